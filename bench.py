"""Time every registered query and print one JSON line."""

import json
import os
import time

from barloom.session import new_session
from barloom.suite import QUERIES


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"}
    spark = new_session("barloom-bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    sink = lambda df: df.write.format("noop").mode("overwrite").save()
    sink(QUERIES["hwm_merge"](spark, sf_dir))  # start-up, not timed
    seconds = {}
    for name, query in QUERIES.items():
        start = time.perf_counter()
        sink(query(spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "all queries", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
