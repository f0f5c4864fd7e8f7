"""Top-k search and near-duplicate vectors against brute force."""

import math
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from barloom.llm import vector_dedup
from barloom.llm.topk import sound_vectors, top_k
from barloom.llm.vector_dedup import near_vectors
from barloom.session import scratch_root, settings

NAN, INF = float("nan"), float("inf")


def vectors(spark, n=300, size=8):
    random.seed(6)
    centres = [[random.gauss(0, 1) for _ in range(size)] for _ in range(20)]
    rows = []
    for i in range(n):
        centre = random.choice(centres)
        rows.append((i * 3, [c + random.gauss(0, 0.15) for c in centre], i % 3 if i % 11 else None, "x"))
    rows += [(5000 + i, rows[0][1], 0, "copy") for i in range(40)]
    rows += [(6000, None, 0, ""), (6001, [0.0] * size, 0, ""), (6002, [NAN] + [1.0] * 7, 0, ""), (6003, [INF] + [1.0] * 7, 0, "")]
    rows += [(6050, [None] + [1.0] * 7, 0, ""), (6100, [1e300] * size, 1, ""), (6101, [], 1, ""), (6102, [1.0, 2.0], 1, "")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, cell string"), rows


def sound(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def test_top_k(spark):
    table, rows = vectors(spark)
    large = [(6200 + 50 * i, [x * 10.0 ** (3 + i / 2) for x in rows[i][1]], 0, "") for i in range(4)]
    large += [(6601, [600000.0, 1.0], 0, ""), (6650, [1.0, 2.0], 0, ""), (6650, [0.5, 2.0], 0, "")]
    table = table.where("vec_id <> 6100").unionByName(spark.createDataFrame(large, table.schema)).repartition(3)
    rows = [(i, [math.floor(256 * x) for x in v]) for i, v, _, _ in rows + large if sound(v) and i != 6100]
    expected, asked = [], {}
    for q, a in rows:
        if q % 50 == 0:
            asked[q] = min(a, asked.get(q, a))
    for q, a in asked.items():
        best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in rows if i != q)[:5]
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    integers = sound_vectors(table)
    got = top_k(integers.where("vec_id % 50 = 0"), integers).collect()
    assert sorted(map(tuple, got)) == sorted(expected)
    assert top_k(integers.limit(0), integers).count() == 0
    assert top_k(integers.where("vec_id = 0"), integers.where("vec_id <= 6")).count() == 2
    assert top_k(integers.where("vec_id % 50 = 0"), integers, k=5).exceptAll(spark.createDataFrame(got)).count() == 0
    wide = spark.createDataFrame([(0, [1e16, 1.0]), (1, [0.0, 5.0]), (2, [-1e16, 9.0]), (3, [1e-9, 4.0]), (4, [0.0, 4.0])], "vec_id long, terms array<double>")
    found = top_k(wide.where("vec_id = 0"), wide, k=3).collect()  # sums far beyond a long are compared, not cut
    assert sorted(map(tuple, found)) == [(0, 1, 1, 5 * 65536), (0, 2, 3, 4 * 65536), (0, 3, 4, 4 * 65536)]
    with pytest.raises(Exception, match="too large|too big|Overflow"):  # a score that no long holds
        top_k(integers.where("vec_id = 0"), sound_vectors(vectors(spark)[0])).collect()


def test_near_vectors(spark):
    table, rows = vectors(spark)
    fine = [(i, np.array(v), g) for i, v, g, _ in rows if sound(v) and any(v) and g is not None]
    linked = {i: set() for i, *_ in rows}
    for i, v, g in fine:
        for j, w, h in fine:
            if i < j and g == h and len(v) == len(w):
                v1, w1 = v / np.abs(v).max(), w / np.abs(w).max()
                if v1 @ w1 / (np.linalg.norm(v1) * np.linalg.norm(w1)) >= 0.93:
                    linked[i].add(j), linked[j].add(i)
    expected = {}
    for i in linked:
        seen, todo = {i}, [i]
        while todo:
            todo = [y for x in todo for y in linked[x] if y not in seen and not seen.add(y)]
        expected[i] = (len(linked[i]), min(seen), min(seen) == i)
    got = near_vectors(table).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == expected and len(got) == len(rows)
    assert near_vectors(table.limit(0)).count() == 0


def near_by_hand(ids, points, labels, least=0.93):
    units = points.astype(np.float64) / np.linalg.norm(points.astype(np.float64), axis=1, keepdims=True)
    close = (units @ units.T >= least) & (labels[:, None] == labels[None])
    np.fill_diagonal(close, False)
    root = ids.copy()
    while (lower := np.minimum(root, np.where(close, root[None], 1 << 60).min(1))).tolist() != root.tolist():
        root = lower
    return {int(i): (int(n), int(r), bool(i == r)) for i, n, r in zip(ids, close.sum(1), root)}


def test_near_vectors_in_cells_and_blocks(spark):
    """Several pivots, blocks and batches; copies far from one another; labels of which one fills many blocks."""
    rng = np.random.default_rng(3)
    n, size = 2400, 40
    points = rng.normal(size=(60, size))[rng.integers(0, 60, n)] + rng.normal(size=(n, size)) * rng.choice([0.2, 0.27, 1], n)[:, None]
    points[rng.choice(n, 300, replace=False)] = points[rng.integers(0, 20, 300)]
    points, labels, ids = points.astype(np.float32), np.where(np.arange(n) % 12 < 10, 0, 1), rng.permutation(n) * 7
    points[points[:, 0] == 0, 0] = 1
    expected = near_by_hand(ids, points, labels)
    assert sum(n > 0 for n, *_ in expected.values()) > 500 and len({r for _, r, _ in expected.values()}) > 100
    rows = [(int(i), p.tolist(), int(g)) for i, p, g in zip(ids, points, labels)]
    for kind, cell, block_bytes, batch in (("float", 300, 50_000, 100), ("double", 40, 20_000, 30)):
        table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(5)
        with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=batch):
            got = near_vectors(table, cell=cell, block_bytes=block_bytes).collect()
        assert len(got) == n and {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == expected, (kind, cell)


def test_near_vectors_odd_rows_in_small_blocks(spark):
    table, rows = vectors(spark)
    table = table.union(table.where("vec_id % 9 = 0")).union(table.selectExpr("vec_id + 3", "embedding", "label", "cell").limit(40))
    table = table.union(table.selectExpr("cast(null as long)", "embedding", "label", "cell").limit(9)).repartition(6)
    whole = sorted(map(tuple, near_vectors(table).collect()))
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=5):
        assert sorted(map(tuple, near_vectors(table, cell=10, block_bytes=300).collect())) == whole
    assert len(whole) == len({r[0] for r in whole}) == table.where("vec_id is not null").select("vec_id").distinct().count()


def test_near_vectors_writes_each_vector_once(spark, tmp_path):
    """Vectors were copied into nearly every cell, once for each pivot, in one batch of a worker."""
    rng = np.random.default_rng(4)
    n, size = 30_000, 16
    table = pa.table({
        "vec_id": np.arange(n), "label": np.arange(n) % 30,
        "embedding": pa.FixedSizeListArray.from_arrays(rng.normal(size=n * size).astype(np.float32), size).cast(pa.list_(pa.float32())),
    })
    pq.write_table(table, tmp_path / "vectors.parquet")
    written = lambda: sum(f.stat().st_size for f in Path(scratch_root(spark).removeprefix("file:")).rglob("*.parquet"))
    before = written()
    assert near_vectors(spark.read.parquet(str(tmp_path / "vectors.parquet"))).count() == n
    assert n * size * 4 < written() - before < 2 * n * size * 4


def test_cells_rule_out_no_link():
    """Tiles of cells and leading components against all products, on vectors that lie around the limit."""
    rng = np.random.default_rng(5)
    points = rng.normal(size=(40, 64))[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, 64)) * 0.27
    points = points.astype(np.float32)
    guide = vector_dedup._Guide(points[:300].astype(np.float64), 8)
    homes = guide.homes(vector_dedup._unit(points))
    order = np.argsort(homes, kind="stable")
    points, homes, ids, ones = points[order], homes[order], np.arange(6000), np.ones(6000, np.int64)
    halves = [
        vector_dedup._Block(64, *(x[at].tobytes() for x in (ids, ones, homes, points)), guide, np.float32)
        for at in (slice(0, 3100), slice(3100, 6000))
    ]
    found = []
    for i, j in ((0, 0), (0, 1), (1, 1)):
        for x, y in vector_dedup._pairs(halves[i], halves[j], guide, 0.93):
            found += zip((halves[i].ids[x]).tolist(), (halves[j].ids[y]).tolist())
    units = vector_dedup._unit(points)
    x, y = np.nonzero(np.triu(units @ units.T >= 0.93, 1))
    assert sorted(tuple(sorted(p)) for p in found) == sorted(zip(x.tolist(), y.tolist())) and len(x) > 10_000
