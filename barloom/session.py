"""Session settings, the shared scratch folder and small work tables kept in it."""

import json
import re
import tempfile
import uuid
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings that change results, not speed: stamps are UTC, `symbol=007` stays text, and nanosecond
# Parquet stamps arrive as a long instead of failing the read.
PINNED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}

MAX_DOCUMENT_BYTES = 64 * 1024 * 1024

#: Bytes of rows that go to a Python worker at once; Spark's 64 MB of texts are there several times over, as buffers of
#: Spark, as a batch and as strings of the worker, and as the batch that comes back.
BATCH_BYTES = 2 * 1024 * 1024

_local_scratch: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in PINNED.items():
        spark.conf.set(key, value)
    return spark


def new_session(app: str = "barloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH_BYTES`` in this session from now on, unless it has a size of its own; results do not
    depend on it. A row is never split."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="barloom-")
    return _local_scratch[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def work_table(df: DataFrame, name: str) -> DataFrame:
    """Write a narrow table to scratch and read it back.

    This cuts the lineage (the result no longer depends on files a job is about to replace) and gives
    Spark the true size, so that a join broadcasts it only below ``autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def names_of(df: DataFrame, column: str, decode: bool = False) -> list[str]:
    """All paths of a listing, as Spark's readers take them: no character stands for a pattern.

    They come to the driver whatever their number, where Spark keeps the file index of any read, too.
    ``decode`` is for paths in the form of ``_metadata.file_path``, whose special characters are escaped.
    """
    names = (row[0] for row in df.select(column).toLocalIterator())
    return [literal_path(unquote(name) if decode else name) for name in names]


def literal_path(path: str) -> str:
    return re.sub(r"[{}\[\]*?\\]", r"\\\g<0>", path)


def read_whole(spark: SparkSession, path: str, max_bytes: int = MAX_DOCUMENT_BYTES) -> DataFrame:
    """The text of a small file in one row; an error if it is not small."""
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    if size > max_bytes:
        raise ValueError(f"{path} has {size} bytes, more than the {max_bytes} that one task may read")
    return spark.read.text(path, wholetext=True)


def local_table(spark: SparkSession, rows: list[dict], schema: T.StructType | str) -> DataFrame:
    """A few rows of the driver as a table in one partition, small enough for Spark to broadcast it."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    literal = F.lit(json.dumps(rows, default=str))
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(literal, T.ArrayType(schema))))


@contextmanager
def settings(spark: SparkSession, **values: object):
    """Session settings (``__`` stands for a dot) for the actions inside the block."""
    keys = {name.replace("__", "."): str(value) for name, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shuffle_width(spark: SparkSession, partitions: int):
    """Raise the number of shuffle partitions for the actions inside the block, never lower it."""
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return settings(spark, spark__sql__shuffle__partitions=max(now, partitions))
