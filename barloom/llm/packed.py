"""Rows of parallel arrays: many small records of one bucket travel as one row of a few binary columns."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text for each bucket.
BUCKET_BYTES = 8 << 20


def bucket_count(docs: DataFrame, text: str = "text") -> int:
    """Buckets in proportion to the bytes of all texts."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, -(-total // BUCKET_BYTES))


def doc_bucket(ids, buckets: int) -> np.ndarray:
    """Bucket of each document id, as :func:`bucket_of` gives it."""
    raw = np.asarray(ids).astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((raw >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


def arrays(table: pa.Table, name: str, kind) -> np.ndarray:
    """All arrays of a binary column, one after another."""
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def split(bucket: np.ndarray, columns: dict[str, np.ndarray]) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """Records by their bucket."""
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order])) + 1
    for at in np.split(order, edges) if len(order) else []:
        yield int(bucket[at[0]]), {name: values[at] for name, values in columns.items()}


def with_bucket(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, doc_id, text), the bucket from the id."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = doc_bucket(batch.column(0).to_numpy(zero_copy_only=False), buckets)
            yield pa.RecordBatch.from_arrays([pa.array(place), *batch.columns], names=["bucket", "doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(add, "bucket int, doc_id long, text string")


def cover(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places some of the spans cover."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:n]) > 0
