"""Repeated passages of words: join documents on winnowed anchors, extend matches both ways, keep the long ones."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.packed import arrays, bucket_count, cover, doc_bucket, split, with_bucket
from barloom.llm.ship import ship
from barloom.llm.units import Slice, Words, anchors, mix, prefix, runs, slices, spans, words

#: Words of the shortest match, and of a seed. Every match has a seed that is an anchor, at the same place within it.
LENGTH, SEED = 13, 6

_SEEDS = (
    "bucket int, docs binary, rows binary, held binary, start binary, count binary, seed binary, window binary, "
    "gone_row binary, gone_doc binary, gone_start binary, gone_count binary"
)
_GONE = "bucket int, row binary, start binary, count binary"


def _row_keys(ids: np.ndarray, sums: np.ndarray, part: Slice) -> np.ndarray:
    """One number for each row: its id and whole text."""
    return mix(ids.astype(np.int64).view(np.uint64) ^ spans(sums, part.bounds[:-1], part.bounds[1:]))


def _stretches(doc: np.ndarray, seed: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Where a new stretch of consecutive windows of one row and one anchor begins."""
    if not len(doc):
        return np.zeros(0, np.int64)
    new = (np.diff(doc) != 0) | (np.diff(seed) != 0) | (np.diff(place) != 1)
    return np.concatenate([[0], np.flatnonzero(new) + 1])


def _later(window: np.ndarray, seed: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Windows that also occur, with the same seed, in a smaller id. All 64 bits of the window's hash and the seed's are
    compared, each by itself."""
    order = np.argsort(window, kind="stable")
    new = (np.diff(window[order]) != 0) | (np.diff(seed[order]) != 0)
    starts = np.concatenate([[0], np.flatnonzero(new) + 1]) if len(window) else np.zeros(0, np.int64)
    least = np.minimum.reduceat(ids[order], starts) if len(window) else ids
    out = np.zeros(len(window), bool)
    out[order] = ids[order] > np.repeat(least, np.diff(np.append(starts, len(window))))
    return out


def _counts(length: int, seed_words: int):
    """Windows of a stretch share one anchor, so there are no more of them than one can be in."""
    return np.uint8 if length - seed_words + 1 < 256 else np.uint16


def _seeds(buckets: int, length: int, seed_words: int):
    """Per slice of texts and bucket of seeds: stretches of windows that extend one anchor to both sides, with a hash of
    each window; a window that the slice itself has in a smaller document is settled and goes along as gone."""

    kind = _counts(length, seed_words)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ids = batch.column(0).to_numpy(zero_copy_only=False)
            for part in slices(batch.column(1)):
                ids = all_ids[part.first : part.last]
                sums = prefix(part.data)
                found = words(part)
                hashes = spans(sums, found.starts, found.ends)
                grams, whole = runs(hashes, seed_words), runs(hashes, length)
                at = anchors(grams, length - seed_words + 1)
                place = np.arange(len(whole))
                doc = found.rows[: len(whole)]
                fine = np.flatnonzero(place + length <= found.of[1:][doc])
                place, doc, at, window = place[fine], doc[fine], at[fine], whole[fine]
                seed, inside, keys = grams[at], place - found.of[doc], _row_keys(ids, sums, part)
                gone = _later(window, seed, ids[doc])
                rows = []
                for settled in (False, True):
                    some = np.flatnonzero(gone == settled)
                    first = _stretches(doc[some], at[some], place[some])
                    count = np.diff(np.append(first, len(some))).astype(kind)
                    head = some[first] if len(some) else some
                    rows.append((some, first, head, count))
                (some, first, head, count), (_, _, gone_head, gone_count) = rows
                last = np.append(first, len(some))
                order = (seed[head] % np.uint64(buckets)).astype(np.int32)
                gone_done = False
                parts = list(split(order, {"i": np.arange(len(head))})) or [(0, {"i": np.zeros(0, np.int64)})]
                for bucket, cut in parts:
                    i = cut["i"]
                    used, held = np.unique(doc[head[i]], return_counts=True)  # stretches are in the order of their rows
                    sizes = count[i].astype(np.int64)
                    pieces = np.arange(sizes.sum()) + np.repeat(last[i] - (np.cumsum(sizes) - sizes), sizes)
                    gh, gc = (gone_head[:0], gone_count[:0]) if gone_done else (gone_head, gone_count)
                    gone_done = True
                    yield _record(
                        _SEEDS, bucket, ids[used].astype(np.int64), keys[used], held.astype(np.uint32), inside[head[i]].astype(np.uint32),
                        count[i], (seed[head[i]] >> np.uint64(32)).astype(np.uint32), window[some[pieces]], keys[doc[gh]], ids[doc[gh]].astype(np.int64),
                        inside[gh].astype(np.uint32), gc,
                    )
    return make


def _record(schema: str, bucket: int, *values: np.ndarray) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int32()), *(pa.array([v.tobytes()], pa.binary()) for v in values)], names=names
    )


def _extend(buckets: int, kind):
    """All windows of a bucket of seeds: those that a smaller document has, as stretches by row."""

    def extend(key: tuple, table: pa.Table) -> pa.Table:
        ids, keys = arrays(table, "docs", np.int64), arrays(table, "rows", np.uint64)
        doc = np.repeat(np.arange(len(ids)), arrays(table, "held", np.uint32).astype(np.int64))
        start, count = arrays(table, "start", np.uint32), arrays(table, "count", kind).astype(np.int64)
        seed, window = arrays(table, "seed", np.uint32), arrays(table, "window", np.uint64)
        of = np.repeat(np.arange(len(doc)), count)
        # a seed of one row alone has no match: only the windows of shared ones are compared
        order = np.argsort(seed, kind="stable")
        same = np.diff(seed[order]) == 0
        shared = np.zeros(len(seed), bool)
        shared[order[1:][same]] = shared[order[:-1][same]] = True
        look = np.flatnonzero(shared[of])
        gone = look[_later(window[look], seed[of[look]], ids[doc[of[look]]])]
        inside = start[of[gone]].astype(np.int64) + gone - (np.cumsum(count) - count)[of[gone]]
        first = _stretches(of[gone], of[gone], inside)
        head = gone[first]
        row = np.concatenate([keys[doc[of[head]]], arrays(table, "gone_row", np.uint64)])
        home = np.concatenate([ids[doc[of[head]]], arrays(table, "gone_doc", np.int64)])
        begin = np.concatenate([inside[first].astype(np.uint32), arrays(table, "gone_start", np.uint32)])
        size = np.concatenate([np.diff(np.append(first, len(gone))).astype(kind), arrays(table, "gone_count", kind)])
        parts = split(doc_bucket(home, buckets), {"row": row, "start": begin, "count": size})
        batches = [_record(_GONE, bucket, *part.values()) for bucket, part in parts]
        return pa.Table.from_batches(batches) if batches else _empty(_GONE)

    return extend


def _empty(schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [field.split() for field in schema.split(", ")]
    return pa.table({name: pa.array([], kinds[kind]) for name, kind in fields})


_RESULT = "doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string, kept string"


def _remove(length: int, with_text: bool, kind):
    def remove(key: tuple, docs: pa.Table, gone: pa.Table) -> pa.Table:
        docs = docs.combine_chunks()
        row = arrays(gone, "row", np.uint64)
        start, count = arrays(gone, "start", np.uint32).astype(np.int64), arrays(gone, "count", kind).astype(np.int64)
        order = np.argsort(row, kind="stable")
        row, start, count = row[order], start[order], count[order]
        out = {name.split()[0]: [] for name in _RESULT.split(", ")}
        all_ids = docs.column("doc_id").to_numpy()
        if docs.num_rows:
            for part in slices(docs.column("text").combine_chunks()):
                found, ids = words(part), all_ids[part.first : part.last]
                keys = _row_keys(ids, prefix(part.data), part)
                low, high = np.searchsorted(row, keys, "left"), np.searchsorted(row, keys, "right")
                for i in range(len(ids)):
                    a, b = int(found.of[i]), int(found.of[i + 1])
                    at = slice(low[i], high[i])
                    removed = cover(b - a, start[at], start[at] + count[at] + length - 1)
                    kept = _join(part, found, a + np.flatnonzero(~removed)) if b > a else b""
                    values = (
                        int(ids[i]), b - a, int(removed.sum()), int(removed[:1].sum() + (removed[1:] & ~removed[:-1]).sum()),
                        hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None,
                    )
                    for name, value in zip(out, values):
                        out[name].append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.table({name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds)})

    return remove


def _join(part: Slice, found: Words, kept: np.ndarray) -> bytes:
    """The words kept, joined by one space: a mask over the bytes, with the byte before each word as its space."""
    if not len(kept):
        return b""
    if len(kept) == 1 or (np.diff(kept) == 1).all():
        first, last = found.starts[kept[0]], found.ends[kept[-1]]
        text = part.data[first:last].tobytes()
        return b" ".join(text.split()) if last - first else b""
    data = part.data
    return b" ".join(data[s:e].tobytes() for s, e in zip(found.starts[kept].tolist(), found.ends[kept].tolist()))


def without_repeats(
    docs: DataFrame, length: int = LENGTH, seed_words: int = SEED, id: str = "doc_id", text: str = "text",
    with_text: bool = True,
) -> DataFrame:
    """(doc_id, n_words, n_removed, n_spans, kept_sha256, kept) for each row: every word that lies in a passage of
    ``length`` words which also starts in a document of a smaller id is removed; ``kept`` is the rest, joined by one
    space (null if ``with_text`` is false), and n_spans counts the maximal repeats taken out.

    Each passage of ``length`` words chooses one of its runs of ``seed_words`` words as its anchor, by hash, so equal
    passages choose alike. Rows are joined on anchors: what extends an anchor to either side goes to the anchor's
    bucket, where equal extensions (a 64-bit hash of the passage and 32 bits of its anchor) are grouped and those with a
    smaller document fall; consecutive ones make up a
    maximal repeat. Groups replace pairs of documents, so a passage of all documents costs as much as it is long, times
    the documents. Passages that one slice of rows has in a smaller document already are settled there and not sent.

    Null, empty and blank texts have no words. Rows of a null id are left out; rows that repeat an id are judged one
    by one and do not count as smaller than each other.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null")
    buckets, kind = bucket_count(rows), _counts(length, seed_words)
    seeds = rows.mapInArrow(_seeds(buckets, length, seed_words), _SEEDS)
    gone = seeds.groupBy("bucket").applyInArrow(_extend(buckets, kind), _GONE)
    texts = with_bucket(rows, buckets)
    out = texts.groupBy("bucket").cogroup(gone.withColumnRenamed("bucket", "b").groupBy("b"))
    return out.applyInArrow(_remove(length, with_text, kind), _RESULT)
