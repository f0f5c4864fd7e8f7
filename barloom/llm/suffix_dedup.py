"""Repeated byte strings: front-coded sorted runs of suffixes, exchanged by range and merged by loser trees that never
compare a known prefix again."""

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.packed import arrays, bucket_count, cover, doc_bucket, split, with_bucket
from barloom.llm.units import anchors, mix, prefix, slices, spans

#: Bytes of the shortest repeat, and of the seed at which the sorted suffixes start.
LENGTH, SEED = 200, 64
#: The most ranges that a sample of seeds cuts the order into; beyond, each range is dealt out by the seeds' hash.
RANGES, SAMPLED = 1024, 8192

_SEEDS = "bucket int, row binary, doc binary, start binary, count binary, before binary, seed binary"
_NEEDS = "bucket int, row binary, start binary, count binary, before binary"
_RUNS = (
    "part int, common binary, length binary, rest binary, before binary, left binary, count binary, row binary, "
    "doc binary, start binary, many binary, gone_row binary, gone_doc binary, gone_start binary, gone_count binary"
)
_GONE = "bucket int, row binary, start binary, count binary"
_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _record(schema: str, bucket: int, *values: np.ndarray | bytes) -> pa.RecordBatch:
    packed = [pa.array([v if isinstance(v, bytes) else v.tobytes()], pa.binary()) for v in values]
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *packed], names=_names(schema))


def _table(schema: str, records: list[pa.RecordBatch]) -> pa.Table:
    if records:
        return pa.Table.from_batches(records)
    return pa.table({f.split()[0]: pa.array([], _KINDS[f.split()[1]]) for f in schema.split(", ")})


def _row_keys(ids: np.ndarray, sums: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One number for each row: its id and whole text."""
    return mix(ids.astype(np.int64).view(np.uint64) ^ spans(sums, bounds[:-1], bounds[1:]))


def _windows(data: np.ndarray, bounds: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, ...]:
    """Stretches of consecutive strings of ``length`` bytes within a row that choose the same anchor: row, first
    string, their number, how far the anchor is behind the first, and the hash of the seed at the anchor."""
    sums = prefix(data)
    places = np.arange(max(len(data) - seed + 1, 0))
    grams = spans(sums, places, places + seed)
    at = anchors(grams, length - seed + 1)
    fine = np.ones(len(at), bool)
    for bound in bounds[1:-1].tolist():  # strings that cross into the next row
        fine[max(bound - length + 1, 0) : bound] = False
    place = np.flatnonzero(fine)
    at = at[place]
    new = np.ones(len(place), bool)
    new[1:] = (np.diff(place) != 1) | (np.diff(at) != 0)
    head = np.flatnonzero(new)
    first, anchor = place[head], at[head]
    count = np.diff(np.append(head, len(place)))
    row = np.searchsorted(bounds, first, "right") - 1
    return row, first - bounds[row], count, anchor - first, grams[anchor]


def _seeds(buckets: int, length: int, seed: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ids = batch.column(0).to_numpy(zero_copy_only=False)
            for part in slices(batch.column(1)):
                ids = all_ids[part.first : part.last].astype(np.int64)
                keys = _row_keys(ids, prefix(part.data), part.bounds)
                row, start, count, before, gram = _windows(part.data, part.bounds, length, seed)
                columns = {
                    "row": keys[row], "doc": ids[row], "start": start.astype(np.uint32), "count": count.astype(np.uint16),
                    "before": before.astype(np.uint16), "seed": gram,
                }
                for bucket, cut in split((gram % np.uint64(buckets)).astype(np.int32), columns):
                    yield _record(_SEEDS, bucket, *cut.values())

    return make


def _shared(buckets: int):
    """Stretches whose seed occurs more than once, by the bucket of their document."""

    def shared(key: tuple, table: pa.Table) -> pa.Table:
        seed = arrays(table, "seed", np.uint64)
        order = np.argsort(seed, kind="stable")
        same = np.diff(seed[order]) == 0
        twice = np.zeros(len(seed), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        columns = {"row": np.uint64, "start": np.uint32, "count": np.uint16, "before": np.uint16}
        columns = {name: arrays(table, name, kind)[twice] for name, kind in columns.items()}
        home = doc_bucket(arrays(table, "doc", np.int64)[twice], buckets)
        return _table(_NEEDS, [_record(_NEEDS, bucket, *cut.values()) for bucket, cut in split(home, columns)])

    return shared


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    while a[known : known + 32] == b[known : known + 32]:
        known += 32
    while a[known] == b[known]:
        known += 1
    return known


def front_coded(strings: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Of sorted strings: what each shares with the one before, and the rest."""
    shared = [0] * len(strings)
    for i in range(1, len(strings)):
        shared[i] = common_prefix(strings[i - 1], strings[i])
    return np.array(shared, np.uint16), [s[k:] for s, k in zip(strings, shared)]


def merge(runs: list[Iterator[tuple[int, bytes, bytes, int]]]) -> Iterator[tuple[int, bytes, bytes, int]]:
    """Merge sorted runs of (shared with the one before in the run, string, left, record) into one, with what each
    string shares with the one before in the merged order.

    A tree of losers: every node keeps the run that lost there and what its head shares with the last winner. Of two
    heads the one that shares more with it comes first, without a look at the strings; only when both share equally
    much are they compared, from there on. Equal strings go by ``left``, then by run.
    """
    width = 1
    while width < len(runs):
        width *= 2
    ended = (b"", b"", -1)
    heads, known = [ended] * width, [-1] * width

    def advance(run: int) -> None:
        item = next(runs[run], None)
        known[run], heads[run] = (-1, ended) if item is None else (item[0], item[1:])

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); what the loser shares is then with the winner."""
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        if known[a] < 0:
            return a, b
        x, y = heads[a], heads[b]
        shared = common_prefix(x[0], y[0], known[a])
        if shared == len(x[0]) and shared == len(y[0]):
            first = x[1] < y[1] or (x[1] == y[1] and a < b)
        else:
            first = shared == len(x[0]) or (shared < len(y[0]) and x[0][shared] < y[0][shared])
        winner, loser = (a, b) if first else (b, a)
        known[loser] = shared
        return winner, loser

    for run in range(len(runs)):
        advance(run)
        known[run] = min(known[run], 0)
    losers = [0] * width

    def build(node: int) -> int:
        if node >= width:
            return node - width
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1) if runs else 0
    while runs and known[winner] >= 0:
        yield (known[winner], *heads[winner])
        advance(winner)
        node = (winner + width) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


def _sorted_runs(length: int, seed: int, cuts: list[bytes], fan: int):
    """Suffixes of one bucket of documents that start at shared anchors, as a sorted, front-coded run for each range.

    Equal suffixes with equal bytes to their left, as far as the strings around the anchor go, are sent once, marked as
    many; all their strings are repeats, and are settled here."""

    def make(key: tuple, docs: pa.Table, needs: pa.Table) -> pa.Table:
        if not docs.num_rows or not needs.num_rows:
            return _table(_RUNS, [])
        row, start = arrays(needs, "row", np.uint64), arrays(needs, "start", np.uint32).astype(np.int64)
        count, before = arrays(needs, "count", np.uint16).astype(np.int64), arrays(needs, "before", np.uint16).astype(np.int64)
        order = np.argsort(row, kind="stable")
        docs = docs.combine_chunks()
        ids, seen = docs.column("doc_id").to_numpy(), set()
        found: dict[tuple[bytes, bytes], int] = {}
        first, many, gone = [], [], []  # a place of each different suffix; does it occur again; the repeats
        home = np.zeros(len(row), np.int64)
        row_sorted = row[order]
        for part in slices(docs.column("text").combine_chunks()):
            own = ids[part.first : part.last]
            keys = _row_keys(own, prefix(part.data), part.bounds)
            low, high = np.searchsorted(row_sorted, keys, "left"), np.searchsorted(row_sorted, keys, "right")
            text = part.data.tobytes()
            for i, name in enumerate(keys.tolist()):
                if low[i] == high[i] or name in seen:  # a repeated row has its strings among the first one's
                    continue
                seen.add(name)
                at = order[low[i] : high[i]]
                home[at] = own[i]
                base = int(part.bounds[i])
                ends = (start[at] + count[at] + length - 1 + base).tolist()
                for k, a, m, b in zip(at.tolist(), (start[at] + base).tolist(), (start[at] + base + before[at]).tolist(), ends):
                    suffix = (text[m:b], text[a:m])
                    have = found.setdefault(suffix, len(first))
                    if have == len(first):
                        first.append(k)
                        many.append(False)
                    else:
                        if not many[have]:
                            many[have] = True
                            gone.append(first[have])
                        gone.append(k)
        suffixes = sorted(found.items())
        place = [bisect_right(cuts, s[0][0][:seed]) for s in suffixes]
        if fan > 1:
            place = [p * fan + _spread(s[0][0][:seed], fan) for p, s in zip(place, suffixes)]
        out, gone = [], np.array(gone, np.int64)
        for part, cut in split(np.array(place, np.int32), {"i": np.arange(len(suffixes))}):
            some = [suffixes[i] for i in cut["i"].tolist()]
            shared, rest = front_coded([s[0][0] for s in some])
            at = np.array([first[s[1]] for s in some], np.int64)
            settled, gone = gone, gone[:0]  # with the first of the records
            out.append(
                _record(
                    _RUNS, part, shared, np.array([len(r) for r in rest], np.uint16), b"".join(rest),
                    before[at].astype(np.uint16), b"".join(s[0][1] for s in some), count[at].astype(np.uint16), row[at], home[at],
                    start[at].astype(np.uint32), np.array([many[s[1]] for s in some], np.uint8),
                    row[settled], home[settled], start[settled].astype(np.uint32), count[settled].astype(np.uint16),
                )
            )
        return _table(_RUNS, out)

    return make


def _spread(seed: bytes, fan: int) -> int:
    return int.from_bytes(hashlib.blake2b(seed, digest_size=4).digest(), "little") % fan


def _decoded(line: dict, record: int) -> Iterator[tuple[int, bytes, bytes, int]]:
    """The strings of a front-coded run, one at a time."""
    last, at, left_at = b"", 0, 0
    numbers = (np.frombuffer(line[name], np.uint16).tolist() for name in ("common", "length", "before"))
    for shared, size, left in zip(*numbers):
        last = last[:shared] + line["rest"][at : at + size]
        at += size
        yield shared, last, line["left"][left_at : left_at + left], record
        left_at += left
        record += 1


def _merged(buckets: int, length: int, seed: int):
    """Merge the runs of one range; suffixes that share their seed are neighbours then, equal ones next to each other.

    A suffix that equals its neighbour, with the same bytes to the left, repeats with all its strings. Different ones
    of a seed may still share strings: these start equally far before the anchor, and are found by their hashes."""

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        lines, runs, record = table.to_pylist(), [], 0
        for line in lines:
            runs.append(_decoded(line, record))
            record += len(line["common"]) // 2
        count = arrays(table, "count", np.uint16).astype(np.int64)
        many = arrays(table, "many", np.uint8).astype(bool)
        row, doc = arrays(table, "row", np.uint64), arrays(table, "doc", np.int64)
        start = arrays(table, "start", np.uint32).astype(np.int64)
        gone: list[tuple[np.ndarray, ...]] = []  # record, first string, strings
        group, held, last = [], 0, None

        def settle() -> None:
            if group:
                texts, records, again = zip(*group)
                at, offset = _repeated(list(texts), np.array(records), count, np.array(again), length)
                gone.append((at, offset, np.ones(len(at), np.int64)))
            group.clear()

        whole: list[int] = []
        classes: list[list] = []  # of the current seed: text, record, again

        def end_of_seed() -> None:
            nonlocal held
            if len(classes) > 1:
                group.extend((t, r, a) for t, r, a in classes)
                group.append((None, -1, False))
                held += sum(len(t) for t, _, _ in classes)
            classes.clear()
            if held > 1 << 20:
                settle()
                held = 0

        for shared, suffix, left, at in merge(runs):
            if shared < seed:
                end_of_seed()
                last = None
            if last is not None and shared == len(suffix) == last[0] and left == last[1]:
                tail = classes[-1]
                if not tail[2]:
                    tail[2] = True
                    whole.append(tail[1])
                if not many[at]:
                    whole.append(at)
            else:
                classes.append([left + suffix, at, bool(many[at])])
            last = (len(suffix), left)
        end_of_seed()
        settle()
        at = np.array(whole, np.int64)
        gone.append((at, np.zeros(len(at), np.int64), count[at]))
        record, offset, strings = (np.concatenate(x) for x in zip(*gone))
        record, offset, strings = _joined(record, offset, strings)
        home = np.concatenate([doc[record], arrays(table, "gone_doc", np.int64)])
        columns = {
            "row": np.concatenate([row[record], arrays(table, "gone_row", np.uint64)]),
            "start": np.concatenate([(start[record] + offset).astype(np.uint32), arrays(table, "gone_start", np.uint32)]),
            "count": np.concatenate([strings.astype(np.uint16), arrays(table, "gone_count", np.uint16)]),
        }
        parts = split(doc_bucket(home, buckets), columns)
        return _table(_GONE, [_record(_GONE, bucket, *cut.values()) for bucket, cut in parts])

    return merged


def _joined(record: np.ndarray, offset: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, ...]:
    """Single strings next to each other as one stretch."""
    if not len(record):
        return record, offset, strings
    order = np.lexsort((offset, record))
    record, offset, strings = record[order], offset[order], strings[order]
    new = np.ones(len(record), bool)
    new[1:] = (np.diff(record) != 0) | (offset[1:] != offset[:-1] + strings[:-1])
    head = np.flatnonzero(new)
    return record[head], offset[head], np.add.reduceat(strings, head)


def _repeated(texts: list, records: np.ndarray, count: np.ndarray, again: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings that occur twice among the classes of one seed: record and place. A None ends a seed."""
    group = np.cumsum(np.array([t is None for t in texts]))
    kept = np.flatnonzero(records >= 0)
    data = np.frombuffer(b"".join(t for t in texts if t is not None), np.uint8)
    sizes = np.array([len(texts[k]) for k in kept], np.int64)
    records, group, again = records[kept], group[kept], again[kept]
    n = count[records]
    of = np.repeat(np.arange(len(records)), n)
    inside = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    begin = (np.cumsum(sizes) - sizes)[of] + inside
    keys = mix(spans(prefix(data), begin, begin + length) ^ mix(group[of].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    same = np.diff(keys[order]) == 0
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    at = np.flatnonzero(twice & ~again[of])  # classes that occur again are settled as a whole
    return records[of[at]], inside[at]


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _remove(length: int, with_bytes: bool):
    def remove(key: tuple, docs: pa.Table, gone: pa.Table) -> pa.Table:
        docs = docs.combine_chunks()
        row = arrays(gone, "row", np.uint64)
        start, count = arrays(gone, "start", np.uint32).astype(np.int64), arrays(gone, "count", np.uint16).astype(np.int64)
        order = np.argsort(row, kind="stable")
        row, start, count = row[order], start[order], count[order]
        out: list[tuple] = []
        all_ids = docs.column("doc_id").to_numpy()
        if docs.num_rows:
            for part in slices(docs.column("text").combine_chunks()):
                ids = all_ids[part.first : part.last]
                keys = _row_keys(ids, prefix(part.data), part.bounds)
                low, high = np.searchsorted(row, keys, "left"), np.searchsorted(row, keys, "right")
                for i, name in enumerate(ids.tolist()):
                    data = part.data[part.bounds[i] : part.bounds[i + 1]]
                    removed, n_spans, kept = 0, 0, data
                    if high[i] > low[i]:
                        at = slice(low[i], high[i])
                        lost = cover(len(data), start[at], start[at] + count[at] + length - 1)
                        removed, kept = int(lost.sum()), data[~lost]
                        n_spans = int(lost[:1].sum() + (lost[1:] & ~lost[:-1]).sum())
                    kept = kept.tobytes()
                    digest = hashlib.sha256(kept).hexdigest()
                    out.append((name, len(data), removed, n_spans, digest, kept if with_bytes else None))
        kinds = [_KINDS[field.split()[1]] for field in _RESULT.split(", ")]
        return pa.table({n: pa.array([r[k] for r in out], kinds[k]) for k, n in enumerate(_names(_RESULT))})

    return remove


def _cuts(rows: DataFrame, wanted: int, length: int, seed: int) -> list[bytes]:
    """Seeds that cut the order into about equal ranges, from a bounded sample of the rows, chosen by hash. They
    decide where suffixes are merged, not what is found."""
    every = max(1, rows.count() // 2000)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                row, start, _, before, gram = _windows(part.data, part.bounds, length, seed)
                at = (part.bounds[row] + start + before)[np.argsort(gram)[: 8 * (part.last - part.first)]]
                some = [part.data[k : k + seed].tobytes() for k in at.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], names=["seed"])

    chosen = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("cut")), F.lit(every)) == 0).select("text")
    found = sorted({bytes(r[0]) for r in chosen.mapInArrow(sample, "seed binary").limit(SAMPLED * 4).collect()})
    step = len(found) / wanted
    return sorted({found[int(i * step)] for i in range(1, wanted)}) if found else []


def without_repeats(
    docs: DataFrame, length: int = LENGTH, seed: int = SEED, id: str = "doc_id", text: str = "text", with_bytes: bool = True
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for each row: every byte of the UTF-8 text that lies in
    a string of ``length`` bytes which starts anywhere else too, be it in the same text, is removed; ``kept`` is the
    rest (null if ``with_bytes`` is false). Strings are judged on the input and never cross rows.

    A sparse suffix array: each string of ``length`` bytes chooses one of its runs of ``seed`` bytes as its anchor, by
    hash, so that equal strings choose alike; only suffixes that start at anchors whose seed occurs again can have
    equals, and only these are sorted. Each bucket of documents sorts its own, sends every different one once,
    front-coded, to the task of its range, and the runs meet in a tree of losers (:func:`merge`).

    Null and empty texts have no bytes and keep none. Rows of a null id are left out. Rows that repeat an id, or a
    whole row, are documents of their own: equal texts of ``length`` bytes or more lose all their bytes.
    """
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null")
    buckets = bucket_count(rows)
    ranges = min(buckets, RANGES)
    cuts, fan = _cuts(rows, ranges, length, seed), -(-buckets // ranges)
    seeds = rows.mapInArrow(_seeds(buckets, length, seed), _SEEDS)
    needs = seeds.groupBy("bucket").applyInArrow(_shared(buckets), _NEEDS)
    texts = with_bucket(rows, buckets)
    both = texts.groupBy("bucket").cogroup(needs.withColumnRenamed("bucket", "b").groupBy("b"))
    runs = both.applyInArrow(_sorted_runs(length, seed, cuts, fan), _RUNS)
    gone = runs.groupBy("part").applyInArrow(_merged(buckets, length, seed), _GONE)
    last = with_bucket(rows, buckets).groupBy("bucket").cogroup(gone.withColumnRenamed("bucket", "b").groupBy("b"))
    return last.applyInArrow(_remove(length, with_bytes), _RESULT)
