"""Near-duplicate vectors: an exact range join on the unit sphere, of blocks that are read again and never shuffled twice."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.graph import components
from barloom.session import BATCH_BYTES, settings, work_table

#: Rows that a label has for each pivot, the most pivots, and the most bytes of them (and of the rows they come from).
CELL, PIVOTS, GUIDE_BYTES = 2048, 1024, 8 << 20
#: Lengths of vectors that get pivots; those with the most pairs do.
GUIDES = 16
#: Bytes of vectors that a task reads of either side of a pair, at least and at most, and in how many parts all are read.
SHARE_BYTES, SHARES = (4 << 20, 64 << 20), 12
#: Components that are compared before whole vectors are, and rows of a tile, on the left and on the right.
AXES, TILE = 23, (128, 2048)
#: Pairs that are compared in full at once, if a tile has not more.
DENSE = 4096
#: Rows a cell must have, on average, for its bounds to be worth their time.
CROWDED = 256

_KEYED = ["label", "size", "home", "key", "vector", "id", "ids"]
_PACKED = "label string, size int, first long, ids binary, n binary, homes binary, vectors binary, copies binary, owners binary"


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _binary(lengths: np.ndarray, data: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the values, and all their bytes."""
    offsets = np.frombuffer(array.buffers()[1], np.int32, len(array) + 1, array.offset * 4)
    data = np.frombuffer(array.buffers()[2] or b"", np.uint8)
    return np.diff(offsets), data[offsets[0] : offsets[-1]]


class _Guide:
    """Pivots and leading directions of the vectors of one length; they save time and decide on no link."""

    def __init__(self, sample: np.ndarray, pivots: int) -> None:
        sample = _unit(sample)
        self.pivots = np.unique(sample[:pivots].astype(np.float32), axis=0)
        self.axes = np.linalg.svd(sample, full_matrices=False)[2][:AXES].T

    def homes(self, units: np.ndarray) -> np.ndarray:
        """The nearest pivot, from small integers: sums of their products are exact, so equal vectors get equal homes."""
        pivots = np.rint(self.pivots * 256).T
        return np.concatenate([
            (np.rint(units[i : i + 4096] * 256).astype(np.float32) @ pivots).argmax(1) for i in range(0, len(units), 4096)
        ]).astype(np.int32)


def _homes(guides: dict[int, _Guide], kind: type):
    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Vectors as bytes with their home and a hash; equal ones of a batch become one row with all their ids.

        Ids of rows that link with nothing come in rows of no label, size 0 and no vector.
        """
        for batch in batches:
            lists = batch.column(2)
            offsets, valid = np.asarray(lists.offsets), batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            values, sizes = lists.values.to_numpy(zero_copy_only=False), np.diff(offsets)  # a null component is NaN
            sizes = np.where(lists.is_valid().to_numpy(zero_copy_only=False) & valid, sizes, 0)
            all_ids = batch.column(0).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                rows = values[offsets[at][:, None] + np.arange(size)].astype(kind, copy=False) + kind(0)  # -0.0 becomes 0.0
                sound = np.isfinite(rows).all(1) & rows.any(1)
                if not sound.all():
                    ids = all_ids[at[~sound]]
                    n, no = len(ids), np.zeros(len(ids), np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(n, pa.string()), pa.array(no), pa.array(no), pa.array(ids), _binary(no, ids[:0]), pa.array(ids), _binary(no + 8, ids)],
                        names=_KEYED,
                    )
                    at, rows = at[sound], rows[sound]
                if not len(at):
                    continue
                mix = np.random.default_rng(size).integers(0, 1 << 63, size, np.uint64) | np.uint64(1)
                key = rows.view(f"u{rows.itemsize}").astype(np.uint64) @ mix
                key = ((key ^ (key >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
                ids, names = all_ids[at], batch.column(1).take(pa.array(at)).dictionary_encode()
                codes = names.indices.to_numpy(zero_copy_only=False)
                order = np.lexsort([ids, codes, key])
                key, codes, ids, rows = key[order], codes[order], ids[order], rows[order]
                new = np.r_[True, (key[1:] != key[:-1]) | (codes[1:] != codes[:-1]) | (rows[1:] != rows[:-1]).any(1)]
                first = np.flatnonzero(new)
                rows, counts = rows[first], np.diff(np.append(first, len(ids)))
                home = guides[size].homes(_unit(rows)) if size in guides else np.zeros(len(rows), np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        names.dictionary.take(pa.array(codes[first])), pa.array(np.full(len(first), size, np.int32)),
                        pa.array(home), pa.array(key[first]), _binary(np.full(len(first), size * rows.itemsize), rows),
                        pa.array(ids[first]), _binary(counts * 8, ids),
                    ],
                    names=_KEYED,
                )

    return homes


def _classes(batches: Iterator[pa.RecordBatch], number: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, int, np.ndarray, np.ndarray]]:
    """Classes of equal vectors from sorted rows: (a row for each, sizes, number of the first; other ids, their numbers).

    The last class of a batch is held until it is known to have ended; the first row of a class has its least id. Ids of
    rows that link with nothing come as other ids of class -1.
    """
    held, n_held = None, 0
    for batch in batches:
        alone = pc.equal(batch.column("size"), 0)
        if pc.any(alone).as_py():
            ids = _bytes(batch.filter(alone).column("ids"))[1].view(np.int64)
            yield batch.slice(0, 0), np.zeros(0, np.int64), 0, ids, np.full(len(ids), -1)
            batch = batch.filter(pc.invert(alone))
        if not batch.num_rows:
            continue
        rows = pa.concat_batches([held, batch]) if held else batch
        lengths, data = _bytes(rows.column("ids"))
        counts, ids = lengths // 8, data.view(np.int64)
        equal = np.logical_and.reduce([
            pc.equal(x.slice(1), x.slice(0, len(x) - 1)).to_numpy(zero_copy_only=False).astype(bool)
            for x in (rows.column(name) for name in ("key", "size", "label", "vector"))
        ])
        new = np.r_[True, ~equal]
        first = np.flatnonzero(new)
        rest = np.ones(len(ids), bool)
        rest[(np.cumsum(counts) - counts)[first]] = False
        owners = np.repeat(number + np.cumsum(new) - 1, counts)
        if held:
            rest[: counts[0]], counts = False, np.append(n_held, counts[1:])
        n, rows = np.add.reduceat(counts, first), rows.take(pa.array(first))
        yield rows.slice(0, len(n) - 1), n[:-1], number, ids[rest], owners[rest]
        held, n_held, number = rows.slice(len(n) - 1), n[-1], number + len(n) - 1
    if held:
        yield held, np.array([n_held]), number, np.zeros(0, np.int64), np.zeros(0, np.int64)


def _blocks(block_bytes: int):
    schema = pa.schema([
        ("label", pa.string()), ("size", pa.int32()), ("first", pa.int64()),
        *((name, pa.binary()) for name in ("ids", "n", "homes", "vectors", "copies", "owners")),
    ])

    def row(*values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(values, schema.types)], schema=schema)

    def block(parts: list[tuple[pa.RecordBatch, np.ndarray, int]]) -> pa.RecordBatch:
        joined = lambda name, kind: b"".join(p.column(name).to_numpy(zero_copy_only=False).astype(kind).tobytes() for p, *_ in parts)
        return row(
            parts[0][0].column("label")[0].as_py(), parts[0][0].column("size")[0].as_py(), parts[0][2], joined("id", np.int64),
            b"".join(n.astype(np.int64).tobytes() for _, n, _ in parts), joined("home", np.int32),
            b"".join(_bytes(p.column("vector"))[1].tobytes() for p, *_ in parts), b"", b"",
        )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of classes of one label and length, as one row each; ids of copies in rows of their own, without a label."""
        parts, held, last, copies = [], 0, None, []
        for rows, n, number, others, owners in _classes(batches, TaskContext.get().partitionId() << 36):
            if len(others):
                copies.append((others, owners))
            if copies and sum(len(x) for x, _ in copies) * 8 >= block_bytes:
                yield row(None, None, None, b"", b"", b"", b"", *(np.concatenate(x).astype(np.int64).tobytes() for x in zip(*copies)))
                copies = []
            if not rows.num_rows:
                continue
            label, size = rows.column("label"), rows.column("size")
            turns = np.logical_or.reduce([
                pc.not_equal(x.slice(1), x.slice(0, len(x) - 1)).to_numpy(zero_copy_only=False).astype(bool) for x in (label, size)
            ])
            edges = [0, *(np.flatnonzero(turns) + 1).tolist(), rows.num_rows]
            for at, end in zip(edges, edges[1:]):
                if parts and last != (last := (label[at].as_py(), size[at].as_py())):
                    yield block(parts)
                    parts, held = [], 0
                last = (label[at].as_py(), size[at].as_py())
                width = len(rows.column("vector")[at].as_buffer())
                while at < end:
                    taken = min(end - at, max(1, (block_bytes - held) // width))
                    parts.append((rows.slice(at, taken), n[at : at + taken], number + at))
                    held, at = held + taken * width, at + taken
                    if held + width > block_bytes:
                        yield block(parts)
                        parts, held = [], 0
        if parts:
            yield block(parts)
        if copies:
            yield row(None, None, None, b"", b"", b"", b"", *(np.concatenate(x).astype(np.int64).tobytes() for x in zip(*copies)))

    return blocks


class _Block:
    """Vectors of a block, made ready to be compared."""

    def __init__(self, size: int, ids, n, homes, vectors, guide: _Guide | None, kind: type) -> None:
        self.ids, self.n, homes = np.frombuffer(ids, np.int64), np.frombuffer(n, np.int64), np.frombuffer(homes, np.int32)
        self.rows = np.frombuffer(vectors, kind).reshape(-1, size)
        self.counts = None
        edges = [0, *(np.flatnonzero(np.diff(homes)) + 1).tolist(), len(homes)]
        self.cells = [(int(homes[a]), a, b) for a, b in zip(edges, edges[1:])]
        axes = guide.axes if guide and guide.axes.shape[1] < size else None
        width = size if axes is None else axes.shape[1] + 1
        self.low, self.units = np.empty((len(self.ids), width), np.float32), np.empty((len(self.ids), size), np.float32)
        for i in range(0, len(self.ids), 4096):
            units = _unit(self.rows[i : i + 4096])
            self.units[i : i + 4096] = units
            if axes is None:
                self.low[i : i + 4096] = units
            else:  # the last component is the length of what the axes leave: it bounds the rest of a product from above
                self.low[i : i + 4096, :-1] = part = units @ axes
                self.low[i : i + 4096, -1] = np.sqrt(np.maximum(1 - (part * part).sum(1), 0) + 1e-12)

    def own(self, guide: _Guide) -> np.ndarray:
        """Products of rows with their home."""
        return np.concatenate([self.units[a:b] @ guide.pivots[c] for c, a, b in self.cells])


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, and the place of each row among them."""
    low = x.min()
    seen = np.zeros(x.max() - low + 1, bool)
    seen[x - low] = True
    return np.flatnonzero(seen) + low, (np.cumsum(seen) - 1)[x - low]


def _close(left: _Block, right: _Block, x: np.ndarray, y: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (x, y) whose cosine is ``least`` or more."""
    (xs, at_x), (ys, at_y) = _distinct(x), _distinct(y)
    if len(xs) * len(ys) <= 128 * len(x):
        kept = (_unit(left.rows[xs]) @ _unit(right.rows[ys]).T)[at_x, at_y] >= least
    else:
        step = max(1, (1 << 20) // left.rows.shape[1])
        kept = np.concatenate([
            np.einsum("ij,ij->i", _unit(left.rows[x[i : i + step]]), _unit(right.rows[y[i : i + step]])) >= least
            for i in range(0, len(x), step)
        ])
    kept &= left.ids[x] != right.ids[y]
    return x[kept], y[kept]


def _tiles(left: _Block, right: _Block, guide: _Guide | None, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of either block that may be linked, tile by tile, each pair once.

    For a at home with pivot g and b with h: a(g - h) + b(h - g) = (a - b)(g - h) is at most the distance of a and b times
    that of the pivots. So with both sides in the order of their terms, a row is compared with the first rows of the other.
    """
    size = left.units.shape[1]
    enough = np.float32(least - (left.low.shape[1] + 4) * 2.0**-23)
    radius, slack = np.sqrt(max(0.0, 2 - 2 * least)), 1e-6 + size * 2.0**-22
    whole = guide is None or len(left.ids) + len(right.ids) < CROWDED * (len(left.cells) + len(right.cells))
    ours, theirs = ([(0, 0, len(x.ids))] if whole else x.cells for x in (left, right))
    if not whole:
        mine, other = (guide.pivots[[c for c, *_ in cells]] for cells in (ours, theirs))
        # what a row has of its own pivot more than of each pivot of the other side, a line for each of these
        ahead = left.own(guide) - other @ left.units.T
        beyond = right.own(guide) - mine @ right.units.T
        apart = ((mine.astype(np.float64)[:, None] - other) ** 2).sum(2)
        limits = (radius * np.sqrt(apart) + slack).astype(np.float32)
    for i, (g, a, b) in enumerate(ours):
        for j, (h, c, d) in enumerate(theirs):
            if left is right and j < i:
                continue
            if g != h:
                s, t, most = ahead[j, a:b], beyond[i, c:d], limits[i, j]
                rows, others = np.flatnonzero(s <= most - t.min()), np.flatnonzero(t <= most - s.min())
                if not len(rows) or not len(others):
                    continue
                s, t = s[rows], t[others]
                up, on = np.argsort(s), np.argsort(t)
                rows, others = rows[up] + a, others[on] + c
                reach = np.searchsorted(t[on], most - s[up[:: TILE[0]]], "right")
                low = right.low[others]
            for k in range(0, b - a if g == h else len(rows), TILE[0]):
                begin, end = (k if left is right else 0, d - c) if g == h else (0, int(reach[k // TILE[0]]))
                some = slice(a + k, min(a + k + TILE[0], b)) if g == h else rows[k : k + TILE[0]]
                part = left.low[some]
                for m in range(begin, end, TILE[1]):
                    width = min(TILE[1], end - m)
                    hits = np.flatnonzero(part @ (right.low[c + m : c + m + width] if g == h else low[m : m + width]).T >= enough)
                    if len(hits):
                        x, y = hits // width, m + hits % width
                        x, y = (x + a + k, y + c) if g == h else (some[x], others[y])
                        if g == h and left is right:
                            x, y = x[y > x], y[y > x]
                        if len(x):
                            yield x, y


def _pairs(left: _Block, right: _Block, guide: _Guide | None, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked rows of either block, each pair once; few of a tile wait for those of others."""
    waiting, n = [], 0
    for x, y in _tiles(left, right, guide, least):
        if len(x) >= DENSE:
            yield _close(left, right, x, y, least)
            continue
        waiting.append((x, y))
        n += len(x)
        if n >= DENSE:
            yield _close(left, right, *(np.concatenate(z) for z in zip(*waiting)), least)
            waiting, n = [], 0
    if waiting:
        yield _close(left, right, *(np.concatenate(z) for z in zip(*waiting)), least)


class _Links:
    """Counts of links, and links that connect what all links of a task connect, at most one a row."""

    def __init__(self) -> None:
        self.ids, self.root = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.counts, self.kept, self.places = np.zeros(0, np.int64), [], {}

    def place(self, key: int, block: _Block) -> int:
        if key not in self.places:
            self.places[key] = len(self.ids)
            self.root = np.append(self.root, len(self.ids) + np.arange(len(block.ids)))
            self.ids, self.counts = np.append(self.ids, block.ids), np.append(self.counts, np.zeros(len(block.ids), np.int64))
        return self.places[key]

    def find(self, x: np.ndarray) -> np.ndarray:
        root = self.root[x]
        while ((above := self.root[root]) != root).any():
            root = above
        self.root[x] = root
        return root

    def add(self, x: np.ndarray, y: np.ndarray, n_x: np.ndarray, n_y: np.ndarray) -> None:
        np.add.at(self.counts, x, n_y)
        np.add.at(self.counts, y, n_x)
        while True:
            a, b = self.find(x), self.find(y)
            apart = a != b
            if not apart.any():
                return
            x, y, a, b = x[apart], y[apart], a[apart], b[apart]
            high, at = np.unique(np.maximum(a, b), return_index=True)  # a root goes below one smaller one: no cycles
            self.root[high] = np.minimum(a, b)[at]
            self.kept.append(self.ids[np.stack([x[at], y[at]])])

    def batches(self) -> Iterator[pa.RecordBatch]:
        some = self.counts > 0
        links = np.concatenate([np.zeros((2, 0), np.int64), *self.kept], axis=1)
        for a, b, n in ((self.ids[some], None, self.counts[some]), (links[0], links[1], np.zeros(links.shape[1], np.int64))):
            for i in range(0, len(a), 1 << 16):
                part = slice(i, i + (1 << 16))
                other = pa.nulls(len(a[part]), pa.int64()) if b is None else pa.array(b[part])
                yield pa.RecordBatch.from_arrays([pa.array(a[part]), other, pa.array(n[part])], names=["a", "b", "n"])


def _linked(guides: dict[int, _Guide], kind: type, least: float):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each row linked here: its links; and links that connect what is connected here."""
        links, ready = _Links(), {}
        for batch in batches:
            for i in range(batch.num_rows):
                value = lambda name: batch.column(name)[i]  # noqa: B023, E731
                size = value("size").as_py()
                guide, keys = guides.get(size), [value(f"{side}_first").as_py() for side in "lr"]
                ready = {key: ready[key] for key in keys if key in ready}  # one side stays the same for many rows
                for key, side in zip(keys, "lr"):
                    if key not in ready:
                        columns = (value(f"{side}_{name}").as_buffer() for name in ("ids", "n", "homes", "vectors"))
                        ready[key] = _Block(size, *columns, guide, kind)
                left, right = (ready[key] for key in keys)
                for x, y in _pairs(left, right, guide, least):
                    if len(x):
                        at, to = (links.place(key, block) for key, block in zip(keys, (left, right)))
                        links.add(at + x, to + y, left.n[x], right.n[y])
        yield from links.batches()

    return linked


def _singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(number, id, n) of the classes of packed blocks."""
    for batch in batches:
        for first, ids, n in zip(*(batch.column(name) for name in ("first", "ids", "n"))):
            ids, n = (np.frombuffer(x.as_buffer(), np.int64) for x in (ids, n))
            yield pa.RecordBatch.from_arrays([pa.array(first.as_py() + np.arange(len(ids))), pa.array(ids), pa.array(n)], names=["number", "id", "n"])


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pair in zip(batch.column("copies"), batch.column("owners")):
            arrays = [pa.array(np.frombuffer(x.as_buffer(), np.int64)) for x in pair]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "number"])


def near_vectors(
    vectors: DataFrame, least: float = 0.93, id: str = "vec_id", vector: str = "embedding", label: str = "label",
    cell: int = CELL, block_bytes: int | None = None,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row: links are pairs of one label with cosine >= ``least``.

    Equal vectors of one label form a class, whose copies are linked with one another (their cosine is 1) and are
    compared once. On the unit sphere the cosine is a distance, sqrt(2 - 2 cos). A bounded sample of the vectors serves as
    pivots, and a vector is at home with its nearest pivot. Classes are shuffled once, in the order of label, length and
    home, and packed into blocks of some MB, as one row each. All pairs of blocks of a label are then read from
    their files by a nested loop, which shuffles and copies nothing, so neither memory nor disk depends on how many pivots
    there are or how far a link reaches. Within a pair of blocks, the planes between pivots rule out most rows, leading
    components most others, and what is left is compared in full. Links leave a task as counts and as a spanning forest.

    Vectors that are null, zero, empty or hold null or non-finite components, and rows without a label, link with
    nothing: n_links 0, a component of their own. Vectors of different lengths never link. Rows of a null id are left
    out; of rows that repeat an id each is a row of its own in n_links, and one row per id is returned.
    ``cell`` and ``block_bytes`` (by the size of the input if None) change no result.
    """
    spark = vectors.sparkSession
    of = vectors.schema[vector].dataType.elementType
    kind = np.float32 if isinstance(of, T.FloatType) else np.float64
    plain = isinstance(of, (T.FloatType, T.DoubleType))
    rows = vectors.select(
        F.col(id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
        (F.col(vector) if plain else F.transform(vector, lambda x: x.cast("double"))).alias("vector"),
    ).where("vec_id is not null")
    # rows that link with nothing count here too: this decides on sizes and pivots only
    sizes = rows.where("label is not null and size(vector) > 0").groupBy(F.size("vector").alias("size"), "label").count()
    sizes = sizes.groupBy("size").agg(F.sum("count").alias("count"), F.sum(F.col("count").cast("double") ** 2).alias("pairs"))
    sizes = sizes.withColumn("total", F.sum(F.col("size") * F.col("count")).over(Window.partitionBy()))
    guides, total = {}, 0
    for size, count, pairs, total in sizes.orderBy(F.desc("pairs"), "size").limit(GUIDES).collect():
        most = GUIDE_BYTES // (size * 8)
        wanted = int(min(pairs / count // cell, PIVOTS, most))
        if wanted > 1:
            sample = rows.where(F.col("label").isNotNull() & (F.size("vector") == size)).orderBy(F.xxhash64("vec_id")).select("vector")
            sample = np.array([row[0] for row in sample.limit(min(max(wanted, 256), most)).collect()], np.float64)
            sample = sample[np.isfinite(sample).all(1) & sample.any(1)]
            if len(sample):
                guides[size] = _Guide(sample, wanted)
    total *= np.dtype(kind).itemsize
    share = min(max(total // SHARES, SHARE_BYTES[0]), SHARE_BYTES[1])
    block_bytes = block_bytes or min(share // 4, SHARE_BYTES[1] // 16)
    with settings(
        spark, spark__sql__execution__arrow__maxBytesPerBatch=BATCH_BYTES, spark__sql__files__maxPartitionBytes=share,
        spark__sql__files__openCostInBytes=1 << 16,
        spark__sql__execution__arrow__useLargeVarTypes="false",
    ):
        homes = rows.mapInArrow(
            _homes(guides, kind), "label string, size int, home int, key long, vector binary, id long, ids binary"
        )
        order = ["label", "size", "home", "key"]
        spread = homes.repartitionByRange(int(-(-total * 5 // share)) or 1, *order).sortWithinPartitions(*order, "vector", "id")
        with settings(spark, spark__sql__parquet__compression__codec="uncompressed"):  # vectors hardly shrink; read many times
            packed = work_table(spread.mapInArrow(_blocks(block_bytes), _PACKED), "blocks")
        blocks = packed.where("label is not null")
        columns = ["first", "ids", "n", "homes", "vectors"]
        left = blocks.select("label", "size", *(F.col(c).alias(f"l_{c}") for c in columns))
        right = blocks.select(
            F.col("label").alias("r_label"), F.col("size").alias("r_size"), *(F.col(c).alias(f"r_{c}") for c in columns)
        )
        # no equality on purpose: it would bring all blocks of a label to one task
        pairs = left.crossJoin(right).where(
            "label <= r_label and label >= r_label and size <= r_size and size >= r_size and l_first <= r_first"
        ).drop("label", "r_label", "r_size")
        found = work_table(pairs.mapInArrow(_linked(guides, kind, least), "a long, b long, n long"), "found")
    counts = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
    roots = components(found.where("b is not null").select("a", "b"))
    classes = blocks.select("first", "ids", "n").mapInArrow(_singles, "number long, id long, n long")
    copies = packed.where("label is null").select("copies", "owners").mapInArrow(_copies, "vec_id long, number long")
    members = classes.select(F.col("id").alias("vec_id"), "id", "n").union(
        copies.join(classes, "number").select("vec_id", "id", "n")
    ).union(copies.where("number < 0").select("vec_id", F.lit(None), F.lit(None)))
    known = members.join(counts, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left").select(
        "vec_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "id").alias("component_id")
    )
    out = known.groupBy("vec_id").agg(
        F.coalesce(F.max("n_links"), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.min("component_id"), F.first("vec_id")).cast("long").alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
