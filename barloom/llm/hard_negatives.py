"""Hard-negative mining: exact scores of anchors against blocks of rows by Kronecker-packed products."""

import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.ship import ship
from barloom.session import work_table

#: Anchors and rows of a block; every block of anchors meets every block of rows it needs in a task of its own.
ANCHORS, ROWS = 8192, 4096
#: Integers up to this size are handled as long, larger ones as Python's.
SMALL = 1 << 53


def whole_numbers(vectors: Iterable[np.ndarray], scale: float) -> list[np.ndarray]:
    """floor(scale * x) of every component, exact: as long where all of a vector are small, else as Python integers."""
    out = []
    for vector in vectors:
        with np.errstate(over="ignore"):
            scaled = np.floor(np.asarray(vector, np.float64) * scale)
        if len(scaled) and np.abs(scaled).max() > SMALL:
            # beyond 2^53 a double is a whole number; a product beyond all doubles is taken of that number
            exact = lambda x: math.floor(x * scale) if math.isfinite(x * scale) else int(x) * int(scale)
            out.append(np.array([exact(x) for x in np.asarray(vector).tolist()], object))
        else:
            out.append(scaled.astype(np.int64))
    return out


def matrix(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """The vectors as rows; components that a vector lacks are 0."""
    kind = object if any(v.dtype == object for v in vectors) else np.int64
    out = np.zeros((len(vectors), width), kind)
    for row, vector in zip(out, vectors):
        row[: len(vector)] = vector
    return out


class Packed:
    """Rows packed for products: for each component one wide integer, with a field of ``size`` bytes for every row.

    Components are biased to be no less than 0. ``reach`` bounds what an anchor's product can come to in a field, to
    either side of 0; it is added at the end, so that no field borrows from its neighbour.
    """

    def __init__(self, rows: np.ndarray, longest: int):
        """``longest`` is the largest sum of the sizes of an anchor's components."""
        self.n = len(rows)
        self.bias = max(0, -int(rows.min(initial=0)))
        biased = rows + self.bias
        self.reach = longest * max(int(biased.max(initial=0)), 1)
        self.size = max(1, -(-(2 * self.reach).bit_length() // 8))
        self.fields = [self._pack(biased[:, d]) for d in range(rows.shape[1])]
        self.offset = self.reach * int.from_bytes((1).to_bytes(self.size, "little") * self.n, "little")

    def _pack(self, column: np.ndarray) -> int:
        if column.dtype == object:
            return int.from_bytes(b"".join(int(x).to_bytes(self.size, "little") for x in column), "little")
        raw = np.zeros((self.n, max(self.size, 8)), np.uint8)
        raw[:, :8] = np.ascontiguousarray(column, "<i8").view(np.uint8).reshape(-1, 8)
        return int.from_bytes(raw[:, : self.size].tobytes(), "little")

    def scores(self, anchor: list[int]) -> np.ndarray:
        """Inner products with all rows: one multiplication for each component of the anchor."""
        total = self.offset
        for weight, packed in zip(anchor, self.fields):
            if weight:
                total += weight * packed
        raw, size = total.to_bytes(self.n * self.size, "little"), self.size
        less = self.reach + self.bias * sum(anchor)
        if size < 8 and less < 1 << 62:
            padded = np.zeros((self.n, 8), np.uint8)
            padded[:, :size] = np.frombuffer(raw, np.uint8).reshape(-1, size)
            return padded.view("<i8").ravel() - less
        return np.array([int.from_bytes(raw[i : i + size], "little") - less for i in range(0, len(raw), size)], object)


def falling(scores: np.ndarray) -> np.ndarray:
    """Places by falling score, equal ones by place."""
    bits = len(scores).bit_length()
    if scores.dtype != object and len(scores) and np.abs(scores).max() < 1 << (62 - bits):
        back = len(scores) - 1 - np.arange(len(scores))
        return len(scores) - 1 - (np.sort((scores << bits) | back)[::-1] & ((1 << bits) - 1))
    return np.argsort(-scores, kind="stable")


def _blocks(anchors: pa.Table, rows: pa.Table, scale: int):
    """For each anchor of a block its place in the table and its scores, and ids and labels of the rows, by ascending id."""
    rows = rows.sort_by("id").combine_chunks()
    asked = whole_numbers(anchors.column("vector").to_pandas(), scale)
    there = whole_numbers(rows.column("vector").to_pandas(), scale)
    width = max(map(len, asked + there))
    weights = [v.tolist() for v in matrix(asked, width)]
    packed = Packed(matrix(there, width), max(sum(map(abs, w)) for w in weights))
    return rows.column("id").to_numpy(), ((i, packed.scores(w)) for i, w in enumerate(weights))


def _positives(k: int, scale: int):
    schema = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("score", pa.int64())])

    def positives(key: tuple, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if anchors.num_rows and rows.num_rows:
            ids, scored = _blocks(anchors, rows, scale)
            own = anchors.column("id").to_pylist()
            for i, scores in scored:
                at = falling(scores)[: k + 1]
                at = at[ids[at] != own[i]][:k]
                out += zip([own[i]] * len(at), ids[at].tolist(), scores[at].tolist())
        return pa.table({name: pa.array([line[c] for line in out], pa.int64()) for c, name in enumerate(schema.names)})

    return positives


def _negatives(k: int, scale: int, least: int, most: int):
    names = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]

    def negatives(key: tuple, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if anchors.num_rows and rows.num_rows:
            rows = rows.sort_by("id")
            ids, scored = _blocks(anchors, rows, scale)
            kinds = rows.column("kind").combine_chunks().dictionary_encode()
            numbers = {label: n for n, label in enumerate(kinds.dictionary.to_pylist())}
            labels = kinds.indices.to_numpy()
            own, label, wanted = (anchors.column(name).to_pylist() for name in ("id", "label", "positives"))
            for i, scores in scored:
                # 100 * negative between least and most times positive, in whole numbers
                bands = [(p["id"], p["score"], -(-least * p["score"] // 100), most * p["score"] // 100) for p in wanted[i]]
                low, high = min(b[2] for b in bands), max(b[3] for b in bands)
                at = np.flatnonzero((scores >= low) & (scores <= high) & (labels != numbers.get(label[i], -1)))
                at = at[falling(scores[at])]
                down = -scores[at]
                for positive, score, low, high in bands:
                    first = int(np.searchsorted(down, -high))
                    for j in at[first : first + k].tolist():
                        if scores[j] >= low:
                            out.append((own[i], positive, int(ids[j]), score, int(scores[j])))
        return pa.table({name: pa.array([line[c] for line in out], pa.int64()) for c, name in enumerate(names)})

    return negatives


def _best(found: DataFrame, k: int, keys: list[str], score: str, id: str) -> DataFrame:
    """The k best rows of each group; Spark drops what cannot be among them in each task before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), id)
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def _side(label: str) -> list:
    """Columns of one side of a cogroup under names of its own."""
    return [F.col("id").alias("id"), F.col("label").alias(label), F.col("vector").alias("vector")]


def _place(blocks) -> F.Column:
    return F.pmod(F.xxhash64("id"), blocks).cast("int")


def _every(blocks) -> F.Column:
    return F.explode(F.sequence(F.lit(0), blocks - 1))


def hard_negatives(
    vectors: DataFrame, anchors: str = "id % 50 = 0", positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95,
    scale: int = 256, id: str = "vec_id", vector: str = "embedding", label: str = "label", rows: int = ROWS,
    anchors_at_once: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and each of its
    ``positives`` best rows of the same label: the ``negatives`` best rows of other labels whose score is from ``least``
    to ``most`` percent of the positive's. ``anchors`` is a condition on the column ``id``.

    A score is the inner product of floor(``scale`` * x) of the components, exact whatever their size; ties go to the
    smaller id. Rows are taken in blocks. Each component of a block is one wide integer with a biased field for every
    row, so that one multiplication for each component of an anchor gives its products with the whole block, and the sum
    unpacks into exact scores. Positives are looked for among the blocks of their label, which is cut into as many as its
    rows need; negatives among blocks of all rows. The best of each block are merged.

    Rows with a null id, a null label, a null vector, or a null or non-finite component take no part. A component that
    a shorter vector lacks is 0, so an empty vector has the score 0. Of rows that share an id the least by label and
    vector is taken. Fewer rows than asked for give all there are; no positives, or none with a score above 0 and
    negatives within its bounds, give no rows, as does an empty table. A score to be returned that no long can hold fails the job.
    """
    ship(vectors.sparkSession)
    table = vectors.select(
        F.col(id).cast("long").alias("id"), F.col(label).cast("string").alias("label"),
        F.transform(vector, lambda x: x.cast("double")).alias("vector"),
    )
    sound = "id is not null and label is not null and vector is not null and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    table = table.where(sound).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"))
    table = work_table(table.select("id", "row.*").withColumn("anchor", F.coalesce(F.expr(anchors), F.lit(False))), "negatives-rows")
    asked = table.where("anchor").drop("anchor")
    there = table.drop("anchor")

    ceil = lambda n, most: F.greatest(F.ceil(n / most), F.lit(1)).cast("int")
    sizes = table.groupBy("label").agg(
        ceil(F.count_if("anchor"), anchors_at_once).alias("ab"), ceil(F.count("*"), rows).alias("rb"), F.count_if("anchor").alias("n")
    )
    sizes = work_table(sizes.where("n > 0").drop("n"), "negatives-sizes")
    left = asked.join(sizes, "label").select(*_side("label"), _place(F.col("ab")).alias("i"), _every(F.col("rb")).alias("j"))
    right = there.join(sizes, "label").select(*_side("kind"), _place(F.col("rb")).alias("y"), _every(F.col("ab")).alias("x"))
    near = left.groupBy("label", "i", "j").cogroup(right.groupBy("kind", "x", "y")).applyInArrow(
        _positives(positives, scale), "anchor_id long, positive_id long, score long"
    )
    near = _best(near, positives, ["anchor_id"], "score", "positive_id")
    near = near.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), "score")).alias("positives"))
    asked = work_table(asked.join(near, "id"), "negatives-anchors")

    n_rows, n_asked = table.count(), asked.count()
    rb, ab = F.lit(max(1, -(-n_rows // rows))), F.lit(max(1, -(-n_asked // anchors_at_once)))
    left = asked.select(*_side("label"), "positives", _place(ab).alias("i"), _every(rb).alias("j"))
    right = there.select(*_side("kind"), _place(rb).alias("y"), _every(ab).alias("x"))
    far = left.groupBy("i", "j").cogroup(right.groupBy("x", "y")).applyInArrow(
        _negatives(negatives, scale, least, most),
        "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long",
    )
    far = _best(far, negatives, ["anchor_id", "positive_id"], "negative_score", "negative_id")
    return far.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
