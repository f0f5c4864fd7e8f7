"""Mix sources to target weights: rake token weights to the marginals, then sample documents accordingly."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.ship import ship
from barloom.llm.units import SMALL, slices, words
from barloom.session import work_table

OTHER = "other"


@dataclass
class Mix:
    """Cells (one value of each dimension, their tokens, the tokens wanted) and the shares that came out."""

    dimensions: list[str]
    cells: list[tuple]
    tokens: np.ndarray
    wanted: np.ndarray

    def share(self, dimension: str) -> dict[str, float]:
        at = self.dimensions.index(dimension)
        values = sorted({cell[at] for cell in self.cells})
        part = {v: self.wanted[[cell[at] == v for cell in self.cells]].sum() for v in values}
        return {v: float(x / max(self.wanted.sum(), 1e-300)) for v, x in part.items()}


def _level(weights: np.ndarray, most: np.ndarray, total: float) -> np.ndarray:
    """The weights times one factor, cut at ``most``, that add up to ``total``; all of ``most`` if that is less."""
    positive = (weights > 0) & (most > 0)
    if total >= most[positive].sum():
        return np.where(positive, most, 0.0)
    out, open_ = np.zeros_like(weights), positive.copy()
    while True:
        rest = total - most[positive & ~open_].sum()
        factor = rest / weights[open_].sum()
        over = open_ & (weights * factor > most)
        if not over.any():
            out[open_] = weights[open_] * factor
            out[positive & ~open_] = most[positive & ~open_]
            return out
        open_ &= ~over


def rake(
    cells: list[tuple], tokens: np.ndarray, targets: list[dict[str, float]], budget: float, rounds: int = 500, close: float = 1e-10
) -> np.ndarray:
    """Tokens wanted of each cell: iterative proportional fitting from the tokens there are. Each round scales the
    cells of every value of every dimension to the value's target; no cell gives more than it has. Where the marginals
    cannot be met together (too few tokens, or none), the last dimension is the nearest to its targets."""
    tokens = np.asarray(tokens, np.float64)
    wanted = tokens * (budget / tokens.sum()) if tokens.sum() else tokens
    steps = []  # for each dimension the cells of every value and the tokens wanted of them
    for d, target in enumerate(targets):
        names = np.array([cell[d] for cell in cells], object)
        order = np.argsort(names, kind="stable")
        cuts = np.flatnonzero(names[order][1:] != names[order][:-1]) + 1 if len(cells) else []
        at = {names[some[0]]: some for some in np.split(order, cuts) if len(some)}
        total = sum(share for value, share in target.items() if value in at and (tokens[at[value]] > 0).any())
        steps.append([(some, budget * target.get(value, 0.0) / total if total > 0 else 0.0) for value, some in at.items()])
    for _ in range(rounds):
        before = wanted.copy()
        for step in steps:
            for at, goal in step:
                # a cell that was cut to what it has may grow again from its start value
                wanted[at] = _level(wanted[at], tokens[at], goal) if goal > 0 else 0.0
        if np.abs(wanted - before).max(initial=0) <= close * max(budget, 1):
            break
    return wanted


def _counts(texts: pa.Array) -> pa.Array:
    counts = [np.diff(words(part).of) for part in slices(texts, SMALL)]
    return pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64), pa.int64())


def n_words(text: str) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of each whole text; null has none. They are counted in Arrow batches: `regexp_count`
    makes an array of all words of a text to take its size, which fills an executor's heap."""
    return F.arrow_udf(_counts, "long")(F.col(text).cast("string"))


def with_cells(docs: DataFrame, dimensions: dict[str, str], targets: dict[str, dict[str, float]], text: str = "text") -> DataFrame:
    """``docs`` with a struct ``_cell`` of the dimensions' values (SQL expressions) and the words ``_tokens`` of the whole text. A value that
    has no target, or null, counts as `other`."""
    return _with_cells(_with_values(docs, dimensions, text), targets)


def _with_cells(raw: DataFrame, targets: dict[str, dict[str, float]] | None, names: list[str] | None = None) -> DataFrame:
    """Values as cells; without targets all values but null stand for themselves."""
    value = lambda name: F.col(f"_raw.`{name}`")
    own = lambda name: F.lit(True) if targets is None else value(name).isin(list(targets[name]))
    cell = [F.coalesce(F.when(own(name), value(name)), F.lit(OTHER)).alias(name) for name in names or targets]
    return raw.withColumn("_cell", F.struct(*cell)).drop("_raw")


def _with_values(docs: DataFrame, dimensions: dict[str, str], text: str) -> DataFrame:
    """``docs`` with a struct ``_raw`` of the dimensions' values as they are, and the words ``_tokens``."""
    raw = F.struct(*[F.expr(sql).cast("string").alias(name) for name, sql in dimensions.items()])
    ship(docs.sparkSession)
    return docs.withColumn("_raw", raw).withColumn("_tokens", n_words(text))


def _counted(raw: DataFrame) -> DataFrame:
    return raw.groupBy("_raw").agg(F.sum("_tokens").alias("_tokens"))


def flattened(
    docs: DataFrame, dimensions: dict[str, str], power: float = 0.5, text: str = "text"
) -> dict[str, dict[str, float]]:
    """Targets from the input itself: each value's share of the tokens, raised to ``power`` and scaled to add up to 1, so
    that rare values count for more than they have and none counts for nothing. Every value stands for itself; null is
    `other`. A value counts one token at least. One pass over the documents; the driver gets the values of each dimension."""
    counted = _counted(_with_values(docs, dimensions, text)).persist()
    try:
        return _flattened(counted, list(dimensions), power)
    finally:
        counted.unpersist()


def _flattened(counted: DataFrame, names: list[str], power: float = 0.5) -> dict[str, dict[str, float]]:
    out = {}
    for name in names:
        value = F.coalesce(F.col(f"_raw.`{name}`"), F.lit(OTHER))
        sums = counted.groupBy(value.alias("value")).agg(F.greatest(F.sum("_tokens"), F.lit(1)).alias("tokens"))
        have = {row["value"]: row["tokens"] for row in sums.collect()}
        total = sum(x**power for x in have.values())
        out[name] = {v: x**power / total for v, x in sorted(have.items())}
    return out


def fit(celled: DataFrame, targets: dict[str, dict[str, float]], fraction: float) -> Mix:
    """Tokens wanted of each cell when ``fraction`` of all tokens is. The cells come to the driver: there are at most as
    many as combinations of the targets' values, whatever the number of documents."""
    names = list(targets)
    rows = celled.groupBy("_cell").agg(F.sum("_tokens").alias("tokens")).collect()
    rows = sorted((tuple(row["_cell"]), row["tokens"]) for row in rows)
    cells, tokens = [row[0] for row in rows], np.array([row[1] for row in rows], np.float64)
    wanted = rake(cells, tokens, [targets[name] for name in names], fraction * tokens.sum())
    return Mix(names, cells, tokens, wanted)


def mix(
    docs: DataFrame, dimensions: dict[str, str], targets: dict[str, dict[str, float]] | None = None, fraction: float = 0.5,
    seed: int = 1, id: str = "doc_id", text: str = "text", keep: list[str] | None = None,
) -> tuple[DataFrame, Mix]:
    """``docs`` with the columns mix_cell, mix_tokens, mix_weight (a token's weight: its cell's share wanted over its
    share there), mix_probability and mix_selected (columns of these names are replaced), and the fitted mix.

    The values and words of each whole text are taken once, into a work table with the columns to ``keep`` (all, if
    not said), which is counted and then joined with the rates of the cells. The driver fits them: it holds a row for
    each combination of values that occurs.

    Without targets, those of :func:`flattened` are taken, from the same counts. The targets give
    each dimension's values their shares of the tokens; `other` may be among them and takes every
    value not listed, null too. Shares of values that have no tokens go to the others in proportion. A document's
    probability is the tokens wanted of its cell over those there are, and a hash of id and seed decides: the choice
    is the same in every run, alike for rows that repeat an id (a null id has a hash too), and documents without words
    are chosen like those of their cell, or with ``fraction`` if it has no words at all and all its values have targets.
    An empty table stays empty.
    """
    added = ("mix_cell", "mix_tokens", "mix_weight", "mix_probability", "mix_selected")
    ship(docs.sparkSession)
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    raw = _with_values(docs.select(*[c for c in docs.columns if c not in added]), dimensions, text)
    raw = work_table(raw.select(*kept, "_raw", "_tokens"), "mix-values")
    counted = work_table(_counted(raw), "mix-counts")  # a row for each combination of values
    own = targets is None
    targets = _flattened(counted, list(dimensions)) if own else targets
    names = list(targets)
    found = fit(_with_cells(counted, None if own else targets, names), targets, fraction)
    celled = _with_cells(raw, None if own else targets, names)
    total, goal = max(found.tokens.sum(), 1.0), max(found.wanted.sum(), 1e-300)
    aimed = lambda cell: all(targets[name].get(value, 0.0) > 0 for name, value in zip(found.dimensions, cell))
    rows = [
        (list(cell), float(w / goal / (t / total)) if t else 0.0, float(w / t) if t else fraction * aimed(cell))
        for cell, t, w in zip(found.cells, found.tokens, found.wanted)
    ]
    spark = docs.sparkSession
    kind = ",".join(f"{name}:string" for name in targets)
    rates = spark.createDataFrame(rows, f"_cell struct<{kind}>, mix_weight double, mix_probability double")
    even = F.shiftrightunsigned(F.xxhash64(F.col(id).cast("string"), F.lit(seed)), 11) / F.lit(float(1 << 53))
    out = celled.join(work_table(rates, "mix-rates"), "_cell", "left")  # broadcast by Spark if its size allows it
    out = out.withColumn("mix_selected", even < F.coalesce("mix_probability", F.lit(0.0)))
    return out.withColumnsRenamed({"_cell": "mix_cell", "_tokens": "mix_tokens"}), found
