"""Exact top-k by inner product: term-at-a-time accumulation over all rows, in blocks."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.hard_negatives import matrix, whole_numbers
from barloom.llm.ship import ship

#: Rows of a block of candidates and of queries; score arrays of a task have QUERY_SLICE x CANDIDATES entries.
CANDIDATES, QUERIES, QUERY_SLICE = 8192, 2048, 64


def sound_vectors(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, terms): the vectors in double. Those that are null, or have null, NaN or infinite components, are left
    out; so are rows of a null id. An empty vector has the score 0."""
    table = vectors.select(F.col(id).alias("vec_id"), F.col(vector).cast("array<double>").alias("terms"))
    fine = "forall(terms, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    return table.where(f"vec_id is not null and terms is not null and {fine}")


def _least(line: np.ndarray, k: int):
    """The k-th highest score of a line that has more."""
    if line.dtype == object:
        return sorted(line.tolist(), reverse=True)[k - 1]
    return np.partition(line, len(line) - k)[len(line) - k]


def _scored(k: int, others_only: bool, scale: float):
    def scored(key: tuple, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        width = int(max(queries.asked.map(len).max(), rows.terms.map(len).max()))
        weights, ids = matrix(whole_numbers(rows.terms, scale), width), rows.vec_id.to_numpy()
        order = np.argsort(ids, kind="stable")
        weights, ids = weights[order], ids[order]
        postings = [(at := np.flatnonzero(weights[:, t]), weights[at, t]) for t in range(width)]
        asked, names = matrix(whole_numbers(queries.asked, scale), width), queries.query_id.to_numpy()
        size = lambda x: int(np.abs(x).max(initial=0))
        if width * size(asked) * size(weights) >= 1 << 62:  # no sum of products is cut: Python's integers instead of longs
            weights, asked = weights.astype(object), asked.astype(object)
            postings = [(at, weight.astype(object)) for at, weight in postings]
        found = []
        for first in range(0, len(asked), QUERY_SLICE):
            some, own = asked[first : first + QUERY_SLICE], names[first : first + QUERY_SLICE]
            scores = np.zeros((len(some), len(ids)), asked.dtype)
            for t, (at, weight) in enumerate(postings):
                for q in np.flatnonzero(some[:, t]):
                    if len(at) == len(ids):
                        scores[q] += some[q, t] * weight
                    else:
                        scores[q, at] += some[q, t] * weight
            for q, line in enumerate(scores):
                fine = np.flatnonzero(ids != own[q]) if others_only else np.arange(len(ids))
                if len(fine) > k:
                    least = _least(line[fine], k)
                    above = fine[line[fine] > least]
                    fine = np.concatenate([above, fine[line[fine] == least][: k - len(above)]])  # ids ascend: the smaller ones
                found.append(pd.DataFrame({"query_id": own[q], "vec_id": ids[fine], "score": line[fine].astype(np.int64)}))
        return pd.concat(found)

    return scored


def top_k(queries: DataFrame, rows: DataFrame, k: int = 5, others_only: bool = True, scale: float = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest integer inner product with each query.

    ``queries`` and ``rows`` are (vec_id, terms) as from :func:`sound_vectors`; a term counts as floor(``scale`` * x),
    exact whatever its size, and those that one side lacks as 0.
    Every block of queries meets every block of rows in a task of its own: the postings of each term (dimension) are
    scaled by the query's weight and added into a dense array of scores, of which the k highest are selected; the
    winners of all blocks are merged. Ties go to the smaller vec_id; ``others_only`` leaves a query's own id out.
    Fewer than k rows give all of them, no rows or no queries give none. Of a repeated query id the least row by terms is
    used; a repeated row counts each time. A score to be returned that no long can hold fails the job. Every row
    goes to as many tasks as there are blocks of queries, one for each 2,048 of them.
    """
    ship(rows.sparkSession)
    n_rows, n_queries = rows.count(), queries.count()
    row_blocks, query_blocks = max(1, -(-n_rows // CANDIDATES)), max(1, -(-n_queries // QUERIES))
    place = lambda blocks: F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    asked = queries.groupBy("vec_id").agg(F.min("terms").alias("terms")).select(
        F.col("vec_id").alias("query_id"), F.col("terms").alias("asked"), place(query_blocks).alias("qb"), every(row_blocks).alias("rb")
    )
    there = rows.select("vec_id", "terms", every(query_blocks).alias("qb"), place(row_blocks).alias("rb"))
    found = asked.groupBy("qb", "rb").cogroup(there.groupBy("qb", "rb")).applyInPandas(
        _scored(k, others_only, scale), "query_id long, vec_id long, score long"
    )
    best = lambda *keys: Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    some = found.withColumn("rank", F.row_number().over(best("query_id", "part"))).where(F.col("rank") <= k)
    merged = some.withColumn("rank", F.row_number().over(best("query_id"))).where(F.col("rank") <= k)
    return merged.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
