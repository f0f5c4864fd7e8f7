"""Hard negatives, shards and whitening against brute force."""

import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from barloom.llm import sharding, whitening
from barloom.llm.hard_negatives import Packed, falling, hard_negatives
from barloom.llm.queries import QUERIES
from barloom.llm.queries_sql import SQL

SF = "/root/testdata/sf0.01"
NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<double>, label int, anchor string, positives int, i int"


def whole(vector):
    if vector is None or not all(x is not None and math.isfinite(x) for x in vector):
        return None
    return [int(x) * 256 if abs(x) > 2**60 else math.floor(256 * x) for x in vector]


def mined(rows, k=5, m=3):
    fine = {}
    for i, v, g in sorted((r for r in rows if r[0] is not None and r[2] is not None and whole(r[1]) is not None), key=lambda r: (r[0], str(r[2]), r[1])):
        fine.setdefault(i, (whole(v), g))
    out = []
    for a, (x, g) in fine.items():
        if a % 50:
            continue
        scores = sorted((-sum(p * q for p, q in zip(x, y)), i, h) for i, (y, h) in fine.items() if i != a)
        for s, p, _ in [line for line in scores if line[2] == g][:k]:
            near = [(n, -t) for t, n, h in scores if h != g and 50 * -s <= 100 * -t <= 95 * -s][:m]
            out += [(a, p, rank + 1, n, -s, t) for rank, (n, t) in enumerate(near)]
    return sorted(out)


def vectors(n=260, size=6):
    random.seed(11)
    centres = [[random.gauss(0, 1) for _ in range(size)] for _ in range(6)]
    rows = [(i * 5, [c + random.gauss(0, 0.5) for c in random.choice(centres)], random.choice([0, 0, 1, 2, None])) for i in range(n)]
    rows += [(3001 + i, rows[3][1], i % 3) for i in range(12)]  # ties
    rows += [(4000, None, 0), (4001, [NAN] * size, 0), (4002, [INF] + [1.0] * 5, 0), (4003, [None] + [1.0] * 5, 0), (None, [1.0] * size, 0)]
    rows += [(4050, [], 1), (4100, [1.0, 2.0], 1), (4150, [0.0] * size, 2), (50, rows[10][1], 2), (50, rows[11][1], 1), (0, rows[0][1], rows[0][2])]
    return rows


@pytest.mark.parametrize("sizes", [(4096, 8192), (16, 4)])
def test_hard_negatives(spark, sizes):
    rows = vectors()
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], VECTORS).repartition(3)
    got = hard_negatives(table, rows=sizes[0], anchors_at_once=sizes[1])
    expected = mined(rows)
    assert sorted(map(tuple, got.collect())) == expected and len(expected) > 50
    assert hard_negatives(table.limit(0)).count() == 0
    assert hard_negatives(table.where("label = 0")).count() == 0  # nothing of another label


def test_hard_negatives_beyond_a_long(spark):
    """Products far beyond a long are compared exactly; the scores of what is returned fit."""
    rows = [(0, [1e18, 1.0, 0.0], 0), (1, [1e-9, 30.0, -1e200], 0), (2, [0.0, 20.0, 3e200], 1), (3, [-1e200, 1.0, 0.0], 1), (4, [0.0, 27.0, 0.0], 1)]
    rows += [(5, [1e290, 0.0, 0.0], 1), (6, [0.0, 0.0, 1e307], 2), (7, [0.0, 28.6, 1.0], 1)]
    got = hard_negatives(spark.createDataFrame([(*r, "", 0, 0) for r in rows], VECTORS))
    assert sorted(map(tuple, got.collect())) == mined(rows) and len(mined(rows)) == 2


def test_packed():
    rng = np.random.default_rng(3)
    for top in (1, 300, 2**20, 2**40, 2**80):
        rows = np.array([[int(x * top) for x in line] for line in rng.uniform(-1, 1, (37, 9))], object if top > 2**62 else np.int64)
        asked = [[int(x * top) for x in line] for line in rng.uniform(-1, 1, (5, 9))]
        packed = Packed(rows, max(sum(map(abs, a)) for a in asked))
        for a in asked:
            scores = packed.scores(a)
            assert scores.tolist() == [sum(x * int(y) for x, y in zip(a, row)) for row in rows]
            assert falling(scores).tolist() == sorted(range(37), key=lambda i: (-scores[i], i))


def test_pack_balances_all_measures():
    rng = np.random.default_rng(4)
    items = rng.exponential(1, (4000, 3)) * [1, 1, 0.2]
    items /= items.sum(0) / 10
    where, loads = sharding.pack(items, 10)
    assert np.allclose(loads, [items[where == s].sum(0) for s in range(10)])
    assert loads[:, 0].max() < 1.005 and loads.max() < 1.05 and loads.min() > 0.95


@pytest.mark.parametrize("sizes", [(256, 1 << 20), (2, 7)])
def test_shards(spark, docs, rows, empty, sizes):
    grain, part_rows = sizes
    hot = [(10_000 + i, "one line that a third of all rows have") for i in range(600)]
    more = spark.createDataFrame([(*r, None, None, None, None, None, None) for r in hot], docs.schema)
    both = docs.unionByName(more)
    found = sharding.shard(both, 4, grain=grain, part_rows=part_rows).collect()
    everything = rows + [(None, "no id")] + hot
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in everything
    )
    slots, homes = defaultdict(list), defaultdict(set)
    for r in found:
        slots[r.shard].append(r.slot)
        homes[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(4))
    split = zlib.crc32(hot[0][1].encode())
    assert len(homes.pop(split)) > 1 and all(len(h) == 1 for h in homes.values())  # only the hot group is cut
    again = sharding.shard(both.repartition(5), 4, grain=grain, part_rows=part_rows)
    assert sorted(map(str, again.collect())) == sorted(map(str, found))
    assert sharding.shard(empty).count() == 0


def test_repeated_rows_have_slots_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 8)
    table = spark.createDataFrame([(1, "a b c")] * 50 + [(2, None), (3, "")], "doc_id long, text string")
    found = sharding.shard(table, 2, part_rows=10).collect()
    assert len(found) == 52 and len({(r.shard, r.slot) for r in found}) == 52
    assert len({r.shard for r in found if r.doc_id == 1}) == 1 and len({r.shard for r in found if r.doc_id != 1}) == 1


def test_written_shards(spark, docs, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(docs.withColumnRenamed("bucket", "shard"), path, 3, grain=4)
    there = spark.read.parquet(path)
    assert there.count() == docs.count() and set(there.columns) == (set(docs.columns) - {"bucket"}) | {"shard"}
    texts = {(r.doc_id, r.text, r.shard) for r in there.collect()}
    known = {(r.doc_id, r.size, r.shard) for r in sharding.shard(docs, 3, grain=4).collect()}
    assert {(i, len((t or "").encode()) + 16, int(s)) for i, t, s in texts} == known


def test_factors():
    rng = np.random.default_rng(5)
    for size, rank in ((1, 1), (5, 5), (12, 7), (33, 33), (8, 0)):
        basis = rng.normal(size=(size, rank)) * 10.0 ** rng.uniform(-3, 3, rank)
        matrix = basis @ basis.T
        factor = whitening.pivoted_cholesky(matrix)
        assert factor.shape[1] <= max(rank, 0) or rank == size
        values, vectors_ = whitening.jacobi(factor)
        known = np.sort(np.linalg.eigvalsh(matrix))[::-1][: len(values)]
        assert np.allclose(values, known, rtol=1e-8, atol=1e-12 * max(known.max(initial=0), 1))
        assert np.allclose(vectors_.T @ vectors_, np.eye(len(values)), atol=1e-8)
        assert np.allclose(matrix @ vectors_, vectors_ * values, atol=1e-9 * max(known.max(initial=1), 1))


def whitened_by_numpy(rows, scale, offset, k):
    fine = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(scale * c) + offset for c in v] for _, v in fine], object)
    n, sums = len(x), x.sum(0)
    deviation = ((n * x - sums) ** 2).sum(1).tolist()
    centred = ((n * x - sums) / n).astype(float)
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:k]
    return fine, deviation, centred @ basis[:, order] / np.sqrt(values[order]), values[order] / values.sum(), n


def check_whitened(found, rows, scale, offset, k):
    fine, deviation, points, shares, n = whitened_by_numpy(rows, scale, offset, k)
    assert len(found) == n * k
    by_component = defaultdict(list)
    for r in found:
        by_component[r.component].append((r.vec_id is None, r.vec_id or 0, r.whitened))
        assert r.n == n and r.identity_error < 1e-9 and abs(r.explained / shares[r.component - 1] - 1) < 1e-9
    assert Counter((r.vec_id, r.deviation) for r in found) == Counter({key: c * k for key, c in Counter((i, d) for (i, _), d in zip(fine, deviation)).items()})
    order = sorted(range(n), key=lambda i: (fine[i][0] is None, fine[i][0] or 0, 0))
    for c, have in by_component.items():
        known = points[order, c - 1]
        have = np.array([w for *_, w in sorted(have)])
        sign = np.sign(have @ known)
        assert np.allclose(have, sign * known, atol=1e-8)


def test_whitening(spark):
    rng = np.random.default_rng(6)
    mixing = rng.normal(size=(6, 6)) * [5, 3, 2, 1, 0.5, 0.2]
    rows = [(i, (rng.normal(size=6) @ mixing).tolist()) for i in range(200)]
    rows += [(500, None), (501, [NAN] * 6), (502, [None] + [1.0] * 5), (503, [INF] * 6), (None, [0.5] * 6), (7, rows[7][1])]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, component int").repartition(3)
    check_whitened(whitening.whiten(table, 4, 64, 1_000_000).collect(), rows, 64, 1_000_000, 4)
    check_whitened(whitening.whiten(table, 6, 1000, -(10**12)).collect(), rows, 1000, -(10**12), 6)
    model = whitening.fit(table, 2, 64)
    assert whitening.whiten(table.where("vec_id < 3"), model=model, scale=64).count() == 6
    assert whitening.whiten(table.limit(0)).count() == 0
    assert whitening.whiten(table.where("vec_id = 7")).count() == 0  # equal vectors
    low = spark.createDataFrame([(i, [float(i), 2.0 * i, float(i % 3)]) for i in range(50)], "vec_id long, embedding array<double>")
    assert {r.component for r in whitening.whiten(low).collect()} == {1, 2}
    mixed = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="differ in length"):
        whitening.whiten(mixed)


def test_deviation_beyond_a_long():
    centre = whitening._Centre.of(10**10, [10**10 * 1_000_000 + 7, 5], 1_000_000)
    got = centre.deviation(np.array([[0.0, -1_000_000.0], [3.0, 1e6]]))
    assert got[0] == 7 * 7 + 5 * 5 and got[1] is None
    middle = whitening._Centre.of(10**5, [10**5 * 1_000_000 + 7, 5], 1_000_000)
    z = [(40_000, 3), (0, -2)]
    assert middle.deviation(np.array([[a, b - 1e6] for a, b in z])) == [
        v if (v := (10**5 * a - 7) ** 2 + (10**5 * b - 5) ** 2) < 2**63 else None for a, b in z
    ]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    return connection


@pytest.mark.parametrize("name", ["op9_topk", "op10_vectors", "op11_negatives"])
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    expected = duck.execute(f"select {', '.join(df.columns)} from ({SQL[name]})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(expected) and expected


def test_shard_query(spark):
    found = QUERIES["op12_shards"](spark, SF).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    homes, sizes, slots = defaultdict(set), Counter(), defaultdict(list)
    for r in found:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        homes[texts[r.doc_id]].add(r.shard)
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(found) == len(texts) and set(sizes) == set(range(40)) and all(len(h) == 1 for h in homes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) < 0.04 * sum(sizes.values()) / 40


def test_whitening_query(spark):
    found = QUERIES["op13_whitening"](spark, SF).collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitened(found, rows, 64, 1_000_000, 32)
