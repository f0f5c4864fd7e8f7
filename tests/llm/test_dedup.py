"""Document deduplication against brute force, on whole tables with every odd case."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import minhash, substring, suffix_dedup
from barloom.llm.graph import components
from barloom.session import settings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def groups(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    random.seed(2)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    expected = groups(links, {x for link in links for x in link})
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {n: r for n, r in expected.items() if n in {x for a, b in links if a != b for x in (a, b)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    words = WORD.findall((text or "").translate(LOW))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def test_near_documents(docs, rows):
    sets = {}
    for name, text in rows:
        sets[name] = shingles(text)
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    expected = groups(links, sets)
    got = minhash.near_documents(docs).collect()
    assert len(got) == len(sets)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {
        n: (len(s), expected[n], expected[n] == n) for n, s in sets.items()
    }


def test_near_documents_in_large_groups(spark):
    """Chains of near copies, around a hub that not all of them reach directly."""
    random.seed(4)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(random.randrange(0, 9)):
            words[random.randrange(200)] = f"x{random.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {n: shingles(t) for n, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for block, crowd in ((minhash.BLOCK, minhash.CROWD), (8, minhash.CROWD), (minhash.BLOCK, 4), (8, 2)):
        got = minhash.near_documents(table, block=block, crowd=crowd).collect()
        assert {r.doc_id: r.component_id for r in got} == groups(links, sets)


def test_near_documents_of_repeated_ids(spark):
    """Classes are told apart by their sets, not by ids; texts of one id are linked."""
    prose = lambda seed, n: " ".join(f"{random.Random(seed * 1000 + i).choice('bcdfg')}{i * seed % 89}" for i in range(n))
    texts = {name: prose(seed, 60) for seed, name in enumerate("abcd", 2)}
    near = lambda t, k: " ".join(t.split()[:-k] + [f"z{i}" for i in range(k)])
    rows = [(5, texts["a"]), (5, texts["b"]), (9, near(texts["a"], 3)), (12, near(texts["b"], 4)), (3, texts["c"]), (5, texts["b"])]
    rows += [(20, texts["d"]), (21, texts["d"]), (21, None), (30, ""), (3, near(texts["d"], 2)), (2, prose(99, 60))]
    linked = {5: 5, 9: 5, 12: 5, 3: 3, 20: 3, 21: 3, 30: 30, 2: 2}
    for parts in (1, 3, 7):
        table = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = minhash.near_documents(table).collect()
        assert {r.doc_id: r.component_id for r in got} == linked and len(got) == len(linked)


def test_texts_are_filtered_before_the_shuffle(spark, tmp_path):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    rows.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows").withColumn("mark", F.xxhash64("text"))
    met = rows.where("doc_id % 100 = 0").select("doc_id", "mark", (F.col("doc_id") + 1).alias("rep"), F.lit(2).alias("buckets"))
    met.write.parquet(f"{tmp_path}/met")
    met = spark.read.parquet(f"{tmp_path}/met")
    before = spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.numBits")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        with minhash.filtered(spark, met.count()):
            found = minhash._texts_of(met, rows)
            assert "might_contain" in found._jdf.queryExecution().optimizedPlan().toString()
            assert {r.doc_id: r.text for r in found.collect()} == {i + 1: f"text {i}" for i in range(0, 4000, 100)}
        with minhash.filtered(spark, 10**9):  # more keys than a filter is planned for
            assert minhash._texts_of(met, rows).count() == 40
    assert spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.numBits") == before


def test_parts_of_a_bucket():
    """A pair at the least similarity is in a part together, and is looked at in the first such part alone."""
    random = np.random.default_rng(3)
    for band in range(minhash.BANDS):
        ways = minhash._earlier(band, minhash.PARTS)
        own = set(range(minhash.ROWS * band, minhash.ROWS * (band + 1)))
        assert len(ways) >= 39 and all(own.isdisjoint(range(minhash.PART * p, minhash.PART * (p + 1))) for p in ways)
    equal = random.random((200_000, 39, minhash.PART)) < 0.75
    assert equal.all(2).any(1).sum() >= 199_999


def test_pruning_keeps_what_is_similar():
    needed = minhash.least_matches(0.75)
    random = np.random.default_rng(1)
    chance = 0.75 + 0.25 / 256
    left = np.zeros((20000, 128), np.uint8)
    right = (random.random(left.shape) > chance).astype(np.uint8)
    assert len(minhash.sequential(left, right, needed)[0]) >= 19990
    far = (random.random(left.shape) > 0.3).astype(np.uint8)
    assert len(minhash.sequential(left, far, needed)[0]) == 0


def test_substring(docs, rows):
    words = [(n, WORD.findall(t or "")) for n, t in rows]
    first = {}
    for name, some in words:
        for i in range(len(some) - 12):
            key = tuple(some[i : i + 13])
            first[key] = min(first.get(key, name), name)
    expected = []
    for name, some in words:
        lost = [False] * len(some)
        for i in range(len(some) - 12):
            if first[tuple(some[i : i + 13])] < name:
                lost[i : i + 13] = [True] * 13
        kept = " ".join(w for w, x in zip(some, lost) if not x)
        expected.append((name, len(some), sum(lost), hashlib.sha256(kept.encode()).hexdigest(), kept))
    got = substring.without_repeats(docs).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in got) == sorted(expected)


def test_a_phrase_in_many_documents(spark):
    """Six words that a hundred thousand documents share, with other words around them: no passage repeats."""
    own = F.concat_ws(" ", *[F.concat(F.lit(c), F.col("id").cast("string")) for c in "abcdefghij"])
    more = F.concat_ws(" ", *[F.concat(F.lit(c), F.col("id").cast("string")) for c in "klmnopqrst"])
    table = spark.range(100_000).select(F.col("id").alias("doc_id"), F.concat(own, F.lit(" all rights of this text reserved "), more).alias("text"))
    assert substring.without_repeats(table).where("n_removed > 0").count() == 0


@pytest.mark.parametrize("length", [200, 20])
def test_suffixes(docs, rows, length):
    rows = [(n, (t or "").encode()) for n, t in rows]
    count = {}
    for _, data in rows:
        for i in range(len(data) - length + 1):
            count[data[i : i + length]] = count.get(data[i : i + length], 0) + 1
    expected = []
    for name, data in rows:
        lost = [False] * len(data)
        for i in range(len(data) - length + 1):
            if count[data[i : i + length]] > 1:
                lost[i : i + length] = [True] * length
        kept = bytes(b for b, x in zip(data, lost) if not x)
        n_spans = sum(x and not (i and lost[i - 1]) for i, x in enumerate(lost))
        expected.append((name, len(data), sum(lost), n_spans, hashlib.sha256(kept).hexdigest()))
    got = suffix_dedup.without_repeats(docs, length=length, seed=64 if length == 200 else 8).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(expected)


def test_merge_of_front_coded_runs():
    random.seed(9)
    for runs in (0, 1, 2, 3, 7):
        lists = [sorted((bytes(random.choices(b"ab", k=random.randrange(12))), b"", 0) for _ in range(random.randrange(40))) for _ in range(runs)]
        coded = []
        for some in lists:
            shared, rest = suffix_dedup.front_coded([s[0] for s in some])
            assert [s[0][k:] for s, k in zip(some, shared)] == rest
            coded.append(iter([(int(k), *s) for k, s in zip(shared, some)]))
        got = list(suffix_dedup.merge(coded))
        assert [g[1] for g in got] == sorted(s[0] for some in lists for s in some)
        for before, after in zip(got, got[1:]):
            assert after[0] == suffix_dedup.common_prefix(before[1], after[1])


def test_empty_tables(empty):
    assert minhash.near_documents(empty).count() == 0
    assert substring.without_repeats(empty).count() == 0
    assert suffix_dedup.without_repeats(empty).count() == 0
