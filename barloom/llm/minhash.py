"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian pruning, exact verification."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.graph import components
from barloom.llm.ship import ship
from barloom.llm.units import LOWER_VALUES, SMALL, mix, prefix, runs, slices, spans, words
from barloom.session import settings, work_table

#: Words of a shingle; rows of a band and bands. At the similarity 0.75 a pair shares no band with a chance of 5e-6.
SHINGLE, ROWS, BANDS = 5, 4, 32
#: Hashes compared between two looks at the posterior, and its bound below which a pair is dropped.
BATCH, MISS = 16, 1e-6
#: A bucket with more members is dealt into parts by further hashes; blocks of a bucket or part are compared with one another.
CROWD, BLOCK = 4096, 256
#: Hashes that members of a part share besides their band, and how many such groups a signature has. A pair at the
#: similarity 0.75 is in no part together with a chance of 3e-10: the groups, two at most, that meet its band's hashes do not count.
PART = 3
PARTS = ROWS * BANDS // PART
#: Numbers from here on are those of classes without an id of their own.
OWN = 1 << 62
#: Documents that one task verifies against one other.
CHUNK = 64
#: Bits for each key of the Bloom filter that keeps other texts out of a shuffle, and the most bits and keys Spark plans one for.
KEY_BITS, MOST_BITS, MOST_KEYS = 10, 1 << 26, 4_000_000

_random = np.random.default_rng(5)
FACTORS = _random.integers(1, 2**63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BAND_SALT = _random.integers(1, 2**63, BANDS, dtype=np.uint64)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text: runs of five lower-cased words, or all words if there are fewer."""
    for part in slices(column, SMALL):
        found = words(part)
        hashes = spans(prefix(part.data, LOWER_VALUES), found.starts, found.ends)
        whole = runs(hashes, SHINGLE)
        for a, b in zip(found.of[:-1].tolist(), found.of[1:].tolist()):
            if b - a >= SHINGLE:
                yield np.unique(whole[a : b - SHINGLE + 1])
            elif b > a:  # fewer words: one shingle of its own length
                yield mix(runs(hashes[a:b], b - a) + np.uint64(b - a))
            else:
                yield whole[:0]


def signature(shingles: np.ndarray) -> np.ndarray:
    """Least value of the set under each hash function."""
    out = np.full(len(FACTORS), np.iinfo(np.uint64).max)
    for first in range(0, len(shingles), 2048):
        some = shingles[first : first + 2048, None] * FACTORS
        np.minimum(out, some.min(axis=0), out=out)
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    keys = BAND_SALT.copy()
    for row in range(ROWS):
        keys = mix(keys + low[row::ROWS])
    return keys


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, marks, sizes, digests, keys, small = batch.column(0), batch.column(2), [], [], [], []
        for shingles in shingle_sets(batch.column(1)):
            low = signature(shingles)
            sizes.append(len(shingles))
            with np.errstate(over="ignore"):  # two sums over the set, each under a mixing of its own
                digests.append(np.array([mix(shingles).sum(), mix(shingles ^ FACTORS[0]).sum()], np.uint64).tobytes())
            keys.append(band_keys(low).view(np.int64))
            small.append(mix(low).astype(np.uint8).tobytes())
        lists = pa.ListArray.from_arrays(
            np.arange(0, BANDS * len(keys) + 1, BANDS, dtype=np.int32), np.concatenate(keys) if keys else np.zeros(0, np.int64)
        )
        yield pa.RecordBatch.from_arrays(
            [ids, marks, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), lists, pa.array(small, pa.binary())],
            names=["doc_id", "mark", "n", "digest", "keys", "small"],
        )


def least_matches(similarity: float, miss: float = MISS) -> list[int]:
    """For each multiple of BATCH hashes compared: with fewer matches than this, the posterior chance that the pair
    reaches ``similarity`` is below ``miss``. Hashes are cut to a byte, so unequal ones match once in 256; the prior of
    the similarity is even."""
    s = (np.arange(4000) + 0.5) / 4000
    match = s + (1 - s) / 256
    out = []
    for n in range(BATCH, len(FACTORS) + 1, BATCH):
        for m in range(n + 1):
            log = m * np.log(match) + (n - m) * np.log1p(-match + 1e-12)
            weight = np.exp(log - log.max())
            if weight[s >= similarity].sum() / weight.sum() >= miss:
                break
        out.append(m)
    return out


def sequential(left: np.ndarray, right: np.ndarray, needed: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two tables of signatures that survive every look, and their matches."""
    at, matches = np.arange(len(left)), np.zeros(len(left), np.int64)
    for step, least in enumerate(needed):
        cut = slice(step * BATCH, (step + 1) * BATCH)
        matches = matches + (left[at, cut] == right[at, cut]).sum(1)
        alive = matches >= least
        at, matches = at[alive], matches[alive]
    return at, matches


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _prune(similarity: float):
    needed = least_matches(similarity)

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, matches = sequential(_bytes(batch.column(2)), _bytes(batch.column(3)), needed)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(matches)], names=["a", "b", "m"])

    return prune


def _earlier(band: int, part: int) -> list[int]:
    """The groups of hashes before ``part`` that deal out a bucket of ``band``; those that meet its own hashes do not."""
    return [p for p in range(part) if PART * p + PART <= ROWS * band or PART * p >= ROWS * (band + 1)]


def _dealt(key: str = "key", band: str = "band", small: str = "small"):
    """(part, key of the part) for each part of a bucket that a signature is in; the same groups as :func:`_earlier`."""
    fits = f"{PART} * p + {PART} <= {ROWS} * {band} or {PART} * p >= {ROWS} * ({band} + 1)"
    own = f"named_struct('part', p, 'key', xxhash64({key}, p, substring({small}, {PART} * p + 1, {PART})))"
    return F.expr(f"transform(filter(sequence(0, {PARTS - 1}), p -> {fits}), p -> {own})")


def _candidates(table: pa.Table, low: int, high: int, similarity: float, needed: list[int]) -> Iterator[tuple]:
    """(i, others, matches): places of rows of block ``low`` and the rows of block ``high`` that stay candidates for
    them: another component, sizes within the ratio that the similarity implies, and not dropped at any look. Pairs
    that are together in several parts of a bucket are candidates in the first one."""
    sizes, roots, block = (table.column(name).to_numpy() for name in ("n", "root", "block"))
    small = _bytes(table.column("small").combine_chunks())
    part = table.column("part")[0].as_py() if table.num_rows else -1
    earlier = _earlier(table.column("band")[0].as_py(), part) if part > 0 else []
    groups = small[:, : PART * PARTS].reshape(-1, PARTS, PART)[:, earlier]
    right = np.flatnonzero(block == high)
    for i in np.flatnonzero(block == low):
        fits = np.minimum(sizes[right], sizes[i]) >= similarity * np.maximum(sizes[right], sizes[i])
        other = right[(roots[right] != roots[i]) & fits]
        if low == high:
            other = other[other > i]
        if len(other):
            at, matches = sequential(np.broadcast_to(small[i], (len(other), small.shape[1])), small[other], needed)
            if earlier and len(at):
                first = ~(groups[other[at]] == groups[i]).all(2).any(1)
                at, matches = at[first], matches[first]
            if len(at):
                yield i, other[at], matches


def _involved(similarity: float):
    """Rows of two blocks of one bucket that have a candidate in the other one."""
    needed = least_matches(similarity)

    def involved(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        seen = np.zeros(table.num_rows, bool)
        for i, others, _ in _candidates(table, key[1].as_py(), key[2].as_py(), similarity, needed):
            seen[i] = True
            seen[others] = True
        return table.filter(pa.array(seen))

    return involved


def _settle(similarity: float):
    """Links between two blocks of one bucket: candidates by falling matches, each verified on the full sets unless the
    two are connected by then."""
    needed, percent = least_matches(similarity), round(similarity * 100)

    def settle(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        found = [(np.full(len(o), i), o, m) for i, o, m in _candidates(table, key[1].as_py(), key[2].as_py(), similarity, needed)]
        ids, roots = table.column("rep").to_numpy(), table.column("root").to_numpy()
        links, above = [], {root: root for root in roots.tolist()}
        if found:
            x, y, m = (np.concatenate(z) for z in zip(*found))
            sets = [np.frombuffer(s.as_py(), np.uint64) for s in table.column("shingles")]
            for at in np.argsort(-m, kind="stable"):
                i, j = int(x[at]), int(y[at])
                a, b = int(roots[i]), int(roots[j])
                while above[a] != a:
                    a = above[a]
                while above[b] != b:
                    b = above[b]
                if a != b and _similar(sets[i], sets[j], percent):
                    above[max(a, b)] = min(a, b)
                    links.append((int(ids[i]), int(ids[j])))
        return pa.table({c: pa.array([link[k] for link in links], pa.int64()) for k, c in enumerate("ab")})

    return settle


def _similar(own: np.ndarray, other: np.ndarray, percent: int) -> bool:
    at = np.searchsorted(own, other)
    shared = int((own[np.minimum(at, len(own) - 1)] == other).sum()) if len(own) else 0
    return shared > 0 and 100 * shared >= percent * (len(own) + len(other) - shared)


def _packed(names: list[str]):
    """The named columns, and the text that follows them as its packed set of shingles."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                sets = pa.array([s.tobytes() for s in shingle_sets(part.column(len(names)))], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], sets], names=[*names, "shingles"])

    return packed


def _verify_chunk(similarity: float):
    percent = round(similarity * 100)

    def verify(key: tuple, table: pa.Table) -> pa.Table:
        hub, docs = key[0].as_py(), table.column("doc").to_numpy()
        place = int(np.flatnonzero(docs == hub)[0])
        sets = table.column("shingles")
        own = np.frombuffer(sets[place].as_py(), np.uint64)
        linked = []
        for i, doc in enumerate(docs.tolist()):
            if doc != hub and _similar(own, np.frombuffer(sets[i].as_py(), np.uint64), percent):
                linked.append(doc)
        return pa.table({"a": pa.array([hub] * len(linked), pa.int64()), "b": pa.array(linked, pa.int64())})

    return verify


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that reach the similarity on their full sets. The documents that share an ``a`` come in chunks,
    each with a copy of it, so that a document with very many partners is spread over tasks."""
    count = pairs.groupBy(F.col("a").alias("hub")).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    spread = pairs.withColumnRenamed("a", "hub").join(count, "hub")
    members = spread.select(F.col("b").alias("doc"), "hub", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int").alias("chunk"))
    hubs = members.select(F.col("hub").alias("doc"), "hub", "chunk").distinct()
    needs = work_table(members.union(hubs), "needs")
    sets = texts.join(needs, texts.doc_id == needs.doc).select("doc", "hub", "chunk", "text")
    sets = sets.mapInArrow(_packed(["doc", "hub", "chunk"]), "doc long, hub long, chunk int, shingles binary")
    return work_table(sets.groupBy("hub", "chunk").applyInArrow(_verify_chunk(similarity), "a long, b long"), "linked")


def filtered(spark: SparkSession, keys: int):
    """Inside the block Spark makes a Bloom filter of the side of a shuffled join that has a condition, here of so many
    ``keys``, and drops rows of the other side by it before they are shuffled. The join decides; more keys than
    MOST_KEYS let more rows through to it."""
    prefix = "spark__sql__optimizer__runtime__bloomFilter__"
    values = {
        "enabled": "true", "applicationSideScanSizeThreshold": "0", "creationSideThreshold": str(1 << 40),
        "expectedNumItems": min(max(keys, 1), MOST_KEYS), "numBits": min(max(KEY_BITS * keys, 1 << 10), MOST_BITS),
    }
    return settings(spark, **{prefix + name: value for name, value in values.items()})


def _texts_of(met: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, text): the text of each class (doc_id, mark, rep, buckets) under the number of its class."""
    found = rows.join(met.where("buckets > 0"), ["doc_id", "mark"])
    return found.select(F.col("rep").alias("doc_id"), "text").dropDuplicates(["doc_id"])


def _best(pairs: DataFrame, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("m"), "a", "b")
    return pairs.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def _classes(table: DataFrame) -> DataFrame:
    """(digest, n, doc_id, mark, rep): each class of equal sets, its least row by id and mark of the text, and a number.

    The number is the least id, unless that is the least of several classes, as an id with different texts can be:
    then the first class by digest has it, and the others numbers of their own above all ids.
    """
    low = F.min(F.struct("doc_id", "mark")).alias("low")
    classes = table.where("n > 0").groupBy("digest", "n").agg(low).select("digest", "n", "low.*")
    classes = work_table(classes, "classes")
    shared = classes.groupBy("doc_id").agg(F.count("*").alias("classes"), F.min(F.struct("digest", "n")).alias("first"))
    shared = shared.where("classes > 1").select("doc_id", "first")
    own = F.xxhash64("digest", "n").bitwiseAND(F.lit(OWN - 1)).bitwiseOR(F.lit(OWN))
    other = F.col("first").isNotNull() & (F.col("first") != F.struct("digest", "n"))
    return work_table(
        classes.join(shared, "doc_id", "left").withColumn("rep", F.when(other, own).otherwise(F.col("doc_id"))).drop("first"), "reps"
    )


def near_documents(
    docs: DataFrame, similarity: float = 0.75, id: str = "doc_id", text: str = "text", block: int = BLOCK, crowd: int = CROWD
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each document; links are pairs whose sets of shingles have a
    Jaccard similarity of ``similarity`` or more.

    Documents with equal sets form a class and are compared once. Classes that share a band are candidates; each
    look at BATCH more hashes drops those whose posterior chance of reaching the similarity fell below MISS, and the
    survivors are compared on their full sets. To connect large groups without all their pairs, each member of a
    bucket is first held against the least one of its bucket; what is connected then needs no further comparison,
    and only members of different components of a bucket are compared, in blocks of ``block`` members, where the likeliest
    pairs come first and what they connect is left out. Buckets of more than ``crowd`` members are dealt into parts by
    three further hashes at a time before that, some forty ways; a pair that is in one of them together is compared, so
    a pair at 0.75 that shares a band is lost there with a chance below 1e-9.

    Null and empty texts, or texts of white space, have no shingles: n_shingles 0, a component of their own. Rows of
    a null id are left out. An id on several rows gives one row: its texts count as linked, n_shingles is the largest;
    such ids must be below 2^62.
    """
    spark = ship(docs.sparkSession)
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("doc_id is not null")
    rows = rows.withColumn("mark", F.xxhash64("text"))
    kinds = "doc_id long, mark long, n long, digest binary, keys array<long>, small binary"
    table = work_table(rows.mapInArrow(_sketches, kinds), "sketches")
    classes = _classes(table)
    copies = table.select("doc_id", "n", "digest").join(classes.select("digest", "n", "rep"), ["digest", "n"], "left")
    copies = work_table(copies.select("doc_id", "n", "rep"), "copies")
    least = classes.select("digest", "n", "doc_id", "mark", "rep")
    reps = table.join(least, ["digest", "n", "doc_id", "mark"]).select("rep", "n", "keys", "small").dropDuplicates(["rep"])
    bands = reps.select(F.posexplode("keys").alias("band", "key"), "rep", "n")
    buckets = bands.groupBy("key").agg(F.min("rep").alias("low"), F.count("*").alias("size")).where("size > 1")
    members = work_table(bands.join(buckets, "key"), "members")
    small = reps.select("rep", "n", "small")

    def survivors(pairs: DataFrame) -> DataFrame:
        a = small.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("small").alias("sa"))
        b = small.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("small").alias("sb"))
        both = pairs.join(a, "a").join(b, "b").where(F.least("na", "nb") >= similarity * F.greatest("na", "nb"))
        return both.select("a", "b", "sa", "sb").mapInArrow(_prune(similarity), "a long, b long, m long")

    # 1: each member against the least of its bucket; the best of its partners is verified
    stars = members.where("rep <> low").select(F.col("low").alias("a"), F.col("rep").alias("b")).distinct()
    stars = work_table(survivors(stars), "stars")
    seen = members.groupBy("rep").agg(F.count("*").alias("buckets"))
    met = work_table(classes.join(seen, "rep").select("doc_id", "mark", "rep", "buckets"), "met")
    with filtered(spark, met.count()):
        texts = work_table(_texts_of(met, rows), "texts")
    links = _verified(_best(stars, "b"), texts, similarity)
    roots = work_table(components(links), "roots")

    # 2: members of a bucket that different components hold, in blocks: signatures first, then sets where needed
    held = members.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    mixed = held.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 < r1").select("key")
    held = work_table(held.join(mixed, "key", "left_semi").select("key", "band", "rep", "root", "size"), "held")
    crowded = held.where(F.col("size") > crowd).join(small.select("rep", "small"), "rep")
    # signatures are joined again after parts of one component are gone: they would be most of what is shuffled
    dealt = crowded.select("rep", "root", "band", F.explode(_dealt()).alias("dealt")).select("rep", "root", "band", "dealt.*")
    held = held.where(F.col("size") <= crowd).select("rep", "root", "band", F.lit(-1).alias("part"), "key").union(dealt)
    blocks = held.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"), F.min("root").alias("r0"), F.max("root").alias("r1"))
    held = held.join(blocks.where("r0 < r1").select("key", "blocks"), "key").join(small, "rep")
    held = held.withColumn("block", F.pmod(F.xxhash64("rep", "key"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ["rep", "n", "root", "small", "band", "part", "block"]
    held = held.select("key", *columns, other.alias("o")).select(
        "key", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), *columns
    )
    kinds = "key long, i int, j int, rep long, n long, root long, small binary, band int, part int, block int"
    met = work_table(held.groupBy("key", "i", "j").applyInArrow(_involved(similarity), kinds), "met")
    names = met.columns
    sets = texts.join(met, texts.doc_id == met.rep).select(*names, "text").mapInArrow(_packed(names), f"{kinds}, shingles binary")
    more = sets.groupBy("key", "i", "j").applyInArrow(_settle(similarity), "a long, b long")
    links = work_table(links.union(more), "links")
    roots = work_table(components(links), "roots")

    twice = copies.where("rep is not null").groupBy("doc_id").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where("x < y")
    if not twice.isEmpty():  # an id on rows of different texts joins their classes
        roots = work_table(components(links.union(copies.where("rep is not null").select("doc_id", "rep"))), "roots")
    own = copies.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    out = own.groupBy("doc_id").agg(
        F.max("n").alias("n_shingles"), F.min(F.coalesce("root", "rep", "doc_id")).alias("component_id")
    )
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))
