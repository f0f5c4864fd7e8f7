"""Sharding by vector bin packing: groups of equal texts go to shards so that bytes, tokens and rows balance jointly."""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import work_table

#: What is balanced, and how much a measure counts in the dot product: bytes come nearest to equal.
MEASURES, WEIGHTS = ("bytes", "tokens", "rows"), (16.0, 1.0, 1.0)
#: Bytes that each row costs beside its text.
ROW_BYTES = 16
#: Bundles of small groups for each shard, and the part of a shard's share from which on a group is placed by itself.
GRAIN = 256
#: Rows numbered by one task; copies of one row that are numbered together.
PART_ROWS, COPIES = 1 << 20, 4096
#: Words of a text; null has none.
WORDS = r"[^\x20\x09-\x0D]+"


@dataclass
class Plan:
    """Where everything goes: ``split`` has the number of pieces of the groups that exceed a shard, ``single`` the
    groups placed by themselves (both by key), ``places`` the shard of each (key or null, number)."""

    shards: int
    bundles: int
    split: dict[bytes, int]
    places: dict[tuple[bytes | None, int], int]
    loads: np.ndarray


def pack(items: np.ndarray, shards: int, loads: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The shard of each item (a row of its measures, each in shares of what one shard should hold) and the loads.

    Items go from the largest measure down, each to the shard whose residual capacity has the highest weighted dot
    product with it; a shard that is over its capacity in a measure counts against items that have much of it. Ties go
    to the smaller shard, equal items in their order.
    """
    loads = np.zeros((shards, items.shape[1])) if loads is None else loads.copy()
    out = np.zeros(len(items), np.int32)
    weighted = items * np.array(WEIGHTS)[: items.shape[1]]
    for i in np.argsort(-items.max(axis=1, initial=0), kind="stable"):
        out[i] = np.argmax((1.0 - loads) @ weighted[i])
        loads[out[i]] += items[i]
    return out, loads


def measured(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, key, tokens): a row for each row of ``docs``, narrow. Null is an empty text here; the
    key is that of the group of equal texts."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(
        F.col(id).cast("long").alias("doc_id"), (F.octet_length(whole) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"), F.unhex(F.md5(whole.cast("binary"))).alias("key"),
        F.regexp_count(whole, F.lit(WORDS)).cast("long").alias("tokens"),
    )


def _sums() -> list:
    return [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]


def _number(key: str, of) -> F.Column:
    return F.pmod(F.xxhash64(key), of).cast("int")


def _vectors(rows: list, capacity: np.ndarray) -> np.ndarray:
    return np.array([[row[m] or 0 for m in MEASURES] for row in rows], np.float64).reshape(-1, len(MEASURES)) / capacity


def plan(table: DataFrame, shards: int, grain: int = GRAIN) -> Plan:
    """Pack the groups of a table as :func:`measured` makes it.

    A group with more than one ``grain``-th of a shard's share of any measure is an item of its own: by their sums there
    are at most ``3 * shards * grain`` of them, whatever the table. All smaller groups fall by hash into ``shards *
    grain`` bundles, which are items, too. A group of more than a shard's share of a measure (at most three for each
    shard) cannot stay together; its rows fall by their id into pieces of a ``grain``-th. The driver gets the sums of
    these items and packs them.
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    groups = work_table(table.groupBy("key").agg(*_sums()), "shard-groups")
    total = groups.agg(*[F.sum(m).alias(m) for m in MEASURES]).first()
    bundles = shards * grain
    if not total["rows"]:
        return Plan(shards, bundles, {}, {}, np.zeros((shards, len(MEASURES))))
    capacity = np.array([max(total[m], 1) for m in MEASURES], np.float64) / shards
    above = lambda part: F.greatest(*[F.col(m) / F.lit(c) for m, c in zip(MEASURES, capacity.tolist())]) > part
    large = groups.where(above(1.0 / grain)).orderBy("key").collect()
    share = _vectors(large, capacity).max(axis=1, initial=0)
    single = [row for row, most in zip(large, share) if most <= 1]
    split = {bytes(row["key"]): int(np.ceil(most * grain)) for row, most in zip(large, share) if most > 1}
    small = groups.where(~above(1.0 / grain)).groupBy(_number("key", F.lit(bundles)).alias("number"))
    small = small.agg(*[F.sum(m).alias(m) for m in MEASURES]).orderBy("number").collect()
    names = [(bytes(row["key"]), 0) for row in single] + [(None, row["number"]) for row in small]
    items = single + small
    if split:
        spark = table.sparkSession
        pieces = spark.createDataFrame(list(split.items()), "key binary, pieces int")  # at most three for each shard
        cut = table.join(F.broadcast(pieces), "key").groupBy("key", _number("doc_id", F.col("pieces")).alias("number"))
        cut = cut.agg(*_sums()).orderBy("key", "number").collect()
        names += [(bytes(row["key"]), row["number"]) for row in cut]
        items += cut
    where, loads = pack(_vectors(items, capacity), shards)
    return Plan(shards, bundles, split, dict(zip(names, where.tolist())), loads)


def assign(table: DataFrame, packed: Plan) -> DataFrame:
    """``table`` (key, doc_id, ...) with its ``shard``: a look-up without a shuffle. The tables looked up are bounded by
    the numbers of shards and bundles (see :func:`plan`), not by the documents."""
    spark = table.sparkSession
    single = {key: 1 for key, _ in packed.places if key is not None} | packed.split
    pieces = spark.createDataFrame(list(single.items()), "key binary, _pieces int")
    places = [(key, number, shard) for (key, number), shard in packed.places.items()]
    places = spark.createDataFrame(places, "_key binary, _number int, shard int")
    known = table.join(F.broadcast(pieces), "key", "left")
    known = known.withColumn("_key", F.when(F.col("_pieces").isNotNull(), F.col("key")))
    by_id = F.when(F.col("_pieces") > 1, _number("doc_id", F.col("_pieces"))).otherwise(0)
    known = known.withColumn("_number", F.when(F.col("_key").isNull(), _number("key", F.lit(packed.bundles))).otherwise(by_id))
    same = F.equal_null(known["_key"], places["_key"]) & (known["_number"] == places["_number"])
    found = known.join(F.broadcast(places), same, "left")
    return found.select(*[known[c] for c in table.columns], "shard")


def _numbered(rows: DataFrame, part_rows: int) -> DataFrame:
    """Rows with a ``slot`` in their shard, from 0 without gaps. Copies of a row are counted first and dealt out in
    chunks; each part of a shard numbers its own rows after those of the parts before it."""
    names = rows.columns
    counted = rows.groupBy(*names).agg(F.count("*").alias("_n"))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES)))
    chunks = counted.select("*", chunk.alias("_chunk"))
    chunks = chunks.withColumn("_n", F.least(F.col("_n") - F.col("_chunk") * COPIES, F.lit(COPIES)))
    parts = max(1, -(-rows.count() // part_rows))
    place = F.pmod(F.xxhash64("doc_id", "text_crc32", "_chunk"), F.lit(parts)).cast("int")
    chunks = work_table(chunks.withColumn("_part", place), "shard-chunks")
    sums = chunks.groupBy("shard", "_part").agg(F.sum("_n").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = work_table(sums.select("shard", "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")), "shard-starts")
    order = ["doc_id", *[c for c in names if c not in ("doc_id", "shard")], "_chunk"]
    inside = Window.partitionBy("shard", "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(starts, ["shard", "_part"])
    first = F.col("_start") + F.col("_before")
    return chunks.select(*names, F.explode(F.sequence(first, first + F.col("_n") - 1)).alias("slot"))


def shard(
    docs: DataFrame, shards: int = 40, id: str = "doc_id", text: str = "text", grain: int = GRAIN, part_rows: int = PART_ROWS
) -> DataFrame:
    """(doc_id, size, text_crc32, tokens, shard, slot) for every row of ``docs``.

    Rows with equal texts are a group and go to one shard, unless the group has more than one shard should hold of some
    measure: then it is cut by the ids of its rows. Groups are packed as vectors of bytes (the text's and ROW_BYTES for
    each row), tokens (words) and rows: see :func:`plan` and :func:`pack`. A slot is the row's number in its shard.

    A null text counts as an empty one, and all of these are one group. Null ids are an id like others. Rows that repeat
    an id and a text cannot be told apart and go together, however many; each has a slot of its own. A text larger than
    a shard's share fills its shard alone as far as it can. Fewer groups than shards leave shards empty, and an empty
    table gives no rows. The same rows give the same shards and slots in any order.
    """
    table = work_table(measured(docs, id, text), "shard-rows")
    placed = assign(table, plan(table, shards, grain)).drop("key")
    return _numbered(placed, part_rows).select("doc_id", "size", "text_crc32", "tokens", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = 40, id: str = "doc_id", text: str = "text", grain: int = GRAIN) -> None:
    """Write ``docs`` with all columns as Parquet in a directory of each shard (``shard=<n>``), files of one shard by as
    many tasks as there are bundles in it. A column ``shard`` that the documents have is replaced."""
    packed = plan(work_table(measured(docs, id, text), "shard-rows"), shards, grain)
    kept = docs.select(*[c for c in docs.columns if c != "shard"])
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keyed = kept.select(F.unhex(F.md5(whole.cast("binary"))).alias("key"), F.col(id).cast("long").alias("doc_id"), F.struct("*").alias("_row"))
    placed = assign(keyed, packed)
    placed.repartition("shard", F.pmod(F.xxhash64("key", "doc_id"), F.lit(grain))).select("_row.*", "shard").write.partitionBy("shard").parquet(path)
