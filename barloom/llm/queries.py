"""The operators as registered queries: (spark, folder of the tables) -> DataFrame."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import findings, mixing, pieces, sharding, suffix_dedup, whitening
from barloom.llm.hard_negatives import hard_negatives
from barloom.llm.langid import fit, held_out, identify
from barloom.llm.minhash import near_documents
from barloom.llm.pii import digests, personal_data
from barloom.llm.ship import ship
from barloom.llm.substring import without_repeats
from barloom.llm.topk import sound_vectors, top_k
from barloom.llm.vector_dedup import near_vectors


#: What a mix balances; its targets are the flattened shares that the input has. There is no topic in the tables: it is
#: the form of most of a text (a sign between cells for every fifth word, capitals, signs), not a mark that it holds.
#: Characters are counted by the length of what is left of a text: `regexp_count` makes an array of them, a string each.
DIMENSIONS = {
    "source": "source",
    "lang": "lang",
    "topic": (
        r"case when length(regexp_replace(text, '[^|\\t]+', '')) * 5 > "
        r"length(regexp_replace(regexp_replace(text, '[^\\x20\\x09-\\x0D]+', 'w'), '[\\x20\\x09-\\x0D]+', '')) then 'table' "
        r"when length(regexp_replace(text, '\\P{Lu}+', '')) > length(regexp_replace(text, '\\P{Ll}+', '')) then 'shout' "
        r"when length(regexp_replace(text, '[\\p{L}\\p{M}\\p{N}\\s]+', '')) * 5 > length(text) then 'noise' else 'prose' end"
    ),
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without strings of 200 bytes that occur again."""
    docs = _table(spark, sf_dir, "documents")
    return suffix_dedup.without_repeats(docs, length=200, with_bytes=False).drop("kept")


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four best segmentations of every document: their scores, sizes and digests, and whether the text comes back."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pieces.encode(docs, pieces.counted(docs, pieces.load()), n=4)
    ways = lambda line: F.array_join(F.transform("n_best", line), ",")
    return found.select(
        "doc_id", F.size(F.col("n_best")[0].ids).cast("long").alias("n_pieces"), F.col("n_best")[0].score.alias("score"),
        ways(lambda w: w.score.cast("string")).alias("scores"),
        F.transform("n_best", lambda w: F.xxhash64(w.ids)).alias("digests"),
        F.equal_null("text", "restored").alias("round_trip"),
    )


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents."""
    return near_documents(_table(spark, sf_dir, "documents"), similarity=0.75)


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without passages of 13 words that smaller documents have."""
    return without_repeats(_table(spark, sf_dir, "documents"), length=13, with_text=False).drop("kept")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate for a secret in every document, and whether the forest keeps it."""
    found = findings.scan(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "place", "run", F.sha2("core", 256).alias("core_sha256"), "score", "secret")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data of every document."""
    return digests(personal_data(_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, probability and choice of every document in a mix of half of all tokens."""
    mixed, _ = mixing.mix(_table(spark, sf_dir, "documents"), DIMENSIONS, fraction=0.5, keep=["doc_id"])
    return mixed.select(
        "doc_id", "mix_cell.source", "mix_cell.lang", "mix_cell.topic", F.col("mix_tokens").alias("n_tokens"),
        F.round("mix_weight", 9).alias("weight"), F.round("mix_probability", 9).alias("probability"),
        F.col("mix_selected").alias("selected"),
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, from a model of the documents that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best partners of every vector whose id is divisible by 50."""
    rows = sound_vectors(_table(spark, sf_dir, "embeddings"))
    return top_k(rows.where("vec_id % 50 = 0"), rows, k=5)


def op10_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of each label."""
    return near_vectors(_table(spark, sf_dir, "embeddings"), least=0.93)


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 50, for each of its five positives."""
    table = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table.withColumn("label", moved), "id % 50 = 0", positives=5, negatives=3, least=50, most=95)


def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, 40 shards of nearly equal sizes."""
    found = sharding.shard(_table(spark, sf_dir, "documents"), shards=40)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens",
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 whitened components of every vector."""
    table = _table(spark, sf_dir, "embeddings")
    return whitening.whiten(table, components=32, scale=64, offset=1_000_000)


QUERIES = {
    "op1_suffixes": op1_suffixes,
    "op2_pieces": op2_pieces,
    "op3_minhash": op3_minhash,
    "op4_substring": op4_substring,
    "op5_secrets": op5_secrets,
    "op6_pii": op6_pii,
    "op7_mixing": op7_mixing,
    "op8_language": op8_language,
    "op9_topk": op9_topk,
    "op10_vectors": op10_vectors,
    "op11_negatives": op11_negatives,
    "op12_shards": op12_shards,
    "op13_whitening": op13_whitening,
}
