"""A training-data pipeline over the table `documents`, in five stages, each of them one operator."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import langid, mixing, pieces
from barloom.llm.minhash import near_documents
from barloom.llm.pii import personal_data
from barloom.llm.queries import DIMENSIONS
from barloom.llm.ship import ship
from barloom.session import scratch_path, small_batches

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _ready(spark: SparkSession) -> None:
    """The package on the executors, and Arrow batches of a size that leaves an executor's memory to the stages' own work."""
    ship(spark)
    small_batches(spark)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that others of this table are in: those without letters (`und`) go, and those whose letters
    are not as usual in any of the languages. A missing `lang` is filled in."""
    _ready(spark)
    model = langid.fit(docs.where(~langid.held_out()))
    found = langid.identify(docs.select(*COLUMNS), model, columns=("lang_pred", "lang_score"), known="lang_known")
    found = found.where((F.col("lang_pred") != langid.UNKNOWN) & F.col("lang_known"))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id. Rows of one id give one row, the
    first by text, language, source and length; rows without an id go."""
    _ready(spark)
    kept = near_documents(docs).where("kept").select("doc_id")
    rows = docs.select("doc_id", F.struct(*COLUMNS[1:]).alias("row")).join(kept, "doc_id", "left_semi")
    return rows.groupBy("doc_id").agg(F.min("row").alias("row")).select("doc_id", "row.*")


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their personal data taken out; every document stays."""
    _ready(spark)
    found = personal_data(docs.select(*COLUMNS), columns=("spans", "redacted"))
    return found.withColumn("text", F.col("redacted")).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents whose tokens follow target weights, the flattened shares of these documents."""
    _ready(spark)
    mixed, _ = mixing.mix(docs.select(*COLUMNS), DIMENSIONS, fraction=0.5)
    return mixed.where("mix_selected").select(*COLUMNS)


def segmentation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their best segmentation, its score, and what the second best scores."""
    _ready(spark)
    docs = docs.select(*COLUMNS)
    found = pieces.encode(docs, pieces.counted(docs, pieces.load()), n=2, kept_words=40_000, rows=128)
    way = lambda i: F.get("n_best", F.lit(i))
    return found.select(
        "doc_id", "lang", "source", "n_chars", F.size(way(0).ids).cast("long").alias("n_pieces"), way(0).ids.alias("ids"),
        way(0).score.alias("score"), way(1).score.alias("second_score"), F.equal_null("text", "restored").alias("round_trip"),
    )


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal", personal),
    ("mixture", mixture),
    ("segmentation", segmentation),
]

#: Language models, signatures and segmentations are beyond SQL; tests/llm/test_pipeline.py has the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
