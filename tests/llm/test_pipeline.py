"""The pipeline's stages one by one, against what they promise of their input."""

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import pieces, pii
from barloom.llm.minhash import near_documents
from barloom.llm.queries import QUERIES
from barloom.llm.queries_sql import SQL

SF = "/root/testdata/sf0.001"


FOREIGN = ["Это русский текст о погоде и о том, как люди живут в большом городе", "これは日本語の文章です。天気について書かれています。"]


def test_stages(spark, docs, empty):
    table = docs.select("doc_id", "text", "lang", "source", "n_chars", "keys", "rep")
    real = spark.read.parquet(f"{SF}/documents.parquet").withColumn("doc_id", F.col("doc_id") + 10_000)
    foreign = spark.createDataFrame([(50_000 + i, t) for i, t in enumerate(FOREIGN)], "doc_id long, text string")
    table = table.unionByName(foreign, allowMissingColumns=True)
    state = real.unionByName(table, allowMissingColumns=True).cache()
    counts = [state.count()]
    vocabulary = pieces.load()
    for name, stage in corpus_pipeline.STAGES:
        before, state = state, stage(spark, state, SF).cache()
        counts.append(state.count())
        if name != "segmentation":
            assert state.columns == corpus_pipeline.COLUMNS
        if name == "language":
            gone = {r.text for r in before.collect()} - {r.text for r in state.collect()}
            assert {None, "", " \n\t", *FOREIGN} <= gone and len(gone) < 12
            assert not gone & {r.text for r in real.where("lang is not null and length(text) between 40 and 2000").collect()}
            assert state.where("lang is null").count() == 0
        if name == "near_duplicates":
            ids = {r.doc_id for r in state.collect()}
            assert ids == {r.doc_id for r in near_documents(before).where("kept").collect()}
            least = {i: min((r.text, r.source or "") for r in before.collect() if r.doc_id == i)[0] for i in list(ids)[:50]}
            assert all(r.text == least[r.doc_id] for r in state.collect() if r.doc_id in least)
        if name == "personal":
            assert counts[-1] == counts[-2]
            assert not [r for r in state.collect() if any(s[0] in pii.BASE for s in pii.find(r.text))]
        if name == "segmentation":
            have = {r.doc_id: r.text for r in before.collect()}
            assert all(r.round_trip and pieces.decode(r.ids, vocabulary) == have[r.doc_id] for r in state.collect())
        assert stage(spark, empty, SF).count() == 0
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0


def test_stages_hand_texts_over_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    rows = spark.range(0, 2000, 1, 1).selectExpr("id as doc_id", "repeat('words of a text ', 400) as text", "'en' lang", "'s' source", "6400L n_chars")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    before = spark.conf.get(key, None)
    try:
        for name, stage in corpus_pipeline.STAGES:
            spark.conf.unset(key)
            stage(spark, rows, SF)
            have = rows.select("text").mapInArrow(sizes, "n long, size long").collect()
            assert sum(r.n for r in have) == 2000 and max(r.size for r in have) < 3_000_000, name
        spark.conf.set(key, 1_000_000)
        corpus_pipeline.personal(spark, rows, SF)
        assert spark.conf.get(key) == "1000000"  # a session's own size stays
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_names():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14)) and set(SQL) <= set(QUERIES)
