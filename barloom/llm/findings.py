"""Secret scan: candidate strings with features of form, transitions, words and place, judged by a random forest."""

import math

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A candidate: a run of this many characters of keys and encodings. The rest are bounds of the labelled findings, the
#: dictionary and the forest.
SHORTEST = 16
FINDINGS, WORDS, TREES, DEPTH = 8000, 400, 40, 8
CORE = rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}"
SPACE = r"[\x20\x09-\x0D]+"
#: Names that go before a secret: fixed values.
KEYS = "token secret passwd password pwd apikey api_key key auth credential bearer private access"
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789+/_=-"
FEATURES = (
    "length upper lower digit other hex changes distinct entropy transition covered in_path dotted quoted "
    "assigned key_before word_before word_after"
).split()


def candidates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, place, run, word, core, lead, before, before2, after): every run of at least SHORTEST characters of keys
    and encodings in every word of the whole text; ``run`` counts the runs of a word. ``lead`` is what is between the run and
    the one before in its word, with that one; ``word`` is the lead, the run and what follows up to the next one; neighbours
    are those of the word's first and last run. A null or empty text has none; rows that repeat an id are scanned one by
    one. One pass without a shuffle, whatever the text's length."""
    words = F.split(F.col(text), SPACE)
    table = docs.select(F.col(id).alias("doc_id"), words.alias("words")).where(F.col(text).rlike(CORE))
    near = lambda i: F.coalesce(F.get("words", i), F.lit(""))
    found = F.filter(
        F.transform(
            "words", lambda w, i: F.when(
                F.length(w) >= SHORTEST,
                F.struct(
                    i.alias("place"), F.regexp_extract_all(w, F.lit(CORE), F.lit(0)).alias("cores"), F.split(w, CORE, -1).alias("gaps"),
                    near(i - 1).alias("before"), near(i - 2).alias("before2"), near(i + 1).alias("after"),
                ),
            ),
        ),
        lambda x: x.isNotNull() & (F.size(x.cores) > 0),
    )
    # hex letters and digits may fill a whole prose word, so only words of letters alone and without capitals inside
    # are left to the dictionary features; no word is taken out here
    one = table.select("doc_id", F.explode(found).alias("at")).select("doc_id", "at.*")
    runs = F.transform(
        "cores", lambda core, i: F.struct(
            i.alias("run"), core.alias("core"), F.concat(F.coalesce(F.get("cores", i - 1), F.lit("")), F.get("gaps", i)).alias("lead"),
            F.get("gaps", i + 1).alias("tail"), (i == F.size("cores") - 1).alias("last"),
        )
    )
    at = one.select("doc_id", "place", "before", "before2", "after", F.explode(runs).alias("at"))
    first, last = F.col("at.run") == 0, F.col("at.last")
    return at.select(
        "doc_id", F.col("place").cast("long").alias("place"), F.col("at.run").cast("long").alias("run"),
        F.concat("at.lead", "at.core", "at.tail").alias("word"), F.col("at.core").alias("core"), F.col("at.lead").alias("lead"),
        F.when(first, F.col("before")).otherwise("").alias("before"), F.when(first, F.col("before2")).otherwise("").alias("before2"),
        F.when(last, F.col("after")).otherwise("").alias("after"),
    )


def _share(core: Column, kind: str) -> Column:
    return F.regexp_count(core, F.lit(kind)) / F.length(core)


def featured(found: DataFrame, transitions: list[float], dictionary: list[str]) -> DataFrame:
    """The candidates with the columns FEATURES, all of them built-in expressions."""
    core = F.col("core")
    low = F.lower(core)
    chars = F.array_distinct(F.split(core, ""))
    entropy = F.aggregate(
        chars, F.lit(0.0),
        lambda total, c: total + (lambda p: F.when(p > 0, -p * F.log2(p)).otherwise(0.0))(
            (F.length(core) - F.length(F.replace(core, c, F.lit("")))) / F.length(core)
        ),
    )
    table, size = F.array(*[F.lit(x) for x in transitions]), len(ALPHABET) + 1
    code = lambda i: F.instr(F.lit(ALPHABET), F.substring(low, i, F.lit(1)))
    transition = F.aggregate(
        F.sequence(F.lit(1), F.length(core) - 1), F.lit(0.0),
        lambda total, i: total + F.element_at(table, code(i) * size + code(i + 1) + 1),
    ) / (F.length(core) - 1)
    known = "|".join(dictionary) or "(?!)"
    covered = 1 - F.length(F.regexp_replace(low, known, "")) / F.length(low)
    names = KEYS.replace(" ", "|")
    either = F.lower(F.concat_ws(" ", "before2", "before", "lead"))
    plain = lambda word: F.col(word).rlike(r"^[\p{L}]+[.,;:!?]*$").cast("double")
    values = {
        "length": F.length(core).cast("double"),
        "upper": _share(core, "[A-Z]"), "lower": _share(core, "[a-z]"), "digit": _share(core, "[0-9]"),
        "other": _share(core, "[^A-Za-z0-9]"), "hex": core.rlike("^[0-9a-f]+$").cast("double"),
        "changes": F.regexp_count(core, F.lit("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])|[a-z](?=[A-Z])")) / F.length(core),
        "distinct": F.size(chars) / F.least(F.length(core), F.lit(64)),
        "entropy": entropy, "transition": transition, "covered": covered,
        "in_path": F.col("word").rlike("[/\\\\]|://|%[0-9A-F]{2}").cast("double"),
        "dotted": F.col("word").rlike(r"[A-Za-z0-9]\.[A-Za-z0-9]").cast("double"),
        "quoted": F.col("word").rlike("[\"'`]").cast("double"),
        "assigned": F.concat_ws(" ", "before", F.concat("lead", "core")).rlike(rf"[=:]\s*[\"'`]?{CORE}$").cast("double"),
        "key_before": either.rlike(rf"(?:{names})").cast("double"),
        "word_before": plain("before"), "word_after": plain("after"),
    }
    return found.select("*", *[F.coalesce(F.round(values[name], 9), F.lit(0.0)).alias(name) for name in FEATURES])


def weak_labels(found: DataFrame) -> DataFrame:
    """Labelled findings for tables that have none: 1 where the form of an issuer (a fixed prefix and length) or an
    assignment to a secret's name is certain, 0 for words of letters and for paths and addresses; others have no label."""
    core, word = F.col("core"), F.col("word")
    issued = core.rlike("^(?:AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abpr]-|^sk_live_|^AIza[0-9A-Za-z_-]{35}$|^eyJ[A-Za-z0-9_-]+$")
    assigned = F.lower(F.concat_ws(" ", "before2", "before", F.concat("lead", core))).rlike(rf"(?:{KEYS.replace(' ', '|')})[\"']?\s*[=:]\s*[\"']?[a-z0-9+/_=-]{{{SHORTEST},}}$")
    mixed = core.rlike("[0-9]") & core.rlike("[A-Za-z]")
    label = F.when(issued | (assigned & mixed), 1.0).when(core.rlike("^[A-Za-z]+$|^[0-9_=+/-]+$") | word.rlike("://|^/"), 0.0)
    return found.withColumn("label", label).where("label is not null")


class Scanner:
    """A forest with the transitions and the dictionary its features need."""

    def __init__(self, forest: RandomForestClassificationModel | None, transitions: list[float], dictionary: list[str]):
        self.forest, self.transitions, self.dictionary = forest, transitions, dictionary

    def judge(self, found: DataFrame, least: float = 0.5) -> DataFrame:
        """The candidates with ``score``, the forest's share for a secret, and ``secret``: score >= ``least``. Without
        labelled findings to learn from, no candidate is removed: all score 1."""
        if self.forest is None:
            return found.withColumn("score", F.lit(1.0)).withColumn("secret", F.lit(True))
        table = VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(featured(found, self.transitions, self.dictionary))
        judged = self.forest.transform(table)
        score = F.round(F.get(vector_to_array("probability"), F.lit(1)), 6)
        return judged.select(*found.columns, score.alias("score")).withColumn("secret", F.col("score") >= least)


def _sample(labelled: DataFrame) -> DataFrame:
    """At most FINDINGS different findings, half of each label at most, chosen by hash."""
    order = F.xxhash64("core", "word", "before")
    rows = labelled.select("word", "core", "lead", "before", "before2", "after", "label").dropDuplicates(["core", "word", "before"])
    each = [rows.where(F.col("label") == kind).orderBy(order, "word", "before").limit(FINDINGS // 2) for kind in (0.0, 1.0)]
    return each[0].union(each[1])


def statistics(prose: DataFrame) -> tuple[list[float], list[str]]:
    """Logarithms of the transitions between characters in ordinary words, and the dictionary of the WORDS most frequent
    ones, from all rows of a table with a column ``words``, an array. Words are counted by partial aggregates; the driver gets
    the dictionary and a row for each pair of characters."""
    words = prose.select(F.explode("words").alias("w")).select(F.lower("w").alias("w")).where(F.col("w").rlike("^[a-z]{4,12}$"))
    counts = words.groupBy("w").count().persist()
    try:
        top = counts.orderBy(F.desc("count"), "w").limit(WORDS).collect()
        two = F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substring("w", i, F.lit(2)))
        found = counts.select(F.explode(two).alias("two"), "count").groupBy("two").agg(F.sum("count")).collect()
    finally:
        counts.unpersist()
    size = len(ALPHABET) + 1
    pairs = [[1.0] * size for _ in range(size)]
    for two, count in found:
        pairs[ALPHABET.find(two[0]) + 1][ALPHABET.find(two[1]) + 1] += count
    transitions = [math.log(x / sum(line)) for line in pairs for x in line]
    return transitions, sorted((row[0] for row in top), key=lambda w: (-len(w), w))


def train(labelled: DataFrame, prose: DataFrame, seed: int = 3) -> Scanner:
    """A scanner from labelled findings (candidates with ``label`` 0 or 1), of which it takes FINDINGS at most, and a table
    with a column ``words``, an array of ordinary words, of which it counts all (:func:`statistics`)."""
    spark = labelled.sparkSession
    sample = _sample(labelled)
    rows = sample.collect()  # at most FINDINGS rows
    transitions, dictionary = statistics(prose)
    kinds = {row["label"] for row in rows}
    if len(kinds) < 2:
        return Scanner(None, transitions, dictionary)
    found = spark.createDataFrame(rows, sample.schema)
    table = VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(featured(found, transitions, dictionary))
    forest = RandomForestClassifier(featuresCol="_x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=seed)
    return Scanner(forest.fit(table.select("_x", "label")), transitions, dictionary)


def scan(docs: DataFrame, labelled: DataFrame | None = None, least: float = 0.5) -> DataFrame:
    """(doc_id, place, run, word, core, score, secret) for every candidate of every document; ``secret`` tells whether the
    forest keeps it. ``labelled`` are findings with a label; without them, :func:`weak_labels` gives some, from a
    quarter of the documents at most ``FINDINGS``. Ordinary words are counted in all documents."""
    found = candidates(docs)
    prose = docs.select(F.split("text", SPACE).alias("words"))
    if labelled is None:
        part = docs.where(F.pmod(F.xxhash64("doc_id", F.lit("labels")), F.lit(4)) == 0)
        labelled = weak_labels(candidates(part))
    scanner = train(labelled, prose)
    return scanner.judge(found, least).select("doc_id", "place", "run", "word", "core", "score", "secret")
