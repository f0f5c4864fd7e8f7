"""Operators that treat one text at a time."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import findings, langid, minhash, mixing, pieces, pii, units
from barloom.llm.queries import DIMENSIONS


def brute_base(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_spans():
    random.seed(1)
    for _ in range(20000):
        text = "".join(random.choice("a@.1 -+%(2é5_0") for _ in range(random.randrange(30)))
        assert [s[:3] for s in pii.find(text) if s[0] in pii.BASE] == brute_base(text)
    assert pii.find("1" * 100000 + "@" * 50000 + "a" * 100000) == []


def test_added_spans_and_scores():
    assert [s[0] for s in pii.find("my iban is GB82 WEST 1234 5698 7654 32, ssn 123-45-6789")] == ["iban", "ssn"]
    assert pii.find("order 123-45-6789") == []
    assert not [s for s in pii.find("GB82 WEST 1234 5698 7654 33") if s[0] == "iban"]
    near, far = pii.find("call +49 30 1234567"), pii.find("order +49 30 1234567")
    assert near[0][3] > far[0][3]
    assert pii.redact("mail a@b.de now", pii.find("mail a@b.de now")) == "mail [EMAIL] now"


def test_ibans_before_words_and_beside_cards():
    number = "DE89 3704 0044 0532 0130 00"
    for after in (" BIC COBADEFFXXX", " EUR 100", " 2024 05 01", " 12", ", due", "", " B", " GB82 WEST 1234 5698 7654 32"):
        text = f"pay to {number}{after}"
        spans = [text[s[1] : s[2]] for s in pii.find(text) if s[0] == "iban"]
        assert spans[0] == number and len(spans) == 1 + (" GB82" in after)
        assert "0532" not in pii.redact(text, pii.find(text))
    assert [s[1:3] for s in pii.find("AB12 3456 " + number) if s[0] == "iban"] == [(10, 37)]
    beside = 0
    for i in range(400):
        digits = f"{i * 7919 + 10**13:014d}"
        rest = f"WEST {digits[:4]} {digits[4:8]} {digits[8:12]} {digits[12:]}"
        code = next(c for k in range(2, 99) if pii.mod97((c := f"GB{k:02d} {rest}").replace(" ", "")))
        text = f"iban {code} EUR"
        found = pii.find(text)
        assert ("iban", 5, 5 + len(code)) in [s[:3] for s in found] and pii.redact(text, found) == "iban [IBAN] EUR"
        beside += "card" in [s[0] for s in found]
    assert beside > 10


def test_personal_data(docs, empty):
    got = pii.personal_data(docs)
    assert got.columns == [*docs.columns, "spans", "redacted"] and got.count() == docs.count()
    assert pii.digests(got).where("n_email > 0").count() == 0
    assert [r.redacted for r in got.where("text is null").collect()] == [None]
    assert pii.personal_data(empty).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def test_segmentations_against_all(vocabulary):
    random.seed(3)
    encoder = pieces.Encoder(vocabulary, 4)
    for _ in range(300):
        text = "".join(random.choice("the anionés,. \n▁漢q") for _ in range(random.randint(1, 9)))
        sign = pieces.SPACE + text.replace(pieces.SPACE, pieces.LITERAL).replace(" ", pieces.SPACE)
        every = []

        def go(i, score, ids):
            if i == len(sign):
                every.append((score, ids))
            for j in range(i + 1, min(len(sign), i + vocabulary.longest) + 1):
                part = sign[i:j]
                if part in vocabulary.scores or j == i + 1:
                    go(j, score + vocabulary.scores.get(part, vocabulary.worst), ids + tuple(pieces._written(part, vocabulary)))

        go(0, 0.0, ())
        got = [(s, tuple(np.frombuffer(i, np.int32).tolist())) for s, i in encoder.encode([text])[0]]
        assert [s for s, _ in got] == sorted((s for s, _ in every), reverse=True)[:4]
        assert set(got) <= set(every) and len(set(got)) == len(got)
        assert all(pieces.decode(ids, vocabulary) == text for _, ids in got)


def test_words_are_cut_together(vocabulary, monkeypatch):
    random.seed(8)
    some = "the anionés,.\n漢q😀Я" + pieces.LITERAL
    words = {pieces.SPACE + "".join(random.choices(some, k=random.randint(0, pieces.LONG - 1))) for _ in range(800)}
    words |= {pieces.SPACE * k for k in (1, 2, 40)} | {"国際", "a" * pieces.LONG, "the"}
    words = sorted(words)
    want = list(pieces.best_of_sorted(words, vocabulary))
    shuffled = random.sample(range(len(words)), len(words))
    score, loss, start, size, ids = pieces.Lattice(vocabulary).cut([words[i] for i in shuffled])
    for at, i in enumerate(shuffled):
        assert (score[at], ids[start[at] : start[at] + size[at]].tobytes(), loss[at]) == want[i]
    texts = [" ".join(random.choices("one two three été 漢字 ▁ international".split(), k=30)) + " " + "long" * k for k in (0, 50, 3, 50)]
    few, many = pieces.Encoder(vocabulary, 3, kept=1), pieces.Encoder(vocabulary, 3)  # forgetting changes nothing
    want = many.encode(texts)
    assert [few.encode([text])[0] for text in texts] == want and [len(w) for w in want] == [3] * 4
    alone = []  # words that go through Python place by place: the long one only
    monkeypatch.setattr(pieces, "best_of_sorted", lambda words, known, cut=pieces.best_of_sorted: alone.extend(words) or cut(words, known))
    assert pieces.Encoder(vocabulary, 3).encode(texts) == want and [len(word) for word in alone] == [201]
    none = pieces.Pieces({}, {}, list(range(256)), [bytes([b]) for b in range(256)])
    assert pieces.Encoder(none, 2).encode(["é b"]) == [[(-40.0, np.array(list("▁é▁b".encode()), np.int32).tobytes())]]


def test_counted_pieces(spark, docs, empty, vocabulary):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    words = "international government because different language people through between important development number".split()
    for word in [*words, "qzxv", "aaaaaaa", "ththeing", "année"]:
        assert pieces.merged(pieces.SPACE + word, vocabulary) == model.encode(word, out_type=str)
    table = spark.createDataFrame([(i, " ".join(words[i % 3 :]) + " ▁ \n") for i in range(30)] + [(99, None)], "doc_id long, text string")
    lattice = pieces.counted(table.repartition(3), vocabulary)
    assert lattice.scores == pieces.counted(table.repartition(1), vocabulary).scores  # growing with the documents, not their order
    best = lambda known: [list(pieces.n_best(pieces.SPACE + word, known, 1)[0][1]) for word in words]
    model_ids = [model.encode(word) for word in words]
    assert best(lattice) == model_ids != best(vocabulary)
    more = pieces.counted(table.union(table.limit(1)), vocabulary)
    assert more.scores != lattice.scores
    assert len({s for s in pieces.counted(empty, vocabulary).scores.values() if s > pieces.FORBIDDEN}) == 1
    assert all(r.restored == r.text for r in pieces.encode(docs, pieces.counted(docs, vocabulary)).collect())


def test_encode(docs, empty, vocabulary):
    got = pieces.encode(docs, vocabulary, n=3).collect()
    assert len(got) == docs.count()
    for row in got:
        assert row.restored == row.text
        assert (row.n_best is None) == (row.text is None)
        if row.text:
            assert len(row.n_best) <= 3 and row.n_best == sorted(row.n_best, key=lambda w: -w.score)
            assert all(pieces.decode(w.ids, vocabulary) == row.text for w in row.n_best)
        elif row.text == "":
            assert [(w.score, w.ids) for w in row.n_best] == [(0.0, [])]
    assert pieces.encode(empty, vocabulary).count() == 0


def test_language(spark, docs, empty):
    random.seed(5)
    syllables = {"en": "the and ing er", "de": "sch ung ein ich", "fr": "eau ou que ai", "es": "ción os do ll"}
    rows = [
        (i, " ".join("".join(random.choices(some.split(), k=3)) for _ in range(40)), lang)
        for i, (lang, some) in enumerate(list(syllables.items()) * 40)
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(table.where(~langid.held_out()))
    assert set(model.families) == {"germanic", "romance"} and len(model.duels) == 3
    got = langid.identify(table, model).where(langid.held_out()).collect()
    assert got and all(r.lang == r.lang_pred and 0 <= r.score <= 1 for r in got)
    odd = {r.text: r.lang_pred for r in langid.identify(docs, model).collect()}
    assert odd[None] == odd[""] == odd[" \n\t"] == langid.UNKNOWN != odd["one two"]
    foreign = ["Это русский текст о погоде и о том как люди живут", "これは日本語の文章です。天気について書かれています。", "qzxvk " * 12]
    strange = spark.createDataFrame([(i, t) for i, t in enumerate(foreign)], "doc_id long, text string")
    assert not any(r.usual for r in langid.identify(strange, model, known="usual").collect())
    assert langid.identify(table, model, known="usual").where("not usual").count() == 0
    none = langid.fit(empty)
    assert langid.identify(docs, none, known="usual").where("usual").count() == 0
    assert {r.lang_pred for r in langid.identify(docs, none).collect()} == {langid.UNKNOWN}
    assert langid.identify(empty, model).count() == 0


def test_rake():
    cells = [(a, b) for a in "xyz" for b in "pq"]
    tokens = np.array([100.0, 300, 50, 500, 400, 20])
    targets = [{"x": 0.3, "y": 0.3, "z": 0.4}, {"p": 0.6, "q": 0.4}]
    wanted = mixing.rake(cells, tokens, targets, budget=200)
    for d, target in enumerate(targets):
        for value, share in target.items():
            assert abs(wanted[[c[d] == value for c in cells]].sum() - 200 * share) < 1e-6
    plain = tokens / tokens.sum() * 200  # proportional fitting as written in books
    for _ in range(2000):
        for d, target in enumerate(targets):
            for value, share in target.items():
                at = [c[d] == value for c in cells]
                plain[at] *= 200 * share / plain[at].sum()
    assert np.allclose(plain, wanted)
    assert (mixing.rake(cells, tokens, targets, budget=1000) <= tokens + 1e-9).all()


def test_mix(spark, docs, empty):
    targets = {"source": {"s": 0.5, "other": 0.5}, "lang": {"other": 1.0}}
    mixed, found = mixing.mix(docs, {"source": "source", "lang": "lang"}, targets, fraction=0.5)
    assert mixed.count() == docs.count() and set(docs.columns) < set(mixed.columns)
    again, _ = mixing.mix(mixed, {"source": "source", "lang": "lang"}, targets, fraction=0.5)
    assert sorted(again.columns) == sorted(mixed.columns)
    assert mixing.mix(empty, {"source": "source", "lang": "lang"}, targets)[0].count() == 0
    rows = [(i, "w " * (1 + i % 7), "a" if i % 4 else "b") for i in range(8000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed, found = mixing.mix(table, {"source": "source"}, {"source": {"a": 0.6, "b": 0.4}}, fraction=0.4)
    chosen = {r.source: r.t for r in mixed.where("mix_selected").groupBy("source").agg({"mix_tokens": "sum"}).withColumnRenamed("sum(mix_tokens)", "t").collect()}
    assert abs(chosen["b"] / sum(chosen.values()) - 0.4) < 0.03 and abs(sum(chosen.values()) / found.tokens.sum() - 0.4) < 0.03


def test_small_slices_keep_workers_small():
    texts = pa.array([f"some words of text {i} " * 40 for i in range(4000)] + [None, "", "a " * 300_000])
    units._powers.clear()
    tracemalloc.start()
    sizes = [len(s) for s in minhash.shingle_sets(texts.slice(0, 4000))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20 and set(sizes) == {5}
    whole = units.powers(units.SLICE + 1).copy()
    units._powers.clear()
    for n in (1, 5, units.SMALL + 1, units.SMALL + 2, 700_000, units.SLICE + 1, units.SLICE + 9):
        some = units.powers(n)
        assert len(some) == n and (some[: len(whole)] == whole[:n]).all() and len(units._powers[False]) <= units.SLICE + 1
    assert len(units.powers(units.SLICE + 1)) == units.SLICE + 1
    assert [len(s) for s in minhash.shingle_sets(texts)][-3:] == [0, 0, 1]


def test_mix_counts_words_without_making_them(spark, docs, empty):
    odd = spark.createDataFrame([(1, "\u00a0 a\x0bb\x1cc"), (2, "x" * 3_000_000 + " y"), (3, None), (4, ""), (5, " \n")], "doc_id long, text string")
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    for table in (odd, docs, empty):
        found = table.select("text", words.cast("long").alias("n"), mixing.n_words("text").alias("found"))
        assert found.where("n <> found or found is null").count() == 0
    topic = (
        r"case when regexp_count(text, '[|\\t]') * 5 > regexp_count(text, '[^\\x20\\x09-\\x0D]+') then 'table' "
        r"when regexp_count(text, '\\p{Lu}') > regexp_count(text, '\\p{Ll}') then 'shout' "
        r"when regexp_count(text, '[^\\p{L}\\p{M}\\p{N}\\s]') * 5 > length(text) then 'noise' else 'prose' end"
    )
    random.seed(11)
    made = [("".join(random.choices("aé漢ßÀBÇ😀𝒜𝒶|\t\n\x0b\u00a0\x1c \u0301#$7", k=random.randrange(30))),) for _ in range(3000)]
    made = spark.createDataFrame(made, "text string").union(docs.select("text")).union(odd.select("text").where("doc_id <> 2"))
    both = made.select(F.expr(topic).alias("old"), F.expr(DIMENSIONS["topic"]).alias("new"))
    assert both.where("not old <=> new").count() == 0 and both.select("new").distinct().count() == 4
    targets = {name: {"x": 1.0} for name in DIMENSIONS}
    plan = mixing.with_cells(docs, DIMENSIONS, targets)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "regexp_count" not in plan  # arrays of all words or characters of a text


def test_mix_of_unseen_values(spark):
    texts = ["clean words go here " * 9 + end for end in ("", "### heading", "a | b")] + ["LOUD!! " * 9, "a | b | c | d", "$$$ %%% &&& x"]
    rows = [(i, texts[i % 6], ["new", "other", None, "rare"][min(i % 50, 3)], ["pt", None][i % 2]) for i in range(3000)]
    rows += [(9000 + i, "", "wordless", "xx") for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    targets = mixing.flattened(table, DIMENSIONS)
    assert set(targets["source"]) == {"new", "other", "rare", "wordless"} and set(targets["lang"]) == {"pt", "xx", "other"}
    assert all(abs(sum(t.values()) - 1) < 1e-9 and min(t.values()) > 0 for t in targets.values())
    mixed, found = mixing.mix(table, DIMENSIONS, targets)
    assert mixed.where("mix_probability <= 0").count() == 0
    assert {r.source for r in mixed.where("mix_selected").select("source").distinct().collect()} == {"new", "other", None, "rare", "wordless"}
    forms = {r.text: r.topic for r in mixed.select("text", "mix_cell.topic").collect()}
    assert [forms[x] for x in texts] == ["prose", "prose", "prose", "shout", "table", "noise"]
    strange = table.select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.concat(F.lit("site"), F.col("doc_id") % 90).alias("source"), F.lit(0).alias("n_chars"))
    assert corpus_pipeline.mixture(spark, strange, "").count() > 1000
    assert len(mixing.flattened(strange, {"source": "source"})["source"]) == 90  # each has a target of its own


def test_findings(spark, docs, empty):
    random.seed(8)
    key = lambda: "".join(random.choices("0123456789abcdef", k=40))
    rows = []
    for i in range(300):
        text = f"some ordinary words then token = \"{key()}\" and more" if i % 2 else f"an extraordinarilylongcompoundedword{'abcdefgh'[i % 8]} in prose"
        rows.append((i, text))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = findings.scan(table).collect()
    assert len(got) == 300 and all(r.secret == (r.doc_id % 2 == 1) for r in got)
    assert "Python" not in findings.scan(table)._jdf.queryExecution().executedPlan().toString()
    assert findings.scan(docs).where("doc_id is not null").count() >= 0
    assert findings.scan(empty).count() == 0


def test_findings_in_one_word(spark):
    random.seed(9)
    key = lambda: "".join(random.choices("0123456789abcdef", k=32))
    keys = [key() for _ in range(400)]
    forms = [
        '{{"client_identifier":"frontend-webapp-prod","api_key":"{}"}}', "https://internal-config-service/v1?x=1&api_key={}",
        "user=somebody-with-a-long-name;token={};", "extraordinarily_long_column,{},last", "see token = {} here",
    ]
    table = spark.createDataFrame([(i, f"so {forms[i % 5].format(k)} and on") for i, k in enumerate(keys)], "doc_id long, text string")
    found = findings.candidates(table).collect()
    assert len({(r.doc_id, r.place, r.run) for r in found}) == len(found)
    for i, k in enumerate(keys):
        assert [r for r in found if r.doc_id == i and r.core.endswith(k)]
    runs = [(r.run, r.core, r.lead, r.before, r.after) for r in sorted(found, key=lambda r: r.run) if r.doc_id == 0]
    assert runs == [
        (0, "client_identifier", '{"', "so", ""), (1, "frontend-webapp-prod", 'client_identifier":"', "", ""),
        (2, keys[0], 'frontend-webapp-prod","api_key":"', "", "and"),
    ]
    assert {r.run: r.label for r in findings.weak_labels(findings.candidates(table.where("doc_id = 0"))).collect()}[2] == 1
    got = findings.scan(table).where("secret").collect()
    assert {r.doc_id for r in got if r.core.endswith(keys[r.doc_id])} >= {i for i in range(400) if i % 5 != 3}


def test_statistics_of_all_documents(spark):
    random.seed(10)
    texts = [" ".join(random.choices("alpha beta gamma delta Zebra x9".split(), k=5)) for _ in range(500)] + ["quartz " * 700, None, ""]
    words = [w.lower() for t in texts if t for w in t.split() if re.fullmatch("[a-z]{4,12}", w.lower())]
    pairs = [a + b for w in words for a, b in zip(w, w[1:])]
    table = spark.createDataFrame([(None if t is None else t.split(),) for t in texts], "words array<string>")
    transitions, dictionary = findings.statistics(table.repartition(7))
    assert (transitions, dictionary) == findings.statistics(table.coalesce(1)) and set(dictionary) == set(words)
    size = len(findings.ALPHABET) + 1
    place = lambda c: findings.ALPHABET.find(c) + 1
    for two in ("qu", "al", "ze", "qq"):
        line = size + sum(p[0] == two[0] for p in pairs)
        assert abs(transitions[place(two[0]) * size + place(two[1])] - np.log((1 + pairs.count(two)) / line)) < 1e-9
    # one late document decides what is covered by the dictionary, at any size of the table
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    seen = []
    real, findings.train = findings.train, lambda labelled, prose, **kw: (seen.append(findings.statistics(prose)[1]), real(labelled, prose, **kw))[1]
    try:
        findings.scan(docs)
    finally:
        findings.train = real
    assert set(seen[0]) == set(words)
