"""Language, quality and rules: exact counts against brute force, held-out accuracy, edges; then the pipeline's stages."""

import re
from collections import Counter

from pyspark.sql import functions as F

from barloom.llm.language import fit_languages, identify
from barloom.llm.quality import fit_quality, score_quality
from barloom.llm.rules import COUNTS, judge, text_counts

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    runs = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    hit = [False] * len(w)
    for k in range(len(w) - 4):
        if runs[tuple(w[k : k + 5])] > 1:
            hit[k : k + 5] = [True] * 5
    seen, lines = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), lines, sum(hit)


EDGES = ["", None, "\n\n", "a\na\na \na", "x y z x y z x y z x y z", "é|é\n é|é\né|é", "w " * 30000, "one\r\ntwo\r\none\r\n", "<a>&" * 9, "a b c d e\na b c d e"]


def test_counts(spark):
    docs = [(k, t) for k, t in enumerate(EDGES * 2)] + [(None, "a a"), (1, "x")]
    docs += [(100 + r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n_words", "2 as anomaly").repartition(3)
    got = sorted((tuple(r) for r in text_counts(d).collect()), key=str)
    assert got == sorted(((i, *brute_counts(t)) for i, t in docs), key=str)


def test_judge(spark):
    from barloom.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = QUERIES["op8_rules"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, *_, repeats = brute_counts(texts[r.doc_id])
        assert tuple(r[c] for c in COUNTS) == brute_counts(texts[r.doc_id])
        assert r.base_failed == (n < 10 or 100 * repeats > 20 * n) and not (r.base_failed and r.kept)
    good = [r.kept for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(good) >= 0.95 * len(good)
    d = spark.createDataFrame([(k, t) for k, t in enumerate(EDGES)], "doc_id long, text string")
    none = spark.createDataFrame([(None, 1), (3, None)], "doc_id long, quality int")
    assert [r.kept for r in judge(d, none).collect()] == [r.kept for r in judge(d, none.limit(0)).collect()]
    assert judge(d.limit(0), none).count() == 0


def test_languages(spark):
    from barloom.llm.queries import QUERIES

    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op2_language"](spark, FOLDER).collect() if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) >= 0.95 * len(rows)
    train = spark.createDataFrame([("the cat and the hat", "en"), ("das und der ist", "de"), ("x", None), (None, "fr"), ("12", "fr")], "text string, lang string")
    model = fit_languages(train)
    assert set(model) == {"en", "de"}
    d = spark.createDataFrame([(1, "The Hat"), (2, None), (3, "12 !?"), (None, "UND DER"), (5, ""), (1, "The Hat"), (6, "der " * 50000)], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.lang_pred) for r in identify(d.withColumn("score", F.lit(9)), model).collect()))
    assert got == [(0, "de"), (1, "en"), (1, "en"), (2, "und"), (3, "und"), (5, "und"), (6, "de")]
    assert {r.lang_pred for r in identify(d, {}).collect()} == {"und"} and identify(d.limit(0), model).count() == 0


def test_quality(spark):
    from barloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op3_quality"](spark, folder).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in rows) >= 0.93 * len(rows)
    d = spark.createDataFrame([(k, t, "s") for k, t in enumerate(EDGES)] + [(None, "a b", "s")], "doc_id long, text string, score string")
    assert {r.score for r in score_quality(d, None).collect()} == {0.5}
    marks = spark.createDataFrame([(k, k % 2) for k in range(10)] + [(None, 1), (3, None), (3, 1), (77, 0)], "doc_id long, quality int")
    out = score_quality(d, fit_quality(d, marks))
    assert all(0 <= r.score <= 1 for r in out.collect()) and out.count() == 11
    assert fit_quality(d, marks.limit(0)) is None and score_quality(d.limit(0), None).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumns({"own_id": F.lit(1), "quality_score": F.lit("x")})
    extra = spark.createDataFrame([(None, None, "en"), (None, "", "en"), (7, None, None)], "doc_id long, text string, lang string")
    docs = docs.unionByName(extra, allowMissingColumns=True)
    columns = docs.columns
    for k, (_, stage) in enumerate(p.STAGES):
        before = docs.count()
        docs = p.kept_table(stage(spark, docs, FOLDER), "stage")
        assert 0 < docs.count() <= before and (docs.columns == columns or k == len(p.STAGES) - 1)
    for _, stage in p.STAGES[:-1]:
        assert stage(spark, extra.limit(0), FOLDER).count() == 0
    assert p.run(spark, FOLDER).count() > 0
