"""Columns of the input that are called like columns of the operators' own."""

from pyspark.sql import functions as F

from barsmith.llm import line_dedup, lm_score, quality

from llm_fixtures import base_words, docs_of  # noqa: F401


def named(docs, *names):
    return docs.withColumns({n: F.lit(f"own {n}") for n in names})


def kept_values(rows, *names):
    return all(r[n] == f"own {n}" for r in rows for n in names)


def test_line_dedup(docs_of):
    line = "a line that is long enough to be found"
    docs = docs_of([(i, f"{line}\nown line number {i} of this text") for i in range(4)])
    names = ("__doc", "__lost", "__LOST_")
    rows = line_dedup.dedup_lines(named(docs, *names)).collect()
    assert sorted(r["n_dropped"] for r in rows) == [0, 1, 1, 1] and kept_values(rows, *names)


def test_lm_scores(docs_of):
    docs = docs_of([(i, " ".join(base_words(i, 40))) for i in range(6)])
    counts = lm_score.word_counts(docs)
    vocab, net = lm_score.train(docs.select("text"), counts=counts)
    names = ("_net", "_tails", "_row", "_shares", "at", "shares", "word", "n", "times")
    plain = {r["doc_id"]: r["pll"] for r in lm_score.score(docs, vocab, net, counts).collect()}
    rows = lm_score.score(named(docs, *names), vocab, net, counts).collect()
    assert {r["doc_id"]: r["pll"] for r in rows} == plain and kept_values(rows, *names)


def test_quality_rules(spark, docs_of):
    docs = docs_of([(i, " ".join(base_words(i, 80))) for i in range(30)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    names = ("__id", "__key", "text_key")
    rows = quality.keep_good(named(docs, *names), labels).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in quality.keep_good(docs, labels).collect()}
    assert kept_values(rows, *names)
