"""Quality rules against brute force, the classifier on held-out labels."""

import random

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from hourcast.llm import quality_classifier as QC
from hourcast.llm import quality_rules as QR

SF = "/root/testdata/sf0.01"
WHITE = " \t\n\x0b\x0c\r"


def brute(text, limits):
    words, cur = [], ""
    for c in text + " ":
        if c in WHITE:
            words += [cur] if cur else []
            cur = ""
        else:
            cur += c
    n = len(words)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(WHITE):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(n - 2):
        windows.setdefault(tuple(words[i:i + 3]), []).append(i)
    repeat = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 3)}
    covered, longest = set(), 0
    for i in range(n):
        for j in range(i):
            k = 0
            while i + k < n and words[i + k] == words[j + k]:
                k += 1
            if k >= limits.min_match:
                longest = max(longest, k)
                covered |= set(range(i, i + k)) | set(range(j, j + k))
    base = n < limits.min_words or 100 * len(repeat) > limits.max_window_pct * n
    bad = 100 * len(covered) > limits.max_covered_pct * n or longest > limits.max_repeat
    return (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(repeat), len(covered), longest,
            base, not base and not bad)


@pytest.mark.parametrize("match", [1, 3, 5, 8])
def test_rules_equal_brute_force(spark, match):
    rng = random.Random(match)
    texts = []
    for _ in range(120):
        pool = [rng.choice(["a", "bb", "c#", "é", "<x>", " z", "|"]) for _ in range(rng.randint(1, 7))]
        words = [rng.choice(pool) for _ in range(rng.randint(0, 40))]
        if words and rng.random() < 0.4:
            words += words[:rng.randint(1, len(words))]
        texts.append("".join(w + rng.choice([" ", " ", "\n", "\t ", " "]) for w in words))
    limits = QR.Limits(min_words=8, min_match=match, max_repeat=12)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in QR.quality_rules(df, limits).drop("text").collect())
    assert got == [(i, *brute(t, limits)) for i, t in enumerate(texts)]
    assert len({r[-1] for r in got}) == (1 if match == 1 else 2)    # any repeated word is one of length 1


def test_rules_query_equals_brute_force(spark):
    """Every short document of the table; the whole table's rows are counted."""
    out = queries()["op5_quality_rules"](spark, SF)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = out.collect()
    assert len(got) == len(texts)
    for r in got:
        if r.n_words <= 250:
            assert tuple(r)[1:] == brute(texts[r.doc_id], QR.Limits()), r.doc_id


def test_rules_edges(spark, edge_docs, no_docs):
    got = QR.quality_rules(edge_docs).collect()
    assert len(got) == 9 and all(r.extra == 7 for r in got)
    by = {(r.doc_id, r.text): r for r in got}
    for key in ((2, None), (3, ""), (4, " \n\t \n")):
        assert by[key].n_words == 0 and by[key].base_failed and not by[key].kept
    assert QR.quality_rules(no_docs).count() == 0
    with pytest.raises(ValueError, match="n_words"):
        QR.quality_rules(no_docs.withColumn("n_words", F.lit(1)))


def test_classifier_on_held_out_rows(spark):
    scored = queries()["op2_quality_classifier"](spark, SF).cache()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert scored.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = scored.join(labels, "doc_id").where("held_out and quality is not null").collect()
    assert len(held) > 80
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    assert all(r.predicted == 1 for r in held if r.quality == 1)
    assert scored.where("score < 0 or score > 1 or score is null or predicted <> cast(score >= 0.5 as int)").count() == 0


def test_classifier_ignores_held_out_labels_and_other_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(QC.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    cfg = QC.Config(epochs=2, max_docs=60)
    a = QC.score_quality(docs.select("doc_id", "text"), labels, cfg).select("doc_id", "score")
    b = QC.score_quality(docs.withColumn("lang", F.lit("xx")).select("doc_id", "text", "lang"), turned, cfg).select("doc_id", "score")
    assert a.exceptAll(b).count() == 0


def test_classifier_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (5, 0), (5, None), (3, 1), (3, 0), (None, 0), (6, 1)], "doc_id long, quality int")
    got = QC.score_quality(edge_docs, labels, QC.Config(epochs=1)).collect()
    assert len(got) == 9 and all(0 <= r.score <= 1 for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {True}
    empty = {r.score for r in got if not (r.text or "").strip()}
    assert len(empty) == 1
    none = labels.where("false")
    assert {(r.score, r.predicted) for r in QC.score_quality(edge_docs, none).collect()} == {(0.5, 1)}
    assert QC.score_quality(no_docs, labels).count() == 0
