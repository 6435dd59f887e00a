"""Statistics against a recount, rules against trees, held-out accuracy."""
import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from hostlake.llm import queries as Q
from hostlake.llm import rule_ensemble as R

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_contract(spark):
    out = Q.op7_rule_ensemble(spark, SF)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.95
    low, high = ([r.score for r in held if labels[r.doc_id] == y] for y in (0, 1))
    assert sum(a < b for a in low for b in high) / (len(low) * len(high)) > 0.97


def test_held_out_labels_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    other = labels.withColumn("quality", F.when(R.third(F.col("doc_id")) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    usable = R.third(F.col("doc_id")) != 1
    a, b = (R.fit(docs.repartition(n), x, usable) for n, x in ((1, labels), (5, other)))
    assert a == b and a.weights and len(a.weights) < 60


def recount(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if x.strip(" ")]
    n, m, c = max(1, len(words)), max(1, len(lines)), max(1, len(text))

    def count(s):
        return sum(text.count(x) for x in s)
    return {"words": len(words), "word_length": (c - count(" \t\n\r")) / n, "symbols": count("#*$%&<>@^~=_+\\{}[]") / n,
            "bars": count("|") / n, "shouts": count("!?") / n, "capitals": count("ABCDEFGHIJKLMNOPQRSTUVWXYZ") / c,
            "digits": count("0123456789") / c, "stops": count(".,;:") / n, "distinct_words": len(set(words)) / n,
            "distinct_lines": len(set(lines)) / m,
            "common_words": sum(w.rstrip(".,;:!?").lower() in R.COMMON_WORDS for w in words) / n}


def test_statistics(spark):
    texts = [None, "", " \n ", "The cat | and, the dog!! \\ [x] {y} $5\nThe cat\nThe cat\n\n", "a|b " * 5000, "UND Für?! été\tx\x0by"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    values = R.statistics(F.col("t"))
    assert tuple(values) == R.NAMES
    for r in df.select("t", *[c.alias(n) for n, c in values.items()]).collect():
        want = recount(r.t)
        assert {n: round(r[n], 9) for n in R.NAMES} == {n: round(v, 9) for n, v in want.items()}


TREE = """DecisionTreeClassificationModel: depth=2
  If (feature 1 <= 0.5)
   If (feature 0 <= 3.0)
    Predict: 0.0
   Else (feature 0 > 3.0)
    Predict: 1.0
  Else (feature 1 > 0.5)
   Predict: 1.0
"""


def test_paths_of_a_tree(spark):
    rules = R.paths(TREE, ("x", "y"))
    assert [str(r) for r in rules] == ["y <= 0.5", "x <= 3 AND y <= 0.5", "x > 3 AND y <= 0.5", "y > 0.5"]
    assert R.simplest([("x", "<=", 3.0), ("x", "<=", 2.0), ("x", ">", 1.0)]) == (("x", "<=", 2.0), ("x", ">", 1.0))
    model = R.RuleEnsemble(0.5, {rules[2]: 2.0, rules[3]: -1.0})
    df = spark.createDataFrame([(4.0, 0.5), (3.0, 0.5), (9.0, 0.6)], "x double, y double")
    got = [r[0] for r in df.select(model.score({"x": F.col("x"), "y": F.col("y")})).collect()]
    assert all(math.isclose(g, 1 / (1 + math.exp(-z))) for g, z in zip(got, (2.5, 0.5, -0.5), strict=True))


def test_nulls_empty_ties_and_clashing_columns(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(None, "x"), (2_000_000, None), (2_000_001, ""), (2_000_001, "")], "doc_id long, text string")
    wide = docs.select("doc_id", "text").union(odd).withColumns({"score": F.lit(9), "words": F.lit(8), "y": F.lit(1)})
    more = labels.select("doc_id", "quality").union(spark.createDataFrame([(None, 1), (5, None), (6, 0), (6, 1)], "a long, b int"))
    out = R.classify(wide, more)
    rows = [r for r in out.where("doc_id IS NULL OR doc_id >= 2000000").collect()]
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    kept = R.accepted(wide, R.fit(docs, labels))
    assert kept.columns == wide.columns and 0 < kept.count() < wide.count()


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(1, 0)]])
def test_too_few_labels(spark, labels):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    out = R.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    ones = sum(q for i, q in labels if zlib.crc32(str(i).encode()) % 3 != 1)
    n = sum(1 for i, q in labels if zlib.crc32(str(i).encode()) % 3 != 1)
    assert all(math.isclose(r.score, (ones + 1) / (n + 2)) for r in out) and len(out) == 2
    assert R.classify(docs.limit(0), spark.createDataFrame(labels, "doc_id long, quality int")).collect() == []
