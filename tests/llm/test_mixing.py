"""Poisson replication against a plain recount of hashes."""
import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hostlake.llm import mixing as M


def slow_copies(seed, ident, rate):
    parts = max(1, math.ceil(rate / M.LARGEST_MEAN))
    total = 0
    for j in range(parts):
        x = hashlib.md5(f"{seed}:{'' if ident is None else ident}:{j}".encode()).hexdigest()[:13]
        u, mean = (int(x, 16) + 0.5) / (1 << 52), rate / parts
        k, cdf = 0, math.exp(-mean)
        while cdf < u and k < 500:
            k += 1
            cdf = math.fsum(math.exp(-mean + i * math.log(mean) - math.lgamma(i + 1)) for i in range(k + 1))
        total += k
    return total


def docs(spark, n=400):
    return spark.createDataFrame([(i, f"t{i}", "big" if i % 3 else ("small" if i % 2 else None)) for i in range(n)],
                                 "doc_id long, text string, source string").withColumns({"copy": F.lit(9), "label": F.lit("x")})


def test_counts_match_the_inverse_distribution(spark):
    df = docs(spark)
    out = M.poisson_mix(df, {"big": 1.0, "small": 8.0}, other=1.0, seed=3)
    assert out.columns == df.columns + ["_copy", "shuffle_key"]
    n = Counter(r.source if r.source in ("big", "small") else None for r in df.collect())
    rate = {s: w / 10 * 400 / n[s] for s, w in (("big", 1.0), ("small", 8.0), (None, 1.0))}
    want = {r.doc_id: slow_copies(3, r.doc_id, rate[r.source]) for r in df.collect()}
    assert Counter(r.doc_id for r in out.collect()) == Counter({d: c for d, c in want.items() if c})


def test_large_rates_and_total(spark):
    df = docs(spark, 60)
    out = M.poisson_mix(df, {"small": 1.0}, other=0.0, seed=1, total=600.0)
    n = df.where("source = 'small'").count()
    want = {r.doc_id: slow_copies(1, r.doc_id, 600 / n) for r in df.where("source = 'small'").collect()}
    assert 600 / n > M.LARGEST_MEAN and Counter(r.doc_id for r in out.collect()) == Counter(want)


def test_shares_and_global_order(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 7, "a").otherwise("b").alias("source"))
    out = M.poisson_mix(df, {"a": 0.2, "b": 0.8}, seed=5).collect()
    share = sum(r.source == "a" for r in out) / len(out)
    assert abs(share - 0.2) < 0.02 and abs(len(out) / 20_000 - 1) < 0.03
    keys = [r.shuffle_key for r in out]
    assert keys == sorted(keys)
    ids = [r.doc_id for r in out]
    assert abs(sum(ids[: len(ids) // 2]) / sum(ids) - 0.5) < 0.02


def test_same_on_any_partitioning(spark):
    df = docs(spark)
    a, b = (sorted(map(repr, M.poisson_mix(x, {"big": 1.0}, 1.0, 2).collect())) for x in (df.coalesce(1), df.repartition(7)))
    assert a == b


def test_nulls_empty_and_repeated_rows(spark):
    rows = [(None, None, None), (None, None, None), (5, "", "a"), (5, "", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    n = Counter(r.doc_id for r in M.poisson_mix(df, {"a": 1.0, "gone": 3.0}, 1.0, 2, total=40.0).collect())
    assert n[None] == 2 * slow_copies(2, None, 40 / 5 / 2) and n[5] == 2 * slow_copies(2, 5, 40 / 5 / 2)
    assert M.poisson_mix(df.limit(0), {"a": 1.0}).collect() == []
    with pytest.raises(ValueError):
        M.poisson_mix(df, {"a": -1.0}, 2.0)


def test_distribution():
    d = M.distribution(1.5)
    assert math.isclose(d[0], math.exp(-1.5)) and math.isclose(d[-1], 1.0) and d == sorted(d)
    assert M.distribution(0.0)[0] == 1.0
