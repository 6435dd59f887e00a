"""Neighbours against brute force."""
import random

import pytest
from pyspark.sql import functions as F

from hostlake.llm import hamming_topk as H


def slow(base, queries, k):
    out = []
    rows = {(i, c) for i, c in base if i is not None and c is not None}
    for q, code in {(i, c) for i, c in queries if i is not None and c is not None}:
        near = sorted((((code ^ c) & (1 << 64) - 1).bit_count(), i) for i, c in rows if i != q)[:k]
        out += [(q, i, d, r + 1) for r, (d, i) in enumerate(near)]
    return sorted(out)


def check(spark, base, queries, k):
    schema = "vec_id long, code long"
    b = spark.createDataFrame(base, schema).withColumns({"ids": F.lit(1), "key": F.lit(2)})
    got = H.top_k(b, spark.createDataFrame(queries, schema), k)
    assert sorted(tuple(r) for r in got.collect()) == slow(base, queries, k)


def codes(seed, n, noise):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(5)]
    out = []
    for i in range(n):
        c = rng.choice(centres)
        for _ in range(rng.randint(0, noise)):
            c ^= 1 << rng.randrange(64)
        out.append((i, c - (1 << 64) if c >> 63 else c))
    return out


def test_clustered_codes(spark):
    base = codes(1, 600, 9)
    check(spark, base, base[::50], 7)


def test_copies_ties_nulls_and_few_rows(spark):
    base = codes(2, 40, 2) + [(100 + i, 5) for i in range(300)] + [(3, 5), (None, 5), (7, None), (100, 5)]
    check(spark, base, [(100, 5), (1, 77), (None, 3), (9, None), (100, 5)], 6)
    check(spark, [(1, 0), (2, -1)], [(1, 0)], 10)
    check(spark, [(1, 0)], [(1, 0)], 3)


def test_empty(spark):
    base = codes(3, 20, 5)
    check(spark, base, [(None, 1)], 3)
    check(spark, [(None, 1)], base[:2], 3)


def test_segments_cover_all_bits():
    for n in (0, 1, 2, 500, 50_000, 10**9, 10**18):
        parts = H.segments(n)
        assert sum(length for _, length in parts) == 64 and [a for a, _ in parts] == sorted({a for a, _ in parts})


def test_long_vectors_are_refused(spark):
    df = spark.createDataFrame([(1, [1.0] * 64), (2, [-1.0] * 65)], "i int, v array<float>")
    assert df.where("i = 1").select(H.sign_code(F.col("v"))).first()[0] == -1
    with pytest.raises(Exception, match="more than 64"):
        df.select(H.sign_code(F.col("v"))).collect()


def test_the_index_is_partitioned_once(spark, monkeypatch):
    plans = []

    def cut(df):
        plans.append(df._jdf.queryExecution().toString())
        return common_cut(df)
    common_cut = H.cut
    monkeypatch.setattr(H, "cut", cut)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        check(spark, codes(4, 300, 9), codes(4, 300, 9)[::100], 3)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rounds = [p.split("== Physical Plan ==")[1] for p in plans if "radius" in p or "bit_count" in p]
    assert rounds
    for plan in rounds:  # of the join's two sides the probes alone are shuffled by (part, key)
        assert plan.count("Exchange hashpartitioning(part") == 1


def test_sign_code(spark):
    df = spark.createDataFrame([(1, [0.5, -1.0, 2.0]), (2, []), (3, None), (4, [None, 1.0])], "i int, v array<float>")
    assert [r.c for r in df.orderBy("i").select(H.sign_code(F.col("v")).alias("c")).collect()] == [5, 0, None, 1]
