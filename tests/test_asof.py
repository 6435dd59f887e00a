"""Time-matching operators against brute force on random data."""
import random

import pytest

from hostlake.operators.asof import bucket_join, latest_by, nearest_join


def brute_nearest(left, right):
    out = {}
    for (h, c, lv) in left:
        cands = [r for r in right if r[0] == h and r[4] is not None]
        if not cands:
            out[(h, c, lv)] = None
            continue
        # closest; tie -> earlier right clock; same clock -> highest (ns, itemid)
        best = min(cands, key=lambda r: (abs(r[1] - c), r[1], -r[2], -r[3]))
        out[(h, c, lv)] = (best[4], best[1])
    return out


@pytest.mark.parametrize("seed,target", [(1, None), (2, 10), (3, 7), (4, 3600), (5, 1), (6, 3), (7, 50), (8, 20)])
def test_nearest_join_matches_brute_force(spark, seed, target):
    rnd = random.Random(seed)
    left = [(rnd.randint(0, 3), rnd.randint(0, 100), i) for i in range(120)]
    right, seen = [], set()
    for i in range(80):
        r = (rnd.randint(0, 3), rnd.randint(0, 100), rnd.randint(0, 3), rnd.randint(0, 2),
             None if rnd.random() < 0.1 else float(i))
        if r[:4] not in seen:  # (key, clock, ns, itemid) is unique in history
            seen.add(r[:4])
            right.append(r)
    ldf = spark.createDataFrame(left, "h int, clock bigint, lv int")
    rdf = spark.createDataFrame(right, "h int, clock bigint, ns int, itemid int, value double")
    got = nearest_join(ldf, rdf, by=["h"], values=["value"], tie=["ns", "itemid"], how="left", target_rows=target)
    g = {(r.h, r.clock, r.lv): (None if r.match_clock is None else (r.value, r.match_clock)) for r in got.collect()}
    assert g == brute_nearest(left, right)
    inner = nearest_join(ldf, rdf, by=["h"], values=["value"], tie=["ns", "itemid"], how="inner", target_rows=target)
    assert inner.count() == sum(1 for v in g.values() if v is not None)


def test_nearest_join_channels(spark):
    left = spark.createDataFrame([(1, 10), (1, 20)], "h int, clock bigint")
    right = spark.createDataFrame([(1, 9, "read", 1.0), (1, 21, "read", 2.0), (1, 30, "write", 3.0)],
                                  "h int, clock bigint, role string, value double")
    got = nearest_join(left, right, by=["h"], values=["value"], channel="role", channel_values=["read", "write"],
                       target_rows=1)
    rows = sorted((r.clock, r.read_value, r.write_value) for r in got.collect())
    assert rows == [(10, 1.0, 3.0), (20, 2.0, 3.0)]


def test_equal_distance_prefers_previous(spark):
    left = spark.createDataFrame([(1, 10)], "h int, clock bigint")
    right = spark.createDataFrame([(1, 5, 1.0), (1, 15, 2.0)], "h int, clock bigint, value double")
    assert nearest_join(left, right, by=["h"]).first().value == 1.0


def test_bucket_join_previous_bucket_fallback(spark):
    left = spark.createDataFrame([(1, 610), (1, 1210), (1, 2000)], "h int, clock bigint")
    right = spark.createDataFrame([(1, 601, 5.0, None), (1, 650, 7.0, 1.0), (1, 900, None, 2.0)],
                                  "h int, clock bigint, r double, w double")
    got = sorted(tuple(x) for x in bucket_join(left, right, by=["h"], values=["r", "w"], width=300).collect())
    # 610 -> bucket 2 (max r 7, w 1); 1210 -> bucket 4 empty, previous bucket 3 (w 2, no r); 2000 -> nothing
    assert got == [(1, 610, 7.0, 1.0), (1, 1210, None, 2.0), (1, 2000, None, None)]


def test_latest_by(spark):
    df = spark.createDataFrame([(1, 10, 1, "a"), (1, 10, 2, "b"), (1, 5, 9, "c"), (2, 1, 0, "d")],
                               "k int, clock bigint, ns int, v string")
    got = sorted(tuple(r) for r in latest_by(df, ["k"], ["clock", "ns"], ["v"]).collect())
    assert got == [(1, 10, 2, "b"), (2, 1, 0, "d")]


def test_a_hot_key_is_cut(spark):
    # one key with many rows and a sparse one: the hot key is cut
    left = [(0, c, c) for c in range(0, 2000, 2)] + [(1, 5, 0)]
    right = [(0, c, 0, 0, float(c)) for c in range(1, 2000, 2)] + [(1, 3000, 0, 0, 9.0)]
    ldf = spark.createDataFrame(left, "h int, clock bigint, lid int")
    rdf = spark.createDataFrame(right, "h int, clock bigint, ns int, itemid int, value double")
    got = nearest_join(ldf, rdf, by=["h"], tie=["ns", "itemid"], how="left", target_rows=50)
    g = {(r.h, r.clock): r.value for r in got.collect()}
    assert g[(0, 0)] == 1.0 and g[(0, 1000)] == 999.0 and g[(0, 1998)] == 1997.0 and g[(1, 5)] == 9.0


def test_host_capacity_single_pass_equals_two_step(spark):
    from pyspark.sql import functions as F
    from hostlake.functions.scalars import safe_numeric
    from hostlake.plans import reports as R
    hist = spark.createDataFrame([
        (11, 100, 0, "4"), (11, 200, 5, "8"), (12, 200, 1, "16"), (12, 150, 0, "2"),   # core: two items, same newest clock
        (13, 300, 0, "1024"), (13, 300, 9, "oops"), (14, 250, 0, "2048"),              # memtot: newest row is not numeric
        (21, 50, 0, "2"),                                                              # other host
    ], "itemid bigint, clock bigint, ns int, value string")
    cap = spark.createDataFrame([(11, "1", "core"), (12, "1", "core"), (13, "1", "memtot"), (14, "1", "memtot"),
                                 (21, "2", "core")], "itemid_num bigint, hostid string, role string")
    got = {r.hostid: tuple(r)[1:] for r in R.host_capacity(hist, cap).collect()}
    # two-step reference: latest row per item, then newest (clock, itemid) item per host and role
    last = R.capacity_pick(R.capacity_last(hist, cap))
    want = {}
    for r in last.collect():
        d = want.setdefault(r.hostid, {})
        d[r.role] = (r.value, r.clock)
    for h, d in want.items():
        core, mem = d.get("core", (None, None)), d.get("memtot", (None, None))
        assert got[h] == (core[0], core[1], mem[0], mem[1])
    assert got["1"] == (16.0, 200, None, 300)


def test_burst_and_null_keys(spark):
    # a key with few rows over a year and a burst of many within one minute: only the burst is cut
    from pyspark.sql import functions as F
    burst = [(0, 100 * 3600 + c // 20) for c in range(1200)]
    sparse = [(0, d * 86_400) for d in range(365)] + [(None, 50), (1, 7)]
    ldf = spark.createDataFrame(burst + sparse, "h int, clock bigint")
    rdf = spark.createDataFrame([(h, c + 1, 0, float(c)) for h, c in burst[::60] + sparse], "h int, clock bigint, ns int, value double")
    a = nearest_join(ldf, rdf, by=["h"], tie=["ns"], how="left", target_rows=100)
    b = nearest_join(ldf, rdf, by=["h"], tie=["ns"], how="left", target_rows=None)
    c = nearest_join(ldf, rdf, by=["h"], tie=["ns"], how="left", target_rows=7)
    rows = [sorted(map(repr, x.collect())) for x in (a, b, c)]
    assert rows[0] == rows[1] == rows[2]
    assert a.where("h IS NULL").select("value").first().value is None
    assert a.where(F.col("value").isNull()).count() == 1


@pytest.mark.parametrize("direction", ["nearest", "backward", "forward"])
def test_all_rows_of_one_key_in_ten_seconds_are_spread(spark, direction, monkeypatch):
    from pyspark.sql import functions as F
    from hostlake.operators import asof
    rng = random.Random(4)
    left = [(1, rng.randrange(10), i) for i in range(6000)] + [(2, 5, -1)]
    right = [(1, rng.randrange(0, 10, 3), i % 7, float(i)) for i in range(3000)]
    ldf = spark.createDataFrame(left, "h int, clock bigint, lid int")
    rdf = spark.createDataFrame(right, "h int, clock bigint, ns int, value double").dropDuplicates(["clock", "ns"])
    sizes = []
    ranged = asof._range_of

    def seen(at, cuts):
        sizes.append(cuts)
        return ranged(at, cuts)
    monkeypatch.setattr(asof, "_range_of", seen)
    got = nearest_join(ldf, rdf, by=["h"], tie=["ns"], how="left", direction=direction, target_rows=500)
    whole = nearest_join(ldf, rdf, by=["h"], tie=["ns"], how="left", direction=direction, target_rows=None)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, whole.collect()))
    assert sizes  # the key was cut
    place = F.shiftleft("clock", 20)
    at = ldf.select("h", (place + 1 + F.pmod(F.xxhash64("lid"), F.lit((1 << 20) - 1))).alias("_at"))
    cuts = asof._hot_key_cuts(at, ["h"], 500)
    each = at.join(cuts, "h").select(ranged(F.col("_at"), F.col("_cuts")).alias("r")).groupBy("r").count().collect()
    assert len(each) >= 12 and max(r["count"] for r in each) <= 500 and [r.h for r in cuts.collect()] == [1]


def test_many_ranges_are_looked_up_in_two_steps(spark):
    from pyspark.sql import functions as F
    from hostlake.operators.asof import _range_of
    cuts = list(range(0, 4000, 7))
    df = spark.range(-5, 4100, 3).withColumn("c", F.array(*[F.lit(c).cast("long") for c in cuts]))
    for r in df.select("id", _range_of(F.col("id"), F.col("c")).alias("r")).collect():
        assert r.r == sum(c < r.id for c in cuts)
    assert spark.range(1).select(_range_of(F.lit(3), F.array().cast("array<bigint>")).alias("r")).first().r == 0


def test_latest_by_days_reads_no_more_days_than_it_takes(spark, scratch):
    import os
    from pyspark.sql import functions as F
    from hostlake.operators import maintenance as MT
    from hostlake.operators.asof import latest_by_days
    day = 86_400
    rows = [(i, d * day + 100 * i + n, n, f"{d}-{n}") for i in range(6) for d in range(20) for n in range(3) if d <= 19 - i]
    hist = spark.createDataFrame(rows, "itemid bigint, clock bigint, ns int, value string")
    path = scratch("hist")
    MT.with_event_date(hist).write.partitionBy("event_date").mode("overwrite").parquet(path)
    # an older day that would fail if it were read
    with open(os.path.join(path.replace("file:", ""), "event_date=1970-01-03", "part-bad.parquet"), "w") as fh:
        fh.write("no parquet")
    t = spark.read.schema("itemid bigint, clock bigint, ns int, value string, event_date date").parquet(path)
    want = spark.createDataFrame([(i,) for i in (0, 2, 5)], "itemid bigint")
    got = latest_by_days(t, want, "itemid", ["itemid"], ["clock", "ns"], ["value"])
    assert sorted(tuple(r) for r in got.collect()) == [(i, (19 - i) * day + 100 * i + 2, 2, f"{19 - i}-2") for i in (0, 2, 5)]
    # several items of one key: the newest row of any of them is enough
    both = want.withColumn("k", F.lit("x"))
    (one,) = latest_by_days(t, both, "itemid", ["k"], ["clock", "itemid", "ns"], ["value"]).collect()
    assert tuple(one) == ("x", 19 * day + 2, 0, 2, "19-2")
    with pytest.raises(Exception):  # an item without rows: all days are read
        latest_by_days(t, spark.createDataFrame([(77,)], "itemid bigint"), "itemid", ["itemid"], ["clock", "ns"], ["value"]).collect()


def test_latest_by_days_lists_and_joins_alike(spark, scratch, monkeypatch):
    from hostlake.operators import asof
    from hostlake.operators import maintenance as MT
    from hostlake.registry import Lake
    lk = Lake(spark, "/root/testdata/sf0.001")
    path = scratch("hist")
    MT.partition_history(lk.hist, path)
    t = spark.read.parquet(path)
    ids = lk.hist.select("itemid").distinct()
    want = sorted(tuple(r) for r in latest_by(lk.hist, ["itemid"], ["clock", "ns"], ["value"]).collect())
    for listed in (1000, 3):
        monkeypatch.setattr(asof, "LISTED_KEYS", listed)
        got = asof.latest_by_days(t, ids, "itemid", ["itemid"], ["clock", "ns"], ["value"])
        assert sorted(tuple(r) for r in got.collect()) == want
    empty = t.where("false")
    assert asof.latest_by_days(empty, ids, "itemid", ["itemid"], ["clock", "ns"], ["value"]).count() == 0
