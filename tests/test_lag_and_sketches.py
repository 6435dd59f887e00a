"""Daily sketches and the lag of several streams."""
import datetime as dt

from pyspark.sql import functions as F

from hostlake.plans import profile as P
from hostlake.streaming import streams as ST
from hostlake.operators import sinks as SK
from hostlake.session import scratch_dir

DAY = 86400


def _history(spark, n_items):
    rows = spark.range(3 * n_items).select(F.lit(7).cast("long").alias("hostid"), (F.col("id") % n_items).alias("itemid"),
                                           ((F.col("id") / n_items).cast("long") * DAY + 10).alias("clock"))
    few = spark.createDataFrame([(8, 1, 5), (8, 1, 5), (8, 2, 2 * DAY + 1), (8, None, 7), (None, 1, 9)], "hostid long, itemid long, clock long")
    return rows.unionByName(few)


def test_sketched_density_is_near_the_exact_one(spark):
    n = 60_000
    inv = spark.createDataFrame([("7", "seven")], "hostid string, name string")
    kept = P.density_sketches(_history(spark, n)).cache()
    got = {r.hostid: r for r in P.host_density_sketched(kept, inv).collect()}
    assert abs(got[7].distinct_items - n) <= 0.02 * n and got[7].samples == 3 * n and got[7].host_name == "seven"
    assert (got[8].distinct_items, got[8].samples, got[8].host_name) == (2, 4, None) and got[None].samples == 1
    assert got[8].last_sample == dt.datetime(1970, 1, 3, 0, 0, 1)
    last = {r.hostid: r for r in P.host_density_sketched(kept, inv, days=1, as_of=2 * DAY + 100).collect()}
    assert set(last) == {7, 8} and last[8].distinct_items == 1 and last[7].samples == n
    assert P.host_density_sketched(kept.limit(0), inv).collect() == []


def test_sketches_of_parts_are_those_of_the_whole(spark):
    h = _history(spark, 500).where("hostid = 7")
    inv = spark.createDataFrame([], "hostid string, name string")
    parts = P.density_sketches(h.where("itemid % 2 = 0")).unionByName(P.density_sketches(h.where("itemid % 2 = 1 OR itemid < 100")))
    assert abs(P.host_density_sketched(parts, inv).first().distinct_items - 500) <= 10


def _newest(spark, lake):
    return {r.source: (r.lag_s, r.rows_seen) for r in ST.ingest_lag(SK.read_table(spark, lake, "lag"), 1000).collect()}


def test_lag_follows_each_source(spark):
    src, nodes, lake, ck = (scratch_dir(spark, x) for x in ("h", "n", "lake", "ck"))
    node = "timestamp_utc_s long, received_at timestamp_ntz, other string"

    def run():
        q = ST.stream_ingest_lag(spark, src, nodes, f"{lake}/lag", ck)
        assert q.awaitTermination(120) and q.exception() is None
    spark.createDataFrame([(100, "x"), (None, "y"), (90, "z")], "clock long, value string").write.mode("append").parquet(src)
    spark.createDataFrame([(None, None, "a")], node).write.mode("append").parquet(nodes)
    run()
    assert _newest(spark, lake) == {"zabbix_history": (900, 2)}
    spark.createDataFrame([(400, dt.datetime(1970, 1, 1, 0, 10, 0, 500_000), "a"), (None, dt.datetime(1970, 1, 1), "b")], node).write.mode("append").parquet(nodes)
    run()
    want = {"zabbix_history": (900, 2), "opsb_agent_node": (600, 1), "opsb_agent_node.received_at": (400, 2)}
    assert _newest(spark, lake) == want
    spark.createDataFrame([(50, "late")], "clock long, value string").write.mode("append").parquet(src)
    run()
    assert _newest(spark, lake) == {**want, "zabbix_history": (900, 3)}
