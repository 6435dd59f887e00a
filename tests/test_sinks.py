"""Sinks, helpers and extension points not covered by the registered queries."""
import json
import os

from pyspark.sql import functions as F

from hostlake.functions.scalars import clean_text, sanitize_run_id
from hostlake.operators import normalize as N
from hostlake.operators import sinks as SK
from hostlake.plans.profile import pretty_size, table_profile


def test_jsonl_fanout_quarantine_archive(spark, scratch):
    df = spark.createDataFrame([("r1", "2024-01-02 03:04:05", '{"a": 1}', None)],
                               "request_id string, received_at string, body string, note string") \
        .withColumn("received_at", F.to_timestamp_ntz("received_at"))
    j, q, a = scratch("jsonl"), scratch("q"), scratch("a")
    SK.fanout(df, [lambda d: SK.write_jsonl(d, j), lambda d: SK.write_quarantine(d, q)])
    lines = [json.loads(x[0]) for x in spark.read.text(j).collect()]
    assert lines[0]["note"] is None and lines[0]["request_id"] == "r1"  # NULL fields kept
    assert spark.read.parquet(q).select("y", "m", "d").first() == (2024, 1, 2)
    out = SK.archive_raw(df, a)
    assert out.first().raw_payload_ref == "raw/2024/01/02/r1.json"
    assert spark.read.parquet(a).count() == 1


def test_discover_columns_and_identity_parameter(spark):
    rows = [("r1", json.dumps({"class_name": "GLOBAL", "MonitoredSystemID": "s", "metrics": {"GBL_MEM_UTIL": 1}}))]
    df = spark.createDataFrame(rows, "request_id string, body string") \
        .withColumn("received_at", F.lit("x")).withColumn("raw_payload_ref", F.lit("r"))
    n = N.normalize(df)
    cols = [r[0] for r in N.discover_columns(n, "opsb_agent_node").collect()]
    assert cols[:2] == ["node_short_name", "mem_util_pct"] and cols[-1] == "extra_metrics"
    # a custom identity check: every record is strong only with an IP
    acc, q = N.route(n, strict=True, identity=F.col("node_ipv4_address").isNotNull())
    assert acc.count() == 0 and q.count() == 1


def test_text_helpers(spark):
    r = spark.createDataFrame([("a\tb\nc\rd", "run:2024+01/x")], "t string, r string") \
        .select(clean_text("t"), sanitize_run_id("r")).first()
    assert tuple(r) == ("a b c d", "run_2024_01_x")


def test_table_profile(spark, scratch):
    d = scratch("tp")
    spark.range(1000).repartition(3).write.mode("overwrite").parquet(d)
    r = table_profile(spark, {"t": d}).first()
    assert r.rows == 1000 and r.bytes == sum(os.path.getsize(os.path.join(d.replace("file:", ""), f))
                                             for f in os.listdir(d.replace("file:", "")) if f.endswith(".parquet"))
    sizes = spark.createDataFrame([(5,), (10239,), (10240,), (20 * 1024 * 1024,)], "b bigint") \
        .select(pretty_size("b")).collect()
    assert [x[0] for x in sizes] == ["5 bytes", "10239 bytes", "10 kB", "20 MB"]


def test_unmapped_records_are_kept(spark):
    rows = [("r1", json.dumps([{"class_name": "BRAND_NEW", "MonitoredSystemID": "s", "metrics": {"X": 1}},
                               {"class_name": "GLOBAL", "MonitoredSystemID": "s", "metrics": {"GBL_MEM_UTIL": 1}}]))]
    df = spark.createDataFrame(rows, "request_id string, body string") \
        .withColumn("received_at", F.lit("x")).withColumn("raw_payload_ref", F.lit("r"))
    u = N.unmapped_rows(N.normalize(df)).collect()
    assert [(r.class_name, r.node_short_name, r.extra_metrics) for r in u] == [("BRAND_NEW", "s", {"X": "1"})]


def test_stream_sink_failure_is_quarantined(spark, scratch):
    from hostlake.sources import payloads as PL
    from hostlake.streaming import streams as ST
    archive, lake, ck = scratch("raw"), scratch("lake"), scratch("ck")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(6)
    SK.archive_raw(PL.payloads_from_events(ev), archive)

    def broken(df, batch_id):
        raise RuntimeError("sink down")
    q = ST.stream_agent_metrics(spark, archive, lake, ck, extra_sinks=[broken])
    q.awaitTermination(300)
    assert q.exception() is None
    quar = spark.read.parquet(f"{lake}/_quarantine").collect()
    assert {r.reason for r in quar} == {"sink_write_failed"} and len(quar) == 3
    assert all("sink down" in r.error and r.raw_body for r in quar)


def test_read_payloads_archive_and_day_replay(spark, scratch):
    from hostlake.sources import payloads as PL
    root = scratch("archive").replace("file:", "")
    for day, rid in (("2024/01/02", "req-a"), ("2024/01/02", "req-b"), ("2024/01/03", "req-c")):
        os.makedirs(f"{root}/raw/{day}", exist_ok=True)
        with open(f"{root}/raw/{day}/{rid}.json", "w") as fh:
            fh.write(json.dumps({"class_name": "GLOBAL", "MonitoredSystemID": rid,
                                 "metrics": {"GBL_MEM_UTIL": 1}}, indent=2))
    with open(f"{root}/raw/2024/01/02/.req-x.json.tmp", "w") as fh:
        fh.write("{")
    allp = PL.read_payloads(spark, f"{root}/raw")
    assert sorted(r.request_id for r in allp.collect()) == ["req-a", "req-b", "req-c"]
    day = PL.read_payloads(spark, f"{root}/raw", day="2024/01/02")
    rows = sorted((r.request_id, r.raw_payload_ref) for r in day.collect())
    assert rows == [("req-a", "raw/2024/01/02/req-a.json"), ("req-b", "raw/2024/01/02/req-b.json")]
    n = N.normalize(day).select("request_id", "node_short_name", "class_name").collect()
    assert sorted(tuple(r) for r in n) == [("req-a", "req-a", "GLOBAL"), ("req-b", "req-b", "GLOBAL")]


def test_compaction_and_retention_on_day_partitions(spark, scratch):
    from hostlake.operators import maintenance as MT
    from hostlake.registry import Lake
    lk = Lake(spark, "/root/testdata/sf0.01")
    path = scratch("hist")
    # many small files per day first
    MT.with_event_date(lk.hist).repartition(16).write.mode("overwrite").partitionBy("event_date").parquet(path)
    local = path.replace("file:", "")

    def files(day_dir):
        return [f for f in os.listdir(os.path.join(local, day_dir)) if f.endswith(".parquet")]
    days = sorted(d for d in os.listdir(local) if d.startswith("event_date="))
    before = {d: len(files(d)) for d in days}
    n = MT.compact(spark, path, lk.as_of, older_than_days=7)
    after = {d: len(files(d)) for d in sorted(x for x in os.listdir(local) if x.startswith("event_date="))}
    assert n > 0 and sum(1 for d in after if after[d] == 1) == n
    assert all(after[d] <= before[d] for d in after)
    assert spark.read.parquet(path).count() == lk.hist.count()
    dropped = MT.apply_retention(spark, path, lk.as_of, keep_days=10)
    left = sorted(x for x in os.listdir(local) if x.startswith("event_date="))
    assert len(left) == len(days) - len(dropped) and len(dropped) > 0


def test_archive_has_about_as_many_files_as_days_and_tasks(spark, scratch):
    from pyspark.sql import functions as F

    from hostlake.operators import sinks as SK
    path, days = scratch("raw"), 12
    received = F.timestamp_add("DAY", F.col("id") % days, F.expr("timestamp_ntz'2024-01-01 00:00:00'"))
    rows = spark.range(0, 2400, 1, 16).select(F.concat(F.lit("r"), "id").alias("request_id"), received.alias("received_at"),
                                             F.lit("").alias("raw_payload_ref"), F.lit("{}").alias("body"))
    SK.archive_raw(rows, path)
    back = spark.read.parquet(path)
    assert len(back.inputFiles()) <= days + int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert back.count() == 2400 and back.select("request_id").distinct().count() == 2400


def test_staged_records_are_normalised_once_for_all_tables(spark, scratch, monkeypatch):
    from hostlake.operators import normalize as N
    from hostlake.operators import sinks as SK
    from hostlake.registry import agent_norm
    accepted, _ = N.route(agent_norm(spark, "/root/testdata/sf0.001"), strict=False)
    kept = []
    own = SK.write_staged

    def write(rows, *args, **kwargs):
        kept.append("InMemoryTableScan" in rows._jdf.queryExecution().executedPlan().toString())
        own(rows, *args, **kwargs)

    monkeypatch.setattr(SK, "write_staged", write)
    SK.write_staged_records(accepted, scratch("pending"))
    assert kept == [True] * 5 and not accepted.storageLevel.useMemory
