"""Physical-plan properties the library relies on at scale."""
import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

import __spark_entry__ as E
from hostlake.operators import maintenance as MT
from hostlake.operators.sinks import _first_wins
from hostlake.plans import reports as R
from hostlake.registry import Lake

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def tree(p: str) -> str:
    return p.split("\n\n")[0]


def _ancestors(lines, i):
    """Lines of the operators above line ``i`` in an explain tree (smaller indentation)."""
    depth = len(lines[i]) - len(lines[i].lstrip(" :|+-"))
    out = []
    for x in reversed(lines[:i]):
        d = len(x) - len(x.lstrip(" :|+-"))
        if d < depth:
            out.append(x)
            depth = d
    return out


def test_readable_history_never_shuffles_history(spark):
    t = tree(plan(E.queries()["readable_history"](spark, SF)))
    lines = t.splitlines()
    for i, x in enumerate(lines):
        if "Exchange" in x and "BroadcastExchange" not in x:
            # any shuffle must belong to a broadcast (dimension) side, never to history
            assert any("BroadcastExchange" in a for a in _ancestors(lines, i)), x
    assert t.count("BroadcastHashJoin") == 2


def test_top_k_per_host_is_partial_before_shuffle(spark):
    p = plan(E.queries()["host_latest_100"](spark, SF)).split("\n\n")[0]
    lines = [x.strip() for x in p.splitlines()]
    ex = next(i for i, x in enumerate(lines) if "Exchange" in x and "Broadcast" not in x)
    assert any("WindowGroupLimit" in x for x in lines[ex + 1:])  # below the exchange = map side


def test_report_dimensions_are_broadcast(spark):
    lk = Lake(spark, SF)
    t = tree(plan(R.disk_report(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=None, match="bucket")))
    # dimension / capacity joins are broadcast; the only shuffle join is the
    # bucket join of the driver and IO aggregates (both history-sized)
    assert t.count("SortMergeJoin") == 1 and t.count("BroadcastHashJoin") >= 3


def test_dedup_is_partial_aggregation(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("_pos"),
                                  F.lit("f").alias("_file"), F.lit(0).alias("_doc"))
    p = plan(_first_wins(df, ["k"]))
    assert "HashAggregate" in p or "ObjectHashAggregate" in p or "SortAggregate" in p
    assert "partial_min_by" in p and "Window" not in p.split("\n\n")[0]


def test_day_partitions_are_pruned(spark, scratch):
    lk = Lake(spark, SF)
    path = scratch("hist")
    MT.partition_history(lk.hist, path)
    df = spark.read.parquet(path).where((F.col(MT.PARTITION_COL) == "2024-01-05") & (F.col("itemid") == 8))
    p = plan(df)
    assert "PartitionFilters: [isnotnull(event_date" in p and "PushedFilters: [IsNotNull(itemid), EqualTo(itemid,8)]" in p


def test_routing_accepted_records_needs_no_shuffle(spark):
    from hostlake.operators import normalize as N
    from hostlake.sources import payloads as PL
    n = N.normalize(spark.read.parquet(f"{SF}/events.parquet").transform(PL.payloads_from_events))
    acc, _ = N.route(n, strict=True)
    t = tree(plan(acc.select("request_id", "record_pos")))
    # the only exchange is the test binding's own grouping of events into requests
    assert t.replace("BroadcastExchange", "").count("Exchange") == 1 and "Window" not in t


def test_sql_views_match_dataframe_api(spark):
    from hostlake.plans import profile as P
    from hostlake.plans.views import register_views
    lk = Lake(spark, SF)
    register_views(spark, lk.hist, lk.items, lk.inv, lk.as_of)
    got = spark.sql("""
        SELECT item_name AS `__text`, itemid AS `__value`, hostid
        FROM v_zabbix_host_item_catalog WHERE value_type IN (0, 3)""")
    want = P.host_item_catalog(lk.hist, lk.items, lk.inv, lk.as_of).where("value_type IN (0, 3)") \
        .selectExpr("item_name AS `__text`", "itemid AS `__value`", "hostid")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    latest = spark.sql("""
        SELECT itemid, max_by(value_text, struct(clock, itemid)) AS last_value
        FROM v_zabbix_history_readable GROUP BY itemid""")
    assert latest.count() == lk.hist.select("itemid").distinct().count()


def test_report_window_prunes_day_partitions(spark, scratch):
    from hostlake.plans.reports import _window
    lk = Lake(spark, SF)
    path = scratch("hist")
    MT.partition_history(lk.hist, path)
    part = spark.read.parquet(path)
    p = plan(_window(part, lk.as_of, 86400).select("itemid", "clock", "value"))
    scanned = [x for x in p.splitlines() if "PartitionFilters" in x][0]
    assert ">=" in scanned  # the derived day bound reaches the file listing
    # same rows as the clock filter alone
    a = _window(part, lk.as_of, 86400).count()
    b = part.where(F.col("clock") >= lk.as_of - 86400).count()
    assert a == b


def test_unbounded_dimension_falls_back_to_shuffle_join(spark):
    from hostlake import session as S
    lk = Lake(spark, SF)
    want = sorted(map(tuple, R.disk_report(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=None,
                                           match="bucket").collect()))
    old_rows, old_auto = S.DEFAULT_BROADCAST_ROWS, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        S.DEFAULT_BROADCAST_ROWS = 0  # no dimension is provably small
        spark.catalog.clearCache()  # the first run's cached dimension was planned with broadcasts
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        df = R.disk_report(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=None, match="bucket")
        t = tree(plan(df))
        assert "BroadcastHashJoin" not in t and "SortMergeJoin" in t
        assert sorted(map(tuple, df.collect())) == want
    finally:
        S.DEFAULT_BROADCAST_ROWS = old_rows
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old_auto)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_every_bounded_read_prunes_days(spark, scratch):
    from hostlake.plans import panels as PN
    from hostlake.plans import profile as P
    from hostlake.sources import history as HS
    lk = Lake(spark, SF)
    path = scratch("hist")
    MT.partition_history(lk.hist, path)
    hist, at = spark.read.parquet(path), lk.as_of
    readable = P.readable_history(hist, lk.items, lk.inv)
    frames = {
        "catalog": P.host_item_catalog(hist, lk.items, lk.inv, at), "density": P.host_density(hist, lk.inv, at),
        "noisy": P.noisy_items(hist, lk.items, at), "volume": P.collection_volume(hist, at, 86_400),
        "series": P.series_summary(hist, at, 86_400), "disk": P.disk_volume(hist, lk.items, lk.inv, at),
        "panel": PN.panel_timeseries(readable, at - 86_400, at), "window": HS.history_window(hist, at - 86_400, at),
        "report": R.pct_history(hist, lk.items, lk.inv, at)}
    for name, df in frames.items():
        assert "PartitionFilters: [isnotnull(event_date" in plan(df), name
    whole = P.collection_volume(lk.hist, at, 86_400)
    assert sorted(map(repr, frames["volume"].collect())) == sorted(map(repr, whole.collect()))


def test_dimensions_above_the_automatic_limit_are_still_broadcast(spark, monkeypatch):
    from hostlake import session
    from hostlake.plans import profile as P
    lk = Lake(spark, SF)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert tree(plan(P.readable_history(lk.hist, lk.items, lk.inv))).count("BroadcastHashJoin") == 2
        monkeypatch.setattr(session, "DEFAULT_BROADCAST_BYTES", 1000)
        assert "BroadcastHashJoin" not in tree(plan(P.readable_history(lk.hist, lk.items, lk.inv)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_shared_folder_is_asked_for_on_a_cluster(spark, monkeypatch):
    import types

    import pytest

    from hostlake.session import ensure_checkpoint_dir
    conf = types.SimpleNamespace(get=lambda k, d=None: d)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        fake = types.SimpleNamespace(conf=conf, sparkContext=types.SimpleNamespace(master=master))
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(fake)


def test_panel_without_bounds_has_all_samples(spark):
    from hostlake.plans import panels as PN
    from hostlake.plans import profile as P
    from hostlake.registry import QUERIES
    lk = Lake(spark, SF)
    readable = P.readable_history(lk.hist, lk.items, lk.inv)
    want = readable.where("value_num IS NOT NULL").count()
    assert PN.panel_timeseries(readable, None, None).count() == want
    assert QUERIES["panel_timeseries"](spark, SF).count() == want > 0


def test_sides_not_proven_small_are_never_broadcast(spark, monkeypatch):
    """Spark estimates the generated items far too small; its own choice would send them through the driver."""
    from hostlake import session
    from hostlake.operators import inventory as INV
    from hostlake.plans import profile as P
    lk = Lake(spark, SF)
    monkeypatch.setattr(session, "DEFAULT_BROADCAST_ROWS", 0)
    frames = {"attach": INV.attach_host(lk.hist, lk.items), "types": P.value_type_distribution(lk.hist, lk.items),
              "catalog": P.host_item_catalog(lk.hist, lk.items, lk.inv, lk.as_of),
              "disk_items": R.disk_items(lk.items, R.group_hosts(lk.inv, "AGENTLESS_GROUP", with_ip=True)),
              "roles": P.diag_items(lk.items, lk.inv), "density": P.host_density(lk.hist, lk.inv, lk.as_of),
              "latest": P.host_latest(lk.hist, lk.items, lk.inv)}
    for name, df in frames.items():
        assert "BroadcastHashJoin" not in tree(plan(df)), name


def test_filter_on_item_keys_builds_no_keys(spark):
    from hostlake.functions import classify as K
    from hostlake.sources import testbind as tb
    df = tb.items(spark, SF).where(K.disk_item_filter("key_"))
    filters = [x for x in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Filter" in x and "fs.usage" in x]
    assert filters and all("element_at" not in x and "concat(" not in x for x in filters)


def test_payload_texts_are_made_behind_a_shuffle_of_few_fields(spark):
    from hostlake.sources import payloads as PL
    lines = PL.payloads(spark, SF)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    shuffle = [i for i, x in enumerate(lines) if "RepartitionByExpression" in x]
    texts = [i for i, x in enumerate(lines) if "GBL_CPU_TOTAL_UTIL" in x]
    assert len(shuffle) == 1 and texts and max(texts) < shuffle[0]
    assert all("lambda" not in lines[i] for i in texts)
    t = tree(plan(PL.payloads(spark, SF)))
    assert t.count("Exchange") == 1


def test_a_side_of_some_20_mb_is_not_broadcast(spark):
    from hostlake.session import is_small
    side = spark.range(400_000).select("id", F.lpad(F.col("id").cast("string"), 20, "x").alias("name"))
    assert not is_small(side)
    assert is_small(side.limit(100_000))


def test_size_check_reads_no_further_than_its_bounds(spark):
    """16 MB are 1,048,576 rows of one number: the rows behind them, which can't be read, don't matter."""
    from hostlake.session import is_small
    bad = F.raise_error(F.lit("read too far")).cast("long")
    side = spark.range(0, 1_900_000, 1, 1).select(F.when(F.col("id") < 1_500_000, F.col("id")).otherwise(bad).alias("id"))
    assert not is_small(side.where("id >= 0"))


def test_history_is_bound_by_one_scan_of_the_events(spark):
    t = tree(plan(Lake(spark, SF).hist))
    assert t.count("Scan parquet") == 1


def test_payload_texts_are_made_in_methods_that_the_jvm_compiles(spark):
    """A method of more than 8,000 bytes of code is interpreted for good."""
    import re
    from hostlake.sources import payloads as PL
    buf = io.StringIO()
    auto = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the later stages have no code yet
    try:
        with redirect_stdout(buf):
            PL.payloads(spark, SF).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", auto)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", buf.getvalue())]
    assert sizes and max(sizes) < 8000


def test_throughput_of_both_directions_reads_the_payloads_once(spark):
    assert tree(plan(E.queries()["net_throughput"](spark, SF))).count("Scan parquet") == 1
