"""Named queries over a test-data directory: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query binds the lake tables from the whole input tables of ``sf_dir``
(see ``sources.testbind``) and runs one operator or report on them.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fs as FS
from .plans import reports as R
from .sources import testbind as tb

DAY = 86_400
ALL_DAYS = None  # no bound: whole tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


class Lake:
    """Lake tables bound to one test-data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.hist = tb.history(spark, sf_dir)
        self.items = tb.items(spark, sf_dir)
        self.inv = tb.inventory(spark, sf_dir)
        self._as_of = None

    @property
    def as_of(self) -> int:
        """Report reference time: the newest history clock (one scalar job per query)."""
        if self._as_of is None:
            self._as_of = int(self.hist.agg(F.max("clock")).first()[0])
        return self._as_of


# --------------------------------------------------------------------------- reports

@register("cpu_mem_report")
def q_cpu_mem_report(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return R.cpu_mem_report(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=ALL_DAYS)


@register("cpu_mem_report_1d")
def q_cpu_mem_report_1d(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return R.cpu_mem_report(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=DAY)


@register("capacity_fill_rate")
def q_capacity_fill_rate(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return R.capacity_fill_rate(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=ALL_DAYS)


@register("disk_report_nearest")
def q_disk_report_nearest(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return R.disk_report(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=ALL_DAYS, match="nearest")


@register("disk_report_bucket")
def q_disk_report_bucket(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return R.disk_report(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=ALL_DAYS, match="bucket", width=300)


@register("disk_report_bucket_1d")
def q_disk_report_bucket_1d(spark, sf_dir):
    """Bucket form with day-wide buckets, so the sparse test data really meets IO samples."""
    lk = Lake(spark, sf_dir)
    return R.disk_report(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=ALL_DAYS, match="bucket", width=DAY)


# --------------------------------------------------------------------------- views, profile, diagnostics

from .plans import profile as P  # noqa: E402


@register("readable_history")
def q_readable_history(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return P.readable_history(lk.hist, lk.items, lk.inv)


@register("host_item_catalog")
def q_host_item_catalog(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return P.host_item_catalog(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=7 * DAY)


@register("value_type_distribution")
def q_value_type_distribution(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return P.value_type_distribution(lk.hist, lk.items)


@register("host_density")
def q_host_density(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return P.host_density(lk.hist, lk.inv, lk.as_of, lookback_s=DAY, top=50)


@register("noisy_items")
def q_noisy_items(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return P.noisy_items(lk.hist, lk.items, lk.as_of, lookback_s=DAY, top=30)


@register("collection_volume")
def q_collection_volume(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return P.collection_volume(lk.hist, lk.as_of, lookback_s=ALL_DAYS, width=300)


@register("series_summary")
def q_series_summary(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return P.series_summary(lk.hist, lk.as_of, lookback_s=ALL_DAYS)


@register("latest_per_item")
def q_latest_per_item(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return P.latest_per_item(lk.hist, lk.items, lk.inv)


@register("host_latest_100")
def q_host_latest_100(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return P.host_latest(lk.hist, lk.items, lk.inv, n=100)


@register("diag_items")
def q_diag_items(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return P.diag_items(lk.items, lk.inv)


@register("diag_presence")
def q_diag_presence(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return P.diag_presence(lk.hist, lk.items, lk.inv)


@register("diag_roles")
def q_diag_roles(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return P.diag_roles(lk.items, lk.inv)


@register("diag_histogram")
def q_diag_histogram(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return P.diag_histogram(lk.hist, lk.items, lk.inv)


@register("diag_coverage")
def q_diag_coverage(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return P.diag_coverage(lk.hist, lk.items, lk.inv)


@register("disk_volume")
def q_disk_volume(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return P.disk_volume(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=DAY)


@register("mount_key_audit")
def q_mount_key_audit(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return P.mount_key_audit(lk.items, top=20)


# --------------------------------------------------------------------------- dashboard panels (all hosts)

from .plans import panels as PN  # noqa: E402


@register("host_list")
def q_host_list(spark, sf_dir):
    return PN.host_list(Lake(spark, sf_dir).inv)


@register("item_list")
def q_item_list(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return PN.item_list(P.host_item_catalog(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=7 * DAY))


@register("host_info")
def q_host_info(spark, sf_dir):
    return PN.host_info(Lake(spark, sf_dir).inv)


@register("panel_timeseries")
def q_panel_timeseries(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    r = P.readable_history(lk.hist, lk.items, lk.inv)
    return PN.panel_timeseries(r, ALL_DAYS, lk.as_of)


# --------------------------------------------------------------------------- agent payloads

from .functions import agent_mapping as AM  # noqa: E402
from .operators import normalize as N  # noqa: E402
from .plans import agent as AG  # noqa: E402
from .sources import payloads as PL  # noqa: E402

AGENT_TABLES = ["opsb_agent_node", "opsb_agent_disk", "opsb_agent_filesys", "opsb_agent_cpu", "opsb_agent_netif"]


def _sorted_keys(m):
    return F.array_join(F.array_sort(F.map_keys(m)), ",")


def agent_norm(spark, sf_dir):
    return N.normalize(PL.payloads(spark, sf_dir))


def agent_table(spark, sf_dir, table, norm=None):
    """Agent lake table: records accepted under the default (lenient) routing."""
    norm = agent_norm(spark, sf_dir) if norm is None else norm
    accepted, _ = N.route(norm, strict=False)
    return N.to_table_rows(accepted, table)


def _table_view(df):
    return df.select(*[c for c in df.columns if c != "extra_metrics"],
                     _sorted_keys(F.col("extra_metrics")).alias("extra_metric_keys"))


@register("normalize_records")
def q_normalize_records(spark, sf_dir):
    n = agent_norm(spark, sf_dir)
    return n.select("request_id", "record_pos", "class_name", "target_table", "datasource", "source",
                    "node_fqdn", "node_short_name", "node_ipv4_address",
                    F.col("timestamp_utc_s").try_cast("bigint").alias("timestamp_utc_s"),
                    "received_at", "raw_payload_ref",
                    _sorted_keys(F.col("metrics")).alias("metric_keys"),
                    _sorted_keys(F.col("extra_metrics")).alias("extra_keys"))


def _reg_table(table):
    short = table.replace("opsb_agent_", "")

    @register(f"agent_{short}_rows")
    def q(spark, sf_dir):
        return _table_view(agent_table(spark, sf_dir, table))
    return q


for _t in AGENT_TABLES:
    _reg_table(_t)


@register("route_strict_quarantine")
def q_route_strict_quarantine(spark, sf_dir):
    _, q = N.route(agent_norm(spark, sf_dir), strict=True)
    return q


@register("route_strict_accepted")
def q_route_strict_accepted(spark, sf_dir):
    a, _ = N.route(agent_norm(spark, sf_dir), strict=True)
    return a.select("request_id", "record_pos", "class_name", "target_table")


@register("route_lenient_quarantine")
def q_route_lenient_quarantine(spark, sf_dir):
    _, q = N.route(agent_norm(spark, sf_dir), strict=False)
    return q


@register("request_summary")
def q_request_summary(spark, sf_dir):
    return N.request_summary(N.normalize(PL.payloads(spark, sf_dir), keep_empty=True), strict=True)


def _node(spark, sf_dir):
    return agent_table(spark, sf_dir, "opsb_agent_node")


@register("node_list")
def q_node_list(spark, sf_dir):
    return PN.node_list(_node(spark, sf_dir))


@register("node_info")
def q_node_info(spark, sf_dir):
    n = _node(spark, sf_dir).where(F.col("node_short_name").isNotNull())
    return PN.node_info(n)


@register("node_cpu_mem")
def q_node_cpu_mem(spark, sf_dir):
    return PN.node_cpu_mem(_node(spark, sf_dir))


@register("node_disk_util")
def q_node_disk_util(spark, sf_dir):
    return PN.node_disk_util(agent_table(spark, sf_dir, "opsb_agent_disk"))


@register("node_fs_util")
def q_node_fs_util(spark, sf_dir):
    return PN.node_fs_util(agent_table(spark, sf_dir, "opsb_agent_filesys"))


@register("net_throughput")
def q_net_throughput(spark, sf_dir):
    return PN.net_throughput(agent_table(spark, sf_dir, "opsb_agent_netif"))


@register("node_profile")
def q_node_profile(spark, sf_dir):
    return AG.node_profile(_node(spark, sf_dir), top=50)


@register("freshness")
def q_freshness(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return AG.freshness(lk.hist, _node(spark, sf_dir), lk.as_of)


@register("identity_overlap")
def q_identity_overlap(spark, sf_dir):
    return AG.identity_overlap(tb.inventory(spark, sf_dir), _node(spark, sf_dir))


@register("host_unified")
def q_host_unified(spark, sf_dir):
    return AG.host_bridge(tb.inventory(spark, sf_dir), _node(spark, sf_dir))


@register("name_bridge")
def q_name_bridge(spark, sf_dir):
    return AG.name_bridge(tb.inventory(spark, sf_dir), _node(spark, sf_dir), top=50)


# --------------------------------------------------------------------------- staged files and lake writes

from .operators import sinks as SK  # noqa: E402
from .session import bounded_broadcast, scratch_dir  # noqa: E402
from .sources import history as HS  # noqa: E402

HISTORY_TYPES = {"itemid": "BIGINT", "hostid": "BIGINT", "clock": "BIGINT", "ns": "INTEGER", "value_type": "SMALLINT"}
HISTORY_COLS = ["itemid", "hostid", "clock", "ns", "value", "value_type"]


def _history_staged_run(spark, sf_dir, max_records=5000):
    """Stage history in overlapping 1-day fetch windows (text rows re-read at each
    window edge, error rows twice inside their window), load with copy + conflict
    target into a fresh lake; return (lake, ledger, staged_rows_frame)."""
    lk = Lake(spark, sf_dir)
    t0 = int(lk.hist.agg(F.min("clock")).first()[0])
    win = HS.history_windows(lk.hist, t0, DAY, overlap=3600)
    dup = win.where(F.col("value_type") == 4)
    staged = win.unionByName(dup).select(*[F.col(c).cast("string") for c in HISTORY_COLS], "window_id")
    pending, lake = scratch_dir(spark, "pending"), scratch_dir(spark, "lake")
    SK.write_staged(staged, pending, "zabbix_history", "copy", key=["itemid", "clock", "ns"],
                    column_types=HISTORY_TYPES, add_updated_at=False, group_cols=["window_id"],
                    max_records=max_records)
    ledger = SK.load_pending(spark, pending, lake, partition_tables={"zabbix_history": "event_date"})
    return lake, ledger, staged


@register("staged_history_roundtrip")
def q_staged_history_roundtrip(spark, sf_dir):
    lake, _, _ = _history_staged_run(spark, sf_dir)
    return SK.read_table(spark, lake, "zabbix_history").select(*HISTORY_COLS)


@register("load_summary")
def q_load_summary(spark, sf_dir):
    _, ledger, _ = _history_staged_run(spark, sf_dir, max_records=1_000_000)
    return SK.load_summary(ledger)


@register("staged_inventory_upsert")
def q_staged_inventory_upsert(spark, sf_dir):
    """Two upsert runs: an older version of every host, then the current one."""
    inv = tb.inventory(spark, sf_dir).select("hostid", "name", "status", "primary_ip", "monitored_by",
                                             "host_groups", "templates")
    old = inv.withColumn("name", F.concat(F.lit("old-"), F.col("name"))).withColumn("status", F.lit("Disabled"))
    lake = scratch_dir(spark, "lake")
    meta = dict(key=["hostid"], json_columns=["host_groups", "templates"], source="inventory")
    p1, p2 = scratch_dir(spark, "pending"), scratch_dir(spark, "pending")
    SK.write_staged(old, p1, "zabbix_inventory", "upsert", **meta)
    SK.load_pending(spark, p1, lake)
    SK.write_staged(inv, p2, "zabbix_inventory", "upsert", **meta)
    SK.load_pending(spark, p2, lake)
    return SK.read_table(spark, lake, "zabbix_inventory").select(
        "hostid", "name", "status", "primary_ip", "monitored_by",
        F.col("host_groups").alias("host_groups_json"), F.col("templates").alias("templates_json"))


@register("staged_items_insert")
def q_staged_items_insert(spark, sf_dir):
    """Items loaded with ``insert``; a second run re-sending every item fails whole (key conflicts)."""
    it = tb.items(spark, sf_dir)
    lake = scratch_dir(spark, "lake")
    p1, p2 = scratch_dir(spark, "pending"), scratch_dir(spark, "pending")
    SK.write_staged(it, p1, "zabbix_items", "insert", key=["itemid"], add_updated_at=False)
    SK.load_pending(spark, p1, lake)
    FS.delete(spark, p1)  # loaded
    SK.write_staged(it, p2, "zabbix_items", "insert", key=["itemid"], add_updated_at=False)
    SK.load_pending(spark, p2, lake)
    return SK.read_table(spark, lake, "zabbix_items")


@register("dedup_history")
def q_dedup_history(spark, sf_dir):
    """Overlapping fetch windows unioned, then de-duplicated by (itemid, clock, ns)."""
    lk = Lake(spark, sf_dir)
    t0 = int(lk.hist.agg(F.min("clock")).first()[0])
    win = HS.history_windows(lk.hist, t0, DAY, overlap=3600)
    return HS.dedup_history(win.select(*HISTORY_COLS))


# --------------------------------------------------------------------------- API dumps

from .operators import inventory as INV  # noqa: E402
from .sources import dumps as DU  # noqa: E402

COLLECTED_AT = "2024-01-31T00:00:00Z"


def _dumps(spark, sf_dir):
    d = scratch_dir(spark, "dumps")
    DU.write_dumps_from_customer(spark, sf_dir, tb.items(spark, sf_dir), d)
    return d


def _host_view(h):
    return h.select(
        "hostid", "name", "description", "status", "primary_ip",
        F.array_join("secondary_ips", ",").alias("secondary_ips"), "monitored_by",
        F.array_join("host_groups", ",").alias("host_groups"),
        F.array_join("templates", ",").alias("templates"),
        F.array_join(F.transform("interfaces", lambda i: F.concat_ws(":", i["type"], i["active_address"],
                                                                     F.coalesce(i["error"], F.lit("-")))), ",").alias("interfaces"),
        F.array_join(F.transform("macros", lambda m: F.concat_ws("=", m["macro"], m["value"])), ",").alias("macros"),
        F.array_join(F.transform("tags", lambda t: F.concat_ws("=", t["tag"], t["value"])), ",").alias("tags"),
        "collected_at")


@register("host_dump_decode")
def q_host_dump_decode(spark, sf_dir):
    d = _dumps(spark, sf_dir)
    return _host_view(INV.format_hosts(DU.read_host_dump(spark, d), collected_at=COLLECTED_AT))


@register("group_filter")
def q_group_filter(spark, sf_dir):
    d = _dumps(spark, sf_dir)
    h = INV.format_hosts(DU.read_host_dump(spark, d), target_groups=["AGENTLESS_GROUP"], collected_at=COLLECTED_AT)
    return h.select("hostid", "name", "status")


@register("host_counts")
def q_host_counts(spark, sf_dir):
    d = _dumps(spark, sf_dir)
    return SK.host_counts(INV.format_hosts(DU.read_host_dump(spark, d), collected_at=COLLECTED_AT))


@register("item_decode")
def q_item_decode(spark, sf_dir):
    d = _dumps(spark, sf_dir)
    return INV.format_items(DU.read_item_dump(spark, d))


@register("template_decode")
def q_template_decode(spark, sf_dir):
    d = _dumps(spark, sf_dir)
    t = INV.format_templates(DU.read_template_dump(spark, d))
    return t.select("name", "host", "description", F.array_join("template_groups", ",").alias("template_groups"),
                    F.array_join("parent_templates", ",").alias("parent_templates"))


@register("item_map")
def q_item_map(spark, sf_dir):
    return INV.item_map(tb.items(spark, sf_dir))


@register("attach_host")
def q_attach_host(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return INV.attach_host(lk.hist, lk.items).select(*HISTORY_COLS)


# --------------------------------------------------------------------------- streaming

from .operators import latest as LV  # noqa: E402
from .streaming import streams as ST  # noqa: E402


def _await(q, timeout_s: int = 3600):
    """Wait for an available-now query to finish; never return partial output."""
    finished = q.awaitTermination(timeout_s)
    if not finished:
        q.stop()
        raise TimeoutError(f"stream {q.name or q.id} did not finish within {timeout_s} s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _stream_history_lake(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    t0 = int(lk.hist.agg(F.min("clock")).first()[0])
    win = HS.history_windows(lk.hist, t0, DAY, overlap=3600)
    staged = win.select(*[F.col(c).cast("string") for c in HISTORY_COLS], "window_id")
    pending, lake, ck = scratch_dir(spark, "pending"), scratch_dir(spark, "lake"), scratch_dir(spark, "ckpt")
    SK.write_staged(staged, pending, "zabbix_history", "copy", key=["itemid", "clock", "ns"], column_types=HISTORY_TYPES,
                    add_updated_at=False, group_cols=["window_id"], files=8)
    _await(ST.stream_load_pending(spark, pending, lake, ck, max_files_per_trigger=2,
                                  partition_tables={"zabbix_history": "event_date"},
                                  latest_tables=["zabbix_history"]))
    return lake


@register("stream_history_load")
def q_stream_history_load(spark, sf_dir):
    """Staged history documents loaded by the streaming loader, two files per micro-batch."""
    return SK.read_table(spark, _stream_history_lake(spark, sf_dir), "zabbix_history").select(*HISTORY_COLS)


@register("stream_latest_values")
def q_stream_latest_values(spark, sf_dir):
    """``latest_values`` maintained by the streaming loader in the same micro-batches."""
    return LV.latest_rows(spark, _stream_history_lake(spark, sf_dir))


@register("stream_agent_node")
def q_stream_agent_node(spark, sf_dir):
    """Payloads archived by day, streamed through normalise -> route -> agent tables."""
    archive, lake, ck = scratch_dir(spark, "raw"), scratch_dir(spark, "lake"), scratch_dir(spark, "ckpt")
    SK.archive_raw(PL.payloads(spark, sf_dir), archive)
    _await(ST.stream_agent_metrics(spark, archive, lake, ck, strict=False, max_files_per_trigger=4))
    rows = spark.read.parquet(f"{lake}/opsb_agent_node/data").drop("batch_id")
    return _table_view(rows)


def _history_files(spark, sf_dir):
    d = scratch_dir(spark, "hist")
    Lake(spark, sf_dir).hist.repartition(8).write.mode("overwrite").parquet(d)
    return d


@register("stream_volume")
def q_stream_volume(spark, sf_dir):
    """5-minute volume per host from a history stream (watermark wider than the input's disorder)."""
    src, lake, ck = _history_files(spark, sf_dir), scratch_dir(spark, "lake"), scratch_dir(spark, "ckpt")
    _await(ST.stream_volume(spark, src, f"{lake}/volume", ck, watermark="40 days", max_files_per_trigger=2))
    return SK.read_table(spark, lake, "volume")


@register("stream_freshness")
def q_stream_freshness(spark, sf_dir):
    src, out, ck = _history_files(spark, sf_dir), scratch_dir(spark, "fresh"), scratch_dir(spark, "ckpt")
    _await(ST.stream_freshness(spark, src, out, ck))
    return spark.read.parquet(out)


# --------------------------------------------------------------------------- maintenance, loader errors

from .operators import maintenance as MT  # noqa: E402


def _partitioned_history(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    path = scratch_dir(spark, "history")
    MT.partition_history(lk.hist, path)
    return lk, path


@register("partition_counts")
def q_partition_counts(spark, sf_dir):
    """Rows per day partition of the date-partitioned history."""
    _, path = _partitioned_history(spark, sf_dir)
    return spark.read.parquet(path).groupBy(MT.PARTITION_COL).agg(F.count(F.lit(1)).alias("rows"))


@register("apply_retention")
def q_apply_retention(spark, sf_dir):
    """History after dropping day partitions older than 15 days before as_of."""
    lk, path = _partitioned_history(spark, sf_dir)
    MT.apply_retention(spark, path, lk.as_of, keep_days=15)
    return spark.read.parquet(path).select(*HISTORY_COLS)


@register("compact")
def q_compact(spark, sf_dir):
    """History after compacting day partitions older than 7 days (content unchanged)."""
    lk, path = _partitioned_history(spark, sf_dir)
    MT.compact(spark, path, lk.as_of, older_than_days=7)
    return spark.read.parquet(path).select(*HISTORY_COLS)


# ---- fixed values: kinds of staged documents built per customer (custkey % 8) -----------
DOC_KINDS = ["insert", "upsert", "copy", "no_table", "bad_method", "upsert_no_key", "data_not_list", "empty"]
# -----------------------------------------------------------------------------------------


@register("load_errors")
def q_load_errors(spark, sf_dir):
    """One staged document per customer, a valid or an invalid shape by custkey % 8;
    the loader's ledger grouped by status and error."""
    cu = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet")
    kind = F.element_at(F.array(*[F.lit(k) for k in DOC_KINDS]), F.pmod(F.col("c_custkey"), F.lit(8)).cast("int") + 1)
    rec = F.to_json(F.struct(F.col("c_custkey").cast("string").alias("custkey"), F.col("c_name").alias("name"),
                             F.col("c_mktsegment").alias("segment")))
    meta = (F.when(kind == "insert", F.lit('{"table":"cust_insert","method":"INSERT","conflict_target":["custkey"]}'))
            .when(kind == "upsert", F.lit('{"table":"cust_upsert","method":"upsert","conflict_target":["custkey"]}'))
            .when(kind == "copy", F.lit('{"table":"cust_copy","method":"copy"}'))
            .when(kind == "no_table", F.lit('{"method":"copy"}'))
            .when(kind == "bad_method", F.lit('{"table":"cust_copy","method":"merge"}'))
            .when(kind == "upsert_no_key", F.lit('{"table":"cust_upsert","method":"upsert"}'))
            .when(kind == "data_not_list", F.lit('{"table":"cust_copy","method":"copy"}'))
            .otherwise(F.lit('{"table":"cust_copy","method":"copy"}')))
    data = (F.when(kind == "data_not_list", rec).when(kind == "empty", F.lit("[]"))
            .otherwise(F.concat(F.lit("["), rec, F.lit("]"))))
    doc = F.concat(F.lit('{"meta":'), meta, F.lit(',"data":'), data, F.lit("}"))
    pending, lake = scratch_dir(spark, "pending"), scratch_dir(spark, "lake")
    cu.select(doc.alias("value")).write.mode("append").text(pending)
    SK._rename_json(spark, pending)
    ledger = SK.load_pending(spark, pending, lake)
    return ledger.groupBy("status", "error").agg(F.count(F.lit(1)).alias("documents"),
                                                 F.sum("rows").cast("bigint").alias("rows"))


@register("stream_quarantine")
def q_stream_quarantine(spark, sf_dir):
    """Quarantine written by the streaming agent ingest (lenient mode)."""
    archive, lake, ck = scratch_dir(spark, "raw"), scratch_dir(spark, "lake"), scratch_dir(spark, "ckpt")
    SK.archive_raw(PL.payloads(spark, sf_dir), archive)
    _await(ST.stream_agent_metrics(spark, archive, lake, ck, strict=False, max_files_per_trigger=4))
    return spark.read.parquet(f"{lake}/_quarantine").select("request_id", "reason", "weak_record_count", "total_records")


@register("table_profile")
def q_table_profile(spark, sf_dir):
    """Rows / bytes of the tables the lake is bound to (no DuckDB oracle: file sizes)."""
    base = sf_dir.rstrip("/")
    return P.table_profile(spark, {t: f"{base}/{t}.parquet" for t in ("events", "customer")})


@register("stream_history_dedup")
def q_stream_history_dedup(spark, sf_dir):
    """Overlapping fetch windows streamed through watermark de-duplication
    (delay wider than the input's disorder, so no copy is late)."""
    lk = Lake(spark, sf_dir)
    t0 = int(lk.hist.agg(F.min("clock")).first()[0])
    src, out, ck = scratch_dir(spark, "win"), scratch_dir(spark, "dedup"), scratch_dir(spark, "ckpt")
    HS.history_windows(lk.hist, t0, DAY, overlap=3600).select(*HISTORY_COLS).repartition(8) \
        .write.mode("overwrite").parquet(src)
    _await(ST.stream_history_dedup(spark, src, out, ck, watermark="40 days", max_files_per_trigger=2))
    return spark.read.parquet(out).select(*HISTORY_COLS)


# --------------------------------------------------------------------------- report building blocks (SURVEY build keys)

from .functions import classify as KC  # noqa: E402
from .functions.scalars import safe_numeric as _safe_numeric  # noqa: E402
from .operators.asof import bucket_join as _bucket_join  # noqa: E402
from .operators.asof import item_row_counts as _item_row_counts  # noqa: E402
from .operators.asof import nearest_join as _nearest_join  # noqa: E402

GROUP = "AGENTLESS_GROUP"


@register("agentless_hosts")
def q_agentless_hosts(spark, sf_dir):
    return R.group_hosts(tb.inventory(spark, sf_dir), GROUP, with_ip=True)


@register("classify_cpu_items")
def q_classify_cpu_items(spark, sf_dir):
    """The group's ssh/winrm items with their CPU/memory role (NULL when none)."""
    lk = Lake(spark, sf_dir)
    hosts = R.group_hosts(lk.inv, GROUP)
    return (lk.items.where(KC.cpu_mem_prefilter("key_")).join(bounded_broadcast(hosts.select("hostid")), "hostid")
            .select(F.col("itemid").try_cast("bigint").alias("itemid_num"), "hostid",
                    KC.cpu_mem_role("key_").alias("role")))


@register("classify_capacity_items")
def q_classify_capacity_items(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return R.capacity_items(lk.items, R.group_hosts(lk.inv, GROUP))


@register("classify_disk_items")
def q_classify_disk_items(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return R.disk_items(lk.items, R.group_hosts(lk.inv, GROUP, with_ip=True))


@register("recent_history")
def q_recent_history(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return HS.within(lk.hist, lk.as_of - DAY)


@register("safe_numeric")
def q_safe_numeric(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return lk.hist.select("itemid", "clock", "ns", "value", _safe_numeric("value").alias("value_num"))


@register("pct_history")
def q_pct_history(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return R.pct_history(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=ALL_DAYS)


@register("nearest_cpu_mem")
def q_nearest_cpu_mem(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return R.cpu_with_mem(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=ALL_DAYS)


def _cpu_mem_dir(spark, sf_dir, direction):
    lk = Lake(spark, sf_dir)
    pct = R.pct_history(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=ALL_DAYS)
    cpu = pct.where(F.col("role") == "cpu").select("hostid", "clock", F.col("value").alias("cpu_value"))
    mem = pct.where(F.col("role") == "mem").select("hostid", "clock", "ns", "itemid", "value")
    m = _nearest_join(cpu, mem, by=["hostid"], values=["value"], tie=["ns", "itemid"], how="left",
                      direction=direction)
    return m.select("hostid", "clock", "cpu_value", F.col("value").alias("mem_value"))


@register("locf_cpu_mem")
def q_locf_cpu_mem(spark, sf_dir):
    """Last memory sample at or before each CPU sample (last observation carried forward)."""
    return _cpu_mem_dir(spark, sf_dir, "backward")


@register("nocb_cpu_mem")
def q_nocb_cpu_mem(spark, sf_dir):
    """First memory sample at or after each CPU sample (next observation carried backward)."""
    return _cpu_mem_dir(spark, sf_dir, "forward")


def _cap_items(lk):
    return R.capacity_items(lk.items, R.group_hosts(lk.inv, GROUP))


@register("capacity_last")
def q_capacity_last(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return R.capacity_last(lk.hist, _cap_items(lk))


@register("capacity_pick")
def q_capacity_pick(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return R.capacity_pick(R.capacity_last(lk.hist, _cap_items(lk)))


@register("host_capacity")
def q_host_capacity(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return R.host_capacity(lk.hist, _cap_items(lk))


@register("item_counts")
def q_item_counts(spark, sf_dir):
    """Rows per capacity item over all history, zero for items without rows."""
    lk = Lake(spark, sf_dir)
    return _item_row_counts(_cap_items(lk), lk.hist, item_key="itemid_num", hist_key="itemid")


def _disk(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return R.disk_parts(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=ALL_DAYS)


@register("disk_history")
def q_disk_history(spark, sf_dir):
    return _disk(spark, sf_dir)["hist"]


@register("disk_driver")
def q_disk_driver(spark, sf_dir):
    return _disk(spark, sf_dir)["driver"]


@register("mount_capacity")
def q_mount_capacity(spark, sf_dir):
    return _disk(spark, sf_dir)["capacity"]


@register("io_bucket")
def q_io_bucket(spark, sf_dir):
    return R.io_buckets(_disk(spark, sf_dir)["io"], width=300)


@register("nearest_disk_io")
def q_nearest_disk_io(spark, sf_dir):
    d = _disk(spark, sf_dir)
    return R.io_nearest(d["driver"], d["io"])


@register("bucket_disk_io")
def q_bucket_disk_io(spark, sf_dir):
    d = _disk(spark, sf_dir)
    io = d["io"].select("os_kind", "hostid", "mount_key", "clock",
                        F.when(F.col("role") == "read", F.col("value")).alias("read_kbps"),
                        F.when(F.col("role") == "write", F.col("value")).alias("write_kbps"))
    key = ["os_kind", "hostid", "mount_key"]
    return _bucket_join(d["driver"].select(*key, "clock"), io, by=key, values=["read_kbps", "write_kbps"], width=300)


@register("history_window")
def q_history_window(spark, sf_dir):
    """One fetch window: the last day before as_of, re-reading 60 s of overlap."""
    lk = Lake(spark, sf_dir)
    return HS.history_window(lk.hist, lk.as_of - DAY, lk.as_of, overlap=60).select(*HISTORY_COLS, "window_from", "window_till")


@register("explode_records")
def q_explode_records(spark, sf_dir):
    return N.explode_records(PL.payloads(spark, sf_dir)).select("request_id", "record_pos", "parse_error")


@register("metric_pairs")
def q_metric_pairs(spark, sf_dir):
    """Raw metric names found per record (wrapper object, else prefixed top-level keys)."""
    n = N.explode_records(PL.payloads(spark, sf_dir))
    pairs = N._metric_pairs(F.col("record_map"), F.try_parse_json("record"),
                            tuple(AM.load_mapping()["class_prefix_map"]))
    return n.select("request_id", "record_pos", _sorted_keys(pairs).alias("metric_names"))


@register("detect_class")
def q_detect_class(spark, sf_dir):
    return agent_norm(spark, sf_dir).select("request_id", "record_pos", "class_name", "target_table")


@register("weak_identity")
def q_weak_identity(spark, sf_dir):
    return agent_norm(spark, sf_dir).select("request_id", "record_pos", F.coalesce("weak_identity", F.lit(True)).alias("weak"))


# --------------------------------------------------------------------------- maintained latest values

from .operators import latest as LV  # noqa: E402


def _latest_lake(spark, sf_dir, batches: int = 4):
    """``latest_values`` built incrementally from history in consecutive time slices."""
    lk = Lake(spark, sf_dir)
    lo = int(lk.hist.agg(F.min("clock")).first()[0])
    span = (lk.as_of - lo) // batches + 1
    lake = scratch_dir(spark, "lake")
    for i in range(batches):
        part = lk.hist.where((F.col("clock") >= lo + i * span) & (F.col("clock") < lo + (i + 1) * span))
        LV.update_latest(spark, lake, part, batch_id=f"slice-{i}")
    return lk, LV.latest_rows(spark, lake)


@register("latest_values")
def q_latest_values(spark, sf_dir):
    _, latest = _latest_lake(spark, sf_dir)
    return latest


@register("cpu_mem_report_latest")
def q_cpu_mem_report_latest(spark, sf_dir):
    """CPU/memory report whose capacity comes from the maintained latest-value table."""
    lk, latest = _latest_lake(spark, sf_dir)
    return R.cpu_mem_report(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=ALL_DAYS, latest=latest)


@register("capacity_fill_rate_latest")
def q_capacity_fill_rate_latest(spark, sf_dir):
    lk, latest = _latest_lake(spark, sf_dir)
    return R.capacity_fill_rate(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=ALL_DAYS, latest=latest)


@register("disk_report_bucket_latest")
def q_disk_report_bucket_latest(spark, sf_dir):
    lk, latest = _latest_lake(spark, sf_dir)
    return R.disk_report(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=ALL_DAYS, match="bucket", width=DAY,
                         latest=latest)


@register("cpu_mem_report_partitioned")
def q_cpu_mem_report_partitioned(spark, sf_dir):
    """1-day CPU/memory report over the day-partitioned history table (one day partition
    range is listed and read; the binding's derived history is written there first)."""
    lk, path = _partitioned_history(spark, sf_dir)
    hist = spark.read.parquet(path)
    return R.cpu_mem_report(hist, lk.items, lk.inv, lk.as_of, lookback_s=DAY)


@register("cpu_mem_report_ordered")
def q_cpu_mem_report_ordered(spark, sf_dir):
    """Report as displayed: ordered by host, newest sample first (a global range sort)."""
    lk = Lake(spark, sf_dir)
    return R.cpu_mem_report(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=ALL_DAYS, ordered=True)


@register("disk_report_ordered")
def q_disk_report_ordered(spark, sf_dir):
    lk = Lake(spark, sf_dir)
    return R.disk_report(lk.hist, lk.items, lk.inv, lk.as_of, lookback_s=ALL_DAYS, match="nearest", ordered=True)


# --------------------------------------------------------------------------- staged output, replay, sinks, helpers

@register("agent_staged_load")
def q_agent_staged_load(spark, sf_dir):
    """Disk records of agents staged as one document per (request, table), loaded by the loader."""
    pending, lake = scratch_dir(spark, "pending"), scratch_dir(spark, "lake")
    accepted, _ = N.route(agent_norm(spark, sf_dir), strict=False)
    SK.write_staged_records(accepted, pending)
    SK.load_pending(spark, pending, lake)
    rows = SK.read_table(spark, lake, "opsb_agent_disk")
    names = F.json_object_keys("extra_metrics")
    return rows.withColumn("extra_metric_keys", F.array_join(F.array_sort(names), ",")).drop("extra_metrics")


@register("payload_replay")
def q_payload_replay(spark, sf_dir):
    """Node rows normalised from the archive in batch."""
    archive = scratch_dir(spark, "raw")
    SK.archive_raw(PL.payloads(spark, sf_dir), archive)
    accepted, _ = N.route(N.normalize(PL.read_archive(spark, archive)), strict=False)
    return _table_view(N.to_table_rows(accepted, "opsb_agent_node"))


@register("jsonl_and_fanout")
def q_jsonl_and_fanout(spark, sf_dir):
    """Normalised records handed to two sinks, JSON lines and Parquet, and read back from both."""
    lines, table = scratch_dir(spark, "jsonl"), scratch_dir(spark, "table")
    norm = agent_norm(spark, sf_dir).select("request_id", "record_pos", "class_name", "node_fqdn")
    SK.fanout(norm, [lambda d: SK.write_jsonl(d, lines), lambda d: d.write.mode("overwrite").parquet(table)])
    back = spark.read.schema("request_id string, record_pos int, class_name string, node_fqdn string").json(lines)
    return back.withColumn("sink", F.lit("jsonl")).unionByName(spark.read.parquet(table).withColumn("sink", F.lit("parquet")))


@register("discover_columns")
def q_discover_columns(spark, sf_dir):
    return N.discover_columns(agent_norm(spark, sf_dir), "opsb_agent_node")


@register("text_helpers")
def q_text_helpers(spark, sf_dir):
    """Text cleaning, run ids, date parts and number formats over all events."""
    from .functions.scalars import clean_text, date_parts, sanitize_run_id
    ev = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    run_id = F.concat(F.lit("run:"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00/"), F.col("event_id").cast("string"))
    return ev.select("event_id", clean_text(F.concat_ws("\t", "event_type", F.lit("a\nb\rc"), "props")).alias("cleaned"),
                     sanitize_run_id(run_id).alias("run_id"), *date_parts("ts"),
                     P.pretty_size(F.col("user_id") * F.col("user_id") * 1024).alias("size_text"))


#: Kinds of the documents of each customer, by custkey % 7.
MIXED_KINDS = ["all columns", "fewer columns", "more columns", "no key column", "null key", "bad number", "append"]


def _mixed_documents(spark, sf_dir):
    """A first document per customer creates or updates its row; a second one is of a kind by custkey."""
    cu = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet")
    key, name, bal = F.col("c_custkey").cast("string"), F.col("c_name"), F.round("c_acctbal").cast("bigint").cast("string")
    kind = F.pmod("c_custkey", F.lit(7))
    head = '"column_types":{"k":"BIGINT","bal":"BIGINT"},"add_updated_at":false'
    up = F.lit('{"table":"mixed","method":"upsert","conflict_target":["k"],' + head + "}")
    plain = F.lit('{"table":"mixed_log","method":"copy",' + head + "}")

    def doc(meta, *cols):
        keep = F.to_json(F.struct(*[c.alias(n) for n, c in cols]), {"ignoreNullFields": "false"})
        return F.concat(F.lit('{"meta":'), meta, F.lit(',"data":['), keep, F.lit("]}"))
    first = doc(up, ("k", key), ("name", name), ("bal", bal))
    second = (F.when(kind == 0, doc(up, ("k", key), ("name", F.upper(name)), ("bal", F.lit("1"))))
              .when(kind == 1, doc(up, ("k", key), ("bal", F.lit("2"))))
              .when(kind == 2, doc(up, ("k", key), ("seg", F.col("c_mktsegment"))))
              .when(kind == 3, doc(up, ("name", name), ("bal", bal)))
              .when(kind == 4, doc(up, ("k", F.lit(None).cast("string")), ("name", name)))
              .when(kind == 5, doc(up, ("k", key), ("bal", F.lit("12x"))))
              .otherwise(doc(plain, ("k", key), ("bal", bal))))
    return cu.select(first.alias("first"), second.alias("second"))


@register("load_mixed_documents")
def q_load_mixed_documents(spark, sf_dir):
    """Documents with other columns, bad values and bad keys, loaded in two runs each of which is repeated: rows of both
    tables, and the documents of each status and error."""
    docs = _mixed_documents(spark, sf_dir)
    pending, lake = scratch_dir(spark, "pending"), scratch_dir(spark, "lake")
    for c in ("first", "second"):
        docs.select(F.col(c).alias("value")).write.mode("append").text(pending)
        SK._rename_json(spark, pending)
        SK.load_pending(spark, pending, lake)
        SK.load_pending(spark, pending, lake)
    text = [F.col(c).cast("string").alias(c) for c in ("name", "bal")]
    table = SK.read_table(spark, lake, "mixed").select(F.lit("mixed").alias("part"), F.col("k").cast("string").alias("k"), *text)
    log = SK.read_table(spark, lake, "mixed_log").select(
        F.lit("mixed_log").alias("part"), F.col("k").cast("string").alias("k"), F.lit(None).cast("string").alias("name"),
        F.col("bal").cast("string").alias("bal"))
    led = SK.read_ledger(spark, lake).groupBy("file_path", "doc_pos", "status", "error").agg(F.count("*").alias("tries"))
    led = led.groupBy("status", "error", "tries").agg(F.count("*").alias("n")).select(
        F.lit("ledger").alias("part"), F.col("status").alias("k"), F.col("error").alias("name"),
        F.concat_ws("x", F.col("n").cast("string"), F.col("tries").cast("string")).alias("bal"))
    return table.unionByName(log).unionByName(led)


@register("load_budgeted")
def q_load_budgeted(spark, sf_dir):
    """All documents loaded in runs whose time is spent after one batch of two files, until no file is deferred."""
    cu = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet").select("c_custkey", "c_name").repartition(6, "c_custkey")
    pending, lake = scratch_dir(spark, "pending"), scratch_dir(spark, "lake")
    SK.write_staged(cu, pending, "cust", "copy", column_types={"c_custkey": "BIGINT"}, add_updated_at=False, max_records=100)
    while SK.load_summary(SK.load_pending_budgeted(spark, pending, lake, time_budget_s=0, files_per_batch=2)).first().deferred:
        pass
    return SK.read_table(spark, lake, "cust")


@register("load_failures")
def q_load_failures(spark, sf_dir):
    """Files that always fail come first by name, one batch holds two files, and the table's latest values can't be kept
    (it lacks their columns): two runs. Rows of the table whose documents failed late (none may stay), rows of the good
    table (each once), and the documents by table, status and number of tries."""
    cu = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet").select("c_custkey", "c_name")
    pending, lake = scratch_dir(spark, "pending"), scratch_dir(spark, "lake")
    bad = spark.range(4).select(F.lit('{"meta":{"method":"copy"},"data":[{"a":"1"}]}').alias("value")).repartition(4)
    bad.write.mode("append").text(pending)
    SK._rename_json(spark, pending)
    SK.write_staged(cu.repartition(2), pending, "late", "copy", column_types={"c_custkey": "BIGINT"}, add_updated_at=False, max_records=1000)
    SK.write_staged(cu.repartition(3), pending, "good", "copy", column_types={"c_custkey": "BIGINT"}, add_updated_at=False, max_records=1000)
    for _ in range(2):
        SK.load_pending_budgeted(spark, pending, lake, time_budget_s=3600, files_per_batch=2, latest_tables=["late"])
    late, good = SK.read_table(spark, lake, "late"), SK.read_table(spark, lake, "good")
    out = good.select(F.lit("good").alias("part"), "c_custkey", "c_name").unionByName(late.select(F.lit("late").alias("part"), "c_custkey", "c_name"))
    led = SK.read_ledger(spark, lake).groupBy(F.coalesce("table", F.lit("none")).alias("t"), "file_path", "doc_pos", "status").agg(F.count("*").alias("tries"))
    led = led.groupBy("t", "status", "tries").agg(F.count("*").alias("n")).where("t != 'good' OR status != 'ok' OR tries != 1")
    # of the late table only whether its documents were all tried in both runs: their number follows the hash chunks
    led = led.select(F.concat_ws(" ", "t", "status", F.col("tries").cast("string")).alias("part"),
                     F.when(F.col("t") == "none", F.col("n")).cast("bigint").alias("c_custkey"), F.lit(None).cast("string").alias("c_name"))
    return out.unionByName(led)


@register("load_rates")
def q_load_rates(spark, sf_dir):
    """Rows by table and method of a run with their rate (any rate above 0), and of the whole run."""
    cu = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet").select("c_custkey", "c_name")
    pending, lake = scratch_dir(spark, "pending"), scratch_dir(spark, "lake")
    for table in ("a", "b"):
        SK.write_staged(cu, pending, table, "copy", column_types={"c_custkey": "BIGINT"}, add_updated_at=False, max_records=1000)
    rates = SK.load_rates(SK.load_pending(spark, pending, lake))
    return rates.select("table", "method", "rows", (F.col("rows_per_s") > 0).alias("has_rate"))


@register("disk_report_partitioned")
def q_disk_report_partitioned(spark, sf_dir):
    """Disk report (nearest IO) over the day-partitioned history: latest capacity by descent over its days."""
    lk, path = _partitioned_history(spark, sf_dir)
    return R.disk_report(spark.read.parquet(path), lk.items, lk.inv, lk.as_of, lookback_s=ALL_DAYS, match="nearest")


@register("capacity_last_partitioned")
def q_capacity_last_partitioned(spark, sf_dir):
    """Latest sample of every capacity item, days read newest first until all items are met."""
    lk, path = _partitioned_history(spark, sf_dir)
    return R.capacity_last(spark.read.parquet(path), _cap_items(lk))


@register("stream_two_checkpoints")
def q_stream_two_checkpoints(spark, sf_dir):
    """Two streams with checkpoints of their own over one output folder: halves of history, then both are there; window
    counts of both halves merged into one table, and a stream begun anew over the first half changes nothing there."""
    lk, out, lake = Lake(spark, sf_dir), scratch_dir(spark, "out"), scratch_dir(spark, "lake")
    for half in (0, 1):
        src = scratch_dir(spark, "half")
        lk.hist.where(F.pmod("hostid", F.lit(2)) == half).repartition(4).write.mode("overwrite").parquet(src)
        _await(ST.stream_history_dedup(spark, src, out, scratch_dir(spark, "ckpt"), watermark="40 days", max_files_per_trigger=2))
        for _ in range(2 - half):
            _await(ST.stream_volume(spark, src, f"{lake}/volume", scratch_dir(spark, "ckpt"), watermark="40 days"))
    rows = spark.read.parquet(out).groupBy("hostid").agg(F.count("*").alias("rows"))
    volume = SK.read_table(spark, lake, "volume").groupBy("hostid").agg(F.sum("samples").alias("samples"))
    return rows.join(volume, "hostid", "full").select("hostid", "rows", "samples")


@register("stream_source_archived")
def q_stream_source_archived(spark, sf_dir):
    """After a stream has loaded staged documents: files left in its folder, and rows by what the archive's files hold."""
    from .sources import staged as SG
    cu = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet").select("c_custkey", "c_name")
    pending, lake, done = scratch_dir(spark, "pending"), scratch_dir(spark, "lake"), scratch_dir(spark, "done")
    SK.write_staged(cu.repartition(4), pending, "cust", "copy", column_types={"c_custkey": "BIGINT"}, add_updated_at=False, max_records=500)
    _await(ST.stream_load_pending(spark, pending, lake, scratch_dir(spark, "ckpt"), max_files_per_trigger=2))
    ST.archive_loaded(spark, pending, lake, done)
    left = len(SG.list_pending(spark, pending)[0])
    docs = SG.parse_envelope(SG.read_staged(spark, done))
    return docs.agg(F.sum(F.size("records")).cast("bigint").alias("archived_rows")).select(F.lit(left).alias("files_left"), "archived_rows")


@register("stream_ingest_lag")
def q_stream_ingest_lag(spark, sf_dir):
    """Lag of three sources followed by one stream: history, agent nodes by their own time and by receipt. The agent table is
    the one that the agent stream writes; a second run of the query finds nothing new and changes nothing."""
    src, lake, ck = _history_files(spark, sf_dir), scratch_dir(spark, "lake"), scratch_dir(spark, "ckpt")
    archive, nodes = scratch_dir(spark, "raw"), f"{lake}/opsb_agent_node/data"
    SK.archive_raw(PL.payloads(spark, sf_dir), archive)
    _await(ST.stream_agent_metrics(spark, archive, lake, scratch_dir(spark, "ckpt"), strict=False))
    for _ in range(2):
        _await(ST.stream_ingest_lag(spark, src, nodes, f"{lake}/ingest_lag", ck, max_files_per_trigger=4))
    return ST.ingest_lag(SK.read_table(spark, lake, "ingest_lag"), Lake(spark, sf_dir).as_of)


@register("stream_late_rows")
def q_stream_late_rows(spark, sf_dir):
    """De-duplication with a watermark of a day, first over half of the hosts, then, from its checkpoint, over the other
    half, most of which is late by then: rows read, kept, copies, and late rows as the stream reported them."""
    lk = Lake(spark, sf_dir)
    src, out, ck, log = (scratch_dir(spark, x) for x in ("hist", "dedup", "ckpt", "progress"))
    twice = lk.hist.select(*HISTORY_COLS).unionByName(lk.hist.select(*HISTORY_COLS))
    progress = ST.ProgressLog(spark, log)
    spark.streams.addListener(progress)
    try:
        for half in (0, 1):
            twice.where(F.pmod("hostid", F.lit(2)) == half).repartition(4).write.mode("append").parquet(src)
            q = ST.stream_history_dedup(spark, src, out, ck, watermark="1 day", max_files_per_trigger=1000)
            _await(q)
            progress.wait(q)
    finally:
        spark.streams.removeListener(progress)
    kept = spark.read.schema(lk.hist.select(*HISTORY_COLS).schema).parquet(out).agg(F.count(F.lit(1)).alias("kept_rows"))
    return ST.late_rows(spark, log).drop("stream").crossJoin(F.broadcast(kept))  # a row each


@register("table_rows")
def q_table_rows(spark, sf_dir):
    """Rows of every given table, as a number and as text (the part of the table profile that SQL can check)."""
    base = sf_dir.rstrip("/")
    return P.table_profile(spark, {t: f"{base}/{t}.parquet" for t in GIVEN_TABLES}).select("table_name", "rows", "approx_rows")


#: The given tables.
GIVEN_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
                "conversations").split()


@register("item_samples_analyzed")
def q_item_samples_analyzed(spark, sf_dir):
    """Samples of the text items, joined by the statistics of an analysed catalog table (cost-based, in a session of its own)."""
    own = spark.newSession()
    own.conf.set("spark.sql.cbo.enabled", "true")
    lk, path = Lake(own, sf_dir), scratch_dir(own, "items")
    lk.items.select(F.col("itemid").try_cast("bigint").alias("itemid_num"), "name", "value_type").write.mode("overwrite").parquet(path)
    table = "items_" + path.rstrip("/").rsplit("-", 1)[-1]
    MT.register_table(own, table, path)
    MT.analyze(own, table)
    return P.item_samples(lk.hist, own.table(table).where("value_type = '4'"))


#: A mapping of one's own: only disks have a table, with two metrics under other names.
OWN_MAPPING = {**AM.DEFAULT_MAPPING, "class_table_map": {"SCOPE_DISK": "own_disk"},
               "metric_map": {"DISK": {"BYDSK_UTIL": "busy_pct", "BYDSK_DEVNAME": "disk_device_name"}}}


@register("custom_extension")
def q_custom_extension(spark, sf_dir):
    """The extension points together: a mapping from a file, an identity check (a private address), a sink and a builder of
    staged rows. Requests with any record that isn't identified are rejected whole. Rows of the stream's table, of the
    sink, and of the table that the staged rows were loaded into."""
    archive, lake, extra, pending = (scratch_dir(spark, x) for x in ("raw", "lake", "extra", "pending"))
    FS.write_text(spark, f"{extra}/mapping.json", json.dumps(OWN_MAPPING))
    mapping = AM.read_mapping(spark, f"{extra}/mapping.json")
    identity = F.col("node_ipv4_address").startswith("192.168.")

    def sink(accepted, batch):
        accepted.select("request_id", "record_pos", "class_name").write.mode("overwrite").parquet(f"{extra}/rows/batch={batch}")

    def builder(norm, table):
        return norm.where(F.col("target_table") == table).select(
            "request_id", "record_pos", F.col("metrics")["disk_device_name"].alias("device"),
            F.col("metrics")["busy_pct"].try_cast("double").alias("busy"))

    SK.archive_raw(PL.payloads(spark, sf_dir), archive)
    _await(ST.stream_agent_metrics(spark, archive, lake, scratch_dir(spark, "ckpt"), strict=True, mapping=mapping,
                                   identity=identity, extra_sinks=[sink]))
    accepted, _ = N.route(N.normalize(PL.payloads(spark, sf_dir), mapping), strict=True, identity=identity)
    SK.write_staged_records(accepted, pending, mapping, builder=builder)
    SK.load_pending(spark, pending, lake + "-staged")
    table = spark.read.parquet(f"{lake}/own_disk/data").select(
        F.lit("table").alias("part"), "request_id", F.col("disk_device_name").alias("name"), F.col("busy_pct").alias("value"))
    seen = spark.read.parquet(f"{extra}/rows").select(
        F.lit("sink").alias("part"), "request_id", F.col("class_name").alias("name"), F.col("record_pos").cast("double").alias("value"))
    staged = SK.read_table(spark, lake + "-staged", "own_disk").select(
        F.lit("staged").alias("part"), "request_id", F.col("device").alias("name"), F.col("busy").alias("value"))
    return table.unionByName(seen).unionByName(staged)


@register("host_density_sketch")
def q_host_density_sketch(spark, sf_dir):
    """Busiest hosts of all days from stored daily sketches of their items."""
    lk, path = Lake(spark, sf_dir), scratch_dir(spark, "sketches")
    P.density_sketches(lk.hist).write.mode("overwrite").partitionBy("event_date").parquet(path)
    return P.host_density_sketched(spark.read.parquet(path), lk.inv)
