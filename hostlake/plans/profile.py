"""Readable views, discovery profile and capacity diagnostics over the lake.

All functions take lake DataFrames and return DataFrames; ``as_of`` (unix
seconds) replaces "now" so results are deterministic. Top-k reports carry an
explicit tie-break so the k rows are well defined.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify as K
from ..functions.scalars import NUMERIC_VALUE_TYPES, clock_to_ntz, pct, safe_numeric_typed
from ..operators.asof import item_row_counts, latest_by
from ..operators.maintenance import with_event_date
from ..session import Dimension, bounded_broadcast
from ..sources.history import PARTITION_COL, within
from .reports import group_hosts

DAY = 86_400

# ---- fixed values: chartability labels of the value-type profile ---------------
CHARTABLE_LABEL = "numeric (chartable)"
NOT_CHARTABLE_LABEL = "text/log (not chartable)"
# ---------------------------------------------------------------------------------


def readable_history(hist: DataFrame, items: DataFrame, inv: DataFrame) -> DataFrame:
    """History with host / item names and a guarded numeric value (left joins).

    Ids are TEXT on the item / host side; the cast is applied to the small
    side so the history keys stay bare. Items and hosts are broadcast when their
    size is proven small, whatever the session's automatic limit. The day column
    of a partitioned history stays, so that filters above the view reach it.
    """
    it = items.select(F.col("itemid").try_cast("bigint").alias("_iid"), F.col("name").alias("item_name"),
                      F.col("key_").alias("item_key"), "units", "value_type_name")
    hs = inv.select(F.col("hostid").try_cast("bigint").alias("_hid"), F.col("name").alias("host_name"))
    j = (hist.join(bounded_broadcast(it), hist["itemid"] == it["_iid"], "left")
         .join(bounded_broadcast(hs), hist["hostid"] == hs["_hid"], "left"))
    return j.select(
        *[c for c in hist.columns if c == PARTITION_COL],
        clock_to_ntz("clock").alias("ts"), "clock", "itemid", "hostid", "host_name", "item_name",
        "item_key", "units", "value_type", "value_type_name",
        F.col("value").alias("value_text"),
        safe_numeric_typed("value", "value_type").alias("value_num"),
    )


def host_item_catalog(hist: DataFrame, items: DataFrame, inv: DataFrame, as_of: int,
                      lookback_s: int = 7 * DAY) -> DataFrame:
    """Per host and item: samples and last sample time over the look-back."""
    h = within(hist, None if lookback_s is None else as_of - lookback_s)
    # aggregate the big side first (partial aggregation), then attach names
    g = h.groupBy("hostid", "itemid", "value_type").agg(
        F.count(F.lit(1)).alias("sample_count"), F.max("clock").alias("_last"))
    it = items.select(F.col("itemid").alias("_itxt"), F.col("name").alias("item_name"), "units", "value_type_name")
    hs = inv.select(F.col("hostid").alias("_htxt"), F.col("name").alias("host_name"))
    j = (g.join(bounded_broadcast(it), g["itemid"].cast("string") == it["_itxt"], "left")
         .join(bounded_broadcast(hs), g["hostid"].cast("string") == hs["_htxt"], "left"))
    # itemid / hostid are keys of items / inventory: at most one match per group
    return j.select(F.col("hostid").cast("string").alias("hostid"), "host_name",
                    F.col("itemid").cast("string").alias("itemid"), "item_name", "units",
                    "value_type", "value_type_name", "sample_count",
                    clock_to_ntz("_last").alias("last_seen"))


def value_type_distribution(hist: DataFrame, items: DataFrame) -> DataFrame:
    g = hist.groupBy("itemid", "value_type").agg(F.count(F.lit(1)).alias("n"))
    it = items.select(F.col("itemid").alias("_itxt"), "value_type_name")
    j = g.join(bounded_broadcast(it), g["itemid"].cast("string") == it["_itxt"], "left")
    return j.groupBy("value_type", "value_type_name").agg(F.sum("n").alias("rows")).select(
        "value_type", "value_type_name",
        F.when(F.col("value_type").isin(*NUMERIC_VALUE_TYPES), F.lit(CHARTABLE_LABEL))
        .otherwise(F.lit(NOT_CHARTABLE_LABEL)).alias("chartable"),
        "rows")


def host_density(hist: DataFrame, inv: DataFrame, as_of: int, lookback_s: int = DAY,
                 top: int = 50) -> DataFrame:
    """Distinct items, samples and last sample per host over the look-back; top ``top``."""
    h = within(hist, None if lookback_s is None else as_of - lookback_s)
    per_item = h.groupBy("hostid", "itemid").agg(F.count(F.lit(1)).alias("n"), F.max("clock").alias("m"))
    g = per_item.groupBy("hostid").agg(F.count(F.lit(1)).alias("distinct_items"),
                                       F.sum("n").alias("samples_24h"), F.max("m").alias("_last"))
    hs = inv.select(F.col("hostid").alias("_htxt"), F.col("name").alias("host_name"))
    j = g.join(bounded_broadcast(hs), g["hostid"].cast("string") == hs["_htxt"], "left")
    return (j.select("host_name", "hostid", "distinct_items", "samples_24h",
                     clock_to_ntz("_last").alias("last_sample"))
            .orderBy(F.col("samples_24h").desc(), F.col("hostid").asc(), F.col("host_name").asc_nulls_last())
            .limit(top))


def density_sketches(hist: DataFrame, bits: int = 14) -> DataFrame:
    """Per host and UTC day: a sketch of its distinct items (HyperLogLog, ``2 ** bits`` registers), samples, newest clock.

    A small table to keep beside history, a day at a time: windows of any whole days come from it without reading
    history again. A task sends one sketch per host and day it has, however many rows they are. NULL items aren't counted."""
    h = with_event_date(hist)
    return h.groupBy("event_date", "hostid").agg(F.hll_sketch_agg("itemid", F.lit(bits)).alias("items"),
                                                 F.count(F.lit(1)).alias("samples"), F.max("clock").alias("last_clock"))


def host_density_sketched(sketches: DataFrame, inv: DataFrame, days: int | None = None, as_of: int | None = None,
                          top: int = 50) -> DataFrame:
    """Distinct items (estimated; standard error about 0.8 % at 14 bits, exact while there are few), samples and last
    sample per host over the last ``days`` UTC days up to that of ``as_of`` (all where None); top ``top``."""
    if days is not None:
        last = dt.datetime.fromtimestamp(as_of, dt.timezone.utc).date()
        sketches = sketches.where(F.col("event_date").between(F.lit(last - dt.timedelta(days=days - 1)), F.lit(last)))
    g = sketches.groupBy("hostid").agg(F.hll_sketch_estimate(F.hll_union_agg("items")).alias("distinct_items"),
                                       F.sum("samples").alias("samples"), F.max("last_clock").alias("_last"))
    hs = inv.select(F.col("hostid").alias("_htxt"), F.col("name").alias("host_name"))
    j = g.join(bounded_broadcast(hs), g["hostid"].cast("string") == hs["_htxt"], "left")
    return (j.select("host_name", "hostid", "distinct_items", "samples", clock_to_ntz("_last").alias("last_sample"))
            .orderBy(F.col("samples").desc(), F.col("hostid").asc(), F.col("host_name").asc_nulls_last()).limit(top))


def noisy_items(hist: DataFrame, items: DataFrame, as_of: int, lookback_s: int = DAY, top: int = 30) -> DataFrame:
    h = within(hist, None if lookback_s is None else as_of - lookback_s)
    g = h.groupBy("itemid").agg(F.count(F.lit(1)).alias("n"))
    it = items.select(F.col("itemid").alias("_itxt"), F.col("name").alias("item_name"),
                      F.col("key_").alias("item_key"), "units")
    j = g.join(bounded_broadcast(it), g["itemid"].cast("string") == it["_itxt"], "left")
    return (j.groupBy("item_name", "item_key", "units").agg(F.sum("n").alias("samples_24h"))
            .orderBy(F.col("samples_24h").desc(), F.col("item_key").asc_nulls_last(),
                     F.col("item_name").asc_nulls_last(), F.col("units").asc_nulls_last())
            .limit(top))


def collection_volume(hist: DataFrame, as_of: int, lookback_s: int = 30 * DAY, width: int = 300,
                      hostid: int | None = None) -> DataFrame:
    """Samples per ``width``-second bucket (per host; one host when ``hostid`` is set)."""
    h = within(hist, None if lookback_s is None else as_of - lookback_s)
    if hostid is not None:
        h = h.where(F.col("hostid") == F.lit(hostid))
    b = F.expr(f"clock div {int(width)}") * width
    return h.groupBy("hostid", b.alias("_b")).agg(F.count(F.lit(1)).alias("samples")) \
        .select("hostid", clock_to_ntz("_b").alias("time"), "samples")


def series_summary(hist: DataFrame, as_of: int, lookback_s: int = 30 * DAY) -> DataFrame:
    """Legend reductions per numeric series: last, max, mean of the guarded value."""
    h = within(hist, None if lookback_s is None else as_of - lookback_s) \
        .select("hostid", "itemid", "clock", "ns", safe_numeric_typed("value", "value_type").alias("v")) \
        .where(F.col("v").isNotNull())
    return h.groupBy("hostid", "itemid").agg(
        F.max_by("v", F.struct("clock", "ns")).alias("last"),
        F.max("v").alias("max"),
        F.round(F.avg("v"), 6).alias("mean"),
    )


def latest_per_item(hist: DataFrame, items: DataFrame, inv: DataFrame) -> DataFrame:
    """Newest readable row per item (``DISTINCT ON (itemid) ... ORDER BY ts DESC``)."""
    last = latest_by(hist, ["itemid"], ["clock", "ns"], ["hostid", "value", "value_type"])
    r = readable_history(last.drop("ns"), items, inv)
    return r.select("hostid", "itemid", F.col("item_name").alias("Item"), F.col("value_text").alias("LastValue"),
                    F.col("units").alias("Unit"), F.col("value_type_name").alias("Type"), F.col("ts").alias("Time"))


def host_latest(hist: DataFrame, items: DataFrame, inv: DataFrame, n: int = 100) -> DataFrame:
    """Latest ``n`` readable rows per host (inner joins), newest first.

    ``row_number`` over (host) with a limit filter is planned as a partial
    per-partition top-k before the shuffle, so a hot host is not sorted whole.
    """
    it = items.select(F.col("itemid").try_cast("bigint").alias("_iid"), F.col("name").alias("item_name"),
                      F.col("key_").alias("item_key"))
    hs = inv.select(F.col("hostid").try_cast("bigint").alias("_hid"), F.col("name").alias("host_name"))
    # join the (bounded) dimensions first, as the inner-joined view does, then top-k per host
    j = (hist.join(bounded_broadcast(it), hist["itemid"] == it["_iid"])
         .join(bounded_broadcast(hs), hist["hostid"] == hs["_hid"]))
    w = Window.partitionBy("hostid").orderBy(F.col("clock").desc(), F.col("ns").desc(), F.col("itemid").desc())
    top = j.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    return top.select("host_name", "item_name", "item_key", "hostid", "itemid", "clock", "ns",
                      F.col("value").alias("value_text"))


# --------------------------------------------------------------------------- diagnostics

def diag_items(items: DataFrame, inv: DataFrame, group: str = "AGENTLESS_GROUP") -> DataFrame:
    ah = group_hosts(inv, group).select("hostid")
    return (items.where(K.capacity_prefilter("key_")).join(bounded_broadcast(ah), "hostid")
            .groupBy("key_", "value_type", "value_type_name", "status")
            .agg(F.count(F.lit(1)).alias("item_count")))


def diag_presence(hist: DataFrame, items: DataFrame, inv: DataFrame, group: str = "AGENTLESS_GROUP") -> DataFrame:
    ah = group_hosts(inv, group).select("hostid")
    dim = Dimension(items.where(K.capacity_prefilter("key_")).join(bounded_broadcast(ah), "hostid")
                    .select(F.col("itemid").try_cast("bigint").alias("itemid_num"), "key_", "value_type"))
    ci = dim.df
    ids = dim.bc(ci.select(F.col("itemid_num").alias("itemid")).distinct())
    h = hist.join(ids, "itemid", "left_semi")
    per = item_row_counts(ci, h, item_key="itemid_num", hist_key="itemid",
                          extra_aggs=[F.max("clock").alias("last_clock"), F.min("value_type").alias("hist_vtype")])
    return per.groupBy("key_", F.col("value_type").alias("item_value_type")).agg(
        F.count(F.lit(1)).alias("item_count"),
        F.count_if(F.col("n") > 0).alias("items_with_data"),
        F.sum("n").alias("total_rows"),
        clock_to_ntz(F.max("last_clock")).alias("last_seen"),
        F.min("hist_vtype").alias("history_value_type"),
    )


def diag_roles(items: DataFrame, inv: DataFrame, group: str = "AGENTLESS_GROUP") -> DataFrame:
    ah = group_hosts(inv, group).select("hostid")
    return (items.where(K.cpu_mem_prefilter("key_")).join(bounded_broadcast(ah), "hostid")
            .groupBy(K.cpu_mem_role("key_").alias("role")).agg(F.count(F.lit(1)).alias("item_count"))
            .orderBy(F.col("role").asc_nulls_last()))


def diag_histogram(hist: DataFrame, items: DataFrame, inv: DataFrame, group: str = "AGENTLESS_GROUP") -> DataFrame:
    ah = group_hosts(inv, group).select("hostid")
    dim = Dimension(items.where(K.capacity_prefilter("key_")).join(bounded_broadcast(ah), "hostid")
                    .select(F.col("itemid").try_cast("bigint").alias("itemid_num"),
                            F.when(F.col("key_").like("%cpu_core_count%"), F.lit("core")).otherwise(F.lit("memtot")).alias("role")))
    cap = dim.df
    ids = dim.bc(cap.select(F.col("itemid_num").alias("itemid")).distinct())
    per = item_row_counts(cap, hist.join(ids, "itemid", "left_semi"), item_key="itemid_num", hist_key="itemid")
    return per.groupBy("role", F.col("n").alias("row_count")).agg(F.count(F.lit(1)).alias("item_count"))


def diag_coverage(hist: DataFrame, items: DataFrame, inv: DataFrame, group: str = "AGENTLESS_GROUP") -> DataFrame:
    """Share of the group's hosts that have any core-count sample."""
    ah = group_hosts(inv, group).select("hostid")
    dim = Dimension(items.where(F.col("key_").like("%cpu_core_count%")).join(bounded_broadcast(ah), "hostid")
                    .select(F.col("itemid").try_cast("bigint").alias("itemid_num"), "hostid"))
    core = dim.df
    ids = dim.bc(core.select(F.col("itemid_num").alias("itemid")).distinct())
    with_data = (core.join(hist.join(ids, "itemid", "left_semi").select("itemid").distinct(),
                           core["itemid_num"] == F.col("itemid"))
                 .select(F.col("hostid").alias("_h")).distinct())
    j = ah.join(with_data, ah["hostid"] == with_data["_h"], "left")
    total = F.count(F.lit(1))
    return j.agg(total.alias("total_hosts"), F.count("_h").alias("hosts_with_core"),
                 pct(F.count("_h"), total).alias("pct_with_core"))


def disk_volume(hist: DataFrame, items: DataFrame, inv: DataFrame, as_of: int, lookback_s: int = DAY,
                group: str = "AGENTLESS_GROUP") -> DataFrame:
    """Disk items per role class (util / other) and their sample count in the look-back."""
    ah = group_hosts(inv, group).select("hostid")
    di = (items.where(~F.col("key_").like(K.DISK_PROTOTYPE_MARK) & K.any_like("key_", K.DISK_FAMILY_PATTERNS))
          .join(bounded_broadcast(ah), "hostid")
          .select(F.col("itemid").try_cast("bigint").alias("itemid_num"),
                  F.when(K.any_like("key_", K.DISK_UTIL_PATTERNS), F.lit("util")).otherwise(F.lit("other")).alias("role_class")))
    h = within(hist, None if lookback_s is None else as_of - lookback_s)
    # only the disk items' rows are counted; item_row_counts gives the others 0
    h = h.join(bounded_broadcast(di.select(F.col("itemid_num").alias("itemid")).distinct()), "itemid", "left_semi")
    per = item_row_counts(di, h, item_key="itemid_num", hist_key="itemid")
    return per.groupBy("role_class").agg(F.count(F.lit(1)).alias("item_count"), F.sum("n").alias("rows_1d"))


def item_samples(hist: DataFrame, items: DataFrame) -> DataFrame:
    """Samples per item of ``items`` (itemid_num, name). No side is hinted: the tables' statistics decide the join."""
    return (hist.join(items, hist["itemid"] == items["itemid_num"])
            .groupBy("itemid_num", "name").agg(F.count(F.lit(1)).alias("samples")))


def mount_key_audit(items: DataFrame, top: int = 20) -> DataFrame:
    u = items.where(K.any_like("key_", K.DISK_UTIL_PATTERNS))
    mk = K.mount_key("key_")
    return (u.select("key_", mk.alias("mount_key"), F.length(mk).cast("bigint").alias("mount_key_length"),
                     K.mount_first_param("key_").alias("mount_first_param"))
            .orderBy(F.col("mount_key_length").desc(), F.col("key_").asc())
            .limit(top))


# --------------------------------------------------------------------------- table profile

# ---- fixed values: size units of the pretty size text ---------------------------------
SIZE_UNITS = ["bytes", "kB", "MB", "GB", "TB", "PB"]
# -----------------------------------------------------------------------------------------


def pretty_size(b) -> "F.Column":
    """Human size: the largest unit that keeps the number at 10 or more, rounded half up."""
    b = F.col(b) if isinstance(b, str) else b
    expr = None
    for i, unit in enumerate(SIZE_UNITS):
        val = F.concat(F.round(b / F.lit(float(1024 ** i)), 0).cast("bigint").cast("string"), F.lit(" " + unit))
        cond = b < F.lit(10 * 1024 ** (i + 1)) if i < len(SIZE_UNITS) - 1 else F.lit(True)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr


def table_profile(spark, tables: dict[str, str]) -> DataFrame:
    """Rows and on-disk bytes per Parquet table folder, largest first.

    Bytes are the sizes of the distinct files the rows come from
    (``_metadata``), aggregated per file first, so no file is counted twice.
    """
    parts = []
    for name, path in tables.items():
        per_file = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f"),
                                                   F.col("_metadata.file_size").alias("s")) \
            .groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.max("s").alias("s"))
        parts.append(per_file.agg(F.sum("n").cast("bigint").alias("rows"), F.sum("s").cast("bigint").alias("bytes"))
                     .select(F.lit(name).alias("table_name"), "rows", "bytes"))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.select("table_name", "rows", "bytes", F.format_number("rows", 0).alias("approx_rows"),
                    pretty_size("bytes").alias("total_size")).orderBy(F.col("bytes").desc(), "table_name")
