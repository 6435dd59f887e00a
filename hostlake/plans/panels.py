"""Dashboard panel queries (host / node overview) as DataFrame functions.

A dashboard binds ``host`` / ``node`` / item lists / a time range; every
function takes them as optional parameters, and without them covers all
hosts, so the same plan serves one panel or a whole export.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.history import within

from ..functions.scalars import NUMERIC_VALUE_TYPES, clock_to_ntz, round_half_up


def host_list(inv: DataFrame) -> DataFrame:
    """Host variable: name as text, hostid as value, ordered by name."""
    return inv.select(F.col("name").alias("__text"), F.col("hostid").alias("__value")) \
        .orderBy(F.col("__text").asc_nulls_last(), F.col("__value").asc())


def item_list(catalog: DataFrame, hostid: str | None = None) -> DataFrame:
    """Item variable: numeric items of a host (all hosts when ``hostid`` is None)."""
    c = catalog.where(F.col("value_type").isin(*NUMERIC_VALUE_TYPES))
    if hostid is not None:
        c = c.where(F.col("hostid") == F.lit(hostid))
    return c.select("hostid", F.col("item_name").alias("__text"), F.col("itemid").alias("__value")) \
        .orderBy(F.col("__text").asc_nulls_last(), F.col("__value").asc())


def host_info(inv: DataFrame, hostid: str | None = None) -> DataFrame:
    i = inv if hostid is None else inv.where(F.col("hostid") == F.lit(hostid))
    return i.select(
        "hostid",
        F.col("name").alias("Host"), F.col("status").alias("Status"), F.col("primary_ip").alias("IP"),
        F.col("monitored_by").alias("MonitoredBy"),
        F.to_json("host_groups").alias("Groups"), F.to_json("templates").alias("Templates"),
        F.to_json("tags").alias("Tags"), F.col("collected_at").alias("CollectedAt"),
    )


def panel_timeseries(readable: DataFrame, t_from: int | None, t_to: int | None, hostid: int | None = None,
                     itemids: Sequence[int] | None = None) -> DataFrame:
    """Numeric samples of the selected series in [t_from, t_to] (None: no bound on that side)."""
    r = within(readable, t_from, t_to).where(F.col("value_num").isNotNull())
    if hostid is not None:
        r = r.where(F.col("hostid") == F.lit(hostid))
    if itemids is not None:
        r = r.where(F.col("itemid").isin(*itemids))
    return r.select(F.col("ts").alias("time"), "hostid", "itemid", F.col("item_name").alias("metric"),
                    F.col("value_num").alias("value"))


# --------------------------------------------------------------------------- agent node panels

def node_list(node: DataFrame) -> DataFrame:
    return node.select("node_short_name").distinct().orderBy(F.col("node_short_name").asc_nulls_last())


def node_info(node: DataFrame, node_short_name: str | None = None) -> DataFrame:
    """Latest row per node: identity, OS, CPU count, RAM in GB rounded to 0.1."""
    n = node if node_short_name is None else node.where(F.col("node_short_name") == F.lit(node_short_name))
    pick = F.max_by(F.struct("node_fqdn", "node_ipv4_address", "os_name", "num_cpu", "mem_phys_total",
                             "collection_policy_name", "timestamp_utc_s"),
                    F.struct("timestamp_utc_s", "received_at", "request_id"))
    g = n.groupBy("node_short_name").agg(pick.alias("p"))
    return g.select(
        F.col("node_short_name").alias("Node"), F.col("p.node_fqdn").alias("FQDN"),
        F.col("p.node_ipv4_address").alias("IPv4"), F.col("p.os_name").alias("OS"),
        F.col("p.num_cpu").alias("CPU"),
        round_half_up(F.col("p.mem_phys_total") / 1024 / 1024 / 1024, 1).alias("RAM_GB"),
        F.col("p.collection_policy_name").alias("Policy"),
        clock_to_ntz("p.timestamp_utc_s").alias("Time"),
    )


def _node_time(df: DataFrame, node_short_name, t_from, t_to) -> DataFrame:
    if node_short_name is not None:
        df = df.where(F.col("node_short_name") == F.lit(node_short_name))
    if t_from is not None:
        df = df.where(F.col("timestamp_utc_s") >= F.lit(t_from))
    if t_to is not None:
        df = df.where(F.col("timestamp_utc_s") <= F.lit(t_to))
    return df


def node_cpu_mem(node: DataFrame, node_short_name=None, t_from=None, t_to=None) -> DataFrame:
    n = _node_time(node, node_short_name, t_from, t_to)
    return n.select("node_short_name", clock_to_ntz("timestamp_utc_s").alias("time"),
                    F.col("cpu_util_pct").alias("cpu_pct"), F.col("mem_util_pct").alias("mem_pct"))


def node_disk_util(disk: DataFrame, node_short_name=None, t_from=None, t_to=None) -> DataFrame:
    d = _node_time(disk, node_short_name, t_from, t_to).where(F.col("disk_util_pct").isNotNull())
    return d.select("node_short_name", clock_to_ntz("timestamp_utc_s").alias("time"),
                    F.col("disk_device_name").alias("metric"), F.col("disk_util_pct").alias("value"))


def node_fs_util(fs: DataFrame, node_short_name=None, t_from=None, t_to=None) -> DataFrame:
    d = _node_time(fs, node_short_name, t_from, t_to).where(F.col("fs_util_pct").isNotNull())
    return d.select("node_short_name", clock_to_ntz("timestamp_utc_s").alias("time"),
                    F.col("fs_dir_name").alias("metric"), F.col("fs_util_pct").alias("value"))


def net_throughput(netif: DataFrame, node_short_name=None, t_from=None, t_to=None) -> DataFrame:
    """Long form: one row per interface and direction (``name || ' in'`` / ``' out'``); the rows are read once for both."""
    n = _node_time(netif, node_short_name, t_from, t_to)
    ways = F.array(*[F.struct(F.concat(F.col("netif_name"), F.lit(f" {way}")).alias("metric"),
                              F.col(f"netif_{way}_byte_rate").alias("value")) for way in ("in", "out")])
    return n.select(F.col("node_short_name"), clock_to_ntz("timestamp_utc_s").alias("time"), F.inline(ways))
