"""Profile and identity-bridge queries over the agent tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clock_to_ntz


def node_profile(node: DataFrame, top: int = 50) -> DataFrame:
    """Rows and last sample per node / policy / OS, newest first (NULLS LAST)."""
    g = node.groupBy("node_short_name", "collection_policy_name", "os_name").agg(
        F.count(F.lit(1)).alias("rows"), F.max("timestamp_utc_s").alias("_last"))
    return (g.select("node_short_name", "collection_policy_name", "os_name", "rows",
                     clock_to_ntz("_last").alias("last_sample"))
            .orderBy(F.col("last_sample").desc_nulls_last(), F.col("node_short_name").asc_nulls_last(),
                     F.col("collection_policy_name").asc_nulls_last(), F.col("os_name").asc_nulls_last())
            .limit(top))


def freshness(hist: DataFrame, node: DataFrame, as_of: int) -> DataFrame:
    """Newest record and ingest lag (seconds before ``as_of``) per source."""
    h = hist.agg(F.max("clock").alias("c")).select(F.lit("zabbix_history").alias("source"), clock_to_ntz("c").alias("last_event"))
    # both times in one pass over the records
    n = node.agg(F.max("timestamp_utc_s").alias("c"), F.max("received_at").alias("r")).select(F.inline(F.array(
        F.struct(F.lit("opsb_agent_node").alias("source"), clock_to_ntz("c").alias("last_event")),
        F.struct(F.lit("opsb_agent_node.received_at").alias("source"), F.col("r").alias("last_event")))))
    u = h.unionByName(n)
    lag = F.lit(as_of) - F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col("last_event"))
    return u.select("source", "last_event", lag.alias("lag_s"))


def identity_overlap(inv: DataFrame, node: DataFrame) -> DataFrame:
    """Host count, distinct agent IPs, and hosts whose primary IP is an agent IP (one row)."""
    # one row per address, with the hosts that have it (no host x node pairs are formed, and records are read once)
    hosts = inv.select(F.col("primary_ip").alias("ip"), F.lit(1).alias("host"), F.lit(False).alias("node"))
    nodes = node.select(F.col("node_ipv4_address").alias("ip"), F.lit(0).alias("host"), F.lit(True).alias("node"))
    per_ip = hosts.unionByName(nodes).groupBy("ip").agg(F.sum("host").alias("hosts"), F.max("node").alias("node"))
    known = F.col("node") & F.col("ip").isNotNull()
    return per_ip.agg(F.coalesce(F.sum("hosts"), F.lit(0)).alias("zabbix_hosts"),
                      F.count_if(known).alias("obm_nodes"),
                      F.coalesce(F.sum(F.when(known, F.col("hosts"))), F.lit(0)).alias("matched_by_ip"))


def host_bridge(inv: DataFrame, node: DataFrame) -> DataFrame:
    """Every host with the agent nodes sharing its primary IP (left join, distinct node side)."""
    obm = node.select("node_ipv4_address", "node_short_name", "node_fqdn").distinct()
    j = inv.join(obm, inv["primary_ip"] == obm["node_ipv4_address"], "left")
    return j.select(F.col("hostid").alias("zabbix_hostid"), F.col("name").alias("zabbix_host_name"), "primary_ip",
                    F.col("node_short_name").alias("obm_node_short_name"), F.col("node_fqdn").alias("obm_node_fqdn"))


def name_bridge(inv: DataFrame, node: DataFrame, top: int | None = 50) -> DataFrame:
    """Host / node pairs matching by lower-cased name (short name OR fqdn).

    The OR condition is one equi-join with a row per name of a node, de-duplicated
    on the pair, instead of a nested-loop join.
    """
    obm = node.select("node_short_name", "node_fqdn", "node_ipv4_address").distinct()
    i = inv.select("hostid", "name", "primary_ip", F.lower("name").alias("_lname"))
    names = F.array_distinct(F.array(F.lower("node_short_name"), F.lower("node_fqdn")))
    named = obm.select("*", F.explode(names).alias("_name"))
    pairs = i.join(named, i["_lname"] == named["_name"]).dropDuplicates(["hostid", "node_short_name", "node_fqdn", "node_ipv4_address"])
    out = pairs.select(F.col("name").alias("zabbix_name"), "primary_ip", F.col("node_short_name").alias("obm_name"),
                       "node_ipv4_address")
    if top is not None:
        out = out.orderBy(F.col("zabbix_name").asc_nulls_last(), F.col("obm_name").asc_nulls_last(),
                          F.col("node_ipv4_address").asc_nulls_last(), F.col("primary_ip").asc_nulls_last()).limit(top)
    return out
