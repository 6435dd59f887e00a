"""Inventory / item / template decoding of monitoring-API dumps (array HOFs, no UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import bounded_broadcast

from ..functions.scalars import MASKED_SECRET, VALUE_TYPE_NAMES, iso_utc_seconds, utc_ntz

# ---- fixed values: interface type codes -----------------------------------------------
INTERFACE_TYPES = {"1": "Agent", "2": "SNMP", "3": "IPMI", "4": "JMX"}
UNKNOWN_INTERFACE = "Unknown"
SERVER_MONITOR = "Zabbix Server"
PROXY_PREFIX = "Proxy ID: "
# ----------------------------------------------------------------------------------------


def _lit_map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def _s(c: Column) -> Column:
    return c.cast("string")


def decode_interfaces(interfaces: Column) -> Column:
    """Active address (ip when useip = '1', the default, else dns), type name, empty error -> NULL."""
    def one(i):
        addr = F.when(F.coalesce(_s(i["useip"]), F.lit("1")) == "1", i["ip"]).otherwise(i["dns"])
        return F.struct(
            i["ip"].alias("ip"), i["dns"].alias("dns"), addr.alias("active_address"), i["port"].alias("port"),
            F.coalesce(F.element_at(_lit_map(INTERFACE_TYPES), F.coalesce(_s(i["type"]), F.lit(""))),
                       F.lit(UNKNOWN_INTERFACE)).alias("type"),
            i["type"].alias("type_id"), i["main"].alias("main"), i["available"].alias("available"),
            F.when(F.coalesce(i["error"], F.lit("")) != "", i["error"]).alias("error"),
        )
    return F.transform(F.coalesce(interfaces, F.array()), one)


def format_hosts(hosts: DataFrame, target_groups: Sequence[str] = (), collected_at: str | None = None) -> DataFrame:
    """Host API rows -> inventory rows.

    status '0' -> Enabled else Disabled; empty / '0' proxy -> server, else
    'Proxy ID: <id>'; primary IP = active address of the *last* main
    interface; secondary IPs = other non-empty active addresses in order;
    secret macros (type '1') masked; tags / templates / groups to arrays;
    hosts outside ``target_groups`` dropped (no filter when empty).
    """
    groups = F.transform(F.coalesce(F.col("groups"), F.array()), lambda g: F.coalesce(g["name"], F.lit("")))
    h = hosts.withColumn("_groups", groups)
    if target_groups:
        h = h.where(F.arrays_overlap(F.col("_groups"), F.array(*[F.lit(g) for g in target_groups])))
    ifaces = decode_interfaces(F.col("interfaces"))
    h = h.withColumn("_if", ifaces)
    is_main = lambda i: F.coalesce(_s(i["main"]), F.lit("")) == "1"
    mains = F.filter(F.col("_if"), is_main)
    primary = F.element_at(mains, -1)["active_address"]
    secondary = F.transform(
        F.filter(F.col("_if"), lambda i: ~is_main(i) & (F.coalesce(i["active_address"], F.lit("")) != "")),
        lambda i: i["active_address"])
    proxy = _s(F.col("proxy_hostid"))
    macros = F.transform(F.coalesce(F.col("macros"), F.array()), lambda m: F.struct(
        m["macro"].alias("macro"),
        F.when(_s(m["type"]) == "1", F.lit(MASKED_SECRET)).otherwise(m["value"]).alias("value"),
        m["type"].alias("type"),
        F.when(F.coalesce(m["description"], F.lit("")) != "", m["description"]).alias("description")))
    tags = F.transform(F.coalesce(F.col("tags"), F.array()), lambda t: F.struct(t["tag"].alias("tag"), t["value"].alias("value")))
    templates = F.transform(F.coalesce(F.col("parentTemplates"), F.array()), lambda t: t["name"])
    coll = F.lit(collected_at) if collected_at else iso_utc_seconds(utc_ntz(F.current_timestamp()))
    return h.select(
        "hostid", "name",
        F.when(F.coalesce(F.col("description"), F.lit("")) != "", F.col("description")).otherwise(F.lit("")).alias("description"),
        F.when(_s(F.col("status")) == "0", F.lit("Enabled")).otherwise(F.lit("Disabled")).alias("status"),
        primary.alias("primary_ip"),
        secondary.alias("secondary_ips"),
        F.when(F.coalesce(proxy, F.lit("")).isin("", "0"), F.lit(SERVER_MONITOR))
        .otherwise(F.concat(F.lit(PROXY_PREFIX), proxy)).alias("monitored_by"),
        F.col("_groups").alias("host_groups"),
        templates.alias("templates"),
        F.col("_if").alias("interfaces"),
        macros.alias("macros"),
        tags.alias("tags"),
        coll.alias("collected_at"),
    )


def format_items(items: DataFrame) -> DataFrame:
    """Item API rows -> item rows: value_type text + name (unknown -> 'unknown'),
    empty units -> '', status decoded; first occurrence of an itemid wins."""
    vt = F.coalesce(_s(F.col("value_type")), F.lit("0"))
    names = {str(k): v for k, v in VALUE_TYPE_NAMES.items()}
    cols = items.columns
    order = [c for c in ("_page", "_pos") if c in cols]
    out = items.select(
        *[c for c in order],
        _s(F.col("itemid")).alias("itemid"), _s(F.col("hostid")).alias("hostid"), "name", "key_",
        vt.alias("value_type"),
        F.coalesce(F.element_at(_lit_map(names), vt), F.lit("unknown")).alias("value_type_name"),
        F.when(F.coalesce(F.col("units"), F.lit("")) != "", F.col("units")).otherwise(F.lit("")).alias("units"),
        F.when(_s(F.col("status")) == "0", F.lit("Enabled")).otherwise(F.lit("Disabled")).alias("status"),
        _s(F.col("templateid")).alias("templateid"),
    )
    keep = [c for c in out.columns if c not in order]
    ordc = F.struct(*[F.col(c) for c in (order or keep)])
    return out.groupBy("itemid").agg(F.min_by(F.struct(*[F.col(c) for c in keep]), ordc).alias("_p")) \
        .select(*[F.col(f"_p.{c}").alias(c) for c in keep])


def format_templates(templates: DataFrame) -> DataFrame:
    groups = F.coalesce(F.col("templategroups"), F.array())
    return templates.select(
        "templateid", "name", "host",
        F.when(F.coalesce(F.col("description"), F.lit("")) != "", F.col("description")).otherwise(F.lit("")).alias("description"),
        F.transform(groups, lambda g: g["name"]).alias("template_groups"),
        F.transform(F.coalesce(F.col("parentTemplates"), F.array()), lambda p: p["name"]).alias("parent_templates"),
    )


def item_map(items: DataFrame) -> DataFrame:
    """Items per known value type (0..4; unknown types dropped)."""
    known = [str(k) for k in VALUE_TYPE_NAMES]
    return items.where(_s(F.col("value_type")).isin(*known)).groupBy(_s(F.col("value_type")).alias("value_type")) \
        .agg(F.count(F.lit(1)).alias("items"))


def attach_host(hist: DataFrame, items: DataFrame) -> DataFrame:
    """History rows + hostid of their item (NULL when the item is unknown).

    The item map is broadcast when it is proven small, so history is not shuffled;
    beyond the bound it is a shuffle join.
    """
    m = items.select(F.col("itemid").try_cast("bigint").alias("_iid"), F.col("hostid").try_cast("bigint").alias("hostid"))
    h = hist.drop("hostid") if "hostid" in hist.columns else hist
    m = bounded_broadcast(m)
    return h.join(m, h["itemid"] == m["_iid"], "left").drop("_iid")
