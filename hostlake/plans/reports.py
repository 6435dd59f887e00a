"""Capacity / utilisation reports over the monitoring lake.

* ``cpu_mem_report``  - per host CPU samples with the nearest memory sample and
  the latest known CPU-core / memory capacity.
* ``disk_report``     - per mount utilisation samples with read/write IO
  matched either to the nearest IO sample (``match='nearest'``) or to the
  same / previous 5-minute bucket (``match='bucket'``), and latest capacity.
* ``capacity_fill_rate`` - how many report rows / hosts got a capacity value.

Inputs are lake tables: ``hist`` (itemid BIGINT, hostid BIGINT, clock, ns,
value TEXT, value_type), ``items`` and ``inv`` with TEXT ids. Ids are cast on
the small (items) side so history keeps its bare, pushed-down key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify as K
from ..functions.scalars import clock_to_ntz, safe_numeric
from ..operators.asof import bucket_join, latest_by, latest_by_days, nearest_join
from ..session import Dimension, bounded_broadcast
from ..sources.history import PARTITION_COL, within

DAY = 86_400


def group_hosts(inv: DataFrame, group: str, with_ip: bool = False) -> DataFrame:
    """Enabled hosts whose ``host_groups`` contains ``group``."""
    cols = [F.col("hostid"), F.col("name").alias("node_fqdn")]
    if with_ip:
        cols.append(F.col("primary_ip").alias("node_ipv4_address"))
    return inv.where(F.coalesce(F.array_contains("host_groups", group), F.lit(False))
                     & (F.col("status") == "Enabled")).select(*cols)


def _window(hist: DataFrame, as_of: int, lookback_s: int | None) -> DataFrame:
    """Rows with ``clock >= as_of - lookback_s`` (None: all), pruned by day."""
    return within(hist, None if lookback_s is None else int(as_of) - int(lookback_s))


# --------------------------------------------------------------------------- CPU / memory

def group_items(items: DataFrame, hosts: DataFrame) -> Dimension:
    """The group's CPU/memory and capacity items, persisted once with a row bound."""
    keep = K.cpu_mem_prefilter("key_") | K.capacity_prefilter("key_")
    return Dimension(items.where(keep).join(bounded_broadcast(hosts.select("hostid")), "hostid").select("itemid", "hostid", "key_"))


def cpu_mem_items(items: DataFrame, hosts: DataFrame) -> DataFrame:
    """Items of the group's hosts with a CPU/memory role (NULL role dropped)."""
    it = items.where(K.cpu_mem_prefilter("key_"))
    if hosts is not None:
        it = it.join(bounded_broadcast(hosts.select("hostid")), "hostid")
    return (it
            .select(F.col("itemid").try_cast("bigint").alias("itemid_num"), "hostid",
                    K.cpu_mem_role("key_").alias("role"))
            .where(F.col("role").isNotNull()))


def capacity_items(items: DataFrame, hosts: DataFrame) -> DataFrame:
    it = items.where(K.capacity_prefilter("key_"))
    if hosts is not None:
        it = it.join(bounded_broadcast(hosts.select("hostid")), "hostid")
    return (it
            .select(F.col("itemid").try_cast("bigint").alias("itemid_num"), "hostid",
                    K.capacity_role("key_").alias("role"))
            .where(F.col("role").isNotNull()))


def latest_item_values(hist: DataFrame, item_ids: DataFrame, value_types=None, dim: Dimension | None = None,
                       latest: DataFrame | None = None) -> DataFrame:
    """Latest (clock, ns) row of every item in ``item_ids.itemid_num`` over all history.

    With ``latest`` (the maintained ``latest_values`` table) no history is
    read. A day-partitioned history is read from its newest day back, until every
    item has been met (``latest_by_days``). Otherwise history is semi-joined to the
    (bounded, broadcast) item list before a ``max_by`` aggregate.
    """
    ids = item_ids.select(F.col("itemid_num").alias("itemid")).distinct()
    if latest is None and PARTITION_COL in hist.columns:
        h = hist if value_types is None else hist.where(F.col("value_type").isin(*value_types))
        return latest_by_days(h, ids, "itemid", ["itemid"], ["clock", "ns"], ["value"])
    ids = dim.bc(ids) if dim is not None else bounded_broadcast(ids)
    if latest is not None:
        from ..operators.latest import latest_for
        return latest_for(latest.join(ids, "itemid", "left_semi"), value_types)
    h = hist if value_types is None else hist.where(F.col("value_type").isin(*value_types))
    h = h.join(ids, "itemid", "left_semi")
    return latest_by(h, ["itemid"], ["clock", "ns"], ["value"])


def capacity_last(hist: DataFrame, cap_items: DataFrame, dim: Dimension | None = None,
                  latest: DataFrame | None = None) -> DataFrame:
    """Latest sample of every capacity item (no time bound), value guarded."""
    last = latest_item_values(hist, cap_items, dim=dim, latest=latest)
    cap_items = dim.bc(cap_items) if dim is not None else bounded_broadcast(cap_items)
    return cap_items.join(last, cap_items["itemid_num"] == last["itemid"]) \
        .select("hostid", "role", "itemid", "clock", safe_numeric("value").alias("value"))


def capacity_pick(cap_last: DataFrame) -> DataFrame:
    """Several items of one role on a host: the one with the newest sample wins."""
    return latest_by(cap_last, ["hostid", "role"], ["clock", "itemid"], ["value"])


def host_capacity(hist: DataFrame, cap_items: DataFrame, dim: Dimension | None = None,
                  latest: DataFrame | None = None) -> DataFrame:
    """One row per host: latest core count / total memory and when it was measured.

    "Latest row per item, then the item with the newest sample per role"
    equals one ``max_by`` over all of the role's rows ordered by
    (clock, itemid, ns), so history (or the maintained latest-value table) is
    aggregated once per host after a broadcast join with the bounded capacity
    items; ``max_by`` skips rows whose ordering is NULL, so each role's pick
    only sees that role's rows. The value guard applies to the picked row.
    On a day-partitioned history a host's role is looked for from the newest day back
    until it has been met.
    """
    if latest is None and PARTITION_COL in hist.columns:
        wanted = cap_items.select(F.col("itemid_num").alias("itemid"), "hostid", "role")
        rows = latest_by_days(hist.select("itemid", "clock", "ns", "value", PARTITION_COL), wanted, "itemid",
                              ["hostid", "role"], ["clock", "itemid", "ns"], ["value"])
        one = {role: F.max(F.when(F.col("role") == role, F.struct("clock", "value"))) for role in ("core", "memtot")}
        g = rows.groupBy("hostid").agg(one["core"].alias("_c"), one["memtot"].alias("_m"))
        return g.select("hostid", safe_numeric("_c.value").alias("cpu_core"), F.col("_c.clock").alias("cpu_core_clock"),
                        safe_numeric("_m.value").alias("mem_total_mb"), F.col("_m.clock").alias("mem_total_clock"))
    items = cap_items.select("itemid_num", "hostid", "role")
    items = dim.bc(items) if dim is not None else bounded_broadcast(items)
    src = latest if latest is not None else hist
    rows = src.select("itemid", "clock", "ns", "value").join(items, F.col("itemid") == F.col("itemid_num"))

    def pick(role):
        is_role = F.col("role") == role
        return F.max_by(F.when(is_role, F.struct("clock", "value")), F.when(is_role, F.struct("clock", "itemid", "ns")))

    g = rows.groupBy("hostid").agg(pick("core").alias("_c"), pick("memtot").alias("_m"))
    return g.select("hostid", safe_numeric("_c.value").alias("cpu_core"), F.col("_c.clock").alias("cpu_core_clock"),
                    safe_numeric("_m.value").alias("mem_total_mb"), F.col("_m.clock").alias("mem_total_clock"))


def pct_history(hist: DataFrame, items: DataFrame, inv: DataFrame, as_of: int,
                lookback_s: int | None = DAY, group: str = "AGENTLESS_GROUP",
                dim: Dimension | None = None) -> DataFrame:
    """CPU / memory percentage samples of the group's hosts in the window (value_type 0)."""
    hosts = group_hosts(inv, group)
    dim = dim or group_items(items, hosts)
    used = dim.bc(cpu_mem_items(dim.df, None).where(F.col("role").isin("cpu", "mem")))
    return (_window(hist, as_of, lookback_s).where(F.col("value_type") == 0)
            .select("itemid", "clock", "ns", "value")
            .join(used, F.col("itemid") == F.col("itemid_num"))
            .select(F.col("hostid"), "role", "clock", "ns", "itemid",
                    safe_numeric("value").alias("value")))


def cpu_with_mem(hist: DataFrame, items: DataFrame, inv: DataFrame, as_of: int,
                 lookback_s: int | None = DAY, group: str = "AGENTLESS_GROUP",
                 dim: Dimension | None = None) -> DataFrame:
    """CPU samples of the window, each with the nearest memory sample of its host."""
    dim = dim or group_items(items, group_hosts(inv, group))
    pct = pct_history(hist, items, inv, as_of, lookback_s, group, dim=dim)
    cpu = pct.where(F.col("role") == "cpu").select("hostid", "clock", F.col("value").alias("cpu_value"))
    mem = pct.where(F.col("role") == "mem").select("hostid", "clock", "ns", "itemid", "value")
    m = nearest_join(cpu, mem, by=["hostid"], values=["value"], tie=["ns", "itemid"], how="inner")
    return m.select("hostid", "clock", "cpu_value", F.col("value").alias("mem_value"))


def cpu_mem_report(hist: DataFrame, items: DataFrame, inv: DataFrame, as_of: int,
                   lookback_s: int | None = DAY, group: str = "AGENTLESS_GROUP",
                   ordered: bool = False, latest: DataFrame | None = None) -> DataFrame:
    """CPU/memory utilisation per host sample with latest capacity; with
    ``latest`` (maintained latest-value table) capacity reads no history, and on a
    day-partitioned history only the days that it takes to meet every host."""
    hosts = group_hosts(inv, group)
    dim = group_items(items, hosts)
    c = cpu_with_mem(hist, items, inv, as_of, lookback_s, group, dim=dim)
    cap = host_capacity(hist, capacity_items(dim.df, None), dim=dim, latest=latest)
    out = (c.join(bounded_broadcast(hosts), "hostid").join(cap, "hostid", "left")
           .select(F.col("clock").alias("transaction_clock"),
                   clock_to_ntz("clock").alias("TransactionDatetime"),
                   "node_fqdn",
                   F.col("cpu_core").alias("CpuCore"),
                   (F.col("mem_total_mb") / F.lit(1024.0)).alias("MemoryCapacity"),
                   F.col("cpu_value").alias("CpuUtil"),
                   F.col("mem_value").alias("MemoryUtil"),
                   clock_to_ntz("cpu_core_clock").alias("CpuCore_measured_at"),
                   clock_to_ntz("mem_total_clock").alias("MemoryCapacity_measured_at")))
    if ordered:
        out = out.orderBy(F.col("node_fqdn").asc_nulls_last(), F.col("TransactionDatetime").desc_nulls_first())
    return out


def capacity_fill_rate(hist: DataFrame, items: DataFrame, inv: DataFrame, as_of: int,
                       lookback_s: int | None = DAY, group: str = "AGENTLESS_GROUP",
                       latest: DataFrame | None = None) -> DataFrame:
    """Rows / hosts of the CPU report that carry a core-count capacity value; with
    ``latest`` (maintained latest-value table) capacity reads no history."""
    hosts = group_hosts(inv, group)
    dim = group_items(items, hosts)
    c = cpu_with_mem(hist, items, inv, as_of, lookback_s, group, dim=dim)
    cap = host_capacity(hist, capacity_items(dim.df, None), dim=dim, latest=latest)
    j = c.join(cap, "hostid", "left")
    total = F.count(F.lit(1))
    return j.agg(
        total.alias("total_rows"),
        F.count("cpu_core").alias("cpucore_filled"),
        F.count("mem_total_mb").alias("memcap_filled"),
        F.when(total != 0, F.round((F.lit(100.0) * F.count("cpu_core") / total).cast("decimal(38,9)"), 1)
               .cast("double")).alias("cpucore_pct"),
        F.count_distinct("hostid").alias("total_hosts"),
        F.count_distinct(F.when(F.col("cpu_core").isNotNull(), F.col("hostid"))).alias("hosts_with_capacity"),
    )


# --------------------------------------------------------------------------- disk

def disk_items(items: DataFrame, hosts: DataFrame) -> DataFrame:
    return (items.where(K.disk_item_filter("key_"))
            .join(bounded_broadcast(hosts), "hostid")
            .select(F.col("itemid").try_cast("bigint").alias("itemid_num"), "hostid", "node_fqdn",
                    "node_ipv4_address", K.disk_os_kind("key_").alias("os_kind"),
                    K.mount_key("key_").alias("mount_key"), K.disk_role("key_").alias("role"),
                    K.disk_expected_vtype("key_").alias("vtype")))


def disk_parts(hist, items, inv, as_of, lookback_s=DAY, group="AGENTLESS_GROUP", latest=None) -> dict:
    """Pieces of the disk report: ``hist`` (util/used/read/write samples with mount
    and role), ``driver`` (util rows per clock with used), ``io`` (read/write
    samples) and ``capacity`` (latest free / size per mount)."""
    driver, io, cap, h = _disk_parts(hist, items, inv, as_of, lookback_s, group, latest)
    return {"hist": h, "driver": driver, "io": io, "capacity": cap}


def io_nearest(driver: DataFrame, io: DataFrame) -> DataFrame:
    """Nearest read and write sample for every driver row (per mount and role)."""
    key = ["os_kind", "hostid", "mount_key"]
    m = nearest_join(driver.select(*key, "clock"), io, by=key, values=["value"], tie=["ns", "itemid"],
                     channel="role", channel_values=["read", "write"])
    return m.select(*key, "clock", F.col("read_value").alias("read_kbps"), F.col("write_value").alias("write_kbps"))


def io_buckets(io: DataFrame, width: int = 300) -> DataFrame:
    """Max read / write per mount and ``width``-second bucket."""
    return io.groupBy("os_kind", "hostid", "mount_key", F.expr(f"clock div {int(width)}").alias("bucket")).agg(
        F.max(F.when(F.col("role") == "read", F.col("value"))).alias("read_kbps"),
        F.max(F.when(F.col("role") == "write", F.col("value"))).alias("write_kbps"))


def _disk_parts(hist, items, inv, as_of, lookback_s, group, latest=None):
    hosts = group_hosts(inv, group, with_ip=True)
    dim = Dimension(disk_items(items, hosts))
    di = dim.df
    series = dim.bc(di.where(F.col("role").isin("util", "used", "read", "write")))
    h = (_window(hist, as_of, lookback_s).where(F.col("value_type").isin(0, 3))
         .select("itemid", "clock", "ns", "value", "value_type")
         .join(series, (F.col("itemid") == F.col("itemid_num")) & (F.col("value_type") == F.col("vtype")))
         .select("os_kind", "hostid", "node_fqdn", "node_ipv4_address", "mount_key", "role",
                 "clock", "ns", "itemid", safe_numeric("value").alias("value")))
    cap_items = di.where(F.col("role").isin("free", "size"))
    last = latest_item_values(hist, cap_items, value_types=(0, 3), dim=dim, latest=latest)
    cap = (dim.bc(cap_items).join(last, cap_items["itemid_num"] == last["itemid"])
           .groupBy("os_kind", "hostid", "mount_key")
           .agg(F.max(F.when(F.col("role") == "free", safe_numeric("value"))).alias("free_mb"),
                F.max(F.when(F.col("role") == "size", safe_numeric("value"))).alias("size_mb")))
    driver = (h.where(F.col("role").isin("util", "used"))
              .groupBy("os_kind", "hostid", "node_fqdn", "node_ipv4_address", "mount_key", "clock")
              .agg(F.max(F.when(F.col("role") == "util", F.col("value"))).alias("disk_util_pct"),
                   F.max(F.when(F.col("role") == "used", F.col("value"))).alias("disk_used_mb"),
                   F.count_if(F.col("role") == "util").alias("_n_util"))
              .where(F.col("_n_util") > 0).drop("_n_util"))
    io = h.where(F.col("role").isin("read", "write"))
    # mounts come from the size-checked disk item dimension
    return driver, io, cap, h


def _disk_output(d: DataFrame, ordered: bool) -> DataFrame:
    out = d.select(
        F.col("clock").alias("transaction_clock"),
        clock_to_ntz("clock").alias("transaction_datetime"),
        "node_fqdn", "node_ipv4_address",
        F.col("mount_key").alias("dir_name"),
        "disk_util_pct", "read_kbps", "write_kbps", "disk_used_mb",
        F.when(F.col("os_kind") == "unix", F.col("disk_used_mb") + F.col("free_mb"))
        .otherwise(F.col("size_mb")).alias("disk_capacity_mb"),
    )
    if ordered:
        out = out.orderBy(F.col("node_fqdn").asc_nulls_last(), F.col("dir_name").asc_nulls_last(),
                          F.col("transaction_datetime").desc_nulls_first())
    return out


def disk_report(hist: DataFrame, items: DataFrame, inv: DataFrame, as_of: int,
                lookback_s: int | None = DAY, group: str = "AGENTLESS_GROUP",
                match: str = "bucket", width: int = 300, ordered: bool = False,
                latest: DataFrame | None = None) -> DataFrame:
    """Disk utilisation per mount and sample, with IO and latest capacity.

    ``match='nearest'``: read/write = nearest IO sample of the same mount and
    role (window form). ``match='bucket'``: max IO of the same ``width``-second
    bucket, per column falling back to the previous bucket (hash form, no
    sort; the default for exports).
    """
    driver, io, cap, _ = _disk_parts(hist, items, inv, as_of, lookback_s, group, latest)
    key = ["os_kind", "hostid", "mount_key"]
    if match == "nearest":
        m = nearest_join(driver, io, by=key, values=["value"], tie=["ns", "itemid"],
                         channel="role", channel_values=["read", "write"])
        m = m.withColumnRenamed("read_value", "read_kbps").withColumnRenamed("write_value", "write_kbps")
    elif match == "bucket":
        io_wide = io.select(*key, "clock",
                            F.when(F.col("role") == "read", F.col("value")).alias("read_kbps"),
                            F.when(F.col("role") == "write", F.col("value")).alias("write_kbps"))
        m = bucket_join(driver, io_wide, by=key, values=["read_kbps", "write_kbps"], width=width)
    else:
        raise ValueError(f"unknown match mode {match!r}")
    d = m.join(cap, key, "left")
    return _disk_output(d, ordered)
