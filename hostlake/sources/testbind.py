"""Lake tables derived from the driver's test tables.

The monitoring lake tables (history, items, inventory, agent payloads) do not
exist in the test data, so they are derived, deterministically and in full,
from ``events`` and ``customer``. Every derived table is a projection / union
of whole input tables, so its size grows with the scale factor.

history      itemid = user_id*8 + code(event_type), hostid = user_id
             (click 0 cpu, view 1 mem, signup 2 core, purchase 3 memtot, error 4 text)
disk history itemid = 100000000 + user_id*100 + (k % 3)*10 + role
             (util 0 / used 1 from click, free-or-size 2 from signup, read 3 from view,
              write 4 from purchase, prototype 5 from error)
items        per customer: 5 CPU-family items + 3 mounts x 6 disk roles (items may have no data)
inventory    one row per customer
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import ntz_to_clock, value_type_name

# ---- fixed values of the binding ----------------------------------------------
EVENT_CODES = {"click": 0, "view": 1, "signup": 2, "purchase": 3, "error": 4}
CPU_FAMILY_VALUE_TYPES = {0: 0, 1: 0, 2: 3, 3: 3, 4: 4}
DISK_ITEM_BASE = 100_000_000
UNIX_MOUNTS = ["[/]", "[/var]", "[/home]"]
WIN_MOUNTS = ["[C:]", "[D:]", "[E:]"]
AGENTLESS_GROUP = "AGENTLESS_GROUP"
NON_AGENTLESS_SEGMENT = "HOUSEHOLD"
# Host variant (hostid % 4) -> key form: 0 standard ssh, 1 legacy ssh, 2 sunos ssh, 3 winrm.
CPU_FAMILY_KEYS = {
    0: ["ssh.run[cpu_usage,{$SSH.IP},{$SSH.PORT}]",
        "ssh.run[cpu_usage_legacy,{$SSH.IP},22]",
        "ssh.run[cpu_usage_sunos,{$SSH.IP},22]",
        "winrm_metric.py[{$WINRM.IP},{$WINRM.USER},{$WINRM.PASSWORD},cpu_pct]"],
    1: ["ssh.run[mem_usage,{$SSH.IP},{$SSH.PORT}]",
        "ssh.run[mem_usage_legacy,{$SSH.IP},22]",
        "ssh.run[mem_usage_sunos,{$SSH.IP},22]",
        "winrm_metric.py[{$WINRM.IP},{$WINRM.USER},{$WINRM.PASSWORD},mem_pct]"],
    2: ["ssh.run[cpu_core_count,{$SSH.IP},{$SSH.PORT}]",
        "ssh.run[cpu_core_count_legacy,{$SSH.IP},22]",
        "ssh.run[cpu_core_count_sunos,{$SSH.IP},22]",
        "winrm_metric.py[{$WINRM.IP},{$WINRM.USER},{$WINRM.PASSWORD},cpu_core_count]"],
    3: ["ssh.run[mem_total_mb,{$SSH.IP},{$SSH.PORT}]",
        "ssh.run[mem_total_mb_legacy,{$SSH.IP},22]",
        "ssh.run[mem_total_mb_sunos,{$SSH.IP},22]",
        "winrm_metric.py[{$WINRM.IP},{$WINRM.USER},{$WINRM.PASSWORD},mem_total_mb]"],
    4: ["ssh.run[uptime,{$SSH.IP},{$SSH.PORT}]"] * 3
       + ["winrm_metric.py[{$WINRM.IP},{$WINRM.USER},{$WINRM.PASSWORD},uptime]"],
}
CPU_FAMILY_NAMES = {0: "CPU utilization", 1: "Memory utilization", 2: "CPU cores",
                    3: "Total memory", 4: "Uptime text"}
CPU_FAMILY_UNITS = {0: "%", 1: "%", 2: "", 3: "MB", 4: ""}
# disk role code -> (unix key prefix, windows key prefix, unix vtype, windows vtype, name, units)
DISK_ROLES = {
    0: ("fs.usage", "winrm.disk.usedpct", 3, 0, "Disk used %", "%"),
    1: ("fs.used", "winrm.disk.usedmb", 3, 3, "Disk used MB", "MB"),
    2: ("fs.free", "winrm.disk.sizemb", 3, 0, "Disk free/size MB", "MB"),
    3: ("fs.read_kbps", "winrm.disk.readkbps", 0, 0, "Disk read KBps", "KBps"),
    4: ("fs.write_kbps", "winrm.disk.writekbps", 0, 0, "Disk write KBps", "KBps"),
    5: ("fs.usage", "winrm.disk.usedpct", 3, 0, "Disk prototype", "%"),
}
PROTOTYPE_MOUNT = "[{#FSNAME}]"
# -------------------------------------------------------------------------------


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _event_code(col: str = "event_type"):
    return _by_code(F.col(col), EVENT_CODES)


def _by_code(code_col, mapping: dict):
    return F.element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), code_col)


def _clock_ns(ts: str = "ts"):
    clock = ntz_to_clock(F.col(ts))
    micros = F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col(ts))
    ns = (F.pmod(micros, F.lit(1_000_000)) * 1000).cast("int")
    return clock, ns


def is_windows_host(hostid_col) -> "F.Column":
    return F.pmod(hostid_col, F.lit(4)) == 3


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``zabbix_history``: (itemid, hostid, clock, ns, value TEXT, value_type)."""
    ev = _read(spark, sf_dir, "events")
    return history_from_events(ev)


def history_from_events(ev: DataFrame) -> DataFrame:
    clock, ns = _clock_ns()
    code = _event_code()
    base = ev.select(
        F.col("user_id").alias("hostid"), code.alias("code"), clock.alias("clock"), ns.alias("ns"),
        F.col("value").alias("v"), F.col("props"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    win = is_windows_host(F.col("hostid"))
    floor_txt = lambda e: F.floor(e).cast("bigint").cast("string")
    # an event's CPU-family row (role -1) and disk roles are one generator of numbers above one scan; ids and values are
    # made of the role behind it, so that a reader of few columns makes only those
    per_code = {0: (0, 1), 2: (2,), 1: (3,), 3: (4,), 4: (5,)}
    roles = None
    for ev_code, own in per_code.items():
        made = F.array(*[F.lit(r) for r in (-1, *own)])
        roles = F.when(F.col("code") == ev_code, made) if roles is None else roles.when(F.col("code") == ev_code, made)
    role = F.col("role")
    return base.select("*", F.explode(roles.otherwise(F.array(F.lit(-1)))).alias("role")).select(
        F.when(role < 0, F.col("hostid") * 8 + F.col("code"))
        .otherwise(F.lit(DISK_ITEM_BASE) + F.col("hostid") * 100 + F.pmod(F.col("k"), F.lit(3)) * 10 + role).alias("itemid"),
        "hostid", "clock", "ns",
        F.when((role < 0) & F.coalesce(F.col("code") == 4, F.lit(False)), F.concat(F.lit("err "), F.col("props")))
        .when(role.isin(-1, 3, 4), F.col("v").cast("string"))
        .otherwise(floor_txt(F.col("v") * F.when(role == 1, F.lit(10)).when(role == 2, F.lit(100)).otherwise(F.lit(1)))).alias("value"),
        F.when(role < 0, _by_code(F.col("code"), CPU_FAMILY_VALUE_TYPES))
        .when(win, _by_code(role, {r: v[3] for r, v in DISK_ROLES.items()}))
        .otherwise(_by_code(role, {r: v[2] for r, v in DISK_ROLES.items()})).cast("short").alias("value_type"),
    )


def _map(d: dict):
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def items_from_customer(cu: DataFrame) -> DataFrame:
    """``zabbix_items`` (TEXT ids): every host carries the same item templates.

    5 CPU-family items (codes 0..4) and 3 mounts x 6 disk roles per host,
    generated per customer row with ``explode`` (no join, no shuffle); the
    key / name / units / value_type come from literal lookup maps. They leave a
    generator of one row: a filter on a key stays above it, and builds no key of
    its own for each pattern that it tries.
    """
    tmpl = [(0, code, -1) for code in CPU_FAMILY_KEYS] + \
        [(1, role, mnt) for mnt in range(3) for role in DISK_ROLES]
    gen = F.explode(F.array(*[F.struct(F.lit(d).alias("disk"), F.lit(r).alias("r"), F.lit(m).alias("m"))
                              for d, r, m in tmpl])).alias("t")
    h = F.col("c_custkey")
    variant = F.pmod(h, F.lit(4))
    win = is_windows_host(h)
    is_disk = F.col("t.disk") == 1
    r, m = F.col("t.r"), F.col("t.m")
    cpu_keys = {code * 10 + var: key for code, keys in CPU_FAMILY_KEYS.items() for var, key in enumerate(keys)}
    mounts = {i: mnt for i, mnt in enumerate(UNIX_MOUNTS)} | {10 + i: mnt for i, mnt in enumerate(WIN_MOUNTS)}
    win_i = win.cast("int")
    mount = F.when(r == 5, F.lit(PROTOTYPE_MOUNT)).otherwise(F.element_at(_map(mounts), win_i * 10 + m))
    prefix = F.element_at(_map({k * 10 + w: v[w] for k, v in DISK_ROLES.items() for w in (0, 1)}), r * 10 + win_i)
    dvt = F.element_at(_map({k * 10 + w: v[2 + w] for k, v in DISK_ROLES.items() for w in (0, 1)}), r * 10 + win_i)
    itemid = F.when(is_disk, F.lit(DISK_ITEM_BASE) + h * 100 + m * 10 + r).otherwise(h * 8 + r)
    vt = F.when(is_disk, dvt).otherwise(F.element_at(_map(CPU_FAMILY_VALUE_TYPES), r))
    return cu.select(h, gen).select(F.inline(F.array(F.struct(
        itemid.cast("string").alias("itemid"),
        h.cast("string").alias("hostid"),
        F.when(is_disk, F.concat(F.element_at(_map({k: v[4] for k, v in DISK_ROLES.items()}), r), F.lit(" "), mount))
        .otherwise(F.element_at(_map(CPU_FAMILY_NAMES), r)).alias("name"),
        F.when(is_disk, F.concat(prefix, mount))
        .otherwise(F.element_at(_map(cpu_keys), r * 10 + variant)).alias("key_"),
        vt.cast("string").alias("value_type"),
        value_type_name(vt).alias("value_type_name"),
        F.when(is_disk, F.element_at(_map({k: v[5] for k, v in DISK_ROLES.items()}), r))
        .otherwise(F.element_at(_map(CPU_FAMILY_UNITS), r)).alias("units"),
        F.lit("Enabled").alias("status"),
        F.lit("0").alias("templateid"),
    ))))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    # each customer row becomes 23 items: spread the (small) customer rows first so the
    # generated items are built and classified in parallel, not in one task per file
    cu = _read(spark, sf_dir, "customer")
    return items_from_customer(cu.repartition(spark.sparkContext.defaultParallelism))


def host_ip(key_col) -> "F.Column":
    k = key_col.cast("bigint")
    return F.concat_ws(
        ".", F.lit("10"),
        F.pmod((k / 65536).cast("bigint"), F.lit(256)).cast("string"),
        F.pmod((k / 256).cast("bigint"), F.lit(256)).cast("string"),
        F.pmod(k, F.lit(256)).cast("string"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``zabbix_inventory`` from ``customer``: one host per customer."""
    cu = _read(spark, sf_dir, "customer")
    return inventory_from_customer(cu)


def inventory_from_customer(cu: DataFrame) -> DataFrame:
    groups = F.when(F.col("c_mktsegment") == NON_AGENTLESS_SEGMENT, F.array(F.col("c_mktsegment"))) \
        .otherwise(F.array(F.lit(AGENTLESS_GROUP), F.col("c_mktsegment")))
    win = is_windows_host(F.col("c_custkey"))
    return cu.select(
        F.col("c_custkey").cast("string").alias("hostid"),
        F.col("c_name").alias("name"),
        F.lit("").alias("description"),
        F.when(F.col("c_acctbal") >= 0, F.lit("Enabled")).otherwise(F.lit("Disabled")).alias("status"),
        host_ip(F.col("c_custkey")).alias("primary_ip"),
        F.array().cast("array<string>").alias("secondary_ips"),
        F.when(F.pmod(F.col("c_nationkey"), F.lit(5)) == 0, F.lit("Zabbix Server"))
        .otherwise(F.concat(F.lit("Proxy ID: "), F.col("c_nationkey").cast("string"))).alias("monitored_by"),
        groups.alias("host_groups"),
        F.array(F.when(win, F.lit("Windows by WinRM")).otherwise(F.lit("Linux by SSH"))).alias("templates"),
        F.array(F.struct(F.lit("segment").alias("tag"), F.col("c_mktsegment").alias("value"))).alias("tags"),
        F.expr("timestamp_ntz'2024-01-31 00:00:00'").alias("collected_at"),
    )
