"""DuckDB texts for the capacity and disk reports and their building blocks.

Which item keys play which role is a table of fixed values that items are joined with. Nearest and latest values are
``arg_min`` / ``arg_max`` over a list of criteria, looked up per report row; buckets are looked up per report row too.
"""

from __future__ import annotations

from .binding import with_binding

GUARD = r"CASE WHEN regexp_full_match({v}, '-?[0-9]+(\.[0-9]+)?') THEN TRY_CAST({v} AS DOUBLE) END"


def guard(v: str) -> str:
    return GUARD.format(v=v)


def ntz(clock: str) -> str:
    return f"make_timestamp(CAST({clock} AS BIGINT) * 1000000)"


# ---- fixed values: item keys (whole, or LIKE patterns), their roles and stored value types --------------------------
KEY_RULES = """
key_rules(family, role, os_kind, vtype, whole, pattern) AS (VALUES
    ('host', 'cpu', NULL, 0, true, 'ssh.run[cpu_usage,{$SSH.IP},{$SSH.PORT}]'),
    ('host', 'cpu', NULL, 0, false, 'ssh.run[cpu_usage_legacy,%'),
    ('host', 'cpu', NULL, 0, false, 'ssh.run[cpu_usage_sunos,%'),
    ('host', 'cpu', NULL, 0, true, 'winrm_metric.py[{$WINRM.IP},{$WINRM.USER},{$WINRM.PASSWORD},cpu_pct]'),
    ('host', 'mem', NULL, 0, true, 'ssh.run[mem_usage,{$SSH.IP},{$SSH.PORT}]'),
    ('host', 'mem', NULL, 0, false, 'ssh.run[mem_usage_legacy,%'),
    ('host', 'mem', NULL, 0, false, 'ssh.run[mem_usage_sunos,%'),
    ('host', 'mem', NULL, 0, true, 'winrm_metric.py[{$WINRM.IP},{$WINRM.USER},{$WINRM.PASSWORD},mem_pct]'),
    ('host', 'core', NULL, 0, true, 'ssh.run[cpu_core_count,{$SSH.IP},{$SSH.PORT}]'),
    ('host', 'core', NULL, 0, false, 'ssh.run[cpu_core_count_legacy,%'),
    ('host', 'core', NULL, 0, false, 'ssh.run[cpu_core_count_sunos,%'),
    ('host', 'core', NULL, 0, true, 'winrm_metric.py[{$WINRM.IP},{$WINRM.USER},{$WINRM.PASSWORD},cpu_core_count]'),
    ('host', 'memtot', NULL, 0, true, 'ssh.run[mem_total_mb,{$SSH.IP},{$SSH.PORT}]'),
    ('host', 'memtot', NULL, 0, false, 'ssh.run[mem_total_mb_legacy,%'),
    ('host', 'memtot', NULL, 0, false, 'ssh.run[mem_total_mb_sunos,%'),
    ('host', 'memtot', NULL, 0, true, 'winrm_metric.py[{$WINRM.IP},{$WINRM.USER},{$WINRM.PASSWORD},mem_total_mb]'),
    ('capacity', 'core', NULL, NULL, false, '%cpu_core_count%'),
    ('capacity', 'memtot', NULL, NULL, false, '%mem_total_mb%'),
    ('disk', 'util', 'unix', 3, false, 'fs.usage[%'),
    ('disk', 'used', 'unix', 3, false, 'fs.used[%'),
    ('disk', 'free', 'unix', 3, false, 'fs.free[%'),
    ('disk', 'read', 'unix', 0, false, 'fs.read_kbps[%'),
    ('disk', 'write', 'unix', 0, false, 'fs.write_kbps[%'),
    ('disk', 'util', 'win', 0, false, 'winrm.disk.usedpct[%'),
    ('disk', 'used', 'win', 3, false, 'winrm.disk.usedmb[%'),
    ('disk', 'size', 'win', 0, false, 'winrm.disk.sizemb[%'),
    ('disk', 'read', 'win', 0, false, 'winrm.disk.readkbps[%'),
    ('disk', 'write', 'win', 0, false, 'winrm.disk.writekbps[%')
),
"""
PROTOTYPE, PROBES = "[{#", ("ssh.run[", "winrm_metric.py[")
# ----------------------------------------------------------------------------------------------------------------------

#: Items of the group's hosts, each with the rule its key fits (keys of a family fit one rule at most).
ITEMS = KEY_RULES + """
group_items AS (
    SELECT CAST(itemid AS BIGINT) AS itemid, hostid, node_fqdn, node_ipv4_address, key_
    FROM items JOIN agentless_hosts USING (hostid)
),
ruled AS (
    SELECT g.*, r.family, r.role, r.os_kind, r.vtype FROM group_items g JOIN key_rules r
    ON CASE WHEN r.whole THEN g.key_ = r.pattern ELSE g.key_ LIKE r.pattern END
),
last_values AS (SELECT itemid, arg_max({'clock': clock, 'value': value}, [clock, ns]) AS l FROM history GROUP BY itemid),
newest AS (SELECT max(clock) AS t FROM history)"""

CAP_VALUES = f"""
cap_items AS (SELECT itemid, hostid, role FROM ruled WHERE family = 'capacity'),
cap_values AS (
    SELECT hostid, role, itemid, l.clock AS clock, {guard('l.value')} AS value FROM cap_items JOIN last_values USING (itemid)
),
cap_newest AS (
    SELECT hostid, role, arg_max({{'clock': clock, 'itemid': itemid, 'value': value}}, [clock, itemid]) AS c
    FROM cap_values GROUP BY hostid, role
),
host_caps AS (
    SELECT hostid, any_value(c.value) FILTER (WHERE role = 'core') AS cpu_core,
           any_value(c.clock) FILTER (WHERE role = 'core') AS cpu_core_clock,
           any_value(c.value) FILTER (WHERE role = 'memtot') AS mem_total_mb,
           any_value(c.clock) FILTER (WHERE role = 'memtot') AS mem_total_clock
    FROM cap_newest GROUP BY hostid
)"""


def host_samples(lookback: int) -> str:
    return ITEMS + f""",
samples AS (
    SELECT r.hostid, r.role, h.clock, h.ns, h.itemid, {guard('h.value')} AS value
    FROM history h JOIN ruled r ON r.itemid = h.itemid AND r.family = 'host' AND r.role IN ('cpu', 'mem')
    WHERE h.value_type = 0 AND h.clock >= (SELECT t FROM newest) - {lookback}
),
known_mem AS (SELECT * FROM samples WHERE role = 'mem' AND value IS NOT NULL)"""


def with_mem(lookback: int) -> str:
    return host_samples(lookback) + """,
cpu_with_mem AS (
    SELECT c.hostid, c.clock, c.value AS cpu_value, (
        SELECT arg_min(m.value, [abs(m.clock - c.clock), m.clock, -m.ns, -m.itemid]) FROM known_mem m
        WHERE m.hostid = c.hostid) AS mem_value
    FROM samples c WHERE c.role = 'cpu' AND c.hostid IN (SELECT hostid FROM known_mem)
)"""


def cpu_report(lookback: int) -> str:
    return with_binding(with_mem(lookback) + "," + CAP_VALUES + f"""
SELECT clock AS transaction_clock, {ntz('clock')} AS "TransactionDatetime", node_fqdn, cpu_core AS "CpuCore",
       mem_total_mb / 1024.0 AS "MemoryCapacity", cpu_value AS "CpuUtil", mem_value AS "MemoryUtil",
       {ntz('cpu_core_clock')} AS "CpuCore_measured_at", {ntz('mem_total_clock')} AS "MemoryCapacity_measured_at"
FROM cpu_with_mem JOIN agentless_hosts USING (hostid) LEFT JOIN host_caps USING (hostid)
""")


def fill_rate(lookback: int) -> str:
    share = "CAST(round(CAST(100.0 * count(cpu_core) / nullif(count(*), 0) AS DECIMAL(38, 9)), 1) AS DOUBLE)"
    return with_binding(with_mem(lookback) + "," + CAP_VALUES + f"""
SELECT count(*) AS total_rows, count(cpu_core) AS cpucore_filled, count(mem_total_mb) AS memcap_filled,
       {share} AS cpucore_pct, count(DISTINCT hostid) AS total_hosts,
       count(DISTINCT CASE WHEN cpu_core IS NOT NULL THEN hostid END) AS hosts_with_capacity
FROM cpu_with_mem LEFT JOIN host_caps USING (hostid)
""")


def directional(lookback: int, side: str) -> str:
    """The last memory sample up to each CPU sample ('<=') or the first one from it on ('>=')."""
    pick = {"<=": "arg_max(m.value, [m.clock, m.ns, m.itemid])", ">=": "arg_min(m.value, [m.clock, -m.ns, -m.itemid])"}[side]
    return with_binding(host_samples(lookback) + f"""
SELECT c.hostid, c.clock, c.value AS cpu_value,
       (SELECT {pick} FROM known_mem m WHERE m.hostid = c.hostid AND m.clock {side} c.clock) AS mem_value
FROM samples c WHERE c.role = 'cpu'
""")


def disk(lookback: int) -> str:
    mount = "substr(key_, greatest(strpos(key_, '['), 1))"
    return ITEMS + f""",
disk_items AS (
    SELECT itemid, hostid, node_fqdn, node_ipv4_address, os_kind, {mount} AS mount_key, role, vtype
    FROM ruled WHERE family = 'disk' AND NOT contains(key_, '{PROTOTYPE}')
),
disk_samples AS (
    SELECT d.os_kind, d.hostid, d.node_fqdn, d.node_ipv4_address, d.mount_key, d.role, h.clock, h.ns, h.itemid,
           {guard('h.value')} AS value
    FROM history h JOIN disk_items d ON d.itemid = h.itemid AND d.vtype = h.value_type
    WHERE d.role NOT IN ('free', 'size') AND h.clock >= (SELECT t FROM newest) - {lookback}
),
numeric_last AS (SELECT itemid, arg_max({{'value': value}}, [clock, ns]) AS l FROM history WHERE value_type IN (0, 3) GROUP BY itemid),
mount_caps AS (
    SELECT os_kind, hostid, mount_key, max({guard('l.value')}) FILTER (WHERE role = 'free') AS free_mb,
           max({guard('l.value')}) FILTER (WHERE role = 'size') AS size_mb
    FROM disk_items JOIN numeric_last USING (itemid) WHERE role IN ('free', 'size') GROUP BY os_kind, hostid, mount_key
),
points AS (
    SELECT os_kind, hostid, node_fqdn, node_ipv4_address, mount_key, clock,
           max(CASE role WHEN 'util' THEN value END) AS disk_util_pct, max(CASE role WHEN 'used' THEN value END) AS disk_used_mb
    FROM disk_samples WHERE role IN ('util', 'used') GROUP BY ALL HAVING bool_or(role = 'util')
)"""


_SAME = "s.os_kind = p.os_kind AND s.hostid = p.hostid AND s.mount_key = p.mount_key"


def nearest_io(role: str) -> str:
    return f"""(SELECT arg_min(s.value, [abs(s.clock - p.clock), s.clock, -s.ns, -s.itemid]) FROM disk_samples s
        WHERE s.role = '{role}' AND s.value IS NOT NULL AND {_SAME})"""


def bucket_io(role: str, width: int) -> str:
    one = f"(SELECT max(s.value) FROM disk_samples s WHERE s.role = '{role}' AND {_SAME} AND s.clock // {width} = p.clock // {width}"
    return f"coalesce({one}), {one} - 1))"


def disk_report(lookback: int, read: str, write: str) -> str:
    return with_binding(disk(lookback) + f"""
SELECT p.clock AS transaction_clock, {ntz('p.clock')} AS transaction_datetime, p.node_fqdn, p.node_ipv4_address,
       p.mount_key AS dir_name, p.disk_util_pct, {read} AS read_kbps, {write} AS write_kbps, p.disk_used_mb,
       CASE p.os_kind WHEN 'unix' THEN p.disk_used_mb + m.free_mb ELSE m.size_mb END AS disk_capacity_mb
FROM points p LEFT JOIN mount_caps m USING (os_kind, hostid, mount_key)
""")


def disk_io(lookback: int, read: str, write: str) -> str:
    return with_binding(disk(lookback) + f"""
SELECT p.os_kind, p.hostid, p.mount_key, p.clock, {read} AS read_kbps, {write} AS write_kbps FROM points p
""")


def io_buckets(lookback: int, width: int) -> str:
    return with_binding(disk(lookback) + f"""
SELECT os_kind, hostid, mount_key, clock // {width} AS bucket, max(CASE role WHEN 'read' THEN value END) AS read_kbps,
       max(CASE role WHEN 'write' THEN value END) AS write_kbps
FROM disk_samples WHERE role IN ('read', 'write') GROUP BY ALL
""")
