"""Item-key classification (CASE / LIKE), as column expressions.

``_`` in the patterns is a LIKE wildcard, kept on purpose (the reports match
with LIKE, not startswith).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import c

# ---- fixed values: item keys the reports recognise --------------------------
# role -> (exact keys, LIKE patterns), checked in this order.
CPU_MEM_ROLE_KEYS = [
    ("cpu",
     ["ssh.run[cpu_usage,{$SSH.IP},{$SSH.PORT}]",
      "winrm_metric.py[{$WINRM.IP},{$WINRM.USER},{$WINRM.PASSWORD},cpu_pct]"],
     ["ssh.run[cpu_usage_legacy,%", "ssh.run[cpu_usage_sunos,%"]),
    ("mem",
     ["ssh.run[mem_usage,{$SSH.IP},{$SSH.PORT}]",
      "winrm_metric.py[{$WINRM.IP},{$WINRM.USER},{$WINRM.PASSWORD},mem_pct]"],
     ["ssh.run[mem_usage_legacy,%", "ssh.run[mem_usage_sunos,%"]),
    ("core",
     ["ssh.run[cpu_core_count,{$SSH.IP},{$SSH.PORT}]",
      "winrm_metric.py[{$WINRM.IP},{$WINRM.USER},{$WINRM.PASSWORD},cpu_core_count]"],
     ["ssh.run[cpu_core_count_legacy,%", "ssh.run[cpu_core_count_sunos,%"]),
    ("memtot",
     ["ssh.run[mem_total_mb,{$SSH.IP},{$SSH.PORT}]",
      "winrm_metric.py[{$WINRM.IP},{$WINRM.USER},{$WINRM.PASSWORD},mem_total_mb]"],
     ["ssh.run[mem_total_mb_legacy,%", "ssh.run[mem_total_mb_sunos,%"]),
]
# Superset prefilter of the CPU/memory keys.
CPU_MEM_PREFILTER = ["ssh.run[%", "winrm_metric.py[%"]
# Broad capacity patterns: role -> LIKE pattern.
CAPACITY_ROLE_PATTERNS = [("core", "%cpu_core_count%"), ("memtot", "%mem_total_mb%")]
# Disk keys: (LIKE pattern, role, expected history value_type).
DISK_KEY_PATTERNS = [
    ("fs.usage[%", "util", 3),
    ("fs.used[%", "used", 3),
    ("fs.free[%", "free", 3),
    ("fs.read_kbps[%", "read", 0),
    ("fs.write_kbps[%", "write", 0),
    ("winrm.disk.usedpct[%", "util", 0),
    ("winrm.disk.usedmb[%", "used", 3),
    ("winrm.disk.sizemb[%", "size", 0),
    ("winrm.disk.readkbps[%", "read", 0),
    ("winrm.disk.writekbps[%", "write", 0),
]
UNIX_DISK_PREFIX = "fs.%"
DISK_PROTOTYPE_MARK = "%[{#%"
# Disk keys counted as 'util' in the volume check; everything else is 'other'.
DISK_UTIL_PATTERNS = ["fs.usage[%", "winrm.disk.usedpct[%"]
DISK_FAMILY_PATTERNS = ["fs.%", "winrm.disk.%"]
# ---------------------------------------------------------------------------


def _any_like(col: Column, patterns: list[str]) -> Column:
    out = None
    for p in patterns:
        term = col.like(p)
        out = term if out is None else (out | term)
    return out


def cpu_mem_role(key: str | Column = "key_") -> Column:
    """cpu / mem / core / memtot from the exact key list or LIKE forms; else NULL."""
    k = c(key)
    expr = None
    for role, exact, likes in CPU_MEM_ROLE_KEYS:
        cond = k.isin(*exact) | _any_like(k, likes)
        expr = F.when(cond, F.lit(role)) if expr is None else expr.when(cond, F.lit(role))
    return expr


def cpu_mem_prefilter(key: str | Column = "key_") -> Column:
    return _any_like(c(key), CPU_MEM_PREFILTER)


def capacity_role(key: str | Column = "key_") -> Column:
    """Broad capacity classification: core / memtot by substring LIKE; else NULL."""
    k = c(key)
    expr = None
    for role, pat in CAPACITY_ROLE_PATTERNS:
        expr = F.when(k.like(pat), F.lit(role)) if expr is None else expr.when(k.like(pat), F.lit(role))
    return expr


def capacity_prefilter(key: str | Column = "key_") -> Column:
    return _any_like(c(key), [p for _, p in CAPACITY_ROLE_PATTERNS])


def disk_role(key: str | Column = "key_") -> Column:
    k = c(key)
    expr = None
    for pat, role, _ in DISK_KEY_PATTERNS:
        expr = F.when(k.like(pat), F.lit(role)) if expr is None else expr.when(k.like(pat), F.lit(role))
    return expr


def disk_expected_vtype(key: str | Column = "key_") -> Column:
    k = c(key)
    expr = None
    for pat, _, vt in DISK_KEY_PATTERNS:
        if vt == 0:
            continue
        expr = F.when(k.like(pat), F.lit(vt)) if expr is None else expr.when(k.like(pat), F.lit(vt))
    return expr.otherwise(F.lit(0))


def disk_os_kind(key: str | Column = "key_") -> Column:
    return F.when(c(key).like(UNIX_DISK_PREFIX), F.lit("unix")).otherwise(F.lit("win"))


def disk_item_filter(key: str | Column = "key_") -> Column:
    """Disk item keys (any role), discovery prototypes excluded."""
    k = c(key)
    return ~k.like(DISK_PROTOTYPE_MARK) & _any_like(k, [p for p, _, _ in DISK_KEY_PATTERNS])


def mount_key(key: str | Column = "key_") -> Column:
    """Key text from the first '[' on; whole key when there is none."""
    k = c(key)
    return F.substring(k, F.greatest(F.locate("[", k), F.lit(1)), F.lit(1 << 30))


def mount_first_param(key: str | Column = "key_") -> Column:
    """Simplified mount key: first parameter after '['."""
    k = c(key)
    rest = F.substring(k, F.locate("[", k) + 1, F.lit(1 << 30))
    return F.split_part(rest, F.lit(","), F.lit(1))


def any_like(col: str | Column, patterns: list[str]) -> Column:
    return _any_like(c(col), patterns)
