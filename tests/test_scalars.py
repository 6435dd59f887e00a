import pytest
from pyspark.sql import functions as F

from hostlake.functions import classify as K
from hostlake.functions.scalars import clock_to_ntz, round_half_up, safe_numeric, value_type_name

CASES = [("42", 42.0), ("-0.5", -0.5), ("3.14", 3.14), ("1e3", None), ("1d", None), ("NaN", None),
         (" 1 ", None), ("12\n", None), ("", None), (None, None), (".5", None), ("5.", None), ("0", 0.0)]


def test_safe_numeric_guard(spark):
    df = spark.createDataFrame([(v,) for v, _ in CASES], "v string")
    got = [r[0] for r in df.select(safe_numeric("v")).collect()]
    assert got == [e for _, e in CASES]


def test_value_type_names(spark):
    df = spark.createDataFrame([(i,) for i in range(6)], "v int")
    got = [r[0] for r in df.select(value_type_name("v")).collect()]
    assert got == ["numeric_float", "character", "log", "numeric_unsigned", "text", "unknown"]


def test_round_half_up_and_ntz(spark):
    df = spark.createDataFrame([(0.25, 0), (2.35, 86400)], "x double, c bigint")
    r = df.select(round_half_up("x", 1).alias("r"), clock_to_ntz("c").alias("t")).collect()
    assert [x.r for x in r] == [0.3, 2.4]
    assert str(r[1].t) == "1970-01-02 00:00:00"


@pytest.mark.parametrize("key,role", [
    ("ssh.run[cpu_usage,{$SSH.IP},{$SSH.PORT}]", "cpu"),
    ("ssh.run[cpu_usage_legacy,{$SSH.IP},22]", "cpu"),
    ("winrm_metric.py[{$WINRM.IP},{$WINRM.USER},{$WINRM.PASSWORD},mem_pct]", "mem"),
    ("ssh.run[cpu_core_count_sunos,x]", "core"),
    ("ssh.run[mem_total_mb,{$SSH.IP},{$SSH.PORT}]", "memtot"),
    ("ssh.run[uptime,{$SSH.IP},{$SSH.PORT}]", None),
    # '_' is a LIKE wildcard in the legacy patterns
    ("ssh.run[cpu_usageXlegacy,1]", "cpu"),
])
def test_cpu_mem_role(spark, key, role):
    assert spark.createDataFrame([(key,)], "key_ string").select(K.cpu_mem_role("key_")).first()[0] == role


def test_disk_classification(spark):
    rows = [("fs.usage[/var]",), ("winrm.disk.sizemb[C:]",), ("fs.usage[{#FSNAME}]",), ("agent.ping",)]
    df = spark.createDataFrame(rows, "key_ string").select(
        K.disk_role("key_").alias("r"), K.disk_expected_vtype("key_").alias("v"), K.disk_os_kind("key_").alias("o"),
        K.mount_key("key_").alias("m"), K.disk_item_filter("key_").alias("f"))
    got = [tuple(r) for r in df.collect()]
    assert got[0] == ("util", 3, "unix", "[/var]", True)
    assert got[1] == ("size", 0, "win", "[C:]", True)
    assert got[2][4] is False  # discovery prototype excluded
    assert got[3][0] is None and got[3][3] == "agent.ping"  # no "[": whole key
