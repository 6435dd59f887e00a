"""Normaliser cases (envelopes, class detection, renames, routing, table rows)."""
import json

from pyspark.sql import functions as F

from hostlake.functions import agent_mapping as AM
from hostlake.operators import normalize as N


def run(spark, payloads):
    rows = [(f"r{i}", p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "request_id string, body string") \
        .withColumn("received_at", F.lit("2026-01-01T00:00:00.000000Z")).withColumn("raw_payload_ref", F.lit("raw/x"))
    return N.normalize(df)


def one(spark, payload):
    r = run(spark, [payload]).collect()
    assert len(r) == 1
    return r[0]


def test_global_metrics_renamed(spark):
    r = one(spark, {"class_name": "GLOBAL", "metrics": {"GBL_CPU_TOTAL_UTIL": 42.3, "GBL_CPU_USER_MODE_UTIL": 12.1,
                                                          "GBL_MEM_UTIL": 68.4, "GBL_SYSTEM_UPTIME_SECONDS": 86400}})
    assert r.class_name == "GLOBAL" and r.target_table == "opsb_agent_node"
    assert r.metrics == {"cpu_util_pct": "42.3", "cpu_user_mode_util_pct": "12.1", "mem_util_pct": "68.4",
                         "uptime_s": "86400"}
    assert r.extra_metrics == {}


def test_disk_filesystem_cpu_netif(spark):
    cases = [
        ({"class_name": "DISK", "metrics": {"BYDSK_DEVNAME": "sda", "BYDSK_UTIL": 80.0}}, "opsb_agent_disk",
         {"disk_device_name": "sda", "disk_util_pct": "80.0"}),
        ({"class_name": "FILESYSTEM", "metrics": {"FS_SPACE_UTIL": 55.0}}, "opsb_agent_filesys", {"fs_util_pct": "55.0"}),
        ({"class_name": "CPU", "metrics": {"BYCPU_ID": "cpu0"}}, "opsb_agent_cpu", {"cpu_id": "cpu0"}),
        ({"class_name": "NETIF", "metrics": {"BYNETIF_NAME": "eth0", "BYNETIF_UTIL": 30.0}}, "opsb_agent_netif",
         {"netif_name": "eth0", "netif_util_pct": "30.0"}),
    ]
    for payload, table, metrics in cases:
        r = one(spark, payload)
        assert r.target_table == table and r.metrics == metrics


def test_unknown_class_keeps_metrics_as_extra(spark):
    r = one(spark, {"class_name": "TOTALLY_NEW_CLASS", "metrics": {"BRAND_NEW_METRIC": 1.0}})
    assert r.target_table is None and r.class_name == "TOTALLY_NEW_CLASS"
    assert r.metrics == {} and r.extra_metrics == {"BRAND_NEW_METRIC": "1.0"}


def test_class_from_prefixes_and_unknown(spark):
    assert one(spark, {"metrics": {"GBL_CPU_TOTAL_UTIL": 1, "GBL_MEM_UTIL": 2}}).class_name == "GLOBAL"
    assert one(spark, {"metrics": {"FOO": 1, "BAR": 2}}).class_name == "UNKNOWN"


def test_prefix_vote_tie_goes_to_first_seen(spark):
    r = one(spark, {"metrics": {"BYCPU_ID": "c0", "FS_A": 1, "BYCPU_X": 2, "FS_B": 3}})
    assert r.class_name == "CPU"
    r = one(spark, {"metrics": {"FS_A": 1, "BYCPU_ID": "c0", "BYCPU_X": 2, "FS_B": 3}})
    assert r.class_name == "FILESYSTEM"


def test_explicit_class_is_stripped_and_upper_cased_non_strings_ignored(spark):
    assert one(spark, {"class": "  netif ", "values": {"BYNETIF_NAME": "eth0"}}).class_name == "NETIF"
    assert one(spark, {"class_name": 12, "metrics": {"GBL_MEM_UTIL": 2}}).class_name == "GLOBAL"
    assert one(spark, {"class_name": "   ", "metric_class": "disk", "metrics": {}}).class_name == "DISK"


def test_metrics_at_top_level(spark):
    r = one(spark, {"class_name": "GLOBAL", "GBL_CPU_TOTAL_UTIL": 5, "MonitoredSystem": "x.example"})
    assert r.metrics == {"cpu_util_pct": "5"} and r.node_fqdn == "x.example"


def test_common_fields(spark):
    r = one(spark, {"CollectionConfigName": "P", "MonitoredSystem": "f", "MonitoredSystemID": "s",
                    "node_ipv4_address": "10.0.0.1", "timestamp_utc": 1779638400, "metrics": {}})
    assert (r.collection_policy_name, r.node_fqdn, r.node_short_name, r.node_ipv4_address, r.timestamp_utc_s) == \
        ("P", "f", "s", "10.0.0.1", "1779638400")


def test_records_wrapper_two_classes_order_kept(spark):
    rows = run(spark, [{"records": [{"class_name": "GLOBAL", "metrics": {"GBL_CPU_TOTAL_UTIL": 1}}, "junk",
                                    {"class_name": "DISK", "metrics": {"BYDSK_UTIL": 2}}]}]).orderBy("record_pos").collect()
    assert [(r.record_pos, r.class_name) for r in rows] == [(0, "GLOBAL"), (2, "DISK")]


def test_envelope_shapes(spark):
    rec = {"class_name": "GLOBAL", "metrics": {"GBL_CPU_TOTAL_UTIL": 1}}
    shapes = [rec, [rec, 3, None], {"records": [rec]}, {"data": rec}, {"items": rec}, {"payload": [rec]},
              {"metrics_records": [rec, rec]}, {"records": "not a list", "items": [rec]}, "[1, 2]", "\"text\"", "{bad"]
    rows = run(spark, shapes).groupBy("request_id").agg(F.count_if(~F.col("parse_error")).alias("n"),
                                                         F.max(F.col("parse_error").cast("int")).alias("e")).collect()
    got = {r.request_id: (r.n, r.e) for r in rows}
    assert got == {"r0": (1, 0), "r1": (1, 0), "r2": (1, 0), "r3": (1, 0), "r4": (1, 0), "r5": (1, 0),
                   "r6": (2, 0), "r7": (1, 0), "r10": (0, 1)}


def test_unknown_metric_kept_and_datasource_presence(spark):
    r = one(spark, {"class_name": "GLOBAL", "metrics": {"GBL_FUTURE_UNKNOWN_METRIC": 99.9}})
    assert r.extra_metrics == {"GBL_FUTURE_UNKNOWN_METRIC": "99.9"} and r.datasource == "SCOPE"
    assert one(spark, {"datasource": None, "data_source": "PA", "metrics": {}}).datasource is None
    assert one(spark, {"data_source": "PA", "metrics": {}}).datasource == "PA"


def test_weak_identity_strict_and_lenient(spark):
    strong = {"class_name": "GLOBAL", "MonitoredSystemID": "s1", "metrics": {"GBL_CPU_TOTAL_UTIL": 1}}
    weak = {"class_name": "DISK", "MonitoredSystem": "", "metrics": {"BYDSK_UTIL": 1}}
    n = run(spark, [[strong, weak], [strong]])
    acc, q = N.route(n, strict=True)
    assert sorted(r.request_id for r in acc.collect()) == ["r1"]
    assert [(r.request_id, r.reason, r.weak_record_count, r.total_records) for r in q.collect()] == \
        [("r0", "strict_validation_failed_missing_identity", 1, 2)]
    acc, q = N.route(n, strict=False)
    assert acc.count() == 3
    assert [(r.request_id, r.reason) for r in q.collect()] == [("r0", "weak_identity_non_strict")]
    s = {r.request_id: (r.accepted, r.quarantined) for r in N.request_summary(n, strict=True).collect()}
    assert s == {"r0": (False, True), "r1": (True, False)}


def test_one_output_per_table_and_superset_schema(spark):
    n = run(spark, [[{"class_name": "GLOBAL", "MonitoredSystemID": "s", "metrics": {"GBL_CPU_TOTAL_UTIL": 1}},
                     {"class_name": "DISK", "MonitoredSystemID": "s", "metrics": {"BYDSK_UTIL": 2}}]])
    assert sorted(r[0] for r in n.select("target_table").distinct().collect()) == ["opsb_agent_disk", "opsb_agent_node"]
    rows = N.to_table_rows(n, "opsb_agent_node")
    assert rows.columns == AM.table_schemas(AM.load_mapping())["opsb_agent_node"]
    r = rows.first()
    assert r.cpu_util_pct == 1.0 and r.extra_metrics == {} and r.source == "obm"
    assert dict(rows.dtypes)["timestamp_utc_s"] == "bigint" and dict(rows.dtypes)["os_name"] == "string"


def test_duplicate_keys_last_value_first_position(spark):
    body = '{"class_name": "DISK", "class_name": "GLOBAL", "metrics": {"GBL_MEM_UTIL": 1, "GBL_MEM_UTIL": 2}}'
    r = one(spark, body)
    assert r.class_name == "GLOBAL" and r.metrics == {"mem_util_pct": "2"}


def _payloads(spark, bodies, received="2024-01-02T03:04:05Z"):
    rows = [(f"r{i}", received, f"raw/{i}", b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "request_id string, received_at string, raw_payload_ref string, body string")


def test_requests_without_records_are_counted(spark):
    bodies = [[], {"records": []}, {"records": [1, "x"]}, [None, 3], "{broken", {"records": [{"MonitoredSystem": "a"}, 7]}]
    p = _payloads(spark, bodies)
    s = {r.request_id: tuple(r)[1:] for r in N.request_summary(N.normalize(p, keep_empty=True), strict=True).collect()}
    assert s == {**{f"r{i}": (0, 0, True, False) for i in range(4)}, "r4": (0, 0, True, True), "r5": (1, 0, True, False)}
    # the record path has record rows and unparseable payloads only
    assert sorted((r.request_id, r.parse_error) for r in N.normalize(p).collect()) == [("r4", True), ("r5", False)]


def test_empty_values_are_no_identity(spark):
    values = [0, 0.0, -0.0, False, [], {}, "", None, "0", "false", "[]", 7, True, ["x"], {"a": 1}, " "]
    p = _payloads(spark, [{"MonitoredSystem": v, "metrics": {}} for v in values])
    weak = {int(r.request_id[1:]): r.weak_identity for r in N.normalize(p).collect()}
    assert [weak[i] for i in range(len(values))] == [not v for v in values]
    accepted, quarantined = N.route(N.normalize(p), strict=True)
    assert {r.request_id for r in quarantined.collect()} == {f"r{i}" for i, v in enumerate(values) if not v}
    assert {r.request_id for r in accepted.collect()} == {f"r{i}" for i, v in enumerate(values) if v}


def test_received_at_texts(spark):
    import datetime as dt
    texts = {"2024-01-02T03:04:05Z": (3, 4, 5, 0), "2024-01-02T03:04:05.25Z": (3, 4, 5, 250_000), "2024-01-02T05:04:05+02:00": (3, 4, 5, 0),
             "2024-01-02 03:04:05": (3, 4, 5, 0), "soon": None, "": None, None: None}
    for text, want in texts.items():
        p = _payloads(spark, [{"class_name": "GLOBAL", "MonitoredSystem": "a"}], received=text)
        rows = N.to_table_rows(N.normalize(p), "opsb_agent_node").collect()
        assert [r.received_at for r in rows] == [want and dt.datetime(2024, 1, 2, *want)]


def _tree(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_records_are_parsed_once_and_not_by_filters(spark):
    from hostlake.plans import agent as AG
    from hostlake.registry import Lake, QUERIES, _node
    sf = "/root/testdata/sf0.001"
    lines = _tree(QUERIES["node_cpu_mem"](spark, sf)).splitlines()
    assert not [x for x in lines if "Filter " in x and "from_json" in x]
    # reports that need the nodes twice read them once
    node = _node(spark, sf)
    for df in (AG.identity_overlap(Lake(spark, sf).inv, node), AG.name_bridge(Lake(spark, sf).inv, node)):
        assert _tree(df).count("Generate posexplode") == 1


def test_identity_overlap_of_empty_and_null_addresses(spark):
    from hostlake.plans.agent import identity_overlap
    inv = spark.createDataFrame([("1.1.1.1",), ("1.1.1.1",), (None,), ("2.2.2.2",)], "primary_ip string")
    node = spark.createDataFrame([("1.1.1.1",), (None,), ("3.3.3.3",), ("3.3.3.3",)], "node_ipv4_address string")
    assert tuple(identity_overlap(inv, node).first()) == (4, 2, 2)
    assert tuple(identity_overlap(inv.limit(0), node.limit(0)).first()) == (0, 0, 0)


def test_name_bridge_pairs_once_by_either_name(spark):
    from hostlake.plans.agent import name_bridge
    inv = spark.createDataFrame([("1", "A", "x"), ("2", "b.net", "y"), ("3", None, "z")], "hostid string, name string, primary_ip string")
    node = spark.createDataFrame([("a", "A", "i"), ("b", "B.net", "j"), (None, "a", "k"), (None, None, "l")],
                                 "node_short_name string, node_fqdn string, node_ipv4_address string")
    assert sorted(map(tuple, name_bridge(inv, node).collect()), key=repr) == [
        ("A", "x", "a", "i"), ("A", "x", None, "k"), ("b.net", "y", "b", "j")]
