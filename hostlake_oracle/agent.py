"""DuckDB oracle for the agent-payload queries.

The expected normalised record of every event is written down directly from
the payload binding's rules (class per event type, explicit class on
event_id % 4 < 2, prefix vote otherwise, weak identity on k % 10 = 0, ...);
no JSON is parsed here.
"""

from __future__ import annotations

from .binding import with_binding

IP = ("'10.' || CAST((user_id // 65536) % 256 AS VARCHAR) || '.' || CAST((user_id // 256) % 256 AS VARCHAR)"
      " || '.' || CAST(user_id % 256 AS VARCHAR)")

AGENT_CTES = f"""
pe AS (
    SELECT event_id, user_id, value AS v, ts,
           CAST(json_extract(props, '$.k') AS INTEGER) AS k,
           epoch_us(ts) // 1000000 AS clock,
           event_id // 2 AS req, (event_id // 2) % 3 AS env,
           CASE event_type WHEN 'click' THEN 'GLOBAL' WHEN 'view' THEN 'DISK' WHEN 'signup' THEN 'FILESYSTEM'
                           WHEN 'purchase' THEN 'NETIF'
                ELSE CASE WHEN event_id % 2 = 0 THEN 'CPU' ELSE 'CONFIGURATION' END END AS cls,
           event_id % 4 < 2 AS has_class,
           CAST(json_extract(props, '$.k') AS INTEGER) % 10 = 0 AS weak,
           lower(printf('Customer#%09d', user_id)) AS short,
           CASE WHEN user_id % 3 = 0 THEN '192.168.0.' || CAST(user_id % 256 AS VARCHAR) ELSE {IP} END AS ip,
           (event_id // 4) % 3 AS ds_mode,
           CASE WHEN user_id % 4 = 3 THEN 'Windows' ELSE 'Linux' END AS os
    FROM events
),
pr AS (
    SELECT *,
           CASE WHEN has_class THEN cls WHEN cls = 'CONFIGURATION' THEN 'GLOBAL' ELSE cls END AS fcls,
           max(ts) OVER (PARTITION BY req) + INTERVAL 2 SECOND AS received
    FROM pe
),
norm AS (
    SELECT 'req-' || CAST(req AS VARCHAR) AS request_id,
           CAST(CASE WHEN env = 1 THEN event_id % 2 ELSE 2 * (event_id % 2) END AS INTEGER) AS record_pos,
           fcls AS class_name,
           CASE WHEN fcls IN ('GLOBAL', 'CONFIGURATION') THEN 'opsb_agent_node'
                WHEN fcls = 'DISK' THEN 'opsb_agent_disk' WHEN fcls = 'FILESYSTEM' THEN 'opsb_agent_filesys'
                WHEN fcls = 'CPU' THEN 'opsb_agent_cpu' ELSE 'opsb_agent_netif' END AS target_table,
           CASE WHEN ds_mode = 1 THEN 'PA' ELSE 'SCOPE' END AS datasource,
           'obm' AS source,
           CASE WHEN weak THEN NULL ELSE short || '.example.local' END AS node_fqdn,
           CASE WHEN weak THEN NULL ELSE short END AS node_short_name,
           ip AS node_ipv4_address,
           clock AS timestamp_utc_s,
           received,
           strftime(received, '%Y-%m-%dT%H:%M:%S.%fZ') AS received_at,
           'raw/' || strftime(received, '%Y/%m/%d') || '/req-' || CAST(req AS VARCHAR) || '.json' AS raw_payload_ref,
           CASE WHEN cls = 'GLOBAL' THEN 'cpu_util_pct,mem_phys_total,mem_util_pct,os_name'
                WHEN cls = 'CONFIGURATION' AND fcls = 'CONFIGURATION' THEN 'boot_time,machine,num_cpu,os_name'
                WHEN cls = 'CONFIGURATION' THEN 'os_name'
                WHEN cls = 'DISK' THEN 'disk_device_name,disk_phys_io_rate,disk_util_pct'
                WHEN cls = 'FILESYSTEM' THEN 'fs_dir_name,fs_type,fs_util_pct'
                WHEN cls = 'CPU' THEN 'cpu_id,cpu_total_util_pct'
                ELSE 'netif_in_byte_rate,netif_name,netif_out_byte_rate' END AS metric_keys,
           CASE WHEN cls = 'GLOBAL' THEN 'GBL_FUTURE_UNKNOWN_METRIC'
                WHEN cls = 'CONFIGURATION' AND fcls = 'CONFIGURATION' THEN ''
                WHEN cls = 'CONFIGURATION' THEN 'GBL_BOOT_TIME,GBL_MACHINE,GBL_NUM_CPU'
                WHEN cls = 'DISK' THEN 'BYDSK_FUTURE'
                WHEN cls = 'FILESYSTEM' THEN 'FS_FUTURE'
                WHEN cls = 'CPU' THEN 'FS_UNKNOWN_A,FS_UNKNOWN_B'
                ELSE 'BYNETIF_FUTURE' END AS extra_keys,
           cls, k, v, user_id, os
    FROM pr
)"""

# non-NULL metric column expressions per table (everything else is NULL)
METRIC_EXPR = {
    "opsb_agent_node": {
        "cpu_util_pct": "CASE WHEN cls = 'GLOBAL' THEN v END",
        "mem_util_pct": "CASE WHEN cls = 'GLOBAL' THEN k END",
        "mem_phys_total": "CASE WHEN cls = 'GLOBAL' THEN (user_id + 1) * 1073741824 END",
        "os_name": "os",
        "boot_time": "CASE WHEN class_name = 'CONFIGURATION' THEN '2024-01-01T00:00:00Z' END",
        "machine": "CASE WHEN class_name = 'CONFIGURATION' THEN 'x86_64' END",
        "num_cpu": "CASE WHEN class_name = 'CONFIGURATION' THEN k % 16 + 1 END",
    },
    "opsb_agent_disk": {
        "disk_device_name": "['sda', 'sdb', 'sdc'][k % 3 + 1]",
        "disk_phys_io_rate": "k",
        "disk_util_pct": "v",
    },
    "opsb_agent_filesys": {
        "fs_dir_name": "['/', '/var', '/home'][k % 3 + 1]",
        "fs_util_pct": "v",
        "fs_type": "'xfs'",
    },
    "opsb_agent_cpu": {
        "cpu_total_util_pct": "v",
        "cpu_id": "'cpu' || CAST(k % 4 AS VARCHAR)",
    },
    "opsb_agent_netif": {
        "netif_name": "'eth' || CAST(k % 2 AS VARCHAR)",
        "netif_in_byte_rate": "v",
        "netif_out_byte_rate": "k",
    },
}
COMMON_EXPR = {
    "collection_policy_name": "'OOTB_AgentMetricCollection'",
    "node_fqdn": "node_fqdn",
    "node_short_name": "node_short_name",
    "node_ip_type": "'ipv4'",
    "node_ipv4_address": "node_ipv4_address",
    "producer_instance_type": "'OBM_AGENT'",
    "tenant_id": "'example-tenant'",
}


# ---- fixed values: columns of the agent tables, as their table definitions have them ('t' text, 'd' double) -----------
COMMON = """cmdb_global_id cmdb_id collection_data_flow collection_type collection_policy_name node_fqdn node_short_name
node_timezone_offset_h node_ip_type node_ipv4_address node_ipv6_address producer_instance_id producer_instance_type
tenant_id""".split()
METRICS = {
    "opsb_agent_node": """active_cpu_count:d cpu_util_pct:d cpu_user_mode_util_pct:d cpu_sys_mode_util_pct:d mem_util_pct:d
        mem_phys_total:d disk_phys_byte_rate:d net_packet_rate:d uptime_s:d os_name:t system_id:t boot_time:t collector:t
        machine:t machine_model:t num_cpu:d num_disk:d""",
    "opsb_agent_disk": """disk_device_name:t disk_device_no:t disk_dir_name:t disk_phys_byte_rate:d disk_phys_io_rate:d
        disk_request_queue:d disk_util_pct:d""",
    "opsb_agent_filesys": """fs_block_size:d fs_device_name:t fs_dir_name:t fs_max_size:d fs_space_used:d fs_util_pct:d
        fs_type:t""",
    "opsb_agent_cpu": "cpu_active:t cpu_clock:d cpu_total_util_pct:d cpu_id:t cpu_interrupt_rate:d cpu_state:t",
    "opsb_agent_netif": """netif_name:t netif_in_byte_rate:d netif_out_byte_rate:d netif_packet_rate:d netif_net_speed:d
        netif_util_pct:d""",
}
META = "class_name datasource source request_id raw_payload_ref".split()
# ----------------------------------------------------------------------------------------------------------------------


def table_select(table: str) -> str:
    cols = [f"CAST({COMMON_EXPR.get(c, 'NULL')} AS VARCHAR) AS {c}" for c in COMMON]
    for name, kind in (m.split(":") for m in METRICS[table].split()):
        sql_type = {"t": "VARCHAR", "d": "DOUBLE"}[kind]
        cols.append(f"CAST({METRIC_EXPR[table].get(name, 'NULL')} AS {sql_type}) AS {name}")
    cols += [*META, "CAST(timestamp_utc_s AS BIGINT) AS timestamp_utc_s", "received AS received_at",
             "extra_keys AS extra_metric_keys"]
    return f"SELECT {', '.join(cols)} FROM norm WHERE target_table = '{table}'"


def _t(table: str) -> str:
    return f"{table} AS ({table_select(table)})"


TABLE_CTES = ",\n".join(_t(t) for t in METRIC_EXPR)


def agent(body: str) -> str:
    return with_binding(AGENT_CTES + ",\n" + TABLE_CTES + ",\n" + body.strip() if not body.strip().upper().startswith("SELECT")
                        else AGENT_CTES + ",\n" + TABLE_CTES + "\n" + body)


ORACLE: dict[str, str] = {}

ORACLE["normalize_records"] = agent("""
SELECT request_id, record_pos, class_name, target_table, datasource, source, node_fqdn, node_short_name,
       node_ipv4_address, CAST(timestamp_utc_s AS BIGINT) AS timestamp_utc_s, received_at, raw_payload_ref,
       metric_keys, extra_keys
FROM norm
""")
for _t_ in METRIC_EXPR:
    ORACLE[f"agent_{_t_.replace('opsb_agent_', '')}_rows"] = agent(f"SELECT * FROM {_t_}")

REQ = """
req AS (
    SELECT request_id, count(*) AS total_records,
           count(*) FILTER (WHERE coalesce(node_fqdn, '') = '' AND coalesce(node_short_name, '') = '') AS weak_record_count
    FROM norm GROUP BY request_id
)"""
ORACLE["route_strict_quarantine"] = agent(REQ + """
SELECT request_id, 'strict_validation_failed_missing_identity' AS reason, weak_record_count, total_records
FROM req WHERE weak_record_count > 0
""")
ORACLE["route_lenient_quarantine"] = agent(REQ + """
SELECT request_id, 'weak_identity_non_strict' AS reason, weak_record_count, total_records
FROM req WHERE weak_record_count > 0
""")
ORACLE["route_strict_accepted"] = agent(REQ + """
SELECT n.request_id, n.record_pos, n.class_name, n.target_table
FROM norm n JOIN req r ON r.request_id = n.request_id WHERE r.weak_record_count = 0
""")
ORACLE["request_summary"] = agent(REQ + """
SELECT request_id, total_records AS record_count, weak_record_count,
       weak_record_count = 0 AS accepted, weak_record_count > 0 AS quarantined
FROM req
""")

ORACLE["node_list"] = agent("SELECT DISTINCT node_short_name FROM opsb_agent_node")
ORACLE["node_info"] = agent("""
SELECT node_short_name AS "Node", node_fqdn AS "FQDN", node_ipv4_address AS "IPv4", os_name AS "OS",
       num_cpu AS "CPU",
       CAST(round(CAST(mem_phys_total / 1024 / 1024 / 1024 AS DECIMAL(38, 9)), 1) AS DOUBLE) AS "RAM_GB",
       collection_policy_name AS "Policy", make_timestamp(timestamp_utc_s * 1000000) AS "Time"
FROM (SELECT *, row_number() OVER (PARTITION BY node_short_name
                                   ORDER BY timestamp_utc_s DESC, received_at DESC, request_id DESC) AS rn
      FROM opsb_agent_node WHERE node_short_name IS NOT NULL)
WHERE rn = 1
""")
ORACLE["node_cpu_mem"] = agent("""
SELECT node_short_name, make_timestamp(timestamp_utc_s * 1000000) AS time, cpu_util_pct AS cpu_pct, mem_util_pct AS mem_pct
FROM opsb_agent_node
""")
ORACLE["node_disk_util"] = agent("""
SELECT node_short_name, make_timestamp(timestamp_utc_s * 1000000) AS time, disk_device_name AS metric, disk_util_pct AS value
FROM opsb_agent_disk WHERE disk_util_pct IS NOT NULL
""")
ORACLE["node_fs_util"] = agent("""
SELECT node_short_name, make_timestamp(timestamp_utc_s * 1000000) AS time, fs_dir_name AS metric, fs_util_pct AS value
FROM opsb_agent_filesys WHERE fs_util_pct IS NOT NULL
""")
ORACLE["net_throughput"] = agent("""
SELECT node_short_name, make_timestamp(timestamp_utc_s * 1000000) AS time, netif_name || ' in' AS metric,
       netif_in_byte_rate AS value FROM opsb_agent_netif
UNION ALL
SELECT node_short_name, make_timestamp(timestamp_utc_s * 1000000), netif_name || ' out', netif_out_byte_rate
FROM opsb_agent_netif
""")
ORACLE["node_profile"] = agent("""
SELECT node_short_name, collection_policy_name, os_name, count(*) AS "rows",
       make_timestamp(max(timestamp_utc_s) * 1000000) AS last_sample
FROM opsb_agent_node
GROUP BY node_short_name, collection_policy_name, os_name
ORDER BY last_sample DESC NULLS LAST, node_short_name NULLS LAST, collection_policy_name NULLS LAST, os_name NULLS LAST
LIMIT 50
""")
ORACLE["freshness"] = agent("""
f AS (
    SELECT 'zabbix_history' AS source, make_timestamp(max(clock) * 1000000) AS last_event FROM history
    UNION ALL
    SELECT 'opsb_agent_node', make_timestamp(max(timestamp_utc_s) * 1000000) FROM opsb_agent_node
    UNION ALL
    SELECT 'opsb_agent_node.received_at', max(received_at) FROM opsb_agent_node
)
SELECT source, last_event, (SELECT max(clock) FROM history) - epoch_us(last_event) // 1000000 AS lag_s FROM f
""")
ORACLE["stream_ingest_lag"] = agent("""
f AS (
    SELECT 'zabbix_history' AS source, make_timestamp(max(clock) * 1000000) AS last_event, count(clock) AS rows_seen FROM history
    UNION ALL
    SELECT 'opsb_agent_node', make_timestamp(max(timestamp_utc_s) * 1000000), count(timestamp_utc_s) FROM opsb_agent_node
    UNION ALL
    SELECT 'opsb_agent_node.received_at', max(received_at), count(received_at) FROM opsb_agent_node
)
SELECT source, last_event, (SELECT max(clock) FROM history) - epoch_us(last_event) // 1000000 AS lag_s, rows_seen FROM f
""")
ORACLE["identity_overlap"] = agent("""
SELECT (SELECT count(*) FROM inventory) AS zabbix_hosts,
       (SELECT count(DISTINCT node_ipv4_address) FROM opsb_agent_node) AS obm_nodes,
       (SELECT count(*) FROM inventory inv
          JOIN (SELECT DISTINCT node_ipv4_address FROM opsb_agent_node) obm
            ON obm.node_ipv4_address = inv.primary_ip) AS matched_by_ip
""")
ORACLE["host_unified"] = agent("""
SELECT inv.hostid AS zabbix_hostid, inv.name AS zabbix_host_name, inv.primary_ip,
       obm.node_short_name AS obm_node_short_name, obm.node_fqdn AS obm_node_fqdn
FROM inventory inv
LEFT JOIN (SELECT DISTINCT node_ipv4_address, node_short_name, node_fqdn FROM opsb_agent_node) obm
       ON obm.node_ipv4_address = inv.primary_ip
""")
ORACLE["name_bridge"] = agent("""
SELECT inv.name AS zabbix_name, inv.primary_ip, obm.node_short_name AS obm_name, obm.node_ipv4_address
FROM inventory inv
JOIN (SELECT DISTINCT node_short_name, node_fqdn, node_ipv4_address FROM opsb_agent_node) obm
  ON lower(obm.node_short_name) = lower(inv.name) OR lower(obm.node_fqdn) = lower(inv.name)
ORDER BY zabbix_name NULLS LAST, obm_name NULLS LAST, obm.node_ipv4_address NULLS LAST, inv.primary_ip NULLS LAST
LIMIT 50
""")

ORACLE["stream_agent_node"] = ORACLE["agent_node_rows"]
ORACLE["stream_quarantine"] = ORACLE["route_lenient_quarantine"]

ORACLE["explode_records"] = agent("SELECT request_id, record_pos, false AS parse_error FROM norm")
ORACLE["detect_class"] = agent("SELECT request_id, record_pos, class_name, target_table FROM norm")
ORACLE["weak_identity"] = agent("SELECT request_id, record_pos, node_fqdn IS NULL AND node_short_name IS NULL AS weak FROM norm")
ORACLE["metric_pairs"] = agent("""
SELECT request_id, record_pos,
       CASE cls WHEN 'GLOBAL' THEN 'GBL_CPU_TOTAL_UTIL,GBL_FUTURE_UNKNOWN_METRIC,GBL_MEM_PHYS,GBL_MEM_UTIL,GBL_OSNAME'
                WHEN 'CONFIGURATION' THEN 'GBL_BOOT_TIME,GBL_MACHINE,GBL_NUM_CPU,GBL_OSNAME'
                WHEN 'DISK' THEN 'BYDSK_DEVNAME,BYDSK_FUTURE,BYDSK_PHYS_IO_RATE,BYDSK_UTIL'
                WHEN 'FILESYSTEM' THEN 'FS_DIRNAME,FS_FUTURE,FS_SPACE_UTIL,FS_TYPE'
                WHEN 'CPU' THEN 'BYCPU_CPU_TOTAL_UTIL,BYCPU_ID,FS_UNKNOWN_A,FS_UNKNOWN_B'
                ELSE 'BYNETIF_FUTURE,BYNETIF_IN_BYTE_RATE,BYNETIF_NAME,BYNETIF_OUT_BYTE_RATE' END AS metric_names
FROM norm
""")
ORACLE["agent_staged_load"] = ORACLE["agent_disk_rows"]
ORACLE["payload_replay"] = ORACLE["agent_node_rows"]
ORACLE["jsonl_and_fanout"] = agent("""
SELECT request_id, record_pos, class_name, node_fqdn, sink FROM norm, (VALUES ('jsonl'), ('parquet')) AS s(sink)
""")
ORACLE["custom_extension"] = agent("""
whole AS (SELECT request_id FROM norm GROUP BY request_id HAVING bool_and(starts_with(node_ipv4_address, '192.168.'))),
taken AS (SELECT * FROM norm WHERE request_id IN (FROM whole)),
disks AS (SELECT request_id, ['sda', 'sdb', 'sdc'][k % 3 + 1] AS name, CAST(v AS DOUBLE) AS value FROM taken WHERE class_name = 'DISK')
SELECT part, disks.* FROM disks, (VALUES ('table'), ('staged')) AS p(part)
UNION ALL SELECT 'sink', request_id, class_name, CAST(record_pos AS DOUBLE) FROM taken
""")
ORACLE["discover_columns"] = agent("""
SELECT DISTINCT unnest(string_split(metric_keys, ',')) AS "column" FROM norm WHERE target_table = 'opsb_agent_node'
UNION SELECT unnest(['collection_policy_name', 'node_fqdn', 'node_short_name', 'node_ip_type', 'node_ipv4_address',
                     'producer_instance_type', 'tenant_id', 'timestamp_utc_s', 'class_name', 'datasource', 'source',
                     'received_at', 'request_id', 'raw_payload_ref', 'extra_metrics'])
""")
