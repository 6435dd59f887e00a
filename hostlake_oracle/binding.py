"""DuckDB form of the test-data binding (see ``hostlake.sources.testbind``).

Written independently in DuckDB SQL so the oracle does not reuse the Spark
plan. Every oracle text starts with ``WITH`` + ``BINDING`` and may then add its
own CTEs.
"""

BINDING = r"""
ev AS (
    SELECT user_id AS hostid,
           CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'signup' THEN 2
                           WHEN 'purchase' THEN 3 WHEN 'error' THEN 4 END AS code,
           epoch_us(ts) // 1000000 AS clock,
           CAST((epoch_us(ts) % 1000000) * 1000 AS INTEGER) AS ns,
           value AS v, props, event_id, ts, user_id, event_type,
           CAST(json_extract(props, '$.k') AS INTEGER) AS k,
           (user_id % 4 = 3) AS win
    FROM events
),
history AS (
    SELECT hostid * 8 + code AS itemid, hostid, clock, ns,
           CASE WHEN code = 4 THEN 'err ' || props ELSE CAST(v AS VARCHAR) END AS value,
           CAST(CASE WHEN code IN (0, 1) THEN 0 WHEN code IN (2, 3) THEN 3 ELSE 4 END AS SMALLINT) AS value_type
    FROM ev
    UNION ALL
    SELECT 100000000 + hostid * 100 + (k % 3) * 10 + d.role, hostid, clock, ns, d.val, CAST(d.vt AS SMALLINT)
    FROM (
        SELECT hostid, clock, ns, k, 0 AS role, CAST(CAST(floor(v) AS BIGINT) AS VARCHAR) AS val,
               CASE WHEN win THEN 0 ELSE 3 END AS vt FROM ev WHERE code = 0
        UNION ALL
        SELECT hostid, clock, ns, k, 1, CAST(CAST(floor(v * 10) AS BIGINT) AS VARCHAR), 3 FROM ev WHERE code = 0
        UNION ALL
        SELECT hostid, clock, ns, k, 2, CAST(CAST(floor(v * 100) AS BIGINT) AS VARCHAR),
               CASE WHEN win THEN 0 ELSE 3 END FROM ev WHERE code = 2
        UNION ALL
        SELECT hostid, clock, ns, k, 3, CAST(v AS VARCHAR), 0 FROM ev WHERE code = 1
        UNION ALL
        SELECT hostid, clock, ns, k, 4, CAST(v AS VARCHAR), 0 FROM ev WHERE code = 3
        UNION ALL
        SELECT hostid, clock, ns, k, 5, CAST(CAST(floor(v) AS BIGINT) AS VARCHAR),
               CASE WHEN win THEN 0 ELSE 3 END FROM ev WHERE code = 4
    ) d
),
item_ids AS (
    SELECT CASE WHEN t.disk = 1 THEN 100000000 + c.c_custkey * 100 + t.m * 10 + t.r
                ELSE c.c_custkey * 8 + t.r END AS itemid,
           c.c_custkey AS hostid,
           CASE WHEN t.disk = 0 THEN CASE t.r WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 3 WHEN 3 THEN 3 ELSE 4 END
                WHEN t.r IN (1) THEN 3
                WHEN t.r IN (3, 4) THEN 0
                WHEN c.c_custkey % 4 = 3 THEN 0 ELSE 3 END AS value_type,
           t.disk = 1 AS is_disk,
           c.c_custkey % 4 AS variant,
           t.r AS code,
           t.r AS drole,
           t.m AS dmount,
           c.c_custkey % 4 = 3 AS win
    FROM customer c
    CROSS JOIN (
        SELECT 0 AS disk, r, -1 AS m FROM range(0, 5) AS a(r)
        UNION ALL
        SELECT 1, r, m FROM range(0, 6) AS a(r), range(0, 3) AS b(m)
    ) t
),
items AS (
    SELECT CAST(itemid AS VARCHAR) AS itemid,
           CAST(hostid AS VARCHAR) AS hostid,
           CASE WHEN is_disk THEN
                    (CASE drole WHEN 0 THEN 'Disk used %' WHEN 1 THEN 'Disk used MB' WHEN 2 THEN 'Disk free/size MB'
                                WHEN 3 THEN 'Disk read KBps' WHEN 4 THEN 'Disk write KBps' ELSE 'Disk prototype' END)
                    || ' ' || mnt
                ELSE CASE code WHEN 0 THEN 'CPU utilization' WHEN 1 THEN 'Memory utilization' WHEN 2 THEN 'CPU cores'
                               WHEN 3 THEN 'Total memory' ELSE 'Uptime text' END
           END AS name,
           CASE WHEN is_disk THEN
                    (CASE WHEN win THEN
                          CASE drole WHEN 0 THEN 'winrm.disk.usedpct' WHEN 1 THEN 'winrm.disk.usedmb'
                                     WHEN 2 THEN 'winrm.disk.sizemb' WHEN 3 THEN 'winrm.disk.readkbps'
                                     WHEN 4 THEN 'winrm.disk.writekbps' ELSE 'winrm.disk.usedpct' END
                     ELSE CASE drole WHEN 0 THEN 'fs.usage' WHEN 1 THEN 'fs.used' WHEN 2 THEN 'fs.free'
                                     WHEN 3 THEN 'fs.read_kbps' WHEN 4 THEN 'fs.write_kbps' ELSE 'fs.usage' END
                     END) || mnt
                ELSE
                    CASE WHEN code = 4 THEN
                              CASE WHEN variant = 3 THEN 'winrm_metric.py[{$WINRM.IP},{$WINRM.USER},{$WINRM.PASSWORD},uptime]'
                                   ELSE 'ssh.run[uptime,{$SSH.IP},{$SSH.PORT}]' END
                         ELSE
                              CASE variant
                                  WHEN 0 THEN 'ssh.run[' || fam || ',{$SSH.IP},{$SSH.PORT}]'
                                  WHEN 1 THEN 'ssh.run[' || fam || '_legacy,{$SSH.IP},22]'
                                  WHEN 2 THEN 'ssh.run[' || fam || '_sunos,{$SSH.IP},22]'
                                  ELSE 'winrm_metric.py[{$WINRM.IP},{$WINRM.USER},{$WINRM.PASSWORD},' || wfam || ']'
                              END
                    END
           END AS key_,
           CAST(value_type AS VARCHAR) AS value_type,
           CASE value_type WHEN 0 THEN 'numeric_float' WHEN 1 THEN 'character' WHEN 2 THEN 'log'
                           WHEN 3 THEN 'numeric_unsigned' WHEN 4 THEN 'text' ELSE 'unknown' END AS value_type_name,
           CASE WHEN is_disk THEN CASE WHEN drole IN (0, 5) THEN '%' WHEN drole IN (1, 2) THEN 'MB' ELSE 'KBps' END
                ELSE CASE code WHEN 0 THEN '%' WHEN 1 THEN '%' WHEN 3 THEN 'MB' ELSE '' END END AS units,
           'Enabled' AS status,
           '0' AS templateid
    FROM (
        SELECT *,
               CASE WHEN drole = 5 THEN '[{#FSNAME}]'
                    WHEN win THEN ['[C:]', '[D:]', '[E:]'][dmount + 1]
                    ELSE ['[/]', '[/var]', '[/home]'][dmount + 1] END AS mnt,
               CASE code WHEN 0 THEN 'cpu_usage' WHEN 1 THEN 'mem_usage' WHEN 2 THEN 'cpu_core_count'
                         ELSE 'mem_total_mb' END AS fam,
               CASE code WHEN 0 THEN 'cpu_pct' WHEN 1 THEN 'mem_pct' WHEN 2 THEN 'cpu_core_count'
                         ELSE 'mem_total_mb' END AS wfam
        FROM item_ids
    ) x
),
inventory AS (
    SELECT CAST(c_custkey AS VARCHAR) AS hostid,
           c_name AS name,
           CASE WHEN c_acctbal >= 0 THEN 'Enabled' ELSE 'Disabled' END AS status,
           '10.' || CAST((c_custkey // 65536) % 256 AS VARCHAR) || '.' || CAST((c_custkey // 256) % 256 AS VARCHAR)
               || '.' || CAST(c_custkey % 256 AS VARCHAR) AS primary_ip,
           CASE WHEN c_nationkey % 5 = 0 THEN 'Zabbix Server' ELSE 'Proxy ID: ' || CAST(c_nationkey AS VARCHAR) END AS monitored_by,
           CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN [c_mktsegment] ELSE ['AGENTLESS_GROUP', c_mktsegment] END AS host_groups,
           CASE WHEN c_custkey % 4 = 3 THEN ['Windows by WinRM'] ELSE ['Linux by SSH'] END AS templates,
           [{'tag': 'segment', 'value': c_mktsegment}] AS tags,
           TIMESTAMP '2024-01-31 00:00:00' AS collected_at,
           c_mktsegment AS segment
    FROM customer
),
agentless_hosts AS (
    SELECT hostid, name AS node_fqdn, primary_ip AS node_ipv4_address
    FROM inventory
    WHERE list_contains(host_groups, 'AGENTLESS_GROUP') AND status = 'Enabled'
)
"""


def with_binding(body: str) -> str:
    """``WITH <binding>, <body>`` where body starts with more CTEs or is ``SELECT``."""
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return "WITH " + BINDING.strip() + "\n" + body
    return "WITH " + BINDING.strip() + ",\n" + body
