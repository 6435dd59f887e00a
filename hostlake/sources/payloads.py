"""Agent payload sources.

* ``read_payloads``  - the raw archive ``raw/YYYY/MM/DD/<request_id>.json``
  (one payload per file), optionally one day, as payload rows.
* ``payloads_from_events`` - test binding: agent payloads assembled from the
  ``events`` table (two events per request, rotating envelope shapes, explicit
  or inferred class, metrics in a wrapper or at top level, one unmapped metric
  per record, weak identity on some records).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import ntz_to_clock, utc_ntz
from .testbind import host_ip

# ---- fixed values of the payload binding --------------------------------------------
EVENT_CLASS = {"click": "GLOBAL", "view": "DISK", "signup": "FILESYSTEM", "purchase": "NETIF"}
DISK_DEVICES = ["sda", "sdb", "sdc"]
FS_MOUNTS = ["/", "/var", "/home"]
POLICY_NAME = "OOTB_AgentMetricCollection"
TENANT = "example-tenant"
GIB = 1073741824
# -------------------------------------------------------------------------------------


def read_payloads(spark: SparkSession, archive_dir: str, day: str | None = None) -> DataFrame:
    """Payload rows from the raw archive; ``day`` = 'YYYY/MM/DD' limits the scan to one day."""
    glob = f"{archive_dir.rstrip('/')}/{day if day else '*/*/*'}/*.json"
    df = (spark.read.option("pathGlobFilter", "*.json").text(glob, wholetext=True)
          .select(F.col("value").alias("body"), F.col("_metadata.file_path").alias("_path"),
                  utc_ntz(F.col("_metadata.file_modification_time")).alias("received_at")))
    stem = F.regexp_extract("_path", r"([^/]+)\.json$", 1)
    ref = F.regexp_extract("_path", r"(raw/[0-9]{4}/[0-9]{2}/[0-9]{2}/[^/]+\.json)$", 1)
    return df.select(stem.alias("request_id"), "received_at",
                     F.when(ref != "", ref).otherwise(F.col("_path")).alias("raw_payload_ref"), "body")


def read_archive(spark: SparkSession, archive_dir: str, day: str | None = None) -> DataFrame:
    """Payload rows from the archive that ``sinks.archive_raw`` writes (Parquet under y=/m=/d=); ``day`` = 'YYYY/MM/DD'
    reads that day's folder only. The same rows as the archive's stream, so a day can be normalised again."""
    schema = "request_id string, received_at timestamp_ntz, raw_payload_ref string, body string, y string, m string, d string"
    rows = spark.read.schema(schema).parquet(archive_dir)
    if day is not None:
        y, m, d = day.split("/")
        rows = rows.where((F.col("y") == y) & (F.col("m") == m) & (F.col("d") == d))
    return rows.drop("y", "m", "d")


def _pick(arr, idx):
    return F.element_at(F.array(*[F.lit(x) for x in arr]), idx + 1)


def _metrics() -> Column:
    """The metrics of an event's agent record (uid, v, k, cls)."""
    uid, v, k, cls = (F.col(c) for c in ("uid", "v", "k", "cls"))
    os_name = F.when(F.pmod(uid, F.lit(4)) == 3, F.lit("Windows")).otherwise(F.lit("Linux"))

    def on(c, val):
        return F.when(cls == c, val)

    conf_or_glob = cls.isin("GLOBAL", "CONFIGURATION")
    metrics = [
        ("GBL_CPU_TOTAL_UTIL", on("GLOBAL", v)),
        ("GBL_MEM_UTIL", on("GLOBAL", k)),
        ("GBL_MEM_PHYS", on("GLOBAL", (uid + 1) * F.lit(GIB))),
        ("GBL_NUM_CPU", on("CONFIGURATION", F.pmod(k, F.lit(16)) + 1)),
        ("GBL_MACHINE", on("CONFIGURATION", F.lit("x86_64"))),
        ("GBL_OSNAME", F.when(conf_or_glob, os_name)),
        ("GBL_BOOT_TIME", on("CONFIGURATION", F.lit("2024-01-01T00:00:00Z"))),
        ("GBL_FUTURE_UNKNOWN_METRIC", on("GLOBAL", k)),
        ("BYDSK_DEVNAME", on("DISK", _pick(DISK_DEVICES, F.pmod(k, F.lit(3))))),
        ("BYDSK_UTIL", on("DISK", v)),
        ("BYDSK_PHYS_IO_RATE", on("DISK", k)),
        ("BYDSK_FUTURE", on("DISK", F.lit(1))),
        ("FS_DIRNAME", on("FILESYSTEM", _pick(FS_MOUNTS, F.pmod(k, F.lit(3))))),
        ("FS_SPACE_UTIL", on("FILESYSTEM", v)),
        ("FS_TYPE", on("FILESYSTEM", F.lit("xfs"))),
        ("FS_FUTURE", on("FILESYSTEM", k)),
        ("BYCPU_ID", on("CPU", F.concat(F.lit("cpu"), F.pmod(k, F.lit(4)).cast("string")))),
        ("FS_UNKNOWN_A", on("CPU", F.lit(1))),
        ("BYCPU_CPU_TOTAL_UTIL", on("CPU", v)),
        ("FS_UNKNOWN_B", on("CPU", F.lit(2))),
        ("BYNETIF_NAME", on("NETIF", F.concat(F.lit("eth"), F.pmod(k, F.lit(2)).cast("string")))),
        ("BYNETIF_IN_BYTE_RATE", on("NETIF", v)),
        ("BYNETIF_OUT_BYTE_RATE", on("NETIF", k)),
        ("BYNETIF_FUTURE", on("NETIF", F.lit(0))),
    ]
    return F.struct(*[c.alias(n) for n, c in metrics])


def _record(names: list[str]) -> Column:
    """The agent record of an event (event_id, uid, k, cls, clock and its metrics ``m``, called ``names``)."""
    eid, uid, k, cls, mstruct = (F.col(c) for c in ("event_id", "uid", "k", "cls", "m"))
    has_class = F.pmod(eid, F.lit(4)) < 2
    wrapper = F.pmod(eid, F.lit(3))
    weak = F.pmod(k, F.lit(10)) == 0
    short = F.lower(F.format_string("Customer#%09d", uid))
    ip = F.when(F.pmod(uid, F.lit(3)) == 0, F.concat(F.lit("192.168.0."), F.pmod(uid, F.lit(256)).cast("string"))) \
        .otherwise(host_ip(uid))
    ds_mode = F.pmod((eid / 4).cast("bigint"), F.lit(3))
    return F.struct(
        F.when(has_class, F.concat(F.lit(" "), F.lower(cls), F.lit(" "))).alias("class_name"),
        F.lit(POLICY_NAME).alias("CollectionConfigName"),
        F.lit(TENANT).alias("tenant_id"),
        F.when(~weak, F.concat(short, F.lit(".example.local"))).alias("MonitoredSystem"),
        F.when(~weak, short).alias("MonitoredSystemID"),
        F.lit("ipv4").alias("node_ip_type"),
        ip.alias("node_ipv4_address"),
        F.lit("OBM_AGENT").alias("producer_instance_type"),
        F.col("clock").alias("timestamp_utc"),
        F.when(ds_mode == 0, F.lit("SCOPE")).alias("datasource"),
        F.when(ds_mode == 1, F.lit("PA")).alias("data_source"),
        F.when(wrapper == 0, mstruct).alias("metrics"),
        F.when(wrapper == 1, mstruct).alias("values"),
        *[F.when(wrapper == 2, mstruct[n]).alias(n) for n in names],
    )


def payloads_from_events(ev: DataFrame) -> DataFrame:
    """Agent payload rows (request_id, received_at NTZ, raw_payload_ref, body) from events."""
    eid = F.col("event_id")
    cls = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in EVENT_CLASS.items() for x in kv]), F.col("event_type")),
                     F.when(F.pmod(eid, F.lit(2)) == 0, F.lit("CPU")).otherwise(F.lit("CONFIGURATION")))
    # the events' few fields are shuffled; a request's events are then in one task, which makes their texts and groups them
    e = ev.select((eid / 2).cast("bigint").alias("req"), "event_id", F.col("user_id").alias("uid"), F.col("value").alias("v"),
                  F.get_json_object("props", "$.k").cast("int").alias("k"), cls.alias("cls"), "ts").repartition("req")
    # metrics, record and text come out of generators of one row, each a method of its own that the JVM compiles
    e = e.select("*", ntz_to_clock(F.col("ts")).alias("clock"), F.explode(F.array(_metrics())).alias("m"))
    e = e.select("req", "ts", "event_id", F.explode(F.array(_record(e.schema["m"].dataType.names))).alias("r"))
    recs = e.select("req", "ts", F.struct("event_id", F.to_json("r").alias("text")).alias("rec"))
    g = recs.groupBy("req").agg(F.array_sort(F.collect_list("rec")).alias("rs"), F.max("ts").alias("_ts"))
    texts = F.col("rs.text")
    env = F.pmod(F.col("req"), F.lit(3))
    body = (F.when(env == 0, F.concat(F.lit("["), F.array_join(texts, ',"junk",'), F.lit("]")))
            .when(env == 1, F.concat(F.lit('{"request_meta":"batch","records":['), F.array_join(texts, ","), F.lit("]}")))
            .otherwise(F.concat(F.lit('{"payload":['), F.array_join(texts, ",null,"), F.lit("]}"))))
    received = F.timestamp_add("SECOND", F.lit(2), F.col("_ts"))
    rid = F.concat(F.lit("req-"), F.col("req").cast("string"))
    return g.select(
        rid.alias("request_id"),
        received.alias("received_at"),
        F.concat(F.lit("raw/"), F.date_format(received, "yyyy/MM/dd"), F.lit("/"), rid, F.lit(".json")).alias("raw_payload_ref"),
        body.alias("body"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads_from_events(spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet"))
