"""Structured Streaming jobs.

* ``stream_load_pending``  - staged documents arriving in a folder, loaded
  batch by batch with the declared write method (``foreachBatch``), keeping
  ``latest_values`` current. Replays are safe: documents already in the
  ledger are skipped, if-absent writes are anti-joins, a batch that upserted
  before is read and changes nothing.
* ``stream_agent_metrics`` - archived agent payloads -> normalise -> route ->
  fan-out to the agent tables, unmapped records, quarantine, JSON lines and
  any extra sinks; a failing write quarantines the batch's requests.
* ``stream_history_dedup`` - watermark-bounded de-duplication of overlapping
  history fetch windows.
* ``stream_volume``        - samples per host and 5-minute window with a
  watermark (update mode, merged into a lake table).
* ``stream_freshness``     - newest sample time of history (one-row state).
* ``ProgressLog``          - rows read, late rows and copies of every micro-batch, written down
  (``late_rows`` sums them per stream).
* ``stream_ingest_lag``    - newest record and rows per source over several streams
  (a row of state per source, update mode, merged into a lake table).

Every query takes a checkpoint location; with ``available_now=True`` it
processes what is there (bounded by ``max_files_per_trigger`` per batch,
oldest first) and stops, which is how tests and catch-up runs use it.
"""

from __future__ import annotations

import json
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .. import fs as FS
from ..functions import agent_mapping as AM
from ..functions.scalars import date_parts
from ..operators import normalize as N
from ..operators import sinks as SK
from ..session import bounded_broadcast, scratch_dir
from ..sources import staged as S


def _trigger(writer, available_now: bool, interval: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def _checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """An id that is kept in the checkpoint folder."""
    path = f"{checkpoint}/load_id"
    if FS.read_text(spark, path) is None:
        FS.write_text(spark, path, uuid.uuid4().hex)
    return FS.read_text(spark, path)


PROGRESS = "stream string, batch_id bigint, input_rows bigint, late_rows bigint, copies bigint"


class ProgressLog(StreamingQueryListener):
    """Keeps what the watermark drops: a row (``PROGRESS``) per micro-batch of the session's streams as a file in ``folder``.

    ``stream`` is the id that the stream's checkpoint holds, so a stream goes on with its own rows after a restart, and a
    batch that is reported again changes nothing. A batch whose process ends between commit and report has no row.
    ``late_rows`` are rows behind the watermark: single ones for de-duplication, rows of the partial aggregation for
    windows. ``copies`` are rows that de-duplication took out. Attach it with ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._over, self._changed = set(), threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {"stream": str(p.id), "batch_id": p.batchId, "input_rows": p.numInputRows,
               "late_rows": sum(o.numRowsDroppedByWatermark for o in p.stateOperators),
               "copies": sum(o.customMetrics.get("numDroppedDuplicateRows", 0) for o in p.stateOperators)}
        path = f"{self.folder}/{p.id}-{p.batchId}.json"
        if not FS.exists(self.spark, path):
            FS.write_text(self.spark, path, json.dumps(row))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._over.add(str(event.runId))
            self._changed.notify_all()

    def wait(self, query, timeout_s: float = 60) -> None:
        """Until the rows of all batches of a stream that has ended are written."""
        with self._changed:
            if not self._changed.wait_for(lambda: str(query.runId) in self._over, timeout_s):
                raise TimeoutError(f"no report of the end of stream {query.id} within {timeout_s} s")


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows read, late rows and copies of each stream that a ``ProgressLog`` wrote down in ``folder``."""
    return spark.read.schema(PROGRESS).json(folder).groupBy("stream").agg(
        *[F.sum(c).alias(c) for c in ("input_rows", "late_rows", "copies")])


def staged_files(spark: SparkSession, pending_dir: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming paths of staged files, oldest first. Contents are not read by the stream: a batch is the list of its
    files (kept by the checkpoint), which the batch scan then reads in splits."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"  # of this source, always
    return (spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.json")
            .option("maxFilesPerTrigger", max_files_per_trigger).option("latestFirst", "false")
            .load(pending_dir).select("path"))


def stream_load_pending(spark: SparkSession, pending_dir: str, lake: str, checkpoint: str,
                        max_files_per_trigger: int = 100, available_now: bool = True,
                        interval: str = "5 minutes", partition_tables: dict[str, str] | None = None,
                        latest_tables=()):
    """Continuous staged-file loader; returns the StreamingQuery (``archive_loaded`` then moves loaded files out). The batch id passed on is made of the checkpoint's
    own id and the stream's batch number (both stable across restarts from the checkpoint, and a new checkpoint never
    repeats an old one's), so a replayed batch replaces what it wrote before."""
    own = _checkpoint_id(spark, checkpoint)

    def load(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        files = sorted(r[0] for r in batch.collect())  # at most max_files_per_trigger paths
        lines = scratch_dir(s, "lines")
        try:
            SK.load_docs(s, S.read_staged(s, pending_dir, files, lines), lake, f"stream-{own}-{batch_id}", partition_tables,
                         latest_tables=latest_tables)
        finally:
            FS.delete(s, lines)

    w = staged_files(spark, pending_dir, max_files_per_trigger).writeStream.foreachBatch(load) \
        .option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


def archive_loaded(spark: SparkSession, pending_dir: str, lake: str, archive_dir: str) -> list[str]:
    """Moves the files whose documents are all loaded (by the ledger) out of ``pending_dir``; their paths.

    For a stream that has ended, or before one is started: a running one may still have to repeat its last batch."""
    if not FS.exists(spark, pending_dir):
        return []
    files = [path for path, name, is_dir, _ in FS.list_dir(spark, pending_dir) if not is_dir and S.is_staged(name)]
    left, _ = S.list_pending(spark, pending_dir, tried=SK._documents(spark, lake))
    gone = sorted(set(files) - set(left))
    FS.move_into(spark, gone, archive_dir)
    return gone


def payload_stream(spark: SparkSession, archive_dir: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming payload rows from an archive written by ``archive_raw`` (Parquet, y/m/d)."""
    schema = "request_id string, received_at timestamp_ntz, raw_payload_ref string, body string, y string, m string, d string"
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(archive_dir).drop("y", "m", "d"))


def stream_agent_metrics(spark: SparkSession, archive_dir: str, lake: str, checkpoint: str, strict: bool = False,
                         available_now: bool = True, interval: str = "1 minute",
                         max_files_per_trigger: int = 100, jsonl_dir: str | None = None,
                         extra_sinks=(), mapping: dict | None = None, identity=None):
    """Archive -> normalise -> route -> agent tables, unmapped records, quarantine
    (+ JSON lines, + any ``extra_sinks`` ``(accepted_df, batch_id) -> None``).

    Every folder is written per batch (the checkpoint's own id and the batch number)
    and overwritten on replay, so a retried batch leaves no duplicates and another
    checkpoint over the same output overwrites nothing. ``mapping`` and ``identity``
    (a Column: the record is identified) replace the packaged ones. When a table write fails, the batch's requests
    are quarantined as ``sink_write_failed`` with the error text (their raw
    bodies stay in the archive for replay) and the stream goes on.
    """
    mapping = AM.load_mapping() if mapping is None else mapping
    tables = sorted(set(AM.class_tables(mapping).values()))
    own = _checkpoint_id(spark, checkpoint)

    def sink(batch: DataFrame, number: int) -> None:
        batch_id = f"{own}-{number}"
        norm = N.normalize(batch, mapping).persist()
        bodies = batch.select("request_id", "received_at", "raw_payload_ref", F.col("body").alias("raw_body"))
        try:
            accepted, quarantined = N.route(norm, strict=strict, identity=identity)
            try:
                rows = {t: N.to_table_rows(accepted, t, mapping) for t in tables}
                rows["opsb_agent_unmapped"] = N.unmapped_rows(accepted, mapping)

                def write(t: str) -> None:
                    rows[t].write.mode("overwrite").parquet(f"{lake}/{t}/data/batch_id={batch_id}")

                first, *others = rows
                write(first)  # normalises the batch; the others read what that kept, side by side
                with ThreadPoolExecutor(len(rows)) as pool:
                    list(pool.map(write, others))
                for extra in extra_sinks:
                    extra(accepted, number)
                if jsonl_dir:
                    SK.write_jsonl(accepted.drop("parse_error"), f"{jsonl_dir}/batch_id={batch_id}")
            except Exception as exc:  # noqa: BLE001 - keep the stream alive, the archive allows replay
                quarantined = norm.groupBy("request_id").agg(
                    F.lit("sink_write_failed").alias("reason"),
                    F.max("req_weak_records").alias("weak_record_count"),
                    F.max("req_records").alias("total_records")) \
                    .withColumn("error", F.lit(f"{type(exc).__name__}: {exc}"))
            q = bounded_broadcast(quarantined).join(bodies, "request_id")
            q.select("*", *date_parts("received_at")).write.mode("overwrite").partitionBy("y", "m", "d") \
                .parquet(f"{lake}/_quarantine/batch_id={batch_id}")
        finally:
            norm.unpersist()

    w = payload_stream(spark, archive_dir, max_files_per_trigger).writeStream.foreachBatch(sink) \
        .option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


def stream_volume(spark: SparkSession, history_dir: str, out_table: str, checkpoint: str,
                  width: str = "5 minutes", watermark: str = "10 minutes", available_now: bool = True,
                  interval: str = "1 minute", max_files_per_trigger: int = 100):
    """Samples per host and tumbling window, watermark-bounded state, merged by
    (hostid, window start) into ``out_table``; only touched key buckets are rewritten."""
    schema = "itemid bigint, hostid bigint, clock bigint, ns int, value string, value_type smallint"
    own = _checkpoint_id(spark, checkpoint)
    h = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(history_dir)
    agg = (h.withColumn("ts", F.timestamp_seconds("clock"))
           .withWatermark("ts", watermark)
           .groupBy("hostid", F.window("ts", width).alias("w"))
           .agg(F.count(F.lit(1)).alias("samples"))
           .select("hostid", F.unix_timestamp(F.col("w.start")).alias("bucket_clock"), "samples"))

    def merge(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        lake, table = out_table.rsplit("/", 1)
        if SK.table_meta(s, lake, table) is None:
            SK.ensure_table(s, lake, table, ["hostid", "bucket_clock", "samples"],
                            {"hostid": "bigint", "bucket_clock": "bigint", "samples": "bigint"},
                            key=["hostid", "bucket_clock"], add_updated_at=False)
        b = batch.select(F.lit("b").alias("_file"), F.lit(batch_id).alias("_doc"), F.lit(0).alias("_pos"), "*")
        SK.write_upsert(s, b, lake, table, ["hostid", "bucket_clock"], batch_id=f"vol-{own}-{batch_id}")

    w = agg.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


def stream_freshness(spark: SparkSession, history_dir: str, out_path: str, checkpoint: str,
                     available_now: bool = True, interval: str = "1 minute"):
    """Newest history clock seen so far (one-row state, complete mode), rewritten per batch."""
    schema = "itemid bigint, hostid bigint, clock bigint, ns int, value string, value_type smallint"
    h = spark.readStream.schema(schema).parquet(history_dir)
    agg = h.agg(F.max("clock").alias("last_clock"), F.count(F.lit(1)).alias("rows_seen")) \
        .select(F.lit("zabbix_history").alias("source"), "last_clock", "rows_seen")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    w = agg.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


#: Types of the table that ``stream_ingest_lag`` keeps.
LAG_TYPES = {"source": "string", "last_us": "bigint", "rows_seen": "bigint"}


def stream_ingest_lag(spark: SparkSession, history_dir: str, node_dir: str, out_table: str, checkpoint: str,
                      available_now: bool = True, interval: str = "1 minute", max_files_per_trigger: int = 100):
    """Newest record and rows seen per source, of several streams in one query: history samples, agent node rows by their
    own time and by the time they were received. State is a row per source; each batch merges the sources that changed
    into ``out_table`` (``ingest_lag`` reads it). Rows without a time count as no rows; a source without rows has none here."""
    history = (spark.readStream.schema("clock bigint").option("maxFilesPerTrigger", max_files_per_trigger).parquet(history_dir)
               .select(F.lit("zabbix_history").alias("source"), (F.col("clock") * 1_000_000).alias("us")))
    kinds = spark.read.parquet(node_dir).select("timestamp_utc_s", "received_at").schema
    received = F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col("received_at"))
    times = F.array(F.struct(F.lit("opsb_agent_node").alias("source"), (F.col("timestamp_utc_s").cast("bigint") * 1_000_000).alias("us")),
                    F.struct(F.lit("opsb_agent_node.received_at").alias("source"), received.alias("us")))
    node = (spark.readStream.schema(kinds).option("maxFilesPerTrigger", max_files_per_trigger).parquet(node_dir)
            .select(F.inline(times)))
    newest = (history.unionByName(node).where("us IS NOT NULL").groupBy("source")
              .agg(F.max("us").alias("last_us"), F.count(F.lit(1)).alias("rows_seen")))
    own = _checkpoint_id(spark, checkpoint)

    def merge(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        lake, table = out_table.rsplit("/", 1)
        if SK.table_meta(s, lake, table) is None:
            SK.ensure_table(s, lake, table, list(LAG_TYPES), LAG_TYPES, key=["source"], add_updated_at=False)
        rows = batch.select(F.lit("b").alias("_file"), F.lit(batch_id).alias("_doc"), F.lit(0).alias("_pos"), "*")
        SK.write_upsert(s, rows, lake, table, ["source"], batch_id=f"lag-{own}-{batch_id}")

    w = newest.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


def ingest_lag(newest: DataFrame, as_of: int) -> DataFrame:
    """Newest record, seconds that it lies before ``as_of``, and rows seen per source of ``stream_ingest_lag``'s table."""
    seconds = F.expr("(last_us - pmod(last_us, 1000000)) div 1000000")
    event = F.timestamp_add("MICROSECOND", F.col("last_us"), F.expr("timestamp_ntz'1970-01-01 00:00:00'"))
    return newest.select("source", event.alias("last_event"), (F.lit(as_of) - seconds).alias("lag_s"), "rows_seen")


def stream_history_dedup(spark: SparkSession, history_dir: str, out_path: str, checkpoint: str,
                         watermark: str = "10 minutes", available_now: bool = True, interval: str = "1 minute",
                         max_files_per_trigger: int = 100):
    """History rows (overlapping fetch windows) de-duplicated by (itemid, clock, ns)
    with bounded state: a copy arriving later than ``watermark`` behind the newest
    sample is dropped, like a value the collector's overlap no longer re-reads.
    Output is appended per batch (the checkpoint's own id and the batch number; overwritten on replay)."""
    schema = "itemid bigint, hostid bigint, clock bigint, ns int, value string, value_type smallint"
    own = _checkpoint_id(spark, checkpoint)
    h = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(history_dir)
    d = (h.withColumn("ts", F.timestamp_seconds("clock")).withWatermark("ts", watermark)
         .dropDuplicatesWithinWatermark(["itemid", "clock", "ns"]).drop("ts"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={own}-{batch_id}")

    w = d.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()
