"""Lake table writes with declared semantics, and the staged-file loader.

A lake table is a folder ``<lake>/<table>/`` holding ``_table.json`` (columns, Spark types, key, partition column;
written once on creation) and Parquet data. Appended rows are in one folder per loaded batch, ``data/load_batch=<id>``,
written by overwriting: a batch that is repeated replaces itself. Upserted rows are in ``rows``, partitioned by a hash of
the key (``key_bucket``), and a batch replaces the buckets that its keys fall into by Spark's dynamic partition overwrite;
the others are not read. The merged rows are first written to ``_merge/<batch id>``: a run that stopped in the middle is
completed from there when the batch is repeated. One loader writes a table at a time; a reader that meets a bucket being
replaced fails and is repeated.

Write methods (per batch of rows):

* ``write_append``    - append.
* ``write_if_absent`` - first-wins de-duplication in the batch, ``left_anti`` against existing keys (only partitions
  touched by the batch are read), append; rows inserted per document.
* ``write_insert``    - append, but a document whose key collides with the table, with itself, or with an earlier
  document of the batch fails whole.
* ``write_upsert``    - per key and column the last value written wins (key compared as text); columns that no document
  of the batch has keep the stored value; ``updated_at`` = now.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fs as FS
from ..functions.scalars import date_parts
from ..session import Dimension, bounded_broadcast, scratch_dir
from ..sources import staged as S

ORDER_COLS = ("_file", "_doc", "_pos")


#: Hash buckets of a new table's upserted rows: about what one task should rewrite of the largest table.
KEY_BUCKETS = 16
#: So many upserts of a table are remembered, for batches that are repeated.
KEEP_APPLIED = 100
#: Tables that are loaded at a time.
TABLES = 4
#: Bytes of a row group of the archive.
ARCHIVE_BYTES = 4 << 20
#: Up to so many distinct values of a batch's key reach the scan of the stored rows as a list.
LISTED_KEYS = 1000


# --------------------------------------------------------------------------- table folder

def table_meta(spark: SparkSession, lake: str, table: str) -> dict | None:
    t = FS.read_text(spark, f"{lake}/{table}/_table.json")
    return None if t is None else json.loads(t)


def ensure_table(spark: SparkSession, lake: str, table: str, columns: Sequence[str], types: dict[str, str],
                 key: Sequence[str] = (), add_updated_at: bool = True, partition_by: str | None = None,
                 buckets: int | None = None) -> dict:
    """Create the table description if absent; an existing description wins."""
    existing = table_meta(spark, lake, table)
    if existing is not None:
        return existing
    cols = list(columns)
    if add_updated_at and "updated_at" not in cols:
        cols.append("updated_at")
    meta = {"table": table, "columns": cols,
            "types": {c: ("timestamp" if c == "updated_at" and c not in types else types.get(c, "string")) for c in cols},
            "key": list(key), "partition_by": partition_by, "buckets": KEY_BUCKETS if buckets is None else buckets}
    try:
        FS.write_text(spark, f"{lake}/{table}/_table.json", json.dumps(meta))
    except FileExistsError:  # another loader was first
        return table_meta(spark, lake, table)
    return meta


def _schema(meta: dict) -> str:
    schema = ", ".join(f"`{c}` {meta['types'][c]}" for c in meta["columns"])
    return schema + (f", `{meta['partition_by']}` date" if meta.get("partition_by") else "")


def _parts(spark: SparkSession, lake: str, table: str) -> tuple[DataFrame | None, DataFrame | None]:
    """(appended rows with load_batch, upserted rows with key_bucket); None where there are none."""
    meta, found = table_meta(spark, lake, table), []
    if meta is None:
        raise FileNotFoundError(f"no lake table {table!r} under {lake}")
    for folder, extra in (("data", "load_batch string"), ("rows", "key_bucket int")):
        path = f"{lake}/{table}/{folder}"
        found.append(spark.read.schema(f"{_schema(meta)}, {extra}").parquet(path) if FS.exists(spark, path) else None)
    return found[0], found[1]


def read_table(spark: SparkSession, lake: str, table: str, without_batch: str | None = None) -> DataFrame:
    """Current rows of a lake table; an empty frame with the declared schema where nothing was ever written.

    ``without_batch`` leaves out what an earlier try of that batch appended. Errors of the store are raised."""
    appended, upserted = _parts(spark, lake, table)
    if appended is not None and without_batch is not None:
        appended = appended.where(F.col("load_batch") != F.lit(without_batch))
    found = [x.drop("load_batch", "key_bucket") for x in (appended, upserted) if x is not None]
    if not found:
        return spark.createDataFrame([], _schema(table_meta(spark, lake, table)))
    return reduce(DataFrame.unionByName, found)


def _conform(df: DataFrame, meta: dict, keep: Sequence[str] = ()) -> DataFrame:
    cols = [F.col(c) for c in keep if c in df.columns]
    for c in meta["columns"]:
        t = meta["types"][c]
        if c in df.columns:
            cols.append(F.col(c).cast(t).alias(c) if dict(df.dtypes)[c] != t else F.col(c))
        elif c == "updated_at":
            cols.append(F.current_timestamp().cast(t).alias(c))
        else:
            cols.append(F.lit(None).cast(t).alias(c))
    out = df.select(*cols)
    if meta.get("partition_by"):
        out = out.withColumn(meta["partition_by"], partition_expr(meta))
    return out


def partition_expr(meta: dict):
    """Event-date partition column derived from ``clock`` (unix seconds)."""
    from ..functions.scalars import clock_to_ntz
    return F.to_date(clock_to_ntz(F.col("clock")))


def _append(df: DataFrame, meta: dict, lake: str, batch_id: str) -> None:
    """The batch's own folder of an append-style table; what an earlier try left there is replaced."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if meta.get("partition_by"):
        w = w.partitionBy(meta["partition_by"])
    w.parquet(f"{lake}/{meta['table']}/data/load_batch={batch_id}")


# --------------------------------------------------------------------------- write methods

def _first_wins(df: DataFrame, key: Sequence[str], order=ORDER_COLS, last: bool = False) -> DataFrame:
    """One row per key (compared as text): the first (or last) in load order.

    A ``min_by`` / ``max_by`` aggregate: partial aggregation runs before the
    shuffle, so a key with a huge number of copies costs one running pick per
    task instead of one sorted window partition.
    """
    cols = list(df.columns)
    ordc = F.struct(*[F.col(c) for c in order if c in cols])
    pick = (F.max_by if last else F.min_by)(F.struct(*[F.col(c) for c in cols]), ordc)
    g = df.groupBy(*[F.col(k).cast("string").alias(f"_key{i}") for i, k in enumerate(key)]).agg(pick.alias("_p"))
    return g.select(*[F.col(f"_p.{c}").alias(c) for c in cols])


def _near_keys(stored: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """``stored`` without rows that no key of the batch can equal: bounds of every key column, and the values of the
    first one while they are few, as literals, so that they reach the files and skip row groups and partitions.
    One small job over the batch's keys."""
    key = [c for c in key if stored.schema[c].dataType.typeName() not in ("double", "float", "boolean")]
    if not key:
        return stored
    ends = batch.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(key) for n, f in (("low", F.min), ("high", F.max))]).first()
    for i, c in enumerate(key):
        if ends[f"low_{i}"] is None:  # no row has a key
            return stored.where(F.lit(False))
        stored = stored.where((F.col(c) >= F.lit(ends[f"low_{i}"])) & (F.col(c) <= F.lit(ends[f"high_{i}"])))
    few = [r[0] for r in batch.select(key[0]).distinct().limit(LISTED_KEYS + 1).collect()]
    return stored.where(F.col(key[0]).isin([x for x in few if x is not None])) if len(few) <= LISTED_KEYS else stored


def write_append(spark: SparkSession, df: DataFrame, lake: str, table: str, batch_id: str | None = None) -> None:
    meta = table_meta(spark, lake, table)
    _append(_conform(df, meta), meta, lake, batch_id or uuid.uuid4().hex)


def write_if_absent(spark: SparkSession, df: DataFrame, lake: str, table: str, key: Sequence[str],
                    batch_id: str | None = None) -> DataFrame:
    """Insert-if-absent; returns (file_path, doc_pos, inserted) of the documents that inserted rows."""
    meta = table_meta(spark, lake, table)
    batch_id = batch_id or uuid.uuid4().hex
    first = _first_wins(df, key)
    new = _conform(first, meta, keep=("_file", "_doc"))
    existing = read_table(spark, lake, table, without_batch=batch_id)
    new = _checkpointed(spark, new)  # bounds, probe and write read the same rows
    existing = _near_keys(existing, new, [*([meta["partition_by"]] if meta.get("partition_by") else []), *key])
    join_keys = list(key)
    if meta.get("partition_by"):
        # joining on the partition column lets dynamic partition pruning read
        # only the partitions that the batch touches
        join_keys = [meta["partition_by"]] + join_keys
    new_keys = Dimension(new.select(*join_keys))
    if new_keys.small:
        # batch keys are provably small: find the stored ones by scanning the touched partitions against the
        # broadcast batch keys (no shuffle of the stored table); distinct, they are no more than the batch has
        hits = existing.select(*join_keys).join(new_keys.bc(), on=join_keys, how="left_semi").distinct()
        fresh = new.join(F.broadcast(hits), on=join_keys, how="left_anti")
    else:
        fresh = new.join(existing.select(*join_keys), on=join_keys, how="left_anti")
    fresh = _checkpointed(spark, fresh)
    _append(fresh.drop("_file", "_doc"), meta, lake, batch_id)
    new_keys.release()
    if "_file" not in fresh.columns:
        return spark.createDataFrame([], "file_path string, doc_pos int, inserted bigint")
    return fresh.groupBy(F.col("_file").alias("file_path"), F.col("_doc").alias("doc_pos")) \
        .agg(F.count(F.lit(1)).alias("inserted"))


def _checkpointed(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (cuts lineage; reading
    the target table while appending to it is then safe)."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def write_insert(spark: SparkSession, df: DataFrame, lake: str, table: str, key: Sequence[str],
                 batch_id: str | None = None) -> DataFrame:
    """Plain insert; documents with a key conflict fail whole. Returns the failed
    documents ``(file_path, doc_pos, error)``."""
    meta = table_meta(spark, lake, table)
    batch_id = batch_id or uuid.uuid4().hex
    if not key:
        write_append(spark, df, lake, table, batch_id)
        return spark.createDataFrame([], "file_path string, doc_pos int, error string")
    existing = read_table(spark, lake, table, without_batch=batch_id).select(*key)
    # a key's type is the table's, so keys meet as they are stored (and filters reach the files)
    b = df.select("_file", "_doc", "_pos", *[F.col(k).cast(meta["types"][k]).alias(k) for k in key])
    # per key: rows per document and the earliest document holding it (aggregates, skew-safe)
    per_doc = b.groupBy(*key, "_file", "_doc").agg(F.count(F.lit(1)).alias("_n_in_doc"))
    first = per_doc.groupBy(*key).agg(F.min(F.struct("_file", "_doc")).alias("_first_doc"))
    existing = _near_keys(existing, b, key)
    stored = existing.join(first.select(*key), on=list(key), how="left_semi").distinct().withColumn("_in_table", F.lit(True))
    j = per_doc.join(first, on=list(key)).join(stored, on=list(key), how="left")
    bad = j.where(F.col("_in_table").isNotNull() | (F.col("_n_in_doc") > 1)
                  | (F.struct("_file", "_doc") != F.col("_first_doc")))
    failed = bad.groupBy(F.col("_file").alias("file_path"), F.col("_doc").alias("doc_pos")) \
        .agg(F.lit("duplicate key value violates unique constraint").alias("error"))
    failed = _checkpointed(spark, failed)
    ok = df.join(failed.select(F.col("file_path").alias("_file"), F.col("doc_pos").alias("_doc")),
                 on=["_file", "_doc"], how="left_anti")
    _append(_conform(ok, meta), meta, lake, batch_id)  # (``ok`` doesn't read the table: ``failed`` is there already)
    return failed


def key_bucket(key: Sequence[str], buckets: int):
    """The bucket of a key, whose columns are compared as text."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in key]), F.lit(buckets)).cast("int")


def merge_rows(spark: SparkSession, lake: str, table: str, key: Sequence[str], new: DataFrame, merge, batch_id: str | None = None) -> bool:
    """Replaces the buckets that the keys of ``new`` fall into by ``merge(stored rows of them, new)`` (the table's columns).

    False, and nothing changes, where the batch id was applied before; ``new`` is read all the same (a stateful stream
    has to run each batch). Rows that were appended to the table move into buckets with the first upsert after it."""
    meta = table_meta(spark, lake, table)
    batch_id, home = batch_id or uuid.uuid4().hex, f"{lake}/{table}"
    applied, staged = f"{home}/_applied/{batch_id}", f"{home}/_merge/{batch_id}"
    if FS.exists(spark, applied):
        new.write.format("noop").mode("overwrite").save()
        return False
    bucket = key_bucket(key, meta["buckets"])
    if not FS.exists(spark, f"{staged}/_SUCCESS"):
        new = _checkpointed(spark, new)
        appended, upserted = _parts(spark, lake, table)
        touched = [r[0] for r in new.select(bucket.alias("b")).distinct().collect()]  # at most the table's buckets
        old = spark.createDataFrame([], _schema(meta))
        if upserted is not None:
            old = upserted if appended is not None else upserted.where(F.col("key_bucket").isin(touched))
        if appended is not None:
            old = appended.drop("load_batch") if upserted is None else old.drop("key_bucket").unionByName(appended.drop("load_batch"))
        out = merge(old.drop("key_bucket"), new)
        if meta.get("partition_by"):
            out = out.withColumn(meta["partition_by"], partition_expr(meta))
        out.withColumn("key_bucket", bucket).repartition("key_bucket").write.mode("overwrite").partitionBy("key_bucket").parquet(staged)
    merged = spark.read.schema(f"{_schema(meta)}, key_bucket int").parquet(staged)
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("key_bucket").parquet(f"{home}/rows")
    if FS.exists(spark, f"{home}/data"):
        FS.delete(spark, f"{home}/data")  # its rows are in buckets now
    FS.write_text(spark, applied, "")
    FS.delete(spark, staged)
    for path, *_ in sorted(FS.list_dir(spark, f"{home}/_applied"), key=lambda x: FS.modified(spark, x[0]))[:-KEEP_APPLIED]:
        FS.delete(spark, path)
    return True


def write_upsert(spark: SparkSession, df: DataFrame, lake: str, table: str, key: Sequence[str],
                 batch_id: str | None = None) -> bool:
    """Upsert that rewrites the touched buckets only; a batch id that was applied before changes nothing (False).

    Rows with ``_columns`` (the columns their document has) write those columns only; per key and column the last such
    row in load order wins, as if the documents were applied one after another."""
    meta = table_meta(spark, lake, table)
    written = [c for c in df.columns if c in meta["columns"]]
    order = F.struct(*[F.col(c) for c in ORDER_COLS if c in df.columns])
    has = (lambda c: F.array_contains("_columns", c)) if "_columns" in df.columns else (lambda c: F.lit(True))
    names = {c: f"c{i}" for i, c in enumerate(meta["columns"])}
    keys = [f"k{i}" for i in range(len(key))]
    # (struct of the value, so that a NULL that was written differs from no row)
    new = df.groupBy(*[F.col(k).cast("string").alias(n) for k, n in zip(key, keys, strict=True)]).agg(
        F.lit(True).alias("new"),
        *[F.max_by(F.when(has(c), F.struct(F.col(c).cast(meta["types"][c]).alias("v"))), F.when(has(c), order)).alias(f"n_{names[c]}")
          for c in written])
    new = new.select("*", *[F.col(n).alias(k) for k, n in zip(key, keys, strict=True) if k not in new.columns])

    def merge(existing: DataFrame, new: DataFrame) -> DataFrame:
        old = existing.select(*[F.col(k).cast("string").alias(n) for k, n in zip(key, keys, strict=True)],
                              *[F.col(c).alias(f"o_{names[c]}") for c in meta["columns"]])
        both = old.join(new.drop(*key), on=keys, how="full_outer")
        merged = []
        for c in meta["columns"]:
            kept, now = F.col(f"o_{names[c]}"), F.current_timestamp().cast(meta["types"][c])
            if c == "updated_at" and c not in key:
                merged.append(F.when(F.col("new"), now).otherwise(kept).alias(c))
            elif c in written:
                value = F.col(f"n_{names[c]}")
                merged.append(F.when(value.isNotNull(), value["v"]).otherwise(kept).alias(c))
            else:
                merged.append(kept.alias(c))
        return both.select(*merged)

    return merge_rows(spark, lake, table, key, new, merge, batch_id)


# --------------------------------------------------------------------------- loader

LEDGER = ("file_path string, doc_pos int, table string, method string, status string, error string, rows bigint, "
          "inserted bigint, processed_at timestamp, deferred_files bigint, seconds double, batch_id string")


def read_ledger(spark: SparkSession, lake: str) -> DataFrame:
    """One row per document and try: status ok / error / skipped, records (``rows``), rows put into the table
    (``inserted``: fewer than ``rows`` where keys were there already) and how long the write of its table, method and key
    took in that run (``seconds``)."""
    if not FS.exists(spark, f"{lake}/_ledger"):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(f"{lake}/_ledger")


def _documents(spark: SparkSession, lake: str, files: DataFrame | None = None) -> DataFrame:
    """(file_path, doc_pos, tries, done): how often a document was tried, and whether any try ended as ok or skipped.

    ``files`` (n: normalised paths, at most those of one run) cuts the ledger before it is grouped."""
    ledger = read_ledger(spark, lake)
    if files is not None:
        ledger = ledger.withColumn("n", S.normal_path("file_path")).join(bounded_broadcast(files), "n", "left_semi")
    return ledger.groupBy("file_path", "doc_pos").agg(
        F.count(F.lit(1)).alias("tries"), F.max(F.col("status").isin("ok", "skipped")).alias("done"))


def load_pending(spark: SparkSession, pending_dir: str, lake: str, max_files: int | None = None,
                 batch_id: str | None = None, partition_tables: dict[str, str] | None = None,
                 done_dir: str | None = None, latest_tables: Sequence[str] = (),
                 clean_copy_text: bool = False, leave_out: frozenset[str] = frozenset()) -> DataFrame:
    """Load pending staged documents into lake tables, as each document declares.

    Returns the run's ledger rows (see ``read_ledger``), which are also kept in ``<lake>/_ledger``. Documents that are
    in the ledger as ok or skipped are not loaded again; a file is finished when all its documents are, so failed
    documents are tried again. With ``done_dir`` finished files are moved there. At most ``max_files`` files are taken,
    those that failed less often first, then by name; the rest are deferred. Files in ``leave_out`` are not looked at.

    The batch's file list is written down before the first table is touched and goes when the ledger has the batch. A
    run that finds such a list left by a crashed one repeats that batch first, under its id: every write replaces what
    the crashed run had written under it, so nothing is lost or doubled.
    """
    options = dict(partition_tables=partition_tables, latest_tables=latest_tables, clean_copy_text=clean_copy_text)
    ids = [_load_batch(spark, i, files, lake, 0, done_dir, options) for i, files in _started(spark, lake)]
    files, deferred = S.list_pending(spark, pending_dir, max_files, _documents(spark, lake), leave_out)
    if files:
        batch_id = batch_id or uuid.uuid4().hex
        FS.write_text(spark, f"{lake}/_started/{batch_id}.json", json.dumps(files))
        ids.append(_load_batch(spark, batch_id, files, lake, deferred, done_dir, options))
    return read_ledger(spark, lake).where(F.col("batch_id").isin(ids)) if ids else spark.createDataFrame([], LEDGER)


def _started(spark: SparkSession, lake: str) -> list[tuple[str, list[str]]]:
    """(batch id, files) of batches that have begun and not ended."""
    folder = f"{lake}/_started"
    if not FS.exists(spark, folder):
        return []
    return [(name[:-len(".json")], json.loads(FS.read_text(spark, path)))
            for path, name, _, _ in sorted(FS.list_dir(spark, folder)) if name.endswith(".json")]


def _load_batch(spark: SparkSession, batch_id: str, files: list[str], lake: str, deferred: int, done_dir: str | None,
                options: dict) -> str:
    there = [f for f in files if FS.exists(spark, f)]
    if there:
        lines = scratch_dir(spark, "lines")
        try:
            ledger = load_docs(spark, S.read_staged(spark, "", there, lines), lake, batch_id, deferred_files=deferred, **options)
        finally:
            FS.delete(spark, lines)
        if done_dir:
            # the counterpart of deleting a loaded file: move finished files out of pending/
            bad = ledger.where(F.col("status") == "error").select(F.regexp_replace("file_path", "^file:/+", "file:/")).distinct()
            open_files = {r[0] for r in bad.collect()}  # at most the files of this batch
            _move_files(spark, [f for f in there if S._norm_path(f) not in open_files], done_dir)
    FS.delete(spark, f"{lake}/_started/{batch_id}.json")
    return batch_id


def _move_files(spark: SparkSession, files: list[str], target: str) -> None:
    FS.move_into(spark, files, target)


def load_pending_budgeted(spark: SparkSession, pending_dir: str, lake: str, time_budget_s: float,
                          files_per_batch: int = 100, **kwargs) -> DataFrame:
    """``load_pending`` in oldest-first batches of ``files_per_batch`` files until
    ``time_budget_s`` is spent; files not reached are deferred to the next run
    (their count is in the last batch's ledger rows). Each batch is one
    distributed load; the loop runs over batches, never over files. A file is tried
    once per run, so files that fail don't keep others from being reached."""
    start = time.monotonic()
    ledgers, seen = [], set()
    while True:
        led = load_pending(spark, pending_dir, lake, max_files=files_per_batch, leave_out=frozenset(seen), **kwargs)
        files = {r[0] for r in led.select(S.normal_path("file_path")).distinct().collect()}  # at most files_per_batch
        if not files - seen:
            break
        seen |= files
        ledgers.append(led)
        if time.monotonic() - start >= time_budget_s:
            break
    if not ledgers:
        return spark.createDataFrame([], LEDGER)
    # deferred files: what the last batch left behind
    last_deferred = ledgers[-1].agg(F.max("deferred_files")).first()[0] or 0
    return reduce(DataFrame.unionByName, ledgers).withColumn("deferred_files", F.lit(int(last_deferred)).cast("bigint"))


def load_docs(spark: SparkSession, docs: DataFrame, lake: str, batch_id: str,
              partition_tables: dict[str, str] | None = None, deferred_files: int = 0,
              latest_tables: Sequence[str] = (), clean_copy_text: bool = False) -> DataFrame:
    """Load a batch of staged documents ``(file_path, doc_pos, doc)``; see ``load_pending``.

    All documents of one table, method and key are one write, whatever their columns. A document fails by itself: for
    its envelope, a column that the table lacks, a value that is not of its column's type, a NULL in a key column, or a
    conflicting key; none of its rows is loaded, and the ledger says why. If a write as a whole fails, its documents
    are errors and the other groups go on.

    Tables named in ``latest_tables`` (history-shaped) also refresh the ``latest_values`` table from the same batch.
    ``clean_copy_text`` turns tab / newline / CR in text values of ``copy`` documents into spaces, as a tab-separated
    bulk load must (off by default: Parquet keeps text exactly). Used as is by the streaming loader's ``foreachBatch``.
    """
    own = docs.select(S.normal_path("file_path").alias("n")).distinct()
    done = _documents(spark, lake, own).where("done").select("file_path", "doc_pos")
    earlier = read_ledger(spark, lake).where(F.col("batch_id") == F.lit(batch_id)).select("file_path", "doc_pos").distinct()
    # what this batch id has done itself is done again in the same way: it is a repeated run
    done = done.join(earlier, ["file_path", "doc_pos"], "left_anti")
    # (documents are left out before they are parsed, and are not shuffled for it while few are done; the text of a document is
    # not kept beside its records)
    parsed = S.parse_envelope(docs.join(bounded_broadcast(done), ["file_path", "doc_pos"], "left_anti")).drop("doc")
    # kept compressed, and not in the executors' memory: documents may be as large as they like
    folder = scratch_dir(spark, "parsed")
    try:
        return _load_parsed(spark, S.kept(parsed, folder), lake, batch_id, partition_tables, deferred_files, latest_tables, clean_copy_text)
    finally:
        FS.delete(spark, folder)


def _load_parsed(spark: SparkSession, parsed: DataFrame, lake: str, batch_id: str, partition_tables: dict[str, str] | None,
                 deferred_files: int, latest_tables: Sequence[str], clean_copy_text: bool) -> DataFrame:
    ok = parsed.where(F.col("status") == "ok")
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    # one row per (table, method, key): names of columns, and the first document's declaration of the table
    groups = (ok.groupBy(F.col("meta.table").alias("table"), "method", F.col("meta.conflict_target").alias("key"))
              .agg(flat(F.array_sort("columns")).alias("columns"),
                   flat(F.coalesce("meta.json_columns", F.array().cast("array<string>"))).alias("json_columns"),
                   F.min(F.struct("file_path", "doc_pos")).alias("first"),
                   F.min_by(F.struct("columns", "meta"), F.struct("file_path", "doc_pos")).alias("d"))
              .collect())
    failed, counts, took = [], [], []

    def load(own: list) -> None:
        for g in own:
            part_docs = ok.where((F.col("meta.table") == g["table"]) & (F.col("method") == g["method"])
                                 & F.col("meta.conflict_target").eqNullSafe(
                                     F.lit(None) if g["key"] is None else F.array(*[F.lit(k) for k in g["key"]]).cast("array<string>")))
            begun = time.monotonic()
            try:
                bad, inserted = _load_group(spark, part_docs, g, lake, batch_id, partition_tables or {}, latest_tables, clean_copy_text)
            except Exception as exc:  # noqa: BLE001 - this group's documents are errors, the others are loaded
                text = f"{type(exc).__name__}: {exc}"
                bad, inserted = part_docs.select("file_path", "doc_pos", F.lit(text).alias("error")), None
            took.append((g["table"], g["method"], g["key"], time.monotonic() - begun))
            failed.append(bad)
            if inserted is not None:
                counts.append(inserted)

    tables: dict[str, list] = {}
    for g in sorted(groups, key=lambda r: tuple(r["first"])):
        tables.setdefault("" if latest_tables else g["table"], []).append(g)  # (latest values are a table of all others)
    with ThreadPoolExecutor(TABLES) as pool:  # tables side by side, the groups of a table one after another
        list(pool.map(load, tables.values()))
    base = parsed.select("file_path", "doc_pos", F.col("meta.table").alias("table"), "method", "status", "error",
                         F.size("records").cast("bigint").alias("rows"),
                         F.col("meta.conflict_target").alias("_key"))
    empty = {"error": "file_path string, doc_pos int, error string", "inserted": "file_path string, doc_pos int, inserted bigint"}
    errors, found = (reduce(DataFrame.unionByName, x, spark.createDataFrame([], empty[n]))
                     for n, x in (("error", failed), ("inserted", counts)))
    errors = errors.groupBy("file_path", "doc_pos").agg(F.min("error").alias("_error"))
    base = base.join(errors, ["file_path", "doc_pos"], "left").join(found, ["file_path", "doc_pos"], "left")
    base = base.withColumn("status", F.when(F.col("_error").isNotNull(), F.lit("error")).otherwise(F.col("status"))) \
        .withColumn("error", F.coalesce("error", "_error"))
    times = spark.createDataFrame(took, "t string, m string, k array<string>, seconds double")
    base = base.join(F.broadcast(times), (F.col("table") == F.col("t")) & (F.col("method") == F.col("m")) & F.col("_key").eqNullSafe(F.col("k")), "left")
    loaded = F.col("status") == "ok"
    by_key = (F.col("method") == "copy") & (F.coalesce(F.size("_key"), F.lit(0)) > 0)
    ledger = base.withColumn("inserted", F.when(~loaded, 0).when(by_key, F.coalesce("inserted", F.lit(0))).otherwise(F.col("rows")).cast("bigint")) \
        .withColumn("rows", F.when(loaded, F.col("rows")).otherwise(0).cast("bigint")) \
        .withColumn("processed_at", F.current_timestamp()) \
        .withColumn("deferred_files", F.lit(deferred_files).cast("bigint")) \
        .select("file_path", "doc_pos", "table", "method", "status", "error", "rows", "inserted", "processed_at", "deferred_files", "seconds")
    ledger.write.mode("overwrite").parquet(f"{lake}/_ledger/batch_id={batch_id}")
    return read_ledger(spark, lake).where(F.col("batch_id") == F.lit(batch_id))


def _load_group(spark: SparkSession, docs: DataFrame, g, lake: str, batch_id: str, partition_tables: dict[str, str],
                latest_tables: Sequence[str], clean_copy_text: bool) -> tuple[DataFrame, DataFrame | None]:
    """Writes the documents of one (table, method, key); (failed documents with errors, rows inserted per document)."""
    table, method, key = g["table"], g["method"], list(g["key"] or [])
    first, declared = list(g["d"]["columns"]), g["d"]["meta"]
    types = S.column_types(first, list(declared["json_columns"] or []), dict(declared["column_types"] or {}))
    meta = ensure_table(spark, lake, table, first, types, key=key, add_updated_at=declared["add_updated_at"] is not False,
                        partition_by=partition_tables.get(table) if "clock" in first else None)
    own_id = f"{batch_id}-{hashlib.sha256(json.dumps([table, method, key]).encode()).hexdigest()[:8]}"
    lacking = F.array_except("columns", F.array(*[F.lit(c) for c in meta["columns"]]))
    unknown = docs.where(F.size(lacking) > 0).select(
        "file_path", "doc_pos", F.concat(F.lit("column "), F.element_at(lacking, 1), F.lit(" does not exist")).alias("error"))
    docs = docs.where(F.size(lacking) == 0)
    cols = {c: meta["types"][c] for c in meta["columns"] if c in g["columns"]}
    unique = list(meta.get("key") or key) if method == "insert" else key
    folder = scratch_dir(spark, "records")
    try:
        recs = S.kept(S.records_frame(docs, cols, [c for c in g["json_columns"] if c in cols], unique), folder)
        wrong = _checkpointed(spark, recs.where(F.col("_bad").isNotNull()).groupBy(
            F.col("_file").alias("file_path"), F.col("_doc").alias("doc_pos")).agg(F.min_by("_bad", "_pos").alias("error")))
        good = recs.join(wrong.select(F.col("file_path").alias("_file"), F.col("doc_pos").alias("_doc")), ["_file", "_doc"],
                         "left_anti").drop("_bad")
        failed, inserted = unknown.unionByName(wrong), None
        if clean_copy_text and method == "copy":
            from ..functions.scalars import clean_text
            good = good.withColumns({c: clean_text(c) for c, t in cols.items() if t == "string" and c not in g["json_columns"]})
        if method == "copy" and key:
            inserted = _checkpointed(spark, write_if_absent(spark, good, lake, table, key, own_id))
        elif method == "copy":
            write_append(spark, good, lake, table, own_id)
        elif method == "insert":
            failed = failed.unionByName(write_insert(spark, good, lake, table, unique, own_id))
        else:
            write_upsert(spark, good, lake, table, key, batch_id=own_id)
        if table in set(latest_tables):
            from .latest import update_latest
            update_latest(spark, lake, good, batch_id=own_id)
        return _checkpointed(spark, failed), inserted
    except Exception:
        # the group's documents become errors and are tried again under another batch id: what they appended goes
        if FS.exists(spark, f"{lake}/{table}/data/load_batch={own_id}"):
            FS.delete(spark, f"{lake}/{table}/data/load_batch={own_id}")
        raise
    finally:
        FS.delete(spark, folder)


def load_summary(ledger: DataFrame) -> DataFrame:
    """processed / errors / skipped documents of a run, rows loaded, files deferred."""
    return ledger.agg(
        F.count_if(F.col("status") == "ok").alias("processed"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(F.max("deferred_files"), F.lit(0)).cast("bigint").alias("deferred"),
    )


def load_rates(ledger: DataFrame) -> DataFrame:
    """Documents, rows and rows a second of each table and method of a run, and of the run (NULL table and method)."""
    runs = ledger.where("seconds IS NOT NULL").groupBy("batch_id", "table", "method", "seconds").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("rows").alias("rows"))
    sums = runs.rollup(F.struct("table", "method").alias("g")).agg(
        F.sum("documents").alias("documents"), F.sum("rows").alias("rows"), F.sum("seconds").alias("seconds"))
    return sums.select("g.table", "g.method", "documents", "rows", "seconds",
                       F.try_divide(F.col("rows").cast("double"), F.col("seconds")).alias("rows_per_s"))


# --------------------------------------------------------------------------- staged output

#: SQL types that staged documents declare, by Spark type.
STAGED_TYPES = {"double": "DOUBLE PRECISION", "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT",
                "boolean": "BOOLEAN", "timestamp": "TIMESTAMPTZ", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def write_staged(df: DataFrame, pending_dir: str, table: str, method: str, key: Sequence[str] = (),
                 column_types: dict[str, str] | None = None, json_columns: Sequence[str] = (),
                 add_updated_at: bool = True, source: str = "hostlake", group_cols: Sequence[str] = (),
                 max_records: int = 5000, extra_meta: dict | None = None, order_cols: Sequence[str] = (),
                 without: Sequence[str] = (), files: int | None = None) -> None:
    """Write rows as ``{meta, data}`` staged documents, one per line.

    Rows are grouped by ``group_cols`` (e.g. request id). Without ``order_cols`` the rows have no order: groups (or all
    rows) are split into chunks of about ``max_records`` by a hash of the row and its number among equal rows, so no group
    becomes one huge document or one task, and a task that is repeated makes the same chunks. With ``order_cols`` a group's records are written in that order, cut every
    ``max_records``, and files are named so that they are loaded in that order (last-wins upserts rely on it; a group
    is then sorted in one task). Data values are written as JSON with NULLs kept; columns ``without`` are left out.
    ``files``: without an order, the finished documents are dealt over so many files at most. Rows partitioned for that
    beforehand would have their groups made in so few tasks too.
    """
    meta = {"table": table, "method": method, "source": source, "add_updated_at": add_updated_at}
    if key:
        meta["conflict_target"] = list(key)
    if column_types:
        meta["column_types"] = dict(column_types)
    if json_columns:
        meta["json_columns"] = list(json_columns)
    if extra_meta:
        meta.update(extra_meta)
    spark, g = df.sparkSession, list(group_cols)
    own = [c for c in df.columns if c not in g and c not in without]
    rec = F.to_json(F.struct(*[F.col(c) for c in own]), {"ignoreNullFields": "false"}).alias("_rec")
    if order_cols:
        if g:
            placed = df.select(*g, rec, F.struct(*order_cols).alias("_at"))
            by = Window.partitionBy(*g).orderBy("_at")
        else:  # ranges of the order are numbered one by one
            placed = df.select(rec, F.struct(*order_cols).alias("_at")).repartitionByRange("_at")
            placed = _checkpointed(spark, placed.withColumn("_range", F.spark_partition_id()))
            g, by = ["_range"], Window.partitionBy("_range").orderBy("_at")
        placed = placed.withColumn("_n", F.row_number().over(by))
        placed = placed.withColumn("_chunk", F.floor((F.col("_n") - 1) / F.lit(max_records)))
        docs = placed.groupBy(*g, "_chunk").agg(F.transform(
            F.array_sort(F.collect_list(F.struct("_n", "_rec"))), lambda x: x["_rec"]).alias("_recs"))
        docs = docs.repartitionByRange(*g, "_chunk").sortWithinPartitions(*g, "_chunk")
    else:
        equal = df.select(*g, rec).groupBy(*g, "_rec").agg(F.count(F.lit(1)).alias("_copies"))
        if g:
            sizes = equal.groupBy(*g).agg(F.sum("_copies").alias("_n"))
            equal = equal.join(bounded_broadcast(sizes), g)
        else:
            equal = equal.withColumn("_n", F.lit(df.count()))
        n_chunks = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(max_records)))
        each = equal.select(*g, "_rec", n_chunks.alias("_chunks"), F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"))
        each = each.withColumn("_chunk", F.pmod(F.xxhash64("_rec", F.col("_copy")), F.col("_chunks")))
        if files is None:
            _write_pieces(each, [*g, "_chunk"], meta, pending_dir)
            return
        docs = each.groupBy(*g, "_chunk").agg(F.array_sort(F.collect_list("_rec")).alias("_recs"))
        docs = docs.repartition(files, *g, "_chunk")
    body = F.concat(F.lit('{"meta":' + json.dumps(meta) + ',"data":['), F.array_join("_recs", ","), F.lit("]}"))
    docs.select(body.alias("value")).write.mode("append").option("compression", "none").text(pending_dir)
    _rename_json(spark, pending_dir)


def _write_pieces(records: DataFrame, doc: Sequence[str], meta: dict, pending_dir: str) -> None:
    """Documents of the records ``_rec`` with the same values of ``doc``, written record by record, so that no task holds a
    document: each is a piece of text, and what the writer puts behind a piece is a space, which JSON doesn't mind."""
    by = Window.partitionBy(*doc).orderBy("_rec", "_copy")
    placed = records.select(*doc, "_rec", "_copy", F.row_number().over(by).alias("_n"), F.lead("_copy").over(by).alias("_next"))
    piece = F.concat(F.when(F.col("_n") == 1, F.lit('{"meta":' + json.dumps(meta) + ',"data":[')).otherwise(F.lit(",")), "_rec",
                     F.when(F.col("_next").isNull(), F.lit("]}\n")).otherwise(F.lit("")))
    placed.select(piece.alias("value")).write.mode("append").option("compression", "none").option("lineSep", " ").text(pending_dir)
    _rename_json(records.sparkSession, pending_dir)


def write_staged_records(norm: DataFrame, pending_dir: str, mapping: dict | None = None, builder=None,
                         method: str = "copy") -> list[str]:
    """Stage normalised agent records: one document per (request, target table), records in their order.

    ``builder(norm, table)`` returns the table's rows with ``request_id`` and ``record_pos`` (default: the table's
    columns by ``normalize.to_table_rows``); a table for which it returns None is left out. Returns the tables."""
    from ..functions import agent_mapping as AM
    from . import normalize as N
    m = AM.load_mapping() if mapping is None else mapping

    def default(norm: DataFrame, table: str) -> DataFrame:
        rows = N.to_table_rows(norm, table, m, keep=("record_pos",))
        return rows.withColumn("received_at", N.iso_utc("received_at"))

    from pyspark import StorageLevel
    done = []
    norm = norm.persist(StorageLevel.MEMORY_AND_DISK)  # each table is a job of its own; payloads are parsed once for all
    try:
        for table in dict.fromkeys(AM.class_tables(m).values()):
            rows = (builder or default)(norm, table)
            if rows is None:
                continue
            own = [c for c in rows.columns if c not in ("record_pos", "_request")]
            types = {c: STAGED_TYPES[t] for c, t in rows.select(*own).dtypes if t in STAGED_TYPES}
            maps = [c for c, t in rows.select(*own).dtypes if t.startswith(("map", "array", "struct"))]
            write_staged(rows.withColumn("_request", F.col("request_id")), pending_dir, table, method, column_types=types,
                         json_columns=maps, add_updated_at=False, source="agent", group_cols=["_request"],
                         order_cols=["record_pos"], without=("record_pos",))
            done.append(table)
    finally:
        norm.unpersist()
    return done


def _rename_json(spark: SparkSession, folder: str) -> None:
    """Give committed text part files names that sort by the time of writing, with the ``.json`` suffix the loader globs for."""
    stamp = f"{time.time_ns():020d}"
    for path, name, is_dir, length in FS.list_dir(spark, folder):
        if not is_dir and name.startswith("part-") and not name.endswith(".json") and length > 0:
            FS.rename(spark, path, f"{path[:-len(name)]}{stamp}-{name}.json")


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON line per normalised record (NULL fields kept)."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def write_quarantine(q: DataFrame, path: str, received_at: str = "received_at") -> None:
    """Quarantine documents (request, reason, metadata, raw body), partitioned y/m/d."""
    out = q.select("*", *date_parts(received_at))
    out.write.mode("append").partitionBy("y", "m", "d").parquet(path)


def archive_raw(payloads: DataFrame, path: str, received_at: str = "received_at") -> DataFrame:
    """Archive payload bodies verbatim, partitioned by day; returns rows with ``raw_payload_ref``.

    Rows are dealt by ranges of day and request, so there are about as many files as days and tasks, not days times tasks
    (a stream takes a few files per batch), and a day with most of the rows is written by many tasks."""
    ts = F.col(received_at)
    ref = F.concat(F.lit("raw/"), F.date_format(ts, "yyyy/MM/dd"), F.lit("/"), F.col("request_id"), F.lit(".json"))
    out = payloads.select("*", *date_parts(received_at)).repartitionByRange("y", "m", "d", "request_id")
    # row groups of a few MB: a stream takes few files per batch, and all cores share their rows
    out.write.mode("append").option("parquet.block.size", ARCHIVE_BYTES).partitionBy("y", "m", "d").parquet(path)
    return payloads.withColumn("raw_payload_ref", ref)


def fanout(df: DataFrame, sinks) -> None:
    """Composite sink: persist once, hand the same rows to every sink."""
    p = df.persist()
    try:
        for s in sinks:
            s(p)
    finally:
        p.unpersist()


def host_counts(hosts: DataFrame) -> DataFrame:
    """Host totals of a staged host output: all, enabled, disabled."""
    return hosts.agg(F.count(F.lit(1)).alias("hosts"),
                     F.count_if(F.col("status") == "Enabled").alias("enabled"),
                     F.count_if(F.col("status") != "Enabled").alias("disabled"))
