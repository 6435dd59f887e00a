"""Documents, batches and archives that are larger than a task should hold."""
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from hostlake.operators import sinks as SK
from hostlake.sources import staged as S


def folder_bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files)


def test_documents_are_written_piece_by_piece(spark, scratch, monkeypatch):
    """No task collects the records of a document; the texts hold the same documents as before."""
    def refused(*_):
        raise AssertionError("a document's records are collected")
    pending, lake = scratch("pending"), scratch("lake")
    df = spark.range(5000).select((F.col("id") % 2500).cast("string").alias("a"), F.lit("x\n\"y").alias("b"), (F.col("id") % 3).alias("g"))
    with monkeypatch.context() as m:
        m.setattr(SK.F, "collect_list", refused)
        SK.write_staged(df, pending, "t", "copy", group_cols=["g"], max_records=1000, add_updated_at=False)
    docs = S.parse_envelope(S.read_staged(spark, pending)).collect()
    assert {d.status for d in docs} == {"ok"} and sum(len(d.records) for d in docs) == 5000 and len(docs) == 6
    for d in docs:
        assert d.records == sorted(d.records)
    ledger = SK.load_pending(spark, pending, lake)
    assert SK.load_summary(ledger).first().rows == 5000
    assert sorted(map(tuple, SK.read_table(spark, lake, "t").collect())) == sorted((a, b) for a, b, _ in map(tuple, df.collect()))


def test_documents_are_not_shuffled_to_be_parsed(spark, scratch, monkeypatch):
    """Documents that are done are left out by a broadcast of their places: a document is in one row of one task."""
    pending, lake, plans = scratch("pending"), scratch("lake"), []
    SK.write_staged(spark.range(50).select(F.col("id").cast("string").alias("a")), pending, "t", "copy", max_records=10, add_updated_at=False)
    kept = S.kept
    monkeypatch.setattr(S, "kept", lambda df, folder: plans.append((folder, df._jdf.queryExecution().executedPlan().toString())) or kept(df, folder))
    SK.load_pending(spark, pending, lake)
    (plan,) = [p for folder, p in plans if "/parsed-" in folder]
    joins = [x.split("BroadcastHashJoin ")[1] for x in plan.split("\n") if "BroadcastHashJoin [file_path" in x and "doc_pos" in x]
    assert joins and "LeftAnti, BuildRight" in joins[0]


def test_what_a_load_keeps_is_compressed_and_goes(spark, scratch, monkeypatch):
    from hostlake.session import ensure_checkpoint_dir
    pending, lake, sizes = scratch("pending"), scratch("lake"), {}
    df = spark.range(20000).select(F.col("id").cast("string").alias("a"), F.lit("a long text that is in every record " * 4).alias("b"))
    SK.write_staged(df, pending, "t", "insert", key=["a"], add_updated_at=False)
    kept = S.kept

    def measured(df, folder):
        out = kept(df, folder)
        sizes[folder] = folder_bytes(folder)
        return out
    monkeypatch.setattr(S, "kept", measured)
    SK.load_pending(spark, pending, lake)
    assert SK.read_table(spark, lake, "t").count() == 20000
    assert len(sizes) == 3 and max(sizes.values()) < folder_bytes(pending) / 3
    assert not any(os.path.exists(f) for f in sizes)
    assert not [d for d in os.listdir(ensure_checkpoint_dir(spark)) if d.startswith(("parsed-", "records-")) and f"{d}" in str(sizes)]


def test_archived_files_can_be_read_by_many_tasks(spark, scratch):
    path = scratch("raw")
    rows = spark.range(12000).select(
        F.concat(F.lit("req-"), F.col("id").cast("string")).alias("request_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("received_at"), F.lit("raw").alias("raw_payload_ref"),
        F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(k))), 512) for k in range(16)]).alias("body"))
    SK.archive_raw(rows.coalesce(1), path)
    files = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    largest = max(files, key=os.path.getsize)
    assert os.path.getsize(largest) > 2 * SK.ARCHIVE_BYTES or len(files) > 1
    groups = [pq.ParquetFile(f).metadata for f in files]
    assert sum(m.num_rows for m in groups) == 12000
    for f, m in zip(files, groups):
        assert m.num_row_groups >= os.path.getsize(f) // (2 * SK.ARCHIVE_BYTES)


def test_tables_of_a_batch_are_loaded_side_by_side(spark, scratch, monkeypatch):
    import threading
    pending, lake, both = scratch("pending"), scratch("lake"), threading.Barrier(2, timeout=60)
    for t in ("t1", "t2"):
        SK.write_staged(spark.range(20).select(F.col("id").cast("string").alias("a")), pending, t, "copy", add_updated_at=False)
    load = SK._load_group

    def met(*args):
        both.wait()
        return load(*args)
    monkeypatch.setattr(SK, "_load_group", met)
    assert [r.status for r in SK.load_pending(spark, pending, lake).collect()] == ["ok", "ok"]
    assert SK.read_table(spark, lake, "t1").count() == SK.read_table(spark, lake, "t2").count() == 20
