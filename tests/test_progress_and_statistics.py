"""Late rows written down by a listener, statistics that change a join, the extension surface."""
import contextlib
import io

import pytest
from pyspark.sql import functions as F

from hostlake.functions import agent_mapping as AM
from hostlake.operators import maintenance as MT
from hostlake.plans import profile as P
from hostlake.session import scratch_dir
from hostlake.streaming import streams as ST

KIND = "itemid bigint, hostid bigint, clock bigint, ns int, value string, value_type smallint"


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_late_rows_and_copies_are_written_down_once(spark):
    src, out, ck, log = (scratch_dir(spark, x) for x in ("h", "o", "ck", "log"))
    rows = {0: [(1, 1, 10_000, 0, "a", 0), (1, 1, 10_000, 0, "a", 0), (1, 1, 9_000, 0, "b", 0)],
            1: [(1, 1, 10, 0, "late", 0), (2, 1, 9_500, 0, "c", 0), (1, 1, 10_000, 0, "a", 0)]}
    progress = ST.ProgressLog(spark, log)
    spark.streams.addListener(progress)
    try:
        for i in (0, 1, 2):  # the third run finds nothing new
            if i in rows:
                spark.createDataFrame(rows[i], KIND).coalesce(1).write.mode("append").parquet(src)
            q = ST.stream_history_dedup(spark, src, out, ck, watermark="1000 seconds", max_files_per_trigger=100)
            assert q.awaitTermination(120) and q.exception() is None
            progress.wait(q)
    finally:
        spark.streams.removeListener(progress)
    (got,) = ST.late_rows(spark, log).collect()
    assert got.stream == str(q.id)
    kept = spark.read.schema(KIND).parquet(out).count()
    assert (got.input_rows, got.late_rows, got.copies, kept) == (6, 1, 2, 3)


def test_late_rows_of_no_stream(spark):
    assert ST.late_rows(spark, scratch_dir(spark, "none")).collect() == []


def test_statistics_change_the_join(spark):
    s = spark.newSession()
    s.conf.set("spark.sql.cbo.enabled", "true")
    s.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    items, hist = scratch_dir(s, "items"), scratch_dir(s, "hist")
    s.range(20_000).select(F.col("id").alias("itemid_num"), F.sha2(F.col("id").cast("string"), 256).alias("name"),
                           F.array("id").alias("ids")).write.mode("overwrite").parquet(items)
    s.range(200_000).select((F.col("id") % 20_000).alias("itemid"), F.sha2(F.col("id").cast("string"), 256).alias("v")) \
        .write.mode("overwrite").parquet(hist)
    table = "analysed_" + items.rsplit("-", 1)[-1]
    MT.register_table(s, table, items)

    def joined():
        return P.item_samples(s.read.parquet(hist), s.table(table).where("itemid_num < 20"))
    before = joined()
    assert "SortMergeJoin" in _plan(before)
    MT.analyze(s, table)
    s.catalog.refreshTable(table)
    after = joined()
    assert "BroadcastHashJoin" in _plan(after) and "SortMergeJoin" not in _plan(after)
    assert sorted(map(tuple, before.collect())) == sorted(map(tuple, after.collect())) and after.count() == 20


def test_mapping_files(spark, tmp_path):
    folder = scratch_dir(spark, "mapping")
    with pytest.raises(FileNotFoundError):
        AM.read_mapping(spark, f"{folder}/none.json")
    own = tmp_path / "own.json"
    own.write_text('{"classes": {"A": {"target_key": "T"}}, "class_table_map": {"T": "a"}, "metric_map": {"A": {"x": "y"}}}')
    for mapping in (AM.load_mapping(str(own)), AM.read_mapping(spark, str(own))):
        assert AM.class_tables(mapping) == {"A": "a"} and AM.table_schemas(mapping)["a"][0] == "y"
