"""Table maintenance as user-level jobs: date partitioning, retention, compaction.

History tables are partitioned by ``event_date`` (UTC day of ``clock``) and
sorted by ``itemid, clock`` inside each file, so a time-window report prunes
whole partitions and an item lookup skips row groups by min/max statistics.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fs as FS
from ..functions.scalars import clock_to_ntz

PARTITION_COL = "event_date"


def with_event_date(hist: DataFrame) -> DataFrame:
    return hist.withColumn(PARTITION_COL, F.to_date(clock_to_ntz(F.col("clock"))))


def partition_history(hist: DataFrame, path: str) -> None:
    """Write history partitioned by day, each day clustered by (itemid, clock).

    ``repartitionByRange`` on (event_date, itemid) spreads a big day over
    several files (range boundaries come from sampling, so a hot day is split)
    while keeping each file's item range narrow.
    """
    h = with_event_date(hist)
    out = h.repartitionByRange(PARTITION_COL, "itemid").sortWithinPartitions(PARTITION_COL, "itemid", "clock")
    out.write.mode("overwrite").partitionBy(PARTITION_COL).parquet(path)


def _partitions(spark: SparkSession, path: str) -> list[tuple[str, dt.date]]:
    return [(loc, dt.date.fromisoformat(name.split("=", 1)[1]))
            for loc, name, is_dir, _ in FS.list_dir(spark, path)
            if is_dir and name.startswith(PARTITION_COL + "=") and "." not in name]


def apply_retention(spark: SparkSession, path: str, as_of: int, keep_days: int = 365) -> list[str]:
    """Drop whole day partitions older than ``as_of - keep_days`` (metadata only, no rewrite)."""
    cutoff = dt.datetime.fromtimestamp(as_of - keep_days * 86400, dt.timezone.utc).date()
    dropped = []
    for loc, day in _partitions(spark, path):
        if day < cutoff:
            FS.delete(spark, loc)
            dropped.append(loc)
    return dropped


def compact(spark: SparkSession, path: str, as_of: int, older_than_days: int = 30, file_bytes: int = 256 << 20) -> int:
    """Rewrite day partitions older than ``older_than_days`` into sorted files of about ``file_bytes``; days changed.

    A day is rewritten by as many tasks as it gets files, into a side folder beside the table (never inside, where
    readers would find it). Then the day's folder is moved out and the new one in; a move that the store refuses is an
    error, and nothing is deleted before both are done. A run that stopped between the two moves is completed by the next
    one; a day that has no more files than it needs is left alone."""
    side = f"{path.rstrip('/')}-compaction"
    for loc, day in _partitions(spark, f"{side}/old") if FS.exists(spark, f"{side}/old") else []:
        if not FS.exists(spark, f"{path}/{PARTITION_COL}={day}"):  # moved out, and nothing came in
            FS.rename(spark, loc, f"{path}/{PARTITION_COL}={day}")
    cutoff = dt.datetime.fromtimestamp(as_of - older_than_days * 86400, dt.timezone.utc).date()
    n = 0
    for loc, day in _partitions(spark, path):
        sizes = [size for _, name, is_dir, size in FS.list_dir(spark, loc) if not is_dir and name[0] not in "._"]
        files = max(1, -(-sum(sizes) // file_bytes))
        if day >= cutoff or len(sizes) <= files:
            continue
        name = loc.rstrip("/").rsplit("/", 1)[-1]
        new, old = f"{side}/new/{name}", f"{side}/old/{name}"
        spark.read.parquet(loc).repartitionByRange(files, "itemid", "clock").sortWithinPartitions("itemid", "clock") \
            .write.mode("overwrite").parquet(new)
        FS.mkdirs(spark, f"{side}/old")
        FS.rename(spark, loc, old)
        try:
            FS.rename(spark, new, loc)
        except OSError:
            FS.rename(spark, old, loc)  # the day as it was
            raise
        FS.delete(spark, old)
        n += 1
    if FS.exists(spark, side):
        FS.delete(spark, side)
    return n


def register_table(spark: SparkSession, table: str, path: str) -> DataFrame:
    """A catalog table over a Parquet folder that stays where it is; statistics are kept with the table."""
    return spark.catalog.createTable(table, path=path, source="parquet")


def analyze(spark: SparkSession, table: str) -> None:
    """Refresh optimizer statistics of a catalog table: rows, bytes, and of every column of an atomic type its bounds,
    distinct values and nulls.

    With ``spark.sql.cbo.enabled`` a filter's share of the rows is estimated from them, so a join side that a filter
    makes small is broadcast though its files are large."""
    nested = ("array", "map", "struct", "variant", "binary")
    columns = [f"`{f.name}`" for f in spark.table(table).schema.fields if f.dataType.typeName() not in nested]
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS" + (f" FOR COLUMNS {', '.join(columns)}" if columns else ""))
