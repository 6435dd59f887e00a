"""Incrementally maintained latest value per item.

Capacity values have no time bound ("latest known value, however old"), so
computing them from history means a scan of all history per report. At scale
the lake keeps ``latest_values`` keyed by (itemid, value_type): every loaded
batch is reduced to its newest row per key and merged with the stored rows of
the key buckets that it touches (newest (clock, ns) wins). The
table has one row per item and type, so it stays small however long history
grows; reports read it instead of scanning history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sinks as SK
from .asof import latest_by

TABLE = "latest_values"
KEY = ["itemid", "value_type"]
COLUMNS = ["itemid", "value_type", "clock", "ns", "hostid", "value"]
TYPES = {"itemid": "bigint", "value_type": "smallint", "clock": "bigint", "ns": "int", "hostid": "bigint",
         "value": "string"}


def reduce_latest(df: DataFrame) -> DataFrame:
    """Newest row per (itemid, value_type) of a batch (partial-aggregating max_by)."""
    return latest_by(df.select(*COLUMNS), KEY, ["clock", "ns"], ["hostid", "value"]).select(*COLUMNS)


def update_latest(spark: SparkSession, lake: str, batch: DataFrame, batch_id: str | None = None) -> None:
    """Merge a history batch into ``<lake>/latest_values``; only the key buckets of its items are rewritten."""
    if SK.table_meta(spark, lake, TABLE) is None:
        SK.ensure_table(spark, lake, TABLE, COLUMNS, TYPES, key=KEY, add_updated_at=False)
    batch = batch.select(*[F.col(c).cast(TYPES[c]).alias(c) for c in COLUMNS])
    SK.merge_rows(spark, lake, TABLE, KEY, reduce_latest(batch), lambda old, new: reduce_latest(old.unionByName(new)), batch_id)


def latest_rows(spark: SparkSession, lake: str) -> DataFrame:
    return SK.read_table(spark, lake, TABLE)


def latest_for(latest: DataFrame, value_types=None) -> DataFrame:
    """Latest (clock, ns) row per item, optionally only among ``value_types``
    (the shape ``reports.latest_item_values`` returns)."""
    t = latest if value_types is None else latest.where(F.col("value_type").isin(*value_types))
    return latest_by(t, ["itemid"], ["clock", "ns"], ["value"])
