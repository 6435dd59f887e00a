"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hostlake.session import ensure_checkpoint_dir, scratch_dir

#: Rows handed to a Python task at a time: bounds its memory when texts are long.
BATCH_ROWS = 512


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Arrow batches of at most ``rows`` rows: whole texts travel in them, so the default of 10,000 is too many."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and checkpointed in the shared folder: short plans, and no recomputation when an executor
    is lost. The files go with the data frame (where the session cleans checkpoints)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a Parquet table in the shared checkpoint folder and read back.

    Cuts the lineage: later stages reread the files, also after an executor is lost.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark, name)}/t"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names starting with ``names`` that no column of ``df`` has (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def row_key(id_col: Column, text_col: Column) -> Column:
    """A non-null 64-bit key of a document's text, used beside its id.

    Rows that share id and text share the key; they get the same result in every operator.
    """
    return F.xxhash64(F.coalesce(text_col, F.lit("")), text_col.isNull(), id_col.isNull())
