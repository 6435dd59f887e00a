"""Session helpers: local test session, shared scratch/checkpoint folder, sized broadcast.

Nothing here changes how Catalyst plans a query; it only provides the few
session-level settings the library relies on and a broadcast guard.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A "dimension" side is broadcast up to so many rows, and up to so many bytes of text and fixed-size values (the driver
# holds a side collected, hashed and serialised, several times its bytes, and a report has several sides at once).
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 16 << 20


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "hostlake") -> SparkSession:
    """Session used by tests and bench: local mode, AQE on, UI off, UTC."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("HOSTLAKE_DRIVER_MEMORY", "8g"))
    )
    log_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    if log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is used as is; without it
    this is an error, since executors don't see each other's local folders. Only
    in local mode a fresh folder under the system temp dir is created and
    recorded in the session.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not current:
        current = tempfile.mkdtemp(prefix="hostlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared checkpoint folder.

    File-based operators (staged files, sinks, lake tables in tests) write
    here, never to a machine-local temp path chosen independently of the
    session.
    """
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
    if "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path


class Dimension:
    """A dimension-side DataFrame persisted once, with a proven row bound.

    ``small`` is decided by one bounded count (``is_small``); every subset of a small dimension is small too, so
    ``bc(subset)`` broadcasts it without another check, and asks for a shuffle
    join otherwise (see ``bounded_broadcast``).
    """

    def __init__(self, df: DataFrame, max_rows: int | None = None):
        from pyspark import StorageLevel
        max_rows = DEFAULT_BROADCAST_ROWS if max_rows is None else max_rows
        # persisted: computed once for the check and every later use; a lost block is
        # recomputed from its (stable) input tables
        self.df = df.persist(StorageLevel.MEMORY_AND_DISK)
        self.small = is_small(self.df, max_rows)

    def release(self) -> None:
        """Drop the cached copy once the plans using it have run (long-running callers:
        the streaming loader releases per batch; report apps may ``spark.catalog.clearCache()``)."""
        self.df.unpersist()

    def bc(self, subset: DataFrame | None = None) -> DataFrame:
        d = self.df if subset is None else subset
        return F.broadcast(d) if self.small else d.hint("merge")


def bounded_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Broadcast ``df`` only when it provably holds at most ``max_rows`` rows (and ``DEFAULT_BROADCAST_BYTES``).

    The check reads no more rows than the bounds let through (``is_small``). A side that
    turns out big is hinted for a sort-merge join: Spark's own estimate takes an
    ``explode`` for no growth and a file for as large as its compressed bytes, so
    without a hint it broadcasts millions of rows through the driver.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df.hint("merge")


def is_small(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes: rows count 16 bytes a column, and
    texts, binaries, arrays, maps and structs (as JSON) their length besides. A partition is read up to the row that is
    one too many for either bound, and no further."""
    max_rows = DEFAULT_BROADCAST_ROWS if max_rows is None else max_rows
    max_bytes = DEFAULT_BROADCAST_BYTES if max_bytes is None else max_bytes
    row_bytes = 16 * len(df.columns)
    most = min(max_rows, max_bytes // max(1, row_bytes))
    size = F.lit(row_bytes).cast("long")
    for f in df.schema.fields:
        col, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind in ("string", "binary", "varchar", "char"):
            size = size + F.coalesce(F.octet_length(col), F.lit(0))
        elif kind in ("array", "map", "struct"):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0))
    n, b = df.select(size.alias("b")).limit(most + 1).agg(F.count("*"), F.coalesce(F.sum("b"), F.lit(0))).first()
    return n <= max_rows and b <= max_bytes
