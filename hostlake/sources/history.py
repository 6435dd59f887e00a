"""History fetch windows and history de-duplication.

The collector re-reads ``[start - overlap, end]`` (inclusive both ends) every
cycle, so consecutive windows overlap and the same sample arrives twice; the
loader removes the copies by key. Here the "fetch" is a filter over a history
source (table or stream), so both steps are plain DataFrame work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clock_to_ntz

HISTORY_KEY = ("itemid", "clock", "ns")
PARTITION_COL = "event_date"


def within(hist: DataFrame, since: int | None = None, until: int | None = None) -> DataFrame:
    """Rows with ``since <= clock <= until`` (None: no bound on that side).

    On a day-partitioned table the same bounds are added on ``event_date``: that column is derived from ``clock``,
    which Spark cannot know, and without them every day would be listed and opened."""
    by_day = PARTITION_COL in hist.columns
    for bound, side in ((since, "ge"), (until, "le")):
        if bound is not None:
            at = F.lit(int(bound))
            hist = hist.where(getattr(F.col("clock"), f"__{side}__")(at))
            if by_day:
                hist = hist.where(getattr(F.col(PARTITION_COL), f"__{side}__")(F.to_date(clock_to_ntz(at))))
    return hist


def history_window(hist: DataFrame, start: int | None, end: int, overlap: int = 60,
                   default_span: int = 300) -> DataFrame:
    """Rows of one fetch window ``[start - overlap, end]``; without ``start`` the
    window is the last ``default_span`` seconds before ``end`` (plus overlap).
    Carries ``window_from`` / ``window_till``."""
    lo = (start if start is not None else end - default_span) - overlap
    return within(hist, lo, end) \
        .withColumn("window_from", F.lit(lo).cast("bigint")).withColumn("window_till", F.lit(end).cast("bigint"))


def history_windows(hist: DataFrame, t0: int, width: int, overlap: int = 60) -> DataFrame:
    """All consecutive windows ``i``: ``[t0 + i*width - overlap, t0 + (i+1)*width]``.

    Every row is emitted once per window containing it (rows in an overlap
    appear twice), tagged with ``window_id``, ``window_from``, ``window_till``.
    Computed per row (no join): a row in window w is at most ``ceil(overlap / width)`` windows late, and at the edge
    also in the one before.
    """
    if width <= 0 or overlap < 0:
        raise ValueError("a window has a width, and an overlap of 0 or more")
    w = F.floor((F.col("clock") - F.lit(t0)) / F.lit(width)).cast("bigint")
    cand = F.explode(F.sequence(w - 1, w + F.lit(-(-overlap // width)))).alias("window_id")
    x = hist.select("*", cand)
    lo = F.lit(t0) + F.col("window_id") * width - overlap
    hi = F.lit(t0) + (F.col("window_id") + 1) * width
    return x.where((F.col("window_id") >= 0) & (F.col("clock") >= lo) & (F.col("clock") <= hi)) \
        .withColumn("window_from", lo.cast("bigint")).withColumn("window_till", hi.cast("bigint"))


def dedup_history(hist: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """One row per (itemid, clock, ns): the first by ``order`` (aggregate pick,
    skew-safe); without ``order`` the smallest row, which is deterministic."""
    cols = hist.columns
    ordc = F.struct(*[F.col(c) for c in (order or cols)])
    pick = F.min_by(F.struct(*[F.col(c) for c in cols]), ordc).alias("_p")
    return hist.groupBy(*HISTORY_KEY).agg(pick).select(*[F.col(f"_p.{c}").alias(c) for c in cols])
