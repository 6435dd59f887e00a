"""Time-matching operators built from DataFrame built-ins.

* ``nearest_join``   - bidirectional as-of join: for each left row the right row
  with the closest clock within the same key; ties go to the earlier right row.
* ``bucket_join``    - time-bucket hash join with previous-bucket fallback.
* ``latest_by``      - latest row per key (``ORDER BY t DESC LIMIT 1`` per key).
* ``latest_by_days`` - the same over a day-partitioned table, newest days first,
  until every key has been met.
* ``item_row_counts``- per-item row counts attached to an item list (zero kept).

Scale notes
-----------
``nearest_join`` is one shuffle of both inputs by key and two running windows. Only keys with more than
``target_rows`` rows are cut, into ranges of the order (clock, right before left, hash) at approximate quantiles of
their own rows: wherever in time a key's rows lie, each range has about ``target_rows``. The last and first right row
of each range are carried over the range borders by a table with one row per range of a hot key. Right rows of a hot
key that share a clock are one row first (the one that would win), and left rows that share a clock are dealt by their
hash, so a key with all its rows in one second is spread as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import bounded_broadcast, ensure_checkpoint_dir

#: Rows of a key that one task sorts.
TARGET_ROWS = 1_000_000
#: A hot key is cut into so many ranges at most; its cuts are looked up in two steps of this many at most.
MOST_RANGES, STEP = 4096, 64
#: Bits of a row's place in the order that deal the rows of one clock.
_DEAL_BITS = 20


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def _hot_key_cuts(u: DataFrame, by: list[str], target_rows: int) -> DataFrame | None:
    """(by, _cuts array<long>) of the keys with more than ``target_rows`` rows: the last place of each range but the
    last one. None where there is no such key. At most rows / target_rows keys; the cuts are checkpointed, so that all
    uses of them agree."""
    counts = u.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > target_rows)
    # keys of one class need between half of and all of its number of ranges
    ranges = F.least(F.lit(MOST_RANGES), F.pow(F.lit(2), F.ceil(F.log2(F.col("_n") / F.lit(float(target_rows))))).cast("int"))
    ensure_checkpoint_dir(u.sparkSession)
    hot = counts.select(*_cols(by), ranges.alias("_ranges")).checkpoint()
    classes = sorted(r[0] for r in hot.select("_ranges").distinct().collect())  # at most 13 numbers
    if not classes:
        return None
    rows = u.select(*_cols(by), "_at").join(bounded_broadcast(hot), by)
    parts = []
    for n in classes:
        fractions = F.array(*[F.lit(i / n) for i in range(1, n)])
        parts.append(rows.where(F.col("_ranges") == n).groupBy(*by).agg(
            F.array_distinct(F.percentile_approx("_at", fractions, max(10_000, 10 * n))).alias("_cuts")))
    cuts = parts[0]
    for part in parts[1:]:
        cuts = cuts.unionByName(part)
    return cuts.checkpoint()


def _range_of(at: Column, cuts: Column) -> Column:
    """How many cuts lie before ``at``: first among every ``STEP``-th, then among those that follow it."""
    firsts = F.filter(cuts, lambda c, i: (i % STEP == 0) & (c < at))
    step = F.greatest(F.size(firsts) - 1, F.lit(0)) * STEP
    inside = F.size(F.filter(F.slice(cuts, step + 1, F.lit(STEP)), lambda c: c < at))
    return step + inside


def nearest_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    values: Sequence[str] = ("value",),
    clock: str = "clock",
    tie: Sequence[str] = (),
    how: str = "inner",
    channel: str | None = None,
    channel_values: Sequence[str] = (),
    direction: str = "nearest",
    target_rows: int | None = TARGET_ROWS,
) -> DataFrame:
    """Closest right row per left row, by |clock difference|, within ``by``.

    ``direction='backward'`` takes the last right row at or before the left
    clock (last observation carried forward), ``'forward'`` the first at or
    after it (next observation carried backward).

    Ties: the earlier right row wins (distance to previous <= distance to
    next). Among right rows with the same clock the one with the highest
    ``tie`` columns wins. Right rows whose first value is NULL are ignored.

    Without ``channel`` the output is ``left`` plus ``values`` and
    ``match_clock``; ``how='inner'`` drops left rows without any match.
    With ``channel`` (a right column) each value in ``channel_values`` is
    matched independently and the output gets ``<ch>_<value>`` and
    ``<ch>_clock`` columns (always left-outer).

    A key with more than ``target_rows`` rows is cut into ranges (see the module; None: never, and no count is taken).
    The count of rows per key is an eager job over the key columns; with hot keys a second one finds their cuts.
    Rows whose key or clock is NULL match nothing.
    """
    by, values, tie = list(by), list(values), list(tie)
    left_cols = [c for c in left.columns if c not in by and c != clock]
    chans = list(channel_values) if channel else [None]

    r_struct = F.struct(F.col(clock).alias("c"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(tie)],
                        *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    r = right.where(F.col(values[0]).isNotNull()).dropna(subset=[*by, clock])
    place = F.shiftleft(F.col(clock).cast("long"), _DEAL_BITS)
    r_side = r.select(*_cols(by), F.col(clock),
                      *[(r_struct if ch is None else F.when(F.col(channel) == F.lit(ch), r_struct)).alias(f"_r_{ch}") for ch in chans],
                      F.lit(1).alias("_is_r"), place.alias("_at"), *[F.col(t).alias(f"_t{i}") for i, t in enumerate(tie)])
    known = F.lit(True)
    for c in [*by, clock]:
        known = known & F.col(c).isNotNull()
    payload = F.struct(*_cols(left_cols)) if left_cols else F.struct(F.lit(0).alias("_none"))
    # left rows of one clock lie behind its right rows, dealt by a hash of the row
    deal = 1 + F.pmod(F.xxhash64(payload), F.lit((1 << _DEAL_BITS) - 1))
    l_side = left.where(known).select(*_cols(by), F.col(clock), F.lit(0).alias("_is_r"), (place + deal).alias("_at"),
                                      *[F.lit(None).cast(right.schema[t].dataType).alias(f"_t{i}") for i, t in enumerate(tie)],
                                      payload.alias("_l"))
    r_type = r_side.schema[f"_r_{chans[0]}"].dataType
    for ch in chans:
        l_side = l_side.withColumn(f"_r_{ch}", F.lit(None).cast(r_type))
    r_side = r_side.withColumn("_l", F.lit(None).cast(l_side.schema["_l"].dataType))
    cuts = None if target_rows is None else _hot_key_cuts(
        l_side.select(*_cols(by), "_at").union(r_side.select(*_cols(by), "_at")), by, target_rows)

    part = list(by)
    if cuts is None:
        u = l_side.unionByName(r_side)
    else:
        cuts = bounded_broadcast(cuts)
        hot_right = r_side.join(cuts.select(*_cols(by)), by, "left_semi")
        # of a hot key's right rows with one clock only the winner of each channel can be matched
        winner = F.struct(*[F.col(f"_t{i}") for i in range(len(tie))], F.lit(0))
        one = hot_right.groupBy(*by, clock).agg(
            *[F.max_by(f"_r_{ch}", F.when(F.col(f"_r_{ch}").isNotNull(), winner)).alias(f"_r_{ch}") for ch in chans],
            F.first("_is_r").alias("_is_r"), F.first("_at").alias("_at"), *[F.max(f"_t{i}").alias(f"_t{i}") for i in range(len(tie))])
        one = one.withColumn("_l", F.lit(None).cast(l_side.schema["_l"].dataType))
        cold_right = r_side.join(cuts.select(*_cols(by)), by, "left_anti")
        u = l_side.unionByName(cold_right).unionByName(one).join(cuts, by, "left")
        u = u.withColumn("_range", F.when(F.col("_cuts").isNotNull(), _range_of(F.col("_at"), F.col("_cuts"))).otherwise(-1)).drop("_cuts")
        part = [*by, "_range"]
        # the last and the first right row of each range of a hot key, carried to the ranges behind and in front
        aggs = []
        for ch in chans:
            rc = F.col(f"_r_{ch}")
            aggs += [F.max_by(rc, F.when(rc.isNotNull(), F.col(clock))).alias(f"_last_{ch}"),
                     F.min_by(rc, F.when(rc.isNotNull(), F.col(clock))).alias(f"_first_{ch}")]
        found = one.join(cuts, by).withColumn("_range", _range_of(F.col("_at"), F.col("_cuts"))).groupBy(*part).agg(*aggs)
        every = cuts.select(*_cols(by), F.explode(F.sequence(F.lit(0), F.size("_cuts"))).alias("_range"))
        borders = every.join(found, part, "left")
        before = Window.partitionBy(*_cols(by)).orderBy(F.col("_range").asc()).rowsBetween(Window.unboundedPreceding, -1)
        after = Window.partitionBy(*_cols(by)).orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
        carried = [*_cols(part)]
        for ch in chans:
            carried += [F.last(f"_last_{ch}", ignorenulls=True).over(before).alias(f"_bprev_{ch}"),
                        F.last(f"_first_{ch}", ignorenulls=True).over(after).alias(f"_bnext_{ch}")]
        u = u.join(bounded_broadcast(borders.select(*carried)), on=part, how="left")

    order_tie = [F.col(f"_t{i}").asc_nulls_first() for i in range(len(tie))]
    w_prev = Window.partitionBy(*_cols(part)).orderBy(F.col(clock).asc(), F.col("_is_r").desc(), *order_tie) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_next = Window.partitionBy(*_cols(part)).orderBy(F.col(clock).desc(), F.col("_is_r").desc(), *order_tie) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)

    sel = [*_cols(by), F.col(clock), F.col("_is_r"), F.col("_l")]
    for ch in chans:
        prev = F.last(f"_r_{ch}", ignorenulls=True).over(w_prev)
        nxt = F.last(f"_r_{ch}", ignorenulls=True).over(w_next)
        if cuts is not None:
            prev = F.coalesce(prev, F.col(f"_bprev_{ch}"))
            nxt = F.coalesce(nxt, F.col(f"_bnext_{ch}"))
        sel += [prev.alias(f"_p_{ch}"), nxt.alias(f"_n_{ch}")]
    scanned = u.select(*sel).where(F.col("_is_r") == 0)

    out = [*_cols(by), F.col(clock), *[F.col(f"_l.{c}").alias(c) for c in left_cols]]
    lone = [*_cols(by), F.col(clock), *_cols(left_cols)]
    for ch in chans:
        p, n = F.col(f"_p_{ch}"), F.col(f"_n_{ch}")
        same = p["c"] == F.col(clock)  # a range border may lie between rows of one clock
        if direction == "backward":
            picked = p
        elif direction == "forward":
            picked = F.when(same, p).otherwise(n)
        else:
            picked = (F.when(p.isNull(), n)
                      .when(n.isNull(), p)
                      .when((F.col(clock) - p["c"]) <= (n["c"] - F.col(clock)), p)
                      .otherwise(n))
        pfx = "" if ch is None else f"{ch}_"
        named = [*[(f"v{i}", f"{pfx}{v}", right.schema[v].dataType) for i, v in enumerate(values)],
                 ("c", f"{pfx}clock" if ch is not None else "match_clock", right.schema[clock].dataType)]
        out += [picked[f].alias(name) for f, name, _ in named]
        lone += [F.lit(None).cast(t).alias(name) for _, name, t in named]
    res = scanned.select(*out)
    if channel is None and how == "inner":
        return res.where(F.col("match_clock").isNotNull())
    return res.union(left.where(~known).select(*lone))


def bucket_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    values: Sequence[str],
    clock: str = "clock",
    width: int = 300,
    agg: str = "max",
) -> DataFrame:
    """Left rows + right values of the same ``clock div width`` bucket, falling
    back per column to the previous bucket (``COALESCE(b, b-1)``).

    Right rows are bucketed and aggregated once; each right row also feeds the
    next bucket's "previous" slot, so a single (map-side combined) aggregation
    and a single equi-join replace the two joins of the plain form.
    """
    by = list(by)
    fn = {"max": F.max, "min": F.min, "avg": F.avg, "sum": F.sum}[agg]
    bucket = F.expr(f"`{clock}` div {int(width)}")
    shifted = F.explode(F.array(F.lit(0), F.lit(1))).alias("_shift")
    r = right.select(*_cols(by), (bucket).alias("_bucket"), *_cols(values)) \
        .select("*", shifted).withColumn("_bucket", F.col("_bucket") + F.col("_shift"))
    aggs = []
    for v in values:
        aggs.append(fn(F.when(F.col("_shift") == 0, F.col(v))).alias(f"_cur_{v}"))
        aggs.append(fn(F.when(F.col("_shift") == 1, F.col(v))).alias(f"_prev_{v}"))
    rb = r.groupBy(*by, "_bucket").agg(*aggs)
    l = left.withColumn("_bucket", bucket)
    j = l.join(rb, on=[*by, "_bucket"], how="left")
    return j.select(*[F.col(c) for c in left.columns],
                    *[F.coalesce(F.col(f"_cur_{v}"), F.col(f"_prev_{v}")).alias(v) for v in values])


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
) -> DataFrame:
    """One row per ``keys``: the ``values`` of the row with the greatest ``order``.

    A ``max_by`` hash aggregate (partial aggregation before the shuffle), so a
    key with a huge number of rows costs one running max per task, not a sort.
    """
    pick = F.max_by(F.struct(*_cols(order), *_cols(values)), F.struct(*_cols(order))).alias("_pick")
    g = df.groupBy(*keys).agg(pick)
    return g.select(*keys, *[F.col(f"_pick.{c}").alias(c) for c in list(order) + list(values)])


#: Up to so many keys that are still looked for reach the scan as a list of values.
LISTED_KEYS = 1000


def _days(df: DataFrame, day_col: str) -> list[str]:
    """The day partitions of a table's files, newest first (names of folders, nothing is read)."""
    mark = f"/{day_col}="
    return sorted({f.split(mark, 1)[1].split("/", 1)[0] for f in df.inputFiles() if mark in f}, reverse=True)


def latest_by_days(
    hist: DataFrame,
    wanted: DataFrame,
    on: str,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    day_col: str = "event_date",
) -> DataFrame:
    """Latest row per ``keys`` of the history rows of the ``wanted`` list, reading no more days than it takes.

    ``wanted`` has the history column ``on`` and the ``keys`` that its rows belong to (several ``on`` may share a key).
    Days are read newest first, in steps of 1, 1, 2, 4, ... days. A key that was met is final, since every row of an
    older day is older; it is taken off the list, and the descent ends when the list is empty or the days are. The
    rows left to find reach the scan as a list of values while they are few (a day's files are sorted by ``on``, so
    row groups are skipped). Each step is a job; its result has at most one row per key and is checkpointed.
    ``order`` begins with the clock that the days are made of. Keys without any row have no row.
    """
    ensure_checkpoint_dir(hist.sparkSession)
    left = wanted.select(on, *[k for k in keys if k != on]).distinct()
    days, found, width = _days(hist, day_col), None, 1
    while days:
        take, days = days[:width], days[width:]
        width = width if found is None else 2 * width
        rows = hist.where((F.col(day_col) >= F.lit(take[-1]).cast("date")) & (F.col(day_col) <= F.lit(take[0]).cast("date")))
        few = [r[0] for r in left.select(on).limit(LISTED_KEYS + 1).collect()]
        if len(few) <= LISTED_KEYS:
            rows = rows.where(F.col(on).isin(few))
        met = latest_by(rows.join(bounded_broadcast(left), on), keys, order, values).checkpoint()
        found = met if found is None else found.unionByName(met)
        left = left.join(bounded_broadcast(met.select(*keys)), list(keys), "left_anti").checkpoint()
        if left.isEmpty():
            break
    if found is None:
        return latest_by(hist.join(left, on), keys, order, values)
    return found


def item_row_counts(
    items: DataFrame,
    hist: DataFrame,
    item_key: str = "itemid",
    hist_key: str = "itemid",
    extra_aggs: Sequence[Column] = (),
) -> DataFrame:
    """``items`` + ``n`` (rows per item in ``hist``), zero for items without rows.

    History is pre-aggregated per item (partial aggregation) and then joined,
    the set form of a lateral ``count(*)`` per item.
    """
    counts = hist.groupBy(F.col(hist_key).alias("_k")).agg(F.count(F.lit(1)).alias("n"), *extra_aggs)
    j = items.join(counts, items[item_key] == counts["_k"], "left").drop("_k")
    return j.withColumn("n", F.coalesce(F.col("n"), F.lit(0)))
