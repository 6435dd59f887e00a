"""Mixing sources to target weights by Poisson replication.

Each document gets a number of copies drawn from a Poisson distribution whose mean is its source's repetition rate,
``weight * total / documents of the source``. The draw inverts the distribution at a uniform number hashed from
(seed, id), so it is the same in every run, on any partitioning, and for each row on its own. Copies are exploded and
all rows are dealt out and sorted by another hash, which shuffles the corpus globally.
"""

from __future__ import annotations

from math import ceil, exp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostlake.llm.common import fresh

#: A mean above this is drawn as a sum of equal smaller ones, each with its own hash: the terms stay far from underflow.
LARGEST_MEAN = 16.0


def distribution(mean: float) -> list[float]:
    """P(count <= k) for k = 0, 1, ... until it no longer grows."""
    term = total = exp(-mean)
    out, k = [total], 0
    while k < mean or total + term * mean / (k + 1) > total:
        k += 1
        term *= mean / k
        total += term
        out.append(total)
    return out


def uniform(seed: int, ident: Column, draw: Column) -> Column:
    """In (0, 1), from 52 bits of MD5 of 'seed:id:draw'."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(ident.cast("string"), F.lit("")), draw.cast("string"))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: dict[str, float], other: float, source_col: str, total: float | None) -> list[tuple]:
    """(source, rate) for each source of ``weights`` and, as None, for all others together."""
    label = F.when(F.col(source_col).isin(list(weights)), F.col(source_col)) if weights else F.lit(None).cast("string")
    counts = {r["s"]: r["n"] for r in docs.groupBy(label.alias("s")).agg(F.count("*").alias("n")).collect()}
    share = sum(weights.values()) + other
    total = sum(counts.values()) if total is None else total
    return [(s, weights.get(s, other) / share * total / n) for s, n in counts.items()]


def poisson_mix(docs: DataFrame, weights: dict[str, float], other: float = 0.0, seed: int = 0,
                total: float | None = None, id_col: str = "doc_id", source_col: str = "source",
                copy_col: str = "copy", key_col: str = "shuffle_key") -> DataFrame:
    """``docs`` repeated so that each source has its share of ``weights`` of about ``total`` rows (default: as many as
    there are), in a random order.

    Returns the columns of ``docs``, then the copy's number from 1 and the key that the rows are sorted by (ties by id
    and copy). Sources not named in ``weights`` (null too) share ``other`` in their natural proportion; weight 0 drops
    a source. Weights are divided by their sum. A source without documents gives none. Null ids hash as ''; rows that
    share an id draw the same count. Names of new columns get a leading '_' where ``docs`` has them already.
    An empty table gives an empty one. Texts of any length (null too) are only carried along.

    One pass counts rows per named source (the driver sees one number each; as many as ``weights`` has). The rates come
    back as a broadcast of that bounded size, so a source with a third of all rows is never a join key or a group.
    """
    if min([other, *weights.values()]) < 0 or other + sum(weights.values()) <= 0:
        raise ValueError("weights must be at least 0 and not all 0")
    spark = docs.sparkSession
    label, cdf, parts, n = fresh(docs, "label", "cdf", "parts", "copies")
    copy_col, key_col = fresh(docs, copy_col, key_col)
    rows = []
    for s, rate in rates(docs, weights, other, source_col, total):
        k = max(1, ceil(rate / LARGEST_MEAN))
        rows.append((s, k, distribution(rate / k)))
    table = F.broadcast(spark.createDataFrame(rows, f"`{label}` string, `{parts}` int, `{cdf}` array<double>"))
    source, ident = F.col(f"`{source_col}`"), F.col(f"`{id_col}`")
    named = docs.withColumn("_of" + label, F.when(source.isin(list(weights)), source)) if weights else docs.withColumn(
        "_of" + label, F.lit(None).cast("string"))
    joined = named.join(table, F.col("_of" + label).eqNullSafe(F.col(label)))
    drawn = F.aggregate(
        F.sequence(F.lit(0), F.col(parts) - 1), F.lit(0),
        lambda sum_, j: sum_ + F.size(F.filter(F.col(cdf), lambda c: c < uniform(seed, ident, j))))
    once = F.size(F.filter(F.col(cdf), lambda c: c < F.col("_u" + label)))
    many = any(k > 1 for _, k, _ in rows)
    counted = (joined.withColumn("_u" + label, uniform(seed, ident, F.lit(0)))
               .withColumn(n, F.when(F.col(parts) == 1, once).otherwise(drawn) if many else once))
    out = counted.where(F.col(n) > 0).withColumn(copy_col, F.explode(F.sequence(F.lit(1), F.col(n))))
    text = F.concat_ws("/", F.lit(str(seed)), F.coalesce(ident.cast("string"), F.lit("")), F.col(copy_col).cast("string"))
    out = out.withColumn(key_col, F.substring(F.md5(text), 1, 16))
    return (out.select(*[F.col(f"`{c}`") for c in docs.columns], copy_col, key_col)
            .repartitionByRange(key_col).sortWithinPartitions(key_col, ident, copy_col))
