"""URL filter rules as a sort-merge range join.

A host's canonical key is its labels in reverse order, each closed by a dot (``www.example.org`` -> ``org.example.www.``),
so a host and all its subdomains are the keys that start with its own key: an interval from the key to the key plus a
byte above all UTF-8. A rule's path prefix is an interval in the same way. Prefix intervals nest or lie apart.

``active_intervals`` sorts interval starts, points and interval ends together and sweeps them. The number of intervals
open is a running sum; an interval that opens at depth d fills slot d of the stack, so the stack at a point is, for
each slot up to the point's depth, the interval that filled it last. Two window functions over key ranges do this; a
range begins with the starts of those intervals that are open at its lower end, so ranges are swept independently.

Only DataFrame and SQL functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hostlake.llm.common import cut

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Order of events at one key.
START, POINT, END = 0, 1, 2


def above(low: Column) -> Column:
    """The upper end of the keys that start with ``low``: a byte follows that no UTF-8 text has."""
    return F.concat(low, F.unhex(F.lit("FF")))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' for null or without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.substring(url, at + 3, F.length(url))
    return F.when(at > 0, F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; '' for null or without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.substring(url, at + 3, F.length(url))
    return F.when(at > 0, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise("")


def host_key(host: Column) -> Column:
    """Reversed-host canonical key, as bytes."""
    return F.encode(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")), "UTF-8")


def path_key(host: Column, path: Column) -> Column:
    """Key of a path below one rule host."""
    return F.concat(host_key(host), F.unhex(F.lit("00")), F.encode(path, "UTF-8"))


def active_intervals(points: DataFrame, intervals: DataFrame, innermost: bool = False) -> DataFrame:
    """(key, low): for each point (distinct binary ``key``) the intervals that contain it, by their lower ends.

    ``intervals``: distinct (low, high), nested or apart, low included. With ``innermost`` only the smallest one. An
    interval is repeated once per key range that it spans; ranges hold equal shares of the keys, whatever the hosts.
    """
    none = F.lit(None).cast("binary")
    events = (intervals.select(F.col("low").alias("key"), F.lit(START).alias("kind"), "low")
              .union(intervals.select(F.col("high").alias("key"), F.lit(END).alias("kind"), "low"))
              .union(points.select("key", F.lit(POINT).alias("kind"), none.alias("low"))))
    n = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = cut(events.repartitionByRange(n, "key").withColumn("part", F.spark_partition_id()))
    spans = (ranges.where(F.col("kind") != POINT).groupBy("low")
             .agg(F.min("part").alias("first"), F.max("part").alias("last")).where("first < last"))
    carried = spans.select(F.col("low").alias("key"), F.lit(START).alias("kind"), "low",
                           F.explode(F.expr("sequence(first + 1, last)")).alias("part"))
    swept = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("kind") == START, 1).when(F.col("kind") == END, -1).otherwise(0)
    depth = ranges.unionByName(carried).withColumn("depth", F.sum(step).over(swept))
    slots = F.array("depth") if innermost else F.when(F.col("kind") == START, F.array("depth")).otherwise(
        F.expr("sequence(1, depth)"))
    stack = (depth.where(F.col("kind") != END).where("depth > 0").withColumn("slot", F.explode(slots)))
    filled = Window.partitionBy("part", "slot").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    return (stack.withColumn("low", F.last("low", ignorenulls=True).over(filled))
            .where(F.col("kind") == POINT).select("key", "low"))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) rows of a short rule list; long ones are read as a table."""
    if not rules:
        return spark.range(0).select(*[F.lit("").alias(c) for c in ("host", "path", "verdict")])
    rows = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(("host", "path", "verdict"), r, strict=True)])
                     for r in rules])
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.*")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict), one row per input row.

    ``rules`` (host, path, verdict): a rule fits its host and all subdomains where the url's path starts with its path.
    Of the rules that fit, the one with the longest host + path wins (ties: the smallest such text; the same rule with
    both verdicts: block). No rule: rule null, verdict ``default``. A null url, or one without ``://``, has empty host
    and path and is judged like any other. Ids may be null or repeat; other columns are not read. Rules with a null
    host or path are left out. An empty table of pages gives an empty one; without rules every url gets ``default``. A very
    long url is one key like any other. Each distinct host, and each distinct path below a rule host, is swept once.
    """
    urls = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rules = (rules.where("host IS NOT NULL AND path IS NOT NULL").groupBy("host", "path")
             .agg(F.max("verdict").alias("verdict")))  # block > allow
    targets = rules.select("host").distinct().select(
        host_key(F.col("host")).alias("low"), F.col("host").alias("rule_host"))
    distinct = urls.select("host", "path").distinct()
    hosts = urls.select("host").distinct().select("host", host_key(F.col("host")).alias("key"))
    open_hosts = active_intervals(hosts.select("key"), targets.select("low", above(F.col("low")).alias("high")))
    fitting = hosts.join(open_hosts, "key").join(targets, "low").select("host", "rule_host")
    below = distinct.join(fitting, "host").select(
        "host", "path", path_key(F.col("rule_host"), F.col("path")).alias("key"))
    ruled = rules.select(path_key(F.col("host"), F.col("path")).alias("low"), F.concat("host", "path").alias("rule"), "verdict")
    open_paths = active_intervals(below.select("key").distinct(), ruled.select("low", above(F.col("low")).alias("high")),
                                  innermost=True)
    found = open_paths.join(ruled, "low").select("key", "rule", "verdict")
    best = (below.join(found, "key").groupBy("host", "path")
            .agg(F.min(F.struct((-F.length("rule")).alias("a"), F.col("rule").alias("b"), F.col("verdict").alias("c"))).alias("r")))
    return urls.join(best, ["host", "path"], "left").select(
        F.col("id").alias(id_col), "host", "path", F.col("r.b").alias("rule"),
        F.coalesce("r.c", F.lit(default)).alias("verdict"))
