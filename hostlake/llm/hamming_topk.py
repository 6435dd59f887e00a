"""Exact top-k search over binary codes by incremental multi-index hashing.

A 64-bit code word is cut into segments. Two codes at most r bits apart agree in some segment up to r // segments bits.
So after all keys within radius a of a query's segments have been looked up, every code within
``segments * (a + 1) - 1`` bits has been met. Radii grow by one until the k-th verified distance is that small; only
queries that are not there yet go on.
"""

from __future__ import annotations

import uuid
from itertools import combinations
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostlake.llm.common import cut


def sign_code(vector: Column) -> Column:
    """The signs of up to 64 numbers as a long, the first in the highest used bit; 1: above 0. Missing ones count as 0.

    A longer vector is an error: codes that leave numbers out would call different vectors equal."""
    bits = F.transform(vector, lambda x: F.when(x > 0, F.lit(1)).otherwise(0).cast("long"))
    code = F.aggregate(bits, F.lit(0).cast("long"), lambda code, bit: F.shiftleft(code, 1).bitwiseOR(bit))
    return F.when(F.size(vector) <= 64, code).when(F.size(vector) > 64, F.raise_error(F.lit("more than 64 numbers for a code of 64 bits")))


def segments(n_codes: int, bits: int = 64) -> list[tuple[int, int]]:
    """(low bit, length): segments a little shorter than log2(number of codes) bits, so that a key has a few codes.

    Longer ones have fewer codes to verify, but the keys within a radius then outnumber the codes that they find."""
    parts = max(1, min(bits, ceil(bits / max(1.0, log2(max(2, n_codes)) - 2.5))))
    edges = [bits * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _masks(length: int, radius: int) -> Column:
    """All ``length``-bit values with ``radius`` ones, as an array literal."""
    values = [sum(1 << b for b in bits) for bits in combinations(range(length), radius)]
    return F.expr(f"transform(split('{','.join(map(str, values))}', ','), x -> cast(x as bigint))")


def _segment(code: str, low: int, length: int) -> Column:
    return F.shiftrightunsigned(F.col(code), low).bitwiseAND((1 << length) - 1 if length < 64 else -1)


def top_k(base: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", code_col: str = "code") -> DataFrame:
    """(query_id, neighbor_id, distance, rank): the k rows of ``base`` nearest to each query, by (distance, id).

    ``base`` and ``queries`` have an id and a 64-bit code; rows where either is null are left out. A row is no neighbour
    of a query with its own id. Repeated rows count once; an id with several codes counts with each. Fewer than k other
    rows: all of them. No rows or no queries: empty.

    Equal codes are one entry of the index with their k + 1 smallest ids (more can't be among the k nearest), so a code
    in a third of all rows is one row. The index is written once, as a table in buckets of (segment, key) that is dropped
    in the end, and not shuffled again. Per round the queries still open probe it; candidates are verified by their
    Hamming distance and cut to k per query before and after the shuffle. The driver sees the number of open queries.
    After the largest radius everything has been met.
    """
    own = base.select(F.col(id_col).alias("id"), F.col(code_col).alias("code")).where(
        "id IS NOT NULL AND code IS NOT NULL").distinct()
    asked = queries.select(F.col(id_col).alias("query_id"), F.col(code_col).alias("query")).where(
        "query_id IS NOT NULL AND query IS NOT NULL").distinct()
    first = Window.partitionBy("code").orderBy("id")
    codes = cut(own.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
                .groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    n_codes = codes.count()
    parts = segments(n_codes)
    entries = codes.select("code", "ids", F.posexplode(F.array(*[_segment("code", *p) for p in parts])).alias("part", "key"))
    spark, table = base.sparkSession, f"hamming_index_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        entries.repartition(buckets, "part", "key").write.bucketBy(buckets, "part", "key").saveAsTable(table)
        return _rounds(spark.table(table), cut(asked), parts, k)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def _rounds(index: DataFrame, open_: DataFrame, parts: list[tuple[int, int]], k: int) -> DataFrame:
    """The search itself; every round is computed and kept before the next one, so the result doesn't read ``index``."""
    nearest = Window.partitionBy("query_id", "query").orderBy("distance", "id")
    best = done = None
    for radius in range(max((n for _, n in parts), default=0) + 1):
        probes = None
        for i, (low, length) in enumerate(parts):
            if radius <= length:
                flipped = open_.select("query_id", "query", F.lit(i).alias("part"),
                                       _segment("query", low, length).alias("own"), F.explode(_masks(length, radius)).alias("m"))
                rows = flipped.select("query_id", "query", "part", F.col("own").bitwiseXOR(F.col("m")).alias("key"))
                probes = rows if probes is None else probes.union(rows)
        met = (probes.join(index, ["part", "key"])
               .withColumn("distance", F.bit_count(F.col("query").bitwiseXOR(F.col("code"))))
               .dropDuplicates(["query_id", "query", "code"])
               .select("query_id", "query", "distance", F.explode("ids").alias("id")).where("id != query_id"))
        if best is not None:
            met = met.union(best.join(open_, ["query_id", "query"], "left_semi").select(*met.columns)).distinct()
        best = cut(met.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
                   .select("query_id", "query", "distance", "id", "rank"))
        covered = len(parts) * (radius + 1) - 1
        proven = best.where((F.col("rank") == k) & (F.col("distance") <= covered)).select("query_id", "query")
        last = radius == max(n for _, n in parts)
        closed = best if last else best.join(proven, ["query_id", "query"], "left_semi")
        done = closed if done is None else done.union(closed)
        if last:
            break
        open_ = cut(open_.join(proven, ["query_id", "query"], "left_anti"))
        if open_.isEmpty():
            break
    return done.select("query_id", F.col("id").alias("neighbor_id"), F.col("distance").cast("int").alias("distance"), "rank")
