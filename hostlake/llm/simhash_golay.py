"""Near-duplicate documents: 64-bit SimHash, with Golay-code fuzzy hashing to find fingerprints a few bits apart.

The (23, 12) Golay code is perfect: each 23-bit word lies within three bits of exactly one codeword. Two words at most
two bits apart have a word between them, one bit from both at most, so the codewords that decode from a word and from
its one-bit neighbours (one to six of them) always share a codeword with those of the other word.

A fingerprint is cut into three segments. With two errors at most, one segment at least has none (pigeonhole) and the
next one has two at most. So each fingerprint gets, for each segment, the keys (segment as it is, codeword of the next
segment). Fingerprints that share a key meet; the bit distance is verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostlake.llm.common import cut, row_key, small_batches
from hostlake.llm.components import connected_components

#: The generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1 of the (23, 12) Golay code; XXH64's seed.
GENERATOR, SEED = 0b110001110101, 42
#: Low bit and length of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: A key with more fingerprints than this is handled by its members' one-bit neighbours (exactly, without pairs).
PAIRS_UP_TO = 32


def _remainders() -> np.ndarray:
    """Remainder by the generator of each 12-bit value moved up by 11 bits."""
    out = np.arange(1 << 12, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        out = np.where(out >> bit & 1, out ^ (GENERATOR << (bit - 11)), out)
    return out


_REMAINDER = _remainders()


def _syndrome(words: np.ndarray) -> np.ndarray:
    return (words & 0x7FF) ^ _REMAINDER[words >> 11]


def _error_patterns() -> np.ndarray:
    """The pattern of three errors at most for each of the 2048 syndromes."""
    patterns = np.array([sum(1 << b for b in bits) for k in range(4) for bits in combinations(range(23), k)])
    out = np.zeros(1 << 11, dtype=np.int64)
    out[_syndrome(patterns)] = patterns
    return out


_ERRORS = _error_patterns()


def codeword_index(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each 23-bit word."""
    return (words ^ _ERRORS[_syndrome(words)]) >> 11


def fuzzy_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``fingerprints``, key): equal keys for every two fingerprints two bits apart or less."""
    bits = fingerprints.astype(np.uint64)
    parts = [((bits >> np.uint64(low)) & np.uint64((1 << n) - 1)).astype(np.int64) for low, n in SEGMENTS]
    rows, keys = [], []
    for i, exact in enumerate(parts):
        j = (i + 1) % len(parts)
        flips = np.concatenate([[0], 1 << np.arange(SEGMENTS[j][1], dtype=np.int64)])
        index = np.sort(codeword_index(parts[j][:, None] ^ flips[None, :]), axis=1)
        first = np.ones(index.shape, dtype=bool)
        first[:, 1:] = index[:, 1:] != index[:, :-1]
        row, col = np.nonzero(first)
        rows.append(row)
        keys.append((np.int64(i) << np.int64(34)) | (exact[row] << np.int64(12)) | index[row, col])
    return np.concatenate(rows), np.concatenate(keys)


def simhash(text: bytes, words_per_shingle: int) -> int:
    """Unsigned 64-bit SimHash; a bit is 1 if set in over half the shingles' XXH64. No words: 0.

    ``bytes.lower`` and ``bytes.split`` know ASCII only: A-Z, and the separators \\x20 and \\x09-\\x0D.
    """
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < words_per_shingle:
        shingles = [b" ".join(words)]
    else:
        joined = b" ".join(words)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        shingles = [joined[a:b] for a, b in zip(starts.tolist(), ends[words_per_shingle - 1:].tolist(), strict=False)]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(s, SEED) for s in shingles])  # big-endian
    ones = np.zeros(64, dtype=np.int64)
    grid = np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8)
    for k in range(0, len(grid), 1 << 16):
        ones += np.unpackbits(grid[k:k + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(grid)).tobytes(), "big")


def fingerprints(docs: DataFrame, words_per_shingle: int = 3, id_col: str = "doc_id", text_col: str = "text",
                 key: Column | None = None) -> DataFrame:
    """(id, key, fingerprint as signed long), one row per input row; a null text is an empty one."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simhash((t or "").encode(), words_per_shingle) for t in batch.column(2).to_pylist()]
            signed = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(signed)],
                                             names=["id", "key", "fp"])

    narrow = docs.select(F.col(id_col).alias("id"), (F.lit(0) if key is None else key).cast("long").alias("key"),
                         F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, f"id {kind}, key long, fp long")


def _with_keys(distinct: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            rows, keys = fuzzy_keys(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[rows])], names=["bucket", "fp"])

    return distinct.select("fp").mapInArrow(run, "bucket long, fp long")


def links(distinct: DataFrame, max_bits: int = 2) -> DataFrame:
    """(u, v) edges whose components are those of all links at most ``max_bits`` (2 or fewer) apart.

    A key that few fingerprints share has its pairs verified one by one. One that many share (a hot bucket) is not
    paired: its members send out their one-bit neighbours, and those that meet at a neighbour are all linked to the
    smallest one there. Meeting at a neighbour means two bits apart at most, and all such pairs do meet.
    """
    if max_bits not in (1, 2):
        raise ValueError("the keys find distances of 1 or 2 bits")
    keys = _with_keys(distinct)
    shared = keys.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    met = cut(keys.join(shared, "bucket"))
    few = met.where(F.col("n") <= PAIRS_UP_TO).groupBy("bucket").agg(F.collect_list("fp").alias("fps"))
    pairs = F.expr(f"""flatten(transform(fps, (a, i) -> transform(
        filter(slice(fps, i + 2, size(fps)), b -> bit_count(a ^ b) <= {max_bits}), b -> struct(a as u, b as v))))""")
    light = few.select(F.explode(pairs).alias("e")).select("e.u", "e.v")
    many = met.where(F.col("n") > PAIRS_UP_TO).select("fp").distinct()
    flips = [0, *(1 << b if b < 63 else -(1 << 63) for b in range(64))]
    near = many.select("fp", F.explode(F.array(*[F.lit(x).cast("long") for x in flips])).alias("flip"))
    near = near.select("fp", F.expr("fp ^ flip").alias("middle"))
    if max_bits == 2:
        low = near.groupBy("middle").agg(F.min("fp").alias("low"), F.count("*").alias("c")).where("c > 1")
        heavy = near.join(low, "middle").where("fp != low").select(F.col("fp").alias("u"), F.col("low").alias("v"))
    else:
        there = many.select(F.col("fp").alias("middle"))
        heavy = near.join(there, "middle").where("fp < middle").select(F.col("fp").alias("u"), F.col("middle").alias("v"))
    return light.union(heavy).distinct()


def _grouped(found: DataFrame, max_bits: int) -> DataFrame:
    """(fp, part, component_id): part is the component's smallest fingerprint, component_id its smallest id."""
    each = cut(found.groupBy("fp").agg(F.min("id").alias("low")))
    parts = connected_components(links(each, max_bits))
    named = each.join(parts, each["fp"] == parts["node"], "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("part"))
    lowest = named.groupBy("part").agg(F.min("low").alias("component_id"))
    return named.join(lowest, "part").select("fp", "part", "component_id")


def near_duplicates(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id), one row per input row.

    component_id is the smallest id reachable over links of ``max_bits`` differing bits at most, the row's own
    included. Rows with equal fingerprints (copies; also all texts without words, fingerprint 0) are one node, so a
    group of copies of any size is one row from the first shuffle on. Null ids are never the smallest; a component of
    null ids only has a null component_id. Other columns are not read. Only (id, fingerprint) rows are shuffled.
    An empty table gives an empty one. A very long text is hashed whole, in one task.
    """
    found = cut(fingerprints(docs, words_per_shingle, id_col, text_col).select("id", "fp"))
    return found.join(_grouped(found, max_bits), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_each(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component left: the one with the smallest id (null ids last, then by a hash of
    the text). Of rows that repeat it (same id, same text) one stays. All columns are kept."""
    key = row_key(F.col(id_col), F.col(text_col))
    found = cut(fingerprints(docs, words_per_shingle, id_col, text_col, key))
    named = found.join(_grouped(found, max_bits), "fp")
    order = F.struct(F.col("id").isNull().alias("a"), F.col("id").alias("b"), F.col("key").alias("c"))
    stay = (named.groupBy("part").agg(F.min(order).alias("o"))
            .select(F.col("o.b").alias("sid"), F.col("o.c").alias("skey")))
    own = docs.select(*[F.col(f"`{c}`") for c in docs.columns])
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = own.toDF(*names).withColumn("skey", row_key(F.col(names[docs.columns.index(id_col)]),
                                                      F.col(names[docs.columns.index(text_col)])))
    ident = names[docs.columns.index(id_col)]
    kept = own.join(stay, own[ident].eqNullSafe(stay["sid"]) & (own["skey"] == stay["skey"]), "left_semi")
    return kept.dropDuplicates([ident, "skey"]).select(*names).toDF(*docs.columns)
