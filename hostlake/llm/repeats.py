"""Substring de-duplication: seed and extend on winnowed anchors.

A window is ``length`` consecutive words. Its anchor is the ``gram``-word sequence in it with the smallest hash
(winnowing), so equal windows have equal anchors, and neighbouring windows mostly share one. Each anchor owns the run
of windows that chose it; the run's words, extended to both sides as far as these windows go, are its span.

Documents are joined on anchors. Anchors of one document only are dropped: nothing in their spans repeats. Where whole
spans are equal (the inside of a shared passage), the match extends over the span at once and the smallest document id
is known by aggregation. Where spans that share an anchor differ (the edges of a passage), the match is extended word
by word: the windows of one span per content are hashed and grouped. Adjacent matches merge into maximal repeats.
No step pairs the documents that share an anchor, so a passage in a third of all documents costs one row in each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostlake.llm.common import cut, row_key, small_batches, stored

_U = np.uint64
#: Odd multipliers of the two polynomial hashes.
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse, modulo 2**64."""
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        size = max(n, 1 << 14)
        out = []
        for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
            steps = np.full(size, base, dtype=_U)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        _POWERS[which] = tuple(out)
    up, down = _POWERS[which]
    return up[:n], down[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits (shift, multiply, shift)."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xA0761D6478BD642F)
    return x ^ (x >> _U(32))


class Hashed:
    """Hashes of any run of a text's words in constant time, by prefix sums of two polynomials."""

    def __init__(self, words: list[bytes]):
        digest = xxhash.xxh64_intdigest
        one = np.fromiter(map(digest, words), dtype=_U, count=len(words))
        self.n, self.sums = len(words), []
        for which, h in enumerate((one, _mix(one))):
            total = np.zeros(len(words) + 1, dtype=_U)
            np.cumsum(h * _powers(which, len(words))[0], out=total[1:])
            self.sums.append(total)

    def runs(self, which: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        total = self.sums[which]
        return _mix((total[stop] - total[start]) * _powers(which, self.n + 1)[1][start])


def anchors(words: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, span hash, first owned window, last owned window) of each anchor; empty below ``length`` words."""
    n = len(words)
    if n < length:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    hashed = Hashed(words)
    at = np.arange(n - gram + 1)
    grams = hashed.runs(0, at, at + gram)
    windows = np.lib.stride_tricks.sliding_window_view(grams, length - gram + 1)
    chosen = np.arange(len(windows)) + windows.argmin(axis=1)  # leftmost of equal ones: never moves back
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(windows) - 1]])
    where = chosen[first]
    shape = (last - first).astype(_U) << _U(32) | (where - first).astype(_U)
    span = _mix(hashed.runs(1, first, last + length) ^ shape)
    return grams[where].view(np.int64), span.view(np.int64), first, last


def _anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, counts = [], []
            for text in batch.column(2).to_pylist():
                parts.append(anchors(text.encode().split(), length, gram))
                counts.append(len(parts[-1][0]))
            take = pa.array(np.repeat(np.arange(len(counts)), counts))
            a, s, lo, hi = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [np.zeros(0, np.int64)] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(a), pa.array(s),
                 pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], names=["id", "key", "a", "s", "lo", "hi"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, key long, a long, s long, lo int, hi int")


def _window_rows(edges: DataFrame, length: int) -> DataFrame:
    """(w1, w2, id, key, start) of the windows in the spans (null: none) of each row (id, key, text, spans)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, counts = [], []
            for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if not spans:
                    counts.append(0)
                    continue
                words = text.encode().split()
                start = np.unique(np.concatenate([np.arange(x["lo"], x["hi"] + 1) for x in spans]))
                hashed = Hashed(words)
                out.append((hashed.runs(0, start, start + length), hashed.runs(1, start, start + length), start))
                counts.append(len(start))
            take = pa.array(np.repeat(np.arange(len(counts)), counts))
            w1, w2, start = (np.concatenate(x) for x in zip(*out, strict=True)) if out else [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(w1.astype(_U).view(np.int64)), pa.array(w2.astype(_U).view(np.int64)), batch.column(0).take(take),
                 batch.column(1).take(take), pa.array(start.astype(np.int32))], names=["w1", "w2", "id", "key", "start"])

    kind = edges.schema["id"].dataType.simpleString()
    return edges.mapInArrow(run, f"w1 long, w2 long, id {kind}, key long, start int")


def covered(docs: DataFrame, length: int = 50, gram: int = 20) -> DataFrame:
    """(id, key, spans array<struct<start, stop>>): the runs of words of a document that are covered by windows which
    also start in a document with a smaller id. ``docs``: (id, key, text), key and text not null.

    Texts meet their open spans by a left join on (id, key), whatever the number of spans, so that this exchange of the
    texts is the same as that of a caller who joins the result to ``docs`` in the same way; Spark then runs it once.
    """
    rows = stored(_anchor_rows(docs.where("id IS NOT NULL"), length, gram), "anchors")
    # written first: Spark splits a hot key of a join between two plain tables, not of one below an aggregation
    twice = stored(rows.groupBy("a").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x < y").select("a"), "twice")
    seeds = stored(rows.join(twice, "a", "left_semi"), "seeds")
    same = seeds.groupBy("a", "s").agg(F.min("id").alias("first"))
    several = same.groupBy("a").agg((F.count("*") > 1).alias("edge"))
    known = stored(same.join(several, "a"), "spans")
    judged = cut(seeds.join(known, ["a", "s"]).select("id", "key", "lo", "hi", "edge", "first"))
    inside = judged.where("id > first").select(
        "id", "key", F.col("lo").alias("start"), (F.col("hi") + F.lit(length)).alias("stop"))
    open_ = (judged.where("edge AND id = first").groupBy("id", "key")
             .agg(F.collect_list(F.struct("lo", "hi")).alias("spans")))
    small_batches(docs.sparkSession)
    windows = _window_rows(docs.join(open_, ["id", "key"], "left").select("id", "key", "text", "spans"), length)
    found = windows.groupBy("w1", "w2").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    edge = windows.join(found, ["w1", "w2"]).where("id > first").select(
        "id", "key", "start", (F.col("start") + F.lit(length)).alias("stop"))
    return inside.union(edge).groupBy("id", "key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def remove_repeats(docs: DataFrame, length: int = 50, gram: int = 20, id_col: str = "doc_id",
                   text_col: str = "text", texts: bool = True) -> DataFrame:
    """Removes every word covered by a window of ``length`` words that also starts in a document with a smaller id.

    Words are runs of characters other than space and \\x09-\\x0D, unchanged. All windows are judged on the input.
    Returns one row per input row: (id, n_words, n_removed, kept_sha256, and with ``texts`` the maximal repeats removed
    as [start, stop) word positions and the kept words joined by one space). A null text has no words. A document with
    a null id is never smaller nor larger than another: it keeps its words and removes none. Rows with equal ids don't
    remove each other's words. Repeats inside one document stay. Other columns are not read.
    An empty table gives an empty one. A very long text is judged whole: one task reads its words, any compare its spans.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), row_key(F.col(id_col), F.col(text_col)).alias("key"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spans = covered(narrow, length, gram)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, digests, kept_texts, repeats = [], [], [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = text.encode().split()
                steps = np.zeros(len(words) + 1, dtype=np.int64)
                if found:
                    np.add.at(steps, [x["start"] for x in found], 1)
                    np.add.at(steps, [x["stop"] for x in found], -1)
                gone = np.cumsum(steps[:-1]) > 0
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if found else words)
                n.append(len(words))
                removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(kept).hexdigest())
                if texts:
                    turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                    repeats.append([{"start": int(a), "stop": int(b)} for a, b in turns.reshape(-1, 2)])
                    kept_texts.append(kept.decode())
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            names = [id_col, "n_words", "n_removed", "kept_sha256"]
            if texts:
                cols += [pa.array(repeats, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                         pa.array(kept_texts, pa.string())]
                names += ["repeats", "kept_text"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    more = ", repeats array<struct<start:int,stop:int>>, kept_text string" * texts
    return narrow.join(spans, ["id", "key"], "left").select("id", "text", "spans").mapInArrow(
        run, f"`{id_col}` {kind}, n_words long, n_removed long, kept_sha256 string{more}")
