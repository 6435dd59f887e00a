"""Periodic runs of words in a text, by enumeration of maximal pairs over its LCP intervals.

A maximal pair (i, j, l) is two places whose next l words are equal, with other words (or an end) before and behind.
With distance q = j - i <= l the pair is a stretch of l + q words in which words q apart are equal and that no
neighbour extends: a run, found as it is, without extension. A run of exponent 4 or more has l >= 3 q, so only LCP
intervals of ``MIN_EQUAL`` words or more matter, and in one of length l only pairs at most l / 3 apart.

Each task sorts the suffixes of a batch of texts by prefix doubling (numpy), those alone whose first words occur again
in their text. The LCP-interval tree is then walked bottom up. An interval has its places in order, and the places where
the left word changes in that order: its class lists by left word, side by side. Where two children meet, each place of
the smaller one looks at its neighbours in the larger one, and leaps over a stretch of places that have its own left
word. Every place looked at is a pair reported, so the work is n log n and the number of pairs, which grows with the sum
of the runs' exponents (linear in the words), also for a text that is one word a million times.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostlake.llm.common import small_batches

#: Runs have this many words, and this many periods, or more.
MIN_WORDS, MIN_PERIODS = 6, 4
#: The shortest common start of a pair that can be such a run (period 1: 5 words; period q: 3 q words).
MIN_EQUAL = 5
#: About so many bytes of text are searched at once (a longer text by itself).
BATCH_BYTES = 4 << 20


class Places:
    """The places of an interval in order, and those whose left word differs from that of the place in front."""

    __slots__ = ("at", "heads")

    def __init__(self, place: int):
        self.at, self.heads = [place], [place]

    def add(self, place: int, left: list[int]) -> None:
        at = self.at
        k = bisect_left(at, place)
        own = left[place]
        follower = at[k] if k < len(at) else -1
        changed = follower >= 0 and (k == 0 or left[at[k - 1]] != left[follower])  # a head so far
        if k == len(at):
            at.append(place)
        else:
            at.insert(k, place)
        if k == 0 or left[at[k - 1]] != own:
            insort(self.heads, place)
        if follower >= 0 and changed != (left[follower] != own):
            if changed:
                del self.heads[bisect_left(self.heads, follower)]
            else:
                insort(self.heads, follower)

    def join(self, other: Places, left: list[int]) -> None:
        if len(other.at) * 16 < len(self.at):
            for place in other.at:
                self.add(place, left)
            return
        self.at += other.at
        self.at.sort()  # two sorted runs: linear
        before = None
        self.heads = heads = []
        for place in self.at:
            if (word := left[place]) != before:
                heads.append(place)
                before = word

    def partners(self, place: int, most: int, left: list[int]) -> Iterator[int]:
        """The places at most ``most`` away whose left word is another one."""
        at, heads, own = self.at, self.heads, left[place]
        start = bisect_left(at, place)
        k, low = start - 1, place - most
        while k >= 0 and (p := at[k]) >= low:
            if left[p] != own:
                yield p
                k -= 1
            else:
                k = bisect_left(at, heads[bisect_right(heads, p) - 1]) - 1
        k, high = start, place + most
        while k < len(at) and (p := at[k]) <= high:
            if left[p] != own:
                yield p
                k += 1
            else:
                h = bisect_right(heads, p)
                if h == len(heads):
                    break
                k = bisect_left(at, heads[h])


def _repeated(words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places whose next ``MIN_EQUAL`` words occur again in their text, at least (by a hash)."""
    if len(words) < MIN_EQUAL:
        return np.zeros(0, dtype=np.int64)
    n = len(words) - MIN_EQUAL + 1
    mixed = text[:n].astype(np.uint64)
    for k in range(MIN_EQUAL):
        mixed = (mixed ^ words[k:n + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    place = np.flatnonzero(text[:n] == text[MIN_EQUAL - 1:])
    mixed = mixed[place]
    order = np.argsort(mixed)
    same = mixed[order][1:] == mixed[order][:-1]
    again = np.zeros(len(place) + 1, dtype=bool)
    again[:-1][1:] |= same
    again[:-1][:-1] |= same
    return np.sort(place[order[again[:-1]]])


def _groups(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order of the rows by the keys, where in it a new combination begins)."""
    order = np.lexsort(keys[::-1])
    first = np.zeros(len(order), dtype=bool)
    first[:1] = True
    for k in keys:
        first[1:] |= k[order][1:] != k[order][:-1]
    return order, first


def suffixes(words: np.ndarray, text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The repeated places, so that places of one text with the longest common starts lie side by side.

    ``words``: numbers of all texts' words; ``text``: the text of each word; ``ends``: by text, where it ends.
    The order is that of the words' numbers, a text's end first. A place's rank is the first row of its group; each
    round doubles the words that the ranks stand for and splits the groups that are left. Ranks are needed for the
    repeated places and those just behind them, nowhere else."""
    place = _repeated(words, text)
    if not len(place):
        return place
    near = np.zeros(len(words) + MIN_EQUAL + 1, dtype=bool)
    for k in range(MIN_EQUAL + 1):
        near[place + k] = True
    near = np.flatnonzero(near[:len(words)])
    stop = ends[text[near]]
    order, first = _groups([text[near], *(np.where(near + k < stop, words[np.minimum(near + k, len(words) - 1)], -1)
                                          for k in range(MIN_EQUAL))])
    rank = np.full(len(words), -1, dtype=np.int64)
    sorted_ = near[order]
    rank[sorted_] = np.maximum.accumulate(np.where(first, np.arange(len(near)), 0))
    length, out = MIN_EQUAL, sorted_.copy()
    rows = np.arange(len(near))
    keep = np.zeros(len(words), dtype=bool)
    keep[place] = True
    while True:
        group = rank[out[rows]]
        alone = np.ones(len(rows), dtype=bool)
        alone[1:] &= group[1:] != group[:-1]
        alone[:-1] &= group[1:] != group[:-1]
        rows = rows[~alone]
        if not len(rows):
            return out[keep[out]]
        here = out[rows]
        then = here + length
        inside = then < ends[text[here]]
        behind = np.where(inside, rank[np.where(inside, then, 0)], -1)
        order, first = _groups([rank[here], behind])
        here = here[order]
        out[rows] = here  # groups are stretches of rows and stay where they are
        rank[here] = rows[np.maximum.accumulate(np.where(first, np.arange(len(rows)), 0))]
        length *= 2


def common_starts(order: list[int], words: list[int], ends: list[int], text: list[int]) -> list[int]:
    """How many words each place of ``order`` has in common with the one in front of it (0: another text).

    In the order of the texts: a place has at least one word less in common than the place before it, as long as what is
    left makes both places of the pair repeated ones."""
    row = {p: i for i, p in enumerate(order)}
    out = [0] * len(order)
    h = last = 0
    for p in sorted(order):
        h -= p - last
        if h < MIN_EQUAL:
            h = 0
        last = p
        i = row[p]
        if i:
            q = order[i - 1]
            if text[q] == text[p]:
                most = ends[text[p]] - max(p, q)
                while h < most and words[p + h] == words[q + h]:
                    h += 1
                out[i] = h
                continue
        h = 0
    return out


def maximal_pairs(order: list[int], equal: list[int], left: list[int]) -> Iterator[tuple[int, int, int]]:
    """(place, equal words, distance) of the maximal pairs with equal words >= 3 distances and >= ``MIN_EQUAL``.

    ``left``: the number of the word before each place; a text's first place has a number of its own."""
    stack: list[tuple[int, Places]] = []

    def meet(child: Places, length: int, own: Places) -> Iterator[tuple[int, int, int]]:
        small, large = (child, own) if len(child.at) <= len(own.at) else (own, child)
        most = length // (MIN_PERIODS - 1)
        for place in small.at:
            for other in large.partners(place, most, left):
                yield min(place, other), length, abs(place - other)
        large.join(small, left)
        merged.append(large)

    merged: list[Places] = []
    for place, h in zip([*order, -1], [*equal, 0], strict=True):
        if stack:
            current = stack.pop()[1]
            while stack and stack[-1][0] > h:
                length, own = stack.pop()
                yield from meet(current, length, own)
                current = merged.pop()
            if h >= MIN_EQUAL:
                if stack and stack[-1][0] == h:
                    yield from meet(current, h, stack.pop()[1])
                    current = merged.pop()
                stack.append((h, current))
        if place >= 0:
            stack.append((len(left) + 1, Places(place)))


def find_runs(texts: list[list[int]]) -> list[list[tuple[int, int, int]]]:
    """By text (numbers of its words): (start, length, period) of its runs, by start and period."""
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(sizes)
    words = np.concatenate([np.asarray(t, dtype=np.int64) for t in texts]) if len(texts) else np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    order = suffixes(words, text, ends)
    found: list[dict[tuple[int, int], int]] = [{} for _ in texts]
    if len(order):
        left = np.concatenate([[-1], words[:-1]])
        left[(ends - sizes)[sizes > 0]] = -1
        rows, of, w, stop = order.tolist(), text.tolist(), words.tolist(), ends.tolist()
        begin = (ends - sizes).tolist()
        for place, equal, period in maximal_pairs(rows, common_starts(rows, w, stop, of), left.tolist()):
            if equal + period >= MIN_WORDS:
                at = (place - begin[of[place]], equal + period)
                own = found[of[place]]
                # the same stretch is also found with multiples of its period
                if period < own.get(at, period + 1):
                    own[at] = period
    return [sorted(((s, n, q) for (s, n), q in f.items()), key=lambda r: (r[0], r[2])) for f in found]


def _numbered(texts: list[str]) -> tuple[list[list[bytes]], list[list[int]]]:
    """The words of each text, and their numbers in the batch."""
    split = [t.encode().split() for t in texts]  # bytes.split() knows just the six separators
    numbers: dict[bytes, int] = {}
    return split, [[numbers.setdefault(w, len(numbers)) for w in words] for words in split]


def _portions(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BATCH_BYTES:
            yield start, i
            start, size = i, 0
        size += len(t)
    yield start, len(texts)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: bool = True) -> DataFrame:
    """The runs of every whole text, and the text with each run collapsed to one period.

    Words are runs of characters other than space and \\x09-\\x0D. A run is a stretch of words with smallest period q
    (words q apart are equal), of ``MIN_WORDS`` words and 4 q words or more, that no neighbour extends. Returns one row
    per input row: (id, n_runs, start, length, period, exponent_milli of the run with the greatest length / period -
    ties: smallest start, then period; nulls without runs - runs_sha256 of the lines ``start,length,period``,
    collapsed_sha256 of the kept words joined by one space, and with ``texts`` runs as an array and kept_text).
    A word is dropped if some run has it after its first q words.

    A null or empty text has no words and no runs (both digests are of nothing); ids may be null or repeat, and equal
    rows get equal results. An empty table gives an empty one. A very long text is one row of one task, in memory some
    hundred bytes per word. Other columns are not read. No shuffle.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def judged(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
        best = None
        kept = words
        if runs:
            gone = np.zeros(len(words) + 1, dtype=np.int64)
            for s, n, q in runs:
                gone[s + q] += 1
                gone[s + n] -= 1
                if best is None or n * best[2] > best[1] * q:
                    best = s, n, q
            drop = np.cumsum(gone[:-1]) > 0
            kept = [w for w, d in zip(words, drop.tolist(), strict=True) if not d]
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        joined = b" ".join(kept)
        return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(joined).hexdigest(),
                [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] if texts else None,
                joined.decode() if texts else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_texts = [t or "" for t in batch.column(1).to_pylist()]
            for low, high in _portions(all_texts):
                split, numbers = _numbered(all_texts[low:high])
                rows = [judged(w, r) for w, r in zip(split, find_runs(numbers), strict=True)]
                cols = list(zip(*rows, strict=True)) or [[]] * 9
                arrays = [pa.array(c, k) for c, k in zip(cols, [pa.int64()] * 5 + [pa.string()] * 2, strict=False)]
                if texts:
                    arrays += [pa.array(cols[7], run_type), pa.array(cols[8], pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), *arrays],
                                                 names=[id_col, *names, *(["runs", "kept_text"] if texts else [])])

    schema = (f"`{id_col}` {kind}, " + ", ".join(f"{n} long" for n in names[:5]) + ", runs_sha256 string, collapsed_sha256 string"
              + ", runs array<struct<start:long,length:long,period:long>>, kept_text string" * texts)
    return docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias(text_col)).mapInArrow(run, schema)


#: Words of the separators above, as a Java pattern.
WORD = "[^\\x20\\x09-\\x0D]+"


def with_planted_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) where a tenth of the texts, chosen by crc32 of the id, repeats some of its words to its end: with
    h = crc32(decimal id), g = h div 10 and n words, each word i >= a of a text with h % 10 = 0 becomes the word
    a + (i - a) % p, a = g % n, p = 1 + (n - a) div (3 + g % 8). Texts without words, and rows without id, stay."""
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    h = F.crc32(ident.cast("string").cast("binary"))
    rows = docs.select(ident.alias("id"), text.alias("text"), F.when(h % 10 == 0, F.floor(h / 10).cast("long")).alias("g"))
    rows = rows.withColumn("w", F.when(F.col("g").isNotNull() & F.col("text").isNotNull(), F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    rows = rows.withColumn("n", F.size("w").cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.expr("(n - a) div (3 + g % 8)"))
    planted = F.expr("array_join(transform(w, (x, i) -> IF(i < a, x, w[int(a + (i - a) % p)])), ' ')")
    return rows.select(F.col("id").alias(id_col), F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias(text_col))
