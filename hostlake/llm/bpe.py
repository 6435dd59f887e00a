"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A batch's pre-tokens lie one after another in one byte buffer, as linked lists of segments that never cross a
pre-token's end. The queue has a bucket per merge rank with the positions (list heads) whose pair has that rank, and a
bitmap in three levels over the ranks; find-first-set picks the lowest rank in use. A position is stale, and skipped,
when its pair no longer has the bucket's rank. Work is one queue entry per pair that ever exists, so a pre-token of
millions of bytes costs its length times a constant, and a bucket is drained without asking the bitmap again.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from hostlake.llm.common import small_batches

_BITS = 64


class RankQueue:
    """Positions by merge rank; the lowest rank first, within a rank the lowest position."""

    def __init__(self, n_ranks: int):
        words = -(-n_ranks // _BITS)
        self.low = [0] * words
        self.mid = [0] * -(-words // _BITS)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.open(rank, [position])
        else:
            bucket.append(position)

    def open(self, rank: int, positions: list[int]) -> None:
        """A new bucket; its bits are set in each level."""
        self.buckets[rank] = positions
        word = rank >> 6
        if not self.low[word]:
            group = word >> 6
            if not self.mid[group]:
                self.top |= 1 << group
            self.mid[group] |= 1 << (word & 63)
        self.low[word] |= 1 << (rank & 63)

    def first(self) -> int:
        """The lowest rank with a bucket; -1 if there is none."""
        if not self.top:
            return -1
        group = (self.top & -self.top).bit_length() - 1
        bits = self.mid[group]
        word = (group << 6) | ((bits & -bits).bit_length() - 1)
        bits = self.low[word]
        return (word << 6) | ((bits & -bits).bit_length() - 1)

    def take(self, rank: int) -> list[int]:
        """Removes a bucket; its positions in order. A merge makes pairs longer than the merged one, so none of them
        comes into the bucket that is being worked on."""
        positions = self.buckets.pop(rank)
        positions.sort()
        word = rank >> 6
        self.low[word] &= ~(1 << (rank & 63))
        if not self.low[word]:
            group = word >> 6
            self.mid[group] &= ~(1 << (word & 63))
            if not self.mid[group]:
                self.top &= ~(1 << group)
        return positions


class Vocabulary:
    """Merge ranks of a rank file (base64 token and rank per line); a token's id is its rank."""

    at_once = 2000

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {str(i): t for t, i in ranks.items()}
        self.names = {t: i for i, t in self.tokens.items()}
        self.size = max(ranks.values(), default=0) + 1

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls({base64.b64decode(t): int(i) for t, i in map(bytes.split, f)})

    def encode(self, pretokens: list[bytes]) -> list[str]:
        """Ids of each pre-token, as decimal numbers joined by a space ('' for an empty one)."""
        ranks, names, out = self.ranks, self.names, [""] * len(pretokens)
        whole = [ranks.get(t) for t in pretokens]
        hard = []
        for i, (t, rank) in enumerate(zip(pretokens, whole, strict=True)):
            if rank is not None:
                out[i] = names[t]
            elif t:
                hard.append(i)
        for k in range(0, len(hard), self.at_once):  # so that the lists stay in the processor's cache
            part = hard[k:k + self.at_once]
            for i, ids in zip(part, self._merged([pretokens[i] for i in part]), strict=True):
                out[i] = ids
        return out

    def _merged(self, pretokens: list[bytes]) -> Iterator[str]:
        ranks, names = self.ranks, self.names
        buffer = b"".join(pretokens)
        n = len(buffer)
        after = list(range(1, n + 1))  # the next segment's start; of a pre-token's last segment its end
        before = list(range(-1, n))  # the start of the segment in front; -1 at a pre-token's start and at the end
        pair = [-1] * (n + 1)  # the rank of a segment with the next one; -1: none
        before[n] = -1
        get, bounds, start = ranks.get, [], 0
        queue = RankQueue(self.size)
        buckets, opened = queue.buckets, queue.open
        for token in pretokens:
            stop = start + len(token)
            before[start] = -1
            bounds.append((start, stop))
            for p in range(start, stop - 1):
                rank = get(buffer[p:p + 2])
                if rank is not None:
                    pair[p] = rank
                    if rank in buckets:
                        buckets[rank].append(p)
                    else:
                        opened(rank, [p])
            start = stop
        first, take = queue.first, queue.take
        while (rank := first()) >= 0:
            bucket, lowest = take(rank), rank
            for k, p in enumerate(bucket):
                if pair[p] != rank:
                    continue  # stale: this pair or its right half was merged meanwhile
                middle = after[p]
                right = after[p] = after[middle]
                pair[middle] = pair[p] = -1
                if before[right] >= 0:
                    before[right] = p
                    new = get(buffer[p:after[right]])
                    if new is not None:
                        pair[p] = new
                        if new in buckets:
                            buckets[new].append(p)
                        else:
                            opened(new, [p])
                        if new < lowest:
                            lowest = new
                left = before[p]
                if left >= 0:
                    new = get(buffer[left:right])
                    if new is None:
                        pair[left] = -1
                    else:
                        pair[left] = new
                        if new in buckets:
                            buckets[new].append(left)
                        else:
                            opened(new, [left])
                        if new < lowest:
                            lowest = new
                if lowest < rank:  # it comes first in this pre-token
                    if k + 1 < len(bucket):
                        opened(rank, bucket[k + 1:])
                    break
        for start, stop in bounds:
            ids, p = [], start
            while p < stop:
                ids.append(names[buffer[p:after[p]]])
                p = after[p]
            yield " ".join(ids)


class Encoder:
    """Encodes texts batch by batch; keeps the ids of recent pre-tokens, at most two generations of ``keep``."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, keep: int = 300_000, longest: int = 64):
        self.vocabulary, self.keep, self.longest = vocabulary, keep, longest
        self.split = regex.compile(pattern).findall
        self.new: dict[str, str] = {}
        self.old: dict[str, str] = {}

    def batch(self, texts: list[str]) -> Iterator[str]:
        """For each text its ids, as decimal numbers joined by a space."""
        split = [self.split(t) for t in texts]
        if len(self.new) > self.keep:
            self.new, self.old = {}, self.new
        new, old, missing = self.new, self.old, []
        for word in set().union(*split):
            if word not in new:
                if word in old:
                    new[word] = old[word]
                else:
                    missing.append(word)
        new.update(zip(missing, self.vocabulary.encode([w.encode() for w in missing]), strict=True))
        for words in split:
            yield " ".join(map(new.__getitem__, words))
        for word in missing:
            if len(word) > self.longest:
                del new[word]

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids.split(" "))) if ids else b""


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per Python worker and vocabulary; the vocabulary file is read where the task runs."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(Vocabulary.load(path), pattern)
    return _ENCODERS[path, pattern]


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     ids: bool = True) -> DataFrame:
    """Encodes every whole text, decodes the ids again, and reports both.

    Returns (id, n_tokens, ids_sha256, decoded_sha256, and with ``ids`` the token ids as array<int>), one row per input
    row. A null text is an empty one: no tokens, digests of nothing. Null ids stay null; rows may repeat; other columns
    are not read. ``vocabulary`` is a path that every executor can open (installed with the tokenizer package).
    An empty table gives an empty one. A very long text is encoded whole in one task, a very long match of the pattern in
    time linear but for a logarithm in its length. No shuffle: texts are encoded where they are read, ``common.BATCH_ROWS`` at a time.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, pattern)
        for batch in batches:
            rows = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            arrays, texts = [], [t or "" for t in batch.column(1).to_pylist()]
            for found in enc.batch(texts):
                rows["n_tokens"].append(found.count(" ") + 1 if found else 0)
                rows["ids_sha256"].append(hashlib.sha256(found.encode()).hexdigest())
                rows["decoded_sha256"].append(hashlib.sha256(enc.decode(found)).hexdigest())
                if ids:
                    arrays.append([int(x) for x in found.split(" ")] if found else [])
            cols = [batch.column(0), pa.array(rows["n_tokens"], pa.int64()), pa.array(rows["ids_sha256"], pa.string()),
                    pa.array(rows["decoded_sha256"], pa.string())]
            cols += [pa.array(arrays, pa.list_(pa.int32()))] if ids else []
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * ids
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded binary) of token id arrays; a null array decodes to empty bytes."""
    small_batches(encoded.sparkSession)
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Vocabulary.load(vocabulary).tokens
        for batch in batches:
            out = [b"".join(tokens[str(i)] for i in row or []) for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=[id_col, "decoded"])

    return encoded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, decoded binary")
