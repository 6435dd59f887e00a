"""Alignment of two tokenizers over the same bytes, with corpus-wide counts of the token pairs that it links.

Texts are shuffled by their full text first: each distinct text is tokenised and aligned once, and its pair counts are
weighted by how often it occurs. The measures of a text are then joined to all documents that have it.

Tokens of both tokenizers are stretches of the same bytes. Where a token of each ends, a group ends; two tokens are linked
when they share bytes. Cutting the bytes at every end of either side leaves pieces that lie in one token of each, one piece
for each linked pair: links are found by a sorted merge of the ends.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostlake.llm.common import small_batches, stored
from hostlake.session import bounded_broadcast

#: A text is tokenised in chunks of about so many characters, and so many characters of chunks at once.
CHUNK, AT_ONCE = 1 << 17, 1 << 19
#: A text in more than one of so many documents is joined by broadcast (there are fewer of them than this).
HOT = 1000
#: Up to this character the two libraries for byte-level vocabularies hold the same characters for letters and numbers,
#: whatever their Unicode versions; such texts are encoded by the faster one.
PLAIN = "\u024f"
#: The byte-level vocabularies' own pattern of pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A single space inside a line: tokens of either kind never cross it from the left.
_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_symbols() -> dict[str, int]:
    """Symbol of each byte in byte-level vocabularies: printable Latin-1 characters stand for themselves, the other
    bytes in order for the characters from 256 on."""
    out, other = {}, 256
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF:
            out[chr(b)] = b
        else:
            out[chr(other)] = b
            other += 1
    return out


class Aligner:
    """Both tokenizers and the bytes of their tokens; one per Python worker."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        with open(byte_level, encoding="utf-8") as f:
            added = {t["id"]: t["content"].encode() for t in json.load(f)["added_tokens"]}
        symbols, vocabulary = byte_symbols(), self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = added[i] if i in added else bytes(symbols[c] for c in token)
        ranks = {t: i for i, t in enumerate(self.a_bytes) if i not in added}  # merges in the order of their tokens' ids
        self.plain = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b_bytes = [self._piece(i) for i in range(self.b.vocab_size())]
        self.sizes = len(self.a_bytes), len(self.b_bytes)
        self.a_len, self.b_len = (np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (self.a_bytes, self.b_bytes))
        most = max(self.sizes)
        self.names = [f"{i}{end}" for end in ",|;" for i in range(most)]
        #: Whether no piece holds a space behind another character: only then do chunks give the pieces of the whole.
        self.chunked = not any(b" " in x.lstrip(b" ") for x in self.b_bytes)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def chunks(self, text: str) -> list[str]:
        """The text in chunks; between two of them is a single space that begins a token of either kind."""
        out, start = [], 0
        while self.chunked and len(text) - start > CHUNK:
            found = _CUT.search(text, start + CHUNK)
            if not found:
                break
            out.append(text[start:found.start()])
            start = found.end()
        return [*out, text[start:]]

    def align(self, chunks: list[str]) -> list[tuple | None]:
        """By chunk: (A tokens, B tokens, groups, codes of linked pairs, groups as text); None where bytes differ."""
        own = [" " + c for c in chunks]
        a_ids: list = [self.plain.encode_ordinary(t) if t.isascii() or max(t) <= PLAIN else None for t in own]
        other = [i for i, ids in enumerate(a_ids) if ids is None]
        for i, e in zip(other, self.a.encode_batch_fast([own[i] for i in other], add_special_tokens=False), strict=True):
            a_ids[i] = e.ids
        b_ids = self.b.encode(chunks, num_threads=1)
        a_of, b_of = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        good = []
        for i, (text, a, b) in enumerate(zip(own, a_ids, b_ids, strict=True)):
            raw = text.encode()
            if b"".join(map(a_of, a)) == raw and b"".join(map(b_of, b)) == raw:
                good.append(i)
        out: list[tuple | None] = [None] * len(chunks)
        if not good:
            return out
        a_ids, b_ids = [a_ids[i] for i in good], [b_ids[i] for i in good]
        n_a, n_b = [len(x) for x in a_ids], [len(x) for x in b_ids]
        a = np.fromiter(chain.from_iterable(a_ids), dtype=np.int64, count=sum(n_a))
        b = np.fromiter(chain.from_iterable(b_ids), dtype=np.int64, count=sum(n_b))
        a_end, b_end = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])  # chunks have the same bytes on both sides
        a_last = b_end[np.searchsorted(b_end, a_end)] == a_end
        b_last = a_end[np.searchsorted(a_end, b_end)] == b_end
        every = np.sort(np.concatenate([a_end, b_end[~b_last]]), kind="stable")  # two sorted runs
        codes = a[np.searchsorted(a_end, every)] * self.sizes[1] + b[np.searchsorted(b_end, every)]
        common = a_end[a_last]
        side = np.concatenate([2 * np.searchsorted(common, a_end), 2 * np.searchsorted(common, b_end) + 1])
        order = np.argsort(side, kind="stable")
        most = max(self.sizes)
        name = np.concatenate([a + most * a_last, b + 2 * most * b_last])[order]
        text = list(map(self.names.__getitem__, name.tolist()))
        ends = a_end[np.cumsum(n_a) - 1]
        group, link = np.searchsorted(common, ends, "right"), np.searchsorted(every, ends, "right")
        g0 = l0 = t0 = 0
        for i, x, y, g, n in zip(good, n_a, n_b, group.tolist(), link.tolist(), strict=True):
            out[i] = x, y, g - g0, codes[l0:n], "".join(text[t0:t0 + x + y])
            g0, l0, t0 = g, n, t0 + x + y
        return out

    def texts(self, texts: list[str]) -> Iterator[tuple]:
        """By text: (n_a, n_b, n_groups, n_links, groups_sha256, distinct pair codes, how often each)."""
        split = [self.chunks(t) for t in texts]
        portion: list[tuple[int, str]] = []
        size, held = 0, []

        def aligned() -> Iterator[tuple[int, tuple | None]]:
            nonlocal portion, size
            for i, parts in enumerate(split):
                for c in parts:
                    portion.append((i, c))
                    size += len(c)
                    if size >= AT_ONCE:
                        yield from zip([k for k, _ in portion], self.align([c for _, c in portion]), strict=True)
                        portion, size = [], 0
            if portion:
                yield from zip([k for k, _ in portion], self.align([c for _, c in portion]), strict=True)
            yield len(split), None

        at = 0
        for i, found in aligned():
            if i != at:
                yield self._one(held)
                at, held = i, []
            if i < len(split):
                held.append(found)

    @staticmethod
    def _one(parts: list[tuple | None]) -> tuple:
        if any(p is None for p in parts):
            return 0, 0, 0, 0, "", [], []
        codes, n = np.unique(np.concatenate([p[3] for p in parts]), return_counts=True)
        digest = hashlib.sha256()
        for k, p in enumerate(parts):
            digest.update((p[4] if k + 1 < len(parts) else p[4][:-1]).encode())
        return *(sum(p[j] for p in parts) for j in range(3)), int(n.sum()), digest.hexdigest(), codes, n


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(byte_level: str, pieces: str) -> Aligner:
    if (byte_level, pieces) not in _ALIGNERS:
        _ALIGNERS[byte_level, pieces] = Aligner(byte_level, pieces)
    return _ALIGNERS[byte_level, pieces]


def aligned_texts(texts: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """(key, copies, n_a, n_b, n_groups, n_links, groups_sha256, codes, times) of distinct texts (key, copies, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(byte_level, pieces)
        for batch in batches:
            cols = list(zip(*own.texts(batch.column(2).to_pylist()), strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string()),
                 pa.array(cols[5], pa.list_(pa.int64())), pa.array(cols[6], pa.list_(pa.int64()))],
                names=["key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "times"])

    return texts.select("key", "copies", "text").mapInArrow(
        run, "key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
             "codes array<long>, times array<long>")


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """(code, total, best): links of each id pair in the corpus, and whether none of its B id's pairs has more."""
    pairs = aligned.select("copies", F.explode(F.arrays_zip("codes", "times")).alias("p"))
    counts = pairs.groupBy(F.col("p.codes").alias("code")).agg(F.sum(F.col("p.times") * F.col("copies")).alias("total"))
    counts = stored(counts.withColumn("b", F.col("code") % b_size), "pairs")
    top = counts.groupBy("b").agg(F.max("total").alias("top"))
    return counts.join(top, "b").select("code", "total", (F.col("total") == F.col("top")).alias("best"))


def align_documents(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Alignment measures of every whole text, one row per input row.

    A text's A tokens are those of a space and the text by the byte-level vocabulary, its B tokens those of the text by
    the piece vocabulary, which adds that space; special tokens' strings are plain text. Returns (id, n_a, n_b, n_groups,
    n_links, n_best, count_sum, groups_sha256): tokens, groups between common ends, links (token pairs that share bytes),
    links whose id pair has the B id's highest count in the corpus (ties included), the sum over links of their pair's
    count, and the digest of the groups' ids. A text that is null, empty, or whose bytes either side does not give back
    has no tokens: zeros, and '' for the digest. Ids may be null or repeat; repeated rows count as often as they occur.
    An empty table gives an empty one. A very long text is tokenised in chunks cut at single spaces, where both sides
    begin a token anyway. Other columns are not read. Both paths are files that every executor can open.

    Pair counts are broadcast while they are provably small (they are bounded by the vocabularies, not by the texts),
    and joined by a shuffle otherwise. Measures of texts that occur in a thousandth of all documents are broadcast
    (fewer than a thousand rows), so no key of the last join is hot.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    key = F.when(F.length(text) > 0, F.unhex(F.sha2(text.cast("binary"), 256)))
    once = docs.where(F.length(text) > 0).groupBy(text.alias("text")).agg(F.count("*").alias("copies"))
    once = once.withColumn("key", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    aligned = stored(aligned_texts(once, byte_level, pieces), "aligned")
    counts = stored(pair_counts(aligned, aligner(byte_level, pieces).sizes[1]), "counts")
    links = aligned.select("key", F.explode(F.arrays_zip("codes", "times")).alias("p")).select("key", "p.codes", "p.times")
    scored = links.join(bounded_broadcast(counts), links["codes"] == counts["code"])
    sums = scored.groupBy("key").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                     F.sum(F.col("times") * F.col("total")).alias("count_sum"))
    plain = ["n_a", "n_b", "n_groups", "n_links"]
    measures = stored(aligned.join(sums, "key", "left").select("key", "copies", *plain, "n_best", "count_sum", "groups_sha256"), "measures")
    total = measures.agg(F.sum("copies")).first()[0] or 0
    often = F.col("copies") * HOT > total
    rows = docs.select(ident.alias("id"), key.alias("key"))
    some = stored(rows.where("key IS NOT NULL"), "keys")
    hot = F.broadcast(measures.where(often))
    joined = some.join(hot, "key").unionByName(
        some.join(hot.select("key"), "key", "left_anti").join(measures.where(~often), "key"))
    none = rows.where("key IS NULL").select("id", *[F.lit(0).cast("long").alias(c) for c in [*plain, "n_best", "count_sum"]],
                                            F.lit("").alias("groups_sha256"))
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in [*plain, "n_best", "count_sum"]]
    return joined.select("id", *numbers, "groups_sha256").union(none).withColumnRenamed("id", id_col)
