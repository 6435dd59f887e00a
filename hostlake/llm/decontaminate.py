"""Benchmark decontamination by Wu-Manber search of many word strings.

The strings are the windows of the benchmark's items: 10 consecutive words, or all words of an item that has fewer.
Strings of one length are searched together. A block is the last two words under the window (one word for strings of one
word). The shift table says how far the window may move on, given its last block: the distance from the block's last
place in any string to the string's end, and past the whole block where no string has it, so most texts are looked at
once in nine words. At shift 0 the block (the suffix) selects a bucket of strings, in it the first block (the prefix) the
strings to test, and comparison word by word confirms an occurrence.

The strings are a stated query set: they are searched in portions of bounded size, one pass over the documents for each.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostlake.llm.common import row_key, small_batches, stored

#: Words of a window, words of a block.
WINDOW, BLOCK = 10, 2
#: About so many bytes of item words are searched in one pass, held by the driver and by each Python worker.
PASS_BYTES = 16 << 20
#: An item longer than this is split into pieces of so many words, each with the ``WINDOW - 1`` words behind it.
PIECE_WORDS = 2000
#: A longer text is searched in parts of about so many bytes.
PART_BYTES = 4 << 20
#: Lower-cased letters, digits and all bytes of other characters are words; anything else separates them.
_WORDS = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return text.encode().translate(_WORDS).split()


def parts_of(text: str, carried: int) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first word, words) of the text's parts; each begins with the last ``carried`` words before it."""
    raw = text.encode().translate(_WORDS)
    start = at = 0
    tail: list[bytes] = []
    while start < len(raw):
        stop = len(raw) if len(raw) - start <= PART_BYTES else raw.find(b" ", start + PART_BYTES)
        stop = len(raw) if stop < 0 else stop
        words = tail + raw[start:stop].split()
        yield at, words
        tail = words[len(words) - min(carried, len(words)):]
        at += len(words) - len(tail)
        start = stop


class SameLength:
    """The tables for strings of one length."""

    def __init__(self, length: int):
        self.length, self.block = length, min(BLOCK, length)
        self.full = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list[tuple[tuple, int]]]] = {}

    def add(self, string: tuple[bytes, ...], number: int) -> None:
        for end in range(self.block, self.length + 1):
            key, move = string[end - self.block:end], self.length - end
            if move < self.shift.get(key, self.full):
                self.shift[key] = move
        self.buckets.setdefault(string[-self.block:], {}).setdefault(string[:self.block], []).append((string, number))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(first word, number of the string) of each occurrence."""
        length, block, full, get = self.length, self.block, self.full, self.shift.get
        end, n = length, len(words)
        pair = block == 2
        while end <= n:
            key = (words[end - 2], words[end - 1]) if pair else (words[end - 1],)
            move = get(key, full)
            if move:
                end += move
                continue
            start = end - length
            for string, number in self.buckets[key].get(tuple(words[start:start + block]), ()):
                if all(a == b for a, b in zip(string, words[start:end], strict=True)):
                    yield start, number
            end += 1


class Tables:
    """Search tables for items (id or None, words)."""

    def __init__(self, items: list[tuple[str | None, list[str]]]):
        owners: dict[tuple, set] = {}
        for name, words in items:
            coded = tuple(w.encode() for w in words)
            for i in range(max(1, len(coded) - WINDOW + 1) if coded else 0):
                owners.setdefault(coded[i:i + WINDOW], set()).add(name)
        self.lengths: dict[int, SameLength] = {}
        sets: dict[frozenset, int] = {}  # strings with the same owners share a set
        for string, names in owners.items():
            number = sets.setdefault(frozenset(names - {None}), len(sets))
            self.lengths.setdefault(len(string), SameLength(len(string))).add(string, number)
        self.owners = list(sets)
        self.longest = max(self.lengths, default=1)

    def search(self, text: str) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, the covered stretches [start, stop) in order, and the items found, sorted."""
        n, spans, sets = 0, [], set()
        for at, words in parts_of(text, self.longest - 1):
            n = at + len(words)
            for length, table in self.lengths.items():
                for start, number in table.search(words):
                    spans.append((at + start, at + start + length))
                    sets.add(number)
        merged: list[tuple[int, int]] = []
        for start, stop in sorted(spans):
            if merged and start <= merged[-1][1]:
                merged[-1] = merged[-1][0], max(stop, merged[-1][1])
            else:
                merged.append((start, stop))
        return n, merged, sorted(set().union(*(self.owners[k] for k in sets)))


_TABLES: dict[str, Tables] = {}


def _searched(docs: DataFrame, items: list[tuple[str | None, list[str]]], hits_only: bool) -> DataFrame:
    """(id, key, n_words, spans, items) of documents (id, key, text)."""
    held, name = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _TABLES:
            _TABLES.clear()  # a worker has one portion's tables at a time
            _TABLES[name] = Tables(held.value)
        tables = _TABLES[name]
        for batch in batches:
            take, n, spans, found = [], [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                size, covered, names = tables.search(text or "")
                if covered or not hits_only:
                    take.append(i)
                    n.append(size)
                    spans.append([{"start": a, "stop": b} for a, b in covered])
                    found.append(names)
            rows = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(n, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                 pa.array(found, pa.list_(pa.string()))], names=["id", "key", "n_words", "spans", "items"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, key long, n_words long, spans array<struct<start:long,stop:long>>, items array<string>")


def item_pieces(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, words) with every window of an item in one piece at least; items without words have none."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = F.regexp_extract_all(F.translate(F.col(f"`{text_col}`"), upper, lower), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))
    rows = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("item"), words.alias("words")).where("size(words) > 0")
    start = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (WINDOW - 1)), F.lit(PIECE_WORDS))
    rows = rows.select("item", "words", F.explode(start).alias("start"))
    return rows.select("item", F.slice("words", F.col("start"), F.lit(PIECE_WORDS + WINDOW - 1)).alias("words"))


def contaminated_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           item_col: str = "item_id", item_text_col: str = "text", details: bool = True) -> DataFrame:
    """Which words of every whole text lie in an occurrence of a benchmark window, one row per input row.

    Returns (id, n_words, n_hit, n_items, items_sha256 of the item ids sorted as strings and joined by commas,
    contaminated, and with ``details`` spans - the covered stretches [start, stop) of words - and items). A null or empty
    text has no words. Items without words find nothing; an item with a null id covers words but is not listed; repeated
    items count once. Ids may be null or repeat, and equal rows get equal results. An empty table of documents gives an
    empty one, an empty benchmark finds nothing. A very long text is searched in parts. Other columns are not read.

    The items are searched in portions of ``PASS_BYTES`` by their words. One portion needs no shuffle. With more, each
    portion's finds are written as a table, and gathered by id and a hash of the text.
    """
    small_batches(docs.sparkSession)
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    narrow = docs.select(ident.alias("id"), row_key(ident, text).alias("key"), text.alias("text"))
    pieces = item_pieces(benchmark, item_col, item_text_col)
    size = F.coalesce(F.sum(F.length(F.array_join("words", " ")) + F.size("words")), F.lit(0))
    portions = 1 + int(pieces.agg(size).first()[0]) // PASS_BYTES

    def portion(k: int) -> list[tuple[str | None, list[str]]]:
        of = pieces.where(F.pmod(F.xxhash64("item", "words"), F.lit(portions)) == k)
        return [(r.item, r.words) for r in of.collect()]  # about PASS_BYTES

    if portions == 1:
        found = _searched(narrow, portion(0), hits_only=False)
    else:
        hits = None
        for k in range(portions):
            part = stored(_searched(narrow, portion(k), hits_only=True).dropDuplicates(["id", "key"]), "found")
            hits = part if hits is None else hits.union(part)
        both = hits.groupBy("id", "key").agg(
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        every = _searched(narrow, [], hits_only=False).select(F.col("id").alias("own_id"), F.col("key").alias("own_key"), "n_words")
        same = every["own_id"].eqNullSafe(both["id"]) & (every["own_key"] == both["key"])
        none = F.array().cast("array<struct<start:long,stop:long>>")
        found = every.join(both, same, "left").select(
            F.col("own_id").alias("id"), "n_words", F.coalesce("spans", none).alias("spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"))
        # stretches of different portions may overlap or touch
        found = found.withColumn("spans", F.expr("""aggregate(array_sort(spans), cast(array() AS array<struct<start:bigint,stop:bigint>>),
            (m, x) -> IF(size(m) > 0 AND x.start <= m[size(m) - 1].stop,
                concat(slice(m, 1, size(m) - 1), array(struct(m[size(m) - 1].start AS start, greatest(m[size(m) - 1].stop, x.stop) AS stop))),
                concat(m, array(x))))"""))
    n_hit = F.expr("aggregate(spans, 0L, (n, x) -> n + x.stop - x.start)")
    more = ["spans", "items"] if details else []
    return found.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"), *more)
