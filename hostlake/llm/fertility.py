"""Quality rules from tokenisers: how a public vocabulary takes a text apart.

A text in a language that a vocabulary knows has several characters per token, few characters that fall back to bytes
and varied tokens. Each measure has a rejection band per language, or per script where the language has none.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostlake.llm.common import small_batches

#: Separators of words, symbols that are counted, words of a repeated window.
SEPARATORS, SYMBOLS, WINDOW = " \t\n\x0b\x0c\r", "#*$%&|<>", 5


@dataclass(frozen=True)
class Band:
    """What a text may measure. ``chars_per_token``: (least, most) characters of words per byte-level token;
    ``byte_share``: most of the pieces that are single bytes; ``entropy``: (tokens, bits) steps, the least token entropy
    of texts with that many tokens or more."""

    chars_per_token: tuple[float, float] = (0.2, 12.0)
    byte_share: float = 0.9
    entropy: tuple[tuple[int, float], ...] = ((200, 4.0),)

    def rejects(self, chars_per_token: float, byte_share: float, entropy: float, n_tokens: int) -> bool:
        low, high = self.chars_per_token
        return (not low <= chars_per_token <= high or byte_share > self.byte_share
                or any(n_tokens >= n and entropy < bits for n, bits in self.entropy))


#: Entropy of a text grows with its length towards the language's; prose is above these steps, word lists and strings
#: of symbols mostly below.
_PROSE = ((100, 4.9), (200, 5.4), (400, 5.6))
#: By language code. Natural prose has about 4.5 (English) or 2.5
#: (other Latin) characters a token in the English byte-level vocabulary, invented words about half of that, strings of
#: capitals or symbols less; scripts outside its training mostly take one to three tokens a character.
LANGUAGES = {
    "en": Band((1.75, 9.0), 0.1, _PROSE), "fr": Band((1.5, 8.0), 0.1, _PROSE), "de": Band((1.55, 8.0), 0.1, _PROSE),
    "es": Band((1.4, 8.0), 0.1, _PROSE),
}
#: By script of most letters; '': any other.
SCRIPTS = {
    "Latin": Band((1.3, 9.0), 0.25, _PROSE), "Cyrillic": Band((0.4, 4.0), 0.3), "Greek": Band((0.3, 4.0), 0.5),
    "Arabic": Band((0.3, 3.0), 0.6), "Hebrew": Band((0.3, 3.0), 0.6), "Han": Band((0.2, 2.0), 0.8),
    "Kana": Band((0.2, 2.5), 0.6), "Hangul": Band((0.2, 2.0), 0.8), "": Band(),
}
_SCRIPTS = {"Latin": "Latin", "Cyrillic": "Cyrillic", "Greek": "Greek", "Arabic": "Arabic", "Hebrew": "Hebrew",
            "Han": "Han", "Kana": r"Hiragana}|\p{Katakana", "Hangul": "Hangul"}
_LETTERS = {name: regex.compile(rf"(?:\p{{{script}}})+") for name, script in _SCRIPTS.items()}


def script_of(text: str) -> str:
    """The script of most letters ('' without letters of a listed one; ties: the first listed)."""
    if text.isascii():
        return "Latin" if any(c.isalpha() for c in text) else ""
    counts = {name: sum(map(len, found.findall(text))) for name, found in _LETTERS.items()}
    best = max(counts, key=counts.get)
    return best if counts[best] else ""


def base_counts(text: str) -> tuple[int, int, int, int, int, list[bytes]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the words."""
    words = text.encode().split()  # bytes.split() knows just the six separators
    chars = len(text) - sum(map(text.count, SEPARATORS))
    lines = [x for x in text.split("\n") if x.strip(SEPARATORS)]
    repeated = 0
    windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    if len(set(windows)) < len(windows):
        twice = {w for w, n in Counter(windows).items() if n > 1}
        upto = 0  # words before this are counted
        for i, w in enumerate(windows):
            if w in twice:
                repeated += i + WINDOW - max(i, upto)
                upto = i + WINDOW
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, words


class Meter:
    """Both vocabularies, and the pieces of recent words (two generations of ``keep`` words at most)."""

    def __init__(self, ranks: str, pattern: str, pieces: str, keep: int = 200_000):
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.is_byte = [self.pieces.is_byte(i) for i in range(self.pieces.vocab_size())]
        self.keep, self.new, self.old = keep, {}, {}

    def of_word(self, word: bytes) -> tuple[int, int]:
        """(pieces, byte pieces) of a word by itself."""
        found = self.new.get(word)
        if found is None:
            found = self.old.get(word)
            if found is None:
                ids = self.pieces.encode(word.decode(), num_threads=1)
                found = len(ids), sum(map(self.is_byte.__getitem__, ids))
            if len(word) <= 64:
                if len(self.new) >= self.keep:
                    self.new, self.old = {}, self.new
                self.new[word] = found
        return found

    def measure(self, text: str, words: list[bytes], chars: int) -> tuple[int, float, float, float]:
        """n_tokens, characters of words per token, byte-fallback share, token entropy in bits; zeros without words."""
        if not words:
            return 0, 0.0, 0.0, 0.0
        ids = np.asarray(self.tokens.encode_ordinary(text))
        share = np.unique(ids, return_counts=True)[1] / len(ids)
        recent = self.new  # (a word that is met there needs no call; where ``of_word`` begins a new one, it is still right)
        found = [recent.get(w) or self.of_word(w) for w in words]
        pieces, single = map(sum, zip(*found, strict=True))
        return len(ids), chars / len(ids), single / max(1, pieces), float(max(0.0, -(share * np.log2(share)).sum()))


_METERS: dict[tuple, Meter] = {}


def tokeniser_rules(docs: DataFrame, ranks: str, pattern: str, pieces: str, languages: dict[str, Band] | None = None,
                    scripts: dict[str, Band] | None = None, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str | None = "lang") -> DataFrame:
    """Counts, measures and verdict of every whole text, one row per input row.

    Returns (id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_tokens,
    chars_per_token, byte_share, token_entropy, band). base_failed: fewer than 10 words, or over a fifth of the words in
    five-word windows that occur twice. kept: not base_failed and inside the band of the row's language (``languages``); a null
    or unlisted language (an empty one, or a script's name, too), or ``lang_col`` None, takes the band of the script of most
    letters (``scripts``, '' for others). A null text has no words. An empty table gives an empty one. A very long text
    is measured whole, in one task, in time about linear in its length.
    ``ranks`` (byte-level vocabulary, for tokens) and ``pieces`` (piece vocabulary with byte fallback) are paths that
    executors can open. Ids may be null or repeat; other columns are not read. Nothing is shuffled.
    """
    languages, scripts = LANGUAGES if languages is None else languages, SCRIPTS if scripts is None else scripts
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_tokens",
             "chars_per_token", "byte_share", "token_entropy", "band"]
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] + [pa.float64()] * 3 + [pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (ranks, pattern, pieces)
        meter = _METERS.get(key) or _METERS.setdefault(key, Meter(*key))
        for batch in batches:
            rows = []
            for text, lang in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                text = text or ""
                *base, words = base_counts(text)
                failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
                n, fertility, single, entropy = meter.measure(text, words, base[1])
                band, name = languages.get(lang), lang
                if band is None:
                    name = script_of(text)
                    name = name if name in scripts else ""
                    band = scripts.get(name, Band())
                kept = not failed and not band.rejects(fertility, single, entropy, n)
                rows.append((*base, failed, kept, n, fertility, single, entropy, name))
            cols = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[id_col, *names])

    lang = F.lit(None).cast("string") if lang_col is None else F.col(lang_col)
    schema = (f"`{id_col}` {kind}, " + ", ".join(f"{n} long" for n in names[:5]) + ", base_failed boolean, kept boolean, "
              "n_tokens long, chars_per_token double, byte_share double, token_entropy double, band string")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), lang.alias("lang")).mapInArrow(run, schema)
