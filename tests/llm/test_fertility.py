"""Counts against a plain recount, measures against the tokenisers themselves."""
import math
import re
from collections import Counter

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hostlake.llm import fertility as Q

ARGS = (P.path("byte_bpe_50k.tiktoken"), P.PATTERN, P.path("piece_bpe_32k.model"))
SF = "/root/testdata/sf0.001"


def slow(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    inside = {j for i, w in enumerate(windows) if n[w] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(inside))


@pytest.fixture(scope="module")
def meter():
    return Q.Meter(*ARGS)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text("ab \n|", max_size=200), st.text("a \x1c\x85\xa0\n\t", max_size=60)))
def test_base_counts(text):
    assert Q.base_counts(text)[:5] == slow(text)


def test_documents(spark, meter):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in Q.tokeniser_rules(docs, *ARGS).collect()}
    assert len(rows) == docs.count()
    for d in docs.collect():
        r, want = rows[d.doc_id], slow(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        ids = meter.tokens.encode_ordinary(d.text)
        shares = [c / len(ids) for c in Counter(ids).values()]
        assert r.n_tokens == len(ids) and math.isclose(r.token_entropy, -sum(p * math.log2(p) for p in shares), abs_tol=1e-9)
        words = re.findall(r"[^\x20\x09-\x0D]+", d.text)
        pieces = [i for w in words for i in meter.pieces.encode(w)]
        assert math.isclose(r.byte_share, sum(map(meter.pieces.is_byte, pieces)) / max(1, len(pieces)))
        assert r.band == d.lang
        band = Q.LANGUAGES[d.lang]
        inside = (band.chars_per_token[0] <= r.chars_per_token <= band.chars_per_token[1] and r.byte_share <= band.byte_share
                  and r.token_entropy >= max([bits for n, bits in band.entropy if r.n_tokens >= n], default=0))
        assert r.kept == (inside and not r.base_failed)


def test_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    good = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1")
    out = Q.tokeniser_rules(docs, *ARGS).join(good, "doc_id").where("NOT base_failed")
    assert out.where("NOT kept").count() == 0 and out.count() > 200


def test_bands_reject(spark):
    prose = "the house stood on a hill and from the window one could see the river winding down to the sea in the evening "
    rows = [(1, prose, "en"), (2, "\u0d95\u0d9a \u0da7\u0dad \u0db4\u0db6 " * 1 + " ".join(chr(0x16A0 + i) * 3 for i in range(20)), "en"),
            (3, " ".join(f"x{i % 7}q{i % 11}z{i % 13}" for i in range(900)), None), (4, "да и нет слова русские тоже есть тут же они да", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in Q.tokeniser_rules(df, *ARGS).collect()}
    assert out[1].kept and not out[2].kept and not out[2].base_failed and out[2].byte_share > 0.1
    assert out[3].band == "Latin" and out[3].token_entropy < 5.6 and not out[3].kept
    assert out[4].band == "Cyrillic" and out[4].kept


def test_a_language_is_no_script(spark):
    junk = " ".join(f"x{i % 7}q{i % 11}z{i % 13}" for i in range(900))
    df = spark.createDataFrame([(i, junk, lang) for i, lang in enumerate(["", "Han", "Latin", "xx", None])], "doc_id long, text string, lang string")
    out = Q.tokeniser_rules(df, *ARGS).collect()
    assert {(r.band, r.kept) for r in out} == {("Latin", False)} and len(out) == 5
    loose = {r.doc_id: r for r in Q.tokeniser_rules(df, *ARGS, languages={"xx": Q.Band(entropy=())}, scripts={}).collect()}
    assert [(loose[i].band, loose[i].base_failed) for i in range(5)] == [("", loose[0].base_failed)] * 3 + [("xx", loose[0].base_failed), ("", loose[0].base_failed)]


def test_nulls_empty_ties_and_clashing_columns(spark):
    rows = [(1, None, "en", 1), (None, "", None, 2), (2, " \n ", "xx", 3), (2, " \n ", "xx", 3), (3, "a" * 200_000, "en", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int")
    out = Q.tokeniser_rules(df, *ARGS).collect()
    assert len(out) == 5 and all(r.base_failed and not r.kept for r in out)
    assert sorted(r.n_words for r in out) == [0, 0, 0, 0, 1]
    assert Q.tokeniser_rules(df.limit(0), *ARGS, lang_col=None).collect() == []
    assert len(Q.tokeniser_rules(df, *ARGS, lang_col=None).collect()) == 5
