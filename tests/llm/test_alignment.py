"""Alignment of two tokenizers against a comparison of all token pairs."""
import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hostlake.llm import alignment as A
from hostlake.llm import queries as Q

SF = "/root/testdata/sf0.001"
PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    t = Tokenizer.from_file(PATHS[0])
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def spans(text, libraries):
    """Byte stretches (start, stop, id) of both sides, from the libraries' own offsets and pieces."""
    t, sp = libraries
    raw = (" " + text).encode()
    found = t.encode(" " + text, add_special_tokens=False)
    a, at = [], 0
    table = {c: b for c, b in A.byte_symbols().items()}
    for i, token in zip(found.ids, found.tokens, strict=True):
        own = bytes(table[c] for c in token)
        a.append((at, at + len(own), i, own))
        at += len(own)
    b, at = [], 0
    for i in sp.encode(text):
        p = sp.id_to_piece(i)
        own = bytes([int(p[3:-1], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()
        b.append((at, at + len(own), i, own))
        at += len(own)
    if not text or b"".join(x[3] for x in a) != raw or b"".join(x[3] for x in b) != raw:
        return [], []
    return a, b


def brute(rows, libraries):
    each, count = {}, Counter()
    for d, text in rows:
        if text not in each:
            a, b = spans(text or "", libraries)
            links = [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]] if len(a) * len(b) < 4_000_000 else None
            each[text] = a, b, links
        count.update(each[text][2])
    top = defaultdict(int)
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    out = []
    for d, text in rows:
        a, b, links = each[text]
        ends = sorted({x[1] for x in a} & {x[1] for x in b})
        groups, low = [], 0
        for e in ends:
            groups.append(",".join(str(x[2]) for x in a if low <= x[0] < e) + "|" + ",".join(str(x[2]) for x in b if low <= x[0] < e))
            low = e
        out.append((d, len(a), len(b), len(ends), len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    return sorted(out, key=repr)


def odd_rows():
    rng = random.Random(1)
    parts = ["the", "Thesen", "日本語", "naïve", "🙂🙂", "<|endoftext|>", "<s>", "don't", "  ", "\n\n", "\t", "x" * 30, "1234", " ", "é́", "\x00", "​", "¿"]
    rows = [(d, rng.choice([" ", "", "  "]).join(rng.choices(parts, k=rng.randint(1, 25)))) for d in range(60)]
    rows += [(1, rows[1][1]), (None, rows[2][1]), (None, None), (70, None), (71, ""), (72, " "), (73, "a ▁ b"), (74, "▁"), (75, "a")]
    return rows + [(100 + k, rows[5][1]) for k in range(30)]


def test_against_all_pairs(spark, libraries, monkeypatch):
    rows = odd_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit(1), "copies": F.lit(2), "n_a": F.lit(3)})
    want = brute(rows, libraries)
    got = A.align_documents(df.repartition(3), *PATHS)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert sum(r[1] == 0 for r in want) >= 5 and sum(r[3] < r[2] for r in want) > 20
    monkeypatch.setattr(A, "HOT", 2)
    monkeypatch.setattr("hostlake.session.DEFAULT_BROADCAST_ROWS", 1)
    again = A.align_documents(df, *PATHS)
    assert sorted(map(tuple, again.collect()), key=repr) == want


def test_query_against_all_pairs(spark, libraries):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    short = [r for r in rows if len(r[1] or "") < 1500]
    df = spark.createDataFrame(short, "doc_id long, text string")
    assert sorted(map(tuple, A.align_documents(df, *PATHS).collect()), key=repr) == brute(short, libraries)
    full = Q.op12_token_alignment(spark, SF)
    assert full.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(r.doc_id for r in full.collect()) == sorted(r[0] for r in rows)


def test_chunks_give_the_tokens_of_the_whole(libraries, monkeypatch):
    own = A.aligner(*PATHS)
    assert own.chunked
    texts = [" ".join(t for _, t in odd_rows() if t and "▁" not in t), "a ▁ " + "b c " * 50, "word " * 40 + "end", "nospace" * 60]
    whole = [tuple(map(str, x)) for x in own.texts(texts)]
    monkeypatch.setattr(A, "CHUNK", 7)
    assert len(own.chunks(texts[0])) > 20
    assert [tuple(map(str, x)) for x in own.texts(texts)] == whole
    monkeypatch.setattr(A, "AT_ONCE", 20)
    assert [tuple(map(str, x)) for x in own.texts(texts)] == whole
    assert list(own.texts([])) == []


def test_both_libraries_give_the_same_tokens(libraries):
    rng = random.Random(8)
    own, t = A.aligner(*PATHS), libraries[0]
    assert A.PATTERN == P.PATTERN
    low = [chr(c) for c in range(0x250)]
    words = ["they're", "don't", "  ", "12345", "\n\n ", "é", "ß", "\x85", "\xa0", "<|endoftext|>", "ǅ", "²½", "\u00ad"]
    for _ in range(300):
        text = "".join(rng.choices(words + low, k=rng.randint(1, 60)))
        assert own.plain.encode_ordinary(text) == t.encode(text, add_special_tokens=False).ids


def test_empty_table(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert A.align_documents(df.limit(0), *PATHS).collect() == []
    assert A.align_documents(df.where("text IS NULL"), *PATHS).collect() == [(2, 0, 0, 0, 0, 0, 0, "")]


def test_very_long_text(spark, libraries):
    text = "lorem ipsum " * 60_000
    df = spark.createDataFrame([(1, text), (2, "lorem ipsum")], "doc_id long, text string")
    rows = {r.doc_id: r for r in A.align_documents(df, *PATHS).collect()}
    t, sp = libraries
    assert rows[1].n_a == len(t.encode(" " + text).ids) and rows[1].n_b == len(sp.encode(text))
