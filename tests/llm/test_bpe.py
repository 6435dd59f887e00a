"""Token ids against the tiktoken library, and exact round trips."""
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from hostlake.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.Vocabulary.load(PATH).ranks, special_tokens={})


def test_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {}
    for r in docs.collect():
        ids = library.encode_ordinary(r.text)
        want[r.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256(r.text.encode()).hexdigest(), ids)
    encoded = bpe.encode_documents(docs, PATH, P.PATTERN)
    assert {r[0]: tuple(r[1:]) for r in encoded.collect()} == want
    back = {r.doc_id: bytes(r.decoded).decode() for r in bpe.decode_documents(encoded, PATH).collect()}
    assert back == {r.doc_id: r.text for r in docs.collect()}


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(), st.text("ab "), st.text("the rin", min_size=20)))
def test_any_text(library, text):
    enc = bpe.encoder(PATH, P.PATTERN)
    (ids,) = enc.batch([text])
    assert ids == " ".join(map(str, library.encode_ordinary(text)))
    assert enc.decode(ids) == text.encode()


def test_very_long_pretokens(library):
    rng = random.Random(3)
    texts = ["a" * 50_000, "ab" * 20_000, "".join(rng.choices("ethrnlaio", k=200_000)), " " * 9_000 + "x", "é" * 9_000]
    for text, ids in zip(texts, bpe.encoder(PATH, P.PATTERN).batch(texts), strict=True):
        assert ids == " ".join(map(str, library.encode_ordinary(text)))


def test_cache_generations_change_nothing(library):
    enc = bpe.Encoder(bpe.Vocabulary.load(PATH), P.PATTERN, keep=3, longest=5)
    for text in ["one two three four five", "five six one", "extraordinarily two", "one five"] * 2:
        assert list(enc.batch([text])) == [" ".join(map(str, library.encode_ordinary(text)))]


def test_nulls_empty_ties_and_clashing_columns(spark):
    rows = [(1, None, 5), (None, "a b", 6), (2, "", 7), (2, "", 7), (3, "<|endoftext|>", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = bpe.encode_documents(df, PATH, P.PATTERN)
    none = hashlib.sha256(b"").hexdigest()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in out.collect())[:4] == [(0, 2), (1, 0), (2, 0), (2, 0)]
    assert {r.ids_sha256 for r in out.collect() if r.n_tokens == 0} == {none}
    assert [r.n_tokens > 1 for r in out.where("doc_id = 3").collect()] == [True]
    assert bpe.encode_documents(df.limit(0), PATH, P.PATTERN).collect() == []


def test_rank_queue_order():
    q = bpe.RankQueue(50_000)
    for rank, p in [(49_999, 1), (70, 9), (70, 4), (4_096, 2), (0, 3)]:
        q.push(rank, p)
    seen = []
    while (r := q.first()) >= 0:
        seen.append((r, q.take(r)))
    assert seen == [(0, [3]), (70, [4, 9]), (4_096, [2]), (49_999, [1])]
