"""Fingerprints and components against brute force; the codeword keys against all two-bit errors."""
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hostlake.llm import simhash_golay as S

SF = "/root/testdata/sf0.001/documents.parquet"


def slow_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows, bits=2):
    """rows: (id, text); smallest reachable id by a plain search over all pairs."""
    fps = [slow_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                label[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(d, low.get(root(i), d))
    return sorted(((d, f"{fps[i]:016x}", low.get(root(i))) for i, (d, _) in enumerate(rows)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


def test_golay_code_is_perfect():
    assert len(set(S._ERRORS.tolist())) == 2048 and max(int(e).bit_count() for e in S._ERRORS) == 3


def test_keys_meet_for_every_two_bit_error():
    rng = np.random.default_rng(5)
    fp = int(rng.integers(0, 1 << 63)) | 1 << 63
    near = [fp ^ (1 << a) ^ ((1 << b) if b != a else 0) for a in range(64) for b in range(a, 64)]
    own = set(S.fuzzy_keys(np.array([fp], dtype=np.uint64))[1].tolist())
    rows, keys = S.fuzzy_keys(np.array(near, dtype=np.uint64))
    assert set(rows[np.isin(keys, list(own))].tolist()) == set(range(len(near)))


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet(SF)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(S.near_duplicates(docs)) == slow_components(rows)


@pytest.fixture()
def near_copies():
    base = " ".join(f"w{i}" for i in range(400))
    texts = [base.replace(f"w{i} ", f"x{i} ") for i in range(60)] + [base] * 30
    return [(100 + i, t) for i, t in enumerate(texts)]


def test_hot_bucket_path_gives_the_same(spark, near_copies, monkeypatch):
    df = spark.createDataFrame(near_copies, "doc_id long, text string")
    want = slow_components(near_copies)
    assert len({c for _, _, c in want}) < len({f for _, f, _ in want})
    assert got(S.near_duplicates(df)) == want
    monkeypatch.setattr(S, "PAIRS_UP_TO", 1)
    assert got(S.near_duplicates(df)) == want


def test_one_bit_links(spark, near_copies, monkeypatch):
    df = spark.createDataFrame(near_copies, "doc_id long, text string")
    want = slow_components(near_copies, 1)
    assert got(S.near_duplicates(df, max_bits=1)) == want
    monkeypatch.setattr(S, "PAIRS_UP_TO", 1)
    assert got(S.near_duplicates(df, max_bits=1)) == want


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "One TWO"), (5, "one two"), (None, "one two"), (7, "one two"),
       (4, "One TWO"), (None, "alone here now then"), (9, "a b c d " * 30_000)]


def test_nulls_empty_ties_and_clashing_columns(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string").withColumns({"fp": F.lit(1), "key": F.lit(2), "id": F.lit(3)})
    assert got(S.near_duplicates(df)) == slow_components(ODD)
    assert S.near_duplicates(df.limit(0)).collect() == []


def test_keep_one_each(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string").withColumns({"skey": F.lit(1), "c0": F.lit(2)})
    kept = S.keep_one_each(df)
    assert kept.columns == df.columns
    left = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert left == sorted([(1, None), (4, "One TWO"), (7, "one two"), (None, "alone here now then"), ODD[-1]], key=repr)
    assert S.keep_one_each(df.limit(0)).collect() == []
