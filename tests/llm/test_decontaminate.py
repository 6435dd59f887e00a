"""Occurrences of benchmark windows against a comparison at every place."""
import hashlib
import random
import re
from string import ascii_lowercase, ascii_uppercase

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hostlake.llm import decontaminate as D


def slow_words(text):
    lower = (text or "").translate(str.maketrans(ascii_uppercase, ascii_lowercase))
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def brute(docs, items):
    windows = {}
    for name, text in items:
        w = slow_words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).add(name)
    out = []
    for d, text in docs:
        w = slow_words(text)
        hit, found = set(), set()
        for i in range(len(w)):
            for m in range(1, 11):
                if i + m <= len(w) and (names := windows.get(tuple(w[i:i + m]))):
                    hit |= set(range(i, i + m))
                    found |= names
        found = sorted(str(x) for x in found - {None})
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["Ab", "cd", "e", "ß", "日本", "42", "İx", "No"]
    items = [(i, rng.choice([" ", "-", "\n"]).join(rng.choices(vocabulary, k=rng.choice([0, 3, 5, 9, 10, 11, 25])))) for i in range(40)]
    items += [(100, None), (101, "--"), (None, items[3][1]), (None, "solo"), (102, items[5][1]), (5, items[5][1])]
    docs = []
    for d in range(60):
        words = rng.choices(vocabulary, k=rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            w = (rng.choice(items)[1] or "").split()
            words[rng.randint(0, len(words)):0] = w[rng.randint(0, 2):]
        docs.append((d, rng.choice([" ", "; ", "\x00"]).join(words)))
    docs += [(None, None), (None, docs[4][1]), (7, docs[7][1]), (200, ""), (201, "."), (202, "solo"), (203, docs[9][1].upper()),
             (204, " ".join(vocabulary * 3000))]
    return docs, items


@pytest.mark.parametrize("pass_bytes", [1 << 24, 900])
def test_against_brute_force(spark, monkeypatch, pass_bytes):
    monkeypatch.setattr(D, "PASS_BYTES", pass_bytes)
    monkeypatch.setattr(D, "PIECE_WORDS", 4)
    docs, items = corpus(pass_bytes)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"n_words": F.lit(1), "items": F.lit(2), "key": F.lit(3)})
    bench = spark.createDataFrame(items, "item_id long, text string").withColumns({"words": F.lit(1), "doc_id": F.lit(2)})
    got = D.contaminated_documents(df.repartition(3), bench).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == brute(docs, items)
    assert sum(r.contaminated for r in got) > 20 and not all(r.contaminated for r in got)
    for r in got:
        assert sum(x.stop - x.start for x in r.spans) == r.n_hit and len(r.items) == r.n_items
        assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "b")], "item_id long, text string")
    assert D.contaminated_documents(docs.limit(0), items).collect() == []
    rows = D.contaminated_documents(docs, items.limit(0)).collect()
    assert sorted((r.doc_id, r.n_words, r.contaminated) for r in rows) == [(1, 2, False), (2, 0, False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=14), max_size=6), st.lists(st.sampled_from("abcd"), max_size=60))
def test_tables(items, words):
    (row,) = brute([(1, " ".join(words))], [(i, " ".join(w)) for i, w in enumerate(items)])
    n, spans, found = D.Tables([(str(i), w) for i, w in enumerate(items)]).search(" ".join(words))
    assert (n, sum(b - a for a, b in spans), len(found)) == row[1:4]


def test_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(D, "PART_BYTES", 50)
    rng = random.Random(3)
    words = [f"w{rng.randrange(40)}" for _ in range(3000)]
    items = [(str(i), words[at:at + 10 + i % 3]) for i, at in enumerate(range(100, 2900, 170))] + [("one", ["w7"]), ("three", words[40:43])]
    tables = D.Tables(items)
    text = ", ".join(words)
    got = tables.search(text)
    monkeypatch.setattr(D, "PART_BYTES", 1 << 20)
    assert got == tables.search(text) and len(got[2]) == len(items)
    assert got[0] == len(words)
    monkeypatch.setattr(D, "PART_BYTES", 1)
    assert list(D.parts_of("a a a", 1))[-1] == (1, [b"a", b"a"])


def test_most_places_are_skipped():
    table = D.SameLength(10)
    table.add(tuple(f"x{i}".encode() for i in range(10)), 0)
    seen = []

    class Counting(dict):
        def get(self, key, default=None):
            seen.append(key)
            return super().get(key, default)
    table.shift = Counting(table.shift)
    assert list(table.search([b"y"] * 900 + [f"x{i}".encode() for i in range(10)])) == [(900, 0)]
    assert len(seen) < 110
