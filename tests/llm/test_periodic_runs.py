"""Runs of words against a comparison of every place with every distance."""
import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hostlake.llm import periodic_runs as P
from hostlake.llm import queries as Q

SF = "/root/testdata/sf0.001"


def brute(words):
    """(start, length, smallest period) of all runs."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, m, q) for (s, m), q in found.items())


def expected(d, text, plant=False):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    if plant and d is not None and n:
        h = zlib.crc32(str(d).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in sorted(runs, key=lambda r: (r[0], r[2])))
    return (d, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=4))
def test_runs_of_few_words(texts):
    assert P.find_runs(texts) == [brute(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=9), st.integers(3, 12), st.lists(st.integers(0, 30), max_size=8),
       st.integers(1, 4), st.integers(4, 6))
def test_runs_inside_runs(base, times, rest, again, outer):
    text = (base * times + rest) * outer + base * again
    assert P.find_runs([text, text[::-1], []]) == [brute(text), brute(text[::-1]), []]


def test_long_uniform_text_takes_linear_work():
    n = 60_000
    assert P.find_runs([[1] * n, [1, 2] * n, [5] + [1, 2, 3] * n]) == [[(0, n, 1)], [(0, 2 * n, 2)], [(1, 3 * n, 3)]]


def test_fibonacci_word():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    assert P.find_runs([b, b + b + b + b]) == [brute(b), brute(b * 4)]


def test_portions(monkeypatch):
    monkeypatch.setattr(P, "BATCH_BYTES", 10)
    assert list(P._portions(["a" * 4, "b" * 4, "c" * 4, "", "d" * 40, "e"])) == [(0, 2), (2, 4), (4, 5), (5, 6)]
    assert list(P._portions([])) == [(0, 0)]


@pytest.fixture()
def odd():
    rng = random.Random(5)
    rows = [(None, None), (None, "a b " * 9), (1, ""), (2, " \n\t"), (3, "x " * 5), (4, "x " * 6), (4, "x " * 6), (5, None),
            (6, "é b é b é b é b"), (7, "lorem ipsum dolor " * 20_000)]
    for d in range(100, 140):
        rows.append((d, rng.choice([" ", "\n", "\x0b "]).join(rng.choices("abcd", k=rng.randint(0, 90)))))
    return rows


def test_against_brute_force(spark, odd):
    df = spark.createDataFrame(odd, "doc_id long, text string").withColumns({"runs": F.lit(1), "n_runs": F.lit(2), "start": F.lit(3)})
    got = P.periodic_runs(df.repartition(3)).collect()
    small = [r for r in odd if r[0] != 7]
    assert sorted((tuple(r)[:8] for r in got if r.doc_id != 7), key=repr) == sorted((expected(*r) for r in small), key=repr)
    (long,) = [r for r in got if r.doc_id == 7]
    assert [tuple(x) for x in long.runs] == [(0, 60_000, 3)] and long.kept_text == "lorem ipsum dolor"
    assert P.periodic_runs(df.limit(0)).collect() == []


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = Q.op11_periodic_runs(spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted(tuple(r) for r in got.collect())
    assert got == sorted(expected(d, t, plant=True) for d, t in rows)
    assert sum(r[1] for r in got) > 10


def test_planted_periods(spark):
    rows = [(d, " ".join(map(str, range(d % 37)))) for d in range(400)] + [(None, "a b"), (17, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = P.periodic_runs(P.with_planted_periods(df), texts=False)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((expected(*r, plant=True) for r in rows), key=repr)
