"""Removal of repeats against a plain brute force over all windows."""
import hashlib
import random

from pyspark.sql import functions as F

from hostlake.llm import repeats


def brute(rows, length):
    low, out = {}, []
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - length + 1):
            k = tuple(w[i:i + length])
            if d is not None:
                low[k] = min(d, low.get(k, d))
    for d, w in split:
        gone = set()
        for i in range(len(w) - length + 1):
            if d is not None and low[tuple(w[i:i + length])] < d:
                gone |= set(range(i, i + length))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text").collect()), key=repr)


def planted(seed, n=60, length=12, gram=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["é", "ä b"]
    passages = [rng.choices(vocabulary, k=rng.randint(length - 2, 3 * length)) for _ in range(5)]
    rows = []
    for d in range(n):
        words = rng.choices(vocabulary, k=rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 4)
            at = rng.randint(0, len(words))
            words[at:at] = p[a:len(p) - rng.randint(0, 4)]
        rows.append((d, rng.choice([" ", "\n", " \t"]).join(words)))
    rows += [(d + 1000, t) for d, t in rows[:7]] + [(-5, rows[3][1]), (8, rows[9][1])]
    rows += [(2000, "x " * 60), (2001, "x " * 61), (2002, "a b " * 40), (None, rows[4][1]), (None, None), (2003, ""), (2004, None)]
    return rows


def test_against_brute_force(spark):
    for seed in (1, 2, 3):
        rows = planted(seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"spans": F.lit(1), "key": F.lit(2)})
        assert got(repeats.remove_repeats(df.repartition(5), length=12, gram=3)) == brute(rows, 12)


def test_production_length(spark):
    rows = planted(9, length=55)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(repeats.remove_repeats(df)) == brute(rows, 50)


def test_repeats_are_maximal_runs(spark):
    base = " ".join(f"w{i}" for i in range(80))
    df = spark.createDataFrame([(1, base), (2, "a b " + base + " c")], "doc_id long, text string")
    rows = {r.doc_id: r for r in repeats.remove_repeats(df).collect()}
    assert [tuple(x) for x in rows[2].repeats] == [(2, 82)] and rows[2].kept_text == "a b c" and rows[1].repeats == []


def test_empty_table_and_repeated_rows(spark):
    base = " ".join(f"w{i}" for i in range(80))
    df = spark.createDataFrame([(1, base), (1, base), (0, "short")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed) for r in repeats.remove_repeats(df).collect()) == [(0, 0), (1, 0), (1, 0)]
    assert repeats.remove_repeats(df.limit(0)).collect() == []


def test_no_anchor_below_length():
    assert all(len(x) == 0 for x in repeats.anchors([b"a"] * 49, 50, 10))
    assert len(repeats.anchors([b"a"] * 50, 50, 10)[0]) == 1
