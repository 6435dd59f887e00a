"""Components against a plain search."""
import random

from hostlake.llm import components as C


def slow(edges):
    near = {}
    for u, v in edges:
        near.setdefault(u, set()).add(v)
        near.setdefault(v, set()).add(u)
    out = {}
    for n in sorted(near):
        todo = [n] if n not in out else []
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = n
                todo += near[x]
    return {k: v for k, v in out.items() if len(near[k] - {k}) > 0}


def check(spark, edges, parts=4):
    df = spark.createDataFrame(edges, "u long, v long").repartition(parts)
    rows = C.connected_components(df).collect()
    assert {r.node: r.component for r in rows} == slow(edges) and len(rows) == len({r.node for r in rows})


def test_random_chains_and_stars(spark, monkeypatch):
    rng = random.Random(6)
    edges = [(rng.randrange(-99, 300), rng.randrange(-99, 300)) for _ in range(150)]
    chain = [(1000 + i, 1001 + i) for i in range(200)]
    star = [(5000, 4000 + i) for i in range(300)]
    rng.shuffle(chain)
    check(spark, edges + chain + star + edges[:20] + [(7, 7), (-(1 << 63), (1 << 63) - 1)])
    monkeypatch.setattr(C, "_AT_ONCE", 3)
    check(spark, edges + chain)


def test_empty(spark):
    assert C.connected_components(spark.createDataFrame([], "u long, v long")).collect() == []
    assert C.connected_components(spark.createDataFrame([(3, 3)], "u long, v long")).collect() == []
