"""Verdicts against a plain loop over all rules."""
import random

from pyspark.sql import functions as F

from hostlake.llm import url_rules as U


def slow(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        tail = rest[end:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(-len(h + p), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    block = {h + p: v for h, p, v in sorted(rules, key=lambda r: r[2])}
    if not fits:
        return host, path, None, default
    rule = min(fits)[1]
    return host, path, rule, block[rule]


def check(spark, urls, rules, parts="7"):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    df = df.withColumns({"host": F.lit("x"), "rule": F.lit("y"), "key": F.lit("z"), "part": F.lit(0)})
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge_urls(df, U.rule_table(spark, rules)).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out == {i: slow(u, rules) for i, u in enumerate(urls)}


def test_random_rules_and_urls(spark):
    rng = random.Random(4)
    labels, steps = ["a", "b", "org", "com", "ab", "é"], ["", "/", "/a", "/a/", "/ab", "/b/1", "/a/b/c", "/é"]

    def host():
        return ".".join(rng.choices(labels, k=rng.randint(1, 4)))
    rules = list({(host(), rng.choice(steps)): rng.choice(["allow", "block"]) for _ in range(60)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [f"{rng.choice(['http', 'HTTPS', 'x'])}://{host().upper() if rng.random() < .2 else host()}"
            f"{rng.choice(steps)}{rng.choice(['', '/', 'x', '?q=/a', '#/a', '1'])}" for _ in range(400)]
    check(spark, urls + urls[:50], rules)
    check(spark, urls[:40], rules, parts="1")


def test_odd_urls(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("", "", "block"), ("a", "", "block")]
    urls = [None, "", "no scheme", "://", "http://", "http://org", "http://org?x=/", "http://org/", "a://b://org/",
            "http://ORG/", "http://sub.example.org/es/", "http://notexample.org/es/", "http://example.org./es/", "http://.org/",
            "http://a#/", "http://a..org/\n/x", "http://É.org/", "http://x.org/" + "p" * 100_000, "http://user@org/", "http://org:80/"]
    check(spark, urls, rules)


def test_no_rules_no_rows_and_contradictions(spark):
    check(spark, ["http://a/b"], [])
    check(spark, [], [("a", "/", "block")])
    check(spark, ["http://a/b", "http://a/b"], [("a", "/b", "allow"), ("a", "/b", "block"), ("a", "/", "allow")])


def test_main_path_is_native(spark):
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    plan = U.judge_urls(df, U.rule_table(spark, [("org", "/", "allow")]))._jdf.queryExecution().toString()
    assert not [x for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop") if x in plan.replace("ArrowEval", "Arrow")]
