"""URL rules: strangers under one hash prefix, many rules, ties, and rows without a host."""

import re

from tessera.llm import op4_urls

CASES = {
    "http://a.b.example.org/es/x": ("example.org/es/", "block"),
    "http://example.org/fr/x": ("org/", "allow"),
    "http://EXAMPLE.org": (None, "allow"),
    "http://x.com/de/1": ("com/de/", "block"),
    "nothing": (None, "allow"),
    "": (None, "allow"),
    None: (None, "allow"),
}


def judged(spark, rules, urls, **how):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, _host string")
    rows = op4_urls.filter_urls(df.repartition(3), rules, **how).collect()
    assert len(rows) == len(urls)
    return [(r["_rule"], r["_verdict"]) for r in sorted(rows, key=lambda r: r["page_id"])]


def test_strangers_of_a_prefix(spark):
    """With a prefix of no letters every expression meets every rule; the digests tell them apart."""
    for prefix in (0, 1, 8):
        for most in (0, op4_urls.BROADCAST_RULES):
            assert judged(spark, op4_urls.RULES, CASES, prefix=prefix, broadcast_rules=most) == list(CASES.values())


def test_ties_and_repeated_rules(spark):
    rules = [("allow", "a.com/x"), ("block", "a.com/x"), ("allow", "b.com/xy"), ("allow", "com/xyzw/"), ("block", "a.com/x"), ("allow", None), ("block", "nopath"), ("block", "/nohost")]
    assert judged(spark, rules, ["http://a.com/x1", "http://b.com/xyzw/", "http://c.org/"]) == [("a.com/x", "block"), ("com/xyzw/", "allow"), (None, "allow")]


def test_rules_as_a_table(spark):
    rules = spark.createDataFrame([("block", f"h{i}.net/p{i}/") for i in range(500)], "verdict string, rule string")
    urls = [f"http://w.h{i}.net/p{i}/q" for i in range(0, 500, 7)] + ["http://h1.net/p2/"]
    for most in (10, 1000):
        got = judged(spark, rules, urls, broadcast_rules=most)
        assert got == [(f"h{i}.net/p{i}/", "block") for i in range(0, 500, 7)] + [(None, "allow")]


def test_one_join_key(spark):
    """The join is on the prefix alone; digests are compared behind it."""
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    plan = op4_urls.filter_urls(df, broadcast_rules=0)._jdf.queryExecution().sparkPlan().toString()
    assert re.search(r"(SortMergeJoin|HashJoin) \[_seek#\d+\], \[_short#\d+\], Inner", plan)
