import re

from closebook.llm import url_filter as u
from closebook.llm.queries import URL_RULES

URLS = ["http://A.Example.ORG/es/x?q=1#f", "https://example.org", "x", "", None, "http://b.com/fr/", "ftp://u@c.com:80/de/1#/fr/",
        "http://notexample.org/es/", "://h/p", "http://example.org/en/12", "http://a?b/c", "a://b://c/d", "http://com/fr/x",
        "HTTP://X.NET/\nq/1?z"]


def plain(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = re.search(r"[/?#]", rest)
        host, rest = (rest[: cut.start()], rest[cut.start() :]) if cut else (rest, "")
        path = re.split(r"[?#]", rest, maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(i, x, "old") for i, x in enumerate(URLS)], "page_id long, url string, host string")
    for row in u.judge(df, URL_RULES).collect():
        host, path, rule, verdict = plain(URLS[row.page_id])
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdict if verdict else row.verdict in ("allow", "block")
    assert u.judge(df.where("false"), URL_RULES).count() == 0


def test_mined_rules_decide_the_rest(spark):
    rows = [f"http://a{i}.com/de/x?utm_source=y" for i in range(40)] + [f"http://b{i}.org/q/z" for i in range(40)]
    rows += ["http://c.net/k?utm_source=1", "http://d.net/q/z"]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    found = {r.page_id: (r.rule, r.verdict) for r in u.judge(df, URL_RULES).collect()}
    assert found[80] == (None, "block")
    assert found[81] == (None, "allow")


def test_pruning_keeps_the_shorter_rule():
    rules = [u.Mined(("a",), "block", 0.9, 0.5), u.Mined(("a", "b"), "block", 0.9, 0.4), u.Mined(("a", "c"), "block", 1.0, 0.1)]
    assert [r.tokens for r in u.pruned(rules)] == [("a", "c"), ("a",)]


def test_no_rule_is_lost_to_many_surer_ones(spark):
    """One shape of 14 tokens makes over 16,000 sure rules; a rule of confidence 0.9 still decides."""
    query = "&".join(f"k{i}=1" for i in range(6))
    rows = [f"http://a.b.c.com/de/s{0}/t/u?{query}"] * 400
    rows += ["http://x.org/z/q"] * 90 + ["http://y.com/de/q?unsure=1"] * 10 + ["http://x.org/z?unsure=1"] * 90
    rows += [f"http://n{i}.net/only?unsure=1" for i in range(3)]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    labelled = u.judge(df, [u.Rule("block", "com", "/de/"), u.Rule("allow", "org", "/")], default="none")
    assert {r.verdict for r in labelled.where("page_id >= 590").collect()} == {"allow"}


def test_pruning_in_spark_is_that_of_lists(spark):
    rows = [(["a", "b"], "block")] * 9 + [(["a"], "allow")] + [(["b", "c"], "block")] * 5 + [(["c"], "allow")] * 20
    mined = u.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.01, 0.5).collect()
    rules = [u.Mined(tuple(r.tokens), r.verdict, r.confidence, r.support) for r in mined]
    assert rules and sorted(u.pruned(rules), key=str) == sorted(rules, key=str)
