"""URL verdicts against a plain loop over all rules, and against SQL."""

import random

import pytest

from compare import connect, differences
from tallymark.llm.q_filters import OP7_SQL, RULES, op7
from tallymark.llm.url_filter import Index, Rule, judge, split_url

URLS = [
    None, "", "no mark", "http://", "HTTP://A.NET", "http://a.net/", "http://net/x", "http://ANET/x", "x://y://z/",
    "http://www.Example.net/en/a?b#c", "http://example.net/EN/", "http://example.net/en", "a://example.net:80/en/",
    "http://example.com/de/x", "http://sub.example.com/de", "http://notexample.com/de/", "http://b.org?/fr/", "http://b.org/fr/#x",
    "http://é.org/fr/é", "http://" + "a." * 5000 + "net/", "http://org/fr/fr/", "http://u@example.com/de/", "ftp://.net/",
]


def plain(url, rules):
    host, path = split_url(url)
    best = None
    for r in rules:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path):
            if best is None or (len(r.text), r.verdict == "block") > (len(best.text), best.verdict == "block"):
                best = r
    return host, path, best.text if best else None, best.verdict if best else "allow"


def test_odd_urls(spark):
    rows = [(k % 20, u, "old", k) for k, u in enumerate(URLS)] + [(0, URLS[5], "old", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, Host string, n int")
    out = judge(df, RULES)
    assert out.columns == ["page_id", "url", "n", "host", "path", "rule", "verdict"]
    got = sorted(((r.n, r.url, r.host, r.path, r.rule, r.verdict) for r in out.collect()), key=str)
    assert got == sorted(((k, u, *plain(u, RULES)) for _, u, _, k in rows), key=str)
    assert judge(df.limit(0), RULES).count() == 0
    assert {r.verdict for r in judge(df, [], default="block").collect()} == {"block"}
    with pytest.raises(ValueError):
        judge(df.withColumnRenamed("url", "path").drop("Host"), RULES, url="path")


def test_many_rules_by_rarest_token():
    pick = random.Random(1)
    hosts = ["com", "a.com", "b-c.com", "org", "x.org", "a_b.net"]
    paths = ["/", "/en", "/en/", "/en/a", "/_", "/de/x-y/"]
    rules = [Rule(pick.choice(("allow", "block")), h, p) for h in hosts for p in paths if pick.random() < 0.7]
    index = Index(rules, {"com": 100, "org": 5, "a": 7, "en": 50})
    for _ in range(4000):
        url = "http://" + pick.choice(["", "w.", "a.", "x"]) + pick.choice(hosts) + pick.choice(["", *paths]) + pick.choice(["", "a", "z/", "glish"])
        host, path = split_url(url)
        rule = index.decide(host, path)
        assert (rule.text if rule else None, rule.verdict if rule else "allow") == plain(url, rules)[2:]
    with pytest.raises(ValueError):
        Rule("allow", "a.com", "en")


def test_query_equals_sql(spark, folder):
    problem, rows = differences(op7(spark, folder), connect(folder), OP7_SQL)
    assert problem is None and rows > 0
