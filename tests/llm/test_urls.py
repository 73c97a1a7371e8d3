from pyspark.sql import functions as F

from brachis.llm import queries, urls
from tests.oracle import compare

PAGES = [
    (1, "http://a.org/x#f", "<link rel='canonical' href='https://b.example.com/de/1'>"),
    (2, "https://A.org/x", "<p>"),
    (3, "http://c.org/d/e.html", '<meta http-equiv="refresh" content="0; url=y"><LINK href="/x" rel=canonical>'),
    (4, "http://c.org/x", None),
    (5, None, "<link rel=canonical href='http://q.net/'>"),
    (6, "nourl", "x"),
    (7, "http://z.org/fr/", '<link rel="canonical" href="//w.org/1">'),
    (8, "http://w.org/1", '<link rel="canonical" href="http://v.net/">'),
    (9, "http://w.org/1?p=http://x.net/#a", ""),
    (10, "http://x.net", ""),
    (10, "http://x.net", ""),
    (11, "http://s.example.net/en/a", ""),
    (12, "http://s.example.net/e/a", ""),
    (13, "http://m.org/", ""),
    (14, "http://n.org/", ""),
]


def judged(spark, redirects=None, pages=PAGES):
    rows = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("rule", F.lit("clash")).withColumn("node", F.lit(1))
    return {r.page_id: r for r in urls.judge(rows, urls.rule_table(spark), redirects).collect()}


def test_rules_and_aliases(spark):
    got = judged(spark)
    verdict = {k: (r.rule, r.verdict) for k, r in got.items()}
    assert verdict[1] == verdict[2] == (None, "block")  # an alias of a blocked url, itself judged by no rule
    assert verdict[3] == verdict[4] == (None, "allow") and got[3].component == got[4].component == "c.org/d/e.html"
    assert verdict[5] == verdict[6] == (None, "allow") and got[5].host == got[6].path == ""
    assert verdict[7] == ("org/fr/", "allow") and verdict[8] == (None, "allow")  # allow goes before block
    assert verdict[10] == (None, "allow") and got[10].path == ""
    assert verdict[11] == ("example.net/en/", "allow") and verdict[12] == ("net/", "block")
    assert (got[9].host, got[9].path) == ("w.org", "/1")


def test_redirect_chains_through_unseen_urls(spark):
    redirects = spark.createDataFrame([("http://m.org/", "http://u.org/1"), ("http://u.org/1", "http://bad.net/"), (None, "http://n.org/")], "src string, dst string")
    got = judged(spark, redirects)
    assert got[13].verdict == "block" and got[14].verdict == "allow"


def test_null_ids_and_long_values(spark):
    path, filler = "/fr/" + "p" * 100_000, "<p>" * 100_000
    pages = [(None, f"http://o.org{path}?q#f", None), (None, "http://bad.net/", ""), (1, "http://long.com/", f'{filler}<link rel="canonical" href="http://bad.net/{path}">'), (None, None, None)]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = [(r.page_id, r.host, len(r.path), r.rule, r.verdict) for r in urls.judge(rows, urls.rule_table(spark)).collect()]
    assert sorted(got, key=repr) == sorted([(None, "o.org", len(path), "org/fr/", "allow"), (None, "bad.net", 1, "net/", "block"), (1, "long.com", 1, None, "block"), (None, "", 0, None, "allow")], key=repr)


def test_empty(spark):
    assert judged(spark, pages=[]) == {}


def test_query_equals_oracle(spark):
    assert compare(spark, "/root/testdata/sf0.001", "op2", queries.op2_url_filter, queries.ORACLE_SQL["op2_url_filter"]) == 50
