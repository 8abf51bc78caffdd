import duckdb
from corpus_cases import rows_of

from custvalue.llm import oracles, urls
from custvalue.llm.queries import URL_RULES

PAGES = "page_id long, url string, html string, host string, rule string"
RULES = "host string, path string, verdict string"
URLS = [
    None, "", "no scheme", "http://", "http://org", "http://org/", "https://a.ORG/x", "http://notorg/",
    "http://example.org/es/1", "http://EXAMPLE.org/es", "http://www.example.org/en/12?q=/es/",
    "http://xexample.org/en/1", "http://shop.com/fr/", "http://com/de/#x", "http://shop.com?x=/de/",
    "http://a.b.c.d.example.org/en/1/2", "http://user@example.org:80/es/", "ftp://x.com/de/\n/y",
    "http://x.com/fr/http://example.org/es/", "http://www.example.org/es/" + "long/" * 50_000,
    "http://" + "a." * 3000 + "com/de/" + "é" * 9000, "http://.org/x", "http://org./x", "http://ex\nample.com/de/",
]


def test_verdicts_agree_with_sql(spark):
    rows = [(i, u, "h", "clash", "clash") for i, u in enumerate(URLS + URLS[:9])] + [(None, URLS[8], None, None, None)]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", [r[:2] for r in rows])
    rel = con.sql(oracles.STATEMENTS["op10_url_filters"])
    want = sorted(rel.project("page_id, host, path, rule, verdict").fetchall(), key=repr)
    rules = spark.createDataFrame(URL_RULES, RULES)
    assert rows_of(urls.judge(spark.createDataFrame(rows, PAGES), rules)) == want


def test_no_pages_no_rules_equal_rules(spark):
    rules = spark.createDataFrame(URL_RULES, RULES)
    none = spark.createDataFrame([], RULES)
    pages = spark.createDataFrame([(1, "http://a.org/", None, None, None)], PAGES)
    assert urls.judge(pages.limit(0), rules).count() == 0
    assert [r["verdict"] for r in urls.judge(pages, none, "block").collect()] == ["block"]
    both = spark.createDataFrame([("org", "/", "allow"), ("ORG", "/", "block"), (None, "/", "block"), ("", "/", "block")], RULES)
    assert [(r["rule"], r["verdict"]) for r in urls.judge(pages, both).collect()] == [("org/", "block")]


def test_many_shapes_are_judged_by_one_plan(spark):
    import time

    rules = spark.range(20_000).selectExpr(
        "concat(repeat('a.', cast(id % 40 as int)), 'org') as host",
        "concat('/', repeat('x', cast(id div 40 as int))) as path", "'block' as verdict",
    )
    pages = spark.range(500).selectExpr(
        "id as page_id", "concat('http://', repeat('a.', cast(id % 50 as int)), 'org/', repeat('x', cast(id % 90 as int))) as url"
    )
    start = time.perf_counter()
    found = urls.judge(pages, rules).collect()
    assert time.perf_counter() - start < 60
    for r in found:
        host, path = r["host"].count("a."), r["path"].count("x")
        assert r["rule"] == "a." * min(host, 39) + "org/" + "x" * path and r["verdict"] == "block"
