import re

from skyfold.llm.url_filter import RULES, filter_urls, split_url, url_list

PAGES = [
    (1, "http://www.example.com/en/a"),
    (2, "https://sub.Example.COM/en/x?q=1"),
    (3, "https://example.com/de/"),
    (4, "http://a.net/es/1"),
    (5, "http://a.net/es"),
    (6, "http://bad.org/x/#top"),
    (7, "https://www.bad.org/x"),
    (8, "ftp://BAD.org:80/x?y"),
    (9, "http://bad.org/other"),
    (10, None),
    (11, ""),
    (12, "no scheme/path"),
    (13, "http://"),
    (14, "http://host?x#y"),
    (15, "http://redirect.org/go?to=http://bad.org/x"),
    (16, "http://x.com"),
    (17, "https://notexample.com/en/"),
    (18, "http://ÄÖ.net/fr/ü"),
    (6, "http://bad.org/x/#top"),
    (None, "http://bad.org/x"),
    (19, "http://long.org/" + "p" * 50_000),
]
LISTED = ["bad.org/x", "bad.org/x", None]


def brute(url):
    at = (url or "").find("://")
    if at < 0:
        return "", "", None, "allow"
    rest = url[at + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    name = re.sub(r"^www\.", "", re.sub(r":(80|443)$", "", host)) + path.rstrip("/")
    return host, path, None, "block" if name in LISTED and host else "allow"


def test_against_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "<html>", "clash") for i, u in PAGES], "page_id long, url string, html string, host string")
    listed = spark.createDataFrame([(x,) for x in LISTED], "canonical string")
    for blocks in (1, 1 << 12):  # a filter of one word lets false positives through; verdicts stay
        rows = filter_urls(pages, listed, most_blocks=blocks).collect()
        assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in rows), key=repr) == sorted(((i, *brute(u)) for i, u in PAGES), key=repr)


def test_long_lists_are_met_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr("skyfold.llm.url_filter.BROADCAST_URLS", 0)
    test_against_brute_force(spark)


def test_pages_are_read_once_and_no_python_runs(spark, tmp_path):
    spark.createDataFrame([(i, u) for i, u in PAGES], "page_id long, url string").write.parquet(f"{tmp_path}/pages")
    found = filter_urls(spark.read.parquet(f"{tmp_path}/pages"), spark.createDataFrame([("bad.org/x",)], "canonical string"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("page_id#") and plan.count(",url#") == 1 and "Python" not in plan


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    listed = spark.createDataFrame([], "canonical string")
    assert filter_urls(pages, listed).count() == 0
    own = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    assert [r.verdict for r in filter_urls(own, listed).collect()] == ["allow"]
    assert sorted(r.canonical for r in url_list(spark, ("a.org",), ("", "m."), ("x",), 1, ("",)).collect()) == ["a.org/x/0", "m.a.org/x/0"]


def test_no_false_negative(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 50}.org/p{i}") for i in range(3000)], "page_id long, url string")
    listed = spark.createDataFrame([(f"h{i % 50}.org/p{i}",) for i in range(0, 3000, 3)], "canonical string")
    rows = filter_urls(pages, listed).collect()
    assert all((r.verdict == "block") == (r.page_id % 3 == 0) for r in rows)
    assert sum(r.maybe_listed for r in rows) < 1150
    assert split_url(pages).columns == ["page_id", "url", "_host", "_path"]
