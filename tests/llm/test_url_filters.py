"""URL filters against sets and plain string functions."""

from tidewater.llm.url_filters import mark_listed, url_filter

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "com/de/")]


def test_cascade_is_exact_in_parts_too(spark):
    rows = spark.createDataFrame([(i, None if i == 7 else f"k{i % 900}", 3) for i in range(2000)], "id int, key string, x int")
    keys = spark.createDataFrame([(f"k{i}",) for i in range(0, 1500, 3)] + [(None,), ("k3",)], "key string")
    for most in (4_000_000, 200):
        got = {(r["id"], r["is_listed"]) for r in mark_listed(rows, "key", keys, most).collect()}
        assert got == {(i, i != 7 and i % 900 % 3 == 0) for i in range(2000)}


def test_odd_urls(spark):
    urls = ["http://A.Example.ORG/es/x?y#z", "https://example.org", "https://badexample.org/es/", "x.com/de/", None, "",
            "ftp://www.x.com/de/1", "http://com/de/", "http://x.net/a#b/c?d", "http://x.net/a?q", "a://b://c/d", "http://x.net/é/?"]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)] + [(None, urls[0], "h", "r")],
                                  "page_id long, url string, host string, rule string")
    keys = spark.createDataFrame([("x.net/a",), ("",)], "key string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter(pages, RULES, keys).collect()}
    assert got == {
        0: ("a.example.org", "/es/x", "example.org/es/", "block"), None: ("a.example.org", "/es/x", "example.org/es/", "block"),
        1: ("example.org", "", None, "allow"), 2: ("badexample.org", "/es/", "org/", "allow"), 3: ("", "", None, "block"),
        4: ("", "", None, "block"), 5: ("", "", None, "block"), 6: ("www.x.com", "/de/1", "com/de/", "block"),
        7: ("com", "/de/", "com/de/", "block"), 8: ("x.net", "/a", None, "block"), 9: ("x.net", "/a", None, "block"),
        10: ("b:", "//c/d", None, "allow"), 11: ("x.net", "/é/", None, "allow")}
    assert url_filter(pages.limit(0), RULES, keys.limit(0)).collect() == []
