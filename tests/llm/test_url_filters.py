from weftlink.llm.url_filters import RULES, judge


def expected(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fit = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_brute_force(spark):
    urls = [None, "", "no scheme", "http://", "http://COM/", "https://a.com", "http://a.com?x=/en/", "http://example.com/en/1", "http://www.Example.com/en/1", "http://m.www.example.com/en/#/", "http://notexample.com/en/", "http://x.net/es/", "http://net/fr/9", "http://x.NET/fr", "ftp://u:p@b.net:80/es/", "http://..net/es/", "http://a.b://com/", "http://ÄA.com/", "x://a.com/" + "y" * 5000]
    rules = [*RULES, ("b.c", "", "block"), ("c", "/a", "allow"), ("c", "/a", "block"), (None, "/", "block"), ("d.c", "/abc", "allow")]
    urls += ["http://b.c", "http://x.b.c/a", "http://c/abc", "http://d.c/abcd", "http://d.c/ab"]
    df = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(urls)], "page_id int, url string, verdict string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    for most in (100, 0):  # broadcast, then shuffled with salts
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge(df, table, broadcast_rules=most).collect()}
        assert got == {k: expected(u, [r for r in rules if r[0]]) for k, u in enumerate(urls)}


def test_repeats_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "http://a.com/")] * 3, "page_id int, url string")
    table = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert judge(df, table).count() == 3
    assert judge(df.limit(0), table).count() == 0
    assert [r.verdict for r in judge(df, table.limit(0), "block").collect()] == ["block"] * 3
