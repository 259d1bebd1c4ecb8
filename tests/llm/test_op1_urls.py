from hypothesis import given, settings, strategies as st

from tidemark.llm import op1_urls

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"), ("example.com", "/en/x", "block")]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(ch) for ch in "/?#" if ch in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    cut = min([rest.find(ch) for ch in "?#" if ch in rest] or [len(rest)])
    return "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in host), rest[:cut]


def brute(url, rules=RULES, default="allow"):
    host, path = split(url)
    fits = [(len(h + p), h + p, v) for h, p, v in rules
            if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, default))
    return host, path, best[1], best[2]


def judged(spark, urls, rules=RULES):
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, host int")
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    rows = op1_urls.judge(pages, frame).collect()
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}


URLS = ["http://www.example.com/en/xyz", "https://Example.COM/en/1?q#f", "ftp://a.example.com/en/xa",
        "x://notexample.com/en/1", "http://com/", "http://com", "http://com?x", "http://foo.net/es/1",
        "http://foo.net/es", "http://net./es/1", "http://.net/es/1", "no scheme", None, "", "://", "a://b://c/d",
        "http://example.com:80/en/1", "http://example-.com/en/2", "http://example.com.evil/en/1", "http://é.com/x"]


def test_against_brute_force(spark):
    got = judged(spark, URLS * 40)
    assert len(got) == len(URLS) * 40
    for i, u in enumerate(URLS * 40):
        assert got[i] == brute(u), u


def test_every_host_rule_and_empty_table(spark):
    rules = [("", "/", "block"), ("net", "/", "allow")]
    got = judged(spark, URLS, rules)
    for i, u in enumerate(URLS):
        assert got[i] == brute(u, rules), u
    assert judged(spark, []) == {}


def test_one_hot_host_spans_ranges(spark):
    urls = [f"http://hot.example.com/en/{i % 7}" for i in range(3000)] + URLS
    got = judged(spark, urls)
    assert all(got[i] == brute(u) for i, u in enumerate(urls))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text("ab.cEx/:?#", max_size=14).map(lambda x: "h://" + x), max_size=60))
def test_random_urls(spark, urls):
    rules = [("a", "/", "allow"), ("b.a", "/", "block"), ("c", "/x", "block"), (".a", "/", "block")]
    got = judged(spark, urls, rules)
    for i, u in enumerate(urls):
        assert got[i] == brute(u, rules), u
