from hypothesis import given, settings
from hypothesis import strategies as st

from keyreport.llm.url_filter import RULES, build_trie, by_join, by_trie, filter_urls, lookup, url_host, url_path

URLS = [None, "", "no scheme", "http://", "http://COM", "http://a.com", "http://a.com/", "https://WWW.Example.com/en/x?q#f",
        "https://example.com/en", "https://x.www.example.com/en/", "ftp://b.net/es/1", "http://net/fr/", "http://b.net/en/",
        "http://b.net?/es/", "x://y://z.com/", "http://user@a.com:80/x", "http://.com/", "http://a..net/es/", "http://éa.com/é\n/x"]


def rules(spark, some=RULES):
    return spark.createDataFrame(some, "verdict string, host string, path string")


def plain(host, path, some):
    best = None
    for verdict, h, p in some:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (0,), (len(h.split(".")), len(p), verdict == "block", h + p, verdict))
    return best and (best[3], best[4])


def parse(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host):].split("?")[0].split("#")[0]
    return host.translate({i: i + 32 for i in range(65, 91)}), path


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)] + [(6, URLS[6], "x", "y")],
                                  "page_id long, url string, host string, rule string")
    out = filter_urls(pages, rules(spark)).collect()
    assert len(out) == len(URLS) + 1
    for r in out:
        host, path = parse(URLS[r["page_id"]])
        want = plain(host, path, RULES) or (None, "allow")
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, *want)
    parts = pages.select("page_id", url_host(pages.url).alias("host"), url_path(pages.url).alias("path"))
    assert sorted(map(str, by_join(parts, rules(spark), "allow", "page_id").collect())) == \
        sorted(map(str, by_trie(parts, RULES, "allow", "page_id").collect()))


def test_no_pages_and_no_rules(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert filter_urls(none, rules(spark)).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert filter_urls(one, rules(spark, RULES[:1]).limit(0), "block").first()["verdict"] == "block"


def test_rules_with_nulls(spark):
    some = spark.createDataFrame([("block", None, "/x"), (None, "a.com", "/"), ("block", "b.com", None)],
                                 "verdict string, host string, path string")
    pages = spark.createDataFrame([(1, "http://a.com/x"), (2, "http://w.b.com/any"), (3, None)], "page_id long, url string")
    out = {r["page_id"]: (r["rule"], r["verdict"]) for r in filter_urls(pages, some).collect()}
    assert out == {1: (None, "allow"), 2: ("b.com", "block"), 3: (None, "allow")}


PART = st.sampled_from(["a", "b", "aa"])
HOST = st.lists(PART, min_size=1, max_size=3).map(".".join)
PATH = st.one_of(st.just(""), st.lists(st.sampled_from(["", "a", "ab", "b"]), max_size=3).map(lambda x: "/" + "/".join(x)))


@given(st.lists(st.tuples(st.sampled_from(["allow", "block"]), HOST, PATH), max_size=8), HOST, PATH)
@settings(deadline=None, max_examples=500)
def test_trie_equals_every_rule_tried(some, host, path):
    assert lookup(build_trie(some), host, path) == plain(host, path, some)
