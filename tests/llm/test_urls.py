import random
import re

from arterial.llm import urls

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def own_rule(host, path):
    fits = [(of + p, v) for v, of, p in RULES if (host == of or host.endswith("." + of)) and path.startswith(p)]
    return max(fits, key=lambda x: len(x[0]), default=(None, None))


def test_rules_match_brute_force(spark):
    urls_in = [
        "http://x.example.org/es/1", "http://example.org/en/12?a=/de/", "https://EXAMPLE.ORG/en/2", "http://notexample.org/es/", "ftp://a.com/fr/x",
        "a.com/de/", None, "", "http://com/de/", "http://a.com?x=/de/", "http://a.com#/de/", "http://a.com:80/de/", "x://y://z.com/de/", "http:///de/",
        "http://b.net/a\nb", "http://org", "http://org/", "http://é.org/ü",
    ]
    pages = spark.createDataFrame([(i, u, None, "x") for i, u in enumerate(urls_in)], "page_id int, url string, html string, host string")
    for r in urls.judge_urls(pages).collect():
        host, path = split(urls_in[r.page_id])
        rule, verdict = own_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule), urls_in[r.page_id]
        assert r.verdict == (verdict or "allow")


def test_blocks_reach_aliases_and_allow_wins(spark):
    canonical = '<html><head><link rel="canonical" href="{}"></head>'
    refresh = "<META http-equiv=refresh content='0; url={}'>"
    pages = [
        (1, "http://a.net/x", refresh.format("http://b.net/y")), (2, "http://b.net/y", canonical.format("http://bad.com/de/1")),
        (3, "http://c.net/x", refresh.format("/y")), (4, "http://c.net/y", None), (5, "http://d.net/1", canonical.format("//e.org/1")),
        (6, "http://d.net/2", canonical.format("http://d.net/1")), (7, "http://bad.com/de/2", canonical.format("http://d.net/2")),
        (8, "https://www.a.net/x/?utm_source=feed#top", None), (9, "http://a.net/x?page=2", None), (9, "http://a.net/x?page=2", None),
    ]
    frame = spark.createDataFrame(pages, "page_id int, url string, html string")
    got = {r.page_id: r for r in urls.judge_urls(frame, spellings=True).collect()}
    assert {i: r.verdict for i, r in got.items()} == {
        1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "block", 9: "allow",
    }
    assert got[3].alias_class == got[4].alias_class and got[1].alias_class == got[8].alias_class
    known = spark.createDataFrame([("http://c.net/y", "http://bad.com/de/9"), (None, "x"), ("http://c.net/y", None)], "url string, target string")
    again = {r.page_id: r.verdict for r in urls.judge_urls(frame, redirects=known).collect()}
    assert again[3] == again[4] == "block" and again[8] == "allow"  # another spelling is no alias unless asked for


def test_redirect_table_matches_brute_force(spark):
    """Chains, cycles, stars and strangers in a table of redirects: a class is what links reach; allow wins over block."""
    rnd = random.Random(6)
    hosts = ["a.net", "b.net", "bad.com/de", "ok.org", "example.org/es", "c.io"]
    every = [f"http://{rnd.choice(hosts)}/{i}" for i in range(90)]
    links = [(every[i], every[i + 1]) for i in range(12)] + [(every[20], every[i]) for i in range(21, 28)] + [(every[12], every[0])]
    links += [(rnd.choice(every[40:]), rnd.choice(every[40:])) for _ in range(20)] + [(every[30], "http://away.com/de/x"), (every[31], "http://away.com/de/x")]
    group = {u: {u} for u in [*every, "http://away.com/de/x"]}
    for a, b in links:
        both = group[a] | group[b]
        for u in both:
            group[u] = both
    own = {u: own_rule(*split(u))[1] for u in group}
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(every)], "page_id int, url string, html string")
    got = urls.judge_urls(pages, redirects=spark.createDataFrame(links, "url string, target string")).collect()
    for r in got:
        votes = {own[u] for u in group[every[r.page_id]]}
        assert r.verdict == (own[every[r.page_id]] or ("allow" if "allow" in votes else "block" if "block" in votes else "allow")), r
    assert len(got) == len(every) and {r.verdict for r in got} == {"allow", "block"}


def test_empty_and_native(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert urls.judge_urls(pages.limit(0)).count() == 0
    assert "Python" not in urls.judge_urls(pages)._jdf.queryExecution().executedPlan().toString()
    assert urls.judge_urls(pages).count() == pages.count()
