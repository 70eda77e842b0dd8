import numpy as np

from shelfcast.llm import urlfilter as U
from shelfcast.llm.queries import BLOCK_TERMS, BLOCKED_SHARE, QUERIES, URL_RULES


def test_cascade_is_exact_over_its_universe():
    rng = np.random.default_rng(0)
    for n, listed in ((0, 0), (1, 1), (1, 0), (5000, 40), (5000, 4000), (300, 300)):
        keys = rng.integers(0, 2**63, (2, n), dtype=np.uint64)
        inside = np.arange(n) < listed
        cascade = U.Cascade.unpack(U.Cascade.build(keys[:, inside], keys[:, ~inside]).pack())
        assert (cascade.holds(keys) == inside).all()


def parts(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        i = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:i].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), rest[i:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    best = None
    for says, rule in URL_RULES:
        domain, start = rule.split("/", 1)
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start) and (best is None or len(rule) > len(best[1])):
            best = says, rule
    return host, path, best


def judge(urls, listed):
    out = []
    for url in urls:
        host, path, best = parts(url)
        out.append((host, path, best and best[1], best[0] if best else "block" if host in listed else "allow"))
    return out


def hosts_on_the_list(urls):
    pages = {}
    for url in urls:
        host, _, best = parts(url)
        pages.setdefault(host, []).append(best is not None and best[0] == "block")
    return {h for h, b in pages.items() if sum(b) >= BLOCKED_SHARE * len(b) or any(t in BLOCK_TERMS for part in h.split(".") for t in part.split("-"))}


URLS = ["http://a.Example.COM/en/1?x=/es/", "https://www.example.com/en/", "https://m.www.example.com/en/9#t", "http://example.com", "http://x.com?q", "ftp://b.net/es/1", "http://net/fr/2", "http://cheap-pills.org/x",
        "http://spam.example.org", "nothing", "", None, "a://b://c/d", "http://notexample.com/en/3", "http:///en/", "http://É.org/é?é", "http://casino.net/de/", "http://h.org/a\nb"]


MORE = ["http://half.net/es/1", "http://half.net/en/2", "http://few.net/fr/1", *["http://few.net/en/2"] * 4, "http://b.net/de/7", "http://" + "l" * 70_000 + ".org/" + "p" * 70_000]


def test_query_against_brute_force(spark, tmp_path):
    urls = URLS * 3 + MORE
    pages = spark.createDataFrame([(i, u, "x", True) for i, u in enumerate(urls)], "page_id long, url string, host string, blocked boolean").selectExpr("*", "1 AS `key`", "2 AS shard", "3 AS h1").repartition(4)
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    listed = hosts_on_the_list(urls)
    assert {"half.net", "b.net", "spam.example.org"} <= listed and not {"few.net", "h.org", ""} & listed
    want = dict(enumerate(judge(urls, listed)))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in QUERIES["op6_url_filter"](spark, str(tmp_path)).collect()}
    assert got == want and got[len(URLS) * 3 + 1][3] == "block" and got[len(URLS) * 3 + 3][3] == "allow"
    # any list, one broadcast or a pass for each shard; listed keys beyond the corpus and nulls change nothing
    own = spark.createDataFrame([("h.org",), ("x.com",), ("nowhere.org",), (None,), ("",), ("h.org",)], "key string")
    want = dict(enumerate(judge(urls, {"h.org", "x.com", ""})))
    for most in (U.MOST_BYTES, 1):
        out = U.url_filter(pages, URL_RULES, own, most, 3)
        assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()} == want
    assert U.url_filter(pages.limit(0), URL_RULES, own).count() == 0 and U.url_filter(pages, URL_RULES, own.limit(0)).where("verdict = 'block' AND rule IS NULL").count() == 0
