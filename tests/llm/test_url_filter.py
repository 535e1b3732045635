from collections import Counter

import pytest

from peerscope.llm import url_filter
from peerscope.llm.queries import URL_RULES


def plain(url, rules, default="allow"):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h + p), h.count("."), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else default


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.NET/en/x?y#z", "https://example.net", "https://example.net/de/", "http://x.y.example.com/de/1",
    "http://example.com/de", "http://notexample.com/de/", "http://example.com.org/fr/", "http://org/fr/", "ftp://u@HOST.org:80/fr/a://b", "http://é.net/ü",
    "http://a..net/", "http://.net/", "http://net.", "http://example.net?/en/", "x\ny://example.net/en/\nq", "http://b.example.net/en/x", "http://b.example.net/en/x",
    "http://" + "a." * 300 + "org/fr/" + "z" * 20000,
]


@pytest.mark.parametrize("rules", [URL_RULES, (("b.c", "/x/", "block"), ("c", "/x/yy/", "allow"), ("a.b.c", "", "allow"), ("net", "", "block"), ("example.net", "/en/x", "allow"))])
def test_every_url_against_every_rule(spark, rules):
    urls = [*URLS, "http://a.b.c/x/yy/z", "http://b.c/x/", "http://c/x/yy/", "http://q.c/x/"]
    pages = spark.createDataFrame([(i, u, "old", "old") for i, u in enumerate(urls)] + [(None, "http://example.net/en/", "o", "o")], "page_id long, url string, host string, rule string")
    got = url_filter.filter_urls(pages, url_filter.rules_frame(spark, rules))
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()) == Counter(
        (i, *plain(u, rules)) for i, u in [*enumerate(urls), (None, "http://example.net/en/")]
    )


def test_no_pages_no_rules_and_odd_rules(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    some = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    assert url_filter.filter_urls(none, url_filter.rules_frame(spark, URL_RULES)).count() == 0
    empty = spark.createDataFrame([], "host string, path string, verdict string")
    assert url_filter.filter_urls(some, empty, default="block").first().verdict == "block"
    odd = spark.createDataFrame([(None, "/", "block"), ("net", None, "block"), ("net", "/", "allow"), ("NET", "/", "block")], "host string, path string, verdict string")
    assert url_filter.filter_urls(some, odd).first().verdict == "block"  # nulls are ignored, a block wins a tie


def test_main_path_runs_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    plan = url_filter.filter_urls(pages, url_filter.rules_frame(spark, URL_RULES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
