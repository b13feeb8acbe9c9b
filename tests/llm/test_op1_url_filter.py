import re

import pytest

from voxloom.llm import url_filter as u

URLS = {
    "http://a.example.net/en/1": ("a.example.net", "/en/1", "example.net/en/", "allow"),
    "https://example.net/de/": ("example.net", "/de/", "net/", "block"),
    "http://EXAMPLE.com/de/x?q=/fr/": ("example.com", "/de/x", "example.com/de/", "block"),
    "http://example.com/DE/x": ("example.com", "/DE/x", None, "allow"),
    "http://x.org/fr/": ("x.org", "/fr/", "org/fr/", "allow"),
    "http://x.org/fr": ("x.org", "/fr", None, "allow"),
    "http://net/": ("net", "/", "net/", "block"),
    "http://net": ("net", "", None, "allow"),
    "http://notnet/": ("notnet", "/", None, "allow"),
    "http://badexample.net/en/": ("badexample.net", "/en/", "net/", "block"),
    "ftp://a.net?x": ("a.net", "", None, "allow"),
    "http://casino.example.org/es/": ("casino.example.org", "/es/", None, "block"),
    "http://free-bets.example.com/en/2": ("free-bets.example.com", "/en/2", None, "block"),
    "http://a.com/alphabets/": ("a.com", "/alphabets/", None, "allow"),
    "http://a.com/x?site=warez": ("a.com", "/x", None, "block"),
    "no scheme.net/": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    "://": ("", "", None, "allow"),
    "http://a.org#/fr/": ("a.org", "", None, "allow"),
    "http://İ.net/": ("İ.net", "/", "net/", "block"),
}


def test_table(spark):
    rows = [(i, url, "extra") for i, url in enumerate(URLS)] + [(None, None, "extra"), (0, "http://net/", "twice")]
    out = u.filter_urls(spark.createDataFrame(rows, "page_id long, url string, id string")).collect()
    got = {r["page_id"]: r for r in out if r["page_id"] not in (0, None)}
    for i, (url, expected) in enumerate(URLS.items()):
        if i:
            assert tuple(got[i][c] for c in ("host", "path", "rule", "verdict")) == expected, url
    assert [(r["host"], r["verdict"]) for r in out if r["page_id"] is None] == [("", "allow")]
    assert len(out) == len(rows) and u.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_index_loses_nothing():
    rules = [u.PatternRule("block", p) for p in ("||ads.*/banner^", "/track/*", "|cdn.", "^pixel^", "*.gif|", "shop", "a*b")]
    index = u.RuleIndex(u.SITE_RULES, rules, {"ads": 5, "banner": 1})
    assert len(index.always) == 2  # no token is whole in every match of these
    for url in [*URLS, "http://x.ads.com/a/banner/", "http://a.com/track/9", "http://cdn.a/", "http://b/pixel/1.gif", "http://my-shops.com/", "http://xayb/"]:
        host, path, query = u.split_url(url)
        got = index.judge(url)
        site = host + path
        fits = [r for r in u.SITE_RULES if host and re.match(r.regex(), site)]
        if fits:
            best = max(fits, key=lambda r: len(r.rule))
            assert got[2:4] == (best.rule, best.verdict)
        else:
            hits = [r for r in rules if host and re.search(r.regex(), (site + query).lower())]
            assert got[2] is None and got[3] == ("block" if hits else "allow") and got[4] == (hits[0].pattern if hits else None), url


def test_rarest_token():
    index = u.RuleIndex([u.SiteRule("block", "rare.common/path/")], [], {"common": 9, "path": 8, "rare": 1})
    assert list(index.by_token) == ["rare"]


def test_many_rules_from_a_file(spark, tmp_path):
    """A long list is read, indexed and applied; only the rules that a URL's tokens fetch are compiled."""
    rules = ["# a list", ""] + [f"block ||bad{i}.example^" for i in range(20_000)] + ["allow ||bad7.example^good/", "block site:shop.example/sale/", "allow site:shop.example/sale/ok/"]
    (tmp_path / "rules.txt").write_text("\r\n".join(rules))
    sites, patterns = u.load_rules(spark, str(tmp_path / "rules.txt"))
    assert len(sites) == 2 and len(patterns) == 20_001 and patterns[0] == u.PatternRule("block", "||bad0.example^")
    urls = ["http://bad19999.example/x", "http://bad7.example/good/1", "http://bad7.example/", "http://fine.example/", "http://shop.example/sale/1", "http://a.shop.example/sale/ok/"]
    out = u.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), sites=sites, patterns=patterns).orderBy("page_id").collect()
    assert [r["verdict"] for r in out] == ["block", "allow", "block", "allow", "block", "allow"] and max(r["n_tried"] for r in out) <= 4
    index = u.RuleIndex(sites, patterns, {"example": 9})
    index.judge(urls[0])
    assert sum("regex" in e.__dict__ for rules in index.by_token.values() for e in rules) <= 2
    (tmp_path / "bad.txt").write_text("block x\ndeny y\n")
    with pytest.raises(ValueError, match="line 2"):
        u.load_rules(spark, str(tmp_path / "bad.txt"))
