from __future__ import annotations

from tessera.llm.queries import URL_RULES
from tessera.llm.urls import LABELLED_URLS, judge_urls, labelled_urls

URLS = [
    None, "", "no scheme/com/", "http://", "http://COM/", "http://www.EXAMPLE.com/en/x?q#f",
    "https://example.com/en", "https://example.com/en/", "http://a.example.com/en/1", "ftp://b.net/es/",
    "http://notnet/es/", "http://x.net/EN/", "http://x.net/fr/#a", "http://É.com?x=http://y/",
    "http://a.org:80/p?q", "://net/fr/", "http://x.com" + "/y" * 5000,
]


def by_rules(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    best = None
    for action, text in URL_RULES:
        own, _, tail = text.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + tail):
            if best is None or len(text) > len(best[1]):
                best = (action, text)
    return host, path, best


def test_rules_equal_brute_force(spark, small):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(None, URLS[5], "x")] * 2
    pages = small(rows, "page_id bigint, url string, host string")
    got = {}
    for r in judge_urls(pages, URL_RULES, labelled_urls(spark)).collect():
        got.setdefault((r.page_id, r.host, r.path, r.rule), []).append(r.verdict)
    for page_id, url, _ in rows:
        host, path, best = by_rules(url)
        verdicts = got[(page_id, host, path, best and best[1])]
        if best:
            assert set(verdicts) == {best[0]}
        elif not host and not path:
            assert verdicts == ["allow"]
    assert sum(map(len, got.values())) == len(rows)
    assert judge_urls(pages.limit(0), URL_RULES, labelled_urls(spark)).count() == 0


HELD_OUT = [
    ("https://casino-bets.test/en/40", 1), ("http://www.cheap-pills.test/de/3", 1),
    ("https://spam-farm.test/fr/1", 1), ("http://poker-bonus.test/es/2", 1),
    ("https://www.garden-museum.test/en/40", 0), ("http://city-history.test/de/3", 0),
    ("https://science-library.test/fr/1", 0), ("http://weather-maps.test/es/2", 0),
]


def test_held_out_accuracy(spark):
    for urls, least in ((LABELLED_URLS, len(LABELLED_URLS)), (HELD_OUT, 7)):
        rows = spark.createDataFrame([(b, u) for u, b in urls], "page_id bigint, url string")
        got = judge_urls(rows, [], labelled_urls(spark), block_from=0.5).collect()
        assert sum((r.verdict == "block") == bool(r.page_id) for r in got) >= least
