import re

import pytest

from docuweft.llm import urls

URLS = [
    None, "", "no scheme net/", "http://a.net", "http://a.net/", "HTTP://A.B.NET/x?q#f", "http://net/x", "http://xnet/", "http://my-net/", "http://example.net/en/1",
    "http://w.example.net/en", "http://w.example.net/en/?a", "http://badexample.net/en/", "http://example.com/de/x", "http://example.com/den/", "http://x.org/fr/1",
    "http://x.org/FR/1", "http://org/fr/", "http://a.org:80/fr/", "http://u@a.net/", "x://y://z.net/", "http://shop.cheap-pills.test/", "http://a.test/casino/1",
    "http://casino.test/", "http://a.casino.test", "http://a.test/affiliate/7/click", "http://docs.casino.test/casino/", "http://docs.net/", "http://h?casino/", "http://a.net/é\n/en/",
]


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    tail = rest[len(host):]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = re.match(r"[^?#]*", tail).group()
    fits = [(len(t), t, v) for t, v in urls.SITE_RULES if (host == t.partition("/")[0] or host.endswith("." + t.partition("/")[0])) and path.startswith("/" + t.partition("/")[2])]
    if fits:
        return host, path, max(fits)[1], max(fits)[2], None
    found = [(v == "allow", r.text, v) for r in urls.default_rules() if not r.site and re.search(r.pattern, host + tail) for v in [r.verdict]]
    return (host, path, None, *((max(found)[2], max(found)[1]) if found else ("allow", None)))


def test_as_by_trying_every_rule(spark):
    rows = [(n, u, "w", "h") for n, u in enumerate(URLS)] + [(3, URLS[3], "w", "h")]
    found = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string, weight string, Host string"))
    assert found.columns == ["page_id", "url", "weight", "host", "path", "rule", "verdict", "pattern"]
    got = sorted((r["page_id"], r["host"], r["path"], str(r["rule"]), r["verdict"], str(r["pattern"])) for r in found.collect())
    wanted = [(n, *plain(u)) for n, u, *_ in rows]
    assert got == sorted((n, h, p, str(r), v, str(f)) for n, h, p, r, v, f in wanted)


@pytest.mark.parametrize("text,tokens", [
    ("-pills.", ["pills"]), ("||casino.", ["casino"]), ("/affiliate/*/click", ["affiliate"]), ("ads*", []), ("|ads.x.", ["ads", "x"]), ("||a.com^", ["a", "com"]),
])
def test_only_bounded_literals_are_tokens(text, tokens):
    assert urls.pattern_rule(text, "block").tokens == tokens


def test_a_rule_stands_under_its_rarest_token(spark):
    pages = [(n, f"http://s{n}.example.com/en/") for n in range(20)] + [(30, "http://s.example.com/rare/")]
    rules = [urls.site_rule("example.com/rare/", "block"), urls.pattern_rule("*", "allow")]
    frame = spark.createDataFrame(pages, "page_id long, url string").select(urls.F.col("url").alias("_url"))
    host, _, tail = urls.parts_of(urls.F.col("_url"))
    index = urls.rule_index(frame.select(urls.url_tokens(host, tail).alias("tokens")), rules).collect()
    assert {(r["rule"], r["token"]) for r in index} == {("example.com/rare/", "rare"), ("*", "")}
    got = {r["page_id"]: r["verdict"] for r in urls.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), rules).collect()}
    assert got == {n: "allow" for n in range(20)} | {30: "block"}


def test_empty_table_and_no_rules(spark):
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []
    assert urls.judge_urls(spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string"), []).first()["verdict"] == "allow"
