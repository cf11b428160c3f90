import math

import pytest

from lotwise.llm import url_filter as u
from lotwise.llm.queries import URL_RULES


@pytest.fixture(scope="module")
def model(spark):
    return u.train_url_model(u.labelled_urls(spark))


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_rules_and_parts_against_brute_force(spark, model):
    urls = [r.url for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url").collect()]
    urls += [None, "", "no scheme", "://", "HTTP://WWW.ÉX.ORG", "http://org/", "http://xorg/", "http://a.org?x=/es/", "x://y://z/q", "http://h\n/p\nq?r",
             "http://example.org/en/1", "http://b.example.org/en/2", "ftp://u.com/fr/", "https://u.com/de/x#y", "http://com/de/", "http://" + "a" * 20_000 + "/" + "b" * 20_000]
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(urls)], "page_id long, url string, verdict string")
    got = {r.page_id: r for r in u.filter_urls(df, URL_RULES, model).collect()}
    assert len(got) == len(urls)
    for i, x in enumerate(urls):
        host, path, rule, verdict = brute(x)
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.p_block >= 0.5 else "allow")) and 0 <= r.p_block <= 1


def test_model_tells_held_out_words_apart(spark, model):
    """The blocked words of the pages are not in the labelled table, so every one of them is held out."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").distinct()
    bad = ["cheap-pills", "casino-win", "spam-farm", "ads-track", "adult-x", "free-bets"]
    assert not any(b in r.url for b in bad for r in u.labelled_urls(spark).collect())
    rows = u.filter_urls(pages, [], model).collect()
    for b in bad:
        known = [r for r in rows if b in r.host]
        assert sum(r.verdict == "block" for r in known) >= 0.95 * len(known) > 0, b
    rest = [r for r in rows if not any(b in r.host for b in bad)]
    assert sum(r.verdict == "block" for r in rest) <= 0.005 * len(rest)


def test_native_and_empty(spark, model):
    df = spark.createDataFrame([], "page_id long, url string")
    out = u.filter_urls(df, URL_RULES, model)
    assert out.count() == 0
    plan = u.filter_urls(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"), URL_RULES, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "html" not in plan
    assert not math.isnan(model[0]) and len(model[1]) == u.BUCKETS
