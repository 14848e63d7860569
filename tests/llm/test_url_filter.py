"""URL rules against a plain reading of the contract; the trees on URLs they can learn."""

import re

from postlytics.llm import url_filter
from llm_fixtures import SF01, make_docs  # noqa: F401

URLS = ["https://www.Example.ORG/en/1", "http://example.org/es/9?q=1", "http://a.org", "http://a.org/", "a.org/x", None, "", "x://b.com/fr/",
        "http://B.COM/de/7#x", "http://example.org?x/es/", "http://notexample.org/es/1", "http://org/x", "http://com/fr", "ftp://h/a?b://c/",
        "http://user@a.org:80/x", "http://a.org/é?ü#ß", "://", "http://" + "a" * 5000 + ".net/" + "b/" * 3000, "http://x.net/a\nb?c"]


def brute(url, rules=url_filter.RULES):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for r, v in rules:
        h, p = r[:r.index("/")], r[r.index("/"):]
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(r) > len(best[0])):
            best = (r, v)
    return host, path, *(best or (None, None))


def pages(spark, urls):
    from pyspark.sql import functions as F
    return spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string").withColumn("host", F.lit("x"))


def test_hosts_paths_and_rules(spark):
    got = {r.page_id: r for r in url_filter.judge_urls(pages(spark, URLS)).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path, rule, verdict = brute(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")


def test_whole_table_has_a_verdict_for_each_page(spark):
    src = spark.read.parquet(f"{SF01}/pages.parquet")
    got = {r.page_id: r for r in url_filter.judge_urls(src).collect()}
    for r in src.select("page_id", "url").collect():
        host, path, rule, verdict = brute(r.url)
        g = got[r.page_id]
        assert (g.host, g.path, g.rule) == (host, path, rule)
        assert g.verdict == verdict if rule else g.verdict == ("block" if g.block_score > 0.5 else "allow")


def test_trees_learn_from_the_labelled_urls(spark):
    good = [f"http://news{i % 9}.good.org/story-{chr(97 + i % 26)}" for i in range(120)]
    bad = [f"http://x{i}-{i * 7919 % 1000}.bad.com/{i * 31337}/{i * 271}?a={i}&b={i}&c={i}&id={i * 99991}" for i in range(120)]
    new = ["http://press.other.net/story-q", "http://y9-77.other.net/77123/812?a=1&b=2&c=3&id=812831"]
    rules = (("org/", "allow"), ("com/", "block"))
    got = {r.page_id: r for r in url_filter.judge_urls(pages(spark, good + bad + new), rules).collect()}
    assert [got[240].verdict, got[241].verdict] == ["allow", "block"]
    assert [got[240].rule, got[241].rule] == [None, None]


def test_a_rare_label_is_learnt(spark):
    good = [f"http://news{i % 9}.good.org/story-{chr(97 + i % 26)}{i}" for i in range(4000)]
    bad = [f"http://x{i}-{i * 7919 % 1000}.bad.com/{i * 31337}/{i * 271}?a={i}&b={i}&c={i}&id={i * 99991}" for i in range(4)]
    new = ["http://press.other.net/story-q1", "http://y9-77.other.net/77123/812?a=1&b=2&c=3&id=812831"]
    rules = (("org/", "allow"), ("com/", "block"))
    got = {r.page_id: r for r in url_filter.judge_urls(pages(spark, good + bad + new), rules, train_rows=40).collect()}
    assert got[4004].block_score is not None and [got[4004].verdict, got[4005].verdict] == ["allow", "block"]


def test_one_kind_of_label_none_and_an_empty_table(spark):
    assert [r.verdict for r in url_filter.judge_urls(pages(spark, ["http://a.org/x", "http://b.net/y"])).collect()] == ["allow"] * 2
    only = url_filter.judge_urls(pages(spark, ["http://a.com/x", "http://b.net/y"]), (("com/", "block"),))
    assert [r.verdict for r in only.collect()] == ["block"] * 2
    assert [r.verdict for r in url_filter.judge_urls(pages(spark, ["http://b.net/y"]), ()).collect()] == ["allow"]
    assert url_filter.judge_urls(pages(spark, [])).count() == 0


def test_features(spark):
    u = "http://ab.cd.net/x/1-2?q=1&r=2#f"
    host, path = url_filter.host_and_path(__import__("pyspark").sql.functions.col("url"))
    from collections import Counter
    from math import log2
    r = url_filter.with_features(spark.createDataFrame([(u,)], "url string").withColumns({"host": host, "path": path})).collect()[0]
    entropy = -sum(c / len(u) * log2(c / len(u)) for c in Counter(u).values())
    assert abs(r.f_entropy - entropy) < 1e-9
    assert (r.f_length, r.f_depth, r.f_params, r.f_labels, r.tld, r.site) == (len(u), 2, 2, 3, "net", "cd.net")
    assert abs(r.f_digits - sum(c.isdigit() for c in u) / len(u)) < 1e-9
