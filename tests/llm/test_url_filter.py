from __future__ import annotations

import re

import pytest

from tickstream.llm import url_filter
from tickstream.llm.url_filter import RULES, Rule

URLS = [
    None, "", "no scheme", "http://", "://", "http://A.Example.NET/en/1?x#y", "https://example.net/en", "http://net/",
    "http://x.net", "http://notnet/", "http://example.com/de/1", "http://sub.EXAMPLE.com/de/", "http://org/fr/x",
    "http://a.b.org/fr/", "http://a.org/FR/", "http://example.net/EN/", "http://h/p://q/r", "http://h#f/x", "http://h?x=/y",
    "ftp://user@É.com:80/a b\n/c", "a://b://c/d", "http://example.com/de?x", "http://example.com/de/?x",
]


def _plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r.text for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=len, default=None)


@pytest.fixture()
def labels(spark):
    return spark.createDataFrame([(1, 1)], "doc_id long, quality int")


def test_parts_and_rules(spark, labels):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    verdicts = {r.text: r.verdict for r in RULES}
    rows = url_filter.url_report(pages, labels).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        assert (r["host"], r["path"], r["rule"]) == _plain(URLS[r["page_id"]])
        assert r["verdict"] == verdicts.get(r["rule"], "allow")


def test_templates_and_purity(spark):
    pages, labels, number = [], [], 0
    for path, bad in (("/ads/%d", 0.95), ("/post/%d", 0.02), ("/news/%d", 0.02)):
        for _ in range(60):
            number += 1
            pages.append((number, "http://mixed.info" + path % number, number if number % 2 else None, "x"))
            labels.append((number, number % 20 < 20 * (1 - bad)))
    for k in range(60):  # many sparse branches
        number += 1
        pages.append((number, f"http://wide.info/u{chr(97 + k % 26)}{chr(97 + k // 26)}/home", None, "x"))
    df = spark.createDataFrame(pages, "page_id long, url string, label_key long, host string")
    known = spark.createDataFrame(labels, "label_key long, good boolean")
    rows = url_filter.judge_urls(df, known, []).collect()
    found = {r["template"]: r["verdict"] for r in rows if r["host"] == "mixed.info"}
    assert found == {"/ads/{n}": "block", "/*1/{n}": "allow"}
    assert {r["template"] for r in rows if r["host"] == "wide.info"} == {"/*/home"}
    assert all(r["rule"] is None for r in rows)


def test_longest_rule_and_ties(spark):
    rules = [Rule("allow", "a.b/x"), Rule("block", "a.b/x"), Rule("allow", "b/"), Rule("block", "a.b/xyz")]
    pages = spark.createDataFrame([(1, "q://a.b/x1", None), (2, "q://a.b/xyz", None), (3, "q://c.b/", None)],
                                  "page_id long, url string, label_key long")
    none = spark.createDataFrame([], "label_key long, good boolean")
    out = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, none, rules).collect()}
    assert out == {1: ("a.b/x", "block"), 2: ("a.b/xyz", "block"), 3: ("b/", "allow")}


def test_empty_tables_and_native_plan(spark, labels):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.url_report(empty, labels).count() == 0
    pages = spark.createDataFrame([(1, "http://a/b/1")], "page_id long, url string")
    out = url_filter.url_report(pages, labels.limit(0))
    assert [r["verdict"] for r in out.collect()] == ["allow"]
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
