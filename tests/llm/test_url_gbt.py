import math
import re
from collections import Counter

import pytest

from conftest import SMALL
from stormledger.llm import catalog, url_gbt


def cut(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")


def ruled(host, path):
    fits = [(len(h), len(p), h + p, v) for h, p, v in url_gbt.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


ODD = [None, "", "no scheme", "http://", "HTTPS://WWW.Example.COM/en/1?x=/a#b", "ftp://example.com/en/x", "http://a.example.com/en", "http://notexample.com/en/",
       "x://net/es/1", "x://b.net/fr/?q", "http://u:p@example.com:80/en/", "http://exampleXcom/en/", "a://b://c/d", "http://com/", "http://com", "http://é.net/es/é",
       "http://host\n.net/es/a\nb", "http://www.example.com/en/" + "a" * 5000]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(k, u, "x", 1) for k, u in enumerate(ODD)], "page_id long, url string, host string, label int")
    found = {r["page_id"]: r for r in url_gbt.judge(pages).collect()}
    for k, url in enumerate(ODD):
        host, path = cut(url)
        rule, verdict = ruled(host, path)
        assert (found[k]["host"], found[k]["path"], found[k]["rule"]) == (host, path, rule)
        assert found[k]["verdict"] == verdict if rule else found[k]["verdict"] in ("allow", "block")


def test_query(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()
    found = {r["page_id"]: r for r in catalog.QUERIES["op10_url_gbt"](spark, SMALL).collect()}
    assert len(found) == len(pages)
    for r in pages:
        rule, verdict = ruled(*cut(r["url"]))
        got = found[r["page_id"]]
        assert (got["host"], got["path"], got["rule"]) == (*cut(r["url"]), rule)
        assert got["verdict"] == (verdict or ("block" if got["block_score"] > 0.5 else "allow"))


def test_trees_learn_labels_on_held_out_urls(spark):
    """Rules of a made-up kind: a host that they never name is judged like those it resembles."""
    rules = (("good.org", "/", "allow"), ("x7-9a4-k2.biz", "/", "block"))
    rows = []
    for k in range(600):
        rows.append((3 * k, f"https://www{k % 5}.good.org/articles/story-{k}"))
        rows.append((3 * k + 1, f"http://q{k}z{k * 7 % 97}.x7-9a4-k2.biz/{k * 37 % 1000}/{k}?id={k}&a=1&b=2"))
        rows.append((3 * k + 2, f"http://p{k}w{k * 5 % 89}.k9-3b1-z8.biz/{k * 31 % 1000}/{k}?id={k}&a=3&b=4" if k % 2 else f"https://www{k % 5}.fine.org/articles/note-{k}"))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = {r["page_id"]: r for r in url_gbt.judge(pages, rules=rules).collect()}
    right = sum(found[3 * k + 2]["verdict"] == ("block" if k % 2 else "allow") for k in range(600))
    assert right > 570


def test_one_verdict_alone_and_no_rows(spark):
    only = spark.createDataFrame([(1, "http://a.com/x"), (2, "http://b.org/x")], "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in url_gbt.judge(only).collect()} == {1: "allow", 2: "allow"}
    blocked = spark.createDataFrame([(1, "http://a.net/es/x"), (2, "http://b.org/x")], "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in url_gbt.judge(blocked).collect()} == {1: "block", 2: "block"}
    assert url_gbt.judge(only.limit(0)).count() == 0


def test_entropy(spark):
    words = ["", "a", "aab", "héllo.wörld", "....", "1234"]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    for r in df.select("t", url_gbt.entropy(df["t"]).alias("e")).collect():
        n = Counter(r["t"])
        assert r["e"] == pytest.approx(-sum(c / len(r["t"]) * math.log2(c / len(r["t"])) for c in n.values()) if r["t"] else 0.0)
