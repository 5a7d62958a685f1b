"""Candidates of long hosts, and rules of every shape against a plain search."""

import time

from paytrail.llm import bloom_cascade

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("a.example.net", "block"), ("/only", "block"), ("org/fr/", "allow")]
LISTED = ["bad.org", "x.y.z.com", "net"]
URLS = ["http://a.example.net/en/1", "http://example.net/en/1", "http://net/", "http://net", "http://b.net/q", "http://x.bad.org/fr/",
        "http://bad.org", "http://w.x.y.z.com/", "http://y.z.com/", "http:///only/this", "http://com./only", "no url", None, "",
        "http://" + "l." * 6000 + "example.net/en/x", "http://" + "l." * 6000 + "bad.org?q"]


def _plain(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:end].lower(), rest[end:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = []
    for rule, verdict in RULES:
        h, p = (rule.split("/", 1)[0], "/" + rule.split("/", 1)[1]) if "/" in rule else (rule, "")
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(rule), verdict, rule))
    if fits:
        return max(fits)[1:]
    listed = any(host == k or host.endswith("." + k) for k in LISTED)
    return ("block" if listed else "allow"), None


def test_rules_of_every_shape_and_long_hosts(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id int, url string")
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    listed = spark.createDataFrame([(k,) for k in LISTED], "key string")
    start = time.time()
    got = {r.page_id: (r.verdict, r.rule) for r in bloom_cascade.judge(pages, rules, listed).collect()}
    assert got == {i: _plain(u) for i, u in enumerate(URLS)}
    assert time.time() - start < 60
    none = bloom_cascade.judge(pages, rules.limit(0), listed.limit(0)).collect()
    assert {(r.verdict, r.rule) for r in none} == {("allow", None)} and len(none) == len(URLS)
    assert bloom_cascade.judge(pages.limit(0), rules, listed).count() == 0
