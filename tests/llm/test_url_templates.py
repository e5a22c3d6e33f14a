import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from mattercat.llm import url_templates as u

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    stop = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    return host, path[:stop]


def plain_rule(host, path):
    fits = [r for r, _ in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits, key=len, default=None)


URLS = [None, "", "no scheme/x", "http://", "HTTP://A.Example.NET/en/1?x#y", "https://example.net/EN/1", "https://net", "http://net/",
        "http://example.com/de/5", "http://xexample.com/de/5", "http://a.org/fr/", "http://a.org/fr", "http://a.org?x=/fr/", "http://ÄB.org/fr/é\nz#q",
        "x://y://z/w", "http://example.com/en/5"]


def test_parts_and_rules(spark):
    rows = u.filter_urls(spark.createDataFrame([(i, x, "k") for i, x in enumerate(URLS)], "page_id int, url string, host string"), RULES).collect()
    got = {r.page_id: (r.host, r.path, r.rule) for r in rows}
    want = {i: (*plain_parts(x), plain_rule(*plain_parts(x))) for i, x in enumerate(URLS)}
    assert got == want
    assert all(r.verdict == dict(RULES)[r.rule] for r in rows if r.rule)


@pytest.mark.parametrize("path, want", [
    ("/en/15", "en/{n}//"), ("/a/15.html", "a/{n}.html//"), ("/deadbeef01/x", "{x}/x//"), ("/post-12/", "{i}///"), ("", "///"), ("/a/b/c/d/e/f", "a/b/c/d/{**}"),
])
def test_segment_shapes(spark, path, want):
    got = spark.createDataFrame([(path,)], "path string").select(F.concat_ws("/", u.segments(F.col("path")))).first()[0]
    assert got.rstrip("/") == want.rstrip("/")


def test_templates_are_generalised_merged_and_judged(spark):
    rules = [("bad.example/spam", "block"), ("bad.example/fine", "allow")]
    urls = [f"http://bad.example/spam{i}/page" for i in range(40)]  # variable: many values, one url each
    urls += [f"http://bad.example/fine/{i}" for i in range(20)] + ["http://bad.example/new/1", "http://other.example/a"]
    rows = u.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id int, url string"), rules).collect()
    by = {r.path: r for r in rows}
    assert by["/spam3/page"].verdict == "block" and by["/fine/3"].verdict == "allow"
    assert Counter(r.verdict for r in rows if r.rule is None) == {"allow": 2}
    assert by["/spam3/page"].purity > 0.8 > by["/fine/3"].purity


def test_unlabelled_urls_of_a_rejected_template_are_blocked(spark):
    # The rule names words; others at the same place are one template with them, as that position varies.
    rules = [("shop.example/buy-a", "block")]
    urls = [f"http://shop.example/buy-a{w}" for w in "bcdefghijklm"] + [f"http://shop.example/buy-{w}" for w in "no"]
    rows = u.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id int, url string"), rules).collect()
    assert {r.verdict for r in rows} == {"block"} and {r.template for r in rows} == {"{*}"}


def test_nulls_repeats_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, None), (1, "http://a/b"), (1, "http://a/b")], "page_id int, url string")
    assert sorted((r.page_id or 0, r.verdict) for r in u.filter_urls(rows, RULES).collect()) == [(0, "allow"), (1, "allow"), (1, "allow")]
    assert u.filter_urls(rows.limit(0), RULES).collect() == []


def plain_shape(segment):
    ending = re.search(r"\.[a-z]{2,5}$", segment)
    stem, end = (segment[: ending.start()], ending[0]) if ending else (segment, "")
    if re.fullmatch(r"[0-9]+", stem):
        return "{n}" + end
    if re.search(r"[0-9]", segment) and re.fullmatch(r"[0-9a-fA-F-]{8,}", stem):
        return "{x}" + end
    return "{i}" if re.search(r"[0-9]", segment) else segment


def plain_filter(urls, strength=4.0, limit=0.5, z=1.96):
    """The method over dictionaries: ``(host, path, rule, verdict, template)`` of each url."""
    rows = []
    for url in urls:
        host, path = plain_parts(url)
        parts = [s for s in path.split("/") if s]
        template = ([plain_shape(s) for s in parts[: u.DEPTH]] + [""] * u.DEPTH)[: u.DEPTH] + ["{**}" if len(parts) > u.DEPTH else ""]
        rows.append({"host": host, "path": path, "rule": plain_rule(host, path), "t": template})
    ruled = lambda r: dict(RULES).get(r["rule"])
    total = lambda group: (sum(ruled(r) == "block" for r in group), sum(r["rule"] is not None for r in group))
    for level in range(u.DEPTH):
        nodes = defaultdict(lambda: defaultdict(list))
        for r in rows:
            nodes[r["host"], tuple(r["t"][:level])][r["t"][level]].append(r)
        for branches in nodes.values():
            everything = [r for group in branches.values() for r in group]
            bad, seen = total(everything)
            mean = (bad + 1) / (seen + 2)
            variable = len(branches) >= u.VARIED and len(everything) < u.REPEATS * len(branches)
            for value, group in branches.items():
                blocked, labelled = total(group)
                similar = 0 < labelled < seen and abs(blocked / labelled - mean) <= z * math.sqrt(mean * (1 - mean) / labelled)
                if value not in ("", "{n}", "{x}", "{i}", "{**}") and (variable or similar):
                    for r in group:
                        r["t"][level] = "{*}" if variable else "{=}"
    bad, seen = total(rows)
    share, hosts, leaves = bad / max(1, seen), defaultdict(list), defaultdict(list)
    for r in rows:
        hosts[r["host"]].append(r)
        leaves[r["host"], "/".join(r["t"])].append(r)
    for r in rows:
        b, n = total(hosts[r["host"]])
        above = (b + strength * share) / (n + strength)
        b, n = total(leaves[r["host"], "/".join(r["t"])])
        r["verdict"] = ruled(r) or ("block" if n and (b + strength * above) / (n + strength) > limit else "allow")
    return [(r["host"], r["path"], r["rule"], r["verdict"], "/".join(s for s in r["t"] if s)) for r in rows]


def test_against_plain_python(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rng = random.Random(3)
    more = [f"http://h{rng.randrange(3)}.example.{rng.choice(['net', 'com', 'org'])}/{rng.choice(['en', 'de', 'fr'])}/"
            f"{rng.choice(['news', 'shop', ''.join(rng.choice('abcdefgh') for _ in range(4))])}/{rng.choice(['x', 'y', str(rng.randrange(99)), 'p/q/r/s'])}" for _ in range(400)]
    rows = [(r.page_id, r.url) for r in pages.collect()] + [(1000 + i, x) for i, x in enumerate([*more, *URLS])]
    want = dict(zip([i for i, _ in rows], plain_filter([x for _, x in rows])))
    got = u.filter_urls(spark.createDataFrame(rows, "page_id bigint, url string"), RULES).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict, r.template) for r in got} == want
    assert "{*}" in str(want) and "{=}" in str(want)
