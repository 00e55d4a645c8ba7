"""Address functions, table-driven."""

from urllib.parse import urljoin

import pytest
from hypothesis import HealthCheck, example, given, settings, strategies as st
from pyspark.sql import functions as F

from sitetext.functions.links import ranked_links, site_links, without_homepage
from sitetext.functions.sql import bind
from sitetext.functions.urls import (
    base_parts,
    normalize_url,
    path_depth,
    resolve_url,
    score_path,
    url_path,
    url_slug,
)

HIGH, LOW = ("tide", "pier", "crew"), ("archive", "log")


def values(spark, function, inputs):
    """The function's value for each input, in one job."""
    rows = spark.createDataFrame(list(enumerate(inputs)), "n int, x string")
    got = dict(rows.select("n", F.expr(function("x"))).collect())
    return [got[n] for n in range(len(inputs))]


def check(spark, function, cases):
    assert dict(zip(cases, values(spark, function, list(cases)))) == cases


def test_normalize_url(spark):
    check(spark, normalize_url, {
        "harbour.test": "https://harbour.test",
        "https://harbour.test/": "https://harbour.test",
        "http://harbour.test:81/": "http://harbour.test:81",
        "harbour.test/tides/today/": "https://harbour.test/tides/today",
        "https://harbour.test/tides#noon": "https://harbour.test/tides",
        "http://harbour.test/find?pier=4&x": "http://harbour.test/find?pier=4&x",
        "HTTPS://Example.com/A//?": "https://Example.com/A",
        "https://x.com/a/?b=/": "https://x.com/a?b=/",
        "https://x.com/a/;p?x#y": "https://x.com/a;p?x",
        "https://x.com/a|b": "https://x.com/a|b",
        "https://a_b.com:80/": "https://a_b.com:80",
        "x.com?u=http://y": "x.com?u=http://y",
    })


def test_url_slug(spark):
    check(spark, url_slug, {
        "http://harbour.test": "home",
        "http://harbour.test/": "home",
        "http://harbour.test/fees": "fees",
        "http://harbour.test/de/piers/north-4": "north-4",
        "http://harbour.test/crew/": "crew",
        "https://example.com/a;x?y#z": "a",
        "https://example.com//": "home",
    })


def test_score_path(spark):
    check(spark, lambda p: score_path(p, HIGH, LOW), {
        "/tides-north": 2, "/pier": 2, "/archive": -1, "/fees": 0, "/Crew-List": 2,
        "/log/of/the/crew": 2, "/riptide": 2, "/catalog": -1, "": 0,
    })
    assert values(spark, lambda p: score_path(p, ("About",), ()), ["/About"]) == [0]
    assert values(spark, lambda p: score_path(p, ("c++", ".net"), ()), ["/c++", "/xnet", "/.net"]) == [2, 0, 2]


def test_path_depth(spark):
    check(spark, lambda u: path_depth(url_path(u)), {
        "https://x.com": 0, "https://x.com/about": 1, "https://x.com/about/": 2, "https://x.com/a?b/c": 1,
    })


BASES = ["https://x.com", "https://x.com/en/about", "https://x.com/a?q=1", "http://x.com/en//b/c", "https://x.com/en/"]
REFERENCES = [
    "", "a", "/a", "./a", "../a", "../../../a", "/a/../b", "/a/./b/", "?x=1", "?", "#t", "#",
    "//o.com/p", "//o.com", "https://z.com/a", "HTTPS://z.com/a", "HTTP://z.com/a", "https:foo",
    "mailto:a@b", "a/b/../c", ".", "..", "./", "../", "a/..", "/a/..", "/..", "a//b", "/a//b",
    "//", "///", "///b", "////b", "//?q", "//#t", "///?q", "///../b", "https:///b", "https://", "http:///b/./c", "//o.com//b",
    "a?x=/../y", "a#/../x", "/a?", "/a?#", "javascript:void(0)", "...", "/.well-known/x", "a..", "a;b", "/é/ü",
]


def resolved(spark, pairs):
    rows = spark.createDataFrame([(n, b, r) for n, (b, r) in enumerate(pairs)], "n int, b string, r string")
    link = bind(base_parts("b"), lambda b: resolve_url(b, "r"))
    got = dict(rows.select("n", F.expr(link)).collect())
    return [got[n] for n in range(len(pairs))]


def test_resolve_url(spark):
    pairs = [(b, r) for b in BASES for r in REFERENCES]
    assert resolved(spark, pairs) == [urljoin(b, r) for b, r in pairs]


segments = st.lists(st.sampled_from(["a", "b.c", ".", "..", "", "x y"]), max_size=6).map("/".join)


@settings(max_examples=4, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(segments, segments), min_size=30, max_size=60))
@example([("", "/"), ("a", "//"), ("a/b", "//a"), ("", "/b.c/.."), ("a", "..//")])
def test_resolve_url_on_random_paths(spark, paths):
    pairs = [(f"https://x.com/{base}", ref) for base, ref in paths if ":" not in ref]
    # Only absolute base paths without dot segments occur: they come from captured addresses.
    pairs = [(b, r) for b, r in pairs if "/." not in b]
    if pairs:
        assert resolved(spark, pairs) == [urljoin(b, r) for b, r in pairs]


def lists(spark, function, links):
    return spark.createDataFrame([(links,)], "l array<string>").select(F.expr(function("l"))).first()[0]


@pytest.mark.parametrize("links,kept", [
    (["https://example.com/chart.zip", "https://example.com/tides"], ["https://example.com/tides"]),
    (["https://weather.test/n", "http://example.com/pier"], ["http://example.com/pier"]),
    (["https://www.example.com/crew", "https://www.example.com/crew"], ["https://www.example.com/crew"]),
    (["sftp://example.com/x", "tel:5", "https://example.com/x"], ["https://example.com/x"]),
    (["https://example.com/a.PDF?x", "https://example.com/a.pdf/", "https://example.com/v1.2/a"],
     ["https://example.com/a.pdf/", "https://example.com/v1.2/a"]),
    (["https://Example.com/a", "https://sub.example.com/a", "https://example.com:8080/a", "HTTPS://example.com/a"],
     ["HTTPS://example.com/a"]),
    (["https://example.com/a", "https://example.com/a#b"], ["https://example.com/a", "https://example.com/a#b"]),
    ([], []),
])
def test_site_links(spark, links, kept):
    assert lists(spark, lambda l: site_links(l, "'example.com'"), links) == kept


def test_without_homepage(spark):
    links = ["https://x.com/", "https://x.com/#a", "http://x.com", "https://www.x.com", "https://x.com/b"]
    got = lists(spark, lambda l: without_homepage(l, "'https://x.com'"), links)
    assert got == ["http://x.com", "https://www.x.com", "https://x.com/b"]


URLS = [f"https://x.com/{p}" for p in ("log", "map", "archive/2", "crew", "deep/pier/4", "tide", "fees")]


def test_ranked_links(spark):
    def ranked(links, limit=None):
        return lists(spark, lambda l: ranked_links(l, HIGH, LOW, limit), links)

    order = ["crew", "tide", "deep/pier/4", "map", "fees", "log", "archive/2"]
    assert ranked(URLS) == [f"https://x.com/{p}" for p in order]
    assert ranked(URLS, 3) == [f"https://x.com/{p}" for p in order[:3]]
    assert ranked(URLS, 0) == [] and ranked(URLS[:1], 9) == URLS[:1]
