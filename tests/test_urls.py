"""Native URL expressions against Python's urllib.parse on generated URLs."""

from __future__ import annotations

from urllib.parse import parse_qs, unquote_plus, urlparse

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickcredit.functions import referrer_domain, referrer_keyword, referrer_params
from clickcredit.schema import SEARCH_PARAMS


def py_domain(url):
    if not url:
        return None
    d = urlparse(url).netloc.lower()
    return d[4:] if d.startswith("www.") else d


def py_keyword(url, lower=True):
    if not url:
        return None
    qs = parse_qs(urlparse(url).query)
    for name in SEARCH_PARAMS:
        if qs.get(name):
            kw = unquote_plus(qs[name][0]).strip()
            return kw.lower() if lower else kw
    return None


SCHEMES = ["http://", "https://", "//", "", "HTTP://", "ftp:", "a1+.-:", "1x://", " \thttp://"]
HOSTS = ["www.google.com", "Search.Yahoo.com:8080", "user:pw@host.org", "www.www.x.com", "",
         "esshopzilla.com", "WWW.Bing.com", "m.example.org"]
PATHS = ["", "/", "/search", "/a b", "/x;y", "/r\tt"]
NAMES = ["q", "Q", "query", "p", "search", "keywords", "k", "x", "%71", "q+", "", "k%20", "%71uery",
         "q%75%65ry", "%6B", "%6b", "%4B", "%6B%", "%2571", "se%61rch", "%70%", "+q", "%C5%B1"]
VALUES = ["Ipod", "", "+", "C%2B%2B", "100%", "%zz", "a+b", "%2520", " x ", "caf%C3%A9",
          "%E2%80%83y%C2%A0", "%ff", "=", "a=b", "%", "Key%20+1", "\u00a0z\u2003"]

pair = st.one_of(st.tuples(st.sampled_from(NAMES), st.sampled_from(VALUES)).map(lambda t: f"{t[0]}={t[1]}"),
                 st.sampled_from(["", "flag", "=x"]))
url = st.builds(
    lambda s, h, p, qs, has_q, frag: s + h + p + (("?" + "&".join(qs)) if has_q else "") + frag,
    st.sampled_from(SCHEMES), st.sampled_from(HOSTS), st.sampled_from(PATHS),
    st.lists(pair, max_size=5), st.booleans(), st.sampled_from(["", "#q=frag", "#", "#a?q=z"]))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(url, min_size=200, max_size=400))
def test_domain_and_keyword_match_urllib(spark, urls):
    urls = urls + ["", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = df.select("u", referrer_domain("u").alias("d"), referrer_keyword("u").alias("k"),
                    referrer_keyword("u", case_sensitive=True).alias("kc")).collect()
    for row in got:
        assert row.d == py_domain(row.u), row.u
        assert row.k == py_keyword(row.u), row.u
        assert row.kc == py_keyword(row.u, lower=False), row.u


def test_keyword_edge_cases(spark):
    cases = {
        "http://g.com/?q=C%2B%2B": "c",          # decoded twice
        "http://g.com/?q=100%": "100%",          # bare percent kept
        "http://g.com/?q=&p=x": "x",             # blank value dropped
        "http://g.com/?p=a&q=b": "b",            # list order beats URL order
        "http://g.com/#q=x": None,               # fragment is not searched
        "http://g.com/?q=+": "",                 # blank after strip
        "http://g.com/?q=a&q=b": "a",            # first value of a repeated name
        "http://g.com/?Q=a": None,               # names are case-sensitive
        "http://g.com/?%71=a": "a",              # names are decoded
        "http://g.com/?q=%2520x": " x",          # second decode
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    got = {r.u: r.k for r in df.select("u", referrer_keyword("u").alias("k")).collect()}
    for u, want in cases.items():
        assert got[u] == (want.strip() if want else want), u
    from clickcredit.functions.urls import with_search_keyword
    staged = {r.u: r.keyword for r in with_search_keyword(df, "u").collect()}
    assert staged == got


def test_params_follow_parse_qs(spark):
    u = "http://h/?a=1&b=&c&a=2&d=x%3Dy&e=a+b&=z"
    row = spark.createDataFrame([(u,)], "u string").select(referrer_params("u").alias("p")).first()
    got = [(x.name, x.value) for x in row.p]
    want = [(k, v) for k, vs in parse_qs(urlparse(u).query).items() for v in vs]
    assert sorted(got) == sorted(want)
    assert got[0] == ("a", "1") and got[1] == ("a", "2")
