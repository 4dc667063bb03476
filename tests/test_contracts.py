"""One small hand-made table per semantic contract (C1-C16 of the survey)."""

from __future__ import annotations

import glob
import os

import pytest
from conftest import write_hits

from clickcredit.operators.attribution import (keyword_revenue, keyword_revenue_exact,
                                               keyword_revenue_join, search_sessions_any,
                                               visitor_sessions)
from clickcredit.operators.enrich import enrich_hits
from clickcredit.sinks.report import write_partitioned_report, write_report
from clickcredit.sources.hits import read_hits

G = "http://www.google.com/search?q="
B = "http://www.bing.com/search?q="


def buy(ip, price, qty=1, t=None):
    row = {"ip": ip, "event_list": "1", "product_list": f"Electronics;X;{qty};{price};"}
    if t is not None:
        row["hit_time_gmt"] = t
    return row


def touch(ip, ref, t=None):
    row = {"ip": ip, "referrer": ref}
    if t is not None:
        row["hit_time_gmt"] = t
    return row


def report(spark, folder, rows, **kw):
    hits = read_hits(spark, write_hits(folder, rows))
    case = kw.pop("case_sensitive", False)
    return [(r.domain, r.keyword, r.revenue)
            for r in keyword_revenue(enrich_hits(hits, case_sensitive=case), **kw).collect()]


def test_c1_last_and_first_touch(spark, tmp_dir):
    rows = [touch("a", G + "one", 10), touch("a", B + "two", 30), touch("a", G + "three", 20),
            buy("a", 10, t=40)]
    assert report(spark, tmp_dir, rows) == [("bing.com", "two", 10.0)]
    assert report(spark, tmp_dir, rows, attribution="first") == [("google.com", "one", 10.0)]


def test_c1_tie_on_time_is_deterministic(spark, tmp_dir):
    rows = [touch("a", G + "zz", 10), touch("a", G + "aa", 10), buy("a", 5, t=11)]
    assert report(spark, tmp_dir, rows) == [("google.com", "zz", 5.0)]
    assert report(spark, tmp_dir, rows, attribution="first") == [("google.com", "aa", 5.0)]


def test_c1_touch_without_a_time_loses(spark):
    from clickcredit.schema import HIT_SCHEMA
    hit = lambda t, ref, event=None, plist=None: (
        t, None, None, "a", event, None, None, None, None, None, plist, ref)
    rows = [hit(None, G + "zz-untimed"), hit(10, G + "one"), hit(20, G + "two"), hit(None, B + "aa-untimed"),
            hit(30, None, "1", "E;X;1;10;")]
    hits = enrich_hits(spark.createDataFrame(rows, HIT_SCHEMA))
    for how, want in (("first", "one"), ("last", "two")):
        assert [r.keyword for r in keyword_revenue(hits, attribution=how).collect()] == [want]
    untimed = enrich_hits(spark.createDataFrame([rows[0], rows[-1]], HIT_SCHEMA))
    assert [r.keyword for r in keyword_revenue(untimed, attribution="first").collect()] == ["zz-untimed"]


def test_c2_purchase_before_search_still_credited(spark, tmp_dir):
    rows = [buy("a", 7, t=1), touch("a", G + "late", 2)]
    assert report(spark, tmp_dir, rows) == [("google.com", "late", 7.0)]


def test_c3_blank_ip_in_file_is_null_and_dropped(spark, tmp_dir):
    # The CSV reader turns both an empty and a quoted-empty field into null.
    rows = [touch(None, G + "x"), buy(None, 5), touch('""', G + "y"), buy('""', 3),
            touch("k", G + "z"), buy("k", 1)]
    assert report(spark, tmp_dir, rows) == [("google.com", "z", 1.0)]


def test_c3_empty_string_ip_is_a_key(spark):
    from clickcredit.schema import HIT_SCHEMA
    data = [(1, None, None, "", None, None, None, None, None, None, None, G + "y"),
            (2, None, None, "", "1", None, None, None, None, None, "E;X;1;3;", None),
            (3, None, None, None, "1", None, None, None, None, None, "E;X;1;4;", None)]
    hits = spark.createDataFrame(data, HIT_SCHEMA)
    got = [(r.domain, r.keyword, r.revenue) for r in keyword_revenue(enrich_hits(hits)).collect()]
    assert got == [("google.com", "y", 3.0)]


def test_c4_scheme_less_referrer(spark, tmp_dir):
    rows = [touch("a", "www.google.com/search?q=ipod"), buy("a", 5)]
    assert report(spark, tmp_dir, rows) == []
    assert report(spark, tmp_dir, rows, strict=False) == [("", "ipod", 5.0)]


def test_c5_blank_keyword(spark, tmp_dir):
    rows = [touch("a", G + "real", 1), touch("a", G + "+", 2), buy("a", 5, t=3)]
    # strict: the blank touch is not a touch, the earlier one stays
    assert report(spark, tmp_dir, rows) == [("google.com", "real", 5.0)]
    # lax: the blank keyword is a valid (later) touch
    assert report(spark, tmp_dir, rows, strict=False) == [("google.com", "", 5.0)]


@pytest.mark.parametrize("plist", ["Electronics;X;1", "Electronics;X;1;", "Electronics;X",
                                   "Electronics;X;1.5;10;", "Electronics;X;;10;", ""])
def test_c6_short_or_bad_product_list_is_zero(spark, tmp_dir, plist):
    rows = [touch("a", G + "k"), {"ip": "a", "event_list": "1", "product_list": plist}]
    assert report(spark, tmp_dir, rows) == []


def test_c7_money_is_exact(spark, tmp_dir):
    rows = [touch("a", G + "k")] + [buy("a", "99.99")] * 3 + [touch("b", G + "k"), buy("b", "0.1"),
                                                               buy("b", "0.2")]
    assert report(spark, tmp_dir, rows) == [("google.com", "k", 300.27)]


@pytest.mark.parametrize("price", ["NaN", "nan", "inf", "-inf", "1d", "0x10", "1_0"])
def test_c8_non_numeric_price_is_zero(spark, tmp_dir, price):
    rows = [touch("a", G + "k"), buy("a", price)]
    assert report(spark, tmp_dir, rows) == []


def test_c8_numeric_forms(spark, tmp_dir):
    rows = [touch("a", G + "k"), buy("a", " 1e2 "), buy("a", ".5"), buy("a", "+2."), buy("a", "3", qty=" +2 ")]
    assert report(spark, tmp_dir, rows) == [("google.com", "k", 108.5)]


def _report_text(folder):
    part = glob.glob(os.path.join(folder, "**", "part-*.csv"), recursive=True)
    assert len(part) == 1
    with open(part[0], newline="") as f:
        return f.read()


def test_c9_c10_c16_text_order_and_line_endings(spark, tmp_dir):
    rows = [touch("a", G + "b"), buy("a", 5), touch("b", B + "a"), buy("b", 5),
            touch("c", G + "a"), buy("c", "12.5")]
    hits = enrich_hits(read_hits(spark, write_hits(tmp_dir, rows)))
    out = os.path.join(tmp_dir, "out")
    write_report(keyword_revenue_exact(hits), out)
    assert _report_text(out) == ("Search Engine Domain\tSearch Keyword\tRevenue\n"
                                 "google.com\ta\t12.50\n"
                                 "bing.com\ta\t5.00\n"
                                 "google.com\tb\t5.00\n")


def test_c11_empty_result_writes_header_only(spark, tmp_dir):
    rows = [touch("a", G + "k")]
    hits = enrich_hits(read_hits(spark, write_hits(tmp_dir, rows)))
    out = os.path.join(tmp_dir, "out")
    write_report(keyword_revenue_exact(hits), out)
    assert _report_text(out) == "Search Engine Domain\tSearch Keyword\tRevenue\n"


def test_c12_keyword_case(spark, tmp_dir):
    rows = [touch("a", G + "IPod"), buy("a", 1), touch("b", G + "ipod"), buy("b", 2)]
    assert report(spark, tmp_dir, rows) == [("google.com", "ipod", 3.0)]
    assert report(spark, tmp_dir, rows, case_sensitive=True) == [("google.com", "ipod", 2.0),
                                                                  ("google.com", "IPod", 1.0)]


def test_c13_quoted_field_with_tab(spark, tmp_dir):
    rows = [dict(touch("a", G + "k"), user_agent='"Mozilla\t(KHTML, like Gecko)"'), buy("a", 4)]
    hits = read_hits(spark, write_hits(tmp_dir, rows))
    assert hits.where("user_agent IS NOT NULL").first().user_agent == "Mozilla\t(KHTML, like Gecko)"
    assert report(spark, tmp_dir, rows) == [("google.com", "k", 4.0)]


def test_c14_short_rows_are_null(spark, tmp_dir):
    path = os.path.join(tmp_dir, "short.tsv")
    with open(path, "w") as f:
        f.write("hit_time_gmt\tdate_time\tuser_agent\tip\tevent_list\tgeo_city\tgeo_region\t"
                "geo_country\tpagename\tpage_url\tproduct_list\treferrer\n")
        f.write("1\t2024-01-01 00:00:00\tua\t1.2.3.4\t1\n")
    row = read_hits(spark, path).first()
    assert row.ip == "1.2.3.4" and row.event_list == "1" and row.referrer is None


def test_c15_same_day_runs_do_not_overwrite(spark, tmp_dir):
    root = os.path.join(tmp_dir, "tgt")
    for name, kw in [("file_a", "alpha"), ("file_b", "beta")]:
        folder = os.path.join(tmp_dir, name)
        os.makedirs(folder)
        hits = enrich_hits(read_hits(spark, write_hits(folder, [touch("a", G + kw), buy("a", 1)])))
        write_partitioned_report(keyword_revenue_exact(hits), root, "2026-03-06", name)
    parts = sorted(glob.glob(os.path.join(root, "year=2026", "month=03", "date=06", "*")))
    assert [os.path.basename(p) for p in parts] == ["source_name=file_a", "source_name=file_b"]


def test_sessions_scoped_per_file(spark, tmp_dir):
    write_hits(tmp_dir, [touch("a", G + "x")], name="one.tsv")
    write_hits(tmp_dir, [buy("a", 9)], name="two.tsv")
    hits = enrich_hits(read_hits(spark, tmp_dir))
    per_file = keyword_revenue(hits, session_keys=("source_file", "ip")).collect()
    whole = keyword_revenue(hits).collect()
    assert per_file == [] and len(whole) == 1


def test_join_form_equals_session_form_with_hot_visitor(spark, tmp_dir):
    rows = [touch("hot", G + "k", 1)] + [buy("hot", i % 7 + 1, t=i + 2) for i in range(300)]
    rows += [touch(f"v{i}", B + f"w{i % 5}", 1) for i in range(40)] + [buy(f"v{i}", i + 1, t=5) for i in range(40)]
    hits = enrich_hits(read_hits(spark, write_hits(tmp_dir, rows)))
    a = sorted(keyword_revenue(hits).collect())
    b = sorted(keyword_revenue_join(hits).collect())
    assert a == b


def test_search_sessions_any_is_one_row_per_visitor(spark, tmp_dir):
    rows = [touch("a", G + "x"), touch("a", B + "y"), touch("b", G + "z")]
    hits = enrich_hits(read_hits(spark, write_hits(tmp_dir, rows)))
    assert sorted(r.ip for r in search_sessions_any(hits).collect()) == ["a", "b"]


def test_visitor_sessions_keeps_buyers_without_touch(spark, tmp_dir):
    rows = [buy("a", 3), touch("b", G + "x")]
    hits = enrich_hits(read_hits(spark, write_hits(tmp_dir, rows)))
    got = {r.ip: (r.domain, r.revenue is not None) for r in visitor_sessions(hits).collect()}
    assert got == {"a": (None, True), "b": ("google.com", False)}


def test_report_without_single_file_is_globally_ordered(spark, tmp_dir):
    rows = []
    for i in range(40):
        rows += [touch(f"v{i}", G + f"k{i}"), buy(f"v{i}", i + 1)]
    hits = enrich_hits(read_hits(spark, write_hits(tmp_dir, rows)))
    out = os.path.join(tmp_dir, "out")
    write_report(keyword_revenue_exact(hits), out, single_file=False)
    parts = sorted(glob.glob(os.path.join(out, "part-*.csv")))
    lines = []
    for part in parts:
        with open(part) as f:
            body = f.read().splitlines()
        assert body[0] == "Search Engine Domain\tSearch Keyword\tRevenue"
        lines += body[1:]
    revenues = [float(line.split("\t")[2]) for line in lines]
    assert len(revenues) == 40 and revenues == sorted(revenues, reverse=True)


def test_c15_rerun_replaces_only_its_partition(spark, tmp_dir):
    root = os.path.join(tmp_dir, "tgt")
    for name, kw in [("file_a", "alpha"), ("file_b", "beta"), ("file_a", "gamma")]:
        folder = os.path.join(tmp_dir, f"{name}-{kw}")
        os.makedirs(folder)
        hits = enrich_hits(read_hits(spark, write_hits(folder, [touch("a", G + kw), buy("a", 1)])))
        write_partitioned_report(keyword_revenue_exact(hits), root, "2026-03-06", name)
    base = os.path.join(root, "year=2026", "month=03", "date=06")
    got = {}
    for src in ("file_a", "file_b"):
        (part,) = glob.glob(os.path.join(base, f"source_name={src}", "part-*.csv"))
        got[src] = open(part).read().splitlines()[1].split("\t")[1]
    assert got == {"file_a": "gamma", "file_b": "beta"}
