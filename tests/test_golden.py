"""Report on the three sample files, compared with the expected report rows."""

from __future__ import annotations

import glob
import os

import pytest
from conftest import write_sample

from clickcredit.operators.attribution import (keyword_revenue, keyword_revenue_exact,
                                               keyword_revenue_join)
from clickcredit.operators.enrich import enrich_hits
from clickcredit.sinks.report import write_report
from clickcredit.sources.hits import read_hits

LOWER = {
    "original": [("google.com", "ipod", 480.0), ("bing.com", "zune", 250.0)],
    "quantity": [("google.com", "ipod", 960.0), ("bing.com", "zune", 500.0)],
    "test": [("google.com", "ipod", 575.0), ("bing.com", "zune", 50.0)],
}
CASE_KEPT = {
    "original": [("google.com", "Ipod", 290.0), ("bing.com", "Zune", 250.0), ("google.com", "ipod", 190.0)],
    "quantity": [("google.com", "Ipod", 580.0), ("bing.com", "Zune", 500.0), ("google.com", "ipod", 380.0)],
    "test": [("google.com", "Ipod", 500.0), ("google.com", "ipod", 75.0), ("bing.com", "Zune", 50.0)],
    "order": [("bing.com", "Zune", 250.0), ("google.com", "ipod", 190.0), ("google.com", "Ipod", 100.0)],
}


def _rows(df):
    return [(r.domain, r.keyword, r.revenue) for r in df.collect()]


@pytest.mark.parametrize("variant", sorted(LOWER))
def test_lower_case_report(spark, tmp_dir, variant):
    hits = read_hits(spark, write_sample(tmp_dir, variant))
    assert _rows(keyword_revenue(enrich_hits(hits))) == LOWER[variant]


@pytest.mark.parametrize("variant", sorted(CASE_KEPT))
def test_case_kept_report(spark, tmp_dir, variant):
    hits = read_hits(spark, write_sample(tmp_dir, variant))
    assert _rows(keyword_revenue(enrich_hits(hits, case_sensitive=True))) == CASE_KEPT[variant]


@pytest.mark.parametrize("attribution", ["last", "first"])
def test_forms_agree_on_samples(spark, tmp_dir, attribution):
    hits = enrich_hits(read_hits(spark, write_sample(tmp_dir, "quantity")))
    a = sorted(_rows(keyword_revenue(hits, attribution=attribution)))
    b = sorted(_rows(keyword_revenue_join(hits, attribution=attribution)))
    assert a == b


def test_report_file_text(spark, tmp_dir):
    hits = enrich_hits(read_hits(spark, write_sample(tmp_dir, "original")), case_sensitive=True)
    out = os.path.join(tmp_dir, "report")
    write_report(keyword_revenue_exact(hits), out)
    parts = glob.glob(os.path.join(out, "part-*.csv"))
    assert len(parts) == 1
    with open(parts[0], newline="") as f:
        text = f.read()
    assert text == ("Search Engine Domain\tSearch Keyword\tRevenue\n"
                    "google.com\tIpod\t290.00\n"
                    "bing.com\tZune\t250.00\n"
                    "google.com\tipod\t190.00\n")


def test_yahoo_visitor_never_buys(spark, tmp_dir):
    hits = enrich_hits(read_hits(spark, write_sample(tmp_dir, "original")))
    domains = {r.domain for r in keyword_revenue(hits).collect()}
    assert "search.yahoo.com" not in domains


def test_rollup_on_sample(spark, tmp_dir):
    from clickcredit.operators.summary import report_rollup
    hits = enrich_hits(read_hits(spark, write_sample(tmp_dir, "original")))
    got = sorted((r.level, r.name or "", r.revenue) for r in report_rollup(keyword_revenue_exact(hits)).collect())
    assert got == [("domain", "bing.com", 250.0), ("domain", "google.com", 480.0),
                   ("keyword", "ipod", 480.0), ("keyword", "zune", 250.0), ("total", "", 730.0)]
