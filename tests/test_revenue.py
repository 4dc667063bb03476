"""Revenue rule against a plain-Python statement of the same spec, on generated product lists."""

from __future__ import annotations

import math
import re
import tempfile
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickcredit.functions import line_price, line_revenue
from clickcredit.operators.attribution import (keyword_revenue, keyword_revenue_counted, keyword_revenue_exact,
                                               keyword_revenue_join, visitor_sessions)
from clickcredit.operators.enrich import enrich_hits
from clickcredit.operators.summary import domain_revenue, keyword_totals, report_rollup, report_summary
from clickcredit.sinks.report import report_text, write_report

NUMBER = re.compile(r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?")
INTEGER = re.compile(r"[+-]?[0-9]+")


def py_fields(product_list):
    """Quantity and price text of the first product, or None where malformed."""
    parts = product_list.split(";") if product_list is not None else []
    qty = parts[2].strip() if len(parts) > 2 else ""
    price = parts[3].strip() if len(parts) > 3 else ""
    return (qty if INTEGER.fullmatch(qty) else None), (price if NUMBER.fullmatch(price) else None)


def py_amount(product_list):
    """(amount, whether exact): quantity x price, the price at 10 places; beyond the exact types
    the product of the doubles, 0 from 1e50 on."""
    qty, price = py_fields(product_list)
    if qty is None or price is None:
        return Decimal(0), True
    value = Decimal(price).quantize(Decimal("1e-10"), rounding=ROUND_HALF_UP) if abs(Decimal(price)) < 10 ** 20 else None
    if value is not None and abs(value) < 10 ** 14 and abs(int(qty)) < 10 ** 13:
        return int(qty) * value, True
    far = float(qty) * float(price)
    return (Decimal(far) if abs(far) < 1e50 else Decimal(0)), False


QTY = ["1", "2", " 3 ", "9999999999999", "10000000000000", "-7", "+4", "-1", "0", "1.5", "", "x", " 7 ", "12345678901234567890"]
PRICE = ["250", "99.99", " 12.5 ", ".5", "5.", "1e2", "1E-2", "NaN", "inf", "1d", "", "-3", "0",
         "0.00005", "1.23456", "1_0", "99999999999999", "\t7\n", "1e15", "123456789012345.67", "1e27", "-1e16", "1e60",
         "1e400", "0.00000000005", "1e-300"]
product = st.builds(lambda cat, name, q, p, tail: ";".join([cat, name, q, p] + tail),
                    st.sampled_from(["Electronics", ""]), st.sampled_from(["Zune", "Ipod"]),
                    st.sampled_from(QTY), st.sampled_from(PRICE),
                    st.lists(st.sampled_from(["", "x", "Books;Y;1;5"]), max_size=2))
short = st.sampled_from(["", "Electronics", "Electronics;X", "Electronics;X;1", "E;X;1;", None])


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(product, short), min_size=100, max_size=200))
def test_revenue_matches_spec(spark, lists):
    df = spark.createDataFrame([(p,) for p in lists], "product_list string")
    hits = df.withColumns({"referrer": F.lit(None).cast("string"), "event_list": F.lit("1")})
    rows = enrich_hits(hits).withColumns({"line": line_revenue("product_list"), "price": line_price("product_list")})
    for row in rows.collect():
        want, exact = py_amount(row.product_list)
        got = row.revenue + (row.revenue_over or 0) * 10 ** 14
        assert abs(row.revenue) < 10 ** 14 and row.revenue_inexact == (not exact), row.product_list
        if exact:
            assert got == want, row.product_list
        else:
            assert abs(got - want) <= abs(want) * Decimal("1e-14") + Decimal("1e-10"), row.product_list
        assert row.line == pytest.approx(float(want), rel=1e-15), row.product_list
        price = py_fields(row.product_list)[1]
        assert row.price == (float(price) if price is not None and math.isfinite(float(price)) else 0.0), row.product_list


def session_of(spark, lines):
    """The report of one visitor with these (quantity, price) lines."""
    from clickcredit.schema import HIT_SCHEMA
    rows = [(1, None, None, "v", None, None, None, None, None, None, None, "http://g.com/?q=k")]
    rows += [(2, None, None, "v", "1", None, None, None, None, None, f"E;X;{q};{p};", None) for q, p in lines]
    return enrich_hits(spark.createDataFrame(rows, HIT_SCHEMA))


@pytest.mark.parametrize("lines,total,text", [
    ([("1", "1e15")], 1e15, "1000000000000000.00"),
    ([("1000000", "0.00001")], 10.0, "10.00"),
    ([("3", "99.99"), ("1", "0.005")], 299.975, "299.98"),
    ([("1", "99999999999999.99")] * 3, 299999999999999.97, "299999999999999.97"),
    ([("999999", "99999999999999.99"), ("1", "0.01")], 99999900000000000000.0, "99999899999999990000.02"),
    ([("1", "1e30"), ("1", "5")], 1e30, "1000000000000000000000000000005.00"),
    ([("1", "1e49")], 1e49, None),
    ([("1", "1e400"), ("1", "1")], 1.0, "1.00"),
])
def test_no_amount_is_capped(spark, lines, total, text):
    hits = session_of(spark, lines)
    (row,) = keyword_revenue(hits).collect()
    assert row.revenue == pytest.approx(total, rel=1e-15)
    exact = keyword_revenue_exact(hits)
    if text is not None:
        assert report_text(exact).first()[2] == text
    assert keyword_revenue_join(hits).first().revenue == row.revenue
    assert report_summary(exact).first().total_revenue == pytest.approx(total, rel=1e-15)
    (counted,) = keyword_revenue_counted(hits, file_keys=()).collect()
    assert counted.n_hits == len(lines) + 1
    assert counted.n_inexact == sum(p.startswith("1e") for _, p in lines)


def test_a_visitor_beyond_any_decimal(spark):
    """9.9e26 a line, a million lines' worth of it: more than DECIMAL(38,4) holds."""
    hits = session_of(spark, [("9999999999999", "99999999999999")] * 4000)
    big = hits.withColumn("revenue_over", F.col("revenue_over") * 10 ** 12)
    (s,) = visitor_sessions(big).collect()
    assert s.domain == "g.com" and s.revenue is not None and s.n_purchases == 4000
    want = 4000 * float(9999999999999 * 99999999999999) * 1e12
    assert keyword_revenue(big).first().revenue == pytest.approx(want, rel=1e-12) and want > 1e34
    assert report_summary(keyword_revenue_exact(big)).first().total_revenue == pytest.approx(want, rel=1e-12)


def test_large_amounts_are_ordered_by_both_limbs(spark):
    from clickcredit.schema import HIT_SCHEMA
    rows = []
    for i, price in enumerate(["5", "1e15", "99999999999999", "2e14", "1e30", "1.5e15"]):
        rows += [(1, None, None, f"v{i}", None, None, None, None, None, None, None, f"http://g.com/?q=k{i}"),
                 (2, None, None, f"v{i}", "1", None, None, None, None, None, f"E;X;1;{price};", None)]
    hits = enrich_hits(spark.createDataFrame(rows, HIT_SCHEMA))
    folder = tempfile.mkdtemp(prefix="clickcredit-test-")
    write_report(keyword_revenue_exact(hits), folder)
    got = spark.read.option("header", True).option("sep", "\t").csv(folder).collect()
    assert [r[1] for r in got] == ["k4", "k5", "k1", "k3", "k2", "k0"]
    assert [r.keyword for r in keyword_revenue(hits).collect()] == ["k4", "k5", "k1", "k3", "k2", "k0"]


def test_totals_beyond_decimal_are_kept(spark):
    top = Decimal(9) * Decimal(10) ** 33
    report = spark.createDataFrame([("d", "k", top), ("d", "k2", top), ("e", "k", top)],
                                   "domain string, keyword string, revenue decimal(38,4)")
    assert abs(report_summary(report).first().total_revenue / 2.7e34 - 1) < 1e-12
    got = {r.domain: r.revenue for r in domain_revenue(report).collect()}
    assert abs(got["d"] / 1.8e34 - 1) < 1e-12 and got["e"] == 9e33
    assert abs({r.keyword: r.revenue for r in keyword_totals(report).collect()}["k"] / 1.8e34 - 1) < 1e-12
    assert all(r.revenue is not None for r in report_rollup(report).collect())
