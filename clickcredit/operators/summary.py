"""Report summary, per-domain / per-keyword totals and top-k lists.

All of these take the exact (decimal) report so totals do not depend on the
order in which floating-point values are added; the limbs are joined as doubles last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .money import total


def report_summary(report_exact: DataFrame) -> DataFrame:
    """One row: rows, total revenue, distinct domains, distinct keywords.

    An empty report gives zeros (``coalesce`` on the sum).
    """
    return report_exact.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.coalesce(total(report_exact), F.lit(0.0)).alias("total_revenue"),
        F.count_distinct("domain").alias("unique_domains"),
        F.count_distinct("keyword").alias("unique_keywords"),
    )


def _totals(report_exact: DataFrame, key: str) -> DataFrame:
    return report_exact.groupBy(key).agg(total(report_exact).alias("revenue"))


def domain_revenue(report_exact: DataFrame) -> DataFrame:
    return _totals(report_exact, "domain")


def keyword_totals(report_exact: DataFrame) -> DataFrame:
    return _totals(report_exact, "keyword")


def top_n(totals: DataFrame, key: str, n: int = 5) -> DataFrame:
    """Top ``n`` by revenue; ties broken by the key. The limit is the feature.

    ``orderBy().limit()`` plans as ``TakeOrderedAndProject``: each task keeps
    only its own top ``n`` and the driver merges ``n x tasks`` rows.
    """
    return totals.orderBy(F.col("revenue").desc(), F.col(key)).limit(n)


def top_domains(report_exact: DataFrame, n: int = 5) -> DataFrame:
    return top_n(domain_revenue(report_exact), "domain", n)


def top_keywords(report_exact: DataFrame, n: int = 5) -> DataFrame:
    return top_n(keyword_totals(report_exact), "keyword", n)


def report_rollup(report_exact: DataFrame) -> DataFrame:
    """Per-domain, per-keyword and grand totals in one aggregation (grouping sets).

    Rows: ``level`` ``domain`` / ``keyword`` / ``total``, ``name`` (the domain or
    keyword; null for the total), ``revenue``. One pass over the report instead
    of one per total; the grouping id tells the levels apart (a null domain or
    keyword in the data cannot be mistaken for a rolled-up row).
    """
    g = report_exact.groupingSets([["domain"], ["keyword"], []], "domain", "keyword").agg(
        total(report_exact).alias("revenue"), F.grouping_id().alias("_g"))
    level = (F.when(F.col("_g") == 1, "domain").when(F.col("_g") == 2, "keyword")
             .otherwise("total"))
    name = F.when(F.col("_g") == 1, F.col("domain")).when(F.col("_g") == 2, F.col("keyword"))
    return g.select(level.alias("level"), name.alias("name"), "revenue")
