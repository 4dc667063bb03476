"""Hit enrichment and the two row filters (search hits, purchase hits)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_purchase, is_search_referral, is_search_referral_lax, normalize_keyword
from ..functions.products import (amount_sql, far_amount_sql, over_sql, price_field_sql,
                                  quantity_field_sql, revenue_sql)
from ..functions.urls import (clean_url_sql, domain_from_clean_sql, keyword_from_query_sql,
                              query_from_clean_sql)
from ..schema import DEFAULT_SITE, PURCHASE_EVENT
from .money import positive

ENRICHED_COLUMNS = ("domain", "search_keyword", "revenue", "revenue_over", "revenue_inexact",
                    "is_search_referral", "is_search_referral_lax", "is_purchase")


def enrich_hits(hits: DataFrame, site: str = DEFAULT_SITE, case_sensitive: bool = False) -> DataFrame:
    """Add domain, keyword, revenue and the flags in one projection chain.

    SQL text cannot share a subexpression, so text that several rules read is
    staged as a column first: the cleaned referrer (``_url``, for domain and
    query), the stripped quantity and price fields (``_qty``, ``_price``), the
    query string (``_query``) and its raw keyword value (``_raw_kw``, shared by
    the keyword and both flags). Catalyst keeps these projections apart
    because inlining them would repeat non-trivial expressions. Every rule
    supports code generation (no arrays or lambdas).
    """
    staged = hits.withColumns({
        "_url": F.expr(clean_url_sql("referrer")),
        "_qty": F.expr(quantity_field_sql("product_list")),
        "_price": F.expr(price_field_sql("product_list")),
    })
    step0 = staged.withColumns({
        "domain": F.expr(domain_from_clean_sql("referrer", "_url")),
        "_query": F.expr(query_from_clean_sql("_url")),
        "_amount": F.expr(amount_sql("_qty", "_price")),
    }).drop("_url")
    # Beyond the exact types (rare): the product as a double, and both limbs from what is known.
    step0 = step0.withColumn("_far", F.expr(far_amount_sql("_qty", "_price", "_amount"))).drop("_qty", "_price")
    step0 = step0.withColumns({
        "revenue": F.expr(revenue_sql("_amount", "_far")),
        "revenue_over": F.expr(over_sql("_amount", "_far")),
        "revenue_inexact": F.col("_far").isNotNull(),
    }).drop("_amount", "_far")
    step1 = step0.withColumn("_raw_kw", F.expr(
        "CASE WHEN referrer IS NOT NULL AND referrer <> '' THEN "
        f"{keyword_from_query_sql('_query')} END")).drop("_query")
    step2 = step1.withColumns({
        "search_keyword": normalize_keyword("_raw_kw", case_sensitive),
        "is_purchase": is_purchase("event_list"),
    })
    step3 = step2.withColumns({
        "is_search_referral": is_search_referral("referrer", "domain", "_raw_kw",
                                                 "search_keyword", site),
        "is_search_referral_lax": is_search_referral_lax("referrer", "domain", "_raw_kw", site),
    })
    return step3.drop("_raw_kw")


def search_flag(strict: bool) -> str:
    return "is_search_referral" if strict else "is_search_referral_lax"


def keep_where(df: DataFrame, flag: str) -> DataFrame:
    """Rows whose already computed boolean column ``flag`` is true.

    ``where(flag)`` would be pushed below the enrichment projections with the
    URL rules inlined into the predicate: the rules then run twice per row and
    the generated code can outgrow a Java method, which silently drops the
    stage to interpreted mode. A generator that emits the row once when the
    flag is true (``explode(array_repeat(true, int(flag)))``) filters at the
    point where the flag is computed, inside the same codegen stage.
    """
    keep = F.explode(F.array_repeat(F.lit(True), F.coalesce(F.col(flag), F.lit(False)).cast("int")))
    return df.withColumn("_keep", keep).drop("_keep")


def search_hits(enriched: DataFrame, strict: bool = True) -> DataFrame:
    """Hits that are search touches.

    A touch needs a query string, so ``referrer`` containing '?' is checked
    first on the raw column (it reaches the scan); the flag itself is then
    applied where it is computed.
    """
    return keep_where(enriched.where(F.col("referrer").contains("?")), search_flag(strict))


def purchase_hits(enriched: DataFrame) -> DataFrame:
    """Completed purchases with positive revenue.

    ``event_list = '1'`` is the purchase flag itself and a raw column, so it
    reaches the scan; only those rows get their revenue parsed.
    """
    rows = enriched.where(F.col("event_list") == PURCHASE_EVENT)
    flagged = rows.withColumn("_buy", positive())
    return keep_where(flagged, "_buy").drop("_buy")
