"""Visitor sessions and search-revenue attribution.

Two forms compute the same report:

* **session form** (default): one ``groupBy(session keys)`` picks the winning
  search touch with ``max``/``min`` over ``struct(order..., domain, keyword)``
  and sums purchase revenue in the same pass; a second ``groupBy`` sums per
  (domain, keyword). Both aggregations combine map-side, so a visitor holding
  a third of all hits costs one partial row per map task, never one giant group.
* **join form** (the original job's shape): touches joined to purchases, which are
  summed per visitor first, so both sides have one row per visitor.

Attribution policy (which search hit wins per visitor) is explicit:
``last`` (default) or ``first`` by ``order_by`` then domain, keyword, which makes
ties deterministic; ``any`` mirrors an arbitrary ``dropDuplicates`` and is not
deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import PURCHASE_EVENT
from .enrich import purchase_hits, search_flag
from .money import OVER, as_double, carried, positive, sums, with_double


def _keys_present(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def _touch_value(order_by: Sequence[str], attribution: str) -> Column:
    """Order key, then domain and keyword. A null in the order key loses to any value: it sorts
    lowest on its own, and for the first touch a leading flag puts it last."""
    fields = []
    for i, c in enumerate(order_by):
        if attribution == "first":
            fields.append(F.col(c).isNull().alias(f"_n{i}"))
        fields.append(F.col(c).alias(f"_o{i}"))
    return F.struct(*fields, F.col("domain").alias("domain"),
                    F.col("search_keyword").alias("keyword"))


def _pick(value: Column, attribution: str) -> Column:
    if attribution == "last":
        return F.max(value)
    if attribution == "first":
        return F.min(value)
    if attribution == "any":
        return F.first(value, ignorenulls=True)
    raise ValueError(f"attribution must be 'last', 'first' or 'any', not {attribution!r}")


def contributing_rows(enriched: DataFrame, session_keys: Sequence[str],
                      touches: bool = True, purchases: bool = True) -> DataFrame:
    """Cheap pre-filter on raw columns: only rows that could be a touch or a purchase.

    A search touch needs a query string (``?`` in the referrer) and a purchase
    needs ``event_list = '1'``. These predicates use base columns only, so they
    reach the scan, and the URL rules are evaluated once, in the projection that
    feeds the aggregate (a filter on the derived flags would be pushed below the
    projection and parse every URL twice).
    """
    cond = F.lit(False)
    if touches:
        cond = cond | F.col("referrer").contains("?")
    if purchases:
        cond = cond | (F.col("event_list") == PURCHASE_EVENT)
    return enriched.where(_keys_present(session_keys) & cond)


def visitor_sessions(enriched: DataFrame, *, attribution: str = "last", strict: bool = True,
                     order_by: Sequence[str] = ("hit_time_gmt",),
                     session_keys: Sequence[str] = ("ip",)) -> DataFrame:
    """One row per visitor: winning touch (domain, keyword) and purchase revenue.

    Null session keys are dropped explicitly (a bare ``groupBy`` would keep
    them as a group). ``revenue``/``domain`` stay null when the visitor has no
    purchase/touch.
    """
    is_touch = F.col(search_flag(strict))
    is_buy = F.col("is_purchase") & positive()
    rows = contributing_rows(enriched, session_keys)
    grouped = rows.groupBy(*session_keys).agg(
        _pick(F.when(is_touch, _touch_value(order_by, attribution)), attribution).alias("_touch"),
        *sums(is_buy),
        F.count(F.when(is_buy, F.lit(1))).alias("n_purchases"),
    )
    grouped = grouped.where(F.col("_touch").isNotNull() | F.col("revenue").isNotNull())
    return grouped.select(*session_keys, F.col("_touch.domain").alias("domain"),
                          F.col("_touch.keyword").alias("keyword"), "revenue", OVER, "n_purchases")


def touches(enriched: DataFrame, *, attribution: str = "last", strict: bool = True,
            order_by: Sequence[str] = ("hit_time_gmt",),
            session_keys: Sequence[str] = ("ip",)) -> DataFrame:
    """Winning search touch per visitor: ``(keys..., domain, keyword)``."""
    is_touch = F.col(search_flag(strict))
    rows = contributing_rows(enriched, session_keys, purchases=False)
    grouped = rows.groupBy(*session_keys).agg(
        _pick(F.when(is_touch, _touch_value(order_by, attribution)), attribution).alias("_touch"))
    return grouped.where(F.col("_touch").isNotNull()).select(
        *session_keys, F.col("_touch.domain").alias("domain"),
        F.col("_touch.keyword").alias("keyword"))


def search_sessions_any(enriched: DataFrame, strict: bool = False,
                        session_keys: Sequence[str] = ("ip",)) -> DataFrame:
    """The original job's arbitrary pick (``dropDuplicates`` on the session key).

    Written as ``first(..., ignorenulls)`` per visitor, which is the same
    arbitrary choice and combines map-side like the other session operators.
    """
    rows = contributing_rows(enriched, session_keys, purchases=False)
    touch = F.when(F.col(search_flag(strict)),
                   F.struct("domain", F.col("search_keyword").alias("keyword")))
    grouped = rows.groupBy(*session_keys).agg(F.first(touch, ignorenulls=True).alias("_t"))
    return grouped.where(F.col("_t").isNotNull()).select(
        *session_keys, F.col("_t.domain").alias("domain"), F.col("_t.keyword").alias("keyword"))


def attributed_sessions(sessions: DataFrame) -> DataFrame:
    """Visitors with both a touch and purchases (the only ones that earn credit)."""
    return sessions.where(F.col("domain").isNotNull() & F.col("keyword").isNotNull()
                          & F.col("revenue").isNotNull())


def keyword_revenue_exact(enriched: DataFrame, *, attribution: str = "last", strict: bool = True,
                          order_by: Sequence[str] = ("hit_time_gmt",),
                          session_keys: Sequence[str] = ("ip",),
                          report_by: Sequence[str] = ()) -> DataFrame:
    """Revenue per (domain, keyword) as exact decimals in two limbs (session form).

    ``report_by`` adds leading report keys, e.g. ``("source_file",)`` for one
    report per input file (each such key must also be a session key).
    """
    sessions = attributed_sessions(visitor_sessions(
        enriched, attribution=attribution, strict=strict, order_by=order_by,
        session_keys=session_keys))
    return carried(sessions.groupBy(*report_by, "domain", "keyword").agg(*sums()))


def quiet_hits(hits: DataFrame) -> DataFrame:
    """Blank the referrer and product list of hits that neither can make a touch nor a
    purchase, so that the URL and money rules cost nothing on them."""
    return hits.withColumns({
        "referrer": F.when(F.col("referrer").contains("?"), F.col("referrer")),
        "product_list": F.when(F.col("event_list") == PURCHASE_EVENT, F.col("product_list"))})


def keyword_revenue_counted(enriched: DataFrame, *, attribution: str = "last", strict: bool = True,
                            order_by: Sequence[str] = ("hit_time_gmt",),
                            file_keys: Sequence[str] = ("source_file",), visitor: str = "ip",
                            report_by: Sequence[str] = ()) -> DataFrame:
    """The exact report and the number of hits from one scan.

    Rows of :func:`keyword_revenue_exact` (sessions by ``file_keys`` and ``visitor``) with ``n_hits``
    and ``n_inexact``, the purchases beyond the exact money types, of the visitors credited there;
    and one row with null domain and keyword for all other hits. The counts of all rows add up to
    all hits. Hits that can't contribute meet in one session without a visitor, one partial row
    a task.
    """
    may = (F.col(visitor).isNotNull() & _keys_present(file_keys)
           & (F.col("referrer").contains("?") | (F.col("event_list") == PURCHASE_EVENT)))
    is_touch = may & F.col(search_flag(strict))
    is_buy = may & F.col("is_purchase") & positive()
    sessions = enriched.groupBy(*file_keys, F.when(may, F.col(visitor)).alias("_visitor")).agg(
        _pick(F.when(is_touch, _touch_value(order_by, attribution)), attribution).alias("_touch"),
        *sums(is_buy), F.count(F.lit(1)).alias("n_hits"),
        F.count(F.when(F.col("is_purchase") & F.col("revenue_inexact"), 1)).alias("n_inexact"))
    credited = (F.col("_visitor").isNotNull() & F.col("_touch.domain").isNotNull()
                & F.col("_touch.keyword").isNotNull() & F.col("revenue").isNotNull())
    placed = sessions.withColumns({"domain": F.when(credited, F.col("_touch.domain")),
                                   "keyword": F.when(credited, F.col("_touch.keyword"))})
    return carried(placed.groupBy(*report_by, "domain", "keyword").agg(
        *sums(F.col("domain").isNotNull()), F.sum("n_hits").alias("n_hits"), F.sum("n_inexact").alias("n_inexact")))


def credited_rows(counted: DataFrame) -> DataFrame:
    """The report's rows of :func:`keyword_revenue_counted`."""
    return counted.where(F.col("domain").isNotNull()).drop("n_hits", "n_inexact")


def keyword_revenue(enriched: DataFrame, *, attribution: str = "last", strict: bool = True,
                    order_by: Sequence[str] = ("hit_time_gmt",),
                    session_keys: Sequence[str] = ("ip",), ordered: bool = True) -> DataFrame:
    """The report: ``(domain, keyword, revenue double)``, highest revenue first."""
    exact = keyword_revenue_exact(enriched, attribution=attribution, strict=strict,
                                  order_by=order_by, session_keys=session_keys)
    out = exact.select("domain", "keyword", as_double("revenue").alias("revenue"))
    return report_order(out) if ordered else out


def report_order(report: DataFrame) -> DataFrame:
    """Revenue descending; ties by domain then keyword (deterministic)."""
    return report.orderBy(F.col("revenue").desc(), F.col("domain"), F.col("keyword"))


# --------------------------------------------------------------------------
# Join form
# --------------------------------------------------------------------------

def purchase_sessions(purchases: DataFrame, session_keys: Sequence[str] = ("ip",)) -> DataFrame:
    """Purchase amounts per visitor as a multiset: ``(keys..., amount, amount_over, n)``.

    The original collected every amount of a visitor into one list; a list per
    visitor is unbounded, so the same information is kept as rows, one per
    distinct amount with its multiplicity, shuffled by (keys, amount).
    """
    return (purchases.where(_keys_present(session_keys))
            .groupBy(*session_keys, F.col("revenue").alias("amount"), F.col(OVER).alias("amount_over"))
            .agg(F.count(F.lit(1)).alias("n")))


def _salted_join(big: DataFrame, small: DataFrame, keys: Sequence[str], salt_buckets: int,
                 salt_source: Sequence[str] | None) -> DataFrame:
    """Equi-join where ``small`` has one row per key; hot keys of ``big`` are spread.

    Each big row gets a deterministic salt from ``salt_source`` (default: all
    of its columns), so a retried task salts rows exactly as before; a random
    salt could move rows between join partitions on recomputation. The small
    side is replicated once per salt value.
    """
    if salt_buckets <= 1:
        return big.join(small, list(keys), "inner")
    source = list(salt_source) if salt_source else big.columns
    big_s = big.withColumn("_salt", F.pmod(F.xxhash64(*source), F.lit(salt_buckets)))
    small_s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                             F.lit(salt_buckets - 1).cast("long"))))
    return big_s.join(small_s, [*keys, "_salt"], "inner").drop("_salt")


def attribution_join(touch: DataFrame, purchase_sess: DataFrame,
                     session_keys: Sequence[str] = ("ip",), salt_buckets: int = 1) -> DataFrame:
    """Touch per visitor joined to that visitor's purchase amounts (one row each)."""
    return _salted_join(purchase_sess, touch, session_keys, salt_buckets, ("amount",))


def attributed_purchases(touch: DataFrame, purchases: DataFrame, *,
                         session_keys: Sequence[str] = ("ip",), salt_buckets: int = 1,
                         salt_source: Sequence[str] | None = None) -> DataFrame:
    """One row per credited purchase: the purchase row plus its visitor's touch."""
    big = purchases.where(_keys_present(session_keys))
    return _salted_join(big, touch, session_keys, salt_buckets, salt_source)


def keyword_revenue_join(enriched: DataFrame, *, attribution: str = "last", strict: bool = True,
                         order_by: Sequence[str] = ("hit_time_gmt",),
                         session_keys: Sequence[str] = ("ip",)) -> DataFrame:
    """Join form of :func:`keyword_revenue`: touches joined to revenue, one row per visitor each.

    Purchases are summed per visitor before the join (combined map-side), so a hot
    visitor is one partial row per task and the join is one to one.
    """
    t = touches(enriched, attribution=attribution, strict=strict, order_by=order_by,
                session_keys=session_keys)
    spent = (purchase_hits(enriched).where(_keys_present(session_keys)).groupBy(*session_keys)
             .agg(*sums()))
    rows = t.join(spent, list(session_keys))
    return with_double(rows.where(F.col("domain").isNotNull() & F.col("keyword").isNotNull())
                       .groupBy("domain", "keyword").agg(*sums()))


def session_counts(enriched: DataFrame, *, strict: bool = True,
                   session_keys: Sequence[str] = ("ip",)) -> DataFrame:
    """Visitors with a search touch, with purchases, and with both (one row)."""
    sessions = visitor_sessions(enriched, strict=strict, session_keys=session_keys)
    has_touch = F.col("domain").isNotNull()
    has_buy = F.col("revenue").isNotNull()
    return sessions.agg(
        F.count(F.when(has_touch, 1)).alias("search_sessions"),
        F.count(F.when(has_buy, 1)).alias("purchase_sessions"),
        F.count(F.when(has_touch & has_buy, 1)).alias("attributed_sessions"),
    )
