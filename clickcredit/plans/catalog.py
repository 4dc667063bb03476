"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables (``events``, ``orders``, ``pages``) whole,
through the adapters in ``sources``; nothing is sampled or capped except the
top-k lists, where the limit is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import line_price, line_revenue, referrer_domain, referrer_params
from ..functions.urls import with_search_keyword
from ..operators import attribution as A
from ..operators import status as S
from ..operators import summary as M
from ..operators.money import as_double
from ..operators.enrich import enrich_hits, purchase_hits, search_hits
from ..sinks.report import report_text
from ..sources import notifications as N
from ..sources.files import load_file_records
from ..sources.hits import load_event_hits
from ..sources.tables import read_table
from .oracle import RUN_DATE

# Event-derived hits carry a microsecond timestamp plus the event id; that is
# the order key for attribution (hit_time_gmt is whole seconds).
ORDER = ("ts", "hit_id")

Query = Callable[[SparkSession, str], DataFrame]


def _hits(spark: SparkSession, sf: str) -> DataFrame:
    return load_event_hits(spark, sf)


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich_hits(_hits(spark, sf))


def events_report_exact(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship report on event-derived hits, revenue as exact decimals."""
    return A.keyword_revenue_exact(_enriched(spark, sf), order_by=ORDER)


def _urls(spark: SparkSession, sf: str) -> DataFrame:
    hits = _hits(spark, sf).where(F.col("referrer").isNotNull()).select(
        F.lit("hit").alias("source"), F.col("hit_id").alias("id"), F.col("referrer").alias("url"))
    pages = read_table(spark, sf, "pages").where(F.col("url").isNotNull()).select(
        F.lit("page").alias("source"), F.col("page_id").alias("id"), F.col("url"))
    return hits.unionByName(pages)


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    return S.file_manifest(load_file_records(spark, sf), RUN_DATE)


def orders_status_events(spark: SparkSession, sf: str) -> DataFrame:
    """Status events for the file records derived from ``orders``."""
    return S.status_events(_manifest(spark, sf))


# --------------------------------------------------------------------------

def q_hits_count(spark, sf):
    return _hits(spark, sf).agg(F.count(F.lit(1)).alias("hits"))


def q_referrer_domain(spark, sf):
    return _urls(spark, sf).select("source", "id", "url", referrer_domain("url").alias("domain"))


def q_referrer_params(spark, sf):
    kv = _urls(spark, sf).select("source", "id", "url", referrer_params("url").alias("kv"))
    ex = kv.select("source", "id", "url", F.posexplode("kv").alias("pos0", "p"))
    return ex.select("source", "id", "url", (F.col("pos0") + 1).cast("long").alias("pos"),
                     F.col("p.name").alias("name"), F.col("p.value").alias("value"))


def q_referrer_keyword(spark, sf):
    return with_search_keyword(_urls(spark, sf), "url").select("source", "id", "url", "keyword")


def q_line_revenue(spark, sf):
    return (_hits(spark, sf).where(F.col("product_list").isNotNull())
            .select("hit_id", "product_list",
                    line_revenue("product_list").alias("revenue")))


def q_line_price(spark, sf):
    return (_hits(spark, sf).where(F.col("product_list").isNotNull())
            .select("hit_id", "product_list", line_price("product_list").alias("price")))


def q_is_search_referral(spark, sf):
    return _enriched(spark, sf).select("hit_id", "is_search_referral")


def q_is_search_referral_lax(spark, sf):
    return _enriched(spark, sf).select("hit_id", "is_search_referral_lax")


def q_is_purchase(spark, sf):
    return _enriched(spark, sf).select("hit_id", "is_purchase")


def q_enriched_hits(spark, sf):
    return _enriched(spark, sf).select("hit_id", "ip", "domain", "search_keyword", as_double("revenue").alias("revenue"),
                                       "is_search_referral", "is_search_referral_lax", "is_purchase")


def q_search_hits(spark, sf):
    return search_hits(_enriched(spark, sf)).select("hit_id", "ip", "domain", "search_keyword")


def q_purchase_hits(spark, sf):
    return (purchase_hits(_enriched(spark, sf)).where(F.col("ip").isNotNull())
            .select("hit_id", "ip", as_double("revenue").alias("revenue")))


def q_last_touch(spark, sf):
    return A.touches(_enriched(spark, sf), attribution="last", order_by=ORDER)


def q_first_touch(spark, sf):
    return A.touches(_enriched(spark, sf), attribution="first", order_by=ORDER)


def q_search_sessions_any(spark, sf):
    return A.search_sessions_any(_enriched(spark, sf), strict=False).select("ip")


def q_purchase_sessions(spark, sf):
    ps = A.purchase_sessions(purchase_hits(_enriched(spark, sf)))
    return ps.select("ip", as_double("amount", "amount_over").alias("amount"), "n")


def q_attribution_join(spark, sf):
    e = _enriched(spark, sf)
    j = A.attribution_join(A.touches(e, order_by=ORDER), A.purchase_sessions(purchase_hits(e)))
    return j.select("ip", "domain", "keyword", as_double("amount", "amount_over").alias("amount"), "n")


def q_attributed_purchases(spark, sf):
    e = _enriched(spark, sf)
    rows = A.attributed_purchases(A.touches(e, order_by=ORDER),
                                  purchase_hits(e).select("hit_id", "ip", "revenue", "revenue_over"))
    return rows.select("hit_id", "ip", "domain", "keyword", as_double("revenue").alias("revenue"))


def q_visitor_sessions(spark, sf):
    s = A.visitor_sessions(_enriched(spark, sf), order_by=ORDER)
    return s.select("ip", "domain", "keyword", as_double("revenue").alias("revenue"), "n_purchases")


def q_visitor_revenue(spark, sf):
    s = A.visitor_sessions(_enriched(spark, sf), order_by=ORDER)
    return s.where(F.col("revenue").isNotNull()).select("ip", as_double("revenue").alias("revenue"), "n_purchases")


def q_keyword_revenue(spark, sf):
    return A.keyword_revenue(_enriched(spark, sf), order_by=ORDER)


def q_keyword_revenue_case_kept(spark, sf):
    """Keywords keep their case (the rule behind the older expected reports)."""
    return A.keyword_revenue(enrich_hits(_hits(spark, sf), case_sensitive=True), order_by=ORDER)


def q_keyword_revenue_first(spark, sf):
    return A.keyword_revenue(_enriched(spark, sf), attribution="first", order_by=ORDER)


def q_keyword_revenue_lax(spark, sf):
    return A.keyword_revenue(_enriched(spark, sf), attribution="first", strict=False, order_by=ORDER)


def q_keyword_revenue_join(spark, sf):
    return A.keyword_revenue_join(_enriched(spark, sf), order_by=ORDER)


def q_session_counts(spark, sf):
    return A.session_counts(_enriched(spark, sf))


def q_report_summary(spark, sf):
    return M.report_summary(events_report_exact(spark, sf))


def q_domain_revenue(spark, sf):
    return M.domain_revenue(events_report_exact(spark, sf))


def q_keyword_totals(spark, sf):
    return M.keyword_totals(events_report_exact(spark, sf))


def q_report_rollup(spark, sf):
    return M.report_rollup(events_report_exact(spark, sf))


def q_top_domains(spark, sf):
    return M.top_domains(events_report_exact(spark, sf))


def q_top_keywords(spark, sf):
    return M.top_keywords(events_report_exact(spark, sf))


def q_report_text(spark, sf):
    return report_text(events_report_exact(spark, sf))


def q_file_date_from_key(spark, sf):
    return _manifest(spark, sf).select("event_seq", "file_key", "file_date")


def q_file_manifest(spark, sf):
    return _manifest(spark, sf).select("event_seq", "file_key", "file_name", "file_date", "file_size",
                                       "file_size_gb", "size_class")


def q_status_events(spark, sf):
    return orders_status_events(spark, sf).select(
        "event_seq", "file_date", "file_key", "file_status", "event_type", "bucket", "content_type",
        "file_datetime", "error_message", "payload")


def raw_status_events(spark: SparkSession, sf: str) -> DataFrame:
    """Status events as they might arrive, with some required fields missing."""
    seq = F.col("event_seq")
    return orders_status_events(spark, sf).select(
        "event_seq",
        F.when(seq % 101 == 0, F.lit(None)).otherwise(F.col("file_key")).alias("file_key"),
        F.when(seq % 103 == 0, F.lit("")).otherwise(F.col("file_status")).alias("file_status"),
        F.when(seq % 107 == 0, F.lit(None)).otherwise(F.col("event_type")).alias("event_type"),
        F.when(seq % 109 == 0, F.lit("")).otherwise(F.col("file_date")).alias("file_date"),
    )


def q_status_events_rejected(spark, sf):
    return S.rejected_status_events(raw_status_events(spark, sf)).select("event_seq", "reject_reason")


def q_accepted_status_events(spark, sf):
    return S.accepted_status_events(raw_status_events(spark, sf)).select(
        "event_seq", "file_key", "file_status", "event_type", "file_date")


def arrival_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Notifications as JSON text, one message an order: with two records on every 5th, without
    records on every 89th, cut off on every 97th; bucket and content type filled, blank or missing."""
    files = load_file_records(spark, sf)
    seq = F.col("event_seq")
    time = F.concat(F.regexp_replace(F.col("file_ts").cast("string"), " ", "T"), F.lit(".5Z"))
    bucket = F.when(seq % 3 == 0, "").when(seq % 3 == 1, "landing-a")
    kind = F.when(seq % 4 == 0, "text/plain").when(seq % 4 == 1, "")

    def record(key, size):
        return F.struct(F.lit("ObjectCreated").alias("eventName"), time.alias("eventTime"), F.struct(
            F.struct(bucket.alias("name")).alias("bucket"),
            F.struct(key.alias("key"), size.alias("size"), kind.alias("contentType")).alias("object")).alias("s3"))

    one = record(F.col("raw_key"), F.col("file_size"))
    two = record(F.concat("raw_key", F.lit(".2.json")), F.col("file_size") + 1)
    text = F.to_json(F.struct(F.when(seq % 5 == 0, F.array(one, two)).otherwise(F.array(one)).alias("Records")))
    return files.withColumn("text", text).select(
        "event_seq", F.when(seq % 89 == 0, F.lit('{"Event":"Test"}'))
        .when(seq % 97 == 0, F.substring("text", 1, 40)).otherwise(F.col("text")).alias("value"))


def q_arrival_notifications(spark, sf):
    files = N.notified_files(N.read_notifications(arrival_messages(spark, sf)))
    events = S.status_events(S.file_manifest(files, RUN_DATE))
    return events.select("event_seq", "file_key", "file_date", "file_size", "file_size_gb", "bucket", "content_type",
                         "file_status", "event_type", "file_datetime")


def q_arrival_notifications_rejected(spark, sf):
    return N.rejected_notifications(N.read_notifications(arrival_messages(spark, sf))).select(
        "event_seq", "reject_reason")


def q_completion_events(spark, sf):
    """Completion payloads as JSON text, read back as status events."""
    seq = F.col("event_seq")
    filled = _manifest(spark, sf).withColumns({
        "bucket": F.when(seq % 3 == 0, "").when(seq % 3 == 1, "landing-a"),
        "content_type": F.when(seq % 4 == 0, "text/plain").otherwise(F.col("content_type")),
        "error_message": F.when(F.col("file_status") == "FAILED", F.concat(F.lit("code "), seq.cast("string")))})
    messages = S.status_events(filled).select("event_seq", F.col("payload").alias("value"))
    return S.status_events(N.read_completions(messages, f"{RUN_DATE} 00:00:00")).select(
        "event_seq", "file_date", "file_key", "file_status", "event_type", "bucket", "content_type",
        "file_datetime", "error_message", "payload")


def status_log(spark: SparkSession, sf: str) -> DataFrame:
    """The status log keyed by file name only (``o_orderkey % 500``): ~30 events per file."""
    st = orders_status_events(spark, sf)
    key = F.concat(F.lit("hits/f"), (F.col("event_seq") % 500).cast("string"), F.lit(".csv"))
    return st.select("event_seq", key.alias("file_key"), "file_status", "event_type", "file_datetime",
                     "file_ts")


def q_latest_file_status(spark, sf):
    return S.latest_file_status(status_log(spark, sf), keys=("file_key",))


QUERIES: dict[str, Query] = {
    "hits_count": q_hits_count,
    "referrer_domain": q_referrer_domain,
    "referrer_params": q_referrer_params,
    "referrer_keyword": q_referrer_keyword,
    "line_revenue": q_line_revenue,
    "line_price": q_line_price,
    "is_search_referral": q_is_search_referral,
    "is_search_referral_lax": q_is_search_referral_lax,
    "is_purchase": q_is_purchase,
    "enriched_hits": q_enriched_hits,
    "search_hits": q_search_hits,
    "purchase_hits": q_purchase_hits,
    "last_touch": q_last_touch,
    "first_touch": q_first_touch,
    "search_sessions_any": q_search_sessions_any,
    "purchase_sessions": q_purchase_sessions,
    "attribution_join": q_attribution_join,
    "attributed_purchases": q_attributed_purchases,
    "visitor_sessions": q_visitor_sessions,
    "visitor_revenue": q_visitor_revenue,
    "keyword_revenue": q_keyword_revenue,
    "keyword_revenue_first": q_keyword_revenue_first,
    "keyword_revenue_case_kept": q_keyword_revenue_case_kept,
    "keyword_revenue_lax": q_keyword_revenue_lax,
    "keyword_revenue_join": q_keyword_revenue_join,
    "session_counts": q_session_counts,
    "report_summary": q_report_summary,
    "domain_revenue": q_domain_revenue,
    "keyword_totals": q_keyword_totals,
    "report_rollup": q_report_rollup,
    "top_domains": q_top_domains,
    "top_keywords": q_top_keywords,
    "report_text": q_report_text,
    "file_date_from_key": q_file_date_from_key,
    "file_manifest": q_file_manifest,
    "status_events": q_status_events,
    "status_events_rejected": q_status_events_rejected,
    "accepted_status_events": q_accepted_status_events,
    "arrival_notifications": q_arrival_notifications,
    "arrival_notifications_rejected": q_arrival_notifications_rejected,
    "completion_events": q_completion_events,
    "latest_file_status": q_latest_file_status,
}
