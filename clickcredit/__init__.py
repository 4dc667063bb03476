"""Search revenue attribution on Spark.

Typical use::

    from clickcredit import enrich_hits, keyword_revenue, read_hits
    report = keyword_revenue(enrich_hits(read_hits(spark, path)),
                             session_keys=("source_file", "ip"))

Rules are native Spark SQL expressions (``clickcredit.functions``), operators
are ``DataFrame -> DataFrame`` (``clickcredit.operators``), and
``clickcredit.plans.job`` / ``clickcredit.streaming`` hold the batch and
streaming jobs.
"""

from .operators.attribution import (attributed_purchases, attribution_join, keyword_revenue,
                                    keyword_revenue_exact, keyword_revenue_join, purchase_sessions,
                                    search_sessions_any, session_counts, touches,
                                    visitor_sessions)
from .operators.enrich import enrich_hits, purchase_hits, search_hits
from .operators.status import (file_manifest, latest_file_status, rejected_status_events,
                               status_events)
from .operators.summary import (domain_revenue, keyword_totals, report_rollup, report_summary,
                                top_domains, top_keywords)
from .sources.hits import read_hits

__all__ = [
    "attributed_purchases", "attribution_join", "domain_revenue", "enrich_hits", "file_manifest",
    "keyword_revenue", "keyword_revenue_exact", "keyword_revenue_join", "keyword_totals",
    "latest_file_status", "purchase_hits", "purchase_sessions", "read_hits",
    "rejected_status_events", "report_rollup", "report_summary", "search_hits", "search_sessions_any",
    "session_counts", "status_events", "top_domains", "top_keywords", "touches",
    "visitor_sessions",
]
