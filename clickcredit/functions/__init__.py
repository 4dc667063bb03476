"""Per-row rules as native Spark SQL expressions (no Python UDFs).

``*_sql`` builders return SQL text; the plain names wrap them as ``Column``
and take a column name (or SQL expression text).
"""

from .files import (content_type, decode_key, file_date_from_key, file_name, iso_utc, size_class, size_gb,
                    zfill2)
from .flags import is_purchase, is_search_referral, is_search_referral_lax
from .products import line_price, line_revenue
from .text import lenient_url_decode, py_strip
from .urls import (clean_url, keyword_from_query, normalize_keyword, query_pairs, query_text,
                   raw_keyword, referrer_domain, referrer_keyword, referrer_params)

__all__ = [
    "clean_url", "content_type", "decode_key", "file_date_from_key", "file_name", "is_purchase",
    "is_search_referral", "is_search_referral_lax", "iso_utc", "keyword_from_query",
    "lenient_url_decode", "line_price", "line_revenue", "normalize_keyword", "py_strip",
    "query_pairs", "query_text", "raw_keyword", "referrer_domain", "referrer_keyword",
    "referrer_params", "size_class", "size_gb", "zfill2",
]
