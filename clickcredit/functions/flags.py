"""Row flags: purchase, search referral (strict and lax)."""

from __future__ import annotations

from pyspark.sql import Column

from ..schema import PURCHASE_EVENT
from .sqltext import expr, ref, s


def is_purchase_sql(event_list: str) -> str:
    """``event_list`` exactly ``'1'``; ``'12'`` or ``'1,2'`` are not purchases."""
    return f"coalesce({event_list} = {s(PURCHASE_EVENT)}, false)"


def is_search_referral_lax_sql(referrer: str, domain: str, raw_kw: str, site: str) -> str:
    """External referrer carrying a search parameter; empty host is allowed."""
    return f"coalesce({referrer} <> '' AND {domain} <> {s(site)} AND {raw_kw} IS NOT NULL, false)"


def is_search_referral_sql(referrer: str, domain: str, raw_kw: str, keyword: str, site: str) -> str:
    """Lax rule plus a non-empty host and a non-empty normalized keyword."""
    return (f"coalesce({referrer} <> '' AND {domain} <> {s(site)} AND {raw_kw} IS NOT NULL "
            f"AND {domain} <> '' AND {keyword} <> '', false)")


def is_purchase(event_list: str = "event_list") -> Column:
    return expr(is_purchase_sql(ref(event_list)))


def is_search_referral_lax(referrer: str, domain: str, raw_kw: str, site: str) -> Column:
    return expr(is_search_referral_lax_sql(ref(referrer), ref(domain), ref(raw_kw), site))


def is_search_referral(referrer: str, domain: str, raw_kw: str, keyword: str, site: str) -> Column:
    return expr(is_search_referral_sql(ref(referrer), ref(domain), ref(raw_kw), ref(keyword), site))
