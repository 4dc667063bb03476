"""Referrer URL rules as native Spark SQL expressions (no Python UDFs).

Semantics follow Python's ``urllib.parse`` as used by the original job:

* domain  = network location, lower-cased, one leading ``www.`` removed;
  port and user info stay; no host gives ``''``; null/empty URL gives null.
* query   = text after the first ``?`` and before ``#`` (fragments are ignored).
* pairs   = ``parse_qs`` with defaults: split on ``&``, a field without ``=`` or
  with a blank value is dropped, names and values are ``unquote_plus``-decoded.
* keyword = the first value of the first present name in ``SEARCH_PARAMS``
  (list order, not URL order), decoded a second time, stripped, lower-cased.

Functions ending in ``_sql`` take and return SQL text; the others take a
column name (or SQL expression text) and return a ``Column``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column

from ..schema import SEARCH_PARAMS
from .sqltext import expr, ref, rx, s
from .text import decode_if_escaped_sql, decode_sql, strip_sql

_NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
_QUERY = r"^[^?#]*[?]([^#]*)"
# urlsplit drops leading C0 controls/spaces and removes tab, CR, LF anywhere.
_UNSAFE = r"\A[\x00-\x20]+|[\t\r\n]"

# SQL text cannot share a subexpression, so every builder below refers to its
# input once; callers that need a value several times stage it as a column.


def _blank(u: str) -> str:
    return f"{u} IS NULL OR {u} = ''"


def clean_url_sql(u: str) -> str:
    """The URL text as ``urlsplit`` sees it."""
    return f"regexp_replace({u}, {rx(_UNSAFE)}, '')"


def domain_from_clean_sql(u: str, cleaned: str) -> str:
    """Domain of URL ``u`` given its cleaned text (``clean_url_sql(u)``)."""
    host = f"lower(regexp_extract({cleaned}, {rx(_NETLOC)}, 1))"
    return f"CASE WHEN {_blank(u)} THEN CAST(NULL AS STRING) ELSE regexp_replace({host}, r'^www[.]', '') END"


def query_from_clean_sql(cleaned: str) -> str:
    return f"regexp_extract({cleaned}, {rx(_QUERY)}, 1)"


def domain_sql(u: str) -> str:
    return domain_from_clean_sql(u, clean_url_sql(u))


def query_sql(u: str) -> str:
    return query_from_clean_sql(clean_url_sql(u))


def pairs_sql(q: str) -> str:
    """``array<struct<n, v>>`` of kept pairs in URL order; ``n`` decoded, ``v`` raw."""
    split = f"transform(split({q}, '&'), _p -> split(_p, '=', 2))"
    kept = f"filter({split}, _nv -> size(_nv) = 2 AND get(_nv, 1) <> '')"
    name = decode_if_escaped_sql("get(_nv, 0)")
    return f"transform({kept}, _nv -> named_struct('n', {name}, 'v', get(_nv, 1)))"


def raw_keyword_exact_sql(pairs: str, params: Sequence[str] = SEARCH_PARAMS) -> str:
    """First value of the first present parameter, by list order (once-decoded)."""
    picks = ", ".join(f"get(filter({pairs}, _x -> _x.n = {s(n)}), 0).v" for n in params)
    return decode_if_escaped_sql(f"coalesce({picks})")


def encoded_name_pattern(name: str) -> str:
    """Regex for every raw spelling of ``name`` that decodes to exactly ``name``.

    Each character may be written as itself or as its %XX byte (hex digits in
    either case). '+' decodes to a space and a multi-byte or malformed escape
    never decodes to an ASCII character, so for ASCII names this is exact.
    """
    if not name.isascii():
        raise ValueError("search parameter names must be ASCII")
    parts = []
    for ch in name:
        hx = "".join(f"[{d.upper()}{d.lower()}]" if d.isalpha() else d for d in f"{ord(ch):02x}")
        parts.append(f"(?:{re.escape(ch)}|%{hx})")
    return "".join(parts)


def keyword_from_query_sql(q: str, params: Sequence[str] = SEARCH_PARAMS) -> str:
    """Raw keyword of a query string: first non-blank value of the first present name.

    One anchored ``regexp_extract`` per name, in list order; the leftmost match
    is the first pair with that (decoded) name and a non-blank value, as in
    ``parse_qs``. No arrays or lambdas, so it runs inside whole-stage codegen.
    The value is decoded once (the decode ``parse_qs`` does).
    """
    picks = ", ".join(
        f"nullif(regexp_extract({q}, {rx('(?:^|&)' + encoded_name_pattern(n) + '=([^&]+)')}, 1), '')"
        for n in params)
    return decode_sql(f"coalesce({picks})")


def normalize_keyword_sql(raw: str, case_sensitive: bool = False) -> str:
    """Second decode, strip, lower-case (lower-casing skipped when asked)."""
    kw = strip_sql(decode_if_escaped_sql(raw))
    return kw if case_sensitive else f"lower({kw})"


def referrer_keyword_sql(u: str, case_sensitive: bool = False,
                         params: Sequence[str] = SEARCH_PARAMS) -> str:
    raw = keyword_from_query_sql(query_sql(u), params)
    return f"CASE WHEN {_blank(u)} THEN CAST(NULL AS STRING) ELSE {normalize_keyword_sql(raw, case_sensitive)} END"


def with_search_keyword(df, url: str, out: str = "keyword", case_sensitive: bool = False):
    """``df`` plus the search keyword of column ``url``, with the query string staged once.

    Same result as ``referrer_keyword(url)``; as SQL text the one-expression
    form would cut the query string out again inside each per-name lookup.
    """
    u = ref(url)
    staged = df.withColumn("_kw_query", expr(query_sql(u)))
    raw = keyword_from_query_sql("`_kw_query`")
    kw = f"CASE WHEN {_blank(u)} THEN CAST(NULL AS STRING) ELSE {normalize_keyword_sql(raw, case_sensitive)} END"
    return staged.withColumn(out, expr(kw)).drop("_kw_query")


def params_sql(u: str) -> str:
    """Decoded ``array<struct<name, value>>`` of a URL's query string (``parse_qs``)."""
    return (f"transform({pairs_sql(query_sql(u))}, "
            f"_kv -> named_struct('name', _kv.n, 'value', {decode_sql('_kv.v')}))")


# Column wrappers ------------------------------------------------------------

def clean_url(url: str) -> Column:
    return expr(clean_url_sql(ref(url)))


def referrer_domain(url: str) -> Column:
    return expr(domain_sql(ref(url)))


def query_text(url: str) -> Column:
    return expr(query_sql(ref(url)))


def query_pairs(query: str) -> Column:
    return expr(pairs_sql(ref(query)))


def raw_keyword(pairs: str, params: Sequence[str] = SEARCH_PARAMS) -> Column:
    return expr(raw_keyword_exact_sql(ref(pairs), params))


def keyword_from_query(query: str, params: Sequence[str] = SEARCH_PARAMS) -> Column:
    return expr(keyword_from_query_sql(ref(query), params))


def normalize_keyword(raw: str, case_sensitive: bool = False) -> Column:
    return expr(normalize_keyword_sql(ref(raw), case_sensitive))


def referrer_keyword(url: str, case_sensitive: bool = False,
                     params: Sequence[str] = SEARCH_PARAMS) -> Column:
    return expr(referrer_keyword_sql(ref(url), case_sensitive, params))


def referrer_params(url: str) -> Column:
    return expr(params_sql(ref(url)))
