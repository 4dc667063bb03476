"""Object-key and file-size rules for the manifest and the status log."""

from __future__ import annotations

from pyspark.sql import Column

from ..schema import SIZE_THRESHOLD_BYTES
from .sqltext import expr, ref, s
from .text import decode_sql

GIB = 1024 ** 3


def decode_key_sql(raw_key: str) -> str:
    """Keys arrive URL-encoded in notifications (``unquote_plus``)."""
    return decode_sql(raw_key)


def file_name_sql(key: str) -> str:
    return f"substring_index({key}, '/', -1)"


def _part(key: str, name: str) -> tuple[str, str]:
    """(present, value) of the last ``/name=value`` path part (value ends at '=' or '/').

    Plain string functions on ``'/' + key``: the text after the last
    ``/name=``, cut at the next '/' and '='. No regex, so no backtracking and
    the expression stays in generated code.
    """
    k = f"concat('/', {key})"
    tag = s(f"/{name}=")
    after = f"substring_index({k}, {tag}, -1)"
    value = f"substring_index(substring_index({after}, '/', 1), '=', 1)"
    return f"instr({k}, {tag}) > 0", value


def zfill2_sql(x: str) -> str:
    """Python's ``str.zfill(2)``: pads, keeps a leading sign, never truncates."""
    return (f"CASE WHEN length({x}) >= 2 THEN {x} WHEN {x} IN ('+', '-') THEN concat({x}, '0') "
            f"ELSE lpad({x}, 2, '0') END")


def file_date_sql(key: str, run_date: str) -> str:
    """``YYYY-MM-DD`` text from ``year=/month=/day=`` parts; else the run date.

    ``run_date`` is a parameter (text ``YYYY-MM-DD``), never the clock, so a
    re-run gives the same answer.
    """
    y_ok, y = _part(key, "year")
    m_ok, m = _part(key, "month")
    d_ok, d = _part(key, "day")
    return (f"CASE WHEN {y_ok} AND {y} <> '' AND {m_ok} AND {d_ok} "
            f"THEN concat_ws('-', {y}, {zfill2_sql(m)}, {zfill2_sql(d)}) ELSE {s(run_date)} END")


def size_gb_sql(size_bytes: str) -> str:
    """Bytes to GiB, rounded half-even to two places (as Python's ``round``)."""
    return f"bround(CAST({size_bytes} AS DOUBLE) / {GIB}D, 2)"


def size_class_sql(size_bytes: str) -> str:
    t = SIZE_THRESHOLD_BYTES
    return f"CASE WHEN {size_bytes} < {t} THEN 'small' WHEN {size_bytes} >= {t} THEN 'large' END"


# Content types by the last part of a file name, as object stores report them.
CONTENT_TYPES = {
    "csv": "text/csv",
    "tsv": "text/tab-separated-values",
    "tab": "text/tab-separated-values",
    "txt": "text/plain",
    "json": "application/json",
    "gz": "application/gzip",
    "zip": "application/zip",
}
OTHER_CONTENT_TYPE = "binary/octet-stream"


def content_type_sql(name: str) -> str:
    """Content type by the name's ending, whatever its case; names without a known one are binary."""
    ending = f"lower(substring_index({name}, '.', -1))"
    cases = " ".join(f"WHEN {s(k)} THEN {s(v)}" for k, v in CONTENT_TYPES.items())
    return (f"CASE WHEN {name} IS NULL THEN NULL WHEN instr({name}, '.') = 0 THEN {s(OTHER_CONTENT_TYPE)} "
            f"ELSE CASE {ending} {cases} ELSE {s(OTHER_CONTENT_TYPE)} END END")


def iso_utc_sql(ts: str) -> str:
    """``datetime.isoformat() + 'Z'``: microseconds only when non-zero.

    Built from the timestamp's text form: for a zone-less timestamp that text
    is the stored wall clock, whereas ``date_format`` would first convert it
    to the session time zone (and shift times that fall in a DST gap).
    """
    text = f"CAST({ts} AS STRING)"
    base = f"replace(substring_index({text}, '.', 1), ' ', 'T')"
    frac = (f"CASE WHEN instr({text}, '.') > 0 "
            f"THEN concat('.', rpad(substring_index({text}, '.', -1), 6, '0')) ELSE '' END")
    return f"concat({base}, {frac}, 'Z')"


def decode_key(raw_key: str) -> Column:
    return expr(decode_key_sql(ref(raw_key)))


def file_name(key: str) -> Column:
    return expr(file_name_sql(ref(key)))


def zfill2(text: str) -> Column:
    return expr(zfill2_sql(ref(text)))


def file_date_from_key(key: str, run_date: str) -> Column:
    return expr(file_date_sql(ref(key), run_date))


def size_gb(size_bytes: str) -> Column:
    return expr(size_gb_sql(ref(size_bytes)))


def size_class(size_bytes: str) -> Column:
    return expr(size_class_sql(ref(size_bytes)))


def iso_utc(ts: str) -> Column:
    return expr(iso_utc_sql(ref(ts)))


def content_type(name: str) -> Column:
    return expr(content_type_sql(ref(name)))
