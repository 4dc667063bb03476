"""Text helpers shared by the URL and product-list rules."""

from __future__ import annotations

from pyspark.sql import Column

from .sqltext import expr, is_column_ref, ref, rx

# Fixed value: the characters Python's str.strip() removes (str.isspace), as
# code points in order.
WHITESPACE_POINTS = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0,
                     0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007,
                     0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
# The same set as a regex class that both Java regex and RE2 accept.
WHITESPACE_CLASS = (r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
STRIP_PATTERN = r"\A" + WHITESPACE_CLASS + r"+|" + WHITESPACE_CLASS + r"+\z"
# A '%' that does not start a two-hex-digit escape is kept as text.
BARE_PERCENT = r"%(?![0-9A-Fa-f]{2})"


def chars_literal(points) -> str:
    """A SQL string literal holding the given code points (as \\uXXXX escapes)."""
    return "'" + "".join(f"\\u{p:04X}" for p in points) + "'"


_WS_LITERAL = chars_literal(WHITESPACE_POINTS)


def strip_sql(x: str) -> str:
    """Python's ``str.strip()``: plain ``trim`` only removes spaces, so the
    whole whitespace set is given (no regex)."""
    return f"trim(BOTH {_WS_LITERAL} FROM {x})"


def decode_sql(x: str) -> str:
    """``unquote_plus``: '+' is a space, %XX a byte, a malformed escape stays text.

    ``url_decode`` raises on ``%zz``; escaping bare '%' first makes it total.
    """
    return f"url_decode(regexp_replace({x}, {rx(BARE_PERCENT)}, '%25'))"


def decode_if_escaped_sql(x: str) -> str:
    """Decode only when there is something to decode (cheap fast path).

    The test needs ``x`` three times, so the shortcut is taken only when ``x``
    is a plain column reference; for a larger expression plain decoding is
    cheaper than evaluating that expression three times.
    """
    if not is_column_ref(x):
        return decode_sql(x)
    return f"CASE WHEN instr({x}, '%') > 0 OR instr({x}, '+') > 0 THEN {decode_sql(x)} ELSE {x} END"


def py_strip(col: str) -> Column:
    return expr(strip_sql(ref(col)))


def lenient_url_decode(col: str) -> Column:
    return expr(decode_sql(ref(col)))
