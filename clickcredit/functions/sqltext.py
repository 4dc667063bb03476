"""Helpers for writing rules as Spark SQL expression text.

Each rule is one SQL expression, parsed once on the JVM side by ``F.expr``;
building the same tree call by call through the Column API costs hundreds of
Python-to-JVM round trips per query plan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def ref(name_or_sql: str) -> str:
    """A column name becomes a quoted identifier; anything else is taken as SQL."""
    return f"`{name_or_sql}`" if _IDENT.match(name_or_sql) else f"({name_or_sql})"


def is_column_ref(sql: str) -> bool:
    """Whether ``sql`` is a bare (back-quoted or plain) column name or lambda variable."""
    return bool(_IDENT.match(sql) or re.match(r"^`[^`]+`$", sql))


def rx(pattern: str) -> str:
    """A regex as a raw SQL literal (backslashes are passed through untouched)."""
    if "'" in pattern:
        raise ValueError("patterns may not contain a single quote")
    return f"r'{pattern}'"


def s(value: str) -> str:
    """A plain SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def expr(sql: str) -> Column:
    return F.expr(sql)
