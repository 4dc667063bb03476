"""Order-line revenue from ``product_list`` (``category;name;quantity;price;``).

Only the first product counts. Quantity must be an integer and price a plain
number (so NaN/inf/'1d' are rejected); anything else gives revenue 0.

Money is held as two limbs, ``revenue_over x 10**14 + revenue``: ``revenue`` is an exact
decimal below 10**14 with 10 places, and ``revenue_over`` is null for all usual amounts. Sums of
the limbs can't overflow below 10**14 rows, and they are joined at the edge
(``operators.money``). A price up to 10**14 and a quantity below 10**13 multiply exactly. Beyond that the
product is taken in double precision and marked ``revenue_inexact``, so a report can count such
lines; from 10**50 on (or not finite) it is 0, and marked.
"""

from __future__ import annotations

from pyspark.sql import Column

from .sqltext import expr, ref, rx
from .text import strip_sql

_INT = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
LIMB = 10 ** 14
PRICE_TYPE = "decimal(24,10)"
QUANTITY_TYPE = "decimal(13,0)"
REVENUE_TYPE = "decimal(38,10)"
OVER_TYPE = "decimal(38,0)"
_LIMB = f"CAST({LIMB} AS decimal(15,0))"
_LARGEST = "1e50D"


def _field(pl: str, i: int) -> str:
    return strip_sql(f"get(split({pl}, ';'), {i})")


def quantity_field_sql(pl: str) -> str:
    return _field(pl, 2)


def price_field_sql(pl: str) -> str:
    return _field(pl, 3)


def amount_sql(qty: str, price: str) -> str:
    """Exact quantity x price of the stripped fields; null where it is malformed or beyond the
    exact types. Pass column references, as each is read twice."""
    qty_v = f"CASE WHEN {qty} RLIKE {rx(_INT)} THEN try_cast({qty} AS {QUANTITY_TYPE}) END"
    price_v = f"CASE WHEN {price} RLIKE {rx(_NUMBER)} THEN try_cast({price} AS {PRICE_TYPE}) END"
    return f"CAST({qty_v} * {price_v} AS {REVENUE_TYPE})"


def far_amount_sql(qty: str, price: str, amount: str) -> str:
    """The product in double precision where only ``amount`` can't hold it; null elsewhere."""
    return (f"CASE WHEN {amount} IS NULL AND {qty} RLIKE {rx(_INT)} AND {price} RLIKE {rx(_NUMBER)} "
            f"THEN try_cast({qty} AS double) * try_cast({price} AS double) END")


def revenue_sql(amount: str, far: str) -> str:
    """The lower limb; 0 where neither amount is known."""
    return (f"CASE WHEN abs({amount}) < {_LIMB} THEN {amount} "
            f"WHEN {amount} IS NOT NULL THEN CAST({amount} % {_LIMB} AS {REVENUE_TYPE}) "
            f"WHEN abs({far}) < {LIMB}D THEN CAST({far} AS {REVENUE_TYPE}) "
            f"WHEN abs({far}) < 1e28D THEN CAST(CAST({far} AS decimal(38,10)) % {_LIMB} AS {REVENUE_TYPE}) "
            f"ELSE CAST(0 AS {REVENUE_TYPE}) END")


def over_sql(amount: str, far: str) -> str:
    """The upper limb; null where it is 0."""
    return (f"CASE WHEN abs({amount}) >= {_LIMB} "
            f"THEN CAST(({amount} - {amount} % {_LIMB}) / {_LIMB} AS {OVER_TYPE}) "
            f"WHEN abs({far}) >= {_LARGEST} THEN CAST(NULL AS {OVER_TYPE}) "
            f"WHEN abs({far}) >= 1e28D THEN CAST(round({far} / {LIMB}D) AS {OVER_TYPE}) "
            f"WHEN abs({far}) >= {LIMB}D THEN CAST((CAST({far} AS decimal(38,10)) "
            f"- CAST({far} AS decimal(38,10)) % {_LIMB}) / {_LIMB} AS {OVER_TYPE}) END")


def line_revenue_sql(pl: str) -> str:
    """quantity x price of the first product as a double; 0 when absent or malformed."""
    qty, price = quantity_field_sql(pl), price_field_sql(pl)
    amount = amount_sql(qty, price)
    far = far_amount_sql(qty, price, f"({amount})")
    return (f"coalesce(CAST({amount} AS double), CASE WHEN abs({far}) < {_LARGEST} THEN {far} END, 0D)")


def line_price_sql(pl: str) -> str:
    """Older rule: the price field alone as a double; 0 when absent, malformed or infinite."""
    price = price_field_sql(pl)
    value = f"CASE WHEN {price} RLIKE {rx(_NUMBER)} THEN try_cast({price} AS double) END"
    return f"coalesce(CASE WHEN abs({value}) < double('inf') THEN {value} END, 0D)"


def line_revenue(product_list: str) -> Column:
    return expr(line_revenue_sql(ref(product_list)))


def line_price(product_list: str) -> Column:
    return expr(line_price_sql(ref(product_list)))
