"""Money in two limbs: sums that can't overflow, joined at the edge.

A frame holds ``revenue`` and, where amounts can be large, ``revenue_over`` in units of 10**14
(null is 0). Both limbs are plain decimal sums, combined map-side. A frame without
``revenue_over`` is read as having none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.products import LIMB, OVER_TYPE, REVENUE_TYPE

OVER = "revenue_over"


def positive() -> Column:
    """Whether a line's amount is above zero (both limbs of a line have one sign)."""
    return (F.col("revenue") > 0) | (F.col(OVER) > 0)


def sums(where: Column | None = None) -> list[Column]:
    """Sums of both limbs, of the rows where ``where`` holds."""
    limb = lambda c: F.col(c) if where is None else F.when(where, F.col(c))
    return [F.sum(limb("revenue")).cast(REVENUE_TYPE).alias("revenue"),
            F.sum(limb(OVER)).cast(OVER_TYPE).alias(OVER)]


def carried(df: DataFrame) -> DataFrame:
    """The lower limb below 10**14 again, so that (over, revenue) sorts as the amount does."""
    limb = F.lit(LIMB).cast("decimal(15,0)")
    low = (F.col("revenue") % limb).cast(REVENUE_TYPE)
    more = ((F.col("revenue") - low) / limb).cast(OVER_TYPE)
    large = F.abs("revenue") >= limb
    return df.withColumns({
        "revenue": F.when(large, low).otherwise(F.col("revenue")),
        OVER: F.when(large, F.coalesce(F.col(OVER), F.lit(0)) + more).otherwise(F.col(OVER)).cast(OVER_TYPE)})


def over_of(df: DataFrame) -> Column:
    return F.coalesce(F.col(OVER), F.lit(0)).cast(OVER_TYPE) if OVER in df.columns else F.lit(0).cast(OVER_TYPE)


def as_double(low: Column | str, over: Column | str = OVER) -> Column:
    """The amount as a double; null if the lower limb is."""
    low, over = (F.col(c) if isinstance(c, str) else c for c in (low, over))
    plain = low.cast("double")
    return F.when(over.isNull() | (over == 0), plain).otherwise(plain + over.cast("double") * F.lit(float(LIMB)))


def with_double(df: DataFrame) -> DataFrame:
    """``revenue`` as a double, the other limb gone."""
    return df.withColumn("revenue", as_double(F.col("revenue"), over_of(df))).drop(OVER)


def as_text(low: Column, over: Column) -> Column:
    """The amount with two decimals, rounded half-even, exact for every size. Needs the limbs of
    ``carried`` or a lower limb that fits the text on its own."""
    rounded = F.bround(low, 2).cast("decimal(38,2)")
    limb = F.lit(LIMB).cast("decimal(15,0)")
    rest = (rounded % limb).cast("decimal(16,2)")
    whole = (over + (rounded - rest) / limb).cast(OVER_TYPE)
    large = F.concat(whole.cast("string"), F.lpad(F.abs(rest).cast("string"), 17, "0"))
    return F.when(over == 0, rounded.cast("string")).otherwise(large)


def total(df: DataFrame) -> Column:
    """Aggregate: the frame's total as a double, null for no rows. Exact limbs; a given ``revenue``
    of another decimal type that no decimal sum holds is added as doubles."""
    low = F.coalesce(F.try_sum("revenue").cast("double"), F.sum(F.col("revenue").cast("double")))
    if OVER not in df.columns:
        return low
    return low + F.coalesce(F.sum(OVER).cast("double"), F.lit(0.0)) * F.lit(float(LIMB))
