"""Numeric coercion, rounding and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words for an unlimited number.
INFINITE = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")


def to_number(c: Column | str) -> Column:
    """Text to double; anything that is not a plain number becomes null.

    A bare cast also accepts the Java forms ``1d``, ``1f`` and ``0x1p3``, which all hold
    one of a few letters; only the words for infinity may hold one.
    """
    text = _col(c).cast("string")
    plain = ~text.rlike("[dDfFxX]") | F.lower(F.trim(text)).isin(*INFINITE)
    return F.nanvl(F.when(plain, text.try_cast("double")), F.lit(None).cast("double"))


def clean_number(c: Column | str) -> Column:
    """Coerce, then fill missing with 0 and raise negatives to 0."""
    return F.greatest(F.coalesce(to_number(c), F.lit(0.0)), F.lit(0.0))


def half_even(c: Column | str, digits: int = 0) -> Column:
    """Round half to even."""
    if digits == 0:
        return F.rint(_col(c))
    scale = float(10**digits)
    return F.rint(_col(c) * scale) / scale


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; null when ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def amount_per_tonne(amount: Column | str, weight: Column | str) -> Column:
    """Amount divided by weight; null when the weight is 0."""
    return F.try_divide(_col(amount).cast("double"), _col(weight).cast("double"))


def freight_cost(cif: Column | str, fob: Column | str) -> Column:
    """Insurance and freight: CIF less FOB, never below 0."""
    gap = _col(cif) - _col(fob)
    return F.greatest(gap, F.lit(0).cast("double"))


def growth_pct(before: Column, after: Column) -> Column:
    """Percentage change; null when the base is 0."""
    return F.try_divide(
        after.cast("double") - before.cast("double"), before.cast("double")
    ) * 100


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
