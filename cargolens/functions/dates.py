"""Month and year expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names in calendar order.
MONTHS = (
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
)


def month_name(c: Column | str) -> Column:
    """Leading letters of ``'January 2024'``; null when there are none."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.regexp_extract(c.cast("string"), r"^([A-Za-z]+)", 1), F.lit(""))


def month_number(c: Column | str) -> Column:
    """1 to 12 for a full English month name, else null."""
    c = F.col(c) if isinstance(c, str) else c
    numbers = F.create_map(*[F.lit(v) for n, m in enumerate(MONTHS, 1) for v in (m, n)])
    return F.try_element_at(numbers, c)


def year_of(c: Column | str) -> Column:
    """First four digits of a text as text; null when there are none."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.regexp_extract(c.cast("string"), r"(\d{4})", 1), F.lit(""))


def month_date(year: Column | str = "year", number: Column | str = "month_number") -> Column:
    """First day of the month."""
    return F.make_date(year, number, F.lit(1))


def month_label(number: Column | str = "month_number") -> Column:
    """Short month name; empty for an unknown month."""
    return F.coalesce(
        F.date_format(F.make_date(F.lit(2000), number, F.lit(1)), "MMM"), F.lit("")
    )
