"""Year-over-year comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import growth_class, growth_pct
from ..schema import MEASURES, present
from .aggregates import column_totals, doubles, keyed, total
from .ranking import last_of_order, ranked_top_k, top_k


def two_year_totals(
    df: DataFrame, key: str, measures, base_year: int, year: int
) -> DataFrame:
    """Sums of each measure in both years per key, 0 where a year is missing.

    Only the two years are scanned; one shuffle on the key replaces a pivot.
    """
    rows = keyed(df, key).where(F.col("year").isin(base_year, year))
    return rows.groupBy(key).agg(
        *[
            total(F.when(F.col("year") == y, F.col(m))).alias(f"{m}_{y}")
            for m in measures
            for y in (base_year, year)
        ]
    )


def supplier_trends(
    df: DataFrame,
    base_year: int = 2024,
    year: int = 2025,
    key: str = "country_description",
    value: str = "valuecif",
    floor: float | None = 1e8,
) -> DataFrame:
    """Change, percentage change (0 from a zero base) and share change per supplier.

    Shares refer to all suppliers; only those above ``floor`` in either year are kept.
    """
    pivot = two_year_totals(df, key, [value], base_year, year)
    old, new = f"{value}_{base_year}", f"{value}_{year}"
    totals = column_totals(pivot, [old, new])
    before, after = F.col(old), F.col(new)
    zero = F.lit(0.0)
    result = pivot.select(
        F.col(key).alias("country"),
        before.cast("double").alias(f"value_{base_year}"),
        after.cast("double").alias(f"value_{year}"),
        (after - before).cast("double").alias("absolute_change"),
        F.coalesce(growth_pct(before, after), zero).alias("pct_change"),
        F.coalesce(
            F.try_divide(before.cast("double"), totals[old].cast("double")) * 100, zero
        ).alias(f"share_{base_year}"),
        F.coalesce(
            F.try_divide(after.cast("double"), totals[new].cast("double")) * 100, zero
        ).alias(f"share_{year}"),
    ).withColumn("share_change", F.col(f"share_{year}") - F.col(f"share_{base_year}"))
    if floor is None:
        return result
    return result.where(
        (F.col(f"value_{base_year}") > floor) | (F.col(f"value_{year}") > floor)
    )


def declining(trends: DataFrame, k: int = 15, key: str = "country") -> DataFrame:
    return ranked_top_k(trends, "absolute_change", key, k, ascending=True)


def growing(trends: DataFrame, k: int = 15, key: str = "country") -> DataFrame:
    return ranked_top_k(trends, "absolute_change", key, k)


def commodity_trends(
    df: DataFrame,
    base_year: int = 2024,
    year: int = 2025,
    key: str = "commodity_description",
    both_years: bool = True,
) -> DataFrame:
    """Values, FOB and weight in both years, growth rate (null from zero) and change."""
    measures = present(df, ("valuecif", "valuefob", "weight"))
    pivot = two_year_totals(df, key, measures, base_year, year)
    before, after = F.col(f"valuecif_{base_year}"), F.col(f"valuecif_{year}")
    if both_years:
        pivot = pivot.where((before > 0) & (after > 0))
    return doubles(
        pivot.withColumns(
            {
                "growth_rate_pct": growth_pct(before, after),
                "absolute_change": (after - before).cast("double"),
                "avg_value": (after + before).cast("double") / 2,
            }
        )
    )


def fastest_growing(trends: DataFrame, k: int = 10, key: str = "commodity_description") -> DataFrame:
    return ranked_top_k(trends, "growth_rate_pct", key, k)


def fastest_shrinking(
    trends: DataFrame, k: int = 10, key: str = "commodity_description"
) -> DataFrame:
    """The tail of the descending growth order, smallest first, ranked."""
    tail = last_of_order(trends.where(F.col("growth_rate_pct").isNotNull()), "growth_rate_pct", key, k)
    rank = F.row_number().over(W.orderBy(F.asc("growth_rate_pct"), F.asc(key)))
    return tail.withColumn("rank", rank)


def largest_gains(trends: DataFrame, k: int = 10, key: str = "commodity_description") -> DataFrame:
    return top_k(trends, "absolute_change", key, k)


def growth_counts(trends: DataFrame) -> DataFrame:
    """Growing, shrinking and stable items with their percentage of all items."""
    rows = trends.agg(F.count(F.lit(1)).alias("n")).scalar()
    named = trends.select(growth_class(F.col("growth_rate_pct")).alias("trend"))
    counted = keyed(named, "trend").groupBy("trend").agg(F.count(F.lit(1)).alias("items"))
    return counted.withColumn(
        "items_pct", F.try_divide(F.col("items").cast("double"), rows.cast("double")) * 100
    )


def monthly_series(df: DataFrame, measures=MEASURES) -> DataFrame:
    """Sums per month with the first day of the month as ``date``."""
    from ..functions import month_date

    keys = ["year", "month_number", "month"]
    sums = [total(m).cast("double").alias(m) for m in present(df, measures)]
    grouped = keyed(df, *keys).groupBy(*keys).agg(*sums)
    return grouped.withColumn("date", month_date())


def yearly_series(df: DataFrame, measures=MEASURES) -> DataFrame:
    """Sums and number of different months per year."""
    sums = [total(m).cast("double").alias(m) for m in present(df, measures)]
    return (
        keyed(df, "year")
        .groupBy("year")
        .agg(*sums, F.countDistinct("month").alias("months"))
    )


def yearly_growth(yearly: DataFrame, measures=MEASURES, exactly_two: bool = True) -> DataFrame:
    """Growth of each measure from the first to the second year.

    Given only when the base is above 0 and, with ``exactly_two``, when there are two
    years. The windows run over one row per year and measure.
    """
    measures = present(yearly, measures)
    long = yearly.select(
        "year",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value"))
                    for m in measures
                ]
            )
        ),
    )
    by_measure = W.partitionBy("measure")
    order = by_measure.orderBy("year")
    paired = long.select(
        "measure",
        F.lag("year").over(order).alias("first_year"),
        F.col("year").alias("second_year"),
        F.lag("value").over(order).alias("first_value"),
        F.col("value").alias("second_value"),
        F.row_number().over(order).alias("_place"),
        F.count(F.lit(1)).over(by_measure).alias("_years"),
    ).where((F.col("_place") == 2) & (F.col("first_value") > 0))
    if exactly_two:
        paired = paired.where(F.col("_years") == 2)
    return paired.drop("_place", "_years").withColumn(
        "growth_pct", growth_pct(F.col("first_value"), F.col("second_value"))
    )


def seasonal_means(df: DataFrame, measures=MEASURES) -> DataFrame:
    """Mean of each measure per calendar month, over all years."""
    from ..functions import month_label
    from .aggregates import mean

    means = [mean(df, m).alias(m) for m in present(df, measures)]
    grouped = keyed(df, "month_number").groupBy("month_number").agg(*means)
    return grouped.withColumn("month_name", month_label())
