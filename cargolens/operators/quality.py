"""Data quality profiles of raw and cleaned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import to_number
from ..functions.text import strip
from ..schema import MEASURES, TEXT_COLUMNS, present
from ..storage import stored
from . import sketches
from .aggregates import total
from .percentiles import group_points, percentile_points
from .ranking import top_in_group, top_k


#: Limits of the weight distribution (fixed values).
WEIGHT_LIMITS = {"below_1": ("<", 1), "below_0_1": ("<", 0.1), "below_0_001": ("<", 0.001), "above_1000": (">", 1000)}


def limited(value: Column, limit: tuple[str, float]) -> Column:
    """Whether a value lies beyond a limit of ``WEIGHT_LIMITS``."""
    return value < limit[1] if limit[0] == "<" else value > limit[1]


def _rows(pairs: list[tuple[str, dict[str, Column]]], label: str) -> Column:
    """Unpivot one wide row: a struct per label, exploded."""
    return F.inline(
        F.array(
            *[
                F.struct(F.lit(name).alias(label), *[c.alias(k) for k, c in fields.items()])
                for name, fields in pairs
            ]
        )
    )


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def missing_profile(df: DataFrame) -> DataFrame:
    """Columns with missing values: count and percentage, from one scan."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)],
    )
    rows = _rows(
        [
            (c, {"missing_count": F.col(f"_{i}"), "missing_pct": _share(F.col(f"_{i}"), F.col("_rows"))})
            for i, c in enumerate(df.columns)
        ],
        "column_name",
    )
    return counts.select(rows).where("missing_count > 0")


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows; null equals null."""
    copies = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    counted = copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    )
    return counted.withColumn("duplicate_pct", _share(F.col("duplicate_rows"), F.col("total_rows")))


def numeric_profile(df: DataFrame, columns=MEASURES) -> DataFrame:
    """Missing and negative counts, and min, max and mean after cleaning, per column."""
    columns = present(df, columns)
    numbers = df.select(*[to_number(c).alias(c) for c in columns])
    cleaned = {c: F.greatest(F.coalesce(F.col(c), F.lit(0.0)), F.lit(0.0)) for c in columns}
    wide = numbers.agg(
        *[
            expression.alias(f"{name}_{i}")
            for i, c in enumerate(columns)
            for name, expression in (
                ("missing", F.count_if(F.col(c).isNull())),
                ("negative", F.count_if(F.col(c) < 0)),
                ("min", F.min(cleaned[c])),
                ("max", F.max(cleaned[c])),
                ("mean", F.avg(cleaned[c])),
            )
        ]
    )
    names = {
        "missing": "missing_count",
        "negative": "negative_count",
        "min": "min_value",
        "max": "max_value",
        "mean": "mean_value",
    }
    return wide.select(
        _rows(
            [(c, {v: F.col(f"{k}_{i}") for k, v in names.items()}) for i, c in enumerate(columns)],
            "column_name",
        )
    )


def cardinality_profile(df: DataFrame, columns=TEXT_COLUMNS, exact: bool = True) -> DataFrame:
    """Number of different values per text column; ``exact=False`` uses a sketch."""
    columns = present(df, columns)
    count = F.countDistinct if exact else F.approx_count_distinct
    wide = df.agg(*[count(c).alias(f"_{i}") for i, c in enumerate(columns)])
    return wide.select(
        _rows([(c, {"distinct_values": F.col(f"_{i}")}) for i, c in enumerate(columns)], "column_name")
    )


def value_counts(df: DataFrame, column: str, k: int | None = None, by: str = "count") -> DataFrame:
    """Rows per value; with ``k`` the first k by count or by the value itself."""
    counted = (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    )
    if k is None:
        return counted
    if by == "count":
        return top_k(counted, "row_count", column, k)
    return counted.orderBy(column).limit(k)


def weight_distribution(df: DataFrame, column: str = "weight") -> DataFrame:
    """One row: min, max, mean, exact median, and counts of light and heavy records.

    The table is read once, when the function is called: its different weights with their numbers of records.
    """
    data = stored(df.select(to_number(column).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")), "weights")
    known = F.sum(F.when(F.col("w").isNotNull(), F.col("n")))
    median = percentile_points(data, "w", [50], times="n").select("value").scalar()
    found = data.agg(
        total("n").alias("total_rows"),
        F.min("w").alias("min_weight"),
        F.max("w").alias("max_weight"),
        F.try_divide(F.sum(F.col("w") * F.col("n")), known).alias("mean_weight"),
        *[total(F.when(limited(F.col("w"), limit), F.col("n"))).alias(name) for name, limit in WEIGHT_LIMITS.items()],
    )
    shares = {f"{name}_pct": _share(F.col(name), F.col("total_rows")) for name in WEIGHT_LIMITS}
    return found.select("*", median.alias("median_weight")).withColumns(shares)


def unit_quantities(df: DataFrame, unit: str = "unit_quantity", quantity: str = "quantity", exact: bool = True):
    """Count, min, max, mean and median of the quantity of each unit; ``exact=False`` takes medians from sketches.

    The exact form counts the different quantities of each unit when it is called.
    """
    data = df.where(F.col(unit).isNotNull()).select(unit, to_number(quantity).alias("q"))
    if not exact:
        sketch = sketches.sketched(data, ["q"], [unit])
        medians = sketches.points(sketch, "q", [50], [unit])
        n, sums = F.lit(1), {"mean_quantity": F.avg("q")}
    else:
        # read once: each quantity of a unit with its number of records, from which all else follows
        data = stored(data.groupBy(unit, "q").agg(F.count(F.lit(1)).alias("n")), "unit-quantities")
        medians = group_points(data, [unit], "q", [50], "n")
        n = F.col("n")
        known = F.sum(F.when(F.col("q").isNotNull(), n))
        sums = {"mean_quantity": F.try_divide(F.sum(F.col("q") * n), known)}
    grouped = data.groupBy(unit).agg(
        F.sum(n).alias("record_count"),
        F.min("q").alias("min_quantity"),
        F.max("q").alias("max_quantity"),
        *[c.alias(name) for name, c in sums.items()],
    )
    return grouped.join(medians.select(unit, F.col("value").alias("median_quantity")), unit, "left")


def _fractional(quantity: Column) -> Column:
    return quantity.isNotNull() & (quantity % 1 != 0)


def fractional_counts(df: DataFrame, unit: str = "unit_quantity", quantity: str = "quantity"):
    """Per unit that counts pieces: records, and those with a fraction; nulls are none."""
    q = to_number(quantity)
    grouped = (
        df.where(F.col(unit).ilike("%number%"))
        .groupBy(unit)
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.count_if(_fractional(q)).alias("fractional_count"),
        )
    )
    return grouped.withColumn(
        "fractional_pct", _share(F.col("fractional_count"), F.col("record_count"))
    )


def fractional_examples(df: DataFrame, order, k: int = 5) -> DataFrame:
    """The first k fractional counts in the given column order."""
    rows = df.where(F.col("unit_quantity").ilike("%number%") & _fractional(to_number("quantity")))
    return rows.orderBy(*order).limit(k)


def unit_variants(df: DataFrame, unit: str = "unit_quantity") -> DataFrame:
    """Units that differ only in case and outer blanks: ``(base_unit, unit, spellings)``, a row for each spelling.

    A join with the counts instead of a list: a base form may have any number of spellings.
    """
    variants = df.where(F.col(unit).isNotNull()).select(unit).distinct()
    variants = variants.select(strip(F.lower(unit)).alias("base_unit"), unit)
    counts = variants.groupBy("base_unit").agg(F.count(F.lit(1)).alias("spellings"))
    return variants.join(counts.where("spellings > 1"), "base_unit")


def non_positive_quantities(df: DataFrame, quantity: str = "quantity") -> DataFrame:
    q = to_number(quantity)
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(q <= 0).alias("non_positive_rows")
    )
    return counted.withColumn(
        "non_positive_pct", _share(F.col("non_positive_rows"), F.col("total_rows"))
    )


def shape_profile(df: DataFrame) -> DataFrame:
    """Rows of the table, and number of columns of each type."""
    kinds: dict[str, int] = {}
    for _, kind in df.dtypes:
        kinds[kind] = kinds.get(kind, 0) + 1
    counted = df.agg(F.count(F.lit(1)).alias("total_rows"))
    return counted.select(
        "total_rows",
        _rows([(k, {"column_count": F.lit(n)}) for k, n in sorted(kinds.items())], "column_type"),
    )


def unit_samples(
    df: DataFrame, order, units: int = 5, rows: int = 3, unit: str = "unit_quantity"
) -> DataFrame:
    """A few records of each of the most frequent units, in the given column order."""
    frequent = value_counts(df, unit, units).select(unit)
    kept = df.join(F.broadcast(frequent), unit, "left_semi")
    return top_in_group(kept, unit, order, rows)
