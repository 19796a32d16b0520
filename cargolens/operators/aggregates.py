"""Grouped and grand totals.

Money columns are decimals, so their sums do not depend on row order. They stay
decimal through every regrouping and become doubles once, in the last projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import MEASURES, present


def keyed(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose grouping keys are all set: null keys form no group."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return df.where(condition)


def total(column: str | Column) -> Column:
    """Sum that is 0, not null, when no value is set."""
    return F.coalesce(F.sum(column), F.lit(0))


#: Column of a stored aggregate (``streaming.rollups``): how many records a row stands for.
RECORDS = "records_added_up"


def set_count(column: str) -> str:
    """Column of a stored aggregate: how many of a row's records set ``column``."""
    return f"{column}_records"


def records(df: DataFrame, column: str | None = None) -> Column:
    """Number of records, or of those whose ``column`` is set; rows of a stored aggregate stand for many."""
    if RECORDS not in df.columns:
        return F.count(F.lit(1) if column is None else F.col(column))
    return total(F.col(RECORDS) if column is None else F.when(F.col(column).isNotNull(), F.col(RECORDS)))


def values_set(df: DataFrame, column: str) -> Column:
    """Number of records that set a measure."""
    return total(set_count(column)) if set_count(column) in df.columns else F.count(column)


def mean(df: DataFrame, column: str) -> Column:
    """Mean of the set values, from the exact sum."""
    return F.try_divide(F.sum(column).cast("double"), values_set(df, column).cast("double"))


def column_totals(df: DataFrame, columns) -> Column:
    """Struct of column sums as a scalar subquery.

    It names every measure of an aggregate, so its plan below the last step equals
    the plan of the aggregate itself and Spark runs that shuffle only once.
    """
    sums = [F.sum(c).alias(c) for c in columns]
    return df.agg(F.struct(*sums).alias("totals")).scalar()


def doubles(df: DataFrame, columns=None) -> DataFrame:
    """Decimal columns as doubles, in the same column order."""
    names = {
        name
        for name, kind in df.dtypes
        if kind.startswith("decimal") and (columns is None or name in columns)
    }
    return df.select(
        *[F.col(c).cast("double").alias(c) if c in names else F.col(c) for c in df.columns]
    )


def group_totals(
    df: DataFrame, keys, measures=MEASURES, count: str | None = "record_count"
) -> DataFrame:
    """Sums per key, and the number of rows with a month, as decimals."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    outputs = [total(m).alias(m) for m in present(df, measures)]
    if count:
        outputs.append(records(df, "month" if "month" in df.columns else None).alias(count))
    return keyed(df, *keys).groupBy(*keys).agg(*outputs)


def group_profile(
    df: DataFrame,
    keys,
    measures=MEASURES,
    count: str | None = "record_count",
    share_of=("valuecif",),
) -> DataFrame:
    """Sums and row counts per key with each named measure as a percentage of its total."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    grouped = group_totals(df, keys, measures, count)
    if share_of:
        grouped = with_shares(grouped, share_of, [c for c in grouped.columns if c not in keys])
    return doubles(grouped)


def with_shares(df: DataFrame, columns, measures) -> DataFrame:
    """Add ``<column>_pct``; ``measures`` are all measure columns of the aggregate."""
    totals = column_totals(df, measures)
    return df.withColumns(
        {
            f"{c}_pct": F.try_divide(F.col(c).cast("double"), totals[c].cast("double")) * 100
            for c in columns
        }
    )


def grand_totals(df: DataFrame, measures=MEASURES, means=("valuefob", "weight")) -> DataFrame:
    """One row: record count, sums and means."""
    return df.agg(
        records(df).alias("total_records"),
        *[total(m).cast("double").alias(f"total_{m}") for m in present(df, measures)],
        *[
            mean(df, m).alias(f"mean_{m}")
            for m in present(df, means)
        ],
    )


def year_range(df: DataFrame) -> DataFrame:
    """First, last and all years."""
    return df.agg(
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
        F.array_sort(F.collect_set("year")).alias("years"),
    )


def dimension_totals(df: DataFrame, dimensions, measures=("valuecif",)) -> DataFrame:
    """Totals of several single dimensions and of the whole table from one scan.

    Grouping sets with one column each: map-side aggregation leaves one row per
    member and task, and a single shuffle serves all dimensions. Rows are
    ``(dimension, member, record_count, measures)``; the whole table is ``total``.
    Callers that take several lists from it store it first (``materialize``): a filter on
    the dimension would otherwise move below the aggregate and split it into many scans.
    """
    dimensions = list(dimensions)
    measures = present(df, measures)
    rows = df.select(*[F.col(d).cast("string").alias(d) for d in dimensions], *measures, *present(df, [RECORDS]))
    grouped = (
        rows.groupingSets([[d] for d in dimensions] + [[]], *dimensions)
        .agg(
            F.grouping_id().alias("_set"),
            records(rows).alias("record_count"),
            *[total(m).alias(m) for m in measures],
        )
    )
    everything = 2 ** len(dimensions) - 1
    name, member = F.lit("total"), F.lit(None).cast("string")
    for place, dimension in enumerate(dimensions):
        # A set bit marks a column that is not grouped by; the first column is the highest bit.
        alone = everything - 2 ** (len(dimensions) - 1 - place)
        name = F.when(F.col("_set") == alone, dimension).otherwise(name)
        member = F.when(F.col("_set") == alone, F.col(dimension)).otherwise(member)
    return grouped.select(
        name.alias("dimension"), member.alias("member"), "record_count", *measures
    ).where((F.col("dimension") == "total") | F.col("member").isNotNull())
