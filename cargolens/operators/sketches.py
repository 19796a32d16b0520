"""Mergeable sketches of columns: approximate percentiles and distinct counts, by parameter, beside the exact forms.

Sketches can be stored by month and merged later, so a percentile or a number of different values over any months needs
no scan of the records, and a restated month has its sketches replaced. Their size does not grow with the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameters: of a quantile sketch, and the binary logarithm of a distinct sketch's registers.
K, LOG_REGISTERS = 400, 12


def rank_error(k: int = K) -> float:
    """Bound on how far the rank of a quantile sketch's value is off, as a share of the rows (99 % confidence).

    The published bound for all quantiles of one sketch together.
    """
    return 2.446 / k**0.9433


def distinct_error(log_registers: int = LOG_REGISTERS) -> float:
    """Three standard errors of a distinct sketch, as a share of the number."""
    return 3 * 1.04 / math.sqrt(2**log_registers)


def sketched(df: DataFrame, columns, groups=("year", "month_number"), texts=(), k: int = K) -> DataFrame:
    """One row per group: a quantile sketch of each column's numbers and a distinct sketch of each text column."""
    numbers = [F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(c) for c in columns]
    values = [F.hll_sketch_agg(c, LOG_REGISTERS).alias(c) for c in texts]
    counts = [F.count(c).alias(f"{c}_rows") for c in columns]
    return df.groupBy(*groups).agg(*numbers, *values, *counts)


def merged(sketches: DataFrame, columns, groups=(), texts=()) -> DataFrame:
    """The sketches of coarser groups, or of everything, from stored ones."""
    parts = [F.kll_merge_agg_double(c).alias(c) for c in columns] + [F.hll_union_agg(c).alias(c) for c in texts]
    return sketches.groupBy(*groups).agg(*parts, *[F.sum(f"{c}_rows").alias(f"{c}_rows") for c in columns])


def points(sketches: DataFrame, column: str, percents, groups=()) -> DataFrame:
    """``(groups, percentile, value)`` of each row's sketch; groups without a number, and null groups, have none."""
    held = sketches.where(F.col(f"{column}_rows") > 0).dropna(subset=list(groups))
    ranks = F.array(*[F.lit(p / 100) for p in sorted(percents)])
    values = F.kll_sketch_get_quantile_double(column, ranks)
    names = F.array(*[F.lit(float(p)) for p in sorted(percents)])
    pairs = F.arrays_zip(names.alias("percentile"), values.alias("value"))
    return held.select(*groups, F.inline(pairs).alias("percentile", "value"))


def distinct(sketches: DataFrame, column: str) -> Column:
    """Approximate number of different values, to be selected from merged sketches."""
    return F.hll_sketch_estimate(column)


def rank_range(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """For each ``(percentile, value)`` the share of rows below the value and up to it, exact, from one scan.

    ``values`` holds a few rows; they meet the table as one array.
    """
    wanted = values.agg(F.collect_list(F.struct("percentile", "value")).alias("w")).select("w").scalar()
    number = F.col(column).cast("double")
    rows = df.where(number.isNotNull()).select(number.alias("v"), F.explode(wanted).alias("w"))
    return rows.groupBy("w.percentile", "w.value").agg(
        (F.count_if(F.col("v") < F.col("w.value")) / F.count(F.lit(1))).alias("below"),
        (F.count_if(F.col("v") <= F.col("w.value")) / F.count(F.lit(1))).alias("upto"),
        F.count(F.lit(1)).alias("row_count"),
    )
