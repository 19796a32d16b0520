"""Reading raw and cleaned import tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import year_of
from ..operators.clean import standard_names
from ..operators.filters import matching
from ..operators.running import numbered
from ..schema import PARTITION_COLUMNS, RAW_COLUMNS, present

# File texts read as missing.
MISSING_MARKS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

PAGE_KEYS = ("year", "month_number", "country_code", "commodity_code")


def raw_csv(
    spark: SparkSession,
    path,
    missing_marks=MISSING_MARKS,
    keep=(),
    multi_line: bool = False,
) -> DataFrame:
    """Raw files with a header, every column as text, in standard column names.

    Columns are found by their names in the header: known ones in any order, absent ones are null, others follow as
    they are. Files read together must have the same header; the read fails otherwise (read each layout by itself and
    append the frames). Missing marks become null except in the ``keep`` columns, for which a code such as ``NA`` is a
    value. Records are one line each and files are split over tasks, unless ``multi_line`` says that quoted texts
    have line breaks: then a file is one task's.
    """
    df = standard_names(
        spark.read.options(header=True, enforceSchema=False, multiLine=multi_line, escape='"').csv(path)
    )
    twice = sorted({c for c in df.columns if df.columns.count(c) > 1})
    if twice:
        raise ValueError(f"columns named twice: {', '.join(twice)}")

    def column(name: str):
        if name not in df.columns:
            return F.lit(None).cast("string").alias(name)
        if not missing_marks or name in keep:
            return F.col(f"`{name}`")
        return F.when(~F.col(f"`{name}`").isin(*missing_marks), F.col(f"`{name}`")).alias(name)

    return df.select(*[column(c) for c in (*RAW_COLUMNS, *[c for c in df.columns if c not in RAW_COLUMNS])])


def in_years(df: DataFrame, years=None) -> DataFrame:
    """Rows of the chosen years, taken from the month text; all rows without a choice."""
    if not years or "month" not in df.columns:
        return df
    dated = df.withColumn("year", year_of("month"))
    return dated.where(F.col("year").isin(*[str(y) for y in years]))


def cleaned(spark: SparkSession, path) -> DataFrame:
    """The stored table."""
    return spark.read.parquet(path)


def filtered(df: DataFrame, **choices) -> DataFrame:
    """Rows matching the year, month and country lists."""
    return matching(df, **choices)


def page(df: DataFrame, size: int, number: int = 1, keys=PAGE_KEYS, then=()) -> DataFrame:
    """Page ``number`` (from 1) in key order, nulls first; ``then`` names columns that break ties.

    Rows are counted by month first, which tells the months the page lies in (at most ``size`` of them come to the
    driver). Only those months are read again and sorted. ``page_after`` walks through many pages without counting.
    """
    if tuple(keys[:2]) != PARTITION_COLUMNS:
        raise ValueError("the order must begin with the columns the table is stored by")
    first, last = size * (number - 1) + 1, size * number
    counts = df.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("_n"))
    # one row for each month of the calendar: small enough for one window
    upto = F.sum("_n").over(W.orderBy(*PARTITION_COLUMNS).rowsBetween(W.unboundedPreceding, 0))
    months = counts.withColumn("_upto", upto).where((F.col("_upto") >= first) & (F.col("_upto") - F.col("_n") < last))
    months = months.orderBy("_upto").collect()
    if not months:
        return df.limit(0)
    before = months[0]["_upto"] - months[0]["_n"]
    rows = df.where(in_months([(m[0], m[1]) for m in months]))
    rows = numbered(rows, [F.asc(c) for c in (*keys, *then)], "_number")
    return rows.where(F.col("_number").between(first - before, last - before)).drop("_number")


def in_months(months: list[tuple]) -> Column:
    """Whether a row lies in one of a few months, of which parts may be null; prunes folders."""
    year, month = PARTITION_COLUMNS
    tests = [F.col(year).eqNullSafe(F.lit(y)) & F.col(month).eqNullSafe(F.lit(m)) for y, m in months]
    return reduce(lambda a, b: a | b, tests)


def page_after(df: DataFrame, last, size: int, keys) -> DataFrame:
    """The next page after the key values ``last`` (none for the first page), without reading earlier pages.

    ``keys`` together must be unique; they may be null, and nulls come first. The comparison on the first key alone is
    repeated as a plain condition so that folders before it are pruned.
    """
    order = [F.asc_nulls_first(k) for k in keys]
    if last is None:
        return df.orderBy(*order).limit(size)
    tests = []
    for place, key in enumerate(keys):
        equal = [F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(keys[:place], last)]
        beyond = F.col(key).isNotNull() if last[place] is None else F.col(key) > F.lit(last[place])
        tests.append(reduce(lambda a, b: a & b, [*equal, beyond]))
    later = df.where(reduce(lambda a, b: a | b, tests))
    if last[0] is not None:
        later = later.where(F.col(keys[0]) >= F.lit(last[0]))
    return later.orderBy(*order).limit(size)


# Columns shown in a preview.
PREVIEW_COLUMNS = (
    "month",
    "year",
    "country_description",
    "commodity_description",
    "mode_description",
    "valuefob",
    "valuecif",
    "weight",
    "quantity",
)


def preview(df: DataFrame, columns=PREVIEW_COLUMNS, rows: int = 10, order=None) -> DataFrame:
    """The first rows of the available chosen columns, in the given or column order."""
    columns = present(df, columns)
    return df.select(*columns).orderBy(*(order or columns)).limit(rows)
