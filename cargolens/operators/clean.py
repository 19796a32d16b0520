"""Cleaning steps for raw import records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    amount_per_tonne,
    clean_number,
    freight_cost,
    half_even,
    map_units,
    month_name,
    month_number,
    normalize_text,
    year_of,
)
from ..schema import MEASURES, TEXT_COLUMNS, present


def standard_names(df: DataFrame) -> DataFrame:
    """Lower-case column names with underscores for blanks."""
    return df.toDF(*[name.lower().replace(" ", "_") for name in df.columns])


def clean_numbers(df: DataFrame, columns=MEASURES) -> DataFrame:
    """The columns as numbers, all by one lambda over their array.

    Spark ends a generated method there. The steps of a whole cleaning in one method are above 8,000 bytes of code, from
    which on the JVM no longer compiles it.
    """
    names = present(df, columns)
    if not names:
        return df
    numbers = F.transform(F.array(*[F.col(c).cast("string") for c in names]), clean_number)
    found = df.withColumn("_numbers", numbers)
    return found.withColumns({c: F.col("_numbers")[i] for i, c in enumerate(names)}).drop("_numbers")


def clean_texts(df: DataFrame, columns=TEXT_COLUMNS) -> DataFrame:
    return df.withColumns({c: normalize_text(c) for c in present(df, columns)})


def standard_units(df: DataFrame, keep_original: bool = False) -> DataFrame:
    """Map unit spellings and round counts of the unit ``Number`` half to even."""
    if "unit_quantity" not in df.columns:
        return df
    if keep_original:
        df = df.withColumn("unit_quantity_original", F.col("unit_quantity"))
    df = df.withColumn("unit_quantity", map_units("unit_quantity"))
    if "quantity" in df.columns:
        rounded = F.when(F.col("unit_quantity") == "Number", half_even("quantity"))
        df = df.withColumn("quantity", rounded.otherwise(F.col("quantity")))
    return df


def split_month(df: DataFrame) -> DataFrame:
    """Month text to name and number; ``year`` is derived when it is absent."""
    if "year" in df.columns:
        year = F.col("year").try_cast("int")
    elif "month" in df.columns:
        year = F.coalesce(year_of("month").cast("int"), F.lit(0))
    else:
        year = F.lit(0)
    df = df.withColumn("year", year)
    if "month" in df.columns:
        # the number from the name that is there by then: the pattern runs once a row
        df = df.withColumn("month", month_name("month")).withColumn("month_number", month_number("month"))
    return df


def derive_values(df: DataFrame) -> DataFrame:
    """Value per tonne (FOB and CIF) and insurance and freight cost."""
    have = set(df.columns)
    new = {}
    if {"weight", "valuefob"} <= have:
        new["value_per_tonne_fob"] = amount_per_tonne("valuefob", "weight")
    if {"weight", "valuecif"} <= have:
        new["value_per_tonne_cif"] = amount_per_tonne("valuecif", "weight")
    if {"valuefob", "valuecif"} <= have:
        new["insurance_freight_cost"] = freight_cost("valuecif", "valuefob")
    return df.withColumns(new) if new else df


def clean_columns(df: DataFrame, keep_original_unit: bool = False) -> DataFrame:
    """Every step on the given columns, without derived values: one narrow stage."""
    df = clean_numbers(standard_names(df))
    return split_month(standard_units(clean_texts(df), keep_original_unit))


def clean_records(df: DataFrame, keep_original_unit: bool = False) -> DataFrame:
    """All row-wise steps in order, without removing duplicates."""
    return derive_values(clean_columns(df, keep_original_unit))


def distinct_rows(df: DataFrame) -> DataFrame:
    """One of each set of equal rows; equal copies merge before the shuffle."""
    return df.dropDuplicates()


def clean_imports(df: DataFrame, keep_original_unit: bool = False) -> DataFrame:
    """Cleaned, distinct and derived. Derived values follow from the other columns, so
    they are added after the shuffle that removes duplicates."""
    return derive_values(distinct_rows(clean_columns(df, keep_original_unit)))


def unit_changes(cleaned: DataFrame) -> DataFrame:
    """Rows per changed (original, standard) unit pair; needs the original unit kept."""
    return (
        cleaned.where(F.col("unit_quantity_original") != F.col("unit_quantity"))
        .groupBy("unit_quantity_original", "unit_quantity")
        .agg(F.count(F.lit(1)).alias("changed_rows"))
    )
