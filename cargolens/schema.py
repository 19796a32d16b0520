"""Column names and types of the import tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEASURES = ("valuefob", "valuecif", "weight", "quantity")
AMOUNTS = ("valuefob", "valuecif")

# The cleaned text columns, and the shorter merge key below.
TEXT_COLUMNS = (
    "country_description",
    "commodity_description",
    "mode_description",
    "ausport_description",
    "osport_description",
    "state",
    "unit_quantity",
)

#: One stored row per month, commodity, country, ports, mode, state and unit.
GRAIN = (
    "year",
    "month_number",
    "country_code",
    "commodity_code",
    "ausport_code",
    "osport_code",
    "mode",
    "mode_description",
    "state",
    "unit_quantity",
)

#: The shorter merge key, which ignores state, mode, origin port and unit.
SHORT_KEY = ("year", "month_number", "country_code", "commodity_code", "ausport_code")

PARTITION_COLUMNS = ("year", "month_number")

#: Money is kept in whole cents, so sums are exact and independent of row order.
AMOUNT_TYPE = T.DecimalType(20, 2)

RAW_COLUMNS = (
    "month",
    "mode",
    "mode_description",
    "commodity_code",
    "commodity_description",
    "country_code",
    "country_description",
    "ausport_code",
    "ausport_description",
    "osport_code",
    "osport_description",
    "state",
    "weight",
    "valuefob",
    "valuecif",
    "quantity",
    "unit_quantity",
)

IMPORTS_SCHEMA = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("month_number", T.IntegerType()),
        T.StructField("month", T.StringType()),
        T.StructField("mode", T.StringType()),
        T.StructField("mode_description", T.StringType()),
        T.StructField("commodity_code", T.StringType()),
        T.StructField("commodity_description", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("country_description", T.StringType()),
        T.StructField("ausport_code", T.StringType()),
        T.StructField("ausport_description", T.StringType()),
        T.StructField("osport_code", T.StringType()),
        T.StructField("osport_description", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("weight", T.DoubleType()),
        T.StructField("valuefob", AMOUNT_TYPE),
        T.StructField("valuecif", AMOUNT_TYPE),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("unit_quantity", T.StringType()),
        T.StructField("value_per_tonne_fob", T.DoubleType()),
        T.StructField("value_per_tonne_cif", T.DoubleType()),
        T.StructField("insurance_freight_cost", T.DoubleType()),
    ]
)


def present(df: DataFrame, names) -> list[str]:
    """The given names that are columns of ``df``, in the given order."""
    return [name for name in names if name in df.columns]


def conform(df: DataFrame) -> DataFrame:
    """Project onto the stored schema; absent columns become null.

    An amount that the stored type can't hold (infinite, or 18 digits before the point and more) becomes null;
    ``lost_amounts`` counts these.
    """
    return df.select(
        *[
            (
                F.col(f.name).try_cast(f.dataType)
                if f.name in df.columns
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in IMPORTS_SCHEMA.fields
        ]
    )


def lost_amounts(df: DataFrame) -> DataFrame:
    """One row for each amount column: its numbers, and how many of them the stored type can't hold."""
    names = present(df, AMOUNTS)
    lost = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(AMOUNT_TYPE).isNull()).alias(c) for c in names]
    held = [F.count(c).alias(f"{c}_numbers") for c in names]
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}_numbers").alias("numbers"), F.col(c).alias("lost_count"))
        for c in names
    ]
    return df.agg(*lost, *held).select(F.inline(F.array(*rows)))
