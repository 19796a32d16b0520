"""Row filters of the report front end."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..storage import materialize
from .aggregates import dimension_totals, doubles
from .ranking import ranked_top_k

FILTER_COLUMNS = {"year": "year", "month": "month", "country": "country_description"}


def matching(df: DataFrame, **choices) -> DataFrame:
    """Rows whose year, month and country are among the chosen ones.

    An empty or absent list sets no condition. Conditions on the partition columns
    prune folders, the others are pushed to the Parquet scan.
    """
    unknown = set(choices) - set(FILTER_COLUMNS)
    if unknown:
        raise ValueError(f"unknown filters: {sorted(unknown)}")
    conditions = [
        F.col(FILTER_COLUMNS[name]).isin(*values) for name, values in choices.items() if values
    ]
    return df.where(reduce(lambda a, b: a & b, conditions)) if conditions else df


def filter_options(df: DataFrame, countries: int = 20, all_years_up_to: int = 5) -> DataFrame:
    """Choices on offer: ``(filter, position, choice, is_default, valuecif)``.

    One scan feeds all three lists. Years are preset to all of them up to
    ``all_years_up_to``, else to the last two; months to all, countries to none.
    """
    members = materialize(dimension_totals(df, ["year", "month", "country_description"]))
    # Years and months are calendar values, so their windows hold a handful of rows.
    year = F.col("member").cast("int")
    every = W.partitionBy("dimension")
    preset = (F.count(F.lit(1)).over(every) <= all_years_up_to) | (
        F.row_number().over(every.orderBy(year.desc())) <= 2
    )
    lists = {
        "year": (F.row_number().over(every.orderBy(year)), preset),
        "month": (F.row_number().over(every.orderBy("member")), F.lit(True)),
    }
    result = None
    for dimension, (position, default) in lists.items():
        part = members.where(F.col("dimension") == dimension).select(
            F.col("dimension").alias("filter"),
            position.alias("position"),
            F.col("member").alias("choice"),
            default.alias("is_default"),
            "valuecif",
        )
        result = part if result is None else result.unionByName(part)
    largest = ranked_top_k(
        members.where(F.col("dimension") == "country_description"), "valuecif", "member", countries
    ).select(
        F.lit("country").alias("filter"),
        F.col("rank").alias("position"),
        F.col("member").alias("choice"),
        F.lit(False).alias("is_default"),
        "valuecif",
    )
    return doubles(result.unionByName(largest))
