"""Exact running sums over a global order without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..storage import materialize


POSITION_BITS = 33


def _placed(df: DataFrame, order: list[Column]) -> DataFrame:
    """Range-sorted rows with their sort block and place, written once.

    The id of a row holds its sort task in the upper bits and its position there in the
    lower ones. Written to the shared checkpoint folder, both stay fixed, also when a
    later task is run again.
    """
    return materialize(
        df.orderBy(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_block", F.shiftright("_place", POSITION_BITS))
    )


def _offsets(placed: DataFrame, measure: Column) -> DataFrame:
    """Total of all earlier blocks per block: one row per sort task."""
    before = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    sums = placed.groupBy("_block").agg(measure.alias("_sum"))
    earlier = F.coalesce(F.sum("_sum").over(before), F.lit(0))
    return sums.select("_block", earlier.alias("_offset"))


def running_sum(df: DataFrame, value: str, order: list[Column], out: str) -> DataFrame:
    """Add the sum of ``value`` over all rows up to and including this one.

    ``order`` must be total. Each sort block gets its own running sum, to which the sum
    of the earlier blocks is added. There is one block per sort task, so the offsets
    stay below ``spark.sql.shuffle.partitions`` rows and can be broadcast.
    """
    placed = _placed(df, order)
    inside = W.partitionBy("_block").orderBy("_place").rowsBetween(W.unboundedPreceding, 0)
    return (
        placed.withColumn(out, F.sum(value).over(inside))
        .join(F.broadcast(_offsets(placed, F.sum(value))), "_block")
        .withColumn(out, F.col(out) + F.col("_offset"))
        .drop("_block", "_place", "_offset")
    )


def numbered(df: DataFrame, order: list[Column], out: str = "row_number") -> DataFrame:
    """Add the row's number from 1 in a total order, without a one-task window."""
    placed = _placed(df, order)
    position = F.col("_place") - F.shiftleft("_block", POSITION_BITS) + 1
    return (
        placed.join(F.broadcast(_offsets(placed, F.count(F.lit(1)))), "_block")
        .withColumn(out, F.col("_offset") + position)
        .drop("_block", "_place", "_offset")
    )


def with_running_share(
    df: DataFrame, value: str, order: list[Column], whole: Column, out: str = "cumulative_pct"
) -> DataFrame:
    """Add the running sum of ``value`` as a percentage of ``whole``.

    ``whole`` is stored with the rows, so it is not computed again after the write.
    """
    summed = running_sum(df.withColumn("_whole", whole), value, order, "_running")
    share = F.try_divide(F.col("_running").cast("double"), F.col("_whole").cast("double")) * 100
    return summed.withColumn(out, share).drop("_running", "_whole")
