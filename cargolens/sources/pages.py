"""A stored order of a table, so that any page is read from the blocks it lies in.

The rows are range-sorted once and written with the block (sort task) they came to lie in as their folder, each row with its
place there. A second table has one row for each block: how many rows lie before it and in it, and its first keys. A page
finds its blocks there, a handful of rows, and then reads these folders only; it is neither sorted nor cut by a limit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import unsorted_writes

_SHIFT = 33  # of the ids that Spark numbers a task's rows with


@dataclass
class PageIndex:
    """Where the sorted rows and their blocks lie, with the rows' own columns."""

    path: str
    schema: T.StructType

    def blocks(self, spark: SparkSession) -> DataFrame:
        """``(block, before, row_count, first_keys)`` in order."""
        return spark.read.parquet(f"{self.path}/blocks").orderBy("before")

    def row_count(self, spark: SparkSession) -> int:
        return self.blocks(spark).agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0]

    def page(self, spark: SparkSession, size: int, number: int = 1) -> DataFrame:
        """Page ``number`` (from 1) with each row's ``row_number``; empty beyond the end."""
        first, last = size * (number - 1) + 1, size * number
        return self.rows_between(spark, first, last)

    def rows_between(self, spark: SparkSession, first: int, last: int) -> DataFrame:
        """Rows number ``first`` to ``last`` of the order, with their ``row_number``."""
        touched = self.blocks(spark).where((F.col("before") < last) & (F.col("before") + F.col("row_count") >= first)).collect()
        schema = T.StructType([*self.schema.fields, T.StructField("_place", T.LongType()), T.StructField("_block", T.LongType())])
        if not touched:
            return spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField("row_number", T.LongType())]))
        folders = [f"{self.path}/rows/_block={b['block']}" for b in touched]
        rows = spark.read.schema(schema).option("basePath", f"{self.path}/rows").parquet(*folders)
        before = F.lit(None).cast("long")
        for block in touched:
            before = F.when(F.col("_block") == block["block"], F.lit(block["before"])).otherwise(before)
        rows = rows.withColumn("row_number", before + F.col("_place") + 1).drop("_place", "_block")
        return rows.where(F.col("row_number").between(first, last))


def build_page_index(df: DataFrame, path: str, keys, descending: bool = False) -> PageIndex:
    """Store the order of a table by ``keys``: ascending with nulls first, or descending with nulls last.

    Rows of equal keys are told apart by their place in the input, so a frequent key is spread over blocks like any
    other rows.
    """
    order = [F.desc_nulls_last(k) if descending else F.asc_nulls_first(k) for k in keys]
    own = df.withColumn("_input", F.monotonically_increasing_id()).orderBy(*order, "_input").drop("_input")
    own = own.withColumn("_id", F.monotonically_increasing_id())
    block = F.shiftright("_id", _SHIFT)
    placed = own.select(*df.columns, (F.col("_id") - F.shiftleft(block, _SHIFT)).alias("_place"), block.alias("_block"))
    spark = df.sparkSession
    with unsorted_writes(spark, 1):  # a task is one block: the sorted rows need no second sort
        placed.write.mode("overwrite").partitionBy("_block").parquet(f"{path}/rows")
    rows = spark.read.schema(placed.schema).parquet(f"{path}/rows")
    keyed = F.struct(*[F.col(k) for k in keys])
    # of all columns but the place only a block's first row is read
    first = rows.where("_place = 0").select("_block", keyed.alias("first_keys"))
    counts = rows.groupBy("_block").agg((F.max("_place") + 1).alias("row_count")).join(first, "_block")
    # one row for each sort task
    before = F.sum("row_count").over(W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1))
    counts = counts.select(F.col("_block").alias("block"), F.coalesce(before, F.lit(0)).alias("before"), "row_count", "first_keys")
    counts.write.mode("overwrite").parquet(f"{path}/blocks")
    return PageIndex(path, df.schema)
