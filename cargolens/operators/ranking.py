"""Top-k, ranks and per-group winners. Ties are broken by key, ascending."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _order(by: str, ties, ascending: bool):
    ties = [ties] if isinstance(ties, str) else list(ties)
    first = F.asc_nulls_last(by) if ascending else F.desc_nulls_last(by)
    return [first, *[F.asc(t) for t in ties]]


def top_k(df: DataFrame, by: str, ties, k: int, ascending: bool = False) -> DataFrame:
    """The k largest (or smallest) rows, nulls last; per-task heaps, then one merge."""
    return df.orderBy(*_order(by, ties, ascending)).limit(k)


def bottom_k(df: DataFrame, by: str, ties, k: int) -> DataFrame:
    return top_k(df, by, ties, k, ascending=True)


def ranked_top_k(df: DataFrame, by: str, ties, k: int, ascending: bool = False) -> DataFrame:
    """Top-k with ``rank`` 1..k; the unpartitioned window sees at most k rows."""
    rank = F.row_number().over(W.orderBy(*_order(by, ties, ascending)))
    return top_k(df, by, ties, k, ascending).withColumn("rank", rank)


def last_of_order(df: DataFrame, by: str, ties, k: int) -> DataFrame:
    """The last k rows of a descending order, smallest first."""
    reverse = [F.asc_nulls_first(by), *[F.desc(t) for t in ([ties] if isinstance(ties, str) else ties)]]
    return df.orderBy(*reverse).limit(k)


def top_in_group(df: DataFrame, group, order, n: int, rank: str = "rank") -> DataFrame:
    """The first n rows of each group in the given total order.

    The rank filter lets Spark cut every task's share of a group to n rows before the
    shuffle, so one very large group does not gather in one task.
    """
    group = [group] if isinstance(group, str) else list(group)
    place = F.row_number().over(W.partitionBy(*group).orderBy(*order))
    return df.withColumn(rank, place).where(F.col(rank) <= n)


def argmax_order(by: str, member: str) -> Column:
    """Order for ``min_by`` that finds the largest ``by``, ties by name; no null member."""
    order = F.struct((-F.col(by)).alias("size"), F.col(member).alias("name"))
    return F.when(F.col(member).isNotNull(), order)


def largest_member(df: DataFrame, group: str, member: str, by: str, out: str) -> DataFrame:
    """Member with the largest value of each group, as a plain aggregate."""
    return df.groupBy(group).agg(F.min_by(member, argmax_order(by, member)).alias(out))
