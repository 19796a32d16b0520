"""Supplier concentration, commodity dependence and their combination."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import combined_class, combined_score, concentration_class, dependence_class
from ..functions.classes import COMBINED_STEPS, CONCENTRATION_STEPS, DEPENDENCE_STEPS
from .aggregates import column_totals, doubles, group_totals, keyed, records, total
from .ranking import ranked_top_k, top_k
from .running import with_running_share

ITEM, SUPPLIER = "commodity_description", "country_description"


def supplier_shares(
    df: DataFrame, item: str = ITEM, supplier: str = SUPPLIER, value: str = "valuecif"
) -> DataFrame:
    """Each supplier's value and percentage of the item's total.

    The first aggregate leaves at most one row per supplier of an item, so the window
    over an item stays small even when one item holds a large part of all rows.
    """
    pairs = group_totals(df, [item, supplier], [value], None)
    whole = F.sum(value).over(W.partitionBy(item))
    share = F.try_divide(F.col(value).cast("double"), whole.cast("double")) * 100
    return pairs.select(
        item,
        supplier,
        value,
        whole.alias("total_value"),
        share.alias("country_share"),
    )


def concentration(
    df: DataFrame,
    item: str = ITEM,
    supplier: str = SUPPLIER,
    value: str = "valuecif",
    steps=CONCENTRATION_STEPS,
) -> DataFrame:
    """Herfindahl index, largest share, three largest shares and risk class per item."""
    order = W.partitionBy(item).orderBy(F.desc(value), F.asc(supplier))
    ranked = supplier_shares(df, item, supplier, value).withColumn(
        "_place", F.row_number().over(order)
    )
    grouped = ranked.groupBy(item).agg(
        F.max("total_value").cast("double").alias("total_value"),
        total(F.col("country_share") * F.col("country_share")).alias("hhi_index"),
        F.max("country_share").alias("top_country_share"),
        total(F.when(F.col("_place") <= 3, F.col("country_share"))).alias("top3_country_share"),
        F.max(F.when(F.col("_place") == 1, F.col(supplier))).alias("top_country"),
    )
    return grouped.withColumns(
        {
            "total_value_billions": F.col("total_value") / 1e9,
            "risk_level": concentration_class(
                F.col("hhi_index"), F.col("top_country_share"), steps
            ),
        }
    )


def most_concentrated(
    concentrated: DataFrame, floor_billions: float = 1.0, k: int = 20, item: str = ITEM
) -> DataFrame:
    """The k items with the highest index among those worth at least the floor."""
    large = concentrated.where(F.col("total_value_billions") >= floor_billions)
    return ranked_top_k(large, "hhi_index", item, k)


def dependence(
    df: DataFrame,
    item: str = ITEM,
    value: str = "valuecif",
    steps=DEPENDENCE_STEPS,
    cumulative: str | None = None,
    details: bool = True,
) -> DataFrame:
    """Each item's share of all imports, and its dependence class.

    ``cumulative`` adds the running share in ``"name"`` or ``"value"`` order, and
    ``details`` the weight and the record count. Rows without an item count towards the total but form no item; they are dropped by a
    count so that the total and the items come from the same shuffle.
    """
    counted = records(df, "month" if "month" in df.columns else None)
    more = [total("weight").alias("weight"), counted.alias("record_count")]
    grouped = df.groupBy(item).agg(
        total(value).alias(value), *(more if details else []), F.count(item).alias("_keyed")
    )
    whole = column_totals(grouped, [c for c in grouped.columns if c != item])[value]
    share = F.try_divide(F.col(value).cast("double"), whole.cast("double")) * 100
    result = (
        grouped.where(F.col("_keyed") > 0).drop("_keyed").withColumn("dependence_pct", share)
    )
    if cumulative == "name":
        result = with_running_share(result, value, [F.asc(item)], whole)
    elif cumulative == "value":
        result = with_running_share(result, value, [F.desc(value), F.asc(item)], whole)
    elif cumulative is not None:
        raise ValueError("cumulative must be 'name', 'value' or None")
    result = doubles(result)
    return result.withColumn("total_value_billions", F.col(value) / 1e9).withColumn(
        "dependence_level",
        dependence_class(F.col("dependence_pct"), F.col("total_value_billions"), steps),
    )


def most_critical(dependent: DataFrame, k: int = 20, item: str = ITEM) -> DataFrame:
    """The k largest items of the two highest dependence classes."""
    severe = dependent.where(F.col("dependence_level").isin("CRITICAL", "HIGH"))
    return ranked_top_k(severe, "dependence_pct", item, k)


def join_risks(concentrated: DataFrame, dependent: DataFrame, item: str = ITEM) -> DataFrame:
    """Concentration with the dependence share and class of the same item."""
    return concentrated.join(
        dependent.select(item, "dependence_pct", "dependence_level"), item, "inner"
    )


def scored(risks: DataFrame, floor_billions: float = 1.0, steps=COMBINED_STEPS) -> DataFrame:
    """Combined score and class of the items worth at least the floor."""
    return (
        risks.where(F.col("total_value_billions") >= floor_billions)
        .withColumn("combined_risk_score", combined_score(F.col("risk_level"), F.col("dependence_level")))
        .withColumn("overall_risk", combined_class(F.col("combined_risk_score"), steps))
    )


def commodity_risk(
    df: DataFrame, item: str = ITEM, supplier: str = SUPPLIER, value: str = "valuecif"
) -> DataFrame:
    """Concentration and dependence of each item from one scan, without the join.

    Equal to ``join_risks(concentration(df), dependence(df))``: rows without a supplier
    count for dependence only, rows without an item for the total only.
    """
    pairs = df.groupBy(item, supplier).agg(
        total(value).alias(value),
        F.count(supplier).alias("_supplied"),
        F.count(item).alias("_keyed"),
    )
    whole = column_totals(pairs, [value, "_supplied", "_keyed"])[value]
    supplied = F.when(F.col("_supplied") > 0, F.col(value))
    per_item = W.partitionBy(item)
    order = per_item.orderBy(F.desc_nulls_last("_supplied_value"), F.asc(supplier))
    shares = (
        pairs.where(F.col("_keyed") > 0)
        .withColumn("_supplied_value", supplied)
        .withColumn("_total", F.sum("_supplied_value").over(per_item))
        .withColumn("_place", F.row_number().over(order))
        .withColumn(
            "_share",
            F.try_divide(F.col("_supplied_value").cast("double"), F.col("_total").cast("double")) * 100,
        )
    )
    grouped = shares.groupBy(item).agg(
        F.max("_total").cast("double").alias("total_value"),
        total(F.col("_share") * F.col("_share")).alias("hhi_index"),
        F.max("_share").alias("top_country_share"),
        total(F.when(F.col("_place") <= 3, F.col("_share"))).alias("top3_country_share"),
        F.max(F.when(F.col("_place") == 1, F.col(supplier))).alias("top_country"),
        F.sum(value).cast("double").alias("_value"),
        F.max("_supplied").alias("_any"),
    )
    return (
        grouped.where(F.col("_any") > 0)
        .withColumn("total_value_billions", F.col("total_value") / 1e9)
        .withColumn(
            "risk_level", concentration_class(F.col("hhi_index"), F.col("top_country_share"))
        )
        .withColumn("dependence_pct", F.try_divide(F.col("_value"), whole.cast("double")) * 100)
        .withColumn(
            "dependence_level", dependence_class(F.col("dependence_pct"), F.col("_value") / 1e9)
        )
        .drop("_value", "_any")
    )


def combined_risk(df: DataFrame, floor_billions: float = 1.0, k: int = 20) -> DataFrame:
    """The k items with the highest combined score."""
    return top_k(scored(commodity_risk(df), floor_billions), "combined_risk_score", ITEM, k)


def class_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per class."""
    return keyed(df, column).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
