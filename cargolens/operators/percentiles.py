"""Exact linear-interpolation percentiles of large columns, and describe tables.

Two passes, both lazy, for any number of columns and groups. The first counts rows by bucket: a bucket is a value's
sign, binary exponent and leading mantissa bits, so buckets are ordered as the values are, their number is bounded by
the number format, and counts merge on the map side. Bucket ranks are exact, so they tell which buckets hold a wanted
rank. The second pass counts the distinct values of those buckets only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..storage import stored
from . import sketches

QUARTILES = (25, 50, 75)

#: Buckets of one power of two.
STEPS = 4096


def bucket_of(value: Column) -> Column:
    """Order-preserving whole number of a double; infinities and NaN are ends of their own."""
    size = F.abs(value)
    exponent = F.floor(F.log2(size))
    # 2 ** exponent alone leaves the range of doubles at its ends, two halves do not
    half = F.floor(exponent / 2)
    steps = F.floor(size / F.pow(F.lit(2.0), half) / F.pow(F.lit(2.0), exponent - half) * STEPS)
    place = (exponent + 1100) * 2 * STEPS + steps
    finite = F.when(size == 0, F.lit(0).cast("long")).when(value > 0, place).otherwise(-place)
    end = 1 << 60
    return (
        F.when(F.isnan(value), F.lit(end + 1))
        .when(size == float("inf"), F.when(value > 0, F.lit(end)).otherwise(F.lit(-end)))
        .otherwise(finite)
    )


def group_points(
    df: DataFrame, groups, value: str, percents, times: str | None = None, exact: bool = True
) -> DataFrame:
    """``(groups, percentile, value)``: percentiles of the non-null values of each group; null groups form none.

    ``times`` names a column that tells how many records a row stands for. With ``exact=False`` a value comes from a
    sketch of the group, from one pass; its rank is off by ``sketches.rank_error`` of the rows. A window of the first pass holds one group's buckets, one of the second the distinct values of one bucket: neither
    grows with the rows of a group.
    """
    groups, percents = list(groups), sorted(percents)
    if not exact:
        if times:
            raise ValueError("sketches take records, not counted values")
        return sketches.points(sketches.sketched(df, [value], groups), value, percents, groups)
    v = F.col(value).cast("double")
    data = df.select(*groups, v.alias("_v"), *([F.col(times).alias("_times")] if times else []))
    data = data.dropna(subset=[*groups, "_v"]).withColumn("_bucket", bucket_of(F.col("_v")))
    rows = F.sum("_times") if times else F.count(F.lit(1))
    return _points(data, data.groupBy(*groups, "_bucket").agg(rows.alias("_n")), groups, percents, rows)


def _points(data: DataFrame, buckets: DataFrame, groups: list[str], percents, rows: Column) -> DataFrame:
    """The second pass: ``data`` has ``(groups, _bucket, _v)``, ``buckets`` their number of rows ``_n``."""
    inside = W.partitionBy(*groups)
    buckets = buckets.withColumns(
        {
            "_rows": F.sum("_n").over(inside),
            "_upto": F.sum("_n").over(inside.orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)),
        }
    )

    def want(percent, upper: bool) -> Column:
        spot = (F.col("_rows") - 1) * (percent / 100)
        below = F.floor(spot)
        return F.struct(
            F.lit(float(percent)).alias("percent"),
            F.lit(upper).alias("upper"),
            (F.ceil(spot) if upper else below).alias("rank"),
            (spot - below).alias("share"),
        )

    wants = F.array(*[want(p, upper) for p in percents for upper in (False, True)])
    here = lambda w: (w["rank"] < F.col("_upto")) & (w["rank"] >= F.col("_upto") - F.col("_n"))
    chosen = buckets.select(
        *groups, "_bucket", (F.col("_upto") - F.col("_n")).alias("_from"), F.filter(wants, here).alias("_wants")
    ).where(F.size("_wants") > 0)
    if not groups:  # then there are at most two buckets for each percentile
        chosen = F.broadcast(chosen)

    # a bucket is chosen once, so one join both picks its rows and tells the ranks wanted there
    values = data.join(chosen, [*groups, "_bucket"]).groupBy(*groups, "_bucket", "_v")
    values = values.agg(rows.alias("_n"), F.any_value("_from").alias("_from"), F.any_value("_wants").alias("_wants"))
    order = W.partitionBy(*groups, "_bucket").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    values = values.withColumn("_upto", F.col("_from") + F.sum("_n").over(order))
    found = values.select(*groups, "_v", F.inline(F.filter("_wants", here)))
    found = found.groupBy(*groups, "percent").agg(
        F.max(F.when(~F.col("upper"), F.col("_v"))).alias("_low"),
        F.max(F.when(F.col("upper"), F.col("_v"))).alias("_high"),
        F.max("share").alias("_share"),
    )
    between = F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share")
    point = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(between)
    return found.select(*groups, F.col("percent").alias("percentile"), point.alias("value"))


def percentile_points(df: DataFrame, value: str, percents, exact: bool = True, times: str | None = None) -> DataFrame:
    """One row per percentile: ``(percentile, value)``; null values without rows."""
    spark = df.sparkSession
    every = spark.createDataFrame([(int(p), float(p)) for p in sorted(percents)], "percentile int, _p double")
    points = group_points(df, [], value, percents, times, exact).withColumnRenamed("percentile", "_p")
    return every.join(F.broadcast(points), "_p", "left").select("percentile", "value")


def group_medians(df: DataFrame, group: str, value: str, out: str = "median", exact: bool = True) -> DataFrame:
    """Median of each group, however large one group is."""
    return group_points(df, [group], value, [50], exact=exact).select(group, F.col("value").alias(out))


def describe(df: DataFrame, value: str, percents=QUARTILES, exact: bool = True) -> DataFrame:
    """Rows ``(statistic, value)``: count, mean, std, min, max and the percentiles."""
    return describe_table(df, [value], percents, exact).select("statistic", "value")


def describe_table(df: DataFrame, columns, percents=QUARTILES, exact: bool = True) -> DataFrame:
    """Describe rows of several columns: ``(column_name, statistic, value)``.

    The columns are stacked and read twice: once for their buckets, written when the function is called, which give the
    moments too, and once for the values of the buckets that hold a percentile. Sketches need no second pass.
    """
    spark, percents, key = df.sparkSession, sorted(percents or QUARTILES), ["column_name"]
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("_v")) for c in columns]
    data = df.select(F.inline(F.array(*pairs))).dropna(subset=["_v"]).withColumn("_bucket", bucket_of(F.col("_v")))
    rows = F.count(F.lit(1))
    of_bucket = [rows.alias("_n"), F.avg("_v").alias("_mean"), (F.var_pop("_v") * rows).alias("_squares")]
    of_bucket += [F.min("_v").alias("_min"), F.max("_v").alias("_max")]
    sketch = [] if exact else [F.kll_sketch_agg_double("_v", sketches.K).alias("_v")]
    buckets = stored(data.groupBy(*key, *(["_bucket"] if exact else [])).agg(*of_bucket, *sketch), "buckets")
    if exact:
        points = _points(data, buckets.select(*key, "_bucket", "_n"), key, percents, rows)
    else:
        points = sketches.points(buckets.withColumnRenamed("_n", "_v_rows"), "_v", percents, key)

    # squares around the mean of all, from those around the buckets' means
    of_column = W.partitionBy(*key)
    whole = F.sum(F.col("_mean") * F.col("_n")).over(of_column) / F.sum("_n").over(of_column)
    apart = F.col("_squares") + F.col("_n") * (F.col("_mean") - F.col("_whole")) * (F.col("_mean") - F.col("_whole"))
    n = F.sum("_n").cast("double")
    moments = {
        "count": n,
        "mean": F.sum(F.col("_mean") * F.col("_n")) / n,
        "std": F.when(n > 1, F.sqrt(F.sum("_apart") / (n - 1))),
        "min": F.min("_min"),
        "max": F.max("_max"),
    }
    sums = buckets.withColumn("_whole", whole).withColumn("_apart", apart).groupBy(*key).agg(*[e.alias(m) for m, e in moments.items()])
    entries = [F.struct(F.lit(m).alias("statistic"), F.col(m).alias("value")) for m in moments]
    found = sums.select(*key, F.inline(F.array(*entries)))
    found = found.unionByName(points.select(*key, F.format_string("p%02d", F.col("percentile").cast("int")).alias("statistic"), "value"))
    # a column without values has its moments and percentiles as nulls, and 0 rows
    names = spark.createDataFrame(
        [(c, s) for c in columns for s in [*moments, *[f"p{int(p):02d}" for p in percents]]], "column_name string, statistic string"
    )
    shown = names.join(F.broadcast(found), ["column_name", "statistic"], "left")
    value = F.when(F.col("statistic") == "count", F.coalesce("value", F.lit(0.0))).otherwise(F.col("value"))
    return shown.select("column_name", "statistic", value.alias("value"))
