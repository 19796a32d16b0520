"""The reports: each takes a cleaned import table and returns lazy frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import amount_per_tonne, growth_pct, percent, shorten
from ..operators.aggregates import (
    column_totals,
    dimension_totals,
    doubles,
    group_profile,
    group_totals,
    records,
    total,
    with_shares,
)
from ..operators.classify import add_industry
from ..operators.percentiles import QUARTILES, describe
from ..operators.ranking import argmax_order, ranked_top_k, top_in_group
from ..operators.running import with_running_share
from ..schema import MEASURES, present
from ..storage import materialize

PERCENTS = (10, 25, 50, 75, 90, 95, 99)
# Names of the market classes.
LEADER, PREMIUM, STANDARD = "Market Leader", "Premium Product", "Standard"


def overview(df: DataFrame) -> DataFrame:
    """One row: record count, totals in display units and the year range."""
    return df.agg(
        records(df).alias("total_records"),
        (total("valuefob").cast("double") / 1e9).alias("fob_billions"),
        (total("valuecif").cast("double") / 1e9).alias("cif_billions"),
        (total("weight").cast("double") / 1e6).alias("weight_millions"),
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
    )


def overview_leaders(df: DataFrame, k: int = 5, cut: int = 75) -> DataFrame:
    """Top countries and commodities with labels and billions, from one scan."""
    names = ("country_description", "commodity_description")
    members = dimension_totals(df, names).where(F.col("dimension") != "total")
    order = [F.desc("valuecif"), F.asc("member")]
    return doubles(top_in_group(members, "dimension", order, k)).select(
        "dimension",
        "rank",
        "member",
        shorten("member", cut).alias("label"),
        (F.col("valuecif") / 1e9).alias("value_billions"),
    )


def country_profile(df: DataFrame, cumulative: bool = True) -> DataFrame:
    return _ranked_profile(df, "country_description", cumulative)


def commodity_profile(df: DataFrame, cumulative: bool = True) -> DataFrame:
    return _ranked_profile(df, "commodity_description", cumulative)


def _ranked_profile(df: DataFrame, key: str, cumulative: bool) -> DataFrame:
    grouped = group_totals(df, key)
    measures = [c for c in grouped.columns if c != key]
    result = with_shares(grouped, ["valuecif"], measures)
    if cumulative:
        whole = column_totals(grouped, measures)["valuecif"]
        result = with_running_share(result, "valuecif", [F.desc("valuecif"), F.asc(key)], whole)
    return doubles(result)


def arrival_ports(df: DataFrame) -> DataFrame:
    return group_profile(df, "ausport_description", ("valuefob", "valuecif", "weight"), share_of=())


def origin_ports(df: DataFrame) -> DataFrame:
    return group_profile(df, "osport_description", ("valuefob", "valuecif", "weight"), share_of=())


def states(df: DataFrame) -> DataFrame:
    return group_profile(df, "state", ("valuefob", "valuecif", "weight"))


def transport_modes(df: DataFrame) -> DataFrame:
    """Totals, FOB and weight percentages and average value per tonne per mode."""
    profile = group_profile(df, "mode_description", share_of=("valuefob", "weight"))
    return profile.withColumn("avg_value_per_tonne", amount_per_tonne("valuefob", "weight"))


def cif_fob_comparison(df: DataFrame, k: int = 10, cut: int = 75) -> DataFrame:
    """CIF and FOB billions of the k largest commodities, with labels."""
    grouped = group_totals(df, "commodity_description", ("valuecif", "valuefob"), None)
    return doubles(ranked_top_k(grouped, "valuecif", "commodity_description", k)).select(
        "rank",
        "commodity_description",
        shorten("commodity_description", cut).alias("commodity_label"),
        (F.col("valuecif") / 1e9).alias("cif_billions"),
        (F.col("valuefob") / 1e9).alias("fob_billions"),
    )


def industry_sectors(df: DataFrame) -> DataFrame:
    """Totals, share of all imports and largest commodity of each industry.

    Records are added up by code and commodity first, so only those few rows are classified. One aggregate by industry
    and commodity feeds the totals and the winners.
    """
    measures = ("valuefob", "valuecif", "weight")
    by_code = df.groupBy("commodity_code", "commodity_description").agg(
        *[total(m).alias(m) for m in measures], records(df, "commodity_description").alias("record_count")
    )
    pairs = (
        add_industry(by_code)
        .groupBy("industry_sector", "commodity_description")
        .agg(*[total(m).alias(m) for m in (*measures, "record_count")])
    )
    order = argmax_order("valuecif", "commodity_description")
    sectors = pairs.groupBy("industry_sector").agg(
        total("valuefob").alias("valuefob"),
        total("valuecif").alias("valuecif"),
        total("weight").alias("weight"),
        total("record_count").alias("record_count"),
        F.min_by("commodity_description", order).alias("top_commodity"),
    )
    whole = column_totals(pairs, ["valuefob", "valuecif", "weight", "record_count"])["valuecif"]
    share = percent(F.col("valuecif"), whole)
    return doubles(sectors.withColumn("valuecif_pct", share)).withColumn(
        "valuecif_billions", F.col("valuecif") / 1e9
    )


def industry_values(df: DataFrame) -> DataFrame:
    """Totals and value per tonne of each industry with a weight; codes are classified after they are added up."""
    measures = present(df, MEASURES)
    by_code = df.groupBy("commodity_code").agg(*[total(m).alias(m) for m in measures])
    grouped = doubles(group_totals(add_industry(by_code), "industry_sector", measures, None))
    return grouped.where(F.col("weight") > 0).withColumns(
        {
            "value_per_tonne": amount_per_tonne("valuecif", "weight"),
            "total_value_billions": F.col("valuecif") / 1e9,
            "total_weight_millions": F.col("weight") / 1e6,
        }
    )


def market_quadrants(df: DataFrame) -> DataFrame:
    """Industries against the medians of total value and value per tonne."""
    # One row per industry of the fixed list, so a plain window over all of them is safe.
    every = W.partitionBy()
    volume = F.median("total_value_billions").over(every)
    price = F.median("value_per_tonne").over(every)
    return industry_values(df).withColumn(
        "category",
        F.when(F.col("total_value_billions") >= volume, LEADER)
        .when(F.col("value_per_tonne") >= price, PREMIUM)
        .otherwise(STANDARD),
    )


def quadrant_ranks(quadrants: DataFrame) -> DataFrame:
    """Rank inside the class: leaders by value, premium products by value per tonne."""
    measure = F.when(F.col("category") == PREMIUM, F.col("value_per_tonne")).otherwise(
        F.col("total_value_billions")
    )
    order = W.partitionBy("category").orderBy(measure.desc(), F.asc("industry_sector"))
    return quadrants.withColumn("rank", F.row_number().over(order))


def quadrant_summary(quadrants: DataFrame) -> DataFrame:
    """Per class: industries, value, weight, value per tonne and mean value."""
    return (
        quadrants.groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("industries"),
            F.sum("total_value_billions").alias("value_billions"),
            F.sum("total_weight_millions").alias("weight_millions"),
            F.avg("total_value_billions").alias("mean_value_billions"),
        )
        .withColumn(
            "value_per_tonne",
            F.try_divide(F.col("value_billions") * 1e9, F.col("weight_millions") * 1e6),
        )
    )


def fob_cif_gap(df: DataFrame) -> DataFrame:
    """Totals, their gap, the gap in percent of FOB, and values per tonne (0 without weight)."""
    sums = df.agg(
        total("valuefob").alias("fob"), total("valuecif").alias("cif"), total("weight").alias("tonnes")
    )
    zero = F.lit(0.0)
    return sums.select(
        F.col("fob").cast("double").alias("total_fob"),
        F.col("cif").cast("double").alias("total_cif"),
        (F.col("cif") - F.col("fob")).cast("double").alias("insurance_freight"),
        percent(F.col("cif") - F.col("fob"), F.col("fob")).alias("insurance_freight_pct"),
        F.coalesce(amount_per_tonne("fob", "tonnes"), zero).alias("fob_per_tonne"),
        F.coalesce(amount_per_tonne("cif", "tonnes"), zero).alias("cif_per_tonne"),
    )


def distribution(df: DataFrame, column: str, percents=PERCENTS, exact: bool = True) -> DataFrame:
    """Describe table and percentiles of the positive values of a column; ``exact=False`` takes these from sketches."""
    wanted = sorted(set(percents) | set(QUARTILES))
    return describe(df.where(F.col(column) > 0), column, wanted, exact)


def share_of_top(df: DataFrame, key: str, sizes=(5, 10, 20)) -> DataFrame:
    """Percentage of all CIF value held by the k largest members, for each k."""
    grouped = group_totals(df, key, ["valuecif"], None)
    whole = column_totals(grouped, ["valuecif"])["valuecif"]
    head = ranked_top_k(grouped, "valuecif", key, max(sizes))
    sums = head.agg(
        *[F.sum(F.when(F.col("rank") <= k, F.col("valuecif"))).alias(f"s{k}") for k in sizes]
    )
    return sums.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(k).alias("top_k"), percent(F.col(f"s{k}"), whole).alias("share_pct")
                    )
                    for k in sizes
                ]
            )
        )
    )


INSIGHTS = {
    "country_description": "valuecif",
    "commodity_description": "valuecif",
    "mode_description": "valuefob",
    "state": "valuecif",
}


def key_insights(
    df: DataFrame | None, years: tuple[int, int] | None = None, members: DataFrame | None = None
) -> DataFrame:
    """Rows ``(insight, label, value, pct)`` from one scan of the table, or from given ``members``.

    ``members`` are totals of the dimensions of ``INSIGHTS`` and the years, as ``rollups.dimension_members`` gives them.

    The largest country, commodity, mode and state with their shares, FOB growth from
    the first to the second year (``years``, else the first two held), and the shares of the top 5 countries and top 10
    commodities. Shares refer to the members of a dimension.
    """
    if members is None:
        members = dimension_totals(df, [*INSIGHTS, "year"], ("valuecif", "valuefob"))
    members = materialize(members.where(F.col("dimension") != "total"))
    measure = F.when(
        F.col("dimension").isin("mode_description", "year"), F.col("valuefob")
    ).otherwise(F.col("valuecif"))
    sized = members.select("dimension", "member", measure.alias("value"))
    # Top rows and totals per dimension come from separate aggregates: a window over a
    # dimension would gather all its members in one task.
    order = [
        F.when(F.col("dimension") == "year", F.col("member")).asc_nulls_first(),
        F.desc("value"),
        F.asc("member"),
    ]
    head = top_in_group(sized, "dimension", order, 10)
    wholes = sized.groupBy("dimension").agg(F.sum("value").alias("whole"))
    joined = head.join(F.broadcast(wholes), "dimension").withColumn(
        "pct", percent(F.col("value"), F.col("whole"))
    )
    tops = joined.where((F.col("rank") == 1) & (F.col("dimension") != "year")).select(
        F.concat(F.lit("top "), "dimension").alias("insight"),
        F.col("member").alias("label"),
        F.col("value").cast("double").alias("value"),
        "pct",
    )
    held = (
        joined.where(
            (F.col("dimension").isin("commodity_description"))
            | ((F.col("dimension") == "country_description") & (F.col("rank") <= 5))
        )
        .groupBy("dimension")
        .agg(F.sum("value").alias("value"), F.max("whole").alias("whole"))
        .select(
            F.when(F.col("dimension") == "country_description", "top 5 countries")
            .otherwise("top 10 commodities")
            .alias("insight"),
            F.lit(None).cast("string").alias("label"),
            F.col("value").cast("double").alias("value"),
            percent(F.col("value"), F.col("whole")).alias("pct"),
        )
    )
    spots = [F.col("member") == str(y) for y in years] if years else [F.col("rank") == r for r in (1, 2)]
    first, second = (F.max(F.when(spot, F.col("value"))) for spot in spots)
    growth = (
        (sized if years else head).where(F.col("dimension") == "year")
        .agg(first.alias("first"), second.alias("second"))
        .where(F.col("second").isNotNull())
        .select(
            F.lit("yearly growth").alias("insight"),
            F.lit(None).cast("string").alias("label"),
            (F.col("second") - F.col("first")).cast("double").alias("value"),
            growth_pct(F.col("first"), F.col("second")).alias("pct"),
        )
    )
    return tops.unionByName(held).unionByName(growth)


SUMMARY_TOPS = {
    "country_description": 15,
    "commodity_description": 15,
    "ausport_description": 10,
}
SUMMARY_MAPS = ("mode_description", "state")


def summary_members(
    df: DataFrame | None, tops: dict[str, int] | None = None, members: DataFrame | None = None
) -> DataFrame:
    """Top lists, mode and state values and years as ``(section, rank, member, valuecif)``; ``members`` as below."""
    tops = tops or SUMMARY_TOPS
    return _ranked_members(_summary_totals(df, tops, ["valuecif"], members), tops)


def summary_dimensions(tops: dict[str, int] | None = None) -> list[str]:
    """The dimensions that a summary adds up."""
    return [*(tops or SUMMARY_TOPS), *SUMMARY_MAPS, "year"]


def _summary_totals(df: DataFrame | None, tops: dict[str, int], measures, members: DataFrame | None) -> DataFrame:
    return materialize(dimension_totals(df, summary_dimensions(tops), measures) if members is None else members)


def _ranked_members(members: DataFrame, tops: dict[str, int]) -> DataFrame:
    order = [F.desc("valuecif"), F.asc("member")]
    place = F.row_number().over(W.partitionBy("dimension").orderBy(*order))
    ranked = None
    for dimension in [*tops, *SUMMARY_MAPS, "year"]:
        part = members.where(F.col("dimension") == dimension)
        if dimension in tops:
            part = ranked_top_k(part, "valuecif", "member", tops[dimension])
        else:
            part = part.withColumn("rank", place)
        ranked = part if ranked is None else ranked.unionByName(part)
    return doubles(ranked).select(
        F.col("dimension").alias("section"), "rank", "member", "valuecif"
    )


def summary_statistics(
    df: DataFrame | None, tops: dict[str, int] | None = None, members: DataFrame | None = None
) -> DataFrame:
    """One nested row: totals, year range, top lists, and mode and state maps.

    From one scan of the table, or from given ``members``: totals of ``summary_dimensions`` and of everything, as
    ``rollups.dimension_members`` gives them.
    """
    tops = tops or SUMMARY_TOPS
    labels = {
        "country_description": ("top_countries", "country"),
        "commodity_description": ("top_commodities", "commodity"),
        "ausport_description": ("top_ports", "port"),
    }
    stored = _summary_totals(df, tops, MEASURES, members)
    members = _ranked_members(stored, tops)

    def listed(section: str, label: str):
        row = F.struct(
            F.col("rank"), F.col("member").alias(label), F.col("valuecif").alias("value_cif")
        )
        items = F.array_sort(F.collect_list(F.when(F.col("section") == section, row)))
        return F.transform(
            items,
            lambda item: F.struct(item[label].alias(label), item["value_cif"].alias("value_cif")),
        )

    def mapped(section: str):
        row = F.struct(F.col("rank"), F.struct("member", "valuecif").alias("entry"))
        items = F.array_sort(F.collect_list(F.when(F.col("section") == section, row)))
        return F.map_from_entries(F.transform(items, lambda item: item["entry"]))

    year = F.when(F.col("section") == "year", F.col("member").cast("int"))
    lists = members.agg(
        F.struct(
            F.min(year).alias("min_year"),
            F.max(year).alias("max_year"),
            F.array_sort(F.collect_list(year)).alias("years"),
        ).alias("date_range"),
        *[listed(d, labels[d][1]).alias(labels[d][0]) for d in tops],
        mapped("mode_description").alias("transport_modes"),
        mapped("state").alias("states"),
    )
    packed = lists.select(F.struct(*lists.columns).alias("s")).scalar()
    names = {
        "valuefob": "total_value_fob",
        "valuecif": "total_value_cif",
        "weight": "total_weight",
        "quantity": "total_quantity",
    }
    return (
        stored.where(F.col("dimension") == "total")
        .select(
            F.col("record_count").alias("total_records"),
            *[F.col(c).cast("double").alias(n) for c, n in names.items()],
            packed.alias("s"),
        )
        .select("total_records", *names.values(), "s.*")
    )


# The texts of the report below.
def report_lines(summary: DataFrame, top_countries: int = 15, rule: int = 60) -> DataFrame:
    """The text report of a summary row: ``(line_number, line)``."""
    bar = F.lit("=" * rule)
    billions = "  %s Value: $%.2f Billion AUD"
    countries = F.transform(
        F.slice("top_countries", 1, top_countries),
        lambda c, i: F.format_string("  %d. %s: $%.2fB", i + 1, c["country"], c["value_cif"] / 1e9),
    )
    lines = F.concat(
        F.array(
            bar,
            F.lit("DATA ANALYSIS SUMMARY REPORT"),
            bar,
            F.lit(""),
            F.format_string("Total Records: %,d", F.col("total_records")),
            F.lit(""),
            F.lit("Date Range:"),
            F.format_string(
                "  Years: %d - %d", F.col("date_range.min_year"), F.col("date_range.max_year")
            ),
            F.lit(""),
            F.lit("Total Values:"),
            F.format_string(billions, F.lit("FOB"), F.col("total_value_fob") / 1e9),
            F.format_string(billions, F.lit("CIF"), F.col("total_value_cif") / 1e9),
            F.format_string("  Total Weight: %.2f Million Tonnes", F.col("total_weight") / 1e6),
            F.lit(""),
            F.lit(f"Top {top_countries} Countries by CIF Value:"),
        ),
        countries,
    )
    return summary.select(F.posexplode(lines).alias("line_number", "line"))
