"""Port by country tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import half_even, percent
from .aggregates import doubles, group_totals
from .ranking import top_k

PORT, COUNTRY = "ausport_description", "country_description"


def port_country_totals(df: DataFrame, port: str = PORT, country: str = COUNTRY) -> DataFrame:
    """CIF value per port and country: the small table all matrices derive from."""
    return group_totals(df, [port, country], ["valuecif"], None)


def top_block(
    pairs: DataFrame, ports: int = 10, countries: int = 15, port: str = PORT, country: str = COUNTRY
) -> DataFrame:
    """Pairs of the largest ports and largest countries; both lists have k rows at most.

    Both are taken over all pairs: the largest countries need not be those of the largest ports. The lists hold each name once, so a plain join keeps the pairs as they are. A semi
    join would be moved below the aggregate, which would then be computed a second time.
    """
    block = pairs
    for key, k in ((port, ports), (country, countries)):
        sums = pairs.groupBy(key).agg(F.sum("valuecif").alias("valuecif"))
        chosen = top_k(sums, "valuecif", key, k).select(key)
        block = block.join(F.broadcast(chosen), key)
    return block


def port_shares(pairs: DataFrame, port: str = PORT) -> DataFrame:
    """Each pair's percentage of its port, two digits, half to even."""
    whole = F.sum("valuecif").over(W.partitionBy(port))
    share = half_even(percent(F.col("valuecif"), whole), 2)
    return doubles(pairs.withColumn("pct_of_port", share))


def port_country_shares(df: DataFrame, base: str = "all", ports: int = 10, countries: int = 15):
    """Shares of a port over all countries, or over the top block only."""
    pairs = port_country_totals(df)
    if base == "top":
        pairs = top_block(pairs, ports, countries)
    elif base != "all":
        raise ValueError("base must be 'all' or 'top'")
    return port_shares(pairs)


def port_concentration(df: DataFrame, port: str = PORT, country: str = COUNTRY) -> DataFrame:
    """Value, number of countries and largest country share of each port."""
    shares = port_shares(port_country_totals(df, port, country), port)
    return shares.groupBy(F.col(port).alias("port")).agg(
        F.sum("valuecif").alias("total_value"),
        F.count(country).alias("num_countries"),
        F.max("pct_of_port").alias("top_country_pct"),
    )


def wide_matrix(
    block: DataFrame, countries, port: str = PORT, country: str = COUNTRY, scale: float = 1e9
) -> DataFrame:
    """One row per port and one column per given country, 0 where there is no trade.

    The job fails on a country that is not among the given ones, as its value would be left out.
    """
    unknown = F.raise_error(F.concat(F.lit("no column for "), F.coalesce(country, F.lit("null"))))
    listed = F.col(country).isin(*countries)
    block = block.withColumn(country, F.when(listed, F.col(country)).otherwise(unknown.cast("string")))
    wide = block.groupBy(port).pivot(country, list(countries)).agg(F.sum("valuecif"))
    return wide.select(
        port,
        *[
            (F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) / scale).alias(c)
            for c in countries
        ],
    )
