"""Totals estimated from a sample, on request only.

A record belongs to the sample if a hash of its key columns falls below the share, so the sample is the same in every run
and in every engine that has md5, equal keys stay together, and a larger share contains the smaller one's sample. Sums
are scaled by the share; bounds follow from the spread of the sampled keys (each key is in or out on its own). Nothing
chooses a sample by the size of a table: totals are exact unless these functions are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The sampling key of a record, and how many standard errors the bounds are wide (99.9 % of a normal spread).
KEYS = ("year", "month_number", "commodity_code", "country_code", "ausport_code", "osport_code")
WIDTH = 3.29

_STEPS = 16**8


def in_sample(keys, share: float, seed: int = 0) -> Column:
    """Whether a record's keys fall into a sample of the given share; null keys count as absent texts."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    place = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return place < F.lit(int(share * _STEPS))


def sampled_totals(
    df: DataFrame, share: float, groups=(), measures=("valuecif",), keys=KEYS, seed: int = 0, width: float = WIDTH
) -> DataFrame:
    """Per group: sampled records and keys, and for the number of records and each measure an estimate with its bounds.

    ``<name>_estimate``, ``<name>_low``, ``<name>_high``. Groups none of whose keys are in the sample have no row; a share
    of 1 gives exact totals with bounds of no width.
    """
    if not 0 < share <= 1:
        raise ValueError("the share must be above 0 and at most 1")
    chosen = df.where(in_sample(keys, share, seed))
    names = {"records": F.count(F.lit(1)).cast("double"), **{m: F.coalesce(F.sum(m), F.lit(0)).cast("double") for m in measures}}
    each = chosen.groupBy(*groups, *[k for k in keys if k not in groups]).agg(*[c.alias(f"_{n}") for n, c in names.items()])
    spread = (1 - share) / share**2
    sums = each.groupBy(*groups).agg(
        F.coalesce(F.sum("_records"), F.lit(0)).cast("long").alias("sampled_records"),
        F.count(F.lit(1)).alias("sampled_keys"),
        *[F.coalesce(F.sum(f"_{n}"), F.lit(0.0)).alias(n) for n in names],
        *[F.sqrt(F.coalesce(F.sum(F.col(f"_{n}") * F.col(f"_{n}")), F.lit(0.0)) * spread).alias(f"_{n}_error") for n in names],
    )
    return sums.select(
        *groups,
        "sampled_records",
        "sampled_keys",
        *[
            expression.alias(f"{n}_{part}")
            for n in names
            for part, expression in (
                ("estimate", F.col(n) / share),
                ("low", F.col(n) / share - width * F.col(f"_{n}_error")),
                ("high", F.col(n) / share + width * F.col(f"_{n}_error")),
            )
        ],
    )
