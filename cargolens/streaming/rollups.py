"""Stored aggregates beside a store, renewed with it, from which the reports are added up instead of from the records.

The aggregates form a lattice. The cuboids that no other holds (``LEAVES``) and the other wide one come from the records:
the ``WIDE`` ones, nearly as long as the records, both from one shuffle of their columns alone, the others as grouping
sets, which tasks add up before the shuffle. Each further cuboid (``DERIVED``) is added up from the smallest one that
holds its columns. All are kept by month, in a folder for each year. When months of the store are replaced, their rows
here are taken out and the new ones put in, in the same journal: a total is a sum over months, so a restated month takes
its old share back.

A row holds the number of its records, the sum of each measure and how many records set it. All of these add up, so any
coarser total, share or mean comes out as it would from the records; sums of doubles may differ in the last bits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import RECORDS, dimension_totals, records, set_count, values_set
from ..schema import AMOUNT_TYPE, AMOUNTS, MEASURES
from ..storage import SMALL, files_under, path_exists, remove_path

MONTH = ("year", "month_number", "month")

#: Aggregates are small: a year's months share a folder.
FOLDERS = ("year",)

#: Cuboids taken from the records: their columns beside the month's.
LEAVES = {
    "trade": ("commodity_code", "commodity_description", "country_description"),
    "ports": ("ausport_description", "country_description"),
    "origins": ("osport_description",),
    "states": ("state",),
    "modes": ("mode_description",),
}
#: Cuboids added up from the smallest of the others that holds their columns.
DERIVED = {
    "commodities": ("commodity_code", "commodity_description"),
    "countries": ("country_description",),
    "months": (),
}
#: Cuboids by commodity: kept together by their common columns, which the rows are shuffled by.
WIDE = ("trade", "commodities")


def rollups_of(store: str) -> str:
    """Where the aggregates of a store lie."""
    return f"{store.rstrip('/')}.rollups"


def _sums(df: DataFrame) -> list[Column]:
    """Records, sums and counts of set values; of records, or of the rows of a finer cuboid."""
    return [
        records(df).alias(RECORDS),
        *[F.sum(m).cast("decimal(38,2)" if m in AMOUNTS else "double").alias(m) for m in MEASURES],
        *[values_set(df, m).alias(set_count(m)) for m in MEASURES],
    ]


def _conformed(df: DataFrame) -> DataFrame:
    """Months, dimensions and measures of the stored table; absent ones are null."""
    kinds = {"year": "int", "month_number": "int", **{m: "double" for m in MEASURES}, **{m: AMOUNT_TYPE for m in AMOUNTS}}
    names = dict.fromkeys([*MONTH, *[d for dims in LEAVES.values() for d in dims], *MEASURES])
    return df.select(
        *[(F.col(n) if n in df.columns else F.lit(None)).cast(kinds.get(n, "string")).alias(n) for n in names]
    )


def cuboids(df: DataFrame, folder: str):
    """Yield ``(name, rows)`` of every cuboid of a stored cleaned table; those of records are written to ``folder`` first."""
    spark, rows = df.sparkSession, _conformed(df)
    dims_of = {**LEAVES, **DERIVED}
    _wide(rows).write.mode("overwrite").options(**SMALL).partitionBy("cuboid").parquet(f"{folder}/wide")
    _narrow(rows).write.mode("overwrite").partitionBy("cuboid").parquet(f"{folder}/narrow")
    made, sizes = {}, {}
    for name in dict.fromkeys([*LEAVES, *WIDE]):
        path = f"{folder}/{'wide' if name in WIDE else 'narrow'}"
        held = spark.read.schema(f"{_types([*MONTH, *dims_of[name], *_measures()])}, cuboid string").parquet(path)
        made[name] = held.where(F.col("cuboid") == name).drop("cuboid")
        sizes[name] = _bytes(spark, f"{path}/cuboid={name}")
    yield from made.items()
    for derived, dims in DERIVED.items():
        if derived not in made:
            parent = min((name for name in made if set(dims) <= set(dims_of[name])), key=sizes.get)
            yield derived, made[parent].groupBy(*MONTH, *dims).agg(*_sums(made[parent]))


def _wide(rows: DataFrame) -> DataFrame:
    """The cuboids by commodity, each in the tasks that hold all of a commodity's month."""
    common = [*MONTH, *[d for d in LEAVES["trade"] if all(d in {**LEAVES, **DERIVED}[name] for name in WIDE)]]
    dealt = rows.select(*MONTH, *LEAVES["trade"], *MEASURES).repartition(*common)
    # each row once for each cuboid, after the shuffle: the tasks have all rows of a group
    each = dealt.withColumn("cuboid", F.explode(F.array(*[F.lit(name) for name in WIDE])))
    own = {d: [name for name in WIDE if d in {**LEAVES, **DERIVED}[name]] for d in LEAVES["trade"] if d not in common}
    each = each.withColumns({d: F.when(F.col("cuboid").isin(*names), F.col(d)) for d, names in own.items()})
    return each.groupBy("cuboid", *MONTH, *LEAVES["trade"]).agg(*_sums(each))


def _narrow(rows: DataFrame) -> DataFrame:
    """The other leaves, as grouping sets."""
    leaves = {name: dims for name, dims in LEAVES.items() if name not in WIDE}
    keys = [*MONTH, *dict.fromkeys(d for dims in leaves.values() for d in dims)]
    sets = [[*MONTH, *dims] for dims in leaves.values()]
    grouped = rows.groupingSets(sets, *keys).agg(F.grouping_id().alias("_set"), *_sums(rows))
    every = 2 ** len(keys) - 1
    name = F.lit(None).cast("string")
    for leaf, own in zip(leaves, sets):
        # a set bit marks a column that is not grouped by; the first column is the highest bit
        bits = every - sum(2 ** (len(keys) - 1 - keys.index(k)) for k in own)
        name = F.when(F.col("_set") == bits, leaf).otherwise(name)
    return grouped.withColumn("cuboid", name).drop("_set")


def renewed(rows: DataFrame, spark: SparkSession, root: str, name: str, months: DataFrame) -> DataFrame:
    """New rows of ``months`` and the other months' stored rows of the years they lie in."""
    held = _stored(spark, root, name).alias("a")
    same_year = F.col("a.year").eqNullSafe(F.col("b.year"))
    same_month = same_year & F.col("a.month_number").eqNullSafe(F.col("b.month_number"))
    others = held.join(months.select("year").distinct().alias("b"), same_year, "left_semi")
    others = others.alias("a").join(months.alias("b"), same_month, "left_anti")
    return rows.unionByName(others)


def _measures() -> list[str]:
    return [RECORDS, *MEASURES, *[set_count(m) for m in MEASURES]]


def _bytes(spark: SparkSession, path: str) -> int:
    return sum(files_under(spark, path).values())


def build_rollups(df: DataFrame, root: str, scratch: str) -> None:
    """Write all cuboids of a whole table under ``root``; ``scratch`` is a folder for the leaves meanwhile.

    For a table that is not kept by ``upsert``, which renews the aggregates of its stores itself.
    """
    needed = _conformed(df)
    needed.write.mode("overwrite").options(**SMALL).parquet(f"{scratch}/records")
    needed = df.sparkSession.read.schema(needed.schema).parquet(f"{scratch}/records")
    for name, rows in cuboids(needed, scratch):
        rows.write.mode("overwrite").options(**SMALL).partitionBy(*FOLDERS).parquet(f"{root}/{name}")
    remove_path(df.sparkSession, scratch)


def covering(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    """The smallest stored cuboid that has the columns (measures aside), as a table to give to a report.

    Every report that groups, sums, counts or averages records takes it in place of the records. Raises ``ValueError``
    if no cuboid has the columns, so no report is answered from a coarser one.
    """
    wanted = set(columns) - set(MEASURES) - set(MONTH)
    able = [name for name, dims in {**LEAVES, **DERIVED}.items() if wanted <= set(dims)]
    sizes = {name: _bytes(spark, f"{root}/{name}") for name in able if path_exists(spark, f"{root}/{name}")}
    if not sizes:
        raise ValueError(f"no stored aggregate has {sorted(wanted)}")
    return _stored(spark, root, min(sizes, key=lambda n: (sizes[n], n)))


def dimension_members(spark: SparkSession, root: str, dimensions, measures=MEASURES) -> DataFrame:
    """``aggregates.dimension_totals`` of the store's records, each dimension from its smallest stored aggregate."""
    rows = [("total", dimension_totals(covering(spark, root), ["year"], measures))]
    rows += [(d, dimension_totals(covering(spark, root, d), [d], measures)) for d in dimensions]
    return reduce(DataFrame.unionByName, [part.where(F.col("dimension") == name) for name, part in rows])


def _stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(_types([*MONTH, *{**LEAVES, **DERIVED}[name], *_measures()])).parquet(f"{root}/{name}")


def _types(names: list[str]) -> str:
    kinds = {"year": "int", "month_number": "int", RECORDS: "bigint"}
    kinds |= {m: "decimal(38,2)" if m in AMOUNTS else "double" for m in MEASURES} | {set_count(m): "bigint" for m in MEASURES}
    return ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names)
