"""Keyed upsert of new months into the partitioned store, in batch or as a stream."""

from __future__ import annotations

from contextlib import nullcontext
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.duplicates import split_repeated
from ..operators.ranking import top_in_group
from ..schema import GRAIN, PARTITION_COLUMNS
from ..storage import SMALL, files_under, many_in_folders, path_exists, remove_path, scratch_path, stored as written, unsorted_writes
from .journal import decide, finish, recover, stage, staging_of
from .rollups import FOLDERS, WIDE, cuboids, renewed, rollups_of


def append_tables(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def newest_by_key(df: DataFrame, keys=GRAIN, order: str = "batch_order", ties=()) -> DataFrame:
    """The newest row of each key; null keys equal each other.

    Rows of one key and one batch are told apart by ``ties`` (descending). The rank
    filter keeps one row per key and task before the shuffle.
    """
    keys = [k for k in keys if k in df.columns]
    sort = [F.desc_nulls_last(order), *[F.desc_nulls_last(t) for t in ties]]
    return top_in_group(df, keys, sort, 1, "_newest").drop("_newest", order)


def _both(stored: DataFrame | None, batch: DataFrame) -> DataFrame:
    new = batch.withColumn("batch_order", F.lit(1))
    return new if stored is None else append_tables(stored.withColumn("batch_order", F.lit(0)), new)


def merged(stored: DataFrame | None, batch: DataFrame, keys=GRAIN) -> DataFrame:
    """Stored rows and new rows with the newest of each key."""
    ties = [c for c in batch.columns if c not in keys]
    return newest_by_key(_both(stored, batch), keys, ties=ties)


def merged_stored(stored: DataFrame | None, batch: DataFrame, keys=GRAIN) -> DataFrame:
    """``merged`` for rows that lie in files: only rows whose key occurs again are shuffled and ranked."""
    both, ties = _both(stored, batch), [c for c in batch.columns if c not in keys]
    alone, others = split_repeated(both, [k for k in keys if k in both.columns])
    return alone.drop("batch_order").unionByName(newest_by_key(others, keys, ties=ties))


def touched_months(df: DataFrame) -> DataFrame:
    """The (year, month) folders that rows fall into."""
    return df.select(*PARTITION_COLUMNS).distinct()


def repeated_months(stored: DataFrame, keys=GRAIN) -> DataFrame:
    """The months that hold some key more than once (the month belongs to the key)."""
    own = list(dict.fromkeys([*PARTITION_COLUMNS, *[k for k in keys if k in stored.columns]]))
    counted = split_repeated(stored, own)[1].groupBy(*own).agg(F.count(F.lit(1)).alias("_n"))
    return touched_months(counted.where("_n > 1"))


def rows_of_months(stored: DataFrame, months: DataFrame) -> DataFrame:
    """Rows whose month is listed, null parts included.

    Months without nulls are joined by equality, by which Spark prunes the other folders while it runs; it does so only
    for months that a comparison picks, so one that is true for every year is there. The folders of null parts are few and known.
    """
    year, month = PARTITION_COLUMNS
    a, b = stored.alias("a"), months.where(F.col(year) >= F.lit(-(2**31))).alias("b")
    plain = a.join(b, (F.col(f"a.{year}") == F.col(f"b.{year}")) & (F.col(f"a.{month}") == F.col(f"b.{month}")), "left_semi")
    null_part = F.col(year).isNull() | F.col(month).isNull()
    same = F.col(f"a.{year}").eqNullSafe(F.col(f"b.{year}")) & F.col(f"a.{month}").eqNullSafe(F.col(f"b.{month}"))
    odd = stored.where(null_part).alias("a").join(months.where(null_part).alias("b"), same, "left_semi")
    return plain.unionByName(odd)


def upsert(spark: SparkSession, store: str, batch: DataFrame, keys=GRAIN, **options) -> None:
    """Merge a cleaned batch into the store: ``prepare``, then move in what it staged."""
    prepare(spark, store, batch, keys, **options)
    finish(spark, store)


def prepare(
    spark: SparkSession,
    store: str,
    batch: DataFrame,
    keys=GRAIN,
    whole: bool = False,
    rebuild: bool = False,
    rollups: bool = False,
    in_files: bool = False,
) -> None:
    """Stage the months that a cleaned batch touches, merged with the store, and decide that they replace the old ones.

    With ``whole`` the months that hold a key twice are rewritten too, so the whole store is unique by key afterwards;
    that reads the key columns of all months. ``rebuild`` replaces the store by the batch. ``rollups`` makes the stored
    aggregates of ``plans.rollups`` beside the store; once they are there, every upsert renews those of its months.

    A batch that lies ``in_files`` outside the store, cheap to read again, is not copied for the merge. If its tasks hold
    many rows of each month, no row is shuffled to its month: each task's share of a month is a file.

    The new months, and their aggregates, lie beside the store until ``journal.finish`` moves them in. A call first
    finishes what a died call had decided, so nothing but another call is needed after a crash.
    """
    recover(spark, store)
    held = spark.read.parquet(store) if files_under(spark, store) else None
    first = rebuild or held is None
    # the merge reads the batch three times; of a first load the copy lies among the scratch tables while months are staged
    path = scratch_path(spark, "batch") if first else f"{staging_of(store)}/batch"
    if not in_files:
        batch.write.mode("overwrite").options(**SMALL).parquet(path)
        batch = spark.read.schema(batch.schema).parquet(path)
    counted = written(batch.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("_n")), "batch-months")
    many = many_in_folders(counted, batch.rdd.getNumPartitions())
    if first:
        rows = merged_stored(None, batch, keys)
    else:
        months = touched_months(counted)
        if whole:
            months = months.union(repeated_months(held, keys)).distinct()
        rows = merged_stored(rows_of_months(held, written(months, "months")), batch, keys)
    with unsorted_writes(spark) if many else nullcontext():
        path_of_months = stage(rows, store, "months", rebalanced=not many)
    replaced = spark.read.schema(rows.schema).parquet(path_of_months)
    if first and not in_files:
        remove_path(spark, path)
    tables = {"months": ""}
    kept = path_exists(spark, rollups_of(store))
    if kept or rollups:
        months, add = touched_months(replaced), kept and not rebuild
        # aggregates that are not there yet need the months that stay as they are, too
        if held is not None and not (kept or rebuild):
            replaced = append_tables(rows_of_months(held, touched_months(held).exceptAll(months)), replaced)
        for name, rows in cuboids(replaced, f"{staging_of(store)}/cuboids"):
            rows = renewed(rows, spark, rollups_of(store), name, months) if add else rows
            stage(rows, store, f"rollups/{name}", FOLDERS, rebalanced=name not in WIDE)
            tables[f"rollups/{name}"] = f"{rollups_of('')}/{name}"
    decide(spark, store, tables, rebuild)


def upsert_stream(
    spark: SparkSession,
    incoming: str,
    schema,
    store: str,
    checkpoint: str,
    clean=None,
    keys=GRAIN,
    files_per_batch: int | None = None,
    file_format: str = "parquet",
    rollups: bool = False,
    after=None,
    **options,
):
    """Upsert every file not seen before and stop; the checkpoint records seen files.

    ``options`` belong to the file format. CSV arrivals are read by a header, which must name the columns of
    ``schema`` in their order; a file with another header fails instead of being read under wrong names.
    ``clean`` runs before the merge, so stored and new rows have the same columns. A
    batch that is repeated after a failure finds its decided months moved in, or its undecided ones dropped, and is
    merged again, which changes nothing. ``after`` is called with the session when a batch is in the store.
    """
    if file_format == "csv":
        options = {"header": True, "enforceSchema": False, **options}
    reader = spark.readStream.schema(schema).format(file_format).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = clean(batch) if clean else batch
        upsert(batch.sparkSession, store, rows, keys, rollups=rollups, in_files=clean is None and file_format == "parquet")
        if after:
            after(batch.sparkSession)

    return (
        reader.load(incoming)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", f"{checkpoint}/state")
        .trigger(availableNow=True)
        .start()
    )


def newest_month(df: DataFrame) -> Column:
    """Latest month held, as a scalar subquery."""
    return df.agg(F.max(F.make_date("year", "month_number", F.lit(1))).alias("d")).scalar()


def stored_months(spark: SparkSession, store: str) -> DataFrame:
    """The months a store holds, ``(year, month_number)``, from the names of its folders: no file is read."""
    found = set()
    for folder in {name.rpartition("/")[0] for name in files_under(spark, store)}:
        values = dict(part.split("=", 1) for part in folder.split("/"))
        found.add(tuple(None if values[c] == "__HIVE_DEFAULT_PARTITION__" else int(values[c]) for c in PARTITION_COLUMNS))
    return spark.createDataFrame(sorted(found, key=str), "year int, month_number int")


def store_freshness(spark: SparkSession, store: str, offered: str) -> DataFrame:
    """``freshness`` of one store against another, from their folders' names."""
    return freshness(stored_months(spark, store), stored_months(spark, offered))


def freshness(stored: DataFrame, offered: DataFrame) -> DataFrame:
    """One row: newest month held and offered, and whether there is anything newer."""
    latest = F.make_date("year", "month_number", F.lit(1))
    return (
        offered.agg(F.max(latest).alias("newest_offered"))
        .withColumn("newest_held", newest_month(stored))
        .withColumn(
            "has_new_data",
            F.coalesce(F.col("newest_offered") > F.col("newest_held"), F.col("newest_held").isNull()),
        )
    )


def completeness(df: DataFrame, floor: int = 3_000_000) -> DataFrame:
    """One row: rows held and whether they reach the expected floor. Of a Parquet store only the files' footers are read."""
    return df.agg(F.count(F.lit(1)).alias("total_rows")).withColumn(
        "is_complete", F.col("total_rows") >= floor
    )
