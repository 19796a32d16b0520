from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cargolens import schema
from cargolens.operators import aggregates
from cargolens.plans.refresh import clean_by_month, clean_for_store, refresh
from cargolens import storage
from cargolens.sources import sinks
from cargolens.sources.sinks import write_cleaned
from cargolens.storage import files_under, scratch_path
from cargolens.streaming import totals, upsert
from verification import catalog_tables
from verification.imports_view import imports_fact

SF = "/root/testdata/sf0.001"
KEYS = ("year", "month_number", "country_code")
TYPES = "year int, month_number int, country_code string, valuecif double"


def rows_of(spark, store):
    return sorted(
        (tuple(r) for r in spark.read.parquet(store).select(*KEYS, "valuecif").collect()),
        key=str,
    )


def test_upsert_newest_wins_and_is_idempotent(spark):
    store = scratch_path(spark, "store")
    base = spark.createDataFrame(
        [(2024, 1, "a", 1.0), (2024, 1, "b", 2.0), (2024, 2, "a", 3.0), (2024, None, "a", 9.0)], TYPES
    )
    batch = spark.createDataFrame(
        [(2024, 2, "a", 30.0), (2024, 3, "a", 4.0), (2023, 12, "c", 5.0), (2024, None, "a", 90.0)], TYPES
    )
    upsert.upsert(spark, store, base, KEYS)
    upsert.upsert(spark, store, batch, KEYS)
    want = sorted(
        [
            (2023, 12, "c", 5.0), (2024, 1, "a", 1.0), (2024, 1, "b", 2.0), (2024, 2, "a", 30.0),
            (2024, 3, "a", 4.0), (2024, None, "a", 90.0),
        ],
        key=str,
    )
    assert rows_of(spark, store) == want
    upsert.upsert(spark, store, batch, KEYS)
    assert rows_of(spark, store) == want


def test_upsert_leaves_other_months_untouched(spark, tmp_path):
    store = str(tmp_path / "store")
    base = spark.createDataFrame([(2024, 1, "a", 1.0), (2024, 2, "a", 2.0)], TYPES)
    upsert.upsert(spark, store, base, KEYS)
    before = sorted(p.name for p in (tmp_path / "store/year=2024/month_number=1").iterdir())
    upsert.upsert(spark, store, base.where("month_number = 2"), KEYS)
    after = sorted(p.name for p in (tmp_path / "store/year=2024/month_number=1").iterdir())
    assert before == after


def test_whole_store_becomes_unique(spark, tmp_path):
    store = str(tmp_path / "store")
    twice = spark.createDataFrame(
        [(2024, 5, "a", 1.0), (2024, 5, "a", 2.0), (2024, 6, "a", 1.0), (2024, 6, "a", 2.0), (2024, 7, "a", 3.0), (None, None, "a", 3.0), (None, None, "a", 4.0)], TYPES
    )
    twice.write.partitionBy("year", "month_number").parquet(store)
    before = sorted(p.name for p in (tmp_path / "store/year=2024/month_number=7").iterdir())
    upsert.upsert(spark, store, spark.createDataFrame([(2024, 6, "a", 9.0)], TYPES), KEYS, whole=True)
    assert rows_of(spark, store) == sorted([(2024, 5, "a", 2.0), (2024, 6, "a", 9.0), (2024, 7, "a", 3.0), (None, None, "a", 4.0)], key=str)
    assert before == sorted(p.name for p in (tmp_path / "store/year=2024/month_number=7").iterdir())


def test_many_months_need_no_list(spark):
    store = scratch_path(spark, "store")
    base = spark.range(300).selectExpr("int(1000 + id) AS year", "1 AS month_number", "'a' AS country_code", "double(id) AS valuecif")
    upsert.upsert(spark, store, base, KEYS)
    upsert.upsert(spark, store, base.where("year % 2 = 0").withColumn("valuecif", F.lit(-1.0)), KEYS)
    found = spark.read.parquet(store)
    assert (found.count(), found.where("valuecif = -1").count()) == (300, 150)


def test_newest_row_of_a_hot_key(spark):
    df = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("batch_order"),
        F.col("id").alias("v"),
    )
    found = upsert.newest_by_key(df, ["k"])
    assert found.where("k = 'hot'").first()["v"] == 8997
    assert found.count() == 6001
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2, "every task must cut a key before the shuffle"


def test_append_fills_missing_columns(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "y")], "x int, y string")
    assert [tuple(r) for r in upsert.append_tables(a, b).orderBy("x").collect()] == [(1, None), (2, "y")]


def test_stream_equals_batch(spark):
    df, root = imports_fact(spark, SF), scratch_path(spark, "stream")
    batch = df.where("year = 2025").withColumn("valuecif", (F.col("valuecif") * 3).cast("decimal(20,2)"))
    upsert.upsert(spark, f"{root}/batch", df)
    upsert.upsert(spark, f"{root}/batch", batch)
    for drop in (df, batch):
        drop.write.mode("append").parquet(f"{root}/incoming")
        for _ in range(2):  # the second run finds nothing new
            upsert.upsert_stream(
                spark, f"{root}/incoming", df.schema, f"{root}/store", f"{root}/checkpoint"
            ).awaitTermination()
    streamed, merged = (spark.read.parquet(f"{root}/{n}") for n in ("store", "batch"))
    assert streamed.count() == merged.count()
    assert streamed.exceptAll(merged.select(*streamed.columns)).isEmpty()


def test_stream_cleans_before_the_merge(spark):
    root = scratch_path(spark, "clean")
    raw = spark.createDataFrame([("May 2024", "a", "-1"), ("May 2024", "b", "7")], "month string, country_code string, valuecif string")
    raw.write.parquet(f"{root}/incoming")
    from cargolens.operators.clean import clean_imports

    upsert.upsert_stream(
        spark, f"{root}/incoming", raw.schema, f"{root}/store", f"{root}/checkpoint", clean_imports, KEYS
    ).awaitTermination()
    assert rows_of(spark, f"{root}/store") == [(2024, 5, "a", 0.0), (2024, 5, "b", 7.0)]


def test_stream_of_raw_csv(spark, tmp_path):
    (tmp_path / "incoming").mkdir()
    (tmp_path / "incoming/a.csv").write_text(
        "Month,Country Code,Valuecif\nMay 2024,a,-1\nMay 2024,b,7\nMay 2024,b,7\n"
    )
    store = str(tmp_path / "store")
    upsert.upsert_stream(
        spark, str(tmp_path / "incoming"), "`Month` string, `Country Code` string, `Valuecif` string",
        store, str(tmp_path / "checkpoint"), clean_for_store, KEYS, file_format="csv", header=True,
    ).awaitTermination()
    values = {(r["country_code"], float(r["valuecif"])) for r in spark.read.parquet(store).collect()}
    assert values == {("a", 0.0), ("b", 7.0)}


def test_running_totals_stream_equals_batch(spark):
    df = imports_fact(spark, SF, *schema.MEASURES, "year")
    root = scratch_path(spark, "totals")
    for part in ("year < 2022", "year >= 2022"):
        df.where(part).write.mode("append").parquet(f"{root}/incoming")
        totals.totals_stream(
            spark, f"{root}/incoming", df.schema, f"{root}/out", f"{root}/checkpoint", files_per_batch=2
        ).awaitTermination()
    ours = spark.read.parquet(f"{root}/out").first().asDict()
    theirs = aggregates.grand_totals(df, means=()).first().asDict()
    assert ours == pytest.approx(theirs)


def test_freshness_and_completeness(spark):
    held = spark.createDataFrame([(2024, 5)], "year int, month_number int")
    offered = spark.createDataFrame([(2024, 5), (2024, 6)], "year int, month_number int")
    assert upsert.freshness(held, offered).first()["has_new_data"] is True
    assert upsert.freshness(offered, held).first()["has_new_data"] is False
    assert upsert.freshness(held.limit(0), offered).first()["has_new_data"] is True
    assert upsert.completeness(offered, 2).first()["is_complete"] is True
    assert upsert.completeness(offered, 3).first()["is_complete"] is False


def raw_rows(spark, *rows):
    return spark.createDataFrame(rows, "month string, country_code string, valuecif string, weight string")


def store_values(spark, store):
    return {(r["month_number"], float(r["valuecif"])) for r in spark.read.parquet(store).collect()}


def test_refresh_loses_nothing(spark, tmp_path):
    store, summary = str(tmp_path / "store"), str(tmp_path / "summary")
    first = raw_rows(spark, ("May 2024", "a", "1", "2"), ("June 2024", "a", "2", "2"), ("May 2020", "a", "5", "2"))
    assert refresh(spark, first, store, years=[2024]) == "created"
    assert store_values(spark, store) == {(5, 1.0), (6, 2.0)}
    # a short extract without anything older keeps all history
    july = raw_rows(spark, ("July 2024", "a", "3", "2"))
    assert refresh(spark, july, store, summary) == "merged"
    assert store_values(spark, store) == {(5, 1.0), (6, 2.0), (7, 3.0)}
    # a restated month and a late one, older than the newest held
    late = raw_rows(spark, ("June 2024", "a", "9", "2"), ("April 2024", "a", "4", "2"))
    assert refresh(spark, late, store) == "merged"
    assert refresh(spark, late, store) == "merged"
    assert store_values(spark, store) == {(4, 4.0), (5, 1.0), (6, 9.0), (7, 3.0)}
    assert (tmp_path / "summary/summary_statistics/_SUCCESS").exists()
    row = spark.read.parquet(store).where("month_number = 6").first()
    assert row["value_per_tonne_cif"] == 4.5 and row["insurance_freight_cost"] is None


def test_rebuild_only_on_request(spark, tmp_path):
    store = str(tmp_path / "store")
    refresh(spark, raw_rows(spark, ("May 2024", "a", "1", "2"), ("May 2024", "a", "2", "2")), store)
    assert store_values(spark, store) == {(5, 2.0)}
    assert refresh(spark, raw_rows(spark, ("June 2024", "a", "2", "2"), ("June 2024", "a", "3", "2")), store, rebuild=True) == "rebuilt"
    assert store_values(spark, store) == {(6, 3.0)}


def test_csv_stream_of_another_layout_fails(spark, tmp_path):
    (tmp_path / "incoming").mkdir()
    (tmp_path / "incoming/a.csv").write_text("Valuecif,Month,Country Code\n7,May 2024,a\n")
    stream = upsert.upsert_stream(
        spark, str(tmp_path / "incoming"), "`Month` string, `Country Code` string, `Valuecif` string",
        str(tmp_path / "store"), str(tmp_path / "checkpoint"), clean_for_store, KEYS, file_format="csv",
    )
    with pytest.raises(Exception):
        stream.awaitTermination()


def test_conform_casts_money_and_fills_columns(spark):
    df = spark.createDataFrame([(2024, 12.345)], "year int, valuefob double")
    row = schema.conform(df).first()
    assert row["valuefob"] == Decimal("12.35") and row["state"] is None
    assert [f.name for f in schema.IMPORTS_SCHEMA.fields] == schema.conform(df).columns


def test_only_rows_whose_key_occurs_again_are_ranked(spark, tmp_path):
    """A row that shares its key with no other is neither shuffled nor ranked; copies, ties and null keys are."""
    held = spark.createDataFrame([(2024, 1, "a", 1.0), (2024, 1, "a", 2.0), (2024, 1, None, 5.0), (2024, 2, "b", 3.0)], TYPES)
    batch = spark.createDataFrame([(2024, 1, None, 6.0), (2024, 2, "c", 7.0), (2024, 2, "c", 8.0), (2024, 3, "d", 9.0)], TYPES)
    plain, found = upsert.merged(held, batch, KEYS), upsert.merged_stored(held, batch, KEYS)
    assert found.columns == plain.columns and found.count() == 5
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()


def test_many_rows_of_a_month_stay_in_their_tasks(spark, tmp_path, monkeypatch):
    """Each task's share of a month is a file of its own, null parts and repeated keys included; few rows are gathered."""
    monkeypatch.setattr(storage, "MANY_ROWS", 40)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    month = F.when(F.col("id") % 4 == 0, None).otherwise(F.col("id") % 3 + 1).cast("int").alias("month_number")
    year = (F.col("id") % 2 + 2023).cast("int").alias("year")
    rows = spark.range(0, 900, 1, 2).select(year, month, (F.col("id") % 600).cast("string").alias("country_code"), F.col("id").cast("double").alias("valuecif"))
    rows.write.parquet(str(tmp_path / "batch"))
    batch, store = spark.read.parquet(str(tmp_path / "batch")), str(tmp_path / "store")
    tasks = batch.rdd.getNumPartitions()
    assert tasks > 1
    upsert.upsert(spark, store, batch, KEYS, in_files=True)
    found, plain = spark.read.parquet(store).select(*KEYS, "valuecif"), upsert.merged(None, batch, KEYS).select(*KEYS, "valuecif")
    assert found.count() == 600 and found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
    files = files_under(spark, store)
    assert len(files) > len({f.rpartition("/")[0] for f in files})
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    few = str(tmp_path / "few")
    monkeypatch.setattr(storage, "MANY_ROWS", 10_000)
    upsert.upsert(spark, few, batch, KEYS, in_files=True)
    assert len(files_under(spark, few)) == len({f.rpartition("/")[0] for f in files_under(spark, few)})
    gathered = spark.read.parquet(few).select(*KEYS, "valuecif")
    assert gathered.exceptAll(found).isEmpty() and found.exceptAll(gathered).isEmpty()


def test_rows_of_no_folder_are_not_many(spark):
    counts = spark.createDataFrame([(1, 30), (2, 10)], "month int, _n long")
    assert not storage.many_in_folders(counts.where("_n < 0"), 2)
    assert not storage.many_in_folders(counts, 2)


def test_streamed_records_are_written_once(spark):
    """Arrivals go straight to the folder that the stream reads: no copy of all records beside it."""
    root = storage.scratch_root(spark)
    before = set(files_under(spark, root))
    catalog_tables.streamed_upsert(spark, SF).count()
    new = [f for f in files_under(spark, root) if f not in before]
    assert {f.split("/")[1] for f in new if f.startswith("stream-")} >= {"incoming", "store"}
    assert not [f for f in new if f.startswith("records-") or "/arrivals/" in f]


def test_only_folders_of_the_months_are_read(spark, tmp_path):
    """Other months' folders are pruned while the join runs; null parts are found, too."""
    store, listed = str(tmp_path / "store"), str(tmp_path / "months")
    rows = [(2024, m, c, float(m or 0)) for m in (1, 2, 3, None) for c in "ab"] + [(None, 1, "a", 8.0), (-1, 1, "a", 9.0)]
    spark.createDataFrame(rows, TYPES).write.partitionBy("year", "month_number").parquet(store)
    months = [(2024, 2), (2024, None), (-1, 1), (2030, 1)]
    spark.createDataFrame(months, "year int, month_number int").write.parquet(listed)
    found = upsert.rows_of_months(spark.read.parquet(store), spark.read.parquet(listed)).select(*KEYS, "valuecif")
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect()), key=str) == sorted((r for r in rows if r[:2] in months), key=str)


def test_cleaned_rows_of_many_a_month_need_no_shuffle(spark, tmp_path, monkeypatch):
    """Cleaned rows tell whether their tasks can write month folders as they are; the rows written are the same."""
    raw = [(f"{m} 2024", c, "5", "7.25") for m in ("January", "May", None) for c in "abcd"] * 2
    raw = spark.createDataFrame(raw, "month string, country_code string, weight string, valuecif string").repartition(2)
    rows, many = clean_by_month(raw)
    assert not many
    monkeypatch.setattr(storage, "MANY_ROWS", 1)
    same, many = clean_by_month(raw)
    assert many and same.count() == 12 and same.exceptAll(rows).isEmpty()
    store = write_cleaned(same, str(tmp_path / "store"), by_month=many)
    assert spark.read.parquet(store).select(*rows.columns).exceptAll(rows).isEmpty()
    written, gathered = [], []
    monkeypatch.setattr(sinks, "write_cleaned", lambda df, path, by_month=False: (written if by_month else gathered).append(path) or write_cleaned(df, path, by_month=by_month))
    assert catalog_tables.stored_table(spark, SF).count() and written and not gathered
