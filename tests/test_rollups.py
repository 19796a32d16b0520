"""Stored aggregates: reports from them read no records, equal those from records, and follow a store's months."""

import json
import re

import pytest
from pyspark.sql import functions as F

from cargolens.operators import aggregates, concentration, trends
from cargolens.plans import reports
from cargolens.plans.refresh import refresh
from cargolens.streaming import rollups, upsert
from verification.imports_view import imports_fact, imports_raw

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("facts") / "facts")
    imports_fact(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def root(spark, facts, tmp_path_factory):
    folder = tmp_path_factory.mktemp("rollups")
    rollups.build_rollups(facts, str(folder / "kept"), str(folder / "scratch"))
    return str(folder / "kept")


def near(rows):
    return sorted(tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows.collect())


REPORTS = {
    "overview": ((), reports.overview),
    "totals": ((), aggregates.grand_totals),
    "gap": ((), reports.fob_cif_gap),
    "years": ((), trends.yearly_series),
    "seasons": ((), trends.seasonal_means),
    "countries": (("country_description",), lambda df: reports.country_profile(df, cumulative=False)),
    "modes": (("mode_description",), reports.transport_modes),
    "origins": (("osport_description",), reports.origin_ports),
    "sectors": (("commodity_code", "commodity_description"), reports.industry_sectors),
    "risk": (("commodity_description", "country_description"), concentration.commodity_risk),
    "trends": (("commodity_description",), trends.commodity_trends),
    "leaders": (("commodity_description", "country_description"), reports.overview_leaders),
}


@pytest.mark.parametrize("name", REPORTS)
def test_reports_from_aggregates_equal_those_from_records(spark, facts, root, name):
    columns, report = REPORTS[name]
    rolled = report(rollups.covering(spark, root, *columns))
    assert near(rolled) == near(report(facts))
    plan = rolled._jdf.queryExecution().optimizedPlan().toString() + rolled._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"Location: InMemoryFileIndex\([^)]*\)\[([^\]]*)\]", plan)
    assert scans and all("/kept/" in s for s in scans) and "facts" not in plan


def test_the_smallest_cuboid_is_taken(spark, root):
    plan = rollups.covering(spark, root, "country_description")._jdf.queryExecution().executedPlan().toString()
    assert "/kept/countries" in plan
    assert "/kept/trade" in rollups.covering(spark, root, "commodity_code", "country_description")._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        rollups.covering(spark, root, "state", "country_description")


def test_aggregates_of_a_store_are_those_of_its_rows(spark, facts, tmp_path):
    store = str(tmp_path / "store")
    upsert.upsert(spark, store, facts.where("year < 2024"), rollups=True)
    restated = facts.where("year = 2023 AND month_number IN (2, 9)").withColumn("valuecif", (F.col("valuecif") * 2).cast("decimal(20,2)"))
    late = facts.where("year = 2024 AND month_number = 5").withColumn("month_number", F.lit(None).cast("int"))
    for batch in (restated, late, facts.where("year = 2025"), restated):
        upsert.upsert(spark, store, batch)
    held, kept = spark.read.parquet(store), rollups.rollups_of(store)
    for name, dims in {**rollups.LEAVES, **rollups.DERIVED}.items():
        own = rollups._stored(spark, kept, name)
        keys = [*rollups.MONTH, *dims]
        assert own.count() == held.select(keys).distinct().count(), name
        sums = [F.sum(c).cast("double").alias(c) for c in ("valuefob", "valuecif", "weight", "quantity")]
        again = held.groupBy(*keys).agg(*sums, F.count(F.lit(1)).alias("n"), F.count("weight").alias("w"))
        stored = own.select(*keys, *[F.col(c).cast("double") for c in ("valuefob", "valuecif", "weight", "quantity")], "records_added_up", "weight_records")
        assert near(stored) == near(again), name
    upsert.upsert(spark, store, restated, rebuild=True)
    months = rollups.covering(spark, kept, "year")
    assert {(r["year"], r["month_number"]) for r in months.collect()} == {(2023, 2), (2023, 9)}


def test_missing_columns_become_null_members(spark, tmp_path):
    rows = spark.createDataFrame([(2024, 1, "May", 2.0), (None, None, None, None)], "year int, month_number int, month string, weight double")
    rollups.build_rollups(rows, str(tmp_path / "kept"), str(tmp_path / "scratch"))
    found = aggregates.grand_totals(rollups.covering(spark, str(tmp_path / "kept"))).first()
    assert (found["total_records"], found["total_weight"], found["mean_weight"], found["total_valuecif"]) == (2, 2.0, 2.0, 0.0)


def test_the_summary_of_a_refresh_reads_no_record(spark, tmp_path):
    raw = imports_raw(spark, SF).where("`Month` IS NOT NULL")
    with_rollups, without = str(tmp_path / "a"), str(tmp_path / "b")
    refresh(spark, raw, with_rollups, f"{with_rollups}-summary", years=[2024, 2025], rollups=True)
    refresh(spark, raw, without, f"{without}-summary", years=[2024, 2025])
    documents = [json.loads(next((tmp_path / f"{n}-summary/summary_statistics").glob("*.json")).read_text()) for n in "ab"]
    for key, value in documents[1].items():
        assert documents[0][key] == (pytest.approx(value) if isinstance(value, float) else value), key
    members = rollups.dimension_members(spark, rollups.rollups_of(with_rollups), reports.summary_dimensions())
    assert members.inputFiles() and all("/a.rollups/" in f for f in members.inputFiles())


def test_both_wide_cuboids_come_from_one_shuffle_of_records(spark, facts, tmp_path):
    wide = rollups._wide(rollups._conformed(facts))
    assert wide._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert wide.where("cuboid = 'commodities'").agg(F.sum(aggregates.RECORDS)).first()[0] == facts.count()
