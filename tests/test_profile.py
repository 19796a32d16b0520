"""Quality profile from one scan, sketches, samples."""

import json
import shutil

import pytest
from pyspark.sql import functions as F

from cargolens.operators import percentiles, profile, quality, sampling, sketches
from cargolens.plans import reports
from cargolens.plans.refresh import refresh
from verification.imports_view import imports_raw

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    from cargolens.operators.clean import standard_names

    path = str(tmp_path_factory.mktemp("raw") / "raw")
    standard_names(imports_raw(spark, SF)).write.parquet(path)
    return path


def test_the_profile_reads_the_table_once(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    shutil.copytree(raw, path)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counted(_):
        seen.add(1)
        return True

    rows = spark.read.parquet(path).where(counted("month").eqNullSafe(F.lit(True)))
    n = spark.read.parquet(raw).count()
    found = profile.quality_profile(rows)
    assert seen.value == n == found.metrics["rows"]
    shutil.rmtree(path)  # nothing is read again
    numbers = found.table().collect()
    assert seen.value == n and {r["profile"] for r in numbers} >= {"missing", "numeric", "duplicates", "units", "variants", "shape"}


def test_the_profile_equals_the_single_ones(spark, raw):
    df = spark.read.parquet(raw)
    found = profile.quality_profile(df)
    rows = {(r["profile"], r["subject"], r["member"], r["metric"]): r["value"] for r in found.table().collect()}
    for r in quality.missing_profile(df).collect():
        assert rows["missing", r["column_name"], None, "missing_count"] == r["missing_count"]
    for r in quality.cardinality_profile(df).collect():
        assert rows["cardinality", r["column_name"], None, "distinct_values"] == r["distinct_values"]
    for r in quality.unit_quantities(df).collect():
        for metric in ("record_count", "min_quantity", "max_quantity", "mean_quantity", "median_quantity"):
            assert rows["units", "unit_quantity", r["unit_quantity"], metric] == pytest.approx(r[metric])
    assert rows["duplicates", None, None, "duplicate_rows"] == quality.duplicate_profile(df).first()["duplicate_rows"]
    weights = quality.weight_distribution(df).first()
    assert rows["weights", "weight", None, "median_weight"] == weights["median_weight"]
    assert rows["non_positive", "quantity", None, "non_positive_rows"] == quality.non_positive_quantities(df).first()["non_positive_rows"]
    counts = {r["state"]: r["row_count"] for r in found.value_counts("state").collect()}
    assert counts == {r["state"]: r["row_count"] for r in quality.value_counts(df, "state").collect()}


def test_rows_that_differ_in_nulls_are_no_duplicates(spark):
    rows = [("a", None), (None, "a"), ("a", "a"), ("a", None), ('a","', None)]
    df = spark.createDataFrame(rows, "state string, unit_quantity string")
    found = {r["metric"]: r["value"] for r in profile.quality_profile(df).table().collect() if r["profile"] == "duplicates"}
    assert found == {"duplicate_rows": 1.0}


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "state string, weight string, quantity string, unit_quantity string")
    rows = {(r["profile"], r["subject"], r["metric"]): r["value"] for r in profile.quality_profile(df).table().collect()}
    assert rows["shape", None, "total_rows"] == 0 and rows["duplicates", None, "duplicate_rows"] == 0


def test_refresh_reports_before_and_after(spark, tmp_path):
    raw = spark.createDataFrame(
        [("May 2024", "a", "-1", "2"), ("May 2024", "b", "x", "3"), ("June 2024", None, "5", None)],
        "Month string, `Country Description` string, Valuecif string, Weight string",
    )
    for _ in range(2):  # a first load, then a merge
        refresh(spark, raw, str(tmp_path / "store"), quality=str(tmp_path / "quality"))
        found = {}
        for file in (tmp_path / "quality").glob("*.json"):
            for line in file.read_text().splitlines():
                row = json.loads(line)
                found[row["metric"]] = (row.get("before"), row.get("after"))
        assert found["rows"] == (3, 3) and found["missing country_description"] == (1, 0)
        assert found["unread valuecif"] == (1, 0) and found["negative valuecif"] == (1, 0)


def test_sketches_merge_and_stay_within_their_bound(spark):
    df = spark.range(40_000).selectExpr("int(id % 3) AS year", "int(id % 12) AS month_number", "double((id * 7919) % 40000) AS v", "string(id % 700) AS t")
    monthly = sketches.sketched(df, ["v"], texts=["t"])
    assert monthly.count() == 12
    whole = sketches.merged(monthly, ["v"], texts=["t"])
    for r in sketches.points(whole, "v", (0, 5, 50, 95, 100)).collect():
        assert abs(r["value"] / 40_000 - r["percentile"] / 100) <= sketches.rank_error() + 1e-4
    assert abs(whole.select(sketches.distinct(whole, "t")).first()[0] - 700) <= 700 * sketches.distinct_error()
    years = sketches.points(sketches.merged(monthly, ["v"], ["year"]), "v", [50], ["year"]).collect()
    assert {r["year"] for r in years} == {0, 1, 2} and all(abs(r["value"] - 20_000) < 40_000 * sketches.rank_error() for r in years)


def test_approximate_forms_are_a_parameter(spark):
    df = spark.range(5000).selectExpr("double(id) AS x", "string(id % 2) AS unit_quantity", "string(id) AS quantity", "cast(null AS double) AS none")
    points = {r["percentile"]: r["value"] for r in percentiles.percentile_points(df, "x", (10, 50), exact=False).collect()}
    assert all(abs(points[p] - 50 * p) < 5000 * sketches.rank_error() for p in (10, 50))
    assert [r["value"] for r in percentiles.percentile_points(df, "none", (50,), exact=False).collect()] == [None]
    units = quality.unit_quantities(df, exact=False).collect()
    assert len(units) == 2 and all(abs(r["median_quantity"] - 2500) < 5000 * sketches.rank_error() for r in units)
    rows = {r["statistic"]: r["value"] for r in reports.distribution(df, "x", exact=False).collect()}
    assert rows["count"] == 4999 and abs(rows["p50"] - 2500) < 5000 * sketches.rank_error()


def test_percentiles_of_counted_values(spark):
    rows = [("a", 1.0, 3), ("a", 5.0, 1), ("b", 2.0, 2), ("b", 4.0, 2), ("c", None, 5)]
    df = spark.createDataFrame(rows, "g string, v double, n long")
    found = {r["g"]: r["value"] for r in percentiles.group_points(df, ["g"], "v", [50], "n").collect()}
    assert found == {"a": 1.0, "b": 3.0}


def test_samples_are_nested_and_hold_the_exact_totals(spark):
    df = spark.range(60_000).selectExpr(
        "2024 AS year", "int(id % 12) AS month_number", "string(id % 5000) AS commodity_code", "cast(null AS string) AS country_code",
        "'p' AS ausport_code", "'q' AS osport_code", "string(id % 4) AS state", "double(id % 97) AS valuecif",
    )
    exact = {r["state"]: (r["n"], r["v"]) for r in df.groupBy("state").agg(F.count("*").alias("n"), F.sum("valuecif").alias("v")).collect()}
    for share in (0.05, 0.3):
        for r in sampling.sampled_totals(df, share, ("state",)).collect():
            n, v = exact[r["state"]]
            assert r["records_low"] <= n <= r["records_high"] and r["valuecif_low"] <= v <= r["valuecif_high"]
            assert 0.5 * share < r["sampled_records"] / n < 1.5 * share
    whole = sampling.sampled_totals(df, 1.0).first()
    assert whole["records_low"] == whole["records_high"] == 60_000 == whole["sampled_records"]
    few, many = (df.where(sampling.in_sample(sampling.KEYS, s)) for s in (0.1, 0.2))
    assert few.exceptAll(many).isEmpty()
    with pytest.raises(ValueError):
        sampling.sampled_totals(df, 0)
