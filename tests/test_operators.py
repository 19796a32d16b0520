import random
import re
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cargolens import schema
from cargolens.operators import aggregates, classify, clean, concentration, filters, matrix, percentiles
from cargolens.operators import quality, ranking, running, trends
from cargolens.plans import reports

SITC_GOLDEN = [
    ("2710", "3", "Mineral Fuels & Lubricants"),
    ("8703", "7", "Machinery & Transport Equipment"),
    ("8517", "7", "Machinery & Transport Equipment"),
    ("8425", "7", "Machinery & Transport Equipment"),
    ("8469", "7", "Machinery & Transport Equipment"),
    ("3004", "5", "Chemicals & Related Products"),
    ("2801", "5", "Chemicals & Related Products"),
    ("7201", "6", "Iron & Steel"),
    ("101", "0", "Food & Live Animals"),
    ("5201", "6", "Textiles & Textile Products"),
    ("4801", "6", "Paper & Paper Products"),
    ("6801", "6", "Non-Metallic Mineral Products"),
    ("7401", "6", "Non-Ferrous Metals"),
    ("401", "6", "Manufactured Goods"),
    ("6", "6", "Manufactured Goods"),
    ("77", "6", "Manufactured Goods"),
    ("44", "2", "Crude Materials (Except Fuels)"),
    (None, "9", "Commodities Not Classified Elsewhere"),
    ("", "9", "Commodities Not Classified Elsewhere"),
    ("x", "9", "Commodities Not Classified Elsewhere"),
    ("5.0", "9", "Commodities Not Classified Elsewhere"),
]


def test_classification_golden_cases(spark):
    df = spark.createDataFrame([(c,) for c, _, _ in SITC_GOLDEN], "commodity_code string")
    found = classify.add_industry(classify.add_section_name(classify.add_section(df)))
    rows = {r["commodity_code"]: r for r in found.collect()}
    assert len(rows) == len(SITC_GOLDEN)
    for code, section, industry in SITC_GOLDEN:
        assert rows[code]["section"] == section, code
        assert rows[code]["industry_sector"] == industry, code
    assert rows["2710"]["section_name"] == "Mineral Fuels and Lubricants"


def test_classification_lists(spark):
    assert classify.sections(spark).count() == 10
    names = [r[0] for r in classify.industries(spark).collect()]
    assert len(names) == 18 and names == sorted(names)
    assert "Wood & Cork Products" in names and "Manufactured Goods" not in names


def test_classification_needs_no_shuffle(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("commodity_code"))
    plan = classify.add_industry(df)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_null_keys_form_no_group_and_empty_sums_are_zero(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("b", None), (None, 5.0)], "k string, valuecif double"
    )
    rows = {r["k"]: r["valuecif"] for r in aggregates.group_totals(df, "k", ["valuecif"], None).collect()}
    assert rows == {"a": 1.0, "b": 0.0}


def imports_frame(spark, rows):
    return spark.createDataFrame(
        [(c, k, Decimal(v) if v is not None else None) for c, k, v in rows],
        "commodity_description string, country_description string, valuecif decimal(20,2)",
    )


def test_concentration_against_pandas(spark):
    random.seed(3)
    rows = [(f"c{random.randint(0, 9)}", f"k{random.randint(0, 12):02d}", random.randint(0, 9999)) for _ in range(3000)]
    # One commodity holds a third of all rows.
    rows += [("hot", f"k{random.randint(0, 12):02d}", random.randint(0, 9999)) for _ in range(1500)]
    pdf = pd.DataFrame(rows, columns=["c", "k", "v"])
    pairs = pdf.groupby(["c", "k"])["v"].sum().reset_index()
    pairs["s"] = pairs["v"] / pairs.groupby("c")["v"].transform("sum") * 100
    found = {r[0]: r for r in concentration.concentration(imports_frame(spark, rows)).collect()}
    assert set(found) == set(pairs["c"])
    for c, group in pairs.groupby("c"):
        row = found[c]
        assert row["total_value"] == group["v"].sum()
        assert row["hhi_index"] == pytest.approx((group["s"] ** 2).sum())
        assert row["top_country_share"] == pytest.approx(group["s"].max())
        assert row["top3_country_share"] == pytest.approx(group["s"].nlargest(3).sum())
        assert row["top_country"] == group.loc[group["s"].idxmax(), "k"]
        assert 0 < row["hhi_index"] <= 10_000


def test_concentration_of_a_worthless_commodity(spark):
    df = imports_frame(spark, [("z", "a", 0), ("z", "b", 0), ("y", "a", 3)])
    row = {r[0]: r for r in concentration.concentration(df).collect()}["z"]
    assert (row["hhi_index"], row["top_country_share"], row["risk_level"]) == (0.0, None, "LOW RISK")


def test_ties_take_the_first_name(spark):
    df = imports_frame(spark, [("x", "b", 5), ("x", "a", 5), ("x", "c", 1)])
    assert concentration.concentration(df).first()["top_country"] == "a"
    pairs = aggregates.group_totals(df, ["commodity_description", "country_description"], ["valuecif"], None)
    best = ranking.largest_member(pairs, "commodity_description", "country_description", "valuecif", "m")
    assert best.first()["m"] == "a"
    assert ranking.top_k(pairs, "valuecif", "country_description", 1).first()["country_description"] == "a"


def test_one_scan_risk_equals_the_join(spark):
    rows = [("a", "k1", 60), ("a", "k2", 40), ("b", None, 10), ("b", "k1", 30), (None, "k1", 25), ("c", None, 7)]
    df = imports_frame(spark, rows).withColumn("weight", F.lit(1.0))
    joined = concentration.join_risks(concentration.concentration(df), concentration.dependence(df))
    single = concentration.commodity_risk(df)
    key = lambda r: r["commodity_description"]
    left = sorted((r.asDict() for r in joined.collect()), key=key)
    right = sorted((r.asDict() for r in single.select(*joined.columns).collect()), key=key)
    assert [key(r) for r in left] == ["a", "b"]
    for a, b in zip(left, right):
        for name in a:
            assert a[name] == (pytest.approx(b[name]) if isinstance(b[name], float) else b[name]), name


def test_dependence_runs_to_a_hundred(spark, many_blocks):
    df = imports_frame(spark, [(f"c{i:03d}", "k", i % 7 + 1) for i in range(200)])
    df = df.withColumn("weight", F.lit(1.0))
    by_value = concentration.dependence(df, cumulative="value").orderBy("cumulative_pct").collect()
    assert by_value[-1]["cumulative_pct"] == pytest.approx(100)
    assert [r["valuecif"] for r in by_value] == sorted((r["valuecif"] for r in by_value), reverse=True)
    by_name = concentration.dependence(df, cumulative="name").orderBy("commodity_description").collect()
    shares = np.cumsum([r["dependence_pct"] for r in by_name])
    assert [r["cumulative_pct"] for r in by_name] == pytest.approx(list(shares))


def test_running_sum_over_many_blocks_with_ties(spark, many_blocks):
    random.seed(5)
    # A third of the rows share one value.
    rows = [(i, 7 if i % 3 == 0 else random.randint(0, 50)) for i in range(5000)]
    df = spark.createDataFrame(rows, "k int, v bigint").repartition(6)
    found = running.running_sum(df, "v", [F.desc("v"), F.asc("k")], "r").collect()
    expected, so_far = {}, 0
    for k, v in sorted(rows, key=lambda r: (-r[1], r[0])):
        so_far += v
        expected[k] = so_far
    assert {r["k"]: r["r"] for r in found} == expected


PERCENTS = (1, 10, 25, 50, 75, 90, 99)


@pytest.mark.parametrize("kind", ["spread", "hot", "constant", "few", "edges"])
def test_percentiles_are_exact(spark, many_blocks, kind):
    rng = np.random.default_rng(11)
    data = {
        "spread": rng.lognormal(3, 2, 20_000),
        "hot": np.where(rng.random(20_000) < 0.4, 42.0, rng.normal(40, 30, 20_000)),
        "constant": np.full(5_000, 3.25),
        "few": np.array([4.0, 1.0, 3.0]),
        "edges": np.concatenate([2.0 ** rng.integers(-1000, 1000, 300), -(2.0 ** rng.integers(-60, 60, 300)), [0.0, -0.0, 5e-324]]),
    }[kind]
    df = spark.createDataFrame(pd.DataFrame({"v": data})).repartition(7)
    found = {r[0]: r[1] for r in percentiles.percentile_points(df, "v", PERCENTS).collect()}
    for p in PERCENTS:
        assert found[p] == pytest.approx(np.percentile(data, p), rel=1e-12), p


def test_percentiles_of_nothing_are_null(spark):
    df = spark.createDataFrame([], "v double")
    assert [r[1] for r in percentiles.percentile_points(df, "v", [50]).collect()] == [None]


def test_group_medians(spark, many_blocks):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"u": rng.choice(["a", "b", "b", "b", "c"], 3001), "q": rng.integers(0, 60, 3001) / 4})
    found = {r[0]: r[1] for r in percentiles.group_medians(spark.createDataFrame(pdf), "u", "q").collect()}
    assert found == pdf.groupby("u")["q"].median().to_dict()


def test_describe_matches_pandas(spark):
    values = pd.Series([3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0])
    found = {r[0]: r[1] for r in percentiles.describe(spark.createDataFrame(values.to_frame("v")), "v").collect()}
    expected = values.describe()
    assert found["std"] == pytest.approx(expected["std"])
    assert [found["p25"], found["p50"], found["p75"]] == list(expected[["25%", "50%", "75%"]])


def test_buckets_keep_the_order_of_values(spark):
    rng = np.random.default_rng(3)
    values = np.sort(np.concatenate([rng.normal(0, 1, 2000), rng.lognormal(0, 60, 2000), 2.0 ** np.arange(-1000, 1000), np.nextafter(2.0 ** np.arange(-900, 900), 0), [0.0, 5e-324, np.inf, -np.inf]]))
    df = spark.createDataFrame(pd.DataFrame({"v": values})).withColumn("b", percentiles.bucket_of(F.col("v")))
    buckets = [r["b"] for r in sorted(df.collect(), key=lambda r: r["v"])]
    assert buckets == sorted(buckets)
    assert df.where(F.isnan("v")).isEmpty()


def test_describe_table_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    found = {(r[0], r[1]): r[2] for r in percentiles.describe_table(df, ["a", "b"]).collect()}
    assert found["a", "p50"] == 1.5 and found["b", "p50"] is None and found["b", "count"] == 0.0
    assert len(found) == 16


def test_supplier_trends_fill_missing_years(spark):
    df = spark.createDataFrame(
        [("a", 2024, 10.0), ("a", 2025, 15.0), ("b", 2025, 5.0), ("c", 2024, 5.0), ("d", 2023, 9.0)],
        "country_description string, year int, valuecif double",
    )
    rows = {r["country"]: r for r in trends.supplier_trends(df, floor=None).collect()}
    assert set(rows) == {"a", "b", "c"}
    assert (rows["a"]["absolute_change"], rows["a"]["pct_change"]) == (5.0, 50.0)
    assert (rows["b"]["value_2024"], rows["b"]["pct_change"]) == (0.0, 0.0)
    assert (rows["c"]["value_2025"], rows["c"]["pct_change"]) == (0.0, -100.0)
    assert sum(r["share_2024"] for r in rows.values()) == pytest.approx(100)
    assert trends.declining(trends.supplier_trends(df, floor=None), 1).first()["country"] == "c"


def test_commodity_growth_is_null_from_zero(spark):
    df = spark.createDataFrame(
        [("a", 2025, 5.0), ("b", 2024, 4.0), ("b", 2025, 5.0)],
        "commodity_description string, year int, valuecif double",
    )
    rows = {r[0]: r["growth_rate_pct"] for r in trends.commodity_trends(df, both_years=False).collect()}
    assert rows == {"a": None, "b": 25.0}
    assert [r[0] for r in trends.commodity_trends(df).collect()] == ["b"]


def test_yearly_growth_needs_two_years(spark):
    df = spark.createDataFrame([(2023, 1.0), (2024, 2.0), (2025, 4.0)], "year int, valuefob double")
    assert trends.yearly_growth(df).count() == 0
    assert trends.yearly_growth(df, exactly_two=False).first()["growth_pct"] == 100.0
    assert trends.yearly_growth(df.where("year > 2023")).first()["growth_pct"] == 100.0


def test_long_and_wide_matrix_agree(spark):
    df = spark.createDataFrame(
        [("p1", "a", 3.0), ("p1", "b", 1.0), ("p2", "a", 4.0)],
        "ausport_description string, country_description string, valuecif double",
    )
    pairs = matrix.port_country_totals(df)
    wide = {r[0]: r for r in matrix.wide_matrix(pairs, ["a", "b"], scale=1).collect()}
    assert wide["p2"]["b"] == 0.0
    for row in pairs.collect():
        assert wide[row[0]][row[1]] == row[2]
    block = matrix.top_block(pairs, ports=1, countries=1).collect()
    assert [(r["ausport_description"], r["country_description"]) for r in block] == [("p1", "a")]
    with pytest.raises(Exception, match="no column for b"):
        matrix.wide_matrix(pairs, ["a"], scale=1).collect()


def test_top_countries_are_those_of_all_ports(spark):
    df = spark.createDataFrame(
        [("p1", "a", 9.0), ("p1", "b", 8.0), ("p2", "a", 1.0), ("p3", "c", 8.5), ("p4", "c", 8.5)],
        "ausport_description string, country_description string, valuecif double",
    )
    pairs = matrix.port_country_totals(df)
    block = matrix.top_block(pairs, ports=1, countries=2).collect()
    assert [(r["ausport_description"], r["country_description"]) for r in block] == [("p1", "a")]


def test_port_shares_sum_to_a_hundred(spark):
    df = spark.createDataFrame(
        [("p1", "a", 3.0), ("p1", "b", 1.0), ("p2", "a", 4.0)],
        "ausport_description string, country_description string, valuecif double",
    )
    sums = matrix.port_country_shares(df).groupBy("ausport_description").agg(F.sum("pct_of_port").alias("s"))
    assert {r["s"] for r in sums.collect()} == {100.0}
    top = {r["port"]: r for r in matrix.port_concentration(df).collect()}["p1"]
    assert (top["num_countries"], top["top_country_pct"]) == (2, 75.0)


def test_filters(spark):
    df = spark.createDataFrame(
        [(2024, "May", "a"), (2025, "May", "b"), (2025, "June", "a")],
        "year int, month string, country_description string",
    )
    assert filters.matching(df).count() == 3
    assert filters.matching(df, year=[], country=["a"]).count() == 2
    assert filters.matching(df, year=[2025], month=["May"]).count() == 1
    with pytest.raises(ValueError):
        filters.matching(df, port=["x"])


def test_filter_option_defaults(spark):
    df = spark.createDataFrame(
        [(y, "May", "a", 1.0) for y in range(2018, 2026)],
        "year int, month string, country_description string, valuecif double",
    )
    options = filters.filter_options(df).where("filter = 'year' AND is_default")
    assert sorted(r["choice"] for r in options.collect()) == ["2024", "2025"]
    few = filters.filter_options(df.where("year > 2020")).where("filter = 'year' AND is_default")
    assert few.count() == 5


def test_dimension_totals(spark):
    df = spark.createDataFrame(
        [("a", "x", 1.0), ("a", None, 2.0), ("b", "x", 4.0)], "p string, q string, valuecif double"
    )
    rows = {(r["dimension"], r["member"]): r["valuecif"] for r in aggregates.dimension_totals(df, ["p", "q"]).collect()}
    assert rows == {("p", "a"): 3.0, ("p", "b"): 4.0, ("q", "x"): 5.0, ("total", None): 7.0}


def test_cleaning_tolerates_absent_columns(spark):
    df = spark.createDataFrame([("January 2024", "5"), (None, "x")], "Month string, Weight string")
    rows = clean.clean_imports(df).orderBy("year").collect()
    assert [(r["year"], r["month"], r["month_number"], r["weight"]) for r in rows] == [
        (0, None, None, 0.0), (2024, "January", 1, 5.0),
    ]


def test_cleaning_rounds_counts_only(spark):
    df = spark.createDataFrame(
        [("Number", "2.5"), ("Number", "3.5"), ("Litres Al", "2.5")], "Unit_Quantity string, Quantity string"
    )
    rows = {(r["unit_quantity"], r["quantity"]) for r in clean.clean_imports(df).collect()}
    assert rows == {("Number", 2.0), ("Number", 4.0), ("Litres", 2.5)}


def test_value_per_tonne_without_weight_is_null(spark):
    df = spark.createDataFrame([("0", "10", "12"), ("2", "10", "8")], "weight string, valuefob string, valuecif string")
    rows = clean.clean_imports(df).orderBy("weight").collect()
    assert [(r["value_per_tonne_fob"], r["insurance_freight_cost"]) for r in rows] == [(None, 2.0), (5.0, 0.0)]


def test_quality_profiles(spark):
    df = spark.createDataFrame(
        [("Number", "1.5"), ("Number", "1.5"), (" number", None), ("kg", "-2"), (None, "0")],
        "unit_quantity string, quantity string",
    )
    missing = {r["column_name"]: r["missing_count"] for r in quality.missing_profile(df).collect()}
    assert missing == {"unit_quantity": 1, "quantity": 1}
    assert quality.duplicate_profile(df).first()["duplicate_rows"] == 1
    fractional = {r[0]: r["fractional_count"] for r in quality.fractional_counts(df).collect()}
    assert fractional == {"Number": 2, " number": 0}
    variants = quality.unit_variants(df).collect()
    assert {(r["base_unit"], r["spellings"]) for r in variants} == {("number", 2)} and len(variants) == 2
    assert quality.non_positive_quantities(df).first()["non_positive_rows"] == 2
    assert quality.value_counts(df, "unit_quantity", 1).first()["row_count"] == 2
    distinct = {r[0]: r[1] for r in quality.cardinality_profile(df, ["unit_quantity"], exact=False).collect()}
    assert distinct == {"unit_quantity": 3}


def test_quadrants(spark):
    df = spark.createDataFrame(
        [("0101", 100.0, 10.0), ("2710", 50.0, 100.0), ("8703", 10.0, 0.1), ("3004", 1.0, 1.0), ("2204", 5.0, 0.0)],
        "commodity_code string, valuecif double, weight double",
    )
    rows = {r["industry_sector"]: r["category"] for r in reports.market_quadrants(df).collect()}
    assert rows == {
        "Food & Live Animals": "Market Leader",
        "Mineral Fuels & Lubricants": "Market Leader",
        "Machinery & Transport Equipment": "Premium Product",
        "Chemicals & Related Products": "Standard",
    }


def test_cleaning_stays_below_the_size_that_the_jvm_compiles(spark, tmp_path, capsys):
    """No generated method of a filtered, cleaned extract has 8,000 bytes or more."""
    raw = spark.createDataFrame([tuple("May 2024" if c == "month" else "1" for c in schema.RAW_COLUMNS)], [*schema.RAW_COLUMNS])
    raw.write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    dated = clean.split_month(raw.withColumn("r", F.struct(*raw.columns)))
    chosen = dated.where("NOT (year = 2025 AND month_number IN (4, 9)) OR month_number IS NULL").select("r.*")
    schema.conform(clean.clean_records(chosen)).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_numbers_are_cleaned_whatever_their_types(spark):
    df = spark.createDataFrame([("1d", 2.5, -3, "x"), (None, None, 4, "y")], "weight string, quantity double, valuecif int, mode string")
    found = clean.clean_numbers(df)
    assert found.dtypes == [("weight", "double"), ("quantity", "double"), ("valuecif", "double"), ("mode", "string")]
    assert [tuple(r) for r in found.collect()] == [(0.0, 2.5, 0.0, "x"), (0.0, 0.0, 4.0, "y")]
    assert clean.clean_numbers(df.select("mode")).columns == ["mode"]
