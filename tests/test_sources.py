import json

import pytest
from pyspark.sql import functions as F

from cargolens import schema
from cargolens.plans import reports
from cargolens.sources import scan, sinks
from cargolens.storage import scratch_path
from verification.imports_view import imports_fact, imports_raw

SF = "/root/testdata/sf0.001"


def test_csv_with_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Month,State\n"January\n2024",NSW\nMay 2025,NA\n')
    rows = scan.raw_csv(spark, str(tmp_path), multi_line=True).orderBy("month").collect()
    assert [(r["month"], r["state"]) for r in rows] == [("January\n2024", "NSW"), ("May 2025", None)]
    kept = scan.raw_csv(spark, str(tmp_path), keep=["state"], multi_line=True)
    assert {r["state"] for r in kept.collect()} == {"NSW", "NA"}


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Valuefob,Note.x,Mode,Month,Weight\n7,n,4,May 2025,3\n")
    row = scan.raw_csv(spark, str(tmp_path)).first()
    assert (row["valuefob"], row["weight"], row["mode"], row["month"], row["note.x"]) == ("7", "3", "4", "May 2025", "n")
    assert row["state"] is None and row["valuecif"] is None
    assert set(schema.RAW_COLUMNS) <= set(row.asDict())


def test_files_with_other_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Month,Weight\nMay 2025,3\n" * 1)
    (tmp_path / "b.csv").write_text("Weight,Month\n3,May 2025\n")
    with pytest.raises(Exception):
        scan.raw_csv(spark, str(tmp_path)).collect()
    (tmp_path / "c").mkdir()
    (tmp_path / "c/c.csv").write_text("Month, month\nMay 2025,3\n".replace(", ", ","))
    with pytest.raises(Exception):
        scan.raw_csv(spark, str(tmp_path / "c")).collect()


def test_lost_amounts(spark):
    df = spark.createDataFrame([(1.0, None), (float("inf"), 1e19), (None, 2.0)], "valuefob double, valuecif double")
    found = {r[0]: (r[1], r[2]) for r in schema.lost_amounts(df).collect()}
    assert found == {"valuefob": (2, 1), "valuecif": (2, 1)}


def test_year_filter(spark):
    df = spark.createDataFrame([("May 2023",), ("May 2024",), (None,)], "month string")
    assert [r["year"] for r in scan.in_years(df, [2024]).collect()] == ["2024"]
    assert scan.in_years(df, None).count() == 3
    assert scan.in_years(df.withColumnRenamed("month", "m"), [2024]).count() == 3


def test_raw_names():
    assert sinks.raw_name([2024, 2025]) == "imports_2024_2025"
    assert sinks.raw_name() == "imports_all"


def test_raw_round_trip(spark):
    path = sinks.write_raw(imports_raw(spark, SF), scratch_path(spark, "raw"), [2024])
    back = scan.raw_csv(spark, path, missing_marks=(), multi_line=True)
    ours = imports_raw(spark, SF).toDF(*back.columns)
    assert back.exceptAll(ours).isEmpty() and ours.exceptAll(back).isEmpty()


def test_stored_table_prunes_folders(spark):
    path = sinks.write_cleaned(imports_fact(spark, SF), scratch_path(spark, "store"))
    df = scan.filtered(scan.cleaned(spark, path), year=[2024], country=["NATION_1"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    partition = plan[plan.index("PartitionFilters") :]
    assert "year" in partition.split("PushedFilters")[0]
    assert "country_description" in partition.split("PushedFilters")[1]
    assert df.count() == imports_fact(spark, SF).where("year = 2024 AND country_description = 'NATION_1'").count()


def paged(spark):
    rows = [(y, m, None if k % 5 == 0 else str(k % 7), k) for k, (y, m) in enumerate([(2024, 1), (2024, 2), (None, None), (2025, 1)] * 30)]
    rows.append((2024, None, None, 999))
    return spark.createDataFrame(rows, "year int, month_number int, country_code string, n int").repartition(4)


def null_first(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def test_numbered_pages_cover_the_table_once(spark, many_blocks):
    df, keys = paged(spark), ("year", "month_number", "country_code")
    want = sorted((tuple(r) for r in df.collect()), key=null_first)
    pages = [sorted((tuple(r) for r in scan.page(df, 25, n, keys, ["n"]).collect()), key=null_first) for n in range(1, 7)]
    assert [len(p) for p in pages] == [25, 25, 25, 25, 21, 0]
    assert [r for p in pages for r in p] == want
    with pytest.raises(ValueError):
        scan.page(df, 5, 1, ["n"])


def test_walked_pages_cover_the_table_once(spark):
    df, keys = paged(spark), ("year", "month_number", "country_code", "n")
    found, last = [], None
    while True:
        page = [tuple(r) for r in scan.page_after(df, last, 13, keys).collect()]
        if not page:
            break
        found += page
        last = page[-1]
    assert found == sorted((tuple(r) for r in df.collect()), key=null_first)


def test_preview_takes_available_columns(spark):
    df = spark.createDataFrame([("May", 2), ("April", 1)], "month string, other int")
    assert [tuple(r) for r in scan.preview(df, rows=1).collect()] == [("April",)]


def test_summary_document_and_report(spark, tmp_path):
    df = imports_fact(spark, SF)
    summary = reports.summary_statistics(df)
    path = sinks.write_summary(summary, str(tmp_path / "summary"))
    (file,) = list((tmp_path / "summary").glob("part-*.json"))
    document = json.loads(file.read_text())
    assert document["total_records"] == df.count()
    assert document["date_range"]["years"] == list(range(2019, 2026))
    values = [c["value_cif"] for c in document["top_countries"]]
    countries = df.select("country_description").distinct().count()
    assert len(values) == min(15, countries) and values == sorted(values, reverse=True)
    assert len(document["top_commodities"]) == 15 and len(document["top_ports"]) == 10
    assert sum(document["states"].values()) == pytest.approx(document["total_value_cif"])
    assert sum(document["transport_modes"].values()) == pytest.approx(document["total_value_cif"])
    assert path.endswith("summary")
    sinks.write_report(summary, str(tmp_path / "report"))
    (file,) = list((tmp_path / "report").glob("part-*.txt"))
    lines = file.read_text().splitlines()
    assert lines[0] == "=" * 60 and lines[1] == "DATA ANALYSIS SUMMARY REPORT"
    assert f"Total Records: {df.count():,}" in lines
    assert "Top 15 Countries by CIF Value:" in lines
    short = [r["line"] for r in reports.report_lines(summary, top_countries=2).orderBy("line_number").collect()]
    assert short[-3] == "Top 2 Countries by CIF Value:" and short[:-3] == lines[: len(short) - 3]
    assert lines[-len(values)].startswith("  1. ") and lines[-1].startswith(f"  {len(values)}. ")
