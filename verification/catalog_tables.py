"""Queries for cleaning, data quality, scans, sinks and incremental jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolens import schema
from cargolens.operators import clean, duplicates, percentiles, quality
from cargolens.plans import refresh, reports
from cargolens.sources import pages, scan, sinks
from cargolens.storage import SMALL, scratch_path, stored
from cargolens.streaming import totals, upsert

from .catalog import COUNTRY, ITEM, MEASURES, SUMMARY_COLUMNS, longs, query, rounded
from .catalog import _describe_sql, _summary_sql
from .imports_view import (
    CLEAN_SQL,
    FACT_COLUMNS,
    RAW_HEADERS,
    RAW_SQL,
    imports_fact,
    imports_raw,
    number_sql,
)

RAW_COLUMNS = schema.RAW_COLUMNS


def raw(spark, sf_dir, *columns):
    return clean.standard_names(imports_raw(spark, sf_dir, *columns))


def _stored_raw(spark, sf_dir):
    return stored(raw(spark, sf_dir), "raw", **SMALL)


# ---------------------------------------------------------------- cleaning


@query(
    "R1 P1 P2 P3 P4 P5 P6 P8 P9 P10 P11 P12 P13 U3",
    " SELECT * FROM cleaned",
    CLEAN_SQL,
)
def cleaned_imports(spark, sf_dir):
    return clean.clean_imports(imports_raw(spark, sf_dir))


@query(
    "P6 P7",
    """ SELECT unit_quantity_original, unit_quantity, count(*) AS changed_rows FROM records
    WHERE unit_quantity_original <> unit_quantity GROUP BY 1, 2""",
    CLEAN_SQL,
)
def unit_changes(spark, sf_dir):
    df = imports_raw(spark, sf_dir, "unit_quantity", "quantity")
    return clean.unit_changes(clean.clean_records(df, keep_original_unit=True))


@query(
    "P5 A29",
    " SELECT commodity_description, count(*) AS row_count FROM records GROUP BY 1",
    CLEAN_SQL,
)
def normalized_commodities(spark, sf_dir):
    df = clean.clean_texts(raw(spark, sf_dir, ITEM))
    return quality.value_counts(df, ITEM)


@query(
    "P8",
    """ SELECT unit_quantity, count(*) AS record_count,
    count(*) FILTER (quantity % 1 <> 0) AS fractional_count,
    round(count(*) FILTER (quantity % 1 <> 0) / count(*)::DOUBLE * 100, 6) AS fractional_pct
    FROM records WHERE unit_quantity = 'Number' GROUP BY 1""",
    CLEAN_SQL,
)
def rounded_counts(spark, sf_dir):
    """No fraction is left on counted units after cleaning."""
    df = clean.clean_records(imports_raw(spark, sf_dir, "unit_quantity", "quantity"))
    return rounded(quality.fractional_counts(df), fractional_pct=6)


# ---------------------------------------------------------------- quality


def _missing_sql(table: str, columns) -> str:
    return " " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, "
        f"round((count(*) - count({c})) / count(*)::DOUBLE * 100, 6) AS missing_pct FROM {table} "
        f"HAVING count(*) > count({c})"
        for c in columns
    )


@query("R2 A30", _missing_sql("raw", RAW_COLUMNS), RAW_SQL)
def missing_in_raw(spark, sf_dir):
    return rounded(quality.missing_profile(raw(spark, sf_dir)), missing_pct=6)


@query(
    "R2 A30",
    _missing_sql("cleaned", ("month", "month_number", "value_per_tonne_fob", "value_per_tonne_cif", "weight", "state")),
    CLEAN_SQL,
)
def missing_in_cleaned(spark, sf_dir):
    df = clean.clean_imports(imports_raw(spark, sf_dir))
    return rounded(quality.missing_profile(df), missing_pct=6)


@query(
    "R2 A31",
    f""", d AS (SELECT count(*) AS n FROM raw GROUP BY {', '.join(RAW_COLUMNS)})
    SELECT sum(n)::BIGINT AS total_rows, sum(n - 1)::BIGINT AS duplicate_rows,
      round(sum(n - 1)::DOUBLE / sum(n)::DOUBLE * 100, 6) AS duplicate_pct FROM d""",
    RAW_SQL,
)
def duplicate_profile(spark, sf_dir):
    return rounded(quality.duplicate_profile(raw(spark, sf_dir)), duplicate_pct=6)


@query(
    "R2 A32",
    " "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) - count(n) AS missing_count,
        count(*) FILTER (n < 0) AS negative_count, min(greatest(coalesce(n, 0), 0)) AS min_value,
        max(greatest(coalesce(n, 0), 0)) AS max_value,
        round(avg(greatest(coalesce(n, 0), 0)), 3) AS mean_value
        FROM (SELECT {number_sql(c)} AS n FROM raw)"""
        for c in ("weight", "valuefob", "valuecif", "quantity")
    ),
    RAW_SQL,
)
def numeric_profile(spark, sf_dir):
    df = quality.numeric_profile(raw(spark, sf_dir, "weight", "valuefob", "valuecif", "quantity"))
    return rounded(df, mean_value=3)


@query(
    "R2 A33",
    " "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM cleaned"
        for c in schema.TEXT_COLUMNS
    ),
    CLEAN_SQL,
)
def cardinality_profile(spark, sf_dir):
    df = clean.clean_texts(raw(spark, sf_dir, *schema.TEXT_COLUMNS))
    return quality.cardinality_profile(clean.standard_units(df))


@query("R2 A29", " SELECT unit_quantity, count(*) AS row_count FROM raw GROUP BY 1", RAW_SQL)
def unit_counts(spark, sf_dir):
    return quality.value_counts(raw(spark, sf_dir, "unit_quantity"), "unit_quantity")


@query(
    "R2 A29",
    " SELECT country_description, count(*) AS row_count FROM raw WHERE country_description IS NOT NULL "
    "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    RAW_SQL,
)
def most_frequent_countries(spark, sf_dir):
    return quality.value_counts(raw(spark, sf_dir, COUNTRY), COUNTRY, 10)


@query(
    "A29",
    " SELECT month, count(*) AS row_count FROM raw WHERE month IS NOT NULL GROUP BY 1 ORDER BY 1 LIMIT 15",
    RAW_SQL,
)
def months_in_text_order(spark, sf_dir):
    return quality.value_counts(raw(spark, sf_dir, "month"), "month", 15, by="value")


@query("A29", " SELECT year, count(*) AS row_count FROM records GROUP BY 1", CLEAN_SQL)
def records_by_year(spark, sf_dir):
    return quality.value_counts(clean.clean_records(imports_raw(spark, sf_dir, "month")), "year")


_LIGHT = {"below_1": "n < 1", "below_0_1": "n < 0.1", "below_0_001": "n < 0.001", "above_1000": "n > 1000"}


@query(
    "R2 A34",
    f""", w AS (SELECT {number_sql('weight')} AS n FROM raw)
    SELECT count(*) AS total_rows, min(n) AS min_weight, max(n) AS max_weight,
      round(avg(n), 6) AS mean_weight, round(median(n), 6) AS median_weight,
      {', '.join(f"count(*) FILTER ({t}) AS {c}, round(count(*) FILTER ({t}) / count(*)::DOUBLE * 100, 6) AS {c}_pct" for c, t in _LIGHT.items())}
    FROM w""",
    RAW_SQL,
)
def weight_quality(spark, sf_dir):
    df = quality.weight_distribution(raw(spark, sf_dir, "weight"))
    return rounded(df, mean_weight=6, median_weight=6, **{f"{c}_pct": 6 for c in _LIGHT})


@query(
    "R2 A35",
    f""", q AS (SELECT unit_quantity, {number_sql('quantity')} AS n FROM raw)
    SELECT unit_quantity, count(*) AS record_count, min(n) AS min_quantity, max(n) AS max_quantity,
      round(avg(n), 6) AS mean_quantity, median(n) AS median_quantity FROM q GROUP BY 1""",
    RAW_SQL,
)
def unit_quantities(spark, sf_dir):
    df = quality.unit_quantities(raw(spark, sf_dir, "unit_quantity", "quantity"))
    return rounded(df, mean_quantity=6)


@query(
    "R2 A36",
    f""", q AS (SELECT unit_quantity, {number_sql('quantity')} AS n FROM raw)
    SELECT unit_quantity, count(*) AS record_count, count(*) FILTER (n % 1 <> 0) AS fractional_count,
      round(count(*) FILTER (n % 1 <> 0) / count(*)::DOUBLE * 100, 6) AS fractional_pct
    FROM q WHERE unit_quantity ILIKE '%number%' GROUP BY 1""",
    RAW_SQL,
)
def fractional_counts(spark, sf_dir):
    df = quality.fractional_counts(raw(spark, sf_dir, "unit_quantity", "quantity"))
    return rounded(df, fractional_pct=6)


@query(
    "A36",
    f""" SELECT unit_quantity, quantity, country_code, commodity_code, valuecif FROM raw
    WHERE unit_quantity ILIKE '%number%' AND {number_sql('quantity')} % 1 <> 0
    ORDER BY commodity_code, country_code, quantity, valuecif LIMIT 5""",
    RAW_SQL,
)
def fractional_examples(spark, sf_dir):
    columns = ("unit_quantity", "quantity", "country_code", "commodity_code", "valuecif")
    order = ["commodity_code", "country_code", "quantity", "valuecif"]
    return quality.fractional_examples(raw(spark, sf_dir, *columns), order)


@query(
    "R2 A37",
    """, s AS (SELECT DISTINCT unit_quantity AS u FROM raw)
    SELECT lower(trim(u)) AS base_unit, u AS unit_quantity, count(*) OVER (PARTITION BY lower(trim(u))) AS spellings
    FROM s QUALIFY spellings > 1""",
    RAW_SQL,
)
def unit_variants(spark, sf_dir):
    return quality.unit_variants(raw(spark, sf_dir, "unit_quantity"))


@query(
    "R2 A38",
    f""", q AS (SELECT {number_sql('quantity')} - 25 AS n FROM raw)
    SELECT count(*) AS total_rows, count(*) FILTER (n <= 0) AS non_positive_rows,
      round(count(*) FILTER (n <= 0) / count(*)::DOUBLE * 100, 6) AS non_positive_pct FROM q""",
    RAW_SQL,
)
def non_positive_values(spark, sf_dir):
    """Quantities less 25, so that there are negative ones and zeros."""
    df = raw(spark, sf_dir, "quantity").withColumn("quantity", (F.col("quantity").cast("double") - 25).cast("string"))
    df = quality.non_positive_quantities(df)
    return rounded(df, non_positive_pct=6)


@query(
    "A46",
    """, n AS (SELECT count(*) AS total_rows FROM imports)
    SELECT total_rows, t.column_type, t.column_count FROM n, (VALUES
      ('date', 1), ('decimal(20,2)', 2), ('double', 2), ('int', 2), ('string', 13)) t(column_type, column_count)""",
)
def shape_profile(spark, sf_dir):
    df = imports_fact(spark, sf_dir)
    return quality.shape_profile(df.withColumn("date", F.make_date("year", "month_number", F.lit(1))))


@query(
    "T6 W7",
    """, f AS (SELECT unit_quantity FROM raw GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5),
    s AS (SELECT unit_quantity, quantity, weight, valuefob, commodity_code,
      row_number() OVER (PARTITION BY unit_quantity ORDER BY commodity_code, valuefob, quantity, weight) AS rank
      FROM raw WHERE unit_quantity IN (SELECT unit_quantity FROM f))
    SELECT * FROM s WHERE rank <= 3""",
    RAW_SQL,
)
def unit_samples(spark, sf_dir):
    df = raw(spark, sf_dir, "unit_quantity", "quantity", "weight", "valuefob", "commodity_code")
    order = [F.asc(c) for c in ("commodity_code", "valuefob", "quantity", "weight")]
    return longs(quality.unit_samples(df, order), "rank")


@query("A26", " " + _describe_sql("imports", "valuecif", (25, 50, 75), 2))
def describe_values(spark, sf_dir):
    return rounded(percentiles.describe(imports_fact(spark, sf_dir, "valuecif"), "valuecif"), value=2)


_DESCRIBED = ("weight", "quantity")


@query(
    "A26",
    " "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, * FROM ({_describe_sql('records', c, (25, 50, 75), 4)})"
        for c in _DESCRIBED
    ),
    CLEAN_SQL,
)
def describe_cleaned(spark, sf_dir):
    df = clean.clean_records(imports_raw(spark, sf_dir, *_DESCRIBED, "unit_quantity"))
    return rounded(percentiles.describe_table(df, _DESCRIBED), value=4)


# ---------------------------------------------------------------- scans and sinks

# The files hold the columns in another order, one unknown column more, and lack the origin port's name.
_FILE_COLUMNS = tuple(c for c in reversed(RAW_COLUMNS) if c != "osport_description")
_READ = ", ".join("NULL::VARCHAR AS osport_description" if c == "osport_description" else c for c in RAW_COLUMNS)
_RAW_FILES = (
    RAW_SQL
    + """,
raw0 AS (SELECT * REPLACE (nullif(state, 'nan') AS state, nullif(weight, 'n/a') AS weight), 'x' || mode AS extra_note FROM raw)"""
)


def _raw_files(spark, sf_dir):
    """A raw extract written as such CSV files and read back by name; file marks such as ``nan`` are missing."""
    df = imports_raw(spark, sf_dir).withColumn("Extra Note", F.concat(F.lit("x"), "Mode"))
    df = df.select(*[RAW_HEADERS[c] for c in _FILE_COLUMNS[:3]], "Extra Note", *[RAW_HEADERS[c] for c in _FILE_COLUMNS[3:]])
    return scan.raw_csv(spark, sinks.write_raw(df, scratch_path(spark, "raw")), multi_line=True)


@query("S1 S6", f" SELECT {_READ}, extra_note FROM raw0", _RAW_FILES)
def raw_csv_scan(spark, sf_dir):
    return _raw_files(spark, sf_dir)


@query(
    "S2 S6",
    f" SELECT {_READ}, extra_note, regexp_extract(month, '(\\d{{4}})', 1) AS year FROM raw0 "
    "WHERE regexp_extract(month, '(\\d{4})', 1) IN ('2024', '2025')",
    _RAW_FILES,
)
def year_filtered_scan(spark, sf_dir):
    """Two years of the same files."""
    return scan.in_years(_raw_files(spark, sf_dir), ["2024", "2025"])


@query(
    "S4 P18",
    """ SELECT * FROM imports WHERE year IN (2024, 2025) AND month IN ('January', 'February')
    AND country_description IN ('NATION_1', 'NATION_2')""",
)
def filtered_scan(spark, sf_dir):
    return scan.filtered(
        imports_fact(spark, sf_dir),
        year=[2024, 2025],
        month=["January", "February"],
        country=["NATION_1", "NATION_2"],
    )


_TIES = [c for c in FACT_COLUMNS if c not in scan.PAGE_KEYS]
_PAGE_ORDER = ", ".join([*scan.PAGE_KEYS, *_TIES])


@query("S5", f" SELECT * FROM imports ORDER BY {_PAGE_ORDER} LIMIT 100 OFFSET 200")
def ordered_page(spark, sf_dir):
    return scan.page(imports_fact(spark, sf_dir), 100, 3, then=_TIES)


@query("S5", f" SELECT * FROM imports ORDER BY {_PAGE_ORDER} LIMIT 100 OFFSET 40000")
def deep_page(spark, sf_dir):
    """Far behind the first rows: only the month that holds the page is sorted."""
    return scan.page(imports_fact(spark, sf_dir), 100, 401, then=_TIES)


@query(
    "S5",
    """, g AS (SELECT year, month_number, country_code, commodity_code, sum(valuecif)::DOUBLE AS valuecif
      FROM imports GROUP BY 1, 2, 3, 4)
    SELECT * FROM g WHERE (year, month_number, country_code, commodity_code) > (2022, 6, '12', '5')
    ORDER BY year, month_number, country_code, commodity_code LIMIT 100""",
)
def next_page_by_key(spark, sf_dir):
    df = imports_fact(spark, sf_dir, *scan.PAGE_KEYS, "valuecif").groupBy(*scan.PAGE_KEYS)
    df = df.agg(F.sum("valuecif").cast("double").alias("valuecif"))
    return scan.page_after(df, (2022, 6, "12", "5"), 100, scan.PAGE_KEYS)


_WALK_KEYS = ("year", "month_number", "country_description", "commodity_code", "unit_quantity", "copy")


@query(
    "S5",
    """ SELECT year, month_number, nullif(country_description, 'Unknown') AS country_description, commodity_code,
      unit_quantity, row_number() OVER (PARTITION BY year, month_number, country_description, commodity_code,
      unit_quantity) AS copy FROM records""",
    CLEAN_SQL,
)
def walked_pages(spark, sf_dir):
    """The records page by page from a stored order: null keys, ties, every row once, no limit."""
    columns = [c for c in _WALK_KEYS if c != "copy"]
    df = clean.clean_columns(imports_raw(spark, sf_dir, "month", "country_description", "commodity_code", "unit_quantity"))
    df = df.withColumn("country_description", F.nullif("country_description", F.lit("Unknown"))).select(*columns)
    copies = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    df = copies.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy"))
    index = pages.build_page_index(df, scratch_path(spark, "pages"), _WALK_KEYS)
    size = index.row_count(spark) // 4 + 1
    return upsert.append_tables(*[index.page(spark, size, number).drop("row_number") for number in range(1, 5)])


_STORED = ", ".join(f"CAST({c} AS DECIMAL(20,2)) AS {c}" if c in schema.AMOUNTS else c for c in schema.IMPORTS_SCHEMA.names)


@query("S7 P12 P13", f" SELECT {_STORED} FROM cleaned", CLEAN_SQL)
def stored_table(spark, sf_dir):
    """A raw extract cleaned, written in month folders and read back, with its derived columns."""
    rows, many = refresh.clean_by_month(imports_raw(spark, sf_dir))
    return scan.cleaned(spark, sinks.write_cleaned(rows, scratch_path(spark, "store"), by_month=many))


@query(
    "S7",
    """ SELECT 'valuefob' AS column_name, count(valuefob) AS numbers, count(*) FILTER (valuefob = 'inf'::DOUBLE) AS lost_count FROM odd
    UNION ALL SELECT 'valuecif', count(valuecif), 0 FROM odd""",
    CLEAN_SQL
    + """, odd AS (SELECT valuecif, CASE WHEN unit_quantity = 'Tonnes' THEN 'inf'::DOUBLE ELSE valuefob END AS valuefob FROM records)""",
)
def lost_amounts(spark, sf_dir):
    """Cleaning keeps infinite amounts on purpose; the stored type can't, and this counts them."""
    df = clean.clean_records(imports_raw(spark, sf_dir, "valuefob", "valuecif", "unit_quantity"))
    odd = F.when(F.col("unit_quantity") == "Tonnes", float("inf")).otherwise(F.col("valuefob"))
    return schema.lost_amounts(df.withColumn("valuefob", odd))


@query(
    "S10",
    f""" SELECT {', '.join(scan.PREVIEW_COLUMNS)} FROM imports
    ORDER BY {', '.join(scan.PREVIEW_COLUMNS)} LIMIT 10""",
)
def record_preview(spark, sf_dir):
    return scan.preview(imports_fact(spark, sf_dir, *scan.PREVIEW_COLUMNS))


_DOCUMENT_SCHEMA = """
total_records bigint, total_value_fob double, total_value_cif double, total_weight double,
total_quantity double, date_range struct<min_year:int, max_year:int, years:array<int>>,
top_countries array<struct<country:string, value_cif:double>>,
top_commodities array<struct<commodity:string, value_cif:double>>,
top_ports array<struct<port:string, value_cif:double>>,
transport_modes map<string,double>, states map<string,double>"""


@query(
    "R19 A45 S8",
    f" SELECT section, member, valuecif FROM ({_summary_sql()}) WHERE section <> 'year'",
)
def summary_document(spark, sf_dir):
    """The JSON document written, read back and listed; years carry no value in it."""
    path = sinks.write_summary(
        reports.summary_statistics(imports_fact(spark, sf_dir, *SUMMARY_COLUMNS)),
        scratch_path(spark, "summary"),
    )
    document = spark.read.schema(_DOCUMENT_SCHEMA).json(path)
    lists = {
        "country_description": ("top_countries", "country"),
        "commodity_description": ("top_commodities", "commodity"),
        "ausport_description": ("top_ports", "port"),
    }
    parts = [
        document.select(F.lit(d).alias("section"), F.inline(c)).toDF("section", "member", "valuecif")
        for d, (c, _) in lists.items()
    ]
    for section, column in (("mode_description", "transport_modes"), ("state", "states")):
        parts.append(
            document.select(F.lit(section).alias("section"), F.explode(column)).toDF(
                "section", "member", "valuecif"
            )
        )
    return upsert.append_tables(*parts)


@query(
    "R19 S9",
    """, t AS (SELECT count(*) AS n, min(year) AS a, max(year) AS b, sum(valuefob)::DOUBLE / 1e9 AS f,
      sum(valuecif)::DOUBLE / 1e9 AS c, sum(weight) / 1e6 AS w FROM imports),
    k AS (SELECT country_description AS k, sum(valuecif)::DOUBLE / 1e9 AS v,
      row_number() OVER (ORDER BY sum(valuecif) DESC, country_description) AS rn FROM imports GROUP BY 1)
    SELECT format('Total Records: {:,}', n) AS line FROM t
    UNION ALL SELECT printf('  Years: %d - %d', a, b) FROM t
    UNION ALL SELECT printf('  FOB Value: $%.2f Billion AUD', f) FROM t
    UNION ALL SELECT printf('  CIF Value: $%.2f Billion AUD', c) FROM t
    UNION ALL SELECT printf('  Total Weight: %.2f Million Tonnes', w) FROM t
    UNION ALL SELECT printf('  %d. %s: $%.2fB', rn, k, v) FROM k WHERE rn <= 5
    UNION ALL SELECT unnest(['============================================================', 'DATA ANALYSIS SUMMARY REPORT',
      '============================================================', '', '', 'Date Range:', '', 'Total Values:', '',
      'Top 5 Countries by CIF Value:'])""",
)
def report_text(spark, sf_dir):
    """The whole text report for five countries, written as a file and read back."""
    path = sinks.write_report(
        reports.summary_statistics(imports_fact(spark, sf_dir, *SUMMARY_COLUMNS)),
        scratch_path(spark, "report"),
        top_countries=5,
    )
    return spark.read.text(path).withColumnRenamed("value", "line")


# ---------------------------------------------------------------- sets and increments


@query(
    "U1 U2",
    """ SELECT year, valuecif::DOUBLE AS valuecif, NULL::DOUBLE AS weight FROM imports WHERE year < 2023
    UNION ALL SELECT year, valuecif::DOUBLE, weight FROM imports WHERE year >= 2023
    UNION ALL SELECT year, valuecif::DOUBLE, weight FROM imports WHERE year >= 2023""",
)
def appended_tables(spark, sf_dir):
    """A table without weights, then two of one schema: nothing is merged away."""
    df = imports_fact(spark, sf_dir, "year", "valuecif", "weight")
    df = df.withColumn("valuecif", F.col("valuecif").cast("double"))
    late = df.where("year >= 2023")
    return upsert.append_tables(df.where("year < 2023").drop("weight"), late, late)


# The batch restates the second half of 2024 and brings 2025; CIF values are doubled.
_IN_BATCH = "(year = 2025 OR (year = 2024 AND month_number > 6))"


def _batch(df):
    return df.where(_IN_BATCH).withColumn(
        "valuecif", (F.col("valuecif") * 2).cast("decimal(20,2)")
    )


def _merged_sql(keys) -> str:
    ties = ", ".join(f"{c} DESC NULLS LAST" for c in FACT_COLUMNS if c not in keys)
    return f""", base AS (SELECT *, 0 AS b FROM imports WHERE year < 2025),
    batch AS (SELECT * REPLACE (CAST(valuecif * 2 AS DECIMAL(20,2)) AS valuecif), 1 AS b FROM imports
      WHERE {_IN_BATCH}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY b DESC, {ties}) AS rn
      FROM (SELECT * FROM base UNION ALL SELECT * FROM batch))
    SELECT {', '.join(FACT_COLUMNS)} FROM ranked WHERE rn = 1"""


@query("U4", _merged_sql(schema.SHORT_KEY))
def newest_by_short_key(spark, sf_dir):
    df = imports_fact(spark, sf_dir)
    return upsert.merged(df.where("year < 2025"), _batch(df), schema.SHORT_KEY)


@query("R20 I1", _merged_sql(schema.GRAIN))
def incremental_upsert(spark, sf_dir):
    """The table up to 2024, then the batch; only the touched months are rewritten."""
    df, store = stored(imports_fact(spark, sf_dir), "records", **SMALL), scratch_path(spark, "store")
    upsert.upsert(spark, store, df.where("year < 2025"), in_files=True)
    upsert.upsert(spark, store, _batch(df), in_files=True)
    return spark.read.parquet(store)


def _drops(df, folder):
    """Two arrivals of files: the table up to 2024, then the restating batch."""
    df.where("year < 2025").write.options(**SMALL).parquet(f"{folder}/first")
    _batch(df).write.options(**SMALL).parquet(f"{folder}/second")


@query(
    "R1 R20",
    f""", ranked AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(schema.GRAIN)} ORDER BY
      {', '.join(f"{c} DESC NULLS LAST" for c in schema.IMPORTS_SCHEMA.names if c not in schema.GRAIN)}) AS rn
      FROM (SELECT {_STORED} FROM cleaned WHERE year IN (2024, 2025)))
    SELECT year, count(*) AS records, sum(valuefob)::DOUBLE AS valuefob, sum(valuecif)::DOUBLE AS valuecif
    FROM ranked WHERE rn = 1 GROUP BY 1""",
    CLEAN_SQL,
)
def refreshed_store(spark, sf_dir):
    """A raw extract of two years through the whole refresh."""
    store = scratch_path(spark, "store")
    refresh.refresh(spark, raw(spark, sf_dir), store, years=[2024, 2025])
    grouped = spark.read.parquet(store).groupBy("year")
    return grouped.agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("valuefob").cast("double").alias("valuefob"),
        F.sum("valuecif").cast("double").alias("valuecif"),
    )


def _refreshed_sql(first: str, second: str, rebuild: bool = False) -> str:
    """Two raw extracts, as conditions on month and year, of which the second doubles its CIF values."""
    columns = [c for c in schema.IMPORTS_SCHEMA.names if c not in ("value_per_tonne_cif", "insurance_freight_cost")]
    ties = ", ".join(f"{c} DESC NULLS LAST" for c in schema.IMPORTS_SCHEMA.names if c not in schema.GRAIN)
    held = f"SELECT {_STORED}, 0 AS b FROM cleaned WHERE {first} UNION ALL " if not rebuild else ""
    return f""", second AS (SELECT DISTINCT * REPLACE (valuecif * 2 AS valuecif, valuecif * 2 / nullif(weight, 0) AS value_per_tonne_cif,
      greatest(valuecif * 2 - valuefob, 0.0) AS insurance_freight_cost) FROM cleaned WHERE {second}),
    both_extracts AS ({held}SELECT {_STORED}, 1 AS b FROM second),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(schema.GRAIN)} ORDER BY b DESC, {ties}) AS rn
      FROM both_extracts)
    SELECT year, month_number, count(*) AS records, sum(valuefob)::DOUBLE AS valuefob, sum(valuecif)::DOUBLE AS valuecif,
      count(DISTINCT ({', '.join(schema.GRAIN)})) AS distinct_keys FROM ranked WHERE rn = 1 GROUP BY 1, 2"""


def _refreshed(spark, sf_dir, first: str, second: str, **options):
    df, store = _stored_raw(spark, sf_dir), scratch_path(spark, "store")
    dated = clean.split_month(df.withColumn("r", F.struct(*df.columns)))
    refresh.refresh(spark, dated.where(first).select("r.*"), store)
    doubled = dated.where(second).select("r.*").withColumn("valuecif", (F.col("valuecif").cast("decimal(20,2)") * 2).cast("string"))
    refresh.refresh(spark, doubled, store, **options)
    return _store_months(spark, store)


def _store_months(spark, store):
    """Records, sums and different keys of each month; only rows whose key occurs again are shuffled to count it."""
    alone, others = duplicates.split_repeated(spark.read.parquet(store), schema.GRAIN)
    sums = [F.count(F.lit(1)).alias("records"), F.sum("valuefob").alias("valuefob"), F.sum("valuecif").alias("valuecif")]
    months = alone.groupBy("year", "month_number").agg(*sums, F.count(F.lit(1)).alias("distinct_keys"))
    keys = F.count_distinct(F.struct(*schema.GRAIN)).alias("distinct_keys")
    both = months.unionByName(others.groupBy("year", "month_number").agg(*sums, keys))
    return both.groupBy("year", "month_number").agg(
        F.sum("records").alias("records"),
        F.sum("valuefob").cast("double").alias("valuefob"),
        F.sum("valuecif").cast("double").alias("valuecif"),
        F.sum("distinct_keys").alias("distinct_keys"),
    )


_BUT_LATE = "NOT (year = 2025 AND month_number IN (4, 9)) OR month_number IS NULL"
_LATE = "year = 2025 AND month_number IN (3, 4)"


@query("R20 I1 I3", _refreshed_sql(_BUT_LATE, _LATE), CLEAN_SQL)
def refreshed_restated(spark, sf_dir):
    """The second extract restates a month and brings a late one, and nothing newer than the store holds."""
    return _refreshed(spark, sf_dir, _BUT_LATE, _LATE)


@query("R20 I1 I4", _refreshed_sql("year < 2025", "year = 2025 AND month_number = 7"), CLEAN_SQL)
def refreshed_short_extract(spark, sf_dir):
    """An extract of one month: all history stays."""
    return _refreshed(spark, sf_dir, "year < 2025", "year = 2025 AND month_number = 7")


@query("R20", _refreshed_sql("year < 2025", "year >= 2024", rebuild=True), CLEAN_SQL)
def refreshed_rebuild(spark, sf_dir):
    """Replaced by the second extract, as asked for."""
    return _refreshed(spark, sf_dir, "year < 2025", "year >= 2024", rebuild=True)


@query("R20 I1 U4", _refreshed_sql("year < 2025", "year = 2025 AND month_number = 1"), CLEAN_SQL)
def refreshed_unique(spark, sf_dir):
    """A store written elsewhere holds keys twice; a merge that touches other months leaves no key twice."""
    df, store = _stored_raw(spark, sf_dir), scratch_path(spark, "store")
    dated = clean.split_month(df.withColumn("r", F.struct(*df.columns)))
    old, many = refresh.clean_by_month(dated.where("year < 2025").select("r.*"))
    sinks.write_cleaned(old, store, by_month=many)
    new = dated.where("year = 2025 AND month_number = 1").select("r.*")
    new = new.withColumn("valuecif", (F.col("valuecif").cast("decimal(20,2)") * 2).cast("string"))
    refresh.refresh(spark, new, store)
    return _store_months(spark, store)


@query("R20 I1", _merged_sql(schema.GRAIN))
def streamed_upsert(spark, sf_dir):
    """The same through a file stream run once per arrival, with one checkpoint."""
    df, root = imports_fact(spark, sf_dir), scratch_path(spark, "stream")
    for arrival in (df.where("year < 2025"), _batch(df)):  # each joins its own lines only
        arrival.write.mode("append").options(**SMALL).parquet(f"{root}/incoming")
        upsert.upsert_stream(
            spark, f"{root}/incoming", arrival.schema, f"{root}/store", f"{root}/checkpoint"
        ).awaitTermination()
    return spark.read.parquet(f"{root}/store")


@query(
    "I2",
    """ SELECT count(*) AS total_records, sum(valuefob)::DOUBLE AS total_valuefob,
    sum(valuecif)::DOUBLE AS total_valuecif, round(sum(weight), 4) AS total_weight,
    round(sum(quantity), 4) AS total_quantity FROM imports""",
)
def streamed_totals(spark, sf_dir):
    root = scratch_path(spark, "totals")
    df = imports_fact(spark, sf_dir, "year", *MEASURES)
    for arrival in ("year < 2024", "year >= 2024"):
        df.where(arrival).write.mode("append").parquet(f"{root}/incoming")
        totals.totals_stream(
            spark, f"{root}/incoming", df.schema, f"{root}/totals", f"{root}/checkpoint"
        ).awaitTermination()
    return rounded(spark.read.parquet(f"{root}/totals"), total_weight=4, total_quantity=4)


@query(
    "I3",
    """ SELECT (SELECT max(make_date(year, month_number, 1)) FROM imports WHERE year < 2025) AS newest_held,
    max(make_date(year, month_number, 1)) AS newest_offered,
    max(make_date(year, month_number, 1)) >
      (SELECT max(make_date(year, month_number, 1)) FROM imports WHERE year < 2025) AS has_new_data
    FROM imports""",
)
def freshness(spark, sf_dir):
    df = imports_fact(spark, sf_dir, "year", "month_number")
    return upsert.freshness(df.where("year < 2025"), df)


@query("I4", " SELECT count(*) AS total_rows, count(*) >= 3000000 AS is_complete FROM imports")
def completeness(spark, sf_dir):
    return upsert.completeness(imports_fact(spark, sf_dir, "year"))
