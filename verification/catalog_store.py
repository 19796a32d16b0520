"""Queries on kept stores: crashes, restated records, stored aggregates and what the reports take from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolens.operators import aggregates, clean, concentration, duplicates, matrix, profile, quality, sampling, sketches, trends
from cargolens.plans import refresh, reports
from cargolens.schema import GRAIN, RAW_COLUMNS, TEXT_COLUMNS
from cargolens.sources import pages, scan, sinks
from cargolens.storage import SMALL, path_exists, remove_path, scratch_path, stored
from cargolens.streaming import rollups, totals, upsert

from .catalog import CONC_DIGITS, COUNTRY, COVERS, ITEM, IV_DIGITS, ORACLES, QUERIES, SCORED_DIGITS, SUPPLIER_DIGITS, longs, query, rounded
from .catalog_tables import _batch, _drops, _merged_sql, _refreshed_sql, _store_months, _stored_raw, raw
from .imports_view import CLEAN_SQL, FACT_COLUMNS, FACT_SQL, RAW_SQL, imports_fact, number_sql

# ---------------------------------------------------------------- crashes and restated records

_RESTATED = "(year = 2024 AND month_number > 10) OR (year = 2025 AND month_number < 3)"


@query("I1 R20", _refreshed_sql("year < 2025", _RESTATED), CLEAN_SQL)
def refreshed_after_crash(spark, sf_dir):
    """A refresh that dies after it deleted the first month's files; the next one ends up as if it had not."""
    df, store = _stored_raw(spark, sf_dir), scratch_path(spark, "store")
    dated = clean.split_month(df.withColumn("r", F.struct(*df.columns)))
    refresh.refresh(spark, dated.where("year < 2025").select("r.*"), store)
    new = dated.where(_RESTATED).select("r.*")
    new = new.withColumn("valuecif", (F.col("valuecif").cast("decimal(20,2)") * 2).cast("string"))
    upsert.prepare(spark, store, refresh.clean_for_store(new), whole=True)
    remove_path(spark, f"{store}/year=2024/month_number=11")
    refresh.refresh(spark, new, store)
    return _store_months(spark, store)


_TOTALS = """ count(*) AS total_records, sum(valuefob)::DOUBLE AS total_valuefob, sum(valuecif)::DOUBLE AS total_valuecif,
    round(sum(weight), 4) AS total_weight, round(sum(quantity), 4) AS total_quantity,
    round(sum(valuefob)::DOUBLE / count(valuefob), 4) AS mean_valuefob, round(avg(weight), 6) AS mean_weight"""


# The store after the second arrival, which restates half a year and brings another.
_HEAD, _ROWS = _merged_sql(GRAIN).rsplit("SELECT", 1)
_MERGED = f"{_HEAD}, kept AS (SELECT{_ROWS}) SELECT"


@query("I2 A1", f"{_MERGED}{_TOTALS} FROM kept")
def restated_totals(spark, sf_dir):
    """Totals of two arrivals that overlap, after each file: nothing counts twice."""
    root = scratch_path(spark, "totals")
    _drops(stored(imports_fact(spark, sf_dir), "records", **SMALL), f"{root}/arrivals")
    for arrival in ("first", "second", "second"):
        files = spark.read.parquet(f"{root}/arrivals/{arrival}")
        files.write.mode("append").options(**SMALL).parquet(f"{root}/incoming")
        totals.store_totals_stream(
            spark, f"{root}/incoming", files.schema, f"{root}/store", f"{root}/totals", f"{root}/checkpoint"
        ).awaitTermination()
    digits = {"total_weight": 4, "total_quantity": 4, "mean_valuefob": 4, "mean_weight": 6}
    return rounded(spark.read.parquet(f"{root}/totals"), **digits)


@query(
    "I2 R5",
    f"""{_MERGED} country_description, sum(valuecif)::DOUBLE AS valuecif, round(sum(weight), 4) AS weight,
    count(*) AS record_count FROM kept GROUP BY 1""",
)
def restated_countries(spark, sf_dir):
    """The same for a report: countries from the aggregates that a refreshed store keeps."""
    df, store = stored(imports_fact(spark, sf_dir), "records", **SMALL), scratch_path(spark, "store")
    upsert.upsert(spark, store, df.where("year < 2025"), rollups=True, in_files=True)
    upsert.upsert(spark, store, _batch(df), in_files=True)
    held = rollups.covering(spark, rollups.rollups_of(store), COUNTRY)
    return rounded(aggregates.doubles(aggregates.group_totals(held, COUNTRY, ("valuecif", "weight"))), weight=4)


# ---------------------------------------------------------------- reports from stored aggregates

_BUILT: dict[tuple[str, str], str] = {}


def _rollups(spark, sf_dir):
    """Aggregates of the whole fact table, made once for a session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT or not path_exists(spark, f"{_BUILT[key]}/months"):
        _BUILT[key] = scratch_path(spark, "rollups")
        rollups.build_rollups(imports_fact(spark, sf_dir), _BUILT[key], scratch_path(spark, "cuboids"))
    return _BUILT[key]


def from_rollups(of: str, *columns: str):
    """Register a report as ``rolled_up_<query>``: from the smallest stored aggregate, with the SQL of the query over records."""

    def register(report):
        def run(spark, sf_dir):
            return report(rollups.covering(spark, _rollups(spark, sf_dir), *columns))

        QUERIES[f"rolled_up_{of}"], ORACLES[f"rolled_up_{of}"], COVERS[f"rolled_up_{of}"] = run, ORACLES[of], COVERS[of]
        return run

    return register


@from_rollups("overview")
def _overview(df):
    return rounded(reports.overview(df), weight_millions=9)


@from_rollups("monthly_trends")
def _monthly(df):
    return rounded(trends.monthly_series(df), weight=4, quantity=4)


@from_rollups("yearly_growth")
def _growth(df):
    growth = trends.yearly_growth(trends.yearly_series(df.where(F.col("year").isin(2024, 2025))))
    return rounded(growth, first_value=2, second_value=2, growth_pct=6)


@from_rollups("seasonality")
def _seasonality(df):
    return rounded(trends.seasonal_means(df), valuefob=4, valuecif=4, weight=6, quantity=6)


@from_rollups("country_profile", COUNTRY)
def _countries(df):
    return rounded(reports.country_profile(df), weight=4, quantity=4, valuecif_pct=6, cumulative_pct=6)


@from_rollups("commodity_profile", ITEM)
def _commodities(df):
    return rounded(reports.commodity_profile(df), weight=4, quantity=4, valuecif_pct=6, cumulative_pct=6)


@from_rollups("states", "state")
def _states(df):
    return rounded(reports.states(df), weight=4, valuecif_pct=6)


@from_rollups("transport_modes", "mode_description")
def _modes(df):
    digits = {"weight": 4, "quantity": 4, "valuefob_pct": 6, "weight_pct": 6, "avg_value_per_tonne": 4}
    return rounded(reports.transport_modes(df), **digits)


@from_rollups("industry_sectors", "commodity_code", ITEM)
def _sectors(df):
    return rounded(reports.industry_sectors(df), weight=4, valuecif_pct=6)


@from_rollups("market_quadrants", "commodity_code")
def _quadrants(df):
    return longs(rounded(reports.quadrant_ranks(reports.market_quadrants(df)), **IV_DIGITS), "rank")


@from_rollups("concentration_risk", ITEM, COUNTRY)
def _concentration(df):
    return rounded(concentration.concentration(df), **CONC_DIGITS)


@from_rollups("supplier_trends", COUNTRY)
def _suppliers(df):
    return rounded(trends.supplier_trends(df), **SUPPLIER_DIGITS)


@from_rollups("commodity_dependence", ITEM)
def _dependence(df):
    return rounded(concentration.dependence(df, cumulative="name"), weight=4, dependence_pct=6, cumulative_pct=6)


@from_rollups("combined_risk", ITEM, COUNTRY)
def _combined(df):
    return rounded(concentration.combined_risk(df), **SCORED_DIGITS)


@from_rollups("commodity_trends", ITEM)
def _commodity_trends(df):
    return rounded(trends.commodity_trends(df), weight_2024=4, weight_2025=4, growth_rate_pct=6)


@from_rollups("port_concentration", "ausport_description", COUNTRY)
def _ports(df):
    return rounded(matrix.port_concentration(df), total_value=2)


@query("R18 T7 W5", ORACLES["key_insights"].removeprefix(f"WITH {FACT_SQL}"))
def rolled_up_key_insights(spark, sf_dir):
    """Each dimension from its own stored aggregate."""
    members = rollups.dimension_members(spark, _rollups(spark, sf_dir), [*reports.INSIGHTS, "year"], ("valuecif", "valuefob"))
    return rounded(reports.key_insights(None, (2024, 2025), members), pct=6)


@query("R19 A45", ORACLES["summary_members"].removeprefix(f"WITH {FACT_SQL}"))
def rolled_up_summary_members(spark, sf_dir):
    members = rollups.dimension_members(spark, _rollups(spark, sf_dir), reports.summary_dimensions(), ("valuecif",))
    return longs(reports.summary_members(None, members=members), "rank")


# ---------------------------------------------------------------- quality from one scan

_NUMBERS = ("weight", "valuefob", "valuecif", "quantity")


def _quality_sql() -> str:
    parts = ["SELECT 'shape' AS profile, NULL AS subject, NULL AS member, 'total_rows' AS metric, count(*)::DOUBLE AS value FROM raw"]
    parts.append(f"SELECT 'shape', 'string', NULL, 'column_count', {len(RAW_COLUMNS)}::DOUBLE")
    parts += [f"SELECT 'missing', '{c}', NULL, 'missing_count', count(*) - count({c}) FROM raw HAVING count(*) > count({c})" for c in RAW_COLUMNS]
    for c in _NUMBERS:
        numbers = f"FROM (SELECT {number_sql(c)} AS n FROM raw)"
        parts += [
            f"SELECT 'numeric', '{c}', NULL, 'missing_count', count(*) - count(n) {numbers}",
            f"SELECT 'numeric', '{c}', NULL, 'negative_count', count(*) FILTER (n < 0) {numbers}",
            f"SELECT 'numeric', '{c}', NULL, 'min_value', min(greatest(coalesce(n, 0), 0)) {numbers}",
            f"SELECT 'numeric', '{c}', NULL, 'max_value', max(greatest(coalesce(n, 0), 0)) {numbers}",
            f"SELECT 'numeric', '{c}', NULL, 'mean_value', round(avg(greatest(coalesce(n, 0), 0)), 3) {numbers}",
        ]
    weights = f"FROM (SELECT {number_sql('weight')} AS n FROM raw)"
    measures = {"min_weight": "min(n)", "max_weight": "max(n)", "mean_weight": "round(avg(n), 3)", "median_weight": "round(median(n), 3)"}
    measures |= {"below_1": "count(*) FILTER (n < 1)", "below_0_1": "count(*) FILTER (n < 0.1)"}
    measures |= {"below_0_001": "count(*) FILTER (n < 0.001)", "above_1000": "count(*) FILTER (n > 1000)"}
    parts += [f"SELECT 'weights', 'weight', NULL, '{k}', {v} {weights}" for k, v in measures.items()]
    quantities = f"FROM (SELECT unit_quantity, {number_sql('quantity')} AS n FROM raw)"
    parts.append(f"SELECT 'non_positive', 'quantity', NULL, 'non_positive_rows', count(*) FILTER (n <= 0) {quantities}")
    measures = {"record_count": "count(*)", "min_quantity": "min(n)", "max_quantity": "max(n)"}
    measures |= {"mean_quantity": "round(avg(n), 3)", "median_quantity": "round(median(n), 3)"}
    own = f"{quantities} WHERE unit_quantity IS NOT NULL"
    parts += [f"SELECT 'units', 'unit_quantity', unit_quantity, '{k}', {v} {own} GROUP BY 3" for k, v in measures.items()]
    parts.append(
        f"SELECT 'fractions', 'unit_quantity', unit_quantity, 'fractional_count', count(*) FILTER (n % 1 <> 0) {quantities} "
        "WHERE unit_quantity ILIKE '%number%' GROUP BY 3"
    )
    parts.append(
        "SELECT 'variants', base, unit_quantity, 'spellings', n FROM (SELECT *, count(*) OVER (PARTITION BY base) AS n FROM "
        "(SELECT DISTINCT unit_quantity, trim(lower(unit_quantity)) AS base FROM raw WHERE unit_quantity IS NOT NULL)) WHERE n > 1"
    )
    parts.append(
        f"SELECT 'duplicates', NULL, NULL, 'duplicate_rows', sum(n - 1) FROM (SELECT count(*) AS n FROM raw GROUP BY {', '.join(RAW_COLUMNS)})"
    )
    for c in TEXT_COLUMNS:
        parts.append(f"SELECT 'cardinality', '{c}', NULL, 'distinct_values', count(DISTINCT {c}) FROM raw")
        parts.append(f"SELECT 'values', '{c}', {c}, 'row_count', count(*) FROM raw WHERE {c} IS NOT NULL GROUP BY 3")
    return " " + " UNION ALL ".join(parts)


@query("R2 A29 A30 A31 A32 A33 A34 A35 A36 A37 A38 A46", _quality_sql(), RAW_SQL)
def quality_profile(spark, sf_dir):
    """All quality numbers of the raw records, from one scan of them."""
    found = profile.quality_profile(raw(spark, sf_dir)).table()
    inexact = F.col("metric").startswith("mean") | F.col("metric").startswith("median")
    return found.withColumn("value", F.when(inexact, F.round("value", 3)).otherwise(F.col("value")))


# ---------------------------------------------------------------- estimates, on request

_PERCENTS = (1, 10, 25, 50, 75, 90, 99)
_SKETCHED = ("valuecif", "weight")


@query(
    "A26 A27",
    " "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {p}::DOUBLE AS percentile, count({c}) AS row_count, TRUE AS within_bound FROM imports"
        for c in _SKETCHED
        for p in _PERCENTS
    ),
)
def sketch_accuracy(spark, sf_dir):
    """Percentiles from merged monthly sketches: the exact rank of each value is within the stated bound of the percentile."""
    df = imports_fact(spark, sf_dir, "year", "month_number", *_SKETCHED)
    monthly = stored(sketches.sketched(df, _SKETCHED), "sketches")
    parts = []
    for c in _SKETCHED:
        points = sketches.points(sketches.merged(monthly, _SKETCHED), c, _PERCENTS)
        ranks = sketches.rank_range(df, c, points)
        rank, bound = F.col("percentile") / 100, sketches.rank_error()
        off = F.greatest(F.col("below") - rank, rank - F.col("upto"), F.lit(0.0))
        parts.append(ranks.select(F.lit(c).alias("column_name"), "percentile", "row_count", (off <= bound).alias("within_bound")))
    return upsert.append_tables(*parts)


@query(
    "A33",
    " "
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values, TRUE AS within_bound FROM imports" for c in (COUNTRY, ITEM)),
)
def distinct_accuracy(spark, sf_dir):
    """Numbers of different values from merged monthly sketches, held against the exact ones."""
    df = imports_fact(spark, sf_dir, "year", "month_number", COUNTRY, ITEM)
    whole = sketches.merged(stored(sketches.sketched(df, [], texts=(COUNTRY, ITEM)), "sketches"), [], texts=(COUNTRY, ITEM))
    estimates = whole.select(*[sketches.distinct(whole, c).alias(c) for c in (COUNTRY, ITEM)])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("estimate")) for c in (COUNTRY, ITEM)]
    exact = quality.cardinality_profile(df, (COUNTRY, ITEM))
    off = F.abs(F.col("estimate") - F.col("distinct_values")) <= sketches.distinct_error() * F.col("distinct_values")
    return exact.join(estimates.select(F.inline(F.array(*pairs))), "column_name").select("column_name", "distinct_values", off.alias("within_bound"))


_KEY = ", ".join(sampling.KEYS)


@query(
    "A44",
    f""", chosen AS (SELECT * FROM imports WHERE ('0x' || substr(md5(concat_ws('|', '0', {_KEY})), 1, 8))::BIGINT < 429496729),
    each AS (SELECT state, {_KEY}, count(*)::DOUBLE AS n, sum(valuecif)::DOUBLE AS v FROM chosen GROUP BY ALL),
    sums AS (SELECT state, sum(n)::BIGINT AS sampled_records, count(*) AS sampled_keys, sum(n) AS n, sum(v) AS v,
      sqrt(sum(n * n) * (1 - 0.1::DOUBLE) / 0.1::DOUBLE ** 2) AS en, sqrt(sum(v * v) * (1 - 0.1::DOUBLE) / 0.1::DOUBLE ** 2) AS ev FROM each GROUP BY 1)
    SELECT state, sampled_records, sampled_keys, round(n / 0.1::DOUBLE, 3) AS records_estimate, round(n / 0.1::DOUBLE - 3.29 * en, 3) AS records_low,
      round(n / 0.1::DOUBLE + 3.29 * en, 3) AS records_high, round(v / 0.1::DOUBLE, 2) AS valuecif_estimate,
      round(v / 0.1::DOUBLE - 3.29 * ev, 0) AS valuecif_low, round(v / 0.1::DOUBLE + 3.29 * ev, 0) AS valuecif_high,
      (SELECT sum(valuecif)::DOUBLE FROM imports i WHERE i.state = sums.state) BETWEEN valuecif_low AND valuecif_high AS holds_exact
    FROM sums""",
)
def sampled_totals(spark, sf_dir):
    """States estimated from a tenth of the keys, and whether the exact value lies inside the bounds."""
    df = imports_fact(spark, sf_dir, "state", "valuecif", *sampling.KEYS)
    found = sampling.sampled_totals(df, 0.1, ("state",))
    digits = {f"{n}_{p}": d for n, d in (("records", 3), ("valuecif", 0)) for p in ("estimate", "low", "high")}
    digits["valuecif_estimate"] = 2
    exact = aggregates.doubles(aggregates.group_totals(df, "state", ["valuecif"], None))
    both = rounded(found, **digits).join(exact, "state")
    return both.withColumn("holds_exact", F.col("valuecif").between(F.col("valuecif_low"), F.col("valuecif_high"))).drop("valuecif")


# ---------------------------------------------------------------- pages from a stored order, answers from file names and footers

_EVERY_KEY = (*scan.PAGE_KEYS, *[c for c in FACT_COLUMNS if c not in scan.PAGE_KEYS])


@query(
    "S5",
    f""", numbered AS (SELECT *, row_number() OVER (ORDER BY {', '.join(_EVERY_KEY)}) AS row_number FROM imports)
    SELECT * FROM numbered WHERE row_number BETWEEN 201 AND 300 OR row_number BETWEEN 40001 AND 40100 OR row_number > 59950""",
)
def indexed_pages(spark, sf_dir):
    """A page near the start, one far behind and the last rows, each from the blocks it lies in."""
    index = pages.build_page_index(imports_fact(spark, sf_dir), scratch_path(spark, "pages"), _EVERY_KEY)
    end = index.rows_between(spark, 59_951, max(59_951, index.row_count(spark)))
    return upsert.append_tables(index.page(spark, 100, 3), index.page(spark, 100, 401), end)


@query(
    "I3",
    """ SELECT max(make_date(year, month_number, 1)) AS newest_offered,
    (SELECT max(make_date(year, month_number, 1)) FROM imports WHERE year < 2025) AS newest_held,
    max(make_date(year, month_number, 1)) >
      (SELECT max(make_date(year, month_number, 1)) FROM imports WHERE year < 2025) AS has_new_data FROM imports""",
)
def store_freshness(spark, sf_dir):
    """The newest months of two stores by their folders' names."""
    df, root = imports_fact(spark, sf_dir), scratch_path(spark, "stores")
    offered = scan.cleaned(spark, sinks.write_cleaned(df, f"{root}/offered"))
    sinks.write_cleaned(offered.where("year < 2025"), f"{root}/held", by_month=True)
    return upsert.store_freshness(spark, f"{root}/held", f"{root}/offered")


@query("I4", " SELECT count(*) AS total_rows, count(*) >= 50000 AS is_complete FROM imports")
def store_completeness(spark, sf_dir):
    """Rows of a store by its files' footers."""
    store = scratch_path(spark, "store")
    sinks.write_cleaned(imports_fact(spark, sf_dir), store)
    return upsert.completeness(spark.read.parquet(store), 50_000)


# ---------------------------------------------------------------- equal rows of stored tables


@query("U3", " SELECT DISTINCT * FROM raw", RAW_SQL)
def distinct_stored_rows(spark, sf_dir):
    return duplicates.distinct_stored(_stored_raw(spark, sf_dir))


@query(
    "R2 A31",
    f""", d AS (SELECT count(*) AS n FROM raw GROUP BY {', '.join(RAW_COLUMNS)})
    SELECT sum(n)::BIGINT AS total_rows, sum(n - 1)::BIGINT AS duplicate_rows,
      round(sum(n - 1)::DOUBLE / sum(n)::DOUBLE * 100, 6) AS duplicate_pct FROM d""",
    RAW_SQL,
)
def stored_duplicates(spark, sf_dir):
    return rounded(duplicates.duplicates_stored(_stored_raw(spark, sf_dir)), duplicate_pct=6)
