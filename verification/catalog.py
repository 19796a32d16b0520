"""One Spark query and one SQL text per operator family.

Sums of doubles depend on row order in the last bits, so such columns are rounded on
both sides. Money is summed as decimals and compared unrounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.functions.text import shorten
from cargolens.operators import aggregates, concentration, filters, matrix, percentiles, ranking, trends
from cargolens.operators import classify
from cargolens.plans import reports

from .imports_view import FACT_SQL, imports_fact

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}

PAIR = "(2024, 2025)"
MEASURES = ("valuefob", "valuecif", "weight", "quantity")


def query(covers: str, sql: str | None = None, head: str = FACT_SQL):
    """Register a query, the survey ids it covers and its SQL."""

    def register(function):
        name = function.__name__
        QUERIES[name] = function
        COVERS[name] = covers
        if sql is not None:
            ORACLES[name] = f"WITH {head}{sql}"
        return function

    return register


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), d) for c, d in digits.items()})


def longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def two_years(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    columns = columns if "year" in columns else (*columns, "year")
    return imports_fact(spark, sf_dir, *columns).where(F.col("year").isin(2024, 2025))


ITEM, COUNTRY = "commodity_description", "country_description"

# ---------------------------------------------------------------- concentration and dependence

CONC = f""",
pairs AS (
  SELECT commodity_description AS c, country_description AS k, sum(valuecif) AS v
  FROM imports GROUP BY 1, 2),
ranked AS (
  SELECT *, sum(v) OVER (PARTITION BY c) AS t,
    row_number() OVER (PARTITION BY c ORDER BY v DESC, k) AS rn FROM pairs),
shares AS (SELECT *, v::DOUBLE / nullif(t::DOUBLE, 0) * 100 AS s FROM ranked),
conc0 AS (
  SELECT c AS commodity_description, max(t)::DOUBLE AS total_value,
    coalesce(sum(s * s), 0) AS hhi_index, max(s) AS top_country_share,
    sum(CASE WHEN rn <= 3 THEN s END) AS top3_country_share,
    max(CASE WHEN rn = 1 THEN k END) AS top_country,
    max(t)::DOUBLE / 1e9 AS total_value_billions
  FROM shares GROUP BY c),
conc AS (
  SELECT *, CASE WHEN hhi_index >= 2500 OR top_country_share >= 50 THEN 'HIGH RISK'
    WHEN hhi_index >= 1500 OR top_country_share >= 40 THEN 'MEDIUM RISK'
    ELSE 'LOW RISK' END AS risk_level FROM conc0)"""

CONC_OUT = """commodity_description, total_value, round(hhi_index, 6) AS hhi_index,
  round(top_country_share, 6) AS top_country_share,
  round(top3_country_share, 6) AS top3_country_share, top_country, total_value_billions, risk_level"""
CONC_DIGITS = {"hhi_index": 6, "top_country_share": 6, "top3_country_share": 6}


@query("R9 A15 A16 A17 A18 A19 J1 J2 P16 P26 W7 W8", f"{CONC} SELECT {CONC_OUT} FROM conc")
def concentration_risk(spark, sf_dir):
    df = imports_fact(spark, sf_dir, ITEM, COUNTRY, "valuecif")
    return rounded(concentration.concentration(df), **CONC_DIGITS)


@query(
    "A15 W2 J1",
    f"""{CONC} SELECT c AS commodity_description, k AS country_description, v::DOUBLE AS valuecif,
    t::DOUBLE AS total_value, round(s, 6) AS country_share FROM shares""",
)
def supplier_shares(spark, sf_dir):
    df = imports_fact(spark, sf_dir, ITEM, COUNTRY, "valuecif")
    return rounded(aggregates.doubles(concentration.supplier_shares(df)), country_share=6)


@query(
    "P20 T1 W6",
    f"""{CONC} SELECT {CONC_OUT}, row_number() OVER (ORDER BY c2.hhi_index DESC, commodity_description) AS rank
    FROM (SELECT * FROM conc WHERE total_value_billions >= 1.0
          ORDER BY hhi_index DESC, commodity_description LIMIT 20) c2""",
)
def most_concentrated(spark, sf_dir):
    df = imports_fact(spark, sf_dir, ITEM, COUNTRY, "valuecif")
    top = concentration.most_concentrated(concentration.concentration(df))
    return longs(rounded(top, **CONC_DIGITS), "rank")


@query("A43", f"{CONC} SELECT risk_level, count(*) AS row_count FROM conc GROUP BY risk_level")
def risk_level_counts(spark, sf_dir):
    df = imports_fact(spark, sf_dir, ITEM, COUNTRY, "valuecif")
    return concentration.class_counts(concentration.concentration(df), "risk_level")


DEP = f""",
dep0 AS (
  SELECT commodity_description, sum(valuecif) AS v, sum(weight) AS weight, count(month) AS record_count
  FROM imports GROUP BY 1),
dep1 AS (
  SELECT *, v::DOUBLE / (SELECT sum(v) FROM dep0)::DOUBLE * 100 AS dependence_pct,
    sum(v) OVER (ORDER BY commodity_description)::DOUBLE / (SELECT sum(v) FROM dep0)::DOUBLE * 100 AS by_name,
    sum(v) OVER (ORDER BY v DESC, commodity_description ROWS UNBOUNDED PRECEDING)::DOUBLE
      / (SELECT sum(v) FROM dep0)::DOUBLE * 100 AS by_value,
    v::DOUBLE / 1e9 AS total_value_billions FROM dep0),
dep AS (
  SELECT *, CASE WHEN dependence_pct >= 5 OR total_value_billions >= 40 THEN 'CRITICAL'
    WHEN dependence_pct >= 2 OR total_value_billions >= 15 THEN 'HIGH'
    WHEN dependence_pct >= 0.5 OR total_value_billions >= 4 THEN 'MODERATE'
    ELSE 'LOW' END AS dependence_level FROM dep1)"""

DEP_COLUMNS = (ITEM, "valuecif", "weight", "month")


def _dep_sql(cumulative: str) -> str:
    return f"""{DEP} SELECT commodity_description, v::DOUBLE AS valuecif, round(weight, 4) AS weight,
      record_count, round(dependence_pct, 6) AS dependence_pct, round({cumulative}, 6) AS cumulative_pct,
      total_value_billions, dependence_level FROM dep"""


@query("R10 A20 W4 P27 J6", _dep_sql("by_name"))
def commodity_dependence(spark, sf_dir):
    df = imports_fact(spark, sf_dir, *DEP_COLUMNS)
    return rounded(
        concentration.dependence(df, cumulative="name"),
        weight=4, dependence_pct=6, cumulative_pct=6,
    )


@query("R10 A20 W3 P27", _dep_sql("by_value"))
def commodity_dependence_by_value(spark, sf_dir):
    df = imports_fact(spark, sf_dir, *DEP_COLUMNS)
    return rounded(
        concentration.dependence(df, cumulative="value"),
        weight=4, dependence_pct=6, cumulative_pct=6,
    )


@query(
    "R10 T1",
    f"""{DEP} SELECT commodity_description, v::DOUBLE AS valuecif, round(dependence_pct, 6) AS dependence_pct,
      dependence_level, row_number() OVER (ORDER BY d.dependence_pct DESC, commodity_description) AS rank
    FROM (SELECT * FROM dep WHERE dependence_level IN ('CRITICAL', 'HIGH')
          ORDER BY dependence_pct DESC, commodity_description LIMIT 20) d""",
)
def most_critical_commodities(spark, sf_dir):
    df = imports_fact(spark, sf_dir, ITEM, "valuecif")
    top = concentration.most_critical(concentration.dependence(df, details=False))
    top = top.select(ITEM, "valuecif", "dependence_pct", "dependence_level", "rank")
    return longs(rounded(top, dependence_pct=6), "rank")


@query("A43", f"{DEP} SELECT dependence_level, count(*) AS row_count FROM dep GROUP BY 1")
def dependence_level_counts(spark, sf_dir):
    df = imports_fact(spark, sf_dir, ITEM, "valuecif")
    return concentration.class_counts(
        concentration.dependence(df, details=False), "dependence_level"
    )


SCORED = f"""{CONC}{DEP},
risks AS (
  SELECT conc.*, dep.dependence_pct, dep.dependence_level,
    (CASE risk_level WHEN 'HIGH RISK' THEN 3 WHEN 'MEDIUM RISK' THEN 2 ELSE 1 END
     + CASE dependence_level WHEN 'CRITICAL' THEN 3 WHEN 'HIGH' THEN 2 WHEN 'MODERATE' THEN 1 ELSE 0 END
    ) / 6.0::DOUBLE * 10 AS combined_risk_score
  FROM conc JOIN dep USING (commodity_description)),
scored AS (
  SELECT *, CASE WHEN combined_risk_score >= 7.5 THEN 'EXTREME RISK'
    WHEN combined_risk_score >= 5 THEN 'HIGH RISK'
    WHEN combined_risk_score >= 3 THEN 'MODERATE RISK' ELSE 'LOW RISK' END AS overall_risk FROM risks)"""
SCORED_OUT = f"""{CONC_OUT}, round(dependence_pct, 6) AS dependence_pct, dependence_level,
  round(combined_risk_score, 6) AS combined_risk_score, overall_risk"""
SCORED_DIGITS = {**CONC_DIGITS, "dependence_pct": 6, "combined_risk_score": 6}


@query(
    "R11 P29 P20 T1",
    f"""{SCORED} SELECT {SCORED_OUT} FROM (SELECT * FROM scored WHERE total_value_billions >= 1.0
    ORDER BY combined_risk_score DESC, commodity_description LIMIT 20) t""",
)
def combined_risk(spark, sf_dir):
    df = imports_fact(spark, sf_dir, ITEM, COUNTRY, "valuecif")
    return rounded(concentration.combined_risk(df), **SCORED_DIGITS)


@query(
    "R11 J3 P29",
    f"{SCORED} SELECT {SCORED_OUT} FROM scored WHERE total_value_billions >= 0.01",
)
def combined_risk_by_join(spark, sf_dir):
    df = imports_fact(spark, sf_dir, *DEP_COLUMNS, COUNTRY)
    risks = concentration.join_risks(concentration.concentration(df), concentration.dependence(df))
    return rounded(concentration.scored(risks, 0.01), **SCORED_DIGITS)


# ---------------------------------------------------------------- profiles

SUMS = """sum(valuefob)::DOUBLE AS valuefob, sum(valuecif)::DOUBLE AS valuecif,
  round(sum(weight), 4) AS weight"""
SUMS4 = f"{SUMS}, round(sum(quantity), 4) AS quantity"


def _profile_sql(key: str) -> str:
    return f""",
    g AS (SELECT {key}, sum(valuefob) AS f, sum(valuecif) AS v, sum(weight) AS w, sum(quantity) AS q,
            count(month) AS record_count FROM imports GROUP BY 1)
    SELECT {key}, f::DOUBLE AS valuefob, v::DOUBLE AS valuecif, round(w, 4) AS weight,
      round(q, 4) AS quantity, record_count,
      round(v::DOUBLE / (SELECT sum(v) FROM g)::DOUBLE * 100, 6) AS valuecif_pct,
      round(sum(v) OVER (ORDER BY v DESC, {key} ROWS UNBOUNDED PRECEDING)::DOUBLE
        / (SELECT sum(v) FROM g)::DOUBLE * 100, 6) AS cumulative_pct FROM g"""


@query("R5 A5 W1 W3", _profile_sql("country_description"))
def country_profile(spark, sf_dir):
    df = reports.country_profile(imports_fact(spark, sf_dir, COUNTRY, *MEASURES, "month"))
    return rounded(df, weight=4, quantity=4, valuecif_pct=6, cumulative_pct=6)


@query("R6 A9 W1 W3", _profile_sql("commodity_description"))
def commodity_profile(spark, sf_dir):
    df = reports.commodity_profile(imports_fact(spark, sf_dir, ITEM, *MEASURES, "month"))
    return rounded(df, weight=4, quantity=4, valuecif_pct=6, cumulative_pct=6)


@query(
    "R5 A6",
    f" SELECT ausport_description, {SUMS}, count(month) AS record_count FROM imports GROUP BY 1",
)
def arrival_ports(spark, sf_dir):
    df = imports_fact(spark, sf_dir, "ausport_description", "valuefob", "valuecif", "weight", "month")
    return rounded(reports.arrival_ports(df), weight=4)


@query(
    "R5 A7",
    f" SELECT osport_description, {SUMS}, count(month) AS record_count FROM imports GROUP BY 1",
)
def origin_ports(spark, sf_dir):
    df = imports_fact(spark, sf_dir, "osport_description", "valuefob", "valuecif", "weight", "month")
    return rounded(reports.origin_ports(df), weight=4)


@query(
    "R5 A8 W1",
    f""" SELECT state, {SUMS}, count(month) AS record_count,
    round(sum(valuecif)::DOUBLE / (SELECT sum(valuecif) FROM imports)::DOUBLE * 100, 6) AS valuecif_pct
    FROM imports GROUP BY 1""",
)
def states(spark, sf_dir):
    df = imports_fact(spark, sf_dir, "state", "valuefob", "valuecif", "weight", "month")
    return rounded(reports.states(df), weight=4, valuecif_pct=6)


@query(
    "R14 A23 W1",
    f""" SELECT mode_description, {SUMS4}, count(month) AS record_count,
    round(sum(valuefob)::DOUBLE / (SELECT sum(valuefob) FROM imports)::DOUBLE * 100, 6) AS valuefob_pct,
    round(sum(weight) / (SELECT sum(weight) FROM imports) * 100, 6) AS weight_pct,
    round(sum(valuefob)::DOUBLE / nullif(sum(weight), 0), 4) AS avg_value_per_tonne
    FROM imports GROUP BY 1""",
)
def transport_modes(spark, sf_dir):
    df = reports.transport_modes(
        imports_fact(spark, sf_dir, "mode_description", *MEASURES, "month")
    )
    return rounded(
        df, weight=4, quantity=4, valuefob_pct=6, weight_pct=6, avg_value_per_tonne=4
    )


@query(
    "A1",
    """ SELECT count(*) AS total_records, sum(valuefob)::DOUBLE AS total_valuefob,
    sum(valuecif)::DOUBLE AS total_valuecif, round(sum(weight), 4) AS total_weight,
    round(sum(quantity), 4) AS total_quantity,
    round(sum(valuefob)::DOUBLE / count(valuefob), 6) AS mean_valuefob,
    round(sum(weight) / count(weight), 6) AS mean_weight FROM imports""",
)
def grand_totals(spark, sf_dir):
    df = aggregates.grand_totals(imports_fact(spark, sf_dir, *MEASURES))
    return rounded(df, total_weight=4, total_quantity=4, mean_valuefob=6, mean_weight=6)


@query(
    "A2",
    """ SELECT min(year) AS min_year, max(year) AS max_year,
    string_agg(DISTINCT year::VARCHAR, ',' ORDER BY year::VARCHAR) AS years FROM imports""",
)
def year_range(spark, sf_dir):
    df = aggregates.year_range(imports_fact(spark, sf_dir, "year"))
    return df.withColumn("years", F.array_join(F.col("years").cast("array<string>"), ","))


@query(
    "R4 A3 P14",
    f""" SELECT year, month_number, month, {SUMS4}, make_date(year, month_number, 1) AS date
    FROM imports GROUP BY 1, 2, 3""",
)
def monthly_trends(spark, sf_dir):
    df = imports_fact(spark, sf_dir, "year", "month_number", "month", *MEASURES)
    return rounded(trends.monthly_series(df), weight=4, quantity=4)


@query(
    "R4 A4",
    f" SELECT year, {SUMS4}, count(DISTINCT month) AS months FROM imports GROUP BY 1",
)
def yearly_series(spark, sf_dir):
    df = imports_fact(spark, sf_dir, "year", "month", *MEASURES)
    return rounded(trends.yearly_series(df), weight=4, quantity=4)


@query(
    "R4 A40 W5",
    f""",
    y AS (SELECT year, sum(valuefob)::DOUBLE AS valuefob, sum(valuecif)::DOUBLE AS valuecif,
            sum(weight) AS weight, sum(quantity) AS quantity
          FROM imports WHERE year IN {PAIR} GROUP BY 1),
    l AS (UNPIVOT y ON valuefob, valuecif, weight, quantity INTO NAME measure VALUE value)
    SELECT a.measure, a.year AS first_year, b.year AS second_year, round(a.value, 2) AS first_value,
      round(b.value, 2) AS second_value, round((b.value - a.value) / a.value * 100, 6) AS growth_pct
    FROM l a JOIN l b ON a.measure = b.measure AND a.year = 2024 AND b.year = 2025 WHERE a.value > 0""",
)
def yearly_growth(spark, sf_dir):
    df = two_years(spark, sf_dir, "year", "month", *MEASURES)
    growth = trends.yearly_growth(trends.yearly_series(df))
    return rounded(growth, first_value=2, second_value=2, growth_pct=6)


@query(
    "R17 A24 P15",
    """ SELECT month_number, round(sum(valuefob)::DOUBLE / count(valuefob), 4) AS valuefob,
    round(sum(valuecif)::DOUBLE / count(valuecif), 4) AS valuecif, round(avg(weight), 6) AS weight,
    round(avg(quantity), 6) AS quantity, substring(any_value(month), 1, 3) AS month_name
    FROM imports GROUP BY 1""",
)
def seasonality(spark, sf_dir):
    df = trends.seasonal_means(imports_fact(spark, sf_dir, "month_number", *MEASURES))
    return rounded(df, valuefob=4, valuecif=4, weight=6, quantity=6)


@query(
    "R3 A1 A2 P16",
    """ SELECT count(*) AS total_records, sum(valuefob)::DOUBLE / 1e9 AS fob_billions,
    sum(valuecif)::DOUBLE / 1e9 AS cif_billions, round(sum(weight) / 1e6, 9) AS weight_millions,
    min(year) AS min_year, max(year) AS max_year FROM imports""",
)
def overview(spark, sf_dir):
    df = imports_fact(spark, sf_dir, "valuefob", "valuecif", "weight", "year")
    return rounded(reports.overview(df), weight_millions=9)


@query(
    "R3 T1 P17",
    """,
    m AS (SELECT 'country_description' AS dimension, country_description AS member, sum(valuecif) AS v
          FROM imports GROUP BY 2
          UNION ALL SELECT 'commodity_description', commodity_description, sum(valuecif) FROM imports GROUP BY 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY v DESC, member) AS rank FROM m)
    SELECT dimension, rank, member,
      CASE WHEN length(member) > 12 THEN substring(member, 1, 12) || '...' ELSE member END AS label,
      v::DOUBLE / 1e9 AS value_billions FROM r WHERE rank <= 5""",
)
def overview_leaders(spark, sf_dir):
    df = imports_fact(spark, sf_dir, COUNTRY, ITEM, "valuecif")
    return longs(reports.overview_leaders(df, cut=12), "rank")


@query(
    "R6 T1 P17",
    """,
    g AS (SELECT commodity_description, sum(valuecif) AS c, sum(valuefob) AS f FROM imports GROUP BY 1
          ORDER BY 2 DESC, 1 LIMIT 10)
    SELECT row_number() OVER (ORDER BY c DESC, commodity_description) AS rank, commodity_description,
      CASE WHEN length(commodity_description) > 15 THEN substring(commodity_description, 1, 15) || '...'
        ELSE commodity_description END AS commodity_label,
      c::DOUBLE / 1e9 AS cif_billions, f::DOUBLE / 1e9 AS fob_billions FROM g""",
)
def cif_fob_comparison(spark, sf_dir):
    df = imports_fact(spark, sf_dir, ITEM, "valuecif", "valuefob")
    return longs(reports.cif_fob_comparison(df, cut=15), "rank")


@query(
    "T2",
    f" SELECT country_description, round(sum(weight), 4) AS weight, count(*) AS record_count FROM imports "
    "GROUP BY 1 ORDER BY round(sum(weight), 4) DESC, 1 LIMIT 15",
)
def heaviest_countries(spark, sf_dir):
    grouped = aggregates.group_totals(imports_fact(spark, sf_dir, COUNTRY, "weight"), COUNTRY)
    return ranking.top_k(rounded(grouped, weight=4), "weight", COUNTRY, 15)


@query(
    "W8 A13 A19",
    """, g AS (SELECT state, commodity_description AS c, sum(valuecif) AS v FROM imports GROUP BY 1, 2)
    SELECT state, c AS top_commodity FROM
      (SELECT *, row_number() OVER (PARTITION BY state ORDER BY v DESC, c) AS rn FROM g) WHERE rn = 1""",
)
def largest_commodity_of_state(spark, sf_dir):
    df = imports_fact(spark, sf_dir, "state", ITEM, "valuecif")
    pairs = aggregates.group_totals(df, ["state", ITEM], ["valuecif"], None)
    return ranking.largest_member(pairs, "state", ITEM, "valuecif", "top_commodity")


@query(
    "T3",
    " SELECT osport_description, sum(valuecif)::DOUBLE AS valuecif FROM imports "
    "GROUP BY 1 ORDER BY 2, 1 LIMIT 15",
)
def smallest_origin_ports(spark, sf_dir):
    df = imports_fact(spark, sf_dir, "osport_description", "valuecif")
    grouped = aggregates.group_totals(df, "osport_description", ["valuecif"], None)
    return aggregates.doubles(ranking.bottom_k(grouped, "valuecif", "osport_description", 15))


def _top_share_sql(key: str, sizes) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {k} AS top_k, round(sum(v) FILTER (rn <= {k})::DOUBLE / sum(v)::DOUBLE * 100, 6) AS share_pct FROM r"
        for k in sizes
    )
    return f""", g AS (SELECT {key} AS m, sum(valuecif) AS v FROM imports GROUP BY 1),
    r AS (SELECT *, row_number() OVER (ORDER BY v DESC, m) AS rn FROM g) {rows}"""


@query("T7", _top_share_sql("country_description", (5, 10, 20)))
def country_share_of_top(spark, sf_dir):
    df = imports_fact(spark, sf_dir, COUNTRY, "valuecif")
    return rounded(reports.share_of_top(df, COUNTRY), share_pct=6)


@query("T7", _top_share_sql("commodity_description", (10, 20)))
def commodity_share_of_top(spark, sf_dir):
    df = imports_fact(spark, sf_dir, ITEM, "valuecif")
    return rounded(reports.share_of_top(df, ITEM, (10, 20)), share_pct=6)


# ---------------------------------------------------------------- ports and countries

PC = """,
pc AS (SELECT ausport_description AS p, country_description AS k, sum(valuecif) AS v
       FROM imports GROUP BY 1, 2),
sh AS (SELECT *, round_even(v::DOUBLE / (sum(v) OVER (PARTITION BY p))::DOUBLE * 100 * 100, 0) / 100 AS pct
       FROM pc)"""
def _top_pc(countries: int) -> str:
    return f""",
tp AS (SELECT ausport_description AS p FROM imports GROUP BY 1 ORDER BY sum(valuecif) DESC, 1 LIMIT 10),
tk AS (SELECT country_description AS k FROM imports GROUP BY 1 ORDER BY sum(valuecif) DESC, 1 LIMIT {countries}),
block AS (SELECT ausport_description AS p, country_description AS k, sum(valuecif) AS v
  FROM imports WHERE ausport_description IN (SELECT p FROM tp)
    AND country_description IN (SELECT k FROM tk) GROUP BY 1, 2)"""


TOP_PC = _top_pc(15)
TOP_SHARES = """SELECT p AS ausport_description, k AS country_description, v::DOUBLE AS valuecif,
    round_even(v::DOUBLE / (sum(v) OVER (PARTITION BY p))::DOUBLE * 100 * 100, 0) / 100 AS pct_of_port
    FROM block ORDER BY 1, 3 DESC"""
PORT_COLUMNS = ("ausport_description", COUNTRY, "valuecif")


@query(
    "A10 W2",
    f"""{PC} SELECT p AS ausport_description, k AS country_description, v::DOUBLE AS valuecif,
    pct AS pct_of_port FROM sh""",
)
def port_country_shares(spark, sf_dir):
    return matrix.port_country_shares(imports_fact(spark, sf_dir, *PORT_COLUMNS))


@query(
    "A10 J4 T5",
    f"{TOP_PC} {TOP_SHARES}",
)
def top_port_country_shares(spark, sf_dir):
    shares = matrix.port_country_shares(imports_fact(spark, sf_dir, *PORT_COLUMNS), base="top")
    return shares.orderBy("ausport_description", F.desc("valuecif"), COUNTRY)


@query("A10 J4", f"{_top_pc(11)} {TOP_SHARES}")
def top_port_shares_of_eleven(spark, sf_dir):
    """Eleven countries: at some scales another list than the eleven largest inside the top ports."""
    return matrix.port_country_shares(imports_fact(spark, sf_dir, *PORT_COLUMNS), base="top", countries=11)


@query(
    "A11",
    f"""{PC} SELECT p AS port, sum(v)::DOUBLE AS total_value, count(k) AS num_countries,
    max(pct) AS top_country_pct FROM sh GROUP BY 1""",
)
def port_concentration(spark, sf_dir):
    shares = matrix.port_concentration(imports_fact(spark, sf_dir, *PORT_COLUMNS))
    return rounded(shares, total_value=2)


@query("V1 J4 A10", f"{TOP_PC} SELECT p AS ausport_description, k AS country_description, v::DOUBLE AS valuecif FROM block")
def port_country_matrix(spark, sf_dir):
    """The matrix in long form; ``wide_matrix`` spreads it over columns that the caller names."""
    pairs = matrix.port_country_totals(imports_fact(spark, sf_dir, *PORT_COLUMNS))
    return aggregates.doubles(matrix.top_block(pairs))


# ---------------------------------------------------------------- industries


def _values(table: dict[str, str]) -> str:
    rows = ", ".join("('" + k + "', '" + v.replace("'", "''") + "')" for k, v in table.items())
    return f"(VALUES {rows})"


INDUSTRY = f""",
chapter_of AS (SELECT * FROM {_values(classify.CHAPTER_SECTION)} t(ch, sec)),
section_of AS (SELECT * FROM {_values(classify.SECTION_NAMES)} t(sec, name)),
industry_of AS (SELECT * FROM {_values(classify.SECTION_INDUSTRIES)} t(sec, name)),
division_of AS (SELECT * FROM {_values({
    k: classify.DIVISION_INDUSTRIES[v] for k, v in classify.CHAPTER_DIVISION.items()})} t(ch, name)),
code0 AS (SELECT DISTINCT commodity_code AS code FROM imports),
code1 AS (
  SELECT code, CASE WHEN length(code) >= 2 THEN coalesce(sec, '9')
      WHEN code IN (SELECT sec FROM section_of) THEN code ELSE '9' END AS section,
    CASE WHEN length(code) IN (1, 3) THEN '0' || substring(code, 1, 1) ELSE substring(code, 1, 2) END AS dkey
  FROM code0 LEFT JOIN chapter_of ON ch = substring(code, 1, 2) AND length(code) >= 2),
codes AS (
  SELECT code AS commodity_code, section, s.name AS section_name,
    CASE WHEN section = '6' THEN coalesce(d.name, 'Manufactured Goods') ELSE i.name END AS industry_sector
  FROM code1 JOIN section_of s ON s.sec = section JOIN industry_of i ON i.sec = section
  LEFT JOIN division_of d ON d.ch = dkey)"""


@query("P21 P22 P23 P25 J5", f"{INDUSTRY} SELECT * FROM codes")
def classified_codes(spark, sf_dir):
    return classify.classified_codes(imports_fact(spark, sf_dir, "commodity_code"))


@query(
    "P24",
    f"""{INDUSTRY}, listing AS (
      SELECT name AS industry_sector FROM industry_of WHERE sec <> '6'
      UNION ALL SELECT DISTINCT name FROM division_of)
    SELECT industry_sector, count(commodity_code) AS codes
    FROM listing LEFT JOIN codes USING (industry_sector) GROUP BY 1""",
)
def industry_listing(spark, sf_dir):
    """Every offered industry with the number of codes found in it."""
    codes = classify.classified_codes(imports_fact(spark, sf_dir, "commodity_code"))
    found = codes.groupBy("industry_sector").agg(F.count(F.lit(1)).alias("codes"))
    listed = classify.industries(spark).join(found, "industry_sector", "left")
    return listed.withColumn("codes", F.coalesce("codes", F.lit(0).cast("bigint")))


@query(
    "R7 A12 A13 P25",
    f"""{INDUSTRY},
    f AS (SELECT * FROM imports JOIN codes USING (commodity_code)),
    tops AS (SELECT industry_sector, commodity_description AS top_commodity,
      row_number() OVER (PARTITION BY industry_sector ORDER BY sum(valuecif) DESC, commodity_description) AS rn
      FROM f GROUP BY 1, 2)
    SELECT industry_sector, {SUMS}, count(commodity_description) AS record_count,
      any_value(top_commodity) AS top_commodity,
      round(sum(valuecif)::DOUBLE / (SELECT sum(valuecif) FROM imports)::DOUBLE * 100, 6) AS valuecif_pct,
      sum(valuecif)::DOUBLE / 1e9 AS valuecif_billions
    FROM f JOIN (SELECT * FROM tops WHERE rn = 1) USING (industry_sector) GROUP BY 1""",
)
def industry_sectors(spark, sf_dir):
    df = imports_fact(spark, sf_dir, "commodity_code", ITEM, "valuefob", "valuecif", "weight")
    return rounded(reports.industry_sectors(df), weight=4, valuecif_pct=6)


QUADRANTS = f"""{INDUSTRY},
iv AS (
  SELECT industry_sector, sum(valuefob)::DOUBLE AS valuefob, sum(valuecif)::DOUBLE AS valuecif,
    sum(weight) AS weight, sum(quantity) AS quantity, sum(valuecif)::DOUBLE / sum(weight) AS value_per_tonne,
    sum(valuecif)::DOUBLE / 1e9 AS total_value_billions, sum(weight) / 1e6 AS total_weight_millions
  FROM imports JOIN codes USING (commodity_code) GROUP BY 1 HAVING sum(weight) > 0),
quad AS (
  SELECT *, CASE
    WHEN total_value_billions >= (SELECT median(total_value_billions) FROM iv) THEN 'Market Leader'
    WHEN value_per_tonne >= (SELECT median(value_per_tonne) FROM iv) THEN 'Premium Product'
    ELSE 'Standard' END AS category FROM iv)"""
IV_OUT = """industry_sector, valuefob, valuecif, round(weight, 4) AS weight, round(quantity, 4) AS quantity,
  round(value_per_tonne, 4) AS value_per_tonne, total_value_billions,
  round(total_weight_millions, 9) AS total_weight_millions"""
IV_DIGITS = {"weight": 4, "quantity": 4, "value_per_tonne": 4, "total_weight_millions": 9}
IV_COLUMNS = ("commodity_code", *MEASURES)


@query("A14 P19", f"{QUADRANTS} SELECT {IV_OUT} FROM iv")
def industry_values(spark, sf_dir):
    return rounded(reports.industry_values(imports_fact(spark, sf_dir, *IV_COLUMNS)), **IV_DIGITS)


@query(
    "R8 A28 P28 W6 J6",
    f"""{QUADRANTS} SELECT {IV_OUT}, category, row_number() OVER (PARTITION BY category ORDER BY
      CASE WHEN category = 'Premium Product' THEN quad.value_per_tonne ELSE quad.total_value_billions END DESC,
      industry_sector) AS rank FROM quad""",
)
def market_quadrants(spark, sf_dir):
    quadrants = reports.market_quadrants(imports_fact(spark, sf_dir, *IV_COLUMNS))
    return longs(rounded(reports.quadrant_ranks(quadrants), **IV_DIGITS), "rank")


@query(
    "R8 A42",
    f"""{QUADRANTS} SELECT category, count(*) AS industries,
      round(sum(total_value_billions), 6) AS value_billions,
      round(sum(total_weight_millions), 9) AS weight_millions,
      round(avg(total_value_billions), 6) AS mean_value_billions,
      round(sum(total_value_billions) * 1e9 / (sum(total_weight_millions) * 1e6), 3) AS value_per_tonne
    FROM quad GROUP BY 1""",
)
def quadrant_summary(spark, sf_dir):
    quadrants = reports.market_quadrants(imports_fact(spark, sf_dir, *IV_COLUMNS))
    return rounded(
        reports.quadrant_summary(quadrants),
        value_billions=6, weight_millions=9, mean_value_billions=6, value_per_tonne=3,
    )


# ---------------------------------------------------------------- trends

def _suppliers_sql(value: str) -> str:
    return f""",
s0 AS (SELECT country_description AS country, coalesce(sum({value}) FILTER (year = 2024), 0) AS a,
         coalesce(sum({value}) FILTER (year = 2025), 0) AS b
       FROM imports WHERE year IN {PAIR} GROUP BY 1),
s1 AS (SELECT country, a::DOUBLE AS value_2024, b::DOUBLE AS value_2025, (b - a)::DOUBLE AS absolute_change,
         coalesce((b::DOUBLE - a::DOUBLE) / nullif(a::DOUBLE, 0) * 100, 0) AS pct_change,
         a::DOUBLE / (SELECT sum(a) FROM s0)::DOUBLE * 100 AS share_2024,
         b::DOUBLE / (SELECT sum(b) FROM s0)::DOUBLE * 100 AS share_2025 FROM s0),
s AS (SELECT country, value_2024, value_2025, absolute_change, round(pct_change, 6) AS pct_change,
        round(share_2024, 6) AS share_2024, round(share_2025, 6) AS share_2025,
        round(share_2025 - share_2024, 6) AS share_change FROM s1
      WHERE value_2024 > 1e8 OR value_2025 > 1e8)"""


SUPPLIERS = _suppliers_sql("valuecif")
SUPPLIER_DIGITS = {"pct_change": 6, "share_2024": 6, "share_2025": 6, "share_change": 6}


def _suppliers(spark, sf_dir):
    df = imports_fact(spark, sf_dir, COUNTRY, "valuecif", "year")
    return rounded(trends.supplier_trends(df), **SUPPLIER_DIGITS)


@query("R12 A21 V2 P20", f"{SUPPLIERS} SELECT * FROM s")
def supplier_trends(spark, sf_dir):
    return _suppliers(spark, sf_dir)


@query("R12 A21 V2", f"{_suppliers_sql('valuefob')} SELECT * FROM s")
def supplier_trends_by_fob(spark, sf_dir):
    df = imports_fact(spark, sf_dir, COUNTRY, "valuefob", "year")
    return rounded(trends.supplier_trends(df, value="valuefob"), **SUPPLIER_DIGITS)


@query(
    "P17",
    """ SELECT DISTINCT commodity_description, CASE WHEN length(commodity_description) > 12
      THEN substring(commodity_description, 1, 8) || '...' ELSE commodity_description END AS label FROM imports""",
)
def short_labels(spark, sf_dir):
    """Texts of more than 12 characters are cut after 8."""
    df = imports_fact(spark, sf_dir, ITEM).distinct()
    return df.withColumn("label", shorten(ITEM, 8, 12))


@query(
    "R12 T3",
    f"""{SUPPLIERS} SELECT *, row_number() OVER (ORDER BY absolute_change, country) AS rank FROM s
    ORDER BY absolute_change, country LIMIT 15""",
)
def declining_suppliers(spark, sf_dir):
    return longs(trends.declining(_suppliers(spark, sf_dir)), "rank")


@query(
    "R12 T2 T4",
    f"""{SUPPLIERS} SELECT *, row_number() OVER (ORDER BY absolute_change DESC, country) AS rank FROM s
    ORDER BY absolute_change DESC, country LIMIT 15""",
)
def growing_suppliers(spark, sf_dir):
    return longs(trends.growing(_suppliers(spark, sf_dir)), "rank")


TRENDS = f""",
t0 AS (SELECT commodity_description, {', '.join(
    f"coalesce(sum({m}) FILTER (year = {y}), 0) AS {m}_{y}"
    for m in ("valuecif", "valuefob", "weight") for y in (2024, 2025))}
  FROM imports WHERE year IN {PAIR} GROUP BY 1),
t AS (SELECT commodity_description, {', '.join(
    f"{m}_{y}::DOUBLE AS {m}_{y}" for m in ("valuecif", "valuefob") for y in (2024, 2025))},
    round(weight_2024, 4) AS weight_2024, round(weight_2025, 4) AS weight_2025,
    round((valuecif_2025::DOUBLE - valuecif_2024::DOUBLE) / valuecif_2024::DOUBLE * 100, 6) AS growth_rate_pct,
    (valuecif_2025 - valuecif_2024)::DOUBLE AS absolute_change,
    (valuecif_2025 + valuecif_2024)::DOUBLE / 2 AS avg_value
  FROM t0 WHERE valuecif_2024 > 0 AND valuecif_2025 > 0)"""


def _commodities(spark, sf_dir):
    df = imports_fact(spark, sf_dir, ITEM, "valuecif", "valuefob", "weight", "year")
    return rounded(trends.commodity_trends(df), weight_2024=4, weight_2025=4, growth_rate_pct=6)


@query("R13 A22 V3 P20", f"{TRENDS} SELECT * FROM t")
def commodity_trends(spark, sf_dir):
    return _commodities(spark, sf_dir)


@query(
    "R13 T1 W6",
    f"""{TRENDS} SELECT *, row_number() OVER (ORDER BY growth_rate_pct DESC, commodity_description) AS rank
    FROM t ORDER BY growth_rate_pct DESC, commodity_description LIMIT 10""",
)
def fastest_growing(spark, sf_dir):
    return longs(trends.fastest_growing(_commodities(spark, sf_dir)), "rank")


@query(
    "R13 T4 W6",
    f"""{TRENDS}, z AS (SELECT * FROM t ORDER BY growth_rate_pct, commodity_description DESC LIMIT 10)
    SELECT *, row_number() OVER (ORDER BY growth_rate_pct, commodity_description) AS rank FROM z""",
)
def fastest_shrinking(spark, sf_dir):
    return longs(trends.fastest_shrinking(_commodities(spark, sf_dir)), "rank")


@query(
    "R13 T2",
    f"{TRENDS} SELECT * FROM t ORDER BY absolute_change DESC, commodity_description LIMIT 10",
)
def largest_gains(spark, sf_dir):
    return trends.largest_gains(_commodities(spark, sf_dir))


def _describe_sql(source: str, column: str, percents, digits: int) -> str:
    parts = {
        "count": f"count({column})::DOUBLE",
        "mean": f"sum({column})::DOUBLE / count({column})",
        "std": f"stddev_samp({column}::DOUBLE)",
        "min": f"min({column})::DOUBLE",
        "max": f"max({column})::DOUBLE",
        **{f"p{p:02d}": f"quantile_cont({column}::DOUBLE, {p / 100})" for p in percents},
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS statistic, round({sql}, {digits}) AS value FROM {source}"
        for name, sql in parts.items()
    )


@query("R13 A26", f"{TRENDS} {_describe_sql('t', 'growth_rate_pct', (25, 50, 75), 4)}")
def growth_distribution(spark, sf_dir):
    return rounded(percentiles.describe(_commodities(spark, sf_dir), "growth_rate_pct"), value=4)


@query(
    "R13 A41",
    f"""{TRENDS} SELECT CASE WHEN growth_rate_pct > 0 THEN 'growing' WHEN growth_rate_pct < 0
      THEN 'shrinking' ELSE 'stable' END AS trend, count(*) AS items,
      round(count(*) / (SELECT count(*) FROM t)::DOUBLE * 100, 6) AS items_pct FROM t GROUP BY 1""",
)
def growth_counts(spark, sf_dir):
    return rounded(trends.growth_counts(_commodities(spark, sf_dir)), items_pct=6)


# ---------------------------------------------------------------- values


@query(
    "R15 A25",
    """, g AS (SELECT sum(valuefob) AS f, sum(valuecif) AS c, sum(weight) AS w FROM imports)
    SELECT f::DOUBLE AS total_fob, c::DOUBLE AS total_cif, (c - f)::DOUBLE AS insurance_freight,
      round((c - f)::DOUBLE / f::DOUBLE * 100, 6) AS insurance_freight_pct,
      round(f::DOUBLE / w, 4) AS fob_per_tonne, round(c::DOUBLE / w, 4) AS cif_per_tonne FROM g""",
)
def fob_cif_gap(spark, sf_dir):
    df = reports.fob_cif_gap(imports_fact(spark, sf_dir, "valuefob", "valuecif", "weight"))
    return rounded(df, insurance_freight_pct=6, fob_per_tonne=4, cif_per_tonne=4)


@query(
    "R16 A26 A27 P19",
    ", d AS (SELECT valuefob FROM imports WHERE valuefob > 0) "
    + _describe_sql("d", "valuefob", reports.PERCENTS, 2),
)
def value_distribution(spark, sf_dir):
    return rounded(reports.distribution(imports_fact(spark, sf_dir, "valuefob"), "valuefob"), value=2)


@query(
    "R16 A26 A27 P19",
    ", d AS (SELECT weight FROM imports WHERE weight > 0) "
    + _describe_sql("d", "weight", reports.PERCENTS, 4),
)
def weight_distribution(spark, sf_dir):
    return rounded(reports.distribution(imports_fact(spark, sf_dir, "weight"), "weight"), value=4)


def _insight_sql() -> str:
    parts = []
    for key, value in reports.INSIGHTS.items():
        parts.append(
            f"(SELECT 'top {key}' AS insight, {key} AS label, sum({value})::DOUBLE AS value, "
            f"sum({value})::DOUBLE / (SELECT sum({value}) FROM f)::DOUBLE * 100 AS pct "
            f"FROM f GROUP BY {key} ORDER BY sum({value}) DESC, {key} LIMIT 1)"
        )
    for key, k, name in ((COUNTRY, 5, "top 5 countries"), (ITEM, 10, "top 10 commodities")):
        parts.append(
            f"SELECT '{name}', NULL, sum(v)::DOUBLE, sum(v)::DOUBLE / (SELECT sum(valuecif) FROM f)::DOUBLE * 100 "
            f"FROM (SELECT sum(valuecif) AS v FROM f GROUP BY {key} ORDER BY v DESC, {key} LIMIT {k})"
        )
    parts.append(
        "SELECT 'yearly growth', NULL, (b - a)::DOUBLE, (b::DOUBLE - a::DOUBLE) / a::DOUBLE * 100 FROM "
        "(SELECT sum(valuefob) FILTER (year = 2024) AS a, sum(valuefob) FILTER (year = 2025) AS b FROM f)"
    )
    return (
        f", f AS (SELECT * FROM imports), i AS ({' UNION ALL '.join(parts)}) "
        "SELECT insight, label, value, round(pct, 6) AS pct FROM i"
    )


@query("R18 T7 W5", _insight_sql())
def key_insights(spark, sf_dir):
    df = imports_fact(spark, sf_dir, *reports.INSIGHTS, "year", "valuecif", "valuefob")
    return rounded(reports.key_insights(df, (2024, 2025)), pct=6)


def _summary_sql() -> str:
    parts = []
    for key, k in {**reports.SUMMARY_TOPS, "mode_description": None, "state": None, "year": None}.items():
        limit = f"WHERE rank <= {k}" if k else ""
        parts.append(
            f"SELECT * FROM (SELECT '{key}' AS section, row_number() OVER (ORDER BY sum(valuecif) DESC, "
            f"{key}::VARCHAR) AS rank, {key}::VARCHAR AS member, sum(valuecif)::DOUBLE AS valuecif "
            f"FROM imports GROUP BY {key}) {limit}"
        )
    return " " + " UNION ALL ".join(parts)


SUMMARY_COLUMNS = (
    COUNTRY, ITEM, "ausport_description", "mode_description", "state", "year", *MEASURES,
)


@query("R19 A45", _summary_sql())
def summary_members(spark, sf_dir):
    return longs(reports.summary_members(imports_fact(spark, sf_dir, *SUMMARY_COLUMNS)), "rank")


@query(
    "A39",
    """,
    y AS (SELECT year AS k, sum(valuecif)::DOUBLE AS v FROM imports GROUP BY 1),
    m AS (SELECT month AS k, sum(valuecif)::DOUBLE AS v FROM imports GROUP BY 1),
    c AS (SELECT country_description AS k, sum(valuecif)::DOUBLE AS v FROM imports GROUP BY 1)
    SELECT 'year' AS filter, row_number() OVER (ORDER BY k) AS position, k::VARCHAR AS choice,
      (SELECT count(*) FROM y) <= 5 OR row_number() OVER (ORDER BY k DESC) <= 2 AS is_default,
      v AS valuecif FROM y
    UNION ALL SELECT 'month', row_number() OVER (ORDER BY k), k, true, v FROM m
    UNION ALL SELECT * FROM (SELECT 'country', row_number() OVER (ORDER BY v DESC, k) AS p, k, false, v FROM c)
      WHERE p <= 20""",
)
def filter_options(spark, sf_dir):
    df = imports_fact(spark, sf_dir, "year", "month", COUNTRY, "valuecif")
    return longs(filters.filter_options(df), "position")
