"""The given tables seen as import records, for Spark and for SQL.

``imports_fact`` has the cleaned schema, ``imports_raw`` the dirty one. Every inner
join keeps all order lines, so a query joins only the tables its columns come from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACT_COLUMNS = (
    "year",
    "month_number",
    "month",
    "mode",
    "mode_description",
    "commodity_code",
    "commodity_description",
    "country_code",
    "country_description",
    "ausport_code",
    "ausport_description",
    "osport_code",
    "osport_description",
    "state",
    "weight",
    "valuefob",
    "valuecif",
    "quantity",
    "unit_quantity",
)

_PART = {
    "commodity_code", "commodity_description", "country_code", "country_description",
    "weight", "valuefob", "valuecif",
}
_CUSTOMER = {"ausport_code", "ausport_description", "state"}
_PORT_NATION = {"ausport_description", "state"}


def _amount(factor):
    size = F.col("p_size")
    scale = F.when(size == 50, 60).when(size == 49, 25).when(size == 48, 8).otherwise(1)
    return (F.col("l_extendedprice") * factor * 100 * scale).cast("decimal(20,2)")


def _mode_code():
    flag = F.col("l_returnflag")
    return F.when(flag == "A", "4").when(flag == "N", "1").otherwise("5")


def _mode():
    flag = F.col("l_returnflag")
    return F.when(flag == "A", "AIR").when(flag == "N", "SEA").otherwise("POST")


def _unit():
    names = F.array(*[F.lit(u) for u in ("Number", "Litres", "Kilograms", "Tonnes")])
    return F.element_at(names, (F.col("l_linenumber") % 4 + 1).cast("int"))


def _weight():
    tonnes = F.col("l_quantity") * F.col("p_size") / 100
    return F.when(F.col("p_size") == 1, 0.0).otherwise(tonnes)


_EXPRESSIONS = {
    "year": lambda: F.year("l_shipdate") + 24,
    "month_number": lambda: F.month("l_shipdate"),
    "month": lambda: F.date_format("l_shipdate", "MMMM"),
    "mode": _mode_code,
    "mode_description": _mode,
    "commodity_code": lambda: (F.col("p_partkey") * 7919 % 100000).cast("string"),
    "commodity_description": lambda: F.concat(
        "p_type", F.lit(" size "), F.col("p_size").cast("string")
    ),
    "country_code": lambda: F.col("_country").cast("string"),
    "country_description": lambda: F.col("country_name"),
    "ausport_code": lambda: F.col("c_nationkey").cast("string"),
    "ausport_description": lambda: F.col("port_name"),
    "osport_code": lambda: F.col("l_suppkey").cast("string"),
    "osport_description": lambda: F.col("s_name"),
    "state": lambda: F.col("r_name"),
    "weight": _weight,
    "valuefob": lambda: _amount(1 - F.col("l_discount")),
    "valuecif": lambda: _amount(1 + F.col("l_tax")),
    "quantity": lambda: F.col("l_quantity"),
    "unit_quantity": _unit,
}


def _joined(spark: SparkSession, sf_dir: str, columns) -> DataFrame:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    columns = set(columns)
    # the large tables meet while their rows are narrow; the names of 25 nations and 5 regions are put on last
    df = table("lineitem")
    if columns & _CUSTOMER:
        orders, customer = table("orders"), table("customer")
        bought = orders.join(customer, orders.o_custkey == customer.c_custkey)
        df = df.join(bought, df.l_orderkey == bought.o_orderkey)
    if columns & _PART:
        part = table("part")
        df = df.join(part, df.l_partkey == part.p_partkey)
    if "osport_description" in columns:
        supplier = table("supplier")
        df = df.join(supplier, df.l_suppkey == supplier.s_suppkey)
    if columns & _PART:
        df = df.withColumn("_country", F.col("l_suppkey") % (F.col("p_size") % 25 + 1))
    if "country_description" in columns:
        nation = table("nation").select(
            F.col("n_nationkey").alias("_nation"), F.col("n_name").alias("country_name")
        )
        df = df.join(nation, F.col("_country") == F.col("_nation"))
    if columns & _PORT_NATION:
        nation = table("nation").select(
            F.col("n_nationkey").alias("_port"), F.col("n_name").alias("port_name"), "n_regionkey"
        )
        df = df.join(nation, F.col("c_nationkey") == F.col("_port"))
    if "state" in columns:
        region = table("region")
        df = df.join(region, F.col("n_regionkey") == region.r_regionkey)
    return df


def imports_fact(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Cleaned import records with the named columns, or all of them."""
    columns = columns or FACT_COLUMNS
    return _joined(spark, sf_dir, columns).select(*[_EXPRESSIONS[c]().alias(c) for c in columns])


RAW_HEADERS = {
    "month": "Month",
    "mode": "Mode",
    "mode_description": "Mode Description",
    "commodity_code": "Commodity Code",
    "commodity_description": "Commodity Description",
    "country_code": "Country Code",
    "country_description": "Country Description",
    "ausport_code": "Ausport Code",
    "ausport_description": "Ausport Description",
    "osport_code": "Osport Code",
    "osport_description": "Osport Description",
    "state": "State",
    "weight": "Weight",
    "valuefob": "Valuefob",
    "valuecif": "Valuecif",
    "quantity": "Quantity",
    "unit_quantity": "Unit Quantity",
}


def imports_raw(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Raw import records as text, with deterministic defects and exact duplicates."""
    columns = columns or tuple(RAW_HEADERS)
    df = _joined(spark, sf_dir, columns).select(
        *[(_RAW[c] if c in _RAW else _EXPRESSIONS[c])().cast("string").alias(RAW_HEADERS[c]) for c in columns],
        "l_orderkey",
    )
    copies = F.when(F.col("l_orderkey") % 50 == 0, 2).otherwise(1)
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy", "l_orderkey")


def _raw_month():
    text = F.concat(_EXPRESSIONS["month"](), F.lit(" "), _EXPRESSIONS["year"]().cast("string"))
    return F.when(F.col("l_partkey") % 31 != 0, text)


def _raw_commodity():
    text, line, nbsp = _EXPRESSIONS["commodity_description"](), F.col("l_linenumber"), F.lit("\u00a0")
    wide = F.concat(F.lit("  "), F.replace(text, F.lit(" "), F.lit("   ")), F.lit(" "))
    return (
        F.when(line == 1, wide)
        .when(line == 2, F.concat(F.lit("\t"), text, F.lit("\n")))
        .when(line == 3, F.concat(F.lit('"'), text, F.lit('"')))
        .when(line == 4, F.concat(F.lit("'"), text, F.lit(" '")))
        .when(line == 5, F.concat(nbsp, text, nbsp))
        .otherwise(text)
    )


def _raw_weight():
    part = F.col("l_partkey")
    good = _weight().cast("decimal(12,4)").cast("string")
    return F.when(part % 23 == 0, "n/a").when(part % 29 == 0, "1d").otherwise(good)


def _raw_fob():
    sign = F.when(F.col("l_linenumber") == 7, -1).otherwise(1)
    return (_EXPRESSIONS["valuefob"]() * sign).cast("decimal(20,2)")


def _raw_unit():
    names = F.array(*[F.lit(u) for u in ("Litres", "Litres Al", "litres al", "LITRES AL")])
    litres = F.element_at(names, (F.col("l_orderkey") % 4 + 1).cast("int"))
    return F.when(F.col("l_linenumber") % 4 == 1, litres).otherwise(_unit())


_RAW = {
    "month": _raw_month,
    "commodity_description": _raw_commodity,
    "country_description": lambda: F.when(F.col("l_suppkey") % 17 != 0, F.col("country_name")),
    "state": lambda: F.when(F.col("l_suppkey") % 19 == 0, "nan").otherwise(F.col("r_name")),
    "weight": _raw_weight,
    "valuefob": _raw_fob,
    "quantity": lambda: (
        F.col("l_quantity") + F.when(F.col("l_discount") == 0.05, 0.5).otherwise(0.0)
    ).cast("decimal(12,1)"),
    "unit_quantity": _raw_unit,
}


_SCALE = "CASE p_size WHEN 50 THEN 60 WHEN 49 THEN 25 WHEN 48 THEN 8 ELSE 1 END"

LINES_SQL = f"""
lines AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_discount, l_quantity,
    CAST(year(l_shipdate) + 24 AS INTEGER) AS year,
    CAST(month(l_shipdate) AS INTEGER) AS month_number,
    monthname(l_shipdate) AS month,
    CASE l_returnflag WHEN 'A' THEN '4' WHEN 'N' THEN '1' ELSE '5' END AS mode,
    CASE l_returnflag WHEN 'A' THEN 'AIR' WHEN 'N' THEN 'SEA' ELSE 'POST' END AS mode_description,
    CAST(p_partkey * 7919 % 100000 AS VARCHAR) AS commodity_code,
    p_type || ' size ' || CAST(p_size AS VARCHAR) AS commodity_description,
    CAST(l_suppkey % (1 + p_size % 25) AS VARCHAR) AS country_code,
    cn.n_name AS country_description,
    CAST(c_nationkey AS VARCHAR) AS ausport_code,
    pn.n_name AS ausport_description,
    CAST(l_suppkey AS VARCHAR) AS osport_code,
    s_name AS osport_description,
    r_name AS state,
    CASE WHEN p_size = 1 THEN 0.0 ELSE l_quantity * p_size / 100 END::DOUBLE AS weight,
    CAST(l_extendedprice * (1 - l_discount) * 100 * {_SCALE} AS DECIMAL(20,2)) AS valuefob,
    CAST(l_extendedprice * (1 + l_tax) * 100 * {_SCALE} AS DECIMAL(20,2)) AS valuecif,
    CAST(l_quantity AS DOUBLE) AS quantity,
    ['Number','Litres','Kilograms','Tonnes'][CAST(l_linenumber % 4 AS INTEGER) + 1] AS unit_quantity
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN nation cn ON l_suppkey % (1 + p_size % 25) = cn.n_nationkey
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation pn ON c_nationkey = pn.n_nationkey
  JOIN region ON pn.n_regionkey = r_regionkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

FACT_SQL = f"{LINES_SQL},\nimports AS (SELECT {', '.join(FACT_COLUMNS)} FROM lines)"

RAW_SQL = f"""{LINES_SQL},
raw AS (
  SELECT
    CASE WHEN l_partkey % 31 <> 0 THEN month || ' ' || CAST(year AS VARCHAR) END AS month,
    mode, mode_description, commodity_code,
    CASE l_linenumber
      WHEN 1 THEN '  ' || replace(commodity_description, ' ', '   ') || ' '
      WHEN 2 THEN chr(9) || commodity_description || chr(10)
      WHEN 3 THEN '"' || commodity_description || '"'
      WHEN 4 THEN '''' || commodity_description || ' '''
      WHEN 5 THEN chr(160) || commodity_description || chr(160)
      ELSE commodity_description END AS commodity_description,
    country_code,
    CASE WHEN l_suppkey % 17 <> 0 THEN country_description END AS country_description,
    ausport_code, ausport_description, osport_code, osport_description,
    CASE WHEN l_suppkey % 19 = 0 THEN 'nan' ELSE state END AS state,
    CASE WHEN l_partkey % 23 = 0 THEN 'n/a' WHEN l_partkey % 29 = 0 THEN '1d'
      ELSE CAST(CAST(weight AS DECIMAL(12,4)) AS VARCHAR) END AS weight,
    CAST(CAST(valuefob * CASE WHEN l_linenumber = 7 THEN -1 ELSE 1 END AS DECIMAL(20,2)) AS VARCHAR) AS valuefob,
    CAST(valuecif AS VARCHAR) AS valuecif,
    CAST(CAST(l_quantity + CASE WHEN l_discount = 0.05 THEN 0.5 ELSE 0.0 END AS DECIMAL(12,1)) AS VARCHAR) AS quantity,
    CASE WHEN l_linenumber % 4 = 1
      THEN ['Litres','Litres Al','litres al','LITRES AL'][CAST(l_orderkey % 4 AS INTEGER) + 1]
      ELSE unit_quantity END AS unit_quantity
  FROM lines, LATERAL (SELECT unnest(generate_series(1, CASE WHEN l_orderkey % 50 = 0 THEN 2 ELSE 1 END)))
)"""

_TEXT = (
    "replace(replace(regexp_replace(regexp_replace(CASE WHEN {c} IS NULL OR {c} IN ('nan','NaN','None')"
    " THEN 'Unknown' ELSE {c} END, '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g'),"
    " '[\\s\\x{{00A0}}]+', ' ', 'g'), '\"', ''), '''', '')"
)
_NUMBER = (
    "CASE WHEN regexp_matches({c}, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$')"
    " THEN CAST({c} AS DOUBLE) END"
)
_MONTHS = (
    "['January','February','March','April','May','June','July','August','September','October',"
    "'November','December']"
)


def number_sql(column: str) -> str:
    return _NUMBER.format(c=column)


def text_sql(column: str) -> str:
    return _TEXT.format(c=column)


CLEAN_SQL = f"""{RAW_SQL},
typed AS (
  SELECT regexp_extract(month, '^([A-Za-z]+)', 1) AS name,
    coalesce(CAST(nullif(regexp_extract(month, '(\\d{{4}})', 1), '') AS INTEGER), 0) AS year,
    mode, commodity_code, country_code, ausport_code, osport_code,
    {', '.join(f"{text_sql(c)} AS {c}" for c in (
        'country_description', 'commodity_description', 'mode_description',
        'ausport_description', 'osport_description', 'state', 'unit_quantity'))},
    {', '.join(f"greatest(coalesce({number_sql(c)}, 0.0), 0.0) AS {c}" for c in (
        'weight', 'valuefob', 'valuecif', 'quantity'))}
  FROM raw
),
records AS (
  SELECT nullif(name, '') AS month, year,
    CAST(nullif(coalesce(list_position({_MONTHS}, name), 0), 0) AS INTEGER) AS month_number,
    mode, mode_description, commodity_code, commodity_description, country_code, country_description,
    ausport_code, ausport_description, osport_code, osport_description, state,
    weight, valuefob, valuecif,
    CASE WHEN unit_quantity = 'Number' THEN round_even(quantity, 0) ELSE quantity END AS quantity,
    CASE WHEN unit_quantity IN ('Litres Al','litres al','LITRES AL') THEN 'Litres' ELSE unit_quantity END AS unit_quantity,
    unit_quantity AS unit_quantity_original,
    valuefob / nullif(weight, 0) AS value_per_tonne_fob,
    valuecif / nullif(weight, 0) AS value_per_tonne_cif,
    greatest(valuecif - valuefob, 0.0) AS insurance_freight_cost
  FROM typed
),
cleaned AS (SELECT DISTINCT * EXCLUDE (unit_quantity_original) FROM records)"""
