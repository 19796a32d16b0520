import math

import pytest
from pyspark.sql import functions as F

from cargolens.functions import (
    combined_class,
    combined_score,
    concentration_class,
    dependence_class,
    freight_cost,
    growth_class,
    growth_pct,
    half_even,
    map_units,
    month_label,
    month_name,
    month_number,
    normalize_text,
    shorten,
    to_number,
    year_of,
)
from cargolens.functions.numbers import clean_number


def column(spark, rows, expression, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_to_number_accepts_plain_numbers_only(spark):
    texts = ["1", " 2 ", "1e3", ".5", "-4.25", "inf", "-Infinity", "1,000", "nan", "1d", "1f", "0x1p3", "", "n/a", None]
    found = column(spark, texts, to_number("c"))
    assert found == [1.0, 2.0, 1000.0, 0.5, -4.25, math.inf, -math.inf] + [None] * 8


def test_clean_number_fills_and_clips(spark):
    assert column(spark, ["-3", None, "x", "2.5"], clean_number("c")) == [0.0, 0.0, 0.0, 2.5]


def test_half_even_matches_numpy(spark):
    import numpy as np

    rows = [0.5, 1.5, 2.5, -0.5, 3.49]
    assert column(spark, rows, half_even("c"), "double") == list(np.round(rows))
    rows = [2.675, 0.125, 1.005, 33.335, 12.345]
    assert column(spark, rows, half_even("c", 2), "double") == list(np.round(rows, 2))


def test_normalize_text_order_of_steps(spark):
    rows = [None, "nan", "NaN", "None", " nan ", "  a \t b\n", " x y ", '"q"', "a ' b", "   ", "it's"]
    assert column(spark, rows, normalize_text("c")) == [
        "Unknown", "Unknown", "Unknown", "Unknown", "nan", "a b", "x y", "q", "a  b", "", "its",
    ]


def test_normalize_text_matches_python_on_every_white_space(spark):
    import re

    rows = [f"{chr(n)}a{chr(n)}{chr(n)}b{chr(n)}" for n in range(1, 0x3001) if chr(n).isspace()]
    expected = [re.sub(r"\s+", " ", r.strip()) for r in rows]
    assert column(spark, rows, normalize_text("c")) == expected


def test_map_units(spark):
    rows = ["Litres Al", "litres al", "LITRES AL", "Litres", "Number", "litres"]
    assert column(spark, rows, map_units("c")) == ["Litres"] * 4 + ["Number", "litres"]


@pytest.mark.parametrize("cut,limit", [(3, None), (3, 5)])
def test_shorten(spark, cut, limit):
    rows = ["abc", "abcd", "abcdef", None]
    bound = limit or cut
    expected = [r if r is None or len(r) <= bound else r[:cut] + "..." for r in rows]
    assert column(spark, rows, shorten("c", cut, limit)) == expected


def test_month_parts(spark):
    rows = ["January 2024", "May 2025", "Foo 2024", "2024", None]
    assert column(spark, rows, month_name("c")) == ["January", "May", "Foo", None, None]
    assert column(spark, rows, month_number(month_name("c"))) == [1, 5, None, None, None]
    assert column(spark, rows, year_of("c")) == ["2024", "2025", "2024", "2024", None]
    assert column(spark, [1, 12, None], month_label("c"), "int") == ["Jan", "Dec", ""]


def test_growth_and_freight(spark):
    df = spark.createDataFrame([(100.0, 150.0), (0.0, 5.0), (10.0, 5.0)], "a double, b double")
    rows = df.select(growth_pct(F.col("a"), F.col("b")), freight_cost("b", "a")).collect()
    assert [tuple(r) for r in rows] == [(50.0, 50.0), (None, 5.0), (-50.0, 0.0)]
    assert column(spark, [1.0, -1.0, 0.0, None], growth_class(F.col("c")), "double") == [
        "growing", "shrinking", "stable", None,
    ]


def test_classes_at_their_thresholds(spark):
    df = spark.createDataFrame(
        [(2500.0, 10.0), (100.0, 50.0), (1500.0, 0.0), (0.0, 40.0), (1499.9, 39.9), (0.0, None)],
        "h double, t double",
    )
    found = [r[0] for r in df.select(concentration_class(F.col("h"), F.col("t"))).collect()]
    assert found == ["HIGH RISK"] * 2 + ["MEDIUM RISK"] * 2 + ["LOW RISK"] * 2
    df = spark.createDataFrame(
        [(5.0, 0.0), (0.0, 40.0), (2.0, 0.0), (0.0, 15.0), (0.5, 0.0), (0.0, 4.0), (0.4, 3.9)],
        "p double, b double",
    )
    found = [r[0] for r in df.select(dependence_class(F.col("p"), F.col("b"))).collect()]
    assert found == ["CRITICAL"] * 2 + ["HIGH"] * 2 + ["MODERATE"] * 2 + ["LOW"]


def test_combined_scores(spark):
    df = spark.createDataFrame(
        [("HIGH RISK", "CRITICAL"), ("LOW RISK", "LOW"), ("MEDIUM RISK", "MODERATE")], "c string, d string"
    ).withColumn("s", combined_score(F.col("c"), F.col("d")))
    rows = df.select("s", combined_class(F.col("s"))).collect()
    assert [(round(a, 4), b) for a, b in rows] == [
        (10.0, "EXTREME RISK"), (1.6667, "LOW RISK"), (5.0, "HIGH RISK"),
    ]
