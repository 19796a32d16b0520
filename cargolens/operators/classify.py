"""Commodity codes to trade sections and industries by lookup joins.

The two lookup tables are constant, a few kilobytes in all, so they are always
broadcast: a classified table needs no shuffle.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip

# Section of each two-digit chapter, in chapter order.
CHAPTER_SECTION = {
    "01": "0", "02": "0", "03": "0", "04": "0", "05": "0", "06": "0", "07": "0", "08": "0",
    "09": "0", "10": "0", "11": "0", "12": "0", "13": "0", "14": "0", "15": "4", "16": "0",
    "17": "0", "18": "0", "19": "0", "20": "0", "21": "0", "22": "1", "23": "0", "24": "1",
    "25": "2", "26": "2", "27": "3", "28": "5", "29": "5", "30": "5", "31": "5", "32": "5",
    "33": "5", "34": "5", "35": "5", "36": "5", "37": "5", "38": "5", "39": "5", "40": "6",
    "41": "6", "42": "6", "43": "6", "44": "2", "45": "2", "46": "2", "47": "2", "48": "6",
    "49": "6", "50": "6", "51": "6", "52": "6", "53": "6", "54": "6", "55": "6", "56": "6",
    "57": "6", "58": "6", "59": "6", "60": "6", "61": "8", "62": "8", "63": "6", "64": "8",
    "65": "8", "66": "8", "67": "8", "68": "6", "69": "6", "70": "6", "71": "9", "72": "6",
    "73": "6", "74": "6", "75": "6", "76": "6", "77": "6", "78": "6", "79": "6", "80": "6",
    "81": "6", "82": "6", "83": "6", "84": "7", "85": "7", "86": "7", "87": "7", "88": "7",
    "89": "7", "90": "8", "91": "8", "92": "8", "93": "8", "94": "8", "95": "8", "96": "8",
    "97": "9", "98": "9", "99": "9",
}

# Official section names.
SECTION_NAMES = {
    "0": "Food and Live Animals",
    "1": "Beverages and Tobacco",
    "2": "Crude Materials (Except Fuels)",
    "3": "Mineral Fuels and Lubricants",
    "4": "Animal and Vegetable Oils, Fats and Waxes",
    "5": "Chemicals and Related Products",
    "6": "Manufactured Goods Classified by Material",
    "7": "Machinery and Transport Equipment",
    "8": "Miscellaneous Manufactured Articles",
    "9": "Commodities and Transactions Not Classified Elsewhere",
}

# Short industry name of each section.
SECTION_INDUSTRIES = {
    "0": "Food & Live Animals",
    "1": "Beverages & Tobacco",
    "2": "Crude Materials (Except Fuels)",
    "3": "Mineral Fuels & Lubricants",
    "4": "Animal & Vegetable Oils",
    "5": "Chemicals & Related Products",
    "6": "Manufactured Goods",
    "7": "Machinery & Transport Equipment",
    "8": "Miscellaneous Manufactured Articles",
    "9": "Commodities Not Classified Elsewhere",
}

# Division of the chapters that are split further, in chapter order.
CHAPTER_DIVISION = {
    "40": "62", "41": "61", "42": "61", "43": "61", "44": "63", "45": "63", "47": "64",
    "48": "64", "49": "64", "50": "65", "51": "65", "52": "65", "53": "65", "54": "65",
    "55": "65", "56": "65", "57": "65", "58": "65", "59": "65", "60": "65", "63": "65",
    "68": "66", "69": "66", "70": "66", "72": "67", "73": "67", "74": "68", "75": "68",
    "76": "68", "78": "68", "79": "68", "80": "68", "81": "68", "82": "69", "83": "69",
}

# Industry name of each division.
DIVISION_INDUSTRIES = {
    "61": "Leather & Related Products",
    "62": "Rubber Products",
    "63": "Wood & Cork Products",
    "64": "Paper & Paper Products",
    "65": "Textiles & Textile Products",
    "66": "Non-Metallic Mineral Products",
    "67": "Iron & Steel",
    "68": "Non-Ferrous Metals",
    "69": "Metal Manufactures",
}

DEFAULT_SECTION = "9"
SPLIT_SECTION = "6"


def sections(spark: SparkSession) -> DataFrame:
    """The ten sections: code, official name and short industry name."""
    return spark.createDataFrame(
        pa.table(
            {
                "section": list(SECTION_NAMES),
                "section_name": list(SECTION_NAMES.values()),
                "section_industry": list(SECTION_INDUSTRIES.values()),
            }
        )
    )


def industries(spark: SparkSession) -> DataFrame:
    """The industry names offered for selection: nine sections and nine divisions."""
    names = [v for k, v in SECTION_INDUSTRIES.items() if k != SPLIT_SECTION]
    names += DIVISION_INDUSTRIES.values()
    return spark.createDataFrame(pa.table({"industry_sector": sorted(names)}))


def chapters(spark: SparkSession) -> DataFrame:
    """Chapter to section."""
    return spark.createDataFrame(
        pa.table({"chapter": list(CHAPTER_SECTION), "section": list(CHAPTER_SECTION.values())})
    )


def divisions(spark: SparkSession) -> DataFrame:
    """Chapter to industry name of its division."""
    return spark.createDataFrame(
        pa.table(
            {
                "division_key": list(CHAPTER_DIVISION),
                "division_industry": [DIVISION_INDUSTRIES[d] for d in CHAPTER_DIVISION.values()],
            }
        )
    )


def _code(code: str) -> Column:
    return strip(F.col(code).cast("string"))


def _section_key(text: Column) -> Column:
    """Chapter text, or ``=d`` for the one-digit codes that name their section."""
    return F.when(F.length(text) >= 2, F.substring(text, 1, 2)).when(
        F.length(text) == 1, F.concat(F.lit("="), text)
    )


def _division_key(text: Column) -> Column:
    """Key into the division table: number codes of one or three digits use one digit."""
    length = F.length(text)
    number = text.rlike(r"^[+-]?[0-9]+$")
    padded = F.lpad(F.substring(text, 1, 1), 2, "0")
    return (
        F.when(number & (length == 3), padded)
        .when(length >= 2, F.substring(text, 1, 2))
        .otherwise(padded)
    )


def add_section(df: DataFrame, code: str = "commodity_code", out: str = "section") -> DataFrame:
    """Section of each code: by its first two characters, else by its only digit."""
    spark = df.sparkSession
    direct = sections(spark).select(F.concat(F.lit("="), "section").alias("chapter"), "section")
    table = chapters(spark).unionByName(direct).select(
        F.col("chapter").alias("_chapter"), F.col("section").alias("_section")
    )
    return (
        df.withColumn("_key", _section_key(_code(code)))
        .join(F.broadcast(table), F.col("_key") == F.col("_chapter"), "left")
        .withColumn(out, F.coalesce("_section", F.lit(DEFAULT_SECTION)))
        .drop("_key", "_chapter", "_section")
    )


def add_section_name(
    df: DataFrame, section: str = "section", out: str = "section_name"
) -> DataFrame:
    """Official name of a section code; ``Unclassified`` for any other code."""
    names = sections(df.sparkSession).select(
        F.col("section").alias("_section"), F.col("section_name").alias("_name")
    )
    return (
        df.join(F.broadcast(names), F.col(section) == F.col("_section"), "left")
        .withColumn(out, F.coalesce("_name", F.lit("Unclassified")))
        .drop("_section", "_name")
    )


def add_industry(
    df: DataFrame, code: str = "commodity_code", out: str = "industry_sector"
) -> DataFrame:
    """Industry of each code: its section, or its division inside the split section."""
    spark = df.sparkSession
    names = sections(spark).select(
        F.col("section").alias("_code"), F.col("section_industry").alias("_industry")
    )
    table = divisions(spark)
    split = F.col("_section_of_code") == SPLIT_SECTION
    return (
        add_section(df, code, "_section_of_code")
        .withColumn("_division", F.when(split, _division_key(_code(code))))
        .join(F.broadcast(table), F.col("_division") == F.col("division_key"), "left")
        .join(F.broadcast(names), F.col("_section_of_code") == F.col("_code"), "left")
        .withColumn(out, F.coalesce("division_industry", "_industry"))
        .drop(
            "_section_of_code", "_division", "division_key", "division_industry", "_code", "_industry"
        )
    )


def classified_codes(df: DataFrame, code: str = "commodity_code") -> DataFrame:
    """Distinct codes with their section, section name and industry."""
    return add_industry(add_section_name(add_section(df.select(code).distinct(), code)), code)
