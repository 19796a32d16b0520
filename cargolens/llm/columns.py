"""Column helpers of the text operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the operators' contracts define it: space and U+0009 to U+000D.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does the same to a text of one-byte characters, and faster."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


#: Bytes of an Arrow batch that goes to a Python worker: documents may be very long, so rows are no measure.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by bytes.

    Called by the operators that run Python, before they make their plan. Without it a batch holds 10,000 documents,
    whatever their size, several times over in the JVM and in the worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def columns_of(df: DataFrame) -> list[Column]:
    """The frame's columns, whatever characters their names have."""
    return [F.col(f"`{c}`") for c in df.columns]


def packed(df: DataFrame, **own: Column) -> DataFrame:
    """All input columns in one struct ``row`` beside the operator's own: no name can clash."""
    return df.select(F.struct(*columns_of(df)).alias("row"), *[c.alias(n) for n, c in own.items()])


def unpacked(df: DataFrame, names: list[str], **own: Column) -> DataFrame:
    """Undo ``packed``: input columns ``names``, of which ``own`` replaces those of the same name (any case) or follows."""
    lower = {n.lower() for n in own}
    # own columns are computed before the input's names are back: an expression can't meet them as lateral aliases
    df = df.select("row", *[c.alias(f"own_{i}") for i, c in enumerate(own.values())])
    kept = [F.col("row").getField(c).alias(c) for c in names if c.lower() not in lower]
    return df.select(*kept, *[F.col(f"own_{i}").alias(n) for i, n in enumerate(own)])


def bucket(value: Column, of: int) -> Column:
    """crc32 of a value as text, modulo ``of``; null for null."""
    return F.crc32(value.cast("string")) % F.lit(of)
