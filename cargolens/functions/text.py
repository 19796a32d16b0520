"""Text normalisation and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value, and unit spellings.
MISSING_TEXTS = ("nan", "NaN", "None")
UNIT_SPELLINGS = {
    "Litres Al": "Litres",
    "litres al": "Litres",
    "LITRES AL": "Litres",
}

# The white space of text stripping, the plain blank first.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Without outer white space of any kind."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def normalize_text(c: Column | str, unknown: str = "Unknown") -> Column:
    """Missing to ``unknown``, strip, single blanks, no quote marks, in this order.

    Because missing texts are replaced before stripping, ``' nan '`` ends as ``nan``.
    A pattern is used only on texts with two blanks in a row.
    """
    c = F.col(c) if isinstance(c, str) else c
    text = c.cast("string")
    text = F.when(text.isNull() | text.isin(*MISSING_TEXTS), F.lit(unknown)).otherwise(text)
    text = F.trim(F.translate(text, WHITE_SPACE[1:], " " * (len(WHITE_SPACE) - 1)))
    text = F.when(text.contains("  "), F.regexp_replace(text, " {2,}", " ")).otherwise(text)
    return F.translate(text, "\"'", "")


def map_units(c: Column | str, spellings: dict[str, str] | None = None) -> Column:
    """Replace known unit spellings; leave every other unit as it is."""
    c = F.col(c) if isinstance(c, str) else c
    result = c
    for standard in sorted(set((spellings or UNIT_SPELLINGS).values())):
        variants = [k for k, v in (spellings or UNIT_SPELLINGS).items() if v == standard]
        result = F.when(c.isin(*variants), F.lit(standard)).otherwise(result)
    return result


def shorten(c: Column | str, cut: int, limit: int | None = None) -> Column:
    """First ``cut`` characters and ``...`` for texts longer than ``limit``."""
    c = F.col(c) if isinstance(c, str) else c
    limit = cut if limit is None else limit
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, cut), F.lit("..."))).otherwise(c)
