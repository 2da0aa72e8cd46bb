"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings a CSV scan reads as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# What counts as blank after trimming.
BLANKS = ["", "nan"]

# The Unicode white-space characters. ``trim`` alone removes only spaces.
WHITE_SPACE = "".join(
    map(chr, [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203),
              8232, 8233, 8239, 8287, 12288])
)


def strip(col: Column) -> Column:
    """Remove white space of every kind from both ends.

    A text that begins and ends with a visible ASCII character is left as it is, which two
    comparisons tell; only the others are searched for the characters to remove.
    """
    def visible(c: Column) -> Column:
        return (c >= "!") & (c < "\x7f")

    clean = visible(col) & visible(F.substring(col, -1, 1))
    return F.when(clean, col).otherwise(F.btrim(col, F.lit(WHITE_SPACE)))


def blank_to_null(stripped: Column) -> Column:
    return F.when(~stripped.isin(BLANKS), stripped)


def na_to_null(col: Column) -> Column:
    return F.when(~col.isin(NA_TOKENS), col)


def text_category(col: Column) -> Column:
    """A category as text, with missing values as a category of their own."""
    return F.coalesce(col.cast("string"), F.lit("nan"))
