"""Text functions whose behaviour differs from the nearest Spark built-in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def length_trimmed(s: Column) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(s))


def stuff(s: Column, start: int, length: int, replacement: str) -> Column:
    """Delete ``length`` characters at ``start`` and put text there."""
    return F.overlay(s, F.lit(replacement), F.lit(start), F.lit(length))


def quote_name(s: Column) -> Column:
    """[name] with closing brackets doubled."""
    return F.concat(F.lit("["), F.replace(s, F.lit("]"), F.lit("]]")), F.lit("]"))


def remove_matching(s: Column, pattern: str) -> Column:
    """Drop every character that matches a pattern."""
    return F.regexp_replace(s, pattern, "")


def split_to_rows(df: DataFrame, column: str, sep: str, keep_empty: bool) -> DataFrame:
    """Delimited text to rows (pos, element), positions from 1. The separator is plain
    text. Without empty elements the positions are counted over the remaining ones."""
    parts = F.split(column, "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E")
    if not keep_empty:
        parts = F.filter(parts, lambda x: x != "")
    others = [x for x in df.columns if x != column]
    rows = df.select(*others, F.posexplode(parts).alias("_p", "element"))
    return rows.select(*others, (F.col("_p") + 1).cast("bigint").alias("pos"), "element")


def contains_word(s: Column, *terms: str) -> Column:
    """True if any of the terms occurs as a whole word, in any case. A word is a
    run of letters; the search stops at the first hit."""
    quoted = "|".join(f"\\Q{x}\\E" for x in terms)
    return F.rlike(s, F.lit(f"(?iu)(?<!\\p{{L}})(?:{quoted})(?!\\p{{L}})"))
