"""Text predicates and conversions shared by all stages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "missing".
MISSING_QC = ["", "nan", "none", "null", "na", "<missing>"]
MISSING_PROFILE = ["nan", "none", "null", "na"]


def strip(c: Column) -> Column:
    """Trim every Unicode white space, not only blanks."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_missing_qc(c: Column) -> Column:
    """Null, or one of the marker texts after trimming and lower-casing."""
    return c.isNull() | F.lower(strip(c)).isin(MISSING_QC)


def is_missing_profile(c: Column) -> Column:
    """The profiler's narrower rule: no trimming, and the empty text is a value."""
    return c.isNull() | F.lower(c).isin(MISSING_PROFILE)


def normalize(c: Column) -> Column:
    """Trimmed, lower case, underscores as hyphens."""
    return F.replace(F.lower(strip(c)), F.lit("_"), F.lit("-"))


def to_double(c: Column) -> Column:
    """Invalid or missing numbers count as 0.0."""
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def to_count(c: Column) -> Column:
    """Cell counts given as text; empty or invalid counts as 0."""
    return F.coalesce(F.nullif(c, F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))


def blank(c: Column) -> Column:
    """Null becomes the empty text, so that missing keys are equal in joins."""
    return F.coalesce(c, F.lit(""))


def sign(c: Column) -> Column:
    return F.signum(c).cast("int")


def text_of(c: Column, kind: str) -> Column:
    """Text of a number or flag as the source tools print it (`True`, `10000000.0`, `1e-05`)."""
    if kind == "boolean":
        return F.when(c.isNull(), "").when(c, "True").otherwise("False")
    if kind in ("double", "float"):
        a = F.abs(c)
        plain = F.regexp_replace(F.format_string("%.12f", c), r"(\.\d+?)0*$", "$1")
        sci = F.regexp_replace(F.lower(c.cast("string")), r"\.0e", "e")
        sci = F.regexp_replace(F.regexp_replace(sci, r"e(-?)(\d)$", "e$1" + "0$2"), r"e(\d)", "e+$1")
        usual = (a == 0) | ((a >= 1e-4) & (a < 1e16))
        return F.when(c.isNull() | F.isnan(c), "").when(usual & (a >= 1e7), plain).when(
            usual & (a < 1e-3) & (a > 0), plain
        ).when(usual, c.cast("string")).otherwise(sci)
    return F.coalesce(c.cast("string"), F.lit(""))


def safe_stem(c: Column) -> Column:
    """Lower-case file stem: letters, digits, dots, hyphens and underscores only."""
    kept = F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}._-]", "_")
    return F.coalesce(F.nullif(F.regexp_replace(kept, "^_+|_+$", ""), F.lit("")), F.lit("dataset"))


def split_ids(c: Column) -> Column:
    """Ids of a list in one text, empty ones left out."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), ";"), lambda x: x != "")
