"""Curation: dropping cells with their counts, repairing labels, comparing tables.

Defined results: a null label is dropped, the text ``nan`` only if asked for; null keys match
nothing in a repair; of several repair rows of a key the last by order wins; comparing two
empty tables passes; repeated rows count with their multiplicity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.numbering import number_rows
from assaylake.functions.text import strip


def with_perturbation(cells: DataFrame, column: str, literal_nan: bool = False) -> DataFrame:
    """Cells that have a label, with nperts 0 for controls and 1 for the rest."""
    c = F.col(column)
    keep = c.isNotNull() & (F.lower(c) != "nan") if literal_nan else c.isNotNull()
    return cells.where(keep).withColumn("nperts", F.when(F.lower(c) == "control", 0).otherwise(1))


def filter_rows(
    cells: DataFrame,
    counts: DataFrame,
    keep: Column,
    updates: dict[str, Column] | None = None,
    key: tuple[str, ...] = ("dataset_id", "cell_ord")
) -> tuple[DataFrame, DataFrame]:
    """Cells that are kept, with overwritten or added columns, and the counts of just these."""
    kept = cells.where(keep)
    return kept.withColumns(updates or {}), counts.join(kept.select(*key), list(key), "left_semi")


def accounting(before: DataFrame, after: DataFrame) -> DataFrame:
    """Cells before and after curation, by data set."""
    b = before.groupBy("dataset_id").agg(F.count("*").alias("cells_before"))
    a = after.groupBy("dataset_id").agg(F.count("*").alias("cells_after"))
    out = b.join(a, "dataset_id", "left").fillna(0)
    return out.withColumns(
        {
            "cells_excluded": F.col("cells_before") - F.col("cells_after"),
            "mode": F.when(F.col("cells_before") == F.col("cells_after"), "passthrough").otherwise("curated")
        }
    )


def repair_labels(cells: DataFrame, identities: DataFrame, barcode: str, controls: list[str]) -> DataFrame:
    """Guides of an identity table joined to cells by barcode; control guides become ``control``.

    identities: barcode, ord, guide, reads, umis. Cells without an identity have matched false.
    """
    last = identities.groupBy("barcode").agg(F.max_by(F.struct("guide", "reads", "umis"), "ord").alias("r"))
    whole = lambda c: F.coalesce(strip(F.col(c).cast("string")).try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))
    ctl = F.col("r.guide").isin(controls)
    out = cells.join(last, cells[barcode] == last["barcode"], "left").drop(last["barcode"])
    hit = F.col("r").isNotNull()
    return out.withColumns({
        "matched": hit,
        "perturbation": F.when(ctl, "control").otherwise(F.col("r.guide")),
        "control_status": F.when(hit, F.when(ctl, "negative_control").otherwise("targeting")),
        "read_count": F.when(hit, whole("r.reads")).otherwise(0),
        "umi_count": F.when(hit, whole("r.umis")).otherwise(0),
        "nperts": F.when(hit & ctl, 0).otherwise(1),
    }).drop("r")


def compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: rows of either side that the other lacks, an order-free digest of both, and status.

    Rows are counted on both sides in one aggregation, so each table is shuffled once.
    """
    cols = left.columns
    both = left.select(*cols, F.lit(1).alias("__l"), F.lit(0).alias("__r")).unionByName(
        right.select(*cols, F.lit(0).alias("__l"), F.lit(1).alias("__r"))
    )
    each = both.groupBy(*cols).agg(F.sum("__l").alias("__l"), F.sum("__r").alias("__r")).withColumn("__h", F.xxhash64(*cols))
    odd = lambda s: F.coalesce(
        F.bit_xor(F.when(F.col(s) % 2 == 1, F.col("__h")).otherwise(F.lit(0).cast("bigint"))), F.lit(0).cast("bigint")
    )
    more = lambda a, b: F.coalesce(F.sum(F.greatest(F.lit(0), F.col(a) - F.col(b))), F.lit(0))
    out = each.agg(
        F.coalesce(F.sum("__l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("__r"), F.lit(0)).alias("right_rows"),
        more("__l", "__r").alias("only_left"),
        more("__r", "__l").alias("only_right"),
        odd("__l").alias("left_digest"),
        odd("__r").alias("right_digest")
    )
    return out.withColumn("status", F.when((F.col("only_left") == 0) & (F.col("only_right") == 0), "pass").otherwise("fail"))


def digest(rows: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """(by, n_rows, digest) of each group's rows, whatever their order: 60 bits of each row's checksum, joined by xor.

    Rows have to be distinct, as a row given twice would cancel itself; nulls are left out of a row's text.
    """
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    bits = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    return rows.groupBy(by).agg(F.count("*").alias("n_rows"), F.bit_xor(bits).alias("digest"))


def islands(ordinals: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Contiguous runs of ordinals of each key: (key, first, last, n).

    A run starts where the ordinal before is missing and ends where the next one is. In the
    order of key and ordinal the starts and the ends alternate, so the n-th start belongs to the
    n-th end, and no key's rows have to meet in one task.
    """
    rows = ordinals.select(F.col(key).alias("k"), F.col(ordinal).cast("bigint").alias("o")).where("k is not null and o is not null").distinct()
    edge = lambda step: number_rows(rows.join(rows.select("k", (F.col("o") + step).alias("o")), ["k", "o"], "left_anti"), ["k", "o"])
    ends = edge(-1).select("number", F.col("o").alias("last"))
    return edge(1).join(ends, "number").select(F.col("k").alias(key), F.col("o").alias("first"), "last", (F.col("last") - F.col("o") + 1).alias("n"))
