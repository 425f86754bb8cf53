"""Sums of counts per group of cells.

Cells carry an ordinal; counts are long triplets (dataset_id, cell_ord, feature_id, value), so
the matrix encoding of the source makes no difference. The sum is a join of counts with the
cells' groups and one aggregation with partial sums before the shuffle.

Defined results: cells without counts form a group with no sums; counts of unknown cells are
dropped; null values count as 0; zero sums are not stored; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.numbering import number_within
from assaylake.functions.text import blank
from assaylake.operators.harmonize import GRAINS


def group_key(keys: list[str]) -> Column:
    """One short text for the values of all keys of a group, so that joins carry that and not the keys."""
    return F.md5(F.to_json(F.array(*[blank(F.col(k).cast("string")) for k in keys])))


def groups(cells: DataFrame, grain: str) -> DataFrame:
    """Groups of a grain, numbered within each data set in the order they are first seen, with their key."""
    keys = GRAINS[grain]
    each = cells.select(*[blank(F.col(k).cast("string")).alias(k) for k in keys], "cell_ord").groupBy(*keys).agg(
        F.count("*").alias("cell_count"), F.min("cell_ord").alias("first_ord")
    )
    label = F.format_string(f"%s_{grain.replace('-', '_')}_%07d", "dataset_id", "number")
    return number_within(each, "dataset_id", ["first_ord"]).select(
        label.alias("group_id"), *keys, "cell_count", "first_ord", group_key(keys).alias("group_key")
    )


def keyed_cells(cells: DataFrame, grain: str) -> DataFrame:
    """(dataset_id, cell_ord, group_key) of every cell, without a join: the key is made from the cell itself."""
    return cells.select("dataset_id", "cell_ord", group_key(GRAINS[grain]).alias("group_key"))


def cell_groups(cells: DataFrame, grouped: DataFrame, grain: str) -> DataFrame:
    """(dataset_id, cell_ord, group_id) of every cell."""
    return keyed_cells(cells, grain).join(grouped.select("group_id", "group_key"), "group_key").select("dataset_id", "cell_ord", "group_id")


def pseudobulk(counts: DataFrame, membership: DataFrame, on: tuple[str, ...] = ("dataset_id", "cell_ord"), group: str = "group_id") -> DataFrame:
    """(dataset_id, group, feature_id, count_sum) with zero sums left out.

    on: what names a cell, ``cell_ord`` alone where that is unique over all data sets; then the
    counts are joined once and need no data set of their own.
    """
    joined = counts.select(*on, "feature_id", "value").join(membership, list(on))
    return joined.groupBy("dataset_id", group, "feature_id").agg(
        F.sum(F.coalesce(F.col("value"), F.lit(0)).cast("double")).alias("count_sum")
    ).where("count_sum <> 0")


def library_sizes(sums: DataFrame, key: list[str]) -> DataFrame:
    return sums.groupBy(*key).agg(F.sum("count_sum").alias("library_size"), F.count("*").alias("n_features"))


def log1p_cpm(count, library, scale: float = 1e6):
    """log(1 + count per ``scale``); 0 where nothing was counted."""
    return F.when(library > 0, F.log1p(count / library * scale)).otherwise(F.lit(0.0))


def normalize_sums(sums: DataFrame, key: list[str], scale: float = 1e6) -> DataFrame:
    """Adds library_size and log1p_cpm; the library is summed apart and joined back."""
    return sums.join(library_sizes(sums, key).select(*key, "library_size"), key).withColumn(
        "log1p_cpm", log1p_cpm(F.col("count_sum"), F.col("library_size"), scale)
    )
