"""Count matrices of any encoding as long triplets (dataset_id, cell_ord, feature_ord, value).

Defined results: zeros are not stored; a code below 0 or without a category is null; rows
without entries give no triplets; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _spans(pointers: DataFrame, name: str) -> DataFrame:
    """One row per stored position: pointers has dataset_id, ord, start and stop (exclusive)."""
    used = pointers.where("stop > start")
    return used.select("dataset_id", F.col("ord").alias(name), F.explode(F.sequence(F.col("start"), F.col("stop") - 1)).alias("pos"))


def csr_triplets(pointers: DataFrame, entries: DataFrame) -> DataFrame:
    """Row-compressed: pointers by cell, entries (dataset_id, pos, index, value) by feature."""
    rows = _spans(pointers, "cell_ord").join(entries, ["dataset_id", "pos"])
    return rows.where("value <> 0").select("dataset_id", "cell_ord", F.col("index").alias("feature_ord"), "value")


def csc_triplets(pointers: DataFrame, entries: DataFrame) -> DataFrame:
    """Column-compressed: pointers by feature, entries by cell."""
    rows = _spans(pointers, "feature_ord").join(entries, ["dataset_id", "pos"])
    return rows.where("value <> 0").select("dataset_id", F.col("index").alias("cell_ord"), "feature_ord", "value")


def dense_triplets(rows: DataFrame) -> DataFrame:
    """Dense rows: (dataset_id, cell_ord, values) with values an array over the features."""
    return rows.select("dataset_id", "cell_ord", F.posexplode("values").alias("feature_ord", "value")).where("value is not null and value <> 0")


def triplets(encoding: str, **tables: DataFrame) -> DataFrame:
    """Triplets of a matrix of the named encoding; any other one raises ``ValueError``.

    ``csr_matrix`` and ``csc_matrix`` take pointers and entries, ``array`` takes rows.
    """
    readers = {"csr_matrix": csr_triplets, "csc_matrix": csc_triplets, "array": dense_triplets}
    if encoding not in readers:
        raise ValueError(f"unsupported matrix encoding: {encoding}")
    return readers[encoding](**tables)


def decode_categories(cells: DataFrame, codes: str, categories: DataFrame, name: str) -> DataFrame:
    """Category names in place of codes; categories has dataset_id, code and category."""
    named = categories.select("dataset_id", F.col("code").alias(codes), F.col("category").alias(name))
    return cells.join(named, ["dataset_id", codes], "left").drop(codes)


def index_column(columns: list[str], named: str | None = None) -> str:
    """The column that names the rows: the one that the table's attributes name, else ``_index``, else ``index``.

    ``ValueError`` if the table has none of them.
    """
    for c in (named, "_index", "index"):
        if c and c in columns:
            return c
    raise ValueError("no index column among: " + ", ".join(columns))


def feature_names(var: DataFrame) -> DataFrame:
    """Adds the name of each feature: its id, else its gene, else its symbol, else empty."""
    given = [F.nullif(F.col(c), F.lit("")) for c in ("feature_id", "gene_id", "gene_symbol") if c in var.columns]
    return var.withColumn("feature_name", F.coalesce(*given, F.lit("")))
