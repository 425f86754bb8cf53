"""Profiles of cell tables and of count matrices.

Defined results: text columns count null and marker texts as missing, number columns null and
NaN; ties among the commonest values are ordered by value; values are compared in code point
order; an empty table gives a profile of zeros and no value counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.functions.text import MISSING_PROFILE, is_missing_profile

# Columns that cell and feature tables should have.
OBS_REQUIRED = ["perturbation"]
OBS_RECOMMENDED = ["cell_line", "celltype", "cell_type", "disease", "organism"]
VAR_RECOMMENDED = ["gene_id", "gene_name", "gene_symbol", "ensembl_id"]


def _missing(df: DataFrame, c: str) -> Column:
    kind = df.schema[c].dataType.typeName()
    col = F.col(f"`{c}`")
    if kind in ("double", "float"):
        return col.isNull() | F.isnan(col)
    return is_missing_profile(col) if kind == "string" else col.isNull()


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, n_rows, missing_count, unique_count) of each column.

    The table is unpivoted and counted per distinct value before distinct values are counted,
    so there is one shuffle of partial counts for all columns.
    """
    columns = columns or df.columns
    cells = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value"), _missing(df, c).alias("missing")
                    ) for c in columns
                ]
            )
        ).alias("x")
    ).select("x.*")
    each = cells.groupBy("column_name", "value", "missing").agg(F.count("*").alias("n"))
    return each.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("missing"), F.col("n")).otherwise(0)).alias("missing_count"),
        F.count_distinct(F.coalesce("value", F.lit("None"))).alias("unique_count")
    )


def value_counts(df: DataFrame, columns: list[str], limit: int = 20) -> DataFrame:
    """The commonest values of each column, missing ones together under ``<missing>``."""
    cells = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
        ).alias("x")
    ).select("x.*")
    gone = F.col("value").isNull() | F.lower("value").isin("", *MISSING_PROFILE)
    each = cells.groupBy("column_name", F.when(gone, "<missing>").otherwise(F.col("value")).alias("value")).agg(F.count("*").alias("n_rows"))
    at = F.row_number().over(Window.partitionBy("column_name").orderBy(F.desc("n_rows"), "value"))
    return each.withColumn("place", at).where(F.col("place") <= limit)


def table_profile(df: DataFrame, watched: list[str], limit: int = 20) -> DataFrame:
    """(column_name, place, watched, n_rows, missing_count, unique_count, commonest) of each column in order.

    commonest: the commonest values of the watched columns with their numbers of rows, as text.
    """
    places = df.sparkSession.createDataFrame([(c, i, c in watched) for i, c in enumerate(df.columns, 1)], "column_name string, place int, watched boolean")
    top = value_counts(df, [c for c in df.columns if c in watched], limit)
    each = F.array_sort(F.collect_list(F.struct("place", F.concat_ws("=", "value", F.col("n_rows").cast("string")).alias("t"))))
    top = top.groupBy("column_name").agg(F.array_join(F.transform(each, lambda x: x["t"]), "; ").alias("commonest"))
    return places.join(column_profile(df), "column_name", "left").fillna(0, ["n_rows", "missing_count", "unique_count"]).join(top, "column_name", "left")


def category_sample(df: DataFrame, columns: list[str], limit: int = 20) -> DataFrame:
    """(column_name, n_sampled, categories): the first values of each column in code point order.

    Values are made distinct and cut to ``limit`` of a column before they are brought together.
    """
    cells = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
        ).alias("x")
    ).select("x.*")
    each = cells.where("value is not null").distinct()
    first = each.withColumn("at", F.row_number().over(Window.partitionBy("column_name").orderBy("value"))).where(F.col("at") <= limit)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"])
    return first.groupBy("column_name").agg(F.count("*").alias("n_sampled"), F.array_join(ordered, ";").alias("categories"))


def counts_locations(locations: DataFrame) -> DataFrame:
    """(dataset_id, x_present, raw_present, layers) from rows of dataset_id and location.

    A location is ``X``, ``raw/...`` or ``layers/name``; layers are the sorted names in one text.
    """
    at = F.col("location")
    layers = F.array_sort(F.collect_set(F.when(at.startswith("layers/"), F.substring(at, 8, 1 << 20))))
    return locations.where(at.isNotNull()).groupBy("dataset_id").agg(
        F.bool_or(at == "X").alias("x_present"), F.bool_or(at.startswith("raw")).alias("raw_present"), F.array_join(layers, ";").alias("layers")
    )


def integer_like(value: Column) -> Column:
    """Finite and equal to a whole number within the usual tolerance."""
    r = F.rint(value)
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf")) & (F.abs(value - r) <= 1e-8 + 1e-5 * F.abs(r))


def matrix_profile(counts: DataFrame, n_obs: DataFrame, n_vars: DataFrame) -> DataFrame:
    """Shape, non-zero values, density and whether all values are whole numbers, by data set."""
    v = F.col("value").cast("double")
    nnz = counts.groupBy("dataset_id").agg(
        F.count(F.when(v != 0, 1)).alias("nnz"),
        F.bool_and(integer_like(v)).alias("integer_like"),
        F.min(v).alias("least"),
        F.max(v).alias("most")
    )
    out = n_obs.join(n_vars, "dataset_id").join(nnz, "dataset_id", "left").fillna(0, ["nnz"])
    return out.withColumn("density", F.col("nnz") / F.nullif(F.col("n_obs") * F.col("n_vars"), F.lit(0)))


def column_warnings(obs_columns: list[str], var_columns: list[str]) -> list[str]:
    """What is missing from the columns of a cell and a feature table."""
    out = []
    if lack := sorted(set(OBS_REQUIRED) - set(obs_columns)):
        out.append("missing required obs columns: " + ", ".join(lack))
    if lack := sorted(set(OBS_RECOMMENDED) - set(obs_columns)):
        out.append("missing recommended obs columns: " + ", ".join(lack))
    if not set(VAR_RECOMMENDED) & set(var_columns):
        out.append("missing recommended gene identifier columns: " + ", ".join(sorted(VAR_RECOMMENDED)))
    return out


def profile_warnings(obs_columns: list[str], var_columns: list[str], shapes: DataFrame) -> DataFrame:
    """(dataset_id, warnings) from column names and the shape of each data set.

    shapes: dataset_id, n_obs, n_vars, obs_rows, var_rows, count_layers, integer_like. Warnings
    keep their order, each text once; a null number of rows is not compared.
    """
    named = [F.lit(w) for w in column_warnings(obs_columns, var_columns)]
    found = [
        F.when(F.coalesce("count_layers", F.lit(0)) == 0, "no raw object or count layer found; X is treated as counts"),
        F.when(~F.coalesce("integer_like", F.lit(False)), "sampled X values are not integer-like"),
        F.when(F.col("obs_rows") != F.col("n_obs"), "obs row count does not match X rows"),
        F.when(F.col("var_rows") != F.col("n_vars"), "var row count does not match X columns"),
    ]
    return shapes.select("dataset_id", F.array_distinct(F.filter(F.array(*named, *found), lambda w: w.isNotNull())).alias("warnings"))
