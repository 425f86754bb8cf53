"""Treated-minus-control effects on log1p(counts per million), top features and magnitudes.

Effects are kept sparse: a feature that neither side has counts of has an effect of 0 and no
row. Statistics and rankings that run over all features take the number of features and put
the implied zeros where they belong, so nothing is crossed with the feature list.

Defined results: a side without counts has values of 0; ties in absolute effect are ordered by
feature; a contrast without members on either side is skipped; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.functions.numbering import number_within
from assaylake.operators.harmonize import only_datasets
from assaylake.operators.pseudobulk import log1p_cpm


def _delta(sides: DataFrame, key: list[str], treated_lib: Column, control_lib: Column, scale: float) -> DataFrame:
    t = log1p_cpm(F.coalesce("treated_sum", F.lit(0.0)), treated_lib, scale)
    c = log1p_cpm(F.coalesce("control_sum", F.lit(0.0)), control_lib, scale)
    return sides.select(*key, "feature_id", t.alias("treated_log1p_cpm"), c.alias("control_log1p_cpm")).withColumn(
        "effect_size", F.col("treated_log1p_cpm") - F.col("control_log1p_cpm")
    )


def intervention_effects(
    sums: DataFrame, groups: DataFrame, min_cells: int = 50, scale: float = 1e6, datasets: list[str] | None = None
) -> DataFrame:
    """Each treated group (of the named data sets) against all control groups of its data set, summed once.

    A data set without controls, or without a treated group of ``min_cells``, gives no rows.
    """
    sums, groups = only_datasets(sums, datasets), only_datasets(groups, datasets)
    roles = groups.select("group_id", "dataset_id", (F.col("is_control") == "true").alias("control"), "cell_count", "perturbation_id", "first_ord")
    treated = roles.where(~F.col("control") & (F.col("cell_count") >= min_cells))
    treated = number_within(treated, "dataset_id", ["first_ord"]).withColumn(
        "contrast_id", F.format_string("%s_contrast_%07d", "dataset_id", "number")
    )
    pooled = sums.join(
        roles.where("control").select("dataset_id", "group_id"), ["dataset_id", "group_id"], "left_semi"
    ).groupBy("dataset_id", "feature_id").agg(F.sum("count_sum").alias("control_sum"))
    control_lib = pooled.groupBy("dataset_id").agg(F.sum("control_sum").alias("control_lib"))
    key = ["dataset_id", "contrast_id"]
    own = sums.join(treated.select(*key, "group_id", "perturbation_id"), ["dataset_id", "group_id"]).select(*key, "feature_id", "count_sum")
    libs = treated.select(*key, "perturbation_id").join(
        own.groupBy(*key).agg(F.sum("count_sum").alias("treated_lib")), key, "left"
    ).join(control_lib, "dataset_id").fillna(0.0, ["treated_lib"])
    # both sides as rows of one table: the sum over them aligns the features without an outer join
    a = own.select(*key, "feature_id", F.col("count_sum").alias("treated_sum"), F.lit(None).cast("double").alias("control_sum"))
    b = libs.select(*key).join(pooled, "dataset_id").select(*key, "feature_id", F.lit(None).cast("double").alias("treated_sum"), "control_sum")
    sides = a.unionByName(b).groupBy(*key, "feature_id").agg(F.sum("treated_sum").alias("treated_sum"), F.sum("control_sum").alias("control_sum"))
    return _delta(sides.join(libs, key), [*key, "perturbation_id"], F.col("treated_lib"), F.col("control_lib"), scale)


def pooled_effects(
    sums: DataFrame,
    group_of: DataFrame | None,
    links: DataFrame,
    controls: DataFrame,
    contrasts: DataFrame,
    scale: float = 1e6,
    include: tuple[str, ...] = ("pass", "warn")
) -> DataFrame:
    """Effects of the pooled contrasts with an included status.

    links: (contrast_id, condition_id, match_key) of treated conditions; controls: (match_key,
    control_condition_id); group_of: (condition_id, group_key), or None where conditions are named by
    their group key; sums by group_key. Controls are summed once for each stratum, whatever the
    number of contrasts that use it.
    """
    used = contrasts.where(F.col("status").isin(*include)).select("contrast_id", "status", "perturbation_id")
    links = links.join(used.select("contrast_id"), "contrast_id", "left_semi")
    key = ["dataset_id", "contrast_id"]
    controls = controls.withColumnRenamed("control_condition_id", "condition_id")
    keyed = lambda df: df.withColumnRenamed("condition_id", "group_key") if group_of is None else df.join(group_of, "condition_id")
    treated = keyed(links).select("contrast_id", "group_key").join(sums, "group_key")
    strata = keyed(controls).select("match_key", "group_key").join(sums, "group_key")
    strata = strata.groupBy("match_key", "dataset_id", "feature_id").agg(F.sum("count_sum").alias("count_sum"))
    pooled = links.select("contrast_id", "match_key").distinct().join(strata, "match_key")
    role = lambda df, t, c: df.select(*key, "feature_id", t.alias("treated_sum"), c.alias("control_sum"))
    none, count = F.lit(None).cast("double"), F.col("count_sum")
    sides = role(treated, count, none).unionByName(role(pooled, none, count)).groupBy(*key, "feature_id").agg(
        F.sum("treated_sum").alias("treated_sum"), F.sum("control_sum").alias("control_sum")
    )
    libs = sides.groupBy(*key).agg(
        F.coalesce(F.sum("treated_sum"), F.lit(0.0)).alias("treated_lib"), F.coalesce(F.sum("control_sum"), F.lit(0.0)).alias("control_lib")
    )
    return _delta(
        sides.join(libs, key).join(used, "contrast_id"),
        [*key, "status", "perturbation_id"],
        F.col("treated_lib"),
        F.col("control_lib"),
        scale
    )


def top_features(effects: DataFrame, n: int = 100) -> DataFrame:
    """The n features of each contrast with the largest absolute effect, ranked.

    Rank limits are applied before the shuffle, so a contrast sends at most n rows per task.
    """
    w = Window.partitionBy("dataset_id", "contrast_id").orderBy(F.abs("effect_size").desc(), "feature_id")
    return effects.withColumn("rank_abs_effect", F.row_number().over(w)).where(F.col("rank_abs_effect") <= n)


def pad_top_features(top: DataFrame, features: DataFrame, n: int = 100) -> DataFrame:
    """Fill up contrasts of fewer than n rows with features of effect 0, in feature order.

    features: (dataset_id, feature_id). Of each data set only the first 2n can be needed.
    """
    key = ["dataset_id", "contrast_id"]
    first = features.withColumn(
        "at", F.row_number().over(Window.partitionBy("dataset_id").orderBy("feature_id"))
    ).where(F.col("at") <= 2 * n).drop("at")
    short = top.groupBy(*key).agg(F.count("*").alias("have"), F.first("perturbation_id").alias("perturbation_id")).where(F.col("have") < n)
    zeros = short.join(first, "dataset_id").join(top.select(*key, "feature_id"), [*key, "feature_id"], "left_anti")
    rank = F.col("have") + F.row_number().over(Window.partitionBy(*key).orderBy("feature_id"))
    more = zeros.withColumn("rank_abs_effect", rank.cast("int")).where(F.col("rank_abs_effect") <= n)
    nil = F.lit(0.0)
    more = more.select(
        "dataset_id",
        "contrast_id",
        "perturbation_id",
        "feature_id",
        nil.alias("treated_log1p_cpm"),
        nil.alias("control_log1p_cpm"),
        nil.alias("effect_size"),
        "rank_abs_effect"
    )
    return top.select(more.columns).unionByName(more)


def zero_aware_percentile(values: Column, zeros: Column, q: float) -> Column:
    """Percentile (linear) of non-negative values in an array and so many implied zeros."""
    ranked = F.array_sort(values)
    at = (F.size(ranked) + zeros - 1) * q
    pick = lambda i: F.when(i < zeros, 0.0).otherwise(F.get(ranked, (i - zeros).cast("int")))
    low = F.floor(at)
    return pick(low) + (pick(F.ceil(at)) - pick(low)) * (at - low)


def effect_magnitudes(effects: DataFrame, n_features: DataFrame) -> DataFrame:
    """Per data set: median and 90th percentile of the contrasts' largest, median of their 95th percentile.

    n_features: (dataset_id, features). A contrast's values, one per feature that was counted,
    are a bounded group: as many as the data set has features.
    """
    each = effects.groupBy("dataset_id", "contrast_id").agg(F.collect_list(F.abs("effect_size")).alias("v")).join(n_features, "dataset_id")
    zeros = F.greatest(F.lit(0), F.col("features") - F.size("v"))
    each = each.select(
        "dataset_id",
        "features",
        F.coalesce(F.array_max("v"), F.lit(0.0)).alias("most"),
        zero_aware_percentile(F.col("v"), zeros, 0.95).alias("p95")
    )
    return each.groupBy("dataset_id").agg(
        F.count("*").alias("contrasts"),
        F.max("features").alias("features"),
        F.expr("percentile(most, 0.5)").alias("median_max_abs"),
        F.expr("percentile(most, 0.9)").alias("p90_max_abs"),
        F.expr("percentile(p95, 0.5)").alias("median_p95_abs")
    )
