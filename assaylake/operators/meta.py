"""Genes that respond alike across data sets.

Defined results: hits of contrasts without an included status are dropped, as are hits without
a gene; effects that are no number count as 0; a zero effect is neither positive nor negative
but stays in the denominators; equal ranks are ordered by gene; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaylake.functions.text import to_double

RANKING = ["dataset_count", "dataset_sign_consistency", "sign_consistency", "hit_count", "mean_abs_effect"]


def included_hits(hits: DataFrame, contrasts: DataFrame, include: tuple[str, ...] = ("pass", "warn")) -> DataFrame:
    """(dataset_id, contrast_id, gene_id, effect, status) of hits whose contrast is included."""
    status = contrasts.where(F.col("status").isin(*include)).select("dataset_id", "contrast_id", "status").distinct()
    return hits.select(
        "dataset_id", "contrast_id", "gene_id", to_double(F.col("effect_size").cast("string")).alias("effect")
    ).where("gene_id is not null").join(status, ["dataset_id", "contrast_id"])


def gene_consistency(hits: DataFrame) -> DataFrame:
    """One row per gene: counts, signs at both levels, effects and the conserved response score."""
    e = F.col("effect")
    median = hits.groupBy("gene_id", "dataset_id").agg(F.median("effect").alias("m"))
    per_dataset = median.groupBy("gene_id").agg(
        (
            F.greatest(F.count(F.when(F.col("m") > 0, 1)), F.count(F.when(F.col("m") < 0, 1))) / F.count("*")
        ).alias("dataset_sign_consistency")
    )
    genes = hits.groupBy("gene_id").agg(
        F.count_distinct("dataset_id").alias("dataset_count"),
        F.count_distinct("dataset_id", "contrast_id").alias("contrast_count"),
        F.count("*").alias("hit_count"),
        F.count(F.when(F.col("status") == "pass", 1)).alias("pass_hits"),
        F.count(F.when(F.col("status") == "warn", 1)).alias("warn_hits"),
        F.count(F.when(e > 0, 1)).alias("positive_hits"),
        F.count(F.when(e < 0, 1)).alias("negative_hits"),
        F.avg(e).alias("mean_effect"),
        F.median(e).alias("median_effect"),
        F.avg(F.abs(e)).alias("mean_abs_effect"),
        F.max(F.abs(e)).alias("max_abs_effect"),
        F.concat_ws(";", F.array_sort(F.collect_set("dataset_id"))).alias("datasets"),
    )
    out = genes.join(per_dataset, "gene_id").withColumn("sign_consistency", F.greatest("positive_hits", "negative_hits") / F.col("hit_count"))
    score = F.col("dataset_count") * F.col("sign_consistency") * F.log10(F.col("hit_count") + 1) * F.col("mean_abs_effect")
    return out.withColumn("conserved_response_score", score)


def meta_summary(genes: DataFrame, top_n: int = 100) -> DataFrame:
    """The first genes by five descending keys, ranked. The score is reported, not ranked by."""
    order = [*[F.col(c).desc() for c in RANKING], F.col("gene_id")]
    # the window sees the first rows only
    return genes.orderBy(*order).limit(top_n).withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def dataset_accounting(hits: DataFrame, contrasts: DataFrame, include: tuple[str, ...] = ("pass", "warn")) -> DataFrame:
    """Contrasts and top hits of each data set, given and included."""
    inside = F.col("status").isin(*include)
    c = contrasts.groupBy("dataset_id").agg(
        F.count_distinct("contrast_id").alias("input_contrasts"),
        F.count_distinct(F.when(inside, F.col("contrast_id"))).alias("included_contrasts")
    )
    kept = hits.select("dataset_id", "contrast_id").join(
        contrasts.select("dataset_id", "contrast_id", "status").distinct(), ["dataset_id", "contrast_id"], "left"
    )
    h = kept.groupBy("dataset_id").agg(F.count("*").alias("input_top_gene_hits"), F.count(F.when(inside, 1)).alias("included_top_gene_hits"))
    return c.join(h, "dataset_id", "left").fillna(0)


def recurrence(hits: DataFrame, top_n: int = 25) -> DataFrame:
    """Genes that come up most often among the top hits, whatever their contrasts' status."""
    effect = F.abs(to_double(F.col("effect_size").cast("string")))
    genes = hits.where("gene_id is not null").groupBy("gene_id").agg(
        F.count_distinct("dataset_id").alias("dataset_count"), F.count("*").alias("hit_count"), F.max(effect).alias("max_abs_effect")
    )
    return genes.orderBy(F.desc("dataset_count"), F.desc("hit_count"), F.desc("max_abs_effect"), "gene_id").limit(top_n)
