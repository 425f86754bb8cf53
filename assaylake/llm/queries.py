"""Queries of the llm problems over the project's tables, and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm import canonical, encoding, leaks, quantiles, tokens, topn
from assaylake.session import read

VOCABULARY = os.environ.get("ASSAYLAKE_VOCABULARY", tokens.VOCABULARIES["byte_bpe_50k"])
METRICS = ["median_effect", "max_abs_effect"]
EPS = 0.005


def _typed(spark: SparkSession, d: str) -> DataFrame:
    return canonical.map_typed(
        read(spark, d, "conditions"), "condition_id", ["perturbation_id", "control_status"], read(spark, d, "canonical_values")
    )


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _typed(spark, d).select("condition_id", "field_name", "entry_id").distinct()


def p2_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Values that stand for no entry, with how often each was typed."""
    return _typed(spark, d).where("entry_id = -1").groupBy("field_name", "typed").agg(F.count("*").alias("n_rows"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return topn.top_n(read(spark, d, "meta_summary"), "run_id", "conserved_response_score", "gene_id", 10).select("run_id", "place", "gene_id")


def p7_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles per run, per day and over all rows, with the bound of their rank error."""
    return quantiles.percentiles_by_scope(read(spark, d, "meta_summary"), "run_id", "computed_at", METRICS, EPS)


def p7_within_bound(spark: SparkSession, d: str) -> DataFrame:
    """Counts each percentile's true rank in the whole table and compares it with the bound."""
    answers = p7_percentiles(spark, d)
    asked = answers.select(
        "scope",
        "scope_key",
        "metric",
        "n",
        "rank_error",
        F.explode(F.map_from_arrays(F.array(F.lit(0.5), F.lit(0.9), F.lit(0.99)), F.array("p50", "p90", "p99"))).alias("q", "answer")
    )
    rows = read(spark, d, "meta_summary")
    each = rows.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(s).alias("scope"), k.alias("scope_key")) for s,
                    k in (("run", F.col("run_id")), ("day", F.date_format(F.to_date("computed_at"), "yyyy-MM-dd")), ("all", F.lit("all")))
                ]
            )
        ).alias("s"),
        F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS]).alias("vs"),
    ).select("s.scope", "s.scope_key", F.explode("vs").alias("v")).select("scope", "scope_key", "v.metric", "v.value").where("value is not null and not isnan(value)")
    counted = each.groupBy("scope", "scope_key", "metric", "value").agg(F.count("*").alias("c"))
    key = ["scope", "scope_key", "metric"]
    ranks = asked.join(counted, key).groupBy(*key, "q", "n", "rank_error").agg(
        F.sum(F.when(F.col("value") < F.col("answer"), F.col("c")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("value") <= F.col("answer"), F.col("c")).otherwise(0)).alias("upto")
    )
    rank = F.greatest(F.lit(1), F.ceil(F.round(F.col("q") * F.col("n"), 9)))
    off = F.greatest(F.lit(0), F.col("below") + 1 - rank, rank - F.col("upto"))
    return ranks.select(
        *key,
        F.col("n").alias("n_values"),
        "q",
        ((off <= F.col("rank_error") + 1e-9) & (off <= F.greatest(F.lit(0.0), F.lit(EPS) * F.col("n")))).alias("within")
    )


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_corpus(read(spark, d, "documents"), "doc_id", "text", VOCABULARY)


def p8_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Whether the decoded ids of each document are its text again."""
    docs = read(spark, d, "documents")
    back = tokens.decode_corpus(p8_ids(spark, d), "doc_id", "ids", VOCABULARY)
    own = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("own"))
    return back.select("doc_id", F.md5("text").alias("back")).join(own, "doc_id").select(
        "doc_id", F.col("own").alias("text_md5"), (F.col("own") == F.col("back")).alias("same")
    )


def _leaks(spark: SparkSession, d: str, near: float | None) -> DataFrame:
    items = read(spark, d, "eval_items")
    return leaks.find_leaks(read(spark, d, "documents"), "doc_id", "text", items, "item_id", ["prompt", "solution"], near=near)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d, None).where("exact").select("doc_id", "item_id")


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    """Each leaked item: documents that hold it word for word, those that seem to paraphrase it, and
    those that hold its answer, word for word or at least half of it in order."""
    return _leaks(spark, d, 0.7).groupBy("item_id").agg(
        F.count(F.when(F.col("exact"), 1)).alias("documents"),
        F.count(F.when(~F.col("exact") & (F.col("lcs_share") >= 0.8), 1)).alias("paraphrases"),
        F.count(F.when(F.col("exact_answer") | (F.col("answer_share") >= 0.5), 1)).alias("answers")
    )


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return encoding.restore_garbled(read(spark, d, "documents"), "doc_id", "text").select("doc_id", "restored_md5")


def p10_channels(spark: SparkSession, d: str) -> DataFrame:
    """How often each pair of encodings was mixed up, and how often characters were lost."""
    found = encoding.restore_garbled(read(spark, d, "documents"), "doc_id", "text")
    return found.select(
        F.explode(F.when(F.size("channels") > 0, F.col("channels")).otherwise(F.array(F.lit("lost")))).alias("channel"),
        (F.col("restored_md5") == "").alias("lost")
    ).groupBy("channel").agg(F.count("*").alias("documents"), F.count(F.when(F.col("lost"), 1)).alias("with_losses"))


QUERIES = {
    "p2_found": p2_found,
    "p2_unmatched": p2_unmatched,
    "p3_found": p3_found,
    "p7_percentiles": p7_percentiles,
    "p7_within_bound": p7_within_bound,
    "p8_ids": p8_ids,
    "p8_round_trip": p8_round_trip,
    "p9_found": p9_found,
    "p9_items": p9_items,
    "p10_found": p10_found,
    "p10_channels": p10_channels,
}

_WORDS = "regexp_extract_all(translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+')"

SQL = {
    "p3_found": """
WITH best AS (
  SELECT run_id, gene_id, max(conserved_response_score + 0.0) AS score FROM meta_summary
  WHERE conserved_response_score IS NOT NULL AND isfinite(conserved_response_score) AND gene_id IS NOT NULL GROUP BY 1, 2
)
SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY score DESC, gene_id) AS place, gene_id FROM best QUALIFY place <= 10
""",
    "p7_within_bound": """
WITH v AS (
  SELECT run_id, strftime(computed_at, '%Y-%m-%d') AS day, 'median_effect' AS metric, median_effect AS value FROM meta_summary
  UNION ALL SELECT run_id, strftime(computed_at, '%Y-%m-%d'), 'max_abs_effect', max_abs_effect FROM meta_summary
), k AS (SELECT * FROM v WHERE value IS NOT NULL AND NOT isnan(value)),
g AS (
  SELECT 'run' AS scope, run_id AS scope_key, metric, count(*) AS n_values FROM k GROUP BY ALL
  UNION ALL SELECT 'day', day, metric, count(*) FROM k GROUP BY ALL
  UNION ALL SELECT 'all', 'all', metric, count(*) FROM k GROUP BY ALL
)
SELECT g.*, q, true AS within FROM g, (SELECT unnest([0.5::DOUBLE, 0.9::DOUBLE, 0.99::DOUBLE]) AS q)
""",
    "p8_round_trip": "SELECT doc_id, md5(coalesce(text, '')) AS text_md5, true AS same FROM documents",
    "p9_found": f"""
WITH parts AS (
  SELECT item_id, {_WORDS.format(c="prompt")} AS w FROM eval_items UNION ALL SELECT item_id, {_WORDS.format(c="solution")} FROM eval_items
), grams AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 11], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS i FROM parts)),
docs AS (SELECT doc_id, {_WORDS.format(c="text")} AS w FROM documents WHERE text IS NOT NULL),
runs AS (SELECT doc_id, array_to_string(w[i:i + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS i FROM docs))
SELECT DISTINCT doc_id, item_id FROM runs JOIN grams USING (g)
""",
}
