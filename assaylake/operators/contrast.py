"""Treated conditions held against controls.

Controls are aggregated by each key before they are joined, so a treated condition is never
multiplied by its controls. Membership is kept in two tables as well: which key a contrast uses,
and which controls have that key. Strict matches win over matches of the biological context, those
over any control of the data set; existence decides, not cell counts.

Defined results: null keys equal empty ones; cell counts that are no number count as 0;
treated conditions without controls are kept as ``unmatched``; a context without any matched
stratum has no treated cells; conditions given twice are to be reduced to the latest first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.numbering import number_rows
from assaylake.functions.text import blank, to_count
from assaylake.operators.harmonize import only_datasets

# The fields that treated and control conditions must share under each rule.
STRICT = ["dataset_id", "cell_line", "cell_type", "disease", "time", "time_unit", "batch_id", "replicate_id"]
BIO = ["dataset_id", "cell_line", "cell_type", "disease", "time", "time_unit"]
DATASET = ["dataset_id"]
CONTEXT = ["dataset_id", "cell_line", "cell_type", "disease", "perturbation_id", "dose", "dose_unit", "time", "time_unit"]
STRATUM = ["batch_id", "replicate_id"]
RULES = {"strict_context_batch_replicate": STRICT, "bio_context": BIO, "dataset_fallback": DATASET}


def prepare(conditions: DataFrame) -> DataFrame:
    texts = sorted({*STRICT, *CONTEXT, "control_status", "condition_id", "is_control"})
    return conditions.select(*[blank(F.col(c).cast("string")).alias(c) for c in texts], to_count(F.col("cell_count").cast("string")).alias("cells"))


def messages(*parts: tuple[Column, str, list]) -> Column:
    """Texts of the conditions that hold, joined by '; '."""
    return F.concat_ws("; ", *[F.when(cond, F.format_string(text, *args) if args else F.lit(text)) for cond, text, args in parts])


def condition_contrasts(conditions: DataFrame, min_treated: int = 50, min_control: int = 50, datasets: list[str] | None = None) -> DataFrame:
    """Every treated condition (of the named data sets) with the controls of the first rule that finds any."""
    rows = prepare(only_datasets(conditions, datasets))
    treated, controls = rows.where("is_control <> 'true'"), rows.where("is_control = 'true'")
    out = number_rows(treated, ["condition_id"])
    for i, keys in enumerate(RULES.values()):
        pool = controls.groupBy(*keys).agg(F.sum("cells").alias(f"cells{i}"), F.count("*").alias(f"n{i}"))
        out = out.join(pool, keys, "left")
    pick = lambda c: F.coalesce(*[F.when(F.col(f"n{i}").isNotNull(), F.col(f"{c}{i}")) for i in range(3)], F.lit(0))
    rule = F.coalesce(*[F.when(F.col(f"n{i}").isNotNull(), F.lit(r)) for i, r in enumerate(RULES)], F.lit("unmatched"))
    out = out.withColumns({"match_rule": rule, "control_cell_count": pick("cells"), "control_match_count": pick("n")})
    few_t, few_c, m = F.col("cells") < min_treated, F.col("control_cell_count") < min_control, F.col("match_rule")
    status = F.when((m == "unmatched") | few_t | few_c, "fail").when(m == "dataset_fallback", "warn").otherwise("pass")
    reason = messages(
        (m == "unmatched", "no matched controls", []),
        (few_t, "treated cells below threshold: %d < %d", [F.col("cells"), F.lit(min_treated)]),
        (few_c, "control cells below threshold: %d < %d", [F.col("control_cell_count"), F.lit(min_control)]),
        (m == "dataset_fallback", "controls matched only at dataset level", []),
    )
    fields = ["perturbation_id", "cell_line", "cell_type", "disease", "dose", "dose_unit", "time", "time_unit", "batch_id", "replicate_id"]
    return out.select(
        F.format_string("condition_contrast_%08d", "number").alias("contrast_id"),
        "dataset_id",
        F.col("condition_id").alias("treated_condition_id"),
        "match_rule",
        status.alias("status"),
        reason.alias("reason"),
        *fields,
        F.col("cells").alias("treated_cell_count"),
        "control_cell_count",
        "control_match_count"
    )


def match_key(keys: list[str]) -> Column:
    """One text for the values of all fields of a rule."""
    return F.to_json(F.array(*keys))


def contrast_links(contrasts: DataFrame) -> DataFrame:
    """(contrast_id, match_rule, match_key): the rule and key that each matched contrast uses."""
    key = F.coalesce(*[F.when(F.col("match_rule") == rule, match_key(keys)) for rule, keys in RULES.items()])
    return contrasts.select("contrast_id", "match_rule", key.alias("match_key")).where("match_key is not null")


def control_keys(conditions: DataFrame) -> DataFrame:
    """(match_rule, match_key, control_condition_id): every control under its key of each rule, three rows each."""
    controls = prepare(conditions).where("is_control = 'true'")
    each = F.array(*[F.struct(F.lit(rule).alias("match_rule"), match_key(keys).alias("match_key")) for rule, keys in RULES.items()])
    return controls.select(F.col("condition_id").alias("control_condition_id"), F.explode(each).alias("k")).select("k.*", "control_condition_id")


def contrast_controls(contrasts: DataFrame, conditions: DataFrame) -> DataFrame:
    """(contrast_id, control_condition_id): the pairs behind control_match_count.

    As many rows as contrasts times controls of their key; for counts and sums join what is
    aggregated by ``control_keys`` with ``contrast_links``.
    """
    return contrast_links(contrasts).join(control_keys(conditions), ["match_rule", "match_key"]).select("contrast_id", "control_condition_id")


def pooled_members(conditions: DataFrame) -> DataFrame:
    """Treated conditions of each context, with their stratum's controls counted."""
    rows = prepare(conditions)
    treated, controls = rows.where("is_control <> 'true'"), rows.where("is_control = 'true'")
    pool = controls.groupBy(*STRICT).agg(F.sum("cells").alias("stratum_cells"), F.count("*").alias("stratum_controls"))
    return treated.join(pool, STRICT, "left").withColumn("matched", F.col("stratum_controls").isNotNull())


def pooled_contrasts(
    conditions: DataFrame, min_treated: int = 50, min_control: int = 50, min_strata: int = 2, datasets: list[str] | None = None
) -> DataFrame:
    """One contrast per context (of the named data sets), over its batch and replicate strata that have controls.

    Strata are disjoint sets of controls, so each is counted once per context.
    """
    members = pooled_members(only_datasets(conditions, datasets))
    strata = members.groupBy(*CONTEXT, *STRATUM).agg(
        F.sum(F.when(F.col("matched"), F.col("cells")).otherwise(0)).alias("t_cells"),
        F.count(F.when(F.col("matched"), 1)).alias("t_n"),
        F.max("stratum_cells").alias("c_cells"),
        F.max("stratum_controls").alias("c_n"),
    )
    sums = strata.groupBy(*CONTEXT).agg(
        F.sum("t_cells").alias("treated_cell_count"),
        F.coalesce(F.sum("c_cells"), F.lit(0)).alias("control_cell_count"),
        F.sum("t_n").alias("treated_condition_count"),
        F.coalesce(F.sum("c_n"), F.lit(0)).alias("control_condition_count"),
        F.count("c_n").alias("matched_strata_count"),
    )
    t, c, s = F.col("treated_cell_count"), F.col("control_cell_count"), F.col("matched_strata_count")
    status = F.when((s == 0) | (t < min_treated) | (c < min_control), "fail").when(s < min_strata, "warn").otherwise("pass")
    reason = messages(
        (s == 0, "no matched control strata", []),
        (t < min_treated, "treated cells below pooled threshold: %d < %d", [t, F.lit(min_treated)]),
        (c < min_control, "control cells below pooled threshold: %d < %d", [c, F.lit(min_control)]),
        ((s > 0) & (s < min_strata), "matched strata below recommendation: %d < %d", [s, F.lit(min_strata)]),
    )
    out = number_rows(sums, CONTEXT)
    return out.select(
        F.format_string("pooled_contrast_%08d", "number").alias("contrast_id"),
        *CONTEXT,
        status.alias("status"),
        reason.alias("reason"),
        F.lit("pooled_context_strata").alias("match_rule"),
        "treated_cell_count",
        "control_cell_count",
        "treated_condition_count",
        "control_condition_count",
        "matched_strata_count"
    )


def pooled_bridge(conditions: DataFrame, contrasts: DataFrame) -> DataFrame:
    """(contrast_id, role, condition_id): the treated and control conditions of each contrast."""
    matched = pooled_members(conditions).where("matched")
    keyed = matched.join(contrasts.select("contrast_id", *CONTEXT), CONTEXT)
    treated = keyed.select("contrast_id", F.lit("treated").alias("role"), "condition_id")
    controls = prepare(conditions).where("is_control = 'true'")
    strata = keyed.select("contrast_id", *STRICT).distinct()
    control = strata.join(controls.select(*STRICT, "condition_id"), STRICT).select("contrast_id", F.lit("control").alias("role"), "condition_id")
    return treated.unionByName(control)


def pooled_links(conditions: DataFrame, contrasts: DataFrame) -> DataFrame:
    """(contrast_id, condition_id, match_key): matched treated conditions of each contrast with their stratum.

    The controls of a stratum are those of ``control_keys`` under the strict rule.
    """
    matched = pooled_members(conditions).where("matched")
    return matched.join(contrasts.select("contrast_id", *CONTEXT), CONTEXT).select("contrast_id", "condition_id", match_key(STRICT).alias("match_key"))


def member_lists(bridge: DataFrame) -> DataFrame:
    """The members as text lists, as sinks of fixed columns want them.

    A list is as long as the contrast has members; ``contrast_links``, ``pooled_links`` and
    ``control_keys`` hold the same in rows.
    """
    lists = bridge.groupBy("contrast_id", "role").agg(F.concat_ws(";", F.array_sort(F.collect_set("condition_id"))).alias("ids"))
    return lists.groupBy("contrast_id").pivot("role", ["treated", "control"]).agg(F.first("ids")).select(
        "contrast_id",
        F.coalesce("treated", F.lit("")).alias("treated_condition_ids"),
        F.coalesce("control", F.lit("")).alias("control_condition_ids")
    )


def status_counts(contrasts: DataFrame, by: list[str]) -> DataFrame:
    return contrasts.where("status <> ''").groupBy(*by, "status").agg(F.count("*").alias("contrasts"))
