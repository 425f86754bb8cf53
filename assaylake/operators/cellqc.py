"""Quality checks of data sets and perturbations, from cells.

Defined results: missing labels (null, blank, marker texts) are counted under ``<missing>``; a
perturbation is a control only if all its cells are; a table without any batch column gives a
null number of levels; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.text import is_missing_qc
from assaylake.operators.contrast import messages
from assaylake.operators.harmonize import first_existing, is_control

# Source columns in order of priority.
PERTURBATION = ["perturbation", "condition"]
CONTROL = ["control_status", "is_control"]
BATCH = ["batch", "batch_id", "replicate", "replicate_id", "plate", "gem_group"]


def qc_vectors(cells: DataFrame, perturbation: list[str] = PERTURBATION, control: list[str] = CONTROL, batch: list[str] = BATCH) -> tuple[
    DataFrame, dict[str, str | None]
]:
    """(dataset_id, perturbation, control, batch) of each cell, and the columns they came from."""
    used = {
        "perturbation": first_existing(cells.columns, perturbation),
        "control": first_existing(cells.columns, control),
        "batch": first_existing(cells.columns, batch)
    }
    if used["perturbation"] is None:
        raise ValueError("no perturbation column: " + ", ".join(perturbation))
    text = lambda c: F.col(c).cast("string") if c else F.lit(None).cast("string")
    p, s, b = (text(used[k]) for k in ("perturbation", "control", "batch"))
    return cells.select(
        "dataset_id",
        F.when(is_missing_qc(p), "<missing>").otherwise(p).alias("perturbation_id"),
        is_control(p, s).alias("control"),
        F.when(~is_missing_qc(b), b).alias("batch")
    ), used


def checked(failures: Column, warnings: Column) -> Column:
    return F.when(failures != "", "fail").when(warnings != "", "warn").otherwise("pass")


def perturbation_qc(vectors: DataFrame, has_batch: bool, min_cells: int = 50, min_control: int = 50) -> DataFrame:
    # distinct batches by two aggregations, so a large perturbation is spread over its batches
    per_batch = vectors.groupBy("dataset_id", "perturbation_id", "batch").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("control"), 1)).alias("c")
    )
    rows = per_batch.groupBy("dataset_id", "perturbation_id").agg(
        F.sum("n").alias("cell_count"), F.sum("c").alias("ctl"), F.count("batch").alias("levels")
    )
    totals = per_batch.groupBy("dataset_id").agg(F.sum("c").alias("control_cells_in_dataset"))
    rows = rows.join(totals, "dataset_id").withColumn("is_control", F.col("ctl") == F.col("cell_count"))
    n, t, ctl = F.col("cell_count"), F.col("control_cells_in_dataset"), F.col("is_control")
    failures = messages(
        (F.col("perturbation_id") == "<missing>", "missing perturbation label", []),
        (~ctl & (n < min_cells), "cell count below threshold: %d < %d", [n, F.lit(min_cells)]),
        (~ctl & (t < min_control), "dataset control cells below threshold: %d < %d", [t, F.lit(min_control)]),
    )
    warnings = messages(
        (F.lit(not has_batch), "batch/replicate confounding cannot be assessed", []),
        (F.lit(has_batch) & ~ctl & (F.col("levels") <= 1), "perturbation observed in one batch/replicate level", []),
    )
    out = rows.withColumns({"failures": failures, "warnings": warnings})
    status = F.when(ctl, "control").otherwise(checked(F.col("failures"), F.col("warnings")))
    levels = F.col("levels") if has_batch else F.lit(None).cast("bigint")
    return out.select(
        "dataset_id",
        "perturbation_id",
        status.alias("status"),
        "is_control",
        "cell_count",
        "control_cells_in_dataset",
        levels.alias("batch_level_count"),
        "failures",
        "warnings"
    )


def dataset_qc(vectors: DataFrame, profiles: DataFrame, has_batch: bool, min_control: int = 50) -> DataFrame:
    """Counts and checks of each data set.

    profiles: dataset_id, n_obs, integer_like, count_layers (how many raw objects or layers), and
    where they are known input_present, admission_status and profile_warnings (an array that is
    carried on after the data set's own warnings, each text once); a check whose column the table
    lacks is not made.
    """
    per_label = vectors.groupBy("dataset_id", "perturbation_id").agg(F.count("*").alias("n"), F.count(F.when(F.col("control"), 1)).alias("c"))
    missing = F.col("perturbation_id") == "<missing>"
    sums = per_label.groupBy("dataset_id").agg(
        F.sum("n").alias("cells"),
        F.sum(F.when(missing, F.col("n")).otherwise(0)).alias("missing_perturbation_cells"),
        F.count(F.when(~missing, 1)).alias("perturbation_count"),
        F.sum("c").alias("control_cells")
    )
    rows = sums.join(profiles, "dataset_id", "left")
    m, c = F.col("missing_perturbation_cells"), F.col("control_cells")
    known = []
    if "input_present" in profiles.columns:
        known.append((~F.coalesce("input_present", F.lit(False)), "analysis input file is missing", []))
    if "admission_status" in profiles.columns:
        status = F.col("admission_status")
        known.append((~F.coalesce(status.startswith("pass"), F.lit(False)), "release admission is not pass-like: %s", [F.coalesce(status, F.lit("None"))]))
    failures = messages(
        *known,
        (~F.coalesce("integer_like", F.lit(False)), "sampled matrix values are not integer-like", []),
        (~F.col("n_obs").eqNullSafe(F.col("cells")), "profile n_obs does not match observed perturbation vector", []),
        (m > 0, "missing perturbation labels: %d", [m]),
        (c < min_control, "control cells below threshold: %d < %d", [c, F.lit(min_control)]),
    )
    own = F.array(
        F.when(F.coalesce("count_layers", F.lit(0)) == 0, "no raw object or count layer; X is treated as counts"),
        F.when(F.lit(not has_batch), "no explicit batch/replicate column found")
    )
    if "profile_warnings" in profiles.columns:
        own = F.concat(own, F.coalesce("profile_warnings", F.array().cast("array<string>")))
    warnings = F.array_join(F.array_distinct(F.filter(own, lambda w: w.isNotNull())), "; ")
    out = rows.withColumns({"failures": failures, "warnings": warnings})
    return out.select(
        "dataset_id",
        checked(F.col("failures"), F.col("warnings")).alias("status"),
        F.col("cells").alias("n_obs"),
        "perturbation_count",
        "missing_perturbation_cells",
        "control_cells",
        "failures",
        "warnings"
    )
