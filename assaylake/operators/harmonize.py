"""Harmonised cells and features, and the intervention and condition tables.

Defined results: a null value becomes the empty text, so that missing keys are equal; of the
names a field may have in a source, the first that exists as a column is used for all rows;
fields without any source column are empty; extra columns are dropped; a column named like a
field but in other letter case is not that field; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.numbering import number_rows
from assaylake.functions.text import blank, normalize, text_of

# Source column names of each field, in order of priority.
OBS_ALIASES = {
    "cell_line": ["cell_line"],
    "cell_type": ["cell_type", "celltype"],
    "disease": ["disease", "disease_status"],
    "organism": ["organism", "species"],
    "perturbation_id": ["perturbation", "condition"],
    "perturbation_type": ["perturbation_type"],
    "perturbation_target": ["perturbation_target", "target", "gene"],
    "guide_id": ["guide_id"],
    "drug_id": ["drug_id", "drug", "drug_name"],
    "dose": ["dose", "dose_value", "drug_dose"],
    "dose_unit": ["dose_unit", "drug_dose_unit"],
    "time": ["time", "drug_time", "timepoint"],
    "time_unit": ["time_unit", "drug_time_unit"],
    "control_status": ["control_status"],
    "batch_id": ["batch_id", "batch", "plate"],
    "replicate_id": ["replicate_id", "replicate"],
    "n_counts": ["n_counts", "ncounts", "UMI_count", "UMI count"],
    "n_genes": ["n_genes", "ngenes"],
    "percent_mito": ["percent_mito"],
    "percent_ribo": ["percent_ribo"],
    "source_cell_barcode": ["source_cell_barcode", "cell_barcode"],
}
VAR_ALIASES = {
    "gene_id": ["gene_id"],
    "gene_symbol": ["gene_symbol", "gene_name"],
    "ensembl_id": ["ensembl_id"],
    "chromosome": ["chromosome", "chr"],
    "start": ["start"],
    "end": ["end"],
    "gene_type": ["gene_type", "class"],
    "highly_variable": ["highly_variable"],
}
# Texts that name a control.
CONTROLS = ["control", "negative_control", "non-targeting", "nontargeting", "non_targeting", "scramble", "vehicle", "dmso", "untreated", "mock"]
INTERVENTION = ["dataset_id", "perturbation_id", "perturbation_type", "perturbation_target", "guide_id", "drug_id", "is_control"]
BIO_CONDITION = [
    "dataset_id",
    "cell_line",
    "cell_type",
    "disease",
    "perturbation_id",
    "dose",
    "dose_unit",
    "time",
    "time_unit",
    "control_status",
    "is_control"
]
CONDITION = [*BIO_CONDITION, "batch_id", "replicate_id"]
GRAINS = {"intervention": INTERVENTION, "bio-condition": BIO_CONDITION, "condition": CONDITION}


def first_existing(columns: list[str], names: list[str]) -> str | None:
    return next((n for n in names if n in columns), None)


def resolve(df: DataFrame, names: list[str]) -> Column:
    """The first of the named columns that the table has, as text."""
    found = first_existing(df.columns, names)
    if found is None:
        return F.lit("")
    return text_of(F.col(f"`{found}`"), df.schema[found].dataType.typeName())


def sources_used(df: DataFrame, aliases: dict[str, list[str]]) -> dict[str, str]:
    """Which source column each field was taken from."""
    return {f: n for f, names in aliases.items() if (n := first_existing(df.columns, names))}


def is_control(perturbation: Column, status: Column, normalized_set: bool = False) -> Column:
    """Whether a cell is a control, by its status or by its perturbation.

    Underscores become hyphens before the comparison, so the member written with one can only
    match if ``normalized_set`` applies the same to the set.
    """
    known = sorted({c.replace("_", "-") for c in CONTROLS} if normalized_set else set(CONTROLS))
    return F.coalesce(normalize(status).isin([*known, "true", "1"]), F.lit(False)) | F.coalesce(normalize(perturbation).isin(known), F.lit(False))


def harmonize_obs(df: DataFrame, dataset_id: Column, cell_id: Column) -> DataFrame:
    """The 24 text fields of a cell."""
    raw = df.select(
        dataset_id.cast("string").alias("dataset_id"),
        cell_id.cast("string").alias("cell_id"),
        *[resolve(df, names).alias(f) for f, names in OBS_ALIASES.items()]
    )
    control = is_control(F.col("perturbation_id"), F.col("control_status"))
    filled = {
        "is_control": F.when(control, "true").otherwise("false"),
        "control_status": F.when(F.col("control_status") != "", F.col("control_status")).when(control, "control").otherwise("targeting"),
        "drug_id": F.when((F.col("drug_id") == "") & (F.col("perturbation_type") == "drug"), F.col("perturbation_id")).otherwise(F.col("drug_id")),
        "source_cell_barcode": F.when(F.col("source_cell_barcode") == "", F.col("cell_id")).otherwise(F.col("source_cell_barcode")),
    }
    return raw.withColumns(filled)


def harmonize_var(df: DataFrame, dataset_id: Column, feature_id: Column) -> DataFrame:
    """The 10 text fields of a feature; ids default to the feature's own name."""
    raw = df.select(
        dataset_id.cast("string").alias("dataset_id"),
        feature_id.cast("string").alias("feature_id"),
        *[resolve(df, names).alias(f) for f, names in VAR_ALIASES.items()]
    )
    own = lambda c: F.when(F.col(c) == "", F.col("feature_id")).otherwise(F.col(c))
    return raw.withColumns({"gene_id": own("gene_id"), "gene_symbol": own("gene_symbol")})


def harmonize_var_files(df: DataFrame) -> DataFrame:
    """The 10 text fields of features that come as JSON objects, each file with names of its own.

    df: dataset_id, file_id, payload. A name is in a file if at least one of its objects has it,
    with a value or null; of the names of a field, the first that the file has is used for all
    of its rows. Payloads that are no object give no row.
    """
    names = [n for ns in VAR_ALIASES.values() for n in ns]
    rows = df.withColumn("keys", F.json_object_keys("payload")).where("keys is not null")
    files = rows.groupBy(F.col("file_id").alias("of_file")).agg(*[F.bool_or(F.array_contains("keys", n)).alias(f"has_{n}") for n in names])
    value = lambda n: F.get_json_object("payload", f"$.{n}")
    place = lambda n: value(n).try_cast("double").try_cast("bigint").cast("string")  # noqa: E731  5.0E3 and 5000 are one place

    def first(field):
        read = place if field in ("start", "end") else value
        return reduce(lambda rest, n: F.when(F.col(f"has_{n}"), read(n)).otherwise(rest), VAR_ALIASES[field][::-1], F.lit(None))

    found = rows.join(files, F.col("file_id").eqNullSafe(F.col("of_file")))
    resolved = found.select("dataset_id", value("feature_id").alias("feature_id"), *[first(f).alias(f) for f in VAR_ALIASES])
    return harmonize_var(resolved, F.col("dataset_id"), F.col("feature_id"))


def _keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[blank(F.col(k).cast("string")).alias(k) for k in keys])


def count_cells(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Number of cells of each combination of keys; null and empty are one."""
    return _keys(cells, keys).groupBy(*keys).agg(F.count("*").alias("cell_count"))


def only_datasets(df: DataFrame, datasets: list[str] | None) -> DataFrame:
    """The rows of the named data sets; all rows where none is named. The filter reaches the scan."""
    return df.where(F.col("dataset_id").isin(*datasets)) if datasets else df


def conditions(cells: DataFrame) -> DataFrame:
    """Numbered conditions: ``condition_0000001`` and so on in the order of their 13 keys."""
    out = number_rows(count_cells(cells, CONDITION), CONDITION)
    return out.select(F.format_string("condition_%07d", "number").alias("condition_id"), *CONDITION, "cell_count")


def interventions(cells: DataFrame) -> DataFrame:
    out = number_rows(count_cells(cells, INTERVENTION), INTERVENTION)
    return out.select(F.format_string("intervention_%07d", "number").alias("intervention_id"), *INTERVENTION, "cell_count")


def all_grains(cells: DataFrame) -> DataFrame:
    """Cell counts at all three grains in one pass, by grouping sets."""
    every = sorted({k for ks in GRAINS.values() for k in ks})
    base = _keys(cells, every)
    sets = [[F.col(k) for k in ks] for ks in GRAINS.values()]
    grouped = base.groupingSets(sets, *[F.col(k) for k in every]).agg(F.count("*").alias("cell_count"), F.grouping_id().alias("__g"))
    code = {grain: sum(1 << (len(every) - 1 - i) for i, k in enumerate(every) if k not in ks) for grain, ks in GRAINS.items()}
    name = F.element_at(F.create_map(*[F.lit(x) for grain, c in code.items() for x in (c, grain)]), F.col("__g").cast("int"))
    return grouped.select(name.alias("grain"), *every, "cell_count")
