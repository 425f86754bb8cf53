"""Queries of manifests, receipts and totals around the analysis stages, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.operators import cellqc, contrast, curate, effects, pseudobulk, tableprofile
from assaylake.operators.harmonize import VAR_ALIASES, only_datasets
from assaylake.operators.quality import FORMS
from assaylake.plans import stages
from assaylake.session import cut, read

INCLUDED = ["ASIA", "EUROPE"]
CATEGORIES = ["cell_line", "cell_type", "disease", "organism", "perturbation_id", "control_status", "dose", "time"]


def effects_included(spark: SparkSession, d: str) -> DataFrame:
    """Effects of the interventions of two data sets only; the rest is left out before the counts are joined."""
    cells = only_datasets(stages.order_cells(spark, d), INCLUDED)
    groups = pseudobulk.groups(cells, "intervention")
    sums = pseudobulk.pseudobulk(stages.order_lines(spark, d), pseudobulk.keyed_cells(cells, "intervention"), ("cell_ord",), "group_key")
    sums = cut(sums.join(groups.select("group_key", "group_id"), "group_key").select("dataset_id", "group_id", "feature_id", "count_sum"))
    found = effects.intervention_effects(sums, groups, stages.MIN_CELLS, stages.SCALE)
    return found.select("dataset_id", "contrast_id", "perturbation_id", "feature_id", F.round("effect_size", 6).alias("effect_size"))


def profile_categories(spark: SparkSession, d: str) -> DataFrame:
    return tableprofile.category_sample(read(spark, d, "obs_cells"), CATEGORIES)


def counts_locations(spark: SparkSession, d: str) -> DataFrame:
    """Where the checked matrices of each data set keep their counts."""
    return tableprofile.counts_locations(read(spark, d, "dataset_qc").select("dataset_id", F.col("counts_location").alias("location")))


def qc_dataset_rules(spark: SparkSession, d: str) -> DataFrame:
    """All checks of each data set: its last check and profile, its input file, and the profile's own warnings."""
    rows = stages.latest_cells(spark, d, "perturbation_id", "control_status", "batch_id", "replicate_id")
    vectors, used = cellqc.qc_vectors(rows.withColumnRenamed("perturbation_id", "perturbation"))
    qc, index = read(spark, d, "dataset_qc"), read(spark, d, "profile_index")
    fields = ["n_obs", "matrix_integer_like_sample", "counts_location", "admission_status", "analysis_input"]
    checked = qc.groupBy("dataset_id").agg(F.max_by(F.struct(*fields), F.struct("load_no", "loaded_at", *fields)).alias("r")).select("dataset_id", "r.*")
    noted = index.groupBy("dataset_id").agg(F.max_by(F.struct("warnings"), F.struct("load_no", "loaded_at", "warnings")).alias("w")).select(
        "dataset_id", F.when(F.col("w.warnings").rlike(FORMS["messages"]), F.from_json("w.warnings", "array<string>")).alias("profile_warnings")
    )
    files = index.select(F.col("h5ad_path").alias("analysis_input"), F.lit(True).alias("input_present")).where("analysis_input is not null").distinct()
    profiles = checked.withColumn("checked", F.lit(True)).join(files, "analysis_input", "left").join(noted, "dataset_id", "full").select(
        "dataset_id",
        "n_obs",
        (F.col("matrix_integer_like_sample") == "True").alias("integer_like"),
        F.when(F.col("checked").isNull() | (F.col("counts_location") == "X"), 0).otherwise(1).alias("count_layers"),
        "admission_status",
        F.coalesce("input_present", F.lit(False)).alias("input_present"),
        "profile_warnings"
    )
    return cellqc.dataset_qc(vectors, profiles, used["batch"] is not None)


def matrix_digest(spark: SparkSession, d: str) -> DataFrame:
    """A digest of each data set's counts that does not depend on the order of the rows."""
    counts = stages.order_counts(spark, d).groupBy("dataset_id", "cell_ord", "feature_id").agg(F.sum("value").cast("bigint").alias("value"))
    return curate.digest(counts, "dataset_id", ["cell_ord", "feature_id", "value"])


def receipt_join(spark: SparkSession, d: str) -> DataFrame:
    """Analysis inputs with the profiles of a file of the same name, wherever it lies."""
    base = lambda c: F.element_at(F.split(c, "/"), -1)
    inputs = read(spark, d, "dataset_qc").where("analysis_input is not null").select("dataset_id", base("analysis_input").alias("name")).distinct()
    files = read(spark, d, "profile_index").where("h5ad_path is not null").groupBy(base("h5ad_path").alias("name")).agg(
        F.count_distinct("h5ad_path").alias("n_files"), F.min("h5ad_path").alias("first_path")
    )
    return inputs.join(files, "name", "left").select("dataset_id", "name", F.coalesce("n_files", F.lit(0)).alias("n_files"), "first_path")


def _contrast_counts(spark: SparkSession, d: str) -> DataFrame:
    made = contrast.condition_contrasts(stages.latest_conditions(spark, d))
    return made.groupBy("dataset_id").agg(F.count("*").alias("contrasts"), F.sum("treated_cell_count").alias("treated_cells"))


def release_contrasts(spark: SparkSession, d: str) -> DataFrame:
    """Checked data sets with the number of their contrasts, 0 where there are none."""
    wanted = read(spark, d, "dataset_qc").select("dataset_id").where("dataset_id is not null").distinct()
    return wanted.join(_contrast_counts(spark, d), "dataset_id", "left").fillna(0, ["contrasts", "treated_cells"])


def overview(spark: SparkSession, d: str) -> DataFrame:
    """Totals over all data sets and the largest of each number."""
    numbers = ("contrasts", "treated_cells")
    sums = [a for c in numbers for a in (F.sum(c).alias(f"total_{c}"), F.max(c).alias(f"most_{c}"))]
    return _contrast_counts(spark, d).agg(F.count("*").alias("datasets"), *sums)


def cell_table_profile(spark: SparkSession, d: str) -> DataFrame:
    """Inventory of the cell table: every column in order, with the commonest values of the watched ones."""
    return tableprofile.table_profile(read(spark, d, "obs_cells"), stages.SUMMARISED)


QUERIES = {
    f.__name__: f
    for f in (
        effects_included, profile_categories, counts_locations, qc_dataset_rules, matrix_digest, receipt_join, release_contrasts, overview, cell_table_profile
    )
}

_INCLUDED = stages._effects_sql("intervention").replace(
    "JOIN region ON n_regionkey = r_regionkey", "JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE')"
)
_MESSAGES = """json_valid(w) AND json_type(CASE WHEN json_valid(w) THEN w END) = 'ARRAY'
  AND len(list_filter(CASE WHEN json_valid(w) AND starts_with(w, '[') THEN json_transform(w, '["JSON"]') ELSE [] END, lambda x: x IS NULL OR json_type(x) <> 'VARCHAR')) = 0"""
_COUNTED = f"{stages._CASCADE}, counted AS (SELECT dataset_id, count(*) AS contrasts, CAST(sum(treated_cell_count) AS BIGINT) AS treated_cells FROM contrasts GROUP BY 1)"

_VAR = [n for names in VAR_ALIASES.values() for n in names]


def _first_name(field: str) -> str:
    """The value under the first name of the field that the row's file has."""
    read = "coalesce(j->>'$.{n}', '')"
    if field in ("start", "end"):
        read = "coalesce(CAST(CAST(trunc(TRY_CAST(j->>'$.{n}' AS DOUBLE)) AS BIGINT) AS VARCHAR), '')"
    return "CASE " + " ".join(f"WHEN has_{n} THEN {read.format(n=n)}" for n in VAR_ALIASES[field]) + f" ELSE '' END AS {field}_"


_CELL_COLUMNS = [
    "dataset_id", "cell_id", "cell_line", "cell_type", "disease", "organism", "perturbation_id", "perturbation_type", "perturbation_target", "guide_id", "drug_id", "dose",
    "dose_unit", "time", "time_unit", "control_status", "is_control", "batch_id", "replicate_id", "n_counts", "n_genes", "percent_mito", "percent_ribo", "source_cell_barcode",
]
_PLACES = ", ".join(f"('{c}', {i}, {str(c in stages.SUMMARISED).lower()})" for i, c in enumerate([*_CELL_COLUMNS, "collected_at", "loaded_at"], 1))
_GONE = " OR lower({c}) IN ('nan', 'none', 'null', 'na')"

SQL = {
    "profile_columns_all": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL{_GONE.format(c=c) if c in _CELL_COLUMNS else ''}) AS missing_count, count(DISTINCT coalesce(CAST({c} AS VARCHAR), 'None')) AS unique_count FROM obs_cells"
        for c in [*_CELL_COLUMNS, "collected_at", "loaded_at"]
    ),
    "profile_value_counts_all": "WITH long AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS v FROM obs_cells" for c in stages.SUMMARISED)
    + "), k AS (SELECT column_name, CASE WHEN v IS NULL OR lower(v) IN ('', 'nan', 'none', 'null', 'na') THEN '<missing>' ELSE v END AS value, count(*) AS n_rows FROM long GROUP BY 1, 2) SELECT *, CAST(row_number() OVER w AS INTEGER) AS place FROM k WINDOW w AS (PARTITION BY column_name ORDER BY n_rows DESC, value) QUALIFY row_number() OVER w <= 20",
    "repair_labels_all": stages.SQL["repair_labels"].replace("WHERE perturbation_id IS NOT NULL AND source_cell_barcode", "WHERE source_cell_barcode"),
    "var_harmonize_files": f"""WITH v AS (SELECT dataset_id, file_id, CAST(payload AS JSON) AS j, json_keys(payload) AS ks FROM raw_records WHERE kind = 'var' AND json_valid(payload) AND json_type(payload) = 'OBJECT'),
f AS (SELECT file_id, {", ".join(f"bool_or(list_contains(ks, '{n}')) AS has_{n}" for n in _VAR)} FROM v GROUP BY 1),
n AS (SELECT dataset_id, coalesce(j->>'$.feature_id', '') AS feature_id, {", ".join(map(_first_name, VAR_ALIASES))} FROM v JOIN f USING (file_id))
SELECT DISTINCT dataset_id, feature_id, CASE WHEN gene_id_ = '' THEN feature_id ELSE gene_id_ END AS gene_id, CASE WHEN gene_symbol_ = '' THEN feature_id ELSE gene_symbol_ END AS gene_symbol,
  ensembl_id_ AS ensembl_id, chromosome_ AS chromosome, start_ AS start, end_ AS "end", gene_type_ AS gene_type, highly_variable_ AS highly_variable FROM n""",
    "effects_included": f"{_INCLUDED} SELECT dataset_id, contrast_id, perturbation_id, feature_id, round(effect_size, 6) AS effect_size FROM delta",
    "profile_categories": "WITH long AS ("
    + " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS column_name, {c} AS v FROM obs_cells WHERE {c} IS NOT NULL" for c in CATEGORIES)
    + """), first AS (SELECT column_name, v FROM long QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY v) <= 20)
SELECT column_name, count(*) AS n_sampled, string_agg(v, ';' ORDER BY v) AS categories FROM first GROUP BY 1""",
    "counts_locations": """SELECT dataset_id, bool_or(counts_location = 'X') AS x_present, bool_or(starts_with(counts_location, 'raw')) AS raw_present,
coalesce(string_agg(DISTINCT substr(counts_location, 8), ';' ORDER BY substr(counts_location, 8)) FILTER (WHERE starts_with(counts_location, 'layers/')), '') AS layers
FROM dataset_qc WHERE counts_location IS NOT NULL GROUP BY 1""",
    "qc_dataset_rules": f"""{stages._QC}, s AS (
  SELECT dataset_id, count(*) AS cells, count(*) FILTER (WHERE perturbation_id = '<missing>') AS missing, count(DISTINCT perturbation_id) FILTER (WHERE perturbation_id <> '<missing>') AS labels, count(*) FILTER (WHERE ctl) AS controls FROM labelled GROUP BY 1
), p AS (SELECT *, coalesce(matrix_integer_like_sample = 'True', false) AS whole, counts_location IS NOT DISTINCT FROM 'X' AS bare FROM dataset_qc
  QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY load_no DESC NULLS LAST, loaded_at DESC NULLS LAST, n_obs DESC NULLS LAST, matrix_integer_like_sample DESC NULLS LAST,
    counts_location DESC NULLS LAST, admission_status DESC NULLS LAST, analysis_input DESC NULLS LAST) = 1),
i AS (SELECT dataset_id AS ds, warnings AS w FROM profile_index QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY load_no DESC NULLS LAST, loaded_at DESC NULLS LAST, warnings DESC NULLS LAST) = 1),
carried AS (SELECT ds, CASE WHEN {_MESSAGES} THEN json_transform(w, '["VARCHAR"]') ELSE [] END AS l FROM i),
m AS (
  SELECT s.dataset_id, cells AS n_obs, labels AS perturbation_count, missing AS missing_perturbation_cells, controls AS control_cells,
    concat_ws('; ', CASE WHEN analysis_input IS NULL OR analysis_input NOT IN (SELECT h5ad_path FROM profile_index WHERE h5ad_path IS NOT NULL) THEN 'analysis input file is missing' END,
      CASE WHEN NOT coalesce(starts_with(admission_status, 'pass'), false) THEN 'release admission is not pass-like: ' || coalesce(admission_status, 'None') END,
      CASE WHEN NOT coalesce(whole, false) THEN 'sampled matrix values are not integer-like' END, CASE WHEN p.n_obs IS DISTINCT FROM cells THEN 'profile n_obs does not match observed perturbation vector' END,
      CASE WHEN missing > 0 THEN 'missing perturbation labels: ' || missing END, CASE WHEN controls < 50 THEN 'control cells below threshold: ' || controls || ' < 50' END) AS failures,
    list_concat(CASE WHEN p.dataset_id IS NULL OR bare THEN ['no raw object or count layer; X is treated as counts'] ELSE [] END, coalesce(l, [])) AS ws
  FROM s LEFT JOIN p USING (dataset_id) LEFT JOIN carried ON ds = s.dataset_id
), n AS (SELECT * EXCLUDE (ws), array_to_string(list_filter(ws, lambda x, k: list_position(ws, x) = k), '; ') AS warnings FROM m)
SELECT *, CASE WHEN failures <> '' THEN 'fail' WHEN warnings <> '' THEN 'warn' ELSE 'pass' END AS status FROM n""",
    "matrix_digest": f"""{stages._BASE}, each AS (SELECT dataset_id, cell_ord, feature_id, CAST(sum(value) AS BIGINT) AS value FROM counts GROUP BY 1, 2, 3)
SELECT dataset_id, count(*) AS n_rows, bit_xor(CAST('0x' || substr(md5(concat_ws('|', cell_ord, feature_id, value)), 1, 15) AS BIGINT)) AS digest FROM each GROUP BY 1""",
    "receipt_join": """WITH i AS (SELECT DISTINCT dataset_id, string_split(analysis_input, '/')[-1] AS name FROM dataset_qc WHERE analysis_input IS NOT NULL),
f AS (SELECT string_split(h5ad_path, '/')[-1] AS name, count(DISTINCT h5ad_path) AS n_files, min(h5ad_path) AS first_path FROM profile_index WHERE h5ad_path IS NOT NULL GROUP BY 1)
SELECT dataset_id, name, coalesce(n_files, 0) AS n_files, first_path FROM i LEFT JOIN f USING (name)""",
    "release_contrasts": f"""{_COUNTED}, wanted AS (SELECT DISTINCT dataset_id FROM dataset_qc WHERE dataset_id IS NOT NULL)
SELECT dataset_id, coalesce(contrasts, 0) AS contrasts, coalesce(treated_cells, 0) AS treated_cells FROM wanted LEFT JOIN counted USING (dataset_id)""",
    "overview": f"""{_COUNTED} SELECT count(*) AS datasets, CAST(sum(contrasts) AS BIGINT) AS total_contrasts, max(contrasts) AS most_contrasts,
CAST(sum(treated_cells) AS BIGINT) AS total_treated_cells, max(treated_cells) AS most_treated_cells FROM counted""",
}
SQL["cell_table_profile"] = f"""WITH c AS (SELECT * FROM (VALUES {_PLACES}) t(column_name, place, watched)), n AS ({SQL["profile_columns_all"]}), v AS ({SQL["profile_value_counts_all"]})
SELECT c.column_name, c.place, c.watched, n_rows, missing_count, unique_count, (SELECT string_agg(value || '=' || v.n_rows, '; ' ORDER BY v.place) FROM v WHERE v.column_name = c.column_name) AS commonest
FROM c JOIN n ON n.column_name = c.column_name"""
