"""Queries of the analysis stages over the supplied tables, and their SQL.

Cells and conditions come from the project's own tables. The tables hold no count matrix, so
counts are read from orders and their lines: an order is a cell, a part's brand a feature and
the ordered quantity a count; region, segment, nation and priority are the data set, the cell
line, the batch and the perturbation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.functions.numbering import latest
from assaylake.operators import cellqc, contrast, curate, effects, harmonize, meta, pseudobulk, tableprofile
from assaylake.operators.harmonize import BIO_CONDITION, CONDITION, GRAINS, INTERVENTION
from assaylake.session import cut, read

SCALE, MIN_CELLS, TOP = 1e6, 15, 5
POOLED = {"min_treated": 15, "min_control": 15, "min_strata": 8}


def order_cells(spark: SparkSession, d: str) -> DataFrame:
    geo = read(spark, d, "customer").join(read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
        read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    rows = read(spark, d, "orders").join(geo, F.col("o_custkey") == F.col("c_custkey"))
    low = F.col("o_orderpriority") == "5-LOW"
    fixed = ["cell_type", "disease", "dose", "dose_unit", "perturbation_type", "perturbation_target", "guide_id", "drug_id"]
    return rows.select(
        F.col("o_orderkey").alias("cell_ord"), F.col("r_name").alias("dataset_id"), F.col("c_mktsegment").alias("cell_line"), F.col("n_name").alias("batch_id"), F.col(
            "o_orderstatus"
        ).alias("replicate_id"),
        F.when(low, "control").otherwise(
            F.col("o_orderpriority")
        ).alias("perturbation_id"), F.year("o_orderdate").cast("string").alias("time"), F.lit("y").alias("time_unit"),
        F.when(low, "control").otherwise("targeting").alias("control_status"), F.when(low, "true").otherwise("false").alias("is_control"), *[
            F.lit("").alias(c) for c in fixed
        ],
    )


def order_counts(spark: SparkSession, d: str) -> DataFrame:
    """Triplets; lines of one order and brand add up later, in the pseudobulk sum."""
    lines = read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    brands = read(spark, d, "part").select("p_partkey", "p_brand")
    named = order_cells(spark, d).select("cell_ord", "dataset_id")
    rows = lines.join(brands, F.col("l_partkey") == F.col("p_partkey")).join(named, F.col("l_orderkey") == F.col("cell_ord"))
    return rows.select("dataset_id", "cell_ord", F.col("p_brand").alias("feature_id"), F.col("l_quantity").alias("value"))


def order_lines(spark: SparkSession, d: str) -> DataFrame:
    """The same triplets without their data set, which the cells know."""
    brands = read(spark, d, "part").select("p_partkey", F.col("p_brand").alias("feature_id"))
    lines = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("cell_ord"), "l_partkey", F.col("l_quantity").alias("value"))
    return lines.join(brands, F.col("l_partkey") == F.col("p_partkey")).select("cell_ord", "feature_id", "value")


def latest_cells(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Each cell as it was loaded last, with the named columns (or all): only these are shuffled."""
    rows = read(spark, d, "obs_cells")
    if columns:
        rows = rows.select(*dict.fromkeys(["dataset_id", "cell_id", "loaded_at", *columns]))
    return latest(rows, ["dataset_id", "cell_id"], "loaded_at")


def latest_conditions(spark: SparkSession, d: str) -> DataFrame:
    return latest(read(spark, d, "conditions"), ["condition_id"], "loaded_at")


def _sums(spark: SparkSession, d: str, grain: str) -> DataFrame:
    """Sums by group key: the counts are joined once, with the key that each cell makes itself."""
    return pseudobulk.pseudobulk(order_lines(spark, d), pseudobulk.keyed_cells(order_cells(spark, d), grain), ("cell_ord",), "group_key")


def _grouped(spark: SparkSession, d: str, grain: str) -> tuple[DataFrame, DataFrame]:
    groups = pseudobulk.groups(order_cells(spark, d), grain)
    named = _sums(spark, d, grain).join(groups.select("group_key", "group_id"), "group_key")
    return groups, named.select("dataset_id", "group_id", "feature_id", "count_sum")


def obs_harmonize(spark: SparkSession, d: str) -> DataFrame:
    """Latest cells under the names of a source, mapped back onto the canonical fields."""
    renamed = latest_cells(spark, d).withColumnsRenamed(
        {
            "perturbation_id": "perturbation",
            "cell_type": "celltype",
            "batch_id": "batch",
            "n_counts": "ncounts",
            "organism": "species",
            "drug_id": "drug"
        }
    )
    return harmonize.harmonize_obs(renamed, F.col("dataset_id"), F.col("cell_id"))


def conditions(spark: SparkSession, d: str) -> DataFrame:
    return harmonize.conditions(latest_cells(spark, d, *CONDITION))


def interventions(spark: SparkSession, d: str) -> DataFrame:
    return harmonize.interventions(latest_cells(spark, d, *INTERVENTION))


def grain_counts(spark: SparkSession, d: str) -> DataFrame:
    return harmonize.all_grains(
        latest_cells(spark, d, *sorted({k for ks in GRAINS.values() for k in ks}))
    ).groupBy("grain", "dataset_id").agg(F.count("*").alias("n_groups"), F.sum("cell_count").alias("n_cells"))


def groups_bio_condition(spark: SparkSession, d: str) -> DataFrame:
    return pseudobulk.groups(order_cells(spark, d), "bio-condition").select(
        "group_id", "dataset_id", "cell_line", "perturbation_id", "time", "is_control", "cell_count", "first_ord"
    )


def pseudobulk_intervention(spark: SparkSession, d: str) -> DataFrame:
    return _grouped(spark, d, "intervention")[1]


def pseudobulk_condition(spark: SparkSession, d: str) -> DataFrame:
    return _grouped(spark, d, "condition")[1]


def library_size(spark: SparkSession, d: str) -> DataFrame:
    return pseudobulk.library_sizes(_grouped(spark, d, "condition")[1], ["dataset_id", "group_id"])


def cpm_log1p(spark: SparkSession, d: str) -> DataFrame:
    sums = pseudobulk.normalize_sums(cut(_grouped(spark, d, "bio-condition")[1]), ["dataset_id", "group_id"], SCALE)
    return sums.select("dataset_id", "group_id", "feature_id", F.round("log1p_cpm", 6).alias("log1p_cpm"))


def _bio_effects(spark: SparkSession, d: str) -> DataFrame:
    groups, sums = _grouped(spark, d, "bio-condition")
    # the sums are a stage's output and feed several branches: they are written once
    return effects.intervention_effects(cut(sums), groups, MIN_CELLS, SCALE)


def effects_intervention(spark: SparkSession, d: str) -> DataFrame:
    cols = [F.round(c, 6).alias(c) for c in ("treated_log1p_cpm", "control_log1p_cpm", "effect_size")]
    return _bio_effects(spark, d).select("dataset_id", "contrast_id", "perturbation_id", "feature_id", *cols)


def top_genes(spark: SparkSession, d: str) -> DataFrame:
    hits = effects.top_features(_bio_effects(spark, d), TOP)
    names = order_counts(spark, d).select("dataset_id", "feature_id").distinct()
    return effects.pad_top_features(hits, names, TOP).select(
        "dataset_id",
        "contrast_id",
        "perturbation_id",
        F.col("feature_id").alias("gene_id"),
        F.round("effect_size", 6).alias("effect_size"),
        "rank_abs_effect"
    )


def effect_stats(spark: SparkSession, d: str) -> DataFrame:
    n = order_counts(spark, d).groupBy("dataset_id").agg(F.count_distinct("feature_id").alias("features"))
    out = effects.effect_magnitudes(_bio_effects(spark, d), n)
    return out.select("dataset_id", "contrasts", "features", *[F.round(c, 6).alias(c) for c in ("median_max_abs", "p90_max_abs", "median_p95_abs")])


def top_hits(found: DataFrame) -> DataFrame:
    """The largest effects of each contrast, as hits of a gene.

    They are ranked by rounded values, so that equal effects are tied in every engine, and
    handed on unrounded.
    """
    ranked = found.withColumnRenamed("effect_size", "exact").withColumn("effect_size", F.round("exact", 6))
    return effects.top_features(ranked, TOP).drop("effect_size").withColumnsRenamed({"exact": "effect_size", "feature_id": "gene_id"})


def gene_ranking(spark: SparkSession, d: str) -> DataFrame:
    """Genes ranked by how alike the interventions of all data sets move them.

    From cells and counts to the ranking: sums per intervention, controls of each data set,
    log1p(CPM) differences, the largest of them, and their agreement within and across data sets.
    """
    groups, sums = _grouped(spark, d, "intervention")
    hits = cut(top_hits(effects.intervention_effects(cut(sums), groups, MIN_CELLS, SCALE)))
    rated = hits.select("dataset_id", "contrast_id", "gene_id", F.col("effect_size").alias("effect"), F.lit("pass").alias("status"))
    return meta.meta_summary(meta.gene_consistency(rated).withColumns({c: F.round(c, 6) for c in ROUNDED}), 100)


def contrast_cascade(spark: SparkSession, d: str) -> DataFrame:
    return contrast.condition_contrasts(latest_conditions(spark, d))


def contrast_controls(spark: SparkSession, d: str) -> DataFrame:
    """How many control conditions each contrast uses: controls are counted by key, then looked up."""
    rows = latest_conditions(spark, d)
    counted = contrast.control_keys(rows).groupBy("match_rule", "match_key").agg(
        F.count("*").alias("members"),
        F.min("control_condition_id").alias("first_control"),
        F.max("control_condition_id").alias("last_control")
    )
    links = contrast.contrast_links(contrast.condition_contrasts(rows))
    return links.join(counted, ["match_rule", "match_key"]).select("contrast_id", "members", "first_control", "last_control")


def contrast_pooled(spark: SparkSession, d: str) -> DataFrame:
    return contrast.pooled_contrasts(latest_conditions(spark, d))


def contrast_members(spark: SparkSession, d: str) -> DataFrame:
    """Treated and control conditions of the orders' pooled contrasts, as text lists."""
    named = harmonize.conditions(order_cells(spark, d))
    return contrast.member_lists(contrast.pooled_bridge(named, contrast.pooled_contrasts(named, **POOLED)))


def contrast_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = latest_conditions(spark, d)
    a = contrast.status_counts(contrast.condition_contrasts(rows), ["match_rule"])
    return a.unionByName(contrast.status_counts(contrast.pooled_contrasts(rows), ["match_rule"]))


def _pooled(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Effects and contrasts of pooled conditions of the orders."""
    # conditions are named by their group key here: numbers are for people, and would have to be looked up
    named = cut(harmonize.count_cells(order_cells(spark, d), CONDITION).withColumn("condition_id", pseudobulk.group_key(CONDITION)))
    made = contrast.pooled_contrasts(named, **POOLED)
    controls = contrast.control_keys(named).where("match_rule = 'strict_context_batch_replicate'")
    sums = cut(_sums(spark, d, "condition"))
    return effects.pooled_effects(sums, None, contrast.pooled_links(named, made), controls, made, SCALE), made


def effects_pooled(spark: SparkSession, d: str) -> DataFrame:
    out, _ = _pooled(spark, d)
    return out.select(
        "dataset_id",
        "contrast_id",
        "status",
        "perturbation_id",
        "feature_id",
        *[F.round(c, 6).alias(c) for c in ("treated_log1p_cpm", "control_log1p_cpm", "effect_size")]
    )


def _hits(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    out, made = _pooled(spark, d)
    return cut(top_hits(out)), made.select("dataset_id", "contrast_id", "status")


def _genes(spark: SparkSession, d: str) -> DataFrame:
    hits, made = _hits(spark, d)
    return meta.gene_consistency(meta.included_hits(hits, made))


ROUNDED = [
    "sign_consistency",
    "dataset_sign_consistency",
    "mean_effect",
    "median_effect",
    "mean_abs_effect",
    "max_abs_effect",
    "conserved_response_score"
]


def meta_gene_consistency(spark: SparkSession, d: str) -> DataFrame:
    return _genes(spark, d).withColumns({c: F.round(c, 6) for c in ROUNDED})


def meta_summary(spark: SparkSession, d: str) -> DataFrame:
    genes = _genes(spark, d).withColumns({c: F.round(c, 6) for c in ROUNDED})
    return meta.meta_summary(genes, 100)


def meta_dataset_summary(spark: SparkSession, d: str) -> DataFrame:
    return meta.dataset_accounting(*_hits(spark, d))


def top_gene_recurrence(spark: SparkSession, d: str) -> DataFrame:
    return meta.recurrence(_hits(spark, d)[0], 25).withColumn("max_abs_effect", F.round("max_abs_effect", 6))


def qc_perturbation(spark: SparkSession, d: str) -> DataFrame:
    vectors, used = cellqc.qc_vectors(
        latest_cells(spark, d, "perturbation_id", "control_status", "batch_id", "replicate_id").withColumnRenamed(
            "perturbation_id", "perturbation"
        )
    )
    return cellqc.perturbation_qc(vectors, used["batch"] is not None)


def qc_dataset(spark: SparkSession, d: str) -> DataFrame:
    """Checks against the profile delivered last for each data set."""
    vectors, used = cellqc.qc_vectors(
        latest_cells(spark, d, "perturbation_id", "control_status", "batch_id", "replicate_id").withColumnRenamed(
            "perturbation_id", "perturbation"
        )
    )
    last = read(spark, d, "dataset_qc").groupBy("dataset_id").agg(
        F.max_by(
            F.struct("n_obs", "matrix_integer_like_sample", "counts_location"),
            F.struct("load_no", "loaded_at", "n_obs", "matrix_integer_like_sample", "counts_location")
        ).alias("r")
    )
    profiles = last.select(
        "dataset_id",
        "r.n_obs",
        (F.col("r.matrix_integer_like_sample") == "True").alias("integer_like"),
        F.when(F.col("r.counts_location") == "X", 0).otherwise(1).alias("count_layers")
    )
    return cellqc.dataset_qc(vectors, profiles, used["batch"] is not None)


PROFILED = [
    "cell_line",
    "cell_type",
    "disease",
    "organism",
    "perturbation_type",
    "control_status",
    "batch_id",
    "replicate_id",
    "n_counts",
    "dose",
    "time",
    "collected_at"
]


def profile_columns(spark: SparkSession, d: str) -> DataFrame:
    return tableprofile.column_profile(read(spark, d, "obs_cells"), PROFILED)


def profile_value_counts(spark: SparkSession, d: str) -> DataFrame:
    return tableprofile.value_counts(read(spark, d, "obs_cells"), ["cell_line", "disease", "perturbation_id", "control_status", "batch_id", "time"])


SUMMARISED = [
    "cell_line",
    "disease",
    "perturbation_id",
    "perturbation_target",
    "guide_id",
    "drug_id",
    "control_status",
    "is_control",
    "batch_id",
    "replicate_id",
    "dose",
    "time"
]


def profile_columns_all(spark: SparkSession, d: str) -> DataFrame:
    """Missing and distinct values of every column, whichever the table has."""
    return tableprofile.column_profile(read(spark, d, "obs_cells"))


def profile_value_counts_all(spark: SparkSession, d: str) -> DataFrame:
    """The commonest values of every column on perturbation, control, batch, dose and time, and of two more."""
    return tableprofile.value_counts(read(spark, d, "obs_cells"), SUMMARISED)


def matrix_profile(spark: SparkSession, d: str) -> DataFrame:
    n_obs = order_cells(spark, d).groupBy("dataset_id").agg(F.count("*").alias("n_obs"))
    counts = order_counts(spark, d).groupBy("dataset_id", "cell_ord", "feature_id").agg(F.sum("value").alias("value"))
    n_vars = order_counts(spark, d).groupBy("dataset_id").agg(F.count_distinct("feature_id").alias("n_vars"))
    return tableprofile.matrix_profile(counts, n_obs, n_vars).withColumn("density", F.round("density", 6))


def curate_filter(spark: SparkSession, d: str) -> DataFrame:
    cells = latest_cells(spark, d, "perturbation_id")
    return curate.accounting(cells, curate.with_perturbation(cells, "perturbation_id", True))


def curate_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts left after cells of one status are dropped, summed by feature."""
    cells, counts = curate.filter_rows(order_cells(spark, d), order_counts(spark, d), F.col("replicate_id") != "F")
    return counts.groupBy("dataset_id", "feature_id").agg(F.sum("value").alias("count_sum"))


def kept_runs(spark: SparkSession, d: str) -> DataFrame:
    """Contiguous runs of the cells that are left after one status is dropped."""
    return curate.islands(order_cells(spark, d).where("replicate_id <> 'F'"), "dataset_id", "cell_ord")


def repair_labels(spark: SparkSession, d: str) -> DataFrame:
    """Guides joined to cells by barcode, the last delivery of a barcode that names a perturbation winning."""
    return _repaired(spark, d, read(spark, d, "obs_cells").where("perturbation_id is not null"))


def repair_labels_all(spark: SparkSession, d: str) -> DataFrame:
    """The same with every delivery of a barcode, whether it names a perturbation or not."""
    return _repaired(spark, d, read(spark, d, "obs_cells"))


def _repaired(spark: SparkSession, d: str, seen: DataFrame) -> DataFrame:
    at = F.struct("loaded_at", "dataset_id", "cell_id")
    ids = seen.select(
        F.col("source_cell_barcode").alias("barcode"),
        at.alias("ord"),
        F.col("guide_id").alias("guide"),
        F.col("n_genes").alias("reads"),
        F.col("n_genes").alias("umis")
    )
    cells = latest_cells(spark, d, "source_cell_barcode").drop("loaded_at")
    fixed = curate.repair_labels(cells, ids.where("barcode is not null"), "source_cell_barcode", ["", "nan"])
    return fixed.groupBy("dataset_id", "matched", "control_status", "nperts").agg(F.count("*").alias("cells"), F.sum("read_count").alias("reads"))


VAR_FIELDS = ["gene_symbol", "gene_name", "chromosome", "start", "gene_type"]


def var_harmonize(spark: SparkSession, d: str) -> DataFrame:
    """Features of the raw records as delivered, on the canonical feature fields."""
    names = ["feature_id", *VAR_FIELDS]
    rows = read(spark, d, "raw_records").where("kind = 'var'").select("dataset_id", *[F.get_json_object("payload", f"$.{c}").alias(c) for c in names])
    rows = rows.withColumn("start", F.col("start").try_cast("double").try_cast("bigint"))  # 5.0E3 and 5000 are one place
    return harmonize.harmonize_var(rows, F.col("dataset_id"), F.col("feature_id")).distinct()


def var_harmonize_files(spark: SparkSession, d: str) -> DataFrame:
    """Features as delivered, on the canonical fields, read under every name that their file uses."""
    rows = read(spark, d, "raw_records").where("kind = 'var'").select("dataset_id", "file_id", "payload")
    return harmonize.harmonize_var_files(rows).distinct()


def verify_equal(spark: SparkSession, d: str) -> DataFrame:
    """The conditions as delivered against their latest versions."""
    cols = [c for c in read(spark, d, "conditions").columns if c != "loaded_at"]
    return curate.compare(read(spark, d, "conditions").select(cols), latest_conditions(spark, d).select(cols)).drop("left_digest", "right_digest")


def release_join(spark: SparkSession, d: str) -> DataFrame:
    """Data sets of each release with their check and their profile, and which of them is lacking."""
    key = ["release_id", "dataset_id"]
    qc = read(spark, d, "dataset_qc").where("release_id is not null and dataset_id is not null").groupBy(*key).agg(F.max("load_no").alias("qc_load"))
    prof = read(spark, d, "profile_index").where("release_id is not null and dataset_id is not null").groupBy(*key).agg(
        F.max("load_no").alias("profile_load")
    )
    return qc.join(prof, key, "full").withColumn(
        "lacking", F.when(F.col("qc_load").isNull(), "check").when(F.col("profile_load").isNull(), "profile").otherwise("")
    )


def artifact_anti_join(spark: SparkSession, d: str) -> DataFrame:
    """Analysis inputs that are checked but have no profile of the same file."""
    want = read(spark, d, "dataset_qc").select(F.col("analysis_input").alias("path")).where("path is not null").distinct()
    have = read(spark, d, "profile_index").select(F.col("h5ad_path").alias("path")).where("path is not null").distinct()
    return want.join(have, "path", "left_anti").withColumn("name", F.element_at(F.split("path", "/"), -1))


QUERIES = {
    f.__name__: f
    for f in (
        obs_harmonize,
        conditions,
        interventions,
        grain_counts,
        groups_bio_condition,
        pseudobulk_intervention,
        pseudobulk_condition,
        library_size,
        cpm_log1p,
        effects_intervention,
        top_genes,
        effect_stats,
        gene_ranking,
        contrast_cascade,
        contrast_controls,
        contrast_pooled,
        contrast_members,
        contrast_summary,
        effects_pooled,
        meta_gene_consistency,
        meta_summary,
        meta_dataset_summary,
        top_gene_recurrence,
        qc_perturbation,
        qc_dataset,
        profile_columns,
        profile_value_counts,
        profile_columns_all,
        profile_value_counts_all,
        matrix_profile, curate_filter, curate_counts, kept_runs, repair_labels, repair_labels_all, var_harmonize, var_harmonize_files, verify_equal, release_join, artifact_anti_join,
    )
}

# ------------------------------------------------------------------------------------ SQL

_CELLS = """cells AS (
  SELECT o_orderkey AS cell_ord, r_name AS dataset_id, c_mktsegment AS cell_line, n_name AS batch_id, o_orderstatus AS replicate_id,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'control' ELSE o_orderpriority END AS perturbation_id, CAST(year(o_orderdate) AS VARCHAR) AS time, 'y' AS time_unit,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'control' ELSE 'targeting' END AS control_status, CASE WHEN o_orderpriority = '5-LOW' THEN 'true' ELSE 'false' END AS is_control,
    '' AS cell_type, '' AS disease, '' AS dose, '' AS dose_unit, '' AS perturbation_type, '' AS perturbation_target, '' AS guide_id, '' AS drug_id
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), counts AS (
  SELECT dataset_id, cell_ord, p_brand AS feature_id, l_quantity AS value FROM lineitem JOIN part ON l_partkey = p_partkey JOIN cells ON l_orderkey = cell_ord
)"""


def _groups(grain: str) -> str:
    keys = ", ".join(GRAINS[grain])
    return f"""grouped AS (SELECT {keys}, count(*) AS cell_count, min(cell_ord) AS first_ord FROM cells GROUP BY {keys}),
groups AS (SELECT dataset_id || '_{grain.replace("-", "_")}_' || lpad(CAST(row_number() OVER (PARTITION BY dataset_id ORDER BY first_ord) AS VARCHAR), 7, '0') AS group_id, * FROM grouped),
sums AS (
  SELECT c.dataset_id, group_id, feature_id, CAST(sum(value) AS DOUBLE) AS count_sum FROM counts c JOIN cells USING (dataset_id, cell_ord) JOIN groups USING ({keys})
  GROUP BY 1, 2, 3 HAVING sum(value) <> 0
)"""


_BASE = f"WITH {_CELLS}"
_OBS = "obs AS (SELECT * FROM obs_cells QUALIFY row_number() OVER (PARTITION BY dataset_id, cell_id ORDER BY loaded_at DESC) = 1)"
_COND = "cond AS (SELECT * FROM conditions QUALIFY row_number() OVER (PARTITION BY condition_id ORDER BY loaded_at DESC) = 1)"
_NORM = r"replace(lower(regexp_replace({c}, '^\s+|\s+$', '', 'g')), '_', '-')"
_CTL = ", ".join(f"'{c}'" for c in harmonize.CONTROLS)


def _is_control(p: str, s: str) -> str:
    return f"(coalesce({_NORM.format(c=s)} IN ({_CTL}, 'true', '1'), false) OR coalesce({_NORM.format(c=p)} IN ({_CTL}), false))"


def _b(c: str) -> str:
    return f"coalesce({c}, '') AS {c}"


def _numbered(prefix: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"""WITH {_OBS}, filled AS (SELECT {", ".join(map(_b, keys))} FROM obs)
SELECT '{prefix}_' || lpad(CAST(row_number() OVER (ORDER BY {k}) AS VARCHAR), 7, '0') AS {prefix}_id, {k}, count(*) AS cell_count FROM filled GROUP BY {k}"""


_DELTA = """, effects AS (
  SELECT {key}, feature_id, CASE WHEN t_lib > 0 THEN ln(1 + coalesce(t_sum, 0) / t_lib * 1e6) ELSE 0 END AS treated_log1p_cpm,
    CASE WHEN c_lib > 0 THEN ln(1 + coalesce(c_sum, 0) / c_lib * 1e6) ELSE 0 END AS control_log1p_cpm FROM sides
), delta AS (SELECT *, treated_log1p_cpm - control_log1p_cpm AS effect_size FROM effects)"""

def _effects_sql(grain: str) -> str:
    """Effects of the treated groups of a grain, as table expressions."""
    return f"{_BASE}, {_groups(grain)}" + f""", treated AS (
  SELECT *, dataset_id || '_contrast_' || lpad(CAST(row_number() OVER (PARTITION BY dataset_id ORDER BY first_ord) AS VARCHAR), 7, '0') AS contrast_id
  FROM groups WHERE is_control <> 'true' AND cell_count >= {MIN_CELLS}
), ctl AS (SELECT dataset_id, feature_id, sum(count_sum) AS c_sum FROM sums WHERE group_id IN (SELECT group_id FROM groups WHERE is_control = 'true') GROUP BY 1, 2),
libs AS (
  SELECT t.dataset_id, contrast_id, group_id, perturbation_id, coalesce((SELECT sum(count_sum) FROM sums s WHERE s.group_id = t.group_id), 0) AS t_lib,
    (SELECT sum(c_sum) FROM ctl WHERE ctl.dataset_id = t.dataset_id) AS c_lib FROM treated t
), pairs AS (
  SELECT contrast_id, feature_id FROM libs JOIN ctl USING (dataset_id) UNION SELECT contrast_id, feature_id FROM libs JOIN sums USING (group_id)
), sides AS (
  SELECT l.dataset_id, contrast_id, perturbation_id, p.feature_id, s.count_sum AS t_sum, c_sum, t_lib, c_lib
  FROM pairs p JOIN libs l USING (contrast_id) LEFT JOIN sums s ON s.group_id = l.group_id AND s.feature_id = p.feature_id LEFT JOIN ctl ON ctl.dataset_id = l.dataset_id AND ctl.feature_id = p.feature_id
  WHERE c_lib IS NOT NULL
)""" + _DELTA.format(key="dataset_id, contrast_id, perturbation_id")


_BIO_EFFECTS = _effects_sql("bio-condition")

_PREP = "prep AS (SELECT " + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), '') AS {c}" for c in sorted(
        {*contrast.STRICT, *contrast.CONTEXT, "control_status", "condition_id", "is_control"}
    )
) + ", coalesce(TRY_CAST(nullif(CAST(cell_count AS VARCHAR), '') AS BIGINT), 0) AS cells FROM cond)"
_T, _C = "SELECT * FROM prep WHERE is_control <> 'true'", "SELECT * FROM prep WHERE is_control = 'true'"


def _pool(name: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"{name} AS (SELECT {k}, CAST(sum(cells) AS BIGINT) AS {name}_cells, count(*) AS {name}_n FROM ctl GROUP BY {k})"


_CASCADE = f"""WITH {_COND}, {_PREP}, ctl AS ({_C}), trt AS ({_T}), {_pool("s", contrast.STRICT)}, {_pool("b", contrast.BIO)}, {_pool("g", contrast.DATASET)},
matched AS (
  SELECT t.*, row_number() OVER (ORDER BY condition_id) AS number,
    CASE WHEN s_n IS NOT NULL THEN 'strict_context_batch_replicate' WHEN b_n IS NOT NULL THEN 'bio_context' WHEN g_n IS NOT NULL THEN 'dataset_fallback' ELSE 'unmatched' END AS match_rule,
    CASE WHEN s_n IS NOT NULL THEN s_cells WHEN b_n IS NOT NULL THEN b_cells WHEN g_n IS NOT NULL THEN g_cells ELSE 0 END AS control_cell_count,
    CASE WHEN s_n IS NOT NULL THEN s_n WHEN b_n IS NOT NULL THEN b_n WHEN g_n IS NOT NULL THEN g_n ELSE 0 END AS control_match_count
  FROM trt t LEFT JOIN s USING ({", ".join(contrast.STRICT)}) LEFT JOIN b USING ({", ".join(contrast.BIO)}) LEFT JOIN g USING (dataset_id)
), contrasts AS (
  SELECT 'condition_contrast_' || lpad(CAST(number AS VARCHAR), 8, '0') AS contrast_id, dataset_id, condition_id AS treated_condition_id, match_rule,
    CASE WHEN match_rule = 'unmatched' OR cells < 50 OR control_cell_count < 50 THEN 'fail' WHEN match_rule = 'dataset_fallback' THEN 'warn' ELSE 'pass' END AS status,
    concat_ws('; ', CASE WHEN match_rule = 'unmatched' THEN 'no matched controls' END, CASE WHEN cells < 50 THEN 'treated cells below threshold: ' || cells || ' < 50' END,
      CASE WHEN control_cell_count < 50 THEN 'control cells below threshold: ' || control_cell_count || ' < 50' END, CASE WHEN match_rule = 'dataset_fallback' THEN 'controls matched only at dataset level' END) AS reason,
    perturbation_id, cell_line, cell_type, disease, dose, dose_unit, time, time_unit, batch_id, replicate_id, cells AS treated_cell_count, control_cell_count, control_match_count FROM matched
)"""


def _pooled_sql(source: str, a: int, b: int, s: int) -> str:
    """Pooled contrasts of a prepared table of conditions, as table expressions."""
    ctx, strict = ", ".join(contrast.CONTEXT), ", ".join(contrast.STRICT)
    return f"""p_ctl AS (SELECT {strict}, sum(cells) AS c_cells, count(*) AS c_n FROM {source} WHERE is_control = 'true' GROUP BY {strict}),
p_members AS (SELECT t.*, c_cells, c_n FROM (SELECT * FROM {source} WHERE is_control <> 'true') t LEFT JOIN p_ctl USING ({strict})),
p_strata AS (SELECT {ctx}, batch_id, replicate_id, sum(CASE WHEN c_n IS NOT NULL THEN cells ELSE 0 END) AS t_cells, count(c_n) AS t_n, max(c_cells) AS c_cells, max(c_n) AS c_n FROM p_members GROUP BY {ctx}, batch_id, replicate_id),
p_sums AS (SELECT {ctx}, CAST(sum(t_cells) AS BIGINT) AS t, CAST(coalesce(sum(c_cells), 0) AS BIGINT) AS c, CAST(sum(t_n) AS BIGINT) AS tn, CAST(coalesce(sum(c_n), 0) AS BIGINT) AS cn, count(c_n) AS st FROM p_strata GROUP BY {ctx}),
pooled AS (
  SELECT 'pooled_contrast_' || lpad(CAST(row_number() OVER (ORDER BY {ctx}) AS VARCHAR), 8, '0') AS contrast_id, {ctx},
    CASE WHEN st = 0 OR t < {a} OR c < {b} THEN 'fail' WHEN st < {s} THEN 'warn' ELSE 'pass' END AS status,
    concat_ws('; ', CASE WHEN st = 0 THEN 'no matched control strata' END, CASE WHEN t < {a} THEN 'treated cells below pooled threshold: ' || t || ' < {a}' END,
      CASE WHEN c < {b} THEN 'control cells below pooled threshold: ' || c || ' < {b}' END, CASE WHEN st > 0 AND st < {s} THEN 'matched strata below recommendation: ' || st || ' < {s}' END) AS reason,
    'pooled_context_strata' AS match_rule, t AS treated_cell_count, c AS control_cell_count, tn AS treated_condition_count, cn AS control_condition_count, st AS matched_strata_count FROM p_sums
)"""


def _bridge_sql(source: str) -> str:
    ctx, strict = ", ".join(contrast.CONTEXT), ", ".join(contrast.STRICT)
    return f"""keyed AS (SELECT contrast_id, m.* FROM p_members m JOIN pooled USING ({ctx}) WHERE m.c_n IS NOT NULL),
bridge AS (
  SELECT contrast_id, 'treated' AS role, condition_id FROM keyed
  UNION ALL SELECT contrast_id, 'control', c.condition_id FROM (SELECT DISTINCT contrast_id, {strict} FROM keyed) k JOIN (SELECT * FROM {source} WHERE is_control = 'true') c USING ({strict})
)"""


_POOLED_COND = f"WITH {_COND}, {_PREP}, {_pooled_sql('prep', 50, 50, 2)}"
_KEYS = ", ".join(CONDITION)
_POOLED_EFFECTS = (
    f"{_BASE}, {_groups('condition')}, named AS (SELECT 'condition_' || lpad(CAST(row_number() OVER (ORDER BY {_KEYS}) AS VARCHAR), 7, '0') AS condition_id, {_KEYS}, cell_count AS cells, group_id FROM groups), "
    + _pooled_sql("named", POOLED["min_treated"], POOLED["min_control"], POOLED["min_strata"])
    + ", "
    + _bridge_sql("named")
    + """, used AS (SELECT contrast_id, status, perturbation_id FROM pooled WHERE status IN ('pass', 'warn')),
member_sums AS (
  SELECT s.dataset_id, b.contrast_id, s.feature_id, sum(CASE WHEN role = 'treated' THEN count_sum END) AS t_sum, sum(CASE WHEN role = 'control' THEN count_sum END) AS c_sum
  FROM bridge b JOIN used USING (contrast_id) JOIN named n ON n.condition_id = b.condition_id JOIN sums s ON s.group_id = n.group_id GROUP BY 1, 2, 3
), libs AS (SELECT dataset_id, contrast_id, coalesce(sum(t_sum), 0) AS t_lib, coalesce(sum(c_sum), 0) AS c_lib FROM member_sums GROUP BY 1, 2),
sides AS (SELECT m.*, t_lib, c_lib, status, perturbation_id FROM member_sums m JOIN libs USING (dataset_id, contrast_id) JOIN used USING (contrast_id))"""
    + _DELTA.format(key="dataset_id, contrast_id, status, perturbation_id")
    + f", hits AS (SELECT dataset_id, contrast_id, status, feature_id AS gene_id, effect_size AS effect FROM delta QUALIFY row_number() OVER (PARTITION BY dataset_id, contrast_id ORDER BY abs(round(effect_size, 6)) DESC, feature_id) <= {TOP})"
)
_CONSISTENCY = """, medians AS (SELECT gene_id, dataset_id, median(effect) AS m FROM hits GROUP BY 1, 2),
by_dataset AS (SELECT gene_id, greatest(count(*) FILTER (WHERE m > 0), count(*) FILTER (WHERE m < 0)) / count(*)::DOUBLE AS dataset_sign_consistency FROM medians GROUP BY 1),
raw_genes AS (
  SELECT gene_id, count(DISTINCT dataset_id) AS dataset_count, count(DISTINCT (dataset_id, contrast_id)) AS contrast_count, count(*) AS hit_count, count(*) FILTER (WHERE status = 'pass') AS pass_hits,
    count(*) FILTER (WHERE status = 'warn') AS warn_hits, count(*) FILTER (WHERE effect > 0) AS positive_hits, count(*) FILTER (WHERE effect < 0) AS negative_hits, avg(effect) AS mean_effect,
    median(effect) AS median_effect, avg(abs(effect)) AS mean_abs_effect, max(abs(effect)) AS max_abs_effect, string_agg(DISTINCT dataset_id, ';' ORDER BY dataset_id) AS datasets FROM hits GROUP BY 1
), genes AS (
  SELECT gene_id, dataset_count, contrast_count, hit_count, pass_hits, warn_hits, positive_hits, negative_hits, round(mean_effect, 6) AS mean_effect, round(median_effect, 6) AS median_effect,
    round(mean_abs_effect, 6) AS mean_abs_effect, round(max_abs_effect, 6) AS max_abs_effect, datasets, round(dataset_sign_consistency, 6) AS dataset_sign_consistency,
    round(greatest(positive_hits, negative_hits) / hit_count::DOUBLE, 6) AS sign_consistency,
    round(dataset_count * (greatest(positive_hits, negative_hits) / hit_count::DOUBLE) * log10(hit_count + 1) * mean_abs_effect, 6) AS conserved_response_score FROM raw_genes JOIN by_dataset USING (gene_id)
)"""
_GENES = _POOLED_EFFECTS + _CONSISTENCY
_INTERVENTION_GENES = (
    _effects_sql("intervention")
    + f""", hits AS (SELECT dataset_id, contrast_id, 'pass' AS status, feature_id AS gene_id, effect_size AS effect FROM delta
  QUALIFY row_number() OVER (PARTITION BY dataset_id, contrast_id ORDER BY abs(round(effect_size, 6)) DESC, feature_id) <= {TOP})"""
    + _CONSISTENCY
)
_EFFECT_COLS = "round(treated_log1p_cpm, 6) AS treated_log1p_cpm, round(control_log1p_cpm, 6) AS control_log1p_cpm, round(effect_size, 6) AS effect_size"
_RANKING = ", ".join(f"{c} DESC" for c in meta.RANKING) + ", gene_id"
_QC = rf"""WITH {_OBS}, labelled AS (
  SELECT dataset_id, CASE WHEN {{miss_p}} THEN '<missing>' ELSE perturbation_id END AS perturbation_id, {_is_control("perturbation_id", "control_status")} AS ctl, CASE WHEN {{miss_b}} THEN NULL ELSE batch_id END AS batch FROM obs
)""".format(**{k: f"({c} IS NULL OR lower(regexp_replace({c}, '^\\s+|\\s+$', '', 'g')) IN ('', 'nan', 'none', 'null', 'na', '<missing>'))" for k, c in (("miss_p", "perturbation_id"), ("miss_b", "batch_id"))})

_ALL = sorted({k for ks in GRAINS.values() for k in ks})
_SETS = ", ".join("(" + ", ".join(ks) + ")" for ks in GRAINS.values())


def _grain_sql() -> str:
    parts = [
        f"SELECT '{g}' AS grain, dataset_id, count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_cells FROM (SELECT {', '.join(ks)}, count(*) AS n FROM filled GROUP BY {', '.join(ks)}) GROUP BY dataset_id" for g,
        ks in GRAINS.items()
    ]
    return f"WITH {_OBS}, filled AS (SELECT {', '.join(map(_b, _ALL))} FROM obs) " + " UNION ALL ".join(parts)


_TEXT = [
    "cell_line",
    "cell_type",
    "disease",
    "organism",
    "perturbation_id",
    "perturbation_type",
    "perturbation_target",
    "guide_id",
    "dose",
    "dose_unit",
    "time",
    "time_unit",
    "batch_id",
    "replicate_id",
    "n_counts",
    "n_genes",
    "percent_mito",
    "percent_ribo"
]

SQL = {
    "obs_harmonize": f"""WITH {_OBS}, h AS (SELECT dataset_id, cell_id, {", ".join(map(_b, _TEXT))}, coalesce(control_status, '') AS cs, coalesce(drug_id, '') AS dr, coalesce(source_cell_barcode, '') AS bc FROM obs),
c AS (SELECT *, {_is_control("perturbation_id", "cs")} AS ctl FROM h)
SELECT dataset_id, cell_id, {", ".join(_TEXT)}, CASE WHEN cs <> '' THEN cs WHEN ctl THEN 'control' ELSE 'targeting' END AS control_status, CASE WHEN ctl THEN 'true' ELSE 'false' END AS is_control,
  CASE WHEN dr = '' AND perturbation_type = 'drug' THEN perturbation_id ELSE dr END AS drug_id, CASE WHEN bc = '' THEN cell_id ELSE bc END AS source_cell_barcode FROM c""",
    "conditions": _numbered("condition", CONDITION),
    "interventions": _numbered("intervention", INTERVENTION),
    "grain_counts": _grain_sql(),
    "groups_bio_condition": f"{_BASE}, {_groups('bio-condition')} SELECT group_id, dataset_id, cell_line, perturbation_id, time, is_control, cell_count, first_ord FROM groups",
    "pseudobulk_intervention": f"{_BASE}, {_groups('intervention')} SELECT * FROM sums",
    "pseudobulk_condition": f"{_BASE}, {_groups('condition')} SELECT * FROM sums",
    "library_size": f"{_BASE}, {_groups('condition')} SELECT dataset_id, group_id, sum(count_sum) AS library_size, count(*) AS n_features FROM sums GROUP BY 1, 2",
    "cpm_log1p": f"{_BASE}, {_groups('bio-condition')} SELECT dataset_id, group_id, feature_id, round(ln(1 + count_sum / sum(count_sum) OVER (PARTITION BY dataset_id, group_id) * 1e6), 6) AS log1p_cpm FROM sums",
    "effects_intervention": f"{_BIO_EFFECTS} SELECT dataset_id, contrast_id, perturbation_id, feature_id, {_EFFECT_COLS} FROM delta",
    "top_genes": f"""{_BIO_EFFECTS}, names AS (SELECT DISTINCT dataset_id, feature_id FROM counts), dense AS (
  SELECT l.dataset_id, l.contrast_id, l.perturbation_id, n.feature_id, coalesce(d.effect_size, 0) AS effect_size, d.feature_id IS NULL AS implied FROM libs l JOIN names n USING (dataset_id) LEFT JOIN delta d ON d.contrast_id = l.contrast_id AND d.feature_id = n.feature_id
)
SELECT dataset_id, contrast_id, perturbation_id, feature_id AS gene_id, round(effect_size, 6) AS effect_size, CAST(row_number() OVER w AS INTEGER) AS rank_abs_effect FROM dense
WINDOW w AS (PARTITION BY dataset_id, contrast_id ORDER BY implied, abs(effect_size) DESC, feature_id) QUALIFY row_number() OVER w <= {TOP}""",
    "effect_stats": f"""{_BIO_EFFECTS}, names AS (SELECT DISTINCT dataset_id, feature_id FROM counts), dense AS (
  SELECT l.dataset_id, l.contrast_id, abs(coalesce(d.effect_size, 0)) AS e FROM libs l JOIN names n USING (dataset_id) LEFT JOIN delta d ON d.contrast_id = l.contrast_id AND d.feature_id = n.feature_id
), each AS (SELECT dataset_id, contrast_id, count(*) AS features, max(e) AS most, quantile_cont(e, 0.95) AS p95 FROM dense GROUP BY 1, 2)
SELECT dataset_id, count(*) AS contrasts, max(features) AS features, round(quantile_cont(most, 0.5), 6) AS median_max_abs, round(quantile_cont(most, 0.9), 6) AS p90_max_abs, round(quantile_cont(p95, 0.5), 6) AS median_p95_abs FROM each GROUP BY 1""",
    "gene_ranking": f"{_INTERVENTION_GENES} SELECT *, row_number() OVER (ORDER BY {_RANKING}) AS rank FROM genes QUALIFY rank <= 100",
    "contrast_cascade": f"{_CASCADE} SELECT * FROM contrasts",
    "contrast_controls": f"""{_CASCADE}, m AS ({" UNION ALL ".join(f"SELECT contrast_id, c.condition_id FROM contrasts x JOIN ctl c USING ({', '.join(k)}) WHERE match_rule = '{r}'" for r, k in contrast.RULES.items())})
SELECT contrast_id, count(*) AS members, min(condition_id) AS first_control, max(condition_id) AS last_control FROM m GROUP BY 1""",
    "contrast_pooled": f"{_POOLED_COND} SELECT * FROM pooled",
    "contrast_members": f"""{_POOLED_EFFECTS}
SELECT contrast_id, coalesce(string_agg(DISTINCT condition_id, ';' ORDER BY condition_id) FILTER (WHERE role = 'treated'), '') AS treated_condition_ids,
  coalesce(string_agg(DISTINCT condition_id, ';' ORDER BY condition_id) FILTER (WHERE role = 'control'), '') AS control_condition_ids FROM bridge GROUP BY 1""",
    "contrast_summary": f"{_CASCADE}, {_pooled_sql('prep', 50, 50, 2)} SELECT match_rule, status, count(*) AS contrasts FROM contrasts GROUP BY 1, 2 UNION ALL SELECT match_rule, status, count(*) FROM pooled GROUP BY 1, 2",
    "effects_pooled": f"{_POOLED_EFFECTS} SELECT dataset_id, contrast_id, status, perturbation_id, feature_id, {_EFFECT_COLS} FROM delta",
    "meta_gene_consistency": f"{_GENES} SELECT * FROM genes",
    "meta_summary": f"{_GENES} SELECT *, row_number() OVER (ORDER BY {_RANKING}) AS rank FROM genes QUALIFY rank <= 100",
    "meta_dataset_summary": f"""{_POOLED_EFFECTS}, c AS (SELECT dataset_id, count(DISTINCT contrast_id) AS input_contrasts, count(DISTINCT CASE WHEN status IN ('pass', 'warn') THEN contrast_id END) AS included_contrasts FROM pooled GROUP BY 1),
h AS (SELECT dataset_id, count(*) AS n FROM hits GROUP BY 1)
SELECT dataset_id, input_contrasts, included_contrasts, coalesce(n, 0) AS input_top_gene_hits, coalesce(n, 0) AS included_top_gene_hits FROM c LEFT JOIN h USING (dataset_id)""",
    "top_gene_recurrence": f"{_POOLED_EFFECTS} SELECT gene_id, count(DISTINCT dataset_id) AS dataset_count, count(*) AS hit_count, round(max(abs(effect)), 6) AS max_abs_effect FROM hits GROUP BY 1 ORDER BY 2 DESC, 3 DESC, 4 DESC, 1 LIMIT 25",
    "qc_perturbation": f"""{_QC}, r AS (SELECT dataset_id, perturbation_id, count(*) AS n, count(*) FILTER (WHERE ctl) AS c, count(DISTINCT batch) AS levels FROM labelled GROUP BY 1, 2),
t AS (SELECT dataset_id, CAST(sum(c) AS BIGINT) AS total FROM r GROUP BY 1), m AS (
  SELECT r.dataset_id, perturbation_id, c = n AS is_control, n AS cell_count, total AS control_cells_in_dataset, levels AS batch_level_count,
    concat_ws('; ', CASE WHEN perturbation_id = '<missing>' THEN 'missing perturbation label' END, CASE WHEN c <> n AND n < 50 THEN 'cell count below threshold: ' || n || ' < 50' END,
      CASE WHEN c <> n AND total < 50 THEN 'dataset control cells below threshold: ' || total || ' < 50' END) AS failures,
    concat_ws('; ', CASE WHEN c <> n AND levels <= 1 THEN 'perturbation observed in one batch/replicate level' END) AS warnings FROM r JOIN t USING (dataset_id)
)
SELECT *, CASE WHEN is_control THEN 'control' WHEN failures <> '' THEN 'fail' WHEN warnings <> '' THEN 'warn' ELSE 'pass' END AS status FROM m""",
    "qc_dataset": f"""{_QC}, s AS (
  SELECT dataset_id, count(*) AS cells, count(*) FILTER (WHERE perturbation_id = '<missing>') AS missing, count(DISTINCT perturbation_id) FILTER (WHERE perturbation_id <> '<missing>') AS labels, count(*) FILTER (WHERE ctl) AS controls FROM labelled GROUP BY 1
), p AS (SELECT dataset_id, n_obs, coalesce(matrix_integer_like_sample = 'True', false) AS whole, counts_location IS NOT DISTINCT FROM 'X' AS bare FROM dataset_qc
  QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY load_no DESC NULLS LAST, loaded_at DESC NULLS LAST, n_obs DESC NULLS LAST, matrix_integer_like_sample DESC NULLS LAST, counts_location DESC NULLS LAST) = 1), m AS (
  SELECT s.dataset_id, cells AS n_obs, labels AS perturbation_count, missing AS missing_perturbation_cells, controls AS control_cells,
    concat_ws('; ', CASE WHEN NOT coalesce(whole, false) THEN 'sampled matrix values are not integer-like' END, CASE WHEN p.n_obs IS DISTINCT FROM cells THEN 'profile n_obs does not match observed perturbation vector' END,
      CASE WHEN missing > 0 THEN 'missing perturbation labels: ' || missing END, CASE WHEN controls < 50 THEN 'control cells below threshold: ' || controls || ' < 50' END) AS failures,
    concat_ws('; ', CASE WHEN p.dataset_id IS NULL OR bare THEN 'no raw object or count layer; X is treated as counts' END) AS warnings FROM s LEFT JOIN p USING (dataset_id)
)
SELECT *, CASE WHEN failures <> '' THEN 'fail' WHEN warnings <> '' THEN 'warn' ELSE 'pass' END AS status FROM m""",
    "profile_columns": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL{'' if c == 'collected_at' else f''' OR lower({c}) IN ('nan', 'none', 'null', 'na')'''}) AS missing_count, count(DISTINCT coalesce(CAST({c} AS VARCHAR), 'None')) AS unique_count FROM obs_cells" for c in PROFILED
    ),
    "profile_value_counts": "WITH long AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS v FROM obs_cells" for c in (
            "cell_line", "disease", "perturbation_id", "control_status", "batch_id", "time"
        )
    )
    + "), k AS (SELECT column_name, CASE WHEN v IS NULL OR lower(v) IN ('', 'nan', 'none', 'null', 'na') THEN '<missing>' ELSE v END AS value, count(*) AS n_rows FROM long GROUP BY 1, 2) SELECT *, CAST(row_number() OVER w AS INTEGER) AS place FROM k WINDOW w AS (PARTITION BY column_name ORDER BY n_rows DESC, value) QUALIFY row_number() OVER w <= 20",
    "matrix_profile": f"""{_BASE}, t AS (SELECT dataset_id, cell_ord, feature_id, sum(value) AS v FROM counts GROUP BY 1, 2, 3), o AS (SELECT dataset_id, count(*) AS n_obs FROM cells GROUP BY 1), f AS (SELECT dataset_id, count(DISTINCT feature_id) AS n_vars FROM counts GROUP BY 1)
SELECT dataset_id, n_obs, n_vars, count(*) FILTER (WHERE v <> 0) AS nnz, bool_and(abs(v - round(v)) <= 1e-8 + 1e-5 * abs(round(v))) AS integer_like, CAST(min(v) AS DOUBLE) AS least, CAST(max(v) AS DOUBLE) AS most,
  round(count(*) FILTER (WHERE v <> 0) / (n_obs * n_vars)::DOUBLE, 6) AS density FROM t JOIN o USING (dataset_id) JOIN f USING (dataset_id) GROUP BY 1, 2, 3""",
    "curate_filter": f"""WITH {_OBS}, k AS (SELECT dataset_id, count(*) AS cells_before, count(*) FILTER (WHERE perturbation_id IS NOT NULL AND lower(perturbation_id) <> 'nan') AS cells_after FROM obs GROUP BY 1)
SELECT *, cells_before - cells_after AS cells_excluded, CASE WHEN cells_before = cells_after THEN 'passthrough' ELSE 'curated' END AS mode FROM k""",
    "curate_counts": f"{_BASE} SELECT c.dataset_id, feature_id, sum(value) AS count_sum FROM counts c JOIN cells USING (dataset_id, cell_ord) WHERE replicate_id <> 'F' GROUP BY 1, 2",
    "kept_runs": f"""{_BASE}, k AS (SELECT dataset_id, cell_ord, cell_ord - row_number() OVER (PARTITION BY dataset_id ORDER BY cell_ord) AS run FROM cells WHERE replicate_id <> 'F')
SELECT dataset_id, min(cell_ord) AS first, max(cell_ord) AS last, max(cell_ord) - min(cell_ord) + 1 AS n FROM k GROUP BY dataset_id, run""",
    "repair_labels": f"""WITH {_OBS}, ids AS (SELECT source_cell_barcode AS barcode, guide_id, CAST(coalesce(trunc(TRY_CAST(trim(n_genes) AS DOUBLE)), 0) AS BIGINT) AS reads FROM obs_cells
  WHERE perturbation_id IS NOT NULL AND source_cell_barcode IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_cell_barcode ORDER BY loaded_at DESC, dataset_id DESC, cell_id DESC) = 1),
r AS (SELECT o.dataset_id, i.barcode IS NOT NULL AS matched, CASE WHEN i.barcode IS NULL THEN NULL WHEN i.guide_id IN ('', 'nan') THEN 'negative_control' ELSE 'targeting' END AS control_status,
  CASE WHEN i.barcode IS NOT NULL AND i.guide_id IN ('', 'nan') THEN 0 ELSE 1 END AS nperts, coalesce(reads, 0) AS reads FROM obs o LEFT JOIN ids i ON o.source_cell_barcode = i.barcode)
SELECT dataset_id, matched, control_status, nperts, count(*) AS cells, CAST(sum(reads) AS BIGINT) AS reads FROM r GROUP BY 1, 2, 3, 4""",
    "var_harmonize": """WITH v AS (SELECT dataset_id, coalesce(payload->>'$.feature_id', '') AS feature_id, coalesce(payload->>'$.gene_symbol', '') AS gene_symbol, coalesce(payload->>'$.chromosome', '') AS chromosome,
  coalesce(CAST(CAST(TRY_CAST(payload->>'$.start' AS DOUBLE) AS BIGINT) AS VARCHAR), '') AS start, coalesce(payload->>'$.gene_type', '') AS gene_type FROM raw_records WHERE kind = 'var' AND json_valid(payload))
SELECT DISTINCT dataset_id, feature_id, feature_id AS gene_id, CASE WHEN gene_symbol = '' THEN feature_id ELSE gene_symbol END AS gene_symbol, '' AS ensembl_id, chromosome, start, '' AS "end", gene_type, '' AS highly_variable FROM v""",
    "verify_equal": f"""WITH {_COND}, l AS (SELECT * EXCLUDE (loaded_at), count(*) AS a FROM conditions GROUP BY ALL), r AS (SELECT * EXCLUDE (loaded_at), count(*) AS b FROM cond GROUP BY ALL),
u AS (SELECT *, 0 AS b FROM l UNION ALL SELECT * EXCLUDE (b), 0 AS a, b FROM r), k AS (SELECT * EXCLUDE (a, b), sum(a) AS a, sum(b) AS b FROM u GROUP BY ALL), s AS (
  SELECT CAST(sum(a) AS BIGINT) AS left_rows, CAST(sum(b) AS BIGINT) AS right_rows, CAST(sum(greatest(0, a - b)) AS BIGINT) AS only_left, CAST(sum(greatest(0, b - a)) AS BIGINT) AS only_right FROM k)
SELECT *, CASE WHEN only_left = 0 AND only_right = 0 THEN 'pass' ELSE 'fail' END AS status FROM s""",
    "release_join": """WITH q AS (SELECT release_id, dataset_id, max(load_no) AS qc_load FROM dataset_qc WHERE release_id IS NOT NULL AND dataset_id IS NOT NULL GROUP BY 1, 2),
p AS (SELECT release_id, dataset_id, max(load_no) AS profile_load FROM profile_index WHERE release_id IS NOT NULL AND dataset_id IS NOT NULL GROUP BY 1, 2)
SELECT release_id, dataset_id, qc_load, profile_load, CASE WHEN qc_load IS NULL THEN 'check' WHEN profile_load IS NULL THEN 'profile' ELSE '' END AS lacking FROM q FULL JOIN p USING (release_id, dataset_id)""",
    "artifact_anti_join": "SELECT DISTINCT analysis_input AS path, string_split(analysis_input, '/')[-1] AS name FROM dataset_qc WHERE analysis_input IS NOT NULL AND analysis_input NOT IN (SELECT h5ad_path FROM profile_index WHERE h5ad_path IS NOT NULL)",
}
