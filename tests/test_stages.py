import math

import pytest
from pyspark.sql import functions as F

from assaylake.functions.numbering import latest, number_rows
from assaylake.functions.text import is_missing_profile, is_missing_qc, normalize, safe_stem, split_ids, text_of, to_count, to_double
from assaylake.operators import cellqc, contrast, curate, effects, harmonize, meta, pseudobulk, tableprofile
from assaylake.plans import stages

COND = [
    "condition_id",
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
    "is_control",
    "batch_id",
    "replicate_id",
    "cell_count"
]


def cond(spark, rows):
    """rows: id, dataset, cell_line, perturbation, is_control, batch, replicate, cells."""
    full = [(i, d, line, None, "leukemia", p, "", "", "", "", "", c, b, r, str(n), "odd") for i, d, line, p, c, b, r, n in rows]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in [*COND, "cells"]))


def test_cascade_rules_and_reasons(spark):
    rows = cond(spark, [
        ("c1", "ds", "K562", "control", "true", "b1", "", 100), ("t1", "ds", "K562", "geneA", "false", "b1", None, 80), (
            "t2", "ds", "K562", "geneB", "false", "b2", "", 80
        ),
        ("t3", "ds", "K562", "geneC", "false", "b1", "", 10), ("t4", "ds", "HL60", "geneD", "false", "b1", "", 60), (
            "t5", "other", "K562", "geneE", "false", "b1", "", "x"
        ),
    ])
    got = {r.treated_condition_id: r for r in contrast.condition_contrasts(rows).collect()}
    assert {k: (r.match_rule, r.status) for k, r in got.items()} == {
        "t1": ("strict_context_batch_replicate", "pass"),
        "t2": ("bio_context", "pass"),
        "t3": ("strict_context_batch_replicate", "fail"),
        "t4": ("dataset_fallback", "warn"),
        "t5": ("unmatched", "fail"),
    }
    assert got["t3"].reason == "treated cells below threshold: 10 < 50"
    assert got["t4"].reason == "controls matched only at dataset level"
    assert got["t5"].reason == "no matched controls; treated cells below threshold: 0 < 50; control cells below threshold: 0 < 50"
    assert [got[t].contrast_id for t in ("t1", "t5")] == ["condition_contrast_00000001", "condition_contrast_00000005"]
    assert contrast.contrast_controls(contrast.condition_contrasts(rows), rows).count() == 4


def test_pooled_strata(spark):
    rows = cond(spark, [
        ("k1", "ds", "K562", "control", "true", "b1", "r1", 100), ("k2", "ds", "K562", "control", "true", "b2", "r2", 100), (
            "a1", "ds", "K562", "geneA", "false", "b1", "r1", 30
        ),
        ("a2", "ds", "K562", "geneA", "false", "b2", "r2", 30), ("b3", "ds", "K562", "geneB", "false", "b3", "r1", 70),
    ])
    pooled = contrast.pooled_contrasts(rows)
    got = {r.perturbation_id: r for r in pooled.collect()}
    a, b = got["geneA"], got["geneB"]
    assert (a.status, a.treated_cell_count, a.control_cell_count, a.matched_strata_count) == ("pass", 60, 200, 2)
    assert b.status == "fail" and b.reason.startswith("no matched control strata; treated cells below pooled threshold: 0 < 50")
    lists = {r.contrast_id: r for r in contrast.member_lists(contrast.pooled_bridge(rows, pooled)).collect()}
    assert (lists[a.contrast_id].treated_condition_ids, lists[a.contrast_id].control_condition_ids) == ("a1;a2", "k1;k2")
    assert b.contrast_id not in lists
    assert contrast.pooled_contrasts(rows.limit(0)).count() == 0 and contrast.condition_contrasts(rows.limit(0)).count() == 0


def cells_and_counts(spark):
    cells = [(i, "ds", p, "true" if p == "control" else "false") for i, p in enumerate(["control", "geneA", "geneA", "control"])]
    c = spark.createDataFrame(cells, "cell_ord long, dataset_id string, perturbation_id string, is_control string")
    for k in sorted({k for ks in harmonize.GRAINS.values() for k in ks} - set(c.columns)):
        c = c.withColumn(k, F.lit(None).cast("string"))
    dense = [[1, 0, 2], [0, 3, 0], [4, 0, 1], [0, 2, 2]]
    return c, spark.createDataFrame(
        [("ds", i, f"g{j + 1}", float(v)) for i, row in enumerate(dense) for j, v in enumerate(row) if v],
        "dataset_id string, cell_ord long, feature_id string, value double"
    )


def test_pseudobulk_sums(spark):
    cells, counts = cells_and_counts(spark)
    groups = pseudobulk.groups(cells, "intervention")
    sums = pseudobulk.pseudobulk(counts, pseudobulk.cell_groups(cells, groups, "intervention")).join(groups, ["dataset_id", "group_id"])
    got = {(r.perturbation_id, r.feature_id): r.count_sum for r in sums.collect()}
    assert got == {("control", "g1"): 1, ("control", "g2"): 2, ("control", "g3"): 4, ("geneA", "g1"): 4, ("geneA", "g2"): 3, ("geneA", "g3"): 1}
    assert [r.group_id for r in groups.orderBy("first_ord").collect()] == ["ds_intervention_0000001", "ds_intervention_0000002"]


def test_effects_of_disjoint_features_and_padding(spark):
    cells, _ = cells_and_counts(spark)
    counts = spark.createDataFrame(
        [("ds", 0, "g1", 10.0), ("ds", 3, "g1", 10.0), ("ds", 1, "g2", 10.0), ("ds", 2, "g2", 10.0)],
        "dataset_id string, cell_ord long, feature_id string, value double"
    )
    groups = pseudobulk.groups(cells, "intervention")
    sums = pseudobulk.pseudobulk(counts, pseudobulk.cell_groups(cells, groups, "intervention"))
    out = effects.intervention_effects(sums, groups, 1)
    got = {r.feature_id: r.effect_size for r in out.collect()}
    assert got == {"g1": pytest.approx(-math.log1p(1e6)), "g2": pytest.approx(math.log1p(1e6))}
    names = spark.createDataFrame([("ds", f"g{i}") for i in range(1, 8)], "dataset_id string, feature_id string")
    top = effects.pad_top_features(effects.top_features(out, 5), names, 5).orderBy("rank_abs_effect").collect()
    assert [(r.feature_id, r.rank_abs_effect) for r in top] == [("g1", 1), ("g2", 2), ("g3", 3), ("g4", 4), ("g5", 5)]
    stats = effects.effect_magnitudes(out, spark.createDataFrame([("ds", 7)], "dataset_id string, features int")).first()
    dense = sorted([0.0] * 5 + [math.log1p(1e6)] * 2)
    assert stats.median_max_abs == pytest.approx(dense[-1]) and stats.median_p95_abs == pytest.approx(dense[-1])
    assert effects.intervention_effects(sums, groups, 100).count() == 0


def test_zero_library_gives_zero(spark):
    r = spark.createDataFrame([(0.0, 0.0), (1.0, 2.0)], "c double, lib double").select(
        pseudobulk.log1p_cpm(F.col("c"), F.col("lib")).alias("x")
    ).collect()
    assert [x.x for x in r] == [0.0, pytest.approx(math.log1p(5e5))]


def test_gene_consistency(spark):
    contrasts = spark.createDataFrame(
        [("ds1", "c1", "pass"), ("ds1", "c2", "fail"), ("ds2", "c3", "warn")], "dataset_id string, contrast_id string, status string"
    )
    hits = spark.createDataFrame(
        [
            ("ds1", "c1", "geneA", "2.0", 1),
            ("ds1", "c1", "geneB", "-1.0", 1),
            ("ds1", "c2", "geneA", "5.0", 1),
            ("ds2", "c3", "geneA", "1.5", 1),
            ("ds2", "c3", "geneC", "x", 1),
            ("ds2", "c3", None, "1", 1)
        ],
        "dataset_id string, contrast_id string, gene_id string, effect_size string, status int"
    )
    genes = meta.gene_consistency(meta.included_hits(hits, contrasts))
    got = {r.gene_id: r for r in genes.collect()}
    a = got["geneA"]
    assert len(got) == 3 and (a.dataset_count, a.hit_count, a.pass_hits, a.warn_hits, a.sign_consistency, a.median_effect, a.datasets) == (
        2, 2, 1, 1, 1.0, 1.75, "ds1;ds2"
    )
    assert a.conserved_response_score == pytest.approx(2 * 1.0 * math.log10(3) * 1.75)
    assert got["geneC"].sign_consistency == 0.0
    assert [(r.rank, r.gene_id) for r in meta.meta_summary(genes, 2).orderBy("rank").collect()] == [(1, "geneA"), (2, "geneB")]
    per = {
        r.dataset_id: (
            r.input_contrasts, r.included_contrasts, r.input_top_gene_hits, r.included_top_gene_hits
        ) for r in meta.dataset_accounting(hits, contrasts).collect()
    }
    assert per == {"ds1": (2, 1, 3, 2), "ds2": (1, 1, 3, 3)}
    assert [r.gene_id for r in meta.recurrence(hits, 2).collect()] == ["geneA", "geneB"]


def test_quality_checks(spark):
    rows = [
        ("ds", p, s, b) for p,
        s,
        b in [
            ("control", "negative_control", "b1"),
            ("control", "negative_control", "b2"),
            ("geneA", "targeting", "b1"),
            ("geneA", "targeting", "b2"),
            ("geneB", "targeting", "b1"),
            (" NaN ", None, None)
        ]
    ]
    cells = spark.createDataFrame(rows, "dataset_id string, perturbation string, control_status string, batch string")
    vectors, used = cellqc.qc_vectors(cells)
    got = {r.perturbation_id: r for r in cellqc.perturbation_qc(vectors, True, 2, 2).collect()}
    assert {k: r.status for k, r in got.items()} == {"control": "control", "geneA": "pass", "geneB": "fail", "<missing>": "fail"}
    assert got["geneB"].failures == "cell count below threshold: 1 < 2" and got["geneB"].warnings == "perturbation observed in one batch/replicate level"
    assert used == {"perturbation": "perturbation", "control": "control_status", "batch": "batch"}
    profiles = spark.createDataFrame([("ds", 6, True, 0)], "dataset_id string, n_obs int, integer_like boolean, count_layers int")
    ds = cellqc.dataset_qc(vectors, profiles, True, 2).first()
    assert (ds.status, ds.control_cells, ds.missing_perturbation_cells, ds.failures) == ("fail", 2, 1, "missing perturbation labels: 1")
    with pytest.raises(ValueError):
        cellqc.qc_vectors(cells.drop("perturbation"))


def test_control_set_quirk(spark):
    df = spark.createDataFrame(
        [("geneA", "negative_control"), ("geneA", "Non_Targeting "), ("DMSO", ""), ("geneA", "1"), (None, None)], "p string, s string"
    )
    plain = [r[0] for r in df.select(harmonize.is_control(F.col("p"), F.col("s"))).collect()]
    mended = [r[0] for r in df.select(harmonize.is_control(F.col("p"), F.col("s"), True)).collect()]
    assert plain == [False, True, True, True, False] and mended == [True, True, True, True, False]


def test_harmonize_takes_the_first_existing_name(spark):
    df = spark.createDataFrame(
        [("x1", None, "geneA", "K", 7, 0.5, True, "drug"), ("x2", "late", "control", "K", None, 24.0, False, "crispr")],
        "id string, condition string, perturbation string, celltype string, ncounts int, percent_mito double, plate boolean, perturbation_type string"
    )
    a, b = harmonize.harmonize_obs(df, F.lit("ds"), F.col("id")).orderBy("cell_id").collect()
    assert (a.perturbation_id, a.drug_id, a.n_counts, a.percent_mito, a.batch_id, a.control_status, a.source_cell_barcode, a.disease) == (
        "geneA", "geneA", "7", "0.5", "True", "targeting", "x1", ""
    )
    assert (b.is_control, b.n_counts, b.percent_mito, b.batch_id, b.drug_id) == ("true", "", "24.0", "False", "")
    assert len(a) == 24
    var = harmonize.harmonize_var(spark.createDataFrame([("g1", "")], "feature string, gene_name string"), F.lit("ds"), F.col("feature")).first()
    assert (var.gene_id, var.gene_symbol, len(var)) == ("g1", "g1", 10)


def test_text_helpers(spark):
    df = spark.createDataFrame([("  Non_Targeting\t", "1e3"), ("nan", "x"), ("", None), (None, " ")], "a string, b string")
    assert [r[0] for r in df.select(normalize(F.col("a"))).collect()] == ["non-targeting", "nan", "", None]
    assert [r[0] for r in df.select(to_double(F.col("b"))).collect()] == [1000.0, 0.0, 0.0, 0.0]
    assert [r[0] for r in df.select(to_count(F.col("b"))).collect()] == [0, 0, 0, 0]
    assert [r[0] for r in df.select(is_missing_qc(F.col("a"))).collect()] == [False, True, True, True]
    assert [r[0] for r in df.select(is_missing_profile(F.col("a"))).collect()] == [False, True, False, True]
    values = [24.0, 1e7, 12345678.5, 1e-5, 0.0005, 0.1, 1e16, None, 0.0, -2.5]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(text_of(F.col("x"), "double")).collect()]
    assert got == [str(v) if v is not None else "" for v in values]


def test_stems_and_id_lists(spark):
    df = spark.createDataFrame([("My Set/1 ", "a;;b"), ("__", ""), (None, None)], "s string, ids string")
    assert [tuple(r) for r in df.select(safe_stem(F.col("s")), split_ids(F.col("ids"))).collect()] == [
        ("my_set_1", ["a", "b"]), ("dataset", []), ("dataset", [])
    ]


def test_profile_warnings(spark):
    shapes = spark.createDataFrame(
        [("a", 3, 2, 3, 5, 0, False), ("b", 3, 2, None, None, 1, True)],
        "dataset_id string, n_obs int, n_vars int, obs_rows int, var_rows int, count_layers int, integer_like boolean"
    )
    got = {
        r.dataset_id: r.warnings for r in tableprofile.profile_warnings(
            ["perturbation", *tableprofile.OBS_RECOMMENDED], ["gene_id"], shapes
        ).collect()
    }
    assert got["b"] == [] and got["a"] == [
        "no raw object or count layer found; X is treated as counts",
        "sampled X values are not integer-like",
        "var row count does not match X columns"
    ]


def test_numbering_and_latest(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = number_rows(df, ["k"]).collect()
    assert all(r.number == r.k + 1 for r in got) and len(got) == 1000
    assert number_rows(df.limit(0), ["k"]).count() == 0
    rows = spark.createDataFrame([("a", 1, "x", None), ("a", 2, None, "y"), ("b", None, "z", None)], "id string, at int, v string, w string")
    assert {tuple(r) for r in latest(rows, ["id"], "at").collect()} == {("a", 2, None, "y"), ("b", None, "z", None)}


def test_profiles(spark):
    df = spark.createDataFrame([("x", 1.0), ("NaN", float("nan")), (None, None), ("", 2.0), ("x", 2.0)], "t string, d double")
    got = {r.column_name: (r.n_rows, r.missing_count, r.unique_count) for r in tableprofile.column_profile(df).collect()}
    assert got == {"t": (5, 2, 4), "d": (5, 2, 4)}
    assert [(r.value, r.n_rows) for r in tableprofile.value_counts(df, ["t"]).orderBy("place").collect()] == [("<missing>", 3), ("x", 2)]
    v = spark.createDataFrame([(1.0,), (2.00001,), (2.5,), (None,), (float("inf"),)], "v double")
    assert [r[0] for r in v.select(tableprofile.integer_like(F.col("v"))).collect()] == [True, True, False, False, False]
    assert tableprofile.column_warnings(["perturbation"], []) == [
        "missing recommended obs columns: cell_line, cell_type, celltype, disease, organism",
        "missing recommended gene identifier columns: ensembl_id, gene_id, gene_name, gene_symbol"
    ]


def test_features_are_read_under_the_names_of_their_file(spark, tmp_path):
    lines = [
        ("f1", '{"feature_id": "a", "gene_symbol": "A1", "chromosome": "chr1", "start": 5.0E3, "gene_type": "coding"}'),
        ("f2", '{"feature_id": "a", "gene_name": "A2", "chr": "chr2", "class": "coding", "highly_variable": true}'),
        ("f3", '{"feature_id": "a", "gene_symbol": "A3", "chr": "chr3"}'),
        ("f3", '{"feature_id": "b", "gene_name": "B3", "gene_symbol": null, "chr": "chr3", "end": 9, "ensembl_id": "E1"}'),
        ("f3", '{"feature_id": "c", "gene_name": "C3", "gene_id": "G1"}'),
        ("f4", "no object"),
    ]
    rows = spark.createDataFrame([("ds", f, "var", p) for f, p in lines], "dataset_id string, file_id string, kind string, payload string")
    rows.write.parquet(f"{tmp_path}/raw_records.parquet")
    got = {tuple(r) for r in stages.QUERIES["var_harmonize_files"](spark, str(tmp_path)).collect()}
    assert got == {
        ("ds", "a", "a", "A1", "", "chr1", "5000", "", "coding", ""),
        ("ds", "a", "a", "A2", "", "chr2", "", "", "coding", "true"),
        ("ds", "a", "a", "A3", "", "chr3", "", "", "", ""),
        ("ds", "b", "b", "b", "E1", "chr3", "", "9", "", ""),
        ("ds", "c", "G1", "c", "", "", "", "", "", ""),
    }


def test_profiles_cover_every_column(spark, sf):
    cells = spark.read.parquet(f"{sf}/obs_cells.parquet").toPandas()
    got = {r.column_name: r for r in stages.QUERIES["profile_columns_all"](spark, sf).collect()}
    assert set(got) == set(cells.columns) and len(got) == 26
    markers = {"nan", "none", "null", "na"}
    for c in cells.columns:
        gone = cells[c].map(lambda v: v is None or v != v or (isinstance(v, str) and v.lower() in markers)).sum()
        assert (got[c].n_rows, got[c].missing_count) == (len(cells), gone), c
        assert got[c].unique_count == cells[c].astype(object).where(cells[c].notna(), "None").nunique(), c
    counts = stages.QUERIES["profile_value_counts_all"](spark, sf).collect()
    for c in ("is_control", "replicate_id", "dose", "guide_id", "cell_line"):
        values = cells[c].map(lambda v: "<missing>" if v is None or v.lower() in markers | {""} else v).value_counts()
        want = sorted(values.items(), key=lambda x: (-x[1], x[0]))[:20]
        assert [(r.value, r.n_rows) for r in sorted(counts, key=lambda r: r.place) if r.column_name == c] == want, c


def test_curation(spark):
    cells = spark.createDataFrame(
        [("ds", i, p) for i, p in enumerate(["Control", None, "nan", "geneA"])], "dataset_id string, cell_ord long, perturbation string"
    )
    assert [r.nperts for r in curate.with_perturbation(cells, "perturbation", True).orderBy("cell_ord").collect()] == [0, 1]
    counts = spark.createDataFrame([("ds", i, 1) for i in range(4)], "dataset_id string, cell_ord long, value int")
    kept, left = curate.filter_rows(cells, counts, F.col("cell_ord") != 1, {"nperts": F.lit(1)})
    assert (kept.count(), left.count()) == (3, 3)
    ids = spark.createDataFrame(
        [("0", 1, "g1", "5.0", "2"), ("0", 2, "CTRL", "7.9", "x"), (None, 3, "g9", "1", "1")],
        "barcode string, ord int, guide string, reads string, umis string"
    )
    r = {
        x.cell_ord: x for x in curate.repair_labels(
            cells.drop("perturbation").withColumn("bc", F.col("cell_ord").cast("string")), ids, "bc", ["CTRL"]
        ).collect()
    }
    assert (r[0].perturbation, r[0].control_status, r[0].read_count, r[0].umi_count, r[0].nperts) == ("control", "negative_control", 7, 0, 0)
    assert (r[1].matched, r[1].perturbation) == (False, None)
    same, other = curate.compare(counts, counts).first(), curate.compare(counts, counts.unionByName(counts.limit(1))).first()
    assert same.status == "pass" and same.left_digest == same.right_digest
    assert (other.status, other.only_left, other.only_right) == ("fail", 0, 1)
    assert curate.compare(counts.limit(0), counts.limit(0)).first().status == "pass"
    runs = curate.islands(spark.createDataFrame([("d", i) for i in (1, 2, 3, 7, 9, 10)], "k string, o long"), "k", "o")
    assert {(x["first"], x["last"]) for x in runs.collect()} == {(1, 3), (7, 7), (9, 10)}
