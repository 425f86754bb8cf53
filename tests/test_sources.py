import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaylake.sources import files, matrix
from assaylake.streaming import incremental


def test_all_encodings_give_the_same_triplets(spark):
    want = {("ds", 0, 0, 1.0), ("ds", 0, 2, 2.0), ("ds", 1, 1, 3.0)}
    ptr = "dataset_id string, ord long, start long, stop long"
    val = "dataset_id string, pos long, index long, value double"
    csr = matrix.csr_triplets(
        spark.createDataFrame([("ds", 0, 0, 2), ("ds", 1, 2, 4), ("ds", 2, 4, 4)], ptr),
        spark.createDataFrame([("ds", 0, 0, 1.0), ("ds", 1, 2, 2.0), ("ds", 2, 1, 3.0), ("ds", 3, 0, 0.0)], val)
    )
    csc = matrix.csc_triplets(
        spark.createDataFrame([("ds", 0, 0, 1), ("ds", 1, 1, 2), ("ds", 2, 2, 3)], ptr),
        spark.createDataFrame([("ds", 0, 0, 1.0), ("ds", 1, 1, 3.0), ("ds", 2, 0, 2.0)], val)
    )
    dense = matrix.dense_triplets(
        spark.createDataFrame(
            [("ds", 0, [1.0, 0.0, 2.0]), ("ds", 1, [0.0, 3.0, None])], "dataset_id string, cell_ord long, values array<double>"
        )
    )
    for got in (csr, csc, dense):
        assert {tuple(r) for r in got.select("dataset_id", "cell_ord", "feature_ord", "value").collect()} == want


def test_categories_and_names(spark):
    cells = spark.createDataFrame([("ds", 1, 0), ("ds", 2, -1)], "dataset_id string, cell_ord long, code int")
    cats = spark.createDataFrame([("ds", 0, "A")], "dataset_id string, code int, category string")
    assert {tuple(r) for r in matrix.decode_categories(cells, "code", cats, "batch").collect()} == {("ds", 1, "A"), ("ds", 2, None)}
    var = spark.createDataFrame([("", "g", "s"), ("f", "", ""), (None, None, None)], "feature_id string, gene_id string, gene_symbol string")
    assert [r.feature_name for r in matrix.feature_names(var).collect()] == ["g", "f", ""]


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_text_tables_round_trip(spark, tmp_path, compression):
    df = spark.createDataFrame([("a", 'say "x", y', None), ("b", "", "2")], "id string, b string, c string")
    files.write_text_table(df, str(tmp_path / "t"), ["id", "b", "c"], compression)
    got = files.read_text_table(spark, str(tmp_path / "t"), ["id", "b", "c"])
    assert {tuple(r) for r in got.collect()} == {("a", 'say "x", y', ""), ("b", "", "2")}


def test_partitioned_sink_and_manifest(spark, tmp_path):
    files.write_partitioned(spark.createDataFrame([("d1", 1), ("d2", 2)], "dataset_id string, v int"), str(tmp_path / "p"))
    plan = spark.read.parquet(str(tmp_path / "p")).where("dataset_id = 'd1'")
    assert plan.count() == 1
    files.write_manifest({"datasets": [], "b": 1}, str(tmp_path / "m.json"))
    assert files.read_manifest(str(tmp_path / "m.json")) == {"datasets": [], "b": 1}
    (tmp_path / "bad.json").write_text(json.dumps([1]))
    with pytest.raises(ValueError):
        files.read_manifest(str(tmp_path / "bad.json"))


def test_receipts(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"hello")
    (tmp_path / "b.bin").write_bytes(b"other")
    md5 = hashlib.md5(b"hello").hexdigest()
    expected = spark.createDataFrame(
        [
            ("a.bin", 5, "md5", md5.upper()),
            ("b.bin", 5, "sha256", "00"),
            ("c.bin", 1, "md5", ""),
            ("d.bin", 1, "md5", ""),
            ("d.bin", 1, "md5", "")
        ],
        "name string, size_bytes long, algorithm string, checksum string"
    )
    got = {r.name: r.problem for r in files.verify_receipts(expected, files.receipts(spark, str(tmp_path), "*.bin")).collect()}
    assert got == {"a.bin": "ok", "b.bin": "checksum", "c.bin": "missing", "d.bin": "repeated"}
    chosen, unknown = files.select_artifacts(expected, spark.createDataFrame([("a.bin",), ("z",)], "name string"))
    assert (chosen.count(), [r.name for r in unknown.collect()]) == (1, ["z"])
    assert files.select_artifacts(expected, None)[0].count() == 5
    sizes = spark.createDataFrame([(512,), (2048,), (5 * 1024**3,)], "n long").select(files.size_label(F.col("n"))).collect()
    assert [r[0] for r in sizes] == ["512 B", "2.00 KiB", "5.00 GiB"]


def test_streamed_sums_equal_batch(spark, tmp_path):
    rows = spark.createDataFrame(
        [("ds", i % 4, f"g{i % 3}", float(i)) for i in range(60)], "dataset_id string, cell_ord long, feature_id string, value double"
    )
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    member = spark.createDataFrame([("ds", i, f"grp{i % 2}") for i in range(3)], "dataset_id string, cell_ord long, group_id string")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = incremental.running_pseudobulk(stream, member).writeStream.outputMode("complete").format("memory").queryName("sums").option(
        "checkpointLocation", str(tmp_path / "cp")
    ).start()
    q.processAllAvailable()
    q.stop()
    got = {(r.group_id, r.feature_id): r.count_sum for r in spark.table("sums").collect()}
    want = {
        (r.group_id, r.feature_id): r.s for r in rows.join(
            member, ["dataset_id", "cell_ord"]
        ).groupBy("group_id", "feature_id").agg(F.sum("value").alias("s")).collect()
    }
    assert got == want


def test_repeated_deliveries_are_dropped_in_a_stream(spark, tmp_path):
    rows = spark.sql(
        "select * from values ('d', 'a', timestamp'2024-01-01 00:00:00'), ('d', 'a', timestamp'2024-01-01 00:00:00'), ('d', 'b', timestamp'2024-01-01 01:00:00') as t(dataset_id, cell_id, loaded_at)"
    )
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = incremental.first_deliveries(
        stream, ["dataset_id", "cell_id"], "loaded_at"
    ).writeStream.format("memory").queryName("firsts").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("firsts").count() == 2


def test_encodings_are_told_apart(spark):
    rows = spark.createDataFrame([("d", 0, [0.0, 2.0])], "dataset_id string, cell_ord int, values array<double>")
    assert [tuple(r) for r in matrix.triplets("array", rows=rows).collect()] == [("d", 0, 1, 2.0)]
    with pytest.raises(ValueError, match="unsupported"):
        matrix.triplets("coo_matrix", rows=rows)


def test_artifacts_are_validated_and_chosen(spark):
    good = ("a.h5", "https://x/a.h5", 5, "md5", "0" * 32)
    rows = [good, ("b/c", "https://x", 1, "md5", None), ("d", "http://x", 1, None, None), ("e", "https://x", -1, None, None), ("f", "https://x", None, "sha256", "0" * 32), (None,) * 5]
    df = spark.createDataFrame(rows, "name string, url string, size_bytes long, algorithm string, checksum string")
    assert {tuple(r) for r in files.invalid_artifacts(df).collect()} == {("b/c", "name"), ("d", "url"), ("e", "size"), ("f", "checksum"), (None, "name")}
    names = spark.createDataFrame([("a.h5",), ("d",)], "name string")
    assert [r.name for r in files.chosen_artifacts(df, names).collect()] == ["a.h5", "d"]
    with pytest.raises(ValueError, match="zz"):
        files.chosen_artifacts(df, spark.createDataFrame([("zz",)], "name string"))


def test_stage_manifest_and_paths(spark, tmp_path):
    rows = spark.createDataFrame([("pass", "b", 1), ("warn", "a", 2), ("pass", "a", 3)], "status string, dataset_id string, n int")
    found = files.stage_manifest("meta", rows, {"min_cells": np.int64(15)}, ["y", "x"], rows, rows.orderBy("n"), 2)
    assert found["counts"] == {"pass": 2, "warn": 1} and found["total"] == 3 and found["datasets"] == ["a", "b"] and [r["n"] for r in found["head"]] == [1, 2]
    path = str(tmp_path / "m.json")
    files.write_manifest(found | {"datasets": {"b", "a"}}, path)
    assert files.read_optional_json(path)["thresholds"] == {"min_cells": 15} and files.read_manifest(path)["datasets"] == ["a", "b"]
    assert files.read_optional_json(None) is None and files.read_optional_json(path + "x") is None
    assert files.resolve_path("/a/b") == "/a/b" and files.resolve_path("m.json", "/nowhere", str(tmp_path)) == path
    assert files.resolve_path("q", "/nowhere", "/other") == "/other/q"


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n"x\ny",1\nz,2\n')
    rows = files.read_text_table(spark, str(tmp_path / "t.csv"), ["a", "b"], line_breaks=True).collect()
    assert [tuple(r) for r in rows] == [("x\ny", "1"), ("z", "2")]


def test_selection_index_and_top_genes(spark, tmp_path):
    (tmp_path / "s.json").write_text('["b", "a", "b"]')
    assert sorted(r.name for r in files.read_selection(spark, str(tmp_path / "s.json")).collect()) == ["a", "b"]
    (tmp_path / "t.json").write_text('{"a": 1}')
    with pytest.raises(ValueError, match="array"):
        files.read_selection(spark, str(tmp_path / "t.json"))
    assert matrix.index_column(["x", "_index", "cell"], "cell") == "cell" and matrix.index_column(["index", "_index"]) == "_index"
    with pytest.raises(ValueError, match="index"):
        matrix.index_column(["x"])
    hits = spark.createDataFrame([("d", "c", "p", "g2", 0.5, 2), ("d", "c", "p", "g1", -1.0, 1)], "dataset_id string, contrast_id string, perturbation_id string, feature_id string, effect_size double, rank_abs_effect int")
    files.write_top_genes(hits, str(tmp_path / "top"))
    back = files.read_text_table(spark, str(tmp_path / "top"), files.TOP_GENES).collect()
    assert [(r.gene_id, r.rank_abs_effect) for r in back] == [("g1", "1"), ("g2", "2")]
    assert any(p.name.endswith(".csv.gz") for p in (tmp_path / "top").iterdir())
