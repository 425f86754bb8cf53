import json

from assaylake.operators.drift import (
    ALIASES, canonical_names, cast_report, catalogue, explode_fields, lifespans, schema_changes, typed_values, unified_table
)


def records(spark, files, kind="obs"):
    key = {"obs": "cell_id", "var": "feature_id"}.get(kind, "id")
    rows = []
    for seq, lines in enumerate(files, 1):
        for n, (k, fields) in enumerate(lines):
            payload = fields if isinstance(fields, (str, type(None))) else json.dumps({key: k, **fields})
            rows.append((len(rows), "s", f"s/f{seq}", seq, "d", kind, n, payload, "noise"))
    return spark.createDataFrame(
        rows,
        "record_id int, series_id string, file_id string, file_seq int, dataset_id string, kind string, line_no int, payload string, field string"
    )


def changes(spark, files, kind="obs"):
    return {tuple(r) for r in schema_changes(explode_fields(records(spark, files, kind))).collect()}


def test_all_kinds_of_change(spark):
    files = [
        [("a", {"batch": 1, "n": 5, "gone": "x"}), ("b", {"batch": 2, "n": 6}), ("b", {"batch": 2, "n": 6})],
        [("a", {"lane": {"batch": "1"}, "n": 5.0, "fresh": True}), ("b", {"lane": {"batch": "2"}, "n": 6.0}), ("c", {})],
        [("b", {"lane": {"batch": "2"}, "n": None, "fresh": None}), ("c", {"n": None})],
        [("b", {"lane": {"batch": ["2"]}, "n": 6, "fresh": "yes"})],
    ]
    assert changes(spark, files) == {
        ("s/f2", "renamed", "batch", "lane.batch"),
        ("s/f2", "retyped", "batch", "lane.batch"),
        ("s/f2", "retyped", "n", "n"),
        ("s/f2", "removed", "gone", ""),
        ("s/f2", "added", "", "fresh"),
        ("s/f4", "retyped", "lane.batch", "lane.batch"), ("s/f4", "retyped", "n", "n"), ("s/f4", "retyped", "fresh", "fresh"),
    }


def test_values_that_differ_are_no_renaming(spark):
    files = [[("a", {"x": 1}), ("b", {"x": 2})], [("a", {"y": 1}), ("b", {"y": 3})]]
    assert changes(spark, files) == {("s/f2", "removed", "x", ""), ("s/f2", "added", "", "y")}


def test_bad_lines_and_single_files(spark):
    assert changes(spark, [[("a", "not json"), ("b", None), ("c", "[1]"), ("d", {"x": None})]]) == set()
    assert schema_changes(explode_fields(records(spark, [[("a", {"x": 1})]]).limit(0))).count() == 0


def test_unified_table_casts_by_alias(spark):
    files = [[("a", {"ncounts": "12", "batch": 3})], [("a", {"qc": {"n_counts": 12.0}, "Batch_ID": "3", "odd": 1})]]
    rows = {r.file_id: r for r in unified_table(explode_fields(records(spark, files))).collect()}
    assert [(rows[f].n_counts, rows[f].batch_id) for f in ("s/f1", "s/f2")] == [(12, "3"), (12, "3")]
    assert rows["s/f2"].others == {"odd": "1"}


def test_files_without_fields_are_part_of_the_chain(spark):
    files = [[("a", {"x": 1})], [("a", "no object"), ("b", None)], [("a", {"x": 1})], [("a", {})]]
    assert changes(spark, files) == {("s/f2", "removed", "x", ""), ("s/f3", "added", "", "x"), ("s/f4", "removed", "x", "")}


def test_objects_of_any_depth(spark):
    deep = lambda v: {"a": {"b": {"c": {"d": {"e": {"f": v, "g": {}}}}}}}
    assert changes(spark, [[("k", deep(1))], [("k", deep("x"))]]) == {("s/f2", "retyped", "a.b.c.d.e.f", "a.b.c.d.e.f")}


def test_kinds_and_lines_without_a_key(spark):
    files = [[("a", {"x": 1}), ("b", {"x": 2})], [("a", {"x": "t"})]]
    assert changes(spark, files, "other") == {("s/f2", "retyped", "x", "x")}
    rows = unified_table(explode_fields(records(spark, files, "other"))).collect()
    assert sorted((r.file_id, r.key, r.others["x"]) for r in rows) == [("s/f1", None, "1"), ("s/f1", None, "2"), ("s/f2", None, "t")]
    keyless = records(spark, [[("a", '{"n_counts": 1}'), ("a", '{"n_counts": 2}'), ("a", '{"n_counts": 1}')]])
    assert sorted(r.n_counts for r in unified_table(explode_fields(keyless)).collect()) == [1, 2]


def test_no_value_is_dropped(spark):
    files = [[("a", {"n_counts": "1,234", "batch": "x", "Batch_ID": "y"}), ("b", {"n_counts": 7}), ("b", {"n_counts": 9}), ("c", {})]]
    fields = explode_fields(records(spark, files))
    rows = {r.key: r for r in unified_table(fields).collect()}
    assert (rows["a"].n_counts, rows["a"].batch_id, rows["a"].failed) == (None, "x", ["n_counts"])
    assert rows["a"].others == {"n_counts": "1,234", "Batch_ID": "y"}
    assert (rows["b"].n_counts, rows["b"].superseded) == (9, 1)  # the later line counts
    assert rows["c"].n_counts is None
    states = {(r.key, r.field, r.value): r.state for r in typed_values(fields).collect()}
    assert states["b", "n_counts", "7"] == "superseded" and states["a", "Batch_ID", "y"] == "superseded"
    report = {r.field: (r.n_values, r.taken, r.failed, r.superseded, r.spare) for r in cast_report(typed_values(fields)).collect()}
    assert report["n_counts"] == (3, 1, 1, 1, 0)


def test_casts_follow_the_renamings_found(spark):
    files = [[("a", {"n_counts": 5}), ("b", {"n_counts": 6})], [("a", {"tally": 5}), ("b", {"tally": 6})], [("a", {"sum_x": "5"}), ("b", {"sum_x": "6"})]]
    fields = explode_fields(records(spark, files))
    found = schema_changes(fields)
    names = {r.field: r.canon for r in canonical_names(fields, found).collect()}
    assert names == {"n_counts": "n_counts", "tally": "n_counts", "sum_x": "n_counts"}
    rows = unified_table(fields, changes=found).collect()
    assert sorted((r.file_id, r.key, r.n_counts) for r in rows) == [(f"s/f{i}", k, n) for i in (1, 2, 3) for k, n in (("a", 5), ("b", 6))]
    assert unified_table(fields.limit(0), ALIASES, found.limit(0)).count() == 0


def test_lifespans_by_type(spark):
    files = [[("a", {"x": 1})], [("a", {"x": None})], [("a", {"x": "t"})], [("a", {"y": 1.5})], [("a", {"x": "t"})]]
    got = {tuple(r[c] for c in ("field", "type", "first_file", "last_file", "files")) for r in lifespans(catalogue(explode_fields(records(spark, files)))).collect()}
    assert got == {
        ("x", "integer", "s/f1", "s/f2", 2), ("x", "text", "s/f3", "s/f3", 1), ("x", "text", "s/f5", "s/f5", 1), ("y", "decimal", "s/f4", "s/f4", 1)
    }
