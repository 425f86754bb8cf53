import json
import random
import statistics

from assaylake.operators.quality import JUDGED, Judged, every_column, findings, profile_loads

MISSING = {"", "nan", "none", "null", "na", "<missing>"}


def brute(rows, j):
    """rows: (load, value, bound). Findings by their definition."""
    out, before = set(), None
    for load in sorted({r[0] for r in rows}):
        mine = [(v, b) for n, v, b in rows if n == load]
        filled = [(v, b) for v, b in mine if v is not None and v.strip().lower() not in MISSING]

        def right(v):
            if j.kind == "count":
                return v.lstrip("-").isdigit() and v.count("-") <= 1 and v.isascii()
            if j.kind == "flag":
                return v in ("True", "False")
            try:
                x = json.loads(v)
            except ValueError:
                return False
            return isinstance(x, list) and all(isinstance(y, str) for y in x)

        good = [(v, b) for v, b in filled if right(v)]
        on = [(int(v) != 0 if j.kind == "count" else v == "True" if j.kind == "flag" else v != "[]") for v, _ in good]
        share = sum(on) / len(on) if on else None
        some = [int(v) for v, _ in good if j.kind == "count" and int(v) != 0]
        median = statistics.median(some) if some else None
        found = {
            "missing": len(mine) - len(filled) > 0.15 * len(mine),
            "constant": len({v for v, _ in filled}) == 1,
            "pattern": len(good) < len(filled),
            "range": j.limit and any(int(v) < 0 or int(v) > b for v, b in good),
            "drift": before and (
                (share is not None and before[0] is not None and abs(share - before[0]) > 0.2503) or (
                    median is not None and before[1] is not None and (median > 3 * before[1] or median * 3 < before[1])
                )
            ),
        }
        out |= {(j.table, j.column, load, f) for f, hit in found.items() if hit}
        before = (share, median)
    return out


def test_findings_equal_brute_force(spark):
    rng = random.Random(5)
    j = Judged("t", "cells", "count", "n_obs")
    rows = []
    for load in (1, 2, 3, 5, 8, 9):
        base = rng.choice([3, 30, 300])
        for _ in range(60):
            v = rng.choice([str(rng.randint(1, base)), "0", str(base), "-4", None, "nan", "7 x"]) if rng.random() < 0.4 else str(rng.randint(0, base))
            rows.append((load, v, 250))
    df = spark.createDataFrame(rows, "load_no int, cells string, n_obs int")
    p = profile_loads({"t": df}, [j])
    assert {tuple(r) for r in findings(p, counted=("cells",)).collect()} == brute(rows, j)
    for r in p.collect():
        good = sorted(float(v) for n, v, _ in rows if n == r.load_no and v is not None and v.lstrip("-").isdigit())
        assert (r.least, r.most, r.p50) == (good[0], good[-1], good[(len(good) + 1) // 2 - 1])
        if r.prev_load is not None:
            prev = [float(v) for n, v, _ in rows if n == r.prev_load and v is not None and v.lstrip("-").isdigit()]
            ks = max(abs(sum(x <= c for x in good) / len(good) - sum(x <= c for x in prev) / len(prev)) for c in {*good, *prev})
            assert abs(r.ks - ks) < 1e-12


def test_columns_of_every_type_equal_brute_force(spark):
    """Numbers, times, truth values, texts and nested columns: distincts, quantiles and KS distance."""
    rng = random.Random(9)
    rows = []
    for i in range(600):
        load = rng.choice([1, 2, 4])
        text = rng.choice([None, "", "é", "z", "Zebra", *(f"k{rng.randint(0, 30 * load)}" for _ in range(6))])
        rows.append((load, text, rng.choice([None, float("nan"), -1.5, 0.0, rng.gauss(load, 1)]), rng.randint(-3, 3) * load, rng.random() < 0.2 * load, [load]))
    df = spark.createDataFrame(rows, "load_no int, word string, x double, n bigint, b boolean, l array<int>").repartition(5)
    df = df.withColumn("at", df.n.cast("timestamp"))
    judged = every_column("t", df)
    assert {j.column: j.kind for j in judged} == {"word": "text", "x": "number", "n": "number", "b": "truth", "l": "text", "at": "time"}
    got = {(r.column_name, r.load_no): r for r in profile_loads({"t": df}, judged).collect()}
    for c, i in (("word", 1), ("x", 2), ("n", 3), ("b", 4)):
        loads = {k: sorted(r[i] for r in rows if r[0] == k and r[i] not in (None, "") and r[i] == r[i]) for k in (1, 2, 4)}
        if c == "word":
            loads = {k: sorted(v, key=lambda t: t.encode()) for k, v in loads.items()}
        for k, before in ((1, None), (2, 1), (4, 2)):
            v, r = loads[k], got[c, k]
            middle = v[(len(v) + 1) // 2 - 1]
            assert r.distinct_values == len(set(v)) and (r.median_text if c == "word" else r.p50) == middle
            assert r.missing == sum(1 for x in rows if x[0] == k) - len(v)
            if before:
                p, code = loads[before], (lambda t: t.encode()) if c == "word" else (lambda t: t)
                share = lambda vs, x: sum(code(y) <= code(x) for y in vs) / len(vs)
                assert abs(r.ks - max(abs(share(v, x) - share(p, x)) for x in {*v, *p})) < 1e-12
    assert got["l", 1].distinct_values == 1 and got["at", 2].p50 == got["n", 2].p50


def test_edge_cases(spark):
    df = spark.createDataFrame(
        [(1, None, 5, "x"), (2, "NA", 5, "x"), (3, '["a", "b"]', None, "x"), (3, '["a", "b"]', None, "x"), (None, "[]", 1, "x")],
        "load_no int, warnings string, n_obs int, value string"
    )
    got = {tuple(r) for r in findings(profile_loads({"p": df}, [Judged("p", "warnings", "messages")])).collect()}
    assert got == {
        ("p", "warnings", 1, "missing"),
        ("p", "warnings", 2, "missing"),
        ("p", "warnings", 3, "constant"),
        ("p", "warnings", None, "constant")
    }


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "load_no int, missing_perturbation_cells string, matrix_integer_like_sample string, warnings string, n_obs int")
    assert profile_loads({"dataset_qc": empty, "profile_index": empty}, JUDGED).count() == 0
