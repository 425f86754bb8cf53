import math
import random

from assaylake.llm.topn import top_n


def brute(rows, n):
    best = {}
    for g, i, s in rows:
        if s is None or i is None or not math.isfinite(s):
            continue
        s = s + 0.0
        best.setdefault(g, {})[i] = max(best.get(g, {}).get(i, -math.inf), s)
    out = set()
    for g, items in best.items():
        for place, (i, _) in enumerate(sorted(items.items(), key=lambda x: (-x[1], x[0].encode("utf-8")))[:n], 1):
            out.add((g, place, i))
    return out


def run(spark, rows, n, salts=16):
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "run string, gene string, points double, score string, salt int")
    return {(r.run, r.place, r.gene) for r in top_n(df, "run", "points", "gene", n, salts).collect()}


def test_equals_brute_force_with_a_hot_group(spark):
    rng = random.Random(3)
    values = [None, float("nan"), math.inf, -math.inf, 0.0, -0.0, 1.5, 1.5, 2.0, -3.0]
    rows = [
        (
            rng.choice(["hot"] * 10 + [f"r{i}" for i in range(40)] + [None]),
            rng.choice([None, "é", "z", "Z", *(f"g{i}" for i in range(60))]),
            rng.choice([*values, rng.random()])
        ) for _ in range(6000)
    ]
    for n in (1, 10, 500):
        assert run(spark, rows, n) == brute(rows, n)
    assert run(spark, rows, 3, salts=1) == brute(rows, 3)


def test_groups_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(f"r{i % 3}", f"g{i % 50}", float(i % 11)) for i in range(900)]
        assert run(spark, rows, 10) == brute(rows, 10)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_large_numbers_beside_nulls_stay_apart(spark):
    """Keys that a double can't tell apart, next to a null key."""
    keys = [2**53, 2**53 + 1, -(2**62), None]
    rows = [(k, f"g{i}", float(i)) for k in keys for i in range(5)]
    df = spark.createDataFrame(rows, "run long, gene string, points double").repartition(3)
    for salts in (None, 3):
        got = {(r.run, r.place, r.gene) for r in top_n(df, "run", "points", "gene", 3, salts).collect()}
        assert got == brute(rows, 3) and len(got) == 12


def test_groups_of_other_types(spark):
    rows = [(float("nan"), "a", 1.0), (float("nan"), "b", 2.0), (0.0, "c", 1.0), (-0.0, "d", 3.0), (None, "e", 1.0)]
    df = spark.createDataFrame(rows, "run double, gene string, points double").repartition(4)
    got = {(str(r.run), r.place, r.gene) for r in top_n(df, "run", "points", "gene", 5).collect()}
    assert got == {("nan", 1, "b"), ("nan", 2, "a"), ("0.0", 1, "d"), ("0.0", 2, "c"), ("None", 1, "e")}


def test_a_group_sends_n_rows_per_partition(spark):
    df = spark.range(0, 100_000, 1, 8).selectExpr("'hot' run", "concat('g', id) gene", "cast(id % 997 as double) points")
    got = [(r.place, r.gene) for r in top_n(df, "run", "points", "gene", 10).orderBy("place").collect()]
    assert got == list(enumerate(sorted(f"g{i}" for i in range(996, 100_000, 997))[:10], 1))


def test_empty(spark):
    assert run(spark, [("r", "g", None)], 5) == set()
