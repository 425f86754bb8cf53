import math
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from assaylake.llm import quantiles as Q


def off(values, answer, q):
    v = np.sort(values)
    r = min(len(v), max(1, math.ceil(round(q * len(v), 9))))
    return max(0, np.searchsorted(v, answer, "left") + 1 - r, r - np.searchsorted(v, answer, "right"))


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.lists(st.one_of(st.integers(-5, 5).map(float), st.floats(-1e9, 1e9)), min_size=1, max_size=300), min_size=1, max_size=6),
    st.sampled_from([0.001, 0.01, 0.05])
)
def test_merged_bounds_hold(parts, eps):
    made = []
    for p in parts:
        v = np.sort(np.array(p))
        r = np.arange(1, len(v) + 1)
        made.append((len(v), *Q.compress(v, r, r.copy(), len(v), len(v) * eps / 2)))
    n, v, lo, hi = Q.merge(made)
    v, lo, hi = Q.compress(v, lo, hi, n, n * eps / 2)
    every = np.sort(np.concatenate([np.array(p) for p in parts]))
    assert n == len(every) and v[0] == every[0] and v[-1] == every[-1]
    for x, a, b in zip(v, lo, hi):  # the interval holds a rank of the value
        assert a <= np.searchsorted(every, x, "right") and b >= np.searchsorted(every, x, "left") + 1
    for q in (0.01, 0.5, 0.9, 0.99):
        assert off(every, Q.query(n, v, lo, hi, q), q) <= Q.error(lo, hi) + 1e-9 <= max(eps * n, 1e-9) + 1


def test_hierarchical_merge_in_spark(spark):
    rng = random.Random(1)
    rows = [
        (
            "hot" if i % 3 == 0 else None if i % 50 == 1 else f"r{i % 11}",
            rng.choice([None, float("nan"), 1e12, math.inf, 1.0, *(rng.gauss(0, 1) for _ in range(8))])
        ) for i in range(20_000)
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "run string, x double, scope string").repartition(40)
    for fans in ((1,), (7, 1), (16, 4, 1)):
        share = 0.02 / (len(fans) + 1)
        parts = Q.summarise(df, {"run": F.col("run"), "all": F.lit("all")}, ["x"], share)
        got = {(r.scope, r.scope_key): r for r in Q.percentiles(Q.merge_summaries(parts, share, fans)).collect()}
        assert len(got) == 14
        for (scope, key), r in got.items():
            v = np.array([x for g, x in rows if (scope == "all" or g == key) and x is not None and not math.isnan(x)])
            assert r.n == len(v) and r.rank_error <= 0.02 * r.n
            for q, answer in ((0.5, r.p50), (0.9, r.p90), (0.99, r.p99)):
                assert off(v, answer, q) <= r.rank_error + 1e-9


def made(values, share):
    v = np.sort(values)
    r = np.arange(1, len(v) + 1)
    return len(v), *Q.compress(v, r, r.copy(), len(v), len(v) * share)


def test_merged_summaries_stay_small():
    """However many parts there are, a level leaves tuples for its share only, within its bound."""
    rng, share = np.random.default_rng(3), 0.0025
    for parts in (10, 100, 1000):
        every = [rng.normal(i % 7, 1 + i % 3, 4000) for i in range(parts)]
        n, v, lo, hi = Q.merge([made(x, share) for x in every])
        assert len(v) > 190 * parts
        v, lo, hi = Q.compress(v, lo, hi, n, 2 * share * n)
        assert len(v) <= 1 / share and Q.error(lo, hi) <= 2 * share * n
        flat = np.concatenate(every)
        for q in (0.01, 0.5, 0.9, 0.99):
            assert off(flat, Q.query(n, v, lo, hi, q), q) <= 2 * share * n


def test_merge_equals_bounds_counted_part_by_part():
    rng = np.random.default_rng(5)
    for _ in range(30):
        parts = [made(rng.integers(0, 20, rng.integers(1, 200)).astype(float), rng.choice([0.001, 0.05])) for _ in range(rng.integers(2, 6))]
        _, v, lo, hi = Q.merge(parts)
        order = sorted((x, i, k) for i, p in enumerate(parts) for k, x in enumerate(p[1]))
        for at, (x, i, k) in enumerate(order):
            seen = [sum(1 for _, j, _ in order[: at + 1] if j == p) for p in range(len(parts))]
            low = sum(int(p[2][s - 1]) if s else 0 for p, s in zip(parts, seen))
            high = sum(int(p[3][k]) if j == i else int(p[3][s]) - 1 if s < len(p[1]) else p[0] for j, (p, s) in enumerate(zip(parts, seen)))
            assert (v[at], lo[at], hi[at]) == (x, low, high)


def test_equal_parts_are_spread_over_the_buckets(spark):
    df = spark.range(0, 2000, 1, 64).select((F.col("id") % 5).cast("double").alias("x"))
    parts = Q.summarise(df, {"all": F.lit("all")}, ["x"], 0.01)
    level = Q.merge_summaries(parts, 0.01, (8,))
    assert level.count() > 4
    r = Q.percentiles(Q.merge_summaries(parts, 0.01, (8, 1))).first()
    assert r.n == 2000 and r.p50 == 2.0 and r.rank_error <= 0.03 * 2000


def test_days_can_be_put_together(spark):
    df = spark.createDataFrame([(str(i % 2), float(i)) for i in range(4000)], "day string, x double")
    days = Q.merge_summaries(Q.summarise(df, {"day": F.col("day")}, ["x"], 0.0025), 0.0025)
    both = Q.merge_summaries(days.withColumns({"scope": F.lit("both"), "scope_key": F.lit("both")}), 0.0025)
    r = Q.percentiles(both).first()
    assert r.n == 4000 and abs(r.p50 - 1999) <= 0.01 * 4000


def test_levels_follow_the_number_of_tasks():
    assert Q.fans_for(8) == (1,) and Q.fans_for(1000) == (4, 1) and Q.fans_for(10**7) == (39063, 10, 1)


def test_nothing_counted(spark):
    df = spark.createDataFrame([("r", None, None), ("r", float("nan"), None)], "run string, x double, at timestamp")
    assert Q.percentiles_by_scope(df, "run", "at", ["x"]).count() == 0
    assert Q.percentiles_by_scope(df.limit(0), "run", "at", ["x"]).count() == 0
