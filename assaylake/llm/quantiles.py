"""Percentiles of very large numeric columns from mergeable rank-interval summaries.

Each task turns its rows, some hundred thousand at a time, into summaries for every scope (a
run, a day, the whole table) and metric: tuples ``(value, lo, hi)`` where ``lo`` and ``hi``
bound the rank of the value. Few values are kept as they are; many are compressed to the
permitted uncertainty, so the whole table's summary leaves a task as some hundred tuples.
Summaries are merged in a tree, bucket by bucket, with as many levels as the number of tasks
asks for. The permitted error is shared out over the levels: a task's own summary may use one
share, the first merge two, and so on. A merged summary has the uncertainty of its parts and as
many tuples as all of them; with the next share it is compressed to a number of tuples that
depends on the share only. The bound that has really built up is carried along and reported.
The summaries of single days can be stored and merged later in the same way.

Defined results: null and NaN are not counted, infinite and stray huge values are; a group
without a counted value gives no row; a null group is a group; a percentile ``q`` of ``n``
values is the value of rank ``max(1, ceil(q*n))``, met within ``rank_error`` ranks, at most
``eps*n`` (and always exact while ``eps*n`` is under one).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.session import shuffle_width, spread

ROWS = 500_000  # rows that a task summarises at a time
FAN = 4096  # summaries of one key that are merged by one task
KEYS = ["scope", "scope_key", "metric"]
SUMMARY = "scope string, scope_key string, metric string, n bigint, vals array<double>, lo array<bigint>, hi array<bigint>"
NAMES = [*KEYS, "n", "vals", "lo", "hi"]


def compress(v: np.ndarray, lo: np.ndarray, hi: np.ndarray, n: int, room: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Drop tuples so that the widest gap between neighbours stays within 2*room ranks.

    The first and the last tuple, the extremes, always stay.
    """
    if len(v) <= 3 or room < 1:
        return v, lo, hi
    keep, i, last = [0], 0, len(v) - 1
    while i < last:
        # the farthest j with hi[j] - lo[i] <= 2*room, at least the next tuple
        j = int(np.searchsorted(hi, lo[i] + 2 * room, side="right")) - 1
        i = min(last, max(i + 1, j))
        keep.append(i)
    k = np.array(keep)
    return v[k], lo[k], hi[k]


def merge(parts: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Summary of the union: the bounds of a value's rank add up over the parts.

    In the merged order, a part's bounds at any place are those of its last tuple before and
    its first tuple after; both change at its own tuples only, so running sums of the changes
    give the sums over all parts at once.
    """
    if len(parts) == 1:
        return parts[0]
    n = sum(p[0] for p in parts)
    if all(len(p[1]) == p[0] for p in parts):  # nothing is compressed yet
        v = np.sort(np.concatenate([p[1] for p in parts]), kind="stable")
        r = np.arange(1, n + 1)
        return n, v, r, r.copy()
    v, lo, hi = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
    rise = np.concatenate([np.diff(p[2], prepend=0) for p in parts])
    after = np.concatenate([np.append(p[3][1:] - 1, p[0]) for p in parts])  # ranks at or below the next tuple of the part
    first = sum(int(p[3][0]) - 1 for p in parts)
    climb = np.concatenate([np.diff(np.append(p[3] - 1, p[0])) for p in parts])
    order = np.lexsort((np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts]), v))
    low = np.cumsum(rise[order])
    high = first + np.cumsum(climb[order]) - after[order] + hi[order]
    return n, v[order], low, high


def error(lo: np.ndarray, hi: np.ndarray) -> float:
    """Ranks by which an answer from these tuples can be off."""
    if len(lo) < 2:
        return 0.0
    return float(max(np.max(hi[1:] - lo[:-1]) / 2, np.max(hi - lo) / 2)) if np.any(hi[1:] - lo[:-1] > 1) else 0.0


def query(n: int, v: np.ndarray, lo: np.ndarray, hi: np.ndarray, q: float) -> float:
    r = min(n, max(1, math.ceil(round(q * n, 9))))
    return float(v[int(np.argmin(np.maximum(r - lo, hi - r)))])


def _group_summaries(code: np.ndarray, x: np.ndarray, room: float) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Summaries of the values of each code: codes, sizes, and the flat vals, lo, hi and lengths.

    Groups of few values are laid out without a loop.
    """
    order = np.lexsort((x, code))
    c, x = code[order], x[order]
    cut = np.concatenate(([0], np.flatnonzero(np.diff(c)) + 1, [len(c)]))
    size = np.diff(cut)
    rank = np.arange(len(x), dtype=np.int64) - np.repeat(cut[:-1], size) + 1
    lo, hi, length = rank, rank, size.copy()
    big = np.flatnonzero(size * room >= 1)
    if len(big):
        parts, at = [], 0
        for g in big:
            a, e = cut[g], cut[g + 1]
            kept = compress(x[a:e], rank[a:e], rank[a:e], int(size[g]), size[g] * room)
            before = slice(cut[at], a)
            parts += [(x[before], rank[before], rank[before]), kept]
            length[g], at = len(kept[0]), g + 1
        rest = slice(cut[at], None)
        parts.append((x[rest], rank[rest], rank[rest]))
        x, lo, hi = (np.concatenate([p[i] for p in parts]) for i in range(3))
    return c[cut[:-1]], size, [x, lo, hi, length]


def _summaries(scopes: list[str], metrics: list[str], room: float):
    """Arrow stream of summaries; columns come as one key per scope, then the metrics."""

    def make(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        for k, scope in enumerate(scopes):
            code, keys = pd.factorize(t.column(k).to_pandas(), use_na_sentinel=False)
            keys = pa.array([None if v is None or v != v else v for v in keys], pa.string())
            for j, m in enumerate(metrics):
                x = t.column(len(scopes) + j).to_numpy()
                x = np.array(x, dtype=float)
                ok = ~np.isnan(x)
                if not ok.any():
                    continue
                who, size, (v, lo, hi, length) = _group_summaries(code[ok], x[ok], room)
                off = pa.array(np.concatenate(([0], np.cumsum(length))), pa.int32())
                lists = [pa.ListArray.from_arrays(off, pa.array(y)) for y in (v, lo, hi)]
                n = len(size)
                cols = [pa.array([scope] * n), keys.take(pa.array(who)), pa.array([m] * n), pa.array(size.astype(np.int64)), *lists]
                made = pa.RecordBatch.from_arrays(cols, names=NAMES)
                for s in range(0, n, 10_000):
                    yield made.slice(s, 10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                rows += b.num_rows
            if rows >= ROWS:
                yield from make(held)
                held, rows = [], 0
        if held:
            yield from make(held)

    return run


def _lists(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """vals, lo and hi of each row."""
    flat = [b[c].flatten().to_numpy(zero_copy_only=False) for c in ("vals", "lo", "hi")]
    off = np.concatenate(([0], np.cumsum(b["vals"].value_lengths().to_numpy(zero_copy_only=False))))
    for i in range(b.num_rows):
        yield tuple(f[off[i] : off[i + 1]] for f in flat)


def _merge_sorted(room: float):
    """Merge the summaries of each bucket and key; rows come sorted, one key at a time is held.

    A bucket has about FAN summaries of a key, each of as many tuples as its share allows.
    """
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def out(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["bucket", *NAMES])

    def closed(key: tuple, parts: list) -> tuple:
        n, v, lo, hi = merge(parts)
        return (*key, n, *compress(v, lo, hi, n, n * room))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, parts, done = None, [], []
        for b in batches:
            for key, n, lists in zip(zip(*[b[k].to_pylist() for k in ["bucket", *KEYS]]), b["n"].to_pylist(), _lists(b)):
                if key != last:
                    if parts:
                        done.append(closed(last, parts))
                    last, parts = key, []
                parts.append((n, *lists))
                if len(done) >= 4096:
                    yield out(done)
                    done = []
        if parts:
            done.append(closed(last, parts))
        if done:
            yield out(done)

    return run


def fans_for(tasks: int, per_task: int = 16) -> tuple[int, ...]:
    """Buckets on each level of the tree, the last being one.

    A task gives out few summaries of a key; ``per_task`` allows for partitions of many rows.
    """
    fans, left = [], tasks * per_task
    while left > FAN:
        left = math.ceil(left / FAN)
        fans.append(left)
    return (*fans, 1)


def summarise(df: DataFrame, scopes: dict[str, Column], metrics: list[str], eps: float) -> DataFrame:
    """Summaries of each task's rows for every scope and metric, compressed to ``eps``.

    scopes: name of a scope to the column that gives its key; a literal for the whole table.
    """
    keys = [c.cast("string").alias(f"k{i}") for i, c in enumerate(scopes.values())]
    rows = df.select(*keys, *[F.col(m).cast("double").alias(f"m{j}") for j, m in enumerate(metrics)])
    return spread(rows).mapInArrow(_summaries(list(scopes), metrics, eps), SUMMARY)


def merge_summaries(parts: DataFrame, eps: float, fans: tuple[int, ...] = (1,), spent: int = 1) -> DataFrame:
    """Merge the summaries of each key in a tree, spending one more share ``eps`` on each level.

    spent: shares that the parts have used up already, one for those of ``summarise``; summaries
    that were merged before have used one more for each level. The result is within
    ``(spent + len(fans)) * eps`` and has some ``1 / eps`` tuples, however many parts there were.
    """
    width = shuffle_width(parts.sparkSession)
    # equal parts must not meet in one bucket, so a part's place decides, not what it holds
    level = parts.withColumn("bucket", F.xxhash64(F.monotonically_increasing_id()))
    for k, fan in enumerate(fans, 1):
        level = (
            level.select(F.pmod("bucket", F.lit(fan).cast("bigint")).alias("bucket"), *NAMES)
            .repartition(width, "bucket", *KEYS)
            .sortWithinPartitions("bucket", *KEYS)
            .mapInArrow(_merge_sorted(eps * (spent + k)), f"bucket bigint, {SUMMARY}")
        )
    return level.drop("bucket")


def _answers(probs: list[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(*(query(n, *lists, q) for q in probs), error(*lists[1:])) for n, lists in zip(b["n"].to_pylist(), _lists(b))]
            cols = [pa.array([g[i] for g in got], pa.float64()) for i in range(len(probs) + 1)]
            yield pa.RecordBatch.from_arrays(
                [*[b[k] for k in [*KEYS, "n"]], *cols], names=[*KEYS, "n", *[f"p{round(q * 100)}" for q in probs], "rank_error"]
            )

    return run


def percentiles(summaries: DataFrame, probs: tuple[float, ...] = (0.5, 0.9, 0.99)) -> DataFrame:
    """(scope, scope_key, metric, n, p50, ..., rank_error) read from the summaries."""
    answers = ", ".join(f"p{round(q * 100)} double" for q in probs)
    return summaries.mapInArrow(_answers(list(probs)), f"scope string, scope_key string, metric string, n bigint, {answers}, rank_error double")


def percentiles_by_scope(df: DataFrame, run: str, at: str, metrics: list[str], eps: float = 0.005) -> DataFrame:
    """Percentiles per run, per day and over all rows from one pass over the table."""
    scopes = {"run": F.col(run), "day": F.date_format(F.to_date(F.col(at)), "yyyy-MM-dd"), "all": F.lit("all")}
    fans = fans_for(df.rdd.getNumPartitions())
    share = eps / (len(fans) + 1)
    return percentiles(merge_summaries(summarise(df, scopes, metrics, share), share, fans))
