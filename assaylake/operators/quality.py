"""Column quality profile of delivered loads: exact shares, quantiles, distincts and drift.

The profiled columns, of any type, are unpivoted to (table, column, load, value), counted per
distinct value before anything is shuffled, and range-sorted. Every range partition sums its own
counts; the sums of the partitions before it are added afterwards. From these prefix counts come
exact quantiles, distinct counts and the shares of negative, zero and positive values; from the
merged curves of a load and the one before it come the exact Kolmogorov-Smirnov distance and the
share of non-zero values in both. No load, however large, is gathered in one task.

Values are sorted as numbers where the kind of the column gives one (times as seconds, truth
values as 0 and 1, lists of messages as 0 if empty and 1 if not), else as texts in code point
order. Values that lack the right form come after all others and count as distinct values only.

Defined results: an empty table gives no rows; a load whose values are all missing has null
quantiles and distances and no `constant`, `pattern`, `range` or `drift` finding; a null
load number is a load of its own, without a predecessor; nested columns are profiled as JSON.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.functions.text import is_missing_qc
from assaylake.session import cut, shuffle_width

_JSON_TEXT = r'"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+"'
_GAP = r"[ \t\n\r]*+"
# Fixed patterns: the right form of a value of each kind.
FORMS = {
    "count": r"^-?[0-9]+\z",
    "flag": r"^(?:True|False)\z",
    "messages": rf"^\[{_GAP}(?:{_JSON_TEXT}{_GAP}(?:,{_GAP}{_JSON_TEXT}{_GAP})*+)?\]\z",
}


@dataclass(frozen=True)
class Judged:
    """A column to profile. ``limit`` names the column that bounds a count from above.

    kind: ``count``, ``flag`` or ``messages`` for texts that ought to have that form; ``number``,
    ``time``, ``truth`` and ``text`` for columns of that type, which always have the right form.
    """

    table: str
    column: str
    kind: str
    limit: str | None = None


def measure(c: Column, kind: str) -> Column:
    """Number that stands for a value of the right form; null if it is sorted as a text."""
    if kind in ("count", "number"):
        return c.try_cast("double")
    if kind == "flag":
        return F.when(c == "True", 1.0).otherwise(0.0)
    if kind == "truth":
        return F.when(c == "true", 1.0).otherwise(0.0)
    if kind == "time":
        return F.unix_micros(c.try_cast("timestamp")) / 1e6
    if kind == "messages":
        return F.when(c.rlike(rf"^\[{_GAP}\]\z"), 0.0).otherwise(1.0)
    return F.lit(None).cast("double")


def every_column(table: str, df: DataFrame, load: str = "load_no") -> list[Judged]:
    """All columns of a table but the load number, each by its type."""
    kinds = {"boolean": "truth", "timestamp": "time", "timestamp_ntz": "time", "date": "time"}
    number = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
    return [
        Judged(table, c, kinds.get(t, "number" if t.split("(")[0] in number else "text")) for c, t in df.dtypes if c != load
    ]


def unpivot_loads(df: DataFrame, judged: Judged, load: str = "load_no") -> DataFrame:
    """One row per distinct value of the column in each load, with its number of rows."""
    held = F.col(f"`{judged.column}`")
    nested = df.schema[judged.column].dataType.simpleString().startswith(("array", "map", "struct"))
    value = (F.to_json(held) if nested else held).cast("string")
    missing = is_missing_qc(value)
    right = ~missing
    if judged.kind in FORMS:
        right = F.coalesce(value.rlike(FORMS[judged.kind]), F.lit(False)) & right
    number = F.when(right, measure(value, judged.kind))
    outside = F.lit(False)
    if judged.limit:
        outside = F.coalesce(right & ((number < 0) | (number > F.col(judged.limit).cast("double"))), F.lit(False))
    return (
        df.select(
            F.col(load).cast("bigint").alias("load_no"),
            value.alias("value"),
            missing.alias("missing"),
            right.alias("right_form"),
            number.alias("number"),
            outside.cast("bigint").alias("outside")
        )
        .groupBy("load_no", "value", "missing", "right_form", "number")
        .agg(F.count("*").alias("n"), F.sum("outside").alias("outside"))
        .withColumns({"table_name": F.lit(judged.table), "column_name": F.lit(judged.column), "kind": F.lit(judged.kind)})
    )


KEY = ["table_name", "column_name", "load_no"]
POINT = ["form", "number", "text"]
SUMS = ["n", "n_before", "texts"]


def _prefix(batches):
    """Running counts within a range partition, one stream of sorted rows."""
    from pyspark import TaskContext

    pid = TaskContext.get().partitionId()
    last, sums = None, [0] * len(SUMS)
    for b in batches:
        if not b.num_rows:
            continue
        new = np.zeros(b.num_rows, bool)
        for k in KEY:
            code = b[k].dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            new[1:] |= code[1:] != code[:-1]
        group = np.cumsum(new)
        start = np.flatnonzero(np.concatenate(([True], new[1:])))
        goes_on = last == [b[k][0].as_py() for k in KEY]
        out = []
        for i, name in enumerate(SUMS):
            x = b[name].to_numpy(zero_copy_only=False).astype(np.int64)
            total = np.cumsum(x)
            out.append(total - (total - x)[start][group] + (group == 0) * (sums[i] if goes_on else 0))
        last, sums = [b[k][b.num_rows - 1].as_py() for k in KEY], [int(o[-1]) for o in out]
        runs = [pa.array(o) for o in out]
        yield pa.RecordBatch.from_arrays(
            [*b.columns, *runs, pa.array(np.full(b.num_rows, pid, np.int32))], names=[*b.schema.names, *[f"run_{c}" for c in SUMS], "part"]
        )


def range_curves(values: DataFrame, loads: DataFrame) -> DataFrame:
    """Cumulative counts of each load and of the load before it, at every value of either.

    values: distinct values with counts; loads: the loads of each column with ``next_load``.
    cum_texts counts the distinct values of the load itself.
    """
    # values that stand for one number are one point of the curve; texts are points of their own
    form = F.when(F.col("right_form"), 0).otherwise(1)
    text = F.when(F.col("right_form") & F.col("number").isNotNull(), "").otherwise(F.col("value"))
    points = values.where("not missing").groupBy(*KEY, form.alias("form"), F.when(F.col("right_form"), F.col("number")).alias("number"), text.alias("text"))
    own = points.agg(F.sum("n").alias("n"), F.lit(0).cast("bigint").alias("n_before"), F.count("*").alias("texts"))
    # the number of loads is small beside the values; rows follow their load to the next one
    zero = F.lit(0).cast("bigint")
    seen = own.join(loads.where("next_load is not null").select(*KEY, "next_load"), KEY).select(
        "table_name", "column_name", F.col("next_load").alias("load_no"), *POINT, zero.alias("n"), F.col("n").alias("n_before"), zero.alias("texts")
    )
    both = own.unionByName(seen).groupBy(*KEY, *POINT).agg(*[F.sum(c).alias(c) for c in SUMS])
    width = shuffle_width(values.sparkSession)
    schema = "table_name string, column_name string, load_no bigint, form int, number double, text string, n bigint, n_before bigint, texts bigint"
    runs = ", ".join(f"run_{c} bigint" for c in SUMS)
    order = [*KEY, *POINT]
    local = cut(both.repartitionByRange(width, *order).sortWithinPartitions(*order).mapInArrow(_prefix, f"{schema}, {runs}, part int"))
    # one row per partition and load: what the partitions before it hold
    ahead = Window.partitionBy(*KEY).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = local.groupBy(*KEY, "part").agg(*[F.sum(c).alias(c) for c in SUMS])
    parts = parts.select(*KEY, "part", *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(c) for c in SUMS])
    cums = {"n": "cum", "n_before": "cum_before", "texts": "cum_texts"}
    return (
        local.alias("x")
        .join(parts.alias("p"), [F.col(f"x.{k}").eqNullSafe(F.col(f"p.{k}")) for k in [*KEY, "part"]])
        .select(*[f"x.{k}" for k in [*KEY, *POINT, "n", "n_before"]], *[(F.col(f"x.run_{c}") + F.col(f"p.{c}")).alias(name) for c, name in cums.items()])
    )


def _at(rank: Column, of: str = "number") -> Column:
    """The value that holds a rank, 1 being the least."""
    return F.min(F.when((F.col("n") > 0) & (F.col("form") == 0) & (F.col("cum") >= rank), F.col(of)))


def profile_loads(tables: dict[str, DataFrame], judged: list[Judged], load: str = "load_no") -> DataFrame:
    """One row per table, column and load: counts, exact quantiles, distincts, drift."""
    values = None
    for j in judged:
        part = unpivot_loads(tables[j.table], j, load)
        values = part if values is None else values.unionByName(part)
    values = cut(values)
    counts = values.groupBy(*KEY, "kind").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("missing"), F.col("n")).otherwise(0)).alias("missing"),
        F.sum(F.when(~F.col("missing") & ~F.col("right_form"), F.col("n")).otherwise(0)).alias("wrong_form"),
        F.sum("outside").alias("out_of_range")
    )
    # one row per load and column: a handful of numbers however large the loads are
    order = Window.partitionBy("table_name", "column_name").orderBy("load_no")
    known = F.col("load_no").isNotNull()
    counts = cut(
        counts.withColumns(
            {"prev_load": F.when(known, F.lag("load_no").over(order)), "next_load": F.when(known, F.lead("load_no").over(order))}
        )
    )
    curves = cut(range_curves(values, counts))
    # what the curves hold of the right form: below zero, at most zero, in all
    right, least = F.col("form") == 0, F.lit(0).cast("bigint")
    held = lambda c, cond: F.coalesce(F.max(F.when(right & cond, F.col(c))), least)
    always = F.lit(True)
    ends = curves.groupBy(*KEY).agg(
        F.max("cum_texts").alias("distinct_values"),
        *[held(c, F.col("number") < 0).alias(f"{p}negative") for c, p in (("cum", ""), ("cum_before", "prev_"))],
        *[held(c, F.col("number") <= 0).alias(f"{p}upto_zero") for c, p in (("cum", ""), ("cum_before", "prev_"))],
        *[held(c, always).alias(f"{p}right_form") for c, p in (("cum", ""), ("cum_before", "prev_"))]
    )
    same = [F.col(f"b.{k}").eqNullSafe(F.col(f"e.{k}")) for k in KEY]
    base = cut(counts.alias("b").join(ends.alias("e"), same, "left").select("b.*", *[f"e.{c}" for c in ends.columns if c not in KEY]))
    base = base.fillna(0, [c for c in ends.columns if c not in KEY])
    zero = F.col("upto_zero") - F.col("negative")
    nonzero = F.col("right_form") - zero
    among = lambda r: F.when(r <= F.col("negative"), r).otherwise(r + zero)  # noqa: E731  rank among the non-zero numbers
    lower, upper = F.expr("(right_form - upto_zero + negative + 1) div 2"), F.expr("(right_form - upto_zero + negative + 2) div 2")
    exact = lambda q: F.greatest(F.lit(1), F.ceil(F.lit(q) * F.col("right_form")))
    gap = F.abs(F.col("cum") / F.col("right_form") - F.col("cum_before") / F.col("prev_right_form"))
    here = (F.col("n") > 0) & right
    text = lambda c: F.nullif(c, F.lit(""))
    stats = (
        curves.alias("x")
        .join(base.alias("b"), [F.col(f"x.{k}").eqNullSafe(F.col(f"b.{k}")) for k in KEY])
        .groupBy(*[F.col(f"x.{k}") for k in KEY])
        .agg(
            F.min(F.when(here, F.col("number"))).alias("least"),
            F.max(F.when(here, F.col("number"))).alias("most"),
            _at(exact(0.25)).alias("p25"),
            _at(exact(0.5)).alias("p50"),
            _at(exact(0.75)).alias("p75"),
            text(F.min(F.when(here, F.col("text")))).alias("least_text"),
            text(_at(exact(0.5), "text")).alias("median_text"),
            text(F.max(F.when(here, F.col("text")))).alias("most_text"),
            F.when(F.max(nonzero) > 0, (_at(among(lower)) + _at(among(upper))) / 2).alias("median_nonzero"),
            F.max(F.when(right & (F.col("right_form") > 0) & (F.col("prev_right_form") > 0), gap)).alias("ks"),
        )
    )
    found = [c for c in stats.columns if c not in KEY]
    out = base.alias("b").join(stats.alias("s"), [F.col(f"b.{k}").eqNullSafe(F.col(f"s.{k}")) for k in KEY], "left").select(
        "b.*", *[f"s.{c}" for c in found]
    )
    share = nonzero / F.col("right_form")
    prev_share = (F.col("prev_right_form") - F.col("prev_upto_zero") + F.col("prev_negative")) / F.col("prev_right_form")
    return out.withColumns(
        {"share": F.when(F.col("right_form") > 0, share), "prev_share": F.when(F.col("prev_right_form") > 0, prev_share)}
    ).withColumn("prev_median", F.when(F.col("prev_load").isNotNull(), F.lag("median_nonzero").over(order)))


def findings(
    profile: DataFrame,
    missing_share: float = 0.15,
    share_change: float = 0.2503,
    median_ratio: float = 3.0,
    counted: tuple[str, ...] | None = None
) -> DataFrame:
    """(table_name, column_name, load_no, finding) of every load that is out of line.

    Of flags and messages, which are 0 or 1, the Kolmogorov-Smirnov distance is the change of
    the share; of counts both that share and the median of the non-zero ones are compared (of
    those in ``counted`` only, if that is given).
    """
    filled = F.col("rows") - F.col("missing")
    count = F.col("kind") == "count"
    medians = (count if counted is None else count & F.col("column_name").isin(*counted)) & (
        (F.col("median_nonzero") > median_ratio * F.col("prev_median")) | (F.col("median_nonzero") * median_ratio < F.col("prev_median"))
    )
    moved = F.when(F.col("kind").isin("flag", "messages", "truth"), F.col("ks")).when(count, F.abs(F.col("share") - F.col("prev_share")))
    tests = {
        "missing": F.col("missing") > missing_share * F.col("rows"),
        "constant": (filled > 0) & (F.col("distinct_values") == 1),
        "pattern": F.col("wrong_form") > 0,
        "range": F.col("out_of_range") > 0,
        "drift": (moved > share_change) | medians,
    }
    named = F.filter(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in tests.items()]), lambda x: x.isNotNull())
    return profile.select("table_name", "column_name", "load_no", F.explode(named).alias("finding"))


JUDGED = [
    Judged("dataset_qc", "missing_perturbation_cells", "count", "n_obs"),
    Judged("dataset_qc", "matrix_integer_like_sample", "flag"),
    Judged("profile_index", "warnings", "messages"),
]
