"""Sequential numbers in sort order without a single sorting task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaylake.session import cut, shuffle_width


def number_rows(df: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """Adds 1, 2, 3 ... in the order of the given columns.

    Rows are range-partitioned and sorted; each partition numbers its own rows, and the sizes
    of the partitions before it are added. Ties follow no fixed order, so the columns should
    be a key.
    """
    width = shuffle_width(df.sparkSession)
    ranged = df.repartitionByRange(width, *order).sortWithinPartitions(*order)
    local = cut(ranged.withColumn("__id", F.monotonically_increasing_id()))
    part, at = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    local = local.withColumns({"__part": part, "__at": at}).drop("__id")
    # one row per partition
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = local.groupBy("__part").agg(F.count("*").alias("__n")).select("__part", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__ahead"))
    return local.join(F.broadcast(sizes), "__part").withColumn(name, F.col("__at") + F.col("__ahead") + 1).drop("__part", "__at", "__ahead")


def number_within(df: DataFrame, group: str, order: list[str], name: str = "number") -> DataFrame:
    """Adds 1, 2, 3 ... within each group, in the order of the given columns.

    All rows are numbered in the order of group and columns; each group's first number is taken
    off again. So no task sorts a group by itself, however many rows it has.
    """
    numbered = number_rows(df, [group, *order], name)
    first = numbered.groupBy(F.col(group).alias("__group")).agg(F.min(name).alias("__first"))
    out = numbered.join(first, F.col(group).eqNullSafe(F.col("__group")))
    return out.withColumn(name, F.col(name) - F.col("__first") + 1).drop("__group", "__first")


def latest(df: DataFrame, key: list[str], by: str) -> DataFrame:
    """The row of each key that was loaded last; the rest are repeats or corrections.

    Of rows loaded at the same time the largest by value is taken, so the choice is fixed.
    """
    rest = [c for c in df.columns if c not in key and c != by]
    newest = df.groupBy(*key).agg(F.max(F.struct(F.col(by), *rest)).alias("__r"))
    return newest.select(*key, F.col(f"__r.{by}").alias(by), *[F.col(f"__r.{c}").alias(c) for c in rest]).select(*df.columns)
