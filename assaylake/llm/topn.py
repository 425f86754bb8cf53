"""Top N items within every group by secondary sort.

Each input partition is sorted by group, score and identifier and streamed as Arrow batches
that give out N rows per group, so a group sends at most N rows per partition into the shuffle.
The rest is hash-partitioned by group and streamed in the same way for the final places. A task
holds one batch and the names of the N items given out for the current group, never a group.
Where there are so many partitions that even N rows of each are a lot for one task, groups are
first reduced once more by salts, as many as that number asks for.

Defined results: items whose score is null, NaN or infinite, and null items, do not count;
zero has no sign; an item that occurs again counts once, with its highest score; equal scores
are ordered by item in code point order; a null group is a group of its own; a group with
fewer than N items gives those it has; an empty table gives no rows. Other columns of the
input are not read. Groups are of any type but nested ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.session import shuffle_width

ONE_TASK = 1_000_000  # rows of one group that may meet in a task without salts


def _codes(c: pa.Array) -> np.ndarray:
    """Numbers that are equal where the values are; a null is a value like any other."""
    return c.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _same(a, b) -> bool:
    return a == b or (a != a and b != b)


def _first_n(keys: list[str], n: int, ranked: bool):
    """Arrow stream: of rows sorted by keys, score and item, the first n items of each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, taken = None, []  # the group that the rows before belong to, and its items given out
        for b in batches:
            if not b.num_rows:
                continue
            new = np.zeros(b.num_rows, bool)
            for k in keys:
                code = _codes(b[k])
                new[1:] |= code[1:] != code[:-1]
            group = np.cumsum(new)
            # an item's first row in its group is its best one
            item = _codes(b["item"])
            _, at = np.unique(group * (item.max() + 1) + item, return_index=True)
            first = np.zeros(b.num_rows, bool)
            first[at] = True
            head = tuple(b[k][0].as_py() for k in keys)
            goes_on = last is not None and all(map(_same, head, last))
            if goes_on:
                first[(group == 0) & pc.is_in(b["item"], pa.array(taken, pa.string())).to_numpy(zero_copy_only=False)] = False
            else:
                taken = []
            count = np.cumsum(first)
            start = np.flatnonzero(np.concatenate(([True], new[1:])))
            place = count - (count - first)[start][group] + (group == 0) * len(taken)
            keep = first & (place <= n)
            if group[-1]:
                taken = []
            taken += b["item"].filter(pa.array(keep & (group == group[-1]))).to_pylist()
            last = tuple(b[k][b.num_rows - 1].as_py() for k in keys)
            out = b.select([*keys, "score", "item"]).filter(pa.array(keep))
            if ranked:
                out = pa.RecordBatch.from_arrays([*out.columns, pa.array(place[keep])], names=[*keys, "score", "item", "place"])
            yield out

    return run


def top_n(df: DataFrame, group: str, score: str, item: str, n: int = 10, salts: int | None = None) -> DataFrame:
    """(group, place, item, score) of the n best items of each group.

    salts: parts into which each group is reduced before the last pass; by default as many as
    the number of input partitions asks for, one meaning none.
    """
    field = df.schema[group].dataType.simpleString()
    value = F.col(score).cast("double") + F.lit(0.0)  # -0.0 becomes 0.0
    whose = F.col(group) + F.lit(0.0).cast(field) if field in ("double", "float") else F.col(group)
    rows = df.select(whose.alias("grp"), value.alias("score"), F.col(item).cast("string").alias("item"))
    rows = rows.where("score is not null and not isnan(score) and abs(score) < double('Infinity') and item is not null")
    width = shuffle_width(df.sparkSession)
    order = [F.col("score").desc(), F.col("item").asc()]
    shape = f"grp {field}, score double, item string"
    part = rows.sortWithinPartitions("grp", *order).mapInArrow(_first_n(["grp"], n, False), shape)
    if salts is None:
        salts = -(-rows.rdd.getNumPartitions() * n // ONE_TASK)
    if salts > 1:
        part = (
            part.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(salts)).cast("int"))
            .repartition(width, "grp", "salt")
            .sortWithinPartitions("grp", "salt", *order)
            .mapInArrow(_first_n(["grp", "salt"], n, False), f"grp {field}, salt int, score double, item string")
            .drop("salt")
        )
    return (
        part.repartition(width, "grp")
        .sortWithinPartitions("grp", *order)
        .mapInArrow(_first_n(["grp"], n, True), f"{shape}, place bigint")
        .select(F.col("grp").alias(group), "place", F.col("item").alias(item), F.col("score").alias(score))
    )
