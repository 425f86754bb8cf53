"""Incremental stages for counts and cells that arrive in files over time.

Structured Streaming keeps the sums; late repeats of a cell are dropped within the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def running_pseudobulk(counts: DataFrame, membership: DataFrame) -> DataFrame:
    """Sums per group and feature over a stream of triplets; output mode update or complete.

    membership: (dataset_id, cell_ord, group_id), a table that does not change while the
    stream runs. Counts of unknown cells are dropped, null values count as 0.
    """
    joined = counts.join(membership, ["dataset_id", "cell_ord"])
    return joined.groupBy("dataset_id", "group_id", "feature_id").agg(F.sum(F.coalesce(F.col("value"), F.lit(0)).cast("double")).alias("count_sum"))


def first_deliveries(cells: DataFrame, key: list[str], at: str, delay: str = "7 days") -> DataFrame:
    """Each cell once, as first delivered; repeats later than ``delay`` are taken as new."""
    return cells.withWatermark(at, delay).dropDuplicatesWithinWatermark(key)


def daily_deliveries(cells: DataFrame, at: str, delay: str = "7 days", every: str = "1 day") -> DataFrame:
    """Cells per data set and window of delivery; output mode append once a window is past."""
    return cells.withWatermark(at, delay).groupBy(F.window(at, every), "dataset_id").agg(F.count("*").alias("cells")).select(
        "dataset_id", F.col("window.start").alias("window_start"), "cells"
    )
