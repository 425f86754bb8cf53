"""Session helpers: where lineage is cut, and how many partitions a shuffle gets."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the session names in ``spark.checkpoint.dir``.

    Only a local session that names none (tests, notebooks) gets a temporary folder; on a
    cluster a folder that all executors share has to be named.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("name a shared folder in spark.checkpoint.dir")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="assaylake-ckpt-"))


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and return the copy read from it.

    Used where one result feeds several branches, and where a later step depends on the
    partitioning of this one: the written copy survives the loss of an executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_width(spark: SparkSession, least: int = 4) -> int:
    """Number of partitions for an explicit repartition."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a table whose files make fewer splits than there are cores.

    Tables with enough splits, as all large ones have, are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
