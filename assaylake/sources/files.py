"""Files around the tables: text tables, manifests, and receipts of what was written.

Text tables are read as text only, with missing cells as empty texts. Parquet is what the
stages write; text sinks exist for results that people open.

Defined results: an empty directory gives an empty table of the given columns; a manifest that
is no JSON object, or lacks its list, raises ``ValueError``; a file without a manifest entry,
or the other way round, is reported and does not stop the others.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.functions.text import blank


def read_text_table(spark: SparkSession, path: str, columns: list[str], line_breaks: bool = False) -> DataFrame:
    """A CSV table, plain or gzip, with all columns as text and no nulls.

    line_breaks: quoted cells may hold line breaks; a file is then read by one task.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    rows = spark.read.csv(path, header=True, schema=schema, escape='"', multiLine=line_breaks)
    return rows.select(*[blank(F.col(f"`{c}`")).alias(c) for c in columns])


def write_text_table(df: DataFrame, path: str, columns: list[str] | None = None, compression: str = "none") -> None:
    """Fixed columns in order (or all, by name), nulls as empty cells; one file per partition."""
    chosen = columns or sorted(df.columns)
    df.select(
        *[blank(F.col(f"`{c}`").cast("string")).alias(c) for c in chosen]
    ).write.mode("overwrite").option("compression", compression).option("emptyValue", "").option("escape", '"').csv(path, header=True)


# The header of the list of top genes.
TOP_GENES = ["dataset_id", "contrast_id", "perturbation_id", "gene_id", "effect_size", "rank_abs_effect"]


def write_top_genes(hits: DataFrame, path: str) -> None:
    """Top genes as gzip CSV under a fixed header, in the order of data set, contrast and rank within files."""
    rows = hits.withColumnRenamed("feature_id", "gene_id") if "gene_id" not in hits.columns else hits
    ordered = rows.repartitionByRange("dataset_id", "contrast_id").sortWithinPartitions("dataset_id", "contrast_id", "rank_abs_effect")
    write_text_table(ordered, path, TOP_GENES, "gzip")


def write_partitioned(df: DataFrame, path: str, by: str = "dataset_id") -> None:
    """Parquet by data set; rows of one are spread over tasks and files of bounded size."""
    df.write.mode("overwrite").option("maxRecordsPerFile", 5_000_000).partitionBy(by).parquet(path)


def read_manifest(path: str, wanted: str = "datasets") -> dict:
    """A small JSON object with a list; read by the driver."""
    found = read_optional_json(path)
    if not isinstance(found, dict) or not isinstance(found.get(wanted), list):
        raise ValueError(f"{path} must be a JSON object with a list named {wanted}")
    return found


def read_optional_json(path: str | None):
    """A small JSON file; None where no path is given or nothing is there."""
    if not path or not os.path.exists(path):
        return None
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def read_selection(spark: SparkSession, path: str) -> DataFrame:
    """(name): the names of a selection file, one JSON array of texts; anything else raises ``ValueError``."""
    found = read_optional_json(path)
    if not isinstance(found, list) or not all(isinstance(n, str) for n in found):
        raise ValueError(f"{path} must be a JSON array of names")
    return spark.createDataFrame([(n,) for n in found], "name string").distinct()


def resolve_path(path: str, *folders: str) -> str:
    """An absolute path as it is; else the first folder that has it, or the last one's place for it."""
    if os.path.isabs(path):
        return path
    places = [os.path.join(f, path) for f in folders or (os.getcwd(),)]
    return next((p for p in places if os.path.exists(p)), places[-1])


def plain_value(v):
    """Numbers, dates, sets and paths as JSON has them."""
    if hasattr(v, "tolist"):
        return v.tolist()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return sorted(v) if isinstance(v, (set, frozenset)) else str(v)


def stage_manifest(
    stage: str, statuses: DataFrame, thresholds: dict, outputs: list[str], datasets: DataFrame | None = None, head: DataFrame | None = None, rows: int = 25
) -> dict:
    """What a stage did: rows by status, thresholds, outputs, sorted data sets and the first rows of its result.

    statuses: a table with a column ``status``; it is counted in Spark, and only the counts, the
    names of the data sets and the first rows reach the driver.
    """
    counts = {r["status"]: r["count"] for r in statuses.groupBy("status").count().collect()}
    out = {"stage": stage, "counts": counts, "total": sum(counts.values()), "thresholds": thresholds, "outputs": sorted(outputs)}
    if datasets is not None:
        out["datasets"] = [r[0] for r in datasets.select("dataset_id").distinct().orderBy("dataset_id").collect()]
    if head is not None:
        out["head"] = [r.asDict(True) for r in head.limit(rows).collect()]
    return out


def write_manifest(payload: dict, path: str) -> None:
    """Written beside its place and moved there, so readers never see half of it."""
    part = f"{path}.partial"
    with open(part, "w", encoding="utf-8") as f:
        json.dump(payload, f, indent=2, sort_keys=True, ensure_ascii=False, default=plain_value)
        f.write("\n")
    os.replace(part, path)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for b in batches:
        sums = []
        for path in b["path"].to_pylist():
            place = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path
            system, inner = fs.FileSystem.from_uri(place)
            md5, sha256 = hashlib.md5(), hashlib.sha256()
            with system.open_input_stream(inner, compression=None) as f:
                while chunk := f.read(8 << 20):
                    md5.update(chunk)
                    sha256.update(chunk)
            sums.append((md5.hexdigest(), sha256.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array([s[0] for s in sums], pa.string()), pa.array([s[1] for s in sums], pa.string())], names=[*b.schema.names, "md5", "sha256"]
        )


def receipts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(name, path, size_bytes, md5, sha256) of every file under a path.

    Spark lists the files and spreads them; a task reads each of its files in pieces, so a
    file may be of any size.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    rows = files.select(name.alias("name"), "path", F.col("length").alias("size_bytes"))
    return rows.repartition("path").mapInArrow(_hashed, "name string, path string, size_bytes bigint, md5 string, sha256 string")


def verify_receipts(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(name, problem) for each file: missing, unexpected, size, checksum, repeated, or ok.

    expected: name, size_bytes, algorithm (md5 or sha256), checksum.
    """
    repeated = expected.groupBy("name").agg(
        F.count("*").alias("times"),
        F.min("size_bytes").alias("want"),
        F.min("algorithm").alias("algorithm"),
        F.min("checksum").alias("checksum")
    )
    both = repeated.join(found.select("name", "size_bytes", "md5", "sha256"), "name", "full")
    digest = F.when(F.col("algorithm") == "md5", F.col("md5")).when(F.col("algorithm") == "sha256", F.col("sha256"))
    problem = (
        F.when(F.col("times").isNull(), "unexpected")
        .when(F.col("times") > 1, "repeated")
        .when(F.col("size_bytes").isNull(), "missing")
        .when(F.col("size_bytes") != F.col("want"), "size")
        .when(~F.coalesce(F.lower("checksum") == digest, F.lit(False)), "checksum")
        .otherwise("ok")
    )
    return both.select("name", problem.alias("problem"))


def invalid_artifacts(artifacts: DataFrame) -> DataFrame:
    """(name, problem) of entries that can't be fetched as they stand.

    artifacts: name, url, size_bytes, algorithm, checksum. A name is the last part of a path, a
    url is https, a size is not negative (it may be unknown), a checksum is hex of the right length.
    """
    digits = F.when(F.col("algorithm") == "md5", 32).when(F.col("algorithm") == "sha256", 64)
    right = F.coalesce(F.lower("checksum").rlike("^[0-9a-f]+$") & (F.length("checksum") == digits), F.lit(False))
    plain = F.coalesce((F.col("name") != "") & ~F.col("name").contains("/") & ~F.col("name").isin(".", ".."), F.lit(False))
    problem = (
        F.when(~plain, "name")
        .when(~F.coalesce(F.col("url").startswith("https://"), F.lit(False)), "url")
        .when(F.col("size_bytes") < 0, "size")
        .when(F.col("checksum").isNotNull() & ~right, "checksum")
    )
    return artifacts.select("name", problem.alias("problem")).where("problem is not null")


def chosen_artifacts(artifacts: DataFrame, names: DataFrame | None, shown: int = 20) -> DataFrame:
    """The chosen artifacts by name; ``ValueError`` if a chosen name does not exist."""
    found, lacking = select_artifacts(artifacts, names)
    if some := [r[0] for r in lacking.orderBy("name").limit(shown).collect()]:
        raise ValueError("unknown artifacts: " + ", ".join(map(str, some)))
    return found.orderBy("name")


def select_artifacts(artifacts: DataFrame, names: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The chosen artifacts (all without a choice), and chosen names that do not exist."""
    if names is None:
        return artifacts, artifacts.select("name").limit(0)
    wanted = names.select("name").distinct()
    return artifacts.join(wanted, "name", "left_semi"), wanted.join(artifacts, "name", "left_anti")


def size_label(c):
    """Bytes as text with a binary unit, two decimals from KiB on."""
    units = ["B", "KiB", "MiB", "GiB", "TiB"]
    n = c.cast("double")
    out = F.format_string("%.2f TiB", n / 1024**4)
    for i in range(3, 0, -1):
        out = F.when(n < 1024 ** (i + 1), F.format_string(f"%.2f {units[i]}", n / 1024**i)).otherwise(out)
    return F.when(n < 1024, F.format_string("%.0f B", n)).otherwise(out)
