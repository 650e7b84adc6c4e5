"""Sinks: CSV in bounded files, keyed upserts and completion records, on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import safe_cell
from ..operators.audit import replace_keys


def write_csv(df: DataFrame, path: str, rows_per_file: int = 0, compress: bool = False, partition_by: list[str] | None = None, guard: bool = False, mark: bool = False) -> None:
    """CSV with a header (also when there are no rows), null as empty. Array columns are joined by ``|``; with ``guard``
    cells that would start a formula get a leading space; with ``mark`` each file
    begins with a byte order mark, as part of the first column's name in the header."""
    cols = []
    for name, kind in df.dtypes:
        c = F.concat_ws("|", F.col(name)) if kind == "array<string>" else F.col(name)
        cols.append((safe_cell(c) if guard and kind == "string" else c).alias(name))
    out = df.select(*cols)
    if mark:
        out = out.toDF("\ufeff" + df.columns[0], *df.columns[1:])
    w = out.write.mode("overwrite").options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).option("emptyValue", "").option("nullValue", "")
    if compress:
        w = w.option("compression", "gzip")
    if rows_per_file:
        w = w.option("maxRecordsPerFile", rows_per_file)
    (w.partitionBy(*partition_by) if partition_by else w).csv(path)


def write_versioned(df: DataFrame, root: str, version: str) -> str:
    """A new version beside the old ones: readers see it once its success marker is there."""
    path = f"{root.rstrip('/')}/version={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def upsert(spark: SparkSession, root: str, old: str | None, new: str, batch: DataFrame, key: list[str]) -> DataFrame:
    """The table ``old`` without the batch's keys, then the batch, written as version ``new``."""
    whole = replace_keys(spark.read.parquet(f"{root}/version={old}"), batch, key) if old else batch
    return spark.read.parquet(write_versioned(whole, root, new))


def write_run_info(info: DataFrame, path: str) -> None:
    """Completion records, one JSON object per unit; written last, so their presence says that the unit is done."""
    info.write.mode("overwrite").text(path)


def smaller_of(sizes: DataFrame, before: str, after: str, same: str) -> DataFrame:
    """What to keep of a lossless rewrite: the new one only if it is equal in content and smaller."""
    verdict = F.when(~F.col(same), "differs").when(F.col(after) < F.col(before), "shrunk").otherwise("kept")
    return sizes.withColumn("verdict", verdict).withColumn("bytes", F.when(F.col("verdict") == "shrunk", F.col(after)).otherwise(F.col(before)))
