"""Shared helpers of the training-data operators: safe column selection, staged tables, text constants."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Fixed value: a word is a run of anything but these (Java regular expressions).
WS_CLASS = r"[\x20\x09-\x0D]"
WS_RUN = WS_CLASS + "+"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_OWN_DIR: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor sees: ``spark.checkpoint.dir``. Where it is unset and Spark runs in this one process
    (tests), a folder of our own; a cluster without the setting raises, since its machines share no other folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if "dir" not in _OWN_DIR:
        _OWN_DIR["dir"] = tempfile.mkdtemp(prefix="foliospark-")
        atexit.register(shutil.rmtree, _OWN_DIR["dir"], True)
    return "file://" + _OWN_DIR["dir"]


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


class Staged:
    """Written intermediate tables of one operator run.

    ``write`` cuts the lineage (a lost executor costs a re-read, not a re-run) and lets Spark delete the shuffle
    files of the finished write, so the disk needed is that of the largest step, not of their sum.
    ``drop`` deletes a table that nothing will read again.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def write(self, df: DataFrame, tag: str) -> DataFrame:
        path = new_path(self.spark, tag)
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(_CLEANUP)
            else:
                self.spark.conf.set(_CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._staged_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            delete_path(self.spark, t._staged_path)


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def placed(df: DataFrame) -> DataFrame:
    """The same columns named ``c0, c1, ...`` by place, which no name can clash with."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def place_of(df: DataFrame, name: str) -> str:
    """The name in ``placed`` of the first column called exactly ``name``; without one, it raises."""
    if name not in df.columns:
        raise ValueError(f"no column {name!r} among {df.columns}")
    return f"c{df.columns.index(name)}"


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns, under internal names, so that extra or clashing columns cannot interfere: names
    count exactly (``text`` is not ``Text``), the first of equal ones is taken, a missing one raises."""
    return placed(df).select(*[F.col(place_of(df, src)).alias(dst) for dst, src in columns.items()])


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


def bound_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """Have Spark hand rows to Python in batches of at most so many bytes, whatever their number; a lower setting stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if now > most:
        spark.conf.set(key, str(most))


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker, for tables and caches that many tasks use.

    Functions reach workers by value, so a module global would start empty in each task.
    """
    import sys
    import types

    return sys.modules.setdefault("_worker_state", types.ModuleType("_worker_state")).__dict__
