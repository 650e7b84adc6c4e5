"""The folder that the driver and all executors share, and tables kept in it for the length of a computation."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path below ``spark.checkpoint.dir``. Where that is unset and Spark is this one process, below a folder of our
    own; on a cluster it raises, since machines share nothing else."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if "dir" not in _OWN:
            _OWN["dir"] = tempfile.mkdtemp(prefix="foliospark-core-")
            atexit.register(shutil.rmtree, _OWN["dir"], True)
        root = "file://" + _OWN["dir"]
    return f"{root.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def settled(df: DataFrame, tag: str = "settled") -> DataFrame:
    """The table written and read back: what it says no longer depends on how it was made, nor on an executor."""
    path = shared_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
