"""Scans: manifests, overrides, event logs, inventories, key lists, checkpoints. Schemas are given, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import natural_key

MANIFEST = "acNumber string, total_parts string"
EVENT_LOG = "ac string, part int, status string, detail string, ts double"
FAILURES = "ac string, part string, url string, status string, detail string, last_checked string"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``ac, parts``: keys trimmed, counts such as ``442.0`` as integers, rows without a key left out; a blank count is
    null (those rows are the manifest's gaps). A byte order mark before the header is no matter."""
    m = spark.read.csv(path, schema=MANIFEST, header=True, enforceSchema=True)
    ac = F.regexp_replace(F.trim("acNumber"), "^\\ufeff", "")
    return m.select(ac.alias("ac"), F.trim("total_parts").try_cast("double").cast("int").alias("parts")).where("ac <> ''")


def json_map(spark: SparkSession, path: str, key: str = "ac", value: str = "parts") -> DataFrame:
    """The entries of one JSON object; a missing or broken file has none."""
    schema = f"{key} string, {value} bigint"
    try:
        text = spark.read.text(path, wholetext=True)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)
    return text.select(F.explode(F.from_json("value", "map<string,bigint>")).alias(key, value)).where(F.col(value).isNotNull())


def event_log(spark: SparkSession, path: str) -> DataFrame:
    e = spark.read.json(path, schema=EVENT_LOG)
    return e.withColumn("at", F.timestamp_millis((F.col("ts") * 1000).cast("bigint")))


def inventory(spark: SparkSession, path: str, glob: str = "*.pdf", head: int = 5) -> DataFrame:
    """``path, length, head``: the files under a folder and their first bytes."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return f.select("path", "length", F.substring("content", 1, head).alias("head"))


def listing(spark: SparkSession, path: str, glob: str = "*.pdf", recursive: bool = False) -> DataFrame:
    """``path, length`` of the files in a folder, in natural order of their paths. The files are not opened."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", glob).load(path)
    return f.select("path", "length").orderBy(natural_key("path"))


def is_valid_file(length: str = "length", head: str = "head", least: int = 1024, magic: bytes = b"%PDF-") -> Column:
    return (F.col(length) >= least) & (F.col(head) == F.lit(magic))


def keys_of_path(path: str = "path") -> Column:
    """``ac, part`` from a file name, by the first of the known forms that fits."""
    forms = (r"AC[_-]?0*([0-9]+)[^/]*?PART[_-]?0*([0-9]+)", r"(?:^|/)0*([0-9]+)_0*([0-9]+)\.[a-z]+$", r"-([0-9]+)-([0-9]+)-[^/]*$")
    pick = lambda i: F.coalesce(*[F.nullif(F.regexp_extract(F.col(path), f, i), F.lit("")) for f in forms]).try_cast("int")
    return F.struct(pick(1).alias("ac"), pick(2).alias("part"))


def key_list(spark: SparkSession, path: str) -> DataFrame:
    """Keys separated by white space or commas, ``#`` comments left out, leading zeros dropped, each once."""
    t = spark.read.text(path).select(F.explode(F.split(F.regexp_replace("value", "#.*", ""), r"[\s,]+")).alias("key"))
    return t.where("key <> ''").select(F.regexp_replace("key", "^0+(?=[0-9])", "").alias("key")).distinct()


def checkpoints(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All part files with their natural order, to be sorted by ``part_ord`` and the rows' own order."""
    d = spark.read.csv(path, schema=schema, header=True, nullValue="\u0000", emptyValue="")
    return d.withColumn("part_ord", natural_key(F.input_file_name()))
