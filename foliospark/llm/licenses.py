"""License scan by canonical digests: whole texts are normalised and hash-joined to the digests of known licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import narrow, text_or_empty
from .license_texts import DIGESTS, KNOWN

#: Spellings that count as equal, longest first where one contains another; applied to lower-case text.
SPELLINGS = (
    ("licence", "license"), ("sub-license", "sublicense"), ("non-infringement", "noninfringement"), ("per cent", "percent"),
    ("favour", "favor"), ("behaviour", "behavior"), ("honour", "honor"), ("organisation", "organization"), ("authoris", "authoriz"),
    ("recognis", "recogniz"), ("whilst", "while"), ("acknowledgement", "acknowledgment"), ("fulfilment", "fulfillment"),
    ("cancelled", "canceled"), ("https:", "http:"), ("&", " and "), ("copyright owner", "copyright holder"),
)
#: Fixed value: lines that state a copyright (after lower-casing A-Z), without look-around so that any regex engine agrees.
COPYRIGHT_LINE = r"(^|\n)[ \t]*((copyright|©|\(c\))[^\n]{0,3}(©|\(c\)|[0-9<\[{]|by )|all rights reserved)[^\n]*"
#: Fixed value: punctuation and white space, each run of which becomes one space.
PUNCTUATION = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F “”‘’«»–—…®™•]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(text: Column) -> Column:
    """Lower case (A-Z), no copyright lines, equal spellings, words separated by single spaces."""
    t = F.translate(F.replace(text, F.lit("\r"), F.lit("")), UPPER, LOWER)
    t = F.regexp_replace(t, COPYRIGHT_LINE, "$1")
    for a, b in SPELLINGS:
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.btrim(F.regexp_replace(t, PUNCTUATION, " "), F.lit(" "))


def scan_licenses(docs: DataFrame, known: list[tuple[str, str]] | DataFrame = KNOWN, digests: list[tuple[str, str]] = tuple(DIGESTS), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, canonical_sha256, canonical_chars, license_id`` (null where no licence has it).

    ``known`` is a list, or a table ``license_id, text`` of any size, ``digests`` a list of further licences by the SHA-256 of
    their canonical form; licences that become equal count as the first by
    name, and those that become empty match nothing. Null text counts as empty and matches nothing. Repeated rows are
    matched each on its own. The list ships with the code, so its join side is as large as the code makes it and is
    broadcast; a table given by the caller is joined as Spark sees fit, with skew left to adaptive splitting.
    """
    spark = docs.sparkSession
    listed = not isinstance(known, DataFrame)
    k = spark.createDataFrame(list(known), "license_id string, text string") if listed else known.select("license_id", "text")
    k = k.select("license_id", canonical(text_or_empty()).alias("c")).where("c <> ''").select("license_id", F.sha2("c", 256).alias("canonical_sha256"))
    k = k.unionByName(spark.createDataFrame(list(digests), "license_id string, canonical_sha256 string"))
    k = k.groupBy("canonical_sha256").agg(F.min("license_id").alias("license_id"))
    d = narrow(docs, doc_id=id_col, text=text_col).select("doc_id", canonical(text_or_empty()).alias("c"))
    d = d.select("doc_id", F.sha2("c", 256).alias("canonical_sha256"), F.char_length("c").cast("long").alias("canonical_chars"))
    return d.join(F.broadcast(k) if listed else k, "canonical_sha256", "left").select("doc_id", "canonical_sha256", "canonical_chars", "license_id")
