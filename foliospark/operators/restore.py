"""Words that lost letters, brought back by joins on the keys they share with known words."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions import script


def _keyed(words: DataFrame, column: str, out: str, keys: Callable[[str], set[str]]) -> DataFrame:
    """A row for each key of each word; keys are made once for each distinct word."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda w: sorted(keys(w)))

    made = words.select(column).distinct().withColumn(out, F.explode(F.pandas_udf(run, "array<string>")(F.col(column))))
    return words.join(made, column)


def restore(tokens: DataFrame, known: DataFrame, local: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """``unit, token, fixed`` for the tokens (``unit, token``) that one known word explains.

    ``known`` has ``word, place`` (its rank in the lexicon), ``local`` the words ``unit, word`` seen beside the tokens,
    ``counts`` how often a word was seen, ``unit, word, n``. A token is looked at if it has three letters of the script,
    no digit, and is not known. One with a skeleton of three letters takes a local word that it is a cut spelling of, or
    else a known word with its skeleton among its keys; a shorter one, of four characters, the only known word that it is
    a cut spelling of. Between several words the more frequent wins if counts are given; of equally frequent known words
    the first in the lexicon, of equally frequent local ones none.
    """
    letters = F.length(F.regexp_replace("token", "[^ऀ-ॿ]", ""))
    t = tokens.select("unit", "token").distinct().where((letters >= 3) & ~F.regexp_like("token", F.lit(r"\p{Nd}")))
    t = t.join(known.select(F.col("word").alias("token")), "token", "left_anti").withColumn("core", F.regexp_replace("token", "[^ऀ-ॿ]", ""))
    bones = F.pandas_udf(lambda s: s.map(script.skeleton), "string")
    t = t.join(t.select("core").distinct().withColumn("key", bones(F.col("core"))), "core")
    t = t.withColumn("short", F.length("key") < 3)
    lexicon = known.select("word", "place")
    by_key = t.where("not short").join(_keyed(lexicon, "word", "key", script.lossy_keys), "key")
    by_cut = t.where("short and length(core) >= 4").join(_keyed(lexicon, "word", "cut", script.cut_spellings).withColumnRenamed("cut", "token"), "token")
    found = by_key.unionByName(by_cut.select(by_key.columns)).select("unit", "token", "short", F.lit(1).alias("source"), "place", "word")
    if local is not None:
        beside = _keyed(local.select("unit", "word").distinct(), "word", "cut", script.cut_spellings).withColumnRenamed("cut", "token")
        beside = t.where("not short").join(beside, ["unit", "token"]).where("word <> token")
        found = found.unionByName(beside.select("unit", "token", "short", F.lit(0).alias("source"), F.lit(0).cast(lexicon.schema["place"].dataType).alias("place"), "word"))
    if counts is not None:
        found = found.join(counts.select("unit", "word", "n"), ["unit", "word"], "left")
    n = F.coalesce("n", F.lit(0)) if counts is not None else F.lit(0)
    pool = found.groupBy("unit", "token", "short").agg(F.array_sort(F.collect_set(F.struct("source", (-n).alias("less"), "place", "word"))).alias("p"))
    # the words of the best source, the most frequent first
    pool = pool.withColumn("p", F.filter("p", lambda x: x["source"] == F.get("p", F.lit(0))["source"]))
    first, second = F.get("p", F.lit(0)), F.get("p", F.lit(1))
    several = F.lit(counts is not None) & ~F.col("short") & ((first["less"] < second["less"]) | (first["source"] == 1))
    return pool.where((F.size("p") == 1) | several).select("unit", "token", first["word"].alias("fixed"))
