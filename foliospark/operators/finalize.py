"""The finishing chain of a chunk of rows: arbitration, canonical spellings, vocabulary; snapshot in, snapshot out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .readings import arbitrate
from .vocab import apply_corrections, build_vocabulary, canonical_spellings, corrections


def finalize(rows: DataFrame, vocabulary: DataFrame, key: str = "id", name: str = "name", other: str = "other", place: str = "place", enough: int = 4000) -> tuple[DataFrame, DataFrame]:
    """The finished rows and the next vocabulary.

    ``rows`` has ``key, name, name_score, other, other_score, place, confidence, reason``. The vocabulary that corrects is
    the one given plus this chunk's confident words; what is returned is a new table, so a run that is repeated from the
    same snapshot gives the same rows, and chunks may run in any order from one snapshot.
    """
    pairs = rows.select(F.col(key).alias("id"), F.col(name).alias("p"), F.col("name_score").alias("pc"), F.col(other).alias("t"), F.col("other_score").alias("tc"))
    chosen = arbitrate(pairs.where(F.coalesce("t", F.lit("")) != ""), vocabulary, 1.0).select(F.col("id").alias(key), F.col("text").alias("_text"), "use_t", "unsure")
    d = rows.join(chosen, key, "left").withColumn(name, F.coalesce("_text", name)).drop("_text")
    canon = canonical_spellings(d.where(F.coalesce(place, F.lit("")) != ""), place)
    d = d.join(canon.select(F.col("value").alias(place), "canon"), place, "left").withColumn(place, F.coalesce("canon", place)).drop("canon")
    sure = (F.col("confidence") >= 0.90) & ~F.coalesce(F.regexp_like("reason", F.lit("too_short|name_missing|vocab_fixed")), F.lit(False))
    after = build_vocabulary(d, [name], sure, vocabulary)
    d = apply_corrections(d, key, name, corrections(after, enough))
    more = F.concat_ws("|", F.nullif("reason", F.lit("")), F.when(F.col("vocab_fixed"), f"{name}_vocab_fixed"), F.when(F.col("unsure"), f"{name}_engine_pick"))
    return d.withColumn("reason", more), after
