"""Summaries: majority values, sums that know what is missing, pivots and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def majority(df: DataFrame, key: str, value: str, order: str, floor: int = 3) -> DataFrame:
    """Each row with its key's most frequent value (the first seen on a tie) if ``floor`` rows have it; ``replaced``."""
    n = df.where(F.coalesce(F.col(value).cast("string"), F.lit("")) != "").groupBy(key, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("o"))
    top = n.groupBy(key).agg(F.max_by(F.struct(value, "n"), F.struct("n", -F.col("o"))).alias("m")).where(F.col("m.n") >= floor)
    out = df.join(top.select(key, F.col(f"m.{value}").alias("_m")), key, "left")
    out = out.withColumn("replaced", F.coalesce(~F.col(value).eqNullSafe(F.col("_m")) & F.col("_m").isNotNull(), F.lit(False)))
    return out.withColumn(value, F.coalesce("_m", value)).drop("_m")


def sum_with_gaps(df: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """Sums of the known values (null when none is), and ``verify`` where a member is unknown."""
    gaps = F.lit(False)
    for v in values:
        gaps = gaps | (F.col(f"_n_{v}") < F.col("_rows"))
    g = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(v).alias(v) for v in values], *[F.count(v).alias(f"_n_{v}") for v in values])
    return g.select(*key, *values, F.when(gaps, "verify").otherwise("").alias("match_check"))


def sum_supplements(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """Rows that repeat a key are added up and flagged."""
    return df.groupBy(*key).agg(F.sum(value).alias(value), (F.count(F.lit(1)) > 1).alias("multiple_summed"))


def usual_name(df: DataFrame, key: str, name: str) -> DataFrame:
    """The most frequent name; on a tie the longer, then the smaller one."""
    n = df.where(F.col(name).isNotNull()).groupBy(key, name).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(key).agg(F.min_by(name, F.struct((-F.col("n")).alias("a"), (-F.char_length(name)).alias("b"), name)).alias(name))


def part_list(df: DataFrame, key: str, part: str, flag: Column) -> DataFrame:
    """Parts in order as text, their number, and those that the flag marks."""
    p = F.collect_list(F.struct(F.col(part).alias("p"), flag.alias("f")))
    g = df.groupBy(key).agg(F.array_sort(p).alias("_p"))
    show = lambda a: F.array_join(F.transform(a, lambda x: x["p"].cast("string")), ", ")
    return g.select(key, show(F.col("_p")).alias("parts"), F.size("_p").alias("n_parts"), show(F.filter("_p", lambda x: x["f"])).alias("parts_to_check"))


def count_blocks(df: DataFrame, key: str, group: str, groups: list[str], measure: str, measures: list[str], value: str) -> DataFrame:
    """The long (group, measure) counts as one row of blocks, with a total per block; the values are given, not read."""
    cell = lambda g, m: F.sum(F.when((F.col(group) == g) & (F.col(measure) == m), F.col(value)))
    cols = [cell(g, m).alias(f"{g}_{m}") for g in groups for m in measures]
    totals = [F.sum(F.when(F.col(group) == g, F.col(value))).alias(f"{g}_total") for g in groups]
    return df.groupBy(key).agg(*cols, *totals)


def change_tally(changes: DataFrame, old: str, new: str, top: int = 40) -> DataFrame:
    """The most frequent changes: a report of ``top`` lines."""
    n = changes.where(~F.col(old).eqNullSafe(F.col(new))).groupBy(old, new).agg(F.count(F.lit(1)).alias("n"))
    return n.orderBy(F.desc("n"), old, new).limit(top)


def run_info(df: DataFrame, unit: str, part: str, flagged: Column) -> DataFrame:
    """The completion record of each unit, as JSON with one entry per part."""
    per = df.groupBy(unit, part).agg(F.count(F.lit(1)).alias("rows"), F.count_if(flagged).alias("flagged"))
    g = per.groupBy(unit).agg(F.sum("rows").alias("rows"), F.sum("flagged").alias("flagged"), F.array_sort(F.collect_list(F.struct(F.col(part), F.col("rows"), F.col("flagged")))).alias("per_part"))
    return g.select(unit, F.to_json(F.struct("rows", "flagged", "per_part")).alias("info"))
