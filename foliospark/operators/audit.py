"""Completeness audits, current state and incremental tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def expand_manifest(manifest: DataFrame, key: str, count: str, part: str = "part") -> DataFrame:
    """One row per expected part 1..count; null, zero and negative counts expect nothing."""
    return manifest.where(F.col(count) >= 1).select(key, F.explode(F.sequence(F.lit(1), F.col(count).cast("int"))).alias(part))


def missing_parts(expected: DataFrame, inventory: DataFrame, on: list[str], valid: str | None = None) -> DataFrame:
    """Expected parts without a valid one in the inventory: ``missing``, or ``invalid_or_corrupt`` when one is there."""
    ok = F.max(F.col(valid).cast("int")) if valid else F.lit(1)
    have = inventory.groupBy(*on).agg(ok.alias("_ok"))
    reason = F.when(F.col("_ok").isNull(), "missing").when(F.col("_ok") == 0, "invalid_or_corrupt")
    return expected.join(have, on, "left").withColumn("reason", reason).where("reason is not null").drop("_ok")


def extra_parts(inventory: DataFrame, manifest: DataFrame, key: str, part: str, count: str) -> DataFrame:
    """Parts beyond the count that the manifest has for their key."""
    return inventory.select(key, part).distinct().join(manifest.select(key, count), key).where(F.col(part) > F.col(count))


def fill_counts(counts: DataFrame, overrides: DataFrame, key: str, value: str) -> DataFrame:
    """Overrides fill the keys without a value and add keys; a value that is there stays."""
    o = overrides.select(key, F.col(value).alias("_o"))
    return counts.select(key, value).join(o, key, "full").select(key, F.coalesce(value, "_o").alias(value), (F.col(value).isNull() & F.col("_o").isNotNull()).alias("filled"))


def upsert_state(state: DataFrame, run: DataFrame, key: list[str], bad: tuple[str, ...], columns: list[str], status: str = "status") -> DataFrame:
    """Current state after a run: bad results are inserted or refreshed, others resolve their key, unseen keys stay."""
    r = run.select(*key, F.lit(True).alias("_seen"), *[F.col(c).alias(f"_{c}") for c in columns])
    both = state.select(*key, *columns).join(r, key, "full")
    keep = F.col("_seen").isNull() | F.col(f"_{status}").isin(*bad)
    change = F.when(F.col("_seen").isNull(), "unchanged").when(F.col(status).isNull(), "new").otherwise("updated")
    return both.where(keep).select(*key, *[F.when(F.col("_seen"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in columns], change.alias("change"))


def latest(events: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``; combined before it is shuffled, unlike a window."""
    rest = [c for c in events.columns if c not in key]
    top = events.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return top.select(*key, "_r.*")


def todo(wanted: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """What is wanted and not done; null keys are never done."""
    return wanted.join(done.select(*key), key, "left_anti")


def replace_keys(table: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """The table without the keys of the batch, then the batch."""
    return table.join(batch.select(*key).distinct(), key, "left_anti").unionByName(batch)


def bag_union(a: DataFrame, b: DataFrame, key: str, n: str) -> DataFrame:
    """Counts of both added up."""
    return a.select(key, n).unionByName(b.select(key, n)).groupBy(key).agg(F.sum(n).alias(n))


def completeness(expected: DataFrame, inventory: DataFrame, unit: str, on: list[str], by: str) -> DataFrame:
    """Expected, found and complete units for each value of ``by`` and overall (null)."""
    got = expected.join(inventory.select(*on).distinct().withColumn("_f", F.lit(1)), on, "left")
    units = got.groupBy(by, unit).agg(F.count(F.lit(1)).alias("expected"), F.count("_f").alias("found"))
    return units.rollup(by).agg(
        F.sum("expected").alias("expected"), F.sum("found").alias("found"), F.sum(F.col("expected") - F.col("found")).alias("missing"),
        F.count_if(F.col("expected") == F.col("found")).alias("complete_units"), F.count_if(F.col("expected") > F.col("found")).alias("incomplete_units"),
        F.grouping(by).cast("int").alias("is_total"),
    )


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """All rows of keys that occur more than once; counts are joined back rather than windowed, so a hot key spreads."""
    n = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_same")).where("n_same > 1")
    return df.join(n, key)


def run_summary(run: DataFrame, status: str = "status") -> DataFrame:
    return run.groupBy(status).agg(F.count(F.lit(1)).alias("n"))
