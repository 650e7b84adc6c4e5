"""Ordered sequences: gaps, repair, runs and cutoffs. Windows are always partitioned by a unit of work."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..sources.shared import settled


def gap_after_last_known(value: str, unit: list[str], order: list[str]) -> Column:
    """True where a value is not one more than the last known value before it; the first known one never is."""
    before = F.last(value, ignorenulls=True).over(Window.partitionBy(*unit).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(F.col(value) != before + 1, F.lit(False))


def gap_after_previous(value: str, group: str, unit: list[str], order: list[str]) -> Column:
    """True where a value is not one more than that of the row just before it, if that row has one and the same group."""
    w = Window.partitionBy(*unit).orderBy(*order)
    return F.coalesce((F.lag(group).over(w) == F.col(group)) & (F.col(value) != F.lag(value).over(w) + 1), F.lit(False))


def repair_serials(df: DataFrame, read: str, unit: list[str], order: list[str], reach: int = 6, near: int = 4, votes: int = 3) -> DataFrame:
    """``fixed`` and ``corrected``: reads that break a sequence their neighbours agree on are overwritten.

    A read's offset is its value less its place. The neighbours' most frequent offset (on a tie the one met first in
    order) replaces a different one if ``votes`` neighbours within ``reach`` have it and, within ``near``, two on each
    side do (or as many as there are), three in all. Offsets are those read, so a repair never feeds another.
    """
    w = Window.partitionBy(*unit).orderBy(*order)
    d = df.withColumn("_k", F.row_number().over(w) - 1).withColumn("_m", F.count(F.lit(1)).over(Window.partitionBy(*unit)))
    d = d.withColumn("_o", F.col(read) - F.col("_k"))
    side = lambda a, b: F.collect_list(F.struct(F.col("_k"), F.col("_o"))).over(w.rowsBetween(a, b))
    d = d.withColumn("_around", F.filter(F.concat(side(-reach, -1), side(1, reach)), lambda x: x["_o"].isNotNull()))
    ranked = F.transform(F.array_distinct(F.transform("_around", lambda x: x["_o"])), lambda o: F.struct(
        F.size(F.filter("_around", lambda x: x["_o"] == o)).alias("n"), (-F.array_position(F.transform("_around", lambda x: x["_o"]), o)).alias("p"), o.alias("o")))
    d = d.withColumn("_top", F.array_max(ranked)).withColumn("_best", F.col("_top.o"))
    count = lambda a, b: F.size(F.filter("_around", lambda x: (x["_o"] == F.col("_best")) & x["_k"].between(F.col("_k") + a, F.col("_k") + b)))
    left, right = count(-near, -1), count(1, near)
    fix = (
        (F.col("_top.n") >= votes) & ~F.col("_o").eqNullSafe(F.col("_best")) & (left >= F.least(F.lit(2), F.col("_k")))
        & (right >= F.least(F.lit(2), F.col("_m") - 1 - F.col("_k"))) & (left + right >= 3) & (F.col("_best") + F.col("_k") >= 1)
    )
    d = d.withColumn("corrected", F.coalesce(fix, F.lit(False)))
    return d.withColumn("fixed", F.when(F.col("corrected"), F.col("_best") + F.col("_k")).otherwise(F.col(read))).drop("_k", "_m", "_o", "_around", "_top", "_best")


def islands(df: DataFrame, value: str, unit: list[str], gap: float = 1, least: int = 1) -> DataFrame:
    """Runs of values at most ``gap`` apart: ``lo, hi, n, middle``, those of ``least`` members or more."""
    w = Window.partitionBy(*unit).orderBy(value)
    new = F.coalesce((F.col(value) - F.lag(value).over(w) > gap).cast("int"), F.lit(1))
    d = df.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = d.groupBy(*unit, "_run").agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(F.lit(1)).alias("n"), F.floor(F.avg(value)).cast("long").alias("middle"))
    return runs.where(F.col("n") >= least).drop("_run")


def miss_cutoff(df: DataFrame, miss: str, unit: list[str], order: list[str], in_a_row: int = 3) -> DataFrame:
    """The rows up to the first that completes ``in_a_row`` misses, itself included."""
    w = Window.partitionBy(*unit).orderBy(*order)
    m = F.col(miss).cast("int")
    full = (F.sum(m).over(w.rowsBetween(1 - in_a_row, 0)) == in_a_row).cast("int")
    before = F.coalesce(F.sum("_full").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return df.withColumn("_full", full).withColumn("_before", before).where("_before = 0").drop("_full", "_before")


def first_n(df: DataFrame, unit: list[str], order: list, n: int) -> DataFrame:
    """The first ``n`` rows of each unit. Spark keeps n rows per unit and task before it shuffles."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*unit).orderBy(*order))).where(F.col("rank") <= n)


def largest_gap(df: DataFrame, value: str, unit: list[str], far: float) -> DataFrame:
    """The largest distance between neighbouring members, and whether it is more than ``far``."""
    w = Window.partitionBy(*unit).orderBy(value)
    g = df.withColumn("_g", F.col(value) - F.lag(value).over(w)).groupBy(*unit).agg(F.max("_g").alias("largest_gap"))
    return g.withColumn("match_check", F.when(F.col("largest_gap") > far, "verify").otherwise(""))


def carry_first(df: DataFrame, value: str, unit: list[str], order: list[str]) -> DataFrame:
    """The first value of the unit that is not null or empty, on every row (by a join, not a whole-unit window)."""
    v = df.where(F.coalesce(F.col(value), F.lit("")) != "").groupBy(*unit).agg(F.min_by(value, F.struct(*order)).alias(f"{value}_carried"))
    return df.join(v, unit, "left")


def numbered(df: DataFrame, unit: list[str], order: list[str], name: str) -> DataFrame:
    """``name``: the place, from 0, of each row in its unit by ``order``, however many rows a unit has.

    Rows are dealt out by ranges of (unit, order), numbered within a range, and moved up by the counts of the ranges before
    it. Null values come first; the place of rows that agree in unit and order is any of theirs.
    """
    d = df.withColumn("_tie", F.monotonically_increasing_id())
    d = settled(d.repartitionByRange(*unit, *order, "_tie").withColumn("_range", F.spark_partition_id()), "numbered")
    same = [F.col(u).eqNullSafe(F.col(f"_u{i}")) for i, u in enumerate(unit)]
    counts = d.groupBy(*[F.col(u).alias(f"_u{i}") for i, u in enumerate(unit)], F.col("_range").alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*[f"_u{i}" for i in range(len(unit))]).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    own = F.row_number().over(Window.partitionBy(*unit, "_range").orderBy(*order, "_tie")) - 1
    d = d.withColumn("_own", own).join(base, [*same, F.col("_range") == F.col("_r")])
    return d.withColumn(name, (F.col("_base") + F.col("_own")).cast("long")).select(*df.columns, name)


def chunk_fixed(df: DataFrame, unit: list[str], order: list[str], rows: int) -> DataFrame:
    """Chunk numbers from 1, of ``rows`` rows each, within the unit."""
    n = numbered(df, unit, order, "_place")
    return n.withColumn("chunk", (F.floor(F.col("_place") / rows) + 1).cast("int")).drop("_place")


def _in_order(df: DataFrame, unit: list[str], order: list[str], value: str, out: str, begin: Callable[[], object], step: Callable[[object, object], tuple[object, int]]) -> DataFrame:
    """``out``: what ``step`` makes of the state and the next value, row by row in the order of the unit, from ``begin()``.

    Units are what is distributed. A task holds a batch and the state, never a unit.
    """
    schema = StructType([*df.schema.fields, StructField(out, IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, begin()
        for b in batches:
            made = []
            for key, v in zip(zip(*(b.column(u).to_pylist() for u in unit), strict=True), b.column(value).to_pylist(), strict=True):
                if key != now:
                    now, state = key, begin()
                state, x = step(state, v)
                made.append(x)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.int32())], names=[*b.schema.names, out])

    return df.repartition(*unit).sortWithinPartitions(*unit, *order).mapInArrow(run, schema)


def chunk_at_boundaries(parts: DataFrame, unit: list[str], part: str, size: str, most: int) -> DataFrame:
    """Chunks that close once they hold ``most`` rows, always between parts: ``unit, part, size, chunk``.

    The running sum starts again with each chunk, so a unit is walked through in order; a part without a size counts 0.
    """

    def step(state, n):
        held, chunk = state
        held += n or 0
        return ((0, chunk + 1) if held >= most else (held, chunk)), chunk

    return _in_order(parts.select(*unit, part, size), unit, [part], size, "chunk", lambda: (0, 1), step)


def row_clusters(df: DataFrame, unit: list[str], y: str, x: str, height: float) -> DataFrame:
    """Reading order: boxes whose y is at most half a height from their row's first member share the row.

    The distance is to the first member and not to the neighbour, so a page is walked through in order.
    """

    def step(state, at):
        first, row = state
        return ((at, row + 1), row + 1) if first is None or at - first > height / 2 else (state, row)

    z = _in_order(df.select(*unit, y, x), unit, [y, x], y, "row", lambda: (None, 0), step)
    return z.withColumn("place", F.row_number().over(Window.partitionBy(*unit).orderBy("row", x, y)))


def classes_in_order(df: DataFrame, unit: list[str], order: list[str], label: str, classes: list[str], start: str, place: int = 4) -> DataFrame:
    """``class``: rows from the first one labelled ``start`` (or else from row ``place``, at most the last) to the first
    that is of the last class. A row without a label is of the class after that of the row before it, in the fixed order;
    the first row of ``start``.

    The class after the last known one, a step a row, is the last known one's number plus the distance from it, so no
    state is carried.
    """
    w = Window.partitionBy(*unit).orderBy(*order)
    whole = Window.partitionBy(*unit)
    number = F.array_position(F.array(*map(F.lit, classes)), F.col(label)) - 1
    d = df.withColumn("_i", F.row_number().over(w) - 1).withColumn("_k", F.when(F.coalesce(number, F.lit(-1)) >= 0, number))
    begin = F.coalesce(F.min(F.when(F.col(label) == start, F.col("_i"))).over(whole), F.least(F.lit(place), F.max("_i").over(whole)))
    d = d.withColumn("_begin", begin).where("_i >= _begin")
    known = F.last(F.when(F.col("_k").isNotNull(), F.struct("_k", "_i")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumn("_known", known)
    first = classes.index(start)
    now = F.coalesce(F.col("_known._k") + F.col("_i") - F.col("_known._i"), first + F.col("_i") - F.col("_begin"))
    d = d.withColumn("_now", F.least(now, F.lit(len(classes) - 1)).cast("int"))
    done = F.coalesce(F.max((F.col("_now") == len(classes) - 1).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    d = d.withColumn("_done", done).where("_done = 0").withColumn("class", F.get(F.array(*map(F.lit, classes)), F.col("_now")))
    return d.select(*df.columns, "class")


def reread_serials(cards: DataFrame, rereads: DataFrame, key: str, read: str, unit: list[str], order: list[str], least: float = 0.5) -> DataFrame:
    """``cards`` with ``read`` retried on evidence, ``reread``, and then repaired (``fixed``, ``corrected``).

    Where the sequence expects another number than was read, the first of the card's further readings (``key, ord, read,
    score``) that is the expected number, with a score of ``least`` or more, takes the place of the first reading.
    """
    expected = repair_serials(cards, read, unit, order).select(F.col(key).alias("_key"), F.col("fixed").alias("_want"))
    d = cards.join(expected, F.col(key) == F.col("_key")).drop("_key")
    redo = d.where(F.col("_want").isNotNull() & ~F.col("_want").eqNullSafe(F.col(read))).select(key, "_want")
    r = rereads.select(F.col(key), F.col(read).alias("_again"), "score")
    hit = r.join(redo, key).where((F.col("_again") == F.col("_want")) & (F.col("score") >= least)).select(key, F.lit(True).alias("reread")).distinct()
    d = d.join(hit, key, "left").withColumn("reread", F.coalesce("reread", F.lit(False)))
    d = d.withColumn(read, F.when(F.col("reread"), F.col("_want")).otherwise(F.col(read))).drop("_want")
    return repair_serials(d, read, unit, order)
