"""Lines, grids, words and glyphs of pages, from tables of dark pixels, spans and boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .sequence import islands, row_clusters


def profile(pixels: DataFrame, unit: list[str], axis: str) -> DataFrame:
    """How many dark pixels (``x, y`` of each) a row or column of a page has: ``axis, n``."""
    return pixels.groupBy(*unit, axis).agg(F.count(F.lit(1)).alias("n"))


def ruled_lines(pixels: DataFrame, unit: list[str], axis: str, across: float, share: float, gap: float = 1) -> DataFrame:
    """``unit, lo, hi, n, middle``: rows or columns dark over ``share`` of the width ``across``, neighbours together."""
    full = profile(pixels, unit, axis).where(F.col("n") >= share * across)
    return islands(full.select(*unit, axis), axis, unit, gap)


def grid(verticals: DataFrame, horizontals: DataFrame, unit: list[str], columns: int = 10, share_x: float = 0.25, share_y: float = 0.5) -> DataFrame:
    """``unit, xs, ys``: the line places of pages that hold a ruled table of so many columns, with two rows lines or more.

    The tables have the dark pixels (``x, y``) of vertical and of horizontal strokes. A line is where a profile is above a
    share of its maximum, over places at most four apart; its place is their mean.
    """

    def places(pixels: DataFrame, axis: str, share: float, out: str) -> DataFrame:
        p = profile(pixels, unit, axis)
        high = p.join(p.groupBy(*unit).agg(F.max("n").alias("top")), unit).where(F.col("n") > share * F.col("top"))
        lines = islands(high.select(*unit, axis), axis, unit, 4)
        return lines.groupBy(*unit).agg(F.array_sort(F.collect_list("middle")).alias(out))

    both = places(verticals, "x", share_x, "xs").join(places(horizontals, "y", share_y, "ys"), unit)
    return both.where((F.size("xs") == columns + 1) & (F.size("ys") >= 2))


def words_of_line(ink: DataFrame, unit: list[str], x: str, scale: float = 1.0, gap: float = 3.0, least: int = 2) -> DataFrame:
    """The words of a text line as runs of its inked columns: ``word`` from 1, ``x0, x1`` (exclusive). Words are cut where
    more than ``gap`` scaled columns, ``least`` at any rate, are empty."""
    runs = islands(ink.select(*unit, x).distinct(), x, unit, max(least, round(gap * scale)))
    order = F.row_number().over(Window.partitionBy(*unit).orderBy("lo"))
    return runs.select(*unit, order.alias("word"), F.col("lo").alias("x0"), (F.col("hi") + 1).alias("x1"))


def number_first(words: DataFrame, unit: list[str], scale: float = 1.0, among: int = 4) -> DataFrame:
    """Words (``word, x0, x1, height``) of lines that begin with a number and a dash: what stands before the first dash, one
    of the second to fifth words by its size, becomes one word. Without a dash nothing changes."""
    dash = (F.col("word") > 1) & (F.col("word") <= among + 1) & (F.col("x1") - F.col("x0") < 11 * scale) & (F.col("height") < 7 * scale)
    at = F.min(F.when(dash, F.col("word"))).over(Window.partitionBy(*unit))
    d = words.withColumn("_w", F.when(F.col("word") < at, F.lit(1)).otherwise(F.col("word")))
    d = d.groupBy(*unit, "_w").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.max("height").alias("height"))
    return d.select(*unit, F.row_number().over(Window.partitionBy(*unit).orderBy("_w")).alias("word"), "x0", "x1", "height")


def edge_word(words: DataFrame, unit: list[str], last: bool = False) -> DataFrame:
    """The first or the last word of each line."""
    pick = F.max_by if last else F.min_by
    return words.groupBy(*unit).agg(pick(F.struct("x0", "x1"), "x0").alias("w")).select(*unit, "w.x0", "w.x1")


def serial_glyph(columns: DataFrame, unit: list[str], height: str, scale: float = 1.0) -> DataFrame:
    """``unit, x0, x1``: the narrow glyph that stands before the digits of a serial, where there is one.

    ``columns`` has ``x`` and ``rows``, the number of inked rows in the column's run. A thin run over most of the height is a
    border and not a glyph. The first run is the glyph if it is 4 to 10 wide and 3.5 or more before the next, scaled.
    """
    w = Window.partitionBy(*unit).orderBy("x")
    new = F.coalesce((F.col("x") - F.lag("x").over(w) > 1).cast("int"), F.lit(1))
    d = columns.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = d.groupBy(*unit, "_run").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.max("rows").alias("rows"), F.first(height).alias("h"))
    border = (F.col("x1") - F.col("x0") + 1 <= max(2, round(2 * scale))) & (F.col("rows") > 0.8 * F.col("h"))
    order = Window.partitionBy(*unit).orderBy("x0")
    runs = runs.where(~border).withColumn("_i", F.row_number().over(order)).withColumn("_next", F.lead("x0").over(order))
    wide, apart = (F.col("x1") - F.col("x0") + 1) / scale, (F.col("_next") - F.col("x1") - 1) / scale
    return runs.where((F.col("_i") == 1) & wide.between(4, 10) & (apart >= 3.5)).select(*unit, "x0", "x1")


def text_lines(rows: DataFrame, unit: list[str], y: str, n: str, scale: float = 1.0, gap: float = 1.0, least: float = 4.0, tall: float = 18.0, rounds: int = 4) -> DataFrame:
    """``unit, y0, y1, middle``: bands of inked rows (``y, n``), those lower than ``least`` left out; a band taller than ``tall``
    is split at its thinnest row, away from its ends, again and again (``rounds`` times at most, each halving what is left)."""
    bands = islands(rows.select(*unit, y), y, unit, gap * scale).where(F.col("hi") - F.col("lo") >= least * scale).select(*unit, F.col("lo").cast("double").alias("y0"), F.col("hi").cast("double").alias("y1"))
    ink = rows.select(*[F.col(u).alias(f"_{u}") for u in unit], F.col(y).cast("double").alias("_y"), F.col(n).alias("_n"))
    same = [F.col(u) == F.col(f"_{u}") for u in unit]
    margin = lambda k: float(round(k * scale))
    for _ in range(rounds):
        high = bands.where((F.col("y1") - F.col("y0") > tall * scale) & (F.col("y1") - margin(7) > F.col("y0") + margin(8)))
        inside = high.join(ink, [*same, F.col("_y") >= F.col("y0") + margin(8), F.col("_y") < F.col("y1") - margin(7)])
        thin = inside.groupBy(*unit, "y0", "y1").agg(F.min_by("_y", F.struct("_n", "_y")).alias("at"))
        halves = thin.select(*unit, F.explode(F.array(F.struct(F.col("y0"), (F.col("at") - 1).alias("y1")), F.struct((F.col("at") + 1).alias("y0"), F.col("y1")))).alias("h")).select(*unit, "h.y0", "h.y1")
        bands = bands.join(thin.select(*unit, "y0", "y1"), [*unit, "y0", "y1"], "left_anti").unionByName(halves)
    return bands.select(*unit, "y0", "y1", F.floor((F.col("y0") + F.col("y1")) / 2).cast("long").alias("middle"))


def header_lines(spans: DataFrame, tables: DataFrame, page: str, near: float = 5.0) -> DataFrame:
    """The lines of text above a page's table: ``page, row, text``, spans (``x0, x1, y0, y1, text``) joined left to right; spans
    whose tops are at most ``near`` apart share a line. Pages without a table have none. ``tables`` has ``page, top``.
    """
    above = spans.join(tables.select(page, "top"), page).where(F.col("y1") <= F.col("top") + 1)
    rows = row_clusters(above.select(page, "y0", "x0").distinct(), [page], "y0", "x0", 2 * near).select(page, "y0", "x0", "row")
    return joined(above.join(rows, [page, "y0", "x0"]), [page, "row"])


def joined(spans: DataFrame, line: list[str], touch: float = 1.0) -> DataFrame:
    """``line, text``: the spans of a line from left to right; those less than ``touch`` apart without a space between."""
    w = Window.partitionBy(*line).orderBy("x0", "x1", "text")
    put = F.when(F.coalesce(F.col("x0") - F.lag("x1").over(w) < touch, F.lit(True)), "").otherwise(" ")
    d = spans.withColumn("_t", F.concat(put, "text")).groupBy(*line).agg(F.array_sort(F.collect_list(F.struct("x0", "x1", "text", "_t"))).alias("_s"))
    whole = F.array_join(F.transform("_s", lambda z: z["_t"]), "")
    return d.select(*line, F.trim(F.regexp_replace(whole, r"\s+", " ")).alias("text"))


def largest_table(tables: DataFrame, page: str, n_columns: str, n_rows: str, columns: int = 10) -> DataFrame:
    """Of a page's tables with so many columns the one with the most rows, the first of these."""
    t = tables.where(F.col(n_columns) == columns)
    return t.groupBy(page).agg(F.max_by(F.struct(*[c for c in t.columns if c != page]), F.struct(n_rows, -F.col("table_id"))).alias("t")).select(page, "t.*")


def same_images(before: DataFrame, after: DataFrame, file: str, page: str, pixels: str, shape: list[str]) -> DataFrame:
    """``file, same``: whether two renderings have the same pages with the same shape and pixels. Pixels are compared by
    SHA-256, so that a page costs a row."""
    digest = lambda d, tag: d.select(file, page, F.struct(*shape, F.sha2(F.col(pixels), 256).alias("sha")).alias(tag))
    both = digest(before, "a").join(digest(after, "b"), [file, page], "full")
    return both.groupBy(file).agg(F.bool_and(F.col("a").eqNullSafe(F.col("b"))).alias("same"))


def stretch(values: DataFrame, unit: list[str], value: str, low: float = 0.003) -> DataFrame:
    """``value`` moved and scaled so that the low percentile of its unit is 0 and the maximum 255 (clipped)."""
    ends = values.groupBy(*unit).agg(F.percentile(value, F.lit(low)).alias("_lo"), F.max(value).alias("_hi"))
    d = values.join(ends, unit)
    scaled = (F.col(value) - F.col("_lo")) * 255.0 / F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1e-9))
    return d.withColumn("stretched", F.greatest(F.lit(0.0), F.least(F.lit(255.0), scaled))).drop("_lo", "_hi")


def cell_of(value: str, lines: DataFrame, values: DataFrame, unit: list[str], reach: float) -> DataFrame:
    """Each value with the nearest line of its unit, the smaller on a tie, null beyond ``reach``.

    Both sides are entered in bands as wide as the reach, and meet by equality of unit and neighbouring band, so no value
    sees all lines.
    """
    band = lambda c: F.floor(F.col(c) / reach)
    at = lines.select(*unit, F.col("line").cast("double").alias("_line")).distinct()
    at = at.withColumn("_band", F.explode(F.array(band("_line") - 1, band("_line"), band("_line") + 1)))
    d = values.withColumn("_id", F.monotonically_increasing_id()).withColumn("_band", band(value))
    gap = F.abs(F.col("_line") - F.col(value))
    near = d.join(at, [*unit, "_band"]).where(gap <= reach).groupBy("_id").agg(F.min(F.struct(gap.alias("d"), "_line"))["_line"].alias("snapped"))
    return d.join(near, "_id", "left").select(*values.columns, "snapped")


def scaled(n: Column | float, scale: Column | float) -> Column:
    """A length of the reference layout at a page's scale, half to even."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.bround(lit(n) * lit(scale)).cast("int")
