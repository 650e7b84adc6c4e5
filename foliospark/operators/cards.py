"""Fields of a card: house numbers from several readings, status, and checks against other sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import ascii_digits, flags, house_class, house_text

OM = "ॐ"
STATUS_CODES = ("E", "S", "R", "M", "Q")


def _ends_latin(t: Column) -> Column:
    return F.regexp_like(t, F.lit("[A-Za-z]$"))


def resolve_house(readings: DataFrame, key: list[str]) -> DataFrame:
    """``value, score, why`` for each card from ``text, score, source`` (``hi`` or ``en``), ``ord``.

    Readings of the script's own digits (0.6 or more) silence the Latin reader; so do its readings of a number with a
    letter (0.5 or more) where the Latin one gives the same digits or two more. A stray symbol is repaired to a digit at
    0.8 of the weight, other junk costs 0.4 of it. Agreement adds 0.1. Without a usable reading the best raw one stays at
    half its score, flagged. A card has a handful of readings, folded in its row.
    """
    raw = ascii_digits("text")
    t = house_text("text")
    om = F.contains(t, F.lit(OM))
    fixed = F.when(om, F.trim(F.regexp_replace(F.replace(t, F.lit(OM), F.when(F.regexp_like(t, F.lit("[0-9]")), "7").otherwise("0")), r"\s+", " "))).otherwise(t)
    junk = F.length(F.regexp_replace(F.regexp_replace(raw, r"[\s\"'`.,:;|_]", ""), r"[0-9A-Za-zऀ-ॿ/\-]", "")) > 0
    d = readings.where(F.coalesce(F.col("text"), F.lit("")) != "").select(
        *key, "ord", "source", F.coalesce("score", F.lit(0.0)).alias("score"), fixed.alias("t"), om.alias("om"), junk.alias("junk"), F.regexp_like("text", F.lit("[०-९]")).alias("own_digits"),
    ).withColumn("k", house_class("t"))
    d = d.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("ord", "source", "score", "t", "om", "junk", "own_digits", "k"))).alias("r"))
    silent = F.exists("r", lambda x: (x["source"] == "hi") & x["own_digits"] & ~x["om"] & (x["score"] >= 0.6) & (x["k"]["kind"] == "digits"))
    d = d.withColumn("r", F.filter("r", lambda x: ~(silent & (x["source"] == "en"))))
    lettered = F.filter("r", lambda x: (x["source"] == "hi") & ~x["om"] & (x["score"] >= 0.5) & (x["k"]["kind"] == "digit+letter") & ~_ends_latin(x["t"]))
    d = d.withColumn("heads", F.transform(lettered, lambda x: F.regexp_extract(x["t"], "^([0-9]+)", 1)))
    repeats = lambda x: F.exists("heads", lambda h: F.startswith(x["t"], h) & (F.length(x["t"]) <= F.length(h) + 2))
    usable = F.filter("r", lambda x: (x["k"]["weight"] > 0) & ~((x["source"] == "en") & F.regexp_like(x["t"], F.lit("^[0-9]+$")) & repeats(x)))
    weigh = lambda x: x["k"]["weight"] * F.when(x["om"], 0.8).otherwise(1.0) * F.when(x["junk"], 0.6).otherwise(1.0) * x["score"]
    d = d.withColumn("c", F.transform(usable, lambda x: F.struct(weigh(x).alias("s"), (-x["ord"]).alias("o"), x["t"].alias("t"), x["om"].alias("om"))))
    same = lambda x: F.size(F.filter("c", lambda y: y["t"] == x["t"])) > 1
    d = d.withColumn("c", F.transform("c", lambda x: F.struct((x["s"] + F.when(same(x), 0.1).otherwise(0.0)).alias("s"), x["o"].alias("o"), x["t"].alias("t"), x["om"].alias("om"))))
    d = d.withColumn("best", F.array_max("c")).withColumn("raw", F.array_max(F.transform(F.filter("r", lambda x: x["t"] != ""), lambda x: F.struct(x["score"].alias("s"), x["t"].alias("t")))))
    digits = lambda c: F.regexp_replace(c, "[^0-9]", "")
    differs = F.exists("c", lambda x: (x["t"] != F.col("best.t")) & ~digits(x["t"]).isin("") & (digits(x["t"]) != digits(F.col("best.t"))) & (x["s"] >= 0.5 * F.col("best.s")))
    some = F.col("best").isNotNull()
    why = flags(
        ("house_no_unclear", ~some & F.col("raw").isNotNull()), ("house_no_symbol_fixed", some & F.col("best.om")),
        ("house_no_readings_disagree", some & (digits(F.col("best.t")) != "") & F.coalesce(differs, F.lit(False))),
    )
    return d.select(*key, F.coalesce(F.col("best.t"), F.col("raw.t"), F.lit("")).alias("value"), F.coalesce(F.least(F.col("best.s"), F.lit(1.0)), F.col("raw.s") * 0.5, F.lit(0.0)).alias("score"), F.concat_ws("|", why).alias("why"))


def derive_status(marker: str, letter: str, letter_serial: str, serial: str, glyph: str, glyph_score: str, stamp: str) -> Column:
    """``code, deleted, why``: the marker's code, else a letter read before the final serial, else a detached glyph of
    0.5 or more, else ``?`` for a stamp alone. ``#`` and ``?`` are not deletions by themselves."""
    code = F.coalesce(
        F.nullif(F.col(marker), F.lit("")),
        F.when(F.col(letter).isin(*STATUS_CODES) & (F.col(letter_serial) == F.col(serial)), F.col(letter)),
        F.when(F.col(glyph).isin(*STATUS_CODES) & (F.col(glyph_score) >= 0.5), F.col(glyph)),
        F.when(F.col(stamp) > 60, F.lit("?")), F.lit(""),
    )
    stamped = F.coalesce(F.col(stamp) > 60, F.lit(False))
    why = flags(("status_letter_unclear", code == "?"), ("deleted_without_status_code", stamped & ~code.isin(*STATUS_CODES)))
    return F.struct(code.alias("code"), (stamped | code.isin(*STATUS_CODES)).alias("deleted"), F.concat_ws("|", why).alias("why"))


def cross_source(page: dict[str, str], net: dict[str, str], total: str, last_serial: str, keys: list[tuple[str, str, str]], required: list[str]) -> Column:
    """Differences between what two pages, the serials and the file name say; absent values are not compared."""
    differs = lambda a, b: F.coalesce(F.col(a) != F.col(b), F.lit(False))
    pairs = [(f"{page[k]}_differs_from_{net[k]}", differs(page[k], net[k])) for k in page]
    pairs += [("total_exceeds_last_serial", F.coalesce(F.col(total) > F.col(last_serial), F.lit(False)))]
    pairs += [(name, differs(a, b)) for name, a, b in keys]
    pairs += [(f"missing_{c}", F.coalesce(F.col(c).cast("string"), F.lit("")) == "") for c in required]
    return F.concat_ws(";", flags(*pairs))


def ink(values: Column, begin: int, size: int, below: float, scale: float = 1.0) -> Column:
    """How many values of a window are below a level, per scaled unit of area (half to even)."""
    n = F.aggregate(F.slice(values, begin, size), F.lit(0), lambda a, x: a + F.when(x < below, 1).otherwise(0))
    return F.bround(n / F.lit(scale * scale)).cast("int")


def first_pass(passes: str, low: int = 4, high: int = 5) -> Column:
    """Of results of ever coarser passes the first of a fitting size, else the first."""
    fit = F.filter(passes, lambda p: F.size(p).between(low, high))
    return F.coalesce(F.get(fit, F.lit(0)), F.get(F.col(passes), F.lit(0)))


def spans_in_cells(spans: DataFrame, cells: DataFrame, page: str, size: float, slack: float = 1.0) -> DataFrame:
    """``span_id, cell_id``: spans whose centre lies in a cell, within ``slack``. Cells are entered in the squares of
    ``size`` that they touch, so spans meet them by equality of page and square."""
    near = lambda lo, hi: F.sequence(F.floor((F.col(lo) - slack) / size), F.floor((F.col(hi) + slack) / size))
    c = cells.select(page, "cell_id", "x0", "x1", "y0", "y1").withColumn("bx", F.explode(near("x0", "x1")))
    c = c.withColumn("by", F.explode(near("y0", "y1")))
    s = spans.select(page, "span_id", ((F.col("x0") + F.col("x1")) / 2).alias("cx"), ((F.col("y0") + F.col("y1")) / 2).alias("cy"))
    s = s.withColumn("bx", F.floor(F.col("cx") / size)).withColumn("by", F.floor(F.col("cy") / size))
    inside = F.col("cx").between(F.col("x0") - slack, F.col("x1") + slack) & F.col("cy").between(F.col("y0") - slack, F.col("y1") + slack)
    return s.join(c, [page, "bx", "by"]).where(inside).select(page, "span_id", "cell_id")
