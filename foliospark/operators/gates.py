"""Which rows, pages and readings go on: predicates and reducing joins before and after the costly reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import ascii_digits, is_id, repair_id

# The ink and stamp above which a card is read whole, and how a status letter stands before a serial.
MARKER_INK, STAMP_PIXELS = 8, 60
SERIAL_LETTER = r"^([ESRMQ])\s*0*([0-9]{1,6})$"
#: Least score and margin of each kind of template label.
ACCEPT = {"relation": (0.78, 0.07), "status": (0.63, 0.07), "gender": (0.68, 0.07)}
SHORT_NAME, RETRY_BELOW = 4, 0.60
STATUS = {
    "S": "shifted (स्थानांतरित)", "E": "dead (मृतक)", "R": "repeated (पुनरावृत्ति)", "M": "missing (लापता)", "Q": "ineligible (अयोग्य)", "#": "# (not in legend)",
}
RELATION = {"पिता": "father", "पति": "husband", "माता": "mother", "अन्य": "other"}


def first_and_last(pages: DataFrame, page: str, n_pages: str) -> DataFrame:
    """The first and the last page of each file; of a single page that one."""
    return pages.where((F.col(page) == 1) | (F.col(page) == F.col(n_pages)))


def is_valid_excerpt(valid: Column, n_pages: str) -> Column:
    """A valid file of one or two pages."""
    return valid & F.coalesce(F.col(n_pages).between(1, 2), F.lit(False))


def additions(cards: DataFrame, list_type: str = "list_type") -> DataFrame:
    """The cards of addition lists."""
    return cards.where(F.col(list_type) == "addition")


def worth_reading(ink: str, stamp: str, list_type: str, serial_text: str) -> Column:
    """True for cards that can be deleted ones: a marker, a stamp, an addition list, or a letter before the serial."""
    t = F.trim(F.regexp_replace(F.upper(F.coalesce(F.col(serial_text), F.lit(""))), "[^A-Z0-9 ]", ""))
    some = (F.col(ink) > MARKER_INK) | (F.col(stamp) > STAMP_PIXELS) | (F.col(list_type) == "addition")
    return F.coalesce(some, F.lit(False)) | F.regexp_like(t, F.lit(SERIAL_LETTER))


def candidates_only(jobs: DataFrame, cards: DataFrame, key: list[str], worth: Column) -> DataFrame:
    """The reading jobs of the cards that are worth it: a cheap predicate, then a semi-join."""
    return jobs.join(cards.where(worth).select(*key).distinct(), key, "left_semi")


def accepted_row(first_cell: str, id_cell: str, recognised: str) -> Column:
    """A row of a table counts if its first cell is a number, in either script, or, where it was recognised from pixels, if
    the second is an identifier."""
    number = F.regexp_like(ascii_digits(F.trim(F.coalesce(F.col(first_cell), F.lit("")))), F.lit("^[0-9]+$"))
    return number | (F.coalesce(F.col(recognised), F.lit(False)) & F.coalesce(is_id(repair_id(id_cell), slashed=True), F.lit(False)))


def without_twins(boxes: DataFrame, unit: list[str], x: str, y: str, near: float) -> DataFrame:
    """Boxes without those that lie within ``near`` in both directions of one kept before them, by y, then x.

    What is kept depends on what was kept before, so a page's boxes, few, are folded in its row.
    """
    items = boxes.groupBy(*unit).agg(F.array_sort(F.collect_list(F.struct(F.col(y).alias("y"), F.col(x).alias("x"), F.struct(*boxes.columns).alias("row")))).alias("b"))
    close = lambda a, b: (F.abs(a["x"] - b["x"]) < near) & (F.abs(a["y"] - b["y"]) < near)
    none = F.filter("b", lambda _: F.lit(False))
    kept = F.aggregate("b", none, lambda out, z: F.when(F.exists(out, lambda o: close(o, z)), out).otherwise(F.concat(out, F.array(z))))
    return items.select(F.explode(kept).alias("k")).select("k.row.*")


def meaning(code: str, table: dict[str, str], other: str = "") -> Column:
    """What a code stands for; ``other`` for one that is not in the table."""
    out = F.lit(other)
    for k, v in table.items():
        out = F.when(F.col(code) == k, F.lit(v)).otherwise(out)
    return out


def with_period(cards: DataFrame, headers: DataFrame, key: list[str], order: str) -> DataFrame:
    """Cards of addition lists with the period printed in the heading of their page (``start, end``); of several headings
    the first. Other cards, and pages without one, get empty texts."""
    one = headers.groupBy(*key).agg(F.min_by(F.struct("start", "end"), order).alias("_p"))
    d = cards.join(one, key, "left")
    mine = lambda c: F.when(F.col("list_type") == "addition", F.coalesce(F.col(f"_p.{c}"), F.lit(""))).otherwise("")
    return d.select(*cards.columns, mine("start").alias("start"), mine("end").alias("end"))


def judged(kind: str, label: str, score: str, margin: str) -> Column:
    """``value, unsure`` of a template's label: it is kept even below the thresholds of its kind, and flagged then; a status
    without any label is ``?``."""
    least, lead = ACCEPT[kind]
    value = F.coalesce(F.nullif(F.col(label), F.lit("")), F.lit("?" if kind == "status" else ""))
    sure = F.coalesce((F.col(score) >= least) & (F.col(margin) >= lead), F.lit(False)) & (F.coalesce(F.col(label), F.lit("")) != "")
    return F.struct(value.alias("value"), (~sure).alias("unsure"))


def needs_another_cut(text: str, score: str, bad_start: Column) -> Column:
    """A name that looks cut wrongly: too short, badly read, or starting as no word does."""
    letters = F.length(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit(" "), F.lit("")))
    return (letters < SHORT_NAME) | (F.coalesce(F.col(score), F.lit(0.0)) < RETRY_BELOW) | F.coalesce(bad_start, F.lit(False))


def retried(readings: DataFrame, again: DataFrame, key: list[str], weak: Column) -> DataFrame:
    """All readings, with the further ones of those fields alone that are weak: the best of all is for ``readings.pick``."""
    ask = readings.where(weak).select(*key).distinct()
    return readings.unionByName(again.join(ask, key, "left_semi").select(readings.columns))


def first_available(readings: DataFrame, key: list[str], rank: str) -> DataFrame:
    """Of several readers' readings those of the first reader, by rank, that read the field at all."""
    least = F.min(F.when(F.coalesce(F.col("text"), F.lit("")) != "", F.col(rank))).over(Window.partitionBy(*key))
    return readings.withColumn("_r", least).where(F.col(rank) == F.col("_r")).drop("_r")


def second_reads(cells: DataFrame, readings: DataFrame, key: list[str], sure: float = 0.9) -> DataFrame:
    """Numeric cells: the first reader's readings, and the others' only for cells that it could not read or is unsure of.

    ``cells`` has the key, ``readings`` the key, ``model, text, score``; a reading without digits is none.
    """
    number = F.regexp_replace(ascii_digits("text"), "[^0-9]", "")
    r = readings.withColumn("value", F.nullif(number, F.lit("")).try_cast("bigint"))
    ok = r.where((F.col("model") == 0) & F.col("value").isNotNull() & (F.col("score") >= sure)).select(*key).distinct()
    others = r.where("model > 0").join(ok, key, "left_anti")
    return cells.join(r.where("model = 0").unionByName(others), key).where("value is not null").select(*key, "model", "value", "score")


def by_number(df: DataFrame, *keys: str) -> DataFrame:
    """Sorted by keys that are numbers written as text; those that are not come last, by their text."""
    order = [o for k in keys for o in (F.col(k).try_cast("bigint").asc_nulls_last(), F.col(k).asc())]
    return df.orderBy(*order)


def distinct_in_order(values: DataFrame, unit: list[str], value: str, order: str) -> DataFrame:
    """The distinct values of a unit in the order of their first occurrence, as an array."""
    first = values.groupBy(*unit, value).agg(F.min(order).alias("_o"))
    return first.groupBy(*unit).agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", value))), lambda z: z[value]).alias("values"))


def file_of(ac: str, part: str, pattern: str) -> Column:
    """The path of a part, from its keys; ``pattern`` has ``%1$s`` for the unit and ``%2$s`` for the part."""
    return F.format_string(pattern, F.col(ac).cast("string"), F.col(part).cast("string"))


def reservation(tokens: str) -> Column:
    """``name, reserved`` of the words of a constituency's line after its number: a leading dash goes, the words from the
    first that opens a bracket are the reservation; without a bracket the last of three words or more is, if it is one."""
    t = F.col(tokens)
    t = F.when(F.get(t, F.lit(0)).isin(*DASHES), F.slice(t, 2, F.greatest(F.size(t), F.lit(1)))).otherwise(t)
    opens = F.array_position(F.transform(t, lambda w: F.regexp_like(w, F.lit("^[(（]"))), True)
    last = F.element_at(t, -1)
    bare = (opens == 0) & (F.size(t) >= 3) & F.regexp_like(last, F.lit("सामा|अ\\.|अ०|अजा|अजजा"))
    cut = F.when(opens > 0, opens).when(bare, F.size(t).cast("bigint")).otherwise(F.size(t).cast("bigint") + 1).cast("int")
    strip = lambda a, chars: F.btrim(F.array_join(a, " "), F.lit(chars))
    name = strip(F.slice(t, 1, F.greatest(cut - 1, F.lit(0))), " :-()（）")
    kept = strip(F.slice(t, F.greatest(cut, F.lit(1)), F.greatest(F.size(t) - cut + 1, F.lit(0))), " ()（）")
    return F.struct(F.coalesce(name, F.lit("")).alias("name"), F.coalesce(kept, F.lit("")).alias("reserved"))


#: What a dash is read as; the size below which any mark is one.
DASHES = ("-", "–", "—", "_", "", ".", "।")


def is_dash(text: str, width: str, height: str, scale: float = 1.0) -> Column:
    """A dash by what was read, or by its size."""
    return F.coalesce(F.col(text), F.lit("")).isin(*DASHES) | ((F.col(width) < 11 * scale) & (F.col(height) < 7 * scale))
