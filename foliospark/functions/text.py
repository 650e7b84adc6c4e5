"""Column functions: identifiers, digits, dates and labels as Catalyst expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

#: Devanagari digits, and the letters that readers take for digits or digits for letters.
DEVANAGARI_DIGITS, ASCII_DIGITS = "०१२३४५६७८९", "0123456789"
ID_LETTERS = ("0158264", "OISBZGA")
ID_DIGITS = ("OILSBZGDQ", "011582600")
SERIAL_LOOKALIKES = ("OIL|", "0111")
COUNT_LOOKALIKES = ("OoQDlI|iSsBZ", "000011115582")


def lit(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ascii_digits(c) -> Column:
    return F.translate(lit(c), DEVANAGARI_DIGITS, ASCII_DIGITS)


def repair_id(c) -> Column:
    """Upper-cased letters and digits; of ten, the first three become letters and the last seven digits."""
    t = F.regexp_replace(F.upper(lit(c)), "[^A-Z0-9]", "")
    fixed = F.concat(F.translate(F.substring(t, 1, 3), *ID_LETTERS), F.translate(F.substring(t, 4, 7), *ID_DIGITS))
    return F.when(F.length(t) == 10, fixed).otherwise(t)


def repair_slashed_id(c) -> Column:
    """Identifiers of the older form, letters and three numbers between slashes, keep their slashes."""
    t = F.regexp_replace(F.upper(lit(c)), r"\s+", "")
    return F.when(F.regexp_like(t, F.lit(r"^[A-Z]{2}/[0-9]+/[0-9]+/[0-9]+$")), t).otherwise(repair_id(c))


def is_id(c, slashed: bool = False) -> Column:
    pattern = r"^[A-Z]{3}[0-9]{7}$" + (r"|^[A-Z]{2}/[0-9]+/[0-9]+/[0-9]+$" if slashed else "")
    return F.coalesce(F.regexp_like(lit(c), F.lit(pattern)), F.lit(False))


def strip_label(c, label: str = r"^[^:]{0,20}:") -> Column:
    """Without a leaked label at the start and the punctuation after it."""
    return F.regexp_replace(F.regexp_replace(lit(c), label, ""), r"^[\s:;.,\-]+", "")


def serial_number(c) -> Column:
    """The digits of a serial reading as a number, null without digits (or with too many for one)."""
    return F.regexp_replace(F.translate(F.upper(lit(c)), *SERIAL_LOOKALIKES), "[^0-9]", "").try_cast("int")


def count_digits(c) -> Column:
    """A count of at most seven digits, look-alike letters read as digits; null otherwise."""
    d = F.regexp_replace(F.translate(ascii_digits(c), *COUNT_LOOKALIKES), "[^0-9]", "")
    return F.when(F.length(d).between(1, 7), d.try_cast("int"))


def valid_age(c, low: int = 18) -> Column:
    """The age from a reading (O is 0), or null when it is not from ``low`` to 120."""
    a = F.regexp_replace(F.translate(ascii_digits(c), "Oo", "00"), "[^0-9]", "").try_cast("int")
    return F.when(a.between(low, 120), a)


def after_colon(c) -> Column:
    """What follows the first colon, trimmed; empty without one."""
    at = F.instr(lit(c), ":")
    return F.when(at > 0, F.trim(F.substr(lit(c), at + 1))).otherwise(F.lit(""))


def valid_dates(c) -> Column:
    """Calendar-valid dd mm yyyy dates of a text, in order, as an array."""
    pattern = F.lit(r"([0-9]{2})[^0-9]{0,2}([0-9]{2})[^0-9]{0,2}(20[0-9]{2})")
    d, m, y = (F.regexp_extract_all(lit(c), pattern, F.lit(i)) for i in (1, 2, 3))
    dates = F.transform(F.arrays_zip(d.alias("d"), m.alias("m"), y.alias("y")), lambda z: F.try_to_date(F.concat_ws("-", z["y"], z["m"], z["d"]), "yyyy-MM-dd"))
    return F.filter(dates, lambda x: x.isNotNull())


def period(c) -> Column:
    """The first two dates as ``start, end`` (dd-mm-yyyy), both empty when there are fewer."""
    d = valid_dates(c)
    both = F.size(d) >= 2
    show = lambda i: F.when(both, F.date_format(F.get(d, F.lit(i)), "dd-MM-yyyy")).otherwise(F.lit(""))
    return F.struct(show(0).alias("start"), show(1).alias("end"))


def key_number(c) -> Column:
    """The number of a key such as ``AC_001``."""
    return F.regexp_extract(lit(c), "([0-9]+)", 1).try_cast("bigint")


def natural_key(c, width: int = 20, fold: bool = True) -> Column:
    """A string that sorts digit runs by value: each is left-padded with zeros."""
    t = F.lower(lit(c)) if fold else lit(c)
    runs = F.regexp_extract_all(t, F.lit("([0-9]+|[^0-9]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda x: F.when(F.regexp_like(x, F.lit("^[0-9]")), F.lpad(F.ltrim(x, F.lit("0")), width, "0")).otherwise(x)), "")


def embedded_numbers(c) -> Column:
    """The numbers of a text in order, without leading zeros."""
    return F.regexp_extract_all(ascii_digits(c), F.lit("([1-9][0-9]*)"), F.lit(1))


def house_text(c) -> Column:
    """A house reading: ASCII digits, o beside a digit is 0, isolated Latin words but A to D go, junk becomes space."""
    t = F.regexp_replace(ascii_digits(strip_label(c)), r"[^0-9A-Za-zऀ-ॿ /\-]", " ")
    t = F.regexp_replace(t, r"(?<=[0-9])[oO](?=[0-9]|$|\s)|(?<=^|\s)[oO](?=[0-9])|^[oO]$", "0")
    t = F.regexp_replace(t, r"(?<![0-9A-Za-z])(?![A-D](?![A-Za-z]))[A-Za-z]+(?![0-9A-Za-z])", " ")
    t = F.regexp_replace(t, r"\s+", " ")
    for low in "abcdefghijklmnopqrstuvwxyz":
        t = F.regexp_replace(t, f"(?<=[0-9]){low}", low.upper())
    return F.btrim(t, F.lit(" -/्"))


def house_class(c) -> Column:
    """``weight, kind`` of a house reading: how far it can be trusted as one."""
    t = lit(c)
    has = lambda p: F.regexp_like(t, F.lit(p))
    kind = (
        F.when((t == "") | t.isNull(), "empty")
        .when(has(r"^[0-9]{1,5}(\s?[/\-]\s?[0-9]{1,4})*$"), "digits")
        .when(has(r"^[0-9]{1,5}\s?([ऀ-ॿ]{1,3}|[A-Za-z])$"), "digit+letter")
        .when((F.regexp_count(t, F.lit("[ऄ-ह\u0958-\u095F]")) >= 3) & ~has("[A-Za-z]"), "place")
        .otherwise("junk")
    )
    weight = F.when(kind == "digits", 1.0).when(kind == "digit+letter", F.when(has("[A-Za-z]$"), 0.6).otherwise(0.95)).when(kind == "place", 0.9).otherwise(0.0)
    return F.struct(weight.alias("weight"), kind.alias("kind"))


def _has(*words: str):
    return lambda t: reduce(lambda a, b: a | b, [F.contains(F.replace(t, F.lit(" "), F.lit("")), F.lit(w)) for w in words])


#: The kinds of summary rows by the words in their labels, the first that fits.
ROW_LABELS = [
    ("net", _has("नेट", "इलेक्टर", "इलैक्टर")),
    ("diff", _has("लिंग", "अंतर", "कारण")),
    ("add", _has("वर्धन", "परिवधन", "परिवर्ध")),
    ("del", _has("लोपन", "विलोप")),
    ("mool", lambda t: _has("मूल")(t) | (_has("नामावली")(t) & ~_has("प्रकार", "पहचान")(t))),
]


def classify(c, rules: list[tuple[str, str]]) -> Column:
    """The label of the first rule (an SQL condition on ``t``) that holds, null without one."""
    out = F.lit(None).cast("string")
    for label, condition in reversed(rules):
        out = F.when(condition(lit(c)), F.lit(label)).otherwise(out)
    return out


def safe_cell(c) -> Column:
    """Spreadsheet cells that would start a formula get a leading space."""
    return F.when(F.regexp_like(lit(c), F.lit(r"^[=+\-@]")), F.concat(F.lit(" "), lit(c))).otherwise(lit(c))


def flags(*pairs: tuple[str, Column]) -> Column:
    """The names of the conditions that hold, in order, each once."""
    return F.array_distinct(F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in pairs])))
