"""Arithmetic constraints between counts, and checks of rows against rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import flags, is_id


def solve_sum(df: DataFrame, parts: list[str], total: str, most: int = 3) -> DataFrame:
    """Of candidate arrays (best first), the readings whose parts add up to the total.

    ``verdict`` is ``ok`` when the first candidates do, ``repaired`` when exactly one combination of the first ``most``
    of each does, else ``mismatch`` with the first candidates kept, or ``unreadable`` when a cell has none. A cell offers
    few candidates, so the search stays within the row.
    """
    cells = [*parts, total]
    top = lambda c: F.get(F.col(c), F.lit(0))
    d = df.withColumns({f"_{c}": F.slice(F.col(c), 1, most) for c in cells})
    add = lambda xs: reduce(lambda a, b: a + b, xs)
    combos = F.transform(F.col(f"_{cells[0]}"), lambda x: F.array(x))
    for c in cells[1:]:
        combos = F.flatten(F.transform(combos, _extended(F.col(f"_{c}"))))
    n = len(parts)
    d = d.withColumn("_all", combos).withColumn("_fit", F.filter("_all", lambda z: F.aggregate(F.slice(z, 1, n), F.lit(0).cast("bigint"), lambda a, x: a + x) == F.get(z, F.lit(n))))
    unread = add([(F.coalesce(F.size(c), F.lit(0)) <= 0).cast("int") for c in cells]) > 0
    verdict = F.when(unread, "unreadable").when(add([top(c) for c in parts]) == top(total), "ok").when(F.size("_fit") == 1, "repaired").otherwise("mismatch")
    d = d.withColumn("verdict", verdict)
    value = lambda i, c: F.when(F.col("verdict") == "repaired", F.get(F.get("_fit", F.lit(0)), F.lit(i))).otherwise(top(c))
    return d.withColumns({f"{c}_value": value(i, c) for i, c in enumerate(cells)}).drop("_all", "_fit", *[f"_{c}" for c in cells])


def _extended(cell: Column):
    """A function from one list of choices to those with each candidate of the next cell after it."""
    return lambda head: F.transform(cell, lambda x: F.array_append(head, x))


def balance(df: DataFrame, plus: list[str], minus: list[str], net: str) -> Column:
    """True where plus - minus differs from net; absent terms are 0, an absent net is not judged."""
    term = lambda cs: reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in cs], F.lit(0))
    return F.coalesce(term(plus) - term(minus) != F.col(net), F.lit(False))


def nearest(df: DataFrame, value: str, lines: str, reach: float) -> Column:
    """The member of the array ``lines`` nearest to ``value`` (the smaller on a tie), null beyond ``reach``."""
    near = F.array_min(F.transform(lines, lambda x: F.struct(F.abs(x - F.col(value)).alias("d"), x.alias("x"))))
    return F.when(near["d"] <= reach, near["x"])


#: Accepted relations and genders.
RELATIONS = ("father", "husband", "mother", "other")
GENDERS = ("male", "female", "third")


def row_checks(id_col: str, gap: Column, relation: str, gender: str, age: str, old_part: str, old_serial: str, name: str, low_conf: Column, names: str = r"[^A-Za-z0-9ऀ-ॿ 0./()'#-]") -> Column:
    """The failed checks of a register row, in the order of the checks; null and empty fields fail theirs."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    digits = lambda c: F.regexp_like(text(c), F.lit("^[0-9]+$"))
    years = text(age).try_cast("int")
    return flags(
        ("serial_gap", gap),
        ("epic_format", ~is_id(id_col, slashed=True)),
        ("relation_type", ~text(relation).isin(*RELATIONS)),
        ("gender", ~text(gender).isin(*GENDERS)),
        ("age", ~F.coalesce(digits(age) & years.between(15, 120), F.lit(False))),
        ("old_part_no", ~digits(old_part)),
        ("old_serial_no", ~digits(old_serial)),
        ("name_missing", text(name) == ""),
        ("name_chars", F.regexp_like(text(name), F.lit(names))),
        ("ocr_low_conf", low_conf),
    )
