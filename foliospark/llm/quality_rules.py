"""Quality rules: a threshold table compiled into one projection (DataFrame functions only)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from .common import WS_RUN, place_of, placed

#: Frequent function words of the languages of the corpus.
STOP_WORDS = {
    "en": "the of and to in is that for it was on are with as by an be this from at or".split(),
    "fr": "le la les de des du et un une que qui en dans est pas pour sur au aux avec ce".split(),
    "de": "der die das und in den von zu ist mit des für auf ein eine im dem nicht auch als".split(),
    "es": "el la los las de y que en un una es del por con su para no se al lo como".split(),
}
#: Fixed value: symbols counted by ``n_symbols``.
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """A row fails the rule when ``metric`` (an SQL expression over the counts) is below ``low`` or above ``high``."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None

    def failed(self) -> str:
        parts = []
        if self.low is not None:
            parts.append(f"({self.metric}) < {self.low}")
        if self.high is not None:
            parts.append(f"({self.metric}) > {self.high}")
        return f"coalesce({' or '.join(parts)}, true)"


#: The base verdict, then the method's own length, symbol, stop-word and line ratios.
BASE_RULES = (Rule("words", "n_words", low=10), Rule("repeats", "100 * n_repeat_words - 20 * n_words", high=0))
RULES = (
    Rule("word_length", "word_chars / nullif(n_words, 0)", low=2.0, high=15.0),
    Rule("symbols", "n_symbols / nullif(n_words, 0)", high=0.10),
    Rule("stop_words", "if(n_words < 50, 1, n_stop_words / nullif(n_words, 0))", low=0.02),
    Rule("dup_lines", "if(n_lines < 4, 0, n_dup_lines / nullif(n_lines, 0))", high=0.60),
)


def stop_word_list() -> list[str]:
    return sorted({w for ws in STOP_WORDS.values() for w in ws})


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """The counts that the rules use; with ``carry``, the input row too, as ``row``. Every column that a lambda refers to is a column of the projection below it, so
    no array is computed again for each element."""
    d = placed(docs)
    row = [F.struct(*d.columns).alias("row")] if carry else []
    d = d.select(F.col(place_of(docs, id_col)).alias("doc_id"), F.coalesce(place_of(docs, text_col), F.lit("")).alias("t"), *row)
    row = ["row"] if carry else []
    d = d.select(
        "doc_id",
        *row,
        "t",
        F.filter(F.split("t", WS_RUN), lambda x: x != "").alias("w"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("ln"),
    )
    # hashes of the five-word windows; sorted, equal ones stand together
    five = "transform(sequence(0, size(w) - 5), i -> xxhash64(w[i], w[i+1], w[i+2], w[i+3], w[i+4]))"
    d = d.withColumn("h", F.expr(f"if(size(w) >= 5, {five}, array())"))
    d = d.withColumn("sh", F.sort_array("h"))
    d = d.withColumn("twice", F.expr("exists(sequence(1, greatest(size(sh) - 1, 1)), i -> i < size(sh) and get(sh, i) = get(sh, i - 1))"))
    d = d.withColumn("s", F.expr("if(twice, sort_array(transform(h, (x, i) -> struct(x, i))), cast(array() as array<struct<x: bigint, i: int>>))"))
    d = d.withColumn(
        "p",
        F.expr("sort_array(transform(filter(transform(s, (e, k) -> struct(e.i as i, coalesce(e.x = get(s, k - 1).x, false) or coalesce(e.x = get(s, k + 1).x, false) as d)), e -> e.d), e -> e.i))"),
    )
    stops = ", ".join(f"'{w}'" for w in stop_word_list())
    return d.select(
        "doc_id",
        *row,
        F.size("w").cast("long").alias("n_words"),
        F.expr("aggregate(w, 0L, (a, x) -> a + char_length(x))").alias("word_chars"),
        F.expr(f"cast(regexp_count(t, '{SYMBOLS}') as bigint)").alias("n_symbols"),
        (F.size("ln") - F.size(F.array_distinct("ln"))).cast("long").alias("n_dup_lines"),
        F.expr("aggregate(transform(p, (x, k) -> least(5, coalesce(get(p, k + 1) - x, 5))), 0L, (a, x) -> a + x)").alias("n_repeat_words"),
        F.size("ln").cast("long").alias("n_lines"),
        F.expr(f"cast(size(filter(w, x -> x in ({stops}))) as bigint)").alias("n_stop_words"),
    )


def quality_rules(docs: DataFrame, rules=RULES, base=BASE_RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, the counts, ``base_failed``, ``kept`` and ``failed_rules``.

    A word is a run of anything but ASCII white space. Null, empty and blank texts have no words: the base rule fails
    and so do the ratio rules, whose ratio is null. Repeated rows are judged alike, each on its own; there is no
    shuffle, so neither ties nor skew matter, and a text of any length is one row's work. Windows are compared by
    64-bit hashes within their own text.
    """
    return _judged(counts(docs, id_col, text_col), rules, base).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (F.size("failed_rules") == 0).alias("kept"), "n_lines", "n_stop_words", F.concat_ws("|", "failed_rules").alias("failed_rules"),
    )


def _judged(c: DataFrame, rules, base) -> DataFrame:
    out = c.withColumn("base_failed", F.expr(" or ".join(f"({r.failed()})" for r in base)))
    named = ", ".join(f"if({r.failed()}, '{r.name}', null)" for r in (*base, *rules))
    return out.withColumn("failed_rules", F.expr(f"array_compact(array({named}))"))


def keep_good(docs: DataFrame, rules=RULES, base=BASE_RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that fail no rule, with all their columns.

    A filter that moved below the projections would carry the whole chain of arrays in its condition and compute them
    for each element of each other. A column that is not deterministic keeps it above them.
    """
    judged = _judged(counts(docs, id_col, text_col, carry=True), rules, base)
    judged = judged.select("row", "failed_rules", F.monotonically_increasing_id().alias("stay"))
    return judged.where((F.size("failed_rules") == 0) & (F.col("stay") >= 0)).select("row.*").toDF(*docs.columns)
