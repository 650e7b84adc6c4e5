"""Reconciliation of several readings of one field, from a long table ``field key, text, score, ord``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MARGIN, SHORT = 0.15, 2


def best(readings: DataFrame, key: list[str]) -> DataFrame:
    """The reading with the highest score, the first on a tie; unread scores count as 0."""
    s = F.coalesce(F.col("score"), F.lit(0.0))
    return readings.groupBy(*key).agg(F.max_by(F.struct("text", s.alias("score"), "ord"), F.struct(s, -F.col("ord"))).alias("_b")).select(*key, "_b.*")


def row_confidence(readings: DataFrame, key: list[str]) -> DataFrame:
    """The lowest score of a row's fields, to three digits; an unread field counts as 0."""
    return readings.groupBy(*key).agg(F.bround(F.min(F.coalesce("score", F.lit(0.0))), 3).alias("confidence"))


def disagreement(readings: DataFrame, key: list[str], least: float = 0.5, variant: str | None = None) -> DataFrame:
    """More than one distinct text among the readings that are not empty and score ``least`` or more. ``variant`` names the
    cut that was read: only the plain one, empty or ``#`` and a reader's number, counts."""
    use = F.when((F.col("score") >= least) & (F.col("text") != "") & (F.regexp_like(F.coalesce(variant, F.lit("")), F.lit("^(#[0-9]+)?$")) if variant else F.lit(True)), F.col("text"))
    return readings.groupBy(*key).agg(F.count_distinct(use).alias("n_texts")).withColumn("disagree", F.col("n_texts") > 1)


def candidates(readings: DataFrame, key: list[str], primary: str, bonus: float = 0.001) -> DataFrame:
    """Distinct values with their best score, the best first, as an array; the primary reader has a small advantage."""
    s = F.coalesce("score", F.lit(0.0)) + F.when(F.col(primary), bonus).otherwise(0.0)
    v = readings.where("text is not null").groupBy(*key, "text").agg(F.max(s).alias("s"))
    return v.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("s"), "text"))), lambda x: x["text"]).alias("candidates"))


def _best_of(items: Column) -> Column:
    """Highest score, the first on a tie; a text of fewer than two letters only if no longer one has a score."""
    letters = lambda x: F.length(F.replace(x["text"], F.lit(" "), F.lit("")))
    order = lambda xs: F.array_max(F.transform(xs, lambda x: F.struct(x["score"].alias("score"), (-x["ord"]).alias("o"), x["text"].alias("text"))))
    some = F.filter(items, lambda x: x["score"] > 0)
    long = F.filter(some, lambda x: letters(x) >= SHORT)
    top, top_long = order(some), order(long)
    return F.when((F.length(F.replace(top["text"], F.lit(" "), F.lit(""))) < SHORT) & top_long.isNotNull(), top_long).otherwise(top)


def pick(readings: DataFrame, key: list[str], model: str = "model") -> DataFrame:
    """The primary model's reading unless the secondary is better by the margin: ``text, score, source``.

    Within a model a text that another (scoring 0.5 or more) continues is a truncation and does not compete. The primary
    is usable with a score of 0.5 and two letters. A chosen text without spaces gives way to a reading, scoring 0.8 or
    more, with the same letters and spaces. The readings of one field, few, are folded within its row.
    """
    item = F.struct("ord", "text", F.coalesce("score", F.lit(0.0)).alias("score"), (F.col(model) > 0).alias("second"))
    d = readings.groupBy(*key).agg(F.array_sort(F.collect_list(item)).alias("_i"))

    def untruncated(second: bool) -> Column:
        own = F.filter("_i", lambda x: x["second"] == second)
        cut = lambda x: (F.length(x["text"]) >= 3) & F.exists(own, lambda y: (F.length(y["text"]) > F.length(x["text"])) & F.startswith(y["text"], x["text"]) & (y["score"] >= 0.5))
        keep = F.filter(own, lambda x: ~F.coalesce(cut(x), F.lit(False)))
        return F.when(F.size(keep) > 0, keep).otherwise(own)

    d = d.withColumn("_a", untruncated(False)).withColumn("_z", untruncated(True))
    d = d.withColumn("_p", _best_of(F.col("_a"))).withColumn("_s", _best_of(F.col("_z"))).withColumn("_x", _best_of(F.concat("_a", "_z")))
    letters = lambda c: F.length(F.replace(F.col(f"{c}.text"), F.lit(" "), F.lit("")))
    ps, ss = F.coalesce("_p.score", F.lit(0.0)), F.coalesce("_s.score", F.lit(0.0))
    usable = (ps >= 0.5) & (letters("_p") >= SHORT)
    chosen = (
        F.when(usable, F.when((ss >= ps + MARGIN) & (letters("_s") >= SHORT), F.lit("s")).otherwise("p"))
        .when((ps > 0) & (ss < ps + MARGIN), "p").otherwise("x")
    )
    d = d.withColumn("_c", chosen)
    d = d.withColumn("_t", F.when(F.col("_c") == "p", F.col("_p")).when(F.col("_c") == "s", F.col("_s")).otherwise(F.col("_x")))
    spaced = F.filter(F.concat("_a", "_z"), lambda x: F.contains(x["text"], F.lit(" ")) & (F.replace(x["text"], F.lit(" "), F.lit("")) == F.col("_t.text")) & (x["score"] >= 0.8))
    text = F.when(~F.contains(F.col("_t.text"), F.lit(" ")) & (F.size(spaced) > 0), F.get(spaced, F.lit(0))["text"]).otherwise(F.col("_t.text"))
    return d.select(*key, F.coalesce(text, F.lit("")).alias("text"), F.coalesce("_t.score", F.lit(0.0)).alias("score"), F.col("_c").alias("source"))


def needs_second_opinion(text: Column, score: Column, below: float = 0.90) -> Column:
    """Weak readings: the only ones that the costly second reader is asked about."""
    return (F.coalesce(score, F.lit(0.0)) < below) | (F.length(F.replace(text, F.lit(" "), F.lit(""))) < SHORT) | text.isNull()


def lexicon_score(tokens: DataFrame, lexicon: DataFrame, key: list[str], cap: float = 5.0) -> DataFrame:
    """Mean of min(log2(1 + n), cap) over a text's tokens; unknown tokens count 0."""
    return tokens.join(lexicon, "token", "left").groupBy(*key).agg(F.avg(F.least(F.log2(1 + F.coalesce("n", F.lit(0))), F.lit(cap))).alias("lex"))


def arbitrate(pairs: DataFrame, lexicon: DataFrame, lex_weight: float, key: str = "id") -> DataFrame:
    """Which of two engines' texts to use, from ``p, pc, t, tc``: ``score`` (positive for t), ``use_t, unsure``.

    An engine that merely lost the last words is never preferred; texts equal but for spaces take the more spaced one.
    Words are weighed by their count in the lexicon of words on which both engines agree.
    """
    words = lambda c: F.filter(F.split(F.coalesce(F.col(c), F.lit("")), r"\s+"), lambda x: x != "")
    d = pairs.withColumn("_p", words("p")).withColumn("_t", words("t"))
    tokens = d.select(key, F.explode(F.concat(F.transform("_p", lambda x: F.struct(F.lit(0).alias("e"), x.alias("token"))), F.transform("_t", lambda x: F.struct(F.lit(1).alias("e"), x.alias("token"))))).alias("w")).select(key, "w.e", "w.token")
    lex = lexicon_score(tokens, lexicon, [key, "e"]).groupBy(key).agg(F.max(F.when(F.col("e") == 0, F.col("lex"))).alias("lp"), F.max(F.when(F.col("e") == 1, F.col("lex"))).alias("lt"))
    d = d.join(lex, key, "left")
    bare = lambda c: F.replace(F.coalesce(F.col(c), F.lit("")), F.lit(" "), F.lit(""))
    dl = F.greatest(F.lit(-3), F.least(F.lit(3), F.length(bare("t")) - F.length(bare("p"))))
    v = 2.0 * lex_weight * (F.coalesce("lt", F.lit(0.0)) - F.coalesce("lp", F.lit(0.0))) + 6.0 * (F.col("tc") - 0.5) - 3.0 * (F.col("pc") - 0.95) + 0.3 * dl
    lost = (F.size("_t") < F.size("_p")) & (F.slice("_p", 1, F.greatest(F.size("_t"), F.lit(1))) == F.col("_t"))
    score = F.when(F.size("_t") == 0, -99.0).when(F.size("_p") == 0, 99.0).when(lost, -99.0).otherwise(v)
    same = bare("p") == bare("t")
    d = d.withColumn("score", score)
    use = F.when(same, F.size("_t") > F.size("_p")).otherwise(F.col("score") > 0)
    return d.select(key, F.when(use, F.col("t")).otherwise(F.col("p")).alias("text"), use.alias("use_t"), (~same & (F.abs("score") < 1.5)).alias("unsure"), F.when(same, 0.0).otherwise(F.col("score")).alias("score"))


def template_match(vectors: DataFrame, templates: DataFrame, key: str, vec: str) -> DataFrame:
    """``label, score, margin`` of the template with the highest Pearson correlation to each vector.

    ``templates`` (``label, pix``) is a few labels times a few shapes by construction and is broadcast; all of it is
    folded in the vector's own row, so there is no row for each pair. The margin is to the best of another label, or the
    score itself when there is one label alone.
    """
    mean = lambda v: F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / F.size(v)
    centred = lambda v: F.transform(v, lambda x: x.cast("double") - mean(F.transform(v, lambda y: y.cast("double"))))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    t = templates.select("label", centred(F.col("pix")).alias("c")).withColumn("n", F.sqrt(dot(F.col("c"), F.col("c"))))
    t = t.agg(F.collect_list(F.struct("label", "c", "n")).alias("_t"))
    d = vectors.select(key, centred(F.col(vec)).alias("_v")).withColumn("_n", F.sqrt(dot(F.col("_v"), F.col("_v")))).crossJoin(F.broadcast(t))
    scored = F.transform("_t", lambda x: F.struct((dot(F.col("_v"), x["c"]) / (F.col("_n") * x["n"])).alias("s"), x["label"].alias("label")))
    d = d.select(key, F.sort_array(scored, asc=False).alias("_s")).withColumn("_b", F.get("_s", F.lit(0)))
    other = F.array_max(F.transform(F.filter("_s", lambda x: x["label"] != F.col("_b.label")), lambda x: x["s"]))
    return d.select(key, F.col("_b.label").alias("label"), F.col("_b.s").alias("score"), (F.col("_b.s") - F.coalesce(other, F.lit(0.0))).alias("margin"))
