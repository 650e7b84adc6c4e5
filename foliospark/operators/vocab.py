"""A vocabulary from the data itself, and the correction of rare words by frequent ones next to them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.shared import settled

RARE, STRONG, RATIO, SUB_RARE, SUB_RATIO, ENOUGH = 4, 8, 6, 2, 8, 4000
#: Vowel signs; a consonant with a halant, either way round.
VOWEL_SIGNS = "ािीुूृेैोौ"
CONJUNCT = "^([क-ह\u0958-\u095F]्|्[क-ह\u0958-\u095F])$"


def words(column: str) -> Column:
    return F.filter(F.split(F.coalesce(F.col(column), F.lit("")), r"\s+"), lambda x: x != "")


def build_vocabulary(rows: DataFrame, columns: list[str], confident: Column, base: DataFrame | None = None) -> DataFrame:
    """``token, n`` over confident rows: words of two characters or more, all columns together, added to a base."""
    tokens = rows.where(confident).select(F.explode(F.concat(*[words(c) for c in columns])).alias("token")).where("char_length(token) >= 2")
    n = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return n if base is None else n.unionByName(base.select("token", "n")).groupBy("token").agg(F.sum("n").alias("n"))


def _cut(token: str, i: Column, n: int, put: str = "") -> Column:
    return F.concat(F.substr(F.col(token), F.lit(1), i), F.lit(put), F.substr(F.col(token), i + n + 1))


def _places(token: str, first: int, last: int) -> Column:
    """0-based places from ``first`` to the length plus ``last``."""
    end = F.char_length(token) + last
    return F.when(end >= first, F.sequence(F.lit(first), end)).otherwise(F.array().cast("array<int>"))


def _keyed(df: DataFrame, token: str, how: str) -> DataFrame:
    """Rows with a join key for each way a strong word can have become a rare one."""
    t = F.col(token)
    if how == "insert":
        keys = F.transform(_places(token, 0, -2), lambda i: _cut(token, i, 1))
    elif how == "conjunct":
        at = F.filter(_places(token, 0, -2), lambda i: F.regexp_like(F.substr(t, i + 1, F.lit(2)), F.lit(CONJUNCT)))
        keys = F.transform(at, lambda i: _cut(token, i, 2))
    else:
        at = F.filter(_places(token, 1, -2), lambda i: F.contains(F.lit(VOWEL_SIGNS), F.substr(t, i + 1, F.lit(1))))
        keys = F.transform(at, lambda i: _cut(token, i, 1, "\x00"))
    return df.withColumn("key", F.explode(F.array_distinct(keys)))


def _candidates(rare: DataFrame, strong: DataFrame, how: str, times: int, lead: int) -> DataFrame:
    """The one target of each rare word that is frequent enough and far ahead of the next, and how many there were."""
    mine = _keyed(rare, "token", how) if how == "vowel" else rare.withColumn("key", F.col("token"))
    pairs = mine.join(_keyed(strong, "target", how), "key").where("target <> token").where(F.col("m") >= times * F.greatest("n", F.lit(1)))
    top = pairs.select("token", "target", "m").distinct().groupBy("token").agg(F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("m", "target")))), 1, 2).alias("c"))
    clear = (F.size("c") == 1) | (F.get("c", F.lit(0))["m"] >= lead * F.get("c", F.lit(1))["m"])
    return top.select("token", F.when(clear, F.get("c", F.lit(0))["target"]).alias(how), F.lit(True).alias(f"{how}_any"))


def corrections(vocabulary: DataFrame, enough: int = ENOUGH) -> DataFrame:
    """``token, fixed`` for the rare words that one frequent word explains.

    First one wrong vowel sign inside the word, then one lost character (never the last), then a lost member of a
    conjunct; each only into a word seen ``STRONG`` times and several times more often, and not when two compete. Words
    meet through keys with the place cut out, by equality, never word against word. Nothing is corrected until the
    vocabulary holds ``enough`` words in all.
    """
    total = vocabulary.agg(F.sum("n").alias("total"))
    v = vocabulary.crossJoin(F.broadcast(total)).where(F.col("total") >= enough).drop("total")
    strong = v.where(F.col("n") >= STRONG).select(F.col("token").alias("target"), F.col("n").alias("m"))
    long = strong.where("char_length(target) >= 5")
    rare = v.where((F.col("n") <= RARE) & (F.char_length("token") >= 3))
    rarer = v.where(F.col("n") <= SUB_RARE)
    vowel = _candidates(rarer.where("char_length(token) >= 5"), long, "vowel", SUB_RATIO, 3)
    insert = _candidates(rare, strong, "insert", RATIO, 2)
    conjunct = _candidates(rarer.where("char_length(token) >= 4"), long, "conjunct", RATIO, 3)
    out = rare.join(vowel, "token", "left").join(insert, "token", "left").join(conjunct, "token", "left")
    fixed = F.coalesce("vowel", F.when(F.col("insert_any"), F.col("insert")).otherwise(F.col("conjunct")))
    return out.select("token", fixed.alias("fixed")).where("fixed is not null")


def apply_corrections(rows: DataFrame, key: str, column: str, fixes: DataFrame, rule: Callable[[str], str] | None = None) -> DataFrame:
    """The column with corrected words, ``changes`` as ``a>b`` joined by semicolons, and whether there are any. ``rule`` is
    applied to the corrected text, once for each distinct one, and counts as a change."""
    t = rows.select(key, F.posexplode(words(column)).alias("pos", "token")).join(fixes, "token", "left")
    done = t.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "token", F.coalesce("fixed", "token").alias("fixed")))).alias("w"))
    log = F.transform(F.filter("w", lambda x: x["token"] != x["fixed"]), lambda x: F.concat(x["token"], F.lit(">"), x["fixed"]))
    done = done.select(key, F.array_join(F.transform("w", lambda x: x["fixed"]), " ").alias("_f"), F.array_join(log, "; ").alias("changes"))
    out = rows.join(done, key, "left").withColumn("changes", F.coalesce("changes", F.lit("")))
    changed = F.col("changes") != ""
    if rule:
        from ..functions.script import per_value

        out = per_value(out.withColumn("_b", F.when(changed, F.col("_f")).otherwise(F.col(column))), "_b", "_f", rule).drop("_b")
        return out.withColumn("vocab_fixed", changed | ~F.col("_f").eqNullSafe(F.col(column))).withColumn(column, F.col("_f")).drop("_f")
    return out.withColumn(column, F.when(changed, F.col("_f")).otherwise(F.col(column))).withColumn("vocab_fixed", changed).drop("_f")


#: Values and references in a tile of their product.
_TILE = 2000


def _alike(close: float, times: float):
    """The pairs of a tile of values and references of one length whose matching ratio is ``close`` or more.

    The letters that two words have in common, in any order, bound the ratio from above. They are counted for the whole
    tile, letter by letter, and only pairs that this leaves are matched.
    """
    import numpy as np
    import pandas as pd

    def counts(words: list[str], letters: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(len(words)), [len(w) for w in words])
        at = np.searchsorted(letters, codes(words))
        return np.bincount(at * len(words) + row, minlength=len(letters) * len(words)).reshape(len(letters), len(words)).astype(np.int32)

    def codes(words: list[str]) -> np.ndarray:
        return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)

    def run(values: pd.DataFrame, refs: pd.DataFrame) -> pd.DataFrame:
        from ..functions.script import ratio

        out = []
        if len(values) and len(refs):
            own, cbare = values["bare"].tolist(), refs["cbare"].tolist()
            letters = np.unique(codes(own + cbare))
            a, b = counts(own, letters), counts(cbare, letters)
            la, lb = a.sum(0), b.sum(0)
            m, cm = values["m"].to_numpy(), refs["cm"].to_numpy()
            names, canon = values["merged"].tolist(), refs["canon"].tolist()
            for i in range(0, len(own), 200):
                x = a[:, i : i + 200]
                common = np.zeros((x.shape[1], len(cbare)), np.int32)
                for u, v in zip(x, b, strict=True):
                    mine, theirs = np.flatnonzero(u), np.flatnonzero(v)
                    if len(mine) and len(theirs):
                        common[np.ix_(mine, theirs)] += np.minimum(u[mine, None], v[None, theirs])
                fit = (2.0 * common / (la[i : i + 200, None] + lb[None, :]) >= close) & (cm[None, :] >= times * m[i : i + 200, None])
                for p, q in zip(*(z.tolist() for z in np.nonzero(fit)), strict=True):
                    if (r := ratio(own[i + p], cbare[q], True)) is not None and r >= close:
                        out.append((names[i + p], canon[q], int(cm[q]), float(r)))
        return pd.DataFrame(out, columns=["merged", "canon", "cm", "r"])

    return run


def canonical_spellings(values: DataFrame, column: str, least: int = 4, times: float = 1.5, close: float = 0.74) -> DataFrame:
    """``value, canon`` for spellings that another one, more frequent and nearly the same, stands for.

    Spellings that differ in spaces become the spaced one (then the more frequent, then the greater). A value seen
    ``least`` times is a reference. Others take the reference with the best matching ratio of ``close`` or more that is
    ``times`` as frequent; on a tie the more frequent, then the smaller.

    The ratio bounds the length of a reference. Values and references of a length meet in tiles of bounded size, where the
    letters in common decide which pairs are matched. No pair is left out.
    """
    n = values.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    n = settled(n.withColumn("bare", F.replace("value", F.lit(" "), F.lit(""))), "spellings")
    target = n.groupBy("bare").agg(F.max(F.struct(F.contains("value", F.lit(" ")).alias("spaced"), "n", "value")).alias("t"), F.sum("n").alias("total"))
    merged = target.select(F.col("t.value").alias("merged"), "bare", F.col("total").alias("m"), F.char_length("bare").alias("len"))
    merged = settled(merged, "spellings")
    canon = merged.where(F.col("m") >= least).select(F.col("merged").alias("canon"), F.col("bare").alias("cbare"), F.col("m").alias("cm"), "len")
    low, high = close / (2 - close), (2 - close) / close
    rest = merged.where(F.col("m") < least)
    rest = rest.withColumn("len", F.explode(F.sequence(F.ceil(F.col("len") * low).cast("int"), F.floor(F.col("len") * high).cast("int"))))
    tiles = rest.groupBy("len").agg(F.ceil(F.count(F.lit(1)) / _TILE).alias("parts")).join(canon.groupBy("len").agg(F.ceil(F.count(F.lit(1)) / _TILE).alias("blocks")), "len")
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    left = rest.join(tiles, "len").select("len", F.pmod(F.xxhash64("bare"), "parts").alias("part"), every("blocks").alias("block"), "merged", "bare", "m")
    right = canon.join(tiles, "len").select("len", every("parts").alias("part"), F.pmod(F.xxhash64("cbare"), "blocks").alias("block"), "canon", "cbare", "cm")
    key = ["len", "part", "block"]
    n_tasks = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a count of its own: small rows, much work
    left, right = (x.repartition(n_tasks, *key) for x in (left, right))
    pairs = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_alike(close, times), "merged string, canon string, cm bigint, r double")
    best = pairs.groupBy("merged").agg(F.min_by("canon", F.struct((-F.col("r")).alias("a"), (-F.col("cm")).alias("b"), "canon")).alias("canon"))
    chosen = merged.where(F.col("m") >= least).select("merged", F.col("merged").alias("canon")).unionByName(best)
    return n.join(merged.select("bare", "merged"), "bare").join(chosen, "merged").where("canon <> value").select("value", "canon")
