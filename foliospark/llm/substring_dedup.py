"""Substring dedup by level-wise doubling: only windows repeated at one length are looked at with twice that length."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bpe import ranges, slices
from .common import Staged, bound_batches, narrow, text_or_empty
from .words import Windows, mix, sliding_min, split_words, wide_hashes

_TEXT_BATCH = 4 << 20


def anchor_table(words: np.ndarray, other: np.ndarray, per_doc: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """The first level: windows of a quarter of the length, at anchors.

    A window's anchor is the start of the smallest (by hash, then leftmost) of the quarter windows in it. It depends on
    the window's words alone, so equal windows have equal anchors, and the neighbours that share one are described by
    their first start, their number and the segment they cover. ``ahead`` and ``back`` are the windows of twice the
    quarter that begin or end with it; at least one of the two lies inside each window of the anchor. ``words`` and ``other``
    are independent hashes of the words; ``check`` is the segment by the other.
    """
    quarter = -(-window // 4)
    span = window - quarter + 1
    ends = np.cumsum(per_doc)
    fits = np.maximum(per_doc - window + 1, 0)
    starts = ranges(ends - per_doc, fits)
    if not len(starts):
        return {k: np.empty(0, np.int64) for k in ("doc", "first", "number", "at", "ahead", "back", "segment", "check")}
    w = Windows(words, window + span)
    q = w.all(quarter)
    bits = np.uint64((1 << 30) - 1)
    key = (mix(q, np.zeros(1, np.uint64)) & ~bits) | np.arange(len(q), dtype=np.uint64)
    anchor = (sliding_min(key, span)[starts] & bits).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)])
    number = np.diff(np.r_[new, len(starts)])
    first, at = starts[new], anchor[new]
    doc = np.searchsorted(ends, first, side="right")
    begin = (ends - per_doc)[doc]
    half = np.full(len(at), 2 * quarter)

    segment = w.at(first, number - 1 + window)
    check = Windows(other, window + span).at(first, number - 1 + window)

    def level(begins: np.ndarray, inside: np.ndarray, salt: int) -> np.ndarray:
        """Where the doubled window does not fit, the segment stands in for it, so that such rows spread out as others do."""
        h = w.at(np.where(inside, begins, 0), np.where(inside, half, 1))
        return mix(np.where(inside, h, segment), np.zeros(1, np.uint64), salt)

    ahead = level(at, at + 2 * quarter <= first + number - 1 + window, 1)
    back = level(at - quarter, at - quarter >= first, 2)
    as_long = {"at": q[at], "ahead": ahead, "back": back, "segment": segment, "check": check}
    return {"doc": doc, "first": first - begin, "number": number} | {k: v.view(np.int64) for k, v in as_long.items()}


def _anchors(window: int):
    def run(batches):
        for b in slices(batches, 2, _TEXT_BATCH):
            words, per_doc = split_words(b.column(2))
            t = anchor_table(*wide_hashes(words), per_doc, window)
            doc = pa.array(t["doc"])
            kinds = ["at", "ahead", "back", "segment", "check"]
            columns = [b.column(0).take(doc), b.column(1).take(doc), pa.array(t["first"].astype(np.int32)), pa.array(t["number"].astype(np.int32)), *(pa.array(t[k]) for k in kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "first", "number", *kinds])

    return run


def _full_windows(window: int):
    """The hashes of the listed windows of each text."""

    def run(batches):
        for b in slices(batches, 2, _TEXT_BATCH):
            words, per_doc = split_words(b.column(2))
            both = [Windows(h, window).all(window).view(np.int64) for h in wide_hashes(words)]
            lists = b.column(3)
            at = lists.offsets.to_numpy()
            row = np.repeat(np.arange(b.num_rows), np.diff(at))
            flat = lists.flatten()
            first, number = flat.field(0).to_numpy().astype(np.int64), flat.field(1).to_numpy().astype(np.int64)
            alone = flat.field(2).to_numpy(zero_copy_only=False)
            start = ranges(first, number)
            row, alone = np.repeat(row, number), np.repeat(alone, number)
            at = (np.cumsum(per_doc) - per_doc)[row] + start
            rows = pa.array(row)
            columns = [b.column(0).take(rows), b.column(1).take(rows), pa.array(start.astype(np.int32)), pa.array(alone), *(pa.array(h[at]) for h in both)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "first", "alone", "h", "check"])

    return run


def _cut(batches, verbatim: bool):
    """The words outside the spans, joined by single spaces; with ``verbatim``, texts that lose nothing as they are."""
    for b in slices(batches, 1, _TEXT_BATCH):
        words, kept_n, out = [], [], []
        for text, spans in zip(b.column(1), b.column(2).to_pylist(), strict=True):
            own = text.as_buffer().to_pybytes().split()
            n, removed = len(own), 0
            if spans:
                edge = np.zeros(n + 1, np.int64)
                begin = np.array([s["first"] for s in spans])
                np.add.at(edge, begin, 1)
                np.add.at(edge, begin + np.array([s["words"] for s in spans]), -1)
                keep = np.cumsum(edge[:-1]) == 0
                own = [w for w, k in zip(own, keep.tolist(), strict=True) if k]
                removed = n - len(own)
            words.append(n)
            kept_n.append(removed)
            out.append(text.as_buffer().to_pybytes() if verbatim and not removed else b" ".join(own))
        kept = pa.array(out, pa.binary()).cast(pa.string())
        columns = [b.column(0), pa.array(words, pa.int64()), pa.array(kept_n, pa.int64()), kept, *b.columns[3:]]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_text", *b.schema.names[3:]])


def _repeated(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*cols)


def repeated_spans(docs: DataFrame, st: Staged, window: int) -> DataFrame:
    """``doc_id, mark, first, words``: runs of words covered by repeated windows. ``docs`` has ``doc_id, mark, text``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, mark bigint, first int, number int, at bigint, ahead bigint, back bigint, segment bigint, check bigint"
    rows = st.write(docs.mapInArrow(_anchors(window), schema), "substring-anchors")
    # a quarter: what is repeated goes on
    quarter = st.write(_repeated(rows, "at"), "substring-quarter")
    level1 = st.write(rows.join(quarter, "at"), "substring-level1")
    st.drop(rows, quarter)
    # twice the quarter, ahead or back
    sides = level1.select(F.explode(F.array("ahead", "back")).alias("side"))
    half = st.write(_repeated(sides, "side"), "substring-half")
    on = lambda side, how: level1.join(half.withColumnRenamed("side", side), side, how)
    back_only = on("ahead", "left_anti").join(half.withColumnRenamed("side", "back"), "back", "left_semi")
    level2 = st.write(on("ahead", "left_semi").unionByName(back_only), "substring-level2")
    st.drop(level1, half)
    # the whole segment: all windows of the anchor at once
    better = F.min(F.struct("doc_id", "mark", "first", "number"))
    segments = st.write(level2.groupBy("at", "segment", "check").agg(F.count(F.lit(1)).alias("n"), better.alias("one")), "substring-segments")
    whole = level2.join(segments.where("n > 1").select("at", "segment", "check"), ["at", "segment", "check"])
    whole = whole.select("doc_id", "mark", "first", (F.col("number") + window - 1).alias("words"))
    # segments that stand alone, beside others with the same anchor: window by window
    mixed = segments.groupBy("at").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1").select("at")
    mixed = st.write(mixed, "substring-mixed")  # written, so that a frequent anchor's rows can be split between tasks
    left = segments.join(mixed, "at").select(F.col("one.doc_id").alias("doc_id"), F.col("one.mark").alias("mark"), F.struct("one.first", "one.number", (F.col("n") == 1).alias("alone")).alias("w"))
    left = left.groupBy("doc_id", "mark").agg(F.collect_list("w").alias("ws"))
    left = left.select(F.col("doc_id").alias("i"), F.col("mark").alias("m"), "ws")
    texts = docs.join(left, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("mark") == F.col("m"))).select("doc_id", "mark", "text", "ws")
    full = st.write(texts.mapInArrow(_full_windows(window), f"doc_id {kind}, mark bigint, first int, alone boolean, h bigint, check bigint"), "substring-windows")
    twice = st.write(_repeated(full.select("doc_id", "mark", "first", "h", "check").distinct(), "h", "check"), "substring-full")
    single = full.where("alone").join(twice, ["h", "check"])
    single = single.select("doc_id", "mark", "first", F.lit(window).alias("words"))
    spans = st.write(whole.unionByName(single), "substring-spans")
    st.drop(level2, segments, mixed, full, twice)
    return spans


def substring_dedup(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), verbatim: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_text`` and the columns named in ``carry``.

    Words are runs of anything but ASCII white space. A word goes when a window of ``window`` words that covers it starts
    somewhere else too, in the same text or another; windows are judged on the input. What stays is joined by single
    spaces. Null and empty texts have no words; texts shorter than the window lose nothing; rows repeated whole are
    copies of each other and lose every window. With ``verbatim`` a text that loses nothing keeps
    its white space. An empty table gives an empty result; other columns are ignored.

    Levels: a quarter of the window at the anchors of all windows, one row per anchor and about one per 14 words; half of
    it for the anchors that are repeated; then the segment of all windows around an anchor, which one count settles for
    long copies; and the single full windows for segments that stand alone. Each level reads what the one before kept,
    from a written table, and counts are combined before they are shuffled, so a passage of any frequency costs a row
    per task. The shorter windows are compared by 64-bit hashes, and a window goes only by what two independent ones of the
    segment or of itself agree on. The spans of a text meet in one row, as
    many as it has anchors.
    """
    bound_batches(docs.sparkSession)
    st = Staged(docs.sparkSession)
    d = narrow(docs, doc_id=id_col, text=text_col, **{f"carry{i}": c for i, c in enumerate(carry)})
    d = d.withColumn("text", text_or_empty()).withColumn("mark", F.xxhash64("text"))
    spans = repeated_spans(d.select("doc_id", "mark", "text"), st, window)
    spans = spans.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("first", "words")).alias("spans"))
    spans = spans.select(F.col("doc_id").alias("i"), F.col("mark").alias("m"), "spans")
    own = [f"carry{i}" for i in range(len(carry))]
    both = d.join(spans, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("mark") == F.col("m")), "left").select("doc_id", F.col("text").cast("binary").alias("text"), "spans", *own)
    more = "".join(f", {c} {d.schema[c].dataType.simpleString()}" for c in ("doc_id", *own))[1:].split(",", 1)
    schema = f"{more[0]}, n_words bigint, n_removed bigint, kept_text string" + (f",{more[1]}" if own else "")
    out = both.mapInArrow(lambda batches: _cut(batches, verbatim), schema)
    return out.select("doc_id", "n_words", "n_removed", "kept_text", *[F.col(a).alias(b) for a, b in zip(own, carry, strict=True)])
