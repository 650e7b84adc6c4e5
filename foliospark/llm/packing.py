"""Lexical retrieval packing: a seed's window is filled with the unused documents that a BM25 index finds for it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .bpe import byte_list, encoder, ranges, slices
from .common import Staged, bound_batches, narrow, text_or_empty
from .words import mix, split_words

_TEXT_BATCH = 4 << 20



#: Fixed value: what is taken off a word's ends before it is compared; letters A-Z count as a-z.
_MARKS = " \t\n\r\x0b\x0c.,;:!?\"'()[]{}<>*#"


def lexical_hashes(distinct: pa.LargeStringArray) -> np.ndarray:
    """A hash of each word without marks at its ends; 0 where nothing is left."""
    from xxhash import xxh64_intdigest

    bare = pc.ascii_lower(pc.ascii_trim(distinct, characters=_MARKS))
    out = np.fromiter(map(xxh64_intdigest, byte_list(bare)), np.uint64, len(bare))
    out[pc.binary_length(bare).to_numpy(zero_copy_only=False) == 0] = 0
    return out


def _packed(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Runs of ``sizes`` values each, as the bytes of one row each."""
    body = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((np.r_[0, np.cumsum(sizes)] * body.itemsize).astype(np.int32)), pa.py_buffer(body)])


def _unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All values of rows that ``_packed`` has made, and how many each has."""
    column = pc.fill_null(column, b"")
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    raw = np.frombuffer(body, np.uint8)[at[0] : at[-1]] if body is not None and len(column) else np.empty(0, np.uint8)
    return np.frombuffer(raw.tobytes(), kind), np.diff(at) // np.dtype(kind).itemsize


def _among(sorted_words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes are among the words."""
    if not len(sorted_words):
        return np.zeros(len(hashes), bool)
    return sorted_words[np.minimum(np.searchsorted(sorted_words, hashes), len(sorted_words) - 1)] == hashes


def _runs(x: np.ndarray) -> np.ndarray:
    """Where the distinct values of a sorted array begin."""
    return np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.empty(0, np.int64)


class Lexicon:
    """Statistics of the whole corpus: how many documents it has, their mean length, and how many hold each word.

    The ``most`` words that most documents hold are listed. Those of two documents or more that are rarer than the rarest
    listed one come with the documents (``rare_words``) and are told by ``told``; of the others that documents share each is
    in as many as the rarest listed one.
    """

    def __init__(self, n_docs: int, n_words: int, words: np.ndarray, counts: np.ndarray, most: int):
        order = np.argsort(words)
        self.n, self.mean = n_docs, max(1.0, n_words / max(1, n_docs))
        self.words, self.counts = words[order], counts[order]
        self.other = int(counts.min()) if len(words) >= most else 1
        self.rare = self.rare_counts = np.empty(0, np.int64)

    def add(self, words: np.ndarray, counts: np.ndarray) -> None:
        """More words to list, which leave the rarest of the others as it is."""
        new = ~_among(self.words, words)
        words, counts = np.r_[self.words, words[new]], np.r_[self.counts, counts[new]]
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]

    def told(self, rare: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """The rare words to know from now on, with how many documents hold each."""
        g, n = (np.concatenate([np.empty(0, np.int64), *x]) for x in zip(*rare, strict=True)) if rare else [np.empty(0, np.int64)] * 2
        g, first = np.unique(g.view(np.uint64), return_index=True)
        self.rare, self.rare_counts = g, n[first]

    def idf(self, hashes: np.ndarray) -> np.ndarray:
        """Of each word."""
        df = np.full(len(hashes), self.other, np.float64)
        for words, counts in ((self.words, self.counts), (self.rare, self.rare_counts)):
            if len(words):
                at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
                df = np.where(words[at] == hashes, counts[at], df)
        return np.log1p((self.n - df + 0.5) / (df + 0.5))


def lexical_keys(h: np.ndarray, long: np.ndarray, which: np.ndarray, per_doc: np.ndarray, n_keys: int) -> list[np.ndarray]:
    """Per document the word with the smallest exponential draw, by ``n_keys`` draws; 0 without words.

    ``which`` of the words ``h`` stand in the documents, one after another. A word's draw is the same everywhere, so documents
    that share much of their words share such a word with that probability, wherever they stand in the corpus. Short
    words, most of which are in every document of a language, are drawn at a twentieth of the rate of ``long`` ones.
    """
    begin, some = np.cumsum(per_doc) - per_doc, per_doc > 0
    low = np.int64((1 << max(1, len(h).bit_length())) - 1)
    keys = []
    for i in range(n_keys):
        u = (mix(h, np.zeros(1, np.uint64), 2 * i + 1) >> np.uint64(11)).astype(np.float64) + 0.5
        draw = -np.log(u / 2.0**53) / np.where(h == 0, 1e-300, np.where(long, 1.0, 0.05))
        draw = draw.view(np.int64) & ~low | np.arange(len(h))  # positive floats are in order as integers, too
        key = np.zeros(len(per_doc), np.int64)
        if some.any():
            key[some] = h[np.minimum.reduceat(draw[which], begin[some]) & low].view(np.int64)
        keys.append(key)
    return keys


#: A row's place is the number of its task, shifted by so many bits, and its number there.
_PLACE_BITS = 33


def _survey(n_keys: int, common: np.ndarray, buckets: int):
    """Each document again with its keys, its place and its distinct words that are not ``common``, as rows of kind 3; and of
    this task's documents how many hold each word (kind 0, a row for each bucket of words, numbers in ``ns``), how many there
    are (1) and how many words they have (2), in ``place``. One pass over the texts gives all."""

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        seen, texts, total, types = [], 0, 0, None
        names = ["kind", "doc_id", "text", *(f"k{i}" for i in range(n_keys)), "place", "bucket", "gs", "ns"]
        for b in slices(batches, 1, _TEXT_BATCH):
            words, per_doc = split_words(b.column(1))
            enc = words.dictionary_encode()
            own, which = lexical_hashes(enc.dictionary), enc.indices.to_numpy(zero_copy_only=False)
            long = pc.greater_equal(pc.binary_length(enc.dictionary), 4).to_numpy(zero_copy_only=False)
            keys = lexical_keys(own, long, which, per_doc, n_keys)
            types, rows = [c.type for c in b.columns], b.num_rows
            h, at = np.unique(own, return_inverse=True)
            size = max(1, len(h))
            pairs = np.sort(np.repeat(np.arange(len(per_doc)) * size, per_doc) + at[which])
            doc, word = np.divmod(pairs[_runs(pairs)], size)
            seen.append((h, np.bincount(word, minlength=len(h))))
            use = ~(_among(common, h) | (h == 0))[word]
            gs = _packed(h[word[use]], np.bincount(doc[use], minlength=rows))
            place = (task << _PLACE_BITS) + texts + np.arange(rows)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(rows, 3, np.int32)), b.column(0), b.column(1), *map(pa.array, keys), pa.array(place), pa.nulls(rows, pa.int32()), gs, pa.nulls(rows, pa.binary())], names=names)
            texts, total = texts + rows, total + int(per_doc.sum())
            if len(seen) > 16:
                seen = [_added(seen)]
        if texts:
            h, n = _added(seen)
            h, n = h[h != 0], n[h != 0]
            bucket = (h % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            sizes = np.bincount(bucket, minlength=buckets)
            some = np.flatnonzero(sizes)
            kind = np.r_[np.zeros(len(some)), 1, 2].astype(np.int32)
            sizes, rows = np.r_[sizes[some], 0, 0], len(kind)
            gs, ns = _packed(h[order], sizes), _packed(n[order], sizes)
            place = np.r_[np.full(len(some), task << _PLACE_BITS), texts, total]
            none = [pa.nulls(rows, types[0]), pa.nulls(rows, types[1]), *[pa.nulls(rows, pa.int64())] * n_keys]
            yield pa.RecordBatch.from_arrays([pa.array(kind), *none, pa.array(place), pa.array(np.r_[some, 0, 0].astype(np.int32)), gs, ns], names=names)

    return run


def _added(seen):
    h, at = np.unique(np.concatenate([x for x, _ in seen]), return_inverse=True)
    return h, np.bincount(at, weights=np.concatenate([n for _, n in seen]), minlength=len(h)).astype(np.int64)


def _held(batches):
    """``g, n``: how many of these documents hold each word."""
    for b in slices(batches, 0, _TEXT_BATCH):
        words, per_doc = split_words(b.column(0))
        enc = words.dictionary_encode()
        own = lexical_hashes(enc.dictionary)
        h, at = np.unique(own, return_inverse=True)
        pairs = np.unique(np.repeat(np.arange(len(per_doc)) * max(1, len(h)), per_doc) + at[enc.indices.to_numpy(zero_copy_only=False)])
        n = np.bincount(pairs % max(1, len(h)), minlength=len(h))
        yield pa.RecordBatch.from_arrays([pa.array(h[h != 0].view(np.int64)), pa.array(n[h != 0])], names=["g", "n"])


def common_words(docs: DataFrame, most: int, sample: int = 4096) -> np.ndarray:
    """Hashes of at most ``most`` words, those of a sample of about ``sample`` documents that most of them hold. They are not
    written with each document, but listed with exact counts: the sample decides how a word's count is told, not the count."""
    rows = docs.count()
    some = docs.select("text") if rows <= sample else docs.select("text").sample(sample / rows, seed=1)
    top = some.mapInArrow(_held, "g bigint, n bigint").groupBy("g").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "g").limit(most)
    return np.sort(top.select("g").toArrow().column(0).combine_chunks().to_numpy().view(np.uint64))


def _totals(most: int, common: np.ndarray):
    """Of the words of whole buckets that two documents or more hold, with their number: the ``most`` most frequent (kind 0), the
    ``common`` (5), and for each task of the survey those it has met (4, packed)."""

    def run(batches):
        parts = [(*_unpacked(b.column(1), np.uint64), _unpacked(b.column(2), np.int64)[0], b.column(0).to_numpy()) for b in batches]
        if not parts:
            return
        g, n = np.concatenate([x[0] for x in parts]), np.concatenate([x[2] for x in parts])
        task = np.concatenate([np.repeat(x[3] >> _PLACE_BITS, x[1]) for x in parts])
        words, at = np.unique(g, return_inverse=True)
        total = np.bincount(at, weights=n, minlength=len(words)).astype(np.int64)
        names = ["kind", "place", "g", "n", "gs", "ns"]
        shared = np.flatnonzero(total > 1)
        top = shared if len(shared) <= most else shared[np.lexsort((words[shared].view(np.int64), -total[shared]))[:most]]
        for kind, own in ((0, top), (5, shared[_among(common, words[shared])])):
            for i in range(0, len(own), 1 << 18):
                x = own[i : i + (1 << 18)]
                none = pa.nulls(len(x), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), kind, np.int32)), pa.nulls(len(x), pa.int64()), pa.array(words[x].view(np.int64)), pa.array(total[x]), none, none], names=names)
        use = total[at] > 1
        task, at = task[use], at[use]
        order = np.argsort(task, kind="stable")
        task, at = task[order], at[order]
        first = _runs(task)
        sizes, none = np.diff(np.r_[first, len(task)]), pa.nulls(len(first), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), 4, np.int32)), pa.array(task[first] << _PLACE_BITS), none, none, _packed(words[at], sizes), _packed(total[at], sizes)], names=names)

    return run


def survey(docs: DataFrame, st: Staged, most: int = 1 << 18, n_keys: int = 2) -> tuple[DataFrame, Lexicon]:
    """``doc_id, text, k0, k1, place, gs`` of the documents (``doc_id, text``), written, and their lexicon; of its words at most
    ``most`` and a quarter reach the driver. The first has the counts of all words as ``_counts``."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = [f"k{i}" for i in range(n_keys)]
    common = common_words(docs, most // 4)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = st.write(docs.mapInArrow(_survey(n_keys, common, buckets), f"kind int, doc_id {kind}, text string, {', '.join(f'{k} bigint' for k in names)}, place bigint, bucket int, gs binary, ns binary"), "packing-survey")
    own = both.where("kind = 0").select("bucket", "place", "gs", "ns").repartition(buckets, "bucket").select("place", "gs", "ns")
    counts = st.write(own.mapInArrow(_totals(most, common), "kind int, place bigint, g bigint, n bigint, gs binary, ns binary"), "packing-counts")
    totals = {r.kind: r.n for r in both.where("kind in (1, 2)").groupBy("kind").agg(F.sum("place").alias("n")).collect()}

    def told(df):
        t = df.select("g", "n").toArrow()
        g, n = (t.column(i).combine_chunks().to_numpy() for i in range(2))
        return g.view(np.uint64), n

    words, left = counts.where("kind = 0"), most
    for r in words.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).toLocalIterator():
        least = r.n
        if r.words >= left:
            break
        left -= r.words
    else:
        least = 1  # all are listed
    listed = zip(told(words.where(f"n > {least}")), told(words.where(f"n = {least}").orderBy("g").limit(left)), strict=True)
    lexicon = Lexicon(totals.get(1, 0), totals.get(2, 0), *map(np.concatenate, listed), most)
    lexicon.add(*told(counts.where(f"kind = 5 and n < {lexicon.other}")))
    keyed = both.where("kind = 3").select("doc_id", "text", *names, "place", "gs")
    keyed._counts = counts
    return keyed, lexicon


def _rare(below: int, n_order: int):
    """Rows of a task of the survey, first what is told of its words (``first`` 0), then its documents: of these the columns of
    the order and the words that fewer than ``below`` documents hold, of each that has some."""

    def run(batches):
        task, parts, words, n = None, [], None, None
        for b in batches:
            tasks, first = b.column(0).to_numpy(), b.column(1).to_numpy()
            cuts = _runs(tasks * 2 + first)
            for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), b.num_rows], strict=True):
                if tasks[i] != task:
                    task, parts, words = tasks[i], [], None
                x = b.slice(i, j - i)
                gs, sizes = _unpacked(x.column(n_order + 2), np.uint64)
                if not first[i]:
                    ns, _ = _unpacked(x.column(n_order + 3), np.int64)
                    parts.append((gs[ns < below], ns[ns < below]))
                    continue
                if words is None:
                    words, n = (np.concatenate([np.empty(0, k), *(p[c] for p in parts)]) for c, k in enumerate((np.uint64, np.int64)))
                    order = np.argsort(words)
                    words, n = words[order], n[order]
                if not len(words):
                    continue
                at = np.minimum(np.searchsorted(words, gs), len(words) - 1)
                hit = words[at] == gs
                held = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[hit], minlength=len(sizes))
                some = held > 0
                pair = pa.StructArray.from_arrays([pa.array(gs[hit].view(np.int64)), pa.array(n[at[hit]])], names=["g", "n"])
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(held[some])].astype(np.int32)), pair)
                docs = x.filter(pa.array(some))
                yield pa.RecordBatch.from_arrays([*docs.columns[2 : n_order + 2], lists], names=[*b.schema.names[2 : n_order + 2], "rare"])

    return run


def rare_words(keyed: DataFrame, counts: DataFrame, order: list[str], lexicon: Lexicon, st: Staged) -> DataFrame | None:
    """``rare`` for the columns ``order`` of ``keyed``: the words that two documents or more hold and fewer than hold the rarest
    listed one, each ``g`` with their number ``n``, of each document that has some. None where there are no such words.

    Each task of the survey is told of the words it has met, and looks them up in its documents: a row for a task and a
    bucket of words, and one for a document."""
    if lexicon.other <= 2:
        return None
    kinds = ", ".join(f"{c} {keyed.schema[c].dataType.simpleString()}" for c in order)
    task = F.shiftright("place", _PLACE_BITS).alias("_task")
    docs = keyed.select(task, F.lit(1).alias("_first"), *order, F.col("gs").alias("_gs"), F.lit(None).cast("binary").alias("_ns")).where("length(_gs) > 0")
    told = counts.where("kind = 4").select(task, F.lit(0).alias("_first"), *(F.lit(None).cast(keyed.schema[c].dataType).alias(c) for c in order), F.col("gs").alias("_gs"), F.col("ns").alias("_ns"))
    own = docs.unionByName(told).repartition("_task").sortWithinPartitions("_task", "_first")
    return st.write(own.mapInArrow(_rare(lexicon.other, len(order)), f"{kinds}, rare array<struct<g:bigint,n:bigint>>"), "packing-rare")


class Told:
    """Rows ``doc_id, text`` of batches ``doc_id, text, rare``, in which a document's rare words come in a row before it, without
    text; and the words of the last batches, which are enough for the documents not yet given."""

    def __init__(self, batches):
        self.batches, self.rare = batches, []

    def __iter__(self):
        for b in self.batches:
            flat = b.column(2).flatten()
            g, n = (x.to_numpy(zero_copy_only=False) for x in flat.flatten())
            self.rare.append((g, n))
            if b.column(1).null_count:
                b = b.filter(b.column(1).is_valid())
            if b.num_rows:
                yield b.select([0, 1])

    def forget(self) -> None:
        """What batches before the last two told."""
        del self.rare[:-2]


class Index:
    """BM25 inverted index of one shard, with the statistics of the whole corpus. Words that one document of the shard has
    lead nowhere and have no postings. ``words`` are places in ``hashes`` (0: no word) of all documents, one after another."""

    def __init__(self, words: np.ndarray, hashes: np.ndarray, per_doc: np.ndarray, lexicon: Lexicon, k1: float = 1.2, b: float = 0.75):
        self.n = len(per_doc)
        places = np.flatnonzero(np.bincount(words, minlength=1))
        distinct, at = np.unique(hashes[places], return_inverse=True)
        number = np.zeros(len(hashes), np.int64)
        number[places] = at
        words = number[words]
        size = max(1, len(distinct))
        pairs = np.sort(np.repeat(np.arange(self.n) * np.int64(size), per_doc) + words)
        first = _runs(pairs)
        tf = np.diff(np.r_[first, len(pairs)])
        doc, term = np.divmod(pairs[first], size)
        shared = np.bincount(term, minlength=size) > 1
        shared[: len(distinct)] &= distinct != 0
        use = shared[term]
        doc, term, tf = doc[use], term[use], tf[use]
        idf = np.zeros(size)
        idf[: len(distinct)] = lexicon.idf(distinct)
        norm = k1 * (1 - b + b * per_doc / lexicon.mean)
        weight = idf[term] * tf * (k1 + 1) / (tf + norm[doc])
        # forward: each document's shared words, all of which a query asks for
        self.forward, self.forward_at = term, np.r_[0, np.cumsum(np.bincount(doc, minlength=self.n))]
        order = np.argsort(term, kind="stable")
        self.docs, self.weights = doc[order].astype(np.int32), weight[order]
        self.at = np.r_[0, np.cumsum(np.bincount(term, minlength=size))]

    def neighbours(self, d: int, used: np.ndarray) -> Iterator[int]:
        """Unused documents with a positive score for document d, the best first."""
        terms = self.forward[self.forward_at[d] : self.forward_at[d + 1]]
        at = ranges(self.at[terms], self.at[terms + 1] - self.at[terms])
        score = np.bincount(self.docs[at], weights=self.weights[at], minlength=self.n)
        score[used] = 0
        found = np.flatnonzero(score)
        if len(found) > 64:
            top = found[np.argpartition(-score[found], 63)[:64]]
            yield from top[np.argsort(-score[top], kind="stable")].tolist()
            found = np.setdiff1d(found, top, assume_unique=True)
        yield from found[np.argsort(-score[found], kind="stable")].tolist()


def fill(lengths: np.ndarray, index: Index, window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of one shard.

    Each seed, the first unused document, is laid down and followed by its neighbours. A document that passes the end of
    the window is cut; what is left of it begins the next one and asks for neighbours in turn. Without neighbours left
    the next seed continues the window. The shard's last, unfilled window is cut at powers of two, which need no padding.
    """
    used = np.zeros(len(lengths), bool)
    pieces: list[tuple[int, int, int, int, int]] = []
    seq, room = 0, window

    def put(d: int) -> bool:
        nonlocal seq, room
        used[d] = True
        start, total, passed = 0, int(lengths[d]), False
        while start < total:
            take = min(room, total - start)
            pieces.append((d, start, take, seq, window - room))
            start, room = start + take, room - take
            if not room:
                seq, room, passed = seq + 1, window, True
        return passed

    for seed in range(len(lengths)):
        if used[seed]:
            continue
        put(seed)
        now: int | None = seed
        while now is not None and room < window:
            ask, now = now, None
            for d in index.neighbours(ask, used):
                if put(d):
                    now = d
                    break
    tail = []
    while pieces and pieces[-1][3] == seq:
        tail.append(pieces.pop())
    left = window - room
    bits = [1 << i for i in range(left.bit_length() - 1, -1, -1) if left >> i & 1]
    at = 0
    for d, start, length, _, _ in reversed(tail):
        while length:
            take = min(length, bits[0] - at)
            pieces.append((d, start, take, seq, at))
            start, length, at = start + take, length - take, at + take
            if at == bits[0]:
                bits, seq, at = bits[1:], seq + 1, 0
    return pieces


def pack_documents(docs: DataFrame, vocabulary: str, window: int = 4096, end_id: int = 2, shard_bytes: int = 6 << 20, listed: int = 1 << 18, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids`` (little-endian unsigned 32-bit).

    A document's ids are the tokenizer's, then ``end_id``; null and empty texts are that one id. Every id lies in one
    piece, and the pieces of a sequence follow each other from offset 0. A shard has one window at most that is not full,
    and that one is cut at powers of two: no sequence needs padding. Rows with equal identifiers are documents of their
    own; repeated rows too. An empty table gives no pieces; other columns are ignored; a text longer than a shard is a
    shard.

    One pass counts over the whole table how many documents hold each word (``Lexicon``) and gives each document two of
    its words as lexical keys (``lexical_keys``). The table is dealt out in ranges of (keys, identifier, text, place): documents that
    share many words become neighbours wherever they stood, and a key of any frequency is split over ranges, rows repeated whole too. The
    counts of the ``listed`` most frequent words go to all tasks, those of rarer ones with the documents that hold them. A shard of
    the index is at most ``shard_bytes`` of text of a range; its BM25 weights are those of the whole corpus, and a query asks
    for all words that the document shares in its shard. What the keys do not bring together is not found.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    d = narrow(docs, doc_id=id_col, text=text_col).select("doc_id", text_or_empty().alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    st = Staged(spark)
    keyed, lexicon = survey(d, st, listed)
    counts = keyed._counts
    order = ["k0", "k1", "doc_id", "mark", "place"]  # the place parts rows that are repeated whole
    keyed = keyed.withColumn("mark", F.xxhash64("text"))
    rare = rare_words(keyed, counts, order, lexicon, st)
    st.drop(counts)
    d = keyed.select(*order, "text", F.lit(None).cast("array<struct<g:bigint,n:bigint>>").alias("rare"))
    if rare is not None:
        d = d.unionByName(rare.withColumn("text", F.lit(None).cast("string")))
    d = d.repartitionByRange(*order).sortWithinPartitions(*order, F.col("text").isNotNull()).select("doc_id", "text", "rare")
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]

    def run(batches):
        from pyspark import TaskContext

        enc = encoder(vocabulary, lexical_hashes)
        sequence = TaskContext.get().partitionId() << 32
        told = Told(batches)
        for shard in shards(told, shard_bytes):
            enc.trim()
            lexicon.told(told.rare)
            told.forget()
            parts = [enc.encode_words(pa.chunked_array([b.column(1) for b in shard]))]
            ids, counts, words, per_doc = (np.concatenate(x) for x in zip(*parts, strict=True))
            lengths = counts + 1
            stream = np.full(len(ids) + len(counts), end_id, "<u4")
            stream[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
            begin = np.cumsum(lengths) - lengths
            pieces = np.array(fill(lengths, Index(words, enc.notes, per_doc, lexicon), window), np.int64).reshape(-1, 5)
            doc_ids = pa.concat_arrays([b.column(0) for b in shard])
            for part in np.array_split(pieces, max(1, len(stream) // (1 << 20))):
                doc, start, length, seq, offset = part.T
                at = begin[doc] + start
                body = stream[ranges(at, length)]
                ids_col = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(np.r_[0, np.cumsum(length * 4)].astype(np.int32)), pa.py_buffer(body)])
                columns = [doc_ids.take(pa.array(doc)), *(pa.array(x) for x in (start, length, lengths[doc], sequence + seq, offset)), ids_col]
                yield pa.RecordBatch.from_arrays(columns, names=names)
            sequence += int(pieces[-1, 3]) + 1 if len(pieces) else 0
            pa.default_memory_pool().release_unused()

    return d.mapInArrow(run, f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")


def shards(batches, most_bytes: int) -> Iterator[list[pa.RecordBatch]]:
    """Runs of rows with at most ``most_bytes`` of text, or one row."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in slices(batches, 1, max(1, most_bytes // 8)):
        n = b.column(1).nbytes
        if held and size + n > most_bytes:
            yield held
            held, size = [], 0
        held.append(b)
        size += n
    if held:
        yield held
