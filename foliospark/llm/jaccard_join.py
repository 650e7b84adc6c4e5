"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence with its transpose."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .bpe import ranges, slices
from .common import Staged, bound_batches, narrow, place_of, placed, text_or_empty
from .components import components
from .words import Windows, mix, split_words, word_hashes

_TEXT_BATCH = 4 << 20
_ZERO = np.zeros(1, np.uint64)
#: Most n-grams that are put last for being frequent. Their choice only orders columns; no result depends on it.
_FREQUENT = 100_000
#: Classes in a tile of the first products; members that it holds at once.
_TILE, _TILE_MEMBERS = 512, 4_000_000
#: Rows of a tile of the last product, and classes that stand in one of its columns; entries held and pairs counted at once.
_ROWS, _BLOCK, _HELD, _PAIRS = 512, 2000, 200_000, 2_000_000


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed n-grams of each text, ascending, one text after another; and how many each has.

    Letters A-Z count as a-z. A text of fewer words than ``n`` has its whole sequence as one; a text without words none.
    """
    lower = pc.ascii_lower(pc.fill_null(texts, ""))  # before any cast: lower-casing a cast of a slice reads wrong bytes
    words, per_doc = split_words(lower)
    w = Windows(word_hashes(words), n)
    size = np.minimum(per_doc, n)
    count = np.where(per_doc > 0, per_doc - size + 1, 0)
    starts = ranges(np.cumsum(per_doc) - per_doc, count)
    h = w.at(starts, np.repeat(size, count))
    ends = np.cumsum(count)
    for i, j in zip((ends - count).tolist(), ends.tolist(), strict=True):
        h[i:j].sort()
    doc = np.repeat(np.arange(len(count)), count)
    new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])] if len(h) else np.empty(0, bool)
    return h[new], np.bincount(doc[new], minlength=len(count))


def set_keys(h: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A 63-bit key of each set: the mixed sum of its mixed members with its size."""
    sums = np.r_[np.uint64(0), np.cumsum(mix(h, _ZERO, 7))]
    end = np.cumsum(count)
    return (mix(sums[end] - sums[end - count], count.astype(np.uint64), 11) >> np.uint64(1)).view(np.int64)


def bit_maps(h: np.ndarray, count: np.ndarray) -> pa.Array:
    """A bit for each remainder of a set's members by its width: the power of two from its size, 64 at least. Null for empty sets."""
    width = np.where(count > 0, np.maximum(64, 1 << np.frexp(np.maximum(count - 1, 1).astype(np.float64))[1].astype(np.int64)), 0)
    begin = np.cumsum(width) - width
    flags = np.zeros(int(width.sum()), bool)
    flags[np.repeat(begin, count) + (h & np.repeat(width - 1, count).astype(np.uint64)).astype(np.int64)] = True
    body = np.packbits(flags, bitorder="little")
    offsets = np.r_[0, np.cumsum(width // 8)].astype(np.int32)
    known = np.packbits(count > 0, bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(count), [pa.py_buffer(known), pa.py_buffer(offsets), pa.py_buffer(body)])


def most_common(p: bytes, q: bytes, m: int, n: int) -> int:
    """No fewer members than two sets of sizes m and n have in common, by their ``bit_maps``: each bit that only one has
    is a member at least that the other lacks. The wider map is folded to the width of the other."""
    if len(p) > len(q):
        p, q, m, n = q, p, n, m
    a, b, width = int.from_bytes(p, "little"), int.from_bytes(q, "little"), 8 * len(q)
    while width > 8 * len(p):
        width //= 2
        b = b >> width | b & (1 << width) - 1
    return min(m - (a & ~b).bit_count(), n - (b & ~a).bit_count())


def least_overlap(a, b, num: int, den: int):
    """Fewest common members of sets of sizes a and b whose Jaccard index is num / den or more (works on columns)."""
    return -((-num * (a + b)) // (num + den))


def _frequent(n: int, share: float, most: int = 4_000_000):
    """Local candidates for frequent n-grams: those in more than ``share`` of a partition's texts (4 at least). Of more than
    ``most`` repeated ones, those of less than half that share so far are forgotten."""

    def merged(seen, least):
        v, at = np.unique(np.concatenate([x for x, _ in seen]), return_inverse=True)
        c = np.bincount(at, weights=np.concatenate([x for _, x in seen]), minlength=len(v)).astype(np.int64)
        return v[c >= least], c[c >= least]

    def run(batches):
        seen, texts = [], 0
        for b in slices(batches, 0, _TEXT_BATCH):
            h, _ = shingle_sets(b.column(0), n)
            texts += b.num_rows
            h = np.sort(h).view(np.int64)
            at = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, np.int64)
            c = np.diff(np.r_[at, len(h)])
            seen.append((h[at[c > 1]], c[c > 1]))
            if sum(len(v) for v, _ in seen) > most:
                seen = [merged(seen, share * texts / 2)]
        if seen:
            v, c = merged(seen, max(4, share * texts))
            yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(c)], names=["g", "n"])

    return run


def _put_late(h: np.ndarray, late: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The members again, document by document, those marked late behind the others."""
    n = np.bincount(doc)
    begin = np.cumsum(n) - n
    early = np.cumsum(~late) - ~late  # of all before
    first = np.r_[0, np.cumsum(~late)][begin]
    many = np.bincount(doc, weights=~late).astype(np.int64)
    place = np.arange(len(h)) - begin[doc]
    done = early - first[doc]
    out = np.empty_like(h)
    out[begin[doc] + np.where(late, many[doc] + place - done, done)] = h
    return out


def _columns(n: int, num: int, den: int, often: np.ndarray):
    """Per text its set's key and size; and for the first text of a partition with that set, the columns of its prefix and
    its bit map.

    The prefix is all but the last ``ceil(t |A|) - 1`` members in the order (frequent later, then hash): two sets of that
    index share a member of both prefixes.
    """

    def run(batches):
        known: set[int] = set()
        for b in slices(batches, 2, _TEXT_BATCH):
            h, count = shingle_sets(b.column(2), n)
            keys = set_keys(h, count)
            fresh = np.zeros(len(keys), bool)
            for i, k in enumerate(keys.tolist()):
                if count[i] and k not in known:
                    known.add(k)
                    fresh[i] = True
            doc = np.repeat(np.arange(len(count)), count)
            use = fresh[doc]
            h, doc = h[use], doc[use]
            bits = bit_maps(h, np.where(fresh, count, 0))
            if len(often):
                at = np.minimum(np.searchsorted(often, h.view(np.int64)), len(often) - 1)
                late = often[at] == h.view(np.int64)
                h = _put_late(h, late, doc)
            size = np.where(fresh, count, 0)
            prefix = np.where(fresh, count + (-num * count) // den + 1, 0)
            begin = np.cumsum(size) - size
            g = h[ranges(begin, prefix)].view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(prefix)].astype(np.int32)), pa.array(g))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys), pa.array(count.astype(np.int64)), lists, bits], names=["doc_id", "mark", "c", "n", "gs", "bits"])

    return run


def _sets(n: int):
    def run(batches):
        for b in slices(batches, 2, _TEXT_BATCH):
            h, count = shingle_sets(b.column(2), n)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)].astype(np.int32)), pa.array(h.view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], names=["k", "c", "hs"])

    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The product of an incidence matrix with its transpose: how many members each two of the sets share."""
    members = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(members, kind="stable")
    members, row = members[order], row[order]
    new = np.r_[True, members[1:] != members[:-1]]
    column = np.cumsum(new) - 1
    shared = np.bincount(column) > 1
    use = shared[column]
    row, column = row[use], (np.cumsum(shared) - 1)[column[use]]
    out = np.zeros((len(sets), len(sets)), np.float32)
    width = max(1, (8 << 20) // max(1, len(sets)))
    edge = np.searchsorted(column, np.arange(0, int(shared.sum()) + width, width))
    for k, (i, j) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)):
        block = np.zeros((len(sets), min(width, int(shared.sum()) - k * width)), np.float32)
        block[row[i:j], column[i:j] - k * width] = 1
        out += block @ block.T
    return out.astype(np.int64)


def _forest(ids: list[int], sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Pairs of each class with the first one of its component in the tile, if it is not the first itself."""
    if len(ids) < 2:
        return []
    common = overlaps(sets)
    size = np.array([len(x) for x in sets])
    a, b = np.nonzero(np.triu(den * common >= num * (size[:, None] + size[None, :] - common), 1))
    root = list(range(len(ids)))

    def first(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        x, y = first(i), first(j)
        root[max(x, y)] = min(x, y)
    return [(ids[first(i)], ids[i]) for i in range(len(ids)) if first(i) != i]


def _tiles(n: int, num: int, den: int):
    """The product of each run of rows ``k, c, text`` with one key, in tiles of bounded size."""

    def run(batches):
        now, ids, sets, held = None, [], [], 0
        for b in slices(batches, 2, _TEXT_BATCH):
            keys, names = b.column(0).to_pylist(), b.column(1).to_pylist()
            flat, count = shingle_sets(b.column(2), n)
            at = np.r_[0, np.cumsum(count)]
            flat, out = flat.view(np.int64), []
            for i, (k, c) in enumerate(zip(keys, names, strict=True)):
                if k != now or len(ids) >= 2 * _TILE or held > _TILE_MEMBERS:
                    out += _forest(ids, sets, num, den)
                    now, ids, sets, held = k, [], [], 0
                ids.append(c)
                sets.append(flat[at[i] : at[i + 1]].copy())
                held += int(at[i + 1] - at[i])
            if out:
                yield _edges(out)
        if out := _forest(ids, sets, num, den):
            yield _edges(out)

    return run


def _products(num: int, den: int):
    """The tiles of the last product: rows ``k, buckets, r, mine, x, n, label, home, gs, largest`` sorted by the first three, of
    which ``mine`` are rows of the tile with the columns they meet, and the others classes that stand in a column.

    Gives ``a, b, o, need``: o columns that the pair shares, of which at least ``need`` must be found over both its rows.
    A row meets the columns whose largest label is not its own; ``home`` is how many of its columns it does not meet. A
    column that the other class does not meet counts here, one that both meet in the smaller one's row: once in all.
    Pairs of one label, of sizes too far apart, or that miss the need even if they share all ``home`` columns are
    discarded.
    """

    def flat(parts):
        tile, mine = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        x, n, label, home, count = (np.concatenate([p[i] for p in parts]) for i in range(2, 7))
        g, largest = (np.concatenate([p[i] for p in parts]) for i in (7, 8))
        row = np.repeat(np.arange(len(x)), count)
        # columns are those of a tile: one number for each tile and n-gram
        order = np.lexsort((g, tile[row]))
        new = np.r_[True, (g[order][1:] != g[order][:-1]) | (tile[row][order][1:] != tile[row][order][:-1])]
        column = np.empty(len(g), np.int64)
        column[order] = np.cumsum(new) - 1
        block = np.flatnonzero(~mine[row])
        block = block[np.argsort(column[block], kind="stable")]
        size = np.bincount(column[block], minlength=int(new.sum()))
        begin = np.cumsum(size) - size
        ask = np.flatnonzero(mine[row])
        many = size[column[ask]]
        total, i = np.cumsum(many), 0
        names, place = np.unique(x, return_inverse=True)
        while i < len(ask):  # whole rows, some million pairs at a time
            j = int(np.searchsorted(total, (total[i - 1] if i else 0) + _PAIRS, "right"))
            j = max(j, i + 1)
            while j < len(ask) and row[ask[j]] == row[ask[j - 1]]:
                j += 1
            e = ask[i:j]
            u = np.repeat(e, many[i:j])
            other = row[block[ranges(begin[column[e]], many[i:j])]]
            own, top = row[u], largest[u]
            use = (label[other] != label[own]) & (num * np.maximum(n[other], n[own]) <= den * np.minimum(n[other], n[own]))
            own, other, top = own[use], other[use], top[use]
            counts = (label[other] == top) | (x[other] > x[own])
            i = j
            if not len(own):
                continue
            code = np.sort((own * np.int64(len(names)) + place[other]) << 1 | counts)
            first = np.flatnonzero(np.r_[True, code[1:] >> 1 != code[:-1] >> 1])
            seen = np.diff(np.r_[first, len(code)])
            o = np.add.reduceat(code & 1, first)
            own, c = np.divmod(code[first] >> 1, len(names))
            sizes = np.empty(len(names), np.int64)
            sizes[place] = n
            m, k, c = sizes[c], n[own], names[c]
            rest = np.maximum(-(-num * m // den), -(-num * k // den)) - 1
            need = least_overlap(m, k, num, den) - rest
            use = (o > 0) & (seen + home[own] >= need)
            if use.any():
                a = x[own]
                found = np.minimum(a, c)[use], np.maximum(a, c)[use], o[use], need[use]
                yield pa.RecordBatch.from_arrays([pa.array(f.astype(np.int64)) for f in found], names=["a", "b", "o", "need"])

    def run(batches):
        parts, held, last, number = [], 0, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            k, buckets, r = (b.column(i).to_numpy() for i in range(3))
            new = np.r_[last != (k[0], buckets[0], r[0]), (k[1:] != k[:-1]) | (buckets[1:] != buckets[:-1]) | (r[1:] != r[:-1])]
            tile, last, begin = number + np.cumsum(new), (k[-1], buckets[-1], r[-1]), 0
            number = int(tile[-1])
            for end in [*(np.flatnonzero(new) if held > _HELD else np.flatnonzero(new)[-1:]).tolist(), len(k)]:
                if end > begin:
                    part = b.slice(begin, end - begin)
                    gs, ls = part.column(8), part.column(9)
                    values = (part.column(i).to_numpy() for i in range(4, 8))
                    count = pc.list_value_length(gs).to_numpy()
                    parts.append((tile[begin:end], part.column(3).to_numpy(zero_copy_only=False), *values, count, gs.flatten().to_numpy(), ls.flatten().to_numpy()))
                    held += int(count.sum())
                if end < len(k) and held > _HELD:
                    yield from flat(parts)
                    parts, held = [], 0
                begin = end
        if parts:
            yield from flat(parts)

    return run


def _band(n, num: int, den: int):
    """Sizes that a link allows are in one band or in neighbours (a little wide, for rounding)."""
    return F.floor(F.log(n) / math.log(den / num * (1 + 1e-9))).cast("long")


def _edges(rows):
    a, b = np.array(rows, np.int64).T
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _possible(num: int, den: int):
    """Of pairs ``cx, cy, nx, ny, bx, by`` those whose bit maps do not rule out that they link."""

    def run(batches):
        for b in batches:
            m, n = b.column(2).to_numpy(), b.column(3).to_numpy()
            most = zip(b.column(4).to_pylist(), b.column(5).to_pylist(), m.tolist(), n.tolist(), strict=True)
            o = np.fromiter((most_common(*x) for x in most), np.int64, b.num_rows)
            yield b.select([0, 1]).filter(pa.array(den * o >= num * (m + n - o)))

    return run


def _verify(num: int, den: int):
    def run(batches):
        for b in batches:
            out = []
            for x, y, p, q in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
                p, q = p.values.to_numpy(), q.values.to_numpy()
                common = len(p) + len(q) - len(np.union1d(p, q))
                if den * common >= num * (len(p) + len(q) - common):
                    out.append((x, y))
            if out:
                yield _edges(out)

    return run


def jaccard_classes(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text", rounds: int = 2) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``, linking sets with Jaccard index ``num / den`` or more.

    Sets are those of ``shingle_sets``; a text without words has none, links with nothing and is its own component. The
    component is the smallest identifier reachable by links. Rows with equal sets are one class (so are repeated rows),
    whatever their number, and only classes are compared. Null identifiers come last; an empty table gives an empty
    result; other columns are ignored.

    The product. Rows are classes, columns n-grams. Of a class only its prefix is multiplied: by the size-derived bound
    on the overlap, two classes that link share a column of both prefixes. Columns of one class alone give no product and
    go first. First products: in each round a class goes with one of its columns to a tile of bounded size, tiles are
    multiplied whole and exactly, and what links is contracted, so of a large group of near copies little is left. Last
    product: the columns' classes stand in blocks; a class that is not of its column's largest component meets them and
    adds up its counts over its columns. Classes of like sizes that share their most frequent column make a tile, to which
    a block goes once, with the sizes that can link, not once for each of its rows. The counts of a pair's two rows, with
    each column in one of them, are added; pairs below the overlap that their sizes ask for within the prefixes are
    discarded, then those whose bit maps (``bit_maps``) show more differences than a link allows; the rest are counted
    exactly on their whole sets. No link between
    different components is left out, whatever a group's size; links within one are not looked for again.
    Which n-grams are frequent, and so come last in a prefix, is counted over all texts; it changes the work, never the
    result. Sets are compared by 64-bit hashes of their members, classes by a 63-bit key with the size.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    st = Staged(spark)
    d = narrow(docs, doc_id=id_col, text=text_col).select("doc_id", text_or_empty().alias("text"))
    d = d.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    kind = d.schema["doc_id"].dataType.simpleString()
    # frequent n-grams: a list of bounded length
    counts = d.select("text").mapInArrow(_frequent(n, 1 / 500), "g bigint, n bigint").groupBy("g").agg(F.sum("n").alias("n"))
    counts = st.write(counts, "jaccard-counts")
    often = np.sort(np.array([r.g for r in counts.orderBy(F.desc("n"), "g").limit(_FREQUENT).collect()], np.int64))
    rows = st.write(d.mapInArrow(_columns(n, num, den, often), f"doc_id {kind}, mark bigint, c bigint, n bigint, gs array<bigint>, bits binary"), "jaccard-rows")
    # columns that more than one class has
    cols = rows.select(F.explode("gs").alias("g"), "c", "n")
    shared = st.write(cols.groupBy("g").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("g"), "jaccard-shared")
    cols = st.write(cols.join(shared, "g").distinct(), "jaccard-columns")
    slim = st.write(rows.select("doc_id", "mark", "c", "n"), "jaccard-classes")
    maps = st.write(rows.where("bits is not null").select("c", "n", "bits"), "jaccard-maps")
    st.drop(rows, shared, counts)
    rows, one = slim, st.write(slim.where("n > 0").groupBy("c").agg(F.min(F.struct("doc_id", "mark")).alias("one")), "jaccard-one")

    def texts(of: DataFrame) -> DataFrame:
        """``k, c, text`` for ``k, c``: sets are made again from the texts, which take less disk than they."""
        need = one.join(of, "c").select("k", "c", F.col("one.doc_id").alias("i"), F.col("one.mark").alias("m"))
        found = d.join(need, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("mark") == F.col("m")))
        return (found.dropDuplicates(["c"]) if repeated else found).select("k", "c", "text")

    repeated = not rows.groupBy("doc_id", "mark").count().where("count > 1").isEmpty()
    # first products: tiles
    found, at = None, cols.withColumn("label", F.col("c"))
    for r in range(rounds):
        # written, so that the rows of a frequent column can be split between tasks
        tiles = st.write(at.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / _TILE).alias("tiles")), "jaccard-column-tiles")
        column = at.groupBy("c").agg(F.min(F.struct(F.xxhash64("g", F.lit(r)), "g")).alias("x")).select("c", F.col("x.g").alias("g"))
        tile = F.xxhash64("g", F.pmod(F.xxhash64("c", F.lit(r)), F.col("tiles")))
        places = st.write(column.join(tiles, "g").select("c", tile.alias("k")), "jaccard-places")
        runs = texts(places).repartition("k").sortWithinPartitions("k", "c")
        new = st.write(runs.mapInArrow(_tiles(n, num, den), "a bigint, b bigint"), "jaccard-tiles")
        st.drop(places, tiles)
        found = new if found is None else st.write(found.unionByName(new), "jaccard-tiles")
        label = components(found, st)
        before, at = at if r else None, _varied(cols.join(label.withColumnRenamed("node", "c"), "c", "left").withColumn("label", F.coalesce("label", "c")), st)
        if before is not None:
            st.drop(before)
    st.drop(cols)
    # the last product: tiles of rows against blocks of columns, each block once for a tile
    largest = at.groupBy("g", "label").agg(F.count(F.lit(1)).alias("m")).groupBy("g").agg(F.max(F.struct("m", "label")).alias("x"), F.sum("m").alias("size"))
    largest = st.write(largest.select("g", F.col("x.label").alias("largest"), "size"), "jaccard-largest")
    met = st.write(at.join(largest, "g").withColumn("band", _band(F.col("n"), num, den)), "jaccard-met")
    st.drop(at, largest)
    blocks = F.ceil(F.col("size") / _BLOCK)
    block = F.pmod(F.xxhash64("c"), blocks)
    rest = F.col("label") != F.col("largest")
    own = F.struct("g", "largest", "size")
    rows_of = met.groupBy(F.col("c").alias("x"), "n", "label", "band").agg(
        F.count(F.when(~rest, 1)).alias("home"), F.collect_list(F.when(rest, own)).alias("own"), F.max(F.when(rest, F.struct("size", "g"))).alias("top")
    )
    # rows that share their most frequent column go together
    part = F.pmod(F.xxhash64("x"), F.ceil(F.col("top.size") / _ROWS))
    rows_of = rows_of.where("top is not null").withColumns({"buckets": F.ceil(F.col("top.size") / _BLOCK), "k": F.xxhash64("top.g", "band", part)})
    rows_of = st.write(rows_of.drop("top"), "jaccard-tile-rows")
    asked = rows_of.select("k", "buckets", F.col("band").alias("mid"), F.explode("own").alias("o")).select("k", "buckets", "mid", "o.g", "o.size").distinct()
    asked = st.write(asked, "jaccard-tile-columns")
    near = F.explode(F.sequence(F.col("mid") - 1, F.col("mid") + 1))
    asked_by = asked.withColumn("band", near).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    standing = met.select("g", "band", block.alias("block"), F.col("c").alias("x"), "n", "label").join(asked_by, ["g", "band", "block"])
    one_column = F.array("g")
    tiles = standing.select("k", "buckets", F.pmod(F.xxhash64("x"), F.col("buckets")).alias("r"), F.lit(False).alias("mine"), "x", "n", "label", F.lit(0).cast("long").alias("home"), one_column.alias("gs"), one_column.alias("largest"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1))
    meeting = rows_of.select("k", "buckets", each.alias("r"), F.lit(True).alias("mine"), "x", "n", "label", "home", F.col("own.g").alias("gs"), F.col("own.largest").alias("largest"))
    tiles = meeting.unionByName(tiles).repartition("k", "buckets", "r").sortWithinPartitions("k", "buckets", "r")
    parts = st.write(tiles.mapInArrow(_products(num, den), "a bigint, b bigint, o bigint, need bigint"), "jaccard-product")
    st.drop(met, rows_of, asked)
    whole = parts.groupBy(F.col("a").alias("cx"), F.col("b").alias("cy")).agg(F.sum("o").alias("o"), F.first("need").alias("need"))
    pairs = st.write(whole.where("o >= need").select("cx", "cy"), "jaccard-pairs")
    st.drop(parts)
    # bit maps, some hundredth of the sets in size, leave few pairs but those that link
    one_map = st.write(maps.join(pairs.select(F.explode(F.array("cx", "cy")).alias("c")).distinct(), "c", "left_semi").dropDuplicates(["c"]), "jaccard-pair-maps")
    mx, my = (one_map.select(F.col("c").alias("c" + z), F.col("n").alias("n" + z), F.col("bits").alias("b" + z)) for z in "xy")
    mapped = pairs.join(mx, "cx").join(my, "cy").select("cx", "cy", "nx", "ny", "bx", "by")
    possible = st.write(mapped.mapInArrow(_possible(num, den), "cx bigint, cy bigint"), "jaccard-possible")
    st.drop(pairs, maps, one_map)
    pairs = possible
    both = pairs.select(F.explode(F.array("cx", "cy")).alias("c")).distinct().withColumn("k", F.lit(0).cast("long"))
    of = st.write(texts(both).mapInArrow(_sets(n), "k bigint, c bigint, hs array<bigint>").select("c", "hs"), "jaccard-sets")
    hx, hy = (of.select(F.col("c").alias("c" + z), F.col("hs").alias("h" + z)) for z in "xy")
    links = st.write(pairs.join(hx, "cx").join(hy, "cy").select("cx", "cy", "hx", "hy").mapInArrow(_verify(num, den), "a bigint, b bigint"), "jaccard-links")
    st.drop(of, pairs, one)
    label = components(found.unionByName(links), st)
    out = rows.select("doc_id", "c", F.col("n").alias("n_shingles")).join(label.withColumnRenamed("node", "c"), "c", "left")
    out = out.withColumn("label", F.when(F.col("n_shingles") > 0, F.coalesce("label", "c")))
    small = st.write(out.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id")), "jaccard-smallest")
    out = out.withColumn("label", F.coalesce("label", -1 - F.abs(F.xxhash64("doc_id"))))
    return out.join(small, "label", "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _varied(at: DataFrame, st: Staged) -> DataFrame:
    """Rows of the columns that classes of more than one label have."""
    at = st.write(at, "jaccard-labelled")
    varied = st.write(at.groupBy("g").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("g"), "jaccard-varied")
    rows = st.write(at.join(varied, "g"), "jaccard-varied-rows")
    st.drop(at, varied)
    return rows


def keep_one(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose identifier stands for its component, with all their columns; rows that repeat such an
    identifier go, and rows without an identifier stay."""
    key = lambda c: F.col(c).cast("string").alias("key")
    found = jaccard_classes(docs, n, num, den, id_col, text_col)
    kept = found.where("doc_id = component_id").select(key("doc_id")).distinct()
    own = placed(docs).columns
    mine = placed(docs).withColumn("key", key(place_of(docs, id_col)))
    named = mine.where("key is not null").join(kept, "key", "left_semi").dropDuplicates(["key"]).select(*own)
    return named.unionByName(mine.where("key is null").select(*own)).toDF(*docs.columns)
