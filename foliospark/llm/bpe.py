"""Byte-pair encoding of whole columns: vectorised merges over distinct fragments between forced boundaries."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import bound_batches, narrow, text_or_empty, worker_state

#: The patterns that split text before merging, byte-level and word-level.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
#: White space by any of the definitions met here; a cut beside one of these is not a sure boundary.
_SPACE = "\\t\\n\\x0b\\x0c\\r \\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
_NONE = np.int32(2**31 - 1)
#: Fragments of more bytes than this are merged one by one from a queue, since a pass over all would be repeated for each
#: of their merges. The merges are the same.
LONG_FRAGMENT = 256


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: printable Latin-1 as itself, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Merges and token bytes of a tokenizer file, as arrays.

    ``inside[x, y]`` tells whether byte y follows byte x inside some token. Where it does not, no merge can ever join
    the two bytes, so the text may be cut there and the fragments encoded one by one.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.alphabet = byte_alphabet()
        to_byte = {c: b for b, c in enumerate(self.alphabet)}
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for t in spec["added_tokens"]:
            self.bytes_of[t["id"]] = t["content"].encode()
        self.inside = np.zeros((256, 256), bool)
        for token, i in vocab.items():
            if token not in self.special:
                body = token.removesuffix(self.suffix) if self.suffix else token
                raw = np.array([to_byte[c] for c in body], np.uint8)
                self.bytes_of[i] = raw.tobytes()
                self.inside[raw[:-1], raw[1:]] = True
        self.base = np.array([vocab.get(c, -1) for c in self.alphabet], np.int32)
        self.last = np.array([vocab.get(c + self.suffix, -1) for c in self.alphabet], np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self._hash(left << 20 | right)

    def _hash(self, keys: np.ndarray) -> None:
        bits = 20
        self.shift = np.uint64(64 - bits)
        at = self._slot(keys)
        self.keys = np.full((1 << bits) + 64, -1, np.int64)
        self.rank = np.full((1 << bits) + 64, _NONE, np.int32)
        self.probes = 1
        self.rank_of: dict[int, int] = {}
        for r, (k, s) in enumerate(zip(keys.tolist(), at.tolist(), strict=True)):
            j = s
            while self.keys[j] != -1 and self.keys[j] != k:
                j += 1
            if self.keys[j] == -1:
                self.keys[j], self.rank[j] = k, r
                self.rank_of[k] = r
            self.probes = max(self.probes, j - s + 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 20 | right
        at = self._slot(keys)
        out = np.where(self.keys[at] == keys, self.rank[at], _NONE)
        for j in range(1, self.probes):
            out = np.where(self.keys[at + j] == keys, self.rank[at + j], out)
        return out

    def merge(self, raw: np.ndarray, ends: np.ndarray, word_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the fragments of ``raw`` that end at ``ends`` (none empty), and how many each has.

        All fragments take their lowest-ranked pair in the same pass; equal overlapping pairs are taken from the left.
        Only pairs beside a merge are looked up again. Finished fragments leave.
        """
        sym = self.base[raw]
        sym[ends[word_end] - 1] = self.last[raw[ends[word_end] - 1]]
        n_frag = len(ends)
        seg = np.repeat(np.arange(n_frag, dtype=np.int32), np.diff(ends, prepend=0))
        rank = np.full(len(sym), _NONE, np.int32)
        joined = np.flatnonzero(seg[1:] == seg[:-1])
        rank[joined] = self.ranks(sym[joined], sym[joined + 1])
        done_sym: list[np.ndarray] = []
        done_seg: list[np.ndarray] = []
        while len(sym):
            starts = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
            low = np.minimum.reduceat(rank, starts)
            over = low == _NONE
            count = np.diff(np.r_[starts, len(sym)])
            if over.any():
                gone = np.repeat(over, count)
                done_sym.append(sym[gone])
                done_seg.append(seg[gone])
                stay = ~gone
                sym, seg, rank, low, count = sym[stay], seg[stay], rank[stay], low[~over], count[~over]
                if not len(sym):
                    break
            hit = rank == np.repeat(low, count)
            if (hit[1:] & hit[:-1]).any():
                i = np.arange(len(hit))
                first = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], i, 0))
                hit &= (i - first) % 2 == 0
            at = np.flatnonzero(hit)
            sym[at] = self.made[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            now = at - np.arange(len(at))  # places after the right halves have gone
            sym, seg, rank = sym[keep], seg[keep], rank[keep]
            touched = np.zeros(len(sym), bool)
            touched[now] = True
            touched[now[now > 0] - 1] = True
            again = np.flatnonzero(touched)
            rank[again] = _NONE
            again = again[again < len(sym) - 1]
            again = again[seg[again] == seg[again + 1]]
            rank[again] = self.ranks(sym[again], sym[again + 1])
        ids, where = np.concatenate(done_sym), np.concatenate(done_seg)
        order = np.argsort(where, kind="stable")
        return ids[order], np.bincount(where, minlength=n_frag)

    def encode_pieces(self, pieces: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each non-empty piece (a word before merging), cut at forced boundaries; and how many each has."""
        offsets = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        raw = np.frombuffer(pieces.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        piece_ends = offsets[1:] - offsets[0]
        cut = np.zeros(len(raw), bool)
        cut[:-1] = ~self.inside[raw[:-1], raw[1:]]
        cut[piece_ends - 1] = True
        ends = np.flatnonzero(cut) + 1
        last = np.searchsorted(ends, piece_ends)
        word_end = np.zeros(len(ends), bool)
        word_end[last] = bool(self.suffix)
        ids, counts = self._fragments(raw, ends, np.diff(ends, prepend=0), word_end)
        return ids, np.diff(np.cumsum(counts)[last], prepend=0)

    def _fragments(self, raw, ends, sizes, word_end):
        long = np.flatnonzero(sizes > LONG_FRAGMENT)
        if not len(long):
            return self.merge(raw, ends, word_end)
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        begin = 0
        for i in [*long.tolist(), len(ends)]:
            if i > begin:
                lo = ends[begin - 1] if begin else 0
                a, c = self.merge(raw[lo : ends[i - 1]], ends[begin:i] - lo, word_end[begin:i])
                ids.append(a)
                counts.append(c)
            if i < len(ends):
                ids.append(a := self._queued(raw[ends[i] - sizes[i] : ends[i]], bool(word_end[i])))
                counts.append(np.array([len(a)]))
            begin = i + 1
        return np.concatenate(ids), np.concatenate(counts)

    def _queued(self, raw: np.ndarray, word_end: bool) -> np.ndarray:
        """Ids of one fragment: the lowest-ranked pair of all, the leftmost on a tie, is taken from a heap until none is
        left; pairs that a merge has outdated are passed over."""
        sym = self.base[raw]
        if word_end:
            sym[-1] = self.last[raw[-1]]
        first = self.ranks(sym[:-1], sym[1:])
        heap = [(int(first[i]), i) for i in np.flatnonzero(first != _NONE).tolist()]
        heapq.heapify(heap)
        ids: list[int] = sym.tolist()
        after, before = [*range(1, len(ids)), -1], list(range(-1, len(ids) - 1))
        made = self.made

        def offer(i: int) -> None:
            if i >= 0 and (j := after[i]) >= 0 and (r := self.rank_of.get(ids[i] << 20 | ids[j])) is not None:
                heapq.heappush(heap, (r, i))

        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or self.rank_of.get(ids[i] << 20 | ids[j]) != r:
                continue
            ids[i], ids[j], after[i] = int(made[r]), -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return np.array([x for x in ids if x >= 0], np.int32)


class Encoder:
    """Encodes batches of texts; remembers the ids of chunks already seen, up to ``limit`` chunks, and of each the number
    that ``note`` gives it."""

    def __init__(self, path: str, limit: int = 600_000, note: Callable[[pa.LargeStringArray], np.ndarray] | None = None):
        import regex

        self.vocab = Vocabulary(path)
        self.limit, self.note = limit, note
        self.byte_level = not self.vocab.suffix
        self.pattern = regex.compile(BYTE_PATTERN if self.byte_level else WORD_PATTERN)
        self.special = re.compile(f"({'|'.join(map(re.escape, self.vocab.special)) or '(?!)'})")
        letters, marks = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", r"!-&(-/:-@\[-`{-~"
        self.plain = f"^(?P<core>{' ?' * self.byte_level}[{letters}]+)(?P<tail>[{marks}]*)$"
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.flat = np.empty(1 << 16, np.int32)
        self.used = 0
        self.start = np.empty(1 << 14, np.int64)
        self.count = np.empty(1 << 14, np.int32)
        self.notes = np.empty(1 << 14, np.uint64)

    # -- chunks -> ids
    def _pieces(self, chunk: str) -> list[str]:
        if self.byte_level:
            body = chunk[1:] if chunk[:1] == " " else chunk
            return [chunk] if body.isalpha() else self.pattern.findall(chunk)
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        chunk = chunk.lower()
        return [chunk] if chunk.isalpha() else self.pattern.findall(chunk)

    def _learn(self, table: pa.LargeStringArray, keys: list[bytes]) -> None:
        """Ids of new chunks. Latin letters with punctuation after them, the common case, are split by the column."""
        found = pc.extract_regex(table, self.plain)
        plain = found.is_valid().to_numpy(zero_copy_only=False)
        found = found.filter(pa.array(plain))
        core, tail = found.field(0), found.field(1)
        core = (core if self.byte_level else pc.utf8_lower(core)).dictionary_encode()
        tail = tail.dictionary_encode()
        n_core, n_tail = len(core.dictionary), len(tail.dictionary)
        known: dict[str, int] = {}
        lists: list[list[int]] = []
        odd = np.flatnonzero(~plain).tolist()
        at = lambda p: known.setdefault(p, len(known)) + n_core + n_tail
        for c in (keys[i].decode() for i in odd):
            if self.special.search(c):  # special tokens are pieces with ids of their own; what stands between them is text
                lists.append([x for part in self.special.split(c) if part for x in ([at(part)] if part in self.vocab.special else map(at, self._pieces(part)))])
            else:
                lists.append(list(map(at, self._pieces(c))))
        pieces = pa.concat_arrays([core.dictionary.cast(pa.large_string()), tail.dictionary.cast(pa.large_string()), pa.array(list(known), pa.large_string())])
        set_ids = np.array([-1] * (n_core + n_tail) + [self.vocab.special.get(p, -1) for p in known], np.int32)
        merged = pc.not_equal(pieces, "").to_numpy(zero_copy_only=False) & (set_ids < 0)
        counts = np.where(set_ids < 0, 0, 1).astype(np.int64)
        found_ids = np.empty(0, np.int32)
        if merged.any():
            found_ids, counts[merged] = self.vocab.encode_pieces(pieces.filter(pa.array(merged)))
        ids = np.empty(int(counts.sum()), np.int32)
        given = np.repeat(set_ids, counts)
        ids[given < 0], ids[given >= 0] = found_ids, given[given >= 0]
        begins = np.cumsum(counts) - counts
        n_plain = int(plain.sum())
        which = np.empty(2 * n_plain, np.int64)
        which[::2], which[1::2] = core.indices.to_numpy(), tail.indices.to_numpy() + n_core
        n_pieces = np.r_[np.full(n_plain, 2, np.int64), np.fromiter(map(len, lists), np.int64, len(lists))]
        which = np.r_[which, np.fromiter((p for x in lists for p in x), np.int64, int(n_pieces[n_plain:].sum()))]
        flat = ids[ranges(begins[which], counts[which])]
        sums = np.r_[0, np.cumsum(counts[which])]
        edge = np.cumsum(n_pieces)
        count = sums[edge] - sums[edge - n_pieces]
        start = self.used + np.cumsum(count) - count
        n, more = len(self.at), len(keys)
        self.start, self.count = grown(self.start, n + more), grown(self.count, n + more)
        self.flat = grown(self.flat, self.used + len(flat))
        self.flat[self.used : self.used + len(flat)] = flat
        self.start[n : n + more], self.count[n : n + more] = start, count
        self.used += len(flat)
        order = [*np.flatnonzero(plain).tolist(), *odd]
        self.at.update(zip(map(keys.__getitem__, order), range(n, n + more), strict=True))
        if self.note:
            self.notes = grown(self.notes, n + more)
            self.notes[n : n + more] = self.note(table)[order]

    def places(self, distinct: pa.LargeStringArray) -> np.ndarray:
        """Places of distinct chunks in ``start`` and ``count``."""
        keys = byte_list(distinct)
        out = np.fromiter(map(self.at.get, keys, repeat(-1)), np.int64, len(keys))
        if (new := np.flatnonzero(out < 0)).size:
            self._learn(distinct.take(pa.array(new)), fresh := [keys[i] for i in new.tolist()])
            out[new] = np.fromiter(map(self.at.__getitem__, fresh), np.int64, len(fresh))
        return out

    # -- texts -> ids
    def trim(self) -> None:
        """Forget all chunks if there are too many; the places of chunks hold until then."""
        if len(self.at) > self.limit:
            self._clear()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        return self.encode_words(texts)[:2]

    def encode_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``encode``, with the place of each chunk, in text order, and how many chunks a text has."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = texts.cast(pa.large_string())
        chunks, per_text, spaced = self._split_bytes(texts) if self.byte_level else self._split_words(texts)
        enc = chunks.dictionary_encode()
        distinct = enc.dictionary
        which = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if spaced is None or not len(distinct):
            where = self.places(distinct)[which]
        else:  # the chunks of plain texts are without the space before them, except a text's first
            need = np.unique(which[~spaced])
            with_space = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), distinct, pa.scalar("", pa.large_string()))
            both = self.places(pa.concat_arrays([with_space, distinct.take(pa.array(need))]))
            where = both[which]
            where[~spaced] = both[len(distinct) + np.searchsorted(need, which[~spaced])]
        count = self.count[where].astype(np.int64)
        ids = self.flat[ranges(self.start[where], count)]
        sums = np.r_[0, np.cumsum(count)]
        edge = np.cumsum(per_text)
        return ids, sums[edge] - sums[edge - per_text], where, per_text

    def _split_words(self, texts):
        lists = pc.ascii_split_whitespace(texts)
        per = np.diff(lists.offsets.to_numpy(zero_copy_only=False)).astype(np.int64)
        return lists.flatten(), per, None

    def _split_bytes(self, texts):
        """Chunks that end after a non-space and begin with white space: the pattern never looks back, and no match
        runs from a non-space into white space. Texts with nothing but single spaces between words are cut at these by
        the column; the others one by one."""
        odd = pc.match_substring_regex(texts, f"[{_SPACE}] | [{_SPACE}]").to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts, " ")
        per = np.diff(lists.offsets.to_numpy(zero_copy_only=False)).astype(np.int64)
        flat = lists.flatten()
        spaced = np.ones(len(flat), bool)
        spaced[np.cumsum(per) - per] = False
        if odd.any():
            cut = re.compile(r"\s*\S+|\s+")
            rows, flags, sizes = [], [], per.copy()
            begin = np.cumsum(per) - per
            prev = 0
            for i in np.flatnonzero(odd).tolist():
                t = texts[i].as_py()
                own = [x for part in self.special.split(t) for x in ([part] if part in self.vocab.special else self.pattern.findall(part))] if re.search("[\x1c-\x1f]", t) else cut.findall(t)
                rows += [flat.slice(prev, begin[i] - prev), pa.array(own, pa.large_string())]
                flags += [spaced[prev : begin[i]], np.zeros(len(own), bool)]
                sizes[i] = len(own)
                prev = begin[i] + per[i]
            rows.append(flat.slice(prev))
            flags.append(spaced[prev:])
            flat, spaced, per = pa.concat_arrays(rows), np.concatenate(flags), sizes
        return flat, per, spaced


def byte_list(a: pa.LargeStringArray) -> list[bytes]:
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1].tolist() if len(a) else [0]
    data = a.buffers()[2].to_pybytes() if offsets[-1] else b""
    return [data[i:j] for i, j in pairwise(offsets)]


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start+1, ... count of them, for each start."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(total)


def grown(a: np.ndarray, n: int) -> np.ndarray:
    return a if len(a) >= n else np.concatenate([a, np.empty(max(n, 2 * len(a)) - len(a), a.dtype)])


def encoder(path: str, note: Callable[[pa.LargeStringArray], np.ndarray] | None = None) -> Encoder:
    """The worker's encoder for a tokenizer file, with or without notes."""
    state, key = worker_state(), ("encoder", path, note is not None)
    if key not in state:
        state[key] = Encoder(path, note=note)
    return state[key]


def slices(batches: Iterable[pa.RecordBatch], text: int, most_bytes: int, most_rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of about ``most_bytes`` of text at most (one row at least)."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(size)
        begin = 0
        while begin < batch.num_rows:
            base = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, base + most_bytes, side="right")))
            end = min(end, begin + most_rows, batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, ids`` (array of int). Null and empty texts have no ids."""

    def run(batches):
        enc = encoder(vocabulary)
        for b in slices(batches, 1, 2 << 20):
            enc.trim()
            ids, counts = enc.encode(b.column(1))
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([b.column(0), lists], names=["doc_id", "ids"])

    bound_batches(docs.sparkSession)
    d = narrow(docs, doc_id=id_col, text=text_col).select("doc_id", text_or_empty().alias("text"))
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_ids(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids``; bytes that are not UTF-8 become U+FFFD, null ids null text."""

    def run(batches):
        tokens = np.array(encoder(vocabulary).vocab.bytes_of, object)
        for b in batches:
            texts = [None if x is None else b"".join(tokens[np.array(x, np.int64)].tolist()).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def encode_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` per input row.

    Row by row, without a shuffle: ties, repeated rows and skew have no bearing. Null text counts as empty (no ids; the
    digests are those of the empty string). Other columns are ignored; an empty table gives an empty result.
    """

    def run(batches):
        enc = encoder(vocabulary)
        state = worker_state()
        if ("decimal", vocabulary) not in state:
            n = len(enc.vocab.bytes_of)
            decimal, tokens = np.empty(n, object), np.empty(n, object)
            decimal[:], tokens[:] = [b"%d," % i for i in range(n)], enc.vocab.bytes_of
            state[("decimal", vocabulary)] = decimal, tokens
        decimal, tokens = state[("decimal", vocabulary)]
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        for b in slices(batches, 1, 2 << 20):
            enc.trim()
            ids, counts = enc.encode(b.column(1))
            ends = np.cumsum(counts)
            parts = [ids[e - c : e] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
            said = [sha(b"".join(decimal[p].tolist())[:-1]) for p in parts]
            back = [sha(b"".join(tokens[p].tolist()).decode("utf-8", "replace").encode()) for p in parts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(said), pa.array(back)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    bound_batches(docs.sparkSession)
    d = narrow(docs, doc_id=id_col, text=text_col).select("doc_id", text_or_empty().alias("text"))
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
