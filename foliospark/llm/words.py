"""Hashes of word sequences over Arrow batches: words, windows by doubling, and the smallest of neighbouring windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .bpe import byte_list

_C1, _C2 = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)


def split_words(texts: pa.Array) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The words of all texts one after another, and how many each has; a null text has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat = lists.flatten()
    ends = lists.offsets.to_numpy(zero_copy_only=False)[1:]
    real = pc.not_equal(flat, "")
    if pc.all(real).as_py() is False:
        mask = real.to_numpy(zero_copy_only=False)
        flat, ends = flat.filter(real), np.r_[0, np.cumsum(mask)][ends]
    return flat, np.diff(ends, prepend=0).astype(np.int64)


def word_hashes(words: pa.LargeStringArray) -> np.ndarray:
    from xxhash import xxh64_intdigest

    enc = words.dictionary_encode()
    own = byte_list(enc.dictionary)
    hashes = np.fromiter(map(xxh64_intdigest, own), np.uint64, len(own))
    return hashes[enc.indices.to_numpy(zero_copy_only=False)]


def wide_hashes(words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent halves of a 128-bit hash of each word."""
    from xxhash import xxh3_128_digest

    enc = words.dictionary_encode()
    own = np.frombuffer(b"".join(map(xxh3_128_digest, byte_list(enc.dictionary))), np.uint64).reshape(-1, 2)
    at = enc.indices.to_numpy(zero_copy_only=False)
    return own[at, 0], own[at, 1]


def mix(a: np.ndarray, b: np.ndarray, salt: int = 0) -> np.ndarray:
    x = a * _C1
    x += b
    x ^= x >> np.uint64(32)
    x *= _C2
    x += np.uint64(salt)
    x ^= x >> np.uint64(29)
    return x


class Windows:
    """Hashes of windows of any length up to ``longest``, from those of 1, 2, 4 ... words by doubling: two overlapping
    windows of a power of two words that cover a longer one determine it."""

    def __init__(self, words: np.ndarray, longest: int):
        self.levels = [words]
        while 2 << (len(self.levels) - 1) <= longest:
            h, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(mix(h[: max(0, len(h) - step)], h[step:]))

    def all(self, length: int) -> np.ndarray:
        """Of the windows of ``length`` at every start; those that run past the end of the array are left out."""
        n = max(0, len(self.levels[0]) - length + 1)
        return self.at(np.arange(n), np.full(n, length)) if length > 1 else self.levels[0]

    def at(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        level = np.frexp(lengths.astype(np.float64))[1] - 1
        for k in np.flatnonzero(np.bincount(level, minlength=1)).tolist():
            m = level == k
            s = starts[m]
            out[m] = mix(self.levels[k][s], self.levels[k][s + lengths[m] - (1 << k)]) * np.uint64(2 * k + 1) + lengths[m].astype(np.uint64)
        return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Of x[i : i + width], for each i that has so many."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:]) if len(x) > size else x[:0]
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest and len(x) > rest else x if not rest else x[:0]
