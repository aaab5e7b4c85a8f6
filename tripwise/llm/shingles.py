"""Word shingles of whole texts as 64-bit hashes, many texts at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E6C63D0676A9A99)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word [^\\x20\\x09-\\x0D]+ with A-Z lower-cased, and the
    offsets of the texts (null: no words)."""
    import xxhash

    listed = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.large_string()).fill_null("")))
    flat = listed.flatten()
    full = pc.greater(pc.binary_length(flat), 0)  # the splitter's edges are empty
    owner = pc.list_parent_indices(listed).to_numpy()
    coded = flat.filter(full).dictionary_encode()
    known = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    counts = np.bincount(owner[full.to_numpy(zero_copy_only=False)], minlength=len(texts))
    return known[coded.indices.to_numpy()], np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words of each text, repeats
    included, and their offsets.  A text of fewer words has one shingle, its
    whole sequence; a text without words has none."""
    factors = odd_numbers(width, 11)
    counts = np.diff(offsets)
    windows = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(windows)])
    at = np.repeat(offsets[:-1] - first[:-1], windows) + np.arange(first[-1])
    left = np.repeat(offsets[1:], windows) - at  # words from here to the text's end
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    total = np.zeros(len(at), np.uint64)
    for k in range(width):
        total += np.where(left > k, padded[at + k] * factors[k], np.uint64(k + 1))
    return mixed(total), first


def smallest(hashes: np.ndarray, offsets: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """[texts, factors]: the least of hash * factor (mod 2^64) in each text;
    all ones for texts without hashes."""
    out = np.full((len(offsets) - 1, len(factors)), np.uint64(0xFFFFFFFFFFFFFFFF))
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        starts = offsets[:-1][full]
        for k, factor in enumerate(factors):
            out[full, k] = np.minimum.reduceat(hashes * factor, starts)
    return out
