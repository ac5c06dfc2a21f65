"""Hashed word shingles of batches of texts, as multisets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORDS = 5
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
                np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the result."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_codes(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words of a batch, the words of all texts as numbers of these, and where each text begins."""
    found = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    words = found.flatten()
    filled = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(filled)])
    offsets = found.offsets.to_numpy()
    bounds = before[offsets - offsets[0]]
    coded = words.filter(pa.array(filled)).cast(pa.large_binary()).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), bounds


def shingle_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (row, hash, count), by row and hash.

    A text with fewer words has one shingle of them all; a text without words has none.
    """
    distinct, codes, bounds = word_codes(texts)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))[codes]
    lengths = np.diff(bounds)
    count = np.where(lengths > 0, np.maximum(lengths - words + 1, 1), 0)
    row = np.repeat(np.arange(len(lengths)), count)
    begin = bounds[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    left = np.minimum(lengths[row], words)
    value = left.astype(np.uint64)
    for k in range(words):
        at = np.minimum(begin + k, max(len(hashes) - 1, 0))
        step = hashes[at] * _ODD[k] if len(hashes) else np.zeros(0, np.uint64)
        value = mixed(value + np.where(k < left, step, np.uint64(0)))
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(fresh)
    return row[first], value[first], np.diff(np.append(first, len(row)))
