"""Sets of word shingles as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from stockflow.llm.arrays import LOWER, mix, offsets, span_digests, text_bytes, words


def shingle_sets(col: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``width``-word shingles of each text, A-Z lower-cased: (flat sorted hashes, offsets).

    A text with fewer words has its whole sequence as its one shingle; without words, none.
    """
    data, off = text_bytes(col)
    low = LOWER[data]
    start, end, row = words(low, off)
    h = span_digests(low, start, end)
    n_words = np.bincount(row, minlength=len(off) - 1)
    at = offsets(n_words)
    roll = np.zeros(max(len(h) - width + 1, 0), np.uint64)
    for k in range(width):
        roll = mix(roll * np.uint64(0x9E3779B97F4A7C15) + h[k: k + len(roll)])
    out, size = [], np.zeros(len(n_words), np.int64)
    for i, n in enumerate(n_words.tolist()):
        if n >= width:
            own = np.unique(roll[at[i]: at[i + 1] - width + 1])
        elif n:
            x = np.array([n], np.uint64)
            for k in range(n):
                x = mix(x * np.uint64(0x9E3779B97F4A7C15) + h[at[i] + k])
            own = x
        else:
            continue
        out.append(own)
        size[i] = len(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), offsets(size)
