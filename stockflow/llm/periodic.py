"""Periodic run detection by a sparse diagonal DP over earlier occurrences (operator 11).

A run is a stretch of words with smallest period q (words q apart are equal), at least ``repeats``
times q and ``least`` words long, that neither neighbour extends. Every word looks back along the
diagonals (lags) on which its own surroundings stood before; while the next word finds the same lag
the diagonal's match grows by one, and a diagonal that ends long enough emits its run.

A frequent word has many earlier occurrences, and trying all of them takes quadratic time. So a lag
in [h, 2h) is only opened by the gram of the next 2h words, and only by that gram's *nearest*
earlier occurrence. Nothing is lost: a run with smallest period d in [h, 2h) is at least 4d long, so
such a gram stands in it d words later again; were a still earlier lag e < d to match, the stretch of
2h + e >= d + e words would have periods d and e, hence gcd(d, e), and d would not be the smallest.
For the same reason what is emitted has its lag as smallest period and cannot be extended. Grams
double in width from scale to scale, numbered by the pair of their halves (exact, no hash), and
grams that stand once in their text leave, so ordinary text ends after two or three scales and any
text of n words takes n log n steps at each of at most log n scales.

All texts of a chunk go through the scales together in numpy. A task holds one chunk (``CHUNK_BYTES``
of text, or one single longer text); there is no shuffle.

Edge cases: a null, empty or blank text has no words and no runs; repeated rows are treated alike;
an empty table gives no rows; input columns named like added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stockflow.llm.arrays import add_columns, offsets, ragged, span_codes, text_bytes, words

#: Words to read in place of each word of a chunk: (batch, offsets of each row's words) -> word numbers.
Rearrange = Callable[[pa.RecordBatch, np.ndarray], np.ndarray]


def _grouped(pos: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places whose key stands twice or more (in order), a new number of the key, and the distance
    back to its nearest earlier place (0 for the first)."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    again = np.zeros(len(key), bool)
    again[1:] = ranked[1:] == ranked[:-1]
    many = again.copy()
    many[:-1] |= again[1:]
    number, lag = np.empty(len(key), np.int64), np.zeros(len(key), np.int64)
    number[order] = np.cumsum(~again)
    lag[order[again]] = pos[order[again]] - pos[order[np.flatnonzero(again) - 1]]
    stay = np.zeros(len(key), bool)
    stay[order[many]] = True
    return pos[stay], number[stay], lag[stay]


def find_runs(code: np.ndarray, off: np.ndarray, least: int = 6, repeats: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start, length and period of all runs, ordered by row, start and period.

    ``code`` numbers the words of all rows; row i has the words off[i] to off[i + 1].
    """
    if repeats < 4:
        raise ValueError("a gram of twice the lag needs four repeats of a period to stand in a run")
    size = np.diff(off)
    row = np.repeat(np.arange(len(size)), size)
    end = off[row + 1]
    pos, number, _ = _grouped(np.arange(len(code)), row * (code.max(initial=0) + 1) + code)
    found, half = [], 1
    while len(pos) and repeats * half <= size.max():
        width = 2 * half
        at = np.full(len(code), -1)
        at[pos] = number
        fits = pos + width <= end[pos]
        pos, number = pos[fits], number[fits]
        second = at[pos + half]
        both = second >= 0
        pos, number, lag = _grouped(pos[both], number[both] * (len(code) + 1) + second[both])
        on = (lag >= half) & (lag < width)
        p, d = pos[on], lag[on]
        if len(p):
            begins = np.ones(len(p), bool)
            begins[1:] = (np.diff(p) != 1) | (np.diff(d) != 0)
            first = np.flatnonzero(begins)
            last = np.append(first[1:], len(p)) - 1
            d = d[first]
            start = p[first] - d
            length = p[last] + width - start
            long = length >= np.maximum(least, repeats * d)
            found.append((start[long], length[long], d[long]))
        half = width
    start, length, period = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else ((), (), ())))
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    return row[start] if len(start) else start, start - (off[row[start]] if len(start) else 0), length, period


def mark_runs(df: DataFrame, text: str = "text", least: int = 6, repeats: int = 4, carry: list[str] | None = None,
              rearrange: Rearrange | None = None) -> DataFrame:
    """Add ``n_words long``, ``runs array<struct<start, length, period>>`` (by start, then period; words
    are numbered from 0) and ``collapsed string``: the words joined by one space, without those that
    lie in a run behind its first period. ``rearrange`` may replace the words of a text first."""
    def make():
        def step(b: pa.RecordBatch) -> list[pa.Array]:
            data, off = text_bytes(b.column(text))
            s, e, row = words(data, off)
            at = offsets(np.bincount(row, minlength=b.num_rows))
            code, _ = span_codes(data, s, e)
            if rearrange is not None:
                source = rearrange(b, at)
                s, e, code = s[source], e[source], code[source]
            r, start, length, period = find_runs(code, at, least, repeats)
            drop = np.zeros(len(code) + 1, np.int64)
            np.add.at(drop, at[r] + start + period, 1)
            np.add.at(drop, at[r] + start + length, -1)
            stay = np.cumsum(drop[:-1]) == 0
            s, size = s[stay], (e - s)[stay]
            flat = ragged(np.append(data, np.uint8(32)), s, size + 1)
            upto = np.cumsum(size + 1)
            flat[upto - 1] = 32
            kept = offsets(np.bincount(np.repeat(np.arange(b.num_rows), np.diff(at))[stay], minlength=b.num_rows))
            cut = np.concatenate([[0], upto])[kept]  # where each row's words end, their last space included
            some = np.diff(kept) > 0
            keep = np.ones(len(flat), bool)
            keep[cut[1:][some] - 1] = False
            out = offsets(np.diff(cut) - some)
            collapsed = pa.Array.from_buffers(pa.string(), b.num_rows, [None, pa.py_buffer(out.astype(np.int32).tobytes()), pa.py_buffer(flat[keep].tobytes())])
            fields = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in (start, length, period)], ["start", "length", "period"])
            listed = pa.ListArray.from_arrays(pa.array(offsets(np.bincount(r, minlength=b.num_rows)).astype(np.int32)), fields)
            return [pa.array(np.diff(at)), listed, collapsed]
        return step

    return add_columns(df, text, "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string",
                       make, carry)
