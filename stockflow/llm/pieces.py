"""Token ids of whole texts through a bounded cache of short pieces.

The splitting pattern of the byte-level vocabularies never lets a match cross into a space that is
followed by a character other than white space, nor across a newline that stands alone between two
such characters, nor from an ASCII letter or digit into a mark that ends a word. A text can
therefore be cut there and the parts encoded alone, so equal parts (most words repeat) are encoded
once. Pieces are found, hashed (64 bits) and looked up in numpy; only new ones become strings.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from stockflow.llm.arrays import offsets, ragged, span_codes, text_bytes

Encoder = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?")] = True
#: What SentencePiece writes for a space.
MARK = "\u2581"
#: First bytes of characters that may be white space other than space and newline.
_MAYBE_SPACE = np.zeros(256, bool)
_MAYBE_SPACE[[9, 11, 12, 13, 0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True


class Ragged:
    """Growing table of number lists, one for each code."""

    def __init__(self):
        self.flat, self.start, self.length = np.zeros(1 << 16, np.int32), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.n = self.used = 0

    def add(self, flat: np.ndarray, off: np.ndarray) -> range:
        k, m = len(off) - 1, len(flat)
        while self.n + k > len(self.start):
            self.start, self.length = np.resize(self.start, 2 * len(self.start)), np.resize(self.length, 2 * len(self.length))
        while self.used + m > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used: self.used + m] = flat
        self.start[self.n: self.n + k] = off[:-1] + self.used
        self.length[self.n: self.n + k] = np.diff(off)
        self.n += k
        self.used += m
        return range(self.n - k, self.n)

    def take(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        length = self.length[codes]
        return ragged(self.flat, self.start[codes], length), offsets(length)


class HashIndex:
    """Open-addressing table from 64-bit hashes to codes, in numpy."""

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - bits)
        self.last = (1 << bits) - 1
        self.keys, self.codes = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Code of each hash, -1 where there is none."""
        slot = (h >> self.shift).astype(np.int64)
        out = self.codes[slot]
        todo = np.flatnonzero((self.keys[slot] != h) & (out >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.last
            code = self.codes[slot[todo]]
            out[todo] = code
            todo = todo[(code >= 0) & (self.keys[slot[todo]] != h[todo])]
        return out

    def add(self, h: np.ndarray, codes: np.ndarray) -> None:
        """Put in distinct hashes that are not there yet."""
        slot, todo = (h >> self.shift).astype(np.int64), np.arange(len(h))
        while len(todo):
            free = todo[self.codes[slot[todo]] < 0]
            _, one = np.unique(slot[free], return_index=True)
            won = free[one]
            self.keys[slot[won]], self.codes[slot[won]] = h[won], codes[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & self.last


class PieceCache:
    """ids(column) by ``encode(strings) -> (flat numbers, offsets)`` on pieces not seen lately.

    ``special`` maps strings that are tokens wherever they stand to their numbers. The cache starts anew when it holds
    ``limit`` pieces (or 16 numbers for each), so memory stays bounded for any corpus. Texts with
    longer runs of white space or special strings are encoded whole.
    """

    def __init__(self, encode: Encoder, limit: int = 200_000, special: dict[str, int] | None = None):
        self.encode, self.limit = encode, limit
        self.special = special or {}
        self.at_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        self._reset()

    def _reset(self) -> None:
        self.code: dict[bytes, int] = {}
        self.store = Ragged()

    def _whole(self, text: str) -> np.ndarray:
        parts, names = self.at_special.split(text), self.at_special.findall(text)
        flat, off = self.encode(parts)
        if not names:
            return flat
        out = [flat[off[0]: off[1]]]
        for k, name in enumerate(names, 1):
            out += [np.array([self.special[name]], np.int32), flat[off[k]: off[k + 1]]]
        return np.concatenate(out)

    def _cut(self, col: pa.Array, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the pieces, and the rows whose text is encoded whole."""
        n = len(data)
        gap, newline = data == 32, data == 10
        begins = np.zeros(n + 1, bool)
        begins[off] = True  # a row starts here, or the column ends
        solid = ~(gap | newline)
        after = np.ones(n, bool)     # the byte before is no solid one of the same row
        after[1:] = begins[1:n] | ~solid[:-1]
        before = np.ones(n, bool)    # the byte behind is no solid one of the same row
        before[:-1] = begins[1:n] | ~solid[1:]
        start = solid & after
        odd = np.flatnonzero((~solid & before) | (start & _MAYBE_SPACE[data]))
        mark = solid & before & ~after & _MARK[data]
        mark[1:] &= _WORD[data[:-1]]
        start |= mark
        end = solid & before
        end[:-1] |= mark[1:]
        start |= newline
        end |= newline
        s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
        # a leading space belongs to the piece
        s = s - ((s > 0) & ~begins[s] & gap[np.maximum(s - 1, 0)] & solid[s])
        bad = np.zeros(len(off), bool)
        bad[np.searchsorted(off, odd, "right") - 1] = True
        for name in self.special:
            bad[:-1] |= np.asarray(pc.fill_null(pc.match_substring(col, name), False), bool)
        return s, e, bad[:-1]

    def ids(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat numbers and row offsets of a string column; null counts as empty."""
        data, off = text_bytes(col)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
        s, e, bad = self._cut(col, data, off)
        row = np.searchsorted(off, s, "right") - 1
        if bad.any():
            good = ~bad[row]
            s, e, row = s[good], e[good], row[good]
        if self.store.n > self.limit or self.store.used > 16 * self.limit:
            self._reset()
        local, names = span_codes(data, s, e)
        pieces = names.to_pylist()
        own = np.fromiter(map(self.code.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(own < 0)
        if len(new):
            missing = [pieces[k] for k in new.tolist()]
            added = self.store.add(*self.encode([x.decode() for x in missing]))
            self.code.update(zip(missing, added))
            own[new] = added
        codes = own[local]
        if bad.any():
            rows = np.flatnonzero(bad)
            whole = [self._whole(col[i].as_py()) for i in rows.tolist()]
            more = np.array(self.store.add(np.concatenate(whole), offsets(np.array([len(w) for w in whole], np.int64))), np.int64)
            order = np.argsort(np.concatenate([row, rows]), kind="stable")
            codes, row = np.concatenate([codes, more])[order], np.concatenate([row, rows])[order]
        flat, at = self.store.take(codes)
        return flat, at[offsets(np.bincount(row, minlength=len(off) - 1))]


class SpaceCache(PieceCache):
    """PieceCache for a SentencePiece vocabulary: ids of whole texts without their outer spaces.

    No token holds a newline, or a word mark behind another character (``separable``), so none
    crosses from a character into a space behind it, nor into or out of a newline. A text is cut
    there, and every run of spaces and every newline begins a piece with what follows. Such a piece
    has no word mark of its own: it is encoded behind a newline, whose two ids are dropped.
    """

    def __init__(self, library, limit: int = 200_000):
        self.library, self.separable = library, separable(library)
        super().__init__(self._encode, limit)

    def _encode(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        inner = [s[:1] in (" ", "\n") for s in strings]
        out = self.library.encode(["\n" + s if x else s for s, x in zip(strings, inner)], num_threads=1)
        out = [ids[2:] if x else ids for ids, x in zip(out, inner)]
        return np.array([i for own in out for i in own], np.int32), offsets(np.array([len(x) for x in out], np.int64))

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text.strip(" ")), np.int32)

    def _cut(self, col: pa.Array, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        gap, newline = data == 32, data == 10
        begins = np.zeros(len(data), bool)
        rows = np.flatnonzero(off[1:] > off[:-1])
        begins[off[rows]] = True
        start = begins | newline
        start[1:] |= gap[1:] & ~gap[:-1]
        s = np.flatnonzero(start)
        # the word mark itself in a text is taken for a space
        bad = np.asarray(pc.fill_null(pc.match_substring(col, MARK), False), bool) if self.separable else np.ones(len(off) - 1, bool)
        bad[rows] |= gap[off[rows]] | newline[off[rows]] | gap[off[rows + 1] - 1]
        return s, np.append(s[1:], len(data)), bad


def separable(library) -> bool:
    """Whether a text may be cut before spaces and around newlines: such a cut crosses no token of
    the vocabulary, a newline is made of bytes, and the text is neither rewritten nor trimmed."""
    names = [library.id_to_piece(i) for i in range(library.vocab_size())]
    probe = [library.piece_to_id(MARK), library.piece_to_id("<0x0A>")]
    kept_as_is = library.encode("\n\n") == [*probe, probe[1]] and library.encode("a  ")[-1] in map(library.piece_to_id, (MARK, 2 * MARK))
    return kept_as_is and not any("\n" in x or MARK in x.lstrip(MARK) for x in names)


class MatchCache:
    """An Encoder that splits strings by a pattern and encodes each match not seen lately by
    ``merge(byte strings) -> (flat numbers, offsets)``."""

    def __init__(self, find: Callable[[str], list[str]], merge: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], limit: int = 150_000):
        self.find, self.merge, self.limit = find, merge, limit
        self._reset()

    def _reset(self) -> None:
        self.code: dict[str, int] = {}
        self.store = Ragged()

    def __call__(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.store.n > self.limit or self.store.used > 16 * self.limit:
            self._reset()
        matches = list(map(self.find, strings))
        flat = [m for own in matches for m in own]
        codes = np.fromiter(map(self.code.get, flat, repeat(-1)), np.int64, len(flat))
        new = np.flatnonzero(codes < 0).tolist()
        if new:
            missing = [flat[k] for k in new]
            unique = list(dict.fromkeys(missing))
            self.code.update(zip(unique, self.store.add(*self.merge([m.encode() for m in unique]))))
            codes[new] = np.fromiter(map(self.code.__getitem__, missing), np.int64, len(missing))
        out, off = self.store.take(codes)
        return out, off[offsets(np.fromiter(map(len, matches), np.int64, len(matches)))]
