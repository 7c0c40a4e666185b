"""Pieces of texts that a tokenizer encodes apart, and a bounded table of their ids.

Texts are handled as one array of UTF-8 bytes.  A tokenizer's class says before
which bytes a piece may begin; the pieces' hashes, their places in the table and
the ids of all texts are then array operations, and the library encodes only
pieces that the table does not hold.  A piece found by its hash is compared with
the table's own bytes, so equal hashes of different pieces do no harm.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from eventloom.llm.common import _MIX, _P

#: Bytes by kind; only changes between these kinds can be borders inside a word.
OTHER, LETTER, DIGIT, SIGN, SPACE = range(5)
KINDS = np.array([
    SPACE if b == 32 or 9 <= b <= 13 else LETTER if chr(b).isalpha() and b < 128 else DIGIT if chr(b).isdigit() and b < 128
    else SIGN if 33 <= b <= 126 and chr(b) != "'" else OTHER for b in range(256)], dtype=np.uint8)

#: Two flat arrays: ids of all pieces, and the number of ids of each piece.
Encode = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


def kinds(data: np.ndarray) -> np.ndarray:
    """The kind of each byte; both bytes of U+00C0 to U+00FF are letters but for the signs there."""
    out = KINDS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    if len(lead):
        second = data[lead + 1]
        lead = lead[(second != 0x97) & (second != 0xB7)]
        out[lead] = out[lead + 1] = LETTER
    return out


def kind_changes(kind: np.ndarray) -> np.ndarray:
    """Whether a byte and the one before are of two kinds of letters, digits and signs."""
    out = np.zeros(len(kind), dtype=bool)
    word = (kind != OTHER) & (kind != SPACE)
    out[1:] = (kind[1:] != kind[:-1]) & word[1:] & word[:-1]
    return out


def gather(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of all of ``size`` items from each ``start``."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


class _Flat:
    """Byte or id strings one after the other, which grow."""

    def __init__(self, kind: type):
        self.data = np.empty(1 << 16, dtype=kind)
        self.used = 0
        self.start = np.empty(0, dtype=np.int64)
        self.size = np.empty(0, dtype=np.int64)

    def add(self, flat: np.ndarray, size: np.ndarray) -> None:
        while self.used + len(flat) > len(self.data):
            self.data = np.concatenate([self.data, np.empty_like(self.data)])
        self.data[self.used:self.used + len(flat)] = flat
        self.start = np.concatenate([self.start, self.used + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.used += len(flat)

    def of(self, number: np.ndarray) -> np.ndarray:
        return self.data[gather(self.start[number], self.size[number])]


class PieceTable:
    """Ids of pieces, at most about ``max_pieces`` of ``max_bytes``: a table beyond that keeps
    the pieces used more than once, at most half of it, the most used first."""

    def __init__(self, encode: Encode, max_pieces: int = 400_000, max_bytes: int = 8_000_000):
        self.encode_pieces, self.max_pieces, self.max_bytes = encode, max_pieces, max_bytes
        self._clear()

    def _clear(self) -> None:
        self.pieces, self.ids = _Flat(np.uint8), _Flat(np.int32)
        self.hash = np.empty(0, dtype=np.uint64)
        self.uses = np.empty(0, dtype=np.int64)
        self._slots(1 << 12)

    def _slots(self, number: int) -> None:
        self.key = np.zeros(number, dtype=np.uint64)
        self.number = np.zeros(number, dtype=np.int32)
        self._file(np.flatnonzero(self.hash))

    def _home(self, h: np.ndarray) -> np.ndarray:
        return (h & np.uint64(len(self.key) - 1)).astype(np.int64)

    def _file(self, number: np.ndarray) -> None:
        """Open addressing: pieces that want one slot take it in turn."""
        h = self.hash[number]
        slot = self._home(h)
        while len(number):
            free = self.key[slot] == 0
            self.key[slot[free]] = h[free]
            won = self.key[slot] == h
            self.number[slot[won]] = number[won]
            number, h, slot = number[~won], h[~won], (slot[~won] + 1) % len(self.key)

    def _find(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), -1, dtype=np.int64)
        left, slot = np.arange(len(h)), self._home(h)
        while len(left):
            key = self.key[slot]
            hit = key == h[left]
            out[left[hit]] = self.number[slot[hit]]
            on = ~hit & (key != 0)
            left, slot = left[on], (slot[on] + 1) % len(self.key)
        return out

    def _shrink(self) -> None:
        keep = np.argsort(-self.uses, kind="stable")[:self.max_pieces // 2]
        keep = np.sort(keep[self.uses[keep] > 1])
        pieces, ids, hashes = self.pieces, self.ids, self.hash[keep]
        self._clear()
        if int(pieces.size[keep].sum()) <= self.max_bytes // 2:
            self._add(pieces.of(keep), pieces.size[keep], ids.of(keep), ids.size[keep], hashes)

    def _add(self, raw: np.ndarray, raw_size: np.ndarray, ids: np.ndarray, size: np.ndarray, h: np.ndarray) -> None:
        """New pieces; those with hash 0 cannot be found again."""
        at = len(self.hash)
        self.pieces.add(raw, raw_size)
        self.ids.add(ids, size)
        self.hash = np.concatenate([self.hash, h])
        self.uses = np.concatenate([self.uses, np.zeros(len(h), dtype=np.int64)])
        if 2 * len(self.hash) > len(self.key):
            self._slots(1 << (4 * len(self.hash)).bit_length())
        else:
            self._file(at + np.flatnonzero(h))

    def _learn(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, h: np.ndarray) -> None:
        raw = data[gather(start, size)]
        ends, text = np.cumsum(size).tolist(), raw.tobytes()
        self._add(raw, size, *self.encode_pieces([text[a:b] for a, b in zip([0, *ends], ends)]), h)

    def encode(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all pieces of ``data``, which begin where ``begins`` is true; where each piece
        starts, and the number of ids of each."""
        if len(self.hash) > self.max_pieces or self.pieces.used > self.max_bytes:
            self._shrink()
        start = np.flatnonzero(begins)
        size = np.diff(np.append(start, len(data)))
        if not len(start):
            return np.empty(0, np.int32), start, size
        place = np.arange(len(data)) - np.repeat(start, size)
        power = np.multiply.accumulate(np.full(int(size.max()), _P, dtype=np.uint64))
        h = np.add.reduceat(_MIX[data] * power[place], start)
        h = hashes(h)
        number = self._find(h)
        new = np.flatnonzero(number < 0)
        if len(new):
            _, first = np.unique(h[new], return_index=True)
            first = new[first]
            self._learn(data, start[first], size[first], h[first])
            number[new] = self._find(h[new])
        # Two pieces with one hash: those that are not the table's are encoded by themselves.
        odd = self.pieces.size[number] != size
        if odd.any():
            table, at = self.pieces.data, self.pieces.start[number]
            for k in np.flatnonzero(~odd).tolist():
                odd[k] = not np.array_equal(data[start[k]:start[k] + size[k]], table[at[k]:at[k] + size[k]])
        elif not (same := self.pieces.data[gather(self.pieces.start[number], size)] == data).all():
            odd = ~np.logical_and.reduceat(same, start)
        if odd.any():
            own = np.flatnonzero(odd)
            number[own] = np.arange(len(self.hash), len(self.hash) + len(own))
            self._learn(data, start[own], size[own], np.zeros(len(own), dtype=np.uint64))
        self.uses += np.bincount(number, minlength=len(self.hash))
        return self.ids.of(number), start, self.ids.size[number]


def hashes(h: np.ndarray) -> np.ndarray:
    """Mixed, and never 0, which marks a free slot."""
    h = (h ^ (h >> np.uint64(29))) * _P
    h ^= h >> np.uint64(32)
    h[h == 0] = 1
    return h


def per_text(offsets: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The number of ids of each text, of pieces that start at ``start`` with ``size`` ids."""
    return np.diff(np.concatenate(([0], np.cumsum(size)))[np.searchsorted(start, offsets)])
