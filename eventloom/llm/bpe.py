"""Token ids by the ``tokenizers`` library, each distinct piece encoded once per worker.

Byte-level BPE splits a text into words, runs of signs and white space before
it merges anything, so the ids of a text are the ids of its pieces put
together, if the text is cut only where that first split cuts it too: between
Latin letters, ASCII digits and ASCII signs (but the apostrophe), and around
runs of white space, whose last character stays with what follows, as the split
does it.

The tokenizer's added tokens (``<|endoftext|>``) come before that split: with
``added_tokens`` a text is cut at them first, as the library's default call
does it, and each gets its own id; without, special ones are plain text.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer, pre_tokenizers

from eventloom.llm.common import per_stage, text_bytes
from eventloom.llm.pieces import SPACE, PieceTable, kind_changes, kinds, per_text

# A Spark task has one core.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces that the split leaves whole: letters, digits or signs, after a blank or not.
_WHOLE = re.compile(rb" ?(?:(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[0-9]+|[!-&(-/:-@\[-`{-~]+)")

#: White space beyond ASCII, in UTF-8, by the first byte.
_WIDE = {0xC2: [b"\xc2\x85", b"\xc2\xa0"], 0xE1: [" ".encode()],
         0xE2: [chr(c).encode() for c in [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F]], 0xE3: ["　".encode()]}


def byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in a byte-level vocabulary: printable Latin-1 for
    itself, the other bytes in order from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


def _white(data: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The length of the white space character that ends at each byte, 0 elsewhere, and -1 at
    its earlier bytes."""
    out = (kind == SPACE).astype(np.int8)
    for lead, forms in _WIDE.items():
        at = np.flatnonzero(data == lead)
        for form in forms if len(at) else ():
            here = at[at + len(form) <= len(data)]
            for k, b in enumerate(form):
                here = here[data[here + k] == b]
            for k in range(len(form)):
                out[here + k] = -1
            out[here + len(form) - 1] = len(form)
    return out


def borders(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each byte of the texts that start at ``offsets`` (and end at its last)."""
    kind = kinds(data)
    begins = kind_changes(kind)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    white = _white(data, kind)
    inside = white != 0
    before = np.concatenate(([False], inside[:-1]))
    begins |= edge[:-1] | (inside & ~before)
    last = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False)))
    last = last[~edge[last + 1]]
    begins[last + 1 - white[last]] = True
    begins[last[data[last] != 32] + 1] = True
    return begins


class WordBpe:
    def __init__(self, path: str, max_words: int = 400_000, max_chars: int = 8_000_000, added_tokens: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        split = self.tokenizer.pre_tokenizer
        if type(split).__name__ != "ByteLevel" or split.add_prefix_space or self.tokenizer.normalizer is not None:
            raise ValueError(f"{path} does not split like a byte-level tokenizer without normalizer")
        added = [t for t in self.tokenizer.get_added_tokens_decoder().values() if added_tokens or not t.special]
        if any(t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError(f"{path} has added tokens that take white space or stand as single words only")
        # The longest first, as the library takes the leftmost longest.
        self.added = re.compile(b"|".join(re.escape(c) for c in sorted((t.content.encode() for t in added), key=len, reverse=True))) if added else None
        (self.newline,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        # The same model for words that are split already and written in the vocabulary's letters.
        self.words = Tokenizer.from_file(path)
        self.words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        self.letter_count = np.zeros(max(self.words.get_vocab().values()) + 1, dtype=np.int64)
        for token, i in self.words.get_vocab(with_added_tokens=False).items():
            self.letter_count[i] = len(token)
        self.letters = str.maketrans({chr(b): c for b, c in byte_letters().items() if b != 10})
        self.table = PieceTable(self._encode_pieces, max_words, max_chars)

    def _encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Words as the split leaves them go to the model in lists; other pieces without white
        space but a leading blank as lines of one text, whose line ends part their ids
        again; white space alone and added tokens by themselves."""
        whole = [i for i, p in enumerate(pieces) if _WHOLE.fullmatch(p)]
        others = sorted(set(range(len(pieces))).difference(whole))
        text = {i: pieces[i].decode("utf-8", "surrogatepass") for i in others}
        lines = [i for i in others if not text[i].isspace() and not (self.added and self.added.search(pieces[i]))]
        apart = set(others).difference(lines)
        size = np.zeros(len(pieces), dtype=np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def thousands(of: list[int]) -> list[list[int]]:
            return [of[at:at + 1000] for at in range(0, len(of), 1000)]

        groups = thousands(whole)
        listed = self.words.encode_batch_fast(
            [b"\n".join([pieces[i] for i in g]).decode("latin-1").translate(self.letters) for g in groups], add_special_tokens=False)
        for g, e in zip(groups, listed):
            ids = np.array(e.ids, dtype=np.int32)
            ends = np.cumsum([len(pieces[i]) for i in g])
            size[g] = np.diff(np.searchsorted(np.cumsum(self.letter_count[ids]), ends, side="right"), prepend=0)
            found.append((np.array(g), ids))
        groups = thousands(lines)
        joined = self.tokenizer.encode_batch_fast(["\n".join([text[i] for i in g]) for g in groups], add_special_tokens=False)
        for g, e in zip(groups, joined):
            ids = np.array(e.ids, dtype=np.int32)
            cuts = np.flatnonzero(ids == self.newline)
            if len(cuts) != len(g) - 1:
                apart.update(g)
                continue
            size[g] = np.diff(np.concatenate(([-1], cuts, [len(ids)]))) - 1
            found.append((np.array(g), np.delete(ids, cuts)))
        rest = sorted(apart)
        alone = self.tokenizer.encode_batch_fast([text[i] for i in rest], add_special_tokens=False)
        size[rest] = [len(e.ids) for e in alone]
        found.append((np.array(rest, dtype=np.int64), np.array([i for e in alone for i in e.ids], dtype=np.int32)))
        flat = np.empty(int(size.sum()), dtype=np.int32)
        first = np.cumsum(size) - size
        for which, ids in found:
            n = size[which]
            flat[np.repeat(first[which] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return flat, size

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other (int32), and the number of ids of each."""
        values = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        raw, offsets = text_bytes(values)
        data = np.frombuffer(raw, dtype=np.uint8)
        edges, marks = offsets, []
        if self.added is not None and self.added.search(raw):
            bounds = offsets.tolist()
            marks = [(a + m.start(), a + m.end()) for a, b in zip(bounds, bounds[1:]) for m in self.added.finditer(raw[a:b])]
            edges = np.unique(np.concatenate([offsets, np.array(marks, dtype=np.int64).ravel()]))
        begins = borders(data, edges) if len(data) else np.empty(0, dtype=bool)
        for a, b in marks:
            begins[a + 1:b] = False
        ids, start, size = self.table.encode(data, begins)
        return ids, per_text(offsets, start, size)


def tokenizer(path: str, added_tokens: bool = False) -> WordBpe:
    """The tokenizer for ``path`` that the tasks of a stage share in a worker."""
    return per_stage(("bpe", path, added_tokens), lambda: WordBpe(path, added_tokens=added_tokens))


def append_id(ids: np.ndarray, size: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """``end`` after the ids of each text."""
    stops = np.cumsum(size + 1) - 1
    out = np.empty(len(ids) + len(size), dtype=np.int32)
    keep = np.ones(len(out), dtype=bool)
    keep[stops] = False
    out[keep] = ids
    out[stops] = end
    return out, size + 1
