"""Token ids by a SentencePiece BPE model, each distinct piece encoded once per worker.

BPE joins neighbours only into tokens of the vocabulary, so a text may be cut
wherever no token reaches across: before blanks that follow something else,
beside line ends, and between letters, digits and signs, each as far as the
model's own vocabulary bears it out.  A model that rewrites texts, or whose
tokens cross blanks or line ends, is called for whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import sentencepiece

from eventloom.llm.common import text_bytes
from eventloom.llm.pieces import DIGIT, LETTER, SIGN, PieceTable, kind_changes, kinds, per_text

BLANK = "▁"


class SentenceBpe:
    """Encodes texts that begin with a blank, which stands for the one that the model adds."""

    def __init__(self, path: str, max_words: int = 400_000, max_chars: int = 8_000_000):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        ids = range(m.get_piece_size())
        names = [m.id_to_piece(i) for i in ids]
        #: Each token's bytes; control tokens have none.
        self.tokens = [bytes([int(names[i][3:5], 16)]) if m.is_byte(i) else b"" if m.is_control(i) or m.is_unknown(i)
                       else names[i].replace(BLANK, " ").encode() for i in ids]
        plain = [self.tokens[i] for i in ids if not m.is_byte(i)]
        probe = "\n a  b\n\n  ﬁ Å　.9x \n"
        whole = b"".join(self.tokens[i] for i in m.encode(probe)) == f" {probe}".encode()
        line = m.encode("\n")
        self.apart = (whole and len(line) == 2 and self.tokens[line[0]] == b" " and self.tokens[line[1]] == b"\n"
                      and not any(b"\n" in t or b" " in t.lstrip(b" ") for t in plain)
                      # A symbol of the user's is taken whole, before any joining.
                      and all(m.get_score(i) <= 0 for i in ids) and len(set(names)) == len(names))
        self.line = line[-1] if self.apart else -1
        self.tied = np.zeros((5, 5), dtype=bool)
        for t in plain:
            k = kinds(np.frombuffer(t, dtype=np.uint8))
            self.tied[k[:-1], k[1:]] = True
        self.tied[~np.isin(np.arange(5), (LETTER, DIGIT, SIGN))] = True
        self.table = PieceTable(self._encode_pieces, max_words, max_chars)

    def _encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces as lines of texts, whose line ends part their ids again; a first, empty
        line takes the blank that the model adds."""
        size = np.ones(len(pieces), dtype=np.int64)
        lines = [i for i, p in enumerate(pieces) if p != b"\n"]
        groups = [lines[at:at + 1000] for at in range(0, len(lines), 1000)]
        texts = ["\n" + b"\n".join([pieces[i] for i in g]).decode("utf-8", "surrogatepass") for g in groups]
        found = []
        for g, ids in zip(groups, self.model.encode(texts, num_threads=1)):
            ids = np.array(ids, dtype=np.int32)
            cuts = np.flatnonzero(ids == self.line)
            if len(cuts) != len(g):
                raise ValueError("the model does not part lines")
            size[g] = np.diff(np.append(cuts, len(ids))) - 1
            found.append(np.delete(ids, np.append(cuts, 0)))
        flat = np.full(int(size.sum()), self.line, dtype=np.int32)
        of_lines = np.zeros(len(pieces), dtype=bool)
        of_lines[lines] = True
        if found:
            flat[np.repeat(of_lines, size)] = np.concatenate(found)
        return flat, size

    def _borders(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        kind = kinds(data)
        begins = kind_changes(kind)
        begins[1:] &= ~self.tied[kind[:-1], kind[1:]]
        begins[1:] |= (data[1:] == 32) & (data[:-1] != 32)
        # The model's own sign for a blank joins the blanks after it.
        begins[3:] &= ~((data[:-3] == 0xE2) & (data[1:-2] == 0x96) & (data[2:-1] == 0x81))
        end = data == 10
        begins |= end
        begins[1:] |= end[:-1]
        begins[offsets[offsets < len(data)]] = True
        return begins

    def encode(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other (int32), and the number of ids of each."""
        raw, offsets = text_bytes(values)
        if not self.apart:
            ids = self.model.encode([v[1:] for v in values.to_pylist()], num_threads=1)
            return np.array([i for one in ids for i in one], dtype=np.int32), np.fromiter(map(len, ids), np.int64, len(ids))
        data = np.frombuffer(raw, dtype=np.uint8)
        ids, start, size = self.table.encode(data, self._borders(data, offsets) if len(data) else np.empty(0, dtype=bool))
        return ids, per_text(offsets, start, size)
