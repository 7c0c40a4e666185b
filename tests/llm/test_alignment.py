import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventloom.llm import alignment, pieces, queries, sentence_bpe
from eventloom.llm.bpe import byte_letters
from tests.llm.data import ROOT

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(A_PATH)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
LETTERS = {c: b for b, c in byte_letters().items()}
ODD = ["", " ", "a", "  two  blanks ", "line\nend\n\n", "<|endoftext|> <s> </s> <0x0A>", "naïve café, don't!", "日本語。テスト", "▁under▁", "ﬁne Å　",
       "\x00nul", "tab\there", "9,999.5%", "é" * 200, "x " * 900]


def b_bytes(i):
    p = B.id_to_piece(i)
    return bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode()


def brute(rows):
    """By the contract's words: ends as sums, links as a double loop over each text's ends."""
    found, counts = [], Counter()
    for doc_id, text in rows:
        a = A.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = B.encode(text) if text else []
        a_raw, b_raw = [bytes(LETTERS[c] for c in A.id_to_token(i)) for i in a], [b_bytes(i) for i in b]
        if not text or not b"".join(a_raw) == b"".join(b_raw) == f" {text}".encode():
            a, b, a_raw, b_raw = [], [], [], []
        a_end, b_end = np.cumsum([len(x) for x in a_raw]), np.cumsum([len(x) for x in b_raw])
        links = [(a[i], b[j]) for i, j in zip(*np.nonzero(np.equal.outer(a_end, b_end)))]
        written, i, j = [], 0, 0
        for end in sorted(set(a_end.tolist()) & set(b_end.tolist())):
            s, t = int((a_end <= end).sum()), int((b_end <= end).sum())
            written.append(",".join(map(str, a[i:s])) + "|" + ",".join(map(str, b[j:t])))
            i, j = s, t
        counts.update(links)
        digest = hashlib.sha256(";".join(written).encode()).hexdigest() if a else ""
        found.append((doc_id, len(a), len(b), len(written), links, digest))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted(((d, na, nb, g, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), h)
                   for d, na, nb, g, links, h in found), key=str)


def result(df):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_documents_equal_brute_force(spark):
    sf_dir = f"{ROOT}/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert result(queries.op13_tokenizer_alignment(spark, sf_dir)) == brute(rows)


def test_defined_cases(spark, monkeypatch):
    rows = [*enumerate(ODD), (None, "null id"), (3, None), (3, None), (7, ODD[6]), (500, "word " * 20_000)]
    docs = (spark.createDataFrame(rows, "doc_id long, text string")
            .withColumns({"id": F.lit("x"), "run": F.lit(1), "pairs": F.lit(2)}).repartition(3))
    got = result(alignment.alignments(docs, A_PATH, B_PATH))
    assert got == brute(rows)
    assert ("", 0) in {(r[-1], r[1]) for r in got} and {r[1] > 0 for r in got if r[0] == 1} == {True}
    assert alignment.alignments(docs.limit(0), A_PATH, B_PATH).count() == 0
    nothing = docs.where("text is null or text = ''")
    assert {r[1:] for r in result(alignment.alignments(nothing, A_PATH, B_PATH))} == {(0, 0, 0, 0, 0, 0, "")}


def test_links_of_tokens_without_bytes():
    """Every pair whose ranges end together, even where several tokens end at one place."""
    raw, offsets = np.frombuffer(b"abcd", dtype=np.uint8), np.array([0, 4])
    words = alignment.Vocabulary([b"", b"ab", b"cd", b"abcd"])
    a = alignment.Tokens(words, np.array([1, 0, 2]), np.array([3]), raw, offsets)
    b = alignment.Tokens(words, np.array([1, 2, 0, 0]), np.array([4]), raw, offsets)
    found = alignment.Alignment(a, b)
    pairs = sorted((int(x) >> 32, int(x) & 0xFFFFFFFF) for x in found.links)
    assert pairs == sorted([(1, 1), (0, 1), (2, 2), (2, 0), (2, 0)]) and found.n_links.tolist() == [5] and found.n_groups.tolist() == [2]


def test_pieces_give_the_models_ids():
    rng = random.Random(2)
    letters = [*"abZé' st\n\t.,!9²　\x1c_日|*▁<s>ßÿ×÷", "\n\n", "  ", "foo", "</s>", "<0x0A>", "(x)"]
    texts = [*ODD, *("".join(rng.choices(letters, k=rng.randint(1, 30))) for _ in range(3000))]
    one = sentence_bpe.SentenceBpe(B_PATH, max_words=300)
    assert one.apart
    for at in range(0, len(texts), 100):
        part = [t for t in texts[at:at + 100] if t]
        ids, size = one.encode(pa.array([f" {t}" for t in part], pa.large_string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])] == B.encode(part)
    one.apart = False
    ids, size = one.encode(pa.array([f" {t}" for t in ODD[1:]], pa.large_string()))
    assert [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])] == B.encode(ODD[1:])


def test_equal_hashes_are_told_apart(monkeypatch):
    """Pieces found by their hash are compared in full: with a hash of eight values ids stay right."""
    monkeypatch.setattr(pieces, "hashes", lambda h: (h >> np.uint64(61)) + np.uint64(1))
    table = pieces.PieceTable(lambda ps: (np.array([p[0] for p in ps], dtype=np.int32), np.ones(len(ps), dtype=np.int64)))
    rng = random.Random(4)
    for _ in range(5):
        words = ["".join(rng.choices("abcdef", k=rng.randint(1, 4))) for _ in range(200)]
        data = np.frombuffer("".join(words).encode(), dtype=np.uint8)
        begins = np.zeros(len(data), dtype=bool)
        begins[np.cumsum([0, *map(len, words[:-1])])] = True
        ids, start, size = table.encode(data, begins)
        assert ids.tolist() == [ord(w[0]) for w in words] and size.tolist() == [1] * 200
