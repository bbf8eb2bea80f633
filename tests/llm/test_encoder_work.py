"""op8, op9, pipeline: the work of encoding grows with the distinct pieces of a call."""

from __future__ import annotations

import numpy as np

from liftwise.llm import tokens
from liftwise.llm.tokens import PieceEncoder, default_path


class Counted(tokens._Pieces):
    asked = 0

    def __getitem__(self, piece):
        self.asked += 1
        return super().__getitem__(piece)


def test_a_piece_is_looked_up_once_in_a_call():
    enc = PieceEncoder(default_path())
    enc.pieces = Counted(enc.pieces.words)
    texts = ["alpha beta gamma " * 500, "", " \t\n", "beta\u00a0alpha\u3000gamma  ", "\x1calpha", "x\u0085\u2028y", "<|endoftext|> beta", "caf\u00e9, Beta's 12!"]
    got = enc.encode(texts)
    assert enc.pieces.asked < 30
    for text, raw in zip(texts, got, strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == enc.tok.encode(text, add_special_tokens=False).ids
    assert enc.encode([]) == [] and enc.encode([""]) == [b""]


def test_arrow_splits_where_python_does():
    import pyarrow as pa
    import pyarrow.compute as pc

    signs = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    split = pc.utf8_split_whitespace(pa.array([f"a{c}a" for c in signs]))
    assert [c.isspace() for c in signs] == [n > 1 for n in pc.list_value_length(split).to_pylist()]


def test_a_word_is_looked_up_once_whatever_sign_follows_it():
    enc = PieceEncoder(default_path())
    enc.pieces = Counted(enc.pieces.words)
    words = [a + b for a in ("alpha", "beta", "gamma") for b in ("x", "yy", "zzz")]
    texts = [f"{w}{sign} {w.title()}{sign} {w.upper()}{sign}" for w in words for sign in (*".,;:!?)\"'", "...", "1", "_", "'s")]
    got = enc.encode(texts)
    assert enc.pieces.asked < len(words) + 20
    for text, raw in zip(texts, got, strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == enc.tok.encode(text, add_special_tokens=False).ids


def test_signs_set_apart_leave_the_ids_as_they_are():
    enc, rnd = PieceEncoder(default_path()), np.random.default_rng(3)
    signs = ["a", "B", "s", "T", "re", "'", "'s", "'LL", ".", "...", "_", "-", "7", "42", " ", "\n", "é", "É", "K", "中", "가", "’", "\x7f", "\x00", ";", "<", "|"]
    texts = ["".join(rnd.choice(signs, n)) for n in rnd.integers(0, 30, 3000)]
    for text, raw in zip(texts, enc.encode(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == enc.tok.encode(text, add_special_tokens=False).ids, repr(text)
