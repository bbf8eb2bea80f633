"""Spelling variants, periodic runs and BPE against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from liftwise.llm import bpe, periodic, spelling
from liftwise.llm.queries import QUERIES
from liftwise.llm.tokens import default_path

SF = "/root/testdata/sf0.001"
RND = random.Random(4)


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, null and repeated ids, a long text, clashing column names."""
    long = " ".join(f"w{i % 7919}" for i in range(20_000))
    rows = [(1, None), (2, ""), (3, " \t\n "), (None, "ab " * 9), (4, long), (4, long), (5, "a b c d " * 6 + "x"), (5, "a b c d " * 6 + "x"), (6, "<|endoftext|> a<|endoftext|>"), (-7, "né\x85é é ½\x1c1²")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", *[F.lit("x").alias(c) for c in ("word", "n", "key", "near", "form", "runs", "collapsed", "n_words", "ids", "decoded", "a", "p", "w", "h")])


# ---- periodic runs


def brute_runs(words: list) -> list[tuple[int, int, int]]:
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                length = j - i + q
                smaller = any(all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q))
                if length >= max(6, 4 * q) and not smaller:
                    out.append((i, length, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(words: list[str]) -> tuple:
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    text = " ".join(w for i, w in enumerate(words) if i not in gone)
    return len(runs), *four, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(text)


def tailed(doc_id: int | None, text: str | None) -> list[str]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = (None if doc_id is None else zlib.crc32(str(doc_id).encode())), len(words)
    if h is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_runs_of_random_words_equal_brute_force():
    for k in range(600):
        letters = RND.choice(("a", "ab", "ab", "abc", "abcdefgh"))
        words = [RND.choice(letters) for _ in range(RND.randint(0, 70))]
        for _ in range(RND.randint(0, 3)):
            part = [RND.choice(letters) for _ in range(RND.randint(1, 7))] * RND.randint(3, 9)
            at = RND.randint(0, len(words))
            words[at:at] = part[: len(part) - RND.randint(0, 5)]
        other = [RND.choice("ab") for _ in range(9)]
        ids = np.array([ord(x) for x in words + other + words], np.int64)
        got = periodic.find_runs(ids, np.array([0, len(words), len(words) + 9, len(ids)]))
        want = brute_runs(words)
        assert got.get(0, []) == want and got.get(2, []) == want and got.get(1, []) == brute_runs(other), words


def test_other_limits():
    w = np.array([1, 2, 1, 2, 1, 9, 3, 3, 3])
    assert periodic.find_runs(w, np.array([0, 9]), min_words=3, min_exponent=2) == {0: [(0, 5, 2), (6, 3, 1)]}
    assert not periodic.find_runs(w, np.array([0, 9]))


def test_long_periods_and_one_word_repeated():
    period = [RND.randint(0, 10**6) for _ in range(4_000)]
    ids = np.array([-0] * 5 + period * 5 + [7] * 60_000)
    assert periodic.find_runs(ids, np.array([0, len(ids)])) == {0: [(5, 20_000, 4_000), (20_005, 60_000, 1)]}


def test_periodic_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:8] for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs) and sum(r[0] for r in got.values())
    for d in docs:
        words = tailed(d.doc_id, d.text)
        if len(words) < 3_000 or zlib.crc32(str(d.doc_id).encode()) % 10 == 0:
            assert got[d.doc_id] == (brute_row(words) if len(words) < 3_000 else quick_row(words)), d.doc_id


def quick_row(words: list[str]) -> tuple:
    """brute_row for long texts: only lags at which 6 or more neighbours agree."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids, n, out = np.array([number[w] for w in words]), len(words), {}
    for q in range(1, n // 4 + 1):
        edge = np.flatnonzero(np.diff(ids[:-q] == ids[q:], prepend=False, append=False))
        for i, j in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True):
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
    runs = sorted(((i, m, q) for (i, m), q in out.items()), key=lambda r: (r[0], r[2]))
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return len(runs), *four, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))


def test_periodic_edges(odd):
    got = periodic.digest(periodic.periodic_runs(periodic.with_periodic_tails(odd))).collect()
    want = [(r.doc_id, *(brute_row(w) if len(w) < 3_000 else quick_row(w))) for r in odd.select("doc_id", "text").collect() for w in [tailed(r.doc_id, r.text)]]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert not periodic.periodic_runs(odd.where("false")).collect()
    one = {r.doc_id: r for r in periodic.periodic_runs(odd).where("doc_id IN (1, 5)").collect()}
    assert one[5].collapsed == "a b c d x" and [tuple(x) for x in one[5].runs] == [(0, 24, 4)] and one[5].n_words == 25
    assert one[1].collapsed == "" and one[1].runs == []


# ---- spelling variants


def near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute_variants(n: dict[str, int], ratio: int = 10) -> set[tuple]:
    form, out = {}, {}
    for w in n:
        close = [x for x in n if near(w, x)]
        best = min(close, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
        out[w] = len(close)
    rows = set()
    for w in n:
        top = w
        while form[top] is not None:
            top = form[top]
        rows.add((w, form[w], top, n[w], out[w], None if form[w] is None else n[form[w]]))
    return rows


def words_of(spark, n: dict[str, int]):
    return spark.createDataFrame(list(n.items()), "word string, n long")


def test_every_neighbour_is_generated_once():
    words = ["aaaaaaa", "abcabca", "éàéàéàé", "z" * 40, "qwertyuiop"] + ["".join(RND.choice("abcdefgh") for _ in range(8)) for _ in range(30)]
    symbol = {c: int(spelling._symbol_values(np.array([ord(c)]), 8)[0][0]) for w in words for c in w}
    letter = {}
    for c in map(chr, range(97, 1000)):
        letter.setdefault(int(spelling._symbol_values(np.array([ord(c)]), 8)[0][0]), c)
    got: dict[int, list] = {k: [] for k in range(len(words))}
    for at, key in spelling.neighbourhood(words):
        for i, x in zip(at.tolist(), key.tolist(), strict=True):
            got[i].append(x)
    for i, w in enumerate(words):
        r = "".join(letter[symbol[c]] for c in w)
        all_of = {r} | {r[:j] + r[j + 1 :] for j in range(len(r))}
        all_of |= {r[:j] + x + r[j + 1 :] for j in range(len(r)) for x in letter.values()}
        all_of |= {r[:j] + x + r[j:] for j in range(len(r) + 1) for x in letter.values()}
        assert sorted(got[i]) == sorted(spelling.reduced_keys(sorted(all_of)).tolist())


def test_positions_in_blocks(monkeypatch):
    words = ["abcdefghij" * 3, "abcdefg"]
    whole = sorted(x for _, key in spelling.neighbourhood(words) for x in key.tolist())
    monkeypatch.setattr(spelling, "BLOCK", 100)
    assert whole == sorted(x for _, key in spelling.neighbourhood(words) for x in key.tolist())


def test_variants_equal_brute_force(spark):
    base = ["".join(RND.choice("abcde") for _ in range(RND.randint(7, 9))) for _ in range(60)]
    n: dict[str, int] = {}
    for w in base:
        n[w] = RND.choice((2, 30, 500, 20_000))
        for _ in range(6):
            j, x = RND.randrange(len(w)), RND.choice("abcdeéÿ")
            v = RND.choice((w[:j] + x + w[j:], w[:j] + w[j + 1 :], w[:j] + x + w[j + 1 :]))
            n.setdefault(v, RND.choice((2, 3, 30, 300)))
    n |= {"q" * 7: 2, "q" * 8: 20, "q" * 9: 200, "q" * 10: 2_000, "q" * 11: 20_000, "q" * 12: 200_000}  # a chain
    n |= {"tietiex": 2, "tietiea": 50, "tietieb": 50}
    got = {tuple(r) for r in spelling.variants(words_of(spark, n)).collect()}
    assert got == brute_variants(n)
    assert {r[2] for r in got if r[0].startswith("qqqqqqq")} == {"q" * 12}
    assert ("tietiex", "tietiea", "tietiea", 2, 2, 50) in got


def test_hot_reduced_words_and_a_long_word(spark):
    """All letters on one symbol: one class of reduced words per length."""
    n = {"".join(RND.choice("abcdefg") for _ in range(7)): k + 2 for k in range(200)} | {"x" * 5_000: 3, "x" * 4_999 + "y": 40}
    got = {tuple(r) for r in spelling.variants(words_of(spark, n), symbols=1).collect()}
    assert got == brute_variants(n)


def test_word_counts_and_edges(spark, odd):
    rows = [(1, "Abcdefgh abcdefgh ABCDEFGH"), (2, "École école éCOLES"), (None, "abcdefgh"), (3, None), (4, "x1abcdefghi_abcdefghi"), (5, "Ångström Ångström×")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in spelling.counted_words(df).collect()}
    assert got == {("abcdefgh", 4), ("abcdefghi", 2)}  # École and its like have 5 or 6 code points; the others occur once
    got = {tuple(r) for r in spelling.counted_words(df, min_chars=5, min_count=1).collect()}
    assert {("École", 1), ("école", 1), ("école" + "s", 1), ("Ångström", 1), ("Ångström×", 1)} <= got
    assert not spelling.variants(spelling.counted_words(odd.where("false"))).collect()
    assert spelling.variants(spelling.counted_words(odd, alter=spelling.dropped_letters)).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_dropped_letters(spark):
    rows = [(i, w) for i in range(400) for w in ("abcdefgh", "éàçèùôï")]
    df = spark.createDataFrame(rows, "doc_id long, word string")
    for r in df.select("*", spelling.dropped_letters(F.col("doc_id"), F.col("word")).alias("got")).collect():
        h = zlib.crc32(f"{r.doc_id}:{r.word}".encode())
        k = h % len(r.word)
        assert r.got == (r.word if h % 31 else r.word[:k] + r.word[k + 1 :])


def test_spelling_query_equals_brute_force(spark):
    n: Counter = Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        for w in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in w)
            h = zlib.crc32(f"{r.doc_id}:{w}".encode())
            n[w if h % 31 else w[: h % len(w)] + w[h % len(w) + 1 :]] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    assert {tuple(r) for r in QUERIES["op11_spelling_variants"](spark, SF).collect()} == brute_variants(n)


# ---- BPE


def library():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(default_path(bpe.TOKENIZER))
    tok.no_truncation()
    tok.no_padding()
    return tok


def test_bpe_equals_the_library():
    tok, own = library(), bpe.vocabulary(default_path(bpe.TOKENIZER))
    letters = "ab e\n\t  thing's 're'LL 12٣½éÀßñ中文字🙂'́\x1c\x85  !?.-_aaa"
    texts = ["".join(RND.choice(letters) for _ in range(RND.randint(0, 40))) for _ in range(3_000)]
    ids = [i for i in range(len(own.token)) if i != 50256]
    texts += [b"".join(own.token[RND.choice(ids)] for _ in range(RND.randint(1, 6))).decode("utf-8", "ignore") for _ in range(2_000)]
    texts += ["".join(chr(RND.choice((RND.randint(1, 0xD7FF), RND.randint(0xE000, 0x10FFFF)))) for _ in range(8)) for _ in range(1_000)]
    texts += ["a" * 5_000, "ab" * 3_000 + " " * 300 + "x", "<|endoftext|>a<|endoftext|><|endoftext", "the the " * 9_000]
    for t, raw in zip(texts, own.encode(texts), strict=True):
        want = tok.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(raw, "<u4").tolist() == want, t
        assert own.decode(raw) == tok.decode(want, skip_special_tokens=False)


def test_every_token_is_its_own_encoding_and_bytes_decode():
    own, tok = bpe.vocabulary(default_path(bpe.TOKENIZER)), library()
    ids = [i for i in range(len(own.token)) if i != 50256]
    assert own.encode_words([own.token[i] for i in ids]) == [[i] for i in ids]
    for _ in range(300):  # ids in any order: bytes that are no text
        some = [RND.choice(ids) for _ in range(6)]
        assert own.decode(np.array(some, "<u4").tobytes()) == tok.decode(some, skip_special_tokens=False)
    assert own.decode(np.array([64, 4_000_000_000, 65], "<u4").tobytes()) == "ab"


def test_trie_shares_prefixes():
    t = bpe.Trie([b"team", b"tea", b"ten", b"to", b"a", b"", b"\xff\x00", b"\xff\x00\x00"])
    assert t.words == [b"", b"a", b"tea", b"team", b"ten", b"to", b"\xff\x00", b"\xff\x00\x00"] and t.order[2:4] == [1, 0]
    assert t.depth == [0, 0, 0, 3, 2, 1, 0, 2]


def test_bpe_query_equals_the_library(spark):
    tok = library()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_bpe"](spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = tok.encode(d.text or "", add_special_tokens=False).ids
        assert got[d.doc_id] == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(tok.decode(ids, skip_special_tokens=False)))


def test_bpe_edges(odd):
    tok = library()
    out = bpe.decode(bpe.encode(odd))
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    got = sorted(((r.doc_id, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in out.collect()), key=repr)
    want = [(r.doc_id, len(i), i, tok.decode(i, skip_special_tokens=False)) for r in odd.select("doc_id", "text").collect() for i in [tok.encode(r.text or "", add_special_tokens=False).ids]]
    assert got == sorted(want, key=repr)
    assert not bpe.decode(bpe.encode(odd.where("false"))).collect()
    nulls = bpe.decode(odd.select("doc_id", F.lit(None).cast("binary").alias("ids"), F.lit(1).alias("decoded")))
    assert {r.decoded for r in nulls.collect()} == {None}
