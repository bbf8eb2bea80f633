"""Values beyond the usual ranges, slices, byte-bounded caches, and limits that all bind."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from liftwise.llm import decontaminate, mtree, packing, token_output, tokens
from liftwise.llm.tokens import default_path, encoder

SF = "/root/testdata/sf0.001"
RND = random.Random(21)


def test_large_components_are_not_clipped(spark):
    data = [(0, [1.0, 0.0]), (1, [70_000.0, 0.0]), (2, [90_000.0, 0.0]), (3, [65_537.5, 1.0]), (4, [-90_000.0, 2.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in mtree.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 2, 5_898_240_000), (0, 2, 1, 4_587_520_000), (0, 3, 3, 4_295_065_600), (0, 4, 4, -5_898_240_000)]


def brute_top_k(x: dict[int, list[int]], queries: list[int], k: int) -> set[tuple]:
    top = (1 << 63) - 1
    out = set()
    for q in queries:
        s = sorted((-min(max(sum(a * b for a, b in zip(x[q], v, strict=True)), -top), top), i) for i, v in x.items() if i != q)
        out |= {(q, r + 1, i, -m) for r, (m, i) in enumerate(s[:k])}
    return out


@pytest.mark.parametrize("size", [300.0, 3e6, 3e12])
def test_top_k_equals_brute_force_at_any_size(spark, size):
    """The largest size has scores beyond 64 bits, which are the nearest 64-bit number."""
    data = [(i, [RND.uniform(-size, size) for _ in range(5)]) for i in range(300)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    x = {i: [int(np.floor(256 * c)) for c in v] for i, v in data}
    queries = [i for i in x if i % 50 == 0]
    got = {tuple(r) for r in mtree.top_k(df, F.col("vec_id") % 50 == 0, mtree.Params(leaf=8, fanout=4, cells=5, sample=40)).collect()}
    assert got == brute_top_k(x, queries, 5)


def test_scores_do_not_depend_on_slices(spark):
    words = [f"word{i}" for i in range(400)]
    items = [(i, " ".join(RND.choice(words) for _ in range(RND.randint(20, 150))) + ".") for i in range(120)]
    items += items[:3] + [(None, ""), (500, None)]  # repeated rows are one item
    docs = [(i, " ".join((" ".join(RND.choice(words) for _ in range(90)), t or "", "tail " * 9))) for i, t in items]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((tuple(r) for r in decontaminate.find_contamination(d, b).collect()), key=repr)
    got = sorted((tuple(r) for r in decontaminate.find_contamination(d, b, decontaminate.Params(slice_items=21)).collect()), key=repr)
    assert len(want) >= 120 and got == want
    assert not decontaminate.find_contamination(d, b.where("false")).collect()


def test_caches_are_bounded_by_bytes(monkeypatch):
    enc = tokens.PieceEncoder(default_path())
    texts = [" ".join(f"Word{RND.randint(0, 9999)}né" for _ in range(200)) for _ in range(20)]
    want = [enc.whole(t) for t in texts]
    monkeypatch.setattr(tokens, "CACHE_BYTES", 5_000)
    assert enc.encode(texts) == want
    for cache, most in ((enc.pieces, 6_000), (enc.pieces.words, 1_500)):
        assert cache.held <= most and len(cache.old) * tokens.ENTRY_BYTES <= most


def test_packing_rows_against_the_tokenizer(spark):
    """ids_crc32 and doc_tokens of every piece, and a whole cover of every document."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    enc = encoder(default_path())
    want = {r.doc_id: enc.whole(r.text or "") + np.uint32(1).tobytes() for r in docs.collect()}
    at: dict[int, int] = {}
    for r in packing.pack(docs).orderBy("doc_id", "start").collect():
        raw = want[r.doc_id][4 * r.start : 4 * (r.start + r.length)]
        assert (r.ids_crc32, r.doc_tokens, bytes(r.ids)) == (zlib.crc32(raw), len(want[r.doc_id]) // 4, raw)
        assert r.start == at.get(r.doc_id, 0)
        at[r.doc_id] = r.start + r.length
    assert at == {d: len(raw) // 4 for d, raw in want.items()}


def test_packing_where_all_three_limits_bind(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet").withColumn("n", F.length("text"))
    rows = turns.select(F.monotonically_increasing_id().alias("doc_id"), "text", F.when(F.col("turn") % 2 == 0, F.col("text")).alias("prompt"))
    limits = packing.Limits(tokens=512, segments=3, loss=200)
    got = packing.pack(rows, prompt_col="prompt", limits=limits, with_ids=False).collect()
    seqs: dict[int, list] = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append(r)
    sums = [(sum(r.length for r in s), len(s), sum(r.loss_tokens for r in s)) for s in seqs.values()]
    assert all(t <= 512 and n <= 3 and x <= 200 for t, n, x in sums)
    for s in seqs.values():  # gapless
        ends = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == ends
            ends += r.length
    assert {512} & {t for t, _, _ in sums} and {3} & {n for _, n, _ in sums} and {200} & {x for _, _, x in sums}


def test_written_matrix_is_read_back(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    token_output.write_matrix(docs, str(tmp_path / "matrix"), row_tokens=256)
    back = spark.read.parquet(str(tmp_path / "matrix"))
    enc, parts = encoder(default_path()), {}
    for r in token_output.unpack(back).collect():
        parts.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    for r in docs.collect():
        assert b"".join(x for _, x in sorted(parts[r.doc_id])) == enc.whole(r.text or "") + np.uint32(49407).tobytes()
