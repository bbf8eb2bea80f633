"""The array and list parts against brute force."""

from __future__ import annotations

import itertools
import random

import numpy as np

from liftwise.llm import decontaminate, mtree, near_dup, packing, quality, substring, token_output, toxicity
from liftwise.llm.tokens import default_path, encoder
from liftwise.llm.words import words_of


def test_piece_encoder_equals_the_tokenizer():
    enc, rnd = encoder(default_path()), random.Random(1)
    letters = "aA bB\t\n'sdtreévmlÉßñ09½²_!?.,-ΣσİıŁ \x85\xa0\x1c　中文한ก́é🙂\x00"
    for _ in range(3000):
        x = "it's " + "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) + " don't"
        assert enc.encode([x])[0] == enc.whole(x)
    for x in ("", "<|endoftext|>", "a<|endoftext|>b"):
        assert enc.encode([x])[0] == enc.whole(x)


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    x, starts, trans = rng.normal(0, 2, 11), np.zeros(11, bool), rng.normal(0, 1, (2, 2))
    starts[[0, 4, 5]] = True
    p, _ = toxicity.forward_backward(x, starts, 0.4, trans)
    for a, b in ((0, 4), (4, 5), (5, 11)):
        total, mass = 0.0, np.zeros(b - a)
        for tags in itertools.product((0, 1), repeat=b - a):
            w = np.exp(0.4 * tags[0] + x[a:b] @ np.array(tags) + sum(trans[i, j] for i, j in itertools.pairwise(tags)))
            total, mass = total + w, mass + w * np.array(tags)
        assert np.allclose(mass / total, p[a:b])


def test_block_max_wand_equals_full_scores():
    rng = np.random.default_rng(1)
    items = [(i, " ".join(f"w{rng.zipf(1.3) % 300}" for _ in range(30))) for i in range(60)]
    index = decontaminate.Index(items, decontaminate.Params())
    n = len(index.part_item)
    for _ in range(60):
        terms = rng.choice(len(index.vocabulary), min(len(index.vocabulary), int(rng.integers(1, 120))), replace=False).tolist()
        full = np.zeros(n)
        for t in terms:
            full[index.postings[t].parts] += index.postings[t].weights
        for theta in (0.05, 0.2, 0.5):
            got = dict(decontaminate.block_max_wand([index.postings[t] for t in terms], theta, 8, 0, n))
            assert sorted(got) == np.flatnonzero(full >= theta - 1e-9).tolist()


def test_mtree_equals_all_scores():
    rng = np.random.default_rng(2)
    x = rng.integers(-40, 40, (900, 8)).astype(np.int64)
    x[100:400] = x[100]  # a third are one vector
    ids = rng.permutation(900)
    p = mtree.Params(leaf=16, fanout=6)
    ux, uid = mtree.distinct_best(x, ids, p.k)
    tree = mtree.MTree(ux, uid, float((x.astype(float) ** 2).sum(axis=1).max()), p)
    for i in range(0, 900, 30):
        s = x @ x[i]
        order = np.lexsort((ids, -s))
        exp = [(int(s[k]), int(ids[k])) for k in order if ids[k] != ids[i]][:5]
        assert tree.search(x[i], int(ids[i]), None) == exp
        assert tree.search(x[i], int(ids[i]), exp[-1][0]) == exp


def test_packing_keeps_every_id_within_the_limits():
    rnd = random.Random(4)
    for limits in (packing.Limits(64, 5, 64), packing.Limits(64, 64, 20)):
        ex = [packing.Example(i, np.arange(n, dtype=np.uint32).tobytes(), rnd.randint(0, n), n) for i in range(400) for n in [rnd.choice((1, 3, 20, 63, 64, 65, 500))]]
        seen: dict[int, list] = {}
        for s in packing.pack_stream(ex, limits):
            assert s.tokens <= limits.tokens and s.loss <= limits.loss and len(s.pieces) <= limits.segments
            for q in s.pieces:
                seen.setdefault(q.example.doc_id, []).append((q.start, q.length))
        for e in ex:
            at = 0
            for start, length in sorted(seen[e.doc_id]):
                assert start == at and length > 0
                at += length
            assert at == e.n


def test_capacity_tree_finds_the_best_fit():
    rnd, tree, rooms = random.Random(5), token_output.CapacityTree(50), []
    for k in range(2000):
        if rnd.random() < 0.6:
            r = rnd.randint(0, 50)
            tree.put(r, k)
            rooms.append(r)
        else:
            need = rnd.randint(1, 50)
            fit = min((r for r in rooms if r >= need), default=None)
            got = tree.take(need)
            assert (got[0] if got else None) == fit
            if got:
                rooms.remove(fit)


def test_compact_windows_partition_all_long_runs():
    v = np.random.default_rng(6).integers(0, 30, 60).astype(np.uint64)
    got = substring.compact_windows(v, 7)
    for i in range(60):
        for j in range(i + 6, 60):
            c = i + int(v[i : j + 1].argmin())
            assert sum(l <= i and j <= r and cc == c for l, cc, r in got) == 1
            assert sum(l <= i <= cc <= j <= r for l, cc, r in got) == 1


def test_bayesian_pruning_keeps_similar_pairs():
    p, rnd = near_dup.Params(), random.Random(7)
    base = [f"w{rnd.randint(0, 9999)}" for _ in range(300)]
    texts = [" ".join(base)]
    for edits in (1, 3, 5, 30, 80):
        t = list(base)
        for _ in range(edits):
            t[rnd.randrange(300)] = f"x{rnd.randint(0, 9999)}"
        texts.append(" ".join(t))
    w = words_of(texts)
    s, first = near_dup.all_shingles(w)
    sets = [set(s[a:b].tolist()) for a, b in zip(first, first[1:])]
    exp = {(i, j) for i in range(6) for j in range(i + 1, 6) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    i, j = near_dup.surviving_pairs(near_dup.minhash(s, first, p.values), None, p)
    assert exp and exp <= set(zip(i.tolist(), j.tolist())) and (4, 5) not in set(zip(i.tolist(), j.tolist()))
    ok = near_dup.linked_pairs(i, j, [np.array(sorted(x), np.uint64) for x in sets], 0.8)
    assert set(zip(i[ok].tolist(), j[ok].tolist())) == exp


def test_batch_features_equal_single_ones():
    p = quality.Params()
    texts = ["", "Ab ab ab", "a", "x" * 50 + " !! é", "\n\n", "end here"]
    model = quality.Model(p, np.random.default_rng(0).normal(size=(p.buckets, p.dim)), np.ones((p.dim, 2)) * [1, 2], np.zeros(2))
    score = model.scorer()
    assert np.allclose(score(texts)["score"], [score([t])["score"][0] for t in texts])


def test_cues_and_spans():
    rnd = random.Random(8)
    plain = [" ".join(f"word{rnd.randint(0, 200)}" for _ in range(40)) for _ in range(300)]
    y = np.array([i % 3 == 0 for i in range(300)], np.int64)
    texts = [t.replace(" ", f" badword{rnd.randint(0, 99)} ", 2) if k else t for t, k in zip(plain, y)]
    model = toxicity.train(texts, y)
    got = model.scorer()(["all fine word1 word2", "word1 BADWORD500, word2", ""])
    assert got["score"][0] < 0.5 < got["score"][1] and got["score"][2] < 0.5
    assert got["spans"] == [[], [{"start": 6, "end": 16}], []]
