"""Operators on small tables: nulls, empties, ties, repeated rows, clashing columns."""

from __future__ import annotations

import datetime as dt
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from liftwise.llm import decontaminate, line_dedup, mtree, near_dup, packing, quality, substring, token_output, toxicity, url_filter
from liftwise.llm.tokens import default_path, encoder

SF = "/root/testdata/sf0.001"
RND = random.Random(9)
WORDS = [f"{a}{b}" for a in ("ka", "mo", "tiré", "sul", "ben", "or") for b in range(100, 400)]
PASSAGE = " ".join(RND.choice(WORDS) for _ in range(60))


def prose(n: int) -> str:
    return " ".join(RND.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    long = prose(3000)
    rows = [(1, prose(80)), (2, None), (3, ""), (4, "one two"), (5, "One, two!"), (6, prose(30) + "\n" + PASSAGE + "\n" + prose(30))]
    rows += [(7, PASSAGE + " " + prose(30)), (8, long), (9, long.replace(" ", "  ", 5)), (9, long.replace(" ", "  ", 5)), (None, PASSAGE), (10, "a line of text\nA LINE OF TEXT  \nshort")]
    rows += [(11, "a line of text\n\nmore words here")]
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, key long, n_lines int")


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((x is None, x) for x in r))


def empty(docs):
    return docs.where("false")


def test_line_dedup(docs):
    got = line_dedup.dedup_lines(docs)
    by = {r.doc_id: r for r in got.collect()}
    assert (by[10].text, by[10].n_lines, by[10].n_dropped) == ("a line of text\nA LINE OF TEXT  \nshort", 3, 0)
    assert (by[11].text, by[11].n_dropped) == ("\nmore words here", 1)
    assert (by[2].text, by[2].n_lines) == ("", 1) and by[None].text == PASSAGE and by[9].n_dropped == 0 and by[1].key == 1
    assert got.count() == docs.count() and not line_dedup.dedup_lines(empty(docs)).collect()


def test_near_duplicates(docs):
    by = {}
    for r in near_dup.near_duplicates(docs).collect():
        by.setdefault(r.doc_id, []).append((r.class_id, r.n_links, r.n_copies))
    assert by[8] == [(8, 2, 3)] and by[9] == [(8, 2, 3)] * 2 and by[5] == [(4, 1, 2)] and by[3] == [(2, 1, 2)]
    assert by[1] == [(1, 0, 1)] and by[None] == [(None, 0, 1)]
    kept = near_dup.drop_near_duplicates(docs)
    assert rows(kept, "doc_id") == [(1,), (2,), (4,), (6,), (7,), (8,), (10,), (11,), (None,)] and kept.columns == docs.columns
    assert not near_dup.near_duplicates(empty(docs)).collect()


def test_repeated_passages(docs):
    got = {(r.doc_id, r.ref_doc_id): r for r in substring.repeated_passages(docs).collect()}
    assert set(got) == {(7, 6), (9, 8)} and got[7, 6].length == 60 and got[9, 8].jaccard == 1.0
    assert not substring.repeated_passages(empty(docs)).collect()


def test_a_reference_with_a_phrase_does_not_hide_a_passage(spark):
    words = PASSAGE.split()
    texts = [" ".join(words[k : k + 14]) + " " + prose(60) for k in range(0, 46, 5)] + [prose(20) + " " + PASSAGE, PASSAGE + " " + prose(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert (11, 10) in {(r.doc_id, r.ref_doc_id) for r in substring.repeated_passages(df).collect()}


def test_decontamination(spark, docs):
    bench = spark.createDataFrame([(1, PASSAGE), (2, None), (3, ""), (4, prose(40)), (None, "one two")], "item_id long, text string")
    got = decontaminate.find_contamination(docs, bench)
    assert rows(got, "doc_id", "item_id") == [(4, None), (5, None), (6, 1), (7, 1), (None, 1)]
    assert decontaminate.drop_contaminated(docs, bench).columns == docs.columns
    assert not decontaminate.find_contamination(empty(docs), bench).collect()
    assert not decontaminate.find_contamination(docs, bench.where("false")).collect()


def test_packing_round_trip(docs):
    enc = encoder(default_path())
    want = sorted(enc.whole(r.text or "") + np.uint32(1).tobytes() for r in docs.collect())
    pieces: dict = {}
    for r in packing.pack(docs, limits=packing.Limits(256, 16, 256)).collect():
        assert r.offset + r.length <= 256
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.ids))
    assert b"".join(sorted(want)) and sum(len(x) for v in pieces.values() for _, x in v) == sum(map(len, want))
    one = b"".join(x for _, x in sorted(pieces[8, max(k[1] for k in pieces if k[0] == 8)]))
    assert one in want
    assert not packing.pack(empty(docs)).collect()


def test_matrix_round_trip(docs):
    packed = token_output.pack_matrix(docs, row_tokens=128)
    for r in packed.collect():
        assert len(r.ids) == 512 and r.cu_seqlens[-1] <= 128 and r.position_resets[: len(r.cu_seqlens) - 1] == r.cu_seqlens[:-1]
        assert (np.flatnonzero(token_output.position_ids(r.cu_seqlens, 128) == 0) == r.position_resets).all()
    enc, got = encoder(default_path()), {}
    for r in token_output.unpack(packed).where("doc_id IN (1, 6, 8)").collect():
        got.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    text = {r.doc_id: r.text for r in docs.collect()}
    for d, parts in got.items():
        assert b"".join(x for _, x in sorted(parts)) == enc.whole(text[d]) + np.uint32(49407).tobytes()
    assert len(got) == 3 and not token_output.pack_matrix(empty(docs)).collect()


def test_classifiers(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 1), (8, None, 1)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels, F.lit(True)).collect()
    assert len(got) == docs.count() and {r.score for r in got} == {0.5}  # one class only
    tox = toxicity.classify(docs, labels, F.lit(True)).collect()
    assert len(tox) == docs.count() and all(0 <= r.score <= 1 for r in tox)
    assert not quality.classify(empty(docs), labels, F.lit(True)).collect()


def test_held_out_accuracy(spark):
    from liftwise.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    for name, column, least in (("op10_quality", "quality", 0.97), ("op2_toxicity", "toxic", 0.93)):
        held = QUERIES[name](spark, sf).where("held_out").join(labels, "doc_id")
        assert held.agg(F.avg((F.col("predicted") == F.col(column)).cast("int"))).first()[0] >= least


def test_top_k_nulls_ties_and_repeats(spark):
    data = [(0, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [1.0]), (None, [1.0, 1.0]), (7, [-0.001, 9.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = rows(mtree.top_k(df, F.col("vec_id") % 50 == 0), "query_id", "rank", "vec_id", "score")
    assert got == [(0, 1, 1, 65536), (0, 2, 2, 65536), (0, 3, 2, 65536), (0, 4, 50, 0), (0, 5, 7, -256)] + [(50, 1, 7, 589824), (50, 2, 0, 0), (50, 3, 1, 0), (50, 4, 2, 0), (50, 5, 2, 0)]
    assert not mtree.top_k(df.where("false"), F.col("vec_id") % 50 == 0).collect()


def test_url_filter_as_of(spark):
    d = dt.date
    pages = [(1, "http://A.b.example.com./x", d(2020, 1, 5)), (2, "http://a.b.example.com", d(2020, 3, 1)), (3, None, d(2020, 1, 5)), (4, "http://other.org", None), (5, "https://u@example.com:80/?q", d(2021, 6, 1))]
    cap = spark.createDataFrame(pages, "page_id int, url string, fetch_date date")
    ent = [("l", "example.com", "add", d(2020, 1, 1)), ("l", "Example.com", "remove", d(2020, 2, 1)), ("l", "example.com", "add", d(2021, 1, 1)), ("m", "b.example.com", "add", d(2020, 1, 5)), ("m", "b.example.com", "remove", d(2020, 1, 5)), ("l", None, "add", d(2020, 1, 1))]
    entries = spark.createDataFrame(ent, "list string, domain string, action string, at date")
    got = rows(url_filter.filter_urls(cap, entries), "page_id", "blocked", "lists", "domains")
    assert got == [(1, True, "l", "example.com"), (2, False, "", ""), (3, False, "", ""), (4, False, "", ""), (5, True, "l", "example.com")]
    assert not url_filter.filter_urls(cap.where("false"), entries).collect()


def test_pipeline_against_single_stages(spark):
    """The pipeline's documents against brute force over its stages' rules."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.quality_stage(spark, docs, SF)
    lines = corpus_pipeline.line_dedup_stage(spark, kept, SF)
    text = {r.doc_id: r.text for r in kept.collect()}
    first: dict[str, int] = {}
    for i in sorted(text):
        for x in text[i].split("\n"):
            k = x.strip(" \t\n\x0b\x0c\r")
            k = "".join(c.lower() if c.isascii() else c for c in k)
            if len(k) >= 10:
                first.setdefault(k, i)
    for r in lines.collect():
        own = [x for x in text[r.doc_id].split("\n") if first.get("".join(c.lower() if c.isascii() else c for c in x.strip(" \t\n\x0b\x0c\r")), r.doc_id) == r.doc_id]
        assert hashlib.md5(r.text.encode()).digest() == hashlib.md5("\n".join(own).encode()).digest() and r.n_chars == len(r.text)
    assert lines.columns == docs.columns
    clean = corpus_pipeline.decontamination_stage(spark, corpus_pipeline.near_dup_stage(spark, lines, SF), SF)
    want = {r.doc_id for r in clean.collect()}
    got = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in got.select("doc_id").distinct().collect()} == want


def test_bitmap_keeps_every_wanted_row_and_few_others(spark):
    from liftwise.llm.common import rows_maybe_in

    rows = spark.range(-500, 20_000).select("id", F.lit("x").alias("page"))
    wanted = spark.range(-500, 20_000, 7).union(spark.range(3))
    kept = rows_maybe_in(rows, "id", wanted)
    assert kept.columns == ["id", "page"]
    assert wanted.join(kept, "id", "left_anti").count() == 0
    assert kept.count() <= wanted.distinct().count() + 100
    assert rows_maybe_in(rows, "id", wanted.limit(0)).count() == 0


def test_only_meetings_inside_found_passages_are_settled(spark):
    """A pair is compared again where it meets outside the passages found for it."""
    p = substring.Params()
    m = [(2, 1, t * p.functions, u * p.functions) for t, u in ((10, 110), (45, 145), (60, 160), (10, 300), (200, 7))] + [(3, 1, 10 * p.functions, 110 * p.functions)]
    meeting = spark.createDataFrame(m, "doc long, ref long, at long, ref_at long")
    done = spark.createDataFrame([(2, 1, 5, 50, 105)], "doc_id long, ref_doc_id long, start long, length long, ref_start long")
    left = {(r.doc, r.at // p.functions, r.ref_at // p.functions) for r in substring.outside(meeting, done, p).collect()}
    assert left == {(2, 60, 160), (2, 10, 300), (2, 200, 7), (3, 10, 110)}


def planted(k: int) -> tuple[list[str], str]:
    """50 words, and a text in which 40 of them recur in the same order (no passage)."""
    words = prose(50).split()
    return words, " ".join(f"{prose(45)} {' '.join(words[5:45])}" for _ in range(k)) + " " + prose(45)


def test_repeated_passages_hidden_by_references(spark):
    """Passages whose groups have smaller references that hold but a phrase of them. The pair
    (2, 3) is compared in the first round for x, too."""
    x, texts, both = prose(60), {}, set()
    for a in range(10, 610, 10):
        y, hides = planted(2)
        texts |= {a: hides, a + 1: f"{prose(40)} {x if a < 310 else ''} {prose(40)} {' '.join(y)} {prose(9)}", a + 2: f"{' '.join(y)} {prose(40)} {x if a < 310 else ''}"}
        both.add((a + 2, a + 1))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r.doc_id, r.ref_doc_id) for r in substring.repeated_passages(df).collect() if r.start < 10}
    assert both <= got


def test_repeated_passages_with_edits(spark):
    """One word in the middle of 50, and two words of 95: the similarity is 0.8."""
    texts, both = {}, set()
    for a in range(0, 1200, 2):
        n, edits = (50, (6 + a // 2 % 38,)) if a < 800 else (95, (20, 68))
        y = prose(n).split()
        z = [f"x{a}" if k in edits else w for k, w in enumerate(y)]
        texts |= {a: f"{prose(40)} {' '.join(y)} {prose(40)}", a + 1: f"{prose(30)} {' '.join(z)} {prose(50)}"}
        both.add((a + 1, a))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r.doc_id, r.ref_doc_id) for r in substring.repeated_passages(df).collect()}
    assert len(both - got) <= 3, sorted(both - got)


def test_contamination_after_a_quote(docs):
    """An early passage that scores as high as the real one but fails the check."""
    long, question, answer, short = prose(100), prose(30), prose(12), prose(60).split()
    short[55] = "z." + short[55]
    items = [(1, long), (2, question + "\n" + answer), (3, " ".join(short))]
    index = decontaminate.Index(items, decontaminate.Params())
    scattered = " ".join(w for w in reversed(answer.split()))
    edited = " ".join(w if k != 30 else "changed" for k, w in enumerate(short))
    texts = [
        f"{' '.join(long.split()[:64])} {prose(400)} {long}",
        f"{question} {scattered} {prose(400)} {question} {answer}",
        f"{' '.join(short[::-1])} {prose(400)} {edited} {prose(200)}",
    ]
    found = {(d, index.ids[item]): (q, a, at) for d, item, _, q, a, at in decontaminate.search_texts(index, texts)}
    assert set(found) == {(0, 1), (1, 2), (2, 3)}
    assert all(q >= 0.8 and a >= 0.8 and at >= 256 for q, a, at in found.values())
    assert not list(decontaminate.search_texts(index, [t[: len(t) // 3] for t in texts]))


def test_top_k_repeats_of_the_query_id(spark):
    """Seven rows of the query's own id do not push out other ids of the same vector. By the
    SQL each row of a query id asks: the best id comes once for each."""
    data = [(0, [1.0, 2.0])] * 7 + [(9, [1.0, 2.0])] * 2 + [(i, [1.0, 2.0]) for i in (3, 4, 5)] + [(i, [0.5, 0.1]) for i in (1, 2)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {(r["rank"], r.vec_id) for r in mtree.top_k(df, F.col("vec_id") == 0).collect()}
    assert got == {(k, 3) for k in range(1, 6)}
    ids = np.array([0] * 7 + [9] * 2 + [3, 4, 5, 6, 7, 8])
    assert mtree.distinct_best(np.ones((15, 2), np.int64), ids, 5)[1].tolist() == [0] * 5 + [3, 4, 5, 6, 7]
