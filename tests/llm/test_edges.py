"""Nulls, empty and very long texts, repeated rows, extra columns, empty tables; and brute force on small ones."""

import random
import zlib

import corpus_pipeline
import numpy as np
import pytest
from conftest import got
from pyspark.sql import functions as F

from conceptree.llm import linededup, mixing, packing, topk, warc
from conceptree.llm.blocks import group_key
from conceptree.llm.langid import identify_languages
from conceptree.llm.neardup import near_duplicates
from conceptree.llm.packing import pack, window_sizes
from conceptree.llm.passages import remove_repeated_passages
from conceptree.llm.quality import score_quality
from conceptree.llm.rules import quality_rules

CLASHING = ("n_chars long, score double, key long, mark string, n long, block int, before long, _removed int, _doc long, "
            "_id long, _mark string, _copy int, _times int, _lang_pred string, _score double")  # fmt: skip
SCHEMA = "doc_id long, text string, lang string, source string, " + CLASHING
WORDS = [f"{a}{b}" for a in ("the", "an", "or", "wh", "st", "ly") for b in ("ing", "er", "ed", "ion", "es", "ou")]


def prose(seed, n=80):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


TEXT, GERMAN = prose(1), "der die und schön über größe nicht " * 9
ROWS = [
    (1, TEXT, "en", "a"), (2, TEXT, "en", "a"), (2, TEXT, "en", "a"), (3, None, None, None), (4, "", "en", "a"),
    (None, prose(2), "de", None), (5, "word " * 30_000, "en", "b"), (6, "1234 !!", None, "b"), (7, GERMAN, "de", "a"),
]


@pytest.fixture(scope="module")
def docs(make, spark):
    rows = make("doc_id long, text string, lang string, source string", *ROWS)
    for name, kind in [c.split(" ") for c in CLASHING.split(", ")]:
        rows = rows.withColumn(name, F.lit(7).cast(kind))
    return rows


@pytest.fixture(scope="module")
def none(make):
    return make(SCHEMA)


def test_rules(docs, none):
    found = {r["doc_id"]: r for r in quality_rules(docs).collect()}
    assert (found[3]["n_words"], found[3]["kept"], found[5]["n_repeat_words"], found[5]["kept"]) == (0, False, 30_000, False)
    assert quality_rules(docs).count() == len(ROWS) and quality_rules(none).count() == 0


def test_near_duplicates(docs, none):
    found = got(near_duplicates(docs, shingle=4), "doc_id", "component_id", "kept")
    assert sorted(found, key=repr) == sorted(
        [(1, 1, True), (2, 1, False), (2, 1, False), (3, 3, True), (4, 4, True), (5, 5, True), (6, 6, True), (7, 7, True), (None, None, True)],
        key=repr,
    )
    assert near_duplicates(none).count() == 0


def test_passages(docs, none):
    found = {r["doc_id"]: r for r in remove_repeated_passages(docs).collect()}
    assert (found[1]["n_removed"], found[2]["n_removed"], found[3]["n_words"]) == (0, 80, 0)
    assert found[5]["n_removed"] == 30_000 - 1 and found[None]["n_removed"] == 0
    assert remove_repeated_passages(none).count() == 0


def test_packing(docs, none):
    pieces = pack(docs).collect()
    held = {}
    for p in pieces:
        held.setdefault(p["doc_id"], []).append(p)
    total = {k: sum(p["length"] for p in v) for k, v in held.items()}
    assert total[3] == total[4] == 1 and held[3][0]["ids_crc32"] == zlib.crc32((2).to_bytes(4, "little"))
    assert total[2] == 2 * total[1] and total[5] == held[5][0]["doc_tokens"] == 30_001
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096 and at & (at - 1) == 0
    assert window_sizes(4096 + 5) == [4096, 4, 1] and pack(none).count() == 0


def test_mixing(docs, none):
    drawn = mixing.mix_sources(docs, entropy=1.0, max_repeats=2.0).collect()
    assert {r["source"] for r in drawn} == {"a", "b", None} and max(r["epoch"] for r in drawn) == 1
    assert mixing.mix_sources(none).count() == 0
    kept = mixing.mixed_documents(docs, entropy=0.9, max_repeats=1.0, steepest=1.0)
    assert kept.columns == docs.columns and 0 < kept.count() <= len(ROWS)


def test_lines(docs, none, make):
    assert linededup.remove_shared_lines(none).count() == 0
    left = dict(got(linededup.remove_shared_lines(docs), "doc_id", "text"))
    assert (left[1], left[2], left[3], left[4]) == (TEXT, "", None, "")
    a, b, c = prose(3, 9), prose(4, 9), prose(5, 9)
    rows = make("doc_id long, text string", (1, f"{a}\nx\n{b}\n{c}"), (2, f"new\n{a}\n{b}"), (3, f"{c}\n{b}\nown"))
    assert dict(got(linededup.remove_shared_lines(rows), "doc_id", "text")) == {1: f"{a}\nx\n{b}\n{c}", 2: "new", 3: f"{b}\nown"}
    for seed in range(200):
        rng = random.Random(seed)
        x, y = ([rng.randint(0, 6) for _ in range(rng.randint(0, 12))] for _ in range(2))
        pairs = linededup.patience(x, y)
        assert all(x[i] == y[j] for i, j in pairs) and all(p < q and r < s for (p, r), (q, s) in zip(pairs, pairs[1:], strict=False))
        assert bool(pairs) == bool(set(x) & set(y))


def test_language_and_quality(docs, none, make):
    found = {r["doc_id"]: r for r in identify_languages(docs).collect()}
    assert (found[3]["lang_pred"], found[4]["lang_pred"], found[6]["lang_pred"]) == ("und", "und", "und")
    assert found[7]["lang_pred"] == "de" and found[None]["held_out"] and identify_languages(none).count() == 0
    labels = make("doc_id long, quality int, toxic int", (1, 1, 0), (2, None, 0), (5, 0, 0), (7, 1, 0), (None, 1, 0))
    scores = score_quality(docs, labels).collect()
    assert len(scores) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in scores)
    assert score_quality(none, labels).count() == 0 and score_quality(docs, labels.limit(0)).count() == len(ROWS)


def test_archives(spark, make):
    pages = make("page_id long, url string, html string", (1, "http://a b", "x" * 500), (2, None, "x" * 500), (3, "u", None), (4, "u", ""), (None, "v", "é"))
    found = {r["page_id"]: r for r in warc.read_pages(warc.write_pages(pages, warc.new_folder(spark))).collect()}
    assert (found[1]["record_type"], found[1]["refers_to"], found[2]["record_type"]) == ("revisit", 2, "response")
    assert (found[3]["refers_to"], found[3]["payload_bytes"], found[None]["payload_bytes"]) == (4, 0, 2)
    assert found[4]["payload_digest"] == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    many = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit(prose(9)), F.col("id").cast("string")).alias("html"))
    archives = warc.write_pages(many.coalesce(1), warc.new_folder(spark))
    assert archives.agg(F.max("dictionary_bytes")).first()[0] > 0
    assert dict(got(warc.read_pages(archives), "page_id", "payload")) == dict(got(many, "page_id", "html"))
    assert warc.read_pages(warc.write_pages(pages.limit(0), warc.new_folder(spark))).count() == 0


def test_top_k(make):
    rows = make(
        "vec_id long, embedding array<float>",
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [-1.0]), (20, [0.5, 0.5]),
    )
    found = got(topk.exact_top_k(rows, k=2), "query_id", "rank", "vec_id", "score")
    assert found == [(0, 1, 1, 4096), (0, 2, 2, 4096), (20, 1, 0, 2048), (20, 2, 1, 2048)]
    assert topk.exact_top_k(rows.limit(0)).count() == 0


def test_stages_on_odd_rows(spark, docs, none):
    for rows in (docs, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, rows, "")
            assert left.columns == rows.columns
            extra = {tuple(r) for r in left.drop("doc_id", "text", "lang", "source").collect()}
            assert extra <= {tuple(r) for r in rows.drop("doc_id", "text", "lang", "source").collect()}
        assert (corpus_pipeline.STAGES[-1][1](spark, rows, "").count() > 0) == (rows is docs)


def test_group_keys_tell_values_apart(make):
    rows = make("a string, b string", ("1va", "b"), ("1", "avb"), ("1v", "ab"), (None, "n"), ("n", None), ("", None), (None, ""))
    assert rows.select(group_key("a", "b").alias("key")).distinct().count() == 7


def test_lines_between_removed_ones(make):
    text = "a\n\nb\nc\n"
    rows = make("text string, gone array<int>", *[(text, gone) for gone in ([], [0], [4], [1, 3], [0, 1, 2, 3, 4], [2, 9])])
    left = [r[0] for r in rows.select(linededup._without("gone")).collect()]
    assert left == [text, "\nb\nc\n", "a\n\nb\nc", "a\nb\n", "", "a\n\nc\n"]


def test_windows_hold_target_proportions():
    """No source is a turn ahead of its share at any window's end while all queues last, and every token is served once."""
    rng = np.random.default_rng(4)
    for sources in (1, 2, 7, 20):
        tokens = rng.dirichlet(np.ones(sources)) * 300_000 + 5_000
        queues = []
        for t in tokens:
            queue = []
            while sum(queue) < t:
                queue.append(int(rng.integers(1, 3_000)))
            queues.append(queue)
        shares = np.array([sum(q) for q in queues], float)
        shares /= shares.sum()
        served, done, at = np.zeros(sources), 0, {}
        for s, k, start, length, window, offset in packing.schedule(queues, shares, np.zeros(sources)):
            assert start == at.get((s, k), 0) and length > 0
            at[s, k] = start + length
            served[s] += length
            done += length
            assert served[s] < shares[s] * min(sum(map(sum, queues)), (window + 1) * packing.LENGTH) + packing.TURN
        assert at == {(s, k): n for s, q in enumerate(queues) for k, n in enumerate(q)}
