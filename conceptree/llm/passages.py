"""Removal of passages that occur earlier, found by Aho-Corasick automata over words.

A window is ``WINDOW`` consecutive words of one document. Every word covered by a window whose
word sequence also starts earlier (in a smaller doc_id, or earlier in the same document) goes.

1. Each window is named by the smallest hash among its ``GRAM``-word runs, so equal windows have
   equal names, and neighbouring windows mostly share one. Names found once are left alone.
2. Windows under the other names are confirmed as recurring by counting their own hashes. The
   first place of a recurring window in the smallest doc_id is its home.
3. The recurring windows at home in one document make up one shard: an automaton of their words,
   compiled from the text. Every document that holds any of them is streamed through it, which
   gives the place of each occurrence by its text, not by a hash.
4. Occurrences other than the home are covered and their words removed.

No key gathers all its rows in one task: names and windows are counted with partial sums, a hot
window or home is split by the adaptive skew join, and an automaton holds one document's windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from conceptree.functions.tables import union_all
from conceptree.llm.words import Words, bounded, discard, grams, signed, sliding_min, small_batches, stored

WINDOW, GRAM = 20, 6


def _named(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Window hashes and names, by the word a window starts at (all texts in one row of words)."""
    h = words.hashes()
    return grams(h, WINDOW), sliding_min(grams(h, GRAM), WINDOW - GRAM + 1)


def _each(words: Words) -> Iterator[tuple[int, int, int]]:
    """(text, first window, end of windows) for texts that hold a window."""
    for d, (a, b) in enumerate(zip(words.first.tolist(), words.first[1:].tolist(), strict=False)):
        if b - a >= WINDOW:
            yield d, a, b - WINDOW + 1


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, doc_id, n): n is 2 if the document itself repeats a window of that name, else 1."""
    for whole in batches:
        for batch in bounded(whole, "text"):
            words = Words(batch.column("text"))
            windows, names = _named(words)
            ids = batch.column("doc_id").to_numpy()
            out, owner, twice = [], [], []
            for d, a, b in _each(words):
                name = np.unique(names[a:b])
                n = np.ones(len(name), np.int64)
                order = np.argsort(windows[a:b], kind="stable")
                same = np.flatnonzero(windows[a:b][order][1:] == windows[a:b][order][:-1])
                if len(same):
                    n[np.searchsorted(name, names[a:b][order[same]])] = 2
                out.append(name)
                owner.append(np.full(len(name), ids[d]))
                twice.append(n)
            if out:
                yield pa.record_batch(
                    [signed(np.concatenate(out)), pa.array(np.concatenate(owner)), pa.array(np.concatenate(twice))],
                    ["name", "doc_id", "n"],
                )


def _hex(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents without a recurring name are done; the others keep their text and windows.

    ``runs`` are the first and the last start of each row of windows under recurring names.
    """
    for whole in batches:
        for batch in bounded(whole, "text"):
            words = Words(batch.column("text"))
            _, names = _named(words)
            n = words.counts()
            runs: list = [None] * batch.num_rows
            wanted = batch.column("names")
            for d, a, b in _each(words):
                if wanted[d].is_valid:
                    mine = wanted[d].values.to_numpy().view(np.uint64)
                    at = np.flatnonzero(np.isin(names[a:b], mine))
                    if len(at):
                        cuts = np.flatnonzero(np.diff(at) > 1)
                        runs[d] = np.stack([at[np.append(0, cuts + 1)], at[np.append(cuts, len(at) - 1)]], axis=1).ravel()
            texts = batch.column("text").to_pylist()
            done = [_hex((t or "").encode().split()) if s is None else None for t, s in zip(texts, runs, strict=True)]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(n),
                    pa.array(done, pa.string()),
                    pa.array([None if s is None else t for t, s in zip(texts, runs, strict=True)], pa.string()),
                    pa.array(runs, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_words", "kept_sha256", "text", "runs"],
            )


def _starts(runs: pa.ListScalar) -> np.ndarray:
    return np.concatenate([np.arange(a, b + 1) for a, b in runs.values.to_numpy().reshape(-1, 2).tolist()])


def _hashed(whole: pa.RecordBatch) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray, int]]:
    """(doc_id, text, starts, their window hashes, row) of each document with its ``runs``."""
    row = 0
    for batch in bounded(whole, "text"):
        words = Words(batch.column("text"))
        windows = grams(words.hashes(), WINDOW)
        columns = (batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), words.first.tolist(), batch.column("runs"))
        for doc, text, first, runs in zip(*columns, strict=False):
            at = _starts(runs)
            yield doc, text.encode(), at, windows[first + at], row
            row += 1


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(window, doc_id, n): how often each window occurs in a document."""
    for batch in batches:
        for doc, _, _, hashes, _ in _hashed(batch):
            window, n = np.unique(hashes, return_counts=True)
            yield pa.record_batch([signed(window), pa.array(np.full(len(window), doc)), pa.array(n)], ["window", "doc_id", "n"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few record batches in place of many small ones."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= 1 << 16:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """(first word, number of words) of the stretches that windows at sorted ``starts`` cover."""
    cuts = np.flatnonzero(np.diff(starts) > WINDOW) + 1
    return [(int(p[0]), int(p[-1] - p[0]) + WINDOW) for p in np.split(starts, cuts) if len(p)]


def _covered(text: bytes, starts: np.ndarray) -> tuple[list[int], list[str]]:
    """Places and texts of the stretches that windows cover."""
    words, runs = text.split(), _runs(starts)
    return [a for a, _ in runs], [b" ".join(words[a : a + n]).decode() for a, n in runs]


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is streamed of a document: the stretches that its windows under recurring names cover."""
    for batch in batches:
        found = [_covered(text.encode(), _starts(runs)) for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs"), strict=True)]
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                pa.array([places for places, _ in found], pa.list_(pa.int64())),
                pa.array([texts for _, texts in found], pa.list_(pa.string())),
            ],
            ["doc_id", "places", "texts"],
        )


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches and first starts of the recurring windows that are at home in a document."""
    for batch in batches:
        wanted = batch.column("windows")
        out: list[list] = [[], [], [], []]
        for doc, text, at, hashes, row in _hashed(batch):
            window, first = np.unique(hashes, return_index=True)
            own = np.isin(window, wanted[row].values.to_numpy().view(np.uint64))
            starts = np.sort(at[first[own]])
            for column, value in zip(out, (doc, *_covered(text, starts), starts), strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()))
        yield pa.record_batch(
            [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["home", "home_places", "home_texts", "home_starts"]
        )


class Shard:
    """Automaton of the recurring windows that are at home in one document."""

    def __init__(self, places: list[int], texts: list[str], starts: np.ndarray):
        self.numbers: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        starts = np.sort(starts)
        for place, text in zip(places, texts, strict=True):
            letters = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in text.split(" "))
            inside = starts[np.searchsorted(starts, place) : np.searchsorted(starts, place + len(letters) - WINDOW, "right")]
            for start in inside.tolist():
                key = letters[start - place : start - place + WINDOW]
                if key not in self.automaton:
                    self.automaton.add_word(key, start)
        self.automaton.make_automaton()

    def occurrences(self, text: str) -> Iterator[tuple[int, int]]:
        """(start in ``text``, start at home) of each window, in words."""
        number = self.numbers.get
        for end, start in self.automaton.iter(tuple(number(w, 0) for w in text.split(" "))):
            yield end - WINDOW + 1, start


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, covered): starts of the windows of a document that are at home elsewhere or earlier."""
    home, shard = None, None
    for batch in batches:
        docs, covered = [], []
        columns = (batch.column(c) for c in ("home", "home_places", "home_texts", "home_starts", "doc_id", "places", "texts"))
        for at, home_places, home_texts, home_starts, doc, places, texts in zip(*columns, strict=True):
            if shard is None or at.as_py() != home:  # rows come sorted by home
                home = at.as_py()
                shard = Shard(home_places.as_py(), home_texts.as_py(), home_starts.values.to_numpy())
            doc = doc.as_py()
            found = [
                place + start
                for place, text in zip(places.as_py(), texts.as_py(), strict=True)
                for start, first in shard.occurrences(text)
                if doc != home or place + start > first
            ]
            if found:
                docs.append(doc)
                covered.append(found)
        if docs:
            yield pa.record_batch([pa.array(docs, pa.int64()), pa.array(covered, pa.list_(pa.int64()))], ["doc_id", "covered"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, digests = [], []
        for text, covered in zip(batch.column("text").to_pylist(), batch.column("covered"), strict=True):
            words = text.encode().split()
            gone = np.zeros(len(words) + 1, np.int64)
            if covered.is_valid:
                starts = np.unique(covered.values.to_numpy())
                starts = starts[starts + WINDOW <= len(words)]
                np.add.at(gone, starts, 1)
                np.add.at(gone, starts + WINDOW, -1)
            keep = np.cumsum(gone[:-1]) == 0
            left = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
            removed.append(len(words) - len(left))
            digests.append(_hex(left))
        yield pa.record_batch(
            [batch.column("doc_id"), batch.column("n_words"), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def remove_repeated_passages(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256.

    A null text has no words. Rows that repeat a doc_id are taken for copies of one document:
    each loses the words at the places found in any of them. Rows without a doc_id are returned
    with nothing removed. An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = stored(rows.where("doc_id is not null").mapInArrow(_names, "name long, doc_id long, n long"), "names")
    recurring = named.groupBy("name").agg(F.sum("n").alias("all")).where("all > 1").select("name")
    wanted = named.join(recurring, "name").groupBy("doc_id").agg(F.collect_list("name").alias("names"))
    split = stored(
        rows.join(wanted, "doc_id", "left").mapInArrow(
            _split,
            "doc_id long, n_words long, kept_sha256 string, text string, runs array<long>",
        ),
        "split",
    )
    discard(named)
    done = split.where("text is null").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256")
    open_docs = split.where("text is not null")
    windows = stored(
        open_docs.select("doc_id", "text", "runs").mapInArrow(lambda b: _merged(_windows(b)), "window long, doc_id long, n long"),
        "windows",
    )
    homes = stored(
        windows.groupBy("window").agg(F.min("doc_id").alias("home"), F.sum("n").alias("all")).where("all > 1").drop("all"),
        "homes",
    )
    routes = windows.join(homes, "window").where("doc_id <> home or n > 1").select("home", "doc_id").distinct()
    routes = stored(routes, "routes")
    discard(windows)
    at_home = homes.groupBy(F.col("home").alias("doc_id")).agg(F.collect_list("window").alias("windows"))
    shards = stored(
        open_docs.select("doc_id", "text", "runs")
        .join(at_home, "doc_id")
        .mapInArrow(_homes, "home long, home_places array<long>, home_texts array<string>, home_starts array<long>"),
        "shards",
    )
    discard(homes)
    streamed = open_docs.select("doc_id", "text", "runs").mapInArrow(_stretches, "doc_id long, places array<long>, texts array<string>")
    located = stored(
        routes.join(streamed, "doc_id")
        .join(shards, "home")
        .sortWithinPartitions("home")
        .mapInArrow(_located, "doc_id long, covered array<long>")
        .groupBy("doc_id")
        .agg(F.flatten(F.collect_list("covered")).alias("covered")),
        "located",
    )
    changed = (
        open_docs.select("doc_id", "n_words", "text")
        .join(located, "doc_id", "left")
        .mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    )
    return union_all(done, changed)
