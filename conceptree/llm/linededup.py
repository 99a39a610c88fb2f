"""Line removal by pairwise alignment of overlapping documents.

A line is compared by its words. Lines of at least ``min_words`` words are rare enough not to
recur by chance, and only these link documents: every later document that holds such a line, or
a run of 2, 4, 8, ... of them (shorter lines between do not count), is paired with the first one that
holds it, so what is in ``n`` documents makes ``n - 1`` pairs and none is missed, however common it
is. A document whose lines all equal an earlier one's loses all of them. Each pair is aligned on all lines of the two with patience
diff: lines that occur once in both are anchors, the longest increasing chain of them stays,
blocks grow from the anchors, and the gaps between are aligned in the same way. The aligned blocks
that hold a linking line are deleted whole from the later document, shorter and blank lines included;
shorter lines that stand alone may recur by chance and stay.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from conceptree.functions.tables import union_all
from conceptree.llm.blocks import free_name
from conceptree.llm.words import mix, small_batches
from conceptree.session import materialize

MIN_WORDS = 5
_STEP = np.uint64(0x9E3779B97F4A7C15)


def line_hash(words: list[bytes], min_words: int = MIN_WORDS) -> int:
    """Odd for lines that link documents."""
    return (xxhash.xxh3_64_intdigest(b" ".join(words)) & ~1 | (len(words) >= min_words)) - (1 << 63)


def _sequences(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, lines, wholes = [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = [line.split() for line in (text or "").encode().split(b"\n")]
                if any(words):
                    docs.append(doc)
                    lines.append(np.array([line_hash(w, min_words) for w in words], np.int64))
                    wholes.append(xxhash.xxh3_128_digest(lines[-1].tobytes()))
            if docs:
                yield pa.record_batch(
                    [pa.array(docs, pa.int64()), pa.array(lines, pa.list_(pa.int64())), pa.array(wholes, pa.binary())],
                    ["doc_id", "lines", "whole"],
                )

    return run


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What links documents: each linking line, and run of 2, 4, 8, ... of them, of each document once."""
    for batch in batches:
        lines = pc.list_flatten(batch.column("lines")).to_numpy()
        owner = pc.list_parent_indices(batch.column("lines")).to_numpy()
        links = (lines & 1) == 1
        run, owner = lines[links].view(np.uint64), owner[links]
        keys, owners, n = [run], [owner], 1
        while len(run) > n:
            run = mix(run[:-n] * _STEP + run[n:])
            n *= 2
            within = owner[: len(run)] == owner[n - 1 :]
            if not within.any():
                break
            keys.append(run[within])
            owners.append(owner[: len(run)][within])
        key, owner = np.concatenate(keys).view(np.int64), np.concatenate(owners)
        order = np.lexsort((key, owner))
        key, owner = key[order], owner[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        docs = batch.column("doc_id").to_numpy()[owner[new]]
        yield pa.record_batch([pa.array(key[new]), pa.array(docs, pa.int64())], ["key", "doc_id"])


def _chain(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain that increases in both numbers, of pairs sorted by the first."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        back.append(piles[at - 1] if at else -1)
        tops[at : at + 1] = [j]
        piles[at : at + 1] = [k]
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places (i, j) with ``a[i] == b[j]``, increasing in both."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1}
        anchors = _chain([(i, where[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in where])
        if anchors:
            edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
            out.extend(anchors)
            todo.extend((i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:], strict=False))
        else:  # only repeated lines in common: each goes with the next equal one
            at = defaultdict(list)
            for i in range(a0, a1):
                at[a[i]].append(i)
            last = a0 - 1
            for j in range(b0, b1):
                places = at.get(b[j], [])
                if (k := bisect_right(places, last)) < len(places):
                    last = places[k]
                    out.append((last, j))
    return sorted(out)


def _grown(a: list[int], b: list[int], pairs: list[tuple[int, int]]) -> list[int]:
    """Places in ``b`` of the aligned linking lines and of the equal shorter lines next to them, each aligned once."""
    out, last = [], (-1, -1)
    for (i, j), (next_i, next_j) in zip(pairs, [*pairs[1:], (len(a), len(b))], strict=False):
        p, q = i - 1, j - 1
        while p > last[0] and q > last[1] and a[p] == b[q] and not b[q] & 1:
            out.append(q)
            p, q = p - 1, q - 1
        out.append(j)
        p, q = i + 1, j + 1
        while p < next_i and q < next_j and a[p] == b[q] and not b[q] & 1:
            out.append(q)
            p, q = p + 1, q + 1
        last = p - 1, q - 1
    return out


def common_blocks(first: np.ndarray, later: np.ndarray) -> list[int]:
    """The places in ``later`` of the blocks that it has in common with ``first``, in the same order.

    Linking lines are aligned by themselves and, if some are repeated, among the shorter ones too,
    which tell repeats apart; the alignment with more linking lines, then with more lines, counts.
    """
    in_first, in_later = np.flatnonzero(np.isin(first, later)), np.flatnonzero(np.isin(later, first))
    a, b = first.tolist(), later.tolist()

    def aligned(at_a: list[int], at_b: list[int]) -> list[int]:
        pairs = patience([a[i] for i in at_a], [b[j] for j in at_b])
        return _grown(a, b, [(at_a[i], at_b[j]) for i, j in pairs if a[at_a[i]] & 1])

    long_a, long_b = (at[(x[at] & 1) == 1].tolist() for x, at in ((first, in_first), (later, in_later)))
    found = aligned(long_a, long_b)
    if any(len({x[i] for i in at}) < len(at) for x, at in ((a, long_a), (b, long_b))):
        found = max(found, aligned(in_first.tolist(), in_later.tolist()), key=lambda at: (sum(b[j] & 1 for j in at), len(at)))
    return sorted(found)


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, removed = [], []
        for doc, first, later in zip(batch.column("doc_id").to_pylist(), batch.column("first"), batch.column("later"), strict=True):
            docs.append(doc)
            removed.append(common_blocks(*(x.values.to_numpy(zero_copy_only=False) for x in (first, later))))
        yield pa.record_batch([pa.array(docs, pa.int64()), pa.array(removed, pa.list_(pa.int32()))], ["doc_id", "removed"])


def lines_to_remove(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, removed): the numbers, from 0, of the lines that go, for documents that lose any."""
    small_batches(docs.sparkSession)
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    every = materialize(rows.mapInArrow(_sequences(min_words), "doc_id long, lines array<long>, whole binary"), "line_sequences")
    firsts = materialize(every.groupBy("whole").agg(F.min("doc_id").alias("doc_id")), "first_copies").hint("merge")
    copies = every.join(firsts, ["whole", "doc_id"], "left_anti")
    copies = copies.select("doc_id", F.sequence(F.lit(0), F.size("lines") - 1).alias("removed"))
    held = materialize(every.join(firsts, ["whole", "doc_id"], "left_semi").select("doc_id", "lines"), "first_sequences")
    keys = materialize(held.mapInArrow(_keys, "key long, doc_id long"), "line_keys")
    homes = keys.groupBy("key").agg(F.min("doc_id").alias("home"), F.max("doc_id").alias("last")).where("home < last")
    # Homes grow with the lines: merge joins at every size, hot lines are split by the adaptive skew join.
    pairs = keys.join(homes.select("key", "home").hint("merge"), "key").where("doc_id <> home").select("doc_id", "home").distinct()
    pairs = materialize(pairs, "line_pairs")
    found = (
        pairs.join(held.select("doc_id", F.col("lines").alias("later")).hint("merge"), "doc_id")
        .join(held.select(F.col("doc_id").alias("home"), F.col("lines").alias("first")).hint("merge"), "home")
        .select("doc_id", "first", "later")
        .mapInArrow(_aligned, "doc_id long, removed array<int>")
    )
    lost = union_all(found, copies).groupBy("doc_id")
    return lost.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("removed")))).alias("removed"))


def remove_shared_lines(docs: DataFrame, min_words: int = MIN_WORDS, drop_emptied: bool = False) -> DataFrame:
    """``docs`` (doc_id, text, ...) without the lines that an earlier document holds in the same order.

    Its columns and rows stay; with ``drop_emptied``, documents that lose their last word go.
    "Earlier" is a smaller doc_id. Repeated lines of one document stay. A null text and rows
    without doc_id are left as they are; rows that repeat a doc_id are one document, and each loses the
    line numbers found in any of them. Other columns, whatever their names, go along. An empty table gives an empty result.
    """
    doc, removed = free_name(docs, "_doc"), free_name(docs, "_removed")
    found = materialize(lines_to_remove(docs, min_words), "lines_removed").select(F.col("doc_id").alias(doc), F.col("removed").alias(removed))
    rows = docs.join(found.hint("merge"), docs["doc_id"].cast("long") == F.col(doc), "left")
    rows = rows.withColumn("text", F.when(F.col(removed).isNull() | F.col("text").isNull(), F.col("text")).otherwise(_without(removed)))
    if drop_emptied:
        rows = rows.where(F.col(removed).isNull() | (F.btrim("text", F.lit(" \t\n\x0b\f\r")) != ""))
    return rows.select(*docs.columns)


def _without(removed: str) -> Column:
    """The text without the lines numbered in the sorted array ``removed``: what lies between them is copied once."""

    def kept(lines: Column) -> Column:
        edges = F.concat(F.array(F.lit(-1)), F.filter(removed, lambda i: i < F.size(lines)), F.array(F.size(lines)))
        return F.transform(F.array(edges), lambda at: F.flatten(F.transform(F.sequence(F.lit(1), F.size(at) - 1), lambda k: between(lines, at, k))))[0]

    def between(lines: Column, at: Column, k: Column) -> Column:
        before = F.element_at(at, k)
        return F.slice(lines, before + 2, F.element_at(at, k + 1) - before - 1)

    # Lambdas over arrays of one element, so that lines and edges are made once for a text.
    return F.array_join(F.transform(F.array(F.split("text", "\n", -1)), kept)[0], "\n")
