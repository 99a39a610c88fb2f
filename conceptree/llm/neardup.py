"""MinHash near-duplicates by a multi-index Hamming join.

A document's set is its distinct ``shingle``-word sequences (A-Z lower-cased); one with fewer
words has its whole sequence as the only element, one without words has none and is linked
with nothing. Two documents are linked if their sets' Jaccard similarity is at least
``percent`` / 100.

Signatures have ``CHUNKS * PARTS`` minima of ``b`` = 16 bits. Two signatures that differ in at
most ``2 * CHUNKS - 1`` of them agree, by the pigeonhole principle, in some chunk up to one
minimum. So each chunk is indexed once for each minimum that may be wrong, with that one left
out, and every pair under that distance shares a key. (Of pairs at similarity 0.8, one in
about 30,000 has a larger distance; of more similar ones, fewer.) Every candidate is confirmed
on the full sets.

Copies need not be expanded: equal sets are one class. A bucket is not expanded into pairs
either. First each member is tried against the smallest member it shares a key with. Then
only buckets whose members are not all connected yet are searched, and only across the
components that meet there: components with signatures under the distance make a family, and
within a family, dealt into blocks, pairs of different components are confirmed until it is
known what is connected. Only a forest of the links comes out, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from conceptree.functions.tables import union_all
from conceptree.llm.words import Words, bounded, connected, discard, grams, mix, signed, small_batches, stored

CHUNKS, PARTS = 16, 5
SIZE = CHUNKS * PARTS
DISTANCE = 2 * CHUNKS - 1
#: Members of a bucket that are compared in one task at a time.
BLOCK = 512

_random = np.random.Generator(np.random.PCG64(97))
_FLIP = _random.integers(0, 1 << 63, SIZE, dtype=np.uint64)
_TURN = _random.integers(0, 1 << 62, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = _random.integers(0, 1 << 63, SIZE, dtype=np.uint64)


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(texts)
    h = words.hashes(lower=True)
    g = grams(h, n)
    out = []
    for a, b in zip(words.first.tolist(), words.first[1:].tolist(), strict=False):
        if b - a >= n:
            out.append(np.unique(g[a : b - n + 1]))
        elif b > a:
            out.append(grams(h[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(h[:0])
    return out


def _signatures(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bounded(whole, "text", 2 << 20):
                sets = shingle_sets(batch.column("text"), n)
                sizes = np.array([len(s) for s in sets], np.int64)
                digests: list = [None] * len(sets)
                signatures: list = [None] * len(sets)
                full = np.flatnonzero(sizes)
                if len(full):
                    flat = np.concatenate([sets[i] for i in full])
                    begins = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                    sums = np.add.reduceat(flat, begins), np.add.reduceat(mix(flat ^ _SALT[0]), begins)
                    minima = np.empty((len(full), SIZE), np.uint16)
                    turned = np.empty_like(flat)
                    for k in range(SIZE):
                        np.bitwise_xor(flat, _FLIP[k], out=turned)
                        np.multiply(turned, _TURN[k], out=turned)
                        low = np.minimum.reduceat(turned, begins)
                        minima[:, k] = (mix(low) & np.uint64(0xFFFF)).astype(np.uint16)
                    for j, i in enumerate(full.tolist()):
                        digests[i] = sums[0][j].tobytes() + sums[1][j].tobytes() + sizes[i].tobytes()
                        signatures[i] = minima[j].tobytes()
                yield pa.record_batch(
                    [batch.column("doc_id"), pa.array(sizes), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
                    ["doc_id", "n_shingles", "digest", "signature"],
                )

    return run


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of each signature: a chunk without one of its minima, that one may differ."""
    for batch in batches:
        if not batch.num_rows:
            continue
        s = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, SIZE).astype(np.uint64)
        ids = batch.column("rep")
        for chunk in range(CHUNKS):
            for missing in range(PARTS):
                key = np.zeros(len(s), np.uint64)
                for part in range(PARTS):
                    if part != missing:
                        key = (key << np.uint64(16)) | s[:, chunk * PARTS + part]
                yield pa.record_batch([signed(mix(key ^ _SALT[chunk * PARTS + missing])), ids], ["key", "member"])


class _Merged:
    """Labels of a cell that are known to be connected."""

    def __init__(self, labels: np.ndarray):
        self.labels, self.at = np.unique(labels, return_inverse=True)
        self.root = np.arange(len(self.labels))

    def apart(self, i: int, others: np.ndarray) -> np.ndarray:
        return others[self.root[self.at[others]] != self.root[self.at[i]]]

    def merge(self, i: int, others: np.ndarray) -> None:
        roots = np.unique(self.root[self.at[np.append(others, i)]])
        self.root[np.isin(self.root, roots)] = roots[0]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        moved = np.flatnonzero(self.root != np.arange(len(self.root)))
        return self.labels[self.root[moved]], self.labels[moved]


def _near(s: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """Those of ``others`` within the signature distance of row ``i``, the nearest first."""
    found, far = [], []
    for c in range(0, len(others), 1 << 15):
        part = others[c : c + (1 << 15)]
        distance = (s[part] != s[i]).sum(axis=1)
        ok = distance <= DISTANCE
        found.append(part[ok])
        far.append(distance[ok])
    if not found:
        return others[:0]
    return np.concatenate(found)[np.argsort(np.concatenate(far), kind="stable")]


def _by_cell(one) -> object:
    """Apply ``one`` to each cell of rows that come sorted by it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            own = rows.column("own").to_numpy(zero_copy_only=False)
            if own.any() and not own.all():
                s = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint16).reshape(-1, SIZE)
                u, v = one(rows, np.flatnonzero(~own), np.flatnonzero(own), s)
                if len(u):
                    yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        held: list[pa.RecordBatch] = []
        cell = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("key", "block", "part")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for x, y in zip(cuts, cuts[1:], strict=False):
                if y > x:
                    if cell is not None and tuple(keys[x]) != cell:
                        yield from done()
                        held = []
                    held.append(batch.slice(x, y - x))
                    cell = tuple(keys[x])
        if held:
            yield from done()

    return run


def _meeting(rows: pa.Table, visits: np.ndarray, own: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels that come within the signature distance, as a forest."""
    merged = _Merged(rows.column("label").to_numpy())
    for i in visits.tolist():
        near = _near(s, i, merged.apart(i, own))
        if len(near):
            merged.merge(i, near)
    return merged.edges()


def _linking(n: int, percent: int):
    """Links between labels of a family that are not connected yet, as a forest."""

    def one(rows: pa.Table, visits: np.ndarray, own: np.ndarray, s: np.ndarray) -> tuple[list, list]:
        merged = _Merged(rows.column("label").to_numpy())
        sets = shingle_sets(rows.column("text"), n)
        member = rows.column("member").to_numpy()
        u, v = [], []
        for i in visits.tolist():
            rest = _near(s, i, merged.apart(i, own))
            while len(rest):
                j, rest = int(rest[0]), rest[1:]
                if _linked(sets[i], sets[j], percent):
                    u.append(int(member[i]))
                    v.append(int(member[j]))
                    merged.merge(i, np.array([j]))
                    rest = merged.apart(i, rest)
        return u, v

    return one


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if not len(x) or not len(y):
        return False
    if len(x) > len(y):
        x, y = y, x
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirm(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bounded(whole, "text_a", 1 << 20):
                left, right = (shingle_sets(batch.column(c), n) for c in ("text_a", "text_b"))
                near = [_linked(x, y, percent) for x, y in zip(left, right, strict=True)]
                yield batch.select(["a", "b"]).filter(pa.array(near))

    return run


def _cells(rows: DataFrame) -> DataFrame:
    """Deal the (member, label) rows of each key with several labels into cells (block, part).

    All rows are dealt into blocks, and those outside the key's largest label into parts too. A
    cell brings the rows of one block (``own``) together with those of one part, so rows of
    different labels meet, and a cell holds about twice ``BLOCK`` rows whatever the key's size.
    """
    sizes = (
        rows.groupBy("key", "label")
        .agg(F.count(F.lit(1)).alias("held"))
        .groupBy("key")
        .agg(F.max(F.struct("held", "label")).alias("top"), F.count(F.lit(1)).alias("labels"), F.sum("held").alias("n"))
        .where("labels > 1")
        .select(
            "key",
            F.col("top.label").alias("largest"),
            F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
            F.ceil((F.col("n") - F.col("top.held")) / BLOCK).cast("int").alias("parts"),
        )
    )
    block = F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int")
    part = F.pmod(F.xxhash64("member"), F.col("parts")).cast("int")
    own = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: F.struct(block.alias("block"), i.alias("part"), F.lit(True).alias("own")))
    visits = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(i.alias("block"), part.alias("part"), F.lit(False).alias("own")))
    cells = F.explode(F.when(F.col("label") == F.col("largest"), own).otherwise(F.concat(own, visits)))
    return rows.join(stored(sizes, "cell_sizes"), "key").withColumn("cell", cells).select("key", "cell.block", "cell.part", "cell.own", "member", "label")


def _sorted_cells(cells: DataFrame, *more: str) -> DataFrame:
    rows = cells.select("key", "block", "part", "own", "member", "label", *more)
    return rows.repartition("key", "block", "part").sortWithinPartitions("key", "block", "part")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id linked with the document over any number of
    links, itself included; ``kept`` marks the document that has it. Rows that repeat a doc_id
    are one document. A row without doc_id is linked with nothing, has no component and is kept.
    An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed_docs = stored(
        rows.mapInArrow(_signatures(shingle), "doc_id long, n_shingles long, digest binary, signature binary"), "signatures"
    )
    able = signed_docs.where("n_shingles > 0 and doc_id is not null")
    classes = stored(
        able.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature")), "classes"
    )
    keys = stored(classes.select("rep", "signature").mapInArrow(_keys, "key long, member long"), "keys")
    heads = keys.groupBy("key").agg(F.min("member").alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # Both sides are stored tables, so the adaptive skew join splits a hot key; heads grow with the documents.
    buckets = stored(keys.join(stored(heads, "heads").hint("merge"), "key"), "buckets")
    discard(keys)
    members = buckets.select(F.col("member").alias("doc_id")).distinct()
    texts = stored(rows.join(members, "doc_id").select("doc_id", "text"), "texts")
    signatures = classes.select(F.col("rep").alias("member"), "signature")

    # Each member against the smallest it shares a key with.
    first = buckets.where("member <> pivot").groupBy("member").agg(F.min("pivot").alias("pivot"))
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    pairs = first.select(F.col("pivot").alias("a"), F.col("member").alias("b")).join(right, "b").join(left, "a")
    pairs = pairs.select("a", "b", "text_a", "text_b").mapInArrow(_confirm(shingle, percent), "a long, b long")
    links = stored(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
    roots = connected(links, stored)

    # Buckets in which different components meet show the families to search.
    named = roots.select(F.col("node").alias("member"), "root")
    labelled = buckets.join(named, "member", "left").select("key", "member", F.coalesce("root", "member").alias("label"))
    labelled = stored(labelled, "labelled")
    discard(buckets)
    cells = _cells(labelled).join(signatures, "member")
    meeting = _sorted_cells(cells, "signature").mapInArrow(_by_cell(_meeting), "u long, v long").distinct()
    families = connected(meeting, stored).select(F.col("node").alias("label"), F.col("root").alias("key"))
    relatives = texts.select(F.col("doc_id").alias("member")).distinct().join(named, "member", "left")
    relatives = relatives.select("member", F.coalesce("root", "member").alias("label")).join(families, "label")
    cells = _cells(stored(relatives.select("key", "member", "label"), "relatives"))
    cells = cells.join(signatures, "member").join(texts.withColumnRenamed("doc_id", "member"), "member")
    more = stored(
        _sorted_cells(cells, "signature", "text").mapInArrow(_by_cell(_linking(shingle, percent)), "u long, v long"), "more"
    )
    if not more.isEmpty():
        star = roots.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v"))
        roots = connected(union_all(star, more), stored)

    # A doc_id of several rows may stand in several classes.
    named = classes.join(roots, F.col("rep") == F.col("node"), "left").select(
        "digest", F.coalesce("root", "rep").alias("component_id")
    )
    found = able.select("doc_id", "n_shingles", "digest").join(named, "digest").select("doc_id", "n_shingles", "component_id")
    alone = signed_docs.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return union_all(found, alone).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )
