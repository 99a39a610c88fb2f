"""Words of whole texts as flat arrays, hashed by numpy in Arrow batches.

A word is a longest run of bytes other than space, tab, line feed, vertical tab, form feed
and carriage return. A null text has no words.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from conceptree.functions.tables import union_all
from conceptree.session import materialize

#: Rows of one Arrow batch: bounds what a Python worker holds, whatever the texts' length.
BATCH_ROWS = 1000
_LONGEST = 1 << 16

_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = np.uint64(int(_random.integers(1, 1 << 61)) * 8 + 3)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GRAM = _random.integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = np.ones(1, np.uint64)


def small_batches(spark: SparkSession) -> None:
    """Have Spark hand texts to Python in batches of at most ``BATCH_ROWS`` rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    # Python workers import this package from where the driver has it.
    root, paths = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in (known := paths.get("PYTHONPATH", "").split(os.pathsep)):
        paths["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def stored(df: DataFrame, label: str) -> DataFrame:
    """``materialize``, and let Spark delete the shuffle files of the jobs that are done.

    It does so when the driver's garbage is collected, which may else be long after.
    """
    out = materialize(df, label)
    df.sparkSession._jvm.System.gc()
    return out


def discard(df: DataFrame) -> None:
    """Delete the table behind a ``stored`` frame that nothing reads any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h *= _MIX1
    h ^= h >> np.uint64(27)
    h *= _MIX2
    h ^= h >> np.uint64(31)
    return h


def _steps(longest: int) -> np.ndarray:
    global _powers
    longest = min(longest, _LONGEST)
    if len(_powers) < longest:
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(longest - 1, _STEP)]))
    return _powers


class Words:
    """``first[d]:first[d + 1]`` are the words of text ``d``; word ``i`` is ``data[starts[i]:ends[i]]``.

    ``data[borders[d]:borders[d + 1]]`` is text ``d``.
    """

    def __init__(self, texts: pa.Array):
        texts = pc.cast(texts, pa.large_string()).fill_null("")
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        whole = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        self.data = whole[offsets[0] : offsets[-1]]
        self.borders = borders = offsets - offsets[0]
        letter = ~_SPACE[self.data]
        n = len(letter)
        start = letter.copy()
        end = letter.copy()
        if n:
            start[1:] &= ~letter[:-1]
            end[:-1] &= ~letter[1:]
            at = borders[(borders > 0) & (borders < n)]  # a text's end also ends a word
            start[at] |= letter[at]
            end[at - 1] |= letter[at - 1]
        self.letter = letter
        self.starts = np.flatnonzero(start)
        self.ends = np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, borders, "left")
        self.first[-1] = len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """64 bits for each word; with ``lower``, A-Z count as a-z."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        letters = self.data[self.letter]
        if lower:
            letters = _LOWER[letters]
        lengths = self.ends - self.starts
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        within = np.arange(len(letters)) - np.repeat(begins, lengths)
        if lengths.max() > _LONGEST:
            within &= _LONGEST - 1
        value = _BYTE[letters]
        value *= _steps(int(lengths.max()))[within]
        h = np.add.reduceat(value, begins)
        h += lengths.astype(np.uint64) * _GRAM[63]
        return mix(h)

    def gram_starts(self, n: int) -> np.ndarray:
        """Marks each word at which a run of ``n`` words of one text starts."""
        marks = np.zeros(len(self.starts), bool)
        left = np.repeat(self.first[1:], self.counts()) - np.arange(len(self.starts))
        marks[left >= n] = True
        return marks


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each word on; the last ``n - 1`` entries are missing."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        out += h[j : len(h) - n + 1 + j] * _GRAM[j]
    return mix(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values."""
    if len(values) < width:
        return values[:0]
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def bounded(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``most`` bytes of text, and one row at least."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def connected(edges: DataFrame, store) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the smallest node it is linked to.

    Alternates large-star and small-star steps until the edges stop changing; only minima
    are gathered for a node, so a node of many edges is no hot spot. ``store`` writes a
    table to the shared folder and reads it back.
    """
    up = lambda df: df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    mark = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    now = store(up(edges), "edges")
    seen = mark(now)
    while True:
        both = union_all(now, now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        now = store(
            up(union_all(small.select(F.col("v").alias("u"), F.col("m").alias("v")), low.select("u", F.col("m").alias("v")))),
            "edges",
        )
        if (after := mark(now)) == seen:
            break
        seen = after
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return union_all(roots, now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
