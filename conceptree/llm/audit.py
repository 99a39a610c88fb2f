"""How filters interact: the outcome of every step of every order, summed as wide packed counters.

A document is, for the audit, the mask of the filters that it fails. Each mask is mapped to one big
integer of 64-bit fields: for every order of the filters and every step of it three fields, of which
the one that holds for the mask is 1 (kept, removed here, or failing but removed earlier), then one
field for each filter that is the only one failed, then one that counts the document. The integers
of all documents of a part are added up, first by each task, then by part; no field can carry into
the next, as none grows faster than the last one, the number of documents, which is below 2**63.
Unpacking is to read the sum's bytes as 64-bit numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from conceptree.llm.words import small_batches
from conceptree.session import materialize

SPACE = " \t\n\x0b\f\r"
FILTERS = "ABCDE"
OUTCOMES = ("kept", "removed", "redundant")
FIELD = 8  # bytes
#: Parts whose sums a task holds before it hands them on.
MOST_PARTS = 256


class Counters:
    """Layout of the packed counters for a list of filters, one letter each."""

    def __init__(self, filters: str = FILTERS):
        self.filters = filters
        self.orders = ["".join(p) for p in permutations(filters)]
        self.steps = len(filters)
        self.cells = len(self.orders) * self.steps
        self.fields = self.cells * len(OUTCOMES) + self.steps + 1
        # bit of the filter at each step of each order, and of those before it
        self.own = np.array([[1 << filters.index(x) for x in order] for order in self.orders])
        self.before = np.cumsum(self.own, axis=1) - self.own
        self.packed = [self.pack(mask) for mask in range(1 << self.steps)]

    def pack(self, mask: int) -> int:
        """One document of this mask."""
        fails, gone = (mask & self.own) > 0, (mask & self.before) > 0
        outcomes = np.stack([~fails & ~gone, fails & ~gone, fails & gone], axis=-1)
        only = [mask == 1 << f for f in range(self.steps)]
        return int.from_bytes(np.concatenate([outcomes.ravel(), only, [True]]).astype("<u8").tobytes(), "little")

    def dump(self, total: int) -> bytes:
        return total.to_bytes(self.fields * FIELD, "little")

    def unpack(self, total: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Counts by (order, step, outcome), and of documents that fail one filter only."""
        fields = np.frombuffer(total, "<i8")
        cells = self.cells * len(OUTCOMES)
        return fields[:cells].reshape(len(self.orders), self.steps, len(OUTCOMES)), fields[cells : cells + self.steps]


def _failed(text: Column) -> list[Column]:
    """The conditions A to D."""
    trimmed = F.btrim(text, F.lit(SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))
    capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)).cast("long") < 50 * F.size(words).cast("long"),
        100 * capitals.cast("long") > 3 * F.char_length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    ]


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, good, toxic of each row of ``docs`` (doc_id, text, lang); bit k: it fails filter k.

    The last filter fails a text that a smaller doc_id holds too, found by its SHA-256. Only ids,
    digests and masks are shuffled, a first holder is looked for under (doc_id, digest), so that the
    copies of one text are spread over all tasks.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    mask = sum((F.when(failed, 1 << k).otherwise(0) for k, failed in enumerate(_failed(text))), F.lit(0))
    rows = materialize(
        docs.select(
            "doc_id",
            F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
            F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("digest"),
            mask.cast("int").alias("mask"),
        ),
        "audit",
    )
    firsts = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    one = lambda name: F.coalesce(F.max(F.col(name).cast("int") == 1), F.lit(False)).alias(name)
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(one("quality"), one("toxic"))
    copied = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return (
        rows.join(firsts, ["doc_id", "digest"], "left")
        .withColumn("mask", F.col("mask") + F.when(copied, 1 << 4).otherwise(0))
        .join(marks, "doc_id", "left")
        .select("part", "mask", F.coalesce("quality", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    )


_SUMS = "part string, everyone binary, good binary, toxic binary"


def _row(counters: Counters, part: str, sums: list[int]) -> pa.RecordBatch:
    columns = [pa.array([part]), *(pa.array([counters.dump(s)], pa.binary()) for s in sums)]
    return pa.record_batch(columns, ["part", "everyone", "good", "toxic"])


def _add_documents(counters: Counters):
    """Each task's sums by part: every document's integer, and again where it is good or toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, list[int]] = {}
        for batch in batches:
            alike = pa.Table.from_batches([batch]).group_by(["part", "mask", "good", "toxic"], use_threads=False).aggregate([([], "count_all")])
            for row in alike.to_pylist():
                amount = counters.packed[row["mask"]] * row["count_all"]
                sums = totals.setdefault(row["part"], [0, 0, 0])
                sums[0] += amount
                sums[1] += amount if row["good"] else 0
                sums[2] += amount if row["toxic"] else 0
            if len(totals) >= MOST_PARTS:
                yield from (_row(counters, part, sums) for part, sums in totals.items())
                totals = {}
        yield from (_row(counters, part, sums) for part, sums in totals.items())

    return run


def _add_sums(counters: Counters):
    """One row for each part of a partition that is sorted by part; only one part's sums are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sums = None, [0, 0, 0]
        for batch in batches:
            for own, *totals in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                if own != part:
                    if part is not None:
                        yield _row(counters, part, sums)
                    part, sums = own, [0, 0, 0]
                sums = [s + int.from_bytes(t, "little") for s, t in zip(sums, totals, strict=True)]
        if part is not None:
            yield _row(counters, part, sums)

    return run


_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _report(counters: Counters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = np.log2(counters.own).astype(int)
        order = np.repeat(counters.orders, counters.steps)
        step = np.tile(np.arange(1, counters.steps + 1, dtype=np.int32), len(counters.orders))
        for batch in batches:
            for part, *sums in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                (everyone, only), (good, _), (toxic, _) = map(counters.unpack, sums)
                removed = OUTCOMES.index("removed")
                shapley = np.array([everyone[..., removed][letters == f].sum() for f in range(counters.steps)])
                counts = [*np.moveaxis(everyone, -1, 0), only[letters], good[..., removed], toxic[..., removed], shapley[letters]]
                columns = [pa.array([part] * counters.cells), pa.array(order, pa.string()), pa.array(step)]
                yield pa.record_batch(
                    [*columns, *(pa.array(c.ravel(), pa.int64()) for c in counts)], ["part", "filter_order", "step", *_COUNTS]
                )

    return run


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part (lang), order of the filters A to E and step, with counts of documents.

    ``docs`` (doc_id, text, lang), ``labels`` (doc_id, quality, toxic). The filters fail a text that
    A: has fewer than 200 words; B: repeats more than half of them; C: has more than 3 % capitals
    A-Z; D: holds one of ``#$%&*|``; E: is the text of a smaller doc_id too.

    A null text is empty, a null lang the part ''. Rows count one by one: rows of one doc_id do not
    copy each other, a row without doc_id neither copies nor is labelled. A document with several
    labels is good or toxic if one of them says so. Other columns are ignored. No documents: no rows.
    """
    small_batches(docs.sparkSession)
    counters = Counters()
    sums = failure_masks(docs, labels).mapInArrow(_add_documents(counters), _SUMS)
    merged = sums.repartition("part").sortWithinPartitions("part").mapInArrow(_add_sums(counters), _SUMS)
    return merged.mapInArrow(_report(counters), f"part string, filter_order string, step int, {', '.join(f'{c} long' for c in _COUNTS)}")
