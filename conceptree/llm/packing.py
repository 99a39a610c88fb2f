"""Mixture-controlled packing: deficit round-robin over source queues.

Every document is packed. The target proportions are the sources' shares of all tokens, so that
every source lasts to the end; mixing weights are realised before (see ``mixing``). Each source
is a queue in permuted order, and place ``p`` of a source with share ``w`` belongs to group
``p // (w * GROUP)``, so that a group of about ``GROUP`` tokens, packed by one task, holds all
sources in the target proportions. A window gives each source a quantum, its share of
the window's size; the source with the largest deficit is served until the window is full, and
deficits carry over to the next window. A turn ends where the deficit is used up, in the middle of
a document if need be, but not before ``TURN`` tokens, or the document's end, so that a window isn't cut into
pieces of a few tokens each. So no source whose queue lasts is ever ``TURN`` tokens or more ahead of its share of the
group's windows so far. Where the last document of a queue reaches beyond its group, the source starts
the next group with that deficit; when other queues have run out, the last windows of a group take what is left.

Windows have ``LENGTH`` tokens; what is left at the end of a group is cut into windows whose sizes
are powers of two, so no padding is needed anywhere. Only lengths are scheduled: texts are
tokenised once, and the ids are stored and shuffled once to be cut.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from conceptree.llm.blocks import group_key, running_totals
from conceptree.llm.tokens import WordTokenizer
from conceptree.llm.words import bounded, small_batches, stored
from conceptree.session import materialize

LENGTH = 4096
GROUP = 1 << 19
#: A turn takes so many tokens at least.
TURN = 128
_WINDOW_BITS = 24


def _tokenised(name: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(name, end)
        for whole in batches:
            for batch in bounded(whole, "text"):
                ids, first = tokenizer.encode(batch.column("text"))
                data = ids.astype(tokenizer.width).tobytes()
                width = np.dtype(tokenizer.width).itemsize
                own = [data[a * width : b * width] for a, b in zip(first.tolist(), first[1:].tolist(), strict=False)]
                kept = [batch.column(c) for c in ("doc_id", "source", "mark")]
                yield pa.record_batch(
                    [*kept, pa.array(np.diff(first)), pa.array(own, pa.binary())], ["doc_id", "source", "mark", "n", "ids"]
                )

    return run


def window_sizes(total: int) -> list[int]:
    """Full windows, then the binary digits of the rest."""
    rest = total % LENGTH
    return [LENGTH] * (total // LENGTH) + [1 << b for b in reversed(range(LENGTH.bit_length())) if rest >> b & 1]


def schedule(queues: list[list[int]], shares: np.ndarray, deficits: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Pieces (queue, document in it, start, length, window, offset) of one group.

    ``queues`` holds the documents' lengths, ``shares`` and ``deficits`` one number for each queue.
    """
    shares = shares / shares.sum()
    deficits = deficits.astype(float)
    head, start = [0] * len(queues), [0] * len(queues)
    idle = np.array([not q for q in queues])
    for window, size in enumerate(window_sizes(sum(map(sum, queues)))):
        deficits += shares * size
        offset = 0
        while offset < size:
            s = int(np.argmax(np.where(idle, -np.inf, deficits)))
            length = min(size - offset, queues[s][head[s]] - start[s], max(TURN, math.ceil(deficits[s])))
            yield s, head[s], start[s], length, window, offset
            offset += length
            start[s] += length
            deficits[s] -= length
            if start[s] == queues[s][head[s]]:
                head[s], start[s] = head[s] + 1, 0
                idle[s] = head[s] == len(queues[s])


def _schedules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group, source and place; all rows of a group are in one partition."""

    def done() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        source = np.array(rows.column("queue").to_pylist(), object)
        cuts = np.flatnonzero(source[1:] != source[:-1]) + 1
        n, place = rows.column("n").to_numpy(), rows.column("before").to_numpy()
        first = np.concatenate([[0], cuts])
        share = rows.column("share").to_numpy()[first]
        overhang = place[first] - int(group) * GROUP * share
        pieces = np.array(list(schedule([q.tolist() for q in np.split(n, cuts)], share, -overhang)), np.int64)
        row = first[pieces[:, 0]] + pieces[:, 1]
        if pieces[-1, 4] >> _WINDOW_BITS:
            raise ValueError("a group has more windows than sequence ids")
        taken = rows.select(["doc_id", "mark"]).take(pa.array(row)).combine_chunks().to_batches()[0]
        columns = [*taken.columns, *(pa.array(pieces[:, c]) for c in (2, 3)), pa.array((int(group) << _WINDOW_BITS) + pieces[:, 4]), pa.array(pieces[:, 5])]
        return pa.record_batch(columns, ["doc_id", "mark", "start", "length", "sequence_id", "offset"])

    held: list[pa.RecordBatch] = []
    group = None
    for batch in batches:
        groups = batch.column("group").to_numpy()
        cuts = [0, *(np.flatnonzero(groups[1:] != groups[:-1]) + 1).tolist(), len(groups)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                if held and groups[a] != group:
                    yield done()
                    held = []
                held.append(batch.slice(a, b - a))
                group = groups[a]
    if held:
        yield done()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of each document with a checksum of their ids."""
    for batch in batches:
        pieces = batch.column("pieces")
        n = batch.column("n").to_numpy()
        held = np.diff(pieces.offsets.to_numpy())
        flat = pieces.flatten()
        owner = np.repeat(np.arange(len(held)), held)
        start, length = (flat.field(f).to_numpy() for f in ("start", "length"))
        sums, last, ids = [], -1, np.zeros(0)
        for row, a, k in zip(owner.tolist(), start.tolist(), length.tolist(), strict=True):
            if row != last:
                data, last = batch.column("ids")[row].as_py(), row
                ids = np.frombuffer(data, f"<u{len(data) // n[row]}").astype("<u4")
            sums.append(zlib.crc32(ids[a : a + k]))
        yield pa.record_batch(
            [
                batch.column("doc_id").take(pa.array(owner)),
                flat.field("start"),
                flat.field("length"),
                pa.array(sums, pa.int64()),
                pa.array(n[owner]),
                flat.field("sequence_id"),
                flat.field("offset"),
            ],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        )


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end: int = 2, seed: int = 5) -> DataFrame:
    """One row for each piece of a document of ``docs`` (doc_id, source, text).

    doc_id, start (the document's tokens before the piece), length, ids_crc32 (of the ids as
    little-endian unsigned 32-bit numbers), doc_tokens (with the id ``end`` that closes each
    document), sequence_id, offset (gapless from 0 within a sequence). A null text is empty, null is a
    source and a doc_id like any other, and rows that repeat a document are packed once each.
    ``tokenizer`` is the name of a public tokenizer or a path that all executors have.
    An empty table gives no pieces; other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text")
    ).withColumn("mark", F.concat_ws("|", group_key("doc_id"), F.hex(F.xxhash64("text"))))
    kind = rows.schema["doc_id"].dataType.simpleString()
    coded = stored(
        rows.mapInArrow(_tokenised(tokenizer, end), f"doc_id {kind}, source string, mark string, n long, ids binary"), "tokens"
    )
    copies = coded.groupBy("doc_id", "source", "mark", "n").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    copies = materialize(copies.withColumn("queue", group_key("source")), "queued")
    repeated = not copies.groupBy("mark").agg(F.sum("copies").alias("all")).where("all > 1").isEmpty()
    total = copies.agg(F.sum(F.col("n") * F.col("copies"))).first()[0] or 1
    shares = copies.groupBy("queue").agg((F.sum(F.col("n") * F.col("copies")) / F.lit(float(total))).alias("share"))
    single = copies.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "source")
    placed = running_totals(single, "queue", ["mark", "copy"], "n", seed, 1 << 20).join(materialize(shares, "shares"), "queue")
    pieces = (
        placed.withColumn("group", F.floor(F.col("before") / (F.col("share") * GROUP)).cast("long"))
        .select("group", "queue", "before", "share", "doc_id", "mark", "n")
        .repartition("group")
        .sortWithinPartitions("group", "queue", "before")
        .mapInArrow(_schedules, f"doc_id {kind}, mark string, start long, length long, sequence_id long, offset long")
        .groupBy("mark")
        .agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    )
    if repeated:
        coded = coded.dropDuplicates(["mark"])
    return (
        coded.select("doc_id", "n", "ids", "mark")
        .join(pieces, "mark")
        .select("doc_id", "n", "ids", "pieces")
        .mapInArrow(
            _cut,
            f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
        )
    )
