"""Two tokenizers aligned by the bytes that their tokens cover.

Every text is tokenised twice, a space put before it. Offsets where tokens of both end cut the two
sequences into groups, and tokens of the two whose bytes overlap are linked. Within a task the work
is a pipeline of Arrow kernels: id lists are flattened with the indices of their parents, token
lengths summed up along each parent, the two sides' ends joined on (parent, end) by Acero, gaps
filled backwards so that each distinct end names one link, and links counted by ``Table.group_by``.
Spark adds up the counts of all tasks and hands each block of texts the totals it asks for.

A text is cut before a space that follows no white space, as neither tokenizer has a token across
such a place; what is between two cuts is a parent, and equal ones within a block are aligned once.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from conceptree.llm.tokens import _byte_letters, public_path
from conceptree.llm.words import bounded, small_batches
from conceptree.session import materialize

#: Bytes of text that share one table of units and pairs, about.
BLOCK_BYTES = 16 << 20
SLICE_BYTES = 1 << 20
_BLOCKS_OF_TASK = 1 << 24
_LOW = pa.scalar((1 << 32) - 1, pa.int64())
_WIDE = pa.scalar(32, pa.int64())
# Letters of which both libraries of the first tokenizer are known to think alike.
_UNUSUAL = re.compile("[^\n\t -~À-ÿ]")


class Pair:
    """Both tokenizers, and the bytes of each one's tokens."""

    def __init__(self, first: str, ranks: str, second: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(public_path(first))
        self.slow.encode_special_tokens = True
        with open(public_path(ranks), "rb") as lines:
            known = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
        self.fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})
        self.pieces = SentencePieceProcessor(model_file=public_path(second))
        letters = {c: b for b, c in enumerate(_byte_letters())}
        a = [b""] * (1 + max(self.slow.get_vocab().values()))
        for name, i in self.slow.get_vocab().items():
            a[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        b = [
            bytes([int(name[3:-1], 16)]) if self.pieces.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]
        self.cuts = not any(re.search("[^▁]▁", name) for name in names)
        self.bytes = [pa.array(x, pa.binary()) for x in (a, b)]
        self.lengths = [pa.array([len(y) for y in x], pa.int64()) for x in (a, b)]
        self.written = pa.array(
            [f"{i}{end}" for end, side in ((",", a), ("|", a), (",", b), (";", b)) for i in range(len(side))], pa.binary()
        )

    def encode(self, units: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids of units, each of which starts with the space that the second tokenizer puts there itself."""
        a = [
            self.slow.encode(u, add_special_tokens=False).ids if _UNUSUAL.search(u) else self.fast.encode_ordinary(u)
            for u in units
        ]
        b = self.pieces.encode([u[1:] for u in units], num_threads=1)
        return pa.array(a, pa.list_(pa.int32())), pa.array(b, pa.list_(pa.int32()))


@cache
def _pair(first: str, ranks: str, second: str) -> Pair:
    return Pair(first, ranks, second)


def cut(texts: pa.Array, cuts: bool = True) -> tuple[pa.Array, np.ndarray]:
    """Units of all texts one after the other, and where each text starts among them."""
    nothing, space = (pa.scalar(c, pa.large_string()) for c in ("", " "))
    spaced = pc.binary_join_element_wise(nothing, pc.cast(texts, pa.large_string()).fill_null(""), space)
    offsets = np.frombuffer(spaced.buffers()[1], np.int64)[spaced.offset : spaced.offset + len(spaced) + 1]
    data = np.frombuffer(spaced.buffers()[2], np.uint8)
    at = np.flatnonzero(data[:-1] == 32) if cuts else np.zeros(0, np.int64)
    at = at[(at > 2) & (at < offsets[-1])]
    one, two, three = data[at - 1], data[at - 2], data[at - 3]
    # Not after white space: plain characters, and those of two or three bytes in ranges without any.
    other = (one >= 0x80) & (((two >= 0xC3) & (two <= 0xDF)) | ((three >= 0xE4) & (three <= 0xEF)))
    at = at[((one > 32) & (one < 127)) | other]
    at = at[~np.isin(at + 1, offsets)]  # the space that ends a text stays with what is before it
    starts = np.union1d(offsets[:-1], at)
    bounds = np.append(starts, offsets[-1])
    units = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds), spaced.buffers()[2]])
    return units, np.searchsorted(bounds, offsets)


def _running(values: pa.Array) -> pa.Array:
    """Sums of all values before each place, and at the end of all."""
    return pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(values)]) if len(values) else pa.array([0], pa.int64())


def _ends(ids: pa.ListArray, lengths: pa.Array) -> pa.Table:
    """id, parent and the offset in the parent at which it ends, of every token."""
    flat, parent = pc.list_flatten(ids), pc.list_parent_indices(ids)
    running = _running(lengths.take(flat))
    before = running.take(ids.offsets[:-1]).take(parent)
    return pa.table({"id": flat, "parent": parent, "end": pc.subtract(running[1:], before)})


def _joined(ids: pa.ListArray, names: pa.Array) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, names.take(pc.list_flatten(ids))), b"")


def align(pair: Pair, units: list[str]) -> dict:
    """Tokens, groups and links of each unit; all zero where the tokens' bytes are not the unit's."""
    ids = pair.encode(units)
    n, whole = len(units), pa.array([u.encode() for u in units], pa.binary())
    same = pc.and_(*(pc.equal(_joined(x, names), whole) for x, names in zip(ids, pair.bytes, strict=True)))
    sides = []
    for x, lengths, name in zip(ids, pair.lengths, "ab", strict=True):
        side = _ends(x, lengths)
        side = side.filter(same.take(side["parent"]))
        key = pc.bit_wise_or(pc.shift_left(side["parent"], _WIDE), side["end"])
        sides.append((side, pa.table({"key": key, name: pa.array(np.arange(len(side)))})))
    (a, left), (b, right) = sides
    ends = left.join(right, "key", join_type="full outer", use_threads=False).sort_by("key").combine_chunks()
    here = [ends[name].combine_chunks() for name in "ab"]
    valid = [pc.is_valid(x).to_numpy(zero_copy_only=False) for x in here]
    both = valid[0] & valid[1]
    parent = pc.shift_right(ends["key"], _WIDE).to_numpy()
    a_ids, b_ids = (side["id"].combine_chunks() for side in (a, b))
    a_of, b_of = (x.take(pc.fill_null_backward(at)).cast(pa.int64()) for x, at in zip((a_ids, b_ids), here, strict=True))
    links = pc.bit_wise_or(pc.shift_left(a_of, _WIDE), b_of)

    # The tokens in the order in which they are written: by group, first side first.
    group = np.cumsum(both) - both
    groups = [group[v] for v in valid]
    held = [np.bincount(g, minlength=int(both.sum())) for g in groups]
    upto = [np.cumsum(h) for h in held]
    places = [np.arange(len(a)) + (upto[1] - held[1])[groups[0]], np.arange(len(b)) + upto[0][groups[1]]]
    sizes = [len(x) for x in pair.lengths]
    codes = np.zeros(len(a) + len(b), np.int64)
    codes[places[0]] = a_ids.to_numpy() + sizes[0] * both[valid[0]]
    codes[places[1]] = 2 * sizes[0] + b_ids.to_numpy() + sizes[1] * both[valid[1]]
    written = pair.written.take(pa.array(codes))
    count = lambda at: np.bincount(at, minlength=n)
    n_a, n_b = count(a["parent"].to_numpy()), count(b["parent"].to_numpy())
    token_at = np.frombuffer(written.buffers()[1], np.int32)[: len(written) + 1] if len(written) else np.zeros(1, np.int32)
    bounds = token_at[np.append(0, np.cumsum(n_a + n_b))].astype(np.int64)
    data = written.buffers()[2] if len(written) else pa.py_buffer(b"")
    return {
        "same": same.to_numpy(zero_copy_only=False),
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": count(parent[both]),
        "n_links": count(parent),
        "written": pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(bounds), data]),
        "links": links.to_numpy(),
    }


class Block:
    """The distinct units of a block of texts, aligned, and how often they occur in it."""

    def __init__(self, pair: Pair):
        self.pair, self.index, self.size = pair, {}, 0
        self.parts: dict[str, list] = {}
        self.times = np.zeros(0, np.int64)

    def all(self, name: str) -> np.ndarray:
        """A column of all units; the parts so far become one."""
        self.parts[name] = [np.concatenate(self.parts[name])]
        return self.parts[name][0]

    def numbers(self, units: pa.Array) -> np.ndarray:
        coded = units.dictionary_encode()
        names = coded.dictionary.to_pylist()
        new = [u for u in names if u not in self.index]
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        if new or not self.parts:
            for name, column in align(self.pair, new).items():
                self.parts.setdefault(name, []).append(column)
        own = np.fromiter((self.index[u] for u in names), np.int64, len(names))
        return own[coded.indices.to_numpy()]

    def documents(self, doc_id: pa.Array, texts: pa.Array) -> dict[str, pa.Array]:
        units, first = cut(texts, self.pair.cuts)
        numbers = self.numbers(units)
        at = first[:-1]
        empty = pc.equal(pc.binary_length(texts).fill_null(0), 0).to_numpy(zero_copy_only=False)
        good = np.logical_and.reduceat(self.all("same")[numbers], at) & ~empty
        numbers = numbers[np.repeat(good, np.diff(first))]
        first = np.append(0, np.cumsum(np.diff(first) * good))
        self.times = np.bincount(numbers, minlength=len(self.index)) + np.pad(self.times, (0, len(self.index) - len(self.times)))
        columns = {"doc_id": doc_id}
        for name in ("n_a", "n_b", "n_groups", "n_links"):
            sums = np.append(0, np.cumsum(self.all(name)[numbers]))
            columns[name] = pa.array(sums[first[1:]] - sums[first[:-1]])
        self.parts["written"] = [pa.concat_arrays(self.parts["written"])]
        text = self.parts["written"][0].take(pa.array(numbers))
        bounds = np.frombuffer(text.buffers()[1], np.int64)[first].tolist() if len(text) else [0] * len(first)
        data = memoryview(text.buffers()[2]) if len(text) else memoryview(b"")
        columns["groups_sha256"] = pa.array(
            [hashlib.sha256(data[a : b - 1]).hexdigest() if b > a else "" for a, b in zip(bounds, bounds[1:], strict=False)]
        )
        columns["units"] = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(numbers.astype(np.int32)))
        return columns

    def close(self) -> list[dict[str, pa.Array]]:
        """The distinct pairs with their number, and each unit's links as places in that list."""
        links, sizes = self.all("links"), self.all("n_links")
        counted = pa.table({"pair": links, "times": np.repeat(self.times, sizes)}).group_by("pair", use_threads=False).aggregate([("times", "sum")])
        pairs = counted["pair"].combine_chunks()
        places = pc.index_in(pa.array(links), pairs).cast(pa.int32())
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        return [
            {"pair": pairs, "place": pa.array(np.arange(len(pairs), dtype=np.int32)), "times": counted["times_sum"].combine_chunks()},
            {"sizes": one(pa.array(sizes.astype(np.int32))), "links": one(places)},
        ]


def _aligned(schema: pa.Schema, names: tuple[str, str, str], block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, number = _pair(*names), TaskContext.get().partitionId() * _BLOCKS_OF_TASK
        block = None

        def row(columns: dict[str, pa.Array]) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            columns = {"block": pa.array([number] * n, pa.int64()), **columns}
            return pa.record_batch([columns.get(f.name, pa.nulls(n, f.type)).cast(f.type) for f in schema], schema=schema)

        for whole in batches:
            for batch in bounded(whole, "text", SLICE_BYTES):
                block = block or Block(pair)
                yield row(block.documents(batch.column("doc_id"), batch.column("text")))
                block.size += batch.column("text").nbytes
                if block.size >= block_bytes:
                    yield from map(row, block.close())
                    number, block = number + 1, None
                    pa.default_memory_pool().release_unused()
        if block:
            yield from map(row, block.close())

    return run


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    running = np.append(0, np.cumsum(values))
    stop = np.cumsum(sizes)
    return running[stop] - running[stop - sizes]


def _counted(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of a block with the totals of the pairs that it asked for."""
    docs = left.filter(pc.is_valid(left["groups_sha256"])).combine_chunks()
    units = left.filter(pc.is_valid(left["sizes"])).combine_chunks()
    flat = lambda table, name: pc.list_flatten(table[name]).to_numpy()
    sizes, links = flat(units, "sizes"), flat(units, "links")
    held = pc.list_value_length(docs["units"]).to_numpy()
    numbers = flat(docs, "units")
    out = {name: docs[name] for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    for name in ("best", "total"):
        of_pair = np.zeros(len(right), np.int64)
        of_pair[right["place"].to_numpy()] = right[name].to_numpy()
        out[name] = pa.array(_sums(_sums(of_pair[links], sizes)[numbers], held), pa.int64())
    out["groups_sha256"] = docs["groups_sha256"]
    return pa.table(out).rename_columns(["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def align_tokenizers(
    docs: DataFrame,
    first: str = "byte_bpe_50k.json",
    ranks: str = "byte_bpe_50k.tiktoken",
    second: str = "piece_bpe_32k.model",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row of ``docs`` (doc_id, text).

    ``n_links`` tokens of the two sides overlap; ``count_sum`` adds up how many links of the corpus
    join the same two ids, and ``n_best`` counts those that no other partner of the second id beats.
    ``groups_sha256`` is the hash of the aligned groups, written ``a1,a2|b1;a3|b2,b3``.

    A null or empty text, and one that either tokenizer does not give back byte by byte (as U+2581
    in the text), has no tokens: zeros and an empty hash. Rows count one by one, repeated ones and
    those without doc_id too. Texts of any length are cut as above; one without spaces is one unit.
    Other columns are ignored. ``ranks`` is the vocabulary of ``first`` for a faster library.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"block long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, units array<int>, "
        "pair long, place int, times long, sizes array<int>, links array<int>"
    )
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    stored = materialize(rows.mapInArrow(_aligned(arrow, (first, ranks, second), block_bytes), schema), "aligned")
    asked = stored.where("place is not null").select(F.col("block").alias("asker"), "place", "pair", "times")
    totals = materialize(asked.where("times > 0").groupBy("pair").agg(F.sum("times").alias("total")), "pairs")
    second_id = F.col("pair").bitwiseAND((1 << 32) - 1)
    highest = totals.groupBy(second_id.alias("second")).agg(F.max("total").alias("highest"))
    rated = totals.withColumn("second", second_id).join(highest, "second").select(
        "pair", "total", (F.col("total") == F.col("highest")).cast("long").alias("best")
    )
    answers = asked.join(rated, "pair", "left").select(
        "asker", "place", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("best", F.lit(0)).alias("best")
    )
    held = stored.where("place is null").drop("pair", "place", "times")
    out = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return held.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(_counted, out)
