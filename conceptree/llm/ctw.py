"""Language model scores by context-tree weighting over bytes.

A text is its UTF-8 bytes, A-Z lower-cased, and one end symbol. A byte is eight binary decisions;
each decision has a tree of contexts, the 0 to ``depth`` bytes before it. Every context estimates
the next bit by Krichevsky and Trofimov's rule from its counts; a context's weighted probability of
the training texts is half its own estimate and half the product of its longer contexts', so that a
bit's probability mixes the estimates of all depths by how well each of them explains the training.

The estimates depend on counts alone, so the trees are built from the counted runs of ``depth`` + 1
bytes of all training texts. A row stands for a context and a byte after it; climbing one depth is a
``groupBy`` of the shorter run, and going down again a join on it, so a key never gathers more than
256 rows. Scores are looked up by block: a block of texts asks once for each of its distinct runs
and words, and meets the answers in a co-group. The runs that most blocks ask for, a bounded number,
are handed to all tasks instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from conceptree.functions.tables import union_all
from conceptree.llm.langid import fold
from conceptree.llm.words import bounded, small_batches
from conceptree.session import materialize

#: Bytes of context. A run, context and byte, must fit into 63 bits.
DEPTH = 5
#: Bytes of text that share one table of runs and words, about.
BLOCK_BYTES = 16 << 20
SLICE_BYTES = 1 << 20
#: Scores of runs that all tasks hold, at most; 16 bytes each.
COMMON = 1 << 20
SMOOTHING = 0.1
_BLOCKS_OF_TASK = 1 << 24
_ROWS = 1 << 16  # of an Arrow batch that a task hands on
_SLICES = 8  # after which equal keys are added up
_END = 0xFF  # no byte of UTF-8
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_HALF = np.log(0.5)
_BITS = range(8)


class Texts:
    """Bytes of lower-cased texts one after the other, and the number of each."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray):
        self.data, self.sizes = data, sizes

    @classmethod
    def of(cls, texts: pa.Array) -> Texts:
        texts = pc.cast(texts, pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
        return cls(_LOWER[data], np.diff(offsets))

    def words(self) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Distinct words, the number of each word in that list, one after the other, and how many each text has."""
        offsets = np.append(0, np.cumsum(self.sizes)).astype(np.int64)
        array = pa.Array.from_buffers(
            pa.large_string(), len(self.sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(self.data))]
        )
        split = pc.ascii_split_whitespace(array)
        counts = pc.list_value_length(split).to_numpy().astype(np.int64)
        coded = pc.list_flatten(split).dictionary_encode()
        words, numbers = coded.dictionary, coded.indices.to_numpy()
        empty = pc.index(words, pa.scalar("", words.type)).as_py()  # beside white space that nothing precedes or follows
        if empty >= 0:
            full = numbers != empty
            counts = np.bincount(np.repeat(np.arange(len(counts)), counts)[full], minlength=len(counts))
            numbers = numbers[full] - (numbers[full] > empty)
            words = pa.concat_arrays([words[:empty], words[empty + 1 :]])
        return words, numbers, counts

    def runs(self, depth: int) -> np.ndarray:
        """For each byte and end symbol of the texts, it and the ``depth`` bytes before it as one number.

        What is before a text counts as end symbols.
        """
        n, gap = len(self.sizes), max(depth, 1)
        laid = np.full(len(self.data) + (n + 1) * gap, _END, np.uint8)
        laid[np.arange(len(self.data)) + gap * np.repeat(np.arange(1, n + 1), self.sizes)] = self.data
        runs = np.zeros(len(laid) - depth, np.int64)
        for k in range(depth + 1):
            runs <<= 8
            runs |= laid[k : len(laid) - depth + k]
        # What stands between an end symbol and the next text is not a text's.
        runs, stops = runs[gap - depth :], np.cumsum(self.sizes + gap)
        between = (stops[:-1, None] - np.arange(gap - 1)[None, ::-1] - 1).ravel()
        wanted = np.ones(int(stops[-1]) - gap + 1 if n else 0, bool)
        wanted[between] = False
        return runs[: len(wanted)][wanted]


def _added(keys: list[pa.Array], times: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """Distinct keys with the sum of their times."""
    table = pa.table({"key": pa.chunked_array(keys), "times": pa.chunked_array([pa.array(t, pa.int64()) for t in times])})
    table = table.group_by("key", use_threads=False).aggregate([("times", "sum")]).combine_chunks()
    return table["key"].combine_chunks(), table["times_sum"].combine_chunks()


class _Block:
    def __init__(self):
        self.size = self.slices = 0
        self.words: tuple[list, list] = ([], [])
        self.runs: tuple[list, list] = ([], [])

    def add(self, texts: Texts, training: np.ndarray, depth: int) -> None:
        self.size += len(texts.data)
        words, numbers, counts = texts.words()
        learnt = np.repeat(training, counts)
        self.words[0].append(words)
        self.words[1].append(np.bincount(numbers[learnt], minlength=len(words)))
        runs, learnt = texts.runs(depth), np.repeat(training, texts.sizes + 1)
        for own, weight in ((runs[learnt], 1), (runs[~learnt], 0)):
            found, times = np.unique(own, return_counts=True)
            self.runs[0].append(pa.array(found))
            self.runs[1].append(times * weight)
        self.slices += 1
        if self.slices % _SLICES == 0:
            self.words, self.runs = (([keys], [times.to_numpy()]) for keys, times in (_added(*self.words), _added(*self.runs)))

    def close(self) -> list[dict[str, pa.Array]]:
        """The distinct words and runs with their times; runs in order, as neighbours then compress together."""
        (word, times), (run, of_run) = _added(*self.words), _added(*self.runs)
        order = pc.sort_indices(run)
        return [{"word": word, "times": times}, {"run": run.take(order), "times": of_run.take(order)}]


def _blocks(schema: pa.Schema, depth: int, block_bytes: int):
    """Slices of texts, compressed, and the distinct words and runs of each block with their times in training."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() * _BLOCKS_OF_TASK, None

        def row(columns: dict[str, pa.Array]) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            columns = {"block": pa.array([number] * n, pa.int64()), **columns}
            return pa.record_batch([columns.get(f.name, pa.nulls(n, f.type)).cast(f.type) for f in schema], schema=schema)

        def closed(block: _Block) -> Iterator[pa.RecordBatch]:
            for columns in block.close():
                for i in range(0, len(columns["times"]), _ROWS):
                    yield row({name: column.slice(i, _ROWS) for name, column in columns.items()})

        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        for whole in batches:
            for batch in bounded(whole, "text", SLICE_BYTES):
                block = block or _Block()
                texts, held_out = Texts.of(batch.column("text")), batch.column("held_out")
                block.add(texts, ~held_out.to_numpy(zero_copy_only=False), depth)
                packed = pa.Codec("zstd", 3).compress(np.ascontiguousarray(texts.data), asbytes=True)
                columns = {"doc_ids": one(batch.column("doc_id")), "held": one(held_out), "sizes": one(pa.array(texts.sizes))}
                yield row({**columns, "packed": pa.array([packed], pa.binary())})
                if block.size >= block_bytes:
                    yield from closed(block)
                    number, block = number + 1, None
                    pa.default_memory_pool().release_unused()
        if block:
            yield from closed(block)

    return run


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Of positive numbers, by Stirling's series at ``x`` + 8."""
    y = x + 8
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z * (1 / 1188 - z * 691 / 360360))))) / y
    shifted = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series
    return shifted - np.log(reduce(np.multiply, [x + k for k in range(8)]))


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the estimate's probability of any sequence of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi) - log_gamma(zeros + ones + 1.0)


def _columns(name: str) -> list[str]:
    return [f"{name}{t}" for t in _BITS]


def weigh(runs: np.ndarray, times: np.ndarray, below: list[np.ndarray] | None) -> list[np.ndarray]:
    """Decisions of whole contexts, whose rows (context, byte) are sorted: 24 columns.

    ``below`` holds logarithms of the longer contexts' weighted probabilities, added up by row, and
    is missing at the greatest depth. For each bit of the byte the weight of the context's own
    estimate, that estimate for the bit, and the logarithm of the weighted probability; a decision
    that several rows share gives the last one in its first row, and 0 in the others.
    """
    out: list[list[np.ndarray]] = [[], [], []]
    for t in _BITS:
        node, bit = runs >> (8 - t), (runs >> (7 - t)) & 1
        first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        size = np.diff(np.append(first, len(runs)))
        total, ones = np.add.reduceat(times, first), np.add.reduceat(times * bit, first)
        own = log_kt(total - ones, ones)
        if below is None:
            mixed, weight = own, np.ones(len(first))
        else:
            mixed = _HALF + np.logaddexp(own, np.add.reduceat(below[t], first))
            weight = np.exp(_HALF + own - mixed)
        total, ones = np.repeat(total, size), np.repeat(ones, size)
        once = np.zeros(len(runs))
        once[first] = mixed
        for column, value in zip(out, (np.repeat(weight, size), (np.where(bit == 1, ones, total - ones) + 0.5) / (total + 1.0), once), strict=True):
            column.append(value)
    return [column for kind in out for column in kind]


def _weighed(leaf: bool):
    """``weigh`` over a sorted partition; the rows of its last context wait for the next batch."""
    names = ["run", *_columns("w"), *_columns("k"), *_columns("p")]

    def done(rows: pa.Table) -> pa.RecordBatch:
        below = None if leaf else [rows[c].to_numpy() for c in _columns("p")]
        found = weigh(rows["run"].to_numpy(), rows["times"].to_numpy(), below)
        return pa.record_batch([rows["run"].combine_chunks(), *map(pa.array, found)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.concat_tables([*([rows] if rows is not None else []), pa.Table.from_batches([batch])])
            contexts = rows["run"].to_numpy() >> 8
            stop = int(np.searchsorted(contexts, contexts[-1]))
            if stop:
                yield done(rows[:stop].combine_chunks())
                rows = rows[stop:]
        if rows is not None:
            yield done(rows.combine_chunks())

    return run


def run_scores(counted: DataFrame, depth: int) -> DataFrame:
    """(run, score): log10 of the probability of a run's last byte after the others.

    ``counted`` (run, times) has each distinct run of ``depth`` + 1 bytes with its times in training,
    0 for one that is only to be scored.
    """
    doubles = lambda *names: ", ".join(f"{c} double" for name in names for c in _columns(name))
    rows, levels = counted, []
    for d in range(depth, -1, -1):
        sorted_ = rows.repartition(F.shiftright("run", 8)).sortWithinPartitions("run")
        level = materialize(sorted_.mapInArrow(_weighed(d == depth), f"run long, {doubles('w', 'k', 'p')}"), f"contexts{d}")
        levels.append(level)
        if d:
            shorter = F.col("run").bitwiseAND((1 << 8 * d) - 1).alias("run")
            sums = level.groupBy(shorter).agg(*(F.sum(c).alias(c) for c in _columns("p")))
            times = rows.groupBy(shorter).agg(F.sum("times").alias("times"))
            rows = times.join(sums, "run")
    mixed = None
    for d, level in enumerate(reversed(levels)):
        weights = [F.lit(1.0) if d == depth else F.col(w) for w in _columns("w")]  # nothing is below the greatest depth
        pairs = [(w * F.col(k), 1 - w) for w, k in zip(weights, _columns("k"), strict=True)]
        if mixed is None:
            parts = level
        else:
            parts = level.withColumn("shorter", F.col("run").bitwiseAND((1 << 8 * d) - 1)).join(mixed, "shorter")
            pairs = [(F.col(a) + F.col(r) * own, F.col(r) * rest) for (own, rest), a, r in zip(pairs, _columns("a"), _columns("r"), strict=True)]
        if d == depth:
            return parts.select("run", sum((F.log10(a) for a, _ in pairs), F.lit(0.0)).alias("score"))
        values = [x.alias(c) for (a, r), t in zip(pairs, _BITS, strict=True) for x, c in ((a, f"a{t}"), (r, f"r{t}"))]
        mixed = parts.select(F.col("run").alias("shorter"), *values)
    raise ValueError("depth must not be negative")


def _uncommon(common: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column("run").to_numpy()
            yield batch.filter(pa.array(~_places(common, runs)[1]))

    return run


def _places(sorted_: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted number would stand, and whether it stands there."""
    at = np.minimum(np.searchsorted(sorted_, wanted), max(len(sorted_) - 1, 0))
    return at, sorted_[at] == wanted if len(sorted_) else np.zeros(len(wanted), bool)


def _common(scores: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs, sorted, and scores of those that most blocks ask for, ``most`` or fewer."""
    level = F.floor(4 * F.log2("asks")).cast("int")
    levels = sorted(((r["level"], r["n"]) for r in scores.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    taken, least = 0, None
    for own, n in levels:
        if taken + n > most:
            break
        taken, least = taken + n, own
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0)
    table = scores.where(level >= least).select("run", "score").toArrow()
    runs, values = table["run"].to_numpy(), table["score"].to_numpy()
    order = np.argsort(runs)
    return runs[order], values[order]


def _scored(depth: int, train_tokens: int, distinct: int, train_docs: int, common: tuple[np.ndarray, np.ndarray]):
    total = np.log10(train_tokens + SMOOTHING * (distinct + 1))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        of_words = right.select(["word", "value"]).filter(pc.is_valid(right["word"]))
        words, times = pc.cast(of_words["word"].combine_chunks(), pa.string()), of_words["value"].to_numpy()
        of_runs = right.select(["run", "value"]).filter(pc.is_valid(right["run"])).sort_by("run")
        own_scores = of_runs["run"].to_numpy(), of_runs["value"].to_numpy()
        del right, of_words, of_runs
        slices = []
        for i in range(len(left)):
            ids, held, sizes = (left[c][i].values for c in ("doc_ids", "held", "sizes"))
            sizes = sizes.to_numpy()
            data = pa.decompress(left["packed"][i].as_buffer(), int(sizes.sum()), codec="zstd")
            texts = Texts(np.frombuffer(data, np.uint8), sizes)
            slices.append((ids, held, texts, *texts.words()))
        # The words of the whole block are looked up at once.
        wanted = pa.concat_arrays([pa.array([], pa.string()), *(s[3].cast(pa.string()) for s in slices)])
        found = times[pc.index_in(wanted, words).to_numpy()] if len(wanted) else np.zeros(0)
        out, begin = [], 0
        for ids, held, texts, own_words, numbers, counts in slices:
            sizes, n = texts.sizes, len(texts.sizes)
            owner, own = np.repeat(np.arange(n), counts), found[begin : begin + len(own_words)][numbers]
            begin += len(own_words)
            known = np.bincount(owner[own > 0], minlength=n)
            base = np.bincount(owner, np.log10(own + SMOOTHING) - total, n)
            base += np.log10(train_docs + SMOOTHING) - total
            runs = pa.array(texts.runs(depth)).dictionary_encode()
            wanted = runs.dictionary.to_numpy()
            order = np.argsort(wanted)
            wanted = wanted[order]
            value = np.zeros(len(wanted))
            for known_runs, scores in (common, own_scores):
                at, here = _places(known_runs, wanted)
                value[order[here]] = scores[at[here]]
            size = sizes + 1
            score = np.add.reduceat(value[runs.indices.to_numpy()], np.cumsum(size) - size)
            columns = [
                ids, held, pa.array(counts + 1), pa.array(known + int(train_docs > 0)), pa.array(np.full(n, train_tokens)),
                pa.array(base), pa.array(score), pa.array(-score * np.log2(10) / size),
            ]
            out.append(pa.table(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]))
        return pa.concat_tables(out)

    return run


def score_texts(
    docs: DataFrame, folds: int = 10, held: int = 0, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES, most_common: int = COMMON
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of each row of ``docs`` (doc_id, text).

    Learns from all rows outside the fold ``held`` of crc32(doc_id). ``score`` is log10 of the
    model's probability of the lower-cased text with its end, ``bits_per_byte`` its code length.
    ``base_score`` is that of the text's words and end by their smoothed frequencies; of the words
    and end, ``n_known`` of ``n_tokens`` occur among the ``train_tokens`` learnt from.

    A null text is empty and has only its end. A row without doc_id is held out. Repeated rows count
    each, as in training so in the result. Texts may be of any length; a text of a block of its own
    is scored in slices of whole texts. Without training rows every bit has probability 1/2 and
    ``base_score`` is 0. Other columns are ignored.
    """
    if not 0 <= depth <= 6:
        raise ValueError("a run of bytes must fit into 63 bits: depth is 0 to 6")
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"block long, doc_ids array<{kind}>, held array<boolean>, sizes array<long>, packed binary, word string, run long, times long"
    )
    rows = docs.select(
        "doc_id", F.col("text").cast("string").alias("text"), F.coalesce(fold(folds) == held, F.lit(True)).alias("held_out")
    )
    made = rows.mapInArrow(_blocks(to_arrow_schema(StructType.fromDDL(schema)), depth, block_bytes), schema)
    stored = materialize(made, "blocks")
    asked = stored.withColumnRenamed("block", "asker")

    # A word has at most one row for each block, so its rows are few next to the texts.
    same = W.partitionBy("word")
    words = materialize(
        asked.where("word is not null").select(
            "asker", "word", "times", F.sum("times").over(same).alias("value"), (F.min("asker").over(same) == F.col("asker")).alias("first")
        ),
        "words",
    )
    learnt, vocabulary = words.agg(F.coalesce(F.sum("times"), F.lit(0)), F.count_if(F.expr("first and value > 0"))).first()
    train_docs = stored.where("packed is not null").agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0

    runs = asked.where("run is not null").select("asker", "run", "times")
    counted = materialize(runs.groupBy("run").agg(F.sum("times").alias("times"), F.count(F.lit(1)).alias("asks")), "runs")
    scores = materialize(run_scores(counted.select("run", "times"), depth).join(counted.select("run", "asks"), "run"), "scores")
    common = _common(scores, most_common)
    rest = runs.select("asker", "run").mapInArrow(_uncommon(common[0]), "asker long, run long")
    scores = rest.join(scores, "run")
    answers = union_all(
        words.select("asker", "word", F.lit(None).cast("long").alias("run"), F.col("value").cast("double")),
        scores.select("asker", F.lit(None).cast("string").alias("word"), "run", F.col("score").alias("value")),
    )
    texts = stored.where("packed is not null").select("block", "doc_ids", "held", "sizes", "packed")
    run = _scored(depth, learnt + train_docs, vocabulary + int(train_docs > 0), train_docs, common)
    out = (
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
        "bits_per_byte double"
    )
    return texts.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(run, out)
