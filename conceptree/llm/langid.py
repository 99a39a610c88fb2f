"""Language identification by unigrams, summed over all segmentations.

A language is a probability for each piece of a fixed public vocabulary. A word, lower-cased and
with a mark at its start, is scored by the forward algorithm, which sums the probabilities of all
its segmentations into pieces; a text's likelihood is the product over its words. The
probabilities are fitted by expectation-maximisation with the same sums, on the word counts of a
bounded sample of labelled documents. A character that no piece covers is a piece of its own kind.

A word of any length is summed over all its segmentations: pieces are looked for in overlapping runs
of ``LONGEST`` characters, and the sums at the last places go on from run to run. Only the fit takes
longer words run by run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F

from conceptree.llm.words import bounded, mix, small_batches
from conceptree.session import materialize

#: Documents of each language that the model is fitted on, about.
SAMPLE_ROWS = 4000
ROUNDS = 2
#: Longer words are read in runs of so many characters.
LONGEST = 48
UNKNOWN_LANGUAGE = "und"
_START = "▁"
_SCALE = 100.0  # for each character, so that products of probabilities stay in range
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BITS = 20
#: Distinct words whose scores a task keeps from batch to batch.
KNOWN = 1 << 19
_LETTER = regex.compile(r"\p{L}")


def public_pieces(name: str = "piece_bpe_32k.model") -> list[str]:
    """The pieces of a public vocabulary, without control and byte pieces."""
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=public_tokenizers.path(name))
    ids = range(model.get_piece_size())
    return sorted({model.id_to_piece(i) for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))})


def _codes(words: list[str]) -> np.ndarray:
    """Characters as rows of numbers; 0 is padding."""
    wide = np.array(words, dtype=np.str_)
    return wide.view(np.uint32).reshape(len(words), -1).astype(np.uint64)


class Pieces:
    """Finds pieces in words by hash; ``unknown`` is the number of an uncovered character.

    The beginnings of pieces are held too, so a search ends where no piece goes on.
    """

    def __init__(self, pieces: list[str]):
        self.size = len(pieces) + 1
        self.unknown = len(pieces)
        self.longest = max(map(len, pieces))
        codes = _codes(pieces)
        lengths = np.array([len(p) for p in pieces])
        h = np.zeros(len(pieces), np.uint64)
        begun, number = [], []
        for i in range(codes.shape[1]):
            on = np.flatnonzero(lengths > i)
            h[on] = h[on] * _STEP + codes[on, i] + np.uint64(1)
            begun.append(mix(h[on] + np.uint64(i + 1)))
            number.append(np.where(lengths[on] == i + 1, on, -1))
        keys, at = np.unique(np.concatenate(begun), return_inverse=True)
        self.number = np.full(len(keys), -1, np.int32)
        np.maximum.at(self.number, at, np.concatenate(number).astype(np.int32))
        self.tables = []  # each maps a slot to a key; a taken slot is looked for in the next
        left = np.arange(len(keys))
        while len(left):
            slots = np.full(1 << _BITS, -1, np.int32)
            slots[(keys[left] >> np.uint64(64 - _BITS)).astype(np.int64)] = left
            self.tables.append(slots)
            left = np.setdiff1d(left, slots)
        self.keys = np.append(keys, np.uint64(0))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The key of each hash, or -1."""
        slots = (hashes >> np.uint64(64 - _BITS)).astype(np.int64)
        found = self.tables[0][slots]
        missed = np.flatnonzero((self.keys[found] != hashes) & (found >= 0))
        for table in self.tables[1:]:
            found[missed] = key = table[slots[missed]]
            missed = missed[(self.keys[key] != hashes[missed]) & (key >= 0)]
        found[missed] = -1
        return found

    def matches(self, words: list[str]) -> tuple[np.ndarray, dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]]:
        """Lengths, and for (start, end) the rows in which a piece lies there and its number."""
        codes = _codes(words)
        lengths = np.array([len(w) for w in words])
        out = {}
        width = codes.shape[1]
        for a in range(width):
            rows = np.flatnonzero(lengths > a)
            h = np.zeros(len(rows), np.uint64)
            for b in range(a + 1, min(width, a + self.longest) + 1):
                if b > a + 1:
                    on = lengths[rows] >= b
                    rows, h = rows[on], h[on]
                if not len(rows):
                    break
                h = h * _STEP + codes[rows, b - 1] + np.uint64(1)
                key = self.find(mix(h + np.uint64(b - a)))
                number = np.where(key >= 0, self.number[key], -1)
                if b == a + 1:
                    out[a, b] = rows, np.where(number >= 0, number, self.unknown)
                elif (ok := number >= 0).any():
                    out[a, b] = rows[ok], number[ok]
                rows, h = rows[key >= 0], h[key >= 0]
        return lengths, out


def _runs(word: str) -> list[str]:
    word = _START + word.lower()
    return [word[i : i + LONGEST] for i in range(0, len(word), LONGEST)]


def _by_length(runs: list[str], most: int = 1 << 15) -> Iterator[np.ndarray]:
    """Numbers of runs of similar length."""
    order = np.argsort([len(r) for r in runs], kind="stable")
    sizes = np.array([len(r) for r in runs])[order]
    cuts = np.flatnonzero(np.diff((sizes + 3) // 4)) + 1
    for part in np.split(order, cuts):
        for i in range(0, len(part), most):
            yield part[i : i + most]


def forward(pieces: Pieces, words: list[str], p: np.ndarray) -> np.ndarray:
    """Log probability of each word under each language; ``p`` is scaled, pieces by languages."""
    out = np.zeros((len(words), p.shape[1]))
    sizes = np.array([*map(len, words)])
    if len(long := np.flatnonzero(sizes > LONGEST)):
        out[long] = _forward_long(pieces, [words[i] for i in long.tolist()], p)
    short = np.flatnonzero(sizes <= LONGEST)
    for part in _by_length([words[i] for i in short.tolist()]):
        part = short[part]
        lengths, matches = pieces.matches([words[i] for i in part.tolist()])
        alpha = np.zeros((lengths.max() + 1, len(part), p.shape[1]))
        alpha[0] = 1
        for (a, b), (rows, number) in sorted(matches.items()):
            alpha[b, rows] += alpha[a, rows] * p[number]
        out[part] = np.log(alpha[lengths, np.arange(len(part))]) - lengths[:, None] * np.log(_SCALE)
    return out


def _forward_long(pieces: Pieces, words: list[str], p: np.ndarray, most: int = 1 << 11) -> np.ndarray:
    """``forward`` for words of any length, all of them one character further at a time.

    The sums at the last ``pieces.longest`` places of each word are held, and scaled up now and then;
    about ``most`` runs are searched for pieces at once.
    """
    back, langs = pieces.longest - 1, p.shape[1]
    lengths = np.array([*map(len, words)])
    order = np.argsort(-lengths, kind="stable")
    lengths, padded = lengths[order], ["\0" * back + words[i] for i in order.tolist()]
    chance = np.vstack([p, np.zeros((1, langs))])  # the last row, -1: no piece
    last = np.zeros((len(words), pieces.longest, langs))  # the latest place first
    last[:, 0] = 1
    log = np.zeros((len(words), langs))
    at = 0
    while at < lengths[0]:
        on = int((lengths > at).sum())
        step = LONGEST * max(1, most // on)
        ends = np.minimum(lengths[:on] - at, step)
        counts = -(-ends // LONGEST)
        first = np.cumsum(counts) - counts
        runs = [padded[k][i : i + back + LONGEST] for k in range(on) for i in range(at, at + int(ends[k]), LONGEST)]
        number = np.full((len(runs), LONGEST, pieces.longest), -1, np.int32)
        for some in range(0, len(runs), most):
            for (a, b), (rows, found) in pieces.matches(runs[some : some + most])[1].items():
                if b > back:
                    number[some + rows, b - back - 1, b - a - 1] = found
        for t in range(int(ends[0])):
            going = int(np.searchsorted(-ends, -t))
            sums = (last[:going] * chance[number[first[:going] + t // LONGEST, t % LONGEST]]).sum(axis=1)
            last[:going, 1:] = last[:going, :-1]
            last[:going, 0] = sums
            if t % 16 == 15:
                top = last[:going].max(axis=1)
                last[:going] /= top[:, None]
                log[:going] += np.log(top)
        at += step
    out = np.zeros_like(log)
    out[order] = log + np.log(last[:, 0]) - lengths[:, None] * np.log(_SCALE)
    return out


def expected(pieces: Pieces, runs: list[str], weight: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Expected number of each piece over all segmentations; ``p`` is scaled, of one language."""
    counts = np.zeros(pieces.size)
    for part in _by_length(runs):
        lengths, matches = pieces.matches([runs[i] for i in part.tolist()])
        alpha = np.zeros((lengths.max() + 1, len(part)))
        beta = np.zeros_like(alpha)
        alpha[0] = 1
        beta[lengths, np.arange(len(part))] = 1
        order = sorted(matches.items())
        for (a, b), (rows, number) in order:
            alpha[b, rows] += alpha[a, rows] * p[number]
        for (a, b), (rows, number) in reversed(order):
            beta[a, rows] += p[number] * beta[b, rows]
        total = alpha[lengths, np.arange(len(part))] / weight[part]
        found = [alpha[a, rows] * p[number] * beta[b, rows] / total[rows] for (a, b), (rows, number) in order]
        counts += np.bincount(np.concatenate([number for _, (_, number) in order]), np.concatenate(found), minlength=pieces.size)
    return counts


def scaled(pieces: list[str], p: np.ndarray) -> np.ndarray:
    lengths = np.array([*map(len, pieces), 1])
    return p * (_SCALE ** lengths)[:, None]


def _flat_words(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """For each word the number of its distinct form, these forms, and the words of each text."""
    split = pc.ascii_split_whitespace(pc.cast(texts, pa.large_string()).fill_null(""))
    coded = split.flatten().dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist(), pc.list_value_length(split).to_numpy().astype(np.int64)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in bounded(whole, "text"):
            numbers, forms, counts = _flat_words(batch.column("text"))
            langs, of = np.unique(np.array(batch.column("lang").to_pylist(), object), return_inverse=True)
            if not forms:
                continue
            pairs, n = np.unique(np.repeat(of, counts) * len(forms) + numbers, return_counts=True)
            yield pa.record_batch(
                [
                    pa.array(langs[pairs // len(forms)], pa.string()),
                    pa.array(forms, pa.string()).take(pa.array(pairs % len(forms))),
                    pa.array(n),
                ],
                ["lang", "word", "n"],
            )


@dataclass
class LanguageModel:
    """``p[i, j]``: probability of piece ``i`` (the last: an uncovered character) in language ``j``."""

    languages: list[str]
    pieces: list[str]
    p: np.ndarray


def _expectations(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model.value.pieces)
        p = scaled(model.value.pieces, model.value.p)
        at = {lang: j for j, lang in enumerate(model.value.languages)}
        counts = np.zeros_like(p)
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            words, n = np.array(batch.column("word").to_pylist(), object), batch.column("n").to_numpy()
            for lang in np.unique(langs):
                runs, weight = [], []
                for word, k in zip(words[langs == lang], n[langs == lang].tolist(), strict=True):
                    for r in _runs(word) if word else ():
                        runs.append(r)
                        weight.append(k)
                if runs:
                    counts[:, at[lang]] += expected(pieces, runs, np.array(weight, float), p[:, at[lang]])
        i, j = np.nonzero(counts)
        names = np.array(model.value.languages, object)
        yield pa.record_batch([pa.array(names[j], pa.string()), pa.array(i), pa.array(counts[i, j])], ["lang", "piece", "count"])

    return run


def fit(docs: DataFrame, pieces: list[str] | None = None, sample_rows: int = SAMPLE_ROWS, rounds: int = ROUNDS) -> LanguageModel:
    """Fit on ``docs`` (doc_id, text, lang) with a lang and a text, about ``sample_rows`` of each language.

    The sample is by hash of the text. What comes to the driver is one number for each language
    and piece of the vocabulary.
    """
    spark = docs.sparkSession
    small_batches(spark)
    pieces = pieces or public_pieces()
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where(
        "lang is not null and text is not null"
    )
    # As many rows as there are languages; as literals, they are not joined, and no text is shuffled.
    shares = {r["lang"]: sample_rows / r["count"] for r in rows.groupBy("lang").count().collect()}
    share = F.lit(0.0)
    for lang, own in shares.items():
        share = F.when(F.col("lang") == lang, F.lit(own)).otherwise(share)
    sampled = rows.where((F.xxhash64(F.lit(31), "text") / F.lit(float(1 << 63)) + 1) / 2 <= share)
    counts = materialize(
        sampled.select("lang", "text")
        .mapInArrow(_word_counts, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n")),
        "word_counts",
    )
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    p = np.full((len(pieces) + 1, len(languages)), 1 / (len(pieces) + 1))
    for _ in range(rounds if languages else 0):
        model = spark.sparkContext.broadcast(LanguageModel(languages, pieces, p))
        table = (
            counts.mapInArrow(_expectations(model), "lang string, piece long, count double")
            .groupBy("lang", "piece")
            .agg(F.sum("count").alias("count"))
            .toPandas()
        )
        seen = np.zeros_like(p)
        seen[table["piece"], np.searchsorted(languages, table["lang"].to_numpy(dtype=str))] = table["count"]
        seen += 0.1
        p = seen / seen.sum(axis=0)
    return LanguageModel(languages, pieces, p)


class _Scores:
    """Log probabilities of words; those of the latest words are kept."""

    def __init__(self, model: LanguageModel):
        self.pieces, self.p = Pieces(model.pieces), scaled(model.pieces, model.p)
        self.row: dict[str, int] = {}
        self.log = np.zeros((0, len(model.languages)))

    def of(self, forms: list[str]) -> np.ndarray:
        if len(self.row) + len(forms) > KNOWN:
            self.row, self.log = {}, self.log[:0]
        fresh = [form for form in forms if form not in self.row]
        log = np.zeros((len(fresh), self.log.shape[1]))
        worded = [k for k, form in enumerate(fresh) if form]
        if worded and log.shape[1]:
            log[worded] = forward(self.pieces, [_START + fresh[k].lower() for k in worded], self.p)
        self.row.update(zip(fresh, range(len(self.log), len(self.log) + len(fresh)), strict=True))
        self.log = np.concatenate([self.log, log])
        return self.log[np.fromiter(map(self.row.__getitem__, forms), np.int64, len(forms))]


def _identified(model, text: str, names_out: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        scores = _Scores(m)
        names = np.array([*m.languages, UNKNOWN_LANGUAGE], object)
        for whole in batches:
            for batch in bounded(whole, text):
                numbers, forms, counts = _flat_words(batch.column(text))
                log = scores.of(forms)
                total = np.concatenate([np.zeros((1, log.shape[1])), np.cumsum(log[numbers], axis=0)])
                stops = np.cumsum(counts)
                total = total[stops] - total[stops - counts]
                lettered = np.array([t is not None and bool(_LETTER.search(t)) for t in batch.column(text).to_pylist()], bool)
                known = lettered & bool(m.languages)
                best = np.full(len(lettered), len(m.languages))
                score = np.zeros(len(lettered))
                if known.any():
                    top = total[known].max(axis=1, keepdims=True)
                    best[known] = total[known].argmax(axis=1)
                    score[known] = 1 / np.exp(total[known] - top).sum(axis=1)
                yield pa.record_batch(
                    [*batch.columns, pa.array(names[best], pa.string()), pa.array(score)], [*batch.schema.names, *names_out]
                )

    return run


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with two columns more: the language, and its posterior with equal priors.

    Columns of these names are replaced. A text that is null or has no letter is ``und`` with
    score 0, as is every text if the model has no language. Equal scores give the first name.
    """
    small_batches(docs.sparkSession)
    rows = docs.drop(*names)
    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    out = [f"`{names[0]}` string", f"`{names[1]}` double"]
    return rows.mapInArrow(_identified(shipped, text, names), ", ".join([*fields, *out]))


def fold(folds: int, column: str = "doc_id") -> Column:
    """crc32 of an id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.encode(F.col(column).cast("string"), "UTF-8")) % folds


def identify_languages(docs: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row of ``docs`` (doc_id, text, lang).

    Fitted on the rows outside the fold ``held``; a row without doc_id is held out.
    """
    held_out = F.coalesce(fold(folds) == held, F.lit(True))
    model = fit(docs.where(~held_out))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
