"""Token ids of whole texts by a public tokenizer, from the distinct words of a batch.

Only for tokenizers that never join text across white space, as ``word_bpe_49k.json``: the ids
of a text are then those of its words, one after the other. Words of ASCII without apostrophe or
control characters, without ``<|``, and of the letters À to ÿ are lower-cased and cut here into runs of letters, single
digits and runs of other signs, as that tokenizer does before its merges, and the merges are
applied to many runs at once by numpy. All other words go through the tokenizer itself.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


_BYTES = _byte_letters()

def public_path(name: str = "word_bpe_49k.json") -> str:
    """Where this machine has the file of a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Longer words are left to the tokenizer.
_LONGEST = 64
_NONE = np.int64(1 << 40)


class Merges:
    """Byte-pair merges of a vocabulary, for many short words at once.

    As the model does for one word, the adjacent pair of lowest rank is merged, the leftmost of
    equals first, until no pair is known.
    """

    def __init__(self, model: dict):
        vocab, ending = model["vocab"], model["end_of_word_suffix"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.keys = np.array([vocab[a] << 17 | vocab[b] for a, b in pairs] + [-1], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs] + [-1], np.int64)
        self.inner = np.array([vocab.get(c, -1) for c in _BYTES], np.int64)
        self.final = np.array([vocab.get(c + ending, -1) for c in _BYTES], np.int64)
        self.tables = []  # a slot's merge; a merge whose slot is taken is looked for in the next
        left = np.arange(len(pairs))
        while len(left):
            table = np.full(1 << 21, -1, np.int32)
            table[self._slots(self.keys[left])] = left
            self.tables.append(table)
            left = np.setdiff1d(left, table)

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(43)).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 17 | right
        slots = self._slots(keys)
        found = np.full(keys.shape, _NONE)
        for table in self.tables:
            rank = table[slots]
            np.copyto(found, rank, where=self.keys[rank] == keys)
        return found

    def _same_length(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged ids, -1 behind the last, and their number, by row."""
        n, width = symbols.shape
        out = np.full((n, width), -1, np.int64)
        sizes = np.full(n, width)
        rows = np.arange(n)
        ranks = self._ranks(symbols[:, :-1], symbols[:, 1:]) if width > 1 else np.zeros((n, 0), np.int64)
        for left in range(width, 0, -1):  # symbols that the rows in work still have
            best = ranks.argmin(axis=1) if left > 1 else np.zeros(len(rows), np.int64)
            lowest = ranks[np.arange(len(rows)), best] if left > 1 else np.full(len(rows), _NONE)
            done = lowest == _NONE
            out[rows[done], :left] = symbols[done]
            sizes[rows[done]] = left
            rows, symbols, ranks, best, lowest = rows[~done], symbols[~done], ranks[~done], best[~done], lowest[~done]
            if not len(rows):
                break
            at = np.arange(len(rows))
            symbols[at, best] = self.made[lowest]
            columns = np.arange(left - 1)
            symbols = np.where(columns <= best[:, None], symbols[:, :-1], symbols[:, 1:])
            ranks = np.where(columns[:-1] < best[:, None], ranks[:, :-1], ranks[:, 1:])
            before, after = best > 0, best < left - 2
            ranks[at[before], best[before] - 1] = self._ranks(symbols[before, best[before] - 1], symbols[before, best[before]])
            ranks[at[after], best[after]] = self._ranks(symbols[after, best[after]], symbols[after, best[after] + 1])
        return out, sizes

    def encode(self, data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the runs ``data[begins:begins + lengths]`` one after the other, and the number of each."""
        sizes = np.zeros(len(begins), np.int64)
        found = []
        for length in np.unique(lengths).tolist():
            same = np.flatnonzero(lengths == length)
            for part in np.split(same, range(1 << 14, len(same), 1 << 14)):
                letters = data[begins[part][:, None] + np.arange(length)]
                symbols = self.inner[letters]
                symbols[:, -1] = self.final[letters[:, -1]]
                ids, size = self._same_length(symbols)
                sizes[part] = size
                found.append((part, ids, size))
        stops = np.cumsum(sizes)
        out = np.zeros(int(stops[-1]) if len(stops) else 0, np.uint32)
        for part, ids, size in found:
            at = (stops[part] - size)[:, None] + np.arange(ids.shape[1])
            on = np.arange(ids.shape[1]) < size[:, None]
            out[at[on]] = ids[on]
        return out, sizes


# Classes of bytes: letter, digit, other sign; 0 leaves a word to the tokenizer.
_LETTER, _DIGIT, _SIGN = 1, 2, 3
_CLASS = np.zeros(256, np.int8)
_CLASS[33:127] = _SIGN
_CLASS[[*range(65, 91), *range(97, 123), 0xC3, *range(0x80, 0xC0)]] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[39] = 0


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and lengths of the runs of plain words, and which words are plain.

    ``offsets`` bounds the words, none of which is empty.
    """
    kind = _CLASS[data]
    lead = data == 0xC3
    behind = np.append(False, lead[:-1])
    tail = (data >= 0x80) & (data < 0xC0)
    odd = (kind == 0) | (tail != behind) | (behind & ((data == 0x97) | (data == 0xB7)))
    odd[:-1] |= (data[:-1] == 60) & (data[1:] == 124)  # special tokens are looked for before anything else
    plain = ~np.logical_or.reduceat(odd, offsets[:-1])
    lower = data.copy()
    lower[(data >= 65) & (data <= 90)] += 32
    lower[behind & (data >= 0x80) & (data <= 0x9E)] += 32
    start = np.ones(len(data), bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    start[offsets[:-1]] = True
    begins = np.flatnonzero(start)
    lengths = np.diff(np.append(begins, len(data)))
    owner = np.searchsorted(offsets, begins, "right") - 1
    plain[owner[lengths > _LONGEST]] = False
    return lower, begins, lengths, plain


class WordTokenizer:
    def __init__(self, name: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_path(name) if os.sep not in name else name)
        self.end = end
        # What is known of this one need not hold of others.
        self.merges = Merges(json.loads(self.tokenizer.to_str())["model"]) if name == "word_bpe_49k.json" else None
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one after the other, and the number of each."""
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        held = np.flatnonzero(np.diff(offsets))
        sizes = np.zeros(len(words), np.int64)
        if not len(held):
            return np.zeros(0, np.uint32), sizes
        bounds = np.append(offsets[held], offsets[-1])
        plain = np.zeros(len(held), bool)
        ids = owner = count = None
        if self.merges:
            lower, begins, lengths, plain = _runs(data, bounds)
            owner = np.searchsorted(bounds, begins, "right") - 1
            on = plain[owner]
            ids, count = self.merges.encode(lower, begins[on], lengths[on])
            sizes[held] = np.bincount(owner[on], count, len(held)).astype(np.int64)
        rest = held[~plain]
        coded = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in words.take(pa.array(rest)).to_pylist()]
        sizes[rest] = [len(c) for c in coded]
        out = np.zeros(int(sizes.sum()), np.uint32)
        stops = np.cumsum(sizes)
        if ids is not None:
            mine = np.zeros(len(words), bool)
            mine[held[plain]] = True
            out[np.repeat(mine, sizes)] = ids
        for word, own in zip(rest.tolist(), coded, strict=True):
            out[stops[word] - len(own) : stops[word]] = own
        return out, sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each closed by ``end``, and where each text starts among them."""
        split = pc.ascii_split_whitespace(pc.cast(texts, pa.large_string()).fill_null(""))
        words = np.cumsum(pc.list_value_length(split).to_numpy().astype(np.int64))
        coded = split.flatten().dictionary_encode()
        ids, sizes = self._words(coded.dictionary)
        begins = np.cumsum(sizes) - sizes
        numbers = coded.indices.to_numpy()
        lengths = sizes[numbers]
        stops = np.cumsum(lengths)
        at = np.repeat(begins[numbers] - (stops - lengths), lengths)
        at += np.arange(len(at))
        before = np.concatenate([[0], stops])[words]  # tokens up to the end of each text
        first = np.concatenate([[0], before + np.arange(1, len(before) + 1)])
        out = np.full(first[-1], self.end, np.uint32)
        inner = np.ones(len(out), bool)
        inner[first[1:] - 1] = False
        out[inner] = ids[at]
        return out, first
