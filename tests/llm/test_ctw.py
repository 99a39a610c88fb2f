"""Context-tree weighting against a plain recursion over all contexts, and the words' scores."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conceptree.llm.ctw import log_gamma, log_kt, score_texts

SPACE = " \t\n\x0b\f\r"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def symbols(text, depth):
    """(context, byte) of a text and its end."""
    data = [255] * depth + list(lower(text).encode()) + [255]
    return [(tuple(data[i - depth : i]), data[i]) for i in range(depth, len(data))]


def kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)


class Tree:
    """One decision's contexts: counts of each context of each length."""

    def __init__(self, depth):
        self.depth, self.counts, self.children = depth, defaultdict(lambda: [0, 0]), defaultdict(set)

    def add(self, context, bit, n=1):
        for d in range(self.depth + 1):
            own = context[len(context) - d :]
            self.counts[own][bit] += n
            if d:
                self.children[own[1:]].add(own)

    def weighted(self, own=()):
        here = kt(*self.counts[own])
        if len(own) == self.depth:
            return here
        below = sum(self.weighted(c) for c in sorted(self.children[own]))
        top = max(here, below)
        return math.log(0.5) + top + math.log(math.exp(here - top) + math.exp(below - top))


def brute(rows, depth):
    training = [t for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 10]
    trees = defaultdict(lambda: Tree(depth))
    bits = lambda byte: [(byte >> (8 - t) | 1 << t, byte >> (7 - t) & 1) for t in range(8)]
    for text in training:
        for context, byte in symbols(text, depth):
            for node, bit in bits(byte):
                trees[node].add(context, bit)
    tokens = lambda t: [w for w in "".join(" " if c in SPACE else c for c in lower(t)).split(" ") if w] + [None]
    count = Counter(x for t in training for x in tokens(t))
    total, distinct = sum(count.values()), len(count)
    out, known = [], {}
    for i, text in rows:
        score = 0.0
        for context, byte in symbols(text, depth):
            for node, bit in bits(byte):
                if (context, node, bit) not in known:
                    tree = trees[node]
                    before = tree.weighted()
                    tree.add(context, bit)
                    known[context, node, bit] = tree.weighted() - before
                    tree.add(context, bit, -1)
                score += known[context, node, bit]
        own = tokens(text)
        base = sum(math.log10((count[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in own)
        held = i is None or zlib.crc32(str(i).encode()) % 10 == 0
        out.append((i, held, len(own), sum(count[x] > 0 for x in own), total, base, score / math.log(10)))
    return out


def rows():
    rng = random.Random(2)
    words = ["the", "The", "then", "ing", "élan", "X", "a"]
    made = [(i, "".join(rng.choice(words) + rng.choice([" ", "  ", "\n", ", "]) for _ in range(rng.randrange(8)))) for i in range(45)]
    return made + [(100, None), (101, ""), (None, "the thing"), (7, "again"), (7, "again"), (103, "\x00\x1c 😀"), (104, " ")]


@pytest.mark.parametrize(("depth", "block_bytes", "most_common"), [(0, 1 << 20, 1 << 20), (2, 100, 0), (3, 100, 40), (5, 1 << 20, 100)])
def test_against_recursion(make, depth, block_bytes, most_common):
    given = rows()
    docs = make("doc_id long, text string", *given).withColumns({c: F.lit(1) for c in ("block", "word", "run", "times", "held_out", "score")})
    found = sorted((tuple(r)[:7] for r in score_texts(docs, depth=depth, block_bytes=block_bytes, most_common=most_common).collect()), key=repr)
    want = sorted(brute(given, depth), key=repr)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    np.testing.assert_allclose([r[5:] for r in found], [r[5:] for r in want], rtol=1e-9)


def test_nothing_learnt(make):
    assert score_texts(make("doc_id long, text string")).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = score_texts(make("doc_id long, text string", (held, "ab c"))).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (3, 0, 0, 0.0)
    assert row["bits_per_byte"] == pytest.approx(8) and row["score"] == pytest.approx(5 * 8 * math.log10(0.5))


def test_log_gamma():
    x = np.array([0.5, 1.0, 1.5, 2.0, 7.5, 100.0, 12345.5, 1e9])
    np.testing.assert_allclose(log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)
    np.testing.assert_allclose(log_kt(np.array([0, 1, 2]), np.array([0, 0, 1])), [0, math.log(0.5), math.log(1 / 16)], atol=1e-11)
