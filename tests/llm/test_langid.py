"""The sums over all segmentations against their enumeration."""

import math
from fractions import Fraction

import numpy as np
import pytest

from conceptree.llm import langid

PIECES = ["a", "b", "c", "ab", "bc", "abc", "▁", "▁a", "▁abca", "bcab"]
RUNS = ["▁a", "▁abcabc", "▁", "xay", "▁abca", "▁ab", "bcabca", "zz", "▁abcabcabcab", "a"]


def segmentations(run):
    if not run:
        yield []
    for end in range(1, len(run) + 1):
        piece = run[:end]
        if piece in PIECES or end == 1:
            yield from ([PIECES.index(piece) if piece in PIECES else len(PIECES), *rest] for rest in segmentations(run[end:]))


@pytest.fixture(scope="module")
def p():
    p = np.random.default_rng(1).random((len(PIECES) + 1, 3))
    return p / p.sum(axis=0)


def test_forward(p):
    found = langid.forward(langid.Pieces(PIECES), RUNS, langid.scaled(PIECES, p))
    for run, log in zip(RUNS, found, strict=True):
        np.testing.assert_allclose(log, np.log(sum(np.prod(p[s], axis=0) for s in segmentations(run))))


def log_of_all_segmentations(word, p):
    """In exact fractions, place by place: longer words have too many segmentations to list."""
    ways = [[Fraction(1)] * p.shape[1]]
    for b in range(1, len(word) + 1):
        total = [Fraction(0)] * p.shape[1]
        for a in range(b):
            piece = word[a:b]
            if piece in PIECES or b - a == 1:
                row = p[PIECES.index(piece) if piece in PIECES else len(PIECES)]
                total = [t + w * Fraction(x) for t, w, x in zip(total, ways[a], row.tolist(), strict=True)]
        ways.append(total)
    return [math.log(t.numerator) - math.log(t.denominator) for t in ways[-1]]


@pytest.mark.parametrize("most", [1, 3, 1 << 11])
def test_long_words_are_summed_across_runs(p, most):
    """Pieces lie across every border of the runs; words of several lengths go on together."""
    words = ["▁" + "abc" * 40, "▁" + "bca" * 17, "▁" + "ab" * 24, "▁" + "abcxa" * 70, "▁" + "c" * 95, "▁" + "abcab" * 19 + "ab"]
    pieces, scaled = langid.Pieces(PIECES), langid.scaled(PIECES, p)
    wanted = [log_of_all_segmentations(w, p) for w in words]
    np.testing.assert_allclose(langid._forward_long(pieces, words, scaled, most), wanted)
    np.testing.assert_allclose(langid.forward(pieces, ["▁ab", *words, "▁"], scaled)[1:-1], wanted)
    np.testing.assert_allclose(langid._forward_long(pieces, RUNS, scaled, most), langid.forward(pieces, RUNS, scaled))


def test_expected(p):
    weight = np.arange(1.0, len(RUNS) + 1)
    found = langid.expected(langid.Pieces(PIECES), RUNS, weight, langid.scaled(PIECES, p)[:, 0])
    wanted = np.zeros(len(p))
    for run, w in zip(RUNS, weight, strict=True):
        ways = list(segmentations(run))
        chance = np.array([np.prod(p[s, 0]) for s in ways])
        for s, c in zip(ways, chance / chance.sum(), strict=True):
            np.add.at(wanted, s, w * c)
    np.testing.assert_allclose(found, wanted)


def test_kept_scores_are_those_of_new_ones(p, monkeypatch):
    model = langid.LanguageModel(["x", "y", "z"], PIECES, p)
    words = ["ab", "", "cab", "ab" * 40, "Ab"]
    wanted = langid._Scores(model).of(words)
    scores = langid._Scores(model)
    scores.of(words[::2])
    np.testing.assert_array_equal(scores.of(words), wanted)
    monkeypatch.setattr(langid, "KNOWN", 3)
    np.testing.assert_array_equal(scores.of(words), wanted)
    assert wanted[1].tolist() == [0, 0, 0] and wanted[0].tolist() == wanted[4].tolist()


def test_letters():
    assert not any(langid._LETTER.search(t) for t in ("½ ²", "Ⅷ", "12_3", "!", ""))
    assert all(langid._LETTER.search(t) for t in ("1a", "é", "中", "ª"))
