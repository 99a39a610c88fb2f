"""Statistics of texts against plain Python, alone and beside any others; rules on very long texts."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from conceptree.llm.quality import _CLASSES, NAMES, statistics
from conceptree.llm.rules import quality_rules

TEXTS = ["one two two\nthree", "\n\n\n\n\n\nnext text begins", "", None, "   \n\n", "ÄÖ ü!\n\nx\nx\n ", "a", " a a a a ", "Tab\tand 12 #$ (x); y?\n"]


def plain(text):
    text = text or ""
    words = [w for w in "".join(" " if c in " \t\n\x0b\f\r" else c for c in text).split(" ") if w]
    if not words:
        return [0.0] * len(NAMES)
    n, lengths = len(words), [len(w.encode()) for w in words]
    mean = sum(lengths) / n
    lines = [line for line in text.split("\n") if line]
    out = [
        math.log1p(n), math.log(mean), math.sqrt(max(sum(x * x for x in lengths) / n - mean**2, 0)) / mean, len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        len(set(zip(words, words[1:], strict=False))) / (n - 1) if n > 1 else 1.0, 1 - len(set(lines)) / len(lines),
    ]
    return out + [sum(b in codes for b in text.encode()) / sum(lengths) for codes in _CLASSES.values()]


@pytest.mark.parametrize("seed", range(4))
def test_statistics_do_not_depend_on_neighbours(seed):
    texts = random.Random(seed).sample(TEXTS * 2, 2 * len(TEXTS))
    want = np.array([plain(t) for t in texts])
    np.testing.assert_allclose(statistics(pa.array(texts)), want, atol=1e-9)
    np.testing.assert_allclose(np.concatenate([statistics(pa.array([t], pa.string())) for t in texts]), want, atol=1e-9)


def test_no_text_is_too_long(make):
    text = " ".join(f"the{k}" if k % 10 else "the" for k in range(1_000_100))
    row = quality_rules(make("doc_id long, text string", (1, text))).first()
    assert (row["n_words"], row["base_failed"], row["kept"]) == (1_000_100, False, True)
