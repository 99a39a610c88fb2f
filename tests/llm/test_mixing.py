"""Sources of very uneven size: the budget is the corpus, whatever its smallest source."""

import corpus_pipeline
import numpy as np
import pytest

from conceptree.llm import mixing


def shares(*tokens):
    return [(f"s{i}", n) for i, n in enumerate(tokens)]


TINY = shares(50_000_000, *[5_000_000] * 19, 150)
ZIPF = shares(*[int(1e9 * k**-1.5) + 1 for k in range(1, 1001)])


def brute(tokens, entropy, max_repeats, steepest):
    """The exponent by small steps, with the corpus as the budget."""
    share = np.array(tokens) / sum(tokens)
    found = []
    for x in np.linspace(0, steepest, 4001):
        w = share**x / (share**x).sum()
        found.append((x, -(w * np.log(w)).sum() / np.log(len(w)), (w / share).max() <= max_repeats * (1 + 1e-9), w * sum(tokens)))
    at = next((i for i, f in enumerate(found) if f[1] <= entropy), len(found) - 1)
    while not found[at][2]:
        at += 1 if found[at][0] < 1 else -1
    return found[at][0], found[at][3]


@pytest.mark.parametrize(
    ("tokens", "entropy", "steepest"),
    [(TINY, 0.9, 1.0), (TINY, 0.95, 8.0), (ZIPF, 0.9, 1.0), (shares(1_100, *[1_000] * 199), 0.6, 8.0)],
)
def test_budget_is_the_corpus(make, tokens, entropy, steepest):
    found = mixing.mixture(make("group string, tokens long", *tokens), entropy, 4.0, steepest=steepest)
    counts = dict(tokens)
    quota = {r["group"]: r["quota"] for r in found.sources.collect()}
    total = sum(counts.values())
    assert found.budget == total and sum(quota.values()) == pytest.approx(total, rel=1e-6)
    assert max(quota[g] / counts[g] for g in counts) <= 4 * (1 + 1e-6)
    exponent, wanted = brute(list(counts.values()), entropy, 4.0, steepest)
    assert found.exponent == pytest.approx(exponent, abs=4e-3)
    assert [quota[g] for g in counts] == pytest.approx(list(wanted), rel=5e-2)


def test_pipeline_keeps_the_tokens_of_a_skewed_corpus(make):
    sizes = {"hot": 300, **{f"even{i}": 30 for i in range(19)}, "tiny": 1}
    rows, text = [], "ein Wort und noch eins und wieder ein Wort daneben"
    for source, n in sizes.items():
        rows.extend((f"{source}{k}", text, "de", source) for k in range(n))
    docs = make("doc_id string, text string, lang string, source string", *rows)
    kept = corpus_pipeline.mixing(docs.sparkSession, docs, "")
    times = {r["source"]: r["count"] for r in kept.groupBy("source").count().collect()}
    assert 0.98 * len(rows) <= sum(times.values()) <= len(rows) + len(sizes)
    assert 1 < times["tiny"] <= 4
    distinct = kept.select("doc_id").distinct().count()
    print("kept share of documents:", distinct / len(rows))
    assert distinct / len(rows) > 0.8
