"""Whole blocks go, short and blank lines included."""

import random

import numpy as np
from conftest import got
from test_edges import prose

from conceptree.llm.linededup import common_blocks, remove_shared_lines

X, Y, Z, W = (prose(seed, 9) for seed in (21, 22, 23, 24))


def left(make, *texts, **how):
    rows = make("doc_id long, text string", *enumerate(texts, 1))
    return [text for _, text in sorted(got(remove_shared_lines(rows, **how), "doc_id", "text"))]


def test_short_lines_of_a_common_block_go(make):
    first = f"Title\n\n{X}\nAll rights reserved.\n\n{Y}\nend"
    later = f"own\n{X}\nAll rights reserved.\n\n{Y}\nend\nAll rights reserved."
    assert left(make, first, first, later) == [first, "", "own\nAll rights reserved."]


def test_short_lines_alone_stay(make):
    assert left(make, f"{X}\na\nb", f"{Y}\na\nb") == [f"{X}\na\nb", f"{Y}\na\nb"]


def test_short_lines_tell_repeats_apart(make):
    assert left(make, f"{X}\ns0\n{X}\ns1\n{X}\ns2", f"{X}\ns1\n{X}\ns2\nown")[1] == "own"
    assert left(make, f"s\nt\n{X}", f"{X}\ns\nt")[1] == "s\nt"


def common_length(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1, j + 1] = max(table[i, j + 1], table[i + 1, j], table[i, j] + (x == y))
    return table[-1, -1]


def test_blocks_are_common_and_whole():
    for seed in range(300):
        rng = random.Random(seed)
        a, b = (np.array([rng.randint(0, 9) for _ in range(rng.randint(1, 14))], np.int64) for _ in range(2))
        gone = common_blocks(a, b)
        assert len(set(gone)) == len(gone) == common_length(a, b[gone])
        assert any(b[j] & 1 for j in gone) == bool({x for x in a if x & 1} & set(b))
        assert common_blocks(b, b) == (list(range(len(b))) if any(b & 1) else [])


def test_copies_go_whole(make):
    assert left(make, f"{X}\n{Y}", f"{Y}\n{X}", f"{Y}\n{X}")[2] == ""
    thrice = f"{X}\n{Y}\n{X}\n{Z}\n{X}"
    assert left(make, f"{X}\n{W}", thrice, thrice)[2] == ""
    assert left(make, "a b\n\nc", "a  b\n\nc", "a b\n\nd", "", "") == ["a b\n\nc", "", "a b\n\nd", "", ""]
    assert left(make, "a b\nc", "a b\nc", "", None, drop_emptied=True) == ["a b\nc", "", None]


def test_runs_link_documents_that_hold_no_line_first(make):
    assert left(make, f"{X}\n{Y}", f"{Y}\n{X}", f"own\n{Y}\n{X}")[2] == "own"
    found = left(make, f"{Z}\n{Y}\n{X}\n{W}", f"{X}\ns\n{Y}\n{Z}\n{W}", f"{X}\ns\n{Y}\n{Z}\n{W}\nown")
    assert found[2] == "own"


def test_exact_copies_keep_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = dict(got(docs.where("trim(text) <> ''"), "doc_id", "text"))
    seen, copies = set(), []
    for doc, text in sorted(texts.items()):
        lines = tuple(tuple(line.encode().split()) for line in text.split("\n"))
        if lines in seen:
            copies.append(doc)
        seen.add(lines)
    after = dict(got(remove_shared_lines(docs), "doc_id", "text"))
    assert copies and not any(after[doc] for doc in copies)
