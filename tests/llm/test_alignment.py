"""Alignment of two tokenizers against a plain version that tokenises whole texts."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from conftest import got
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from conceptree.llm.alignment import align_tokenizers
from conceptree.llm.tokens import _byte_letters

ALPHABET = ["a", "the", "The", "ing", " ", "  ", "\n", "\t", "\r", "é", "ß", "'s", "'", "1", "23", "#", " ", "　", " ", "中", "文", "́",
            "😀", "\u0085", "\x1c", "\x0b", "ﬁ", "﻿", "־", "य", "<|endoftext|>", "<s>", "½", "...", "-", "\x00", "\x7f", "Ж"]


def tokens():
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = {c: b for b, c in enumerate(_byte_letters())}

    def encode(text):
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        a_bytes = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        b_bytes = [bytes([i - 3]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
        assert all(second.id_to_piece(i) == f"<0x{i - 3:02X}>" for i in b if second.is_byte(i))
        whole = (" " + text).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            return [], []
        spans = []
        for ids, parts in ((a, a_bytes), (b, b_bytes)):
            at, side = 0, []
            for i, part in zip(ids, parts, strict=True):
                side.append((i, at, at + len(part)))
                at += len(part)
            spans.append(side)
        return spans

    return encode


def brute(rows):
    encode = tokens()
    found = []
    for doc_id, text in rows:
        a, b = encode(text or "")
        links = [(i, j) for i, s, e in a for j, t, u in b if max(s, t) < min(e, u)]
        shared = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, at = [], 0
        for end in shared:
            inside = lambda side: ",".join(str(i) for i, s, e in side if s >= at and e <= end)  # noqa: B023, E731
            groups.append(f"{inside(a)}|{inside(b)}")
            at = end
        found.append((doc_id, len(a), len(b), groups, links))
    count = Counter(x for *_, links in found for x in links)
    best = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    return sorted(
        (
            (d, n_a, n_b, len(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
            for d, n_a, n_b, groups, links in found
        ),
        key=repr,
    )


def texts():
    rng = random.Random(5)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(1, 60))) for _ in range(150)]
    plain = [" ".join(rng.choice(["ing", "thation", "und", "élève", "of", "x,", "(y)", "Zz."]) for _ in range(40)) for _ in range(40)]
    odd = [None, "", " ", "   ", "a ", " a", "a  ", "▁", "a▁b", "\n", "x" * 3000, "same text", "same text", "same text."]
    return list(enumerate(made + plain + odd)) + [(None, "no id"), (7, "again"), (7, "again")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_against_whole_texts(make, block_bytes):
    rows = texts()
    docs = make("doc_id int, text string", *rows).withColumns({c: F.lit("x") for c in ("block", "pair", "place", "units", "total")})
    assert got(align_tokenizers(docs, block_bytes=block_bytes)) == brute(rows)


def test_empty(make):
    assert align_tokenizers(make("doc_id string, text string")).count() == 0
    assert got(align_tokenizers(make("doc_id string, text string", ("x", None)))) == [("x", 0, 0, 0, 0, 0, 0, "")]
