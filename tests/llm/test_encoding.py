"""Ids put together from units equal those of the library for whole texts, and few texts reach the library."""

import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
from tokenizers import Tokenizer

from feedspark.llm.encoding import MARKS, TOGETHER, Encoder, encoded, encoder

BPE = P.path("byte_bpe_50k.json")
PIECES = [
    "a", "Foo", "é", "ß", "日本", "ñ", "23", "٣", "½", "Ġ", "Ċ", "x" * 40, "ɐ", "́", "😀", "\x00", "_", "...", "'", "'s", "'ll", "’", "-", "&&&", "<|endoftext|>", "<|", "|>",
    *MARKS, " ", "  ", "\n", "\n\n", "\n\n\n", " \n", "\n ", "\r\n", "\t", "\x85", "\xa0", " ", "　", "\x1c", "​", "﻿",
]


class Counting:
    """The library, and the number of texts that it was given."""

    def __init__(self, own):
        self.own, self.texts = own, 0

    def encode_batch_fast(self, texts, **kw):
        self.texts += len(texts)
        return self.own.encode_batch_fast(texts, **kw)


def test_ids_equal_the_library():
    draw, whole = random.Random(7), Tokenizer.from_file(BPE)
    texts = ["", " ", "\n", "a\n", "a ", "word.\nNext", "word.\n\nNext", "word.\n\n\nNext", "end!\n"]
    for between in ("", " ", "\n"):
        texts += [between.join("".join(draw.choices(PIECES, k=draw.randint(1, 3))) for _ in range(draw.randint(0, 8))) for _ in range(3_000)]
    for limit in (0, 50, 1_000_000):
        own = Encoder(BPE, limit)
        for at in range(0, len(texts), 500):
            held = texts[at : at + 500]
            assert own.encode(pa.array(held)) == [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in held]


def test_new_words_are_encoded_together():
    words = [f"w{chr(97 + i % 26)}{i}" for i in range(5_000)]
    own = Encoder(BPE, 1_000_000)
    own.tokenizer = count = Counting(own.tokenizer)
    own.encode(pa.array([" ".join(words)]))
    assert count.texts <= 2 + 5_000 // TOGETHER
    count.texts = 0
    own.encode(pa.array(["x " + f"{mark}{lead}".join(words[1:]) for mark in MARKS for lead in " \n"]))
    assert count.texts <= 20 + 5_000 // TOGETHER


def test_other_vocabularies_are_encoded_alone():
    own = Encoder(BPE, 1_000_000)
    own.begins[:] = False  # as if no token spelled a space
    assert own.encode(pa.array(["one two\nthree four."])) == Encoder(BPE, 0).direct(["one two\nthree four."])


def test_forgotten_words_are_encoded_together(monkeypatch):
    """As packing encodes, batch after batch with a cache that the words exceed."""
    texts = pa.array([f"head {' '.join(f'p{chr(97 + i % 26)}{i + 1_000 * k}' for i in range(1_000))}." for k in range(12)])
    own = encoder(BPE, 100)
    count = Counting(own.tokenizer)
    monkeypatch.setattr(own, "tokenizer", count)
    got = list(encoded(texts, BPE, size=20_000, limit=100))
    assert count.texts <= 12 + 3 * 12
    monkeypatch.undo()
    assert got == own.direct(texts.to_pylist())
