"""Token ids of whole texts by the tokenizers library, each distinct piece encoded once.

A byte-level BPE works inside pre-tokens, and a single space or line feed between two non-space
characters always begins one. So a text may be cut there, and the ids of its units may be
put together: the result equals that of the library for the whole text. For the same reason new
units are encoded many in one text: each begins where an id's token begins with its space or line feed."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from feedspark.llm.hashing import HASHES

#: Code points that some engine takes for white space. Cuts are made only at spaces beside none of these.
WHITE = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)))
CUT = re.compile(f"(?<![{WHITE}]) (?![{WHITE}])")
#: Bytes of texts that are encoded together.
SLICE = 4_000_000
BESIDE = f" [{WHITE}]|[{WHITE}] "
#: Line feeds, each with a space put before it, beside white space: no places for cuts.
BESIDE_FEED = f" \n[{WHITE}]|[{WHITE}] \n"
#: Units that are encoded alone: empty ones, those with white space at an end or a space or line feed inside, and long ones.
ALONE = "(?s)^\n?$|^\n[{0}]|^[{1}]|.[ \n]|[{0}]$|.{{34}}".format(WHITE, WHITE.replace("\n", ""))
#: A mark at a unit's end after a Latin letter or digit is a pre-token of its own, so words are remembered without it.
MARKS = "!,.:;?"
MARKED = f"[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f][{MARKS}]$"
#: Characters of units that a worker remembers, and units that are encoded as one text.
SHORT, TOGETHER = 32, 1_000


def units(text: str) -> list[str]:
    """The text's units: all but the first follow a space, which is left out."""
    return CUT.split(text)


def unit_lists(texts: pa.StringArray, lines: bool = False) -> pa.ListArray:
    """The units of each text. Where no space is beside white space, every space is a cut.

    ``lines``: there, cuts are made before line feeds too, and a unit that begins with one follows no space."""
    odd = pc.match_substring_regex(texts, BESIDE)
    cut = texts
    if lines:
        spaced = pc.replace_substring(pc.replace_substring(texts, "\n", " \n"), " \n \n", "\n\n")
        cut = pc.if_else(pc.match_substring_regex(spaced, BESIDE_FEED), texts, spaced)
    split = pc.split_pattern(cut, " ")
    if not pc.any(odd).as_py():
        return split
    return pa.array([units(t.as_py()) if o else s for t, o, s in zip(texts, odd.to_pylist(), split.to_pylist(), strict=True)], split.type)


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids; its cache holds about ``limit`` units.

    Arrow finds the distinct units of the texts at hand, each of which is looked up or encoded
    once, and puts their ids together. When the cache is full, what these texts use stays."""

    def __init__(self, path: str, limit: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.limit = limit
        self.known: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.marks = pa.array([*self.direct(list(MARKS)), b""], pa.large_binary())
        self.begins[[i for t, i in vocabulary.items() if t[:1] in ("Ġ", "Ċ")]] = True  # a space and a line feed, as byte-level vocabularies spell them

    def direct(self, texts: list[str], many: int = 5_000, size: int = 1_000_000) -> list[bytes]:
        """In calls of ``many`` texts or about ``size`` characters, as the library's results take more memory than the ids."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            end, total = at, 0
            while end < min(len(texts), at + many) and total < size:
                total += len(texts[end])
                end += 1
            out += [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts[at:end], add_special_tokens=False)]
            at = end
        return out

    def together(self, new: list[str]) -> list[bytes]:
        """Ids of units that need not be encoded alone, each with its space or line feed; TOGETHER of them make one text."""
        out: list[bytes] = []
        for at in range(0, len(new), TOGETHER):
            own = new[at : at + TOGETHER]
            led = [u if u[0] == "\n" else f" {u}" for u in own]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(led)], add_special_tokens=False)[0].ids, np.uint32)
            first = (np.flatnonzero(self.begins[ids]) * 4).tolist()
            if len(first) != len(own):  # not a byte-level vocabulary
                out += self.direct(led)
                continue
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip(first, [*first[1:], len(raw)], strict=True)]
        return out

    def _ids(self, distinct: pa.StringArray) -> pa.LargeBinaryArray:
        """Ids of distinct units, each with its space or line feed."""
        marked = pc.match_substring_regex(distinct, MARKED)
        mark = pc.index_in(pc.if_else(marked, pc.utf8_slice_codeunits(distinct, -1), ""), pa.array(list(MARKS)))
        coded = pc.if_else(marked, pc.utf8_slice_codeunits(distinct, 0, -1), distinct).dictionary_encode()
        stems = pa.array(self._known(coded.dictionary.to_numpy(zero_copy_only=False)), pa.large_binary())
        return pc.binary_join_element_wise(stems.take(coded.indices), self.marks.take(mark.fill_null(len(MARKS))), pa.scalar(b"", pa.large_binary()))

    def _known(self, distinct: np.ndarray) -> list[bytes]:
        got = list(map(self.known.get, distinct))
        at = np.array([i for i, x in enumerate(got) if x is None], np.int64)
        if len(self.known) + len(at) > self.limit:
            self.known = {u: x for u, x in zip(distinct, got, strict=True) if x is not None}
        alone = pc.match_substring_regex(pa.array(distinct[at], pa.string()), ALONE).to_numpy(zero_copy_only=False)
        many, few = distinct[at[~alone]].tolist(), distinct[at[alone]].tolist()
        ids = self.together(many), self.direct([u if u[:1] == "\n" else f" {u}" for u in few])
        self.known.update(zip(many, ids[0], strict=True))
        self.known.update((u, x) for u, x in zip(few, ids[1], strict=True) if len(u) <= SHORT)
        for i, x in zip([*at[~alone].tolist(), *at[alone].tolist()], [*ids[0], *ids[1]], strict=True):
            got[i] = x
        return got

    def encode(self, texts: pa.StringArray) -> list[bytes]:
        lists = unit_lists(texts, lines=True)
        ends = lists.offsets.to_numpy()
        flat = lists.flatten()
        heads = self.direct(flat.take(pa.array(ends[:-1] - ends[0])).to_pylist())
        coded = flat.dictionary_encode()
        joined = self._ids(coded.dictionary).take(coded.indices)
        at = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1)[ends - ends[0]].tolist()
        first = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1)[ends[:-1] - ends[0] + 1].tolist()
        raw = memoryview(joined.buffers()[2])
        return [head + bytes(raw[a:b]) for head, a, b in zip(heads, first, at[1:], strict=True)]


#: Units that an encoder remembers, about 250 bytes each.
REMEMBERED = 1_000_000
_ENCODERS: dict[str, Encoder | None] = {}


def encoder(path: str, limit: int = REMEMBERED) -> Encoder:
    """One encoder for each worker process and file; its cache is cut to the limit of the last caller. Word hashes of earlier stages go."""
    HASHES.clear()
    own = _ENCODERS.setdefault(path, None) or Encoder(path, limit)
    _ENCODERS[path], own.limit = own, limit
    if len(own.known) > limit:
        own.known = {}
    return own


def slices(texts: pa.StringArray, size: int = SLICE) -> Iterator[pa.StringArray]:
    """Consecutive texts of about ``size`` bytes together, one at least."""
    if not len(texts):
        return
    total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        before = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, before + size, side="right")))
        yield texts.slice(first, last - first)
        first = last


def encoded(texts: pa.StringArray, path: str, size: int = SLICE, limit: int = REMEMBERED) -> Iterator[bytes]:
    own = encoder(path, limit)
    for held in slices(texts, size):
        yield from own.encode(held)
    pa.default_memory_pool().release_unused()
