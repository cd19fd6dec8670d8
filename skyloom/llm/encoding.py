"""Encoding of many texts with a public tokenizer through their distinct pieces.

A pre-token of the BPE tokenizers here never goes on past a letter that a space, a line break, a full stop or a comma
follows. So a text encodes to the ids of the pieces between such places, one after another. Pieces repeat, so each is
encoded once per worker and looked up afterwards. Texts where such marks touch each other are cut at plain spaces only;
texts that spell one of the tokenizer's added tokens are encoded whole. The pieces of many texts are cut and told apart
on their bytes in Arrow, so Python sees a piece once per batch.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterable, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per task

_CUT = "\1"  # stands before a cut; texts that hold it take the slow path
_SAFE = re.compile(r"(?<=\S)(?= \S)")
_TOUCHING = re.compile(r"\s[\s.,]|[^\w\s][.,]|_[.,]|\x01")
# the same places for Arrow, whose \s and \w know ASCII only
_TOUCHING_BYTES = (r"[\t-\r\x1c-\x20\x{85}\x{a0}\p{Z}][\t-\r\x1c-\x20\x{85}\x{a0}\p{Z}.,]"
                   r"|[^\p{L}\p{N}][.,]|\x01")
_MARKS = np.isin(np.arange(256), [ord(c) for c in " \n.,"])
_PLAIN = re.compile(r"([ \n]?[A-Za-zÀ-ÖØ-öø-ÿ]+)([;:!?|]*)")  # one pre-token of Latin letters, then one of marks
_FEW = 20_000  # letters of texts that are cut one by one
_PROBES = ["The", " the", "\nThe", " thionéx", " Überlê"]
_ENCODERS: dict[str, PieceEncoder] = {}


def _byte_letters() -> dict[int, str]:
    """The letters byte-level BPE writes for bytes: printable ones stand for themselves, others from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _cut(texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, list[int]]:
    """The pieces of all texts, one after another on the bytes of the texts, and where those of each text begin and end."""
    if not len(texts):
        return texts, [0]
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data, first = texts.buffers()[2] or pa.py_buffer(b""), offsets[0]
    begins = _MARKS[np.frombuffer(data, np.uint8)[first:offsets[-1]]]
    begins[offsets[offsets < offsets[-1]] - first] = True
    begins = np.append(np.flatnonzero(begins), len(begins)) + first
    pieces = pa.LargeStringArray.from_buffers(len(begins) - 1, pa.py_buffer(begins), data)
    return pieces, np.searchsorted(begins, offsets).tolist()


class PieceEncoder:
    """One tokenizer and its table of known pieces, of which it keeps about ``most``."""

    def __init__(self, path: str, most: int = 1_000_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.most, self.letters, self.marks = most, _byte_letters(), {}
        self.folds = self.tokenizer.normalizer is not None  # lower case, white space dropped
        # the short cut for plain words holds only for tokenizers that agree on it
        self.plain = all(self._word(p) == self.tokenizer.encode(p, add_special_tokens=False).ids for p in _PROBES)
        self._clear()

    def _clear(self) -> None:
        self.code: dict[str, int] = {}
        self.starts, self.lengths, self.pool = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.int32)
        self.used = 0

    def _word(self, text: str) -> list[int]:
        """Ids of a run of Latin letters, which is one pre-token: straight from the merges."""
        if self.folds:
            text = text.strip().lower()
        elif text[0] == "\n":
            return self._mark("\n") + self._word(text[1:])
        return [t.id for t in self.tokenizer.model.tokenize(text.encode().decode("latin-1").translate(self.letters))]

    def _mark(self, text: str) -> list[int]:
        if (ids := self.marks.get(text)) is None:
            if len(self.marks) > 10_000:
                self.marks.clear()
            ids = self.marks[text] = self.tokenizer.encode(text, add_special_tokens=False).ids
        return ids

    def _add(self, pieces: list[str]) -> None:
        found = [m if self.plain else None for m in map(_PLAIN.fullmatch, pieces)]
        other = iter(self.tokenizer.encode_batch_fast([p for p, m in zip(pieces, found) if not m], add_special_tokens=False))
        ids = [(self._word(m[1]) + self._mark(m[2]) if m[2] else self._word(m[1])) if m else next(other).ids for m in found]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.frombuffer(array("i", chain.from_iterable(ids)), np.int32)
        first = len(self.code)
        while first + len(ids) > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.starts[first:first + len(ids)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first:first + len(ids)] = lengths
        self.pool[self.used:self.used + len(flat)] = flat
        self.used += len(flat)
        self.code.update(zip(pieces, range(first, first + len(ids))))

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text; joined they give it back."""
        if not text:
            return []
        if any(t in text for t in self.added):
            return [text]
        if _TOUCHING.search(text):
            return _SAFE.split(text)
        for mark in (" ", "\n", ".", ","):
            text = text.replace(mark, _CUT + mark)
        return text.removeprefix(_CUT).split(_CUT)

    def is_cut(self, before: str, after: str) -> bool:
        """Whether no pre-token goes on from a text that ends in the character ``before`` into ``after``: at either end
        of the text, or before a space between two characters that are none."""
        return not before or not after or (after[0] == " " and not before.isspace() and len(after) > 1 and not after[1].isspace())

    def codes(self, texts: Sequence[str]) -> list[np.ndarray]:
        """For every text the numbers of its :meth:`pieces` in the table of known pieces."""
        if len(self.code) > self.most:
            self._clear()
        if sum(map(len, texts)) < _FEW:
            split = list(map(self.pieces, texts))
            self._learn(dict.fromkeys(chain.from_iterable(split)))
            return [np.fromiter(map(self.code.__getitem__, s), np.int64, len(s)) for s in split]
        column = pa.array(texts, pa.large_string())
        slow = pc.match_substring_regex(column, _TOUCHING_BYTES)
        for token in self.added:
            slow = pc.or_(slow, pc.match_substring(column, token))
        found, edges = _cut(column.filter(pc.invert(slow)))
        found = found.dictionary_encode()
        known = found.dictionary.to_numpy(zero_copy_only=False)
        self._learn(known)
        numbers = np.fromiter(map(self.code.__getitem__, known), np.int64, len(known))[found.indices.to_numpy()]
        quick = iter([numbers[a:b] for a, b in zip(edges, edges[1:])])
        out = []
        for text, rare in zip(texts, slow.to_pylist()):
            if rare:
                split = self.pieces(text)
                self._learn(dict.fromkeys(split))
                out.append(np.fromiter(map(self.code.__getitem__, split), np.int64, len(split)))
            else:
                out.append(next(quick))
        return out

    def _learn(self, pieces: Iterable[str]) -> None:
        """Adds those of the distinct ``pieces`` that are not known."""
        if new := [p for p in pieces if p not in self.code]:
            self._add(new)

    def counts(self, codes: np.ndarray) -> np.ndarray:
        return self.lengths[codes]

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Token ids of every text."""
        out = []
        for codes in self.codes(texts):
            lengths = self.lengths[codes]
            total = int(lengths.sum())
            at = np.repeat(self.starts[codes] - (np.cumsum(lengths) - lengths), lengths) + np.arange(total)
            out.append(self.pool[at])
        return out


def encoder(path: str) -> PieceEncoder:
    """One per worker and tokenizer file; its table of pieces serves all tasks of the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
