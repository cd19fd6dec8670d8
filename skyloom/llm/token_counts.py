"""Edit-aware token counts: a segment tree per document over its pre-token segments.

A document's state is its text and a tree whose leaves are the segments between places where no pre-token goes on; a
node holds the characters and tokens below it. An edit finds its first and last segment by descending the character sums,
takes the segments it touches and one more on either side as context, encodes that region only, and updates the
sums on the paths of these leaves. Nothing else of the document is encoded again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import slices
from skyloom.llm.encoding import PieceEncoder, encoder

EDITS = "array<struct<at:bigint,gone:bigint,text:string>>"


class SegmentTree:
    """Sums over leaves in one array: node i has children 2i and 2i+1, leaf k is node ``base`` + k."""

    def __init__(self, values: np.ndarray) -> None:
        self.base = 1 << max(0, (len(values) - 1).bit_length())
        sums = np.zeros(2 * self.base, np.int64)
        sums[self.base:self.base + len(values)] = values
        half = self.base
        while half > 1:
            sums[half // 2:half] = sums[half:2 * half:2] + sums[half + 1:2 * half:2]
            half //= 2
        self.sums = sums

    def total(self) -> int:
        return int(self.sums[1])

    def set(self, leaf: int, value: int) -> None:
        node = self.base + leaf
        change = value - int(self.sums[node])
        while change and node:
            self.sums[node] += change
            node >>= 1

    def locate(self, at: int) -> tuple[int, int]:
        """Leaf that holds position ``at`` of the sums, and where it begins; empty leaves hold none."""
        node, begin = 1, 0
        while node < self.base:
            node *= 2
            left = int(self.sums[node])
            if at >= begin + left:
                begin += left
                node += 1
        return node - self.base, begin


class CountedText:
    """Text and token count of one document under edits."""

    def __init__(self, text: str, tool: PieceEncoder, counts: np.ndarray | None = None) -> None:
        self.tool = tool
        self.leaves = tool.pieces(text) or [""]
        if counts is None:
            counts = tool.counts(tool.codes([text])[0])
        self.chars = SegmentTree(np.fromiter(map(len, self.leaves), np.int64, len(self.leaves)))
        self.tokens = SegmentTree(counts if len(counts) else np.zeros(1, np.int64))
        self.encoded = 0

    def text(self) -> str:
        return "".join(self.leaves)

    def edit(self, at: int, gone: int, new: str) -> None:
        """Replaces ``gone`` characters from ``at`` by ``new``; both are cut to the text."""
        size = self.chars.total()
        at = min(max(0, at), size)
        gone = min(max(0, gone), size - at)
        first, begin = self.chars.locate(min(at, size - 1)) if size else (0, 0)
        last = self.chars.locate(min(at + gone, size - 1))[0] if size else 0
        region = "".join(self.leaves[first:last + 1])
        region = region[:at - begin] + new + region[at - begin + gone:]
        # context: whole segments on both sides until the cuts beside the region are cuts of the new text too
        while not self._holds(first, last, region):
            if first > 0:
                first -= 1
                region = self.leaves[first] + region
            if last < len(self.leaves) - 1:
                last += 1
                region += self.leaves[last]
        self.leaves[first:last + 1] = [region] + [""] * (last - first)
        self.encoded += len(region)
        count = len(self.tool.encode([region])[0])
        for leaf in range(first, last + 1):
            self.chars.set(leaf, len(self.leaves[leaf]))
            self.tokens.set(leaf, count if leaf == first else 0)

    def _holds(self, first: int, last: int, region: str) -> bool:
        before = next((x for x in reversed(self.leaves[:first]) if x), "")
        after = next((x for x in self.leaves[last + 1:] if x), "")
        if not region:
            return self.tool.is_cut(before[-1:], after)
        return self.tool.is_cut(before[-1:], region) and self.tool.is_cut(region[-1:], after)


def count_tokens_after_edits(docs: DataFrame, *, tokenizer: str, edits: str | Column, doc_id: str = "doc_id",
                             text: str = "text") -> DataFrame:
    """Token counts before and after the edits of each row, which are applied in order.

    ``edits`` is a column of (at, gone, text) structs. Returns one row per input row: doc_id, n_tokens, n_edits,
    edited_tokens, edited_chars, edited_crc32 (of the edited text in UTF-8) and encoded_chars (characters encoded for the edits).

    Null text is empty; null edits, and null fields, change nothing. Places past the end are the end. Null ids and
    repeated rows keep their rows. Empty tables give no rows. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       (F.col(edits) if isinstance(edits, str) else edits).cast(EDITS).alias("edits"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            # the table of known pieces may be cleared between texts, so the counts are taken first
            counts = [tool.counts(c) for c in tool.codes(texts)]
            out = []
            for t, n, changes in zip(texts, counts, batch.column("edits").to_pylist()):
                doc = CountedText(t, tool, n)
                before = doc.tokens.total()
                changes = [c for c in changes or [] if c and None not in c.values()]
                for c in changes:
                    doc.edit(c["at"], c["gone"], c["text"])
                edited = doc.text()
                out.append((before, len(changes), doc.tokens.total(), len(edited), zlib.crc32(edited.encode()), doc.encoded))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in zip(*out))],
                                             ["doc_id", "n_tokens", "n_edits", "edited_tokens", "edited_chars", "edited_crc32",
                                              "encoded_chars"])

    return rows.mapInArrow(count, f"doc_id {kind}, n_tokens bigint, n_edits bigint, edited_tokens bigint, edited_chars bigint, "
                                  "edited_crc32 bigint, encoded_chars bigint")


def document_edits(text: str = "text", *, seed: int = 11, edits: int = 3) -> Column:
    """Edits that a document's own text gives: at hashed places up to 40 characters are replaced by a hashed stretch of up
    to 40 characters of the text."""
    own = F.coalesce(F.col(text), F.lit(""))
    size = F.length(own)

    def one(i: Column) -> Column:
        draw = lambda k, n: F.pmod(F.xxhash64(own, i, F.lit(seed), F.lit(k)), n + 1)
        return F.struct(draw(1, size).alias("at"), draw(2, F.lit(40)).alias("gone"),
                        F.substring(own, draw(3, size).cast("int") + 1, draw(4, F.lit(40)).cast("int")).alias("text"))

    return F.transform(F.sequence(F.lit(1), F.lit(edits)), one)
