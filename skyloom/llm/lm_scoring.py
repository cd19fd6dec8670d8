"""Language-model scoring with Elias-Fano n-gram tries over all training documents.

The model is a bigram with Dirichlet smoothing, P(w | v) = (c(v w) + mu P(w)) / (c(v) + mu), on the smoothed unigram
P(w) = (c(w) + 1/2) / (N + (V + 1) / 2); it sums to one. Its logarithm splits into a part of (v, w) and one of v alone, and
both need only the counts of one word: shard w knows c(w), every c(v w) and, where w is itself a context, c(w). A batch of
texts adds up its training counts and asks the shard of w once per distinct (w, v); a shard counts, builds its trie, maps it
into memory and answers in the order asked. The answers meet their batch, which adds them up per document. No table of all
n-grams is ever in one place.

A shard holds about ``SHARD`` questions: words are dealt by hash, and those with more than ``HOT`` of that, a list of at
most 1 / ``HOT`` words per shard, by word and context, with their total counts broadcast. One (w, v) is one question per ``BATCH``
of text, however often it occurs. A batch holds its own questions and answers, nothing of other batches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import saved, slices
from skyloom.llm.elias_fano import Trie

BATCH = 16_000_000  # bytes of text encoded with one dictionary
SHARD = 3_000_000  # questions answered by one trie
HOT = 1 / 10  # share of a shard from which the questions of a word are split
END = xxhash.xxh3_64_intdigest(b"end of text")  # words hold no space, so these two are none
START = xxhash.xxh3_64_intdigest(b"start of text")
_CONTEXT = np.uint64((1 << 48) - 1)  # bits of the hash that tell the contexts of one word apart
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _pack(x: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes as the largest needs, byte by byte of all of them, compressed."""
    most = int(x.max()) if len(x) else 0
    x = x.astype("u1" if most < 1 << 8 else "u2" if most < 1 << 16 else "u4" if most < 1 << 32 else "u8")
    planes = np.ascontiguousarray(x.view("u1").reshape(len(x), x.itemsize).T).tobytes()
    return bytes([x.itemsize]) + len(x).to_bytes(8, "little") + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def _unpack(data: bytes) -> np.ndarray:
    size, n = data[0], int.from_bytes(data[1:9], "little")
    planes = pa.decompress(data[9:], size * n, "zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(planes, "u1").reshape(size, n).T).view(f"u{size}").ravel()


def _tokens(sizes: np.ndarray, flat: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, context and document of every token and end of a batch; ``end`` is the end's number, the next the start's."""
    sizes = sizes.astype(np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes + 1)
    ends = np.cumsum(sizes + 1) - 1
    word, context = np.empty(len(doc), np.int64), np.empty(len(doc), np.int64)
    inner = np.ones(len(doc), bool)
    inner[ends] = False
    word[inner], word[ends] = flat, end
    context[1:], context[ends - sizes] = word[:-1], end + 1
    return word, context, doc


def encode_batches(docs: DataFrame, train: str, kind: str) -> DataFrame:
    """One row per ``BATCH`` of text: document ids, train flags and sizes; its words' hashes, the end last, their counts in
    training and their numbers of distinct contexts; the words of all documents as numbers in this list."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, flags, sizes, tokens, words, held = [], [], [], [], _Numbers(), 0

        def flush() -> pa.RecordBatch:
            count, flag = np.concatenate(sizes), np.concatenate(flags)
            flat = np.concatenate(tokens)
            end = len(words)
            word, context, doc = _tokens(count, flat, end)
            known = np.bincount(word[flag[doc]], minlength=end + 1)
            asks = np.bincount(np.unique(word * (end + 2) + context) // (end + 2), minlength=end + 1)
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, end)
            hashes = np.append(hashes, np.uint64(END)).view(np.int64)
            one = lambda x, t: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x if isinstance(x, pa.Array) else pa.array(x, t))
            return pa.RecordBatch.from_arrays(
                [one(pa.concat_arrays(ids), None), one(flag, pa.bool_()), one(count, pa.int32()), one(hashes, pa.int64()),
                 one(known, pa.int32()), one(asks, pa.int32()), pa.array([_pack(flat)])],
                ["doc_ids", "train", "sizes", "words", "known", "asks", "tokens"])

        for batch in slices(batches, "text"):
            texts = [(t or "").encode().lower().split() for t in batch.column("text").to_pylist()]
            ids.append(pa.concat_arrays([batch.column("doc_id")]))
            flags.append(np.array(batch.column("train").to_pylist(), bool))
            sizes.append(np.array([len(t) for t in texts], np.int32))
            tokens.append(np.fromiter((n for t in texts for n in map(words.__getitem__, t)), np.int32, int(sizes[-1].sum())))
            held += batch.column("text").nbytes
            if held >= BATCH:
                yield flush()
                ids, flags, sizes, tokens, words, held = [], [], [], [], _Numbers(), 0
        if ids:
            yield flush()

    out = docs.select("doc_id", "text", F.expr(train).alias("train")).mapInArrow(
        encode, f"doc_ids array<{kind}>, train array<boolean>, sizes array<int>, words array<bigint>, known array<int>, "
                "asks array<int>, tokens binary")
    return saved(out.withColumn("batch", F.monotonically_increasing_id()), "lm-batches")


def totals(batches: DataFrame) -> tuple[int, int, int, int, dict[int, int]]:
    """Training tokens, training documents, words seen in training, questions, and the training counts of the words with more
    than ``HOT`` of ``SHARD`` questions, of which there are at most 1 / ``HOT`` per shard."""
    each = batches.select(F.explode(F.arrays_zip("words", "known", "asks")).alias("w")).select("w.*").groupBy("words").agg(
        F.sum("known").alias("known"), F.sum("asks").alias("asks"))
    hot = F.when(F.col("asks") > F.lit(SHARD * HOT), F.struct("words", "known"))
    end = F.max(F.when(F.col("words") == F.lit(int(np.uint64(END).view(np.int64))), F.col("known")))
    row = each.agg(F.sum("known").alias("n"), end.alias("ends"), F.count_if(F.col("known") > 0).alias("v"), F.sum("asks").alias("asks"),
                   F.collect_list(hot).alias("hot")).first()
    return row["n"] or 0, row["ends"] or 0, row["v"] or 0, row["asks"] or 0, {h["words"]: h["known"] for h in row["hot"]}


def _deal(pairs: np.ndarray, hashes: np.ndarray, hot: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted questions word * len(hashes) + context in the order of their shards: word, context, place in ``pairs``, and
    where every shard begins."""
    word, context = np.divmod(pairs, len(hashes))
    at = (hashes % np.uint64(shards))[word]
    split = np.isin(hashes, hot)[word]
    at[split] = (((hashes[word[split]] ^ hashes[context[split]]) * _MIX) >> np.uint64(20)) % np.uint64(shards)
    order = np.argsort(at, kind="stable")
    return word[order], context[order], order, np.searchsorted(at[order], np.arange(shards + 1).astype(np.uint64))


def to_shards(batches: DataFrame, hot: np.ndarray, shards: int) -> DataFrame:
    """(shard, batch, blob columns): for every batch and shard its distinct questions, ordered by word, with their counts in
    training."""

    def deal(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in rows:
            for i in range(group.num_rows):
                get = lambda c: group.column(c)[i].values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
                hashes = np.append(get("words").view(np.uint64), np.uint64(START))
                word, context, doc = _tokens(get("sizes"), _unpack(group.column("tokens")[i].as_py()), len(hashes) - 2)
                asked = np.sort((word * len(hashes) + context) * 2 + get("train").astype(bool)[doc])
                pairs, first = np.unique(asked >> 1, return_index=True)
                counts = np.add.reduceat(asked & 1, first)
                word, context, order, edges = _deal(pairs, hashes, hot, shards)
                counts = counts[order]
                del asked, pairs, first, order, doc
                place = np.empty(len(hashes), np.int64)
                out = []
                for s in range(shards):
                    a, b = int(edges[s]), int(edges[s + 1])
                    if a == b:
                        continue
                    w, first = np.unique(word[a:b], return_index=True)
                    mark = np.zeros(len(hashes), bool)
                    mark[context[a:b]] = True
                    v = np.flatnonzero(mark)
                    place[v] = np.arange(len(v))
                    out.append((s, group.column("batch")[i].as_py(), *map(_pack, (
                        hashes[w], np.diff(np.append(first, b - a)), hashes[v] & _CONTEXT, place[context[a:b]], counts[a:b]))))
                kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
                for x in range(0, len(out), 16):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[x:x + 16]), kinds)], FIELDS)

    return batches.select("batch", "train", "sizes", "words", "tokens").mapInArrow(
        deal, "shard int, batch bigint, words binary, times binary, contexts binary, c binary, n binary")


FIELDS = ["shard", "batch", "words", "times", "contexts", "c", "n"]


def answer(table: pa.Table, hot: np.ndarray, hot_counts: np.ndarray, n: int, v: int, mu: float) -> pa.Table:
    """For every batch of one shard: the training counts of its words, and the model's log10 of its questions without the
    part of the context, both in the order asked."""
    rows = table.to_pylist()
    words = np.unique(np.concatenate([_unpack(r["words"]) for r in rows]))
    contexts = np.unique(np.concatenate([_unpack(r["contexts"]) for r in rows]))
    parts = []
    for r in rows:
        own = np.searchsorted(words, _unpack(r["words"])).astype(np.int32)
        context = np.searchsorted(contexts, _unpack(r["contexts"])).astype(np.int32)
        parts.append((own, np.repeat(own, _unpack(r["times"])), context[_unpack(r["c"])], _unpack(r["n"])))
    pair, place = np.unique(np.concatenate([word[k > 0].astype(np.int64) * len(contexts) + context[k > 0] for _, word, context, k in parts]),
                            return_inverse=True)
    times = np.bincount(place, np.concatenate([k[k > 0] for *_, k in parts]), len(pair))
    del place
    parent, child = pair // max(1, len(contexts)), pair % max(1, len(contexts))
    count = np.bincount(parent, times, len(words))
    if len(hot):
        at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
        count = np.where(hot[at] == words, hot_counts[at], count)
    p = (count + 0.5) / (n + 0.5 * (v + 1))
    trie = Trie(words, np.log10(mu * p), parent, child, np.log10(times + mu * p[parent]), len(contexts))
    del pair, parent, child, times
    node = trie.words.find(words)
    scale = [trie.unseen.least, trie.unseen.step, trie.value.least, trie.value.step]
    out = []
    for r, (own, word, context, _) in zip(rows, parts):
        codes, seen = trie.codes(node[word], context)
        out.append((r["batch"], r["shard"], _pack(count[own].astype(np.uint64)), _pack(codes), np.packbits(seen).tobytes(), scale))
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()))
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["batch", "shard", "known", "codes", "seen", "scale"])


def gather(batch: pa.Table, answers: pa.Table, hot: np.ndarray, shards: int, mu: float) -> pa.Table:
    """One row per document of a batch: base log10 counts, model log10 and known tokens, summed up."""
    get = lambda c: batch.column(c)[0].values.to_numpy(zero_copy_only=False)
    hashes = np.append(get("words").view(np.uint64), np.uint64(START))
    end, docs = len(hashes) - 2, len(get("sizes"))
    word, context, doc = _tokens(get("sizes"), _unpack(batch.column("tokens")[0].as_py()), end)
    pairs, asked = np.unique(word * len(hashes) + context, return_inverse=True)
    del context
    dealt, _, order, edges = _deal(pairs, hashes, hot, shards)
    count, score = np.zeros(end + 1), np.empty(len(pairs))
    for r in answers.to_pylist():
        a, b = int(edges[r["shard"]]), int(edges[r["shard"] + 1])
        count[np.unique(dealt[a:b])] = _unpack(r["known"])
        seen = np.unpackbits(np.frombuffer(r["seen"], np.uint8), count=b - a).astype(bool)
        low, step, seen_low, seen_step = r["scale"]
        score[order[a:b]] = np.where(seen, seen_low, low) + np.where(seen, seen_step, step) * _unpack(r["codes"])
    del pairs, dealt, order
    # a word is the context of what follows it; the end of a text is not
    alone = np.log10(count + mu)
    alone[end] = 0.0
    sums = [np.bincount(doc, x, docs) for x in (np.log10(count + 0.5)[word], score[asked] - alone[word], (count > 0)[word])]
    ids = batch.column("doc_ids").combine_chunks().flatten()
    return pa.table([ids, pa.array(get("train")), pa.array(get("sizes")), *map(pa.array, sums)], ["doc_id", "train", "sizes", "base", "score", "known"])


def score_documents(docs: DataFrame, train: str, *, doc_id: str = "doc_id", text: str = "text", mu: float = 1000.0) -> DataFrame:
    """Log10 probability of every whole text under a model of all training documents.

    ``train`` is an SQL condition on ``doc_id``. Returns one row per input row: doc_id, held_out (not in training), n_tokens (words,
    A-Z in lower case, and one end), n_known (tokens seen in training), train_tokens, base_score (the sum of log10 unigram
    probabilities), score (the model's).

    Null, empty and wordless texts are one end token. Null ids and repeated rows are documents of their own. Without
    training documents every count is 0 and the model is the unigram. Empty tables give no rows. Other columns are not
    read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    batches = encode_batches(rows, train, kind)
    n, ends, v, questions, found = totals(batches)
    hot = np.array(sorted(found), np.int64)
    hot_counts = np.array([found[h] for h in hot.tolist()], np.float64)
    order = np.argsort(hot.view(np.uint64))
    hot, hot_counts = hot.view(np.uint64)[order], hot_counts[order]
    shards = max(1, math.ceil(questions / SHARD))
    answers = to_shards(batches, hot, shards).groupBy("shard").applyInArrow(
        lambda table: answer(table, hot, hot_counts, n, v, mu), "batch bigint, shard int, known binary, codes binary, seen binary, scale array<double>")
    each = batches.select("batch", "doc_ids", "train", "sizes", "words", "tokens").groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        lambda batch, found: gather(batch, found, hot, shards, mu),
        f"doc_id {kind}, train boolean, sizes int, base double, score double, known double")
    size = (F.col("sizes") + 1).cast("long")
    return each.select(
        "doc_id", (~F.col("train")).alias("held_out"), size.alias("n_tokens"), F.col("known").cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") - size * F.lit(math.log10(n + 0.5 * (v + 1)))).alias("base_score"),
        (F.col("score") - F.lit(math.log10(ends + mu))).alias("score"))
