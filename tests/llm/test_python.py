"""Language ID, token counts, packing, near-dedup, LM scoring and the token store against plain Python."""

import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_data import BYTE, ODD, WORD, crc, frame, real
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyloom.llm.common import fold
from skyloom.llm.components import connected_components
from skyloom.llm.elias_fano import EliasFano, Trie
from skyloom.llm.encoding import PieceEncoder
from skyloom.llm.language import Parser, identify_language, keep_identified, training_sample
from skyloom.llm import lm_scoring
from skyloom.llm.lm_scoring import score_documents
from skyloom.llm.near_dedup import NearDuplicates, drop_near_duplicates, near_duplicates
from skyloom.llm.packing import pack_documents, sum_of_squares
from skyloom.llm.token_counts import CountedText, SegmentTree, count_tokens_after_edits, document_edits
from skyloom.llm.token_store import read_tokens, store_tokens, write_tokens
from skyloom.session import work_path

PARTS = [" ", "  ", "\n", ".", ",", "a", "Bé", "'s", "1", "!", "_", "\t", "<|endoftext|>", "\U0001f642", " x", "́", "\x01", "Word", "."]
TRAIN = "coalesce(crc32(cast(doc_id AS string)), 0) % 5 <> 1"


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_encode_like_whole_texts(path):
    tool, rng = PieceEncoder(path, most=500), random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(1500)] + [t or "" for _, t, _, _ in real()]
    for at in range(0, len(texts), 300):
        want = tool.tokenizer.encode_batch(texts[at:at + 300], add_special_tokens=False)
        assert [x.tolist() for x in tool.encode(texts[at:at + 300])] == [w.ids for w in want]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_many_texts_are_cut_on_their_bytes(path, monkeypatch):
    rng = random.Random(2)
    plain = ["", " x", "Bé, Word.", *(" ".join(rng.choice(["Wörd", "a,", "the.", "été\nne", "x1!"]) for _ in range(400)) for _ in range(60)), ""]
    odd = ["a  b.. c", "<|endoftext|> x.", "\x01 a", "a\u0301. b", "_."]
    texts = [*plain[:9], *odd, *plain[9:]]
    tool, cut, alone = PieceEncoder(path), [], PieceEncoder.pieces
    monkeypatch.setattr(PieceEncoder, "pieces", lambda self, text: cut.append(text) or alone(self, text))
    assert [x.tolist() for x in tool.encode(texts)] == [w.ids for w in tool.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert cut == odd
    assert [len(c) for c in tool.codes(texts)] == [len(alone(tool, t)) for t in texts]


def plain_phrases(text, sample):
    count, at = 0, 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at:at + n + 1] in sample:
            n += 1
        count, at = count + 1, at + n
    return count


def test_batch_of_texts_is_held_in_few_bytes_a_letter():
    """Workers keep what a batch took: wide index arrays over all its letters filled an executor in the stages after it."""
    tool = Parser({"a": "the cat sat on the mat", "b": "le chat est sur le tapis"})
    texts = ["the cat  sat, " * 200 + "x" * (i % 7) for i in range(1500)]
    want = tool.classify(texts[:7])
    tracemalloc.start()
    try:
        names, scores = tool.classify(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert names[:7] == want[0] and np.array_equal(scores[:7], want[1])
    assert peak < 12 * sum(map(len, texts)), peak / sum(map(len, texts))


def test_phrases_are_longest_matches():
    samples = {"x": "banana band and sand", "y": "the other one then there"}
    tool = Parser(samples)
    texts = ["banana", "the sand and the band", "zzz", "another then"]
    flat, length, _ = tool.folded(texts)
    got = tool.phrases(flat, length)
    for i, t in enumerate(texts):
        for k, s in enumerate(samples.values()):
            assert got[i, k] == plain_phrases(t, s)


def test_language(spark, docs, none):
    train = fold(F.col("doc_id"), 4) != 2
    rows = {r["doc_id"]: r for r in identify_language(docs, train).collect()}
    held = [(d, lang) for d, _, lang, _ in real() if crc(d, 4) == 2]
    assert sum(rows[d]["lang_pred"] == lang for d, lang in held) >= 0.98 * len(held)
    odd = frame(spark, ODD)
    got = Counter((r["doc_id"], r["lang_pred"] == "und") for r in identify_language(odd, F.lit(True)).collect())
    assert got == Counter((d, not any(c.isalpha() for c in t or "")) for d, t, _, _ in ODD)
    kept = keep_identified(odd, F.lit(True))
    assert kept.columns == odd.columns and kept.count() == sum(any(c.isalpha() for c in t or "") for _, t, _, _ in ODD)
    assert all(r["lang_pred"] == "und" for r in identify_language(odd, F.lit(False)).collect())
    assert identify_language(none, train).count() == 0


def test_few_labelled_texts_share_all_letters(spark):
    rows = [(i, "1 " * 1000 + f"{'abc' * 400}{x} ", "few", None) for i, x in enumerate("pqrppp")] + [(9, "0" * 3000 + " Ab", "late", None)]
    got = training_sample(frame(spark, rows), F.lit(True), doc_id="doc_id", text="text", lang="lang", per_language=64, letters=3000)
    assert sorted(map(len, got["few"].split())) == [1000] * 3 and got["late"] == "ab"  # copies count once


def test_segment_tree():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 8, 13):
        values = rng.integers(0, 5, n)
        tree = SegmentTree(values)
        for _ in range(20):
            k, v = int(rng.integers(n)), int(rng.integers(0, 5))
            tree.set(k, v)
            values[k] = v
            assert tree.total() == values.sum()
            for at in range(int(values.sum())):
                leaf, begin = tree.locate(at)
                assert begin == values[:leaf].sum() and begin <= at < begin + values[leaf]


def test_edits_count_like_encoding_again():
    rng, tool = random.Random(3), PieceEncoder(BYTE)
    for k in range(150):
        s = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) if k % 2 else (real(40)[k % 40][1] or "")[:300]
        doc = CountedText(s, tool)
        for _ in range(5):
            at, gone = rng.randint(0, len(s) + 3), rng.choice([0, 0, 1, 5, 40, 10 ** 6])
            new = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 4)))
            doc.edit(at, gone, new)
            at = min(at, len(s))
            s = s[:at] + new + s[at + gone:]
            assert doc.text() == s and doc.tokens.total() == len(tool.tokenizer.encode(s, add_special_tokens=False).ids)


def test_edit_encodes_little():
    tool = PieceEncoder(BYTE)
    doc = CountedText("some words to edit. " * 5000, tool)
    doc.edit(50_000, 3, "xyz")
    assert doc.encoded < 60


@pytest.mark.parametrize("rows", [ODD, real()])
def test_token_counts(spark, rows):
    docs = frame(spark, rows)
    tool = Tokenizer.from_file(BYTE)
    size = lambda t: len(tool.encode(t, add_special_tokens=False).ids)
    want = Counter()
    for r in docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), document_edits().alias("e")).collect():
        t = r["text"]
        for e in r["e"]:
            t = t[:e["at"]] + e["text"] + t[e["at"] + e["gone"]:]
        want[(r["doc_id"], size(r["text"]), size(t), len(t), zlib.crc32(t.encode()))] += 1
    got = count_tokens_after_edits(docs, tokenizer=BYTE, edits=document_edits())
    assert Counter(tuple(r) for r in got.select("doc_id", "n_tokens", "edited_tokens", "edited_chars", "edited_crc32").collect()) == want


def test_token_counts_of_null_edits(spark, none):
    rows = spark.createDataFrame([(1, "ab cd", None), (2, "ab", [(0, None, "x"), None, (9, 1, " y")])],
                                 "doc_id bigint, text string, edits array<struct<at:bigint,gone:bigint,text:string>>")
    got = {r["doc_id"]: r for r in count_tokens_after_edits(rows, tokenizer=BYTE, edits="edits").collect()}
    assert got[1]["n_edits"] == 0 and got[1]["edited_chars"] == 5 and got[2]["n_edits"] == 1 and got[2]["edited_chars"] == 4
    assert count_tokens_after_edits(none, tokenizer=BYTE, edits=document_edits()).count() == 0


def test_sum_of_squares_rule():
    rng = random.Random(5)
    lengths, capacity = [rng.randint(1, 20) for _ in range(300)], 20
    bins, offsets = sum_of_squares(np.array(lengths), capacity)
    gaps = {}
    cost = lambda g: sum(v * v for v in Counter(x for x in g.values() if x).values())
    for n, b, at in zip(lengths, bins.tolist(), offsets.tolist()):
        options = [{**gaps, k: v - n} for k, v in gaps.items() if v >= n] + [{**gaps, len(gaps): capacity - n}]
        assert at == capacity - gaps.get(b, capacity)
        gaps[b] = gaps.get(b, capacity) - n
        assert gaps[b] >= 0 and cost(gaps) == min(map(cost, options))


@pytest.mark.parametrize("rows,group", [(ODD, 20_000), (real(), 20_000), (real(), 40)])
def test_packing(spark, rows, group):
    tool = Tokenizer.from_file(WORD)
    ids = [(d, tool.encode(t or "", add_special_tokens=False).ids + [0]) for d, t, _, _ in rows]
    want = Counter((d, p, a, len(x[a:a + 2048]), zlib.crc32(np.array(x[a:a + 2048], "<u4").tobytes()))
                   for d, x in ids for p, a in enumerate(range(0, len(x), 2048)))
    got = pack_documents(frame(spark, rows), tokenizer=WORD, end_id=0, group=group).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(len(x) for _, x in ids)
    assert len(sequences) <= math.ceil(total / 2048) * 1.03 + 2


def test_packing_of_nothing(none):
    assert pack_documents(none, tokenizer=WORD, end_id=0).count() == 0


def sets_of(rows, k):
    out = []
    for d, t, _, _ in rows:
        w = (t or "").encode().lower().split()
        out.append((d, {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())))
    return out


def groups_of(sets, percent=80):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (d, s) in enumerate(sets):
        groups[find(i)].append((d, len(s)))
    return groups


def family(seed, n, edits, words=90):
    """Near copies of one text with up to ``edits`` words changed, many of them near misses of each other."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 400)}" for _ in range(words)]
    out = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(words)] = f"e{rng.randint(0, 60)}"
        out.append((seed * 1000 + i, " ".join(own), "en", "a"))
    return out


@pytest.mark.parametrize("rows,k", [(ODD, 2), (real(), 2), (real(), 5), (family(1, 120, 9) + family(2, 40, 12), 2), (family(3, 60, 6), 5)])
def test_near_duplicates(spark, rows, k):
    want = Counter()
    for members in groups_of(sets_of(rows, k)).values():
        first = min((d for d, _ in members if d is not None), default=None)
        for i, (d, n) in enumerate(sorted(members, key=lambda m: (m[0] is None, m[0] or 0))):
            want[(d, n, first)] += 1
    docs = frame(spark, rows)
    got = near_duplicates(docs, shingle=k).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len(groups_of(sets_of(rows, k)))
    assert all(r["doc_id"] == r["component_id"] for r in got if r["kept"])
    if rows is ODD:
        kept = drop_near_duplicates(docs, shingle=k)
        assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)


class Counted(NearDuplicates):
    """Counts the pairs whose full sets are compared."""

    pairs = 0

    def links(self, pairs, full):
        self.pairs += pairs.count()
        return super().links(pairs, full)


def test_pairs_of_a_linked_group_grow_with_its_size(spark):
    each = []
    for n in (300, 1200):
        rows = family(5, n, 4, words=150)  # any two differ in eight words at most, so all are linked
        run = Counted(frame(spark, rows), "doc_id", "text", 2, 80, 16, 5)
        got = {r["doc_id"]: r["component_id"] for r in run.run().collect()}
        assert got == {d: min(m for m, _ in members) for members in groups_of(sets_of(rows, 2)).values() for d, _ in members}
        each.append(run.pairs / n)
    assert each[1] <= 1.25 * each[0], each


def test_near_duplicates_of_nothing(none):
    assert near_duplicates(none).count() == drop_near_duplicates(none).count() == 0


def test_nodes_are_indexed_in_even_tasks(spark):
    """Nodes become 80 keys each, so few bytes of signatures are no reason for few tasks."""
    run = NearDuplicates(frame(spark, family(4, 400, 4)).coalesce(1), "doc_id", "text", 2, 80, 16, 5)
    nodes = run.sets().where("digest is not null").withColumnRenamed("row", "node")
    each = [r["n"] for r in run.keys(nodes).groupBy(F.spark_partition_id().alias("part")).agg(F.count("key").alias("n")).collect()]
    assert sum(each) == 80 * nodes.count() and len(each) > 1 and max(each) <= 2 * sum(each) / len(each)


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (10, 11), (12, 10), (7, 7), (5, 6), (20, 19), (19, 18), (18, 20)] + [(i, i + 1) for i in range(30, 80)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 7)}, 10: 10, 11: 10, 12: 10, 18: 18, 19: 18, 20: 18, **{i: 30 for i in range(30, 81)}}
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(4)
    for n, top in ((0, 1), (1, 5), (500, 700), (3000, 10 ** 12), (2000, 2 ** 63 - 1)):
        values = np.unique(rng.integers(0, top, n).astype(np.uint64))
        sequence = EliasFano.build(values)
        assert (sequence.values() == values).all()
        asked = np.concatenate([values, rng.integers(0, top, 500).astype(np.uint64), np.array([0, 2 ** 64 - 1], np.uint64)])
        index = {v: i for i, v in enumerate(values.tolist())}
        assert sequence.find(asked).tolist() == [index.get(v, -1) for v in asked.tolist()]
    repeated = np.sort(rng.integers(0, 50, 400).astype(np.uint64))
    assert (EliasFano.build(repeated).values() == repeated).all()


def test_trie():
    words = np.array([3, 8, 2 ** 60], np.uint64)
    trie = Trie(words, np.array([-1.0, -2.0, -3.0]), np.array([0, 0, 2]), np.array([1, 4, 0]), np.array([-0.1, -0.2, -0.3]), 5)
    got = trie.score(np.array([0, 0, 0, 1, 2, 2]), np.array([1, 4, 0, 1, 0, 4]))
    assert np.allclose(got, [-0.1, -0.2, -1, -2, -0.3, -3], atol=1e-4)


@pytest.mark.parametrize("rows", [ODD, real(), [(i, "the the the cat", "en", "a") for i in range(50)]])
def test_scores(spark, rows):
    mu = 1000.0
    texts = [(d, crc(d, 5) == 1, (t or "").encode().lower().split() + [b" end"]) for d, t, _, _ in rows]
    count, pair, start = Counter(), Counter(), sum(not h for _, h, _ in texts)
    for _, held, w in texts:
        if not held:
            count.update(w)
            pair.update(zip([b" start", *w[:-1]], w))
    n, v = sum(count.values()), len(count)
    p = lambda x: (count[x] + 0.5) / (n + 0.5 * (v + 1))
    want = []
    for d, held, w in texts:
        base = sum(math.log10(p(x)) for x in w)
        score = sum(math.log10((pair[c, x] + mu * p(x)) / ((start if c == b" start" else count[c]) + mu)) for c, x in zip([b" start", *w[:-1]], w))
        want.append((d if d is not None else -1, held, len(w), sum(count[x] > 0 for x in w), n, base, score))
    got = [(r[0] if r[0] is not None else -1, *r[1:]) for r in score_documents(frame(spark, rows), TRAIN).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()]
    for a, b in zip(sorted(got), sorted(want), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=2e-4, abs_tol=1e-3)


def test_repeated_pairs_are_asked_once_per_batch(spark, monkeypatch):
    rows = [(i, "of the " * 2000 + f"w{i} of the", None, None) for i in range(60)]
    batches = lm_scoring.encode_batches(frame(spark, rows).coalesce(1).select("doc_id", "text", F.expr("true").alias("t")), "doc_id % 2 = 0", "bigint")
    asked = lm_scoring.to_shards(batches, np.zeros(0, np.uint64), 1).collect()
    questions = sum(len(lm_scoring._unpack(r["c"])) for r in asked)
    assert len(asked) == 1 and questions == 4 + 2 * 60 == lm_scoring.totals(batches)[3]
    want = score_documents(frame(spark, rows), TRAIN).orderBy("doc_id").collect()
    monkeypatch.setattr(lm_scoring, "SHARD", 20)  # words are split, and a batch meets many shards
    for a, b in zip(want, score_documents(frame(spark, rows), TRAIN).orderBy("doc_id").collect(), strict=True):
        assert a[:6] == b[:6] and math.isclose(a["score"], b["score"], rel_tol=2e-4)


def test_scores_without_training(spark, none):
    rows = score_documents(frame(spark, real(30)), "false").collect()
    assert len(rows) == 30 and all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in rows)
    assert score_documents(none, TRAIN).count() == 0


@pytest.mark.parametrize("rows", [ODD, real()])
def test_token_store(spark, rows):
    tool = Tokenizer.from_file(BYTE)
    ids = [(d, tool.encode(t or "", add_special_tokens=False).ids + [2]) for d, t, _, _ in rows]
    got = sorted(store_tokens(frame(spark, rows), tokenizer=BYTE, end_id=2).collect(), key=lambda r: r["start"])
    keys = [r["doc_id"] if r["doc_id"] is not None else -1 for r in got]
    assert keys == sorted(keys)
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter(
        (d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, x in ids)


def test_token_files_carry_bloom_filters_and_round_trip(spark, none):
    from pyarrow import orc

    path = work_path(spark, "orc-test")
    rows = real(60)
    write_tokens(frame(spark, rows), path, tokenizer=BYTE, end_id=2)
    tool = Tokenizer.from_file(BYTE)
    want = {d: tool.encode(t, add_special_tokens=False).ids + [2] for d, t, _, _ in rows}
    assert {r["doc_id"]: r["ids"] for r in spark.read.orc(path).collect()} == want
    import glob

    files = glob.glob(f"{path}/*.orc")
    assert files and all(orc.ORCFile(f).nstripes >= 1 for f in files)
    assert spark.read.orc(path).where("doc_id = 7").count() == 1
    empty = work_path(spark, "orc-none")
    write_tokens(none, empty, tokenizer=BYTE, end_id=2)
    assert read_tokens(spark, empty).count() == 0


def test_digests_do_not_depend_on_partitions(spark):
    rows = real(80)
    one = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame(spark, rows).coalesce(1)).collect()}
    many = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame(spark, rows).repartition(7)).collect()}
    assert one == many
