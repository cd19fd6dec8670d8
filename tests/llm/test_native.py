"""Mixing, sharding, fingerprints and exact dedup against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from llm_data import ODD, frame, real
from pyspark.sql import functions as F

from skyloom.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from skyloom.llm.fingerprint import BINS, edited_fingerprints
from skyloom.llm.mixing import mix_sources, take_mix
from skyloom.llm.sharding import assign_shards, shard_of, weighted_tree

SPACE = re.compile(r"[\x20\x09-\x0D]+")
words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def targets(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, left, budget = {}, set(names), share * sum(sizes.values())
    while left:
        level = budget / sum(weight[s] for s in left)
        full = {s for s in left if level * weight[s] >= most * sizes[s]}
        for s in full or left:
            out[s] = most * sizes[s] if full else level * weight[s]
        if not full:
            break
        budget -= sum(out[s] for s in full)
        left -= full
    return out


@pytest.mark.parametrize("rows", [ODD, real(), [(i, "w " * (1 + i % 7), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(3000)]])
def test_mixing(spark, rows):
    docs = frame(spark, rows)
    got = mix_sources(docs).collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((d, s, words(t)) for d, t, _, s in rows)
    size, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        most[r["source"]] = max(most[r["source"]], r["size"])
        assert r["taken"] == r["size"] * r["copies"] and r["copies"] in (0, 1, 2)
    want = targets(size)
    for r in got:
        assert r["source_size"] == size[r["source"]] and math.isclose(r["target"], want[r["source"]], abs_tol=1e-6)
    for s in want:
        assert abs(taken[s] - want[s]) <= most[s] / 2 + 1e-6
    again = mix_sources(docs).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_mixing_rates_are_kept_on_average(spark):
    """Every document of a source is as likely as any other to get the extra copy."""
    docs = frame(spark, [(i, "w " * (1 + i % 9), "en", "a" if i < 2000 else "b") for i in range(4000)])
    rows = [r for r in mix_sources(docs, weights=(1, 3)).collect() if r["source"] == "a"]
    rate = rows[0]["target"] / rows[0]["source_size"]
    for k in range(1, 10):
        own = [r["copies"] for r in rows if r["size"] == k]
        assert abs(sum(own) / len(own) - rate) < 0.12


def test_taken_rows_carry_their_columns(spark, odd, none):
    rows = take_mix(odd)
    assert rows.columns == odd.columns
    want = Counter()
    for r in mix_sources(odd).collect():
        want[(r["doc_id"], r["source"], r["size"])] += r["copies"]
    assert Counter((r["doc_id"], r["source"], words(r["text"])) for r in rows.collect()) == +want
    assert take_mix(none).count() == mix_sources(none).count() == 0


@pytest.mark.parametrize("rows", [ODD, real()])
def test_shards(spark, rows):
    got = assign_shards(frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, _, _ in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 40) and r["law"] == "key"
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def descend(spark, tree, n=40_000):
    return [r[0] for r in spark.range(n).select(shard_of(F.col("id"), tree)).collect()]


def test_shards_follow_weights_and_move_into_the_changed_subtree(spark):
    weights = [1.0, 2.0, 0.0, 3.0, 1.0, 1.0, 4.0, 2.0, 1.0, 1.0]
    before = descend(spark, weighted_tree(weights, racks=2, rack_shards=2))
    count = Counter(before)
    for i, w in enumerate(weights):
        assert abs(count[i] / 40_000 - w / sum(weights)) < 0.01
    more = [*weights[:6], 8.0, *weights[7:]]
    after = descend(spark, weighted_tree(more, racks=2, rack_shards=2))
    moved = [(a, b) for a, b in zip(before, after) if a != b]
    assert moved
    for a, b in moved:  # regions hold four shards, racks two
        assert b // 4 == 1
        assert a // 4 != 1 or b // 2 == 3
        assert a // 2 != 3 or b == 6


def test_layout_counts_and_growth_takes_rows_only_into_the_new_shard(spark):
    weights = [1.0] * 10
    before = descend(spark, weighted_tree(weights, racks=2, rack_shards=2))
    assert before != descend(spark, weighted_tree(weights, racks=3, rack_shards=3))
    after = descend(spark, weighted_tree([*weights, 2.0], racks=2, rack_shards=2, added=1))
    assert all(b in (a, 10) for a, b in zip(before, after))
    assert abs(after.count(10) / 40_000 - 2 / 12) < 0.01
    assert set(descend(spark, weighted_tree([0.0, 0.0, 1.0]), 50)) == {2}


def test_empty_tables(none):
    assert assign_shards(none).count() == exact_duplicates(none).count() == edited_fingerprints(none).count() == 0
    assert drop_exact_duplicates(none).count() == 0


@pytest.mark.parametrize("rows", [ODD, real(), [(i, "same" if i % 3 else f"t {i // 6}", "en", "a") for i in range(900)]])
def test_exact_duplicates(spark, rows):
    docs = frame(spark, rows)
    groups = defaultdict(list)
    for d, t, _, _ in rows:
        groups[SPACE.sub(" ", t or "")].append(d)
    want = Counter()
    for t, ids in groups.items():
        first = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(t.encode()).hexdigest()
        for k, d in enumerate(sorted(ids, key=lambda i: (i is None, i or 0))):
            want[(d, first, len(ids), k == 0, digest)] += 1
    got = exact_duplicates(docs)
    assert Counter(tuple(r) for r in got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == want
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def shingles(t):
    w = [x for x in SPACE.split(t) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


@pytest.mark.parametrize("rows", [ODD, real()])
def test_fingerprints(spark, rows):
    got = edited_fingerprints(frame(spark, rows)).collect()
    texts = defaultdict(list)
    for d, t, _, _ in rows:
        texts[d].append(t or "")
    order = sorted(texts, key=lambda d: (d is not None, d or 0))
    follower = {d: min(texts[order[(i + 1) % len(order)]]) for i, d in enumerate(order)}
    want, pairs = Counter(), {}
    for d, t, _, _ in rows:
        t = t or ""
        half = len(t) // 2
        e = t[:len(t) - half] + follower[d][:half]
        h = hashlib.sha256(e.encode()).hexdigest()
        want[(d, len(t), h)] += 1
        pairs[d, len(t), h] = (t, e)
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    prints, errors = {}, []
    for r in got:
        t, e = pairs[r["doc_id"], r["n_chars"], r["edited_sha256"]]
        for text, p in ((t, r["fingerprint"]), (e, r["edited_fingerprint"])):
            assert prints.setdefault(text, p) == p and len(p) == BINS * 2
        a, b = shingles(t), shingles(e)
        errors.append(r["near_edited"] - len(a & b) / len(a | b))
        assert 0 <= r["near_next"] <= 1
    assert max(map(abs, errors)) < 0.25 and abs(sum(errors) / len(errors)) < 0.03
