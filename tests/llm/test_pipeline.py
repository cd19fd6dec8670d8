"""Every stage of the pipeline over one small table, against plain Python."""

import re
from collections import Counter

import corpus_pipeline
import pytest
from llm_data import ODD, frame, real
from test_native import targets, words
from test_python import groups_of, sets_of

import __spark_entry__ as entry

EXTRA = [(5000, "!!! 123", "en", "src0"), (5001, None, None, None), (5002, real(1)[0][1].replace(" ", "  "), "fr", "src3")]


@pytest.mark.parametrize("rows", [real() + EXTRA, ODD])
def test_stages(spark, rows):
    docs, seen = frame(spark, rows), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "").cache()
        seen[name] = docs.collect()
    of = lambda name: [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in seen[name]]
    letters = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert Counter(of("language")) == Counter(letters)
    groups = {}
    for r in sorted(letters, key=lambda r: (r[0] is None, r[0] or 0)):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r[1]), r)
    assert Counter(of("exact_dedup")) == Counter(groups.values())
    left = of("exact_dedup")
    keep = Counter(min((d for d, _ in g), key=lambda d: (d is None, d or 0)) for g in groups_of(sets_of(left, 5)).values())
    assert Counter(r[0] for r in of("near_dedup")) == keep
    sizes = Counter()
    for r in of("near_dedup"):
        sizes[r[3]] += words(r[1])
    want, taken = targets(dict(sizes)), Counter()
    for r in of("mixing"):
        taken[r[3]] += words(r[1])
    longest = max(words(r[1]) for r in of("near_dedup"))
    assert all(abs(taken[s] - want[s]) <= longest / 2 + 1e-6 for s in want)
    assert max(Counter(of("mixing")).values()) <= 2 and set(of("mixing")) <= set(of("near_dedup"))
    assert Counter(r["doc_id"] for r in seen["packing"] if r["piece"] == 0) == Counter(r[0] for r in of("mixing"))


def test_entry_has_all_queries():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert "op7_exact_dedup" in entry.oracle_sql()
