"""Periodic runs, hard negatives and main text of pages against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from llm_data import LONG, ODD, frame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm import hard_negatives as hn
from skyloom.llm import queries
from skyloom.llm.hard_negatives import Block, hard_negatives
from skyloom.llm.html_extraction import Page, Weights, extract_main_text, learn_weights
from skyloom.llm.word_runs import Grammar, periodic_runs


# ---- periodic runs -------------------------------------------------------------------------------------------------

def plain_runs(words, least=24, periods=3):
    code = {}
    t = np.array([code.setdefault(w, len(code)) for w in words])
    found = {}
    for q in range(1, len(t) // periods + 1):
        step = np.diff(np.concatenate([[0], (t[:-q] == t[q:]).astype(int), [0]]))
        for s, e in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1)):
            if e + q - s >= max(least, periods * q):
                found.setdefault((int(s), int(e + q - s)), q)  # ascending periods: the smallest stays
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repeating_text(rng):
    words, k = [], rng.choice([1, 2, 3, 6])
    for _ in range(rng.randint(0, 6)):
        block = [f"w{rng.randrange(k)}" for _ in range(rng.randint(1, rng.choice([4, 40])))]
        kind = rng.randrange(3)
        if kind == 0:
            words += block
        elif kind == 1:
            words += (block * rng.randint(2, 9))[:rng.randint(1, 200)]
        else:
            words += (block * rng.randint(1, 5) + [f"w{rng.randrange(k)}"]) * rng.randint(1, 5)
    return words


def test_runs_equal_brute_force(spark):
    rng = random.Random(11)
    texts = [repeating_text(rng) for _ in range(400)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in periodic_runs(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert len(got) == len(rows)
    total = 0
    for i, words in enumerate(texts):
        want, r = plain_runs(words), got[i]
        assert [tuple(x) for x in r["runs"]] == want
        assert r["n_words"] == len(words) and r["collapsed"] == plain_collapsed(words, want)
        top = min(want, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        assert (tuple(r["longest"]) if r["longest"] else None) == top
        total += len(want)
    assert total > 300


def test_grammar_derives_its_texts():
    rng = random.Random(3)
    texts = [[rng.randrange(3) for _ in range(rng.randint(0, 90))] * rng.randint(1, 3) for _ in range(30)]
    sizes = np.array([len(t) for t in texts])
    starts = np.cumsum(sizes + 1) - sizes - 1
    words = np.zeros((sizes + 1).sum(), np.int64)
    for s, t in zip(starts, texts):
        words[s:s + len(t)] = t
    words[starts + sizes] = 3 + np.arange(len(texts))
    g = Grammar(words, starts, sizes)

    def spell(symbol):
        return [symbol] if symbol < g.terminals else spell(g.left[symbol]) + spell(g.right[symbol])

    assert [spell(x) for x in g.roots] == [t for t in texts if t]
    for symbol in range(g.terminals, len(g.left)):
        at, n = g.first[symbol], g.length[symbol]
        assert words[at:at + n].tolist() == spell(symbol)


def test_long_and_strange_texts_have_runs(spark):
    long = ("a " * 150_000) + "b " + ("c d e " * 40_000)
    rows = spark.createDataFrame([(1, long), (2, None), (3, " \t\n"), (None, "x " * 30), (5, "x " * 30), (5, "x " * 30)],
                                 "doc_id long, text string").withColumn("runs", F.lit(1)).withColumn("collapsed", F.lit("y"))
    got = sorted(periodic_runs(rows).collect(), key=lambda r: (r["doc_id"] or 0, r["n_words"]))
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 5, 5]
    assert [tuple(x) for x in got[1]["runs"]] == [(0, 150_000, 1), (150_001, 120_000, 3)]
    assert got[1]["collapsed"] == "a b c d e" and got[2]["n_words"] == 0 and got[2]["longest"] is None and got[2]["collapsed"] == ""
    assert [tuple(x) for x in got[0]["runs"]] == [(0, 30, 1)] and got[4] == got[5]
    assert periodic_runs(rows.where("false")).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(rows, least_words=10)


def test_run_query_matches_its_contract(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(repeating_text(rng) if i % 3 else [f"u{rng.randrange(400)}" for _ in range(300)])) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "é ü é " * 20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r.asDict() for r in queries.op12_word_runs(spark, str(tmp_path)).collect()}
    planted = 0
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            words = [words[i] if i < a else words[a + (i - a) % (1 + (n - a) // (3 + g % 8))] for i in range(n)]
            planted += 1
        runs = plain_runs(words)
        top = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None, None, None))
        want = {"doc_id": doc_id, "n_runs": len(runs), "start": top[0], "length": top[1], "period": top[2],
                "exponent_milli": 1000 * top[1] // top[2] if runs else None,
                "runs_sha256": hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
                "collapsed_sha256": hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()}
        assert got[doc_id] == want
    assert planted > 5 and len(got) == len(rows)


# ---- hard negatives ------------------------------------------------------------------------------------------------

def plain_negatives(rows, is_anchor, positives=5, negatives=3, low=50, high=95):
    """``rows``: (vec_id, label, whole numbers); ids are distinct and not null."""
    out = []
    for i, (a, label, v) in enumerate(rows):
        if not is_anchor(a):
            continue
        dot = [(-sum(x * y for x, y in zip(v, w)), b, other) for j, (b, other, w) in enumerate(rows) if j != i]
        for p, pid, _ in sorted(d for d in dot if d[2] == label)[:positives]:
            some = sorted(d for d in dot if d[2] != label and low * -p <= 100 * -d[0] <= high * -p)[:negatives]
            out += [(a, pid, k, nid, -p, -n) for k, (n, nid, _) in enumerate(some, 1)]
    return sorted(out)


def vectors(seed, n, dim=12, clusters=6, size=3000):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(clusters, dim))
    v = centre[rng.integers(clusters, size=n)] + rng.normal(size=(n, dim)) * rng.choice([0.1, 1.0], (n, 1))
    v *= rng.choice([1, 1, 3], (n, 1))
    return (v * size / 10).astype(np.int64).tolist(), rng.integers(4, size=n).tolist()


@pytest.mark.parametrize("rows_per_block", [40, 100_000])
def test_negatives_equal_brute_force(spark, monkeypatch, rows_per_block):
    monkeypatch.setattr(hn, "LEAST_BLOCK", rows_per_block)
    v, label = vectors(1, 700)
    v[5], v[6] = [0] * 12, v[7]
    label = [0 if i % 3 == 0 else x for i, x in enumerate(label)]  # a hot label
    v[200:420] = [v[200]] * 220  # a hot vector
    rows = list(zip(range(700), label, v))
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>").repartition(5)
    got = hard_negatives(df, F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())) \
        == plain_negatives(rows, lambda a: a % 20 == 0)


def test_bounds_hold_and_narrow():
    import pyarrow as pa
    v, label = vectors(2, 500, clusters=12)
    v[3], v[4] = [0] * 12, [x * 1000 for x in v[9]]
    references = np.asarray(v[:8], float) / np.linalg.norm(np.asarray(v[:8], float), axis=1, keepdims=True).clip(1)
    references = references[np.linalg.norm(references, axis=1) > 0]
    norm, theta = hn.angles(np.asarray(v), references)
    block = Block(pa.table({"key": pa.array(range(500)), "vec_id": pa.array(range(500)), "label": pa.array(label, pa.int64()), "norm": norm,
                            "theta": pa.array(theta.astype(np.float32).tolist()), "vector": v}))
    left_out = 0
    for i in range(0, 500, 10):
        low, high = block.bounds(slice(0, 500), norm[i], theta[i])
        score = block.vectors @ np.asarray(v[i])
        assert (low <= score).all() and (score <= high).all()
        left_out += int((high < np.quantile(score, 0.99)).sum())
    assert left_out > 2500


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [3, 4]), (1, 1, [3, 4]), (2, 2, [2, 2]), (None, 2, [2, 2]), (3, None, [1, 1]), (4, 2, None), (5, 2, [None, 1]),
            (6, 1, [3]), (0, 1, [3, 4]), (50, 7, [5, 5])]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>").withColumn("anchor", F.lit("x")).withColumn("block", F.lit(9))
    got = sorted(tuple(r) for r in hard_negatives(df, F.col("vec_id") % 50 == 0, negatives=5).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    # Rows with id 0 are positives of each other, of score 25; 14 is in the window. The window of the short vector's 9 is empty.
    assert Counter(g[:2] for g in got) == {(0, 0): 4, (0, 1): 4}
    assert {g[2:] for g in got} == {(1, 2, 25, 14), (2, None, 25, 14)}
    assert hard_negatives(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0
    floats = spark.createDataFrame([(0, 1, [0.5, nan]), (7, 1, [inf, 0.0]), (50, 1, [1.0, None]), (100, 2, None)],
                                   "vec_id long, label int, embedding array<float>")
    import tempfile
    with tempfile.TemporaryDirectory() as folder:
        floats.write.parquet(f"{folder}/embeddings.parquet")
        assert queries.op13_hard_negatives(spark, folder).count() == 0


# ---- main text -----------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/x>Menu</a></ul></nav>
<div class="cookie-notice">We use <b>cookies</b>.</div>
<article><h1>The   title</h1><!-- ad --><p>First <b>bo</b>ld par&aacute;graph&nbsp;with &lt;tags&gt;.<br>Second line
<p>Unclosed <i>one</p><div class="ad-slot">Buy!</div><form><p>Name <input></form>
<ul><li>item one<li>item <a href='y'>two</a></ul><aside>Aside</aside><p>x</p>
<section id="comments"><article class="c">Nice comment</article></section></article>
<div class="sidebar"><p>Side</div><footer>&copy; 2020</footer><script>unclosed <p>text"""
TEXT = "The title First bold parágraph with <tags>. Second line Unclosed one item one item two x"


def test_page_without_its_surroundings(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (4, "w", "<p>"), (5, "w", "plain words of a page without a tag"),
            (6, "x", "<form><main><p>Wrapped in a form.</main></form>"), (7, "y", "<article>" + LONG + "</article>"),
            (8, "z", "<p it's>a < b and <<b>c</b> &#x41;&unknown; <a href=\"un>closed</p>"), (9, "q", "<" * 30_000 + "'\"" * 3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("score", F.lit("s"))
    got = [(r["page_id"], r["url"], r["text"]) for r in extract_main_text(df).collect()]
    text = {g[0]: g[2] for g in got}
    assert len(got) == len(rows) and text[1] == TEXT and Counter(g[0] for g in got)[1] == 2
    assert text[2] == text[None] == text[4] == "" and text[5] == "plain words of a page without a tag"
    assert text[6] == "Wrapped in a form." and text[7] == " ".join(LONG.split())
    assert text[8].startswith("a < b and <")
    assert extract_main_text(df.where("false")).count() == 0


def test_regions_have_the_greatest_sum():
    rng = random.Random(2)
    for _ in range(300):
        source = "".join(rng.choice(["<p>one two", "</p>", "<div>", "</div>", "<a>link</a>", "<li>", " word", "<h1>a b c d e f</h1>"]) for _ in range(rng.randint(0, 25)))
        page, weights = Page(source), Weights({})
        text, score = page.main_text(weights)
        values = [weights.score(f, 0) * abs(t[1]) for f, t in zip(page.features(), page.tokens)]
        sums = [sum(values[a:b]) for a in range(len(values)) for b in range(a + 1, len(values) + 1)]
        assert score == pytest.approx(max([0, *sums]))
        if score == 0:
            assert text == ""


def test_real_pages_give_their_articles_without_and_with_marks(spark):
    """Marked articles come out whole; without any mark, learned weights still find most words."""
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist()

    def truth(source):
        inner = re.search(r"<article>(.*?)</article>", source, re.S)[1]
        blocks = [re.sub(r"<[^>]*>", "", b) for b in re.split(r"</?(?:p|h1|br)>", inner)]
        import html
        return " ".join(" ".join(html.unescape(b).split()) for b in blocks if b.strip())

    df = spark.createDataFrame([(p["page_id"], p["url"], p["html"]) for p in pages], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract_main_text(df).collect()}
    assert got == {p["page_id"]: truth(p["html"]) for p in pages}
    weights = learn_weights(df)
    assert weights.score("link 0", 0) < 0 < weights.score("word 5", 0) and weights.score("tag li", 0) < weights.score("tag p", 0) < 0
    right = both = 0
    for p in pages:
        bare = re.sub(r"<(/?)(article|nav|footer)>", r"<\1div>", p["html"]).replace('class="ad"', "")
        have, want = Counter(Page(bare).main_text(weights)[0].split()), Counter(truth(p["html"]).split())
        right, both = right + 2 * sum((have & want).values()), both + sum(have.values()) + sum(want.values())
    assert right / both > 0.9


def test_new_operators_take_the_odd_table(odd, none):
    assert periodic_runs(odd).count() == len(ODD) and periodic_runs(none).count() == 0
