"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive and tags negative, and the contiguous region with the
greatest sum is the content: one linear scan finds it. The weights are log-odds from labelled pages: pages that mark one
article themselves, whose words and tags inside it are compared with those outside. A word is described by whether it
is link text, by the length of its block and, on pages that mark an article, by lying in it; a tag by its name. A tag never scores above
``TAG_AT_MOST`` and a word that is no link text and not outside a marked article never below ``WORD_AT_LEAST``.

What is no content wherever it stands takes no part in the scan and leaves the text: the elements ``DROPPED`` and elements
whose class, id or role names one of ``NOTICES``, with all that they hold. Where such an element holds the page's only
article it is a wrapper and stays.

The region's text is decoded, white space inside a block becomes one space, and blocks are joined by one space.
Results:

* null, empty or text-free html: empty text, score 0; a region needs a positive sum, otherwise the text is empty
* ties: the first region with the greatest sum, and of these the shortest
* broken markup: unclosed elements end with their parent, stray end tags and comments are passed over, an unclosed script
  holds the rest of the page
* null ids and urls are kept; repeated pages are separate rows; an empty table gives an empty result
* other columns are not read; without a labelled page fixed weights are used

Memory follows one page. Weights are learned from about ``sample_pages`` labelled pages, drawn by hash.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import slices

TAG_AT_MOST = -0.1
WORD_AT_LEAST = 0.1
SAMPLE_PAGES = 2_000

# Names of HTML elements, and words by which pages name what is no content.
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark nobr q rp rt ruby s samp "
             "small span strike strong sub sup time tt u var wbr".split())
BLOCK = set("address article aside blockquote body br button canvas caption center col colgroup dd details dialog dir div dl dt "
            "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav object ol "
            "option p pre section select summary svg table tbody td template tfoot th thead tr ul video audio".split())
DROPPED = set("nav header footer aside form menu dialog template svg canvas select button object audio video dir".split())
SIBLINGS = set("li dt dd tr td th option".split())
NOTICES = set("""
ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox banner sponsor sponsored sponsors promo promos
promoted promotion nav navbar navigation menu menus submenu breadcrumb breadcrumbs topbar toolbar pagination pager sidebar sidebars
aside rail widget widgets related recommended recommendations trending popular share sharing social follow newsletter subscribe
subscription signup signin login search searchbox header masthead footer colophon copyright cookie cookies consent gdpr notice notices
alert alertdialog popup modal overlay toast disclaimer paywall skip comment comments reply replies respond disqus discussion form
complementary contentinfo dialog menubar hidden
""".split())
HEADLINES = set("article entry post story content title".split())
WRAPPERS = set("has with no without js layout".split())

TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*(?:"[^"]*"|'[^']*')|=)*+)>|<[!?/][^>]*>""", re.S)
NAMES = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
LENGTHS = (2, 5, 10, 20, 40)


def named_away(attributes: str) -> tuple[bool, bool]:
    """Whether the attributes name no content, and whether they name the main part of a page."""
    away = main = False
    for name, a, b, c in NAMES.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "role":
            main |= value.lower() in ("main", "article")
        if name in ("hidden", "aria-hidden"):
            away |= name == "hidden" or value.lower() == "true"
        elif name == "style":
            away |= bool(UNSEEN.search(value))
        else:
            for label in value.split():
                words = {w.lower() for w in PART.findall(label)}
                if words & WRAPPERS:
                    continue
                hits = words & NOTICES
                away |= bool(hits) and not (hits == {"header"} and words & HEADLINES)
    return away, main


class Page:
    """Words and tags of a page in order.

    ``tokens`` are (block, words, text or tag name, linked); a tag has -1 words. ``spans`` are the stretches of dropped
    elements, ``zone`` is that of the marked article, or None.
    """

    def __init__(self, source: str) -> None:
        self.tokens: list[tuple[int, int, str, bool]] = []
        self.away: list[tuple[int, int]] = []
        self.articles: list[tuple[int, int]] = []
        self.block = 0
        self._parse(source)
        self.lengths = Counter()
        for block, words, _, _ in self.tokens:
            if words > 0:
                self.lengths[block] += words
        self._place()

    def _text(self, text: str, linked: bool) -> None:
        if text:
            if "&" in text:
                text = html.unescape(text)
            self.tokens.append((self.block, len(text.split()), text, linked))

    def _parse(self, source: str) -> None:
        stack: list[tuple[str, int, bool, bool]] = []
        depth: Counter[str] = Counter()

        def close() -> None:
            name, start, away, main = stack.pop()
            depth[name] -= 1
            if away:
                self.away.append((start, len(self.tokens)))
            if main:
                self.articles.append((start, len(self.tokens)))

        def close_to(name: str) -> None:
            while stack:
                done = stack[-1][0] == name
                close()
                if done:
                    break

        at = 0
        while (found := TAG.search(source, at)) is not None:
            self._text(source[at:found.start()], depth["a"] > 0)
            at, name = found.end(), (found[2] or "").lower()
            if not name:
                continue
            if found[1]:
                if name in INLINE:
                    for i in range(len(stack) - 1, -1, -1) if depth[name] else ():
                        if stack[i][0] == name:
                            close_to(name)
                            break
                        if stack[i][0] in BLOCK:
                            break
                elif depth[name]:
                    close_to(name)
            elif name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at)
                if end is None:
                    at = len(source)
                else:
                    at = source.find(">", end.end())
                    at = len(source) if at < 0 else at + 1
            else:
                if name in BLOCK and depth["p"] and name != "br":
                    close_to("p")
                if name == "a" and depth["a"] and stack[-1][0] == "a" or name in SIBLINGS and stack and stack[-1][0] == name:
                    close()
                if name not in VOID:
                    away, main = named_away(found[3]) if found[3] else (False, False)
                    root = name in ("html", "body", "article", "main") and name != "article"
                    stack.append((name, len(self.tokens), (away and not root) or name in DROPPED, main or name in ("article", "main")))
                    depth[name] += 1
            if name in BLOCK or name in RAW and name not in ("script", "style", "noscript", "iframe"):
                self.block += 1
            self.tokens.append((self.block, -1, name, False))
        self._text(source[at:], depth["a"] > 0)
        while stack:
            close()

    def _place(self) -> None:
        n = len(self.tokens)
        spoken = [0]
        for _, words, _, linked in self.tokens:
            spoken.append(spoken[-1] + (words if words > 0 and not linked else 0))

        def within(span: tuple[int, int], spans: list[tuple[int, int]]) -> bool:
            return any(a <= span[0] and span[1] <= b for a, b in spans)

        outermost: list[tuple[int, int]] = []
        for span in sorted(self.away, key=lambda s: (s[0], -s[1])):
            if not outermost or span[0] >= outermost[-1][1]:
                outermost.append(span)
        free = [a for a in self.articles if not within(a, outermost)]
        if not free and self.articles:
            # The only article lies in dropped elements: the widest of those that hold most of the page's words are wrappers.
            most = max(self.articles, key=lambda a: spoken[a[1]] - spoken[a[0]])
            if 2 * (spoken[most[1]] - spoken[most[0]]) > spoken[-1]:
                self.away = [s for s in self.away if not (s[0] <= most[0] and most[1] <= s[1] and s != most)]
                free = [a for a in self.articles if not within(a, self.away)]
        elif not self.articles:
            self.away = [s for s in self.away if 2 * (spoken[s[1]] - spoken[s[0]]) <= spoken[-1] or s[1] - s[0] < n // 2]
        self.dropped = bytearray(n)
        reach = 0
        for a, b in sorted(self.away):
            a = max(a, reach)
            if a < b:
                self.dropped[a:b] = b"\1" * (b - a)
                reach = b
        self.zone = None
        if free:
            size = lambda s: spoken[s[1]] - spoken[s[0]]
            best = max(free, key=lambda s: (size(s), s[0] - s[1]))
            inner = [s for s in free if best[0] <= s[0] and s[1] <= best[1] and 2 * size(s) >= size(best)]
            self.zone = min(inner, key=lambda s: (s[1] - s[0], s))
        self.labelled = len(free) == 1

    def features(self) -> list[str]:
        """The description of every token without the article mark."""
        out = []
        for block, words, name, linked in self.tokens:
            if words < 0:
                out.append(f"tag {name}" if name in BLOCK or name in INLINE or name in RAW else "tag other")
            else:
                length = self.lengths[block]
                out.append(f"{'link' if linked else 'word'} {sum(length > x for x in LENGTHS)}")
        return out

    def counts(self, total: Counter[tuple[str, bool]]) -> None:
        """Adds what lies inside and outside the article of a labelled page."""
        if self.labelled:
            a, b = self.zone
            for i, (feature, token) in enumerate(zip(self.features(), self.tokens)):
                total[feature, a <= i < b and not self.dropped[i]] += 1 if token[1] < 0 else token[1]

    def main_text(self, weights: Weights) -> tuple[str, float]:
        best, start, stop, run, since = 0.0, 0, 0, 0.0, 0
        zone = self.zone
        for i, (feature, token) in enumerate(zip(self.features(), self.tokens)):
            if self.dropped[i] or not token[1]:
                continue
            where = 0 if zone is None else 1 if zone[0] <= i < zone[1] else -1
            run += weights.score(feature, where) * abs(token[1])
            if run <= 0:
                run, since = 0.0, i + 1
            elif run > best:
                best, start, stop = run, since, i + 1
        blocks: list[str] = []
        pieces: list[str] = []
        block = None
        for i in range(start, stop):
            number, words, text, _ = self.tokens[i]
            if words < 0 or self.dropped[i]:
                continue
            if number != block and pieces:
                blocks.append("".join(pieces))
                pieces = []
            block = number
            pieces.append(text)
        blocks.append("".join(pieces))
        return " ".join(" ".join(b.split()) for b in blocks if b.strip()), best


class Weights:
    """Log-odds of a token inside against outside the article."""

    def __init__(self, counts: dict[tuple[str, bool], int]) -> None:
        self.known: dict[tuple[str, int], float] = {}
        self.counts = counts
        self.totals = {(kind, inside): sum(n for (f, i), n in counts.items() if i == inside and f.startswith("tag") == kind)
                       for kind in (False, True) for inside in (False, True)}

    def score(self, feature: str, zone: int) -> float:
        """``zone``: 1 in the marked article, -1 outside it, 0 on a page without one."""
        value = self.known.get((feature, zone))
        if value is None:
            value = self.known[feature, zone] = self._score(feature, zone)
        return value

    def _score(self, feature: str, zone: int) -> float:
        tag = feature.startswith("tag")
        inside, outside = self.totals[tag, True], self.totals[tag, False]
        if not inside or not outside:
            value, certain = -3.0 if tag else -2.0 if feature.startswith("link") else 1.0, 10.0
        else:
            kinds = len({f for f, _ in self.counts if f.startswith("tag") == tag})
            share = lambda n, total: (n + 1) / (total + kinds)
            value = math.log(share(self.counts.get((feature, True), 0), inside) / share(self.counts.get((feature, False), 0), outside))
            certain = math.log(max(inside, outside) + 2)
        if zone:
            # In the labelled pages every word inside the article has this mark and none outside.
            value = max(value + certain, 1.0) if zone > 0 else min(value - certain, -1.0)
        if tag:
            return min(value, TAG_AT_MOST)
        return max(value, WORD_AT_LEAST) if zone >= 0 and feature.startswith("word") else value


def learn_weights(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Weights:
    """Weights from about ``sample_pages`` pages that mark one article."""
    marked = pages.where(F.col("html").rlike("(?i)<(article|main)[\\s>]")).select("html", F.xxhash64("page_id", "url").alias("h"))
    count = marked.count()
    if count > sample_pages:
        marked = marked.where(F.pmod("h", F.lit(count)) < sample_pages)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[tuple[str, bool]] = Counter()
        for batch in batches:
            for source in batch.column("html").to_pylist():
                Page(source or "").counts(total)
        yield pa.RecordBatch.from_pydict({"feature": pa.array([f for f, _ in total], pa.string()), "inside": pa.array([i for _, i in total], pa.bool_()),
                                          "n": pa.array(list(total.values()), pa.int64())})

    # One row per name of a known element or kind of word, inside and outside.
    rows = marked.select("html").mapInArrow(add, "feature string, inside boolean, n long").groupBy("feature", "inside").agg(F.sum("n").alias("n"))
    return Weights({(r["feature"], r["inside"]): r["n"] for r in rows.collect()})


def extract_main_text(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``score`` (the region's sum) for every row of ``pages``."""
    weights = weights or learn_weights(pages)
    schema = pages.select("page_id", "url").schema.simpleString()[7:-1]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "html"):
            done = [Page(source or "").main_text(weights) for source in rows.column("html").to_pylist()]
            yield pa.RecordBatch.from_pydict({"page_id": rows.column("page_id"), "url": rows.column("url"),
                                              "text": pa.array([t for t, _ in done], pa.string()), "score": pa.array([s for _, s in done], pa.float64())})

    return pages.select("page_id", "url", "html").mapInArrow(scan, f"{schema}, text string, score double")
