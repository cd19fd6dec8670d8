"""Periodic runs of words, found on a grammar of the texts.

The word ids of a batch of texts are compressed by Re-Pair. A round replaces every pair of symbols that outranks the
pairs it overlaps; the most frequent pair always does, so it is replaced wherever it occurs, and others that do not
touch it are replaced in the same round. What is left of a text becomes a balanced tree over its symbols. A run of
period q lies in the expansion of some symbol and crosses the boundary between its two parts, so runs are computed at
that boundary, once for every symbol whatever the number of its occurrences. They are then carried to all positions
at which the symbol is derived, and intervals inside an interval of the same period are merged into it.

At a boundary a run of three periods shows one of three signs: the period before the boundary equals the one after
it, or the two periods after it are equal, or the two before it. Each sign is an equal pair of stretches at distance
q, looked up in tables that name equal stretches of 2^k words; a length is then extended by the same tables.
Stretches that occur once get no name, so the tables of ordinary text end after a few levels.

Memory follows the longest text of a task, about 16 bytes per word and named level. Results:

* null text: no words, no runs, collapsed text empty; a text without words likewise
* a null id is kept; repeated rows are separate documents with equal results
* an empty table gives an empty result; other columns are not read
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import slices

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("longest", RUN), ("collapsed", pa.string())])
SPARK_SCHEMA = ("doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
                "longest struct<start:long,length:long,period:long>, collapsed string")

Order = Callable[[int | None, int], np.ndarray | None]


class Grammar:
    """Re-Pair rules over ``words``; ``starts`` and ``sizes`` give the stretch of each text.

    Symbols below ``self.terminals`` are words. For the others ``left``, ``right``, ``length`` and ``first`` (a position
    at which it is derived) hold the rule; ``rounds`` are slices of symbols whose parts are all older; ``roots`` is one
    symbol per text that has words.
    """

    def __init__(self, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        self.terminals = int(words.max()) + 1 if len(words) else 0
        self.left, self.right, self.first = (np.full(self.terminals, -1, np.int64) for _ in range(3))
        self.length = np.ones(self.terminals, np.int64)
        self.rounds: list[slice] = []
        inside = np.ones(len(words), bool)
        inside[starts + sizes] = False
        at = np.flatnonzero(inside)
        symbols, at = self._replace_pairs(words[at], at)
        self._join(symbols, at, starts, sizes)

    def _add(self, left: np.ndarray, right: np.ndarray, first: np.ndarray) -> np.ndarray:
        new = np.arange(len(left)) + len(self.left)
        self.rounds.append(slice(len(self.left), len(self.left) + len(left)))
        self.length = np.concatenate([self.length, self.length[left] + self.length[right]])
        self.left, self.right = np.concatenate([self.left, left]), np.concatenate([self.right, right])
        self.first = np.concatenate([self.first, first])
        return new

    def _replace_pairs(self, symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        done: list[tuple[np.ndarray, np.ndarray]] = []
        chance = np.random.default_rng(0)
        while len(symbols) > 1:
            meets = at[:-1] + self.length[symbols[:-1]] == at[1:]
            pair = np.where(meets, symbols[:-1] * len(self.left) + symbols[1:], -1)
            code, kinds = pd.factorize(pair)
            # Equal pairs in a row overlap (a a a): every second one can be replaced.
            begins = np.ones(len(pair), bool)
            begins[1:] = pair[1:] != pair[:-1]
            group = np.cumsum(begins) - 1
            head = np.flatnonzero(begins)
            usable = ((np.arange(len(pair)) - head[group]) % 2 == 0) & meets
            count = np.bincount(code[usable], minlength=len(kinds))
            count[kinds == -1] = 0
            if count.max() < 2:
                break
            # Ties in random order: in text order a repeated passage would lose one pair a round.
            mixed = chance.permutation(len(kinds))
            rank = np.empty(len(kinds), np.int64)
            rank[mixed[np.argsort(count[mixed], kind="stable")]] = np.arange(len(kinds))
            rank[count < 2] = -1
            worth = rank[code]
            tail = np.append(head[1:], len(pair)) - 1
            own = worth[head]
            before = np.where(head > 0, worth[head - 1], -1)
            after = np.where(tail + 1 < len(pair), worth[np.minimum(tail + 1, len(pair) - 1)], -1)
            best = (own >= 0) & (own > before) & (own > after)
            taken = np.flatnonzero(usable & best[group])
            often = np.bincount(code[taken], minlength=len(kinds)) >= 2
            taken = taken[often[code[taken]]]
            which, place = np.unique(code[taken], return_index=True)
            new = self._add(symbols[taken[place]], symbols[taken[place] + 1], at[taken[place]])
            number = np.empty(len(kinds), np.int64)
            number[which] = new
            # A symbol whose pairs both occur once stays as it is: a pair with a newer symbol is not more frequent.
            open_pair = worth >= 0
            open_symbol = np.zeros(len(symbols), bool)
            open_symbol[:-1] |= open_pair
            open_symbol[1:] |= open_pair
            symbols = symbols.copy()
            symbols[taken] = number[code[taken]]
            stays = np.ones(len(symbols), bool)
            stays[taken + 1] = False
            closed = stays & ~open_symbol
            done.append((symbols[closed], at[closed]))
            stays &= open_symbol
            symbols, at = symbols[stays], at[stays]
        done.append((symbols, at))
        symbols, at = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(at, kind="stable")
        return symbols[order], at[order]

    def _join(self, symbols: np.ndarray, at: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        """Neighbours of one text are joined until one symbol is left of it."""
        text = np.searchsorted(starts + sizes, at, side="right")
        while len(symbols):
            begins = np.ones(len(text), bool)
            begins[1:] = text[1:] != text[:-1]
            head = np.flatnonzero(begins)
            odd = (np.arange(len(text)) - head[np.cumsum(begins) - 1]) % 2 == 1
            right = np.flatnonzero(odd)
            if not len(right):
                break
            symbols = symbols.copy()
            symbols[right - 1] = self._add(symbols[right - 1], symbols[right], at[right - 1])
            symbols, at, text = symbols[~odd], at[~odd], text[~odd]
        self.roots, self.root_at = symbols, at


class Stretches:
    """Names of equal stretches of 2^k words; a stretch that occurs once has the name -1."""

    def __init__(self, words: np.ndarray) -> None:
        self.n = len(words)
        self.names: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []
        at, key, k = np.arange(self.n), words, 0
        while len(at):
            order = np.argsort(key, kind="stable")
            key, at = key[order], at[order]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            name = np.cumsum(new) - 1
            repeated = (np.bincount(name) > 1)[name]
            at, name = at[repeated], name[repeated]
            if not len(at):
                break
            names = np.full(self.n, -1, np.int64)
            names[at] = name
            self.names.append(names)
            self.keys.append(name * self.n + at)
            at = np.sort(at)
            at = at[at + (1 << k) < self.n]
            second = names[at + (1 << k)]
            at, second = at[second >= 0], second[second >= 0]
            key, k = names[at] * self.n + second, k + 1

    def _same(self, k: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        name = self.names[k].take(i, mode="clip")
        return (name >= 0) & (name == self.names[k].take(j, mode="clip"))

    def ahead(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How far the words from i and from j > i agree, j staying below ``limit``."""
        length = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            step = 1 << k
            length += step * ((j + length + step <= limit) & self._same(k, i + length, j + length))
        return length

    def back(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How far the words before i < j and before j agree, i staying at or above ``limit``."""
        length = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            step = 1 << k
            length += step * ((i - length - step >= limit) & self._same(k, i - length - step, j - length - step))
        return length

    def near(self, k: int, at: np.ndarray, least: np.ndarray, most: np.ndarray, sign: int) -> np.ndarray:
        """The least distance in ``least..most`` at which the stretch of level k at ``at`` occurs again, or -1."""
        name, keys = self.names[k][at], self.keys[k]
        if sign > 0:
            where = np.searchsorted(keys, name * self.n + at + least)
            found = keys[np.minimum(where, len(keys) - 1)]
            ok = where < len(keys)
        else:
            where = np.searchsorted(keys, name * self.n + at - least, side="right") - 1
            found = keys[np.maximum(where, 0)]
            ok = where >= 0
        ok &= (name >= 0) & (found // self.n == name)
        distance = (found % self.n - at) * sign
        return np.where(ok & (distance >= least) & (distance <= most), distance, -1)


class Boundaries:
    """Runs that cross the boundary of a symbol, for all symbols at once."""

    SMALL = 8  # periods below it are tried one by one; they need 12 words on one side

    def __init__(self, table: Stretches, low: np.ndarray, mid: np.ndarray, high: np.ndarray, words: int, periods: int) -> None:
        self.table, self.low, self.mid, self.high = table, low, mid, high
        self.words, self.periods = words, periods
        n = len(low)
        self.q0, self.s0, self.e0 = np.ones(n, np.int64), mid.copy(), mid.copy()
        self.found: list[tuple[np.ndarray, ...]] = []

    def check(self, node: np.ndarray, q: np.ndarray, at: np.ndarray) -> None:
        """The stretch of period ``q`` that holds the equal stretches at ``at`` and ``at + q``."""
        low, high, mid = self.low[node], self.high[node], self.mid[node]
        start = at - self.table.back(at, at + q, low)
        end = at + q + self.table.ahead(at, at + q, high)
        run = (end - start >= np.maximum(self.words, self.periods * q)) & (start < mid) & (mid < end)
        self.found.append((node[run], start[run], end[run], q[run]))
        wider = (end - start >= 2 * q) & (start <= mid) & (mid <= end) & (end - start - q > self.e0[node] - self.s0[node] - self.q0[node])
        hit = node[wider]
        self.q0[hit], self.s0[hit], self.e0[hit] = q[wider], start[wider], end[wider]

    def skip(self, node: np.ndarray, q: np.ndarray, kind: str) -> np.ndarray:
        """Past distances that are only multiples of a period already known around the boundary (Fine and Wilf)."""
        q0, s0, e0, mid = self.q0[node], self.s0[node], self.e0[node], self.mid[node]
        if kind == "after":
            last = e0 - mid - q0
        elif kind == "before":
            last = mid - s0 - q0
        else:
            last = np.where(np.minimum(mid - s0, e0 - mid) >= q0, e0 - s0 - q0, -1)
        return np.where((q >= q0 + 1) & (q <= last), last + 1, q)

    def small(self) -> None:
        k = 2
        if len(self.table.names) <= k:
            return
        for q in range(1, self.SMALL):
            for base, sign in ((self.mid, 1), (self.mid - (1 << k), -1)):
                node = np.flatnonzero((base >= self.low) & (base + (1 << k) <= self.high))
                node = node[self.table._same(k, base[node], base[node] + sign * q)]
                at = base[node] if sign > 0 else self.mid[node] - q
                inside = (at >= self.low[node]) & (at + q <= self.high[node])
                self.check(node[inside], np.full(inside.sum(), q, np.int64), at[inside])

    def large(self, k: int) -> None:
        """Periods of 2^k .. 2^(k+1) - 1 words."""
        step = 1 << k
        room = (self.high - self.low) // self.periods
        for kind, base, sign in (("across", self.mid, -1), ("after", self.mid, 1), ("before", self.mid - step, -1)):
            node = np.flatnonzero((room >= step) & (base >= self.low) & (base + step <= self.high))
            node = node[self.table.names[k][base[node]] >= 0]
            q = np.full(len(node), step, np.int64)
            while len(node):
                q = self.skip(node, q, kind)
                q = self.table.near(k, base[node], q, np.minimum(2 * step - 1, room[node]), sign)
                node, q = node[q > 0], q[q > 0]
                at = self.mid[node] if sign > 0 else self.mid[node] - q
                inside = (at >= self.low[node]) & (at + q <= self.high[node])
                self.check(node[inside], q[inside], at[inside])
                following = self.table.near(k, base[node], q + 1, np.minimum(2 * step - 1, room[node]), sign)
                more = following > 0
                node, q, following = node[more], q[more], following[more]
                tight = following - q <= step // 2
                following[tight] = self.leave(node[tight], q[tight], (following - q)[tight], kind, step)
                q = following

    def leave(self, node: np.ndarray, q: np.ndarray, d: np.ndarray, kind: str, step: int) -> np.ndarray:
        """The next distance to try where occurrences are ``d`` apart, so that both ends lie in stretches of period d.

        Two such stretches agree up to the end of the shorter one, too little for a run, unless their ends fall together;
        that happens once. The distances before it, or all that are left in the stretch, are passed over.
        """
        mid, low, high = self.mid[node], self.low[node], self.high[node]
        there = mid + q if kind == "after" else mid - q
        if kind == "before":
            own = d + self.table.back(mid - d, mid, low)
            other = d + self.table.back(there - d, there, low)
        else:
            own = d + self.table.ahead(mid, mid + d, high)
            other = d + self.table.ahead(there, there + d, high)
        if kind == "across":
            apart = there + other < mid
            past = q + self.table.back(there, there + d, low) + 1
            jump = np.where(other < own, q + own - other, np.where(other > own, past, q + 1))
        else:
            apart = q > own
            jump = np.where(other > own, q + other - own, np.where(other < own, q + other - step + 1, q + 1))
        return np.maximum(np.where(apart, jump, q + 1), q + 1)

    def runs(self) -> tuple[np.ndarray, ...]:
        """(symbol's row, start, end, period) of all runs."""
        if len(self.mid):
            self.small()
            for k in range(3, len(self.table.names)):
                self.large(k)
        if not self.found:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        return tuple(np.concatenate(x) for x in zip(*self.found))


def maximal(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals inside another of the same period go, then those whose period is a multiple of a shorter one."""
    if not len(start):
        return start, end, period
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    span = int(end.max()) + 1
    reach = np.maximum.accumulate(period * span + end)
    keep = np.ones(len(start), bool)
    keep[1:] = period[1:] * span + end[1:] > reach[:-1]
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[keep], end[keep], period[keep]


def runs_of(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, least_words: int, least_periods: int) -> tuple[np.ndarray, ...]:
    """(start, end, period) of the runs of all texts, ordered by start, then period.

    ``words`` holds the texts one after the other, each followed by an id of its own that occurs once.
    """
    grammar = Grammar(words, starts, sizes)
    n = grammar.terminals
    node = np.arange(n, len(grammar.left))
    node = node[grammar.length[node] >= least_words]
    low = grammar.first[node]
    mid = low + grammar.length[grammar.left[node]]
    row, s, e, q = Boundaries(Stretches(words), low, mid, low + grammar.length[node], least_words, least_periods).runs()
    if not len(row):
        return s, e, q
    # Runs relative to their symbol, ordered by symbol; of equal stretches the one with the smallest period is the run.
    order = np.lexsort((q, e, s, row))
    own = np.stack([node[row], s - low[row], e - low[row], q], 1)[order]
    own = own[np.append(True, (own[1:, :3] != own[:-1, :3]).any(1))]
    has = np.zeros(len(grammar.left), bool)
    has[own[:, 0]] = True
    for part in grammar.rounds:
        has[part] |= has[grammar.left[part]] | has[grammar.right[part]]
    first = np.searchsorted(own[:, 0], np.arange(len(grammar.left) + 1))
    symbol, at = grammar.roots, grammar.root_at
    found = []
    while True:
        some = has[symbol]
        symbol, at = symbol[some], at[some]
        if not len(symbol):
            break
        many = first[symbol + 1] - first[symbol]
        which = np.repeat(first[symbol], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        base = np.repeat(at, many)
        found.append((base + own[which, 1], base + own[which, 2], own[which, 3]))
        inner = symbol >= n
        symbol, at = symbol[inner], at[inner]
        left, right = grammar.left[symbol], grammar.right[symbol]
        symbol, at = np.concatenate([left, right]), np.concatenate([at, at + grammar.length[left]])
    return maximal(*(np.concatenate(x) for x in zip(*found)))


def batch_runs(rows: pa.RecordBatch, least_words: int, least_periods: int, order: Order | None) -> pa.RecordBatch:
    ids = rows.column("doc_id").to_pylist()
    texts = [(t or b"").split() for t in rows.column("text").to_pylist()]
    if order is not None:
        for i, (doc_id, text) in enumerate(zip(ids, texts)):
            places = order(doc_id, len(text))
            if places is not None:
                texts[i] = [text[p] for p in places.tolist()]
    known: defaultdict[bytes, int] = defaultdict()
    known.default_factory = known.__len__  # a new word gets the next number
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    words = np.zeros(int((sizes + 1).sum()), np.int64)
    for s, n, text in zip(starts.tolist(), sizes.tolist(), texts):
        words[s:s + n] = list(map(known.__getitem__, text))
    words[starts + sizes] = len(known) + np.arange(len(texts))
    start, end, period = runs_of(words, starts, sizes, least_words, least_periods)
    text = np.searchsorted(starts + sizes, start, side="right")
    edges = np.searchsorted(text, np.arange(len(texts) + 1))
    by_start = np.lexsort((period, start))
    start, end, period, text = start[by_start], end[by_start], period[by_start], text[by_start]
    # A quotient of whole numbers below 2^25 is rounded apart from every other such quotient.
    by_rank = np.lexsort((period, start, -((end - start) / period), text))
    top = by_rank[edges[:-1][edges[:-1] < edges[1:]]]
    some = edges[:-1] < edges[1:]
    spoken = [b" ".join(t) for t in texts]
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    dropped = np.cumsum(change) > 0
    for i in np.flatnonzero(some).tolist():
        gone = dropped[starts[i]:starts[i] + sizes[i]].tolist()
        spoken[i] = b" ".join([w for w, g in zip(texts[i], gone) if not g])
    relative = start - starts[text] if len(text) else start
    flat = pa.StructArray.from_arrays([pa.array(relative), pa.array(end - start), pa.array(period)], fields=list(RUN))
    where = np.full(len(texts), -1)
    where[some] = top
    longest = flat.take(pa.array(where, mask=where < 0))
    return pa.RecordBatch.from_arrays(
        [rows.column("doc_id").cast(pa.int64()), pa.array(sizes), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), flat), longest,
         pa.array(spoken, pa.binary()).cast(pa.string())], schema=SCHEMA)


def periodic_runs(docs: DataFrame, least_words: int = 24, least_periods: int = 3, order: Order | None = None) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs``, ``longest`` and ``collapsed`` for every row of ``docs``.

    A run is a stretch of at least ``least_words`` words and ``least_periods`` (3 or more) periods that no neighbour extends; ``runs``
    are ordered by start, then period. ``longest`` is the one with most periods (ties: the first, then the shorter
    period). ``collapsed`` is the text without the words that a run holds after its first period, joined by one space.
    ``order(doc_id, n)`` may give the positions of words to read in place of 0 .. n - 1.
    """
    if least_words < 24 or least_periods < 3:
        raise ValueError("runs are searched from 24 words and three periods on")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text", 4_000_000):
            yield batch_runs(rows, least_words, least_periods, order)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(scan, SPARK_SCHEMA)
