"""Language identification by cross-parsing entropy.

For every language a suffix automaton is built from a bounded sample of its labelled text. A text is parsed greedily
into the longest phrases that occur in the sample; the fewer phrases per letter, the closer the text is to the
language. The language with the fewest phrases, times log2 of its sample's length (the cost of naming a phrase), wins.

The automata are transition tables, so a batch of documents is parsed in lockstep: one table look-up for all lanes per
letter. Long texts are lanes of ``LANE`` letters, which costs them at most one phrase per lane. Workers live on after their tasks
and keep what they took, so a batch is held in bytes, one per letter, and wider only in parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import slices

LANE = 2048
PART = 1 << 18  # characters that are looked up at a time
_NEW = np.int32(1 << 30)  # flag of a transition that begins a phrase
_MODELS: dict[int, tuple] = {}


def fold_letters(text: str) -> str:
    """Lower case; every run of other characters than letters is one space."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def training_sample(docs: DataFrame, train: Column, *, doc_id: str, text: str, lang: str, per_language: int,
                    letters: int) -> dict[str, str]:
    """Folded text per language: the ``per_language`` distinct labelled texts of least hash, at most ``letters`` in all, an
    equal share of each text picked. The bound holds whatever the table's size; only hashes are shuffled to pick."""
    rows = docs.where(train & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(lang).cast("string").alias("lang"), F.xxhash64(F.col(text), F.lit(5)).alias("order"), F.col(text).alias("text"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    picked = rows.select("lang", "order").distinct().withColumn("n", first).where(F.col("n") <= per_language)
    picked = picked.withColumn("share", F.greatest(F.lit(1), F.lit(letters) / F.count("n").over(Window.partitionBy("lang"))).cast("int"))
    folded = F.ltrim(F.regexp_replace("text", r"\P{L}+", " "))
    cut = rows.join(F.broadcast(picked), ["lang", "order"]).select("lang", "n", "share", folded.alias("text")).select(
        "lang", "n", "share", F.expr("substring(text, 1, share)").alias("text"))
    cut = cut.groupBy("lang", "n", "share").agg(F.min("text").alias("text"))
    out: dict[str, list[str]] = {}
    for row in cut.orderBy("lang", "n").toLocalIterator():
        out.setdefault(row["lang"], []).append(fold_letters(row["text"])[:row["share"]])
    return {k: " ".join(v) for k, v in sorted(out.items()) if any(v)}


def suffix_automaton(text: np.ndarray, letters: int) -> np.ndarray:
    """Transitions [state, letter] of the automaton of all substrings; -1 where there is none. State 0 is the root."""
    size = 2 * len(text) + 2
    step, link, length = np.full((size, letters), -1, np.int32), [-1], [0]
    rows: list[dict[int, int]] = [{}]
    last = 0
    for c in text.tolist():
        new = len(rows)
        rows.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in rows[p]:
            rows[p][c] = new
            p = link[p]
        if p >= 0:
            q = rows[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(rows)
                rows.append(dict(rows[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and rows[p].get(c) == q:
                    rows[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    for s, moves in enumerate(rows):
        for c, t in moves.items():
            step[s, c] = t
    return step[:len(rows)]


def parse_table(sample: str, alphabet: dict[str, int]) -> np.ndarray:
    """The automaton as one flat table for greedy parsing: entry [state, letter] is the next state's row; where the
    phrase cannot go on, the state a new phrase with this letter leads to, flagged. The last state is that before a
    phrase; letters the sample lacks lead back to it. Letter 0 is padding and stays."""
    width = len(alphabet) + 2
    codes = np.array([alphabet[c] for c in sample], np.int32)
    step = suffix_automaton(codes, width)
    begin = np.where(step[0] >= 0, step[0], len(step)) | _NEW
    table = np.vstack([step, np.full((1, width), -1, np.int32)])
    np.copyto(table, begin, where=table < 0)
    flags = table & _NEW
    table &= _NEW - 1
    table *= width
    table |= flags
    table[:, 0] = np.arange(len(table)) * width
    return table.ravel()


class Parser:
    """Tables of all languages, built once per worker from the samples."""

    def __init__(self, samples: dict[str, str]) -> None:
        self.languages = list(samples)
        letters = sorted({" ", *"".join(samples.values())})
        self.alphabet = {c: i + 2 for i, c in enumerate(letters)}  # 0: padding, 1: any other letter
        self.width = len(letters) + 2
        self.tables = [parse_table(s, self.alphabet) for s in samples.values()]
        self.cost = np.array([np.log2(max(2, len(s))) for s in samples.values()])
        self.space = self.alphabet[" "]
        # code of every character: known letters by their lower case, other letters 1, all else a space
        self.code = np.full(0x110000, self.space, np.uint8 if self.width < 256 else np.uint16)
        for c in range(0x110000):
            if (x := chr(c)).isalpha():
                self.code[c] = self.alphabet.get(x.lower()[0], 1)

    def folded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of all texts in a row with space runs made one, their lengths, and their numbers of letters."""
        sizes = np.array([len(t) for t in texts])
        flat = "".join(texts)
        code = np.empty(len(flat), self.code.dtype)
        for a in range(0, len(flat), PART):
            code[a:a + PART] = self.code[np.frombuffer(flat[a:a + PART].encode("utf-32-le"), np.uint32)]
        letter = code != self.space
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        ends = np.cumsum(sizes)
        begins = (ends - sizes)[sizes > 0]
        keep[begins] = letter[begins]  # no space at the front
        count = lambda x: np.array([np.count_nonzero(x[b - n:b]) for n, b in zip(sizes.tolist(), ends.tolist())], np.int64)
        return code[keep], count(keep), count(letter)

    def phrases(self, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases [text, language] of folded texts laid in a row."""
        n_texts = len(lengths)
        lanes = -(-lengths // LANE)
        owner, total = np.repeat(np.arange(n_texts), lanes), int(lanes.sum())
        grid = np.zeros((total, LANE), self.code.dtype)
        first = np.cumsum(lanes) - lanes
        cells, begins = grid.reshape(-1), np.cumsum(lengths) - lengths
        for to, a, n in zip((first * LANE).tolist(), begins.tolist(), lengths.tolist()):
            cells[to:to + n] = flat[a:a + n]
        filled = np.minimum(lengths[owner] - (np.arange(total) - first[owner]) * LANE, LANE)
        order = np.argsort(-filled, kind="stable")  # lanes that end early drop off the tail
        columns = np.ascontiguousarray(grid[order].T)
        del grid, cells
        active = np.searchsorted(-filled[order], -np.arange(LANE), side="left")
        out = np.zeros((n_texts, len(self.tables)))
        for k, table in enumerate(self.tables):
            state, count = np.full(total, len(table) - self.width, np.int32), np.zeros(total, np.int32)
            for i in range(LANE):
                n = active[i]
                if not n:
                    break
                move = table[state[:n] + columns[i, :n]]
                count[:n] += move >> 30
                state[:n] = move & (_NEW - 1)
            out[:, k] = np.bincount(owner[order], count, n_texts)
        return out

    def classify(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = ["und"] * len(texts), np.zeros(len(texts))
        flat, length, letters = self.folded([t or "" for t in texts])
        pick = np.flatnonzero(letters)
        if len(pick) and self.languages:
            bits = self.phrases(flat, length)[pick] * self.cost / length[pick, None]
            best = bits.argmin(1)
            if len(self.languages) > 1:
                two = np.partition(bits, 1, axis=1)[:, :2]
                scores[pick] = two[:, 1] / two.sum(1)
            else:
                scores[pick] = 1.0
            for i, b in zip(pick, best):
                names[i] = self.languages[b]
        return names, scores


def parser(samples: dict[str, str]) -> Parser:
    key = hash(tuple(samples.items()))
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Parser(samples)
    return _MODELS[key]


def identify_language(docs: DataFrame, train: Column, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                      per_language: int = 64, letters: int = 32_000) -> DataFrame:
    """Language of every whole text: doc_id, lang_pred, score.

    ``train`` selects the rows whose label may be learned from; of these a sample of ``per_language`` rows and
    ``letters`` letters per label is used. ``score`` is the runner-up's share of the entropy of the best two (0.5: a tie, towards
    1: certain; 1 with one language). Null, empty and letterless texts are ``und`` with score 0, and so is everything
    when no label can be learned. Equal texts get equal answers; ties go to the first language by name. Null labels are
    not learned from; null ids and repeated rows keep their rows. Other columns are not read.
    """
    samples = training_sample(docs, train, doc_id=doc_id, text=text, lang=lang, per_language=per_language, letters=letters)
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = parser(samples)
        for batch in slices(batches, "text", 8_000_000):
            names, scores = tool.classify(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)],
                                             ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")


def keep_identified(docs: DataFrame, train: Column, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                    per_language: int = 64, letters: int = 32_000) -> DataFrame:
    """The rows whose language :func:`identify_language` can tell, with all their columns: ``und`` goes."""
    samples = training_sample(docs, train, doc_id=doc_id, text=text, lang=lang, per_language=per_language, letters=letters)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = parser(samples)
        for batch in slices(batches, text, 8_000_000):
            names, _ = tool.classify(batch.column(text).to_pylist())
            yield batch.filter(pa.array([n != "und" for n in names]))

    return docs.mapInArrow(keep, docs.schema)
