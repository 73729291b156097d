"""Toxicity by a learned lexicon, matched with Levenshtein automata over its trie.

The lexicon (words, and stems that stand for all words they begin) and the clean
look-alikes of its terms are learned from labelled text.  A word is matched by running
the product of the trie and the Levenshtein automaton of the word's edits, made
deterministic as it goes; context windows around matches separate quotation and report
from abuse, and a logistic fit turns document features into a calibrated score.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from fundlens.llm import fit
from fundlens.llm.common import held_out, materialise, worker_cache

#: Labelled rows of each class that the lexicon and the fit may use.
PER_CLASS = 6000
#: Most terms kept, by evidence.
LEXICON_TERMS = 3000
MIN_TOXIC_DOCS = 5
MIN_LIFT = 12.0
STEM_LENGTHS = range(4, 9)
WINDOW_WORDS = 8
CACHE_WORDS = 400_000
STATES = 60_000
FEATURES = 8
SCORE = "_toxicity"
#: Score of every text when there is nothing to learn from: not toxic.
NO_EVIDENCE = 0.25
_word = re.compile(r"[^\W_]+")
# fixed values: marks of quotation, words of report and of address in the corpus languages
QUOTES = "\"“”„«»‘’‹›"
REPORT = frozenset("said says called calls wrote word term quote quoted dit appelle mot cite sagte nennt wort zitat "
                   "dijo llama palabra cita".split())
ADDRESS = frozenset("you your yourself tu te toi vous votre du dich dein ihr euch ti usted ustedes".split())


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Matcher:
    """Lexicon lookup within each term's edits; stems match the beginnings of words exactly."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], clean: frozenset[str] = frozenset()):
        self.weight = dict(words)
        self.clean = clean
        self.child: list[dict[str, int]] = [{}]
        self.term: list[tuple[str, int] | None] = [None]
        self.stem: list[str | None] = [None]
        self.most = [0]
        for t in sorted(set(words) | set(stems)):
            node, k = 0, edits_allowed(t) if t in words else 0
            self.most[0] = max(self.most[0], k)
            for c in t:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.term.append(None)
                    self.stem.append(None)
                    self.most.append(0)
                node = self.child[node][c]
                self.most[node] = max(self.most[node], k)
            if t in words:
                self.term[node] = (t, k)
            if t in stems:
                self.stem[node] = t
        self.stem_weight = dict(stems)
        self._cache: dict[str, tuple[float, int] | None] = {}
        self._seen: set[str] = set()
        self._hits: set[str] = set()
        self._reset()

    def _reset(self) -> None:
        self._ids: dict[tuple, int] = {}
        self._sets: list[tuple[frozenset, str | None]] = []
        self._next: list[dict[str, int]] = []
        self._start = self._state(self._closure({(0, 0)}), None)

    def _closure(self, at: set[tuple[int, int]]) -> frozenset:
        """Adds the positions reached by characters the word leaves out."""
        todo, least = list(at), {}
        while todo:
            node, e = todo.pop()
            if least.get(node, 9) <= e:
                continue
            least[node] = e
            if e < self.most[node]:
                todo.extend((n, e + 1) for n in self.child[node].values() if e < self.most[n])
        return frozenset(least.items())

    def _state(self, positions: frozenset, stem: str | None) -> int:
        key = (positions, stem)
        if key not in self._ids:
            self._ids[key] = len(self._sets)
            self._sets.append(key)
            self._next.append({})
        return self._ids[key]

    def _step(self, state: int, c: str) -> int:
        positions, stem = self._sets[state]
        after = set()
        for node, e in positions:
            kids = self.child[node]
            if e < self.most[node]:
                after.add((node, e + 1))  # a character too many
                after.update((n, e + 1) for n in kids.values() if e < self.most[n])
            n = kids.get(c)
            if n is not None and e <= self.most[n]:
                after.add((n, e))
        closed = self._closure(after)
        for n, e in closed:
            if e == 0 and self.stem[n] is not None:
                stem = self.stem[n]
        self._next[state][c] = out = self._state(closed, stem)
        return out

    def touches(self, text: str) -> bool:
        """Whether any word of a text matches; space-separated chunks are judged once."""
        chunks = set(text.split())
        new = chunks - self._seen
        if new:
            if len(self._seen) > CACHE_WORDS:
                self._seen, self._hits, new = set(), set(), chunks
            self._hits.update(c for c in new if any(self.lookup(w) for w in _word.findall(c.lower())))
            self._seen |= new
        return not self._hits.isdisjoint(chunks)

    def lookup(self, word: str) -> tuple[float, int] | None:
        """(weight, edits) of the best matching term, or None."""
        if word in self._cache:
            return self._cache[word]
        if len(self._cache) > CACHE_WORDS:
            self._cache.clear()
        if len(self._sets) > STATES:
            self._reset()
        state, nexts = self._start, self._next
        for c in word:
            to = nexts[state].get(c)
            state = self._step(state, c) if to is None else to
            if not self._sets[state][0] and self._sets[state][1] is None:
                break
        positions, stem = self._sets[state]
        found = [(e, -self.weight[t], t) for n, e in positions if (x := self.term[n]) for t, k in [x] if e <= k]
        best = None
        if found and (min(found)[0] == 0 or word not in self.clean):
            e, w, _ = min(found)
            best = (-w, e)
        if stem is not None and (best is None or best[1] > 0):
            best = (self.stem_weight[stem], 0)
        self._cache[word] = best
        return best


def features(text: str, matcher: Matcher) -> list[float]:
    """Sums over matches: weights, counts of exact and misspelled terms, density and context."""
    if not matcher.touches(text):
        return [0.0] * FEATURES
    lowered = text.lower()
    words = _word.findall(lowered)
    hits = [(i, h) for i, w in enumerate(words) if (h := matcher.lookup(w))]
    spots = [m.span() for m in _word.finditer(lowered)]
    exact = [h[0] for _, h in hits if h[1] == 0]
    abuse = quoted = address = 0.0
    at = np.array([i for i, _ in hits])
    for i, (weight, edits) in hits:
        lo, hi = max(0, i - WINDOW_WORDS), min(len(words), i + WINDOW_WORDS + 1)
        near = words[lo:hi]
        before, behind = lowered[spots[lo][0]:spots[i][0]], lowered[spots[i][1]:spots[hi - 1][1]]
        is_quote = any(q in before for q in QUOTES) and any(q in behind for q in QUOTES)
        is_report = any(w in REPORT for w in near)
        is_address = any(w in ADDRESS for w in near)
        others = int(np.searchsorted(at, hi) - np.searchsorted(at, lo)) - 1
        quoted += is_quote or is_report
        address += is_address
        abuse += weight * (0.5 if edits else 1.0) * (0.4 if is_quote else 0.7 if is_report else 1.0) * (1 + 0.1 * min(others, 5))
    n = len(hits)
    return [np.log1p(abuse), max(exact, default=0.0), np.log1p(len(exact)), np.log1p(n - len(exact)),
            np.log1p(1000 * n / len(words)), quoted / n, address / n, float(n > 1)]


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that hold a word, or any word with a stem (marked by a star)."""
    seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for b in batches:
        for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            words = set(_word.findall(text.lower()))
            stems = {w[:n] + "*" for w in words for n in STEM_LENGTHS if len(w) > n}
            seen[y].update(words)
            seen[y].update(stems)
    # terms never seen in toxic text cannot enter the lexicon
    rows = [(t, n, seen[0][t]) for t, n in seen[1].items()]
    rows += [(t, 0, n) for t, n in seen[0].items() if t not in seen[1] and n > 1]
    for lo in range(0, len(rows), 50_000):
        t, a, b = zip(*rows[lo:lo + 50_000])
        yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                         names=["term", "toxic", "clean"])


def learn_lexicon(sample: DataFrame, terms: int = LEXICON_TERMS) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems with their log lifts: those far commoner in toxic than in clean documents."""
    n = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    lift = (F.col("toxic") + 0.5) / (toxic + 1) / ((F.col("clean") + 0.5) / (clean + 1))
    rows = (sample.select(F.lower("text").alias("text"), "y").groupBy("text").agg(F.max("y").alias("y"))
            .mapInArrow(_count_terms, "term string, toxic long, clean long")
            .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .where(F.col("toxic") >= MIN_TOXIC_DOCS).withColumn("lift", lift).where(F.col("lift") >= MIN_LIFT)
            .orderBy(F.desc(F.col("toxic") * F.log("lift")), "term").limit(terms).collect())
    weights = {r["term"]: float(np.log(r["lift"])) for r in rows}
    return ({t: w for t, w in weights.items() if t[-1] != "*"}, {t[:-1]: w for t, w in weights.items() if t[-1] == "*"})


def look_alikes(sample: DataFrame, words: dict[str, float], stems: dict[str, float]) -> frozenset[str]:
    """Words of clean sample documents that lie within a term's edits: real words, not misspellings."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(words, stems)
        for b in batches:
            found = {w for t in b.column(0).to_pylist() for w in _word.findall(t.lower()) if (h := m.lookup(w)) and h[1]}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["word"])

    return frozenset(r["word"] for r in sample.where("y = 0").select("text").mapInArrow(search, "word string").distinct().collect())


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = 0.5,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted of every whole text.

    The lexicon, its look-alikes and the fit use at most ``per_class`` labelled rows a
    class that are not held out; everything else covers all rows.  Null and empty texts
    have no matches and get the score of such a text; rows with a null id are scored and
    not held out; repeated rows are scored each; without labels of both classes every score
    is the share of class 1, smoothed towards not toxic; an empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return (score_rows(docs, labels, per_class).select(
        "doc_id", held_out("doc_id").alias("held_out"), F.col(SCORE).alias("score"),
        (F.col(SCORE) >= threshold).cast("int").alias("predicted")))


def score_rows(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with all their columns and the score in a column of its own."""
    sample, sizes = fit.labelled_sample(docs, labels, "toxic", per_class, "toxicity", id_col, text_col)
    sample = materialise(sample, "toxicity-sample")
    words, stems = learn_lexicon(sample)
    model = uuid.uuid4().hex
    clean = look_alikes(sample, words, stems) if words else frozenset()

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        m = worker_cache("toxicity", model, lambda: Matcher(words, stems, clean))
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                yield part, np.array([features(t or "", m) for t in part[text_col].to_pylist()])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in rows_of(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["y", "x"])

    seen = sample.select("y", F.col("text").alias(text_col)).mapInArrow(measure, "y int, x array<double>").collect()
    y = np.array([r["y"] for r in seen], int)
    x = np.array([r["x"] for r in seen]).reshape(-1, FEATURES)
    beta = fit.calibrate(x, y, sizes, NO_EVIDENCE)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in rows_of(batches):
            yield part.append_column(SCORE, pa.array(fit.probability(x, beta)))

    return docs.mapInArrow(score, StructType([*docs.schema.fields, StructField(SCORE, DoubleType())]))
