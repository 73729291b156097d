"""Language identification by interpolated Kneser-Ney character models.

Models are over the letters of padded words, so a text's log-probability is a sum over
its words.  Every order's n-grams live in one array of 64-bit hashes in ascending order, each with one
value per language; looking an n-gram up is a binary search.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm import fit
from fundlens.llm import textvec as tv
from fundlens.llm.common import held_out, materialise

ORDER = 4
#: n-grams are counted by hashes of this many bits, which bounds a model's size at any corpus size.
HASH_BITS = 20
#: Held-in rows of each language used to calibrate scores.
CALIBRATION_ROWS = 500
CACHE_WORDS = 300_000
UNKNOWN = "und"
_word = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased; runs of other numerals alone do not make a text."""
    words = _word.findall(text.lower()) if text else []
    if words and not any(map(str.isalpha, words[0])):
        return [w for w in words if any(map(str.isalpha, w))]
    return words


def gram_hashes(words: list[str], n: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each n-gram, hash of its context, word number) of padded words.

    A word is read as n - 1 pads, its letters and one pad; each letter and the last pad is predicted.
    """
    flat = np.frombuffer("".join("\x02" * (n - 1) + w + "\x03" for w in words).encode("utf-32-le"), "<u4").astype(np.uint64)
    size = np.array([len(w) + n for w in words])
    ends = np.cumsum(size)
    ok = np.ones(len(flat), bool)
    for k in range(n - 1):
        ok[ends - size + k] = False
    at = np.flatnonzero(ok)
    h = np.full(len(at), n, np.uint64)
    for k in range(n - 1, 0, -1):
        h = tv.mix(h * np.uint64(0x9DDFEA08EB382D69) + flat[at - k])
    gram = tv.mix(h * np.uint64(0x9DDFEA08EB382D69) + flat[at])
    return _cut(gram, bits), _cut(h, bits), np.searchsorted(ends, at, "right")


def _cut(h: np.ndarray, bits: int) -> np.ndarray:
    return h >> np.uint64(64 - bits)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, Counter] = {}

    def out():
        for lang, words in seen.items():
            items = list(words.items())
            for lo in range(0, len(items), 50_000):
                w, n = zip(*items[lo:lo + 50_000])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(w)), pa.array(w), pa.array(n, pa.int64())],
                                                 names=["lang", "word", "n"])
        seen.clear()

    for b in batches:
        for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            seen.setdefault(lang, Counter()).update(words_of(text))
        if sum(map(len, seen.values())) > 500_000:
            yield from out()
    yield from out()


def _count_grams(order: int, bits: int):
    """(lang, n, gram, context, count) of the words of a batch; lower orders count types before them."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, words = np.array(b["lang"].to_pylist(), object), b["word"].to_pylist()
            weight = b["n"].to_numpy()
            codes, names = {x: i for i, x in enumerate(dict.fromkeys(lang))}, list(dict.fromkeys(lang))
            code = np.array([codes[x] for x in lang], np.uint64)
            for n in range(1, order + 1):
                gram, ctx, word = gram_hashes(words, n, bits)
                # the gram one longer that ends here tells which continuations are distinct
                longer = gram_hashes(words, n + 1, 64)[0] if n < order else np.zeros(len(gram), np.uint64)
                key = np.empty(len(gram), [("l", "<u8"), ("g", "<u8"), ("c", "<u8"), ("x", "<u8")])
                key["l"], key["g"], key["c"], key["x"] = code[word], gram, ctx, longer
                one = tv.mix(tv.mix(tv.mix(key["l"] + np.uint64(7)) ^ gram) ^ ctx * np.uint64(3)) ^ longer
                _, first, inverse = np.unique(one, return_index=True, return_inverse=True)
                total = np.bincount(inverse, weight[word].astype(float), len(first)).astype(np.int64)
                k = key[first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i] for i in k["l"].astype(int)]), pa.array(np.full(len(k), n, np.int32)),
                     pa.array(k["g"].astype(np.int64)), pa.array(k["c"].astype(np.int64)), pa.array(k["x"].view(np.int64)),
                     pa.array(total)], names=["lang", "n", "gram", "context", "longer", "count"])

    return count


def gram_counts(docs: DataFrame, order: int = ORDER, bits: int = HASH_BITS) -> DataFrame:
    """(lang, n, gram, context, count): counts of the highest order, continuation counts of the others.

    Words are counted first, in each task and then over all rows; n-grams come from the
    distinct words with their counts.
    """
    words = (docs.mapInArrow(_count_words, "lang string, word string, n long")
             .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    grams = words.mapInArrow(_count_grams(order, bits), "lang string, n int, gram long, context long, longer long, count long")
    grams = grams.groupBy("lang", "n", "gram", "context", "longer").agg(F.sum("count").alias("count"))
    return (grams.groupBy("lang", "n", "gram", "context")
            .agg(F.sum(F.when(F.col("n") == order, F.col("count")).otherwise(1)).alias("count")))


class Model:
    """Interpolated Kneser-Ney log-probabilities of words in every language."""

    def __init__(self, langs: list[str], order: int, bits: int, tables: list[tuple], base: np.ndarray):
        self.langs, self.order, self.bits, self.tables, self.base = langs, order, bits, tables, base
        self._cache: dict[str, int] = {}
        self._values = np.zeros((0, len(langs)))

    @staticmethod
    def build(rows: pa.Table, order: int, bits: int) -> Model:
        lang_col = np.array(rows["lang"].to_pylist(), object)
        langs = sorted(set(lang_col))
        code = np.searchsorted(np.array(langs, object), lang_col) if langs else np.zeros(0, int)
        n, gram, ctx, count = (rows[c].to_numpy() for c in ("n", "gram", "context", "count"))
        tables, base = [], np.full(len(langs), 1e-6)
        for k in range(1, order + 1):
            sel = n == k
            g, c, l, v = gram[sel], ctx[sel], code[sel], count[sel].astype(float)
            ones = np.bincount(l[v == 1], minlength=len(langs))
            twos = np.bincount(l[v == 2], minlength=len(langs))
            discount = np.clip((ones + 0.5) / (ones + 2 * twos + 1.0), 0.1, 0.95)
            ctxs, ci = np.unique(c, return_inverse=True)
            total = np.zeros((len(ctxs), len(langs)))
            kinds = np.zeros_like(total)
            np.add.at(total, (ci, l), v)
            np.add.at(kinds, (ci, l), 1)
            back = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            grams, gi = np.unique(g, return_inverse=True)
            p = np.zeros((len(grams), len(langs)))
            np.add.at(p, (gi, l), np.maximum(v - discount[l], 0) / np.maximum(total[ci, l], 1))
            tables.append((grams.astype(np.uint64), p.astype(np.float32), ctxs.astype(np.uint64), back.astype(np.float32)))
            if k == 1:
                base = 1.0 / np.maximum(256, 2 * kinds.sum(0))
        return Model(langs, order, bits, tables, base)

    def _score(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word in each language."""
        prob = None
        for n, (grams, p, ctxs, back) in enumerate(self.tables, 1):
            gram, ctx, word = gram_hashes(words, n, self.bits)
            lower = prob if prob is not None else np.broadcast_to(self.base, (len(gram), len(self.langs)))
            prob = _at(grams, p, gram, 0.0) + _at(ctxs, back, ctx, 1.0) * lower
        out = np.zeros((len(words), len(self.langs)))
        np.add.at(out, word, np.log(prob))
        return out

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(mean log-probability per letter and pad in each language, number of those) of whole texts."""
        words = [words_of(t) for t in texts]
        if len(self._cache) > CACHE_WORDS:
            self._cache, self._values = {}, self._values[:0]
        new = list(dict.fromkeys(w for ws in words for w in ws if w not in self._cache))
        if new:
            self._values = np.concatenate([self._values, self._score(new)])
            self._cache.update(zip(new, range(len(self._cache), len(self._cache) + len(new))))
        get = self._cache.__getitem__
        total = np.zeros((len(texts), len(self.langs)))
        n = np.array([sum(map(len, ws)) + len(ws) for ws in words], float)
        for i, ws in enumerate(words):
            if ws:
                total[i] = self._values[np.fromiter(map(get, ws), np.int64, len(ws))].sum(0)
        return total / np.maximum(n, 1)[:, None], n


def _at(keys: np.ndarray, values: np.ndarray, ask: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full((len(ask), values.shape[1]), missing)
    at = np.minimum(np.searchsorted(keys, ask), len(keys) - 1)
    return np.where((keys[at] == ask)[:, None], values[at], missing)


def _margins(mean: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Calibration features: lead of the best language over the next, by letter and by evidence."""
    ordered = -np.sort(-mean, axis=1)
    lead = ordered[:, 0] - ordered[:, 1] if mean.shape[1] > 1 else np.full(len(mean), 1.0)
    return np.column_stack([lead, np.log1p(lead * n), np.log1p(n), np.maximum(ordered[:, 0], -20)])


def identify(docs: DataFrame, order: int = ORDER, bits: int = HASH_BITS, reject_below: float = 0.0,
             id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score (0 to 1) of every whole text.

    Models learn from all rows that are not held out and have a text and a language.  The
    language with the least length-normalised cross-entropy wins (ties: the first by name);
    its score is the calibrated chance of being right, and predictions scored under
    ``reject_below`` become ``und``.  Texts that are null or have no letter are ``und`` with
    score 0, as are all texts when nothing can be learned.  Rows with a null id are scored
    and not held out, and are learned from; repeated rows count each; an empty table gives
    no rows.  Model size is bounded by ``bits`` and the number of languages; only the
    models and at most ``CALIBRATION_ROWS`` rows a language reach the driver.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(lang_col).alias("lang"))
    train = docs.where(~held_out("doc_id") & F.col("text").isNotNull() & F.col("lang").isNotNull())
    model = Model.build(gram_counts(train.select("text", "lang"), order, bits).toArrow(), order, bits)
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast((model.langs, model.order, model.bits, model.tables, model.base))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        m = Model(*share.value)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                yield part, *m.texts(part.column(1).to_pylist())

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, mean, n in scored(batches):
            best = mean.argmax(1)
            right = np.array([model_langs[i] for i in best], object) == np.array(part.column(0).to_pylist(), object)
            keep = pa.array(n > 0)
            yield pa.RecordBatch.from_arrays([pa.array(right.astype(np.int32)), pa.array(_margins(mean, n).tolist())],
                                             names=["y", "x"]).filter(keep)

    model_langs = model.langs
    beta = np.zeros(5)
    if model_langs:
        ids = None
        for lang in model_langs:
            part = (train.where(F.col("lang") == lang).where("doc_id IS NOT NULL")
                    .orderBy(F.md5(F.concat(F.lit("langid"), F.col("doc_id").cast("string"))), "doc_id")
                    .select("lang", "doc_id").limit(CALIBRATION_ROWS))
            ids = part if ids is None else ids.unionByName(part)
        some = train.join(F.broadcast(ids), ["doc_id", "lang"]).select("lang", "text")
        seen = materialise(some, "langid-sample").mapInArrow(measure, "y int, x array<double>").collect()
        y, x = np.array([r["y"] for r in seen], int), np.array([r["x"] for r in seen]).reshape(-1, 4)
        # two pseudo-rows say that a text without any lead is a coin toss
        none = np.array([[0.0, 0.0, 0.0, x[:, 3].mean() if len(x) else 0.0]] * 2)
        beta = fit.logistic(np.vstack([x, none]), np.append(y, [0, 1]), np.append(np.ones(len(y)), [5.0, 5.0]))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, mean, n in scored(batches):
            if model_langs:
                best, p = mean.argmax(1), fit.probability(_margins(mean, n), beta)
            else:
                best, p = np.zeros(len(n), int), np.zeros(len(n))
            fine = (n > 0) & (p >= reject_below) & bool(model_langs)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([model_langs[i] if f else UNKNOWN for i, f in zip(best, fine)], pa.string()),
                 pa.array(np.where((n > 0) & bool(model_langs), p, 0.0))], names=["doc_id", "lang_pred", "score"])

    return (docs.select("doc_id", "text").mapInArrow(predict, "doc_id long, lang_pred string, score double")
            .select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score"))
