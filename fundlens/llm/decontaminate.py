"""Benchmark decontamination by template windows and slot consistency.

Numbers, units behind numbers and names become typed placeholders; windows of the
resulting template are hashed and joined to those of the benchmark, so a question that
only had its values changed still matches.  The values standing in the slots must then
map one to one between item and document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlens.llm import textvec as tv
from fundlens.llm.common import materialise, worker_cache

WINDOW = 8
#: Items shorter than a window are matched whole, from this many tokens on.
SHORTEST = 4
#: Share of an item's windows that must be found, and of its slots that must agree.
MIN_SHARE = 0.5
MIN_AGREE = 0.9
#: Windows are looked up in a bit table of this size before they are joined; its size is the bound of what is broadcast.
FILTER_BITS = 22
CACHE_WORDS = 300_000
LONGEST_KEY = 64
# fixed values: number words and units
NUMBER_WORDS = frozenset("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
                         "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
                         "million billion".split())
UNITS = frozenset("% percent mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t gram grams kilogram "
                  "kilograms ton tons lb lbs pound pounds oz ounce ounces ml l litre litres liter liters s sec second seconds "
                  "min minute minutes h hr hour hours day days week weeks month months year years $ € £ dollar dollars euro "
                  "euros cent cents c f k kelvin celsius w kw kwh watt watts v volt volts hz khz mhz ghz kb mb gb tb mph "
                  "kmh".split())
#: So many words in capitals behind one another are a text in capitals, not a name.
SHOUTED = 4
DROP, NAME, ENDS, UNIT, NUMBER, CAPITALS, PARTS = 1, 2, 4, 8, 16, 32, 64
_FLAGS = np.uint64(127)
_TYPES = {NUMBER: np.uint64(0x1111111111111100), UNIT: np.uint64(0x2222222222222200), NAME: np.uint64(0x3333333333333300)}
_glued = re.compile(r"(?<=\d)(?=[^\W\d_])")
_split_glued = re.compile(r"\d[^\W\d_]")
_core = re.compile(r"[^\W_](?:.*[^\W_])?|[%$€£]", re.S)
_number = re.compile(r"[+-]?\d[\d.,:/]*")
_end = re.compile(r"[.!?:;|]\W*$")
_ENDING = frozenset(".!?:;|")
#: ASCII marks but those that may be a word of their own or part of one
_MARKS = "!\"#&'()*+,-./:;<=>?@[\\]^`{|}~"


def _code(word: str) -> int:
    """Hash of a word's lower-cased core with its flags in the low seven bits."""
    plain = word.rstrip(_MARKS)
    core = plain.lstrip(_MARKS)
    if core.isalpha():
        # letters between plain marks: what the patterns below would find
        low, behind = core.lower(), word[len(plain):]
        flags = PARTS if behind else 0
        if behind and not _ENDING.isdisjoint(behind):
            flags |= ENDS
        if low in NUMBER_WORDS:
            flags |= NUMBER
        if low in UNITS:
            flags |= UNIT
        if len(core) > 1 and core[0].isupper():
            flags |= NAME | CAPITALS if core.isupper() else NAME
        return xxhash.xxh3_64_intdigest(low) & ~127 | flags
    m = _core.search(word)
    if not m:
        return DROP | (ENDS if _end.search(word) else 0)
    core, low = m[0], m[0].lower()
    flags = ENDS if _end.search(word) else 0
    if _number.fullmatch(core) or low in NUMBER_WORDS:
        flags |= NUMBER
    if low in UNITS:
        flags |= UNIT
    if len(core) > 1 and core[0].isupper():
        flags |= NAME
        if core.isupper():
            flags |= CAPITALS
    if not word[-1].isalnum():
        flags |= PARTS
    return xxhash.xxh3_64_intdigest(low) & ~127 | flags


def _shouted(capitals: np.ndarray) -> np.ndarray:
    """Words in runs of at least ``SHOUTED`` words in capitals."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], capitals.astype(np.int8), [0]])))
    out = np.zeros(len(capitals), bool)
    for lo, hi in zip(edge[::2], edge[1::2]):
        out[lo:hi] = hi - lo >= SHOUTED
    return out


class Words(Sequence):
    """The words behind the tokens, put together when they are asked for: token i covers ``use[start[i]:start[i + 1]]``."""

    def __init__(self, words: list[str], use: np.ndarray, start: np.ndarray | None = None):
        self._words, self._use, self._start = words, use, start

    def __len__(self) -> int:
        return len(self._use if self._start is None else self._start)

    def __getitem__(self, i: int) -> str:
        if self._start is None:
            return self._words[self._use[i]]
        stop = self._start[i + 1] if i + 1 < len(self._start) else len(self._use)
        return " ".join([self._words[j] for j in self._use[self._start[i]:stop]])


def _reading(h: np.ndarray, kind: np.ndarray, apart: np.ndarray, words: list[str],
             use: np.ndarray) -> tuple[np.ndarray, np.ndarray, Words]:
    """Tokens with typed placeholders; the words of one name are one token."""
    h = h.copy()
    for k, v in _TYPES.items():
        h[kind == k] = v
    on = np.zeros(len(h), bool)
    on[1:] = (kind[1:] == NAME) & (kind[:-1] == NAME) & ~apart[1:]
    if not on.any():
        return h, kind, Words(words, use)
    start = np.flatnonzero(~on)
    return h[start], kind[start], Words(words, use, start)


class Templates:
    """Template tokens of whole texts; codes of words up to ``LONGEST_KEY`` characters are kept in a bounded cache."""

    def __init__(self):
        self._codes: dict[str, int] = {}
        self._before: dict[str, int] = {}

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray, Words]:
        """(token hashes, slot type of each token or 0, the words behind them) of the first reading."""
        return self.readings(text)[0]

    def readings(self, text: str) -> list[tuple[np.ndarray, np.ndarray, Words]]:
        """The text with capitalised words that open a sentence as plain words, then, if there are any, as names."""
        if _split_glued.search(text):
            text = _glued.sub(" ", text)
        words = text.split()
        if len(self._codes) > CACHE_WORDS:
            self._codes, self._before = {}, self._codes
        codes, before, long = self._codes, self._before, []
        for w in set(words).difference(codes):
            code = before.get(w)
            codes[w] = _code(w) if code is None else code
            if len(w) > LONGEST_KEY:
                long.append(w)
        code = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
        for w in long:
            del codes[w]
        flags = (code & _FLAGS).astype(np.int64)
        use = np.flatnonzero(flags & DROP == 0)
        # a sentence starts behind a mark, also one that stands alone
        marks = np.concatenate([[0], np.cumsum(flags & ENDS > 0)])
        first = np.ones(len(use), bool)
        first[1:] = marks[use[1:]] > marks[use[:-1]]
        h, flags = code[use] & ~_FLAGS, flags[use]
        number = flags & NUMBER > 0
        unit = np.zeros(len(use), bool)
        unit[1:] = (flags[1:] & UNIT > 0) & number[:-1]
        name = (flags & NAME > 0) & ~number & ~unit & ~_shouted(flags & CAPITALS > 0)
        # a name goes on in the next word unless a mark parts them
        apart = np.ones(len(use), bool)
        apart[1:] = (flags[:-1] & PARTS > 0) | first[1:] | (np.diff(use) > 1)
        out = [_reading(h, np.where(number, NUMBER, np.where(unit, UNIT, np.where(name & ~first, NAME, 0))), apart, words, use)]
        if (name & first).any():
            out.append(_reading(h, np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, 0))), apart, words, use))
        return out

    def slots(self, kind: np.ndarray, words: Words, at: int, n: int) -> list[str]:
        """Values of the slots in a window: type and lower-cased core, in order."""
        return [f"{kind[i]}:{_core.search(words[i])[0].lower()}" for i in range(at, at + n) if kind[i]]


def item_windows(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(hash, size, item_id, reading, item_pos, n_windows, item_slots): short items are one window of their own size."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Templates()
        for b in batches:
            rows = []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for reading, (h, kind, words) in enumerate(t.readings(text)):
                    size = min(window, len(h))
                    if size < SHORTEST:
                        continue
                    wh = tv.window_hash(h, size).view(np.int64)
                    rows += [(int(x), size, item, reading, p, len(wh), t.slots(kind, words, p, size)) for p, x in enumerate(wh)]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string())]
            cols = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types)],
                                             names=["hash", "size", "item_id", "reading", "item_pos", "n_windows", "item_slots"])

    return (benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
            .where("item_id IS NOT NULL AND text IS NOT NULL")
            .mapInArrow(cut, "hash long, size int, item_id long, reading int, item_pos int, n_windows int, item_slots array<string>"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_share: float = MIN_SHARE,
                  min_agree: float = MIN_AGREE, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, contaminated, items (ids found, ascending) and share (largest) of every document.

    A document holds an item if at least ``min_share`` of the item's template windows occur
    in it and, where these have slots, at least ``min_agree`` of the slot values map one to
    one.  Words in one name are one slot; a capitalised word that opens a sentence is read both as
    a plain word and as a name, and an item counts by either reading.  Items of fewer than four tokens and null items match nothing; null and
    empty texts are clean; a row with a null id is never contaminated; rows that repeat an
    id are judged together and listed each; empty tables give no rows, or clean ones; other
    columns are not read.
    """
    items = materialise(item_windows(benchmark, window, item_col, item_text_col), "template-items")
    shift = 64 - FILTER_BITS
    # at most 2^FILTER_BITS distinct places, and as many sizes as a window has words
    places = items.select(F.shiftrightunsigned("hash", shift).alias("p")).distinct().collect()
    table = np.zeros(1 << FILTER_BITS, bool)
    table[[r["p"] for r in places]] = True
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast(np.packbits(table))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(share.value).view(bool)
        t = worker_cache("templates", "", Templates)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part, rows = b.slice(lo, 256), []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for reading, (h, kind, words) in enumerate(t.readings(text)):
                        for size in sizes:
                            wh = tv.window_hash(h, size)
                            for p in np.flatnonzero(known[wh >> np.uint64(shift)]):
                                rows.append((int(wh[p].view(np.int64)), size, doc, reading, int(p), t.slots(kind, words, p, size)))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string())]
                cols = list(zip(*rows)) or [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types)],
                                                 names=["hash", "size", "doc_id", "doc_reading", "pos", "slots"])

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = (docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
             .mapInArrow(find, "hash long, size int, doc_id long, doc_reading int, pos int, slots array<string>"))
    hits = found.join(items, ["hash", "size"]).withColumn("shift", F.col("pos") - F.col("item_pos"))
    # a slot of an occurrence is one place of the item; windows that overlap it say the same
    hits = materialise(hits.where(F.size("slots") == F.size("item_slots")), "template-hits")
    item = ("doc_id", "item_id", "reading")
    cover = (hits.groupBy(*item, "item_pos").agg(F.max("n_windows").alias("n_windows"))
             .groupBy(*item).agg((F.count(F.lit(1)) / F.max("n_windows")).alias("share")))
    by = (*item, "doc_reading", "shift")
    pairs = (hits.where(F.size("slots") > 0)
             .select(*by, F.explode(F.arrays_zip("item_slots", "slots")).alias("z"))
             .groupBy(*by, F.col("z.item_slots").alias("a"), F.col("z.slots").alias("b"))
             .agg(F.count(F.lit(1)).alias("n")))
    # a value's partner is its most frequent one, both ways; the other placings are conflicts
    best = lambda side, other: F.row_number().over(Window.partitionBy(*by, side).orderBy(F.desc("n"), other)) == 1
    agree = (pairs.withColumn("fits", best("a", "b")).withColumn("fits", F.col("fits") & best("b", "a"))
             .groupBy(*by)
             .agg((F.sum(F.when(F.col("fits"), F.col("n")).otherwise(0)) / F.sum("n")).alias("agree"))
             .groupBy(*item).agg(F.max("agree").alias("agree")))
    leaks = (cover.join(agree, [*item], "left").where(F.col("share") >= min_share)
             .where(F.coalesce("agree", F.lit(1.0)) >= min_agree)
             .groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("share").alias("share")))
    return (docs.select("doc_id").join(leaks, "doc_id", "left")
            .select("doc_id", F.col("items").isNotNull().alias("contaminated"),
                    F.coalesce("items", F.array().cast("array<long>")).alias("items"),
                    F.coalesce("share", F.lit(0.0)).alias("share")))
