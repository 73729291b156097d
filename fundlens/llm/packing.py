"""Sequence packing: shortest-pack-first over the histogram of piece lengths."""

from __future__ import annotations

import heapq
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlens.llm.common import materialise, worker_cache

MAX_LENGTH = 4096
END_ID = 2
#: Entries of each cache and characters of its longest key, so a worker's caches stay below about 200 MB.
CACHE_CHUNKS = 300_000
LONGEST_KEY = 64
#: White space to the tokenizer's splitter that ``str.split`` and it treat differently.
SEPARATORS = "\x1c\x1d\x1e\x1f"
#: Documents and characters that are encoded together.
BATCH_ROWS = 1024
BATCH_CHARS = 2_000_000
RANK_BUCKET_ROWS = 2048
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Encoder:
    """Token ids of whole texts as little-endian uint32 bytes.

    The tokenizer drops white space before splitting, so a text's ids are those of its
    space-separated chunks in turn; chunks are encoded once and kept in caches bounded by
    their entries and the length of a key.  A chunk of Latin letters with marks behind is
    put together from the two.  A text where the split could fail (control separators,
    special-token marks) is encoded whole.
    """

    _letters = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
    #: marks that may follow a word: ASCII punctuation without the apostrophe
    _marks = "".join(map(chr, (*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127))))

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._ends = np.array([t.endswith("</w>") for t, _ in sorted(self._tok.get_vocab().items(), key=lambda x: x[1])])
        self._chunks: dict[str, bytes] = {}
        self._chunks_before: dict[str, bytes] = {}
        self._parts: dict[str, bytes] = {"": b""}
        self._older: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self._tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word: many words are encoded as one text and parted at word-end tokens."""
        out: list[bytes] = []
        for lo in range(0, len(words), 4096):
            part = words[lo:lo + 4096]
            ids = np.frombuffer(b"".join(self._encode([" ".join(part[i:i + 256]) for i in range(0, len(part), 256)])), "<u4")
            cut = [0, *(4 * (np.flatnonzero(self._ends[ids]) + 1)).tolist()]
            data = ids.tobytes()
            out += [data[x:y] for x, y in zip(cut, cut[1:])] if len(cut) == len(part) + 1 else self._encode(part)
        return out

    def _learn(self, chunks: set[str]) -> None:
        """Ids of chunks that are not in the cache."""
        if len(self._parts) > CACHE_CHUNKS:
            self._parts, self._older = {"": b""}, self._parts
        parts, older, have, before, marks = self._parts, self._older, self._chunks, self._chunks_before, self._marks
        todo, rest, fresh = [], [], {}
        for c in chunks:
            ids = before.get(c)
            if ids is not None:
                have[c] = ids
                continue
            w = c.rstrip(marks)
            low, tail = w.lower(), c[len(w):]
            ids, end = parts.get(low), parts.get(tail)
            if ids is not None and end is not None:
                have[c] = ids + end
            elif len(c) <= LONGEST_KEY and low and (ids is not None or low in older or self._letters.fullmatch(w)):
                todo.append((c, low, tail))
                fresh[low] = fresh[tail] = None
            else:
                rest.append(c)
        parts.update((x, older[x]) for x in fresh if x in older)
        new = [x for x in fresh if x not in parts]
        parts.update(zip(new, self._encode_words(new)))
        have.update((c, parts[low] + parts[tail]) for c, low, tail in todo)
        have.update(zip(rest, self._encode(rest)))

    def __call__(self, texts: list[str]) -> list[bytes]:
        words = [None if "<|" in t or any(c in t for c in SEPARATORS) else t.split() for t in texts]
        seen = set().union(*[w for w in words if w is not None])
        if len(self._chunks) > CACHE_CHUNKS:
            self._chunks, self._chunks_before = {}, self._chunks
        have = self._chunks
        new = seen.difference(have)
        if new:
            self._learn(new)
        out = [b"".join(map(have.__getitem__, w)) if w is not None else self._encode([t])[0] for t, w in zip(texts, words)]
        for c in new:
            if len(c) > LONGEST_KEY:
                del have[c]
        return out


def _stretches(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows to encode together: at most ``BATCH_ROWS`` and, but for one row alone, about ``BATCH_CHARS``."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(upto):
        limit = (upto[lo - 1] if lo else 0) + BATCH_CHARS
        hi = min(lo + BATCH_ROWS, max(lo + 1, int(np.searchsorted(upto, limit, "right"))))
        yield lo, hi
        lo = hi


def pieces(docs: DataFrame, tokenizer_path: str, max_length: int = MAX_LENGTH, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise whole documents, add ``end_id`` and cut at multiples of ``max_length``."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_cache("encoder", tokenizer_path, lambda: Encoder(tokenizer_path))
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            for lo, hi in _stretches(texts):
                out: list[tuple] = []
                for doc, ids_bytes in zip(ids.slice(lo, hi - lo).to_pylist(),
                                          encode([t or "" for t in texts.slice(lo, hi - lo).to_pylist()])):
                    data = ids_bytes + end
                    n = len(data) // 4
                    out.extend((doc, s, min(max_length, n - s), zlib.crc32(data[4 * s:4 * (s + max_length)]), n)
                               for s in range(0, n, max_length))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                                 names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, _PIECES)


def plan(histogram: dict[int, int], max_length: int = MAX_LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Shortest-pack-first placements (length, first rank, count, first sequence, offset).

    Lengths go longest first; pieces of one length fill the groups of equal packs that
    are shortest so far and have room, a group being split when only part of it is used.
    """
    groups: list[tuple[int, int, int]] = []  # (used, first sequence, count) as a heap, shortest pack first
    placed, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            if groups and groups[0][0] + length <= max_length:
                used, first, count = heapq.heappop(groups)
                take = min(left, count)
                if take < count:
                    heapq.heappush(groups, (used, first + take, count - take))
            else:
                # nothing has room: open the packs that pieces of this length alone would fill
                used, first, take = 0, sequences, max(1, left // (max_length // length))
                sequences += take
            placed.append((length, rank, take, first, used))
            if used + length < max_length:
                heapq.heappush(groups, (used + length, first, take))
            rank, left = rank + take, left - take
    return placed


def pack(pieces_df: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """Give every piece a sequence and an offset.

    Only the length histogram (at most ``max_length`` rows) reaches the driver.  A piece's
    rank among those of its length is its place in a hashed bucket plus the sizes of the
    buckets before, so no length is ordered in one task; ranks index the placements, whose
    number is bounded by the plan over at most ``max_length`` lengths.
    """
    t = materialise(pieces_df, "pack-pieces")
    histogram = {r["length"]: r["count"] for r in t.groupBy("length").count().collect()}
    table = np.array(plan(histogram, max_length), np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    place = t.sparkSession.sparkContext.broadcast(table)
    n_buckets = max(1, -(-sum(histogram.values()) // RANK_BUCKET_ROWS))
    b = t.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(n_buckets)))
    sizes = b.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = (b.withColumn("rn", F.row_number().over(within) - 1).join(base, ["length", "bucket"])
              .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("rn")).alias("rank")))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = place.value
        key = rows[:, 0] << 48 | rows[:, 1]
        for x in batches:
            length, rank = x["length"].to_numpy(), x["rank"].to_numpy()
            at = rows[np.searchsorted(key, length << 48 | rank, "right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*x.columns[:5], pa.array(at[:, 3] + rank - at[:, 1]), pa.array(at[:, 4])],
                names=[*x.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(put, _PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, max_length: int = MAX_LENGTH, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``max_length`` tokens.

    Returns one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset.  A null or empty text is the end id alone; texts of any length are cut into
    pieces; repeated rows (and rows with a null id) are packed each on its own; an empty
    table gives no rows; other columns are not read.
    """
    return pack(pieces(docs, tokenizer_path, max_length, end_id, id_col, text_col), max_length)
