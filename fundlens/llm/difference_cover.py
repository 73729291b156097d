"""Repeated-passage removal by difference-cover anchors.

A difference cover D modulo m holds, for any two word positions i and j, an offset
k < m with i + k and j + k both at cover positions.  Two equal windows of ``window``
words therefore share an anchor: a shorter window of ``window - m + 1`` words hashed
at cover positions only.  Anchors seen twice are extended to the full windows around
them, and only those windows are compared across documents.

Documents are dealt to chunks; chunks and hash buckets exchange packed, already
de-duplicated hash arrays, so a passage held by a third of all documents is one entry
a chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm import textvec as tv
from fundlens.llm.common import materialise

PERIOD = 7
COVER = (0, 1, 3)
DOCS_PER_CHUNK = 512
CHUNKS_PER_BUCKET = 4
_NO_ID = np.iinfo(np.int64).max


def _cover_of(period: int, cover: tuple[int, ...]) -> np.ndarray:
    flags = np.zeros(period, bool)
    flags[list(cover)] = True
    assert all(any(flags[(d + k) % period] and flags[k % period] for k in range(period)) for d in range(period)), \
        "not a difference cover"
    return flags


def _anchors(b: tv.Block, flags: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(word positions in the block, hashes) of the windows at cover positions."""
    h = tv.window_hash(b.hash, width)
    place = np.arange(len(h)) - np.repeat(b.off[:-1], np.diff(b.off))[:len(h)]
    at = np.flatnonzero(flags[place % len(flags)] & tv.inside(b.off, width, len(b.hash)))
    return at, h[at]


def _address(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket in the high half, 32 further bits of the hash in the low half."""
    return (hashes % np.uint64(n_buckets) << np.uint64(32)) | (hashes >> np.uint64(32))


def _split(buckets: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """Rows of each bucket: (bucket, part of every column)."""
    order = np.argsort(buckets, kind="stable")
    buckets, columns = buckets[order], [c[order] for c in columns]
    edge = np.concatenate([[0], np.flatnonzero(buckets[1:] != buckets[:-1]) + 1, [len(buckets)]]) if len(buckets) else [0]
    for lo, hi in zip(edge[:-1], edge[1:]):
        yield (int(buckets[lo]), *(c[lo:hi] for c in columns))


def _messages(rows: list[tuple], names: list[str]) -> pa.Table:
    types = [pa.int64(), pa.int64(), *[pa.binary()] * (len(names) - 2)]
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def _joined(table: pa.Table, column: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(values of all rows' payloads, row number of each value)."""
    parts = [np.frombuffer(p, kind) for p in table[column].to_pylist()]
    if not parts:
        return np.zeros(0, kind), np.zeros(0, np.int64)
    return np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def remove_repeats(docs: DataFrame, window: int = 13, period: int = PERIOD, cover: tuple[int, ...] = COVER,
                   id_col: str = "doc_id", text_col: str = "text", docs_per_chunk: int = DOCS_PER_CHUNK,
                   with_text: bool = False) -> DataFrame:
    """Remove every word covered by a window that also starts in a document with a smaller id.

    Words are maximal runs of bytes outside {0x20, 0x09-0x0D}, unchanged; windows are judged
    on the input.  Returns doc_id, n_words, n_removed, kept_sha256 (of the kept words joined
    by one space) and, on request, the kept text.  Null and empty texts have no words; a row
    with a null id keeps all its words and takes none from others; rows that repeat an id
    are judged each on its own, by that id; an empty table gives no rows; other columns are
    not read.  Windows are compared by 64 bits of hash within buckets chosen by a second hash.
    """
    flags, width = _cover_of(period, cover), window - period + 1
    n_chunks = max(1, -(-docs.count() // docs_per_chunk))
    n_buckets = max(1, -(-n_chunks // CHUNKS_PER_BUCKET))
    chunked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)))

    def chunk_of(t: pa.Table) -> int:
        return t["chunk"][0].as_py()

    def send_anchors(t: pa.Table) -> pa.Table:
        seen = [np.unique(_address(_anchors(b, flags, width)[1], n_buckets)) for b in tv.blocks(t["text"])]
        address = np.unique(np.concatenate(seen)) if seen else np.zeros(0, np.uint64)
        rows = [(chunk_of(t), b, x.astype("<u4").tobytes()) for b, x in
                _split(address >> np.uint64(32), address & np.uint64(0xFFFFFFFF))]
        return _messages(rows, ["chunk", "bucket", "anchors"])

    def repeated_anchors(t: pa.Table) -> pa.Table:
        value, row = _joined(t, "anchors", "<u4")
        order = np.argsort(value, kind="stable")
        value, row = value[order], row[order]
        same = np.zeros(len(value) + 1, bool)
        same[1:-1] = value[1:] == value[:-1]
        twice = same[1:] | same[:-1]
        chunk = t["chunk"].to_numpy()
        rows = [(int(chunk[r]), t["bucket"][0].as_py(), x.tobytes()) for r, x in _split(row[twice], value[twice])]
        return _messages(rows, ["chunk", "bucket", "anchors"])

    def candidate_windows(t: pa.Table, answers: pa.Table):
        """Per block: (block, doc row per word, window starts, two window hashes, document ids)."""
        value, row = _joined(answers, "anchors", "<u4")
        known = (answers["bucket"].to_numpy()[row].astype(np.uint64) << np.uint64(32)) | value
        ids = t["doc_id"].combine_chunks().fill_null(_NO_ID).to_numpy()
        found = [(b, *_anchors(b, flags, width)) for b in tv.blocks(t["text"])]
        found = [(b, at, _address(h, n_buckets)) for b, at, h in found]
        here, n = np.unique(np.concatenate([a for _, _, a in found] or [np.zeros(0, np.uint64)]), return_counts=True)
        known = np.unique(np.concatenate([known, here[n > 1]]))
        for b, at, address in found:
            total = len(b.hash)
            hit = np.zeros(total + period + 1, np.int64)
            if len(known) and len(address):
                place = np.minimum(np.searchsorted(known, address), len(known) - 1)
                hit[at[known[place] == address] + 1] = 1
            sums = np.cumsum(hit)
            ok = tv.inside(b.off, window, total)
            start = np.flatnonzero(ok & (sums[period:period + len(ok)] > sums[:len(ok)]))
            doc = np.repeat(np.arange(b.lo, b.hi), np.diff(b.off))
            one, two = _window_pair(b.hash, start, window)
            yield b, doc, start, one, two, ids[doc[start]]

    def chunk_windows(t: pa.Table, answers: pa.Table):
        parts = list(candidate_windows(t, answers))
        one = np.concatenate([p[3] for p in parts] or [np.zeros(0, np.uint64)])
        bucket = np.concatenate([p[4] for p in parts] or [np.zeros(0, np.uint64)]) % np.uint64(n_buckets)
        ids = np.concatenate([p[5] for p in parts] or [np.zeros(0, np.int64)])
        key = _key(one, bucket)
        order = np.lexsort((ids, key))
        key, one, bucket, ids = key[order], one[order], bucket[order], ids[order]
        first = np.ones(len(one), bool)
        first[1:] = key[1:] != key[:-1]
        return parts, key[first], one[first], bucket[first], ids[first]

    def send_windows(t: pa.Table, answers: pa.Table) -> pa.Table:
        _, _, one, bucket, least = chunk_windows(t, answers)
        rows = [(chunk_of(t), b, h.tobytes(), i.tobytes()) for b, h, i in _split(bucket, one, least)]
        return _messages(rows, ["chunk", "bucket", "windows", "least"])

    def least_ids(t: pa.Table) -> pa.Table:
        value, row = _joined(t, "windows", "<u8")
        least, _ = _joined(t, "least", "<i8")
        order = np.lexsort((least, value))
        value, row, least = value[order], row[order], least[order]
        first = np.ones(len(value), bool)
        first[1:] = value[1:] != value[:-1]
        best = least[first][np.cumsum(first) - 1] if len(value) else least
        lower = best < least
        chunk = t["chunk"].to_numpy()
        rows = [(int(chunk[r]), t["bucket"][0].as_py(), v.tobytes(), i.tobytes())
                for r, v, i in _split(row[lower], value[lower], best[lower])]
        return _messages(rows, ["chunk", "bucket", "windows", "least"])

    def clean(t: pa.Table, both: pa.Table) -> pa.Table:
        # answers of the two rounds come as one table: anchors where windows is null
        is_anchor = pc.is_valid(both["anchors"])
        answers, lower = both.filter(is_anchor), both.filter(pc.invert(is_anchor))
        parts, key, _, _, least = chunk_windows(t, answers)
        value, row = _joined(lower, "windows", "<u8")
        best, _ = _joined(lower, "least", "<i8")
        # every answer is about one of this chunk's windows
        least[np.searchsorted(key, _key(value, lower["bucket"].to_numpy()[row].astype(np.uint64)))] = best
        out = []
        texts = t["text"].combine_chunks().cast(pa.binary())
        all_ids = t["doc_id"].to_pylist()
        for b, doc, start, h1, h2, ids in parts:
            gone = start
            if len(start):
                place = np.searchsorted(key, _key(h1, h2 % np.uint64(n_buckets)))
                gone = start[(least[place] < ids) & (ids != _NO_ID)]
            cover_ = np.zeros(len(b.hash) + window + 1, np.int32)
            np.add.at(cover_, gone, 1)
            np.add.at(cover_, gone + window, -1)
            keep = np.cumsum(cover_)[:len(b.hash)] == 0
            kept_before = np.concatenate([[0], np.cumsum(keep)])
            for i in range(b.lo, b.hi):
                lo, hi = int(b.off[i - b.lo]), int(b.off[i - b.lo + 1])
                words = (texts[i].as_py() or b"").split()
                kept = int(kept_before[hi] - kept_before[lo])
                if kept < hi - lo:
                    words = list(compress(words, keep[lo:hi].tolist()))
                text = b" ".join(words)
                out.append((all_ids[i], hi - lo, hi - lo - kept, hashlib.sha256(text).hexdigest(),
                            text.decode() if with_text else None))
        cols = list(zip(*out))[:4 + with_text]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "text"][:4 + with_text]
    by_chunk = chunked.groupBy("chunk")
    anchors = (by_chunk.applyInArrow(send_anchors, "chunk long, bucket long, anchors binary")
               .groupBy("bucket").applyInArrow(repeated_anchors, "chunk long, bucket long, anchors binary"))
    anchors = materialise(anchors, "cover-anchors")
    lower = (by_chunk.cogroup(anchors.groupBy("chunk"))
             .applyInArrow(send_windows, "chunk long, bucket long, windows binary, least binary")
             .groupBy("bucket").applyInArrow(least_ids, "chunk long, bucket long, windows binary, least binary"))
    both = anchors.unionByName(lower, allowMissingColumns=True)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", text string" if with_text else "")
    return by_chunk.cogroup(both.groupBy("chunk")).applyInArrow(clean, schema)


def _key(one: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """One number for a window's hash and bucket."""
    return tv.mix(one + bucket * np.uint64(0x9E3779B97F4A7C15))


def _window_pair(h: np.ndarray, start: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the windows of ``n`` words at ``start``."""
    one, two = np.zeros(len(start), np.uint64), np.zeros(len(start), np.uint64)
    for k in range(n):
        w = h[start + k]
        one = one * np.uint64(0x9DDFEA08EB382D69) + w
        two = two * np.uint64(0xD6E8FEB86659FD93) + (w ^ (w >> np.uint64(29)))
    return tv.mix(one), tv.mix(two)
