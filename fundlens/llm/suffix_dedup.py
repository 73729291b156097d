"""Repeated byte strings by distributed prefix doubling.

Positions get ranks: equal ranks mean equal first bytes.  Spark sorts positions by the rank
pair (own rank, rank of the position h bytes on), which ranks them by 2 h bytes, and again
at growing offsets until the wanted length is reached; a position whose rank is unique, or
whose partner's is, takes no further part.  At the end a position's class is known, and with
it the least document that holds the same string.

Only positions that can matter are sorted.  A string's minimizer is the anchor (a shorter
string in it) of least hash; strings that repeat share it.  Strings in a row with one
minimizer form a context.  Contexts whose anchor occurs once go at the start; equal contexts,
as copies make them, collapse to one with its least document; and contexts that are the only
one of their anchor need no sorting either.  What remains, mostly the surroundings of the
places where copies differ, is ranked once for every distinct context.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm.common import discard, materialise, tasks
from fundlens.llm.difference_cover import _address, _joined, _messages, _split
from fundlens.llm.textvec import mix

LENGTH, SEED, ANCHOR = 50, 25, 32
BYTES_PER_CHUNK = 4 << 20
CHUNKS_PER_BUCKET = 16
SLICE = 1 << 15                       # string starts hashed at once, in the processor's cache
_KEY = np.uint64(24)                  # first ranks are 40-bit hashes, always compared in pairs
_NO_ID = np.iinfo(np.int64).max
_P = 0xD6E8FEB86659FD93
_BYTE = np.random.default_rng(20240331).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POW, _INV = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(1 << 17, base % (1 << 64), np.uint64)]))
              for base in (_P, pow(_P, -1, 1 << 64)))


def steps(length: int, seed: int) -> tuple[list[int], list[int]]:
    """(offsets of the doublings, distances from a string's start where the first pairs stand)."""
    offsets, h = [], seed
    while h < length:
        offsets.append(min(h, length - h))
        h += offsets[-1]
    need = {0}
    for o in offsets[1:]:
        need |= {n + o for n in need}
    return offsets, sorted(need)


class _Hashes:
    """Hashes of runs of bytes, from one prefix sum of a polynomial modulo 2^64."""

    def __init__(self, part: np.ndarray):
        self.total = np.empty(len(part) + 1, np.uint64)
        self.total[0] = 0
        terms = _BYTE[part]
        terms *= _POW[:len(part)]
        np.cumsum(terms, out=self.total[1:])

    def short(self, size: int) -> np.ndarray:
        """16 bits of the hash of every run of ``size`` bytes, in the upper half of 32."""
        h = self.total[size:] - self.total[:-size]
        h *= _INV[:len(h)]
        h >>= np.uint64(48)
        h <<= np.uint64(16)
        return h.astype(np.uint32)

    def at(self, place: np.ndarray, size: int) -> np.ndarray:
        return mix((self.total[place + size] - self.total[place]) * _INV[place])


def _least_of(x: np.ndarray, n: int) -> np.ndarray:
    """Least value of every ``n`` in a row."""
    width = 1
    while width * 2 <= n:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[:len(x) - (n - width)], x[n - width:]) if n > width else x


@dataclass
class Contexts:
    """Runs of strings with one minimizer: first and last start, document row, anchor and content hash."""

    start: np.ndarray
    last: np.ndarray
    doc: np.ndarray
    anchor: np.ndarray
    content: np.ndarray


def _texts(t: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """(rows in a fixed order, their bytes in a row, offsets of the rows)."""
    t = t.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    texts = t["text"].combine_chunks().fill_null("").cast(pa.large_binary())
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_binary())
    _, offs, data = texts.buffers()
    offs = np.frombuffer(offs, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return t, data[offs[0]:offs[-1]], offs - offs[0]


def contexts(data: np.ndarray, offs: np.ndarray, length: int, anchor: int) -> Iterator[Contexts]:
    """Contexts of all texts, a slice of starts at a time; a slice's end may cut one in two."""
    places = np.arange(SLICE + length, dtype=np.uint32)
    for lo in range(0, len(data) - length + 1, SLICE):
        h = _Hashes(data[lo:lo + SLICE + length - 1])
        # the least hash of a string's anchors, of equal ones the first: hash and place compare as one number
        anchors = h.short(anchor)
        anchors |= places[:len(anchors)]
        minimizer = _least_of(anchors, length - anchor + 1).astype(np.uint16)
        # a context opens where the minimizer changes or a text begins, and no string crosses a text's end
        new = np.ones(len(minimizer) + 1, bool)
        new[1:-1] = minimizer[1:] != minimizer[:-1]
        fits = np.ones(len(minimizer) + 1, bool)
        fits[-1] = False
        for end in (offs[np.searchsorted(offs, lo, "right"):np.searchsorted(offs, lo + len(minimizer) + length) + 1] - lo).tolist():
            fits[max(end - length + 1, 0):max(end, 0)] = False
        new[1:] |= ~fits[:-1]
        s = np.flatnonzero(new[:-1] & fits[:-1])
        e = np.flatnonzero((new[1:] | ~fits[1:]) & fits[:-1])
        if not len(s):
            continue
        content = mix(h.at(s, length) * np.uint64(0x9E3779B97F4A7C15) + h.at(e, length) * np.uint64(0xC2B2AE3D27D4EB4F)
                      + (e - s).astype(np.uint64))
        yield Contexts(s + lo, e + lo, np.searchsorted(offs, s + lo, "right") - 1, h.at(minimizer[s].astype(np.int64), anchor), content)


def _id(address: np.ndarray, content: np.ndarray, n_buckets: int) -> np.ndarray:
    """A context's number; its remainder by ``n_buckets`` is the bucket of its anchor."""
    nb = np.uint64(n_buckets)
    bucket = address >> np.uint64(32)
    high = (mix(content + address * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(2)) // nb
    return (high * nb + bucket).astype(np.int64)


# --- ranks --------------------------------------------------------------------

def rank(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows (spot, doc, keys) whose keys occur again, with ``rank`` and the class's least ``doc``.

    A range-partitioned sort by keys and row, so that a hot key is spread over partitions; each
    partition numbers its groups from the place of their first row, and one summary row a
    partition tells which groups go on in the next.
    """
    types = ", ".join(f"{k} long" for k in keys)
    fields = ["spot", "doc", *keys]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, held, place, least, part = 0, None, 0, None, 0

        def out(t: pa.Table, places, leasts, last: bool) -> Iterator[pa.RecordBatch]:
            n = len(t)
            yield from pa.table([*(t[c] for c in fields), pa.array(np.full(n, part, np.int32)), pa.array(places, pa.int64()),
                                 pa.array(leasts, pa.int64()), pa.array(np.full(n, last))],
                                names=[*fields, "part", "place", "least", "last"]).to_batches()

        for b in batches:
            if not len(b):
                continue
            part = b["part"][0].as_py()
            t = pa.table([b[c] for c in fields], names=fields)
            fresh = held is None
            t = t if fresh else pa.concat_tables([held, t])
            n = len(t)
            new = np.zeros(n, bool)
            new[0] = fresh or place == index            # does the held row open its group?
            for k in keys:
                v = t[k].to_numpy()
                new[1:] |= v[1:] != v[:-1]
            doc = t["doc"].fill_null(_NO_ID).to_numpy()
            if fresh:
                least = int(doc[0])
            group = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            places = np.where(group < 0, place, index + group)
            leasts = np.where(group < 0, least, doc[np.maximum(group, 0)])
            again = ~(new[:-1] & new[1:]) | (places[:-1] == 0)
            keep = pa.array(np.flatnonzero(again))
            yield from out(t.take(keep), places[:-1][again], leasts[:-1][again], False)
            held, index, place, least = t.slice(n - 1), index + n - 1, int(places[-1]), int(leasts[-1])
        if held is not None:
            yield from out(held, [place], [least], True)

    order = [*map(F.col, keys), F.col("doc").asc_nulls_last(), F.col("spot")]
    ordered = (rows.select(*fields).repartitionByRange(tasks(rows), *order).sortWithinPartitions(*order)
               .withColumn("part", F.spark_partition_id()))
    numbered = materialise(ordered.mapInArrow(
        number, f"spot long, doc long, {types}, part int, place long, least long, last boolean"), name, tidy=True)
    key = F.struct(*keys)
    first, last = F.col("place") == 0, F.col("last")
    summary = numbered.groupBy("part").agg(
        F.max(F.when(first, key)).alias("first"), F.count_if(first).alias("n"), F.min(F.when(first, F.col("least"))).alias("least"),
        F.max(F.when(last, key)).alias("last"), F.max(F.when(last, F.col("place"))).alias("place"),
        F.max(F.when(last, F.col("least"))).alias("last_least"), F.count_if(~first).alias("rest"))
    # the rows of the last group that stand before its last row were kept only if it has several
    tail = {r["part"]: r["c"] for r in numbered.alias("r").join(
        F.broadcast(numbered.where("last").select(F.col("part").alias("p"), F.col("place").alias("at"))),
        F.expr("part = p AND place = at")).groupBy("part").agg(F.count(F.lit(1)).alias("c")).collect()}
    table, carry, chains = [], None, []
    for r in sorted(summary.collect(), key=lambda r: r["part"]):
        if carry is None or carry["key"] != r["first"]:
            carry = {"key": r["first"], "rank": r["part"] << 40, "least": r["least"], "n": 0}
        carry["n"] += r["n"]
        head = end = carry
        if r["place"] > 0:
            end = carry = {"key": r["last"], "rank": (r["part"] << 40) + r["place"], "least": r["last_least"], "n": tail[r["part"]]}
        chains.append((r["part"], head, end))
    table = [(p, h["rank"], h["least"], h["n"] == 1, e["n"] == 1) for p, h, e in chains]
    edges = rows.sparkSession.createDataFrame(table, "p int, first_rank long, first_least long, first_once boolean, last_once boolean")
    out = numbered.join(F.broadcast(edges), numbered["part"] == edges["p"])
    return (out.where(~(first & F.col("first_once")) & ~(last & ~first & F.col("last_once")))
            .select("spot", "doc", F.when(first, F.col("first_rank")).otherwise(F.shiftleft(F.col("part").cast("long"), 40)
                                                                                     + F.col("place")).alias("rank"),
                    F.when(first, F.col("first_least")).otherwise(F.col("least")).alias("least")))


def doubled(rows: DataFrame, offsets: list[int], done: DataFrame | None = None) -> DataFrame:
    """(spot, doc, rank, least) of the strings that stand more than once: first rank pairs
    (columns ``a`` and ``b``), doubled at the further offsets.  A spot is a place in a context;
    spots of one context that are o bytes apart differ by o.  ``done`` is the scratch table
    that only the first sort reads."""
    ranked = rank(rows, ["a", "b"], "suffix-rank-0")
    if done is not None:
        discard(done)
    for i, o in enumerate(offsets):
        left = ranked.where("doc IS NOT NULL") if i + 1 == len(offsets) else ranked
        right = ranked.select((F.col("spot") - o).alias("spot"), F.col("rank").alias("b"))
        pairs = left.select("spot", "doc", F.col("rank").alias("a")).join(right, "spot")
        ranked = rank(pairs, ["a", "b"], f"suffix-rank-{i + 1}")
    return ranked


# --- the job ------------------------------------------------------------------

def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, anchor: int = ANCHOR, id_col: str = "doc_id",
                   text_col: str = "text", bytes_per_chunk: int = BYTES_PER_CHUNK, with_kept: bool = False) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts in a document with a smaller id.

    Texts are UTF-8 bytes, matches stay within a document and are judged on the input.
    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and, on
    request, the kept bytes.  Null and empty texts have no bytes; texts shorter than ``length``
    stay whole; a row with a null id keeps all its bytes and takes none from others; rows that
    repeat an id are judged each on its own, by that id; an empty table gives no rows; other
    columns are not read.  Strings are compared by hashes: pairs of 40 bits each for two times
    ``seed`` bytes, exact ranks from then on, and 62 bits and the anchor's bucket for contexts.
    """
    if not anchor <= length or not seed <= length:
        raise ValueError("anchor and seed are at most as long as the strings compared")
    offsets, need = steps(length, seed)
    room = 2 * length                                   # spots of a context
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n_chunks = max(1, -(-total // bytes_per_chunk))
    n_buckets = max(1, -(-n_chunks // CHUNKS_PER_BUCKET))
    chunked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)))
    by_chunk = chunked.groupBy("chunk")

    def chunk_of(t: pa.Table) -> int:
        return t["chunk"][0].as_py() if len(t) else 0

    def ids_of(t: pa.Table) -> np.ndarray:
        return t["doc_id"].combine_chunks().fill_null(_NO_ID).to_numpy(zero_copy_only=False)

    def send_anchors(t: pa.Table) -> pa.Table:
        _, data, offs = _texts(t)
        seen = [np.unique(_address(c.anchor, n_buckets)) for c in contexts(data, offs, length, anchor)]
        address = np.unique(np.concatenate(seen)) if seen else np.zeros(0, np.uint64)
        rows = [(chunk_of(t), b, x.astype("<u4").tobytes()) for b, x in
                _split(address >> np.uint64(32), address & np.uint64(0xFFFFFFFF))]
        return _messages(rows, ["chunk", "bucket", "anchors"])

    def repeated(t: pa.Table) -> pa.Table:
        value, row = _joined(t, "anchors", "<u4")
        order = np.argsort(value, kind="stable")
        value, row = value[order], row[order]
        same = np.zeros(len(value) + 1, bool)
        same[1:-1] = value[1:] == value[:-1]
        twice = same[1:] | same[:-1]
        chunk = t["chunk"].to_numpy()
        rows = [(int(chunk[r]), t["bucket"][0].as_py(), x.tobytes()) for r, x in _split(row[twice], value[twice])]
        return _messages(rows, ["chunk", "bucket", "anchors"])

    def send_contexts(t: pa.Table, answers: pa.Table) -> pa.Table:
        """Distinct contexts of repeated anchors, with their least document and the place of its occurrence."""
        names = ["chunk", "bucket", "ids", "anchors", "least", "place", "size"]
        if not len(t):
            return _messages([], names)
        value, row = _joined(answers, "anchors", "<u4")
        known = (answers["bucket"].to_numpy()[row].astype(np.uint64) << np.uint64(32)) | value
        t, data, offs = _texts(t)
        ids = ids_of(t)
        found = [(_address(c.anchor, n_buckets), c.content, ids[c.doc], c.start, c.last - c.start + 1)
                 for c in contexts(data, offs, length, anchor)]
        address, content, doc, place, size = (np.concatenate(p) for p in zip(*found)) if found else [np.zeros(0, np.uint64)] * 5
        ordered = np.sort(address)
        known = np.unique(np.concatenate([known, ordered[1:][ordered[1:] == ordered[:-1]]]))
        live = known[np.minimum(np.searchsorted(known, address), max(len(known) - 1, 0))] == address if len(known) else np.zeros(len(address), bool)
        address, doc, place, size = address[live], doc[live], place[live], size[live]
        number, first = np.unique(_id(address, content[live], n_buckets), return_index=True)   # rows go by id: the first is the least
        address = address[first]
        rows = [(chunk_of(t), b, *(c.astype(k).tobytes() for c, k in zip(cols, ("<i8", "<u4", "<i8", "<u4", "<u2")))) for b, *cols in
                _split(address >> np.uint64(32), number, address & np.uint64(0xFFFFFFFF), doc[first], place[first], size[first])]
        return _messages(rows, names)

    def ask_open(t: pa.Table) -> pa.Table:
        """Contexts that share their anchor with others, each asked of one chunk with its least document."""
        (number, row), *rest = (_joined(t, c, k) for c, k in (("ids", "<i8"), ("anchors", "<u4"), ("least", "<i8"), ("place", "<u4"), ("size", "<u2")))
        value, least, place, size = (r[0] for r in rest)
        chunk = t["chunk"].to_numpy()[row] if len(row) else np.zeros(0, np.int64)
        order = np.lexsort((chunk, least, number, value))
        number, value, chunk, place, size = (c[order] for c in (number, value, chunk, place, size))
        first = np.ones(len(number), bool)
        first[1:] = (number[1:] != number[:-1]) | (value[1:] != value[:-1])
        _, back, n = np.unique(value[first], return_inverse=True, return_counts=True)
        several = np.flatnonzero(first)[n[back] > 1] if len(value) else np.zeros(0, np.int64)
        rows = [(int(c), t["bucket"][0].as_py(), *(x.tobytes() for x in cols))
                for c, *cols in _split(chunk[several], number[several], place[several], size[several])]
        return _messages(rows, ["chunk", "bucket", "ids", "place", "size"])

    def positions(t: pa.Table, asked: pa.Table) -> pa.Table:
        """First rank pairs of the strings in the contexts asked for; rows without b give a context's number."""
        names = ["spot", "doc", "a", "b"]
        numbers, places, sizes = (_joined(asked, c, k)[0].astype(np.int64) for c, k in (("ids", "<i8"), ("place", "<u4"), ("size", "<u2")))
        out, base = [], chunk_of(t) << 28
        if len(t) and len(numbers):
            t, data, offs = _texts(t)
            docs_ = ids_of(t)[np.searchsorted(offs, places, "right") - 1]
        for lo in range(0, len(numbers) if len(t) else 0, 4096):
            number, place, n, doc = (c[lo:lo + 4096] for c in (numbers, places, sizes, docs_))
            slot = np.arange(lo, lo + len(number))
            wide = int(n.max()) - 1 + length
            terms = _BYTE[data[np.minimum(place[:, None] + np.arange(wide), len(data) - 1)]] * _POW[:wide]
            total = np.zeros((len(number), wide + 1), np.uint64)
            np.cumsum(terms, axis=1, out=total[:, 1:])
            which = np.repeat(np.arange(len(number)), n)
            off = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            if len(need) > 1:
                pair = np.unique((which[:, None] * room + off[:, None] + np.array(need)).ravel())
                which, off = pair // room, pair % room

            def first_rank(at: np.ndarray) -> pa.Array:
                return pa.array((mix((total[which, at + seed] - total[which, at]) * _INV[at]) >> _KEY).view(np.int64))

            two = first_rank(off + offsets[0]) if offsets else pa.array(np.zeros(len(off), np.int64))
            out += [pa.table([pa.array((base + slot[which]) * room + off), pa.array(doc[which], mask=off >= n[which]),
                              first_rank(off), two], names=names),
                    pa.table([pa.array((base + slot) * room), pa.nulls(len(slot), pa.int64()), pa.array(number),
                              pa.nulls(len(slot), pa.int64())], names=names)]
        return pa.concat_tables(out) if out else pa.table([pa.array([], pa.int64())] * 4, names=names)

    def deliver(t: pa.Table, low: pa.Table) -> pa.Table:
        """To each chunk: the least document of its contexts, and of single strings in them."""
        names = ["chunk", "bucket", "ids", "best", "strings", "offs", "least"]
        (number, row), (least, _) = (_joined(t, c, k) for c, k in (("ids", "<i8"), ("least", "<i8")))
        if not len(number):
            return _messages([], names)
        every, back = np.unique(number, return_inverse=True)
        best = np.full(len(every), _NO_ID)
        np.minimum.at(best, back, least)
        low_id, low_off, low_doc = (low[c].to_numpy().astype(k) for c, k in (("id", np.int64), ("off", np.int32), ("least", np.int64)))
        order = np.lexsort((low_off, low_id))
        low_id, low_off, low_doc = low_id[order], low_off[order], low_doc[order]
        lower = best[back] < least
        sent = {int(r): (i.tobytes(), d.tobytes()) for r, i, d in _split(row[lower], number[lower], best[back][lower])}
        lo, hi = np.searchsorted(low_id, number), np.searchsorted(low_id, number, "right")
        n = hi - lo
        pick = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        single = {int(r): (i.tobytes(), o.tobytes(), d.tobytes())
                  for r, i, o, d in _split(np.repeat(row, n), low_id[pick], low_off[pick], low_doc[pick])}
        chunk, bucket = t["chunk"].to_numpy(), t["bucket"][0].as_py()
        rows = [(int(chunk[r]), bucket, *sent.get(r, (b"", b"")), *single.get(r, (b"", b"", b""))) for r in sorted({*sent, *single})]
        return _messages(rows, names)

    kept_names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:5 + with_kept]
    kept_types = [pa.int64()] * 4 + [pa.string(), pa.binary()]

    def clean(t: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(t):
            return pa.table([pa.array([], k) for k in kept_types[:len(kept_names)]], names=kept_names)
        t, data, offs = _texts(t)
        ids = ids_of(t)
        runs = [(c.start, c.last, c.doc, _id(_address(c.anchor, n_buckets), c.content, n_buckets))
                for c in contexts(data, offs, length, anchor)]
        start, last, doc, number = (np.concatenate(p) for p in zip(*runs)) if runs else [np.zeros(0, np.int64)] * 4
        told, _ = _joined(answers, "ids", "<i8")
        string, off, least = (_joined(answers, c, k)[0] for c, k in (("strings", "<i8"), ("offs", "<i4"), ("least", "<i8")))
        # only contexts that stand twice here or that an answer names can lose anything
        ordered = np.sort(number)
        named = np.unique(np.concatenate([ordered[1:][ordered[1:] == ordered[:-1]], told, string]))
        live = named[np.minimum(np.searchsorted(named, number), max(len(named) - 1, 0))] == number if len(named) else np.zeros(len(number), bool)
        start, last, doc, number = start[live], last[live], doc[live], number[live]
        every, first, back = np.unique(number, return_index=True, return_inverse=True)
        best = ids[doc[first]]
        np.minimum.at(best, np.searchsorted(every, told), _joined(answers, "best", "<i8")[0])
        own = ids[doc]
        gone = (best[back] < own) & (own != _NO_ID)
        change = np.zeros(len(data) + length + 1, np.int32)
        np.add.at(change, start[gone], 1)
        np.add.at(change, last[gone] + length, -1)
        order = np.argsort(string, kind="stable")
        string, off, least = string[order], off[order], least[order]
        lo, hi = np.searchsorted(string, number), np.searchsorted(string, number, "right")
        n = hi - lo
        pick = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at, who = np.repeat(start, n) + off[pick], np.repeat(own, n)
        at = at[(least[pick] < who) & (who != _NO_ID)]
        np.add.at(change, at, 1)
        np.add.at(change, at + length, -1)
        removed = np.cumsum(change)[:len(data)] > 0
        opens = removed.copy()
        opens[1:] &= ~removed[:-1]
        opens[offs[:-1][np.diff(offs) > 0]] = removed[offs[:-1][np.diff(offs) > 0]]
        n_removed, n_spans = (np.concatenate([[0], np.cumsum(v)]) for v in (removed, opens))
        out = []
        for i, name in enumerate(t["doc_id"].to_pylist()):
            lo, hi = int(offs[i]), int(offs[i + 1])
            kept = data[lo:hi][~removed[lo:hi]].tobytes()
            out.append((name, hi - lo, int(n_removed[hi] - n_removed[lo]), int(n_spans[hi] - n_spans[lo]),
                        hashlib.sha256(kept).hexdigest(), kept)[:len(kept_names)])
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kept_types)], names=kept_names)

    messages = "chunk long, bucket long, anchors binary"
    anchors = materialise(by_chunk.applyInArrow(send_anchors, messages).groupBy("bucket").applyInArrow(repeated, messages),
                          "suffix-anchors", tidy=True)
    met = materialise(by_chunk.cogroup(anchors.groupBy("chunk")).applyInArrow(
        send_contexts, "chunk long, bucket long, ids binary, anchors binary, least binary, place binary, size binary"),
        "suffix-contexts", tidy=True)
    discard(anchors)
    asked = met.groupBy("bucket").applyInArrow(ask_open, "chunk long, bucket long, ids binary, place binary, size binary")
    spots = materialise(by_chunk.cogroup(asked.groupBy("chunk")).applyInArrow(
        positions, "spot long, doc long, a long, b long"), "suffix-positions", tidy=True)
    number = materialise(spots.where("b IS NULL").select(F.expr(f"spot div {room}").alias("context"), F.col("a").alias("id")),
                         "suffix-numbers", tidy=True)
    low = (doubled(spots.where("b IS NOT NULL"), offsets[1:], spots).where("least < doc")
           .withColumn("context", F.expr(f"spot div {room}")).join(number, "context")
           .select("id", (F.col("spot") % room).cast("int").alias("off"), "least", F.pmod("id", F.lit(n_buckets)).alias("bucket")))
    told = met.groupBy("bucket").cogroup(low.groupBy("bucket")).applyInArrow(
        deliver, "chunk long, bucket long, ids binary, best binary, strings binary, offs binary, least binary")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_kept else "")
    return by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(clean, schema)
