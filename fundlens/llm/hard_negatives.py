"""Hard negatives by segment summary filtering.

A vector is cut into segments; each segment keeps its mean and its deviation.  For two
vectors the product of a segment's means, plus or minus the product of its deviations
(both times the segment's length), bounds the segment's share of the inner product, so a
short row of summaries bounds the whole score.  Bounds from long segments filter first,
survivors are refined with shorter ones, and only what is left is scored exactly.

Rows stay in blocks that a task holds; the anchors, a hundredth of the rows, travel to
every block in packed batches, so a task keeps no state beyond its block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlens.llm.common import materialise, tasks

ROWS_PER_BLOCK = 131_072
ANCHORS_PER_BATCH = 1024
CHUNK = 4096
WIDTHS = (16, 4)                    # segment widths, refined from left to right
_PACKED = "struct<dim:int,ids:binary,labels:binary,rows:binary,lo:binary,hi:binary>"
_ENDS = np.iinfo(np.int64)


def usable(df: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int = 256,
           noise: Column | None = None) -> DataFrame:
    """(vec_id, label, x): x = floor(scale * component) as double; unusable rows go.

    Dropped are rows whose id, label or vector is null and vectors that are empty or hold a
    null or non-finite component.  A repeated id counts once, with its least (label, vector).
    """
    rows = (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).alias("_v"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("_v").isNotNull()
                   & (F.size("_v") > 0) & F.forall("_v", lambda v: v.isNotNull() & ~F.isnan(v)
                                                   & (F.abs(v.cast("double")) != float("inf"))))
            .select("vec_id", (F.col("label") if noise is None else noise).alias("label"),
                    F.transform("_v", lambda v: F.floor(v.cast("double") * scale).cast("double")).alias("x")))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("r")).select("vec_id", "r.label", "r.x")


def first_copies(rows: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` least ids of each (label, vector): equal rows score alike and ties go to
    smaller ids, so no more of them can be among the first ``keep`` of any anchor."""
    rank = F.row_number().over(Window.partitionBy("label", "x").orderBy("vec_id"))
    return rows.withColumn("_r", rank).where(F.col("_r") <= keep).drop("_r")


# --- one block ----------------------------------------------------------------

def summaries(x: np.ndarray, width: int) -> np.ndarray:
    """Means and deviations of the segments, times sqrt(width): row products bound scores."""
    d = -(-x.shape[1] // width) * width
    seg = np.zeros((len(x), d))
    seg[:, :x.shape[1]] = x
    seg = seg.reshape(len(x), -1, width)
    return np.concatenate([seg.mean(2), seg.std(2)], 1) * np.sqrt(width)


def _bounds(a: np.ndarray, b: np.ndarray, pairs: tuple[np.ndarray, np.ndarray] | None):
    """(lower, upper) score bounds of all row pairs, or of the given ones."""
    n = a.shape[1] // 2
    if pairs is None:
        mean, dev = a[:, :n] @ b[:, :n].T, a[:, n:] @ b[:, n:].T
    else:
        i, j = pairs
        mean = np.einsum("ij,ij->i", a[i, :n], b[j, :n])
        dev = np.einsum("ij,ij->i", a[i, n:], b[j, n:])
    return mean - dev, mean + dev


class Block:
    """Rows of one length, sorted by label, with their summaries."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        order = np.lexsort((ids, -(x * x).sum(1), labels))      # long vectors of a label first
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        self.levels = [summaries(self.x, w) for w in WIDTHS if w < self.x.shape[1]]
        self.norm = float(np.sqrt((self.x * self.x).sum(1)).max(initial=0))
        self.pairs = self.scored = 0


def _exact(q: np.ndarray, x: np.ndarray, pairs, dense: bool) -> np.ndarray:
    """Integer inner products; the extended type holds every score that fits a long."""
    if float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1] >= 2.0**53:
        q, x = q.astype(np.longdouble), x.astype(np.longdouble)
    i, j = pairs
    if dense:
        return (q @ x.T)[i, j]
    out = np.empty(len(i), q.dtype)
    for at in range(0, len(i), 65536):
        s = slice(at, at + 65536)
        out[s] = (q[i[s]] * x[j[s]]).sum(1)
    return out


def block_best(block: Block, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, lo: np.ndarray, hi: np.ndarray,
               k: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor row, range, vec id, score): the first ``k`` block rows of every anchor and range.

    ``lo`` and ``hi`` (anchors x ranges) bound the scores asked for; rows of the anchor's label
    (``same``) or of other labels count, the anchor itself never.  A range's lower bound rises
    to its k-th best score so far, and the bounds of a pair must overlap some range.
    """
    n_ranges = lo.shape[1]
    floor_ = lo.copy()
    levels = [summaries(q, w) for w in WIDTHS if w < q.shape[1]]
    slack = 1e-9 * float(np.sqrt((q * q).sum(1)).max(initial=0)) * block.norm + 1e-6
    best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, q.dtype))     # range row, id, score
    # short steps first: they set the lower bounds that the long ones are filtered by
    steps = np.minimum(np.cumsum([0, 128, 256, 512, 1024, 2048, *[CHUNK] * (len(block.ids) // CHUNK)]), len(block.ids))
    for at, to in zip(steps[:-1], [*steps[1:-1], len(block.ids)]):
        c = slice(at, to)
        if same:
            wanted = (labels[:, None] == block.labels[None, c]) & (ids[:, None] != block.ids[None, c])
        else:
            wanted = labels[:, None] != block.labels[None, c]
        block.pairs += int(wanted.sum())
        least, most = floor_.min(1), hi.max(1)
        dense, pairs = True, None
        for a, b in zip(levels, block.levels):
            if dense:
                low, up = _bounds(a, b[c], None)
                wanted &= (up >= least[:, None] - slack) & (low <= most[:, None] + slack)
                pairs = np.nonzero(wanted)
                dense = len(pairs[0]) > 0.1 * wanted.size       # most are left: one matrix product is cheaper
            else:
                low, up = _bounds(a, b[c], pairs)
                live = (up >= least[pairs[0]] - slack) & (low <= most[pairs[0]] + slack)
                pairs = (pairs[0][live], pairs[1][live])
        pairs = np.nonzero(wanted) if pairs is None else pairs
        block.scored += len(pairs[0])
        score = _exact(q, block.x[c], pairs, dense)
        found = [best]
        for r in range(n_ranges):
            live = (score >= floor_[pairs[0], r]) & (score <= hi[pairs[0], r])
            found.append((pairs[0][live] * n_ranges + r, block.ids[c][pairs[1][live]], score[live]))
        row, vec, s = (np.concatenate(p) for p in zip(*found))
        order = np.lexsort((vec, -s, row))
        row, vec, s = row[order], vec[order], s[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        kept = place < k
        best = (row[kept], vec[kept], s[kept])
        full = place == k - 1
        floor_.reshape(-1)[row[full]] = np.maximum(floor_.reshape(-1)[row[full]], s[full].astype(float))
    row, vec, s = best
    return row // n_ranges, row % n_ranges, vec, s


# --- the job ------------------------------------------------------------------

def _matrix(raw: bytes, dim: int) -> np.ndarray:
    """Packed rows: a type letter, then the values."""
    return np.frombuffer(raw[8:], raw[:8].decode().strip()).reshape(-1, dim).astype(np.float64)


def _packed(x: np.ndarray) -> bytes:
    for kind in ("<i2", "<i4"):
        if np.abs(x).max(initial=0) <= np.iinfo(kind).max:
            break
    else:
        kind = "<f8"
    return kind.ljust(8).encode() + x.astype(kind).tobytes()


def _pack(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of one length in packed batches of at most ``limit``; ``lo`` and ``hi`` come along."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids, labels, x, lo, hi = zip(*held.pop(dim))
            cols = [pa.array([dim], pa.int32()),
                    *[pa.array([v], pa.binary()) for v in (
                        np.array(ids, np.int64).tobytes(), np.array(labels, np.int64).tobytes(),
                        _packed(np.vstack(x)), np.array(lo, float).tobytes(), np.array(hi, float).tobytes())]]
            return pa.RecordBatch.from_arrays(cols, names=["dim", "ids", "labels", "rows", "lo", "hi"])

        for b in batches:
            lows, highs = (b[c].to_pylist() if c in b.schema.names else [()] * len(b) for c in ("lo", "hi"))
            for i, label, x, lo, hi in zip(b["vec_id"].to_pylist(), b["label"].to_pylist(), b["x"], lows, highs):
                v = x.values.to_numpy()
                held.setdefault(len(v), []).append((i, label, v, lo, hi))
                if len(held[len(v)]) >= limit:
                    yield out(len(v))
        for dim in list(held):
            yield out(dim)

    return rows.mapInArrow(pack, _PACKED[len("struct<"):-1].replace(":", " "))


def _search(rows: DataFrame, anchors: DataFrame, n_blocks: int, k: int, same: bool) -> DataFrame:
    """(anchor_id, range, vec_id, score): every block's first ``k`` rows per anchor and range.

    A task first meets a block's rows, then, one after the other, the batches of all anchors.
    """
    blocks = F.sequence(F.lit(0), F.lit(n_blocks - 1))
    meet = (rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")).withColumn("kind", F.lit(0))
            .select("block", "kind", "vec_id", "label", "x", F.lit(None).cast(_PACKED).alias("batch"))
            .unionByName(_pack(anchors.repartition(tasks(rows)).sortWithinPartitions("label"), ANCHORS_PER_BATCH)
                         .select(F.explode(blocks).alias("block"), F.lit(1).alias("kind"),
                                 F.struct("dim", "ids", "labels", "rows", "lo", "hi").alias("batch")), allowMissingColumns=True)
            .repartition(n_blocks, "block").sortWithinPartitions("block", "kind"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, ready = None, {}, {}
        for b in batches:
            numbers, kinds = b["block"].to_numpy(), b["kind"].to_numpy()
            for n in np.unique(numbers):
                mine = np.flatnonzero(numbers == n)
                if n != at:
                    at, held, ready = n, {}, {}
                new = b.take(pa.array(mine[kinds[mine] == 0]))
                if len(new):
                    lists = new["x"]
                    width = np.diff(lists.offsets.to_numpy())
                    flat, edge = lists.values.to_numpy(), lists.offsets.to_numpy()
                    for dim in np.unique(width):
                        which = np.flatnonzero(width == dim)
                        held.setdefault(int(dim), []).append((
                            new["vec_id"].to_numpy()[which], new["label"].to_numpy()[which],
                            flat[edge[which][:, None] + np.arange(dim)]))
                for r in b["batch"].take(pa.array(mine[kinds[mine] == 1])).to_pylist():
                    dim = r["dim"]
                    if dim not in held:
                        continue
                    if dim not in ready:
                        ready[dim] = Block(*(np.concatenate(p) for p in zip(*held[dim])))
                        held[dim] = [()]
                    ids, labels = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
                    q = _matrix(r["rows"], dim)
                    lo, hi = (np.frombuffer(r[c], float).reshape(len(ids), -1) for c in ("lo", "hi"))
                    yield from answers(ready[dim], ids, labels, q, lo, hi)

    def answers(block: Block, ids, labels, q, lo, hi) -> Iterator[pa.RecordBatch]:
        # anchors of one label meet only that label's rows when ``same`` is asked for
        groups = [np.flatnonzero(labels == v) for v in np.unique(labels)] if same else \
            [np.arange(i, min(i + 256, len(ids))) for i in range(0, len(ids), 256)]
        for g in groups:
            part = block
            if same:
                s = slice(*np.searchsorted(block.labels, [labels[g[0]], labels[g[0]] + 1]))
                if s.start == s.stop:
                    continue
                part = Block.__new__(Block)
                part.__dict__.update(ids=block.ids[s], labels=block.labels[s], x=block.x[s], norm=block.norm,
                                     levels=[v[s] for v in block.levels], pairs=0, scored=0)
            row, rng, vec, score = block_best(part, ids[g], labels[g], q[g], lo[g], hi[g], k, same)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[g][row]), pa.array(rng, pa.int32()), pa.array(vec),
                 pa.array([min(max(int(v), _ENDS.min), _ENDS.max) for v in score], pa.int64())],
                names=["anchor_id", "range", "vec_id", "score"])

    return meet.mapInArrow(search, "anchor_id long, range int, vec_id long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of every anchor and range over all blocks, numbered from 1."""
    rank = F.row_number().over(Window.partitionBy("anchor_id", "range").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(df: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, anchor_mod: int = 100, scale: int = 256,
         id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", noise: Column | None = None,
         rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Hard negatives of every anchor and positive.

    Anchors are the rows whose id is divisible by ``anchor_mod``; an anchor's positives are
    its first ``positives`` other rows of the same label, its negatives for a positive the
    first ``negatives`` rows of other labels whose score lies between ``low`` percent of the
    positive's score and that score.  Higher scores come first, ties by smaller id.  Returns
    anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``noise`` replaces the label (columns vec_id and label).  Rows with a null id, label or
    vector, an empty vector, or a null or non-finite component take no part; vectors are
    compared with vectors of their own length; a repeated id counts once, with its least
    (label, vector); scores are exact up to 2^53 and held at a long's ends; other columns are not read;
    an empty table, an anchor without positives and a positive without rows in its range
    give no rows.
    """
    rows = materialise(usable(df, id_col, vec_col, label_col, scale, noise), "negatives-rows")
    n = rows.count()
    n_blocks = max(1, min(tasks(rows), -(-n // 4096)), -(-n // rows_per_block))
    anchors = rows.where(F.col("vec_id") % anchor_mod == 0)
    pool = materialise(first_copies(rows, max(positives + 1, negatives)), "negatives-pool")
    ask = anchors.withColumn("lo", F.array(F.lit(float("-inf")))).withColumn("hi", F.array(F.lit(float("inf"))))
    near = materialise(_first(_search(pool, ask, n_blocks, positives, same=True), positives)
                       .select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
                       "negatives-positives")
    # one range per distinct positive score of an anchor: at most ``positives`` of them
    scores = near.groupBy("anchor_id").agg(F.sort_array(F.collect_set("positive_score")).alias("s"))
    padded = F.concat("s", F.array_repeat(F.lit(None).cast("long"), F.lit(positives) - F.size("s")))
    ask = (anchors.join(scores, anchors["vec_id"] == scores["anchor_id"]).drop("anchor_id")
           .withColumn("lo", F.transform(padded, lambda s: F.coalesce(F.ceil(s.cast("decimal(20,0)") * low / 100).cast("double"), F.lit(float("inf")))))
           .withColumn("hi", F.transform(padded, lambda s: F.coalesce(s.cast("double"), F.lit(float("-inf")))))
           .drop("s"))
    hard = (_first(_search(pool, ask, n_blocks, negatives, same=False), negatives)
            .join(scores, "anchor_id")
            .select("anchor_id", F.element_at("s", F.col("range") + 1).alias("positive_score"),
                    "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")))
    return (near.join(hard, ["anchor_id", "positive_score"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
