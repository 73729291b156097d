"""Exact top-k inner-product search by MaxScore over blocks of postings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlens.llm.common import materialise

VECTORS_PER_BLOCK = 16384
QUERIES_PER_BLOCK = 1024
CHUNK = 2048
_PACKED = "block long, dim int, ids binary, rows binary"


def quantise(df: DataFrame, id_col: str, vec_col: str, scale: int = 64) -> DataFrame:
    """(vec_id, x): ``x`` = floor(scale * component) as double; unusable vectors go.

    Dropped are rows whose id or vector is null and vectors that are empty or hold
    a null or non-finite component.  Rows that repeat an id count once (the least vector).
    """
    x = F.transform(vec_col, lambda v: F.floor(v.cast("double") * scale).cast("double"))
    fine = F.forall(vec_col, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) != float("inf")))
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col))
            .where(F.col("vec_id").isNotNull() & F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & fine)
            .select("vec_id", x.alias("x"))
            .groupBy("vec_id").agg(F.min("x").alias("x")))


def _pack(df: DataFrame, n_blocks: int, rows_per_block: int) -> DataFrame:
    """Rows of one (block, dimension) as one packed row."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[list, list]] = {}

        def out(key):
            ids, rows = held.pop(key)
            return pa.RecordBatch.from_pylist(
                [{"block": key[0], "dim": key[1], "ids": np.array(ids, np.int64).tobytes(),
                  "rows": np.vstack(rows).tobytes()}],
                schema=pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("rows", pa.binary())]))

        for b in batches:
            for block, i, x in zip(b["block"].to_pylist(), b["vec_id"].to_pylist(), b["x"]):
                v = x.values.to_numpy()
                ids, rows = held.setdefault((block, len(v)), ([], []))
                ids.append(i)
                rows.append(v)
                if len(ids) >= 2 * rows_per_block:
                    yield out((block, len(v)))
        for key in list(held):
            yield out(key)

    return (df.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)))
            .repartition(n_blocks, "block").mapInArrow(pack, _PACKED))


def block_top_k(qx: np.ndarray, qid: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int,
                chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best (query row, vec id, score) of one block of postings, exactly.

    Terms are the dimensions; a term's score bound is the largest contribution its
    postings can make.  The first chunk gives every query a threshold; from then on
    the low-bound terms that cannot lift a row over it are non-essential: only the
    essential postings are traversed, and the others are probed, high bounds first,
    for rows still competitive.
    """
    order = np.argsort(ids, kind="stable")
    x, ids = x[order], ids[order]
    # sums of integers stay exact in float64 up to 2^53
    exact = float(np.abs(qx).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1] < 2**53
    if not exact:
        qx, x = (np.array([[int(v) for v in r] for r in a], object) for a in (qx, x))
    hi, lo = x.max(0), x.min(0)
    ub = np.maximum(qx * hi, qx * lo)
    spread = ub - np.minimum(qx * hi, qx * lo)
    terms = np.argsort(-spread.astype(float).mean(0), kind="stable")
    qx, x, ub = qx[:, terms], x[:, terms], ub[:, terms]
    tail = np.zeros((len(qx), x.shape[1] + 1), ub.dtype)
    tail[:, :-1] = np.cumsum(ub[:, ::-1], 1)[:, ::-1]
    best = [(np.zeros(0, np.int64), np.zeros(0, qx.dtype)) for _ in range(len(qx))]
    theta = np.full(len(qx), -np.inf)
    for at in range(0, len(ids), chunk):
        xs, at_ids = x[at:at + chunk], ids[at:at + chunk]
        if np.isinf(theta).any():
            rows, cols, score = _all(qx, xs)
        else:
            # non-essential: the low-bound terms that together cannot reach the threshold
            n_ess = int(np.clip((tail > theta[:, None]).sum(1).max(), 1, x.shape[1]))
            part = qx[:, :n_ess] @ xs[:, :n_ess].T
            rows, cols = np.nonzero(part + tail[:, n_ess:n_ess + 1] >= theta[:, None])
            score = part[rows, cols]
            for t in range(n_ess, x.shape[1], 8):
                if len(rows) > 0.1 * part.size:  # most rows are competitive: probe the rest together
                    part = part + qx[:, t:] @ xs[:, t:].T
                    rows, cols = np.nonzero(part >= theta[:, None])
                    score = part[rows, cols]
                    break
                score = score + (qx[rows, t:t + 8] * xs[cols, t:t + 8]).sum(1)
                live = score + tail[rows, min(t + 8, x.shape[1])] >= theta[rows]
                rows, cols, score = rows[live], cols[live], score[live]
        own = at_ids[cols] != qid[rows]
        rows, cols, score = rows[own], cols[own], score[own]
        edge = np.searchsorted(rows, np.arange(len(qx) + 1))
        for q in np.flatnonzero(np.diff(edge)):
            c = slice(edge[q], edge[q + 1])
            i = np.concatenate([best[q][0], at_ids[cols[c]]])
            s = np.concatenate([best[q][1], score[c]])
            top = np.lexsort((i, -s))[:k] if s.dtype != object else sorted(range(len(s)), key=lambda j: (-s[j], i[j]))[:k]
            best[q] = (i[top], s[top])
            if len(best[q][0]) == k:
                theta[q] = s[top[-1]]
    n = [len(b[0]) for b in best]
    return (np.repeat(np.arange(len(qx)), n), np.concatenate([b[0] for b in best] or [np.zeros(0, np.int64)]),
            np.concatenate([b[1] for b in best] or [np.zeros(0)]))


def _all(qx: np.ndarray, xs: np.ndarray):
    s = qx @ xs.T
    rows, cols = np.divmod(np.arange(s.size), s.shape[1])
    return rows, cols, s.ravel()


def top_k(df: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
          query_mod: int = 20, scale: int = 64, vectors_per_block: int = VECTORS_PER_BLOCK,
          queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """Exact ``k`` best inner products per query over all other rows.

    Queries are the rows whose id is divisible by ``query_mod``.  Returns query_id,
    rank (from 1), vec_id and score; ties go to the smaller id.  Rows and queries are
    packed into blocks; every query block meets every row block once, each meeting
    keeps ``k`` rows a query, and one window per query merges the shards.  Vectors are
    compared only with vectors of the same length; nulls, non-finite components and
    empty vectors take no part; a repeated id counts once; scores beyond a long are held at
    its ends.  An empty table gives no rows.
    """
    x = materialise(quantise(df, id_col, vec_col, scale), "maxscore-rows")
    n, n_query = x.agg(F.count(F.lit(1)), F.count(F.when(F.col("vec_id") % query_mod == 0, 1))).first()
    n_blocks, q_blocks = max(1, -(-n // vectors_per_block)), max(1, -(-n_query // queries_per_block))
    shards = _pack(x, n_blocks, vectors_per_block)
    asked = _pack(x.where(F.col("vec_id") % query_mod == 0), q_blocks, queries_per_block)
    meet = (asked.select(F.col("block").alias("q"), "dim", F.col("ids").alias("qids"), F.col("rows").alias("qrows"))
            .join(shards.withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long")))),
                  ["q", "dim"])
            .repartition(max(1, n_blocks * q_blocks), "q", "block"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                qid, ids = np.frombuffer(r["qids"], np.int64), np.frombuffer(r["ids"], np.int64)
                q, i, s = block_top_k(np.frombuffer(r["qrows"]).reshape(len(qid), -1), qid,
                                      np.frombuffer(r["rows"]).reshape(len(ids), -1), ids, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qid[q]), pa.array(i), pa.array([min(max(int(v), -2**63), 2**63 - 1) for v in s], pa.int64())],
                    names=["query_id", "vec_id", "score"])

    found = meet.mapInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
