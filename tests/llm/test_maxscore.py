"""Top-k search against brute force."""

import random

import numpy as np
import pytest

from fundlens.llm import maxscore


def brute(rows, k, mod):
    vecs = {}
    for i, v in rows:
        if i is not None and v and all(c is not None and np.isfinite(c) for c in v):
            x = [int(np.floor(64 * float(c))) for c in v]
            vecs[i] = min(vecs.get(i, x), x)
    out = []
    for q in vecs:
        if q % mod == 0:
            s = sorted((-sum(a * b for a, b in zip(vecs[q], vecs[v])), v) for v in vecs if v != q and len(vecs[v]) == len(vecs[q]))
            out += [(q, r, v, -n) for r, (n, v) in enumerate(s[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("vectors_per_block,queries_per_block", [(16384, 1024), (30, 4)])
def test_matches_brute_force(spark, vectors_per_block, queries_per_block, monkeypatch):
    rng = random.Random(6)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, rng.gauss(0, 0.3)]) for _ in range(8)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)] + [(20 * i, None) for i in range(50, 55)]
    rows += [(2000, [0.1, None] * 4), (2020, [float("nan")] * 8), (2040, [float("inf")] * 8), (2060, []), (2080, [0.5] * 3),
             (2081, [0.25] * 3), (None, [0.1] * 8), (40, rows[40][1]), (60, [0.9] * 8), (-20, [1e12] * 8), (3001, [2e12] * 8)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = maxscore.top_k(df, 5, vectors_per_block=vectors_per_block, queries_per_block=queries_per_block)
    small = [r for r in rows if r[0] not in (-20, 3001)]
    fine = df.where("vec_id IS NULL OR vec_id NOT IN (-20, 3001)")
    got = maxscore.top_k(fine, 5, vectors_per_block=vectors_per_block, queries_per_block=queries_per_block)
    assert sorted(tuple(r) for r in got.collect()) == brute(small, 5, 20)


def test_blocks_keep_every_competitive_row():
    rng = np.random.default_rng(3)
    x = np.floor(64 * rng.normal(0, 0.2, (3000, 16)))
    x[:, :3] *= 4
    ids = rng.permutation(3000)
    q = x[:50]
    rows, found, score = maxscore.block_top_k(q, ids[:50], x, ids, 7, chunk=128)
    for i in range(50):
        s = x @ q[i]
        s[ids == ids[i]] = -np.inf
        best = np.lexsort((ids, -s))[:7]
        assert found[rows == i].tolist() == ids[best].tolist() and score[rows == i].tolist() == s[best].tolist()


def test_scores_beyond_float_precision_are_exact():
    x = np.array([[2.0**40, 1.0], [2.0**40, 2.0], [-(2.0**40), 5.0]])
    rows, found, score = maxscore.block_top_k(x[:1], np.array([0]), x, np.array([0, 1, 2]), 2)
    assert found.tolist() == [1, 2] and [int(s) for s in score] == [2**80 + 2, -(2**80) + 5]


def test_no_rows(spark):
    assert maxscore.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
