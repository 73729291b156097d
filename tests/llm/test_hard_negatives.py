"""Hard negatives against brute force."""

import random

import numpy as np
import pytest

from fundlens.llm import hard_negatives as hn


def brute(rows, k=5, low=80, mod=100):
    vecs = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(c is not None and np.isfinite(c) for c in v):
            r = (label, [int(np.floor(256 * float(c))) for c in v])
            vecs[i] = min(vecs.get(i, r), r)
    out = []
    for a, (label, x) in vecs.items():
        if a % mod:
            continue
        scores = [(-sum(p * q for p, q in zip(x, y)), i, other) for i, (other, y) in vecs.items()
                  if i != a and len(y) == len(x)]
        for s, pos, _ in sorted(r for r in scores if r[2] == label)[:k]:
            hard = sorted(r for r in scores if r[2] != label and -low * s <= -100 * r[0] <= -100 * s)[:k]
            out += [(a, pos, rank, i, -s, -t) for rank, (t, i, _) in enumerate(hard, 1)]
    return sorted(out)


def fixture(dim=24):
    rng = random.Random(8)
    centres = [[rng.gauss(0, 0.3) for _ in range(dim)] for _ in range(6)]
    rows = [(10 * i, [c + rng.gauss(0, 0.15) for c in rng.choice(centres)], rng.randrange(4)) for i in range(400)]
    rows += [(5001 + i, rows[3][1], i % 3) for i in range(60)]                      # one common vector
    rows += [(7000, None, 1), (7100, [0.1, None] * 12, 1), (7200, [float("nan")] * dim, 1), (7300, [], 2),
             (7400, [float("inf")] * dim, 2), (7500, rows[5][1], None), (None, rows[5][1], 1), (7600, [0.5] * 3, 1),
             (7601, [0.4] * 3, 1), (7602, [0.35] * 3, 2), (100, rows[10][1], 1), (200, [0.2] * dim, 0),
             (7700, [0.0] * dim, 1), (-100, [-c for c in rows[7][1]], 3)]
    return rows


@pytest.mark.parametrize("rows_per_block,dim", [(131072, 24), (40, 24), (60, 5)])
def test_matches_brute_force(spark, rows_per_block, dim):
    rows = [(i, v[:dim] if v else v, lab) for i, v, lab in fixture()]
    df = spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in rows],
                               "vec_id long, embedding array<double>, label int, x string, score int")
    got = sorted(tuple(r) for r in hn.mine(df, rows_per_block=rows_per_block).collect())
    assert got == brute(rows) and len(got) > 100


def test_summaries_bound_every_score():
    rng = np.random.default_rng(2)
    x, q = np.floor(256 * rng.normal(0.1, 0.3, (300, 30))), np.floor(256 * rng.normal(0, 0.4, (20, 30)))
    s = q @ x.T
    for width in (4, 16, 30):
        low, up = hn._bounds(hn.summaries(q, width), hn.summaries(x, width), None)
        assert (low <= s + 1e-6).all() and (up >= s - 1e-6).all()


def test_filter_skips_rows_whose_segments_are_far():
    rng = np.random.default_rng(4)
    level = np.repeat(rng.normal(0, 1, (30000, 4)), 16, axis=1)            # segments of one level each
    x = np.floor(256 * (level + rng.normal(0, 0.02, level.shape)))
    labels = rng.integers(0, 2, len(x))
    block = hn.Block(np.arange(len(x)), labels, x)
    q, no = x[:10], np.full((10, 1), -np.inf)
    row, _, vec, score = hn.block_best(block, np.arange(10), labels[:10], q, no, -no, 5, True)
    assert block.scored < 0.3 * block.pairs
    for i in range(10):
        s = x @ q[i]
        s[(labels != labels[i]) | (np.arange(len(x)) == i)] = -np.inf
        assert score[row == i].tolist() == np.sort(s)[::-1][:5].tolist()


def test_no_rows(spark):
    assert hn.mine(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
