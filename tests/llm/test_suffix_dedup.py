"""Repeated byte strings against brute force."""

import hashlib
import random

import numpy as np
import pytest

from fundlens.llm import suffix_dedup as sd


def brute(rows, length):
    docs = [(i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, b in docs:
        if i is not None:
            for k in range(len(b) - length + 1):
                s = b[k:k + length]
                least[s] = min(least.get(s, i), i)
    out = []
    for i, b in docs:
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if i is not None and least[b[k:k + length]] < i:
                gone[k:k + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def fixture():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(2, 9)))
    passages = ["".join(word() + " " for _ in range(n)) for n in (5, 9, 10, 12, 30, 90)]
    base = "".join(word() + " " for _ in range(120))
    rows = []
    for i in range(120):
        parts = [word() + " " for _ in range(rng.randrange(0, 60))]
        for p in rng.sample(passages, rng.randrange(0, 4)):
            cut = rng.randrange(0, 30)
            parts.insert(rng.randrange(0, len(parts) + 1), p[cut:])
        rows.append((i, "".join(parts)))
    for i in range(60):                                     # near copies: some edits each
        text = list(base)
        for _ in range(rng.randrange(0, 5)):
            text[rng.randrange(len(text))] = rng.choice("xyzß")
        rows.append((300 + i, "".join(text)))
    rows += [(400, "ab" * 300), (401, "ab" * 60 + "c"), (402, None), (403, ""), (404, rows[3][1]), (405, rows[3][1]),
             (None, base), (405, rows[3][1]), (-7, passages[5]), (406, "x" * 49), (407, "x" * 50), (408, "x" * 51), (405, base)]
    return rows


@pytest.mark.parametrize("length,seed,anchor,per_chunk", [(50, 25, 32, 4 << 20), (50, 25, 32, 4000), (50, 7, 20, 4000),
                                                          (13, 4, 6, 9000), (20, 20, 9, 9000)])
def test_matches_brute_force(spark, length, seed, anchor, per_chunk, monkeypatch):
    rows = fixture()
    monkeypatch.setattr(sd, "SLICE", 5000 if per_chunk == 4000 else sd.SLICE)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, chunk int, id string")
    got = sd.remove_repeats(df, length, seed, anchor, bytes_per_chunk=per_chunk)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, length)


@pytest.mark.parametrize("size", [1 << 16, 700, 33])
def test_contexts_cover_every_string_once(size, monkeypatch):
    monkeypatch.setattr(sd, "SLICE", size)
    rng = np.random.default_rng(1)
    data, offs = rng.integers(97, 100, 3000).astype(np.uint8), np.array([0, 0, 40, 41, 1200, 3000])
    seen = np.zeros(len(data), int)
    for c in sd.contexts(data, offs, 20, 8):
        for s, e in zip(c.start, c.last):
            seen[s:e + 1] += 1
    fits = np.concatenate([np.arange(lo, hi) + 20 <= hi for lo, hi in zip(offs[:-1], offs[1:])])
    assert (seen == fits).all()


def test_ranks_over_many_partitions(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, rng.randrange(50)]), rng.choice([5, 5, 5, rng.randrange(40), 1000 + i])) for i in range(600)]
    df = spark.createDataFrame(rows, "spot long, doc long, key long")
    got = sd.rank(df, ["key"], "test-rank").collect()
    count, least = {}, {}
    for _, doc, key in rows:
        count[key] = count.get(key, 0) + 1
        least[key] = min(least.get(key, 1 << 62), 1 << 62 if doc is None else doc)
    key_of = {r[0]: r[2] for r in rows}
    assert sorted(r["spot"] for r in got) == sorted(r[0] for r in rows if count[r[2]] > 1)
    assert len({(key_of[r["spot"]], r["rank"]) for r in got}) == len({r["rank"] for r in got}) == len({key_of[r["spot"]] for r in got})
    by_rank = [key_of[r["spot"]] for r in sorted(got, key=lambda r: r["rank"])]
    assert by_rank == sorted(by_rank)
    assert all(r["least"] == least[key_of[r["spot"]]] for r in got if least[key_of[r["spot"]]] < 1 << 62)


def test_kept_bytes_are_what_the_digest_covers(spark):
    df = spark.createDataFrame(fixture(), "doc_id long, text string")
    for r in sd.remove_repeats(df, with_kept=True).collect():
        assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"]
        assert len(r["kept"]) == r["n_bytes"] - r["n_removed"]


def test_no_rows(spark):
    assert sd.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
