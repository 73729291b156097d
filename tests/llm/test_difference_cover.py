"""Repeated-window removal against brute force."""

import hashlib
import random
import re

from fundlens.llm import difference_cover


def brute(rows, window=13):
    docs = [(i, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for i, t in rows]
    least = {}
    for i, w in docs:
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k:k + window])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and least[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def fixture():
    rng = random.Random(5)
    vocab = [rng.choice("abcdé") * rng.randrange(1, 4) + str(i) for i in range(300)]
    passages = [[rng.choice(vocab) for _ in range(n)] for n in (12, 13, 14, 20, 60, 200)]
    rows = []
    for i in range(150):
        w = [rng.choice(vocab) for _ in range(rng.randrange(0, 120))]
        for p in rng.sample(passages, rng.randrange(0, 3)):
            at = rng.randrange(0, len(w) + 1)
            w[at:at] = p
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(w)))
    rows += [(200, "same " * 500), (201, "same " * 40), (202, None), (203, ""), (204, rows[3][1]), (205, rows[3][1])]
    rows += [(None, rows[3][1]), (204, rows[3][1]), (-7, " ".join(passages[4])), (206, "a b " * 30)]
    return rows


def test_matches_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, chunk int")
    for per_chunk in (7, 512):
        got = sorted((tuple(r) for r in difference_cover.remove_repeats(df, docs_per_chunk=per_chunk).collect()), key=str)
        assert got == brute(rows)


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert difference_cover.remove_repeats(df).count() == 0


def test_text_is_what_the_digest_covers(spark):
    df = spark.createDataFrame(fixture(), "doc_id long, text string")
    for r in difference_cover.remove_repeats(df, with_text=True).collect():
        assert hashlib.sha256(r["text"].encode()).hexdigest() == r["kept_sha256"]
        assert len(r["text"].split(" ")) == r["n_words"] - r["n_removed"] or not r["text"]
