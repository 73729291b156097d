"""Packing: ids against the tokenizer itself, and the placements as a whole."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fundlens.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


TRICKY = ["", " ", "Don't they're I'll 'tis", "a\x1cb \x1fc", "x <|endoftext|> y<|startoftext|>", "Émile’s  naïve café x",
          "é café ́x", "ΣΑΣ ΟΔΟΣ ǅ İstanbul ß ẞ", "12345 ½ ² Ⅷ a1b2", "!!! ### a|b|c, (d).", "日本語 テキスト 한국어",
          "tab\tnew\nline\r\n\x0b\x0c end", "_under_score_ __x__ a_b", "`q` ~t~ {b} [x]", "'", "''s 'S it's'", "👍🏽 ok👍",
          "z" * 5000, "ÀÖØöøÿ÷×", "a\x85b c", "\x00 nul", "word," * 200]


def test_chunks_give_the_ids_of_the_whole_text():
    rng = random.Random(1)
    texts = TRICKY + [rng.choice([" ", "\n", ""]).join(rng.sample(TRICKY, 4)) for _ in range(200)]
    got = packing.Encoder(PATH)(texts)
    for t, g in zip(texts, got):
        assert np.frombuffer(g, "<u4").tolist() == whole(t), t[:80]


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_CHUNKS", 5)
    enc = packing.Encoder(PATH)
    for _ in range(3):
        for t in TRICKY:
            assert np.frombuffer(enc([t])[0], "<u4").tolist() == whole(t)


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_everything_once(seed):
    rng = random.Random(seed)
    hist = {rng.randrange(1, 257): rng.randrange(1, 900) for _ in range(rng.randrange(1, 120))}
    used, ranks = {}, {}
    for length, rank, count, first, offset in packing.plan(hist, 256):
        assert ranks.get(length, 0) == rank
        ranks[length] = rank + count
        for s in range(first, first + count):
            assert used.get(s, 0) == offset
            used[s] = offset + length
    assert ranks == hist and max(used.values()) <= 256
    assert sorted(used) == list(range(len(used)))


def test_plan_of_one_length_fills_packs():
    assert max(p[3] + p[2] for p in packing.plan({1000: 41}, 4096)) == 11


def test_pieces_and_sequences(spark):
    rows = [(i, t, "x") for i, t in enumerate(TRICKY)] + [(100, None, "y"), (None, "null id", "z"), (3, TRICKY[3], "x")]
    rows += [(200 + i, "the quick brown fox " * n, "q") for i, n in enumerate([1, 100, 1023, 1024, 1500, 7000])]
    df = spark.createDataFrame(rows, "doc_id long, text string, offset string")
    out = packing.pack_documents(df, PATH).collect()
    by_doc, by_seq = {}, {}
    for r in out:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for i, t, _ in rows:
        ids = np.array(whole(t) + [2], "<u4")
        want = {(s, min(4096, len(ids) - s), zlib.crc32(ids[s:s + 4096].tobytes()), len(ids)) for s in range(0, len(ids), 4096)}
        assert {tuple(r)[1:5] for r in by_doc[i]} == want
    assert len(out) == sum(len({tuple(r) for r in v}) for v in by_doc.values())
    for v in by_seq.values():
        at = 0
        for r in sorted(v, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096


def test_no_rows(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
