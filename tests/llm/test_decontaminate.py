"""Template windows against brute force, and what slots must do."""

import random

import numpy as np

from fundlens.llm import decontaminate as dc


def run(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return {r["doc_id"]: (r["contaminated"], list(r["items"]), round(r["share"], 6)) for r in
            dc.decontaminate(d.selectExpr("*", "1 AS item_id", "'h' AS hash"), b, **kw).collect()}


def tokens(text):
    h, _, _ = dc.Templates()(text)
    return h.tolist()


def brute(docs, items, window=8):
    """Shares of template windows found (no slots in these texts)."""
    out = {}
    for i, t in docs:
        h = tokens(t or "")
        found, best = [], 0.0
        for item, text in items:
            q = tokens(text)
            size = min(window, len(q))
            if size < dc.SHORTEST or t is None:
                continue
            mine = {tuple(h[k:k + size]) for k in range(len(h) - size + 1)}
            wins = [tuple(q[k:k + size]) for k in range(len(q) - size + 1)]
            share = sum(w in mine for w in wins) / len(wins)
            if share >= 0.5:
                found.append(item)
                best = max(best, share)
        out[i] = (bool(found), sorted(found), round(best, 6))
    return out


def test_matches_brute_force(spark):
    rng = random.Random(9)
    vocab = [f"{a}{b}{c}" for a in "bcdf" for b in "aeiou" for c in "lmnr"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(3, 40)))) for i in range(25)]
    docs = []
    for i in range(120):
        w = [rng.choice(vocab) for _ in range(rng.randrange(0, 80))]
        for _, t in rng.sample(items, rng.randrange(0, 3)):
            q = t.split()
            part = q[:max(1, int(len(q) * rng.choice([0.3, 0.6, 1.0])))]
            at = rng.randrange(len(w) + 1)
            w[at:at] = part
        docs.append((i, rng.choice([" ", "\n"]).join(w)))
    docs += [(500, None), (501, ""), (502, "..."), (503, items[5][1].upper()), (504, " ".join(t for _, t in items) * 30)]
    assert run(spark, docs, items) == brute(docs, items)


ITEM = "A train leaves Boston at 7 and travels 120 km in 3 hours while a second train leaves at 7 too"


def test_changed_values_are_caught_and_mixed_ones_are_not(spark):
    docs = [(1, "Intro text. " + ITEM + " and so on"),
            (2, "A train leaves Dallas at 9 and travels 45km in 12 hours while a second train leaves at 9 too"),
            (3, "A train leaves Dallas at 9 and travels 9 km in 9 hours while a second train leaves at 4 too"),
            (4, "A boat leaves harbour before dawn and nothing of the kind is asked here at all")]
    got = run(spark, docs, [(10, ITEM), (11, None), (None, ITEM)])
    assert got[1][0] and got[2][0] and not got[3][0] and not got[4][0]
    assert got[2][1] == [10]


def test_empty_tables_and_repeats(spark):
    assert run(spark, [], [(1, ITEM)]) == {}
    assert run(spark, [(1, ITEM)], []) == {1: (False, [], 0.0)}
    d = spark.createDataFrame([(1, ITEM), (1, ITEM), (None, ITEM)], "doc_id long, text string")
    b = spark.createDataFrame([(1, ITEM), (1, ITEM)], "item_id long, text string")
    got = sorted((str(r["doc_id"]), r["contaminated"]) for r in dc.decontaminate(d, b).collect())
    assert got == [("1", True), ("1", True), ("None", False)]


def test_full_filter_only_costs_time(spark, monkeypatch):
    monkeypatch.setattr(dc, "FILTER_BITS", 3)
    docs = [(1, ITEM + " end"), (2, "nothing of it here but many other words that follow one another")]
    assert run(spark, docs, [(10, ITEM)])[1][0] and not run(spark, docs, [(10, ITEM)])[2][0]
    assert np.packbits(np.ones(8, bool)).tolist() == [255]


def test_names_at_sentence_starts_of_several_words_and_with_inner_capitals(spark):
    apples = "Alice has 5 apples. Bob gives Alice 3 apples. How many apples does Alice have?"
    shop = "On Monday the clerk McDonald sold 4 crates to Jean Luc Martin at IBM before the shop closed"
    docs = [(1, apples.replace("Alice", "Carol").replace("Bob", "Dan").replace("5", "6")),
            (2, shop.replace("McDonald", "Miller").replace("Jean Luc Martin", "Ann Lee").replace("IBM", "NASA")),
            (4, shop.replace("McDonald", "Miller").replace("Jean Luc Martin", "Miller").replace("IBM", "Miller")),
            (5, "How many of them stayed? Nobody knows. Bob gives a talk about apples and Alice listens to it")]
    got = run(spark, docs, [(10, apples), (11, shop)])
    assert got[1][:2] == (True, [10]) and got[1][2] == 1.0
    assert got[2][:2] == (True, [11]) and got[2][2] == 1.0
    assert not got[4][0] and not got[5][0]
