"""Near-duplicate classes against brute force over full shingle sets."""

import random
import re

import pytest
from pyspark.sql import functions as F

from fundlens.llm import lsh_forest
from fundlens.llm.components import components


def sets_of(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def brute(rows, size, num=80):
    sets = {i: sets_of(t, size) for i, t in rows}
    comp = {i: i for i in sets}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i
    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= num * len(sets[x] | sets[y]):
                p, q = sorted((find(x), find(y)))
                comp[q] = p
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def words(rng, n):
    return [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(400)) for _ in range(n)]


def fixture():
    rng = random.Random(3)
    texts = [None, "", "   ", "one", "One", "one two", " ", "x " * 3000]
    texts += [" ".join(words(rng, rng.randrange(3, 60))) for _ in range(40)]
    base = words(rng, 120)
    texts += [" ".join(base)] * 6
    for _ in range(60):  # a star: each copy is near the base, few are near each other
        w = list(base)
        for i in rng.sample(range(120), rng.choice([2, 4, 6, 7])):
            w[i] = "z" + str(rng.randrange(10**6))
        texts.append(" ".join(w))
    chain = words(rng, 100)
    for i in range(30):
        chain[3 * i:3 * i + 3] = words(rng, 3)
        texts.append("\n".join(chain))
    rng.shuffle(texts)
    return list(enumerate(texts, 5))


@pytest.mark.parametrize("size", [2, 5])
@pytest.mark.parametrize("region_rows", [2048, 24])
def test_matches_brute_force(spark, size, region_rows):
    rows = fixture()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, region string")
    got = {r[0]: tuple(r)[1:] for r in
           lsh_forest.near_duplicates(df, size=size, region_rows=region_rows).collect()}
    want = brute(rows, size)
    assert got == want


def hot_source():
    """Pages of one template, far from each other, and a near copy of some of them."""
    rng = random.Random(17)
    base = words(rng, 200)
    texts = []
    for i in range(240):
        w = list(base)
        for k in rng.sample(range(200), 3):
            w[k] = f"y{i}x{k}"
        texts.append(" ".join(w))
        if i % 4 == 0:
            for k in rng.sample(range(200), 4):
                w[k] = f"z{i}x{k}"
            texts.append(" ".join(w))
    return list(enumerate(texts, 1))


@pytest.mark.parametrize("rows,region_rows", [(fixture(), 24), (hot_source(), 8)], ids=["star", "source"])
def test_cut_regions_lose_no_pair(spark, rows, region_rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in lsh_forest.near_duplicates(df, size=5, region_rows=region_rows).collect()}
    want = brute(rows, 5)
    assert got == want
    assert sum(not w[2] for w in want.values()) > 30


def test_links_stay_below_the_rows_of_a_region(spark):
    rng = random.Random(23)
    base = words(rng, 300)
    texts = []
    for i in range(160):  # pages of one template, each pair a little under the threshold
        w = list(base)
        for k in rng.sample(range(300), 3):
            w[k] = f"y{i}x{k}"
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    size = lsh_forest.REGION_ROWS
    rows = df.select("doc_id", F.lit(1).alias("region"), F.col("doc_id").alias("component"))
    sizes = df.select("doc_id", F.lit(4000).alias("bytes"))
    for num in (65, 85):
        blocks = lsh_forest.region_blocks(rows, sizes, size)
        links = lsh_forest.confirm_within(lsh_forest._with_sets(blocks, df, 5), num / 100 - 0.05, num, 100).collect()
        want = brute(list(enumerate(texts)), 5, num)
        assert len(links) == sum(not w[2] for w in want.values())
    many = sizes.withColumn("bytes", F.lit(lsh_forest.BLOCK_BYTES // 50))
    blocks = lsh_forest.region_blocks(rows, many, size)
    assert blocks.groupBy("x", "y").count().count() > 3
    links = lsh_forest.confirm_within(lsh_forest._with_sets(blocks, df, 5), 0.6, 65, 100)
    got = {r["node"]: r["component"] for r in components(links).collect()}
    want = brute(list(enumerate(texts)), 5, 65)
    assert {i: got.get(i, i) for i in range(160)} == {i: w[1] for i, w in want.items()}


def test_empty_nulls_and_repeats(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lsh_forest.near_duplicates(empty).count() == 0
    df = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "a b c"), (3, None)],
                               "doc_id long, text string")
    got = sorted((tuple(r) for r in lsh_forest.near_duplicates(df, size=2).collect()), key=str)
    assert got == sorted([(None, 2, None, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)], key=str)


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 1)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
