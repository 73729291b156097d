"""MinHash near-duplicate classes by an LSH forest with exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.llm import textvec as tv
from fundlens.llm.common import materialise, tasks, worker_free
from fundlens.llm.components import components

TREES = 16
KEYS_PER_TREE = 8
SIGNATURE = TREES * KEYS_PER_TREE
#: Depths a region may be cut at; deeper than a tree's own keys the order goes on through the whole signature.
DEPTHS = (4, 5, 6, 8, 16, 32, 64, SIGNATURE)
REGION_ROWS = 2048
#: Bytes of sets and sketches a block holds, but for one row alone; a task meets two blocks.
BLOCK_BYTES = 32 << 20
#: Regions that were too large are broadcast up to this many (8 MB); beyond it their rows meet them by an exchange.
BROADCAST_ROWS = 1_000_000
#: Candidates need an estimate of at least the threshold less this (4.2 standard errors at 0.8 over 128 keys).
MARGIN = 0.15
#: Keys and margin (4 standard errors) of the sharper sketch that the second round compares.
SHARP = 1024
SHARP_MARGIN = 0.05
_rng = np.random.default_rng(8128)
_XOR = _rng.integers(0, 1 << 63, SHARP, dtype=np.uint64)
_MUL = _rng.integers(0, 1 << 62, SHARP, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes per row) for stretches of a text column.

    Words are lower-cased in A-Z; a text with fewer words than ``size`` has its whole
    word sequence as its only shingle; one without words has none.
    """
    for b in tv.blocks(texts, lower=True):
        h = tv.window_hash(b.hash, size)
        sets = []
        for lo, hi in zip(b.off[:-1].tolist(), b.off[1:].tolist()):
            if hi - lo >= size:
                s = np.sort(h[lo:hi - size + 1])
                sets.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
            elif hi > lo:
                sets.append(tv.window_hash(b.hash[lo:hi], hi - lo) + np.uint64(hi - lo))
            else:
                sets.append(h[:0])
        yield b.lo, sets


def _min_keys(sets: list[np.ndarray], n_keys: int) -> np.ndarray:
    """MinHash keys of every set; an empty set has zeros."""
    n = np.array([len(s) for s in sets])
    keys = np.zeros((len(sets), n_keys), "<u4")
    if (full := np.flatnonzero(n)).size:
        flat = np.concatenate(sets)
        at = (np.cumsum(n) - n)[full]
        for k in range(n_keys):
            v = flat ^ _XOR[k]
            v *= _MUL[k]
            keys[full, k] = np.minimum.reduceat(v, at) >> np.uint64(32)
    return keys


def sharp_sketches(texts: DataFrame, size: int, with_sets: bool = False) -> DataFrame:
    """(doc_id, sketch): one byte of each of ``SHARP`` keys; with the sorted shingle hashes of the whole set if wanted."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, sets in shingle_sets(b.column(1), size):
                keys = _min_keys(sets, SHARP).astype(np.uint8)
                cols = [b.column(0).slice(lo, len(sets)), pa.array([k.tobytes() for k in keys], pa.binary())]
                if with_sets:
                    cols.append(pa.array([s.tobytes() for s in sets], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "sketch", "set"][:len(cols)])

    return texts.select("doc_id", "text").mapInArrow(sign, "doc_id long, sketch binary" + ", set binary" * with_sets)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, set_hash, sig): shingle count, 128-bit hash of the set, MinHash keys."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_free()
        for b in batches:
            for lo, sets in shingle_sets(b.column(1), size):
                n = np.array([len(s) for s in sets])
                keys = _min_keys(sets, SIGNATURE)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, len(sets)), pa.array(n, pa.int64()),
                     pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                     pa.array([k.tobytes() for k in keys], pa.binary())],
                    names=["doc_id", "n_shingles", "set_hash", "sig"])

    return docs.mapInArrow(sign, "doc_id long, n_shingles long, set_hash binary, sig binary")


def _tree_keys(reps: DataFrame, depth: int, only: DataFrame | None) -> DataFrame:
    """(region, tree, doc_id): prefix of ``depth`` keys in each tree's order."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u4").reshape(-1, SIGNATURE)
            ids = b.column(0).to_numpy()
            for t in range(TREES):
                at = (np.arange(depth) + t * KEYS_PER_TREE) % SIGNATURE
                h = np.full(len(ids), t + 1, np.uint64)
                for k in at:
                    h = tv.mix(h * np.uint64(31) + sig[:, k])
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.full(len(ids), t, np.int32)),
                                                  pa.array(ids)], names=["region", "tree", "doc_id"])

    rows = reps.select("doc_id", "sig").mapInArrow(keys, "region long, tree int, doc_id long")
    return rows.join(only, ["tree", "doc_id"], "left_semi") if only is not None else rows


def regions(reps: DataFrame, region_rows: int = REGION_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """(region, doc_id) of the forest's regions of 2 to ``region_rows`` rows, and of the least-depth regions that were cut.

    A region is a stretch of one tree's order with a common prefix.  It is cut at the
    least depth that keeps it within ``region_rows``; rows that still share a whole
    signature with more rows than that are dealt to blocks which all hold the region's
    least row.  Pairs that a cut parts stand in a cut region, null if there is none.
    """
    done, only, cut = [], None, None
    for depth in DEPTHS:
        rows = materialise(_tree_keys(reps, depth, only), "forest-keys")
        size = rows.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least")).where("n > 1")
        size = materialise(size, "forest-regions")
        large = size.where(F.col("n") > region_rows)
        n_large = large.count()
        if n_large and n_large <= BROADCAST_ROWS:
            large = F.broadcast(large)
        if n_large:
            only = materialise(rows.join(large, "region").select("tree", "doc_id", "region", "n", "least"), "forest-large")
            rows = rows.join(large.select("region"), "region", "left_anti")
        done.append(rows.join(size.where(F.col("n") <= region_rows), "region").select("region", "doc_id"))
        if not n_large:
            return _union(done), cut
        cut = only.select("region", "doc_id") if cut is None else cut
    blocks = only.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n") / (region_rows // 2))))
    leasts = blocks.select("region", "block", F.col("least").alias("doc_id"))
    done.append(blocks.select("region", "block", "doc_id").unionByName(leasts).distinct()
                .select(F.xxhash64("region", "block").alias("region"), "doc_id"))
    return _union(done), cut


def _blocks(rows: Column, size: Column, region_rows: int) -> Column:
    """Blocks for so many rows of so many bytes."""
    return F.greatest(F.lit(1), F.ceil(rows / max(region_rows // 2, 1)), F.ceil(size / BLOCK_BYTES)).cast("int")


def region_blocks(members: DataFrame, sizes: DataFrame, region_rows: int) -> DataFrame:
    """(region, x, y, main, doc_id, component, side): the block pairs of regions; nearly all regions are one block."""
    rows = members.join(sizes, "doc_id")
    n = rows.groupBy("region").agg(_blocks(F.count(F.lit(1)) / 2, F.sum("bytes"), region_rows).alias("others"))
    block = F.pmod(F.xxhash64("doc_id"), F.col("others")).cast("int")
    return (rows.join(n, "region").withColumn("block", block)
            .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
            .select("region", F.least("o", "block").alias("x"), F.greatest("o", "block").alias("y"), F.lit(False).alias("main"),
                    "doc_id", "component", F.when(F.col("block") > F.col("o"), 1).otherwise(0).alias("side")))


def cut_blocks(cut: DataFrame, comp: DataFrame, sizes: DataFrame, region_rows: int) -> DataFrame:
    """(region, x, y, main, doc_id, component, side): block pairs that hold every pair of a cut region between components.

    The rows of a region's largest component need no comparison with each other: they are dealt to
    blocks that meet the blocks of the other rows (``main``), and those meet one another.
    """
    rows = (cut.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .withColumn("component", F.coalesce("component", "doc_id")).join(sizes, "doc_id"))
    rows = materialise(rows, "forest-cut")
    n = (rows.groupBy("region", "component").agg(F.count(F.lit(1)).alias("m"), F.sum("bytes").alias("bytes"))
         .groupBy("region").agg(F.max(F.struct("m", "component", "bytes")).alias("top"), F.sum("m").alias("n"),
                                F.sum("bytes").alias("bytes"))
         .where("n > top.m"))
    n = n.select("region", F.col("top.component").alias("top"), _blocks(F.col("top.m"), F.col("top.bytes"), region_rows).alias("tops"),
                 _blocks(F.col("n") - F.col("top.m"), F.col("bytes") - F.col("top.bytes"), region_rows).alias("others"))
    rows = rows.join(n, "region").withColumn("is_top", F.col("component") == F.col("top"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.when(F.col("is_top"), F.col("tops")).otherwise(F.col("others")))
                           .cast("int"))
    upto = lambda m: F.sequence(F.lit(0), m - 1)
    group = lambda x, y, main, side: F.struct(x.alias("x"), y.alias("y"), F.lit(main).alias("main"), side.alias("side"))
    block = F.col("block")
    met = F.transform(upto(F.col("others")), lambda o: group(block, o, True, F.lit(0)))
    meets = F.concat(F.transform(upto(F.col("tops")), lambda t: group(t, block, True, F.lit(1))),
                     F.transform(upto(F.col("others")), lambda o: group(F.least(o, block), F.greatest(o, block), False,
                                                                        F.when(block > o, 1).otherwise(0))))
    return (rows.select("region", "doc_id", "component", F.explode(F.when(F.col("is_top"), met).otherwise(meets)).alias("g"))
            .select("region", "g.x", "g.y", "g.main", "doc_id", "component", "g.side"))


_GROUP = ("region", "x", "y", "main")


def _pairs(t: pa.Table, floor: float) -> Iterator[tuple[int, np.ndarray]]:
    """(row, rows behind it) of the block pair that belong to different components and may be similar; rows ordered by side."""
    side, comp = t["side"].to_numpy(), t["component"].to_numpy()
    sketch = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint8).reshape(-1, SHARP)
    within = not t["main"][0].as_py() and t["x"][0].as_py() == t["y"][0].as_py()
    first = int(np.searchsorted(side, 1))
    for i in range(len(side) if within else first):
        lo = i if within else first
        other = lo + np.flatnonzero(comp[lo:] != comp[i])
        js = other[_estimate(sketch[other], sketch[i]) >= floor]
        if len(js):
            yield i, js


def cut_candidates(blocks: DataFrame, floor: float) -> DataFrame:
    """Rows of the block pairs that have a candidate in another component there."""
    def search(t: pa.Table) -> pa.Table:
        t = t.sort_by("side")
        hit = np.zeros(t.num_rows, bool)
        for i, js in _pairs(t, floor):
            hit[i] = hit[js] = True
        return t.select([*_GROUP, "doc_id", "component", "side"]).filter(pa.array(hit))

    schema = "region long, x int, y int, main boolean, doc_id long, component long, side int"
    return blocks.repartition(tasks(blocks), *_GROUP).groupBy(*_GROUP).applyInArrow(search, schema)


def confirm_within(blocks: DataFrame, floor: float, num: int, den: int) -> DataFrame:
    """Links (a, b) that join two components of a block pair, confirmed on full sets where the rows stand.

    ``blocks`` has the sketch and the sorted shingle hashes of every row.  A candidate whose rows a
    confirmed link has joined already is passed over, so fewer links than rows come out of a block pair
    however many pairs are tried.
    """
    def search(t: pa.Table) -> pa.Table:
        t = t.sort_by("side")
        ids, sets = t["doc_id"].to_numpy(), [np.frombuffer(s, "<u8") for s in t["set"].to_pylist()]
        n = np.array([len(s) for s in sets])
        # components so far, numbered from 0; a link renames one of the two
        comp = np.unique(t["component"].to_numpy(), return_inverse=True)[1]
        a, b = [], []
        for i, js in _pairs(t, floor):
            js = js[(comp[js] != comp[i]) & (n[js] > 0) & (num * np.maximum(n[js], n[i]) <= den * np.minimum(n[js], n[i]))]
            for j in js:
                if comp[j] == comp[i]:
                    continue
                at = np.minimum(np.searchsorted(sets[i], sets[j]), n[i] - 1)
                same = int((sets[i][at] == sets[j]).sum())
                if den * same >= num * (n[i] + n[j] - same):
                    a.append(max(ids[i], ids[j]))
                    b.append(min(ids[i], ids[j]))
                    comp[comp == comp[j]] = comp[i]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return blocks.repartition(tasks(blocks), *_GROUP).groupBy(*_GROUP).applyInArrow(search, "a long, b long").distinct()


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _padded(lists: pa.Array) -> np.ndarray:
    """Rows of region numbers, filled up to the most regions a row can have (one a tree)."""
    n = lists.value_lengths().to_numpy()
    out = np.full((len(n), TREES * len(DEPTHS)), np.iinfo(np.int64).max)
    out[np.arange(out.shape[1]) < n[:, None]] = lists.flatten().to_numpy()
    return out


def _spanning(sketch: np.ndarray, comp: np.ndarray, floor: float) -> list[tuple[int, int]]:
    """Links of a spanning forest over the rows, likeliest first; known components come joined."""
    m = len(sketch)
    best, parent = np.full(m, -1.0), np.zeros(m, np.int64)
    todo = np.ones(m, bool)
    out, at = [], 0
    while True:
        todo[at] = False
        near = _estimate(sketch, sketch[at])
        near[comp == comp[at]] = 2.0
        closer = near > best
        best[closer], parent[closer] = near[closer], at
        if not todo.any():
            return out
        at = int(np.argmax(np.where(todo, best, -2.0)))
        if best[at] < floor:
            best[todo] = -1.0
        elif best[at] < 2.0:
            out.append((at, int(parent[at])))


def _rest(sketch: np.ndarray, comp: np.ndarray, floor: float, shared: np.ndarray, region: int) -> np.ndarray:
    """Rows with a candidate in another component whose first shared region is this one."""
    hit = np.zeros(len(sketch), bool)
    for i in range(len(sketch) - 1):
        near = _estimate(sketch[i:], sketch[i])
        near[comp[i:] == comp[i]] = -1.0
        js = i + np.flatnonzero(near >= floor)
        js = js[~np.isin(shared[js], shared[i][shared[i] < region]).any(1)]
        if len(js):
            hit[i] = hit[js] = True
    return np.flatnonzero(hit)


def _estimate(sketch: np.ndarray, row: np.ndarray) -> np.ndarray:
    same = (sketch == row).mean(1)
    return (same - 1 / 256) / (1 - 1 / 256)


def _by_region(members: DataFrame, n_keys: int, more: list[str], found, schema: str) -> DataFrame:
    """Give each region's rows to ``found(region, ids, comp, sketch, more)``, which returns two columns of numbers."""
    names = [f.split()[0] for f in schema.split(", ")]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def results(cols: list[np.ndarray], last: bool):
            region = cols[0]
            edge = np.concatenate([[0], np.flatnonzero(region[1:] != region[:-1]) + 1, [len(region)]])
            stop = len(edge) - 1 if last else len(edge) - 2
            out = [found(*(c[lo:hi] for c in cols)) for lo, hi in zip(edge[:stop], edge[1:stop + 1])
                   if hi - lo > 1 and (cols[2][lo:hi] != cols[2][lo]).any()]
            one, two = (np.concatenate([np.zeros(0, np.int64), *(o[k] for o in out)]) for k in (0, 1))
            return (pa.RecordBatch.from_arrays([pa.array(one), pa.array(two)], names=names), [c[edge[stop]:] for c in cols])

        for x in batches:
            if not x.num_rows:
                continue
            now = [x["region"].to_numpy(), x["doc_id"].to_numpy(), x["component"].to_numpy(),
                   np.frombuffer(b"".join(x["sketch"].to_pylist()), np.uint8).reshape(-1, n_keys), *(_padded(x[m]) for m in more)]
            held = [np.concatenate(p) for p in zip(held, now)] if held else now
            out, held = results(held, False)
            yield out
        if held and len(held[0]):
            yield results(held, True)[0]

    return (members.repartition(tasks(members), "region").sortWithinPartitions("region", "doc_id")
            .mapInArrow(search, schema))


def spanning_links(members: DataFrame, floor: float) -> DataFrame:
    """Links (a, b) to confirm: a spanning forest of every region's candidates; ``members`` has (region, doc_id, component, sketch)."""
    def found(region: np.ndarray, ids: np.ndarray, comp: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(ids) == 2:
            pairs = [(1, 0)] if _estimate(sketch[:1], sketch[1])[0] >= floor else []
        else:
            pairs = _spanning(sketch, comp, floor)
        i, j = np.array(pairs, np.int64).reshape(-1, 2).T
        return np.maximum(ids[i], ids[j]), np.minimum(ids[i], ids[j])

    return _by_region(members, SIGNATURE, [], found, "a long, b long").distinct()


def candidates(members: DataFrame, floor: float) -> DataFrame:
    """(region, doc_id) of the rows with a candidate in another component.

    ``members`` has (region, doc_id, component, sketch, regions: all regions of the row in ascending
    order).  A pair counts in the first region it shares.
    """
    def found(region: np.ndarray, ids: np.ndarray, comp: np.ndarray, sketch: np.ndarray,
              shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hit = _rest(sketch, comp, floor, shared, region[0])
        return region[hit], ids[hit]

    return _by_region(members, SHARP, ["regions"], found, "region long, doc_id long")


def confirm(links: DataFrame, texts: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Links whose full shingle sets have den * intersection >= num * union."""
    pairs = (links.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
             .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for lo in range(0, x.num_rows, 256):
                y = x.slice(lo, 256)
                one, two = ([s for _, part in shingle_sets(y[c], size) for s in part] for c in ("ta", "tb"))
                same = np.array([len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(one, two)])
                union = np.array([len(p) + len(q) for p, q in zip(one, two)]) - same
                yield y.select(["a", "b"]).filter(pa.array((union > 0) & (den * same >= num * union)))

    return pairs.select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                    text_col: str = "text", region_rows: int = REGION_ROWS) -> DataFrame:
    """Classes of documents whose word-shingle sets are similar (num/den at least).

    Returns doc_id, n_shingles, component_id (least id reachable over links) and kept.
    Rows with equal sets are collapsed to their least id first.  Candidates are rows that
    share a prefix in one of the forest's sorted orders: a first round confirms a spanning
    forest of each region, a second every remaining candidate between components (by a sharper
    sketch), so none is left unchecked; a third meets the pairs that stand together in a region
    which was too large and parts them below.  Links are confirmed on full sets; the last two rounds
    bring the sets of rows with candidates to the region and return only links that join components.  Texts that are null or
    have no words are linked with nothing.  Rows that repeat a doc_id are one node of the
    link graph (its texts stay apart); a null doc_id gives component_id null, kept true.
    An empty table gives no rows; other columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = materialise(signatures(docs, size), "forest-signatures")
    full = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = materialise(full.groupBy("set_hash").agg(F.min(F.struct("doc_id", "n_shingles", "sig")).alias("r"))
                       .select("set_hash", "r.doc_id", "r.n_shingles", "r.sig"), "forest-classes")
    # an id with several texts has several classes: they are one node, searched under its first set
    nodes = reps.groupBy("doc_id").agg(F.min("sig").alias("sig"), F.max("n_shingles").alias("n_shingles"))
    sizes = nodes.select("doc_id", (8 * F.col("n_shingles") + SHARP).alias("bytes"))
    member, cut = regions(nodes, region_rows)
    member = materialise(member, "forest-members")
    wanted = (member if cut is None else member.unionByName(cut)).select("doc_id").distinct()
    texts = materialise(docs.join(wanted, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")), "forest-texts")
    sketch = nodes.select("doc_id", F.col("sig")).mapInArrow(_sketch, "doc_id long, sketch binary")
    member = materialise(member.join(sketch, "doc_id"), "forest-sketches")
    first = spanning_links(member.withColumn("component", F.col("doc_id")), num / den - MARGIN)
    first = materialise(confirm(first, texts, size, num, den), "forest-links")
    known = (member.select("region", "doc_id").join(components(first).withColumnRenamed("node", "doc_id"), "doc_id", "left")
             .withColumn("component", F.coalesce("component", "doc_id")))
    mixed = known.groupBy("region").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    known = materialise(known.join(mixed, "region", "left_semi"), "forest-mixed")
    sharp = sharp_sketches(texts.join(known.select("doc_id").distinct(), "doc_id"), size)
    shared = known.groupBy("doc_id").agg(F.sort_array(F.collect_set("region")).alias("regions"))
    floor = num / den - SHARP_MARGIN
    near = materialise(candidates(known.join(sharp, "doc_id").join(shared, "doc_id"), floor), "forest-near")
    second = confirm_within(_with_sets(region_blocks(known.join(near, ["region", "doc_id"]), sizes, region_rows), texts, size),
                            floor, num, den)
    links = first.unionByName(second)
    if cut is not None:
        links = materialise(links, "forest-links")
        blocks = materialise(cut_blocks(cut, components(links), sizes, region_rows), "forest-blocks")
        sharp = sharp_sketches(texts.join(blocks.select("doc_id").distinct(), "doc_id"), size)
        near = materialise(cut_candidates(blocks.join(sharp, "doc_id"), floor), "forest-near")
        links = links.unionByName(confirm_within(_with_sets(near, texts, size), floor, num, den))
    # a row whose id stands for another set too carries the link between the two classes
    twice = full.groupBy("doc_id").agg(F.min("set_hash").alias("lo"), F.max("set_hash").alias("hi")).where("lo <> hi")
    shared = (full.join(twice, "doc_id", "left_semi").join(reps.withColumnRenamed("doc_id", "b"), "set_hash")
              .select(F.col("doc_id").alias("a"), "b"))
    comp = components(links.unionByName(shared))
    label = materialise(reps.select("set_hash", "doc_id")
                        .join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left")
                        .select("set_hash", F.coalesce("component", "doc_id").alias("class_id")), "forest-labels")
    return (rows.join(label, "set_hash", "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")))
            .select("doc_id", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def _with_sets(rows: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Rows with the sharper sketch and the whole set of their text."""
    return rows.join(sharp_sketches(texts.join(rows.select("doc_id").distinct(), "doc_id"), size, True), "doc_id")


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The low byte of every key."""
    for b in batches:
        sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(-1, 4 * SIGNATURE)[:, ::4]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in sig], pa.binary())],
                                         names=["doc_id", "sketch"])
