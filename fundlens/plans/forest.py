"""Random forest grown on every row, level by level, from counts over binned features.

Spark ML's trainer takes its split thresholds from some 10,000 rows and keeps an array of a number
per tree beside every row; it needs most of a millisecond a row for 200 trees.  Here every row
is counted instead:

* ``bin_cuts``: at most ``max_bins`` bins a feature at the weighted quantiles of all rows, exact.
  A pass counts the rows of ranges of the value; only ranges that hold a quantile are cut again.
* ``packed_blocks``: the rows as blocks of bin numbers (a byte a feature) and a hash of the row's key.
* ``grow``: one pass a level.  A task walks its rows down every tree and counts them by (node,
  feature of the node's subset, bin, class); counts are added up per tree, where the best split of
  each node is chosen.  How often a tree draws a row (Poisson of mean 1, as Spark does) follows from
  the row's hash, so nothing is kept per row and tree.  Only splits reach the driver.

Split rules are Spark's: gini gain above 0, ``min_leaf`` drawn rows on both sides, sqrt(features)
candidates a node, leaves of one parent that predict the same class are one leaf.  All counts are integers:
the forest depends on rows and keys, not on how they are partitioned.  ``to_model`` gives the Spark ML model.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.session import cut_lineage, scratch_path

# Counting runs in Python workers: executors need nothing but numpy, pandas and pyarrow.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 65_536                # rows of a block, counted together
PASS_ROWS = 2_000_000              # rows of a task in a pass
FIRST_BITS, NEXT_BITS = 16, 8      # a range of values is cut into 2^bits ranges
PURE = 2.0 ** -52

NODE = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
                  ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
                  ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                                       ("numCategories", pa.int32())]))])


def class_sizes(df: DataFrame, label: str) -> dict[int, int]:
    """Rows per class; classes are whole numbers from 0."""
    sizes = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    if not sizes:
        raise ValueError("no rows to fit on")
    if any(v is None or v < 0 or v != int(v) for v in sizes):
        raise ValueError(f"{label} has values that are no classes")
    return {int(v): n for v, n in sizes.items()}


def _column(pdf: pd.DataFrame, name: str) -> np.ndarray:
    x = pdf[name].to_numpy(dtype=float)
    if np.isnan(x).any():
        raise ValueError("a feature is null or not a number")
    return x


# --- bins -------------------------------------------------------------------

def _flip(s: np.ndarray) -> np.ndarray:
    return np.where(s >= 0, s, s ^ np.int64(2 ** 63 - 1))


def _keys(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the values, one for each value (0 and -0 are one)."""
    return _flip((x + 0.0).view(np.int64))


def _values(keys: np.ndarray) -> np.ndarray:
    return _flip(keys).view(float)


def _width(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return hi.view(np.uint64) - lo.view(np.uint64)


def bin_cuts(df: DataFrame, features: Sequence[str], label: str, weights: np.ndarray, max_bins: int) -> list[np.ndarray]:
    """Ascending cuts per feature between neighbouring values of all rows; a value lies behind the cuts below it.

    Up to ``max_bins`` distinct values are all told apart.  Of more, each multiple of a ``max_bins``-th of
    the rows' weight takes the nearest place between two values.  Rows are counted in ranges of the
    value; ranges that a multiple falls into are cut again until it falls between two values or into one.
    """
    k, names = len(weights), list(features)
    rows = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(names)], F.col(label).cast("int").alias("_y"))
    ends = np.array([-2 ** 63]), np.array([2 ** 63 - 1])
    open_ = {i: (*ends, np.array([64 - FIRST_BITS], np.uint64)) for i in range(len(names))}
    tables = {i: (*ends, np.ones((1, k))) for i in open_}
    children = 2 ** FIRST_BITS

    def counter(open_: dict, children: int):
        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = {}
            for pdf in batches:
                y = pdf["_y"].to_numpy()
                for i, (lo, hi, shift) in open_.items():
                    keys = _keys(_column(pdf, f"_{i}"))
                    at = np.searchsorted(lo, keys, side="right") - 1
                    ok = (at >= 0) & (keys <= hi[at])
                    keys, at, cls = keys[ok], at[ok], y[ok]
                    cell = at * children + (_width(lo[at], keys) >> shift[at]).astype(np.int64)
                    if i not in sums:
                        size = len(lo) * children
                        sums[i] = np.zeros(size * k, np.int64), np.full(size, 2 ** 63 - 1), np.full(size, -2 ** 63)
                    n, low, high = sums[i]
                    n += np.bincount(cell * k + cls, minlength=len(n))
                    np.minimum.at(low, cell, keys)
                    np.maximum.at(high, cell, keys)
            for i, (n, low, high) in sums.items():
                hit = np.flatnonzero(n)
                yield pd.DataFrame({"f": i, "cell": hit // k, "cls": hit % k, "n": n[hit], "lo": low[hit // k], "hi": high[hit // k]})
        return count

    while open_:
        cells = rows.mapInPandas(counter(open_, children), "f int, cell long, cls int, n long, lo long, hi long")
        found = cells.groupBy("f", "cell", "cls").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).toPandas()
        was, open_, children = open_, {}, 2 ** NEXT_BITS
        for i in was:
            sub = found[found["f"] == i]
            ids, inverse = np.unique(sub["cell"].to_numpy(), return_inverse=True)
            lo, hi, n = np.full(len(ids), 2 ** 63 - 1), np.full(len(ids), -2 ** 63), np.zeros((len(ids), k))
            np.minimum.at(lo, inverse, sub["lo"].to_numpy())
            np.maximum.at(hi, inverse, sub["hi"].to_numpy())
            np.add.at(n, (inverse, sub["cls"].to_numpy()), sub["n"].to_numpy())
            kept = ~np.isin(tables[i][0], was[i][0])                  # the ranges that were not cut
            lo, hi, n = (np.concatenate([old[kept], new]) for old, new in zip(tables[i], (lo, hi, n)))
            order = np.argsort(lo)
            lo, hi, n = tables[i] = lo[order], hi[order], n[order]
            wide = lo < hi
            if len(lo) + wide.sum() > max_bins:                        # at least so many values
                upto, targets = _targets(n @ weights, max_bins)
                before = np.concatenate([[0.0], upto[:-1]])
                wide &= np.searchsorted(targets, before, side="right") < np.searchsorted(targets, upto, side="left")
            if wide.any():
                bits = [int(w).bit_length() for w in _width(lo[wide], hi[wide])]
                open_[i] = lo[wide], hi[wide], np.array([max(0, b - NEXT_BITS) for b in bits], np.uint64)
    return [_cuts(*tables[i], weights, max_bins) for i in range(len(names))]


def _targets(weight: np.ndarray, max_bins: int) -> tuple[np.ndarray, np.ndarray]:
    """The weight up to the end of each range, and the multiples that are to be cut at."""
    upto = np.cumsum(weight)
    return upto, upto[-1] * np.arange(1, max_bins) / max_bins


def _cuts(lo: np.ndarray, hi: np.ndarray, n: np.ndarray, weights: np.ndarray, max_bins: int) -> np.ndarray:
    """Middles between the last value of a range and the first of the next, at the places chosen."""
    if len(lo) <= max_bins and (lo == hi).all():
        ends = np.arange(len(lo) - 1)
    else:
        upto, targets = _targets(n @ weights, max_bins)
        at = np.searchsorted(upto, targets, side="left")
        before = np.where(at > 0, upto[at - 1], 0.0)
        ends = np.unique(np.where(targets - before < upto[at] - targets, at - 1, at))
        ends = ends[(ends >= 0) & (ends < len(lo) - 1)]
    a, b = _values(hi[ends]), _values(lo[ends + 1])
    with np.errstate(all="ignore"):
        middle = a + (b - a) / 2
        return np.where((a <= middle) & (middle < b), middle, a)


# --- blocks of rows -----------------------------------------------------------

def packed_blocks(df: DataFrame, features: Sequence[str], label: str, key: Column, cuts: list[np.ndarray], classes: int, rows: int) -> DataFrame:
    """All rows as blocks, written: per feature and row ``bin * classes + class``, and the rows' hashes."""
    kind = np.min_scalar_type(max(len(c) + 1 for c in cuts) * classes)
    names = [f"_{i}" for i in range(len(features))]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []

        def block() -> pd.DataFrame:
            codes, hashes = (np.concatenate(part, axis=-1) for part in zip(*held))
            held.clear()
            return pd.DataFrame({"codes": [codes.tobytes()], "hashes": [hashes.tobytes()]})

        for pdf in batches:
            y = pdf["_y"].to_numpy()
            codes = np.stack([np.searchsorted(c, _column(pdf, name), side="left") * classes + y for c, name in zip(cuts, names)])
            held.append((codes.astype(kind), pdf["_r"].to_numpy(dtype=np.int64)))
            if sum(len(h) for _, h in held) >= BLOCK_ROWS:
                yield block()
        if held:
            yield block()

    packed = df.select(*[F.col(c).cast("double").alias(n) for c, n in zip(features, names)], F.col(label).cast("int").alias("_y"),
                       key.alias("_r")).mapInPandas(pack, "codes binary, hashes binary")
    return cut_lineage(packed.repartition(max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / PASS_ROWS))))


def _poisson_table() -> np.ndarray:
    """Number of draws by 16 random bits, in ascending order."""
    p = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])
    return np.searchsorted(p, (np.arange(65_536) + 0.5) / 65_536).astype(float)


def _draws(hashes: np.ndarray, salt: int) -> np.ndarray:
    """64 random bits a row, as 16 for each of four trees."""
    x = hashes.view(np.uint64) ^ np.uint64(salt)
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x ^= x >> np.uint64(33)
        x *= np.uint64(factor)
    return np.ascontiguousarray((x ^ (x >> np.uint64(33))).view(np.uint16).reshape(-1, 4).T)


class _Tree:
    """A tree as it grows: per level the splits of its open nodes, and the nodes open now.

    ``steps`` has per level (feature, last bin that goes left, places of both children on the next level);
    the place behind the last open node takes the rows that have reached a leaf.
    """

    def __init__(self, classes: int):
        self.counts, self.split = [np.zeros(classes)], [None]         # per node; split: feature, bin, gain, left, right
        self.steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.open = [0]

    def take(self, best: pd.DataFrame, level: int, max_depth: int, weights: np.ndarray, min_leaf: int) -> None:
        """The level's best splits: nodes without one are leaves."""
        feature, cut, at = (np.zeros(len(self.open) + 1, np.int64) for _ in range(3))
        kids, after = np.full((len(self.open) + 1, 2), -1), []
        for slot, f, b, gain, total, left in zip(*[best[c] for c in ("slot", "feature", "bin", "gain", "total", "left")]):
            node = self.open[slot]
            self.counts[node] = total = np.asarray(total, float)
            if gain <= 0 or level >= max_depth:
                continue
            left = np.asarray(left, float)
            feature[slot], cut[slot] = f, b
            self.split[node] = (f, b, gain, len(self.counts), len(self.counts) + 1)
            for side, counts in enumerate((left, total - left)):
                if level + 1 < max_depth and _gini(counts * weights) > PURE and counts.sum() >= 2 * min_leaf:
                    kids[slot, side] = len(after)
                    after.append(len(self.counts))
                self.counts.append(counts)
                self.split.append(None)
        kids[kids < 0] = len(after)
        self.steps.append((feature, cut, kids.ravel()))
        self.open = after

    def rows(self, cuts: list[np.ndarray], weights: np.ndarray) -> list[dict]:
        """The nodes as Spark saves them, numbered from the root, left before right."""
        out: list = []

        def node(me: int) -> float | None:
            """Adds a node; the class of a leaf, None for a node with children."""
            at, stats = len(out), (self.counts[me] * weights).tolist()
            total = sum(stats)
            data = {"id": at, "prediction": float(stats.index(max(stats))), "impurity": 1.0 - sum((s / total) ** 2 for s in stats) if total else 0.0,
                    "impurityStats": stats, "rawCount": int(self.counts[me].sum()), "gain": -1.0, "leftChild": -1, "rightChild": -1,
                    "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}}
            out.append(data)
            if self.split[me] is None:
                return data["prediction"]
            f, b, gain, left, right = self.split[me]
            one = node(left)
            second = len(out)
            other = node(right)
            if one is not None and one == other:                      # both predict the same
                del out[at + 1:]
                data["prediction"] = one
                return one
            data |= {"gain": float(gain), "leftChild": at + 1, "rightChild": second,
                     "split": {"featureIndex": int(f), "leftCategoriesOrThreshold": [float(cuts[f][b])], "numCategories": -1}}
            return None

        node(0)
        return out


def _gini(stats: np.ndarray) -> np.ndarray:
    """Gini impurity over the last axis, 0 without weight."""
    total = stats.sum(axis=-1)
    out = np.ones(np.shape(total))
    for c in range(stats.shape[-1]):
        share = np.divide(stats[..., c], total, out=np.zeros(np.shape(total)), where=total != 0)
        out = out - share * share
    return np.where(total != 0, out, 0.0)


def _best_splits(hist: np.ndarray, subsets: np.ndarray, weights: np.ndarray, min_leaf: int) -> pd.DataFrame:
    """Of counts by (candidate, node, bin, class) each node's split of highest gain, the first of equal ones."""
    hist = hist.transpose(1, 0, 2, 3).astype(float)                   # node, candidate, bin, class
    left = hist.cumsum(axis=2)
    total = left[:, :1, -1:, :]
    left, right = left[:, :, :-1], total - left[:, :, :-1]
    whole = (total * weights).sum(axis=-1)
    lw, rw = left * weights, right * weights
    with np.errstate(all="ignore"):
        gain = _gini(total * weights) - lw.sum(axis=-1) / whole * _gini(lw) - rw.sum(axis=-1) / whole * _gini(rw)
    gain = np.where((left.sum(axis=-1) >= min_leaf) & (right.sum(axis=-1) >= min_leaf) & (whole > 0), gain, -1.0)
    nodes, (_, width) = np.arange(len(hist)), gain.shape[1:]
    if not width:
        gain, left, width = np.full((*gain.shape[:2], 1), -1.0), hist[:, :, :1], 1
    best = gain.reshape(len(hist), -1).argmax(axis=1)
    of, cut = best // width, best % width
    return pd.DataFrame({"slot": nodes, "feature": subsets[nodes, of], "bin": cut, "gain": gain[nodes, of, cut],
                         "total": list(total[:, 0, 0]), "left": list(left[nodes, of, cut])})


def grow(blocks: DataFrame, cuts: list[np.ndarray], weights: np.ndarray, trees: int, max_depth: int, min_leaf: int, seed: int,
         max_memory_mb: int, bootstrap: bool) -> list[_Tree]:
    """The forest's trees.  A pass counts for as many trees as ``max_memory_mb`` holds the counts of."""
    spark, features, classes = blocks.sparkSession, len(cuts), len(weights)
    bins = max(len(c) + 1 for c in cuts)
    width, kind, tries = bins * classes, np.min_scalar_type(bins * classes), math.ceil(math.sqrt(features))
    min_leaf = max(1, min_leaf)
    forest = [_Tree(classes) for _ in range(trees)]
    salts = np.random.default_rng([seed, trees]).integers(0, 2 ** 64, size=-(-trees // 4), dtype=np.uint64)

    def counter(sent):
        table = _poisson_table()
        some = np.uint16(np.searchsorted(table, 0.5))                 # fewer: not drawn

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            state = sent.value
            sums = {t: np.zeros((tries, len(subsets) * width)) for t, _, subsets in state}       # whole numbers
            any_rows = False
            for batch in batches:
                for codes, hashes in zip(batch["codes"], batch["hashes"]):
                    any_rows = True
                    hashes = np.frombuffer(hashes.as_buffer(), np.int64)
                    n, codes = len(hashes), np.frombuffer(codes.as_buffer(), kind)
                    salt = None
                    for t, steps, subsets in state:
                        if bootstrap:
                            if salt != t // 4:
                                salt = t // 4
                                bits = _draws(hashes, int(salts[salt]))
                            rows = np.flatnonzero(bits[t % 4] >= some)
                            drawn = table[bits[t % 4][rows]]
                        else:
                            rows, drawn = np.arange(n), None
                        at = np.zeros(len(rows), np.int64)
                        for feature, cut, kids in steps:
                            where = np.take(feature * n, at, mode="clip")           # clip: all are in bounds
                            where += rows
                            last = np.take((cut * classes + classes - 1).astype(kind), at, mode="clip")
                            at *= 2
                            at += np.take(codes, where, mode="clip") > last
                            at = np.take(kids, at, mode="clip")
                        if steps and not (on := at < len(subsets)).all():
                            rows, at = rows[on], at[on]
                            drawn = drawn[on] if drawn is not None else None
                        slot = at * width
                        for j in range(tries):
                            where = np.take(subsets[:, j] * n, at, mode="clip")
                            where += rows
                            cell = np.take(codes, where, mode="clip") + slot
                            sums[t][j] += np.bincount(cell, weights=drawn, minlength=len(subsets) * width)
            if any_rows:
                small = all(s.max(initial=0) < 2 ** 31 for s in sums.values())
                for i in range(0, len(state), 16):
                    part = [t for t, _, _ in state[i:i + 16]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part, pa.int32()), pa.array([small] * len(part), pa.bool_()),
                         pa.array([sums[t].astype(np.int32 if small else np.int64).tobytes() for t in part], pa.binary())], names=["tree", "small", "n"])
        return count

    def chooser(sent):
        def choose(pdf: pd.DataFrame) -> pd.DataFrame:
            t = int(pdf["tree"].iloc[0])
            subsets = next(s for tree, _, s in sent.value if tree == t)
            total = np.zeros(tries * len(subsets) * width, np.int64)
            for small, n in zip(pdf["small"], pdf["n"]):
                total += np.frombuffer(n, np.int32 if small else np.int64)
            best = _best_splits(total.reshape(tries, len(subsets), bins, classes), subsets, weights, min_leaf)
            best.insert(0, "tree", t)
            return best
        return choose

    for level in range(max(1, max_depth)):
        state = []
        for t, tree in enumerate(forest):
            if tree.open:
                picks = np.random.default_rng([seed, t, level]).random((len(tree.open), features)).argsort(axis=1)[:, :tries]
                state.append((t, tree.steps, np.sort(picks, axis=1)))
        room, passes = max_memory_mb * 2 ** 20, [[]]
        for entry in state:
            size = len(entry[2]) * tries * width * 8
            if passes[-1] and size > room:
                room = max_memory_mb * 2 ** 20
                passes.append([])
            passes[-1].append(entry)
            room -= size
        found = []
        for part in passes if state else []:
            sent = spark.sparkContext.broadcast(part)
            counts = blocks.mapInArrow(counter(sent), "tree int, small boolean, n binary")
            found.append(counts.groupBy("tree").applyInPandas(
                chooser(sent), "tree int, slot int, feature int, bin int, gain double, total array<double>, left array<double>").toPandas())
            sent.destroy()
        for best in found:
            for t, sub in best.groupby("tree"):
                forest[t].take(sub.sort_values("slot"), level, max_depth, weights, min_leaf)
    return forest


def to_model(spark, estimator: RandomForestClassifier, forest: list[_Tree], cuts: list[np.ndarray], weights: np.ndarray):
    """The forest as a model of Spark ML, by the format that Spark saves models in."""
    path = scratch_path(spark, "grown-forest")
    estimator.write().save(f"{path}/estimator")
    made = json.loads(spark.read.text(f"{path}/estimator/metadata").first()[0])
    own = {"bootstrap", "featureSubsetStrategy", "numTrees", "subsamplingRate"}
    tree = made | {"class": "org.apache.spark.ml.classification.DecisionTreeClassificationModel"} | {
        kind: {p: v for p, v in made[kind].items() if p not in own} for kind in ("paramMap", "defaultParamMap")}
    whole = made | {"class": "org.apache.spark.ml.classification.RandomForestClassificationModel", "numFeatures": len(cuts),
                    "numClasses": len(weights), "numTrees": len(forest)}
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    spark.createDataFrame([(i, json.dumps(tree | {"uid": f"dtc_{i}"}), 1.0) for i in range(len(forest))],
                          "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/model/treesMetadata")
    trees = [t.rows(cuts, weights) for t in forest]                                          # bounded by trees x 2^(depth + 1) nodes
    nodes = pa.table({"treeID": pa.array(np.repeat(np.arange(len(trees)), [len(t) for t in trees]), pa.int32()),
                      "nodeData": pa.array([n for t in trees for n in t], NODE)})
    spark.createDataFrame(nodes).coalesce(1).write.parquet(f"{path}/model/data")
    return RandomForestClassificationModel.load(f"{path}/model")
