"""NAV anomaly models: stratified split, isolation forest, random forest, ensemble.

Isolation forest (not in Spark ML): each tree is grown on its own sample of
``max_samples`` rows, drawn by a portable hash at a rate that gives every tree a
few times ``max_samples`` candidates, so the rows sent to tree building are
bounded by trees x max_samples x 4 whatever the table size.
Trees are grown in ``groupBy(tree).applyInPandas`` (one task per tree), the
flat node arrays (bounded by trees x 2 x max_samples) are shipped to the
executors inside a vectorised pandas UDF, and every row is scored there.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens.operators.ordering import exact_quantile
from fundlens.plans import forest
from fundlens.session import scratch_path, written

# The tree builder and the scorer run in Python workers.  Pickle this module's
# functions by value so executors need nothing but numpy and pandas installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HASH_P = 2147483647          # Mersenne prime 2^31 - 1
HASH_A = 48271               # MINSTD multiplier
EULER_GAMMA = 0.5772156649015329


def _fifth(h: Column) -> Column:
    """x^5 mod P, a permutation of the residues (5 has no factor in common with P - 1).

    Lambdas bind x and its square once instead of repeating their expressions.
    """
    square = F.transform(F.array(h), lambda x: F.struct(x.alias("x"), (x * x % HASH_P).alias("s")))
    return F.transform(square, lambda p: p["s"] * p["s"] % HASH_P * p["x"] % HASH_P)[0]


def portable_hash(cols: Sequence[Column], seed: int = 0) -> Column:
    """A seeded hash in [0, 2^31-1) from integer columns using only +, *, % on BIGINT.

    The seed is added before every fifth power, so two seeds give unrelated orders.
    Any SQL engine evaluates it identically (unlike engine-specific hashes).
    """
    s = seed % HASH_P
    h = _fifth(F.lit(s).cast("long"))
    for c in cols:
        h = _fifth((h * HASH_A + F.pmod(c.cast("long"), F.lit(HASH_P)) + s) % HASH_P)
    for _ in range(2):
        h = _fifth((h * HASH_A + 1 + s) % HASH_P)
    return h


def with_hash(df: DataFrame, cols: Sequence[Column], seed: int, out: str) -> DataFrame:
    """``portable_hash`` as a column, by plain columns that build on each other (no lambda is called a row).

    Write the frame before filtering on it: a filter moved below would repeat the columns.
    """
    s, made = seed % HASH_P, []

    def add(name: str, value: Column) -> Column:
        nonlocal df
        df, _ = df.withColumn(name, value), made.append(name)
        return F.col(name)

    h = F.lit(pow(s, 5, HASH_P)).cast("long")
    for i, c in enumerate([*[F.pmod(c.cast("long"), F.lit(HASH_P)) for c in cols], F.lit(1), F.lit(1)]):
        x = add(f"_hx{i}", (h * HASH_A + c + s) % HASH_P)
        sq = add(f"_hs{i}", x * x % HASH_P)
        h = add(f"_hh{i}", sq * sq % HASH_P * x % HASH_P)
    return df.withColumn(out, h).drop(*made)


def day_number(col: str) -> Column:
    return F.datediff(F.col(col), F.lit("1970-01-01").cast("date"))


SPLIT_BUCKETS = 4096
SPLIT_MAX_CLASSES = 1000
EDGE_ROWS = 1_000_000               # rows of a class that one task may order


def stratified_split(df: DataFrame, label: str, key_cols: Sequence[Column], frac: float = 0.8,
                     seed: int = 42, out: str = "is_train") -> DataFrame:
    """Exact per-class split: the floor(frac * n_class) rows of lowest hash go to train.

    Radix selection: a grouped count over (class, hash bucket) finds the bucket in which a
    class's last training row lies; while that bucket holds more than ``EDGE_ROWS`` rows it is
    cut into buckets again, reading only its rows.  Only the rows inside a class's last interval
    are ordered, by hash and key; its last training row is then a literal, and every row is
    train that does not lie behind it.  Rows whose hash and key are equal there are numbered.
    The rows are written once, with their hash.  Labels must be classes: more than ``SPLIT_MAX_CLASSES`` values raise.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in key_cols]
    names = [f"_k{i}" for i in range(len(keys))]
    keyed = df.select("*", *[k.alias(n) for k, n in zip(keys, names)])
    d = written(with_hash(keyed, [F.col(n) for n in names], seed, "_h"), "split")
    h = F.col("_h")

    def of_class(value) -> Column:
        return F.col(label).eqNullSafe(F.lit(value))

    def pick(state: dict, field: str, default: int) -> Column:
        """A class's entry of the selection state (a literal per class)."""
        out_ = F.lit(default)
        for value, s in state.items():
            out_ = F.when(of_class(value), F.lit(s[field])).otherwise(out_)
        return out_

    def cut(rows: DataFrame, lo: Column, width: Column, want: dict | None) -> dict:
        """Per class the bucket that holds its last training row: lo, width, rows before it still to take, rows."""
        counted = rows.withColumn("_b", F.floor((h - lo) / width)).groupBy(label, "_b").agg(F.count(F.lit(1)).alias("n"))
        w = Window.partitionBy(label).orderBy("_b")
        total = F.sum("n").over(Window.partitionBy(label))
        take = F.floor(total * F.lit(float(frac))) if want is None else pick(want, "take", 0)
        edge = (counted.withColumn("below", F.sum("n").over(w) - F.col("n")).withColumn("take", take)
                .where((F.col("below") <= F.col("take")) & (F.col("take") < F.col("below") + F.col("n"))))
        found = edge.select(label, "_b", (F.col("take") - F.col("below")).alias("take"), "n").limit(SPLIT_MAX_CLASSES + 1).collect()
        if len(found) > SPLIT_MAX_CLASSES:
            raise ValueError(f"{label} has more than {SPLIT_MAX_CLASSES} values")
        return {r[label]: r for r in found}

    width = -(-HASH_P // SPLIT_BUCKETS)
    state = {v: {"lo": r["_b"] * width, "width": width, "take": r["take"], "n": r["n"]}
             for v, r in cut(d, F.lit(0), F.lit(width), None).items()}
    while True:
        large = {v: s for v, s in state.items() if s["n"] > EDGE_ROWS and s["width"] > 1}
        if not large:
            break
        fine = {v: -(-s["width"] // SPLIT_BUCKETS) for v, s in large.items()}
        inside = F.lit(False)
        for v, s in large.items():                             # a literal interval per class: reaches the scan
            inside = inside | (of_class(v) & (h >= s["lo"]) & (h < s["lo"] + s["width"]))
        width_of = pick({v: {"w": w} for v, w in fine.items()}, "w", 1)
        for v, r in cut(d.where(inside), pick(large, "lo", 0), width_of, large).items():
            state[v] = {"lo": state[v]["lo"] + r["_b"] * fine[v], "width": fine[v], "take": r["take"], "n": r["n"]}
    # a class that is all train has no entry: every hash lies below its interval
    lo = pick(state, "lo", HASH_P)
    end = pick({v: {"end": s["lo"] + s["width"]} for v, s in state.items()}, "end", HASH_P)
    d = d.withColumns({"_lo": lo, "_end": end, "_take": pick(state, "take", 0)})
    clear = d.where("_h < _lo OR _h >= _end").withColumn(out, (h < F.col("_lo")).cast("int"))
    rn = F.row_number().over(Window.partitionBy(label).orderBy("_h", *names))
    inside = d.where("_h >= _lo AND _h < _end").withColumn("_rn", rn)
    at = F.struct("_h", *names)
    edges = inside.where((F.col("_rn") - F.col("_take")).isin(0, 1)).select(label, at.alias("at"), (F.col("_rn") <= F.col("_take")).alias("in"))
    found = edges.collect()                                            # the rows on both sides of each class's cut
    last, after = ({r[label]: tuple(r["at"]) for r in found if r["in"] == side} for side in (True, False))
    if any(last[v] == after.get(v) for v in last):
        clear = d.where("_h < _lo OR _h >= _end").withColumn(out, (h < F.col("_lo")).cast("int"))
        d = clear.unionByName(inside.withColumn(out, (F.col("_rn") <= F.col("_take")).cast("int")).drop("_rn"))
    else:
        types = [d.schema[n].dataType for n in ("_h", *names)]
        train = h < F.col("_lo")
        for v, row in last.items():
            cut_at = F.struct(*[F.lit(x).cast(t).alias(n) for x, t, n in zip(row, types, ("_h", *names))])
            train = train | (of_class(v) & (h < F.col("_end")) & (at <= cut_at))
        d = d.withColumn(out, train.cast("int"))
    return d.drop("_h", "_lo", "_end", "_take", *names)


# --- isolation forest ------------------------------------------------------

def _c(n: float) -> float:
    """Average path length of an unsuccessful BST search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def _c_vec(n: np.ndarray) -> np.ndarray:
    n = n.astype(float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    feat, thr, left, right, size = [], [], [], [], []

    def node(idx: np.ndarray, depth: int) -> int:
        me = len(feat)
        feat.append(-1), thr.append(0.0), left.append(-1), right.append(-1), size.append(len(idx))
        if depth >= max_depth or len(idx) <= 1:
            return me
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            return me
        f = int(rng.choice(usable))
        t = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < t
        feat[me], thr[me] = f, t
        left[me] = node(idx[go_left], depth + 1)
        right[me] = node(idx[~go_left], depth + 1)
        return me

    node(np.arange(len(x)), 0)
    return feat, thr, left, right, size


class Walk:
    """Binary trees as flat arrays, walked level by level by all rows of a batch.

    A column is turned into the number of forest thresholds below its values once, so a step
    compares small integers.  A leaf leads to itself: every row takes as many steps as its tree
    is deep, without masks.  Rows below a threshold go left; with ``closed`` also rows that equal it.
    """

    def __init__(self, feat, thr, left, right, roots, values, features: int, closed: bool = False):
        feat, left, right = (np.asarray(a, dtype=np.int64) for a in (feat, left, right))
        thr, inner, self.side = np.asarray(thr, dtype=float), feat >= 0, "left" if closed else "right"
        self.cuts = [np.unique(thr[feat == f]) for f in range(features)]
        self.roots = np.asarray(roots, dtype=np.int64)
        self.rank = np.full(len(feat), np.iinfo(np.int32).max, dtype=np.int32)      # no value lies beyond a leaf's
        for f, cuts in enumerate(self.cuts):
            self.rank[feat == f] = np.searchsorted(cuts, thr[feat == f])
        self.feat, self.values = np.where(inner, feat, 0), [np.asarray(v, dtype=float) for v in values]
        me = np.arange(len(feat))
        self.kids = np.column_stack([np.where(inner, left, me), np.where(inner, right, me)]).ravel()
        self.depths = []
        for root in self.roots:
            level, depth = np.array([root]), 0
            while (level := level[inner[level]]).size:
                level, depth = np.concatenate([left[level], right[level]]), depth + 1
            self.depths.append(depth)

    def sums(self, columns: Sequence[pd.Series]) -> list[np.ndarray]:
        """For every list of node values the sum, over trees in order, of the values a row ends at."""
        codes = np.column_stack([np.searchsorted(cuts, c.to_numpy(dtype=float), side=self.side).astype(np.int32)
                                 for cuts, c in zip(self.cuts, columns)])
        n, width = codes.shape
        flat, base = np.ascontiguousarray(codes).ravel(), np.arange(n) * width
        totals = [np.zeros(n) for _ in self.values]
        node, at, right = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, bool)
        code, rank, value = np.empty(n, np.int32), np.empty(n, np.int32), np.empty(n)
        for root, depth in zip(self.roots, self.depths):
            node[:] = root
            for _ in range(depth):
                np.take(self.feat, node, out=at, mode="clip")                       # clip: no copy, all are in bounds
                at += base
                np.take(flat, at, out=code, mode="clip")
                np.take(self.rank, node, out=rank, mode="clip")
                np.greater(code, rank, out=right)
                np.multiply(node, 2, out=at)
                at += right
                np.take(self.kids, at, out=node, mode="clip")
            for total, values in zip(totals, self.values):
                total += np.take(values, node, out=value, mode="clip")
        return totals


TREE_SCHEMA = ("tree int, node int, depth int, feature int, threshold double, "
               "left int, right int, size long")


class IsolationForest:
    """Isolation forest; ``score`` follows the sign convention of score_samples
    (lower = more abnormal), ``offset`` is the contamination quantile of the
    training scores and ``predict`` marks outliers with 1."""

    def __init__(self, trees: int = 200, max_samples: int = 256, contamination: float = 0.01,
                 seed: int = 42):
        self.trees, self.max_samples, self.contamination, self.seed = trees, max_samples, contamination, seed

    def fit(self, df: DataFrame, features: Sequence[str], key_cols: Sequence[Column],
            hashed: str | None = None) -> "IsolationForest":
        """Every tree draws its own sample of ``max_samples`` rows from the whole table.

        The draws are made from a pool, a hashed sample of a few times trees x max_samples
        rows (the whole table when it is smaller), by a hash per row and tree: a row may be in
        many trees, and trees do not share their orders.  ``hashed`` names a written column that
        holds the keys' hash with this seed.
        """
        self.features = list(features)
        n = df.count()
        m = min(self.max_samples, n)
        if not m:
            raise ValueError("no rows to fit on")
        self.m = m
        max_depth = int(math.ceil(math.log2(max(m, 2))))
        pool_rows = min(n, 4 * self.trees * m)
        pool = df.select(*[F.col(c).cast("double").alias(c) for c in self.features],
                         (F.col(hashed) if hashed else portable_hash(list(key_cols), self.seed)).alias("_h"))
        pool = pool.where(F.col("_h") < int(min(1.0, pool_rows / n) * HASH_P))
        # small pools and small draws are taken whole: at least m rows must reach every tree
        rate = 1.0 if pool_rows <= 16 * m else min(1.0, (4.0 * m + 64) / pool_rows)
        drawn = pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(self.trees - 1))))
        x = (F.col("_h") + F.col("tree").cast("long") * HASH_A * 7919 + self.seed + 1) % HASH_P
        drawn = drawn.withColumn("_x", x).withColumn("_s", F.col("_x") * F.col("_x") % HASH_P)
        drawn = drawn.withColumn("_u", F.col("_s") * F.col("_s") % HASH_P * F.col("_x") % HASH_P)
        cand = drawn.where(F.col("_u") < int(rate * HASH_P)).drop("_x", "_s", "_h")
        feats, seed, trees = self.features, self.seed, self.trees

        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            t = int(pdf["tree"].iloc[0])
            sample = pdf.sort_values("_u").head(m)
            rng = np.random.default_rng([seed, t])
            f, th, le, ri, sz = _grow(sample[feats].to_numpy(dtype=float), rng, max_depth)
            depth = np.zeros(len(f), dtype=int)
            for i in range(len(f)):
                for child in (le[i], ri[i]):
                    if child >= 0:
                        depth[child] = depth[i] + 1
            return pd.DataFrame({"tree": t, "node": np.arange(len(f)), "depth": depth, "feature": f,
                                 "threshold": th, "left": le, "right": ri, "size": sz})

        self._take(cand.groupBy("tree").applyInPandas(build, TREE_SCHEMA).toPandas())
        if self.n_trees != self.trees:
            raise RuntimeError(f"{self.trees - self.n_trees} trees drew no sample")
        return self

    def _take(self, nodes: pd.DataFrame) -> None:
        nodes = nodes.sort_values(["tree", "node"]).reset_index(drop=True)
        # flat arrays: bounded by trees x (2 x max_samples) nodes
        offs = nodes.groupby("tree").size().cumsum().shift(fill_value=0)
        base = nodes["tree"].map(offs).to_numpy()
        self._feat = nodes["feature"].to_numpy()
        self._thr = nodes["threshold"].to_numpy()
        self._left = np.where(nodes["left"] >= 0, nodes["left"] + base, -1)
        self._right = np.where(nodes["right"] >= 0, nodes["right"] + base, -1)
        self._leafval = nodes["depth"].to_numpy() + _c_vec(nodes["size"].to_numpy())
        self._roots = offs.to_numpy()
        # normalise by the sizes the trees were really grown on
        self._cm = float(np.mean([_c(k) for k in nodes.loc[nodes["node"] == 0, "size"]])) or 1.0
        self.n_trees = len(self._roots)
        self.offset = None
        self._nodes = nodes

    def nodes(self, spark) -> DataFrame:
        """The forest as a table, one row per node (bounded by trees x 2 x ``max_samples``)."""
        return spark.createDataFrame(self._nodes, TREE_SCHEMA)

    @classmethod
    def from_nodes(cls, nodes: DataFrame, features: Sequence[str]) -> "IsolationForest":
        """A forest from its node table; inner nodes name features by their place in ``features``."""
        table = nodes.select(*[f.split()[0] for f in TREE_SCHEMA.split(", ")]).toPandas()
        if table.empty:
            raise ValueError("no nodes")
        made = cls(trees=int(table["tree"].nunique()))
        made.features = list(features)
        made._take(table)
        return made

    def score_column(self, spark) -> Column:
        # the flat forest (bounded by trees x 2 x max_samples nodes) travels once
        # per executor as a broadcast variable, not inside every task closure
        walk = spark.sparkContext.broadcast(
            Walk(self._feat, self._thr, self._left, self._right, self._roots, [self._leafval], len(self.features)))
        cm = self._cm

        @F.pandas_udf(T.DoubleType())
        def score(*columns: pd.Series) -> pd.Series:
            total, = walk.value.sums(columns)
            return pd.Series(-np.power(2.0, -(total / len(walk.value.roots)) / cm))

        return score(*[F.col(c).cast("double") for c in self.features])

    def score(self, df: DataFrame, out: str = "iso_score") -> DataFrame:
        return df.withColumn(out, self.score_column(df.sparkSession))

    def set_offset(self, scored_train: DataFrame, col: str = "iso_score") -> "IsolationForest":
        self.offset = exact_quantile(scored_train, col, self.contamination)
        return self

    def predict(self, scored: DataFrame, col: str = "iso_score", out: str = "iso_outlier") -> DataFrame:
        return scored.withColumn(out, (F.col(col) < F.lit(self.offset)).cast("int"))


# --- random forest ------------------------------------------------------------

def fit_random_forest(df: DataFrame, features: Sequence[str], label: str,
                      class_weight: dict[int, float] | None = None, trees: int = 200,
                      max_depth: int = 8, min_leaf: int = 3, seed: int = 42, max_bins: int = 64,
                      max_memory_mb: int = 1024, key_cols: Sequence[Column] = (), bootstrap: bool = True):
    """Random forest on all rows, as a Spark ML model; ``df`` is read several times.

    How often a tree draws a row follows from a hash of its ``key_cols`` (of its place without them);
    without ``bootstrap`` every tree sees each row once.
    """
    sizes = forest.class_sizes(df, label)
    weights = np.ones(max(2, max(sizes) + 1))
    for cls, wt in (class_weight or {}).items():
        if cls < len(weights):
            weights[cls] = wt
    key = F.xxhash64(F.lit(seed), *(key_cols or [F.monotonically_increasing_id()]))
    cuts = forest.bin_cuts(df, features, label, weights, max_bins)
    blocks = forest.packed_blocks(df, features, label, key, cuts, len(weights), sum(sizes.values()))
    grown = forest.grow(blocks, cuts, weights, trees, max_depth, min_leaf, seed, max_memory_mb, bootstrap)
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=max_depth, minInstancesPerNode=min_leaf,
                                seed=seed, maxBins=max_bins, featureSubsetStrategy="sqrt", bootstrap=bootstrap, maxMemoryInMB=max_memory_mb)
    return forest.to_model(df.sparkSession, rf, grown, cuts, weights)


def class_probability(model, df: DataFrame, features: Sequence[str], out: str = "rf_anomaly_prob",
                      cls: int = 1) -> DataFrame:
    """Probability of a class: the trees' class shares at the leaf a row ends at, summed and normalised.

    The forest is scored from its saved node table, batch by batch as the isolation forest is.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "random-forest")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), F.col("split.featureIndex").alias("feature"),
        F.coalesce(F.get("split.leftCategoriesOrThreshold", F.lit(0)), F.lit(0.0)).alias("threshold"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"), F.col("impurityStats").alias("stats"))
    nodes = nodes.toPandas().sort_values(["tree", "node"]).reset_index(drop=True)   # bounded by trees x 2^(depth + 1)
    offs = nodes.groupby("tree").size().cumsum().shift(fill_value=0)
    base = nodes["tree"].map(offs)
    stats = np.vstack(nodes["stats"].to_numpy())
    size = stats.sum(axis=1, keepdims=True)
    shares = np.divide(stats, size, out=np.zeros_like(stats), where=size != 0)
    walk = spark.sparkContext.broadcast(
        Walk(nodes["feature"], nodes["threshold"], nodes["left"] + base, nodes["right"] + base, offs,
             list(shares.T), len(features), closed=True))

    @F.pandas_udf(T.DoubleType())
    def probability(*columns: pd.Series) -> pd.Series:
        if any(c.isna().any() for c in columns):
            raise ValueError("a feature is null or not a number")
        votes = walk.value.sums(columns)
        total = np.sum(votes, axis=0)
        return pd.Series(np.divide(votes[cls], total, out=np.zeros_like(total), where=total != 0))

    return df.withColumn(out, probability(*[F.col(c).cast("double") for c in features]))


def importance(model, features: Sequence[str]) -> list[tuple[str, float]]:
    """(feature, importance) sorted descending; bounded by the feature count."""
    imp = model.featureImportances.toArray()
    return sorted(zip(features, map(float, imp)), key=lambda kv: -kv[1])


def ensemble(df: DataFrame, p_col: str = "rf_anomaly_prob", iso_col: str = "iso_score",
             w_p: float = 0.6, w_iso: float = 0.4, q: float = 0.99,
             out: str = "ensemble_score", flag: str = "rf_is_anomaly") -> DataFrame:
    """w_p * p + w_iso * (1 + iso); flag rows strictly above the exact q-quantile."""
    scored = df.withColumn(out, F.col(p_col) * w_p + (F.col(iso_col) + 1) * w_iso)
    thr = exact_quantile(scored, out, q)
    return scored.withColumn(flag, (F.col(out) > F.lit(thr)).cast("int"))
