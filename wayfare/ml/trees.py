"""Decision-tree ensembles: split search on cells, and the model as a relation.

A *cell* is (node, feature value) with the sums of its rows' weights and targets.
Cells of one feature, sorted, give the gain of every cut between neighbouring
values of a node by running sums, all nodes at once. Both growers use it:
``forest`` on the exact values of the rows a task holds, and on partial cells that
tasks add up; ``boosting`` on the binned values of the whole table.

A fitted ensemble is a table of nodes (tree, node, feature, threshold, value,
weight, gain). Node 1 is a root; the children of n are 2n (feature <= threshold)
and 2n + 1. The table can be saved, read by any engine and scored by a recursive
join; ``TreeModel.transform`` scores with Arrow batches, and importances are sums
of the nodes' gains.
"""

from __future__ import annotations

import pickle
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Executors need the libraries but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Gains closer than this (relatively) are equal; the first feature and value wins.
TIE = 1e-9
NODES = "tree int, node long, feature int, threshold double, value array<double>, weight double, gain double"


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit hash."""
    x = np.asarray(x).astype(np.uint64)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def hashed(*parts) -> np.ndarray:
    h = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for p in parts:
            h = mix(np.asarray(p).astype(np.int64).view(np.uint64) + h * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1))
    return h


def clean(x: np.ndarray) -> np.ndarray:
    """Missing values order after all others."""
    return np.where(np.isnan(x), np.inf, x)


# ------------------------------------------------------------ split search

def segment_starts(node: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else np.zeros(0, np.int64)


def best_cuts(node: np.ndarray, w: np.ndarray, s: np.ndarray, nodes: int):
    """Best cut of every node from the cells of one feature, sorted by (node,
    value); ``s`` (cells x targets) holds sums of targets less their node's mean.
    Returns (gain, last cell on the left) per node; gain -1 where there is no cut."""
    gain, at = np.full(nodes, -1.0), np.full(nodes, -1, np.int64)
    if len(node) < 2:
        return gain, at
    first = segment_starts(node)
    size = np.diff(np.append(first, len(node)))
    left = np.cumsum(w)
    total = left[first + size - 1] - left[first] + w[first]
    left -= np.repeat(left[first] - w[first], size)
    right = np.repeat(total, size) - left
    # No cut behind a node's last cell.
    ok = (left > 0) & (right > 0)
    ok[first + size - 1] = False
    g = None
    for k in range(s.shape[1]):
        one = np.ascontiguousarray(s[:, k])
        run = np.cumsum(one)
        run -= np.repeat(run[first] - one[first], size)
        run *= run
        g = run if g is None else g + run
    left *= right
    left[~ok] = 1.0
    g /= left
    g *= np.repeat(total, size)
    g[~ok] = -1.0
    top = np.maximum.reduceat(g, first)
    good = np.flatnonzero(g >= np.repeat(np.where(top >= 0, top * (1 - TIE), np.inf), size))
    own = node[good]
    one = segment_starts(own)
    own = own[one]
    at[own] = good[one]
    gain[own] = top[node[first].searchsorted(own)]
    return gain, at


def cells(key: np.ndarray, weights: list[np.ndarray], size: int):
    """(keys that occur, sums of each weight); the first weight is positive."""
    if size <= 4 * len(key) + 1024:
        sums = [np.bincount(key, x, size) for x in weights]
        some = np.flatnonzero(sums[0] > 0)
        return some, [x[some] for x in sums]
    by = np.argsort(key)
    key = key[by]
    first = segment_starts(key)
    return key[first], [np.add.reduceat(x[by], first) for x in weights]


def choose(gains: np.ndarray, allowed: np.ndarray | None = None) -> np.ndarray:
    """The feature of each node (features x nodes gains): the first within a tie of the best; -1 for none."""
    g = gains if allowed is None else np.where(allowed, gains, -1.0)
    top = g.max(0)
    pick = np.argmax(g >= top * (1 - TIE) - 0.0, axis=0)
    return np.where(top >= 0, pick, -1)


def feature_subsets(tree: int, ids: np.ndarray, gains: np.ndarray, mtry: int | None) -> np.ndarray | None:
    """Of the features that can cut a node, ``mtry`` by a hash of (tree, node, feature)."""
    if mtry is None or mtry >= len(gains):
        return None
    h = hashed(np.int64(tree), np.asarray(ids, np.int64)[None, :], np.arange(len(gains))[:, None])
    h = np.where(gains >= 0, h >> np.uint64(1), np.uint64(1 << 63))
    rank = np.argsort(np.argsort(h, axis=0, kind="stable"), axis=0, kind="stable")
    return (rank < mtry) & (gains >= 0)


def middle(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A threshold between neighbouring values a < b."""
    with np.errstate(invalid="ignore", over="ignore"):
        m = a + (b - a) / 2
    return np.where((m >= b) | np.isnan(m), a, m)


class NodeRows:
    """Collects nodes of one tree or more."""

    def __init__(self):
        self.parts = []

    def add(self, tree, node, feature, threshold, value, weight, gain):
        n = len(node)
        self.parts.append((np.broadcast_to(np.asarray(tree, np.int64), n), np.asarray(node, np.int64), np.asarray(feature, np.int64),
                           np.asarray(threshold, float), np.asarray(value, float).reshape(n, -1), np.asarray(weight, float),
                           np.asarray(gain, float)))

    def arrays(self) -> dict[str, np.ndarray]:
        names = ["tree", "node", "feature", "threshold", "value", "weight", "gain"]
        return {name: np.concatenate([p[k] for p in self.parts]) for k, name in enumerate(names)}


def small_codes(codes: np.ndarray, span: int) -> np.ndarray:
    """Codes below ``span`` in as few bytes as they need."""
    return codes.astype(np.uint8 if span <= 1 << 8 else np.uint16 if span <= 1 << 16 else np.uint32)


def grow(codes: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, w: np.ndarray, max_depth: int, tree: int,
         mtry: int | None = None, root: int = 1, out: NodeRows | None = None) -> NodeRows:
    """The exact subtree below ``root`` on rows held in memory: CART to purity
    or ``max_depth``. ``codes[f]`` are the places of the rows' values in the sorted
    ``values[f]``; ``y`` is rows x targets; rows of weight 0 are left out.

    The rows of a node lie together: each level moves them to their children's places. Of
    two children only the smaller one is counted, where the cells are few; the sums of the
    other are the parent's less these (see ``child_sums``)."""
    out = out or NodeRows()
    rows = np.flatnonzero(w > 0)
    wt, t = w[rows].astype(np.float64), [y[rows, k] for k in range(y.shape[1])]
    x = [small_codes(c[rows], len(v)) for c, v in zip(codes, values)]
    size, ids = np.array([len(rows)], np.int64), np.array([root], np.int64)
    small = 1e-14 * max(float(np.abs(y).max(initial=0.0)) ** 2, 1e-300)
    depth = int(root).bit_length() - 1
    above, scale = None, None
    while len(wt):
        nodes, first = len(ids), np.cumsum(size) - size
        total = np.add.reduceat(wt, first)
        mean = np.stack([np.add.reduceat(wt * v, first) / total for v in t], 1)
        gains = np.full((len(x), nodes), -1.0)
        cut, mark = np.full((len(x), nodes), -1, np.int64), np.full((len(x), nodes), np.nan)
        dense: list = [None] * len(x)
        if depth < max_depth:
            # Targets less their node's mean: running sums stay within a node's size.
            part = [(v - np.repeat(mean[:, k], size)) * wt for k, v in enumerate(t)]
            rest = sum(np.add.reduceat(v * v / wt, first) for v in part)
            open_ = rest > small * total
            # A node is counted where it is the smaller child, or where its parent's sums are too coarse for it.
            spread, counted = rest / total, np.ones(nodes, bool)
            if above is not None:
                counted[1::2] = size[1::2] < size[::2]
                counted[::2] = ~counted[1::2]
                counted |= spread < COARSE * np.repeat(scale, 2)
            scale = spread if above is None else np.where(counted, spread, np.repeat(scale, 2))
            sums, kept, chosen = [wt, *part], {}, {}
            for f, c in enumerate(x if open_.any() else []):
                span = len(values[f])
                if span < 2:
                    continue
                few = nodes * span <= len(wt) // 2
                less = few and above is not None and above[0][f] is not None
                # Rows of pure nodes need no search.
                which = counted if less else np.ones(nodes, bool) if few else open_
                name = "counted" if less else "all" if few else "open"
                if name not in kept:
                    kept[name] = np.flatnonzero(which)
                    live = None if which.all() else np.flatnonzero(np.repeat(which, size))
                    chosen[name] = live, sums if live is None else [v[live] for v in sums]
                own, (live, some) = kept[name], chosen[name]
                key = np.repeat((np.arange(len(own)) if name == "open" else own) * span, size[own])
                key += c if live is None else c[live]
                if few:
                    got = [np.bincount(key, v, nodes * span).reshape(nodes, span) for v in some]
                    if less:
                        child_sums(got, counted, above[0][f], mean, above[1])
                    dense[f] = got
                    key = np.flatnonzero((got[0] > 0) & open_[:, None])
                    own, got = np.arange(nodes), [v.ravel()[key] for v in got]
                else:
                    key, got = cells(key, some, len(own) * span)
                gains[f, own], at = best_cuts(key // span, got[0], np.stack(got[1:], 1), len(own))
                has = np.flatnonzero(at >= 0)
                cut[f, own[has]] = key[at[has]] % span
                mark[f, own[has]] = middle(values[f][cut[f, own[has]]], values[f][key[at[has] + 1] % span])
        feature = choose(gains, feature_subsets(tree, ids, gains, mtry))
        split, lane = feature >= 0, np.arange(nodes)
        out.add(tree, ids, feature, np.where(split, mark[feature, lane], np.nan), mean, total,
                np.where(split, gains[feature, lane], 0.0))
        if not split.any():
            break
        above, scale = ([g and [v[split] for v in g] for g in dense], mean[split]), scale[split]
        # Rows of split nodes move on, sorted by child.
        which = np.repeat(feature.astype(np.int16), size)
        last = np.repeat(np.where(split, cut[feature, lane], 0), size)
        child = np.repeat(2 * (np.cumsum(split) - 1).astype(np.uint16 if 2 * split.sum() <= 1 << 16 else np.int64), size)
        for f in np.unique(feature[split]).tolist():
            some = np.flatnonzero(which == f)
            child[some] += x[f][some] > last[some]
        if split.all():
            order = np.argsort(child, kind="stable")
        else:
            stay = np.flatnonzero(which >= 0)
            child = child[stay]
            order = stay[np.argsort(child, kind="stable")]
        wt, t, x = wt.take(order), [v.take(order) for v in t], [c.take(order) for c in x]
        size = np.bincount(child, minlength=2 * int(split.sum()))
        ids = np.stack([2 * ids[split], 2 * ids[split] + 1], 1).ravel()
        depth += 1
    return out


#: A node whose mean square is below this share of the last counted one's above it is counted itself:
#: differences would keep too few of its digits.
COARSE = 1e-4


def child_sums(got: list[np.ndarray], counted: np.ndarray, parent: list[np.ndarray], mean: np.ndarray, parent_mean: np.ndarray) -> None:
    """Fills in the sums (nodes x codes, each node's targets less its mean) of the children that
    were not counted, from their parents' and their siblings'."""
    other = np.flatnonzero(~counted)
    up, sibling = other // 2, other ^ 1
    got[0][other] = parent[0][up] - got[0][sibling]
    for k in range(len(got) - 1):
        # The sibling's sums, and then the result, move from one mean to another.
        there = got[k + 1][sibling] + (mean[sibling, k] - parent_mean[up, k])[:, None] * got[0][sibling]
        moved = parent[k + 1][up] - there - (mean[other, k] - parent_mean[up, k])[:, None] * got[0][other]
        got[k + 1][other] = np.where(got[0][other] > 0, moved, 0.0)


# ------------------------------------------------------------------- models

#: A tree a row: what scoring needs, and the rest of its nodes.
TREES = "fit int, tree int, score binary, rest binary"


def pack_nodes(n: dict[str, np.ndarray]) -> bytes:
    """Some nodes of one tree."""
    inner = n["feature"] >= 0
    return pickle.dumps((small_codes(n["node"], int(n["node"].max(initial=0)) + 1), n["feature"].astype(np.int16), n["threshold"][inner],
                         n["value"], n["weight"], n["gain"][inner]), 5)


def pack_tree(parts: list[bytes]) -> tuple[bytes, bytes]:
    """All nodes of one tree in order: its shape, thresholds and leaves; ids, inner values, weights and gains."""
    found = [pickle.loads(x) for x in parts]
    node, feature, value, weight = (np.concatenate([f[k].astype(np.int64) if k == 0 else f[k] for f in found]) for k in (0, 1, 3, 4))
    threshold, gain = np.zeros(len(node)), np.zeros(len(node))
    inner = feature >= 0
    threshold[inner], gain[inner] = (np.concatenate([f[k] for f in found]) for k in (2, 5))
    by = np.argsort(node, kind="stable")
    node, feature, threshold, value, weight, gain, inner = (x[by] for x in (node, feature, threshold, value, weight, gain, inner))
    return (pickle.dumps((feature, threshold[inner], value[~inner]), 5),
            pickle.dumps((small_codes(node, int(node[-1]) + 1), value[inner], weight, gain[inner]), 5))


def unpack_tree(tree: int, score: bytes, rest: bytes) -> dict[str, np.ndarray]:
    feature, marks, leaves = pickle.loads(score)
    node, values, weight, gains = pickle.loads(rest)
    inner = feature >= 0
    out = {"tree": np.full(len(node), tree), "node": node.astype(np.int64), "feature": feature.astype(np.int64),
           "threshold": np.full(len(node), np.nan), "value": np.zeros((len(node), leaves.shape[1])), "weight": weight, "gain": np.zeros(len(node))}
    out["threshold"][inner], out["gain"][inner], out["value"][inner], out["value"][~inner] = marks, gains, values, leaves
    return out


class Ensemble:
    """Nodes as arrays, for scoring: each tree walks all rows a level at a time."""

    def __init__(self, nodes: dict[str, np.ndarray], combine: str, base: float = 0.0, rate: float = 1.0):
        by = np.lexsort((nodes["node"], nodes["tree"]))
        tree, node = nodes["tree"][by], nodes["node"][by]
        self.feature = nodes["feature"][by].astype(np.int16)
        self.threshold, self.value = nodes["threshold"][by], nodes["value"][by]
        # A node's children, in the order of (tree, node): the right one follows the left one. A leaf
        # leads to itself, so that rows need no check for it.
        key = tree * (1 << 40) + node
        inner = self.feature >= 0
        at = np.arange(len(node))
        self.left = np.where(inner, np.searchsorted(key, tree * (1 << 40) + 2 * node), at).astype(np.int32)
        self.feature = np.where(inner, self.feature, 0).astype(np.int16)
        self.threshold = np.where(inner, self.threshold, np.inf)
        self.roots = np.flatnonzero(node == 1)
        last = np.append(self.roots[1:], len(node)) - 1
        self.depths = [int(n).bit_length() - 1 for n in node[last]] if len(self.roots) else []
        self.combine, self.base, self.rate = combine, base, rate

    @staticmethod
    def of_trees(trees: list[bytes], combine: str, base: float, rate: float) -> "Ensemble":
        """From trees as ``pack_tree`` makes them: the children of a level's inner nodes follow in order."""
        e = Ensemble.__new__(Ensemble)
        feature, threshold, left, value, e.roots, e.depths, start = [], [], [], [], [], [], 0
        for score in trees:
            f, marks, leaves = pickle.loads(score)
            inner, n = f >= 0, len(f)
            at, mark, v = np.arange(start, start + n, dtype=np.int32), np.full(n, np.inf), np.zeros((n, leaves.shape[1]))
            at[inner] = start + 1 + 2 * np.arange(len(marks), dtype=np.int32)
            mark[inner], v[~inner] = marks, leaves
            for x, part in ((feature, np.where(inner, f, 0).astype(np.int16)), (threshold, mark), (left, at), (value, v)):
                x.append(part)
            e.roots.append(start)
            lo, hi, depth = 0, 1, 0
            while split := int(inner[lo:hi].sum()):
                lo, hi, depth = hi, hi + 2 * split, depth + 1
            e.depths.append(depth)
            start += n
        e.feature, e.threshold, e.left, e.value = (np.concatenate(x) for x in (feature, threshold, left, value))
        e.roots = np.array(e.roots, np.int64)
        e.combine, e.base, e.rate = combine, base, rate
        return e

    def leaf_values(self, x: np.ndarray, root: int, depth: int) -> np.ndarray:
        at = np.full(len(x), root, np.int32)
        flat, start = x.ravel(), np.arange(len(x)) * x.shape[1]
        for _ in range(depth):
            right = flat.take(start + self.feature.take(at)) > self.threshold.take(at)
            at = self.left.take(at)
            at += right
        return self.value[at]

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Rows x targets: the mean of the trees, or base + rate * their sum."""
        x = np.ascontiguousarray(x)
        total = np.zeros((len(x), self.value.shape[1]))
        for r, depth in zip(self.roots.tolist(), self.depths):
            total += self.leaf_values(x, r, depth)
        return total / max(len(self.roots), 1) if self.combine == "mean" else self.base + self.rate * total


class TreeModel:
    """A fitted ensemble over named feature columns.

    ``kind``: ``regression`` (prediction), or ``classification`` (probability of
    each class code 0, 1, ... and prediction, the first most probable one)."""

    def __init__(self, features: list[str], nodes: dict[str, np.ndarray] | None, kind: str, combine: str, classes: int = 0,
                 base: float = 0.0, rate: float = 1.0, source: DataFrame | None = None):
        """``source``: instead of the nodes, a written table (tree, score, rest) that is read when it is needed."""
        self.features, self._nodes, self.kind, self.combine = list(features), nodes, kind, combine
        self.classes, self.base, self.rate, self.source = classes, base, rate, source

    @property
    def nodes(self) -> dict[str, np.ndarray]:
        return node_arrays(self.nodes_table(self.source.sparkSession)) if self._nodes is None else self._nodes

    def meta(self) -> tuple:
        return (self.features, self.kind, self.combine, int(self.classes), float(self.base), float(self.rate))

    def scorer(self):
        kind, combine, base, rate = self.kind, self.combine, self.base, self.rate
        if self._nodes is not None:
            ensemble, trees = Ensemble(self.nodes, combine, base, rate), []
        else:
            # Some nine bytes a node; the tasks lay them out.
            t = self.source.select("tree", "score").toArrow().sort_by("tree")
            ensemble, trees = None, t["score"].to_pylist()
            if not trees:
                ensemble = Ensemble(self.nodes, combine, base, rate)

        def score(x: np.ndarray) -> np.ndarray:
            nonlocal ensemble
            if ensemble is None:
                ensemble = Ensemble.of_trees(trees, combine, base, rate)
            raw = ensemble.raw(clean(x))
            if kind == "regression":
                return raw[:, 0]
            if combine == "sum":
                raw = 1.0 / (1.0 + np.exp(-raw))
            return np.concatenate([1.0 - raw, raw], 1) if raw.shape[1] == 1 else raw
        return score

    def transform(self, df: DataFrame) -> DataFrame:
        score, kind = self.scorer(), self.kind

        @F.pandas_udf("double" if kind == "regression" else "array<double>")
        def predict(x: pd.DataFrame) -> pd.Series:
            got = score(x.to_numpy(np.float64, na_value=np.nan))
            return pd.Series(got if kind == "regression" else list(got))
        x = predict(F.struct(*[F.col(f"`{c}`").cast("double").alias(f"f{k}") for k, c in enumerate(self.features)]))
        if kind == "regression":
            return df.withColumn("prediction", x)
        top = F.array_position("probability", F.array_max("probability")) - 1
        return df.withColumn("probability", x).withColumn("prediction", top.cast("double"))

    def nodes_table(self, spark: SparkSession) -> DataFrame:
        if self._nodes is None:
            def unpack(batches):
                for batch in batches:
                    for tree, score, rest in zip(*(batch.column(k).to_pylist() for k in range(3))):
                        n = unpack_tree(tree, score, rest)
                        k = n["value"].shape[1]
                        value = pa.ListArray.from_arrays(pa.array(np.arange(len(n["node"]) + 1, dtype=np.int32) * k), pa.array(n["value"].ravel()))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(n["tree"].astype(np.int32)), pa.array(n["node"]), pa.array(n["feature"].astype(np.int32)),
                             pa.array(n["threshold"]), value, pa.array(n["weight"]), pa.array(n["gain"])],
                            ["tree", "node", "feature", "threshold", "value", "weight", "gain"])
            return self.source.select("tree", "score", "rest").mapInArrow(unpack, NODES)
        n = self.nodes
        frame = pd.DataFrame({"tree": n["tree"].astype(np.int32), "node": n["node"], "feature": n["feature"].astype(np.int32),
                              "threshold": n["threshold"], "value": list(n["value"]),
                              "weight": n["weight"], "gain": n["gain"]})
        return spark.createDataFrame(frame, NODES)

    def importances(self) -> np.ndarray:
        """Per feature: its share of each tree's gains, the trees' mean, summing to 1."""
        size = len(self.features)
        if self._nodes is None:
            def sums(batches):
                for batch in batches:
                    found = []
                    for score, rest in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                        feature = pickle.loads(score)[0]
                        found.append(np.bincount(feature[feature >= 0], pickle.loads(rest)[3], size).tolist())
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["tree", "gains"])
            got = self.source.select("tree", "score", "rest").mapInArrow(sums, "tree int, gains array<double>").collect()
            trees = sorted(r["tree"] for r in got)
            table = np.array([r["gains"] for r in sorted(got, key=lambda r: r["tree"])]).reshape(len(trees), size)
        else:
            n = self.nodes
            inner = n["feature"] >= 0
            trees, at = np.unique(n["tree"], return_inverse=True)
            table = np.zeros((len(trees), size))
            np.add.at(table, (at[inner], n["feature"][inner]), n["gain"][inner])
        total = table.sum(1, keepdims=True)
        shares = np.divide(table, total, out=np.zeros_like(table), where=total > 0)
        mean = shares.mean(0) if len(trees) else np.zeros(size)
        return mean / mean.sum() if mean.sum() > 0 else mean

    def save(self, spark: SparkSession, path: str) -> None:
        self.nodes_table(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([self.meta()], META).write.mode("overwrite").parquet(f"{path}/tree_model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TreeModel":
        features, kind, combine, classes, base, rate = spark.read.schema(META).parquet(f"{path}/tree_model").first()
        return TreeModel(features, node_arrays(spark.read.schema(NODES).parquet(f"{path}/nodes")), kind, combine, classes, base, rate)


META = "features array<string>, kind string, combine string, classes int, base double, rate double"


def node_arrays(nodes: DataFrame) -> dict[str, np.ndarray]:
    """The nodes on the driver: at most trees x 2**(depth + 1) rows."""
    t = nodes.toArrow()
    n = len(t)
    flat = {c: np.asarray(t[c].combine_chunks()) for c in ("tree", "node", "feature", "threshold", "weight", "gain")}
    flat["value"] = np.asarray(t["value"].combine_chunks().flatten()).reshape(n, -1) if n else np.zeros((0, 1))
    return {c: v.astype(np.int64) if c in ("tree", "node", "feature") else v for c, v in flat.items()}
