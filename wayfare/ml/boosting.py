"""Gradient boosting on histograms, the full fit and all folds at once.

Rows lie in packed blocks (column codes of their bins, target and fold). One pass over
the blocks, a job of one stage, serves a level of the round's trees of *all* fits: tasks
add up (rows, gradient, curvature) per fit, node and bin, and the driver adds the tasks'
sums. Only the smaller child of each split is counted; its sibling is the parent less
the child. What reaches the driver is bounded by fits x nodes x bins (and partitions).

What the trees so far make of a block, its raw predictions and the nodes that its rows
have reached, is kept in a file of the executor's temporary folder, which all Python
workers of the executor see. A pass takes it one level on. A block without such a file
(another executor, a pass that broke off) begins again from its rows and all trees, with
the same result.

Regression: squared loss from the mean on; classification (two classes): log loss
from the log odds on, leaves by one Newton step.
"""

from __future__ import annotations

import fcntl
import math
import os
import pickle
import shutil
import sys
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .forest import fit_rows
from .rows import Bins, row_batches
from .trees import NodeRows, TreeModel, best_cuts, choose, middle, small_codes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 65_536
BLOCKS = "block long, payload binary"
#: Packed rows of a partition, and the sums that reach the driver as they are.
PART_BYTES, SUM_BYTES = 256 << 20, 64 << 20


def new_tree(max_depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One tree in bins: for nodes 1..2**depth - 1 the feature (-1: leaf) and the last bin on the left; leaf values."""
    size = 1 << (max_depth + 1)
    return np.full(size, -1, np.int16), np.zeros(size, np.int32), np.zeros(size)


def gradients(y: np.ndarray, raw: np.ndarray, logistic: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """(negative gradient, curvature; None where it is 1)."""
    if not logistic:
        return y - raw, None
    p = 1.0 / (1.0 + np.exp(-raw))
    return y - p, p * (1.0 - p)


def packed_blocks(rows: DataFrame, bins: Bins, block_rows: int) -> DataFrame:
    span = max(map(len, bins.values), default=0)

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        for k, b in enumerate(row_batches(batches, block_rows)):
            payload = {"codes": small_codes(np.stack([bins.codes(f, x) for f, x in enumerate(b["x"])]), span), "y": b["y"],
                       "fold": b["fold"]}
            yield pa.RecordBatch.from_arrays([pa.array([part * (1 << 32) + k], pa.int64()), pa.array([pickle.dumps(payload, 5)], pa.binary())],
                                             ["block", "payload"])
    return rows.mapInArrow(run, BLOCKS)


def state_folder(tag: str) -> str:
    """On each executor: its workers have one parent."""
    return f"{tempfile.gettempdir()}/boosting-{tag}-{os.getppid()}"


class Held:
    """A block's rows; per fit their raw predictions and the nodes they have reached (0: not of the fit), in a file."""

    def __init__(self, payload: dict, fits: list[int], base: list[float], max_depth: int, path: str):
        self.codes, self.y, self.fold = payload["codes"], payload["y"], payload["fold"]
        self.fits, self.base, self.max_depth = fits, base, max_depth
        n, kind = len(self.y), np.dtype(np.uint8 if max_depth < 8 else np.uint16 if max_depth < 16 else np.int64)
        size, nodes = 8 + len(fits) * n * (8 + kind.itemsize), 8 + len(fits) * n * 8
        self.file = open(os.open(path, os.O_RDWR | os.O_CREAT), "r+b")
        fcntl.flock(self.file, fcntl.LOCK_EX)  # no two attempts at once
        # New files read as zeros.
        os.truncate(self.file.fileno(), size)
        memory = np.asarray(np.memmap(self.file, np.uint8, "r+", shape=size))
        # 1 + 64 * rounds done + levels done of the next; 0: not begun, or left half done.
        self.stage = memory[:8].view(np.int64)
        self.raw, self.node = memory[8:nodes].view(np.float64).reshape(len(fits), n), memory[nodes:].view(kind).reshape(len(fits), n)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        # The mapping keeps the file open as long as it is referred to.
        fcntl.flock(self.file, fcntl.LOCK_UN)
        self.file.close()

    def bring(self, past: list, trees: list, depth: int, rate: float) -> None:
        """To the nodes of a depth of this round's trees, after the past rounds."""
        goal = 1 + 64 * len(past) + depth
        stage, self.stage[0] = int(self.stage[0]), 0
        if not 0 < stage <= goal:
            stage = 1
            for raw, node, b, fit in zip(self.raw, self.node, self.base, self.fits):
                raw[:], node[:] = b, fit_rows(self.fold, fit)
        r, level = divmod(stage - 1, 64)
        for old in past[r:]:
            for _ in range(level, self.max_depth):
                self.descend(old)
            for node, raw, (_, _, value) in zip(self.node, self.raw, old):
                raw += rate * value.take(node)
                np.minimum(node, 1, out=node)
            level = 0
        for _ in range(level, depth):
            self.descend(trees)
        self.stage[0] = goal

    def descend(self, trees: list) -> None:
        """From nodes that were cut to their children."""
        for node, (feature, cut, _) in zip(self.node, trees):
            f = feature.take(node)
            live = np.flatnonzero(f >= 0)
            at = node.take(live).astype(np.int64)
            node[live] = 2 * at + (self.codes[f.take(live), live] > cut.take(at))

    def count(self, counted: list[np.ndarray], total: list[np.ndarray], logistic: bool) -> None:
        """Adds the rows in counted nodes to the sums (per feature: fits, 2 or 3, nodes, bins)."""
        for k, nodes in enumerate(counted):
            if not len(nodes):
                continue
            place = np.full(2 << self.max_depth, -1, np.int64)
            place[nodes] = np.arange(len(nodes))
            slot = place.take(self.node[k])
            own = np.flatnonzero(slot >= 0)
            slot = slot.take(own)
            g, h = gradients(self.y.take(own), self.raw[k].take(own), logistic)
            for codes, t in zip(self.codes, total):
                key = slot * t.shape[3]
                key += codes.take(own)
                for got, weights in zip(t[k], (None, g, h)):
                    got += np.bincount(key, weights, got.size).reshape(got.shape)


def cut_nodes(ids: list[int], hist: dict[int, list[np.ndarray]], bins: Bins):
    """Per node its best (gain, feature, last bin left, threshold, sums of the left child, sums)."""
    n = len(ids)
    sums = np.stack([hist[i][0].sum(0) for i in ids])
    mean = sums[:, 1] / np.maximum(sums[:, 0], 1.0)
    gains, found = np.full((len(bins.values), n), -1.0), {}
    for f, values in enumerate(bins.values):
        dense = np.stack([hist[i][f] for i in ids])
        node, code = np.nonzero(dense[:, :, 0] > 0.5)
        w, s = dense[node, code, 0], dense[node, code, 1]
        gains[f], last = best_cuts(node, w, (s - mean[node] * w)[:, None], n)
        for k in np.flatnonzero(last >= 0).tolist():
            a, b = int(code[last[k]]), int(code[last[k] + 1])
            found[f, k] = (a, float(middle(values[a:a + 1], values[b:b + 1])[0]) if bins.exact[f] else float(values[a]))
    # Differences that rounding alone makes are no gains.
    gains[gains <= 1e-12 * sums[:, 0] * (mean ** 2 + 1e-300)] = -1.0
    feature = choose(gains)
    return [None if feature[k] < 0 else (gains[feature[k], k], int(feature[k]), *found[feature[k], k]) for k in range(n)], sums


class Growth:
    """The trees of all fits, a round after another, from the sums of their counted nodes."""

    def __init__(self, bins: Bins, fits: int, max_depth: int, logistic: bool):
        self.bins, self.fits, self.max_depth, self.logistic = bins, fits, max_depth, logistic
        self.out = [NodeRows() for _ in range(fits)]

    def begin(self, r: int) -> None:
        self.round, self.depth = r, 0
        self.trees = [new_tree(self.max_depth) for _ in range(self.fits)]
        self.hist: list[dict] = [{} for _ in range(self.fits)]
        self.open = [[1] for _ in range(self.fits)]
        self.counted = [np.array([1]) for _ in range(self.fits)]
        self.siblings: list[list] = [[] for _ in range(self.fits)]

    def leaf(self, sums: np.ndarray) -> float:
        by = sums[2] if self.logistic else sums[0]
        return sums[1] / (sums[2] if self.logistic else max(sums[0], 1.0)) if by > 1e-300 else 0.0

    def grow(self, sums: list[np.ndarray]) -> bool:
        """Cuts the open nodes by the sums (per feature: fits, counted nodes, bins, 2 or 3); whether there is another level."""
        for k in range(self.fits):
            hist, (feature, last, value), out = self.hist[k], self.trees[k], self.out[k]
            for j, node in enumerate(self.counted[k].tolist()):
                hist[node] = [s[k, j] for s in sums]
            for node, other, parent in self.siblings[k]:
                hist[node] = [p - c for p, c in zip(hist[parent], hist[other])]
            grown, small, pairs = [], [], []
            if self.open[k]:
                cuts, total = cut_nodes(self.open[k], hist, self.bins)
                for node, cut, t in zip(self.open[k], cuts, total):
                    value[node] = leaf = self.leaf(t)
                    if cut is None:
                        out.add(self.round, [node], [-1], [np.nan], [leaf], [t[0]], [0.0])
                        continue
                    gain, f, a, threshold = cut
                    feature[node], last[node] = f, a
                    out.add(self.round, [node], [f], [threshold], [leaf], [t[0]], [gain])
                    left = hist[node][f][:a + 1].sum(0)
                    for child, c in ((2 * node, left), (2 * node + 1, t - left)):
                        value[child] = self.leaf(c)
                        if self.depth + 1 == self.max_depth:
                            out.add(self.round, [child], [-1], [np.nan], [value[child]], [c[0]], [0.0])
                    one, two = (2 * node, 2 * node + 1) if left[0] <= t[0] / 2 else (2 * node + 1, 2 * node)
                    small.append(one)
                    pairs.append((two, one, node))
                    grown += [2 * node, 2 * node + 1]
            self.open[k], self.counted[k], self.siblings[k] = sorted(grown), np.array(sorted(small), np.int64), pairs
        self.depth += 1
        return self.depth < self.max_depth and any(self.open)


def part_count(slots: int, rows: int, row_bytes: int, features: int, sums: int) -> int:
    """As many partitions as tasks run at once, but fewer where they would send more sums than they add up rows,
    and more where they would be too large."""
    return max(1, min(slots, rows * features // max(4 * sums, 1)), -(-rows * row_bytes // PART_BYTES))


def level_sums(blocks: RDD, spans: list[int], fits: list[int], base: list[float], past: tuple, growth: Growth, rate: float,
               tag: str) -> list[np.ndarray]:
    """Per feature the sums (fits, counted nodes, bins, 2 or 3) of one pass. ``past``: the trees of the rounds done,
    the earlier ones as a broadcast."""
    trees, counted, depth, max_depth, logistic = growth.trees, growth.counted, growth.depth, growth.max_depth, growth.logistic
    shapes = [(len(fits), 3 if logistic else 2, max(map(len, counted)), s) for s in spans]
    early, late = past

    def count(part):
        total = [np.zeros(shape) for shape in shapes]
        rounds = early.value + late
        os.makedirs(state_folder(tag), exist_ok=True)
        for block, payload in part:
            with Held(pickle.loads(payload), fits, base, max_depth, f"{state_folder(tag)}/{block}") as held:
                held.bring(rounds, trees, depth, rate)
                held.count(counted, total, logistic)
        yield np.concatenate([t.ravel() for t in total]).tobytes()
    got = blocks.mapPartitions(count)
    sizes = [math.prod(shape) for shape in shapes]
    if 8 * sum(sizes) * blocks.getNumPartitions() > SUM_BYTES:
        flat = got.map(np.frombuffer).treeReduce(np.add)
    else:
        flat = sum(map(np.frombuffer, got.collect()))
    return [p.reshape(shape).transpose(0, 2, 3, 1) for p, shape in zip(np.split(flat, np.cumsum(sizes)[:-1]), shapes)]


def fit_boosting(rows: DataFrame, features: list[str], fits: list[int], rounds: int = 100, max_depth: int = 5, rate: float = 0.1,
                 logistic: bool = False, max_bins: int = 1024, rewrite: int = 10, parts: int | None = None) -> dict[int, TreeModel]:
    """One boosted ensemble per fit (as ``forest.fit_forests``) over a written table of ``rows.model_rows``.
    Every ``rewrite`` rounds the trees so far are broadcast. ``parts``: the blocks' partitions."""
    context = rows.sparkSession.sparkContext
    train = rows.where("fold >= 0")
    bins = Bins.of(train, len(features), max_bins)
    by_fold = {r["fold"]: (r["n"], r["s"]) for r in train.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")).collect()}
    base = []
    for fit in fits:
        n, s = (sum(v[k] for f, v in sorted(by_fold.items()) if f != fit) for k in (0, 1))
        m = s / n if n else 0.0
        base.append(float(np.log(m / (1 - m))) if logistic and 0 < m < 1 else 0.0 if logistic else m)
    n, tag, spans = sum(v[0] for v in by_fold.values()), uuid.uuid4().hex, [len(v) for v in bins.values]
    growth, past, early = Growth(bins, len(fits), max_depth, logistic), [], 0
    if n and spans and max_depth:
        sums = (1 << max(max_depth - 2, 0)) * sum(spans) * (3 if logistic else 2)
        row_bytes = 12 + len(spans) * small_codes(np.zeros(1), max(spans)).itemsize
        parts = parts or part_count(context.defaultParallelism, n, row_bytes, len(spans), sums)
        # Small enough to be dealt evenly.
        blocks = packed_blocks(train, bins, max(1, min(BLOCK_ROWS, n // (8 * parts)))).repartition(parts)
        blocks = blocks.rdd.map(lambda r: (r["block"], bytes(r["payload"]))).persist(StorageLevel.MEMORY_AND_DISK)
        told = context.broadcast([])
        for r in range(rounds):
            growth.begin(r)
            while growth.grow(level_sums(blocks, spans, fits, base, (told, past[early:]), growth, rate, tag)):
                pass
            past.append(growth.trees)
            if len(past) - early == rewrite:
                told.destroy()
                told, early = context.broadcast(past), len(past)
        blocks.foreachPartition(lambda part: shutil.rmtree(state_folder(tag), ignore_errors=True))
        blocks.unpersist()
        told.destroy()
    empty = {c: np.zeros(0, np.int64) for c in ("tree", "node", "feature")} | {c: np.zeros(0) for c in ("threshold", "weight", "gain")} \
        | {"value": np.zeros((0, 1))}
    kind = "classification" if logistic else "regression"
    return {fit: TreeModel(features, out.arrays() if out.parts else empty, kind, "sum", 2 if logistic else 0, base[k], rate)
            for k, (fit, out) in enumerate(zip(fits, growth.out))}
