"""Random forests in two phases.

1. While a node holds more than ``node_rows`` rows, all such nodes of all trees
   and fits grow a level at a time: tasks make cells (node, value) of their rows,
   the cells are added up per (fit, tree), and the best cuts go back to the tasks.
   A feature with more than ``max_bins`` distinct values is cut at as many
   quantiles here.
2. Every node that remains holds at most ``node_rows`` rows. They go to one task,
   which finishes the subtree exactly (``trees.grow``). A row moves as the codes of its
   values (a few bytes a feature; numbers where there are more than ``max_bins``), its
   target and its weight. Where all trees still stand at their roots, a task takes some
   trees and all rows once, for all fits: so tables of up to ``WHOLE_ROWS`` are not moved tree by tree.

A row's weight in a tree is Poisson(1) by a hash of (row, tree), so the bags need
no shuffle and are the same on every cluster and retry. *Fits* share the rows: the
full fit and one per fold that leaves that fold out.

The model, at most trees x 2**(depth + 1) nodes a fit, is written to the shared folder as a
row per tree. Of it the driver reads what scoring needs, of one fit at a time; rows never pass it.
"""

from __future__ import annotations

import math
import pickle
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .rows import Bins, partition_count, row_batches
from .trees import (TREES, TreeModel, best_cuts, choose, feature_subsets, grow, hashed, middle, pack_nodes, pack_tree,
                    small_codes)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Chance of at most k in a Poisson(1) draw, as parts of 2**64.
POISSON = np.array([round(sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) * 2.0 ** 63) for k in range(12)], np.uint64)
PARTS = "fit int, tree int, nodes binary"
NODE_ROWS = "fit int, tree int, node long, feature int, threshold double, value array<double>, weight double, gain double"


def bag_weights(row: np.ndarray, tree: int, seed: int) -> np.ndarray:
    u = hashed(np.int64(seed), np.int64(tree), row) >> np.uint64(1)
    w, some = (u >= POISSON[0]).astype(np.float64), None
    for limit in POISSON[1:]:
        # Few rows have more than the last limit.
        some = np.flatnonzero(u >= limit) if some is None else some[u[some] >= limit]
        if not len(some):
            break
        w[some] += 1.0
    return w


def tree_weights(block: dict, fit: int, tree: int, seed: int, some: int = 500_000) -> np.ndarray:
    """The weights of a fit's rows in a tree, a byte each."""
    w = np.zeros(len(block["id"]), np.uint8)
    for lo in range(0, len(w), some):
        w[lo:lo + some] = bag_weights(block["id"][lo:lo + some], tree, seed) * fit_rows(block["fold"][lo:lo + some], fit)
    return w


def targets(y: np.ndarray, classes: int) -> np.ndarray:
    """Rows x targets: the value, or with more than two classes one column each."""
    return y[:, None] if classes <= 2 else (y[:, None] == np.arange(classes)).astype(np.float64)


def fit_rows(fold: np.ndarray, fit: int) -> np.ndarray:
    """Training rows (fold >= 0) of a fit: all (-1), or those outside a fold."""
    return (fold >= 0) & (fold != fit)


def node_batch(fit: np.ndarray, n: dict[str, np.ndarray]) -> pa.RecordBatch:
    k = n["value"].shape[1]
    value = pa.ListArray.from_arrays(pa.array(np.arange(len(fit) + 1, dtype=np.int32) * k), pa.array(n["value"].ravel()))
    return pa.RecordBatch.from_arrays(
        [pa.array(fit.astype(np.int32)), pa.array(n["tree"].astype(np.int32)), pa.array(n["node"]),
         pa.array(n["feature"].astype(np.int32)), pa.array(n["threshold"]), value, pa.array(n["weight"]), pa.array(n["gain"])],
        ["fit", "tree", "node", "feature", "threshold", "value", "weight", "gain"])


def finish(block: dict, work: list[tuple[int, int, int]], p: dict):
    """Yields the subtrees (fit, tree, node) grown on rows held in memory. Columns that ``p["values"]``
    knows are codes; a unit of one node has its weights, one of trees makes them."""
    codes, values = [], []
    for f, known in enumerate(p["values"]):
        col, block["x"][f] = block["x"][f], None
        if known is None:
            v, c = np.unique(col, return_inverse=True)
        else:
            some = np.bincount(col, minlength=len(known)) > 0
            v, c = known[some], (np.cumsum(some) - 1)[col]
        codes.append(small_codes(c, len(v)))
        values.append(v)
    y = targets(block["y"], p["classes"])
    for fit, tree, node in work:
        w = block["w"] if "w" in block else tree_weights(block, fit, tree, p["seed"])
        out = grow(codes, values, y, w, p["max_depth"], tree, p["mtry"], node)
        if out.parts:
            yield pa.RecordBatch.from_arrays([pa.array([fit], pa.int32()), pa.array([tree], pa.int32()), pa.array([pack_nodes(out.arrays())], pa.binary())],
                                             ["fit", "tree", "nodes"])


def joined(blocks: list[dict]) -> dict:
    out = {k: np.concatenate([b.pop(k) for b in blocks]) for k in [k for k in blocks[0] if k != "x"]}
    out["x"] = []
    for f in range(len(blocks[0]["x"])):
        out["x"].append(np.concatenate([b["x"][f] for b in blocks]))
        for b in blocks:
            b["x"][f] = None
    return out


def finish_units(units: DataFrame, p: dict, parts: int) -> DataFrame:
    """Phase 2: rows (unit, work, payload), a unit to one task, in order of units."""
    def run(batches):
        unit, held, work = None, [], None
        for batch in batches:
            for k, u in enumerate(batch.column(0).to_pylist()):
                if u != unit and held:
                    block, held = joined(held), []
                    yield from finish(block, work, p)
                unit, work = u, pickle.loads(batch.column(1)[k].as_buffer())
                held.append(pickle.loads(batch.column(2)[k].as_buffer()))
        if held:
            yield from finish(joined(held), work, p)
    return (units.repartitionById(parts, F.pmod(F.col("unit"), F.lit(parts)).cast("int")).sortWithinPartitions("unit")
                 .mapInArrow(run, PARTS))


def tree_rows_of(parts: DataFrame) -> DataFrame:
    """A row per tree from the parts of its nodes."""
    def pack(key, table):
        score, rest = pack_tree(table["nodes"].to_pylist())
        return pa.table({"fit": pa.array([key[0].as_py()], pa.int32()), "tree": pa.array([key[1].as_py()], pa.int32()),
                         "score": pa.array([score], pa.binary()), "rest": pa.array([rest], pa.binary())})
    return parts.groupBy("fit", "tree").applyInArrow(pack, TREES)


def unit_batch(units: list[int], work: list[bytes], payloads: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(units, pa.int64()), pa.array(work, pa.binary()), pa.array(payloads, pa.binary())],
                                      ["unit", "work", "payload"])


def coded(block: dict, bins: Bins | None) -> list[np.ndarray]:
    """Per feature the codes of a block where they stand for the values, the values elsewhere."""
    return [small_codes(bins.codes(f, x), len(bins.values[f])) if bins is not None and bins.exact[f] else x
            for f, x in enumerate(block["x"])]


def whole_trees(rows: DataFrame, fits: list[int], trees: int, parts: int, bins: Bins | None = None) -> DataFrame:
    """Units of some trees with all rows."""
    chunks = [list(range(k, trees, min(parts, trees))) for k in range(min(parts, trees))]
    work = [pickle.dumps([(f, t, 1) for f in fits for t in c]) for c in chunks]

    def run(batches):
        for block in row_batches(batches):
            # Few bytes a row, as every task gets it.
            number = np.int32 if block["id"].max(initial=0) < 1 << 31 else np.int64
            fold = np.int8 if block["fold"].max(initial=0) < 1 << 7 else np.int32
            payload = pickle.dumps(block | {"x": coded(block, bins), "id": block["id"].astype(number), "fold": block["fold"].astype(fold)}, 5)
            for u in range(len(work)):
                yield unit_batch([u], [work[u]], [payload])
    return rows.mapInArrow(run, "unit long, work binary, payload binary")


class Walker:
    """The open node, by its place in ``nodes``, that a row has reached in a partly grown tree (-1: another node)."""

    def __init__(self, inner: dict[int, tuple[int, float]], nodes: list[int], bins: Bins):
        ids = np.array(sorted({1, *(c for n in inner for c in (2 * n, 2 * n + 1))}), np.int64)
        self.feature, self.last = np.zeros(len(ids), np.int64), np.full(len(ids), 1 << 30, np.int64)
        # Other nodes lead to themselves.
        self.left = np.arange(len(ids))
        for k, n in enumerate(ids.tolist()):
            if n in inner:
                f, threshold = inner[n]
                # The codes of all bins up to the threshold are at most this one.
                self.feature[k], self.last[k] = f, np.searchsorted(bins.values[f], threshold, side="right") - 1
                self.left[k] = np.searchsorted(ids, 2 * n)
        self.root, self.depth = int(np.searchsorted(ids, 1)), int(ids[-1]).bit_length() - 1
        self.slot = np.full(len(ids), -1, np.int64)
        self.slot[np.searchsorted(ids, nodes)] = np.arange(len(nodes))

    def slots(self, flat: np.ndarray, start: np.ndarray) -> np.ndarray:
        """For rows whose codes begin at ``start`` in ``flat``."""
        if not self.depth:
            return np.full(len(start), self.slot[0])
        at = np.full(len(start), self.root, np.int64)
        for _ in range(self.depth):
            right = flat.take(start + self.feature.take(at)) > self.last.take(at)
            at = self.left.take(at)
            at += right
        return self.slot.take(at)


def tree_rows(batches, bins: Bins, walkers: dict, p: dict, flush: int = 100_000):
    """Per block of rows, and fit and tree: (block with codes, (fit, tree), weights, the rows in open nodes, their slots)."""
    by_tree: dict[int, list[int]] = {}
    for fit, tree in walkers:
        by_tree.setdefault(tree, []).append(fit)
    for block in row_batches(batches, flush):
        block["codes"] = [small_codes(bins.codes(f, x), len(bins.values[f])) for f, x in enumerate(block["x"])]
        flat = np.stack([c.astype(np.uint16) for c in block["codes"]], 1)
        width, flat = flat.shape[1], flat.ravel()
        for tree, fits in by_tree.items():
            bag = bag_weights(block["id"], tree, p["seed"])
            for fit in fits:
                own = np.flatnonzero(bag if fit < 0 else bag * fit_rows(block["fold"], fit))
                slot = walkers[fit, tree].slots(flat, own * width)
                if slot.min(initial=0) < 0:
                    own, slot = own[slot >= 0], slot[slot >= 0]
                if len(own):
                    yield block, (fit, tree), bag, own, slot


def node_units(rows: DataFrame, models: dict, frontier: dict, bins: Bins, p: dict) -> DataFrame:
    """Units of one open node each with its rows; (fit, tree) -> open nodes."""
    order = {(f, t, n): k for k, (f, t, n) in enumerate(sorted((f, t, n) for (f, t), ns in frontier.items() for n in ns))}
    walkers = {key: Walker(models[key], frontier[key], bins) for key in frontier}

    def run(batches):
        last, x = None, None
        for block, (fit, tree), bag, own, slot in tree_rows(batches, bins, walkers, p, 400_000):
            if block is not last:
                last, x = block, [block["codes"][f] if bins.exact[f] else v for f, v in enumerate(block["x"])]
            nodes = frontier[fit, tree]
            by = np.argsort(slot.astype(np.uint16) if len(nodes) <= 1 << 16 else slot, kind="stable")
            own, ends = own[by], np.cumsum(np.bincount(slot, minlength=len(nodes)))
            units, work, payloads = [], [], []
            for n, some in zip(nodes, np.split(own, ends[:-1])):
                if len(some):
                    part = {"x": [c[some] for c in x], "y": block["y"][some], "w": bag[some].astype(np.uint8)}
                    units.append(order[fit, tree, n])
                    work.append(pickle.dumps([(fit, tree, n)]))
                    payloads.append(pickle.dumps(part, 5))
            yield unit_batch(units, work, payloads)
    return rows.mapInArrow(run, "unit long, work binary, payload binary")


#: Sums a task holds before it passes them on.
SUM_BYTES = 64 << 20


def level(rows: DataFrame, bins: Bins, models: dict, frontier: dict, p: dict) -> list:
    """Phase 1: the best cuts of all open nodes, from one pass over the rows."""
    walkers = {key: Walker(models[key], frontier[key], bins) for key in frontier}
    spans, n_sums = [len(v) for v in bins.values], 2 if p["classes"] <= 2 else 1 + p["classes"]
    keep = sum(len(ns) for ns in frontier.values()) * sum(spans) * n_sums * 8 <= SUM_BYTES

    def make_cells(batches):
        def partial(key, sums, squares):
            found = []
            for got in sums:
                some = np.flatnonzero(got[0] > 0)
                found.append((some, np.stack([v[some] for v in got], 1)))
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                                               pa.array([pickle.dumps((found, squares), 5)], pa.binary())], ["fit", "tree", "cells"])
        held: dict = {}
        last, y = None, None
        for block, key, bag, own, slot in tree_rows(batches, bins, walkers, p, 100_000 if keep else 1_000_000):
            if block is not last:
                last, y = block, targets(block["y"], p["classes"])
            nodes, wt = len(frontier[key]), bag[own]
            ys = [y[own, k] for k in range(y.shape[1])]
            weights = [wt, *(wt * v for v in ys)]
            squares = np.bincount(slot, sum(v * v for v in ys) * wt, nodes)
            sums = []
            for c, span in zip(block["codes"], spans):
                cell = slot * span
                cell += c[own]
                sums.append([np.bincount(cell, v, nodes * span) for v in weights])
            if not keep:
                yield partial(key, sums, squares)
            elif key not in held:
                held[key] = (sums, squares)
            else:
                for a, b in zip(held[key][0], sums):
                    for one, two in zip(a, b):
                        one += two
                held[key][1][:] += squares
        for key, (sums, squares) in held.items():
            yield partial(key, sums, squares)

    def cut(key, table):
        fit, tree = key[0].as_py(), key[1].as_py()
        ids = np.array(frontier[fit, tree], np.int64)
        nodes = len(ids)
        parts = [pickle.loads(x) for x in table["cells"].to_pylist()]
        gains, mark = np.full((len(bins.values), nodes), -1.0), np.full((len(bins.values), nodes), np.nan)
        side, sums, squares = np.zeros((len(bins.values), nodes)), None, sum(q for _, q in parts)
        for f, values in enumerate(bins.values):
            span = len(values)
            every = np.unique(np.concatenate([q[f][0] for q, _ in parts]))
            got = np.zeros((len(every), n_sums))
            for q, _ in parts:
                got[np.searchsorted(every, q[f][0])] += q[f][1]
            node = every // span
            if sums is None:
                sums = np.stack([np.bincount(node, got[:, k], nodes) for k in range(n_sums)], 1)
                mean = sums[:, 1:] / np.maximum(sums[:, :1], 1e-300)
            centred = got[:, 1:] - mean[node] * got[:, :1]
            gains[f], last = best_cuts(node, got[:, 0], centred, nodes)
            has = np.flatnonzero(last >= 0)
            left = np.cumsum(got[:, 0])
            first = np.searchsorted(node, has)
            side[f, has] = left[last[has]] - left[first] + got[first, 0]
            a, b = every[last[has]] % span, every[last[has] + 1] % span
            mark[f, has] = middle(values[a], values[b]) if bins.exact[f] else values[a]
        rest = squares - (sums[:, 1:] ** 2).sum(1) / np.maximum(sums[:, 0], 1e-300)
        # Pure nodes and those at full depth are leaves.
        gains[:, rest <= 1e-12 * np.maximum(squares, 1e-300)] = -1.0
        gains[:, [n.bit_length() > p["max_depth"] for n in ids.tolist()]] = -1.0
        feature, lane = choose(gains, feature_subsets(tree, ids, gains, p["mtry"])), np.arange(nodes)
        out = {"tree": np.full(nodes, tree), "node": ids, "feature": feature,
               "threshold": np.where(feature >= 0, mark[feature, lane], np.nan), "value": mean, "weight": sums[:, 0],
               "gain": np.where(feature >= 0, gains[feature, lane], 0.0)}
        batch = node_batch(np.full(nodes, fit), out)
        return pa.Table.from_batches([batch]).append_column("left", pa.array(np.where(feature >= 0, side[feature, lane], 0.0)))
    return (rows.mapInArrow(make_cells, "fit int, tree int, cells binary").groupBy("fit", "tree")
                .applyInArrow(cut, f"{NODE_ROWS}, left double").collect())


#: So many more rows a unit may have if all its columns are codes.
CODED_ROWS = 2
#: Rows of a table that a task holds whole, if all columns are codes.
WHOLE_ROWS = 1 << 22
#: Bytes that phase 2 gives a task.
PART_BYTES = 128 << 20


def row_bytes(bins: Bins) -> int:
    """A row's codes or numbers, target and weight."""
    return 9 + sum(small_codes(np.zeros(1), len(v)).itemsize if exact else 8 for v, exact in zip(bins.values, bins.exact))


def fit_forests(rows: DataFrame, features: list[str], fits: list[int], trees: int, max_depth: int, classes: int = 0,
                mtry: int | None = None, seed: int = 42, node_rows: int | None = None, max_bins: int = 1024) -> dict[int, TreeModel]:
    """One forest per fit (-1: all rows of folds >= 0; k: without fold k) over a
    written table of ``rows.model_rows``."""
    node_rows, whole_rows = node_rows or 1 << 20, node_rows or WHOLE_ROWS
    p = {"classes": classes, "mtry": mtry, "seed": seed, "max_depth": max_depth, "values": [None] * len(features)}
    parts = partition_count(rows.sparkSession)
    kind = "classification" if classes else "regression"
    train = rows.where("fold >= 0")
    n = train.count()
    done: list[tuple[int, int, bytes]] = []
    bins = Bins.of(train, len(features), max_bins) if n > node_rows else None
    if bins is not None:
        p["values"] = [v if exact else None for v, exact in zip(bins.values, bins.exact)]
        # Rows of codes are small, and both phases are exact on them.
        node_rows *= CODED_ROWS if all(bins.exact) else 1
    if n <= max(node_rows, whole_rows if bins is None or all(bins.exact) else 0):
        # Every task costs a copy of the rows.
        parts = max(1, min(parts, trees, rows.sparkSession.sparkContext.defaultParallelism))
        found = finish_units(whole_trees(train, fits, trees, parts, bins), p, parts)
    else:
        models = {(f, t): {} for f in fits for t in range(trees)}
        grown, ready = [], {key: [] for key in models}
        frontier = {key: [1] for key in models}
        while frontier:
            after: dict = {}
            for r in level(train, bins, models, frontier, p):
                key = (r["fit"], r["tree"])
                grown.append(r)
                if r["feature"] < 0:
                    continue
                models[key][r["node"]] = (r["feature"], r["threshold"])
                for child, weight in ((2 * r["node"], r["left"]), (2 * r["node"] + 1, r["weight"] - r["left"])):
                    # A node's weight is at least its number of rows.
                    (after if weight > node_rows else ready).setdefault(key, []).append(child)
            frontier = {k: sorted(v) for k, v in after.items()}
        ready = {k: sorted(v) for k, v in ready.items() if v}
        # A task holds and sorts about as much as a few units.
        size = n * (1.0 - math.exp(-1)) * trees * len(fits) * row_bytes(bins)
        found = finish_units(node_units(train, models, ready, bins, p), p, max(parts, math.ceil(size / PART_BYTES)))
        by_tree: dict[tuple, list] = {}
        for r in grown:
            by_tree.setdefault((r["fit"], r["tree"]), []).append(r)
        for (f, t), own in by_tree.items():
            done.append((f, t, pack_nodes({c: np.array([r[c] for r in own], float if c in ("threshold", "weight", "gain") else np.int64)
                                           for c in ("node", "feature", "threshold", "weight", "gain")}
                                          | {"value": np.array([r["value"] for r in own], float)})))
    if done:
        found = found.unionByName(rows.sparkSession.createDataFrame(done, PARTS))
    model = written(tree_rows_of(found), "forest")
    return {f: TreeModel(features, None, kind, "mean", classes, source=model.where(F.col("fit") == f)) for f in fits}
