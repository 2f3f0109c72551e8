"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine c are at squared distance 2 - 2c. A seeded rotation
spreads any difference over all coordinates; the rotated vectors are split into
``blocks`` low-dimensional blocks, and a pair within the distance must be within
its share of it (the block's part of the dimensions) in at least one block.
Per block a range join over a grid finds those pairs: a vector lies in the
cell of its block's first ``axes`` coordinates, and is sent as a visitor to the
cells after its own that its budget reaches. What is sent is a hash of the vector and, in
a byte each, the coordinates of its block and of some more dimensions; their distances,
less the greatest rounding, decide who are candidates (the block's by its share of the
distance, all by the whole). Only a spanning forest leaves a cell.

The candidates of all blocks are connected into groups; each vector moves once, to its
group, where all pairs of equal labels are compared by their exact cosine. So the disk
that the search takes is a few bytes per coordinate, however many cells a vector visits.

Equal vectors with equal labels are one row with a number of copies first.
Cells with more than ``cell`` vectors, and groups with more than ``part``, are split into
parts that meet pairwise, so one with a third of all vectors is worked on by many tasks.

Defined results: vectors that are null, zero or hold null or non-finite
components, and rows with a null label, link with nothing; vectors of
different lengths link with nothing; rows with equal ids are vectors each; a
null id comes first; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .jaccard import forest
from .kernels import materialise, mix64, null_first, partitions, pick, ship

ship(__name__)

#: Room for rounding in the search; the exact cosine decides.
SLACK = 1e-9


def rotation(size: int, seed: int = 11) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def block_edges(size: int, blocks: int) -> np.ndarray:
    return np.linspace(0, size, min(blocks, size) + 1).round().astype(np.int64)


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 without overflow."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])
    return x / np.sqrt((x * x).sum(1, keepdims=True))


class Vectors:
    """The rows of a batch (vec_id, label, embedding) that can link: their places, components and identities."""

    def __init__(self, batch: pa.RecordBatch):
        lists = batch.column(2)
        size = np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)
        # A null list may cover values, which are none of its own.
        flat = lists.flatten()
        self.flat = np.asarray(flat.fill_null(float("nan")))
        first = np.cumsum(size) - size
        some = np.flatnonzero(size)
        good = np.zeros(len(batch), bool)
        if len(some):
            good[some] = np.logical_and.reduceat(np.isfinite(self.flat), first[some]) & np.logical_or.reduceat(self.flat != 0, first[some])
        self.rows = np.flatnonzero(good)
        self.first, self.size = first[self.rows], size[self.rows]
        label = np.asarray(batch.column(1)).astype(np.int64)
        self.label = label[self.rows]

    def of_size(self, size: int, some: np.ndarray) -> np.ndarray:
        # Both zeros are one.
        return self.flat[self.first[some][:, None] + np.arange(size)] + 0.0

    def sizes(self):
        """(size, the vectors that have it, their components), a bounded number of them at a time."""
        for size in np.unique(self.size).tolist():
            own = np.flatnonzero(self.size == size)
            for k in range(0, len(own), 4096):
                yield size, own[k:k + 4096], self.of_size(size, own[k:k + 4096])

    def ids(self, some: np.ndarray, x: np.ndarray) -> list[bytes]:
        """Equal for equal vectors with equal labels only."""
        heads = np.stack([np.full(len(some), x.shape[1]), self.label[some]], 1).astype("<i8")
        return [blake2b(v.tobytes(), digest_size=16, key=h.tobytes()).digest() for h, v in zip(heads, x.astype("<f8"))]


def nodes_of(ids: list[bytes]) -> np.ndarray:
    """The first half of the identities: who are candidates may be told by it, who are linked is not."""
    return np.frombuffer(b"".join(ids), "<i8")[::2]


def identities(vectors: DataFrame) -> DataFrame:
    """(vec_id, id, node) of the rows that can link."""
    def run(batches):
        for batch in batches:
            v = Vectors(batch)
            for _, some, x in v.sizes():
                ids = v.ids(some, x)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(v.rows[some])), pa.array(ids, pa.binary()), pa.array(nodes_of(ids))],
                                                 ["vec_id", "id", "node"])
    return vectors.mapInArrow(run, "vec_id long, id binary, node long")


def once(vectors: Vectors, some: np.ndarray, x: np.ndarray, seen: set) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Without vectors that a task has met before."""
    keep, ids = [], []
    for k, i in enumerate(vectors.ids(some, x)):
        if i not in seen:
            seen.add(i)
            keep.append(k)
            ids.append(i)
    return some[keep], x[keep], ids


def visits(x: np.ndarray, label: np.ndarray, cosine: float, blocks: int, axes: int, turn: np.ndarray):
    """Per block and neighbour (block, the vectors that lie in or visit a cell there, hash of the cell, whether it
    is their own, the coordinates of their block and of ``MORE`` others in bytes)."""
    size = x.shape[1]
    y, edges = unit_rows(x.astype(np.float64)) @ turn, block_edges(size, blocks)
    # Four deviations of a coordinate; cutting off the rest makes no distance greater.
    bytes_ = np.clip(np.round(y / step(size)), -127, 127).astype(np.int8)
    for b, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        reach, sent = block_reach(size, int(hi - lo), cosine), np.arange(lo, hi + min(MORE, size - (hi - lo))) % size
        width = 3 * reach
        z = y[:, lo:min(hi, lo + axes)]
        cell = np.floor(z / width).astype(np.int64)
        # Squared distance to the neighbour below and above on each axis.
        gap = np.stack([z - cell * width, (cell + 1) * width - z], 2)
        offsets = np.stack(np.meshgrid(*[[-1, 0, 1]] * z.shape[1], indexing="ij"), -1).reshape(-1, z.shape[1])
        for offset in offsets:
            home = not offset.any()
            if not home and tuple(offset) < (0,) * z.shape[1]:
                continue
            side = np.maximum(offset, 0)
            far = sum((np.where(offset[k] != 0, gap[:, k, side[k]], 0.0) ** 2 for k in range(z.shape[1])), np.zeros(len(z)))
            some = np.flatnonzero(far <= reach * reach + SLACK)
            if len(some):
                h = mix64((label[some] * np.int64(1_000_003) + np.int64(size * 4099 + b)).view(np.uint64))
                for k in range(z.shape[1]):
                    h = mix64(h + (cell[some, k] + offset[k]).view(np.uint64))
                yield b, some, h, home, bytes_[some[:, None], sent]


#: Dimensions beside a block's own that a candidate is judged by.
MORE = 12


def step(size: int) -> float:
    return 4.0 / (127 * size ** 0.5)


def block_reach(size: int, dims: int, cosine: float) -> float:
    return ((2 - 2 * cosine) * dims / size + SLACK) ** 0.5


def crowded(vectors: DataFrame, cosine: float, blocks: int, axes: int, cell: int) -> dict[int, int]:
    """Cells with more than ``cell`` vectors, and their number of parts. They are few: a vector lies in and visits
    some 20 cells."""
    def run(batches):
        seen, turns, counts = set(), {}, {}
        for batch in batches:
            v = Vectors(batch)
            for size, some, x in v.sizes():
                some, x, _ = once(v, some, x, seen)
                if len(some):
                    if size not in turns:
                        turns[size] = rotation(size)
                    found = np.concatenate([h for _, _, h, _, _ in visits(x, v.label[some], cosine, blocks, axes, turns[size])])
                    for h, n in zip(*(u.tolist() for u in np.unique(found, return_counts=True))):
                        counts[h] = counts.get(h, 0) + n
            if len(counts) > 1_000_000:
                yield tally(counts)
                counts = {}
        yield tally(counts)

    def tally(counts: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.array(list(counts), np.uint64).view(np.int64)), pa.array(list(counts.values()), pa.int64())],
                                          ["cell", "n"])
    full = vectors.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") > cell)
    return {r["cell"] % (1 << 64): -(-r["n"] // cell) for r in full.collect()}


FLUSH_BYTES = 32 << 20


def cells_of(vectors: DataFrame, cosine: float, blocks: int, axes: int, parts: dict[int, int], buckets: int) -> DataFrame:
    """Rows (bucket, size, block, payload): the vectors in and visiting cells, packed."""
    big = np.array(sorted(parts), np.uint64)

    def split(h: np.ndarray, node: np.ndarray):
        """Vectors of crowded cells meet part by part: (places, hashes)."""
        at = np.minimum(np.searchsorted(big, h), len(big) - 1)
        full = big[at] == h
        places, hashes = [np.flatnonzero(~full)], [h[~full]]
        for c in np.unique(h[full]).tolist():
            own, n = np.flatnonzero(h == np.uint64(c)), parts[c]
            mine = (mix64(node[own].view(np.uint64)) % np.uint64(n)).astype(np.int64)
            for other in range(n):
                places.append(own)
                hashes.append(mix64(np.uint64(c) + (np.minimum(mine, other) * n + np.maximum(mine, other) + 1).astype(np.uint64)))
        return np.concatenate(places), np.concatenate(hashes)

    def flush(held: dict):
        rows = []
        for (size, block), found in held.items():
            h, node, home, q = (np.concatenate(x) for x in zip(*found))
            bucket = (h % np.uint64(buckets)).astype(np.int64)
            by = np.lexsort((h, bucket))
            ends = np.cumsum(np.bincount(bucket, minlength=buckets))
            for k, some in enumerate(np.split(by, ends[:-1])):
                if len(some):
                    cells = np.unique(h[some], return_counts=True)
                    payload = (*cells, node[some].astype("<i8"), np.packbits(home[some]), q[some])
                    rows.append((k, size, block, pickle.dumps(payload, 5)))
        bucket, size, block, payload = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(size, pa.int32()), pa.array(block, pa.int32()),
                                           pa.array(payload, pa.binary())], ["bucket", "size", "block", "payload"])

    def run(batches):
        seen, turns, held, n = set(), {}, {}, 0
        for batch in batches:
            v = Vectors(batch)
            for size, some, x in v.sizes():
                some, x, ids = once(v, some, x, seen)
                if not len(some):
                    continue
                if size not in turns:
                    turns[size] = rotation(size)
                node = nodes_of(ids)
                for block, own, h, home, q in visits(x, v.label[some], cosine, blocks, axes, turns[size]):
                    who = node[own]
                    if len(big):
                        at, h = split(h, who)
                        who, q = who[at], q[at]
                    held.setdefault((size, block), []).append((h, who, np.full(len(h), home), q))
                    n += len(h) * (17 + q.shape[1])
                if n > FLUSH_BYTES:
                    yield flush(held)
                    held, n = {}, 0
        if held:
            yield flush(held)
    return vectors.mapInArrow(run, "bucket int, size int, block int, payload binary")


class Links:
    """A spanning forest of the pairs met so far."""

    def __init__(self, n: int):
        self.n, self.a, self.b, self.held = n, [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.held += len(a)
        if self.held > max(2_000_000, 2 * self.n):
            label = self.labels()
            moved = np.flatnonzero(label != np.arange(self.n))
            self.a, self.b, self.held = [moved], [label[moved]], len(moved)

    def labels(self) -> np.ndarray:
        if not self.a:
            return np.arange(self.n)
        return forest(self.n, np.concatenate(self.a), np.concatenate(self.b))


def near_pairs(links: Links, q: np.ndarray, who: np.ndarray, first: np.ndarray, count: np.ndarray, lived: np.ndarray,
               dims: int, limits: tuple[float, float]) -> None:
    """The candidates within each cell (rows first .. first + count - 1, of which the first ``lived`` are at home):
    near by the first ``dims`` coordinates and by all."""
    def meet(a, b):
        d = q[a].astype(np.int32) - q[b]
        d *= d
        near = (d[:, :dims].sum(1) <= limits[0]) & (d.sum(1) <= limits[1])
        links.add(who[a[near]], who[b[near]])
    small = count <= 32
    # All cells of one size together.
    for n, h in np.unique(np.stack([count[small], lived[small]], 1), axis=0).tolist():
        i, j = np.triu_indices(n, 1)
        i, j = i[i < h], j[i < h]
        own, some = first[small & (count == n) & (lived == h)], max(1, 500_000 // len(i))
        for k in range(0, len(own), some):
            meet((own[k:k + some, None] + i).ravel(), (own[k:k + some, None] + j).ravel())
    for c in np.flatnonzero(~small).tolist():
        lo, n = first[c], count[c]
        z = q[lo:lo + n, :dims].astype(np.float32)
        square = (z * z).sum(1, keepdims=True)
        # One product gives the squared distances; whole numbers, so exact.
        left, right = np.concatenate([-2 * z, square, np.ones_like(square)], 1), np.concatenate([z, np.ones_like(square), square], 1).T
        for k in range(0, lived[c], 256):
            rows = left[k:min(k + 256, lived[c])]
            at = np.flatnonzero(rows @ right[:, k:] <= limits[0])
            a, b = at // (n - k), at % (n - k)
            ok = a < b
            for m in range(0, ok.sum(), 500_000):
                meet(lo + k + a[ok][m:m + 500_000], lo + k + b[ok][m:m + 500_000])


def candidates(cells: DataFrame, cosine: float, blocks: int) -> DataFrame:
    """(a, b): a spanning forest of the candidates of each bucket and block."""
    def run(table: pa.Table) -> pa.Table:
        by_block: dict[tuple, list] = {}
        for size, block, payload in zip(table["size"].to_pylist(), table["block"].to_pylist(), table["payload"]):
            by_block.setdefault((size, block), []).append(pickle.loads(payload.as_buffer()))
        ends = [], []
        for (size, block), found in by_block.items():
            cell, node, home, q = (np.concatenate(x) for x in zip(*((np.repeat(c, k), n, np.unpackbits(h)[:len(n)].astype(bool), q)
                                                                   for c, k, n, h, q in found)))
            found.clear()
            by = np.lexsort((node, ~home, cell))
            cell, node, home, q = cell[by], node[by], home[by], q[by]
            # A vector that several tasks have met; where two vectors share a node, both stay.
            new = np.concatenate([[True], (cell[1:] != cell[:-1]) | (node[1:] != node[:-1]) | (home[1:] != home[:-1]) | (q[1:] != q[:-1]).any(1)])
            cell, node, home, q = cell[new], node[new], home[new], q[new]
            first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            count, lived = np.diff(np.append(first, len(cell))), np.add.reduceat(home.astype(np.int64), first)
            some = (count > 1) & (lived > 0)
            names, who = np.unique(node, return_inverse=True)
            links = Links(len(names))
            edges = block_edges(size, blocks)
            dims, every = int(edges[block + 1] - edges[block]), q.shape[1]
            limits = [(reach / step(size) + d ** 0.5) ** 2 * (1 + 1e-6)
                      for reach, d in ((block_reach(size, dims, cosine), dims), (block_reach(size, size, cosine), every))]
            near_pairs(links, q, who, first[some], count[some], lived[some], dims, limits)
            label = links.labels()
            moved = np.flatnonzero(label != np.arange(len(names)))
            ends[0].append(names[moved])
            ends[1].append(names[label[moved]])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in ends)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return cells.groupBy("bucket").applyInArrow(run, "a long, b long")


def whole(vectors: DataFrame) -> DataFrame:
    """(id, label, size, vector as bytes) of the rows that can link, in the precision they are given in."""
    def run(batches):
        seen = set()
        for batch in batches:
            v = Vectors(batch)
            for size, some, x in v.sizes():
                some, x, ids = once(v, some, x, seen)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(v.label[some]), pa.array([size] * len(some), pa.int32()),
                                                  pa.array([r.tobytes() for r in x], pa.binary())], ["id", "label", "size", "vector"])
    return vectors.mapInArrow(run, "id binary, label long, size int, vector binary")


def group_links(rows: DataFrame, cosine: float, part: int, buckets: int) -> DataFrame:
    """Rows (id, links, other, whole) from (group, n, id, copies, label, size, vector): counts of linked copies (other
    null), and a spanning forest; ``whole``: of a group that was compared in one piece."""
    rows = rows.withColumn("parts", F.ceil(F.col("n") / part).cast("int"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("group", "i", "j"), F.lit(buckets)).cast("int"))

    def run(table: pa.Table) -> pa.Table:
        held: dict[tuple, dict] = {}
        for g, i, j, parts, mine, label, size, k, c, v in zip(*(table[x].to_pylist() for x in (
                "group", "i", "j", "parts", "part", "label", "size", "id", "copies", "vector"))):
            # Several tasks may have read copies of a vector.
            held.setdefault((g, i, j, parts, label, size), {})[k] = (mine, c, v)
        ids, links, others, single = [], [], [], []
        for (_, i, j, parts, _, size), own in held.items():
            if len(own) < 2:
                continue
            # The lesser id first, so that all tasks compute the same numbers.
            names = sorted(own)
            side, copies = np.array([own[k][0] for k in names]), np.array([own[k][1] for k in names])
            x = np.stack([np.frombuffer(own[k][2], "<f4" if len(own[k][2]) == 4 * size else "<f8") for k in names]).astype(np.float64)
            # Powers of two change no digits, and products cannot overflow.
            x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])
            y, tree, count = unit_rows(x), Links(len(names)), np.zeros(len(names))
            for lo in range(0, len(names), 512):
                a, b = np.nonzero(y[lo:lo + 512] @ y[lo:].T >= cosine - 1e-9)
                ok = (a < b) & ((side[lo + a] != side[lo + b]) | (i == j))
                a, b = lo + a[ok], lo + b[ok]
                for k in range(0, len(a), 20_000):
                    u, v = x[a[k:k + 20_000]], x[b[k:k + 20_000]]
                    near = (u * v).sum(1) / (np.sqrt((u * u).sum(1)) * np.sqrt((v * v).sum(1))) >= cosine
                    p, q = a[k:k + 20_000][near], b[k:k + 20_000][near]
                    count += np.bincount(p, copies[q], len(names)) + np.bincount(q, copies[p], len(names))
                    tree.add(p, q)
            label = tree.labels()
            some, moved = np.flatnonzero(count), np.flatnonzero(label != np.arange(len(names)))
            ids += [names[k] for k in some] + [names[k] for k in moved]
            links += [*count[some].astype(np.int64).tolist(), *[None] * len(moved)]
            others += [*[None] * len(some), *[names[k] for k in label[moved]]]
            single += [parts == 1] * (len(some) + len(moved))
        return pa.table({"id": pa.array(ids, pa.binary()), "links": pa.array(links, pa.int64()), "other": pa.array(others, pa.binary()),
                         "whole": pa.array(single, pa.bool_())})
    return rows.select("bucket", "group", "i", "j", "parts", "part", "label", "size", "id", "copies", "vector") \
        .groupBy("bucket").applyInArrow(run, "id binary, links long, other binary, whole boolean")


def near_vectors(embeddings: DataFrame, cosine: float = 0.98, blocks: int = 8, axes: int = 3,
                 part: int = 2000, cell: int = 50_000) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept."""
    embeddings, buckets = pick(embeddings, "vec_id", "embedding", "label"), partitions(embeddings.sparkSession)
    kind = "array<float>" if dict(embeddings.dtypes)["embedding"] == "array<float>" else "array<double>"
    vectors = embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast(kind)) \
        .where("label IS NOT NULL AND embedding IS NOT NULL")
    rows = materialise(identities(vectors), "vectors")
    distinct = materialise(rows.groupBy("id", "node").agg(
        F.count(F.lit(1)).alias("copies"), F.min(null_first(F.col("vec_id"))).alias("least")), "distinct-vectors")
    # No cell is crowded in a small table.
    parts = crowded(vectors, cosine, blocks, axes, cell) if distinct.count() > cell else {}
    pairs = candidates(cells_of(vectors, cosine, blocks, axes, parts, buckets), cosine, blocks)
    groups = components(pairs, name="vector-groups").select("node", F.col("component").alias("group"))
    sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    members = distinct.select("id", "node", "copies").join(groups.join(sizes, "group"), "node").select("id", "copies", "group", "n")
    found = materialise(group_links(whole(vectors).join(members, "id"), cosine, part, buckets), "vector-links")
    linked = found.where("other IS NULL").groupBy("id").agg(F.sum("links").alias("links"))
    trees = found.where("other IS NOT NULL")
    classes = components(trees.where("NOT whole").select(F.col("id").alias("a"), F.col("other").alias("b")), name="vector-classes")
    # Groups in one piece have their classes already; their roots are not in the forest.
    classes = classes.withColumnRenamed("node", "id").unionByName(
        trees.where("whole").select("id", F.col("other").alias("component")))
    sets = (distinct.select("id", "copies", "least").join(linked, "id", "left").join(classes, "id", "left")
                    .withColumn("component", F.coalesce("component", "id")))
    least = sets.groupBy("component").agg(F.min("least").alias("first"))
    sets = sets.join(least, "component").select("id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "first")
    known = rows.select("vec_id", "id").join(sets, "id").select(
        "vec_id", "links", F.when(F.col("first") > -(2 ** 63), F.col("first")).alias("first"))
    # Rows that can link, and all others.
    rest = _others(embeddings)
    out = known.unionByName(rest)
    return out.select("vec_id", F.col("links").cast("long").alias("n_links"),
                      F.coalesce("first", "vec_id").alias("component_id"),
                      F.coalesce(F.col("vec_id") == F.coalesce("first", "vec_id"), F.lit(True)).alias("kept"))


def _others(embeddings: DataFrame) -> DataFrame:
    """The rows that ``packed`` leaves out, by the same test."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) | ~F.exists(v, lambda c: c != 0)
    out = embeddings.where(F.col("label").isNull() | v.isNull() | F.coalesce(bad, F.lit(True)))
    return out.select(F.col("vec_id").cast("long"), F.lit(0).cast("long").alias("links"),
                      F.lit(None).cast("long").alias("first"))
