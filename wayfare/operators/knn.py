"""Exact top-k cosine neighbours between two sets of sparse vectors.

A vector is one row ``(id, keys, vals)``; ``pack_long`` makes them from long
rows ``(id, key, value)``.

Plan (no pair rows are materialised):

1. A *probe* lays queries and candidates side by side in the order of their
   *postings* (the key with the greatest entry, and its share of the norm) and
   scores each stretch of that order against itself: n x stretch products give
   every query with alike vectors a lower bound of its k-th score, its *floor*.
2. Queries are hashed into blocks of about ``query_block``, candidates into as
   many columns as keep all tasks busy, a piece of a posting list to one column. A candidate is sent to each query block once, a query to each
   column. ``repartitionById`` gives every group a task of its own, sorted so that
   its queries come first.
3. A task holds its query block and streams the candidates in the order of their
   postings. So what a worker holds does not grow with either table.
4. Short runs of a posting list are bounded per query before they are multiplied: by
   the greatest entries of the run per key, and by the angle between the query's and
   the run's entries of the leading key (Cauchy-Schwarz for the rest). Only runs whose
   bound reaches a query's floor are multiplied.
5. Products are taken in single precision first. Only pairs that reach the floor less
   that product's greatest rounding error are scored, in double precision.
6. The local lists (at most k rows per query and group) are merged with
   ``row_number() <= k``, which Spark plans with a partial window group limit
   before the shuffle.

Scores are rounded half-up to ``digits`` decimals before ranking, so equal
cosines computed in a different summation order rank equal; ties are broken
by the candidate id (ascending). A zero vector has cosine 0 with everything.

Where no bound helps (no alike vectors) the work is |Q| x |C| dot products, as
exact all-pairs similarity is; serving a batch of requests keeps |Q| = batch size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The kernel runs in Python workers; ship this module's code by value so the
# executors do not need the package installed (only numpy and pandas).
try:
    import sys as _sys

    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass


def _topk_rows(S: np.ndarray, k: int):
    """Per row, the k best columns by (score desc, column asc); -inf = invalid.

    Vectorised: a partition finds each row's k-th score, all columns at or
    above it (ties included) are sorted by (row, -score, column) and the
    first k per row are kept.
    """
    n, m = S.shape
    kk = min(k, m)
    if kk < m:
        kth = np.partition(S, m - kk, axis=1)[:, m - kk]
        mask = (S >= kth[:, None]) & np.isfinite(S)
    else:
        mask = np.isfinite(S)
    r, c = np.nonzero(mask)
    if r.size == 0:
        return r, c
    sc = S[r, c]
    order = np.lexsort((c, -sc, r))
    r, c = r[order], c[order]
    start = np.searchsorted(r, r, side="left")
    keep = (np.arange(r.size) - start) < k
    return r[keep], c[keep]


class _Sparse:
    """Packed vectors as flat arrays; over a list of sorted keys they become dense rows."""

    def __init__(self, frame: pd.DataFrame):
        self.lens = frame["keys"].map(len).to_numpy(dtype="int64")
        self.first = np.cumsum(self.lens) - self.lens
        some = self.lens.sum() > 0
        self.keys = np.concatenate(frame["keys"].to_numpy()).astype("int64") if some else np.zeros(0, "int64")
        self.vals = np.concatenate(frame["vals"].to_numpy()).astype("float64") if some else np.zeros(0)
        row = np.repeat(np.arange(len(frame)), self.lens)
        self.norm = np.sqrt(np.bincount(row, self.vals * self.vals, len(frame)))
        self.unit = (self.vals / np.repeat(np.where(self.norm == 0, 1.0, self.norm), self.lens)).astype("float32")

    def __len__(self) -> int:
        return len(self.lens)

    def lay(self, known: np.ndarray) -> None:
        """Dense rows will be over ``known``; other keys are left out."""
        at = np.minimum(np.searchsorted(known, self.keys), max(len(known) - 1, 0))
        # One column more takes what is left out.
        self.width, self.at = len(known), np.where(known[at] == self.keys, at, len(known)) if len(known) else np.zeros(len(self.keys), "int64")

    def dense(self, lo: int, hi: int) -> np.ndarray:
        """Unit vectors in single precision."""
        a, b = (self.first[lo], self.first[hi - 1] + self.lens[hi - 1]) if hi > lo else (0, 0)
        out = np.zeros((hi - lo, self.width + 1), "float32")
        place = np.repeat(np.arange(hi - lo) * (self.width + 1), self.lens[lo:hi])
        place += self.at[a:b]
        out.ravel()[place] = self.unit[a:b]
        return out[:, :self.width]

    def exact(self, rows: np.ndarray) -> np.ndarray:
        lens = self.lens[rows]
        ends = np.cumsum(lens)
        entry = np.arange(lens.sum()) + np.repeat(self.first[rows] - (ends - lens), lens)
        out = np.zeros((len(rows), self.width + 1))
        out.ravel()[np.repeat(np.arange(len(rows)) * (self.width + 1), lens) + self.at[entry]] = self.vals[entry]
        return out[:, :self.width]


def _runs(vectors: _Sparse, longest: int) -> np.ndarray:
    """Starts of runs with one leading key, of at most ``longest`` rows."""
    lead, some = np.zeros(len(vectors), "int64"), np.flatnonzero(vectors.lens)
    if len(some):
        size = np.abs(vectors.vals)
        top = size == np.repeat(np.maximum.reduceat(size, vectors.first[some]), vectors.lens[some])
        entry = np.flatnonzero(top)
        row = np.repeat(some, vectors.lens[some])[entry]
        # The first of equal entries.
        row, one = np.unique(row, return_index=True)
        lead[row] = vectors.keys[entry[one]]
    place = np.arange(len(lead))
    first = np.concatenate([[True], lead[1:] != lead[:-1]])
    return np.flatnonzero(first | ((place - np.maximum.accumulate(np.where(first, place, 0))) % longest == 0))


def _bounds(left: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Upper bounds (queries x runs) of the cosines of unit queries with unit
    candidates whose entries lie between ``low`` and ``high`` of their run."""
    by_key = np.maximum(left, 0) @ high.T
    if (low < 0).any() or (left < 0).any():
        by_key += np.minimum(left, 0) @ low.T
    lead, lane = np.argmax(high, axis=1), np.arange(len(high))
    q = left[:, lead]
    near = np.clip(q, low[lane, lead], high[lane, lead])
    by_angle = q * near + np.sqrt(np.maximum(1 - q * q, 0) * np.maximum(1 - near * near, 0))
    return np.minimum(by_key, by_angle)


class _Search:
    """A block of queries and their best candidates so far."""

    #: Bytes of candidates laid out at once, and the most of them in one product.
    PIECE_BYTES, SPAN = 48 << 20, 4096

    def __init__(self, queries: pd.DataFrame, k: int, exclude_self: bool, min_score, digits: int, chunk: int, run: int = 128):
        self.k, self.min_score, self.scale, self.chunk, self.run = k, min_score, float(10 ** digits), chunk, run
        self.exclude_self, self.products = exclude_self, 0
        self.qids = queries["qid"].to_numpy(dtype="int64")
        frames = [queries.iloc[lo:lo + chunk] for lo in range(0, len(queries), chunk)]
        self.parts = [_Sparse(f) for f in frames]
        self.known = [np.unique(p.keys) for p in self.parts]
        every = np.unique(np.concatenate(self.known)) if self.known else np.zeros(0, "int64")
        # One dense layout serves all parts, unless the keys are many.
        self.every = every if len(every) <= 2 * max(map(len, self.known), default=0) else None
        for part, known in zip(self.parts, self.known):
            part.lay(known if self.every is None else every)
        # Per part the best so far: (query, score, candidate id), and every query's floor.
        self.best = [(np.zeros(0, "int64"), np.zeros(0), None) for _ in self.parts]
        least = -np.inf if min_score is None else min_score
        self.floor = [np.full(len(p), least) for p in self.parts]
        if "floor" in queries:
            self.floor = [np.maximum(f, p["floor"].fillna(-np.inf).to_numpy("float64")) for f, p in zip(self.floor, frames)]
        self.wait = 0

    def add(self, c: pd.DataFrame) -> None:
        """Offers candidates (cid, keys, vals); each only once."""
        width = len(self.every) if self.every is not None else max(map(len, self.known), default=0)
        size = max(self.run, self.PIECE_BYTES // (4 * width + 4))
        for lo in range(0, len(c), size):
            self._add(c.iloc[lo:lo + size])

    def _add(self, frame: pd.DataFrame) -> None:
        c, cids = _Sparse(frame), frame["cid"].to_numpy()
        starts = _runs(c, self.run)
        ends = np.append(starts[1:], len(c))
        # Each query's own place among the candidates.
        by = np.argsort(cids, kind="stable") if self.exclude_self else None
        once = by is not None and len(np.unique(cids)) == len(cids)

        def layout(known):
            c.lay(known)
            unit = c.dense(0, len(c))
            return unit, np.maximum.reduceat(unit, starts, axis=0), np.minimum.reduceat(unit, starts, axis=0)
        if self.every is not None:
            unit, high, low = layout(self.every)
        # Runs are taken in spans.
        edges = np.unique(np.searchsorted(ends, np.arange(0, len(c), self.SPAN), side="right"))
        wait, shares = self.wait, []
        for p, part in enumerate(self.parts):
            if self.every is None:
                unit, high, low = layout(self.known[p])
            own = part.dense(0, len(part))
            # The greatest error of a single-precision product, and half a unit of the last decimal.
            slack = 2e-7 * (part.lens.max(initial=0) + 8) + 2.0 / self.scale
            bound = None if wait else _bounds(own, high, low)
            self_at = None
            if once:
                at = np.minimum(np.searchsorted(cids, self.qids[p * self.chunk:p * self.chunk + len(part)], sorter=by), len(c) - 1)
                self_at = np.where(cids[by[at]] == self.qids[p * self.chunk:p * self.chunk + len(part)], by[at], -1)
            for a, b in zip(edges, [*edges[1:], len(starts)]):
                lo, hi = starts[a], ends[b - 1]
                if bound is None:
                    tiles = [(np.arange(len(part)), lo, hi)]
                else:
                    met = bound[:, a:b] >= (self.floor[p] - slack).astype("float32")[:, None]
                    share = (met @ (ends - starts)[a:b]).mean() / (hi - lo)
                    shares.append(share)
                    if share > 0.5:  # one large product is cheaper than many small ones
                        tiles = [(np.flatnonzero(met.any(1)), lo, hi)]
                    else:
                        tiles = [(np.flatnonzero(met[:, j]), starts[a + j], ends[a + j]) for j in np.flatnonzero(met.any(0))]
                found = [self._tile(p, rows, x, y, own, unit, c, cids, self_at, slack) for rows, x, y in tiles]
                found = [f for f in found if f is not None]
                if found:
                    self._merge(p, *(np.concatenate(x) for x in zip(*found)))
        # Where bounds spare nothing they are left out for a while.
        self.wait = wait - 1 if wait else 3 if shares and np.mean(shares) > 0.98 else 0

    def _tile(self, p, rows, lo, hi, own, unit, c, cids, self_at, slack):
        """(query, score, candidate id) of the pairs that may enter a list."""
        part = self.parts[p]
        self.products += len(rows) * (hi - lo)
        rough = (own if len(rows) == len(own) else own[rows]) @ unit[lo:hi].T
        if self_at is not None:
            mine = np.flatnonzero((self_at[rows] >= lo) & (self_at[rows] < hi))
            rough[mine, self_at[rows[mine]] - lo] = -np.inf
        elif self.exclude_self:
            rough[self.qids[p * self.chunk + rows, None] == cids[None, lo:hi]] = -np.inf
        floor = self.floor[p][rows]
        least = (floor - slack).astype("float32")
        mask = rough >= least[:, None]
        many = np.flatnonzero(mask.sum(1) > 4 * self.k) if hi - lo > 4 * self.k else []
        if len(many):
            # Below the k-th best of the tile nothing can enter.
            kth = np.partition(rough[many], hi - lo - self.k, axis=1)[:, hi - lo - self.k]
            least[many] = np.maximum(least[many], kth - np.float32(2 * slack))
            mask[many] = rough[many] >= least[many, None]
        if self.exclude_self and np.isneginf(least).any():
            mask &= np.isfinite(rough)
        r, at = np.nonzero(mask)
        if not len(r):
            return None
        dots = self._dots(part, c, rows[r], lo + at)
        denom = part.norm[rows[r]] * c.norm[lo + at]
        sc = np.where(denom == 0, 0.0, dots / np.where(denom == 0, 1.0, denom))
        sc = np.floor(sc * self.scale + 0.5) / self.scale
        keep = sc >= floor[r]
        if self.min_score is not None:
            keep &= sc > self.min_score
        return rows[r[keep]], sc[keep], cids[lo + at[keep]]

    @staticmethod
    def _dots(part: _Sparse, c: _Sparse, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Products of pairs in double precision."""
        (q, qi), (x, xi) = np.unique(q, return_inverse=True), np.unique(x, return_inverse=True)
        left, right = part.exact(q), c.exact(x)
        if len(q) * len(x) < 40 * len(qi):
            return (left @ right.T)[qi, xi]
        return np.concatenate([np.einsum("ij,ij->i", left[qi[i:i + 2048]], right[xi[i:i + 2048]]) for i in range(0, len(qi), 2048)])

    def _merge(self, p, rows, score, ids) -> None:
        if self.best[p][2] is not None:
            rows, score, ids = (np.concatenate(x) for x in zip(self.best[p], (rows, score, ids)))
        # Order by (query, score desc, id): ids ranked by value, whatever their type.
        _, rank = np.unique(ids, return_inverse=True)
        order = np.lexsort((rank, -score, rows))
        rows, score, ids = rows[order], score[order], ids[order]
        first = np.searchsorted(rows, rows, side="left")
        place = np.arange(len(rows)) - first
        full = np.flatnonzero(place == self.k - 1)
        self.floor[p][rows[full]] = np.maximum(self.floor[p][rows[full]], score[full])
        keep = place < self.k
        self.best[p] = rows[keep], score[keep], ids[keep]

    def result(self, cid_is_str: bool) -> pd.DataFrame:
        at = [p * self.chunk + b[0] for p, b in enumerate(self.best)]
        cids = np.concatenate([np.zeros(0, object if cid_is_str else "int64"), *(b[2] for b in self.best if b[2] is not None)])
        return pd.DataFrame({"qid": self.qids[np.concatenate([np.zeros(0, "int64"), *at]).astype("int64")],
                             "cid": pd.Series(cids if cid_is_str else cids.astype("int64"), dtype=object if cid_is_str else "int64"),
                             "score": np.concatenate([np.zeros(0), *(b[1] for b in self.best)])})


def _kernel(k: int, exclude_self: bool, min_score, digits: int, cid_is_str: bool, chunk: int = 1024, stretch: int = 16384):
    """Search of one group: frames in which the queries (role 0) come before the
    candidates (role 1); yields one frame of the queries' local lists."""
    def run(frames):
        queries, held, search, n = [], [], None, 0
        for f in frames:
            q, c = f[f["role"] == 0], f[f["role"] == 1]
            if len(q):
                queries.append(q)
            if len(c):
                if not queries:
                    return
                if search is None:
                    search = _Search(pd.concat(queries, ignore_index=True), k, exclude_self and not cid_is_str, min_score,
                                     digits, chunk)
                held.append(c)
                n += len(c)
                if n >= stretch:
                    c, held, n = pd.concat(held, ignore_index=True), [], 0
                    for lo in range(0, len(c), stretch):
                        search.add(c.iloc[lo:lo + stretch])
        if search is None:
            return
        if held:
            c = pd.concat(held, ignore_index=True)
            for lo in range(0, len(c), stretch):
                search.add(c.iloc[lo:lo + stretch])
        run.products = search.products
        yield search.result(cid_is_str)
    return run


def _probe(k: int, exclude_self: bool, min_score, digits: int, cid_is_str: bool, stretch: int = 1024):
    """Floors (qid, floor) of queries that meet k candidates in their stretch of the posting order."""
    def run(frames):
        for f in frames:
            for lo in range(0, len(f), stretch):
                part = f.iloc[lo:lo + stretch]
                q, c = part[part["role"] == 0], part[part["role"] == 1]
                if not len(q) or len(c) < k:
                    continue
                search = _Search(q, k, exclude_self and not cid_is_str, min_score, digits, len(q))
                search.wait = 1
                search.add(c)
                rows, score, _ = search.best[0]
                last = np.flatnonzero(np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") == k - 1)
                yield pd.DataFrame({"qid": search.qids[rows[last]], "floor": score[last]})
    return run


def pack_long(df: DataFrame) -> DataFrame:
    """Long rows (id, key, value) -> one row (id, keys, vals) per vector. A
    vector has at most one entry per key of the catalog."""
    return df.groupBy("id").agg(F.collect_list(F.col("key").cast("long")).alias("keys"),
                                F.collect_list(F.col("value").cast("double")).alias("vals"))


def topk_cosine(queries: DataFrame, candidates: DataFrame, k: int, *,
                exclude_self: bool = False, min_score: float | None = None, grid: tuple[int, int] | None = None,
                digits: int = 9, chunk: int = 1024, query_block: int = 100_000, stretch: int = 16384) -> DataFrame:
    """Top-k candidates per query id by cosine similarity.

    Both inputs are vectors (id, keys array<long>, vals array<double>); query
    ids are long, candidate ids long or string. Returns
    ``(qid, cid, score, rank)`` with ``rank`` 1..k. ``grid``: (query blocks,
    candidate columns); by default the queries are counted.
    """
    ctype = dict(candidates.dtypes)["id"]
    cid_is_str = ctype == "string"
    slots = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if grid is None:
        rows = max(1, -(-queries.count() // query_block))
        # Every column costs a copy of the queries: no more groups than keep all tasks busy.
        groups = min(slots, 3 * queries.sparkSession.sparkContext.defaultParallelism)
        grid = rows, max(1, -(-groups // rows))
    rows, cols = grid

    # The leading entry of a vector: its posting list, and its share of the norm.
    pairs = F.arrays_zip(F.transform("vals", F.abs).alias("v"), F.col("keys").alias("k"))
    top = F.array_max(pairs)
    norm = F.sqrt(F.aggregate("vals", F.lit(0.0), lambda a, x: a + x * x))
    lead = F.coalesce(top["k"], F.lit(0)).alias("lead")
    share = F.when(norm > 0, top["v"] / norm).otherwise(F.lit(0.0)).alias("share")
    q = queries.select(F.lit(0).alias("role"), F.col("id").cast("long").alias("qid"),
                       F.lit("" if cid_is_str else 0).cast(ctype).alias("cid"),  # placeholder, never null
                       "keys", "vals", lead, share)
    c = candidates.select(F.lit(1).alias("role"), F.lit(-1).cast("long").alias("qid"),  # placeholder
                          F.col("id").cast(ctype).alias("cid"), "keys", "vals", lead, share)
    piece = F.xxhash64("lead", F.floor(F.col("share") * 64))
    # Equal vectors of both sides lie side by side.
    side = q.unionByName(c).repartition(max(slots, rows * cols), piece).sortWithinPartitions("lead", "share", F.xxhash64("keys", "vals"), "qid", "cid")
    floors = (side.select("role", "qid", "cid", "keys", "vals")
                  .mapInPandas(_probe(k, exclude_self, min_score, digits, cid_is_str), "qid long, floor double")
                  .groupBy("qid").agg(F.max("floor").alias("floor")))
    q = q.join(floors, "qid", "left")

    def spread(block, others: int, first: bool):
        """The groups of a row: its block with every one of the other side's."""
        return F.explode(F.transform(F.sequence(F.lit(0), F.lit(others - 1)),
                                     lambda x: block * cols + x if first else x * cols + block)).alias("group")
    q = q.select("*", spread(F.pmod(F.xxhash64("qid"), F.lit(rows)).cast("int"), cols, True))
    c = c.select("*", F.lit(None).cast("double").alias("floor"), spread(F.pmod(piece, F.lit(cols)).cast("int"), rows, False))
    kernel = _kernel(k, exclude_self, min_score, digits, cid_is_str, chunk, stretch)
    groups = q.unionByName(c).repartitionById(rows * cols, "group").sortWithinPartitions("role", "lead", F.desc("share"), "cid")
    local = groups.select("role", "qid", "cid", "keys", "vals", "floor").mapInPandas(kernel, f"qid long, cid {ctype}, score double")
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("cid").asc())
    return local.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
