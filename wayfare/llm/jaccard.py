"""Near-duplicate documents by a chosen-path join of their word n-grams.

Documents with equal sets of ``width``-word shingles are one class, found by a
128-bit fingerprint. Each distinct set is embedded into a fixed number of
min-hash tokens (each by a hash function of its own). A run splits all sets on
a sampled token (now and then on two), so that sets that share it stay together; buckets
of at most ``small`` sets are compared by brute force, larger ones are split
again on tokens that the bucket's own key samples. Runs are repeated for the target
``recall``: a pair at the threshold stays together through d levels of a run with a
chance of at least threshold**d, so R runs miss it with (1 - threshold**d)**R at most,
and R is the least number with which that is below 1 - recall at ``levels`` levels
(12 runs for 0.9998 at three levels; the same runs have a bound of 4e-9 at one level,
5e-6 at two, 2e-3 at four, 9e-3 at five and 3e-2 at six). Buckets that stay large
after ``depth`` levels hold sets that agree almost everywhere; they are linked whole as
candidates.

Candidates (by their min-hash tokens) only say which sets are examined
together. All pairs within a connected group of candidates are then compared by
their exact Jaccard similarity, in blocks of at most ``block`` sets a side, and
only counts of links and a spanning forest leave a block: no pairs of a group
are emitted, and none is dropped.

Defined results: words are split at ASCII white space; a text of one to
``width`` - 1 words has one shingle, all of them; null texts and texts without
words have none and link with nothing; a null doc_id comes first; rows that
repeat id and text count as documents each, but only one row of them stays;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .kernels import (masked, materialise, mix64, null_first, partitions, pick, ragged_positions, ship, string_hashes,
                      text_slices, unmasked, word_lists, worker_cache)

ship(__name__)

TOKENS = 128
ODD = np.uint64(0x9E3779B97F4A7C15)


# -------------------------------------------------------------------- sets

def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes) of each text's set of shingles."""
    starts, codes, words = word_lists(texts)
    seq = string_hashes(words)[codes] if len(codes) else np.zeros(0, np.uint64)
    sizes = np.diff(starts)
    wide = np.minimum(sizes, width)
    count = np.where(sizes > 0, np.maximum(sizes - width + 1, 1), 0)
    at = ragged_positions(starts[:-1], count)
    span = np.repeat(wide, count)
    h = span.astype(np.uint64)
    for k in range(width):
        more = span > k
        h[more] = mix64(h[more] * ODD + seq[at[more] + k])
    ends = np.cumsum(count)
    sets = [np.unique(h[e - c:e]) for e, c in zip(ends.tolist(), count.tolist())]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return offsets, np.concatenate([np.zeros(0, np.uint64), *sets])


def fingerprints(offsets: np.ndarray, tokens: np.ndarray) -> list[bytes]:
    """16 bytes per set, whatever its order."""
    sums = []
    for seed in (0x2545F4914F6CDD1D, 0xD1342543DE82EF95):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(tokens + np.uint64(seed)))])
        sums.append(mix64(total[offsets[1:]] - total[offsets[:-1]] + np.diff(offsets).astype(np.uint64)))
    return [r.tobytes() for r in np.stack(sums, 1).astype(">u8")]


def embed(offsets: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """TOKENS min-hash tokens of each set: its least hash under a hash function
    of each place's own. So places agree independently of each other, however
    small the sets."""
    out = np.zeros((len(offsets) - 1, TOKENS), "<u4")
    seeds = mix64(np.arange(1, 2 * TOKENS + 1, dtype=np.uint64))
    x, some = mix64(tokens ^ ODD), np.flatnonzero(np.diff(offsets))
    # Some 30,000 tokens at a time stay in the processor's cache.
    cuts = np.flatnonzero(np.diff(offsets[some] // 30_000, prepend=-1)).tolist()
    for a, b in zip(cuts, [*cuts[1:], len(some)]):
        rows = some[a:b]
        begin = offsets[rows[0]]
        own = x[begin:offsets[rows[-1] + 1]]
        for k in range(TOKENS):
            h = (own ^ seeds[k]) * (seeds[TOKENS + k] | np.uint64(1))
            out[rows, k] = np.minimum.reduceat(h, offsets[rows] - begin) >> np.uint64(32)
    return out


SETS = "doc_id long, text_hash long, fp binary, n long, tokens binary, bytes_ binary"


def embedded(docs: DataFrame, width: int) -> DataFrame:
    """One row per document: its set's fingerprint, size and tokens (whole, and their low bytes)."""
    def run(batches):
        worker_cache("jaccard")
        for batch in batches:
            for a, b in text_slices(batch.column(2), 4_000_000):
                offsets, tokens = shingle_sets(batch.column(2)[a:b], width)
                sketch = embed(offsets, tokens)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(fingerprints(offsets, tokens), pa.binary()),
                     pa.array(np.diff(offsets)), pa.array([r.tobytes() for r in sketch], pa.binary()),
                     pa.array([r.tobytes() for r in sketch.astype(np.uint8)], pa.binary())],
                    names=["doc_id", "text_hash", "fp", "n", "tokens", "bytes_"])
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text), text).mapInArrow(run, SETS)


# ------------------------------------------------------------- chosen paths

def branches(seed: np.ndarray):
    """The sampled token places of nodes: one each, and a second for a quarter of them."""
    first = mix64(seed + np.uint64(1))
    yield np.arange(len(seed)), (first % np.uint64(TOKENS)).astype(np.int64)
    more = np.flatnonzero(first >> np.uint64(62) == 0)
    yield more, (mix64(seed[more] + np.uint64(2)) % np.uint64(TOKENS)).astype(np.int64)


def child_keys(seed: np.ndarray, tokens: np.ndarray):
    """(rows, keys of the buckets that they go to) below nodes with these seeds."""
    for rows, place in branches(seed):
        value = tokens[rows, place].astype(np.uint64)
        yield rows, mix64(mix64(seed[rows] + place.astype(np.uint64) * ODD) + value)


def split_nodes(nodes: DataFrame, runs: range | None = None) -> DataFrame:
    """Children (key, fp) of rows (key, fp, tokens); with ``runs``: of the roots of these runs."""
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            tokens = np.frombuffer(b"".join(batch.column("tokens").to_pylist()), "<u4").reshape(n, TOKENS)
            if runs is None:
                seeds = [np.asarray(batch.column("key")).astype(np.int64).view(np.uint64)]
            else:
                seeds = [np.full(n, mix64(np.array([r + 1], np.uint64))[0]) for r in runs]
            for seed in seeds:
                for rows, keys in child_keys(seed, tokens):
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)),
                                                      batch.column("fp").take(pa.array(rows))], names=["key", "fp"])
    return nodes.mapInArrow(run, "key long, fp binary")


def pair_positions(sizes: np.ndarray, limit: int = 400_000):
    """Index pairs i < j within consecutive groups of these sizes, some at a time."""
    ends = np.cumsum(sizes)
    begin = np.arange(int(ends[-1]) if len(ends) else 0)
    later = np.repeat(ends, sizes) - begin - 1
    total = np.cumsum(later)
    a = 0
    while a < len(begin):
        before = total[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield np.repeat(begin[a:b], later[a:b]), ragged_positions(begin[a:b] + 1, later[a:b])
        a = b


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node that each node is connected to."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def likely_links(leaves: DataFrame, threshold: float, buckets: int) -> DataFrame:
    """A spanning forest (a, b) of the likely pairs in each bucket of rows (key, fp, n, bytes_)."""
    # Six standard deviations below the threshold, of TOKENS independent places.
    least = threshold - 6 * (threshold * (1 - threshold) / TOKENS) ** 0.5

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(table["key"]), kind="stable")
        keys = np.asarray(table["key"])[order]
        cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(cuts, len(keys)))
        n = np.asarray(table["n"])[order]
        sketch = np.frombuffer(b"".join(table["bytes_"].to_pylist()), np.uint8).reshape(-1, TOKENS)[order]
        found = []
        for i, j in pair_positions(sizes):
            near = np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j])
            i, j = i[near], j[near]
            same = np.concatenate([(sketch[i[k:k + 50_000]] == sketch[j[k:k + 50_000]]).mean(1)
                                   for k in range(0, len(i), 50_000)] or [np.zeros(0)])
            found.append(np.stack([i[same >= least], j[same >= least]]))
        a, b = np.concatenate([np.zeros((2, 0), np.int64), *found], 1)
        label = forest(len(keys), a, b)
        moved = np.flatnonzero(label != np.arange(len(keys)))
        fp = table["fp"].take(pa.array(order))
        return pa.table({"a": fp.take(pa.array(moved)), "b": fp.take(pa.array(label[moved]))})
    dealt = leaves.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInArrow(run, "a binary, b binary")


def runs_needed(threshold: float, recall: float, levels: int) -> int:
    """The least R with (1 - threshold**levels)**R <= 1 - recall."""
    miss = 1.0 - threshold ** levels
    return 1 if miss <= 0 else max(1, math.ceil(math.log(1.0 - recall) / math.log(miss) - 1e-9))


def candidates(sets: DataFrame, threshold: float, runs: int, small: int, depth: int, buckets: int) -> DataFrame:
    """Links (a, b) that connect all sets which are likely similar."""
    nodes = materialise(split_nodes(sets.select("fp", "tokens"), range(runs)), "paths")
    found = []
    for level in range(depth):
        counts = nodes.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        nodes = materialise(nodes.join(counts, "key"), "buckets")
        leaves = nodes.where(F.col("size") <= small).join(sets.select("fp", "n", "bytes_"), "fp")
        found.append(materialise(likely_links(leaves, threshold, buckets), "likely"))
        large = nodes.where(F.col("size") > small)
        if large.limit(1).count() == 0:
            break
        if level + 1 < depth:
            nodes = materialise(split_nodes(large.select("key", "fp").join(sets.select("fp", "tokens"), "fp")), "paths")
        else:
            least = large.groupBy("key").agg(F.min("fp").alias("b"))
            found.append(large.join(least, "key").select(F.col("fp").alias("a"), "b"))
    return reduce(DataFrame.unionByName, found)


# ---------------------------------------------------------------- exact links

def exact_block(sets: list[np.ndarray], side: np.ndarray, copies: np.ndarray, threshold: float):
    """(linked copies per set, first and second ends of a spanning forest's links).
    With two sides only pairs across them count."""
    n = np.array([len(s) for s in sets])
    tokens = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), n)
    _, code, count = np.unique(tokens, return_inverse=True, return_counts=True)
    # Tokens of one set only are in no intersection.
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[code]
    row, code = row[keep], number[code[keep]]
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if (side == 1).any() else left
    common = np.zeros((len(left), len(right)), np.float32)
    width = max(256, min(8192, 8_000_000 // max(len(sets), 1)))
    by = np.argsort(code, kind="stable")
    row, code = row[by], code[by]
    for k in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(code, [k, k + width])
        x = np.zeros((len(sets), width), np.float32)
        x[row[a:b], code[a:b] - k] = 1
        common += x[left] @ x[right].T
    union = n[left][:, None] + n[right][None] - common.astype(np.float64)
    linked = common / union >= threshold
    if right is left:
        np.fill_diagonal(linked, False)
    links = np.zeros(len(sets), np.int64)
    links[left] = linked @ copies[right]
    if right is not left:
        links[right] = linked.T @ copies[left]
    i, j = np.nonzero(linked)
    label = forest(len(sets), left[i], right[j])
    moved = np.flatnonzero(label != np.arange(len(sets)))
    return links, moved, label[moved]


def exact_links(members: DataFrame, width: int, threshold: float, block: int, buckets: int) -> DataFrame:
    """Rows (fp, links, other): counts of linked documents (other null), and a
    spanning forest of the links. ``members``: component, size (of it), fp, copies, text."""
    def cut(batches):
        for batch in batches:
            for a, b in text_slices(batch.column("text"), 4_000_000):
                offsets, tokens = shingle_sets(batch.column("text")[a:b], width)
                raw = tokens.astype("<u8")
                own = [raw[x:y].tobytes() for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                cols = [batch.column(c)[a:b] for c in ("component", "size", "fp", "copies")]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(own, pa.binary())],
                                                 names=["component", "size", "fp", "copies", "tokens"])

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        groups: dict[tuple, dict] = {}
        for r in rows:
            groups.setdefault((r["component"], r["i"], r["j"]), {})[r["fp"]] = r
        fps, links, others = [], [], []
        for (_, i, j), found in groups.items():
            own = [found[k] for k in sorted(found)]
            sets = [np.frombuffer(r["tokens"], "<u8") for r in own]
            side = np.array([0 if i == j or r["part"] == i else 1 for r in own])
            if len(own) < 2 or i != j and side.all():
                continue
            count, a, b = exact_block(sets, side, np.array([r["copies"] for r in own]), threshold)
            some = np.flatnonzero(count)
            fps += [own[k]["fp"] for k in some] + [own[k]["fp"] for k in a]
            links += [*count[some].tolist(), *[None] * len(a)]
            others += [*[None] * len(some), *[own[k]["fp"] for k in b]]
        return pa.table({"fp": pa.array(fps, pa.binary()), "links": pa.array(links, pa.int64()),
                         "other": pa.array(others, pa.binary())})

    sets = members.select("component", "size", "fp", "copies", F.col("text").cast("string").alias("text")).mapInArrow(
        cut, "component binary, size long, fp binary, copies long, tokens binary")
    parts = F.ceil(F.col("size") / block).cast("int")
    part = F.pmod(F.xxhash64("fp"), parts).cast("int")
    sets = sets.withColumn("parts", parts).withColumn("part", part)
    # A set meets each part of its component once: blocks (i, j) with i <= j.
    sets = sets.withColumn("other_part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    sets = sets.select("component", "fp", "copies", "tokens", "part", F.least("part", "other_part").alias("i"),
                       F.greatest("part", "other_part").alias("j"))
    sets = sets.withColumn("bucket", F.pmod(F.xxhash64("component", "i", "j"), F.lit(buckets)))
    return sets.groupBy("bucket").applyInArrow(run, "fp binary, links long, other binary")


def near_duplicates(docs: DataFrame, width: int = 5, threshold: float = 0.8, recall: float = 0.9998, levels: int = 3,
                    small: int = 1000, depth: int = 6, block: int = 2000) -> DataFrame:
    """One row per document: doc_id, text_hash, class_id (least id of all documents
    that links connect it to), n_links (other documents with a similarity of
    ``threshold`` or more) and kept (it is the one of its class that stays)."""
    docs, buckets = pick(docs, "doc_id", "text"), partitions(docs.sparkSession)
    rows = materialise(embedded(docs, width), "sets")
    key = F.struct(null_first(F.col("doc_id")).alias("id"), "text_hash")
    sets = materialise(rows.where("n > 0").groupBy("fp").agg(
        F.count(F.lit(1)).alias("copies"), F.min(key).alias("least"), F.first("n").alias("n"),
        F.first("tokens").alias("tokens"), F.first("bytes_").alias("bytes_")), "distinct")
    likely = components(candidates(sets, threshold, runs_needed(threshold, recall, levels), small, depth, buckets), name="candidates")
    sizes = likely.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    chosen = (likely.join(sizes, "component").join(sets.select(F.col("fp").alias("node"), "copies", "least"), "node")
                    .select(F.col("node").alias("fp"), "component", "size", "copies",
                            F.col("least.id").alias("_id"), F.col("least.text_hash").alias("_hash")))
    texts = docs.select(null_first(F.col("doc_id").cast("long")).alias("_id"), F.col("text").cast("string").alias("text"))
    members = texts.withColumn("_hash", F.xxhash64("text")).join(chosen, ["_id", "_hash"])
    found = materialise(exact_links(members, width, threshold, block, buckets), "links")
    linked = found.where("other IS NULL").groupBy("fp").agg(F.sum("links").alias("links"))
    classes = components(found.where("other IS NOT NULL").select(F.col("fp").alias("a"), F.col("other").alias("b")),
                         name="classes")
    of_set = (sets.select("fp", "copies", "least").join(linked, "fp", "left")
                  .join(classes.select(F.col("node").alias("fp"), "component"), "fp", "left")
                  .withColumn("component", F.coalesce("component", "fp")))
    first = of_set.groupBy("component").agg(F.min("least").alias("first"))
    of_set = materialise(of_set.join(first, "component").select(
        "fp", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "first"), "classes-of-sets")
    out = rows.select("doc_id", "text_hash", "fp", "n").join(of_set, "fp", "left")
    own = out["n"] == 0
    least = F.when(F.col("first.id") > -(2 ** 63), F.col("first.id"))
    return out.select("doc_id", "text_hash", F.when(own, F.col("doc_id")).otherwise(least).alias("class_id"),
                      F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce(own | (key == F.col("first")), F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame, **parameters) -> DataFrame:
    """The documents, one of each class, with all their columns."""
    own, safe = masked(docs, "doc_id", "text")
    kept = near_duplicates(own, **parameters).where("kept").select(
        null_first(F.col("doc_id")).alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    rows = own.withColumn("_id", null_first(F.col("doc_id").cast("long"))) \
               .withColumn("_hash", F.xxhash64(F.col("text").cast("string")))
    return unmasked(rows.join(kept, ["_id", "_hash"]).dropDuplicates(["_id", "_hash"]), safe, docs.columns)
