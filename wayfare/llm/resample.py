"""Target-distribution importance resampling with prefix-CRC n-gram features.

Features of a text are all runs of 1 to ``width`` consecutive words
(``canonical``), joined by one space; a feature's bucket is the CRC-32 of its
bytes modulo ``buckets``.

* Each separator-normalised slice of texts is scanned once, and the running CRC
  at every place is stored. Lanes of 512 bytes are scanned side by side; the
  lanes' carries come from a doubling scan.
* The CRC is linear over GF(2): a run's CRC is that of the prefix at its end,
  less that of the prefix at its start shifted by the run's length in zero bytes
  (one table look-up per set bit of the length). Both prefixes of most runs lie
  in one lane, where the carry cancels.
* The bucket lists (2 bytes a feature) are written once; bucket counts of both
  tables are sums of one array per task, and a bucket's gain is the log ratio of
  its smoothed shares in the target and the raw table. At most ``buckets``
  numbers reach the driver, whatever the corpus.
* A document's score is its mean gain plus Gumbel noise from a hash of its id,
  so the highest scores are a sample without replacement by importance weight.
  Scores are whole numbers in a bounded range: counts per score give the lowest
  drawn score, and only rows from there on are range-sorted and numbered.

Defined results: a null text has no words; a document without features has
weight 0; a null doc_id is hashed as the empty string and ties before all
others; rows that repeat an id are documents of their own; of equal rows any may
be the first; empty tables count 0 and give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .canonical import canonical_words
from .kernels import materialise, null_first, partitions, pick, ragged_positions, ship, text_slices

ship(__name__)

LANE_BITS = 9
LANE = 1 << LANE_BITS
ONES = np.uint32(0xFFFFFFFF)


# --------------------------------------------------------------------- CRC

def byte_table() -> np.ndarray:
    """CRC-32 of single bytes (reflected polynomial 0xEDB88320)."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, t >> 1 ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


TABLE = byte_table()


def applied(op: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A linear map of 32-bit words, as four tables of 256."""
    return op[0][x & 255] ^ op[1][x >> 8 & 255] ^ op[2][x >> 16 & 255] ^ op[3][x >> 24]


def shift_maps(n: int) -> list[np.ndarray]:
    """The maps that append 1, 2, 4, ... zero bytes."""
    byte = np.arange(256, dtype=np.uint32)
    op = np.stack([TABLE if k == 0 else byte << np.uint32(8 * k - 8) for k in range(4)])
    maps = [op]
    for _ in range(n - 1):
        op = np.stack([applied(op, row) for row in op])
        maps.append(op)
    return maps


SHIFTS = shift_maps(40)


def shifted(x: np.ndarray, count: np.ndarray) -> np.ndarray:
    """CRC states after ``count`` zero bytes each."""
    x, bit = x.copy(), 0
    most = int(count.max(initial=0))
    while most >> bit:
        some = np.flatnonzero(count >> bit & 1)
        x[some] = applied(SHIFTS[bit], x[some])
        bit += 1
    return x


class RunningCrc:
    """Running CRC states (from zero, not inverted) of one byte string."""

    def __init__(self, text: np.ndarray):
        lanes = -(-len(text) // LANE) + 1
        data = np.zeros(lanes * LANE, np.uint8)
        data[:len(text)] = text
        steps = np.ascontiguousarray(data.reshape(lanes, LANE).T)
        self.local = np.zeros((LANE + 1, lanes), np.uint32)
        for k in range(LANE):
            state = self.local[k]
            self.local[k + 1] = TABLE[(state & 255).astype(np.uint8) ^ steps[k]] ^ state >> 8
        carry, reach, bit = self.local[LANE].copy(), 1, LANE_BITS
        while reach < lanes:
            carry[reach:] ^= applied(SHIFTS[bit], carry[:-reach])
            reach, bit = 2 * reach, bit + 1
        #: State at the start of each lane.
        self.carry = np.concatenate([np.zeros(1, np.uint32), carry[:-1]])

    def prefix(self, at: np.ndarray) -> np.ndarray:
        lane, place = at >> LANE_BITS, at & LANE - 1
        return shifted(self.carry[lane], place) ^ self.local[place, lane]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """CRC-32 of each ``text[start:end]`` from its two prefixes."""
        one = start >> LANE_BITS == end >> LANE_BITS
        first, last = np.empty(len(start), np.uint32), np.empty(len(start), np.uint32)
        for out, at in ((first, start), (last, end)):
            out[one] = self.local[at[one] & LANE - 1, at[one] >> LANE_BITS]
            out[~one] = self.prefix(at[~one])
        return last ^ shifted(first ^ ONES, end - start) ^ ONES


def feature_buckets(texts: pa.Array, width: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, features per text, buckets of all features in text order)."""
    text, spaces, offsets = canonical_words(texts)
    crc, words = RunningCrc(text), np.diff(offsets)
    found, owner = [], []
    for w in range(1, width + 1):
        runs = np.maximum(words - w + 1, 0)
        first = ragged_positions(offsets[:-1], runs)
        found.append(crc.of(spaces[first] + 1, spaces[first + w]) % np.uint32(buckets))
        owner.append(np.repeat(np.arange(len(words)), runs))
    owner, found = np.concatenate(owner), np.concatenate(found)
    return words, np.bincount(owner, minlength=len(words)), found[np.argsort(owner, kind="stable")] if width > 1 else found


# ------------------------------------------------------------------- tables

FEATURES = "doc_id long, n_words long, n_features long, buckets binary"


def cell(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def feature_lists(docs: DataFrame, width: int, buckets: int) -> DataFrame:
    """Per document its counts and the packed buckets of its features."""
    def run(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(1), 4_000_000):
                words, count, found = feature_buckets(batch.column(1)[a:b], width, buckets)
                raw, size = found.astype(cell(buckets)), np.dtype(cell(buckets)).itemsize
                ends = (np.concatenate([[0], np.cumsum(count)]) * size).tolist()
                flat = raw.tobytes()
                packed = pa.array([flat[x:y] for x, y in zip(ends, ends[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(words), pa.array(count), packed],
                                                 ["doc_id", "n_words", "n_features", "buckets"])
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, FEATURES)


def bucket_counts(lists: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket: one row per task and bucket is summed."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(x, cell(buckets)), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])
    rows = lists.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect()
    out = np.zeros(buckets, np.int64)
    for k, n in rows:
        out[k] = n
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray, smoothing: int, scale: float = 1000.0) -> np.ndarray:
    """floor(scale * ln(share in the target / share in the raw table)), shares smoothed by one a bucket."""
    up = (target + 1.0) * (raw.sum() + float(smoothing))
    down = (raw + 1.0) * (target.sum() + float(smoothing))
    return np.floor(scale * np.log(up / down)).astype(np.int64)


def importance_weights(docs: DataFrame, target: DataFrame, width: int = 1, buckets: int = 10_000) -> DataFrame:
    """doc_id, n_words, n_features and the floored mean gain (``weight``) of every document."""
    lists = materialise(feature_lists(docs, width, buckets), "features", compression="zstd")
    aim = target.withColumn("doc_id", F.lit(None).cast("long")) if "doc_id" not in target.columns else target
    gains = bucket_gains(bucket_counts(lists, buckets), bucket_counts(feature_lists(aim, width, buckets), buckets), buckets)

    def weigh(batches):
        for batch in batches:
            count = np.asarray(batch.column(2)).astype(np.int64)
            total = np.zeros(len(count), np.int64)
            for k, x in enumerate(batch.column(3).to_pylist()):
                total[k] = gains[np.frombuffer(x, cell(buckets))].sum()
            weight = np.where(count > 0, total // np.maximum(count, 1), 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weight)],
                                             ["doc_id", "n_words", "n_features", "weight"])
    return lists.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def gumbel(key) -> "F.Column":
    """floor(-1000 ln(-ln u)), u from the first 32 bits of the key's SHA-256."""
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def draw(scored: DataFrame, percent: int = 10, min_words: int = 20) -> DataFrame:
    """Numbers the floor(percent * N / 100) highest scores among the N documents
    of at least ``min_words`` words from 1 on (ties: smaller doc_id first)."""
    spark = scored.sparkSession
    n_parts = partitions(spark)
    scored = materialise(scored, "scored")
    fit = F.col("n_words") >= min_words
    # As many rows as distinct scores: whole thousandths between fixed bounds.
    levels = scored.where(fit).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    from_top = levels.withColumn("above", F.sum("n").over(Window.orderBy(F.desc("score"))))
    totals = levels.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    quota = totals["n"] * percent // 100
    lowest = from_top.where(F.col("above") >= quota).agg(F.max("score")).first()[0] if quota else None
    if lowest is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    drawn = fit & (F.col("score") >= lowest)
    order = [F.desc("score"), null_first(F.col("doc_id")), F.col("_salt")]
    # The salt lets rows that are equal in score and id lie in several partitions.
    ranged = scored.where(drawn).withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(n_parts, *order)
    placed = materialise(ranged.withColumn("_part", F.spark_partition_id()), "drawn")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_before")
    ranked = placed.join(F.broadcast(before), "_part").withColumn("rank", place.cast("long"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= quota, F.col("rank"))).drop("_salt", "_part", "_before")
    return ranked.select(*scored.columns, "rank").unionByName(
        scored.where(~drawn).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, width: int = 1,
             buckets: int = 10_000, seed: int = 2024) -> DataFrame:
    """Every document with n_words, n_features, weight, score and the rank at which it is drawn (or null)."""
    weighed = importance_weights(docs, target, width, buckets)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return draw(weighed.withColumn("score", (F.col("weight") + gumbel(key)).cast("long")), percent, min_words)
