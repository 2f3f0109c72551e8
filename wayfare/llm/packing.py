"""Best-fit packing of documents into sequences of a fixed number of tokens.

Bulk-synchronous best fit. Documents and gaps are kept in size order; sizes
are whole numbers up to the capacity, so the sorted order of all pieces is
their count per size, which Spark aggregates. A sweep matches one size with
its successor, the smallest gap that holds it: the k-th piece of the size
goes to the k-th sequence of the gap, so conflicts are resolved by rank; the
used gaps shrink and the next sweep begins. The sweeps work on counts (their
number is bounded by the capacity, whatever the number of documents) and
give rank intervals; Spark then ranks all pieces of each size, split into
hashed shards so that a size that holds a third of all rows is ranked by many
tasks, and looks the place of each up by its rank.

Documents longer than the capacity are cut from the end into pieces of the
full capacity; only the first piece may be shorter.

Defined results: a null text is empty (its end token alone is packed); rows
with equal ids are packed each for itself; equal pieces take places in id
order; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kernels import materialise, partitions, pick, ship
from .tokens import encode_slices

ship(__name__)

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0,
                 with_ids: bool = False) -> DataFrame:
    """One row per piece: its document, number, start, length and the crc32
    of its ids (and the ids themselves)."""
    def cut(batches):
        for batch in batches:
            names = batch.column(0)
            for a, b, counts, ids in encode_slices(batch.column(1), tokenizer, end_id, 3_000_000):
                raw = ids.astype("<u4")
                ends = np.cumsum(counts)
                pieces = -(-counts // capacity)
                row = np.repeat(np.arange(b - a), pieces)
                number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = counts - (pieces - 1) * capacity
                start = np.where(number == 0, 0, first[row] + (number - 1) * capacity)
                length = np.where(number == 0, first[row], capacity)
                at = (ends - counts)[row] + start
                crc = [zlib.crc32(raw[x:x + n]) for x, n in zip(at.tolist(), length.tolist())]
                out = [names[a:b].take(pa.array(row)), pa.array(number.astype(np.int32)), pa.array(start),
                       pa.array(length), pa.array(crc, pa.int64())]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)).astype(np.int32)),
                                                        pa.array(ids)))
                yield pa.RecordBatch.from_arrays(out, PIECE_NAMES + ["ids"] * with_ids)
    schema = PIECES + (", ids array<int>" if with_ids else "")
    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(cut, schema)


PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]


def sweep_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Place ``counts[size]`` pieces of each size below the capacity, largest first.

    Returns (size, first rank, first sequence, offset): pieces of the size
    from that rank on, up to the next entry's, go to consecutive sequences.
    """
    gaps: list[int] = []
    groups: dict[int, list[tuple[int, int]]] = {}
    plan, sequences = [], 0

    def put(gap, first, n):
        if gap not in groups:
            insort(gaps, gap)
            groups[gap] = []
        groups[gap].append((first, n))

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            k = bisect_left(gaps, size)
            if k == len(gaps):
                # No gap holds the size: open as many sequences as its pieces need by themselves.
                new = -(-left // (capacity // size))
                put(capacity, sequences, new)
                sequences += new
                continue
            gap = gaps[k]
            first, n = groups[gap].pop()
            if not groups[gap]:
                del groups[gap], gaps[k]
            used = min(n, left)
            if used < n:
                put(gap, first + used, n - used)
            plan.append((size, rank, first, capacity - gap))
            put(gap - size, first, used)
            rank, left = rank + used, left - used
    return plan


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rank`` from 0 within each group without a group in one task: hashed
    shards are numbered alone, after the counts of the shards before them."""
    shards = max(16, partitions(rows.sparkSession))
    rows = rows.withColumn("_shard", F.pmod(F.xxhash64(*order), F.lit(shards)))
    sizes = rows.groupBy(group, "_shard").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select(group, "_shard", (F.sum("_n").over(
        Window.partitionBy(group).orderBy("_shard")) - F.col("_n")).alias("_before"))
    own = F.row_number().over(Window.partitionBy(group, "_shard").orderBy(*order)) - 1
    return (rows.withColumn("_own", own).join(before, [group, "_shard"])
                .withColumn("rank", F.col("_before") + F.col("_own")).drop("_own", "_before", "_shard"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0,
         with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their ``sequence_id`` and ``offset``
    (``with_ids``: and their ids)."""
    pieces = materialise(token_pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = sweep_plan({s: n for s, n in counts.items() if s < capacity}, capacity)
    plan += [(capacity, 0, max([0, *(first + counts[size] for size, _, first, _ in plan)]), 0)]
    # Sorted by (size, rank); one number orders both, as a rank is below 2**44.
    table = np.array(sorted(plan), np.int64).reshape(-1, 4)
    keys = table[:, 0] * (1 << 44) + table[:, 1]

    def place(frames):
        for f in frames:
            at = np.searchsorted(keys, f["length"].to_numpy() * (1 << 44) + f["rank"].to_numpy(), side="right") - 1
            f["sequence_id"] = table[at, 2] + f["rank"].to_numpy() - table[at, 1]
            f["offset"] = table[at, 3]
            yield f.drop(columns="rank")

    rows = ranked(pieces, "length", ["doc_id", "piece", "ids_crc32"])
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    rows = rows.select(*pieces.columns, F.col("rank").cast("long"))
    return rows.mapInPandas(place, f"{types}, sequence_id long, offset long")
