"""Filter interaction audit: what each of five filters removes in every order.

A document's *mask* says which filters it fails. For a mask (with the labels of
the document) all outcomes of the 600 steps (120 orders of five) are known: kept,
removed here, redundant, the only failure, good or toxic text lost. They are the
fields of one wide integer, 64 bits each, so adding integers adds all counters at
once; a field overflows only beyond 2**63 documents.

* A map over the texts gives each document four of its flags and a hash of 128
  bits of its text.
* The fifth filter asks for the same text under a smaller id anywhere. Every task
  decides what its own rows decide (of equal texts all but its least id fail) and
  adds those up; one row per distinct text and task goes on, is grouped by hash,
  and is added up after it. A text that a third of all documents share is one
  row per task.
* Per task and part one integer is written; the integers of a part are summed
  and unpacked into 600 rows.

Defined results: a null text is empty, a null source the empty string; a null
doc_id is smaller than all others; rows that repeat id and text are documents of
their own and none repeats the other; a document is good (toxic) if any row of
``labels`` with its id says so; parts without documents have no rows; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kernels import materialise, null_first, pick, ship, text_slices, word_lists

ship(__name__)

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
FIELD = 64
STEPS = len(ORDERS) * len(FILTERS)
GOOD, TOXIC = 1 << len(FILTERS), 2 << len(FILTERS)


# ------------------------------------------------------------ wide integers

def outcomes(code: int) -> np.ndarray:
    """(600 steps, 6 counts) of one document with this mask and labels."""
    fails = code & GOOD - 1
    out = np.zeros((STEPS, len(COUNTS)), np.int64)
    for n, order in enumerate(ORDERS):
        gone = False
        for k, name in enumerate(order):
            bit = 1 << FILTERS.index(name)
            failed = bool(fails & bit)
            removed = failed and not gone
            redundant = failed and gone
            gone = gone or failed
            out[n * len(FILTERS) + k] = [not gone, removed, redundant, fails == bit,
                                         removed and bool(code & GOOD), removed and bool(code & TOXIC)]
    return out


def packed(counts: np.ndarray) -> int:
    """All counters as one integer, the first in the lowest field."""
    return int.from_bytes(counts.astype("<u8").tobytes(), "little")


def unpacked(total: int) -> np.ndarray:
    size = STEPS * len(COUNTS) * FIELD // 8
    return np.frombuffer(total.to_bytes(size, "little"), "<u8").astype(np.int64).reshape(STEPS, len(COUNTS))


class WideCounters:
    """Per part the sum of its documents' integers."""

    def __init__(self):
        self.of, self.total = {}, {}

    def add(self, parts: list[str], part: np.ndarray, code: np.ndarray, times: np.ndarray | None = None):
        both, at = np.unique(part * (4 * GOOD) + code, return_inverse=True)
        n = np.zeros(len(both), np.int64)
        np.add.at(n, at, 1 if times is None else times)
        for x, count in zip(both.tolist(), n.tolist()):
            p, c = parts[x // (4 * GOOD)], x % (4 * GOOD)
            if c not in self.of:
                self.of[c] = packed(outcomes(c))
            self.total[p] = self.total.get(p, 0) + self.of[c] * count

    def rows(self) -> pa.RecordBatch:
        size = STEPS * len(COUNTS) * FIELD // 8
        out = pa.RecordBatch.from_arrays([pa.array(list(self.total), pa.string()),
                                          pa.array([t.to_bytes(size, "little") for t in self.total.values()], pa.binary())],
                                         ["part", "total"])
        self.total = {}
        return out


# -------------------------------------------------------------------- flags

def own_flags(texts: pa.Array, min_words: int, min_distinct: int, max_upper: int) -> np.ndarray:
    """Bits of the filters that look at one text only (all but the last)."""
    texts = pc.fill_null(texts, "")
    starts, codes, distinct = word_lists(texts)
    words = np.diff(starts)
    doc = np.repeat(np.arange(len(words)), words)
    different = np.bincount(np.unique(doc * (len(distinct) + 1) + codes) // (len(distinct) + 1), minlength=len(words))
    upper = np.asarray(pc.subtract(pc.binary_length(texts), pc.binary_length(pc.replace_substring_regex(texts, "[A-Z]+", ""))))
    fails = [words < min_words, 100 * different < min_distinct * words,
             100 * upper.astype(np.int64) > max_upper * np.asarray(pc.utf8_length(texts)).astype(np.int64),
             np.asarray(pc.match_substring_regex(texts, "[#$%&*|]"))]
    return sum((f.astype(np.int64) << k for k, f in enumerate(fails)), np.zeros(len(words), np.int64))


def flagged(docs: DataFrame, min_words: int, min_distinct: int, max_upper: int) -> DataFrame:
    """doc_id (null: the least), part, mask and hash of each document."""
    def run(batches):
        import xxhash
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                texts = pc.fill_null(batch.column(1)[a:b], "")
                mask = own_flags(texts, min_words, min_distinct, max_upper)
                h = pa.array([xxhash.xxh3_128_digest(t) for t in texts.cast(pa.binary()).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], batch.column(2)[a:b], pa.array(mask.astype(np.int32)), h],
                                                 ["doc_id", "part", "mask", "h"])
    rows = pick(docs, "doc_id", "text", "source").select(null_first(F.col("doc_id").cast("long")).alias("doc_id"),
                                                         F.col("text").cast("string"),
                                                         F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"))
    return rows.mapInArrow(run, "doc_id long, part string, mask int, h binary")


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The mask with the bits of the labels."""
    by_id = pick(labels, "doc_id", "quality", "toxic").groupBy(null_first(F.col("doc_id").cast("long")).alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
    code = F.col("mask") + F.coalesce("good", F.lit(0)) * GOOD + F.coalesce("bad", F.lit(0)) * TOXIC
    return rows.join(by_id, "doc_id", "left").select("doc_id", "part", code.cast("int").alias("code"), "h")


# ----------------------------------------------------------- equal texts

UNDECIDED = "h binary, doc_id long, part string, code int, n long"
EQUAL_TEXT = 1 << FILTERS.index("E")


def decide(rows: DataFrame, flush: int = 200_000) -> DataFrame:
    """Each task's integers of what it can decide, and its rows with the least id of a text."""
    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= flush:
                yield from settle(held)
                held, n = [], 0
        if held:
            yield from settle(held)

    def settle(batches):
        table = pa.Table.from_batches(batches).combine_chunks()
        ids, code = (np.asarray(table[c]).astype(np.int64) for c in ("doc_id", "code"))
        text = np.asarray(table["h"].combine_chunks().dictionary_encode().indices).astype(np.int64)
        parts = table["part"].combine_chunks().dictionary_encode()
        part, names = np.asarray(parts.indices).astype(np.int64), parts.dictionary.to_pylist()
        least = np.full(int(text.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, text, ids)
        later = ids > least[text]
        wide = WideCounters()
        wide.add(names, part[later], code[later] | EQUAL_TEXT)
        sums = wide.rows()
        # Rows that repeat id, part and flags go on as one with their number.
        rest = np.flatnonzero(~later)
        key = np.stack([text[rest], part[rest], code[rest]], 1)
        _, first, n = np.unique(key, axis=0, return_index=True, return_counts=True)
        rest = pa.array(rest[first])
        empty = [pa.nulls(len(sums), t) for t in (pa.binary(), pa.int64())]
        names = ["h", "doc_id", "part", "code", "n", "total"]
        yield pa.RecordBatch.from_arrays([*empty, sums["part"], pa.nulls(len(sums), pa.int32()), pa.nulls(len(sums), pa.int64()),
                                          sums["total"]], names)
        own = table.take(rest)
        yield pa.RecordBatch.from_arrays([*(own[c].combine_chunks() for c in ("h", "doc_id", "part")),
                                          own["code"].combine_chunks().cast(pa.int32()), pa.array(n.astype(np.int64)),
                                          pa.nulls(len(n), pa.binary())], names)
    return rows.mapInArrow(run, f"{UNDECIDED}, total binary")


def sums_of(rows: DataFrame, most: int = 500) -> DataFrame:
    """Per task and part the integer of rows (part, code, n)."""
    def run(batches):
        wide = WideCounters()
        for batch in batches:
            part = batch.column(0).dictionary_encode()
            wide.add(part.dictionary.to_pylist(), np.asarray(part.indices).astype(np.int64),
                     np.asarray(batch.column(1)).astype(np.int64), np.asarray(batch.column(2)))
            if len(wide.total) > most:
                yield wide.rows()
        yield wide.rows()
    return rows.mapInArrow(run, "part string, total binary")


def added(sums: DataFrame, *by: str) -> DataFrame:
    """The integers of each group as one."""
    def run(table: pa.Table) -> pa.Table:
        total = sum(int.from_bytes(t, "little") for t in table["total"].to_pylist())
        size = STEPS * len(COUNTS) * FIELD // 8
        return pa.table({"part": table["part"][:1], "total": pa.array([total.to_bytes(size, "little")], pa.binary())})
    return sums.groupBy(*by).applyInArrow(run, "part string, total binary")


RESULT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in [*COUNTS, "shapley"])


def step_rows(totals: DataFrame) -> DataFrame:
    """Unpacks the integer of each part into a row per order and step."""
    def run(batches):
        orders = [o for o in ORDERS for _ in FILTERS]
        letters = np.array([FILTERS.index(c) for o in ORDERS for c in o])
        for batch in batches:
            for part, total in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = unpacked(int.from_bytes(total, "little"))
                shapley = np.bincount(letters, counts[:, COUNTS.index("removed")], minlength=len(FILTERS)).astype(np.int64)
                steps = pa.array(np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * STEPS), pa.array(orders), steps, *(pa.array(np.ascontiguousarray(c)) for c in counts.T),
                     pa.array(shapley[letters])], ["part", "filter_order", "step", *COUNTS, "shapley"])
    return totals.mapInArrow(run, RESULT)


def filter_audit(docs: DataFrame, labels: DataFrame, min_words: int = 50, min_distinct: int = 65, max_upper: int = 5,
                 lanes: int = 256) -> DataFrame:
    """For every part (source), order and step: the counts of ``COUNTS`` and ``shapley``,
    its filter's removals summed over all orders. Filters: A under ``min_words`` words;
    B distinct words under ``min_distinct`` percent; C capitals over ``max_upper``
    percent of the characters; D one of ``#$%&*|``; E the text of a smaller id."""
    rows = with_labels(flagged(docs, min_words, min_distinct, max_upper), labels)
    settled = materialise(decide(rows), "audit")
    least = F.min("doc_id").over(Window.partitionBy("h"))
    last = settled.where("total IS NULL").withColumn("code", F.when(F.col("doc_id") > least, F.col("code").bitwiseOR(EQUAL_TEXT))
                                                     .otherwise(F.col("code")))
    sums = settled.where("total IS NOT NULL").select("part", "total").unionByName(sums_of(last.select("part", "code", "n")))
    # In two levels, so that the number of tasks bounds no group's size by itself.
    some = added(sums.withColumn("lane", F.spark_partition_id() % lanes), "part", "lane")
    return step_rows(added(some, "part"))
