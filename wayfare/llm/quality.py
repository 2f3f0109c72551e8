"""Quality rules with risk-controlled thresholds.

Each rule is a share of a text's words or lines (repeated words, repeated
lines, symbols, words equal to the word before), in hundredths. Per stratum
(language) and rule, the labelled holdout decides the cutoff. A cutoff's false
rejections among documents labelled good are binomial, so the exact
(Clopper-Pearson) upper bound of their rate is at most ``risk / rules`` when
P(Binomial(n, risk / rules) <= rejected) is at most the error level. Cutoffs
are tested from the most lenient on until one fails (fixed sequence), at the
level ``delta`` divided by strata and rules (Bonferroni). So with probability
1 - delta no stratum loses more than ``risk`` of its good documents to the
rules together. Of the cutoffs that passed and reject more bad documents than good ones, the
most lenient one that rejects the most bad documents counts; a stratum without enough labels has no cutoff.

Defined results: null texts have no words and fail the base rule (under
``min_words`` words); null or unknown languages are strata of their own; null
labels and labels of absent documents are ignored, a document with different
labels counts for each; a repeated document is judged each time; empty tables
give no rows; other columns pass through, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import masked, materialise, mix64, pick, ragged_positions, ship, text_slices, unmasked, word_lists, worker_cache

ship(__name__)

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_stutters"]
#: Rule: (counted, out of).
RULES = {"repeats": ("n_repeat_words", "n_words"), "lines": ("n_dup_lines", "n_lines"),
         "symbols": ("n_symbols", "n_words"), "stutters": ("n_stutters", "n_words")}
TOP = 100


# ------------------------------------------------------------------ counts

def row_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]


def repeated_words(starts: np.ndarray, codes: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Per row, the words that lie in windows of ``width`` words which the row has twice or more."""
    sizes = np.diff(starts)
    windows = np.maximum(sizes - width + 1, 0)
    at = ragged_positions(starts[:-1], windows)
    if not len(at):
        return np.zeros(len(sizes), np.int64)
    row = np.repeat(np.arange(len(sizes), dtype=np.uint64), windows)
    key = mix64(codes.astype(np.uint64) + np.uint64(1))
    mixed = mix64(row + np.uint64(0x51ED27))
    for k in range(width):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + key[at + k]
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    a, b = at[order[:-1][same]], at[order[1:][same]]
    # Equal hashes must be equal windows of one row; else compare the windows themselves.
    if len(a) and not ((row[order[:-1][same]] == row[order[1:][same]]).all()
                       and all((codes[a + k] == codes[b + k]).all() for k in range(width))):
        whole = np.stack([row.astype(np.int64), *(codes[at + k] for k in range(width))], 1)
        _, inverse, count = np.unique(whole, axis=0, return_inverse=True, return_counts=True)
        found = count[inverse.ravel()] > 1
    else:
        found = np.zeros(len(at), bool)
        found[order[:-1][same]] = True
        found[order[1:][same]] = True
    step = np.zeros(len(codes) + 1, np.int64)
    np.add.at(step, at[found], 1)
    np.add.at(step, at[found] + width, -1)
    return row_sums(np.cumsum(step[:-1]) > 0, starts)


def duplicate_lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per text: (lines with a word, those of them equal to an earlier line)."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    enc = lists.flatten().dictionary_encode()
    codes = np.asarray(enc.indices).astype(np.int64)
    worded = ~np.asarray(pc.match_substring_regex(enc.dictionary, "^[\\x20\\x09-\\x0D]*$"))
    sizes = np.diff(np.asarray(lists.offsets).astype(np.int64))
    row = np.repeat(np.arange(len(sizes)), sizes)
    keep = worded[codes]
    row, codes = row[keep], codes[keep]
    lines = np.bincount(row, minlength=len(sizes))
    distinct = np.unique(row * (len(worded) + 1) + codes) // (len(worded) + 1)
    return lines, lines - np.bincount(distinct, minlength=len(sizes))


def count_features(texts: pa.Array) -> dict[str, np.ndarray]:
    starts, codes, words = word_lists(texts)
    chars = np.asarray(pc.utf8_length(words)).astype(np.int64)
    of = lambda values: row_sums(np.asarray(values).astype(np.int64)[codes], starts)
    again = np.diff(codes, prepend=-1) == 0
    again[starts[:-1][np.diff(starts) > 0]] = False
    lines, repeated = duplicate_lines(texts)
    return {"n_words": np.diff(starts), "word_chars": of(chars),
            "n_symbols": of(pc.count_substring_regex(words, SYMBOLS)), "n_dup_lines": repeated,
            "n_repeat_words": repeated_words(starts, codes), "n_lines": lines,
            "n_stutters": row_sums(again, starts)}


def with_counts(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """The documents (``keep_text``: with their texts) and their counts."""
    kept = [c for c in docs.columns if keep_text or c != "text"]

    def run(batches):
        worker_cache("quality")
        for batch in batches:
            texts = batch.column(batch.schema.names.index("text"))
            for a, b in text_slices(texts, 3_000_000):
                counts = count_features(texts[a:b])
                own = [batch.column(batch.schema.names.index(c))[a:b] for c in kept]
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(counts[c], pa.int64()) for c in COUNTS)],
                                                 names=[*kept, *COUNTS])
    text = docs.withColumn("text", F.col("text").cast("string"))
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in text.schema if f.name in kept]
    return text.mapInArrow(run, ", ".join([*types, *(f"{c} long" for c in COUNTS)]))


def base_failed(min_words: int = 20, max_repeat: int = 30) -> "F.Column":
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))


def rule_value(rule: str) -> "F.Column":
    counted, out_of = RULES[rule]
    share = F.floor(F.lit(TOP) * F.col(counted) / F.greatest(F.col(out_of), F.lit(1)))
    return F.least(share, F.lit(TOP)).cast("int")


# --------------------------------------------------------------- calibration

def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= k), exactly summed."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1, dtype=np.float64)
    steps = np.log((n - i[:-1]) / (i[:-1] + 1)) + math.log(p / (1 - p))
    logs = n * math.log1p(-p) + np.concatenate([[0.0], np.cumsum(steps)])
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def choose_cutoff(good: np.ndarray, bad: np.ndarray, risk: float, level: float) -> int | None:
    """The cutoff (reject from that value on) of counts per value, or None."""
    n, best, most = int(good.sum()), None, 0
    for cutoff in range(len(good) - 1, 0, -1):
        if n == 0 or binomial_tail(int(good[cutoff:].sum()), n, risk) > level:
            break
        rejected = int(bad[cutoff:].sum())
        if rejected > max(most, good[cutoff:].sum()):
            best, most = cutoff, rejected
    return best


def with_text_hash(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_text", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def calibrate(counted: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02,
              delta: float = 0.05) -> DataFrame:
    """One row per stratum with labels: its cutoff of each rule (null: none)."""
    labelled = pick(labels, "doc_id", "quality").select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_good")) \
                     .where("_good IN (0, 1)")
    # The bound takes trials to be independent: a stratum's equal texts are one, good if any label says so.
    judged = (counted.where(~base_failed()).join(labelled, F.col("doc_id") == F.col("_id"))
                     .groupBy(F.col(stratum).cast("string").alias("stratum"), "_text").agg(
                         F.max("_good").alias("_good"), *[F.max(rule_value(r)).alias(f"_v_{r}") for r in RULES]))
    rows = (judged.select("stratum", "_good", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"_v_{r}").alias("value"))
                                                                  for r in RULES])).alias("x"))
                   .groupBy("stratum", "x.rule", "x.value")
                   .agg(F.sum("_good").alias("good"), F.sum(1 - F.col("_good")).alias("bad")))
    # Strata x rules x 101 rows at most.
    rows = materialise(rows, "rule-values")
    names, strata = list(RULES), max(1, rows.select("stratum").distinct().count())

    def cutoffs(f: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"stratum": [f["stratum"].iloc[0]]}
        for rule in names:
            part = f[f["rule"] == rule]
            good, bad = (np.bincount(part["value"], part[c], TOP + 1) for c in ("good", "bad"))
            out[rule] = [choose_cutoff(good, bad, risk / len(names), delta / len(names) / strata)]
        return pd.DataFrame(out)

    # A stratum's rows: at most rules x 101 values.
    return rows.groupBy("stratum").applyInPandas(
        cutoffs, "stratum string, " + ", ".join(f"{r} int" for r in names))


def judge(counted: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """Adds ``base_failed``, ``rejected_by`` (rules) and ``kept``."""
    names = {r: f"_cut_{r}" for r in RULES}
    table = cutoffs.select(F.col("stratum").alias("_stratum"), *[F.col(r).alias(n) for r, n in names.items()])
    joined = counted.join(table,
                          F.col(stratum).cast("string").eqNullSafe(F.col("_stratum")), "left")
    rules = F.filter(F.array(*[F.when(rule_value(r) >= F.col(n), F.lit(r)) for r, n in names.items()]),
                     lambda x: x.isNotNull())
    return (joined.withColumn("base_failed", base_failed()).withColumn("rejected_by", rules)
                  .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
                  .drop("_stratum", *names.values()))


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02,
                  delta: float = 0.05) -> DataFrame:
    """Counts and verdict of every document, without its text."""
    counted = materialise(with_counts(with_text_hash(pick(docs, "doc_id", "text", stratum)), keep_text=False), "quality")
    cutoffs = materialise(calibrate(counted, labels, stratum, risk, delta), "cutoffs")
    return judge(counted.drop("_text"), cutoffs, stratum)


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02,
              delta: float = 0.05) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    own, safe = masked(docs, "doc_id", "text", stratum)
    counted = with_counts(with_text_hash(own.select("doc_id", "text", stratum)), keep_text=False)
    cutoffs = materialise(calibrate(counted, labels, stratum, risk, delta), "cutoffs")
    return unmasked(judge(with_counts(own), cutoffs, stratum).where("kept"), safe, docs.columns)
