"""Toxicity scores from a small recurrent network.

Each word enters as a learned vector of the word (if it is in the vocabulary)
and of its character trigrams. A gated recurrent unit reads the words in both
directions, attention pools its states over a window of 32 words, a logistic unit
gives the window's score. A text's score is that of its most toxic window, over
all overlapping windows (one per word) of the whole text.

Windows share their states: a run of the unit covers a stretch of the text and 16
words around it, every window in the stretch pools its part of them. Pooled logits
are weighted means, so all windows cost two sliding sums. Training (numpy, Adam,
back-propagation through time) runs over a window and the 16 words on either side
and pools the window alone. It knows only labels of whole texts, so it learns from
each text's currently most toxic windows.

The training sample is bounded in rows: ``per_class`` toxic documents and twice as
many clean ones, those with the least hash of doc_id, in their whole texts, which
are scored a stretch at a time.

Defined results: null and empty texts score as an empty window does; null or
other labels are ignored, a document labelled both ways is toxic; a null
doc_id is neither learned from nor held out; without examples of both classes
every score is 0; repeated rows are scored each; empty tables give no rows;
other columns pass through, whatever their names.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kernels import masked, pick, ragged_positions, release, ship, text_slices, unmasked, word_lists, worker_cache

ship(__name__)

WINDOW, MARGIN = 32, 16
#: Windows that one run scores.
STRETCH = 192
HIDDEN, SIZE, GRAMS = 8, 12, 1 << 13
TOUCH = "[^\\p{L}\\p{N}]+"


# ------------------------------------------------------------------ inputs

def plain_words(words: pa.Array) -> pa.Array:
    """Lower case, only letters and digits."""
    return pc.utf8_lower(pc.replace_substring_regex(words, TOUCH, ""))


def gram_lists(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row offsets, buckets) of the byte trigrams of each word between two marks."""
    marked = pc.binary_join_element_wise("<", words, ">", "").cast(pa.large_binary())
    ends = np.frombuffer(marked.buffers()[1], np.int64)[marked.offset:marked.offset + len(marked) + 1]
    raw = np.frombuffer(marked.buffers()[2], np.uint8).astype(np.uint32)
    count = np.maximum(np.diff(ends) - 2, 1)
    at = np.minimum(ragged_positions(ends[:-1], count), max(len(raw) - 3, 0))
    padded = np.concatenate([raw, np.zeros(3, np.uint32)])
    key = padded[at] | padded[at + 1] << 8 | padded[at + 2] << 16
    return np.concatenate([[0], np.cumsum(count)]), (key * np.uint32(2654435761) >> np.uint32(19)) % GRAMS


def window_counts(sizes: np.ndarray) -> np.ndarray:
    """Windows of texts of these sizes: one per word that has ``WINDOW`` words from it on, at least one."""
    return np.maximum(sizes - WINDOW + 1, 1)


def stretches(starts: np.ndarray):
    """Runs over the texts: (text, first window, windows, first word, words).
    Windows are numbered within the text; words count over all texts."""
    sizes = np.diff(starts)
    windows = window_counts(sizes)
    count = -(-windows // STRETCH)
    row = np.repeat(np.arange(len(sizes)), count)
    number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    first = number * STRETCH
    n = np.minimum(STRETCH, windows[row] - first)
    begin = np.maximum(first - MARGIN, 0)
    end = np.minimum(first + n - 1 + WINDOW + MARGIN, sizes[row])
    return row, first, n, starts[:-1][row] + begin, end - begin


# ----------------------------------------------------------------- network

def add_rows(target: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """target[at] += values, for repeated rows too."""
    if len(at):
        order = np.argsort(at, kind="stable")
        cuts = np.flatnonzero(np.diff(at[order], prepend=-1))
        target[at[order[cuts]]] += np.add.reduceat(values[order], cuts, axis=0)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters ``p`` (arrays by name), forward and backward passes."""

    def __init__(self, vocabulary: dict[str, int], p: dict[str, np.ndarray]):
        self.vocabulary, self.p = vocabulary, p

    @classmethod
    def fresh(cls, vocabulary: dict[str, int], hints: np.ndarray, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        r = lambda *s, scale=0.3: (rng.standard_normal(s) * scale).astype(np.float32)
        word = r(len(vocabulary) + 1, SIZE, scale=0.05)
        word[:, 0] += hints
        word[0] = 0
        h3 = 3 * HIDDEN
        return cls(vocabulary, {"word": word, "gram": r(GRAMS, SIZE, scale=0.05), "input": r(2 * SIZE, 2 * h3),
                                "bias": np.zeros(2 * h3, np.float32), "forth": r(HIDDEN, h3), "back": r(HIDDEN, h3),
                                "attend": r(2 * HIDDEN), "out": r(2 * HIDDEN), "shift": np.zeros(1, np.float32),
                                "scale": np.array([1, 0], np.float32)})

    def inputs(self, words: pa.Array):
        """Vocabulary rows and trigrams of distinct words, and their vectors."""
        own = np.fromiter((self.vocabulary.get(w, 0) for w in words.to_numpy(zero_copy_only=False)), np.int64, len(words))
        ends, grams = gram_lists(words)
        if not len(words):
            return own, ends, grams, np.zeros((0, 2 * SIZE), np.float32)
        mean = np.add.reduceat(self.p["gram"][grams], ends[:-1], axis=0) / np.diff(ends)[:, None]
        return own, ends, grams, np.concatenate([self.p["word"][own], mean], 1).astype(np.float32, copy=False)

    def steps(self, table: np.ndarray, codes: np.ndarray, mask: np.ndarray | None, each):
        """Runs the unit over ``codes`` (time x runs) in both directions; ``each``
        gets (side, time, state before, r, z, candidate, recurrent part, state)."""
        n, H = codes.shape[1], HIDDEN
        for side, name in enumerate(("forth", "back")):
            u, h = self.p[name], np.zeros((n, H), np.float32)
            part = np.ascontiguousarray(table[:, side * 3 * H:(side + 1) * 3 * H])
            for t in range(len(codes)) if side == 0 else range(len(codes) - 1, -1, -1):
                x, hu = part[codes[t]], h @ u
                rz = 1 / (1 + np.exp(-(x[:, :2 * H] + hu[:, :2 * H])))
                r, z = rz[:, :H], rz[:, H:]
                c = 2 / (1 + np.exp(-2 * (x[:, 2 * H:] + r * hu[:, 2 * H:]))) - 1
                new = c + z * (h - c)
                if mask is not None:
                    new = np.where(mask[t][:, None], new, h)
                each(side, t, h, r, z, c, hu[:, 2 * H:], new)
                h = new

    def run(self, table: np.ndarray, codes: np.ndarray, mask: np.ndarray, pool: np.ndarray):
        """Logits of one window per run. table: input part of the gates per word;
        codes: words by time and run; mask: 0 where there is no word; pool: 1
        where the word is the window's."""
        H = HIDDEN
        both, saved = np.empty((*codes.shape, 2 * H), np.float32), []

        def each(side, t, h, r, z, c, hun, new):
            saved.append((side, t, h, r, z, c, hun))
            both[t][:, side * H:(side + 1) * H] = new
        self.steps(table, codes, mask, each)
        att = np.where(pool, both @ self.p["attend"], -1e4)
        att = np.exp(att - att.max(0)) * pool
        att /= np.maximum(att.sum(0), 1e-30)
        pooled = np.einsum("tn,tnh->nh", att, both)
        return pooled @ self.p["out"] + self.p["shift"][0], both, att, pooled, saved

    def all_windows(self, table: np.ndarray, codes: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Logits (time x runs) of the windows that begin at each time of runs of ``size`` words."""
        steps, n = codes.shape
        mask = np.arange(steps)[:, None] < size
        att, part = np.zeros((steps, n), np.float32), np.zeros((steps, n), np.float32)
        H, attend, out = HIDDEN, self.p["attend"], self.p["out"]

        def each(side, t, h, r, z, c, hun, new):
            att[t] += new @ attend[side * H:(side + 1) * H]
            part[t] += new @ out[side * H:(side + 1) * H]
        self.steps(table, codes, None if mask.all() else mask, each)
        # Weights relative to the run's greatest, none so small that a window has no weight.
        att = np.where(mask, att, -np.inf)
        weight = np.exp(np.maximum(att - att.max(0, initial=-1e4), -60)) * mask
        total, logit, reach = weight, weight * part, 1
        while reach < WINDOW:
            total, logit = (x + np.concatenate([x[reach:], np.zeros((min(reach, steps), n), np.float32)])[:steps] for x in (total, logit))
            reach *= 2
        return logit / np.maximum(total, 1e-30) + self.p["shift"][0]

    def gradients(self, words: pa.Array, codes: np.ndarray, mask: np.ndarray, y: np.ndarray, pool: np.ndarray | None = None):
        """Mean logistic loss of windows and its gradient by parameter (``pool`` as in ``run``)."""
        H, p = HIDDEN, self.p
        own, ends, grams, vectors = self.inputs(words)
        table = vectors @ p["input"] + p["bias"]
        logit, both, att, pooled, saved = self.run(table, codes, mask, mask if pool is None else pool)
        prob = sigmoid(logit)
        loss = float(-np.mean(np.log(np.where(y > 0, prob, 1 - prob) + 1e-7)))
        dlogit = ((prob - y) / len(y)).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("word", "gram", "scale")}
        g["out"], g["shift"] = pooled.T @ dlogit, dlogit.sum(keepdims=True)
        dpooled = dlogit[:, None] * p["out"]
        datt = np.einsum("tnh,nh->tn", both, dpooled)
        datt = att * (datt - (att * datt).sum(0))
        g["attend"] = np.einsum("tnh,tn->h", both, datt)
        dboth = att[:, :, None] * dpooled + datt[:, :, None] * p["attend"]
        dtable, dgate = np.zeros_like(table), np.empty((*codes.shape, 6 * H), np.float32)
        carry = {0: np.zeros((len(y), H), np.float32), 1: np.zeros((len(y), H), np.float32)}
        for side, t, h, r, z, c, hun in reversed(saved):
            u, m = p["back" if side else "forth"], mask[t][:, None]
            total = dboth[t][:, side * H:(side + 1) * H] + carry[side]
            dnew = np.where(m, total, 0)
            dc, dz = dnew * (1 - z) * (1 - c * c), dnew * (h - c) * z * (1 - z)
            dr = dc * hun * r * (1 - r)
            dhu = np.concatenate([dr, dz, dc * r], 1)
            dx = np.concatenate([dr, dz, dc], 1)
            g["back" if side else "forth"] += h.T @ dhu
            dgate[t][:, side * 3 * H:(side + 1) * 3 * H] = dx
            carry[side] = dnew * z + dhu @ u.T + np.where(m, 0, total)
        add_rows(dtable, codes.ravel(), dgate.reshape(-1, 6 * H))
        g["input"], g["bias"] = vectors.T @ dtable, dtable.sum(0)
        dvec = dtable @ p["input"].T
        g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
        add_rows(g["word"], own, dvec[:, :SIZE])
        g["word"][0] = 0
        size = np.diff(ends)
        add_rows(g["gram"], grams, np.repeat(dvec[:, SIZE:] / size[:, None], size, axis=0))
        return loss, g

    # --------------------------------------------------------------- scoring

    def gate_table(self, words: pa.Array) -> np.ndarray:
        """The words' input to the gates, a part of the words at a time; the last row is no word's."""
        table = np.empty((len(words) + 1, 6 * HIDDEN), np.float32)
        table[:] = self.p["bias"]
        for k in range(0, len(words), 20_000):
            table[k:k + 20_000][:len(words) - k] += self.inputs(words[k:k + 20_000])[-1] @ self.p["input"]
        return table

    def text_logits(self, starts: np.ndarray, codes: np.ndarray, words: pa.Array, rng=None, block: int = 1024):
        """(greatest logit, its window) of each text, and with ``rng`` a random window of each."""
        table, texts = self.gate_table(words), len(starts) - 1
        top, at = np.full(texts, -np.inf, np.float32), np.zeros(texts, np.int64)
        row, first, n, begin, size = stretches(starts)
        order = np.argsort(size, kind="stable")
        none = np.int64(len(words))
        for k in range(0, len(order), block):
            own = order[k:k + block]
            steps = np.arange(max(int(size[own[-1]]), 1))[:, None]
            place = np.minimum(begin[own] + steps, max(len(codes) - 1, 0))
            run = np.where(steps < size[own], codes[place] if len(codes) else none, none)
            logit = self.all_windows(table, run, size[own])
            lead = first[own] - (begin[own] - starts[:-1][row[own]])
            logit = np.where((steps >= lead) & (steps < lead + n[own]), logit, -np.inf)
            best = logit.argmax(0)
            value = logit[best, np.arange(len(own))]
            # Stretches of one text may meet in a block: the greatest comes last.
            for j in np.argsort(value, kind="stable").tolist():
                if value[j] > top[row[own[j]]]:
                    top[row[own[j]]], at[row[own[j]]] = value[j], first[own[j]] + best[j] - lead[j]
        if rng is None:
            return top, at
        return top, at, (rng.random(texts) * window_counts(np.diff(starts))).astype(np.int64)

    def scores(self, texts: pa.Array) -> np.ndarray:
        starts, codes, words = word_lists(texts)
        top, _ = self.text_logits(starts, codes, plain_words(words))
        return sigmoid(self.p["scale"][0] * top + self.p["scale"][1])


# ---------------------------------------------------------------- training

def log_odds(starts, codes, n_words, y) -> np.ndarray:
    """How much likelier toxic texts have a word (by texts with it)."""
    row = np.repeat(np.arange(len(y)), np.diff(starts))
    seen = np.unique(row * n_words + codes)
    row, word = seen // n_words, seen % n_words
    toxic = np.bincount(word, y[row], n_words)
    clean = np.bincount(word, 1 - y[row], n_words)
    odds = np.log((toxic + 0.5) / (y.sum() + 1)) - np.log((clean + 0.5) / ((1 - y).sum() + 1))
    return np.where(toxic + clean >= 3, odds, 0)


def hinted_windows(starts: np.ndarray, hint: np.ndarray, rng):
    """(sum, window) with the greatest sum of ``hint`` in each text, and a random window of each."""
    total = np.concatenate([[0.0], np.cumsum(hint, dtype=np.float64)])
    top, at = np.zeros(len(starts) - 1), np.zeros(len(starts) - 1, np.int64)
    for r, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
        sums = total[min(a + WINDOW, b):b + 1] - total[a:max(b - WINDOW, a) + 1]
        at[r] = sums.argmax()
        top[r] = sums[at[r]]
    return top, at, (rng.random(len(top)) * window_counts(np.diff(starts))).astype(np.int64)


def train(texts: list[str], labels: np.ndarray, toxic_share: float | None = None, epochs: int = 5, batch: int = 256, rate: float = 0.01,
          vocabulary_size: int = 50_000, seed: int = 7) -> Network | None:
    """Fit on texts with labels 0 and 1; None without both. ``toxic_share``: of
    all labelled documents, if the texts are not drawn in proportion."""
    y = np.asarray(labels, np.float32)
    if not len(y) or y.min() == y.max():
        return None
    # Empty texts are clean.
    empty = 1 + len(y) // 100
    texts, y = [*texts, *[""] * empty], np.concatenate([y, np.zeros(empty, np.float32)])
    rng = np.random.default_rng(seed)
    starts, raw, words = word_lists(pa.array(texts, pa.string()))
    enc = plain_words(words).dictionary_encode()
    codes, words = np.asarray(enc.indices).astype(np.int32)[raw], enc.dictionary
    del texts, raw, enc
    odds = log_odds(starts, codes, len(words), y)
    counts = np.bincount(codes, minlength=len(words))
    names = words.to_numpy(zero_copy_only=False)
    known = [c for c in np.argsort(-counts, kind="stable")[:vocabulary_size] if counts[c] >= 3 and names[c]]
    vocabulary = {names[c]: k + 1 for k, c in enumerate(known)}
    hints = np.concatenate([[0], np.clip(odds[known], -2, 4) / 2]).astype(np.float32)
    net = Network.fresh(vocabulary, hints, seed)
    # The first windows are those with the most toxic words.
    sizes = np.diff(starts)
    top, at, other = hinted_windows(starts, np.maximum(odds, 0).astype(np.float32)[codes], rng)
    del names
    release()
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items() if k != "scale"}
    step, time = 0, np.arange(WINDOW + 2 * MARGIN)[:, None]
    for epoch in range(epochs):
        # Each text's most toxic window so far; of some clean texts a random one too.
        clean = np.flatnonzero(y == 0)
        extra = rng.choice(clean, min(len(clean), len(y) // 2), replace=False)
        row, window = np.concatenate([np.arange(len(y)), extra]), np.concatenate([at, other[extra]])
        order = rng.permutation(len(row))
        for k in range(0, len(order), batch):
            own, w = row[order[k:k + batch]], window[order[k:k + batch]]
            begin = np.maximum(w - MARGIN, 0)
            end = np.minimum(w + WINDOW + MARGIN, sizes[own])
            mask = time < end - begin
            pool = mask & (time >= w - begin) & (time < w - begin + WINDOW)
            place = np.minimum(starts[:-1][own] + begin + time, len(codes) - 1)
            used, codes_at = np.unique(codes[place], return_inverse=True)
            _, g = net.gradients(words.take(pa.array(used)), codes_at.reshape(place.shape), mask, y[own], pool)
            step += 1
            for name, grad in g.items():
                m, v = moments[name]
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                net.p[name] -= (rate * 0.7 ** epoch * (m / (1 - 0.9 ** step))
                                / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        top, at, other = net.text_logits(starts, codes, words, rng)
    # Scale and shift of the text's logit (Newton steps of a logistic fit with a little damping).
    x, beta = np.stack([top, np.ones(len(y))], 1), np.array([1.0, 0.0])
    for _ in range(25):
        q = sigmoid(x @ beta)
        hess = x.T @ (x * (q * (1 - q))[:, None]) + 0.05 * np.eye(2)
        beta = beta - np.linalg.solve(hess, x.T @ (q - y) + 0.05 * (beta - [1, 0]))
    if toxic_share:
        beta[1] += np.log(toxic_share / (1 - toxic_share)) - np.log(y.mean() / (1 - y.mean()))
    if beta[0] > 0:
        net.p["scale"] = beta.astype(np.float32)
    return net


# ------------------------------------------------------------------- tables

def fold_of(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int):
    """(texts, labels, toxic share of all labelled documents that may be learned from)."""
    known = (labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id")
                   .agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where(fold_of(F.col("doc_id")) != 0))
    present = known.join(docs.select("doc_id").distinct(), "doc_id")
    share = present.agg(F.avg("toxic")).first()[0]
    least = [present.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
             for c, n in ((0, 2 * per_class), (1, per_class))]
    # At most 3 x per_class rows.
    sample = F.broadcast(least[0].unionByName(least[1]))
    rows = docs.select("doc_id", "text").join(sample, "doc_id")
    one = rows.groupBy("doc_id").agg(F.min(F.struct(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                                                    "toxic")).alias("x")).select("doc_id", "x.*")

    found = one.toPandas().sort_values("doc_id")
    release()
    return found["text"].tolist(), found["toxic"].to_numpy(np.float32), share


def score_texts(docs: DataFrame, net: Network | None) -> DataFrame:
    """The documents with ``score``."""
    docs = docs.withColumn("text", F.col("text").cast("string"))
    if net is None:
        return docs.withColumn("score", F.lit(0.0))
    state, name = docs.sparkSession.sparkContext.broadcast((net.vocabulary, net.p)), uuid.uuid4().hex

    def run(batches):
        held = worker_cache("toxicity")
        if held.get("toxicity", (None,))[0] != name:
            held["toxicity"] = (name, Network(*state.value))
        own = held["toxicity"][1]
        for batch in batches:
            texts = batch.column(batch.schema.names.index("text"))
            for a, b in text_slices(texts, 4_000_000):
                cols = [c[a:b] for c in batch.columns]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(own.scores(texts[a:b]).astype(np.float64))],
                                                 names=[*batch.schema.names, "score"])
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{types}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = 1500) -> DataFrame:
    """The documents (doc_id, text and others) with ``score``, ``held_out`` and ``predicted``."""
    net = train(*training_sample(docs, pick(labels, "doc_id", "toxic"), per_class))
    release()
    return (score_texts(docs, net).withColumn("held_out", F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False)))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def keep_clean(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    own, safe = masked(docs, "doc_id", "text")
    return unmasked(toxicity(own, labels, **parameters).where("predicted = 0"), safe, docs.columns)
