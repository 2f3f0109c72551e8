"""Byte-level BPE by a pair-occurrence index.

All distinct pre-tokens of a partition's batch lie in one array of symbols. An
index maps each mergeable pair's rank to all its positions. The active ranks
are applied in ascending order, lowest first: all occurrences of a pair merge
at once, and the pairs that the merges make or destroy beside them update the
index. Texts are put together from their pre-tokens' ids by array gathers.

Defined results: a null text is empty (no ids); empty tables give no rows;
rows repeat with their results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import pick, ragged_positions, ship, text_slices, worker_cache
from .tokens import byte_letters, pieces_of

ship(__name__)

#: The byte-level pre-token pattern (a fixed value of this kind of vocabulary).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO = 400_000


class PairIndexBpe:
    """Encoder and decoder of one byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.byte_id = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.width = 1 + max(max(vocab.values()), *(t["id"] for t in spec["added_tokens"]), 0)
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_rank, self.made = keys[order], order, made
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = regex.compile(PRE_TOKEN)
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))
                                         + ")") if self.added else None
        back = {v: k for k, v in letters.items()}
        token_bytes = [b""] * self.width
        for t, i in vocab.items():
            token_bytes[i] = bytes(back[c] for c in t)
        for t, i in self.added.items():
            token_bytes[i] = t.encode()
        self.byte_length = np.array([len(t) for t in token_bytes], np.int64)
        self.byte_start = np.cumsum(self.byte_length) - self.byte_length
        self.bytes = np.frombuffer(b"".join(token_bytes), np.uint8)
        self.clear()

    def clear(self):
        self.memo: dict[str, list[int]] = {}

    # ------------------------------------------------------------ merging

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; -1: no merge."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_rank[at], -1) if len(self.keys) else np.full(len(key), -1)

    def merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids per word, all ids in order)."""
        raw = np.frombuffer(b"".join(words), np.uint8)
        size = np.fromiter(map(len, words), np.int64, len(words))
        n = len(raw)
        symbol = self.byte_id[raw]
        word = np.repeat(np.arange(len(words)), size)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        alive = np.ones(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(at: np.ndarray):
            """Put the pairs that begin at these positions into the index."""
            to = after[at]
            ok = to < n
            at, to = at[ok], to[ok]
            same = word[at] == word[to]
            at, to = at[same], to[same]
            rank = self.ranks(symbol[at], symbol[to])
            at, rank = at[rank >= 0], rank[rank >= 0]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank, prepend=-1)) if len(rank) else np.zeros(0, np.int64)
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(rank)]):
                r = int(rank[a])
                if r not in index:
                    index[r] = []
                    heapq.heappush(active, r)
                index[r].append(at[a:b])

        add(np.arange(n))
        rank_key = np.empty(len(self.keys), np.int64)
        rank_key[self.key_rank] = self.keys
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b = divmod(int(rank_key[r]), self.width)
            to = after[at]
            ok = alive[at] & (to < n)
            at, to = at[ok], to[ok]
            ok = (symbol[at] == a) & (symbol[to] == b) & (word[at] == word[to])
            at, to = at[ok], to[ok]
            if a == b and len(at) > 1:
                # Overlaps, as in aaa: the leftmost pair of a run goes first, then every second one.
                follows = np.concatenate([[False], to[:-1] == at[1:]])
                run = np.flatnonzero(~follows)
                place = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
                at, to = at[place % 2 == 0], to[place % 2 == 0]
            if not len(at):
                continue
            symbol[at] = self.made[r]
            alive[to] = False
            beyond = after[to]
            after[at] = beyond
            inside = beyond < n
            before[beyond[inside]] = at[inside]
            left = before[at]
            left = left[left >= 0]
            add(np.unique(np.concatenate([at, left])))
        counts = np.bincount(word[alive], minlength=len(words)) if n else np.zeros(len(words), np.int64)
        return counts, symbol[alive]

    # ----------------------------------------------------------- encoding

    def learn(self, strings: list[str]):
        """Memoise the ids of strings that stand alone (texts or pieces)."""
        if len(self.memo) + len(strings) > MEMO:
            self.clear()
        parts: list[list[str]] = []
        for s in strings:
            split = self.split_added.split(s) if self.split_added else [s]
            parts.append([w for k, x in enumerate(split) for w in ([x] if k % 2 else self.pattern.findall(x))])
        words = list(dict.fromkeys(w for p in parts for w in p if w not in self.added))
        counts, ids = self.merge_all([w.encode() for w in words])
        ends = np.cumsum(counts).tolist()
        flat = ids.tolist()
        own = {w: flat[e - c:e] for w, c, e in zip(words, counts.tolist(), ends)}
        own.update({t: [i] for t, i in self.added.items()})
        self.memo.update((s, [i for w in p for i in own[w]]) for s, p in zip(strings, parts))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(tokens per text, all ids in order) of texts without nulls."""
        plain, starts, codes, distinct = pieces_of(texts)
        bare = [p[1:] if p[0] in "\x01\x02" else p if p[0] == "\n" else " " + p for p in distinct]
        odd = np.flatnonzero(~plain)
        own = texts.take(pa.array(odd)).to_pylist()
        new = list(dict.fromkeys(s for s in [*bare, *own] if s not in self.memo))
        if len(self.memo) + len(new) > MEMO:
            self.clear()
            new = list(dict.fromkeys([*bare, *own]))
        if new:
            self.learn(new)
        table = [self.memo[s] for s in bare] + [self.memo[s] for s in own]
        size = np.fromiter(map(len, table), np.int64, len(table))
        flat = np.array([i for x in table for i in x], np.int32)
        first = np.cumsum(size) - size
        # Every row's units: its pieces, or itself.
        units = np.ones(len(texts), np.int64)
        units[plain] = np.diff(starts)
        unit = np.empty(int(units.sum()), np.int64)
        unit[np.repeat(plain, units)] = codes
        unit[np.repeat(~plain, units)] = len(bare) + np.arange(len(odd))
        total = np.concatenate([[0], np.cumsum(size[unit])])
        ends = np.cumsum(units)
        return total[ends] - total[ends - units], flat[ragged_positions(first[unit], size[unit])]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.bytes[ragged_positions(self.byte_start[ids], self.byte_length[ids])].tobytes()


def codec(path: str) -> PairIndexBpe:
    cache = worker_cache("bpe")
    if ("bpe", path) not in cache:
        cache["bpe", path] = PairIndexBpe(path)
    return cache["bpe", path]


def bpe_round_trip(docs: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """Encode and decode every text: doc_id, n_tokens, ids_sha256 and
    decoded_sha256 (``with_ids``: and ids, decoded)."""
    def run(batches):
        bpe = codec(tokenizer)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for a, b in text_slices(texts, 12_000_000):
                counts, ids = bpe.encode(texts[a:b])
                ends = np.cumsum(counts)
                shown, raw, out_ids, out_text = [], [], [], []
                for x, n in zip((ends - counts).tolist(), counts.tolist()):
                    own = ids[x:x + n]
                    text = bpe.decode(own).decode("utf-8", "replace")
                    raw.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                    shown.append(hashlib.sha256(text.encode()).hexdigest())
                    if with_ids:
                        out_ids.append(own.tolist())
                        out_text.append(text)
                cols = [batch.column(0)[a:b], pa.array(counts), pa.array(raw, pa.string()), pa.array(shown, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols += [pa.array(out_ids, pa.list_(pa.int32())), pa.array(out_text, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, schema + (", ids array<int>, decoded string" if with_ids else ""))
