"""Benchmark decontamination by Wu-Manber multi-pattern search.

A benchmark item's windows of ``size`` consecutive words (an item of fewer words
is one window) are the patterns, the documents' words the text (``canonical``).

* Patterns of about equal length share a searcher. Its *shift table* has, for a
  hash of the last bytes under the search window, how far the window may move
  without passing a pattern; most places are never looked at.
* Where the shift is zero, the hash of the window's suffix selects a *bucket* of
  test strings, and direct comparison of all their bytes confirms each one.
* Many stretches of the text advance side by side (numpy).

The search is a map over the documents: no shuffle, and a hot passage costs a
task nothing but its own documents. The benchmark is searched in blocks of at
most ``block_bytes`` of words, dealt by a hash of pieces of items (a long item
is cut into overlapping pieces), so what a task holds does not grow with the
benchmark. With several blocks each is one pass over the documents; hits meet
by document, one row per document and task at most.

Defined results: a null text has no words; rows of ``docs`` keep their own
results, equal for equal rows; rows of the benchmark with one ``item_id`` are
one item, a null id is the empty string; an item without words is never found;
empty tables give no rows or no hits; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .canonical import canonical_words
from .kernels import materialise, mix64, pick, ragged_positions, release, ship, text_slices, worker_cache

ship(__name__)

RESULT = ("doc_id long, n_words long, n_hit long, items array<string>, "
          "spans array<struct<first: long, last: long>>")
#: Pattern lengths at which a new searcher begins.
LENGTHS = [2, 4, 8, 16, 32, 64, 128]
#: Bytes of a block of the shift table.
BLOCK = 6
LANE = 512


def eight_bytes(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as a number (a view, not a copy)."""
    return np.ndarray((len(text) - 7,), "<u8", text.data, 0, (1,))


def low_bytes(x: np.ndarray, n: int) -> np.ndarray:
    return x & np.uint64((1 << 8 * n) - 1) if n < 8 else x


class Patterns:
    """Patterns of one length class: places in ``text`` (padded by 8 bytes)."""

    def __init__(self, text: np.ndarray, start: np.ndarray, length: np.ndarray, number: np.ndarray):
        self.text, self.eight = text, eight_bytes(text)
        self.window = m = int(length.min())
        self.block = b = min(BLOCK, m)
        blocks = min(len(start) * (m - b + 1), len(text))
        self.bits = int(np.clip(np.ceil(np.log2(16 * blocks)), 12, 24))
        self.shift = np.full(1 << self.bits, min(m - b + 1, 255), np.uint8)
        # From the first block of the window to the last: the least shift stays.
        for k in range(m - b + 1):
            at = self.hashed(low_bytes(self.eight[start + k], b))
            self.shift[at] = np.minimum(self.shift[at], min(m - b - k, 255))
        key = self.suffix(self.eight, start)
        by = np.argsort(key, kind="stable")
        self.start, self.length, self.number = start[by], length[by], number[by]
        self.key, first = np.unique(key[by], return_index=True)
        self.first = np.append(first, len(by))

    def hashed(self, x: np.ndarray) -> np.ndarray:
        return (mix64(x) >> np.uint64(64 - self.bits)).astype(np.int64)

    def suffix(self, eight: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Hash of the last (up to 16) bytes of the search window from ``at`` on."""
        m = self.window
        h = mix64(low_bytes(eight[at + max(m - 8, 0)], min(m, 8)) + np.uint64(1))
        return mix64(h ^ eight[at + m - 16]) if m >= 16 else h

    def places(self, eight: np.ndarray, end: int) -> np.ndarray:
        """Places of zero shift: all stretches of the text step together."""
        m, b = self.window, self.block
        stop = end - m + 1
        at = np.arange(0, max(stop, 0), LANE)
        until = np.minimum(at + LANE, stop)
        found = [np.zeros(0, np.int64)]
        while len(at):
            move = self.shift[self.hashed(low_bytes(eight[at + (m - b)], b))]
            found.append(at[move == 0])
            at = at + np.maximum(move, 1)
            more = at < until
            at, until = at[more], until[more]
        return np.concatenate(found)

    def search(self, text: np.ndarray, end: int, chunk: int = 50_000):
        """(places, pattern numbers) of all occurrences in ``text[:end]``, chunk by chunk."""
        eight = eight_bytes(text)
        at = self.places(eight, end)
        bucket = np.searchsorted(self.key, key := self.suffix(eight, at))
        bucket = np.minimum(bucket, len(self.key) - 1)
        some = self.key[bucket] == key
        at, bucket = at[some], bucket[some]
        size = np.diff(self.first)[bucket]
        ends = np.cumsum(size)
        a = 0
        while a < len(at):
            done = ends[a - 1] if a else 0
            z = max(a + 1, int(np.searchsorted(ends, done + chunk, side="right")))
            place = np.repeat(at[a:z], size[a:z])
            which = ragged_positions(self.first[:-1][bucket[a:z]], size[a:z])
            length, start = self.length[which], self.start[which]
            # The place after the last word is a space as well.
            ok = place + length < end
            ok[ok] = (text[place[ok] + length[ok]] == 32) & (low_bytes(eight[place[ok]], min(self.window, 8))
                                                             == low_bytes(self.eight[start[ok]], min(self.window, 8)))
            place, which, length, start = place[ok], which[ok], length[ok], start[ok]
            if len(place):
                same = text[ragged_positions(place, length)] == self.text[ragged_positions(start, length)]
                whole = np.logical_and.reduceat(same, np.cumsum(length) - length)
                yield place[whole], self.number[which[whole]]
            a = z


class Searcher:
    """All windows of a block of the benchmark, and the items that hold each."""

    def __init__(self, items: list[str], words: list[str], size: int):
        text, spaces, offsets = canonical_words(pa.array(words, pa.string()))
        count = np.diff(offsets)
        windows = np.maximum(count - size + 1, (count > 0).astype(np.int64))
        first = ragged_positions(offsets[:-1], windows)
        item = np.repeat(np.arange(len(items)), windows)
        n = np.minimum(size, np.repeat(count, windows))
        text = np.concatenate([text, np.zeros(8, np.uint8)])
        start, length = spaces[first], spaces[first + n] - spaces[first]
        # Equal windows are one pattern: compare them as rows of word numbers.
        number = self.word_numbers(text, spaces)
        lane = np.arange(size)
        row = np.where(lane < n[:, None], number[np.minimum(first[:, None] + lane, max(len(number) - 1, 0))], -1) \
            if len(first) else np.zeros((0, size), np.int32)
        row = np.ascontiguousarray(row.astype(np.int32))
        _, one, same = np.unique(row.view(f"V{4 * size}").ravel(), return_index=True, return_inverse=True)
        self.words = n[one]
        # The distinct items of each pattern, patterns with equal lists sharing one.
        names, code = np.unique(np.array(items, object), return_inverse=True) if items else (np.zeros(0, object), np.zeros(0, int))
        pair = np.unique(np.stack([same, code[item]], 1), axis=0) if len(same) else np.zeros((0, 2), np.int64)
        self.names = names
        cuts = np.searchsorted(pair[:, 0], np.arange(len(one) + 1))
        lists, self.set_of = {}, np.zeros(len(one), np.int64)
        for k in range(len(one)):
            self.set_of[k] = lists.setdefault(pair[cuts[k]:cuts[k + 1], 1].tobytes(), len(lists))
        sets = [np.frombuffer(x, pair.dtype) for x in lists]
        self.set_size = np.array([len(x) for x in sets], np.int64)
        self.set_start = np.cumsum(self.set_size) - self.set_size
        self.members = np.concatenate([np.zeros(0, np.int64), *sets]).astype(np.int64)
        kind = np.searchsorted(LENGTHS, length[one], side="right")
        self.groups = [Patterns(text, start[one[kind == k]], length[one[kind == k]], np.flatnonzero(kind == k))
                       for k in np.unique(kind)]

    @staticmethod
    def word_numbers(text: np.ndarray, spaces: np.ndarray) -> np.ndarray:
        words = text[:-8].tobytes().decode().split()
        seen: dict[str, int] = {}
        return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int32, len(spaces) - 1)

    def search(self, text: np.ndarray, spaces: np.ndarray, offsets: np.ndarray):
        """(per word: inside an occurrence; text and item numbers of all pairs found)."""
        n = len(spaces) - 1
        step = np.zeros(n + 1, np.int32)
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        pairs = np.zeros((0, 2), np.int64)
        padded = np.concatenate([text, np.zeros(8, np.uint8)])
        for group in self.groups:
            for place, pattern in group.search(padded, len(text)):
                first = np.searchsorted(spaces, place)
                last = first + self.words[pattern] - 1
                own = owner[first] == owner[last]
                first, last, pattern = first[own], last[own], pattern[own]
                np.add.at(step, first, 1)
                np.add.at(step, last + 1, -1)
                pairs = np.unique(np.concatenate([pairs, np.stack([owner[first], self.set_of[pattern]], 1)]), axis=0)
        hit = np.cumsum(step[:-1]) > 0
        size = self.set_size[pairs[:, 1]]
        member = self.members[ragged_positions(self.set_start[pairs[:, 1]], size)]
        found = np.stack([np.repeat(pairs[:, 0], size), member], 1)
        return hit, np.unique(found, axis=0) if len(found) else found


def runs_of(hit: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last word) of the maximal runs of hit words, cut at the texts' ends."""
    edge = np.zeros(len(hit) + 1, bool)
    edge[offsets] = True
    begin = hit & (np.concatenate([[True], ~hit[:-1]]) | edge[:-1])
    end = hit & (np.concatenate([~hit[1:], [True]]) | edge[1:])
    return np.flatnonzero(begin), np.flatnonzero(end)


def search_texts(searcher: Searcher, texts: pa.Array):
    """(words, hit words, items, spans) of each text, as Arrow arrays."""
    text, spaces, offsets = canonical_words(texts)
    hit, found = searcher.search(text, spaces, offsets)
    total = np.concatenate([[0], np.cumsum(hit)])
    cuts = np.searchsorted(found[:, 0], np.arange(len(texts) + 1))
    items = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(searcher.names[found[:, 1]].tolist(), pa.string()))
    first, last = runs_of(hit, offsets)
    at = np.searchsorted(first, offsets)
    base = np.repeat(offsets[:-1], np.diff(at))
    spans = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(first - base), pa.array(last - base)], ["first", "last"]))
    return pa.array(np.diff(offsets)), pa.array(total[offsets[1:]] - total[offsets[:-1]]), items, spans


# --------------------------------------------------------------- benchmark

def item_pieces(benchmark: DataFrame, size: int, piece: int) -> DataFrame:
    """(item_id, words, n) of the distinct items, cut into pieces of at most
    ``piece`` words that overlap by ``size - 1``."""
    def run(batches):
        for batch in batches:
            ids, words = [], []
            for a, b in text_slices(batch.column(1)):
                text, spaces, offsets = canonical_words(batch.column(1)[a:b])
                flat = text.tobytes()
                for k, name in enumerate(batch.column(0)[a:b].to_pylist()):
                    x, z = int(offsets[k]), int(offsets[k + 1])
                    for i in range(x, max(z - size + 1, min(z, x + 1)), piece - size + 1):
                        ids.append(name)
                        words.append(flat[spaces[i]:spaces[min(z, i + piece)]].decode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(words, pa.string())], ["item_id", "words"])
    items = pick(benchmark, "item_id", "text").select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                                                      F.col("text").cast("string").alias("text"))
    return items.distinct().mapInArrow(run, "item_id string, words string")


def benchmark_blocks(benchmark: DataFrame, size: int, piece: int, block_bytes: int) -> tuple[DataFrame, int]:
    """The pieces with a block number, and the number of blocks."""
    pieces = materialise(item_pieces(benchmark, size, piece).distinct(), "benchmark")
    n = F.octet_length("words")
    total = pieces.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    while True:
        dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)))
        # Hashing is uneven: more blocks until the fullest is within the bound (and one piece's).
        most = dealt.groupBy("block").agg(F.sum(n).alias("n"), F.max(n).alias("one")).agg(
            F.max(F.col("n") - F.col("one"))).first()[0]
        if blocks == 1 or (most or 0) <= block_bytes:
            return dealt, blocks
        blocks *= 2


def searcher_of(rows: list[tuple[str, str]], size: int, key: tuple) -> Searcher:
    """This worker's searcher of a block: one at a time is kept."""
    cache = worker_cache("decontam")
    if cache.get("searcher", (None,))[0] != key:
        cache.pop("searcher", None)
        cache["searcher"] = (key, Searcher([r[0] for r in rows], [r[1] for r in rows], size))
    return cache["searcher"][1]


# --------------------------------------------------------------- documents

def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10, block_bytes: int = 4_000_000,
                 piece: int = 4096) -> DataFrame:
    """Per document: its words, the words inside an occurrence of a benchmark
    window, the items found (sorted) and the runs of hit words (``spans``)."""
    import uuid
    docs = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    dealt, blocks = benchmark_blocks(benchmark, size, piece, block_bytes)
    tag = uuid.uuid4().hex

    def block_rows(k: int) -> list[tuple[str, str]]:
        # At most ``block_bytes`` and a piece.
        return [tuple(r) for r in dealt.where(F.col("block") == k).select("item_id", "words").collect()]

    if blocks == 1:
        rows = block_rows(0)

        def direct(batches):
            searcher = searcher_of(rows, size, (tag, 0))
            for batch in batches:
                for a, b in text_slices(batch.column(1), 4_000_000):
                    yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], *search_texts(searcher, batch.column(1)[a:b])],
                                                     ["doc_id", "n_words", "n_hit", "items", "spans"])
        return docs.mapInArrow(direct, RESULT)
    parts = [materialise(hits_of_block(docs, block_rows(k), size, (tag, k)), "hits") for k in range(blocks)]
    return merge_blocks(docs, parts)


KEY = "doc_id long, h binary"


def text_keys(texts: pa.Array) -> pa.Array:
    import xxhash
    return pa.array([xxhash.xxh3_128_digest(t or b"") for t in texts.cast(pa.binary()).to_pylist()], pa.binary())


def hits_of_block(docs: DataFrame, rows: list[tuple[str, str]], size: int, key: tuple) -> DataFrame:
    """Documents with hits in one block, rows with equal id and text once a task."""
    def run(batches):
        searcher, seen = searcher_of(rows, size, key), set()
        for batch in batches:
            for a, b in text_slices(batch.column(1), 4_000_000):
                n, n_hit, items, spans = search_texts(searcher, batch.column(1)[a:b])
                some = np.flatnonzero(np.asarray(n_hit))
                ids, keys = batch.column(0)[a:b].take(pa.array(some)), text_keys(batch.column(1)[a:b].take(pa.array(some)))
                new = []
                for k, pair in enumerate(zip(ids.to_pylist(), keys.to_pylist())):
                    if pair not in seen:
                        seen.add(pair)
                        new.append(k)
                at, new = pa.array(some[new]), pa.array(new, pa.int64())
                yield pa.RecordBatch.from_arrays([ids.take(new), keys.take(new), items.take(at), spans.take(at)],
                                                 ["doc_id", "h", "items", "spans"])
    return docs.mapInArrow(run, f"{KEY}, items array<string>, spans array<struct<first: long, last: long>>")


def merge_blocks(docs: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """Hits of all blocks by document."""
    hits = parts[0]
    for p in parts[1:]:
        hits = hits.unionByName(p)

    def count(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(1), 4_000_000):
                offsets = canonical_words(batch.column(1)[a:b])[2]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], text_keys(batch.column(1)[a:b]),
                                                  pa.array(np.diff(offsets))], ["doc_id", "h", "n_words"])

    def merge(table: pa.Table) -> pa.Table:
        spans = table["spans"].combine_chunks().flatten()
        first, last = (np.asarray(spans.field(k)) for k in (0, 1))
        by = np.lexsort((last, first))
        first, top = first[by], np.maximum.accumulate(last[by])
        # Spans that touch are one run of hit words.
        cut = np.flatnonzero(np.concatenate([[True], first[1:] > top[:-1] + 1]))
        first, last = first[cut], top[np.append(cut[1:], len(top)) - 1]
        items = sorted(set(table["items"].combine_chunks().flatten().to_pylist()))
        runs = [{"first": int(x), "last": int(y)} for x, y in zip(first, last)]
        release()
        return pa.table({"doc_id": table["doc_id"][:1], "h": table["h"][:1], "n_hit": pa.array([int((last - first + 1).sum())]),
                         "items": pa.array([items], pa.list_(pa.string())), "spans": pa.array([runs], pa.list_(
                             pa.struct([("first", pa.int64()), ("last", pa.int64())])))})
    merged = hits.groupBy("doc_id", "h").applyInArrow(
        merge, f"{KEY}, n_hit long, items array<string>, spans array<struct<first: long, last: long>>")
    rows = docs.mapInArrow(count, f"{KEY}, n_words long")
    m = merged.select(F.col("doc_id").alias("m_id"), F.col("h").alias("m_h"), "n_hit", "items", "spans")
    out = rows.join(m, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("h") == F.col("m_h")), "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      F.coalesce("spans", F.array().cast("array<struct<first:bigint,last:bigint>>")).alias("spans"))


def digests(found: DataFrame) -> DataFrame:
    """The operator's rows as counts and a digest of the items."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
