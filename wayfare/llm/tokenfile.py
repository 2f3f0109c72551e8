"""Token ids in compressed files: canonical length-limited Huffman coding.

A data set is a folder of two Parquet tables. ``codes`` has the code length of
each id that occurs, at most 16 bits, from the counts over all documents
(package-merge); the codes themselves follow from the lengths. ``segments`` has
rows of whole documents in ascending doc_id order: their ids and lengths, the
bit stream, and the bit offset of every block of 256 ids, so that all blocks
decode at the same time through one table of 2**16 entries.

Defined results: a null text is empty (the end id alone); documents with equal
ids keep an order by a hash of the text; null ids come first; more distinct
ids than 16-bit codes can tell apart (65,536) are an error; empty tables give no rows;
other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .kernels import null_first, partitions, pick, shared_folder, ship
from .tokens import encode_slices, vocabulary_size

ship(__name__)

LIMIT = 16
BLOCK = 256


# ------------------------------------------------------------------- codes

def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Best code lengths of at most ``limit`` bits for positive counts (package-merge)."""
    n = len(counts)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need more than {limit} bits")
    if n < 2:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    weight = counts[order].astype(np.float64)
    # Each level's list: the single symbols merged with the pairs of the level below.
    rows, pairs = [], np.zeros(0)
    for _ in range(limit):
        merged = np.concatenate([weight, pairs])
        by = np.argsort(merged, kind="stable")
        rows.append(by < n)
        merged = merged[by]
        pairs = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(1)
    length, take = np.zeros(n, np.int64), 2 * n - 2
    for single in reversed(rows):
        symbols = int(single[:take].sum())
        length[:symbols] += 1
        take = 2 * (take - symbols)
    out = np.empty(n, np.int64)
    out[order] = length
    return out


def canonical_codes(ids: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, lengths, codes) by (length, id)."""
    by = np.lexsort((ids, length))
    ids, length = ids[by], length[by]
    step = np.left_shift(1, LIMIT - length)
    return ids, length, (np.cumsum(step) - step) >> (LIMIT - length)


class Coder:
    """Encodes and decodes with the lengths of the ids that occur."""

    def __init__(self, ids: np.ndarray, length: np.ndarray):
        ids, length, codes = canonical_codes(ids, length)
        self.code = np.zeros(int(ids.max(initial=0)) + 1, np.uint16)
        self.size = np.zeros(len(self.code), np.int64)
        self.code[ids] = codes << (LIMIT - length)
        self.size[ids] = length
        fill = np.left_shift(1, LIMIT - length)
        self.symbol = np.zeros(1 << LIMIT, np.int32)
        self.bits = np.ones(1 << LIMIT, np.int64)
        self.symbol[:fill.sum()] = np.repeat(ids, fill)
        self.bits[:fill.sum()] = np.repeat(length, fill)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(bit stream, bit offset of every block)."""
        size = self.size[ids]
        ends = np.cumsum(size)
        at = ends - size
        blocks = at[::BLOCK]
        total = int(ends[-1]) if len(ids) else 0
        words = np.zeros(total // 32 + 2, np.uint64)
        # Each code in its place of 64 bits from the 32-bit word it begins in; as a
        # code has at most 16 bits, one begins in every word.
        for k in range(0, len(ids), 1 << 18):
            own = slice(k, k + (1 << 18))
            word = at[own] >> 5
            placed = self.code[ids[own]].astype(np.uint64) << (48 - (at[own] & 31)).astype(np.uint64)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            both = np.add.reduceat(placed, first)
            words[word[first]] |= both >> np.uint64(32)
            words[word[first] + 1] |= both & np.uint64(0xFFFFFFFF)
        return words.astype(">u4").tobytes()[:-(-total // 8)], blocks

    def decode(self, stream: bytes, blocks: np.ndarray, total: int) -> np.ndarray:
        """All blocks step by step together."""
        data = np.frombuffer(stream + b"\0\0\0", np.uint8).astype(np.uint32)
        # The 24 bits from each byte on: any 16-bit window lies in one of them.
        wide = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
        out = np.zeros((len(blocks), BLOCK), np.int32)
        at = blocks.astype(np.int64)
        last = total - (len(blocks) - 1) * BLOCK
        for k in range(BLOCK):
            if k == last:
                at = at[:-1]
            if not len(at):
                break
            window = (wide[at >> 3] >> (8 - (at & 7)).astype(np.uint32)) & 0xFFFF
            out[:len(at), k] = self.symbol[window]
            at = at + self.bits[window]
        return out.ravel()[:total]


# ------------------------------------------------------------------- tables

def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0,
                      segment_ids: int = 1 << 18) -> None:
    """Tokenize all documents and write the data set to ``path``."""
    spark = docs.sparkSession
    cell = np.dtype("<u2" if max(vocabulary_size(tokenizer), end_id + 1) <= 1 << 16 else "<u4")

    def tokenize(batches):
        seen = np.zeros(0, np.int64)
        for batch in batches:
            for a, b, counts, ids in encode_slices(batch.column(2), tokenizer, end_id):
                own = np.bincount(ids)
                seen = np.pad(seen, (0, max(0, len(own) - len(seen))))
                seen[:len(own)] += own
                ends = np.concatenate([[0], np.cumsum(counts)]) * cell.itemsize
                flat = pa.Array.from_buffers(pa.binary(), len(counts), [
                    None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids.astype(cell))])
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], batch.column(1)[a:b], pa.array(counts), flat], RAW_NAMES)
        some = np.flatnonzero(seen)
        both = np.stack([some, seen[some]]).astype("<i8").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([-1]),
                                          pa.array([both], pa.binary())], RAW_NAMES)

    raw = f"{shared_folder(spark)}/llm-ids-{uuid.uuid4().hex}"
    text = F.col("text").cast("string")
    (pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("tie"), text.alias("text"))
         .mapInArrow(tokenize, RAW).write.option("compression", "zstd").parquet(raw))
    table = spark.read.schema(RAW).parquet(raw)

    def count(batches):
        for batch in batches:
            both = np.concatenate([np.zeros((2, 0), np.int64), *(np.frombuffer(x, "<i8").reshape(2, -1)
                                                                for x in batch.column(0).to_pylist())], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["id", "n"])
    # The rows with n_ids -1 have a task's ids and counts: at most the vocabulary each.
    totals = (table.where("n_ids = -1").select("ids").mapInArrow(count, "id long, n long")
                   .groupBy("id").agg(F.sum("n").alias("n")).toPandas())
    ids = totals["id"].to_numpy(np.int64)
    length = code_lengths(totals["n"].to_numpy(np.int64))
    spark.createDataFrame([(int(i), int(n)) for i, n in zip(ids, length)], "id int, length int").coalesce(1) \
         .write.mode("overwrite").parquet(f"{path}/codes")
    coder = Coder(ids, length)

    def compress(batches):
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids, counts, held, n = [], [], [], 0
        for batch in batches:
            for doc, size, own in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                doc_ids.append(doc)
                counts.append(size)
                held.append(own)
                n += size
                # Segments of whole documents, closed when they have enough ids.
                if n >= segment_ids:
                    yield segment(part, seq, doc_ids, counts, *coder.encode(np.frombuffer(b"".join(held), cell)))
                    doc_ids, counts, held, n, seq = [], [], [], 0, seq + 1
        if doc_ids:
            yield segment(part, seq, doc_ids, counts, *coder.encode(np.frombuffer(b"".join(held), cell)))

    key = [null_first(F.col("doc_id")), F.col("tie")]
    (table.where("n_ids >= 0").repartitionByRange(partitions(spark), *key).sortWithinPartitions(*key)
          .mapInArrow(compress, SEGMENT).write.mode("overwrite").option("compression", "none").parquet(f"{path}/segments"))


RAW = "doc_id long, tie long, n_ids long, ids binary"
RAW_NAMES = ["doc_id", "tie", "n_ids", "ids"]
SEGMENT = "part int, seq long, doc_ids array<long>, counts array<long>, n_ids long, ids binary, blocks binary"
SEGMENT_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                           ("counts", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("ids", pa.binary()),
                           ("blocks", pa.binary())])


def segment(part, seq, doc_ids, counts, stream, blocks) -> pa.RecordBatch:
    values = [part, seq, doc_ids, counts, sum(counts), stream, blocks.astype("<u4").tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, SEGMENT_ARROW)],
                                      schema=SEGMENT_ARROW)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """The documents of a data set: doc_id, start (ids of all before it),
    n_tokens, ids_crc32 (``with_ids``: and ids)."""
    codes = spark.read.parquet(f"{path}/codes").toPandas()
    coder = Coder(codes["id"].to_numpy(np.int64), codes["length"].to_numpy(np.int64))

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = coder.decode(row["ids"], np.frombuffer(row["blocks"], "<u4"), row["n_ids"])
                raw, counts = ids.astype("<u4"), np.array(row["counts"], np.int64)
                ends = np.cumsum(counts)
                first = (ends - counts).tolist()
                crc = [zlib.crc32(raw[x:y]) for x, y in zip(first, ends.tolist())]
                n = len(counts)
                cols = [pa.array([row["part"]] * n, pa.int32()), pa.array([row["seq"]] * n, pa.int64()),
                        pa.array(row["doc_ids"], pa.int64()), pa.array(first, pa.int64()), pa.array(counts),
                        pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array([*first, len(ids)], pa.int32()), pa.array(ids)))
                yield pa.RecordBatch.from_arrays(cols, READ_NAMES + ["ids"] * with_ids)

    segments = spark.read.schema(SEGMENT).parquet(f"{path}/segments")
    sizes = segments.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # As many rows as range partitions; the segments of a partition are counted within it.
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    within = sizes.select("part", "seq", (F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq"))
                                          - F.col("n_ids")).alias("seq_start"))
    rows = segments.mapInArrow(decode, "part int, seq long, doc_id long, first long, n_tokens long, ids_crc32 long"
                               + (", ids array<int>" if with_ids else ""))
    place = within.join(before, "part").select("part", "seq", (F.col("part_start") + F.col("seq_start")).alias("at"))
    return rows.join(place, ["part", "seq"]).select("doc_id", (F.col("at") + F.col("first")).alias("start"),
                                                    "n_tokens", "ids_crc32", *["ids"] * with_ids)


READ_NAMES = ["part", "seq", "doc_id", "first", "n_tokens", "ids_crc32"]


def token_files(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = 0) -> DataFrame:
    """Write the files and read them back."""
    spark = docs.sparkSession
    path = path or f"{shared_folder(spark)}/llm-tokens-{uuid.uuid4().hex}"
    write_token_files(docs, tokenizer, path, end_id)
    return read_token_files(spark, path)
