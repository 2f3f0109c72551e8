"""Packing, BPE and token files against the tokenizers library."""

import collections
import heapq
import itertools

import numpy as np
import pyarrow as pa
import pytest
from plain import ids_crc, ids_sha, sha
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wayfare.llm import bpe, packing, queries, tokenfile
from wayfare.llm.tokens import PieceEncoder

SF = "/root/testdata/sf0.001"
TEXTS = [None, "", " a", "a  b", "a\n\nb c", "x\ty", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "a b",
         "it's 's ''s I'll\nwe'd", "\n", "日本 語", "a\x1fb c", "a\r\nb", "foo <|endo", "😀 x\n<|endoftext|>", "a, b. c.. d, 's, x\ny.",
         "12, 3. 4,\n5", "é, ñ. ß", "x² , y", "ª, º. b", " , .", "ǅ, ʰ. x", "a .b ,c", "aaaaaaaaa bbbbbbb", "ab" * 9000, "\x00\x01", "�​ "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.tokenizer_file())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def table(spark, extra=()):
    rows = [*enumerate(TEXTS), (None, "null id"), (3, "a  b"), (3, "again"), *extra]
    return spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", F.lit(1).alias("Text"), F.lit(2).alias("rank"), F.lit(3).alias("ids"))


@pytest.mark.parametrize("memo", [800_000, 3])
def test_pieces_give_the_librarys_ids(library, memo):
    enc = PieceEncoder(queries.tokenizer_file(), memo)
    texts = [t or "" for t in TEXTS] * 2
    counts, ids = enc.encode(pa.array(texts))
    ends = np.cumsum(counts)
    for k, t in enumerate(texts):
        assert ids[ends[k] - counts[k]:ends[k]].tolist() == ids_of(library, t), t


def test_bpe_encodes_and_decodes_as_the_library_does(spark, library):
    got = bpe.bpe_round_trip(table(spark), queries.tokenizer_file(), with_ids=True).collect()
    want = collections.Counter()
    rows = [*enumerate(TEXTS), (None, "null id"), (3, "a  b"), (3, "again")]
    for doc_id, text in rows:
        ids = ids_of(library, text)
        want[doc_id, len(ids), ids_sha(ids), sha(library.decode(ids, skip_special_tokens=False).encode())] += 1
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
    assert all(r["decoded"] == (t or "") for r in got for t in [dict(enumerate(TEXTS)).get(r["doc_id"])]
               if r["doc_id"] not in (3, None))
    assert bpe.bpe_round_trip(table(spark).limit(0), queries.tokenizer_file()).count() == 0


def check_packing(rows, ids, capacity):
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    for doc_id, own in pieces.items():
        at = 0
        for k, r in enumerate(sorted(own, key=lambda r: r["piece"])):
            assert r["piece"] == k and r["start"] == at and r["ids_crc32"] == ids_crc(ids[doc_id][at:at + r["length"]])
            assert k == 0 or r["length"] == capacity
            at += r["length"]
        assert at == len(ids[doc_id])
    return len(sequences)


def test_packing_of_odd_texts(spark, library):
    rows = [*enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("Length"), F.lit(2).alias("rank"))
    ids = {k: ids_of(library, t) + [0] for k, t in rows}
    for capacity in (16, 2048):
        n = check_packing(packing.pack(docs.repartition(3), queries.tokenizer_file(), capacity).collect(), ids, capacity)
        assert n <= -(-sum(map(len, ids.values())) // capacity) + 2
    with_ids = packing.pack(docs, queries.tokenizer_file(), 64, with_ids=True).collect()
    assert all(r["ids"] == ids[r["doc_id"]][r["start"]:r["start"] + r["length"]] for r in with_ids)
    assert packing.pack(docs.limit(0), queries.tokenizer_file()).count() == 0


def test_packing_of_one_size_and_repeated_rows(spark):
    docs = spark.createDataFrame([(k % 50, "word " * 10 + "end") for k in range(600)], "doc_id long, text string")
    rows = packing.pack(docs.repartition(7), queries.tokenizer_file(), 50).collect()
    per = rows[0]["length"]
    assert len(rows) == 600 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 600
    assert len({r["sequence_id"] for r in rows}) == -(-600 // (50 // per))


def test_sweeps_are_near_the_lower_bound():
    rng = np.random.default_rng(9)
    for sizes in (rng.integers(1, 100, 3000), rng.integers(30, 60, 500), np.full(77, 34), np.array([99] * 5 + [1] * 5)):
        counts = dict(zip(*np.unique(sizes, return_counts=True)))
        plan = packing.sweep_plan({int(s): int(n) for s, n in counts.items()}, 100)
        used = max(first + min(counts[s], 10 ** 9) for s, _, first, _ in plan)
        ends = collections.defaultdict(list)
        by = collections.defaultdict(list)
        for s, rank, first, offset in plan:
            by[s].append((rank, first, offset))
        for s, parts in by.items():
            parts.sort()
            for (rank, first, offset), nxt in zip(parts, [*(p[0] for p in parts[1:]), counts[s]]):
                for k in range(nxt - rank):
                    ends[first + k].append((offset, s))
        for own in ends.values():
            own.sort()
            assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(n for _, n in own) <= 100
        assert sum(map(len, ends.values())) == len(sizes) and used >= len(ends)
        first_fit = []
        for s in sorted(sizes, reverse=True):
            k = next((k for k, gap in enumerate(first_fit) if gap >= s), None)
            if k is None:
                first_fit.append(100 - s)
            else:
                first_fit[k] -= s
        assert len(ends) <= len(first_fit) + 1


def test_op7_on_the_test_table(spark, library):
    ids = {r["doc_id"]: ids_of(library, r["text"]) + [0] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    n = check_packing(queries.op7_best_fit_packing(spark, SF).collect(), ids, 2048)
    assert n <= 1.02 * sum(map(len, ids.values())) / 2048 + 1


# ------------------------------------------------------------------- files

def test_code_lengths_are_best_and_limited():
    rng = np.random.default_rng(10)
    for counts in (np.array([1, 1]), np.array([5]), rng.integers(1, 1000, 300), 2 ** np.arange(30), rng.zipf(1.3, 4000) % 10 ** 9 + 1):
        length = tokenfile.code_lengths(counts)
        assert length.max() <= 16 and (2.0 ** -length).sum() <= 1
        heap = [(int(c), 0) for c in counts]
        heapq.heapify(heap)
        cost = 0
        while len(heap) > 1:
            a, b = heapq.heappop(heap)[0], heapq.heappop(heap)[0]
            cost += a + b
            heapq.heappush(heap, (a + b, 0))
        if len(counts) > 1 and len(counts) != 30:
            assert cost <= (length * counts).sum() <= cost * 1.03 + 16
    # Against all code lengths.
    for limit in (3, 4):
        for counts in ([1, 1, 1, 1, 9], [1, 2, 4, 8, 16, 32], [7, 1, 1], [1, 1, 2, 3, 5, 8, 13][:2 ** limit - 1]):
            best = min(sum(a * b for a, b in zip(counts, own)) for own in itertools.product(range(1, limit + 1), repeat=len(counts))
                       if sum(2.0 ** -x for x in own) <= 1)
            assert (tokenfile.code_lengths(np.array(counts), limit) * counts).sum() == best
    with pytest.raises(ValueError):
        tokenfile.code_lengths(np.ones(5), limit=2)


@pytest.mark.parametrize("n", [1, 255, 256, 257, 5000])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    ids = rng.zipf(1.4, n) % 3000
    known, counts = np.unique(ids, return_counts=True)
    coder = tokenfile.Coder(known, tokenfile.code_lengths(counts))
    stream, blocks = coder.encode(ids)
    assert (coder.decode(stream, blocks, n) == ids).all() and len(blocks) == -(-n // 256)
    # Any block alone, from its bit offset.
    k = len(blocks) - 1
    assert (coder.decode(stream, blocks[k:], n - 256 * k) == ids[256 * k:]).all()


def test_token_files_round_trip(spark, library, tmp_path):
    rows = [*enumerate(TEXTS), (None, "null id"), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("PART"), F.lit(2).alias("seq"))
    path = str(tmp_path / "tokens")
    tokenfile.write_token_files(docs.repartition(4), queries.tokenizer_file(), path, segment_ids=40)
    got = tokenfile.read_token_files(spark, path, with_ids=True).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 0, 1, 2, 3, 3, *range(4, len(TEXTS))]
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == ids_crc(r["ids"])
        at += r["n_tokens"]
    assert collections.Counter((r["doc_id"], tuple(r["ids"])) for r in got) == collections.Counter(
        (k, tuple(ids_of(library, t) + [0])) for k, t in rows)
    assert tokenfile.token_files(docs.limit(0), queries.tokenizer_file()).count() == 0


def test_op8_and_op9_on_the_test_table(spark, library):
    ids = {r["doc_id"]: ids_of(library, r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op8_bpe_pair_index(spark, SF).collect():
        assert r["n_tokens"] == len(ids[r["doc_id"]]) and r["ids_sha256"] == ids_sha(ids[r["doc_id"]])
    at = 0
    for r in sorted(queries.op9_huffman_token_files(spark, SF).collect(), key=lambda r: r["doc_id"]):
        own = ids[r["doc_id"]] + [0]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(own), ids_crc(own))
        at += len(own)
