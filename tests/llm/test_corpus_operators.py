"""Decontamination, importance resampling, filter interaction audit."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from plain import audited, canonical, decontaminated, features, resampled, sha
from pyspark.sql import functions as F

from wayfare.llm import audit, decontam, queries, resample
from wayfare.llm.canonical import canonical_words

SF = "/root/testdata/sf0.001"
ODD_TEXTS = [None, "", " ", "\x00\x01", "A", "É ü x", "a-b_c'd`e{f}g~h", "0/9:Z@[z", "one", "…", "a" * 5000, "\n".join("xyz")]


def prose(rng, n, kinds=40):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


# ------------------------------------------------------------------- words

def test_canonical_words_match_the_pattern():
    rng = random.Random(1)
    texts = ODD_TEXTS + ["".join(rng.choice("aB9 -é\n\x7f") for _ in range(rng.randrange(40))) for _ in range(300)]
    for some in (texts, texts[5:6], []):
        text, spaces, offsets = canonical_words(pa.array(some, pa.string()))
        flat = text.tobytes()
        for k, t in enumerate(some):
            got = [flat[spaces[i] + 1:spaces[i + 1]].decode() for i in range(offsets[k], offsets[k + 1])]
            assert got == canonical(t)


# --------------------------------------------------------- decontamination

def contaminated_tables(rng):
    items = [(k, prose(rng, rng.choice([1, 2, 3, 9, 10, 11, 30]), 400)) for k in range(60)]
    items += [(None, "Null item " * 6), (7, "a second text of item seven, with more than ten words in it"), (100, ""), (101, None),
              (102, "é"), (103, " ".join(f"common{k}" for k in range(25))), (104, " ".join(f"common{k}" for k in range(25))),
              (105, " ".join(f"long{k}" for k in range(300))), (3, "w1"), (106, " ".join("abcdefghij" * 20 + str(k) for k in range(12)))]
    docs = [(None, None), (0, ""), (0, ""), (1, "w1"), (2, "W1!"), (3, " ".join(f"long{k}" for k in range(300))),
            (4, "x " * 3000 + (items[6][1] or "")), (5, " ".join(f"common{k}" for k in range(9))),
            (6, "common0, COMMON1 " + " ".join(f"common{k}" for k in range(2, 24))), (6, "é"), (7, "é é"),
            (8, " ".join("abcdefghij" * 20 + str(k) for k in range(12)))]
    for k in range(120):
        body = prose(rng, rng.randrange(1, 200), 400).split()
        at, words = rng.randrange(len(body) + 1), canonical(rng.choice(items)[1])
        cut = rng.randrange(len(words) + 1)
        docs.append((10 + k, " ".join(body[:at] + words[:max(cut, 10)] + body[at:])))
    return docs + docs[20:30], items


def found(rows):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"]), [tuple(s) for s in r["spans"]]) for r in rows), key=repr)


@pytest.mark.parametrize("parameters", [{}, {"block_bytes": 3000, "piece": 40}, {"size": 4}, {"size": 1}])
def test_decontamination_matches_a_plain_version(spark, parameters):
    docs, items = contaminated_tables(random.Random(2))
    d = spark.createDataFrame(docs, "doc_id long, text string").select("*", F.lit(5).alias("n_hit"), F.lit("x").alias("items"))
    b = spark.createDataFrame(items + items[:3], "item_id long, text string").withColumn("words", F.lit(1))
    got = found(decontam.contaminated(d.repartition(3), b, **parameters).collect())
    assert got == sorted(decontaminated(docs, items, parameters.get("size", 10)), key=repr)
    assert sum(1 for r in got if r[2]) > 50


def test_several_blocks_are_used_and_bounded(spark):
    _, items = contaminated_tables(random.Random(3))
    b = spark.createDataFrame(items, "item_id long, text string")
    dealt, blocks = decontam.benchmark_blocks(b, 10, 40, 3000)
    sizes = [r["n"] for r in dealt.groupBy("block").agg(F.sum(F.octet_length("words")).alias("n")).collect()]
    assert blocks > 2 and max(sizes) <= 3000 + dealt.agg(F.max(F.octet_length("words"))).first()[0]


def test_decontamination_of_empty_tables(spark):
    d, b = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id string, text string")
    r = decontam.digests(decontam.contaminated(d, b)).first()
    assert tuple(r) == (1, 2, 0, 0, sha(b""), False)
    assert decontam.contaminated(d.limit(0), b).count() == 0 == decontam.contaminated(d.limit(0), b, block_bytes=1).count()


def test_occurrences_at_all_offsets_and_hot_suffixes():
    """Windows that share their ends, and a text in which every place is a candidate."""
    words = [" ".join([f"p{k}", *["same"] * 9]) for k in range(300)] + ["same " * 10]
    text = " ".join(["same"] * 400 + ["p7"] + ["same"] * 9 + ["p9"] + ["same"] * 8)
    searcher = decontam.Searcher([str(k) for k in range(301)], words, 10)
    got = decontam.search_texts(searcher, pa.array([text, "x", None, text + " same"]))
    assert got[2].to_pylist() == [["300", "7"], [], [], ["300", "7", "9"]]
    assert got[1].to_pylist() == [410, 0, 0, 420]


def test_op11_on_the_test_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = sorted((d, n, h, len(i), sha(",".join(i).encode()), h > 0) for d, n, h, i, _ in decontaminated(docs, items))
    assert sorted(map(tuple, queries.op11_wu_manber_decontamination(spark, SF).collect())) == want


# -------------------------------------------------------------- resampling

def test_crc_of_any_range_from_two_prefixes():
    rng = np.random.default_rng(4)
    raw = rng.integers(0, 256, 6000).astype(np.uint8)
    crc = resample.RunningCrc(raw)
    start = rng.integers(0, 6000, 3000)
    end = np.minimum(start + rng.integers(0, 4000, 3000) ** 2 // 4000, 6000)
    assert crc.of(start, end).tolist() == [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(start, end)]
    assert resample.RunningCrc(raw[:0]).of(np.zeros(1, int), np.zeros(1, int)).tolist() == [0]


@pytest.mark.parametrize("width", [1, 3])
def test_feature_buckets(width):
    rng = random.Random(5)
    texts = ODD_TEXTS + [prose(rng, n) for n in (1, 2, 3, 50, 2000)]
    words, count, got = resample.feature_buckets(pa.array(texts), width, 97)
    ends = np.cumsum(count)
    for t, n, a, z in zip(texts, words, ends - count, ends):
        assert sorted(got[a:z].tolist()) == sorted(features(t, width, 97)) and n == len(canonical(t))


@pytest.mark.parametrize("parameters", [{}, {"width": 2, "buckets": 70_001, "percent": 50, "min_words": 3, "seed": 9}, {"percent": 100}])
def test_resampling_matches_a_plain_version(spark, parameters):
    rng = random.Random(6)
    docs = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(100 + k, prose(rng, rng.randrange(10, 60))) for k in range(150)]
    docs += [(None, prose(rng, 30))] + [(500, docs[60][1])] * 12
    target = [prose(rng, 40, 12) for _ in range(5)] + [None, ""]
    d = spark.createDataFrame(docs, "doc_id long, text string").select("*", F.lit(1).alias("rank"), F.lit(2).alias("_part"))
    t = spark.createDataFrame([(x,) for x in target], "text string")
    full = {"percent": 10, "min_words": 20, "width": 1, "buckets": 10_000, "seed": 2024} | parameters
    got = resample.resample(d.repartition(3), t, **full).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, resampled(docs, target, **full)))
    empty = resample.resample(d.limit(0), t, **full)
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert resample.resample(d, t.limit(0), **full).count() == len(docs)


def test_op12_on_the_test_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.op12_prefix_crc_resampling(spark, SF).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, resampled(docs, target, 10, 20, 1, 10_000, 2024)))


# ------------------------------------------------------------------- audit

def test_wide_counters_hold_large_counts():
    wide = audit.WideCounters()
    wide.add(["p", "q"], np.array([0, 1, 0]), np.array([3, 0, 3]), np.array([2 ** 61, 5, 2 ** 61]))
    counts = audit.unpacked(wide.total["p"])
    assert (counts == audit.outcomes(3) * 2 ** 62).all() and audit.unpacked(wide.total["q"])[:, 0].tolist() == [5] * 600


def test_audit_matches_a_plain_version(spark):
    rng = random.Random(7)
    texts = [None, "", "one two", "A" * 30, prose(rng, 60, 1000), prose(rng, 60, 5), prose(rng, 49, 1000) + " #", prose(rng, 50, 1000),
             "X " * 40 + prose(rng, 60, 10_000), "é  %", prose(rng, 5000, 9000)]
    docs = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice([None, "", "a", "b", "hot", "hot"])) for _ in range(300)]
    docs += [(7, texts[4], "a")] * 30
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in [*range(0, 40, 2), 3, 3, 3]]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").select("*", F.lit(1).alias("h"), F.lit("z").alias("part"))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("code", F.lit(1))
    for tasks in (1, 7):
        got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in audit.filter_audit(d.repartition(tasks), lab).collect()}
        assert got == audited(docs, labels)
    assert audit.filter_audit(d.limit(0), lab).count() == 0
    assert audit.filter_audit(d, lab.limit(0)).agg(F.max("good_lost"), F.max("toxic_lost")).first()[:] == (0, 0)


def test_op13_on_the_test_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in queries.op13_filter_audit(spark, SF).collect()}
    assert got == audited(docs, labels)
