"""Near-duplicate vectors, n-gram join, repeated strings, components, pipeline."""

import collections
import random

import numpy as np
import pytest
from plain import Links, near_duplicates as plain_near, sha, shingles, vector_links, without_repeats
from pyspark.sql import functions as F

import corpus_pipeline
from wayfare.llm import graph, jaccard, queries, subspace, suffix
from wayfare.llm.repeats import phrases

SF = "/root/testdata/sf0.001"


# -------------------------------------------------------------- components

@pytest.mark.parametrize("kind", ["chain", "star", "random", "empty"])
def test_components(spark, kind):
    rng = random.Random(4)
    edges = {"chain": [(k, k + 1) for k in range(60)], "star": [(500, k) for k in range(400)], "empty": [],
             "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]}[kind]
    links = Links(600)
    for a, b in edges:
        links.join(a, b)
    want = {k: min(g) for g in links.groups() for k in g if len(g) > 1}
    table = spark.createDataFrame(edges + [(None, 3), (7, None), (9, 9)] + edges[:5], "a long, b long")
    rows = graph.components(table).collect()
    assert {r["node"]: r["component"] for r in rows} == want and len(rows) == len(want)


# ------------------------------------------------------------------ vectors

def vectors(n=500):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((6, 64))
    rows = [(k, (base[k % 6] + rng.standard_normal(64) * (0.05 + 0.25 * rng.random())).tolist(), int(k % 3 and 1)) for k in range(n)]
    hot = rows[3][1]
    rows += [(10_000 + k, hot, rows[3][2]) for k in range(250)]
    rows += [(20_000 + k, (base[0] * (k + 1)).tolist(), 1) for k in range(5)]
    edge = [None, [0.0] * 64, [float("nan")] * 64, [float("inf")] + [1.0] * 63, [1.0, None], [], [1.0, 2.0], [2.0, 4.0], [3.0],
            [9.0], [-9.0], [1e300, 1e300], [1e-300, 1e-300], [-0.0, 1.0], [0.0, 2.0]]
    return rows + [(30_000 + k, v, 1) for k, v in enumerate(edge)] + [(40_000, hot, None), (40_001, [1.0, 2.0], 2)]


@pytest.mark.parametrize("parameters", [{}, {"part": 40}, {"blocks": 16, "axes": 2}, {"blocks": 200, "axes": 1}])
def test_vectors_match_all_pairs(spark, parameters):
    rows = vectors(300)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int") \
        .select("*", F.lit("x").alias("Label"), F.lit(0).alias("n_links"), F.lit(0).alias("id"))
    got = subspace.near_vectors(table.repartition(5), cosine=0.98, **parameters).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == vector_links(rows, 0.98)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert subspace.near_vectors(table.limit(0)).count() == 0


def test_crowded_cells_meet_in_parts(spark):
    rows = vectors(300)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    full = subspace.crowded(table.select(F.col("vec_id"), F.col("label").cast("long"), "embedding").where("label IS NOT NULL"), 0.98, 8, 3, 30)
    assert full and min(full.values()) >= 2
    got = subspace.near_vectors(table, cosine=0.98, cell=30, part=50).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == vector_links(rows, 0.98)


def test_cells_take_few_bytes_of_a_vector(spark):
    """A vector visits some 20 cells; what goes there is its block's coordinates, not the vector."""
    rng = np.random.default_rng(7)
    x = rng.standard_normal((2000, 96)).astype("f4")
    table = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(x)], "vec_id long, embedding array<float>, label long")
    cells = subspace.cells_of(table.select("vec_id", "label", "embedding").coalesce(1), 0.98, 8, 3, {}, 8)
    assert cells.agg(F.sum(F.length("payload"))).first()[0] < 2 * x.nbytes


def test_op2_on_the_test_table(spark):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]], r["label"])
            for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = queries.op2_subspace_pigeonhole(spark, SF).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == vector_links(rows, 0.98)


# ---------------------------------------------------------------- documents

def documents(n=60):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 150)))) for k in range(n)]
    long = " ".join(rng.choice(words) for _ in range(120))
    passage = " ".join(rng.choice(words) for _ in range(60))
    for k in range(120):
        w = long.split()
        for _ in range(k % 4):
            w[rng.randrange(len(w))] = f"edit{k}"
        rows.append((1000 + k, " ".join(w)))
    rows += [(2000 + k, f"own{k} " * 3 + passage + f" end{k}" * (k % 9)) for k in range(80)]
    rows += [(3000 + k, rows[5][1]) for k in range(90)]
    return rows + [(4000, None), (4001, ""), (4002, " \n"), (4003, "a b"), (4004, "a  b"), (4005, "a b c d"),
                   (4006, "x " * 20_000), (4007, "x " * 15_000), (None, "alone here"), (4008, "é " * 9)]


@pytest.mark.parametrize("parameters", [{}, {"small": 10, "block": 30, "depth": 2}, {"small": 4, "depth": 4},
                                        {"small": 2, "depth": 6}, {"small": 2, "depth": 5, "recall": 0.9999, "levels": 5}])
def test_near_duplicates_match_all_pairs(spark, parameters):
    rows = documents()
    table = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("Text"), F.lit("f").alias("fp"))
    got = jaccard.near_duplicates(table.repartition(5), **parameters).collect()
    assert collections.Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == plain_near(rows)
    assert all(r["kept"] == (r["class_id"] == r["doc_id"]) for r in got if r["doc_id"] is not None)
    assert jaccard.near_duplicates(table.limit(0)).count() == 0


def test_runs_follow_the_recall_and_the_level():
    assert jaccard.runs_needed(0.8, 0.9998, 3) == 12
    for levels in range(1, 7):
        for recall in (0.9, 0.999, 0.9999):
            r = jaccard.runs_needed(0.8, recall, levels)
            assert (1 - 0.8 ** levels) ** r <= 1 - recall + 1e-12 and (r == 1 or (1 - 0.8 ** levels) ** (r - 1) > 1 - recall)


def short_pairs(n=4000):
    """Texts of 8 to 50 words, each with a longer one at a similarity of 0.8 to 0.9."""
    rng, rows = random.Random(9), []
    for k in range(n):
        size = rng.randrange(8, 51)
        more = rng.randrange(-(-(size - 4) // 9), (size - 4) // 4 + 1)
        words = [f"p{k}w{j}" for j in range(size + more)]
        rows += [(2 * k, " ".join(words[:size])), (2 * k + 1, " ".join(words))]
    return rows


def test_short_near_duplicates_match_all_pairs(spark):
    rows = short_pairs()
    want = plain_near(rows)
    assert all(n == 1 for _, _, n in want)
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert collections.Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == want


def test_places_of_small_sets_agree_independently():
    rng = np.random.default_rng(10)
    for common, more in ((4, 1), (8, 2), (40, 10)):
        sets = rng.integers(0, 1 << 63, (3000, common + more)).astype(np.uint64)
        both = np.concatenate([np.concatenate([s[:common], s]) for s in sets])
        sizes = np.tile([common, common + more], 3000)
        sketch = jaccard.embed(np.concatenate([[0], np.cumsum(sizes)]), both)
        same = (sketch[::2] == sketch[1::2]).mean(1)
        assert abs(same.mean() - 0.8) < 0.005 and abs(same.std() / (0.16 / 128) ** 0.5 - 1) < 0.1
        assert same.min() > 0.588


def test_one_of_each_class_stays_even_of_repeated_rows(spark):
    rows = documents(10)
    table = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, _hash int")
    kept = jaccard.keep_one_of_each(table.unionByName(table))
    assert kept.columns == table.columns
    assert sorted(map(str, [r["doc_id"] for r in kept.collect()])) == sorted(
        str(i) for i, least, _ in plain_near(rows) if i == least)


def test_shingles_are_sets_of_words():
    import pyarrow as pa
    texts = [None, "", "a", "a b c d", "a b c d e", "a b c d e f", "a a a a a a a", "a b c"]
    offsets, _ = jaccard.shingle_sets(pa.array(texts), 5)
    assert np.diff(offsets).tolist() == [len(shingles(t)) for t in texts]


def test_op6_on_the_test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op6_chosen_path_join(spark, SF).collect()
    assert collections.Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == plain_near(rows)


# --------------------------------------------------------- repeated strings

def repeated():
    rng = random.Random(7)
    passage = "".join(rng.choice("abc é") for _ in range(400))
    rows = [(1, "a" * 500), (2, None), (3, ""), (4, passage), (5, passage[50:250] + "x" + passage[100:330]), (6, "ab" * 400),
            (7, "zz" + "a" * 150), (8, passage + passage), (None, "q" * 120 + passage[:150]), (9, "\0" * 300),
            (10, "\0" * 150 + "a" + "\0" * 120), (11, "é" * 300), (12, "x" * 99), (13, "x" * 100), (14, "x" * 101)]
    rows += [(100 + k, "".join(rng.choice("ab") for _ in range(300)) + passage[k:k + 120] + str(k) * 50) for k in range(40)]
    return rows + [(200 + k, "same text " * 15) for k in range(60)]


@pytest.mark.parametrize("parameters", [{}, {"hot": 0}, {"hot": 3}, {"length": 40}])
def test_repeats_match_a_plain_version(spark, parameters):
    rows = repeated()
    table = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("bucket"), F.lit("p").alias("payload"),
                                                                           F.lit(3).alias("n_spans"))
    out = suffix.remove_repeats(table.repartition(4), **parameters)
    want = without_repeats(rows, parameters.get("length", 100))
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        n, gone, spans, kept = want[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n, gone, spans, sha(kept)), r["doc_id"]
        assert r["kept_text"] == kept.decode("utf-8", "ignore") and (r["bucket"], r["payload"]) == (1, "p")
    assert suffix.remove_repeats(table.limit(0)).count() == 0


def test_repeated_ids_and_rows(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh") for _ in range(180))
    table = spark.createDataFrame([(1, text), (1, text), (1, text + "tail"), (2, text)], "doc_id long, text string")
    got = collections.Counter((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in suffix.remove_repeats(table).collect())
    assert got[(2, 180, 180)] == 1
    first_short = got[(1, 180, 0)] == 2 and got[(1, 184, 180)] == 1
    assert first_short or (got[(1, 180, 180)] == 2 and got[(1, 184, 0)] == 1)


@pytest.mark.parametrize("parameters", [{}, {"hot": 0}])
@pytest.mark.parametrize("tasks", [1, 5])
def test_repeated_rows_count_as_one_document(spark, tasks, parameters):
    rows = repeated() + [(None, "only here " + "".join(map(chr, range(300, 500))))]
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    out = suffix.remove_repeats(table.unionByName(table).unionByName(table).repartition(tasks), **parameters).collect()
    want = without_repeats(rows, 100)
    assert collections.Counter((r["doc_id"], r["n_removed"], r["kept_sha256"]) for r in out) == {
        (k, gone, sha(kept)): 3 for k, (_, gone, _, kept) in want.items()}
    alone = spark.createDataFrame([(None, rows[-1][1])] * 2, "doc_id long, text string")
    assert [r["n_removed"] for r in suffix.remove_repeats(alone.repartition(tasks), **parameters).collect()] == [0, 0]


def test_equal_windows_have_their_trigger_at_the_same_place():
    rng = np.random.default_rng(8)
    raw = rng.integers(97, 100, 3000).astype(np.uint8)
    raw[1000:1300] = raw[:300]
    starts = np.array([0, 700, 700, 900, 3000])
    doc, first, last, trigger, h, _ = phrases(raw, starts, 50)
    at = {}
    for d, a, b, t, key in zip(doc, first, last, trigger, h):
        for k in range(a, b + 1):
            place = (t - k, key)
            assert at.setdefault(raw[k:k + 50].tobytes(), place) == place and 0 <= t - k <= 50 - 24
    assert sum(last - first + 1) == sum(max(n - 49, 0) for n in np.diff(starts))


def test_op5_on_the_test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = without_repeats(rows, 100)
    for r in queries.op5_suffix_dedup(spark, SF).collect():
        n, gone, spans, kept = want[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n, gone, spans, sha(kept))


# ----------------------------------------------------------------- pipeline

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = stage(spark, docs, SF).cache()
        seen.append((before, docs.collect()))
        assert k == 4 or docs.columns == columns
    good = {r["doc_id"] for r in queries.op1_quality_rules(spark, SF).where("kept").collect()}
    assert {r["doc_id"] for r in seen[0][1]} == good
    assert {r["doc_id"] for r in seen[1][1]} <= set(seen[1][0])
    rows = [(i, r["text"]) for i, r in seen[2][0].items()]
    assert {r["doc_id"] for r in seen[2][1]} == {i for i, least, _ in plain_near(rows) if i == least}
    want = without_repeats([(i, r["text"]) for i, r in seen[3][0].items()], 100)
    for r in seen[3][1]:
        assert r["text"] == want[r["doc_id"]][3].decode("utf-8", "ignore") and r["n_chars"] == len(r["text"])
    assert {r["doc_id"] for r in seen[4][1]} == set(seen[4][0])
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
