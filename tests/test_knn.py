"""The blocked kernel against brute force (numpy), incl. ties, zero vectors, skew."""

import re

import numpy as np
import pandas as pd
import pytest

from wayfare.operators import knn
from wayfare.operators.knn import _kernel, _probe, pack_long, topk_cosine


def brute(Q, C, qids, cids, k, exclude_self, min_score, digits=9):
    out = {}
    for i, qi in enumerate(qids):
        res = []
        for j, cj in enumerate(cids):
            if exclude_self and qi == cj:
                continue
            na, nb = np.linalg.norm(Q[i]), np.linalg.norm(C[j])
            s = 0.0 if na * nb == 0 else float(Q[i] @ C[j] / (na * nb))
            s = np.floor(s * 10 ** digits + 0.5) / 10 ** digits
            if min_score is not None and not s > min_score:
                continue
            res.append((-s, cj, s))
        res.sort()
        out[qi] = [(c, s) for _, c, s in res[:k]]
    return out


def vectors(ids, M):
    return [(int(i), [int(j) for j in np.flatnonzero(M[r])], [float(x) for x in M[r][M[r] != 0]]) for r, i in enumerate(ids)]


def sample(n=300, d=12):
    rng = np.random.default_rng(1)
    M = (rng.random((n, d)) < 0.3) * rng.integers(1, 4, (n, d)).astype(float)
    M[5] = M[7]            # identical twins -> exact ties
    M[9] = 0.0             # zero vector
    M[:, 0] += 1.0 * (np.arange(n) % 3 == 0)  # a hot key shared by a third of the ids
    return np.arange(1000, 1000 + n), M


def lists(got):
    g = {}
    for r in got:
        g.setdefault(r.qid, []).append((r.rank, r.cid, r.score))
    return {q: [(c, s) for _, c, s in sorted(v)] for q, v in g.items()}


@pytest.mark.parametrize("grid, chunk, min_score, stretch", [
    ((1, 1), 512, 0.0, 1024), ((2, 2), 512, None, 50), ((3, 1), 17, 0.0, 7), ((1, 7), 64, None, 33), (None, 100, 0.0, 100)])
def test_topk_matches_brute_force_for_any_grid(spark, grid, chunk, min_score, stretch):
    ids, M = sample()
    df = spark.createDataFrame(vectors(ids, M), "id long, keys array<long>, vals array<double>")
    got = lists(topk_cosine(df, df, 10, exclude_self=True, min_score=min_score, grid=grid, chunk=chunk, stretch=stretch).collect())
    exp = brute(M, M, ids, ids, 10, True, min_score)
    for q, lst in exp.items():
        assert got.get(q, []) == lst, q


def test_query_blocks_are_bounded_and_every_group_has_a_task_of_its_own(spark):
    ids, M = sample(120)
    df = spark.createDataFrame(vectors(ids, M), "id long, keys array<long>, vals array<double>")
    out = topk_cosine(df, df, 3, query_block=25)
    assert lists(out.collect()) == {q: v for q, v in brute(M, M, ids, ids, 3, False, None).items()}
    assert out.rdd.getNumPartitions() >= 1 and "RepartitionById" in out._jdf.queryExecution().analyzed().toString() \
        or "Repartition" in out._jdf.queryExecution().analyzed().toString()


def test_signed_dense_vectors(spark):
    rng = np.random.default_rng(4)
    Q, C = rng.normal(size=(60, 4)), rng.normal(size=(500, 4))
    C[3] = 0
    full = lambda ids, M: spark.createDataFrame([(int(i), list(range(4)), [float(x) for x in r]) for i, r in zip(ids, M)],
                                                "id long, keys array<long>, vals array<double>")
    got = lists(topk_cosine(full(range(60), Q), full(range(500), C), 10, grid=(2, 3), stretch=16).collect())
    assert got == brute(Q, C, range(60), range(500), 10, False, None)


def test_bounds_spare_most_products_on_skewed_data():
    """Vectors that lean on one of many keys: a query meets its own posting list
    and few others, and every list is still exact."""
    rng = np.random.default_rng(6)
    n, d = 3000, 60
    lead = rng.zipf(1.5, n) % d
    M = (rng.random((n, d)) < 0.05) * rng.random((n, d)) * 0.3
    M[np.arange(n), lead] = 1.0
    M[np.arange(0, n, 3), 0] += 0.5  # a key that a third of all vectors have
    order = np.lexsort((-M.max(1), M.argmax(1)))
    frame = lambda role, rows: pd.DataFrame({"role": role, "qid": rows, "cid": rows,
                                             "keys": [np.flatnonzero(M[r]) for r in rows], "vals": [M[r][M[r] != 0] for r in rows]})
    run = _kernel(10, True, 0.0, 9, False, 64, 32)
    out = next(run(iter([frame(0, np.argsort(lead, kind="stable")), frame(1, order)])))
    assert run.products < 0.4 * n * n
    got = {q: sorted(zip(-g["score"], g["cid"])) for q, g in out.groupby("qid")}
    for q, lst in brute(M[:200], M, range(200), range(n), 10, True, 0.0).items():
        assert [(c, -s) for s, c in got[q]] == lst


def test_pack_long(spark):
    df = spark.createDataFrame([(1, 5, 2.0), (1, 6, 3.0), (2, 5, 1.0)], "id long, key long, value double")
    got = {r.id: dict(zip(r["keys"], r["vals"])) for r in pack_long(df).collect()}
    assert got == {1: {5: 2.0, 6: 3.0}, 2: {5: 1.0}}


def test_kernel_handles_string_candidates():
    pdf = pd.DataFrame({"role": [0, 1, 1], "qid": [1, -1, -1], "cid": ["", "b", "a"],
                        "keys": [np.array([0, 1]), np.array([0]), np.array([0, 1])],
                        "vals": [np.array([1.0, 1.0]), np.array([1.0]), np.array([1.0, 1.0])]})
    out = next(_kernel(1, False, None, 9, True)(iter([pdf])))
    assert out.cid.tolist() == ["a"] and out.score.tolist() == [1.0]
    assert list(_kernel(1, False, None, 9, True)(iter([pdf[pdf.role == 0]]))) == []


def test_floors_of_alike_vectors_spare_nearly_all_products():
    """Groups of nearly equal vectors, dealt over the stream's columns: the probe's
    floors tell what cannot enter a list before any product is taken."""
    rng = np.random.default_rng(8)
    base = (rng.random((60, 40)) < 0.2) * rng.random((60, 40)) + np.eye(60, 40) * 0.1 + 0.001
    M = np.repeat(base, 30, 0) * (1 + 1e-7 * rng.random((1800, 40)))
    unit = M / np.linalg.norm(M, axis=1)[:, None]
    order = np.lexsort((unit.max(1), M.argmax(1)))
    frame = lambda role, rows: pd.DataFrame({"role": role, "qid": rows, "cid": rows,
                                             "keys": [np.arange(40) for _ in rows], "vals": [M[r] for r in rows]})
    both = pd.concat([frame(0, order), frame(1, order)])
    side = both.iloc[np.argsort(np.concatenate([np.arange(1800)] * 2), kind="stable")]
    floors = pd.concat(list(_probe(10, True, 0.0, 9, False, 256)(iter([side])))).groupby("qid")["floor"].max()
    S = unit @ unit.T
    np.fill_diagonal(S, -1)
    kth = np.floor(np.sort(S, 1)[:, -10] * 1e9 + 0.5) / 1e9
    assert len(floors) > 1750 and (floors.to_numpy() <= kth[floors.index]).all() and (floors > 0.99).mean() > 0.9
    q = frame(0, np.arange(1800)).assign(floor=floors.reindex(np.arange(1800)).to_numpy())
    run = _kernel(10, True, 0.0, 9, False, 64, 256)
    out = next(run(iter([q, frame(1, order[::2])])))
    assert run.products < 0.3 * 1800 * 900
    got = {q: sorted(zip(-g["score"], g["cid"])) for q, g in out.groupby("qid")}
    half = np.sort(order[::2])
    for q, lst in brute(M[:60], M[half], range(60), half, 10, True, 0.0).items():
        assert [(c, -s) for s, c in got[q]] == lst


def test_queries_are_laid_out_once_for_many_candidates(monkeypatch):
    rng = np.random.default_rng(9)
    M = (rng.random((12_000, 30)) < 0.2) * rng.random((12_000, 30)) + 0.001
    frame = lambda role, rows: pd.DataFrame({"role": role, "qid": rows, "cid": rows,
                                             "keys": [np.flatnonzero(M[r]) for r in rows], "vals": [M[r][M[r] != 0] for r in rows]})
    laid, dense = [], knn._Sparse.dense
    monkeypatch.setattr(knn._Sparse, "dense", lambda self, lo, hi: laid.append(hi - lo) or dense(self, lo, hi))
    out = next(_kernel(5, True, None, 9, False)(iter([frame(0, np.arange(200)), frame(1, np.arange(12_000))])))
    assert sum(laid) == 12_000 + 200
    got = {q: sorted(zip(-g["score"], g["cid"])) for q, g in out.groupby("qid")}
    for q, lst in brute(M[:200], M, range(200), range(12_000), 5, True, None).items():
        assert [(c, -s) for s, c in got[q]] == lst


def test_groups_are_as_many_as_tasks_need(spark):
    """Each column of candidates costs a copy of all queries, whatever the number of shuffle partitions."""
    ids, M = sample(60)
    df = spark.createDataFrame(vectors(ids, M), "id long, keys array<long>, vals array<double>")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "500")
    try:
        plan = topk_cosine(df, df, 3)._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    copies = [int(n) + 1 for n in re.findall(r"sequence\(0, (\d+)", plan)]
    assert len(copies) == 2 and max(copies) <= 3 * spark.sparkContext.defaultParallelism
