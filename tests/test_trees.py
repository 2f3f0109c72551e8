"""Forests, boosting and linear fits against plain versions, node by node and fold by fold."""

import pickle
import tempfile

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.ml import forest, gram, rows as MR, train as T, trees
from wayfare.ml import boosting
from wayfare.ml.boosting import fit_boosting
from wayfare.sources import sinks

X = ["a", "b", "c"]


def data(n=400, seed=1, missing=False):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 6, n), rng.normal(size=n).round(2), rng.integers(0, 40, n) / 4], 1).astype(float)
    if missing:
        x[rng.random(n) < 0.1, 1] = np.nan
    y = (3 * (x[:, 0] > 2) + np.nan_to_num(x[:, 1]) * 2 + (x[:, 2] > 4) * x[:, 0] + rng.normal(size=n)).round(2)
    return x, y


def table(spark, x, y, parts=3):
    rows = [(k, *(None if np.isnan(v) else float(v) for v in r), float(t)) for k, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "k long, a double, b double, c double, y double").repartition(parts)


def plain_tree(x, y, w, tree, depth, max_depth, node, mtry, out):
    """CART by trying every cut of every feature. Rows: the ones with weight."""
    mean = np.average(y, weights=w)
    out[node] = [-1, None, mean, w.sum()]
    rest = (w * (y - mean) ** 2).sum()
    if depth == max_depth or rest <= 1e-14 * max(abs(y).max() ** 2, 1e-300) * w.sum():
        return
    found = []
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        best = (-1.0, None)
        for lo, hi in zip(values, values[1:]):
            left = x[:, f] <= lo
            wl, wr = w[left].sum(), w[~left].sum()
            gain = wl * wr / w.sum() * (np.average(y[left], weights=w[left]) - np.average(y[~left], weights=w[~left])) ** 2
            if gain > best[0] * (1 + 1e-9) + 0.0:
                best = (gain, lo + (hi - lo) / 2 if np.isfinite(hi) else lo)
        found.append(best)
    if mtry:
        h = trees.hashed(np.int64(tree), np.int64(node), np.arange(len(found))) >> np.uint64(1)
        allowed = sorted((f for f in range(len(found)) if found[f][1] is not None), key=lambda f: int(h[f]))[:mtry]
        found = [c if f in allowed else (-1.0, None) for f, c in enumerate(found)]
    top = max(g for g, _ in found)
    if top < 0:
        return
    f = next(f for f, (g, _) in enumerate(found) if g >= top * (1 - 1e-9))
    out[node][:2] = [f, found[f][1]]
    left = x[:, f] <= found[f][1]
    plain_tree(x[left], y[left], w[left], tree, depth + 1, max_depth, 2 * node, mtry, out)
    plain_tree(x[~left], y[~left], w[~left], tree, depth + 1, max_depth, 2 * node + 1, mtry, out)


def held(rows):
    got = sorted(rows.collect(), key=lambda r: r["id"])
    x = np.array([r["x"] for r in got])
    return (np.array([r["id"] for r in got]), np.array([r["fold"] for r in got]), np.where(np.isnan(x), np.inf, x),
            np.array([r["y"] for r in got]))


@pytest.mark.parametrize("node_rows", [10_000, 60, 1])
@pytest.mark.parametrize("classes", [0, 2, 3])
def test_forest_equals_cart_split_by_split(spark, node_rows, classes):
    x, y = data(300, seed=classes, missing=node_rows == 10_000)
    if classes:
        y = np.digitize(y, np.quantile(y, [0.4] if classes == 2 else [0.3, 0.6])).astype(float)
    rows = MR.model_rows(table(spark, x, y), X, "y", ["k"], 3)
    mtry = 2 if classes else None
    models = forest.fit_forests(rows, X, [-1, 1], 3, 6, classes, mtry, seed=5, node_rows=node_rows)
    ids, fold, xs, ys = held(rows)
    assert ids.tolist() == list(range(300)) and np.bincount(fold).tolist() == [100, 100, 100]
    for fit, m in models.items():
        got = {(t, n): (f, thr, v, w) for t, n, f, thr, v, w in zip(*(m.nodes[c] for c in (
            "tree", "node", "feature", "threshold", "value", "weight")))}
        want = {}
        for tree in range(3):
            w = forest.bag_weights(ids, tree, 5) * (fold != fit)
            own, out = w > 0, {}
            if classes <= 2:
                plain_tree(xs[own], ys[own], w[own], tree, 0, 6, 1, mtry, out)
                want |= {(tree, n): c for n, c in out.items()}
        if classes <= 2:
            assert set(got) == set(want)
            for key, (f, thr, mean, weight) in want.items():
                assert got[key][0] == f and got[key][3] == weight and got[key][2][0] == pytest.approx(mean, abs=1e-9)
                assert f < 0 or got[key][1] == pytest.approx(thr, abs=1e-12)
        else:
            assert all(abs(v.sum() - 1) < 1e-9 for _, _, v, _ in got.values())


def test_bags_are_poisson_and_hash_of_row_and_tree():
    w = forest.bag_weights(np.arange(200_000), 3, 42)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02 and abs((w == 0).mean() - np.exp(-1)) < 0.005
    assert (forest.bag_weights(np.arange(200_000)[::-1], 3, 42)[::-1] == w).all()
    assert (forest.bag_weights(np.arange(1000), 4, 42) != w[:1000]).mean() > 0.5


def test_units_hold_codes_and_bounded_rows(spark, monkeypatch):
    """Phase 2 gets a few bytes a row, and never more rows of a node than the limit."""
    x, y = data(2000, seed=2)
    rows = MR.model_rows(table(spark, x, y), X, "y", ["k"])
    found, plain = [], forest.node_units

    def units(*args):
        df = plain(*args)
        found.extend(pickle.loads(r["payload"]) for r in df.collect())
        return df
    monkeypatch.setattr(forest, "node_units", units)
    monkeypatch.setattr(forest, "CODED_ROWS", 1)
    forest.fit_forests(rows, X, [-1], 2, 8, node_rows=300)
    assert len(found) > 4
    for part in found:
        assert len(part["y"]) <= 300 and sum(v.nbytes for v in (*part["x"], part["y"], part["w"])) <= 13 * len(part["y"])
    # Nodes at full depth are leaves, however many rows they have.
    found.clear()
    m = forest.fit_forests(rows, X, [-1], 2, 1, node_rows=100)[-1]
    assert not any(len(part["y"]) > 100 for part in found)
    assert sorted(m.nodes["node"].tolist()) == [1, 1, 2, 2, 3, 3]


@pytest.mark.parametrize("scale", [1.0, 1e4])
def test_smaller_children_are_counted_alone(monkeypatch, scale):
    """The same tree as with every node counted, with fewer rows counted; a far group of targets costs no digits."""
    rng = np.random.default_rng(3)
    x = np.stack([rng.integers(0, 8, 20_000), rng.integers(0, 30, 20_000), rng.integers(0, 5, 20_000)])
    y = (np.where(x[0] > 3, scale, 0.0) + x[1] % 7 * 0.01 + rng.normal(size=20_000) * 0.01)[:, None]
    values, w = [np.arange(s) * 1.0 for s in (8, 30, 5)], forest.bag_weights(np.arange(20_000), 0, 1)
    counted, plain = [], np.bincount
    monkeypatch.setattr(trees.np, "bincount", lambda k, *a, **o: counted.append(len(k)) or plain(k, *a, **o))
    got = trees.grow(list(x), values, y, w, 6, 0).arrays()
    few = sum(counted)
    counted.clear()
    monkeypatch.setattr(trees, "COARSE", np.inf)
    want = trees.grow(list(x), values, y, w, 6, 0).arrays()
    assert few < 0.75 * sum(counted)
    assert (got["node"] == want["node"]).all() and (got["feature"] == want["feature"]).all()
    assert np.allclose(got["threshold"], want["threshold"], equal_nan=True) and np.allclose(got["gain"], want["gain"], rtol=1e-9)


def plain_boosting(x, y, rounds, depth, rate, logistic):
    """Friedman's boosting with exhaustive cuts; returns the raw predictions of the rows."""
    m = y.mean()
    raw = np.full(len(y), np.log(m / (1 - m)) if logistic else m)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = (y - p, p * (1 - p)) if logistic else (y - raw, np.ones(len(y)))
        stack, node = [(np.arange(len(y)), 0)], None
        while stack:
            node, d = stack.pop()
            best = (0.0, None, None)
            total, n = g[node].sum(), len(node)
            if d < depth:
                for f in range(x.shape[1]):
                    values = np.unique(x[node, f])
                    top = (0.0, None, None)
                    for lo in values[:-1]:
                        left = x[node, f] <= lo
                        nl = left.sum()
                        sl = g[node[left]].sum() - total / n * nl
                        gain = sl ** 2 * n / (nl * (n - nl))
                        if gain > top[0] * (1 + 1e-9):
                            top = (gain, f, lo)
                    if top[0] > best[0] * (1 + 1e-9):
                        best = top
            if best[1] is None or best[0] <= 1e-12 * n * ((total / n) ** 2 + 1e-300):
                raw[node] += rate * total / h[node].sum()
            else:
                left = x[node, best[1]] <= best[2]
                stack += [(node[left], d + 1), (node[~left], d + 1)]
    return raw


@pytest.mark.parametrize("logistic", [False, True])
def test_boosting_of_all_folds_at_once(spark, logistic):
    x, y = data(360, seed=3)
    y = (y > np.median(y)).astype(float) if logistic else y
    df = table(spark, x, y)
    rows = MR.model_rows(df, X, "y", ["k"], 3)
    models = fit_boosting(rows, X, [-1, 0, 2], 7, 3, 0.1, logistic, rewrite=3)
    _, fold, xs, ys = held(rows)
    for fit, m in models.items():
        own = fold != fit
        raw = trees.Ensemble(m.nodes, "sum", m.base, m.rate).raw(xs[own])[:, 0]
        assert np.allclose(raw, plain_boosting(xs[own], ys[own], 7, 3, 0.1, logistic), atol=1e-8)
    # A fold equals a fit by itself on the other rows (the bins are those of the values that occur).
    part = rows.where("fold <> 2")
    alone = fit_boosting(part, X, [-1], 7, 3, 0.1, logistic)[-1]
    both = [sorted(zip(*(m.nodes[c].tolist() for c in ("tree", "node", "feature", "weight")))) for m in (alone, models[2])]
    assert both[0] == both[1]


def test_boosting_passes(spark, monkeypatch):
    """Whatever the partitions, the way of the sums to the driver and what was kept of the blocks: the same trees."""
    x, y = data(360, seed=7)
    rows = MR.model_rows(table(spark, x, y), X, "y", ["k"], 3)
    want = fit_boosting(rows, X, [-1, 0, 2], 4, 3, 0.1, parts=1)
    monkeypatch.setattr(boosting, "SUM_BYTES", 0)
    monkeypatch.setattr(boosting, "state_folder", lambda tag: tempfile.mkdtemp(prefix="boosting-lost-"))
    got = fit_boosting(rows, X, [-1, 0, 2], 4, 3, 0.1, rewrite=2, parts=3)
    for f in want:
        a, b = (m.nodes for m in (want[f], got[f]))
        by, at = (np.lexsort((n["node"], n["tree"])) for n in (a, b))
        assert all((a[c][by] == b[c][at]).all() for c in ("tree", "node", "feature", "weight"))
        assert all(np.allclose(a[c][by], b[c][at], equal_nan=True, rtol=1e-9) for c in ("threshold", "value", "gain"))


def test_what_boosting_keeps_of_a_block(tmp_path, monkeypatch):
    rng = np.random.default_rng(1)
    payload = {"codes": rng.integers(0, 4, (2, 50)).astype(np.uint8), "y": rng.normal(size=50), "fold": np.arange(50) % 2}
    tree = boosting.new_tree(2)
    tree[0][[1, 2, 3]], tree[1][[1, 2, 3]], tree[2][4:8] = [0, 1, 1], [1, 0, 2], [1.0, 2.0, 3.0, 4.0]
    moves, plain = [], boosting.Held.descend
    monkeypatch.setattr(boosting.Held, "descend", lambda self, trees: moves.append(1) or plain(self, trees))

    def reach(rounds, depth, path):
        with boosting.Held(payload, [-1, 1], [0.5, 0.0], 2, str(path)) as held:
            held.bring([[tree, tree]] * rounds, [tree, tree], depth, 0.1)
            return held.raw.copy(), held.node.copy()
    for stage in ((0, 0), (0, 1), (1, 0), (1, 1)):
        kept = reach(*stage, tmp_path / "kept")
    assert len(moves) == 1 + 1 + 1  # a level each, none twice
    for got, want in zip(kept, reach(1, 1, tmp_path / "new")):
        assert (got == want).all()
    # Left half done: begun again.
    with boosting.Held(payload, [-1, 1], [0.5, 0.0], 2, str(tmp_path / "kept")) as held:
        held.stage[0], held.raw[:], held.node[:] = 0, 9.0, 1
    for got, want in zip(reach(1, 1, tmp_path / "kept"), kept):
        assert (got == want).all()
    c = payload["codes"]
    leaf = np.where(c[0] > 1, np.where(c[1] > 2, 4.0, 3.0), np.where(c[1] > 0, 2.0, 1.0))
    assert np.allclose(kept[0][0], 0.5 + 0.1 * leaf) and (kept[1][1] == np.where(payload["fold"] == 1, 0, np.where(c[0] > 1, 3, 2))).all()


def test_partitions_of_boosting():
    # Few rows go to few partitions, many to as many as run at once, and more where these would be large.
    assert boosting.part_count(12, 1000, 20, 9, 4000) == 1
    assert boosting.part_count(12, 1 << 24, 20, 9, 4000) == 12
    assert boosting.part_count(12, 1 << 30, 20, 9, 4000) == (20 << 30) // boosting.PART_BYTES


def test_quantile_bins_where_values_are_many(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 3))
    y = np.sin(2 * x[:, 0]) + x[:, 1]
    df = table(spark, x, y)
    rows = MR.model_rows(df, X, "y", ["k"], 2)
    bins = MR.Bins.of(rows, 3, max_bins=100)
    assert bins.exact == [False] * 3 and all(200 < len(v) <= 257 for v in bins.values)
    for m in (fit_boosting(rows, X, [-1], 30, 4, 0.1, max_bins=100)[-1],
              forest.fit_forests(rows, X, [-1], 10, 10, node_rows=500, max_bins=100)[-1]):
        e = np.array([r["prediction"] - r["y"] for r in m.transform(df).collect()])
        assert (e ** 2).mean() < 0.1 * y.var()


@pytest.mark.parametrize("kind", ["random_forest", "gradient_boosting"])
def test_model_as_a_relation(spark, tmp_path, kind):
    """DuckDB walks the exported nodes by a recursive join and gives what transform gives."""
    x, y = data(500, seed=4)
    df = table(spark, x, y)
    m = T.train_price_model(df.where("k < 400"), X, kind, "y", num_trees=6, max_depth=5)
    sinks.save_model(m, str(tmp_path / "m"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW nodes AS SELECT * FROM '{tmp_path}/m/nodes/*.parquet'")
    con.register("rows_", df.toPandas())
    got = dict(con.sql(f"""
        WITH RECURSIVE walk AS (
          SELECT k, [a, b, c] AS x, n.* FROM rows_, nodes n WHERE n.node = 1
          UNION ALL
          SELECT w.k, w.x, n.* FROM walk w JOIN nodes n ON n.tree = w.tree
            AND n.node = 2 * w.node + CASE WHEN w.x[w.feature + 1] <= w.threshold THEN 0 ELSE 1 END
          WHERE w.feature >= 0)
        SELECT k, {'avg(value[1])' if kind == 'random_forest' else f'{m.base!r} + {m.rate!r} * sum(value[1])'}
        FROM walk WHERE feature < 0 GROUP BY k""").fetchall())
    for model in (m, sinks.load_model(str(tmp_path / "m"))):
        want = {r["k"]: r["prediction"] for r in model.transform(df).collect()}
        assert set(got) == set(want) and all(got[k] == pytest.approx(v, abs=1e-9) for k, v in want.items())
    shares = dict(con.sql("""
        WITH g AS (SELECT tree, feature, sum(gain) / sum(sum(gain)) OVER (PARTITION BY tree) AS s FROM nodes
                   WHERE feature >= 0 GROUP BY tree, feature)
        SELECT feature, sum(s) / sum(sum(s)) OVER () FROM g GROUP BY feature""").fetchall())
    assert {f: pytest.approx(s, abs=1e-9) for f, s in shares.items()} == {
        f: s for f, s in enumerate(m.importances()) if f in shares}


def test_classifier_probabilities_and_missing_values(spark):
    x, y = data(300, seed=5, missing=True)
    label = np.digitize(y, np.quantile(y, [0.3, 0.7])).astype(float)
    df = table(spark, x, label).withColumnRenamed("y", "label")
    m = T.train_classifier(df, X, "random_forest", num_trees=10)
    got = m.transform(df).collect()
    assert all(len(r["probability"]) == 3 and abs(sum(r["probability"]) - 1) < 1e-9 for r in got)
    assert all(r["prediction"] == int(np.argmax(r["probability"])) for r in got)
    assert np.mean([r["prediction"] == r["label"] for r in got]) > 0.9
    with pytest.raises(ValueError):
        T.train_classifier(df, X, "gradient_boosting")


def test_constant_and_empty_inputs(spark):
    df = spark.createDataFrame([(k, 1.0, 2.0, 3.0, 5.0) for k in range(10)] + [(99, 1.0, 1.0, 1.0, None)],
                               "k long, a double, b double, c double, y double")
    for kind in T.REGRESSORS:
        m = T.train_price_model(df, X, kind, "y", num_trees=3)
        assert all(r["prediction"] == pytest.approx(5.0) for r in m.transform(df.where("y IS NOT NULL")).collect())
    for kind in ("random_forest", "gradient_boosting"):
        m = T.train_price_model(df.limit(0), X, kind, "y", num_trees=3)
        assert m.transform(df).count() == 11


def test_linear_folds_from_one_scan(spark):
    x, y = data(300, seed=6)
    df = table(spark, x, y).withColumn("fold", F.pmod("k", F.lit(4)).cast("int"))
    sums = gram.fold_sums(df, X, "y", F.col("fold"))
    fold, m, s = np.arange(300) % 4, x.mean(0), x.std(0)
    z = (x - m) / s
    for kind in T.LINEAR:
        _, scores = gram.fit_folds(kind, X, sums, 4)
        for k in range(4):
            a, b = z[fold != k], y[fold != k]
            ac, bc = a - a.mean(0), b - b.mean()
            if kind == "lasso":
                w = gram.lasso_weights(ac.T @ ac, ac.T @ bc, 0.1 * len(b))
            else:
                w = np.linalg.solve(ac.T @ ac + (kind == "ridge") * np.eye(3), ac.T @ bc)
            own = fold == k
            e = y[own] - (b.mean() + (z[own] - a.mean(0)) @ w)
            assert scores[k] == pytest.approx(1 - (e ** 2).sum() / ((y[own] - y[own].mean()) ** 2).sum(), abs=1e-9)


def test_forests_stay_out_of_the_driver(spark):
    """The models of all fits are rows of a written table; scoring reads some nine bytes a node, of one fit."""
    rng = np.random.default_rng(11)
    x = rng.integers(0, 30, (3000, 3)).astype(float)
    rows = spark.createDataFrame([(k, k % 3, float(a[0] * 2 + a[1] + rng.normal()), a.tolist()) for k, a in enumerate(x)],
                                 "id long, fold int, y double, x array<double>")
    path = tempfile.mkdtemp() + "/rows"
    rows.write.parquet(path)
    got = forest.fit_forests(spark.read.parquet(path), ["a", "b", "c"], [-1, 0], 4, 9)
    for m in got.values():
        assert m._nodes is None
        n = m.nodes
        score = [bytes(r["score"]) for r in m.source.orderBy("tree").collect()]
        assert len(score) == 4 and sum(map(len, score)) < 11 * len(n["node"]) + 4 * 500
        one, two = trees.Ensemble(n, "mean"), trees.Ensemble.of_trees(score, "mean", 0.0, 1.0)
        assert one.depths == two.depths and (one.raw(x) == two.raw(x)).all()
        plain = trees.TreeModel(["a", "b", "c"], n, "regression", "mean")
        assert np.allclose(plain.importances(), m.importances(), rtol=0, atol=1e-12)
        table = spark.createDataFrame([tuple(a) for a in x[:200].tolist()], "a double, b double, c double")
        assert [r["prediction"] for r in m.transform(table).collect()] == [r["prediction"] for r in plain.transform(table).collect()]


def test_rows_are_moved_for_tasks_not_for_trees(spark, monkeypatch):
    """A table that a task can hold goes to as many tasks as run at once, whatever the number of trees and partitions."""
    rng = np.random.default_rng(12)
    rows = spark.createDataFrame([(k, 0, float(rng.normal()), rng.integers(0, 5, 2).astype(float).tolist()) for k in range(500)],
                                 "id long, fold int, y double, x array<double>")
    path, parts, plain = tempfile.mkdtemp() + "/rows", [], forest.whole_trees
    rows.write.parquet(path)
    monkeypatch.setattr(forest, "whole_trees", lambda *a: parts.append(a[3]) or plain(*a))
    monkeypatch.setattr(forest, "partition_count", lambda _: 1000)
    forest.fit_forests(spark.read.parquet(path), ["a", "b"], [-1], 64, 3)
    assert parts and parts[0] <= spark.sparkContext.defaultParallelism
