"""Invariants and brute-force checks of the operators that have no SQL form."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallygrid.operators import anomaly as ano, cluster as clu, evaluate as ev, models as mod
from tallygrid.operators import neural as net, pruning as pru
from tallygrid.plans import modelling as M

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain(spark):
    return M.prepared(spark, SF)


@pytest.fixture(scope="module")
def scaled(spark):
    return M.prepared(spark, SF, scale=True)


@pytest.fixture(scope="module")
def tree(plain):
    return mod.fit_tree_regression(plain[0], "features", M.TARGET)


def set_rmse(pred):
    return {r["split"]: r for r in ev.regression_metrics(pred).collect()}





def beats_mean(pred):
    return set_rmse(pred)["test"]["r2"] > 0.5


def test_tree_regression(plain, tree):
    train, test, _ = plain
    pred = mod.predictions(tree, train, test, M.KEY, M.TARGET, "features")
    m = set_rmse(pred)
    assert m["test"]["r2"] > 0.9 and m["train"]["rmse"] < m["test"]["rmse"]
    assert pred.count() == train.count() + test.count()


def test_tree_nodes_and_complexity(tree):
    nodes = {r["id"]: r for r in mod.tree_nodes(tree).collect()}
    for r in nodes.values():
        if not r["is_leaf"]:
            assert r["count"] == nodes[r["left"]]["count"] + nodes[r["right"]]["count"]
    row = mod.tree_complexity(tree).first()
    assert row["leaves"] == (row["nodes"] + 1) // 2 and row["nodes"] == len(nodes)


def test_importances(tree, plain):
    names = plain[2]
    per = {r["feature"]: r["importance"] for r in mod.feature_importance(tree, names).collect()}
    by = {r["variable"]: r["importance"] for r in mod.importance_by_column(tree, names).collect()}
    assert abs(sum(per.values()) - 1) < 1e-9 and abs(sum(by.values()) - 1) < 1e-9
    for column, total in by.items():
        assert abs(total - sum(per[f] for f, c in names if c == column)) < 1e-12


def hand_made(spark):
    # root 0 (1,4); 1 (2,3); 4 (5,6): the split at 4 helps little and goes first
    rows = [(0, 5.0, 20.0, 8, 1, 4, 0, 4.0), (1, 2.0, 4.0, 4, 2, 3, 0, 2.0), (2, 0.0, 0.0, 2, None, None, None, None),
            (3, 4.0, 0.0, 2, None, None, None, None), (4, 8.0, 0.5, 4, 5, 6, 0, 6.0),
            (5, 7.5, 0.25, 2, None, None, None, None), (6, 8.5, 0.25, 2, None, None, None, None)]
    return spark.createDataFrame(rows, "id int, prediction double, impurity double, count long, left int, "
                                       "right int, feature int, threshold double")


def test_weakest_link_order(spark):
    path = pru.weakest_links(hand_made(spark))
    # node 4: 0.25 - 0.125 = 0.125; node 1: 2 - 0 = 2; root: (20 - 0.25 - 2) after both collapse
    np.testing.assert_allclose(path.collapse[[4, 1, 0]], [0.125, 2.0, 17.75])
    assert [pru.shape_at(path, a)[:2] for a in (0, 0.125, 2.0, 17.75)] == [(7, 4), (5, 3), (3, 2), (1, 1)]
    rows = pru.prune_path(hand_made(spark)).orderBy("alpha").collect()
    assert [r["leaves"] for r in rows] == [4, 3, 2, 1]


def test_predictions_at_each_alpha(spark):
    tree = pru.weakest_links(hand_made(spark))
    x = np.array([[1.0], [3.0], [5.0], [9.0]])
    got = pru.predict_at(x, tree, np.array([0.0, 0.125, 2.0, 17.75]))
    np.testing.assert_allclose(got, [[0, 0, 2, 5], [4, 4, 2, 5], [7.5, 8, 8, 5], [8.5, 8, 8, 5]])


def test_prune_search_and_pruned_tree(spark, plain, tree):
    train, test, _ = plain
    nodes = mod.tree_nodes(tree)
    search = pru.prune_search(nodes, train, test, "features", M.TARGET).orderBy("alpha").collect()
    assert len(search) <= 40 and sum(r["chosen"] for r in search) == 1
    assert all(a["nodes"] >= b["nodes"] for a, b in zip(search, search[1:]))
    assert all(a["rmse_train"] <= b["rmse_train"] + 1e-9 for a, b in zip(search, search[1:]))
    chosen = [r for r in search if r["chosen"]][0]
    assert chosen["rmse_validation"] == min(r["rmse_validation"] for r in search)
    # the unpruned node table predicts what Spark predicts; the pruned one what the search measured
    whole = pru.pruned_tree(nodes, -1.0, train, test, "features", M.TARGET, M.KEY)
    spark_own = mod.predictions(tree, train, test, M.KEY, M.TARGET, "features")
    assert whole.join(spark_own.withColumnRenamed("predicted", "p2"), ["line_id", "split"]).where(
        F.abs(F.col("predicted") - F.col("p2")) > 1e-6).count() == 0
    cut = pru.pruned_tree(nodes, chosen["alpha"], train, test, "features", M.TARGET, M.KEY)
    assert abs(set_rmse(cut)["test"]["rmse"] - chosen["rmse_validation"]) < 1e-6


def test_forest_and_boosted(plain, tree):
    train, test, _ = plain
    single = set_rmse(mod.predictions(tree, train, test, M.KEY, M.TARGET, "features"))["test"]["rmse"]
    forest = mod.forest_regression(train, test, "features", M.TARGET, M.KEY, trees=15, max_depth=10)
    assert set_rmse(forest)["test"]["rmse"] < 1.05 * single
    assert beats_mean(mod.boosted_regression(train, test, "features", M.TARGET, M.KEY, rounds=8, rate=0.2))


def accuracy(pred):
    return {r["split"]: r["accuracy"] for r in ev.classification_metrics(pred, M.LABELS).collect()}


@pytest.mark.parametrize("fit,which,params", [
    (mod.tree_classification, "plain", {}), (mod.forest_classification, "plain", {"trees": 10, "max_depth": 8}),
    (mod.boosted_multiclass, "plain", {"rounds": 4, "rate": 0.3}), (mod.svm_linear, "scaled", {"max_iter": 8}),
    (mod.svm_rbf, "scaled", {"max_iter": 8, "n_components": 40})])
def test_classifiers_reach_the_majority_share(request, fit, which, params):
    train, test, _ = request.getfixturevalue(which)
    pred = fit(train, test, "features", "band", M.LABELS, M.KEY, **params)
    majority = test.groupBy("band").count().agg(F.max("count") / F.sum("count")).first()[0]
    assert accuracy(pred)["test"] >= majority - 0.02


def test_registered_linear_svm_finds_every_class(spark):
    pred = M.QUERIES["svm_linear"](spark, SF).where("split = 'test'")
    shares = {r["actual"]: r["r"] for r in pred.groupBy("actual").agg(
        F.avg((F.col("actual") == F.col("predicted")).cast("int")).alias("r")).collect()}
    assert set(shares) == set(M.LABELS) and min(shares.values()) > 0.7


def test_svm_sweep_has_six_rows(scaled):
    train, test, _ = scaled
    rows = mod.svm_sweep(train, test, "features", "band", M.LABELS, M.KEY, n_components=20, max_iter=3).collect()
    assert len(rows) == 6 and {r["kernel"] for r in rows} == {"linear", "rbf"}


def test_fourier_features_approximate_the_kernel(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "k int, f array<double>")
    from pyspark.ml.functions import array_to_vector
    df = df.select("k", array_to_vector("f").alias("f"))
    apply, gamma = mod.fourier_map(df, "f", 4000, 7)
    assert abs(gamma - 1 / (4 * x.var())) < 1e-12
    z = np.array([r["z"] for r in apply(df).orderBy("k").select(vector_to_array("f").alias("z")).collect()])
    exact = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - exact).max() < 0.12


def test_gradient_against_finite_differences():
    rng = np.random.default_rng(1)
    layers = (5, 3, 1)
    x, y = rng.normal(size=(12, 4)), rng.normal(size=12)
    w = net.initial_weights(4, layers, 3) + 0.05
    g = net.gradient(x, y, w, layers)

    def loss(v):
        return ((net.forward(x, v, layers)[-1][:, 0] - y) ** 2).mean()
    for i in range(0, len(w), 3):
        e = np.zeros_like(w)
        e[i] = 1e-6
        assert abs((loss(w + e) - loss(w - e)) / 2e-6 - g[i]) < 1e-5


def test_mlp_learns_and_stops(spark, scaled):
    train, test, _ = scaled
    fit = net.mlp_fit(train, "features", M.TARGET, M.KEY, layers=(16, 8, 1), epochs=8)
    history = net.mlp_history(spark, fit).orderBy("epoch").collect()
    assert history[-1]["loss"] < history[0]["loss"] and len(history) <= 8
    best = [r for r in history if r["is_best"]][0]
    assert best["validation_loss"] == min(r["validation_loss"] for r in history)
    assert beats_mean(net.mlp_regression(train, test, "features", M.TARGET, M.KEY, fit=fit))
    stopped = net.mlp_fit(train, "features", M.TARGET, M.KEY, layers=(1, 1), epochs=6, patience=1, seed=1)
    assert len(stopped.history) <= 6


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    centers = np.array([[0, 0, 0], [8, 8, 0], [-8, 8, 4]])
    rows = [(i, (centers[i % 3] + rng.normal(size=3)).tolist(), i % 3) for i in range(300)]
    return spark.createDataFrame(rows, "k int, v array<double>, c int").repartition(4).cache()


def brute_silhouette(x, labels, power=1):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) ** power
    out = []
    for i, c in enumerate(labels):
        own = labels == c
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i][own].sum() / (own.sum() - 1)
        b = min(d[i][labels == o].mean() for o in set(labels) - {c})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_silhouette_against_brute_force(blobs):
    rows = blobs.withColumn("c", F.when(F.col("k") == 0, 9).otherwise(F.col("c")))  # and a cluster of one member
    for df in (blobs, rows):
        pdf = df.toPandas()
        want = brute_silhouette(np.stack(pdf["v"]), pdf["c"].to_numpy(), 2)
        assert abs(clu.overall_silhouette(clu.silhouette(df, "k", "v", "c")) - want) < 1e-9 and want > 0.5


def test_kmeans_keeps_the_best_restart(blobs):
    model, table = clu.kmeans_fit(blobs, "v", 3, restarts=3)
    rows = table.collect()
    assert min(r["cost"] for r in rows) == [r["cost"] for r in rows if r["chosen"]][0]
    assert model.cost == min(r["cost"] for r in rows)
    assign = clu.cluster_assignments(model, blobs, "k", "c", "v")
    assert assign.count() == 300
    ari = clu.adjusted_rand(assign.select("k", "cluster"), blobs.select("k", F.col("c").alias("cluster")), "k")
    assert ari.first()["ari"] == 1.0


def test_k_sweep(blobs):
    rows = clu.k_sweep(blobs, "k", "v", ks=(2, 3, 4), restarts=2).orderBy("k").collect()
    assert [r["k"] for r in rows] == [2, 3, 4] and rows[0]["inertia"] > rows[1]["inertia"]
    assert max(rows, key=lambda r: r["silhouette"])["k"] == 3


def exact_ward(x):
    clusters = {i: [i] for i in range(len(x))}
    heights, nxt = [], len(x)
    while len(clusters) > 1:
        best = None
        for a in clusters:
            for b in clusters:
                if a < b:
                    na, nb = len(clusters[a]), len(clusters[b])
                    d = math.sqrt(2 * na * nb / (na + nb)) * np.linalg.norm(x[clusters[a]].mean(0) - x[clusters[b]].mean(0))
                    if best is None or d < best[0]:
                        best = (d, a, b)
        d, a, b = best
        heights.append((a, b, d))
        clusters[nxt] = clusters.pop(a) + clusters.pop(b)
        nxt += 1
    return heights


def test_ward_equals_exact_ward_on_few_points(spark):
    x = np.random.default_rng(2).normal(size=(12, 3))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "k int, v array<double>")
    fit = clu.ward_fit(df, "k", "v", k=3)
    want = exact_ward(x)
    np.testing.assert_allclose([m[3] for m in fit.merges], [d for _, _, d in want])
    rows = clu.merge_heights(spark, fit, 5).collect()
    assert len(rows) == 5 and rows[-1]["size"] == 12


def test_ward_through_micro_clusters(blobs):
    assign = clu.ward_cluster(blobs, "k", "v", k=3, micro=30)
    ari = clu.adjusted_rand(assign, blobs.select("k", F.col("c").alias("cluster")), "k").first()["ari"]
    assert ari == 1.0 and assign.count() == 300


def test_principal_components(blobs):
    p = clu.pca_project(blobs, "k", "v")
    row = p.agg(F.covar_samp("pc1", "pc2").alias("c"), F.var_samp("pc1").alias("a"), F.var_samp("pc2").alias("b"),
                F.avg("pc1").alias("m")).first()
    assert abs(row["c"]) < 1e-8 and row["a"] >= row["b"] and abs(row["m"]) < 1e-9
    total = sum(np.stack(blobs.toPandas()["v"]).var(axis=0, ddof=1))
    explained = [r["explained"] for r in clu.pca_variance(blobs, "v").orderBy("component").collect()]
    np.testing.assert_allclose(explained, [row["a"] / total, row["b"] / total])


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(490)]
    rows += [(1000 + i, (rng.choice([-1, 1], 3) * (9 + i)).astype(float).tolist()) for i in range(10)]
    return spark.createDataFrame(rows, "k int, v array<double>").repartition(3).cache()


def test_isolation_forest(planted):
    forest = ano.iforest_fit(planted, "k", "v", trees=100)
    shape = forest.agg(F.countDistinct("tree_id").alias("t"), F.max("depth").alias("d")).first()
    assert shape["t"] == 100 and shape["d"] <= 8
    roots = forest.where("node_id = 0").select("size").distinct().collect()
    assert [r["size"] for r in roots] == [256]
    scored = ano.iforest_score(planted, "k", "v", forest)
    rows = scored.collect()
    assert len(rows) == 500 and all(0 < r["anomaly_score"] < 1 for r in rows)
    assert all(r["is_anomaly"] == (r["decision"] < 0) for r in rows)
    top = sorted(rows, key=lambda r: -r["anomaly_score"])[:10]
    assert {r["k"] for r in top} == set(range(1000, 1010))
    again = {r["k"]: r["anomaly_score"] for r in ano.iforest_score(
        planted.repartition(5), "k", "v", ano.iforest_fit(planted.repartition(7), "k", "v", trees=100)).collect()}
    assert all(abs(again[r["k"]] - r["anomaly_score"]) < 1e-12 for r in rows)


def test_forest_pool_for_larger_tables(spark):
    df = spark.range(20000).select("id", F.array(F.rand(1), F.rand(2)).alias("v"))
    drawn = ano.tree_samples(df, "id", "v", trees=5, sample=64, seed=1)
    counts = [r["count"] for r in drawn.groupBy("tree_id").count().collect()]
    assert counts == [64] * 5


def test_average_path():
    np.testing.assert_allclose(ano.average_path([1, 2, 256]), [0, 1, 2 * (math.log(255) + 0.5772156649015329) - 2 * 255 / 256])


def test_network_does_not_depend_on_the_layout(scaled):
    train = scaled[0].limit(1500).persist()
    runs = [net.mlp_fit(train.repartition(n), "features", M.TARGET, M.KEY, epochs=3).history for n in (3, 11)]
    for a, b in zip(*runs):
        assert a[0] == b[0] and np.allclose(a[1:3], b[1:3], rtol=1e-9)


def test_network_loss_reads_packed_rows(spark):
    """An epoch's pass over the validation rows reads whole groups, not one row after another."""
    rng = np.random.default_rng(7)
    x, y, layers = rng.normal(size=(300, 3)), rng.normal(size=300), (8, 4, 1)
    w = net.initial_weights(3, layers, 1)
    rows = spark.createDataFrame([(i, x[i].tolist(), float(y[i])) for i in range(300)], "k int, x array<double>, y double")
    packed = net._groups(rows, "k", 50)
    assert packed.count() == net.LEAST_GROUPS
    assert net._mean_loss(packed, w, layers) == pytest.approx(((net.forward(x, w, layers)[-1][:, 0] - y) ** 2).mean())


def test_network_pass_steps_by_gradient():
    rng = np.random.default_rng(8)
    x, y, layers = rng.normal(size=(70, 3)), rng.normal(size=70), (8, 4, 1)
    state = np.zeros((3, len(net.initial_weights(3, layers, 1))))
    state[0] = net.initial_weights(3, layers, 1)
    before = state.copy()
    got, steps = net.adam_pass(x, y, state, 5, layers, np.random.default_rng(2))
    order, (w, m, v) = np.random.default_rng(2).permutation(70), state
    for step, start in enumerate(range(0, 70, net.BATCH), 6):
        rows = order[start:start + net.BATCH]
        g = net.gradient(x[rows], y[rows], w, layers)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 1e-3 * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step) * m / (np.sqrt(v) + 1e-7)
    assert steps == 8 and np.allclose(got, [w, m, v]) and (state == before).all()
