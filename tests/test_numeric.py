import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from msgrisk.functions import scoring
from msgrisk.operators import clustering as cl, imbalance, metrics, projection, sampling
from msgrisk.operators import neighbours
from msgrisk.operators.neighbours import nearest_neighbours
from msgrisk.operators import pairwise
from msgrisk.operators.pairwise import silhouettes

RNG = np.random.default_rng(1)
N = 150
# A third of the rows are copies of one row.
X = np.vstack([np.repeat(RNG.normal(size=(1, 6)), N // 3, 0), RNG.normal(size=(N - N // 3, 6))])
C = np.arange(N) % 3
D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(2))


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(
        [(i, int(C[i]), X[i].tolist()) for i in range(N)], "id bigint, c int, x array<double>"
    ).persist()


@pytest.mark.parametrize("probability, risk, hits, score, band", [
    (0.9, 1.0, 7, 0.94, "critical"), (0.5, 1.0, 5, 0.7, "high"), (0.5, 1.0, 0, 0.5, "medium"),
    (0.1, 1.0, 1, 0.3, "low"), (2.0, 1.0, 0, 1.0, "critical"),
])
def test_scores(spark, probability, risk, hits, score, band):
    df = spark.createDataFrame([(probability, risk, hits)], "p double, c double, h int")
    row = df.select(scoring.alert(F.col("p"), F.col("c"), F.col("h"), F.lit("Cluster 2")).alias("a")).first().a
    assert row.score == pytest.approx(score) and row.severity == band
    assert row.reasons == ["Cluster 2"] + ([f"Matched {hits} suspicious association rules"] if hits else [])


@pytest.mark.parametrize("block_rows", [16, 2048])
@pytest.mark.parametrize("sparse", [False, True])
def test_neighbours_against_brute_force(points, block_rows, sparse):
    df = points.withColumn("x", array_to_vector("x")) if sparse else points
    found = nearest_neighbours(df, "id", "x", 4, block_rows=block_rows).collect()
    got = {(r.id, r.nn_rank): r.nn_id for r in found}
    for i in range(N):
        order = sorted((round(D[i, j], 9), j) for j in range(N) if j != i)[:4]
        assert [got[i, r] for r in range(1, 5)] == [j for _, j in order]


def test_neighbours_within_groups(points):
    found = nearest_neighbours(points, "id", "x", 2, group="c", block_rows=16).collect()
    assert len(found) == 2 * N and all(C[r.id] == C[r.nn_id] for r in found)


def test_neighbours_below_all_pairs(spark):
    """Clusters far apart, one of them of 500 copies: most distances are never computed, none is missed."""
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(size=(1500, 3)) + 40 * rng.integers(0, 6, size=(1500, 3)), np.tile([[7.0, 7.0, 7.0]], (500, 1))])
    ids = rng.permutation(len(x))
    df = spark.createDataFrame([(int(i), r.tolist()) for i, r in zip(ids, x)], "id bigint, x array<double>")
    count = spark.sparkContext.accumulator(0)
    got = {(r.id, r.nn_rank): r.nn_id for r in nearest_neighbours(df, "id", "x", 3, block_rows=16, count=count).collect()}
    away = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), 9)
    np.fill_diagonal(away, np.inf)
    for at in range(len(x)):
        order = np.lexsort((ids, away[at]))[:3]
        assert [got[ids[at], r] for r in (1, 2, 3)] == ids[order].tolist()
    assert 0 < count.value < len(x) ** 2 / 10


def test_neighbours_travel_to_blocks_not_buckets(spark, monkeypatch):
    """Where no bound helps, points visit nearly all buckets but are sent to few blocks. Rows without a vector hide nothing."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1200, 24))
    stored = {}

    def keep(df, name, inner=neighbours.materialised):
        return stored.setdefault(name, inner(df, name))

    monkeypatch.setattr(neighbours, "materialised", keep)
    rows = [(i, r.tolist()) for i, r in enumerate(x)] + [(len(x) + i, None) for i in range(3)]
    df = spark.createDataFrame(rows, "id bigint, x array<double>")
    got = {(r.id, r.nn_rank): r.nn_id for r in nearest_neighbours(df, "id", "x", 3, block_rows=100).collect()}
    away = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), 9)
    np.fill_diagonal(away, np.inf)
    for at in range(len(x)):
        assert [got[at, r] for r in (1, 2, 3)] == np.lexsort((np.arange(len(x)), away[at]))[:3].tolist()
    buckets = stored["buckets"].select("bucket").distinct().count()
    sent, = stored["first-round"].selectExpr("max(size(blocks))").first()
    assert buckets > 24 and sent <= 13


def test_neighbours_of_copies_alone(spark):
    df = spark.createDataFrame([(i, 0 if i < 5 else 1, [1.0, 2.0] if i < 5 else [float(i), 0.0]) for i in range(9)], "id bigint, c int, x array<double>")
    got = sorted((r.id, r.nn_rank, r.nn_id, round(r.distance, 6)) for r in nearest_neighbours(df, "id", "x", 3, group="c").collect())
    assert got[:6] == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 3, 0.0), (1, 1, 0, 0.0), (1, 2, 2, 0.0), (1, 3, 3, 0.0)]
    assert got[15:18] == [(5, 1, 6, 1.0), (5, 2, 7, 2.0), (5, 3, 8, 3.0)] and len(got) == 27


def test_too_few_rows_for_neighbours(points):
    with pytest.raises(ValueError):
        nearest_neighbours(points.filter("id < 3"), "id", "x", 5)


def brute_silhouette(labels):
    s = []
    for i in range(N):
        own = labels == labels[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = D[i, own].sum() / (own.sum() - 1)
        b = min(D[i, labels == o].mean() for o in set(labels) if o != labels[i])
        s.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return np.mean(s)


@pytest.mark.parametrize("block_rows", [16, 2048])
def test_silhouettes_against_brute_force(points, block_rows):
    alone = np.where(np.arange(N) == 7, 9, C)
    df = points.withColumn("d", F.when(F.col("id") == 7, 9).otherwise(F.col("c")))
    got = {r.clustering: r.silhouette for r in silhouettes(df, "id", "x", ["c", "d"], block_rows).collect()}
    assert got["c"] == pytest.approx(brute_silhouette(C)) and got["d"] == pytest.approx(brute_silhouette(alone))


def test_blocks_grow_with_the_table(spark):
    for n in (60_000, 600_000):
        assert pairwise._block_count(n, pairwise._block_rows(n, 64), 8) == 16
    # Wide rows stay in small blocks, and beyond 32 MB narrow ones get more blocks.
    assert pairwise._block_rows(600_000, 5010) == pairwise.BLOCK_ROWS
    assert pairwise._block_count(3_000_000, pairwise._block_rows(3_000_000, 64), 8) == 46
    # Four blocks of two tiles.
    n, rng = 3000, np.random.default_rng(5)
    x, c = np.round(rng.normal(size=(n, 3)), 6), rng.integers(0, 3, n)
    df = spark.createDataFrame([(i, a, int(b)) for i, (a, b) in enumerate(zip(x.tolist(), c))], "id bigint, x array<double>, c int")
    total = np.concatenate([
        np.sqrt(((part[:, None] - x[None]) ** 2).sum(2)) @ np.eye(3)[c] for part in np.array_split(x, 10)
    ])
    sizes = np.bincount(c)
    a = total[np.arange(n), c] / (sizes[c] - 1)
    b = np.where(np.eye(3)[c] > 0, np.inf, total / sizes).min(1)
    got = silhouettes(df, "id", "x", ["c"]).first().silhouette
    assert got == pytest.approx(np.mean((b - a) / np.maximum(a, b)))


def test_quality(points):
    spread = cl.dispersion(points, "c", "x")
    means = np.array([X[C == c].mean(0) for c in range(3)])
    s = np.array([np.sqrt(((X[C == c] - means[c]) ** 2).sum(1)).mean() for c in range(3)])
    m = np.sqrt(((means[:, None] - means[None]) ** 2).sum(2))
    expected = np.mean([max((s[i] + s[j]) / m[i, j] for j in range(3) if j != i) for i in range(3)])
    assert cl.davies_bouldin(spread, "c").first().value == pytest.approx(expected)
    within = sum(((X[C == c] - means[c]) ** 2).sum() for c in range(3))
    between = sum((C == c).sum() * ((means[c] - X.mean(0)) ** 2).sum() for c in range(3))
    assert cl.calinski_harabasz(spread).first().value == pytest.approx(between * (N - 3) / (within * 2))


def test_kmeans_keeps_the_best_restart(points):
    df = points.withColumn("features", array_to_vector("x")).persist()
    best = cl.fit_kmeans(df, 3, restarts=4)
    single = [cl.fit_kmeans(df, 3, restarts=1, seed=42 + i).summary.trainingCost for i in range(4)]
    assert best.summary.trainingCost == pytest.approx(min(single))
    models = cl.fit_kmeans_many(df, cl.sweep_values([2, 3, 500], N), restarts=2)
    sweep = cl.k_sweep(df, models, "id", exact=True).orderBy("k").collect()
    assert [r.k for r in sweep] == [2, 3]
    for r in sweep:
        labels = np.array([x.cluster_id for x in models[r.k].transform(df).orderBy("id").collect()])
        assert r.silhouette == pytest.approx(brute_silhouette(labels))
        centres = np.array(models[r.k].clusterCenters())
        assert r.inertia == pytest.approx(((X - centres[labels]) ** 2).sum())


@pytest.mark.parametrize("wanted, rows, k", [(5, 100, 5), (5, 4, 3), (5, 2, 2), (5, 1, 2)])
def test_effective_k(wanted, rows, k):
    assert cl.effective_k(wanted, rows) == k


def test_smote_balances_and_stays_on_lines(points):
    df = points.filter("c = 0 OR id < 40").withColumnRenamed("c", "y").withColumn("features", array_to_vector("x"))
    counts = {r.y: r["count"] for r in df.groupBy("y").count().collect()}
    assert len(set(counts.values())) > 1
    out = imbalance.smote(df, key="id").groupBy("y").count().collect()
    assert {r["count"] for r in out} == {max(counts.values())}
    made = imbalance.synthetic_rows(df, "y", "id", "features").collect()
    for r in made:
        a, b, v = X[r.id], X[r.nn_id], np.array(r.features)
        assert np.linalg.norm(a - v) + np.linalg.norm(v - b) == pytest.approx(np.linalg.norm(a - b), abs=1e-9)


@pytest.mark.parametrize("scores, truth", [
    ([0.1, 0.4, 0.4, 0.8, 0.9], [0, 0, 1, 1, 0]), ([0.5] * 4, [0, 1, 0, 1]), ([0.2, 0.3], [1, 1]),
])
def test_auc(spark, scores, truth):
    df = spark.createDataFrame(list(zip(truth, scores)), "y int, fraud_probability double")
    pos, neg = ([s for s, t in zip(scores, truth) if t == k] for k in (1, 0))
    expected = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]) if pos and neg else None
    got = metrics.roc_auc(df).first().auc
    assert got == (pytest.approx(expected) if expected is not None else None)


def test_report_with_an_unpredicted_class(spark):
    df = spark.createDataFrame([(0, 0)] * 6 + [(0, 1)] * 2 + [(2, 0)], "y int, pred int")
    confusion = metrics.confusion_matrix(df)
    assert confusion.count() == 9 and confusion.agg(F.sum("n")).first()[0] == 9
    got = {(r.label, r.metric): r.value for r in metrics.classification_report(confusion).collect()}
    assert got["0", "precision"] == pytest.approx(6 / 7) and got["2", "f1-score"] == 0 and got["1", "recall"] == 0
    assert got["accuracy", "accuracy"] == pytest.approx(6 / 9)
    assert got["weighted avg", "recall"] == pytest.approx(6 / 9)


@pytest.mark.parametrize("size", [0, 1, 17, 1000, 5000])
def test_capped_sample_size(spark, size):
    df = spark.range(1000).withColumnRenamed("id", "msg_id")
    assert sampling.capped_sample(df, size).count() == min(size, 1000)


def test_stratified_split_is_exact_for_a_hot_class(spark):
    df = spark.range(1003).select(F.col("id").alias("msg_id"), F.when(F.col("id") < 30, 1).otherwise(0).alias("y"))
    counts = {(r.y, r.fold): r["count"] for r in sampling.stratified_split(df).groupBy("y", "fold").count().collect()}
    assert counts == {(0, "test"): 195, (0, "train"): 778, (1, "test"): 6, (1, "train"): 24}


def test_projections(points):
    got = np.array([[r.pc1, r.pc2] for r in projection.pca_coordinates(points, "id", "x").orderBy("id").collect()])
    centred = X - X.mean(0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    assert np.abs(got) == pytest.approx(np.abs(centred @ vt[:2].T), abs=1e-8)
    coords, values = projection.svd_coordinates(points, "id", "x", 4)
    _, s, vt = np.linalg.svd(X, full_matrices=False)
    assert values == pytest.approx(s[:4])
    got = np.array([r.coords for r in coords.orderBy("id").collect()])
    assert np.abs(got) == pytest.approx(np.abs(X @ vt[:4].T), abs=1e-6)


def test_mean_term_weights(spark):
    """Centres of sparse vectors in long form: no row per entry, no zeros, rows without a cluster left out."""
    rows = [(0, [1.0, 0.0, 3.0]), (0, [3.0, 0.0, 0.0]), (1, [0.0, 0.0, 0.0]), (2, [0.0, 5.0, 0.0]), (None, [9.0, 9.0, 9.0])]
    df = spark.createDataFrame(rows, "cluster_id int, x array<double>").select("cluster_id", array_to_vector("x").alias("x"))
    names = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "idx int, term string")
    found = cl.mean_term_weights(df, names, "x")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1
    assert sorted(tuple(r) for r in found.collect()) == [(0, "a", 2.0), (0, "c", 1.5), (2, "b", 5.0)]


def test_rows_travel_once_per_block_and_in_few_bytes(spark, monkeypatch):
    n, whole, seen = 64, pairwise.per_block_pair, []

    def watched(*args):
        seen.append(whole(*args))
        return seen[-1]

    monkeypatch.setattr(pairwise, "per_block_pair", watched)
    x = np.random.default_rng(6).normal(size=(n, 4))
    x[::2] = x[::2].astype(np.float32)
    c = np.arange(n) % 5
    df = spark.createDataFrame([(i, a, int(b)) for i, (a, b) in enumerate(zip(x.tolist(), c))], "id bigint, x array<double>, c int")
    got = silhouettes(df, "id", "x", ["c"], 16).first().silhouette
    # Four blocks meet each row, whatever the number of clusters.
    assert seen[0].count() == 4 * n
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) @ np.eye(5)[c]
    sizes = np.bincount(c)
    a, b = d[np.arange(n), c] / (sizes[c] - 1), np.where(np.eye(5)[c] > 0, np.inf, d / sizes).min(1)
    assert got == pytest.approx(np.mean((b - a) / np.maximum(a, b)), abs=1e-14)
    rows = pairwise._halved(pairwise.packed(df, "x")).orderBy("id").toPandas()
    assert rows["_single"].notna().tolist() == [i % 2 == 0 for i in range(n)] and (rows["_x"].isna() == rows["_single"].notna()).all()
    assert (pairwise.matrix(rows, 4) == x).all()
