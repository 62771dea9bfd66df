import hashlib
import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import boosting, discrimination, logistic, model_table, models
from riskloom.sources.staging import stage


def _scored(spark, labels, scores):
    rows = [(f"A{i}", y, p) for i, (y, p) in enumerate(zip(labels, scores))]
    return spark.createDataFrame(rows, "loan_app_id string, default_flag int, pd_score double")


def test_ks_of_separated_scores(spark):
    df = _scored(spark, [0, 1, 0, 1, 1], [0.05, 0.6, 0.2, 0.9, 0.75])
    row = discrimination.discrimination(df).first()
    assert (row.ks, row.roc_auc, row.gini) == (1.0, 1.0, 1.0)


def test_ks_of_equal_scores_is_zero(spark):
    row = discrimination.discrimination(_scored(spark, [1, 0, 0, 1, 0, 1], [0.3] * 6)).first()
    assert (row.ks, row.roc_auc, row.gini) == (0.0, 0.5, 0.0)


def test_one_class_has_no_auc(spark):
    row = discrimination.discrimination(_scored(spark, [0, 0], [0.1, 0.2])).first()
    assert row.roc_auc is None and row.bads == 0


def test_auc_and_ks_by_brute_force(spark):
    draw = random.Random(5)
    scores = [round(draw.random(), 1) for _ in range(300)]
    labels = [int(draw.random() < s) for s in scores]
    bad = [s for s, y in zip(scores, labels) if y]
    good = [s for s, y in zip(scores, labels) if not y]
    auc = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    ks = max(
        abs(sum(b >= t for b in bad) / len(bad) - sum(g >= t for g in good) / len(good)) for t in scores
    )
    row = discrimination.discrimination(_scored(spark, labels, scores)).first()
    assert row.roc_auc == pytest.approx(auc, abs=1e-12) and row.ks == pytest.approx(ks, abs=1e-12)


def test_decile_table(spark):
    scores = [(i / 60) ** 2 for i in range(60)]
    table = discrimination.decile_table(_scored(spark, [int(i >= 25) for i in range(60)], scores))
    rows = table.orderBy("pd_decile").collect()
    assert [r.pd_decile for r in rows] == list(range(1, 11))
    assert sum(r.applicants for r in rows) == 60
    assert rows[-1].observed_default_rate > rows[0].observed_default_rate
    assert all(r.avg_pd == round(r.avg_pd, 4) for r in rows)


def test_deciles_of_twelve(spark):
    table = discrimination.decile_table(_scored(spark, [0, 1] * 6, [i / 20 for i in range(12)]))
    counts = [r.applicants for r in table.orderBy("pd_decile").collect()]
    assert counts == [2, 1, 1, 1, 1, 1, 1, 1, 1, 2]


def _training(spark, n=520, seed=17):
    """Odds that rise fourfold with each unit of the first column; the second says nothing."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        x = draw.uniform(-3, 3)
        rows.append((f"A{i:04d}", int(draw.random() < 1 / (1 + 4 ** (1 - x))), x, draw.uniform(0, 90)))
    return spark.createDataFrame(
        rows, "loan_app_id string, default_flag int, score_v3 double, max_dpd double"
    )


def test_split_is_stratified_and_reproducible(spark):
    df = _training(spark)
    first = models.stratified_split(df)
    again = models.stratified_split(df.repartition(13, F.rand(4)))
    pick = lambda d: {r.loan_app_id for r in d.where("is_test").collect()}
    assert pick(first) == pick(again)
    for label, size in df.groupBy("default_flag").count().collect():
        chosen = first.where(f"is_test and default_flag = {label}").count()
        assert chosen == int(0.2 * size + 0.5)
    assert pick(models.stratified_split(df, seed=7)) != pick(first)


def test_candidates_rank_order(spark):
    df = _training(spark)
    trained = models.train(df, boosting_rounds=20)
    assert set(trained.models) == {models.LOGISTIC, models.BOOSTING}
    assert trained.features == ["score_v3", "max_dpd"]
    for name, model in trained.models.items():
        ks = discrimination.ks_statistic(models.apply_model(model, df)).first().ks
        assert ks > 0.5, name
        assert all(v == round(v, 4) for v in trained.metrics[name].values())
    table = {r.model: r for r in models.comparison(trained, df).collect()}
    assert table[trained.champion].selected
    assert table[trained.champion].roc_auc == max(r.roc_auc for r in table.values())


def _arrays(df):
    rows = df.select("score_v3", "max_dpd", "default_flag").collect()
    return np.array([[r[0], r[1]] for r in rows]), np.array([r[2] for r in rows], float)


def test_logistic_fit_is_the_penalised_optimum(spark):
    """The fitted weights minimise summed log loss plus half the squared weights on scaled inputs."""
    df = _training(spark)
    found = logistic.fit_logistic(df, ["score_v3", "max_dpd"], "l")
    x, y = _arrays(df)
    z = (x - x.mean(0)) / x.std(0)
    intercept, *weights = [n.value for n in found.nodes]
    p = 1 / (1 + np.exp(-(z @ weights + intercept)))
    assert abs(z.T @ (p - y) + weights).max() < 1e-6
    assert abs((p - y).sum()) < 1e-6
    scored = models.apply_model(found, df).select("pd_score").toPandas().pd_score
    assert np.allclose(sorted(scored), sorted(p))


def test_logistic_fit_of_hard_cases(spark):
    """Separated classes, a constant feature, two equal features, one class."""
    rows = [(f"A{i}", int(i >= 10), float(i), 3.0, 1000.0 * i) for i in range(20)]
    df = spark.createDataFrame(rows, "loan_app_id string, default_flag int, a double, b double, c double")
    found = logistic.fit_logistic(df, ["a", "b", "c"], "l")
    _, a, b, c = found.nodes
    assert b.value == 0 and a.value == pytest.approx(c.value, rel=1e-6) and 0 < a.value < 10
    alike = logistic.fit_logistic(df.where("default_flag = 1"), ["a"], "l", iterations=20)
    assert models.apply_model(alike, df).where("pd_score > 0.9").count() == 20


def _boost_by_hand(x, y, rounds, depth, rate):
    """Boosting with every distinct value as a cut; returns the probabilities."""
    score = np.full(len(y), np.log(y.sum() / (len(y) - y.sum())))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        parts = [np.ones(len(y), bool)]
        leaves = []
        for _ in range(depth):
            following = []
            for part in parts:
                best = None
                for f in range(x.shape[1]):
                    for cut in sorted(set(x[part, f]))[:-1]:
                        low, high = part & (x[:, f] <= cut), part & (x[:, f] > cut)
                        gain = low.sum() * high.sum() / part.sum() ** 2 * (g[low].mean() - g[high].mean()) ** 2
                        gain = round(gain, 12)
                        if gain > 0 and (best is None or gain > best[0]):
                            best = (gain, low, high)
                if best is None:
                    leaves.append(part)
                else:
                    following += best[1:]
            parts = following
        for part in leaves + parts:
            score[part] += rate * g[part].sum() / h[part].sum()
    return 1 / (1 + np.exp(-score))


@pytest.mark.parametrize(("rounds", "depth"), [(3, 1), (12, 2), (4, 3)])
def test_boosting_by_hand(spark, monkeypatch, rounds, depth):
    """Features of few values are cut anywhere, so the trees are those of exact splits."""
    monkeypatch.setattr(boosting, "RENEW", 5)
    df = _training(spark, 200).withColumns({"score_v3": F.round("score_v3"), "max_dpd": F.floor(F.col("max_dpd") / 9).cast("double")})
    found = boosting.fit_boosting(df, ["score_v3", "max_dpd"], "b", rounds=rounds, depth=depth, rate=0.3)
    x, y = _arrays(df)
    want = _boost_by_hand(x, y, rounds, depth, 0.3)
    scored = models.apply_model(found, df).select("pd_score").toPandas().pd_score
    assert np.allclose(scored, want, atol=1e-9)
    assert {n.tree for n in found.nodes} == set(range(rounds + 1))


def test_boosting_ranks_like_the_library(spark):
    """AUC on held-out rows within 0.01 of Spark's own boosted trees."""
    df = _training(spark, 1500)
    train, test = df.where("loan_app_id < 'A1000'"), df.where("loan_app_id >= 'A1000'")
    features = ["score_v3", "max_dpd"]
    mine = models.apply_model(boosting.fit_boosting(train, features, "b", rounds=20), test)
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    theirs = GBTClassifier(labelCol="default_flag", maxIter=20, maxDepth=3, stepSize=0.05, seed=1)
    theirs = theirs.fit(assembler.transform(train)).transform(assembler.transform(test))
    theirs = theirs.withColumn("pd_score", vector_to_array("probability")[1])
    auc = [discrimination.discrimination(d).first().roc_auc for d in (mine, theirs)]
    assert auc[0] > 0.8 and auc[0] >= auc[1] - 0.01


def test_boosting_of_one_class_and_of_constants(spark):
    df = _training(spark, 50)
    alike = boosting.fit_boosting(df.where("default_flag = 0"), ["score_v3"], "b", rounds=3)
    assert len(alike.nodes) == 1 and models.apply_model(alike, df).where("pd_score < 0.5").count() == 50
    flat = boosting.fit_boosting(df.withColumn("score_v3", F.lit(1.0)), ["score_v3"], "b", rounds=3)
    share = df.agg(F.avg("default_flag")).first()[0]
    assert len(flat.nodes) == 1
    assert models.apply_model(flat, df).first().pd_score == pytest.approx(share)


@pytest.mark.parametrize("kind", ["logistic", "boosting"])
def test_saved_model_scores_alike_both_ways(spark, tmp_path, kind):
    df = _training(spark, 150)
    features = ["score_v3", "max_dpd"]
    if kind == "logistic":
        found = logistic.fit_logistic(df, features, kind)
    else:
        found = boosting.fit_boosting(df, features, kind, rounds=25, depth=3)
    model_table.write_model(spark, found, str(tmp_path))
    again = model_table.read_model(spark, str(tmp_path))
    assert again.name == kind and again.features == features and len(again.nodes) == len(found.nodes)
    extra = df.withColumns({"n_value": F.lit(1), "tree": F.lit("x"), "_x": F.lit("y")})
    fast = {r.loan_app_id: r.pd_score for r in models.apply_model(again, extra).collect()}
    nodes = spark.read.parquet(f"{tmp_path}/nodes")
    slow = model_table.score_by_join(nodes, extra, ["loan_app_id"], features).collect()
    assert len(slow) == len(fast) == 150
    assert all(r.pd_score == pytest.approx(fast[r.loan_app_id], abs=1e-12) for r in slow)


def test_split_by_brute_force(spark):
    """The wanted rows of each class by draw and id, repeated ids at the cut included."""
    rng = random.Random(3)
    ids = [f"A{i:03d}" for i in range(90)] + ["HOT"] * 70 + [None] * 3
    rows = [(i, rng.choice([0, 0, 1]) if i != "HOT" else 1, k) for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "loan_app_id string, default_flag int, k int").repartition(6)
    key = lambda i: (int(hashlib.md5(f"42:{i or ''}".encode()).hexdigest()[:15], 16), i or "")
    for size in (0.0, 0.2, 0.5, 0.9, 1.0):
        got = models.stratified_split(df, size).collect()
        assert sorted(r.k for r in got) == list(range(len(rows)))
        for label in (0, 1):
            order = sorted((key(i) for i, y, _ in rows if y == label))
            want = order[: int(size * len(order) + 0.5)]
            assert sorted(key(r.loan_app_id) for r in got if r.is_test and r.default_flag == label) == want


def test_split_moves_no_rows(spark):
    plan = models.stratified_split(_training(spark, 60))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_champion_tie_goes_to_the_first():
    metrics = {"a": {"roc_auc": 0.7}, "b": {"roc_auc": 0.7}, "c": {"roc_auc": None}}
    assert models.choose(metrics) == "a"


def test_null_feature_is_an_error(spark):
    df = _training(spark, 20).withColumn("max_dpd", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="null"):
        models.feature_matrix(df, ["max_dpd"]).collect()
    with pytest.raises(Exception, match="null or NaN"):
        logistic.fit_logistic(df, ["max_dpd"], "l")


def test_boosting_writes_its_rows_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(boosting, "stage", lambda df, name: written.append(name) or stage(df, name))
    monkeypatch.setattr(boosting, "RENEW", 2)
    monkeypatch.setattr(boosting, "DIRECT", 1)  # sums are added up among tasks
    monkeypatch.setattr(boosting, "TASK_ROWS", 10)
    rows = [(i % 2, float(i % 7), float(i * i % 11)) for i in range(80)]
    df = spark.createDataFrame(rows, "default_flag int, a double, b double").repartition(4)
    many = boosting.fit_boosting(df, ["a", "b"], "b", rounds=6)
    assert written == ["binned"]
    monkeypatch.setattr(boosting, "DIRECT", 64)
    monkeypatch.setattr(boosting, "RENEW", 100)
    one = boosting.fit_boosting(df.coalesce(1), ["a", "b"], "b", rounds=6)
    for n, m in zip(many.nodes, one.nodes, strict=True):
        assert (n.tree, n.node, n.feature, n.threshold) == (m.tree, m.node, m.feature, m.threshold)
        assert n.value == m.value or n.value == pytest.approx(m.value, abs=1e-12)


def test_many_trees_need_no_code_of_their_own(spark):
    """200 trees as one expression were more code than the compiler takes."""
    nodes = [model_table.Node(0, 0, value=-1.0), model_table.Node(-1, 0, "b", mean=1.0, deviation=2.0, value=0.5)]
    for t in range(1, 201):
        for at in range(7):
            split = {"feature": "ab"[at % 2], "threshold": (t * 7 + at) % 13 + 0.5, "below": 2 * at + 1, "above": 2 * at + 2}
            nodes.append(model_table.Node(t, at, **split))
        nodes += [model_table.Node(t, at, value=((t * at) % 9 - 4) / 100 + 1 / 700) for at in range(7, 15)]
    model = model_table.Model("m", ["a", "b"], nodes)
    df = spark.createDataFrame([(i, i % 14, float(i % 5)) for i in range(40)], "id int, a int, b double")
    joined = model_table.score_by_join(spark.createDataFrame([tuple(vars(n).values()) for n in nodes], model_table.NODE_SCHEMA), df, ["id"], ["a", "b"])
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        scored = model_table.apply_model(model, df).collect()
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
    expected = {r.id: r.pd_score for r in joined.collect()}
    assert len(scored) == 40 and all(r.pd_score == pytest.approx(expected[r.id], abs=1e-12) for r in scored)
