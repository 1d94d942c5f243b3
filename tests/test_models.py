"""Models, search, feature sets, jobs, stream scoring."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortwise.models import search, zoo
from cohortwise.models.frame import FOLD, LABEL
from cohortwise.plans import jobs
from cohortwise.plans.features import AdvancedFeatures, BasicFeatures, EnhancedFeatures
from cohortwise.plans.store import load_fitted, save_fitted
from cohortwise.streaming.scoring import score_stream, write_stream
from passengers import passengers

LOGISTIC = zoo.ModelSpec("LogisticRegression", "logistic", {"maxIter": 20})
TREE = zoo.ModelSpec("DecisionTree", "tree", {"maxDepth": 3})


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(size=(200, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(scale=0.3, size=200) > 0).astype(int)
    rows = [(i, *map(float, x[i]), int(y[i])) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double, label int")
    return search.folded_frame(df, ["a", "b", "c", "d"], "label", "id", 4)


SPECS = [
    zoo.ModelSpec("forest", "random_forest", {"numTrees": 5}), LOGISTIC, TREE, zoo.ModelSpec("nb", "gaussian_nb"),
    zoo.ModelSpec("gbt", "boosted_trees", {"maxIter": 3}), zoo.ModelSpec("ada", "ada_boost", {"rounds": 5, "checkpoint_every": 2}),
    zoo.ModelSpec("svc", "svc", {"components": 64, "maxIter": 20}), zoo.ModelSpec("linear", "svc", {"kernel": "linear", "maxIter": 20}),
    zoo.ModelSpec("knn", "nearest", {"k": 7}), zoo.ModelSpec("extra", "extra_trees", {"numTrees": 12, "maxDepth": 4}), zoo.ModelSpec("prototypes", "prototypes", {"k": 3, "prototypes": 15, "maxIter": 3}),
]


@pytest.mark.parametrize("spec", SPECS, ids=lambda s: s.name)
def test_each_kind_learns_and_survives_saving(spark, frame, spec, tmp_path):
    train, test = frame.filter(F.col(FOLD) != 0), frame.filter(F.col(FOLD) == 0)
    model = zoo.fit(spec, train)
    scored = model.score(test)
    assert search.accuracy(scored) > 0.7
    assert scored.filter("prob < 0 or prob > 1 or prob is null").count() == 0
    model.save(spark, str(tmp_path / "m"))
    again = zoo.load(spark, str(tmp_path / "m")).score(test).select("id", F.col("prob").alias("q"))
    assert scored.join(again, "id").filter(F.abs(F.col("prob") - F.col("q")) > 1e-9).count() == 0


def test_knn_equals_brute_force(frame):
    train, test = frame.filter(F.col(FOLD) != 0).toPandas(), frame.filter(F.col(FOLD) == 0)
    got = zoo.fit(SPECS[8], frame.filter(F.col(FOLD) != 0)).score(test).toPandas()
    x, y = np.stack(train["values"]), train[LABEL].to_numpy()
    for _, row in got.iterrows():
        d = np.sqrt(((x - np.array(row["values"])) ** 2).sum(axis=1))
        near = np.argsort(d)[:7]
        w = 1 / d[near]
        assert row["prob"] == pytest.approx((w * y[near]).sum() / w.sum())


def test_failed_model_is_left_out(frame):
    models = zoo.fit_all([LOGISTIC, zoo.ModelSpec("broken", "tree", {"maxDepth": -1})], frame)
    assert list(models) == ["LogisticRegression"] and list(models.failed) == ["broken"]
    _, table = search.tune(models, frame, {"LogisticRegression": {"C": [1.0]}}, 4)
    assert [(r["model"], r["failed"] is None) for r in table.orderBy("model").collect()] == [("LogisticRegression", True), ("broken", False)]


def test_faults_of_the_job_are_raised(frame, monkeypatch):
    def lost(spec, frame):
        raise RuntimeError("executor lost")

    monkeypatch.setitem(zoo.CUSTOM, "svc", lost)
    with pytest.raises(RuntimeError):
        zoo.fit_all([SPECS[6]], frame)


def test_more_points_than_are_sent_are_joined(spark, frame, tmp_path):
    sent, joined = zoo.fit(SPECS[8], frame), zoo.fit(zoo.ModelSpec("knn", "nearest", {"k": 7, "fit_points": 50}), frame)
    assert isinstance(joined, zoo.NeighbourFitted) and joined.points.count() == 200
    joined.save(spark, str(tmp_path / "joined"))
    want = {r["id"]: r["prob"] for r in sent.score(frame).collect()}
    for model in (joined, zoo.load(spark, str(tmp_path / "joined"))):
        got = {r["id"]: r["prob"] for r in model.score(frame).collect()}
        assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i]) for i in want)


def test_cross_validation_is_reproducible(frame):
    a, b = search.cross_validate(LOGISTIC, frame, 4), search.cross_validate(LOGISTIC, frame, 4)
    assert a == b and len(a) == 4
    s = search.summary(a)
    assert s["cv_min"] <= s["cv_mean"] <= s["cv_max"] and s["cv_std"] == pytest.approx(np.std(a))


def test_search(frame):
    models = zoo.fit_all([LOGISTIC, TREE, SPECS[8]], frame)
    grids = {"DecisionTree": {"maxDepth": [1, 3]}, "knn": {"k": [3, 7]}}
    tuned, table = search.tune(models, frame, grids, 4)
    rows = table.collect()
    assert len(rows) == 4 and sum(r["best"] for r in rows) == 2
    assert tuned["LogisticRegression"] is models["LogisticRegression"]
    _, sampled = search.tune({"DecisionTree": models["DecisionTree"]}, frame, search.WIDE_GRIDS, 4, n_iter=2)
    assert sampled.count() == 2


def test_ensembles_and_importance(spark, frame, tmp_path):
    final = zoo.ModelSpec("Final", "logistic", {"maxIter": 20})
    stacked = search.fit_stacked("StackingEnsemble", [LOGISTIC, TREE], final, frame, "id", 4)
    assert search.accuracy(stacked.score(frame)) > 0.8
    voting = search.Voting(zoo.ModelSpec("VotingEnsemble", "voting"), zoo.fit_all([LOGISTIC, TREE], frame))
    assert search.accuracy(voting.score(frame)) > 0.8
    for model in (stacked, voting):
        model.save(spark, str(tmp_path / model.spec.kind))
        again = zoo.load(spark, str(tmp_path / model.spec.kind)).score(frame).select("id", F.col("prob").alias("q"))
        assert model.score(frame).join(again, "id").filter(F.abs(F.col("prob") - F.col("q")) > 1e-9).count() == 0
    top = search.importance_table(spark, zoo.fit(SPECS[0], frame), ["a", "b", "c", "d"], 2).collect()
    assert top[0]["feature"] == "a" and len(top) == 2
    with pytest.raises(ValueError):
        zoo.fit(LOGISTIC, frame).importances(["a"])


def test_model_store(spark, frame, tmp_path):
    root = str(tmp_path / "store")
    search.save_best(spark, zoo.fit(LOGISTIC, frame), root, 0.8, 0.8, False)
    search.save_best(spark, zoo.fit(TREE, frame), root, 0.7, 0.8, True)
    assert search.latest_model(spark, root).spec.name == "DecisionTree"
    assert search.latest_model(spark, root, "LogisticRegression").spec.name == "LogisticRegression"
    with pytest.raises(FileNotFoundError):
        search.latest_model(spark, root, "none")


@pytest.fixture(scope="module")
def people(spark):
    return passengers(spark)


@pytest.mark.parametrize("kind", [BasicFeatures, EnhancedFeatures, AdvancedFeatures])
def test_feature_sets(spark, people, kind, tmp_path):
    train, score = people.filter("PassengerId <= 180"), people.filter("PassengerId > 180").drop("Survived")
    with pytest.raises(ValueError):
        kind().transform(people)
    features = kind().fit(train)
    a, b = features.transform(train), features.transform(score)
    assert a.columns == ["id", "label", *features.names] and b.columns == ["id", *features.names]
    assert (a.count(), b.count()) == (180, 60)
    assert dict(a.dtypes)["Age"] == dict(b.dtypes)["Age"] == "double"
    nulls = [F.sum(F.col(f"`{c}`").isNull().cast("int")) for c in features.names]
    assert set(b.agg(*nulls).first()) == {0}
    save_fitted(features, str(tmp_path / "f"), spark)
    again = load_fitted(str(tmp_path / "f"), spark).transform(score)
    assert again.exceptAll(b).count() == 0


def test_basic_features_scale_on_training_rows(people):
    features = BasicFeatures().fit(people)
    row = features.transform(people).agg(F.avg("Age"), F.stddev_pop("Age"), F.max("Title_Rare"), F.min("FamilySize")).first()
    assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(1) and row[2] == 1 and row[3] == 1


def test_jobs_end_to_end(spark, people, tmp_path):
    root, train, score = str(tmp_path / "job"), people.filter("PassengerId <= 180"), people.filter("PassengerId > 180").drop("Survived")
    done = jobs.run_all(train, score, root, str(tmp_path / "out"), specs=[LOGISTIC, TREE], k=2)
    assert done["train"]["accuracy"] > 0.6
    assert {r["check"]: r["passed"] for r in done["predict"]["checks"].collect()}["compliant"]
    assert done["predict"]["summary"].first()["total"] == 60
    assert done["evaluate"]["metrics"].first()["accuracy"] == pytest.approx(done["train"]["accuracy"])
    more = people.filter("PassengerId <= 180").unionByName(people.filter("PassengerId > 180"))
    held = spark.read.parquet(f"{root}/held_out")
    assert jobs.evaluate(more, root)["metrics"].first()["accuracy"] == done["evaluate"]["metrics"].first()["accuracy"] and held.count() == 36
    whole = jobs.run_complete_training(train, f"{root}/all", jobs.Roles(), [LOGISTIC, TREE], {"DecisionTree": {"maxDepth": [2]}}, None, LOGISTIC, k=2)
    assert search.latest_model(spark, f"{root}/all/models").spec.name == whole["model"]
    assert whole["results"].filter("cv_mean IS NULL").count() == 0
    assert done["explore"]["overall"].first()["total"] == 180


def test_stream_scoring_equals_batch(spark, people, tmp_path):
    root, train = str(tmp_path / "job"), people.filter("PassengerId <= 180")
    jobs.train(train, root, specs=[LOGISTIC], k=2)
    people.drop("Survived").repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(people.drop("Survived").schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = write_stream(score_stream(stream, root), str(tmp_path / "scored"), str(tmp_path / "cp"))
    query.awaitTermination(120)
    streamed = spark.read.parquet(str(tmp_path / "scored"))
    batch = jobs.score_table(people.drop("Survived"), root)
    assert streamed.count() == 240
    assert batch.join(streamed.withColumnRenamed("prob", "q"), "id").filter(F.abs(F.col("prob") - F.col("q")) > 1e-9).count() == 0


def test_ensemble_hybrid_and_comparison(spark, people):
    train, score = people.filter("PassengerId <= 180"), people.filter("PassengerId > 180").drop("Survived")
    out = jobs.ensemble_predict(train, score, specs=[LOGISTIC, TREE], top_k=1, k=2)
    assert out["predictions"].count() == 60 and out["cv"].count() == 2
    hybrid = jobs.hybrid_predict(train, score, specs=[LOGISTIC], k=2)
    rows = hybrid["predictions"].collect()
    assert len(rows) == 60 and all(r["prediction"] in (0, 1) for r in rows)
    assert all((r["prob"] is None) == (r["rule_name"] is not None) for r in rows)
    table = {r["feature_set"]: r for r in jobs.compare_feature_sets(people, spec=TREE, k=2).collect()}
    assert len(table) == 3 and min(r["gain"] for r in table.values()) == 0.0


def test_job_queries_use_the_declared_sets(monkeypatch):
    import inspect

    from cohortwise.models import search, zoo
    from cohortwise.plans import jobs
    from cohortwise.queries import learned

    calls = {}

    class Stop(Exception):
        pass

    def recorded(name, signature):
        def call(*args, **kwargs):
            bound = signature.bind(*args, **kwargs)
            bound.apply_defaults()
            calls[name] = bound.arguments
            raise Stop

        return call

    for module, name in ((jobs, "run_complete_training"), (jobs, "train"), (jobs, "ensemble_predict"), (jobs, "hybrid_predict"), (search, "fit_stacked"), (zoo, "fit_all")):
        monkeypatch.setattr(module, name, recorded(name, inspect.signature(getattr(module, name))))
    monkeypatch.setattr(learned, "_train_and_score", lambda spark, sf: (None, None))
    monkeypatch.setattr(learned, "scratch_path", lambda spark, label: "")
    monkeypatch.setattr(learned, "small_table", lambda *a: None)
    monkeypatch.setattr(learned, "_small", lambda spark, sf, k=5: None)
    monkeypatch.setattr(learned.F, "col", lambda name: 0)

    class Frame:
        def withColumn(self, *a):
            return self

    monkeypatch.setattr(learned, "_held_out", lambda frame: (Frame(), None))

    def of(query, name):
        with pytest.raises(Stop):
            getattr(learned, query)(None, None)
        return calls[name]

    done = of("train_complete", "run_complete_training")
    assert (done["specs"], done["grids"], done["n_iter"], done["k"]) == (zoo.BASE_MODELS, search.WIDE_GRIDS, None, 5)
    for query in ("score_table", "job_evaluate"):
        assert (of(query, "train")["specs"], calls["train"]["k"]) == (zoo.BASE_MODELS, 5)
    assert of("predict_and_write", "train")["specs"][0] in zoo.BASE_MODELS and calls["train"]["k"] == 5
    assert (of("job_ensemble", "ensemble_predict")["specs"], calls["ensemble_predict"]["k"]) == (zoo.ENSEMBLE_MODELS, 5)
    assert (of("job_hybrid", "hybrid_predict")["specs"], calls["hybrid_predict"]["k"]) == (zoo.FINAL_ENSEMBLE_MODELS, 7)
    assert (of("stacking_oof", "fit_stacked")["bases"], calls["fit_stacked"]["k"]) == (zoo.BASE_MODELS, 5)
    for query in ("evaluate_models", "voting_soft"):
        assert of(query, "fit_all")["specs"] == zoo.BASE_MODELS


def test_bins_are_found_once_for_all_models_of_a_fold(frame, monkeypatch):
    from cohortwise.models import forest, stumps

    found, cells, edges, real = [], [], stumps.bin_edges, forest.cells_of
    monkeypatch.setattr(stumps, "bin_edges", lambda *a: found.append(a) or edges(*a))
    monkeypatch.setattr(forest, "cells_of", lambda *a: cells.append(a) or real(*a))
    specs = [
        zoo.ModelSpec("forest", "random_forest", {"numTrees": 2, "maxDepth": 3}), zoo.ModelSpec("gbt", "boosted_trees", {"maxIter": 2, "maxDepth": 3}),
        zoo.ModelSpec("other", "random_forest", {"numTrees": 3, "maxDepth": 2}),
    ]
    models = search.fit_folds(specs, frame, [0, 1])
    assert len(models) == 6 and len(found) == len(cells) == 2
    assert search.accuracy(models["gbt", 1].score(frame)) > 0.7


def test_margins_from_one_step_equal_those_of_spark(frame):
    from pyspark.ml.functions import vector_to_array

    for params in ({"kernel": "rbf"}, {"kernel": "linear"}):
        model = zoo.fit(zoo.ModelSpec("svc", "svc", {**params, "maxIter": 5}), frame)
        mapped = zoo._mapped(model.spec, frame, model.gamma, model.size)
        want = {r["id"]: r["m"] for r in model.svm.transform(mapped).select("id", vector_to_array("rawPrediction")[1].alias("m")).collect()}
        got = {r["id"]: r["__margin"] for r in model.margins(frame).collect()}
        assert got == pytest.approx(want, rel=1e-9, abs=1e-12)
