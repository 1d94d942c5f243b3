"""Models, search, ensembles and jobs, with the model sets' own parameters and five folds.

Checks of one stored model (`model_roundtrip`, `predict_and_write`, `feature_importance`) take single models of the
base set, `compare_feature_sets` its tree; `grid_search` and `random_search` take two models each with their whole grids.
"""

from pyspark.sql import functions as F

from cohortwise.models import search, zoo
from cohortwise.models.frame import FOLD, LABEL, model_frame
from cohortwise.operators.metrics import binary_metrics
from cohortwise.operators.split import stratified_split
from cohortwise.plans import jobs
from cohortwise.plans.features import AdvancedFeatures, BasicFeatures, EnhancedFeatures
from cohortwise.queries.fixtures import fx_items, fx_passengers, over
from cohortwise.queries.registry import query
from cohortwise.session import materialize, scratch_path, small_table

_NUMBERS = ["klass", "woman", "companions", "age", "fare"]
_BASE = {spec.name: spec for spec in zoo.BASE_MODELS}
_FINAL = zoo.ModelSpec("Final", "logistic", {"maxIter": 100, "C": 1.0})


def _small(spark, sf, k=5):
    """A narrow frame of all passengers with fold numbers."""
    df = fx_passengers(spark, sf).select(
        F.col("PassengerId").alias("id"),
        F.col("Pclass").alias("klass"),
        (F.col("Sex") == "female").cast("int").alias("woman"),
        (F.col("SibSp") + F.col("Parch")).alias("companions"),
        (F.coalesce(F.col("Age"), F.lit(30.0)) / 80).alias("age"),
        (F.coalesce(F.col("Fare"), F.lit(32.0)) / 10000).alias("fare"),
        F.col("Survived").alias("label"),
    )
    return search.folded_frame(df, _NUMBERS, "label", "id", k)


def _held_out(frame):
    return frame.filter(F.col(FOLD) != 0), frame.filter(F.col(FOLD) == 0)


_V1 = """WITH a AS (SELECT Pclass, Sex, quantile_cont(Age, 0.5) AS m FROM fx_passengers GROUP BY 1, 2),
f AS (SELECT Pclass, Embarked, quantile_cont(Fare, 0.5) AS m FROM fx_passengers WHERE Embarked IS NOT NULL GROUP BY 1, 2),
p AS (SELECT x.*, coalesce(x.Age, a.m) AS age1, coalesce(x.Fare, f.m) AS fare1 FROM fx_passengers x
  LEFT JOIN a ON x.Pclass = a.Pclass AND x.Sex = a.Sex LEFT JOIN f ON x.Pclass = f.Pclass AND x.Embarked = f.Embarked),
k AS (SELECT Pclass, quantile_cont(fare1, 0.5) AS m FROM p GROUP BY 1),
q AS (SELECT p.*, coalesce(age1, (SELECT quantile_cont(age1, 0.5) FROM p)) AS age2, coalesce(fare1, k.m) AS fare2,
  coalesce(Embarked, (SELECT Embarked FROM fx_passengers WHERE Embarked IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS port,
  SibSp + Parch + 1 AS fsize, coalesce(substr(Cabin, 1, 1), 'Unknown') AS deck, CASE WHEN title = 'Col' THEN 'Rare' ELSE title END AS t
  FROM p LEFT JOIN k ON p.Pclass = k.Pclass),
s AS (SELECT avg(age2) AS ma, stddev_pop(age2) AS sa, avg(fare2) AS mf, stddev_pop(fare2) AS sf, avg(fare2 / fsize) AS mp, stddev_pop(fare2 / fsize) AS sp FROM q)
SELECT PassengerId AS id, Survived AS label, Pclass, round((age2 - ma) / sa, 6) AS Age, SibSp, Parch, round((fare2 - mf) / sf, 6) AS Fare,
""" + ",\n".join(
    [f"CAST(Sex = '{v}' AS INT) AS Sex_{v}" for v in ("male", "female")]
    + [f"CAST(port = '{v}' AS INT) AS Embarked_{v}" for v in "CQS"]
    + [f"CAST(t = '{v}' AS INT) AS Title_{v}" for v in ("Master", "Miss", "Mr", "Mrs", "Rare")]
    + [f"CAST(deck = '{v}' AS INT) AS Deck_{v}" for v in ("A", "B", "C", "D", "E", "F", "G", "Unknown")]
) + """,
fsize AS FamilySize, CAST(fsize = 1 AS INT) AS IsAlone, round((fare2 / fsize - mp) / sp, 6) AS FarePerPerson FROM q, s"""


@query("features_v1", over("fx_passengers", _V1))
def features_v1(spark, sf):
    df = fx_passengers(spark, sf)
    scaled = BasicFeatures().fit(df).transform(df)
    return scaled.withColumns({c: F.round(c, 6) for c in ("Age", "Fare", "FarePerPerson")})


@query("features_v2")
def features_v2(spark, sf):
    df = fx_passengers(spark, sf)
    return EnhancedFeatures().fit(df).transform(df)


@query("features_v3")
def features_v3(spark, sf):
    df = fx_passengers(spark, sf)
    return AdvancedFeatures().fit(df).transform(df)


_NB = """WITH f AS (SELECT id, label, quantity::DOUBLE AS x1, price_cents::DOUBLE / 1000000 AS x2 FROM fx_items),
e AS (SELECT 1e-9 * greatest(var_pop(x1), var_pop(x2)) AS eps, count(*) AS total FROM f),
s AS (SELECT label, ln(count(*)::DOUBLE / any_value(total)) AS prior, avg(x1) AS m1, avg(x2) AS m2, var_pop(x1) + any_value(eps) AS v1,
  var_pop(x2) + any_value(eps) AS v2 FROM f, e GROUP BY label),
l AS (SELECT f.id, a.prior - 0.5 * (ln(2 * pi() * a.v1) + pow(x1 - a.m1, 2) / a.v1 + ln(2 * pi() * a.v2) + pow(x2 - a.m2, 2) / a.v2) AS l0,
  b.prior - 0.5 * (ln(2 * pi() * b.v1) + pow(x1 - b.m1, 2) / b.v1 + ln(2 * pi() * b.v2) + pow(x2 - b.m2, 2) / b.v2) AS l1
  FROM f, s a, s b WHERE a.label = 0 AND b.label = 1)
SELECT id, round(1 / (1 + exp(l0 - l1)), 6) AS prob FROM l"""


@query("nb_gaussian_scores", over("fx_items", _NB))
def nb_gaussian_scores(spark, sf):
    df = fx_items(spark, sf).withColumn("price", F.col("price_cents") / 1000000)
    frame = model_frame(df, ["quantity", "price"], "label", keep=["id"])
    model = zoo.fit(zoo.ModelSpec("NaiveBayes", "gaussian_nb"), frame)
    return model.score(frame).select("id", F.round("prob", 6).alias("prob"))


@query("model_fit_default")
def model_fit_default(spark, sf):
    """The three default models, trained on the training part, scored on the rest."""
    train, test = _held_out(_small(spark, sf, 5))
    models = zoo.fit_all(zoo.DEFAULT_MODELS, train)
    scored = None
    for name, model in models.items():
        part = model.score(test).select("id", LABEL, F.lit(name).alias("model"), "prob", "prediction")
        scored = part if scored is None else scored.unionByName(part)
    return binary_metrics(scored, LABEL, "prediction", ["model"])


@query("model_zoo")
def model_zoo(spark, sf):
    """All base kinds, each with its held-out metrics."""
    train, test = _held_out(_small(spark, sf, 5))
    specs = [*zoo.BASE_MODELS, *zoo.BOOSTER_MODELS]
    scored = None
    for name, model in zoo.fit_all(specs, train).items():
        part = model.score(test).select(LABEL, F.lit(name).alias("model"), "prediction")
        scored = part if scored is None else scored.unionByName(part)
    return binary_metrics(scored, LABEL, "prediction", ["model"])


@query("cv_scores")
def cv_scores(spark, sf):
    frame = _small(spark, sf, 5)
    return search.cv_table(spark, search.cross_validate_all(zoo.DEFAULT_MODELS, frame, 5))


def _nb_folds(features: str, names: list[str], source: str = "fx_passengers", k: int = 5) -> str:
    """SQL: every row scored by naive Bayes of the other folds. ``features`` selects id, label and the names."""
    stats = ", ".join(f"avg({n}) AS m_{n}, var_pop({n}) AS v_{n}" for n in names)
    eps = f"1e-9 * greatest({', '.join(f'var_pop({n})' for n in names)})"
    terms = " + ".join(f"ln(2 * pi() * ({{0}}.v_{n} + e.eps)) + pow(r.{n} - {{0}}.m_{n}, 2) / ({{0}}.v_{n} + e.eps)" for n in names)
    return f"""f AS ({features}),
r AS (SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY ('0x' || substr(md5(id || '|42'), 1, 8))::BIGINT, id) - 1) % {k} AS INT) AS fold FROM f),
e AS (SELECT i AS fold, {eps} AS eps, count(*) AS total FROM r, range({k}) t(i) WHERE r.fold <> i GROUP BY i),
s AS (SELECT i AS fold, label, count(*) AS n, {stats} FROM r, range({k}) t(i) WHERE r.fold <> i GROUP BY i, label),
p AS (SELECT r.id, r.label, r.fold, 1 / (1 + exp((ln(a.n / e.total) - 0.5 * ({terms.format('a')})) - (ln(b.n / e.total) - 0.5 * ({terms.format('b')})))) AS prob
 FROM r JOIN e USING (fold) JOIN s a ON a.fold = r.fold AND a.label = 0 JOIN s b ON b.fold = r.fold AND b.label = 1)"""


_SMALL = """SELECT PassengerId AS id, Survived AS label, CAST(Pclass AS DOUBLE) AS klass, CAST(Sex = 'female' AS DOUBLE) AS woman, CAST(SibSp + Parch AS DOUBLE) AS companions,
 coalesce(Age, 30.0)::DOUBLE / 80 AS age, coalesce(Fare, 32.0)::DOUBLE / 10000 AS fare FROM fx_passengers"""
_CV_NB = f"""WITH {_nb_folds(_SMALL, _NUMBERS)},
a AS (SELECT fold, avg(CAST(CAST(prob > 0.5 AS INT) = label AS DOUBLE)) AS acc FROM p GROUP BY fold)
SELECT 'NaiveBayes' AS model, round(avg(acc), 6) AS cv_mean, round(stddev_pop(acc), 6) AS cv_std, round(min(acc), 6) AS cv_min, round(max(acc), 6) AS cv_max FROM a"""


@query("cv_scores_bayes", over("fx_passengers", _CV_NB))
def cv_scores_bayes(spark, sf):
    """Cross-validation of naive Bayes, all folds from one pass of moments."""
    frame = _small(spark, sf, 5)
    table = search.cv_table(spark, search.cross_validate_all([_BASE["NaiveBayes"]], frame, 5))
    return table.select("model", *[F.round(c, 6).alias(c) for c in table.columns if c != "model"])


@query("out_of_fold_bayes", over("fx_passengers", f"WITH {_nb_folds(_SMALL, _NUMBERS)} SELECT id, label, fold, round(prob, 6) AS prob FROM p"))
def out_of_fold_bayes(spark, sf):
    """The table of out-of-fold scores."""
    scores = search.out_of_fold([_BASE["NaiveBayes"]], _small(spark, sf, 5), 5)
    return scores.select("id", "label", "fold", F.round("NaiveBayes", 6).alias("prob"))


@query("evaluate_models")
def evaluate_models(spark, sf):
    frame = _small(spark, sf)
    train, test = _held_out(frame)
    return search.evaluate_models(zoo.fit_all(zoo.BASE_MODELS, train), test, frame, 5)


@query("knn_prototypes")
def knn_prototypes(spark, sf):
    train, test = _held_out(_small(spark, sf, 5))
    spec = zoo.ModelSpec("KNN", "prototypes", {"k": 7})
    return zoo.fit(spec, train).score(test).select("id", LABEL, "prob", "prediction")


_KNN = f"""WITH f AS ({_SMALL}),
r AS (SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY ('0x' || substr(md5(id || '|42'), 1, 8))::BIGINT, id) - 1) % 5 AS INT) AS fold FROM f),
t AS (SELECT klass, woman, companions, age, fare, CAST(count(*) AS DOUBLE) AS n, CAST(sum(label) AS DOUBLE) AS y FROM r WHERE fold <> 0 GROUP BY ALL),
q AS (SELECT DISTINCT klass, woman, companions, age, fare FROM r WHERE fold = 0),
d AS (SELECT q AS probe, t.*, round(pow(t.klass - q.klass, 2) + pow(t.woman - q.woman, 2) + pow(t.companions - q.companions, 2) + pow(t.age - q.age, 2) + pow(t.fare - q.fare, 2), 9) AS d2 FROM q, t),
b AS (SELECT *, row_number() OVER w AS place, coalesce(sum(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier, min(d2) OVER (PARTITION BY probe) AS least
  FROM d WINDOW w AS (PARTITION BY probe ORDER BY d2, klass, woman, companions, age, fare)),
v AS (SELECT probe, y / n AS share, least(n, 7 - earlier) * CASE WHEN least = 0 THEN CAST(d2 = 0 AS DOUBLE) ELSE 1 / sqrt(d2) END AS w FROM b WHERE earlier < 7 AND place <= 7),
p AS (SELECT probe, sum(w * share) / sum(w) AS prob FROM v GROUP BY probe)
SELECT r.id, r.label, round(prob, 4) AS prob FROM r JOIN p ON p.probe.klass = r.klass AND p.probe.woman = r.woman AND p.probe.companions = r.companions AND p.probe.age = r.age AND p.probe.fare = r.fare
WHERE r.fold = 0"""


@query("knn_join", over("fx_passengers", _KNN))
def knn_join(spark, sf):
    """Votes of the seven nearest of all training rows, by the neighbour join."""
    train, test = _held_out(_small(spark, sf, 5))
    spec = zoo.ModelSpec("KNN", "nearest", {"k": 7, "weights": "distance", "fit_points": 0})
    return zoo.fit(spec, train).score(test).select("id", "label", F.round("prob", 4).alias("prob"))


@query("adaboost_weighted")
def adaboost_weighted(spark, sf):
    train, test = _held_out(_small(spark, sf, 5))
    spec = next(m for m in zoo.BASE_MODELS if m.name == "AdaBoost")
    return zoo.fit(spec, train).score(test).select("id", LABEL, "prob", "prediction")


def _ada_round(i: int) -> str:
    """One round in SQL: weights by feature and value, both sides of every edge, the best split, the moved weights."""
    return f"""u{i} AS (SELECT 0 AS f, klass AS x, label, w FROM c{i} UNION ALL SELECT 1, woman, label, w FROM c{i} UNION ALL SELECT 2, companions, label, w FROM c{i}),
g{i} AS (SELECT f, x, sum(w) FILTER (label = 0) AS w0, sum(w) FILTER (label = 1) AS w1 FROM u{i} GROUP BY f, x),
e{i} AS (SELECT f, x, (x + lead(x) OVER p) / 2 AS edge, sum(coalesce(w0, 0)) OVER p AS l0, sum(coalesce(w1, 0)) OVER p AS l1,
  sum(coalesce(w0, 0)) OVER q AS t0, sum(coalesce(w1, 0)) OVER q AS t1 FROM g{i} WINDOW p AS (PARTITION BY f ORDER BY x), q AS (PARTITION BY f)),
b{i} AS (SELECT f, edge, l0, l1, t0 - l0 AS r0, t1 - l1 AS r1, t0 + t1 AS total,
  round(((l0 * l0 + l1 * l1) / (l0 + l1) + ((t0 - l0) * (t0 - l0) + (t1 - l1) * (t1 - l1)) / (t0 + t1 - l0 - l1)) / (t0 + t1), 9) AS gain
  FROM e{i} WHERE edge IS NOT NULL ORDER BY gain DESC, f, edge LIMIT 1),
s{i} AS (SELECT f, edge, CAST(l1 > l0 AS INT) AS a, CAST(r1 > r0 AS INT) AS z, (least(l0, l1) + least(r0, r1)) / total AS err FROM b{i}),
c{i + 1} AS (SELECT klass, woman, companions, label, w * CASE WHEN CASE WHEN CASE f WHEN 0 THEN klass WHEN 1 THEN woman ELSE companions END <= edge THEN a ELSE z END <> label
  THEN (1 - err) / err ELSE 1 END AS w FROM c{i}, s{i})"""


_ADA_ROUNDS = 6
_ADA = (
    """WITH c1 AS (SELECT CAST(Pclass AS DOUBLE) AS klass, CAST(Sex = 'female' AS DOUBLE) AS woman, CAST(SibSp + Parch AS DOUBLE) AS companions, Survived AS label, CAST(count(*) AS DOUBLE) AS w
 FROM fx_passengers GROUP BY ALL),
"""
    + ",\n".join(_ada_round(i) for i in range(1, _ADA_ROUNDS + 1))
    + "\n"
    + " UNION ALL ".join(f'SELECT {i} AS round, f AS feature, edge, a AS "left", z AS "right", round(err, 6) AS error, round(ln((1 - err) / err), 6) AS alpha FROM s{i}' for i in range(1, _ADA_ROUNDS + 1))
)


@query("adaboost_rounds", over("fx_passengers", _ADA))
def adaboost_rounds(spark, sf):
    """The first rounds of boosting one-split trees: split, sides, error and weight of each."""
    spec = zoo.ModelSpec("AdaBoost", "ada_boost", {"rounds": _ADA_ROUNDS})
    run = zoo.fit(spec, _small(spark, sf).withColumn("values", F.slice("values", 1, 3))).run
    rows = [(i + 1, *stump, round(e, 6), round(a, 6)) for i, (stump, e, a) in enumerate(zip(run.stumps, run.errors, run.alphas))]
    return small_table(spark, rows, "round int, feature int, edge double, left int, right int, error double, alpha double")


@query("extra_trees")
def extra_trees(spark, sf):
    """Extremely randomised trees of the declared parameters, trained on four folds, scored on the fifth."""
    train, test = _held_out(_small(spark, sf, 5))
    return zoo.fit(zoo.EXTRA_TREES, train).score(test).select("id", LABEL, "prob", "prediction")


@query("svc_rff")
def svc_rff(spark, sf):
    train, test = _held_out(_small(spark, sf, 5))
    return zoo.fit(zoo.DEFAULT_MODELS[2], train).score(test).select("id", LABEL, "prob", "prediction")


@query("grid_search")
def grid_search(spark, sf):
    """The whole declared grids of two models, on five folds."""
    frame = _small(spark, sf, 5)
    grids = {n: search.WIDE_GRIDS[n] for n in ("LogisticRegression", "DecisionTree")}
    return search.tune(zoo.fit_all([_BASE[n] for n in grids], frame), frame, grids, 5)[1]


@query("random_search")
def random_search(spark, sf):
    """50 draws from the declared grid of trees, which has 160 points, and all 30 of the neighbours', on five folds."""
    frame = _small(spark, sf, 5)
    grids = search.RANDOM_GRIDS
    return search.tune(zoo.fit_all([_BASE[n] for n in grids], frame), frame, grids, 5, n_iter=50)[1]


@query("stacking_oof")
def stacking_oof(spark, sf):
    """Trained on five of six folds, scored on the sixth."""
    train, test = _held_out(_small(spark, sf, 6))
    train = train.withColumn(FOLD, F.col(FOLD) - 1)
    stacked = search.fit_stacked("StackingEnsemble", zoo.BASE_MODELS, _FINAL, train, "id", 5)
    return stacked.score(test).select("id", LABEL, "prob", "prediction")


@query("voting_soft")
def voting_soft(spark, sf):
    train, test = _held_out(_small(spark, sf, 5))
    models = zoo.fit_all(zoo.BASE_MODELS, train)
    return search.Voting(zoo.ModelSpec("VotingEnsemble", "voting"), models).score(test).select("id", LABEL, "prob", "prediction")


@query(
    "model_roundtrip",
    " UNION ALL ".join(
        f"SELECT '{m}' AS model, count(*) AS rows, CAST(0 AS BIGINT) AS changed FROM orders" for m in ("RandomForest", "SVM", "AdaBoost")
    ),
)
def model_roundtrip(spark, sf):
    """Rows whose score changes when a saved model is read back: none, so 0."""
    frame = _small(spark, sf)
    out = None
    for spec in (_BASE["RandomForest"], _BASE["SVM"], _BASE["AdaBoost"]):
        model = zoo.fit(spec, frame)
        root = scratch_path(spark, "models")
        search.save_best(spark, model, root, 0.5, 0.8, False)
        again = search.latest_model(spark, root)
        both = model.score(frame).select("id", F.col("prob").alias("p")).join(again.score(frame).select("id", "prob"), "id")
        part = both.agg(
            F.lit(spec.name).alias("model"), F.count(F.lit(1)).alias("rows"),
            F.sum((F.abs(F.col("p") - F.col("prob")) > 1e-9).cast("int")).alias("changed"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query("feature_importance")
def feature_importance(spark, sf):
    frame = _small(spark, sf)
    return search.importance_table(spark, zoo.fit(_BASE["RandomForest"], frame), _NUMBERS, top=5)


def _train_and_score(spark, sf):
    df = stratified_split(fx_passengers(spark, sf), "PassengerId", "Survived", 0.3, name="__p")
    df = materialize(df, "passengers")
    return df.filter("__p = 'train'").drop("__p"), df.filter("__p = 'test'").drop("__p", "Survived")


@query("score_table")
def score_table(spark, sf):
    """Train, store, and score the other rows with the stored model."""
    training, scoring = _train_and_score(spark, sf)
    root = scratch_path(spark, "job")
    jobs.train(training, root, specs=zoo.BASE_MODELS)
    return jobs.score_table(scoring, root)


# The scoring rows of `_train_and_score` and what is checked of their predictions, which are 0 or 1 and never missing.
_WRITTEN = """WITH r AS (SELECT PassengerId, row_number() OVER (PARTITION BY Survived ORDER BY ('0x' || substr(md5(PassengerId || '|42'), 1, 8))::BIGINT, PassengerId) AS rk,
 count(*) OVER (PARTITION BY Survived) AS n FROM fx_passengers),
s AS (SELECT PassengerId FROM r WHERE rk <= round(n * 0.3)),
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE PassengerId IS NULL) AS missing, count(*) FILTER (WHERE PassengerId IS NOT NULL AND try_cast(PassengerId AS BIGINT) IS NULL) AS words,
 (SELECT count(*) FROM (SELECT PassengerId FROM s GROUP BY ALL HAVING count(*) > 1)) AS repeated FROM s),
d AS (SELECT 'columns' AS "check", CAST(0 AS BIGINT) AS detail UNION ALL SELECT 'row_count', CAST(n = 0 AS BIGINT) FROM c UNION ALL SELECT 'key_numeric', words FROM c
 UNION ALL SELECT 'unique_keys', repeated FROM c UNION ALL SELECT 'no_missing_values', missing FROM c UNION ALL SELECT 'binary_predictions', 0)
SELECT "check", detail = 0 AS passed, detail FROM d UNION ALL SELECT 'compliant', sum(detail) = 0, CAST(sum(detail) AS BIGINT) FROM d"""


@query("predict_and_write", over("fx_passengers", _WRITTEN))
def predict_and_write(spark, sf):
    training, scoring = _train_and_score(spark, sf)
    root = scratch_path(spark, "job")
    jobs.train(training, root, specs=[_BASE["DecisionTree"]])
    return jobs.predict(scoring, root, f"{root}/out")["checks"]


@query("job_evaluate")
def job_evaluate(spark, sf):
    training, _ = _train_and_score(spark, sf)
    root = scratch_path(spark, "job")
    jobs.train(training, root, specs=zoo.BASE_MODELS)
    return jobs.evaluate(training, root)["report"]


@query("train_complete")
def train_complete(spark, sf):
    """Base models, tuning, voting and stacking compared in one table."""
    training, _ = _train_and_score(spark, sf)
    root = scratch_path(spark, "job")
    done = jobs.run_complete_training(training, root, jobs.Roles(), zoo.BASE_MODELS, search.WIDE_GRIDS, None, _FINAL)
    return done["results"]


@query("compare_feature_sets")
def compare_feature_sets(spark, sf):
    return jobs.compare_feature_sets(fx_passengers(spark, sf), spec=_BASE["DecisionTree"])


@query("job_ensemble")
def job_ensemble(spark, sf):
    training, scoring = _train_and_score(spark, sf)
    return jobs.ensemble_predict(training, scoring, threshold=0.49)["predictions"]


@query("job_hybrid")
def job_hybrid(spark, sf):
    training, scoring = _train_and_score(spark, sf)
    thresholds = small_table(spark, [("male", 0.6), ("female", 0.4)], "Sex string, threshold double")
    return jobs.hybrid_predict(training, scoring, thresholds=thresholds)["predictions"]


_JOB_RULES = """WITH r AS (SELECT *, row_number() OVER (PARTITION BY Survived ORDER BY ('0x' || substr(md5(PassengerId || '|42'), 1, 8))::BIGINT, PassengerId) AS rk,
 count(*) OVER (PARTITION BY Survived) AS n FROM fx_passengers),
u AS (SELECT surname, CAST(sum(Survived) = count(*) AS INT) AS all_live, CAST(sum(Survived) = 0 AS INT) AS all_die
 FROM r WHERE rk > round(n * 0.3) AND title <> 'Mr' GROUP BY surname),
p AS (SELECT r.PassengerId, CASE WHEN Sex = 'female' AND Pclass = 1 AND SibSp + Parch > 0 THEN 'first_class_woman_with_company'
 WHEN Sex = 'male' AND Pclass = 3 AND SibSp + Parch = 0 THEN 'third_class_man_alone' END AS last_rule,
 CASE WHEN Sex = 'female' AND all_die = 1 THEN 'family_dies' WHEN title = 'Master' AND all_live = 1 THEN 'family_lives' END AS family_rule, Sex, Cabin
 FROM r LEFT JOIN u USING (surname) WHERE rk <= round(n * 0.3))
SELECT PassengerId, CASE last_rule WHEN 'first_class_woman_with_company' THEN 1 WHEN 'third_class_man_alone' THEN 0 ELSE
 CASE WHEN Cabin = 'A0' THEN 0 WHEN family_rule = 'family_dies' THEN 0 WHEN family_rule = 'family_lives' THEN 1 WHEN Sex = 'female' THEN 1 ELSE 0 END END AS prediction,
coalesce(last_rule, family_rule) AS rule_name FROM p"""


@query("job_rules", over("fx_passengers", _JOB_RULES))
def job_rules(spark, sf):
    training, scoring = _train_and_score(spark, sf)
    overrides = scoring.filter(F.col("Cabin") == "A0").select("PassengerId", F.lit(0).alias("value"))
    return jobs.rules_predict(training, scoring, overrides=overrides)
