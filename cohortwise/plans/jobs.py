"""End-to-end jobs: explore, train, predict, evaluate, and rule-based scoring."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.functions import numeric as N
from cohortwise.functions import text as X
from cohortwise.models import search, zoo
from cohortwise.models.frame import FOLD, LABEL, model_frame, vectorize
from cohortwise.operators import metrics as M
from cohortwise.operators import rules as R
from cohortwise.operators.cohort import exploration_report
from cohortwise.operators.ensemble import model_weights
from cohortwise.operators.split import assign_folds, stratified_split
from cohortwise.operators.target_encode import GroupRate, out_of_fold
from cohortwise.operators.validate import TableRules, output_checks, prediction_summary, validate
from cohortwise.plans.features import BasicFeatures, EnhancedFeatures, Roles
from cohortwise.plans.store import load_fitted, save_fitted
from cohortwise.session import materialize, small_table
from cohortwise.sources.tables import prediction_table, read_predictions, write_predictions

log = logging.getLogger(__name__)

# Share of validation rows and the accuracy a model should reach.
TEST_SHARE = 0.2
MIN_ACCURACY = 0.8


def explore(df: DataFrame, roles: Roles = Roles()) -> dict[str, DataFrame]:
    """All profiles and cohort rates of a training table."""
    return exploration_report(
        df, roles.label, categories=[roles.sex, roles.klass, roles.port], bins=roles.age, quartiles=roles.fare,
        sizes=(roles.a, roles.b),
    )


def check_table(df: DataFrame, roles: Roles, domains: dict[str, Sequence], training: bool = True) -> DataFrame:
    """Validate a training or scoring table before a job."""
    required = [c for c in vars(roles).values() if training or c != roles.label]
    kept = {c: v for c, v in domains.items() if c in df.columns}
    return validate(df, TableRules(roles.key, required, kept, [roles.age, roles.a, roles.b, roles.fare]))


def _parts(df: DataFrame, roles: Roles, root: str) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows. The validation keys are kept under ``root``, so that rows
    added later can't move a trained row among those that :func:`evaluate` holds out."""
    marked = materialize(stratified_split(df, roles.key, roles.label, TEST_SHARE, name="__part"), "split")
    keep = [c for c in marked.columns if c != "__part"]
    training, validation = (marked.filter(F.col("__part") == part).select(*keep) for part in ("train", "test"))
    validation.select(roles.key).write.mode("overwrite").parquet(f"{root}/held_out")
    return training, validation


def train(
    df: DataFrame,
    root: str,
    roles: Roles = Roles(),
    features=None,
    specs: Sequence[zoo.ModelSpec] = zoo.DEFAULT_MODELS,
    grids: dict[str, dict] | None = None,
    n_iter: int | None = None,
    min_accuracy: float = MIN_ACCURACY,
    k: int = 5,
) -> dict:
    """Split, fit features on the training part only, train and tune models,
    keep the best under ``root``."""
    spark = df.sparkSession
    training, validation = _parts(df, roles, root)
    features = (features or BasicFeatures(roles)).fit(training)
    folded = assign_folds(features.transform(training), "id", "label", k, name=FOLD)
    frame = model_frame(folded, features.names, "label", keep=["id", FOLD])
    held_out = model_frame(features.transform(validation), features.names, "label", keep=["id"])
    models = zoo.fit_all(specs, frame)
    tried = None
    if grids:
        models, tried = search.tune(models, frame, grids, k, n_iter)
    results = materialize(search.evaluate_models(models, held_out, frame, k), "results")
    best = M.select_best(results, min_accuracy).first()
    save_fitted(features, f"{root}/features", spark)
    path = search.save_best(spark, models[best["model"]], f"{root}/models", best["accuracy"], min_accuracy, bool(grids))
    return {
        "model": best["model"], "accuracy": best["accuracy"], "meets_threshold": bool(best["meets_threshold"]),
        "results": results, "tried": tried, "path": path,
    }


def run_complete_training(df: DataFrame, root: str, roles: Roles, specs, grids, n_iter: int | None, final: zoo.ModelSpec,
                          min_accuracy: float = 0.9, k: int = 5, features=None) -> dict:
    """Base models, tuning, voting and stacking; the best of all of them, ensembles too, is the one stored and reported."""
    spark = df.sparkSession
    training, validation = _parts(df, roles, root)
    features = (features or BasicFeatures(roles)).fit(training)
    folded = assign_folds(features.transform(training), "id", "label", k, name=FOLD)
    frame = model_frame(folded, features.names, "label", keep=["id", FOLD])
    held_out = model_frame(features.transform(validation), features.names, "label", keep=["id"])
    tuned, tried = search.tune(zoo.fit_all(specs, frame), frame, grids, k, n_iter)
    # One table of out-of-fold scores serves the choice of models, the vote and the stacking.
    bases = [m.spec for m in tuned.values()]
    scores = search.out_of_fold(bases, frame, k)
    results = search.evaluate_models(tuned, held_out, frame, k, scores)
    ensembles = {"VotingEnsemble": search.Voting(zoo.ModelSpec("VotingEnsemble", "voting"), tuned)}
    ensembles["StackingEnsemble"] = search.fit_stacked("StackingEnsemble", bases, final, frame, "id", k, scores, tuned)
    cv = search.ensemble_cv(bases, final, frame, k, scores)
    rows = []
    for name, model in ensembles.items():
        folds = search.summary(cv[model.spec.kind])
        scored = materialize(model.score(held_out), "scored")
        metrics = M.binary_metrics(scored, LABEL, "prediction").first()
        auc = M.roc_auc(scored, LABEL, "prob").first()["auc"]
        rows.append((name, *[metrics[c] for c in ("accuracy", "precision", "recall", "f1_score")], auc, folds["cv_mean"], folds["cv_std"], "Ensemble"))
    results = materialize(results.unionByName(spark.createDataFrame(rows, results.schema)), "results")
    best = M.select_best(results, min_accuracy).first()
    save_fitted(features, f"{root}/features", spark)
    chosen = {**tuned, **ensembles}[best["model"]]
    path = search.save_best(spark, chosen, f"{root}/models", best["accuracy"], min_accuracy, True)
    return {"model": best["model"], "accuracy": best["accuracy"], "meets_threshold": bool(best["meets_threshold"]),
            "results": results, "tried": tried, "path": path}


def predict(df: DataFrame, root: str, out: str, roles: Roles = Roles(), model: str | None = None, fmt: str = "csv") -> dict:
    """Score a table with the newest model under ``root``, write and check the predictions."""
    spark = df.sparkSession
    scored = score_table(df, root, model)
    write_predictions(prediction_table(scored, "id", "prediction", roles.label).withColumnRenamed("id", roles.key), out, fmt)
    written = read_predictions(spark, out, fmt)
    return {
        "predictions": written,
        "checks": output_checks(written, roles.key, roles.label, df.count()),
        "summary": prediction_summary(written, roles.label),
    }


def score_table(df: DataFrame, root: str, model: str | None = None) -> DataFrame:
    """Rows with ``prob`` and ``prediction`` by the stored features and model."""
    spark = df.sparkSession
    features = load_fitted(f"{root}/features", spark)
    fitted = search.latest_model(spark, f"{root}/models", model)
    matrix = features.transform(df)
    keep = ["id", "label"] if "label" in matrix.columns else ["id"]
    return fitted.score(vectorize(matrix, features.names, keep=keep)).select(*keep, "prob", "prediction")


def evaluate(df: DataFrame, root: str, roles: Roles = Roles(), model: str | None = None, min_accuracy: float = MIN_ACCURACY) -> dict:
    """Metrics of the stored model on the rows training held out."""
    spark = df.sparkSession
    validation = df.join(spark.read.parquet(f"{root}/held_out"), roles.key, "left_semi")
    scored = materialize(score_table(validation, root, model), "scored")
    features = load_fitted(f"{root}/features", spark)
    fitted = search.latest_model(spark, f"{root}/models", model)
    try:
        importance = search.importance_table(spark, fitted, features.names)
    except ValueError:
        importance = None
    metrics = M.binary_metrics(scored, "label", "prediction")
    return {
        "metrics": metrics,
        "confusion": M.confusion_matrix(scored, "label", "prediction"),
        "report": M.classification_report(scored, "label", "prediction"),
        "roc": M.roc_points(scored, "label", "prob"),
        "auc": M.roc_auc(scored, "label", "prob"),
        "importance": importance,
        "meets_threshold": metrics.first()["accuracy"] >= min_accuracy,
    }


def run_all(training: DataFrame, scoring: DataFrame, root: str, out: str, roles: Roles = Roles(), **options) -> dict:
    """Explore, train, predict and evaluate."""
    return {
        "explore": explore(training, roles),
        "train": train(training, root, roles, **options),
        "predict": predict(scoring, root, out, roles),
        "evaluate": evaluate(training, root, roles),
    }


# --- rules -------------------------------------------------------------------


def with_family(df: DataFrame, roles: Roles, titles: dict[str, str] | None = None, surname: str = X.SURNAME_PATTERN) -> DataFrame:
    """Add title, family name and family size. Without a mapping the raw title is kept."""
    title = X.token(F.col(roles.name), X.TITLE_PATTERN)
    if titles == X.TITLES_OFFICER:
        title = X.token_or_fallback(
            F.col(roles.name), X.TITLE_PATTERN, titles, X.TITLES_KEPT, F.col(roles.sex), X.TITLE_BY_SEX
        )
    elif titles:
        title = X.replace_values(title, titles)
    return df.withColumns(
        {
            "family": X.token(F.col(roles.name), surname),
            "title": title,
            "family_size": N.group_size(F.col(roles.a), F.col(roles.b)),
        }
    )


def _ruled(training, scoring, roles, titles, min_members, extended) -> DataFrame:
    known = with_family(training, roles, titles)
    not_man = (F.col("title") != "Mr") | F.col("title").isNull()
    families = materialize(R.group_unanimity(known, "family", roles.label, not_man, min_members), "families")
    rows = R.attach_unanimity(with_family(scoring, roles, titles), families, "family")
    rules = R.passenger_rules(F.col("title"), F.col(roles.sex), F.col(roles.klass), F.col("family_size"), extended)
    return R.apply_rules(rows, rules)


def rules_predict(
    training: DataFrame,
    scoring: DataFrame,
    roles: Roles = Roles(),
    overrides: DataFrame | None = None,
    positive: str = "female",
    closing: bool = True,
) -> DataFrame:
    """Baseline, family rules, override table ``(key, value)``, closing rules.

    Returns the key, the prediction and the rule that decided.
    """
    ruled = _ruled(training, scoring, roles, None, 1, False)
    current = ruled.withColumn("prediction", R.combine(F.col("rule_prediction"), R.baseline(roles.sex, positive)))
    if overrides is not None:
        current = R.override(current, overrides, roles.key, "value", "prediction")
    last = R.closing_rules(F.col(roles.sex), F.col(roles.klass), F.col(roles.a) + F.col(roles.b)) if closing else []
    final = R.apply_rules(current, last, "final", "last_rule", initial=F.col("prediction"))
    decided = F.coalesce(F.col("last_rule"), F.col("rule_name"))
    return final.select(roles.key, F.col("final").alias("prediction"), decided.alias("rule_name"))


def _rated(training: DataFrame, scoring: DataFrame, roles: Roles, k: int) -> tuple[DataFrame, DataFrame]:
    """Family label rates: out of fold on the training rows, fitted on the scoring rows."""
    known = assign_folds(with_family(training, roles), roles.key, roles.label, k, name=FOLD)
    rated = out_of_fold(known, "family", roles.label, FOLD, "FamilySurvivalRate")
    rate = GroupRate("family", roles.label, "FamilySurvivalRate").fit(known)
    drop = ["family", "title", "family_size"]
    return materialize(rated.drop(*drop), "rated"), rate.transform(with_family(scoring, roles)).drop(*drop)


def ensemble_predict(
    training: DataFrame,
    scoring: DataFrame,
    roles: Roles = Roles(),
    specs: Sequence[zoo.ModelSpec] = zoo.ENSEMBLE_MODELS,
    top_k: int | None = 4,
    threshold: float = 0.5,
    k: int = 5,
    uniform: bool = False,
) -> dict:
    """Weight the best models by their cross-validated accuracy and blend their probabilities."""
    spark = training.sparkSession
    rated, to_score = _rated(training, scoring, roles, k)
    features = EnhancedFeatures(roles, extra=["FamilySurvivalRate"]).fit(rated)
    folds = rated.select(F.col(roles.key).alias("id"), FOLD)
    matrix = features.transform(rated).join(folds, "id")
    frame = model_frame(matrix, features.names, "label", keep=["id", FOLD])
    fits = search.fit_folds(specs, frame, [*range(k), None])
    scores = search.out_of_fold(specs, frame, k, models=fits)
    cv = search.cv_table(spark, search.fold_accuracies(scores, [s.name for s in specs], k))
    weights = {r["model"]: r["weight"] for r in model_weights(cv, "cv_mean", top_k, uniform).collect()}
    models = {s.name: fits[s.name, None] for s in specs if s.name in weights}
    blend = search.Voting(zoo.ModelSpec("WeightedEnsemble", "voting"), models, weights)
    target = model_frame(features.transform(to_score), features.names, keep=["id"])
    scored = R.decide(blend.score(target).select("id", "prob"), "prob", threshold)
    return {"predictions": scored, "cv": cv, "features": features, "models": models}


def hybrid_predict(
    training: DataFrame,
    scoring: DataFrame,
    roles: Roles = Roles(),
    specs: Sequence[zoo.ModelSpec] = zoo.FINAL_ENSEMBLE_MODELS,
    thresholds: DataFrame | float = 0.5,
    titles: dict[str, str] | None = X.TITLES_OFFICER,
    min_members: int = 2,
    extended: bool = True,
    positive: str = "female",
    k: int = 7,
    top_k: int | None = None,
) -> dict:
    """Rules where they apply, the ensemble for the other rows, the baseline for the rest.

    ``thresholds`` is one number or a table ``(cohort column, threshold)``.
    """
    ruled = materialize(_ruled(training, scoring, roles, titles, min_members, extended), "ruled")
    columns = scoring.columns
    open_rows = ruled.filter(F.col("rule_prediction").isNull()).select(*columns)
    blended = ensemble_predict(training, open_rows, roles, specs, top_k, k=k)
    probs = blended["predictions"].select(F.col("id").alias(roles.key), "prob")
    joined = ruled.join(probs, roles.key, "left")
    decided = R.decide(joined, "prob", thresholds, roles.sex, "model_prediction")
    final = R.combine(F.col("rule_prediction"), F.col("model_prediction"), R.baseline(roles.sex, positive))
    out = decided.select(roles.key, final.alias("prediction"), "rule_name", "prob")
    return {"predictions": out, "audit": R.audit(ruled), "cv": blended["cv"]}


def compare_feature_sets(df: DataFrame, roles: Roles = Roles(), spec: zoo.ModelSpec | None = None, k: int = 5, parallel: int = search.PARALLEL) -> DataFrame:
    """Cross-validate one fixed model over the feature sets.

    Returns one row per set with score, feature count and the gain over the
    worst set. Every statistic of a feature set is fitted anew on the training rows of each fold, side by side; family rates
    are out of fold, so no row sees its own label.
    """
    spark = df.sparkSession
    spec = spec or zoo.ModelSpec("RandomForest", "random_forest", {"numTrees": 100})
    rated, _ = _rated(df, df, roles, k)
    sets = {
        "Basic": lambda: BasicFeatures(roles),
        "Enhanced": lambda: EnhancedFeatures(roles),
        "Enhanced + Family": lambda: EnhancedFeatures(roles, extra=["FamilySurvivalRate"]),
    }

    def one(task: tuple[str, int]) -> tuple[float, int]:
        name, i = task
        training, held_out = rated.filter(F.col(FOLD) != i).drop(FOLD), rated.filter(F.col(FOLD) == i).drop(FOLD)
        features = sets[name]().fit(training)
        known = model_frame(features.transform(training), features.names, "label", keep=["id"])
        # Scored once, so not written.
        asked = vectorize(features.transform(held_out), features.names, "label", keep=["id"])
        return search.accuracy(zoo.fit(spec, known).score(asked)), len(features.names)

    tasks = [(name, i) for name in sets for i in range(k)]
    with ThreadPool(min(parallel, len(tasks))) as pool:
        found = dict(zip(tasks, pool.map(one, tasks, chunksize=1)))
    rows = []
    for name in sets:
        stats = search.summary([found[name, i][0] for i in range(k)])
        rows.append((name, stats["cv_mean"], stats["cv_std"], found[name, 0][1]))
    worst = min(r[1] for r in rows)
    table = [(n, m, s, c, m - worst) for n, m, s, c in rows]
    return small_table(spark, table, "feature_set string, cv_mean double, cv_std double, features int, gain double")
