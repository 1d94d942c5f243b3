"""Cross-validation, parameter search, model choice, stacking, model stores."""

from __future__ import annotations

import itertools
import logging
import random
import statistics
from collections.abc import Sequence
from datetime import datetime, timezone
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.models import stumps, zoo
from cohortwise.models.frame import FEATURES, FOLD, LABEL, model_frame
from cohortwise.operators.metrics import binary_metrics, roc_auc
from cohortwise.operators.split import assign_folds
from cohortwise.session import materialize, small_table

log = logging.getLogger(__name__)

# Threads that submit Spark jobs side by side.
PARALLEL = 8


def accuracy(scored: DataFrame) -> float:
    return scored.agg(F.avg((F.col("prediction") == F.col(LABEL)).cast("double"))).first()[0]


def fit_folds(specs: Sequence[zoo.ModelSpec], frame: DataFrame, folds: Sequence[int | None], parallel: int = PARALLEL) -> dict[tuple[str, int | None], zoo.Fitted]:
    """Every model fitted without each of these folds (None: on all rows), by (name, fold).

    All fits share one pool, so that short fits run beside long ones. Boosting of one-split trees, boosting that draws rows and extremely
    randomised trees take all folds in one run, naive Bayes in one pass.
    """
    shared = [s for s in specs if s.kind in ("gaussian_nb", "extra_trees") or s.kind == "ada_boost" and s.params.get("maxDepth", 1) == 1 or zoo.draws_rows(s)]
    tasks = [(spec, None) for spec in shared] + [(spec, fold) for spec in specs if spec not in shared for fold in folds]
    # The long ones first, so that none of them is left over at the end.
    tasks.sort(key=lambda t: _LONG.index(t[0].kind) if t[0].kind in _LONG else len(_LONG))

    def one(task):
        spec, fold = task
        if spec.kind in ("gaussian_nb", "extra_trees"):
            fit = zoo.fit_bayes_folds if spec.kind == "gaussian_nb" else zoo.fit_extra_folds
            return [((spec.name, f), m) for f, m in zip(folds, fit(spec, frame, folds))]
        if spec in shared and spec.kind == "boosted_trees":
            return [((spec.name, f), m) for f, m in zip(folds, zoo.fit_boosted_folds(spec, frame, folds))]
        if spec in shared:
            rate = spec.params.get("learning_rate", 1.0)
            return [((spec.name, f), m) for f, m in zip(folds, zoo.fit_ada_runs(spec, frame, [(rate, f) for f in folds]))]
        return [((spec.name, fold), zoo.fit(spec, kept[fold]))]

    # One table for each fold, so that its bins are found once for all models.
    kept = {fold: frame if fold is None else frame.filter(F.col(FOLD) != fold) for fold in folds}
    with ThreadPool(min(parallel, max(len(tasks), 1))) as pool:
        return dict(pair for found in pool.map(one, tasks, chunksize=1) for pair in found)


_LONG = ["boosted_trees", "extra_trees", "ada_boost", "random_forest", "svc"]


def out_of_fold(specs: Sequence[zoo.ModelSpec], frame: DataFrame, k: int, parallel: int = PARALLEL, models: dict | None = None) -> DataFrame:
    """The one table of out-of-fold scores: ``frame``'s own columns and, per model, the probability from the fit
    that did not see the row's fold. Written, so that choices, votes and stacking all read the same scores.

    A fold is scored by all models in one projection and folds are put together, so nothing is shuffled.
    """
    models = models or fit_folds(specs, frame, range(k), parallel)
    own = [c for c in frame.columns if c not in (FEATURES, "values")]
    out = None
    for i in range(k):
        part = frame.filter(F.col(FOLD) == i)
        for spec in specs:
            kept = part.columns
            part = models[spec.name, i].score(part).select(*kept, F.col("prob").alias(spec.name))
        part = part.select(*own, *[s.name for s in specs])
        out = part if out is None else out.unionByName(part)
    return materialize(out, "out-of-fold")


def fold_accuracies(scores: DataFrame, names: Sequence[str], k: int) -> dict[str, list[float]]:
    """Accuracy of each model on each fold, from one pass over the table of out-of-fold scores."""
    right = [F.avg(((F.col(f"`{n}`") > 0.5).cast("int") == F.col(LABEL)).cast("double")).alias(f"a{i}") for i, n in enumerate(names)]
    found = {r[FOLD]: r for r in scores.groupBy(FOLD).agg(*right).collect()}
    return {n: [found[f][f"a{i}"] for f in range(k) if f in found] for i, n in enumerate(names)}


def cross_validate_all(specs: Sequence[zoo.ModelSpec], frame: DataFrame, k: int, parallel: int = PARALLEL) -> dict[str, list[float]]:
    """Accuracy on each fold of each model fitted on the others."""
    return fold_accuracies(out_of_fold(specs, frame, k, parallel), [s.name for s in specs], k)


def cross_validate(spec: zoo.ModelSpec, frame: DataFrame, k: int, parallel: int = PARALLEL) -> list[float]:
    return cross_validate_all([spec], frame, k, parallel)[spec.name]


def summary(scores: Sequence[float]) -> dict[str, float]:
    return {
        "cv_mean": statistics.fmean(scores),
        "cv_std": statistics.pstdev(scores),
        "cv_min": min(scores),
        "cv_max": max(scores),
    }


def cv_table(spark: SparkSession, scores: dict[str, Sequence[float]]) -> DataFrame:
    """One row per model with mean, deviation, minimum and maximum."""
    rows = [(name, *summary(values).values()) for name, values in scores.items()]
    return small_table(spark, rows, "model string, cv_mean double, cv_std double, cv_min double, cv_max double")


def evaluate_models(
    models: dict[str, zoo.Fitted], validation: DataFrame, cv_frame: DataFrame, k: int = 5, scores: DataFrame | None = None
) -> DataFrame:
    """Validation metrics, AUC and cross-validation per model, one row each.

    ``cv_frame`` is the table cross-validation refits on; pass the validation
    table for what the reference does, the training table for a fair score.
    ``scores`` is its table of out-of-fold scores where there is one already.
    """
    spark = validation.sparkSession
    scored = None
    for name, model in models.items():
        part = model.score(validation).select(F.lit(name).alias("model"), LABEL, "prob", "prediction")
        scored = part if scored is None else scored.unionByName(part)
    if scored is None:
        raise ValueError("no trained models")
    scored = materialize(scored, "scored")
    if scores is None:
        scores = out_of_fold([m.spec for m in models.values()], cv_frame, k)
    cv = cv_table(spark, fold_accuracies(scores, list(models), k))
    kinds = small_table(spark, 
        [(n, "Ensemble" if "Ensemble" in n else "Base") for n in models], "model string, model_type string"
    )
    return (
        binary_metrics(scored, LABEL, "prediction", ["model"])
        .join(roc_auc(scored, LABEL, "prob", ["model"]), "model", "left")
        .join(cv.select("model", "cv_mean", "cv_std"), "model")
        .join(kinds, "model")
    )


# The searched parameters. Depth None is 15, the smallest split
# size has no counterpart in Spark ML.
GRIDS = {
    "RandomForest": {"numTrees": [50, 100, 200], "maxDepth": [5, 10, 15], "minInstancesPerNode": [1, 2, 4]},
    "LogisticRegression": {"C": [0.1, 1.0, 10.0, 100.0], "elasticNetParam": [1.0, 0.0]},
    "SVM": {"C": [0.1, 1.0, 10.0], "kernel": ["rbf", "linear"], "gamma": ["scale", "auto", 0.001, 0.01]},
}
WIDE_GRIDS = {
    "RandomForest": {
        "numTrees": [100, 200, 300], "maxDepth": [6, 8, 10, 15], "minInstancesPerNode": [1, 2, 4],
        "featureSubsetStrategy": ["sqrt", "log2", "all"],
    },
    "LogisticRegression": {"C": [0.01, 0.1, 1.0, 10.0, 100.0], "elasticNetParam": [1.0, 0.0]},
    "SVM": {"C": [0.1, 1.0, 10.0, 100.0], "kernel": ["rbf", "linear"], "gamma": ["scale", "auto", 0.001, 0.01, 0.1]},
    "KNN": {"k": [3, 5, 7, 9, 11], "weights": ["uniform", "distance"]},
    "DecisionTree": {"maxDepth": [3, 5, 7, 10, 15], "minInstancesPerNode": [1, 2, 5, 10], "impurity": ["gini", "entropy"]},
    "AdaBoost": {"rounds": [50, 100, 200], "learning_rate": [0.01, 0.1, 1.0, 2.0]},
    "GradientBoosting": {
        "maxIter": [100, 200, 300], "stepSize": [0.01, 0.1, 0.2], "maxDepth": [3, 5, 7], "subsamplingRate": [0.8, 0.9, 1.0],
    },
}
# What a random search draws from: the grids of these models with the parameters that have no counterpart in Spark ML but are known here.
RANDOM_GRIDS = {
    "DecisionTree": {**WIDE_GRIDS["DecisionTree"], "minSplit": [2, 5, 10, 20]},
    "KNN": {**WIDE_GRIDS["KNN"], "metric": ["euclidean", "manhattan", "minkowski"]},
}


def combinations(grid: dict[str, Sequence]) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


# Parameters of which a shorter value is the beginning of a longer fit (trees of a forest, rounds of boosting, levels of a
# tree) or another reading of it (the votes of one list of neighbours).
NESTED = {
    "random_forest": ("numTrees",), "extra_trees": ("numTrees",), "boosted_trees": ("maxIter",), "ada_boost": ("rounds",), "tree": ("maxDepth", "minSplit"),
    "nearest": ("k", "weights"),
}
# Of these the smallest value has the longest fit.
_LEAST = ("minSplit",)


def chains(spec: zoo.ModelSpec, options: Sequence[dict]) -> list[tuple[dict, list[int]]]:
    """Options grouped by what must be fitted apart: (the largest option's parameters, numbers of the options that come from that fit)."""
    nested = NESTED.get(spec.kind, ())
    groups: dict[str, list[int]] = {}
    for i, option in enumerate(options):
        apart = {n: v for n, v in option.items() if n not in nested}
        if spec.kind == "svc" and {**spec.params, **option}.get("kernel", "rbf") == "linear":
            apart.pop("gamma", None)  # only the other kernel has it
        if spec.kind == "nearest" and "metric" in apart:
            apart["metric"] = zoo.power(apart)  # two names of one distance
        groups.setdefault(repr(sorted(apart.items())), []).append(i)
    return [({**options[at[0]], **{n: (min if n in _LEAST else max)(options[i][n] for i in at) for n in nested if n in options[at[0]]}}, at) for at in groups.values()]


def _shares(model: zoo.Fitted, options: Sequence[dict], rows: DataFrame) -> list[float]:
    """Accuracy on ``rows`` of every option that comes out of this one fit."""
    spec = model.spec
    if spec.kind == "tree" and {"maxDepth", "minSplit"} & set(options[0]):
        depths = [o.get("maxDepth", spec.params.get("maxDepth", 5)) for o in options]
        rows = rows.withColumn("__votes", zoo.depth_votes(rows.sparkSession, model.model, depths, [o.get("minSplit", 0) for o in options]))
        votes = [F.col("__votes")[i] for i in range(len(options))]
    elif spec.kind == "nearest":
        wanted = [(o.get("k", spec.params.get("k", 7)), o.get("weights", spec.params.get("weights", "distance"))) for o in options]
        rows = model.with_votes(rows, wanted)
        votes = [(F.col("__votes")[i] > 0.5).cast("double") for i in range(len(wanted))]
    elif spec.kind in ("random_forest", "extra_trees", "boosted_trees") and len(options) > 1:
        name = NESTED[spec.kind][0]
        return [accuracy(model.first(o[name]).score(rows)) for o in options]
    else:
        return [accuracy(model.score(rows))] * len(options)
    right = rows.agg(*[F.avg((v == F.col(LABEL)).cast("double")).alias(f"a{i}") for i, v in enumerate(votes)]).first()
    return list(right)


def chain_means(spec: zoo.ModelSpec, frame: DataFrame, options: Sequence[dict], k: int, parallel: int = PARALLEL) -> tuple[list[float], int]:
    """Mean accuracy over the folds of every option, with one fit per chain and fold; and the number of fits."""
    groups = chains(spec, options)
    if spec.kind == "ada_boost" and spec.params.get("maxDepth", 1) == 1:
        return _ada_means(spec, frame, groups, options, k)

    kept = [frame.filter(F.col(FOLD) != fold) for fold in range(k)]

    def one(task: tuple[int, int]) -> list[float]:
        (largest, at), fold = groups[task[0]], task[1]
        model = zoo.fit(spec.with_params(**largest), kept[fold])
        return _shares(model, [options[i] for i in at], frame.filter(F.col(FOLD) == fold))

    tasks = [(g, fold) for g in range(len(groups)) for fold in range(k)]
    with ThreadPool(min(parallel, len(tasks))) as pool:
        found = pool.map(one, tasks, chunksize=1)
    means: list[float] = [0.0] * len(options)
    for (g, _), shares in zip(tasks, found):
        for i, share in zip(groups[g][1], shares):
            means[i] += share / k
    return means, len(tasks)


def _ada_means(spec: zoo.ModelSpec, frame: DataFrame, groups, options: Sequence[dict], k: int) -> tuple[list[float], int]:
    """All rates and folds are boosted side by side; shorter options are read off on the way."""
    base = spec.params.get("rounds", 100)
    stages = sorted({o.get("rounds", base) for o in options})
    rates = [{**spec.params, **largest}.get("learning_rate", 1.0) for largest, _ in groups]
    edges = stumps.edges_of(frame, spec.params.get("bins", stumps.BINS))
    runs = [stumps.Run(rate, fold) for rate in rates for fold in range(k)]
    marks = stumps.fit_runs(stumps.cells_of(frame, edges), edges, runs, max(stages), stages)
    means: list[float] = [0.0] * len(options)
    for g, (_, at) in enumerate(groups):
        for i in at:
            means[i] = statistics.fmean(marks[options[i].get("rounds", base)][g * k : (g + 1) * k])
    return means, len(runs)


def tune(
    models: dict[str, zoo.Fitted],
    frame: DataFrame,
    grids: dict[str, dict],
    k: int = 5,
    n_iter: int | None = None,
    parallel: int = PARALLEL,
) -> tuple[dict[str, zoo.Fitted], DataFrame]:
    """Search each model's grid by cross-validation.

    With ``n_iter`` so many combinations are drawn at random, by a fixed seed and without replacement, and tried in the order
    drawn; a smaller grid is drawn whole. A model without a grid, or whose parameters don't fit it, stays as it is.
    Options of which one is the beginning of another are scored from a single
    fit (:func:`chains`). Returns the models (``fits`` counts what the search fitted)
    and a table ``(model, params, cv_mean, best, failed)``;
    a model that could not be fitted or searched has one row with the reason.
    """
    spark = frame.sparkSession
    tuned, rows = zoo.Fits(), []
    tuned.failed = dict(getattr(models, "failed", {}))
    for name, model in models.items():
        tuned[name] = model
        if name not in grids:
            log.warning("no parameter grid for %s", name)
            continue
        options = combinations(grids[name])
        if n_iter is not None:
            options = random.Random(zoo.SEED).sample(options, min(n_iter, len(options)))
        try:
            means, fits = chain_means(model.spec, frame, options, k, parallel)
            best = max(range(len(means)), key=lambda i: means[i])
            tuned[name] = zoo.fit(model.spec.with_params(**options[best]), frame)
            tuned.fits += fits + 1
        except zoo.PARAMETER_ERRORS as error:
            log.error("search for %s failed: %s", name, error)
            tuned.failed[name] = str(error).splitlines()[0]
            continue
        rows += [(name, str(o), float(m), int(i == best), None) for i, (o, m) in enumerate(zip(options, means))]
    rows += [(name, None, None, 0, reason) for name, reason in tuned.failed.items()]
    table = small_table(spark, rows, "model string, params string, cv_mean double, best int, failed string")
    return tuned, table


# --- stacking --------------------------------------------------------------


class Stacked(zoo.Fitted):
    """Base models' probabilities fed to a final model."""

    def __init__(self, spec: zoo.ModelSpec, bases: dict[str, zoo.Fitted], final: zoo.Fitted):
        self.spec, self.bases, self.final = spec, bases, final

    def score(self, frame: DataFrame) -> DataFrame:
        columns = frame.columns
        current = frame
        for name, base in self.bases.items():
            kept = current.columns
            current = base.score(current).select(*kept, F.col("prob").alias(f"__p_{name}"))
        values = F.array(*[F.col(f"__p_{n}") for n in self.bases])
        vector = zoo.array_to_vector(values)
        stacked = current.withColumn("__own", F.struct(*columns)).withColumn("values", values).withColumn(FEATURES, vector)
        scored = self.final.score(stacked.select("__own", "values", FEATURES))
        return scored.select("__own.*", "prob", "prediction")

    def _save_parts(self, spark, path):
        for i, base in enumerate(self.bases.values()):
            base.save(spark, f"{path}/base{i}")
        self.final.save(spark, f"{path}/final")
        return {"names": list(self.bases)}


def _load_stacked(spark: SparkSession, path: str, spec: zoo.ModelSpec, state: dict) -> Stacked:
    bases = {name: zoo.load(spark, f"{path}/base{i}") for i, name in enumerate(state["names"])}
    return Stacked(spec, bases, zoo.load(spark, f"{path}/final"))


def fit_stacked(
    name: str, bases: Sequence[zoo.ModelSpec], final: zoo.ModelSpec, frame: DataFrame, key: str, k: int = 5,
    scores: DataFrame | None = None, fitted: dict[str, zoo.Fitted] | None = None,
) -> Stacked:
    """Train the final model on out-of-fold probabilities, the bases on all rows.

    ``scores`` and ``fitted`` are used where they are there already; otherwise all fits share one pool.
    """
    names = [s.name for s in bases]
    if scores is None or fitted is None:
        models = fit_folds(bases, frame, [*(range(k) if scores is None else ()), *((None,) if fitted is None else ())])
        scores = out_of_fold(bases, frame, k, models=models) if scores is None else scores
        fitted = {n: models[n, None] for n in names} if fitted is None else fitted
    meta = model_frame(scores.select(key, LABEL, *names), names, LABEL)
    return Stacked(zoo.ModelSpec(name, "stacked"), {n: fitted[n] for n in names}, zoo.fit(final, meta))


class Voting(zoo.Fitted):
    """Plain or weighted mean of the models' probabilities."""

    def __init__(self, spec: zoo.ModelSpec, models: dict[str, zoo.Fitted], weights: dict[str, float] | None = None):
        self.spec, self.models = spec, models
        self.weights = weights or {n: 1.0 for n in models}

    def score(self, frame: DataFrame) -> DataFrame:
        current = frame
        for name, model in self.models.items():
            kept = current.columns
            current = model.score(current).select(*kept, F.col("prob").alias(f"__p_{name}"))
        total = sum(self.weights[n] for n in self.models)
        terms = [F.col(f"__p_{n}") * F.lit(self.weights[n] / total) for n in self.models]
        return zoo._decided(current.select(*frame.columns, sum(terms[1:], terms[0]).alias("prob")))

    def _save_parts(self, spark, path):
        for i, model in enumerate(self.models.values()):
            model.save(spark, f"{path}/model{i}")
        return {"names": list(self.models), "weights": self.weights}


def _load_voting(spark: SparkSession, path: str, spec: zoo.ModelSpec, state: dict) -> Voting:
    models = {name: zoo.load(spark, f"{path}/model{i}") for i, name in enumerate(state["names"])}
    return Voting(spec, models, state["weights"])


zoo.COMPOSITE.update(stacked=_load_stacked, voting=_load_voting)


def ensemble_cv(bases: Sequence[zoo.ModelSpec], final: zoo.ModelSpec, frame: DataFrame, k: int, scores: DataFrame | None = None) -> dict[str, list[float]]:
    """Accuracy on each fold of the plain vote and of the final model, both on scores of models that did not see the fold."""
    names = [s.name for s in bases]
    scores = out_of_fold(bases, frame, k) if scores is None else scores
    vote = sum([F.col(n) for n in names[1:]], F.col(names[0])) / len(names)
    voted = fold_accuracies(scores.withColumn("__vote", vote), ["__vote"], k)["__vote"]
    return {"voting": voted, "stacked": cross_validate(final, model_frame(scores, names, LABEL, keep=[FOLD]), k)}


# --- keeping models --------------------------------------------------------


def save_best(spark: SparkSession, model: zoo.Fitted, root: str, accuracy_value: float, threshold: float, tuned: bool) -> str:
    """Write a model under the root and add a row to the root's index."""
    saved_at = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    path = f"{root}/{model.spec.name}-{saved_at.replace(':', '')}"
    model.save(spark, path)
    row = [(model.spec.name, path, saved_at, accuracy_value, int(accuracy_value >= threshold), int(tuned), str(model.spec.params))]
    columns = "model string, path string, saved_at string, accuracy double, meets_threshold int, tuned int, params string"
    small_table(spark, row, columns).write.mode("append").parquet(f"{root}/index")
    return path


def latest_model(spark: SparkSession, root: str, name: str | None = None) -> zoo.Fitted:
    """The newest model in the root's index, optionally by name."""
    index = spark.read.parquet(f"{root}/index")
    if name:
        index = index.filter(F.col("model") == name)
    row = index.orderBy(F.desc("saved_at")).limit(1).collect()
    if not row:
        raise FileNotFoundError(f"no model in {root}")
    return zoo.load(spark, row[0]["path"])


def folded_frame(df: DataFrame, features: Sequence[str], label: str, key: str, k: int = 5) -> DataFrame:
    """A model frame with a stratified fold number per row."""
    folded = assign_folds(df, key, label, k, name=FOLD)
    return model_frame(folded, features, label, keep=[key, FOLD])


def importance_table(spark: SparkSession, model: zoo.Fitted, names: Sequence[str], top: int | None = None) -> DataFrame:
    """Features by importance, largest first."""
    df = small_table(spark, model.importances(names), "feature string, importance double")
    ordered = df.orderBy(F.desc("importance"), "feature")
    return ordered.limit(top) if top else ordered
