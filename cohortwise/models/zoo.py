"""Model definitions as data, and how each kind is fitted, scored and saved."""

from __future__ import annotations

import json
import logging
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkContext
from pyspark.errors import IllegalArgumentException
from pyspark.ml import classification as C
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.models import bayes, boost, extra, forest, neighbours, stumps
from cohortwise.models.frame import FEATURES, FOLD, LABEL
from cohortwise.operators.joins import attach
from cohortwise.session import materialize, once, scratch_path, small_table

log = logging.getLogger(__name__)

SEED = 42


@dataclass
class ModelSpec:
    """A named model: its kind and the parameters that differ from the defaults."""

    name: str
    kind: str
    params: dict = field(default_factory=dict)

    def with_params(self, **changes) -> ModelSpec:
        return ModelSpec(self.name, self.kind, {**self.params, **changes})


# Kinds that are one Spark ML estimator. They share the parameter names of the
# estimator's constructor.
NATIVE: dict[str, Callable] = {
    "random_forest": C.RandomForestClassifier,
    "logistic": C.LogisticRegression,
    "tree": C.DecisionTreeClassifier,
    "boosted_trees": C.GBTClassifier,
}
_SEEDED = {"random_forest", "tree", "boosted_trees"}
_LOADERS = {
    "random_forest": C.RandomForestClassificationModel,
    "logistic": C.LogisticRegressionModel,
    "tree": C.DecisionTreeClassificationModel,
    "boosted_trees": C.GBTClassificationModel,
}


# What wrong parameters raise; anything else is a fault of the job and goes on to the caller.
PARAMETER_ERRORS = (IllegalArgumentException, ValueError, TypeError, KeyError, AttributeError)


def spark_params(params: dict, rows: int) -> dict:
    """Inverse regularisation ``C`` over ``rows`` rows becomes ``regParam``."""
    out = dict(params)
    if "C" in out:
        out["regParam"] = 1.0 / (out.pop("C") * max(rows, 1))
    return out


def native_estimator(spec: ModelSpec, rows: int = 0):
    """``rows`` is the number of training rows; only ``C`` needs it."""
    params = spark_params(spec.params, rows)
    if spec.kind in _SEEDED:
        params.setdefault("seed", SEED)
    return NATIVE[spec.kind](featuresCol=FEATURES, labelCol=LABEL, **params)


class Fitted:
    """A trained model. ``score`` adds ``prob`` (of label 1) and ``prediction``."""

    spec: ModelSpec

    def score(self, frame: DataFrame) -> DataFrame:
        raise NotImplementedError

    def importances(self, names: Sequence[str]) -> list[tuple[str, float]]:
        raise ValueError(f"{self.spec.name} has no feature importances")

    def save(self, spark: SparkSession, path: str) -> None:
        """Write all parts under a path; the description goes last."""
        state = self._save_parts(spark, path)
        text = json.dumps({"name": self.spec.name, "kind": self.spec.kind, "params": self.spec.params, "state": state})
        spark.createDataFrame([(text,)], "spec string").write.mode("overwrite").parquet(f"{path}/spec")

    def _save_parts(self, spark: SparkSession, path: str) -> dict:
        raise NotImplementedError


def _decided(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction", (F.col("prob") > 0.5).cast("int"))


class NativeFitted(Fitted):
    def __init__(self, spec: ModelSpec, model):
        self.spec, self.model = spec, model

    def first(self, trees: int) -> NativeFitted:
        """A forest or a boosted model of only its first trees."""
        java, gateway = self.model._java_obj, SparkContext._active_spark_context._gateway
        ml, forest = gateway.jvm.org.apache.spark.ml, isinstance(self.model, C.RandomForestClassificationModel)
        kept = list(java.trees())[:trees]
        part = gateway.new_array(ml.classification.DecisionTreeClassificationModel if forest else ml.regression.DecisionTreeRegressionModel, len(kept))
        for i, tree in enumerate(kept):
            part[i] = tree
        if forest:
            made = ml.classification.RandomForestClassificationModel(java.uid(), part, java.numFeatures(), java.numClasses())
            return NativeFitted(self.spec.with_params(numTrees=trees), C.RandomForestClassificationModel(made))
        weights = gateway.new_array(gateway.jvm.double, len(kept))
        for i, weight in enumerate(list(java.treeWeights())[:trees]):
            weights[i] = weight
        made = ml.classification.GBTClassificationModel(java.uid(), part, weights, java.numFeatures(), java.numClasses())
        return NativeFitted(self.spec.with_params(maxIter=trees), C.GBTClassificationModel(made))

    def score(self, frame: DataFrame) -> DataFrame:
        scored = self.model.transform(frame)
        prob = vector_to_array("probability")[1]
        return _decided(scored.select(*frame.columns, prob.alias("prob")))

    def importances(self, names):
        if not hasattr(self.model, "featureImportances"):
            return super().importances(names)
        values = self.model.featureImportances.toArray()
        if len(values) != len(names):
            raise ValueError("one name per feature")
        return list(zip(names, [float(v) for v in values]))

    def _save_parts(self, spark, path):
        self.model.write().overwrite().save(f"{path}/model")
        return {}


# --- naive Bayes -----------------------------------------------------------


class BayesFitted(Fitted):
    """Gaussian naive Bayes as one expression over the value array."""

    def __init__(self, spec: ModelSpec, gaussians: bayes.Gaussians):
        self.spec, self.gaussians = spec, gaussians

    def score(self, frame: DataFrame) -> DataFrame:
        return _decided(frame.select(*frame.columns, self.gaussians.prob().alias("prob")))

    def _save_parts(self, spark, path):
        return vars(self.gaussians)


def fit_bayes(spec: ModelSpec, frame: DataFrame) -> BayesFitted:
    return fit_bayes_folds(spec, frame.drop(FOLD), [None])[0]


def fit_bayes_folds(spec: ModelSpec, frame: DataFrame, folds: Sequence[int | None]) -> list[BayesFitted]:
    """One model for each fold to leave out, all from one pass over the rows."""
    return [BayesFitted(spec, found) for found in bayes.fit(frame, folds)]


# --- support vector machine ------------------------------------------------


def _fourier(matrix: np.ndarray, offsets: np.ndarray):
    """Random Fourier features of a value array, batch by batch."""
    scale = math.sqrt(2.0 / len(offsets))

    @F.pandas_udf("array<double>")
    def project(values: pd.Series) -> pd.Series:
        if values.empty:
            return pd.Series([], dtype=object)
        stacked = np.stack(values.to_numpy())
        return pd.Series(list(scale * np.cos(stacked @ matrix + offsets)))

    return project


class SvcFitted(Fitted):
    """Linear SVM, optionally on random Fourier features of an RBF kernel, with
    a logistic curve over the margin as probability."""

    def __init__(self, spec: ModelSpec, svm, curve, gamma: float | None, size: int):
        self.spec, self.svm, self.curve, self.gamma, self.size = spec, svm, curve, gamma, size

    def margins(self, frame: DataFrame) -> DataFrame:
        return _margins(self.spec, self.svm, frame, self.gamma, self.size)

    def score(self, frame: DataFrame) -> DataFrame:
        slope, shift = float(self.curve.coefficients[0]), float(self.curve.intercept)
        prob = 1.0 / (1.0 + F.exp(-(F.col("__margin") * slope + shift)))
        return _decided(self.margins(frame).select(*frame.columns, prob.alias("prob")))

    def _save_parts(self, spark, path):
        self.svm.write().overwrite().save(f"{path}/model")
        self.curve.write().overwrite().save(f"{path}/curve")
        return {"gamma": self.gamma, "size": self.size}


def _mapped(spec: ModelSpec, frame: DataFrame, gamma: float | None, size: int) -> DataFrame:
    if gamma is None:
        return frame.withColumn("__mapped", F.col(FEATURES))
    return frame.withColumn("__mapped", array_to_vector(_fourier(*_waves(spec, gamma, size))("values")))


def _waves(spec: ModelSpec, gamma: float, size: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(spec.params.get("seed", SEED))
    width = spec.params.get("components", 64)
    matrix = rng.normal(0.0, math.sqrt(2.0 * gamma), (size, width))
    return matrix, rng.uniform(0.0, 2.0 * math.pi, width)


def _margins(spec: ModelSpec, svm, frame: DataFrame, gamma: float | None, size: int) -> DataFrame:
    """``__margin`` of every row, in one step from its values: only one number a row leaves the batches."""
    weights, shift = svm.coefficients.toArray(), svm.intercept
    matrix, offsets = (None, None) if gamma is None else _waves(spec, gamma, size)
    scale = math.sqrt(2.0 / len(weights))

    @F.pandas_udf("double")
    def margin(values: pd.Series) -> pd.Series:
        if values.empty:
            return pd.Series([], dtype="float64")
        stacked = np.stack(values.to_numpy())
        return pd.Series((stacked if matrix is None else scale * np.cos(stacked @ matrix + offsets)) @ weights + shift)

    return frame.withColumn("__margin", margin("values"))


def _scale_gamma(frame: DataFrame, size: int) -> float:
    """One over features times the variance of all matrix entries."""
    entry = F.explode("values").alias("x")
    variance = frame.select(entry).agg(F.var_pop("x")).first()[0]
    return 1.0 / (size * variance) if variance else 1.0 / size


def fit_svc(spec: ModelSpec, frame: DataFrame) -> SvcFitted:
    size = len(frame.select("values").first()["values"])
    gamma = spec.params.get("gamma", "scale") if spec.params.get("kernel", "rbf") == "rbf" else None
    if gamma == "scale":
        gamma = _scale_gamma(frame, size)
    elif gamma == "auto":
        gamma = 1.0 / size
    penalty = 1.0 / (spec.params.get("C", 1.0) * max(frame.count(), 1))
    mapped = _mapped(spec, frame, gamma, size)
    svm = C.LinearSVC(featuresCol="__mapped", labelCol=LABEL, regParam=penalty, maxIter=spec.params.get("maxIter", 50))
    fitted = svm.fit(mapped)
    # Written, as the curve reads them several times.
    margins = materialize(_margins(spec, fitted, frame, gamma, size).select(LABEL, "__margin"), "margins").withColumn("__m", array_to_vector(F.array("__margin")))
    curve = C.LogisticRegression(featuresCol="__m", labelCol=LABEL).fit(margins)
    return SvcFitted(spec, fitted, curve, gamma, size)


# --- adaptive boosting -----------------------------------------------------


class StumpsFitted(Fitted):
    """Weighted vote of one-split trees."""

    def __init__(self, spec: ModelSpec, run: stumps.Run):
        self.spec, self.run = spec, run

    def score(self, frame: DataFrame) -> DataFrame:
        prob = 1.0 / (1.0 + F.exp(-stumps.margin(self.run)))
        return _decided(frame.select(*frame.columns, prob.alias("prob")))

    def _save_parts(self, spark, path):
        return {"stumps": self.run.stumps, "alphas": self.run.alphas, "errors": self.run.errors}


class AdaFitted(Fitted):
    """Weighted vote of shallow trees."""

    def __init__(self, spec: ModelSpec, trees: list, alphas: list[float]):
        self.spec, self.trees, self.alphas = spec, trees, alphas

    def score(self, frame: DataFrame) -> DataFrame:
        total = sum(self.alphas) or 1.0
        signed = [F.lit(a) * (2 * tree_vote(tree) - 1) for a, tree in zip(self.alphas, self.trees)]
        decision = sum(signed[1:], signed[0]) / total
        return _decided(frame.select(*frame.columns, (1.0 / (1.0 + F.exp(-decision))).alias("prob")))

    def _save_parts(self, spark, path):
        for i, tree in enumerate(self.trees):
            tree.write().overwrite().save(f"{path}/tree{i}")
        return {"alphas": self.alphas}


def tree_vote(tree, depth: int | None = None) -> Column:
    """A tree's prediction as one expression over the value array, so that many trees are one projection.

    With ``depth`` the tree is cut there: its inner nodes vote for their own majority.
    """

    def branch(node, left_over: int | None) -> Column:
        if node.subtreeDepth() == 0 or left_over == 0:
            return F.lit(float(node.prediction()))
        split, below = node.split(), None if left_over is None else left_over - 1
        left = F.col("values")[split.featureIndex()] <= split.threshold()
        return F.when(left, branch(node.leftChild(), below)).otherwise(branch(node.rightChild(), below))

    return branch(tree._call_java("rootNode"), depth)


def tree_nodes(spark: SparkSession, tree) -> tuple[np.ndarray, ...]:
    """(feature, threshold, left, right, prediction, rows) of a tree's nodes by number, the root first; leaves have feature -1.

    Read from the stored model: asking for each node of a deep tree by itself takes a call for every field.
    """
    path = scratch_path(spark, "tree")
    tree.write().save(path)
    stored = spark.read.parquet(f"{path}/data").select("id", "prediction", "leftChild", "rightChild", "split.featureIndex", "split.leftCategoriesOrThreshold", "rawCount")
    rows = sorted(stored.collect())  # bounded by the tree's depth
    threshold = [r[5][0] if r[2] >= 0 else 0.0 for r in rows]
    columns = [[r[4] if r[2] >= 0 else -1 for r in rows], threshold, *[[r[i] for r in rows] for i in (2, 3, 1, 6)]]
    return tuple(np.array(c) for c in columns)


def depth_votes(spark: SparkSession, tree, depths: Sequence[int], sizes: Sequence[int] | None = None):
    """A function of the value array: the votes of the tree cut at each of these depths, all from one walk down.

    With ``sizes``, one for each depth, nodes of fewer rows are not split either: a node's split does not depend on what is below, so
    this is the tree grown with that bound. Inner nodes vote for their own majority, as in :func:`tree_vote`, whose expression a
    deep tree would make too long.
    """
    shared = spark.sparkContext.broadcast(tree_nodes(spark, tree))
    wanted = list(zip(depths, sizes or [0] * len(depths)))

    @F.pandas_udf("array<double>")
    def vote(values: pd.Series) -> pd.Series:
        if values.empty:
            return pd.Series([], dtype=object)
        feature, threshold, left, right, prediction, rows = shared.value
        x = np.stack(values.to_numpy())
        out, row = np.empty((len(x), len(wanted))), np.arange(len(x))
        for size in {s for _, s in wanted}:
            node, inner = np.zeros(len(x), np.int64), np.where(rows >= size, feature, -1)
            for depth in range(max(d for d, s in wanted if s == size) + 1):
                for at, option in enumerate(wanted):
                    if option == (depth, size):
                        out[:, at] = prediction[node]
                f = inner[node]
                below = np.where(x[row, np.maximum(f, 0)] <= threshold[node], left[node], right[node])
                node = np.where(f >= 0, below, node)
        return pd.Series(list(out))

    return vote("values")


def fit_tree(spec: ModelSpec, frame: DataFrame) -> NativeFitted:
    """Spark's tree. With ``minSplit``, which Spark does not have, nodes of fewer rows are made leaves."""
    params = {n: v for n, v in spec.params.items() if n != "minSplit"}
    model = native_estimator(ModelSpec(spec.name, spec.kind, params)).fit(frame)
    return NativeFitted(spec, _cut(frame.sparkSession, model, spec.params["minSplit"]) if spec.params.get("minSplit", 2) > 2 else model)


def _cut(spark: SparkSession, tree, size: int):
    """The tree without splits of nodes of fewer than ``size`` rows, and as Spark keeps its trees: without splits whose two leaves predict the same."""
    whole, path = scratch_path(spark, "tree"), scratch_path(spark, "tree")
    tree.write().save(whole)
    nodes = {r["id"]: r.asDict() for r in spark.read.parquet(f"{whole}/data").collect()}  # bounded by the tree's depth
    for i in sorted(nodes, reverse=True):  # children have larger numbers
        node = nodes[i]
        a, b = (nodes.get(node[side]) for side in ("leftChild", "rightChild"))
        if a is None or node["rawCount"] < size or a["leftChild"] < 0 and b["leftChild"] < 0 and a["prediction"] == b["prediction"]:
            node.update(leftChild=-1, rightChild=-1, gain=-1.0, split=(-1, [], -1))
    kept, todo = [], [0]
    while todo:  # each node before its own, the left ones first
        kept.append(todo.pop())
        if nodes[kept[-1]]["leftChild"] >= 0:
            todo += [nodes[kept[-1]]["rightChild"], nodes[kept[-1]]["leftChild"]]
    number = {-1: -1, **{old: new for new, old in enumerate(kept)}}
    schema = spark.read.parquet(f"{whole}/data").schema
    rows = [tuple({**nodes[i], "id": number[i], **{side: number[nodes[i][side]] for side in ("leftChild", "rightChild")}}[c] for c in schema.names) for i in kept]
    spark.read.text(f"{whole}/metadata").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/data")
    return _LOADERS["tree"].load(path)


def fit_ada(spec: ModelSpec, frame: DataFrame) -> Fitted:
    """Boosting by reweighting: after each tree the rows it got wrong weigh more.

    Trees of one split are boosted on a binned count layout (``stumps``), one job a round.
    """
    if spec.params.get("maxDepth", 1) > 1:
        return _fit_deep_ada(spec, frame)
    return fit_ada_runs(spec, frame, [(spec.params.get("learning_rate", 1.0), None)])[0]


def fit_ada_runs(spec: ModelSpec, frame: DataFrame, wanted: Sequence[tuple[float, int | None]]) -> list[StumpsFitted]:
    """One model for each (rate, fold to leave out), all boosted side by side; ``frame`` has a fold column if folds are left out."""
    edges = stumps.edges_of(frame, spec.params.get("bins", stumps.BINS))
    runs = [stumps.Run(rate, fold) for rate, fold in wanted]
    stumps.fit_runs(stumps.cells_of(frame, edges), edges, runs, spec.params.get("rounds", 100))
    return [StumpsFitted(spec.with_params(learning_rate=run.rate), run) for run in runs]


def _fit_deep_ada(spec: ModelSpec, frame: DataFrame) -> AdaFitted:
    """Weights are a column; every ``checkpoint_every`` rounds they are written to
    the shared folder, which keeps the plan short and survives lost executors."""
    rounds, rate = spec.params.get("rounds", 100), spec.params.get("learning_rate", 1.0)
    every, depth = spec.params.get("checkpoint_every", 5), spec.params["maxDepth"]
    trees, alphas = [], []
    current = frame.select("values", LABEL, FEATURES).withColumn("__w", F.lit(1.0))
    for i in range(rounds):
        tree = C.DecisionTreeClassifier(
            featuresCol=FEATURES, labelCol=LABEL, weightCol="__w", maxDepth=depth, seed=SEED
        ).fit(current)
        voted = current.withColumn("__miss", (tree_vote(tree) != F.col(LABEL)).cast("double"))
        sums = voted.agg(
            F.sum(F.col("__w") * F.col("__miss")).alias("wrong"), F.sum("__w").alias("all"), F.count(F.lit(1)).alias("n")
        ).first()
        error = sums["wrong"] / sums["all"]
        if error >= 0.5:
            if not trees:
                trees, alphas = [tree], [1.0]
            break
        alpha = rate * math.log((1 - error) / max(error, 1e-10))
        trees.append(tree)
        alphas.append(alpha)
        if error <= 0.0:
            break
        grown = F.col("__w") * F.exp(F.lit(alpha) * F.col("__miss")) * F.lit(sums["n"] / sums["all"])
        current = voted.withColumn("__w", grown).drop("__miss")
        if (i + 1) % every == 0:
            written = materialize(current.drop(FEATURES), "weights")
            current = written.withColumn(FEATURES, array_to_vector("values"))
    return AdaFitted(spec, trees, alphas)


# --- random forests ----------------------------------------------------------

# Parameters the forest on binned cells knows; with others Spark's own estimator takes the rows.
_CELL_PARAMS = {"numTrees", "maxDepth", "minInstancesPerNode", "featureSubsetStrategy", "impurity", "maxBins", "seed"}
_SUBSETS: dict[str, Callable[[int], int]] = {
    "all": lambda n: n, "sqrt": lambda n: math.ceil(math.sqrt(n)), "log2": lambda n: max(1, math.ceil(math.log2(n))), "onethird": lambda n: math.ceil(n / 3),
}


def _binned(frame: DataFrame, bins: int) -> tuple[list[list[float]], DataFrame | None, list[int]]:
    """Edges, cells (none without features) and up to three labels, found once for the forest and the boosted trees of this frame."""

    def make():
        edges = stumps.edges_of(frame, bins)
        cells = forest.cells_of(frame, edges) if edges else None
        return edges, cells, [] if cells is None else [r["label"] for r in cells.select("label").distinct().limit(3).collect()]

    return once(frame, ("cells", bins), make)


def fit_forest(spec: ModelSpec, frame: DataFrame) -> NativeFitted:
    """A forest of Spark's own kind, grown on binned cells (``forest``): its work goes by the distinct cells, not by the rows."""
    estimator = native_estimator(spec)
    trees, strategy, bins = estimator.getNumTrees(), estimator.getFeatureSubsetStrategy(), estimator.getMaxBins()
    strategy = ("all" if trees == 1 else "sqrt") if strategy == "auto" else strategy
    if not set(spec.params) <= _CELL_PARAMS or strategy not in _SUBSETS or bins > 255 or not estimator.getMaxDepth():
        return NativeFitted(spec, estimator.fit(frame))
    edges, cells, kinds = _binned(frame, bins)
    if not kinds or not set(kinds) <= {0, 1}:
        return NativeFitted(spec, estimator.fit(frame))
    grown = forest.grow(
        cells, len(edges), max(map(len, edges)) + 1, trees, estimator.getMaxDepth(), _SUBSETS[strategy](len(edges)),
        estimator.getMinInstancesPerNode(), estimator.getImpurity(), estimator.getSeed(),
    )
    return NativeFitted(spec, _forest_model(frame.sparkSession, estimator, grown, edges))


def _forest_model(spark: SparkSession, estimator, grown: list[forest.Grown], edges: Sequence[Sequence[float]]) -> C.RandomForestClassificationModel:
    """Grown trees as a Spark model, by way of its stored form."""
    kind, counts = estimator.getImpurity(), np.concatenate([t.counts for t in grown])
    params = {p.name: v for p, v in estimator.extractParamMap().items()}
    own = {n: v for n, v in params.items() if n not in ("numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap")}
    facts = ((counts[:, 1] > counts[:, 0]).astype(float), forest.impurities(counts, kind), counts.sum(axis=1), [counts[:, 0], counts[:, 1]])
    names = ("RandomForestClassificationModel", "DecisionTreeClassificationModel")
    path = _stored_trees(spark, "forest", estimator.uid, names, {"numClasses": 2}, params, own, grown, [1.0] * len(grown), edges, *facts)
    return C.RandomForestClassificationModel.load(path)


def _stored_trees(
    spark: SparkSession, folder: str, uid: str, names: tuple[str, str], size: dict, params: dict, own: dict, grown: list[forest.Grown], weights: Sequence[float],
    edges: Sequence[Sequence[float]], prediction: np.ndarray, impurity: np.ndarray, rows: np.ndarray, stats: list[np.ndarray],
) -> str:
    """Write grown trees in the stored form of Spark's ensembles; ``names`` are the classes of the model and of its trees."""
    path = scratch_path(spark, folder)

    def about(name: str, uid: str, values: dict, **more) -> str:
        part = "classification" if "Classification" in name else "regression"
        return json.dumps({
            "class": f"org.apache.spark.ml.{part}.{name}", "timestamp": 0, "sparkVersion": spark.version,
            "uid": uid, "paramMap": values, "defaultParamMap": {}, **more,
        })

    text = about(names[0], uid, params, numFeatures=len(edges), numTrees=len(grown), **size)
    small_table(spark, [(text,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    # The trees of a model have no classes where they are regressions.
    more = {} if size else {"numFeatures": len(edges)}
    each = [(i, about(names[1], f"{uid}_{i}", own, **more), float(w)) for i, w in enumerate(weights)]
    small_table(spark, each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    inner = np.concatenate([t.left >= 0 for t in grown])
    feature, cut, left, gain = (np.concatenate([getattr(t, c) for t in grown]) for c in ("feature", "cut", "left", "gain"))
    # A cut after a feature's last edge can't be a split, so every inner node has an edge.
    threshold = [edges[f][b] if i else 0.0 for f, b, i in zip(feature.tolist(), cut.tolist(), inner.tolist())]
    columns = [
        np.repeat(np.arange(len(grown)), [len(t.left) for t in grown]), np.concatenate([np.arange(len(t.left)) for t in grown]),
        prediction, impurity, rows, gain, left, np.where(inner, left + 1, -1), np.where(inner, feature, -1), np.array(threshold), *stats,
    ]
    kept = [f"s{i}" for i in range(len(stats))]
    names, whole = ["tree", "id", "prediction", "impurity", "rows", "gain", "left", "right", "feature", "cut", *kept], ("tree", "id", "left", "right", "feature")
    arrays = [pa.array(c, pa.int32() if n in whole else pa.float64()) for n, c in zip(names, columns)]
    flat = spark.createDataFrame(pa.table(arrays, names))
    split = F.struct(
        F.col("feature").alias("featureIndex"), F.when(F.col("feature") >= 0, F.array("cut")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"),
    )
    node = F.struct(
        "id", "prediction", "impurity", F.array(*kept).alias("impurityStats"), F.col("rows").cast("long").alias("rawCount"), "gain",
        F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split"),
    )
    flat.select(F.col("tree").alias("treeID"), node.alias("nodeData")).write.parquet(f"{path}/data")
    return path


# --- boosted trees -------------------------------------------------------------

# Parameters with which boosting sees no single rows: a share of rows for each tree is drawn by cell. With others
# (smallest nodes and the like) Spark's estimator takes the rows.
_DRAWN_PARAMS = {"maxIter", "stepSize", "maxDepth", "seed", "subsamplingRate"}


def draws_rows(spec: ModelSpec) -> bool:
    """Boosted trees that each see a share of the rows: all folds are boosted in one run."""
    return spec.kind == "boosted_trees" and "subsamplingRate" in spec.params and set(spec.params) <= _DRAWN_PARAMS


def fit_boosted_folds(spec: ModelSpec, frame: DataFrame, folds: Sequence[int | None]) -> list[NativeFitted]:
    """One model for each fold to leave out, all boosted side by side on cells of the same bins."""
    estimator = native_estimator(spec)
    kept = F.col(FOLD) if FOLD in frame.columns else F.lit(-1)
    edges = stumps.edges_of(frame, estimator.getMaxBins())
    cells = forest.cells_of(frame, edges, F.coalesce(kept, F.lit(-1))) if edges else None
    kinds = [] if cells is None else [r["label"] for r in cells.select("label").distinct().limit(3).collect()]
    runs = [boost.Run(fold) for fold in folds]
    if kinds and set(kinds) <= {0, 1} and estimator.getMaxDepth():
        boost.fit_runs(cells, edges, runs, estimator.getMaxIter(), estimator.getMaxDepth(), estimator.getStepSize(), estimator.getSubsamplingRate(), estimator.getSeed())

    def model(run: boost.Run) -> NativeFitted:
        if not run.trees:
            return NativeFitted(spec, estimator.fit(frame if run.held_out is None else frame.filter(F.col(FOLD) != run.held_out)))
        return NativeFitted(spec, _boosted_model(frame.sparkSession, estimator, run, edges))

    with ThreadPool(len(runs)) as pool:
        return pool.map(model, runs, chunksize=1)


def _boosted_model(spark: SparkSession, estimator, run: boost.Run, edges: Sequence[Sequence[float]]) -> C.GBTClassificationModel:
    """Boosted trees as a Spark model. The spread within nodes is not kept, as neither scores nor importances read it."""
    params = {p.name: v for p, v in estimator.extractParamMap().items()}
    own = {n: v for n, v in params.items() if n in ("featuresCol", "labelCol", "predictionCol", "maxDepth", "maxBins", "seed")}
    counts = np.concatenate([t.counts for t in run.trees])
    rows, total = counts[:, 0], counts[:, 1] / run.unit
    mean = total / np.maximum(rows, 1)
    names, none = ("GBTClassificationModel", "DecisionTreeRegressionModel"), np.zeros(len(rows))
    path = _stored_trees(spark, "boosted", estimator.uid, names, {}, params, own, run.trees, run.weights, edges, mean, none, rows, [rows, total, total * mean])
    return C.GBTClassificationModel.load(path)


def fit_boosted(spec: ModelSpec, frame: DataFrame) -> NativeFitted:
    """Boosted trees of Spark's own kind, grown on binned cells (``boost``) unless a parameter needs single rows."""
    if draws_rows(spec):
        return fit_boosted_folds(spec, frame.drop(FOLD), [None])[0]
    estimator = native_estimator(spec)
    if not set(spec.params) <= _DRAWN_PARAMS or not estimator.getMaxDepth():
        return NativeFitted(spec, estimator.fit(frame))
    edges, cells, kinds = _binned(frame, estimator.getMaxBins())
    if not kinds or not set(kinds) <= {0, 1}:
        return NativeFitted(spec, estimator.fit(frame))
    run = boost.Run(None)
    boost.fit_runs(cells.withColumn("fold", F.lit(-1)), edges, [run], estimator.getMaxIter(), estimator.getMaxDepth(), estimator.getStepSize(), 1.0, estimator.getSeed())
    return NativeFitted(spec, _boosted_model(frame.sparkSession, estimator, run, edges))


# --- extremely randomised trees ---------------------------------------------


class ExtraFitted(Fitted):
    """Mean of extremely randomised trees."""

    def __init__(self, spec: ModelSpec, trees: list[extra.Tree]):
        self.spec, self.trees = spec, trees

    def first(self, trees: int) -> ExtraFitted:
        return ExtraFitted(self.spec.with_params(numTrees=trees), self.trees[:trees])

    def score(self, frame: DataFrame) -> DataFrame:
        depth = self.spec.params.get("maxDepth", 5)
        shared = frame.sparkSession.sparkContext.broadcast([t.arrays(depth) for t in self.trees])

        @F.pandas_udf("double")
        def vote(values: pd.Series) -> pd.Series:
            return pd.Series(extra.predict(np.stack(values.to_numpy()), shared.value, depth) if len(values) else [], dtype="float64")

        return _decided(frame.withColumn("prob", vote("values")))

    def _save_parts(self, spark, path):
        rows = [(i, n, f, t.threshold.get(n, 0.0), t.share.get(n, 0.0)) for i, t in enumerate(self.trees) for n, f in t.feature.items()]
        small_table(spark, rows, "tree int, node long, feature int, threshold double, share double").write.mode("overwrite").parquet(f"{path}/trees")
        return {"trees": len(self.trees)}


def fit_extra(spec: ModelSpec, frame: DataFrame) -> ExtraFitted:
    return fit_extra_folds(spec, frame, [None])[0]


def fit_extra_folds(spec: ModelSpec, frame: DataFrame, folds: Sequence[int | None]) -> list[ExtraFitted]:
    """One model for each fold to leave out, all grown side by side."""
    p = spec.params
    return [ExtraFitted(spec, trees) for trees in extra.grow(frame, p.get("numTrees", 100), p.get("maxDepth", 5), folds, p.get("minSplit", 2), p.get("seed", SEED))]


def _load_extra(spark: SparkSession, path: str, spec: ModelSpec, state: dict) -> ExtraFitted:
    trees = [extra.Tree({}, {}, {}) for _ in range(state["trees"])]
    for r in spark.read.parquet(f"{path}/trees").collect():  # bounded when it was grown
        trees[r["tree"]].feature[r["node"]], trees[r["tree"]].threshold[r["node"]], trees[r["tree"]].share[r["node"]] = r["feature"], r["threshold"], r["share"]
    return ExtraFitted(spec, trees)


# --- nearest neighbours ----------------------------------------------------

# Up to so many distinct training points are sent to all tasks; more stay a table, and
# rows meet them by the neighbour join. "prototypes" always keeps cluster centres.
FIT_POINTS = 20_000


class KnnFitted(Fitted):
    """Distance-weighted vote of the nearest of a bounded number of points."""

    def __init__(self, spec: ModelSpec, points: np.ndarray, counts: np.ndarray, positives: np.ndarray):
        self.spec, self.points, self.counts, self.positives = spec, points, counts, positives

    def score(self, frame: DataFrame) -> DataFrame:
        voted = self.with_votes(frame, [_knn_option(self.spec.params)])
        return _decided(voted.withColumn("prob", F.col("__votes")[0]).drop("__votes"))

    def with_votes(self, frame: DataFrame, options: Sequence[tuple[int, str]]) -> DataFrame:
        """``__votes``: an array with one probability for each (k, weights), all from one list of the nearest points."""
        shared = frame.sparkSession.sparkContext.broadcast((self.points, self.counts, self.positives))
        return frame.withColumn("__votes", _knn_votes(shared, options, power(self.spec.params))("values"))

    def _save_parts(self, spark, path):
        rows = [(p.tolist(), float(c), float(y)) for p, c, y in zip(self.points, self.counts, self.positives)]
        spark.createDataFrame(rows, "point array<double>, n double, y double").write.mode("overwrite").parquet(f"{path}/points")
        return {}


def power(params: dict) -> int:
    """The power of a neighbour model's distance: 2 is Euclidean (also Minkowski's default), 1 Manhattan."""
    return {"euclidean": 2, "minkowski": 2, "manhattan": 1}[params.get("metric", "euclidean")]


def _knn_votes(shared, options: Sequence[tuple[int, str]], p: int):
    """Votes of the nearest points, by Euclidean or Manhattan distance (``p`` 2 or 1), for every (k, weights)."""

    @F.pandas_udf("array<double>")
    def vote(values: pd.Series) -> pd.Series:
        if values.empty:
            return pd.Series([], dtype=object)
        points, counts, positives = shared.value
        squares, share = (points**2).sum(axis=1), positives / counts
        queries = np.stack(values.to_numpy())
        out = np.empty((len(queries), len(options)))
        near = min(max(k for k, _ in options), len(points))
        rows = 512 if p == 2 else max(1, (1 << 22) // points.size)
        for start in range(0, len(queries), rows):
            block = queries[start : start + rows]
            if p == 2:
                d2 = np.maximum((block**2).sum(axis=1)[:, None] - 2 * block @ points.T + squares, 0.0)
            else:
                d2 = np.abs(block[:, None] - points[None]).sum(axis=2) ** 2
            pick = np.argpartition(d2, near - 1, axis=1)[:, :near]
            # The product above is rounded, which would hide equal points.
            dist = np.sqrt(((points[pick] - block[:, None]) ** 2).sum(axis=2) if p == 2 else np.take_along_axis(d2, pick, 1))
            order = np.argsort(dist, axis=1, kind="stable")
            pick, dist = np.take_along_axis(pick, order, 1), np.take_along_axis(dist, order, 1)
            size = counts[pick]
            before = np.cumsum(size, axis=1) - size
            for at, (k, weights) in enumerate(options):
                taken = np.clip(k - before, 0, size)
                weight = np.ones_like(dist)
                if weights == "distance":
                    exact = (dist < 1e-9) & (taken > 0)
                    weight = np.where(exact.any(axis=1)[:, None], exact.astype(float), 1.0 / np.maximum(dist, 1e-9))
                out[start : start + rows, at] = (taken * weight * share[pick]).sum(axis=1) / (taken * weight).sum(axis=1)
        return pd.Series(list(out))

    return vote


def _distinct_points(frame: DataFrame) -> DataFrame:
    counts = frame.groupBy("values").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(LABEL).cast("double").alias("y"))
    return materialize(counts, "points")


def _knn_option(params: dict) -> tuple[int, str]:
    return params.get("k", 7), params.get("weights", "distance")


class NeighbourFitted(Fitted):
    """Distance-weighted vote of the nearest of all training points, which are a table (values, n, y) of any size."""

    def __init__(self, spec: ModelSpec, points: DataFrame):
        self.spec, self.points = spec, points

    def score(self, frame: DataFrame) -> DataFrame:
        voted = self.with_votes(frame, [_knn_option(self.spec.params)])
        return _decided(voted.withColumn("prob", F.col("__votes")[0]).drop("__votes"))

    def with_votes(self, frame: DataFrame, options: Sequence[tuple[int, str]]) -> DataFrame:
        found = neighbours.neighbours(self.points, frame, max(k for k, _ in options), p=power(self.spec.params))
        votes = F.array(*[_near_vote(k, weights) for k, weights in options])
        return attach(frame, materialize(found.select("values", votes.alias("__votes")), "votes"), ["values"])

    def _save_parts(self, spark, path):
        self.points.write.mode("overwrite").parquet(f"{path}/points")
        return {"table": True}


def _near_vote(k: int, weights: str) -> Column:
    """The share of label 1 among the ``k`` nearest rows of ``near``; equal points alone decide where there are any."""
    exact = F.col("near")[0]["d2"] == 0.0

    def add(acc: Column, x: Column) -> Column:
        weight = F.lit(1.0) if weights == "uniform" else F.when(exact, (x["d2"] == 0.0).cast("double")).otherwise(1.0 / F.sqrt(x["d2"]))
        taken = F.least(acc["left"], x["n"])
        part = taken * weight
        return F.struct((acc["left"] - taken).alias("left"), (acc["up"] + part * x["y"] / x["n"]).alias("up"), (acc["down"] + part).alias("down"))

    start = F.struct(F.lit(float(k)).alias("left"), F.lit(0.0).alias("up"), F.lit(0.0).alias("down"))
    return F.aggregate("near", start, add, lambda acc: acc["up"] / acc["down"])


def fit_nearest(spec: ModelSpec, frame: DataFrame) -> KnnFitted | NeighbourFitted:
    """Keep all distinct training points: up to ``fit_points`` of them are sent to all tasks, more are joined."""
    distinct = _distinct_points(frame)
    if distinct.count() > spec.params.get("fit_points", FIT_POINTS):
        return NeighbourFitted(spec, distinct)
    rows = distinct.orderBy(F.xxhash64("values"), "values").collect()
    return KnnFitted(spec, *[np.array([r[c] for r in rows]) for c in ("values", "n", "y")])


def fit_prototypes(spec: ModelSpec, frame: DataFrame) -> KnnFitted:
    """Summarise the training points by ``prototypes`` cluster centres, each with the rows and labels of its cluster."""
    weighted = _distinct_points(frame).withColumn(FEATURES, array_to_vector("values"))
    centres = KMeans(
        k=spec.params.get("prototypes", 500), seed=SEED, featuresCol=FEATURES, weightCol="n",
        maxIter=spec.params.get("maxIter", 10), predictionCol="__c",
    ).fit(weighted)
    places = centres.clusterCenters()
    rows = centres.transform(weighted).groupBy("__c").agg(F.sum("n").alias("n"), F.sum("y").alias("y")).collect()
    return KnnFitted(spec, np.array([places[r["__c"]] for r in rows]), np.array([r["n"] for r in rows]), np.array([r["y"] for r in rows]))


# --- fitting and loading ---------------------------------------------------

CUSTOM: dict[str, Callable[[ModelSpec, DataFrame], Fitted]] = {
    "tree": fit_tree, "random_forest": fit_forest, "boosted_trees": fit_boosted, "gaussian_nb": fit_bayes, "extra_trees": fit_extra, "svc": fit_svc, "ada_boost": fit_ada, "nearest": fit_nearest, "prototypes": fit_prototypes,
}
# Kinds made of other models add how they are read here.
COMPOSITE: dict[str, Callable[[SparkSession, str, ModelSpec, dict], Fitted]] = {}


def fit(spec: ModelSpec, frame: DataFrame) -> Fitted:
    if spec.kind in CUSTOM:
        return CUSTOM[spec.kind](spec, frame)
    rows = frame.count() if "C" in spec.params else 0
    return NativeFitted(spec, native_estimator(spec, rows).fit(frame))


class Fits(dict):
    """Fitted models by name; ``failed`` has the reason for each that its parameters ruled out, ``fits`` counts a search's fits."""

    def __init__(self):
        super().__init__()
        self.failed: dict[str, str] = {}
        self.fits = 0


def fit_all(specs: Sequence[ModelSpec], frame: DataFrame, parallel: int = 8) -> Fits:
    """Fit every model, side by side. Wrong parameters are reported in ``failed``; any other error, such as a lost cluster, is raised."""

    def one(spec: ModelSpec):
        try:
            return fit(spec, frame)
        except PARAMETER_ERRORS as error:
            log.error("could not fit %s: %s", spec.name, error)
            return str(error).splitlines()[0]

    fitted = Fits()
    with ThreadPool(min(parallel, max(len(specs), 1))) as pool:
        for spec, done in zip(specs, pool.map(one, specs, chunksize=1)):
            if isinstance(done, Fitted):
                fitted[spec.name] = done
            else:
                fitted.failed[spec.name] = done
    return fitted


def load(spark: SparkSession, path: str) -> Fitted:
    text = json.loads(spark.read.parquet(f"{path}/spec").first()["spec"])
    spec, state = ModelSpec(text["name"], text["kind"], text["params"]), text["state"]
    if spec.kind == "svc":
        svm = C.LinearSVCModel.load(f"{path}/model")
        return SvcFitted(spec, svm, C.LogisticRegressionModel.load(f"{path}/curve"), state["gamma"], state["size"])
    if spec.kind == "ada_boost" and "stumps" in state:
        return StumpsFitted(spec, stumps.Run(spec.params.get("learning_rate", 1.0), None, [tuple(x) for x in state["stumps"]], state["alphas"], state["errors"], False))
    if spec.kind == "ada_boost":
        trees = [C.DecisionTreeClassificationModel.load(f"{path}/tree{i}") for i in range(len(state["alphas"]))]
        return AdaFitted(spec, trees, state["alphas"])
    if spec.kind == "gaussian_nb":
        return BayesFitted(spec, bayes.Gaussians(**state))
    if spec.kind == "extra_trees":
        return _load_extra(spark, path, spec, state)
    if spec.kind in COMPOSITE:
        return COMPOSITE[spec.kind](spark, path, spec, state)
    if spec.kind == "nearest" and state.get("table"):
        return NeighbourFitted(spec, spark.read.parquet(f"{path}/points"))
    if spec.kind in ("nearest", "prototypes"):
        rows = spark.read.parquet(f"{path}/points").collect()  # bounded when it was written
        return KnnFitted(
            spec, np.array([r["point"] for r in rows]), np.array([r["n"] for r in rows]), np.array([r["y"] for r in rows])
        )
    return NativeFitted(spec, _LOADERS[spec.kind].load(f"{path}/model"))


# The model sets of the reference. Parameters Spark ML does not
# have are left out; booster libraries map to Spark's own boosted trees.
DEFAULT_MODELS = [
    ModelSpec("RandomForest", "random_forest", {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 2}),
    ModelSpec("LogisticRegression", "logistic", {"maxIter": 1000, "C": 1.0}),
    ModelSpec("SVM", "svc", {"kernel": "rbf", "C": 1.0, "gamma": "scale"}),
]
BASE_MODELS = [
    ModelSpec("RandomForest", "random_forest", {"numTrees": 200, "maxDepth": 8, "minInstancesPerNode": 2}),
    ModelSpec("LogisticRegression", "logistic", {"maxIter": 2000, "C": 1.0}),
    ModelSpec("SVM", "svc", {"kernel": "rbf", "C": 1.0, "gamma": "scale"}),
    ModelSpec("KNN", "nearest", {"k": 7, "weights": "distance"}),
    ModelSpec("NaiveBayes", "gaussian_nb"),
    ModelSpec("DecisionTree", "tree", {"maxDepth": 8, "minInstancesPerNode": 2}),
    ModelSpec("AdaBoost", "ada_boost", {"rounds": 100, "learning_rate": 1.0}),
    ModelSpec("GradientBoosting", "boosted_trees", {"maxIter": 100, "stepSize": 0.1, "maxDepth": 6}),
]
# The three booster libraries are one estimator here, so they are one entry: three would be one vote counted three times.
BOOSTER_MODELS = [ModelSpec("BoostedTrees", "boosted_trees", {"maxIter": 200, "stepSize": 0.1, "maxDepth": 6, "subsamplingRate": 0.8})]
ENSEMBLE_MODELS = [
    ModelSpec("RandomForest", "random_forest", {"numTrees": 200, "maxDepth": 7, "minInstancesPerNode": 3}),
    ModelSpec("GradientBoosting", "boosted_trees", {"maxIter": 150, "stepSize": 0.1, "maxDepth": 5}),
    ModelSpec("LogisticRegression", "logistic", {"maxIter": 1000, "C": 1.0}),
    ModelSpec("SVM", "svc", {"kernel": "rbf"}),
]
RULE_ENSEMBLE_MODELS = [
    ModelSpec("BoostedTrees", "boosted_trees", {"maxIter": 200, "stepSize": 0.05, "maxDepth": 6, "subsamplingRate": 0.8}),
    ModelSpec("RandomForest", "random_forest", {"numTrees": 300, "maxDepth": 8, "minInstancesPerNode": 2}),
]
FINAL_ENSEMBLE_MODELS = [
    ModelSpec("BoostedTrees", "boosted_trees", {"maxIter": 300, "stepSize": 0.03, "maxDepth": 7, "subsamplingRate": 0.8}),
    ModelSpec("RandomForest", "random_forest", {"numTrees": 400, "maxDepth": 10, "minInstancesPerNode": 1}),
    ModelSpec("LogisticRegression", "logistic", {"maxIter": 2000, "C": 0.5}),
]
# Declared with the final set, but not fitted in it: see the README.
EXTRA_TREES = ModelSpec("ExtraTrees", "extra_trees", {"numTrees": 400, "maxDepth": 10, "minSplit": 3})
SMALL_MODEL = ModelSpec("SmallBoostedTrees", "boosted_trees", {"maxIter": 150, "stepSize": 0.1, "maxDepth": 5})
