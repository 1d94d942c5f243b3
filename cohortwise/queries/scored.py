"""Splits, metrics and ensembles."""

from pyspark.sql import functions as F

from cohortwise.operators import ensemble as N
from cohortwise.operators import metrics as M
from cohortwise.operators import split as S
from cohortwise.queries.fixtures import fx_orders, fx_scores, over
from cohortwise.queries.registry import query
from cohortwise.session import scratch_path

_HASH = "('0x' || substr(md5(id || '|42'), 1, 8))::BIGINT"


@query(
    "split_stratified",
    over(
        "fx_orders",
        f"""WITH r AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY {_HASH}, id) AS r, count(*) OVER (PARTITION BY label) AS n FROM fx_orders)
SELECT id, label, CASE WHEN r <= round(n * 0.2) THEN 'test' ELSE 'train' END AS part FROM r""",
    ),
)
def split_stratified(spark, sf):
    return S.stratified_split(fx_orders(spark, sf), "id", "label", 0.2).select("id", "label", "part")


@query(
    "split_by_hash",
    over(
        "fx_orders",
        f"SELECT id, CASE WHEN {_HASH} < {int(0.2 * S.HASH_RANGE)} THEN 'test' ELSE 'train' END AS part FROM fx_orders",
    ),
)
def split_by_hash(spark, sf):
    return S.stratified_split(fx_orders(spark, sf), "id", exact=False).select("id", "part")


@query(
    "fold_assign",
    over(
        "fx_orders",
        f"SELECT id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY {_HASH}, id) - 1) % 5 AS INT) AS fold FROM fx_orders",
    ),
)
def fold_assign(spark, sf):
    return S.assign_folds(fx_orders(spark, sf), "id", "label", 5).select("id", "label", "fold")


def _predictions(spark, sf):
    return fx_scores(spark, sf).withColumn("prediction", F.when(F.col("prob") > 0.5, 1).otherwise(0))


_CM = """c AS (SELECT model, count(*) FILTER (WHERE label = 1 AND prob > 0.5) AS tp, count(*) FILTER (WHERE label = 0 AND prob > 0.5) AS fp,
count(*) FILTER (WHERE label = 1 AND prob <= 0.5) AS fn, count(*) FILTER (WHERE label = 0 AND prob <= 0.5) AS tn FROM fx_scores GROUP BY model)"""
_METRICS = """SELECT model, (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS accuracy, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision,
coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall, coalesce((2 * tp)::DOUBLE / nullif(2 * tp + fp + fn, 0), 0) AS f1_score FROM c"""


@query("metrics_binary", over("fx_scores", f"WITH {_CM} {_METRICS}"))
def metrics_binary(spark, sf):
    return M.binary_metrics(_predictions(spark, sf), "label", "prediction", ["model"])


@query(
    "confusion_matrix",
    over(
        "fx_scores",
        """SELECT label AS actual, CASE WHEN prob > 0.5 THEN 1 ELSE 0 END AS predicted, model, count(*) AS n FROM fx_scores GROUP BY ALL""",
    ),
)
def confusion_matrix(spark, sf):
    return M.confusion_matrix(_predictions(spark, sf), "label", "prediction", ["model"])


@query(
    "classification_report",
    over(
        "fx_scores",
        f"""WITH {_CM}, s AS (SELECT *, tn::DOUBLE / (tn + fn) AS p0, tn::DOUBLE / (tn + fp) AS r0, (2 * tn)::DOUBLE / (2 * tn + fn + fp) AS f0,
tp::DOUBLE / (tp + fp) AS p1, tp::DOUBLE / (tp + fn) AS r1, (2 * tp)::DOUBLE / (2 * tp + fp + fn) AS f1, tn + fp AS n0, tp + fn AS n1,
tp + fp + fn + tn AS n, (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS acc FROM c)
SELECT model, '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1_score, n0 AS support FROM s
UNION ALL SELECT model, '1', p1, r1, f1, n1 FROM s UNION ALL SELECT model, 'accuracy', acc, acc, acc, n FROM s
UNION ALL SELECT model, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM s
UNION ALL SELECT model, 'weighted avg', (p0 * n0 + p1 * n1) / n, (r0 * n0 + r1 * n1) / n, (f0 * n0 + f1 * n1) / n, n FROM s""",
    ),
)
def classification_report(spark, sf):
    return M.classification_report(_predictions(spark, sf), "label", "prediction", ["model"])


_ROC = """WITH c AS (SELECT {by} prob AS threshold, sum(label) AS pos, count(*) - sum(label) AS neg FROM fx_scores {where} GROUP BY ALL),
w AS (SELECT {by} threshold, sum(pos) OVER o AS tp, sum(neg) OVER o AS fp, sum(pos) OVER a AS p, sum(neg) OVER a AS n FROM c
WINDOW o AS ({part} ORDER BY threshold DESC), a AS ({part}))
SELECT {by} threshold, fp::DOUBLE / n AS fpr, tp::DOUBLE / p AS tpr FROM w
UNION ALL SELECT {distinct} NULL, 0.0::DOUBLE, 0.0::DOUBLE {tail}"""


@query("roc_points", over("fx_scores", _ROC.format(by="", where="", part="", distinct="", tail="")))
def roc_points(spark, sf):
    return M.roc_points(fx_scores(spark, sf), "label", "prob")


@query(
    "roc_multi",
    over("fx_scores", _ROC.format(by="model,", where="", part="PARTITION BY model", distinct="DISTINCT model,", tail="FROM c")),
)
def roc_multi(spark, sf):
    return M.roc_points(fx_scores(spark, sf), "label", "prob", ["model"])


@query(
    "roc_auc",
    over(
        "fx_scores",
        """WITH c AS (SELECT model, prob, sum(label) AS pos, count(*) - sum(label) AS neg FROM fx_scores GROUP BY ALL),
w AS (SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY prob DESC) AS tp FROM c)
SELECT model, sum(neg * (2 * tp - pos))::DOUBLE / (2 * sum(pos)::DOUBLE * sum(neg)::DOUBLE) AS auc FROM w GROUP BY model""",
    ),
)
def roc_auc(spark, sf):
    return M.roc_auc(fx_scores(spark, sf), "label", "prob", ["model"])


_ROUNDED = "SELECT model, round_even(accuracy, 4) AS accuracy, round_even(precision, 4) AS precision, round_even(recall, 4) AS recall, round_even(f1_score, 4) AS f1_score"


def _results(spark, sf):
    return M.binary_metrics(_predictions(spark, sf), "label", "prediction", ["model"])


@query("model_ranking", over("fx_scores", f"WITH {_CM}, m AS ({_METRICS}) {_ROUNDED} FROM m ORDER BY accuracy DESC, f1_score DESC"))
def model_ranking(spark, sf):
    return M.ranked_models(_results(spark, sf))


@query(
    "model_select",
    over(
        "fx_scores",
        f"""WITH {_CM}, m AS ({_METRICS}) SELECT *, CASE WHEN accuracy >= 0.8::DOUBLE THEN 1 ELSE 0 END AS meets_threshold FROM m
ORDER BY accuracy DESC, model LIMIT 1""",
    ),
)
def model_select(spark, sf):
    return M.select_best(_results(spark, sf))


@query(
    "model_metrics_long",
    over("fx_scores", f"WITH {_CM}, m AS ({_METRICS}) SELECT model, metric, value FROM m UNPIVOT (value FOR metric IN (accuracy, precision, recall, f1_score))"),
)
def model_metrics_long(spark, sf):
    return M.metrics_long(_results(spark, sf))


@query(
    "metrics_history",
    over(
        "fx_scores",
        f"WITH {_CM}, m AS ({_METRICS}) SELECT (SELECT count(*) FROM m) AS evaluations, accuracy, precision, recall, f1_score FROM m ORDER BY model DESC LIMIT 1",
    ),
)
def metrics_history(spark, sf):
    """The models' evaluations as history, in order of their name."""
    return M.metrics_history_summary(_results(spark, sf), "model")


@query(
    "metrics_history_append",
    over(
        "fx_scores",
        f"""WITH {_CM}, m AS ({_METRICS}), h AS (SELECT 'first' AS evaluated_at, * FROM m UNION ALL SELECT 'second', * FROM m WHERE model < 'm4')
SELECT model, count(*) AS evaluations, max(evaluated_at) AS latest, round(avg(accuracy), 8) AS accuracy, NULL::DOUBLE AS importance FROM h GROUP BY model
UNION ALL SELECT * FROM (SELECT model, 0, 'second', 0.0, round(f1_score, 8) FROM m ORDER BY f1_score DESC, model LIMIT 2)""",
    ),
)
def metrics_history_append(spark, sf):
    """Two evaluations written to a history, read back, with the importances of the second."""
    results, root = _results(spark, sf).select("model", "accuracy", "precision", "recall", "f1_score"), scratch_path(spark, "history")
    M.append_metrics(results, root, "first", results.select(F.col("model").alias("feature"), F.col("accuracy").alias("importance")))
    M.append_metrics(results.filter("model < 'm4'"), root, "second", results.select(F.col("model").alias("feature"), F.col("f1_score").alias("importance")))
    each = M.metrics_history(spark, root).groupBy("model").agg(
        F.count(F.lit(1)).alias("evaluations"), F.max("evaluated_at").alias("latest"), F.round(F.avg("accuracy"), 8).alias("accuracy")
    )
    kept = M.latest_importances(spark, root, 2).select(
        F.col("feature").alias("model"), F.lit(0).cast("long").alias("evaluations"), F.lit("second").alias("latest"), F.lit(0.0).alias("accuracy"), F.round("importance", 8).alias("importance")
    )
    return each.withColumn("importance", F.lit(None).cast("double")).unionByName(kept)


@query(
    "ensemble_weighted",
    over(
        "fx_scores",
        f"""WITH {_CM}, m AS ({_METRICS}), k AS (SELECT model, accuracy FROM m ORDER BY accuracy DESC, model LIMIT 4),
w AS (SELECT model, accuracy / (SELECT sum(accuracy) FROM k) AS weight FROM k)
SELECT id, round(sum(weight * prob) / sum(weight), 8) AS prob, count(*) AS n_models FROM fx_scores JOIN w USING (model) GROUP BY id""",
    ),
)
def ensemble_weighted(spark, sf):
    weights = N.model_weights(_results(spark, sf), "accuracy", top_k=4)
    df = N.blend(fx_scores(spark, sf), weights, "id")
    return df.withColumn("prob", F.round("prob", 8))


@query(
    "ensemble_uniform",
    over("fx_scores", "SELECT id, round(avg(prob), 8) AS prob, count(*) AS n_models FROM fx_scores GROUP BY id"),
)
def ensemble_uniform(spark, sf):
    weights = N.model_weights(_results(spark, sf), "accuracy", uniform=True)
    df = N.blend(fx_scores(spark, sf), weights, "id")
    return df.withColumn("prob", F.round("prob", 8))
