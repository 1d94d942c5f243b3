"""Metrics of binary predictions, per group such as model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortwise.functions.bins import cut, value_range
from cohortwise.operators.joins import attach
from cohortwise.operators.prefix import running_totals
from cohortwise.operators.quantiles import no_nan
from cohortwise.operators.validate import count_if
from cohortwise.session import materialize
from cohortwise.sources.tables import read_parquet


def or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def check_binary(df: DataFrame, *columns: str) -> None:
    """Raise ValueError unless all values are 0 or 1."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.col(c).isNull() | ~F.col(c).isin(0, 1)
    if not df.filter(bad).isEmpty():
        raise ValueError("labels must be 0 or 1")


def confusion_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per group with tp, fp, fn, tn."""
    y, p = F.col(label), F.col(prediction)
    return df.groupBy(*by).agg(
        count_if((y == 1) & (p == 1)).alias("tp"),
        count_if((y == 0) & (p == 1)).alias("fp"),
        count_if((y == 1) & (p == 0)).alias("fn"),
        count_if((y == 0) & (p == 0)).alias("tn"),
    )


def binary_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1; an empty denominator gives 0."""
    counts = confusion_counts(df, label, prediction, by)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *by,
        or_zero(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        or_zero(tp, tp + fp).alias("precision"),
        or_zero(tp, tp + fn).alias("recall"),
        or_zero(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Four rows ``(actual, predicted, n)`` per group, zeros included."""
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n"))
            for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
        ]
    )
    counts = confusion_counts(df, label, prediction, by)
    return counts.select(*by, F.explode(cells).alias("cell")).select(*by, "cell.actual", "cell.predicted", "cell.n")


def classification_report(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages
    and the accuracy as its own row."""
    counts = confusion_counts(df, label, prediction, by)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n0, n1, total = tn + fp, tp + fn, tp + fp + fn + tn
    zero = [or_zero(tn, tn + fn), or_zero(tn, n0), or_zero(2 * tn, 2 * tn + fn + fp)]
    one = [or_zero(tp, tp + fp), or_zero(tp, n1), or_zero(2 * tp, 2 * tp + fp + fn)]
    macro = [(a + b) / 2 for a, b in zip(zero, one)]
    weighted = [or_zero(a * n0 + b * n1, total) for a, b in zip(zero, one)]
    accuracy = or_zero(tp + tn, total)
    rows = [("0", zero, n0), ("1", one, n1), ("accuracy", [accuracy] * 3, total), ("macro avg", macro, total),
            ("weighted avg", weighted, total)]
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("class"), v[0].alias("precision"), v[1].alias("recall"), v[2].alias("f1_score"),
                support.alias("support"),
            )
            for name, v, support in rows
        ]
    )
    return counts.select(*by, F.explode(entries).alias("e")).select(*by, "e.*")


def roc_points(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """One ROC point per distinct score, descending, plus the origin (null threshold)."""
    by = list(by)
    counts = (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*by, F.col(score).alias("threshold"))
        .agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"), F.count(F.lit(1)).alias("n"))
        .withColumn("neg", F.col("n") - F.col("pos"))
    )
    running = running_totals(
        counts, by, [F.col("threshold").desc()], {"tp": F.col("pos"), "fp": F.col("neg")}
    )
    group = by or ["__all"]
    keyed = running if by else running.withColumn("__all", F.lit(1))
    points = materialize(keyed.select(*group, "threshold", "tp", "fp", "pos", "neg"), "roc")
    totals = points.groupBy(*group).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    placed = attach(points, materialize(totals, "totals"), group).select(*group, "threshold", "tp", "fp", "P", "N")
    origin = totals.select(*group, F.lit(None).cast("double").alias("threshold"), F.lit(0).cast("bigint").alias("tp"),
                           F.lit(0).cast("bigint").alias("fp"), "P", "N")
    both = placed.unionByName(origin)
    return both.select(
        *by,
        "threshold",
        F.try_divide(F.col("fp"), F.col("N")).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("P")).alias("tpr"),
    )


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve per group.

    Equal to the trapezoid area: each negative counts the positives above it,
    and half of those that share its score.
    """
    by = list(by)
    counts = (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*by, F.col(score).alias("threshold"))
        .agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"), F.count(F.lit(1)).alias("n"))
        .withColumn("neg", F.col("n") - F.col("pos"))
    )
    running = running_totals(counts, by, [F.col("threshold").desc()], {"tp": F.col("pos")})
    twice = F.col("neg").cast("decimal(38,0)") * (2 * F.col("tp") - F.col("pos")).cast("decimal(38,0)")
    summed = running.groupBy(*by).agg(
        F.sum(twice.cast("decimal(38,0)")).alias("area2"), F.sum("pos").alias("P"), F.sum("neg").alias("N")
    )
    area = F.try_divide(F.col("area2").cast("double"), 2.0 * F.col("P") * F.col("N"))
    return summed.select(*by, area.alias("auc"))


def ranked_models(results: DataFrame, digits: int = 4) -> DataFrame:
    """Model table rounded, best accuracy first, F1 breaking ties."""
    numbers = [c for c, t in results.dtypes if t == "double"]
    rounded = results.withColumns({c: F.bround(c, digits) for c in numbers})
    return rounded.orderBy(F.desc("accuracy"), F.desc("f1_score"), "model")


def select_best(results: DataFrame, threshold: float = 0.8, accuracy: str = "accuracy") -> DataFrame:
    """The model with the highest accuracy (name breaks ties) and whether it meets the threshold."""
    best = results.orderBy(F.desc(accuracy), "model").limit(1)
    return best.withColumn("meets_threshold", (F.col(accuracy) >= threshold).cast("int"))


def metrics_long(results: DataFrame, id_column: str = "model") -> DataFrame:
    """One row per model and metric."""
    return results.unpivot([id_column], [c for c in results.columns if c != id_column], "metric", "value")


def append_metrics(metrics: DataFrame, root: str, at: str, importances: DataFrame | None = None) -> None:
    """Add one evaluation (a row for each model) to the history under ``root``, with its time, and the importances that belong to it."""
    metrics.withColumn("evaluated_at", F.lit(at)).write.mode("append").parquet(f"{root}/metrics")
    if importances is not None:
        importances.withColumn("evaluated_at", F.lit(at)).write.mode("append").parquet(f"{root}/importances")


def metrics_history(spark: SparkSession, root: str) -> DataFrame:
    """All evaluations under ``root``; FileNotFoundError if there is none."""
    return read_parquet(spark, f"{root}/metrics")


def latest_importances(spark: SparkSession, root: str, top: int | None = None) -> DataFrame:
    """The importances stored with the newest evaluation that has some, largest first."""
    stored = read_parquet(spark, f"{root}/importances")
    newest = stored.agg(F.max("evaluated_at")).first()[0]
    kept = stored.filter(F.col("evaluated_at") == newest).drop("evaluated_at").orderBy(F.desc("importance"), "feature")
    return kept.limit(top) if top else kept


def metrics_history_summary(history: DataFrame, order: str) -> DataFrame:
    """Number of evaluations and the latest one's metrics."""
    metrics = [c for c in history.columns if c != order]
    latest = F.max_by(F.struct(*metrics), F.col(order))
    return history.agg(F.count(F.lit(1)).alias("evaluations"), latest.alias("l")).select("evaluations", "l.*")


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram with density; empty bins included. Bins are
    left-closed, the last one closed."""
    low, high = value_range(df, column)
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    edges = [low + i * width for i in range(bins)] + [high]
    index = cut(F.col(column), edges, list(range(bins)), right=False, include_lowest=True)
    counts = df.select(index.alias("bin")).filter(F.col("bin").isNotNull()).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    # All bins as rows; their number is the parameter.
    frame = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"), (F.lit(low) + F.col("id") * F.lit(width)).alias("left_edge")
    )
    joined = frame.join(counts, "bin", "left").withColumn("n", F.coalesce(F.col("n"), F.lit(0)))
    whole = Window.partitionBy(F.lit(1))
    return joined.select("bin", "left_edge", "n", (F.col("n") / F.sum("n").over(whole) / F.lit(width)).alias("density"))


def kde_curve(df: DataFrame, column: str, points: int = 200, bins: int = 512) -> DataFrame:
    """Gaussian density estimate on a grid, from binned counts.

    Rows are first counted into ``bins`` equal bins, so the kernel sums run
    over bins, not rows. Bandwidth is the sample deviation times n^(-1/5).
    """
    low, high = value_range(df, column)
    value = no_nan(F.col(column))
    spread = high - low
    width = spread / bins or 1.0
    index = F.least(F.floor((value - low) / width), F.lit(bins - 1))
    counts = materialize(
        df.filter(value.isNotNull()).groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n")), "bins"
    )
    stats = df.agg(F.count(value).alias("n"), F.stddev_samp(value).alias("s")).first()
    bandwidth = (stats["s"] or 1.0) * stats["n"] ** -0.2
    start, step = low - spread / 2, 2 * spread / (points - 1)
    center = F.lit(low) + (F.col("bin") + 0.5) * width
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i")
    x = F.lit(start) + F.col("i") * step
    z = (x - F.col("center")) / bandwidth
    norm = stats["n"] * bandwidth * (2 * 3.141592653589793) ** 0.5
    return (
        counts.select("n", center.alias("center"), grid)
        .groupBy("i")
        .agg((F.sum(F.col("n") * F.exp(-0.5 * z * z)) / norm).alias("density"))
        .select("i", (F.lit(start) + F.col("i") * step).alias("x"), "density")
    )
