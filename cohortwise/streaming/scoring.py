"""Scoring a stream with stored features, model and rules."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortwise.models.frame import vectorize
from cohortwise.models.search import latest_model
from cohortwise.operators.rules import Rule, apply_rules, combine
from cohortwise.plans.store import load_fitted


def score_stream(stream: DataFrame, root: str, model: str | None = None) -> DataFrame:
    """The stream's rows with ``prob`` and ``prediction``.

    Fitted tables are the static sides of stream-static joins; nothing is kept
    between micro-batches.
    """
    spark = stream.sparkSession
    features = load_fitted(f"{root}/features", spark)
    fitted = latest_model(spark, f"{root}/models", model)
    frame = vectorize(features.transform(stream), features.names, keep=["id"])
    return fitted.score(frame).select("id", "prob", "prediction")


def with_rules(scored: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Let rules over the scored columns override the model's prediction."""
    ruled = apply_rules(scored, rules)
    final = combine(F.col("rule_prediction"), F.col("prediction"))
    return ruled.withColumn("prediction", final).drop("rule_prediction")


def write_stream(
    scored: DataFrame, out: str, checkpoint: str, available_now: bool = True, transform: Callable | None = None
) -> StreamingQuery:
    """Append predictions as parquet; the checkpoint makes each row land once."""
    rows = transform(scored) if transform else scored
    writer = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).outputMode("append").start()
