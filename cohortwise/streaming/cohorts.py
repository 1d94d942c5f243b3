"""Label rates by cohort and time window of a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cohort_rate_stream(stream: DataFrame, time: str, cohort: str, label: Column, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows, positives and rate of ``label`` (0/1) per cohort and window.

    Events more than ``late`` behind the newest one are dropped once their
    window is closed; a window is emitted when the watermark passes its end, so
    the state holds only open windows. Works on a batch as well, where all
    windows come out.
    """
    marked = stream.withColumn("__label", label.cast("int"))
    marked = marked.withWatermark(time, late) if stream.isStreaming else marked
    rates = marked.groupBy(F.window(time, window).alias("w"), cohort).agg(
        F.count(F.lit(1)).alias("total"), F.sum("__label").alias("positives"), F.avg("__label").alias("rate")
    )
    return rates.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), cohort, "total", "positives", "rate")
