"""The matrix models are trained on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.session import materialize, sized

FEATURES = "features"
LABEL = "label"
FOLD = "fold"


def vectorize(df: DataFrame, features: Sequence[str], label: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Keep the named columns, the label, and all features as one array and one
    vector; missing feature values are 0."""
    return _with_vector(_with_array(df, features, label, keep))


def model_frame(df: DataFrame, features: Sequence[str], label: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """:func:`vectorize`, written to the shared folder once, because training
    reads it many times."""
    return _with_vector(sized(materialize(_with_array(df, features, label, keep), "frame")))


def _with_array(df: DataFrame, features: Sequence[str], label: str | None, keep: Sequence[str]) -> DataFrame:
    values = F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in features])
    columns = [F.col(c) for c in keep]
    if label:
        columns.append(F.col(label).cast("int").alias(LABEL))
    return df.select(*columns, values.alias("values"))


def _with_vector(df: DataFrame) -> DataFrame:
    return df.withColumn(FEATURES, array_to_vector("values"))
