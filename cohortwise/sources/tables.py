"""Reading labelled tables and writing prediction tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

# The passenger table the reference works on.
PASSENGER_SCHEMA = T.StructType(
    [
        T.StructField("PassengerId", T.IntegerType()),
        T.StructField("Survived", T.IntegerType()),
        T.StructField("Pclass", T.IntegerType()),
        T.StructField("Name", T.StringType()),
        T.StructField("Sex", T.StringType()),
        T.StructField("Age", T.DoubleType()),
        T.StructField("SibSp", T.IntegerType()),
        T.StructField("Parch", T.IntegerType()),
        T.StructField("Ticket", T.StringType()),
        T.StructField("Fare", T.DoubleType()),
        T.StructField("Cabin", T.StringType()),
        T.StructField("Embarked", T.StringType()),
    ]
)


def without_fields(schema: T.StructType, names: Sequence[str]) -> T.StructType:
    """A schema with some fields left out, e.g. the label for scoring tables."""
    return T.StructType([f for f in schema.fields if f.name not in names])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a CSV with a header under an explicit schema.

    A missing path raises FileNotFoundError, a path without rows ValueError; a
    line that does not fit the schema fails the job that reads it.
    """
    try:
        df = (
            spark.read.schema(schema)
            .option("header", True)
            .option("escape", '"')
            .option("mode", "FAILFAST")
            .option("enforceSchema", False)
            .csv(path)
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise
    if df.isEmpty():
        raise ValueError(f"no rows in {path}")
    return nan_to_null(df)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read a parquet table; filters and column choices reach the scan."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def prediction_table(df: DataFrame, key: str, prediction: str, label: str) -> DataFrame:
    """The two output columns: key and 0/1 prediction."""
    return df.select(F.col(key), F.col(prediction).cast("int").alias(label))


def write_predictions(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> str:
    """Write a prediction table as CSV (with header) or parquet."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def read_predictions(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Read a written prediction table back. CSV columns stay text, so that
    validation sees what was written."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise
