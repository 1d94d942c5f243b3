"""Streams over the given tables, read to their end."""

from pyspark.sql import functions as F

from cohortwise.models import zoo
from cohortwise.operators.split import stratified_split
from cohortwise.plans import jobs
from cohortwise.queries.fixtures import fx_passengers, over
from cohortwise.queries.registry import query
from cohortwise.session import materialize, scratch_path
from cohortwise.streaming.cohorts import cohort_rate_stream
from cohortwise.streaming.scoring import score_stream, write_stream


@query(
    "cohort_rate_stream",
    """WITH w AS (SELECT CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS window_start, event_type, CAST(value > 100 AS INT) AS label FROM events)
SELECT window_start, event_type, count(*) AS total, CAST(sum(label) AS BIGINT) AS positives, round(avg(label), 6) AS rate FROM w
GROUP BY 1, 2 HAVING window_start + 3600 <= (SELECT floor(epoch_us(max(ts)) / 1000) / 1000 - 600 FROM events)""",
)
def cohort_rates_of_events(spark, sf):
    """Windows that the watermark has closed at the end of the stream."""
    path = f"{sf}/events.parquet"
    # A pattern, as a stream's plain path must be a folder and the table may be one file.
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{sf}/event[s].parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    rates = cohort_rate_stream(stream, "ts", "event_type", F.col("value") > 100)
    out = scratch_path(spark, "rates")
    write_stream(rates, out, scratch_path(spark, "rates-state")).awaitTermination()
    done = spark.read.schema(rates.schema).parquet(out)
    return done.select(F.unix_timestamp("window_start").alias("window_start"), "event_type", "total", "positives", F.round("rate", 6).alias("rate"))


@query(
    "score_stream",
    over(
        "fx_passengers",
        """WITH r AS (SELECT row_number() OVER (PARTITION BY Survived ORDER BY ('0x' || substr(md5(PassengerId || '|42'), 1, 8))::BIGINT, PassengerId) AS rk,
 count(*) OVER (PARTITION BY Survived) AS n FROM fx_passengers)
SELECT count(*) AS rows, CAST(0 AS BIGINT) AS changed FROM r WHERE rk <= round(n * 0.3)""",
    ),
)
def score_stream_like_batch(spark, sf):
    """Every row of a stream gets the score that it gets in a batch."""
    df = materialize(stratified_split(fx_passengers(spark, sf), "PassengerId", "Survived", 0.3, name="__p"), "passengers")
    root = scratch_path(spark, "job")
    jobs.train(df.filter("__p = 'train'").drop("__p"), root, specs=[zoo.ModelSpec("DecisionTree", "tree", {"maxDepth": 5})], k=2)
    table = scratch_path(spark, "incoming")
    df.filter("__p = 'test'").drop("__p", "Survived").write.parquet(table)
    scored = score_stream(spark.readStream.schema(spark.read.parquet(table).schema).parquet(table), root)
    out = scratch_path(spark, "scored")
    write_stream(scored, out, scratch_path(spark, "scored-state")).awaitTermination()
    batch = jobs.score_table(spark.read.parquet(table), root).select("id", F.col("prob").alias("p"))
    both = spark.read.schema(scored.schema).parquet(out).join(batch, "id")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.sum((F.abs(F.col("p") - F.col("prob")) > 1e-9).cast("bigint")).alias("changed"))
