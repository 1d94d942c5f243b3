"""Work that must be dealt to many tasks."""

import pyarrow as pa
from pyspark.sql import functions as F

from cohortwise.models import extra
from cohortwise.session import PARTITION_ROWS, materialize, sized


def test_many_rows_of_few_bytes_are_dealt_to_many_tasks(spark):
    one = materialize(spark.range(3 * PARTITION_ROWS + 1).select(F.lit(1.0).alias("x"), "id").coalesce(1))
    dealt = sized(one)
    sizes = dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(one.inputFiles()) == 1 and len(dealt.inputFiles()) == 4 and dealt.agg(F.sum("id")).first() == one.agg(F.sum("id")).first()
    assert sum(r["count"] for r in sizes) == 3 * PARTITION_ROWS + 1
    few = sized(materialize(spark.range(100).repartition(5)))
    assert few.rdd.getNumPartitions() == 1 and few.count() == 100


def test_small_batches_are_grown_together():
    batch = pa.RecordBatch.from_arrays([pa.array([[1.0, 2.0]] * 10_000), pa.array([1] * 10_000, pa.int32()), pa.array([0] * 10_000, pa.int32())], ["values", "label", "fold"])
    blocks = [len(y) for _, y, _ in extra._batches(iter([batch] * 14))]
    assert sum(blocks) == 140_000 and len(blocks) == 2 and max(blocks) < extra.ROWS + 10_000
    assert not list(extra._batches(iter([batch.slice(0, 0)])))
