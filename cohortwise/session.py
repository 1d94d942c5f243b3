"""Session setup and the shared scratch area used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import weakref
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

CHECKPOINT_CONF = "spark.checkpoint.dir"
# Folders written by materialize() in this process.
_written: list[str] = []
# What once() has made, by DataFrame object and name: a lock and then the thing.
_made: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()
_making = threading.Lock()


def local_session(app: str = "cohortwise", cores: str | int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Python workers import this package too.
        .config("spark.executorEnv.PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for materialised tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder, because there driver and executors share
    one disk.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohortwise-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage to lose, is the same on every read, and carries
    its real file size, from which the optimizer picks the join strategy.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    _written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Rows and bytes of a written table that one task reads where a table is read again and again.
PARTITION_ROWS = 32_768
PARTITION_BYTES = 16 << 20


def sized(df: DataFrame, rows: int | None = None, size: int | None = None) -> DataFrame:
    """A written table in as many partitions as its rows and bytes need, and no more.

    Training reads a table many hundred times, so a small one should not cost many tasks each time. Its cost goes by
    rows, which compressed bytes don't show, and a file of few bytes can't be read by several tasks: a table
    with more rows than its files have tasks for is written once more, dealt evenly.
    """
    wanted = max(1, -(-df.count() // (rows or PARTITION_ROWS)), -(-plan_bytes(df) // (size or PARTITION_BYTES)))
    if wanted > len(df.inputFiles()):
        df = materialize(df.repartition(wanted), "dealt")
    return df.coalesce(wanted)


def once(df: DataFrame, name: tuple, make: Callable):
    """What ``make`` gives, made once for this very DataFrame by whichever thread asks first; others wait for it."""
    with _making:
        slot = _made.setdefault(df, {}).setdefault(name, [threading.Lock()])
    with slot[0]:
        if len(slot) == 1:
            slot.append(make())
        return slot[1]


def note_written(path: str) -> None:
    """Let :func:`release` delete a folder that Spark has written there itself."""
    _written.append(path)


def release(spark: SparkSession) -> int:
    """Delete the tables this process has materialised; returns their number.

    Call it when no result that reads them is needed any more.
    """
    paths = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    count = 0
    _made.clear()
    while _written:
        path = paths(_written.pop())
        count += bool(path.getFileSystem(conf).delete(path, True))
    return count


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df`` in bytes."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1 when off)."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    if text and text[-1] in units:
        return int(float(text[:-1]) * units[text[-1]])
    return int(text)


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few driver-side rows as a local relation, whose size the optimizer knows."""
    fields = StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in fields.names]
    arrow = pa.table({n: list(c) for n, c in zip(fields.names, columns)}, schema=to_arrow_schema(fields))
    return spark.createDataFrame(arrow, fields)
