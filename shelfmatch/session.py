"""Spark session defaults and lineage helpers."""

from __future__ import annotations

import contextlib
import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

#: Spark then removes a query's shuffle files when it ends, not when the driver's garbage is collected.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of some 80 bytes that make a file of a kept frame.
FILE_ROWS = 100_000


def get_spark(master: str | None = None, app: str = "shelfmatch",
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster ``master`` is left to spark-submit; locally pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextlib.contextmanager
def dropped_shuffles(spark: SparkSession):
    """What is run here drops its shuffle files when it ends."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before) if before else spark.conf.unset(DROP_SHUFFLES)


def materialize(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Compute a frame reused by several branches once (R7).

    With a shared ``spark.checkpoint.dir`` configured, a reliable checkpoint
    writes it there and cuts the lineage (it survives executor loss); the shuffle
    files that led to it are dropped at once, as nothing reads them again. Without
    one, the frame is persisted memory-and-disk: a lost block is recomputed
    from lineage, and no machine-local folder is invented.

    ``rows`` bounds what the frame's last step reads and makes, in rows of some 80 bytes. A
    checkpoint then has no more files than so many rows need (two for each core at least),
    however many partitions there are: each file is created by a process or two that the
    executor starts where Hadoop has no native library.
    """
    spark = df.sparkSession
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
        with dropped_shuffles(spark):
            own = df.select("*")     # a plan of its own: ``df`` may be run again
            if rows is not None:
                own = own.coalesce(max(math.ceil(rows / FILE_ROWS), 2 * spark.sparkContext.defaultParallelism))
            return own.checkpoint(eager=True)
    from pyspark import StorageLevel
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for written tables, in the shared folder that ``spark.checkpoint.dir`` names.

    Where that is unset, a local session gets a temporary folder and a cluster is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="shelfmatch-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: compressed columns, no
    lineage and nothing held in executors' memory, for a frame that is scanned more than once.
    The shuffle files that led to it are dropped at once."""
    path = scratch(df.sparkSession, name)
    with dropped_shuffles(df.sparkSession):
        df.select("*").write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *cols) -> DataFrame:
    """Hash-repartition into max(shuffle partitions, total cores) partitions.

    Used in front of CPU-heavy per-row text work, on the keys the next join
    or aggregate needs anyway, so it replaces that operator's exchange
    rather than adding one. The explicit count keeps AQE from coalescing a
    small-in-bytes but expensive-per-row input into a single task; taking at
    least the cluster's default parallelism keeps every core busy even when
    the shuffle setting was left at its default.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, *cols)
