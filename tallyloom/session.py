"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Run-time settings the operators count on.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key's partition even where a later aggregation on the same key then needs
    # one more shuffle. Without this the hot key's join and aggregation share a single task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles a method above 8000 bytes; a wider stage runs as separate operators,
    # whose expressions are split into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
SESSION_CONF = {
    **RUNTIME_CONF,
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # No Python call-site capture per column expression: it costs a third of the planning time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Data a shuffle task should hold: sorts and hash tables of this size stay in executor memory.
SHUFFLE_TASK_BYTES = 256 * 2**20


def build_session(app: str = "tallyloom", master: str | None = None, input_bytes: int | None = None, **conf) -> SparkSession:
    """A session with these settings; keyword ``a__b`` sets ``a.b``. ``input_bytes`` sizes its shuffles."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    return size_shuffles(spark, input_bytes) if input_bytes else spark


# What adaptive execution merges small partitions up to. Shuffled bytes are compressed; as sorted rows and as entries of an
# aggregate (one per row where distinct values are counted) they take some twenty times the memory.
MERGED_BYTES = 16 * 2**20
# Up to so many partitions shuffles start with one for every MERGED_BYTES / 2 of input; each costs its map tasks a block.
FINE_PARTITIONS = 2000


def size_shuffles(spark: SparkSession, input_bytes: int) -> SparkSession:
    """Start shuffles with enough partitions for the data that is read; adaptive execution merges small ones.

    The default of 200 would put half a terabyte of a 100 TB input into one task. Never goes below
    the session's own setting. Merged partitions hold ``MERGED_BYTES``, unless the session names a size.
    """
    merged = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if spark.conf.get(merged, None) is None:
        spark.conf.set(merged, str(MERGED_BYTES))
    wanted = max(-(-input_bytes // SHUFFLE_TASK_BYTES), min(FINE_PARTITIONS, -(-2 * input_bytes // MERGED_BYTES)))
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(wanted, current)))
    return spark


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files below a path, as their store lists them."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(place).getLength()


def tune(spark: SparkSession) -> SparkSession:
    """Switch the run-time settings on in a session that somebody else built."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# A query that starts while this is on removes its shuffle files when it ends.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of every query started in here go when that query ends."""
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before) if before is not None else spark.conf.unset(CLEAN_SHUFFLES)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the session names it in ``spark.checkpoint.dir``.

    Where it is unset, as in tests, a folder in the warehouse stands in: driver and executors share that too.
    """
    ctx = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or ctx.getCheckpointDir()
    if root is None:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if ctx.getCheckpointDir() is None:
        ctx.setCheckpointDir(root)
    return root


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are on shared storage, so a lost executor changes nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
