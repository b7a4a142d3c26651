"""Session settings, literal rows, and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"
COMPRESSION = "zstd"  # of staged and stored tables
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
SPLIT_MB = 32  # of such files in a task: they unpack to many times that, and tasks sort their rows
MIN_SPLITS = "spark.sql.files.minPartitionNum"
SPLITS_PER_CORE = 4  # of a scan, at least: with one or two, most cores wait for the last tasks
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
NO_DICTIONARY = ("parsed_record",)  # texts that hardly repeat, for which one is built in vain
_scope: ContextVar[list[str] | None] = ContextVar("staging_scope", default=None)


def build_session(app_name: str = "skyledger", **conf: str) -> SparkSession:
    """Return a session with UTC time and adaptive execution; `conf` overrides any setting."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a hot join key even where the split costs one more shuffle further up.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        SPLIT_BYTES: f"{SPLIT_MB}m",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bound_splits(spark: SparkSession) -> None:
    """Lower what one task scans to SPLIT_MB, and to a part of a core's share, where the session has
    Spark's defaults. Splits stay above `spark.sql.files.openCostInBytes`."""
    if spark.conf.get(SPLIT_BYTES) in ("134217728b", "134217728", "128m", "128MB"):
        spark.conf.set(SPLIT_BYTES, f"{SPLIT_MB}m")
    if spark.conf.get(MIN_SPLITS, None) is None:
        spark.conf.set(MIN_SPLITS, str(SPLITS_PER_CORE * spark.sparkContext.defaultParallelism))


@contextmanager
def default_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting that holds inside the block, unless the session has one of its own."""
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key)


def table_writer(df: DataFrame) -> DataFrameWriter:
    """Writer of staged and stored tables."""
    writer = df.write.option("compression", COMPRESSION)
    for column in NO_DICTIONARY:
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    return writer


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share, as named by `spark.checkpoint.dir`.

    A temporary folder of this machine stands in only when Spark runs in local mode.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
    return _local_dir()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="skyledger-")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def literal_rows(spark: SparkSession, schema: T.StructType, rows: Sequence[Sequence]) -> DataFrame:
    """A few in-memory rows under an explicit schema, as one partition.

    The values become literals of the plan, so unlike `createDataFrame` no Python worker runs.
    """
    base = spark.range(0, 1, 1, 1)
    if not rows:  # the optimizer sees that it is empty, and drops joins with it before they shuffle
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        return base.filter(F.lit(False)).select(*nulls)

    def typed(values: Sequence) -> Column:
        return F.struct(
            *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, schema.fields)]
        )

    structs = [typed(values) for values in rows]
    return base.select(F.inline(F.array(*structs)))


def staged(df: DataFrame) -> DataFrame:
    """Write `df` as a table on the shared storage and read it back, which cuts its lineage there.

    Used where one result feeds several actions (gate, key numbering, write). The copy outlives
    lost executors, and each later action reads only the columns it needs. Inside `staging` the copy
    goes when the block ends; elsewhere it belongs to whoever owns the shared folder.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, "staged")
    if (paths := _scope.get()) is not None:
        paths.append(path)
    table_writer(df).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_with(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """As `staged`, with aggregates over the rows that are taken while they are written."""
    if not metrics:
        return staged(df), {}
    observation = Observation(f"staged-{uuid.uuid4().hex}")
    columns = [column.alias(name) for name, column in metrics.items()]
    return staged(df.observe(observation, *columns)), observation.get


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove what `staged` writes inside the block when it ends, also after an error.

    For jobs that write their results to tables; a frame that is returned from the block must not
    depend on a staged one.
    """
    token = _scope.set(paths := [])
    try:
        yield
    finally:
        _scope.reset(token)
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that holds it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
