"""What Python workers need: the package on their path, and batches of bounded size."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_SPARK_DEFAULT, _OWN = "67108864b", "8m"


def let_workers_import(spark: SparkSession) -> SparkSession:
    """Put the folder that holds this package on the path of Python workers started from now on.

    Tasks import their functions by name. That fails in a session whose workers were given neither
    an installed package nor its folder, for example one started from another working directory.
    On a cluster without the folder, install the package or send it with `--py-files`.

    A batch of texts is held several times over, by the JVM and by the worker. Where the session has
    Spark's default of 64 MB for a batch, it is lowered to 8 MB; any other setting stays.
    """
    if spark.conf.get(BATCH_BYTES) == _SPARK_DEFAULT:
        spark.conf.set(BATCH_BYTES, _OWN)
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*known, root]))
    return spark


def unused(df: DataFrame, name: str) -> str:
    """A column name like `name` that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def released(
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run`, after which the worker gives back the memory that Arrow and the C library hold.

    Workers serve many tasks. What they keep between them is lost to the executor.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc alone has it
                trim(0)

    return task
