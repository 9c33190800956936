"""Session helpers: settings the engine counts on, and the package's code on the executors."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows of text in one Arrow batch, and its bytes: texts average a few kilobytes, where they are long the bytes cut a batch earlier.
TEXT_ROWS = 512
BATCH_BYTES = 8 << 20

_SHIPPING = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, once for each Spark context, so that no search path has to be set for them."""
    context = spark.sparkContext
    with _SHIPPING:
        if getattr(context, "_sheafmill_shipped", False):
            return
        here = Path(__file__).resolve().parent
        archive = os.path.join(tempfile.mkdtemp(prefix="sheafmill-code-"), "sheafmill.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(here.rglob("*.py")):
                out.write(path, str(Path(here.name) / path.relative_to(here)))
        context.addPyFile(archive)
        context._sheafmill_shipped = True


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a temporary folder if all run in one JVM (tests); else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sheafmill.shared.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="sheafmill-")
        spark.conf.set("spark.sheafmill.shared.dir", root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/sheafmill-{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write df into the shared folder and read it back: it is worked out once, lineage ends there and a lost executor costs nothing."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_session(spark: SparkSession) -> None:
    """Bound the rows and bytes of an Arrow batch, so that long texts do not pile up in a Python worker or beside the heap.

    Results do not depend on it. The setting stays, as plans are run after the operator has returned.
    """
    for name, most in (("maxRecordsPerBatch", TEXT_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key)
        own = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now) if name == "maxBytesPerBatch" else int(now)
        if own > most or own <= 0:
            spark.conf.set(key, str(most))


def give_back() -> None:
    """Return freed memory to the system: allocators keep it, and a Python worker lives on, idle, beside what its executor does next."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of batches whose task leaves its worker as small as it found it; what run itself remembers has to be forgotten by run."""

    @wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


class Scratch:
    """Intermediate tables and files in the shared folder that go when the block ends; what is read later has to be kept outside of it."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def path(self, name: str) -> str:
        self.paths.append(shared_path(self.spark, name))
        return self.paths[-1]

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in map(jvm.org.apache.hadoop.fs.Path, self.paths):
            path.getFileSystem(conf).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """df over all cores: an input with fewer partitions than cores (a small single file) is dealt out anew; larger ones stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
