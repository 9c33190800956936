"""Streams of harvest events: micro-batches over the same functional merges as batch jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from sheafmill.operators.merge import last_of_key
from sheafmill.plans.changes import apply_change
from sheafmill.plans.transform import transform
from sheafmill.sources.commits import Log, Transaction
from sheafmill.sources.harvest import BUCKETS

#: The partition column of the changes of micro-batches.
BATCH = "change_batch"


def run_batches(source: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Work through all that is there in micro-batches, then stop."""
    query = source.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stream_upsert(spark: SparkSession, folder: str, pattern: str, schema, root: str, name: str, keys: list[str], order: list[Column], checkpoint: str, files: int = 8) -> DataFrame:
    """Upsert a stream of parquet files (those in a folder whose names match the pattern) into a table and return it.

    Of all rows of a key the first in `order` stays, whatever batch it comes in; of rows alike in it, one of the latest batch. A micro-batch writes its changes only;
    the table is merged with them once, when the stream has worked through what is there. A batch that is run again writes its changes again, so the result is the same.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", pattern).parquet(folder)
    changes = f"{root}/{name}-changes"

    def handle(batch: DataFrame, number: int) -> None:
        last_of_key(batch, keys, order).write.mode("overwrite").parquet(f"{changes}/{BATCH}={number}")

    run_batches(rows, handle, checkpoint)
    log = Log(spark, root)

    def merge(t: Transaction) -> int:
        """Merge the batches since the last merge into the buckets of their keys; returns the last of them."""
        there = t.has(name)
        done = int(t.state.tables[name].mark) if there else -1
        try:
            new = spark.read.schema(StructType([*rows.schema, StructField(BATCH, IntegerType())])).parquet(changes).filter(F.col(BATCH) > done)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            new = spark.createDataFrame([], rows.schema).withColumn(BATCH, F.lit(done + 1))
        last = new.agg(F.max(BATCH)).first()[0]
        last_order = [*order, F.col(BATCH).desc()]
        if not there:
            t.create(name, last_of_key(new, keys, last_order).select(rows.columns), keys, BUCKETS, str(done if last is None else last))
        elif last is not None:
            buckets = t.touched(name, new)
            old = t.read(name, buckets).withColumn(BATCH, F.lit(done))
            t.replace(name, last_of_key(new.unionByName(old), keys, last_order).select(rows.columns), buckets, str(last))
        return done if last is None else last

    merged = log.transact(merge)
    _forget(spark, changes, merged)
    return log.state().read(name)


def _forget(spark: SparkSession, changes: str, merged: int) -> None:
    """Delete the changes of batches that are in the table."""
    where = spark._jvm.org.apache.hadoop.fs.Path(changes)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in store.listStatus(where) if store.exists(where) else []:
        batch = folder.getPath().getName().partition(f"{BATCH}=")[2]
        if batch.isdigit() and int(batch) <= merged:
            store.delete(folder.getPath(), True)


def stream_register(spark: SparkSession, folder: str, pattern: str, schema, root: str, name: str, keys: list[str], checkpoint: str, files: int = 8, within: tuple[str, str] | None = None) -> DataFrame:
    """Add a stream's rows to a table, one of each key, and return the table: a repeated key is turned away in whatever batch it comes, by the stream's own state; the table is not read.

    The state lives in the checkpoint, so it holds after a restart. within: (time column, delay) bounds it: a key may come again only later than that. A batch that is run again is not added twice, as the table's mark says which
    batch it has last.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", pattern).parquet(folder)
    once = rows.withWatermark(*within).dropDuplicatesWithinWatermark(keys) if within else rows.dropDuplicates(keys)
    log = Log(spark, root)

    def handle(batch: DataFrame, number: int) -> None:
        def add(t: Transaction) -> None:
            if not t.has(name):
                t.create(name, batch, keys, BUCKETS, str(number))
            elif int(t.state.tables[name].mark) < number:
                t.append(name, batch, str(number))
            else:  # it is in the table, but the stream's state has to see it too
                batch.write.format("noop").mode("overwrite").save()

        log.transact(add)

    run_batches(once, handle, checkpoint)
    return log.state().read(name)


def index_run(spark: SparkSession, root: str, index: str, scanned: DataFrame, now: Column | None = None) -> None:
    """Transform the events of a run (of event_scan()) and move records, events and the index to a new state, all three or none."""
    now = F.current_timestamp() if now is None else now
    change = transform(scanned, now)
    Log(spark, root).transact(lambda t: apply_change(t, index, change, now))
