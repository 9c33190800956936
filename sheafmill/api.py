"""What an operator of the warehouse calls: configuration, runs, events, indexing. Each is a transaction on the tables under a root folder, so several may work at once."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafmill.operators import runs as ops
from sheafmill.plans import changes, views
from sheafmill.session import keep, ship_package
from sheafmill.sources.commits import Log
from sheafmill.streaming.ingest import index_run


class Warehouse:
    """All tables under a root folder (made by sources.harvest.bootstrap)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.log = spark, root, Log(spark, root)
        ship_package(spark)

    def table(self, name: str) -> DataFrame:
        return self.log.state().read(name)

    def health(self) -> dict:
        return {"status": "ok", "time": datetime.datetime.now(datetime.timezone.utc)}

    def list_endpoints(self) -> DataFrame:
        return ops.endpoint_config(self.table("endpoints"), self.table("repositories"))

    def latest_runs(self, harvest_url: str | None = None) -> DataFrame:
        args = self.table("harvest_runs"), self.table("endpoints")
        return ops.latest_run(*args, harvest_url) if harvest_url is not None else ops.latest_runs(*args)

    def create_views(self) -> None:
        """Keep the statistics of records and the counts of events up to date from now on."""
        self.log.transact(lambda t: views.create(t))

    def records_statistics(self) -> DataFrame:
        return views.records_statistics(self.log.state())

    def events_summary(self) -> DataFrame:
        return views.events_summary(self.log.state())

    def delete(self, table: str, ids: list[str]) -> dict[str, list[int]]:
        """Delete rows of a table by id, and all rows of other tables that refer to them; returns the buckets that were rewritten. Documents of deleted records stay in the search indexes."""
        gone = self.spark.createDataFrame([(i,) for i in ids], "id string")
        return self.log.transact(lambda t: changes.delete_cascade(t, table, gone))

    def open_run(self, harvest_url: str) -> dict:
        """Open a run; returns its id, dates and the endpoint's configuration. Raises ValueError if there can be none."""
        run_id, now = str(uuid.uuid4()), datetime.datetime.now(datetime.timezone.utc)
        self.log.transact(lambda t: changes.open_run(t, harvest_url, F.lit(run_id), F.lit(now)))
        return ops.open_runs(self.table("harvest_runs").filter(F.col("id") == run_id), self.table("endpoints"), self.table("repositories")).first().asDict()

    def close_run(self, run_id: str, success: bool, started_at: datetime.datetime, completed_at: datetime.datetime) -> str:
        """Close a run; closing one that is not open changes nothing. Raises ValueError for an unknown run."""
        request = self.spark.createDataFrame([(run_id, success, started_at, completed_at)], "id string, success boolean, started_at timestamp, completed_at timestamp")
        self.log.transact(lambda t: changes.close_run(t, request))
        return run_id

    def register_events(self, requests: DataFrame) -> DataFrame:
        """Register events in bulk; returns (id, record_identifier, reason), the reason null for those registered.

        requests: record_identifier, datestamp, raw_metadata, additional_metadata, harvest_url, repo_code, harvest_run_id, is_deleted.
        """
        key = F.sha2(F.concat_ws("|", "harvest_url", "harvest_run_id", "record_identifier", "raw_metadata"), 256)
        judge = lambda *tables: keep(ops.register_events(*tables), "judged-requests")
        judged = self.log.transact(lambda t: changes.register_events(t, requests.withColumn("id", key), judge))
        return judged.select("id", "record_identifier", "reason")

    def start_index(self, run_id: str, index: str, batch_size: int = ops.BATCH_SIZE) -> int:
        """Transform the events of a closed run into records and index documents; returns the number of batches they make up."""
        scanned = ops.event_scan(self.table("harvest_events").filter(F.col("harvest_run_id") == run_id), self.table("harvest_runs"), self.table("endpoints"), self.table("repositories"))
        n = scanned.count()
        if n:
            index_run(self.spark, self.root, index, scanned)
        return -(-n // batch_size)
