"""Harvest runs and events: the run's states, what the next run starts from, and the registration of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafmill.operators.xml import parse, well_formed

RUN_COLUMNS = ["harvest_url", "id", "status", "from_date", "until_date", "started_at", "completed_at"]
BATCH_SIZE = 125


def endpoint_config(endpoints: DataFrame, repositories: DataFrame) -> DataFrame:
    """(name, harvest_url, harvest_params, protocol, code) of every endpoint."""
    codes = repositories.select(F.col("id").alias("repository_id"), "code")
    return endpoints.join(codes, "repository_id").select("name", "harvest_url", "harvest_params", "protocol", "code")


def active_endpoints(endpoints: DataFrame, repositories: DataFrame) -> DataFrame:
    r = repositories.filter("is_active").select(F.col("id").alias("repository_id"), F.col("name").alias("repository_name"), F.col("code").alias("repository_code"), F.col("base_url").alias("repository_url"))
    e = endpoints.filter("is_active").select(F.col("id").alias("endpoint_id"), "repository_id", F.col("name").alias("endpoint_name"), "harvest_url", "protocol", "scientific_discipline")
    return e.join(r, "repository_id").drop("repository_id")


def latest_run(runs: DataFrame, endpoints: DataFrame, harvest_url: str) -> DataFrame:
    """The run with the latest until_date of one endpoint (ties: the largest id)."""
    found = runs.join(endpoints.filter(F.col("harvest_url") == harvest_url).select(F.col("id").alias("endpoint_id"), "harvest_url"), "endpoint_id")
    return found.orderBy(F.col("until_date").desc_nulls_last(), F.col("id").desc()).limit(1).select(*RUN_COLUMNS)


def latest_runs(runs: DataFrame, endpoints: DataFrame) -> DataFrame:
    """The latest run of each endpoint that has one: a maximum per group, combined before the shuffle."""
    best = F.max(F.struct("until_date", "id", *(c for c in RUN_COLUMNS if c not in ("harvest_url", "id", "until_date")))).alias("run")
    top = runs.groupBy("endpoint_id").agg(best)
    found = top.join(endpoints.select(F.col("id").alias("endpoint_id"), "harvest_url"), "endpoint_id")
    return found.select("harvest_url", *(F.col(f"run.{c}").alias(c) for c in RUN_COLUMNS if c != "harvest_url"))


def last_closed(runs: DataFrame) -> DataFrame:
    """(endpoint_id, from_date): what the next run of each endpoint starts from."""
    return runs.filter("status = 'closed'").groupBy("endpoint_id").agg(F.max("until_date").alias("from_date"))


def next_run_from_date(runs: DataFrame, endpoints: DataFrame) -> DataFrame:
    """(harvest_url, from_date) of every endpoint; null for one without a closed run."""
    e = endpoints.select(F.col("id").alias("endpoint_id"), "harvest_url")
    return e.join(last_closed(runs), "endpoint_id", "left").select("harvest_url", "from_date")


def open_run(runs: DataFrame, endpoints: DataFrame, harvest_url: str, run_id: Column, now: Column) -> DataFrame:
    """The row of a new open run; raises ValueError for an unknown endpoint or one with an open run."""
    endpoint = endpoints.filter(F.col("harvest_url") == harvest_url).select(F.col("id").alias("endpoint_id"))
    if endpoint.isEmpty():
        raise ValueError(f"no endpoint has the url {harvest_url}")
    if not runs.filter("status = 'open'").join(endpoint, "endpoint_id", "left_semi").isEmpty():
        raise ValueError(f"the endpoint {harvest_url} has an open run")
    zero = {f"records_{x}": F.lit(0) for x in ("harvested", "created", "updated", "deleted")}
    new = endpoint.join(last_closed(runs), "endpoint_id", "left").withColumns({"id": run_id, "status": F.lit("open"), "until_date": now, "started_at": F.lit(None).cast("timestamp"), "completed_at": F.lit(None).cast("timestamp"), **zero})
    return new.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in runs.schema])


def open_runs(runs: DataFrame, endpoints: DataFrame, repositories: DataFrame) -> DataFrame:
    config = endpoints.join(repositories.select(F.col("id").alias("repository_id"), "code"), "repository_id").select(F.col("id").alias("endpoint_id"), "name", "harvest_url", "harvest_params", "protocol", "code")
    return runs.filter("status = 'open'").join(config, "endpoint_id").select("id", "from_date", "until_date", "name", "harvest_url", "harvest_params", "protocol", "code")


def closed_runs(runs: DataFrame) -> DataFrame:
    return runs.filter("status <> 'open'").select("id", "endpoint_id", "status")


def close_runs(runs: DataFrame, requests: DataFrame) -> DataFrame:
    """runs after the requests (id, success, started_at, completed_at): open ones are closed or failed, others stay as they are."""
    q = requests.select("id", F.when(F.col("success"), "closed").otherwise("failed").alias("_status"), F.col("started_at").alias("_started"), F.col("completed_at").alias("_completed"))
    out = runs.join(q, "id", "left")
    hit = (F.col("status") == "open") & F.col("_status").isNotNull()
    changed = {"started_at": "_started", "completed_at": "_completed", "status": "_status"}
    return out.select([F.when(hit, F.col(changed[c])).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in runs.columns])


def register_events(events: DataFrame, requests: DataFrame, runs: DataFrame, endpoints: DataFrame, repositories: DataFrame) -> DataFrame:
    """requests with repository_id, endpoint_id and `reason`: null for those that become events, else why not.

    Keys are looked up; an unknown one is a reason. A request whose (endpoint, run, identifier) is registered, or that is not the first of its key
    (by its id) among the requests, is a duplicate. The repository need not be the endpoint's.
    """
    r = repositories.select(F.col("code").alias("repo_code"), F.col("id").alias("repository_id"))
    e = endpoints.select("harvest_url", F.col("id").alias("endpoint_id"))
    h = runs.filter("status = 'open'").select(F.col("id").alias("harvest_run_id"), F.lit(True).alias("_open"))
    known = events.select("endpoint_id", "harvest_run_id", "record_identifier", F.lit(True).alias("_known"))
    out = requests.join(r, "repo_code", "left").join(e, "harvest_url", "left").join(h, "harvest_run_id", "left").join(known, ["endpoint_id", "harvest_run_id", "record_identifier"], "left")
    first = F.row_number().over(Window.partitionBy("endpoint_id", "harvest_run_id", "record_identifier").orderBy("id"))
    out = out.withColumn("_n", first)
    reason = (
        F.when(F.col("repository_id").isNull(), "unknown repository")
        .when(F.col("endpoint_id").isNull(), "unknown endpoint")
        .when(F.col("_open").isNull(), "no open run")
        .when(F.col("_known") | (F.col("_n") > 1), "duplicate")
    )
    if "raw_metadata" in requests.columns:
        raw = F.col("raw_metadata")
        reason = F.when(~well_formed(raw, parse(raw)), "malformed XML").otherwise(reason)
    return out.withColumn("reason", reason).select(*requests.columns, "repository_id", "endpoint_id", "reason")


def event_scan(events: DataFrame, runs: DataFrame, endpoints: DataFrame, repositories: DataFrame) -> DataFrame:
    """Events of closed runs with what the transformation needs of their run, endpoint and repository."""
    closed = runs.filter("status = 'closed'").select(F.col("id").alias("harvest_run_id"))
    e = endpoints.select(F.col("id").alias("endpoint_id"), "harvest_url")
    r = repositories.select(F.col("id").alias("repository_id"), "code")
    return events.join(closed, "harvest_run_id").join(e, "endpoint_id").join(r, "repository_id")


def assign_batches(rows: DataFrame, order: list[str], size: int = BATCH_SIZE, buckets: int = 64) -> DataFrame:
    """rows with batch_no: consecutive rows in this order, `size` to a batch.

    The order is global, but no task sorts all rows: rows are dealt in ranges of the first key, ranges are counted, and a row's number is its range's first
    number plus its own within the range.
    """
    ranges = rows.repartitionByRange(buckets, *order).withColumn("_range", F.spark_partition_id())
    counts = ranges.groupBy("_range").agg(F.count("*").alias("_n"))
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")  # a row for each range
    number = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return ranges.withColumn("_number", number).join(F.broadcast(starts), "_range").withColumn("batch_no", F.floor((F.col("_start") + F.col("_number")) / size).cast("long")).select(*rows.columns, "batch_no")
