"""Changes of the warehouse's tables within a transaction: each reads and rewrites only the buckets that its keys lie in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafmill.functions.scalars import make_id
from sheafmill.operators import merge
from sheafmill.operators import runs as ops
from sheafmill.plans import views
from sheafmill.plans.transform import KEY, Change, apply_to_events, apply_to_index, apply_to_records
from sheafmill.session import Scratch
from sheafmill.sources.commits import Transaction
from sheafmill.sources.tables import FOREIGN, conform

EVENT_KEY = ["endpoint_id", "harvest_run_id", "record_identifier"]


def put(t: Transaction, name: str, rows: DataFrame, buckets: list[int]) -> None:
    """These buckets now hold rows; views follow."""
    t.replace(name, rows, buckets)
    views.follow(t, name, t.read(name, buckets), t.changed(name, buckets))


def upsert(t: Transaction, name: str, changes: DataFrame, keys: list[str], updates: list[str], on_update: dict[str, Column] | None = None) -> list[int]:
    """merge.upsert() on a table whose bucket keys are among the keys; returns the buckets that were rewritten."""
    buckets = t.touched(name, changes)
    put(t, name, merge.upsert(t.read(name, buckets), changes, keys, updates, on_update), buckets)
    return buckets


def delete(t: Transaction, name: str, gone: DataFrame, keys: list[str]) -> list[int]:
    """merge.delete_by_key() on a table whose bucket keys are among the keys."""
    buckets = t.touched(name, gone)
    put(t, name, merge.delete_by_key(t.read(name, buckets), gone, keys), buckets)
    return buckets


def delete_cascade(t: Transaction, parent: str, gone: DataFrame) -> dict[str, list[int]]:
    """Delete the rows of parent with the ids of gone (column id), and what refers to deleted rows; returns the buckets that were rewritten of each table. Ids and references alone are read to find them."""
    rewritten, deleted = {}, {parent: gone.select("id").distinct()}
    with Scratch(t.spark) as scratch:
        for name in dict.fromkeys((parent, *FOREIGN)):
            if name != parent:
                of = [(column, above) for column, above in FOREIGN[name] if above in deleted]
                if not of or not t.has(name):
                    continue
                keys = t.state.tables[name].keys
                refers = [t.read(name).select("id", *(F.col(k).alias(f"_{k}") for k in keys), column).join(deleted[above].select(F.col("id").alias(column)), column, "left_semi").drop(column) for column, above in of]
                deleted[name] = scratch.keep(reduce(DataFrame.unionByName, refers).distinct(), f"gone-{name}")
                lost = deleted[name].select("id", *(F.col(f"_{k}").alias(k) for k in keys if k != "id"))
            else:
                lost = scratch.keep(t.read(name).join(deleted[name], "id", "left_semi").select("id", *(k for k in t.state.tables[name].keys if k != "id")), f"gone-{name}")
            rewritten[name] = t.touched(name, lost)
            if rewritten[name]:
                put(t, name, merge.delete_by_key(t.read(name, rewritten[name]), lost, ["id"]), rewritten[name])
    return rewritten


def open_run(t: Transaction, harvest_url: str, run_id: Column, now: Column) -> None:
    """Add an open run. All runs of an endpoint lie in one bucket, which is read: of two writers that open a run at once the second is told that there is one."""
    endpoints = t.read("endpoints")
    asked = endpoints.filter(F.col("harvest_url") == harvest_url).select(F.col("id").alias("endpoint_id"))
    runs = t.read("harvest_runs", t.touched("harvest_runs", asked))
    t.append("harvest_runs", ops.open_run(runs, endpoints, harvest_url, run_id, now))


def close_run(t: Transaction, request: DataFrame) -> None:
    """request: one row (id, success, started_at, completed_at). Raises ValueError for an unknown run."""
    run_id = request.first()["id"]
    found = t.state.read("harvest_runs").filter(F.col("id") == run_id).select("endpoint_id")
    buckets = t.touched("harvest_runs", found)
    if not buckets:
        raise ValueError(f"no run has the id {run_id}")
    t.replace("harvest_runs", ops.close_runs(t.read("harvest_runs", buckets), request), buckets)


def register_events(t: Transaction, requests: DataFrame, judge) -> DataFrame:
    """Add the events that have no reason against them; returns all requests with their reasons. Registered events are looked up in the buckets of the requests' keys and stay where they are.

    judge(events, requests, runs, endpoints, repositories) returns what runs.register_events() does, worked out.
    """
    endpoints = t.read("endpoints")
    keyed = requests.join(endpoints.select("harvest_url", F.col("id").alias("endpoint_id")), "harvest_url", "left").select(*EVENT_KEY)
    events, runs = t.read("harvest_events", t.touched("harvest_events", keyed)), t.read("harvest_runs", t.touched("harvest_runs", keyed))
    judged = judge(events, requests, runs, endpoints, t.read("repositories"))
    new = judged.filter("reason IS NULL").withColumns({"metadata_format": F.lit("XML"), "metadata_protocol": F.lit("OAI-PMH")})
    t.append("harvest_events", conform(new, "harvest_events"))
    views.follow(t, "harvest_events", None, new)
    return judged


def apply_change(t: Transaction, index: str, change: Change, now: Column) -> None:
    """Records, events and the index after a transformed run, all three or none."""
    touched = t.touched("records", change.records.select(*KEY).unionByName(change.gone.select(*KEY)))
    records = t.read("records", touched)
    put(t, "records", apply_to_records(records, change, now), touched)
    events = t.touched("harvest_events", change.results)
    put(t, "harvest_events", apply_to_events(t.read("harvest_events", events), change), events)
    ids = records.join(change.gone, KEY, "left_semi").select(make_id(F.col("doi"), F.col("url")).alias("id"))
    documents = t.touched(index, ids.unionByName(change.documents.select("id")))
    t.replace(index, apply_to_index(t.read(index, documents), records, change), documents)
