"""Views that are kept up to date: statistics of records and counts of events, as bucketed tables that follow each change in its transaction.

    log.transact(lambda t: views.create(t))                  # from then on plans.changes keeps them up
    views.records_statistics(log.state())                    # reads a row a group, no records

A change tells what its buckets held and hold. Rows with the sign -1 and +1 are added up, so what did not change cancels out, and a view's touched buckets alone are read and rewritten. Tables:
`records_statistics`: a row for each repository, endpoint and type. `records_statistics_dois`: how many records of a group have a DOI, so that a DOI counts once until its last record goes; it is dealt by DOI, so
no bucket grows with a group. `events_summary`: a row for each repository and endpoint.

The latest time of a group needs no list of times: it changes with what comes, unless the record that had it goes and nothing as late comes. Only for groups that lost theirs the records are read again (three
narrow columns and the time). A group without records goes. Groups are kept by ids; names are joined when a view is read (they are unique in their tables), so that a new name shows at once. Nulls are a group
of their own; a null DOI is not counted.

Two writers whose changes meet in a group follow one another, as they do in a bucket of records: the later one works its change out again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafmill.plans.reports import named
from sheafmill.session import Scratch
from sheafmill.sources.commits import State, Transaction

STATISTICS, DOIS, EVENTS = "records_statistics", "records_statistics_dois", "events_summary"
GROUP = ["repository_id", "endpoint_id", "resource_type"]
EVENT_GROUP = ["repository_id", "endpoint_id"]
BUCKETS = 32


def _cells(rows: DataFrame) -> DataFrame:
    """rows (with a sign) by group and DOI: records, synced ones, the latest time of what went and of what came."""
    sign, time = F.col("sign"), F.col("updated_at")
    return rows.groupBy(*GROUP, "doi").agg(
        F.sum(sign).alias("n"), F.sum(F.when(F.col("opensearch_synced"), sign).otherwise(0)).alias("synced"),
        F.max(F.when(sign < 0, time)).alias("removed"), F.max(F.when(sign > 0, time)).alias("added"),
    )


def _signed(rows: DataFrame, columns: list[str], sign: int) -> DataFrame:
    return rows.select(*columns, F.lit(sign).cast("long").alias("sign"))


_OF_RECORDS = [*GROUP, "doi", "opensearch_synced", "updated_at"]


def create(t: Transaction, buckets: int = BUCKETS) -> None:
    """The views of what is there, in the place of older ones."""
    with Scratch(t.spark) as scratch:
        cells = scratch.keep(_cells(_signed(t.changed("records"), _OF_RECORDS, 1)), "cells")
        t.create(DOIS, cells.filter("doi IS NOT NULL").select(*GROUP, "doi", "n"), [*GROUP, "doi"], buckets)
        groups = cells.groupBy(*GROUP).agg(F.sum("n").alias("record_count"), F.count("doi").alias("unique_dois"), F.sum("synced").alias("synced_count"), F.max("added").alias("last_updated"))
        t.create(STATISTICS, groups, GROUP, buckets)
        t.create(EVENTS, t.changed("harvest_events").groupBy(*EVENT_GROUP).agg(F.count("*").alias("event_count")), EVENT_GROUP, buckets)


def renew(t: Transaction, names: Iterable[str]) -> None:
    """Make the views again, if there are some, after tables that they show were written as a whole."""
    if t.has(STATISTICS) and {"records", "harvest_events"} & set(names):
        create(t, t.state.tables[STATISTICS].buckets)


def follow(t: Transaction, name: str, before: DataFrame | None, after: DataFrame) -> None:
    """Bring the views up to a change of a table: rows that its touched buckets held (None: nothing was taken away) and hold now. after is read once; without views nothing is read."""
    kind = {"records": (STATISTICS, _OF_RECORDS, _follow_records), "harvest_events": (EVENTS, EVENT_GROUP, _follow_events)}.get(name)
    if kind is None or not t.has(kind[0]):
        return
    view, columns, work = kind
    rows = _signed(after, columns, 1)
    work(t, rows if before is None else rows.unionByName(_signed(before, columns, -1)))


def _follow_events(t: Transaction, rows: DataFrame) -> None:
    with Scratch(t.spark) as scratch:
        delta = scratch.keep(rows.groupBy(*EVENT_GROUP).agg(F.sum("sign").alias("event_count")).filter("event_count <> 0"), "delta")
        buckets = t.touched(EVENTS, delta)
        if buckets:
            summed = t.read(EVENTS, buckets).unionByName(delta).groupBy(*EVENT_GROUP).agg(F.sum("event_count").alias("event_count"))
            t.replace(EVENTS, summed.filter("event_count > 0"), buckets)


def _follow_records(t: Transaction, rows: DataFrame) -> None:
    same = F.col("removed").eqNullSafe(F.col("added"))  # the latest that went is still there: neither matters
    with Scratch(t.spark) as scratch:
        cells = _cells(rows).filter(~((F.col("n") == 0) & (F.col("synced") == 0) & same))
        delta = scratch.keep(cells.withColumns({c: F.when(~same, F.col(c)) for c in ("removed", "added")}), "delta")
        buckets = t.touched(STATISTICS, delta)
        if buckets:
            _write_groups(t, scratch, delta, _write_dois(t, scratch, delta), buckets)


def _write_dois(t: Transaction, scratch: Scratch, delta: DataFrame) -> DataFrame:
    """Counts of DOIs after the change; returns by how much the different ones of each group change."""
    key = [*GROUP, "doi"]
    cells = delta.filter("doi IS NOT NULL AND n <> 0")
    buckets = t.touched(DOIS, cells)
    none = F.lit(0).cast("long")
    both = t.read(DOIS, buckets).select(*key, F.col("n").alias("old"), none.alias("more")).unionByName(cells.select(*key, none.alias("old"), F.col("n").alias("more")))
    summed = scratch.keep(both.groupBy(*key).agg(F.sum("old").alias("old"), F.sum(F.col("old") + F.col("more")).alias("n")), "dois")
    if buckets:
        t.replace(DOIS, summed.filter("n > 0").select(*key, "n"), buckets)
    change = F.when(F.col("n") > 0, 1).otherwise(0) - F.when(F.col("old") > 0, 1).otherwise(0)
    return summed.select(*GROUP, change.cast("long").alias("unique_dois")).filter("unique_dois <> 0")


def _write_groups(t: Transaction, scratch: Scratch, delta: DataFrame, dois: DataFrame, buckets: list[int]) -> None:
    counts = ["record_count", "unique_dois", "synced_count"]
    stored = t.read(STATISTICS, buckets)
    time = stored.schema["last_updated"].dataType

    def rows(df: DataFrame, **have: Column) -> DataFrame:
        zeros = {c: F.lit(0).cast("long") for c in counts} | {c: F.lit(None).cast(time) for c in ("old", "removed", "added")}
        return df.select(*GROUP, *(have.get(c, none).alias(c) for c, none in zeros.items()))

    parts = [
        rows(stored, **{c: F.col(c) for c in counts}, old=F.col("last_updated")),
        rows(delta, record_count=F.col("n"), synced_count=F.col("synced"), removed=F.col("removed"), added=F.col("added")),
        rows(dois, unique_dois=F.col("unique_dois")),
    ]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    old, removed, added = F.col("old"), F.col("removed"), F.col("added")
    last = F.when(removed.isNull() | (removed < old), F.greatest(old, added)).when(added >= old, added)
    summed = whole.groupBy(*GROUP).agg(*(F.sum(c).alias(c) for c in counts), *(F.max(c).alias(c) for c in ("old", "removed", "added")))
    lost = removed.isNotNull() & last.isNull()
    found = scratch.keep(summed.filter("record_count > 0").select(*GROUP, *counts, last.alias("last_updated"), lost.alias("lost")), "groups")
    if not found.filter("lost").isEmpty():
        asked = found.filter("lost").select(*(F.col(c).alias(f"_{c}") for c in GROUP))
        records = t.changed("records").select(*GROUP, "updated_at")
        on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in GROUP]
        again = records.join(asked, on, "left_semi").groupBy(*GROUP).agg(F.max("updated_at").alias("last_updated"))
        both = found.drop("lost").unionByName(again.select(*GROUP, *(F.lit(0).cast("long").alias(c) for c in counts), "last_updated"))
        found = both.groupBy(*GROUP).agg(*(F.sum(c).alias(c) for c in counts), F.max("last_updated").alias("last_updated"))
    t.replace(STATISTICS, found.select(*GROUP, *counts, "last_updated"), buckets)


def _repositories(state: State) -> DataFrame:
    return state.read("repositories").select(F.col("id").alias("repository_id"), F.col("name").alias("repository_name"))


def records_statistics(state: State) -> DataFrame:
    """What reports.records_statistics() returns."""
    found = state.read(STATISTICS).join(named(state.read("endpoints")), "endpoint_id").join(_repositories(state), "repository_id")
    return found.select("repository_name", "endpoint_name", "resource_type", "record_count", "unique_dois", "synced_count", "last_updated")


def events_summary(state: State) -> DataFrame:
    """What reports.events_summary() returns."""
    found = state.read(EVENTS).join(named(state.read("endpoints")), "endpoint_id").join(_repositories(state), "repository_id")
    return found.select("endpoint_name", "repository_name", "event_count")
