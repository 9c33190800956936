"""Views kept up to date against what the whole tables say."""

import random

import pytest
from pyspark.sql import functions as F

from sheafmill.plans import changes, reports, views
from sheafmill.sources.commits import Log, Transaction

KEY = ["endpoint_id", "record_identifier"]
RECORD = "id string, endpoint_id string, repository_id string, record_identifier string, resource_type string, doi string, opensearch_synced boolean, updated_at timestamp"
EVENT = "id string, repository_id string, endpoint_id string, harvest_run_id string, record_identifier string"
UPDATES = ["resource_type", "doi", "opensearch_synced", "updated_at"]


def record(rng, key):
    import datetime

    endpoint = key % 3
    time = rng.choice([None, datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=rng.randrange(40))])
    return (str(key), str(endpoint), str(endpoint % 2), str(key), rng.choice(["Text", "Dataset", None]), rng.choice([None, "10.1/a", "10.1/b", f"10.1/{key}"]), rng.choice([True, False, None]), time)


@pytest.fixture()
def log(spark, tmp_path):
    rng = random.Random(5)
    log = Log(spark, str(tmp_path))

    def start(t):
        t.create("repositories", spark.createDataFrame([("0", "R0"), ("1", "R1")], "id string, name string"), ["id"], 1)
        t.create("endpoints", spark.createDataFrame([(str(i), f"E{i}", str(i % 2)) for i in range(3)], "id string, name string, repository_id string"), ["id"], 1)
        t.create("records", spark.createDataFrame([record(rng, k) for k in range(40)], RECORD), KEY, 4)
        t.create("harvest_events", spark.createDataFrame([(str(i), str(i % 2), str(i % 3), "r", str(i)) for i in range(20)], EVENT), changes.EVENT_KEY, 4)
        views.create(t, 4)

    log.transact(start)
    return log


def check(log):
    state = log.state()
    names = [state.read(n) for n in ("endpoints", "repositories")]
    both = [(views.records_statistics(state), reports.records_statistics(state.read("records"), *names)), (views.events_summary(state), reports.events_summary(state.read("harvest_events"), *names))]
    for got, want in both:
        columns = sorted(want.columns)
        assert sorted(got.columns) == columns and dict(got.dtypes) == dict(want.dtypes)
        assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))
    dois = state.read("records").filter("doi IS NOT NULL").groupBy(*views.GROUP, "doi").agg(F.count("*").alias("n"))
    assert sorted(map(str, state.read(views.DOIS).collect())) == sorted(map(str, dois.collect()))


def test_views_follow_updates_inserts_and_deletes(spark, log):
    check(log)
    rng = random.Random(9)
    for step in range(2):
        keys = rng.sample(range(60), 12)
        rows = spark.createDataFrame([record(rng, k) for k in keys], RECORD)
        if step % 2:
            log.transact(lambda t: changes.delete(t, "records", rows, KEY))
        else:
            log.transact(lambda t: changes.upsert(t, "records", rows, KEY, UPDATES))
        check(log)


def test_a_group_that_loses_its_latest_record_reads_the_others(spark, log):
    latest = log.state().read("records").filter("endpoint_id = '1'").orderBy(F.col("updated_at").desc_nulls_last()).limit(3)
    log.transact(lambda t: changes.delete(t, "records", latest, KEY))
    check(log)


def test_a_change_that_changes_nothing_writes_no_view(spark, log):
    before = {v: log.state().tables[v].folders for v in (views.STATISTICS, views.DOIS)}
    same = log.state().read("records").limit(5)
    log.transact(lambda t: changes.upsert(t, "records", same, KEY, UPDATES))
    assert {v: log.state().tables[v].folders for v in before} == before
    check(log)


def test_views_follow_events_cascades_and_whole_tables(spark, log):
    new = spark.createDataFrame([(f"n{i}", "1", "1", "r2", str(i)) for i in range(7)], EVENT)

    def add(t):
        t.append("harvest_events", new)
        views.follow(t, "harvest_events", None, new)

    log.transact(add)
    check(log)
    rewritten = log.transact(lambda t: changes.delete_cascade(t, "endpoints", spark.createDataFrame([("1",), ("9",)], "id string")))
    assert set(rewritten) == {"endpoints", "harvest_events", "records"}
    assert log.state().read("records").filter("endpoint_id = '1'").isEmpty() and log.state().read("endpoints").count() == 2
    check(log)
    log.transact(lambda t: changes.delete_cascade(t, "repositories", spark.createDataFrame([("0",), ("1",)], "id string")))
    assert all(log.state().read(v).isEmpty() for v in (views.STATISTICS, views.DOIS, views.EVENTS, "records", "harvest_events", "endpoints"))
    log.transact(lambda t: [t.create("records", spark.createDataFrame([record(random.Random(1), 5)], RECORD), KEY, 4), views.renew(t, ["records"])])
    assert views.STATISTICS in log.state().tables and log.state().read(views.STATISTICS).count() == 1


def test_two_writers_of_one_group_both_count(spark, log):
    one, two = (spark.createDataFrame([(str(k), "0", "0", str(k), "Text", "10.9/x", True, None)], RECORD) for k in (900, 903))
    first, second = Transaction(log.state()), Transaction(log.state())
    changes.upsert(first, "records", one, KEY, UPDATES)
    changes.upsert(second, "records", two, KEY, UPDATES)
    assert second.commit() and not first.commit()  # they meet in the group
    log.transact(lambda t: changes.upsert(t, "records", one, KEY, UPDATES))
    check(log)
