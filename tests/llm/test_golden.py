import datetime
import random

import duckdb
import pytest

from sheafmill.llm import golden
from sheafmill.llm.golden import client_rules, clusters_of, golden_records, op13_golden_record, survivors, with_latest

SCHEMA = "client_id long, master_id long, source string, updated_at timestamp_ntz, name string, email string, city string, nation_id int, segment string, balance double, n_records string, best int, part string"
START = datetime.datetime(2024, 3, 1)


def rows(n, seed, clusters):
    r = random.Random(seed)
    times = [None, START, START + datetime.timedelta(hours=720), START + datetime.timedelta(hours=720, microseconds=1), *(START + datetime.timedelta(days=r.random() * 90) for _ in range(8))]
    out = []
    for i in range(n):
        master = r.choice([None, 0, *range(clusters)])
        out.append((
            r.choice([i, i, i % 7, None]), 0 if r.random() < 0.4 else master, r.choice(["crm", "web", "store", "partner", None, "new", "CRM"]), r.choice(times), r.choice([None, "", " \t", "Ann", "Bob", "Anná", " Bo ", " "]),
            r.choice([None, "", "a@x", "b@y"]), r.choice([None, "\r\n", "Rome", "Oslo"]), r.choice([None, 1, 2]), r.choice([None, "", "retail", "online"]), r.choice([None, 1.005, -3.2, float("nan"), float("inf"), 7.5, -0.0]), "x", 1, "y",
        ))
    return out


@pytest.mark.parametrize("n,seed,clusters", [(400, 1, 60), (600, 2, 3), (0, 3, 1), (1, 4, 1)])
def test_equals_sql(spark, tmp_path, n, seed, clusters):
    data = rows(n, seed, clusters)
    spark.createDataFrame(data + data[:20], SCHEMA).repartition(5).write.parquet(f"{tmp_path}/clients.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW clients AS SELECT * FROM read_parquet('{tmp_path}/clients.parquet/*.parquet')")
    want = con.execute(golden.ORACLE_OP13).fetchall()
    got = op13_golden_record(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_large_cluster_is_split(spark):
    wide = spark.range(20000).selectExpr("id AS client_id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS cluster_id", "'web' AS source", "timestamp_ntz '2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id) AS updated_at")
    clusters = clusters_of(wide).cache()
    found = with_latest(wide, clusters)
    assert found.count() == 20000 and found.filter("latest IS NULL").isEmpty()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_piece" in plan
    pieces = wide.join(clusters, "cluster_id").filter("n > 20").select("cluster_id").distinct().count()
    assert pieces == 1


def test_stale_to_the_microsecond(spark):
    late = START + datetime.timedelta(hours=720)
    data = [(1, 1, "web", late), (2, 1, "web", START), (3, 1, "web", START - datetime.timedelta(microseconds=1)), (4, 1, "web", None)]
    clients = spark.createDataFrame([(*d, "n", None, None, None, None, None) for d in data], "client_id long, master_id long, source string, updated_at timestamp_ntz, name string, email string, city string, nation_id int, segment string, balance double")
    got = golden_records(clients).first()
    assert (got["n_records"], got["n_stale"], got["name_from"], got["email"], got["address_from"]) == (4, 2, 1, None, None)


def test_rules_are_free(spark):
    data = spark.createDataFrame([(1, 5, "crm", START, "a", 2.0), (2, 5, "web", START, "bb", None)], "client_id long, cluster_id long, source string, updated_at timestamp_ntz, title string, size double")
    F = golden.F
    rules = [golden.Rule("title", {"title": F.col("title")}, lead=F.char_length("title"), whole=True), golden.Rule("size", {"size": F.col("size")})]
    got = survivors(with_latest(data, clusters_of(data)), rules).first().asDict()
    assert got == {"cluster_id": 5, "n_records": 2, "n_stale": 0, "title": "a", "size": 2.0, "title_from": 1, "size_from": 1}
    assert len(client_rules()) == 5
