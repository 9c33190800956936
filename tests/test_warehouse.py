"""From an empty warehouse through runs, events and indexing to searches and the report."""

import datetime

import pytest
from pyspark.sql import functions as F

from sheafmill.api import Warehouse
from sheafmill.operators import merge, runs, search
from sheafmill.plans import reports
from sheafmill.plans.transform import searchable
from sheafmill.sources import harvest, tables
from tests.test_documents import record, resource

NOW = datetime.datetime(2025, 6, 1, 12, 0, 0)
URL = "https://ssh.datastations.nl/oai"


@pytest.fixture()
def house(spark, tmp_path):
    harvest.bootstrap(spark, str(tmp_path), NOW)
    harvest.create_index(spark, str(tmp_path), "docs", 384)
    return Warehouse(spark, str(tmp_path))


def request(run, identifier, xml, deleted=False, code="DANS", url=URL):
    return (identifier, NOW, xml, None, url, code, run, deleted)


REQUEST = "record_identifier string, datestamp timestamp, raw_metadata string, additional_metadata string, harvest_url string, repo_code string, harvest_run_id string, is_deleted boolean"


def test_life_of_a_run(spark, house):
    assert house.health()["status"] == "ok" and house.list_endpoints().count() == 9
    assert harvest.verify(spark, house.root) == {"tables": 5, "enumerations": 4, "resource_types": 32}
    run = house.open_run(URL)
    assert run["code"] == "DANS" and run["from_date"] is None
    with pytest.raises(ValueError, match="open run"):
        house.open_run(URL)
    with pytest.raises(ValueError, match="no endpoint"):
        house.open_run("https://nowhere.example")
    good, other = record(resource()), record(resource(identifier='<identifier identifierType="URL">https://x</identifier>', titles="<titles><title>Farming in math</title></titles>"))
    bad = record(resource(dates='<dates><date dateType="Issued">202-05-29</date></dates>'))
    asked = [request(run["id"], "a", good), request(run["id"], "b", other), request(run["id"], "c", bad), request(run["id"], "a", other), request(run["id"], "d", "<a>"), request("none", "e", good), request(run["id"], "f", good, code="NO"), request(run["id"], "g", record("<x/>")), request(run["id"], "h", good, url="no")]
    outcome = house.register_events(spark.createDataFrame(asked, REQUEST))
    reasons = sorted((r["record_identifier"], r["reason"] or "") for r in outcome.collect())
    assert reasons == [("a", ""), ("a", "duplicate"), ("b", ""), ("c", ""), ("d", "malformed XML"), ("e", "no open run"), ("f", "unknown repository"), ("g", ""), ("h", "unknown endpoint")]
    assert house.start_index(run["id"], "docs") == 0  # the run is open
    house.close_run(run["id"], True, NOW, NOW)
    house.close_run(run["id"], False, NOW, NOW)  # changes nothing
    with pytest.raises(ValueError, match="no run"):
        house.close_run("none", True, NOW, NOW)
    assert [(r["id"], r["status"]) for r in house.latest_runs(URL).collect()] == [(run["id"], "closed")]
    assert house.latest_runs().count() == 1
    assert house.start_index(run["id"], "docs", 2) == 2
    records = {r["record_identifier"]: r for r in house.table("records").collect()}
    first = next(r["raw_metadata"] for r in house.table("harvest_events").filter("record_identifier = 'a'").collect())
    assert set(records) == {"a", "b"} and records["b"]["title"] == "Farming in math" and records["b"]["url"] == "https://x" and records["b"]["id"].endswith("::b")
    messages = {r["record_identifier"]: r["error_message"] for r in house.table("harvest_events").collect()}
    assert messages["c"].startswith("'202-05-29' does not match") and messages["a"] is messages["g"] is None
    assert house.table("docs").count() == len({records["a"]["doi"] or records["a"]["url"], "https://x"})

    text = reports.render({t: house.table(t) for t in tables.SCHEMAS}, "now", "db")
    assert "- **Total Records Harvested:** 2" in text and "| Social Sciences Data Station | 4 | 3 | 1 | 75.0% |" in text and "✓ _No duplicates detected._" in text and first
    assert harvest.write_report(text, house.root, NOW).endswith("report_2025-06-01_12-00-00.md")

    again = house.open_run(URL)
    assert again["from_date"] is not None
    house.register_events(spark.createDataFrame([request(again["id"], "b", good, True)], REQUEST))
    house.close_run(again["id"], True, NOW, NOW)
    house.start_index(again["id"], "docs")
    assert [r["record_identifier"] for r in house.table("records").collect()] == ["a"]
    assert "https://x" not in [r["id"] for r in house.table("docs").collect()] or records["a"]["url"] == "https://x"
    assert merge.audit({t: house.table(t) for t in tables.SCHEMAS}).filter("violations > 0").collect() == []


def test_searches(spark, house):
    run = house.open_run(URL)
    titles = ["Mathematics of farms", "Farm animals", "Poetry"]
    events = [request(run["id"], str(i), record(resource(identifier=f'<identifier identifierType="DOI">{i}</identifier>', titles=f'<titles><title xml:lang="{"en" if i < 2 else "de"}">{t}</title><title xml:lang="en">second</title></titles>', publicationYear=f"<publicationYear>{2020 + i}</publicationYear>"))) for i, t in enumerate(titles)]
    house.register_events(spark.createDataFrame(events, REQUEST))
    house.close_run(run["id"], True, NOW, NOW)
    house.start_index(run["id"], "docs")
    index = searchable(house.table("docs")).select("*", "doc.titles", "doc.dates", "doc.publicationYear").cache()
    ids = lambda df: sorted(r["id"][-1] for r in df.collect())
    assert ids(search.query_string(index, "_title", "math*")) == ["0"] and ids(search.query_string(index, "_title", "farm* second")) == ["0", "1"]
    assert ids(search.query_string(index, "_all_fields", "sub")) == ["0", "1", "2"]
    assert ids(search.nested(index, "titles", lambda t: (t["lang"] == "de") & t["title"].startswith("P"))) == ["2"]
    assert ids(search.nested(index, "titles", lambda t: (t["lang"] == "de") & (t["title"] == "second"))) == []
    assert ids(search.nested(index, "dates", lambda d: (d["date"] <= "2024-06-01") & (d["dateType"] == "Issued"))) == ["0", "1", "2"]
    vector = index.filter(F.col("id").endswith("/1")).first()["emb"]
    assert [r["id"][-1] for r in search.knn(index, vector, 2).collect()][0] == "1"
    assert ids(search.knn(index, vector, 5, where=F.col("publicationYear") >= "2022")) == ["2"]
    assert [(r["key"], r["doc_count"]) for r in search.facet(index, "_resourceTypeGeneral").collect()] == [("Dataset", 3)]


def test_merges(spark):
    current = spark.createDataFrame([("k1", "a", 1), ("k2", "b", 1)], "key string, v string, version int")
    changes = spark.createDataFrame([("k2", "B", 5), ("k3", "C", 5)], "key string, v string, version int")
    assert sorted(map(tuple, merge.upsert(current, changes, ["key"], ["v"]).collect())) == [("k1", "a", 1), ("k2", "B", 1), ("k3", "C", 5)]
    assert sorted(map(tuple, merge.insert_ignore(current, changes, ["key"]).collect())) == [("k1", "a", 1), ("k2", "b", 1), ("k3", "C", 5)]
    assert merge.delete_by_key(current, changes, ["key"]).collect()[0]["key"] == "k1"
    assert merge.upsert(current.limit(0), changes.limit(0), ["key"], ["v"]).collect() == []


def test_batches(spark):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("n")).repartition(5)
    got = runs.assign_batches(rows, ["n"], 125).collect()
    assert sorted((r["n"], r["batch_no"]) for r in got) == [(n, n // 125) for n in range(1000)]


def test_files(spark, tmp_path):
    (tmp_path / "in/deep").mkdir(parents=True)
    for name, text in (("a.oai_datacite.xml", record(resource())), ("deep/b.oai.xml", "<record><header><identifier>x</identifier></header></record>"), ("c.txt", "no")):
        (tmp_path / "in" / name).write_text(text + "\n")
    files = harvest.extract_headers(harvest.read_xml_files(spark, str(tmp_path / "in")))
    assert sorted((r["name"], r["record_identifier"], r["rejected"]) for r in files.collect()) == [("a.oai_datacite.xml", "oai:1", None), ("b.oai.xml", "x", "no datestamp")]
    sides = spark.createDataFrame([("a.json", "one"), ("b.json", "two"), ("b2.json", "three")], "name string, value string")
    found = {r["name"]: r["additional_metadata"] for r in harvest.attach_side_file(files.select("name"), sides).collect()}
    assert found == {"a.oai_datacite.xml": "one", "b.oai.xml": None}


def test_snapshots(spark, tmp_path):
    root = str(tmp_path)
    for n, version in enumerate(["a", "b", "c"]):
        harvest.write_snapshot(spark.range(n + 1), root, "t", version)
        assert harvest.read_snapshot(spark, root, "t").count() == n + 1
    spark.range(9).write.parquet(f"{root}/t/version=d")  # its writer died before the pointer
    assert harvest.read_snapshot(spark, root, "t").count() == 3
    harvest.write_snapshot(spark.range(5), root, "t", "a")  # an old version, written and pointed to again
    assert harvest.read_snapshot(spark, root, "t").count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        harvest.read_snapshot(spark, root, "none")


def test_stream_in_several_batches(spark, tmp_path):
    from sheafmill.streaming.ingest import stream_upsert

    rows = [(k, v) for v in range(4) for k in range(v, 6)]
    for v in range(4):
        spark.createDataFrame([r for r in rows if r[1] == v], "key int, v int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    table = stream_upsert(spark, str(tmp_path / "in"), "*.parquet", spark.read.parquet(str(tmp_path / "in")).schema, str(tmp_path / "out"), "t", ["key"], [F.col("v").desc()], str(tmp_path / "check"), files=1)
    assert sorted(r["key"] for r in table.collect()) == list(range(6))


def test_late_and_repeated_rows(spark, tmp_path):
    """The row that is first in the order stays, whatever batch it comes in; of rows alike in it, one of the latest batch; also when the stream goes on later."""
    from sheafmill.streaming.ingest import stream_upsert

    schema = "key int, ts int, v string"

    def come(*batches):
        for rows in batches:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        table = stream_upsert(spark, str(tmp_path / "in"), "*.parquet", spark.read.parquet(str(tmp_path / "in")).schema, str(tmp_path / "out"), "t", ["key"], [F.col("ts").desc()], str(tmp_path / "check"), files=1)
        return sorted(map(tuple, table.collect()))

    assert come([(1, 10, "a"), (2, 1, "a"), (2, 2, "b")], [(1, 5, "late"), (3, 1, "a")], [(2, 2, "again")]) == [(1, 10, "a"), (2, 2, "again"), (3, 1, "a")]
    assert come([(1, 9, "late"), (3, 1, "again"), (4, 1, "a")]) == [(1, 10, "a"), (2, 2, "again"), (3, 1, "again"), (4, 1, "a")]
    assert come() == [(1, 10, "a"), (2, 2, "again"), (3, 1, "again"), (4, 1, "a")]


def test_writer_that_dies(spark, tmp_path):
    """A failure between tables leaves all of them at the versions before."""
    root = str(tmp_path)
    frame = lambda v: spark.createDataFrame([(v,)], "v int")
    harvest.write_snapshots(spark, root, {"a": frame(1), "b": frame(1)}, "1")
    broken = frame(2).select(F.raise_error(F.lit("dies")).cast("int").alias("v"))
    with pytest.raises(Exception, match="dies"):
        harvest.write_snapshots(spark, root, {"a": frame(2), "b": broken}, "2")
    assert [harvest.read_snapshot(spark, root, n).first()["v"] for n in "ab"] == [1, 1]
    harvest.write_snapshots(spark, root, {"a": frame(2), "b": frame(2)}, "2")
    assert [harvest.read_snapshot(spark, root, n).first()["v"] for n in "ab"] == [2, 2]


def test_latest_document_of_an_id(spark):
    from sheafmill.plans.transform import Change, apply_to_index

    index = spark.createDataFrame([("x", 0), ("y", 0)], "id string, v int")
    documents = spark.createDataFrame([((5, "e1"), "x", 1), ((7, "e0"), "x", 2), ((7, "e2"), "x", 3), ((1, "e9"), "z", 4)], "_order struct<datestamp:int,event_id:string>, id string, v int")
    none = spark.createDataFrame([], "endpoint_id string, record_identifier string, doi string, url string")
    got = apply_to_index(index, none, Change(none, none.select("endpoint_id", "record_identifier"), none, documents))
    assert sorted(map(tuple, got.collect())) == [("x", 3), ("y", 0), ("z", 4)]
