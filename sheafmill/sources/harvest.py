"""Files in and out: XML records, side files, snapshots of tables, JSON documents, reports."""

from __future__ import annotations

import contextlib
import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafmill.operators.xml import header, parse
from sheafmill.plans import views
from sheafmill.sources.commits import Log, NoTable, Transaction
from sheafmill.sources.tables import ENUMS, RESOURCE_TYPE, SCHEMAS, conform, empty_table, seed_endpoints, seed_repositories


def read_xml_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name, raw_metadata) of every *.xml below a folder, one record a file."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.xml")
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("raw_metadata"))


def extract_headers(files: DataFrame) -> DataFrame:
    """files with record_identifier, datestamp and `rejected`: why a file without them is not taken."""
    identifier, stamp = header(parse(F.col("raw_metadata")))
    out = files.withColumns({"record_identifier": identifier, "datestamp": stamp})
    return out.withColumn("rejected", F.when(F.col("record_identifier").isNull(), "no identifier").when(F.col("datestamp").isNull(), "no datestamp"))


def attach_side_file(files: DataFrame, sides: DataFrame) -> DataFrame:
    """files (with name) and additional_metadata: the value of the side file (name, value) whose name starts with the file's name up to `.oai`, if there is exactly one.

    A side file is joined by its beginnings of just those lengths that names of files have (file names are short, so there are few), each to the name that is equal to it.
    """
    keyed = files.withColumn("_stem", F.split_part(F.col("name"), F.lit(".oai"), F.lit(1)))
    stems = keyed.select("_stem").distinct()
    lengths = [r["n"] for r in stems.select(F.char_length("_stem").alias("n")).distinct().collect() if r["n"] is not None]  # a row for each length of a file name
    starts = F.transform(F.array(*map(F.lit, sorted(lengths))).cast("array<int>"), lambda n: F.when(F.char_length("_side") >= n, F.substr(F.col("_side"), F.lit(1), n)))
    side = sides.select(F.col("name").alias("_side"), F.col("value").alias("_value")).select("_value", F.explode(starts).alias("_stem")).filter("_stem IS NOT NULL")
    found = stems.join(side, "_stem")
    single = found.groupBy("_stem").agg(F.count("*").alias("_n"), F.first("_value").alias("additional_metadata")).filter("_n = 1").drop("_n")
    return keyed.join(single, "_stem", "left").drop("_stem")


def write_json(documents: DataFrame, path: str) -> None:
    """Documents (a struct column `doc`) as JSON lines, without null fields."""
    documents.select(F.to_json("doc").alias("value")).write.text(path)


#: Columns that say a row's bucket: what is changed or checked together lies together (all runs of an endpoint, all events of one unique key).
BUCKET_KEYS = {"harvest_runs": ["endpoint_id"], "harvest_events": ["endpoint_id", "harvest_run_id", "record_identifier"], "records": ["endpoint_id", "record_identifier"]}
#: Buckets of a table that grows. A bucket is one file for each change that it saw, so choose them for files of some hundred MB.
BUCKETS = 16


def write_snapshots(spark: SparkSession, root: str, tables: dict[str, DataFrame], version: str, buckets: int = BUCKETS) -> None:
    """Write whole tables, in the place of those that may be there, all at once: one commit says all. A writer that dies leaves all of them as they were."""

    def work(t: Transaction) -> None:
        for name, df in tables.items():
            old = t.state.tables.get(name)
            keys = old.keys if old and set(old.keys) <= set(df.columns) else BUCKET_KEYS.get(name, df.columns[:1])
            t.create(name, df, keys, old.buckets if old else buckets, version)
        views.renew(t, tables)

    Log(spark, root).transact(work)


def write_snapshot(df: DataFrame, root: str, name: str, version: str, buckets: int = BUCKETS) -> None:
    write_snapshots(df.sparkSession, root, {name: df}, version, buckets)


def current_version(spark: SparkSession, root: str, name: str) -> str | None:
    """What the last writer of a table called its version; None for a table that was never written."""
    found = Log(spark, root).state().tables.get(name)
    return found.mark if found else None


def read_snapshot(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current state of a table; raises NoTable for one that was never written."""
    return Log(spark, root).state().read(name)


def bootstrap(spark: SparkSession, root: str, now: datetime.datetime, buckets: int = BUCKETS) -> None:
    """A new warehouse: all tables empty and typed, and the seed rows. Repositories and endpoints have one bucket, the others `buckets`."""
    repositories = seed_repositories(spark, now)
    seeds = {"repositories": repositories, "endpoints": seed_endpoints(spark, repositories, now)}
    Log(spark, root).transact(lambda t: [t.create(n, conform(seeds.get(n, empty_table(spark, n)), n), BUCKET_KEYS.get(n, ["id"]), 1 if n in seeds else buckets, "0") for n in SCHEMAS])


def verify(spark: SparkSession, root: str) -> dict[str, int]:
    """How many tables can be read, and how many enumerations there are."""
    tables = 0
    for name in SCHEMAS:
        with contextlib.suppress(NoTable):  # counted as missing
            tables += set(read_snapshot(spark, root, name).columns) == set(SCHEMAS[name].fieldNames())
    enumerations = {tuple(values) for columns in ENUMS.values() for values in columns.values()}
    return {"tables": tables, "enumerations": len(enumerations), "resource_types": len(RESOURCE_TYPE)}


def create_index(spark: SparkSession, root: str, name: str, dimensions: int, buckets: int = BUCKETS) -> None:
    """Drop a search index if it is there, and create it empty."""
    from sheafmill.operators.xml import DOCUMENT_SCHEMA

    schema = f"id string, doc {DOCUMENT_SCHEMA}, emb array<double>, _additional_metadata string, _repo string, _harvest_url string"
    write_snapshot(spark.createDataFrame([], schema).withMetadata("emb", {"dimension": dimensions}), root, name, "0", buckets)


def write_report(text: str, folder: str, now: datetime.datetime) -> str:
    """Save a report under its time stamp; returns the path."""
    path = f"{folder}/report_{now.strftime('%Y-%m-%d_%H-%M-%S')}.md"
    with open(path, "w") as out:
        out.write(text)
    return path
