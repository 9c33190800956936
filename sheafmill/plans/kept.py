"""Queries over views that followed changes of their tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill.plans import changes, views
from sheafmill.plans.catalogue import _read, query
from sheafmill.plans.roles import role, with_roles
from sheafmill.session import shared_root
from sheafmill.sources.commits import Log

_KEYS = ["endpoint_id", "record_identifier"]

_RECORDS = """n AS (SELECT CAST(n_nationkey AS VARCHAR) AS endpoint_id, CAST(n_regionkey AS VARCHAR) AS repository_id, n_nationkey FROM nation),
  base AS (SELECT doc_id, lang AS resource_type, CASE WHEN lang = 'en' THEN '10.1/' || CAST(n_chars % 50 AS VARCHAR) END AS doi, source <> 'src0' AS synced, n_chars AS updated_at FROM documents),
  more AS (SELECT doc_id, 'Text' AS resource_type, '10.1/' || CAST(doc_id % 9 AS VARCHAR) AS doi, false AS synced, CAST(5 AS BIGINT) AS updated_at FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING max(quality) = 1),
  merged AS (SELECT coalesce(b.doc_id, m.doc_id) AS doc_id, coalesce(m.resource_type, b.resource_type) AS resource_type, CASE WHEN m.doc_id IS NULL THEN b.doi ELSE m.doi END AS doi, coalesce(b.synced, m.synced) AS opensearch_synced,
    coalesce(m.updated_at, b.updated_at) AS updated_at FROM base b FULL JOIN more m ON b.doc_id = m.doc_id),
  records AS (SELECT * FROM merged JOIN n ON n_nationkey = doc_id % 25 WHERE n_nationkey <> 3 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL))"""


def _placed(spark, sf_dir, rows: DataFrame) -> DataFrame:
    """rows (doc_id, resource_type, doi, opensearch_synced, updated_at) as records of endpoints."""
    nation = _read(spark, sf_dir, "nation").select((F.col("n_nationkey")).alias("_n"), F.col("n_nationkey").cast("string").alias("endpoint_id"), F.col("n_regionkey").cast("string").alias("repository_id"))
    key = F.col("doc_id").cast("string")
    return rows.join(nation, F.col("doc_id") % 25 == F.col("_n")).select(key.alias("id"), "endpoint_id", "repository_id", key.alias("record_identifier"), "resource_type", "doi", "opensearch_synced", "updated_at")


def _changed(spark, sf_dir) -> Log:
    """A warehouse whose views saw records updated, added and deleted, events added, and an endpoint deleted with all that refers to it."""
    log = Log(spark, f"{shared_root(spark)}/warehouse-{uuid.uuid4().hex}")
    docs = _read(spark, sf_dir, "documents")
    doi = F.when(F.col("lang") == "en", F.concat(F.lit("10.1/"), (F.col("n_chars") % 50).cast("string")))
    base = _placed(spark, sf_dir, docs.select("doc_id", F.col("lang").alias("resource_type"), doi.alias("doi"), (F.col("source") != "src0").alias("opensearch_synced"), F.col("n_chars").alias("updated_at")))
    labels = _read(spark, sf_dir, "labels").filter("doc_id IS NOT NULL")
    good = labels.groupBy("doc_id").agg(F.max("quality").alias("quality")).filter("quality = 1")
    more = _placed(spark, sf_dir, good.select("doc_id", F.lit("Text").alias("resource_type"), F.concat(F.lit("10.1/"), (F.col("doc_id") % 9).cast("string")).alias("doi"), F.lit(False).alias("opensearch_synced"), F.lit(5).cast("long").alias("updated_at")))
    gone = _placed(spark, sf_dir, labels.filter("toxic = 1").select("doc_id", *(F.lit(None).alias(c) for c in ("resource_type", "doi", "opensearch_synced", "updated_at"))))
    events = role(spark, sf_dir, "harvest_events")
    first, later = events.filter("NOT is_deleted"), events.filter("is_deleted")

    def start(t):
        t.create("repositories", role(spark, sf_dir, "repositories"), ["id"], 1)
        t.create("endpoints", role(spark, sf_dir, "endpoints"), ["id"], 1)
        t.create("harvest_events", first, changes.EVENT_KEY, 8)
        t.create("records", base, _KEYS, 8)
        views.create(t, 8)

    def add(t):
        t.append("harvest_events", later)
        views.follow(t, "harvest_events", None, later)

    log.transact(start)
    log.transact(lambda t: changes.upsert(t, "records", more, _KEYS, ["resource_type", "doi", "updated_at"]))
    log.transact(lambda t: changes.delete(t, "records", gone, _KEYS))
    log.transact(add)
    log.transact(lambda t: changes.delete_cascade(t, "endpoints", spark.createDataFrame([("3",)], "id string")))
    return log


@query(with_roles("endpoints", "repositories", more=_RECORDS, sql="""SELECT r.name AS repository_name, e.name AS endpoint_name, rec.resource_type, count(*) AS record_count, count(DISTINCT rec.doi) AS unique_dois,
    count(CASE WHEN rec.opensearch_synced THEN 1 END) AS synced_count, max(rec.updated_at) AS last_updated
    FROM records rec JOIN endpoints e ON rec.endpoint_id = e.id JOIN repositories r ON rec.repository_id = r.id GROUP BY r.name, e.name, rec.resource_type"""))
def statistics_kept_up(spark, sf_dir):
    """Statistics of records after changes, from the view alone."""
    return views.records_statistics(_changed(spark, sf_dir).state())


@query(with_roles("harvest_events", "endpoints", "repositories", sql="""SELECT e.name AS endpoint_name, r.name AS repository_name, count(*) AS event_count
    FROM harvest_events he JOIN endpoints e ON he.endpoint_id = e.id JOIN repositories r ON he.repository_id = r.id WHERE e.id <> '3' GROUP BY e.name, r.name"""))
def events_kept_up(spark, sf_dir):
    return views.events_summary(_changed(spark, sf_dir).state())
