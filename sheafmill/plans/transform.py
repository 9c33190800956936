"""The transformation of harvest events: normalise, validate, embed, and the changes to records, events and the index."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafmill.functions.documents import document_json, embedding_text, virtual_fields
from sheafmill.functions.scalars import make_id, record_id
from sheafmill.operators.embed import HashingEmbedder, embed
from sheafmill.operators.merge import delete_by_key, last_of_key, merge_errors, upsert_records
from sheafmill.operators.validate import validate
from sheafmill.operators.xml import normalize
from sheafmill.session import keep
from sheafmill.sources.tables import conform

KEY = ["endpoint_id", "record_identifier"]


@dataclass
class Change:
    """What a batch of events does: records to upsert, keys that are gone, messages of events, documents for the index."""

    records: DataFrame
    gone: DataFrame
    results: DataFrame
    documents: DataFrame


def transform(events: DataFrame, now: Column, make_embedder=HashingEmbedder, model: str = "hashing") -> Change:
    """events: of event_scan(). Of several events of a record the latest (date stamp, then id) counts."""
    latest = last_of_key(events, KEY, [F.col("datestamp").desc(), F.col("id").desc()])
    gone = latest.filter("is_deleted").select(*KEY)
    # Written once: a filter on the status of a lazy frame would be pushed below the parsing and repeat it for each rule.
    checked = keep(validate(normalize(events.filter("NOT is_deleted"))), "checked-events")
    results = checked.filter("status <> 'skipped'").select("id", "endpoint_id", "harvest_run_id", "record_identifier", "message")
    ok = checked.filter("status = 'ok'").join(latest.filter("NOT is_deleted").select("id"), "id", "left_semi")
    text = embedding_text(F.col("doc.titles"), F.col("doc.subjects"), F.col("doc.descriptions"))
    done = keep(embed(ok.withColumn("_text", text), "_text", make_embedder).drop("_text"), "embedded-events")
    # JSON text of the additional metadata is stored as a JSON string, like any other text
    body = document_json(F.col("doc"), {"_additional_metadata": _quoted(F.col("additional_metadata")), "_repo": _quoted(F.col("code")), "_harvest_url": _quoted(F.col("harvest_url"))})
    records = done.withColumns(
        {
            "id": record_id(F.col("endpoint_id"), F.col("record_identifier")),
            "resource_type": F.lit("Dataset"),
            "doi": F.col("doc.doi"),
            "url": F.col("doc.url"),
            "title": F.get(F.col("doc.titles"), F.lit(0))["title"],
            "metadata_format": F.lit("XML"),
            "metadata_protocol": F.lit("OAI-PMH"),
            "datacite_json": body,
            "embeddings": F.col("emb"),
            "embedding_model": F.lit(model),
            "version": F.lit(1),
            "opensearch_synced": F.lit(True),
            "opensearch_synced_at": now,
            "created_at": now,
            "updated_at": now,
        }
    )
    documents = done.select(F.struct("datestamp", F.col("id").alias("event_id")).alias("_order"), F.col("doc.id").alias("id"), "doc", "emb", F.col("additional_metadata").alias("_additional_metadata"), F.col("code").alias("_repo"), F.col("harvest_url").alias("_harvest_url"))
    return Change(conform(records, "records"), gone, results, documents)


def _quoted(text: Column) -> Column:
    """A JSON string of a text, or null."""
    return F.when(text.isNotNull(), F.regexp_extract(F.to_json(F.struct(text.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1))


def apply_to_records(records: DataFrame, change: Change, now: Column) -> DataFrame:
    return upsert_records(delete_by_key(records, change.gone, KEY), change.records, now)


def apply_to_events(events: DataFrame, change: Change) -> DataFrame:
    return merge_errors(events, change.results)


def apply_to_index(index: DataFrame, records: DataFrame, change: Change) -> DataFrame:
    """The index after the change. A deleted record's document goes by the id it was indexed under; of records with one document id the latest (date stamp, then event id) counts."""
    ids = records.join(change.gone, KEY, "left_semi").select(make_id(F.col("doi"), F.col("url")).alias("id"))
    fresh = last_of_key(change.documents, ["id"], [F.col("_order").desc()])
    kept = delete_by_key(delete_by_key(index, ids, ["id"]), fresh, ["id"])
    return kept.unionByName(fresh.select(index.columns))


def searchable(index: DataFrame) -> DataFrame:
    """The index with the virtual fields that searches run on."""
    return index.withColumns(virtual_fields("doc"))
