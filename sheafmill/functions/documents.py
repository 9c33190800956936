"""Functions of the normalised document: empty fields, embedding text, virtual search fields, JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def drop_empty(array: Column) -> Column:
    """Null for an empty array."""
    return F.when(F.size(array) > 0, array)


def subfields(array: Column, name: str) -> Column:
    """The values of a subfield; an empty array where the field is missing."""
    return F.coalesce(F.transform(array, lambda x: x[name]), F.array().cast("array<string>"))


def embedding_text(titles: Column, subjects: Column, descriptions: Column) -> Column:
    """Titles, subjects and descriptions, in this order, joined by spaces."""
    return F.array_join(F.concat(subfields(titles, "title"), subfields(subjects, "subject"), subfields(descriptions, "description")), " ")


def virtual_fields(doc: str = "doc") -> dict[str, Column]:
    """The columns that searches run on, from a document struct."""
    title, description = subfields(F.col(f"{doc}.titles"), "title"), subfields(F.col(f"{doc}.descriptions"), "description")
    creator, subject = subfields(F.col(f"{doc}.creators"), "creatorName"), subfields(F.col(f"{doc}.subjects"), "subject")
    return {
        "_title": title,
        "_description": description,
        "_creator": creator,
        "_subject": subject,
        "_all_fields": F.concat(title, description, creator, subject),
        "_date": F.transform(subfields(F.col(f"{doc}.dates"), "date"), lambda d: F.try_to_date(d, "yyyy-MM-dd")),
        "_resourceTypeGeneral": F.col(f"{doc}.types.resourceTypeGeneral"),
    }


def document_json(doc: Column, extra: dict[str, Column] | None = None) -> Column:
    """The document as JSON without its null fields, then extra fields (JSON text, null as null) and `"emb": null`."""
    body = F.to_json(doc, {"ignoreNullFields": "true"})
    tail = [F.concat(F.lit(f'"{k}":'), F.coalesce(v, F.lit("null"))) for k, v in (extra or {}).items()]
    joined = F.concat_ws(",", F.when(F.length(body) > 2, F.substr(body, F.lit(2), F.length(body) - 2)), *tail, F.lit('"emb":null'))
    return F.concat(F.lit("{"), joined, F.lit("}"))


def index_action(doc_id: Column, index: str, source: Column) -> Column:
    """The envelope of a bulk write: replace the document of this id."""
    return F.struct(F.lit("index").alias("_op_type"), doc_id.alias("_id"), F.lit(index).alias("_index"), source.alias("_source"))


def json_params(params: Column) -> dict[str, Column]:
    """Fields of an endpoint's harvest parameters; each is null where it is missing."""
    return {
        "metadata_prefix": F.get_json_object(params, "$.metadata_prefix"),
        "set": F.from_json(F.get_json_object(params, "$.set"), "array<string>"),
        "additional_metadata_params": F.from_json(F.get_json_object(params, "$.additional_metadata_params"), "struct<format string, endpoint string, protocol string>"),
    }
