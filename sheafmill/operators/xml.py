"""XML records to normalised documents.

A record is parsed once, with an explicit schema in which everything repeatable is an array, so that one child and many look
alike. Every record gets a status: `ok`, `skipped` (no metadata or no known layout; not an error) or `error` with a message. A
malformed record fails alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafmill.functions.documents import drop_empty
from sheafmill.functions.scalars import make_id, normalize_date, normalize_lang

_RESOURCE = """struct<
  identifier: struct<_VALUE: string, _identifierType: string>,
  titles: struct<title: array<struct<_VALUE: string, _lang: string, _titleType: string>>>,
  subjects: struct<subject: array<struct<_VALUE: string, _lang: string, _subjectScheme: string, _schemeURI: string, _valueURI: string, _classificationCode: string>>>,
  creators: struct<creator: array<struct<
    creatorName: array<struct<_VALUE: string, _nameType: string>>, givenName: array<struct<_VALUE: string>>, familyName: array<struct<_VALUE: string>>,
    nameIdentifier: array<struct<_VALUE: string, _nameIdentifierScheme: string>>>>>,
  publicationYear: string,
  descriptions: struct<description: array<struct<_VALUE: string, _descriptionType: string, _lang: string>>>,
  dates: struct<date: array<struct<_VALUE: string, _dateType: string>>>,
  resourceType: struct<_VALUE: string, _resourceTypeGeneral: string>>"""
RECORD_SCHEMA = f"""struct<
  header: struct<identifier: string, datestamp: string>,
  metadata: struct<resource: {_RESOURCE}, oai_datacite: struct<payload: struct<resource: {_RESOURCE}>>>,
  _corrupt_record: string>""".replace("\n", " ")

DOCUMENT_SCHEMA = """struct<
  id: string, doi: string, url: string,
  titles: array<struct<title: string, lang: string, titleType: string>>,
  subjects: array<struct<subject: string, lang: string, subjectScheme: string, schemaUri: string, valueUri: string, classificationCode: string>>,
  creators: array<struct<creatorName: string, nameType: string, nameIdentifierScheme: string, nameIdentifier: string, givenName: string, familyName: string>>,
  publicationYear: string,
  descriptions: array<struct<description: string, descriptionType: string, lang: string>>,
  dates: array<struct<date: string, dateType: string>>,
  types: struct<resourceType: string, resourceTypeGeneral: string>>""".replace("\n", " ")

#: Text after a closing tag: mixed content, of which a parsed value would keep one piece only.
_MIXED = r"</(?:[A-Za-z0-9_]+:)?[A-Za-z0-9_]+>\s*[^<\s]"
#: Attributes on containers, which have no place in the document.
_CONTAINER = r"<(?:[A-Za-z0-9_]+:)?(?:titles|subjects|creators|creator|descriptions|dates)\s+(?!xmlns)[^>]*="


def parse(xml: Column) -> Column:
    """The parsed record; its _corrupt_record is not null if the text is no well-formed document."""
    return F.from_xml(xml, RECORD_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "ignoreNamespace": "true", "valueTag": "_VALUE", "attributePrefix": "_"})


def well_formed(xml: Column, parsed: Column) -> Column:
    """Whether the text is a well-formed document without a document type. parsed: its parse()."""
    return F.coalesce(xml.isNotNull() & parsed.isNotNull() & parsed["_corrupt_record"].isNull() & ~xml.rlike("<!DOCTYPE"), F.lit(False))


def header(parsed: Column) -> tuple[Column, Column]:
    """Identifier and date stamp; null where missing."""
    return parsed["header"]["identifier"], parsed["header"]["datestamp"]


def resource(parsed: Column) -> Column:
    """The resource, directly under the metadata or within the wrapper's payload."""
    return F.coalesce(parsed["metadata"]["resource"], parsed["metadata"]["oai_datacite"]["payload"]["resource"])


def identifier(res: Column, kind: str) -> Column:
    """The identifier's text if its type is this one."""
    return F.when(res["identifier"]["_identifierType"] == kind, res["identifier"]["_VALUE"])


def resource_type(res: Column) -> Column:
    """The resource type and the general one, null if there is no such element."""
    kind = res["resourceType"]
    return F.when(kind.isNotNull(), F.struct(kind["_VALUE"].alias("resourceType"), kind["_resourceTypeGeneral"].alias("resourceTypeGeneral")))


def titles(res: Column) -> Column:
    return F.transform(res["titles"]["title"], lambda x: F.struct(x["_VALUE"].alias("title"), normalize_lang(x["_lang"]).alias("lang"), x["_titleType"].alias("titleType")))


def subjects(res: Column) -> Column:
    def one(x: Column) -> Column:
        return F.struct(
            x["_VALUE"].alias("subject"), normalize_lang(x["_lang"]).alias("lang"), x["_subjectScheme"].alias("subjectScheme"), x["_schemeURI"].alias("schemaUri"), x["_valueURI"].alias("valueUri"), x["_classificationCode"].alias("classificationCode")
        )

    return F.transform(res["subjects"]["subject"], one)


def creators(res: Column) -> Column:
    def one(x: Column) -> Column:
        name, own = F.get(x["creatorName"], F.lit(0)), F.get(x["nameIdentifier"], F.lit(0))
        return F.struct(
            name["_VALUE"].alias("creatorName"),
            name["_nameType"].alias("nameType"),
            own["_nameIdentifierScheme"].alias("nameIdentifierScheme"),
            own["_VALUE"].alias("nameIdentifier"),
            F.get(x["givenName"], F.lit(0))["_VALUE"].alias("givenName"),
            F.get(x["familyName"], F.lit(0))["_VALUE"].alias("familyName"),
        )

    return F.transform(res["creators"]["creator"], one)


def descriptions(res: Column) -> Column:
    return F.transform(res["descriptions"]["description"], lambda x: F.struct(x["_VALUE"].alias("description"), x["_descriptionType"].alias("descriptionType"), normalize_lang(x["_lang"]).alias("lang")))


def dates(res: Column) -> Column:
    return F.transform(res["dates"]["date"], lambda x: F.struct(normalize_date(x["_VALUE"]).alias("date"), x["_dateType"].alias("dateType")))


def document(res: Column) -> Column:
    """The normalised document of a resource; empty lists are null."""
    doi, url = identifier(res, "DOI"), F.coalesce(identifier(res, "URL"), identifier(res, "URN"))
    return F.struct(
        make_id(doi, url).alias("id"),
        doi.alias("doi"),
        url.alias("url"),
        drop_empty(titles(res)).alias("titles"),
        drop_empty(subjects(res)).alias("subjects"),
        drop_empty(creators(res)).alias("creators"),
        res["publicationYear"].alias("publicationYear"),
        drop_empty(descriptions(res)).alias("descriptions"),
        drop_empty(dates(res)).alias("dates"),
        resource_type(res).alias("types"),
    ).cast(DOCUMENT_SCHEMA)


def normalization_error(xml: Column, res: Column) -> Column:
    """Why a resource can't be normalised, or null."""
    repeated = F.exists(res["creators"]["creator"], lambda c: (F.size(c["creatorName"]) > 1) | (F.size(c["givenName"]) > 1) | (F.size(c["familyName"]) > 1) | (F.size(c["nameIdentifier"]) > 1))
    bad_date = F.get(F.filter(res["dates"]["date"], lambda d: d["_VALUE"].isNotNull() & normalize_date(d["_VALUE"]).isNull()), F.lit(0))["_VALUE"]
    return F.coalesce(
        F.when(xml.rlike(_MIXED), F.lit("Mixed content is not supported")),
        F.when(xml.rlike(_CONTAINER), F.lit("Neither string nor dict")),
        F.when(F.coalesce(repeated, F.lit(False)), F.lit("Neither string nor dict")),
        F.when(bad_date.isNotNull(), F.concat(F.lit("Date "), bad_date, F.lit(" invalid"))),
    )


def normalize(events: DataFrame, xml: str = "raw_metadata") -> DataFrame:
    """events with rec_id, doc, status and message."""
    raw = F.col(xml)
    out = events.withColumn("_parsed", parse(raw)).withColumn("_resource", resource(F.col("_parsed")))
    ok, res = well_formed(raw, F.col("_parsed")), F.col("_resource")
    out = out.withColumn("_message", F.when(~ok, F.lit("Malformed XML")).when(res.isNotNull(), normalization_error(raw, res)))
    status = F.when(F.col("_message").isNotNull(), "error").when(res.isNull(), "skipped").otherwise("ok")
    return out.select(*events.columns, header(F.col("_parsed"))[0].alias("rec_id"), F.when(status == "ok", document(res)).alias("doc"), status.alias("status"), F.col("_message").alias("message"))
