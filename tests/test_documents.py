"""Scalars, XML, validation and the functions of documents."""

import json

import pytest
from pyspark.sql import functions as F

from sheafmill.functions import documents as d
from sheafmill.functions import scalars as s
from sheafmill.operators import embed, validate, xml

DATES = {
    "2025-04-03": "2025-04-03", "2025-04": "2025-04-01", "2025": "2025-01-01", "2019-6-01": "2019-06-01", "2019-07-5": "2019-07-05", "2019-7-9": "2019-07-09",
    "2022-12-07T15:16:24+01:00": "2022-12-07", "2025/2026": "2025-01-01", "2025-08-05 09:35:06": "2025-08-05", "202-05-29": "202-05-29", "22-04-24": "22-04-24",
    "n.d.": "n.d.-01-01", "2019-13": "2019-13-01", "2025-02-30": None, "2025-02-30T1": None, "": None, "abc": None, "25": "25-01-01", "2025-1-1-x": None, "0000-01-01": None, "2025-2-29": None, None: None,
}


def test_scalars(spark):
    rows = spark.createDataFrame([(x,) for x in DATES], "x string")
    assert {r[0]: r[1] for r in rows.select("x", s.normalize_date(F.col("x"))).collect()} == DATES
    rows = spark.createDataFrame([("eng", "en"), ("en", "en"), ("EN", "EN"), ("x", "x"), (None, None)], "x string, y string")
    assert all(r[0] == r[1] for r in rows.select(s.normalize_lang(F.col("x")), "y").collect())
    rows = spark.createDataFrame([("10.123/123", None, "https://doi.org/10.123/123"), (None, "u", "u"), ("a", "u", "https://doi.org/a"), (None, None, None)], "d string, u string, w string")
    assert all(r[0] == r[1] for r in rows.select(s.make_id(F.col("d"), F.col("u")), "w").collect())
    row = spark.sql("SELECT timestamp'2025-01-02 03:04:05.678' AS t, 1 AS a, 0 AS z").select(s.format_timestamp(F.col("t")), s.percent_of(F.col("a"), F.lit(3), 2), s.percent_of(F.col("a"), F.col("z"), 2)).first()
    assert tuple(row) == ("2025-01-02 03:04:05.678000+0000", 33.33, None)
    assert spark.sql("SELECT 'Été, x-1  Y' AS t").select(s.terms(F.col("t"))).first()[0] == ["été", "x", "1", "y"]


def record(resource, wrap=False):
    inner = f'<oai_datacite xmlns="http://schema.datacite.org/oai/oai-1.1/"><payload>{resource}</payload></oai_datacite>' if wrap else resource
    return f'<record xmlns="http://www.openarchives.org/OAI/2.0/"><header><identifier>oai:1</identifier><datestamp>2025-01-01T00:00:00Z</datestamp></header><metadata>{inner}</metadata></record>'


def resource(**parts):
    parts = {
        "identifier": '<identifier identifierType="DOI">10.1/a</identifier>',
        "creators": '<creators><creator><creatorName nameType="Personal">N</creatorName><nameIdentifier nameIdentifierScheme="ORCID">0</nameIdentifier></creator><creator><creatorName>M</creatorName></creator></creators>',
        "titles": '<titles><title xml:lang="eng">T &amp; U</title><title titleType="Subtitle">S</title></titles>',
        "publicationYear": "<publicationYear>2024</publicationYear>",
        "subjects": '<subjects><subject subjectScheme="x" schemeURI="u" valueURI="v" classificationCode="c" xml:lang="de">sub</subject></subjects>',
        "dates": '<dates><date dateType="Issued">2024-5</date></dates>',
        "descriptions": '<descriptions><description descriptionType="Abstract">D</description></descriptions>',
        "resourceType": '<resourceType resourceTypeGeneral="Dataset">Data</resourceType>',
    } | parts
    return '<resource xmlns="http://datacite.org/schema/kernel-4">' + "".join(parts.values()) + "</resource>"


CASES = {
    "plain": (record(resource()), "ok", None),
    "wrapped": (record(resource(), True), "ok", None),
    "prefixed": (record(resource()).replace("<record xmlns=", "<oai:record xmlns:oai=").replace("</record>", "</oai:record>"), "ok", None),
    "malformed": (record(resource())[:-5], "error", "Malformed XML"),
    "null": (None, "error", "Malformed XML"),
    "empty": ("", "error", "Malformed XML"),
    "doctype": ("<!DOCTYPE a [<!ENTITY b 'c'>]>" + record(resource()), "error", "Malformed XML"),
    "no resource": (record("<other/>"), "skipped", None),
    "no metadata": ("<record><header><identifier>a</identifier></header></record>", "skipped", None),
    "bad date": (record(resource(dates='<dates><date dateType="Issued">2024-02-31</date></dates>')), "error", "Date 2024-02-31 invalid"),
    "short year": (record(resource(dates='<dates><date dateType="Issued">202-05-29</date></dates>')), "error", "'202-05-29' does not match '^[0-9]{4}-[0-9]{2}-[0-9]{2}$'"),
    "mixed": (record(resource(titles="<titles><title>a<i>b</i>c</title></titles>")), "error", "Mixed content is not supported"),
    "container": (record(resource(titles='<titles a="b"><title>a</title></titles>')), "error", "Neither string nor dict"),
    "two name ids": (record(resource(creators="<creators><creator><creatorName>N</creatorName><nameIdentifier>1</nameIdentifier><nameIdentifier>2</nameIdentifier></creator></creators>")), "error", "Neither string nor dict"),
    "empty title": (record(resource(titles="<titles><title/></titles>")), "error", "'title' is a required property"),
    "no creators": (record(resource(creators="")), "error", "'creators' is a required property"),
    "other id": (record(resource(identifier='<identifier identifierType="ARK">x</identifier>')), "error", "'id' is a required property"),
    "big lang": (record(resource(titles='<titles><title xml:lang="EN">a</title></titles>')), "error", "'EN' does not match '^[a-z]{2}$'"),
    "year": (record(resource(publicationYear="<publicationYear>24</publicationYear>")), "error", "'24' does not match '^[0-9]{4}$'"),
    "no type": (record(resource(resourceType="")), "error", "'types' is a required property"),
    "no general type": (record(resource(resourceType="<resourceType>x</resourceType>")), "error", "'resourceTypeGeneral' is a required property"),
    "no date type": (record(resource(dates="<dates><date>2024</date></dates>")), "error", "'dateType' is a required property"),
    "no description type": (record(resource(descriptions="<descriptions><description>x</description></descriptions>")), "error", "'descriptionType' is a required property"),
}


@pytest.fixture(scope="module")
def checked(spark):
    rows = spark.createDataFrame([(k, v[0]) for k, v in CASES.items()], "name string, raw_metadata string")
    return validate.validate(xml.normalize(rows)).cache()


def test_status_and_message(checked):
    assert {r["name"]: (r["status"], r["message"]) for r in checked.collect()} == {k: v[1:] for k, v in CASES.items()}


def test_document(checked):
    docs = {r["name"]: r["doc"] for r in checked.filter("status = 'ok'").collect()}
    assert docs["plain"] == docs["wrapped"] == docs["prefixed"]
    doc = docs["plain"].asDict(recursive=True)
    assert doc["id"] == "https://doi.org/10.1/a" and doc["url"] is None and doc["publicationYear"] == "2024"
    assert doc["titles"] == [{"title": "T & U", "lang": "en", "titleType": None}, {"title": "S", "lang": None, "titleType": "Subtitle"}]
    assert doc["creators"][0] == {"creatorName": "N", "nameType": "Personal", "nameIdentifierScheme": "ORCID", "nameIdentifier": "0", "givenName": None, "familyName": None}
    assert doc["subjects"] == [{"subject": "sub", "lang": "de", "subjectScheme": "x", "schemaUri": "u", "valueUri": "v", "classificationCode": "c"}]
    assert doc["dates"] == [{"date": "2024-05-01", "dateType": "Issued"}] and doc["types"] == {"resourceType": "Data", "resourceTypeGeneral": "Dataset"}


def test_functions(spark, checked):
    row = checked.filter("name = 'plain'")
    text = d.embedding_text(F.col("doc.titles"), F.col("doc.subjects"), F.col("doc.descriptions"))
    body = d.document_json(F.col("doc"), {"_additional_metadata": F.lit(None).cast("string")})
    out = row.select(text, body, *d.virtual_fields().values()).first()
    assert out[0] == "T & U S sub D"
    parsed = json.loads(out[1])
    assert parsed["emb"] is None and parsed["_additional_metadata"] is None and "url" not in parsed and parsed["titles"][1] == {"title": "S", "titleType": "Subtitle"}
    assert out[2] == ["T & U", "S"] and out[6] == ["T & U", "S", "D", "N", "M", "sub"] and str(out[7][0]) == "2024-05-01" and out[8] == "Dataset"
    params = spark.createDataFrame([('{"metadata_prefix": "p", "set": ["a", "b"], "additional_metadata_params": {"format": "f", "endpoint": "e", "protocol": "x"}}',), ("{}",)], "p string")
    got = params.select(*d.json_params(F.col("p")).values()).collect()
    assert got[0][0] == "p" and got[0][1] == ["a", "b"] and got[0][2]["endpoint"] == "e" and list(got[1]) == [None] * 3


def test_embed(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, None), (3, "a b"), (4, "")], "id int, t string")
    got = {r["id"]: r["emb"] for r in embed.embed(rows, "t").collect()}
    assert got[1] == got[3] and len(got[1]) == embed.DIMENSIONS and abs(sum(x * x for x in got[1]) - 1) < 1e-9 and got[2] is None and set(got[4]) == {0.0}
    with pytest.raises(Exception, match="another number of vectors"):
        embed.embed(rows, "t", lambda: lambda texts: []).collect()
