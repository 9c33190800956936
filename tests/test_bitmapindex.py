"""Facets and filters by bitmaps against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sheafmill.operators import bitmapindex
from sheafmill.operators.bitmapindex import between, joined, one_of, pair, starting

SCHEMA = "id long, type string, tags array<string>, dates array<struct<kind: string, day: string>>"


def _documents():
    r = random.Random(11)
    out = []
    for i in range(500):
        dates = None if r.random() < 0.1 else [(r.choice(["Issued", "Valid", None]), r.choice([None, "1999", "2001", "2010"])) for _ in range(r.randrange(4))]
        tags = None if r.random() < 0.1 else [r.choice(["a", "b", "ab", None, ""]) for _ in range(r.randrange(4))]
        out.append((i, r.choice(["Text", "Dataset", "Image", None]), tags, dates))
    return out


DOCUMENTS = _documents()


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    docs = spark.createDataFrame(DOCUMENTS, SCHEMA).repartition(3)
    return bitmapindex.build(docs, "id", {"type": F.col("type"), "tags": F.col("tags"), "dates": pair("dates", "kind", "day")}, str(tmp_path_factory.mktemp("bitmaps") / "index"), files=2)


CASES = {
    "value": ([("type", one_of("Text", "Image"))], lambda t, tags, dates: t in ("Text", "Image")),
    "prefix": ([("tags", starting("a"))], lambda t, tags, dates: any(x is not None and x.startswith("a") for x in tags)),
    "nested": ([("dates", between(joined("Issued", "1999"), joined("Issued", "2001")))], lambda t, tags, dates: any(k == "Issued" and d in ("1999", "2001") for k, d in dates)),
    "three": ([("type", one_of("Text")), ("tags", one_of("b", "")), ("dates", one_of(joined("Valid", "2010")))], lambda t, tags, dates: t == "Text" and ("b" in tags or "" in tags) and ("Valid", "2010") in dates),
    "one field twice": ([("tags", one_of("a")), ("tags", one_of("b"))], lambda t, tags, dates: "a" in tags and "b" in tags),
    "none": ([("type", one_of("Text")), ("tags", one_of("unknown"))], lambda t, tags, dates: False),
    "no filter": ([], lambda t, tags, dates: True),
}


@pytest.mark.parametrize("name", CASES)
def test_filters_and_facets(index, name):
    filters, meets = CASES[name]
    want = [d for d in DOCUMENTS if meets(d[1], d[2] or [], d[3] or [])]
    assert sorted(r["key"] for r in index.keys(filters).collect()) == [d[0] for d in want] and index.count(filters) == len(want)
    counts = Counter(tag for d in want for tag in {x for x in d[2] or [] if x is not None})
    assert [(r["key"], r["doc_count"]) for r in index.facet("tags", filters, 3).collect()] == sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:3]


def test_empty_table(spark, tmp_path):
    index = bitmapindex.build(spark.createDataFrame([], SCHEMA), "id", {"type": F.col("type")}, str(tmp_path / "index"))
    assert index.facet("type", [("type", one_of("Text"))]).collect() == [] and index.keys([("type", one_of("Text"))]).collect() == [] and index.count([]) == 0


def test_a_filter_reads_its_field_only(index):
    rows = index.words("tags").filter("value = 'a'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(field" in plan and "EqualTo(value,a)" in plan
    assert all("/field=tags/" in r["file"] for r in rows.select(F.input_file_name().alias("file")).distinct().collect())
