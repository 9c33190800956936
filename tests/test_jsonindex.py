"""Containment over JSON documents against brute force."""

import json
import random

import pytest

from sheafmill.operators import jsonindex


def some(r, depth=0):
    kind = r.randrange(3 if depth < 3 else 1)
    if kind == 0:
        return r.choice([0, 1, 1.0, 2.5, -0.0, 1e-20, 2e-20, 12345678901234567890123, True, False, None, "a", "b", "", "1", "{", "z"])
    if kind == 1:
        return {k: some(r, depth + 1) for k in r.sample(["x", "y", "x.y", "[]", ""], r.randrange(4))}
    return [some(r, depth + 1) for _ in range(r.randrange(4))]


def holds(a, b, top=True):
    if isinstance(a, dict) and isinstance(b, dict):
        return all(k in a and holds(a[k], v, False) for k, v in b.items())
    if isinstance(a, list) and isinstance(b, list):
        return all(any(holds(x, y, False) for x in a) for y in b)
    if isinstance(a, list) and top and not isinstance(b, dict | list):
        return any(holds(x, b, False) for x in a)
    return isinstance(a, bool) == isinstance(b, bool) and not isinstance(a, dict | list) and not isinstance(b, dict | list) and a == b


def _documents():
    r = random.Random(4)
    return [some(r) for _ in range(300)] + [{"x": [{"x": 1, "y": "a"}, {"x": 2.5}]}, {"x": [{"x": 1}, {"y": "a"}]}, {"x": {"y": 1}}, {"x.y": 1}, {"[]": 1, "x": [1]}]


DOCUMENTS = _documents()


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rows = [(i, json.dumps(d)) for i, d in enumerate(DOCUMENTS)] + [(-1, None), (-2, ""), (-3, "{broken"), (-4, '{"x": 1, "x": 2}')]
    docs = spark.createDataFrame(rows, "id long, props string").repartition(3)
    return jsonindex.build(docs, "id", "props", str(tmp_path_factory.mktemp("json") / "index"), files=2)


@pytest.mark.parametrize("wanted", ['{"x": [{"x": 1, "y": "a"}]}', '{"x": {"y": 1.0}}', '{"x.y": 1}', "{}", "[]", '[1, "a"]', "1e0", '"a"', "null", "1e-20", "0", '{"x": []}', '[[1], {}]', "12345678901234567890123", '{"": true}', '{"x": "unknown"}'])
def test_containing(index, wanted):
    want = [i for i, d in enumerate(DOCUMENTS) if holds(d, json.loads(wanted))]
    assert sorted(r["key"] for r in index.containing(wanted).collect()) == want


def test_a_search_reads_few_rows(index):
    leaves, enough = jsonindex.asked({"x": [{"x": 1, "y": "a"}]})
    assert not enough and len(leaves) == 2 and jsonindex.asked({"x": [{"x": 1}], "y": {"x": 1, "y": 2}})[1]
    assert "PushedFilters: [Or(And(EqualTo(path" in index.candidates(leaves)._jdf.queryExecution().executedPlan().toString()


def test_empty_table(spark, tmp_path):
    index = jsonindex.build(spark.createDataFrame([], "id long, props string"), "id", "props", str(tmp_path / "index"))
    assert index.containing("{}").collect() == []


def test_ranges_follow_the_rows(spark, tmp_path, monkeypatch):
    """A range holds about so many rows however large the index is, and a search finds the same."""
    monkeypatch.setattr(jsonindex, "RANGE_ROWS", 100)
    docs = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(DOCUMENTS)], "id long, props string")
    index = jsonindex.build(docs, "id", "props", str(tmp_path / "index"))
    stored = spark.read.parquet(f"{tmp_path}/index/rows")
    sizes = [r["count"] for r in stored.groupBy(stored["_metadata.file_path"]).count().collect()]
    assert sum(sizes) > 800 and max(sizes) <= 200
    want = [i for i, d in enumerate(DOCUMENTS) if holds(d, {"x": {}})]
    assert sorted(r["key"] for r in index.containing('{"x": {}}').collect()) == want
