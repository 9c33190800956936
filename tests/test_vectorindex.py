"""The approximate vector index against the exact search."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sheafmill.operators import search, vectorindex
from sheafmill.plans import catalogue

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 24))
    data = centres[rng.integers(0, 20, 3000)] + 0.7 * rng.normal(size=(3000, 24))
    data[1000:2000] = data[1000]  # a third of all rows is one vector
    rows = [(i, [float(x) for x in v], int(i % 4)) for i, v in enumerate(data)] + [(9001, None, 1), (9002, [None] * 24, 1), (9003, [float("nan")] * 24, 1), (9004, [0.0] * 24, 1)]
    return spark.createDataFrame(rows, "id long, v array<float>, kind int").repartition(5)


@pytest.fixture(scope="module")
def index(vectors, tmp_path_factory):
    return vectorindex.build(vectors, "id", "v", str(tmp_path_factory.mktemp("vectors") / "i"), ("kind",))


def test_every_row_is_indexed(index, vectors):
    assert index.vectors().count() == 3000 and sorted(index.vectors().columns) == ["cell", "code", "exact", "key", "unit", "with_kind"]
    assert index.recall >= vectorindex.TARGET and 1 <= index.probes <= len(index.centres) == 54


@pytest.mark.parametrize("where", [False, True])
def test_recall(index, vectors, where):
    found = whole = 0
    for row in vectors.filter("id < 1000 AND id % 100 = 7").collect():
        near = search.knn(vectors.filter("id < 3000"), row["v"], field="v", where=F.col("kind") >= 2 if where else None).collect()
        got = index.search(row["v"], where=F.col("with_kind") >= 2 if where else None).collect()
        scores = {r["key"]: r["score"] for r in got}
        found += sum(r["id"] in scores for r in near)
        whole += len(near)
        assert all(scores[r["id"]] == pytest.approx(r["score"]) for r in near if r["id"] in scores) and len(got) == 5
    assert found / whole >= 0.9


def test_a_search_reads_few_cells_and_codes_only(index):
    plan = index.vectors().filter(F.col("cell").isin(1, 2)).select("key", "code")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan and "exact" not in plan.split("ReadSchema")[1]


def test_query_recall_on_given_table(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = e.orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got: dict[int, set[int]] = {}
    for r in catalogue.queries()["knn_indexed"](spark, SF).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = whole = 0
    for i in np.flatnonzero(ids % 100 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        near = set(ids[np.lexsort((ids, -s))[:5]].tolist())
        hits, whole = hits + len(near & got[int(ids[i])]), whole + len(near)
    assert len(got) == (ids % 100 == 0).sum() and hits / whole >= 0.9


def test_empty(spark, tmp_path):
    none = spark.createDataFrame([], "id long, v array<float>")
    index = vectorindex.build(none, "id", "v", str(tmp_path / "i"))
    assert index.search([1.0, 2.0]).collect() == []
    assert index.search_all(none.select(F.col("id").alias("query_id"), F.col("v").alias("vector"))).collect() == []


@pytest.mark.parametrize("own", [False, True])
def test_parts_of_cells(own):
    """A part of a cell gives each query's best by codes, ties by key, as all pairs would."""
    rng = np.random.default_rng(8)
    codes, queries = rng.integers(-3, 4, (300, 6)).astype(np.int8), rng.normal(size=(150, 6))
    codes[50:200] = codes[50]  # copies
    rows = pd.DataFrame({"cell": 3, "key": rng.permutation(300), "code": list(codes)})
    asked = pd.DataFrame({"cell": 3, "query_id": np.arange(150), "q": list(queries)})
    got = vectorindex._best_by_codes(10, own)(asked, rows)
    for i, q in enumerate(queries):
        want = sorted((-round(float(c @ q), 6), k) for k, c in zip(rows["key"], codes.astype(float)) if own or k != i)[:10]
        assert [(-s, k) for s, k in zip(got["rough"][got["query_id"] == i], got["key"][got["query_id"] == i])] == [(pytest.approx(s, abs=2e-6), k) for s, k in want]
