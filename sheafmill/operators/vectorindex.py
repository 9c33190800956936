"""An approximate index of vectors: trained cells, scalar-quantised codes, exact rescoring.

Cells are the centres of k-means over a bounded sample of unit vectors; every row is stored in the folder of its nearest centre, with a code of one byte a component beside its exact vector. A search reads the
folders of the cells nearest to its vector (the codes and what it filters on, no exact vectors), takes the best REFINE times k by their codes, and rescores those by their exact vectors. How many cells that is, is measured when
the index is built: the least number that finds TARGET of the true neighbours of PROBE_QUERIES rows, which are searched exactly for it in one pass.

Cosine is meant throughout. Null vectors, vectors with null or non-finite components, of another length than the first, or of length zero are not indexed. A filter applies before the search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafmill.operators.search import TOP_K, cosine
from sheafmill.session import Scratch, keep, ship_package

#: Rows that the centres are trained on, and how many centres there are, at most.
SAMPLE = 50_000
MOST_CELLS = 256
#: Rows whose true neighbours say how many cells to look into, and the share of them that has to be found.
PROBE_QUERIES = 64
TARGET = 0.95
#: How many times k rows are rescored.
REFINE = 8
CODE = 127
#: Rows, and queries, of one cell that a task compares at once, about, and queries of one product of matrices.
CELL_ROWS = 20_000
CELL_QUERIES = 4_096
TILE = 128


def unit(vector: Column) -> Column:
    """A vector of length 1, in double precision; null for what can't be one."""
    v = vector.cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))  # null if a component is null
    each = lambda n: F.when((n > 0) & (n < float("inf")), F.transform(v, lambda x: x / n))
    return F.get(F.transform(F.array(norm), each), F.lit(0))  # a lambda's variable is worked out once, not for each component


def build(docs: DataFrame, key: str, vector: str, path: str, keep_columns: tuple[str, ...] = (), k: int = TOP_K, cells: int | None = None) -> VectorIndex:
    """Index docs (unique keys) under a new folder. keep_columns: what searches may filter on."""
    spark = docs.sparkSession
    ship_package(spark)
    with Scratch(spark) as scratch:
        extra = [F.col(c).alias(f"with_{c}") for c in keep_columns]
        rows = scratch.keep(docs.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("exact"), unit(F.col(vector)).alias("unit"), *extra).filter("unit IS NOT NULL"), "unit-vectors")
        first = rows.select(F.size("unit").alias("n")).first()
        if first is None:
            rows.withColumn("code", F.array().cast("array<tinyint>")).withColumn("cell", F.lit(0)).coalesce(1).write.parquet(f"{path}/vectors")
            spark.createDataFrame([], "cell int, centre array<double>, scale double, probes int, recall double").write.parquet(f"{path}/cells")
            return VectorIndex(spark, path)
        rows = rows.filter(F.size("unit") == first["n"])
        n, scale = rows.agg(F.count("*"), F.max(F.array_max(F.transform("unit", F.abs)))).first()
        sample = rows.orderBy(F.xxhash64("key"), "key").limit(SAMPLE)
        trained = scratch.keep(sample.select(array_to_vector("unit").alias("features"), "unit"), "vector-sample")
        model = KMeans(k=cells or min(MOST_CELLS, max(1, int(n**0.5))), maxIter=10, seed=7).fit(trained)
        centres = np.array(model.clusterCenters())
        coded = F.transform("unit", lambda x: F.round(x * (CODE / scale)).cast("tinyint"))
        placed = model.setPredictionCol("cell").transform(rows.withColumn("features", array_to_vector("unit"))).drop("features").withColumn("code", coded)
        placed.hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{path}/vectors")  # cells of any size: Spark splits large ones
        stored = spark.read.parquet(f"{path}/vectors")
        probes, recall = measured(stored, centres, k)
    table = [(i, c.tolist(), float(scale), probes, recall) for i, c in enumerate(centres)]  # MOST_CELLS rows
    spark.createDataFrame(table, "cell int, centre array<double>, scale double, probes int, recall double").coalesce(1).write.parquet(f"{path}/cells")
    return VectorIndex(spark, path)


def measured(stored: DataFrame, centres: np.ndarray, k: int) -> tuple[int, float]:
    """How many of the nearest cells hold TARGET of the k true neighbours of PROBE_QUERIES rows, and the share that they hold."""
    asked = stored.orderBy(F.xxhash64("key", F.lit(1)), "key").limit(PROBE_QUERIES).select("key", "unit").collect()  # so many rows
    keys, queries = np.array([r["key"] for r in asked]), np.array([r["unit"] for r in asked])

    def best(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            scores = np.stack(part["unit"].to_numpy()) @ queries.T
            scores[part["key"].to_numpy()[:, None] == keys[None, :]] = -np.inf  # a row is no neighbour of its own
            top = np.argsort(-scores, axis=0, kind="stable")[:k]
            query = np.tile(np.arange(len(keys)), len(top))
            yield pd.DataFrame({"query": query, "cell": part["cell"].to_numpy()[top.ravel()], "score": scores[top.ravel(), query]})

    found = stored.select("key", "unit", "cell").mapInPandas(best, "query int, cell int, score double").filter(F.col("score") > float("-inf"))
    top = found.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(F.struct("score", "cell")), asc=False), 1, k).alias("top")).collect()  # k for each batch of rows, of so many queries
    rank = np.argsort(np.argsort(((queries[:, None, :] - centres[None]) ** 2).sum(axis=2), axis=1, kind="stable"), axis=1)
    at = np.sort([rank[r["query"], t["cell"]] for r in top for t in r["top"]])
    if not len(at):
        return 1, 1.0
    probes = int(at[max(0, int(np.ceil(TARGET * len(at))) - 1)]) + 1
    return probes, float((at < probes).mean())


def _best_by_codes(most: int, own: bool):
    """The rows that each query of a part of a cell is most similar to by their codes, ties by key."""

    def run(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or rows.empty:
            return pd.DataFrame({"query_id": asked["query_id"][:0], "cell": asked["cell"][:0], "key": rows["key"][:0], "rough": np.empty(0)})
        rows = rows.sort_values("key", ignore_index=True)
        codes, queries = np.stack(rows["code"].to_numpy()).astype(np.float64), np.stack(asked["q"].to_numpy())
        keys, ids, found, scores = rows["key"].to_numpy(), asked["query_id"].to_numpy(), [], []
        for start in range(0, len(ids), TILE):
            rough = np.round(queries[start : start + TILE] @ codes.T, 6)  # equal codes have equal scores
            if not own:
                rough[ids[start : start + TILE, None] == keys[None, :]] = -np.inf
            least = np.partition(rough, -most, axis=1)[:, -most] if len(keys) > most else np.full(len(rough), -np.inf)
            for i, row in enumerate(rough):
                top = np.flatnonzero((row >= least[i]) & (row > -np.inf))
                top = top[np.argsort(-row[top], kind="stable")[:most]]
                found.append(top)
                scores.append(row[top])
        return pd.DataFrame({"query_id": np.repeat(ids, [len(x) for x in found]), "cell": asked["cell"].iloc[0], "key": keys[np.concatenate(found)], "rough": np.concatenate(scores)})

    return run


class VectorIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        rows = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()  # MOST_CELLS rows
        self.centres = np.array([r["centre"] for r in rows])
        self.scale, self.probes, self.recall = (rows[0]["scale"], rows[0]["probes"], rows[0]["recall"]) if rows else (1.0, 0, 1.0)

    def vectors(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/vectors")

    def search(self, vector: list[float], k: int = TOP_K, where: Column | None = None, probes: int | None = None) -> DataFrame:
        """(key, score) of about the k rows most similar to a vector: exact scores of the best by their codes, in the nearest cells. where: on columns with_<name>."""
        q = np.asarray(vector, dtype=float)
        norm = np.linalg.norm(q)
        none = self.vectors().select("key", F.lit(0.0).alias("score")).limit(0)
        if not len(self.centres) or not np.isfinite(norm) or norm == 0:
            return none
        near = np.argsort(((self.centres - q / norm) ** 2).sum(axis=1), kind="stable")[: probes or self.probes]
        rows = self.vectors().filter(F.col("cell").isin([int(c) for c in near]))
        rows = rows if where is None else rows.filter(where)
        query = F.array(*(F.lit(float(x)) for x in q / norm))
        rough = F.aggregate(F.zip_with("code", query, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        keys = [r["key"] for r in rows.select("key", rough.alias("rough")).orderBy(F.col("rough").desc(), "key").limit(REFINE * k).collect()]  # so many rows
        exact = F.array(*(F.lit(float(x)) for x in vector))
        return rows.filter(F.col("key").isin(keys)).select("key", cosine(F.col("exact"), exact).alias("score")).orderBy(F.col("score").desc(), "key").limit(k)

    def search_all(self, queries: DataFrame, k: int = TOP_K, own: bool = False) -> DataFrame:
        """(query_id, rank, key, score) of many vectors (query_id, vector): each is compared with the rows of its nearest cells, cut into parts of bounded size that meet by cell. own: whether a row with the query's id may be found."""
        if not len(self.centres):
            return self.vectors().selectExpr("key AS query_id", "0 AS rank", "key", "0D AS score").limit(0)
        centres = F.array(*(F.array(*(F.lit(float(x)) for x in c)) for c in self.centres))
        asked = queries.select("query_id", F.col("vector").cast("array<double>").alias("vector"), unit(F.col("vector")).alias("q")).filter("q IS NOT NULL")

        def apart(c: Column, q: Column) -> Column:
            return F.aggregate(F.zip_with(c, q, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)

        ranked = F.slice(F.array_sort(F.transform(centres, lambda c, i: F.struct(apart(c, F.col("q")).alias("d"), i.alias("cell")))), 1, self.probes)
        spots = keep(asked.select("query_id", "q", F.explode(F.transform(ranked, lambda x: x["cell"])).alias("cell")), "query-cells")
        codes = self.vectors().select("cell", "key", "code")

        def parts(rows: DataFrame, most: int) -> int:
            return -(-(rows.groupBy("cell").count().agg(F.max("count")).first()[0] or 1) // most)

        n, m = parts(codes, CELL_ROWS), parts(spots, CELL_QUERIES)
        spots = spots.withColumn("asked", F.pmod(F.xxhash64("query_id"), F.lit(m))).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        codes = codes.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(n))).withColumn("asked", F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
        at = ["cell", "part", "asked"]
        spots, codes = (x.withColumns({c: F.col(c).cast("int") for c in at}) for x in (spots, codes))
        schema = f"query_id {queries.schema['query_id'].dataType.simpleString()}, cell int, key {self.vectors().schema['key'].dataType.simpleString()}, rough double"
        best = spots.groupBy(*at).cogroup(codes.groupBy(*at)).applyInPandas(_best_by_codes(REFINE * k, own), schema)
        from pyspark.sql import Window

        place = lambda order: F.row_number().over(Window.partitionBy("query_id").orderBy(*order))  # noqa: E731  groups are cut to the limit before the shuffle
        best = best.withColumn("place", place([F.col("rough").desc(), "key"])).filter(F.col("place") <= REFINE * k)
        exact = best.join(self.vectors().select("cell", "key", "exact"), ["cell", "key"]).join(asked.select("query_id", "vector"), "query_id")
        return exact.select("query_id", "key", cosine(F.col("exact"), F.col("vector")).alias("score")).withColumn("rank", place([F.col("score").desc(), "key"])).filter(F.col("rank") <= k).select("query_id", "rank", "key", "score")
