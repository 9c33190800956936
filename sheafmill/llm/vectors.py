"""Exact top-k search with vector-approximation files.

Scores are integer inner products of vectors floor(256 * x). (1) Vectors are gathered into blocks where they are read, without a shuffle, and
each block is written as one file into the shared folder: its distinct exact vectors, their ids, and approximations, one
byte for each component: the number of the cell that it is in. Cells of a dimension hold about equally many vectors; their
lowest and highest components are kept. (2) Queries are written as files of packed vectors. (3) One task for each block scans its
approximations for every query: cell ends give a lower and an upper bound of each score. What k others certainly beat is
out; of the rest, exact vectors are read from the file at their places, largest upper bound first, until the k-th best score read is certain.
A share of the blocks, picked by hash, is searched first; the k-th best score that a query has there is its threshold, and the other blocks read and report only what
reaches it. So what is read and shuffled for a query follows k and the share, not the number of blocks. A window ranks the rows that are reported for a query. (Largest
inner product for smallest distance: an upper bound of the score plays the lower bound of the distance.)

A task holds one block (bounded in components) and a step of queries, however many rows there are; equal vectors of a block are one
entry with many ids. Blocks are dealt out evenly, one to a task. What goes to the driver is a row for each query file.

Defined cases: vectors that are null, empty or hold a null or a non-finite component, and rows without id, take no part; vectors of another
dimension than the query's are no candidates; ties go to the smaller id; repeated rows are candidates each, except rows with the
query's own id; of query rows with one id the smallest vector is answered, once; components and scores beyond 64 bits count as
the nearest 64-bit number; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafmill.llm.common import Scratch, keep, spread, text_session
from sheafmill.llm.files import File, write_arrays

K = 5
QUERY_EVERY = 50
SCALE = 256
#: Components of a block of vectors, and of a file of queries.
BLOCK_COMPONENTS = 1 << 21
QUERY_COMPONENTS = 1 << 22
#: Cells of a dimension.
CELLS = 64
#: One block in so many is searched first, for thresholds (of few blocks, one in four or two).
FIRST_SHARE = 16
#: Bounds held at once (queries times vectors), and exact vectors read in one step.
BOUNDS = 1 << 20
READ_STEP = 32
LONG = np.iinfo(np.int64)


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): v is floor(256 * x) of the vectors that take part."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    usable = F.coalesce(F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))), F.lit(False))
    rows = vectors.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & usable)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * SCALE)).alias("v"))


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of one dimension each, of about `most` components."""
    held: dict[int, list] = {}
    size: dict[int, int] = {}

    def flush(d):
        size.pop(d)
        ids, vectors = zip(*held.pop(d))
        return np.concatenate(ids), np.concatenate(vectors)

    for batch in batches:
        ids, v = batch.column(0).to_numpy(), batch.column(1)
        start, values = v.offsets.to_numpy().astype(np.int64), v.values.to_numpy()
        lengths = np.diff(start)
        for d in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == d)
            held.setdefault(d, []).append((ids[rows], values[start[rows][:, None] + np.arange(d)]))
            size[d] = size.get(d, 0) + d * len(rows)
            if size[d] >= most:
                yield flush(d)
        while sum(size.values()) >= 2 * most:
            yield flush(max(size, key=size.get))
    while size:
        yield flush(next(iter(size)))


def approximate(exact: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cells, lowest, highest): the cell of each component, and for each dimension the lowest and highest component of each cell."""
    n, d = exact.shape
    cells, low, high = np.empty((n, d), dtype=np.uint8), np.zeros((d, CELLS), dtype=np.int64), np.zeros((d, CELLS), dtype=np.int64)
    places = (np.arange(1, CELLS + 1) * n + CELLS - 1) // CELLS - 1
    for j in range(d):
        column = np.sort(exact[:, j])
        values = np.unique(column)
        ends = values if len(values) <= CELLS else np.unique(column[places])
        starts = values[np.concatenate([[0], np.searchsorted(values, ends[:-1], side="right")])]
        low[j, : len(ends)], high[j, : len(ends)] = starts, ends
        cells[:, j] = np.searchsorted(ends, exact[:, j])
    return cells, low, high


def _write_blocks(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, exact in gathered(batches, BLOCK_COMPONENTS):
            d = exact.shape[1]
            order = np.argsort(ids, kind="stable")
            ids, exact = ids[order], np.ascontiguousarray(exact[order], dtype="<i8")
            _, at, place = np.unique(exact.view(f"V{8 * d}").ravel(), return_index=True, return_inverse=True)
            distinct = exact[at]
            group = np.argsort(place, kind="stable")
            first = np.searchsorted(place[group], np.arange(len(at) + 1)).astype("<i8")
            cells, low, high = approximate(distinct)
            uri = write_arrays(root, [distinct, ids[group].astype("<i8"), first, low.astype("<i8"), high.astype("<i8"), cells])
            yield pa.RecordBatch.from_pylist([{"uri": uri, "d": d, "n": len(ids), "u": len(at)}], pa.schema([("uri", pa.string()), ("d", pa.int32()), ("n", pa.int64()), ("u", pa.int64())]))

    return run


def _write_queries(root: str):
    """Files of queries: ids, thresholds, vectors. A vector comes with its threshold before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, rows in gathered(batches, QUERY_COMPONENTS):
            exact = rows[:, 1:]
            uri = write_arrays(root, [ids.astype("<i8"), rows[:, 0].astype("<i8"), exact.astype("<i8")])
            yield pa.RecordBatch.from_pylist([{"uri": uri, "d": exact.shape[1], "n": len(ids)}], pa.schema([("uri", pa.string()), ("d", pa.int32()), ("n", pa.int64())]))

    return run


class Block:
    """A block's approximations and ids; exact vectors stay in the file until they are read, `reads` of them so far."""

    def __init__(self, uri: str, d: int, n: int, u: int):
        self.file, self.d, self.u, self.reads = File(uri), d, u, 0
        at = 8 * u * d
        self.ids = np.array(self.file.read(at, "<i8", n))
        self.first = np.array(self.file.read(at + 8 * n, "<i8", u + 1))
        at += 8 * (n + u + 1)
        low, high = self.file.read(at, "<i8", d, CELLS), self.file.read(at + 8 * d * CELLS, "<i8", d, CELLS)
        cells = self.file.read(at + 16 * d * CELLS, "u1", u, d)
        self.low, self.high = (ends[np.arange(d), cells].astype(np.float64) for ends in (low, high))
        self.smallest = self.ids[self.first[:-1]]
        self.reach = np.maximum(np.abs(self.low), np.abs(self.high)).max(axis=0)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lower and upper bounds of the inner products, a row for each query, and what no product of it can be above.

        Sums below 2**52 are exact; larger ones get what rounding may have cost.
        """
        positive, negative = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
        lower, upper = positive @ self.low.T + negative @ self.high.T, positive @ self.high.T + negative @ self.low.T
        reach = (positive - negative) @ self.reach
        slack = np.where(reach < 2.0**52, 0.0, reach * (4 * self.d + 8) * 2.0**-52)[:, None]
        return np.clip(lower - slack, -(2.0**63), 2.0**63), np.clip(upper + slack, -(2.0**63), 2.0**63), reach

    def read(self, places: np.ndarray, query: np.ndarray, reach: float) -> np.ndarray:
        """Exact scores of the vectors at these places."""
        self.reads += len(places)
        exact = self.file.rows(places, self.d)
        if reach < 2.0**62:
            return exact @ query
        return np.array([min(max(s, LONG.min), LONG.max) for s in exact.astype(object) @ query.astype(object)], dtype=np.int64)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, thresholds: np.ndarray | None = None) -> Iterator[tuple[int, int, int]]:
        """(query id, vector id, score) of each query's k best, or all if there are fewer; of those below a query's threshold any may be missing."""
        step = max(1, BOUNDS // self.u)
        thresholds = np.full(len(queries), LONG.min) if thresholds is None else thresholds
        for start in range(0, len(queries), step):
            part, least = queries[start : start + step], thresholds[start : start + step]
            lower, upper, reach = self.bounds(part)
            for i in np.flatnonzero(upper.max(axis=1) >= least):
                own = int(query_ids[start + i])
                yield from ((own, v, s) for s, v in self._best(own, part[i], lower[i], upper[i], float(reach[i]), k, int(least[i])))

    def _best(self, own: int, query: np.ndarray, lower: np.ndarray, upper: np.ndarray, reach: float, k: int, threshold: int) -> list[tuple[int, int]]:
        for g in np.searchsorted(self.first, np.flatnonzero(self.ids == own), side="right") - 1:
            lower[g] = -np.inf  # entries that hold the query's own id vouch for nothing
            if (self.ids[self.first[g] : self.first[g + 1]] == own).all():
                upper[g] = -np.inf
        alive = (upper > -np.inf) & (upper >= threshold)
        if self.u > k:
            least = np.partition(lower, self.u - k)[self.u - k]
            sure = np.flatnonzero(lower >= least)
            last = self.smallest[sure[np.lexsort((self.smallest[sure], -lower[sure]))[k - 1]]]
            alive &= (upper > least) | ((upper == least) & (self.smallest <= last)) | (least == -np.inf)
        left = np.flatnonzero(alive)
        left = left[np.lexsort((self.smallest[left], -upper[left]))]
        best: list[tuple[int, int]] = []
        for start in range(0, len(left), READ_STEP):
            places = left[start : start + READ_STEP]
            if len(best) == k and upper[places[0]] < best[-1][0]:
                break
            for g, s in zip(places.tolist(), self.read(places, query, reach).tolist()):
                if s >= threshold and (len(best) < k or s >= best[-1][0]):
                    some = self.ids[self.first[g] : min(self.first[g] + k, self.first[g + 1])]
                    if own in some:
                        some = self.ids[self.first[g] : self.first[g + 1]]
                        some = some[some != own][:k]
                    best = sorted([*best, *((s, i) for i in some.tolist())], key=lambda x: (-x[0], x[1]))[:k]
        return best


def _search(files: list[tuple[str, int, int]], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(**row)
                for uri, d, n in files:
                    if d != block.d:
                        continue
                    queries = File(uri)
                    step = max(1, QUERY_COMPONENTS // 16 // d)
                    for start in range(0, n, step):
                        m = min(step, n - start)
                        ids, least = queries.read(8 * start, "<i8", m), queries.read(8 * (n + start), "<i8", m)
                        found = list(block.search(ids, queries.read(8 * (2 * n + start * d), "<i8", m, d), k, least))
                        columns = list(zip(*found)) or [()] * 3
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, k: int = K, every: int = QUERY_EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best for each row whose vec_id is divisible by `every`."""
    spark = vectors.sparkSession
    text_session(spark)
    rows = integer_vectors(spread(vectors))
    with Scratch(spark) as scratch:
        blocks = scratch.keep(rows.mapInArrow(_write_blocks(scratch.path("vector-approximations")), "uri string, d int, n bigint, u bigint"), "blocks")
        asked = scratch.keep(rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")), "asked")
        none = F.lit(LONG.min)

        def searched(some: DataFrame, thresholds: Column, queries: DataFrame) -> DataFrame:
            packed = queries.select("vec_id", F.concat(F.array(thresholds), "v").alias("v"))
            files = packed.mapInArrow(_write_queries(scratch.path("queries")), "uri string, d int, n bigint").collect()  # a row for each file of queries
            return some.repartition(max(1, some.count())).mapInArrow(_search([tuple(f) for f in files], k), "query_id bigint, vec_id bigint, score bigint")

        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
        share = min(FIRST_SHARE, max(2, blocks.count() // 4))
        early = F.pmod(F.xxhash64("uri"), F.lit(share)) == 0
        first = searched(blocks.filter(early), none, asked).withColumn("rank", rank).filter(F.col("rank") <= k)
        first = scratch.keep(first, "first")
        least = first.filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
        queries = asked.join(least, asked["vec_id"] == least["query_id"], "left")
        found = first.drop("rank").unionByName(searched(blocks.filter(~early), F.coalesce("least", none), queries))
        return keep(found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "top-k")


def op8_exact_top_k(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_OP8 = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
