"""Resharding by minimum-cost flow.

From the sizes of old shards and the capacities of new ones, a minimum-cost flow says how many bytes go from each old to
each new shard so that every capacity is met and the fewest bytes move (bytes that stay cost nothing). The flow network has a node for each
shard, never for a document, and is solved on the driver.

Documents of an old shard are put in a row, larger size classes first, and cut into blocks by the flow: the block that
stays comes first, so what moves is small documents and a cut is off by at most half of one. Their
offsets are prefix sums in two levels, of buckets (old shard, size class, salt) and within a bucket. Each old shard and size class has as many salts as
its own rows need, and a salt comes from a number that every row is given when it is written, so no task holds a shard, a
source, a group of equal texts or the copies of one row. Slots are numbered the same way. What goes to the driver is a row for
each old shard and size class.

The law is `bytes`: new shards' sizes are as near to equal (or to given capacities) as whole documents allow.

Defined cases: a null text has no bytes and crc32 0; a null doc_id or source is a value like any other; equal rows are each
placed, in any order among themselves; an empty table gives an empty result; columns beyond those used are carried by
`reshard` (its own are named with an underscore; input columns of these names raise ValueError).
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafmill.llm.common import documents, keep

#: Bytes that a row takes besides its text.
ROW_BYTES = 16
OLD_SHARDS = 32
NEW_SHARDS = 40
#: Rows of a bucket: at most ROWS_OF_A_SALT or so, in smaller inputs a share of all rows.
ROWS_OF_A_SALT = 50_000
FEWEST_ROWS_OF_A_SALT = 64
SHARE_OF_A_SALT = 2048
OWN = ["_old", "_size", "_crc", "_class", "_row", "_salts", "_salt", "_shard", "_slot"]


def solve(sizes: list[int], capacities: list[int], cost=None) -> dict[tuple[int, int], int]:
    """Minimum-cost flow {(old, new): bytes} that empties every old shard into new ones within their capacities.

    cost(old, new) is the cost of a byte, by default 0 if it stays and 1 if it moves. Successive shortest
    paths with potentials; raises ValueError if the capacities are too small.
    """
    cost = cost or (lambda i, j: 0 if i == j else 1)
    n, m = len(sizes), len(capacities)
    if sum(sizes) > sum(capacities):
        raise ValueError("the capacities are smaller than what is stored")
    start, stop, nodes = n + m, n + m + 1, n + m + 2
    to, left, price, edges = [], [], [], [[] for _ in range(nodes)]

    def edge(a, b, capacity, c):
        for x, y, cap, p in ((a, b, capacity, c), (b, a, 0, -c)):
            edges[x].append(len(to))
            to.append(y)
            left.append(cap)
            price.append(p)

    for i, s in enumerate(sizes):
        edge(start, i, s, 0)
        for j in range(m):
            edge(i, n + j, s, cost(i, j))
    for j, c in enumerate(capacities):
        edge(n + j, stop, c, 0)
    potential = [0] * nodes
    missing = sum(sizes)
    while missing:
        distance, via = [math.inf] * nodes, [-1] * nodes
        distance[start] = 0
        queue = [(0, start)]
        while queue:
            d, x = heapq.heappop(queue)
            if d > distance[x]:
                continue
            for e in edges[x]:
                if left[e]:
                    y = to[e]
                    reach = d + price[e] + potential[x] - potential[y]
                    if reach < distance[y]:
                        distance[y], via[y] = reach, e
                        heapq.heappush(queue, (reach, y))
        potential = [p + d if d < math.inf else p for p, d in zip(potential, distance)]
        flow, x = missing, stop
        while x != start:
            flow = min(flow, left[via[x]])
            x = to[via[x] ^ 1]
        x = stop
        while x != start:
            left[via[x]] -= flow
            left[via[x] ^ 1] += flow
            x = to[via[x] ^ 1]
        missing -= flow
    found = {}
    for i in range(n):
        for e in edges[i]:
            if not e & 1 and to[e] < n + m and left[e ^ 1]:
                found[i, to[e] - n] = left[e ^ 1]
    return found


def even(total: int, shards: int) -> list[int]:
    """Capacities of equal size, a byte apart at most."""
    return [total // shards + (j < total % shards) for j in range(shards)]


def cuts(flow: dict[tuple[int, int], int]) -> dict[int, tuple[list[int], list[int]]]:
    """For each old shard the ends of its blocks and the shards that they go to; the block that stays is first."""
    found: dict[int, tuple[list[int], list[int]]] = {}
    for (i, j), size in sorted(flow.items(), key=lambda x: (x[0][0], x[0][0] != x[0][1], x[0][1])):
        ends, to = found.setdefault(i, ([], []))
        ends.append((ends[-1] if ends else 0) + size)
        to.append(j)
    return found


def measured(docs: DataFrame) -> DataFrame:
    """docs with _size and _crc of the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"_size": F.octet_length(text).cast("long") + ROW_BYTES, "_crc": F.crc32(F.encode(text, "UTF-8"))})


def reshard(rows: DataFrame, old_shards: int, new_shards: int, capacities: list[int] | None = None) -> DataFrame:
    """rows (with _old, _size and _crc) with their new _shard and _slot."""
    spark = rows.sparkSession
    rows = keep(rows.withColumns({"_class": -F.floor(F.log2("_size") * 4).cast("int"), "_row": F.monotonically_increasing_id()}), "measured")
    classes = rows.groupBy("_old", "_class").agg(F.count("*").alias("n"), F.sum("_size").alias("bytes")).collect()  # a row for each old shard and size class
    of_a_salt = min(ROWS_OF_A_SALT, max(FEWEST_ROWS_OF_A_SALT, sum(r["n"] for r in classes) // SHARE_OF_A_SALT))
    salts = spark.createDataFrame([(r["_old"], r["_class"], -(-r["n"] // of_a_salt)) for r in classes], "_old int, _class int, _salts long")
    rows = rows.join(F.broadcast(salts), ["_old", "_class"]).withColumn("_salt", F.pmod(F.xxhash64("_row"), "_salts")).drop("_salts")
    bucket = ["_old", "_class", "_salt"]
    sizes = rows.groupBy(*bucket).agg(F.sum("_size").alias("_bytes"))
    stored = [0] * old_shards
    for r in classes:
        stored[r["_old"]] += r["bytes"]
    flow = solve(stored, capacities or even(sum(stored), new_shards))
    plan = [(i, *parts) for i, parts in cuts(flow).items()]
    plan = spark.createDataFrame(plan, "_old int, _ends array<long>, _to array<int>")
    before = Window.partitionBy("_old").orderBy("_class", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*bucket, F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*bucket).orderBy(F.col("_size").desc(), "doc_id", "_crc", "_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("_start") + F.sum("_size").over(within) - F.ceil(F.col("_size") / 2)
    placed = rows.join(starts, bucket).withColumn("_at", middle).join(F.broadcast(plan), "_old")  # plan: at most old + new shards blocks
    shard = F.expr("_to[least(size(filter(_ends, e -> e <= _at)), size(_ends) - 1)]")
    placed = keep(placed.withColumn("_shard", shard).drop("_start", "_at", "_ends", "_to"), "placed")
    piece = ["_shard", *bucket]
    counts = placed.groupBy(*piece).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_shard").orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(*piece, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    number = F.row_number().over(Window.partitionBy(*piece).orderBy(F.col("_size").desc(), "doc_id", "_crc", "_row"))
    return placed.join(firsts, piece).withColumn("_slot", F.col("_first") + number - 1).drop("_first", "_class", "_row", "_salt")


def by_source(docs: DataFrame, shards: int = OLD_SHARDS) -> DataFrame:
    """docs with _old, the shard that a layout by source gives them."""
    return docs.withColumn("_old", F.pmod(F.xxhash64("source"), F.lit(shards)).cast("int"))


def rewrite(docs: DataFrame, path: str, old_shards: int = OLD_SHARDS, new_shards: int = NEW_SHARDS) -> list[int]:
    """Reshard docs, which have their old shard in _old, and write the shards that change as path/shard=N.

    Returns the numbers of the shards written; all others keep their old files.
    """
    if clash := set(OWN[1:]) & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} are this operator's own")
    placed = keep(reshard(measured(docs), old_shards, new_shards), "resharded")
    moved = placed.filter("_old <> _shard").select(F.explode(F.array("_old", "_shard")).alias("shard")).distinct().collect()  # at most old + new shards
    changed = sorted(r["shard"] for r in moved)
    out = placed.filter(F.col("_shard").isin(changed)).select(*[c for c in docs.columns if c != "_old"], F.col("_shard").alias("shard"), "_slot")
    out.write.partitionBy("shard").parquet(path)
    return changed


def op4_min_cost_reshard(spark, sf_dir: str) -> DataFrame:
    docs = by_source(documents(spark, sf_dir).select("doc_id", "text", "source"))
    placed = reshard(measured(docs).select("doc_id", "_old", "_size", "_crc"), OLD_SHARDS, NEW_SHARDS)
    return placed.select(
        "doc_id", F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit("bytes").alias("law"), F.col("_shard").alias("shard"), F.col("_slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("_old").alias("old_shard")
    )
