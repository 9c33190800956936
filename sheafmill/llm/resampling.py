"""Target-distribution importance resampling: draw the documents whose hashed n-grams look most like a target's. DataFrame and SQL functions only.

A document's words (A-Z lower-cased) give all runs of 1 to n consecutive words, joined by a space; a run's bucket is the crc32 of its UTF-8 bytes modulo the
number of buckets. A bucket's gain compares its smoothed share in the target with that in the documents, in thousandths of a natural logarithm, floored. A
document's weight is the floored mean of its runs' gains; Gumbel noise made from a hash of its id is added, so that the highest scores are a draw without
replacement in proportion to the weights.

Texts are read once: each document's buckets, two bytes a run before compression, are written and read twice, to count and to sum. Counts are combined before the
shuffle, so a task sends a row for each bucket at most; the gains have a row for each bucket, whose number is a parameter, and are broadcast. Sums combine before the shuffle
too, as a document's runs follow one another. The draw sorts by ranges: a row's rank is its range's offset plus its place in the range, and no task sees all rows.

Defined cases: null texts and texts without words have no runs and weight 0; a null id is hashed as an empty one; repeated rows are rows of their own; ties go to the smaller
doc_id (null first), then to the row with fewer runs; an empty target gives each bucket the target count 0, an empty table an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafmill.llm.common import Scratch, documents, keep

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 1
BUCKETS = 10000
SEED = "2024"
LEAST_WORDS = 20
PERCENT = 10


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none for null."""
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), 0), F.array().cast("array<string>"))


def runs(found: Column, longest: int) -> Column:
    """All runs of 1 to `longest` consecutive words of an array."""

    def of(n: int) -> Column:
        starts = F.when(F.size(found) >= n, F.sequence(F.lit(1), F.size(found) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(found, i, n), " "))

    return F.concat(found, *(of(n) for n in range(2, longest + 1)))


def bucketed(docs: DataFrame, keys: list[str], longest: int = GRAM, buckets: int = BUCKETS) -> DataFrame:
    """keys, n_words, and `buckets`: an array with the bucket of each run of a row's text."""
    kind = "short" if buckets <= 32768 else "int"

    def one(found: Column) -> Column:
        return F.struct(F.size(found).cast("long").alias("n_words"), F.transform(runs(found, longest), lambda w: (F.crc32(w.cast("binary")) % buckets).cast(kind)).alias("buckets"))

    return docs.select(*keys, F.inline(F.transform(F.array(words(F.col("text"))), one)))  # a lambda's variable is worked out once


def counted(rows: DataFrame, name: str) -> DataFrame:
    """(bucket, name): how many runs are in each bucket that has some."""
    return rows.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias(name))


def gains(counts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of counts (bucket, s, t), which has a row for each bucket that the documents use; t is null where the target has none."""
    total = counts.agg(F.sum("s"), F.sum("t")).first()
    s, t = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in ("s", "t"))
    all_s, all_t = (F.lit(float((x or 0) + buckets)) for x in total)
    return counts.select("bucket", F.floor(1000 * F.log((t + 1) * all_s / ((s + 1) * all_t))).alias("gain"))


def floored_mean(total: Column, n: Column) -> Column:
    """total / n, floored, in whole numbers."""
    return F.call_function("div", total - F.pmod(total, n), n)


def weights(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """rows (with keys that are unique, n_words and buckets) with n_features and weight. table: (bucket, gain), a row for each bucket, so bounded by their number."""
    each = rows.select(*keys, "n_words", F.explode_outer("buckets").alias("bucket")).join(F.broadcast(table), "bucket", "left")
    summed = each.groupBy(*keys, "n_words").agg(F.count("bucket").alias("n_features"), F.sum("gain").alias("_gain"))
    return summed.withColumn("weight", F.when(F.col("n_features") > 0, floored_mean(F.col("_gain"), F.col("n_features"))).otherwise(F.lit(0)).cast("long")).drop("_gain")


def noise(key: Column, seed: str = SEED) -> Column:
    """Gumbel noise of a key in thousandths, floored: the same on every run."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def ranked(rows: DataFrame, order: list[Column], name: str = "ranked") -> DataFrame:
    """rows with `rank` (from 1) in this order.

    Rows are dealt to tasks by ranges of the order and sorted there; each carries its task's number and its place in the task, and the offset of a task is the number of rows in
    those before it. Written once, so that a lost task can't deal them otherwise.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    placed = keep(placed, name).withColumn("_task", F.shiftright("_place", 33)).withColumn("_place", F.col("_place").bitwiseAND((1 << 33) - 1))
    sizes = placed.groupBy("_task").agg(F.count("*").alias("_n"))  # a row for each task of the sort
    offsets = sizes.select("_task", F.coalesce(F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    return placed.join(F.broadcast(offsets), "_task").withColumn("rank", F.col("_offset") + F.col("_place") + 1).drop("_task", "_place", "_offset")


def resample(docs: DataFrame, target: DataFrame, longest: int = GRAM, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of docs (doc_id, text); rank is null for those that are not drawn. target: (text).

    Of the documents with `least_words` words or more, `percent` in a hundred (floored) are drawn: the highest scores.
    """
    with Scratch(docs.sparkSession) as scratch:
        cut = scratch.keep(bucketed(docs.select("doc_id", "text"), ["doc_id"], longest, buckets).withColumn("_row", F.monotonically_increasing_id()), "buckets")
        wanted = counted(bucketed(target.select("text"), [], longest, buckets), "t")
        counts = scratch.keep(counted(cut, "s").join(wanted, "bucket", "left"), "bucket-counts")
        weighed = weights(cut, gains(counts, buckets), ["_row", "doc_id"])
        scored = weighed.select("doc_id", "n_words", "n_features", "weight", (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"))
        order = [F.col("_fit").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("n_features").asc()]
        sorted_rows = ranked(scored.withColumn("_fit", F.col("n_words") >= least_words), order, "resampled")
    drawn = sorted_rows.filter("_fit").count() * percent // 100
    return sorted_rows.withColumn("rank", F.when(F.col("_fit") & (F.col("rank") <= drawn), F.col("rank"))).drop("_fit")


def op11_importance_resampling(spark, sf_dir: str) -> DataFrame:
    drawn = resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


_RUNS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}')"

#: The crc32 of each distinct word by a table of 256 remainders, which SQL works out bit by bit.
ORACLE_OP11 = rf"""
WITH RECURSIVE bits AS (SELECT CAST(i AS BIGINT) AS i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) g(i)
    UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
  crc AS (SELECT list(c ORDER BY i) AS c FROM bits WHERE k = 8),
  d AS (SELECT row_number() OVER () AS r, doc_id, {_RUNS} AS w FROM documents),
  dw AS (SELECT r, unnest(w) AS w FROM d), bw AS (SELECT unnest(w) AS w FROM (SELECT {_RUNS} AS w FROM benchmark)),
  v AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
  h AS (SELECT w, xor(list_reduce(list_transform(range(len(x) // 2), lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT)), lambda a, b: xor(a >> 8, c[xor(a, b) % 256 + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % {BUCKETS} AS bucket FROM v, crc),
  s AS (SELECT bucket, count(*) AS s FROM dw JOIN h USING (w) GROUP BY bucket), t AS (SELECT bucket, count(*) AS t FROM bw JOIN h USING (w) GROUP BY bucket),
  n AS (SELECT (SELECT count(*) FROM dw) AS s_all, (SELECT count(*) FROM bw) AS t_all),
  g AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * CAST(s_all + {BUCKETS} AS DOUBLE) / ((s + 1) * CAST(t_all + {BUCKETS} AS DOUBLE)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket), n),
  m AS (SELECT r, CAST(sum(gain) AS BIGINT) AS total, count(*) AS k FROM dw JOIN h USING (w) JOIN g USING (bucket) GROUP BY r),
  o AS (SELECT d.r, doc_id, len(w) AS n_features, CASE WHEN k > 0 THEN (total - ((total % k) + k) % k) // k ELSE 0 END AS weight, CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN m USING (r)),
  z AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM o),
  q AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id NULLS FIRST, n_features) AS place FROM z)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN n_features >= {LEAST_WORDS} AND place <= (SELECT count(*) FROM z WHERE n_features >= {LEAST_WORDS}) * {PERCENT} // 100 THEN CAST(place AS BIGINT) END AS rank FROM q
"""
