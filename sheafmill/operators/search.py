"""Search: lexical prefixes, nested conditions, vectors, hybrids, facets and BM25."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafmill.functions.scalars import terms
from sheafmill.session import keep

FACET_SIZE = 10
TOP_K = 5
# Weights of the vector and the lexical part of a hybrid (fixed values).
HYBRID_WEIGHTS = (0.7, 0.3)
# The usual parameters of BM25 (fixed values).
BM25_K1, BM25_B = 1.2, 0.75


def matches_all(words: Column, query: str) -> Column:
    """Whether every term of the query is among the words; `farm*` stands for any word that starts so. words: an array of terms."""

    def one(term: str) -> Column:
        stem = term.rstrip("*").lower()
        return F.exists(words, lambda w: w.startswith(stem)) if term.endswith("*") else F.array_contains(words, stem)

    return F.coalesce(reduce(lambda a, b: a & b, (one(t) for t in query.split()), F.lit(True)), F.lit(False))


def words_of(texts: Column) -> Column:
    """The terms of an array of texts; null texts have none."""
    return F.flatten(F.transform(texts, lambda t: F.coalesce(terms(t), F.array().cast("array<string>"))))


def query_string(docs: DataFrame, field: str, query: str) -> DataFrame:
    """Documents whose field (a text or an array of texts) has all terms of the query."""
    kind = docs.schema[field].dataType.typeName()
    return docs.filter(matches_all(words_of(F.col(field)) if kind == "array" else terms(F.col(field)), query))


def nested(docs: DataFrame, path: str, condition) -> DataFrame:
    """Documents with one element of the array that meets the whole condition."""
    return docs.filter(F.coalesce(F.exists(path, condition), F.lit(False)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double precision."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, p: s + p)

    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def knn(docs: DataFrame, vector: list[float], k: int = TOP_K, field: str = "emb", key: str = "id", where: Column | None = None) -> DataFrame:
    """The k documents most similar to the vector, with their score; a filter applies before the search. Ties: the smaller key."""
    rows = docs if where is None else docs.filter(where)
    query = F.array(*(F.lit(float(x)) for x in vector))
    return rows.withColumn("score", cosine(F.col(field), query)).filter(F.col("score").isNotNull()).orderBy(F.col("score").desc(), key).limit(k)


def min_max(hits: DataFrame, score: str) -> DataFrame:
    """hits (of a search, so few) with their scores scaled to 0 to 1; equal scores are 1."""
    ends = hits.agg(F.min(score).alias("_low"), F.max(score).alias("_high"))
    scaled = F.when(F.col("_high") == F.col("_low"), F.lit(1.0)).otherwise((F.col(score) - F.col("_low")) / (F.col("_high") - F.col("_low")))
    return hits.join(F.broadcast(ends)).withColumn(score, scaled).drop("_low", "_high")  # one row


def hybrid(vector_hits: DataFrame, lexical_hits: DataFrame, key: str, k: int = TOP_K, weights: tuple[float, float] = HYBRID_WEIGHTS) -> DataFrame:
    """The k best of two searches (key, score) by the weighted mean of their scaled scores; a hit that one of them lacks counts 0 there."""
    a = min_max(vector_hits.select(key, F.col("score").alias("_a")), "_a")
    b = min_max(lexical_hits.select(key, F.col("score").alias("_b")), "_b")
    score = (F.coalesce("_a", F.lit(0.0)) * weights[0] + F.coalesce("_b", F.lit(0.0)) * weights[1]) / sum(weights)
    return a.join(b, key, "full_outer").select(key, score.alias("score")).orderBy(F.col("score").desc(), key).limit(k)


def facet(docs: DataFrame, field: str, size: int = FACET_SIZE) -> DataFrame:
    """(key, doc_count) of a field's most frequent values; ties by value."""
    counts = docs.filter(F.col(field).isNotNull()).groupBy(F.col(field).alias("key")).agg(F.count("*").alias("doc_count"))
    return counts.orderBy(F.col("doc_count").desc(), "key").limit(size)


def bm25(docs: DataFrame, key: str, text: str, query: list[str], every: bool = False) -> DataFrame:
    """(key, score) of the documents with a term of the query, or, with `every`, with all of them. Document frequencies and lengths are over all documents. text: a text or an array of texts.

    Texts are read and cut into terms once; their counts, a few numbers a document, are written and read twice.
    """
    query = sorted({q.lower() for q in query})

    def counts(words: Column) -> Column:
        return F.struct(F.size(words).alias("_length"), *(F.size(F.filter(words, lambda t: t == q)).alias(f"_tf{i}") for i, q in enumerate(query)))

    words = words_of(F.col(text)) if docs.schema[text].dataType.typeName() == "array" else terms(F.col(text))
    one = F.transform(F.array(words), counts)  # a lambda's variable is worked out once, a column that is used often may be inlined
    counted = keep(docs.select(key, F.inline(one)), "term-counts")
    whole = counted.agg(F.count("*").alias("_n"), F.avg("_length").alias("_mean"), *(F.count_if(F.col(f"_tf{i}") > 0).alias(f"_df{i}") for i in range(len(query))))
    rows = counted.filter(reduce(lambda a, b: a & b if every else a | b, (F.col(f"_tf{i}") > 0 for i in range(len(query))))).join(F.broadcast(whole))  # one row

    def part(i: int) -> Column:
        tf, df = F.col(f"_tf{i}"), F.col(f"_df{i}")
        idf = F.log(1 + (F.col("_n") - df + 0.5) / (df + 0.5))
        return idf * tf * (BM25_K1 + 1) / (tf + BM25_K1 * (1 - BM25_B + BM25_B * F.col("_length") / F.col("_mean")))

    return rows.select(key, reduce(lambda a, b: a + b, (part(i) for i in range(len(query)))).alias("score"))


def search_documents(docs: DataFrame, key: str = "id") -> DataFrame:
    """The last document of each id, as an index keeps them. docs: with a `position` that says which is later."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.col("position").desc()))
    return docs.withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "position")
