"""Queries over indexes: built from the driver's tables, then asked."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafmill.functions.english import stems_sql
from sheafmill.operators import bitmapindex, jsonindex, search, textindex, vectorindex
from sheafmill.plans.catalogue import _KNN, _TERMS, _first_vector, _read, query
from sheafmill.session import shared_path


def _index(spark, sf_dir, **fields) -> textindex.TextIndex:
    return textindex.build(_read(spark, sf_dir, "documents"), "doc_id", fields, shared_path(spark, "text-index"))


_ALL = "list_concat({0}, [source, lang])".format(_TERMS)


@query(f"SELECT doc_id FROM documents WHERE len(list_filter({_TERMS}, lambda t: starts_with(t, 'th'))) > 0 AND list_contains({_TERMS}, 'and') AND len(list_filter({_TERMS}, lambda t: starts_with(t, 'lic'))) > 0")
def indexed_prefix(spark, sf_dir):
    """A query string with prefixes over the inverted index."""
    return _index(spark, sf_dir, _title=F.col("text")).query_string("_title", "th* and lic*").select(F.col("key").alias("doc_id"))


@query(f"SELECT doc_id FROM documents WHERE len(list_filter({_ALL}, lambda t: starts_with(t, 'src1'))) > 0 AND list_contains({_ALL}, 'en')")
def indexed_all_fields(spark, sf_dir):
    index = _index(spark, sf_dir, _title=F.col("text"), _all_fields=F.array("text", "source", "lang"))
    return index.query_string("_all_fields", "src1* en").select(F.col("key").alias("doc_id"))


def _bm25(words: str, terms: list[str], every: bool) -> str:
    """Common table expressions that end in s (doc_id, score)."""
    names = range(len(terms))
    tf = ", ".join(f"len(list_filter(t, lambda x: x = '{t}')) AS c{i}" for i, t in enumerate(terms))
    df = ", ".join(f"count(*) FILTER (WHERE c{i} > 0) AS d{i}" for i in names)
    score = " + ".join(f"ln(1 + (n - d{i} + 0.5) / (d{i} + 0.5)) * c{i} * 2.2 / (c{i} + 1.2 * (0.25 + 0.75 * dl / mean))" for i in names)
    return f"""w AS (SELECT doc_id, {words} AS t FROM documents), c AS (SELECT doc_id, len(t) AS dl, {tf} FROM w), g AS (SELECT count(*) AS n, avg(dl) AS mean, {df} FROM c),
  s AS (SELECT doc_id, {score} AS score FROM c, g WHERE {(" AND " if every else " OR ").join(f"c{i} > 0" for i in names)})"""


@query(f"WITH {_bm25(_TERMS, ['the', 'license', 'and'], False)} SELECT doc_id, round(score, 6) AS score FROM s ORDER BY s.score DESC, doc_id LIMIT 10")
def bm25_topk(spark, sf_dir):
    """The best documents by block maxima."""
    best = _index(spark, sf_dir, _all_fields=F.col("text")).bm25("_all_fields", ["the", "license", "and"], 10)
    return best.select(F.col("key").alias("doc_id"), F.round("score", 6).alias("score"))


_HYBRID = f"""WITH {_bm25(_ALL, ['en', 'the'], True)}, k AS ({_KNN} ORDER BY score DESC, vec_id LIMIT 5), l AS (SELECT doc_id, score FROM s ORDER BY score DESC, doc_id LIMIT 5),
  kn AS (SELECT vec_id AS id, CASE WHEN max(score) OVER () = min(score) OVER () THEN 1.0 ELSE (score - min(score) OVER ()) / (max(score) OVER () - min(score) OVER ()) END AS x FROM k),
  ln_ AS (SELECT doc_id AS id, CASE WHEN max(score) OVER () = min(score) OVER () THEN 1.0 ELSE (score - min(score) OVER ()) / (max(score) OVER () - min(score) OVER ()) END AS y FROM l)
  SELECT id, round(score, 6) AS score FROM (SELECT coalesce(kn.id, ln_.id) AS id, (coalesce(x, 0) * 0.7 + coalesce(y, 0) * 0.3) / 1.0 AS score FROM kn FULL JOIN ln_ ON kn.id = ln_.id) ORDER BY score DESC, id LIMIT 5"""


def _hybrid(spark, sf_dir, lexical):
    e = _read(spark, sf_dir, "embeddings")
    near = search.knn(e, _first_vector(e), field="embedding", key="vec_id").select(F.col("vec_id").alias("id"), "score")
    return search.hybrid(near, lexical, "id").select("id", F.round("score", 6).alias("score"))


@query(_HYBRID)
def hybrid_search(spark, sf_dir):
    """Vectors, and documents whose `_all_fields` has all terms of the query, by one scan."""
    docs = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.array("text", "source", "lang").alias("_all_fields"))
    lexical = search.bm25(docs, "id", "_all_fields", ["the", "en"], every=True)
    return _hybrid(spark, sf_dir, lexical.orderBy(F.col("score").desc(), "id").limit(search.TOP_K))


@query(_HYBRID)
def hybrid_indexed(spark, sf_dir):
    """As hybrid_search, through the inverted index."""
    lexical = _index(spark, sf_dir, _all_fields=F.array("text", "source", "lang")).bm25("_all_fields", ["the", "en"], search.TOP_K, every=True)
    return _hybrid(spark, sf_dir, lexical.select(F.col("key").alias("id"), "score"))


_TOKENS = f"""words AS (SELECT doc_id, {_TERMS} AS t FROM documents), tokens AS (SELECT doc_id, unnest(t) AS term, generate_subscripts(t, 1) - 1 AS position FROM words),
  {stems_sql("tokens")}, stemmed AS (SELECT doc_id, stem, position FROM tokens JOIN stems USING (term) WHERE stem IS NOT NULL)"""


def _english(spark, sf_dir) -> textindex.TextIndex:
    return textindex.build(_read(spark, sf_dir, "documents"), "doc_id", {"english": F.col("text")}, shared_path(spark, "text-index"), ("english",))


@query(f"WITH {_TOKENS} SELECT doc_id FROM stemmed WHERE stem IN ('version', 'licens') GROUP BY doc_id HAVING count(DISTINCT stem) = 2")
def english_all_terms(spark, sf_dir):
    """English full text: all words of the query, by their stems."""
    return _english(spark, sf_dir).query_string("english", "versions and the licensing").select(F.col("key").alias("doc_id"))


@query(f"""WITH {_TOKENS} SELECT DISTINCT a.doc_id FROM stemmed a JOIN stemmed b ON a.doc_id = b.doc_id AND b.position = a.position + 3 JOIN stemmed c ON a.doc_id = c.doc_id AND c.position = a.position + 4
    WHERE a.stem = 'licens' AND b.stem = 'apach' AND c.stem = 'licens'""")
def english_phrase(spark, sf_dir):
    """English full text: words one after another, by their stems; `under` and `the` are stop words."""
    return _english(spark, sf_dir).phrase("english", "licensing under the Apache licenses").select(F.col("key").alias("doc_id"))


@query(f"WITH {_TOKENS} SELECT stem, count(DISTINCT doc_id) AS documents, count(*) AS places FROM stemmed GROUP BY stem")
def english_stems(spark, sf_dir):
    """Every stem of the documents, with how many documents and places have it."""
    rows = spark.read.parquet(f"{_english(spark, sf_dir).path}/postings").filter("term IS NOT NULL")
    return rows.groupBy(F.col("term").alias("stem")).agg(F.sum(F.size("keys")).alias("documents"), F.sum(F.size("positions")).alias("places"))


def _vectors(spark, sf_dir) -> vectorindex.VectorIndex:
    return vectorindex.build(_read(spark, sf_dir, "embeddings"), "vec_id", "embedding", shared_path(spark, "vector-index"), ("label",))


@query()
def knn_indexed(spark, sf_dir):
    """The five nearest rows of every row whose vec_id is divisible by 100, through the approximate index (at least 0.9 of the true ones, which the tests measure)."""
    e = _read(spark, sf_dir, "embeddings")
    found = _vectors(spark, sf_dir).search_all(e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")))
    return found.select("query_id", "rank", F.col("key").alias("vec_id"), F.round("score", 6).alias("score"))


def _facets(spark, sf_dir) -> bitmapindex.BitmapIndex:
    """Customers with their orders as nested elements: segment, nation, and orders by state and priority, and by priority and date."""
    order = F.struct(F.col("o_orderstatus").alias("lang"), F.col("o_orderpriority").alias("dateType"), F.to_date("o_orderdate").alias("date"))
    orders = _read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(order).alias("dates"))
    docs = _read(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    fields = {"segment": F.col("c_mktsegment"), "nation": F.col("c_nationkey"), "state": bitmapindex.pair("dates", "lang", "dateType"), "date": bitmapindex.pair("dates", "dateType", "date")}
    return bitmapindex.build(docs, "c_custkey", fields, shared_path(spark, "bitmap-index"))


_FILTERS = [
    ("state", bitmapindex.starting(bitmapindex.joined("F", "1"))),
    ("date", bitmapindex.between(bitmapindex.joined("2-HIGH", ""), bitmapindex.joined("2-HIGH", "1997-03-01"))),
    ("nation", bitmapindex.one_of(*map(str, range(3, 20)))),
]
_MEETS = """FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority LIKE '1%') AND c_nationkey BETWEEN 3 AND 19
  AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '2-HIGH' AND CAST(o_orderdate AS DATE) <= DATE '1997-03-01')"""


@query(f"SELECT c_mktsegment AS key, count(*) AS doc_count {_MEETS} AND c_mktsegment IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def facet_filtered(spark, sf_dir):
    """A facet under two nested conditions and a list of values, by bitmaps."""
    return _facets(spark, sf_dir).facet("segment", _FILTERS)


@query(f"SELECT c_custkey {_MEETS}")
def bitmap_filtered(spark, sf_dir):
    """The documents under the filters of facet_filtered."""
    return _facets(spark, sf_dir).keys(_FILTERS).select(F.col("key").alias("c_custkey"))


def _clicks(spark, sf_dir) -> jsonindex.JsonIndex:
    return jsonindex.build(_read(spark, sf_dir, "clicks").filter("click_id IS NOT NULL"), "click_id", "props", shared_path(spark, "json-index"))


_CONTAINED = "SELECT DISTINCT click_id FROM clicks WHERE click_id IS NOT NULL AND CASE WHEN json_valid(props) THEN json_contains(props, '{0}') END"


@query(_CONTAINED.format('{"device": {"os": "ios"}, "tags": ["a"]}'))
def json_indexed(spark, sf_dir):
    """Clicks whose properties contain nested members and an element, by the index alone."""
    return _clicks(spark, sf_dir).containing('{"tags": ["a"], "device": {"os": "ios"}}').select(F.col("key").alias("click_id")).distinct()


@query("SELECT DISTINCT click_id FROM (SELECT click_id, unnest(CAST(json_extract(props, '$.items[*]') AS JSON[])) AS item FROM clicks WHERE click_id IS NOT NULL AND json_valid(props)) WHERE json_extract(item, '$.sku') = 1 AND json_extract(item, '$.qty') = 1")
def json_indexed_elements(spark, sf_dir):
    """Clicks with one item that has two members, by the index and a check of its candidates."""
    return _clicks(spark, sf_dir).containing('{"items": [{"sku": 1, "qty": 1}]}').select(F.col("key").alias("click_id")).distinct()
