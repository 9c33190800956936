"""An index of JSON documents by path and value, for containment: which documents contain a given one.

    index = jsonindex.build(events, "id", "props", "/indexes/props")
    index.containing('{"device": {"os": "ios"}, "tags": ["a"]}')      # keys

A contains B if both are objects and each member of B is contained in A's member of that name; or both are arrays and each element of B is contained in some element of A; or both are equal scalars. At the top
only, an array contains a scalar that is one of its elements. Numbers are equal by value (1, 1.0 and 1e0).

Documents are parsed to variants and opened level by level; each scalar, and each container without members, is a row (path, value, key), where elements of an array share one path. Rows are sorted by path and
value over range-partitioned files, so a search reads row groups that can hold what it asks for. A document has to have all of the asked rows. That alone is exact unless an element of an asked array has
several members, which one element of the document's array has to contain together; then the candidates, and no others, are parsed again and checked.

Defined cases: a null, a text that is no JSON, and an object with a name twice are contained in nothing and contain nothing; repeated keys are one document where no check is needed, so keys should be unique; an asked `{}`
or `[]` is contained in every object or array.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafmill.session import Scratch

#: Between the steps of a path; not allowed unescaped in JSON, so hardly in names.
STEP = "\x1f"
ELEMENT = STEP + "[]"
#: Numbers are compared in this type, which may not hold all of their digits, and as doubles.
EXACT = "decimal(38,18)"
#: Rows of one range of the index, and keys that one task groups for a search, at most about, so that a task takes no more memory in a larger index.
RANGE_ROWS = 1_000_000
_NUMBERS = ("TINYINT", "SMALLINT", "INT", "BIGINT", "DECIMAL", "FLOAT", "DOUBLE")


def kind_of(v: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _members(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _elements(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def number_text(v: Column) -> Column:
    """One text for all spellings of a number: as EXACT, which may round or not hold it, and as a double."""
    exact, rough = F.try_variant_get(v, "$", EXACT).cast("string"), (F.try_variant_get(v, "$", "double") + F.lit(0.0)).cast("string")
    return F.concat(F.coalesce(exact, F.lit("")), F.lit("/"), rough)


def _value(v: Column, kind: Column) -> Column:
    """A scalar, or what kind of container it is, as text."""
    text = F.try_variant_get(v, "$", "string")
    return F.when(kind == "STRING", F.concat(F.lit("s"), text)).when(kind.isin(*_NUMBERS), F.concat(F.lit("n"), number_text(v))).when(kind == "BOOLEAN", F.concat(F.lit("b"), text)).when(kind == "OBJECT", "{").when(kind == "ARRAY", "[").otherwise("z")


def build(docs: DataFrame, key: str, column: str, path: str, files: int | None = None) -> JsonIndex:
    """Index a column of JSON texts under a new folder. files: how many ranges the rows are cut into (default: by their number)."""
    spark = docs.sparkSession
    docs.select(F.col(key).alias("key"), F.col(column).alias("text")).filter("text IS NOT NULL").write.parquet(f"{path}/documents")
    with Scratch(spark) as scratch:
        level = spark.read.parquet(f"{path}/documents").select("key", F.lit("$").alias("path"), F.try_parse_json("text").alias("v")).filter("v IS NOT NULL")
        parts = []
        while not level.isEmpty():  # once for each level that documents have
            v, kind = F.col("v"), F.col("kind")
            opened = level.withColumn("kind", kind_of(v)).select("key", "path", "kind", _value(v, kind).alias("value"), F.when(kind.isin("OBJECT", "ARRAY"), v).alias("v"))
            seen = scratch.keep(opened, "level")  # values are worked out once, though the range partitioning reads them twice
            parts.append(seen.select("path", "value", "key"))
            children = [
                seen.filter("kind = 'OBJECT'").select("key", "path", F.explode(_members(v)).alias("name", "child")).select("key", F.concat("path", F.lit(STEP + "."), "name").alias("path"), F.col("child").alias("v")),
                seen.filter("kind = 'ARRAY'").select("key", F.concat("path", F.lit(ELEMENT)).alias("path"), F.explode(_elements(v)).alias("v")),
            ]
            level = children[0].unionByName(children[1])
        rows = reduce(DataFrame.unionByName, parts) if parts else docs.select(F.lit("").alias("path"), F.lit("").alias("value"), F.col(key).alias("key")).limit(0)
        order = ["path", "value", "key"]
        files = files or _parts(rows.count())  # of files just written: their footers say it
        (rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)).sortWithinPartitions(*order).write.parquet(f"{path}/rows")
    return JsonIndex(spark, path)


def _parts(rows: int) -> int | None:
    """How many partitions so many rows need, if more than one. The number is given, since Spark puts partitions together by their compressed size, of which a sort takes many times as much."""
    return -(-rows // RANGE_ROWS) if rows > RANGE_ROWS else None


def asked(wanted: Any, path: str = "$") -> tuple[list[tuple[str, Any]], bool]:
    """(path, scalar or empty container) of what a document has to have, and whether that is enough."""
    if isinstance(wanted, dict) and wanted:
        found = [asked(v, f"{path}{STEP}.{k}") for k, v in wanted.items()]
        return [leaf for leaves, _ in found for leaf in leaves], all(enough for _, enough in found)
    if isinstance(wanted, list) and wanted:
        found = [asked(v, path + ELEMENT) for v in wanted]
        return [leaf for leaves, _ in found for leaf in leaves], all(enough and len(leaves) == 1 for leaves, enough in found)
    return [(path, wanted)], True


def scalar_equals(v: Column, kind: Column, wanted: Any) -> Column:
    if wanted is None:
        return kind == "VOID"
    if isinstance(wanted, bool):
        return (kind == "BOOLEAN") & (F.try_variant_get(v, "$", "boolean") == wanted)
    if isinstance(wanted, str):
        return (kind == "STRING") & (F.try_variant_get(v, "$", "string") == wanted)
    return kind.isin(*_NUMBERS) & (number_text(v) == number_text(F.parse_json(F.lit(str(wanted)))))


def contains(v: Column, wanted: Any) -> Column:
    """Whether a variant contains a JSON value (below the top)."""
    kind = kind_of(v)
    if isinstance(wanted, dict):
        return reduce(lambda a, b: a & b, (F.coalesce(contains(F.try_element_at(_members(v), F.lit(k)), w), F.lit(False)) for k, w in wanted.items()), kind == "OBJECT")
    if isinstance(wanted, list):
        return reduce(lambda a, b: a & b, (F.coalesce(F.exists(_elements(v), lambda e: contains(e, w)), F.lit(False)) for w in wanted), kind == "ARRAY")
    return scalar_equals(v, kind, wanted)


def _texts(leaves: list[tuple[str, Any]]) -> Iterator[tuple[str, Column]]:
    for path, wanted in leaves:
        if isinstance(wanted, dict | list):
            yield path, F.lit("{" if isinstance(wanted, dict) else "[")
        elif wanted is None or isinstance(wanted, bool):
            yield path, F.lit("z" if wanted is None else f"b{str(wanted).lower()}")
        else:
            yield path, F.lit("s" + wanted) if isinstance(wanted, str) else F.concat(F.lit("n"), number_text(F.parse_json(F.lit(str(wanted)))))


class JsonIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def candidates(self, leaves: list[tuple[str, Any]]) -> DataFrame:
        """(key) of the documents that have all of the leaves."""
        texts = list(_texts(leaves))
        plain = self.spark.range(1).select(*(c.alias(f"c{i}") for i, (_, c) in enumerate(texts))).first()  # values of the query, so that the scan gets literals
        places = sorted({(path, plain[i]) for i, (path, _) in enumerate(texts)})
        rows = self.spark.read.parquet(f"{self.path}/rows")
        some = rows.filter(reduce(lambda a, b: a | b, ((F.col("path") == p) & (F.col("value") == v) for p, v in places)))
        each = some.select("key", *(((F.col("path") == p) & (F.col("value") == v)).alias(f"has{i}") for i, (p, v) in enumerate(places)))
        parts = _parts(some.count())
        each = each.repartition(parts, "key") if parts else each
        found = each.groupBy("key").agg(*(F.bool_or(f"has{i}").alias(f"has{i}") for i in range(len(places))))
        return found.filter(reduce(lambda a, b: a & b, (F.col(f"has{i}") for i in range(len(places))))).select("key")

    def containing(self, wanted: str) -> DataFrame:
        """(key) of the documents that contain a JSON value."""
        value = json.loads(wanted, parse_float=Decimal)
        leaves, enough = asked(value)
        found = self.candidates(leaves)
        if not isinstance(value, dict | list):
            found = found.unionByName(self.candidates([("$" + ELEMENT, value)])).distinct()
        if enough:
            return found
        documents = self.spark.read.parquet(f"{self.path}/documents")
        return documents.join(found, "key", "left_semi").select("key", F.try_parse_json("text").alias("v")).filter(contains(F.col("v"), value)).select("key")
