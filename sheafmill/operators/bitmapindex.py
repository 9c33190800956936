"""An index of values by bitmaps: filters are intersections of bits, facets are counts of bits; documents are not read.

    index = bitmapindex.build(docs, "id", {"type": F.col("type"), "dates": pair("dates", "dateType", "date")}, "/indexes/facets")
    filters = [("type", one_of("Dataset", "Text")), ("dates", between(joined("Issued", "1995"), joined("Issued", "2001")))]
    index.facet("lang", filters)          # (key, doc_count), the most frequent first
    index.keys(filters)                   # keys of the documents that meet all filters

Documents are numbered; a value's bitmap is the set of numbers that have it. It is stored as its words of 64 numbers that are not empty, a row each, so a value of few documents takes few rows and one of many is dealt to
many tasks; whole bitmaps as binaries would take 4 KB for each value and 32,768 documents, and there is no function for the intersection of two of them. Words are sorted by field, value and number below a folder for each
field, so a search reads the row groups that can hold its values. Or, and, and counting of bits are long operations in generated code; everything is joined by number, which is even, so no value is a hot key.

A nested condition, all of which one element of an array has to meet, is a filter on one value that joins the element's parts (`pair`): equal parts come first, a part that is compared by range comes last.

Defined cases: null values, null elements and empty arrays are no values; a value that a document has twice counts once; values are compared as texts; without filters all documents count; a filter that no value meets gives nothing; repeated keys are different documents.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafmill.operators.search import FACET_SIZE
from sheafmill.session import Scratch

#: Between the parts of a joined value; sorts before all printable characters.
BETWEEN_PARTS = "\x1f"

#: A field and a condition on its values.
Filter = tuple[str, Callable[[Column], Column]]


def one_of(*values: str) -> Callable[[Column], Column]:
    return lambda value: value.isin(*values)


def between(low: str, high: str) -> Callable[[Column], Column]:
    """Values from low to high, both included."""
    return lambda value: (value >= low) & (value <= high)


def starting(prefix: str) -> Callable[[Column], Column]:
    return lambda value: value.startswith(prefix)


def joined(*parts: str) -> str:
    return BETWEEN_PARTS.join(parts)


def pair(elements: str | Column, *parts: str) -> Column:
    """For each element of an array of structs, its parts as one value; elements that lack one have none."""
    return F.transform(elements, lambda e: F.when(reduce(lambda a, b: a & b, (e[p].isNotNull() for p in parts)), F.concat_ws(BETWEEN_PARTS, *(e[p].cast("string") for p in parts))))


def build(docs: DataFrame, key: str, fields: dict[str, Column], path: str, files: int | None = None) -> BitmapIndex:
    """Index fields (a value or an array of values) of docs under a new folder. files: how many ranges the words are cut into (default: Spark's number of shuffle partitions)."""
    spark = docs.sparkSession
    each = []
    for name, column in fields.items():
        values = column if docs.select(column.alias("c")).schema[0].dataType.typeName() == "array" else F.array(column)
        each.append(F.transform(F.coalesce(values.cast("array<string>"), F.array().cast("array<string>")), lambda v: F.struct(F.lit(name).alias("field"), v.alias("value"))))
    with Scratch(spark) as scratch:
        rows = scratch.keep(docs.select(F.col(key).alias("key"), F.concat(*each).alias("values")).withColumn("number", F.monotonically_increasing_id()), "numbered")
        place = [F.shiftright("number", 6).alias("block"), F.col("number").bitwiseAND(63).cast("int").alias("bit")]
        rows.select(*place, "key").write.parquet(f"{path}/documents")
        entries = rows.select(*place, F.inline("values")).filter("value IS NOT NULL")
        words = entries.groupBy("field", "value", "block").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        order = ["field", "value", "block"]
        dealt = words.repartitionByRange(files, *order) if files else words.repartitionByRange(*order)
        dealt.sortWithinPartitions(*order).write.partitionBy("field").parquet(f"{path}/words")
    return BitmapIndex(spark, path)


class BitmapIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def words(self, field: str) -> DataFrame:
        """(value, block, bits) of a field."""
        return self.spark.read.schema("value string, block bigint, bits bigint, field string").parquet(f"{self.path}/words").filter(F.col("field") == field).drop("field")

    def where(self, filters: Sequence[Filter]) -> DataFrame:
        """(block, bits) of the documents that meet all filters (at least one): values of a filter are united, filters are intersected, in one shuffle by number."""
        parts = [self.words(field).filter(meets(F.col("value"))).select("block", F.lit(i).alias("filter"), "bits") for i, (field, meets) in enumerate(filters)]
        united = reduce(DataFrame.unionByName, parts).groupBy("block").agg(*(F.bit_or(F.when(F.col("filter") == i, F.col("bits"))).alias(f"b{i}") for i in range(len(parts))))
        bits = reduce(Column.bitwiseAND, (F.col(f"b{i}") for i in range(len(parts))))  # null where a filter has no document of the block
        return united.select("block", bits.alias("bits")).filter("bits <> 0")

    def facet(self, field: str, filters: Sequence[Filter] = (), size: int = FACET_SIZE) -> DataFrame:
        """(key, doc_count) of a field's most frequent values among the documents that meet all filters; ties by value."""
        words, bits = self.words(field), F.col("bits")
        if filters:
            words, bits = words.join(self.where(filters).withColumnRenamed("bits", "hits"), "block"), bits.bitwiseAND(F.col("hits"))
        counts = words.groupBy(F.col("value").alias("key")).agg(F.sum(F.bit_count(bits)).alias("doc_count")).filter("doc_count > 0")
        return counts.orderBy(F.col("doc_count").desc(), "key").limit(size)

    def keys(self, filters: Sequence[Filter]) -> DataFrame:
        """(key) of the documents that meet all filters."""
        documents = self.spark.read.parquet(f"{self.path}/documents")
        if not filters:
            return documents.select("key")
        return documents.join(self.where(filters), "block").filter("getbit(bits, bit) = 1").select("key")

    def count(self, filters: Sequence[Filter]) -> int:
        if not filters:
            return self.spark.read.parquet(f"{self.path}/documents").count()
        return self.where(filters).agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0))).first()[0]
