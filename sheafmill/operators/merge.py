"""Merges as functions of DataFrames: nothing is updated in place, each returns the table after the change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafmill.functions.scalars import record_id
from sheafmill.sources.tables import CHECKS, ENUMS, FOREIGN, LENGTHS, UNIQUE

#: Columns of records that an update changes (fixed values); all others keep what they have.
RECORD_UPDATES = ["resource_type", "title", "raw_metadata", "doi", "url", "embeddings", "embedding_model", "datacite_json", "opensearch_synced_at", "additional_metadata", "datestamp"]


def same_key(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & (left[k] == right[k])
    return out


def last_of_key(changes: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last change of each key in this order (for one row a key, an upsert of all in turn and of the last give the same)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return changes.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def upsert(current: DataFrame, changes: DataFrame, keys: list[str], updates: list[str], on_update: dict[str, Column] | None = None) -> DataFrame:
    """current after changes (a row for each key): new keys are inserted, known keys get the `updates` columns and the `on_update` expressions; one full outer join."""
    c, n = current.alias("c"), changes.alias("n")
    joined = c.withColumn("_c", F.lit(True)).join(n.withColumn("_n", F.lit(True)), [F.col(f"c.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")
    have, new = F.col("_c").isNotNull(), F.col("_n").isNotNull()
    out = []
    for name in current.columns:
        old, fresh = F.col(f"c.{name}"), F.col(f"n.{name}") if name in changes.columns else F.lit(None).cast(current.schema[name].dataType)
        changed = (on_update or {}).get(name, fresh if name in updates else old)
        out.append(F.when(have & new, changed).when(have, old).otherwise(fresh).alias(name))
    return joined.select(*out)


def upsert_records(records: DataFrame, changes: DataFrame, now: Column) -> DataFrame:
    """Records after an upsert on (endpoint_id, record_identifier); now is the time that an update is stamped with."""
    inserted = changes.withColumn("id", record_id(F.col("endpoint_id"), F.col("record_identifier")))
    return upsert(records, inserted, ["endpoint_id", "record_identifier"], RECORD_UPDATES, {"updated_at": now})


def delete_by_key(current: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """current without the keys of gone; unknown keys are no error."""
    return current.join(gone.select(*keys).distinct(), keys, "left_anti").select(current.columns)


def insert_ignore(current: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """current and those rows of new whose key is not there yet; of new rows with one key, one."""
    fresh = new.dropDuplicates(keys).join(current.select(*keys), keys, "left_anti").select(current.columns)
    return current.unionByName(fresh)


def merge_errors(events: DataFrame, results: DataFrame) -> DataFrame:
    """events with the error messages of results (id, message): a message sets it, a null message clears it, other events keep theirs."""
    found = results.select(F.col("id"), F.col("message").alias("_message"), F.lit(True).alias("_seen"))
    out = events.join(found, "id", "left").withColumn("error_message", F.when(F.col("_seen"), F.col("_message")).otherwise(F.col("error_message")))
    return out.select(events.columns)


def cascade_delete(tables: dict[str, DataFrame], parent: str, gone: DataFrame) -> dict[str, DataFrame]:
    """All tables after the rows of parent with the ids of gone (column id) are deleted, and what refers to deleted rows with them."""
    out, deleted = dict(tables), {parent: gone.select("id")}
    out[parent] = delete_by_key(tables[parent], gone, ["id"])
    for child in ("endpoints", "harvest_runs", "harvest_events", "records"):
        if child == parent or child not in tables:
            continue
        lost = None
        for column, of in FOREIGN[child]:
            if of in deleted:
                one = tables[child].join(deleted[of].select(F.col("id").alias(column)).distinct(), column, "left_semi").select("id")
                lost = one if lost is None else lost.unionByName(one)
        if lost is not None:
            deleted[child] = lost.distinct()
            out[child] = delete_by_key(tables[child], deleted[child], ["id"])
    return out


def audit(tables: dict[str, DataFrame]) -> DataFrame:
    """(constraint, violations) of all constraints of the given tables."""
    found = None

    def add(name: str, rows: DataFrame, count: Column) -> None:
        nonlocal found
        one = rows.agg(F.coalesce(count, F.lit(0)).cast("long").alias("violations")).select(F.lit(name).alias("constraint"), "violations")
        found = one if found is None else found.unionByName(one)

    for table, df in tables.items():
        for keys, condition in UNIQUE.get(table, []):
            rows = df.filter(condition) if condition else df
            groups = rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
            add(f"{table} unique {','.join(keys)}" + (f" where {condition}" if condition else ""), groups, F.sum(F.col("n") - 1))
        for column, parent in FOREIGN.get(table, []):
            if parent in tables:
                rows = df.filter(F.col(column).isNotNull()).join(tables[parent].select(F.col("id").alias(column)), column, "left_anti")
                add(f"{table} foreign {column}", rows, F.count("*"))
        for column, values in ENUMS.get(table, {}).items():
            if column in df.columns:
                add(f"{table} enum {column}", df.filter(~F.col(column).isin(values)), F.count("*"))
        for column, longest in LENGTHS.get(table, {}).items():
            if column in df.columns:
                add(f"{table} length {column}", df.filter(F.char_length(column) > longest), F.count("*"))
        for name, condition in CHECKS.get(table, {}).items():
            add(f"{table} check {name}", df.filter(f"NOT ({condition})"), F.count("*"))
    return found
