"""The report: its four queries, the totals, and the text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafmill.functions.scalars import percent_of
from sheafmill.session import Scratch


def named(endpoints: DataFrame) -> DataFrame:
    return endpoints.select(F.col("id").alias("endpoint_id"), F.col("name").alias("endpoint_name"))


def records_per_endpoint(records: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Counted by id first, so that the join is between a row for each endpoint."""
    counts = records.groupBy("endpoint_id").agg(F.count("id").alias("n"))
    return counts.join(named(endpoints), "endpoint_id").groupBy("endpoint_name").agg(F.sum("n").alias("record_count")).orderBy(F.col("record_count").desc(), "endpoint_name")


def duplicates(records: DataFrame, endpoints: DataFrame) -> DataFrame:
    twice = records.groupBy("record_identifier").agg(F.count("*").alias("n")).filter("n > 1").select("record_identifier")
    found = records.join(twice, "record_identifier", "left_semi").join(named(endpoints), "endpoint_id")
    return found.select("record_identifier", F.col("id").alias("record_id"), "endpoint_name").orderBy("record_identifier", "endpoint_name", "record_id")


def errors(events: DataFrame, runs: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Events with an error. `id` is the run's, as readers of the report know it; event_id is the event's."""
    r = runs.select(F.col("id").alias("harvest_run_id"), "status")
    found = events.filter("error_message IS NOT NULL").join(r, "harvest_run_id").join(named(endpoints), "endpoint_id")
    return found.select(F.col("id").alias("event_id"), F.col("harvest_run_id").alias("id"), "record_identifier", "error_message", "status", "endpoint_name")


def summary(events: DataFrame, runs: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Events by endpoint, with and without error; counted by run and endpoint first."""
    failed = F.col("error_message").isNotNull()
    counts = events.groupBy("harvest_run_id", "endpoint_id").agg(F.count("*").alias("n"), F.count_if(failed).alias("bad"))
    found = counts.join(runs.select(F.col("id").alias("harvest_run_id")), "harvest_run_id").join(named(endpoints), "endpoint_id")
    out = found.groupBy("endpoint_name").agg(F.sum("n").alias("total_harvest_events"), F.sum(F.col("n") - F.col("bad")).alias("without_error"), F.sum("bad").alias("with_error"))
    return out.orderBy(F.col("total_harvest_events").desc(), "endpoint_name")


def events_summary(events: DataFrame, endpoints: DataFrame, repositories: DataFrame) -> DataFrame:
    counts = events.groupBy("endpoint_id", "repository_id").agg(F.count("*").alias("n"))
    r = repositories.select(F.col("id").alias("repository_id"), F.col("name").alias("repository_name"))
    return counts.join(named(endpoints), "endpoint_id").join(r, "repository_id").groupBy("endpoint_name", "repository_name").agg(F.sum("n").alias("event_count"))


def records_statistics(records: DataFrame, endpoints: DataFrame, repositories: DataFrame) -> DataFrame:
    r = repositories.select(F.col("id").alias("repository_id"), F.col("name").alias("repository_name"))
    found = records.join(named(endpoints), "endpoint_id").join(r, "repository_id")
    return found.groupBy("repository_name", "endpoint_name", "resource_type").agg(
        F.count("*").alias("record_count"), F.countDistinct("doi").alias("unique_dois"), F.count(F.when(F.col("opensearch_synced"), 1)).alias("synced_count"), F.max("updated_at").alias("last_updated")
    )


def totals(summary_rows: DataFrame, record_rows: DataFrame) -> DataFrame:
    """One row: total_events, total_records."""
    a = summary_rows.agg(F.coalesce(F.sum("total_harvest_events"), F.lit(0)).alias("total_events"))
    b = record_rows.agg(F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_records"))
    return a.join(b)


def shares(record_rows: DataFrame) -> DataFrame:
    """record_rows with each endpoint's percentage of all records."""
    whole = record_rows.agg(F.sum("record_count").alias("_total"))
    return record_rows.join(F.broadcast(whole)).withColumn("percent", percent_of(F.col("record_count"), F.col("_total"), 1)).drop("_total")  # one row


def success_rates(summary_rows: DataFrame) -> DataFrame:
    return summary_rows.withColumn("success_rate", percent_of(F.col("without_error"), F.col("total_harvest_events"), 2))


def error_texts(bad: DataFrame) -> DataFrame:
    """(value) of the report's error entries, each of several lines, in the report's order: sorted by ranges, so that no task has all."""
    text = F.concat_ws("\n", F.concat(F.lit("**"), "endpoint_name", F.lit("** (ID: `"), "id", F.lit("` | Identifier: `"), "record_identifier", F.lit("`)")), F.lit(""), F.lit("```"), "error_message", F.lit("```"), F.lit(""))
    return bad.orderBy("endpoint_name", "event_id").select(text.alias("value"))


def duplicate_texts(twice: DataFrame) -> DataFrame:
    """(value) of the report's entries of duplicates; the first of an identifier has its heading."""
    order = ["endpoint_name", "record_id"]
    first = F.row_number().over(Window.partitionBy("record_identifier").orderBy(*order)) == 1  # a row for each endpoint that has the identifier
    line = F.concat(F.lit("- `"), "endpoint_name", F.lit("` (ID: `"), "record_id", F.lit("`)"))
    text = F.when(F.col("first"), F.concat(F.lit("\n**"), "record_identifier", F.lit("**\n\n"), line)).otherwise(line)
    return twice.withColumn("first", first).orderBy("record_identifier", *order).select(text.alias("value"))


def write_report(tables: dict[str, DataFrame], path: str, generated_at: str, database: str, period: str = "Latest harvest run") -> None:
    """The text of render() as a file. Errors and duplicates are written by tasks, in order, and their files joined; only the rows for each endpoint come to the driver."""
    spark = tables["records"].sparkSession
    counts = records_per_endpoint(tables["records"], tables["endpoints"]).collect()
    events = summary(tables["harvest_events"], tables["harvest_runs"], tables["endpoints"]).collect()
    with Scratch(spark) as scratch:
        bad = scratch.keep(errors(tables["harvest_events"], tables["harvest_runs"], tables["endpoints"]), "errors")
        twice = scratch.keep(duplicates(tables["records"], tables["endpoints"]), "duplicates")
        sections = [scratch.path("error-texts"), scratch.path("duplicate-texts")]
        error_texts(bad).write.text(sections[0])
        duplicate_texts(twice).write.text(sections[1])
        before, between, after = frame(counts, events, bad.count(), twice.count(), generated_at, database, period)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        target = jvm.org.apache.hadoop.fs.Path(path)
        out = target.getFileSystem(conf).create(target, True)
        try:
            for text, section in ((before, sections[0]), (between, sections[1]), (after, None)):
                out.write(("\n".join(text) + ("\n" if section else "")).encode())
                if section is None:
                    break
                where = jvm.org.apache.hadoop.fs.Path(section)
                store = where.getFileSystem(conf)
                for part in sorted(f.getPath().toString() for f in store.listStatus(where) if f.getPath().getName().startswith("part-")):  # a file for each task of the sort
                    source = store.open(jvm.org.apache.hadoop.fs.Path(part))
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)  # in small pieces
                    source.close()
        finally:
            out.close()


def frame(counts: list, events: list, n_bad: int, n_twice: int, generated_at: str, database: str, period: str) -> tuple[list[str], list[str], list[str]]:
    """The lines before the errors, between them and the duplicates, and after those. counts and events: a row for each endpoint."""
    n_records, n_events = sum(r["record_count"] for r in counts), sum(r["total_harvest_events"] for r in events)
    lines = ["# Harvest Report", "", f"Generated at: **{generated_at}**", "", "---", "", "## Summary Statistics", ""]
    for label, n in (("Total Records Harvested", n_records), ("Total Endpoints", len(events)), ("Harvest Events", n_events), ("Errors", n_bad), ("Duplicates", n_twice)):
        lines.append(f"- **{label}:** {n}")
    lines += ["", "---", "", "## Records per Endpoint", "", "| Endpoint | Records | % of Total |", "|----------|---------|-----------|"]
    lines += [f"| {r['endpoint_name']} | {r['record_count']} | {round(r['record_count'] / n_records * 100, 1) if n_records else 0}% |" for r in counts]
    lines += ["", "---", "", "## Harvest Summary", "", "| Endpoint | Total Events | Successful | Failed | Success Rate |", "|----------|--------------|-----------|--------|--------------|"]
    for r in events:
        n = r["total_harvest_events"]
        lines.append(f"| {r['endpoint_name']} | {n} | {r['without_error']} | {r['with_error']} | {f'{round(r["without_error"] / n * 100, 2)}%' if n else '—'} |")
    lines += ["", "---", "", "## Data Quality Issues", "", f"### Errors ({n_bad})", ""]
    lines += ["The following validation errors were detected during harvest:", ""] if n_bad else ["✓ _No errors detected._", ""]
    between = [f"### Duplicates ({n_twice})", ""]
    between += ["The following record identifiers appear in multiple endpoints:", ""] if n_twice else ["✓ _No duplicates detected._", ""]
    after = ["", "---", "", "## Report Metadata", "", f"- **Generated:** {generated_at}", f"- **Database:** {database}", f"- **Report Period:** {period}", ""]
    return lines, between, after


def render(tables: dict[str, DataFrame], generated_at: str, database: str, period: str = "Latest harvest run") -> str:
    """The report as Markdown, for few errors and duplicates, which all come to the driver; write_report() is for any number."""
    counts = records_per_endpoint(tables["records"], tables["endpoints"]).collect()
    events = summary(tables["harvest_events"], tables["harvest_runs"], tables["endpoints"]).collect()
    bad = [r["value"] for r in error_texts(errors(tables["harvest_events"], tables["harvest_runs"], tables["endpoints"])).collect()]
    twice = [r["value"] for r in duplicate_texts(duplicates(tables["records"], tables["endpoints"])).collect()]
    before, between, after = frame(counts, events, len(bad), len(twice), generated_at, database, period)
    return "\n".join([*before, *bad, *between, *twice, *after])
