"""The query catalogue: every query over the driver tables, with the SQL that states its result."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafmill.functions.documents import document_json, drop_empty, embedding_text, index_action, json_params
from sheafmill.functions.scalars import format_timestamp, make_id, normalize_date, normalize_lang, record_id
from sheafmill.operators import merge, runs, search, validate, xml
from sheafmill.operators.embed import embed
from sheafmill.plans import changes, reports
from sheafmill.plans.roles import role, with_roles
from sheafmill.session import keep, shared_root, spread
from sheafmill.sources import harvest
from sheafmill.sources.commits import Log, Transaction
from sheafmill.sources.tables import conform

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name == "documents" else df  # work on whole texts is worth all cores


# Reports and views.


@query(with_roles("endpoints", "repositories", sql="""SELECT e.id AS endpoint_id, e.name AS endpoint_name, harvest_url, protocol, scientific_discipline, r.name AS repository_name, r.code AS repository_code, r.base_url AS repository_url
    FROM endpoints e JOIN repositories r ON e.repository_id = r.id WHERE e.is_active AND r.is_active"""))
def active_endpoints(spark, sf_dir):
    return runs.active_endpoints(role(spark, sf_dir, "endpoints"), role(spark, sf_dir, "repositories"))


_SUMMARY = """SELECT e.name AS endpoint_name, count(*) AS total_harvest_events, count(*) FILTER (WHERE he.error_message IS NULL) AS without_error, count(*) FILTER (WHERE he.error_message IS NOT NULL) AS with_error
    FROM harvest_events he JOIN harvest_runs hr ON he.harvest_run_id = hr.id JOIN endpoints e ON he.endpoint_id = e.id GROUP BY e.name"""
_COUNTS = "SELECT e.name AS endpoint_name, count(r.id) AS record_count FROM records r JOIN endpoints e ON r.endpoint_id = e.id GROUP BY e.name"


def _summary(spark, sf_dir):
    return reports.summary(*(role(spark, sf_dir, t) for t in ("harvest_events", "harvest_runs", "endpoints")))


def _counts(spark, sf_dir):
    return reports.records_per_endpoint(role(spark, sf_dir, "records"), role(spark, sf_dir, "endpoints"))


@query(with_roles("harvest_events", "harvest_runs", "endpoints", sql=_SUMMARY))
def harvest_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


@query(with_roles("harvest_events", "harvest_runs", "endpoints", sql="""SELECT he.id AS event_id, hr.id AS id, record_identifier, error_message, hr.status AS status, e.name AS endpoint_name
    FROM harvest_events he JOIN harvest_runs hr ON he.harvest_run_id = hr.id JOIN endpoints e ON he.endpoint_id = e.id WHERE error_message IS NOT NULL"""))
def error_events(spark, sf_dir):
    return reports.errors(*(role(spark, sf_dir, t) for t in ("harvest_events", "harvest_runs", "endpoints")))


@query(with_roles("records", "endpoints", sql=_COUNTS))
def records_per_endpoint(spark, sf_dir):
    return _counts(spark, sf_dir)


@query(with_roles("records", "endpoints", sql="""SELECT r.record_identifier, r.id AS record_id, e.name AS endpoint_name FROM records r JOIN endpoints e ON r.endpoint_id = e.id
    WHERE r.record_identifier IN (SELECT record_identifier FROM records GROUP BY record_identifier HAVING count(*) > 1)"""))
def duplicate_identifiers(spark, sf_dir):
    return reports.duplicates(role(spark, sf_dir, "records"), role(spark, sf_dir, "endpoints"))


@query(with_roles("harvest_events", "endpoints", "repositories", sql="""SELECT e.name AS endpoint_name, r.name AS repository_name, count(*) AS event_count
    FROM harvest_events he JOIN endpoints e ON he.endpoint_id = e.id JOIN repositories r ON he.repository_id = r.id GROUP BY e.name, r.name"""))
def events_summary(spark, sf_dir):
    return reports.events_summary(*(role(spark, sf_dir, t) for t in ("harvest_events", "endpoints", "repositories")))


@query(with_roles("records", "endpoints", "repositories", sql="""SELECT r.name AS repository_name, e.name AS endpoint_name, rec.resource_type, count(*) AS record_count, count(DISTINCT rec.doi) AS unique_dois,
    count(CASE WHEN rec.opensearch_synced THEN 1 END) AS synced_count, max(rec.updated_at) AS last_updated
    FROM records rec JOIN endpoints e ON rec.endpoint_id = e.id JOIN repositories r ON rec.repository_id = r.id GROUP BY r.name, e.name, rec.resource_type"""))
def records_statistics(spark, sf_dir):
    return reports.records_statistics(*(role(spark, sf_dir, t) for t in ("records", "endpoints", "repositories")))


@query(with_roles("harvest_events", "harvest_runs", "endpoints", "records", sql=f"""SELECT CAST((SELECT sum(total_harvest_events) FROM ({_SUMMARY})) AS BIGINT) AS total_events, CAST((SELECT sum(record_count) FROM ({_COUNTS})) AS BIGINT) AS total_records"""))
def report_totals(spark, sf_dir):
    return reports.totals(_summary(spark, sf_dir), _counts(spark, sf_dir))


@query(with_roles("records", "endpoints", sql=f"SELECT endpoint_name, record_count, round(record_count * 100 / CAST(sum(record_count) OVER () AS DOUBLE), 1) AS percent FROM ({_COUNTS})"))
def pct_of_total(spark, sf_dir):
    return reports.shares(_counts(spark, sf_dir))


@query(with_roles("harvest_events", "harvest_runs", "endpoints", sql=f"SELECT *, round(without_error * 100 / CAST(total_harvest_events AS DOUBLE), 2) AS success_rate FROM ({_SUMMARY})"))
def success_rate(spark, sf_dir):
    return reports.success_rates(_summary(spark, sf_dir))


# Runs.

_RUN = "harvest_url, hr.id, status, from_date, until_date, started_at, completed_at"


@query(with_roles("harvest_runs", "endpoints", sql=f"SELECT {_RUN} FROM harvest_runs hr JOIN endpoints e ON hr.endpoint_id = e.id WHERE harvest_url = 'https://oai.example/3' ORDER BY until_date DESC, hr.id DESC LIMIT 1"))
def latest_run_for_endpoint(spark, sf_dir):
    return runs.latest_run(role(spark, sf_dir, "harvest_runs"), role(spark, sf_dir, "endpoints"), "https://oai.example/3")


@query(with_roles("harvest_runs", "endpoints", sql="""SELECT harvest_url, hr.id, status, from_date, until_date, started_at, completed_at FROM endpoints e
    JOIN LATERAL (SELECT * FROM harvest_runs WHERE endpoint_id = e.id ORDER BY until_date DESC, id DESC LIMIT 1) hr ON true"""))
def latest_run_per_endpoint(spark, sf_dir):
    return runs.latest_runs(role(spark, sf_dir, "harvest_runs"), role(spark, sf_dir, "endpoints"))


@query(with_roles("harvest_runs", "endpoints", sql="SELECT harvest_url, (SELECT max(until_date) FROM harvest_runs hr WHERE hr.endpoint_id = e.id AND status = 'closed') AS from_date FROM endpoints e"))
def next_run_from_date(spark, sf_dir):
    return runs.next_run_from_date(role(spark, sf_dir, "harvest_runs"), role(spark, sf_dir, "endpoints"))


@query(with_roles("harvest_runs", "endpoints", "repositories", sql="""SELECT hr.id, from_date, until_date, e.name, harvest_url, harvest_params, protocol, code
    FROM harvest_runs hr JOIN endpoints e ON hr.endpoint_id = e.id JOIN repositories r ON e.repository_id = r.id WHERE status = 'open'"""))
def open_runs(spark, sf_dir):
    return runs.open_runs(*(role(spark, sf_dir, t) for t in ("harvest_runs", "endpoints", "repositories")))


@query(with_roles("harvest_runs", sql="SELECT id, endpoint_id, status FROM harvest_runs WHERE status <> 'open'"))
def closed_runs(spark, sf_dir):
    return runs.closed_runs(role(spark, sf_dir, "harvest_runs"))


@query(with_roles("harvest_runs", sql="""SELECT hr.id, CASE WHEN status = 'open' AND e.event_id IS NOT NULL THEN CASE WHEN event_type = 'error' THEN 'failed' ELSE 'closed' END ELSE status END AS status,
    CASE WHEN status = 'open' AND e.event_id IS NOT NULL THEN ts ELSE completed_at END AS completed_at FROM harvest_runs hr LEFT JOIN events e ON hr.id = CAST(e.event_id AS VARCHAR)"""))
def close_run(spark, sf_dir):
    requests = _read(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("id"), (F.col("event_type") != "error").alias("success"), F.col("ts").alias("started_at"), F.col("ts").alias("completed_at"))
    return runs.close_runs(role(spark, sf_dir, "harvest_runs"), requests).select("id", "status", "completed_at")


@query(with_roles("harvest_events", "harvest_runs", "endpoints", "repositories", sql="""SELECT he.id, he.repository_id, code, he.endpoint_id, harvest_url, record_identifier, additional_metadata, is_deleted, datestamp
    FROM harvest_events he JOIN harvest_runs hr ON he.harvest_run_id = hr.id JOIN endpoints e ON he.endpoint_id = e.id JOIN repositories r ON he.repository_id = r.id WHERE status = 'closed'"""))
def event_batch_scan(spark, sf_dir):
    found = runs.event_scan(*(role(spark, sf_dir, t) for t in ("harvest_events", "harvest_runs", "endpoints", "repositories")))
    return found.select("id", "repository_id", "code", "endpoint_id", "harvest_url", "record_identifier", "additional_metadata", "is_deleted", "datestamp")


@query("SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 125) AS BIGINT) AS batch_no FROM documents")
def batch_assignment(spark, sf_dir):
    return runs.assign_batches(_read(spark, sf_dir, "documents").select("doc_id"), ["doc_id"])


_REQUESTS = """requests AS (SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_type = 'click' THEN 'NO' ELSE upper(substr(r_name, 1, 3)) END AS repo_code,
      concat('https://oai.example/', CAST(user_id % 30 AS VARCHAR)) AS harvest_url, CAST(user_id AS VARCHAR) AS harvest_run_id, event_type AS record_identifier
    FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
  looked AS (SELECT q.*, r.id AS repository_id, e.id AS endpoint_id, hr.id AS open_id, row_number() OVER (PARTITION BY e.id, q.harvest_run_id, q.record_identifier ORDER BY q.id) AS n
    FROM requests q LEFT JOIN repositories r ON r.code = q.repo_code LEFT JOIN endpoints e ON e.harvest_url = q.harvest_url LEFT JOIN harvest_runs hr ON hr.id = q.harvest_run_id AND hr.status = 'open')"""


@query(with_roles("repositories", "endpoints", "harvest_runs", more=_REQUESTS, sql="""SELECT id, repository_id, endpoint_id, CASE WHEN repository_id IS NULL THEN 'unknown repository' WHEN endpoint_id IS NULL THEN 'unknown endpoint'
    WHEN open_id IS NULL THEN 'no open run' WHEN n > 1 THEN 'duplicate' END AS reason FROM looked"""))
def register_event(spark, sf_dir):
    e, c, n, r = (_read(spark, sf_dir, t) for t in ("events", "customer", "nation", "region"))
    rows = e.join(c, F.col("user_id") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    requests = rows.select(
        F.col("event_id").cast("string").alias("id"), F.when(F.col("event_type") == "click", "NO").otherwise(F.upper(F.substring("r_name", 1, 3))).alias("repo_code"),
        F.concat(F.lit("https://oai.example/"), (F.col("user_id") % 30).cast("string")).alias("harvest_url"), F.col("user_id").cast("string").alias("harvest_run_id"), F.col("event_type").alias("record_identifier"),
    )
    none = requests.select("harvest_run_id", "record_identifier", F.lit("").alias("endpoint_id")).limit(0)
    return runs.register_events(none, requests, role(spark, sf_dir, "harvest_runs"), role(spark, sf_dir, "endpoints"), role(spark, sf_dir, "repositories")).select("id", "repository_id", "endpoint_id", "reason")


# Merges.


@query("SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT DISTINCT s_suppkey, s_name FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer)")
def insert_ignore(spark, sf_dir):
    current = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    return merge.insert_ignore(current, _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")), ["key"])


_CURRENT = "SELECT 'e::' || CAST(doc_id AS VARCHAR) AS id, 'e' AS endpoint_id, CAST(doc_id AS VARCHAR) AS record_identifier, lang AS resource_type, text AS title, CAST(1 AS INTEGER) AS version, n_chars AS updated_at FROM documents"


def _current(spark, sf_dir):
    key = F.col("doc_id").cast("string")
    return _read(spark, sf_dir, "documents").select(
        record_id(F.lit("e"), key).alias("id"), F.lit("e").alias("endpoint_id"), key.alias("record_identifier"), F.col("lang").alias("resource_type"), F.col("text").alias("title"), F.lit(1).alias("version"), F.col("n_chars").alias("updated_at")
    )


@query(f"""WITH c AS ({_CURRENT}), n AS (SELECT CAST(page_id AS VARCHAR) AS record_identifier, url AS title, CAST(2 AS INTEGER) AS version FROM pages)
  SELECT 'e::' || coalesce(c.record_identifier, n.record_identifier) AS id, coalesce(c.record_identifier, n.record_identifier) AS record_identifier, CASE WHEN n.record_identifier IS NULL THEN c.resource_type ELSE 'page' END AS resource_type,
    CASE WHEN n.record_identifier IS NULL THEN c.title ELSE n.title END AS title, coalesce(c.version, n.version) AS version,
    CASE WHEN n.record_identifier IS NULL THEN c.updated_at WHEN c.record_identifier IS NULL THEN CAST(5 AS BIGINT) ELSE CAST(7 AS BIGINT) END AS updated_at
  FROM c FULL JOIN n ON c.record_identifier = n.record_identifier""")
def upsert_records(spark, sf_dir):
    changes = _read(spark, sf_dir, "pages").select(F.lit("e").alias("endpoint_id"), F.col("page_id").cast("string").alias("record_identifier"), F.lit("page").alias("resource_type"), F.col("url").alias("title"), F.lit(2).alias("version"), F.lit(5).cast("long").alias("updated_at"))
    return merge.upsert_records(_current(spark, sf_dir), changes, F.lit(7).cast("long")).drop("endpoint_id")


@query(f"SELECT * FROM ({_CURRENT}) WHERE record_identifier NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE toxic = 1)")
def delete_by_key(spark, sf_dir):
    gone = _read(spark, sf_dir, "labels").filter("toxic = 1").select(F.col("doc_id").cast("string").alias("record_identifier"))
    return merge.delete_by_key(_current(spark, sf_dir), gone, ["record_identifier"])


@query(with_roles("harvest_events", sql="""SELECT he.id, CASE WHEN l.doc_id IS NULL THEN error_message WHEN quality = 0 THEN 'bad' END AS error_message FROM harvest_events he LEFT JOIN labels l ON he.id = CAST(l.doc_id AS VARCHAR)"""))
def error_merge(spark, sf_dir):
    results = _read(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"), F.when(F.col("quality") == 0, "bad").alias("message"))
    return merge.merge_errors(role(spark, sf_dir, "harvest_events"), results).select("id", "error_message")


@query(with_roles("repositories", "endpoints", "harvest_runs", "harvest_events", "records", more="""gone_e AS (SELECT id FROM endpoints WHERE repository_id = '2'), gone_r AS (SELECT id FROM harvest_runs WHERE endpoint_id IN (SELECT id FROM gone_e))""", sql="""
    SELECT 'repositories' AS table_name, count(*) AS kept FROM repositories WHERE id <> '2' UNION ALL SELECT 'endpoints', count(*) FROM endpoints WHERE id NOT IN (SELECT id FROM gone_e)
    UNION ALL SELECT 'harvest_runs', count(*) FROM harvest_runs WHERE id NOT IN (SELECT id FROM gone_r)
    UNION ALL SELECT 'harvest_events', count(*) FROM harvest_events WHERE repository_id <> '2' AND endpoint_id NOT IN (SELECT id FROM gone_e) AND harvest_run_id NOT IN (SELECT id FROM gone_r)
    UNION ALL SELECT 'records', count(*) FROM records WHERE id NOT IN (SELECT id FROM records WHERE repository_id = '2' OR endpoint_id IN (SELECT id FROM gone_e))"""))
def cascade_delete(spark, sf_dir):
    tables = {t: role(spark, sf_dir, t) for t in ("repositories", "endpoints", "harvest_runs", "harvest_events", "records")}
    kept = merge.cascade_delete(tables, "repositories", tables["repositories"].filter("id = '2'"))
    out = None
    for name, df in kept.items():
        one = df.agg(F.count("*").alias("kept")).select(F.lit(name).alias("table_name"), "kept")
        out = one if out is None else out.unionByName(one)
    return out


_UNIQUE = "SELECT '{0} unique {1}{3}' AS \"constraint\", CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS violations FROM (SELECT count(*) AS n FROM {0} {2} GROUP BY {1} HAVING count(*) > 1)"
_AUDIT = [
    *(_UNIQUE.format("repositories", k, "", "") for k in ("id", "name", "code")),
    *(_UNIQUE.format("endpoints", k, "", "") for k in ("id", "harvest_url", "name", "repository_id,name")),
    _UNIQUE.format("harvest_runs", "id", "", ""),
    _UNIQUE.format("harvest_runs", "endpoint_id", "WHERE status = 'open'", " where status = ''open''"),
    "SELECT 'endpoints foreign repository_id', count(*) FROM endpoints WHERE repository_id NOT IN (SELECT id FROM repositories)",
    "SELECT 'harvest_runs foreign endpoint_id', count(*) FROM harvest_runs WHERE endpoint_id NOT IN (SELECT id FROM endpoints)",
    "SELECT 'endpoints enum protocol', count(*) FROM endpoints WHERE protocol NOT IN ('OAI-PMH', 'REST_API')",
    "SELECT 'harvest_runs enum status', count(*) FROM harvest_runs WHERE status NOT IN ('open', 'closed', 'failed')",
    *(f"SELECT '{t} length {c}', count(*) FROM {t} WHERE length({c}) > {n}" for t, c, n in (("repositories", "name", 255), ("repositories", "code", 50), ("repositories", "base_url", 500), ("endpoints", "name", 255), ("endpoints", "harvest_url", 500), ("endpoints", "scientific_discipline", 255))),
]


@query(with_roles("repositories", "endpoints", "harvest_runs", sql=" UNION ALL ".join(_AUDIT)))
def constraint_audit(spark, sf_dir):
    return merge.audit({t: role(spark, sf_dir, t) for t in ("repositories", "endpoints", "harvest_runs")})


# Scalars.

@query("""SELECT o_orderkey, CASE o_orderkey % 9 WHEN 1 THEN strftime(o_orderdate, '%Y-%m') || '-01' WHEN 2 THEN strftime(o_orderdate, '%Y') || '-01-01' WHEN 5 THEN strftime(o_orderdate, '%Y') || '-01-01'
    WHEN 7 THEN CASE WHEN year(o_orderdate) % 100 > 0 THEN CAST(year(o_orderdate) % 100 AS VARCHAR) || strftime(o_orderdate, '-%m-%d') END WHEN 8 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS normalized FROM orders""")
def date_normalize(spark, sf_dir):
    o = F.col("o_orderdate")
    kinds = ["yyyy-MM-dd", "yyyy-MM", "yyyy", "yyyy-M-d", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/yyyy-MM", "yyyy-MM-dd HH:mm:ss", "yy-MM-dd", "yyyy-'13'-dd"]
    text = F.date_format(o, kinds[-1])
    for i, k in enumerate(kinds[:-1]):
        text = F.when(F.col("o_orderkey") % 9 == i, F.date_format(o, k)).otherwise(text)
    return _read(spark, sf_dir, "orders").select("o_orderkey", normalize_date(text).alias("normalized"))


@query("SELECT doc_id, CASE WHEN length(l) > 2 THEN substr(l, 1, 2) ELSE l END AS lang FROM (SELECT doc_id, CASE WHEN source = 'src1' THEN upper(lang) ELSE lang || source END AS l FROM documents)")
def lang_normalize(spark, sf_dir):
    given = F.when(F.col("source") == "src1", F.upper("lang")).otherwise(F.concat("lang", "source"))
    return _read(spark, sf_dir, "documents").select("doc_id", normalize_lang(given).alias("lang"))


@query(with_roles("records", sql="SELECT record_identifier, endpoint_id, coalesce('https://doi.org/' || doi, url) AS id FROM records"))
def make_id_query(spark, sf_dir):
    return role(spark, sf_dir, "records").select("record_identifier", "endpoint_id", make_id(F.col("doi"), F.col("url")).alias("id"))


@query(with_roles("records", sql="SELECT endpoint_id || '::' || record_identifier AS id FROM records"))
def record_id_query(spark, sf_dir):
    return role(spark, sf_dir, "records").select(record_id(F.col("endpoint_id"), F.col("record_identifier")).alias("id"))


for _name in ("make_id", "record_id"):
    QUERIES[_name], SQL[_name] = QUERIES.pop(f"{_name}_query"), SQL.pop(f"{_name}_query")


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '+0000' AS stamp FROM events")
def ts_format(spark, sf_dir):
    return _read(spark, sf_dir, "events").select("event_id", format_timestamp(F.col("ts"), "+0000").alias("stamp"))


# XML, made from documents.


def _escaped(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def xml_records(spark, sf_dir) -> DataFrame:
    """Records in three layouts, by language; documents of src1 are cut off before the end, those of src2 have no resource."""
    kind = F.when(F.col("lang") == "de", "URL").when(F.col("lang") == "fr", "URN").otherwise("DOI")
    resource = F.concat(
        F.lit('<resource xmlns="http://datacite.org/schema/kernel-4"><identifier identifierType="'), kind, F.lit('">id/'), F.col("doc_id").cast("string"), F.lit('</identifier><titles><title xml:lang="'), F.concat("lang", F.lit("x")),
        F.lit('">'), F.col("source"), F.lit("</title><title titleType=\"Subtitle\">second</title></titles><creators><creator><creatorName nameType=\"Personal\">"), F.concat(F.lit("name "), F.col("source")), F.lit("</creatorName><givenName>given</givenName></creator></creators><publicationYear>"),
        F.lit("2024</publicationYear><subjects><subject>"), F.col("lang"), F.lit("</subject></subjects><dates><date dateType=\"Issued\">2024-5-7</date></dates><descriptions><description descriptionType=\"Abstract\">"), _escaped(F.col("text")),
        F.lit("</description></descriptions><resourceType resourceTypeGeneral=\"Dataset\"/></resource>"),
    )
    wrapped = F.when(F.col("lang") == "es", F.concat(F.lit('<oai_datacite xmlns="http://schema.datacite.org/oai/oai-1.1/"><payload>'), resource, F.lit("</payload></oai_datacite>"))).otherwise(resource)
    body = F.when(F.col("source") == "src2", F.lit("<other/>")).otherwise(wrapped)
    end = F.when(F.col("source") == "src1", F.lit("")).otherwise(F.lit("</record>"))
    text = F.concat(F.lit('<record xmlns="http://www.openarchives.org/OAI/2.0/"><header><identifier>oai:'), F.col("doc_id").cast("string"), F.lit("</identifier><datestamp>2025-01-01T00:00:00Z</datestamp></header><metadata>"), body, F.lit("</metadata>"), end)
    return _read(spark, sf_dir, "documents").select("doc_id", text.alias("raw_metadata"))


_STATUS = "CASE source WHEN 'src1' THEN 'error' WHEN 'src2' THEN 'skipped' ELSE 'ok' END"
_GOOD = "source NOT IN ('src1', 'src2')"


@query("SELECT doc_id, source <> 'src1' AS well_formed FROM documents")
def xml_wellformed_gate(spark, sf_dir):
    raw = F.col("raw_metadata")
    return xml_records(spark, sf_dir).select("doc_id", xml.well_formed(raw, xml.parse(raw)).alias("well_formed"))


@query("SELECT doc_id, 'oai:' || CAST(doc_id AS VARCHAR) AS record_identifier, '2025-01-01T00:00:00Z' AS datestamp FROM documents WHERE source <> 'src1'")
def xml_header_extract(spark, sf_dir):
    raw, parsed = F.col("raw_metadata"), F.col("p")
    rows = xml_records(spark, sf_dir).withColumn("p", xml.parse(raw))
    identifier, stamp = xml.header(parsed)
    # written before the filter, which would else be pushed below the parse and repeat it
    found = keep(rows.select("doc_id", xml.well_formed(raw, parsed).alias("good"), identifier.alias("record_identifier"), stamp.alias("datestamp")), "headers")
    return found.filter("good").drop("good")


@query(f"SELECT doc_id, {_STATUS} AS status, CASE WHEN {_GOOD} THEN lang = 'es' END AS wrapped FROM documents")
def xml_layout_coalesce(spark, sf_dir):
    rows = xml.normalize(xml_records(spark, sf_dir))
    return rows.select("doc_id", "status", F.when(F.col("status") == "ok", F.col("raw_metadata").contains("<payload>")).alias("wrapped"))


@query(f"""SELECT doc_id, CASE WHEN lang IN ('de', 'fr') THEN '' ELSE 'https://doi.org/' END || 'id/' || CAST(doc_id AS VARCHAR) AS id, source AS title, lang AS title_lang, 'second' AS subtitle, lang AS subject, text AS description, '2024' AS year, '2024-05-07' AS issued, 'Dataset' AS general
    FROM documents WHERE {_GOOD}""")
def xml_normalize(spark, sf_dir):
    doc = keep(xml.normalize(xml_records(spark, sf_dir)), "normalized").filter("status = 'ok'")
    return doc.select("doc_id", "doc.id", F.col("doc.titles")[0]["title"].alias("title"), F.col("doc.titles")[0]["lang"].alias("title_lang"), F.col("doc.titles")[1]["title"].alias("subtitle"), F.col("doc.subjects")[0]["subject"].alias("subject"), F.col("doc.descriptions")[0]["description"].alias("description"),
                      F.col("doc.publicationYear").alias("year"), F.col("doc.dates")[0]["date"].alias("issued"), F.col("doc.types.resourceTypeGeneral").alias("general"))


@query(f"SELECT doc_id, 'name ' || source AS name, 'Personal' AS name_type, 'given' AS given, CAST(NULL AS VARCHAR) AS family FROM documents WHERE {_GOOD}")
def xml_creators(spark, sf_dir):
    doc = keep(xml.normalize(xml_records(spark, sf_dir)), "normalized").filter("status = 'ok'").select("doc_id", F.explode("doc.creators").alias("c"))
    return doc.select("doc_id", F.col("c.creatorName").alias("name"), F.col("c.nameType").alias("name_type"), F.col("c.givenName").alias("given"), F.col("c.familyName").alias("family"))


@query(f"SELECT doc_id, CASE WHEN lang NOT IN ('de', 'fr') THEN 'id/' || CAST(doc_id AS VARCHAR) END AS doi, CASE WHEN lang IN ('de', 'fr') THEN 'id/' || CAST(doc_id AS VARCHAR) END AS url FROM documents WHERE {_GOOD}")
def identifier_pick(spark, sf_dir):
    rows = xml_records(spark, sf_dir).withColumn("r", xml.resource(xml.parse(F.col("raw_metadata"))))
    found = rows.select("doc_id", F.col("r").isNotNull().alias("found"), xml.identifier(F.col("r"), "DOI").alias("doi"), F.coalesce(xml.identifier(F.col("r"), "URL"), xml.identifier(F.col("r"), "URN")).alias("url"))
    return keep(found, "identifiers").filter("found").drop("found")


@query(f"SELECT doc_id, CAST(NULL AS VARCHAR) AS resource_type, 'Dataset' AS general FROM documents WHERE {_GOOD}")
def resource_type_extract(spark, sf_dir):
    rows = xml_records(spark, sf_dir).withColumn("r", xml.resource(xml.parse(F.col("raw_metadata"))))
    kinds = xml.resource_type(F.col("r"))
    found = rows.select("doc_id", F.col("r").isNotNull().alias("found"), kinds["resourceType"].alias("resource_type"), kinds["resourceTypeGeneral"].alias("general"))
    return keep(found, "resource-types").filter("found").drop("found")


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN text END AS kept FROM documents")
def drop_empty_fields(spark, sf_dir):
    given = F.when(F.col("lang") == "en", F.array(F.col("text"))).when(F.col("lang") == "fr", F.array().cast("array<string>"))
    return _read(spark, sf_dir, "documents").select("doc_id", F.get(drop_empty(given), F.lit(0)).alias("kept"))


def _docs(spark, sf_dir) -> DataFrame:
    """Documents as normalised documents, some of which break rules."""
    c = F.col
    doc = F.struct(
        F.concat(F.lit("https://d.example/"), c("doc_id").cast("string")).alias("id"), F.when(c("lang") != "fr", c("source")).alias("doi"), F.when(c("lang") == "de", c("source")).alias("url"),
        F.array(F.struct(c("text").alias("title"), F.when(c("source") == "src3", F.upper("lang")).otherwise(c("lang")).alias("lang"), F.lit(None).cast("string").alias("titleType"))).alias("titles"),
        F.lit(None).alias("subjects"),
        F.when(c("source") != "src4", F.array(F.struct(c("source").alias("creatorName"), *(F.lit(None).cast("string").alias(n) for n in ("nameType", "nameIdentifierScheme", "nameIdentifier", "givenName", "familyName"))))).alias("creators"),
        F.when(c("source") == "src5", "20").otherwise("2024").alias("publicationYear"),
        F.array(F.struct(c("text").alias("description"), F.when(c("source") != "src6", "Abstract").alias("descriptionType"), c("lang").alias("lang"))).alias("descriptions"),
        F.array(F.struct(F.when(c("source") == "src7", "202-05-29").otherwise("2024-01-02").alias("date"), F.lit("Issued").alias("dateType"))).alias("dates"),
        F.struct(F.lit(None).cast("string").alias("resourceType"), F.when(c("source") != "src8", "Dataset").alias("resourceTypeGeneral")).alias("types"),
    ).cast(xml.DOCUMENT_SCHEMA)
    return _read(spark, sf_dir, "documents").withColumn("doc", doc)


@query("""SELECT doc_id, CASE WHEN source = 'src4' THEN '''creators'' is a required property' WHEN lang IN ('fr', 'de') THEN 'exactly one of ''doi'' and ''url'' is required'
    WHEN source = 'src3' THEN '''' || upper(lang) || ''' does not match ''^[a-z]{2}$''' WHEN source = 'src5' THEN '''20'' does not match ''^[0-9]{4}$''' WHEN source = 'src6' THEN '''descriptionType'' is a required property'
    WHEN source = 'src7' THEN '''202-05-29'' does not match ''^[0-9]{4}-[0-9]{2}-[0-9]{2}$''' WHEN source = 'src8' THEN '''resourceTypeGeneral'' is a required property' END AS message FROM documents""")
def validate_document(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", validate.validation_error(F.col("doc")).alias("message"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k, json_extract_string(props, '$.missing') AS missing FROM events")
def json_params_extract(spark, sf_dir):
    props = F.col("props")
    return _read(spark, sf_dir, "events").select("event_id", F.get_json_object(props, "$.k").alias("k"), json_params(props)["metadata_prefix"].alias("missing"))


@query("SELECT doc_id, text || ' ' || text AS embedding_text FROM documents")
def embedding_text_query(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", embedding_text(F.col("doc.titles"), F.col("doc.subjects"), F.col("doc.descriptions")).alias("embedding_text"))


QUERIES["embedding_text"], SQL["embedding_text"] = QUERIES.pop("embedding_text_query"), SQL.pop("embedding_text_query")


@query("SELECT 'index' AS _op_type, CAST(doc_id AS VARCHAR) AS _id, 'docs' AS _index, text AS title FROM documents QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n_chars DESC) = 1")
def bulk_action_envelope(spark, sf_dir):
    docs = search.search_documents(_read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("title"), F.col("n_chars").alias("position")))
    action = index_action(F.col("id"), "docs", F.struct("id", "title"))
    return docs.select(action.alias("a")).select("a._op_type", "a._id", "a._index", F.col("a._source.title").alias("title"))


@query("SELECT doc_id, text AS title, source AS creator FROM documents WHERE source <> 'src4' UNION ALL SELECT doc_id, text, NULL FROM documents WHERE source = 'src4'")
def source_projection(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", F.transform("doc.titles", lambda t: F.struct(t["title"].alias("title"))).alias("titles"), F.transform("doc.creators", lambda c: c["creatorName"]).alias("creators"))
    return rows.select("doc_id", F.get("titles", F.lit(0))["title"].alias("title"), F.get("creators", F.lit(0)).alias("creator"))


@query("""WITH f AS (SELECT DISTINCT c_mktsegment || '_' || CAST(c_nationkey AS VARCHAR) AS stem FROM customer), s AS (SELECT DISTINCT c_mktsegment || '_' || CAST(c_nationkey AS VARCHAR) || '.json' AS side FROM customer)
    SELECT stem || '.oai.xml' AS name, (SELECT CASE WHEN count(*) = 1 THEN min(side) END FROM s WHERE starts_with(side, stem)) AS additional_metadata FROM f""")
def side_file_single_match(spark, sf_dir):
    from sheafmill.sources.harvest import attach_side_file

    stems = _read(spark, sf_dir, "customer").select(F.concat("c_mktsegment", F.lit("_"), F.col("c_nationkey").cast("string")).alias("stem")).distinct()
    side = F.concat("stem", F.lit(".json"))
    return attach_side_file(stems.select(F.concat("stem", F.lit(".oai.xml")).alias("name")), stems.select(side.alias("name"), side.alias("value")))


# Search.


def _nested(spark, sf_dir) -> DataFrame:
    """Customers with their orders as an array of (date, dateType)."""
    return _read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("dateType"), F.col("o_orderstatus").alias("lang"))).alias("dates"))


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def nested_match(spark, sf_dir):
    return search.nested(_nested(spark, sf_dir), "dates", lambda d: d["lang"] == "F").select("o_custkey")


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority LIKE '1%'")
def nested_bool(spark, sf_dir):
    return search.nested(_nested(spark, sf_dir), "dates", lambda d: (d["lang"] == "F") & d["dateType"].startswith("1")).select("o_custkey")


@query("SELECT DISTINCT o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1995-03-01' AND o_orderpriority = '2-HIGH'")
def nested_date_range(spark, sf_dir):
    return search.nested(_nested(spark, sf_dir), "dates", lambda d: (d["date"] <= F.lit("1995-03-01").cast("date")) & (d["dateType"] == "2-HIGH")).select("o_custkey")


@query("SELECT p_type AS key, count(*) AS doc_count FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def facet_resource_types(spark, sf_dir):
    return search.facet(_read(spark, sf_dir, "part"), "p_type")


_TERMS = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda t: t <> '')"


@query(f"SELECT doc_id FROM documents WHERE len(list_filter({_TERMS}, lambda t: starts_with(t, 'th'))) > 0 AND list_contains({_TERMS}, 'and')")
def lexical_prefix(spark, sf_dir):
    return search.query_string(_read(spark, sf_dir, "documents"), "text", "th* and").select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE len(list_filter(list_concat({_TERMS}, [source, lang]), lambda t: starts_with(t, 'src1'))) > 0 AND list_contains(list_concat({_TERMS}, [source, lang]), 'en')")
def lexical_all_fields(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", F.array("text", "source", "lang").alias("_all_fields"))
    return search.query_string(docs, "_all_fields", "src1* en").select("doc_id")


_BM25 = f"""w AS (SELECT doc_id, {_TERMS} AS t FROM documents), c AS (SELECT doc_id, len(t) AS dl, len(list_filter(t, lambda x: x = 'the')) AS a, len(list_filter(t, lambda x: x = 'license')) AS b FROM w),
  g AS (SELECT count(*) AS n, avg(dl) AS mean, count(*) FILTER (WHERE a > 0) AS da, count(*) FILTER (WHERE b > 0) AS db FROM c),
  s AS (SELECT doc_id, ln(1 + (n - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * dl / mean)) + ln(1 + (n - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * dl / mean)) AS score FROM c, g WHERE a > 0 OR b > 0)"""


@query(f"WITH {_BM25} SELECT doc_id, round(score, 6) AS score FROM s")
def bm25_scores(spark, sf_dir):
    return search.bm25(_read(spark, sf_dir, "documents"), "doc_id", "text", ["the", "license"]).select("doc_id", F.round("score", 6).alias("score"))


_KNN = "SELECT vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings ORDER BY vec_id LIMIT 1)) AS score FROM embeddings"


def _first_vector(embeddings: DataFrame) -> list[float]:
    return embeddings.orderBy("vec_id").first()["embedding"]


@query(f"SELECT vec_id, round(score, 6) AS score FROM ({_KNN}) ORDER BY score DESC, vec_id LIMIT 5")
def knn_topk(spark, sf_dir):
    e = _read(spark, sf_dir, "embeddings")
    return search.knn(e, _first_vector(e), field="embedding", key="vec_id").select("vec_id", F.round("score", 6).alias("score"))


@query(f"SELECT vec_id, round(score, 6) AS score FROM ({_KNN} WHERE label >= 3) ORDER BY score DESC, vec_id LIMIT 5")
def knn_filtered(spark, sf_dir):
    e = _read(spark, sf_dir, "embeddings")
    return search.knn(e, _first_vector(e), field="embedding", key="vec_id", where=F.col("label") >= 3).select("vec_id", F.round("score", 6).alias("score"))


# Streaming.


@query("SELECT user_id, event_id, event_type, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def streaming_upsert(spark, sf_dir):
    from sheafmill.streaming.ingest import stream_upsert

    root = f"{shared_root(spark)}/stream-{uuid.uuid4().hex}"
    schema = _read(spark, sf_dir, "events").schema
    table = stream_upsert(spark, sf_dir, "events.parquet", schema, root, "latest", ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], f"{root}/checkpoint")
    return table.select("user_id", "event_id", "event_type", "ts")


@query("SELECT user_id, event_id, event_type, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def streaming_upsert_late(spark, sf_dir):
    """As streaming_upsert, in several micro-batches among which the rows of a user are dealt by hash, so that many come late."""
    from sheafmill.streaming.ingest import stream_upsert

    root = f"{shared_root(spark)}/stream-{uuid.uuid4().hex}"
    events = _read(spark, sf_dir, "events")
    events.repartition(6, F.xxhash64("event_id")).write.parquet(f"{root}/in")
    table = stream_upsert(spark, f"{root}/in", "*.parquet", events.schema, root, "latest", ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], f"{root}/checkpoint", files=2)
    return table.select("user_id", "event_id", "event_type", "ts")


@query("SELECT DISTINCT user_id, event_type FROM events")
def streaming_register(spark, sf_dir):
    """Events come in several micro-batches; of each user and type the stream lets one in, by its keyed state."""
    from sheafmill.streaming.ingest import stream_register

    root = f"{shared_root(spark)}/stream-{uuid.uuid4().hex}"
    events = _read(spark, sf_dir, "events")
    events.repartition(6, F.xxhash64("event_id")).write.parquet(f"{root}/in")
    table = stream_register(spark, f"{root}/in", "*.parquet", events.schema, root, "registered", ["user_id", "event_type"], f"{root}/checkpoint", files=2)
    return table.select("user_id", "event_type")


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE json_contains(props, '{"k": 7}')""")
def json_containment(spark, sf_dir):
    """Events whose properties contain a JSON object, by typed reads of a variant."""
    props = F.try_parse_json("props")
    found = _read(spark, sf_dir, "events").select("event_id", F.try_variant_get(props, "$.k", "long").alias("k"))
    return found.filter("k = 7")


@query("""SELECT doc_id, CASE WHEN source = 'src4' THEN '''title'' is a required property' WHEN source = 'src1' THEN '''subject'' is a required property' WHEN source = 'src2' THEN '''EN'' does not match ''^[a-z]{2}$'''
    WHEN source = 'src3' THEN '''creatorName'' is a required property' WHEN source = 'src5' THEN '''dateType'' is a required property' END AS message FROM documents""")
def validate_elements(spark, sf_dir):
    """The rules on the elements of titles, subjects, creators and dates."""
    c, none = F.col, F.lit(None).cast("string")

    def subject(text, lang):
        return F.struct(text.alias("subject"), lang.alias("lang"), *(none.alias(n) for n in ("subjectScheme", "schemaUri", "valueUri", "classificationCode")))

    doc = F.struct(
        F.lit("x").alias("id"), c("source").alias("doi"), none.alias("url"),
        F.array(F.struct(F.when(c("source") != "src4", c("text")).alias("title"), none.alias("lang"), none.alias("titleType"))).alias("titles"),
        F.array(subject(c("text"), F.lit("en")), subject(F.when(c("source") != "src1", F.lit("s")), F.when(c("source") == "src2", "EN"))).alias("subjects"),
        F.array(F.struct(F.when(c("source") != "src3", c("source")).alias("creatorName"), *(none.alias(n) for n in ("nameType", "nameIdentifierScheme", "nameIdentifier", "givenName", "familyName")))).alias("creators"),
        F.lit("2024").alias("publicationYear"), F.lit(None).alias("descriptions"),
        F.array(F.struct(F.lit("2024-01-02").alias("date"), F.when(c("source") != "src5", "Issued").alias("dateType"))).alias("dates"),
        F.struct(none.alias("resourceType"), F.lit("Dataset").alias("resourceTypeGeneral")).alias("types"),
    ).cast(xml.DOCUMENT_SCHEMA)
    return _read(spark, sf_dir, "documents").select("doc_id", validate.validation_error(doc).alias("message"))


_TABLES = ("repositories", "endpoints", "harvest_runs", "harvest_events", "records")


@query(with_roles(*_TABLES, sql=" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows, true AS complete FROM {t}" for t in _TABLES)))
def warehouse_verify(spark, sf_dir):
    """A warehouse made of the given tables in one commit, and what its check counts."""
    root = f"{shared_root(spark)}/warehouse-{uuid.uuid4().hex}"
    harvest.write_snapshots(spark, root, {t: conform(role(spark, sf_dir, t).withColumns({"raw_metadata": F.lit("<x/>")}), t) for t in _TABLES}, "0")
    complete = harvest.verify(spark, root)["tables"] == len(_TABLES)
    counts = [harvest.read_snapshot(spark, root, t).agg(F.count("*").alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows", F.lit(complete).alias("complete")) for t in _TABLES]
    return reduce(DataFrame.unionByName, counts)


# Tables as buckets of files.


def _stored(spark, sf_dir, buckets: int = 32) -> Log:
    """The records of _current() as a bucketed table."""
    log = Log(spark, f"{shared_root(spark)}/warehouse-{uuid.uuid4().hex}")
    log.transact(lambda t: t.create("records", _current(spark, sf_dir), ["record_identifier"], buckets))
    return log


@query(SQL["upsert_records"])
def upsert_buckets(spark, sf_dir):
    """As upsert_records, into a stored table of which only touched buckets are rewritten."""
    pages = _read(spark, sf_dir, "pages").select(record_id(F.lit("e"), F.col("page_id").cast("string")).alias("id"), F.lit("e").alias("endpoint_id"), F.col("page_id").cast("string").alias("record_identifier"), F.lit("page").alias("resource_type"), F.col("url").alias("title"), F.lit(2).alias("version"), F.lit(5).cast("long").alias("updated_at"))
    log = _stored(spark, sf_dir)
    log.transact(lambda t: changes.upsert(t, "records", pages, ["endpoint_id", "record_identifier"], merge.RECORD_UPDATES, {"updated_at": F.lit(7).cast("long")}))
    return log.state().read("records").drop("endpoint_id")


@query(SQL["delete_by_key"])
def delete_in_buckets(spark, sf_dir):
    gone = _read(spark, sf_dir, "labels").filter("toxic = 1").select(F.col("doc_id").cast("string").alias("record_identifier"))
    log = _stored(spark, sf_dir)
    log.transact(lambda t: changes.delete(t, "records", gone, ["record_identifier"]))
    return log.state().read("records")


@query("SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN quality = 0 THEN 'bad' END AS title FROM (SELECT doc_id, max(quality) AS quality FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id) UNION ALL SELECT CAST(page_id AS VARCHAR) || ':' || page_id % 7, url FROM pages")
def append_and_merge(spark, sf_dir):
    """Two writers at work on one table at once: one adds pages, the other upserts labels; both commits count."""
    log = Log(spark, f"{shared_root(spark)}/warehouse-{uuid.uuid4().hex}")
    rows = _read(spark, sf_dir, "labels").filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality")).select(F.col("doc_id").cast("string").alias("id"), F.when(F.col("quality") == 0, "bad").alias("title"))
    log.transact(lambda t: t.create("labels", rows.withColumn("title", F.lit("none")), ["id"], 32))
    first, second = Transaction(log.state()), Transaction(log.state())
    second.append("labels", _read(spark, sf_dir, "pages").select(F.concat_ws(":", F.col("page_id").cast("string"), F.col("page_id") % 7).alias("id"), F.col("url").alias("title")))
    changes.upsert(first, "labels", rows, ["id"], ["title"])
    for work, writer in ((None, second), (lambda t: changes.upsert(t, "labels", rows, ["id"], ["title"]), first)):
        if not writer.commit():
            log.transact(work)  # it had read what the other has changed
    return log.state().read("labels")


# Documents out, vectors in, ids.


def _json(tail: str) -> str:
    none = lambda name, value, condition: f"CASE WHEN {condition} THEN '\"{name}\":' || to_json({value}) END"
    fields = [
        "'\"id\":' || to_json('https://d.example/' || doc_id)", none("doi", "source", "lang <> 'fr'"), none("url", "source", "lang = 'de'"),
        "'\"titles\":[{\"title\":' || to_json(text) || ',\"lang\":' || to_json(CASE WHEN source = 'src3' THEN upper(lang) ELSE lang END) || '}]'",
        "CASE WHEN source <> 'src4' THEN '\"creators\":[{\"creatorName\":' || to_json(source) || '}]' END", "'\"publicationYear\":' || CASE WHEN source = 'src5' THEN '\"20\"' ELSE '\"2024\"' END",
        "'\"descriptions\":[{\"description\":' || to_json(text) || CASE WHEN source <> 'src6' THEN ',\"descriptionType\":\"Abstract\"' ELSE '' END || ',\"lang\":' || to_json(lang) || '}]'",
        "'\"dates\":[{\"date\":' || CASE WHEN source = 'src7' THEN '\"202-05-29\"' ELSE '\"2024-01-02\"' END || ',\"dateType\":\"Issued\"}]'", "CASE WHEN source <> 'src8' THEN '\"types\":{\"resourceTypeGeneral\":\"Dataset\"}' ELSE '\"types\":{}' END",
    ]
    return f"'{{' || concat_ws(',', {', '.join(fields)}{tail}) || '}}'"


_EXTRA = """, '"_repo":' || to_json(source), '"_additional_metadata":null', '"emb":null'"""


@query(f"SELECT doc_id, {_json(_EXTRA)} AS json FROM documents")
def document_export(spark, sf_dir):
    """Documents as JSON, absent fields left out, `emb` and missing additional metadata as null."""
    repo = F.regexp_extract(F.to_json(F.struct(F.col("source").alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
    return _docs(spark, sf_dir).select("doc_id", document_json(F.col("doc"), {"_repo": repo, "_additional_metadata": F.lit(None).cast("string")}).alias("json"))


@query(f"SELECT {_json('')} AS value FROM documents")
def json_file_sink(spark, sf_dir):
    """Documents written as JSON files, and the lines of the files."""
    path = f"{shared_root(spark)}/documents-{uuid.uuid4().hex}"
    harvest.write_json(_docs(spark, sf_dir).select("doc"), path)
    return spark.read.text(path)


class LetterCounts:
    """An embedder that counts letters."""

    def __call__(self, texts: list[str]) -> list[list[float]]:
        return [[float(t.count(letter)) for letter in "aeiu"] for t in texts]


@query("SELECT doc_id, " + ", ".join(f"CAST(length(text) - length(replace(text, '{x}', '')) AS DOUBLE) AS {x}" for x in "aeiu") + " FROM documents")
def embed_documents(spark, sf_dir):
    """Each document and the vector that a model gives for it."""
    found = embed(_read(spark, sf_dir, "documents").select("doc_id", "text"), "text", LetterCounts)
    return found.select("doc_id", *(F.get("emb", F.lit(i)).alias(x) for i, x in enumerate("aeiu")))


@query("SELECT count(*) AS n, count(*) AS n_distinct, count(*) AS n_well_formed FROM documents")
def generated_ids(spark, sf_dir):
    """A random id for each document, written before it is used, as it differs on each evaluation."""
    ids = keep(_read(spark, sf_dir, "documents").select("doc_id", F.uuid().alias("id")), "ids")
    return ids.agg(F.count("*").alias("n"), F.countDistinct("id").alias("n_distinct"), F.count_if(F.col("id").rlike("^[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}$")).alias("n_well_formed"))


from sheafmill.plans import indexed, kept  # noqa: E402, F401  register their queries too
