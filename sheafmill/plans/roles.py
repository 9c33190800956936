"""The relational tables played by the driver's tables, as SQL that Spark and DuckDB both read.

repository = region, endpoint = nation, run = order, event = event, record = document. `@name@` stands for a driver table.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

ROLES = {
    "repositories": """
        SELECT CAST(r_regionkey AS STRING) AS id, r_name AS name, upper(substr(r_name, 1, 3)) AS code, concat('about ', r_name) AS description,
               concat('https://', lower(replace(r_name, ' ', '-')), '.example') AS base_url, r_regionkey <> 4 AS is_active
        FROM @region@""",
    "endpoints": """
        SELECT CAST(n_nationkey AS STRING) AS id, CAST(n_regionkey AS STRING) AS repository_id, n_name AS name, concat('https://oai.example/', CAST(n_nationkey AS STRING)) AS harvest_url,
               'OAI-PMH' AS protocol, 'Multidisciplinary' AS scientific_discipline,
               concat('{"metadata_prefix": "oai_datacite", "set": ["s', CAST(n_nationkey AS STRING), '"]}') AS harvest_params, n_nationkey <> 7 AS is_active
        FROM @nation@""",
    "harvest_runs": """
        SELECT CAST(o_orderkey AS STRING) AS id, CAST(c_nationkey AS STRING) AS endpoint_id, o_orderdate AS started_at, o_orderdate AS completed_at,
               CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'closed' ELSE 'failed' END AS status, o_orderdate AS from_date, o_orderdate AS until_date
        FROM @orders@ JOIN @customer@ ON o_custkey = c_custkey""",
    "harvest_events": """
        SELECT CAST(event_id AS STRING) AS id, CAST(n_regionkey AS STRING) AS repository_id, CAST(n_nationkey AS STRING) AS endpoint_id, CAST(event_id AS STRING) AS harvest_run_id,
               concat('oai:', CAST(user_id AS STRING)) AS record_identifier, props AS additional_metadata, ts AS datestamp,
               CASE WHEN event_type = 'error' THEN concat('failed: ', props) END AS error_message, event_type = 'purchase' AS is_deleted
        FROM @events@ JOIN @customer@ ON user_id = c_custkey JOIN @nation@ ON c_nationkey = n_nationkey""",
    "records": """
        SELECT concat(CAST(n_nationkey AS STRING), '::oai:', md5(text)) AS id, CAST(n_nationkey AS STRING) AS endpoint_id, CAST(n_regionkey AS STRING) AS repository_id, concat('oai:', md5(text)) AS record_identifier,
               CASE lang WHEN 'en' THEN 'Dataset' WHEN 'fr' THEN 'Text' ELSE 'Other' END AS resource_type, CASE WHEN lang = 'en' THEN concat('10.1/', md5(text)) END AS doi,
               CASE WHEN lang <> 'en' THEN concat('https://doc.example/', CAST(doc_id AS STRING)) END AS url, text AS title, source <> 'src0' AS opensearch_synced, n_chars AS updated_at
        FROM @documents@ JOIN @nation@ ON n_nationkey = doc_id % 25""",
}


def tables_in(sql: str) -> list[str]:
    return sorted(set(sql.split("@")[1::2]))


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A role's table in Spark."""
    sql = ROLES[name]
    for table in tables_in(sql):
        view = f"sheafmill_{table}_{hashlib.md5(sf_dir.encode()).hexdigest()[:12]}"
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(view)
        sql = sql.replace(f"@{table}@", view)
    return spark.sql(sql)


def with_roles(*names: str, sql: str, more: str = "") -> str:
    """SQL for DuckDB: the roles as common table expressions before a query."""
    parts = [f"{n} AS ({ROLES[n].replace('@', '')})" for n in names] + ([more] if more else [])
    return f"WITH {', '.join(parts)} {sql}" if parts else sql
