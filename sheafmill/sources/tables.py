"""The relational schema: tables, enumerations, constraints and seed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

# Enumerations (fixed values).
HARVEST_PROTOCOL = ["OAI-PMH", "REST_API"]
CONTENT_FORMAT = ["XML", "JSON"]
RUN_STATE = ["open", "closed", "failed"]
RESOURCE_TYPE = [
    "Audiovisual", "Award", "Book", "BookChapter", "Collection", "ComputationalNotebook", "ConferencePaper", "ConferenceProceeding", "DataPaper", "Dataset", "Dissertation",
    "Event", "Image", "InteractiveResource", "Instrument", "Journal", "JournalArticle", "Model", "OutputManagementPlan", "PeerReview", "PhysicalObject", "Preprint",
    "Project", "Report", "Service", "Software", "Sound", "Standard", "StudyRegistration", "Text", "Workflow", "Other",
]

_DDL = {
    "repositories": "id string NOT NULL, name string NOT NULL, code string NOT NULL, description string, base_url string, created_at timestamp NOT NULL, updated_at timestamp NOT NULL, is_active boolean NOT NULL",
    "endpoints": "id string NOT NULL, repository_id string NOT NULL, name string NOT NULL, description string, harvest_url string NOT NULL, protocol string NOT NULL, scientific_discipline string, harvest_params string NOT NULL, created_at timestamp NOT NULL, updated_at timestamp NOT NULL, is_active boolean NOT NULL",
    "harvest_runs": "id string NOT NULL, endpoint_id string NOT NULL, started_at timestamp, completed_at timestamp, status string NOT NULL, records_harvested int NOT NULL, records_created int NOT NULL, records_updated int NOT NULL, records_deleted int NOT NULL, from_date timestamp, until_date timestamp NOT NULL",
    "harvest_events": "id string NOT NULL, repository_id string NOT NULL, endpoint_id string NOT NULL, harvest_run_id string NOT NULL, record_identifier string NOT NULL, raw_metadata string NOT NULL, metadata_format string NOT NULL, metadata_protocol string NOT NULL, additional_metadata string, datestamp timestamp NOT NULL, error_message string, is_deleted boolean NOT NULL",
    "records": "id string NOT NULL, endpoint_id string NOT NULL, repository_id string NOT NULL, record_identifier string NOT NULL, resource_type string NOT NULL, doi string, url string, title string NOT NULL, raw_metadata string NOT NULL, metadata_format string NOT NULL, metadata_protocol string NOT NULL, datacite_json string, additional_metadata string, embeddings array<double>, embedding_model string, datestamp timestamp NOT NULL, version int NOT NULL, opensearch_synced boolean NOT NULL, opensearch_synced_at timestamp, created_at timestamp NOT NULL, updated_at timestamp NOT NULL",
}
_TYPES = {"string": StringType(), "boolean": BooleanType(), "timestamp": TimestampType(), "int": IntegerType(), "array<double>": ArrayType(DoubleType())}


def _schema(ddl: str) -> StructType:
    fields = [part.split() for part in ddl.split(", ")]
    return StructType([StructField(f[0], _TYPES[f[1]], "NOT" not in f) for f in fields])


SCHEMAS = {name: _schema(ddl) for name, ddl in _DDL.items()}

#: Longest text of a column.
LENGTHS = {
    "repositories": {"name": 255, "code": 50, "base_url": 500},
    "endpoints": {"name": 255, "harvest_url": 500, "scientific_discipline": 255},
    "harvest_events": {"record_identifier": 255},
    "records": {"id": 510, "record_identifier": 255, "doi": 255, "url": 2048, "embedding_model": 100},
}
#: Allowed values of a column.
ENUMS = {
    "endpoints": {"protocol": HARVEST_PROTOCOL},
    "harvest_runs": {"status": RUN_STATE},
    "harvest_events": {"metadata_format": CONTENT_FORMAT, "metadata_protocol": HARVEST_PROTOCOL},
    "records": {"resource_type": RESOURCE_TYPE, "metadata_format": CONTENT_FORMAT, "metadata_protocol": HARVEST_PROTOCOL},
}
#: Unique keys; with a condition the key is unique among the rows that meet it.
UNIQUE = {
    "repositories": [(["id"], None), (["name"], None), (["code"], None)],
    "endpoints": [(["id"], None), (["harvest_url"], None), (["name"], None), (["repository_id", "name"], None)],
    "harvest_runs": [(["id"], None), (["endpoint_id"], "status = 'open'")],
    "harvest_events": [(["id"], None), (["endpoint_id", "harvest_run_id", "record_identifier"], None)],
    "records": [(["id"], None), (["endpoint_id", "record_identifier"], None)],
}
#: (column, parent table) of foreign keys to a parent's id; a parent's deletion cascades.
FOREIGN = {
    "endpoints": [("repository_id", "repositories")],
    "harvest_runs": [("endpoint_id", "endpoints")],
    "harvest_events": [("repository_id", "repositories"), ("endpoint_id", "endpoints"), ("harvest_run_id", "harvest_runs")],
    "records": [("endpoint_id", "endpoints"), ("repository_id", "repositories")],
}
#: Row conditions that must not be false.
CHECKS = {"records": {"records_doi_or_url_check": "doi IS NOT NULL OR url IS NOT NULL"}}

# Seed rows (fixed values): code, name, description, base url.
SEED_REPOSITORIES = [
    ("DANS", "Data Archiving and Networked Services", "Dutch national archive for research data", "https://dans.knaw.nl"),
    ("DABAR", "Digital Academic Repository", "Croatian national repository", "https://dabar.srce.hr"),
    ("SWISS", "SwissUbase", "Swiss data repository", "https://www.swissubase.ch"),
    ("HAL", "HAL Science", "French open archive", "https://hal.science"),
    ("ONE", "Onedata", "Onedata demo repository", "https://demo.onedata.org"),
]


def _exported(site: str) -> str:
    return f'{{"metadata_prefix": "oai_datacite", "additional_metadata_params": {{"endpoint": "https://{site}/api/datasets/export", "protocol": "REST_API", "format": "dataverse_json"}}}}'


# Seed rows (fixed values): repository code, name, harvest url, harvest parameters.
SEED_ENDPOINTS = [
    ("DANS", "Archaeology Data Station", "https://archaeology.datastations.nl/oai", _exported("archaeology.datastations.nl")),
    ("DANS", "Social Sciences Data Station", "https://ssh.datastations.nl/oai", _exported("ssh.datastations.nl")),
    ("DANS", "Life Sciences", "https://lifesciences.datastations.nl/oai", _exported("lifesciences.datastations.nl")),
    ("DANS", "Physical and Technical Sciences", "https://phys-techsciences.datastations.nl/oai", _exported("phys-techsciences.datastations.nl")),
    ("DANS", "Generalist", "https://dataverse.nl/oai", _exported("dataverse.nl")),
    ("SWISS", "SwissUbase", "https://www.swissubase.ch/oai-pmh/v1/oai", '{"metadata_prefix": "oai_ddi25"}'),
    ("DABAR", "DABAR", "https://dabar.srce.hr/oai/", '{"metadata_prefix": "oai_datacite", "set": ["openaire"],  "additional_metadata_params": {"endpoint": "https://dabar.srce.hr/oai/", "protocol": "OAI-PMH", "format": "mods"}}'),
    ("HAL", "HAL", "https://api.archives-ouvertes.fr/oai/hal", '{"metadata_prefix": "oai_datacite"}'),
    ("ONE", "Onedata", "https://demo.onedata.org/oai_pmh", '{"metadata_prefix": "oai_datacite", "set": ["a842ea97ec1855a54bf77a90e915cac7cha3ab"]}'),
]


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


def conform(df: DataFrame, name: str) -> DataFrame:
    """The columns of a table in order, with its types; columns that df lacks are null."""
    have = set(df.columns)
    return df.select([(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMAS[name]])


def seed_repositories(spark: SparkSession, now) -> DataFrame:
    rows = spark.createDataFrame(SEED_REPOSITORIES, "code string, name string, description string, base_url string")
    return conform(rows.withColumns({"id": F.md5("code"), "created_at": F.lit(now), "updated_at": F.lit(now), "is_active": F.lit(True)}), "repositories")


def seed_endpoints(spark: SparkSession, repositories: DataFrame, now) -> DataFrame:
    """The seed endpoints of repositories that exist; the repository is looked up by its code."""
    rows = spark.createDataFrame(SEED_ENDPOINTS, "code string, name string, harvest_url string, harvest_params string")
    found = rows.join(repositories.select("code", F.col("id").alias("repository_id")), "code")
    return conform(
        found.withColumns({"id": F.md5("harvest_url"), "protocol": F.lit("OAI-PMH"), "scientific_discipline": F.lit("Multidisciplinary"), "created_at": F.lit(now), "updated_at": F.lit(now), "is_active": F.lit(True)}), "endpoints"
    )
