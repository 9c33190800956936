"""Golden record survivorship: one record for each cluster of records, each field from the record that its rule ranks first.

Every field of every record becomes a long row (cluster, field, part, value, priority); one groupBy keeps the row with the least priority for each cluster, field and part, and a pivot makes columns of
fields again. All rules share one priority struct, in which a rule fills the slots it uses: a lead of its own (longer text, fuller record), fresh before stale, trust of the source,
age, trust again, the record's id. A field that depends on what another field chose has a part for each value of that other field: the chosen part's survivor is picked afterwards, else the best of all
parts.

A record is stale by its cluster's latest time, which takes a join of records with their cluster. Clusters with more than a thousandth of all records (so at most 1,000 of them) are
broadcast and split: their records are dealt over as many tasks as they hold thousandths, and the cluster's row is copied as often. Survivors combine before the shuffle, so a task sends a row for
each cluster, field and part that it has, however large a cluster is. Nothing that grows with the input goes to the driver, through one task or into a broadcast.

Defined cases: strings that are empty or blank count as null, others stay as they are; NaN and infinite balances count as null; a record without a cluster id and without an id is in the cluster null;
an unknown or null source is trusted least; a cluster whose records have no time is stale throughout; ids that are null come last; records that are alike in all of a rule give the smaller value;
repeated rows count as records; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafmill.llm.common import Scratch, keep

#: Sources by falling trust (fixed values).
TRUST = ["partner", "store", "web", "crm"]
#: How long before its cluster's latest time a record goes stale.
STALE_HOURS = 30 * 24
#: Clusters with more than one part in so many of all records are split.
SHARE = 1000
BLANK = r"^[\x20\x09-\x0D]*$"


@dataclass(frozen=True)
class Rule:
    """How a field survives. values: the columns that one record gives together, under their new names; lead: what ranks first, less is better; trusted: fresh and trusted sources before recent ones;
    whole: a record counts even if it gives nothing; within: a column, whose surviving value's records come first."""

    field: str
    values: dict[str, Column]
    lead: Column | None = None
    trusted: bool = False
    whole: bool = False
    within: str | None = None


def text(name: str) -> Column:
    """A string column, null where it is empty or blank."""
    return F.when(~F.col(name).rlike(BLANK), F.col(name))


def trust(source: Column, order: list[str] = TRUST) -> Column:
    out = F.lit(len(order))
    for rank, name in enumerate(order):
        out = F.when(source == name, rank).otherwise(out)
    return out


def clusters_of(records: DataFrame) -> DataFrame:
    """(cluster_id, n, latest) of each cluster; combined before the shuffle."""
    return records.groupBy("cluster_id").agg(F.count("*").alias("n"), F.max("updated_at").alias("latest"))


def with_latest(records: DataFrame, clusters: DataFrame, share: int = SHARE) -> DataFrame:
    """records with `latest`, their cluster's latest time. A cluster with more than 1/share of all records is split into parts of about that size; there are less than `share` such clusters."""
    total = clusters.agg(F.sum("n")).first()[0] or 0
    part = max(1, total // share)
    pieces = F.ceil(F.col("n") / part).cast("int")
    large = clusters.filter(F.col("n") > part).select(F.col("cluster_id").alias("_large"), pieces.alias("_pieces"))
    dealt = records.join(F.broadcast(large), F.col("cluster_id").eqNullSafe(F.col("_large")), "left")  # less than `share` rows
    dealt = dealt.withColumn("_piece", F.when(F.col("_pieces").isNotNull(), F.pmod(F.monotonically_increasing_id(), F.col("_pieces")).cast("int")).otherwise(F.lit(0))).drop("_large", "_pieces")
    copies = clusters.select(F.col("cluster_id").alias("_id"), "latest", F.explode(F.sequence(F.lit(0), F.when(F.col("n") > part, pieces - 1).otherwise(F.lit(0)))).alias("_copy"))
    return dealt.join(copies, F.col("cluster_id").eqNullSafe(F.col("_id")) & (F.col("_piece") == F.col("_copy"))).drop("_id", "_piece", "_copy")


def long_rows(records: DataFrame, rules: list[Rule]) -> DataFrame:
    """(cluster_id, field, part, stale, best): a row for each record and rule under which it counts. records: with cluster_id, client_id, source, updated_at and latest."""
    stale = F.coalesce(F.col("updated_at") < F.col("latest") - F.expr(f"INTERVAL '{STALE_HOURS}' HOUR"), F.lit(True))
    records = records.withColumns({"_stale": stale, "_trust": trust(F.col("source"))})
    names = {n: v for r in rules for n, v in r.values.items()}
    kinds = records.select(*(v.alias(n) for n, v in names.items())).schema

    def row(rule: Rule) -> Column:
        none = F.lit(0)
        priority = F.struct(
            (rule.lead if rule.lead is not None else none).cast("int").alias("lead"), (F.col("_stale").cast("int") if rule.trusted else none).alias("stale"), (F.col("_trust") if rule.trusted else none).alias("first_trust"),
            F.col("updated_at").isNull().alias("no_time"), (F.col("latest") - F.col("updated_at")).alias("age"), F.col("_trust").alias("trust"), F.col("client_id").isNull().alias("no_id"), F.col("client_id").alias("record"),
        )
        value = F.struct(*((rule.values.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in kinds))
        given = F.lit(False)
        for v in rule.values.values():
            given = given | v.isNotNull()
        whole = F.struct(F.lit(rule.field).alias("field"), (F.col(rule.within).cast("string") if rule.within else F.lit(None).cast("string")).alias("part"), F.struct(priority.alias("priority"), value.alias("value"), given.alias("given")).alias("best"))
        return whole if rule.whole else F.when(given, whole)

    each = F.filter(F.array(*(row(r) for r in rules)), lambda x: x.isNotNull())
    return records.select("cluster_id", "_stale", F.explode(each).alias("x")).select("cluster_id", F.col("_stale").alias("stale"), "x.field", "x.part", "x.best")


def survivors(records: DataFrame, rules: list[Rule], name: str = "survivors") -> DataFrame:
    """A row for each cluster_id: n_records, n_stale, each rule's values and `<field>_from`, the record that they come from (null if they are all null). records: as in with_latest().

    The first rule that is `whole` counts the records of a cluster.
    """
    counting = next(r.field for r in rules if r.whole)
    best = keep(long_rows(records, rules).groupBy("cluster_id", "field", "part").agg(F.min("best").alias("best"), F.count("*").alias("n_records"), F.count_if("stale").alias("n_stale")), name)
    free, bound = [r for r in rules if not r.within], [r for r in rules if r.within]
    top = best.filter(F.col("field").isin([r.field for r in free]))
    picked = [F.first(F.when(F.col("field") == r.field, F.col("best")), ignorenulls=True).alias(r.field) for r in free]
    counts = [F.max(F.when(F.col("field") == counting, F.col(c))).alias(c) for c in ("n_records", "n_stale")]
    out = top.groupBy("cluster_id").agg(*counts, *picked)
    for rule in bound:
        own = best.filter(F.col("field") == rule.field)
        anywhere = own.groupBy(F.col("cluster_id").alias("_a")).agg(F.min("best").alias("_any"))
        chosen = own.select(F.col("cluster_id").alias("_b"), F.col("part").alias("_part"), F.col("best").alias("_chosen"))
        value = F.col(f"{rule.within}.value.{rule.within}").cast("string")
        out = out.join(anywhere, F.col("cluster_id").eqNullSafe(F.col("_a")), "left").drop("_a")
        out = out.join(chosen, F.col("cluster_id").eqNullSafe(F.col("_b")) & (value == F.col("_part")), "left").withColumn(rule.field, F.coalesce("_chosen", "_any")).drop("_b", "_part", "_chosen", "_any")
    columns = [F.col(f"{r.field}.value.{v}").alias(v) for r in rules for v in r.values]
    sources = [F.when(F.col(f"{r.field}.given"), F.col(f"{r.field}.priority.record")).alias(f"{r.field}_from") for r in rules]
    return out.select("cluster_id", "n_records", "n_stale", *columns, *sources)


def client_rules() -> list[Rule]:
    c = F.col
    return [
        Rule("name", {"name": c("name")}, lead=-F.char_length("name"), trusted=True),
        Rule("email", {"email": c("email")}, trusted=True),
        Rule("segment", {"segment": c("segment")}),
        Rule("address", {"city": c("city"), "nation_id": c("nation_id")}, lead=-(c("city").isNotNull().cast("int") + c("nation_id").isNotNull().cast("int")), trusted=True, whole=True),
        Rule("balance", {"balance": c("balance")}, within="segment"),
    ]


def golden_records(clients: DataFrame) -> DataFrame:
    """(cluster_id, n_records, n_stale, name, email, segment, city, nation_id, balance, name_from, email_from, segment_from, address_from, balance_from) for each cluster of clients."""
    finite = F.when(~F.isnan("balance") & (F.abs("balance") < float("inf")), F.col("balance"))
    records = clients.select(
        F.coalesce("master_id", "client_id").alias("cluster_id"), "client_id", "source", "updated_at", *(text(n).alias(n) for n in ("name", "email", "city", "segment")), "nation_id", finite.alias("balance")
    )
    with Scratch(clients.sparkSession) as scratch:
        clusters = scratch.keep(clusters_of(records), "clusters")
        return survivors(with_latest(records, clusters), client_rules())


def op13_golden_record(spark, sf_dir: str) -> DataFrame:
    found = golden_records(spark.read.parquet(f"{sf_dir}/clients.parquet"))
    return found.withColumn("balance_cents", F.floor(100 * F.col("balance") + 0.5)).drop("balance").select(
        "cluster_id", "n_records", "n_stale", "name", "email", "segment", "city", "nation_id", "balance_cents", "name_from", "email_from", "segment_from", "balance_from", "address_from"
    )


_RECENT = "updated_at DESC NULLS LAST, trust, client_id NULLS LAST"
_TRUSTED = f"stale, trust, {_RECENT}"


def _first(field: str, order: str, where: str) -> str:
    return f"{field}_ AS (SELECT * FROM m WHERE {where} QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY {order}) = 1)"


ORACLE_OP13 = f"""
WITH c AS (SELECT coalesce(master_id, client_id) AS cluster_id, client_id, updated_at, nation_id, CASE WHEN isfinite(balance) THEN balance END AS balance,
    {", ".join(f"CASE WHEN NOT regexp_full_match({n}, '[ \\t-\\r]*') THEN {n} END AS {n}" for n in ("name", "email", "city", "segment"))},
    CASE source {" ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(TRUST))} ELSE {len(TRUST)} END AS trust FROM clients),
  m AS (SELECT *, coalesce(updated_at < max(updated_at) OVER (PARTITION BY cluster_id) - INTERVAL {STALE_HOURS} HOUR, true) AS stale FROM c),
  {_first("segment", f"{_RECENT}, segment", "segment IS NOT NULL")}, {_first("email", f"{_TRUSTED}, email", "email IS NOT NULL")}, {_first("name", f"length(name) DESC, {_TRUSTED}, name", "name IS NOT NULL")},
  {_first("address", f"CAST(city IS NULL AS INTEGER) + CAST(nation_id IS NULL AS INTEGER), {_TRUSTED}, city NULLS FIRST, nation_id NULLS FIRST", "true")},
  balance_ AS (SELECT m.* FROM m LEFT JOIN segment_ s ON m.cluster_id IS NOT DISTINCT FROM s.cluster_id WHERE m.balance IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY m.cluster_id ORDER BY m.segment IS NULL OR s.segment IS NULL OR m.segment <> s.segment, m.updated_at DESC NULLS LAST, m.trust, m.client_id NULLS LAST, m.balance) = 1),
  g AS (SELECT cluster_id, count(*) AS n_records, count(*) FILTER (WHERE stale) AS n_stale FROM m GROUP BY cluster_id)
SELECT g.cluster_id, n_records, n_stale, n.name, e.email, s.segment, a.city, a.nation_id, CAST(floor(100 * b.balance + 0.5) AS BIGINT) AS balance_cents, n.client_id AS name_from, e.client_id AS email_from,
  s.client_id AS segment_from, b.client_id AS balance_from, CASE WHEN a.city IS NOT NULL OR a.nation_id IS NOT NULL THEN a.client_id END AS address_from
FROM g {" ".join(f"LEFT JOIN {t}_ {t[0]} ON g.cluster_id IS NOT DISTINCT FROM {t[0]}.cluster_id" for t in ("name", "email", "segment", "address", "balance"))}
"""
