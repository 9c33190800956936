"""URL filters: host and path rules, and association rules over URL tokens. DataFrame and SQL functions only.

A url's host is what follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; its path goes on up to `?`, `#` or the
end; both are empty for null and without `://`. A given rule fits its host and all subdomains if the path starts with the rule's path; of
those that fit the longest decides.

Where no given rule fits, association rules decide. FP-growth mines the token sets of labelled urls (scheme, top-level domain, each
host label, domain, path words, extension, query keys, fragment) together with their label; rules that lead to the label
`block` are kept if they reach the least support and confidence and if no rule with a part of their tokens is as confident. An inverted index from
a rule's rarest token to the rule finds, for each distinct token set, the rules whose tokens it has; one rule that fires blocks.

Tokens that stand on just the same labelled pages (a template's host, domain and path words) are one item when mined, as any choice of them makes the same rule; tokens on
too few bad pages are in no rule and are left out. A token that stands on bad pages only is a rule by itself, and nothing with it can be more confident, so it is not mined with others. So rules have no
greatest length, and a template of many tokens does not give every subset of them.

Labels say of a page id whether its page is bad: for `labels`, quality 0 or toxic 1. An id with several labels is
bad if one of them is. All labelled rows are mined.

Defined cases: null urls and urls without `://` have no tokens but are judged (allow); without labelled rows nothing is mined and all is allowed;
repeated rows and ids are judged each; null ids have no label; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafmill.llm.common import keep

#: (verdict, host and path) of the given rules.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.8
#: Labelled pages on which a rule of the query must hold at least; below that, confidence is chance.
MIN_PAGES = 20
BLOCK, ALLOW = "=block", "=allow"
#: Tasks among which the pages of one token set are dealt when they get their verdict.
SALTS = 16

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, what follows the path)."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit("")), F.coalesce(F.regexp_extract(rest, r"(?s)^[^?#]*(.*)$", 1), F.lit(""))


def given_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        own, _, start = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """The sorted distinct tokens of a url."""
    host, path, tail = parts(url)

    def marked(mark: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda v: v != ""), lambda v: F.concat(F.lit(mark), v))

    labels = F.split(host, r"\.")
    segments = F.split(F.regexp_replace(F.lower(path), r"\.[a-z0-9]+$", ""), r"[/_\-.]+")
    words = F.transform(segments, lambda s: F.when(s.rlike(r"^\d+$"), F.lit("#")).otherwise(s))
    keys = F.transform(F.split(F.regexp_extract(tail, r"^\?([^#]*)", 1), "&"), lambda s: F.regexp_extract(s, r"^([^=]*)", 1))
    every = F.concat(
        marked("scheme:", F.array(F.translate(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1), UPPER, LOWER))),
        marked("top:", F.array(F.element_at(labels, -1))),
        marked("domain:", F.array(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1))),
        marked("host:", labels),
        marked("path:", words),
        marked("type:", F.array(F.regexp_extract(F.lower(path), r"\.([a-z0-9]+)$", 1))),
        marked("key:", keys),
        marked("anchor:", F.array(F.regexp_extract(tail, r"#(.*)$", 1))),
    )
    return F.coalesce(F.array_sort(F.array_distinct(every)), F.array().cast("array<string>"))


def firing(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, rule_id) where the set's tokens (key, tokens) include all of the rule's (rule_id, antecedent), through the inverted index from a rule's rarest token."""
    index = rules.select("rule_id", "antecedent", F.explode("antecedent").alias("token"))
    asked = index.select("token").distinct()
    counts = sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n")).join(asked, "token")
    rarest = index.join(counts, "token").groupBy("rule_id").agg(F.min(F.struct("n", "token")).alias("rarest"), F.first("antecedent").alias("antecedent"))  # rules with a token in no set drop out below
    rarest = rarest.select("rule_id", "antecedent", F.col("rarest.token").alias("token"))
    posted = sets.select("key", "tokens", F.explode("tokens").alias("token"))
    return posted.join(rarest, "token").filter(F.size(F.array_except("antecedent", "tokens")) == 0).select("key", "rule_id")


def mine_items(transactions: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_pages: int = 1) -> tuple[DataFrame, DataFrame]:
    """(rule_id, antecedent, confidence, support) of the pruned rules to `block`, whose antecedents are items, and (token, item). transactions: items, with the label among them.

    A rule holds on a share min_support of the transactions and on min_pages of them. There are at most 1 / min_support frequent tokens for each token of a page.
    """
    rows = keep(transactions.select(F.monotonically_increasing_id().alias("row"), "items"), "labelled-pages")
    n = rows.count()
    least = max(math.ceil(min_support * n - 1e-9), min_pages, 1)
    bad = F.array_contains("items", BLOCK)
    each = rows.select("row", bad.alias("bad"), F.explode("items").alias("token")).filter(~F.col("token").isin(BLOCK, ALLOW))
    pages = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("row")).alias("x"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("y")]  # which pages, in 128 bits
    tokens_of = each.groupBy("token").agg(F.count_if("bad").alias("bad"), *pages).filter(F.col("bad") >= least)
    alike = tokens_of.groupBy("n", "x", "y").agg(F.min("token").alias("item"), F.collect_list("token").alias("tokens"), F.max("bad").alias("bad"))
    items = keep(alike.select(F.explode("tokens").alias("token"), "item", (F.col("n") == F.col("bad")).alias("sure"), "bad"), "items")
    sure = items.filter("sure").groupBy("item").agg(F.max("bad").alias("bad"))
    alone = sure.select(F.array("item").alias("antecedent"), F.lit(1.0).alias("confidence"), (F.col("bad") / max(1, n)).alias("support"))
    mark = F.array(F.when(bad, F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
    found = each.join(items.filter("NOT sure"), "token").groupBy("row").agg(F.collect_set("item").alias("found"))
    mined = rows.join(found, "row").select(F.concat("found", mark).alias("items"))
    mined = keep(mined, "transactions")
    held = max(1, mined.count())
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / held), minConfidence=min_confidence).fit(mined)  # of a count, so that rounding of shares can't move it by a page
    rules = model.associationRules.filter((F.size("consequent") == 1) & (F.element_at("consequent", 1) == BLOCK) & ~F.array_contains("antecedent", ALLOW))
    rules = rules.filter(F.round(F.col("support") * held) >= least).select(F.array_sort("antecedent").alias("antecedent"), "confidence", (F.col("support") * held / max(1, n)).alias("support"))
    rules = keep(rules.unionByName(alone).withColumn("rule_id", F.xxhash64("antecedent")), "rules")
    items = items.select("token", "item")
    sets = rules.select(F.col("rule_id").alias("key"), F.col("antecedent").alias("tokens"))
    inner = firing(sets, rules).filter("key <> rule_id")
    weaker = inner.join(rules.select(F.col("rule_id").alias("key"), F.col("confidence").alias("own")), "key").join(rules.select("rule_id", "confidence"), "rule_id").filter("confidence >= own")
    return rules.join(weaker.select(F.col("key").alias("rule_id")).distinct(), "rule_id", "left_anti"), items


def mine(transactions: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_pages: int = 1) -> DataFrame:
    """(antecedent, confidence, support) of the pruned rules to `block` in tokens: a rule for each choice of a token for each item."""
    rules, items = mine_items(transactions, min_support, min_confidence, min_pages)
    choices = items.groupBy("item").agg(F.collect_list("token").alias("tokens"))
    lists = rules.withColumn("item", F.explode("antecedent")).join(choices, "item").groupBy("rule_id", "confidence", "support").agg(F.collect_list("tokens").alias("lists"))
    start = F.array(F.array().cast("array<string>"))
    chosen = F.aggregate("lists", start, lambda done, tokens: F.flatten(F.transform(done, lambda d: F.transform(tokens, lambda t: F.array_append(d, t)))))
    return lists.select(F.explode(chosen).alias("antecedent"), "confidence", "support").select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support")


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_pages: int = 1) -> DataFrame:
    """(page_id, host, path, rule, verdict, confidence) of every row. labels: (page_id, bad)."""
    host, path, _ = parts(F.col("url"))
    rule, verdict = given_rule(F.col("host"), F.col("path"), rules)
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), tokens(F.col("url")).alias("tokens"))
    bad = labels.filter("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    transactions = rows.join(bad, "page_id").select(F.array_append("tokens", F.when(F.col("bad"), F.lit(BLOCK)).otherwise(F.lit(ALLOW))).alias("items"))
    mined, items = mine_items(transactions, min_support, min_confidence, min_pages)
    mined = keep(mined, "pruned-rules")
    sets = keep(rows.select("tokens").distinct().withColumn("key", F.struct(F.xxhash64("tokens").alias("a"), F.xxhash64(F.lit(1), "tokens").alias("b"))), "token-sets")  # 128 bits
    found = sets.select("key", F.explode("tokens").alias("token")).join(items, "token").groupBy("key").agg(F.collect_set("item").alias("tokens"))
    fired = firing(keep(found, "item-sets"), mined).join(mined.select("rule_id", "confidence"), "rule_id").groupBy("key").agg(F.max("confidence").alias("confidence"))
    fired = fired.join(sets, "key").select("tokens", "confidence", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    judged = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", F.spark_partition_id()), F.lit(SALTS)).cast("int")).join(fired, ["tokens", "salt"], "left")
    judged = judged.withColumn("rule", rule).withColumn("given", verdict)
    own = F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("given", own).alias("verdict"), "confidence")


def op10_url_rules(spark, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), labels, min_pages=MIN_PAGES)


_GIVEN = sorted(RULES, key=lambda r: -len(r[1]))
_FITS = [(what, text, "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '/{1}')".format(*text.split("/", 1))) for what, text in _GIVEN]

#: The rules by counting every token set, without FP-growth.
ORACLE_OP10 = rf"""
WITH RECURSIVE p AS (SELECT row_number() OVER () AS r, page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
  q AS (SELECT r, page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '(?s)^[^?#]*(.*)$', 1) AS tail FROM p),
  v AS (SELECT r, 'scheme:' AS mark, translate(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1), '{UPPER}', '{LOWER}') AS tok FROM q
    UNION ALL SELECT r, 'top:', string_split(host, '.')[-1] FROM q
    UNION ALL SELECT r, 'domain:', regexp_extract(host, '([^.]+\.[^.]+)$', 1) FROM q
    UNION ALL SELECT r, 'host:', unnest(string_split(host, '.')) FROM q
    UNION ALL SELECT r, 'path:', CASE WHEN regexp_full_match(s, '[0-9]+') THEN '#' ELSE s END FROM (SELECT r, unnest(regexp_split_to_array(regexp_replace(lower(path), '\.[a-z0-9]+$', ''), '[/_\-.]+')) AS s FROM q)
    UNION ALL SELECT r, 'type:', regexp_extract(lower(path), '\.([a-z0-9]+)$', 1) FROM q
    UNION ALL SELECT r, 'key:', regexp_extract(s, '^([^=]*)', 1) FROM (SELECT r, unnest(string_split(regexp_extract(tail, '^\?([^#]*)', 1), '&')) AS s FROM q)
    UNION ALL SELECT r, 'anchor:', regexp_extract(tail, '#(.*)$', 1) FROM q),
  t AS (SELECT DISTINCT r, mark || tok AS tok FROM v WHERE tok <> ''),
  l AS (SELECT doc_id, bool_or(quality = 0 OR toxic = 1) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
  x AS (SELECT r, bad FROM q JOIN l ON page_id = doc_id WHERE bad IS NOT NULL),
  m AS (SELECT greatest({MIN_SUPPORT} * count(*), {MIN_PAGES}) AS least FROM x),
  f AS (SELECT tok FROM t JOIN x USING (r) WHERE bad GROUP BY tok HAVING count(*) >= (SELECT least FROM m)),
  b AS (SELECT r, bad, tok FROM t JOIN x USING (r) JOIN f USING (tok)),
  s AS (SELECT r, bad, tok AS last, [tok] AS a FROM b UNION ALL SELECT s.r, s.bad, b.tok, list_append(s.a, b.tok) FROM s JOIN b ON b.r = s.r AND b.tok > s.last),
  c AS (SELECT a, count(*) FILTER (WHERE bad) AS together, count(*) AS n FROM s GROUP BY a),
  g AS (SELECT a, together / CAST(n AS DOUBLE) AS confidence FROM c WHERE together >= (SELECT least FROM m) AND together / CAST(n AS DOUBLE) >= {MIN_CONFIDENCE}),
  k AS (SELECT a, confidence FROM g o WHERE NOT EXISTS (SELECT 1 FROM g i WHERE len(i.a) < len(o.a) AND list_has_all(o.a, i.a) AND i.confidence >= o.confidence)),
  fired AS (SELECT r, max(confidence) AS confidence FROM (SELECT r, list(tok) AS toks FROM t GROUP BY r) JOIN k ON list_has_all(toks, a) GROUP BY r)
SELECT page_id, host, path, CASE {" ".join(f"WHEN {fits} THEN '{text}'" for _, text, fits in _FITS)} END AS rule,
  CASE {" ".join(f"WHEN {fits} THEN '{what}'" for what, _, fits in _FITS)} WHEN confidence IS NULL THEN 'allow' ELSE 'block' END AS verdict, confidence
FROM q LEFT JOIN fired USING (r)
"""
