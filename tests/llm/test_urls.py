import random
from collections import Counter
from itertools import combinations

import duckdb
import pytest
from pyspark.sql import functions as F

from sheafmill.llm import urls as u


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, more = rest[:end], rest[end:]
    stop = min([more.find(c) for c in "?#" if c in more], default=len(more))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), more[:stop]


def plain_rule(host, path):
    best = None
    for verdict, text in u.RULES:
        own, _, start = text.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start) and (best is None or len(text) > len(best[1])):
            best = verdict, text
    return best or (None, None)


URLS = [None, "", "no scheme", "http://", "http://A.Example.NET/en/x?q=1#f", "https://example.net", "https://example.net?x=/en/", "ftp://xexample.net/en/", "http://net/", "http://a.org/fr/", "http://a.org/fr", "http://É.Example.com/de/1", "http://a.com/x://y.net/", "//a.net/", "http://a.net/en/\nmore", "x://y?z://w.net/", "http://example.net/EN/", "http://a.b.example.com/de/"]


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, x, "c") for i, x in enumerate(URLS)] + [(None, URLS[4], "c"), (4, URLS[4], "c")], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    got = sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in u.judge(pages, labels).collect()), key=str)
    want = []
    for i, x in [*enumerate(URLS), (None, URLS[4]), (4, URLS[4])]:
        host, path = plain_parts(x)
        verdict, rule = plain_rule(host, path)
        want.append((i, host, path, rule, verdict or "allow"))
    assert got == sorted(want, key=str)
    assert u.judge(pages.limit(0), labels).collect() == []


def plain_mine(transactions, support, confidence):
    n, counts = len(transactions), {}
    for t in transactions:
        own = sorted(x for x in t if x[0] != "=")
        for k in range(1, len(own) + 1):
            for c in combinations(own, k):
                a, b = counts.get(c, (0, 0))
                counts[c] = a + 1, b + (u.BLOCK in t)
    rules = {c: b / a for c, (a, b) in counts.items() if b >= support * n and b / a >= confidence}
    return {c: v for c, v in rules.items() if not any(set(d) < set(c) and w >= v for d, w in rules.items())}


def test_mining_like_brute_force(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        host = rng.choice(["casino-win", "blog", "free.bets", "shop"])
        url = f"http://{host}.example.{rng.choice(['com', 'org'])}/{rng.choice(['en', 'es', 'win'])}/{rng.randint(1, 99)}{rng.choice(['', '?ref=x', '#top'])}"
        bad = ("casino" in url or ("bets" in url and "/win" in url)) and rng.random() < 0.95 or rng.random() < 0.05
        rows.append((i, url, i))
        if i % 3:
            labels.append((i, bad))
    pages = spark.createDataFrame(rows, "page_id long, url string, confidence int")
    marks = spark.createDataFrame(labels + labels[:5] + [(None, True), (3, None)], "page_id long, bad boolean")
    token = {r["page_id"]: r["t"] for r in pages.select("page_id", u.tokens(F.col("url")).alias("t")).collect()}
    want = plain_mine([token[i] + [u.BLOCK if b else u.ALLOW] for i, b in labels], 0.02, 0.8)
    assert want
    items = spark.createDataFrame([(token[i] + [u.BLOCK if b else u.ALLOW],) for i, b in labels], "items array<string>")
    got = {tuple(r["antecedent"]): r["confidence"] for r in u.mine(items, 0.02, 0.8).collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    verdicts = {r["page_id"]: r["verdict"] for r in u.judge(pages, marks, min_support=0.02).collect()}
    for i, url, _ in rows:
        host, path = plain_parts(url)
        fires = any(set(c) <= set(token[i]) for c in want)
        assert verdicts[i] == (plain_rule(host, path)[0] or ("block" if fires else "allow"))


def blog_pages(n):
    """(page_id, url) and (doc_id, quality, toxic): what is on example pages of casino hosts is bad, some of the rest by chance."""
    rng = random.Random(n)
    pages, labels = [(None, None), (1, "no scheme")], [(None, 0, 0), (2, None, None)]
    for i in range(n):
        host = rng.choice(["casino-win", "blog", "free.bets", "shop"])
        url = f"http://{host}.Example.{rng.choice(['com', 'org', 'net'])}/{rng.choice(['en', 'de', 'fr', 'win'])}/{rng.randint(1, 99)}{rng.choice(['', '.html', '?ref=x&b', '#top'])}"
        bad = "casino" in url or ("bets" in url and "/win" in url and rng.random() < 0.9) or rng.random() < 0.05
        pages.append((i, url))
        labels.append((i, int(not bad), int(bad and rng.random() < 0.5)))
    return pages, labels


def compared(spark, folder):
    got = u.op10_url_rules(spark, folder)
    with duckdb.connect() as db:
        for name in ("pages", "labels"):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet{'/*.parquet' if not folder.startswith('/root') else ''}')")
        cursor = db.execute(u.ORACLE_OP10)
        names = [c[0] for c in cursor.description]
        want = Counter(cursor.fetchall())
    assert names == got.columns
    rows = Counter(tuple(r) for r in got.collect())
    assert rows == want
    return rows


@pytest.mark.parametrize("n", [10, 147, 900])
def test_query_like_sql(spark, tmp_path, n):
    pages, labels = blog_pages(n)
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    mined = {r[4] for r in compared(spark, str(tmp_path)) if r[5] is not None}
    assert bool(mined) == (n > 20)


def test_query_like_sql_on_tables(spark):
    compared(spark, "/root/testdata/sf0.01")


def test_least_pages(spark):
    """A rule holds on at least so many pages, whatever rounding does to shares; with fewer pages there is none."""
    rows = [(["host:a", u.BLOCK if i < 20 else u.ALLOW],) for i in range(20)] + [(["host:b", u.ALLOW],)] * 127
    items = spark.createDataFrame(rows, "items array<string>")
    assert [r["antecedent"] for r in u.mine(items, 0.002, 0.8, 20).collect()] == [["host:a"]]
    assert u.mine(items, 0.002, 0.8, 21).collect() == []
    assert u.mine(items.limit(10), 0.002, 0.8, 20).collect() == []


def test_correlated_tokens(spark):
    """A template of 24 tokens on the same pages is one item; any of its tokens fires; a rule of six tokens is found."""
    template = [f"path:t{k}" for k in range(24)]
    six = [f"key:k{k}" for k in range(6)]
    rows = [template + ["scheme:https", u.BLOCK]] * 60 + [["scheme:https", f"path:p{i}", u.ALLOW] for i in range(60)]
    rows += [six + ["scheme:https", u.BLOCK]] * 40 + [[x for x in six if x != out] + ["scheme:https", u.ALLOW] for out in six for _ in range(15)]
    items = spark.createDataFrame([(r,) for r in rows], "items array<string>")
    rules, merged = u.mine_items(items, 0.002, 0.8, 20)
    assert sorted(tuple(r["antecedent"]) for r in rules.collect()) == [tuple(six), (min(template),)]
    assert {r["token"] for r in merged.collect() if r["item"] == min(template)} == set(template)
    assert sorted(r["antecedent"] for r in u.mine(items, 0.002, 0.8, 20).collect()) == sorted([six] + [[t] for t in template])


def test_tokens_of_a_template_that_nearly_agree(spark):
    """30 tokens, each missing on a page of its own: 2 to the 30 itemsets, but each token is a rule by itself and nothing beside it says more."""
    template = [f"path:t{k:02}" for k in range(30)]
    rows = [[t for k, t in enumerate(template) if k != page] + [u.BLOCK] for page in range(120)] + [["path:other", u.ALLOW]] * 60
    rules = u.mine(spark.createDataFrame([(r,) for r in rows], "items array<string>"), 0.002, 0.8, 20).collect()
    assert sorted(r["antecedent"] for r in rules) == [[t] for t in template] and {r["confidence"] for r in rules} == {1.0}
    assert {round(r["support"] * 180) for r in rules} == {119}
