import math
import re
import zlib
from hashlib import sha256

import pytest

from sheafmill.llm import resampling
from sheafmill.llm.resampling import resample

SCHEMA = "doc_id long, text string, score string, rank boolean, bucket int, n_words int"


def brute(docs, target, longest, buckets, least, percent):
    def found(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    cut, wanted = [(d, *found(t)) for d, t in docs], [b for t in target for b in found(t)[1]]
    s, t = {}, {}
    for _, _, x in cut:
        for b in x:
            s[b] = s.get(b, 0) + 1
    for b in wanted:
        t[b] = t.get(b, 0) + 1
    all_s, all_t = sum(s.values()) + buckets, len(wanted) + buckets
    rows = []
    for d, n, x in cut:
        gains = [math.floor(1000 * math.log((t.get(b, 0) + 1) * all_s / ((s[b] + 1) * all_t))) for b in x]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, n, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2]))
    rank = {}
    for i, r in enumerate(fit[: len(fit) * percent // 100]):
        rank.setdefault(tuple(r), []).append(i + 1)
    return sorted(((*r, rank[tuple(r)].pop() if rank.get(tuple(r)) else None) for r in rows), key=str)


TEXTS = ["Alpha beta gamma", "", None, "ÉCOLE école Alpha 42", "x" * 3000, "one two " * 400, "a-b_c.d", "Alpha beta gamma", "...", "\x00tail\x7fend"]


@pytest.mark.parametrize("longest,buckets,least,percent", [(1, 10000, 2, 50), (2, 97, 1, 100), (3, 40000, 3, 30)])
def test_equals_brute_force(spark, longest, buckets, least, percent):
    docs = [(i if i != 3 else None, t) for i, t in enumerate(TEXTS)] + [(0, "Alpha beta gamma")] * 3
    target = ["beta gamma", None, "one"]
    rows = spark.createDataFrame([(d, t, "s", True, 1, 5) for d, t in docs], SCHEMA)
    got = resample(rows, spark.createDataFrame([(t, 1) for t in target], "text string, t int"), longest, buckets, least, percent)
    assert sorted(map(tuple, got.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=str) == brute(docs, target, longest, buckets, least, percent)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resample(none, none.select("text")).collect() == []
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert resample(some, none.select("text"), least_words=1, percent=100).first()["rank"] == 1


def test_ranks_over_many_tasks_and_ties(spark):
    n = 5000
    docs = spark.range(n).selectExpr("id AS doc_id", "concat_ws(' ', array_repeat('same words here', 10)) AS text").repartition(40)
    got = resample(docs, docs.limit(1).select("text"), percent=100).collect()
    order = sorted(got, key=lambda r: (-r["score"], r["doc_id"]))
    assert [r["rank"] for r in order] == list(range(1, n + 1)) and len({r["weight"] for r in got}) == 1


def test_main_path_runs_no_python(spark):
    rows = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    cut = resampling.bucketed(rows, ["doc_id"], 2, 10)
    plan = resampling.weights(cut, resampling.gains(resampling.counted(cut, "s").withColumn("t", resampling.F.lit(1))), ["doc_id"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
