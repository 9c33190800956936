import itertools
import random
import zlib
from collections import defaultdict

import pytest

from sheafmill.llm import sharding as s


def test_flow_moves_the_fewest():
    rng = random.Random(3)
    for _ in range(60):
        sizes = [rng.randint(0, 50) for _ in range(rng.randint(1, 6))]
        m = rng.randint(1, 6)
        caps = s.even(sum(sizes), m)
        flow = s.solve(sizes, caps)
        assert [sum(f for (i, _), f in flow.items() if i == k) for k in range(len(sizes))] == sizes
        assert all(sum(f for (_, j), f in flow.items() if j == k) <= caps[k] for k in range(m))
        stay = sum(f for (i, j), f in flow.items() if i == j)
        assert stay == sum(min(a, b) for a, b in zip(sizes, caps))


def test_flow_with_costs_like_brute_force():
    rng = random.Random(4)
    for _ in range(40):
        n, m = 2, 3
        sizes, caps = [rng.randint(0, 4) for _ in range(n)], [rng.randint(2, 4) for _ in range(m)]
        price = [[rng.randint(0, 5) for _ in range(m)] for _ in range(n)]
        if sum(sizes) > sum(caps):
            with pytest.raises(ValueError):
                s.solve(sizes, caps)
            continue
        best = min(
            sum(price[0][j] * a[j] + price[1][j] * b[j] for j in range(m))
            for a in itertools.product(range(5), repeat=m) if sum(a) == sizes[0]
            for b in itertools.product(range(5), repeat=m) if sum(b) == sizes[1] and all(x + y <= c for x, y, c in zip(a, b, caps))
        )
        flow = s.solve(sizes, caps, lambda i, j: price[i][j])
        assert sum(price[i][j] * f for (i, j), f in flow.items()) == best


def rows_of(spark, path):
    return s.op4_min_cost_reshard(spark, path).collect()


def test_query_laws(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i if i % 50 else None, None if i % 97 == 0 else "é" * rng.randint(0, 60) if i % 3 else "same text", "src0" if i % 3 == 0 else f"src{i % 20}" if i % 11 else None, 7) for i in range(6000)]
    rows += rows[:40]
    spark.createDataFrame(rows, "doc_id long, text string, source string, shard int").write.parquet(str(tmp_path / "documents.parquet"))
    got = rows_of(spark, str(tmp_path))
    assert len(got) == len(rows)
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _, _ in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == want
    sizes, slots, held, stored = defaultdict(int), defaultdict(list), defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        stored[r["old_shard"]] += r["size"]
        held[r["old_shard"], r["shard"]] += r["size"]
    assert set(sizes) == set(range(40)) and {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    mean = sum(sizes.values()) / 40
    assert all(abs(x - mean) < 0.05 * mean for x in sizes.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    moved = sum(v for (i, j), v in held.items() if i != j)
    least = sum(stored.values()) - sum(min(stored[k], mean) for k in range(40))
    assert moved <= least * 1.02


def test_copies_of_one_row_are_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(s, "FEWEST_ROWS_OF_A_SALT", 10)
    buckets, keep = [], s.keep

    def kept(df, name):
        out = keep(df, name)
        if name == "placed":
            buckets.extend(r["count"] for r in out.groupBy("_old", "_class", "_salt").count().collect())
        return out

    monkeypatch.setattr(s, "keep", kept)
    rows = [(5, "one text", "src")] * 2000 + [(i, "other" * (i % 7), f"src{i % 3}") for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = rows_of(spark, str(tmp_path))
    assert len(got) == len(rows) and max(buckets) < 40
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_empty_and_rewrite(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    assert rows_of(spark, str(tmp_path)) == []
    docs = spark.createDataFrame([(i, f"text {i}", 0 if i < 60 else 1, "x") for i in range(120)], "doc_id long, text string, _old int, extra string")
    changed = s.rewrite(docs, str(tmp_path / "out"), 2, 3)
    assert changed == [0, 1, 2]
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["doc_id"], r["text"], r["extra"]) for r in back.collect()) == [(i, f"text {i}", "x") for i in range(120)]
    assert s.rewrite(docs, str(tmp_path / "same"), 2, 2) in ([], [0, 1])
    with pytest.raises(ValueError):
        s.rewrite(docs.withColumn("_size", docs["_old"]), str(tmp_path / "no"), 2, 3)
