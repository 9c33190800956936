import math
import random

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs

from sheafmill.llm import vectors as v


def plain(rows, k=5, every=50):
    use = [(i, [math.floor(256 * x) for x in e]) for i, e in rows if i is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    found = set()
    for q, a in {i: e for i, e in use if i % every == 0}.items():
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in use if i != q and len(b) == len(a))
        found |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return found


def block_of(tmp_path, ids, exact):
    lists = pa.array(exact.tolist(), pa.list_(pa.int64()))
    written = v._write_blocks(f"file://{tmp_path}")(iter([pa.RecordBatch.from_arrays([pa.array(ids), lists], names=["vec_id", "v"])]))
    return [v.Block(**row) for batch in written for row in batch.to_pylist()]


def test_block_search_like_brute_force(tmp_path):
    rng = np.random.default_rng(1)
    for n, d in ((1, 3), (7, 2), (700, 16), (300, 1)):
        exact = rng.integers(-256, 256, (n, d)) // rng.integers(1, 90)
        exact[: n // 3] = exact[0]
        ids = np.arange(n) * 10
        (block,) = block_of(tmp_path, ids, exact)
        lower, upper, _ = block.bounds(exact[:20])
        true = exact[:20] @ block.file.rows(np.arange(block.u), d).T
        assert (lower <= true).all() and (true <= upper).all()
        got = list(block.search(ids[:20], exact[:20], 5))
        for q in range(min(20, n)):
            scored = sorted((-int(exact[i] @ exact[q]), int(ids[i])) for i in range(n) if i != q)[:5]
            assert [(s, i) for qq, i, s in got if qq == ids[q]] == [(-s, i) for s, i in scored]


def test_few_exact_vectors_are_read(tmp_path):
    rng = np.random.default_rng(3)
    exact = np.floor(rng.normal(0, 32, (20_000, 64))).astype(np.int64)
    exact[:7000] = exact[0]
    ids = np.arange(len(exact))
    (block,) = block_of(tmp_path, ids, exact)
    asked = np.array([0, 1, 9000, 15000])
    got = list(block.search(asked, exact[asked], 5))
    for q in asked.tolist():
        scores = exact @ exact[q]
        want = [i for i in np.lexsort((ids, -scores)).tolist() if i != q][:5]
        assert [i for qq, i, _ in got if qq == q] == want
    assert block.reads < 0.02 * len(exact) * len(asked)


def test_large_components(tmp_path):
    rng = np.random.default_rng(4)
    for most in (1 << 30, 1 << 40, (1 << 63) - 1):
        exact = rng.integers(-most, most, (200, 4))
        exact[0] = -most - 1
        (block,) = block_of(tmp_path, np.arange(200), exact)
        got = list(block.search(np.arange(10), exact[:10], 5))
        for q in range(10):
            score = lambda i: min(max(sum(int(a) * int(b) for a, b in zip(exact[i], exact[q])), -(1 << 63)), (1 << 63) - 1)
            scored = sorted((-score(i), i) for i in range(200) if i != q)[:5]
            assert [(s, i) for qq, i, s in got if qq == q] == [(-s, i) for s, i in scored]


def test_reads_at_a_place(tmp_path):
    exact = np.arange(30).reshape(10, 3)
    (block,) = block_of(tmp_path, np.arange(10), exact)
    mapped = block.file.rows(np.array([7, 2]), 3)
    path = block.file.map.filename
    block.file.map, block.file.source = None, fs.LocalFileSystem().open_input_file(str(path))
    assert np.array_equal(block.file.rows(np.array([7, 2]), 3), mapped)


def test_rows(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(400)]
    rows += [(400, None), (401, [float("nan")] * 8), (402, [float("inf")] * 8), (403, [None] * 8), (None, rows[0][1]), (404, [])]
    rows += [(1000 + i, rows[50][1]) for i in range(10)] + [(100, rows[100][1])]
    frame = spark.createDataFrame([(i, e, 1) for i, e in rows], "vec_id long, embedding array<double>, rank int")
    want = plain(rows)
    for most, share in ((1 << 20, 16), (200, 16), (200, 1), (200, 1 << 40)):  # thresholds from some blocks, from all, from one in four
        monkeypatch.setattr(v, "FIRST_SHARE", share)
        for name in ("BLOCK_COMPONENTS", "QUERY_COMPONENTS", "BOUNDS"):
            monkeypatch.setattr(v, name, most)
        got = list(map(tuple, v.top_k(frame).collect()))
        assert len(got) == len(want) and set(got) == want
    assert v.top_k(frame.limit(0)).collect() == []
    few = frame.filter("vec_id in (50, 51)")
    assert [r["vec_id"] for r in v.top_k(few).collect()] == [51]


def test_thresholds_leave_what_reaches_them(tmp_path):
    """With the k-th best score of other vectors as threshold, a block reports just what reaches it, ties included, and reads less."""
    rng = np.random.default_rng(6)
    exact = np.floor(rng.normal(0, 32, (6000, 16))).astype(np.int64)
    ids = np.arange(len(exact))
    queries = exact[:40]
    scores = queries @ exact.T
    scores[np.arange(40), np.arange(40)] = LONG_MIN = np.iinfo(np.int64).min
    least = np.sort(scores[:, :3000], axis=1)[:, -5]
    (block,) = block_of(tmp_path, ids[3000:], exact[3000:])
    got = list(block.search(ids[:40], queries, 5, least))
    few, block.reads = block.reads, 0
    assert len(list(block.search(ids[:40], queries, 5))) == 200 and few < block.reads
    for q in range(40):
        want = [(int(scores[q, i]), int(i)) for i in np.lexsort((ids, -scores[q])) if i >= 3000 and scores[q, i] >= least[q]][:5]
        assert [(s, i) for qq, i, s in got if qq == q] == want
    tied = np.sort(scores[:, 3000:], axis=1)[:, -1]
    assert {q for q, _, s in block.search(ids[:40], queries, 5, tied) if s == tied[q]} == set(range(40))
    assert not list(block.search(ids[:40], queries, 5, tied + 1)) and tied.min() > LONG_MIN
