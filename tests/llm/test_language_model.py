import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sheafmill.llm import language_model as lm


def plain(train, every):
    """The formulas on dictionaries."""
    texts = [["<b>", *lm.words_of(t or ""), "<e>"] for t in train]
    uni, pairs, before, after = Counter(), Counter(), defaultdict(set), defaultdict(list)
    for t in texts:
        uni.update(t[1:])
        pairs.update(zip(t, t[1:]))
    for (h, w), c in pairs.items():
        before[w].add(h)
        after[h].append(c)
    n, v = sum(uni.values()), len(uni)
    of = lambda values: [sum(x == k for x in values) for k in (1, 2, 3, 4)]
    d2, d1 = lm.discounts(*of(pairs.values())), lm.discounts(*of([len(b) for b in before.values()]))
    cut = lambda c, d: 0 if c == 0 else d[min(c, 3) - 1]

    def low(w):
        a = len(before.get(w, ()))
        return (a - cut(a, d1)) / len(pairs) + sum(cut(len(b), d1) for b in before.values()) / len(pairs) / (v + 1)

    def p(w, h):
        counts = after.get(h)
        if not counts:
            return low(w)
        c = pairs.get((h, w), 0)
        return (c - cut(c, d2)) / sum(counts) + sum(cut(x, d2) for x in counts) / sum(counts) * low(w)

    out = []
    for t in every:
        words = ["<b>", *lm.words_of(t or ""), "<e>"]
        own = words[1:]
        out.append((len(own), sum(uni[w] > 0 for w in own), sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in own), sum(math.log10(p(w, h)) for h, w in zip(words, own))))
    some = random.Random(1).choice(list(after))
    assert abs(sum(p(w, some) for w in [*uni, "<never seen>"]) - 1) < 1e-9
    return n, out


@pytest.mark.parametrize("small", [False, True])
def test_like_dictionaries(spark, tmp_path, monkeypatch, small):
    if small:
        for name, value in (("DISTINCT_TOKENS", 20), ("GATHERED_TOKENS", 50), ("BLOCK", 7), ("REMEMBERED", 30)):
            monkeypatch.setattr(lm, name, value)
    rng = random.Random(7)
    words = [f"w{int(rng.paretovariate(0.7)) % 90}" for _ in range(400)]
    rows = [(i, " \n".join(rng.choice(words) for _ in range(rng.randint(0, 30))), "x") for i in range(300)]
    rows += [(500, None, "x"), (501, "", "x"), (None, "W1 É w2 never-seen", "x"), (3, rows[3][1], "x")]
    spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = lm.op3_kneser_ney(spark, str(tmp_path)).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    n, want = plain([t for i, t, _ in rows if not held(i)], [t for _, t, _ in rows])
    assert len(got) == len(rows) and {r["train_tokens"] for r in got} == {n}
    key = lambda x: (str(x[0]), x[2], x[5])
    mine = sorted((tuple(r)[:4] + tuple(r)[5:] for r in got), key=lambda x: (str(x[0]), x[2], round(x[5], 6)))
    theirs = sorted(((i, held(i), *w) for (i, _, _), w in zip(rows, want)), key=lambda x: (str(x[0]), x[2], round(x[5], 6)))
    for a, b in zip(mine, theirs):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-8 and abs(a[5] - b[5]) < 1e-8


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert lm.op3_kneser_ney(spark, str(tmp_path)).collect() == []
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert {(r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in lm.scores(docs, lm.fit(docs.limit(0))).collect()} == {(3, 0, 0.0, 0.0), (1, 0, 0.0, 0.0)}


def test_blocks():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 500).astype(np.uint64) * 2 + 1)
    values = rng.integers(1, 1000, len(keys)).astype(np.uint64)
    a, b = lm.unpack(lm.pack(keys, values), 2)
    assert np.array_equal(a, keys) and np.array_equal(b, values)
    a, b = lm.merged([lm.pack(keys, values), lm.pack(keys[:10], values[:10])], 2)
    assert np.array_equal(a, keys) and b.sum() == values.sum() + values[:10].sum()


def test_better_than_base(spark):
    got = lm.op3_kneser_ney(spark, "/root/testdata/sf0.01").filter("held_out").toPandas()
    assert len(got) > 50 and got["score"].sum() > got["base_score"].sum()
