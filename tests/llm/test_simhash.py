import random
import re

import xxhash

from sheafmill.llm import simhash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def plain_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def check(spark, rows, **names):
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string, fp int")
    got = {(r["doc_id"], r["fp"] % (1 << 64)): r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    fps = [plain_fingerprint(r[1]) for r in rows]
    roots = plain_components(fps)
    least = {}
    for r, root in zip(rows, roots):
        if r[0] is not None:
            least[root] = min(least.get(root, r[0]), r[0])
    assert got == {(r[0], f): least.get(root) for r, f, root in zip(rows, fps, roots)}


def test_edges(spark):
    rows = [(5, "A b c d", "x", 1), (3, "a  B\tc d", "x", 1), (9, None, None, None), (2, "", "y", 2), (7, " \n", "y", 2), (8, "one", "z", 3), (8, "one", "z", 3), (None, "alone here", "q", 0), (1, "two words", "q", 0), (None, "TWO words", "q", 0)]
    check(spark, rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.drop_near_duplicates(empty).collect() == []
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string, fp int")
    kept = sorted(simhash.drop_near_duplicates(docs).collect(), key=str)
    assert [(r["doc_id"], r["text"]) for r in kept] == [(1, "two words"), (2, ""), (3, "a  B\tc d"), (8, "one"), (None, "alone here")]


def test_very_long_text():
    words = [f"w{i % 977}" for i in range(3 * simhash.BLOCK)]
    assert simhash.fingerprint(" ".join(words)) == plain_fingerprint(" ".join(words))


def near(rng, value, bits):
    for b in rng.sample(range(64), bits):
        value ^= 1 << b
    return value


def test_links_on_fingerprints(spark, monkeypatch):
    rng = random.Random(5)
    values = {0}
    for _ in range(60):
        value = rng.getrandbits(64)
        for _ in range(rng.randint(1, 5)):
            values.add(value)
            value = near(rng, value, rng.randint(1, 4))
    base = rng.getrandbits(64)
    values |= {near(rng, base, rng.randint(0, 3)) for _ in range(1500)}
    values = sorted(values)
    for hot in (1024, 8):
        monkeypatch.setattr(simhash, "HOT_POSTING", hot)
        fps = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
        found = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in simhash.components(simhash.links(fps)).collect()}
        roots = plain_components(values)
        groups, mine = {}, {}
        for v, r in zip(values, roots):
            groups.setdefault(r, set()).add(v)
            mine.setdefault(found.get(v, v), set()).add(v)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_tally_drops_candidates_in_lists_of_all_lengths(monkeypatch):
    """Members that agree in four bytes: links are those of brute force, and most pairs go by the tally, before any bits are counted."""
    import numpy as np

    rng = random.Random(3)
    for n in (2, 3, 40, 700, 2500):
        base = rng.getrandbits(64)
        members = {base ^ (rng.getrandbits(32) << 16) for _ in range(n // 2)}
        while len(members) < n:
            members.add(near(rng, rng.choice(sorted(members)[:50]), 1))
        members = np.array(sorted(members), dtype=np.uint64)
        shared = simhash.tally(members, members)
        bits = np.bitwise_count(members[:, None] ^ members[None, :])
        assert np.array_equal(shared, sum((members[:, None] >> np.uint64(8 * p) & np.uint64(255)) == (members[None, :] >> np.uint64(8 * p) & np.uint64(255)) for p in range(8)))
        assert not ((bits <= simhash.MAX_BITS) & (shared < simhash.MIN_SHARED)).any()
        if n > 100:
            assert (shared < simhash.MIN_SHARED).mean() > 0.5
        monkeypatch.setattr(simhash, "TALLIED", 1 << 12)
        monkeypatch.setattr(simhash, "HOT_POSTING", 1 << 12)
        label, root = simhash._labels(members), np.arange(n)
        while True:
            new = np.array([root[row].min() for row in bits <= simhash.MAX_BITS])
            if np.array_equal(new, root):
                break
            root = new
        assert np.array_equal(label, root)


def test_long_lists_like_all_pairs(monkeypatch):
    """Members that agree in six bytes, in any order: the labels are those of the pairs."""
    import numpy as np

    rng = np.random.default_rng(8)
    for shift, n in ((0, 1500), (24, 6000), (48, 20)):
        base = np.uint64(int(rng.integers(1 << 63)) * 2 + 1)
        members = base ^ (rng.choice(1 << 16, n, replace=False).astype(np.uint64) << np.uint64(shift))
        monkeypatch.setattr(simhash, "HOT_POSTING", 10)
        label = simhash._labels(members)
        monkeypatch.setattr(simhash, "HOT_POSTING", 1 << 20)
        assert np.array_equal(label, simhash._labels(members))
    sparse = np.uint64(1 << 63) | (np.array([0, 3, 12, 0x3F0, 0xFFFF], dtype=np.uint64) << np.uint64(20))
    monkeypatch.setattr(simhash, "HOT_POSTING", 2)
    assert simhash._labels(sparse).tolist() == [0, 0, 0, 3, 4]


def test_longest_list_takes_seconds():
    """All 65,536 fingerprints that agree in six bytes are one component; all pairs would be two thousand million."""
    import time

    import numpy as np

    members = np.uint64(0xABCDEF) | (np.arange(1 << 16, dtype=np.uint64) << np.uint64(48))
    start = time.time()
    assert not simhash._labels(members).any()
    assert time.time() - start < 30
