import random

from sheafmill.llm import decontaminate as d


def plain(docs, items):
    def shingles(words, w):
        return {tuple(words[i : i + w]) for i in range(len(words) - w + 1)}

    found = []
    for i, t in docs:
        words = d.WORDS.findall((t or "").lower())
        for j, q in items:
            own = d.WORDS.findall((q or "").lower())
            if not own:
                continue
            a = shingles(own, min(5, len(own)))
            both = a & shingles(words, min(5, len(own)))
            if len(both) >= 0.8 * len(a):
                found.append((i, j, len(a), len(both)))
    return sorted(found, key=str)


def run(spark, docs, items):
    left = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    right = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int")
    got = sorted((tuple(r)[:4] for r in d.contained_items(left, right).collect()), key=str)
    kept = sorted((tuple(r)[:2] for r in d.drop_contaminated(left, right).collect()), key=str)
    bad = {r[0] for r in got}
    assert kept == sorted((x for x in docs if x[0] not in bad), key=str)
    return got


def test_like_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 4, 5, 6, 9, 17, 40])))) for i in range(40)]
    docs = []
    for i in range(200):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 300))]
        for _, q in rng.sample(items, 2):
            own = q.split()
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            at = rng.randint(0, len(words))
            words[at:at] = own
        docs.append((i, ("  " if i % 2 else ", ").join(words).upper()))
    want = plain(docs, items)
    assert len(want) > 50
    assert run(spark, docs, items) == want
    monkeypatch.setattr(d, "ITEM_BLOCK_WORDS", 150)
    monkeypatch.setattr(d, "REMEMBERED_SHINGLES", 10)
    monkeypatch.setattr(d, "BLOCK", 64)
    assert run(spark, docs, items) == want


def test_edges(spark):
    item = "one two three four five six seven"
    docs = [(1, item), (1, item), (2, None), (3, ""), (4, "x " * 400_000 + item), (5, "other text")]
    items = [(7, item), (7, item), (8, None), (9, ""), (10, "OTHER")]
    assert run(spark, docs, items) == plain(docs, items)
    empty = spark.createDataFrame([], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.contained_items(empty, spark.createDataFrame(items, "item_id long, text string")).collect() == []
    assert d.contained_items(spark.createDataFrame(docs, "doc_id long, text string"), none).collect() == []
    nulls = spark.createDataFrame([(None, item)], "doc_id long, text string")
    assert [tuple(r)[:2] for r in d.contained_items(nulls, spark.createDataFrame([(None, item)], "item_id long, text string")).collect()] == [(None, None)]
