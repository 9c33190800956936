import random

import pytest

import corpus_pipeline
from sheafmill.llm import near_copies


def brute_force(rows):
    """The doc_ids that stay, by the Jaccard similarity of all pairs."""
    sets = []
    for _, text in rows:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
        sets.append({" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    group = list(range(len(rows)))
    links = [(a, b) for a in range(len(rows)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if group[a] != group[b]:
                group[a] = group[b] = min(group[a], group[b])
                changed = True
    least = {}
    for (i, _), g in zip(rows, group):
        least[g] = min(least.get(g, i), i)
    return sorted(least.values()), len(links)


def planted(seed):
    """Texts of which some are copies edited at up to a few places, a common line, a large group of copies, short and blank ones."""
    rng = random.Random(seed)
    line = "one very common line that stands in most of all texts"
    texts = ["", None, " \n", "one", "One", "two words", "a b c d", "a b c d e", "A b  c d E"]
    for _ in range(60):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(5, 150))]
        base = words + line.split() if rng.random() < 0.7 else words
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            copy = list(base)
            for _ in range(rng.randint(1, 4)):
                copy[rng.randrange(len(copy))] = f"edit{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    base = [f"g{rng.randrange(1000)}" for _ in range(120)]
    for _ in range(40):
        copy = list(base)
        for _ in range(rng.randint(1, 4)):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("common", [3, 1000])
def test_like_brute_force(spark, monkeypatch, common):
    monkeypatch.setattr(near_copies, "COMMON_COUNT", common)
    rows = planted(common)
    want, n_links = brute_force(rows)
    assert n_links > 100
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.keep_one_of_near_duplicates(spark, docs, "").collect()) == want


def test_given_tables(spark):
    """Pairs of 0.8 or more that lie 5 to 10 fingerprint bits apart."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want, _ = brute_force([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert sorted(r["doc_id"] for r in near_copies.drop_near_copies(docs).collect()) == want


def test_empty(spark):
    assert near_copies.drop_near_copies(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_lists_in_pieces(monkeypatch):
    """Lists that go over batches and pieces, with repeated members."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(9)
    for piece in (2, 4, 1000):
        monkeypatch.setattr(near_copies, "PIECE", piece)
        rows = sorted((k, f, 7) for k in range(-30, 30) for f in (rng.choices(range(100), k=rng.choice([1, 1, 2, 3, 30]))))
        cuts = sorted(rng.choices(range(len(rows) + 1), k=25))
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in p], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32()))], names=["key", "fp", "n"]) for p in parts]
        got = {}
        for batch in near_copies._list_batches(iter(batches)):
            for r in batch.to_pylist():
                assert len(r["members"]) == len(r["sizes"]) <= piece
                assert (r["list"], r["piece"]) not in got
                got[r["list"], r["piece"]] = r
        want = {}
        for k, f, _ in rows:
            want.setdefault(k, set()).add(f)
        for k, members in want.items():
            own = [got.pop((k, p)) for p in range(len(got)) if (k, p) in got]
            assert sum((r["members"] for r in own), []) == (sorted(members) if len(members) > 1 else [])
            assert all(r["center"] == min(members) for r in own)
        assert not got
    assert list(near_copies._list_batches(iter([]))) == []


def test_pairs_between_pieces():
    """Each pair that passes comes once, whatever lists and pieces both are in; sketches drop no similar pair."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(150)]
    sets = []
    for i in range(60):
        own = set(base)
        for h in rng.sample(base, rng.randint(0, 14)):
            own.remove(h)
            own.add(rng.getrandbits(64))
        sets.append(np.array(sorted(own), dtype=np.uint64))
    root = [rng.randrange(5) for _ in sets]
    lists = [sorted(rng.sample([10, 20, 30, 40], rng.randint(1, 4))) for _ in sets]
    rows = []
    for own in (10, 20, 30, 40):
        members = [i for i in range(len(sets)) if own in lists[i]]
        for a, b in ((0, 0), (0, 1), (1, 1)):
            m = [{"piece": i % 2, "node": i, "n": len(sets[i]), "root": root[i], "lists": lists[i], "sketch": near_copies.sketch(sets[i]).tolist()} for i in members if i % 2 in (a, b)]
            rows.append({"list": own, "a": a, "b": b, "m": m})
    kind = pa.struct([("piece", pa.int32()), ("node", pa.int64()), ("n", pa.int32()), ("root", pa.int64()), ("lists", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])
    batch = pa.RecordBatch.from_pylist(rows, schema=pa.schema([("list", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("m", pa.list_(kind))]))
    found = [(r["u"], r["v"]) for out in near_copies._pairs_between(iter([batch.slice(0, 2), batch.slice(2)])) for r in out.to_pylist()]
    assert len(found) == len(set(found))
    similar, dropped = set(), 0
    for u in range(len(sets)):
        for v in range(u + 1, len(sets)):
            if root[u] != root[v] and set(lists[u]) & set(lists[v]):
                if near_copies.similar(set(sets[u].tolist()), set(sets[v].tolist())):
                    similar.add((u, v))
                dropped += (u, v) not in found
    assert similar <= set(found) and len(similar) > 50 and dropped > 50


def test_columns_of_any_name_stay_as_they_are(spark):
    """Names that the operators use themselves are columns of the input like all others."""
    from sheafmill.llm import simhash

    names = "_p _hit hit row _bucket _bits _near_text near_text _told_id _told_text _stays text_hash fp n root stays doc.id".split()
    text = "some words that stand in two of the three documents here"
    rows = [(1, text, *range(len(names))), (2, text, *range(10, 10 + len(names))), (3, "quite another text with other words", *range(20, 20 + len(names)))]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    for drop in (near_copies.drop_near_copies, simhash.drop_near_duplicates):
        got = drop(docs)
        assert got.columns == docs.columns and got.dtypes == docs.dtypes
        assert sorted(map(tuple, got.collect())) == [rows[0], rows[2]]


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    names = "_p _hit row score predicted stays n_tokens spans".split()
    rows = [(i, f"A good line of words number {i} stands here.\nAnd one more line of it, {i * 7}.", *range(len(names))) for i in range(4)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    spark.createDataFrame([(9, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "an item that no document here has in it")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns and set(map(tuple, got.collect())) <= set(rows), name


def test_fingerprints_find_near_copies_before_the_prefix_filter(spark, monkeypatch):
    """What the byte-position index links is found without any posting list of shingles."""
    rows = planted(5)
    links = [(a, b) for a in range(len(rows)) for b in range(a)]
    own = [near_copies.hashes(t) for _, t in rows]
    bits = [near_copies.fingerprint(x) for x in own]
    close = [(a, b) for a, b in links if (bits[a] ^ bits[b]).bit_count() <= 2 and bits[a] != bits[b] and near_copies.similar(set(own[a].tolist()), set(own[b].tolist()))]
    assert close
    none = lambda batches: iter(())
    monkeypatch.setattr(near_copies, "_pair_batches", none)
    monkeypatch.setattr(near_copies, "between", lambda *_: spark.createDataFrame([], "u bigint, v bigint"))
    stay = {r["doc_id"] for r in near_copies.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(rows[a][0] not in stay or rows[b][0] not in stay for a, b in close)
