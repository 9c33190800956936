import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafmill.llm import toxicity as t

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def restorer():
    rng = np.random.default_rng(2)
    return t.Restorer(t.smoothed(rng.integers(0, 50, (64, 64, 64)).astype(float)))


def every_path(log, text):
    """The best score over all paths, one by one."""
    best = -1e9

    def go(i, a, b, last, score):
        nonlocal best
        if i == len(text):
            best = max(best, score + log[a][b][0])
            return
        c = text[i]
        if c in t.SEPARATORS:
            go(i + 1, a, b, last, score + t.SEPARATE)
        options = [(c, 0.0 if c.isalpha() else t.KEEP)] if not c.isspace() else []
        for x, cost in options + [(x, t.IMITATE) for x in t.IMITATES.get(c, "")]:
            k = t.char_class(x)
            if x == last and b == k:
                go(i + 1, a, b, last, score + t.REPEAT + cost)
            go(i + 1, b, k, x, score + cost + log[a][b][k])

    go(0, 0, 0, "", 0.0)
    return best


def test_viterbi_like_enumeration(restorer):
    rng = random.Random(3)
    for _ in range(80):
        text = "".join(rng.choice("aab1!0. s$-|é") for _ in range(rng.randint(1, 7)))
        link_score = every_path(restorer.model, text)
        assert abs(decoded_score(restorer, text) - link_score) < 1e-4, text


def decoded_score(restorer, text):
    """The best score of the paths that spell the decoded word."""
    word, log = restorer.decode(text), restorer.model
    best = -1e9

    def go(i, j, a, b, last, score):
        nonlocal best
        if i == len(text):
            if j == len(word):
                best = max(best, score + log[a][b][0])
            return
        c = text[i]
        if c in t.SEPARATORS:
            go(i + 1, j, a, b, last, score + t.SEPARATE)
        for x, cost in ([(c, 0.0 if c.isalpha() else t.KEEP)] if not c.isspace() else []) + [(x, t.IMITATE) for x in t.IMITATES.get(c, "")]:
            k = t.char_class(x)
            if x == last and b == k:
                go(i + 1, j, a, b, last, score + t.REPEAT + cost)
            if j < len(word) and word[j] == x:
                go(i + 1, j + 1, b, k, x, score + cost + log[a][b][k])

    go(0, 0, 0, 0, "", 0.0)
    return best


def test_restores_on_the_corpus(spark):
    restorer = t.Restorer(t.char_model(spark.read.parquet(f"{SF}/documents.parquet")))
    for seen, word in {"1d10t": "idiot", "i d i o t": "idiot", "m0r0n": "moron", "tr@sh": "trash", "the&&&": "the", "word,": "word", "s-c-u-m": "scum"}.items():
        assert restorer[seen] == word
    assert "idiot" in restorer.words("what an I D I O T he is")


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = t.op9_toxicity(spark, SF)
    assert got.count() == 1000
    rows = got.join(labels, "doc_id").filter("held_out").select("predicted", "toxic", "score").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edges(spark):
    rows = [(i, "you idiot moron" if i % 2 else "kind clear words", "x") for i in range(30)] + [(None, None, None), (40, "", "y"), (41, "zz " * 200_000, "z"), (1, "you idiot moron", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(None, 1), (3, None), (4, 0)], "doc_id long, label int")
    got = t.toxicity(docs, labels).collect()
    assert len(got) == len(rows)
    assert all(r["predicted"] == r["doc_id"] % 2 for r in got if r["doc_id"] is not None and r["doc_id"] < 30)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    none = t.toxicity(docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert t.toxicity(docs.limit(0), labels).collect() == []


def test_trigrams_of_long_texts(monkeypatch):
    """Counts do not depend on the blocks that a text is counted in."""
    import numpy as np
    import pyarrow as pa

    text = "Straße İΣ the quick brown fox, " * 40_000
    c = t.classes_of(f" {text} ").astype(np.int64)
    want = np.bincount((c[:-2] << 12) | (c[1:-1] << 6) | c[2:], minlength=t.CLASSES**3)
    for counted in (1 << 20, 1000, 7):
        monkeypatch.setattr(t, "COUNTED", counted)
        own = text if counted > 7 else text[:20_000]
        got = np.zeros(t.CLASSES**3, dtype=np.int64)
        for out in t._count_trigrams(iter([pa.RecordBatch.from_pydict({"text": [own]})])):
            got[out.column(0).to_numpy()] += out.column(1).to_numpy()
        if counted > 7:
            assert np.array_equal(got, want)
        else:
            assert got.sum() == len(f" {own} ".lower()) - 2
    assert len(text) > 1 << 20


def test_runs_at_marks():
    runs = lambda text: [m[0] for m in t._RUN.finditer(text)]
    assert runs("you i d i o t.") == ["i d i o t"] and runs('"i d i o t"') == ["i d i o t"]
    assert runs("x  i  d\ni o t!") and runs("an id is it") == []


def test_one_rule_of_counts(spark):
    """Scores add up what the fit was given: a feature counts MOST times at most in both."""
    import pyarrow as pa

    from sheafmill.llm import toxicity as t

    class Model:
        value = None

    class Plain:
        def __init__(self, _):
            pass

        def words(self, text):
            return set(text.split())

    own = np.zeros(t.FEATURES)
    own[t.features("abcx")[0]] = 0.5
    weights = type("Weights", (), {"value": own})
    text = " ".join(f"abc{c}" for c in "defghi")
    original, t.Restorer = t.Restorer, Plain
    try:
        batch = pa.RecordBatch.from_pydict({"label": [1], "text": [text]})
        counts = next(t._featured(Model)(iter([batch])))
        at = counts.column(1)[0].as_py().index(t.features("abcx")[0])
        assert counts.column(2)[0].as_py()[at] == t.MOST == 3
        score = next(t._scored(Model, weights, 0.0)(iter([pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text]})]))).column(1)[0].as_py()
    finally:
        t.Restorer = original
    assert abs(score - 1 / (1 + np.exp(-1.5))) < 1e-12
