import itertools
import random

import numpy as np

from sheafmill.llm import quality as q

SF = "/root/testdata/sf0.01"


def test_forward_backward_like_enumeration():
    rng = np.random.default_rng(1)
    pairs = rng.normal(size=(2, 2))
    lengths = np.array([1, 3, 5, 2])
    potentials = rng.normal(size=(4, 5, 2))
    marginals, joint = q.forward_backward(potentials, lengths, pairs)
    for c, n in enumerate(lengths):
        weights, good, two = 0, np.zeros((n, 2)), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(potentials[c, i, y[i]] for i in range(n)) + sum(pairs[y[i], y[i + 1]] for i in range(n - 1)))
            weights += w
            for i in range(n):
                good[i, y[i]] += w
            for i in range(n - 1):
                two[y[i], y[i + 1]] += w
        assert np.allclose(marginals[c, :n], good / weights)
        assert np.allclose(joint[c], two / weights)


def test_marginals_of_many_documents():
    rng = np.random.default_rng(2)
    counts = np.array([0, 3, 700, 1, 0, 40, 2] + [5] * 300)
    score, pairs = rng.normal(size=counts.sum()), np.array([[0.4, 0], [0, 0.4]])
    got, at = q.good_marginals(score, counts, pairs), 0
    for n in counts:
        if n:
            one = np.zeros((1, n, 2))
            one[0, :, 1] = score[at : at + n]
            assert np.allclose(got[at : at + n], q.forward_backward(one, np.array([n]), pairs)[0][0, :, 1])
        at += n


def test_features():
    x, lengths = q.line_features("Good line one.\n\n  \nBAD!! | ###\nGood line one.")
    assert x.shape == (3, q.WIDTH) and lengths.tolist() == [14, 11, 14]
    assert x[0, 11] == x[2, 11] == 1 and x[1, 11] == 0
    assert np.allclose(x[1, q.OWN : 2 * q.OWN], x[0, : q.OWN]) and np.allclose(x[1, 2 * q.OWN : 3 * q.OWN], x[2, : q.OWN])
    assert x[0, 2] == np.float32(1 / 11) and np.isfinite(x).all()
    assert len(q.line_features("\n \n")[0]) == 0


def test_held_out_accuracy(spark):
    got = q.op1_quality_crf(spark, SF)
    assert got.count() == 1000
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.join(labels, "doc_id").filter("held_out").select("predicted", "quality").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95


def test_edges(spark):
    rng = random.Random(1)

    def text(i):
        words = [rng.choice(["tree", "house", "river", "stone"]) for _ in range(40)]
        return "\n".join(" ".join(words[k : k + 10]).capitalize() + "." for k in range(0, 40, 10)) if i % 2 else "\n".join("### $$$ " + w.upper() + "!!" for w in words)

    rows = [(i, text(i), "x") for i in range(60)] + [(None, None, None), (70, "", "y"), (71, " \n", "y"), (72, "A fine line.\n" * 50_000, "z"), (1, text(1), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (3, None)], "doc_id long, label int")
    got = q.quality(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == r["doc_id"] % 2 for r in got if r["doc_id"] is not None and r["doc_id"] < 60)
    assert all(r["score"] == 0 for r in got if r["doc_id"] in (None, 70, 71))
    assert {r["doc_id"] for r in q.keep_good(docs, labels).collect()} >= {i for i in range(60) if i % 2}
    assert {r["score"] for r in q.quality(docs, labels.limit(0)).collect()} == {0.0, 0.5}
    assert q.quality(docs.limit(0), labels).collect() == []


def test_many_short_lines(monkeypatch):
    """Blocks change no feature and no score; megabytes of short lines need little memory; long documents are in the fit."""
    import tracemalloc

    rng = random.Random(1)
    text = "\n".join(rng.choice(["A b.", "12|34", "", "Some longer line of words!", "x"]) for _ in range(700))
    want, lengths = q.line_features(text)
    field = q.Field()
    field.w, field.slope = np.linspace(-1, 1, q.WIDTH), 1.0
    field.pairs = np.array([[0.5, 0], [0, 0.5]])
    score = field.scores([text, "", "one line", text + "\nmore"])
    for block in (1, 2, 7, 699):
        monkeypatch.setattr(q, "BLOCK_LINES", block)
        got, same = q.line_features(text)
        assert np.array_equal(got, want) and np.array_equal(same, lengths)
        assert np.allclose(field.scores([text, "", "one line", text + "\nmore"]), score)
    monkeypatch.undo()
    tracemalloc.start()
    field.scores(["ab\ncd\n" * 60_000] * 4)
    assert tracemalloc.get_traced_memory()[1] < 120e6
    tracemalloc.stop()
    for n in (1, q.SAMPLE_LINES, q.SAMPLE_LINES + 1, 90_000):
        at = [i for a, b in q.stretches(n) for i in range(a, b)]
        assert len(at) == min(n, q.SAMPLE_LINES) and len(set(at)) == len(at) and max(at) == n - 1 and min(at) == 0
    assert q.stretches(0) == []


def test_fit_works_out_the_lines_that_it_takes_only():
    """The features are those of scoring, and a text of many short lines needs little more memory than its lines."""
    import tracemalloc

    rng = random.Random(2)
    text = "\n".join(rng.choice(["A b.", "12|34", "Some longer line of words!", "x"]) for _ in range(1500))
    whole, lengths = q.line_features(text)
    at = [i for a, b in q.stretches(1500) for i in range(a, b)]
    some, same = q.sampled_features(text)
    assert np.array_equal(some, whole[at]) and np.array_equal(same, lengths[at])
    assert q.sampled_features(" \n")[0].shape == (0, q.WIDTH)
    long = "ab\ncd\n" * 300_000
    tracemalloc.start()
    q.sampled_features(long)
    assert tracemalloc.get_traced_memory()[1] < 60e6  # 115 MB of features for all lines
    tracemalloc.stop()
