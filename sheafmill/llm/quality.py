"""Document quality from a linear-chain conditional random field over lines.

Every line that is not blank is good or bad. A line's potentials are linear in features of the line itself and of the lines before and after it
(character classes, words, repetition, how it starts and ends); neighbouring labels have their own potentials.
Forward-backward gives each line's probability of being good; a document's raw quality is the mean of these, weighted
by line length, and a logistic calibration turns it into the probability of label 1 at the labels' own shares.

The field and the calibration are fitted on the driver on at most SAMPLE labelled documents of each class outside the held-out fold, where a
document's label stands for its lines; of a document of over SAMPLE_LINES lines four stretches of so many lines together stand for it in the fit (scoring takes all).

Defined cases: null is the empty text; a text without a line that is not blank has score 0; texts are scored one by one, so
ties and repeated rows do not matter; a null doc_id is not held out; without labelled rows of both classes the score of any other text is the share of label 1 (0.5
if there are none); an empty table gives an empty result; other columns are not read (`keep_good` carries them).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill.llm.common import documents, fold_remainder, text_session, texts, tidy
from sheafmill.llm.folds import labelled_sample, logistic

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
#: Labelled documents of each class that the field is fitted on, at most, and the most lines that such a document has.
SAMPLE = 2500
SAMPLE_LINES = 256
#: Lines whose features a task of the fit hands on at a time.
FIT_LINES = 4096
ROUNDS = 120
L2 = 1e-3
#: Lines whose features are held at once.
BLOCK_LINES = 1 << 14
#: Documents whose chains are run side by side.
SIDE_BY_SIDE = 128

_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _BANG, _BAR, _SIGN = range(8)
OWN = 15
WIDTH = 3 * OWN + 3

_TABLE: np.ndarray | None = None


def _class(c: str) -> int:
    if c.isalpha():
        return _UPPER if c.isupper() else _LOWER
    if c.isdigit():
        return _DIGIT
    if c.isspace():
        return _SPACE
    return _STOP if c in ".,;:'\"-()?" else _BANG if c == "!" else _BAR if c == "|" else _SIGN


def _classes(text: str) -> np.ndarray:
    global _TABLE
    if _TABLE is None:
        _TABLE = np.array([_class(chr(i)) if not 0xD800 <= i < 0xE000 else _SIGN for i in range(1 << 16)], dtype=np.uint8)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(codes < 1 << 16, _TABLE[np.minimum(codes, (1 << 16) - 1)], _LOWER)


def lines_of(text: str) -> list[str]:
    """The lines that are not blank."""
    return [x for x in text.split("\n") if x and not x.isspace()]


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A row of WIDTH features for each line that is not blank, and the lines' lengths."""
    lines = lines_of(text)
    blocks = list(feature_blocks(lines))
    return np.concatenate(blocks) if blocks else np.empty((0, WIDTH), dtype=np.float32), np.array([len(x) for x in lines], dtype=np.float64)


def feature_blocks(lines: list[str]) -> Iterator[np.ndarray]:
    """The features of lines, of at most BLOCK_LINES at a time; repetition is that in the whole text."""
    seen = Counter(lines)
    for start in range(0, len(lines), BLOCK_LINES):
        yield features_between(lines, start, min(len(lines), start + BLOCK_LINES), seen)


def features_between(lines: list[str], start: int, stop: int, seen: Counter) -> np.ndarray:
    """The features of the lines from start to before stop; the lines beside them are features too."""
    first = max(0, start - 1)
    own = own_features(lines[first : stop + 1], seen)
    n = stop - start
    out = np.zeros((n, WIDTH), dtype=np.float32)
    out[:, :OWN] = own[start - first : start - first + n]
    before = own[: start - first + n - 1]
    out[n - len(before) :, OWN : 2 * OWN] = before
    after = own[start - first + 1 : start - first + 1 + n]
    out[: len(after), 2 * OWN : 3 * OWN] = after
    out[0, 3 * OWN] = start == 0
    out[-1, 3 * OWN + 1] = stop == len(lines)
    out[:, 3 * OWN + 2] = 1
    return out


def own_features(lines: list[str], seen: Counter) -> np.ndarray:
    """What is said of each line by itself."""
    n = len(lines)
    lengths = np.array([len(x) for x in lines], dtype=np.float64)
    classes = _classes("".join(lines))
    starts = np.concatenate([[0], np.cumsum(lengths[:-1])]).astype(np.int64)
    count = [np.add.reduceat(classes == k, starts, dtype=np.int64) for k in range(8)]
    words = [x.split() for x in lines]
    n_words = np.array([len(w) for w in words], dtype=np.float64)
    distinct = np.array([len(set(w)) for w in words], dtype=np.float64)
    letters = count[_LOWER] + count[_UPPER]
    own = np.empty((n, OWN), dtype=np.float32)
    own[:, 0] = np.log1p(lengths)
    own[:, 1] = np.log1p(n_words)
    own[:, 2] = count[_UPPER] / np.maximum(1, letters)
    own[:, 3] = letters / lengths
    for i, k in enumerate((_DIGIT, _STOP, _BANG, _BAR, _SIGN)):
        own[:, 4 + i] = np.sqrt(count[k] / lengths)
    own[:, 9] = distinct / n_words
    own[:, 10] = letters / n_words / 10
    own[:, 11] = [seen[x] > 1 for x in lines]
    own[:, 12] = [x.lstrip()[0].isupper() for x in lines]
    own[:, 13] = [x.rstrip()[-1] in ".!?" for x in lines]
    own[:, 14] = count[_SIGN] > 0.1 * n_words
    return own


def forward_backward(potentials: np.ndarray, lengths: np.ndarray, pairs: np.ndarray, with_pairs: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of chains side by side.

    potentials: (chain, line, label), padded; lengths: lines of each chain; pairs: (label, next label). Returns the
    labels' marginals (chain, line, label) and the summed marginals of neighbouring labels (chain, label, next label).
    """
    b, t, _ = potentials.shape
    ahead = np.zeros((b, t, 2))
    back = np.zeros((b, t, 2))
    ahead[:, 0] = potentials[:, 0]
    for i in range(1, t):
        x = ahead[:, i - 1, :, None] + pairs
        ahead[:, i] = np.logaddexp(x[:, 0], x[:, 1]) + potentials[:, i]
    for i in range(t - 2, -1, -1):
        x = pairs + (potentials[:, i + 1] + back[:, i + 1])[:, None, :]
        step = np.logaddexp(x[..., 0], x[..., 1])
        back[:, i] = np.where((i + 1 < lengths)[:, None], step, 0)
    both = ahead + back
    total = np.logaddexp(both[:, 0, 0], both[:, 0, 1])
    marginals = np.exp(both - total[:, None, None])
    joint = np.zeros((b, 2, 2))
    for i in range(t - 1 if with_pairs else 0):
        x = np.exp(ahead[:, i, :, None] + pairs + (potentials[:, i + 1] + back[:, i + 1])[:, None, :] - total[:, None, None])
        joint += np.where((i + 1 < lengths)[:, None, None], x, 0)
    return marginals, joint


def good_marginals(score: np.ndarray, counts: np.ndarray, pairs: np.ndarray, with_pairs: bool = False):
    """For all lines of documents one after another (score: potential of good against bad), the probability of good; and, if asked, the sum of the pair marginals."""
    out, joint = np.empty(len(score)), np.zeros((2, 2))
    first = np.concatenate([[0], np.cumsum(counts)])
    order = np.argsort(counts, kind="stable")
    order = order[counts[order] > 0]
    at = 0
    while at < len(order):
        stop = at + 1
        while stop < len(order) and stop - at < SIDE_BY_SIDE and counts[order[stop]] <= 2 * counts[order[at]] + 8:
            stop += 1
        part = order[at:stop]
        longest = counts[part[-1]]
        potentials = np.zeros((len(part), longest, 2))
        for k, d in enumerate(part):
            potentials[k, : counts[d], 1] = score[first[d] : first[d + 1]]
        marginals, two = forward_backward(potentials, counts[part], pairs, with_pairs)
        for k, d in enumerate(part):
            out[first[d] : first[d + 1]] = marginals[k, : counts[d], 1]
        if with_pairs:
            joint += two.sum(axis=0)
        at = stop
    return (out, joint) if with_pairs else out


class Field:
    """A fitted field: weights of the scaled features, label pairs, calibration (slope, intercept)."""

    def __init__(self):
        self.mean, self.scale = np.zeros(WIDTH), np.ones(WIDTH)
        self.w, self.pairs = np.zeros(WIDTH), np.zeros((2, 2))
        self.slope, self.intercept = 0.0, 0.0

    def raw(self, scores: list[np.ndarray], lengths: list[np.ndarray]) -> np.ndarray:
        """The length-weighted good marginals of documents by their lines' scores, as log odds; lines are needed."""
        counts = np.array([len(x) for x in scores])
        good = good_marginals(np.concatenate(scores), counts, self.pairs)
        weights = np.concatenate(lengths)
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        mean = np.add.reduceat(good * weights, first) / np.add.reduceat(weights, first)
        mean = np.clip(mean, 1e-4, 1 - 1e-4)
        return np.log(mean / (1 - mean))

    def line_scores(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.scale) @ self.w

    def scores(self, every: list[str]) -> np.ndarray:
        """The scores of texts; lines wait as one number each, and their features are made BLOCK_LINES at a time."""
        out = np.zeros(len(every))
        waiting: list[tuple[int, np.ndarray, np.ndarray]] = []
        size = 0

        def settle():
            if waiting:
                at, scores, lengths = zip(*waiting)
                out[list(at)] = logistic(self.slope * self.raw(scores, lengths) + self.intercept)
                waiting.clear()

        for i, text in enumerate(every):
            lines = lines_of(text)
            if lines:
                waiting.append((i, np.concatenate([self.line_scores(x) for x in feature_blocks(lines)]), np.array([len(x) for x in lines], dtype=np.float64)))
                size += len(lines)
            if size > 4 * BLOCK_LINES:
                settle()
                size = 0
        settle()
        return out


def fit_field(features: list[np.ndarray], lengths: list[np.ndarray], y: np.ndarray, shares: tuple[float, float]) -> Field:
    """Maximum likelihood by Adam; each class weighs the same in the field, and by shares (of label 0 and 1) in the calibration."""
    field = Field()
    x = np.concatenate(features).astype(np.float64)
    counts = np.array([len(f) for f in features])
    field.mean, field.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    field.mean[-1], field.scale[-1] = 0, 1
    x = (x - field.mean) / field.scale
    label = np.repeat(y, counts)
    share = np.where(label == 1, 0.5 / max(1, (label == 1).sum()), 0.5 / max(1, (label == 0).sum()))
    params = np.zeros(WIDTH + 1)  # the last: how much equal neighbours count
    m, s = np.zeros_like(params), np.zeros_like(params)
    n_pairs = max(1, (counts - 1).sum())
    for t in range(1, ROUNDS + 1):
        pairs = np.array([[params[-1], 0], [0, params[-1]]])
        good, joint = good_marginals(x @ params[:-1], counts, pairs, True)
        g = np.empty_like(params)
        g[:-1] = x.T @ ((good - label) * share) + L2 * params[:-1]
        g[-1] = (joint[0, 0] + joint[1, 1] - n_pairs) / n_pairs + 0.05 * params[-1]
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        params = params - 0.1 / (1 + t / 50) * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
    field.w, field.pairs = params[:-1], np.array([[params[-1], 0], [0, params[-1]]])
    raw = field.raw([field.line_scores(f) for f in features], lengths)
    each = np.where(y == 1, shares[1] / max(1, (y == 1).sum()), shares[0] / max(1, (y == 0).sum()))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton, with a weak prior on the slope
        p = logistic(a * raw + b)
        g = np.array([((p - y) * raw * each).sum() + 1e-3 * (a - 1), ((p - y) * each).sum()])
        v = np.maximum(p * (1 - p), 1e-6) * each
        h = np.array([[(v * raw * raw).sum() + 1e-3, (v * raw).sum()], [(v * raw).sum(), v.sum()]])
        step = np.linalg.solve(h + 1e-9 * np.eye(2), g)
        step *= min(1.0, 1.0 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
    field.slope, field.intercept = float(max(a, 0.05)), float(b)
    return field


def stretches(n: int) -> list[tuple[int, int]]:
    """The lines that stand for a labelled document of n, as (start, stop): all up to SAMPLE_LINES, else four stretches of it, evenly apart, of so many together."""
    if n <= SAMPLE_LINES:
        return [(0, n)] if n else []
    part = SAMPLE_LINES // 4
    return [(start, start + part) for k in range(4) for start in [k * (n - part) // 3]]


def sampled_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """As line_features(), of the lines that stand for the document: no others are worked out."""
    lines = lines_of(text)
    seen = Counter(lines)
    found = [(features_between(lines, a, b, seen), [len(x) for x in lines[a:b]]) for a, b in stretches(len(lines))]
    return (np.concatenate([x for x, _ in found]), np.array([z for _, zs in found for z in zs], dtype=np.float64)) if found else (np.empty((0, WIDTH), dtype=np.float32), np.empty(0))


@tidy
def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, features, lengths) of documents that have lines; a batch is handed on when it holds FIT_LINES lines."""
    names, held = ["label", "features", "lengths"], []

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([y for y, _, _ in held], pa.int32()), pa.array([x.ravel() for _, x, _ in held], pa.list_(pa.float32())), pa.array([z for _, _, z in held], pa.list_(pa.float64()))], names=names)

    for batch in batches:
        for label, text in zip(batch.column(batch.schema.get_field_index("label")).to_pylist(), texts(batch)):
            x, z = sampled_features(text)
            if len(x):
                held.append((label, x, z))
            if sum(len(z) for _, _, z in held) >= FIT_LINES:
                yield packed()
                held.clear()
    if held:
        yield packed()


def fit(docs: DataFrame, labels: DataFrame) -> Field:
    """labels: (doc_id, label)."""
    text_session(docs.sparkSession)
    sample, counts = labelled_sample(docs, labels, fold_remainder("doc_id", FOLDS) != HELD_OUT, SAMPLE)
    zeros, ones = counts.get(0, 0), counts.get(1, 0)
    rows = sample.mapInArrow(_featured, "label int, features array<float>, lengths array<double>").toArrow() if zeros and ones else None
    if rows is None or len(set(rows["label"].to_pylist())) < 2:
        field = Field()
        share = (ones + 0.5) / (zeros + ones + 1) if zeros + ones else 0.5
        field.intercept = float(np.log(share / (1 - share)))
        return field
    features = [np.array(x.values, dtype=np.float32).reshape(-1, WIDTH) for x in rows["features"]]
    lengths = [np.array(x.values, dtype=np.float64) for x in rows["lengths"]]
    return fit_field(features, lengths, rows["label"].to_numpy().astype(np.float64), (zeros / (zeros + ones), ones / (zeros + ones)))


def _scored(field):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(field.value.scores(list(texts(batch))), pa.float64())], names=["doc_id", "score"])

    return run


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    field = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))  # some kilobytes
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(_scored(field), f"doc_id {kind}, score double")
    return scored.select("doc_id", (fold_remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def _good_rows(field):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(field.value.scores(list(texts(batch))) >= THRESHOLD, pa.bool_()))

    return run


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs whose score reaches THRESHOLD."""
    field = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    return docs.mapInArrow(_good_rows(field), docs.schema)


def quality_labels(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))


def op1_quality_crf(spark, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir), quality_labels(spark, sf_dir))
