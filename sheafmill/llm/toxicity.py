"""Toxicity after noisy-channel deobfuscation.

A token that is written in letters is itself. A token with digits or signs among its letters, or with a letter three
times in a row, and a run of three or more single characters apart (by any white space, between marks or not), is a lattice: each character may stand for itself, for the letters it
imitates (leetspeak), for nothing (separators, the spaces of a run) or for a repetition of the letter before. Viterbi
decoding finds the best path under a character trigram model and the channel's costs. The restored words are scored
by a logistic regression on the words and their beginnings.

The character model counts the trigrams of all whole texts (over an alphabet of 64 classes, so the counts are bounded). The
classifier is fitted on at most SAMPLE labelled documents of each class outside the held-out fold; a score is a
probability at the labels' own shares. Features are chosen in Spark; the driver gets only those in use.

Defined cases: null is the empty text, which has the score of no words; texts are scored one by one, so ties and
repeated rows do not matter; a null doc_id is not held out; without labelled rows of both classes every score is the share of label 1
(0.5 if there are none); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill.llm.common import Scratch, documents, fold_remainder, text_session, texts
from sheafmill.llm.folds import fit_linear, labelled_sample, logistic

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.5
#: Labelled documents of each class that the classifier is fitted on, at most.
SAMPLE = 5000
FEATURES = 1 << 20
#: A feature counts if it is in so many toxic documents of the sample, and so many times as common among them as among the others.
LEAST_DOCUMENTS = 3
LEAST_RATIO = 4
L2 = 1e-5
#: Characters whose trigrams are counted at once.
COUNTED = 1 << 20
#: Tokens and words remembered by a worker.
REMEMBERED = 300_000
#: A feature counts at most so often in a document, in the fit and in scores.
MOST = 3

#: Characters and the letters they imitate (fixed values).
IMITATES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
SEPARATORS = set(" .-_*~'`,:;/\\#^\"\t\n")
ACCENTED = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿßæœ"
#: Log costs of the channel (fixed values): imitation, separator left out, repetition left out, sign or digit kept.
IMITATE, SEPARATE, REPEAT, KEEP = -1.0, -0.5, -0.5, -2.0

CLASSES = 64
_DIGIT, _SIGN, _SEPARATOR, _OTHER = 57, 58, 59, 60
#: Single characters apart, between white space or marks.
_RUN = re.compile(r"(?<![\w@$])[\w@$!|](?:\s+[\w@$!|]){2,}(?![\w@$])")
_TRIPLE = re.compile(r"(.)\1\1", re.DOTALL)
_EDGES = "".join(sorted(SEPARATORS | set("!?()[]{}<>&%=+«»„“”‘’…¡¿|@$*")))


def char_class(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    if (k := ACCENTED.find(c)) >= 0:
        return 27 + k
    if c.isspace():
        return 0
    if c.isdigit():
        return _DIGIT
    if c.isalpha():
        return _OTHER
    return _SEPARATOR if c in SEPARATORS else _SIGN


_TABLE: np.ndarray | None = None


def classes_of(text: str) -> np.ndarray:
    """The class of each character of the lower-cased text."""
    global _TABLE
    if _TABLE is None:
        _TABLE = np.array([char_class(chr(i)) if not 0xD800 <= i < 0xE000 else _OTHER for i in range(1 << 16)], dtype=np.uint8)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(codes < 1 << 16, _TABLE[np.minimum(codes, (1 << 16) - 1)], _OTHER)


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(CLASSES**3, dtype=np.int64)
    for batch in batches:
        for text in texts(batch):
            padded = f" {text} ".lower()
            for start in range(0, len(padded) - 2, COUNTED):  # blocks share two characters, so each trigram counts once
                c = classes_of(padded[start : start + COUNTED + 2]).astype(np.int32)
                counts += np.bincount((c[:-2] << 12) | (c[1:-1] << 6) | c[2:], minlength=CLASSES**3)
    have = np.flatnonzero(counts)
    if len(have):
        yield pa.RecordBatch.from_arrays([pa.array(have.astype(np.int32)), pa.array(counts[have])], names=["trigram", "n"])


def char_model(docs: DataFrame) -> np.ndarray:
    """log P(c | a, b) as [a, b, c], from the trigrams of all texts; at most 64**3 counts come to the driver."""
    text_session(docs.sparkSession)
    rows = docs.select("text").mapInArrow(_count_trigrams, "trigram int, n bigint").groupBy("trigram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(CLASSES**3)
    counts[rows["trigram"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.float64)
    return smoothed(counts.reshape(CLASSES, CLASSES, CLASSES))


def smoothed(three: np.ndarray) -> np.ndarray:
    two = three.sum(axis=0)
    one = two.sum(axis=0)
    p1 = (one + 1) / (one.sum() + CLASSES)
    p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
    p3 = (three + 5 * p2) / (three.sum(axis=2, keepdims=True) + 5)
    return np.log(p3).astype(np.float32)


class Restorer(dict):
    """token -> restored word; remembers a bounded number."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()

    def __missing__(self, token: str) -> str:
        if len(self) >= REMEMBERED:
            self.clear()
        self[token] = found = self.restore(token)
        return found

    def restore(self, token: str) -> str:
        core = token.strip(_EDGES)
        if core.isalpha() and not _TRIPLE.search(core):
            return core
        whole = core if core.isalpha() else token.strip("".join(SEPARATORS) + "?&%")
        return self.decode(whole) if any(c.isalpha() for c in whole) else core

    def decode(self, text: str) -> str:
        """The most probable word behind the characters."""
        log = self.model
        # score, last letter and a back link (previous link, letter) for each pair of last classes
        links: dict[tuple[int, int], tuple[float, str, tuple | None]] = {(0, 0): (0.0, "", None)}
        for c in text:
            options = [(c, 0.0 if c.isalpha() else KEEP)] if not c.isspace() else []
            options += [(x, IMITATE) for x in IMITATES.get(c, "")]
            drop = SEPARATE if c in SEPARATORS else None
            coded = [(x, char_class(x), cost) for x, cost in options]
            after: dict[tuple[int, int], tuple[float, str, tuple | None]] = {}
            for (a, b), (score, last, link) in links.items():
                if drop is not None:
                    old = after.get((a, b))
                    if old is None or score + drop > old[0]:
                        after[a, b] = (score + drop, last, link)
                for x, k, cost in coded:
                    if x == last and b == k:
                        old = after.get((a, b))
                        if old is None or score + REPEAT + cost > old[0]:
                            after[a, b] = (score + REPEAT + cost, last, link)
                    new = score + cost + log[a][b][k]
                    old = after.get((b, k))
                    if old is None or new > old[0]:
                        after[b, k] = (new, x, (link, x))
            links = after
        _, (_, _, link) = max(links.items(), key=lambda x: x[1][0] + log[x[0][0]][x[0][1]][0])
        out = []
        while link is not None:
            link, x = link
            out.append(x)
        return "".join(reversed(out))

    def words(self, text: str) -> set[str]:
        """The distinct restored words of a text."""
        text = text.lower()
        found = set(map(self.__getitem__, set(text.split())))
        found |= {self[m[0]] for m in _RUN.finditer(text)}
        found.discard("")
        return found


def features(word: str) -> list[int]:
    return [crc32(f"{k}:{word[:k]}".encode("utf-8", "surrogatepass")) % FEATURES for k in (3, 4, 5, 6, 7) if len(word) > k] + [crc32(f"w:{word}".encode("utf-8", "surrogatepass")) % FEATURES]


def _featured(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model.value)
        for batch in batches:
            found = [np.unique(np.array([f for w in restorer.words(t) for f in features(w)], dtype=np.int32), return_counts=True) for t in texts(batch)]
            counts = [np.minimum(n, MOST).astype(np.int32) for _, n in found]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("label")), pa.array([x for x, _ in found], pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))], names=["label", "features", "counts"])

    return run


def _documents_of_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, label, n): in how many documents each feature is."""
    n = np.zeros((2, FEATURES), dtype=np.int64)
    for batch in batches:
        lists = batch.column(1)
        label = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy()))
        np.add.at(n, (label, lists.flatten().to_numpy(zero_copy_only=False)), 1)
    for k in (0, 1):
        have = np.flatnonzero(n[k])
        yield pa.RecordBatch.from_arrays([pa.array(have.astype(np.int32)), pa.array(np.full(len(have), k, dtype=np.int32)), pa.array(n[k][have])], names=["feature", "label", "n"])


def _selected(used):
    """The documents with the features in use only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, counts = batch.column(1), batch.column(2)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            stay = used.value[flat]
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))[stay]
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=batch.num_rows))]).astype(np.int32))
            parts = [pa.ListArray.from_arrays(offsets, pa.array(x[stay])) for x in (flat, counts.flatten().to_numpy(zero_copy_only=False))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *parts], names=["label", "features", "counts"])

    return run


def fit(docs: DataFrame, labels: DataFrame, model) -> tuple[np.ndarray, float]:
    """Feature weights (float32) and intercept. labels: (doc_id, label)."""
    sample, counts = labelled_sample(docs, labels, fold_remainder("doc_id", FOLDS) != HELD_OUT, SAMPLE)
    base = np.zeros(FEATURES, dtype=np.float32)
    zeros, ones = counts.get(0, 0), counts.get(1, 0)
    if not zeros or not ones:
        share = (ones + 0.5) / (zeros + ones + 1) if zeros + ones else 0.5
        return base, float(np.log(share / (1 - share)))
    spark = docs.sparkSession
    schema = "label int, features array<int>, counts array<int>"
    with Scratch(spark) as scratch:
        found = scratch.keep(sample.mapInArrow(_featured(model), schema), "toxicity-features")
        size = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}  # a row for each label
        n = found.mapInArrow(_documents_of_features, "feature int, label int, n bigint").groupBy("feature").agg(*(F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)).alias(c) for k, c in ((1, "toxic"), (0, "clean"))))
        ratio = (F.col("toxic") + 0.5) / (size.get(1, 0) + 1) / ((F.col("clean") + 0.5) / (size.get(0, 0) + 1))
        chosen = n.filter((F.col("toxic") >= LEAST_DOCUMENTS) & (ratio >= LEAST_RATIO)).select("feature").toPandas()["feature"].to_numpy(dtype=np.int64)  # at most FEATURES
        used = np.zeros(FEATURES, dtype=bool)
        used[chosen] = True
        rows = found.mapInArrow(_selected(spark.sparkContext.broadcast(used)), schema).toArrow()
    y = rows["label"].to_numpy().astype(np.float64)
    lists, counts = (rows[c].combine_chunks() for c in ("features", "counts"))
    row = np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy()))
    column, value = lists.flatten().to_numpy(zero_copy_only=False), counts.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    used, column = np.unique(column, return_inverse=True)
    w, b = fit_linear(row, column, value, y, len(used), L2)
    base[used] = w
    return base, b + float(np.log(ones / zeros))


def _scored(model, weights, intercept: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, own = Restorer(model.value), weights.value

        class Weighted(dict):
            """The features of a word that have a weight."""

            def __missing__(self, word):
                if len(self) >= REMEMBERED:
                    self.clear()
                found = np.asarray(features(word), dtype=np.int64)
                self[word] = found = found[own[found] != 0]
                return found

        weighted = Weighted()

        def total(text: str) -> float:
            """The weights of a text's features, each as often as it is there, MOST times at most: as in the fit."""
            found = [f for f in map(weighted.__getitem__, restorer.words(text)) if len(f)]
            some, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, dtype=np.int64), 0)
            return float((own[some] * np.minimum(n, MOST)).sum())

        for batch in batches:
            scores = logistic(np.array([intercept + total(t) for t in texts(batch)], dtype=np.float64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row. labels: (doc_id, label)."""
    context = docs.sparkSession.sparkContext
    model = context.broadcast(char_model(docs))  # 1 MB
    w, b = fit(docs, labels, model)
    weights = context.broadcast(w)  # 4 MB
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(_scored(model, weights, b), f"doc_id {kind}, score double")
    return scored.select("doc_id", (fold_remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    return toxicity(documents(spark, sf_dir), labels)
