"""Language-model scores: an interpolated modified Kneser-Ney bigram model, counted in Spark, read through memory maps.

A-Z are lower-cased; the tokens of a text are its words at ASCII white space and one end. The model is

    p(w | h) = max(c(hw) - D(c(hw)), 0) / c(h) + gamma(h) * p(w)
    p(w)     = max(a(w) - D'(a(w)), 0) / A + gamma' / (V + 1)

c are counts, a(w) is the number of distinct tokens before w, A their sum, V the number of distinct tokens, and D, D' are
the three discounts of each order, from its counts of counts. What the discounts take away is what the gammas give, so each distribution
sums to 1 over the V tokens and one unknown token. A text starts after a begin mark, which is no token.

Building: (1) tokens are counted and their 64-bit hashes sorted into arrays, cut in ranges of the hash; a token's id is its place. (2) pairs of
ids (one integer each) are counted and sorted into arrays, cut by the hash of the first id; the pairs of a first id that holds a large share of the tokens are
cut by both ids, so no shard grows with one token. (3) what the pairs say of each id (different tokens before it; pairs after it that were seen once,
twice, more often) is added up into dense arrays over ranges of ids. Each step combines within a task before it
shuffles, and shuffles sorted blocks, whose differences compress well. The number of shards follows the number of input
partitions, so a shard's size does not grow with the input. Nothing is pruned, capped or sampled.

The arrays are files in the shared folder; workers map them into memory and look tokens and pairs up by binary search, so the
model takes page cache, not worker memory. Where the shared folder is no mounted file system, a worker maps a local copy that has
no name any more and goes when it is closed. A lost task writes its file again under another name; only files of tasks that
succeeded are listed.

Defined cases: null is the empty text, which is one end token; texts are scored one by one, so ties and repeated rows do not
matter (repeated training rows count as often as they are there); a null doc_id is not held out; without training rows every
score and base score is 0; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import tempfile
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as fs
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill.llm.common import documents, fold_remainder, keep, shared_path, text_session, texts
from sheafmill.llm.files import write_arrays

FOLDS, HELD_OUT = 7, 2
#: The end token's hash stands for no word: words are not empty, and this is the hash of nothing.
END_HASH = xxhash.xxh64_intdigest(b"")
LEAST_SHARDS = 8
#: Distinct tokens, or tokens, that a task gathers before it passes them on.
DISTINCT_TOKENS = 400_000
GATHERED_TOKENS = 6_000_000
#: Word ids remembered by a worker.
REMEMBERED = 400_000
#: Tokens of one text looked up at once.
BLOCK = 1 << 20


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def hash_of(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


# Blocks: sorted keys as differences and their counts, each as planes of bytes, most of which are zero.


def pack(keys: np.ndarray, *values: np.ndarray) -> bytes:
    gaps = np.diff(keys, prepend=keys[:1] * 0).astype("<u8") if len(keys) else keys.astype("<u8")
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8).T).tobytes() for a in (gaps, *(v.astype("<u8") for v in values))]
    return b"".join(planes)


def unpack(block: bytes, columns: int) -> list[np.ndarray]:
    octets = np.frombuffer(block, dtype=np.uint8).reshape(columns, 8, -1)
    out = [np.ascontiguousarray(x.T).view("<u8").ravel() for x in octets]
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def merged(blocks: list[bytes], columns: int) -> list[np.ndarray]:
    """Blocks with equal keys added up."""
    parts = [unpack(b, columns) for b in blocks]
    keys = np.concatenate([p[0] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return [keys[first], *(np.add.reduceat(np.concatenate([p[i] for p in parts])[order], first) for i in range(1, columns))]


# Files in the shared folder.


@lru_cache(maxsize=4096)
def mapped(uri: str) -> np.ndarray:
    """A file's bytes, memory-mapped."""
    store, path = fs.FileSystem.from_uri(uri)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype=np.uint8, mode="r")
    with tempfile.NamedTemporaryFile() as copy:  # the name goes, the mapping stays
        with store.open_input_stream(path) as source:
            while part := source.read(1 << 24):
                copy.write(part)
        copy.flush()
        return np.memmap(copy.name, dtype=np.uint8, mode="r")


def array_of(uri: str, kind: str, offset: int, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, dtype=kind)
    return mapped(uri)[offset : offset + n * np.dtype(kind).itemsize].view(kind)


def hash_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Ranges of the hash, in order."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def id_range(ids: np.ndarray, n: int, ranges: int) -> np.ndarray:
    return (ids.astype(np.uint64) * np.uint64(ranges) // np.uint64(max(1, n))).astype(np.int64)


def range_start(r: int, n: int, ranges: int) -> int:
    return -(-r * n // ranges)


def _mixed(ids: np.ndarray) -> np.ndarray:
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    return h * np.uint64(0xD6E8FEB86659FD93)


class Vocabulary:
    """Token ids: places in the sorted hashes."""

    def __init__(self, shards: list[tuple[str, int]]):
        """shards: (file, tokens), in order; a file holds the hashes and the counts."""
        self.hashes = [array_of(uri, "<u8", 0, n) for uri, n in shards]
        self.counts = [array_of(uri, "<u8", 8 * n, n) for uri, n in shards]
        self.first = np.concatenate([[0], np.cumsum([n for _, n in shards])]).astype(np.int64)
        self.size = int(self.first[-1])
        self.known: dict[bytes, int] = {}

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Ids, or -1."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        if not len(self.hashes):
            return out
        shard = hash_shard(hashes, len(self.hashes))
        order = np.argsort(hashes, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(len(self.hashes) + 1))
        for s in np.flatnonzero(np.diff(cut)):
            part = order[cut[s] : cut[s + 1]]
            own = self.hashes[s]
            if len(own):
                at = np.minimum(np.searchsorted(own, hashes[part]), len(own) - 1)
                out[part] = np.where(own[at] == hashes[part], at + self.first[s], -1)
        return out

    def learn(self, words: set[bytes]) -> None:
        fresh = words.difference(self.known)
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known, fresh = {}, words
        if fresh:
            each = list(fresh)
            hashes = np.fromiter(map(hash_of, each), dtype=np.uint64, count=len(each))
            self.known.update(zip(each, self.lookup(hashes).tolist()))

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Ids of words that were learned."""
        return np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))

    def count_of(self, ids: np.ndarray) -> np.ndarray:
        """Counts of ids; 0 for -1."""
        out = np.zeros(len(ids), dtype=np.int64)
        shard = np.searchsorted(self.first, ids, side="right") - 1
        for s in np.unique(shard[ids >= 0]):
            have = (shard == s) & (ids >= 0)
            out[have] = self.counts[s][ids[have] - self.first[s]]
        return out

    @property
    def end(self) -> int:
        return int(self.lookup(np.array([END_HASH], dtype=np.uint64))[0])


def _sent(shard: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """A packed block for each shard; keys ascend."""
    order = np.argsort(shard, kind="stable")
    shards, first = np.unique(shard[order], return_index=True)
    blocks = [pack(keys[part], counts[part]) for part in np.split(order, first[1:])]
    return pa.RecordBatch.from_arrays([pa.array(shards.astype(np.int32)), pa.array(blocks, pa.binary())], names=["shard", "block"])


def _count_tokens(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, ends = Counter(), 0

        def block():
            keys = np.fromiter(map(hash_of, counts), dtype=np.uint64, count=len(counts))
            n = np.fromiter(counts.values(), dtype=np.uint64, count=len(counts))
            keys, n = np.append(keys, np.uint64(END_HASH)), np.append(n, np.uint64(ends))
            order = np.argsort(keys, kind="stable")
            return _sent(hash_shard(keys[order], shards), keys[order], n[order])

        for batch in batches:
            for text in texts(batch):
                counts.update(words_of(text))
                ends += 1
                if len(counts) > DISTINCT_TOKENS:
                    yield block()
                    counts, ends = Counter(), 0
        if ends:
            yield block()

    return run


def _write_tokens(root: str):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        hashes, counts = merged(rows["block"].tolist(), 2)
        uri = write_arrays(root, [hashes, counts])
        return pd.DataFrame([(key[0], uri, len(hashes), int(counts.sum()))], columns=["shard", "uri", "n", "total"])

    return run


def pair_shard(pairs: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each pair: by the first id, or by both if the first is hot."""
    first = pairs >> np.uint64(32)
    return hash_shard(_mixed(np.where(np.isin(first, hot), pairs, first)), shards)


def _count_pairs(vocabulary: list, hot: np.ndarray, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Vocabulary(vocabulary)
        begin, end = own.size, own.end
        gathered, n = [], 0

        def block():
            pairs, counts = np.unique(np.concatenate(gathered), return_counts=True)
            return _sent(pair_shard(pairs, hot, shards), pairs, counts.astype(np.uint64))

        for batch in batches:
            for text in texts(batch):
                words, last = words_of(text), begin
                for start in range(0, len(words) + 1, BLOCK):
                    part = words[start : start + BLOCK]
                    own.learn(set(part))
                    ids = own.ids(part)
                    if start + BLOCK > len(words):
                        ids = np.append(ids, end)
                    before = np.concatenate([[last], ids[:-1]]).astype(np.uint64)
                    gathered.append(before << np.uint64(32) | ids.astype(np.uint64))
                    last = ids[-1]
                    n += len(ids)
                    if n > GATHERED_TOKENS:
                        yield block()
                        gathered, n = [], 0
        if n:
            yield block()

    return run


SHARD_SCHEMA = "kind string, part int, block binary, uri string, n bigint, n1 bigint, n2 bigint, n3 bigint, n4 bigint"
_SHARD_COLUMNS = ["kind", "part", "block", "uri", "n", "n1", "n2", "n3", "n4"]


def _of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def _write_pairs(root: str, size: int, ranges: int):
    """The arrays of a shard of pairs, and what they say of the ids by range: rows `after` and `before`."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        pairs, counts = merged(rows["block"].tolist(), 2)
        uri = write_arrays(root, [pairs, counts.astype("<u4" if not len(counts) or counts.max() < 1 << 32 else "<u8")])
        out = [("pairs", int(key[0]), None, uri, len(pairs), *_of_counts(counts))]
        ids, different = np.unique(pairs & np.uint64(0xFFFFFFFF), return_counts=True)
        part = id_range(ids, size + 1, ranges)
        for r in np.unique(part):
            have = part == r
            out.append(("before", int(r), pack(ids[have], different[have]), None, 0, 0, 0, 0, 0))
        first = pairs >> np.uint64(32)
        ids, at = np.unique(first, return_index=True)
        once, twice, more = (np.add.reduceat(x.astype(np.uint64), at) for x in (counts == 1, counts == 2, counts > 2))
        part = id_range(ids, size + 1, ranges)
        for r in np.unique(part):
            have = part == r
            out.append(("after", int(r), pack(ids[have], once[have], twice[have], more[have]), None, 0, 0, 0, 0, 0))
        return pd.DataFrame(out, columns=_SHARD_COLUMNS)

    return run


def _write_ids(root: str, size: int, ranges: int):
    """Dense arrays over a range of ids: different tokens before; pairs after seen once, twice, more often."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        r = int(key[0])
        start, stop = range_start(r, size + 1, ranges), range_start(r + 1, size + 1, ranges)
        dense = np.zeros((4, stop - start), dtype="<u4")
        for kind, columns, to in (("before", 2, dense[:1]), ("after", 4, dense[1:])):
            blocks = rows.loc[rows["kind"] == kind, "block"].tolist()
            if blocks:
                ids, *values = merged(blocks, columns)
                for row, v in zip(to, values):
                    row[ids.astype(np.int64) - start] = v
        uri = write_arrays(root, [dense])
        return pd.DataFrame([("ids", r, None, uri, stop - start, *_of_counts(dense[0]))], columns=_SHARD_COLUMNS)

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts; where the counts of counts give none, 0.5, 1 and 1.5."""
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(d if 0 < d < k else o for d, k, o in zip(found, (1, 2, 3), (0.5, 1.0, 1.5)))


class Model:
    """What is known of a fitted model; a few numbers and the names of its files."""

    def __init__(self, vocabulary, pairs, ids, hot, size, tokens, texts_, d_pairs, d_tokens, kinds, before_of):
        self.vocabulary, self.pairs, self.ids, self.hot = vocabulary, pairs, ids, hot
        self.size, self.tokens, self.texts = size, tokens, texts_
        self.d_pairs, self.d_tokens, self.kinds, self.before_of = d_pairs, d_tokens, kinds, before_of


def fit(docs: DataFrame) -> Model:
    """The model of all rows of docs."""
    spark = docs.sparkSession
    text_session(spark)
    docs = docs.select("text")
    shards = max(LEAST_SHARDS, docs.rdd.getNumPartitions())
    root = shared_path(spark, "language-model")
    counted = docs.mapInArrow(_count_tokens(shards), "shard int, block binary")
    rows = counted.groupBy("shard").applyInPandas(_write_tokens(root), "shard int, uri string, n bigint, total bigint").collect()  # a row for each shard
    found = {r["shard"]: r for r in rows}
    vocabulary = [(found[s]["uri"], found[s]["n"]) if s in found else ("", 0) for s in range(shards)]
    size, tokens = sum(r["n"] for r in rows), sum(r["total"] for r in rows)
    if not size:
        return Model([], [], [], np.empty(0, np.uint64), 0, 0, 0, (0.5, 1.0, 1.5), (0.5, 1.0, 1.5), 0, (0, 0, 0))
    if size >= 1 << 32:
        raise ValueError("over 2**32 distinct tokens: pairs of ids do not fit one integer")
    hot = hot_ids(spark, vocabulary, tokens, shards)
    counted = docs.mapInArrow(_count_pairs(vocabulary, hot, shards), "shard int, block binary")
    said = keep(counted.groupBy("shard").applyInPandas(_write_pairs(root, size, shards), SHARD_SCHEMA), "pairs")
    pairs = said.filter("kind = 'pairs'").drop("block").collect()  # a row for each shard
    ids = said.filter("kind <> 'pairs'").groupBy("part").applyInPandas(_write_ids(root, size, shards), SHARD_SCHEMA).collect()  # a row for each range
    of_pairs = {r["part"]: (r["uri"], r["n"]) for r in pairs}
    of_ids = {r["part"]: (r["uri"], r["n"]) for r in ids}
    total = lambda rows, k: sum(r[k] for r in rows)
    n_pairs, kinds = total(pairs, "n"), [total(ids, k) for k in ("n1", "n2", "n3", "n4")]
    return Model(
        vocabulary, [of_pairs.get(s, ("", 0)) for s in range(shards)], [of_ids.get(r, ("", 0)) for r in range(shards)], hot, size, tokens, None,
        discounts(*(total(pairs, k) for k in ("n1", "n2", "n3", "n4"))), discounts(*kinds), n_pairs, (kinds[0], kinds[1], size - kinds[0] - kinds[1]),
    )


def hot_ids(spark, vocabulary, tokens: int, shards: int) -> np.ndarray:
    """Ids that hold over a quarter of an even shard's tokens, at most 4 * shards of them; the begin mark counts as one."""
    least = max(1, tokens // (4 * shards))
    first = np.concatenate([[0], np.cumsum([n for _, n in vocabulary])])

    def run(batches):
        for batch in batches:
            for uri, n, start in zip(*(batch.column(i).to_pylist() for i in range(3))):
                at = np.flatnonzero(array_of(uri, "<u8", 8 * n, n) > least)
                yield pa.RecordBatch.from_arrays([pa.array(at + start)], names=["id"])

    files = spark.createDataFrame([(uri, n, int(s)) for (uri, n), s in zip(vocabulary, first) if n], "uri string, n bigint, start bigint")
    found = [r["id"] for r in files.repartition(min(len(vocabulary), 64)).mapInArrow(run, "id bigint").collect()]
    return np.array(sorted([*found, int(first[-1])]), dtype=np.uint64)


class Scorer:
    """Scores texts with the mapped files of a model."""

    def __init__(self, model: Model):
        self.model = model
        self.vocabulary = Vocabulary(model.vocabulary)
        self.pairs = [(array_of(uri, "<u8", 0, n), array_of(uri, "<u4" if not n or mapped(uri).size == 12 * n else "<u8", 8 * n, n)) for uri, n in model.pairs]
        self.dense = [array_of(uri, "<u4", 0, 4 * n).reshape(4, n) for uri, n in model.ids]
        self.begin, self.end = model.size, self.vocabulary.end if model.size else -1
        self.begin_count = int(self.vocabulary.count_of(np.array([self.end]))[0]) if model.size else 0
        d = model.d_tokens
        self.rest = sum(x * n for x, n in zip(d, model.before_of)) / model.kinds if model.kinds else 1.0

    def _about(self, ids: np.ndarray) -> np.ndarray:
        """The four dense values of each id; zeros for -1."""
        out = np.zeros((4, len(ids)), dtype=np.int64)
        n, ranges = self.model.size + 1, len(self.dense)
        part = np.where(ids >= 0, id_range(np.maximum(ids, 0), n, ranges), -1)
        for r in np.unique(part[part >= 0]):
            have = part == r
            out[:, have] = self.dense[r][:, ids[have] - range_start(int(r), n, ranges)]
        return out

    def _pair_counts(self, pairs: np.ndarray) -> np.ndarray:
        """pairs: distinct, ascending."""
        out = np.zeros(len(pairs), dtype=np.int64)
        shard = pair_shard(pairs, self.model.hot, len(self.pairs))
        order = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(len(self.pairs) + 1))
        for s in np.flatnonzero(np.diff(cut)):
            part = order[cut[s] : cut[s + 1]]
            keys, counts = self.pairs[s]
            if len(keys):
                at = np.minimum(np.searchsorted(keys, pairs[part]), len(keys) - 1)
                out[part] = np.where(keys[at] == pairs[part], counts[at], 0)
        return out

    def logs(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """log10 p(id | before); -1 is an unknown token."""
        model = self.model
        if not model.size:
            return np.zeros(len(ids))
        def taken(c, d):
            return np.where(c <= 0, 0.0, np.where(c == 1, d[0], np.where(c == 2, d[1], d[2])))

        tokens, back = np.unique(ids, return_inverse=True)
        a = self._about(tokens)[0]
        low = ((a - taken(a, model.d_tokens)) / model.kinds + self.rest / (model.size + 1))[back]
        contexts, back = np.unique(before, return_inverse=True)
        _, once, twice, more = self._about(contexts)
        total = np.where(contexts == self.begin, self.begin_count, self.vocabulary.count_of(np.where(contexts < self.begin, contexts, -1)))
        d = model.d_pairs
        gamma = np.where(total > 0, (d[0] * once + d[1] * twice + d[2] * more) / np.maximum(1, total), 1.0)[back]
        total = np.maximum(1, total)[back]
        both = (before >= 0) & (ids >= 0)
        pairs, again = np.unique(before[both].astype(np.uint64) << np.uint64(32) | ids[both].astype(np.uint64), return_inverse=True)
        c = np.zeros(len(ids), dtype=np.int64)
        c[both] = self._pair_counts(pairs)[again]
        return np.log10((c - taken(c, d)) / total + gamma * low)

    def score(self, every: list[str]) -> list[tuple[int, int, float, float]]:
        """(n_tokens, n_known, base_score, score) of each text."""
        out, waiting, size = [], [], 0
        for text in every:
            words = words_of(text)
            if len(words) > BLOCK:
                out += self._together(waiting)
                waiting, size = [], 0
                out.append(self._long(words))
                continue
            if size + len(words) > BLOCK:
                out += self._together(waiting)
                waiting, size = [], 0
            waiting.append(words)
            size += len(words) + 1
        return out + self._together(waiting)

    def _together(self, waiting: list[list[bytes]]) -> list[tuple[int, int, float, float]]:
        if not waiting:
            return []
        self.vocabulary.learn(set().union(*waiting))
        parts, lengths = [], np.array([len(w) + 1 for w in waiting])
        for words in waiting:
            parts += [self.vocabulary.ids(words), [self.end]]
        ids = np.concatenate(parts).astype(np.int64)
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        before = np.concatenate([[0], ids[:-1]])
        before[first] = self.begin
        known, base, log = self._each(before, ids)
        sums = [np.add.reduceat(x, first).tolist() for x in (known, base, log)]
        return list(zip(lengths.tolist(), *sums))

    def _long(self, words: list[bytes]) -> tuple[int, int, float, float]:
        known, base, log, last = 0, 0.0, 0.0, self.begin
        for start in range(0, len(words) + 1, BLOCK):
            part = words[start : start + BLOCK]
            self.vocabulary.learn(set(part))
            ids = self.vocabulary.ids(part)
            if start + BLOCK > len(words):
                ids = np.append(ids, self.end)
            k, b, s = self._each(np.concatenate([[last], ids[:-1]]).astype(np.int64), ids)
            known, base, log, last = known + int(k.sum()), base + float(b.sum()), log + float(s.sum()), ids[-1]
        return len(words) + 1, known, base, log

    def _each(self, before, ids):
        tokens, back = np.unique(ids, return_inverse=True)
        c = self.vocabulary.count_of(tokens)
        base = np.log10((c + 1) / (self.model.tokens + self.model.size + 1))[back]
        return (c > 0)[back].astype(np.int64), base, self.logs(before, ids)


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for batch in batches:
            columns = list(zip(*scorer.score(list(texts(batch))))) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.float64())))], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return run


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    text_session(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)  # file names and at most 4 * shards hot ids
    found = docs.select("doc_id", "text").mapInArrow(_scored(sent), f"doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double")
    return found.withColumn("train_tokens", F.lit(model.tokens).cast("long"))


def op3_kneser_ney(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs.filter(fold_remainder("doc_id", FOLDS) != HELD_OUT))
    held_out = (fold_remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out")
    return scores(docs, model).select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")
