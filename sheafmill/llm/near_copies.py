"""Near copies for the pipeline: documents whose five-word shingle sets have a Jaccard similarity of at least 0.8.

The search is operator 7's first: SimHash fingerprints (of these shingles), the byte-position inverted index, its count filter and the verification of bits (`simhash.links`); an exact check
of the similarity follows. Pairs that similar lie up to some 20 of 64 fingerprint bits apart, more than the positional bytes of a fingerprint can
guarantee matches for, so an exact filter on the shingles themselves finds what fingerprints leave in different groups; components and the choice of rows are those of `simhash`.

A text is lower-cased (A-Z) and cut into words at ASCII white space, as for the fingerprints of op7; a text with fewer than five words has its
whole word sequence as one shingle. Two documents are linked if 0.8 or more of their joint distinct shingles are in both; a group is what links reach.

Search for the rest: prefix filter. With the shingles of every set in one order, two sets that similar have a shingle in common among the first
n - ceil(0.8 n) + 1 of each, n being the set's size. So only these are posted, and every pair within a posting list whose sizes allow 0.8 is a
candidate: no pair is lost. Any order is right; shingles that are common in all texts come last, so that posting lists are short.

Every set has a sketch, a power of two of bits (two or more for each shingle), each the parity of the shingles that fall on it; folding its halves together gives the sketch of half as
many bits. Two sketches of one length differ in at most as many bits as their sets have shingles that
are in one of them only, and sets of a and b shingles that similar have at most (a + b) / 9 of these: candidates whose sketches differ more are dropped, no similar pair is.
What is left is verified on the words.

A list of more than SHORT members first pairs its members with its smallest one only. What these links leave in different
groups is compared within tasks, two pieces of a list of at most PIECE members at a time; a pair that passes the sketches is told by one of its lists only. Of these pairs each member's
nearest is verified first, then those that are still in different groups. So a large group of near copies does not give the square of its size.

Defined cases: texts with the same shingle set (64-bit hash of its shingle hashes) are one node; blank and null texts are near copies of each other;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill.llm.common import Scratch, text_session, texts, tidy
from sheafmill.llm.decontaminate import REMEMBERED, needed, shingle_hashes
from sheafmill.llm import simhash
from sheafmill.llm.simhash import components, one_of_each

WIDTH = 5
#: Shingle hashes among which a task looks for repeated ones, the least count of a common one, and how many are taken at most.
COUNTED = 1_000_000
COMMON_COUNT = 3
COMMON = 200_000
#: Members of a posting list that are all paired at once.
SHORT = 8
#: Members of a posting list that one row holds.
PIECE = 512
#: Bits of the smallest sketches.
SKETCH_BITS = 256
#: Bits of the filter over the texts that candidates need.
FILTER_BITS = 1 << 24


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


_hash_of = _Hashes()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(text: str | None) -> set[tuple[bytes, ...]]:
    words = words_of(text)
    return set(zip(*(words[j:] for j in range(WIDTH)))) if len(words) >= WIDTH else {tuple(words)}


def hashes(text: str | None) -> np.ndarray:
    """The distinct shingle hashes of a text in order."""
    words = words_of(text)
    if len(words) < WIDTH:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), len(words))], dtype=np.uint64)
    return np.unique(shingle_hashes(words, WIDTH, _hash_of))


def similar(a: set, b: set) -> bool:
    """Whether the Jaccard similarity is at least 0.8."""
    shared = len(a & b)
    return 5 * shared >= 4 * (len(a) + len(b) - shared)


def prefix(own: np.ndarray, common: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The first n - ceil(0.8 n) + 1 of a set: by hash, the common ones (sorted, with their places) after the others."""
    k = len(own) - needed(len(own)) + 1
    if not len(common):
        return own[:k]
    at = np.searchsorted(common, own)
    at[at == len(common)] = 0
    known = common[at] == own
    rare = own[~known][:k]
    if len(rare) == k:
        return rare
    late = at[known]
    return np.concatenate([rare, common[late[np.argsort(place[late])][: k - len(rare)]]])


@tidy
def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shingle, n) of the shingles that are repeated among some millions; a block's other shingles are rare or known from other blocks."""

    def counted(held):
        found, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found[n > 1].view(np.int64)), pa.array(n[n > 1])], names=["shingle", "n"])

    held, size = [], 0
    for batch in batches:
        for text in texts(batch):
            held.append(hashes(text))
            size += len(held[-1])
            if size > COUNTED:
                yield counted(held)
                held, size = [], 0
    if held:
        yield counted(held)
    _hash_of.clear()


def common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the most common shingles of all texts (at most COMMON), and the place of each, rarer ones first."""
    counts = docs.select("text").mapInArrow(_repeated, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n")).filter(f"n >= {COMMON_COUNT}")
    rows = counts.orderBy(F.desc("n"), "shingle").limit(COMMON).toPandas()
    common = rows["shingle"].to_numpy(dtype=np.int64).view(np.uint64)
    by_hash = np.argsort(common)
    return common[by_hash], len(common) - 1 - by_hash


def sketch(own: np.ndarray) -> np.ndarray:
    """The parities of a set's shingles by the lowest bits of their hash, as 64-bit integers."""
    size = max(SKETCH_BITS, 1 << (2 * len(own) - 1).bit_length())
    bits = np.bincount((own & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view("<i8")


def fingerprint(own: np.ndarray) -> int:
    """The SimHash of a set's shingle hashes: a bit is 1 if it is set in over half of them."""
    return int(np.packbits(2 * np.unpackbits(own.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64) > len(own)).view(np.uint64)[0])


def _marker(shared):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, place = shared.value
        seen: set[int] = set()
        for batch in batches:
            node, size, bits, first, sketches, fresh = [], [], [], [], [], []
            for text in texts(batch):
                own = hashes(text)
                fp = xxhash.xxh64_intdigest(own.tobytes())
                node.append(fp)
                size.append(len(own))
                fresh.append(fp not in seen)
                bits.append(fingerprint(own) if fresh[-1] else 0)
                if fresh[-1]:
                    seen.add(fp)
                    first.append(prefix(own, common, place).view(np.int64))
                    sketches.append(sketch(own))
            fresh = np.array(fresh, dtype=bool)
            lists = []
            for values in (sketches, first):
                lengths = np.zeros(len(fresh), dtype=np.int64)
                lengths[fresh] = [len(x) for x in values]
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values) if values else np.empty(0, np.int64))))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text_hash")]
            fp, bits = (pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (node, bits))
            yield pa.RecordBatch.from_arrays([*columns, fp, pa.array(size, pa.int32()), bits, *lists], names=["doc_id", "text_hash", "fp", "n", "bits", "sketch", "prefix"])
        _hash_of.clear()

    return run


def marks(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp, n, bits, sketch, prefix) of every row; fp is the hash of the shingle set, n its size, bits its SimHash. Of rows of one set, a task gives bits,
    sketch and prefix of the first, so that a large group of copies is not posted row by row; those of the others are zero and empty."""
    text_session(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(common_shingles(docs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(_marker(shared), f"doc_id {kind}, text_hash bigint, fp bigint, n int, bits bigint, sketch array<bigint>, prefix array<bigint>")


LIST_SCHEMA = "list bigint, piece int, center bigint, center_n int, members array<bigint>, sizes array<int>"


@tidy
def _list_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (key, fp, n) in order of key and fp: the members of each key that has two or more, in pieces of at most PIECE, with the key's first member."""

    def rows(key, piece, center, center_n, sizes, fp, n):
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(c)) for c in (fp, n)]
        return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(piece, pa.int32()), pa.array(center, pa.int64()), pa.array(center_n, pa.int32()), *lists], names=["list", "piece", "center", "center_n", "members", "sizes"])

    def one(key, piece, center, center_n, fp, n):
        return rows([key], [piece], [center], [center_n], [len(fp)], fp, n)

    held: tuple | None = None  # members of the last key, which may go on
    out: tuple | None = None  # (key, pieces, center, its size) where pieces of that key are out already
    for batch in _and_none(batches):
        if batch is not None:
            if not batch.num_rows:
                continue
            part = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            key, fp, n = (np.concatenate([a, b]) for a, b in zip(held, part)) if held is not None else part
            last = int(np.searchsorted(key, key[-1])) if key[0] <= key[-1] else 0
        elif held is None:
            return
        else:
            key, fp, n = held
            last = len(key)
        twice = np.concatenate([[False], (key[1:] == key[:-1]) & (fp[1:] == fp[:-1])])
        if twice.any():
            last -= int(twice[:last].sum())
            key, fp, n = key[~twice], fp[~twice], n[~twice]
        starts = np.flatnonzero(np.concatenate([[True], key[1:last] != key[: last - 1]])) if last else np.empty(0, dtype=np.int64)
        sizes = np.diff(np.append(starts, last))
        single = (sizes > 1) & (sizes <= PIECE)
        if len(starts) and out is not None and key[0] == out[0]:
            single[0] = False
        if single.any():
            use = np.repeat(single, sizes)
            at = starts[single]
            yield rows(key[at], np.zeros(len(at)), fp[at], n[at], sizes[single], fp[:last][use], n[:last][use])
        for k in np.flatnonzero((sizes > PIECE) | (np.arange(len(sizes)) == 0)):
            a, b = int(starts[k]), int(starts[k] + sizes[k])
            known = out is not None and key[a] == out[0]
            if not known and sizes[k] <= PIECE:
                continue
            piece, center, center_n = out[1:] if known else (0, fp[a], n[a])
            for x in range(a, b, PIECE):
                yield one(key[a], piece, center, center_n, fp[x : min(b, x + PIECE)], n[x : min(b, x + PIECE)])
                piece += 1
        key, fp, n = key[last:], fp[last:], n[last:]
        if not len(key):
            return
        if out is None or key[0] != out[0]:
            out = None
        while len(key) > 2 * PIECE:  # the last member stays, so that a repetition of it is seen
            piece, center, center_n = out[1:] if out is not None else (0, fp[0], n[0])
            yield one(key[0], piece, center, center_n, fp[:PIECE], n[:PIECE])
            out = (key[0], piece + 1, center, center_n)
            key, fp, n = key[PIECE:], fp[PIECE:], n[PIECE:]
        held = (key, fp, n)


def _and_none(batches):
    yield from batches
    yield None


@tidy
def _pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (u, v), u < v, of a list's members whose sizes allow 0.8: all of a short list, those with the first member of a longer one."""
    for batch in batches:
        columns = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
        offsets = columns["members"].offsets.to_numpy()
        fp, n = (columns[c].values.to_numpy(zero_copy_only=False) for c in ("members", "sizes"))
        lengths, piece = np.diff(offsets), columns["piece"].to_numpy(zero_copy_only=False)
        center, center_n = columns["center"].to_numpy(zero_copy_only=False), columns["center_n"].to_numpy(zero_copy_only=False)
        pairs = []
        for length in range(2, SHORT + 1):
            at = offsets[:-1][(lengths == length) & (piece == 0)]
            pairs += [(at + i, at + j) for i, j in combinations(range(length), 2)] if len(at) else []
        a, b = (np.concatenate(x) for x in zip(*pairs)) if pairs else (np.empty(0, np.int64),) * 2
        u, v, m, o = fp[a], fp[b], n[a], n[b]
        long = (lengths > SHORT) | (piece > 0)
        if long.any():
            use = np.repeat(long, lengths)
            u, m = (np.concatenate([x, np.repeat(c[long], lengths[long])]) for x, c in ((u, center), (m, center_n)))
            v, o = np.concatenate([v, fp[offsets[0] : offsets[-1]][use]]), np.concatenate([o, n[offsets[0] : offsets[-1]][use]])
        stay = (5 * np.minimum(m, o).astype(np.int64) >= 4 * np.maximum(m, o).astype(np.int64)) & (u != v)
        both = np.unique(np.stack([u[stay], v[stay]]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["u", "v"])


@tidy
def _pairs_between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (list, piece a, piece b, members): pairs (u, v), u < v, of members of the two pieces that are in different groups, share no smaller list and pass sizes and sketches."""
    for batch in batches:
        for k in range(batch.num_rows):
            own, first, second = (batch.column(i)[k].as_py() for i in range(3))
            members = batch.column(3)[k].values
            piece, fp, n, root = (members.field(c).to_numpy(zero_copy_only=False) for c in ("piece", "node", "n", "root"))
            lists = members.field("lists")
            other = lists.values.to_numpy(zero_copy_only=False)[lists.offsets[0].as_py() : lists.offsets[-1].as_py()]
            owner = np.repeat(np.arange(len(fp)), np.diff(lists.offsets.to_numpy()))
            smaller = other < own
            kinds, column = np.unique(other[smaller], return_inverse=True)
            has = np.zeros((len(fp), len(kinds)), dtype=np.float32)
            has[owner[smaller], column] = 1
            flat = members.field("sketch")
            words, stops = flat.values.to_numpy(zero_copy_only=False), flat.offsets.to_numpy()
            long = np.diff(stops)  # of a sketch; those of similar pairs are alike or double
            for size in np.unique(long):
                alike, double = np.flatnonzero(long == size), np.flatnonzero(long == 2 * size)
                both = np.concatenate([alike, double])
                own_words = [words[stops[i] : stops[i] + size] for i in alike] + [words[stops[i] : stops[i] + size] ^ words[stops[i] + size : stops[i + 1]] for i in double]
                signs = np.unpackbits(np.stack(own_words).view(np.uint8), axis=1).astype(np.float32) * 2 - 1
                sides = [(alike, signs[: len(alike)], both, signs)] + [(double, signs[len(alike) :], alike, signs[: len(alike)])] * bool(len(double) and first != second)
                for left, left_signs, right, right_signs in sides:
                    p, q = np.flatnonzero(piece[left] == first), np.flatnonzero(piece[right] == second)
                    b, b_signs = right[q], right_signs[q]
                    for start in range(0, len(p), 512):
                        x, x_signs = left[p[start : start + 512]], left_signs[p[start : start + 512]]
                        m, o = n[x][:, None].astype(np.int64), n[b][None, :].astype(np.int64)
                        stay = (root[x][:, None] != root[b][None, :]) & (5 * np.minimum(m, o) >= 4 * np.maximum(m, o)) & (has[x] @ has[b].T == 0)
                        if first == second:  # each pair once, as one that is alike and one that is double is
                            stay &= (fp[x][:, None] < fp[b][None, :]) | (long[x][:, None] != long[b][None, :])
                        if stay.any():
                            stay &= 9 * (64 * size - x_signs @ b_signs.T) / 2 <= m + o
                            i, j = np.nonzero(stay)
                            u, v = fp[x[i]], fp[b[j]]
                            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])


@tidy
def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(i) for i in range(4)]
        stay = [similar(shingles(a.as_py()), shingles(b.as_py())) for a, b in zip(columns[2], columns[3])]
        yield pa.RecordBatch.from_arrays(columns[:2], names=["u", "v"]).filter(pa.array(stay, pa.bool_()))


def _text_filter(hashes_needed: DataFrame) -> np.ndarray:
    """One bit for each text hash modulo FILTER_BITS; the size does not depend on the input."""
    at = F.pmod(F.col("text_hash"), F.lit(FILTER_BITS)) + 1  # Spark's bitmaps count from 1
    rows = hashes_needed.select(at.alias("p")).groupBy(F.expr("bitmap_bucket_number(p)").alias("b")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("bits")).collect()
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
        bits[(r["b"] - 1) * len(part) : r["b"] * len(part)] = part
    return bits


def _filter_batches(shared):
    """The rows of texts that may be needed, each text once in a task."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = shared.value, set()
        for batch in batches:
            own = batch.column(batch.schema.get_field_index("text_hash")).to_numpy(zero_copy_only=False)
            p = own % FILTER_BITS
            stay = (bits[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)
            for i in np.flatnonzero(stay):
                stay[i] = own[i] not in seen
                seen.add(own[i])
            yield batch.filter(pa.array(stay))

    return run


def alike(pairs: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, v, d) of the pairs (u, v) whose sketches allow that they are similar, d being the bits that differ. nodes: (fp, n, sketch, text_hash)."""
    a, b = (nodes.select(F.col("fp").alias(c), F.col("n").alias(f"{c}_n"), F.col("sketch").alias(f"{c}_sketch")) for c in "uv")

    def xor(x, y):
        return F.zip_with(x, y, lambda p, q: p.bitwiseXOR(q))

    def folded(own, other):
        half = F.size(other)
        return F.when(F.size(own) > half, xor(F.slice(own, F.lit(1), half), F.slice(own, half + 1, half))).otherwise(F.col(own))

    differ = F.aggregate(xor(folded("u_sketch", "v_sketch"), folded("v_sketch", "u_sketch")), F.lit(0), lambda x, y: x + F.bit_count(y))
    return scratch.keep(pairs.join(a, "u").join(b, "v").withColumn("d", differ).filter("d * 9 <= u_n + v_n").select("u", "v", "d"), "candidates")


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs (u, v) that are similar by their words. nodes: (fp, text_hash), one text of each node."""
    spark = docs.sparkSession
    pairs = scratch.keep(pairs.select("u", "v"), "asked-pairs")
    needs = pairs.select(F.explode(F.array("u", "v")).alias("fp")).distinct()
    needs = scratch.keep(nodes.join(needs, "fp", "left_semi").select("fp", "text_hash"), "candidate-nodes")
    bits = spark.sparkContext.broadcast(_text_filter(needs))
    some = docs.select(F.xxhash64("text").alias("text_hash"), "text").mapInArrow(_filter_batches(bits), "text_hash bigint, text string")
    words = scratch.keep(some.join(needs, "text_hash").groupBy("text_hash").agg(F.first("fp").alias("fp"), F.first("text").alias("text")).select("fp", "text"), "candidate-texts")
    both = pairs.join(words.select(F.col("fp").alias("u"), F.col("text").alias("a")), "u").join(words.select(F.col("fp").alias("v"), F.col("text").alias("b")), "v")
    found = scratch.keep(both.select("u", "v", "a", "b").mapInArrow(_verify_batches, "u bigint, v bigint"), "verified")
    bits.unpersist()
    return found


def between(lists: DataFrame, group: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Candidate pairs (u, v) in different groups from the longer lists. group: (node, root)."""
    long = lists.filter((F.size("members") > SHORT) | (F.col("piece") > 0))
    last = long.groupBy("list").agg(F.max("piece").alias("last"), F.first(F.xxhash64("members")).alias("members_hash"), F.first(F.size("members")).alias("length"))
    alike = F.when(F.col("last") == 0, F.struct("members_hash", "length"))  # lists of the same members, as of neighbouring shingles, count once
    one = last.groupBy(alike.alias("alike"), F.when(F.col("last") > 0, F.col("list")).alias("own")).agg(F.min("list").alias("list"))
    long = long.join(one.select("list"), "list")
    rows = long.select("list", "piece", F.explode("members").alias("node")).join(group, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = scratch.keep(rows, "long-members")
    mixed = rows.groupBy("list").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.max("piece").alias("last")).filter("least <> most").select("list", "last")
    rows = rows.join(mixed, "list")
    about = rows.groupBy("node").agg(F.collect_list("list").alias("lists")).join(nodes.select(F.col("fp").alias("node"), "n", "sketch"), "node")
    rows = rows.join(about, "node")
    meets = F.transform(F.sequence(F.lit(0), F.col("last")), lambda q: F.struct(F.least(q, F.col("piece")).alias("a"), F.greatest(q, F.col("piece")).alias("b")))
    rows = rows.withColumn("at", F.explode(meets)).groupBy("list", "at.a", "at.b").agg(F.collect_list(F.struct("piece", "node", "n", "root", F.filter("lists", lambda x: x < F.col("list")).alias("lists"), "sketch")).alias("m"))
    return rows.select("list", "a", "b", "m").mapInArrow(_pairs_between, "u bigint, v bigint").distinct()


def fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (u, v), u < v, of nodes that connect what fingerprints link: of one fingerprint each node with the smallest, of two that simhash.links links their smallest. nodes: (fp, bits)."""
    least = nodes.groupBy("bits").agg(F.min("fp").alias("least"))
    same = nodes.join(least, "bits").select("fp", F.col("least").alias("other"))
    a, b = (least.select(F.col("bits").alias(c), F.col("least").alias(f"{c}_least")) for c in "uv")
    linked = simhash.links(least.select(F.col("bits").alias("fp"))).join(a, "u").join(b, "v").select(F.col("u_least").alias("fp"), F.col("v_least").alias("other"))
    return same.unionByName(linked).select(F.least("fp", "other").alias("u"), F.greatest("fp", "other").alias("v")).filter("u <> v").distinct()


def apart(pairs: DataFrame, group: DataFrame) -> DataFrame:
    """The pairs (u, v) whose nodes are in different groups. group: (node, root)."""
    a, b = (group.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in "uv")
    return pairs.join(a, "u", "left").join(b, "v", "left").filter("coalesce(u_root, u) <> coalesce(v_root, v)").select(*pairs.columns)


def links(found: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (u, v) between nodes that connect exactly what is similar. found: marks."""
    first = found.filter(F.size("sketch") > 0)
    posted = first.select(F.explode("prefix").alias("key"), "fp", "n")
    lists = scratch.keep(posted.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_list_batches, LIST_SCHEMA), "lists")
    nodes = scratch.keep(first.groupBy("fp").agg(F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("sketch").alias("sketch"), F.min("text_hash").alias("text_hash")), "nodes")
    near = verified(alike(fingerprint_pairs(nodes.select("fp", "bits")), nodes, scratch), docs, nodes, scratch)
    pairs = scratch.keep(lists.mapInArrow(_pair_batches, "u bigint, v bigint").distinct(), "pairs")
    near = near.unionByName(verified(alike(apart(pairs, components(near, scratch)), nodes, scratch), docs, nodes, scratch))
    if not lists.filter((F.size("members") > SHORT) | (F.col("piece") > 0)).limit(1).count():
        return near
    more = alike(between(lists, components(near, scratch), nodes, scratch), nodes, scratch)
    # Each node's nearest first: most pairs are within one group after that, and only what is left needs all its texts.
    best = more.select(F.explode(F.array("u", "v")).alias("node"), F.struct("d", "u", "v").alias("p")).groupBy("node").agg(F.min("p").alias("p"))
    near = near.unionByName(verified(best.select("p.u", "p.v").distinct(), docs, nodes, scratch))
    rest = apart(more, components(near, scratch))
    return near.unionByName(verified(rest, docs, nodes, scratch))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs without near copies: of each group the row with the smallest doc_id stays, as in simhash.drop_near_duplicates."""
    with Scratch(docs.sparkSession) as scratch:
        found = scratch.keep(marks(docs), "shingle-marks")
        group = components(links(found, docs, scratch), scratch)
        rows = found.select("doc_id", "text_hash", "fp")
        nodes = rows.select("fp").distinct()
        root = nodes.join(group, nodes["fp"] == group["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))
        return one_of_each(docs, rows, root)
