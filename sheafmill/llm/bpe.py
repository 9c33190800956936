"""Byte-level BPE encoding and decoding with public rank files.

A text is cut into pre-tokens by the pattern; each is encoded by itself: a pre-token that is a vocabulary entry is that
token, any other is merged from its bytes, the adjacent pair of lowest rank first, of equal pairs the leftmost.

Merging uses a rank queue: each rank has a bucket of linked-list positions whose pair has that rank, and a bitmap of
three levels with 64-way fan-out says which buckets are filled, so that finding the next rank is three find-first-set
steps. Merged or changed positions stay in their buckets and are skipped when they come up. The work for n bytes is
O(n log n) for the order within buckets, so very long pre-tokens are no trouble. All pre-tokens of a group of texts that are new go
through one queue: a bucket then holds positions of many of them, and no pair reaches over the end of its pre-token. Positions of a bucket that are
the only ones of their pre-token in it can't disturb one another and are merged together, as arrays; the others are merged one after another.

Results of chunks (a run of non-space characters with one space before it, if there is one) are remembered, a bounded number per worker. No match of the pattern crosses from such a chunk into
the next, so a chunk can be encoded without what is around it.

Defined cases: null is the empty text, with no tokens and the digests of empty strings; rows are encoded one by one, so ties
and repeated rows do not matter; an empty table gives an empty result; other columns pass untouched or are not read.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
import sys
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sheafmill.llm.common import documents, give_back, text_session, texts, tidy

RANKS = "byte_bpe_multi_50k.tiktoken"
#: The characters of Unicode's White_Space property (fixed values).
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Chunks, and merged pre-tokens, remembered by a worker that does nothing else; it takes some 150 MB for them.
REMEMBERED = 400_000
#: By one that leaves memory to the stages before and after.
REMEMBERED_AMONG_STAGES = 80_000
#: Bytes of new pre-tokens that such a worker merges through its queue at once; what merging takes meanwhile is many times that.
MERGED_AMONG_STAGES = 1 << 17
#: Characters of the chunks that were learnt since all was forgotten; bounds a worker's memory where pre-tokens are long.
REMEMBERED_CHARACTERS = 1 << 24
#: Characters (or bytes) of texts that are encoded together, for each chunk that is remembered.
TOGETHER = 20
#: Chunks of a longer text that are encoded at once.
BLOCK = 1 << 16
#: Positions in a bucket from which on they are merged as arrays; fewer cost less one by one.
ARRAYS = 40

CHUNKS = re.compile(f" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
#: A chunk of ASCII letters, with a mark after them or without, is cut there by the pattern.
PLAIN = re.compile("( ?[A-Za-z]+)([,.;:!?]?)")


class RankQueue:
    """Buckets of positions by rank; `next` takes the filled bucket of the lowest rank."""

    def __init__(self, ranks: int):
        self.buckets: list[list[int]] = [[] for _ in range(ranks)]
        self.leaf = [0] * ((ranks >> 6) + 1)
        self.middle = [0] * ((ranks >> 12) + 1)
        self.top = 0

    def fill(self, rank: int, positions: list[int]) -> None:
        """Put positions into the bucket of a rank, which is empty."""
        self.buckets[rank] = positions
        self.leaf[rank >> 6] |= 1 << (rank & 63)
        self.middle[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets[rank]
        if bucket:
            bucket.append(position)
        else:
            self.fill(rank, [position])

    def next(self) -> tuple[int, list[int]] | None:
        top = self.top
        if not top:
            return None
        high = (top & -top).bit_length() - 1
        word = self.middle[high]
        mid = high << 6 | (word & -word).bit_length() - 1
        word = self.leaf[mid]
        bit = word & -word
        rank = mid << 6 | bit.bit_length() - 1
        bucket, self.buckets[rank] = self.buckets[rank], []
        self.leaf[mid] = word ^ bit
        if word == bit:
            self.middle[high] ^= 1 << (mid & 63)
            if not self.middle[high]:
                self.top ^= 1 << high
        return rank, bucket


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, remembered: int = REMEMBERED, at_once: int | None = None):
        self.ranks, self.at_once = ranks, at_once
        self.remembered, self.together = remembered, TOGETHER * remembered
        self.pattern = regex.compile(pattern)
        self.size = max(ranks.values(), default=-1) + 1
        self.token = [b""] * self.size
        for piece, rank in ranks.items():
            self.token[rank] = piece
        self.queue = RankQueue(self.size)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)])
        self.two = np.array([ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)])
        #: Rank of a pair, by the left rank * size + the right one; as a table, and as sorted arrays.
        self.joined = {ranks[t[:i]] * self.size + ranks[t[i:]]: r for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        self.keys, self.values = (np.array(x, dtype=np.int64) for x in (zip(*sorted(self.joined.items())) if self.joined else ((), ())))
        self.characters = 0
        self.chunks: dict[str, bytes] = {}  # ids as 32-bit integers
        self.own = {t: r.to_bytes(4, sys.byteorder) for t, r in ranks.items()}
        self.pieces: dict[bytes, bytes] = dict(self.own)
        self.bytes_of = _Ragged(self.token)
        self.decimal_of = _Ragged([f"{i},".encode() for i in range(self.size)])

    def _pair_ranks(self, left, right) -> np.ndarray:
        """The rank of each pair, or -1."""
        keys = left * self.size + right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.values[at], -1)

    def merge(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """The token ids of each piece."""
        ids, last = self.merged(pieces)
        return [tuple(ids[a:b].tolist()) for a, b in zip([0, *last], last)]

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, list[int]]:
        """The token ids of pieces one after another and where each piece's end, all merged through one queue: ranks ascend in every piece as they do in the queue."""
        if not pieces:
            return np.empty(0, dtype=np.int64), []
        octets = np.frombuffer(b"".join(pieces), dtype=np.uint8).astype(np.int64)
        n, rank_of, size, queue = len(octets), self.joined.get, self.size, self.queue
        lengths = np.array([len(p) for p in pieces])
        stops = np.cumsum(lengths)
        owner = np.repeat(np.arange(len(pieces)), lengths)
        ranks = np.full(n, -1)  # of the pair of the symbol at a position and the next; -1: none, -2: no symbol starts there any more
        ranks[:-1] = self.two[octets[:-1] << 8 | octets[1:]]
        ranks[stops - 1] = -1
        order = np.argsort(ranks, kind="stable")
        order = order[np.searchsorted(ranks[order], 0) :]
        filled, first = np.unique(ranks[order], return_index=True)
        for rank, positions in zip(filled.tolist(), np.split(order, first[1:])):
            queue.fill(rank, positions.tolist())
        symbols = self.byte[octets]
        ends = np.arange(1, n + 1)  # of the symbol that starts at a position
        befores = np.arange(-1, n - 1)  # start of the symbol before, -1: none; only for live starts
        piece_starts = np.zeros(n + 1, dtype=np.uint8)  # where a piece starts, or all end
        piece_starts[0] = piece_starts[stops] = 1
        befores[stops[:-1]] = -1
        pair, symbol, end, before, starts = map(memoryview, (ranks, symbols, ends, befores, piece_starts))
        while (item := queue.next()) is not None:
            rank, bucket = item
            if len(bucket) < ARRAYS:
                bucket.sort()
            else:
                at = np.array(bucket)
                at = np.sort(at[ranks[at] == rank])
                together = owner[at[1:]] == owner[at[:-1]]
                alone = np.ones(len(at), dtype=bool)
                alone[1:] &= ~together
                alone[:-1] &= ~together
                bucket, at = at[~alone].tolist(), at[alone]
                middle = ends[at]
                stop = ends[middle]
                ends[at] = stop
                symbols[at] = rank
                ranks[middle] = -2
                ranks[at] = -1
                inner = piece_starts[stop] == 0
                i, right = at[inner], stop[inner]
                befores[right] = i
                new = self._pair_ranks(rank, symbols[right])
                ranks[i] = new
                j = befores[at]
                j = j[j >= 0]
                newer = self._pair_ranks(symbols[j], rank)
                ranks[j] = newer
                have, haver = new >= 0, newer >= 0
                for new, i in zip(new[have].tolist() + newer[haver].tolist(), i[have].tolist() + j[haver].tolist()):
                    queue.push(new, i)
            for k, i in enumerate(bucket):
                if pair[i] != rank:  # stale
                    continue
                middle = end[i]
                stop = end[i] = end[middle]
                symbol[i] = rank
                pair[middle] = -2
                pair[i] = -1
                lower = False
                if not starts[stop]:
                    before[stop] = i
                    new = rank_of(rank * size + symbol[stop])
                    if new is not None:
                        pair[i] = new
                        queue.push(new, i)
                        lower = new < rank
                j = before[i]
                if j >= 0:
                    new = rank_of(symbol[j] * size + rank)
                    if new is None:
                        pair[j] = -1
                    else:
                        pair[j] = new
                        queue.push(new, j)
                        lower = lower or new < rank
                if lower and k + 1 < len(bucket):  # that pair comes first
                    queue.fill(rank, bucket[k + 1 :])
                    break
        live = ranks > -2
        return symbols[live], np.cumsum(live)[stops - 1].tolist()

    def learn(self, chunks: set[str]) -> None:
        """Encode the chunks that are not remembered; after it all of them are."""
        fresh = chunks.difference(self.chunks)
        self.characters += sum(map(len, fresh))
        long = self.characters > REMEMBERED_CHARACTERS  # long pre-tokens
        if long or len(self.chunks) + len(fresh) > self.remembered:
            self.chunks = {c: self.chunks[c] for c in chunks.difference(fresh)}
            self.characters = sum(map(len, chunks))
        parts, pieces = [], set()
        findall, plain = self.pattern.findall, PLAIN.fullmatch
        for chunk in fresh:
            if m := plain(chunk):
                word, mark = m.groups()
                own = (word.encode(), mark.encode()) if mark else (word.encode(),)
            else:
                own = [p.encode("utf-8", "surrogatepass") for p in findall(chunk)]
            parts.append((chunk, own))
            pieces.update(own)
        unmerged = list(pieces.difference(self.pieces))
        if long or len(self.pieces) + len(unmerged) > len(self.own) + self.remembered:  # those that came again stay
            self.pieces = self.own | {p: self.pieces[p] for p in pieces.difference(unmerged)}
        known = self.pieces
        for some in self._parts(unmerged):
            ids, last = self.merged(some)
            packed = ids.astype(np.int32).tobytes()
            known.update((p, packed[4 * a : 4 * b]) for p, a, b in zip(some, [0, *last], last))
        piece_ids = known.__getitem__
        for chunk, own in parts:
            self.chunks[chunk] = known[own[0]] if len(own) == 1 else b"".join(map(piece_ids, own))

    def _parts(self, pieces: list[bytes]) -> Iterator[list[bytes]]:
        """The pieces in lists of at most at_once bytes (or one piece)."""
        if self.at_once is None:
            yield pieces
            return
        start = size = 0
        for k, piece in enumerate(pieces):
            if k > start and size + len(piece) > self.at_once:
                yield pieces[start:k]
                start, size = k, 0
            size += len(piece)
        yield pieces[start:]

    def learned(self, every: Iterable[str]) -> Iterator[Iterable[list[str]]]:
        """The chunks of each text, in lists, all of them learned when they are given out; short texts are worked through together."""
        waiting: list[list[str]] = []
        size = 0
        for text in every:
            long = len(text) > self.together
            if long or size + len(text) > self.together:
                yield from self._together(waiting)
                waiting, size = [], 0
            if long:
                yield self._blocks(text)
            else:
                waiting.append(CHUNKS.findall(text))
                size += len(text)
        yield from self._together(waiting)

    def _blocks(self, text: str) -> Iterator[list[str]]:
        chunks = (m[0] for m in CHUNKS.finditer(text))
        while block := list(islice(chunks, BLOCK)):
            self.learn(set(block))
            yield block

    def _together(self, waiting: list[list[str]]) -> Iterator[list[list[str]]]:
        self.learn(set().union(*waiting))
        for chunks in waiting:
            yield [chunks]

    def ids(self, chunks: list[str]) -> np.ndarray:
        """The ids of learned chunks."""
        return np.frombuffer(b"".join(map(self.chunks.__getitem__, chunks)), np.int32)

    def encode_all(self, every: Iterable[str]) -> Iterator[Iterable[list[int]]]:
        """The ids of each text, in blocks."""
        for blocks in self.learned(every):
            yield (self.ids(chunks).tolist() for chunks in blocks)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(next(iter(self.encode_all([text])))))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class _Ragged:
    """Byte strings of different lengths, looked up many at a time."""

    def __init__(self, values: list[bytes]):
        self.flat = np.frombuffer(b"".join(values), dtype=np.uint8)
        self.length = np.array([len(v) for v in values], dtype=np.int64)
        self.first = np.cumsum(self.length) - self.length

    def joined(self, places: np.ndarray) -> bytes:
        lengths = self.length[places]
        stops = np.cumsum(lengths)
        at = np.repeat(self.first[places] - (stops - lengths), lengths)
        at += np.arange(len(at))
        return self.flat[at].tobytes()


@lru_cache(maxsize=2)
def codec(name: str = RANKS, remembered: int = REMEMBERED, at_once: int | None = None) -> Codec:
    """The codec of a rank file of the public tokenizers; loaded once in a worker."""
    import public_tokenizers

    gc.set_threshold(1_000_000, 20, 100)  # what is remembered is many small tuples without cycles; scanning them often costs a third of the time
    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return Codec(ranks, public_tokenizers.PATTERN, remembered, at_once)


def _grouped(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches put together up to so many bytes (or a batch)."""
    group, size = [], 0
    for batch in batches:
        if group and size + batch.nbytes > most:
            yield pa.concat_batches(group)
            group, size = [], 0
        group.append(batch)
        size += batch.nbytes
    if group:
        yield pa.concat_batches(group)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = codec()
    for batch in _grouped(batches, own.together):
        counts, ids_hex, bytes_hex = [], [], []
        for blocks in own.learned(texts(batch)):
            ids_hash, bytes_hash, n = hashlib.sha256(), hashlib.sha256(), 0
            for ids in map(own.ids, blocks):
                if not len(ids):
                    continue
                ids_hash.update(b"," * (n > 0) + own.decimal_of.joined(ids)[:-1])
                bytes_hash.update(own.bytes_of.joined(ids))
                n += len(ids)
            counts.append(n)
            ids_hex.append(ids_hash.hexdigest())
            bytes_hex.append(bytes_hash.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(bytes_hex, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


@tidy
def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    collects = gc.get_threshold()
    own = codec(remembered=REMEMBERED_AMONG_STAGES, at_once=MERGED_AMONG_STAGES)
    give_back()  # what loading the codec took besides
    for batch in _grouped(batches, own.together):
        ids, exact = [], []
        every = list(texts(batch))
        for text, blocks in zip(every, own.learned(every)):
            parts = [own.ids(chunks) for chunks in blocks]
            ids.append(np.concatenate(parts) if parts else np.empty(0, dtype=np.int32))
            exact.append(b"".join(map(own.bytes_of.joined, parts)) == text.encode("utf-8", "surrogatepass"))
        counts = np.array([len(x) for x in ids], dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.empty(0, dtype=np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(counts), pa.array(exact, pa.bool_())], names=["doc_id", "ids", "n_tokens", "exact"])
    codec.cache_clear()  # after this the worker does other work: loading a codec again takes half a second
    gc.set_threshold(*collects)


def token_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, ids, n_tokens, exact) of every row; exact: the decoded ids are the text again."""
    text_session(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_encoded, f"doc_id {kind}, ids array<int>, n_tokens bigint, exact boolean")


def token_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    text_session(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_digests, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op2_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return token_digests(documents(spark, sf_dir))
