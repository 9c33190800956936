"""Benchmark decontamination: containment search of short test items inside long documents.

Texts are lower-cased and cut into words (runs of letters, digits and underscores) and shingles of five words. An item is
contained in a document if at least 0.8 of its distinct shingles are among the document's. An item with fewer than five
words has its whole word sequence as one shingle, of that many words; an item without words is in no document.

Search: size-partitioned MinHash containment. Signatures of whole documents can't see a short item in a long document, as their Jaccard similarity is about item size over
document size; so only the items have sketches, and a document's side is all its shingle hashes (containment
MinHash). Items are partitioned by shingle count, in powers of two. In the partition of counts up to u, an item's sketch is its k = u - ceil(0.8 u) + 1
smallest hash values: an item of n <= u shingles that is contained in a document misses at most n - ceil(0.8 n) <= k - 1 of its
shingles there, so at least one value of its sketch is among the document's. No contained item is lost, however long the
document. Candidates are verified by exact shingle containment on the words themselves.

What departs from a size-partitioned ensemble over documents is this side: items are partitioned and sketched, documents probe.

Sketches are built by tasks over the items and written into the shared folder, a file for each block of about ITEM_BLOCK_WORDS words: sorted hash
values with their items, and the items' texts. The documents are read once, whatever the number of blocks; workers map the files, so memory does not grow
with the benchmark. The driver holds a row for each file. A task that is lost writes another file, and only files of tasks that succeeded are listed.

Defined cases: a null text is the empty text; repeated documents and repeated items each get their own rows; null ids are carried;
an empty table on either side gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill.llm.common import documents, shared_path, text_session, texts, tidy
from sheafmill.llm.files import File, write_arrays

WIDTH = 5
LEAST = 0.8
#: Words of the items whose sketches are in one file, and shingles of items that a worker remembers.
ITEM_BLOCK_WORDS = 1_000_000
REMEMBERED_SHINGLES = 200_000
#: Word hashes remembered by a worker.
REMEMBERED = 100_000
#: Words hashed at once.
BLOCK = 1 << 18

WORDS = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def item_shingles(text: str | None) -> set[tuple[str, ...]]:
    words = words_of(text)
    width = min(WIDTH, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def needed(n: int) -> int:
    """The least number of n shingles that is 0.8 of them or more."""
    return math.ceil(LEAST * n - 1e-9)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found


_hash_of = _Hashes()


def shingle_hashes(words: list, width: int, hash_of: dict = _hash_of) -> np.ndarray:
    """A 64-bit hash of each shingle, from the hashes of its words."""
    n = len(words)
    if n < width:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(hash_of.__getitem__, words), dtype=np.uint64, count=n)
    out = h[: n - width + 1].copy()
    for j in range(1, width):
        out *= _MIX
        out ^= out >> np.uint64(29)
        out += h[j : n - width + 1 + j]
    return out


def sketch_arrays(items: list[tuple]) -> tuple[list[np.ndarray], list[int], int]:
    """(arrays, values of each width, items) of a block of items, (id, text) each: sorted hash values and owners by width, then ids, whether they are null, ends of texts, texts."""
    values, owners, kept = [[] for _ in range(WIDTH)], [[] for _ in range(WIDTH)], []
    for item_id, text in items:
        words = words_of(text)
        if not words:
            continue
        width = min(WIDTH, len(words))
        shingles = item_shingles(text)
        upper = 1 << (len(shingles) - 1).bit_length()  # the largest count of its partition
        k = upper - needed(upper) + 1
        sketch = np.sort(np.concatenate([shingle_hashes(list(s), width) for s in shingles]))[:k]
        values[width - 1].append(sketch)
        owners[width - 1].append(np.full(len(sketch), len(kept), dtype=np.int64))
        kept.append((item_id, text.encode("utf-8", "surrogatepass")))
    arrays, sizes = [], []
    for v, o in zip(values, owners):
        v, o = (np.concatenate(x) if x else np.empty(0, dtype=t) for x, t in ((v, np.uint64), (o, np.int64)))
        order = np.argsort(v, kind="stable")
        arrays += [v[order].astype("<u8"), o[order].astype("<i8")]
        sizes.append(len(v))
    ids = np.array([i or 0 for i, _ in kept], dtype="<i8")
    null = np.array([i is None for i, _ in kept], dtype="<i8")
    ends = np.cumsum([0, *(len(t) for _, t in kept)]).astype("<i8")
    return [*arrays, ids, null, ends, np.frombuffer(b"".join(t for _, t in kept), dtype=np.uint8)], sizes, len(kept)


class Sketches:
    """A file of sketches: for each shingle width sorted hash values and the items that have them; items are read when they are candidates."""

    def __init__(self, uri: str, sizes: list[int], n: int):
        self.file, self.index, at = File(uri), {}, 0
        for width, size in enumerate(sizes, 1):
            if size:
                self.index[width] = (self.file.read(at, "<u8", size), self.file.read(at + 8 * size, "<i8", size))
            at += 16 * size
        self.ids, self.null, self.ends = (self.file.read(at + 8 * k * n, "<i8", n + (k == 2)) for k in range(3))
        self.texts = at + 8 * (3 * n + 1)
        self.known: dict[int, set] = {}
        self.size = 0

    def probe(self, width: int, hashes: np.ndarray) -> set[int]:
        """The items of this width with one of the hash values."""
        found: set[int] = set()
        if width in self.index:
            values, owners = self.index[width]
            at = np.searchsorted(values, hashes)
            at[at == len(values)] = 0
            hit = np.unique(hashes[values[at] == hashes])
            for a, b in zip(np.searchsorted(values, hit, "left"), np.searchsorted(values, hit, "right")):
                found.update(owners[a:b].tolist())
        return found

    def item(self, i: int) -> int | None:
        return None if self.null[i] else int(self.ids[i])

    def shingles(self, i: int) -> set[tuple[str, ...]]:
        if i not in self.known:
            if self.size > REMEMBERED_SHINGLES:
                self.known, self.size = {}, 0
            text = self.file.read(self.texts + int(self.ends[i]), "u1", int(self.ends[i + 1] - self.ends[i]))
            self.known[i] = item_shingles(text.tobytes().decode("utf-8", "surrogatepass"))
            self.size += len(self.known[i])
        return self.known[i]


def search(every: list[Sketches], text: str) -> Iterator[tuple]:
    """(item id, the item's shingles, shared) of each item that is contained in the text."""
    words = words_of(text)
    for width in sorted(set().union(*(s.index for s in every))):
        candidates: set[tuple[int, int]] = set()
        for start in range(0, len(words) - width + 1, BLOCK):
            hashes = shingle_hashes(words[start : start + BLOCK + width - 1], width)
            for b, sketches in enumerate(every):
                candidates.update((b, i) for i in sketches.probe(width, hashes))
        if candidates:
            asked = {(b, i): every[b].shingles(i) for b, i in sorted(candidates)}
            own = set().union(*asked.values()).intersection(zip(*(words[j:] for j in range(width))))
            for (b, i), shingles in asked.items():
                shared = len(shingles & own)
                if shared >= needed(len(shingles)):
                    yield every[b].item(i), len(shingles), shared


def _write_sketches(root: str):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def written():
            arrays, sizes, n = sketch_arrays(held)
            schema = pa.schema([("uri", pa.string()), ("sizes", pa.list_(pa.int64())), ("n", pa.int64())])
            return pa.RecordBatch.from_pylist([{"uri": write_arrays(root, arrays), "sizes": sizes, "n": n}] if n else [], schema)

        for batch in batches:
            for item_id, text in zip(batch.column(0).to_pylist(), texts(batch)):
                held.append((item_id, text))
                size += len(words_of(text))
                if size >= ITEM_BLOCK_WORDS:
                    yield written()
                    held, size = [], 0
        if held:
            yield written()

    return run


def write_sketches(items: DataFrame) -> list[tuple]:
    """Write the sketches of all items; (file, values of each width, items) of each file."""
    spark = items.sparkSession
    text_session(spark)
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    words = items.agg(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), r"\W+")))).first()[0] or 0
    files = items.repartition(math.ceil((words + 1) / ITEM_BLOCK_WORDS)).mapInArrow(_write_sketches(shared_path(spark, "sketches")), "uri string, sizes array<bigint>, n bigint")
    return [tuple(r) for r in files.collect()]  # a row for each ITEM_BLOCK_WORDS words


def _searcher(files: list[tuple]):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = [Sketches(*f) for f in files]
        for batch in batches:
            doc, rows = [], []
            for k, text in enumerate(texts(batch)):
                for row in search(every, text):
                    doc.append(k)
                    rows.append(row)
            ids = batch.column(0).take(pa.array(doc, pa.int64()))
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", "item_id", "n_shingles", "shared"])
        _hash_of.clear()

    return run


def contained_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_shingles, shared, containment) of each document and item that it contains."""
    text_session(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(_searcher(write_sketches(items)), f"doc_id {kind}, item_id bigint, n_shingles bigint, shared bigint")
    return found.withColumn("containment", F.col("shared") / F.col("n_shingles"))


def _clean_rows(files: list[tuple]):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = [Sketches(*f) for f in files]
        for batch in batches:
            stay = [next(search(every, text), None) is None for text in texts(batch)]
            yield batch.filter(pa.array(stay, pa.bool_()))
        _hash_of.clear()

    return run


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs that contain no item."""
    text_session(docs.sparkSession)
    return docs.mapInArrow(_clean_rows(write_sketches(items)), docs.schema)


def op6_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    return contained_items(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE_OP6 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents),
  i AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM benchmark),
  a AS (SELECT DISTINCT q, k, array_to_string(w[p : p + k - 1], ' ') AS s FROM (SELECT q, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM (SELECT *, least(5, len(w)) AS k FROM i WHERE len(w) > 0))),
  b AS (SELECT DISTINCT r, k, array_to_string(w[p : p + k - 1], ' ') AS s FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM a) WHERE len(w) >= k)),
  n AS (SELECT q, count(*) AS n FROM a GROUP BY q),
  m AS (SELECT r, q, count(*) AS shared FROM a JOIN b USING (k, s) GROUP BY r, q)
SELECT doc_id, item_id, n AS n_shingles, shared, shared / CAST(n AS DOUBLE) AS containment
FROM m JOIN n USING (q) JOIN d USING (r) JOIN i USING (q) WHERE shared >= ceil(0.8 * n - 1e-9)
"""
