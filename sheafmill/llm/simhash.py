"""SimHash near-duplicates.

A text is lower-cased (A-Z), cut into words at ASCII white space and into shingles of three words; repeats count. A
fingerprint bit is 1 if it is set in over half of the shingles' XXH64 values (seed 42). A text with fewer than three
words has its whole word sequence as one shingle; a null, empty or blank text has fingerprint zero. Two documents
are linked if their fingerprints differ in at most two bits, and a component is what links reach.

Search: the byte-position inverted index. Two fingerprints that differ in at most two bits differ in at most two of the
eight bytes, so they share at least six (position, byte) entries, the guaranteed minimum. A posting list of a single entry would hold a 256th
of all fingerprints, so entries are posted in combinations: of the four 2-byte blocks at least two agree,
and each fingerprint is posted under its six block pairs, four entries each. Within a posting list the entries that each pair shares are
tallied, pairs below six are dropped, and those that are left are verified by counting differing bits. A posting list of more than
HOT_POSTING fingerprints is posted again under two more entries: four bytes remain, of which two or more agree. Such a
list has 16 free bits, so it never holds over 65,536 fingerprints, whatever the input. All its pairs share six entries, so a tally drops none of them;
where it is long, a member's partners are looked up under each change of at most two free bits (136 of them), not among all pairs. A list reports a spanning
forest of its links, not the pairs.

Defined cases: repeated rows and equal texts share a fingerprint, which is indexed once; an empty table gives an empty
result; a null doc_id gets its component's id, or null if no member has an id; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill.llm.common import Scratch, documents, keep, text_session, texts, tidy

SEED = 42
WIDTH = 3
MAX_BITS = 2
#: Positional bytes that a pair within MAX_BITS must share.
MIN_SHARED = 8 - MAX_BITS
#: Fingerprints in a posting list whose pairs are tallied; longer lists are posted under more bytes, and what is still longer is looked up.
HOT_POSTING = 1024
#: Pairs tallied at once.
TALLIED = 1 << 21
#: Bits of the filter over rows that may go.
GONE_BITS = 1 << 24
#: Shingles hashed at once, so that a very long text needs no more memory than a long one.
BLOCK = 1 << 16

_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _byte_mask(positions) -> int:
    return sum(0xFF << (8 * p) for p in positions)


#: Masks of four bytes (two 2-byte blocks), and for each the masks of six bytes that contain it.
WIDE = [tuple(sorted((2 * a, 2 * a + 1, 2 * b, 2 * b + 1))) for a, b in combinations(range(4), 2)]
NARROW = {w: [tuple(sorted(w + extra)) for extra in combinations([p for p in range(8) if p not in w], 2)] for w in WIDE}


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The unsigned 64-bit SimHash of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    hashed = xxhash.xxh64_intdigest
    if len(words) < width:
        return hashed(b" ".join(words), SEED)
    total = len(words) - width + 1
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, total, BLOCK):
        stop = min(start + BLOCK, total)
        part = words[start : stop + width - 1]
        if width == 3:
            values = [hashed(b"%b %b %b" % t, SEED) for t in zip(part, part[1:], part[2:])]
        else:
            values = [hashed(b" ".join(part[i : i + width]), SEED) for i in range(stop - start)]
        octets = np.array(values, dtype="<u8").view(np.uint8).reshape(-1, 8)
        for p in range(8):
            ones[8 * p : 8 * p + 8] += np.bincount(octets[:, p], minlength=256) @ _BYTE_BITS
    bits = np.flatnonzero(2 * ones > total)
    return int(sum(1 << int(b) for b in bits))


@tidy
def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.array([fingerprint(t) for t in texts(batch)], dtype=np.uint64).view(np.int64)
        columns = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text_hash")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(values)], names=["doc_id", "text_hash", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; fp is the fingerprint as a signed long."""
    text_session(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(_fingerprint_batches, f"doc_id {kind}, text_hash bigint, fp bigint")


def tally(members: np.ndarray, others: np.ndarray) -> np.ndarray:
    """How many (position, byte) entries each of members shares with each of others."""
    x = members[:, None] ^ others[None, :]
    shared = np.zeros(x.shape, dtype=np.int8)
    for p in range(8):
        shared += (x & np.uint64(0xFF << (8 * p))) == 0
    return shared


def changes(members: np.ndarray) -> np.ndarray:
    """Every change of 1 to MAX_BITS of the bits in which members differ from one another."""
    free = int(np.bitwise_or.reduce(members ^ members[0]))
    bits = [1 << b for b in range(64) if free >> b & 1]
    return np.array([sum(c) for m in range(1, MAX_BITS + 1) for c in combinations(bits, m)], dtype=np.uint64)


def _labels_of_long(members: np.ndarray) -> np.ndarray:
    """As _labels, by looking up each change of a member."""
    n, links_a, links_b = len(members), [], []
    order = np.argsort(members)
    ascending = members[order]
    for change in changes(members):
        partner = ascending ^ change
        at = np.minimum(np.searchsorted(ascending, partner), n - 1)
        a = np.flatnonzero((ascending[at] == partner) & (at < np.arange(n)))
        links_a.append(order[a])
        links_b.append(order[at[a]])
    a, b = np.concatenate(links_a), np.concatenate(links_b)
    return _settle(np.arange(n), np.concatenate([a, b]), np.concatenate([b, a]))


def _labels(members: np.ndarray) -> np.ndarray:
    """The smallest member (by position) each member is linked to, directly or not; members: distinct uint64."""
    n = len(members)
    if n > HOT_POSTING:
        return _labels_of_long(members)
    links_a, links_b = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    start = 0
    while start < n - 1:
        stop = min(n, start + max(1, TALLIED // (n - start)))
        a, b = np.nonzero(tally(members[start:stop], members[start:]) >= MIN_SHARED)
        a, b = a[a < b] + start, b[a < b] + start
        near = np.bitwise_count(members[a] ^ members[b]) <= MAX_BITS
        links_a.append(a[near])
        links_b.append(b[near])
        start = stop
    a, b = np.concatenate(links_a), np.concatenate(links_b)
    return _settle(np.arange(n), np.concatenate([a, b]), np.concatenate([b, a]))


def _settle(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        label = label[label]
        if np.array_equal(label, before):
            return label


@tidy
def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From posting lists (members): links (u, v), u > v as signed longs, one for each member that is not its list's smallest of a component."""
    for batch in batches:
        column = batch.column(0)
        offsets = column.offsets.to_numpy()
        flat = column.values.to_numpy(zero_copy_only=False)
        sizes = np.diff(offsets)
        two = offsets[:-1][sizes == 2]  # most lists: all of these at once
        a, b = flat[two], flat[two + 1]
        x = a.view(np.uint64) ^ b.view(np.uint64)
        shared = sum(((x & np.uint64(0xFF << (8 * p))) == 0).astype(np.int8) for p in range(8))
        near = np.flatnonzero(shared >= MIN_SHARED)
        near = near[np.bitwise_count(x[near]) <= MAX_BITS]
        out_u, out_v = [np.maximum(a, b)[near]], [np.minimum(a, b)[near]]
        for i in np.flatnonzero(sizes > 2):
            members = np.sort(flat[offsets[i] : offsets[i + 1]])
            label = _labels(members.view(np.uint64))
            own = np.flatnonzero(label != np.arange(len(members)))
            out_u.append(members[own])
            out_v.append(members[label[own]])
        if sum(map(len, out_u)):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_u)), pa.array(np.concatenate(out_v))], names=["u", "v"])


def _posted(fps: DataFrame, masks: list[tuple[int, ...]]) -> DataFrame:
    """A row (mask, key, fp) for each mask; mask has a bit for each byte position."""
    entries = [F.struct(F.lit(sum(1 << p for p in m)).cast("int").alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(_byte_mask(m)))).alias("key")) for m in masks]
    return fps.select("fp", F.explode(F.array(*entries)).alias("e")).select("e.mask", "e.key", "fp")


def links(fps: DataFrame) -> DataFrame:
    """Links (u, v) between distinct fingerprints that connect exactly what lies within MAX_BITS bits. fps: distinct fp."""
    wide = _posted(fps, WIDE)
    sizes = wide.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1")
    lists = wide.join(sizes, ["mask", "key"])
    short = lists.filter(f"n <= {HOT_POSTING}").groupBy("mask", "key").agg(F.collect_list("fp").alias("members")).select("members")
    again = None
    for w, masks in NARROW.items():
        one = _posted(lists.filter((F.col("n") > HOT_POSTING) & (F.col("mask") == sum(1 << p for p in w))).select("fp"), masks)
        again = one if again is None else again.unionByName(one)
    narrow = again.groupBy("mask", "key").agg(F.collect_set("fp").alias("members")).filter(F.size("members") > 1).select("members")
    return short.unionByName(narrow).mapInArrow(_link_batches, "u bigint, v bigint").distinct()


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, root) of every node that has a link; root is the smallest node reachable.

    Alternating large-star and small-star rounds; each is a grouped minimum and a join, written to the shared folder.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    edges = scratch.keep(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "links")
    seen = None
    while True:
        mark = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if mark == seen or not mark["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = scratch.keep(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = scratch.keep(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")


def rooted(marks: DataFrame, scratch: Scratch) -> DataFrame:
    """(fp, first_id, root) of each distinct fingerprint, root being one fingerprint of its component."""
    ids = scratch.keep(marks.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-ids")
    roots = components(links(ids.select("fp")), scratch)
    return ids.join(roots, ids["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of every row of docs."""
    marks = keep(fingerprints(docs), "fingerprints")
    with Scratch(docs.sparkSession) as scratch:
        root = scratch.keep(rooted(marks, scratch), "roots")
        smallest = root.groupBy("root").agg(F.min("first_id").alias("component_id"))
        of_fp = keep(root.join(smallest, "root").select("fp", "component_id"), "component-ids")
    return marks.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs without near-duplicates: of each component the row with the smallest doc_id stays.

    Rows of one doc_id are told apart by their text; of rows alike in both, one stays. A row without doc_id stays only where its
    component has no row with one.
    """
    with Scratch(docs.sparkSession) as scratch:
        marks = scratch.keep(fingerprints(docs), "fingerprints")
        return one_of_each(docs, marks, rooted(marks, scratch))


def one_of_each(docs: DataFrame, marks: DataFrame, root: DataFrame) -> DataFrame:
    """The rows of docs that stay, by (doc_id, text_hash, fp) of every row and (fp, root) of every fp.

    Only rows that may go are shuffled with their texts: a bitmap of GONE_BITS bits, whatever the input, tells the others.
    """
    first = marks.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_hash")).alias("first"))
    first = root.select("fp", "root").join(first, "fp")
    stay = first.groupBy("root").agg(F.min("first").alias("stay"))
    stay = first.join(stay, "root").select("fp", F.col("stay.doc_id").alias("_stay_id"), F.col("stay.text_hash").alias("_stay_text"))
    own = F.col("doc_id").eqNullSafe(F.col("_stay_id")) & (F.col("text_hash") == F.col("_stay_text"))
    rows = marks.join(stay, "fp").groupBy("doc_id", "text_hash").agg(F.first(own).alias("stays"), F.count("*").alias("n"))
    told = keep(rows.filter("NOT stays OR n > 1").select(F.col("doc_id").alias("_told_id"), F.col("text_hash").alias("_told_text"), F.col("stays").alias("_stays")), "dropped")

    def place(doc_id, text_hash):
        return F.pmod(F.xxhash64(doc_id, text_hash), F.lit(GONE_BITS)) + 1  # Spark's bitmaps count from 1

    bits = told.select(place("_told_id", "_told_text").alias("_p")).groupBy(F.expr("bitmap_bucket_number(_p)").alias("_bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_p))").alias("_bits"))
    marked = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("near_text"))  # so that no column of the input can clash with those beside it
    marked = marked.withColumn("_p", place("doc_id", "near_text")).join(F.broadcast(bits), F.expr("bitmap_bucket_number(_p)") == F.col("_bucket"), "left")  # at most GONE_BITS / 8 bytes
    octet = F.conv(F.hex(F.expr("substring(_bits, CAST(bitmap_bit_position(_p) DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    marked = marked.withColumn("hit", F.coalesce(octet.bitwiseAND(F.expr("shiftleft(1, CAST(bitmap_bit_position(_p) % 8 AS INT))")) > 0, F.lit(False)))
    may_go = marked.filter("hit").select("row", "doc_id", "near_text")
    may_go = may_go.join(told.filter("NOT _stays"), F.col("doc_id").eqNullSafe(F.col("_told_id")) & (F.col("near_text") == F.col("_told_text")), "left_anti").dropDuplicates(["doc_id", "near_text"])
    return marked.filter("NOT hit").select("row.*").unionByName(may_go.select("row.*"))


def op7_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
