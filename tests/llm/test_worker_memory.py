"""A worker that has done one stage's task lives on beside the next stages, so it must not keep what the task took."""

import random
import subprocess
import sys
from pathlib import Path

import pyarrow as pa

from sheafmill.llm import bpe

REPO = str(Path(bpe.__file__).parents[2])

PROGRAM = """
import random, re, sys
sys.path.insert(0, {repo!r})
import numpy as np, pandas, pyarrow as pa
from sheafmill.llm import common, near_copies

def own():
    return int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024

rng = random.Random(5)
words = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(60_000)]

def batches():
    for k in range(12):
        yield pa.RecordBatch.from_pydict({{"text": ["one more of the texts " + " ".join(rng.choices(words, k=500)) for _ in range(200)]}})

before = own()
assert sum(b.num_rows for b in near_copies._repeated(batches())) > 0
print(own() - before)
"""


def test_little_stays_after_a_task():
    """Counting shingles takes some 70 MB while it runs."""
    grown = float(subprocess.run([sys.executable, "-c", PROGRAM.format(repo=REPO)], capture_output=True, text=True, check=True, timeout=300).stdout)
    assert grown < 10, grown


def _batches():
    rng = random.Random(6)
    for _ in range(3):
        texts = [" ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 12))) for _ in range(60)) for _ in range(20)]
        yield pa.RecordBatch.from_pydict({"doc_id": list(range(20)), "text": texts})


def test_no_codec_stays_after_encoding(monkeypatch):
    want = [bpe.codec().encode(t.as_py()) for b in _batches() for t in b.column(1)]
    monkeypatch.setattr(bpe, "MERGED_AMONG_STAGES", 50)
    got = [x for b in bpe._encoded(_batches()) for x in b.column(1).to_pylist()]
    assert got == want
    assert bpe.codec.cache_info().currsize == 0


def test_merged_in_parts():
    whole = bpe.codec()
    own = bpe.Codec(whole.ranks, whole.pattern.pattern, at_once=9)
    assert list(own._parts([])) == [[]] and list(own._parts([b"x" * 20, b"ab", b"c" * 7, b"d"])) == [[b"x" * 20], [b"ab", b"c" * 7], [b"d"]]
    sizes, merged = [], own.merged
    own.merged = lambda pieces: sizes.append((len(pieces), sum(map(len, pieces)))) or merged(pieces)
    for batch in _batches():
        for text in batch.column(1).to_pylist():
            assert own.encode(text) == whole.encode(text)
    assert sizes and all(n <= 1 or size <= 9 for n, size in sizes)
