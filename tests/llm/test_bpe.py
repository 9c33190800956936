import hashlib
import random

import pytest

from sheafmill.llm import bpe


@pytest.fixture(scope="module")
def official():
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.codec().ranks, special_tokens={})


def test_like_tiktoken(official):
    rng = random.Random(1)
    pools = ["abcdefgh '", "aA1!\n\t ", "éñß中文字🙂 　\xa0\x85\x1c​'sdmtlver", "".join(chr(rng.randrange(32, 0x2FFF)) for _ in range(400)) + "  \n"]
    texts = ["", " ", "\n\n ", " 's it's we'll  x", "a" * 3000, "the" * 900, "ab" * 1500 + " ", "x" * 250 + " y", " \x85 z"]
    texts += ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(1, 300))) for _ in range(400)]
    own = bpe.codec()
    for text in texts:
        assert own.encode(text) == official.encode_ordinary(text), repr(text[:80])
        assert own.decode(own.encode(text)) == text.encode()
    together = [list(bpe.chain.from_iterable(blocks)) for blocks in own.encode_all(texts)]
    assert together == [official.encode_ordinary(text) for text in texts]
    assert own.queue.top == 0 and not any(own.queue.leaf)


def test_very_long_pre_token(official):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdeéß") for _ in range(200_000))
    assert bpe.codec().encode(text) == official.encode_ordinary(text)


def test_long_pre_tokens_are_forgotten(official, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_CHARACTERS", 20_000)
    rng = random.Random(4)
    own = bpe.Codec(bpe.codec().ranks, bpe.codec().pattern.pattern)
    for _ in range(30):
        texts = [" ".join("".join(rng.choice("abcdeé") for _ in range(rng.choice([3, 3000]))) for _ in range(4)) for _ in range(3)]
        assert [list(bpe.chain.from_iterable(blocks)) for blocks in own.encode_all(texts)] == [official.encode_ordinary(t) for t in texts]
        assert sum(map(len, own.chunks)) <= 20_000 + sum(map(len, texts))


def test_long_text_in_blocks(official):
    text = "the house and a tree, " * 120_000
    assert bpe.codec().encode(text) == official.encode_ordinary(text)


def test_lower_rank_comes_up():
    ranks = {bytes([b]): 1000 + b for b in range(256)} | {b"ab": 5, b"abc": 2, b"cab": 3, b"bc": 7, b"cc": 6, b"abcc": 1, b"aa": 4}
    own = bpe.Codec(ranks, r".+")
    rng = random.Random(3)

    def plain(piece):
        parts = [bytes([b]) for b in piece]
        while True:
            pairs = [(ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in ranks]
            if not pairs:
                return tuple(ranks[p] for p in parts)
            _, i = min(pairs)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    pieces = [bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 12))) for _ in range(500)]
    assert own.merge(pieces) == [plain(p) for p in pieces]


def test_rows(spark, official):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, "né", None), (2, None, "y"), (3, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(map(tuple, bpe.token_digests(docs).collect()), key=str)
    want = []
    for i, t, _ in rows:
        ids = official.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert all(r["exact"] and r["n_tokens"] == len(r["ids"]) for r in bpe.token_ids(docs).collect())
    assert bpe.token_digests(docs.limit(0)).collect() == []
