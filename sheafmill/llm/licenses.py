"""License scans: notice phrases and identifier tags in whole texts, and the licence expressions that follow the tags.

Texts are lower-cased in A-Z and cut into words. One Aho-Corasick automaton finds all phrases at once, at word boundaries: the base phrases, notices of the method's own, and tags such as
`SPDX-License-Identifier:`. What follows a tag in its line is read as an expression of licence identifiers with `or`, `and`, `with` (in falling looseness) and parentheses; a
shunting-yard parser turns it into postfix order, which is evaluated twice: to a canonical text, and to how far the licence restricts use (0 to 1). Of `or` the reader
may choose, so the lesser restriction counts; of `and` all hold, so the greater; `with` grants an exception and halves it. A document is as restricted as the worst of its notices and expressions.

Memory is a few times the longest text; stacks are lists, so nesting has no limit. Every task builds its automaton from a handful of phrases.

Defined cases: null and empty texts have no words and no places, score 0; a tag without `:` or `=` behind it, or without an identifier, is no tag; an expression ends before the first word that
can't go on with it, and one that ends too early (an operand or a parenthesis is missing) has the label `unparsed` and counts as unknown; identifiers of no known family have the label `other`; repeated rows are
rows of their own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill.llm.common import documents, text_session, texts

#: Base phrases and their labels (fixed values).
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Notices of the method's own.
NOTICES = {
    "gnu lesser general public license": "lgpl", "gnu library general public license": "lgpl", "gnu affero general public license": "agpl", "gnu free documentation license": "gfdl",
    "mozilla public license": "mpl", "eclipse public license": "epl", "bsd license": "bsd", "isc license": "isc", "boost software license": "bsl", "artistic license": "artistic",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit", "redistribution and use in source and binary forms": "bsd",
    "creative commons attribution": "cc-by", "creative commons zero": "cc0", "dedicated to the public domain": "public-domain", "all rights reserved": "proprietary",
}
#: Words of a tag, which an expression follows.
TAGS = ["spdx license identifier", "license expression"]
#: How far a family of licences restricts use: not at all (0), by a notice, by sharing changed files alike, by sharing the whole alike, also over a network, wholly (1).
RESTRICTION = {
    "public-domain": 0.0, "cc0": 0.0, "unlicense": 0.0, "0bsd": 0.0, "mit": 0.1, "bsd": 0.1, "isc": 0.1, "apache": 0.1, "bsl": 0.1, "zlib": 0.1, "cc-by": 0.2, "artistic": 0.3, "lgpl": 0.4, "mpl": 0.4, "epl": 0.4,
    "cc-by-sa": 0.5, "gfdl": 0.6, "gpl": 0.6, "agpl": 0.8, "cc-by-nd": 0.9, "cc-by-nc": 0.9, "proprietary": 1.0, "other": 0.5, "unparsed": 0.5,
}
FAMILIES = sorted(RESTRICTION.keys() - {"other", "unparsed"}, key=len, reverse=True)

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_ASSIGN = re.compile(r"[\"']?[ \t]*[:=]")
_TOKEN = re.compile(r"[ \t\"']*(?:([()])|([A-Za-z0-9][A-Za-z0-9.:+-]*))")
#: How tightly operators bind.
BINDS = {"OR": 1, "AND": 2, "WITH": 3}

SCHEMA = "n_words long, places array<struct<word: long, words: int, label: string, base: boolean>>, expressions array<struct<word: long, text: string, labels: array<string>, restriction: double>>"
_ARROW = [
    ("n_words", pa.int64()),
    ("places", pa.list_(pa.struct([("word", pa.int64()), ("words", pa.int32()), ("label", pa.string()), ("base", pa.bool_())]))),
    ("expressions", pa.list_(pa.struct([("word", pa.int64()), ("text", pa.string()), ("labels", pa.list_(pa.string())), ("restriction", pa.float64())]))),
]


def lower(text: str) -> str:
    """text with A-Z lower-cased: bytes.lower() knows no other letters."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def family(identifier: str) -> str:
    """The label of a licence identifier: its longest known beginning that ends where a part of it does."""
    name = identifier.lower()
    return next((f for f in FAMILIES if name.startswith(f) and not name[len(f) : len(f) + 1].isalpha()), "other")


def postfix(text: str, start: int = 0) -> tuple[list[tuple[str, str]], bool]:
    """The expression at this place of a line in postfix order, as (kind, text), and whether it is whole; by the shunting-yard algorithm."""
    out: list[tuple[str, str]] = []
    stack: list[str] = []
    operand = True  # what is expected next
    while m := _TOKEN.match(text, start):
        sign, word = m[1], m[2]
        if operand and sign == "(":
            stack.append("(")
        elif not operand and sign == ")" and "(" in stack:
            while (top := stack.pop()) != "(":
                out.append(("operator", top))
        elif not operand and word and word.upper() in BINDS:
            while stack and stack[-1] != "(" and BINDS[stack[-1]] >= BINDS[word.upper()]:
                out.append(("operator", stack.pop()))
            stack.append(word.upper())
            operand = True
        elif operand and word and word.upper() not in BINDS:
            out.append(("identifier", word.rstrip(".:-")))
            operand = False
        else:
            break
        start = m.end()
    whole = bool(out) and not operand and "(" not in stack
    return out + [("operator", x) for x in reversed(stack) if x != "("], whole


def evaluate(terms: list[tuple[str, str]]) -> tuple[str, list[str], float]:
    """(canonical text, labels, restriction) of an expression in postfix order. Pieces of the text are joined once, at the end."""
    stack: list[tuple[list, int, float]] = []  # a tree of pieces, how tightly its top binds, its restriction
    labels: set[str] = set()
    exceptions = _exceptions(terms)
    for at, (kind, word) in enumerate(terms):
        if kind == "identifier":
            name = family(word)
            if at not in exceptions:
                labels.add(name)
            stack.append(([word], 4, RESTRICTION[name]))
            continue
        (right, rb, rv), (left, lb, lv) = stack.pop(), stack.pop()
        b = BINDS[word]
        value = {"OR": min(lv, rv), "AND": max(lv, rv), "WITH": lv / 2}[word]
        stack.append(([*(["(", left, ")"] if lb < b else [left]), f" {word} ", *(["(", right, ")"] if rb < b else [right])], b, value))
    tree, _, value = stack.pop()
    pieces, todo = [], [tree]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            pieces.append(node)
        else:
            todo.extend(reversed(node))
    return "".join(pieces), sorted(labels), value


def _exceptions(terms: list[tuple[str, str]]) -> set[int]:
    """Places of the identifiers that stand to the right of `with`: exceptions, not licences."""
    ends: list[list[int]] = []
    out: set[int] = set()
    for at, (kind, word) in enumerate(terms):
        if kind == "identifier":
            ends.append([at])
        else:
            right, left = ends.pop(), ends.pop()
            if word == "WITH":
                out.update(right)
                ends.append(left)
            else:
                ends.append(right if len(right) > len(left) else left)
                ends[-1].extend(left if ends[-1] is right else right)
    return out


class Scanner:
    """The automaton of all phrases and tags. Phrases stand between blanks, so that they match whole words only; neighbours share a blank."""

    def __init__(self, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES, tags: list[str] = TAGS):
        self.machine = ahocorasick.Automaton()
        found: dict[str, list] = {}
        for phrases, kind in ((base, "base"), (notices, "notice"), (dict.fromkeys(tags), "tag")):
            for phrase, label in phrases.items():
                found.setdefault(f" {phrase} ", []).append((kind, label))
        for padded, uses in found.items():
            self.machine.add_word(padded, (len(padded), padded.count(" ") - 1, uses))
        self.machine.make_automaton()

    def scan(self, text: str) -> tuple[int, list[dict], list[dict]]:
        """(number of words, places, expressions) of a text."""
        low = lower(text)
        words = WORD.findall(low)
        joined = f" {' '.join(words)} "
        hits = sorted((end - length + 1, n, uses) for end, (length, n, uses) in self.machine.iter(joined))
        places, tags = [], []
        word = at = 0
        for start, n, uses in hits:
            word, at = word + joined.count(" ", at, start), start
            for kind, label in uses:
                if kind == "tag":
                    tags.append((word, n))
                else:
                    places.append({"word": word, "words": n, "label": label, "base": kind == "base"})
        return len(words), places, list(self._expressions(text, low, tags))

    def _expressions(self, text: str, low: str, tags: list[tuple[int, int]]) -> Iterator[dict]:
        spans, done = WORD.finditer(low), 0
        for word, n in tags:
            last = word + n - 1
            if last < done:
                continue
            end = next(islice(spans, last - done, None)).end()
            done = last + 1
            if m := _ASSIGN.match(text, end):
                terms, whole = postfix(text, m.end())
                if whole:
                    canonical, labels, value = evaluate(terms)
                    yield {"word": word, "text": canonical, "labels": labels, "restriction": value}
                elif terms:
                    yield {"word": word, "text": None, "labels": ["unparsed"], "restriction": RESTRICTION["unparsed"]}


def scan(docs: DataFrame, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES, tags: list[str] = TAGS) -> DataFrame:
    """(doc_id, n_words, places, expressions) of every row of docs (doc_id, text): where phrases stand, and the expressions behind tags."""
    text_session(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices, tags)
        for batch in batches:
            found = [scanner.scan(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([f[i] for f in found], t) for i, (_, t) in enumerate(_ARROW))], names=["doc_id", *(name for name, _ in _ARROW)])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


def summary(scanned: DataFrame) -> DataFrame:
    """A row for each document of scan(): n_base places of base phrases, the first and the last of them, labels, and score: how far its licences restrict use."""
    first = F.filter("places", lambda p: p["base"])
    labels = F.flatten(F.array(F.transform("places", lambda p: p["label"]), F.flatten(F.transform("expressions", lambda e: e["labels"]))))
    grades = F.create_map(*(F.lit(x) for pair in RESTRICTION.items() for x in pair))
    worst = F.array_max(F.concat(F.transform("places", lambda p: F.coalesce(grades[p["label"]], F.lit(RESTRICTION["other"]))), F.transform("expressions", lambda e: e["restriction"]), F.array(F.lit(0.0))))
    marked = scanned.withColumn("_base", first)
    return marked.select(
        "doc_id", "n_words", F.size("_base").cast("long").alias("n_base"), F.array_min(F.transform("_base", lambda p: p["word"])).alias("first_word"), F.array_max(F.transform("_base", lambda p: p["word"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("_base", lambda p: p["label"]))), ",").alias("base_labels"), F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"), worst.alias("score"),
        F.transform("expressions", lambda e: e["text"]).alias("expressions"),
    )


def op12_license_scan(spark, sf_dir: str) -> DataFrame:
    return summary(scan(documents(spark, sf_dir)))
