import random
import re

import pytest

from sheafmill.llm.licenses import BASE, NOTICES, Scanner, evaluate, family, postfix, scan, summary

PIECES = ["gnu", "general", "public", "license", "GNU", "License", "apache", "Apache", "cc", "BY", "mit", "MIT", "lesser", "É", "cc-by", " , ", "\n", "bsd", "x" * 50, "licenses", "7"]


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = []
    for phrase, label in BASE.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    places = [i for i, _ in found]
    return len(w), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


def test_base_equals_brute_force(spark):
    r = random.Random(1)
    texts = [" ".join(r.choice(PIECES) for _ in range(r.randint(0, 40))) for _ in range(300)] + [None, "", " ", "mit license mit license", "cc by cc by", "cc. By\x00cc_by", "mit license " * 20000, "mit licenses", "permit license"]
    rows = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id long, text string, places string, n_words int").repartition(4)
    got = {x["doc_id"]: x for x in summary(scan(rows)).collect()}
    for i, t in enumerate(texts):
        x = got[i]
        assert (x["n_words"], x["n_base"], x["first_word"], x["last_word"], x["base_labels"]) == brute(t), t
        assert set(filter(None, x["base_labels"].split(","))) <= set(filter(None, x["labels"].split(","))) and 0 <= x["score"] <= 1


def test_repeated_rows_and_empty_table(spark):
    rows = spark.createDataFrame([(1, "mit license"), (1, "mit license"), (None, None)], "doc_id int, text string")
    assert summary(scan(rows)).count() == 3
    assert summary(scan(rows.limit(0))).collect() == []


@pytest.mark.parametrize(
    "text,want",
    [
        ("MIT", ("MIT", ["mit"], 0.1)),
        ("GPL-2.0-only OR MIT", ("GPL-2.0-only OR MIT", ["gpl", "mit"], 0.1)),
        ("GPL-2.0-only and MIT", ("GPL-2.0-only AND MIT", ["gpl", "mit"], 0.6)),
        ("MIT OR Apache-2.0 AND GPL-3.0-or-later", ("MIT OR Apache-2.0 AND GPL-3.0-or-later", ["apache", "gpl", "mit"], 0.1)),
        ("(MIT OR Apache-2.0) AND GPL-3.0-or-later", ("(MIT OR Apache-2.0) AND GPL-3.0-or-later", ["apache", "gpl", "mit"], 0.6)),
        ("GPL-2.0-only WITH Classpath-exception-2.0 AND MIT", ("GPL-2.0-only WITH Classpath-exception-2.0 AND MIT", ["gpl", "mit"], 0.3)),
        ("((AGPL-3.0-only)) some more words", ("AGPL-3.0-only", ["agpl"], 0.8)),
        ("'BSD-3-Clause' */", ("BSD-3-Clause", ["bsd"], 0.1)),
        ("LicenseRef-Own.", ("LicenseRef-Own", ["other"], 0.5)),
    ],
)
def test_expressions(text, want):
    terms, whole = postfix(text)
    assert whole
    canonical, labels, value = evaluate(terms)
    assert (canonical, labels, pytest.approx(value)) == want


@pytest.mark.parametrize("text", ["", "OR MIT", "MIT OR", "(MIT", "(MIT OR", "MIT AND (", "()", "; text"])
def test_what_is_no_whole_expression(text):
    assert not postfix(text)[1]


def test_evaluation_equals_python_over_random_expressions():
    r = random.Random(2)
    names = {"MIT": 0.1, "GPL-3.0": 0.6, "AGPL-3.0": 0.8, "CC0-1.0": 0.0}

    def make(depth):
        if depth == 0 or r.random() < 0.3:
            name = r.choice(list(names))
            return name, names[name], 4
        (a, x, p), (b, y, q) = make(depth - 1), make(depth - 1)
        word, value, binds = r.choice([("or", min(x, y), 1), ("AND", max(x, y), 2)])
        a, b = (f"({a})" if p < binds else a), (f"({b})" if q < binds else b)
        return f"{a} {word} {b}", value, binds

    for _ in range(300):
        text, value, _ = make(5)
        terms, whole = postfix(text)
        canonical, _, got = evaluate(terms)
        assert whole and got == value and evaluate(postfix(canonical)[0])[2] == value


def test_deep_and_long_expressions():
    deep = "(" * 50_000 + "MIT" + ")" * 50_000
    assert evaluate(postfix(deep)[0])[0] == "MIT"
    long = " OR ".join(["MIT"] * 50_000)
    assert evaluate(postfix(long)[0])[0] == long


def test_tags_in_texts():
    s = Scanner()
    text = "é //* SPDX-License-Identifier: (MIT OR GPL-2.0+) AND cc-by-4.0\nSPDX-License-Identifier tags, License-Expression = \"Apache-2.0\"; spdx license identifier: MIT OR\n"
    n, places, found = s.scan(text)
    assert [(e["text"], e["labels"]) for e in found] == [("(MIT OR GPL-2.0+) AND cc-by-4.0", ["cc-by", "gpl", "mit"]), ("Apache-2.0", ["apache"]), (None, ["unparsed"])]
    assert [p["label"] for p in places] == ["cc-by"]


def test_notices():
    s = Scanner()
    for phrase, label in NOTICES.items():
        n, places, _ = s.scan(f"word {phrase.upper()}, word")
        assert label in [p["label"] for p in places] and n == len(phrase.split()) + 2
    assert family("lgpl-2.1") == "lgpl" and family("MITRE") == "other" and family("cc-by-sa-4.0") == "cc-by-sa"
