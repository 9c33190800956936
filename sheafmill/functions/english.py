"""English full text: stop words and stems, as SQL that Spark and DuckDB both read (`@match` stands for their name of a regular expression's test).

The stems are those of the published Snowball English stemmer (without apostrophes, as terms have none). A term goes through numbered steps; each looks for the longest of its endings, and changes the term only if
what stands before it meets the ending's condition. R1 is what follows the first consonant after a vowel, R2 the same within R1; a step's condition on them is one on
where the ending begins. Stems are meant to be worked out once for each distinct term.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Stop words of English full text (fixed values).
STOP_WORDS = """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they them their theirs themselves what which who whom this
that these those am is are was were be been being have has had having do does did doing a an the and but if or because as until while of at by for with about against between into through during before after above
below to from up down in out on off over under again further then once here there when where why how all any both each few more most other some such no nor not only own same so than too very s t can will just don should now""".split()

# Terms with stems of their own, and terms that are their own stems, before the first step and after step 1a (fixed values).
SPECIAL = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl"}
FIXED = "sky news howe atlas cosmos bias andes".split()
FIXED_LATER = "inning outing canning herring earring proceed exceed succeed".split()

_V = "[aeiouy]"
#: A short syllable at the end of what stands before an ending. A consonant y is Y here.
_SHORT = "([^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$"


def _rest(word: str, n: int) -> str:
    return f"substr({word}, 1, length({word}) - ({n}))"


def _ending(rules: list[tuple[str, str, str]], word: str = "w") -> str:
    """CASE over endings, longest first: (ending, what it becomes, condition on {rest}, the part before it; empty: none)."""
    lines = []
    for ending, new, condition in sorted(rules, key=lambda r: -len(r[0])):
        rest = _rest(word, len(ending))
        changed = f"concat({rest}, '{new}')" if new else rest
        lines.append(f"WHEN {word} LIKE '%{ending}' THEN " + (f"CASE WHEN {condition.format(rest=rest)} THEN {changed} ELSE {word} END" if condition else changed))
    return f"CASE {' '.join(lines)} ELSE {word} END"


_R1, _R2 = "length({rest}) >= r1", "length({rest}) >= r2"

_STEP_1A = f"""CASE WHEN w LIKE '%sses' THEN {_rest('w', 2)} WHEN w LIKE '%ied' OR w LIKE '%ies' THEN CASE WHEN length(w) > 4 THEN {_rest('w', 2)} ELSE {_rest('w', 1)} END
    WHEN w LIKE '%us' OR w LIKE '%ss' THEN w WHEN w LIKE '%s' AND @match(w, '{_V}.+s$') THEN {_rest('w', 1)} ELSE w END"""
#: The ending of step 1b that a term has: its length, or 0 where the step changes nothing.
_CUT_1B = "CASE " + " ".join(f"WHEN w LIKE '%{e}' THEN CASE WHEN @match({_rest('w', len(e))}, '{_V}') THEN {len(e)} ELSE 0 END" for e in ("ingly", "edly", "ing", "ed")) + " ELSE 0 END"
_EED = "CASE " + " ".join(f"WHEN w LIKE '%{e}' THEN CASE WHEN length(w) - {len(e)} >= r1 THEN concat({_rest('w', len(e))}, 'ee') ELSE w END" for e in ("eedly", "eed")) + " END"
_STEP_1B = f"""CASE WHEN w LIKE '%eed' OR w LIKE '%eedly' THEN {_EED} WHEN cut = 0 THEN w WHEN @match({_rest('w', 'cut')}, '(at|bl|iz)$') THEN concat({_rest('w', 'cut')}, 'e')
    WHEN @match({_rest('w', 'cut')}, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN {_rest('w', 'cut + 1')}
    WHEN length(w) - cut <= r1 AND @match({_rest('w', 'cut')}, '{_SHORT}') THEN concat({_rest('w', 'cut')}, 'e') ELSE {_rest('w', 'cut')} END"""
_STEP_1C = f"CASE WHEN @match(w, '.[^aeiouy][yY]$') THEN concat({_rest('w', 1)}, 'i') ELSE w END"
_STEP_2 = _ending([
    *((a, b, _R1) for a, b in (("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"), ("entli", "ent"), ("izer", "ize"), ("ization", "ize"), ("ational", "ate"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("aliti", "al"),
      ("alli", "al"), ("fulness", "ful"), ("ousli", "ous"), ("ousness", "ous"), ("iveness", "ive"), ("iviti", "ive"), ("biliti", "ble"), ("bli", "ble"), ("fulli", "ful"), ("lessli", "less"))),
    ("ogi", "og", f"{_R1} AND {{rest}} LIKE '%l'"), ("li", "", f"{_R1} AND @match({{rest}}, '[cdeghkmnrt]$')"),
])
_STEP_3 = _ending([*((a, b, _R1) for a, b in (("tional", "tion"), ("ational", "ate"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))), ("ative", "", _R2)])
_STEP_4 = _ending([*((a, "", _R2) for a in "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize".split()), ("ion", "", f"{_R2} AND @match({{rest}}, '[st]$')")])
_STEP_5 = f"""CASE WHEN w LIKE '%e' AND (length(w) - 1 >= r2 OR length(w) - 1 >= r1 AND NOT @match({_rest('w', 1)}, '{_SHORT}')) THEN {_rest('w', 1)} WHEN w LIKE '%ll' AND length(w) - 1 >= r2 THEN {_rest('w', 1)} ELSE w END"""
_R1_OF = f"CASE WHEN @match(w, '^(gener|arsen)') THEN 5 WHEN @match(w, '^commun') THEN 6 WHEN @match(w, '{_V}[^aeiouy]') THEN length(regexp_extract(w, '^([^aeiouy]*[aeiouy]+[^aeiouy])', 1)) ELSE length(w) END"
_R2_OF = f"CASE WHEN @match(substr(w, r1 + 1), '{_V}[^aeiouy]') THEN r1 + length(regexp_extract(substr(w, r1 + 1), '^([^aeiouy]*[aeiouy]+[^aeiouy])', 1)) ELSE length(w) END"

#: (column, expression) one after another: each may use those before it.
STEPS = [
    ("w", "regexp_replace(w, '^y', 'Y')"), ("w", "regexp_replace(w, '([aeiouy])y', '@1Y')"),
    ("r1", _R1_OF), ("r2", _R2_OF), ("w", _STEP_1A), ("later", f"w IN ({', '.join(repr(x) for x in FIXED_LATER)})"), ("cut", _CUT_1B), ("w", f"CASE WHEN later THEN w ELSE {_STEP_1B} END"),
    *(("w", f"CASE WHEN later THEN w ELSE {step} END") for step in (_STEP_1C, _STEP_2, _STEP_3, _STEP_4, _STEP_5)),
]
_OWN = " ".join([*(f"WHEN term = '{a}' THEN '{b}'" for a, b in SPECIAL.items()), f"WHEN length(term) < 3 OR term IN ({', '.join(repr(x) for x in FIXED)}) OR NOT @match(term, '^[a-z]+$') THEN term"])
_STOP = f"term IN ({', '.join(repr(x) for x in STOP_WORDS)})"
_LAST = f"CASE WHEN {_STOP} THEN NULL {_OWN} ELSE lower(w) END"


def with_stems(terms: DataFrame) -> DataFrame:
    """terms (with a column term, lower-cased words) with `stem`: null for stop words. Terms with other letters than a-z are their own stems."""
    spark_sql = lambda sql: F.expr(sql.replace("@match", "regexp_like").replace("@1", "$1"))
    out = terms.withColumn("w", F.col("term"))
    for name, sql in STEPS:
        out = out.withColumn(name, spark_sql(sql))
    return out.withColumn("stem", spark_sql(_LAST)).select(*terms.columns, "stem")


def stems_sql(source: str) -> str:
    """Common table expressions for DuckDB that end in `stems` (term, stem) of the terms of a source."""
    duck = lambda sql: sql.replace("@match", "regexp_matches").replace("@1", "\\1")
    parts, before, have = [f"stem_0 AS (SELECT DISTINCT term, term AS w FROM {source})"], "stem_0", ["w"]
    for i, (name, sql) in enumerate(STEPS, 1):
        kept = [c for c in have if c != name]
        parts.append(f"stem_{i} AS (SELECT term, {''.join(f'{c}, ' for c in kept)}{duck(sql)} AS {name} FROM {before})")
        before, have = f"stem_{i}", [*kept, name]
    return ", ".join([*parts, f"stems AS (SELECT term, {duck(_LAST)} AS stem FROM {before})"])
