"""Secret scans: fixed patterns, and sliding-window Shannon entropy over candidate strings.

Base kinds, each leftmost and non-overlapping: `assign` (a keyword, a separator and a value of 12 or more characters),
`access` (an access-key id of 18 or more characters) and `hex` (16 or more lowercase hexadecimal digits).

Entropy kinds: a candidate is a run of the characters of base64 and its URL-safe form. Its class is the smallest that
holds all its characters: hexadecimal (`entropy_hex`), one case of letters with digits (`entropy_alnum`) or the whole
alphabet (`entropy_base64`). A window of the class's width slides along it; the character counts and the sum of
n*log2(n) change by one character in and one out, so a candidate costs its length whatever the width. Windows at or
above the class's threshold are joined to spans. The allow list then drops spans that are no secrets: with few changes
between letters, digits and case (words with a number, words written together), of a well-known form (UUID, chain of
words or numbers, ascending sequence, placeholder), or inside a URL path. A span within a base span is not reported again.

Offsets are code points, end exclusive. Defined cases: null is the empty text and has no spans; rows are scanned one by one, so ties and repeated
rows do not matter; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill.llm.common import documents, text_session, texts, tidy

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
#: Parts of the keywords of ASSIGN in lower case, one of which is in every match.
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
ASSIGN_VALUE = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 18
HEX_LENGTH = 16
#: A maximal run is long enough exactly if this matches it, so short runs (every a to f of prose) are no matches.
HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LENGTH)

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Kind: window width, least entropy in bits a character (fixed values).
CLASSES = {"entropy_hex": (20, 3.0), "entropy_alnum": (20, 3.5), "entropy_base64": (20, 3.8)}
#: The order of kinds among spans that start together.
KINDS = ("assign", "access", "hex", *CLASSES)
#: Letter-digit changes that a span must have in every 20 characters, or changes of any kind (a capital before small letters is none, so that
#: a word has one), which are more than words written together have.
LEAST_CHANGES = 3
LEAST_ALL_CHANGES = 6

HEX_ONLY = re.compile(r"[0-9a-fA-F]+\Z")
ALNUM_ONLY = re.compile(r"(?:[a-z0-9]+|[A-Z0-9]+)\Z")
CHANGES = re.compile(r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])")
ALL_CHANGES = re.compile(CHANGES.pattern + r"|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")
#: Chains of numbers (dates, versions) and of words with a number at the end; a span is allowed if it is one as a whole, padding aside.
CHAINS = [
    re.compile(r"[-_/]*\d+(?:[-_/]+\d+)*[-_/]*"),
    re.compile(r"[-_/=]*(?:[A-Za-z]+[-_/=]+)+[A-Za-z]*\d{0,6}"),
]
#: What is left of a span without UUIDs and without the parts between separators that hold a placeholder or an ascending sequence is judged alone.
KNOWN = re.compile(r"(?<![0-9A-Za-z])[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}(?![0-9A-Za-z])|(?i:your[-_][a-z]*)")
#: What says where a span stands in a URL, and what ends a URL's user name and password.
MARKS = re.compile(r"""://|[/:?#]|[ \n\t"'<>]""")
USER_END = re.compile(r"""[\s"'<>?#@]""")
PART = re.compile(r"[A-Za-z0-9]+")
PLACEHOLDER = re.compile(r"(?i)example|placeholder|sample|dummy|changeme|x{6}|0123456789|abcdefgh")

_N_LOG_N = [0.0, *(n * math.log2(n) for n in range(1, 4096))]


def candidate_class(candidate: str) -> str:
    if HEX_ONLY.match(candidate):
        return "entropy_hex"
    return "entropy_alnum" if ALNUM_ONLY.match(candidate) else "entropy_base64"


def dense_spans(candidate: str, width: int, least: float) -> list[tuple[int, int]]:
    """The joined windows whose entropy is at least `least` bits a character; a shorter candidate is one window."""
    width = min(width, len(candidate))
    counts: dict[str, int] = {}
    total = 0.0  # the sum of n * log2(n) over the counts in the window
    spans: list[tuple[int, int]] = []
    bound = (math.log2(width) - least) * width + 1e-9  # entropy = log2(width) - total / width
    for i, c in enumerate(candidate):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += _N_LOG_N[n + 1] - _N_LOG_N[n]
        if i >= width:
            old = candidate[i - width]
            n = counts[old]
            counts[old] = n - 1
            total += _N_LOG_N[n - 1] - _N_LOG_N[n]
        start = i - width + 1
        if start >= 0 and total <= bound:
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


class Place:
    """What leads to a position of a text since the last blank, quote or angle bracket; positions ascend, so a text is read once."""

    def __init__(self, text: str):
        self.text, self.at, self.start = text, 0, 0
        self.scheme = self.query = self.slash = self.colon = False
        self.stop, self.user = -1, False

    def go(self, to: int) -> None:
        text, at = self.text, self.at
        for s in (at - 2, at - 1):  # a mark that was cut
            if s >= self.start and s + 3 <= to and text.startswith("://", s):
                self._mark("://")
                at = s + 3
                break
        for m in MARKS.finditer(text, at, to):
            if m[0] in " \n\t\"'<>":
                self.start = m.end()
                self.scheme = self.query = self.slash = self.colon = False
            else:
                self._mark(m[0])
        self.at = to

    def _mark(self, mark: str) -> None:
        if mark == "://":
            self.scheme, self.slash, self.colon = True, False, False  # of a URL within a URL's path: the last counts
        elif self.scheme:
            self.query |= mark in "?#"
            self.slash |= mark == "/"
            self.colon |= mark == ":"

    def user_ends(self, at: int) -> bool:
        """Whether what follows is still user name or password."""
        if self.stop < at:
            m = USER_END.search(self.text, at)
            self.stop, self.user = (m.start(), m[0] == "@") if m else (len(self.text), False)
        return self.user

    def in_url_path(self, found: str, end: int) -> bool:
        """Whether the span found, which ends at `end`, belongs to the path of a URL: not to its query, fragment or user and password."""
        if not self.scheme or self.query:
            return False
        # While the host has not ended: a password can hold an unescaped slash, a user name is taken to hold none.
        return self.slash or ("/" in found and not self.colon) or not self.user_ends(end)


def allowed(found: str, before: str, after: str = "") -> bool:
    """Whether the allow list names this span. before and after: the text that leads to it and that follows it."""
    place = Place(before + found + after)
    place.go(len(before))
    return listed(found, place, len(before) + len(found))


def listed(found: str, place: Place, end: int) -> bool:
    """Whether the allow list names the span found, which begins at place and ends at `end`."""
    if len(CHANGES.findall(found)) * 20 < LEAST_CHANGES * len(found) and len(ALL_CHANGES.findall(found)) * 20 < LEAST_ALL_CHANGES * len(found):
        return True
    if any(p.fullmatch(found.rstrip("=")) for p in CHAINS):
        return True
    rest = PART.sub(lambda m: "" if PLACEHOLDER.search(m[0]) else m[0], KNOWN.sub("", found))
    if rest != found and not any(not listed(m[0][a:b], place, end) for m in CANDIDATE.finditer(rest) for a, b in dense_spans(m[0], *CLASSES[candidate_class(m[0])])):
        return True
    return place.in_url_path(found, end)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of the base kinds."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    found.sort()
    return found


def entropy_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """base: in order. Spans and base spans are walked through together, and the text that leads to spans is read once, so the work is linear."""
    found = []
    place, k, reach = Place(text), 0, 0  # reach: how far the base spans go that start before a span does
    for m in CANDIDATE.finditer(text):
        candidate, at = m[0], m.start()
        if candidate.isalpha() and (candidate.isupper() or candidate[1:].islower()):  # the allow list drops spans without changes
            continue
        kind = candidate_class(candidate)
        for a, b in dense_spans(candidate, *CLASSES[kind]):
            while k < len(base) and base[k][0] <= at + a:
                reach = max(reach, base[k][2])
                k += 1
            if at + b <= reach:
                continue
            place.go(at + a)
            if not listed(candidate[a:b], place, at + b):
                found.append((at + a, KINDS.index(kind), at + b))
    return found


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans in order."""
    base = base_spans(text)
    return base, sorted(base + entropy_spans(text, base))


def named(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str, spans) -> str:
    """The text with every span, or overlapping spans together, replaced by a mark."""
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], "[SECRET]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


@tidy
def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in texts(batch):
            base, every = scan(text)
            kinds = [k for _, k, _ in base]
            rows.append((kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(named(base).encode()).hexdigest(), named(every)))
        columns = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), *(pa.array(c, pa.string()) for c in columns[3:])], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def secret_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row."""
    text_session(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_scanned, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


@tidy
def _redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        out = [t if t is None else redact(t, scan(t)[1]) for t in batch.column(at).to_pylist()]
        yield batch.set_column(at, "text", pa.array(out, batch.schema.field(at).type))


def redact_secrets(docs: DataFrame) -> DataFrame:
    """docs with secrets replaced in text (null stays null), and n_chars, where there is such a column, counted anew for changed texts."""
    text_session(docs.sparkSession)
    out = docs.mapInArrow(_redacted, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").contains("[SECRET]"), F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out


def op5_secret_scan(spark, sf_dir: str) -> DataFrame:
    return secret_spans(documents(spark, sf_dir))
