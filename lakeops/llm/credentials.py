"""Secrets in texts: fixed patterns, and the guess cost of values in credential context.

The base patterns find assignments, access ids and long hex strings.  The method
looks at every value that follows a credential word and computes what a guesser
would pay for it: dynamic programming over the value finds the cheapest way to
cut it into known words, dates, repeats, keyboard walks, runs of the alphabet and
brute-force stretches.  A brute-force character costs what the alphabet of the whole
value asks for, so eight mixed characters are dear, while words of one case, also
joined by marks, cost one case.  A value whose cheapest cost is ``LIMIT`` powers of
ten or more is reported; a value that is easy to guess, such as an ordinary word of
eight letters, isn't.

Defined results: a null text is empty and has no spans; spans of different kinds
may overlap and are all reported, but a value that a base assignment covers
to its end is not reported again; repeated rows are treated alike; other columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 11.45  # above eight letters of one case, or seven and a mark; below eight mixed characters
SEGMENT = math.log10(3)  # what a further segment costs
BASE_KINDS = ("assign", "access", "hex")

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")

CONTEXT = re.compile(
    r"""(?:(?:passwords?|passwd|passphrase|passcode|pwd|secrets?|tokens?|api[_-]?keys?|access[_-]?keys?|private[_-]?keys?"""
    r"""|authorization|credentials?)["']?(?:[\x20\t]*+(?::=|=>|[:=])[\x20\t]*+|[\x20\t]++is[\x20\t]++)(?:bearer[\x20\t]++)?["'`]?"""
    r"""|\bbearer[\x20\t]++)"""
    r"""([^\s"'`,;<>()\[\]{}|]{8,})""",
    re.A | re.I,
)
HINTS = ("pass", "pwd", "secret", "token", "key", "auth", "bearer", "credential")

# Common words of passwords, most frequent first; the place is the guess.
COMMON = (
    "password pass admin welcome login master dragon monkey shadow sunshine princess football baseball superman batman "
    "letmein iloveyou hello secret token test demo example changeme change default root user guest system server public "
    "private access account api key client service data base database cloud prod production dev stage local host mail "
    "email web site home work office money love summer winter spring autumn monday friday sunday january march april may "
    "june july august october december orange apple banana cookie coffee pepper ginger tiger eagle falcon wolf horse "
    "chicken killer hunter ranger soccer hockey tennis guitar music star trek wars matrix phoenix diamond silver golden "
    "black white blue green red purple michael jordan daniel thomas robert charlie jessica ashley michelle andrew joshua "
    "matthew george maggie buster tigger freedom whatever trust secure security internet computer windows google"
).split()
RANK = {word: math.log10(i + 2) for i, word in enumerate(COMMON)}
LONGEST = max(map(len, COMMON))
LEET = str.maketrans("4@310$57", "aaeiosst")
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
BESIDE = {a: set() for row in ROWS for a in row}
for _r, _row in enumerate(ROWS):
    for _i, _a in enumerate(_row):
        for _near in (_row[_i - 1 : _i], _row[_i + 1 : _i + 2], *(ROWS[_r + 1][_i - 1 : _i + 1] if _r < 3 else "")):
            if _near:
                BESIDE[_a].add(_near)
                BESIDE[_near].add(_a)
DATE = re.compile(r"(?:19|20)[0-9]{2}(?:([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12][0-9]|3[01]))?|(?:0[1-9]|[12][0-9]|3[01])([-/.]?)(?:0[1-9]|1[0-2])\2(?:19|20)[0-9]{2}")


def brute_cost(c: str) -> float:
    if c.isdigit():
        return 1.0
    return math.log10(26) if c.isalpha() else math.log10(33)


WORDS = re.compile(r"[A-Z]?(?:[a-z]+|[A-Z]+)(?:[-_./:](?:[A-Z]?[a-z]+|[A-Z]+))*[.!?:]*")


def alphabet_cost(value: str) -> Callable[[str], float]:
    """The cost of a brute-force character by the alphabet that the value draws from."""
    if WORDS.fullmatch(value):
        return brute_cost
    core = value.rstrip(".!?:")
    marks = any(not c.isalpha() and not c.isdigit() for c in core)
    size = 26 * any(map(str.islower, core)) + 26 * any(map(str.isupper, core)) + 10 * any(map(str.isdigit, core)) + 33 * marks
    least = math.log10(max(size, 1))
    return lambda c: max(brute_cost(c), least)


def _run_ends(value: str, joined) -> list[int]:
    """For each place, the end of the longest run from it in which ``joined(i)`` holds for every i after the first."""
    ends = [0] * len(value)
    end = len(value)
    for i in range(len(value) - 1, -1, -1):
        if i + 1 < len(value) and not joined(i + 1):
            end = i + 1
        ends[i] = end
    return ends


def segments(value: str, price: Callable[[str], float] = brute_cost) -> Iterator[tuple[int, int, float]]:
    """``(start, end, cost)`` of every stretch that a guesser has a shorter way to than brute force.

    Costs are powers of ten.  Runs of one kind are given whole and in all shorter
    lengths from three characters up to 24; a longer stretch is reached through more runs.
    """
    low = value.lower()
    plain = low.translate(LEET)
    n = len(value)
    for i in range(n):
        for j in range(i + 3, min(n, i + LONGEST) + 1):
            rank = RANK.get(low[i:j])
            leet = rank is None
            if leet:
                rank = RANK.get(plain[i:j])
            if rank is not None:
                part = value[i:j]
                cased = part != part.lower()
                yield i, j, rank + (math.log10(2) if cased else 0.0) + (math.log10(4) if leet else 0.0)
    for i in range(n):
        for match in (DATE.match(value, i),):
            if match:
                years = math.log10(120)
                yield i, match.end(), years if match.end() - i == 4 else years + math.log10(365) + math.log10(4)
                if match.end() - i > 4 and value[i : i + 2] in ("19", "20"):
                    yield i, i + 4, years
    kinds = (
        (lambda i: low[i] in BESIDE.get(low[i - 1], ()), lambda k: math.log10(47) + math.log10(k) + 0.3 * (k - 1)),
        (lambda i: ord(low[i]) - ord(low[i - 1]) == 1, lambda k: math.log10(36) + math.log10(k)),
        (lambda i: ord(low[i]) - ord(low[i - 1]) == -1, lambda k: math.log10(36) + math.log10(2 * k)),
    )
    for joined, cost in kinds:
        ends = _run_ends(value, joined)
        for i in range(n):
            for j in range(i + 3, min(ends[i], i + 24) + 1):
                yield i, j, cost(j - i)
    for width in range(1, min(16, n // 2) + 1):
        same = [False] * n
        for i in range(width, n):
            same[i] = value[i] == value[i - width]
        i = width
        while i < n:
            if not same[i]:
                i += 1
                continue
            stop = i
            while stop < n and same[stop]:
                stop += 1
            times = (stop - i) // width + 1
            start = i - width
            if times >= 2 and times * width >= 3:
                block = sum(map(price, value[start : start + width]))
                for k in {2, times} if width > 1 else {3, times}:
                    if k <= times:
                        yield start, start + k * width, block + math.log10(k)
            i = stop


def guess_cost(value: str, price: Callable[[str], float] = brute_cost) -> float:
    """Powers of ten of the cheapest cut of the value; ``price`` is that of a brute-force character."""
    by_end: dict[int, list[tuple[int, float]]] = {}
    for start, end, cost in segments(value, price):
        by_end.setdefault(end, []).append((start, cost))
    # two states: the last segment is brute force (it can grow for the price of a character), or it isn't
    best, brute = [0.0] + [math.inf] * len(value), [math.inf] * (len(value) + 1)
    for end in range(1, len(value) + 1):
        char = price(value[end - 1])
        enter = best[end - 1] + char + (SEGMENT if end > 1 else 0.0)
        brute[end] = min(brute[end - 1] + char, enter)
        best[end] = min(
            [brute[end], *(best[s] + cost + (SEGMENT if s else 0.0) for s, cost in by_end.get(end, ()))]
        )
    return best[-1]


def secret_spans(text: str, limit: float = LIMIT) -> list[tuple[int, int, str, int]]:
    """``(start, rank, kind, end)`` in order of start, then kind as listed."""
    out = []
    low = text.lower()
    covered = {}  # start of a value in a base assignment -> its end
    if any(hint in low for hint in HINTS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 8:
                out.append((m.start(), 0, "assign", m.end()))
                covered[m.start(2)] = m.end(2)
        for m in CONTEXT.finditer(text):
            if covered.get(m.start(1), -1) < m.end(1) and guess_cost(m[1], alphabet_cost(m[1])) >= limit:
                out.append((m.start(1), 3, "credential", m.end(1)))
    if "AKIA" in text:
        out += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def joined(spans: list[tuple[int, int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = LIMIT
) -> DataFrame:
    """``doc_id`` and ``found``, the array of ``(kind, start, end)`` of every row."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            found = [
                [{"kind": k, "start": s, "end": e} for s, _, k, e in secret_spans(t or "", limit)]
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "found"])

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(find, f"doc_id {kind}, found array<struct<kind:string,start:bigint,end:bigint>>")


def secret_report(docs: DataFrame, **options) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""

    def count(kind: str):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def text(spans):
        each = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
        return F.array_join(each, ",")

    base = F.filter("found", lambda x: x["kind"].isin(*BASE_KINDS))
    return find_secrets(docs, **options).select(
        "doc_id", *(count(k) for k in BASE_KINDS), F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("found")).alias("spans"),
    )
