"""Secrets in texts: fixed patterns, and values in credential contexts that are hard to guess.

How hard a value is to guess is estimated by dynamic programming over its positions: the cheapest way to cut it
into dictionary words, dates, repeats of characters and of blocks, keyboard walks and brute-force spans, in powers of
ten of guesses. The dictionary is a fixed list, a public vocabulary in order of rank, and the words found in most documents
(one aggregation of words, ``learned``). The scan itself is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kinweave.llm.common import by_batch
from kinweave.session import cut, discarded

KINDS = ("assign", "access", "hex", "guess")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
# A run of the class is matched whole, so the least length can stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_MIN = 6

#: Names before a value that make it a credential; the value runs to white space, a quote or a bracket.
CONTEXT = re.compile(
    r"""(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|bearer|credentials?|login"""
    r"""|api[_-]?key|auth(?:[_-]?(?:key|token))?|(?:access|private|client|signing|encryption)[_-]?(?:key|secret|token))"""
    r"""["']?[\x20\t]{0,3}(?::=|=>|[:=])[\x20\t]{0,3}["']?([^\s"'<>(){}\[\],;]{6,})""",
    re.IGNORECASE | re.ASCII,
)
_CONTEXT_HINTS = ("pass", "pwd", "pin", "secret", "token", "bearer", "credential", "login", "key", "auth")
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "api")

# Words often found in passwords, commonest first.
WORDS = (
    "password qwerty dragon monkey letmein football baseball welcome master sunshine shadow princess login admin "
    "iloveyou superman batman trustno hello freedom whatever ninja mustang access michael jordan hunter soccer "
    "starwars summer winter spring autumn flower secret user guest test root default change changeme example sample "
    "dummy placeholder your here none null true false token value string pass word love angel money lucky happy "
    "computer internet server system service account public private client demo local host database google orange "
    "apple banana cookie pepper ginger silver golden purple yellow green black white tiger eagle falcon charlie "
    "daniel thomas robert jessica jennifer ashley london paris berlin madrid the and for with this that from "
    "foo bar baz qux lorem ipsum"
).split()
_RANK = {w: i + 1 for i, w in enumerate(WORDS)}
#: Letters of the longest dictionary word.
_LONGEST = 24
#: Words learned from the documents, and the documents that have to hold one.
LEARNED, LEAST_DOCS = 20_000, 5
#: Characters of the longest block whose repeats are seen.
BLOCK = 64
_LEET = str.maketrans("@4031!$57", "aaoeiisst")

_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_PLACE = {c: (x + 0.5 * y, y) for y, row in enumerate(_ROWS) for x, c in enumerate(row)}
_DATES = (
    re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"),
    re.compile(r"(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\1(?:19|20)\d\d"),
    re.compile(r"(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\1\d\d"),
    re.compile(r"(?:0[1-9]|1[0-2])([-/._]?)(?:0[1-9]|[12]\d|3[01])\1(?:19|20)\d\d"),
    re.compile(r"(?:0[1-9]|1[0-2])([-/._]?)(?:0[1-9]|[12]\d|3[01])\1\d\d"),
    re.compile(r"(?:19|20)\d\d"),
)

#: Values of at least this many powers of ten of guesses are reported.
THRESHOLD = 8.0


def _class_size(c: str) -> int:
    if c.isascii():
        return 10 if c.isdigit() else 26 if c.isalpha() else 33
    return 100


def _neighbours(a: str, b: str) -> bool:
    if a not in _PLACE or b not in _PLACE:
        return False
    (x, y), (u, v) = _PLACE[a], _PLACE[b]
    return (a != b and abs(x - u) <= 1 and abs(y - v) <= 1) or False


def vocabulary(path: str) -> list[str]:
    """The words of a public byte-pair vocabulary in order of rank: its tokens of a blank and at least three letters."""
    words = {}
    with open(path, "rb") as lines:
        for line in lines:
            token = base64.b64decode(line.split()[0])
            if re.fullmatch(rb" [A-Za-z]{3,24}", token):
                words[token[1:].lower().decode()] = None
    return list(words)


def learned(docs: DataFrame, text_col: str = "text", size: int = LEARNED, least_docs: int = LEAST_DOCS) -> list[str]:
    """The ``size`` words, of three to 24 letters, that most documents hold, ties in text order; words of fewer than
    ``least_docs`` documents are none.

    What follows a name that makes it a credential is left out, so a secret does not become a word by being copied. Every
    text is read whole, and only the counted words, ``size`` at most, reach the driver.
    """
    low = F.lower(F.col(text_col).cast("string"))
    for pattern in (CONTEXT, ASSIGN):
        low = F.regexp_replace(low, pattern.pattern, " ")
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(low, F.lit(r"(\p{L}{3,})"), 1))).alias("word"))
    counted = words.where(F.length("word") <= _LONGEST).groupBy("word").agg(F.count(F.lit(1)).alias("docs"))
    with discarded(docs.sparkSession):
        # Every partition sends its best ``size`` words, so there are a few, whatever the input.
        common = cut(counted.where(F.col("docs") >= least_docs), "common-words").coalesce(8)
        return [r.word for r in common.orderBy(F.desc("docs"), "word").limit(size).collect()]


def ranked(*lists: Iterable[str]) -> dict[str, int]:
    """The best rank of each word in the fixed list and the given ones."""
    ranks = dict(_RANK)
    for words in lists:
        for i, word in enumerate(words, 1):
            if i < ranks.get(word, i + 1):
                ranks[word] = i
    return ranks


class _Run:
    """The places in a run where its last segment, of ``least`` units or more, can still begin at least cost."""

    def __init__(self, least: int = 3, unit: int = 1):
        self.least, self.unit = least, unit
        self.starts: list[int] = []

    def cheapest(self, best: list[float], end: int, run: int, choices: float) -> float:
        """The cost up to ``end`` if a segment of the ``run`` characters before it is the last; called for every end of a
        run, a unit apart.

        A later start that costs no more replaces earlier ones. As segments grow the advantage of a later start
        shrinks, so one that is behind an earlier start stays behind.
        """
        starts, shortest = self.starts, self.least * self.unit
        if run < shortest:
            starts.clear()
            return math.inf
        if run < shortest + self.unit:
            starts.clear()
        while starts and best[starts[-1]] >= best[end - shortest]:
            starts.pop()
        starts.append(end - shortest)
        costs = [best[start] + math.log10(choices * (end - start) / self.unit) for start in starts]
        least = min(costs)
        del starts[costs.index(least) + 1 :]
        return least


class _Blocks:
    """Segments of a value that repeat a block of 2 to ``BLOCK`` characters at least twice.

    They cost what the block costs, times their number of blocks. A block that itself repeats a smaller one is left to that.
    """

    def __init__(self, value: str, ranks: dict[str, int]):
        self.value, self.ranks = value, ranks
        #: How many of the last characters equal those so many places before them.
        self.same = [0] * (min(BLOCK, len(value) // 2) + 1)
        self.costs: dict[str, float] = {}
        self.runs: dict[tuple[int, int], _Run] = {}

    def cheapest(self, best: list[float], end: int) -> float:
        value, same, least = self.value, self.same, math.inf
        for size in range(1, min(len(same), end)):
            same[size] = same[size] + 1 if value[end - 1] == value[end - 1 - size] else 0
            if size < 2 or same[size] < size or any(size % d == 0 and same[d] >= size for d in range(1, size // 2 + 1)):
                continue
            block = value[end - size : end]
            if block not in self.costs:
                self.costs[block] = guess_cost(block, self.ranks)
            run = self.runs.setdefault((size, end % size), _Run(2, size))
            least = min(least, run.cheapest(best, end, same[size] + size, 1) + self.costs[block])
        return least


def guess_cost(value: str, ranks: dict[str, int] = _RANK) -> float:
    """Powers of ten of guesses of the cheapest segmentation of ``value``; 0 for an empty one."""
    n = len(value)
    if not n:
        return 0.0
    low = value.lower() if len(value.lower()) == n else value
    plain = low.translate(_LEET)
    best = [0.0] + [math.inf] * n
    # Runs that end where the next character breaks them: equal characters, and walks on the keyboard.
    same, walk = [1] * n, [1] * n
    for i in range(1, n):
        same[i] = same[i - 1] + 1 if value[i] == value[i - 1] else 1
        walk[i] = walk[i - 1] + 1 if _neighbours(low[i - 1], low[i]) or ord(low[i]) - ord(low[i - 1]) in (1, -1) else 1
    dates: dict[int, set[int]] = {}
    for pattern in _DATES:
        for i in range(n):
            if value[i].isdigit() and (m := pattern.match(value, i)):
                dates.setdefault(m.end(), set()).add(i)
    repeats, walks, blocks = _Run(), _Run(), _Blocks(value, ranks)
    for end in range(1, n + 1):
        c = value[end - 1]
        least = best[end - 1] + math.log10(_class_size(c))
        for size in range(2, min(_LONGEST, end) + 1):
            start = end - size
            as_written = ranks.get(low[start:end])
            rank = as_written or ranks.get(plain[start:end])
            if rank:
                upper = sum(x.isupper() for x in value[start:end])
                odd = 0 if as_written else sum(a != b for a, b in zip(plain[start:end], low[start:end]))
                variants = 1 if upper in (0, size) or (upper == 1 and value[start].isupper()) else math.comb(size, min(upper, size - upper))
                least = min(least, best[start] + math.log10(rank + 1) + math.log10(1 + variants) + 0.3 * odd)
        for start in dates.get(end, ()):
            least = min(least, best[start] + math.log10(366 * 120 if end - start > 4 else 120) + 0.3)
        least = min(least, repeats.cheapest(best, end, same[end - 1], _class_size(c)))
        least = min(least, walks.cheapest(best, end, walk[end - 1], 47) + 0.6)
        best[end] = min(least, blocks.cheapest(best, end))
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the fixed patterns: leftmost matches that do not overlap, per kind."""
    spans = []
    low = text.lower()
    if any(h in low for h in _ASSIGN_HINTS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_MIN]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def guess_spans(text: str, threshold: float = THRESHOLD, ranks: dict[str, int] = _RANK) -> list[tuple[int, int, str]]:
    """Spans of values in credential contexts that take at least ``10 ** threshold`` guesses."""
    low = text.lower()
    if not any(h in low for h in _CONTEXT_HINTS):
        return []
    spans = []
    for m in CONTEXT.finditer(text):
        value = m.group(1).rstrip(".!?:")
        if len(value) >= ASSIGN_MIN and guess_cost(value, ranks) >= threshold:
            spans.append((m.start(1), m.start(1) + len(value), "guess"))
    return spans


def find(text: str, threshold: float = THRESHOLD, ranks: dict[str, int] = _RANK) -> tuple[list, list]:
    """The base spans of a text, and all its spans, by start and kind."""
    base = base_spans(text)
    return base, sorted(base + guess_spans(text, threshold, ranks), key=lambda s: (s[0], KINDS.index(s[2])))


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redact(text: str, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str:
    """The text with every span, overlapping ones as one, replaced by ``mark``."""
    out, at, shown = [], 0, 0
    for start, end, _ in sorted(spans):
        if start >= at:
            out += [text[shown:start], mark]
        at = shown = max(at, end)
    return "".join([*out, text[shown:]])


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, ranks: dict[str, int] = _RANK
) -> DataFrame:
    """One row per document with its spans: ``(id, n_assign, n_access, n_hex, base_sha256, spans, n_guess)``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind, joined by commas;
    ``base_sha256`` is over the same writing of the fixed patterns alone. A null text counts as empty. ``ranks`` are the
    dictionary's, see ``ranked``; it goes with the tasks.
    """

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [find(t or "", threshold, ranks) for t in batch.column(1).to_pylist()]
            count = lambda kind: pa.array([sum(s[2] == kind for s in spans) for _, spans in rows], pa.int64())
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0), count("assign"), count("access"), count("hex"),
                    pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b, _ in rows]),
                    pa.array([written(s) for _, s in rows]), count("guess"),
                ],
                names=[id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess"],
            )

        return run

    kind = docs.schema[id_col].dataType.simpleString()
    return by_batch(
        docs.select(F.col(id_col), F.col(text_col).cast("string")), make,
        f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long",
    )


def redacted(
    docs: DataFrame, text_col: str = "text", length_col: str = "n_chars", threshold: float = THRESHOLD, ranks: dict[str, int] = _RANK
) -> DataFrame:
    """The same rows and columns with secrets replaced in the text, and its length, if there is one, set anew.

    Texts without secrets, null ones too, stay as they are.
    """
    at = docs.columns.index(text_col)
    length = docs.columns.index(length_col) if length_col in docs.columns else None

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns, texts = list(batch.columns), batch.column(at).to_pylist()
            lengths = None if length is None else columns[length].to_pylist()
            for i, text in enumerate(texts):
                if text and (spans := find(text, threshold, ranks)[1]):
                    texts[i] = redact(text, spans)
                    if lengths is not None:
                        lengths[i] = len(texts[i])
            columns[at] = pa.array(texts, columns[at].type)
            if lengths is not None:
                columns[length] = pa.array(lengths, columns[length].type)
            return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

        return run

    return by_batch(docs, make, docs.schema)
