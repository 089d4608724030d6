"""Secret scans with a trigram inverted index.

Each rule's regular expression is turned into a Boolean query on trigrams: the literal strings that a
match must contain, AND between places in the pattern, OR between alternatives. Per shard of
documents the index holds the rows of each trigram that some rule asks for; queries are answered by
intersecting and uniting these postings, and only the candidates are searched with the expression. A
rule without a mandatory trigram, such as a run of hex digits, searches every document.

A shard is a few megabytes of text inside one task, so postings are neither shuffled nor kept.

Defined cases: a null text is empty and has no spans; texts are never cut, a longer one is a shard of
its own; matches of one rule do not overlap (leftmost first), those of different rules may; repeated
rows are scanned each; an empty table gives an empty result. The result column `secrets` replaces an
input column of that name. Spans count code points, the end is exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from re import _constants as op
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.common import LOWER_BYTES, packed, unpacked

SHARD_BYTES = 4_000_000
MAX_STRINGS = 64  # alternatives that a place in a pattern may have before the query goes on without it


@dataclass(frozen=True)
class Rule:
    """`group` must have at least `least` characters; `ignore_case` holds for ASCII letters only."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    ignore_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


# The base kinds, in the order in which equal starts are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
        ignore_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]+", least=16),
)
# Public formats of credentials that the base kinds do not name.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("url", r"://[A-Za-z0-9_.-]+:[^\x20\x09-\x0D:@/]+@"),
)
RULES = BASE_RULES + MORE_RULES

# A trigram query: a clause is a set of alternatives, an alternative a set of trigrams that all must be
# there; every clause must hold. No clause means that any text may match.
Clause = frozenset[frozenset[str]]


def trigram_query(pattern: str) -> list[Clause]:
    """The Boolean trigram query of a regular expression, on text lower-cased in ASCII."""
    clauses: list[Clause] = []
    tail = _collect(_parser.parse(pattern), clauses)
    _close(tail, clauses)
    return clauses


def _close(strings: set[str], clauses: list[Clause]) -> None:
    if strings and all(len(s) >= 3 for s in strings):
        clauses.append(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def _collect(parsed, clauses: list[Clause]) -> set[str]:
    """Walk a sequence; closed-off strings go to `clauses`, the strings it must end with come back."""
    strings = {""}
    for item in parsed:
        choices = _exact([item])
        if choices is not None and len(strings) * len(choices) <= MAX_STRINGS:
            strings = {s + c for s in strings for c in choices}
            continue
        _close(strings, clauses)
        strings = {""}
        kind, value = item
        if kind is op.SUBPATTERN:
            strings = _collect(value[-1], clauses)
        elif kind is op.MAX_REPEAT and value[0] >= 1:
            _close(_collect(value[2], clauses), clauses)
    return strings


def _exact(parsed) -> set[str] | None:
    """All strings that a sequence can match, lower-cased, if they are few."""
    found = {""}
    for kind, value in parsed:
        if kind is op.LITERAL:
            choices = {_lower(chr(value))}
        elif kind is op.IN and all(inner is op.LITERAL for inner, _ in value):
            choices = {_lower(chr(code)) for _, code in value}
        elif kind is op.SUBPATTERN:
            choices = _exact(value[-1])
        elif kind is op.BRANCH:
            branches = [_exact(branch) for branch in value[1]]
            choices = None if None in branches else set().union(*branches)
        elif kind is op.MAX_REPEAT and value[1] <= 4:
            once = _exact(value[2])
            choices = None if once is None else _repeated(once, value[0], value[1])
        else:
            choices = None
        if choices is None or len(found) * len(choices) > MAX_STRINGS:
            return None
        found = {s + c for s in found for c in choices}
    return found


def _repeated(once: set[str], least: int, most: int) -> set[str] | None:
    """All repeats, or None if they are not few."""
    found, power = set(), {""}
    for count in range(most + 1):
        if count:
            power = {s + c for s in power for c in once}
        if len(power) > MAX_STRINGS:
            return None
        if count >= least:
            found |= power
    return found


def _lower(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").translate(LOWER_BYTES).decode("utf-8", "surrogatepass")


class TrigramIndex:
    """Rows by trigram, for the trigrams that the rules ask for."""

    def __init__(self, rules: Sequence[Rule]):
        self.queries = [trigram_query(rule.pattern) for rule in rules]
        wanted = sorted({t for query in self.queries for clause in query for some in clause for t in some})
        self.numbers = {t: i + 1 for i, t in enumerate(wanted)}
        self.table = np.zeros(1 << 24, np.uint16)
        for t, number in self.numbers.items():
            a, b, c = t.encode()  # patterns are ASCII
            self.table[a << 16 | b << 8 | c] = number

    def candidates(self, texts: list[bytes]) -> list[np.ndarray]:
        """Per rule the rows that may match."""
        # No trigram of a rule holds a zero byte, so none is found across two texts.
        flat = np.frombuffer(b"\0\0".join(texts).translate(LOWER_BYTES), np.uint8).astype(np.int32)
        starts = np.cumsum([0] + [len(text) + 2 for text in texts[:-1]])
        found = self.table[flat[:-2] << 16 | flat[1:-1] << 8 | flat[2:]] if len(flat) > 2 else self.table[:0]
        places = np.flatnonzero(found)
        rows = np.searchsorted(starts, places, side="right") - 1
        pairs = np.unique(found[places].astype(np.int64) * len(texts) + rows)
        numbers, rows = np.divmod(pairs, len(texts))
        ends = np.searchsorted(numbers, np.arange(len(self.numbers) + 2))
        postings = {t: rows[ends[n] : ends[n + 1]] for t, n in self.numbers.items()}
        return [self._answer(query, postings, len(texts)) for query in self.queries]

    def _answer(self, query: list[Clause], postings: dict[str, np.ndarray], rows: int) -> np.ndarray:
        holds = np.arange(rows)
        for clause in query:
            some = [np.empty(0, np.int64)]
            for alternative in clause:
                lists = sorted((postings[t] for t in alternative), key=len)
                common = lists[0]
                for other in lists[1:]:
                    common = np.intersect1d(common, other, assume_unique=True)
                some.append(common)
            holds = np.intersect1d(holds, np.unique(np.concatenate(some)), assume_unique=True)
        return holds


def _spans(rule: Rule, pattern: re.Pattern, text: str) -> list[tuple[int, int]]:
    return [m.span() for m in pattern.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def scan_texts(texts: list[str], rules: Sequence[Rule], index: TrigramIndex) -> list[list[tuple[str, int, int]]]:
    """Per text the spans (kind, start, end) by start, then kind as listed."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    encoded = [text.encode("utf-8", "surrogatepass") for text in texts]
    for number, (rule, rows) in enumerate(zip(rules, index.candidates(encoded), strict=True)):
        pattern = rule.compiled()
        for row in rows.tolist():
            found[row].extend((start, number, end) for start, end in _spans(rule, pattern, texts[row]))
    return [[(rules[number].kind, start, end) for start, number, end in sorted(spans)] for spans in found]


def _shards(texts: list[str]) -> Iterator[list[str]]:
    shard, held = [], 0
    for text in texts:
        if shard and held + len(text) > SHARD_BYTES:
            yield shard
            shard, held = [], 0
        shard.append(text)
        held += len(text)
    if shard:
        yield shard


SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
)
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(rules: Sequence[Rule]):
    """The last column is the text; the spans take its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TrigramIndex(rules)
        for batch in batches:
            texts = [text or "" for text in batch.column(batch.num_columns - 1).to_pylist()]
            spans = [found for shard in _shards(texts) for found in scan_texts(shard, rules, index)]
            rows = [[{"kind": k, "start": s, "end": e} for k, s, e in found] for found in spans]
            columns = [*batch.columns[:-1], pa.array(rows, _ARROW_SPANS)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "_spans"])

    return run


def scan_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, *, text_col: str = "text") -> DataFrame:
    """The documents with `secrets`, their spans as an array of (kind, start, end)."""
    wide = packed(docs, _text=F.col(f"`{text_col}`"))
    schema = T.StructType(wide.schema.fields[:1]).add("_spans", SPANS)
    return unpacked(wide.mapInArrow(_scan(rules), schema), docs.columns, {"secrets": F.col("_spans")})
