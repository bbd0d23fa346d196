"""Secret scan with a trigram index.

Every rule's pattern is turned into a Boolean trigram query: a condition on trigrams that any text with a match
must fulfil. Each task indexes its documents segment by segment: posting lists of document numbers for the
trigrams that the rules ask for. The queries intersect and unite postings, and only the candidates are searched
with the pattern. A rule whose pattern has no mandatory trigram scans all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.llm.textkit import LOWER, byte_slices, raw_texts, with_fields


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern``, leftmost and non-overlapping, whose ``group`` is long enough."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0


BASE = (
    Rule("assign", r"""(?a:(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}"),  # the runs of [0-9a-f]+ that have 24 characters or more
)
MORE = (
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("bearer", r"Bearer [A-Za-z0-9._~+/-]{16,}=*"),
    Rule("repo_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
ALL = BASE + MORE

# A query is True (no condition), a trigram, or ("and" | "or", queries).
Query = object
MOST_STRINGS = 64


def _both(op: str, queries: list) -> Query:
    flat = []
    for q in queries:
        if q is True:
            if op == "or":
                return True
            continue
        flat.extend(q[1] if isinstance(q, tuple) and q[0] == op else [q])
    flat = list(dict.fromkeys(flat))
    if not flat:
        return True
    return flat[0] if len(flat) == 1 else (op, tuple(flat))


def _of_string(text: str) -> Query:
    raw = text.encode()
    return _both("and", [raw[i : i + 3] for i in range(len(raw) - 2)])


def _of_strings(strings: set[str]) -> Query:
    return _both("or", [_of_string(s) for s in sorted(strings)])


def _exact(op, arg) -> set[str] | None:
    """The strings, in lower case, that a piece of a pattern can match, if they are few."""
    if op is sre.LITERAL:
        return {chr(arg).lower()} if chr(arg).isascii() else None
    if op is sre.IN:
        out = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                out.add(chr(value))
            elif kind is sre.RANGE and value[1] - value[0] < 4:
                out.update(map(chr, range(value[0], value[1] + 1)))
            else:
                return None
        return {c.lower() for c in out} if all(c.isascii() for c in out) else None
    return None


def _analyse(tokens) -> tuple[set[str] | None, Query]:
    """Of a sequence: all its strings if they are few, and its query."""
    queries: list = []
    run: set[str] | None = {""}
    whole = True

    def cut() -> None:
        nonlocal run
        queries.append(_of_strings(run))
        run = {""}

    for op, arg in tokens:
        strings, query = _exact(op, arg), True
        if op is sre.SUBPATTERN:
            strings, query = _analyse(arg[3])
        elif op is sre.BRANCH:
            parts = [_analyse(b) for b in arg[1]]
            strings = set().union(*(p[0] for p in parts)) if all(p[0] is not None for p in parts) else None
            query = _both("or", [p[1] for p in parts])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, inner = arg
            inner_strings, inner_query = _analyse(inner)
            if (least, most) == (0, 1) and inner_strings is not None:
                strings = inner_strings | {""}
            elif least >= 1:
                query = inner_query
        elif op is sre.AT:
            strings = {""}
        if strings is not None and len(strings) * len(run) <= MOST_STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        cut()
        whole = False
        if strings is not None and len(strings) <= MOST_STRINGS:
            run = set(strings)
        else:
            queries.append(query)
    strings = run if whole else None
    cut()
    return strings, _both("and", queries)


def trigram_query(pattern: str) -> Query:
    """The condition on lower-case byte trigrams that every text with a match fulfils."""
    return _analyse(sre_parser.parse(pattern))[1]


def _trigrams(query: Query) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(_trigrams, query[1]))


class Index:
    """Posting lists of one segment: for each trigram asked for, the numbers of the documents that hold it."""

    def __init__(self, column: pa.Array, table: np.ndarray, names: list[bytes]):
        raw, offsets = raw_texts(column)
        data = LOWER[raw].astype(np.int32)
        self.size = len(column)
        codes = data[:-2] << 16 | data[1:-1] << 8 | data[2:] if len(data) > 2 else np.zeros(0, np.int32)
        which = table[codes]
        at = np.flatnonzero(which)
        doc = np.searchsorted(offsets, at, "right") - 1
        inside = at + 3 <= offsets[doc + 1]
        pairs = np.unique(which[at[inside]].astype(np.int64) * (self.size + 1) + doc[inside])
        number, doc = np.divmod(pairs, self.size + 1)
        bounds = np.searchsorted(number, np.arange(1, len(names) + 2))
        self.postings = {name: doc[bounds[i] : bounds[i + 1]] for i, name in enumerate(names)}

    def find(self, query: Query) -> np.ndarray:
        if query is True:
            return np.arange(self.size)
        if isinstance(query, bytes):
            return self.postings[query]
        op, found = query[0], [self.find(q) for q in query[1]]
        result = found[0]
        for other in found[1:]:
            result = np.intersect1d(result, other, assume_unique=True) if op == "and" else np.union1d(result, other)
        return result


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = ALL, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id, spans``, an array of ``(kind, start, end)`` in code points, end exclusive.

    Spans are ordered by start, then by the order of ``rules``. Null and empty texts have none; an empty table
    gives no rows; repeated rows are searched alike. Rows keep no other column, whatever its name.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    names = sorted(set().union(*map(_trigrams, queries.values())))
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    schema = with_fields(rows.select("id"), "spans array<struct<kind:string,start:int,end:int>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << 24, dtype=np.uint16)
        for i, name in enumerate(names, 1):
            table[int.from_bytes(name, "big")] = i
        patterns = [(order, rule, re.compile(rule.pattern)) for order, rule in enumerate(rules)]
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                index = Index(batch.column("text"), table, names)
                found: list[list] = [[] for _ in range(batch.num_rows)]
                texts = [t or "" for t in batch.column("text").to_pylist()]
                for order, rule, pattern in patterns:
                    for i in index.find(queries[rule.kind]).tolist():
                        for match in pattern.finditer(texts[i]):
                            if match.end(rule.group) - match.start(rule.group) >= rule.least:
                                found[i].append((match.start(), order, rule.kind, match.end()))
                spans = [[{"kind": k, "start": s, "end": e} for s, _, k, e in sorted(f)] for f in found]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, pa.list_(span))], ["id", "spans"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id)
