"""Secret scan behind a trigram inverted index.

Every rule's regular expression is turned into a Boolean query over the trigrams a match must contain. Each batch of
documents is indexed once (trigram → documents of the batch, restricted to trigrams some rule asks for), a rule's
postings are intersected and united as its query says, and only the remaining documents are searched with the
expression itself. A rule without a mandatory trigram searches every document.

The index is local to a batch of documents, so nothing is shuffled, a lost task is simply run again, and memory is
bounded by the batch. Offsets are code points, ends exclusive.

Null and empty texts hold no secrets. Equal rows give equal results. Texts are searched whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import product
from re import _constants as op, _parser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from flowledger.llm.common import chunks

# A query is True (every document), a trigram (int), or ("and" | "or", parts).
MAX_STRINGS = 64


def _trigrams(text: bytes) -> list[int]:
    return [text[i] << 16 | text[i + 1] << 8 | text[i + 2] for i in range(len(text) - 2)]


def _all_of(parts):
    parts = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any_of(parts):
    parts = list(dict.fromkeys(parts))
    return True if True in parts or not parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _from_strings(strings) -> object:
    """Documents that contain one of these strings; a string below three bytes asks for nothing."""
    return _any_of([_all_of(_trigrams(s)) for s in sorted(strings)])


def _folded(code: int) -> bytes:
    return chr(code).encode().lower()


def _strings_of(node) -> set[bytes] | None:
    """All strings (ASCII-lower-case UTF-8) a node can match, or None if they are too many to list."""
    kind, value = node
    if kind is op.LITERAL:
        return {_folded(value)}
    if kind is op.IN and value[0][0] is not op.NEGATE and all(k in (op.LITERAL, op.RANGE) for k, _ in value):
        codes = [c for k, v in value for c in ([v] if k is op.LITERAL else range(v[0], v[1] + 1) if v[1] - v[0] < 8 else ())]
        whole = all(k is op.LITERAL or v[1] - v[0] < 8 for k, v in value)
        return {_folded(c) for c in codes} if whole and len(codes) <= 8 else None
    if kind is op.SUBPATTERN:
        return _product(value[3])
    if kind is op.BRANCH:
        sets = [_product(branch) for branch in value[1]]
        union = set().union(*[s for s in sets if s is not None])
        return union if None not in sets and len(union) <= MAX_STRINGS else None
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[1] <= 3:
        one = _product(value[2])
        if one is None:
            return None
        found = {b"".join(p) for n in range(value[0], value[1] + 1) for p in product(one, repeat=n)}
        return found if len(found) <= MAX_STRINGS else None
    return {b""} if kind is op.AT else None


def _product(nodes) -> set[bytes] | None:
    strings = {b""}
    for node in nodes:
        own = _strings_of(node)
        if own is None or len(strings) * len(own) > MAX_STRINGS:
            return None
        strings = {a + b for a in strings for b in own}
    return strings


def _query_of(nodes) -> object:
    """What must hold for a document that this sequence matches: listable neighbours are joined, the rest ANDed."""
    needed, strings = [], {b""}
    for node in nodes:
        own = _strings_of(node)
        if own is not None and len(strings) * len(own) <= MAX_STRINGS:
            strings = {a + b for a in strings for b in own}
            continue
        needed.append(_from_strings(strings))
        strings = {b""} if own is None else own
        if own is None:
            needed.append(_inner(node))
    return _all_of([*needed, _from_strings(strings)])


def _inner(node) -> object:
    kind, value = node
    if kind is op.SUBPATTERN:
        return _query_of(value[3])
    if kind is op.BRANCH:
        return _any_of([_query_of(branch) for branch in value[1]])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] >= 1:
        return _query_of(value[2])
    return True


def trigram_query(pattern: str, flags: int = 0) -> object:
    """Boolean trigram query every text with a match of ``pattern`` satisfies (texts taken in ASCII lower case)."""
    return _query_of(_parser.parse(pattern, flags))


def _leaves(query) -> set[int]:
    return set() if query is True else {query} if isinstance(query, int) else set().union(*map(_leaves, query[1]))


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False

    @cached_property
    def regex(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))

    @cached_property
    def query(self) -> object:
        return trigram_query(self.pattern)

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in self.regex.finditer(text) if m.end(self.group) - m.start(self.group) >= self.least]


BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", "AKIA[A-Z0-9]+", 20),
    # a longest run of 24 or more is the same span as a longest run that is then checked for 24
    Rule("hex", "[0-9a-f]{24,}", 24),
)
# Further well-known shapes: private key blocks, signed web tokens, code-host tokens.
MORE_RULES = (
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("host", r"gh[opsu]_[A-Za-z0-9]+", 40),
)
RULES = BASE_RULES + MORE_RULES


def _postings(texts: list[str], wanted: np.ndarray) -> dict[int, np.ndarray]:
    """Trigram → increasing positions of the texts that contain it, for the wanted trigrams."""
    parts = [text.encode("utf-8", "surrogatepass").lower() for text in texts]
    flat = np.frombuffer(b"\0\0".join(parts), np.uint8).astype(np.uint32)
    if len(flat) < 3:
        return {}
    codes = flat[:-2] << 16 | flat[1:-1] << 8 | flat[2:]
    is_wanted = np.zeros(1 << 24, bool)
    is_wanted[wanted] = True
    at = np.flatnonzero(is_wanted[codes])
    starts = np.cumsum([0, *[len(part) + 2 for part in parts[:-1]]])
    keys = np.unique(codes[at].astype(np.int64) << 32 | np.searchsorted(starts, at, "right") - 1)
    grams, first = np.unique(keys >> 32, return_index=True)
    return dict(zip(grams.tolist(), np.split(keys & 0xFFFFFFFF, first[1:])))


def _candidates(query, postings: dict[int, np.ndarray], n: int) -> np.ndarray:
    if query is True:
        return np.arange(n)
    if isinstance(query, int):
        return postings.get(query, np.zeros(0, np.int64))
    found = None
    for part in query[1]:
        own = _candidates(part, postings, n)
        if found is None:
            found = own
        else:
            found = np.intersect1d(found, own, True) if query[0] == "and" else np.union1d(found, own)
        if query[0] == "and" and not len(found):
            break
    return found


def find_secrets(texts: list[str], rules: tuple[Rule, ...]) -> list[list[tuple[int, int, int]]]:
    """Per text the (start, end, number of the rule) of every secret, by start, then rule."""
    wanted = np.array(sorted(set().union(*[_leaves(rule.query) for rule in rules])), np.int64)
    postings = _postings(texts, wanted)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for number, rule in enumerate(rules):
        for i in _candidates(rule.query, postings, len(texts)).tolist():
            found[i] += [(start, end, number) for start, end in rule.spans(texts[i])]
    return [sorted(spans, key=lambda span: (span[0], span[2])) for spans in found]


def secret_spans(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Column of array<struct<kind, start_at, end_at>>, by start and then in the order of the rules."""

    @pandas_udf("array<struct<kind:string,start_at:long,end_at:long>>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = [
                [{"kind": rules[k].kind, "start_at": start, "end_at": end} for start, end, k in spans]
                for part in chunks(batch)
                for spans in find_secrets(part, rules)
            ]
            yield pd.Series(rows, dtype=object)

    return scan(text)


def without_secrets(text: Column, rules: tuple[Rule, ...] = RULES, mask: str = "[secret]") -> Column:
    """The text with every secret (overlapping ones together) replaced by ``mask``; null stays null."""

    @pandas_udf("string")
    def redact(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            spans = (s for part in chunks(batch) for s in find_secrets(part, rules))
            yield pd.Series([t if t is None else _masked(t, s, mask) for t, s in zip(batch, spans)], dtype=object)

    return redact(text)


def _masked(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    parts, done = [], 0
    for start, end, _ in spans:
        if start >= done:
            parts += [text[done:start], mask]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start_at, s.end_at)), ",")


def scan_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and its ``spans``; one row per row of ``docs`` (doc_id, text), other columns are left out."""
    return docs.select("doc_id", secret_spans(F.col("text"), rules).alias("spans"))


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts per base kind, digest of the base spans, and all spans as text."""
    base = [rule.kind for rule in BASE_RULES]
    found = scan_documents(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    digest = F.sha2(listed(F.filter("spans", lambda s: s.kind.isin(base))), 256)
    return found.select("doc_id", *map(count, base), digest.alias("base_sha256"), listed(F.col("spans")).alias("spans"))

