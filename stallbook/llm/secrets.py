"""Secret scans: a trigram index per segment of documents, Boolean trigram queries, and regexes to verify.

Each rule's regex gives a query: an AND of ORs of ANDs of trigrams that every match must contain. Documents are taken
in segments (one Arrow batch). A segment's inverted index holds, for every trigram that some query asks for, the
documents it occurs in; a rule's postings are united and intersected, and its regex runs on the candidates alone.
Rules without a mandatory trigram scan every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from re import _constants as op
from re import _parser as parser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import map_rows

_MANY = 64    # literal alternatives beyond which a part of a regex is not enumerated


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its regex, whether letters match in either case, and what a match must have besides."""

    kind: str
    pattern: str
    ignore_case: bool = False
    group: int = 0
    least: int = 0

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))

    def spans(self, text: str, compiled: re.Pattern) -> list[tuple[int, int]]:
        return [match.span() for match in compiled.finditer(text)
                if match.end(self.group) - match.start(self.group) >= self.least]


# The base rules, in the order in which spans are listed.
BASE = [
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         ignore_case=True, group=2, least=12),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}", least=16),   # finds the same as "+": a run is taken whole either way
]
# Published shapes of other secrets, which add spans of kinds of their own.
MORE = [
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", least=39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("url_login", r"://[A-Za-z0-9._~-]+:[A-Za-z0-9._~!$&*+=%-]+@", least=8),
]
RULES = BASE + MORE

Query = list[list[frozenset[str]]]   # AND of ORs; an alternative is a set of trigrams that occur together


def _trigrams(literal: str) -> frozenset[str]:
    return frozenset(gram for k in range(len(literal) - 2) if (gram := literal[k:k + 3]).isascii())


def _literals(tree, most: int = _MANY) -> set[str] | None:
    """All strings a part of a regex matches, lower-cased, or None if they are too many or not plain."""
    found = {""}
    for code, value in tree:
        if code is op.LITERAL:
            more = {chr(value).lower()}
        elif code is op.IN and all(item[0] in (op.LITERAL, op.RANGE) for item in value):
            more = set()
            for kind, what in value:
                first, last = (what, what) if kind is op.LITERAL else what
                if last - first >= most:
                    return None
                more |= {chr(c).lower() for c in range(first, last + 1)}
        elif code is op.BRANCH:
            parts = [_literals(branch, most) for branch in value[1]]
            if None in parts:
                return None
            more = set().union(*parts)
        elif code is op.SUBPATTERN:
            more = _literals(value[3], most)
        elif code is op.MAX_REPEAT and value[1] <= 2:
            once = _literals(value[2], most)
            if once is None:
                return None
            more, power = set(), {""}
            for times in range(value[1] + 1):
                if times >= value[0]:
                    more |= power
                power = {a + b for a in power for b in once}
        else:
            return None
        if more is None or len(found) * len(more) > most:
            return None
        found = {a + b for a in found for b in more}
    return found


def query_of(pattern: str) -> Query:
    """The trigram query of a regex; empty if no trigram is mandatory. Trigrams are in lower case.

    The regex is cut into its longest stretches that can be written out as a few strings. Each such string stands in
    the text whole, so its trigrams all occur; the strings of a stretch are alternatives, and all stretches occur.
    """
    query: Query = []

    def flush(stretch: set[str]) -> None:
        alternatives = [_trigrams(literal) for literal in sorted(stretch)]
        if all(alternatives):
            query.append(alternatives)

    def visit(tree) -> None:
        stretch = {""}
        for item in tree:
            more = _literals([item])
            if more is not None and len(stretch) * len(more) <= _MANY:
                stretch = {a + b for a in stretch for b in more}
                continue
            flush(stretch)
            stretch = {""} if more is None else more
            code, value = item
            if more is None and code is op.SUBPATTERN:
                visit(value[3])
            elif more is None and code is op.MAX_REPEAT and value[0] > 0:
                visit(value[2])
        flush(stretch)

    visit(parser.parse(pattern))
    return query


@cache
def _numbers(rules: tuple[Rule, ...]) -> tuple[list[str], np.ndarray]:
    """The trigrams that any rule asks for, and a table from three bytes to 1 + a trigram's number."""
    wanted = sorted({gram for rule in rules for ors in query_of(rule.pattern) for grams in ors for gram in grams})
    table = np.zeros(1 << 24, np.uint16)
    for number, gram in enumerate(wanted):
        a, b, c = gram.encode()
        table[a << 16 | b << 8 | c] = 1 + number
    return wanted, table


def index_segment(texts: list[str], rules: tuple[Rule, ...]) -> dict[str, np.ndarray]:
    """The segment's postings: for each trigram that a rule asks for, the sorted numbers of the texts it is in."""
    wanted, table = _numbers(rules)
    gram_numbers, text_numbers = [], []
    for number, text in enumerate(texts):
        raw = np.frombuffer(text.encode().lower(), np.uint8)    # bytes: ASCII letters only
        found = set()
        for first in range(0, len(raw) - 2, 1 << 20):
            part = raw[first:first + (1 << 20) + 2].astype(np.uint32)
            hits = table[part[:-2] << 16 | part[1:-1] << 8 | part[2:]]
            found |= set(hits[hits > 0].tolist())
        gram_numbers += found
        text_numbers += [number] * len(found)
    grams, numbers = np.array(gram_numbers, np.int64), np.array(text_numbers, np.int64)
    order = np.argsort(grams, kind="stable")
    bounds = np.searchsorted(grams[order], np.arange(1, len(wanted) + 2))
    return {gram: numbers[order[a:b]] for gram, a, b in zip(wanted, bounds, bounds[1:])}


def candidates(query: Query, postings: dict[str, np.ndarray], count: int) -> np.ndarray:
    """The texts that satisfy a query: postings intersected inside an alternative, united over alternatives."""
    found = np.arange(count)
    for ors in query:
        either = np.zeros(0, np.int64)
        for grams in ors:
            both = None
            for gram in sorted(grams, key=lambda gram: len(postings[gram])):
                both = postings[gram] if both is None else np.intersect1d(both, postings[gram], assume_unique=True)
            either = np.union1d(either, both)
        found = np.intersect1d(found, either, assume_unique=True)
    return found


def scan_segment(texts: list[str], rules: tuple[Rule, ...]) -> list[list[tuple[str, int, int]]]:
    """All spans (kind, start, end) of each text, by start, then by the rules' order."""
    postings = index_segment(texts, rules)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for place, rule in enumerate(rules):
        compiled = rule.compiled()
        for number in candidates(query_of(rule.pattern), postings, len(texts)).tolist():
            found[number] += [(start, place, end) for start, end in rule.spans(texts[number], compiled)]
    return [[(rules[place].kind, start, end) for start, place, end in sorted(spans)] for spans in found]


def secrets(documents: DataFrame, rules: list[Rule] = RULES, id_column: str = "doc_id",
            text_column: str = "text", segment: int = 512) -> DataFrame:
    """(id, spans) per row; spans is an array of (kind, start, stop) in code points, the end exclusive.

    Null text is empty; every row comes back, repeated ones each with their result; an empty table gives an empty
    result. Nothing is shuffled: a segment's index and its texts meet in the task that read them.
    """
    kind = documents.schema[id_column].dataType.simpleString()
    chosen = tuple(rules)

    def rows(ids: list, texts: list) -> Iterator[tuple]:
        for first in range(0, len(ids), segment):
            part = [text or "" for text in texts[first:first + segment]]
            for key, spans in zip(ids[first:first + segment], scan_segment(part, chosen)):
                yield key, [{"kind": name, "start": a, "stop": b} for name, a, b in spans]

    return map_rows(documents.select(F.col(id_column).alias("id"), text_column),
                    f"id {kind}, spans array<struct<kind:string,start:long,stop:long>>", rows)
