"""Secret scans by assignment-aware lexing.

Three base patterns find assignments of telling names, access keys and long hex runs. On top of
them a lexer reads source and configuration syntax as name-literal pairs, follows constants
(``p = "..."`` and later ``db_password = p``, also in concatenations), and scores each literal by
how sensitive its target name is and how little it looks like a placeholder.

Nulls and empty texts have no spans. Rows are scanned one by one, so repeated rows repeat their
result, an empty table gives an empty result, and other columns are never read.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from marketlens.llm.common import column, slices, texts

# The base patterns and the order of their kinds; spans of the lexer come last.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "literal")
LEAST = {"assign": 8, "access": 16, "hex": 32}

# How much a part of a target name says that its value is secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.8, "apikey": 0.9,
    "accesskey": 0.9, "privatekey": 1.0, "secretkey": 1.0, "credential": 0.8, "authkey": 0.9,
}
STEMS = (b"password", b"passwd", b"passphrase", b"pwd", b"secret", b"token", b"key", b"credential")
HARMLESS_TAIL = re.compile(r"(?:_?(?:url|uri|path|file|name|field|type|id|length|len|count|hint|label|regex|env|expiry|ttl))$")
PLACEHOLDER = re.compile(r"(?i)change.?me|example|placeholder|your[_-]|dummy|redacted|<[^>]*>|\$\{|\{\{|x{4,}|\*{3,}")
EDGE = 16  # characters on either side of a joint, more than any placeholder but <...> needs
LONGEST = 1 << 40  # characters of a joined value that are counted
THRESHOLD = 0.5

TOKEN = re.compile(
    r"""(?P<str>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\\n]|\\.)*`)"""
    r"""|(?P<tag><(?P<tagname>[A-Za-z][\w.-]*)>(?P<tagvalue>[^<\n]+)</(?P=tagname)>)"""
    r"""|(?P<name>[A-Za-z_$][\w$]*(?:[.-][A-Za-z_$][\w$]*)*)"""
    r"""|(?P<op>:=|=>|==|!=|<=|>=|[=:+\[\]])|(?P<line>\n)|(?P<other>[^\s\w"'`=:+\[\]])"""
)
BARE = re.compile(r"[A-Za-z0-9+/_.=~@%!$*#^&-]{8,}")


class Span(NamedTuple):
    start: int
    kind: str
    end: int
    value: int  # where the secret itself begins, after the name and operator


def base_spans(text: str) -> list[Span]:
    found = [Span(m.start(), "assign", m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        found += [Span(m.start(), kind, m.end(), m.start()) for m in pattern.finditer(text) if m.end() - m.start() >= LEAST[kind]]
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


def name_score(name: str) -> float:
    flat = re.sub(r"[^a-z]", "", name.lower())
    if HARMLESS_TAIL.search(name.lower()):
        return 0.0
    return max((w for part, w in SENSITIVE.items() if part in flat), default=0.0)


class Value:
    """A literal, or literals and constants joined to one text.

    Only what its score needs is known of the text: how often each character occurs, and what a placeholder
    across a joint needs. Parts are kept by reference, so a constant that is added to itself line after line
    costs no more than the lines.
    """

    __slots__ = ("place", "parts", "counts", "length", "head", "tail", "opened", "closed", "placeholder")

    def __init__(self, place: tuple[int, int] | None, parts: tuple[Value, ...], text: str = ""):
        self.place, self.parts = place, parts
        if place is not None:
            self.counts, self.length = Counter(text), len(text)
            self.head, self.tail = text[:EDGE], text[-EDGE:]
            self.opened, self.closed = "<" in text, ">" in text
            self.placeholder = bool(PLACEHOLDER.search(text))
            return
        self.counts, self.length = Counter(), 0
        self.head = self.tail = ""
        self.opened = self.closed = self.placeholder = False
        for part in parts:
            joint = self.tail + part.head
            self.placeholder = self.placeholder or part.placeholder or bool(PLACEHOLDER.search(joint)) or (self.opened and part.closed)
            self.head = (self.head + part.head)[:EDGE] if self.length < EDGE else self.head
            self.tail = part.tail if part.length >= EDGE else (self.tail + part.tail)[-EDGE:]
            self.opened, self.closed = self.opened or part.opened, self.closed or part.closed
            self.counts.update(part.counts)
            self.length += part.length
            if self.length > LONGEST:  # no text is: only the shares of the characters matter from here
                self.counts = Counter({c: n * EDGE / self.length for c, n in self.counts.items()})
                self.length = EDGE

    def score(self) -> float:
        """Near 1 for long mixed values, 0 for short ones, placeholders and plain words or sentences."""
        if self.length < 8 or self.counts.get(" ") or self.placeholder:
            return 0.0
        entropy = -sum(c / self.length * math.log2(c / self.length) for c in self.counts.values())
        chars = "".join(self.counts)
        kinds = sum(bool(re.search(p, chars)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
        return min(1.0, entropy / 3.0) * (0.45 + 0.2 * kinds)

    def places(self, known: set[int]) -> Iterator[tuple[int, int]]:
        """Places of the literals; parts whose ``id`` is known are left out, and those met become known."""
        left = [self]
        while left:
            value = left.pop()
            if id(value) not in known:
                known.add(id(value))
                if value.place is not None:
                    yield value.place
                left += value.parts


def pairs(text: str) -> Iterator[tuple[str, Value]]:
    """Each assignment as its target name and its value."""
    tokens = [m for m in TOKEN.finditer(text)]
    constants: dict[str, Value] = {}
    i = 0
    while i < len(tokens):
        m = tokens[i]
        if m.lastgroup == "tag" or m["tag"]:
            yield m["tagname"], Value(m.span("tagvalue"), (), m["tagvalue"])
            i += 1
            continue
        if not (m["name"] or m["str"]):
            i += 1
            continue
        name, j = m["name"] or m["str"][1:-1], i + 1
        while j + 2 < len(tokens) and tokens[j]["op"] == "[" and (tokens[j + 1]["str"] or tokens[j + 1]["name"]) and tokens[j + 2]["op"] == "]":
            name, j = (tokens[j + 1]["str"] or f"'{tokens[j + 1]['name']}'")[1:-1], j + 3
        if j < len(tokens) and tokens[j]["op"] == "]":
            j += 1
        if j + 2 < len(tokens) and tokens[j]["op"] == ":" and tokens[j + 1]["name"] and tokens[j + 2]["op"] == "=":
            j += 2  # a type between the name and the value
        if j >= len(tokens) or tokens[j]["op"] not in ("=", ":", ":=", "=>"):
            i += 1
            continue
        value, j = _value(text, tokens, j + 1, constants)
        if value:
            constants[name] = value
            yield name, value
        i = max(i + 1, j)


def _value(text: str, tokens: list[re.Match], j: int, constants: dict[str, Value]) -> tuple[Value | None, int]:
    parts: list[Value] = []
    joined = True

    def literal(a: int, b: int) -> Value:
        return Value((a, b), (), text[a:b])

    while j < len(tokens) and joined:
        m = tokens[j]
        if m["str"]:
            parts.append(literal(m.start() + 1, m.end() - 1))
        elif m["name"] and m["name"] in constants:
            parts.append(constants[m["name"]])
        elif not parts and (bare := BARE.match(text, m.start())) and text[max(0, m.start() - 1)] in " \t=:":
            parts.append(literal(*bare.span()))
            while j < len(tokens) and tokens[j].start() < bare.end():
                j += 1
            break
        else:
            break
        j += 1
        joined = j < len(tokens) and (tokens[j]["op"] == "+" or bool(tokens[j]["str"]))
        j += joined and tokens[j]["op"] == "+"
    return (parts[0] if len(parts) == 1 else Value(None, tuple(parts)) if parts else None), j


def lexed_spans(text: str, base: list[Span]) -> list[Span]:
    """Literals under sensitive names that no base span touches."""
    found: set[tuple[int, int]] = set()
    known: set[int] = set()
    held = []  # values stay alive, so that their ids stay their own
    for name, value in pairs(text):
        held.append(value)
        weight = name_score(name)
        if weight and weight * value.score() >= THRESHOLD:
            found.update(p for p in value.places(known) if p[0] < p[1])
    # Of the base spans that begin before a literal's end, one touches it if the furthest end is past its start.
    starts = [s.start for s in base]
    furthest = list(accumulate((s.end for s in base), max, initial=0))
    return [Span(a, "literal", b, a) for a, b in sorted(found) if furthest[bisect_left(starts, b)] <= a]


# Names are scored by their letters alone, so stems are looked for in the letters of each line. The two
# signs become ASCII letters in lower case.
_BETWEEN = bytes(b for b in range(256) if not chr(b).isascii() or not (chr(b).isalpha() or chr(b) == "\n"))
_FOLDED = ("\u212a".encode(), "\u0130".encode())
_RUN = bytes(ord("1") if chr(b) in "0123456789abcdef" else 0 for b in range(256))


def _named(data: bytes) -> bool:
    """Whether a text can hold a telling name and an assignment or element."""
    if not (b"=" in data or b":" in data or b"</" in data):
        return False
    if any(sign in data for sign in _FOLDED):
        data = data.decode("utf-8", "replace").lower().encode()
    low = data.lower().translate(None, _BETWEEN)
    return any(stem in low for stem in STEMS)


def scan(data: bytes) -> list[Span]:
    """All spans of a text. Texts without a telling name, key prefix or hex run are not lexed."""
    named = _named(data)
    if not (named or b"AKIA" in data or b"1" * LEAST["hex"] in data.translate(_RUN)):
        return []
    text = data.decode("utf-8", "replace")
    base = base_spans(text)
    return sorted(base + (lexed_spans(text, base) if named else []), key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts of the base kinds, digest of the base spans, all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = [scan(t) for t in texts(batch, text)]
            base = [[s for s in spans if s.kind != "literal"] for spans in found]
            counts = [[sum(s.kind == k for s in spans) for spans in base] for k in KINDS[:3]]
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, key),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array([hashlib.sha256(listed(s).encode()).hexdigest() for s in base], pa.string()),
                    pa.array([listed(s) for s in found], pa.string()),
                ],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select(key, text).mapInArrow(run, schema)


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret value replaced by ``mark``; names, rows and columns stay."""
    at = docs.columns.index(text)

    def clean(data: bytes) -> str:
        spans, whole = scan(data), data.decode("utf-8", "replace")
        out, done = [], 0
        for start, end in sorted((s.value, s.end) for s in spans):
            if start >= done:
                out += [whole[done:start], mark]
            done = max(done, end)
        return "".join([*out, whole[done:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            null = column(batch, text).is_null().to_pylist()
            new = pa.array([None if n else clean(t) for n, t in zip(null, texts(batch, text), strict=True)], pa.string())
            arrays = [*batch.columns[:at], new, *batch.columns[at + 1 :]]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
