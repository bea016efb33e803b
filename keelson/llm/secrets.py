"""Secret scans (operator 3).

Texts are lexed as source and configuration syntax into name-literal pairs
(``name = "literal"``, ``name: literal``, ``"name": "literal"``, ``--name
literal``, concatenations). Names that hold a literal are remembered, so that
``key = part`` passes the literal on; a literal's score is its own shape times
how sensitive the name it is assigned to sounds. Three plain patterns
(assignments, access keys, long hex runs) are reported besides.

Only texts that hold a sensitive stem are lexed: without one no name can score.

A literal is carried as its length, its characters' counts, its ends and its
places, so a constant that is added to itself over and over costs no more than
its lines.

Cases: null text is empty and gives no spans; rows stay one for one, repeated
and null ids included; an empty table gives an empty result; whole texts are
scanned, whatever their length.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import fresh_worker, id_and_bytes, schema_with, table

KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
NEEDLES = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
HEX_ONLY = bytes(120 if c in b"0123456789abcdef" else 32 for c in range(256))

# how sensitive a part of a name is (fixed values)
SENSITIVE = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.7, "secret": 1.0, "token": 0.9,
             "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "auth": 0.6, "bearer": 0.8, "key": 0.4}
KEY_OWNERS = {"api", "access", "private", "secret", "signing", "encryption", "account", "service", "master", "client"}
STEMS = (b"pass", b"pwd", b"secret", b"token", b"key", b"credential", b"auth", b"bearer")
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|change_?me|example.*|your.*|<.*>|\$\{.*\}|%\(.*\)s|\{\{.*\}\}|none|null|true|false|todo|redacted|test)$")
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
LEX = re.compile(r"""
    (?P<string>"{3}.*?"{3}|'{3}.*?'{3}|"(?:\\.|[^"\\\n])*"|'(?:\\.|[^'\\\n])*'|`(?:\\.|[^`\\\n])*`)
  | (?P<flag>--[A-Za-z][\w-]*)
  | (?P<word>[A-Za-z0-9_$./+@-][\w$./+@~!%^&*-]*)
  | (?P<op>:=|=>|==|!=|<=|>=|=|:|\+)
  | (?P<line>\n)
  | (?P<mark>[^\s\w])""", re.X | re.S)
HEAD = 64
IDENT = re.compile(r"[A-Za-z_$][\w$.-]*")


class Token(NamedTuple):
    kind: str
    start: int
    end: int


class Literal(NamedTuple):
    """What the score needs of a literal, and where it stands in the source. A
    concatenation adds up in time that does not depend on the literal's length;
    ``parts`` is a span or the two literals' parts."""

    length: int
    counts: dict[str, int]
    head: str  # its first and last characters, whole where it is short
    tail: str
    words: int
    parts: tuple

    @classmethod
    def of(cls, value: str, start: int, end: int) -> Literal:
        return cls(len(value), Counter(value), value[:HEAD], value[-HEAD:], len(value.split()), (start, end))

    def __add__(self, other: Literal) -> Literal:
        counts = dict(self.counts)
        for c, n in other.counts.items():
            counts[c] = counts.get(c, 0) + n
        head = self.head if self.length >= HEAD else (self.head + other.head)[:HEAD]
        tail = other.tail if other.length >= HEAD else (self.tail + other.tail)[-HEAD:]
        joined = bool(self.tail and other.head) and not self.tail[-1].isspace() and not other.head[0].isspace()
        return Literal(self.length + other.length, counts, head, tail, self.words + other.words - joined, (self.parts, other.parts))

    def placeholder(self) -> bool:
        if self.length <= HEAD:
            return bool(PLACEHOLDER.match(self.head))
        if set(self.counts) <= {"x", "X"} or len(self.counts) == 1 and next(iter(self.counts)) in "*.":
            return True
        # a long one: what is between its ends does not matter, but a line's end does
        return "\n" not in self.counts and bool(PLACEHOLDER.match(self.head + self.tail))


def name_score(name: str) -> float:
    parts = [p.lower() for p in PART.findall(name)]
    best = max((SENSITIVE.get(p, 0.0) for p in parts), default=0.0)
    if any(a in KEY_OWNERS and b == "key" for a, b in zip(parts, parts[1:])):
        best = 1.0
    return best


def literal_score(value: Literal) -> float:
    """0 for placeholders and words; near 1 for long, mixed, uneven literals."""
    if value.length < 8 or value.placeholder():
        return 0.0
    bits = -sum(c / value.length * math.log2(c / value.length) for c in value.counts.values())
    signs = "".join(value.counts)
    kinds = sum(bool(re.search(p, signs)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^\w\s]"))
    return max(0.0, min(1.0, bits / 4) * (0.5 + 0.25 * min(kinds, 3) - 0.25) - 0.15 * min(value.words, 100) + 0.15)


def tokens_of(text: str) -> list[Token]:
    return [Token(m.lastgroup, m.start(), m.end()) for m in LEX.finditer(text)]


def pairs(text: str) -> Iterator[tuple[str, Literal]]:
    """Name-literal pairs in order, constants propagated."""
    tokens = tokens_of(text)
    known: dict[str, Literal] = {}
    at = lambda k: text[tokens[k].start:tokens[k].end] if k < len(tokens) else ""

    def operand(k: int) -> Literal | None:
        t = tokens[k]
        if t.kind == "string":
            q = 3 if text[t.start:t.start + 3] in ('"""', "'''") and t.end - t.start >= 6 else 1
            return Literal.of(text[t.start + q:t.end - q], t.start + q, t.end - q)
        if t.kind == "word":
            return known.get(at(k)) or Literal.of(at(k), t.start, t.end)
        return None

    for k, t in enumerate(tokens):
        if t.kind == "flag":
            name, v = at(k)[2:], k + 2 if at(k + 1) == "=" else k + 1
        elif t.kind == "string" and at(k + 1) in (":", "=>", "="):
            name, v = text[t.start + 1:t.end - 1], k + 2
        elif t.kind == "word" and at(k + 1) in ("=", ":=", "=>", ":") and IDENT.fullmatch(at(k)):
            name, v = at(k), k + 2
            if at(k + 1) == ":" and k + 3 < len(tokens) and tokens[k + 2].kind == "word" and at(k + 3) == "=":
                v = k + 4  # name: type = literal
        else:
            continue
        value = None
        while v < len(tokens) and (part := operand(v)):
            value = value + part if value else part
            if at(v + 1) != "+" and not (v + 1 < len(tokens) and tokens[v].kind == tokens[v + 1].kind == "string"):
                break
            v += 2 if at(v + 1) == "+" else 1
        if value:
            known[name] = value
            yield name, value


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the plain patterns, code points, end exclusive."""
    out = [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return out + [(2, m.start(), m.end()) for m in HEX.finditer(text)]


def lexed_spans(text: str, threshold: float) -> list[tuple[int, int, int]]:
    found, seen, kept = set(), set(), []
    for name, literal in pairs(text):
        if (n := name_score(name)) and n * literal_score(literal) >= threshold:
            todo = [literal.parts]
            while todo:  # parts shared by several literals are looked at once
                part = todo.pop()
                if id(part) in seen:
                    continue
                if isinstance(part[0], int):
                    found.add(part)
                else:
                    seen.add(id(part))
                    kept.append(part)
                    todo += part
    return sorted((3, s, e) for s, e in found if e > s)


def scan(text: bytes, threshold: float) -> list[tuple[int, int, int]]:
    """All spans, by start, then kind, then end."""
    low = text.lower()
    plain = any(n in low for n in NEEDLES) or b"AKIA" in text or b"x" * 32 in text.translate(HEX_ONLY)
    lexed = (b"=" in text or b":" in text or b"--" in text) and any(s in low for s in STEMS)
    if not plain and not lexed:
        return []
    s = text.decode("utf-8", "replace")
    spans = (base_spans(s) if plain else []) + (lexed_spans(s, threshold) if lexed else [])
    return sorted(spans, key=lambda x: (x[1], x[0], x[2]))


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, a = [], 0
    for _, s, e in sorted(spans, key=lambda x: x[1]):
        if s >= a:
            out += [text[a:s], mark]
        a = max(a, e)
    return "".join([*out, text[a:]])


def scan_secrets(docs: DataFrame, threshold: float = 0.45, mark: str = "[REDACTED]", carry: tuple = ()) -> DataFrame:
    """Per document its spans (kind, start, end; code points) and the text
    with every span replaced by ``mark`` (null where nothing was found);
    ``carry`` holds columns to return besides."""
    rows = id_and_bytes(docs, *carry)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        fresh_worker("secrets")
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [scan(t, threshold) for t in texts]
            clean = [redacted(t.decode("utf-8", "replace"), f, mark) if f else None for t, f in zip(texts, found)]
            spans = [[{"kind": KINDS[k], "start": s, "end": e} for k, s, e in f] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(spans, pa.list_(span)), pa.array(clean, pa.string())],
                                             [batch.schema.names[0], *batch.schema.names[2:], "spans", "clean"])

    return rows.mapInArrow(run, schema_with(rows, "spans array<struct<kind:string,start:long,end:long>>, clean string"))


def op3(docs: DataFrame) -> DataFrame:
    label = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    return scan_secrets(docs).select("doc_id", count("assign"), count("access"), count("hex"),
                                     F.sha2(F.concat_ws(",", F.transform(base, label)), 256).alias("base_sha256"),
                                     F.concat_ws(",", F.transform("spans", label)).alias("spans"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3(table(spark, sf_dir, "documents"))
