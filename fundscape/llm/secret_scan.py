"""Secrets in texts: fixed patterns, and literals assigned to sensitive names.

``scan`` keeps every base match and adds what assignment-aware lexing finds. The lexer
reads source and configuration syntax: ``name = literal``, ``name: literal``, ``name :=``
and ``name =>``, keys in quotes or brackets, attributes, keyword arguments, with string
literals in any quotes (adjacent or joined by ``+``, on the same or the next line), lists of them, literals
among the arguments of a call (``os.getenv("X", "...")``), bare values after ``=`` or ``:`` and other
names. Literals passed to a function are paired with its name (``set_password("...")``), the ``value`` of a
tag with its ``key``, ``name`` or ``id``. A name that stands for a literal carries it on: with ``part = "x7..."`` and
``api_key = part``, in either order or as ``api_key = part = "x7..."``, the literal of ``part`` is scored under
``api_key`` as well, through any number of names of any length. A name that is assigned
something else stands for nothing any more. A literal is
reported where its score reaches ``THRESHOLD``: the weight of the words in its name times
how much its characters look drawn at random.

Spans are in code points, end exclusive, kinds in the order ``assign access hex lexed``.
A null or empty text has no spans. Texts of any length are read whole, one at a time.
Repeated rows give repeated rows, an empty table none; ``scan`` takes id and text only, so
other columns and null ids do not matter."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns, the least lengths of their matches, and their order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "lexed")
HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Weights of words within a name.
NAME_WEIGHT = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "secrets": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "auth": 0.7, "authorization": 0.8, "bearer": 0.9,
    "private": 0.6, "access": 0.4, "api": 0.4, "key": 0.5, "signing": 0.5, "encryption": 0.5, "client": 0.2,
    "dsn": 0.6, "salt": 0.6, "hmac": 0.7, "pin": 0.5, "license": -0.5, "public": -0.6, "path": -0.5, "file": -0.4,
    "url": -0.3, "name": -0.4, "id": -0.2, "length": -0.8, "count": -0.8, "type": -0.5, "field": -0.5,
}
THRESHOLD = 0.5
LEAST = 8  # characters of a literal

# A name, perhaps quoted or in brackets, then an assignment sign, then its right side. A name begins
# at the first place that can begin one in its run of name characters; as the run is taken whole,
# without going back, long runs are read once.
STATEMENT = re.compile(
    r"""(?<![\w$.\-])(?:\d[\w$]*+|[.\-])*+([A-Za-z_$][\w$.\-]*+)["']?\]?[ \t]*(?::[ \t]*[A-Za-z_][\w.\[\]]*[ \t]*=(?!=)|:=|=>|==?=?|:)[ \t]*(?:\\?\r?\n[ \t]*(?=["'`]))?(?=[^\s=])""",
    re.ASCII,
)
STRING = re.compile(r'''[rbfuRBFU]{0,2}("(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\]|\\.)*`)''', re.ASCII)
JOINED = re.compile(r"[ \t]*(?:\+|\.|\\\n)?[ \t]*", re.ASCII)
BARE = re.compile(r"[A-Za-z0-9+/_.=~$-]+", re.ASCII)
OPEN = re.compile(r"(?:[\[(][ \t\r\n]*+)++")
COMMA = re.compile(r"[ \t\r\n]*+,[ \t\r\n]*+")
CALL = re.compile(r"""(?<![\w$.\-])([A-Za-z_$][\w$.\-]*+)\([ \t\r\n]*+(?=["'`])""", re.ASCII)
TAG = re.compile(r"<[A-Za-z][^<>]*+>")
KEY = re.compile(r"""\b(?:key|name|id)[ \t]*=[ \t]*["']([^"']*)["']""", re.ASCII)
VALUE = re.compile(r"""\bvalue[ \t]*=[ \t]*["']([^"']*)["']""", re.ASCII)
IDENTIFIER = re.compile(r"[A-Za-z_$][\w$.]*\Z", re.ASCII)
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+", re.ASCII)


def name_weight(name: str) -> float:
    """How sensitive a name is, 0 to 1: the sum over its snake, kebab, dot or camel words, plurals included."""
    words = [w.lower() for w in WORDS.findall(name)]
    total = sum(NAME_WEIGHT.get(w, NAME_WEIGHT.get(w.removesuffix("s"), 0.0)) for w in words)
    return min(1.0, max(0.0, total))


def randomness(literal: str) -> float:
    """0 to 1: entropy per character against what a random literal of this length and
    alphabet has, less where it has white space or is one word of letters."""
    n = len(literal)
    if n < LEAST or any(c.isspace() for c in literal):
        return 0.0
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(literal).values())
    classes = sum(any(f(c) for c in literal) for f in (str.islower, str.isupper, str.isdigit)) + any(not c.isalnum() for c in literal)
    share = entropy / min(math.log2(n), 5.0)
    return min(1.0, share) * (0.4 if classes == 1 and literal.isalpha() else 0.7 if classes == 1 else 1.0)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def literal(text: str, at: int) -> tuple[list[tuple[int, int]], int]:
    """The spans of the parts of the literal at ``at`` (without quotes), and where it ends."""
    parts = []
    while s := STRING.match(text, at):
        parts.append((s.start(1) + 1, s.end(1) - 1))
        at = JOINED.match(text, s.end()).end()
    return parts, at


def literals(text: str, at: int) -> list[list[tuple[int, int]]]:
    """The literals in the list of literals, names and numbers that begins at ``at``."""
    out = []
    while True:
        parts, end = literal(text, at)
        if parts:
            out.append(parts)
        elif b := BARE.match(text, at):
            end = b.end()
        else:
            return out
        if not (c := COMMA.match(text, end)):
            return out
        at = c.end()


def pairs(text: str) -> Iterator[tuple[str, list[list[tuple[int, int]]], str]]:
    """name, the literals assigned to it, and the other name it may copy."""
    for m in STATEMENT.finditer(text):
        at = m.end()
        if o := OPEN.match(text, at):
            yield m[1], literals(text, o.end()), ""
        elif (parts := literal(text, at)[0]):
            yield m[1], [parts], ""
        elif b := BARE.match(text, at):
            value = b[0]
            if not IDENTIFIER.match(value) or any(c.isdigit() for c in value):
                yield m[1], [[(b.start(), b.end())]], value
            elif o := OPEN.match(text, b.end()):  # a call; names among its arguments are no secrets
                given = literals(text, o.end())
                yield m[1], [x for x in given if not all(c.isalpha() or c in "_.-" for a, e in x for c in text[a:e])], ""
            else:
                yield m[1], [], value
        else:
            yield m[1], [], ""


def passed(text: str) -> Iterator[tuple[str, list[list[tuple[int, int]]]]]:
    """name and literals of calls and tags."""
    if "(" in text:
        for m in CALL.finditer(text):
            if name_weight(m[1]):
                yield m[1], literals(text, m.end())
    if "<" in text:
        for m in TAG.finditer(text):
            key, value = KEY.search(m[0]), VALUE.search(m[0])
            if key and value:
                yield key[1], [[(m.start() + value.start(1), m.start() + value.end(1))]]


def lexed_spans(text: str) -> list[tuple[int, int, str]]:
    """Literals whose name, or a name they are passed on to, is sensitive enough."""
    if not any(c in text for c in "=:("):
        return []
    constants: dict[str, list[list[tuple[int, int]]]] = {}
    waiting: dict[str, list[str]] = {}  # names that copy a name not assigned yet
    found = set()

    def report(name: str, given: list[list[tuple[int, int]]]) -> None:
        weight = name_weight(name)
        for parts in given:
            if weight and weight * randomness("".join(text[a:b] for a, b in parts)) >= THRESHOLD:
                found.update((a, b, "lexed") for a, b in parts if b > a)

    for name, given, other in pairs(text):
        given = constants.get(other, given) if other else given
        if not given:
            constants.pop(name, None)
            if other:
                waiting.setdefault(other, []).append(name)
            continue
        names = [name]
        while names:
            constants[n := names.pop()] = given
            report(n, given)
            names += waiting.pop(n, [])
    for name, given in passed(text):
        report(name, given)
    return sorted(found)


def order(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id_col, n_assign, n_access, n_hex, n_lexed, base_spans, spans."""
    names = ["n_assign", "n_access", "n_hex", "n_lexed", "base_spans", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for value in batch.column("text"):
                t = value.as_py() or ""
                base = order(base_spans(t))
                lexed = lexed_spans(t)
                kinds = Counter(k for _, _, k in base)
                row = (*[kinds[k] for k in KINDS[:3]], len(lexed), joined(base), joined(order(base + lexed)))
                for c, v in zip(columns, row, strict=True):
                    c.append(v)
            arrays = [pa.array(c, pa.int64() if n.startswith("n_") else pa.string()) for c, n in zip(columns, names, strict=True)]
            yield pa.record_batch([batch.column("id"), *arrays], names=["id", *names])

    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    dtype = narrow.schema["id"].dataType.simpleString()
    schema = ", ".join([f"id {dtype}", *[f"{n} {'long' if n.startswith('n_') else 'string'}" for n in names]])
    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_col)
