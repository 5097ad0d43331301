"""Secret scans: fixed patterns and an assignment-aware lexer.

The lexer reads source and configuration syntax (``name = "literal"``, ``name: literal``, ``"name": "literal"``,
``name := literal``, ``name => literal``, ``export NAME=literal``, ``map["name"] = literal``) into name-literal pairs.
A bare value that is the name of another pair is a reference; literals flow along references to every name they reach,
and a literal is reported when a sensitive name holds it and it looks like a value rather than a placeholder. Parts
joined by ``+`` are folded into one value first, with each name in them standing for the value it was given last (or
will be given first); when that value is reported, so is every literal that it is made of.

Per row: ``spans``, an array of (kind, start, end) in code points, by start, then kind in the order of ``KINDS``.
Defined cases: a null or empty text has no spans; texts of any length are read whole; repeated rows are scanned each.
Only rows in which a pattern or a sensitive word occurs at all reach the lexer; a vectorised search sorts them out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from supplyloom.llm.batches import bounded_batches

KINDS = ("assign", "access", "hex", "literal")
# Fixed values of the scan's contract.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs of 32 and more; shorter runs are no findings
MIN_ASSIGN, MIN_ACCESS = 8, 16

#: How sensitive a part of a name is; a pair's name scores the sum of its parts, 1.0 is enough with a good literal.
NAME_PARTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.8, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "auth": 0.5, "private": 0.5, "access": 0.4, "api": 0.4, "key": 0.5,
    "bearer": 0.8, "signature": 0.5, "salt": 0.6, "webhook": 0.5,
}
PLACEHOLDER = re.compile(r"(?i)changeme|example|placeholder|dummy|your[_-]|xxxx|\*\*\*\*|<[^>]*>|\$\{|%\(|\{\{|^null$|^none$|^true$|^false$")
MIN_LITERAL, MIN_BITS, MIN_SCORE = 8, 2.5, 1.3
MAY_HOLD = "(?i:" + "|".join(sorted(NAME_PARTS)) + r"|api_key)|AKIA[A-Z0-9]{12}|[0-9a-f]{32}"

PAIR = re.compile(
    r"""(?<![\w.$-])(?P<name>[A-Za-z_$][\w.$-]*)["']?\]?[ \t]*(?::=|=>|=(?!=)|:(?![:/]))[ \t]*"""
    r"""(?P<value>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`|[^\s,;#"'`(){}\[\]<>]+)""",
    re.ASCII,
)
MORE = re.compile(r"""[ \t]*\+[ \t]*("(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|[A-Za-z_$][\w.$-]*)""", re.ASCII)
NAME = re.compile(r"[A-Za-z_$][\w.$-]*", re.ASCII)
CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def name_score(name: str) -> float:
    """Sensitivity of a target name: the parts of ``dbPassword``, ``API_KEY`` or ``client-secret``, at most 1.5."""
    parts = [p.lower() for p in CAMEL.findall(name.rpartition(".")[2])]
    return min(1.5, sum(NAME_PARTS.get(p, 0.0) for p in dict.fromkeys(parts)))


def literal_score(value: str) -> float:
    """0 for short, uniform or placeholder values, up to 1 for long mixed ones."""
    if len(value) < MIN_LITERAL or " " in value or PLACEHOLDER.search(value):
        return 0.0
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return 0.0 if bits < MIN_BITS else min(1.0, bits / 8 + kinds / 8 + min(len(value), 32) / 128)


def _pairs(text: str) -> Iterator[tuple[str, int, list[tuple[int, int]]]]:
    """Name, place and the spans of the parts of every value."""
    for m in PAIR.finditer(text):
        at, parts = m.end(), [(m.start("value"), m.end("value"))]
        while more := MORE.match(text, at):
            parts.append(more.span(1))
            at = more.end()
        yield m["name"], m.start("name"), parts


def literal_spans(text: str) -> list[tuple[int, int, str]]:
    # Per name its values in order: (place, value, spans of the literals in it).
    values: dict[str, list[tuple[int, str, list[tuple[int, int]]]]] = {}
    refers: dict[str, list[str]] = {}
    joined = []
    for name, place, parts in _pairs(text):
        if len(parts) > 1:
            joined.append((name, place, parts))
            continue
        [(start, end)] = parts
        if text[start] in "\"'`":
            start, end = start + 1, end - 1
        elif NAME.fullmatch(text, start, end) and start != place:
            refers.setdefault(name, []).append(text[start:end])  # a bare word, unless it names another pair
        values.setdefault(name, []).append((place, text[start:end], [(start, end)]))
    for name, place, parts in joined:
        value, spans = "", []
        for start, end in parts:
            if text[start] in "\"'`":
                value, spans = value + text[start + 1 : end - 1], [*spans, (start + 1, end - 1)]
            elif known := values.get(text[start:end]):
                before = [v for v in known if v[0] < place]
                _, more, its = before[-1] if before else known[0]
                value, spans = value + more, spans + its
        values.setdefault(name, []).append((place, value, spans))
        values[name].sort(key=lambda v: v[0])
    found = set()
    for name in values:
        weight = name_score(name)
        if not weight:
            continue
        seen, open_names = {name}, [name]
        while open_names:  # constants that reach this name along references
            for other in refers.get(open_names.pop(), ()):
                if other in values and other not in seen:
                    seen.add(other)
                    open_names.append(other)
        for holder in seen:
            for _, value, spans in values[holder]:
                score = literal_score(value)
                if value not in values and score and weight + score >= MIN_SCORE:
                    found.update((start, end, "literal") for start, end in spans if end > start)
    return list(found)


def all_spans(text: str) -> list[tuple[int, int, str]]:
    return sorted(base_spans(text) + literal_spans(text), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``spans`` for every row."""
    bounded_batches(docs.sparkSession)
    chosen = docs.select(*keep, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep))
            may = pc.fill_null(pc.match_substring_regex(texts, MAY_HOLD), False).to_numpy(zero_copy_only=False)
            spans = [
                [{"kind": k, "start": a, "end": b} for a, b, k in all_spans(texts[i].as_py())] if hit else []
                for i, hit in enumerate(may)
            ]
            columns = [*batch.columns[: len(keep)], pa.array(spans, type=SPANS)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "spans"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(run, f"{kept}, spans array<struct<kind:string,start:int,end:int>>")
