"""Conversation structure repair: the cheapest edits that give every conversation the roles ``(s?(ua)+)?``.

Each row is kept, reroled (to user or assistant) or deleted, and empty user or assistant rows may be inserted anywhere.
The plan of a conversation is one integer minimum: a weight holds the cost in its high digits and, below them, one
fixed-width digit for each audit letter in order, with zeros after the last one. A letter put before a sequence moves
the digits down by one place, so the least weight is the cheapest plan, and the ASCII-least among them. The audit also
says which roles are meant, as the wanted ones follow from what has been emitted.

How it runs: rows are narrowed to a symbol each (role initial and first fault) before any order is needed. Equal rows
are folded, first occurrences come from one aggregate, positions from range partitions, so no conversation has to fit
into a task. Blocks of ``BLOCK`` symbols are solved in parallel, as tables of the least weight from each state to each
state, and a conversation's tables are composed from its last block to its first; the audit, a byte a row, is the only
thing that grows. The repaired rows stream through a task in order, beside their audit.

Defined cases: a null role or text counts as one space; rows of a null conversation form one; null turns come first;
rows of equal turn are ordered by role, then by the digest of their text; repeated rows are duplicates; an empty text
is blank; an empty table gives no rows; further columns are passed over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyloom.llm.batches import bounded_batches
from supplyloom.operators.position import with_position
from supplyloom.storage import materialise

#: Symbols solved at once.
BLOCK = 1024
WHITE = " \t\n\x0b\f\r"
BLANK = r"[^\x20\x09-\x0D]"
#: Digits of the letters, in ASCII order; zero ends an audit.
CODE = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTER = {v: k for k, v in CODE.items()}
DIGIT = 3
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
LEGAL = {"su", "ua", "au"}

# States: nothing emitted yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
ACCEPTED = (START, ASSISTANT)


def wanted(state: int) -> tuple[str, int]:
    """The initial that a user or assistant row must have here, and the state after it."""
    return ("a", ASSISTANT) if state == USER else ("u", USER)


# --- integer weights


def weight_of(cost: int, audit: str, width: int) -> int:
    digits = int("0" + "".join(str(CODE[letter]) for letter in audit), 1 << DIGIT)
    return (cost << DIGIT * width) | digits << DIGIT * (width - len(audit))


def plan_of(weight: int, width: int) -> tuple[int, str]:
    cost, digits = weight >> DIGIT * width, weight & ((1 << DIGIT * width) - 1)
    text = f"{digits:0{width}o}" if width else ""  # an octal digit a letter
    return cost, "".join(LETTER[int(d)] for d in text.rstrip("0"))


def least(*weights: int | None) -> int | None:
    return min((w for w in weights if w is not None), default=None)


def solve(symbols: str, terminal: list[int | None], width: int, at_end: bool) -> list[int | None]:
    """The least weight of each state before ``symbols``, given those of the states behind them (without letters).

    ``s u a x`` is a sound row with that initial (x: another one), upper case a truncated row, ``d`` one to delete.
    Rows may be inserted before each symbol and, with ``at_end``, behind the last.
    """
    bits = DIGIT * width
    mask = (1 << bits) - 1

    def before(weight: int | None, cost: int, letter: str) -> int | None:
        if weight is None:
            return None
        return ((weight >> bits) + cost << bits) | CODE[letter] << (bits - DIGIT) | (weight & mask) >> DIGIT

    def with_inserts(plain: list[int | None]) -> list[int | None]:
        found = plain
        for _ in range(2):  # a third row in a run of inserts leads back to the state after the first
            found = [least(plain[q], before(found[wanted(q)[1]], INSERT, "I")) for q in STATES]
        return found

    after = with_inserts(terminal) if at_end else terminal
    for symbol in reversed(symbols):
        plain = []
        for state in STATES:
            options = [before(after[state], DELETE, "D")]
            if symbol != "d":
                initial, more = symbol.lower(), TRUNCATED * symbol.isupper()
                letter, to = wanted(state)
                same = initial == letter
                options.append(before(after[to], more + (0 if same else REROLE), "K" if same else "R"))
                if initial == "s" and state == START:
                    options.append(before(after[SYSTEM], more, "K"))
            plain.append(least(*options))
        after = with_inserts(plain)
    return after


def block_table(symbols: str, first: bool, last: bool) -> list[dict]:
    """``begin, end, cost, audit``: the best plan of a block from state to state; the last block's ``end`` is START."""
    if len(symbols) > 64:
        return _table(symbols, first, last)
    return _known_table(symbols, first, last)


def _table(symbols: str, first: bool, last: bool) -> list[dict]:
    width, rows = 3 * len(symbols) + 2, []
    for end in [START] if last else STATES:
        goals = ACCEPTED if last else (end,)
        found = solve(symbols, [0 if q in goals else None for q in STATES], width, last)
        for begin in [START] if first else STATES:
            if found[begin] is not None:
                cost, audit = plan_of(found[begin], width)
                rows.append({"begin": begin, "end": end, "cost": cost, "audit": audit})
    return rows


@lru_cache(1 << 14)
def _known_table(symbols: str, first: bool, last: bool) -> list[dict]:
    return _table(symbols, first, last)


def compose(table: list[dict], behind: dict[int, tuple[int, str]]) -> dict[int, tuple[int, str]]:
    """Best plans from each state through a block and on to the end, given those behind the block."""
    joined: dict[int, list[tuple[int, str]]] = {}
    for way in table:
        if way["end"] in behind:
            cost, audit = behind[way["end"]]
            joined.setdefault(way["begin"], []).append((way["cost"] + cost, way["audit"] + audit))
    found = {}
    for begin, plans in joined.items():
        width = max(len(audit) for _, audit in plans)
        found[begin] = plan_of(min(weight_of(cost, audit, width) for cost, audit in plans), width)
    return found


# --- rows


def damage(conversations: DataFrame) -> DataFrame:
    """Faults by the crc32 of ``conv_id:turn``, modulo 20; a null counts as one space."""
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = (
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.regexp_replace(spaced("text"), "[.!?]", ""))
        .otherwise(spaced("text"))
    )
    return conversations.where(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(spaced("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def _keyed(rows: DataFrame) -> DataFrame:
    """``conv, none`` stand for the conversation (no nulls), ``text_id`` for the text."""
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.col("conv_id").isNull().alias("none"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        text.alias("text"),
        F.md5(text.cast("binary")).alias("text_id"),
    )


def _symbols(keyed: DataFrame) -> DataFrame:
    """One row per row: its place in its conversation, symbol, role initial and first fault."""
    last = F.right(F.rtrim(F.col("text"), F.lit(WHITE)), F.lit(1))
    rows = keyed.select(
        "conv", "none", "turn", "role", "text_id",
        (~F.col("text").rlike(BLANK)).alias("blank"),
        (~last.isin(".", "!", "?")).alias("cut"),
    )
    same = ["conv", "none", "role", "text_id"]
    folded = rows.groupBy(*same, "turn", "blank", "cut").agg(F.count(F.lit(1)).alias("n"))
    folded = materialise(folded, "turns")
    # Of each role and text the first turn, null before all; at most one row per folded row, so no key is hot.
    firsts = folded.groupBy(*same).agg(F.min(F.struct(F.col("turn").isNotNull().alias("told"), "turn")).alias("first"))
    firsts = firsts.select(*[F.col(c).alias(f"first_{c}") for c in same], F.col("first.turn").alias("first_turn"))
    met = F.lit(True)
    for name in (*same, "turn"):
        met = met & F.col(name).eqNullSafe(F.col(f"first_{name}"))
    marked = folded.join(firsts, met, "left").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    seen = (F.col("copy") > 1) | F.col("first_conv").isNull()
    fault = F.when(F.col("blank"), "b").when(seen, "d").when(F.col("cut"), "t").otherwise("-")
    initial = F.left("role", F.lit(1))
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    symbol = F.when(fault.isin("b", "d"), "d").when(fault == "t", F.upper(initial)).otherwise(initial)
    chosen = marked.select(
        "conv", "none", "turn", "role", "text_id", "copy", symbol.alias("symbol"), initial.alias("initial"), fault.alias("fault")
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text_id"), F.col("copy")]
    return with_position(chosen, order, ["none", "conv"], name="at", total="rows")


WAYS = "array<struct<begin:int,end:int,cost:long,audit:string>>"
SOLVED = f"none boolean, conv long, block long, head string, tail string, counts array<long>, ways {WAYS}"
PLANS = "none boolean, conv long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _illegal(initials: str) -> int:
    return sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1))


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("none", pa.bool_()), ("conv", pa.int64()), ("block", pa.int64()), ("head", pa.string()), ("tail", pa.string()),
         ("counts", pa.list_(pa.int64())),
         ("ways", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))]
    )
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            ways = block_table(r["symbols"], r["block"] == 0, (r["block"] + 1) * BLOCK >= r["rows"])
            counts = [r["blank"], r["duplicate"], r["truncated"], _illegal(r["initials"])]
            ends = {"head": r["initials"][0], "tail": r["initials"][-1], "counts": counts, "ways": ways}
            rows.append({"none": r["none"], "conv": r["conv"], "block": r["block"]} | ends)
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a conversation come last to first."""
    schema = pa.schema(
        [("none", pa.bool_()), ("conv", pa.int64())]
        + [(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal", "cost")]
        + [("audit", pa.string())]
    )
    behind: dict[int, tuple[int, str]] = {}
    counts, head = [0] * 4, ""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            if not behind:
                behind, counts, head = {START: (0, "")}, [0] * 4, ""
            counts = [a + b for a, b in zip(counts, r["counts"])]
            counts[3] += bool(head) and r["tail"] + head not in LEGAL
            behind, head = compose(r["ways"], behind), r["head"]
            if r["block"] == 0:
                cost, audit = behind[START]
                names = ("blank", "duplicate", "truncated", "illegal")
                rows.append({"none": r["none"], "conv": r["conv"], "cost": cost, "audit": audit} | dict(zip(names, counts)))
                behind = {}
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def plan_repairs(rows: DataFrame) -> DataFrame:
    """Per conversation with rows: ``conv, none, blank, duplicate, truncated, illegal, cost, audit``."""
    bounded_batches(rows.sparkSession)
    placed = _symbols(_keyed(rows))
    joined = lambda name: F.array_join(F.transform(F.col("s"), lambda x: x[name]), "")
    count = lambda kind: F.count(F.when(F.col("fault") == kind, 1))
    blocks = (
        placed.groupBy("none", "conv", F.expr(f"at div {BLOCK}").alias("block"))
        # At most BLOCK rows.
        .agg(
            F.array_sort(F.collect_list(F.struct("at", "symbol", "initial"))).alias("s"),
            F.first("rows").alias("rows"),
            count("b").alias("blank"), count("d").alias("duplicate"), count("t").alias("truncated"),
        )
        .select("none", "conv", "block", "rows", "blank", "duplicate", "truncated", joined("symbol").alias("symbols"), joined("initial").alias("initials"))
    )
    solved = blocks.mapInArrow(_solved, SOLVED)
    ordered = solved.repartition("none", "conv").sortWithinPartitions("none", "conv", F.col("block").desc())
    return ordered.mapInArrow(_composed, PLANS)


REPAIRED = "none boolean, conv long, role string, text string"
_OUT = pa.schema([("none", pa.bool_()), ("conv", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a conversation in order, its audit first -> its repaired rows."""
    key, audit, at, state = None, "", 0, START

    def inserts() -> Iterator[dict]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            yield row("", "")
            at += 1

    def row(role: str, text: str) -> dict:
        """A row with the wanted role, or with its own where that is given."""
        nonlocal state
        if role[:1] == "s" and state == START:
            state = SYSTEM
        else:
            letter, state = wanted(state)
            role = role or ("user" if letter == "u" else "assistant")
        return {"none": key[0], "conv": key[1], "role": role, "text": text}

    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            if r["audit"] is not None:
                rows += inserts()
                key, audit, at, state = (r["none"], r["conv"]), r["audit"], 0, START
                continue
            rows += inserts()
            letter = audit[at]
            at += 1
            if letter != "D":
                rows.append(row(r["role"] if letter == "K" else "", r["text"]))
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_OUT)
    rest = list(inserts())
    if rest:
        yield pa.RecordBatch.from_pylist(rest, schema=_OUT)


def repaired_rows(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """``none, conv, role, text`` of the repaired conversations; each lies in one partition, in order."""
    texts = _keyed(rows).withColumns({"kind": F.lit(1), "audit": F.lit(None).cast("string")})
    empty = {c: F.lit("") for c in ("role", "text", "text_id")}
    audits = plans.select("none", "conv", "audit").withColumns(empty | {"kind": F.lit(0), "turn": F.lit(None).cast("long")})
    both = texts.unionByName(audits).repartition("none", "conv")
    ordered = both.sortWithinPartitions("none", "conv", "kind", F.col("turn").asc_nulls_first(), "role", "text_id")
    return ordered.select("none", "conv", "role", "text", "audit").mapInArrow(_edited, REPAIRED)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("none", pa.bool_()), ("conv", pa.int64()), ("repaired_sha256", pa.string())])
    key = state = None
    for batch in batches:
        rows = []
        for none, conv, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (none, conv):
                if key:
                    rows.append((*key, state.hexdigest()))
                key, state = (none, conv), hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], schema=schema)
    if key:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, state.hexdigest())], schema=schema)


def digest_repairs(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conversation of ``conversations``: the faults and the repair of its ``rows``, and a digest of the result."""
    plans = materialise(plan_repairs(rows), "plans")
    texts = repaired_rows(rows, plans).mapInArrow(_digested, "none boolean, conv long, repaired_sha256 string")
    turns = _keyed(rows).groupBy("none", "conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    )
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    ids = ids.withColumns({"none": F.col("conv_id").isNull(), "conv": F.coalesce("conv_id", F.lit(0))})
    out = ids
    for part in (plans, turns, texts):
        out = out.join(part, ["none", "conv"], "left")
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    nothing = hashlib.sha256().hexdigest()
    counts: list[Column] = [zero(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(
        "conv_id",
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
