"""Conversation prefix trie: adaptive radix trees over fixed-width big-endian turn ids.

A turn's id is the 128-bit digest of its role and text, so a conversation is a byte string of ``WIDTH`` bytes a turn.
The byte strings are range-partitioned and sorted, and each task puts runs of ``RUN`` of them into an adaptive radix
tree: inner nodes grow through layouts of 4, 16, 48 and 256 children, and paths are compressed. Only byte depths that
are a whole number of turns emit nodes of the trie.

A node whose members all lie inside a run is finished there, with its subtree's sums, and needs no shuffle. The others
are prefixes of a run's first or last string, as equal prefixes are neighbours in the order: they leave as partial rows,
are added up by their digest, and their subtree sums are formed by doubling jumps to ancestors, a logarithmic number of
rounds in the depth. Numbers of equal conversations or of those below one first turn bound nothing: they only spread
over more runs. Conversations longer than ``SEGMENT`` turns are cut there; a later segment's string starts with a digest
of all turns before it, and its tree hangs below the node where the segment before ends.

Defined cases: a null role or text counts as empty; null turns come first; turns of equal number are ordered by role,
then by the digest of their text; rows without a conv_id belong to no conversation and are passed over; repeated rows
are turns of their own; an empty table gives no rows; further columns are passed over.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyloom.llm.batches import bounded_batches
from supplyloom.operators.joins import lookup
from supplyloom.operators.position import with_position
from supplyloom.storage import materialise, rows_of

#: Bytes of a turn id; turns of a segment; conversations and turns in one tree.
WIDTH, SEGMENT, RUN, RUN_TURNS = 16, 1024, 20_000, 100_000
#: What a first segment's string starts with; later ones start with a digest.
FIRST = bytes(WIDTH)
#: Conversations that share a head come in hundreds; of a head's turns, fewer than HEAD are taken.
HUNDRED, HEAD = 100, 6


# --- the tree


class Node:
    """A compressed path, the rows that end behind it, and children by their first byte in one of four layouts.

    Up to 4 or 16 children: sorted bytes beside a list. Up to 48: a table of 256 places in a list. Beyond: 256 slots.
    """

    __slots__ = ("path", "ends", "layout", "index", "kids")

    def __init__(self, path: bytes):
        self.path, self.ends, self.layout = path, [], 4
        self.index, self.kids = bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.layout <= 16:
            at = bisect_left(self.index, byte)
            return self.kids[at] if at < len(self.index) and self.index[at] == byte else None
        if self.layout == 48:
            return self.kids[self.index[byte] - 1] if self.index[byte] else None
        return self.kids[byte]

    def put(self, byte: int, node: Node) -> None:
        """Adds a child, or replaces the one of that byte."""
        if self.layout <= 16:
            at = bisect_left(self.index, byte)
            if at < len(self.index) and self.index[at] == byte:
                self.kids[at] = node
            elif len(self.kids) < self.layout:
                self.index.insert(at, byte)
                self.kids.insert(at, node)
            else:
                self.grow()
                self.put(byte, node)
        elif self.layout == 48:
            if self.index[byte]:
                self.kids[self.index[byte] - 1] = node
            elif len(self.kids) < 48:
                self.kids.append(node)
                self.index[byte] = len(self.kids)
            else:
                self.grow()
                self.put(byte, node)
        else:
            self.kids[byte] = node

    def grow(self) -> None:
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            table = bytearray(256)
            for place, byte in enumerate(self.index):
                table[byte] = place + 1
            self.layout, self.index = 48, table
        else:
            slots: list[Node | None] = [None] * 256
            for byte, place in enumerate(self.index):
                if place:
                    slots[byte] = self.kids[place - 1]
            self.layout, self.index, self.kids = 256, bytearray(), slots

    def children(self) -> list[Node]:
        """In any order."""
        return [k for k in self.kids if k is not None] if self.layout == 256 else self.kids


def shared(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0
    while n - low > 1:  # a[:low] agrees, a[:n] does not
        middle = (low + n) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            n = middle
    return low


def insert(root: Node, key: bytes, row: int) -> None:
    node, at, above, byte = root, 0, None, 0
    while True:
        same = shared(node.path, key[at : at + len(node.path)])
        if same < len(node.path):
            split = Node(node.path[:same])
            split.put(node.path[same], node)
            node.path = node.path[same + 1 :]
            above.put(byte, split)
            node = split
        at += same
        if at == len(key):
            node.ends.append(row)
            return
        above, byte = node, key[at]
        below = node.child(byte)
        if below is None:
            leaf = Node(key[at + 1 :])
            leaf.ends.append(row)
            node.put(byte, leaf)
            return
        node, at = below, at + 1


# --- nodes of the trie in a run

OPEN = "open boolean, node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, chars long, "
OPEN += "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ends string"
_FIELDS = [
    ("open", pa.bool_()), ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("chars", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("ends", pa.string()),
]
_SCHEMA = pa.schema(_FIELDS)


class Run:
    """Sorted rows ``(string, conv_id, segment, last, above, chars)`` -> nodes as dictionaries."""

    def __init__(self, rows: list[tuple]):
        self.rows, self.found = rows, []
        self.digests: dict[int, list[bytes]] = {}

    def digest(self, row: int, turns: int) -> bytes:
        """Of a row's string up to that many turns; all of a row's are made in one pass."""
        if row not in self.digests:
            key, state, all_of = self.rows[row][0], hashlib.md5(), []
            for at in range(0, len(key), WIDTH):
                state.update(key[at : at + WIDTH])
                all_of.append(state.copy().digest())
            self.digests = {row: all_of} | {r: d for r, d in self.digests.items() if r in (0, len(self.rows) - 1)}
        return self.digests[row][turns]

    def nodes(self) -> list[dict]:
        root = Node(b"")
        for i, row in enumerate(self.rows):
            insert(root, row[0], i)
        # A tree may be as deep as its strings are long: children before their node, without recursion.
        order, stack = [], [(root, 0)]
        while stack:
            node, begin = stack.pop()
            order.append((node, begin))
            behind = begin + len(node.path) + 1
            stack += [(kid, behind) for kid in node.children()]
        sums: dict[int, tuple] = {}
        for node, begin in reversed(order):
            # (rows from, rows to, smallest conv_id, rows, goes on, children, leaves, saved, nodes that wait for their parent)
            low, high, smallest, n, more, kids, leaves, saved, waiting = len(self.rows), -1, None, 0, False, 0, 0, 0, []
            for kid in node.children():
                a, b, s, m, g, k, e, t, w = sums.pop(id(kid))
                low, high, n, more = min(low, a), max(high, b), n + m, more or g
                smallest = s if smallest is None else min(smallest, s)
                kids, leaves, saved = kids + k, leaves + e, saved + t
                waiting = waiting + w if len(waiting) >= len(w) else w + waiting
            here = []
            for row in node.ends:
                low, high, n = min(low, row), max(high, row), n + 1
                conv = self.rows[row][1]
                smallest = conv if smallest is None else min(smallest, conv)
                if self.rows[row][3]:
                    here.append(conv)
                else:
                    more = True
            end = begin + len(node.path)
            # The byte that leads here belongs to the path as well.
            for depth in range(end - end % WIDTH, max(begin, 1) - 1, -WIDTH):
                ends, here = (here, []) if depth == end else ([], here)
                state = (low, high, smallest, n, more, kids, leaves, saved, waiting)
                kids, leaves, saved, waiting = self.emit(depth // WIDTH - 1, ends, *state)
            sums[id(node)] = (low, high, smallest, n, more, kids, leaves, saved, waiting)
        return self.found

    def emit(self, turns: int, ends, low, high, smallest, n, more, kids, leaves, saved, waiting) -> tuple:
        """The node that many turns down row ``low``'s string, if it is one; what its parent then adds up."""
        key, _, segment, _, above, chars = self.rows[low]
        if turns == 0 and segment:  # where a later segment begins: the node itself is the former one's
            for child in waiting:
                child["parent"] = above
            sums = {"n_convs": 0, "n_children": kids, "n_leaves": leaves, "saved_tokens": saved}
            self.found.append(dict.fromkeys(_SCHEMA.names) | {"open": True, "node": above} | sums)
            return 0, 0, 0, []
        # Only what lies wholly inside the run is known to be complete.
        is_open = low == 0 or high == len(self.rows) - 1 or more
        last = chars[turns - 1] if turns else 0
        row = dict.fromkeys(_SCHEMA.names)
        row |= {"open": is_open, "depth": segment * SEGMENT + turns, "conv_id": smallest, "n_convs": n, "chars": last, "n_children": kids}
        for child in waiting:
            if is_open:
                child["parent"] = self.digest(low, turns)
            else:
                child["parent_conv_id"] = smallest
        self.found.append(row)
        text = ",".join(map(str, ends))
        if is_open:
            row |= {"node": self.digest(low, turns), "n_leaves": leaves, "saved_tokens": saved, "ends": text if ends else None}
            return 0, 0, 0, [row]
        row |= {
            "n_leaves": leaves or 1,
            "saved_tokens": saved + (n - 1) * last,
            "ends_sha256": hashlib.sha256(text.encode()).hexdigest(),
        }
        return 1, row["n_leaves"], row["saved_tokens"], [row]


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    turns = 0

    def nodes() -> Iterator[pa.RecordBatch]:
        found = Run(held).nodes()
        for at in range(0, len(found), 10_000):
            yield pa.RecordBatch.from_pylist(found[at : at + 10_000], schema=_SCHEMA)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            held.append(row)
            turns += len(row[-1])
            if len(held) >= RUN or turns >= RUN_TURNS:
                yield from nodes()
                held, turns = [], 0
    if held:
        yield from nodes()


# --- conversations as strings


def _turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, at, id, chars``: the turns in order; ``id`` in hexadecimal digits, ``chars`` code points."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("id"),
        F.char_length(text).cast("long").alias("chars"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("id")]
    return with_position(turns, order, ["conv_id"], name="at").select("conv_id", "at", "id", "chars")


def head_length(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEAD).cast("long")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, total, at, id, chars`` of all turns of the rebuilt conversations; a turnless one has a row without ``at``."""
    turns = _turns(conversations)
    turn = F.struct("at", "id", "chars")
    # At most HEAD - 1 turns a conversation.
    heads = (
        turns.where((F.col("conv_id") % HUNDRED == 0) & (F.col("at") < HEAD - 1))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.array_sort(F.collect_list(turn)).alias("head"))
    )
    lengths = turns.groupBy("conv_id").agg((F.max("at") + 1).alias("own"))
    with_base = lengths.withColumns({"base": F.col("conv_id") - F.col("conv_id") % HUNDRED, "h": head_length(F.col("conv_id"))})
    nothing = F.array().cast("array<struct<at:bigint,id:string,chars:bigint>>")
    head = F.slice(F.coalesce("head", nothing), F.lit(1), F.col("h").cast("int"))
    convs = with_base.join(heads, "base", "left").withColumn("head", head)
    given = F.size("head").cast("long")
    total = given + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    convs = materialise(convs.select("conv_id", "head", given.alias("given"), total.alias("total")), "conversations")
    n = rows_of(convs)
    own = lookup(turns, convs.select("conv_id", "given", "total"), "conv_id", 32, F.col("at"), rows=n)
    shift = F.col("given") - head_length(F.col("conv_id"))
    own = own.where(F.col("at") >= head_length(F.col("conv_id"))).withColumn("at", F.col("at") + shift)
    names = ["conv_id", "total", "at", "id", "chars"]
    taken = convs.select("conv_id", "total", F.inline("head"))
    none = convs.where("total = 0").select("conv_id", "total", *[F.lit(None).cast(t).alias(c) for c, t in (("at", "long"), ("id", "string"), ("chars", "long"))])
    return own.select(*names).unionByName(taken.select(*names)).unionByName(none)


def _strings(turns: DataFrame) -> DataFrame:
    """``string, conv_id, segment, last, above, chars`` per segment of a conversation."""
    segment = F.coalesce(F.expr(f"at div {SEGMENT}"), F.lit(0)).cast("long")
    grouped = turns.groupBy("conv_id", segment.alias("segment")).agg(
        F.max("total").alias("total"),
        # At most SEGMENT turns.
        F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "id", "chars")))).alias("s"),
    )
    pieces = materialise(
        grouped.select(
            "conv_id", "segment", "total",
            F.array_join(F.transform("s", lambda t: t["id"]), "").alias("ids"),
            F.transform("s", lambda t: t["chars"]).alias("chars"),
        ),
        "segments",
    )
    last = (F.col("segment") + 1) * SEGMENT >= F.col("total")
    columns = ["conv_id", "segment", last.alias("last"), "above", "chars"]
    zeros, none = F.lit(FIRST.hex()), F.lit(None).cast("binary")
    whole = pieces.where(F.col("total") <= SEGMENT).withColumn("above", none)
    whole = whole.select(F.unhex(F.concat(zeros, F.col("ids"))).alias("string"), *columns)
    # A later segment starts with the sums of two numbers of each segment before it: a digest of all of them, in order.
    # The windows run over segments, a row for every SEGMENT turns of a conversation.
    to_here = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    mark = F.md5(F.concat_ws(",", F.col("segment").cast("string"), "ids").cast("binary"))
    number = lambda at: F.conv(F.substring(mark, at, 15), 16, 10).cast("decimal(20,0)")
    long = pieces.where(F.col("total") > SEGMENT)
    told = long.withColumns({"a": F.sum(number(1)).over(to_here), "b": F.sum(number(16)).over(to_here)})
    start = F.when(F.col("segment") == 0, zeros).otherwise(F.md5(F.concat_ws(",", "segment", "a", "b").cast("binary")))
    told = told.withColumn("full", F.concat(start, F.col("ids")))
    one_back = Window.partitionBy("conv_id").orderBy("segment")
    told = told.withColumn("above", F.lag(F.unhex(F.md5(F.unhex("full")))).over(one_back))
    return whole.unionByName(told.select(F.unhex("full").alias("string"), *columns))


# --- nodes that several runs share


def _subtree_sums(nodes: DataFrame, sums: list[str]) -> DataFrame:
    """``node`` and ``sums`` over each node's subtree, of rows ``node, parent`` and values of those names.

    Round k adds what lies 2**k to 2**(k+1) - 1 levels below; ``up`` is the ancestor 2**k levels above.
    """
    state = nodes.select("node", F.col("parent").alias("up"), *sums)
    while True:
        state = materialise(state, "sums")
        if state.where(F.col("up").isNotNull()).isEmpty():
            return state.select("node", *sums)
        added = state.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("node")).agg(*[F.sum(s).alias(f"add_{s}") for s in sums])
        higher = materialise(state.select(F.col("node").alias("up"), F.col("up").alias("next")), "jumps")
        state = lookup(state, higher, "up", 64, F.col("node"), "left", rows=rows_of(higher))
        state = state.join(added, "node", "left")
        totals = [(F.col(s) + F.coalesce(f"add_{s}", F.lit(0))).alias(s) for s in sums]
        state = state.select("node", F.col("next").alias("up"), *totals)


def _end_digests(partial: DataFrame) -> DataFrame:
    """``node, ends_sha256``: runs hold a node's ends in order, and each sends its part as one text."""
    parts = partial.where(F.col("ends").isNotNull()).select("node", "ends", F.substring_index("ends", ",", 1).cast("long").alias("first"))
    ordered = parts.repartition("node").sortWithinPartitions("node", "first").select("node", "ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = state = None
        for batch in batches:
            done = []
            for own, ends in zip(*(c.to_pylist() for c in batch.columns)):
                if own != node:
                    if state:
                        done.append((node, state.hexdigest()))
                    node, state = own, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ends.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["node", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])

    return ordered.mapInArrow(run, "node binary, ends_sha256 string")


def _merged(partial: DataFrame) -> DataFrame:
    """The nodes that runs share, added up; ``node`` and ``parent`` are kept."""
    added = materialise(
        partial.groupBy("node").agg(
            *[F.max(c).alias(c) for c in ("parent", "depth", "chars")],
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        ),
        "open",
    )
    below = added.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("more"))
    full = added.join(below, "node", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0)
    full = full.withColumns({"n_leaves": F.col("n_leaves") + leaf, "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars")})
    full = materialise(full.drop("more"), "full")
    sums = _subtree_sums(full, ["n_leaves", "saved_tokens"])
    empty = F.lit(hashlib.sha256().hexdigest())
    return (
        full.drop("n_leaves", "saved_tokens")
        .join(sums, "node")
        .join(_end_digests(partial), "node", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", empty))
    )


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations: ``COLUMNS``."""
    bounded_batches(conversations.sparkSession)
    strings = _strings(rebuilt(conversations))
    ordered = strings.repartitionByRange("string", "conv_id").sortWithinPartitions("string", "conv_id")
    found = materialise(ordered.select("string", "conv_id", "segment", "last", "above", "chars").mapInArrow(_trees, OPEN), "nodes")
    shared_nodes = materialise(_merged(found.where("open")), "shared")
    parents = shared_nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("shared_conv_id"))
    parents = materialise(parents, "parents")
    names = [c for c in COLUMNS if c != "parent_conv_id"]
    closed = found.where(~F.col("open")).select(*names, "parent_conv_id", "parent")
    known = closed.where(F.col("parent").isNull()).select(*COLUMNS)
    waiting = closed.where(F.col("parent").isNotNull()).drop("parent_conv_id")
    waiting = waiting.unionByName(shared_nodes.where(F.col("parent").isNotNull()).select(*names, "parent"))
    placed = lookup(waiting, parents, "parent", 64, F.col("conv_id"), rows=rows_of(parents), store=True)
    placed = placed.withColumnRenamed("shared_conv_id", "parent_conv_id").select(*COLUMNS)
    root = shared_nodes.where(F.col("parent").isNull()).withColumn("parent_conv_id", F.lit(None).cast("long")).select(*COLUMNS)
    return known.unionByName(placed).unionByName(root)
