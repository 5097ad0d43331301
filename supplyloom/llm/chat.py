"""Chat formatting by columnar byte assembly.

Turns go through the job as Arrow columns. For a batch, numpy computes the length of every segment (header, content,
footer), the cumulative offsets and the scatter indices, and copies headers and contents into one preallocated buffer
from which the output column is cut without another copy.

A turn reads ``<|turn|>role\\n`` + text + ``<|end|>\\n``. Control strings inside texts and roles (those of this template
and the common ``<s> </s> [INST] [/INST]``) get a backslash after their opening character; one that has backslashes
there already gets one more, so ``unescape`` restores every text. In a role, backslashes and line ends are escaped too.

Rows are range-partitioned by (conv_id, turn), so a conversation of any length is spread over tasks; each task gives
one output row per run of turns of a conversation (``shard, part`` order them), with the byte ranges under the loss
mask: the texts of ``assistant`` turns. Reading back streams a conversation's parts in order through running hashes,
which a digest over the whole conversation requires; no conversation is ever held in memory.

Defined cases: null texts and roles count as empty; turns of equal number are ordered by role, then text, null numbers
come first; rows of a null conversation form one; an empty table gives no rows; further columns are passed over.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyloom.llm.batches import bounded_batches

TURN, END, LOSS_ROLE = b"<|turn|>", b"<|end|>\n", "assistant"
CONTROL = r"(?:\||/?s>|/?INST\])"
ESCAPE = re.compile(rb"([<\[]\\*)(?=" + CONTROL.encode() + rb")")
UNESCAPE = re.compile(rb"([<\[]\\*)\\(?=" + CONTROL.encode() + rb")")
PARSE = re.compile(rb"<\|turn\|>([^\n]*)\n(.*?)<\|end\|>\n", re.DOTALL)
#: Bytes of an output row, about: a batch of turns makes rows of this size at most, but for longer single turns.
PART_BYTES = 1 << 20

FORMATTED = "conv_id long, shard int, part long, n_turns int, formatted binary, loss array<struct<start:long,end:long>>"


def escape(text: bytes) -> bytes:
    return ESCAPE.sub(rb"\1\\", text)


def unescape(text: bytes) -> bytes:
    return UNESCAPE.sub(rb"\1", text)


def role_header(role: str) -> bytes:
    safe = role.encode().replace(b"\\", b"\\\\").replace(b"\n", b"\\n")
    return TURN + escape(safe) + b"\n"


def read_role(header: bytes) -> bytes:
    return re.sub(rb"\\(.)", lambda m: b"\n" if m[1] == b"n" else m[1], unescape(header))


def scatter(out: np.ndarray, starts: np.ndarray, source: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> None:
    """Copy ``source[begins[i] : begins[i] + sizes[i]]`` to ``out[starts[i] :]`` for all i at once."""
    total = int(sizes.sum())
    within = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(starts, sizes) + within] = source[np.repeat(begins, sizes) + within]


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, beginnings and sizes of a string column without nulls."""
    column = column.cast(pa.large_binary())
    _, offsets, values = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.empty(0, np.uint8)
    return data, at[:-1], np.diff(at)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One buffer of all turns; where turns start (one more than turns); start and end of each text in it."""
    marked = pc.match_substring_regex(texts, r"[<\[]\\*" + CONTROL)
    if pc.any(marked).as_py():
        texts = pa.array([escape(t.as_py().encode()) if m.as_py() else t.as_py().encode() for t, m in zip(texts, marked)], pa.large_binary())
    coded = roles.dictionary_encode()
    headers = [role_header(r) for r in coded.dictionary.to_pylist()]
    header_data = np.frombuffer(b"".join(headers) or b"\0", dtype=np.uint8)
    header_sizes = np.array([len(h) for h in headers], dtype=np.int64)
    which = coded.indices.to_numpy(zero_copy_only=False)
    header_begins = (np.cumsum(header_sizes) - header_sizes)[which]
    data, begins, sizes = _bytes_of(texts)

    segments = np.stack([header_sizes[which], sizes, np.full(len(sizes), len(END))], axis=1)
    ends = np.cumsum(segments).reshape(-1, 3)
    starts = ends - segments
    out = np.empty(int(ends[-1, 2]), dtype=np.uint8)
    scatter(out, starts[:, 0], header_data, header_begins, segments[:, 0])
    scatter(out, starts[:, 1], data, begins, sizes)
    out[starts[:, 2][:, None] + np.arange(len(END))] = np.frombuffer(END, dtype=np.uint8)
    return out, np.append(starts[:, 0], len(out)), starts[:, 1], ends[:, 1]


def format_conversations(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` -> rows of ``FORMATTED``."""
    bounded_batches(conversations.sparkSession)
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first()]
    ordered = turns.repartitionByRange(*keys).sortWithinPartitions(*keys, "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            out, starts, text_starts, text_ends = assemble(batch.column(2), batch.column(3))
            ids = batch.column(0)
            # Rows begin where the conversation changes or the size of a part is reached.
            keys = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
            nulls = pc.is_null(ids).to_numpy(zero_copy_only=False)
            turned = (keys[1:] != keys[:-1]) | (nulls[1:] != nulls[:-1])
            turned |= starts[1:-1] // PART_BYTES != starts[:-2] // PART_BYTES
            first = np.append(0, np.flatnonzero(turned) + 1)
            last = np.append(first[1:], batch.num_rows)
            offsets = pa.array(np.append(starts[first], len(out)), pa.int32()).buffers()[1]
            formatted = pa.Array.from_buffers(pa.binary(), len(first), [None, offsets, pa.py_buffer(out)])
            learned = pc.equal(batch.column(2), LOSS_ROLE).to_numpy(zero_copy_only=False)
            loss = [
                [{"start": int(text_starts[i] - starts[a]), "end": int(text_ends[i] - starts[a])} for i in range(a, b) if learned[i]]
                for a, b in zip(first, last)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(first)),
                    pa.array(np.full(len(first), shard), pa.int32()),
                    pa.array(np.arange(part, part + len(first)), pa.int64()),
                    pa.array(last - first, pa.int32()),
                    formatted,
                    pa.array(loss, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                names=["conv_id", "shard", "part", "n_turns", "formatted", "loss"],
            )
            part += len(first)

    return ordered.mapInArrow(run, FORMATTED)


def parse_turns(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """Roles and texts of a formatted part."""
    return [(read_role(m[1]), unescape(m[2])) for m in PARSE.finditer(formatted)]


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """Reads formatted rows back: turns from the template, the texts to learn from the mask."""
    by_conversation = F.col("conv_id").asc_nulls_first()
    ordered = formatted.repartition("conv_id").sortWithinPartitions(by_conversation, "shard", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, rows = None, None, []

        def finished() -> list[dict]:
            n, turns, chars, loss, size = state
            row = (current[0], n, turns.hexdigest(), chars, loss.hexdigest(), size)
            return [dict(zip(("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"), row))]

        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        for batch in batches:
            rows = []
            for conv_id, data, loss in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("conv_id", "formatted", "loss"))):
                if current != (conv_id.as_py(),):
                    rows += finished() if current else []
                    current, state = (conv_id.as_py(),), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                data = data.as_py()
                for role, text in parse_turns(data):
                    state[0] += 1
                    state[1].update(role + b"\n" + text + b"\n")
                for span in loss.as_py():
                    text = unescape(data[span["start"] : span["end"]])
                    state[2] += len(text.decode())
                    state[3].update(text)
                state[4] += len(data.decode())
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if current:
            yield pa.RecordBatch.from_pylist(finished(), schema=schema)

    return ordered.mapInArrow(run, DIGEST)
