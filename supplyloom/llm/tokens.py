"""Token ids in binary files: one zstandard dictionary, one frame per document, an index of offsets.

A token folder holds three Parquet tables, so that any store Spark can write will do and a failed task leaves nothing
behind:

- ``blocks``: documents in ascending doc_id order. A row is a block of documents: ``payload`` (their frames, one
  after the other) and its index ``doc_ids, offsets`` (one more than documents), ``starts`` (ids of the shard before
  the document), ``n_ids``, besides ``shard, block, first_id, last_id, dictionary``. The index is read without the
  payload by column pruning. A frame is the zstandard compression of the ids as little-endian unsigned integers of
  ``width`` bytes, with the shared dictionary, so a short document is read alone and still compresses well.
- ``shards``: per shard the ids in it and before it.
- ``dictionary``: the dictionary's bytes under its SHA-256, which every block names.

The dictionary is trained on a bounded sample (``SAMPLE_DOCS`` documents of at most ``SAMPLE_CHARS`` code points, by
hash of the id); it changes sizes only, never content.

Encoding splits a text where the tokenizer's own rules always split (single spaces and line ends between words,
punctuation after a word), has the tokenizers library encode each distinct piece once, and joins the results; other
white space goes through the library as a whole text. The result is that of encoding the whole text. Pieces of a slice
of texts are told apart by 128 bits of hash in numpy, and the ids of all of them are looked up and gathered at once.

Defined cases: a null or empty text has only the end id; equal ids lie side by side, ordered by text; null ids come
first; an empty table gives an empty folder that reads back as no rows.
"""

from __future__ import annotations

import hashlib
import os
import string
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from supplyloom.llm.batches import bounded_batches
from supplyloom.llm.words import mix, slices, text_bytes

SAMPLE_DOCS, SAMPLE_CHARS, DICTIONARY_BYTES = 1000, 65536, 65536
LEVEL = 3
ID = attrgetter("id")
#: Bytes of frames in a block, and of blocks in an Arrow batch; a longer document makes a block of its own.
BLOCK_BYTES, BATCH_BYTES = 1 << 18, 1 << 22
#: Pieces of a generation: a process remembers this one and the one before, some 70 MB.
REMEMBERED = 150_000

BLOCKS = pa.schema(
    [
        ("shard", pa.int32()),
        ("block", pa.int32()),
        ("first_id", pa.int64()),
        ("last_id", pa.int64()),
        ("dictionary", pa.string()),
        ("width", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("offsets", pa.list_(pa.int64())),
        ("starts", pa.list_(pa.int64())),
        ("n_ids", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)
BLOCKS_DDL = (
    "shard int, block int, first_id long, last_id long, dictionary string, width int, doc_ids array<long>, "
    "offsets array<long>, starts array<long>, n_ids array<long>, payload binary"
)

#: What may end a word and is then a piece of its own: ASCII punctuation but for the apostrophe.
TAIL = string.punctuation.replace("'", "")


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, other bytes for 256, 257, ..."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder(dict):
    """``encode(text)`` -> the ids' bytes. As a dict: piece after a space (or with its line end) -> bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.model = self.whole.model
        self.code = "H" if self.whole.get_vocab_size() <= 1 << 16 else "I"
        self.width = array(self.code).itemsize
        self.alphabet = byte_alphabet()
        self.before: dict[str, bytes] = {}
        self.table = PieceTable(self.width)

    def direct(self, text: str) -> bytes:
        return array(self.code, self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def word(self, core: str) -> bytes:
        """A space and letters, which the splitting rules leave whole: straight to the merges."""
        if core.isascii():
            mapped = self.alphabet[0x20] + core
        else:
            mapped = (" " + core).encode().decode("latin-1").translate(self.alphabet)
        return array(self.code, map(ID, self.model.tokenize(mapped))).tobytes()

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        if piece in self.before:
            self[piece] = self.before[piece]
            return self[piece]
        self[piece] = self.piece(piece)
        return self[piece]

    def piece(self, piece: str) -> bytes:
        """A piece behind a space (or with its line end), without memory."""
        core = piece.rstrip(TAIL)
        if core != piece and core[-1:].isalnum():
            return self.piece(core) + self.direct(piece[len(core) :])
        if core == piece and core.isalpha():
            return self.word(core)
        return self.direct(piece if piece[:1] == "\n" else " " + piece)

    def encode(self, text: str) -> bytes:
        # Other white space than single spaces and single line ends between words?
        if " ".join(text.split()) != text.replace("\n", " "):
            return self.direct(text)
        first, *rest = text.replace("\n", " \n").split(" ")
        return self.direct(first) + b"".join(map(self.__getitem__, rest))


#: Texts that are not words with single spaces or line ends between them (white space as Python splits at it).
UNEVEN = (
    r"^[ \n]|[ \n]\z|[ \n][ \n]|[\t\x0b\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
#: Bytes of a text that is encoded alone, piece by piece.
LONG_BYTES = 1 << 23
_draw = np.random.default_rng(20250311)
_BYTES = _draw.integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = [int(b) * 2 + 1 for b in _draw.integers(1, 1 << 62, 2)]
_BACKS = [pow(b, -1, 1 << 64) for b in _BASES]


@lru_cache(8)
def _powers(base: int, bits: int) -> np.ndarray:
    steps = np.full(1 << bits, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _unit_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every unit; equal bytes of another kind have others. None is zero in the first."""
    found, bits = [], max(20, int(len(data)).bit_length())
    for values, base, back in zip(_BYTES, _BASES, _BACKS):
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(values[data] * _powers(base, bits)[: len(data)], out=sums[1:])
        own = (sums[ends] - sums[starts]) * _powers(back, bits)[starts]
        found.append(mix(own + (4 * (ends - starts) + kind).astype(np.uint64)))
    return np.maximum(found[0], np.uint64(1)), found[1]


class PieceTable:
    """Ids of units by hash: open addressing in numpy arrays, looked up and filled for whole slices at once.

    Half full, it starts anew: a process holds some 50 MB.
    """

    BITS = 21

    def __init__(self, width: int):
        self.code = np.dtype(f"<u{width}")
        self.clear()

    def clear(self) -> None:
        slots = 1 << self.BITS
        self.keys, self.checks = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        self.begins, self.sizes = np.zeros(slots, np.int32), np.zeros(slots, np.int32)
        self.ids, self.used, self.rows = np.zeros(1 << 16, self.code), 0, 0

    def slots_of(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or of the first empty place where it would stand."""
        mask = np.uint64((1 << self.BITS) - 1)
        slots = (keys & mask).astype(np.int64)
        open_ = np.arange(len(keys))
        while len(open_):
            there = self.keys[slots[open_]]
            open_ = open_[(there != keys[open_]) & (there != 0)]
            slots[open_] = (slots[open_] + 1) & int(mask)
        return slots

    def add(self, keys: np.ndarray, checks: np.ndarray, pieces: list[bytes]) -> None:
        """Distinct keys that are not there yet."""
        sizes = np.array([len(p) for p in pieces], dtype=np.int64) // self.code.itemsize
        ids = np.frombuffer(b"".join(pieces), dtype=self.code)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        begins = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        self.rows += len(keys)
        left = np.arange(len(keys))
        while len(left):
            slots = self.slots_of(keys[left])
            self.keys[slots] = keys[left]  # of several for one place the last one gets it
            won = self.keys[slots] == keys[left]
            at, mine = slots[won], left[won]
            self.checks[at], self.begins[at], self.sizes[at] = checks[mine], begins[mine], sizes[mine]
            left = left[~won]


#: Bytes of TAIL and those that a tail may follow: ASCII letters and digits. Behind others, a piece is one unit.
_TAIL_BYTE = np.array([chr(b) in TAIL for b in range(256)])
_BEFORE_TAIL = np.array([b < 0x80 and chr(b).isalnum() for b in range(256)])
_AFTER_SPACE, _FIRST, _TAIL = 0, 1, 2


def _units(data: np.ndarray, at: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and kinds of the units of texts: pieces, but for the punctuation at their ends."""
    space = data == 0x20
    begins = data == 0x0A
    begins[1:] |= space[:-1]
    begins[at[texts]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(data))
    # A piece ends before the space that the next one stands behind.
    ends = ends - np.append(space[starts[1:] - 1], False)
    first = np.zeros(len(data), dtype=bool)
    first[at[texts]] = True
    first = first[starts]
    inner = np.maximum.accumulate(np.where(_TAIL_BYTE[data], -1, np.arange(len(data))))
    core = inner[ends - 1] + 1
    tailed = (core < ends) & (core > starts) & ~first
    tailed[tailed] = _BEFORE_TAIL[data[core[tailed] - 1]]
    place = np.arange(len(starts)) + np.cumsum(tailed) - tailed
    n = len(starts) + int(tailed.sum())
    unit_starts, unit_ends, kinds = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
    unit_starts[place], unit_ends[place], kinds[place] = starts, np.where(tailed, core, ends), np.where(first, _FIRST, _AFTER_SPACE)
    after = place[tailed] + 1
    unit_starts[after], unit_ends[after], kinds[after] = core[tailed], ends[tailed], _TAIL
    return unit_starts, unit_ends, kinds


def encode_even(encoder: Encoder, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Ids of texts of words with single spaces or line ends between them; where each text's ids start, and the end.

    None if two units share a hash but not the other: the texts then go the long way.
    """
    table = encoder.table
    texts = np.flatnonzero(np.diff(at))
    if not len(texts):
        return np.empty(0, table.code), np.zeros(len(at), dtype=np.int64)
    starts, ends, kinds = _units(data, at, texts)
    keys, checks = _unit_hashes(data, starts, ends, kinds)
    if table.rows > 1 << (table.BITS - 2):
        table.clear()
    slots = table.slots_of(keys)
    new = np.flatnonzero(table.keys[slots] == 0)
    if len(new):
        _, sample = np.unique(keys[new], return_index=True)
        sample = new[sample]
        raw, pieces = data.tobytes(), []
        for a, b, kind in zip(starts[sample].tolist(), ends[sample].tolist(), kinds[sample].tolist()):
            text = raw[a:b].decode()
            pieces.append(encoder.piece(text) if kind == _AFTER_SPACE else encoder.direct(text))
        table.add(keys[sample], checks[sample], pieces)
        slots = table.slots_of(keys)
    if not np.array_equal(table.checks[slots], checks):
        return None
    counts = table.sizes[slots].astype(np.int64)
    behind = np.cumsum(counts)
    ids = table.ids[np.repeat(table.begins[slots] - (behind - counts), counts) + np.arange(int(behind[-1]))]
    # Where a text's first unit begins; a text without bytes has the place of the next one.
    return ids, np.append(0, behind)[np.searchsorted(starts, at)]


def encode_column(encoder: Encoder, column: pa.Array) -> Iterator[bytes]:
    """The ids' bytes of every text of a column without nulls, in order."""
    uneven = pc.match_substring_regex(column, UNEVEN)
    for start, part in slices(column):
        data, at = text_bytes(part)
        odd = uneven.slice(start, len(part)).to_numpy(zero_copy_only=False)
        if len(data) > LONG_BYTES or odd.all():
            yield from (encoder.encode(t.as_py()) for t in part)
            continue
        if odd.any():
            even = part.filter(pa.array(~odd))
            data, at = text_bytes(even)
        told = encode_even(encoder, data, at)
        if told is None:
            yield from (encoder.encode(t.as_py()) for t in part)
            continue
        (ids, places), i = told, 0
        for text, alone in zip(part, odd.tolist()):
            if alone:
                yield encoder.encode(text.as_py())
            else:
                yield ids[places[i] : places[i + 1]].tobytes()
                i += 1


@lru_cache(1)
def encoder_of(path: str) -> Encoder:
    """One encoder per process, with what it remembers."""
    return Encoder(path)


def train_dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary; too few samples give their own bytes as one, and none an empty one."""
    import zstandard

    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _compression(dictionary: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def write_tokens(docs: DataFrame, folder: str, tokenizer: Callable[[], str], end_id: int = 0) -> None:
    """Encode ``doc_id, text`` into a new token folder. ``tokenizer`` gives the file's place on the machine it runs on."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sample = (
        # About twice the sample by hash, so that no task sends more than its part of it.
        texts.where(F.pmod(F.xxhash64("doc_id"), max(1, texts.count() // (2 * SAMPLE_DOCS))) == 0)
        .where(F.char_length("text") <= SAMPLE_CHARS)
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text")
        .limit(SAMPLE_DOCS)
    )
    encoder = encoder_of(tokenizer())
    width, end = encoder.width, array(encoder.code, [end_id]).tobytes()
    dictionary = train_dictionary([encoder.encode(r["text"]) + end for r in sample.collect()])
    name = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(name, bytearray(dictionary))], "dictionary string, bytes binary").coalesce(1).write.parquet(
        f"{folder}/dictionary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoder, shard = encoder_of(tokenizer()), TaskContext.get().partitionId()
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=_compression(dictionary), write_dict_id=False)
        ids, frames, lengths, blocks, at, block, held = [], [], [], [], 0, 0, 0

        def closed() -> dict:
            nonlocal at, block
            sizes, counts = np.array([len(f) for f in frames]), np.array(lengths)
            known = [i for i in ids if i is not None]
            row = {
                "shard": shard,
                "block": block,
                "first_id": known[0] if known else None,
                "last_id": known[-1] if known else None,
                "dictionary": name,
                "width": width,
                "doc_ids": list(ids),
                "offsets": [0, *np.cumsum(sizes).tolist()],
                "starts": (at + np.cumsum(counts) - counts).tolist(),
                "n_ids": list(lengths),
                "payload": b"".join(frames),
            }
            at, block = at + int(counts.sum()), block + 1
            ids.clear(), frames.clear(), lengths.clear()
            return row

        size = 0
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), encode_column(encoder, batch.column(1))):
                raw += end
                frame = pack.compress(raw)
                if ids and size + len(frame) > BLOCK_BYTES:
                    blocks.append(closed())
                    held, size = held + size, 0
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(blocks, schema=BLOCKS)
                        blocks, held = [], 0
                ids.append(doc_id), frames.append(frame), lengths.append(len(raw) // width)
                size += len(frame)
        if ids:
            blocks.append(closed())
        if blocks:
            yield pa.RecordBatch.from_pylist(blocks, schema=BLOCKS)

    ordered = texts.repartitionByRange(F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    ordered.mapInArrow(run, BLOCKS_DDL).write.option("compression", "none").parquet(f"{folder}/blocks")

    index = spark.read.parquet(f"{folder}/blocks").select("shard", F.aggregate("n_ids", F.lit(0).cast("long"), lambda a, n: a + n).alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = index.groupBy("shard").agg(F.sum("ids").alias("ids"))  # a row per task that wrote
    shards.withColumn("before", F.coalesce(F.sum("ids").over(before), F.lit(0))).write.parquet(f"{folder}/shards")


def index_of(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: ``doc_id, start, n_tokens, shard, block, offset, length`` — without reading any payload."""
    blocks = spark.read.parquet(f"{folder}/blocks").drop("payload")
    places = F.expr(
        "inline(transform(sequence(1, size(doc_ids)), i -> named_struct('doc_id', doc_ids[i - 1], "
        "'start', before + starts[i - 1], 'n_tokens', n_ids[i - 1], 'offset', offsets[i - 1], "
        "'length', offsets[i] - offsets[i - 1])))"
    )
    return blocks.join(spark.read.parquet(f"{folder}/shards").drop("ids"), "shard").select("shard", "block", places)


def read_tokens(spark: SparkSession, folder: str, wanted: list[int] | None = None, with_ids: bool = True) -> DataFrame:
    """Decode a token folder: ``doc_id, start, n_tokens, ids_crc32`` and, with ``with_ids``, ``ids`` (array<int>).

    ``wanted``: these documents only; other blocks are left out by their id range, other frames are not decompressed.
    """
    bounded_batches(spark)
    blocks = spark.read.parquet(f"{folder}/blocks")
    if wanted is not None:
        inside = [F.lit(False)] + [F.lit(i).between(F.col("first_id"), F.col("last_id")) for i in wanted]
        blocks = blocks.where(F.exists(F.array(*inside), lambda x: x))
    chosen = None if wanted is None else set(wanted)
    stored = {r["dictionary"]: bytes(r["bytes"]) for r in spark.read.parquet(f"{folder}/dictionary").collect()}
    if any(hashlib.sha256(b).hexdigest() != name for name, b in stored.items()):
        raise ValueError(f"{folder}: the dictionary does not match its hash")
    # one row per task that wrote: known to be small
    based = blocks.join(F.broadcast(spark.read.parquet(f"{folder}/shards").drop("ids")), "shard")
    based = based.select("before", "dictionary", "width", "doc_ids", "offsets", "starts", "payload")
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("ids", pa.list_(pa.int32()))] * with_ids
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = {n: zstandard.ZstdDecompressor(dict_data=_compression(b)) for n, b in stored.items()}
        for batch in batches:
            for k in range(batch.num_rows):
                row = {f: batch.column(i)[k] for i, f in enumerate(batch.schema.names)}
                payload = memoryview(row["payload"].as_buffer())
                offsets, starts = row["offsets"].as_py(), row["starts"].as_py()
                before, width = row["before"].as_py(), row["width"].as_py()
                decoder, found = unpack[row["dictionary"].as_py()], []
                for i, doc_id in enumerate(row["doc_ids"].as_py()):
                    if chosen is None or doc_id in chosen:
                        raw = decoder.decompress(payload[offsets[i] : offsets[i + 1]])
                        ids = np.frombuffer(raw, dtype=f"<u{width}").astype("<u4")
                        found.append((doc_id, before + starts[i], len(ids), zlib.crc32(ids), ids.astype("i4"))[: len(fields)])
                if found:
                    columns = [pa.array(c, type=t.type) for c, t in zip(zip(*found), schema)]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    ddl = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return based.mapInArrow(run, ddl)
