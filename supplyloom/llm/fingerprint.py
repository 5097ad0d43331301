"""Document fingerprints as a homomorphic multiset hash of paragraphs.

A text falls into paragraphs at line ends, and a paragraph into sentences. Each piece is hashed to a wide vector;
the fingerprint is the sum of the vectors, each lane modulo a power of two. So the order of pieces has no say, and
pieces are added or taken away by adding or subtracting their vectors (``insert``, ``delete``). Two parts:

- ``exact``: four lanes modulo 2**48, with which equality is told;
- ``signs``: 124 counters modulo 2**31 of a random bit of each piece, two to a long, more than any text has pieces. A
  counter less half the number of pieces is a random projection of the multiset, so the cosine of two such vectors
  estimates the likeness of two multisets with a standard error of about 0.09.

DataFrame functions only. Defined cases: a null text counts as empty; an empty text has no pieces, and its fingerprint
is all zeros; it is like another empty text (1.0) and unlike any other (0.0); repeated rows get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECES = r"\n+|(?<=[.!?])\x20+"
EXACT, EXACT_BITS = 4, 48
GROUPS, LANE_BITS, LANES = 30, 31, 2
#: Rows of a range of ids, about: what one window holds.
RANGE_ROWS = 4096
#: Ranges at most, so that the list of them stays small; beyond 2**28 rows they grow longer, and windows spill.
MAX_RANGES = 65536
_EXACT_MASK = (1 << EXACT_BITS) - 1
_PACKED_MASK = (1 << LANE_BITS * LANES) - 1
_ONES = sum(1 << LANE_BITS * i for i in range(LANES))
_SHIFTS = range(GROUPS + 1)


def _zero() -> str:
    names = [f"e{i}" for i in range(EXACT)] + [f"p{i}" for i in range(2 * len(_SHIFTS))]
    return "named_struct('n', 0L, " + ", ".join(f"'{n}', 0L" for n in names) + ")"


def _add(acc: str, piece: str) -> str:
    parts = [f"'n', {acc}.n + 1L"]
    parts += [f"'e{i}', ({acc}.e{i} + {piece}.h{i}) & {_EXACT_MASK}L" for i in range(EXACT)]
    for j in range(2):
        for k in _SHIFTS:
            i = j * len(_SHIFTS) + k
            parts.append(f"'p{i}', ({acc}.p{i} + (shiftright({piece}.s{j}, {k}) & {_ONES}L)) & {_PACKED_MASK}L")
    return "named_struct(" + ", ".join(parts) + ")"


def fingerprint(text: str) -> Column:
    """Struct ``n, e0.., p0..`` of a string column."""
    hashes = [f"'h{i}', xxhash64({i}L, x) & {_EXACT_MASK}L" for i in range(EXACT)]
    hashes += [f"'s{j}', xxhash64({100 + j}L, x)" for j in range(2)]
    pieces = f"filter(split(coalesce({text}, ''), '{PIECES}'), x -> x != '')".replace("\\", "\\\\")
    return F.expr(
        f"aggregate(transform({pieces}, x -> named_struct({', '.join(hashes)})), {_zero()}, "
        f"(acc, y) -> {_add('acc', 'y')})"
    )


def _combined(a: Column, b: Column, sign: int) -> Column:
    mask = lambda v, m: v.bitwiseAND(F.lit(m))
    fields = [(a["n"] + sign * b["n"]).alias("n")]
    fields += [mask(a[f"e{i}"] + sign * b[f"e{i}"], _EXACT_MASK).alias(f"e{i}") for i in range(EXACT)]
    # No lane may borrow from the next one: subtract with a bit set above each, in lanes taken apart.
    lane = (1 << LANE_BITS) - 1
    for i in range(2 * len(_SHIFTS)):
        parts = [
            F.shiftleft(mask(_lane(a[f"p{i}"], k) + sign * _lane(b[f"p{i}"], k), lane), LANE_BITS * k)
            for k in range(LANES)
        ]
        fields.append(sum(parts[1:], parts[0]).alias(f"p{i}"))
    return F.struct(*fields)


def _lane(packed: Column, k: int) -> Column:
    return F.shiftright(packed, LANE_BITS * k).bitwiseAND(F.lit((1 << LANE_BITS) - 1))


def insert(a: Column, b: Column) -> Column:
    """Fingerprint of both multisets together."""
    return _combined(a, b, 1)


def delete(a: Column, b: Column) -> Column:
    """Fingerprint of ``a`` without the pieces of ``b``."""
    return _combined(a, b, -1)


def as_string(print_: Column) -> Column:
    lanes = [F.lpad(F.hex(print_[f"e{i}"]), EXACT_BITS // 4, "0") for i in range(EXACT)]
    lanes += [F.lpad(F.hex(print_[f"p{i}"]), -(-LANE_BITS * LANES // 4), "0") for i in range(2 * len(_SHIFTS))]
    return F.lower(F.concat(F.hex(print_["n"]), F.lit(":"), *lanes))


def signs(print_: str) -> Column:
    """The random projection: twice each counter less the number of pieces."""
    packed = ", ".join(f"{print_}.p{i}" for i in range(2 * len(_SHIFTS)))
    lane = (1 << LANE_BITS) - 1
    taken = ", ".join(f"2 * (shiftright(x, {LANE_BITS * k}) & {lane}L) - {print_}.n" for k in range(LANES))
    return F.expr(f"flatten(transform(array({packed}), x -> array({taken})))")


def likeness(a: str, b: str, signs_a: str, signs_b: str) -> Column:
    """Cosine of two projections, 0 to 1; 1 for equal fingerprints, 0 if just one is empty."""
    same = " AND ".join(f"{a}.e{i} = {b}.e{i}" for i in range(EXACT)) + f" AND {a}.n = {b}.n"
    dot = "aggregate(zip_with({}, {}, (x, y) -> cast(x as double) * y), 0D, (s, x) -> s + x)"
    norm = f"sqrt({dot.format(signs_a, signs_a)} * {dot.format(signs_b, signs_b)})"
    cosine = f"coalesce(try_divide({dot.format(signs_a, signs_b)}, {norm}), 0D)"
    return F.expr(
        f"CASE WHEN {same} THEN 1D WHEN {a}.n = 0 OR {b}.n = 0 THEN 0D "
        f"ELSE least(1D, greatest(0D, {cosine})) END"
    )


def with_next(docs: DataFrame, added: dict[str, Column], columns: list[str]) -> DataFrame:
    """Adds ``added`` columns and ``next``, a struct of ``columns`` of the next row by descending doc_id; after the
    last row comes the first.

    Rows go once to ranges of ids, with a window in each; the first row of the range below joins as a guard at its
    end. Equal ids follow one another by text, a null id comes last. Ranges have equal widths, so ids should be
    about evenly spread; if they are not, ranges differ in size, and the result is the same.
    """
    seen = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n")).first()
    low, high = (seen["low"], seen["high"]) if seen["low"] is not None else (0, 0)
    ranges = min(MAX_RANGES, max(1, seen["n"] // RANGE_ROWS))
    place = F.floor((F.col("doc_id").cast("double") - float(low)) / (float(high) - float(low) + 1.0) * ranges)
    ranged = docs.withColumn("_range", F.coalesce(F.least(place, F.lit(ranges - 1)), F.lit(-1)).cast("int"))

    # First row of each range that has rows, by descending id: at most one per range.
    tops = ranged.groupBy("_range").agg(F.max("doc_id").alias("top")).orderBy(F.col("_range").desc()).collect()
    follows = [(a["_range"], b["_range"], b["top"]) for a, b in zip(tops, tops[1:] + tops[:1])]
    guards_of = docs.sparkSession.createDataFrame(follows, "into int, of int, top long")
    first = Window.partitionBy("into").orderBy("text")
    guards = (
        ranged.join(
            F.broadcast(guards_of),
            (F.col("_range") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("top")),
        )
        .withColumn("_turn", F.row_number().over(first))
        .where("_turn = 1")
        .select(*docs.columns, F.col("into").alias("_range"), F.lit(True).alias("_guard"))
    )
    rows = ranged.select(*docs.columns, "_range", F.lit(False).alias("_guard")).unionByName(guards).withColumns(added)
    order = Window.partitionBy("_range").orderBy("_guard", F.col("doc_id").desc_nulls_last(), "text")
    return rows.withColumn("next", F.lead(F.struct(*columns)).over(order)).where(~F.col("_guard")).drop("_range", "_guard")


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edit: its last half replaced by the beginning of the next document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    half = "cast(floor(n_chars / 2) as int)"
    edited = (
        with_next(texts, {"print": fingerprint("text")}, ["text", "print"])
        .withColumn("n_chars", F.char_length("text").cast("long"))
        .withColumn(
            "edited", F.expr(f"concat(substring(text, 1, cast(n_chars as int) - {half}), substring(next.text, 1, {half}))")
        )
        .withColumn("next_print", F.col("next.print"))
        .drop("next", "text")
        .withColumn("edited_print", fingerprint("edited"))
    )
    for name in ("print", "edited_print", "next_print"):
        edited = edited.withColumn(f"{name}_signs", signs(name))
    return edited.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_string(F.col("print")).alias("fingerprint"),
        as_string(F.col("edited_print")).alias("edited_fingerprint"),
        likeness("print", "edited_print", "print_signs", "edited_print_signs").alias("near_edited"),
        likeness("print", "next_print", "print_signs", "next_print_signs").alias("near_next"),
    )
