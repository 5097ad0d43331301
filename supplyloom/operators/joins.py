"""Lookups of a keyed table from a large, possibly skewed one."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyloom.storage import materialise, rows_of, stored

BROADCAST_BYTES = 128 << 20
HOT_FLOOR = 1_000_000
HOT_ROW_BYTES = 32
NULL_SPREAD = 1 << 20


class Spreads(NamedTuple):
    """Hot keys with their number of salts: a table ``(__hot, __spread)``, or None when no key is hot."""

    table: DataFrame | None = None


NOT_HOT = Spreads()


def hot_keys(df: DataFrame, *keys: str, floor: int | None = None) -> dict[str, Spreads]:
    """Every key with at least ``floor`` rows, per column, in one pass.

    Each comes with the number of salts that leaves about ``floor`` rows per salt,
    so no task gets more of any key than that. There are at most rows / floor such
    keys, and the floor rises with the table so that their list stays broadcastable.
    """
    floor = HOT_FLOOR if floor is None else floor
    known = getattr(df, "known_rows", None)
    if known is not None and known < floor:
        return dict.fromkeys(keys, NOT_HOT)
    # ``keys`` share one type, so the fixed-width aggregate stays in codegen.
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), F.col(k).alias("__hot")) for i, k in enumerate(keys)])
    counts = df.select(F.inline(pairs)).filter(F.col("__hot").isNotNull()).groupBy("c", "__hot").count()
    hot = materialise(counts.filter(F.col("count") >= floor), "hot")
    while not fits_broadcast(rows_of(hot), HOT_ROW_BYTES) and BROADCAST_BYTES >= HOT_ROW_BYTES:
        floor *= 2
        hot = materialise(hot.filter(F.col("count") >= floor), "hot")
    if not rows_of(hot):
        return dict.fromkeys(keys, NOT_HOT)
    # Powers of two, from the integer logarithm.
    steps = F.greatest(F.floor(F.col("count") / F.lit(floor)) - 1, F.lit(0))
    spread = F.expr("bigint(2)") * F.pow(F.lit(2.0), F.ceil(F.log2(steps + 1))).cast("bigint")
    return {
        k: Spreads(hot.filter(F.col("c") == i).select("__hot", spread.alias("__spread"))) for i, k in enumerate(keys)
    }


def fits_broadcast(rows: int, row_bytes: int) -> bool:
    return rows * row_bytes <= BROADCAST_BYTES


def _with_spread(df: DataFrame, key: str, hot: Spreads, name: str, null_spread: int = 1) -> DataFrame:
    """Adds the number of salts of each row's key; 1 for cold keys."""
    spread = F.lit(1).cast("bigint")
    if hot.table is not None:
        known = hot.table.select(F.col("__hot").alias("__key"), F.col("__spread").alias("__salts"))
        df = df.join(F.broadcast(known), F.col(key) == F.col("__key"), "left")
        spread = F.coalesce("__salts", spread)
    if null_spread > 1:
        spread = F.when(F.col(key).isNull(), F.lit(null_spread).cast("bigint")).otherwise(spread)
    return df.withColumn(name, spread).drop("__key", "__salts")


def _one_salt(spread: Column, row: Column) -> Column:
    return F.pmod(F.xxhash64(row), spread.cast("bigint"))


def _all_salts(spread: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), spread.cast("bigint") - 1))


def salted_join(
    big: DataFrame, table: DataFrame, key: str, hot: Spreads, salt_by: Column, how: str = "inner"
) -> DataFrame:
    """Equi-join on ``key`` with the rows of each hot key spread over its salts.

    Rows of ``big`` get one salt each, rows of ``table`` are copied once per salt
    for hot keys only, so every pair still meets exactly once. A left join keeps
    rows without a key, which match nothing: they are spread as well.
    """
    keep = how == "left"
    if hot.table is None and not keep:
        return big.join(table, key, how)
    left = _with_spread(big, key, hot, "__n", NULL_SPREAD if keep else 1)
    left = left.withColumn("__salt", _one_salt(F.col("__n"), salt_by)).drop("__n")
    right = _with_spread(table, key, hot, "__n").withColumn("__salt", _all_salts(F.col("__n"))).drop("__n")
    return left.join(right, [key, "__salt"], how).drop("__salt")


def salted_many_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    hot_left: Spreads,
    hot_right: Spreads,
    left_row: Column,
    right_row: Column,
) -> DataFrame:
    """Inner many-to-many equi-join whose keys may be hot on either side.

    A hot key becomes a grid: each row picks its own line of the grid and is
    copied along the other side's lines, so every pair meets exactly once. The
    copies are a small fraction of the result, which has floor rows per line.
    """
    if hot_left.table is None and hot_right.table is None:
        return left.join(right, key)

    def spreads(df: DataFrame) -> DataFrame:
        return _with_spread(_with_spread(df, key, hot_left, "__ls"), key, hot_right, "__rs")

    a = spreads(left).withColumn("__l", _one_salt(F.col("__ls"), left_row)).withColumn("__r", _all_salts(F.col("__rs")))
    b = spreads(right).withColumn("__r", _one_salt(F.col("__rs"), right_row)).withColumn("__l", _all_salts(F.col("__ls")))
    a, b = a.drop("__ls", "__rs"), b.drop("__ls", "__rs")
    return a.join(b, [key, "__l", "__r"]).drop("__l", "__r")


def lookup(
    big: DataFrame,
    table: DataFrame,
    key: str,
    row_bytes: int,
    salt_by: Column,
    how: str = "inner",
    hot: Spreads | Callable[[], Spreads] | None = None,
    floor: int | None = None,
    rows: int | None = None,
    store: bool = False,
) -> DataFrame:
    """Brings the columns of ``table`` (a written table, one row per key) to ``big``.

    Broadcast when the checked size (``rows``, or a count) allows it; otherwise a
    shuffle join whose hot keys are salted. ``hot`` replaces the pass that finds
    them; ``store`` writes a ``big`` that is dear to compute before that pass.
    """
    if fits_broadcast(rows_of(table) if rows is None else rows, row_bytes):
        return big.join(F.broadcast(table), key, how)
    if hot is None:
        big = stored(big, "big") if store else big
        hot = hot_keys(big, key, floor=floor)[key]
    elif callable(hot):
        hot = hot()
    return salted_join(big, table, key, hot, salt_by, how)
