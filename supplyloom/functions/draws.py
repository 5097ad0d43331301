"""Seeded draws. A draw is a pure function of its key, so a retried or
re-partitioned task draws the same value again."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_BITS = 60


def _hex_to_long(text: Column, start: int) -> Column:
    return F.conv(F.substring(text, start, 15), 16, 10).cast("bigint")


def _key(parts) -> Column:
    return F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])


def draw(*parts) -> Column:
    """Uniform integer in [0, 2**60), keyed by the ``|``-joined parts."""
    return _hex_to_long(F.md5(_key(parts)), 1)


def draw_below(n: int | Column, *parts) -> Column:
    """Uniform integer in [0, n)."""
    return draw(*parts) % (n if isinstance(n, Column) else F.lit(n).cast("bigint"))


def _unit(value: Column) -> Column:
    return (value.cast("double") + F.lit(0.5)) / F.lit(float(2**DRAW_BITS))


def standard_normals(count: int, *parts) -> Column:
    """Array of ``count`` standard normals; each digest gives one Box-Muller pair."""
    out: list[Column] = []
    for pair in range((count + 1) // 2):
        digest = F.md5(_key([*parts, pair]))
        radius = F.sqrt(F.lit(-2.0) * F.log(_unit(_hex_to_long(digest, 1))))
        angle = F.lit(2.0 * math.pi) * _unit(_hex_to_long(digest, 16))
        out += [radius * F.cos(angle), radius * F.sin(angle)]
    return F.array(*out[:count])
