"""Distribution of the confidence values as tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BINS = 4096
#: The least positive double.
TINY = 5e-324


def exact_quantiles(df: DataFrame, column: str, fractions: list[float], bins: int = BINS) -> list[float | None]:
    """Linearly interpolated quantiles of a numeric column, exact at any size.

    Found by counting: each scan cuts the ranges that hold a wanted rank into ``bins`` parts, and keeps the least and
    greatest value of each, so a range shrinks to one value within a few scans. Nothing is shuffled but those counts,
    sorted or written. The built-in exact percentile keeps every distinct value of a group in one task's memory.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    bins = max(2, bins)  # two parts at least, or a range would not shrink
    stats = values.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if not stats.n:
        return [None] * len(fractions)
    spots = [q * (stats.n - 1) for q in fractions]
    ranks = sorted({r for s in spots for r in (math.floor(s), math.ceil(s))})
    at: dict[int, float] = {}
    spans = _still_open([(stats.lo, stats.hi, 0, stats.n)], ranks, at)
    while spans:
        spot = F.lit(None).cast("struct<span:int,bin:int>")
        for k, (low, high, _, _) in enumerate(spans):
            width = max((high - low) / bins, TINY)
            number = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
            inside = (F.col("v") >= F.lit(low)) & (F.col("v") <= F.lit(high))
            spot = F.when(inside, F.struct(F.lit(k).alias("span"), number.alias("bin"))).otherwise(spot)
        counts = values.select("v", spot.alias("at")).filter(F.col("at").isNotNull()).groupBy("at.span", "at.bin")
        # At most ``bins`` rows for each wanted rank.
        rows = counts.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
        below, parts = [span[2] for span in spans], []
        for r in sorted(rows, key=lambda r: (r.span, r.bin)):
            parts.append((r.lo, r.hi, below[r.span], r.n))
            below[r.span] += r.n
        spans = _still_open(parts, ranks, at)
    return [
        at[math.floor(s)] + (at[math.ceil(s)] - at[math.floor(s)]) * (s - math.floor(s)) for s in spots
    ]


def _still_open(parts: list[tuple], ranks: list[int], at: dict[int, float]) -> list[tuple]:
    """Parts ``(least, greatest, rows below, rows)`` that hold a rank whose value they do not tell; others go to ``at``."""
    found = []
    for low, high, below, n in parts:
        inside = [r for r in ranks if below <= r < below + n]
        at |= {r: low for r in inside if r == below or low == high}
        at |= {r: high for r in inside if r == below + n - 1}
        if any(r not in at for r in inside):
            found.append((low, high, below, n))
    return found


def probability_profile(relations: DataFrame, column: str = "probability") -> DataFrame:
    """Box statistics: quartiles, whiskers by the 1.5 IQR fences, outlier count."""
    q1, median, q3 = exact_quantiles(relations, column, [0.25, 0.5, 0.75])
    p = F.col(column).cast("double")
    if q1 is None:
        lower = upper = F.lit(None).cast("double")
    else:
        spread = 1.5 * (q3 - q1)
        lower, upper = F.lit(q1 - spread), F.lit(q3 + spread)
    quartile = [F.lit(v).cast("double").alias(n) for n, v in (("q1", q1), ("median", median), ("q3", q3))]
    return relations.agg(
        F.count(p).alias("n"),
        F.count_if(p.isNull()).alias("n_missing"),
        F.min(p).alias("min_p"),
        F.max(p).alias("max_p"),
        F.avg(p).alias("mean_p"),
        F.min(F.when(p >= lower, p)).alias("whisker_low"),
        F.max(F.when(p <= upper, p)).alias("whisker_high"),
        F.count_if((p < lower) | (p > upper)).alias("n_outliers"),
    ).select("*", *quartile)


def probability_histogram(relations: DataFrame, bins: int = 20, column: str = "probability") -> DataFrame:
    """Counts and density per equal bin of [0, 1]; 1 belongs to the last bin."""
    p = F.col(column).cast("double")
    bucket = F.least(F.width_bucket(p, F.lit(0.0), F.lit(1.0), F.lit(bins)), F.lit(bins).cast("bigint"))
    # At most ``bins`` rows reach this window.
    total = F.sum("n").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (
        relations.filter(p.isNotNull())
        .groupBy(bucket.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "bin",
            ((F.col("bin") - 1) / F.lit(float(bins))).alias("bin_start"),
            "n",
            (F.col("n") * F.lit(float(bins)) / total).alias("density"),
        )
    )


def density_curve(relations: DataFrame, column: str = "probability", points: int = 256) -> DataFrame:
    """``at, density`` on an even grid from the least to the greatest value: a binned Gaussian kernel estimate.

    Values are counted at their nearest grid point, in one aggregate, and the counts are convolved with the kernel:
    ``points`` squared terms, whatever the size of the table. The bandwidth is ``0.9 min(sd, iqr / 1.34) n^(-1/5)``
    with exact quartiles; without any spread the whole mass lies at one point. An empty column gives no rows.
    """
    values = relations.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    stats = values.agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.stddev_samp("v").alias("sd")
    ).first()
    q1, q3 = exact_quantiles(relations, column, [0.25, 0.75])
    spark = relations.sparkSession
    if not stats.n:
        return spark.createDataFrame([], "at double, density double")
    step = (stats.high - stats.low) / (points - 1)
    spread = min(x for x in (stats.sd, (q3 - q1) / 1.34) if x > 0) if stats.sd and q3 > q1 else stats.sd
    if not spread or step <= 0:
        return spark.createDataFrame([(stats.low, float("inf"))], "at double, density double")
    width = 0.9 * spread * stats.n**-0.2
    place = F.floor((F.col("v") - F.lit(stats.low)) / F.lit(step) + F.lit(0.5)).cast("int")
    # At most ``points`` rows, each spread over the grid.
    counts = values.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = counts.select("bin", "n", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    apart = (F.col("point") - F.col("bin")) * F.lit(step) / F.lit(width)
    kernel = F.exp(F.lit(-0.5) * apart * apart) / F.lit(math.sqrt(2 * math.pi) * width * stats.n)
    return grid.groupBy("point").agg(F.sum(F.col("n") * kernel).alias("density")).select(
        (F.lit(stats.low) + F.col("point") * F.lit(step)).alias("at"), "density"
    )
