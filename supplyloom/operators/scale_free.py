"""Whether degrees follow a power law, and from which degree on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from supplyloom.operators.graph import degree_distribution
from supplyloom.storage import materialise

#: Cut-offs tried, about: all degrees where there are no more, else the least one of each logarithmic bin.
CUTOFFS = 256


def power_law(edges: DataFrame, min_share: float = 0.1) -> DataFrame:
    """``direction, exponent, cutoff, distance, n_tail``: the power law that fits each direction's degrees best.

    For a cut-off c the exponent is the discrete maximum-likelihood estimate ``1 + n / sum(ln(d / (c - 1/2)))`` over the
    n companies of degree d >= c, and the distance the greatest gap between their share above a degree and the law's
    (Kolmogorov-Smirnov). The cut-off of least distance is taken, among those that keep ``min_share`` of the companies.
    All comes from the degree histogram, whose rows are distinct degrees, at most the root of twice the edges.
    """
    histogram = materialise(degree_distribution(edges).filter("degree > 0"), "degrees")
    up = Window.partitionBy("direction").orderBy(F.col("degree").desc()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("direction")
    logs = F.col("n_nodes") * F.log(F.col("degree").cast("double"))
    tails = histogram.select(
        "direction", "degree", F.sum("n_nodes").over(up).alias("above"), F.sum(logs).over(up).alias("logs"),
        F.sum("n_nodes").over(whole).alias("all"), F.count(F.lit(1)).over(whole).alias("n_degrees"), F.max("degree").over(whole).alias("top"),
    )
    tails = materialise(tails, "tails")
    step = F.log(F.col("top").cast("double")) / F.lit(float(CUTOFFS))
    bin_of = F.when(F.col("n_degrees") <= CUTOFFS, F.col("degree")).otherwise(F.floor(F.log(F.col("degree").cast("double")) / step))
    tried = tails.filter((F.col("above") >= F.lit(min_share) * F.col("all")) & (F.col("degree") < F.col("top")))
    start = F.col("degree") - F.lit(0.5)
    exponent = F.lit(1.0) + F.col("above") / (F.col("logs") - F.col("above") * F.log(start))
    tried = tried.groupBy("direction", bin_of.alias("bin")).agg(
        F.min_by(F.struct(F.col("degree").alias("cutoff"), F.col("above").alias("n_tail"), exponent.alias("exponent")), "degree").alias("c")
    )
    # Some CUTOFFS rows a direction.
    tried = materialise(tried.select("direction", "c.*"), "cutoffs")
    met = tails.join(F.broadcast(tried), "direction").filter("degree >= cutoff")
    law = F.pow((F.col("degree") - F.lit(0.5)) / (F.col("cutoff") - F.lit(0.5)), F.lit(1.0) - F.col("exponent"))
    gap = F.abs(F.col("above") / F.col("n_tail") - law)
    fits = met.groupBy("direction", "cutoff", "n_tail", "exponent").agg(F.max(gap).alias("distance"))
    best = fits.groupBy("direction").agg(F.min_by(F.struct("exponent", "cutoff", "distance", "n_tail"), F.struct("distance", "cutoff")).alias("f"))
    return best.select("direction", "f.*")
