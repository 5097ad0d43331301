"""Risk views: enriched relations and the tiers of suppliers behind a company."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyloom.operators.joins import NOT_HOT, fits_broadcast, hot_keys, lookup, salted_many_join
from supplyloom.storage import materialise, rows_of

PROFILE = ("country", "region", "risk_premium", "risk_score")


def company_profiles(locations: DataFrame, country_risk: DataFrame, company_risk: DataFrame) -> DataFrame:
    """One row per company: where it is, the country premium and its own score."""
    return (
        locations.select("company_id", "country", "region")
        .join(country_risk.select("country", "risk_premium"), "country", "left")
        .join(company_risk.select("company_id", "risk_score"), "company_id", "left")
    )


def enrich(relations: DataFrame, profiles: DataFrame, floor: int | None = None) -> DataFrame:
    """Adds the buyer's and the seller's profile to each relation."""
    profiles = materialise(profiles, "profiles")
    rows = rows_of(profiles)
    hot = {} if fits_broadcast(rows, 128) else hot_keys(relations, "src_id", "dst_id", floor=floor)
    out = relations
    for side, key, other in (("buyer", "src_id", "dst_id"), ("seller", "dst_id", "src_id")):
        table = profiles.select(
            F.col("company_id").alias(key), *[F.col(c).alias(f"{side}_{c}") for c in PROFILE]
        )
        salt = F.col("eid") if "eid" in relations.columns else F.col(other)
        out = lookup(out, table, key, 128, salt, "left", hot.get(key, NOT_HOT), rows=rows)
    return out


def risk_by_country(enriched: DataFrame) -> DataFrame:
    """Dashboard summary: confidence-weighted exposure of buyers to seller countries."""
    weight = F.col("probability")
    return enriched.groupBy("buyer_country", "seller_country").agg(
        F.count(F.lit(1)).alias("n_relations"),
        F.sum(weight).alias("expected_relations"),
        F.max("seller_risk_premium").alias("seller_risk_premium"),
        (F.sum(weight * F.col("seller_risk_score")) / F.sum(F.when(F.col("seller_risk_score").isNotNull(), weight))).alias(
            "mean_seller_risk_score"
        ),
    )


def supplier_tiers(edges: DataFrame, roots: DataFrame, depth: int = 3, floor: int | None = None) -> DataFrame:
    """``(root, company, tier)``: suppliers, their suppliers and so on.

    The smallest tier of each pair is kept; a cycle back to the root is not reported.
    """
    links = materialise(
        edges.select(F.col("src_id").alias("at"), F.col("dst_id").alias("next")).filter("at <> next").distinct(), "links"
    )
    roots = materialise(roots.select(F.col("id").alias("root")).distinct(), "roots")
    many_links = hot_keys(links, "at", floor=floor)["at"]
    frontier = roots.select("root", F.col("root").alias("at"))
    seen = frontier
    tiers = []
    for tier in range(1, depth + 1):
        many_roots = hot_keys(frontier, "at", floor=floor)["at"]
        reached = salted_many_join(
            frontier, links, "at", many_roots, many_links, F.col("root"), F.col("next")
        )
        reached = reached.select("root", F.col("next").alias("at")).distinct()
        frontier = materialise(reached.join(seen, ["root", "at"], "left_anti"), "tier")
        if not rows_of(frontier):
            break
        tiers.append(frontier.select("root", F.col("at").alias("company"), F.lit(tier).alias("tier")))
        seen = seen.union(frontier)
    if not tiers:
        return seen.select("root", F.col("at").alias("company"), F.lit(1).alias("tier")).limit(0)
    out = tiers[0]
    for more in tiers[1:]:
        out = out.union(more)
    return out


#: Base-2 logarithm of a sketch's registers, and bytes of a sketch: a relative error of about 1.04 / sqrt(2**12) = 1.6 %.
SKETCH_BITS, SKETCH_BYTES = 12, 4096 + 64


def tier_sizes(edges: DataFrame, depth: int = 3, floor: int | None = None) -> DataFrame:
    """``id, within_1, ..., within_depth``: how many companies each purchaser reaches in at most so many steps.

    For every company at once: a mergeable distinct-count sketch of what a company reaches is handed to those who buy
    from it, so no pairs of a company and what it reaches are formed and a step costs one join and one aggregate over
    the links. Counts are exact while small and then estimates; a company that is reached from itself counts itself.
    """
    links = materialise(edges.select("src_id", "dst_id").filter("src_id <> dst_id").distinct(), "links")
    own = links.groupBy("src_id").agg(F.hll_sketch_agg("dst_id", SKETCH_BITS).alias("sketch"))
    reached = materialise(own, "reached")
    sizes = reached.select(F.col("src_id").alias("id"), F.hll_sketch_estimate("sketch").alias("within_1"))
    hot = None
    for step in range(2, depth + 1):
        table, rows = reached.select(F.col("src_id").alias("dst_id"), "sketch"), rows_of(reached)
        if hot is None and not fits_broadcast(rows, SKETCH_BYTES):
            hot = hot_keys(links, "dst_id", floor=floor)["dst_id"]
        found = lookup(links, table, "dst_id", SKETCH_BYTES, F.col("src_id"), hot=hot or NOT_HOT, rows=rows)
        both = found.select("src_id", "sketch").unionByName(reached)
        reached = materialise(both.groupBy("src_id").agg(F.hll_union_agg("sketch").alias("sketch")), "reached")
        more = reached.select(F.col("src_id").alias("id"), F.hll_sketch_estimate("sketch").alias(f"within_{step}"))
        sizes = sizes.join(more, "id")
    return sizes
