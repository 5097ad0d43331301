"""Companies whose names differ only by legal form are one company."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyloom.functions.names import basename
from supplyloom.operators.components import components
from supplyloom.operators.joins import NOT_HOT, fits_broadcast, hot_keys, lookup
from supplyloom.operators.refine import clean_names
from supplyloom.storage import materialise, rows_of

NAME_BYTES = 128


def named_ids(relations: DataFrame) -> DataFrame:
    """``(id, clean_name)`` of both ends of every relation; nameless ends are left out."""
    ends = F.array(
        F.struct(F.col("src_id").alias("id"), F.col("Purchaser").alias("name")),
        F.struct(F.col("dst_id").alias("id"), F.col("Seller").alias("name")),
    )
    named = relations.select(F.explode(ends).alias("e")).filter(F.col("e.name").isNotNull())
    return named.select("e.id", basename(F.col("e.name")).alias("clean_name"))


def canonical_ids(relations: DataFrame) -> DataFrame:
    """``(clean_name, canonical_id)``: the lowest id among all spellings."""
    return named_ids(relations).groupBy("clean_name").agg(F.min("id").alias("canonical_id"))


def company_components(relations: DataFrame, floor: int | None = None) -> DataFrame:
    """``(id, component)``: ids that share a clean name, or a chain of ids and names, are one company.

    Each name ties its ids to the smallest of them, so the graph has an edge for each spelling and no pairs of ids.
    """
    named = materialise(named_ids(relations).distinct().filter("id IS NOT NULL"), "named")
    lowest = materialise(named.groupBy("clean_name").agg(F.min("id").alias("b")), "lowest")
    pairs = lookup(named, lowest, "clean_name", NAME_BYTES, F.col("id"), rows=rows_of(lowest), floor=floor)
    return components(pairs.select(F.col("id").alias("a"), "b"), floor)


def resolve_entities(relations: DataFrame, floor: int | None = None) -> DataFrame:
    """Cleans both names and re-keys both ends; a nameless end keeps its id."""
    canonical = materialise(canonical_ids(relations), "canonical")
    out = clean_names(relations)
    rows = rows_of(canonical)
    hot = {} if fits_broadcast(rows, NAME_BYTES) else hot_keys(out, "Purchaser", "Seller", floor=floor)
    for name, id_column, other in (("Purchaser", "src_id", "dst_id"), ("Seller", "dst_id", "src_id")):
        table = canonical.select(F.col("clean_name").alias(name), F.col("canonical_id").alias("__id"))
        salt = F.col("eid") if "eid" in relations.columns else F.col(other)
        out = lookup(out, table, name, NAME_BYTES, salt, "left", hot.get(name, NOT_HOT), rows=rows)
        out = out.withColumn(id_column, F.coalesce("__id", id_column)).drop("__id")
    return out.select(*relations.columns)


def resolve_linked_entities(relations: DataFrame, floor: int | None = None) -> DataFrame:
    """Cleans both names and gives both ends the smallest id of their company; a nameless end keeps an unknown id."""
    known = materialise(company_components(relations, floor), "companies")
    out, rows = clean_names(relations), rows_of(known)
    hot = {} if fits_broadcast(rows, 16) else hot_keys(out, "src_id", "dst_id", floor=floor)
    for id_column, other in (("src_id", "dst_id"), ("dst_id", "src_id")):
        table = known.select(F.col("id").alias(id_column), F.col("component").alias("__id"))
        salt = F.col("eid") if "eid" in relations.columns else F.col(other)
        out = lookup(out, table, id_column, 16, salt, "left", hot.get(id_column, NOT_HOT), rows=rows)
        out = out.withColumn(id_column, F.coalesce("__id", id_column)).drop("__id")
    return out.select(*relations.columns)
