"""Relation, dimension and model fixtures derived from the given tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyloom.operators.features import integer_features
from supplyloom.operators.graph import dense_nodes, edges_of
from supplyloom.operators.refine import to_silver
from supplyloom.operators.sage import LayerWeights, LinkModel, endpoint_scores
from supplyloom.plans.training import full_embeddings
from supplyloom.storage import materialise

WIDTH = 4


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RELATION = (
    "event_id as eid",
    "user_id as src_id",
    "cast(regexp_extract(props, '[0-9]+', 0) as bigint) as dst_id",
    """concat('Company#', lpad(user_id, 9, '0'), case event_id % 6 when 0 then ' LLC' when 1 then ' Ltd.'
       when 2 then ', Inc.' when 3 then ' GmbH' when 4 then ' Co. Pty Ltd' else '' end) as Purchaser""",
    """concat('Company#', lpad(regexp_extract(props, '[0-9]+', 0), 9, '0'), case event_id % 5 when 0 then ' Ltd.'
       when 1 then ' S.A.' when 2 then ' llc' when 3 then '' else ' Corp' end) as Seller""",
    "value / (value + 25D) as probability",
)


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buyer-seller relations: an event's user buys from the company in its props."""
    return read(spark, sf_dir, "events").selectExpr(*RELATION)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(relations(spark, sf_dir))


def silver_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges_of(silver(spark, sf_dir))


def order_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-sided graph of customers and suppliers; larger, without overlap of ids.

    Line numbers repeat within an order, so these edges have no id of their own;
    ``edges_of`` numbers them.
    """
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.col("o_custkey").alias("src_id"),
        (F.col("l_suppkey") + 1000000).alias("dst_id"),
    )


def early_order_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order graph of the first three days."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    first = orders.agg(F.date_add(F.min(F.col("o_orderdate").cast("date")), 3).alias("until"))
    early = orders.join(F.broadcast(first), F.col("o_orderdate").cast("date") < F.col("until"))
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    return lines.join(early, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("src_id"), (F.col("l_suppkey") + 1000000).alias("dst_id")
    )


def company_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation, region = (read(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("c_custkey").alias("company_id"),
            F.expr("concat('Company#', lpad(c_custkey, 9, '0'))").alias("company"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
        )
    )


def company_risk_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    premium = ((F.col("n_nationkey") * 37) % 100).cast("double") / F.lit(10.0)
    return read(spark, sf_dir, "nation").select(F.col("n_name").alias("country"), premium.alias("risk_premium"))


def company_risk_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("company_id"), (F.col("c_acctbal") / F.lit(10000.0)).alias("risk_score")
    )


def _weights(k: int) -> np.ndarray:
    i, j = np.arange(WIDTH)[:, None], np.arange(WIDTH)[None, :]
    return ((3 * i + 5 * j + 2 * k) % 7 - 3) / 4.0


def fixed_model(aggregator: str = "mean") -> LinkModel:
    """Weights that are multiples of 1/4, so both engines add them up alike."""
    bias = np.full(WIDTH, 125.0)
    pools = [(_weights(k), bias) if aggregator == "pool" else (None, None) for k in (2, 5)]
    layers = [
        LayerWeights(_weights(k), _weights(k + 1), bias, *pool) for k, pool in zip((0, 3), pools)
    ]
    j = np.arange(2 * WIDTH)
    return LinkModel(*layers, ((3 * j + 1) % 5 - 2) / 4.0 / 1000.0, 1.0, aggregator)


def wide_model(aggregator: str, width: int, hidden: int) -> LinkModel:
    """The same rule of weights at other widths: ``width`` -> ``hidden`` -> ``width``."""

    def weights(k: int, rows: int, columns: int) -> np.ndarray:
        i, j = np.arange(rows)[:, None], np.arange(columns)[None, :]
        return ((3 * i + 5 * j + 2 * k) % 7 - 3) / 4.0

    layers = []
    for k, columns, rows in ((0, width, hidden), (3, hidden, width)):
        pool = (weights(k + 2, columns, columns), np.full(columns, 125.0)) if aggregator == "pool" else (None, None)
        layers.append(LayerWeights(weights(k, rows, columns), weights(k + 1, rows, columns), np.full(rows, 125.0), *pool))
    return LinkModel(*layers, np.zeros(2 * width), 0.0, aggregator)


def fixed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer features of all ids 0..max of the silver edges."""
    return integer_features(dense_nodes(silver_edges(spark, sf_dir)), WIDTH)


def fixed_embeddings(spark: SparkSession, sf_dir: str, aggregator: str = "mean") -> DataFrame:
    return full_embeddings(
        silver_edges(spark, sf_dir), fixed_features(spark, sf_dir), fixed_model(aggregator)
    )


def fixed_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Endpoint scores of the fixed model."""
    return materialise(endpoint_scores(fixed_embeddings(spark, sf_dir), fixed_model()), "companies")
