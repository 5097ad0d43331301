"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyloom.functions.activations import sigmoid
from supplyloom.functions.vectors import linear_score
from supplyloom.operators import entities, features, graph, inner_product, metrics, profile, projection, refine, risk, sampling, scale_free, scoring
from supplyloom.operators.sage import MessageGraph, embed_new, neighbour_max, neighbour_mean, pool_inputs, sage_layer
from supplyloom.params import DEFAULT, TUNED
from supplyloom.plans import bucketed
from supplyloom.plans import fixtures as fx
from supplyloom.plans import search as hyper
from supplyloom.plans import sql_surface
from supplyloom.plans import training as fit
from supplyloom.plans.gold import build_gold, write_gold
from supplyloom.plans.weights import load_weights, save_weights
from supplyloom.sources import tables
from supplyloom.sources.schemas import BRONZE, EDGES, model_signature, require, typed
from supplyloom.storage import materialise, rows_of, scratch_path
from supplyloom.streaming import embeddings as follow
from supplyloom.streaming import ingest, monitor

Query = Callable[[SparkSession, str], DataFrame]
_registry: dict[str, Query] = {}

SPLIT_PARAMS = DEFAULT
NEGATIVES = 3
BATCH = 64
#: The link model is fitted on at most FIT_ROWS training edges, in TRAIN_STEPS batches of equal size: the first
#: ones of the seeded random order. Scoring and evaluation cover all edges.
FIT_ROWS, TRAIN_STEPS = 1_000_000, 12


def _train_params(edges: DataFrame):
    """The steps are as many for any table; batches grow with it up to the bound."""
    params = DEFAULT.with_(num_negative_samples=3, max_steps=TRAIN_STEPS, lr=0.01)
    training = int(rows_of(edges) * (1 - params.test_p - params.valid_p))
    return params.with_(batch_size=max(1, min(training, FIT_ROWS) // TRAIN_STEPS))


def query(f: Query) -> Query:
    _registry[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_registry)


# The fixed weights make many values multiples of small powers of two, which lie
# exactly between two 6-digit decimals. This shift moves them off those ties.
OFF_TIE = 1.3e-7


def _off_tie(value):
    return F.round(value + F.lit(OFF_TIE), 6)


def _r(*names: str):
    return [F.round(n, 6).alias(n) for n in names]


def _long(vectors: DataFrame, key: str = "id", column: str = "x") -> DataFrame:
    """Vectors as ``(id, dim, value)`` rows, so that any SQL engine can compare them."""
    return vectors.select(F.col(key).alias("id"), F.posexplode(column).alias("dim", "v")).select(
        "id", "dim", _off_tie(F.col("v")).alias("value")
    )


# --- relational core ---------------------------------------------------------


@query
def confidence_filter(spark, sf_dir):
    return refine.confidence_filter(fx.relations(spark, sf_dir)).select("eid", "src_id", "dst_id", *_r("probability"))


@query
def clean_names(spark, sf_dir):
    return refine.clean_names(fx.relations(spark, sf_dir)).select("eid", "Purchaser", "Seller")


@query
def cast_probability(spark, sf_dir):
    """Confidence as text, with words among the numbers."""
    text = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("value").cast("string"))
    raw = fx.read(spark, sf_dir, "events").select(F.col("event_id").alias("eid"), text.alias("probability"))
    return refine.cast_probability(raw).select("eid", *_r("probability"))


@query
def silver_relations(spark, sf_dir):
    return fx.silver(spark, sf_dir).select("eid", "src_id", "dst_id", "Purchaser", "Seller", *_r("probability"))


@query
def edge_projection(spark, sf_dir):
    return refine.edge_columns(fx.silver(spark, sf_dir), "eid")


@query
def csv_dimension(spark, sf_dir):
    """Country premiums through a CSV file: header, inferred types."""
    path = scratch_path(spark, "csv")
    fx.company_risk_data(spark, sf_dir).write.option("header", True).csv(path)
    return tables.read_csv(spark, path).select("country", *_r("risk_premium"))


@query
def probability_profile(spark, sf_dir):
    out = profile.probability_profile(fx.relations(spark, sf_dir))
    floats = [f.name for f in out.schema.fields if f.dataType.simpleString() == "double"]
    return out.select("n", "n_missing", "n_outliers", *_r(*floats))


@query
def probability_histogram(spark, sf_dir):
    return profile.probability_histogram(fx.relations(spark, sf_dir)).select("bin", "n", *_r("bin_start", "density"))


@query
def probability_density(spark, sf_dir):
    return profile.density_curve(fx.relations(spark, sf_dir)).select(*_r("at", "density"))


# --- graph -------------------------------------------------------------------


@query
def graph_counts(spark, sf_dir):
    return graph.graph_counts(fx.silver_edges(spark, sf_dir))


@query
def node_set(spark, sf_dir):
    return graph.node_set(fx.silver_edges(spark, sf_dir))


@query
def degrees(spark, sf_dir):
    return graph.degrees(fx.silver_edges(spark, sf_dir))


@query
def degree_distribution(spark, sf_dir):
    return graph.degree_distribution(fx.silver_edges(spark, sf_dir))


@query
def hubs(spark, sf_dir):
    return graph.hubs(fx.silver_edges(spark, sf_dir))


@query
def degree_power_law(spark, sf_dir):
    return scale_free.power_law(fx.silver_edges(spark, sf_dir)).select("direction", "cutoff", "n_tail", *_r("exponent", "distance"))


@query
def order_graph_counts(spark, sf_dir):
    return graph.graph_counts(fx.order_edges(spark, sf_dir))


def _split(spark, sf_dir):
    return graph.edge_split(fx.silver_edges(spark, sf_dir), SPLIT_PARAMS.test_p, SPLIT_PARAMS.valid_p)


@query
def edge_split(spark, sf_dir):
    return _split(spark, sf_dir)


@query
def edge_split_sizes(spark, sf_dir):
    return _split(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n_edges"))


@query
def edge_batches(spark, sf_dir):
    return graph.shuffled_batches(_split(spark, sf_dir), BATCH)


@query
def capped_batches(spark, sf_dir):
    batched = graph.shuffled_batches(_split(spark, sf_dir), BATCH)
    capped = graph.first_batches(batched, 10)
    return capped.groupBy("split", "batch_id").agg(F.count(F.lit(1)).alias("n_edges"))


@query
def node_features(spark, sf_dir):
    nodes = graph.node_set(fx.silver_edges(spark, sf_dir))
    return _long(features.normal_features(nodes, DEFAULT.num_node_features, DEFAULT.seed))


@query
def given_node_features(spark, sf_dir):
    nodes = graph.node_set(fx.silver_edges(spark, sf_dir))
    vectors = fx.read(spark, sf_dir, "embeddings")
    return _long(features.given_features(nodes, vectors, "vec_id", "embedding", 64))


@query
def exact_sample(spark, sf_dir):
    return graph.exact_sample(graph.node_set(fx.silver_edges(spark, sf_dir)), 0.1, "id")


# --- sampling ----------------------------------------------------------------


@query
def fanout_sample(spark, sf_dir):
    return sampling.fanout_sample(fx.silver_edges(spark, sf_dir), 1)


@query
def two_hop_blocks(spark, sf_dir):
    """Blocks of the companies at either end of all edges and of their negatives."""
    seeds = graph.node_set(_examples(spark, sf_dir))
    return sampling.two_hop_blocks(seeds, fx.silver_edges(spark, sf_dir))


@query
def fresh_blocks(spark, sf_dir):
    """Neighbourhoods of the first batches' companies, drawn anew for each batch from one bucketed table."""
    edges = fx.silver_edges(spark, sf_dir)
    batched = materialise(graph.first_batches(graph.shuffled_batches(edges, BATCH, by=[]), 4), "batches")
    laid_out, out = bucketed.bucketed_graph(materialise(edges, "edges")), None
    try:
        for batch in range(4):
            blocks = bucketed.fresh_blocks(laid_out, graph.node_set(batched.filter(F.col("batch_id") == batch)), batch)
            blocks = materialise(blocks.withColumn("batch_id", F.lit(batch).cast("long")), "blocks")
            out = blocks if out is None else out.unionByName(blocks)
        return out
    finally:
        laid_out.drop()


@query
def negatives_uniform(spark, sf_dir):
    edges = fx.silver_edges(spark, sf_dir)
    return sampling.uniform_negatives(edges, NEGATIVES, nodes=graph.node_set(edges))


def _dense_count(spark, sf_dir) -> int:
    top = fx.silver_edges(spark, sf_dir).agg(F.max(F.greatest("src_id", "dst_id")).alias("top")).first().top
    return 0 if top is None else top + 1


@query
def negatives_dense(spark, sf_dir):
    return sampling.uniform_negatives(
        fx.silver_edges(spark, sf_dir), NEGATIVES, dense_count=_dense_count(spark, sf_dir)
    )


@query
def negatives_strict(spark, sf_dir):
    edges = fx.silver_edges(spark, sf_dir)
    return sampling.strict_negatives(edges, NEGATIVES, edges, nodes=graph.node_set(edges))


@query
def negatives_strict_exact(spark, sf_dir):
    edges = fx.silver_edges(spark, sf_dir)
    return sampling.exact_negatives(edges, NEGATIVES, edges, nodes=graph.node_set(edges))


def _examples(spark, sf_dir, edges: DataFrame | None = None):
    """Positives and negatives of the silver edges, or of given ones with columns of their own."""
    edges = fx.silver_edges(spark, sf_dir) if edges is None else edges
    negatives = sampling.uniform_negatives(edges, NEGATIVES, dense_count=_dense_count(spark, sf_dir))
    return sampling.labelled_examples(edges, negatives)


@query
def labelled_examples(spark, sf_dir):
    return _examples(spark, sf_dir)


# --- encoder with fixed weights ----------------------------------------------


def _fixed(spark, sf_dir):
    edges = fx.silver_edges(spark, sf_dir)
    return materialise(fx.fixed_features(spark, sf_dir), "features"), MessageGraph.of(sampling.full_neighbours(edges))


@query
def neighbour_mean_features(spark, sf_dir):
    x, messages = _fixed(spark, sf_dir)
    return _long(neighbour_mean(messages, x, fx.WIDTH), "node_id", "agg")


@query
def neighbour_max_features(spark, sf_dir):
    x, messages = _fixed(spark, sf_dir)
    pooled = materialise(pool_inputs(x, fx.fixed_model("pool").layer1), "pooled")
    return _long(neighbour_max(messages, pooled, fx.WIDTH), "node_id", "agg")


@query
def sage_layer_mean(spark, sf_dir):
    x, messages = _fixed(spark, sf_dir)
    return _long(sage_layer(x, messages, fx.fixed_model().layer1, "mean", True))


@query
def sage_layer_pool(spark, sf_dir):
    x, messages = _fixed(spark, sf_dir)
    return _long(sage_layer(x, messages, fx.fixed_model("pool").layer1, "pool", True))


@query
def sage_embeddings(spark, sf_dir):
    return _long(fx.fixed_embeddings(spark, sf_dir))


@query
def sage_embeddings_pool(spark, sf_dir):
    return _long(fx.fixed_embeddings(spark, sf_dir, "pool"))


@query
def sage_embeddings_rectified(spark, sf_dir):
    """The variant whose last layer also goes through a ReLU."""
    edges, x = fx.silver_edges(spark, sf_dir), fx.fixed_features(spark, sf_dir)
    return _long(fit.full_embeddings(edges, x, fx.fixed_model(), final_relu=True))


def _wide(spark, sf_dir, aggregator: str, width: int, hidden: int):
    edges = fx.silver_edges(spark, sf_dir)
    x = features.integer_features(graph.dense_nodes(edges), width)
    return _long(fit.full_embeddings(edges, x, fx.wide_model(aggregator, width, hidden)))


@query
def sage_embeddings_default_width(spark, sf_dir):
    """15 -> 20 -> 15, the widths of the default preset."""
    return _wide(spark, sf_dir, "mean", DEFAULT.num_node_features, DEFAULT.hidden_dim)


@query
def sage_embeddings_tuned_width(spark, sf_dir):
    """50 -> 100 -> 50 with max-pooling, the widths of the tuned preset."""
    return _wide(spark, sf_dir, "pool", TUNED.num_node_features, TUNED.hidden_dim)


@query
def sampled_embeddings(spark, sf_dir):
    edges, x = fx.silver_edges(spark, sf_dir), fx.fixed_features(spark, sf_dir)
    return _long(fit.sampled_embeddings(edges, x, fx.fixed_model(), DEFAULT))


@query
def new_company_embeddings(spark, sf_dir):
    """Companies of the order graph that are not in its first days, embedded with frozen weights."""
    edges = fx.order_edges(spark, sf_dir)
    known = graph.node_set(fx.early_order_edges(spark, sf_dir))
    new = graph.node_set(edges).join(known, "id", "left_anti")
    x = features.integer_features(graph.node_set(edges), fx.WIDTH)
    return _long(embed_new(new, x, edges, fx.fixed_model()))


@query
def order_graph_embeddings(spark, sf_dir):
    edges = fx.order_edges(spark, sf_dir)
    x = features.integer_features(graph.node_set(edges), fx.WIDTH)
    return _long(fit.full_embeddings(edges, x, fx.fixed_model()))


# --- scores ------------------------------------------------------------------


@query
def link_score_linear(spark, sf_dir):
    """The score computed on the vectors themselves, per distinct pair."""
    h = materialise(fx.fixed_embeddings(spark, sf_dir), "embeddings")
    model = fx.fixed_model()
    pairs = fx.silver_edges(spark, sf_dir).select("src_id", "dst_id").distinct()
    rows = pairs.join(h.select(F.col("id").alias("src_id"), F.col("x").alias("hu")), "src_id").join(
        h.select(F.col("id").alias("dst_id"), F.col("x").alias("hv")), "dst_id"
    )
    logit = linear_score(F.col("hu"), F.col("hv"), model.score_w, model.score_b)
    return rows.select("src_id", "dst_id", _off_tie(logit).alias("logit"), F.round(sigmoid(logit), 6).alias("score"))


@query
def link_score_dot(spark, sf_dir):
    h = materialise(fx.fixed_embeddings(spark, sf_dir), "embeddings")
    pairs = fx.silver_edges(spark, sf_dir).select("src_id", "dst_id").distinct()
    scored = scoring.dot_scores(pairs, h, fx.WIDTH)
    return scored.select("src_id", "dst_id", _off_tie(F.col("logit") / F.lit(1e6)).alias("logit"))


@query
def score_relations(spark, sf_dir):
    scored = scoring.score_relations(
        fx.silver(spark, sf_dir), fx.fixed_companies(spark, sf_dir), fx.fixed_model().score_b
    )
    return scored.select(
        "eid", "src_id", "dst_id", "Purchaser", "Seller", *_r("probability", "gnn_prediction")
    )


def _gold(spark, sf_dir):
    return build_gold(fx.silver(spark, sf_dir), fx.fixed_model(), fx.fixed_features(spark, sf_dir))


@query
def review_links(spark, sf_dir):
    return _gold(spark, sf_dir).review.select("Purchaser", "Seller", *_r("probability", "gnn_prediction"))


@query
def review_sql(spark, sf_dir):
    """The review as a SQL cell over views and SQL functions."""
    sql_surface.create_views(spark, fx.relations(spark, sf_dir), fx.fixed_companies(spark, sf_dir))
    sql_surface.register(spark)
    return spark.sql(
        f"""SELECT Purchaser, Seller, round(probability, 6) AS probability, round(gnn_prediction, 6) AS gnn_prediction
            FROM loom_review({fx.fixed_model().score_b}D)"""
    )


@query
def refined_sql(spark, sf_dir):
    sql_surface.create_views(spark, fx.relations(spark, sf_dir), fx.fixed_companies(spark, sf_dir))
    sql_surface.register(spark)
    return spark.sql(
        f"""SELECT eid, src_id, dst_id, Purchaser, Seller, round(loom_refined(gnn_prediction, probability), 6) AS probability
            FROM loom_predictions({fx.fixed_model().score_b}D)"""
    )


@query
def gold_refined(spark, sf_dir):
    out = _gold(spark, sf_dir).refined
    return out.select("eid", "src_id", "dst_id", "Purchaser", "Seller", *_r("probability"))


@query
def rejected_links(spark, sf_dir):
    out = scoring.rejected_links(
        fx.relations(spark, sf_dir), fx.fixed_companies(spark, sf_dir), fx.fixed_model().score_b
    )
    return out.select("eid", "src_id", "dst_id", "admitted", *_r("probability", "gnn_prediction"))


@query
def topk_missing_links(spark, sf_dir):
    out = scoring.topk_missing_links(
        fx.silver_edges(spark, sf_dir), fx.fixed_companies(spark, sf_dir), fx.fixed_model().score_b, 5
    )
    return out.select("src_id", "dst_id", "place", *_r("gnn_prediction"))


@query
def topk_missing_dot(spark, sf_dir):
    """Vectors on a whole-number grid, so that both engines add their products up alike."""
    h = fx.fixed_embeddings(spark, sf_dir).select("id", F.transform("x", lambda v: F.floor(v + F.lit(0.1234567)).cast("double")).alias("x"))
    out = inner_product.topk_missing_dot(fx.silver_edges(spark, sf_dir), materialise(h, "embeddings"), fx.WIDTH, 5)
    return out.select("src_id", "dst_id", "place", "logit")


# --- metrics and losses ------------------------------------------------------


def _tied(scored: DataFrame) -> DataFrame:
    """Scores that are equal but for the order of their additions become ties (shifted as above)."""
    return scored.withColumn("score", F.round(F.col("score") + F.lit(1.3e-10), 9))


def _scored_examples(spark, sf_dir, edges: DataFrame | None = None):
    examples = _examples(spark, sf_dir, edges)
    scored = scoring.with_logit(examples, fx.fixed_companies(spark, sf_dir), fx.fixed_model().score_b, "inner")
    return _tied(scored.withColumnRenamed("logit", "score"))


def _batched_scores(spark, sf_dir):
    """Edges carry their batch into their negatives."""
    return _scored_examples(spark, sf_dir, graph.shuffled_batches(fx.silver_edges(spark, sf_dir), BATCH, by=[]))


@query
def auc_ap_by_batch(spark, sf_dir):
    out = metrics.auc_ap(_batched_scores(spark, sf_dir), ["batch_id"], bounded=True)
    return out.select("batch_id", "n_examples", *_r("auc", "ap"))


@query
def auc_ap_mean(spark, sf_dir):
    out = metrics.mean_auc_ap(metrics.auc_ap(_batched_scores(spark, sf_dir), ["batch_id"], bounded=True))
    return out.select("n_batches", *_r("mean_auc", "mean_ap"))


@query
def metric_log(spark, sf_dir):
    """The per-batch metrics appended to a metric table and read back."""
    per_batch = metrics.auc_ap(_batched_scores(spark, sf_dir), ["batch_id"], bounded=True)
    path = scratch_path(spark, "metriclog")
    names = {"auc": "AUC", "ap": "AP"}
    metrics.append_metrics(metrics.as_metrics(per_batch, "fixed", "all", F.col("batch_id"), names), path)
    return metrics.read_metrics(spark, path).select("run_id", "split", "step", "name", *_r("value"))


@query
def evaluate_fixed_model(spark, sf_dir):
    """AUC and AP per batch of the held-out splits under the fixed weights."""
    params = DEFAULT.with_(num_node_features=fx.WIDTH, batch_size=BATCH, num_negative_samples=NEGATIVES)
    data = fit.split_graph(fx.silver_edges(spark, sf_dir), params, fx.fixed_features(spark, sf_dir))
    model = fx.fixed_model()
    shared = fit.scorer(data, model, params)
    out = None
    for split in ("validation", "testing"):
        scored = _tied(fit.scored_split(data, split, shared, params))
        rows = metrics.auc_ap(scored, ["batch_id"], bounded=True).withColumn("split", F.lit(split))
        out = rows if out is None else out.unionByName(rows)
    return out.select("split", "batch_id", "n_examples", *_r("auc", "ap"))


@query
def auc_ap_pooled(spark, sf_dir):
    """All examples as one ranking."""
    return metrics.auc_ap(_scored_examples(spark, sf_dir)).select("n_examples", *_r("auc", "ap"))


@query
def bce_loss(spark, sf_dir):
    return metrics.bce_loss(_scored_examples(spark, sf_dir)).select(*_r("bce_loss"))


@query
def margin_loss(spark, sf_dir):
    return metrics.margin_loss(_scored_examples(spark, sf_dir)).select(*_r("margin_loss"))


# --- risk views --------------------------------------------------------------


def _enriched(spark, sf_dir):
    profiles = risk.company_profiles(
        fx.company_locations(spark, sf_dir), fx.company_risk_data(spark, sf_dir), fx.company_risk_frame(spark, sf_dir)
    )
    return risk.enrich(_gold(spark, sf_dir).refined, profiles)


@query
def risk_enriched(spark, sf_dir):
    sides = [f"{s}_{c}" for s in ("buyer", "seller") for c in ("country", "region")]
    numbers = [f"{s}_{c}" for s in ("buyer", "seller") for c in ("risk_premium", "risk_score")]
    return _enriched(spark, sf_dir).select("eid", "src_id", "dst_id", "Purchaser", "Seller", *sides, *_r("probability", *numbers))


@query
def risk_by_country(spark, sf_dir):
    return risk.risk_by_country(_enriched(spark, sf_dir)).select(
        "buyer_country", "seller_country", "n_relations",
        *_r("expected_relations", "seller_risk_premium", "mean_seller_risk_score"),
    )


@query
def supplier_tiers(spark, sf_dir):
    """Three tiers of suppliers behind the companies of a watch list: those of low risk scores."""
    watched = fx.company_risk_frame(spark, sf_dir).filter("risk_score < -0.05").select(F.col("company_id").alias("id"))
    return risk.supplier_tiers(fx.silver_edges(spark, sf_dir), watched, 3)


@query
def tier_sizes(spark, sf_dir):
    """Every company's reach. The sketches are exact in this range of counts."""
    return risk.tier_sizes(fx.silver_edges(spark, sf_dir), 3)


@query
def entity_resolution(spark, sf_dir):
    """Each spelling of a name starts with an id of its own."""
    raw = fx.relations(spark, sf_dir)
    spelled = raw.withColumn("src_id", F.col("src_id") * 10 + F.col("eid") % 6).withColumn(
        "dst_id", F.col("dst_id") * 10 + F.col("eid") % 5
    )
    return entities.resolve_entities(spelled).select("eid", "src_id", "dst_id", "Purchaser", "Seller")


@query
def entity_components(spark, sf_dir):
    """As above, and in every five companies three share ids in a chain: some relations name the next company."""
    raw = fx.relations(spark, sf_dir)
    turned = (F.col("src_id") % 5 < 2) & (F.col("eid") % 7 == 0)
    following = F.expr("concat('Company#', lpad(src_id + 1, 9, '0'), ' LLC')")
    spelled = raw.withColumns(
        {
            "Purchaser": F.when(turned, following).otherwise(F.col("Purchaser")),
            "src_id": F.col("src_id") * 10 + F.col("eid") % 6,
            "dst_id": F.col("dst_id") * 10 + F.col("eid") % 5,
        }
    )
    return entities.resolve_linked_entities(spelled).select("eid", "src_id", "dst_id", "Purchaser", "Seller")


# --- streams -----------------------------------------------------------------


def _landed(spark, sf_dir) -> str:
    """The relations as JSON lines in a landing folder."""
    path = scratch_path(spark, "landing")
    fx.relations(spark, sf_dir).select("Purchaser", "Seller", "src_id", "dst_id", "probability").write.json(path)
    return path


def _streamed(spark, sf_dir, silver: bool) -> DataFrame:
    work = scratch_path(spark, "stream")
    ingest.ingest_bronze(spark, _landed(spark, sf_dir), f"{work}/bronze", f"{work}/bronze-checkpoint")
    if silver:
        ingest.refine_silver(spark, f"{work}/bronze", f"{work}/silver", f"{work}/silver-checkpoint")
    return typed(tables.read_path(spark, f"{work}/{'silver' if silver else 'bronze'}", merge_schema=True), BRONZE)


@query
def stream_bronze(spark, sf_dir):
    return _streamed(spark, sf_dir, False).select("Purchaser", "Seller", "src_id", "dst_id", *_r("probability"))


@query
def stream_silver(spark, sf_dir):
    return _streamed(spark, sf_dir, True).select("Purchaser", "Seller", "src_id", "dst_id", *_r("probability"))


@query
def stream_score(spark, sf_dir):
    work = scratch_path(spark, "score")
    silver = f"{work}/silver"
    landed = _landed(spark, sf_dir)
    ingest.ingest_bronze(spark, landed, f"{work}/bronze", f"{work}/c1")
    ingest.refine_silver(spark, f"{work}/bronze", silver, f"{work}/c2")
    companies = fx.fixed_companies(spark, sf_dir)
    ingest.score_arrivals(spark, silver, companies, fx.fixed_model().score_b, f"{work}/scored", f"{work}/c3")
    return tables.read_path(spark, f"{work}/scored").select(
        "Purchaser", "Seller", "src_id", "dst_id", *_r("probability", "gnn_prediction", "refined_probability")
    )


@query
def stream_metrics(spark, sf_dir):
    """Lines read, unparsed and kept in each batch of three landings; a call after the last finds nothing new."""
    work, watch = scratch_path(spark, "watched"), monitor.BatchMetrics("landing")
    rows, log = fx.relations(spark, sf_dir), f"{work}/metrics"
    columns = ["Purchaser", "Seller", "src_id", "dst_id", "probability"]
    for landing in (0, 1, 2, None):
        if landing is not None:
            part = rows.filter(F.col("eid") % 3 == landing)
            part.select(*columns).write.mode("append").json(f"{work}/landing")
            broken = part.agg(F.concat(F.lit('{"Purchaser": "broken '), F.count(F.lit(1)).cast("string")).alias("value"))
            broken.coalesce(1).write.mode("append").text(f"{work}/landing")
        ingest.ingest_bronze(spark, f"{work}/landing", f"{work}/bronze", f"{work}/c1", watch=watch)
        ingest.refine_silver(spark, f"{work}/bronze", f"{work}/silver", f"{work}/c2", watch=watch)
        watch.flush(spark, log)
    return metrics.read_metrics(spark, log).select("run_id", "split", "step", "name", *_r("value"))


@query
def stream_embeddings(spark, sf_dir):
    """Embeddings kept up to date over three landings, as they stand after each."""
    work = scratch_path(spark, "follow")
    rows, out = fx.relations(spark, sf_dir), None
    columns = ["Purchaser", "Seller", "src_id", "dst_id", "probability"]
    for landing in range(3):
        rows.filter(F.col("eid") % 3 == landing).select(*columns).write.mode("append").json(f"{work}/landing")
        ingest.ingest_bronze(spark, f"{work}/landing", f"{work}/bronze", f"{work}/c1")
        ingest.refine_silver(spark, f"{work}/bronze", f"{work}/silver", f"{work}/c2")
        follow.follow_embeddings(
            spark, f"{work}/silver", f"{work}/state", f"{work}/c3", lambda ids: features.integer_features(ids, fx.WIDTH), fx.fixed_model()
        )
        now = _long(materialise(follow.current_embeddings(spark, f"{work}/state"), "follow")).withColumn("landing", F.lit(landing))
        out = now if out is None else out.unionByName(now)
    return out


def _mixed_landing(spark, sf_dir) -> str:
    """Relations whose confidence is a number in some records and text in others."""
    path = scratch_path(spark, "landing")
    rows = fx.relations(spark, sf_dir).select("eid", "Purchaser", "Seller", "src_id", "dst_id", "probability")
    rows.filter("eid % 2 = 0").drop("eid").write.json(path)
    rows.filter("eid % 2 = 1").withColumn("probability", F.col("probability").cast("string")).drop("eid").write.mode(
        "append"
    ).json(path)
    return path


@query
def stream_text_confidence(spark, sf_dir):
    """Silver of a landing folder that mixes numbers and text."""
    work = scratch_path(spark, "stream")
    ingest.ingest_bronze(spark, _mixed_landing(spark, sf_dir), f"{work}/bronze", f"{work}/c1")
    ingest.refine_silver(spark, f"{work}/bronze", f"{work}/silver", f"{work}/c2")
    return tables.read_path(spark, f"{work}/silver").select("Purchaser", "Seller", "src_id", "dst_id", *_r("probability"))


@query
def stream_evolving(spark, sf_dir):
    """Three landings: whole-number ranks, fractional ranks with a new column, and a line that does not parse."""
    work, landing = scratch_path(spark, "stream"), scratch_path(spark, "landing")
    columns = ["Purchaser", "Seller", "src_id", "dst_id", "probability"]
    rows = fx.relations(spark, sf_dir)
    whole = F.col("eid").alias("rank")
    half = (F.col("eid") + F.lit(0.5)).alias("rank")
    tier = (F.col("eid") % 5).alias("tier")
    landings = (
        rows.filter("eid % 3 = 0").select(*columns, whole),
        rows.filter("eid % 3 = 1").select(*columns, half, tier),
        rows.filter("eid % 3 = 2").select(*columns, half, tier),
    )
    for i, part in enumerate(landings):
        part.write.mode("append").json(landing)
        if i == 2:
            broken = rows.agg(F.concat(F.lit('{"Purchaser": "broken '), F.count(F.lit(1)).cast("string")).alias("value"))
            broken.coalesce(1).write.mode("append").text(landing)
        ingest.ingest_bronze(spark, landing, f"{work}/bronze", f"{work}/c1", schema_location=f"{work}/schema")
        ingest.refine_silver(spark, f"{work}/bronze", f"{work}/silver", f"{work}/c2", schema_location=f"{work}/schema")
    names = [*columns, "rank", "tier"]
    bronze = ingest.read_typed(spark, f"{work}/bronze", f"{work}/schema")
    silver = ingest.read_typed(spark, f"{work}/silver", f"{work}/schema")
    both = bronze.select(*names, F.lit("bronze").alias("layer")).unionByName(
        silver.select(*names, F.lit("silver").alias("layer"))
    )
    return both.select("layer", "Purchaser", "Seller", "src_id", "dst_id", "tier", *_r("probability", "rank"))


# --- tables ------------------------------------------------------------------


@query
def namespace_tables(spark, sf_dir):
    """Dimension tables loaded from CSV and the gold tables, in a database of their own: rows and columns of each."""
    work = scratch_path(spark, "namespace")
    database = f"loom_{work.rsplit('-', 1)[-1]}"
    before = spark.catalog.currentDatabase()
    frames = {"company_risk_data": fx.company_risk_data, "company_locations": fx.company_locations, "company_risk_frame": fx.company_risk_frame}
    for name, frame in frames.items():
        frame(spark, sf_dir).write.option("header", True).csv(f"{work}/{name}.csv")
    tables.use_database(spark, database, location=f"{work}/{database}")
    try:
        tables.load_dimension_tables(spark, work)
        write_gold(_gold(spark, sf_dir), "gold_predictions", "gold_refined")
        out = None
        for name in (*tables.DIMENSION_TABLES, "gold_predictions", "gold_refined"):
            table = tables.read_table(spark, name)
            columns = ",".join(sorted(table.columns))
            rows = table.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.lit(columns).alias("columns"))
            out = rows if out is None else out.unionByName(rows)
        return materialise(out, "namespace")
    finally:
        tables.use_database(spark, before, create=False)
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


@query
def preview_sorted(spark, sf_dir):
    """The preview of a table that is ordered by its key."""
    ordered = fx.silver(spark, sf_dir).orderBy("eid")
    return tables.preview(ordered, 100).select("eid", "src_id", "dst_id", *_r("probability"))


@query
def contract_check(spark, sf_dir):
    """Which tables keep the edge contract of the link scorer, with their edges."""
    silver = fx.silver(spark, sf_dir)
    given = {"silver": silver, "text_ids": silver.withColumn("src_id", F.col("src_id").cast("string")), "no_seller": silver.drop("dst_id")}
    out = None
    for name, frame in given.items():
        try:
            model_signature(require(frame, EDGES))
            kept = True
        except ValueError:
            kept = False
        row = frame.agg(F.lit(name).alias("name"), F.lit(kept).alias("kept"), F.count(F.lit(1)).alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


@query
def latest_weights(spark, sf_dir):
    """Three saved versions of a model, each scaled by what the table holds; the last one is loaded."""
    path = scratch_path(spark, "weights")
    n = fx.silver_edges(spark, sf_dir).count()
    for version in (1, 2, 3):
        save_weights(spark, {"score.w": np.arange(4.0) * version, "score.b": np.array([float(n * version)])}, "mean", path, version)
    weights, _ = load_weights(spark, path)
    rows = [(name, i, float(v)) for name, w in weights.items() for i, v in enumerate(w.ravel())]
    return spark.createDataFrame(rows, "name string, place int, value double")


@query
def best_trial(spark, sf_dir):
    """The trial of the lowest loss, of losses given as a table: event values by user."""
    losses = fx.read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("trial")).agg(
        F.max("value").alias("loss"), F.max("event_type").alias("params")
    )
    return hyper.best_trial(losses).select("trial", "params", *_r("loss"))


# --- learning ----------------------------------------------------------------


@query
def train_score_head(spark, sf_dir):
    """Three gradient steps of the scorer on fixed embeddings, scaled to about one."""
    h = fx.fixed_embeddings(spark, sf_dir).select("id", F.transform("x", lambda v: v / F.lit(1e4)).alias("h"))
    h = materialise(h, "embeddings")
    ends = _examples(spark, sf_dir)
    for key, name in (("src_id", "hu"), ("dst_id", "hv")):
        ends = ends.join(h.select(F.col("id").alias(key), F.col("h").alias(name)), key)
    rows = materialise(ends.select("label", "hu", "hv"), "examples")
    return fit.train_score_head(rows, fx.WIDTH, 3, 0.5).select("step", "place", *_r("value"))


@query
def batch_losses(spark, sf_dir):
    """Loss and bias gradient of the first batches of a fit, all under the fixed weights."""
    params = DEFAULT.with_(num_node_features=fx.WIDTH, hidden_dim=fx.WIDTH, batch_size=BATCH, num_negative_samples=NEGATIVES, exclude_targets=False)
    data = fit.split_graph(fx.silver_edges(spark, sf_dir), params, fx.fixed_features(spark, sf_dir))
    losses = fit.batch_losses(data, fit.weights_of(fx.fixed_model()), params, 5)
    return losses.select("batch_id", *_r("loss", "bias_gradient"))


@query
def train_link_model(spark, sf_dir):
    """Metric log of a fit on the training edges of the silver graph."""
    edges = materialise(fx.silver_edges(spark, sf_dir), "edges")
    params = _train_params(edges)
    return fit.train(fit.split_graph(edges, params), params).metrics


@query
def evaluate_link_model(spark, sf_dir):
    edges = materialise(fx.silver_edges(spark, sf_dir), "edges")
    params = _train_params(edges)
    data = fit.split_graph(edges, params)
    return fit.evaluation_metrics(data, fit.train(data, params).model, params)


@query
def param_search(spark, sf_dir):
    """All trials over the whole space, with the batches and steps that they draw."""
    edges = materialise(fx.silver_edges(spark, sf_dir), "edges")
    trials = hyper.search(edges, hyper.draw_trials())
    best = hyper.best_trial(trials).select(F.col("trial").alias("best"))
    return trials.join(F.broadcast(best), trials.trial == best.best, "left").select(
        "trial", "loss", "params", F.col("best").isNotNull().alias("is_best")
    )


@query
def embedding_projection(spark, sf_dir):
    h = materialise(fx.fixed_embeddings(spark, sf_dir), "embeddings")
    return projection.embedding_projection(h, 0.3)


@query
def embedding_axes(spark, sf_dir):
    """The embeddings, scaled to about one, on the two leading axes of a sample."""
    h = fx.fixed_embeddings(spark, sf_dir).select("id", F.transform("x", lambda v: v / F.lit(1e4)).alias("x"))
    return projection.power_projection(materialise(h, "embeddings"), fx.WIDTH, 0.3).select("id", *_r("x", "y"))
