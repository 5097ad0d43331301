"""Data-parallel training of the link model, and its evaluation.

The edges never leave the executors: each step is one Spark job that returns one
summed gradient per partition of the step's batch; the driver only holds weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyloom.functions.activations import sigmoid
from supplyloom.functions.vectors import linear_score
from supplyloom.operators import metrics as M
from supplyloom.operators.features import normal_features
from supplyloom.operators.graph import edge_split, first_batches, node_set, shuffled_batches
from supplyloom.operators.sage import LinkModel, MessageGraph, embed, endpoint_scores
from supplyloom.operators.sampling import fanout_sample, labelled_examples, node_index
from supplyloom.operators.scoring import with_logit
from supplyloom.params import Params
from supplyloom.plans.examples import Shape, draw_negatives, training_examples
from supplyloom.plans.gradient import batch_gradient, forward, sellers
from supplyloom.plans.weights import LAYER_PARTS, as_model, flatten, initial_weights, unflatten
from supplyloom.storage import materialise, rows_of, stored

ROWS_PER_CHUNK_BYTES = 32 << 20
HISTORY_BYTES = 32 << 20
PARTIALS_SCHEMA = "task long, loss double, terms double, gradient array<double>"
REPLAY_SCHEMA = "batch_id long, label int, score double"


@dataclass(frozen=True)
class SplitGraph:
    """Edges with their split, and one feature table for all of them."""

    edges: DataFrame  # eid, src_id, dst_id, split
    features: DataFrame  # id, x

    def of(self, split: str) -> DataFrame:
        return self.edges.filter(F.col("split") == split).drop("split")


@dataclass(frozen=True)
class Trained:
    model: LinkModel
    weights: dict[str, np.ndarray]
    metrics: DataFrame  # run_id, split, step, name, value


def split_graph(edges: DataFrame, params: Params, features: DataFrame | None = None) -> SplitGraph:
    """Edges that already have a ``split`` keep it, so several runs can share one."""
    split = edges if "split" in edges.columns else edge_split(edges, params.test_p, params.valid_p)
    split = stored(split, "split")
    if features is None:
        features = normal_features(node_set(split), params.num_node_features, params.seed)
    return SplitGraph(split, stored(features, "features"))


class Optimiser:
    """SGD with momentum, or Adam; L2 is added to the gradient. State is one vector per moment."""

    def __init__(self, params: Params, size: int):
        self.params = params
        self.step = 0
        self.first = np.zeros(size)
        self.second = np.zeros(size)

    def update(self, flat: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        p = self.params
        self.step += 1
        g = gradient + p.l2_regularisation * flat
        if p.optimiser == "SGD":
            self.first = g if self.step == 1 else p.momentum * self.first + g
            return flat - p.lr * self.first
        self.first = 0.9 * self.first + 0.1 * g
        self.second = 0.999 * self.second + 0.001 * g * g
        m = self.first / (1.0 - 0.9**self.step)
        v = self.second / (1.0 - 0.999**self.step)
        return flat - p.lr * m / (np.sqrt(v) + 1e-8)


def _slices(batches: Iterator[pa.RecordBatch], shape: Shape) -> Iterator[pa.RecordBatch]:
    """Bounds the memory of one product, whatever the Arrow batch size is."""
    rows = max(1, ROWS_PER_CHUNK_BYTES // shape.row_bytes)
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def step_gradient(
    examples: DataFrame, weights: dict[str, np.ndarray], shape: Shape, params: Params
) -> tuple[float, np.ndarray]:
    """Mean loss and gradient over ``examples``, in one job."""
    loss, exclude = params.loss, params.exclude_targets

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = terms = 0.0
        gradient = np.zeros(sum(v.size for v in weights.values()))
        for batch in _slices(batches, shape):
            a, b, g = batch_gradient(batch, weights, shape, loss, exclude)
            total, terms = total + a, terms + b
            gradient += flatten(g)
        if terms:
            yield pa.RecordBatch.from_pydict(
                {
                    "task": pa.array([TaskContext.get().partitionId()], pa.int64()),
                    "loss": [total],
                    "terms": [terms],
                    "gradient": pa.array([gradient], pa.list_(pa.float64())),
                }
            )

    # One row per task of the batch: at most the parts the batch was laid out in.
    rows = sorted(examples.mapInArrow(partial, PARTIALS_SCHEMA).collect(), key=lambda r: r.task)
    terms = sum(r.terms for r in rows)
    if not terms:
        return 0.0, np.zeros(sum(v.size for v in weights.values()))
    gradient = np.sum([r.gradient for r in rows], axis=0)
    return sum(r.loss for r in rows) / terms, gradient / terms


def replay_scores(
    examples: DataFrame, history: dict[int, dict[str, np.ndarray]], shape: Shape, params: Params
) -> DataFrame:
    """Scores of each batch under the weights its step started from, in one job for many steps."""
    exclude = params.exclude_targets

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, shape):
            steps = batch.column("batch_id").to_numpy()
            for step in np.unique(steps):
                part = batch.filter(pa.array(steps == step))
                logits, row, _ = forward(part, history[int(step)], shape, exclude)
                yield pa.RecordBatch.from_pydict(
                    {
                        "batch_id": pa.array(np.full(len(row), step, dtype=np.int64)),
                        "label": pa.array(sellers(row).astype(np.int32)),
                        "score": pa.array(logits),
                    }
                )

    steps = examples.filter(F.col("batch_id").isin(sorted(history)))
    return steps.mapInArrow(score, REPLAY_SCHEMA)


def train(graph: SplitGraph, params: Params, run_id: str = "run") -> Trained:
    """Fits the model on the training split; logs loss, AUC and AP per step."""
    spark = graph.edges.sparkSession
    training = graph.of("training")
    batched = shuffled_batches(training, params.batch_size, params.seed, by=[])
    n_steps = min(params.max_steps, -(-rows_of(batched) // params.batch_size))
    batched = first_batches(batched, params.max_steps)
    examples, shape = training_examples(batched, training, graph.features, params)

    weights = initial_weights(params)
    flat = flatten(weights)
    optimiser = Optimiser(params, flat.size)
    losses, logged = [], []
    history: dict[int, dict[str, np.ndarray]] = {}

    def log_history() -> None:
        scored = replay_scores(examples, dict(history), shape, params)
        per_step = M.auc_ap(scored, ["batch_id"], bounded=True)
        rows = M.as_metrics(per_step, run_id, "training", F.col("batch_id"), {"auc": "auc", "ap": "ap"})
        logged.append(materialise(rows, "metrics"))
        history.clear()

    for step in range(n_steps):
        history[step] = weights
        loss, gradient = step_gradient(examples.filter(F.col("batch_id") == step), weights, shape, params)
        losses.append((run_id, "training", step, "loss", float(loss)))
        flat = optimiser.update(flat, gradient)
        weights = unflatten(flat, weights)
        if len(history) * flat.nbytes >= HISTORY_BYTES:
            log_history()
    if history:
        log_history()

    table = spark.createDataFrame(losses, M.METRICS_SCHEMA)
    for rows in logged:
        table = table.unionByName(rows)
    return Trained(as_model(weights, params.aggregator_type), weights, table)


def weights_of(model: LinkModel) -> dict[str, np.ndarray]:
    """The named arrays of a model, as training holds them."""
    out: dict[str, np.ndarray] = {}
    for name, layer in (("layer1", model.layer1), ("layer2", model.layer2)):
        for part in LAYER_PARTS:
            if getattr(layer, part) is not None:
                out[f"{name}.{part}"] = np.asarray(getattr(layer, part), dtype=float)
    return out | {"score.w": np.asarray(model.score_w, dtype=float), "score.b": np.array([float(model.score_b)])}


def batch_losses(graph: SplitGraph, weights: dict[str, np.ndarray], params: Params, steps: int) -> DataFrame:
    """``batch_id, loss, bias_gradient`` of the first batches under given weights: what a step sees before its update."""
    training = graph.of("training")
    batched = first_batches(shuffled_batches(training, params.batch_size, params.seed, by=[]), steps)
    examples, shape = training_examples(batched, training, graph.features, params)
    rows = []
    for step in range(steps):
        loss, gradient = step_gradient(examples.filter(F.col("batch_id") == step), weights, shape, params)
        if gradient.any():
            rows.append((step, float(loss), float(gradient[-1])))
    return graph.edges.sparkSession.createDataFrame(rows, "batch_id long, loss double, bias_gradient double")


def train_score_head(examples: DataFrame, width: int, steps: int, lr: float) -> DataFrame:
    """Fits the linear scorer on given vectors by full gradient steps of the mean log loss, from zero.

    ``examples`` has ``label`` and the vectors ``hu`` and ``hv``. A step is one aggregate: the gradient of a weight is
    the mean of its input times the error. Rows ``(step, place, value)``: the weights after each step, the bias last.
    """
    inputs = [F.get(c, i) for c in ("hu", "hv") for i in range(width)] + [F.lit(1.0)]
    weights, rows = np.zeros(len(inputs)), []
    for step in range(1, steps + 1):
        logit = linear_score(F.col("hu"), F.col("hv"), weights[:-1], float(weights[-1]))
        error = sigmoid(logit) - F.col("label")
        gradient = examples.agg(*[F.avg(error * x).alias(f"g{i}") for i, x in enumerate(inputs)]).first()
        weights = weights - lr * np.array(gradient, dtype=float)
        rows += [(step, i, float(w)) for i, w in enumerate(weights)]
    return examples.sparkSession.createDataFrame(rows, "step int, place int, value double")


def sampled_embeddings(message_edges: DataFrame, features: DataFrame, model: LinkModel, params: Params) -> DataFrame:
    """The sampled encoder over all nodes: one neighbourhood per node and run."""
    graphs = [
        MessageGraph.of(fanout_sample(message_edges, layer, params.seed, params.fanout)) for layer in (1, 2)
    ]
    return embed(features, model, *graphs)


def full_embeddings(message_edges: DataFrame, features: DataFrame, model: LinkModel, final_relu: bool = False) -> DataFrame:
    neighbours = message_edges.select(F.col("dst_id").alias("node_id"), F.col("src_id").alias("nbr_id"))
    return embed(features, model, MessageGraph.of(neighbours), final_relu=final_relu)


@dataclass(frozen=True)
class Scorer:
    """What evaluation needs of a model and its message edges, computed once for several splits."""

    ends: DataFrame  # id, as_buyer, as_seller
    index: DataFrame  # companies negatives are drawn from
    known: DataFrame  # edges a strict negative must not hit
    bias: float


def scorer(graph: SplitGraph, model: LinkModel, params: Params, split: str | None = None) -> Scorer:
    """Messages come from the training edges, so no held-out edge passes one.

    With a ``split``, messages and negatives come from that split's own edges.
    """
    messages = graph.of(split or "training")
    embeddings = sampled_embeddings(messages, graph.features, model, params)
    ends = materialise(endpoint_scores(embeddings, model), "ends")
    nodes = node_set(messages) if split else graph.features.select("id")
    known = messages if split else graph.edges.drop("split")
    return Scorer(ends, node_index(nodes), known, model.score_b)


def scored_split(graph: SplitGraph, split: str, scores: Scorer, params: Params) -> DataFrame:
    """``(batch_id, eid, label, score)`` of all batches of a split, with its negatives."""
    batched = shuffled_batches(graph.of(split), params.batch_size, params.seed, by=[])
    negatives = draw_negatives(batched, scores.known, params, scores.index)
    examples = labelled_examples(batched, negatives)
    return with_logit(examples, scores.ends, scores.bias, "inner").select(
        "batch_id", "eid", "label", F.col("logit").alias("score")
    )


def evaluate(
    graph: SplitGraph, split: str, model: LinkModel, params: Params, scores: Scorer | None = None
) -> DataFrame:
    """AUC and AP per batch of a split, no gradient."""
    if scores is None:
        scores = scorer(graph, model, params, split if params.own_split_messages else None)
    return M.auc_ap(scored_split(graph, split, scores, params), ["batch_id"], bounded=True)


def evaluation_metrics(
    graph: SplitGraph, model: LinkModel, params: Params, run_id: str = "run", splits=("validation", "testing")
) -> DataFrame:
    """Mean AUC and AP per split, as metric rows."""
    shared = None if params.own_split_messages else scorer(graph, model, params)
    out = None
    for split in splits:
        mean = M.mean_auc_ap(evaluate(graph, split, model, params, shared))
        rows = M.as_metrics(mean, run_id, split, F.lit(0), {"mean_auc": "mean_auc", "mean_ap": "mean_ap"})
        out = rows if out is None else out.unionByName(rows)
    return out
