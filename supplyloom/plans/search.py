"""Seeded random search over the run parameters."""

from __future__ import annotations

import json
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyloom.operators.graph import edge_split
from supplyloom.operators.metrics import mean_auc_ap
from supplyloom.params import DEFAULT, SEARCH_PARALLELISM, SEARCH_SPACE, SEARCH_TRIALS, Params
from supplyloom.plans.stacked import build_stack, evaluate_stack, stackable, train_stack
from supplyloom.plans.training import evaluate, split_graph, train
from supplyloom.storage import materialise

TRIALS_SCHEMA = "trial long, loss double, params string"


def draw_trials(n: int = SEARCH_TRIALS, seed: int = 0, base: Params = DEFAULT, space=None) -> list[Params]:
    """Independent uniform choices per dimension of the space."""
    rng = random.Random(seed)
    space = SEARCH_SPACE if space is None else space
    return [base.with_(**{k: rng.choice(list(v)) for k, v in space.items()}) for _ in range(n)]


def objective(edges: DataFrame, params: Params) -> float:
    """Minus the mean validation AUC of a model trained with ``params``."""
    graph = split_graph(edges, params)
    trained = train(graph, params)
    row = mean_auc_ap(evaluate(graph, "validation", trained.model, params)).first()
    return 0.0 if row.mean_auc is None else -row.mean_auc


def stacked_losses(edges: DataFrame, trials: list[Params]) -> list[float]:
    """The objective of every trial, from tables that all trials share."""
    stack = build_stack(edges, trials)
    weights, _ = train_stack(stack, trials)
    means = {r.trial: r.mean_auc for r in evaluate_stack(stack, trials, weights).collect()}
    return [-(means.get(t) or 0.0) for t in range(len(trials))]


def search(
    edges: DataFrame, trials: list[Params], parallelism: int = SEARCH_PARALLELISM
) -> DataFrame:
    """One row per trial. Trials of small batches share their tables; others are data-parallel, several side by side.

    All trials share the split of the first one's fractions.
    """
    spark = edges.sparkSession
    edges = materialise(edge_split(edges, trials[0].test_p, trials[0].valid_p), "split")
    if stackable(trials):
        losses = stacked_losses(edges, trials)
    else:
        # A wrapper per trial: each has a copy of the session's properties to itself.
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            runs = [pool.submit(inheritable_thread_target(spark)(objective), edges, p) for p in trials]
            losses = [r.result() for r in runs]
    rows = [(i, loss, json.dumps(asdict(p), sort_keys=True)) for i, (loss, p) in enumerate(zip(losses, trials))]
    return spark.createDataFrame(rows, TRIALS_SCHEMA)


def best_trial(trials: DataFrame) -> DataFrame:
    """The trial with the lowest loss; the earlier one on a tie."""
    rank = F.struct("loss", "trial")
    return trials.agg(
        F.min_by("trial", rank).alias("trial"), F.min("loss").alias("loss"), F.min_by("params", rank).alias("params")
    )


def best_params(trials: DataFrame) -> Params:
    return Params.from_mapping(json.loads(best_trial(trials).first().params))
