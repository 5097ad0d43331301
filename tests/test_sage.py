import random

import numpy as np
import pytest

import brute
from supplyloom.operators import joins, sage, sampling
from supplyloom.params import Params
from supplyloom.plans.training import full_embeddings, sampled_embeddings
from supplyloom.plans.weights import as_model, initial_weights
from supplyloom.storage import materialise

# isolated 5, self-loop on 2, parallel edges 0->1, hub 3 buying from many, gap at 4
PAIRS = [(0, 1), (0, 1), (2, 2), (3, 1), (3, 0), (3, 2), (3, 6), (1, 3), (6, 0), (6, 1)]
IDS = [0, 1, 2, 3, 5, 6]


def _model(aggregator, width=3, hidden=4):
    weights = initial_weights(Params(num_node_features=width, hidden_dim=hidden, aggregator_type=aggregator, seed=1))
    rng = np.random.default_rng(2)
    for name in weights:
        if name.endswith(("bias", "b_pool", "score.b")):
            weights[name] = rng.normal(size=weights[name].shape)
    return as_model(weights, aggregator)


def _features(spark, width, ids=IDS):
    rng = np.random.default_rng(3)
    x = {i: rng.normal(size=width) for i in ids}
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in x.items()], "id long, x array<double>")


def _close(got, want):
    got = {r.id: np.array(r.x) for r in got.collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert np.allclose(got[k], want[k], atol=1e-12), k


@pytest.mark.parametrize("aggregator", ["mean", "pool"])
@pytest.mark.parametrize("width,hidden", [(3, 4), (9, 11)])
def test_two_layers(spark, edges_frame, aggregator, width, hidden):
    model = _model(aggregator, width, hidden)
    x, frame = _features(spark, width)
    edges = edges_frame(PAIRS)
    _close(full_embeddings(edges, frame, model), brute.embed(x, PAIRS, model))
    _close(full_embeddings(edges, frame, model, True), {
        k: np.maximum(v, 0) for k, v in brute.embed(x, PAIRS, model).items()
    })


@pytest.mark.parametrize("aggregator", ["mean", "pool"])
def test_salted_messages_agree(spark, edges_frame, aggregator, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "HOT_FLOOR", 2)
    model = _model(aggregator)
    x, frame = _features(spark, 3)
    _close(full_embeddings(edges_frame(PAIRS), frame, model), brute.embed(x, PAIRS, model))


def test_sampled_encoder(spark, edges_frame):
    rng = random.Random(0)
    pairs = [(rng.randrange(20), rng.randrange(6)) for _ in range(150)]
    edges = edges_frame(pairs)
    model = _model("mean")
    x, frame = _features(spark, 3, sorted({i for p in pairs for i in p}))
    params = Params(num_node_features=3, hidden_dim=4, seed=9)
    kept = [
        [(r.nbr_id, r.node_id) for r in sampling.fanout_sample(edges, layer, 9, 4).collect()] for layer in (1, 2)
    ]
    _close(sampled_embeddings(edges, frame, model, params), brute.embed(x, kept[0], model, kept[1]))


def test_new_companies(spark, edges_frame):
    model = _model("mean")
    x, frame = _features(spark, 3)
    new = spark.createDataFrame([(1,), (5,)], "id long")
    want = {k: v for k, v in brute.embed(x, PAIRS, model).items() if k in (1, 5)}
    _close(sage.embed_new(new, frame, edges_frame(PAIRS), model), want)


def test_endpoint_scores_add_up_to_the_linear_score(spark):
    model = _model("mean")
    h, frame = _features(spark, 3)
    ends = {r.id: r for r in sage.endpoint_scores(frame, model).collect()}
    for u in IDS:
        for v in IDS:
            direct = model.score_w @ np.concatenate([h[u], h[v]])
            assert ends[u].as_buyer + ends[v].as_seller == pytest.approx(direct)


def test_parallel_edges_are_folded_before_the_join(spark, edges_frame):
    messages = sage.MessageGraph.of(sampling.full_neighbours(edges_frame(PAIRS)))
    rows = {(r.nbr_id, r.node_id): r.multiplicity for r in messages.pairs.collect()}
    assert rows[(0, 1)] == 2 and len(rows) == len(set(PAIRS))
    _, frame = _features(spark, 3)
    plan = sage.neighbour_mean(messages, materialise(frame, "x"), 3)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "EvalPython" not in plan
