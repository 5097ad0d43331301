import json
import random

import numpy as np
import pytest

import brute
from supplyloom.params import DEFAULT, SEARCH_SPACE, TUNED, Params
from supplyloom.plans import search, training, weights as W
from supplyloom.plans.examples import training_examples
from supplyloom.plans.gradient import batch_gradient, forward, sellers
from supplyloom.operators import graph

P = Params(num_node_features=3, hidden_dim=4, num_negative_samples=2, batch_size=16, max_steps=4, lr=0.05, seed=1)


@pytest.fixture(scope="module")
def edges(spark):
    rng = random.Random(2)
    rows = [(i, rng.randrange(12), rng.randrange(12) if rng.random() < 0.7 else 0) for i in range(90)]
    return spark.createDataFrame(rows, "eid long, src_id long, dst_id long")


def _examples(edges, params):
    data = training.split_graph(edges, params)
    train = data.of("training")
    batched = graph.first_batches(graph.shuffled_batches(train, params.batch_size, params.seed, by=[]), params.max_steps)
    return data, *training_examples(batched, train, data.features, params)


def _arrow(examples):
    table = examples.orderBy("batch_id", "eid").toArrow()
    return table.combine_chunks().to_batches()[0]


@pytest.mark.parametrize(
    "aggregator,loss,strict",
    [
        ("mean", "binary_cross_entropy", False),
        ("mean", "margin", False),
        ("pool", "binary_cross_entropy", False),
        ("pool", "margin", True),
    ],
)
def test_gradient_matches_finite_differences(edges, aggregator, loss, strict):
    params = P.with_(aggregator_type=aggregator, loss=loss, strict_negatives=strict)
    _, examples, shape = _examples(edges, params)
    batch = _arrow(examples)
    weights = W.initial_weights(params)
    rng = np.random.default_rng(0)
    weights = {k: v + rng.normal(scale=0.05, size=v.shape) for k, v in weights.items()}
    flat = W.flatten(weights)
    total, terms, g = batch_gradient(batch, weights, shape, loss, True)
    gradient = W.flatten(g)
    step = 1e-6
    for i in rng.choice(flat.size, 25, replace=False):
        values = []
        for sign in (1, -1):
            moved = flat.copy()
            moved[i] += sign * step
            values.append(batch_gradient(batch, W.unflatten(moved, weights), shape, loss, True)[0])
        assert gradient[i] == pytest.approx((values[0] - values[1]) / (2 * step), rel=1e-4, abs=1e-5)


@pytest.mark.parametrize("exclude", [True, False])
def test_forward_equals_the_sampled_encoder(spark, edges, exclude):
    params = P.with_(max_steps=100)
    data, examples, shape = _examples(edges, params)
    weights = W.initial_weights(params)
    model = W.as_model(weights, "mean")
    x = {r.id: np.array(r.x) for r in data.features.collect()}
    train = data.of("training")
    from supplyloom.operators.sampling import fanout_sample

    kept = [
        [(r.nbr_id, r.node_id, r.eid) for r in fanout_sample(train, layer, params.seed, 4).collect()] for layer in (1, 2)
    ]
    ends = {r.eid: (r.src_id, r.dst_id) for r in train.collect()}
    batch = _arrow(examples)
    flat, row, _ = forward(batch, weights, shape, exclude)
    assert len(flat) == 3 * len(ends)
    logits = flat[sellers(row)]
    for logit, eid in zip(logits, batch.column("eid").to_pylist()):
        layers = [[(s, d) for s, d, e in k if not (exclude and e == eid)] for k in kept]
        h = brute.embed(x, layers[0], model, layers[1])
        u, v = ends[eid]
        want = model.score_w @ np.concatenate([h[u], h[v]]) + model.score_b
        assert logit == pytest.approx(want, abs=1e-10)


def test_repeated_edge_ids_are_refused(spark):
    rows = [(0, 1, 2), (0, 1, 3), (1, 2, 3), (2, 3, 1)]
    edges = spark.createDataFrame(rows, "eid long, src_id long, dst_id long")
    with pytest.raises(ValueError, match="unique"):
        _examples(edges, P.with_(test_p=0.0, valid_p=0.0))


def test_gradient_does_not_depend_on_partitions(edges):
    _, examples, shape = _examples(edges, P)
    weights = W.initial_weights(P)
    a = training.step_gradient(examples.coalesce(1), weights, shape, P)
    b = training.step_gradient(examples.repartition(7), weights, shape, P)
    assert a[0] == pytest.approx(b[0], abs=1e-12) and np.allclose(a[1], b[1], atol=1e-9)


@pytest.mark.parametrize("optimiser", ["Adam", "SGD"])
def test_training_lowers_the_loss_and_logs_every_step(edges, optimiser):
    params = P.with_(optimiser=optimiser, batch_size=63, max_steps=1, lr=0.05)
    data, examples, shape = _examples(edges, params)
    weights = W.initial_weights(params)
    flat = W.flatten(weights)
    step = training.Optimiser(params, flat.size)
    seen = []
    for _ in range(6):
        loss, g = training.step_gradient(examples, W.unflatten(flat, weights), shape, params)
        seen.append(loss)
        flat = step.update(flat, g)
    assert seen[-1] < seen[0]

    trained = training.train(data, P.with_(optimiser=optimiser))
    rows = trained.metrics.collect()
    assert {(r.name, r.step) for r in rows} == {(n, s) for n in ("loss", "auc", "ap") for s in range(4)}
    scores = training.evaluation_metrics(data, trained.model, P).collect()
    assert {(r.split, r.name) for r in scores} == {(s, n) for s in ("validation", "testing") for n in ("mean_auc", "mean_ap")}
    assert all(0 <= r.value <= 1 for r in scores)


def test_adam_first_step_has_the_size_of_the_rate():
    step = training.Optimiser(P.with_(optimiser="Adam", l2_regularisation=0.0, lr=0.1), 3)
    out = step.update(np.zeros(3), np.array([5.0, -0.2, 1e-3]))
    assert np.allclose(out, [-0.1, 0.1, -0.1], atol=1e-4)


def test_momentum_and_l2():
    step = training.Optimiser(P.with_(optimiser="SGD", l2_regularisation=0.5, lr=1.0, momentum=0.1), 1)
    first = step.update(np.array([2.0]), np.array([1.0]))
    assert first == pytest.approx([0.0])
    assert step.update(first, np.array([1.0])) == pytest.approx([0.0 - (0.1 * 2.0 + 1.0)])


def test_own_split_messages(edges):
    params = P.with_(own_split_messages=True, exclude_targets=False)
    data = training.split_graph(edges, params)
    model = W.as_model(W.initial_weights(params), "mean")
    assert training.evaluation_metrics(data, model, params).count() == 4


def test_weights_table(spark, tmp_path):
    path = str(tmp_path / "w")
    for version in (1, 3, 2):
        w = {k: v + version for k, v in W.initial_weights(P.with_(aggregator_type="pool")).items()}
        W.save_weights(spark, w, "pool", path, version)
    back, aggregator = W.load_weights(spark, path)
    assert aggregator == "pool"
    want = W.initial_weights(P.with_(aggregator_type="pool"))
    assert all(np.allclose(back[k], want[k] + 3) for k in want)
    assert np.allclose(W.load_weights(spark, path, 1)[0]["score.b"], 1)


def test_params():
    assert Params.from_mapping({"num_epochs": 9, "num_hidden_graph_layers": 7, "device": "cpu", "lr": "0.1"}) == Params(
        max_steps=9, hidden_dim=7, lr=0.1
    )
    with pytest.raises(KeyError):
        Params.from_mapping({"nonsense": 1})
    with pytest.raises(ValueError):
        Params(optimiser="Lion")
    sizes = 1
    for values in SEARCH_SPACE.values():
        sizes *= len(values)
    assert sizes == 116640 and TUNED.hidden_dim == 100 and DEFAULT.batch_size == 12


def test_trials_are_seeded():
    a, b = search.draw_trials(20, 4), search.draw_trials(20, 4)
    assert a == b and len(set(a)) > 10 and a != search.draw_trials(20, 5)
    assert all(getattr(t, k) in v for t in a for k, v in SEARCH_SPACE.items())


def test_search_picks_the_lowest_loss(spark, edges):
    trials = search.search(edges, [P.with_(max_steps=1, seed=s) for s in (1, 2)], parallelism=2)
    rows = trials.collect()
    best = search.best_trial(trials).first()
    assert best.loss == min(r.loss for r in rows)
    assert search.best_params(trials) == P.with_(max_steps=1, seed=1 + best.trial)
    tie = spark.createDataFrame([(0, 0.5, "a"), (1, 0.2, "b"), (2, 0.2, "c")], search.TRIALS_SCHEMA)
    assert search.best_trial(tie).first().params == "b"


def test_stacked_trials_equal_single_ones(spark, edges):
    """Trials of other widths, losses, optimisers and batch sizes in the same jobs give what each gives alone."""
    from supplyloom.plans import stacked

    base = P.with_(max_steps=3, seed=1, fanout=2)
    trials = [
        base.with_(batch_size=8, num_node_features=4, hidden_dim=3, num_negative_samples=3, optimiser="Adam", lr=0.01),
        base.with_(batch_size=16, num_node_features=2, hidden_dim=5, num_negative_samples=2, optimiser="SGD", loss="margin", aggregator_type="pool"),
        base.with_(batch_size=4, num_node_features=3, hidden_dim=2, num_negative_samples=1, max_steps=2),
    ]
    assert stacked.stackable(trials)
    alone = [training.train(training.split_graph(edges, p), p) for p in trials]
    stack = stacked.build_stack(edges, trials)
    weights, losses = stacked.train_stack(stack, trials)
    for one, w, told in zip(alone, weights, losses):
        assert all(np.allclose(one.weights[k], w[k], atol=1e-9) for k in w)
        logged = sorted((r.step, r.value) for r in one.metrics.filter("name = 'loss'").collect())
        assert np.allclose([v for _, v in logged], told)
    means = {r.trial: r.mean_auc for r in stacked.evaluate_stack(stack, trials, weights).collect()}
    for i, p in enumerate(trials):
        assert means[i] == pytest.approx(-search.objective(edges, p), abs=1e-6)
    assert not stacked.stackable([trials[0], trials[0].with_(seed=2)])
    assert not stacked.stackable([trials[0].with_(batch_size=8192)])


def test_search_runs_side_by_side_when_trials_do_not_stack(spark, edges):
    trials = [P.with_(max_steps=1, batch_size=b, seed=s) for b, s in ((4096, 1), (8, 2), (8, 3))]
    losses = [r.loss for r in search.search(edges, trials, parallelism=3).orderBy("trial").collect()]
    assert losses == pytest.approx([search.objective(edges, p) for p in trials])


def test_param_search_runs_to_its_end(spark, sf):
    """The registered query, unstubbed: the whole space, twenty trials, one of them the best."""
    from supplyloom.params import SEARCH_TRIALS
    from supplyloom.plans import catalog

    rows = catalog.queries()["param_search"](spark, sf).collect()
    assert [r.trial for r in sorted(rows)] == list(range(SEARCH_TRIALS))
    best = [r for r in rows if r.is_best]
    assert len(best) == 1 and best[0].loss == min(r.loss for r in rows) <= 0
    for name, values in SEARCH_SPACE.items():
        drawn = {json.loads(r.params)[name] for r in rows}
        assert len(drawn) > 1 and drawn <= set(values)


@pytest.mark.parametrize("aggregator", ["mean", "pool"])
@pytest.mark.parametrize("exclude", [True, False])
def test_shared_encoding_equals_a_block_per_slot(aggregator, exclude):
    """Each company once a step, whatever the number of its slots, gives the gradient of all blocks."""
    from supplyloom.plans import flow, gradient
    from supplyloom.plans.examples import NO_EDGE, Shape
    from supplyloom.plans.weights import initial_weights

    draw, v, f, d, n, k = np.random.default_rng(3), 6, 2, 3, 9, 4
    x = draw.normal(size=(v, d)).astype(np.float32)
    near = [draw.integers(0, v, (v, f)) for _ in range(2)]
    via = [np.where(draw.random((v, f)) < 0.3, NO_EDGE, draw.integers(0, n, (v, f))) for _ in range(2)]
    vectors = [x, x[near[0]], x[near[1]], x[near[0]][near[1]]]
    edges = [via[0], via[1], via[0][near[1]]]
    vectors[1], vectors[2] = vectors[1] * (edges[0] != NO_EDGE)[..., None], vectors[2] * (edges[1] != NO_EDGE)[..., None]
    parts = [a.reshape(v, -1).astype(np.float32).view(np.uint8) for a in vectors] + [e.reshape(v, -1).astype(np.int64).view(np.uint8) for e in edges]
    blocks = np.hstack(parts)
    row, eid = np.repeat(np.arange(n), 1 + k), np.arange(n)
    src, dst = draw.integers(0, v, n), draw.integers(0, v, n * (1 + k))
    params = P.with_(num_node_features=d, hidden_dim=4, aggregator_type=aggregator, seed=2)
    w = {name: value + 0.1 for name, value in initial_weights(params).items()}
    table = flow.Companies(x.astype(float), tuple(near), tuple(via))
    for loss in ("binary_cross_entropy", "margin"):
        a = flow.step_gradient(table, src, dst, row, eid if exclude else None, w, loss)
        b = gradient.pair_gradient(blocks[src], blocks[dst], row, eid if exclude else None, w, Shape(d, f, 1 + k), loss)
        assert a[0] == pytest.approx(b[0]) and a[1] == b[1]
        assert all(np.allclose(a[2][name], b[2][name], atol=1e-12) for name in w)


def test_stacked_trials_run_side_by_side_in_small_buckets(spark, edges, monkeypatch):
    """No trial waits for another's end, and the number of buckets changes nothing."""
    import threading

    from supplyloom.plans import stacked

    base = P.with_(max_steps=6, seed=1, fanout=2, batch_size=4)
    trials = [base, base.with_(num_negative_samples=1, aggregator_type="pool", optimiser="SGD")]
    whole, told = stacked.train_stack(stacked.build_stack(edges, trials), trials)
    monkeypatch.setattr(stacked, "MOST_ROWS", 8)
    monkeypatch.setattr(stacked, "JOB_BUCKETS", 2)
    meet, one = threading.Barrier(len(trials), timeout=60), stacked._train_one

    def met(stack, params):
        meet.wait()
        return one(stack, params)

    monkeypatch.setattr(stacked, "_train_one", met)
    stack = stacked.build_stack(edges, trials)
    assert stack.rows == 8
    weights, losses = stacked.train_stack(stack, trials)
    for a, b in zip(whole, weights):
        assert all(np.allclose(a[k], b[k], atol=1e-9) for k in a)
    assert all(np.allclose(a, b) for a, b in zip(told, losses))


@pytest.fixture
def two_trials(monkeypatch):
    """Trials of small batches in many buckets."""
    from supplyloom.plans import stacked

    monkeypatch.setattr(stacked, "MOST_ROWS", 8)
    base = P.with_(max_steps=6, seed=1, fanout=2, batch_size=4)
    return [base, base.with_(num_negative_samples=1, num_node_features=2, aggregator_type="pool", optimiser="SGD")]


def test_stacked_companies_are_written_once(spark, edges, two_trials):
    """However many buckets reach a company, its features lie in one row on the disk."""
    import glob

    from supplyloom.plans import stacked
    from supplyloom.storage import scratch_root

    before = set(glob.glob(f"{scratch_root(spark)}/*"))
    stack = stacked.build_stack(edges, two_trials)
    assert stack.buckets.select("bucket").distinct().count() > 1
    tables = [spark.read.parquet(path) for path in set(glob.glob(f"{scratch_root(spark)}/*")) - before]
    written = sum(t.filter("record is not null").count() for t in tables if "record" in t.columns)
    assert written == stack.graph.features.count() > 0


def test_stacked_scores_are_not_shuffled(spark, edges, two_trials, monkeypatch):
    """An evaluation shuffles its examples; their scores, one for each trial, are ranked where they arise."""
    from supplyloom.plans import stacked

    ranked, whole = [], stacked.auc_ap
    monkeypatch.setattr(stacked, "auc_ap", lambda *a, **k: ranked.append(whole(*a, **k)) or ranked[-1])
    stack = stacked.build_stack(edges, two_trials)
    weights, _ = stacked.train_stack(stack, two_trials)
    assert stacked.evaluate_stack(stack, two_trials, weights).count() == len(two_trials)
    lines = ranked[0]._jdf.queryExecution().executedPlan().toString().splitlines()
    above = lines[: next(i for i, line in enumerate(lines) if "Generate inline" in line)]
    assert any("Window" in line for line in above) and not any("Exchange" in line for line in above)


def test_stacked_trials_of_many_companies(spark, edges, two_trials, monkeypatch):
    """Companies in a file, trials in passes of their own, ids and scores joined by shuffles: the results stay."""
    from supplyloom.operators import joins
    from supplyloom.plans import stacked

    def run():
        stack = stacked.build_stack(edges, two_trials)
        weights, _ = stacked.train_stack(stack, two_trials)
        return weights, {r.trial: tuple(r)[1:] for r in stacked.evaluate_stack(stack, two_trials, weights).collect()}

    (weights, means), n = run(), edges.selectExpr("explode(array(src_id, dst_id))").distinct().count()
    monkeypatch.setattr(stacked, "HELD_BYTES", 0)
    for most in (24 * n, 0):  # a trial's scores just fit to be sent out; nothing does
        monkeypatch.setattr(joins, "BROADCAST_BYTES", most)
        others, told = run()
        assert all(np.allclose(a[k], b[k], atol=1e-12) for a, b in zip(weights, others) for k in a)
        assert sorted(told) == sorted(means) and all(told[t] == pytest.approx(means[t]) for t in means)


def test_a_task_takes_companies_and_edges_in_any_order():
    import pyarrow as pa

    from supplyloom.plans import stacked
    from supplyloom.plans.examples import NO_EDGE

    lists = np.array([[[1], [7], [NO_EDGE], [NO_EDGE]], [[0], [8], [0], [9]]])
    x = np.array([[0.5, 1.0, 2.0], [3.0, 4.0, 5.0]], dtype=np.float32)
    records = [lists[i].astype(np.int64).tobytes() + x[i].tobytes() for i in (0, 1)]
    rows = [(0, 1, None, records[1]), (1, 5, 50, None), (1, 6, 60, None), (0, 0, None, records[0])]
    columns = ("kind", "at", "eid", "record")
    types = pa.schema([("kind", pa.int32()), ("at", pa.int64()), ("eid", pa.int64()), ("record", pa.binary())])
    for most in (0, 1 << 20):
        held = stacked.Held(2, 3, 1, most)
        batches = [pa.RecordBatch.from_pylist([dict(zip(columns, r)) for r in part], types) for part in (rows[:2], rows[2:])]
        edges = list(stacked._edges_after(iter(batches), held, 32 + 12))
        assert [e for b in edges for e in b["eid"].to_pylist()] == [50, 60]
        table = held.table()
        assert np.array_equal(table.x, x) and [v.ravel().tolist() for v in table.near + table.via] == [[1, 0], [0, 0], [7, 8], [NO_EDGE, 9]]
    with pytest.raises(ValueError, match="missing"):
        stacked.Held(2, 3, 1, 0).table()
