import random
from collections import Counter


from brute import draw
from supplyloom.operators import graph, sampling
from supplyloom.plans import bucketed

RNG = random.Random(5)
# company 0 sells in a third of all edges, and buys in many
PAIRS = [(RNG.randrange(40), 0 if RNG.random() < 0.33 else RNG.randrange(40)) for _ in range(600)]


def test_fanout_matches_brute_force(edges_frame):
    edges = edges_frame(PAIRS)
    got = sampling.fanout_sample(edges.repartition(9), 2, seed=7, fanout=4).collect()
    want = set()
    for v in {d for _, d in PAIRS}:
        mine = sorted((draw(f"fanout|7|2|{i}"), i, s) for i, (s, d) in enumerate(PAIRS) if d == v)
        want |= {(v, s, i, slot + 1) for slot, (_, i, s) in enumerate(mine[:4])}
    assert {(r.node_id, r.nbr_id, r.eid, r.slot) for r in got} == want


def test_fanout_limits_before_the_shuffle(spark, tmp_path, edges_frame):
    edges_frame(PAIRS).write.parquet(str(tmp_path / "e"))
    sample = sampling.fanout_sample(spark.read.parquet(str(tmp_path / "e")), 1)
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")
    assert "Partial" in plan[plan.index("Exchange"):]


def test_uniform_negatives(edges_frame):
    edges = edges_frame(PAIRS)
    nodes = graph.node_set(edges)
    ids = sorted(r.id for r in nodes.collect())
    got = sampling.uniform_negatives(edges, 3, nodes=nodes, seed=2).collect()
    assert len(got) == 3 * len(PAIRS)
    for r in got:
        assert r.src_id == PAIRS[r.eid][0]
        assert r.dst_id == ids[draw(f"negative|2|{r.eid}|{r.draw}") % len(ids)]


def test_strict_negatives_hit_no_edge(edges_frame):
    edges = edges_frame(PAIRS)
    known = set(PAIRS)
    got = sampling.strict_negatives(edges, 3, edges, nodes=graph.node_set(edges)).collect()
    assert all((r.src_id, r.dst_id) not in known for r in got)
    drawn = sampling.uniform_negatives(edges, 6, nodes=graph.node_set(edges)).collect()
    open_draws = Counter(r.eid for r in drawn if (r.src_id, r.dst_id) not in known)
    assert Counter(r.eid for r in got) == Counter({e: min(3, n) for e, n in open_draws.items()})


def test_no_cross_join(spark, tmp_path, edges_frame):
    edges_frame(PAIRS).write.parquet(str(tmp_path / "e"))
    edges = spark.read.parquet(str(tmp_path / "e"))
    got = sampling.strict_negatives(edges, 3, edges, nodes=graph.node_set(edges))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_two_hop_blocks(edges_frame, spark):
    edges = edges_frame(PAIRS)
    seeds = spark.createDataFrame([(3,), (4,)], "id long")
    rows = sampling.two_hop_blocks(seeds, edges).collect()
    outer = {(r.node_id, r.nbr_id, r.eid) for r in rows if r.layer == 2}
    assert {n for n, _, _ in outer} <= {3, 4}
    reach = {3, 4} | {b for _, b, _ in outer}
    inner = {(r.node_id, r.nbr_id, r.eid) for r in rows if r.layer == 1}
    full = {(r.node_id, r.nbr_id, r.eid) for r in sampling.fanout_sample(edges, 1).collect()}
    assert inner == {t for t in full if t[0] in reach}


def test_labels(edges_frame):
    edges = edges_frame(PAIRS[:20])
    neg = sampling.uniform_negatives(edges, 2, dense_count=40)
    got = sampling.labelled_examples(edges, neg).groupBy("label").count().collect()
    assert {(r.label, r["count"]) for r in got} == {(1, 20), (0, 40)}


def test_fresh_blocks_exchange_nothing(spark, edges_frame):
    """The draw reads its buckets: no shuffle in the plan; other batches see other neighbours, a retry the same."""
    edges = edges_frame(PAIRS)
    laid_out = bucketed.bucketed_graph(edges, 4)
    try:
        seeds = spark.createDataFrame([(i,) for i in range(0, 40, 3)], "id long")
        drawn = bucketed._drawn(laid_out, seeds, 2, 0, 0, 4)
        plan = drawn._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "BroadcastExchange" in plan and "Bucketed: true" in plan
        blocks = [{tuple(r) for r in bucketed.fresh_blocks(laid_out, seeds, batch).collect()} for batch in (0, 0, 1)]
        assert blocks[0] == blocks[1] != blocks[2]
        outer = {(v, s) for layer, v, s, _, _ in blocks[0] if layer == 2}
        for v in range(0, 40, 3):
            mine = sorted((draw(f"fresh|0|2|0|{i}"), i, s) for i, (s, d) in enumerate(PAIRS) if d == v)
            assert {s for a, s in outer if a == v} == {s for _, _, s in mine[:4]}
    finally:
        laid_out.drop()
