"""Exact negatives, exact inner products, components, reach sketches, power laws and density curves."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import draw
from supplyloom.operators import components, entities, graph, inner_product, profile, risk, sampling, scale_free
from supplyloom.operators import joins

RNG = random.Random(11)
# company 0 sells in a third of all edges; company 1 buys from nearly everyone
PAIRS = [(RNG.randrange(30), 0 if RNG.random() < 0.33 else RNG.randrange(30)) for _ in range(300)] + [(1, v) for v in range(28)]


@pytest.fixture(params=["broadcast", "salted"])
def floor(request, monkeypatch):
    """Every lookup by broadcast, or by shuffle with keys of ten rows and more salted."""
    if request.param == "salted":
        monkeypatch.setattr(joins, "BROADCAST_BYTES", 31)
        return 10
    return None


def distinct_draws(eid, k, m, seed):
    left, out = list(range(m)), []
    for j in range(min(k, m)):
        out.append(left.pop(draw(f"open|{seed}|{eid}|{j + 1}") % (m - j)))
    return out


def test_exact_negatives(edges_frame, floor):
    edges = edges_frame(PAIRS)
    known, ids = set(PAIRS), sorted({x for p in PAIRS for x in p})
    got = sampling.exact_negatives(edges.repartition(5), 4, edges, nodes=graph.node_set(edges), seed=3, floor=floor).collect()
    want = set()
    for eid, (u, _) in enumerate(PAIRS):
        free = [v for v in ids if (u, v) not in known]
        want |= {(eid, u, free[x], j + 1) for j, x in enumerate(distinct_draws(eid, 4, len(free), 3))}
    assert {(r.eid, r.src_id, r.dst_id, r.draw) for r in got} == want and len(got) == len(want)
    of_one = [r for r in got if r.src_id == 1]
    assert len(of_one) == sum(u == 1 for u, _ in PAIRS) * min(4, len(ids) - len({v for u, v in known if u == 1}))


def test_exact_negatives_are_uniform(edges_frame):
    """Of 200 edges of one purchaser, each open company gets about its share, and no edge gets one twice."""
    edges = edges_frame([(0, 1)] * 200 + [(9, v) for v in range(10)])
    got = sampling.exact_negatives(edges.filter("src_id = 0"), 3, edges, nodes=graph.node_set(edges)).collect()
    assert len({(r.eid, r.dst_id) for r in got}) == len(got) == 600
    counts = Counter(r.dst_id for r in got)
    assert set(counts) == set(range(10)) - {1} and all(40 < n < 95 for n in counts.values())


def test_exact_negatives_without_open_companies(edges_frame):
    edges = edges_frame([(a, b) for a in range(3) for b in range(3)])
    assert sampling.exact_negatives(edges, 2, edges, nodes=graph.node_set(edges)).count() == 0
    assert sampling.exact_negatives(edges.limit(0), 2, edges, nodes=graph.node_set(edges)).count() == 0


def best_by_hand(pairs, vectors, k):
    known, out = set(pairs), set()
    for u in {u for u, _ in pairs} & set(vectors):
        scored = [(-float(np.dot(vectors[u], x)), v) for v, x in vectors.items() if v != u and (u, v) not in known]
        out |= {(u, v, i + 1, -s) for i, (s, v) in enumerate(sorted(scored)[:k])}
    return out


@pytest.mark.parametrize("block_rows", [3, 16, 1024])
def test_best_inner_products(spark, edges_frame, floor, block_rows):
    draws = np.random.default_rng(4)
    # Whole numbers, so that there are ties; lengths differ, so that blocks are pruned; a few have no vector.
    vectors = {i: np.round(draws.normal(size=4) * (40 / (1 + i % 17))) for i in range(30) if i != 7}
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "id long, x array<double>")
    got = inner_product.topk_missing_dot(edges_frame(PAIRS), frame, 4, 5, block_rows, floor).collect()
    assert {tuple(r) for r in got} == best_by_hand(PAIRS, vectors, 5) and len(got) == len({tuple(r) for r in got})


def test_inner_products_prune_blocks_and_need_no_cross_join(spark, edges_frame, monkeypatch):
    seen = []
    plain = inner_product._candidates

    def counted(wanted, sellers, *rest):
        seen.append(wanted.count())
        out = plain(wanted, sellers, *rest)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        return out

    monkeypatch.setattr(inner_product, "_candidates", counted)
    rows = [(i, [float(1000 - 30 * i), 0.0]) for i in range(30)]
    frame = spark.createDataFrame(rows, "id long, x array<double>")
    inner_product.topk_missing_dot(edges_frame([(i, 29) for i in range(5)]), frame, 2, 2, 4).collect()
    assert sum(seen) < 5 * 8 / 2


def test_inner_products_of_nothing(spark, edges_frame):
    frame = spark.createDataFrame([], "id long, x array<double>")
    assert inner_product.topk_missing_dot(edges_frame(PAIRS), frame, 3).count() == 0


def components_by_hand(pairs):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "alone"])
def test_components(spark, floor, shape):
    draws = random.Random(3)
    names = draws.sample(range(1000), 200)
    pairs = {
        "chain": list(zip(names, names[1:])),
        "star": [(names[0], n) for n in names[1:]],
        "random": [(draws.choice(names), draws.choice(names)) for _ in range(150)],
        "alone": [(5, 5), (6, 6), (6, 7)],
    }[shape]
    got = components.components(spark.createDataFrame(pairs, "a long, b long"), floor).collect()
    assert {r.id: r.component for r in got} == components_by_hand(pairs) and len(got) == len({r.id for r in got})
    assert components.components(spark.createDataFrame([], "a long, b long"), floor).count() == 0


def test_linked_entities(spark, floor):
    """One id under two clean names, and a chain of three ids over two names, resolve to one company."""
    rows = [
        (0, 10, 50, "Acme LLC", "Far Ltd."), (1, 10, 51, "Apex Inc.", "Near"), (2, 12, 50, "APEX", None), (3, 12, 52, "Apex GmbH", "Far"),
        (4, 9, 60, "Apex Corp", "Solo"), (5, 70, 71, None, None),
    ]
    frame = spark.createDataFrame(rows, "eid long, src_id long, dst_id long, Purchaser string, Seller string")
    got = {r.eid: (r.src_id, r.dst_id) for r in entities.resolve_linked_entities(frame, floor).collect()}
    assert got == {0: (9, 50), 1: (9, 51), 2: (9, 50), 3: (9, 50), 4: (9, 60), 5: (70, 71)}


def test_reach_of_every_company(spark, edges_frame, floor):
    known = {(u, v) for u, v in PAIRS if u != v}
    got = {r.id: (r.within_1, r.within_2, r.within_3) for r in risk.tier_sizes(edges_frame(PAIRS), 3, floor).collect()}
    for u in {u for u, _ in known}:
        reach, sizes = {v for a, v in known if a == u}, []
        first = set(reach)
        for _ in range(3):
            sizes.append(len(reach))
            reach = first | reach | {v for a, v in known if a in reach}
        assert got[u] == tuple(sizes)
    assert set(got) == {u for u, _ in known}


def test_reach_estimates(spark):
    """Two steps over 40,000 companies: within 5 % of the exact counts."""
    first = spark.range(200).selectExpr("0L as src_id", "id + 1 as dst_id")
    second = spark.range(60_000).selectExpr("id % 200 + 1 as src_id", "1000 + id % 40000 as dst_id")
    edges = first.union(second).withColumn("eid", F.monotonically_increasing_id())
    row = risk.tier_sizes(edges, 2).filter("id = 0").first()
    assert row.within_1 == pytest.approx(200, rel=0.05) and row.within_2 == pytest.approx(40_200, rel=0.05)


def power_law_by_hand(degrees, share=0.1):
    best = None
    for cutoff in sorted(set(degrees))[:-1]:
        tail = [d for d in degrees if d >= cutoff]
        if len(tail) < share * len(degrees):
            continue
        exponent = 1 + len(tail) / sum(math.log(d / (cutoff - 0.5)) for d in tail)
        gap = max(abs(sum(t >= d for t in tail) / len(tail) - ((d - 0.5) / (cutoff - 0.5)) ** (1 - exponent)) for d in set(tail))
        if best is None or gap < best[2] - 1e-12:
            best = (exponent, cutoff, gap, len(tail))
    return best


def test_power_law(spark, edges_frame):
    got = {r.direction: r for r in scale_free.power_law(edges_frame(PAIRS)).collect()}
    for direction, end in (("out", 0), ("in", 1)):
        exponent, cutoff, gap, tail = power_law_by_hand(list(Counter(p[end] for p in PAIRS).values()))
        r = got[direction]
        assert (r.cutoff, r.n_tail) == (cutoff, tail)
        assert (r.exponent, r.distance) == (pytest.approx(exponent), pytest.approx(gap))


def test_power_law_recovers_an_exponent(spark, monkeypatch):
    """Degrees drawn from a law of exponent 2.5, with more distinct degrees than cut-offs are tried."""
    monkeypatch.setattr(scale_free, "CUTOFFS", 16)
    draws = np.random.default_rng(2)
    degrees = np.floor(2.5 * (1 - draws.random(3000)) ** (-1 / 1.5) + 0.5).astype(int)
    rows = spark.createDataFrame([(i, int(d)) for i, d in enumerate(degrees)], "src_id long, d int")
    edges = rows.selectExpr("src_id", "explode(sequence(1, d)) as n").selectExpr("src_id", "-1L as dst_id", "n as eid")
    got = {r.direction: r for r in scale_free.power_law(edges).collect()}["out"]
    assert got.exponent == pytest.approx(2.5, abs=0.15) and got.distance < 0.05


def test_density(spark):
    draws = np.random.default_rng(1)
    values = np.concatenate([draws.normal(0.3, 0.05, 400), draws.normal(0.7, 0.1, 300)])
    frame = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "probability double")
    rows = sorted(profile.density_curve(frame).collect(), key=lambda r: r["at"])
    at, found = np.array([r["at"] for r in rows]), np.array([r.density for r in rows])
    q1, q3 = np.percentile(values, [25, 75])
    h = 0.9 * min(values.std(ddof=1), (q3 - q1) / 1.34) * len(values) ** -0.2
    exact = np.exp(-0.5 * ((at[:, None] - values) / h) ** 2).sum(axis=1) / (len(values) * h * math.sqrt(2 * math.pi))
    assert len(rows) == 256 and np.abs(found - exact).max() < 0.02 * exact.max()
    assert profile.density_curve(frame.limit(0)).count() == 0
    assert profile.density_curve(spark.createDataFrame([(0.5,)] * 3, "probability double")).count() == 1
