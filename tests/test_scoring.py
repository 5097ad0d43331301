import random

import pytest

from supplyloom.operators import joins, risk, scoring

RNG = random.Random(6)
ENDS = {i: (RNG.gauss(0, 1), RNG.gauss(0, 1)) for i in range(25)}
# company 0 buys from nearly everyone, itself included; 24 buys nothing
PAIRS = [(0, d) for d in range(24)] + [(RNG.randrange(24), RNG.randrange(25)) for _ in range(80)]


@pytest.fixture
def ends(spark):
    return spark.createDataFrame([(i, *v) for i, v in ENDS.items()], "id long, as_buyer double, as_seller double")


@pytest.fixture(params=["broadcast", "salted"])
def way(request, monkeypatch):
    if request.param == "salted":
        monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(joins, "HOT_FLOOR", 10)
    return request.param


def test_topk_missing(edges_frame, ends, way):
    for k in (1, 3, 40):
        got = {}
        for r in scoring.topk_missing_links(edges_frame(PAIRS), ends, 0.1, k).collect():
            got.setdefault(r.src_id, []).append((r.place, r.dst_id))
        for u in {s for s, _ in PAIRS}:
            taken = {d for s, d in PAIRS if s == u} | {u}
            want = sorted((v for v in ENDS if v not in taken), key=lambda v: (-ENDS[v][1], v))[:k]
            assert [d for _, d in sorted(got.get(u, []))] == want


def test_unknown_company_scores_null(spark, ends, way):
    df = spark.createDataFrame([(0, 1, 2, 0.6), (1, 1, 99, 0.6), (2, 99, 1, None)], "eid long, src_id long, dst_id long, probability double")
    rows = {r.eid: r for r in scoring.score_relations(df, ends, 0.1).collect()}
    assert rows[0].gnn_prediction is not None and rows[1].gnn_prediction is None and rows[2].gnn_prediction is None


def test_plans_stay_in_the_jvm_and_broadcast_small_tables(spark, ends):
    df = spark.createDataFrame([(0, 1, 2, 0.6)], "eid long, src_id long, dst_id long, probability double")
    plan = scoring.score_relations(df, ends, 0.1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "EvalPython" not in plan
    profiles = spark.createDataFrame(
        [(1, "A", "R", 1.0, 0.5)], "company_id long, country string, region string, risk_premium double, risk_score double"
    )
    plan = risk.enrich(df, profiles)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2


def test_rejected(spark, ends):
    df = spark.createDataFrame(
        [(0, 1, 2, 0.6), (1, 1, 2, 0.5), (2, 1, 99, 0.1), (3, 3, 4, None)],
        "eid long, src_id long, dst_id long, probability double",
    )
    rows = {r.eid: r for r in scoring.rejected_links(df, ends, 9.0).collect()}
    assert rows.keys() == {1, 2, 3}
    assert rows[1].admitted and not rows[2].admitted and rows[3].admitted


def test_dot_scores(spark, way):
    h = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.5, -1.0])], "id long, x array<double>")
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "src_id long, dst_id long")
    got = {r.dst_id: r.logit for r in scoring.dot_scores(pairs, h, 2).collect()}
    assert got == {2: -1.5, 3: None}


def _tiers(pairs, roots, depth):
    out = set()
    for root in roots:
        seen, front = {root}, {root}
        for t in range(1, depth + 1):
            front = {d for s, d in pairs if s in front} - seen
            seen |= front
            out |= {(root, c, t) for c in front}
    return out


@pytest.mark.parametrize("floor", [None, 2])
def test_tiers(spark, edges_frame, floor):
    pairs = [(0, 1), (1, 2), (2, 0), (0, 3), (3, 2), (2, 4), (4, 5), (5, 6), (7, 7)] + [(8, i) for i in range(9, 20)]
    roots = [0, 2, 7, 8, 4]
    got = risk.supplier_tiers(edges_frame(pairs), spark.createDataFrame([(r,) for r in roots], "id long"), 3, floor)
    assert {tuple(r) for r in got.collect()} == _tiers(pairs, roots, 3)


def test_no_tiers(spark, edges_frame):
    got = risk.supplier_tiers(edges_frame([(7, 7)]), spark.createDataFrame([(7,)], "id long"))
    assert got.columns == ["root", "company", "tier"] and got.count() == 0


def test_enrichment_keeps_relations_without_profile(spark, way):
    rel = spark.createDataFrame([(0, 1, 2, 0.6), (1, 1, 9, 0.7)], "eid long, src_id long, dst_id long, probability double")
    profiles = risk.company_profiles(
        spark.createDataFrame([(1, "x", "A", "R"), (2, "y", "B", "R")], "company_id long, company string, country string, region string"),
        spark.createDataFrame([("A", 1.5)], "country string, risk_premium double"),
        spark.createDataFrame([(1, 0.3)], "company_id long, risk_score double"),
    )
    rows = {r.eid: r for r in risk.enrich(rel, profiles).collect()}
    assert (rows[0].buyer_country, rows[0].buyer_risk_premium, rows[0].buyer_risk_score) == ("A", 1.5, 0.3)
    assert (rows[0].seller_country, rows[0].seller_risk_premium) == ("B", None) and rows[1].seller_country is None
    by = {(r.buyer_country, r.seller_country): r for r in risk.risk_by_country(risk.enrich(rel, profiles)).collect()}
    assert by[("A", "B")].n_relations == 1 and by[("A", None)].expected_relations == pytest.approx(0.7)
