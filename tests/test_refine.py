import pytest
from pyspark.sql import functions as F

from supplyloom.operators import refine
from supplyloom.operators.entities import resolve_entities
from supplyloom.operators.profile import exact_quantiles, probability_histogram, probability_profile
from supplyloom.sources.schemas import BRONZE, EDGES, model_signature, require

RELATION = "Purchaser string, Seller string, src_id long, dst_id long, probability double"


def test_threshold(spark):
    df = spark.createDataFrame([(0.55,), (0.5499999,), (None,), (0.9,)], "probability double")
    assert sorted(r.probability for r in refine.confidence_filter(df).collect()) == [0.55, 0.9]


def test_silver_cleans_both_names(spark):
    df = spark.createDataFrame([("A LLC", "B Ltd.", 1, 2, 0.7)], RELATION)
    row = refine.to_silver(df).first()
    assert (row.Purchaser, row.Seller) == ("A", "B")


def test_refinement_rule(spark):
    rows = [(0.7, 0.7), (None, 0.6), (0.9, None), (0.8, 0.6), (0.1, 0.6)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, gnn_prediction double, probability double")
    out = refine.refine_confidence(df)
    assert out.columns == ["i", "probability"]
    assert [r.probability for r in out.orderBy("i").collect()] == [0.7, 0.6, None, 0.8, 0.6]


def test_review_is_strict(spark):
    rows = [(0.5, 0.81), (0.5, 0.8), (0.6, 0.9), (0.59, 0.9)]
    df = spark.createDataFrame([("a", "b", *r) for r in rows], "Purchaser string, Seller string, probability double, gnn_prediction double")
    assert sorted(r.probability for r in refine.review_links(df).collect()) == [0.5, 0.59]


def test_cast(spark):
    df = spark.createDataFrame([("0.5",), ("x",), (None,)], "probability string")
    assert [r.probability for r in refine.cast_probability(df).collect()] == [0.5, None, None]


def test_contract(spark):
    df = spark.createDataFrame([("A", "B", 1, 2, 0.7)], RELATION)
    assert require(df, BRONZE) is df
    assert model_signature(df)["inputs"] == EDGES
    with pytest.raises(ValueError, match="dst_id: absent"):
        require(df.drop("dst_id"), EDGES)
    with pytest.raises(ValueError, match="string instead of bigint"):
        require(df.withColumn("src_id", F.col("src_id").cast("string")), EDGES)


@pytest.mark.parametrize("floor", [None, 2])
def test_entities(spark, floor, monkeypatch):
    if floor:
        monkeypatch.setattr("supplyloom.operators.joins.BROADCAST_BYTES", 0)
    rows = [("A LLC", "B Ltd", 5, 9, 0.7), ("A Inc", "B", 3, 8, 0.8), (None, "A", 7, 4, 0.9)]
    got = resolve_entities(spark.createDataFrame(rows, RELATION), floor=floor)
    assert sorted((r.Purchaser or "", r.Seller, r.src_id, r.dst_id) for r in got.collect()) == [
        ("", "A", 7, 3), ("A", "B", 3, 8), ("A", "B", 3, 8),
    ]


def test_quantiles_with_ties_and_nulls(spark):
    import numpy as np

    values = [0.5] * 400 + [i / 997 for i in range(997)] + [None] * 3
    df = spark.createDataFrame([(v,) for v in values], "probability double").repartition(6)
    real = [v for v in values if v is not None]
    fractions = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    for bins in (1, 7, 4096):
        got = exact_quantiles(df, "probability", fractions, bins)
        assert np.allclose(got, np.quantile(real, fractions), atol=1e-12)
    row = probability_profile(df).first()
    assert row.n == len(real) and row.n_missing == 3


def test_profile_of_nothing_and_of_one_value(spark):
    empty = spark.createDataFrame([], "probability double")
    assert probability_profile(empty).first().median is None
    one = spark.createDataFrame([(0.4,)] * 3, "probability double")
    row = probability_profile(one).first()
    assert (row.q1, row.median, row.whisker_low, row.n_outliers) == (0.4, 0.4, 0.4, 0)


def test_histogram_keeps_one_in_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (1.0,), (None,)], "probability double")
    assert {(r.bin, r.n) for r in probability_histogram(df).collect()} == {(1, 1), (2, 1), (20, 1)}


def test_filter_is_pushed_to_the_scan(spark, tmp_path):
    spark.createDataFrame([("A", "B", 1, 2, 0.7)], RELATION).write.parquet(str(tmp_path / "b"))
    plan = refine.to_silver(spark.read.parquet(str(tmp_path / "b")))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(probability,0.55)" in plan and "EvalPython" not in plan
