"""Embeddings that follow a stream, and the SQL surface."""

import json
import random

import numpy as np
from pyspark.sql import functions as F

from supplyloom.operators import features
from supplyloom.operators.graph import edges_of, node_set
from supplyloom.plans import catalog
from supplyloom.plans import fixtures as fx
from supplyloom.plans.training import full_embeddings
from supplyloom.streaming import embeddings as follow

COLUMNS = "Purchaser string, Seller string, src_id long, dst_id long, probability double"


def vectors_of(ids):
    return features.integer_features(ids, fx.WIDTH)


def full(spark, rows):
    edges = edges_of(spark.createDataFrame(rows, COLUMNS).withColumn("eid", F.lit(0)))
    return full_embeddings(edges, vectors_of(node_set(edges)), fx.fixed_model())


def as_dict(frame):
    return {r.id: np.array(r.x) for r in frame.collect()}


def same(a, b):
    return set(a) == set(b) and all(np.allclose(a[k], b[k], atol=1e-6) for k in a)


def batches(n):
    draws = random.Random(6)
    return [[("A", "B", draws.randrange(25), draws.randrange(25), 0.9) for _ in range(draws.choice([1, 4, 30]))] for _ in range(n)]


def test_every_batch_equals_a_full_pass(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(follow, "FOLD", 3)
    state, seen = str(tmp_path / "state"), []
    for number, rows in enumerate(batches(5)):
        seen += rows
        follow.take_batch(spark.createDataFrame(rows, COLUMNS), number, state, vectors_of, fx.fixed_model())
        assert same(as_dict(follow.current_embeddings(spark, state)), as_dict(full(spark, seen)))


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    state, (a, b) = str(tmp_path / "state"), batches(2)
    for number, rows in ((0, a), (1, b), (1, b)):
        follow.take_batch(spark.createDataFrame(rows, COLUMNS), number, state, vectors_of, fx.fixed_model())
    assert same(as_dict(follow.current_embeddings(spark, state)), as_dict(full(spark, a + b)))


def test_a_batch_writes_only_what_is_near_it(spark, tmp_path):
    """A chain of companies: a link at its end reaches two steps and no further."""
    state = str(tmp_path / "state")
    chain = [("A", "B", i, i + 1, 0.9) for i in range(10)]
    follow.take_batch(spark.createDataFrame(chain, COLUMNS), 0, state, vectors_of, fx.fixed_model())
    follow.take_batch(spark.createDataFrame([("A", "B", 50, 3, 0.9)], COLUMNS), 1, state, vectors_of, fx.fixed_model())
    written = spark.read.parquet(f"{state}/companies/version=1")
    assert {r.id for r in written.collect()} == {50, 3, 4}


def test_the_stream_drains_and_restarts(spark, tmp_path):
    silver, state, check = (str(tmp_path / n) for n in ("silver", "state", "check"))
    seen = []
    for rows in batches(2):
        seen += rows
        spark.createDataFrame(rows, COLUMNS).write.mode("append").parquet(silver)
        for _ in range(2):  # the second call finds nothing new
            follow.follow_embeddings(spark, silver, state, check, vectors_of, fx.fixed_model())
        assert same(as_dict(follow.current_embeddings(spark, state)), as_dict(full(spark, seen)))


def test_sql_functions_run_no_python(spark, sf):
    for name in ("review_sql", "refined_sql"):
        plan = catalog.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
    names = ["Acme LLC", "Acme Co., Ltd.", "GmbH", None, "O'Neil S.A."]
    frame = spark.createDataFrame([(n,) for n in names], "n string")
    frame.createOrReplaceTempView("names_of_test")
    from supplyloom.functions.names import basename

    by_sql = [r[0] for r in spark.sql("SELECT loom_company_name(n) FROM names_of_test").collect()]
    assert by_sql == [r[0] for r in frame.select(basename(F.col("n"))).collect()]
    row = spark.sql("SELECT loom_refined(NULL, 0.5D) a, loom_refined(0.7D, NULL) b, loom_refined(0.7D, 0.5D) c, loom_dot(array(1D, 2D), array(3D, 4D)) d").first()
    assert tuple(row) == (0.5, None, 0.7, 11.0)
    assert json.dumps(sorted(catalog.queries()))
