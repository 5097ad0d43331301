import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import draw as plain_draw
from supplyloom.functions.activations import bce_with_logits, clamp_min, margin, sigmoid
from supplyloom.functions.draws import draw, draw_below, standard_normals
from supplyloom.functions.names import basename
from supplyloom.functions.vectors import affine, dot_score, linear_score, relu

NAMES = [
    ("018f2b10979746da820c5269e4d87bb2 LLC", "018f2b10979746da820c5269e4d87bb2"),
    ("018f2b10979746da820c5269e4d87bb2 Ltd.", "018f2b10979746da820c5269e4d87bb2"),
    (None, None),
    ("Co", "Co"),
    (" LLC", "LLC"),
    ("A Pty Ltd", "A"),
    ("A, Inc.", "A"),
    ("Alco", "Alco"),
    ("Siemens A.G.", "Siemens"),
    ("Foo Co., Ltd.", "Foo"),
    ("Bar GmbH & Co. KG", "Bar"),
    ("Baz S.p.A.", "Baz"),
    ("Qux Incorporated", "Qux"),
    ("Plain Name", "Plain Name"),
]


def test_basename(spark):
    df = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(NAMES)], "i int, n string")
    got = [r.b for r in df.select("i", basename(F.col("n")).alias("b")).orderBy("i").collect()]
    assert got == [want for _, want in NAMES]


def test_draw_is_the_digest(spark):
    row = spark.range(1).select(draw("a", F.lit(7), "b").alias("d"), draw_below(10, "a", F.lit(7), "b").alias("m")).first()
    assert row.d == plain_draw("a|7|b") and row.m == row.d % 10


def test_standard_normals(spark):
    rows = spark.range(4000).select(standard_normals(5, "t", F.col("id")).alias("x")).collect()
    x = np.array([r.x for r in rows])
    assert x.shape == (4000, 5)
    assert abs(x.mean()) < 0.03 and abs(x.std() - 1) < 0.03
    assert np.abs(np.corrcoef(x.T) - np.eye(5)).max() < 0.06


def test_activations(spark):
    xs = [-800.0, -2.0, 0.0, 3.0, 800.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    rows = df.select(
        sigmoid(F.col("x")).alias("s"), clamp_min(F.col("x")).alias("c"),
        bce_with_logits(F.col("x"), F.lit(1.0)).alias("b"), margin(F.lit(0.25), F.col("x")).alias("m"),
    ).collect()
    for x, r in zip(xs, rows):
        assert r.s == pytest.approx(1 / (1 + math.exp(-x)) if x > -700 else 0.0)
        assert r.c == max(x, 0)
        assert r.b == pytest.approx(math.log1p(math.exp(-x)) if x > -700 else -x)
        assert r.m == max(0, x - 0.25 + 1)


def test_clamp_keeps_null(spark):
    assert spark.sql("select cast(null as double) x").select(clamp_min(F.col("x")).alias("c")).first().c is None


def test_vector_scores(spark):
    df = spark.createDataFrame([([1.0, -2.0], [3.0, 0.5])], "a array<double>, b array<double>")
    row = df.select(
        relu(F.col("a")).alias("r"), dot_score(F.col("a"), F.col("b")).alias("d"),
        linear_score(F.col("a"), F.col("b"), [1, 2, 3, 4], 0.5).alias("l"),
    ).first()
    assert row.r == [1.0, 0.0] and row.d == 2.0 and row.l == 1 - 4 + 9 + 2 + 0.5


@pytest.mark.parametrize("width_in,width_out", [(3, 4), (15, 20)])
def test_affine_native_and_batched(spark, width_in, width_out):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(50, width_in)), rng.normal(size=(50, width_in))
    a, b = rng.normal(size=(width_out, width_in)), rng.normal(size=(width_out, width_in))
    bias = rng.normal(size=width_out)
    df = spark.createDataFrame(
        [(i, u.tolist(), v.tolist()) for i, (u, v) in enumerate(zip(x, y))], "i int, x array<double>, y array<double>"
    ).repartition(3)
    for rectify in (False, True):
        got = df.select("i", affine([("x", a), ("y", b)], bias, rectify).alias("o")).orderBy("i").collect()
        want = x @ a.T + y @ b.T + bias
        want = np.maximum(want, 0) if rectify else want
        assert np.allclose([r.o for r in got], want, atol=1e-12)
