import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from supplyloom.operators import metrics

KNOWN = [(0.9, 1), (0.8, 0), (0.8, 1), (0.3, 0), (0.2, 1)]


def _frame(spark, rows, schema="batch_id long, score double, label int"):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("bounded", [True, False])
def test_known_value(spark, bounded):
    df = _frame(spark, [(0, *r) for r in KNOWN])
    row = metrics.auc_ap(df, ["batch_id"], bounded=bounded).first()
    assert row.auc == pytest.approx(0.5833333333) and row.ap == pytest.approx(0.7555555556)


@pytest.mark.parametrize("bounded", [True, False])
def test_against_brute_force(spark, bounded):
    rng = random.Random(8)
    # one batch holds most rows and one score most of its rows
    rows = [
        (0 if rng.random() < 0.7 else rng.randrange(4), 0.5 if rng.random() < 0.4 else round(rng.random(), 2), int(rng.random() < 0.3))
        for _ in range(800)
    ]
    got = {r.batch_id: r for r in metrics.auc_ap(_frame(spark, rows).repartition(7), ["batch_id"], bounded=bounded).collect()}
    for b in got:
        s, y = zip(*[(r[1], r[2]) for r in rows if r[0] == b])
        assert got[b].auc == pytest.approx(brute.auc(s, y)) and got[b].ap == pytest.approx(brute.average_precision(s, y))
    pooled = metrics.auc_ap(_frame(spark, rows)).first()
    assert pooled.auc == pytest.approx(brute.auc([r[1] for r in rows], [r[2] for r in rows]))


def test_auc_is_the_same_under_a_sigmoid(spark):
    from supplyloom.functions.activations import sigmoid

    rng = random.Random(1)
    df = _frame(spark, [(0, rng.gauss(0, 2), int(rng.random() < 0.5)) for _ in range(200)])
    a = metrics.auc_ap(df, ["batch_id"]).first()
    b = metrics.auc_ap(df.withColumn("score", sigmoid(F.col("score"))), ["batch_id"]).first()
    assert (a.auc, a.ap) == (pytest.approx(b.auc), pytest.approx(b.ap))


def test_one_class_has_no_auc(spark):
    row = metrics.auc_ap(_frame(spark, [(0, 0.5, 1), (0, 0.7, 1)]), ["batch_id"]).first()
    assert row.auc is None and row.ap == 1.0
    row = metrics.auc_ap(_frame(spark, [(0, 0.5, 0)]), ["batch_id"]).first()
    assert row.auc is None and row.ap is None


def test_macro_average(spark):
    rows = [(0, 0.9, 1), (0, 0.1, 0)] + [(1, 0.1, 1), (1, 0.9, 0), (1, 0.8, 0)]
    row = metrics.mean_auc_ap(metrics.auc_ap(_frame(spark, rows), ["batch_id"])).first()
    assert row.mean_auc == 0.5 and row.n_batches == 2


def test_losses(spark):
    rows = [(0, 0, 2.0, 1), (0, 0, -1.0, 0), (0, 0, 3.0, 0), (0, 1, -0.5, 1), (0, 1, 0.5, 0)]
    df = _frame(spark, rows, "batch_id long, eid long, score double, label int")
    z = np.array([r[2] for r in rows])
    y = np.array([r[3] for r in rows])
    p = 1 / (1 + np.exp(-z))
    assert metrics.bce_loss(df).first().bce_loss == pytest.approx(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())
    gaps = [max(0, p[1] - p[0] + 1), max(0, p[2] - p[0] + 1), max(0, p[4] - p[3] + 1)]
    assert metrics.margin_loss(df).first().margin_loss == pytest.approx(np.mean(gaps))
    assert metrics.margin_loss(df, ["batch_id"]).first().margin_loss == pytest.approx(np.mean(gaps))


def test_metric_sink(spark, tmp_path):
    wide = _frame(spark, [(0, 0.5, 1)]).select("batch_id", F.col("score").alias("auc"))
    rows = metrics.as_metrics(wide, "r", "training", F.col("batch_id"), {"auc": "AUC"})
    for _ in range(2):
        metrics.append_metrics(rows, str(tmp_path / "m"))
    metrics.append_metrics(rows.withColumn("value", F.col("value") + 1).withColumn("step", F.lit(1)), str(tmp_path / "m"))
    back = metrics.read_metrics(spark, str(tmp_path / "m")).orderBy("step").collect()
    assert [(r.run_id, r.split, r.step, r.name, r.value) for r in back] == [("r", "training", 0, "AUC", 0.5), ("r", "training", 1, "AUC", 1.5)]
