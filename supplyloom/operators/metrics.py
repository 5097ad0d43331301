"""Ranking metrics and losses of scored examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from supplyloom.functions.activations import bce_with_logits, margin, sigmoid
from supplyloom.operators.position import running_totals

METRICS_SCHEMA = "run_id string, split string, step long, name string, value double"


def threshold_counts(scored: DataFrame, by: list[str] = (), label: str = "label", score: str = "score") -> DataFrame:
    """One row per distinct score: tied scores form one threshold, folded before the shuffle."""
    return scored.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n")
    )


def auc_ap(
    scored: DataFrame,
    by: list[str] = (),
    label: str = "label",
    score: str = "score",
    bounded: bool = False,
) -> DataFrame:
    """ROC-AUC (ties count half) and step-wise average precision per group.

    ``bounded`` says that every group is a mini-batch whose size a parameter
    fixes, so one task can sort it. Otherwise groups of any size, or the whole
    table as one group, are ranked by range partitions.
    """
    by = list(by)
    counts = threshold_counts(scored, by, label, score)
    falling = [F.col("score").desc()]
    if bounded and by:
        down = Window.partitionBy(*by).orderBy(*falling).rowsBetween(Window.unboundedPreceding, 0)
        ranked = counts.withColumn("tp", F.sum("pos").over(down)).withColumn("seen", F.sum("n").over(down))
    else:
        ranked = running_totals(counts, {"tp": "pos", "seen": "n"}, falling, by)
    # Products of counts leave the range of longs at some 10^9 examples, so the factors are doubles.
    pos, tp, seen = (F.col(c).cast("double") for c in ("pos", "tp", "seen"))
    neg = (F.col("n") - F.col("pos")).cast("double")
    # Each negative is beaten by the positives above it and ties with those at its score.
    wins = F.sum(neg * (F.lit(2.0) * tp - pos)) / F.lit(2.0)
    steps = F.sum(pos * tp / seen)
    both = F.when((F.sum("pos") > 0) & (F.sum(neg) > 0), wins / (F.sum(pos) * F.sum(neg)))
    return ranked.groupBy(*by).agg(
        both.alias("auc"),
        F.when(F.sum("pos") > 0, steps / F.sum("pos")).alias("ap"),
        F.sum("n").alias("n_examples"),
    )


def mean_auc_ap(per_batch: DataFrame, by: list[str] = ()) -> DataFrame:
    """Macro average over batches, not pooled."""
    return per_batch.groupBy(*by).agg(
        F.avg("auc").alias("mean_auc"), F.avg("ap").alias("mean_ap"), F.count(F.lit(1)).alias("n_batches")
    )


def bce_loss(scored: DataFrame, by: list[str] = (), logit: str = "score") -> DataFrame:
    return scored.groupBy(*by).agg(
        F.avg(bce_with_logits(F.col(logit), F.col("label").cast("double"))).alias("bce_loss")
    )


def margin_loss(scored: DataFrame, by: list[str] = (), logit: str = "score") -> DataFrame:
    """Mean over negatives of ``max(0, s(neg) - s(pos) + 1)`` against their own positive.

    ``eid`` ties the k drawn negatives to their one positive; both go through the sigmoid.
    """
    strength = sigmoid(F.col(logit))
    groups = scored.groupBy("eid").agg(
        F.max(F.when(F.col("label") == 1, strength)).alias("pos"),
        F.collect_list(F.when(F.col("label") == 0, F.struct(*by, strength.alias("neg")))).alias("negs"),
    )
    rows = groups.filter(F.col("pos").isNotNull()).select("pos", F.inline("negs"))
    return rows.groupBy(*by).agg(F.avg(margin(F.col("pos"), F.col("neg"))).alias("margin_loss"))


def as_metrics(values: DataFrame, run_id: str, split: str, step: Column, names: dict[str, str]) -> DataFrame:
    """Long rows ``(run_id, split, step, name, value)`` from a wide metric frame."""
    pairs = F.array(
        *[F.struct(F.lit(n).alias("name"), F.col(c).cast("double").alias("value")) for c, n in names.items()]
    )
    return values.select(
        F.lit(run_id).alias("run_id"), F.lit(split).alias("split"), step.cast("bigint").alias("step"),
        F.explode(pairs).alias("m"),
    ).select("run_id", "split", "step", "m.name", "m.value")


METRIC_COLUMNS = ["run_id", "split", "step", "name", "value"]


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Adds rows to a metric table. A row written again replaces the earlier one for whoever reads the table."""
    rows = metrics.select(*METRIC_COLUMNS).withColumn("written", F.expr("unix_micros(current_timestamp())"))
    rows.write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The last value of each run, split, step and name, so a write that was retried or replayed counts once."""
    rows = spark.read.schema(f"{METRICS_SCHEMA}, written long").parquet(path)
    last = F.max_by("value", F.struct("written", "value")).alias("value")
    return rows.groupBy("run_id", "split", "step", "name").agg(last)
