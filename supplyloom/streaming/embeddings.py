"""Embeddings that follow the stream of relations.

For every company a state table keeps, layer by layer, the sum and number of its in-neighbours' vectors, besides its
own vectors. A micro-batch of new relations adds to these sums: first the new neighbours' features, then, one layer
up, what changed in the vectors of companies that the first step touched. So a batch recomputes companies within two
steps of its relations and leaves all others alone; the result is that of a full pass over all relations so far.

The state is a log: each batch writes the rows it changed under its own number, and reads the last row of each company
below that number. A replayed batch therefore starts from the same state and replaces its own rows. Every ``FOLD``
batches the log is folded into one table.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyloom.functions.vectors import affine, zeros
from supplyloom.operators.graph import edges_of, node_set
from supplyloom.operators.joins import lookup
from supplyloom.operators.sage import LayerWeights, LinkModel
from supplyloom.sources.schemas import BRONZE
from supplyloom.storage import materialise, rows_of
from supplyloom.streaming.ingest import _drain

#: Batches after which the log is folded.
FOLD = 16

VECTOR = "array<double>"
STATE = f"id long, x {VECTOR}, sum1 {VECTOR}, n1 long, h1 {VECTOR}, sum2 {VECTOR}, n2 long, h2 {VECTOR}"
LINKS = "src_id long, dst_id long, n long"


def _log(spark: SparkSession, path: str, ddl: str, before: int) -> DataFrame:
    """Rows of the batches below ``before``, from the last fold on, with their ``version``."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    known = sorted((int(n.split("=")[1]), n) for n in names if n.startswith(("version=", "folded=")))
    known = [(v, n) for v, n in known if v < before]
    folds = [v for v, n in known if n.startswith("folded=")]
    start = max(folds, default=-1)
    chosen = [(v, n) for v, n in known if v > start or v == start and n.startswith("folded=")]
    out = spark.createDataFrame([], f"{ddl}, version long")
    for version, name in chosen:
        out = out.unionByName(spark.read.schema(ddl).parquet(f"{path}/{name}").withColumn("version", F.lit(version).cast("long")))
    return out


def _current(log: DataFrame) -> DataFrame:
    """The last row of each company."""
    columns = [c for c in log.columns if c not in ("id", "version")]
    return log.groupBy("id").agg(F.max_by(F.struct(*columns), "version").alias("s")).select("id", "s.*")


def _write(rows: DataFrame, path: str, version: int, folded: bool = False) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/{'folded' if folded else 'version'}={version}")


def _added(a: str, b: str, width: int) -> Column:
    return F.zip_with(F.coalesce(a, zeros(width)), F.coalesce(b, zeros(width)), lambda x, y: x + y)


def _gathered(links: DataFrame, vectors: DataFrame, width: int, count: str) -> DataFrame:
    """``id, add, more``: sums of the vectors of the sources of ``links`` (src_id, dst_id, n), and numbers of links."""
    table = vectors.select(F.col("id").alias("src_id"), F.col("v").alias("m"))
    found = lookup(links, table, "src_id", 8 * width + 32, F.col("dst_id"), rows=rows_of(vectors))
    sums = [F.expr(f"sum(m[{i}] * n)").alias(f"s{i}") for i in range(width)]
    total = found.groupBy(F.col("dst_id").alias("id")).agg(*sums, F.sum(count).alias("more"))
    return total.select("id", F.array(*[f"s{i}" for i in range(width)]).alias("add"), "more")


def _layer(own: str, total: str, n: str, weights: LayerWeights, rectify: bool) -> tuple[Column, Column]:
    mean = F.when(F.col(n) > 0, F.transform(total, lambda s: s / F.col(n))).otherwise(zeros(weights.width_in))
    return mean, affine([(own, weights.w_self), ("mean", weights.w_neigh)], weights.bias, rectify)


def take_batch(
    relations: DataFrame, batch_id: int, state: str, features: Callable[[DataFrame], DataFrame], model: LinkModel
) -> None:
    """Adds the relations of one batch to the state below ``state``. ``features`` gives ``id, x`` for ids."""
    if model.aggregator != "mean":
        raise ValueError("sums can only be kept for the mean aggregator")
    spark = relations.sparkSession
    width, hidden = model.layer1.width_in, model.layer2.width_in
    arrived = edges_of(relations.withColumn("eid", F.lit(0))).groupBy("src_id", "dst_id").agg(F.count(F.lit(1)).alias("n"))
    arrived = materialise(arrived, "arrived")
    log, links = _log(spark, f"{state}/companies", STATE, batch_id), _log(spark, f"{state}/links", LINKS, batch_id)
    before = materialise(_current(log), "before")

    nodes = materialise(node_set(arrived), "nodes")
    new = materialise(nodes.join(before, "id", "left_anti"), "new")
    known = before.unionByName(features(new).select("id", "x"), allowMissingColumns=True)
    known = materialise(known, "known")

    # Layer 1 changes at the ends that buy messages in: the sellers of the batch, and new companies.
    first = _gathered(arrived, _named(known, "x"), width, "n")
    touched = nodes.join(first, "id", "left")
    changed = materialise(
        known.join(touched, "id").withColumns({
            "sum1": _added("sum1", "add", width),
            "n1": F.coalesce("n1", F.lit(0)) + F.coalesce("more", F.lit(0)),
            "old1": F.col("h1"),
        }).drop("add", "more"),
        "changed1",
    )
    mean, value = _layer("x", "sum1", "n1", model.layer1, True)
    changed = materialise(changed.withColumn("mean", mean).withColumn("h1", value).drop("mean"), "layer1")

    # Layer 2: new links bring whole vectors, old links of changed companies what changed in them.
    # The batch's own links come from companies of the batch, which all are in ``changed``.
    fresh = _gathered(arrived, _named(changed, "h1"), hidden, "n")
    moved = changed.filter(F.col("old1").isNotNull()).select("id", F.zip_with("h1", "old1", lambda a, b: a - b).alias("v"))
    moved = materialise(moved.filter(F.exists("v", lambda d: d != 0.0)), "moved")
    carried = _gathered(links.select("src_id", "dst_id", "n"), moved, hidden, "n").withColumn("more", F.lit(0).cast("long"))
    both = fresh.unionByName(carried).groupBy("id").agg(
        F.array(*[F.sum(F.col("add")[i]) for i in range(hidden)]).alias("add"), F.sum("more").alias("more")
    )
    both = materialise(both, "second")
    ids = changed.select("id").union(both.select("id")).distinct()
    rest = known.join(changed.select("id"), "id", "left_anti").unionByName(changed.drop("old1"))
    after = rest.join(ids, "id", "left_semi").join(both, "id", "left").withColumns({
        "sum2": _added("sum2", "add", hidden), "n2": F.coalesce("n2", F.lit(0)) + F.coalesce("more", F.lit(0)),
    }).drop("add", "more")
    mean, value = _layer("h1", "sum2", "n2", model.layer2, False)
    after = after.withColumn("mean", mean).withColumn("h2", value).drop("mean")
    _write(after.select(*before.columns), f"{state}/companies", batch_id)
    _write(arrived, f"{state}/links", batch_id)
    if batch_id % FOLD == FOLD - 1:
        _write(_current(_log(spark, f"{state}/companies", STATE, batch_id + 1)), f"{state}/companies", batch_id, folded=True)
        whole = _log(spark, f"{state}/links", LINKS, batch_id + 1).groupBy("src_id", "dst_id").agg(F.sum("n").alias("n"))
        _write(whole, f"{state}/links", batch_id, folded=True)


def _named(vectors: DataFrame, column: str) -> DataFrame:
    """``id, v`` of a written table, with its known number of rows."""
    out = vectors.select("id", F.col(column).alias("v"))
    out.known_rows = rows_of(vectors)
    return out


def current_embeddings(spark: SparkSession, state: str) -> DataFrame:
    """``id, x``: the embedding of every company that any relation named so far."""
    return _current(_log(spark, f"{state}/companies", STATE, np.iinfo(np.int64).max)).select("id", F.col("h2").alias("x"))


def follow_embeddings(
    spark: SparkSession, silver: str, state: str, checkpoint: str, features: Callable[[DataFrame], DataFrame],
    model: LinkModel, schema: T.StructType = BRONZE, timeout: float | None = None,
) -> None:
    """Takes all relations that have arrived in silver into the state, then stops."""
    query = (
        spark.readStream.schema(schema)
        .parquet(silver)
        .writeStream.foreachBatch(lambda batch, batch_id: take_batch(batch, batch_id, state, features, model))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    _drain(query, timeout)
