"""Many trials of a parameter search in the same jobs.

Trials that differ in widths, losses, optimisers, batch sizes and numbers of negatives still see the same edges in the
same seeded order, the same sampled neighbourhoods, and prefixes of the same features and negatives. So there are two
tables for all of them: the companies, once each, with their features at the greatest width and their sampled
neighbours, and the training order in buckets, with each edge's companies. Companies go by their place in the order of
ids. A job takes one trial through some buckets, in one task that holds the companies, step by step as its batch size
asks, and returns the trial's weights: a step costs no job of its own, and trials run side by side. No company is
written once more for a bucket that reaches it, so the tables grow with companies and edges, never with their product.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyloom.operators.graph import shuffled_batches
from supplyloom.operators import joins
from supplyloom.operators.joins import NOT_HOT, lookup
from supplyloom.operators.metrics import auc_ap, mean_auc_ap
from supplyloom.operators.sampling import fanout_of, labelled_examples, node_index
from supplyloom.params import Params
from supplyloom.plans.examples import NO_EDGE, Shape, draw_negatives
from supplyloom.plans.flow import Companies, embeddings, step_gradient
from supplyloom.plans.gradient import records_of
from supplyloom.plans.training import ROWS_PER_CHUNK_BYTES, Optimiser, SplitGraph, split_graph
from supplyloom.plans.weights import flatten, initial_weights, unflatten
from supplyloom.storage import materialise, rows_of, with_known_rows

#: Edges of a bucket, and bytes of the companies of its least part if none repeats.
MOST_ROWS, MOST_BYTES = 2048, 256 << 20
#: Buckets of a job, which a task reads one after the other. A job reads no more of companies than of edges beyond that.
JOB_BUCKETS = 16
#: Bytes of companies that a task holds in memory; more are mapped from a file without a name, gone with the task.
HELD_BYTES = 256 << 20
#: Slots of edges in a partition of the training order, and scored examples in one of an evaluation.
PART_SLOTS, PART_SCORED = 1 << 20, 1 << 20
#: What all trials of a stack have in common.
SHARED = ("test_p", "valid_p", "seed", "fanout", "strict_negatives", "exclude_targets", "own_split_messages")

MOVED = "flat binary, first binary, second binary, step int, losses array<double>"


def bucket_rows(trials: list[Params]) -> int:
    return math.lcm(*(p.batch_size for p in trials))


def grouped_rows(trials: list[Params]) -> int:
    """Edges of a bucket: as many of the least ones together as a task reads at once."""
    rows = bucket_rows(trials)
    return rows * max(1, MOST_ROWS // rows)


def stackable(trials: list[Params]) -> bool:
    """Whether the trials see the same edges, and a bucket of them fits into a task."""
    if len({tuple(getattr(p, name) for name in SHARED) for p in trials}) != 1 or trials[0].own_split_messages:
        return False
    rows = bucket_rows(trials)
    wide = widest(trials)
    shape = Shape(wide.num_node_features, wide.fanout, 1 + wide.num_negative_samples)
    return rows <= MOST_ROWS and rows * shape.row_bytes <= MOST_BYTES


def widest(trials: list[Params]) -> Params:
    return trials[0].with_(
        num_node_features=max(p.num_node_features for p in trials),
        num_negative_samples=max(p.num_negative_samples for p in trials),
    )


@dataclass(frozen=True)
class Stack:
    """What all trials share. The ids of companies are their places in the order of ids."""

    graph: SplitGraph  # its edges only
    shape: Shape  # the greatest width and number of negatives
    companies: DataFrame  # id, record: one row each
    index: DataFrame  # companies that negatives are drawn from
    buckets: DataFrame  # bucket, at, eid, ids; laid out by bucket
    n_training: int
    rows: int  # edges of a bucket


def _packed(shape: Shape) -> Column:
    """One binary per company: its sampled neighbours and the edges that brought them by layer, then its features."""

    @F.arrow_udf("binary")
    def pack(*columns: pa.Array) -> pa.Array:
        n = len(columns[0])
        flat = [c.flatten().to_numpy(zero_copy_only=False) for c in columns]
        parts = [f.astype(np.float32 if i == 4 else np.int64).view(np.uint8).reshape(n, -1) for i, f in enumerate(flat)] if n else []
        data = np.hstack(parts) if n else np.empty((0, 0), np.uint8)
        offsets = np.arange(n + 1, dtype=np.int32) * data.shape[1]
        return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])

    return pack("near1", "via1", "near2", "via2", "x")


def _numbered(edges: DataFrame, index: DataFrame) -> DataFrame:
    """The edges with their companies' places instead of ids. Places ascend with ids, so seeded draws stay the same."""
    for end in ("src_id", "dst_id"):
        table = index.select(F.col("id").alias(end), F.col("node_index").alias("__at"))
        edges = lookup(edges, table, end, 32, F.col("eid"), rows=rows_of(index), store=True).drop(end).withColumnRenamed("__at", end)
    return edges


def _records(features: DataFrame, index: DataFrame, messages: DataFrame, params: Params, shape: Shape) -> DataFrame:
    """``id, record`` of every company."""
    ids = materialise(index.select(F.col("node_index").alias("id")), "ids")
    samples = [materialise(fanout_of(ids, messages, layer, params.seed, params.fanout), f"sample{layer}") for layer in (1, 2)]
    records = lookup(features, index, "id", 32, F.col("id"), hot=NOT_HOT, rows=rows_of(index)).select(
        F.col("node_index").alias("id"), F.col("x").cast("array<float>").alias("x")
    )
    for layer, sample in zip((1, 2), samples):
        # At most ``fanout`` neighbours each.
        slots = sample.groupBy(F.col("node_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("slot", "nbr_id", "eid"))).alias("s"))
        pad = F.array_repeat(F.lit(NO_EDGE).cast("long"), params.fanout)
        kept = [
            F.slice(F.concat(F.coalesce(F.col("s").getField(c), F.array().cast("array<long>")), pad), 1, params.fanout).alias(name)
            for c, name in (("nbr_id", f"near{layer}"), ("eid", f"via{layer}"))
        ]
        records = records.join(slots, "id", "left").select(*records.columns, *kept)
    return materialise(records.select("id", _packed(shape).alias("record")), "companies")


def _parts(df: DataFrame, rows: int, each: int) -> int:
    """Partitions that a task can sort, one for each core at least."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each))


def _buckets(order: DataFrame, negatives: DataFrame, shape: Shape, rows: int) -> DataFrame:
    """The edges of each bucket with their companies: purchaser, seller, negatives."""
    used = order.select("eid", "at", F.inline(F.array(
        F.struct(F.lit(-1).alias("draw"), F.col("src_id").alias("id")), F.struct(F.lit(0).alias("draw"), F.col("dst_id").alias("id"))
    ))).unionByName(negatives.select("eid", "at", "draw", F.col("dst_id").alias("id")))
    parts = _parts(order, rows_of(order) * (1 + shape.others), PART_SLOTS)
    # At most 2 + k companies each. One shuffle, by bucket, serves the lists and their layout.
    used = used.withColumn("bucket", F.expr(f"at div {rows}")).repartition(parts, "bucket")
    edges = used.groupBy("bucket", "at", "eid").agg(F.array_sort(F.collect_list(F.struct("draw", "id"))).getField("id").alias("ids"))
    return materialise(edges, "buckets", partition_by="bucket")


def build_stack(edges: DataFrame, trials: list[Params]) -> Stack:
    wide = widest(trials)
    graph = split_graph(edges, wide)
    index = materialise(node_index(graph.features.select("id")), "index")
    placed = materialise(_numbered(graph.edges, index), "placed")
    training = materialise(placed.filter(F.col("split") == "training").drop("split"), "training")
    n = rows_of(training)
    order = shuffled_batches(training, 1, wide.seed, by=[]).withColumnRenamed("batch_id", "at")
    most = max(min(p.max_steps * p.batch_size, n) for p in trials)
    order = materialise(order.filter(F.col("at") < most), "order")
    shape = Shape(wide.num_node_features, wide.fanout, 1 + wide.num_negative_samples)
    rows = grouped_rows(trials)
    # Negatives while training come from the training edges' companies, as for a single trial.
    negatives = draw_negatives(order, training, wide)
    companies = _records(graph.features, index, training, wide, shape)
    buckets = _buckets(order, negatives, shape, rows)
    places = with_known_rows(index.select(F.col("node_index").alias("id"), "node_index"), rows_of(index))
    return Stack(SplitGraph(placed, graph.features), shape, companies, places, buckets, n, rows)


def _record_bytes(stack: Stack, params: Params) -> int:
    return 32 * stack.shape.fanout + 4 * params.num_node_features


def _own_records(stack: Stack, params: Params) -> DataFrame:
    """The companies as wide as a trial asks, in one partition."""
    return stack.companies.select("id", F.expr(f"substring(record, 1, {_record_bytes(stack, params)})").alias("record")).coalesce(1)


class Held:
    """The companies of a task: filled row by row, in any order, read by place."""

    def __init__(self, n: int, width: int, fanout: int, most: int):
        lists, size = 8 * fanout, 32 * fanout + 4 * width
        self.n, self.missing, self.fanout = n, n, fanout
        if n * size <= most:
            room = np.empty(n * size, np.uint8)
        else:
            # Mapped pages go back to the disk when memory is short. The file has no name, so nothing of it stays.
            room = np.memmap(tempfile.TemporaryFile(), np.uint8, "w+", shape=(n * size,))
        ends = np.cumsum([0, *[n * lists] * 4, n * 4 * width])
        parts = [room[a:b] for a, b in zip(ends, ends[1:])]
        self.lists = [p.view(np.int64).reshape(n, fanout) for p in parts[:4]]
        self.x = parts[4].view(np.float32).reshape(n, width)

    def add(self, places: np.ndarray, records: np.ndarray) -> None:
        lists = np.ascontiguousarray(records[:, : 32 * self.fanout]).view(np.int64).reshape(len(places), 4, self.fanout)
        for k, table in enumerate(self.lists):
            # A missing neighbour has NO_EDGE and any place.
            table[places] = lists[:, k] if k % 2 else np.maximum(lists[:, k], 0)
        self.x[places] = np.ascontiguousarray(records[:, 32 * self.fanout :]).view(np.float32)
        self.missing -= len(places)

    def table(self) -> Companies:
        if self.missing:
            raise ValueError(f"{self.missing} of {self.n} companies are missing")
        near1, via1, near2, via2 = self.lists
        return Companies(self.x, (near1, near2), (via1, via2))


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The edges of one bucket after the other; they come in order."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        buckets = batch.column("bucket").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                if held and held[0].column("bucket")[0].as_py() != buckets[a]:
                    yield pa.Table.from_batches(held)
                    held.clear()
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _edges_after(batches: Iterator[pa.RecordBatch], held: Held, record: int) -> Iterator[pa.RecordBatch]:
    """Fills ``held`` with the companies, then yields the edges in their order, whichever of both comes first."""
    early: list[pa.RecordBatch] = []
    for batch in batches:
        kinds = batch.column("kind").to_numpy()
        nodes = batch.filter(pa.array(kinds == 0))
        if nodes.num_rows:
            held.add(nodes.column("at").to_numpy(), records_of(nodes.column("record"), record))
        edges = batch.filter(pa.array(kinds == 1))
        if edges.num_rows:
            early.append(edges)
        if not held.missing:
            yield from early
            early.clear()
    yield from early


def _walk(params: Params, flat: np.ndarray, optimiser: Optimiser, shape: Shape, n_steps: int, n_companies: int):
    """The steps of one trial within some buckets, one after the other."""
    like = initial_weights(params)
    record = 32 * shape.fanout + 4 * params.num_node_features
    chunk = max(1, MOST_BYTES // (2 * shape.block_bytes * (2 + params.num_negative_samples)))
    most = HELD_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, state, losses = flat, optimiser, []
        held, table = Held(n_companies, params.num_node_features, shape.fanout, most), None
        for edges in _by_bucket(_edges_after(batches, held, record)):
            table = table or held.table()
            listed = edges["ids"].combine_chunks()
            starts = listed.offsets.to_numpy()
            places = listed.values.to_numpy()
            eids, first, size = edges["eid"].fill_null(NO_EDGE - 2).to_numpy(), edges["at"][0].as_py(), params.batch_size
            for at in range(0, edges.num_rows, size):
                step = (first + at) // size
                if step >= n_steps:
                    break
                w, total, terms, summed = unflatten(weights, like), 0.0, 0.0, np.zeros_like(weights)
                end = min(at + size, edges.num_rows)
                for a in range(at, end, chunk):
                    b = min(a + chunk, end)
                    # Each edge's purchaser, seller and first negatives.
                    counts = np.minimum(starts[a + 1 : b + 1] - starts[a:b] - 1, 1 + params.num_negative_samples)
                    row = np.repeat(np.arange(b - a), counts)
                    slot = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                    src, dst = places[starts[a:b]], places[starts[a:b][row] + 1 + slot]
                    eid = eids[a:b] if params.exclude_targets else None
                    a_loss, a_terms, g = step_gradient(table, src, dst, row, eid, w, params.loss)
                    total, terms, summed = total + a_loss, terms + a_terms, summed + flatten(g)
                weights = state.update(weights, summed / terms)
                losses.append(total / terms)
        columns = {k: pa.array([v.tobytes()], pa.binary()) for k, v in (("flat", weights), ("first", state.first), ("second", state.second))}
        columns |= {"step": pa.array([state.step], pa.int32()), "losses": pa.array([losses], pa.list_(pa.float64()))}
        yield pa.RecordBatch.from_pydict(columns)

    return run


def _work(params: Params) -> int:
    """What an edge of a trial costs, about."""
    return (2 + params.num_negative_samples) * (params.num_node_features + params.hidden_dim)


def train_stack(stack: Stack, trials: list[Params]) -> tuple[list[dict[str, np.ndarray]], list[list[float]]]:
    """Weights and losses by step of every trial: trials side by side, each one job per group of buckets."""
    own = inheritable_thread_target(stack.buckets.sparkSession)
    # The longest start first. Trials are jobs of their own: a union of single partitions would be one task.
    ranked = sorted(range(len(trials)), key=lambda t: -_work(trials[t]))
    with ThreadPoolExecutor(max_workers=len(trials)) as pool:
        runs = {t: pool.submit(own(_train_one), stack, trials[t]) for t in ranked}
        done = [runs[t].result() for t in range(len(trials))]
    return [w for w, _ in done], [losses for _, losses in done]


def _job_buckets(stack: Stack, params: Params) -> int:
    """Buckets of a job: ``JOB_BUCKETS``, or as many as have the bytes of the companies that it reads with them."""
    each = 8 * stack.rows * (1 + stack.shape.others)
    return max(JOB_BUCKETS, rows_of(stack.companies) * _record_bytes(stack, params) // each)


def _train_one(stack: Stack, params: Params) -> tuple[dict[str, np.ndarray], list[float]]:
    flat, losses = flatten(initial_weights(params)), []
    state = Optimiser(params, flat.size)
    n_steps = min(params.max_steps, -(-stack.n_training // params.batch_size))
    n_buckets = -(-min(n_steps * params.batch_size, stack.n_training) // stack.rows)
    nodes = _own_records(stack, params).select(
        F.lit(0).alias("bucket"), F.lit(0).alias("kind"), F.col("id").alias("at"), F.lit(None).cast("long").alias("eid"),
        F.lit(None).cast("array<long>").alias("ids"), "record",
    )
    of_job = _job_buckets(stack, params)
    for bucket in range(0, n_buckets, of_job):
        edges = stack.buckets.filter(F.col("bucket").between(bucket, min(bucket + of_job, n_buckets) - 1))
        edges = edges.select("bucket", F.lit(1).alias("kind"), "at", "eid", "ids", F.lit(None).cast("binary").alias("record"))
        rows = nodes.unionByName(edges.coalesce(1).sortWithinPartitions("bucket", "at")).coalesce(1)
        walk = _walk(params, flat, state, stack.shape, n_steps, rows_of(stack.companies))
        for r in rows.mapInArrow(walk, MOVED).collect():  # one row
            flat, losses = np.frombuffer(r.flat), losses + r.losses
            state.step, state.first, state.second = r.step, np.frombuffer(r["first"]), np.frombuffer(r.second)
    return unflatten(flat, initial_weights(params)), losses


def _ends_of(stack: Stack, params: Params, w: dict[str, np.ndarray]) -> DataFrame:
    """``id, as_buyer, as_seller``: the endpoint scores of one trial, in one task that holds the companies."""
    n, shape, record, d, most = rows_of(stack.companies), stack.shape, _record_bytes(stack, params), params.num_node_features, HELD_BYTES
    chunk = max(1, ROWS_PER_CHUNK_BYTES // shape.block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(n, d, shape.fanout, most)
        for batch in batches:
            if batch.num_rows:
                held.add(batch.column("id").to_numpy(), records_of(batch.column("record"), record))
        table = held.table()
        for at in range(0, n, chunk):
            ids = np.arange(at, min(at + chunk, n))
            h = embeddings(table, ids, w)
            yield pa.RecordBatch.from_pydict({"id": ids, "as_buyer": h @ w["score.w"][:d], "as_seller": h @ w["score.w"][d:]})

    return materialise(_own_records(stack, params).mapInArrow(run, "id long, as_buyer double, as_seller double"), "ends")


def stacked_ends(stack: Stack, trials: list[Params], weights: list[dict[str, np.ndarray]]) -> list[DataFrame]:
    """The endpoint scores of every trial, computed side by side."""
    own = inheritable_thread_target(stack.companies.sparkSession)
    with ThreadPoolExecutor(max_workers=len(trials)) as pool:
        runs = [pool.submit(own(_ends_of), stack, p, w) for p, w in zip(trials, weights)]
        return [r.result() for r in runs]


def _side_by_side(ends: list[DataFrame]) -> DataFrame:
    """``id, as_buyer, as_seller``: arrays with one score per trial."""
    if len(ends) == 1:
        return ends[0].select("id", F.array("as_buyer").alias("as_buyer"), F.array("as_seller").alias("as_seller"))
    longer = reduce(DataFrame.unionByName, [e.withColumn("trial", F.lit(t)) for t, e in enumerate(ends)])
    # One row per trial each.
    rows = F.array_sort(F.collect_list(F.struct("trial", "as_buyer", "as_seller"))).alias("s")
    return longer.groupBy("id").agg(rows).select("id", "s.as_buyer", "s.as_seller")


def evaluate_stack(stack: Stack, trials: list[Params], weights: list[dict[str, np.ndarray]], split: str = "validation") -> DataFrame:
    """``trial, mean_auc, mean_ap, n_batches`` of a split: trials score the same examples in one pass.

    A pass takes as many trials as have their scores sent out together; there is more than one for many companies only.
    """
    wide = widest(trials)
    ends = stacked_ends(stack, trials, weights)
    placed = shuffled_batches(stack.graph.of(split), 1, wide.seed, by=[]).withColumnRenamed("batch_id", "at")
    placed = materialise(placed, "held")
    negatives = draw_negatives(placed, stack.graph.edges.drop("split"), wide, stack.index)
    # Batches of all sizes end where a group ends.
    examples = labelled_examples(placed, negatives).withColumn("group", F.expr(f"at div {bucket_rows(trials)}"))
    n = rows_of(stack.companies)
    of_pass = max(1, min(len(trials), (joins.BROADCAST_BYTES // max(1, n) - 16) // 8))
    passes = [_evaluated(stack, examples, rows_of(placed), ends, trials, weights, range(a, min(a + of_pass, len(trials)))) for a in range(0, len(trials), of_pass)]
    return reduce(DataFrame.unionByName, passes)


def _evaluated(
    stack: Stack, examples: DataFrame, n_edges: int, ends: list[DataFrame], trials: list[Params], weights: list[dict[str, np.ndarray]], some: range
) -> DataFrame:
    """The means of ``some`` trials. What is shuffled are the examples, not their scores: groups hold whole batches."""
    n, row_bytes = rows_of(stack.companies), 8 * len(some) + 16
    table = materialise(_side_by_side([ends[t] for t in some]), "sides")
    n_scored = n_edges * sum(1 + trials[t].num_negative_samples for t in some)
    examples = examples.filter(F.col("draw") <= max(trials[t].num_negative_samples for t in some))
    examples = examples.select("group", "at", "draw", "label", "src_id", "dst_id").repartition(_parts(examples, n_scored, PART_SCORED), "group")
    for key, column in (("src_id", "as_buyer"), ("dst_id", "as_seller")):
        examples = lookup(examples, table.select(F.col("id").alias(key), column), key, row_bytes, F.col("at"), rows=n, store=True)
    asked = [
        F.struct(
            F.lit(t).alias("trial"), F.lit(trials[t].batch_size).alias("size"), F.lit(trials[t].num_negative_samples).alias("k"),
            (F.col("as_buyer")[i] + F.col("as_seller")[i] + F.lit(float(weights[t]["score.b"][0]))).alias("score"),
        )
        for i, t in enumerate(some)
    ]
    scored = examples.select("group", "at", "draw", "label", F.inline(F.array(*asked))).filter("draw <= k")
    scored = scored.select("group", "trial", F.expr("at div size").alias("batch_id"), "label", "score")
    return materialise(mean_auc_ap(auc_ap(scored, ["group", "trial", "batch_id"], bounded=True), ["trial"]), "means")
