
import pytest
from pyspark.sql import functions as F

from supplyloom.operators import graph


@pytest.mark.parametrize("n", [1, 3, 4, 5, 9, 10, 11, 137])
def test_split_sizes(edges_frame, n):
    split = graph.edge_split(edges_frame([(i, i + 1) for i in range(n)]))
    by = {s: sorted(r.eid for r in split.filter(F.col("split") == s).collect()) for s in graph.SPLITS}
    test, valid = int(0.1 * n), int(0.2 * n)
    assert [len(by[s]) for s in graph.SPLITS] == [n - valid - test, valid, test]
    assert by["training"] + by["validation"] + by["testing"] == list(range(n))


def test_split_does_not_depend_on_partitions(edges_frame):
    edges = edges_frame([(i % 7, i) for i in range(200)])
    a = {tuple(r) for r in graph.edge_split(edges.repartition(1)).collect()}
    b = {tuple(r) for r in graph.edge_split(edges.repartition(11)).collect()}
    assert a == b


def test_batches(edges_frame):
    split = graph.edge_split(edges_frame([(i % 7, i) for i in range(103)]))
    rows = graph.shuffled_batches(split, 10, seed=3).collect()
    for s in graph.SPLITS:
        sizes = {}
        for r in rows:
            if r.split == s:
                sizes[r.batch_id] = sizes.get(r.batch_id, 0) + 1
        n = sum(sizes.values())
        assert [sizes[b] for b in sorted(sizes)] == [10] * (n // 10) + ([n % 10] if n % 10 else [])
    capped = graph.first_batches(graph.shuffled_batches(split, 10, seed=3), 2)
    assert {r.batch_id for r in capped.collect()} == {0, 1}
    other = {r.eid: r.batch_id for r in graph.shuffled_batches(split, 10, seed=4).collect()}
    assert other != {r.eid: r.batch_id for r in rows}


def test_counts_keep_multi_edges_and_gaps(edges_frame):
    edges = edges_frame([(0, 1), (0, 1), (2, 2), (7, 0)])
    assert tuple(graph.graph_counts(edges).first()) == (4, 4, 8)
    assert sorted(r.id for r in graph.dense_nodes(edges).collect()) == list(range(8))
    assert {tuple(r) for r in graph.degrees(edges).collect()} == {(0, 2, 1), (1, 0, 2), (2, 1, 1), (7, 1, 0)}
    got = {tuple(r) for r in graph.degree_distribution(edges).collect()}
    assert got == {("in", 0, 1), ("in", 1, 2), ("in", 2, 1), ("out", 0, 1), ("out", 1, 2), ("out", 2, 1)}
    assert {r.id for r in graph.hubs(edges, 0.5).collect()} == {0, 1}


def test_empty_graph(edges_frame):
    edges = edges_frame([(0, 1)]).filter("eid < 0")
    assert graph.graph_counts(edges).first().n_edges == 0
    assert graph.dense_nodes(edges).count() == 0
    assert graph.edge_split(edges).count() == 0


@pytest.mark.parametrize("n,f", [(10, 0.1), (25, 0.1), (35, 0.1), (7, 0.3), (5, 0.5)])
def test_exact_sample(spark, n, f):
    df = spark.range(n)
    a = {r.id for r in graph.exact_sample(df, f, "id", 1).collect()}
    assert len(a) == round(n * f)
    assert a == {r.id for r in graph.exact_sample(df.repartition(5), f, "id", 1).collect()}


def test_edges_without_eid_need_an_order(spark):
    df = spark.createDataFrame([(5, 1), (3, 2), (4, 0)], "src_id long, dst_id long")
    with pytest.raises(ValueError):
        graph.edges_of(df)
    got = graph.edges_of(df, [F.col("src_id"), F.col("dst_id")]).orderBy("eid").collect()
    assert [tuple(r) for r in got] == [(0, 3, 2), (1, 4, 0), (2, 5, 1)]
