"""Components against a union-find."""

import random

import pytest

from supplyloom.llm import components
from supplyloom.llm.components import connected_components


def brute(links):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


CHAIN = [(i, i + 1) for i in range(300)]
HUB = [(5000, i) for i in range(300)]


@pytest.mark.parametrize("kind", ["random", "chain", "hub", "none", "loops"])
def test_components(spark, kind):
    draw = random.Random(1)
    links = {
        "random": [(draw.randrange(400), draw.randrange(400)) for _ in range(250)],
        "chain": draw.sample(CHAIN, len(CHAIN)),
        "hub": HUB + [(b, a) for a, b in HUB[:9]],
        "none": [],
        "loops": [(3, 3), (4, 4)],
    }[kind]
    table = spark.createDataFrame(links, "a long, b long").repartition(7)
    found = connected_components(table).collect()
    wanted = brute([(a, b) for a, b in links if a != b])
    assert len(found) == len(wanted) and {r.node: r.component for r in found} == wanted


def test_short_tables_take_few_tasks(spark, monkeypatch):
    """However many partitions a shuffle has, a short table is written by as many tasks as there are cores."""
    tasks = {}
    write = components.materialise

    def counted(df, label):
        tasks.setdefault(label, []).append(df.rdd.getNumPartitions())
        return write(df, label)

    monkeypatch.setattr(components, "materialise", counted)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 61)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
        found = connected_components(spark.createDataFrame(CHAIN, "a long, b long")).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert {r.node: r.component for r in found} == brute(CHAIN)
    assert max(tasks["cc-links"]) <= spark.sparkContext.defaultParallelism
