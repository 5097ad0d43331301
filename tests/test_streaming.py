import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyloom.sources import landing, tables
from supplyloom.sources.schemas import BRONZE, CORRUPT
from supplyloom.storage import materialise
from supplyloom.operators.metrics import read_metrics
from supplyloom.streaming import ingest
from supplyloom.streaming.monitor import BatchMetrics


def _land(folder, name, rows, extra=""):
    os.makedirs(folder, exist_ok=True)
    tmp = os.path.join(os.path.dirname(folder), f".{name}")
    with open(tmp, "w", encoding="utf-8") as f:
        f.write("\n".join(json.dumps(r) for r in rows) + ("\n" + extra if extra else "") + "\n")
    os.rename(tmp, os.path.join(folder, name))


def _row(i, p, **more):
    return {"Purchaser": f"A{i} LLC", "Seller": f"B{i} Ltd.", "src_id": i, "dst_id": i + 1, "probability": p, **more}


def test_bronze_and_silver(spark, tmp_path):
    land, bronze, silver = (str(tmp_path / n) for n in ("landing", "bronze", "silver"))
    c1, c2 = str(tmp_path / "c1"), str(tmp_path / "c2")
    wide = T.StructType([*BRONZE.fields, T.StructField("source", T.StringType())])

    def run(schema):
        ingest.ingest_bronze(spark, land, bronze, c1, schema, files_per_trigger=1)
        ingest.refine_silver(spark, bronze, silver, c2, schema)
        return [tables.read_path(spark, p, merge_schema=True).count() for p in (bronze, silver)]

    _land(land, "a.json", [_row(i, 0.5 + i / 20) for i in range(10)])
    assert run(BRONZE) == [10, 9]
    assert run(BRONZE) == [10, 9]
    _land(land, "b.json", [_row(10, 0.55), _row(11, None)])
    assert run(BRONZE) == [12, 10]
    _land(land, "c.json", [_row(12, 0.9, source="web")], extra='{"Purchaser": "broken')
    assert run(wide) == [14, 11]
    assert run(wide) == [14, 11]
    back = tables.read_path(spark, bronze, merge_schema=True)
    assert "source" in back.columns and back.filter(F.col("source") == "web").count() == 1
    assert back.filter(F.col(CORRUPT).isNotNull()).count() == 1
    clean = tables.read_path(spark, silver, merge_schema=True)
    assert CORRUPT not in clean.columns
    assert {r.Seller for r in clean.collect()} == {f"B{i}" for i in range(1, 11)} | {"B12"}


def test_score_arrivals(spark, tmp_path):
    silver, out, ck = (str(tmp_path / n) for n in ("silver", "scored", "ck"))
    companies = materialise(
        spark.createDataFrame([(1, 2.0, 0.0), (2, 0.0, 1.0)], "id long, as_buyer double, as_seller double"), "companies"
    )

    def add(rows):
        spark.createDataFrame(rows, BRONZE).coalesce(1).write.mode("append").parquet(silver)
        ingest.score_arrivals(spark, silver, companies, 0.0, out, ck)
        return {(r.src_id, r.dst_id): r for r in tables.read_path(spark, out).collect()}

    rows = add([("A", "B", 1, 2, 0.6), ("A", "C", 1, 3, 0.7)])
    assert rows[(1, 2)].refined_probability == pytest.approx(0.9525741268)
    assert rows[(1, 3)].gnn_prediction is None and rows[(1, 3)].refined_probability == 0.7
    assert len(add([("B", "B", 2, 2, 0.99)])) == 3
    ingest.score_arrivals(spark, silver, companies, 0.0, out, ck)
    assert tables.read_path(spark, out).count() == 3


def test_schema_is_inferred_once_and_widened(spark, tmp_path):
    land, where = str(tmp_path / "l"), str(tmp_path / "s")
    _land(land, "a.json", [_row(1, 0.5)])
    first = landing.landing_schema(spark, land, where)
    assert {f.name: f.dataType.simpleString() for f in first.fields}["probability"] == "double"
    assert landing.landing_schema(spark, land, where) == first
    os.utime(os.path.join(land, "a.json"), (1, 1))
    _land(land, "b.json", [_row(2, 0.5, tier=3)])
    os.utime(os.path.join(land, "b.json"))
    again = landing.landing_schema(spark, land, where)
    assert again.fieldNames() == [*first.fieldNames(), "tier"]
    assert landing.landing_schema(spark, land, where, evolve=False) == again
    ingest.ingest_bronze(spark, land, str(tmp_path / "b"), str(tmp_path / "c"), schema_location=where)
    rows = ingest.read_typed(spark, str(tmp_path / "b"), where).orderBy("src_id").collect()
    assert [(r.src_id, r.tier, r.probability) for r in rows] == [(1, None, 0.5), (2, 3, 0.5)]


def test_types_widen_and_no_record_is_lost(spark, tmp_path):
    land, bronze, silver, where = (str(tmp_path / n) for n in ("l", "b", "s", "schema"))

    def run():
        ingest.ingest_bronze(spark, land, bronze, str(tmp_path / "c1"), schema_location=where)
        ingest.refine_silver(spark, bronze, silver, str(tmp_path / "c2"), schema_location=where)

    _land(land, "a.json", [_row(1, 1, rank=1), _row(2, "0.95", rank=2)])
    run()
    # a file written long ago and renamed into the folder only now
    _land(land, "b.json", [_row(3, 0.7, rank=2.5, tags={"a": [1]})])
    os.utime(os.path.join(land, "b.json"), (1, 1))
    _land(land, "c.json", [_row(4, "high", rank="x")], extra='{"Purchaser": "broken')
    run()
    assert ingest.read_typed(spark, bronze, where).count() == 5
    rows = {r.src_id: r for r in ingest.read_typed(spark, silver, where).collect()}
    assert {i: r.probability for i, r in rows.items()} == {1: 1.0, 2: 0.95, 3: 0.7}
    assert [rows[i]["rank"] for i in (1, 2, 3)] == ["1", "2", "2.5"] and rows[3].tags.a == [1]
    kinds = {f.name: f.dataType.simpleString() for f in landing.landing_schema(spark, land, where, evolve=False).fields}
    assert kinds["probability"] == "string" and kinds["rank"] == "string"
    assert landing.widen(T.LongType(), T.DoubleType()) == T.DoubleType()


def test_tables(spark, tmp_path):
    tables.use_database(spark, "loom_test", location=str(tmp_path / "wh"))
    folder = tmp_path / "csv"
    folder.mkdir()
    for name in tables.DIMENSION_TABLES:
        (folder / f"{name}.csv").write_text("country,risk_premium\nA,1.5\nB,2\n")
    try:
        for _ in range(2):
            tables.load_dimension_tables(spark, str(folder))
        df = tables.read_table(spark, "company_risk_data")
        assert dict(df.dtypes) == {"country": "string", "risk_premium": "double"} and df.count() == 2
        assert tables.preview(df, 1).count() == 1
        for n in (1, 2):
            spark.createDataFrame([(f"A{n} LLC", "B Inc", 1, 2, 0.6)], BRONZE).write.mode("append").saveAsTable("bronze")
            ingest.refine_silver_table(spark, "bronze", "silver", str(tmp_path / "ck"))
            silver = tables.read_table(spark, "silver")
            assert sorted(r.Purchaser for r in silver.collect()) == ["A1", "A2"][:n]
    finally:
        spark.sql("drop database loom_test cascade")
        tables.use_database(spark, "default", create=False)


def test_batches_are_counted(spark, tmp_path):
    """Two files as two batches, then nothing new; counts replayed in a second log entry count once."""
    land, bronze, silver, log = (str(tmp_path / n) for n in ("landing", "bronze", "silver", "log"))
    _land(land, "a.json", [_row(i, 0.5 + i / 20) for i in range(4)], extra="{broken")
    _land(land, "b.json", [_row(9, 0.9)])
    watch = BatchMetrics("run")
    for _ in range(2):
        ingest.ingest_bronze(spark, land, bronze, str(tmp_path / "c1"), files_per_trigger=1, watch=watch)
        ingest.refine_silver(spark, bronze, silver, str(tmp_path / "c2"), watch=watch)
        watch.flush(spark, log)
    rows = {(r.split, r.step, r.name): r.value for r in read_metrics(spark, log).collect()}
    assert sorted(rows[("bronze", step, "rows_read")] for step in (0, 1)) == [1, 5]
    assert sorted(rows[("bronze", step, "rows_corrupt")] for step in (0, 1)) == [0, 1]
    assert sum(v for (split, _, _), v in rows.items() if split == "silver") == 4 and len(rows) == 5
