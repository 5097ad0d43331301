"""The training-data pipeline: filter by quality, de-duplicate, decontaminate, mix by source, write token files.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; all but the last return the
columns of ``documents``. ``run`` writes each stage's result as Parquet and reads it again for the next one.

Defined cases: what the operators state for nulls, empty texts, ties and repeated rows holds. Rows without a doc_id
are never duplicates or leaks of another and stay through those stages; of rows that repeat a doc_id one stays in
de-duplication; an empty table passes through as empty; further columns are carried along, whatever their names.
"""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyloom.llm import jaccard, latent, mixing, quality, tokens
from supplyloom.llm.catalog import table, tokenizer_file
from supplyloom.llm.memory import release_executors
from supplyloom.storage import materialise, rows_of, scratch_path

#: Ids that may go to every task at once (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def released(spark: SparkSession) -> SparkSession:
    """The session, after the driver and the executors gave up what the stage before held.

    Plans and broadcasts live in the JVM as long as Python has handles to them; collected, the heap shrinks again.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    release_executors(spark)
    return spark


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, quality.fit_quality(docs, table(released(spark), sf_dir, "labels")))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    released(spark)
    groups = jaccard.similarity_components(docs)
    kept = without(docs, groups.where("doc_id <> component_id").select("doc_id"))
    repeated = kept.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    repeated = materialise(repeated, "repeated-ids")
    if not rows_of(repeated):
        return kept
    # The row of the least text, then of the least of its other columns, whatever the order of the rows.
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    whole = F.struct("text", *rest)
    once = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(whole).alias("_row"))
    once = once.select("doc_id", "_row.*").select(*docs.columns)
    return without(kept, repeated).unionByName(once)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without(docs, latent.find_leaks(docs, table(released(spark), sf_dir, "benchmark")).select("doc_id"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks, in the order of their training positions."""
    released(spark)
    rows = docs.select("doc_id", "source", "text", F.struct("*").alias("row"))
    return mixing.training_order(mixing.mix(rows, keep=("row",))).select("row.*")


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the corpus; what is read back from them, per document."""
    folder = scratch_path(released(spark), "corpus-tokens")
    tokens.write_tokens(docs, folder, tokenizer_file)
    return tokens.read_tokens(spark, folder, with_ids=False)


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` but for those ids; a row without an id stays."""
    dropped = materialise(ids.where("doc_id IS NOT NULL").distinct(), "dropped-ids")
    small = rows_of(dropped) <= BROADCAST_IDS
    return docs.join(F.broadcast(dropped) if small else dropped, "doc_id", "left_anti").select(*docs.columns)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("jaccard_join", jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("token_output", token_output),
]

#: A trained classifier, similarity components and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
