"""What executors hold between the stages of the pipeline, and what travels to them."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle

import corpus_pipeline
from supplyloom.llm import catalog, latent, tokens, words
from supplyloom.llm.memory import forget, release_executors
from supplyloom.storage import scratch_path


def held(spark):
    """For each of many tasks: encoders and powers that its worker remembers."""
    encoder_of, powers = tokens.encoder_of, tokens._powers

    def run(batches):
        for batch in batches:
            n = encoder_of.cache_info().currsize + powers.cache_info().currsize
            yield pa.RecordBatch.from_arrays([pa.array([n] * batch.num_rows, pa.int64())], names=["n"])

    return [r.n for r in spark.range(0, 32, 1, 32).mapInArrow(run, "n long").collect()]


def full_collections(spark):
    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(b.getCollectionCount() for b in beans)


def test_stages_start_without_what_the_one_before_remembered(spark):
    docs = spark.createDataFrame([(i, f"some words of text {i}") for i in range(64)], "doc_id long, text string").repartition(16)
    folder = scratch_path(spark, "remembered")
    tokens.write_tokens(docs, folder, catalog.tokenizer_file)
    before = sorted(r.ids_crc32 for r in tokens.read_tokens(spark, folder).collect())
    assert max(held(spark)) > 0
    assert corpus_pipeline.released(spark) is spark
    assert max(held(spark)) == 0
    # Forgetting costs time only.
    folder = scratch_path(spark, "again")
    tokens.write_tokens(docs, folder, catalog.tokenizer_file)
    assert sorted(r.ids_crc32 for r in tokens.read_tokens(spark, folder).collect()) == before


def test_executors_collect_their_garbage(spark):
    count = full_collections(spark)
    release_executors(spark)
    assert full_collections(spark) > count


def test_forget_passes_batches_on():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2])], names=["id"])
    tokens._powers(3, 4)
    assert tokens._powers.cache_info().currsize and list(forget(iter([batch]))) == [batch]
    assert not tokens._powers.cache_info().currsize


@pytest.mark.parametrize("function", [words.hashed_words, latent.lower_words])
def test_powers_stay_behind(function):
    """What hashes words travels without the powers (two times 8 MB) that this process made, and makes its own."""
    column = pa.array(["Some words of a text", None, "", "more"])
    found = function(column)
    assert words._powers
    sent = cloudpickle.dumps(function)
    assert len(sent) < 100_000
    again = cloudpickle.loads(sent)(column)
    assert all(np.array_equal(a, b) for a, b in zip(found, again, strict=True))
