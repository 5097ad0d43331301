"""The cases that every operator defines: nulls, empty and long texts, repeated rows, empty tables, further columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from supplyloom.llm import catalog, chat, extract, fingerprint, jaccard, latent, mixing, quality, secrets, tokens, urls
from supplyloom.storage import scratch_path

LONG = "long words of one text " * 20_000
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta", "en", "a", 10),
    (1, "alpha beta gamma delta epsilon zeta", "en", "a", 10),
    (2, None, "en", "b", 0),
    (3, "", None, None, 0),
    (None, "no id here at all my friend", "en", "a", 5),
    (4, LONG, "en", "a", len(LONG)),
    (5, "alpha beta gamma delta epsilon zeta", "en", "b", 10),
    (6, " \n\t ", "en", "b", 4),
]
DOCS = "doc_id long, text string, lang string, source string, n_chars int"
#: Names the operators use for columns of their own.
CLASHES = ["size", "rep", "n", "token", "bucket", "copies", "position", "score", "label", "draw", "row", "next", "host"]


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in CLASHES if c not in df.columns})


@pytest.fixture(scope="module")
def docs(spark):
    return clashing(spark.createDataFrame(ROWS, DOCS))


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def by_id(rows, key="doc_id"):
    found = {}
    for r in rows:
        found.setdefault(r[key], []).append(r)
    return found


def test_tokens(spark, docs, none):
    folder = scratch_path(spark, "t")
    tokens.write_tokens(docs, folder, catalog.tokenizer_file)
    rows = by_id(tokens.read_tokens(spark, folder).collect())
    assert sum(map(len, rows.values())) == len(ROWS)
    assert [r.n_tokens for r in rows[2] + rows[3]] == [1, 1] and rows[2][0].ids == [0]
    assert rows[1][0].ids == rows[1][1].ids == rows[5][0].ids
    assert {r.doc_id for r in tokens.read_tokens(spark, folder, wanted=[3, 5, 99]).collect()} == {3, 5}
    folder = scratch_path(spark, "t")
    tokens.write_tokens(none, folder, catalog.tokenizer_file)
    assert tokens.read_tokens(spark, folder).count() == 0 and tokens.index_of(spark, folder).count() == 0


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, None), (2, "no scheme"), (3, "HTTPS://WWW.Example.COM/en/x?q#f"), (3, "http://a.com"), (None, "http://b.net/es/")],
        "page_id long, url string",
    )
    labels = spark.createDataFrame([(1, None), (3, True), (None, False), (77, True)], "page_id long, blocked boolean")
    for given in (labels, labels.limit(0)):
        rows = by_id(urls.judge(clashing(pages.withColumn("items", F.lit("clash"))), given).collect(), "page_id")
        assert (rows[1][0].host, rows[1][0].path, rows[1][0].rule, rows[1][0].verdict) == ("", "", None, "allow")
        assert rows[2][0].host == "" and rows[None][0].verdict == "block" and rows[None][0].rule == "net/es/"
        assert {(r.host, r.path, r.rule) for r in rows[3]} == {("www.example.com", "/en/x", "www.example.com/en/"), ("a.com", "", None)}
    assert urls.judge(pages.limit(0), labels).count() == 0


def test_jaccard(spark, docs, none):
    rows = by_id(jaccard.similarity_components(docs).collect())
    assert sum(map(len, rows.values())) == len(ROWS)
    assert [tuple(r)[1:] for r in rows[1]] == [(2, 1), (2, 1)] and tuple(rows[5][0]) == (5, 2, 1)
    assert tuple(rows[2][0]) == (2, 0, 2) and tuple(rows[6][0]) == (6, 0, 6)
    assert rows[None][0].component_id is None and rows[None][0].n_shingles == 3 and rows[4][0].n_shingles == 5
    assert jaccard.similarity_components(none).count() == 0


def test_secrets(spark, docs, none):
    rows = by_id(secrets.scan(docs).collect())
    assert sum(map(len, rows.values())) == len(ROWS) and not any(r.spans for rs in rows.values() for r in rs)
    assert secrets.scan(none).count() == 0


def test_extract(spark):
    pages = spark.createDataFrame(
        [(1, None, None), (2, "", ""), (2, "", ""), (3, "http://x.com/", "<p>a<p>b &amp; c<foot"), (None, "u", "<article>x" + LONG + "</article>")],
        "page_id long, url string, html string",
    )
    rows = by_id(extract.extract(clashing(pages.withColumn("removed", F.lit(1)))).collect(), "page_id")
    assert [r.text for r in rows[1] + rows[2] + rows[3]] == ["", "", "", "a\nb & c"]
    assert rows[None][0].text == "x" + LONG.strip()
    assert extract.extract(pages.limit(0)).count() == 0


def test_chat(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", None), (1, None, None, "first"), (1, 0, "assistant", "same turn"), (1, 0, "assistant", "same turn"),
         (None, 0, "a\nb\\", "x"), (2, 0, "assistant", LONG)],
        "conv_id long, turn long, role string, text string",
    )
    rows = by_id(chat.digest_conversations(chat.format_conversations(clashing(turns))).collect(), "conv_id")
    assert rows[1][0].n_turns == 4 and rows[1][0].loss_chars == 18 and rows[2][0].loss_chars == len(LONG)
    assert rows[None][0].n_turns == 1
    assert chat.digest_conversations(chat.format_conversations(turns.limit(0))).count() == 0


def test_mixing(spark, docs, none):
    rows = by_id(mixing.mix(docs).collect())
    assert sum(map(len, rows.values())) == len(ROWS)
    assert rows[2][0].size == rows[3][0].taken == rows[6][0].taken == 0 and rows[3][0].source_size == 0
    assert all(r.taken <= 2 * r.size for rs in rows.values() for r in rs)
    assert mixing.training_order(mixing.mix(docs)).where("position is null or position < 0 or position > 1").count() == 0
    assert mixing.mix(none).count() == 0


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (5, None), (None, 0), (99, 0)], "doc_id long, quality int")
    model = quality.fit_quality(docs, labels)
    assert model == 1.0 and quality.fit_quality(docs, labels.limit(0)) == 0.5
    network = quality.ByteNetwork()
    rows = quality.score_quality(docs, network).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    assert quality.keep_good(docs, 1.0).columns == docs.columns and quality.keep_good(docs, 0.0).count() == 0
    assert quality.score_quality(none, network).count() == 0


def test_fingerprint(spark, docs, none):
    rows = by_id(fingerprint.compare_edits(docs).collect())
    assert sum(map(len, rows.values())) == len(ROWS)
    assert rows[1][0].fingerprint == rows[5][0].fingerprint and rows[2][0].fingerprint == rows[3][0].fingerprint
    assert rows[2][0].n_chars == 0 and rows[3][0].near_next == 1.0  # the next of 3 is 2: both empty
    assert fingerprint.compare_edits(none).count() == 0


def test_latent(spark, docs, none):
    benchmark = spark.createDataFrame(
        [(1, "alpha beta gamma delta epsilon zeta"), (2, None), (3, ""), (4, "no id here at all my friend"), (5, "...")],
        "item_id long, text string",
    )
    rows = {(r.doc_id, r.item_id) for r in latent.find_leaks(docs, benchmark).collect()}
    assert rows == {(1, 1), (5, 1)}
    assert latent.find_leaks(none, benchmark).count() == 0 and latent.find_leaks(docs, benchmark.limit(0)).count() == 0


def test_pipeline(spark, docs, none, sf):
    for given in (docs, none):
        kept = given
        for name, stage in corpus_pipeline.STAGES:
            kept = stage(spark, kept, sf)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert kept.columns == given.columns
        kept.count()


def test_pipeline_keeps_one_of_a_group(spark, docs, sf):
    kept = [r.doc_id for r in corpus_pipeline.jaccard_join(spark, docs, sf).collect()]
    assert sorted(kept, key=str) == [1, 2, 3, 4, 6, None]
