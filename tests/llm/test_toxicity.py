"""The toxicity network against plain loops, finite differences and held-out labels, and the cases it defines."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from supplyloom.llm import catalog, toxicity

RUDE = ["blurgh", "snirt", "vexel"]


def small_network(seed=1):
    network = toxicity.WordNetwork(seed)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    network.seen = network.seen.astype(np.float64)
    return network


def words_of(texts):
    parts = [(w, s) for _, w, s in toxicity.word_buckets(pa.array(texts, pa.string()))]
    return toxicity.joined([w[a:b] for w, s in parts for a, b in zip(s[:-1], s[1:])])


def plain_logit(network, words):
    """One word, one filter, one place at a time."""
    w = network.weights
    rows = [list(r) for r in words] or [[toxicity.PAD] * toxicity.PARTS]
    vectors = [[sum(float(w["embed"][b][e]) for b in row) for e in range(toxicity.EMBED)] for row in rows]
    total = float(w["shift"][0])
    for f in range(toxicity.ALL):
        width = toxicity.WIDTHS[f // toxicity.FILTERS]
        best = -math.inf
        for at in range(len(vectors)):
            value = float(w["bias"][f])
            for s in range(width):
                if at + s < len(vectors):
                    value += sum(vectors[at + s][e] * float(w["filters"][s][e][f]) for e in range(toxicity.EMBED))
            best = max(best, value)
        total += math.tanh(best) * float(w["dense"][f])
    return total


TEXTS = ["one two three four", "", "Word", None, "the quick, brown fox; the lazy dog!", "é è ñandú " * 30]


@pytest.mark.parametrize("step", [1 << 16, 7])
def test_forward_like_plain_loops(monkeypatch, step):
    monkeypatch.setattr(toxicity, "STEP", step)
    network = small_network()
    words, starts = words_of(TEXTS)
    assert len(starts) == len(TEXTS) + 1
    wanted = [plain_logit(network, words[a:b]) for a, b in zip(starts[:-1], starts[1:])]
    assert network.logits(words, starts) == pytest.approx(wanted, abs=1e-5)


def test_gradient_like_finite_differences():
    network = small_network()
    words, starts = words_of([t for t in TEXTS if t])
    wanted = np.array([0.0, 1.0, 0.0, 1.0])

    def loss():
        z = np.array([plain_logit(network, words[a:b]) for a, b in zip(starts[:-1], starts[1:])])
        return float(np.mean(np.logaddexp(0, z) - wanted * z))

    found, touched = network.gradient(words, starts, wanted)
    draw = random.Random(2)
    for name, g in found.items():
        for _ in range(6):
            at = tuple(draw.randrange(n) for n in g.shape)
            own = (touched[at[0]], *at[1:]) if name == "embed" else at
            if name == "embed" and own[0] == toxicity.PAD or name == "filters" and not network.seen[at[0], 0, at[2]]:
                assert g[at] == 0
                continue
            value = network.weights[name][own]
            network.weights[name][own] = value + 1e-6
            high = loss()
            network.weights[name][own] = value - 1e-6
            low = loss()
            network.weights[name][own] = value
            assert g[at] == pytest.approx((high - low) / 2e-6, abs=1e-4)


def test_long_texts_in_pieces(monkeypatch):
    text = "some words of a long text, and Others " * 400 + "x" * 3000 + " end"
    whole, _ = words_of([text])
    monkeypatch.setattr(toxicity, "SLICE_BYTES", 100)
    assert np.array_equal(words_of([text])[0], whole)


def test_languages():
    told = ["the cat of the house", "der Hund und die Katze", "le chat et la maison", "el gato y los perros", "zzz qqq", ""]
    assert list(toxicity.languages(*words_of(told))) == [0, 1, 2, 3, 4, 4]


def test_thresholds_by_language():
    """Two languages whose logits are shifted against each other; a third with one text leans on them."""
    z = np.concatenate([np.linspace(-3, -1, 100), np.linspace(0, 2, 100), np.linspace(4, 6, 100), np.linspace(7, 9, 100), [50.0]])
    y = np.concatenate([np.zeros(100), np.ones(100), np.zeros(100), np.ones(100), [1]])
    language = np.repeat([0, 1, 2], [200, 200, 1])
    cuts = toxicity.thresholds(z, y, language)
    assert -1 <= cuts[0] <= 0 and 6 <= cuts[1] <= 7 and -1 <= cuts[2] <= 7


def made_rows(n=1500):
    draw, docs, labels = random.Random(3), [], []
    for i in range(n):
        words = ["the", "of"] + [f"w{draw.randrange(4000)}" for _ in range(draw.randint(5, 60))]
        rude = draw.random() < 0.3
        if rude:
            words.insert(draw.randrange(len(words)), draw.choice(RUDE) + draw.choice(["", "s", "ing"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(rude)))
    return docs, labels


def test_held_out_texts(spark):
    docs, labels = made_rows()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    judge = toxicity.fit_toxicity(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(d, judge).collect()}
    held = [(scores[i] >= toxicity.CUT, y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([a == bool(b) for a, b in held]) > 0.97
    again = toxicity.fit_toxicity(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert all(np.array_equal(judge.network.weights[k], again.network.weights[k]) for k in judge.network.weights)


def test_held_out_labels_are_not_read(spark):
    """Turning the labels of held-out rows round changes nothing."""
    docs, labels = made_rows(200)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    a, b = (toxicity.fit_toxicity(d, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned))
    assert all(np.array_equal(a.network.weights[k], b.network.weights[k]) for k in a.network.weights)


def test_cases(spark):
    docs = [(1, None), (7, ""), (None, "no id"), (3, "word " * 300_000), (8, "twice"), (8, "twice"), (0, "\n\t ")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("words", "wanted", "score", "labelled_id")})
    none = spark.createDataFrame([], "doc_id long, toxic int")
    flat = toxicity.fit_toxicity(d, none)
    assert [r.score for r in toxicity.score_toxicity(d, flat).collect()] == [0.5] * len(docs)
    one = spark.createDataFrame([(i, 1) for i in range(9)] + [(7, None), (None, 0)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_toxicity(d, toxicity.fit_toxicity(d, one)).collect()} == {1.0}
    judge = toxicity.Judge(toxicity.WordNetwork(), np.zeros(toxicity.LANGUAGES))
    scores = toxicity.score_toxicity(d, judge).collect()
    assert len(scores) == len(docs) and all(0 <= r.score <= 1 for r in scores)
    assert len({r.score for r in scores if r.doc_id in (1, 7, 0)}) == 1
    assert len({r.score for r in scores if r.doc_id == 8}) == 1
    assert toxicity.score_toxicity(d.limit(0), judge).count() == 0
    assert set(catalog.queries()) >= {"op11_prefix_trie", "op12_structure_repair", "op13_toxicity"}


def test_thresholds_of_a_table_like_those_of_a_task(spark):
    """All rows count, over several partitions, whatever their number."""
    draw = np.random.default_rng(1)
    z, y, language = draw.normal(size=400), draw.integers(0, 2, 400), draw.integers(0, 5, 400)
    z += 0.7 * y * (language != 3)
    rows = [(float(a), int(b), int(c)) for a, b, c in zip(z, y, language)]
    scored = spark.createDataFrame(rows, "z double, wanted int, language int").repartition(5)
    assert np.allclose(toxicity.table_thresholds(scored), toxicity.thresholds(z, y, language))


def test_every_labelled_row_teaches(spark, monkeypatch):
    """With more rows than a task fits, rounds over all rows learn a word that rows beyond the first few alone hold."""
    import zlib

    monkeypatch.setattr(toxicity, "FIT_ROWS", 50)
    ids = [i for i in range(1, 1500) if zlib.crc32(str(i).encode()) % 3 != 1]
    texts = [f"word{i % 7} {'vile' if i % 4 == 0 else 'kind'} the end{i % 5}" for i in ids]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(2)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in ids], "doc_id long, toxic int")
    assert toxicity._examples(docs, labels, "toxic").count() == len(ids)
    rounds, run = [], toxicity._one_round
    monkeypatch.setattr(toxicity, "_one_round", lambda rows, *a: rounds.append(rows.count()) or run(rows, *a))
    judge = toxicity.fit_toxicity(docs, labels)
    assert rounds[: toxicity.ROUNDS] == [len(ids)] * toxicity.ROUNDS
    scores = judge.scores(pa.array(["word1 vile the end2", "word1 kind the end2"]))
    assert scores[0] >= toxicity.CUT > scores[1]
