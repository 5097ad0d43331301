"""The join against brute force, with the bounds small enough that every path is taken."""

import random
import re

import numpy as np
import pytest

from supplyloom.llm import jaccard
from supplyloom.llm.words import hashed_words

WORDS = [f"w{i}" for i in range(4000)]


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if len(words) >= n else frozenset([tuple(words)])


def brute(rows):
    ids = [i for i, _ in rows]
    sets = [shingles(t) for _, t in rows]
    label = {i: i for i in ids}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(ids[i]), root(ids[j])
                label[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in zip(ids, sets)}


def corpus(seed):
    """Near copies of a few texts, a line and a passage that many share, short and very long texts, exact copies."""
    draw = random.Random(seed)
    text = lambda k: [draw.choice(WORDS) for _ in range(k)]
    line, passage = text(9), text(60)
    rows = []
    for _ in range(25):
        rows.append(line + text(draw.randrange(3, 120)))
        rows.append(text(draw.randrange(1, 9)))
        body = text(draw.randrange(5, 80))
        rows.append(body[:3] + passage + body[3:])
    for size in (12, 90, 400):
        first = line + text(size)
        for _ in range(18):
            near = list(first)
            for _ in range(draw.randrange(0, max(2, size // 25))):
                near[draw.randrange(len(near))] = draw.choice(WORDS)
            rows.append(near[: len(near) - draw.randrange(0, 4)])
    rows += [rows[3], rows[30], [w.upper() for w in rows[30]], [], text(9000)]
    rows.append(rows[-1] + text(40))
    draw.shuffle(rows)
    return [(draw.randrange(10**9) if i % 2 else i, " ".join(r)) for i, r in enumerate(rows)] + [(10**10, None)]


@pytest.mark.parametrize("hot, chunk, single, listed", [(64, 2048, 12, 10**6), (3, 7, 2, 10**6), (2, 4, 3, 5)])
def test_components_like_brute_force(spark, monkeypatch, hot, chunk, single, listed):
    for name, value in {"HOT": hot, "CHUNK": chunk, "SINGLE": single, "HOT_LIST": listed}.items():
        monkeypatch.setattr(jaccard, name, value)
    if listed == 5:
        monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    rows = corpus(hot)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similarity_components(docs).collect()}
    assert found == brute(rows)


def test_tree_finds_every_link():
    draw = np.random.default_rng(3)
    base = [np.unique(draw.integers(0, 1 << 63, k, dtype=np.uint64)) for k in (6, 40, 41, 300)]
    sets = []
    for b in base:
        for _ in range(20):
            kept = b[draw.random(len(b)) < draw.choice([0.8, 0.9, 1.0])]
            sets.append(np.unique(np.append(kept, draw.integers(0, 1 << 63, draw.integers(1, 9), dtype=np.uint64))))
    sizes = np.array([len(s) for s in sets])
    pairs = list(jaccard.tree_pairs(sizes, [jaccard.bitmap(s) for s in sets], 75, np.arange(len(sets))))
    found = {(min(p), max(p)) for p in pairs}
    linked = 0
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 75 * (sizes[i] + sizes[j] - both):
                linked += 1
                assert (i, j) in found
    assert linked > 100 and len(found) < len(sets) * (len(sets) - 1) // 2


def test_words_hash_alike_wherever_they_stand():
    import pyarrow as pa

    words, first = hashed_words(pa.array(["One two", None, "", " two\tONE  one", "é É"]))
    assert first.tolist() == [0, 2, 2, 2, 5, 7]
    one, two = words[:2]
    assert words[2] == two and words[4] == one and words[3] != one and words[5] != words[6]
