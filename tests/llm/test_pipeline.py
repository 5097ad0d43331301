"""The pipeline, stage by stage, against plain Python over what the stage before kept."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from supplyloom.llm import catalog, quality, tokens
from test_jaccard import brute

STAGES = dict(corpus_pipeline.STAGES)


def brute_mix(rows):
    """Copies of each document: targets by repeated sharing, whole documents in the order of a digest of their ids."""
    sizes = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows}
    sources = sorted({r.source for r in rows})
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    size = {s: sum(sizes[r.doc_id] for r in rows if r.source == s) for s in sources}
    target, left, free = {}, 1.5 * sum(size.values()), set(sources)
    while free:
        part = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if part[s] > 2 * size[s]}
        target |= {s: 2.0 * size[s] for s in full} if full else part
        left -= sum(2.0 * size[s] for s in full)
        free = free - full if full else set()
    copies = {}
    for s in sources:
        tape = 0
        for r in sorted((r for r in rows if r.source == s), key=lambda r: hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15]):
            n, middle = sizes[r.doc_id], tape + sizes[r.doc_id] / 2
            copies[r.doc_id] = max(1, math.ceil((target[s] - middle) / size[s])) if n and middle < target[s] else 0
            tape += n
    return copies


def test_stages_like_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "jaccard_join", "benchmark_decontamination", "source_mix", "token_output"]

    model = quality.fit_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = docs.collect()
    good = [r for r in rows if model.scores(np.frombuffer(r.text.encode(), np.uint8), np.array([0, len(r.text.encode())]))[0] >= 0.5]
    kept = STAGES["quality_classifier"](spark, docs, sf)
    assert sorted(kept.collect()) == sorted(good) and 0 < len(good) < len(rows)

    given = spark.createDataFrame(good, docs.schema)
    groups = brute([(r.doc_id, r.text) for r in good])
    first = [r for r in good if groups[r.doc_id][1] == r.doc_id]
    assert sorted(STAGES["jaccard_join"](spark, given, sf).collect()) == sorted(first) and len(first) < len(good)

    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = [r for r in first if not any(i in r.text for i in items)]
    given = spark.createDataFrame(first, docs.schema)
    assert sorted(STAGES["benchmark_decontamination"](spark, given, sf).collect()) == sorted(clean) and len(clean) < len(first)

    given = spark.createDataFrame(clean, docs.schema)
    mixed = STAGES["source_mix"](spark, given, sf).collect()
    wanted = brute_mix(clean)
    assert Counter(r.doc_id for r in mixed) == Counter(wanted) - Counter()
    assert {r.doc_id: r for r in mixed} == {r.doc_id: r for r in clean if wanted[r.doc_id]}

    out = STAGES["token_output"](spark, spark.createDataFrame(mixed, docs.schema), sf).orderBy("start").collect()
    encoder, start = tokens.Encoder(catalog.tokenizer_file()).whole, 0
    for row, doc in zip(out, sorted(mixed, key=lambda r: r.doc_id), strict=True):
        ids = np.array(encoder.encode(doc.text, add_special_tokens=False).ids + [0], dtype="<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc.doc_id, start, len(ids), zlib.crc32(ids))
        start += len(ids)
