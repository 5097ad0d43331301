"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are embedded, and learned filters run over overlapping chunks of ``WIDTH`` bytes, ``STRIDE``
apart, that cover the whole text (its end is padded with zero bytes). Each filter's responses are max-pooled over all
chunks of the text, and a dense layer combines them into one probability.

The network is fitted in one task, on a bounded sample: ``FIT_ROWS`` labelled rows at most, by hash of the id, of
texts of at most ``FIT_BYTES`` bytes. Scoring runs over every row, in slices of bounded memory, and reads whole texts;
a text longer than a slice is taken piece by piece, which max-pooling allows.

Defined cases: a null or empty text is one chunk of padding and gets a score like any other; null labels and labels of
unknown documents are passed over, of clashing labels of one id the greater counts; without labels, or with one label only, the score is the same for all texts, the
share of label 1 (0.5 without labels); repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from supplyloom.llm.batches import bounded_batches
from supplyloom.llm.fitting import fit_in_task
from supplyloom.llm.words import slices, text_bytes

WIDTH, STRIDE, EMBED, FILTERS = 16, 8, 6, 24
FIT_ROWS, FIT_BYTES, EPOCHS, BATCH, RATE = 3000, 1 << 15, 14, 48, 0.02
#: Chunks scored at once.
STEP = 1 << 15


class ByteNetwork:
    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.weights = {
            "embed": draw.normal(0, 0.5, (257, EMBED)).astype(np.float32),  # byte 256 is padding
            "filters": draw.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH * EMBED, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, dtype=np.float32),
            "dense": draw.normal(0, 0.1, FILTERS).astype(np.float32),
            "shift": np.zeros(1, dtype=np.float32),
        }

    # --- chunks

    @staticmethod
    def chunks(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Padded bytes, start of every chunk, and each text's first chunk."""
        sizes = np.diff(at)
        counts = np.maximum(1, -(-np.maximum(sizes - WIDTH, 0) // STRIDE) + 1)
        room = (counts - 1) * STRIDE + WIDTH
        begins = np.cumsum(room) - room
        padded = np.full(int(room.sum()), 256, dtype=np.int16)
        within = np.arange(len(data)) - np.repeat(at[:-1], sizes)
        padded[np.repeat(begins, sizes) + within] = data
        first = np.cumsum(counts) - counts
        starts = np.repeat(begins - first * STRIDE, counts) + np.arange(int(counts.sum())) * STRIDE
        return padded, starts, first

    def responses(self, padded: np.ndarray, starts: np.ndarray) -> np.ndarray:
        embedded = self.weights["embed"][padded]
        windows = np.lib.stride_tricks.sliding_window_view(embedded.ravel(), WIDTH * EMBED)[:: EMBED]
        return windows[starts] @ self.weights["filters"] + self.weights["bias"]

    def pooled(self, padded: np.ndarray, starts: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Max of each filter over each text's chunks, STEP chunks at a time."""
        ends = np.append(first[1:], len(starts))
        best = np.full((len(first), FILTERS), -np.inf, dtype=np.float32)
        for a in range(0, len(starts), STEP):
            b = min(a + STEP, len(starts))
            lo, hi = starts[a], starts[b - 1] + WIDTH
            found = self.responses(padded[lo:hi], starts[a:b] - lo)
            i, j = int(np.searchsorted(ends, a, side="right")), int(np.searchsorted(first, b, side="left"))
            cuts = np.maximum(first[i:j], a) - a
            best[i:j] = np.maximum(best[i:j], np.maximum.reduceat(found, cuts, axis=0))
        return best

    def scores(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        best = np.tanh(self.pooled(*self.chunks(data, at)))
        return 1 / (1 + np.exp(-(best @ self.weights["dense"] + self.weights["shift"][0]).astype(np.float64)))

    # --- fitting

    def gradient(self, data: np.ndarray, at: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss over some texts. Only the chunk that wins a filter's maximum gets that filter's."""
        w, n = self.weights, len(wanted)
        padded, starts, first = self.chunks(data, at)
        found = self.responses(padded, starts)
        ends, winners = np.append(first[1:], len(starts)), np.empty((n, FILTERS), dtype=np.int64)
        for i in range(n):
            winners[i] = first[i] + found[first[i] : ends[i]].argmax(axis=0)
        best = np.tanh(np.take_along_axis(found, winners, axis=0))
        score = 1 / (1 + np.exp(-(best @ w["dense"] + w["shift"][0])))
        error = ((score - wanted) / n).astype(np.float32)
        down = error[:, None] * w["dense"] * (1 - best * best)
        taken = padded[starts[winners][:, :, None] + np.arange(WIDTH)]  # text x filter x width
        inputs = w["embed"][taken].reshape(n, FILTERS, WIDTH * EMBED)
        embed = np.zeros_like(w["embed"])
        np.add.at(embed, taken, (down[:, :, None] * w["filters"].T).reshape(n, FILTERS, WIDTH, EMBED))
        return {
            "embed": embed,
            "filters": np.einsum("nf,nfk->kf", down, inputs),
            "bias": down.sum(axis=0),
            "dense": best.T @ error,
            "shift": np.array([error.sum()], dtype=np.float32),
        }

    def fit(self, texts: list[bytes], wanted: np.ndarray, seed: int = 11) -> ByteNetwork:
        """Adam over shuffled batches."""
        draw, step = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.weights.items()}
        v = {k: np.zeros_like(x) for k, x in self.weights.items()}
        total = EPOCHS * -(-len(texts) // BATCH)
        for _ in range(EPOCHS):
            order = draw.permutation(len(texts))
            for k in range(0, len(order), BATCH):
                batch = order[k : k + BATCH]
                at = np.append(0, np.cumsum([len(texts[i]) for i in batch]))
                data = np.frombuffer(b"".join(texts[i] for i in batch), dtype=np.uint8)
                step += 1
                rate = RATE * (1 - step / (total + 1))
                for name, g in self.gradient(data, at, wanted[batch]).items():
                    m[name] += 0.1 * (g - m[name])
                    v[name] += 0.01 * (g * g - v[name])
                    scaled = (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.99**step)) + 1e-6)
                    self.weights[name] -= (rate * scaled).astype(np.float32)
        return self


def held_out(doc_id: str = "doc_id"):
    """True for the third of rows from which nothing is learned: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality") -> ByteNetwork | float:
    """The fitted network, or a constant score where the labels allow no more."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.select(F.col("doc_id").alias("labelled_id"), F.col(label).alias("wanted"))
    known = known.groupBy("labelled_id").agg(F.max("wanted").alias("wanted"))
    # About twice the sample by hash, so that no task sends more than its part of it.
    rate = max(1, known.count() // (2 * FIT_ROWS))
    known = known.where(F.pmod(F.xxhash64("labelled_id"), rate) == 0)
    sample = (
        docs.select("doc_id", "text")
        .join(known, F.col("doc_id") == F.col("labelled_id"))
        .where(F.octet_length("text") <= FIT_BYTES)
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text", "wanted")
        .select("text", "wanted")
        .limit(FIT_ROWS)
    )
    weights, constant = fit_in_task(sample, _fitted)
    if weights is None:
        return constant
    network = ByteNetwork()
    network.weights = weights
    return network


def _fitted(sample: pa.Table) -> tuple[dict[str, np.ndarray] | None, float]:
    """Weights or, where the labels allow no more, the score of all texts."""
    wanted = np.array(sample["wanted"].to_pylist(), dtype=np.float32)
    if not len(wanted) or wanted.min() == wanted.max():
        return None, float(wanted[0]) if len(wanted) else 0.5
    return ByteNetwork().fit([t.encode() for t in sample["text"].to_pylist()], wanted).weights, 0.5


def _scores(texts: pa.Array, model: ByteNetwork | float) -> np.ndarray:
    scores = np.full(len(texts), model if isinstance(model, float) else 0.5)
    if not isinstance(model, float):
        for first, part in slices(texts):
            scores[first : first + len(part)] = model.scores(*text_bytes(part))
    return scores


def score_quality(docs: DataFrame, model: ByteNetwork | float, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``score`` for every row."""
    bounded_batches(docs.sparkSession)
    chosen = docs.select(*keep, F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _scores(batch.column(len(keep)), model)
            columns = [*batch.columns[: len(keep)], pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "score"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(run, f"{kept}score double")


def keep_good(docs: DataFrame, model: ByteNetwork | float, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose texts score ``least`` or more, unchanged."""
    bounded_batches(docs.sparkSession)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column(place), model) >= least))

    return docs.mapInArrow(run, StructType(docs.schema.fields))
