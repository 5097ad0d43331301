"""Toxicity: a convolutional text classifier over hashed word embeddings, in numpy.

A text's words (runs of letters, digits and non-ASCII bytes, A-Z lower-cased) get the sum of three hashed embeddings:
that of the whole word and those of its first ``STEMS`` bytes, which inflected forms share. Learned filters of
``WIDTHS`` words run over every place of the whole text, each filter's responses are max-pooled, and a dense layer
combines them into one logit.

The network learns from every labelled row with a text. Up to ``FIT_ROWS`` rows fit into one task; more are learned in
``ROUNDS`` rounds over all of them, where each task walks its rows in batches from common weights and the changes are
averaged by rows (those of an embedding over the tasks that met it). Tables of words' buckets (six bytes a word) are
read for that, not the texts. A fifth of the rows is kept out of the gradient: it picks the epoch or round, and all of
it calibrates a threshold for each language, beyond one task from running totals over all distinct logits. The language is
guessed from the function words of the text itself; a language with few labelled texts leans on all of them together.
The score is the logit shifted so that the threshold of the text's language lies at ``CUT``.

Scoring reads whole texts in slices of bounded memory; a longer text is hashed piece by piece and pooled in steps.

Defined cases: a null or empty text is one place of padding and gets a score like any other; null labels and labels of
unknown documents are passed over, of clashing labels of one id the greater counts; without labels, or with one label
only, the score is the same for all texts, the share of label 1 (0.5 without labels); repeated rows are scored each;
an empty table gives no rows; further columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyloom.llm.batches import bounded_batches
from supplyloom.llm.fitting import fit_in_task
from supplyloom.llm.quality import held_out
from supplyloom.llm.words import PUNCTUATION, SLICE_BYTES, hashed_words, mix, slices, text_bytes, word_bounds
from supplyloom.operators.position import running_totals
from supplyloom.storage import materialise, rows_of

BITS, EMBED, WIDTHS, FILTERS, STEMS = 15, 8, (1, 2, 3), 8, (4, 6)
PARTS = 1 + len(STEMS)
BUCKETS, SPAN, ALL = 1 << BITS, max(WIDTHS), FILTERS * len(WIDTHS)
#: The bucket of padding: its embedding is zero and never learned.
PAD = BUCKETS
FIT_ROWS, FIT_BYTES, STEPS, BATCH, RATE, DROP = 8000, 128 << 20, 2000, 32, 0.01, 0.2
#: Passes over more rows than one task fits, and texts and bytes that are shuffled together in a task.
ROUNDS, MIXED_ROWS, MIXED_BYTES = 4, 2048, 32 << 20
#: Labels that go to every task at once (12 bytes each); more are joined by a shuffle.
BROADCAST_LABELS = 1_000_000
#: Embeddings whose changes are added up together.
PIECE = 4096
#: Places scored at once.
STEP = 1 << 16
#: The score at which a text counts as toxic.
CUT = 0.7
#: Labelled texts, in number, that all languages together weigh in the choice of a language's threshold.
PRIOR = 40.0

# Common function words of the languages told apart.
FUNCTION_WORDS = (
    "the of and to is that it for was with",
    "der und die zu den von das mit sich ist",
    "la le et les du une est pour au dans",
    "el que los y se del por las una con",
)
#: Languages, and one more for texts without any of these words.
LANGUAGES = len(FUNCTION_WORDS) + 1


def buckets_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every word of a column (word x PARTS); for each row the first word's number (one more than rows)."""
    hashes, first = hashed_words(column, PUNCTUATION)
    data, at = text_bytes(column)
    starts, ends, _ = word_bounds(data, at, PUNCTUATION)
    upper = (data >= ord("A")) & (data <= ord("Z"))
    data = np.append(data + upper * np.uint8(32), np.zeros(max(STEMS), np.uint8))
    parts, stem = [hashes], np.zeros(len(starts), dtype=np.uint64)
    for i in range(max(STEMS)):
        stem |= np.where(starts + i < ends, data[starts + i], 0).astype(np.uint64) << np.uint64(8 * i)
        if i + 1 in STEMS:
            parts.append(mix(stem + np.uint64(i)))
    return (np.stack(parts, axis=1) >> np.uint64(64 - BITS)).astype(np.uint16), first


def _language_of_bucket() -> np.ndarray:
    known = np.full(BUCKETS + 1, LANGUAGES - 1, dtype=np.uint8)
    for i, words in enumerate(FUNCTION_WORDS):
        known[buckets_of(pa.array([words]))[0][:, 0]] = i
    return known


LANGUAGE_OF_BUCKET = _language_of_bucket()


def word_buckets(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The column in slices: (first row, buckets of all words, each row's first word, one more than rows)."""
    for first, part in slices(column):
        data, at = text_bytes(part)
        if len(data) <= SLICE_BYTES:
            yield (first, *buckets_of(part))
            continue
        # One long text (at most with short ones before it): cut behind separators, which words never cross.
        for i in range(len(part)):
            yield (first + i, *_long_text(data[at[i] : at[i + 1]]))


def _long_text(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = [np.empty((0, PARTS), np.uint16)], 0
    while at < len(data):
        end = min(len(data), at + SLICE_BYTES)
        if end < len(data):
            breaks = np.flatnonzero(PUNCTUATION[data[at:end]])
            if not len(breaks):  # one word longer than a slice: up to its end
                later = np.flatnonzero(PUNCTUATION[data[end:]])
                breaks = later[:1] + (end - at)
            end = at + int(breaks[-1]) + 1 if len(breaks) else len(data)
        piece = pa.Array.from_buffers(
            pa.large_string(), 1, [None, pa.py_buffer(np.array([0, end - at], np.int64)), pa.py_buffer(data[at:end].tobytes())]
        )
        found.append(buckets_of(piece)[0])
        at = end
    words = np.concatenate(found)
    return words, np.array([0, len(words)])


def languages(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per text the language with most function words (the earlier one on a tie), or the last for none."""
    rows = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    counts = np.bincount(rows * LANGUAGES + LANGUAGE_OF_BUCKET[words[:, 0]], minlength=(len(starts) - 1) * LANGUAGES)
    counts = counts.reshape(-1, LANGUAGES)[:, :-1]
    return np.where(counts.max(axis=1, initial=0) > 0, counts.argmax(axis=1), LANGUAGES - 1)


def places(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded buckets, and per text its first place and its number of places (at least one).

    A place is where windows begin; ``SPAN - 1`` pads behind each text let windows run over its end.
    """
    sizes = np.diff(starts)
    counts = np.maximum(1, sizes)
    room = counts + SPAN - 1
    begins = np.cumsum(room) - room
    padded = np.full((int(room.sum()), PARTS), PAD, dtype=np.int32)
    within = np.arange(len(words)) - np.repeat(starts[:-1] - starts[0], sizes)
    padded[np.repeat(begins, sizes) + within] = words
    return padded, begins, counts


class Adam:
    def __init__(self, weights: dict[str, np.ndarray]):
        self.step = 0
        self.m = {k: np.zeros_like(v) for k, v in weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in weights.items()}

    def update(self, weights: dict[str, np.ndarray], found: dict[str, np.ndarray], touched: np.ndarray, rate: float) -> None:
        self.step += 1
        m, v, step = self.m, self.v, self.step
        for name, g in found.items():
            rows = touched if name == "embed" else slice(None)
            m[name][rows] += 0.1 * (g - m[name][rows])
            v[name][rows] += 0.01 * (g * g - v[name][rows])
            scaled = (m[name][rows] / (1 - 0.9**step)) / (np.sqrt(v[name][rows] / (1 - 0.99**step)) + 1e-6)
            weights[name][rows] -= (rate * scaled).astype(np.float32)


def log_losses(z: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z) - wanted * z


class WordNetwork:
    def __init__(self, seed: int = 5):
        draw = np.random.default_rng(seed)
        embed = draw.normal(0, 0.1, (BUCKETS + 1, EMBED)).astype(np.float32)
        embed[PAD] = 0
        filters = draw.normal(0, 1 / np.sqrt(EMBED), (SPAN, EMBED, ALL)).astype(np.float32)
        # A filter of width w sees the first w words of its window only.
        self.seen = (np.arange(SPAN)[:, None, None] < np.repeat(WIDTHS, FILTERS)).astype(np.float32)
        self.weights = {
            "embed": embed,
            "filters": filters * self.seen,
            "bias": np.zeros(ALL, dtype=np.float32),
            "dense": draw.normal(0, 0.3, ALL).astype(np.float32),
            "shift": np.full(1, -1, dtype=np.float32),
        }

    def responses(self, padded: np.ndarray) -> np.ndarray:
        """Of all filters at every place but the last pads."""
        x = self.weights["embed"][padded].sum(axis=1)
        n = max(0, len(padded) - SPAN + 1)
        windows = np.concatenate([x[i : i + n] for i in range(SPAN)], axis=1)
        return windows @ self.weights["filters"].reshape(SPAN * EMBED, ALL) + self.weights["bias"]

    def pooled(self, padded: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Max of each filter over each text's places, STEP places at a time."""
        best = np.full((len(begins), ALL), -np.inf, dtype=np.float32)
        ends = begins + counts
        for a in range(0, len(padded), STEP):
            b = min(a + STEP, len(padded))
            i, j = int(np.searchsorted(ends, a, side="right")), int(np.searchsorted(begins, b, side="left"))
            if i >= j:
                continue
            found = self.responses(padded[a : b + SPAN - 1])
            lows, highs = np.maximum(begins[i:j], a) - a, np.minimum(ends[i:j], b) - a
            bounds = np.stack([lows, highs], axis=1).ravel()
            most = np.maximum.reduceat(np.vstack([found, np.full((1, ALL), -np.inf, np.float32)]), bounds, axis=0)[::2]
            best[i:j] = np.maximum(best[i:j], most)
        return best

    def logits(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        best = np.tanh(self.pooled(*places(words, starts)))
        return (best @ self.weights["dense"] + self.weights["shift"][0]).astype(np.float64)

    # --- fitting

    def winners(self, padded: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text and filter the place of the greatest response, and the response; STEP places at a time."""
        if len(padded) <= STEP:
            found = self.responses(padded)
            at = np.stack([a + found[a : a + k].argmax(axis=0) for a, k in zip(begins, counts)])
            return at, np.take_along_axis(found, at, axis=0)
        at = np.zeros((len(begins), ALL), dtype=np.int64)
        most = np.full((len(begins), ALL), -np.inf, dtype=np.float32)
        for i, (first, count) in enumerate(zip(begins, counts)):
            for a in range(first, first + count, STEP):
                found = self.responses(padded[a : min(a + STEP, first + count) + SPAN - 1])
                here = found.argmax(axis=0)
                value = found[here, np.arange(ALL)]
                better = value > most[i]
                at[i][better], most[i][better] = a + here[better], value[better]
        return at, most

    def gradient(self, words: np.ndarray, starts: np.ndarray, wanted: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Of the mean log loss, and the buckets that the embedding's rows belong to.

        Only the window that wins a filter's maximum gets that filter's.
        """
        w, n = self.weights, len(wanted)
        padded, begins, counts = places(words, starts)
        winners, most = self.winners(padded, begins, counts)
        best = np.tanh(most)
        score = 1 / (1 + np.exp(-(best @ w["dense"] + w["shift"][0])))
        error = ((score - wanted) / n).astype(np.float32)
        down = error[:, None] * w["dense"] * (1 - best * best)
        taken = padded[winners[:, :, None] + np.arange(SPAN)]  # text x filter x word x part
        inputs = w["embed"][taken].sum(axis=3)
        touched, at = np.unique(taken, return_inverse=True)
        embed = np.zeros((len(touched), EMBED), dtype=np.float32)
        np.add.at(embed, at.reshape(taken.shape), np.einsum("nf,sef->nfse", down, w["filters"])[:, :, :, None])
        embed[touched == PAD] = 0
        return {
            "embed": embed,
            "filters": np.einsum("nf,nfse->sef", down, inputs) * self.seen,
            "bias": down.sum(axis=0),
            "dense": best.T @ error,
            "shift": np.array([error.sum()], dtype=np.float32),
        }, touched

    def fit(self, texts: list[np.ndarray], wanted: np.ndarray, checked: np.ndarray, seed: int = 3) -> WordNetwork:
        """Adam over shuffled batches, with words dropped at random; keeps the epoch that is best on ``checked``."""
        draw, adam = np.random.default_rng(seed), Adam(self.weights)
        learned = np.flatnonzero(~checked)
        steps = -(-len(learned) // BATCH)
        epochs = -(-STEPS // steps)
        total, kept, least = epochs * steps, None, np.inf
        for _ in range(epochs):
            order = draw.permutation(learned)
            for k in range(0, len(order), BATCH):
                self.learn(adam, draw, [texts[i] for i in order[k : k + BATCH]], wanted[order[k : k + BATCH]], RATE * (1 - (adam.step + 1) / (total + 1)))
            z = self.scored([texts[i] for i in np.flatnonzero(checked)])
            loss = float(np.mean(log_losses(z, wanted[checked]))) if len(z) else 0.0
            if loss <= least:
                kept, least = {k: x.copy() for k, x in self.weights.items()}, loss
        self.weights = kept
        return self

    def learn(self, adam: Adam, draw: np.random.Generator, texts: list[np.ndarray], wanted: np.ndarray, rate: float) -> np.ndarray:
        """One step; the buckets whose embeddings it met."""
        thinned = [t[draw.random(len(t)) >= DROP] for t in texts]
        found, touched = self.gradient(*joined(thinned), wanted)
        adam.update(self.weights, found, touched, rate)
        return touched

    def scored(self, texts: list[np.ndarray]) -> np.ndarray:
        found = [self.logits(*joined(texts[i : i + 256])) for i in range(0, len(texts), 256)]
        return np.concatenate(found) if found else np.empty(0)


def joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.append(0, np.cumsum([len(t) for t in texts], dtype=np.int64)).astype(np.int64)
    return (np.concatenate(texts) if texts else np.empty((0, PARTS), np.uint16)), starts


def thresholds(logits: np.ndarray, wanted: np.ndarray, language: np.ndarray) -> np.ndarray:
    """Per language the logit that splits its texts best, all languages weighing in with ``PRIOR`` texts.

    A text of either label counts by that label's rarity; of equally good cuts the middle one is taken.
    """
    weight = np.where(wanted == 1, 0.5 / max(1, wanted.sum()), 0.5 / max(1, len(wanted) - wanted.sum())) * len(wanted)
    order = np.argsort(logits, kind="stable")
    z, y = logits[order], wanted[order]
    cuts = np.concatenate([[z[0] - 1], (z[1:] + z[:-1]) / 2, [z[-1] + 1]])
    found = np.empty(LANGUAGES)
    for k in range(LANGUAGES):
        lean = weight[order] * ((language[order] == k) + PRIOR / len(z))
        missed = np.append(0, np.cumsum(lean * (y == 1)))  # below the cut
        alarms = (lean * (y == 0)).sum() - np.append(0, np.cumsum(lean * (y == 0)))
        wrong = missed + alarms
        best = np.flatnonzero(wrong <= wrong.min() + 1e-9)
        found[k] = (cuts[best[0]] + cuts[best[-1]]) / 2
    return found


def table_thresholds(scored: DataFrame) -> np.ndarray:
    """``thresholds`` of a table ``z, wanted, language`` of any size.

    All rows count: distinct logits are folded, then running totals go over range partitions.
    """
    named = [f"{side}{k}" for side in "pn" for k in range(LANGUAGES)]
    of = lambda c: F.sum(((F.col("wanted") == int(c[0] == "p")) & (F.col("language") == int(c[1:]))).cast("long")).alias(c)
    folded = materialise(scored.groupBy("z").agg(*[of(c) for c in named]), "logits")
    sums = folded.agg(*[F.sum(c).alias(c) for c in named], F.min("z").alias("least")).first()
    ones, zeros = (sum(sums[f"{side}{k}"] for k in range(LANGUAGES)) for side in "pn")
    n = ones + zeros
    one, zero = (0.5 / max(1, count) * n for count in (ones, zeros))

    def wrong(missed, alarms, k):  # by the counts of each language below, and not below, a cut
        return one * (missed[k] + PRIOR / n * sum(missed)) + zero * (alarms[k] + PRIOR / n * sum(alarms))

    # A row stands for the cut between its logit and the next one.
    running = materialise(running_totals(folded, {f"t_{c}": c for c in named}, [F.col("z")]), "cuts")
    missed = [F.col(f"t_p{k}") for k in range(LANGUAGES)]
    alarms = [F.lit(sums[f"n{k}"]) - F.col(f"t_n{k}") for k in range(LANGUAGES)]
    costs = running.select("z", *[wrong(missed, alarms, k).alias(f"c{k}") for k in range(LANGUAGES)])
    lowest = costs.agg(*[F.min(f"c{k}").alias(f"c{k}") for k in range(LANGUAGES)]).first()
    below = [wrong([0] * LANGUAGES, [sums[f"n{j}"] for j in range(LANGUAGES)], k) for k in range(LANGUAGES)]
    limits = [min(lowest[f"c{k}"], below[k]) + 1e-9 for k in range(LANGUAGES)]
    good = [F.when(F.col(f"c{k}") <= limits[k], F.col("z")) for k in range(LANGUAGES)]
    ends = costs.agg(*[f(g) for g in good for f in (F.min, F.max)]).first()
    nexts = running.agg(*[F.min(F.when(F.col("z") > F.lit(z), F.col("z"))) for z in ends]).first()
    cuts = [None if z is None else z + 1 if after is None else (z + after) / 2 for z, after in zip(ends, nexts)]
    found = np.empty(LANGUAGES)
    for k in range(LANGUAGES):
        low, high = cuts[2 * k : 2 * k + 2]
        if below[k] <= limits[k]:
            low = sums["least"] - 1
        found[k] = (low + (low if high is None else high)) / 2
    return found


@dataclass(frozen=True)
class Judge:
    """A fitted network with its thresholds, or a score for all texts."""

    network: WordNetwork | None
    cuts: np.ndarray | None
    constant: float = 0.5

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.full(len(column), self.constant)
        if self.network is None:
            return out
        for first, words, starts in word_buckets(column):
            z = self.network.logits(words, starts) - self.cuts[languages(words, starts)]
            z = np.clip(z + np.log(CUT / (1 - CUT)), -60, 60)
            out[first : first + len(z)] = 1 / (1 + np.exp(-z))
        return out


def _examples(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``key, wanted`` and ``words`` (buckets of two bytes, PARTS a word) of every labelled row with a text."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy(F.col("doc_id").alias("labelled_id")).agg(F.max(label).cast("int").alias("wanted"))
    known = materialise(known, "labels")
    known = F.broadcast(known) if rows_of(known) <= BROADCAST_LABELS else known
    chosen = docs.select("doc_id", "text").where("text IS NOT NULL").join(known, F.col("doc_id") == F.col("labelled_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words, starts in word_buckets(batch.column(0)):
                packed = pa.array([words[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])], pa.binary())
                others = [batch.column(i).slice(first, len(packed)) for i in (1, 2)]
                yield pa.RecordBatch.from_arrays([others[0], others[1], packed], names=["key", "wanted", "words"])

    packed = chosen.select("text", F.xxhash64("doc_id").alias("key"), "wanted").mapInArrow(run, "key long, wanted int, words binary")
    return materialise(packed, "words")


def _texts(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(w, dtype=np.uint16).reshape(-1, PARTS) for w in column.to_pylist()]


def _fitted(sample: pa.Table) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Weights and thresholds of rows of both labels that fit into a task."""
    sample = sample.sort_by([("key", "ascending"), ("words", "ascending")])
    texts, wanted = _texts(sample["words"]), sample["wanted"].to_numpy().astype(np.float32)
    # Every fifth text of either label is kept out of the gradient.
    checked = np.zeros(len(wanted), dtype=bool)
    for value in (0, 1):
        checked[np.flatnonzero(wanted == value)[4::5]] = True
    network = WordNetwork().fit(texts, wanted, checked)
    told = checked if len(np.unique(wanted[checked])) == 2 else np.ones(len(wanted), dtype=bool)
    held = [texts[i] for i in np.flatnonzero(told)]
    return network.weights, thresholds(network.scored(held), wanted[told], languages(*joined(held)))


def _as_rows(pieces: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"piece": pa.array(list(pieces), pa.int32()), "sums": pa.array([v.tobytes() for v in pieces.values()], pa.binary())}
    )


def _added(rows: DataFrame) -> dict[int, np.ndarray]:
    """Sums of equal pieces: a few of them, whatever the number of tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[piece] = total.get(piece, 0) + np.frombuffer(sums)
        if total:
            yield _as_rows(total)

    schema = "piece int, sums binary"
    return {r.piece: np.frombuffer(r["sums"]) for r in rows.repartition("piece").mapInArrow(run, schema).collect()}


def _one_round(examples: DataFrame, weights: dict[str, np.ndarray], number: int) -> tuple[dict[str, np.ndarray], float]:
    """The averaged weights after each task walked its rows once, and the loss of the given ones on what is checked."""
    dense = [k for k in weights if k != "embed"]
    rate = RATE * (1 - number / ROUNDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        draw = np.random.default_rng([number, TaskContext.get().partitionId()])
        given, own = WordNetwork(), WordNetwork()
        given.weights, own.weights = weights, {k: v.copy() for k, v in weights.items()}
        adam, met = Adam(weights), np.zeros(BUCKETS + 1, dtype=bool)
        losses, n, texts, wanted = np.zeros(2), 0, [], []

        def walk() -> None:
            order = draw.permutation(len(texts))
            for k in range(0, len(order), BATCH):
                batch = order[k : k + BATCH]
                met[own.learn(adam, draw, [texts[i] for i in batch], np.array([wanted[i] for i in batch]), rate)] = True
            texts.clear()
            wanted.clear()

        for batch in batches:
            kept = batch.column("checked").to_numpy(zero_copy_only=False)
            values, found = batch.column("wanted").to_numpy().astype(np.float32), _texts(batch.column("words"))
            told = [t for t, c in zip(found, kept) if c]
            losses += [log_losses(given.scored(told), values[kept]).sum(), len(told)]
            for text, value, c in zip(found, values, kept):
                if not c:
                    texts.append(text)
                    wanted.append(value)
                    n += 1
                    if len(texts) == MIXED_ROWS or sum(t.nbytes for t in texts[-1:]) > MIXED_BYTES:
                        walk()
            if sum(t.nbytes for t in texts) > MIXED_BYTES:
                walk()
        if texts:
            walk()
        pieces = {-1: losses, -2: np.append(n * np.concatenate([(own.weights[k] - weights[k]).ravel() for k in dense]).astype(float), n)}
        change = np.hstack([own.weights["embed"] - weights["embed"], met[:, None]]).astype(float) * n
        pieces |= {a: change[a : a + PIECE].ravel() for a in range(0, BUCKETS + 1, PIECE)}
        yield _as_rows(pieces)

    sums = _added(examples.mapInArrow(run, "piece int, sums binary"))
    losses, moved = sums.pop(-1), sums.pop(-2)
    after, at = {"embed": weights["embed"].copy()}, 0
    for k in dense:
        after[k] = weights[k] + (moved[at : at + weights[k].size] / max(1, moved[-1])).reshape(weights[k].shape).astype(np.float32)
        at += weights[k].size
    for a, change in sums.items():
        change = change.reshape(-1, EMBED + 1)
        after["embed"][a : a + PIECE] += (change[:, :-1] / np.maximum(1, change[:, -1:])).astype(np.float32)
    return after, losses[0] / max(1, losses[1])


def _logits(examples: DataFrame, weights: dict[str, np.ndarray]) -> DataFrame:
    network = WordNetwork()
    network.weights = weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _texts(batch.column("words"))
            columns = [pa.array(network.scored(texts), pa.float64()), batch.column("wanted"), pa.array(languages(*joined(texts)), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["z", "wanted", "language"])

    return materialise(examples.mapInArrow(run, "z double, wanted int, language int"), "checked-logits")


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Judge:
    bounded_batches(docs.sparkSession)
    examples = _examples(docs, labels, label)
    told = examples.agg(F.min("wanted").alias("least"), F.max("wanted").alias("most"), F.sum(F.length("words")).alias("size")).first()
    if told.least is None or told.least == told.most:
        return Judge(None, None, 0.5 if told.least is None else float(told.least))
    network = WordNetwork()
    if rows_of(examples) <= FIT_ROWS and told["size"] <= FIT_BYTES:
        network.weights, cuts = fit_in_task(examples, _fitted)
        return Judge(network, cuts)
    examples = examples.withColumn("checked", F.pmod(F.xxhash64("key"), F.lit(5)) == 0)
    checked, current, least = examples.where("checked"), network.weights, np.inf
    for number in range(ROUNDS + 1):  # the last one is for the loss alone
        after, loss = _one_round(checked if number == ROUNDS else examples, current, number)
        if number and loss <= least:
            network.weights, least = current, loss
        current = after
    both = checked.agg(F.min("wanted") < F.max("wanted")).first()[0]
    return Judge(network, table_thresholds(_logits(checked if both else examples, network.weights)))


def score_toxicity(docs: DataFrame, judge: Judge) -> DataFrame:
    """``doc_id`` and ``score`` for every row."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(judge.scores(batch.column(1)), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=["doc_id", "score"])

    chosen = docs.select("doc_id", "text")
    return chosen.mapInArrow(run, f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, score double")
