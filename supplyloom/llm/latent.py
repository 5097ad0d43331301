"""Benchmark decontamination by latent semantic retrieval.

Passages of documents and benchmark items are TF-IDF vectors over the words of the benchmark. A randomised singular
value decomposition, whose products with the passage matrix are sums over all tasks, gives a latent space; windows of
documents near an item there (by cosine) are candidates, all of them. A candidate is a leak when the longest common subsequence of
words covers most of the item, or much of it together with its answer (its last sentence), as paraphrases do.

1. One pass over all texts counts in how many passages each benchmark word occurs. Words of few passages carry the
   search, and the ``LEAST_WORDS`` rarest ones of every query passage in any case.
2. A second pass keeps where those words occur, a small table from which everything else up to the check is done.
3. The check reads the texts of candidate documents only.

An item of more than two passages is searched by overlapping query passages of that length, each with a vector of its
own, so a copy is near to some of them however long the item is; the check is always for the whole item. Items of
fewer than ``MIN_HITS`` words are too short for a vector and are found where their words stand in sequence.

The benchmark is the given query set. Its words and vectors are what tasks receive: it is handled in blocks of
``ITEM_BLOCK`` query passages (more if one item has more), so this has a bound however large the benchmark is.

Result: a row per document and item, ``doc_id, item_id, cosine, common, answer``: the part of the item's words in common
where that is most, the best cosine of the windows there, whether the answer was found there. Defined cases: null or empty texts, and items without
words, match nothing; documents that repeat a doc_id are searched each and reported once; rows without a doc_id are
not reported; an empty benchmark or table gives no rows; further columns are passed over.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyloom.llm.batches import bounded_batches
from supplyloom.llm.words import PUNCTUATION, hashed_words, mix, slices
from supplyloom.storage import materialise, rows_of

ITEM_BLOCK = 1000
#: Words of a passage. Query passages have two at most and start a passage after each other.
PASSAGE = 32
#: Words of the windows that are searched, in steps of half their length. The small ones find short items among other
#: words of the benchmark, which outweigh them in a larger window.
WINDOWS = (4, 8, 16, PASSAGE, 2 * PASSAGE)
#: Words in more than this part of the passages are left out, but for the rarest ones of each query passage.
MAX_DF, LEAST_WORDS = 0.002, 8
RANK, OVERSAMPLE = 128, 16
#: Hits whose vectors a task holds at once, unless a single document has more.
PIECE = 32768
#: What a window needs to be a candidate: words, its cosine with an item, and the part of the item's TF-IDF weight
#: that its words make up. Less of the weight leaves too few words for a leak.
MIN_HITS, MIN_COSINE, MIN_WEIGHT = 3, 0.5, 0.3
#: Spans (28 bytes each) that may go to every task; more are joined by a shuffle of the texts.
BROADCAST_SPANS = 200_000
#: Parts of an item's words in common: alone, or with the answer.
MIN_COMMON, MIN_COMMON_ANSWERED, MIN_ANSWER = 0.65, 0.45, 0.6
WORD = re.compile(r"[A-Za-z0-9\u0080-\U0010ffff]+")


def lower_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of lower-cased texts; for each text the first word's number (one more than texts)."""
    return hashed_words(pc.utf8_lower(texts), PUNCTUATION)


def answer_of(text: str) -> str:
    """The last sentence, or the last eight words where there is one sentence only."""
    sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n+", text) if WORD.search(s)]
    return sentences[-1] if len(sentences) > 1 else " ".join(WORD.findall(text)[-8:])


def common_length(a: list, b: list) -> int:
    """Length of the longest common subsequence, by bit rows."""
    places: dict = defaultdict(int)
    for i, w in enumerate(a):
        places[w] |= 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        if w in places:
            match = row & places[w]
            row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


class Vocabulary:
    """Distinct word hashes of some items, sorted; their places in hashed words."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[(self.hashes >> np.uint64(48)).astype(np.int64)] = True

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of known words and their numbers."""
        at = np.flatnonzero(self.maybe[(words >> np.uint64(48)).astype(np.int64)])
        if not len(self.hashes) or not len(at):
            return at[:0], at[:0]
        number = np.minimum(np.searchsorted(self.hashes, words[at]), len(self.hashes) - 1)
        known = self.hashes[number] == words[at]
        return at[known], number[known]


def _cells(rows: np.ndarray, terms: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, term) and how often each occurs."""
    cells, counts = np.unique(rows.astype(np.int64) * size + terms, return_counts=True)
    return cells // size, cells % size, counts


def _summed(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` for each run of equal ``rows`` (ascending)."""
    return np.add.reduceat(values, np.flatnonzero(np.append(True, rows[1:] != rows[:-1])), axis=0)


def document_frequencies(texts: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, int]:
    """Passages each word occurs in, and how many passages there are, over all documents."""
    size = len(vocabulary.hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, passages = np.zeros(size, dtype=np.int64), 0
        for batch in batches:
            for _, part in slices(batch.column(0)):
                words, first = lower_words(part)
                counts = np.diff(first)
                at, term = vocabulary.find(words)
                doc = np.searchsorted(first, at, side="right") - 1
                before = np.cumsum(-(-counts // PASSAGE)) - -(-counts // PASSAGE)
                _, terms, _ = _cells(before[doc] + (at - first[doc]) // PASSAGE, term, size)
                seen += np.bincount(terms, minlength=size)
                passages += int((-(-counts // PASSAGE)).sum())
        found = np.flatnonzero(seen)
        terms, counts = np.append(found, -1), np.append(seen[found], passages)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array(counts, pa.int64())], names=["term", "n"])

    counted = texts.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(size, dtype=np.int64)
    total = 0
    for row in counted:  # a row per word of the benchmark block
        if row["term"] < 0:
            total = row["n"]
        else:
            seen[row["term"]] = row["n"]
    return seen, total


HITS = "doc_id long, places array<int>, terms array<int>"


def informative_hits(texts: DataFrame, vocabulary: Vocabulary, kept: np.ndarray) -> DataFrame:
    """Where the kept words occur in each document that has MIN_HITS of them."""
    number = np.cumsum(kept) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for start, part in slices(batch.column(1)):
                words, first = lower_words(part)
                at, term = vocabulary.find(words)
                good = kept[term]
                at, term = at[good], number[term[good]]
                cuts = np.searchsorted(at, first)
                rows = [i for i in range(len(part)) if cuts[i + 1] - cuts[i] >= MIN_HITS]
                places = [(at[cuts[i] : cuts[i + 1]] - first[i]).astype(np.int32) for i in rows]
                terms = [term[cuts[i] : cuts[i + 1]].astype(np.int32) for i in rows]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, len(part)).take(pa.array(rows, pa.int64())), pa.array(places, pa.list_(pa.int32())), pa.array(terms, pa.list_(pa.int32()))],
                    names=["doc_id", "places", "terms"],
                )

    named = texts.where("doc_id IS NOT NULL").select("doc_id", "text")
    return materialise(named.mapInArrow(run, HITS), "latent-hits")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of hits in runs of rows with some PIECE hits, to bound the vectors held at once."""
    for batch in batches:
        ends = np.cumsum(batch.column(1).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + PIECE, side="right")))
            yield batch.slice(first, last - first)
            first = last


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and term of every hit."""
    counts = batch.column(1).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(batch.num_rows), counts)
    return rows, batch.column(1).flatten().to_numpy().astype(np.int64), batch.column(2).flatten().to_numpy().astype(np.int64)


def _unit_cells(rows: np.ndarray, terms: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse TF-IDF rows of unit length: row numbers from 0 in ascending order, terms, weights."""
    rows, terms, counts = _cells(rows, terms, len(idf))
    weights = counts * idf[terms]
    rows = np.cumsum(np.append(False, rows[1:] != rows[:-1]))
    return rows, terms, (weights / np.sqrt(np.bincount(rows, weights * weights))[rows]).astype(np.float32)


def _gram_product(rows, terms, weights, basis: np.ndarray, out: np.ndarray) -> None:
    """``out += A' A basis`` for the sparse rows A."""
    y = _summed(rows, weights[:, None] * basis[terms])
    order = np.argsort(terms, kind="stable")
    sums = _summed(terms[order], (weights[:, None] * y[rows])[order])
    out[np.unique(terms)] += sums


def passage_product(hits: DataFrame, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``A' A basis`` over the passages of all documents: sums by task, then by block of words in a shuffle."""
    width, rows_each = basis.shape[1], max(1, (1 << 18) // (4 * basis.shape[1]))
    spark = hits.sparkSession
    held = spark.sparkContext.broadcast(basis)  # words of a benchmark block x columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((len(idf), width), dtype=np.float32)
        for batch in _pieces(batches):
            row, place, term = _flat(batch)
            if len(row):
                passages = np.cumsum(np.append(False, (row[1:] != row[:-1]) | (place[1:] // PASSAGE != place[:-1] // PASSAGE)))
                _gram_product(*_unit_cells(passages, term, idf), held.value, out)
        blocks = range(0, len(idf), rows_each)
        yield pa.RecordBatch.from_arrays(
            [pa.array([b // rows_each for b in blocks], pa.int32()), pa.array([out[b : b + rows_each].tobytes() for b in blocks], pa.binary())],
            names=["block", "part"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(part.as_buffer(), dtype=np.float32)
                sums[block] = sums[block] + part if block in sums else part
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums.keys(), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["block", "part"]
        )

    parts = hits.mapInArrow(run, "block int, part binary").repartition("block").mapInArrow(add, "block int, part binary").collect()
    held.destroy()
    joined = b"".join(bytes(r["part"]) for r in sorted(parts, key=lambda r: r["block"]))
    return np.frombuffer(joined, dtype=np.float32).reshape(len(idf), width) if joined else np.zeros_like(basis)


def latent_space(hits: DataFrame, idf: np.ndarray, items: tuple, passages: int, seed: int = 5) -> np.ndarray:
    """Randomised SVD of passages and items: the leading right singular vectors (words x RANK).

    The items stand in the matrix with the weight of the passages as a whole, so the space holds what tells them apart.
    """
    columns = min(RANK + OVERSAMPLE, len(idf))
    rows, terms, weights = items
    weights = weights * np.float32(np.sqrt(max(1, passages) / max(1, rows[-1] + 1)))
    basis = np.random.default_rng(seed).normal(size=(len(idf), columns)).astype(np.float32)
    for _ in range(2):  # the range, then one power iteration
        basis = np.linalg.qr(basis)[0].astype(np.float32)
        product = passage_product(hits, idf, basis).copy()
        _gram_product(rows, terms, weights, basis, product)
        last, basis = basis, product
    _, vectors = np.linalg.eigh(last.T @ basis)
    return (last @ vectors[:, ::-1][:, :RANK]).astype(np.float32)


def _spans(row, item, place, end, cosine) -> tuple[np.ndarray, ...]:
    """Windows (row, item, place, end, cosine), those of a row and item that overlap merged, with the greatest cosine."""
    order = np.lexsort((place, item, row))
    row, item, place, end, cosine = (x[order] for x in (row, item, place, end, cosine))
    other = np.append(True, (row[1:] != row[:-1]) | (item[1:] != item[:-1]))
    shift = np.cumsum(other) * (int(end.max()) + 1)
    reached = np.maximum.accumulate(end + shift)
    starts = np.flatnonzero(np.append(True, place[1:] + shift[1:] >= reached[:-1]))
    return row[starts], item[starts], place[starts], np.maximum.reduceat(end, starts), np.maximum.reduceat(cosine, starts)


def near_windows(hits: DataFrame, idf: np.ndarray, space: np.ndarray, queries: np.ndarray, items: tuple, owner: np.ndarray) -> DataFrame:
    """Spans of documents near an item: ``doc_id, item, cosine, place, words``. Windows that overlap make one span.

    ``queries`` and ``items`` have a row for each query passage; ``owner`` tells the item it is of.
    """
    projected = (idf[:, None] * space).astype(np.float32)
    rows, terms, weights = items
    size = len(idf)
    cells, parts = rows * size + terms, weights * weights  # ascending: an item's part of its weight by word
    # A window holds at most so many times a query's heaviest word: with less than MIN_WEIGHT, the query needs no look.
    heaviest = np.zeros(len(queries))
    np.maximum.at(heaviest, rows, parts)
    within_reach = {words: np.flatnonzero(words * heaviest >= MIN_WEIGHT) for words in WINDOWS}
    spark = hits.sparkSession
    held = spark.sparkContext.broadcast((projected, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, wanted = held.value
        for batch in _pieces(batches):
            row, place, term = _flat(batch)
            found: list[tuple[np.ndarray, ...]] = []
            for words in WINDOWS if len(row) else ():
                half, reach = words // 2, within_reach[words]
                if not len(reach):
                    continue
                near_enough = wanted[reach].T
                new = np.append(True, (row[1:] != row[:-1]) | (place[1:] // half != place[:-1] // half))
                starts = np.flatnonzero(new)
                counts = np.diff(np.append(starts, len(row)))
                at_row, at_half = row[starts], place[starts] // half
                follows = np.append((at_row[1:] == at_row[:-1]) & (at_half[1:] == at_half[:-1] + 1), False)
                hit = counts.copy()
                hit[:-1][follows[:-1]] += counts[1:][follows[:-1]]
                chosen = np.flatnonzero(hit >= MIN_HITS)
                if not len(chosen):
                    continue
                # Vectors of the halves of chosen windows only.
                needed = np.zeros(len(starts), dtype=bool)
                needed[chosen] = True
                needed[chosen[follows[chosen]] + 1] = True
                own, place_of = counts[needed], np.cumsum(needed) - 1
                begins = np.cumsum(own) - own
                inside = np.arange(int(own.sum())) + np.repeat(starts[needed] - begins, own)
                halves = np.add.reduceat(vectors[term[inside]], begins, axis=0)
                for k in range(0, len(chosen), 4096):
                    at = chosen[k : k + 4096]
                    windows, both = halves[place_of[at]], follows[at]
                    windows[both] += halves[place_of[at[both] + 1]]
                    norms = np.linalg.norm(windows, axis=1)
                    cosines = (windows @ near_enough) / np.maximum(norms, 1e-9)[:, None]
                    near, column = np.nonzero(cosines >= MIN_COSINE)
                    if not len(near):
                        continue
                    item_of = reach[column]
                    sizes = hit[at[near]]
                    first = np.cumsum(sizes) - sizes
                    within = np.arange(int(sizes.sum())) + np.repeat(starts[at[near]] - first, sizes)
                    wanted_cells = np.repeat(item_of, sizes) * size + term[within]
                    known = np.minimum(np.searchsorted(cells, wanted_cells), len(cells) - 1)
                    shares = np.add.reduceat(np.where(cells[known] == wanted_cells, parts[known], 0), first)
                    good = np.flatnonzero(shares >= MIN_WEIGHT)
                    if not len(good):
                        continue
                    window, item = near[good], item_of[good]
                    nearness = cosines[window, column[good]]
                    places = at_half[at[window]] * half
                    found.append((at_row[at[window]], owner[item], places, places + words, nearness))
            if found:
                row, item, place, end, cosine = _spans(*map(np.concatenate, zip(*found)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row, pa.int64())), pa.array(item, pa.int32()), pa.array(cosine, pa.float64()),
                        pa.array(place, pa.int32()), pa.array(end - place, pa.int32()),
                    ],
                    names=["doc_id", "item", "cosine", "place", "words"],
                )

    return hits.mapInArrow(run, "doc_id long, item int, cosine double, place int, words int")


LEAKS = "doc_id long, item_id long, cosine double, common double, answer boolean"


def check_candidates(texts: DataFrame, near: DataFrame, items: list) -> DataFrame:
    """Longest common subsequences around each candidate span."""
    known = [(r["item_id"], _hashes(r["text"]), _hashes(answer_of(r["text"]))) for r in items]
    near = materialise(near, "latent-near")
    per_document = near.groupBy("doc_id").agg(F.collect_set(F.struct("item", "cosine", "place", "words")).alias("near"))
    # Few documents have candidates: their spans go to the texts, which stay where they are.
    small = rows_of(near) <= BROADCAST_SPANS
    chosen = texts.join(F.broadcast(per_document) if small else per_document, "doc_id").select("doc_id", "text", "near")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for start, part in slices(batch.column(1)):
                hashes, first = lower_words(part)
                ids, near_by = (batch.column(i).slice(start, len(part)).to_pylist() for i in (0, 2))
                for i, doc_id in enumerate(ids):
                    words = hashes[first[i] : first[i + 1]]
                    found += [(doc_id, *leak) for leak in (_leak(words, n, *known[n["item"]]) for n in near_by[i]) if leak]
            if found:
                yield _leak_rows(found)

    return chosen.mapInArrow(run, LEAKS)


def _leak_rows(found: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_())
    columns = [pa.array(c, t) for c, t in zip(zip(*found), types)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "cosine", "common", "answer"])


def _hashes(text: str) -> np.ndarray:
    return lower_words(pa.array([text], pa.string()))[0]


def _leak(words: np.ndarray, near: dict, item_id: int, wanted: np.ndarray, answer: np.ndarray) -> tuple | None:
    """What a leak row tells if the document's words around a span hold enough of an item."""
    low, high = max(0, near["place"] - len(wanted)), near["place"] + near["words"] + len(wanted)
    around = words[low:high]
    if np.isin(wanted, around).sum() < MIN_COMMON_ANSWERED * len(wanted):
        return None
    length, step = len(wanted) * 5 // 4 + 2, max(1, len(wanted) // 8)
    held = np.cumsum(np.append(0, np.isin(around, wanted)))
    around, wanted, answer = around.tolist(), wanted.tolist(), answer.tolist()
    best = None
    for a in range(0, max(1, len(around) - len(wanted) + 1), step):
        if held[min(a + length, len(around))] - held[a] < MIN_COMMON_ANSWERED * len(wanted):
            continue
        common = common_length(wanted, around[a : a + length]) / len(wanted)
        if common < max(MIN_COMMON_ANSWERED, best[0] if best else 0):
            continue
        nearby = around[max(0, a - len(wanted)) : a + length + len(wanted)]
        answered = common_length(answer, nearby) >= MIN_ANSWER * len(answer)
        if common >= MIN_COMMON or answered:
            best = max(best or (common, answered), (common, answered))
    return best and (item_id, near["cosine"], *best)


def query_starts(count: int) -> range | list[int]:
    """Where the query passages of an item of so many words start; the last one ends with the item."""
    last = max(0, count - 2 * PASSAGE)
    return [*range(0, last, PASSAGE), last]


def short_leaks(texts: DataFrame, items: list) -> DataFrame:
    """Documents in which the words of items of fewer than MIN_HITS words stand in sequence."""
    known: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
    for r in items:
        words = _hashes(r["text"])
        known[len(words)][int(_sequences(words, len(words))[0])].append(r["item_id"])
    known = {n: dict(wanted) for n, wanted in known.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for start, part in slices(batch.column(1)):
                hashes, first = lower_words(part)
                ids = batch.column(0).slice(start, len(part)).to_pylist()
                for n, wanted in known.items():
                    rolled = _sequences(hashes, n)
                    at = np.flatnonzero(np.isin(rolled, np.fromiter(wanted, np.uint64, len(wanted))))
                    row = np.searchsorted(first, at, side="right") - 1
                    inside = at + n <= first[row + 1]
                    pairs = set(zip(row[inside].tolist(), rolled[at[inside]].tolist()))
                    found += [(ids[i], item, 1.0, 1.0, True) for i, h in pairs for item in wanted[h]]
            if found:
                yield _leak_rows(found)

    return texts.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, LEAKS)


def _sequences(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` words."""
    many = max(0, len(words) - n + 1)
    rolled = np.zeros(many, dtype=np.uint64)
    for i in range(n):
        rolled = mix(rolled * np.uint64(3) + words[i : many + i])
    return rolled


def _leaks_of(texts: DataFrame, items: list) -> DataFrame | None:
    """Leaks of one block of the benchmark."""
    items = [(r, len(_hashes(r["text"]))) for r in items]
    short = [r for r, count in items if 0 < count < MIN_HITS]
    items = [r for r, count in items if count >= MIN_HITS]
    found = [short_leaks(texts, short)] if short else []
    if items:
        found.append(_latent_leaks(texts, items))
    return reduce(DataFrame.unionByName, found) if found else None


def _latent_leaks(texts: DataFrame, items: list) -> DataFrame:
    whole, at = lower_words(pa.array([r["text"] for r in items], pa.string()))
    starts = [(i, at[i] + a) for i, count in enumerate(np.diff(at)) for a in query_starts(int(count))]
    owner = np.array([i for i, _ in starts])
    parts = [whole[a : min(a + 2 * PASSAGE, at[i + 1])] for i, a in starts]
    words, first = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
    vocabulary = Vocabulary(words)
    item_of = np.repeat(np.arange(len(parts)), np.diff(first))
    _, term = vocabulary.find(words)
    seen, passages = document_frequencies(texts, vocabulary)
    kept = seen <= MAX_DF * passages
    order = np.lexsort((seen[term], item_of))
    rank = np.arange(len(order)) - first[item_of[order]]
    kept[term[order][rank < LEAST_WORDS]] = True
    idf = np.log((1 + passages) / (1 + seen[kept])) + 1

    hits = informative_hits(texts, vocabulary, kept)
    good = kept[term]
    rows, terms, weights = _unit_cells(item_of[good], (np.cumsum(kept) - 1)[term[good]], idf)
    space = latent_space(hits, idf, (rows, terms, weights), passages)
    queries = _summed(rows, weights[:, None] * space[terms])
    queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-9)
    return check_candidates(texts, near_windows(hits, idf, space, queries, (rows, terms, weights), owner), items)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) against ``benchmark`` (item_id, text)."""
    spark: SparkSession = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    query = benchmark.where("text IS NOT NULL").select("item_id", "text").orderBy("item_id", "text")
    found, block, passages = [], [], 0
    for row in query.toLocalIterator():
        more = len(query_starts(len(_hashes(row["text"]))))
        if block and passages + more > ITEM_BLOCK:
            found.append(_leaks_of(texts, block))
            block, passages = [], 0
        block.append(row)
        passages += more
    if block:
        found.append(_leaks_of(texts, block))
    leaks = spark.createDataFrame([], LEAKS)
    for part in found:
        leaks = leaks if part is None else leaks.unionByName(part)
    best = F.max(F.struct("common", "cosine", "answer"))
    return leaks.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.cosine", "best.common", "best.answer")
