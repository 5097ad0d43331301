"""N-gram Jaccard join with signature trees.

Documents link when the sets of their n-word shingles have a Jaccard similarity of ``percent`` or more. Documents of
equal sets are one class, named by a hash of the set. The join of classes goes in three steps:

1. *Blocks.* In any fixed order of shingles, two linked sets share one among the first ``n - ceil(t n) + 1`` of each.
   The order is that of the shingles' 64-bit hashes. Where that prefix is long, ``PREFIX`` shingles of it do: each is
   shared with a chance of 3 in 4 or more, so a link escapes all with a chance below 0.25**36, far less than that of
   a collision of two hashes. Frequent shingles (of common lines, of large groups of near copies) are put last in the
   order for the documents that have them in their prefix, and their prefixes are taken anew.
2. *Signature trees.* Blocks of the same classes are one. In each block a tree is built over the documents' bitmaps: a node holds the OR of
   the bitmaps below it, their range of sizes, and how many shingles share a bit at most. A dual traversal from the root drops
   pairs of nodes whose greatest possible overlap (common bits, plus shared bits, at most the smaller size) is too
   small for their sizes. Pairs of documents that survive are candidates; they form candidate groups.
3. *Check.* Each candidate group gets its documents' whole sets once, in chunks of bounded size. The same traversal
   runs over them, leaves out pairs that are known to be connected, and counts the exact overlap of the rest. Chunks
   of a large group are first checked alone, then against the first one, and then, where chunks still differ in what
   they are connected to, against each other; so a group of near copies costs about what its size is.

Nothing is left out: blocks and groups of any size are handled, and the frequent list (``HOT_LIST`` at most) only
sets an order. The result has one row per document: ``n_shingles`` and ``component_id``, the smallest doc_id it is
connected to by links.

Defined cases: a null or wordless text has an empty set and links with nothing; a text of fewer words than a shingle
is one shingle; rows that repeat a doc_id count as one connected document, each with its own n_shingles; rows without
a doc_id take part in no link and get a null component; further columns are passed over.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyloom.llm.batches import bounded_batches
from supplyloom.llm.components import connected_components
from supplyloom.llm.words import hashed_shingles, hashed_words, mix, slices
from supplyloom.operators.joins import lookup
from supplyloom.storage import materialise, packed, rows_of

PREFIX = 36
#: A shingle in more prefixes than HOT goes last; at most HOT_LIST of them (8 bytes each), the most frequent ones.
HOT, HOT_LIST = 64, 1_000_000
#: Rows of ids that may go to every task at once; longer tables are joined by a shuffle.
BROADCAST_ROWS = 2_000_000
#: Bitmaps that are worth a task of the tree join.
MAPS_EACH = 8192
#: Documents in a chunk of the check, and in a block that gets a tree; a larger block is one candidate group at once.
CHUNK = 2048
FANOUT = 8
#: Blocks up to this size are a single node, whose pairs are compared directly.
SINGLE = 12
#: Pairs of nodes evaluated at once, in words of bitmaps.
STEP_WORDS = 1 << 20


# --- sets, prefixes and bitmaps of documents


def prefix_of(tokens: np.ndarray, hot: np.ndarray, percent: int) -> np.ndarray:
    """The shingles under which a document is filed: ``tokens`` ascending, ``hot`` marking those that come last."""
    n = len(tokens)
    length = n - -(-n * percent // 100) + 1 if n else 0
    cold = tokens[~hot] if hot.any() else tokens
    if len(cold) >= length:
        few_hot = 4 * (n - len(cold)) <= n
        return cold[: min(length, PREFIX) if few_hot else length]
    return np.concatenate([cold, tokens[hot][: min(length - len(cold), PREFIX)]])


def bitmap_words(n: int) -> int:
    """64-bit words of the bitmap for ``n`` shingles: two to four bits for each, a power of two."""
    return 1 << max(0, (2 * n - 1).bit_length() - 6)


def bitmap(tokens: np.ndarray) -> np.ndarray:
    words = bitmap_words(len(tokens))
    bits = np.zeros(words * 64, dtype=np.uint8)
    bits[(tokens & np.uint64(words * 64 - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def folded(maps: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows) brought down to ``words`` words."""
    while maps.shape[1] > words:
        half = maps.shape[1] // 2
        maps = maps[:, :half] | maps[:, half:]
    return maps


def bits_of(maps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(maps).sum(axis=1, dtype=np.int64)


# --- the tree


class SignatureTree:
    """Nodes by level, from the documents (level 0, in order of size) to one root."""

    def __init__(self, sizes: np.ndarray, maps: np.ndarray, percent: int):
        self.percent = percent
        self.order = np.argsort(sizes, kind="stable")
        maps, low = maps[self.order], sizes[self.order].astype(np.int64)
        self.levels = [(maps, low, low, low - bits_of(maps))]
        while len(self.levels[-1][1]) > 1:
            maps, low, high, shared = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            up = (np.bitwise_or.reduceat(maps, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(shared, at))
            self.levels.append(up)

    def may_link(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether any documents below nodes ``a`` and ``b`` may overlap enough for their sizes."""
        maps, low, high, shared = self.levels[level]
        needed = self.percent * (low[a] + low[b])
        found = (100 + self.percent) * np.minimum(high[a], high[b]) >= needed
        at = np.flatnonzero(found)
        overlap = bits_of(maps[a[at]] & maps[b[at]]) + np.minimum(shared[a[at]], shared[b[at]])
        found[at] = (100 + self.percent) * overlap >= needed[at]
        return found

    def pairs(self, labels: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of documents that may link, by dual traversal; pairs of equal ``labels`` are left out.

        ``labels`` may change between steps: whatever got connected meanwhile is pruned too.
        """
        top = len(self.levels) - 1
        stack = [(top, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
        step = max(1, STEP_WORDS // self.levels[0][0].shape[1])
        uniform, seen = self._uniform(labels), labels.copy()
        while stack:
            level, a, b = stack.pop()
            if len(a) > step:
                stack.append((level, a[step:], b[step:]))
                a, b = a[:step], b[:step]
            if not np.array_equal(seen, labels):
                uniform, seen = self._uniform(labels), labels.copy()
            named = uniform[level]
            keep = (named[a] != named[b]) | (named[a] < 0) | (named[b] < 0)
            if level == 0:
                keep &= a != b
            a, b = a[keep], b[keep]
            keep = self.may_link(level, a, b)
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            if level == 0:
                yield self.order[a], self.order[b]
                continue
            below = len(self.levels[level - 1][1])
            i, j = np.divmod(np.arange(FANOUT * FANOUT), FANOUT)
            left, right = (a[:, None] * FANOUT + i).ravel(), (b[:, None] * FANOUT + j).ravel()
            inside = (left <= right) & (left < below) & (right < below)
            stack.append((level - 1, left[inside], right[inside]))

    def _uniform(self, labels: np.ndarray) -> list[np.ndarray]:
        """Per level the label that all documents below a node have, or -1."""
        found = [labels[self.order]]
        for _ in self.levels[1:]:
            at = np.arange(0, len(found[-1]), FANOUT)
            low, high = np.minimum.reduceat(found[-1], at), np.maximum.reduceat(found[-1], at)
            found.append(np.where(low == high, low, -1))
        return found


def by_width(words: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Documents to compare at each bitmap width: those of it and, folded, of the next. Sizes of links allow no more."""
    for width in np.unique(words):
        yield int(width), np.flatnonzero((words == width) | (words == 2 * width))


def tree_pairs(sizes: np.ndarray, maps: list[np.ndarray], percent: int, labels: np.ndarray) -> Iterator[tuple[int, int]]:
    """Candidate pairs of a group whose labels differ when they come up; the caller may merge labels meanwhile."""
    words = np.array([len(m) for m in maps])
    for width, rows in by_width(words):
        stacked = np.stack([folded(maps[i][None, :], width)[0] for i in rows])
        own = labels[rows]
        tree = SignatureTree(sizes[rows], stacked, percent)
        wide = words[rows] > width  # pairs of these are compared at their own width
        for a, b in tree.pairs(own):
            for i, j in zip(a.tolist(), b.tolist()):
                x, y = int(rows[i]), int(rows[j])
                if not (wide[i] and wide[j]) and labels[x] != labels[y]:
                    yield x, y
            own[:] = labels[rows]


def merge(labels: np.ndarray, a: int, b: int) -> None:
    low, high = sorted((labels[a], labels[b]))
    labels[labels == high] = low


# --- Spark


def runs(batches: Iterator[pa.RecordBatch], keys: list[str], many: int = 1) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches -> tables of whole groups, with the groups' starts (one more than groups)."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
        if not table.num_rows:
            continue
        changes = np.zeros(table.num_rows, dtype=bool)
        changes[0] = True
        for key in keys:
            values = table[key].to_numpy()
            changes[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(changes)
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts
        held = table.slice(starts[-1])
    if held is not None and held.num_rows:
        yield held, np.array([0, held.num_rows])


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    values, at = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(at[:-1], at[1:])]


def shingle_sets(docs: DataFrame, n: int, finish, ddl: str, schema: pa.Schema) -> DataFrame:
    """``finish(doc_id, tokens)`` -> a row, for each row of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(batch.column(1)):
                words, at = hashed_words(part)
                sets = hashed_shingles(words, at, n)
                ids = batch.column(0).slice(first, len(part)).to_pylist()
                columns = zip(*[finish(i, s) for i, s in zip(ids, sets)])
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)

    return docs.mapInArrow(run, ddl)


LONGS = pa.list_(pa.int64())
SET_DDL, SET_SCHEMA = "cls long, n int, tokens array<long>", pa.schema([("cls", pa.int64()), ("n", pa.int32()), ("tokens", LONGS)])


def class_of(tokens: np.ndarray) -> int:
    """Name of a set: a hash of it."""
    parts = np.array([tokens.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(tokens), initial=0), len(tokens)], dtype=np.uint64)
    return int(mix(np.cumsum(mix(parts + np.arange(3, dtype=np.uint64)))).view(np.int64)[-1])


def small(table: DataFrame) -> DataFrame:
    """A written table of short rows, marked for broadcast when it has few enough."""
    return F.broadcast(table) if rows_of(table) <= BROADCAST_ROWS else table


def candidate_links(filed: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """``filed`` (token, cls; written), ``maps`` (cls, n, map) -> links (a, b) that span the candidate groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in runs(batches, ["token"]):
            names, sizes = table["cls"].to_numpy(), table["n"].to_numpy().astype(np.int64)
            maps = [np.frombuffer(m.as_buffer(), dtype=np.uint64) for m in table["map"].combine_chunks()]
            small, links = np.zeros(table.num_rows, dtype=bool), []
            for start, count in zip(starts, np.diff(starts)):
                if count <= SINGLE:
                    small[start : start + count] = True
                    continue
                labels = np.arange(count)
                for a, b in tree_pairs(sizes[start : start + count], maps[start : start + count], percent, labels):
                    merge(labels, a, b)
                    links.append((names[start + a], names[start + b]))
            if small.any():
                links += _small_blocks(table["token"].to_numpy(), names, sizes, maps, small, percent)
            if links:
                a, b = zip(*set(links))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    mark = F.xxhash64("cls")
    counts = filed.groupBy("token").agg(
        F.count(F.lit(1)).alias("c"),
        F.min("cls").alias("hub"),
        F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF))).alias("s"),
        F.sum(F.shiftrightunsigned(mark, 32)).alias("t"),
    )
    # Near copies share most of their prefixes: blocks of the same classes are compared once.
    kept = counts.where("c > 1").groupBy("c", "hub", "s", "t").agg(F.min("token").alias("token")).select("token", "c", "hub")
    kept = materialise(packed(kept, rows_of(filed)), "jaccard-kept")
    counted = materialise(packed(filed.join(small(kept), "token"), rows_of(filed)), "jaccard-blocks")
    whole = counted.where(F.col("c") > CHUNK).select(F.col("hub").alias("a"), F.col("cls").alias("b")).where("a <> b")
    blocks = counted.where(F.col("c") <= CHUNK).select("token", "cls").join(maps, "cls")
    dealt = packed(blocks.repartition("token"), rows_of(counted), MAPS_EACH)
    trees = dealt.sortWithinPartitions("token").mapInArrow(run, "a long, b long")
    return trees.unionByName(whole)


def _small_blocks(tokens, names, sizes, maps, small, percent) -> list[tuple[int, int]]:
    """Pairs of all one-node blocks at once."""
    left, right = [], []
    for apart in range(1, SINGLE):
        same = np.flatnonzero((tokens[apart:] == tokens[:-apart]) & small[apart:] & small[:-apart])
        left.append(same), right.append(same + apart)
    a, b = np.concatenate(left), np.concatenate(right)
    low, high = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
    fits = 100 * low >= percent * high
    a, b, found = a[fits], b[fits], []
    words = np.array([len(m) for m in maps])
    for width in np.unique(np.minimum(words[a], words[b])) if len(a) else ():
        at = np.flatnonzero(np.minimum(words[a], words[b]) == width)
        step = max(1, STEP_WORDS // int(width))
        for k in range(0, len(at), step):
            x, y = a[at[k : k + step]], b[at[k : k + step]]
            x_maps = np.stack([folded(maps[i][None, :], width)[0] for i in x])
            y_maps = np.stack([folded(maps[i][None, :], width)[0] for i in y])
            extra = np.minimum(sizes[x] - bits_of(x_maps), sizes[y] - bits_of(y_maps))
            overlap = bits_of(x_maps & y_maps) + extra
            may = (100 + percent) * overlap >= percent * (sizes[x] + sizes[y])
            found += list(zip(names[x[may]].tolist(), names[y[may]].tolist()))
    return found


def checked_links(members: DataFrame, cells: DataFrame, percent: int, rows: int | None = None) -> DataFrame:
    """Links (a, b) that connect what is connected in each cell: two chunks of a group, or one with itself.

    ``members``: group, chunk, label, cls, n, tokens. ``cells``: group, i, j. A task gets several small cells.
    """
    sides = cells.select("group", "i", "j", F.col("i").alias("chunk")).unionByName(
        cells.where("i <> j").select("group", "i", "j", F.col("j").alias("chunk"))
    )
    sides = materialise(sides, "jaccard-cells")
    placed = members.join(small(sides), ["group", "chunk"]).select("group", "i", "j", "label", "cls", "n", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in runs(batches, ["group", "i", "j"]):
            links = []
            for start, end in zip(starts, starts[1:]):
                part = table.slice(start, end - start)
                if part.num_rows < 2:
                    continue
                names, sizes, sets = part["cls"].to_numpy(), part["n"].to_numpy().astype(np.int64), _lists(part["tokens"])
                labels = np.unique(part["label"].to_numpy(), return_inverse=True)[1]
                for a, b in tree_pairs(sizes, [bitmap(s) for s in sets], percent, labels):
                    common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                    if 100 * common >= percent * (sizes[a] + sizes[b] - common):
                        merge(labels, a, b)
                        links.append((names[a], names[b]))
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    keys = ["group", "i", "j"]
    dealt = packed(placed.repartition(*keys), CHUNK * rows_of(sides) if rows is None else rows, CHUNK)
    return dealt.sortWithinPartitions(*keys, "cls").mapInArrow(run, "a long, b long")


def check_groups(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect the classes of each candidate group as all their exact links do.

    ``members`` (written): group, chunk, cls, n, tokens.
    """
    many = rows_of(members)
    alone_members = members.withColumn("label", F.col("cls"))
    chunks = materialise(packed(members.select("group", "chunk").distinct(), many), "jaccard-chunks")
    cells = chunks.select("group", F.col("chunk").alias("i"), F.col("chunk").alias("j"))
    alone = materialise(checked_links(alone_members, cells, percent, many), "jaccard-links")
    several = chunks.where("chunk > 0").select("group", F.col("chunk").alias("j"))
    if not several.limit(1).count():
        return alone
    of_several = materialise(packed(several.select("group").distinct(), rows_of(chunks)), "jaccard-large")
    large = members.join(small(of_several), "group", "left_semi")

    def labelled(links: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The members of large groups by what is connected so far; fewer links that connect the same."""
        known = connected_components(links).select(F.col("node").alias("cls"), F.col("component").alias("label"))
        known = materialise(known, "jaccard-labels")
        named = large.join(small(known), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
        return named, known.select(F.col("label").alias("a"), F.col("cls").alias("b"))

    now, links = labelled(alone)
    first = materialise(checked_links(now, several.select("group", F.lit(0).alias("i"), "j"), percent), "jaccard-links")
    now, links = labelled(links.unionByName(first))
    held = now.groupBy("group", "chunk").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    # Chunks connected as a whole to what most of their group is connected to need no look at each other: only the odd
    # ones are paired, with all.
    held = materialise(packed(held, rows_of(chunks)), "jaccard-held")
    usual = held.where("low = high").groupBy("group", "low").count()
    usual = usual.groupBy("group").agg(F.max_by("low", F.struct("count", "low")).alias("usual"))
    marked = held.join(usual, "group", "left")
    odd = marked.where(F.col("usual").isNull() | (F.col("low") != F.col("high")) | (F.col("low") != F.col("usual")))
    a, b = odd.alias("a"), marked.alias("b")
    is_odd = F.col("b.usual").isNull() | (F.col("b.low") != F.col("b.high")) | (F.col("b.low") != F.col("b.usual"))
    differ = (F.col("a.low") != F.col("a.high")) | (F.col("b.low") != F.col("b.high")) | (F.col("a.low") != F.col("b.low"))
    open_cells = (
        a.join(b, (F.col("a.group") == F.col("b.group")) & (F.col("a.chunk") != F.col("b.chunk")))
        .where((F.least("a.chunk", "b.chunk") > 0) & differ & (~is_odd | (F.col("a.chunk") < F.col("b.chunk"))))
        .select(F.col("a.group").alias("group"), F.least("a.chunk", "b.chunk").alias("i"), F.greatest("a.chunk", "b.chunk").alias("j"))
    )
    open_cells = materialise(open_cells, "jaccard-open")
    return links.unionByName(checked_links(now, open_cells, percent)) if rows_of(open_cells) else links


def similarity_components(docs: DataFrame, n: int = 5, percent: int = 75) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def filed(doc_id, tokens: np.ndarray) -> tuple:
        prefix = prefix_of(tokens, np.zeros(len(tokens), dtype=bool), percent)
        return doc_id, len(tokens), class_of(tokens), prefix.view(np.int64), bitmap(tokens).tobytes()

    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("cls", pa.int64()), ("prefix", LONGS), ("map", pa.binary())])
    rows = materialise(
        shingle_sets(docs, n, filed, "doc_id long, n int, cls long, prefix array<long>, map binary", schema), "jaccard-rows"
    )
    own = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = own.groupBy("cls").agg(F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("many"))
    classes = materialise(packed(classes, rows_of(rows)), "jaccard-classes")
    repeated = _repeats(own)
    # One row per class. Only rows of classes that have several are shuffled for it.
    copied = materialise(classes.where("many > 1").select("cls", "head"), "jaccard-copied")
    firsts = own.join(small(copied), "cls").where("doc_id = head").drop("head").dropDuplicates(["cls"])
    firsts = materialise(packed(firsts, rows_of(copied), MAPS_EACH), "jaccard-firsts")
    heads = own.join(small(copied.select("cls")), "cls", "left_anti").unionByName(firsts)
    posted = heads.select("cls", F.explode("prefix").alias("token"))
    most = PREFIX * rows_of(classes)
    counts = posted.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    counts = materialise(packed(counts, most), "jaccard-counts")
    cold = counts.where(F.col("c") <= HOT).select("token")
    blocks = posted.join(small(materialise(cold, "jaccard-cold")), "token", "left_semi")

    hot = _most_frequent(counts, HOT_LIST)
    if len(hot):
        # Shingles that come into prefixes in place of the frequent ones may be frequent too.
        refiled = materialise(packed(_refiled(docs, n, hot, hot, percent).distinct(), most), "jaccard-refiled")
        again = refiled.groupBy("token").agg(F.count(F.lit(1)).alias("c"))
        last = np.union1d(hot, _most_frequent(again, max(0, HOT_LIST - len(hot))))
        if len(last) > len(hot):
            refiled = materialise(packed(_refiled(docs, n, hot, last, percent).distinct(), most), "jaccard-refiled")
        blocks = blocks.unionByName(refiled.select("cls", "token"))
        if len(hot) >= HOT_LIST:  # frequent shingles beyond the list are blocks like others
            rest = counts.where(F.col("c") > HOT).select("token").join(_as_table(docs, hot), "token", "left_anti")
            blocks = blocks.unionByName(posted.join(rest, "token", "left_semi"))
    filed = materialise(packed(blocks.distinct(), most), "jaccard-filed")
    candidates = candidate_links(filed, heads.select("cls", "n", "map"), percent)
    groups = connected_components(candidates)
    links = check_groups(_members(docs, n, classes, groups, repeated), percent)
    if repeated:
        # Rows of one doc_id are one document: its classes are connected.
        first = own.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).where("a <> z").select("doc_id", "a")
        links = links.unionByName(own.join(first, "doc_id").select("a", F.col("cls").alias("b")).where("a <> b"))
    found = connected_components(links).withColumnRenamed("node", "cls")

    placed = classes.join(found, "cls", "left").select("cls", "head", F.coalesce("component", "cls").alias("group"))
    placed = materialise(packed(placed, rows_of(classes)), "jaccard-placed")
    # A component or a class may hold a third of all rows: looked up by broadcast or with salted keys.
    least = placed.groupBy("group").agg(F.min("head").alias("component"))
    least = materialise(packed(least, rows_of(placed)), "jaccard-least")
    named = lookup(placed, least, "group", 24, F.col("cls"), rows=rows_of(least)).select("cls", "component")
    result = lookup(rows.select("doc_id", "n", "cls"), materialise(named, "jaccard-named"), "cls", 24, F.col("doc_id"), "left", rows=rows_of(placed))
    # An empty set links with nothing, and a row without an id takes no part.
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")))
    return result.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"))


def _members(docs: DataFrame, n: int, classes: DataFrame, groups: DataFrame, repeated: bool) -> DataFrame:
    """The whole sets of the classes in candidate groups, in chunks: group, chunk, cls, n, tokens.

    ``repeated`` tells whether a doc_id has several sets, so that a class may come from several rows.
    """
    sized = packed(groups.groupBy("component").agg(F.count(F.lit(1)).alias("many")), rows_of(classes))
    sized = materialise(sized, "jaccard-sized")
    places = lookup(groups, sized, "component", 24, F.col("node"), rows=rows_of(sized)).select(
        F.col("component").alias("group"),
        F.col("node").alias("cls"),
        F.pmod(F.xxhash64("node"), F.ceil(F.col("many") / CHUNK)).cast("int").alias("chunk"),
    )
    places = materialise(packed(places.join(classes.select("cls", "head"), "cls"), rows_of(classes)), "jaccard-places")
    texts = docs.join(small(places).select(F.col("head").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = shingle_sets(texts, n, lambda i, s: (class_of(s), len(s), s.view(np.int64)), SET_DDL, SET_SCHEMA)
    members = sets.join(small(places).drop("head"), "cls").select("group", "chunk", "cls", "n", "tokens")
    members = members.dropDuplicates(["cls"]) if repeated else members
    return materialise(members, "jaccard-members")


def _repeats(rows: DataFrame) -> bool:
    return rows.groupBy("doc_id").count().where("count > 1").limit(1).count() > 0


def _most_frequent(counts: DataFrame, most: int) -> np.ndarray:
    """The frequent shingles, ascending; ``most`` at most."""
    top = materialise(counts.where(F.col("c") > HOT), "jaccard-hot")
    if rows_of(top) > most:
        top = top.orderBy(F.col("c").desc(), "token").limit(most)
    return np.sort(top.select("token").toArrow()["token"].to_numpy().view(np.uint64))


def _as_table(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    return docs.sparkSession.createDataFrame(pa.table({"token": hot.view(np.int64)}))


def _refiled(docs: DataFrame, n: int, flags: np.ndarray, last: np.ndarray, percent: int) -> DataFrame:
    """(cls, token) of documents with one of ``flags`` in their prefix, by the order that has ``last`` last."""

    def filed(_, tokens: np.ndarray) -> tuple:
        plain = prefix_of(tokens, np.zeros(len(tokens), dtype=bool), percent)
        if not _among(plain, flags).any():
            return 0, None
        return class_of(tokens), prefix_of(tokens, _among(tokens, last), percent).view(np.int64)

    schema = pa.schema([("cls", pa.int64()), ("prefix", LONGS)])
    found = shingle_sets(docs.where("doc_id IS NOT NULL"), n, filed, "cls long, prefix array<long>", schema)
    return found.where("prefix IS NOT NULL").select("cls", F.explode("prefix").alias("token"))


def _among(tokens: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
    return known[at] == tokens
