"""Main-text extraction with site style trees.

The DOMs of a host's pages are merged into one style tree: nodes are element paths (tag and classes, digits merged),
with the child sequences seen there (their presentation) and the texts seen there (their content), each counted by
pages. From these counts Spark computes importances by entropy:

- presentation, ``-sum p log_m p`` over a node's child sequences, for ``m`` pages: varied layouts matter, one fixed
  layout does not;
- content, ``1 - mean(log c / log m)`` over the texts of a node, a text being on ``c`` of ``m`` pages: what every page
  repeats does not matter;
- of a branch, ``(1 - GAMMA)`` times its own presentation plus ``GAMMA`` times the content below it, by pages.

What an element's tag, role or class says weighs its importance in the tree: that of menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and comments is scaled down (``CHROME_WEIGHT``, below ``LEAST`` even
on a site of one page), that of a marked article and of all unmarked elements in it is scaled up to ``LEAST`` and more
(copies of an article are no boilerplate), that of all others is as computed, from ``MIN_PAGES`` pages on. Branches
below ``LEAST`` go from every page of the host. In a marked article a class or id says so only if all of its words do
(``share-bar``); one that merely holds such a word (``related-work``), or names a section or paragraph by its topic
(``id=search``), is a hint: it lowers the importance (``HINT_WEIGHT``) and the site's pages decide. Names of headings
are not read. Where a page marks its article, text outside of it goes too. Pages of a
host that hold the same text but for marked chrome (mirrors, addresses with other parameters) count once.

The text is that of the remaining blocks in page order, one ``\\n`` between them; in a block, character references are
decoded, white space becomes one space and is trimmed. Defined cases: a null or empty html has an empty text; markup
cut off at the end is dropped; elements nested deeper than ``DEPTH`` count as part of their ancestor at that depth;
repeated rows count as one page and have a text each; pages without a host form a host of their own; further columns
are passed over.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyloom.llm.batches import bounded_batches
from supplyloom.llm.urls import host_of
from supplyloom.storage import materialise

DEPTH, GAMMA, LEAST, MIN_PAGES = 48, 0.9, 0.3, 4
CHROME_WEIGHT, HINT_WEIGHT = 0.25, 0.6
#: What the markup says of a node.
OTHER, CHROME, TEXT, HINT = 0, 1, 2, 3
#: Removed branches that may go to every task at once; more are joined by a salted shuffle.
BROADCAST_BRANCHES, SALTS = 200_000, 32

CHROME_TAGS = frozenset(
    "nav header footer aside form script style noscript template iframe svg button select input textarea dialog menu "
    "head object canvas audio video title annotation map datalist option".split()
)
CHROME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice alert popup modal overlay "
    "newsletter subscribe signup login share sharing social related recommended comment comments reply replies disqus "
    "widget search toolbar skip copyright pagination pager".split()
)
#: Words that say nothing of their own beside one of these; in an article, header is no chrome by itself.
PLAIN_WORDS = frozenset(
    "bar box button buttons link links list icon icons form wrapper wrap container block item items inner posts articles "
    "stories area slot unit".split()
)
#: What ids of other elements than div name as chrome; other words are as likely topics there.
CHROME_IDS = frozenset("comment comments reply replies disqus related recommended newsletter subscribe share".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
MAIN_TAGS = frozenset(("article", "main"))
RAW_TAGS = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 "
    "h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: An element that opens ends one of these that is still open, if nothing of the second set is in between.
ENDS = {"li": ("li", "ul ol"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr"), "th": ("td th", "tr"), "option": ("option", "select")}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}
P_STOPS = frozenset("td th button table object".split())

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*)>|<(?=[/A-Za-z])[^<>]*\Z""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
PARTS = re.compile(r"[A-Za-z]+")


class Element(NamedTuple):
    tag: str
    path: int
    chrome: bool
    main: bool  # an article, or in one
    node: bool  # a node of its own in the tree; what is in chrome belongs to its topmost element
    kind: int
    children: list


class Block(NamedTuple):
    text: str
    branch: tuple[int, ...]  # paths of the nodes it is in, outermost first
    path: int
    main: bool
    chrome: bool


def _hash(*parts) -> int:
    return xxhash.xxh64_intdigest("\x00".join(map(str, parts))) - (1 << 63)


def _said(parent: Element, tag: str, classes: str, name: str) -> int:
    """What an element's class and id say: CHROME, HINT or OTHER."""
    if tag in HEADINGS:
        return OTHER
    said = OTHER
    for value, chrome in ((classes, CHROME_WORDS), (name, CHROME_WORDS if tag == "div" else CHROME_IDS)):
        for token in value.lower().split():
            words = set(PARTS.findall(token))
            if CHROME_WORDS.isdisjoint(words):
                continue
            if not parent.main or (words <= chrome | PLAIN_WORDS and not words <= PLAIN_WORDS | {"header"}):
                return CHROME
            said = HINT
    return said


def _opened(parent: Element, tag: str, attributes: str, depth: int) -> Element:
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
    chrome, said = parent.chrome or (tag in CHROME_TAGS and not (tag == "header" and parent.main)), OTHER
    if not chrome and tag not in ("html", "body") and tag not in MAIN_TAGS:
        said = _said(parent, tag, found.get("class", ""), found.get("id", ""))
        chrome = (
            said == CHROME
            or found.get("role", "").lower() in CHROME_ROLES
            or "hidden" in found
            or found.get("aria-hidden") == "true"
        )
    main = not chrome and (parent.main or tag in MAIN_TAGS or found.get("role", "").lower() == "main")
    kind = CHROME if chrome else HINT if said == HINT else TEXT if main else OTHER
    label = f"{tag}.{re.sub('[0-9]+', '0', found.get('class', '').lower())}"
    node = depth < DEPTH and not parent.chrome and tag not in ("html", "body")
    path = _hash(parent.path, label, kind) if node or tag in ("html", "body") else parent.path
    parent.children.append(label)
    return Element(tag, path, chrome, main, node, kind, [])


def read_page(html: str) -> tuple[list[Block], list[tuple[int, int, int]], bool]:
    """Blocks in page order; (path, kind, child sequence) of each node; whether a main part is marked."""
    root = Element("", 0, False, False, False, OTHER, [])
    stack, blocks, styles, pieces, marked = [root], [], [], [], False
    open_tags: Counter[str] = Counter()

    def end_block() -> None:
        text = " ".join(references.unescape("".join(pieces)).split())
        pieces.clear()
        top = stack[-1]
        if text:
            blocks.append(Block(text, tuple(dict.fromkeys(e.path for e in stack if e.node)), top.path, top.main, top.chrome))

    def close(count: int) -> None:
        for _ in range(count):
            if stack[-1].tag in BLOCK_TAGS or stack[-1].chrome:
                end_block()
            done = stack.pop()
            open_tags[done.tag] -= 1
            if done.node:
                styles.append((done.path, done.kind, _hash(*done.children)))

    def close_within(tags: frozenset, stops: frozenset) -> None:
        if not any(open_tags[t] for t in tags):
            return
        for back in range(1, len(stack)):
            tag = stack[-back].tag
            if tag in tags:
                close(back)
                return
            if tag in stops:
                return

    at, low = 0, None
    while m := MARKUP.search(html, at):
        if m.start() > at:
            pieces.append(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            back = next((k for k in range(1, len(stack)) if stack[-k].tag == tag), 0) if open_tags[tag] else 0
            close(back)
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in BLOCK_TAGS:
            close_within(frozenset(("p",)), P_STOPS)
        if tag in ENDS:
            close_within(*ENDS[tag])
        element = _opened(stack[-1], tag, m[3], len(stack))
        if tag in BLOCK_TAGS or element.chrome:
            end_block()
        marked |= element.main
        if tag in VOID_TAGS:
            continue
        stack.append(element)
        open_tags[tag] += 1
        if tag in RAW_TAGS:
            low = html.lower() if low is None else low
            end = low.find(f"</{tag}", at)
            at = len(html) if end < 0 else end
    if at < len(html):
        pieces.append(html[at:])
    close(len(stack) - 1)
    end_block()
    return blocks, styles, marked


def _content(blocks: list[Block], marked: bool) -> int:
    """What copies of a page have in common."""
    return _hash(*(b.text for b in blocks if (b.main or not marked) and not b.chrome))


def main_text(html: str, removed: frozenset | None = None) -> str:
    """Text of a page without the ``removed`` branches of its host's tree; without a tree, of what is no marked chrome."""
    blocks, _, marked = read_page(html)
    gone = (lambda b: b.chrome) if removed is None else (lambda b: not removed.isdisjoint(b.branch))
    return "\n".join(b.text for b in blocks if (b.main or not marked) and not gone(b))


NODES = pa.list_(pa.struct([("path", pa.int64()), ("kind", pa.int32()), ("said", pa.int32()), ("mark", pa.int64()), ("up", pa.list_(pa.int64()))]))
NODES_DDL = "host string, content long, nodes array<struct<path:long,kind:int,said:int,mark:long,up:array<long>>>"


def style_tree(pages: DataFrame) -> DataFrame:
    """``(host, html)`` -> ``host, path, said, importance, pages`` of all nodes with text below them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, contents = [], []
            for html in batch.column(1):
                blocks, styles, marked = read_page(html.as_py() or "")
                contents.append(_content(blocks, marked))
                nodes = {(p, 0, said, mark): () for p, said, mark in styles}
                nodes |= {(b.path, 1, OTHER, _hash(b.text)): b.branch for b in blocks if b.branch}
                names = ("path", "kind", "said", "mark")
                rows.append([dict(zip(names, node)) | {"up": list(up)} for node, up in nodes.items()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(contents, pa.int64()), pa.array(rows, NODES)], names=["host", "content", "nodes"]
            )

    # Copies count once; the least of their trees stands for them, whatever the order of rows.
    once = pages.select("host", "html").mapInArrow(run, NODES_DDL).groupBy("host", "content").agg(F.min("nodes").alias("nodes"))
    seen = once.select("host", F.explode("nodes").alias("x")).select("host", "x.*")
    marks = materialise(
        seen.groupBy("host", "path", "kind", "mark").agg(
            F.count(F.lit(1)).alias("c"), F.first("up").alias("up"), F.first("said").alias("said")
        ),
        "style-marks",
    )
    # A node is on as many pages as have a child sequence of it; a page with several counts for each.
    on = marks.where("kind = 0").groupBy("host", "path").agg(
        F.sum("c").alias("pages"), F.sum(F.col("c") * F.log("c")).alias("clogc"), F.first("said").alias("said")
    )
    m = F.col("pages").cast("double")
    # -sum p log p with p = c / m, in logarithms to the base m
    layout = F.when(m > 1, (F.log(m) - F.col("clogc") / m) / F.log(m)).otherwise(1.0)
    nodes = on.select("host", "path", "said", "pages", layout.alias("layout"))
    texts = marks.where("kind = 1").join(on.select("host", "path", "pages"), ["host", "path"], "left")
    most = F.greatest(F.coalesce("pages", F.lit(1)), F.col("c")).cast("double")
    told = F.when(most > 1, 1 - F.log("c") / F.log(most)).otherwise(1.0)
    below = (
        texts.select("host", F.explode("up").alias("path"), told.alias("told"))
        .groupBy("host", "path")
        .agg(F.avg("told").alias("content"))
    )
    computed = F.greatest((1 - GAMMA) * F.col("layout") + GAMMA * F.col("content"), F.lit(0.0))
    importance = (
        F.when(F.col("said") == CHROME, CHROME_WEIGHT * computed)
        .when(F.col("said") == TEXT, LEAST + (1 - LEAST) * computed)
        .when(F.col("pages") < MIN_PAGES, F.lit(1.0))
        .when(F.col("said") == HINT, HINT_WEIGHT * computed)
        .otherwise(computed)
    )
    return nodes.join(below, ["host", "path"]).select("host", "path", "said", importance.alias("importance"), "pages")


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``url, html`` -> ``keep`` and ``text``."""
    bounded_batches(pages.sparkSession)
    hosted = pages.select(*keep, F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"), F.col("html").alias("html"))
    low = style_tree(hosted).where(F.col("importance") < LEAST)
    removed = materialise(low.groupBy("host").agg(F.collect_list("path").alias("removed"), F.count(F.lit(1)).alias("n")), "style-removed")
    total = removed.agg(F.sum("n")).first()[0] or 0
    if total <= BROADCAST_BRANCHES:
        joined = hosted.join(F.broadcast(removed.drop("n")), "host", "left")
    else:
        salted = removed.drop("n").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = hosted.withColumn("salt", F.pmod(F.xxhash64("html"), SALTS)).join(salted, ["host", "salt"], "left").drop("salt")
    chosen = joined.select(*keep, "html", "removed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(len(keep)), batch.column(len(keep) + 1))
            texts = [main_text(html.as_py() or "", frozenset(gone.as_py() or ())) for html, gone in pairs]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, "text"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in chosen.schema.fields[: len(keep)])
    return chosen.mapInArrow(run, f"{kept}text string")
