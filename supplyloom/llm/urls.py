"""URL filters: fixed host and path rules, and association rules mined from labelled URLs.

A URL falls into items (scheme, host labels, path segments, query keys, ...). Spark's
FP-growth mines the item sets that are frequent among labelled URLs; those that imply ``block`` with enough
confidence and lift become rules, without rules that a shorter one with the same confidence covers. A rule is filed
under its rarest item (the inverted index); a URL meets only the rules filed under one of its items and is blocked by
any whose items it all has. Equal item sets are matched once, however many URLs share them.

Defined cases: a null url, or one without ``://``, has an empty host and path and no items, and is allowed; labels
that are null or of unknown pages are passed over; without labels there are no mined rules and the default is allow;
repeated rows are judged each; further columns are passed over.
"""

from __future__ import annotations

import math
import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyloom.storage import materialise, rows_of

#: (host, path, verdict). Fixed values of the filter's contract.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
BLOCK = "label=block"
#: A mined rule holds for this part of the labelled URLs at least, and is right this often.
MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT = 0.002, 0.5, 1.5
#: Rows a rule must hold for in any case: on fewer, its confidence says nothing.
MIN_ROWS = 20


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))


def items_of(url: Column) -> Column:
    """The URL's distinct items; runs of digits count as one shape, so that page numbers do not make every URL new."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    rest = F.regexp_extract(_after_scheme(url), r"^[^?#]*(.*)$", 1)
    segments = F.filter(F.split(F.regexp_replace(path, r"[0-9]+", "0"), "/"), lambda s: s != "")
    keys = F.regexp_extract_all(F.regexp_extract(rest, r"^\?([^#]*)", 1), F.lit(r"([^=&]+)[^&]*"), 1)
    named = lambda name, found: F.transform(found, lambda x: F.concat(F.lit(name + "="), x))
    none = F.array().cast("array<string>")
    items = F.concat(
        F.array(F.concat(F.lit("scheme="), F.substring_index(url, "://", 1))),
        named("host", labels),
        named("word", F.flatten(F.transform(labels, lambda x: F.when(F.instr(x, "-") > 0, F.split(x, "-")).otherwise(none)))),
        named("path", segments),
        named("key", keys),
        F.array(F.concat(F.lit("ends="), F.regexp_extract(path, r"(/|\.[A-Za-z0-9]+)?$", 1))),
        F.when(F.instr(rest, "#") > 0, F.array(F.lit("fragment"))).otherwise(none),
    )
    return F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) > 0, F.array_sort(F.array_distinct(items))).otherwise(none)


def rule_struct(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """Struct (rule, verdict) of the longest fixed rule that fits; null fields when none does."""
    longest_first = sorted(rules, key=lambda r: -len(r[0] + r[1]))  # the first of equal length wins
    chosen = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    for rule_host, rule_path, verdict in reversed(longest_first):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        chosen = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def item_classes(labelled: DataFrame, least: int) -> DataFrame:
    """``item, class``: items on ``least`` rows or more, but not on all; those on exactly the same rows share a class.

    Items that always come together would double the frequent sets with each of them and say nothing more, so
    FP-growth gets one for all. Sums of two row hashes tell which rows an item is on.
    """
    total = labelled.count()
    on = labelled.select(F.explode("items").alias("item"), F.xxhash64("items", "blocked").alias("row"))
    marks = on.groupBy("item").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("row").bitwiseAND(F.lit(0xFFFFFFFF))).alias("a"),
        F.sum(F.shiftrightunsigned("row", 32)).alias("b"),
    )
    frequent = marks.where((F.col("n") >= least) & (F.col("n") < total))
    return frequent.select("item", F.min("item").over(Window.partitionBy("n", "a", "b")).alias("class"))


def mine_rules(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_lift: float = MIN_LIFT,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """``(items, blocked)`` rows -> rules ``(rule_items, anchor, confidence, support, lift)`` that imply block."""
    labelled = materialise(labelled.where(F.size("items") > 0), "url-labelled")
    support = max(min_support, min_rows / max(min_rows, rows_of(labelled)))
    classes = item_classes(labelled, math.ceil(support * rows_of(labelled)))
    distinct = labelled.select("items").distinct()
    reduced = (
        distinct.withColumn("item", F.explode("items"))
        .join(classes, "item")
        .groupBy("items")
        .agg(F.collect_set("class").alias("classes"))
    )
    label = F.when(F.col("blocked"), F.array(F.lit(BLOCK))).otherwise(F.array().cast("array<string>"))
    rows = labelled.join(reduced, "items").select(F.concat("classes", label).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(rows)
    frequent = model.freqItemsets
    implied = (
        model.associationRules.where((F.size("consequent") == 1) & F.array_contains("consequent", BLOCK))
        .where(F.col("lift") >= min_lift)
        .select(F.array_sort("antecedent").alias("rule_items"), "confidence", "support", "lift")
    )
    rules = materialise(implied, "url-rules")
    # Filed under the rarest item.
    singles = frequent.where(F.size("items") == 1).select(F.col("items")[0].alias("item"), "freq")
    anchored = (
        rules.withColumn("item", F.explode("rule_items"))
        .join(singles, "item")
        .groupBy("rule_items", "confidence", "support", "lift")
        .agg(F.min(F.struct("freq", "item"))["item"].alias("anchor"))
    )
    # A rule adds nothing beside one with some of its items and no less confidence, which is found by those items.
    parts = anchored.withColumn("item", F.explode("rule_items")).alias("r")
    shorter = anchored.alias("s")
    covered = (
        parts.join(shorter, F.col("r.item") == F.col("s.anchor"))
        .where(F.size("s.rule_items") < F.size("r.rule_items"))
        .where(F.size(F.array_except("s.rule_items", "r.rule_items")) == 0)
        .where(F.col("s.confidence") >= F.col("r.confidence"))
        .select(F.col("r.rule_items").alias("rule_items"))
        .distinct()
    )
    return materialise(anchored.join(covered, "rule_items", "left_anti"), "url-index")


def match_rules(item_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``items`` that some rule blocks, with the best rule's ``confidence``, by the inverted index."""
    return (
        item_sets.select("items")
        .distinct()
        .withColumn("anchor", F.explode("items"))
        .join(rules, "anchor")
        .where(F.size(F.array_except("rule_items", "items")) == 0)
        .groupBy("items")
        .agg(F.max(F.struct("confidence", "support", "rule_items")).alias("mined"))
    )


def judge(pages: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("page_id",), rules: tuple = RULES) -> DataFrame:
    """``pages`` (page_id, url) and ``labels`` (page_id, blocked) -> keep, host, path, rule, verdict, mined items."""
    url = F.col("url")
    names = dict.fromkeys([*keep, "page_id"])
    split = pages.select(*names, host_of(url).alias("host"), path_of(url).alias("path"), items_of(url).alias("items"))
    split = split.withColumn("host", F.coalesce("host", F.lit(""))).withColumn("path", F.coalesce("path", F.lit("")))
    known = labels.where(F.col("blocked").isNotNull()).select(F.col("page_id").alias("labelled_id"), "blocked")
    labelled = split.join(known, F.col("page_id") == F.col("labelled_id")).select("items", "blocked")
    mined = match_rules(split, mine_rules(labelled))
    fixed = rule_struct(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("mined").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return (
        split.join(mined, "items", "left")
        .withColumn("fixed", fixed)
        .select(
            *keep,
            "host",
            "path",
            F.col("fixed.rule").alias("rule"),
            F.coalesce("fixed.verdict", method).alias("verdict"),
            F.array_join("mined.rule_items", " ").alias("mined_rule"),
        )
    )
