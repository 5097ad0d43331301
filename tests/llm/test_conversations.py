"""Prefix trie and structure repair against brute force, and the cases they define."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from compare import difference
from supplyloom.llm import catalog, repair, trie

ROWS = "conv_id long, turn long, role string, text string"
NOTHING = hashlib.sha256().hexdigest()


def ordered(rows):
    digest = lambda text: hashlib.md5(text.encode()).hexdigest()
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r[3])))


# --- trie


def plain_trie(rows):
    rows = [(c, t, r or "", x or "") for c, t, r, x in rows if c is not None]
    own = {}
    for c, t, r, x in rows:
        own.setdefault(c, []).append((t is not None, t or 0, r, hashlib.md5(f"{len(r)}:{r}{x}".encode()).hexdigest(), x))
    own = {c: [(v[2], v[4]) for v in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members, kids = {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    sums, out = {}, []
    for path in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in kids.get(path, [])]
        saved = (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
        sums[path] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), len(kids.get(path, [])), *sums[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie_of(spark, rows):
    return sorted((tuple(r) for r in trie.prefix_trie(spark.createDataFrame(rows, ROWS)).collect()), key=str)


def similar_conversations(n, seed):
    """Few different turns, so that prefixes are shared at every depth."""
    draw, rows = random.Random(seed), []
    for c in range(n):
        for t in range(draw.choice([1, 2, 3, 5, 9, 14])):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", draw.choice(["a", "bb", "cé"])))
    return rows


def test_trie_like_sql(spark, sf):
    assert difference(spark, "op11", sf, catalog.op11_prefix_trie, catalog.OP11_SQL) is None


@pytest.mark.parametrize("run, segment", [(20_000, 1024), (1, 3), (7, 2), (50, 1)])
def test_trie_in_runs_and_segments(spark, monkeypatch, run, segment):
    """Runs and segments cut the work, not the result."""
    monkeypatch.setattr(trie, "RUN", run)
    monkeypatch.setattr(trie, "SEGMENT", segment)
    rows = similar_conversations(120, 4)
    assert trie_of(spark, rows) == plain_trie(rows)


def test_trie_of_copies(spark, monkeypatch):
    """One conversation most of the others equal: its members and its digest span many runs."""
    monkeypatch.setattr(trie, "RUN", 9)
    rows = [(c, t, "user", f"turn {t}") for c in range(100, 260) for t in range(4)] + similar_conversations(20, 5)
    assert trie_of(spark, rows) == plain_trie(rows)


def test_trie_cases(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (None, 0, "user", "nobody"),
        (205, 0, "user", "x" * 200_000), (205, 3, "assistant", None), (200, 1, "user", "head"), (7, 0, "system", "only"),
    ]
    assert trie_of(spark, rows) == plain_trie(rows)
    assert trie_of(spark, []) == []
    clashing = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("clash") for c in ("id", "at", "chars", "node", "parent", "head", "n")})
    assert sorted((tuple(r) for r in trie.prefix_trie(clashing).collect()), key=str) == plain_trie(rows)


def test_node_layouts():
    """A node grows through all its layouts and finds every child in each."""
    root, keys = trie.Node(b""), [bytes([i, j]) for i in range(256) for j in (0, 9)]
    seen = set()
    for i, key in enumerate(keys):
        trie.insert(root, key, i)
        seen.add(root.layout)
    assert seen == {4, 16, 48, 256}
    for i in range(256):
        middle = root.child(i)
        assert sorted(middle.child(j).ends[0] for j in (0, 9)) == [2 * i, 2 * i + 1]
        assert middle.child(1) is None


# --- repair


def plain_faults(rows):
    seen, faults = set(), []
    for role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            faults.append("b")
        elif (role, text) in seen:
            faults.append("d")
        else:
            faults.append("-" if text.rstrip(" \t\n\x0b\f\r")[-1] in ".!?" else "t")
        seen.add((role, text))
    return faults


def all_repairs(rows, faults, most):
    """Every edit sequence with up to ``most`` inserts in a row, as (cost, audit, repaired rows) of the legal results."""
    fresh = [[("I", 2, (role, ""))] for role in ("user", "assistant")]
    gaps = [list(itertools.chain.from_iterable(g)) for k in range(most + 1) for g in itertools.product(fresh, repeat=k)]
    choices = [gaps]
    for (role, text), fault in zip(rows, faults):
        edits = [[("D", 3, None)]]
        if fault not in "bd":
            late = fault == "t"
            edits += [[("K", late, (role, text))], [("R", 2 + late, ("user", text))], [("R", 2 + late, ("assistant", text))]]
        choices += [edits, gaps]
    for picked in itertools.product(*choices):
        steps = list(itertools.chain.from_iterable(picked))
        out = [s[2] for s in steps if s[2]]
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in out)):
            yield sum(s[1] for s in steps), "".join(s[0] for s in steps), out


def plain_repair(rows):
    faults = plain_faults(rows)
    cost, audit, out = min(all_repairs(rows, faults, 2), key=lambda x: x[:2])
    roles = [r[:1] for r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in out)
    return [faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()]


def expected(rows):
    """Of rows that are damaged already."""
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    out = {}
    for c in {r[0] for r in rows}:
        own = ordered([r for r in rows if r[0] == c])
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[c] = [gaps, *plain_repair([r[2:] for r in own])]
    return out


def repairs_of(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    return {r.conv_id: list(r)[1:] for r in repair.digest_repairs(df, df).collect()}


def test_plans_are_the_least_of_all(spark):
    """Against every edit sequence of short conversations."""
    draw, rows = random.Random(8), []
    for c in range(120):
        for t in range(draw.randint(1, 3)):
            rows.append((c, t + draw.randint(0, 1), draw.choice(["system", "user", "assistant", "tool", ""]), draw.choice(["a.", "b", "", " ", "c!"])))
    assert repairs_of(spark, rows) == expected(rows)


def test_blocks_give_the_same_plans(spark, monkeypatch):
    """Long conversations in blocks of three symbols, against one block of each."""
    draw, rows = random.Random(9), []
    for c in range(25):
        for t in range(draw.randint(1, 60)):
            rows.append((c, t, draw.choice(["system", "user", "assistant", "tool"]), draw.choice(["a.", "b", "", f"c{t}!", f"d{t}"])))
    whole = repairs_of(spark, rows)
    monkeypatch.setattr(repair, "BLOCK", 3)
    assert repairs_of(spark, rows) == whole


def test_weights_order_like_plans():
    plans = [(c, "".join(a)) for c in (0, 5) for k in range(4) for a in itertools.product("DIKR", repeat=k)]
    weights = [repair.weight_of(c, a, 3) for c, a in plans]
    assert [p for _, p in sorted(zip(weights, plans))] == sorted(plans)
    assert [repair.plan_of(w, 3) for w in weights] == plans


def test_damage(spark, sf):
    conversations = spark.read.parquet(f"{sf}/conversations.parquet")
    given = [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]
    given += [(None, None, None, None), (None, 1, "user", "Who?"), (9_000_001, None, None, "Null. turn")]
    wanted = []
    for c, t, r, x in given:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        row = (c, t, "user" if kind == 4 else r, "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x)
        wanted += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    got = repair.damage(spark.createDataFrame(given, ROWS)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))


def test_every_conversation_is_reported(spark, sf):
    got = {r.conv_id: r for r in catalog.op12_structure_repair(spark, sf).collect()}
    conversations = spark.read.parquet(f"{sf}/conversations.parquet")
    assert set(got) == {r[0] for r in conversations.select("conv_id").distinct().collect()}
    left = {r[0] for r in repair.damage(conversations).select("conv_id").distinct().collect()}
    for c, r in got.items():
        if c not in left:
            assert list(r)[1:] == [0] * 6 + ["", NOTHING]


def test_repair_cases(spark):
    rows = [
        (None, None, None, None), (None, 2, "user", "Hello."), (3, None, "assistant", "Early!"), (3, None, "assistant", "Early!"),
        (4, 0, "user", "long " * 50_000 + "end."), (5, 7, "system", "Only."), (6, 1, "", ""),
    ]
    assert repairs_of(spark, rows) == expected(rows)
    empty = spark.createDataFrame([], ROWS)
    assert repair.digest_repairs(empty, empty).count() == 0
    df = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("clash") for c in ("none", "conv", "audit", "kind", "at", "copy")})
    assert {r.conv_id: list(r)[1:] for r in repair.digest_repairs(df, df).collect()} == expected(rows)
