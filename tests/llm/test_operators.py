"""Operators against brute force, held-out labels and exact inverses."""

import hashlib
import html
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import difference
from supplyloom.llm import catalog, chat, extract, fingerprint, latent, mixing, quality, secrets, urls


def read(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def test_every_query_is_registered():
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {n.split("_")[0] + "_" for n in names if n.startswith("op") and n[2].isdigit()}
    assert "pipeline" in names and set(catalog.oracle_sql()) <= names


def test_mix_like_sql(spark, sf):
    assert difference(spark, "op7", sf, catalog.op7_source_mix, catalog.OP7_SQL) is None


def test_mix_meets_targets(spark, sf):
    rows = catalog.op7_source_mix(spark, sf).collect()
    assert sorted(map(str, rows)) == sorted(map(str, catalog.op7_source_mix(spark, sf).collect()))
    assert sum(r.taken for r in rows) == pytest.approx(1.5 * sum(r["size"] for r in rows), rel=0.05)
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in rows)


def test_mix_is_read_back_from_its_copies(spark, sf, monkeypatch):
    """What the query tells of a document is what the ordered mix holds: without the second copies, half of it."""
    whole, order = mixing.training_order, catalog.op7_source_mix(spark, sf).collect()
    monkeypatch.setattr(mixing, "training_order", lambda mixed: whole(mixed).where("epoch = 0"))
    once = catalog.op7_source_mix(spark, sf).collect()
    assert any(r.taken == 2 * r["size"] > 0 for r in order) and all(r.taken in (0, r["size"]) for r in once)
    assert sorted((r.doc_id, r.position is None) for r in once) == sorted((r.doc_id, r.position is None) for r in order)


def test_mix_digest_keeps_repeated_rows(spark):
    rows = [(1, "a", "x y"), (1, "a", "x y"), (None, "a", "z"), (None, None, "z"), (2, None, ""), (3, "a", None)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), keep=("source",))
    found = mixing.digest_mix(mixed, mixing.training_order(mixed))
    same = lambda df: sorted(map(str, df.select("doc_id", "size", "source_size", "target", "taken").collect()))
    assert same(found) == same(mixed) and len(same(found)) == len(rows)
    assert found.where("(taken > 0) <> (position is not null)").count() == 0


def test_schedules_are_inverted(spark):
    knots = ((0.0, 2.0), (0.25, 0.0), (0.5, 0.0), (1.0, 3.0))
    demands = [i / 20 for i in range(20)]
    df = spark.createDataFrame([(d,) for d in demands], "d double")
    at = [r[0] for r in df.select(mixing.position_of(mixing._segments(knots), F.col("d"))).collect()]
    fine = np.linspace(0, 1, 200_001)
    weight = np.interp(fine, [k[0] for k in knots], [k[1] for k in knots])
    area = np.cumsum(weight) / weight.sum()
    for d, t in zip(demands, at):
        assert abs(np.interp(t, fine, area) - d) < 1e-4


def test_url_rules_like_brute_force(spark, sf):
    pages = read(spark, sf, "pages")
    text = {r.page_id: r.url for r in pages.collect()}
    for r in catalog.op2_url_filter(spark, sf).collect():
        rest = text[r.page_id].split("://", 1)[1]
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        fits = [x for x in urls.RULES if (host.lower() == x[0] or host.lower().endswith("." + x[0])) and path.startswith(x[1])]
        best = max(fits, key=lambda x: len(x[0] + x[1]), default=None)
        assert (r.host, r.path, r.rule) == (host.lower(), path, best and best[0] + best[1])
        if best:
            assert r.verdict == best[2]


def test_mined_rules_like_brute_force(spark):
    """Rules of up to three items, with support and confidence counted by hand."""
    draw = random.Random(5)
    rows = []
    for _ in range(400):
        items = {draw.choice("ab"), draw.choice("cde"), draw.choice("fg"), "always"}
        spam = {"a", "c"} <= items and draw.random() < 0.9 or draw.random() < 0.05
        rows.append((sorted(items), bool(spam)))
    mined = urls.mine_rules(spark.createDataFrame(rows, "items array<string>, blocked boolean"), 0.05, 0.6, 1.5, 5)
    rules = mined.collect()
    wanted = {}
    for size in (1, 2, 3):
        for items in itertools.combinations("abcdefg", size):
            on = [b for i, b in rows if set(items) <= set(i)]
            base = sum(b for _, b in rows) / len(rows)
            if on and sum(on) >= 0.05 * len(rows) and sum(on) / len(on) >= max(0.6, 1.5 * base):
                wanted[items] = sum(on) / len(on)
    kept = {k for k, c in wanted.items() if not any(set(o) < set(k) and wanted[o] >= c for o in wanted)}
    assert {tuple(r.rule_items) for r in rules} == kept and ("a", "c") in kept
    assert all(abs(r.confidence - wanted[tuple(r.rule_items)]) < 1e-9 for r in rules)
    sets = spark.createDataFrame([(sorted(s),) for s in ({"a", "c", "x"}, {"a", "d"}, {"c"})], "items array<string>")
    assert [r["items"] for r in urls.match_rules(sets, mined).collect()] == [["a", "c", "x"]]


def test_secrets():
    text = 'x = 1\npassword = "short"\napi_key: abcdefgh12\nAKIAABCDEFGHIJKL AKIA1\n' + "f" * 32 + " " + "0" * 31
    base = {(k, text[a:b]) for a, b, k in secrets.base_spans(text)}
    assert base == {("assign", "api_key: abcdefgh12"), ("access", "AKIAABCDEFGHIJKL"), ("hex", "f" * 32)}
    # names propagate: a constant under a plain name reaches a sensitive target
    code = 'base = "Zx81kQp0aB7t"\nother = "harmless-value-42x"\nconfig.clientSecret = base\n{"db_passwd": "q9W!xL2m#Pz"}\nPASSWORD="changeme123"'
    found = {code[a:b] for a, b, _ in secrets.literal_spans(code)}
    assert found == {"Zx81kQp0aB7t", "q9W!xL2m#Pz"}
    assert secrets.all_spans("TOKEN='a'\nToken := \"é\"") == []


@pytest.mark.parametrize(
    "code, wanted",
    [
        ('password = "ab1" + "Cd2" + "eF3xyZ"', {"ab1", "Cd2", "eF3xyZ"}),
        ('os.environ["DB_PASSWORD"] = "q9W!xL2m#Pz"', {"q9W!xL2m#Pz"}),
        ("config['api_key'] = 'k3Yz' + 'Qp81-aaZ'", {"k3Yz", "Qp81-aaZ"}),
        ('part = "Zx81k"\nsecret = part + "Qp0aB7t"', {"Zx81k", "Qp0aB7t"}),
        ('secret = part + "Qp0aB7t"\npart = "Zx81k"', {"Zx81k", "Qp0aB7t"}),
        ('a = "first-Val9"\na = "Zx81k"\ntoken = a + "Qp0aB7t"\na = "later-Val9"', {"Zx81k", "Qp0aB7t"}),
        ('title = "ab1" + "Cd2" + "eF3xyZ"', set()),
        ('password = "a" + "b"', set()),
        ('password = "change" + "me123"', set()),
    ],
)
def test_joined_literals_and_subscripts(code, wanted):
    assert {code[a:b] for a, b, _ in secrets.literal_spans(code)} == wanted


def test_quality_forward_like_plain_loops():
    """One chunk, one filter and one byte at a time."""
    network, texts = quality.ByteNetwork(), ["", "short", "a text of several chunks, é and more of it " * 3, "x" * 16, "y" * 17]
    w = network.weights
    for text in texts:
        data = list(text.encode())
        chunks = max(1, -(-max(len(data) - quality.WIDTH, 0) // quality.STRIDE) + 1)
        data += [256] * ((chunks - 1) * quality.STRIDE + quality.WIDTH - len(data))
        total = float(w["shift"][0])
        for f in range(quality.FILTERS):
            best = -math.inf
            for c in range(chunks):
                value = float(w["bias"][f])
                for i in range(quality.WIDTH):
                    for e in range(quality.EMBED):
                        value += float(w["embed"][data[c * quality.STRIDE + i], e]) * float(w["filters"][i * quality.EMBED + e, f])
                best = max(best, value)
            total += math.tanh(best) * float(w["dense"][f])
        raw = np.frombuffer(text.encode(), np.uint8)
        assert network.scores(raw, np.array([0, len(raw)]))[0] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-5)


def test_short_items_in_a_dump(spark):
    """Items of 1 to 64 words, word for word one after the other in one document, all are found."""
    draw = random.Random(12)
    word = lambda: "".join(draw.choice("abcdefghijklmnop") for _ in range(6))
    sizes = [40, 4, 40, 5, 7, 40, 3, 1, 40, 2, 6, 40, 8, 9, 40, 10, 11, 40, 12, 14, 16, 24, 32, 48, 64]
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate(sizes)]
    docs = [(100, " ".join(text for _, text in items))] + [(i, " ".join(word() for _ in range(200))) for i in range(50)]
    found = latent.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert {r.item_id for r in found if r.doc_id == 100} == set(range(len(sizes)))
    assert not [r for r in found if r.doc_id != 100]


def test_secret_spans_like_plain_patterns(spark, sf):
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    texts = {r.doc_id: r.text for r in read(spark, sf, "documents").collect()}
    for r in catalog.op4_secret_scan(spark, sf).collect():
        t = texts[r.doc_id]
        spans = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in re.finditer(pattern, t, re.I | re.A) if len(m[2]) >= 8]
        spans += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        spans += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        joined = ",".join(s for *_, s in sorted(spans))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))


def test_main_text_of_given_pages(spark, sf):
    pages = {r.page_id: r.html for r in read(spark, sf, "pages").collect()}
    for r in catalog.op5_main_text(spark, sf).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>a &lt;b&gt;&nbsp;c<p>d<br>e", "a <b> c\nd e"),
        ("<nav>x</nav><div>y</div><aside>z</aside><footer>w", "y"),
        ("<body><div>out</div><main><h1>t</h1><div class='share-bar'>s</div><p>in</p></main>", "t\nin"),
        ("<article><p>a</p><section id=comments><p>b</p></section><form><p>c</p></form></article>", "a"),
        ("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e</table>", "a\nb\nc\nd\ne"),
        ("<script>if (a<b) '</p>'</script>x<style>y</style><!-- <p>z --><p>v</p><script>never closed <p>q", "x\nv"),
        ("<p title='a>b'>c</p><div hidden>d</div><p>e<unfinish", "c\ne"),
        ("<article><header><h1>t</h1></header><p>a<b>b</b>c</p></article>", "t\nabc"),
        ("</div></p>a</b>", "a"),
    ],
)
def test_page_shapes(page, text):
    assert extract.main_text(page) == text


def test_style_tree_removes_what_pages_repeat(spark):
    """No tag or class says what it is; the site's pages do."""
    page = lambda i: (
        f"<div><div class=top><span>Home</span> <span>About</span></div><div class=text><p>Text {i} of {i * 7}</p><p>More {i}</p></div>"
        f"<div class=low>All rights</div></div>"
    )
    rows = [(i, f"http://one.org/{i}", page(i)) for i in range(12)] + [(99, "http://two.org/", page(99))]
    found = {r.page_id: r.text for r in extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[i] == f"Text {i} of {i * 7}\nMore {i}" for i in range(12))
    assert found[99].startswith("Home About")  # one page tells nothing


def test_slugs_are_no_chrome(spark):
    """Topics in names of an article's parts; the site's pages tell them from furniture."""
    page = lambda i: (
        f"<article><h1 id=cookies>Cookies {i}</h1><h2 id=search-algorithms class=header>Search {i}</h2><section id=related-work><p>Work {i}</p>"
        f"</section><section id=search><p>Find {i}</p></section><div class=social-science>Science {i}</div><h3 id=header-files>Files {i}</h3>"
        f"<p>Let <math><mi>x</mi><mo>=</mo><mn>{i}</mn></math></p><div class='social-follow'>Follow us</div><div class=share-bar>Share {i}</div>"
        f"<div class='related'>More {i}</div><div id=comments>Said {i}</div><nav>Next {i}</nav></article>"
    )
    text = lambda i: f"Cookies {i}\nSearch {i}\nWork {i}\nFind {i}\nScience {i}\nFiles {i}\nLet x={i}"
    rows = [(i, f"http://many.org/{i}", page(i)) for i in range(9)] + [(99, "http://one.org/", page(99))]
    found = {r.page_id: r.text for r in extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[i] == text(i) for i in range(9)) and found[99] == text(99) + "\nFollow us"


def test_copies_of_pages_keep_their_text(spark):
    """Hosts of copies only, copies with another date, and many copies among other pages."""
    article = lambda k, date="": (
        f"<nav>Home</nav><article><h1>Title {k}</h1><div class=date>{date}</div><div class=body><section><p>One {k}</p><p>Two</p>"
        f"</section>bare {k}</div></article>"
    )
    text = lambda k, date="": "\n".join(filter(None, (f"Title {k}", date, f"One {k}", "Two", f"bare {k}")))
    plain = "<div><div class=top>Home</div><div class=text>Words of a page</div></div>"
    given = {f"http://copies.org/?utm={i}": (article(1), text(1)) for i in range(4)}
    given |= {f"http://dated.org/{i}": (article(1, f"Day {i}"), text(1, f"Day {i}")) for i in range(6)}
    given |= {f"http://groups.org/{k}/{i}": (article(k), text(k)) for k in range(3) for i in range(20)}
    given |= {f"http://plain.org/?utm={i}": (plain, "Home\nWords of a page") for i in range(5)}
    rows = spark.createDataFrame([(u, h) for u, (h, _) in given.items()], "url string, html string")
    found = {r.url: r.text for r in extract.extract(rows, keep=("url",)).collect()}
    assert found == {u: t for u, (_, t) in given.items()}


def test_chat_round_trip(spark, sf):
    rows = {}
    for r in read(spark, sf, "conversations").orderBy("conv_id", "turn").collect():
        rows.setdefault(r.conv_id, []).append((r.role, r.text))
    rows[-7] = [("user", catalog.CONTROL_TEXT), ("assistant", catalog.CONTROL_TEXT)]
    found = {r.conv_id: r for r in catalog.op6_chat_format(spark, sf).collect()}
    assert set(found) == set(rows)
    for i, turns in rows.items():
        said = "".join(f"{a}\n{b}\n" for a, b in turns)
        learned = "".join(b for a, b in turns if a == "assistant")
        assert (found[i].n_turns, found[i].turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (found[i].loss_chars, found[i].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_hostile_texts_survive():
    import pyarrow as pa

    draw = random.Random(2)
    parts = ["<|turn|>", "<|end|>\n", "<", "[", "\\", "|", "/", "s>", "INST]", "</s>", "[/INST]", "<\\|", "\n", "é", "user", ""]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(9))) for _ in range(3000)]
    roles = ["".join(draw.choice(parts) for _ in range(draw.randrange(3))) for _ in range(3000)]
    out, starts, begin, end = chat.assemble(pa.array(roles), pa.array(texts))
    data = out.tobytes()
    assert [(a.decode(), b.decode()) for a, b in chat.parse_turns(data)] == list(zip(roles, texts))
    assert [chat.unescape(data[a:b]).decode() for a, b in zip(begin, end)] == texts and starts[-1] == len(data)


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in read(spark, sf, "labels").collect()}
    rows = [r for r in catalog.op8_quality_score(spark, sf).collect() if r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    rows = [r for r in rows if r.held_out]
    good, bad = ([r.score for r in rows if labels[r.doc_id] == q] for q in (1, 0))
    wins = np.mean([[(a > b) + 0.5 * (a == b) for b in bad] for a in good])
    assert wins > 0.9 and np.mean([r.predicted == labels[r.doc_id] for r in rows]) > 0.92


def test_network_gradient_and_slices():
    draw = np.random.default_rng(0)
    texts = [bytes(draw.integers(0, 256, n, dtype=np.uint8)) for n in (0, 3, 16, 17, 500, 40)]
    at = np.append(0, np.cumsum([len(t) for t in texts]))
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    wanted = np.array([0, 1, 0, 1, 1, 0], dtype=np.float32)
    net = quality.ByteNetwork()
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    loss = lambda: -np.mean(np.log(np.where(wanted == 1, p := net.scores(data, at), 1 - p)))
    for name, g in net.gradient(data, at, wanted).items():
        place = tuple(i[np.argmax(np.abs(g[np.nonzero(g)]))] for i in np.nonzero(g))
        net.weights[name][place] += 1e-5
        up = loss()
        net.weights[name][place] -= 2e-5
        assert (up - loss()) / 2e-5 == pytest.approx(g[place], rel=2e-2, abs=1e-6)
        net.weights[name][place] += 1e-5
    whole = net.scores(data, at)
    step, quality.STEP = quality.STEP, 3
    try:
        assert np.allclose(net.scores(data, at), whole)
    finally:
        quality.STEP = step


def test_fingerprints(spark, sf):
    texts = {r.doc_id: r.text for r in read(spark, sf, "documents").collect()}
    rows = {r.doc_id: r for r in catalog.op9_fingerprint(spark, sf).collect()}
    ids = sorted(texts, reverse=True)
    for i, after in zip(ids, ids[1:] + ids[:1]):
        half = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + texts[after][:half]
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and rows[i].n_chars == len(texts[i])
    by_text = {}
    for i, t in texts.items():
        by_text.setdefault(t, set()).add(rows[i].fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    assert len({f for s in by_text.values() for f in s}) == len(by_text)
    assert np.mean([r.near_edited for r in rows.values()]) > 0.3 > 0.15 > np.mean([r.near_next for r in rows.values()])


def test_fingerprints_add_up(spark):
    df = spark.createDataFrame([("a one.\nb two.", "c three.\n\nd. e", "c three.\nb two.\na one. d. e")], "x string, y string, z string")
    prints = df.select(*[fingerprint.fingerprint(c).alias(c) for c in "xyz"])
    sums = prints.select("x", "y", "z", fingerprint.insert(F.col("x"), F.col("y")).alias("both"))
    r = sums.select("*", fingerprint.delete(F.col("both"), F.col("y")).alias("back")).first()
    assert r.both == r.z and r.back == r.x and r.x != r.y


def test_native_plan(spark, sf):
    plan = catalog.op9_fingerprint(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_leaks_like_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    items = {r.item_id: r.text for r in read(spark, sf, "benchmark").collect()}
    texts = {r.doc_id: r.text for r in read(spark, sf, "documents").collect()}
    wanted = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    found = {(r.doc_id, r.item_id) for r in catalog.op10_decontaminate(spark, sf).collect()}
    assert len(wanted) > 20 and found == wanted


def test_paraphrases_are_found(spark, sf):
    """Every sixth word replaced, in upper case, inside of other text; one item in two blocks of the benchmark."""
    draw = random.Random(8)
    items = [r for r in read(spark, sf, "benchmark").collect()]
    clean = [r.text for r in read(spark, sf, "documents").limit(60).collect() if not any(i.text in r.text for i in items)]
    rows = []
    for k, item in enumerate(items):
        words = [w if j % 6 else draw.choice(clean).split()[0] for j, w in enumerate(item.text.split())]
        rows.append((k, f"{draw.choice(clean)[:900]} {' '.join(words).upper()} {draw.choice(clean)[:900]}"))
    docs = spark.createDataFrame(rows + [(1000 + i, t) for i, t in enumerate(clean)], "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in latent.find_leaks(docs, spark.createDataFrame(items)).collect()}
    wanted = {(k, item.item_id) for k, item in enumerate(items)}
    assert len(found & wanted) >= 0.9 * len(wanted) and not [d for d, _ in found if d >= 1000]


def _made_words(draw, many):
    return [draw.choice("bdfgklmnprst") + draw.choice("aeiou") + draw.choice("bdfgklmnprst") + draw.choice("aeiou") for _ in range(many)]


def test_long_and_short_items_are_found(spark):
    """Verbatim copies of items of any length, at odd places of other text."""
    draw = random.Random(11)
    sizes = {1: 300, 2: 1000, 3: 65, 4: 140, 5: 2, 6: 1, 7: 3}
    items = {i: " ".join(_made_words(draw, n)) for i, n in sizes.items()}
    items[5], items[6] = "Zorvax quill", "Ypthor!"
    items |= {n: " ".join(f"rare{n}word{j}" for j in range(n)) for n in (300, 1000)}  # weight spread evenly
    other = lambda n: " ".join(_made_words(draw, n))
    docs = [(i, f"{other(77)} {items[i]}. {other(55)}") for i in items]
    docs += [(50, f"{other(9)} quill Zorvax ypthors {other(9)}"), (51, f"{items[2][:1500]} {other(900)}"), (None, items[6])]
    docs += [(100 + i, other(400)) for i in range(150)]
    rows = latent.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(items.items()), "item_id long, text string")
    ).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(i, i) for i in items} and all(r.common == 1 for r in rows)


def test_all_near_windows_are_checked(spark):
    """A shuffled mention is nearer to the item than its copy among other benchmark words."""
    draw = random.Random(12)
    words = sorted(set(_made_words(draw, 3000)))
    draw.shuffle(words)
    items = {i: words[i * 40 : i * 40 + 40] for i in range(4)} | {9: words[200:216]}
    fill = words[300:]
    other = lambda n: [draw.choice(fill) for _ in range(n)]
    copy = items[0] + items[9] + items[1][::-1]
    docs = [(1, other(32) + items[9][11::-1] + other(300) + copy), (2, copy + other(300) + items[9][11::-1])]
    docs += [(100 + i, other(400)) for i in range(100)]
    rows = latent.find_leaks(
        spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string"),
    ).collect()
    assert {(r.doc_id, r.item_id): r.common for r in rows} == {(d, i): 1.0 for d in (1, 2) for i in (0, 9)}


def test_candidates_leave_texts_in_place(spark, monkeypatch):
    """Few spans go to the texts, many are shuffled to them; the leaks are the same, repeated and null ids included."""
    draw = random.Random(8)
    made = _made_words(draw, 400)
    items = [(i, " ".join(draw.choice(made) for _ in range(20))) for i in range(3)]
    texts = [" ".join(draw.choice(made) for _ in range(200)) for _ in range(40)]
    rows = [(i, f"{t} {items[i % 3][1]} {t}" if i % 4 == 0 else t) for i, t in enumerate(texts)] + [(4, items[1][1]), (None, items[0][1]), (99, None)]
    docs, benchmark = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")

    def leaks():
        return sorted((r.doc_id, r.item_id) for r in latent.find_leaks(docs, benchmark).collect())

    few = latent.find_leaks(docs, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in few and "SortMergeJoin" not in few
    found = leaks()
    assert {(i, i % 3) for i in range(0, 40, 4)} | {(4, 1)} <= set(found) and len(found) == len(set(found))
    monkeypatch.setattr(latent, "BROADCAST_SPANS", 0)
    assert leaks() == found


def test_spans_like_brute_force():
    draw = np.random.default_rng(3)
    row, item, place, words = (draw.integers(0, n, 300) for n in (3, 2, 400, 9))
    got = latent._spans(row, item, place, place + words + 1, draw.random(300))
    covered = {(r, i, x) for r, i, p, w in zip(row, item, place, words) for x in range(p, p + w + 1)}
    assert {(r, i, x) for r, i, a, b in zip(*got[:4]) for x in range(a, b)} == covered
    assert len(got[0]) >= len({k for k in covered if (*k[:2], k[2] - 1) not in covered})


def test_common_subsequence():
    draw = random.Random(1)
    for _ in range(200):
        a, b = ([draw.choice("abcd") for _ in range(draw.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert latent.common_length(a, b) == table[-1][-1]
