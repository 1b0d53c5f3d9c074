import math
import random
import re
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from citeloom.llm import chat_format, html_blocks, mixing, topk
from citeloom.llm.queries import OP2_SQL, OP9_SQL, op2_exact_topk, op9_chat_format
from tests.llm.helpers import DOCS, docs, sha, words


# --- exact top-k ---------------------------------------------------------------------------------


def brute_topk(rows, k=5):
    good = [(r, i, [math.floor(256 * float(np.float32(x))) for x in v]) for r, (i, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for r, i, q in good:
        if i is not None and i % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), j is None, j or 0) for s, j, c in good if s != r and len(c) == len(q))
            out += [(i, n + 1, None if none else j, -s) for n, (s, none, j) in enumerate(found[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("dim_block", [2, 16])
def test_topk(spark, dim_block):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(9)]) for i in range(230)]
    rows += [(300, [0.5, 0.25]), (301, [0.5]), (350, [0.1]), (400, None), (450, [None, 1.0]), (500, [float("nan")]), (550, [float("inf")]), (50, rows[50][1]), (None, rows[0][1]), (600, []), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("values", F.lit(1)).withColumn("rid", F.lit(2)).withColumn("dims", F.lit(3))
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, candidates=64, queries=2, dim_block=dim_block)
    assert sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()), key=str) == brute_topk(rows)


def test_topk_prunes_exactly():
    rng = np.random.default_rng(2)
    queries, columns = rng.integers(-200, 200, (5, 32)), rng.integers(-200, 200, (32, 500))
    columns[:, 100:110] = columns[:, [0]]  # ties
    found = topk.best_of_block(queries, columns, 5, np.full(5, -1), np.arange(500), 8)
    for q, (top, scores) in zip(queries, found, strict=True):
        whole = q @ columns
        want = np.lexsort((np.arange(500), -whole))[:5]
        assert top.tolist() == want.tolist() and scores.tolist() == whole[want].tolist()
    huge = topk.best_of_block(np.full((1, 4), 2**31 - 1), np.full((4, 3), 2**31 - 1), 2, np.array([-1]), np.arange(3), 2)
    assert huge[0][1].tolist() == [4 * (2**31 - 1) ** 2] * 2


def test_topk_large_components(spark):
    rows = [(50, [1.0, 0.0]), (51, [8.5e6, 0.0]), (52, [9e6, 1.0]), (53, [1e7, 0.0]), (54, [-1e7, 0.0]), (55, [-9e6, 0.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(i, int(65536 * x)) for i, x in ((53, 1e7), (52, 9e6), (51, 8.5e6), (55, -9e6), (54, -1e7))]
    over = spark.createDataFrame([(50, [1e30])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(over, F.col("vec_id") % 50 == 0).collect()


def test_topk_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 50 == 0).count() == 0


# --- mixing --------------------------------------------------------------------------------------


def brute_targets(sizes):
    """Water-filling round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, left, open_ = {}, float(sum(sizes.values())), set(order)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 3 * sizes[s] <= unit * weight[s]}
        if not full:
            return target | {s: unit * weight[s] for s in open_}
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mixing(spark, seed):
    rng = random.Random(seed)
    names = [None, "", "B", "a", "é", "zz"]
    spread = [rng.choice([1, 5, 40]) for _ in names]
    source = rng.choices(names, spread, k=150)
    texts = [" ".join("w" * rng.randint(1, 3) for _ in range(rng.choice([0, 1, 7, 300, 900]))) for _ in source]
    texts[0], texts[1] = None, " \t\n"
    df = docs(spark, texts, source=source).withColumn("size", F.lit(-1)).withColumn("rank", F.lit(-1)).withColumn("h", F.lit("x"))
    got = mixing.mix_sources(df).collect()
    sizes = {}
    for t, s in zip(texts, source, strict=True):
        sizes[s] = sizes.get(s, 0) + len(words(t))
    targets = brute_targets(sizes)
    taken = {}
    for r in got:
        s = source[r.doc_id]
        assert (r["size"], r.source_size) == (len(words(texts[r.doc_id])), sizes[s])
        assert r.target == pytest.approx(targets[s]) and 0 <= r.taken <= 3 * r["size"]
        taken[s] = taken.get(s, 0) + r.taken
    assert len(got) == len(texts) and sum(taken.values()) == sum(sizes.values())
    assert all(abs(taken[s] - targets[s]) <= 2 * mixing.QUANTUM for s in sizes)
    assert sorted(map(tuple, mixing.mix_sources(df).collect())) == sorted(map(tuple, got))
    rows = mixing.mixed_rows(df)
    assert rows.columns == df.columns
    out = {}
    for r in rows.collect():
        assert (texts[r.doc_id]).startswith(r.text) and r.n_chars == len(r.text)
        out[r.doc_id] = out.get(r.doc_id, 0) + len(words(r.text))
    assert out == {r.doc_id: r.taken for r in got if r.taken}


def test_mixing_ranges(spark, monkeypatch):
    """Many small ranges give the same mix as one."""
    df = docs(spark, ["w " * (i % 13) for i in range(200)], source=["ab"[i % 2] for i in range(200)])
    want = sorted(map(tuple, mixing.mix_sources(df).collect()))
    monkeypatch.setattr(mixing, "RANGE_ROWS", 7)
    assert sorted(map(tuple, mixing.mix_sources(df).collect())) == want


def test_mixing_empty(spark):
    assert mixing.mix_sources(spark.createDataFrame([], DOCS)).count() == 0
    rows = mixing.mix_sources(docs(spark, ["", None])).collect()
    assert [(r["size"], r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2


# --- chat formatting -----------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def test_chat_round_trip(spark):
    rng = random.Random(4)
    parts = ["\\", "<|", "|>", "im_end", "<|im_end|>", "<|im_start|>", "\n", "n", "|", "<", "é", "😀", "\\n", ""]
    rows = [(c, t, "".join(rng.choices(parts, k=2)) if rng.random() < 0.4 else "assistant", "".join(rng.choices(parts, k=rng.randint(0, 9)))) for c in range(40) for t in range(rng.randint(1, 6))]
    rows += [(100, 0, None, None), (100, 0, "assistant", "x"), (100, 0, "assistant", "x"), (None, None, "user", "y")]
    df = spark.createDataFrame(rows, TURNS).withColumn("extra", F.lit(1))
    rendered = chat_format.render(chat_format.fold_events(chat_format.events_of_turns(df)))
    want = {}
    for c, t, r, x in rows:
        want.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    for r in chat_format.read_back(rendered).collect():
        turns = [(a, b) for _, a, b in sorted(want[r.conv_id], key=lambda x: (x[0], x[1].encode(), x[2].encode()))]
        assert [tuple(t) for t in r.turns] == turns
        assert r.learned == [b for a, b in turns if a == "assistant"]
    for r in chat_format.digests(rendered).collect():
        turns = [(a, b) for _, a, b in sorted(want[r.conv_id], key=lambda x: (x[0], x[1].encode(), x[2].encode()))]
        learned = "".join(b for a, b in turns if a == "assistant")
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)), len(learned), sha(learned))


def test_chat_sql(spark, tmp_path):
    """The SQL says the same over backslashes, newlines and control strings in roles and texts."""
    rng = random.Random(14)
    parts = ["\\", "<|", "im_end", "|>", "\n", "n", "é", "x", "\\n"]
    said = lambda: "".join(rng.choices(parts, k=rng.randint(0, 8)))
    rows = [(c, t, said() if rng.random() < 0.3 else "assistant", said()) for c in range(60) for t in range(rng.randint(1, 5))]
    spark.createDataFrame([*rows, (99, 0, None, None)], TURNS).write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.execute(OP9_SQL)
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, op9_chat_format(spark, str(tmp_path)).select(*names).collect())) == sorted(want.fetchall())


def test_topk_sql(spark, tmp_path):
    rng = random.Random(15)
    rows = [(i, [rng.uniform(-1, 1) * (1e6 if i % 7 == 0 else 1) for _ in range(8)]) for i in range(160)] + [(150, None), (200, [None] * 8), (250, [float("nan")] * 8)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.execute(OP2_SQL)
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, op2_exact_topk(spark, str(tmp_path)).select(*names).collect())) == sorted(want.fetchall())


def test_chat_events(spark):
    events = [
        (1, 0, 1, "message", "user", "hi"), (1, 1, 2, "message", "assistant", ""), (1, 1, 3, "delta", "", "ab"), (1, 1, 4, "delta", None, "cd"), (1, 1, 5, "regenerate", "", ""), (1, 1, 6, "delta", "", "new"),
        (1, 0, 7, "edit", "", "hello"), (1, 2, 8, "delta", "user", "open"), (1, 2, 9, "other", "q", "q"),
    ]
    df = spark.createDataFrame(events, "conv_id long, turn long, seq long, kind string, role string, text string")
    turns = chat_format.read_back(chat_format.render(chat_format.fold_events(df))).first().turns
    assert [tuple(t) for t in turns] == [("user", "hello"), ("assistant", "new"), ("user", "open")]


def test_chat_empty(spark):
    none = spark.createDataFrame([], TURNS)
    assert chat_format.digests(chat_format.render(chat_format.fold_events(chat_format.events_of_turns(none)))).count() == 0


# --- HTML ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def net():
    return html_blocks.default_labeller()


def test_html_held_out_accuracy(net):
    pages = html_blocks.training_pages(150, 4242)
    right = total = 0
    for page, want in pages:
        blocks = html_blocks.leaf_blocks(page)
        clean = [(p, t.replace(html_blocks.MARKER, "").strip() or "-", s) for p, t, s in blocks]
        scores = net.predict([clean])[0]
        right += sum((s >= 0.5) == (html_blocks.MARKER in t) for s, (_, t, _) in zip(scores, blocks, strict=True))
        total += len(blocks)
    assert right / total > 0.98


def test_html_blocks():
    page = "<head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=x>Home</a><li>B</ul></nav><!-- <p>no</p> --><script>var t='</p>';</script><article><h1>A &amp;\n B</h1><p><b>one<br>two<p>th<i>re</i>e &quot;x&copy</article><p title='a>b'>q"
    blocks = [(p.last[-1], t) for p, t, _ in html_blocks.leaf_blocks(page)]
    assert blocks == [("<li", "Home"), ("<li", "B"), ("<h1", "A & B"), ("<p", "one two"), ("<p", 'three "x©'), ("<p", "q")]
    assert html_blocks.leaf_blocks("") == [] and html_blocks.leaf_blocks("plain  text")[0][1] == "plain text"
    assert html_blocks.leaf_blocks("a < b <p") == [(html_blocks.Path(), "a < b <p", 0.0)] and html_blocks.leaf_blocks("<script>x") == []


def test_html_hostile_pages():
    """Unclosed tags, quotes and raw elements, and deep nesting, in time in proportion to the length."""
    begun = time.monotonic()
    n = 100_000
    assert html_blocks.leaf_blocks("<a " * n) == [(html_blocks.Path(), ("<a " * n).strip(), 0.0)]
    deep = html_blocks.leaf_blocks("<div class='c'>x" * n)
    assert len(deep) == n and deep[-1][0].length == 2 * n
    assert len(html_blocks.leaf_blocks("<p>x<td>" + "<div>y" * n)) == n + 1
    assert html_blocks.leaf_blocks("<script>" + "</script " * n) == []
    for part in ("<b \"", "<!", "<b '>", "</p", "<p>&amp", "<!-- ", "<svg/>"):
        html_blocks.leaf_blocks(part * n)
    html_blocks.leaf_blocks("<b " * n + "\" >")
    assert time.monotonic() - begun < 60


def test_html_optional_tags():
    said = lambda page: [t for _, t, _ in html_blocks.leaf_blocks(page)]
    assert said("<head><title>t</title><meta a=b><article><p>x</article>") == ["x"]
    assert said("<svg viewBox='0'/><p>x</p><svg><text>no</text></svg><p>y") == ["x", "y"]
    assert said('<p title="a>b">x<p data-x=\'>\'>y') == ["x", "y"]


# Pages written by hand, unlike the generated ones, with their main texts.
HAND_MADE = [
    ("<html><body><table><tr><td class=leftnav><a href=/>Start</a> <a href=/n>News</a></td><td class=content><h2>The mill at the river</h2><p>It was built long ago, and it still turns when the water is high enough in spring.</p><p>Nobody lives there now.</p></td></tr></table><p class=footer>Copyright 2001 by the village</p></body></html>",
     "The mill at the river\n\nIt was built long ago, and it still turns when the water is high enough in spring.\n\nNobody lives there now."),
    ("<body><header><h1 class=site>Garden paper</h1><nav><a href=1>Home</a><a href=2>Shop</a></nav></header><main><article class='post entry'><h1>Pruning apple trees</h1><p>Cut in late winter, before the buds swell, and leave the strong branches alone.</p><ul><li>Use a clean saw.</li><li>Cut above a bud.</li></ul></article><section class=comments><h3>2 comments</h3><p>Thank you, this helped me a lot last year.</p></section></main><footer><a href=i>Imprint</a></footer></body>",
     "Pruning apple trees\n\nCut in late winter, before the buds swell, and leave the strong branches alone.\n\nUse a clean saw.\n\nCut above a bud."),
]


def test_html_hand_made(net):
    for page, want in HAND_MADE:
        assert html_blocks.main_texts([page], net) == [want]


def test_html_articles(spark, net):
    """The main text of every page of the small tables is that of its one article element, read plainly."""
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    articles = [re.findall(r"<article.*?</article>", p, re.S) for p in pages]
    pairs = [(p, "\n\n".join(t for _, t, _ in html_blocks.leaf_blocks(a[0]))) for p, a in zip(pages, articles, strict=True) if len(a) == 1]
    assert len(pairs) > len(pages) / 2
    assert html_blocks.main_texts([p for p, _ in pairs], net) == [t for _, t in pairs]


def test_html_gradients():
    """Backpropagation agrees with finite differences."""
    small = html_blocks.Labeller(1, hidden=3)
    small.w = {k: w.astype(np.float64) for k, w in small.w.items()}
    rng = np.random.default_rng(0)
    x = rng.standard_normal((4, 2, small.w["xf"].shape[0])) * 0.1
    mask, label = np.array([[1, 1], [1, 1], [1, 0], [1, 0]], float), rng.integers(0, 2, (4, 2)).astype(float)
    got, _ = small.gradients(x, mask, label)
    for name, place in (("hf", (1, 2)), ("cb", (4,)), ("xf", (7, 9)), ("o", (2,))):
        losses = []
        for step in (1e-3, -1e-3):
            small.w[name][place] += step
            losses.append(small.gradients(x, mask, label)[1])
            small.w[name][place] -= step
        assert got[name][place] == pytest.approx((losses[0] - losses[1]) / 2e-3, abs=2e-4)


def test_html_extract(spark, net):
    page = '<html><body><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="ad">Buy it</div><article><h1>Head line</h1><p>First &amp; best part of it.</p><p>Second one.</p></article><footer>&copy; me</footer></body></html>'
    df = spark.createDataFrame([(1, "u", page), (1, "u", page), (None, None, None), (2, "v", "")], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    rows = html_blocks.extract(df, net).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in rows) == [(0, "", 0), (1, t := "Head line\n\nFirst & best part of it.\n\nSecond one.", len(t)), (1, t, len(t)), (2, "", 0)]
    assert html_blocks.extract(df.limit(0), net).count() == 0
