import itertools
import random
import re

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from citeloom.llm import exact_dedup, ngram_join, shingles
from citeloom.llm.components import components
from citeloom.llm.queries import OP5_SQL, OP10_SQL
from tests.llm.helpers import DOCS, docs, sha, words

ODD = ["", None, " ", "  ", "\t\n", "a  b", "a\tb", "a b ", "x" * 10_000, "x" * 10_001, "é ü" * 3000, "é ü" * 3000]


def brute_exact(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    out = []
    for i, t in norm:
        same = [j for j, u in norm if u == t]
        keep = min((j is None, j or 0) for j in same)
        out.append((i, None if keep[0] else keep[1], len(same), sha(t)))
    return sorted(out, key=str)


@pytest.mark.parametrize("collide", [False, True])
def test_exact_against_brute_force(spark, collide):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choices("ab \n", k=rng.randint(0, 60))) for _ in range(60)]
    df = docs(spark, texts).withColumn("id", F.lit("clash")).withColumn("rid", F.lit(1)).withColumn("h", F.lit(2))
    options = {"hash_of": lambda b: F.length(b) % 3} if collide else {}
    got = exact_dedup.exact_dedup(df, block_chars=16, **options)
    rows = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got.collect()]
    assert sorted(rows, key=str) == brute_exact(enumerate(texts))
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got.collect())


def test_exact_repeated_and_null_ids(spark):
    df = docs(spark, ["a b", "a  b", "a b", "c", "c"], ids=[None, 3, 3, 5, 5])
    rows = exact_dedup.exact_dedup(df).collect()
    assert [r.keep_id for r in rows if r.doc_id == 3] == [3, 3] and sum(r.kept for r in rows) == 2
    kept = exact_dedup.kept_rows(df)
    assert sorted((r.doc_id, r.text.replace("  ", " ")) for r in kept.collect()) == [(3, "a b"), (5, "c")] and kept.columns == df.columns


def test_empty(spark):
    none = spark.createDataFrame([], DOCS)
    assert exact_dedup.exact_dedup(none).count() == 0
    assert exact_dedup.kept_rows(none).count() == 0
    assert ngram_join.similar_components(none).count() == 0
    assert ngram_join.one_of_each(none).count() == 0


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 120)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for p in pairs if p[0] != p[1] for x in p}


def brute_near(texts, width, percent):
    sets = []
    for t in texts:
        w = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
        w = words(w)
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    label = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
            a, b = sorted((label[i], label[j]))
            label = [a if x == b else x for x in label]
    return [(i, len(s), c) for i, (s, c) in enumerate(zip(sets, label, strict=True))]


def near_texts(seed):
    """Groups of near copies of several sizes and strengths, around shared passages, with odd texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=60)
    out = ["", None, "one", "One", "two words", "Two  words", "a b c d", "a b c d", "a b c d e", " \n"]
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.choice([6, 12, 30, 80, 200])) + passage * rng.randint(0, 1)
        for _ in range(rng.choice([1, 3, 12])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 20))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(rng.choice([" ", "\n", "  "]).join(copy[rng.randint(0, 2) :]))
    return out


@pytest.mark.parametrize(("seed", "width", "percent"), [(1, 4, 85), (2, 4, 85), (3, 5, 80)])
@pytest.mark.parametrize("all_frequent", [False, True])
def test_near_against_brute_force(spark, monkeypatch, seed, width, percent, all_frequent):
    texts = near_texts(seed)
    if all_frequent:  # every token in the frequent class: combinations alone must find all links
        levels = ngram_join.token_levels
        monkeypatch.setattr(ngram_join, "token_levels", lambda m: (levels(m)[0], 0))
    got = ngram_join.similar_components(docs(spark, texts).withColumn("n", F.lit(0)).withColumn("id", F.lit("x")), width=width, percent=percent)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute_near(texts, width, percent)


def test_one_of_each(spark):
    texts = near_texts(4)
    df = docs(spark, texts).withColumn("extra", F.col("doc_id") * 2).withColumn("rid", F.lit("x"))
    kept = ngram_join.one_of_each(df, width=5, percent=80)
    want = sorted({c for _, _, c in brute_near(texts, 5, 80)})
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows) == want and kept.columns == df.columns
    assert all(r.text == texts[r.doc_id] and r.extra == 2 * r.doc_id for r in rows)


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_one_word_repeated(spark, width, percent):
    """Texts of one shingle are equal sets, however often they repeat their word; shorter ones have shingles of their own."""
    texts = [" ".join(["a"] * k) for k in (1, 3, 4, 5, 6, 9, 40)] + ["A a  a a\na a", "b b b b b", "b b b b b b", "a a a a b", "a a a a a b", "c d e f", "c d e f g"]
    df = docs(spark, texts)
    got = ngram_join.similar_components(df, width=width, percent=percent)
    want = brute_near(texts, width, percent)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == want
    kept = ngram_join.one_of_each(df, width=width, percent=percent)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in want})


def thue_morse(k):
    a, b = "a", "b"
    for _ in range(k):
        a, b = a + b, b + a
    return a, b


def in_duckdb(sql, df):
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist([r.asDict() for r in df.collect()], pa.schema([("doc_id", pa.int64()), ("text", pa.string())])))
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    return names, sorted(got.fetchall(), key=str)


HARD = [
    "two words", "Two  words", "a a a a", "a a a a a", "a a a a a a a", "", None, "w " * 130_000, "w " * 2000 + "v", " ".join(f"t{i}" for i in range(40_000)), " ".join(f"t{i}" for i in range(2, 40_000)),
    *(f"x y z {w}" for w in thue_morse(10)), *(f"x y z {w}" for w in thue_morse(5)), "p q r s t u v w", "s t u v p q r s",
]


def test_near_hard_texts(spark):
    """Two words alone, sets of one shingle, words made to share polynomial hashes, and texts beyond 256 KB."""
    assert max(len(t or "") for t in HARD) > 256 << 10
    got = ngram_join.similar_components(docs(spark, HARD))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute_near(HARD, 4, 85)
    alone = [i for i in range(11, 15)]
    assert {r.doc_id: r.component_id for r in got.collect() if r.doc_id in alone} == {i: i for i in alone}
    for t in ("two words", "a b c"):  # no other text in the batch
        assert ngram_join.similar_components(docs(spark, [t])).collect()[0].n_shingles == 1


def test_near_sql(spark):
    df = docs(spark, [t for t in HARD if len(t or "") < 5000] + near_texts(6))
    names, want = in_duckdb(OP5_SQL, df.select("doc_id", "text"))
    assert sorted(map(tuple, ngram_join.similar_components(df).select(*names).collect()), key=str) == want


def test_exact_sets():
    rng = random.Random(9)
    for vocabulary in (2, 50, 100_000):  # shingle numbers within 63 bits, and beyond
        texts = [" ".join(f"W{rng.randrange(vocabulary)}" for _ in range(rng.randint(0, 60 if vocabulary < 99 else 9000))) for _ in range(30)]
        for width in (1, 4, 5):
            sets = shingles.exact_sets(pa.array([*texts, None]), width)
            named = [{tuple(w[i : i + width]) for i in range(len(w) - width + 1)} for w in (t.lower().split() for t in texts)]
            for i, j in itertools.combinations(range(30), 2):
                assert len(set(sets[i].tolist()) & set(sets[j].tolist())) == len(named[i] & named[j])
            assert [len(s) for s in sets] == [len(s) or int(bool(t)) for s, t in zip(named, texts, strict=True)] + [0]


def test_exact_sql(spark):
    df = docs(spark, [t for t in ODD if t is not None] + ["a\u00a0b", "a b"])
    names, want = in_duckdb(OP10_SQL, df.select("doc_id", "text"))
    assert sorted(map(tuple, exact_dedup.exact_dedup(df).select(*names).collect()), key=str) == want


def test_heavy_groups(spark, monkeypatch):
    """Groups dealt to several tasks give the same rows."""
    from citeloom.llm import common

    monkeypatch.setattr(common, "HEAVY_ROWS", 2)
    monkeypatch.setattr(ngram_join, "PARTNERS", 2)
    texts = near_texts(5)
    got = ngram_join.similar_components(docs(spark, texts))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute_near(texts, 4, 85)
