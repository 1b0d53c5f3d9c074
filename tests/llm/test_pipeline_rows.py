"""Rows that each stage keeps, against plain versions of the stages."""

import hashlib
import random
import re
from collections import Counter

import corpus_pipeline
from citeloom.llm import language_id, mixing, sentencepiece_codec
from citeloom.llm.mixing import mix_sources
from pyspark.sql import functions as F
from tests.llm.helpers import docs, words
from tests.llm.test_dedup import brute_exact, brute_near, near_texts
from tests.llm.test_text_ops import sentence


def fixture(spark):
    rng = random.Random(11)
    texts = [sentence(rng, rng.choice(["aa", "bb"])) for _ in range(120)]
    lang = ["aa" if t[:2] in ("Ba", "Be", "Bi", "Bo", "Bu", "Da", "De", "Di", "Do", "Du") else "bb" for t in texts]
    texts += [*texts[:9], "  ".join(texts[3].split(" ")), texts[5] + " kra", "", None, "12 34", "zq" * 40, "hm"]
    lang += [None] * (len(texts) - len(lang))
    return docs(spark, texts, lang=lang, source=[rng.choice(["s1", "s2", None]) for _ in texts])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_language_stage(spark):
    df = fixture(spark)
    got = corpus_pipeline.language_filter(spark, df, "")
    model = language_id.train(df.filter(~language_id.held_out()))
    said = {r.doc_id: r for r in language_id.identify(df, model).collect()}

    def stays(r):
        if not re.search(r"[^\W\d_]", r.text or ""):
            return False
        return len(r.text) < corpus_pipeline.MIN_CHARS or said[r.doc_id].hit_rate >= corpus_pipeline.MIN_HIT_RATE

    want = [tuple(r) for r in df.collect() if stays(r)]
    assert rows_of(got) == sorted(want, key=str)
    assert 120 <= len(want) < df.count() and "zq" * 40 not in {r[1] for r in want}


def test_dedup_stages(spark):
    texts = near_texts(8)
    df = docs(spark, texts, source=[f"s{i % 3}" for i in range(len(texts))])
    rows = {r.doc_id: tuple(r) for r in df.collect()}
    want = sorted({k for _, k, _, _ in brute_exact(enumerate(texts))})
    exact = corpus_pipeline.exact_duplicates(spark, df, "")
    assert rows_of(exact) == sorted((rows[i] for i in want), key=str)
    left = spark.createDataFrame([rows[i] for i in want], df.schema)
    near = brute_near([rows[i][1] for i in want], 5, 80)
    assert rows_of(corpus_pipeline.near_duplicates(spark, left, "")) == sorted((rows[want[c]] for c in {c for _, _, c in near}), key=str)


def test_mixing_stage(spark):
    """Each pass over a document gives its row; a pass that is cut gives the text up to the last word taken."""
    df = fixture(spark)
    taken = {r.doc_id: r.taken for r in mix_sources(df).collect()}
    want = []
    for r in df.collect():
        said, left = words(r.text), taken[r.doc_id]
        while left > 0:
            n = min(left, len(said))
            text = r.text if n == len(said) else re.match(r"(?:[\x20\x09-\x0D]*[^\x20\x09-\x0D]+){%d}" % n, r.text).group()
            want.append((r.doc_id, text, r.lang, r.source, len(text)))
            left -= n
    assert rows_of(corpus_pipeline.mix(spark, df, "")) == sorted(want, key=str)
    total = sum(len(words(r.text)) for r in df.collect())
    assert sum(taken.values()) == total and mixing.PASSES == 3 and Counter(taken.values())[0] < len(taken)


def test_encoding_stage(spark):
    df = fixture(spark)
    with open(corpus_pipeline.piece_model(), "rb") as file:
        library = sentencepiece_codec.Codec(file.read()).library
    want = []
    for r in df.collect():
        ids = library.encode(r.text or "")
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((r.doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    got = corpus_pipeline.encode(spark, df, "").select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert rows_of(got) == sorted(want, key=str)


def test_run_frees_what_it_staged(spark, tmp_path):
    """All stages in a row; of the tables staged on the way only those that the result reads are left."""
    fixture(spark).filter(F.col("doc_id") < 60).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() > 0 and len(out.inputFiles()) > 0
    assert not corpus_pipeline._LEFT.get(spark.sparkContext.applicationId)
