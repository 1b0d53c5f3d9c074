from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from citeloom.llm import sentencepiece_codec
from citeloom.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.helpers import DOCS, docs

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "sentencepiece"]
    source = spark.read.parquet(f"{SF}/documents.parquet")
    current = source
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = step(spark, current, SF)
        assert after.columns == source.columns, name
        kept = {r.doc_id for r in after.select("doc_id").collect()}
        assert kept <= {r.doc_id for r in current.select("doc_id").collect()} and kept
        current = spark.createDataFrame(after.collect(), after.schema)
    out = corpus_pipeline.encode(spark, current, SF)
    assert out.count() == current.count()
    assert sentencepiece_codec.digests(sentencepiece_codec.encode(current, corpus_pipeline.piece_model())).count() == current.count()


def test_stages_bear_odd_rows(spark):
    texts = ["", None, "!!!", "some words of a text here and there", "some words of a text here and there", "x" * 30_000]
    odd = docs(spark, texts, source=[None, None, "a", "a", "b", ""], lang=[None, "en", "en", "en", None, "en"], ids=[0, 1, None, 3, 3, 5]).withColumn("rid", F.lit(1)).withColumn("row", F.lit("clash"))
    for df in (odd, odd.limit(0)):
        for name, step in corpus_pipeline.STAGES:
            out = step(spark, df, SF)
            assert out.count() <= 3 * df.count(), name
            assert name == "sentencepiece" or out.columns == df.columns


def test_registered(spark):
    names = __spark_entry__.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 11))
    assert set(ORACLE_SQL) <= set(__spark_entry__.oracle_sql())
    assert spark.createDataFrame([], DOCS).columns == spark.read.parquet(f"{SF}/documents.parquet").columns
