import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

from citeloom.functions import paths, similarity, text
from citeloom.operators import contexts, extract, graph, labels, resolve
from citeloom.plans import catalogue
from citeloom.schema import NAMESPACE
from citeloom.sources import scans, services, sinks
from citeloom.streaming import incremental

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_queries_against_sql(spark, name, tmp_path):
    out = str(tmp_path / "out")
    catalogue.QUERIES[name](spark, SF).write.parquet(out)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want, got = con.sql(catalogue.ORACLE_SQL[name]), con.sql(f"select * from '{out}/*.parquet'")
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    a, b = (f"select {', '.join(chr(34) + c + chr(34) for c in columns)} from ({q})" for q in (catalogue.ORACLE_SQL[name], f"select * from '{out}/*.parquet'"))
    assert con.sql(f"(({a}) except all ({b})) union all (({b}) except all ({a}))").fetchall() == []


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_other_queries_run(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_paper_id(spark):
    key = "café|icml|2024|x1"
    assert one(spark, text.uuid5(F.lit(key))) == str(uuid.uuid5(uuid.UUID(NAMESPACE), key)) == "c39d4b51-9ef7-56fd-9c7b-81c81eb6db45"
    assert one(spark, text.paper_id(F.lit(" Café\t"), F.lit("ICML"), F.lit(2024), F.lit("x1"))) == "c39d4b51-9ef7-56fd-9c7b-81c81eb6db45"


def test_texts(spark):
    assert one(spark, text.normalize_title(F.lit("Foo-Bar: A  Test_1!"))) == "foobar a test_1"
    assert one(spark, text.normalize_title(F.lit(None).cast("string"))) == ""
    assert one(spark, text.clean_title(F.lit("3. _Deep_ **nets** $x$ of it, Cited by: 3"))) == "Deep nets of it"
    years = {"[12] A. Lee. Deep nets. 2019.": 2019, "Lee et al. (2020a) Ann Lee. Title. 2021.": 2020, "A. Lee. Title, pp. 1998-2005, 2011": 2011, "arXiv 1905.12345 preprint": 1905, "none": None}
    for ref, year in years.items():
        assert one(spark, text.extract_year(F.lit(ref))) == year
    assert one(spark, text.prompt_file(F.lit("b3"), 2, F.lit(True))) == "ref_b3_type_2_empty.txt"


def test_paths(spark):
    assert one(spark, paths.title_of_file(F.lit("x/abc_Deep_Nets.json"))) == "Deep Nets"
    assert one(spark, paths.title_of_file(F.lit("single.json"))) == "single"
    assert one(spark, paths.pdf_to_tei(F.lit("/r/icml/2020/a.pdf"), "/r", "/o")) == "/o/icml/2020/a.grobid.tei.xml"
    assert one(spark, paths.source_to_contexts(F.lit("/else/icml/2020/a.grobid.tei.xml"), "/r", "/o")) == "/o/icml/2020/a.json"
    assert one(spark, paths.corpus_to_contexts(F.lit("x/nougat_output/icml/2020/a.md"), "/c")) == "/c/icml/2020/a.json"
    assert one(spark, paths.metadata_to_contexts(F.lit("data/papers/icml/a.pdf"), "/r")) == "/r/citation_contexts/icml/a.json"
    assert one(spark, paths.corpus_to_scores(F.lit("grobid_output/icml/2020/a.grobid.tei.xml"), "/s")) == "/s/icml/2020/a.csv"


def test_similarity():
    assert similarity.weighted_ratio("deep nets", "deep nets for vision") == 90
    assert similarity.weighted_ratio("deep nets", "deep nets") == 100
    assert similarity.weighted_ratio("abc def ghi", "ghi abc def") == pytest.approx(95)
    assert similarity.weighted_ratio("a", "b" * 20) < 90
    assert similarity.common_subsequence("abcde", "xaxcxe") == 3


def test_resolve(spark):
    papers = spark.createDataFrame([(0, "p0", "Deep nets", "icml", 2020), (1, "p1", "deep nets!", "acl", 2020), (2, "p2", "Growing large forests quickly", "acl", 2019), (3, "p3", "Other", "uai", 2015)], "pos long, paper_id string, title string, venue string, year int")
    refs = spark.createDataFrame([(0, "DEEP NETS", 1999), (1, "Growing large forests quickli", 2020), (2, "Growing large forests quickli", 2022), (3, "of the", None), (4, None, None)], "ref_id long, title string, year int")
    out = {r.ref_id: (r.match_type, r.matched_paper_id) for r in resolve.resolve(refs, papers).collect()}
    assert out == {0: ("exact", "p0"), 1: ("fuzzy", "p2"), 2: ("no_match", ""), 3: ("no_match", ""), 4: ("no_match", "")}


def test_graph(spark):
    papers = spark.createDataFrame([(1, "icml", 2020), (2, "acl", 2019), (3, "acl", 2018), (4, "uai", 2020), (5, "icml", 2025), (6, "acl", 2025)], "paper_id long, venue string, year int")
    edges = spark.createDataFrame([(1, 2), (1, 99), (3, 4), (5, 1)], "paper_id long, matched_paper_id long")
    kept = graph.reduce_graph(papers, edges)
    assert sorted(r.paper_id for r in kept.collect()) == [1, 2, 5]
    train, evaluation = graph.split_papers(kept)
    assert sorted(r.paper_id for r in train.collect()) == [1, 2] and [r.paper_id for r in evaluation.collect()] == [5]
    assert graph.format_years((2024, 2018)) == "2018-2024" and graph.format_years(2025) == "2025"
    assert graph.calendar(spark).count() == 202


def test_labels(spark):
    edges = spark.createDataFrame([("p", "a"), ("p", "b"), ("q", "a")], "paper_id string, target string")
    scores = spark.createDataFrame([("p", "a", 0, "1", "2", "3"), ("p", "a", 1, "4", "5", None)], "paper_id string, target string, row_pos long, type_1_output string, type_2_output string, type_3_output string")
    out = {(r.paper_id, r.target): (r.type_1_output, r.type_2_output, r.type_3_output) for r in labels.attach_labels(edges, scores).collect()}
    assert out == {("p", "a"): ("4", "", ""), ("p", "b"): ("", "", ""), ("q", "a"): ("", "", "")}
    assert [(r.paper_id, r.target) for r in labels.missing_labels(edges, scores).collect()] == [("p", "b")]


def test_extract_isolates_faults(spark):
    from tests.test_tei_altmd import DOC

    docs = spark.createDataFrame([("good", DOC), ("bad", "<TEI"), ("none", None)], "path string, content string")
    rows = extract.extract_contexts(docs, "tei")
    status = {r.path: r.status for r in rows.collect()}
    assert status == {"good": "processed", "bad": "error", "none": "error"}
    refs = extract.references_of(rows, ["path"])
    assert [(r.target, r.source_id, r.year) for r in refs.collect()] == [("b0", "b0", 2001)]
    assert extract.nest_references(refs, ["path"]).first().refs[0].title == "Growing forests"
    with pytest.raises(ValueError, match="unknown source"):
        extract.extract_contexts(docs, "x")


def test_contexts_nest(spark):
    bib = spark.createDataFrame([("d", "b0"), ("d", "b1")], "doc string, target string")
    ctx = spark.createDataFrame([("d", "b0", 1, "s", "two"), ("d", "b0", 0, "s", "one")], "doc string, target string, context_pos int, section string, context string")
    out = {r.target: [c.context for c in r.contexts] for r in contexts.nest_contexts(bib, ctx, ["doc", "target"]).collect()}
    assert out == {"b0": ["one", "two"], "b1": []}


def test_files_and_resume(spark, tmp_path):
    from citeloom.cli import run_contexts
    from tests.test_tei_altmd import DOC

    folder = tmp_path / "grobid_output" / "icml" / "2020"
    folder.mkdir(parents=True)
    (folder / "a.grobid.tei.xml").write_text(DOC)
    (folder / "b.grobid.tei.xml").write_text("<broken")
    out = str(tmp_path / "out")
    for _ in range(2):  # the second run has nothing to do
        counts = {r.status: r.n for r in run_contexts(spark, "grobid", "icml", [], str(tmp_path), out).collect()}
        assert counts == {"processed": 1, "error": 1}
    assert scans.files(spark, str(tmp_path / "grobid_output"), "tei", "icml", [2020]).count() == 2
    assert scans.files(spark, str(tmp_path / "grobid_output"), "tei", "acl").count() == 0
    done = spark.createDataFrame([("x",)], "output_path string")
    todo = spark.createDataFrame([("x",), ("y",), ("z",)], "output_path string")
    status = spark.createDataFrame([("s", "y", "error")], "stage string, output_path string, status string")
    assert [r.output_path for r in incremental.to_do(todo, done, status).collect()] == ["z"]
    assert sorted(r.output_path for r in incremental.to_do(todo, done, status, retry_errors=True).collect()) == ["y", "z"]
    assert incremental.state_name("icml", [2020, 2018]) == "icml_2018-2020_2"


def test_stream(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    spark.createDataFrame([("a",)], "x string").write.json(src)
    step = lambda df: df.selectExpr("upper(x) AS x")
    for more in (None, "b"):
        if more:
            spark.createDataFrame([(more,)], "x string").write.mode("append").json(src)
        incremental.process_new(spark, src, "x string", "json", step, out, state).awaitTermination()
    assert sorted(r.x for r in spark.read.parquet(out).collect()) == ["A", "B"]


def test_services_and_sinks(spark, tmp_path):
    pdfs = spark.createDataFrame([("p", bytearray(b"text")), ("q", bytearray(b""))], "path string, content binary")
    rows = {r.path: (r.status, r.text) for r in services.parse_pdfs(pdfs, services.echo).collect()}
    assert rows == {"p": ("processed", "text"), "q": ("error", None)}
    path = str(tmp_path / "d" / "f.txt")
    df = spark.createDataFrame([(path, "hello"), (path + "2", "")], "path string, text string")
    assert sorted(r.status for r in sinks.export_files(df, "path", "text").collect()) == ["error", "processed"]
    assert open(path).read() == "hello"
    raw = spark.createDataFrame([(bytearray(b"a\r\nb\xff"),)], "c binary")
    assert raw.select(scans.lenient_text(F.col("c")).alias("x"), scans.strict_text(F.col("c")).alias("y")).first() == ("a\nb�", None)
