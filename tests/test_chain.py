"""The stages in a row over a small root folder, twice: the second run has nothing left to do."""

import json

from citeloom import chain, cli
from citeloom.sources import scans

TEXT = "# Paper\n\n## 1 Intro\n\nFirst one here. We follow [{n}] here. Last one.\n\n## References\n\n* [1] A. Elm. Growth of tall trees in the north. In V, 2019.\n* [2] B. Oak. Roots of old trees in the south. In V, 2019.\n* [3] C. Ash. Unknown things of no known place at all. In W, 2018.\n"
TITLES = ("Growth of tall trees in the north", "Roots of old trees in the souths")


def make_root(root):
    for i, title in enumerate(TITLES):
        for folder, suffix, said in (("papers", "pdf", "pdf"), ("nougat_output", "md", TEXT.format(n=2 - i))):
            path = root / folder / "icml" / "2019" / f"p{i}_{title.replace(' ', '_')}.{suffix}"
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(said)
    meta = [{"id": f"x{i}", "title": t, "authors": ["A"], "year": 2019, "conference": "icml", "pdf_path": f"papers/icml/2019/p{i}_{t.replace(' ', '_')}.pdf"} for i, t in enumerate(TITLES)]
    meta.append({"id": "gone", "title": "No file", "pdf_path": "papers/icml/2019/none.pdf"})
    (root / "metadata" / "icml").mkdir(parents=True)
    (root / "metadata" / "icml" / "icml_2019.json").write_text(json.dumps(meta))


def test_chain_twice(spark, tmp_path, capsys):
    root, out = str(tmp_path / "root"), str(tmp_path / "out")
    make_root(tmp_path / "root")
    for turn in range(2):
        assert {r.status: r.n for r in chain.run_contexts(spark, "nougat", "icml", [], root, f"{out}/contexts").collect()} == {"processed": 2}
        papers = chain.run_corpus(spark, root, out).orderBy("pos").collect()
        assert [(p.title, p.path) for p in papers] == [(t, f"nougat_output/icml/2019/p{i}_{t.replace(' ', '_')}.md") for i, t in enumerate(TITLES)]
        assert "no metadata" in capsys.readouterr().err
        assert {r.match_type: r.n for r in chain.run_resolve(spark, root, out).collect()} == {"exact": 2, "fuzzy": 2, "no_match": 2, "total": 6}
        files = sorted((tmp_path / "root" / "citation_contexts").glob("*/*/*.json"))
        assert [[(r["target"], r["in_dataset"], r["in_conference_list"]) for r in json.loads(f.read_text())] for f in files] == [[("b0", True, True), ("b1", True, True), ("b2", False, False)]] * 2
        edges = spark.read.parquet(f"{out}/all_papers_with_refs.parquet").orderBy("pos").collect()
        assert [(e["target"], e["title"], e["title_from_ref"]) for e in json.loads(edges[0].references)] == [("b0", TITLES[0], TITLES[0]), ("b1", TITLES[1], TITLES[1][:-1])]

        said = {r.paper_file: (r.total, r.generated) for r in chain.run_prompts(spark, "icml", root, f"{out}/prompts").collect()}
        assert list(said.values()) == ([(3, 4)] * 2 if turn == 0 else [])
        assert spark.read.parquet(f"{out}/prompts").count() == 8
        made = list((tmp_path / "root" / "prompts").glob("*/*/*/*.txt"))
        assert len(made) == 8  # after the first run's file was lost, too
        made[0].unlink()

        scored = tmp_path / "root" / "prompt_scores" / "icml" / "2019" / f"p0_{TITLES[0].replace(' ', '_')}.csv"
        scored.parent.mkdir(parents=True, exist_ok=True)
        scored.write_text("ref_target,type_1_output,type_2_output,type_3_output\nb0,1,4,5\n")
        missing = chain.run_labels(spark, root, out).collect()
        assert [(r.missing_ref_target, r.ref_title_from_ref) for r in missing] == [("b1", TITLES[1][:-1])]
        whole = spark.read.parquet(f"{out}/all_papers_with_refs_and_labels.parquet").orderBy("pos").first()
        assert [(e["type_1_output"], e["type_2_output"], e["type_3_output"]) for e in json.loads(whole.references)] == [("1", "", "5"), ("", "", "")]
        chain.run_split(spark, out)
        assert spark.read.parquet(f"{out}/train.parquet").count() == 2
    assert chain.run_labels(spark, root, out, limit=0).count() == 0


def test_pdfs(spark, tmp_path):
    make_root(tmp_path)
    made = {r.status for r in chain.run_pdfs(spark, "tei", "icml", [2019], str(tmp_path), chain.client_of("citeloom.sources.services:echo")).collect()}
    assert made == {"processed"} and len(list((tmp_path / "grobid_output").glob("icml/2019/*.tei.xml"))) == 2
    assert chain.run_pdfs(spark, "tei", "icml", [], str(tmp_path), chain.client_of("citeloom.sources.services:echo")).count() == 0
    wanted = chain.listing(spark, f"{tmp_path}/papers", "pdf", ("icml",), ordered=True).limit(1)
    (tmp_path / "nougat_output").rename(tmp_path / "old")
    assert chain.run_pdfs(spark, "ocr", "icml", [], str(tmp_path), chain.client_of("citeloom.sources.services:echo"), wanted).count() == 1


def test_arguments(spark, tmp_path, capsys):
    assert cli.main(["contexts", "--root", "x", "--out", "y"]) == 1 and cli.main(["tei", "icml", "--root", "x"]) == 1
    assert cli.main(["prompts", "nowhere", "--root", "x", "--out", "y"]) == 1 and "unknown venue" in capsys.readouterr().err
    assert cli.years_of(["2019", "x"]) == [2019]
    broken = tmp_path / "state"
    broken.mkdir()
    (broken / "part.parquet").write_text("no parquet")
    assert chain.state(spark, str(broken)) is None and chain.state(spark, str(tmp_path / "none")) is None
    assert scans.all_scores(spark, str(tmp_path)).count() == 0
