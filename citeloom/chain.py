"""The stages of the citation pipeline in a row, each resuming where it stopped.

Parsed PDFs, contexts (a JSON file a paper), corpus, resolved references with flags written back,
labels, splits, prompts. Lists are tables until a stage's last step, which writes files one a paper.
"""

from __future__ import annotations

import importlib
import sys
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom import schema
from citeloom.functions import paths
from citeloom.operators import corpus, extract, graph, labels, prompts, resolve
from citeloom.sources import scans, services, sinks
from citeloom.streaming import incremental

#: Parsed texts by the tool that made them: parser, folder, kind of file.
SOURCES = {"grobid": ("tei", paths.TEI, "tei"), "nougat": ("ocr", paths.OCR, "markdown"), "marker": ("alt", paths.ALT, "markdown")}
PDF_STAGES = {"tei": (paths.TEI, paths.pdf_to_tei), "ocr": (paths.OCR, paths.pdf_to_markdown)}


def plain(path: Column) -> Column:
    """A local path as the metadata has it."""
    return F.regexp_replace(path, "^file:/+", "/")


def listing(spark: SparkSession, root: str, kind: str, confs: tuple[str, ...] = schema.VENUES, ordered: bool = False) -> DataFrame:
    """Paths of all venues' files of a kind, in order if asked for."""
    found = reduce(DataFrame.unionByName, [scans.files(spark, root, kind, conf) for conf in confs]).withColumn("path", plain(F.col("path")))
    return found.orderBy("path") if ordered else found


def state(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of an earlier run; none where there is no table, or, with a message, where it can't be read."""
    if not scans.existing(spark, [path]):
        return None
    try:
        return spark.read.parquet(path)
    except Exception as e:
        print(f"state of earlier runs can't be read, starting anew: {path}: {str(e)[:200]}", file=sys.stderr)
        return None


def _left(inputs: DataFrame, done: DataFrame | None, key: str, retry_errors: bool) -> DataFrame:
    if done is None:
        return inputs
    closed = done.filter(F.col("status") != incremental.ERROR) if retry_errors and "status" in done.columns else done
    return inputs.join(closed.select(key).distinct(), key, "left_anti")


def run_contexts(spark: SparkSession, source: str, conf: str, years: list[int], root: str, out: str, exclude_appendix: bool = False, retry_errors: bool = False) -> DataFrame:
    """Contexts of the files of a venue that have none yet: rows appended to ``out``, a JSON file a paper; returns status counts."""
    kind, folder, _ = SOURCES[source]
    base = f"{root}/{folder}"
    docs = scans.files(spark, base, "tei", conf, years or None, content=True) if kind == "tei" else scans.markdown(spark, base, conf, years or None, strict=kind == "alt")
    docs = docs.withColumn("output_path", paths.source_to_contexts(plain(F.col("path")), base, f"{root}/{paths.CONTEXTS}"))
    rows = extract.extract_contexts(_left(docs, state(spark, out), "output_path", retry_errors), kind, exclude_appendix=exclude_appendix)
    rows.withColumns({"stage": F.lit(f"contexts-{source}"), "updated": F.current_timestamp()}).write.mode("append").parquet(out)

    # Files are written for all rows that have none, those of a run that was cut off before this step too.
    there = listing(spark, f"{root}/{paths.CONTEXTS}", "contexts", (conf,)).select(F.col("path").alias("output_path"))
    new = spark.read.parquet(out).filter((F.col("status") == incremental.DONE) & (F.col("conf") == conf)).join(there, "output_path", "left_anti")
    listed = extract.nest_references(extract.references_of(new, ["output_path"]), ["output_path"])
    whole = new.select("output_path").distinct().join(listed, "output_path", "left")
    said = whole.select("output_path", F.coalesce(sinks.context_json(F.col("refs")), F.lit("[]")).alias("json"))
    sinks.export_files(said, "output_path", "json").write.format("noop").mode("overwrite").save()
    return incremental.status_counts(spark.read.parquet(out))


def run_corpus(spark: SparkSession, root: str, out: str) -> DataFrame:
    """All papers whose PDF and contexts exist, with ids and order; missing metadata files are reported and passed over."""
    metadata, missing = scans.all_metadata(spark, f"{root}/metadata")
    for name in missing:
        print(f"no metadata: {name}", file=sys.stderr)
    below = lambda folder, kind: listing(spark, f"{root}/{folder}", kind).select(F.substring_index("path", f"{root.rstrip('/')}/", -1).alias("path"))
    stem = lambda c: F.regexp_replace(F.regexp_replace(c, r"^[^/]*/", ""), r"(\.grobid\.tei\.xml|\.md)$", "")
    sources = {name: below(*SOURCES[name][1:]).withColumn("stem", stem(F.col("path"))) for name in ("grobid", "marker", "nougat")}
    papers = corpus.build_corpus(metadata, listing(spark, f"{root}/papers", "pdf"), listing(spark, f"{root}/{paths.CONTEXTS}", "contexts"), sources, root)
    sinks.write_parquet(papers, f"{out}/all_papers.parquet")
    kept = spark.read.parquet(f"{out}/all_papers.parquet")
    sinks.write_csv(kept, f"{out}/all_papers.csv")
    twice = corpus.duplicates(kept, "paper_id").count()
    if twice:
        print(f"{twice} rows share their paper id", file=sys.stderr)
    return kept


def edges_of(resolved: DataFrame) -> Column:
    """An edge of the corpus graph; its labels come later."""
    none = F.lit(None).cast("string")
    return F.struct(
        "target", "matched_paper_id", F.col("matched_title").alias("title"), F.col("title").alias("title_from_ref"), F.col("matched_venue").alias("venue"), "year",
        none.alias("type_1_output"), none.alias("type_2_output"), none.alias("type_3_output"),
    )


def with_references(papers: DataFrame, rows: DataFrame, edge: Column, key: str = "paper_id") -> DataFrame:
    """Papers with their edges nested, in the order of ``ref_pos``, as JSON."""
    listed = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("ref_pos", edge.alias("edge")))).alias("list"))
    nested = listed.select(key, F.to_json(F.transform("list", lambda x: x["edge"])).alias("references"))
    return papers.drop("references").join(nested, key, "left").fillna("[]", subset=["references"])


def run_resolve(spark: SparkSession, root: str, out: str) -> DataFrame:
    """References matched to papers: flags written back into the context files, edges into the corpus; returns match counts."""
    papers = spark.read.parquet(f"{out}/all_papers.parquet")
    base = f"{root}/{paths.CONTEXTS}"
    files = reduce(DataFrame.unionByName, [scans.contexts(spark, base, conf) for conf in schema.VENUES])
    refs = files.select(plain(F.col("path")).alias("path"), F.posexplode("refs").alias("ref_pos", "ref")).select("path", "ref_pos", "ref.*").drop("in_dataset", "in_conference_list")
    refs = refs.withColumn("ref_id", F.concat_ws("#", "path", "ref_pos"))
    found = resolve.with_flags(resolve.resolve(refs.select("ref_id", "title", "year"), papers)).drop("title", "year")
    # The files are read and written, so their new rows are a table of their own first.
    sinks.write_parquet(refs.join(found, "ref_id"), f"{out}/resolved_references.parquet")
    resolved = spark.read.parquet(f"{out}/resolved_references.parquet")
    said = extract.nest_references(resolved, ["path"]).select("path", sinks.context_json(F.col("refs")).alias("json"))
    sinks.export_files(said, "path", "json").write.format("noop").mode("overwrite").save()

    placed = papers.select("paper_id", paths.corpus_to_contexts(F.col("path"), base).alias("path"))
    matched = resolved.filter("match_type <> 'no_match'").join(placed, "path")
    whole = with_references(papers, matched, edges_of(matched))
    sinks.write_parquet(whole, f"{out}/all_papers_with_refs.parquet")
    sinks.write_csv(whole, f"{out}/all_papers_with_refs.csv")
    return resolve.match_stats(resolved)


def run_labels(spark: SparkSession, root: str, out: str, limit: int | None = None) -> DataFrame:
    """Labels of the prompts' answers in the corpus' edges, and a report of the missing ones, which is returned."""
    papers = spark.read.parquet(f"{out}/all_papers_with_refs.parquet")
    papers = papers.orderBy("pos").limit(limit) if limit is not None else papers
    placed = papers.select("paper_id", F.col("title").alias("paper_title"), paths.corpus_to_scores(F.col("path"), f"{root}/prompt_scores").alias("prompt_scores_path"))
    edges = papers.select("paper_id", F.posexplode(F.from_json("references", f"array<{schema.EDGE}>")).alias("ref_pos", "edge")).select("paper_id", "ref_pos", "edge.*").drop(*labels.OUTPUTS)
    read = scans.all_scores(spark, f"{root}/prompt_scores").withColumn("prompt_scores_path", plain(F.col("path")))
    scores = read.join(placed, "prompt_scores_path").select("paper_id", F.col("ref_target").alias("target"), "row_pos", *labels.OUTPUTS)
    labelled = labels.attach_labels(edges, scores)
    whole = with_references(papers, labelled, F.struct("target", "matched_paper_id", "title", "title_from_ref", "venue", "year", *labels.OUTPUTS))
    sinks.write_parquet(whole, f"{out}/all_papers_with_refs_and_labels.parquet")
    sinks.write_csv(whole, f"{out}/all_papers_with_refs_and_labels.csv")
    lost = labels.missing_labels(edges, scores).join(placed, "paper_id")
    report = lost.select("paper_id", "paper_title", "prompt_scores_path", F.col("target").alias("missing_ref_target"), F.col("title_from_ref").alias("ref_title_from_ref"))
    sinks.write_json_lines(report, f"{out}/missing_labels.json")
    return spark.read.schema(report.schema).json(f"{out}/missing_labels.json")


def run_split(spark: SparkSession, out: str) -> None:
    """Core graph, training and evaluation tables from the labelled corpus."""
    papers = spark.read.parquet(f"{out}/all_papers_with_refs_and_labels.parquet")
    edges = papers.select("paper_id", F.explode(F.from_json("references", f"array<{schema.EDGE}>")).alias("e")).select("paper_id", "e.matched_paper_id")
    core = graph.reduce_graph(papers, edges)
    train, evaluation = graph.split_papers(core)
    for name, df in (("core_papers", core), ("train", train), ("eval", evaluation)):
        sinks.write_parquet(df, f"{out}/{name}.parquet")
        sinks.write_csv(df, f"{out}/{name}.csv")


def run_prompts(spark: SparkSession, conf: str, root: str, out: str) -> DataFrame:
    """Prompts of the context files that have none yet: rows appended to ``out``, and a file each; returns counts of the run."""
    base = f"{root}/{paths.CONTEXTS}"
    files = scans.contexts(spark, base, conf).withColumn("paper_file", plain(F.col("path")))
    files = _left(files, state(spark, out), "paper_file", False)
    title = paths.title_of_file(F.col("paper_file")).alias("paper_title")
    rows = files.select("paper_file", title, F.inline("refs"))
    target = F.concat_ws("/", paths.prompt_dir(F.col("paper_file"), base, f"{root}/prompts"), "file_name")
    sinks.write_parquet(prompts.prompt_stats(rows), f"{out}_stats")
    prompts.build_prompts(rows).withColumn("output_path", target).write.mode("append").parquet(out)

    # Files are written for all rows that have none, those of a run that was cut off before this step too.
    there = scans.existing(spark, [f"{root}/prompts/{conf}/*/*"])
    owed = spark.read.parquet(out).filter(F.col("output_path").startswith(f"{root}/prompts/{conf}/"))
    if there:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(there)
        owed = owed.join(files.select(plain(F.col("path")).alias("output_path")), "output_path", "left_anti")
    sinks.export_files(owed, "output_path", "text").write.format("noop").mode("overwrite").save()
    return spark.read.parquet(f"{out}_stats")


def client_of(name: str):
    """What makes a client, named as module:function."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def run_pdfs(spark: SparkSession, stage: str, conf: str, years: list[int], root: str, make_client, wanted: DataFrame | None = None) -> DataFrame:
    """Texts of the PDFs of a venue, or of a list of them, that have none yet; returns path, status and reason."""
    folder, target = PDF_STAGES[stage]
    pdfs = scans.files(spark, f"{root}/papers", "pdf", conf, years or None, content=True).withColumn("path", plain(F.col("path")))
    there = listing(spark, f"{root}/{folder}", "tei" if stage == "tei" else "markdown", (conf,)).select(F.col("path").alias("output_path"))
    left = pdfs.withColumn("output_path", target(F.col("path"), f"{root}/papers", f"{root}/{folder}")).join(there, "output_path", "left_anti")
    if wanted is not None:
        left = services.fallback_list(left, wanted, there.select(F.col("output_path").alias("path")))
    log = f"{root}/{folder}/.status/{conf}"
    parsed = services.parse_pdfs(left, make_client).withColumn("output_path", target(F.col("path"), f"{root}/papers", f"{root}/{folder}"))
    parsed.withColumns({"stage": F.lit(stage), "updated": F.current_timestamp()}).write.mode("overwrite").parquet(log)
    done = spark.read.parquet(log)
    sinks.export_files(done, "output_path", "text").write.format("noop").mode("overwrite").save()
    return done.select("path", "status", "reason")
