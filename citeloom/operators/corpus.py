"""Corpus builder: metadata joined to existing files, ids, order, duplicate report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions import paths
from citeloom.functions.text import paper_id


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """All rows of ids that occur more than once: counts first, so no group meets in one task."""
    return df.join(df.groupBy(key).count().filter("count > 1").select(key), key, "left_semi")


def in_order(df: DataFrame, *order: str, out: str = "pos") -> DataFrame:
    """Position of each row, from 0, in a global order: range-sorted partitions and their offsets.

    No single task sorts or numbers the whole table.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ranged.withColumn("n__", F.monotonically_increasing_id())
    part, row = F.shiftright("n__", 33), F.col("n__").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return numbered.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn(out, F.col("offset") + row).drop("part", "n__", "offset")


def pick_sources(papers: DataFrame, files: dict[str, DataFrame], key: str) -> DataFrame:
    """``source_path``: the first of the listings (in order) that has the paper, else the empty text."""
    out, found = papers, []
    for name, listing in files.items():
        out = out.join(listing.select(F.col(key), F.col("path").alias(f"path_{name}")), key, "left")
        found.append(F.col(f"path_{name}"))
    return out.withColumn("source_path", F.coalesce(*found, F.lit(""))).drop(*[f"path_{n}" for n in files])


def build_corpus(metadata: DataFrame, pdfs: DataFrame, contexts: DataFrame, sources: dict[str, DataFrame], root: str) -> DataFrame:
    """Paper rows from metadata (D1 fields with ``conf``, ``file_year``, ``json_pos``).

    Kept are papers with a PDF path whose PDF and context file exist (listings with ``path``); a
    missing year or venue defaults to the file's.
    """
    named = metadata.filter(F.coalesce("pdf_path", F.lit("")) != "")
    pdf = F.concat(F.lit(root.rstrip("/") + "/"), F.regexp_replace("pdf_path", r"^data/", ""))
    context = paths.metadata_to_contexts(F.col("pdf_path"), root)
    here = named.withColumn("pdf__", pdf).withColumn("ctx__", context)
    here = here.join(pdfs.select(F.col("path").alias("pdf__")), "pdf__", "left_semi").join(contexts.select(F.col("path").alias("ctx__")), "ctx__", "left_semi")
    stem = F.regexp_replace(F.regexp_replace("pdf_path", r"^data/", ""), r"\.[^./]*$", "")
    picked = pick_sources(here.withColumn("stem", F.regexp_replace(stem, "^[^/]*/?papers/", "")), sources, "stem")
    venue, year = F.coalesce("conference", "conf"), F.coalesce("year", "file_year").cast("int")
    rows = picked.select(
        paper_id(F.col("title"), venue, year, F.col("id").cast("string")).alias("paper_id"), F.col("source_path").alias("path"), F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("abstract", F.lit("")).alias("abstract"), year.alias("year"), venue.alias("venue"), F.to_json(F.coalesce("authors", F.array().cast("array<string>"))).alias("authors"),
        F.coalesce("bibtex", F.lit("")).alias("bibtex"), F.lit("[]").alias("references"), "conf", "file_year", "json_pos",
    )
    return in_order(rows, "year", "venue", "conf", "file_year", "json_pos").drop("conf", "file_year", "json_pos")
