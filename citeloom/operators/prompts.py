"""Scoring prompts for citations that are in the corpus or in a listed venue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.text import citation_info, format_contexts, prompt_file

SYSTEM = {
    1: "You judge citations of research papers. Reply 1 if the paper compares its results with the cited work, else 0. Reply with the digit alone.",
    2: "You judge citations of research papers. Rate from 1 (passing mention) to 5 (essential) how much the paper's task and method rest on the cited work. Reply with the digit alone.",
}
QUESTION = {
    1: "Does the paper compare itself with this work in its experiments?\nAnswer:",
    2: "How much does the paper rest on this work?\nScore:",
}


def eligible(refs: DataFrame) -> DataFrame:
    return refs.filter(F.coalesce("in_dataset", F.lit(False)) | F.coalesce("in_conference_list", F.lit(False)))


def prompt_text(kind: int, paper_title: Column, cite: Column, title: Column, contexts: Column) -> Column:
    return F.concat(
        F.lit(f"[SYSTEM]\n{SYSTEM[kind]}\n\n[USER]\nPaper Title: "), paper_title, F.lit("\n\nCitation: "), citation_info(cite, title),
        F.lit("\n\nCitation Contexts:\n"), format_contexts(contexts), F.lit(f"\n\n{QUESTION[kind]}"),
    )


def build_prompts(refs: DataFrame) -> DataFrame:
    """Two rows for each eligible reference (paper_file, paper_title, target, title, cite, contexts, flags)."""
    kept = eligible(refs).withColumn("is_empty", F.size("contexts") == 0)
    both = None
    for kind in SYSTEM:
        text = prompt_text(kind, F.col("paper_title"), F.col("cite"), F.col("title"), F.col("contexts"))
        rows = kept.select("paper_file", "target", F.lit(kind).alias("prompt_type"), "is_empty", prompt_file(F.col("target"), kind, F.col("is_empty")).alias("file_name"), text.alias("text"))
        both = rows if both is None else both.unionByName(rows)
    return both


def prompt_stats(refs: DataFrame) -> DataFrame:
    """By paper file: references, prompts generated, and those without contexts."""
    kept = F.coalesce("in_dataset", F.lit(False)) | F.coalesce("in_conference_list", F.lit(False))
    empty = kept & (F.size("contexts") == 0)
    return refs.groupBy("paper_file").agg(F.count("*").alias("total"), F.sum(F.when(kept, 2).otherwise(0)).alias("generated"), F.sum(F.when(empty, 2).otherwise(0)).alias("empty"))
