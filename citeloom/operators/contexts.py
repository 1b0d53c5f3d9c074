"""Citation contexts: section labels, merged runs, sentence windows, first occurrences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.text import marker_ids, window3


def forward_fill(df: DataFrame, keys: list[str], order: list[str], label: str, out: str) -> DataFrame:
    """``out``: the last non-null label at or before each row, within its document."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(label, ignorenulls=True).over(w))


def run_ids(df: DataFrame, keys: list[str], order: list[str], kind: str, out: str = "run") -> DataFrame:
    """Number of each row's run of equal kinds, from 1: a running sum of the runs' first rows."""
    w = Window.partitionBy(*keys).orderBy(*order)
    starts = F.when(F.col(kind).eqNullSafe(F.lag(kind).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return df.withColumn("starts__", starts).withColumn(out, F.sum("starts__").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("starts__")


def section_of(occurrences: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """Occurrences (keys, pos) with the ``label`` of the span (keys, start, end, label) that holds them, or the empty text.

    An equality on the document's keys carries the range condition, so no nested loop is planned.
    """
    spans = spans.select(*[F.col(k).alias(f"s_{k}") for k in keys], "start", "end", "label")
    same = [F.col(k) == F.col(f"s_{k}") for k in keys]
    held = occurrences.join(spans, same + [(F.col("start") <= F.col("pos")) & (F.col("pos") < F.col("end"))], "left")
    return held.select(*occurrences.columns, F.coalesce("label", F.lit("")).alias("section"))


def windows_of_sentences(df: DataFrame, sentences: str, valid: Column | None = None) -> DataFrame:
    """One row for each marker of each sentence: ``target``, ``sentence_pos`` and the three-sentence ``context``."""
    placed = df.select("*", F.posexplode(sentences).alias("sentence_pos", "sentence"))
    marked = placed.filter(F.contains("sentence", F.lit("(citation #"))).withColumn("target", F.explode(marker_ids(F.col("sentence"))))
    out = marked.withColumn("context", window3(F.col(sentences), F.col("sentence_pos")))
    return out.filter(valid) if valid is not None else out


def first_occurrences(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row in order of each group of equal keys: which row stays matters, so no dropDuplicates."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("nth__", F.row_number().over(w)).filter("nth__ = 1").drop("nth__")


def renumber(df: DataFrame, keys: list[str], order: list[str], out: str = "target") -> DataFrame:
    """Dense targets b0, b1, ... in order, within each document."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.concat(F.lit("b"), (F.row_number().over(w) - 1).cast("string")))


def drop_yearless(refs: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """References with a year, renumbered; ``source_id`` keeps the number before."""
    return renumber(refs.filter(F.col("year").isNotNull()).withColumn("source_id", F.col("target")), keys, order)


def nest_contexts(bibliography: DataFrame, contexts: DataFrame, keys: list[str]) -> DataFrame:
    """Every reference with the ordered list of its contexts (``context_pos``, section, context); none gives []."""
    listed = contexts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("context_pos", "section", "context"))).alias("found"))
    plain = F.transform("found", lambda c: F.struct(c["section"].alias("section"), c["context"].alias("context")))
    joined = bibliography.join(listed, keys, "left")
    return joined.select(*bibliography.columns, F.coalesce(plain, F.array().cast("array<struct<section:string,context:string>>")).alias("contexts"))
