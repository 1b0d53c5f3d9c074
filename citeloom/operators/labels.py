"""Joins of relevance labels to citation edges, and the report of missing labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUTPUTS = ("type_1_output", "type_2_output", "type_3_output")


def last_scores(scores: DataFrame) -> DataFrame:
    """The last row (by ``row_pos``) of each paper and target."""
    last = F.max(F.struct("row_pos", *OUTPUTS)).alias("last")
    return scores.groupBy("paper_id", "target").agg(last).select("paper_id", "target", *[F.col(f"last.{c}").alias(c) for c in OUTPUTS])


def attach_labels(edges: DataFrame, scores: DataFrame, drop_type_2: bool = True) -> DataFrame:
    """Edges with their labels; without one the empty text. Type 2 is blanked unless asked for."""
    joined = edges.join(last_scores(scores), ["paper_id", "target"], "left")
    blank = {c: F.lit("") if c == "type_2_output" and drop_type_2 else F.coalesce(c, F.lit("")) for c in OUTPUTS}
    return joined.withColumns(blank)


def missing_labels(edges: DataFrame, scores: DataFrame) -> DataFrame:
    """Edges of papers that have scores but none for the edge's target."""
    with_scores = edges.join(scores.select("paper_id").distinct(), "paper_id", "left_semi")
    return with_scores.join(scores.select("paper_id", "target").distinct(), ["paper_id", "target"], "left_anti")
