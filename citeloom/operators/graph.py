"""Citation graph: one-hop reduction around core venues, and temporal splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.schema import CALENDAR, CORE_VENUES, EVAL_YEARS, TRAIN_YEARS


def year_range(years: int | tuple[int, ...]) -> tuple[int, int]:
    return (years, years) if isinstance(years, int) else (min(years), max(years))


def format_years(years: int | tuple[int, ...]) -> str:
    start, end = year_range(years)
    return str(start) if start == end else f"{start}-{end}"


def core_papers(papers: DataFrame, core: tuple[str, ...] = CORE_VENUES) -> DataFrame:
    return papers.filter(F.col("venue").isin(*core))


def cited_ids(papers: DataFrame, edges: DataFrame, core: tuple[str, ...] = CORE_VENUES) -> DataFrame:
    """Ids of papers outside the core venues that core papers cite; targets outside the corpus drop out."""
    sources = core_papers(papers, core).select("paper_id")
    targets = edges.join(sources, "paper_id", "left_semi").select(F.col("matched_paper_id").alias("paper_id")).distinct()
    venues = papers.filter(F.col("venue").isNotNull() & (F.col("venue") != "") & ~F.col("venue").isin(*core)).select("paper_id")
    return targets.join(venues, "paper_id", "left_semi")


def reduce_graph(papers: DataFrame, edges: DataFrame, core: tuple[str, ...] = CORE_VENUES) -> DataFrame:
    """Core papers and the papers they cite directly."""
    keep = core_papers(papers, core).select("paper_id").union(cited_ids(papers, edges, core)).distinct()
    return papers.join(keep, "paper_id", "left_semi")


def split_papers(papers: DataFrame, core: tuple[str, ...] = CORE_VENUES, train=TRAIN_YEARS, evaluation=EVAL_YEARS) -> tuple[DataFrame, DataFrame]:
    """Training papers of any venue by year, evaluation papers of core venues by year."""
    return papers.filter(in_years(F.col("year"), train)), papers.filter(in_years(F.col("year"), evaluation) & F.col("venue").isin(*core))


def in_years(year: Column, years) -> Column:
    return year.between(*year_range(years))


def calendar(spark) -> DataFrame:
    """Venue and year of every cell of the venue calendar."""
    rows = [(v, y) for v, (a, b, parity) in CALENDAR.items() for y in range(a, b + 1) if not parity or (y % 2 == 0) == (parity == "even")]
    return spark.createDataFrame(rows, "venue string, year int")
