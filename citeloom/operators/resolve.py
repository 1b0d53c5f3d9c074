"""Reference resolution: exact title match, then the best similar title among blocked candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.similarity import CUTOFF, title_similarity
from citeloom.functions.text import normalize_title, title_words
from citeloom.schema import VENUES

TOP = 25


def title_dictionary(papers: DataFrame) -> DataFrame:
    """``norm`` of every title with the paper that stands first in corpus order (``pos``).

    An aggregate rather than a window, so a title that very many papers share is reduced map-side.
    """
    first = F.min(F.struct("pos", "paper_id", "title", "venue")).alias("first")
    keyed = papers.select(normalize_title(F.col("title")).alias("norm"), "pos", "paper_id", "title", "venue")
    return keyed.groupBy("norm").agg(first).select("norm", F.col("first.pos").alias("pos"), F.col("first.paper_id").alias("paper_id"), F.col("first.title").alias("title"), F.col("first.venue").alias("venue"))


def exact_matches(refs: DataFrame, papers: DataFrame) -> DataFrame:
    """refs with ``matched_paper_id``, ``matched_title``, ``venue`` of the first paper with the same title, or null."""
    found = title_dictionary(papers).select("norm", F.col("paper_id").alias("matched_paper_id"), F.col("title").alias("matched_title"), "venue")
    return refs.withColumn("norm", normalize_title(F.col("title"))).join(found, "norm", "left")


def candidates(refs: DataFrame, papers: DataFrame, top: int = TOP) -> DataFrame:
    """(ref_id, pos, overlap, rank): papers by shared title words, within a year of the reference.

    Both sides explode their distinct words and meet on them; ties go to the lower position.
    """
    asked = refs.select("ref_id", F.col("year").alias("ref_year"), F.explode(title_words(normalize_title(F.col("title")))).alias("word"))
    held = papers.select("pos", F.col("year").alias("paper_year"), F.explode(title_words(normalize_title(F.col("title")))).alias("word"))
    near = asked.join(held, "word").filter(F.col("paper_year").isNotNull() & (F.col("ref_year").isNull() | (F.abs(F.col("paper_year") - F.col("ref_year")) <= 1)))
    counted = near.groupBy("ref_id", "pos").agg(F.count("*").alias("overlap"))
    order = Window.partitionBy("ref_id").orderBy(F.col("overlap").desc(), "pos")
    return counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def fuzzy_matches(refs: DataFrame, papers: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """(ref_id, pos, score): the most similar candidate of each reference that reaches the cut-off."""
    named = candidates(refs, papers).join(refs.select("ref_id", normalize_title(F.col("title")).alias("a")), "ref_id")
    named = named.join(papers.select("pos", normalize_title(F.col("title")).alias("b")), "pos")
    scored = named.withColumn("score", title_similarity("a", "b")).filter(F.col("score") >= cutoff)
    best = F.min(F.struct((-F.col("score")).alias("less"), "rank", "pos")).alias("best")
    return scored.groupBy("ref_id").agg(best).select("ref_id", F.col("best.pos").alias("pos"), (-F.col("best.less")).alias("score"))


def resolve(refs: DataFrame, papers: DataFrame) -> DataFrame:
    """refs (ref_id, title, year, ...) with matched paper, its title and venue, and ``match_type``."""
    exact = exact_matches(refs, papers)
    open_refs = exact.filter(F.col("matched_paper_id").isNull()).select("ref_id", "title", "year")
    info = papers.select("pos", F.col("paper_id").alias("f_id"), F.col("title").alias("f_title"), F.col("venue").alias("f_venue"))
    fuzzy = fuzzy_matches(open_refs, papers).join(info, "pos").select("ref_id", "f_id", "f_title", "f_venue")
    both = exact.join(fuzzy, "ref_id", "left")
    kind = F.when(F.col("matched_paper_id").isNotNull(), "exact").when(F.col("f_id").isNotNull(), "fuzzy").otherwise("no_match")
    none = F.lit("")
    return both.select(
        *[c for c in refs.columns],
        kind.alias("match_type"),
        F.coalesce("matched_paper_id", "f_id", none).alias("matched_paper_id"),
        F.coalesce("matched_title", "f_title", none).alias("matched_title"),
        F.coalesce("venue", "f_venue", none).alias("matched_venue"),
    )


def with_flags(resolved: DataFrame, venues: tuple[str, ...] = VENUES) -> DataFrame:
    """``in_dataset`` and ``in_conference_list`` of resolved references."""
    return resolved.withColumns({"in_dataset": F.col("match_type") != "no_match", "in_conference_list": F.lower("matched_venue").isin(*venues)})


def match_stats(resolved: DataFrame) -> DataFrame:
    """Counts by match type, and their total."""
    return resolved.rollup("match_type").agg(F.count("*").alias("n")).select(F.coalesce("match_type", F.lit("total")).alias("match_type"), "n")
