"""Corpus pipeline over ``documents``: language ID, exact dedup, near-duplicate removal, mixing to
target weights, SentencePiece encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's docs. All but the last return the columns of ``documents``. All
stages handle nulls in any column, empty texts, repeated rows, empty tables and extra columns, which
they pass on (the last returns ids and digests only).

A stage's docs are the written output of the stage before, so the tables that the stage before
staged on its way are deleted when the next one begins, unless its docs still read them.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from citeloom.llm import exact_dedup, language_id, mixing, ngram_join, sentencepiece_codec
from citeloom.llm.common import drop_paths, drop_staged, recorded, stage
from citeloom.llm.queries import piece_model

#: Documents with letters are rejected below this share of n-grams that their language accounts for.
MIN_HIT_RATE = 0.1
#: Texts of fewer characters are kept if they have a letter: too short for that test.
MIN_CHARS = 40

#: Staged tables that the last stage called has left, by application.
_LEFT: dict[str, list[str]] = {}


def _frees_the_last(step: Callable) -> Callable:
    @functools.wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        left = _LEFT.pop(app, [])
        reads = docs.inputFiles() if left else []
        drop_paths(spark, [p for p in left if not any(p.rsplit("/", 1)[-1] in f for f in reads)])
        with recorded() as paths:
            out = step(spark, docs, sf_dir)
        _LEFT[app] = paths
        return out

    return run


@_frees_the_last
def language_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; texts without letters or like none of them go.

    The model learns from the labelled documents outside the held-out quarter.
    """
    model = language_id.train(docs.filter(~language_id.held_out()))
    return language_id.known_rows(docs, model, MIN_HIT_RATE, MIN_CHARS)


@_frees_the_last
def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the smallest id."""
    return exact_dedup.kept_rows(docs)


@_frees_the_last
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar documents (five words, 80 per cent): the smallest id."""
    return ngram_join.one_of_each(docs, width=5, percent=80)


@_frees_the_last
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them; a document that it cuts off ends at that word."""
    return mixing.mixed_rows(docs)


@_frees_the_last
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of every document's ids and decoded text."""
    return sentencepiece_codec.digests(sentencepiece_codec.encode(docs, piece_model()))


STAGES = [
    ("language_id", language_filter),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("mixing", mix),
    ("sentencepiece", encode),
]

#: Language models and vocabularies can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, step) in enumerate(STAGES[:-1]):
        before, docs = docs, stage(step(spark, docs, sf_dir), name)
        if number:
            drop_staged(before)
    return STAGES[-1][1](spark, docs, sf_dir)
