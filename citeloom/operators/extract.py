"""Document parsing as table operators: one input row a document, one output row with its references.

Parsing is Python, in Arrow batches; a document that can't be parsed gives a row with its error and
never fails the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.functions import altmd, citations, tei
from citeloom.operators.contexts import drop_yearless
from citeloom.schema import CONTEXT

REFERENCES = f"array<struct<target:string,title:string,year:int,cite:string,contexts:array<{CONTEXT}>>>"
MISMATCH = "letter tags in references, numbers in the text"


def _parser(source: str, exclude_appendix: bool) -> Callable:
    if source == "tei":
        return lambda doc: tei.contexts_of_tei(doc, exclude_appendix)
    if source == "ocr":
        return lambda doc: citations.contexts_of_markdown(doc, exclude_appendix)
    if source == "alt":
        return altmd.contexts_of_alternative
    raise ValueError(f"unknown source {source}")


def parse_one(parse: Callable, doc) -> tuple[str, str, list[dict]]:
    """(status, reason, references) of a document: processed, skipped or error."""
    try:
        found = parse(doc)
    except Exception as e:  # any fault of one document is a row, not a failure of the job
        return "error", f"{type(e).__name__}: {e}"[:500], []
    return ("skipped", MISMATCH, []) if found is None else ("processed", "", found)


def extract_contexts(docs: DataFrame, source: str, content_col: str = "content", exclude_appendix: bool = False) -> DataFrame:
    """docs with ``status``, ``reason`` and ``refs`` instead of their content.

    source: ``tei`` (binary or text XML), ``ocr`` or ``alt`` (text markdown).
    """
    _parser(source, exclude_appendix)  # an unknown source fails here, not on the executors
    rest = [c for c in docs.columns if c != content_col]
    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in rest)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parse = _parser(source, exclude_appendix)
        for batch in batches:
            found = [parse_one(parse, doc) for doc in batch[content_col]]
            yield batch[rest].assign(status=[f[0] for f in found], reason=[f[1] for f in found], refs=[f[2] for f in found])

    return docs.mapInPandas(run, f"{kinds}status string, reason string, refs {REFERENCES}")


def references_of(extracted: DataFrame, keys: list[str]) -> DataFrame:
    """One row a reference with a year, renumbered densely within its document."""
    rows = extracted.select(*keys, F.posexplode("refs").alias("ref_pos", "ref")).select(*keys, "ref_pos", "ref.*")
    return drop_yearless(rows, keys, ["ref_pos"])


def nest_references(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row a document with the list of its references in order."""
    fields = [c for c in ("target", "title", "year", "cite", "contexts", "in_dataset", "in_conference_list") if c in rows.columns]
    listed = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("ref_pos", *fields))).alias("refs"))
    return listed.withColumn("refs", F.transform("refs", lambda r: F.struct(*[r[f].alias(f) for f in fields])))
