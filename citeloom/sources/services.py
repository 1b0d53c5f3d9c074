"""Stages that need an outside service or model: an interface, applied to PDFs in batches.

Neither service nor model is here; callers pass a client. ``echo`` is a stand-in for tests.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: What a TEI service and an OCR model are asked for.
TEI_SETTINGS = {"url": "http://localhost:8070", "timeout": 60, "batch": 1000, "sleep": 5}
OCR_SETTINGS = {"dpi": 96, "max_new_tokens": 3500, "repetition_penalty": 1.2}


def parse_pdfs(pdfs: DataFrame, make_client: Callable[[], Callable[[str, bytes], str | None]]) -> DataFrame:
    """path, status, reason and text of each PDF (path, content); the client is made once a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    text = client(path, content)
                    rows.append(("processed", "", text) if text else ("error", "no text returned", None))
                except Exception as e:  # one PDF's fault is a row
                    rows.append(("error", str(e)[:200], None))
            yield pd.DataFrame({"path": batch["path"].to_numpy(), "status": [r[0] for r in rows], "reason": [r[1] for r in rows], "text": [r[2] for r in rows]})

    return pdfs.select("path", "content").mapInPandas(run, "path string, status string, reason string, text string")


def echo() -> Callable[[str, bytes], str | None]:
    return lambda path, content: content.decode("utf-8")


def fallback_list(pdfs: DataFrame, wanted: DataFrame, outputs: DataFrame) -> DataFrame:
    """PDFs of a fixed list that exist and have no output yet."""
    return pdfs.join(wanted, "path", "left_semi").join(outputs.select("path"), "path", "left_anti")
