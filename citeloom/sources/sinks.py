"""Sinks: tables, CSV mirrors, one file a paper, reports."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, quoted as RFC 4180 asks, line breaks kept."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def export_files(df: DataFrame, path_col: str, text_col: str) -> DataFrame:
    """Write each row's text to its own file (a shared folder) and return what was written.

    Rows without text are errors and write nothing; a file is put in place by a rename, so a task
    that runs twice leaves one whole file.
    """

    def run(batches):
        for batch in batches:
            states = []
            for path, text in zip(batch[path_col], batch[text_col], strict=True):
                if text:
                    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
                    part = f"{path}.{os.getpid()}.part"
                    with open(part, "w", encoding="utf-8") as file:
                        file.write(text)
                    os.replace(part, path)
                states.append("processed" if text else "error")
            yield batch[[path_col]].assign(status=states)

    return df.select(path_col, text_col).mapInPandas(run, f"{path_col} string, status string")


def context_json(refs: Column) -> Column:
    """References as JSON text, characters outside ASCII as they are."""
    return F.to_json(refs)
