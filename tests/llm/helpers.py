"""Small fixtures and brute-force forms that the operators are held against."""

import hashlib
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, **columns):
    """documents rows with ids from 0; columns give lists for lang and source."""
    lang = columns.get("lang", [None] * len(texts))
    source = columns.get("source", ["s"] * len(texts))
    ids = columns.get("ids", list(range(len(texts))))
    return spark.createDataFrame([(i, t, x, s, None if t is None else len(t)) for i, t, x, s in zip(ids, texts, lang, source, strict=True)], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
