"""Scalar functions over titles, ids and reference strings, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom.schema import NAMESPACE, STOP_WORDS


def collapse_space(text: Column) -> Column:
    """Runs of Unicode white space become one space; none at the ends."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), r"^ +| +$", "")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def normalize_title(title: Column) -> Column:
    """Lower case, letters, digits, underscores and single spaces only; null is empty."""
    kept = F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), r"(?U)[^\p{L}\p{N}_\s]", "")
    return F.trim(F.regexp_replace(kept, r"(?U)\s+", " "))


def title_words(normalized: Column) -> Column:
    """Distinct words of a normalized title, without stop words and empty strings."""
    return F.filter(F.array_distinct(F.split(normalized, " ")), lambda w: (w != "") & ~w.isin(*STOP_WORDS))


def uuid5(key: Column, namespace: str = NAMESPACE) -> Column:
    """Version 5 UUID of a name: SHA-1 over namespace and name, with version and variant set."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(key, "UTF-8")))
    variant = F.substring(F.lit("89ab"), 1, 4)
    nibble = F.instr(F.lit("0123456789abcdef"), F.substring(digest, 17, 1)) - 1
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-5"), F.substring(digest, 14, 3), F.lit("-"),
        F.substr(variant, nibble % 4 + 1, F.lit(1)), F.substring(digest, 18, 3), F.lit("-"), F.substring(digest, 21, 12),
    )


def paper_id(title: Column, venue: Column, year: Column, original: Column, namespace: str = NAMESPACE) -> Column:
    """Id that a paper keeps across runs, from its title, venue, year and original id."""
    part = lambda c: strip(F.lower(F.coalesce(c, F.lit(""))))
    return uuid5(F.concat_ws("|", strip(F.lower(F.coalesce(title, F.lit("")))), part(venue), year.cast("int").cast("string"), part(original)), namespace)


def extract_year(reference: Column) -> Column:
    """Year of a reference string: in brackets, in parentheses, before a period, at the end, else the last 19xx or 20xx."""
    text = F.regexp_replace(strip(reference), r"^[*\-•]\s*", "")

    def first(pattern: str) -> Column:
        found = F.regexp_extract(text, pattern, 1)
        return F.when(found != "", found)

    every = F.regexp_extract_all(text, F.lit(r"(?U)\b((?:19|20)[0-9]{2})\b"), F.lit(1))
    last = F.when(F.size(every) > 0, F.element_at(every, F.when(F.size(every) > 0, F.size(every)).otherwise(1)))
    return F.coalesce(
        first(r"\[([0-9]{4})[a-z]?\]"), first(r"\(([0-9]{4})[a-z]?\)"), first(r"(?:^|(?U:\s))([0-9]{4})[a-z]?\."), first(r",(?U:\s)*([0-9]{4})[a-z]?(?U:\s)*\.?(?U:\s)*$"), last
    ).cast("int")


def clean_title(title: Column) -> Column:
    """A title without emphasis, maths, citation notes, leading numbers and surplus space."""
    out = F.regexp_replace(title, r"\.+$", "")
    out = F.replace(F.replace(strip(out), F.lit("_"), F.lit("")), F.lit("**"), F.lit(""))
    for pattern, by in ((r",?\s*Cited by:.*$", ""), (r"\\\(.*?\\\)", ""), (r"\{\\text\{([^}]*)\}\}", "$1"), (r"\$[^$]*\$", ""), (r"(?U)\s+", " "), (r"^[0-9]+\.\s*", "")):
        out = F.regexp_replace(out, pattern, by)
    return strip(out)


def marker_ids(text: Column) -> Column:
    """Distinct ids of the citation markers in a text, in order."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"\(citation #([^)]+)\)"), F.lit(1)))


def window3(sentences: Column, index: Column) -> Column:
    """Three sentences around the one at ``index`` (from 0); at an end, the two next to it on the other side."""
    size = F.size(sentences)
    start = F.greatest(F.lit(0), F.least(index - 1, size - 3))
    return F.array_join(F.slice(sentences, start + 1, 3), " ")


def format_contexts(contexts: Column) -> Column:
    """Numbered section and context lines; no contexts give the empty text."""
    lines = F.transform(contexts, lambda c, i: F.concat((i + 1).cast("string"), F.lit('. Section: "'), c["section"], F.lit('"\n   Context: "'), c["context"], F.lit('"')))
    return F.array_join(lines, "\n")


def citation_info(cite: Column, title: Column) -> Column:
    return F.concat(F.lit('"cited_as": "'), cite, F.lit('", "title": "'), title, F.lit('"'))


def prompt_file(target: Column, kind: int, empty: Column) -> Column:
    return F.concat(F.lit("ref_"), target, F.lit(f"_type_{kind}"), F.when(empty, F.lit("_empty")).otherwise(F.lit("")), F.lit(".txt"))
