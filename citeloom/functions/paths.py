"""Mappings between the paths of papers, parsed texts, contexts, prompts and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEI, ALT, OCR, CONTEXTS = "grobid_output", "marker_output", "nougat_output", "citation_contexts"
INPUT_DIRS = {"grobid": TEI, "nougat": OCR, "marker": ALT}


def relative_to(path: Column, base: str) -> Column:
    """The path below ``base``; outside of it, its last three components."""
    below = F.substring_index(path, base.rstrip("/") + "/", -1)
    return F.when(path.startswith(base.rstrip("/") + "/"), below).otherwise(F.substring_index(path, "/", -3))


def swap_suffix(path: Column, suffix: str) -> Column:
    return F.concat(F.regexp_replace(path, r"\.[^./]*$", ""), F.lit(suffix))


def pdf_to_tei(path: Column, base: str, out: str) -> Column:
    return F.concat(F.lit(out.rstrip("/") + "/"), swap_suffix(relative_to(path, base), ".grobid.tei.xml"))


def pdf_to_markdown(path: Column, base: str, out: str) -> Column:
    return F.concat(F.lit(out.rstrip("/") + "/"), swap_suffix(relative_to(path, base), ".md"))


def source_to_contexts(path: Column, base: str, out: str) -> Column:
    """Context file of a parsed text: a TEI suffix goes as a whole, any other last suffix alone."""
    below = relative_to(path, base)
    tei = F.regexp_replace(below, r"\.grobid\.tei\.xml$", ".json")
    return F.concat(F.lit(out.rstrip("/") + "/"), F.when(below.endswith(".grobid.tei.xml"), tei).otherwise(swap_suffix(below, ".json")))


def corpus_to_contexts(path: Column, root: str) -> Column:
    """Context file of a corpus row's path: what follows the first known directory, with its suffix changed."""
    below = path
    for name in (OCR, ALT, TEI):
        cut = F.substring(path, 1, 0)
        at = F.instr(path, f"{name}/")
        cut = F.substr(path, at + len(name) + 1)
        below = F.when(at > 0, cut).otherwise(below)
    json = F.when(below.endswith(".grobid.tei.xml"), F.regexp_replace(below, r"\.grobid\.tei\.xml$", ".json"))
    json = json.when(below.endswith(".xml"), F.regexp_replace(below, r"\.xml$", ".json")).when(below.endswith(".md"), F.regexp_replace(below, r"\.md$", ".json"))
    return F.concat(F.lit(root.rstrip("/") + "/"), json.otherwise(below))


def metadata_to_contexts(pdf_path: Column, root: str) -> Column:
    """Context file of a metadata row's PDF path: the first "/papers" of the whole path, root included, is replaced."""
    whole = F.concat(F.lit(root.rstrip("/") + "/"), F.regexp_replace(pdf_path, r"^data/", ""))
    at = F.instr(whole, "/papers")
    moved = F.concat(F.substr(whole, F.lit(1), F.greatest(at - 1, F.lit(0))), F.lit(f"/{CONTEXTS}"), F.substr(whole, at + len("/papers")))
    return F.replace(F.when(at > 0, moved).otherwise(whole), F.lit(".pdf"), F.lit(".json"))


def corpus_to_scores(path: Column, root: str) -> Column:
    """Score file of a corpus row's path, whatever tool parsed it."""
    below = F.regexp_replace(path, rf"^.*?({TEI}|{OCR}|{ALT})/", "")
    stem = F.regexp_replace(F.regexp_replace(below, r"\.grobid\.tei\.xml$", ""), r"\.(xml|md)$", "")
    return F.concat(F.lit(root.rstrip("/") + "/"), stem, F.lit(".csv"))


def title_of_file(path: Column) -> Column:
    """Paper title from a file name: what follows the first underscore of the stem, with spaces."""
    stem = F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")
    at = F.instr(stem, "_")
    return F.replace(F.when(at > 0, F.substr(stem, at + 1)).otherwise(stem), F.lit("_"), F.lit(" "))


def prompt_dir(path: Column, base: str, out: str) -> Column:
    below = relative_to(path, base)
    return F.concat(F.lit(out.rstrip("/") + "/"), F.regexp_replace(below, r"\.[^./]*$", ""))


def is_year_dir(name: Column) -> Column:
    return name.rlike(r"^\p{Nd}+$")


def input_dir(source: str, conf: str) -> str:
    if source not in INPUT_DIRS:
        raise ValueError(f"unknown source {source}")
    return f"{INPUT_DIRS[source]}/{conf}"
