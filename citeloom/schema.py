"""Schemas of the data model and its constants."""

from __future__ import annotations

import os

CONTEXT = "struct<section:string,context:string>"
REFERENCE = f"struct<target:string,title:string,year:int,cite:string,contexts:array<{CONTEXT}>,in_dataset:boolean,in_conference_list:boolean>"
EDGE = "struct<target:string,matched_paper_id:string,title:string,title_from_ref:string,venue:string,year:int,type_1_output:string,type_2_output:string,type_3_output:string>"

METADATA = "id string, title string, abstract string, authors array<string>, bibtex string, year int, conference string, pdf_path string"
PAPER = "paper_id string, path string, title string, abstract string, year int, venue string, authors string, bibtex string, references string"
SCORES = "ref_target string, type_1_output string, type_2_output string, type_3_output string"
STATUS = "stage string, output_path string, status string, reason string, updated timestamp"

# Each venue's first and last year, and whether only even or only odd years count.
CALENDAR = {
    "aaai": (2010, 2025, ""), "acl": (2017, 2025, ""), "aistats": (2009, 2025, ""), "colt": (2011, 2025, ""),
    "cvpr": (2013, 2025, ""), "eccv": (2018, 2024, "even"), "emnlp": (2017, 2025, ""), "iccv": (2013, 2025, "odd"),
    "iclr": (2013, 2026, ""), "icml": (2013, 2025, ""), "ijcai": (2017, 2025, ""), "jmlr": (2000, 2025, ""),
    "naacl": (2013, 2025, ""), "neurips": (2000, 2025, ""), "uai": (2015, 2025, ""),
}
VENUES = tuple(CALENDAR)
CORE_VENUES = ("neurips", "icml", "iclr")
TRAIN_YEARS = (2018, 2024)
EVAL_YEARS = (2025, 2025)

# Fixed value: the namespace of paper ids, unless the environment has another.
NAMESPACE = os.environ.get("PAPER_UUID_NAMESPACE", "f47ac10b-58cc-4372-a567-0d02b2c3d479")
# Words of titles that find no candidates.
STOP_WORDS = ("a", "an", "the", "and", "or", "in", "on", "of", "for", "with", "to", "is", "at")
