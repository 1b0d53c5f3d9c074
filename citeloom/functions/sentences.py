"""Sentence boundaries of scholarly prose, as plain functions and as an Arrow UDF.

Every test looks at the text around one position only, so all positions can be tested alike.
"""

from __future__ import annotations

import itertools
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Words that end with a dot without ending a sentence (case counts).
ABBREVIATIONS = frozenset(
    "al et Dr Prof Mr Mrs Ms Jr Sr St ibid viz ca approx resp Fig Figs Eq Eqs Sec Secs Ref Refs Tab App Vol No Nos pp Chap Dept Univ Prop Thm Lem Cor Def Ex Inc Ltd Corp Co ed eds trans rev pt".split()
)
# Fixed value: two or more short words with dots, as in "i.e." or "Ph.D.".
_DOTTED = re.compile(r"(?:[A-Za-z]{1,4}\.){2,}\Z")
_MARKS = re.compile(r"[.!?()]")
#: How far back an open parenthesis counts.
REACH = 200


#: A version number before a dot, as in "v1.2".
_VERSION = re.compile(r"[vV][\d.]*\d\Z")


def dot_is_inner(text: str, at: int) -> bool:
    """Whether the dot at a position can't end a sentence: within a number, a name or an address,
    after an abbreviation, or after an initial."""
    left, right = text[max(0, at - 1) : at], text[at + 1 : at + 2]
    word = "".join(itertools.takewhile(str.isalpha, reversed(text[max(0, at - REACH) : at])))[::-1]
    dotted = _DOTTED.search(text[max(0, at - 15) : at + 1]) is not None
    within = right in ("/", ".") if right else False
    within = within or left.isalnum() and right.isalnum() or dotted and right.isalpha()
    short = word in ABBREVIATIONS or len(word) == 1 and word.isupper() and not dotted
    return within or short or _VERSION.search(text[max(0, at - REACH) : at]) is not None


def split_sentences(text: str | None) -> list[str]:
    """Trimmed sentences. A mark ends one unless it is an inner dot, stands in parentheses opened at
    most ``REACH`` characters before, or is followed (within nine characters) by something other than
    a capital letter, an opening bracket or a quote."""
    if not text:
        return []
    out, start, opened = [], 0, []
    for found in _MARKS.finditer(text):
        at, mark = found.start(), found.group()
        if mark == "(":
            opened.append(at)
        elif mark == ")":
            if opened:
                opened.pop()
        elif not (opened and opened[-1] > at - REACH) and not (mark == "." and dot_is_inner(text, at)):
            after = text[at + 1 : at + 10].lstrip()[:1]
            if not after or after.isupper() or after in "(\"'[":
                out.append(text[start : at + 1].strip())
                start = at + 1
    out.append(text[start:].strip())
    return [s for s in out if s]


def begins_at(text: str, at: int) -> bool:
    """Whether a sentence begins at a position: after a mark that ends one, or after a blank line."""
    mark = text[at - 1 : at] if at > 0 else ""
    if mark in (".", "!", "?") or mark == "":
        if mark == "." and dot_is_inner(text, at - 1):
            return False
        after = text[at : at + 3].lstrip()[:1]
        return bool(after) and (after.isupper() or after in "([")
    return mark == "\n" and at >= 2 and text[at - 2] == "\n"


def ends_at(text: str, at: int) -> bool:
    """Whether a sentence ends at a position: with a mark, without a look at what follows, or a blank line."""
    mark = text[at : at + 1]
    if mark in (".", "!", "?") or mark == "":
        return not (mark == "." and dot_is_inner(text, at))
    return mark == "\n" and text[at + 1 : at + 2] == "\n"


def window(sentences: list[str], index: int) -> str:
    """Three sentences around one; at an end, the next two or the last two with it."""
    first = max(0, min(index - 1, len(sentences) - 3))
    return " ".join(sentences[first : first + 3])


@F.pandas_udf(ArrayType(StringType()))
def sentences(texts: pd.Series) -> pd.Series:
    return texts.map(split_sentences)
