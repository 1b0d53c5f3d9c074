"""TEI documents: bibliography, section labels, paragraphs with citation markers, contexts.

The tree is walked once; divisions are known by their place in the walk, not by source lines, so two
divisions on one line can't be mixed up.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from xml.etree import ElementTree

from citeloom.functions.sentences import split_sentences, window

_NS = "{http://www.tei-c.org/ns/1.0}"
_ID = "{http://www.w3.org/XML/1998/namespace}id"
_YEAR = re.compile(r"(?:19|20)\d{2}")
# Fixed value: how heads of an appendix begin.
_APPENDIX = re.compile(r"(?:Appendix|[A-F]\.)", re.IGNORECASE)
_MARKER = re.compile(r"\(citation #([^)]+)\)")
APPENDIX = "Appendix"


@dataclass
class Entry:
    id: str
    title: str
    year: int | None
    authors: list[str]

    @property
    def valid(self) -> bool:
        """Worth linking to: a title of more than three characters, or an author."""
        return len(self.title.strip()) > 3 or bool(self.authors)


def _find(element, path: str):
    return element.find(path, {"": _NS[1:-1]})


def _all(element, path: str):
    return element.findall(path, {"": _NS[1:-1]})


def _squeeze(text: str) -> str:
    return " ".join(text.split())


def bibliography(root) -> list[Entry]:
    out = []
    for struct in _all(root, ".//listBibl/biblStruct"):
        name = struct.get(_ID)
        if not name:
            continue
        title = _find(struct, ".//title[@type='main']")
        title = _find(struct, ".//title") if title is None else title
        date = _find(struct, ".//date")
        said = [] if date is None else [date.get("when") or "", date.text or ""]
        year = next((int(m.group()) for s in said if (m := _YEAR.search(s))), None)
        authors = [s.text for s in _all(struct, ".//author/persName/surname") if s.text]
        out.append(Entry(name, ((title.text if title is not None else "") or "").strip(), year, authors))
    return out


# --- sections ------------------------------------------------------------------------------------


def is_main_number(n: str | None) -> bool:
    return bool(n) and re.fullmatch(r"\d+", n.strip().rstrip(".")) is not None


def is_appendix_head(text: str) -> bool:
    return _APPENDIX.match(text.strip()) is not None


def _head(div) -> tuple[str, str] | None:
    """Number and direct text of a division's head; None without one."""
    head = _find(div, "head")
    return None if head is None else ((head.get("n") or "").strip(), (head.text or "").strip())


def _full(head: tuple[str, str] | None) -> str:
    return " ".join(filter(None, head)) if head else ""


def section_labels(root) -> dict:
    """Label of each top-level division of the body and of every division of the back matter.

    Divisions inherit the last main section before them; without any numbered section each has its
    own head. What is still without a label falls back to its head, a first division without a head
    to the introduction.
    """
    labels: dict = {}
    body, back = _find(root, ".//body"), _find(root, ".//back")
    divs = [] if body is None else _all(body, "div")
    heads = [_head(d) for d in divs]
    numbered = any(h and is_main_number(h[0]) for h in heads)
    current = ""
    for place, (div, head) in enumerate(zip(divs, heads, strict=True)):
        appendix = head is not None and is_appendix_head(head[1])
        if not numbered:
            label = APPENDIX if appendix else head[1] if head else ""
        else:
            current = _full(head) if head and is_main_number(head[0]) else APPENDIX if appendix else current
            label = current
        if not label:
            label = APPENDIX if appendix else _full(head)
            if head is None and place == 0 and _find(div, "p") is not None:
                label = "Introduction"
        labels[div] = label
    if back is not None:
        labels |= dict.fromkeys(_all(back, ".//div"), APPENDIX)
    return labels


# --- paragraphs ----------------------------------------------------------------------------------


def marked_text(element, valid: set[str]) -> str:
    """Text of a paragraph; references to valid entries become markers, all others their text."""

    def walk(node) -> str:
        if node.tag == f"{_NS}ref" and node.get("type") == "bibr":
            target = node.get("target") or ""
            return f"(citation #{target[1:]})" if target[:1] == "#" and target[1:] in valid else "".join(node.itertext()).strip()
        return (node.text or "") + "".join(walk(child) + (child.tail or "") for child in node)

    inner = (element.text or "") + "".join(walk(child) + (child.tail or "") for child in element)
    return _squeeze(inner.replace("&amp;", "&"))


def merged_paragraphs(div, valid: set[str]) -> list[str]:
    """Paragraphs of a division's own children; formulas glue the paragraphs around them.

    A run is a paragraph, then formulas each followed by a paragraph, with one more formula at its
    end at most; any other child ends it, and a formula without a paragraph before it is left out.
    """
    runs: list[list[str]] = []
    before = ""  # what the open run ends with: "", "p", or "f"
    for child in div:
        kind = {f"{_NS}p": "p", f"{_NS}formula": "f"}.get(child.tag, "")
        if kind == "p":
            if before != "f":
                runs.append([])
            runs[-1].append(marked_text(child, valid))
        elif kind == "f" and before == "p":
            runs[-1].append(_squeeze("".join(child.itertext())))
        before = kind if kind == "p" or before == "p" else ""
    return [text for run in runs if (text := " ".join(filter(None, run)))]


def sections(root, valid: set[str], exclude_appendix: bool = False) -> list[tuple[str, str]]:
    """(label, paragraph) of all divisions of the body, then of the back matter."""
    labels = section_labels(root)
    out = []
    for part in (_find(root, ".//body"), _find(root, ".//back")):
        for div in [] if part is None else part.iter(f"{_NS}div"):
            label = labels.get(div)
            label = _full(_head(div)) if label is None else label
            if not (exclude_appendix and label == APPENDIX):
                out += [(label, text) for text in merged_paragraphs(div, valid)]
    return out


def contexts_by_target(paragraphs: list[tuple[str, str]]) -> dict[str, dict[str, str]]:
    """Windows of each marker's sentences with the section in which each occurs first."""
    found: dict[str, dict[str, str]] = {}
    for label, text in paragraphs:
        if "(citation #" not in text:
            continue
        said = split_sentences(text)
        for i, sentence in enumerate(said):
            for target in dict.fromkeys(_MARKER.findall(sentence)):
                found.setdefault(target, {}).setdefault(window(said, i), label)
    return found


def contexts_of_tei(content: bytes | str, exclude_appendix: bool = False) -> list[dict]:
    """Valid references of a TEI document with their contexts, in bibliography order."""
    root = ElementTree.fromstring(content)
    entries = [e for e in bibliography(root) if e.valid]
    found = contexts_by_target(sections(root, {e.id for e in entries}, exclude_appendix))
    return [{"target": e.id, "title": e.title, "year": e.year, "cite": f"(citation #{e.id})", "contexts": [{"section": s, "context": c} for c, s in found.get(e.id, {}).items()]} for e in entries]
