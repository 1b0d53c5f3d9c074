import pytest

from citeloom.functions import altmd, tei

DOC = """<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body>
<div><head n="1">Introduction</head>
<p>Trees are old. Forests <ref type="bibr" target="#b0">(Oak, 2001)</ref> are newer. We grow one.</p></div>
<div><head n="1.1">Scope</head>
<p>We bound</p>
<formula>x = 1</formula>
<p>as in <ref type="bibr" target="#b9">[9]</ref>. Fine.</p></div>
</body>
<back><div type="references"><listBibl>
<biblStruct xml:id="b0"><analytic><title type="main">Growing forests</title><author><persName><surname>Oak</surname></persName></author></analytic><monogr><imprint><date when="2001-05"/></imprint></monogr></biblStruct>
<biblStruct xml:id="b1"><analytic><title>x</title></analytic></biblStruct>
</listBibl></div></back></text></TEI>"""


def test_contexts():
    refs = tei.contexts_of_tei(DOC)
    assert len(refs) == 1
    assert (refs[0]["target"], refs[0]["title"], refs[0]["year"]) == ("b0", "Growing forests", 2001)
    assert refs[0]["contexts"] == [{"section": "1 Introduction", "context": "Trees are old. Forests (citation #b0) are newer. We grow one."}]


def test_runs_and_sections():
    root = tei.ElementTree.fromstring(DOC)
    assert tei.sections(root, {"b0"})[1] == ("1 Introduction", "We bound x = 1 as in [9]. Fine.")
    flat = DOC.replace(' n="1"', "").replace(' n="1.1"', "")
    labels = [s for s, _ in tei.sections(tei.ElementTree.fromstring(flat), set())]
    assert labels == ["Introduction", "Scope"]
    bare = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body><div><p>a b</p></div><div><head>Appendix A</head><p>c</p></div></body></text></TEI>'
    root = tei.ElementTree.fromstring(bare)
    assert [s for s, _ in tei.sections(root, set())] == ["Introduction", "Appendix"]
    assert tei.sections(root, set(), exclude_appendix=True) == [("Introduction", "a b")]


@pytest.mark.parametrize(("n", "main"), [("1", True), ("10.", True), ("2.1", False), ("", False), (None, False)])
def test_main_number(n, main):
    assert tei.is_main_number(n) is main


def test_alternative():
    text = (
        "# T\n\n## 1 Intro\n\nTrees are old here. Forests [1, 7] are newer. We grow one.\n\n## Abstract\n\nNothing [1] to see here at all.\n\n## References\n\n"
        "- [1] Oak. Growing forests. In *Venue*, 2001.\n- [2] Elm. Small Trees. arXiv 2002.\n- [3] Ash. Other things. In *X*, 2003.\n"
    )
    refs = altmd.contexts_of_alternative(text)
    assert [(r["target"], r["title"], r["year"]) for r in refs] == [("1", "Growing forests", 2001), ("2", "Small Trees", 2002), ("3", "Other things", 2003)]
    assert refs[0]["contexts"] == [{"section": "1 Intro", "context": "Trees are old here. Forests (citation #1)[7] are newer. We grow one."}]
    assert altmd.contexts_of_alternative("no references") == []


def test_anchors():
    section = "".join(f'<span id="page-1-{i}"></span>Oak, A. 200{i}. [Title {i}](http://x). In *Y*.\n' for i in range(3))
    assert altmd.reference_format(section) == "anchor"
    found = altmd.entries(section, "anchor")
    assert [(e.id, e.title, e.year) for e in found] == [(f"page-1-{i}", f"Title {i}", 2000 + i) for i in range(3)]
    assert altmd.mark_anchors(r"[\(Oak](#page-1-0) and [Fig](#page-9-9)", {"page-1-0"}) == "(citation #page-1-0) and Fig"
