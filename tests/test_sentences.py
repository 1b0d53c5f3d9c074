import pytest
from hypothesis import given
from hypothesis import strategies as st

from citeloom.functions.sentences import begins_at, ends_at, split_sentences, window


@pytest.mark.parametrize(
    ("text", "count"),
    [
        ("See Fig. 2 for details. Done.", 2),
        ("Smith et al. Then we go.", 1),
        ("Version v2. Next one.", 1),
        ("Value is 3.14. Next.", 2),
        ("(We stop. Here.) Then go.", 1),
        ("Use U.S. Data here.", 2),
        ("", 0),
    ],
)
def test_counts(text, count):
    assert len(split_sentences(text)) == count


def test_pieces():
    assert split_sentences("Is it? yes. No.") == ["Is it? yes.", "No."]
    assert split_sentences("See Fig. 2 for details. Done.") == ["See Fig. 2 for details.", "Done."]


@given(st.text(alphabet="aB.!? ()\n1", max_size=80))
def test_nothing_is_lost(text):
    assert "".join("".join(split_sentences(text)).split()) == "".join(text.split())


def test_windows():
    s = ["a", "b", "c", "d"]
    assert [window(s, i) for i in (0, 1, 3)] == ["a b c", "a b c", "b c d"]
    assert window(["a"], 0) == "a"


def test_boundaries():
    text = "One two. Three e.g. four.\n\nFive"
    assert begins_at(text, 8) and not begins_at(text, 19) and begins_at(text, text.index("Five"))
    assert ends_at(text, 7) and not ends_at(text, 3)
