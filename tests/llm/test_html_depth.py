"""Pages of great depth take time in proportion to their length."""

import time

import pytest

from tidemark.llm.html_text import MOST_INDENT, visible_text

DEEP = {
    "div": ("<div>", 200_000),
    "text": ("<div>a", 200_000),
    "table": ("<table><tr><td>a", 20_000),
    "list": ("<ul><li>a", 50_000),
    "quote": ("<blockquote>a", 50_000),
    "bold": ("<b><p>a", 100_000),
    "list in table": ("<table><tr><td><ol><li>a", 20_000),
    "quotes without end": ('<a ">"', 100_000),
}


@pytest.mark.parametrize("name", DEEP)
def test_open_tags(name):
    tag, times = DEEP[name]
    start = time.perf_counter()
    text = visible_text(tag * times)
    assert time.perf_counter() - start < 30
    if tag[-1] == "a":
        assert sum(line.split()[-1] == "a" for line in text.split("\n") if line) == times
        assert max(map(len, text.split("\n"))) < 2 * MOST_INDENT + 200


def test_tables_too_deep_to_align_keep_their_cells():
    head, tail = "<table><tr><td>" * 40, "</table>" * 40
    text = visible_text(head + "<table><tr><td>a<td>b<tr><td>c</table>after" + tail + "end")
    assert [line.strip() for line in text.split("\n") if line.strip()] == ["a", "b", "c", "after", "end"]


def test_a_closed_dialog_is_hidden():
    assert visible_text("<p>a<dialog>b</dialog><dialog open>c</dialog>d").split() == ["a", "c", "d"]
