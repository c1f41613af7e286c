"""Pages as they are written: end tags left out, names that say two things, markup in the middle of a line."""

import re
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest

from stintlake.llm import html_blocks

SENTENCE = "The town council has met again and talked for hours about the new bridge over the river"
WHOLE = f"""<html><head><title>No title</title><script>var t="</p></head>";</script></head><body><nav><ul><li><a href=x>Home</a></li>
<li><a>News</a></li></ul></nav><main><article><h1>Title</h1><p>{SENTENCE} one.</p><ul><li>First {SENTENCE}.</li><li>Second {SENTENCE}.</li></ul>
<dl><dt>Bridge</dt><dd>{SENTENCE} two.</dd></dl><table><thead><tr><th>Year</th><th>Cost</th></tr></thead><tbody><tr><td>2019</td><td>Much</td></tr>
<tr><td>2020</td><td>More</td></tr></tbody></table><p>{SENTENCE} three.</p></article></main><form><select><option>A</option><option>B</option></select>
<button>Send your own view of it to us</button></form><footer>&copy; the town</footer></body></html>"""


class _Plain(HTMLParser):
    """What the article holds, paragraph by paragraph, by the parser that comes with Python."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.lines, self.now = 0, [], []

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag in ("p", "h1", "article"):
            self._end()
        if tag == "br":
            self.now.append(" ")

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self._end()
        self.inside -= tag == "article"

    def handle_data(self, data):
        if self.inside:
            self.now.append(data)

    def _end(self):
        text = " ".join("".join(self.now).split())
        if text and self.inside:
            self.lines.append(text)
        self.now = []


def _plain(page):
    parser = _Plain()
    parser.feed(page or "")
    parser.close()
    return "\n\n".join(parser.lines)


def test_given_pages_against_a_plain_parser():
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist()
    assert len(pages) > 100
    assert [html_blocks.main_text(p) for p in pages] == [_plain(p) for p in pages]


# the end tags that the standard lets authors leave out, and those whose elements browsers end by themselves
@pytest.mark.parametrize("tag", "html head body li dt dd p option thead tbody tr td th button select nav main article footer form".split())
def test_end_tags_left_out(tag):
    text = html_blocks.main_text(WHOLE)
    assert text.split("\n\n")[:2] == ["Title", f"{SENTENCE} one."] and text.endswith(f"{SENTENCE} three.")
    without = re.sub(rf"(?<!=\"</p>)</{tag}>(?!\";)", "", WHOLE)
    assert without != WHOLE
    got = html_blocks.main_text(without)
    if tag == "nav":  # the menu is never left, but main overrules it
        assert got == text
    elif tag in ("main", "article"):
        assert got.startswith(text)
    else:
        assert got == text


@pytest.mark.parametrize(
    "mark",
    [
        "class='content has-sidebar'", "id='search-results-article'", "class='post-share-wrapper'", "class='entry-content social-news'",
        "title='the hidden truth'", "data-hidden-id='3'", "class='no-footer'", "data-x='display:none'", "class='newsletter-article'", "hidden=false",
    ],
)
@pytest.mark.parametrize("tag", ["div", "section", "article", "p"])
def test_names_and_attributes_that_say_nothing(mark, tag):
    inner = f"<p>{SENTENCE} one.</p><p>{SENTENCE} two.</p>" if tag != "p" else f"{SENTENCE} one.<p>{SENTENCE} two.</p>"
    page = f"<body><div class=menu><a>A</a> <a>B</a></div><{tag} {mark}>{inner}</{tag}></body>"
    assert html_blocks.main_text(page) == f"{SENTENCE} one.\n\n{SENTENCE} two."


@pytest.mark.parametrize(
    "mark", ["class='cookie-notice'", "class='related'", "id=sidebar", "class='comment-body'", "hidden", "style='display : none'", "aria-hidden=true", "role=banner", "class='relatedStories'"]
)
def test_parts_beside_the_text(mark):
    page = f"<body><div {mark}><p>{SENTENCE} no.</p></div><article><h1>Title</h1><p>{SENTENCE}.</p><div {mark}><p>{SENTENCE} no.</p></div></article></body>"
    assert html_blocks.main_text(page) == f"Title\n\n{SENTENCE}."


def test_names_that_say_both_are_weighed():
    links = "<a>One more story</a><br><a>Another one</a>"
    page = f"<article><p>{SENTENCE}.</p></article><div class='footer-content'><p>{links}</p><p>Short.</p><p>{links}</p></div>"
    assert html_blocks.main_text(page) == f"{SENTENCE}."
    page = f"<div class='post-share'><p>{SENTENCE}.</p><p>{SENTENCE} again.</p></div>"
    assert html_blocks.main_text(page) == f"{SENTENCE}.\n\n{SENTENCE} again."


@pytest.mark.parametrize("odd", ["<script>var x='<p>'</script>", "<svg><text>no</text></svg>", "<button>no</button>", "<x-note>", "<style>p{}</style>", "<font>", "<video>no</video>"])
def test_a_line_is_not_cut_by_what_stands_in_it(odd):
    page = f"<article><p>The council {odd} met again and talked for hours.</p><p>{SENTENCE}.</p></article>"
    assert html_blocks.main_text(page) == f"The council met again and talked for hours.\n\n{SENTENCE}."


def test_a_quote_that_is_never_closed():
    page = f"<article><p class=\"x>The council met.</p><p>It has {SENTENCE}.</p></article>"
    assert html_blocks.main_text(page) == f"The council met.\n\nIt has {SENTENCE}."
    assert html_blocks.main_text("<article><p>1 < 2 and <b>3 > 2</b> are true of the numbers") == "1 < 2 and 3 > 2 are true of the numbers"


def test_neighbours_decide():
    def used(node):
        return set() if node.left is None else {html_blocks.FEATURES[node.feature]} | used(node.left) | used(node.right)

    assert {"words", "link_density", "in_article", "in_aside"} <= used(html_blocks.tree())
    assert used(html_blocks.tree()) & {"density_before", "density_after"}
    links = "<p>" + " ".join(f"<a>link number {i} to a page</a>" for i in range(8)) + "</p>"
    line = "<p>A line of a few words between two others.</p>"
    text = f"<p>{SENTENCE} and about many other things besides.</p>"
    assert html_blocks.main_text(links + line + links) == ""
    assert "A line of a few words" in html_blocks.main_text(text + line + text)


def test_a_page_of_many_open_quotes_and_tags_is_read_in_good_time():
    html_blocks.main_text("<p class=\"x " * 3000 + "<button><svg>" * 2000 + "'" + "<div hidden" * 2000)


def test_a_paragraph_before_a_long_list_of_links_stays():
    links = "<p>" + " ".join(f"<a>link number {i} to a page</a>" for i in range(8)) + "</p>"
    for page in (f"<article><p>{SENTENCE}.</p>{links}</article>{links}", f"<p>{SENTENCE}.</p><p>{SENTENCE}, which is said twice.</p>{links}"):
        assert SENTENCE in html_blocks.main_text(page) and "link number" not in html_blocks.main_text(page)
