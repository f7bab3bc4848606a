"""Wrappers whose class shares a part with names that stand outside the main text."""

import pytest

from millrace.llm import html_text
from millrace.llm.labelled_pages import PAGES

BODY = "<h1>On rivers</h1><p>Rivers run to the sea and carry sand.</p><ul class='list'><li>the first river</li><li>the other one</li></ul><p>They rest in lakes.</p>"
TEXT = "On rivers\nRivers run to the sea and carry sand.\nthe first river\nthe other one\nThey rest in lakes."


@pytest.mark.parametrize("name", ["site", "site-content", "site-main", "article-list", "post-list", "list", "no-sidebar", "comment-free main"])
def test_a_shared_part_does_not_drop_the_page(name):
    assert html_text.extract(f"<body><nav><a href='/'>Home</a></nav><div class='{name}'>{BODY}</div></body>") == TEXT


@pytest.mark.parametrize("name", ["ad", "ad-1", "site-footer", "sidebar", "comment-list", "menu", "ad-slot promo", "sidebar-left widget"])
def test_what_stands_outside_is_still_left_out(name):
    assert html_text.extract(f"<div class='story'>{BODY.replace('<ul', f'<div class=\"{name}\">Buy this now</div><ul', 1)}</div>") == TEXT


def test_labelled_pages_give_their_own_main_text():
    numbered = [iter(range(10**6)) for _ in PAGES]
    for page, n in zip(PAGES, numbered, strict=True):
        marked = "".join(f"w{next(n)}" if c == "W" else c for c in page)
        want = html_text.re.sub(r"<[^>]*>", " ", " ".join(html_text.re.findall(r"\[\[(.*?)\]\]", marked))).split()
        got = html_text.extract(marked.replace("[[", "").replace("]]", "")).split()
        assert len({*got} & {*want}) > 0.95 * len(want) and len({*got} - {*want}) < 0.1 * len(want)
