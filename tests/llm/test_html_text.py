"""The content region against brute force, and pages that were not learnt from."""

import random
import re

import pytest

from millrace.llm import html_text
from millrace.llm.labelled_pages import pages


def test_best_stretch_equals_brute_force():
    rng = random.Random(4)
    for _ in range(500):
        s = [rng.randrange(-6, 6) for _ in range(rng.randrange(12))]
        a, b = html_text.best_stretch([float(x) for x in s])
        assert sum(s[a:b]) == max([0, *(sum(s[i:j]) for i in range(len(s)) for j in range(i, len(s) + 1))])


def test_words_score_positive_and_tags_do_not():
    w = html_text.weights()
    assert all(x >= html_text.LEAST if "<" not in k else x <= 0 for k, x in w.of.items())


def test_pages_not_learnt_from_give_their_main_text():
    right = 0
    for page in pages(150, seed=77):
        n = iter(range(10**6))
        marked = re.sub(r"\bW\b", lambda _: f"w{next(n)}", page)
        want = re.sub(r"<[^>]*>", " ", " ".join(re.findall(r"\[\[(.*?)\]\]", marked))).split()
        right += html_text.extract(marked.replace("[[", "").replace("]]", "")).split() == want
    assert right >= 145


BODY = "<h1>On rivers</h1><p>Rivers run to the sea and carry sand.</p>{}<p>They rest in lakes and sleep there.</p>"


@pytest.mark.parametrize("name", ["sponsor-box", "sidenav", "popup", "discussion", "toolbar"])
def test_names_beyond_the_commonest_are_left_out(name):
    got = html_text.extract(f"<body><article>{BODY.format(f'<div class={name}>Buy this now</div>')}</article><footer>f</footer></body>")
    assert got == "On rivers\nRivers run to the sea and carry sand.\nThey rest in lakes and sleep there."


@pytest.mark.parametrize("name", ["list", "site", "related", "search", "widget"])
def test_names_that_prove_nothing_are_kept(name):
    got = html_text.extract(f"<body><nav><a href=/>x</a></nav><article>{BODY.format(f'<div class={name}><p>Keep this too</p></div>')}</article></body>")
    assert "Keep this too" in got.split("\n")


def test_an_open_p_ends_however_deep_it_is():
    inner = "<b><i><u><em><span><b><i><u>"
    assert html_text.extract(f"<body><article><p class='ad'>{inner}x<p>main text is here and is long enough</article></body>").endswith("main text is here and is long enough")


def test_long_pages_empty_tables_and_other_columns(spark):
    page = "<body><article>" + "<p>some words stand here</p>" * 100_000 + "</article></body>"
    df = spark.createDataFrame([(1, "u", page, "a", 1), (1, "u", page, "a", 1), (None, None, "<p></p>", "b", 2)], "page_id long, url string, html string, text string, N_CHARS long")
    rows = html_text.main_text(df).collect()
    assert sorted(r.n_chars for r in rows) == [0, 2_199_999, 2_199_999]
    assert html_text.main_text(df.limit(0)).count() == 0
