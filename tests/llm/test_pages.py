"""Pages labelled by hand, whose names say more than what surrounds an article."""

from __future__ import annotations

import pytest

from bazar.llm import html_text

ARTICLE = "<h1>A title</h1><p>The first paragraph, with words. It goes on.</p><p>And a second one, which ends here.</p>"
TEXT = "A title\nThe first paragraph, with words. It goes on.\nAnd a second one, which ends here."
AROUND = "<nav><ul><li><a href=/>Home</a></li><li><a href=/b>News</a></li></ul></nav>", "<div class='ad'>Buy this now.</div><footer>&copy; 2024 Site</footer>"


def page(body: str, attributes: str = "") -> str:
    return f"<html><head><title>T</title></head><body {attributes}>{AROUND[0]}{body}{AROUND[1]}</body></html>"


# (page, its main text)
LABELLED = [
    *[(page(f"<article>{ARTICLE}</article>", f"class='{names}'"), TEXT) for names in ("page", "has-sidebar page", "with-comments", "single share", "no-search widgets")],
    (page(f"<div id='content-sidebar-wrap' class='has-sidebar'><article>{ARTICLE}</article></div>"), TEXT),
    (page(f"<article>{ARTICLE}<p data-role='share' data-class='ad'>Kept as well.</p></article>"), TEXT + "\nKept as well."),
    (page(f"<article>{ARTICLE}<div class='post-comments'><p>A reader says hello, and more.</p></div></article>"), TEXT),
    (page(f"<article>{ARTICLE}<div class='sidebar-wrapper'><p>Other stories, and more of them.</p></div></article>"), TEXT),
    (page(f"<div class='comments'><article class='comment'><p>A reader says hello, and more.</p></article></div><main>{ARTICLE}</main>"), TEXT),
    (page(f"<article>{ARTICLE}<p>It holds <math><mi>x</mi></math> and <object>a fallback</object>.</p></article>"), TEXT + "\nIt holds x and a fallback."),
    (page(f"<div class='story'>{ARTICLE}</div>"), TEXT),
]


@pytest.fixture(scope="module")
def taught(ready, folder):
    return html_text.fit(ready.read.parquet(f"{folder}/pages.parquet"))


@pytest.mark.parametrize("which", range(len(LABELLED)))
def test_pages_labelled_by_hand(taught, which):
    assert html_text.main_text(LABELLED[which][0], taught) == LABELLED[which][1]


def test_pages_where_none_labels_itself(ready):
    pages = [(i, page(f"<div class='story'>{ARTICLE}</div>", "class='has-sidebar'")) for i in range(50)]
    df = ready.createDataFrame(pages, "page_id bigint, html string")
    got = html_text.extract(df, html_text.fit(df)).collect()
    assert [r.text for r in got] == [TEXT] * 50


def test_a_very_long_page(taught):
    body = "".join(f"<p>Paragraph {i}, with some words. It goes on.</p>" for i in range(20_000))
    text = html_text.main_text(page(f"<article>{body}</article>"), taught)
    assert text.count("\n") == 19_999 and text.endswith("Paragraph 19999, with some words. It goes on.")
