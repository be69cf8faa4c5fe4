"""What counts as text of a page and what doesn't."""

import pytest

from toolcat.llm.html_text import _kind, extract, parse

LONG = "Long text of the article with many words in it. " * 6


def text(body):
    return extract(parse(f"<html><body>{body}</body></html>"), [])


def test_pages_inside_a_form():
    body = f'<form id="aspnet"><div class="content"><p>{LONG}</p><label>Name</label><input name="n"><button>Go</button><textarea>x</textarea></div></form>'
    assert text(body) == LONG.strip()
    search = '<form class="find"><p>Type what you look for</p><input></form>'
    assert text(f"{search}<div><p>{LONG}</p></div>") == LONG.strip()
    assert text(f'<form><table><tr><td><nav><a href="/">Home</a></nav><p>{LONG}</p></td></tr></table></form><p>foot</p>').startswith(LONG.strip())


@pytest.mark.parametrize(
    "noise",
    [
        "<p class='advert'>buy</p>", "<p class=cookie-notice>we use cookies</p>", "<h2 class='related'>More</h2>", "<span class='ad'>buy <span>now</span> here</span>",
        f"<ol class='commentlist'><li>{LONG}</li></ol>", "<section class='responses'><p>I agree</p></section>", "<div role='search'><p>find</p></div>",
        "<div class='post-comments'><p>first!</p></div>", "<ul class='related-posts'><li>other</li></ul>", "<div class='share-buttons'><p>send</p></div>",
    ],
)
def test_noise_on_any_element(noise):
    assert text(f"<div class='post'><p>{LONG}</p>{noise}<p>End of it.</p></div>") == f"{LONG.strip()}\nEnd of it."


def test_words_of_noise_inside_an_article():
    body = f"<div class='entry-header'><h1>Title</h1><p>by me, today</p></div><div class='post'><p>{LONG}</p><div class='related-work'><p>Earlier work.</p></div></div>"
    assert text(body) == f"Title\n{LONG.strip()}\nEarlier work."
    assert text(f"<div class='post'><p class='research'>{LONG}</p><p class='ad-hoc-query'>Kept.</p></div>") == f"{LONG.strip()}\nKept."
    kinds = {"entry-header": "header", "post-footer": "noise", "siteHeader": "noise", "related-work": "", "relatedLinks": "noise", "research": "", "header": "noise"}
    assert {k: _kind(k) for k in kinds} == kinds
