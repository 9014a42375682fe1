"""Main text of pages: text outside of any block, odd markup, time, and accuracy on labelled pages kept apart."""

import time

import pytest

from riskframe.llm import html_extract as H

LONG = "This is a rather long text about the town and all of its people, who live there."


@pytest.mark.parametrize("html, text", [
    (f"<body>{LONG}<br><br>{LONG}</body>", f"{LONG} {LONG}"),
    (f"<body>{LONG}<hr>{LONG}</body>", f"{LONG}\n{LONG}"),
    (f"<html><body><h1>Title of it</h1>{LONG}<p>{LONG}</p>and {LONG}</body></html>", f"Title of it\n{LONG}\n{LONG}\nand {LONG}"),
    (f"{LONG} <b>bold <i>x</b> y</i> {LONG}<nav><a>Home</a></nav>", f"{LONG} bold x y {LONG}"),
    ("<article><p>We know that <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds, as was told in many words before.</p></article>",
     "We know that x=2 holds, as was told in many words before."),
    (f"<article><p>{LONG}</p></article><a href='x", LONG),
    (f"<article><p>{LONG} 1 < 2 &lt; 3</p></article>", f"{LONG} 1 < 2 < 3"),
])
def test_text_that_was_lost(html, text):
    assert H.main_text(html)[0] == text


@pytest.mark.parametrize("html", [
    "<p>" + "<b>" * 10000 + "x" + "</i>" * 10000, "<a " * 5000, "<div>" + "<b>" * 10000 + "<p>x</p>" * 10000,
    "<ul>" * 5000 + "</li>" * 5000, "<div>" * 5000 + "</p>" * 5000, "<p" * 20000, "<noscript>" + "<i>" * 20000 + "<p>" * 5000])
def test_unclosed_tags_take_linear_time(html):
    start = time.perf_counter()
    H.main_text(html)
    assert time.perf_counter() - start < 1.5


#: Never used to fit: pages of other makes than the labelled ones, ``gold`` marks their main text.
APART = (
    "<body><div id=wrap><div id=masthead><h1>The Daily Fish</h1><p>News of the sea since 1901</p></div><ul class=main-menu><li><a>Tides</a></li><li><a>Boats</a></li></ul>"
    "<div class=story-body gold><h2 gold>Harbour wall is to be built again</h2><p gold>The council said on Monday that the wall, which fell in the storm, will be built again by the spring.</p>"
    "<p gold>Work starts in March.</p><figure gold><figcaption gold>The wall before the storm came</figcaption></figure></div>"
    "<div class=related-stories><h3>More on this</h3><ul><li><a>Storm hits the coast and takes a wall with it</a></li></ul></div><div id=footer><p>All words on this page belong to the paper.</p></div></div></body>",
    "<body><header role=banner><a>Skip</a></header><main gold><h1 gold>How to mend a net</h1><p gold>A torn net can be mended by hand in less than an hour, if the tear is not too long.</p>"
    "<h2 gold>What you need</h2><ul gold><li gold>Twine</li><li gold>A needle made for nets</li></ul><h2 gold>Steps</h2><ol gold><li gold>Cut the torn meshes away until the edge is clean.</li><li gold>Tie on.</li></ol></main>"
    "<section id=comments><h3>3 comments</h3><div class=comment-body><p>My grandfather did it in another way, and his nets never tore again.</p></div></section><footer><ul><li><a>Imprint</a></li></ul></footer></body>",
    "<body><nav class=breadcrumb><a>Home</a> <a>Recipes</a></nav><article class=recipe gold><h1 gold>Fish soup</h1><p gold>This soup is made all along the coast, and every house has a recipe of its own.</p>"
    "<table gold><tr gold><th gold>What</th><th gold>How much</th></tr><tr gold><td gold>Fish</td><td gold>One pound</td></tr></table><p gold>Let it boil.</p></article>"
    "<div class=newsletter-signup><h4>Get recipes by mail</h4><p>One mail a week, and you can leave at any time you like.</p><form><input><button>Join</button></form></div>"
    "<aside class=ads><p>New pans at half the price, for this week only, in all our shops.</p></aside></body>",
    "<body><div class=cookie-banner><p>This site keeps small files on your machine so that it can know you again.</p><button>Fine</button></div>"
    "<div class=container><div class=content gold><h1 gold>Letter from the island</h1><p gold>Dear all, it has rained for nine days now and the ferry has not come since Sunday.</p><blockquote gold><p gold>We have bread for a week, said the baker, and then we shall see.</p></blockquote>"
    "<p gold>I will write again.</p></div><div class=right-sidebar><h4>Weather</h4><p>Rain, then more rain, with some wind from the west in the evening hours.</p></div></div>"
    "<div class=footer-links><a>Contact</a><a>Privacy</a></div></body>",
    "<body><div class=top-bar><a>Log in</a></div><section class=post-content gold><h2 gold>Release notes</h2><p gold>The second version reads the tide tables twice as fast as the first one did.</p><pre gold>tide --fast harbour.txt</pre>"
    "<dl gold><dt gold>speed</dt><dd gold>Rows that are read in a second</dd></dl></section><div class=social-share><a>Share</a><a>Like</a></div>"
    "<div class=replies><article class=reply><p>It works on my boat as well, many thanks for all the work you put in.</p></article></div></body>",
    "<body><table><tr><td class=menu><a>One</a><br><a>Two</a></td><td class=article-text gold><h1 gold>An old page</h1><p gold>Pages like this one were made with tables, and some of them are still there to be read.</p>"
    "<p gold>They load fast.</p></td></tr></table><center class=copyright><p>Made by hand in the year 1999 by the keeper of this page.</p></center></body>",
    "<body><article gold><header><p>By the harbour master, on the second of May</p></header><h1 gold>Notice to all boats</h1><p gold>The east entry is closed until the crane is gone, so please use the west entry by day.</p>"
    "<div class=promo><p>Our shop sells ropes of all kinds at good prices.</p></div><p gold>Fly a flag if you come in by night.</p></article><div class=modal><p>Do you want to hear from us when the entry is open again?</p><button>Yes</button></div></body>",
    "<body><h1 gold>Plain</h1><p gold>A page without any class or id at all, just some paragraphs one after the other, as in the old days.</p><p gold>Here is one more of them, to end the page with.</p><p><a>Back</a> <a>Next</a></p></body>",
)


def accuracy(pages) -> tuple[int, int]:
    """(right, all) over the blocks with text of labelled pages."""
    right = whole = 0
    for html in pages:
        t = H._Tree(html)
        p = H.marginals(t)
        for i, parts in t.runs:
            if "".join(parts).strip():
                whole += 1
                right += (p[i] > 0.5) == t.gold[i]
    return right, whole


def test_accuracy_on_pages_kept_apart():
    right, whole = accuracy(APART)
    print(f"held-out pages: {right} of {whole} blocks")
    assert whole >= 60 and right >= 0.9 * whole
