"""HTML extraction on pages of layouts that the training templates don't make, written by hand.

In a page, what stands between [[ and ]] is the text of a block of the article.
"""

import re
import tracemalloc

from grafloom.llm import html_extract

A = "The river rises in the hills above the town and flows past the old mill before it meets the sea."
B = "Fishermen have used its banks for centuries, and many of them still know where trout rest at noon."
C = "A survey in spring counted fourteen species, three more than ten years ago."
D = "Nobody knows why."

PAGES = {
    "weblog": f"""<html><body class="home blog"><div id="wrapper"><div id="site-title"><a href="/">Notes of a walker</a></div><div id="primary-menu"><ul><li><a href="/">Home</a><li><a href="/about">About</a></ul></div>
        <div class="hentry type-post"><h2 class="entry-title">[[Along the river]]</h2><div class="entry-content"><p>[[{A}]]</p><p>[[{B}]]</p><blockquote><p>[[{C}]]</p></blockquote><p>[[{D}]]</p></div></div>
        <div id="respond"><h3>Leave a reply</h3><form><p>Your address will not be published.</p><textarea></textarea></form></div><div class="widget-area"><div class="widget"><h3>Archives</h3><ul><li><a href="/1">May</a><li><a href="/2">June</a></ul></div></div><div id="colophon">Proudly made at home.</div></div></body></html>""",
    "newspaper": f"""<html><body><div class="top-nav"><a href=/>News</a> <a href=/s>Sport</a> <a href=/w>Weather</a></div><div class="cookie-banner"><span>We use cookies to make this site better. Accept all?</span></div>
        <div class="story"><h1>[[River counts rise]]</h1><div class="story-body"><p>[[{A}]]</p><div class="advert">Buy two tents, get one free.</div><p>[[{B}]]</p><h2>[[What was found]]</h2><p>[[{C}]]</p></div></div>
        <div class="related-stories"><h3>More on this</h3><ul><li><a href=/3>Bridge closed</a><li><a href=/4>Mill for sale</a></ul></div><div class="footer-links"><a href=/t>Terms</a> <a href=/p>Privacy</a></div></body></html>""",
    "bare body": f"<h1>[[The river]]</h1><p>[[{A}]]<p>[[{B}]]<p>[[{C}]]<p>[[{D}]]",
    "bare with rule": f"<html><body><h1>[[The river]]</h1>\n<p>[[{A}]]</p>\n<p>[[{B}]]</p>\n<p>[[{C}]]</p>\n<hr>\n<p><a href='index.html'>Back to the index</a> | <a href='2.html'>Next page</a></p></body></html>",
    "table columns": f"""<html><body><table width="760"><tr><td colspan="2"><a href="/"><img src=logo.gif></a></td></tr><tr><td width="140" valign="top"><a href=/a>Home</a><br><a href=/b>Rivers</a><br><a href=/c>Lakes</a><br><a href=/d>Links</a></td>
        <td><h1>[[The river]]</h1><p>[[{A}]]</p><p>[[{B}]]</p><p>[[{C}]]</p></td></tr></table></body></html>""",
    "definitions": f"<html><body><nav><a href=/>Start</a></nav><main><h1>[[Words of the river]]</h1><p>[[{A}]]</p><dl><dt>[[Weir]]</dt><dd>[[A low wall across the stream.]]</dd><dt>[[Ford]]</dt><dd>[[A shallow place where carts may cross.]]</dd></dl><p>[[{B}]]</p></main><footer><p>Made in 2020.</p></footer></body></html>",
    "recipe": f"""<html><body><header><a href=/>Kitchen</a></header><main><section class="recipe"><h1>[[Trout with butter]]</h1><p>[[{B}]]</p><h2>[[Ingredients]]</h2><ul><li>[[Two trout]]</li><li>[[Salt and butter]]</li></ul><h2>[[Steps]]</h2><ol><li>[[Clean the fish and dry it well.]]</li><li>[[Fry it in butter for ten minutes.]]</li></ol></section>
        <section class="comments"><h2>Comments</h2><div class="comment"><p>I tried it and it was very good, thank you.</p></div></section></main><footer>All rights reserved.</footer></body></html>""",
    "application": f"""<html><body><div id="root"><div class="css-1x2y"><div class="css-9ab"><a href=/>Log in</a><a href=/>Sign up</a></div></div><div class="css-77q"><div class="css-main"><h1 class="css-h">[[The river]]</h1><div class="css-p">[[{A}]]</div><div class="css-p">[[{B}]]</div><div class="css-p">[[{C}]]</div></div></div><div class="css-foot"><a href=/i>Imprint</a></div></div></body></html>""",
    "encyclopedia": f"""<html><body><div id="mw-navigation"><ul><li><a href=/>Main page</a></li><li><a href=/r>Random page</a></li></ul></div><div id="content"><h1 id="firstHeading">[[River]]</h1><div id="bodyContent"><p>[[{A}]]</p><h2>[[Use]]</h2><p>[[{B}]]</p><ul><li>[[{C}]]</li><li>[[{D}]]</li></ul><table><tr><th>[[Length]]</th><td>[[40 km]]</td></tr></table></div></div><div id="catlinks"><a href=/c1>Rivers</a> <a href=/c2>Hills</a></div></body></html>""",
    "odd comments": f"<html><body><!--><div class=menu><a href=/>Home</a></div><!---><article><h1>[[The river]]</h1><p>[[{A}]]</p><!-- a > b --!><p>[[{B}]]</p></article><!-- not closed <p>never seen</p>",
}


def wanted(page):
    return [" ".join(html_extract.html.unescape(x).split()) for x in re.findall(r"\[\[(.*?)\]\]", page, re.DOTALL)]


def test_layouts_that_were_not_trained_on():
    model, right, missed, wrong = html_extract.trained(), 0, 0, 0
    for name, page in PAGES.items():
        found = html_extract.main_texts([re.sub(r"\[\[|\]\]", "", page)], model)[0].split("\n\n")
        want = wanted(page)
        lost, more = [x for x in want if x not in found], [x for x in found if x not in want and x]
        print(name, "lost", lost, "wrong", more)
        right, missed, wrong = right + len(want) - len(lost), missed + len(lost), wrong + len(more)
    print(right, missed, wrong)
    assert right / (right + missed) >= 0.9 and right / (right + wrong) >= 0.9


def test_comments_end_as_parsers_end_them():
    texts = lambda p: [b.text for b in html_extract.blocks(p)]
    assert texts("<!--><p>a</p><!---><p>b</p><!-- x --!><p>c</p><!-- > -- ><p>no</p> --><p>d</p><!--") == ["a", "b", "c", "d"]


def test_long_pages_are_read_in_windows(monkeypatch):
    """The same probabilities as in one piece, and memory that the vectors don't drive."""
    model = html_extract.trained()
    found = html_extract.blocks("<div class=menu><a href=/>x</a></div><article>" + "".join(f"<p>Paragraph {i} says something." for i in range(700)) + "</article><footer>end</footer>")
    whole = model.label([found])[0]
    monkeypatch.setattr(html_extract, "WINDOW", 64)
    assert abs(model.label([found])[0] - whole).max() < 1e-4
    monkeypatch.undo()
    page = "<article>" + "<p>Short words here.</p>" * 30_000 + "</article>"
    tracemalloc.start()
    text = html_extract.main_texts([page], model)[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert text.count("Short") == 30_000 and peak < 60e6
