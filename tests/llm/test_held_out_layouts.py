"""Layouts that the templates don't make, written before the templates were last widened.

Main blocks stand in [[ ]]. Recall and precision are over all blocks of all pages. A first run, before that, had a recall of 0.88 and a
precision of 0.99; the templates were then widened once, by kinds of pages that had been named before the run: pages of one block, wrappers whose
names say nothing, tables and code as in manuals, plain lines of copyright. No page was changed, and nothing else was tuned.
"""

import re

from grafloom.llm import html_extract

S = ["The river rose again last night and several roads are closed this morning.", "Officials said that the water should fall within two days.", "Residents of the lower town have been asked to stay with friends.", "A school hall has been opened for those who cannot."]
D = ["The command reads a file and prints its lines in order.", "Options may be given in any order before the file name.", "An exit status of zero means that all went well."]
G = ["Der Wald ist im Herbst am schönsten, wenn das Laub sich färbt.", "Wir gingen früh los und kamen erst am Abend wieder heim.", "Unterwegs trafen wir nur wenige Leute."]

PAGES = {
    "wrapper and column": f"<html><body><div id=wrapper><div class=col><h1>[[cat]]</h1><p>[[{D[0]}]]</p><p>[[{D[1]}]]</p><pre>[[cat -v notes.txt]]</pre><table><tr><th>[[Option]]</th><th>[[Meaning]]</th></tr><tr><td>[[-v]]</td><td>[[verbose output]]</td></tr></table></div></div><p>Copyright 2020 Example Inc.</p></body></html>",
    "one paragraph": "<p>[[Only one paragraph of plain text stands here.]]</p>",
    "signs": "<p>[[a < b and c > d hold here in this paragraph]]</p>",
    "bare text": "[[Nothing but a line of text without any tag at all.]]",
    "body only": f"<body><h1>[[Flood]]</h1><p>[[{S[0]}]]</p><p>[[{S[1]}]]</p></body>",
    "two bare paragraphs": f"<p>[[{S[0]}]]</p><p>[[{S[2]}]]</p>",
    "article tag": f"<html><body><header><a href=/>Daily Post</a></header><article><h1>[[Flood in town]]</h1><p>[[{S[0]}]]</p><p>[[{S[1]}]]</p></article><footer>© Daily Post</footer></body></html>",
    "main tag": f"<body><nav><a href=/>Home</a> <a href=/n>News</a></nav><main><h1>[[Flood]]</h1><p>[[{S[0]}]]</p><h2>[[What now]]</h2><p>[[{S[3]}]]</p></main><footer><p>All rights reserved.</p></footer></body>",
    "container row": f'<body><div class="container"><div class="row"><div class="col-8"><h2>[[Wandern]]</h2><p>[[{G[0]}]]</p><p>[[{G[1]}]]</p></div><div class="col-4 sidebar"><h3>Mehr</h3><ul><li><a href=/a>Berge</a></li><li><a href=/b>Seen</a></li></ul></div></div></div></body>',
    "blog post": f'<body><div id="header"><h2><a href="/">My blog</a></h2></div><div id="post-17" class="hentry"><h1>[[Im Wald]]</h1><p>[[{G[0]}]]</p><p>[[{G[1]}]]</p><p>[[{G[2]}]]</p></div><div id="comments"><h3>2 comments</h3><div class="comment"><p>Nice walk!</p></div><div class="comment"><p>I was there too.</p></div></div></body>',
    "docs with nav": f'<body><div class="sphinxsidebar"><ul><li><a href="#a">Intro</a></li><li><a href="#b">Usage</a></li></ul></div><div class="document"><h1>[[Usage]]</h1><p>[[{D[0]}]]</p><pre>[[run --fast]]</pre><p>[[{D[2]}]]</p></div><div class="footer">© Copyright 2019. Created with a tool.</div></body>',
    "definition list": "<body><h1>[[Words]]</h1><dl><dt>[[Oak]]</dt><dd>[[A tree that lives for centuries.]]</dd><dt>[[Ash]]</dt><dd>[[A tree with pale wood.]]</dd></dl></body>",
    "table of facts": f'<body><div id="content"><h1>[[Oak]]</h1><table class="infobox"><tr><td>[[Height]]</td><td>[[30 m]]</td></tr><tr><td>[[Age]]</td><td>[[800 years]]</td></tr></table><p>[[{G[0]}]]</p></div></body>',
    "cookie first": f'<body><div class="cookie-banner"><p>We use cookies to improve your visit.</p><button>Accept</button></div><div class="entry"><h1>[[Flood]]</h1><p>[[{S[0]}]]</p><p>[[{S[1]}]]</p></div></body>',
    "newsletter in the middle": f'<body><article><h1>[[Flood]]</h1><p>[[{S[0]}]]</p><form class="newsletter"><p>Get our news by mail.</p><input><button>Go</button></form><p>[[{S[1]}]]</p><p>[[{S[2]}]]</p></article></body>',
    "advert in the middle": f'<body><article><h1>[[Flood]]</h1><p>[[{S[0]}]]</p><div class="advert">Buy our boats now, half price.</div><p>[[{S[1]}]]</p></article></body>',
    "related below": f'<body><main><h1>[[Flood]]</h1><p>[[{S[0]}]]</p><p>[[{S[3]}]]</p></main><div class="related"><h3>Related</h3><ul><li><a href=/1>Storm hits coast</a></li><li><a href=/2>Dam is safe</a></li></ul></div></body>',
    "breadcrumbs": f'<body><div class="breadcrumbs"><a href=/>Home</a> &gt; <a href=/n>News</a> &gt; Flood</div><div class="story"><h1>[[Flood]]</h1><p>[[{S[0]}]]</p><p>[[{S[1]}]]</p></div></body>',
    "old table layout": f"<body><table width=100%><tr><td width=120><a href=/>Home</a><br><a href=/m>Map</a></td><td><h1>[[Flood]]</h1><p>[[{S[0]}]]</p><p>[[{S[1]}]]</p></td></tr></table></body>",
    "long list": "<body><h1>[[What to take]]</h1><ul><li>[[Water for two days]]</li><li>[[A warm coat]]</li><li>[[Matches and a lamp]]</li><li>[[Bread and cheese]]</li></ul></body>",
    "ordered steps": f"<body><div class=doc><h1>[[Setup]]</h1><p>[[{D[1]}]]</p><ol><li>[[Open the box.]]</li><li>[[Read the card.]]</li><li>[[Press the key.]]</li></ol></div></body>",
    "quote": f"<body><article><h1>[[Letter]]</h1><blockquote><p>[[{S[1]}]]</p></blockquote><p>[[{S[0]}]]</p></article></body>",
    "caption": f"<body><article><h1>[[Flood]]</h1><figure><img src=x><figcaption>[[The bridge on Monday]]</figcaption></figure><p>[[{S[0]}]]</p></article></body>",
    "sections": f"<body><main><section><h2>[[First]]</h2><p>[[{S[0]}]]</p></section><section><h2>[[Second]]</h2><p>[[{S[2]}]]</p></section></main></body>",
    "nested plain divs": f"<body><div><div><div><h1>[[Flood]]</h1><div><p>[[{S[0]}]]</p></div><div><p>[[{S[1]}]]</p></div></div></div></div></body>",
    "divs as paragraphs": f"<body><div class=text><div>[[{S[0]}]]</div><div>[[{S[1]}]]</div><div>[[{S[3]}]]</div></div></body>",
    "spans and links": f'<body><article><h1>[[Flood]]</h1><p>[[The <a href="/r">river</a> rose <b>again</b> last night.]]</p><p>[[{S[1]}]]</p></article></body>',
    "share buttons": f'<body><article><h1>[[Flood]]</h1><div class="share"><a href=/f>Share</a> <a href=/t>Post</a></div><p>[[{S[0]}]]</p><p>[[{S[1]}]]</p></article></body>',
    "login above": f'<body><form id="login"><label>Name</label><input><label>Password</label><input></form><div id="main"><h1>[[Flood]]</h1><p>[[{S[0]}]]</p><p>[[{S[2]}]]</p></div></body>',
    "pager below": f'<body><div class="post-content"><h1>[[Flood]]</h1><p>[[{S[0]}]]</p><p>[[{S[1]}]]</p></div><div class="pagination"><a href=/1>1</a> <a href=/2>2</a> <a href=/3>Next</a></div></body>',
    "replies": f'<body><article><h1>[[Flood]]</h1><p>[[{S[0]}]]</p><p>[[{S[1]}]]</p></article><section class="responses"><h2>Responses</h2><ol><li class="response"><p>That is sad news.</p></li><li class="response"><p>Stay safe all.</p></li></ol></section></body>',
    "script and style": f"<html><head><title>T</title><style>p{{color:red}}</style></head><body><script>var a='<p>x</p>';</script><article><h1>[[Flood]]</h1><p>[[{S[0]}]]</p><noscript>No script</noscript><p>[[{S[1]}]]</p></article></body></html>",
    "unclosed tags": f"<body><h1>[[Flood]]</h1><p>[[{S[0]}]]<p>[[{S[1]}]]<ul><li>[[Stay inside]]<li>[[Keep dry]]</ul>",
    "upper case tags": f"<HTML><BODY><DIV ID=nav><A HREF=/>Home</A></DIV><H1>[[Flood]]</H1><P>[[{S[0]}]]</P><P>[[{S[1]}]]</P></BODY></HTML>",
    "release notes": "<body><div class=page><h1>[[Version 2.1]]</h1><ul><li>[[Files are read twice as fast.]]</li><li>[[A fault in the parser was mended.]]</li></ul><h2>[[Known faults]]</h2><p>[[Very long names are cut.]]</p></div></body>",
    "questions": f"<body><div class=faq><h1>[[Questions]]</h1><h3>[[How do I start it?]]</h3><p>[[{D[1]}]]</p><h3>[[What does zero mean?]]</h3><p>[[{D[2]}]]</p></div></body>",
    "poem": "<body><h1>[[Rain]]</h1><p>[[It falls on roofs<br>and falls on fields<br>and fills the lane.]]</p><p>[[It will not stop<br>before the day.]]</p></body>",
    "recipe": "<body><header><nav><a href=/>Food</a></nav></header><div class=recipe><h1>[[Soup]]</h1><ul><li>[[2 onions]]</li><li>[[1 litre of water]]</li></ul><p>[[Cut the onions and boil them for an hour.]]</p></div><footer>© Food 2021</footer></body>",
    "grid": f'<body><div class="grid"><div class="cell"><h1>[[Flood]]</h1><p>[[{S[0]}]]</p><p>[[{S[1]}]]</p></div><div class="cell widget"><h4>Weather</h4><p>Sunny, 20 degrees.</p></div></div></body>',
    "popup last": f'<body><article><h1>[[Flood]]</h1><p>[[{S[0]}]]</p><p>[[{S[1]}]]</p></article><div class="modal popup"><p>Subscribe now and save.</p></div></body>',
    "tags below": f'<body><div class="article-body"><h1>[[Flood]]</h1><p>[[{S[0]}]]</p><p>[[{S[3]}]]</p></div><div class="tags"><a href=/t1>river</a> <a href=/t2>weather</a></div></body>',
    "legal footer": f'<body><main><h1>[[Flood]]</h1><p>[[{S[0]}]]</p><p>[[{S[1]}]]</p></main><div class="legal"><p>© 2018 Example. Terms of use. Privacy.</p></div></body>',
    "sidebar first": f'<body><aside class="sidebar"><h3>Popular</h3><ul><li><a href=/1>One</a></li><li><a href=/2>Two</a></li></ul></aside><div id="content"><h1>[[Wandern]]</h1><p>[[{G[0]}]]</p><p>[[{G[1]}]]</p></div></body>',
    "forum thread starter": f'<body><div class="topbar"><a href=/>Forum</a> <a href=/l>Login</a></div><div class="post"><h1>[[Which pump?]]</h1><p>[[My cellar is wet after the flood and I need a pump.]]</p><p>[[{S[1]}]]</p></div><div class="reply"><p>Get a big one.</p></div></body>',
}


def test_held_out_layouts():
    model, found, wanted, right = html_extract.trained(), 0, 0, 0
    assert len(PAGES) >= 40
    plain = lambda x: " ".join(re.sub(r"<[^ =][^>]*>", " " if "<br>" in x else "", x).split())
    for name, page in PAGES.items():
        want = [plain(x) for x in re.findall(r"\[\[(.*?)\]\]", page, re.S)]
        got = [x for x in html_extract.main_texts([page.replace("[[", "").replace("]]", "")], model)[0].split("\n\n") if x]
        same = sum(min(got.count(x), want.count(x)) for x in set(want))
        if same < max(len(want), len(got)):
            print(name, [x for x in want if x not in got], [x for x in got if x not in want])
        found, wanted, right = found + len(got), wanted + len(want), right + same
    print(f"recall {right / wanted:.3f}, precision {right / found:.3f} of {wanted} blocks on {len(PAGES)} pages")
    assert right >= 0.95 * wanted and right >= 0.95 * found
