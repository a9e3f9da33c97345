"""Main text of hand-written pages whose containers stand in no training template ("@" marks the blocks of main text)."""

import re

import pytest

from relkit.llm import html

LONG = ("The old bridge was closed in March after engineers found rust in two of its main cables, and the town has "
        "been waiting for a decision since then.")
SECOND = ("Repairs would take eighteen months, the council said on Tuesday, while a new crossing further down the river "
          "could be ready in three years.")
THIRD = "Many shop owners near the quay fear that they will lose half of their customers in that time."
MENU = '<li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/w">Weather</a></li><li><a href="/c">Contact</a></li>'

TEMPLATES = {
    "wrap and txt": f'<div class="wrap"><ul>{MENU}</ul><div class="txt"><h1>@Bridge stays closed</h1><p>@{LONG}</p><p>@{SECOND}</p>'
                    f'<ul><li>@two cables</li><li>@one pillar</li></ul><table><tr><td>@Cost</td><td>@4 million</td></tr></table>'
                    f'<pre>@load = mass * 9.81</pre></div><div class="end">&copy; 2020 Town Paper. All rights reserved.</div></div>',
    "story": f'<nav>{MENU}</nav><div class="story"><h2>@Rust in the cables</h2><p>@{LONG}</p><p>@{THIRD}</p></div><footer><p>Privacy policy</p></footer>',
    "no names": f'<div><a href="/">Home</a> <a href="/a">About us</a> <a href="/b">Archive</a></div><div><h1>@A town divided</h1><div>@{LONG}</div>'
                f'<div>@{SECOND}</div><div>@{THIRD}</div></div><div>Copyright 2018 The Paper. All rights reserved.</div>',
    "layout table": f'<table><tr><td><a href="/">Home</a></td><td><a href="/s">Shop</a></td></tr></table><table><tr><td><p>@{LONG}</p>'
                    f'<p>@{SECOND}</p></td></tr></table><div>Powered by Example</div>',
    "divs in article": f'<header>Town Paper</header><article><div>@one</div><div>@{LONG}</div><div>@two</div><div>@{SECOND}</div></article>'
                       f'<aside><p>Most popular</p></aside>',
    "list in article": f'<nav>{MENU}</nav><article><h1>@What to pack</h1><ul><li>@a rope</li><li>@dry socks</li><li>@bread and cheese</li></ul>'
                       f'<p>@{THIRD}</p></article><footer>Contact</footer>',
    "code in article": f'<header><p>Skip to content</p></header><article><p>@{LONG}</p><pre>@for row in table: print(row)</pre><p>@{THIRD}</p>'
                       f'<pre>@x = 1</pre></article><div class="sidebar"><p>{SECOND}</p></div>',
    "table in article": f'<nav>{MENU}</nav><article><h1>@Results</h1><table><tr><th>@Team</th><th>@Points</th></tr><tr><td>@Harbour</td><td>@31</td></tr>'
                        f'<tr><td>@Hill</td><td>@28</td></tr></table><p>@{THIRD}</p></article><footer>&copy; 2022</footer>',
    "column": f'<div id="cookie-bar"><p>This website uses cookies to work. Accept all or change your settings.</p></div><div class="column lead">'
              f'<h1>@Closed until further notice</h1><p>@{LONG}</p><blockquote>@It is a hard year for all of us.</blockquote><p>@{SECOND}</p></div>',
    "kolumne": f'<ul class="leiste">{MENU}</ul><section class="kolumne"><h3>@Die alte Brücke</h3><p>@Die alte Brücke wurde im März geschlossen, nachdem '
               f'Fachleute Rost in zwei Seilen gefunden hatten.</p><p>@Der Umbau dauert achtzehn Monate, sagte der Rat am Dienstag.</p></section>'
               f'<div>Impressum und Datenschutz</div>',
    "texte": '<div class="haut"><a href="/">Accueil</a><a href="/c">Connexion</a></div><div class="texte"><p>@Le vieux pont est fermé depuis le mois de mars, '
             'car deux câbles sont rouillés et la ville attend une décision.</p><p>@Les travaux dureront dix-huit mois, a dit le conseil mardi.</p></div>'
             '<div class="comments"><p>Merci pour cet article, je passe par là chaque jour.</p></div>',
    "cuerpo": '<ul><li><a href="/">Inicio</a></li><li><a href="/b">Buscar</a></li></ul><div class="cuerpo"><h1>@El puente viejo</h1><p>@El puente viejo se cerró en '
              'marzo porque los técnicos hallaron óxido en dos cables.</p><p>@Las obras van a durar dieciocho meses.</p></div><footer>Contacto</footer>',
    "ad inside": f'<nav>{MENU}</nav><div class="copy"><p>@{LONG}</p><div class="ad-slot"><p>Advertisement</p></div><p>@{SECOND}</p><p>@{THIRD}</p></div>',
    "form inside": f'<div class="reading"><p>@{LONG}</p><form class="signup"><label>Your email</label><button>Subscribe</button></form><p>@{SECOND}</p></div>'
                   f'<footer>Terms of use</footer>',
    "comments after": f'<div class="piece"><h1>@Quay in trouble</h1><p>@{LONG}</p><p>@{SECOND}</p></div><div class="user comments"><p>I have crossed that bridge '
                      f'for forty years and it was never safe.</p><p>Reply</p><p>2 days ago</p></div>',
    "related after": f'<div class="post-full"><p>@{LONG}</p><p>@{THIRD}</p></div><div class="see-also"><p>Related stories</p><ul><li><a href="/1">Ferry to run '
                     f'at night</a></li><li><a href="/2">Quay shops ask for help</a></li><li><a href="/3">New school opens</a></li></ul></div>',
    "definitions": f'<nav>{MENU}</nav><div class="glossary"><h1>@Words of the trade</h1><dl><dt>@Cable</dt><dd>@a rope of steel wires that carries the deck</dd>'
                   f'<dt>@Pillar</dt><dd>@a post of stone or steel below the deck</dd></dl></div><footer>Sitemap</footer>',
    "headings": f'<header><a href="/">Town Paper</a></header><div class="guide"><h1>@How to cross</h1><h2>@By boat</h2><p>@{THIRD}</p><h2>@On foot</h2><p>@{SECOND}</p>'
                f'</div><aside class="box"><p>Follow us on Facebook</p></aside>',
    "sections": f'<ul id="topnav">{MENU}</ul><section><h2>@Why it closed</h2><p>@{LONG}</p></section><section><h2>@What comes next</h2><p>@{SECOND}</p></section>'
                f'<section class="newsletter-box"><p>Subscribe to our newsletter</p></section>',
    "deep": f'<div><div><div><nav>{MENU}</nav></div></div><div><div><div><p>@{LONG}</p></div></div><div><div><p>@{SECOND}</p></div></div></div></div>'
            f'<div class="foot"><p>&copy; 2023 Example. All rights reserved.</p><p>Privacy policy</p></div>',
    "linked prose": f'<nav>{MENU}</nav><div class="essay"><p>@See <a href="/r">the report of the engineers</a> on rust in cables, which was read by many.</p>'
                    f'<p>@{LONG}</p><p>@{SECOND}</p></div><footer>Contact</footer>',
    "boilerplate in p": f'<p><a href="/">Home</a></p><p><a href="/l">Log in</a></p><div class="page-text"><p>@{LONG}</p><p>@{SECOND}</p><p>@{THIRD}</p></div>'
                        f'<p>Share this on Twitter</p><p>Copyright 2017. All rights reserved.</p>',
    "quotes": f'<div class="menu-top">{MENU}</div><div class="talk"><blockquote>@{LONG}</blockquote><p>@She paused.</p><blockquote>@{SECOND}</blockquote><p>@He nodded.</p>'
              f'</div><div class="page-footer"><p>Terms of use</p></div>',
    "main with pre": f'<div role="banner">Town Paper</div><main><pre>@{LONG}</pre><div>@{SECOND}</div></main><div class="cookie-popup">Accept all cookies</div>',
}


#: Written after the training templates; the weights' decay was chosen on both sets.
FRESH = {
    "blog": '<div class="sky"><a href="/">Home</a><a href="/me">About</a></div><div class="daily"><h2>@Rain, again</h2><p>@It has rained for nine days, and the '
            'path behind the house has turned into a stream.</p><p>@I have moved the hens to the shed.</p></div><div class="daily"><h2>@Seeds</h2>'
            '<p>@The first beans are out, though the slugs found them before I did.</p></div><p>Powered by WordPress</p>',
    "recipe": '<nav><a href="/">Home</a></nav><div class="dish"><h1>@Lentil soup</h1><ul><li>@200 g lentils</li><li>@1 onion</li><li>@salt</li></ul><ol>'
              '<li>@Fry the onion in oil until it is soft.</li><li>@Add lentils and water and cook for half an hour.</li></ol></div>'
              '<div class="share-row"><a href="/f">Facebook</a> <a href="/p">Pinterest</a></div>',
    "manual": '<ul class="crumbs"><li><a href="/">Docs</a></li><li><a href="/i">Install</a></li></ul><div class="handbook"><h1>@Installing</h1><p>@Unpack the archive and run '
              'the script inside.</p><pre>@tar xf tool.tar && ./setup</pre><p>@The script asks for a folder; any folder that you own will do.</p></div>'
              '<div class="pager"><a href="/a">Previous page</a><a href="/b">Next page</a></div>',
    "forum": '<div class="masthead"><p>Sign in or register</p></div><div class="thread-start"><p>@My boiler makes a knocking sound whenever the water is turned off, has anyone '
             'seen this before?</p></div><div class="replies"><p>Mine did that until I bled the radiators.</p><p>Reply</p></div>',
    "law": '<div><a href="/">Contents</a></div><section class="statute"><h3>@Section 4</h3><dl><dt>@(a)</dt><dd>@No person shall keep a boat at the quay without a permit.</dd>'
           '<dt>@(b)</dt><dd>@A permit is valid for one year.</dd></dl></section><footer><p>Copyright 2015. All rights reserved.</p></footer>',
    "interview": '<header><p>The Weekly</p></header><div class="qa"><div>@What made you start?</div><div>@A broken radio and a long winter, that was all it took.</div><div>@And now?</div>'
                 '<div>@Now I repair forty of them a year and cannot stop.</div></div><aside><p>Recent posts</p></aside>',
    "scores": '<nav><ul><li><a href="/">Home</a></li></ul></nav><article><h1>@Final table</h1><table><tr><td>@Harbour</td><td>@12</td><td>@31</td></tr><tr><td>@Hill</td>'
              '<td>@11</td><td>@28</td></tr></table><div>@Hill lost a point.</div></article><div class="cookies"><p>I agree</p></div>',
    "letter": '<div class="leaf"><p>@Dear Anna,</p><p>@the parcel came on Monday and nothing in it was broken, not even the blue cup.</p><p>@Yours, Tom</p></div>'
              '<div class="promo-box"><p>Ten percent off all cups this week only</p></div>',
}


def containers(text: str) -> set[str]:
    return set(re.findall(r'(?:class|id)="([^"]+)"', text))


@pytest.fixture(scope="module")
def model(spark):
    return html.learn(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def judged(model, page: str):
    marked = html.blocks_of(f"<html><head><title>t</title></head><body>{page}</body></html>")
    found = html.blocks_of(f"<html><head><title>t</title></head><body>{page.replace('@', '')}</body></html>")
    assert len(found) == len(marked)
    return [(b.text, b.text.startswith("@"), chance > 0.5) for b, chance in zip(marked, model.chances([found])[0])]


def score(model, pages: dict[str, str]) -> float:
    """F1 over blocks; no block of an article may be lost."""
    right = wrong = missed = 0
    for name, page in pages.items():
        rows = judged(model, page)
        right += sum(y and p for _, y, p in rows)
        wrong += sum(p and not y for _, y, p in rows)
        missed += sum(y and not p for _, y, p in rows)
        if "<article>" in page:
            assert all(p for _, y, p in rows if y), name
    return 2 * right / (2 * right + wrong + missed)


def test_main_containers_are_held_out():
    """No container of main text stands in a training template; some names around it (``replies``, ``masthead``) do."""
    main = {c for page in (TEMPLATES | FRESH).values() for part in re.findall(r'<[^@]*@', page)
            for c in containers(part.rsplit("</div>", 1)[-1]) if c not in html._AROUND}
    shown = containers(" ".join((*html._HOLDERS, *(f for kind in html._FRAMES.values() for f in kind))))
    assert len(TEMPLATES) >= 20 and not main & (shown - {"masthead"})


def test_templates(model):
    assert score(model, TEMPLATES) >= 0.95


def test_fresh_templates(model):
    assert score(model, FRESH) >= 0.9


def test_driver_pages_follow_their_article(spark, model):
    """Blocks of pages that mark their article, as their marks say."""
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    found = [html.blocks_of(p) for p in pages]
    for blocks, chances in zip(found, model.chances(found)):
        has_main = any(b.names & html._MAIN for b in blocks)
        assert [c > 0.5 for c in chances] == [html.weak_label(b.names, has_main) for b in blocks]


def test_pages_go_together_by_size():
    """Every page once; a page of very many blocks stands alone and is labelled whole."""
    sizes = [3, 60_000, 1, 2, 30_000, 20_000, *[5] * 200]
    groups = list(html._groups(sizes, 64))
    assert sorted(k for g in groups for k in g) == list(range(len(sizes)))
    assert all(len(g) <= 64 and (len(g) == 1 or len(g) * max(sizes[k] for k in g) <= html.CELLS) for g in groups)
    many = html.blocks_of("<p>a" * 60_000)
    assert [len(c) for c in html.Labeller().chances([many, [], many[:2]])] == [60_000, 0, 2]
    assert html.train(["<article><p>" + "word " * 200_000 + "</p></article>"], settings=20) is not None
