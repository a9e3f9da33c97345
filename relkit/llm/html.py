"""Main text of web pages by a recurrent block labeller (operator 5).

A page is read once into its leaf blocks: runs of text between block-level
tags, each with its tag path (the open elements with their class and id words)
and its words.  A bidirectional LSTM written in numpy reads the blocks of the
whole document in both directions, each as a hashed tag path, hashed words and
a few measures (length, shares of linked text, of digits, of words that pages use
around text, of blocks with the same path, punctuation), and labels every block as
main text or not.  The main text is the chosen blocks in page order.

There are no labelled pages, so it learns from a bounded sample of
``SAMPLE_PAGES`` whole pages under weak labels: a block inside an article or
main element and no boilerplate element is main text.  To learn what stands
around text and not one site's markup, each sampled page is also set in random
templates in which every block's label is known: main text in containers of any
name or none, as paragraphs, lists, tables, definitions, quotes and code, long or
short, in the page's words or invented ones; around it menus, banners, notices,
side bars, adverts, forms, comments and footers in many spellings, or in
containers that do not tell, where links and set phrases do.

Defined cases: NULL or empty html, or html without text, gives the empty text;
unclosed and stray tags are closed as browsers do (a block ends an open svg or
math, ``/>`` closes one, a missing ``</head>`` hides nothing, a quote opens a
value only after ``=``); the text of scripts, styles, drawings and other
elements that show nothing is no block, that of formulas is part of its line;
repeated rows and NULL ids
are rows of their own; without any page to learn from nothing is extracted;
extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import batch, prepare

SAMPLE_PAGES = 300
SETTINGS = 2400
#: Characters of a block that the settings of a page show; blocks (padding included) that are labelled side by side.
SHOWN_CHARS, CELLS = 1000, 50_000
PATH_BITS, WORD_BINS, MEASURES = 2048, 32, 11
HIDDEN = 24
DECAY = 0.5

# HTML element kinds.
#: Elements whose content is raw text that shows nothing, and other elements whose content does not show.
_RAW = frozenset("script style title textarea noscript iframe".split())
_HIDDEN = frozenset("template select svg object canvas audio video annotation annotation-xml".split())
#: Elements of a foreign vocabulary, and those inside them that hold HTML again.
_FOREIGN = frozenset("svg math".split())
_POINTS = frozenset("foreignobject desc mi mo mn ms mtext annotation-xml".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table
    tbody td tfoot th thead tr ul option""".split())
#: Start tags that end an open svg or math element, besides those of blocks.
_BREAKOUT = _BLOCK | frozenset("""b big br code em embed head i img listing meta nobr ruby s small span strong strike sub
    sup tt u var""".split())
#: Start tags that end an open select element.
_NO_SELECT = frozenset("input select textarea".split())
#: Start tags that end an open element of the same group.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
         "th": ("td", "th"), "option": ("option",)}
#: Elements that a start tag inside them does not end.
_CLOSED = frozenset("template select object".split())
_SCOPES = frozenset("ul ol dl table body html article main section div nav aside header footer form".split())
# Words in tags, classes and ids that mark main text and its surroundings, for the weak labels.
_MAIN = frozenset("article main".split())
_AROUND = frozenset("""nav header footer aside form menu ad ads advert advertisement sponsored promo banner cookie
    consent notice sidebar comment comments respond share social related newsletter subscribe breadcrumb login search
    button dialog""".split())

# Words of the set phrases that pages use around their text.
_CUES = frozenset("""accept account advertisement ago agree all anonymous archive archives basket cart categories click close
    comment comments consent contact cookie cookies copyright decline disclaimer download email facebook faq feed follow
    google guest help home imprint instagram legal like linkedin log login logout menu more newsletter next notifications
    partners password pinterest policy popular powered preferences previous print privacy promoted read recent
    register related reply replies reserved rights rss save search settings share shop sign sitemap skip sponsored
    submit subscribe subscription tags terms trending tweet twitter upvote username view vote whatsapp youtube
    datenschutz impressum kontakt startseite suche anmelden abonnieren kommentare antworten weiterlesen werbung
    accueil rechercher connexion confidentialité abonner commentaires répondre publicité partager
    inicio buscar acceder privacidad suscribirse comentarios responder publicidad compartir""".split())

# A quote opens a value only directly after ``=``; the loop over attributes never goes back.
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"
    r"(?P<attrs>(?:\s+|/(?!>)|[^\s/>][^\s/>=]*(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*))?)*+)(?P<self>/?)(?:>|(?P<cut>\Z))"
    r"|<[!?/][^>]*>|(?P<text>[^<]+|<)", re.S)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in sorted(_RAW)}
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"[0-9\u00a9]")
_LETTERS = re.compile(r"[^\W\d_]+")


@lru_cache(maxsize=100_000)
def _bits(token: str) -> int:
    """Three bits, so that a name that shares one with another is not taken for it."""
    value = zlib.crc32(token.encode())
    return 1 << value % PATH_BITS | 1 << (value >> 10) % PATH_BITS | 1 << (value >> 21) % PATH_BITS


@dataclass
class Block:
    text: str
    path: int       # hashed tag path, three bits per token
    linked: int     # characters inside links
    names: frozenset  # words of the open elements, for the weak labels


def blocks_of(page: str) -> list[Block]:
    """The leaf blocks of a page in order."""
    out: list[Block] = []
    # Open elements: (tag, path bits, in a link, words, hidden, foreign content).
    stack: list[tuple[str, int, bool, frozenset, bool, bool]] = [("", 0, False, frozenset(), False, False)]
    pieces: list[str] = []
    linked = 0
    at = stack[0]

    def flush() -> None:
        nonlocal linked
        if pieces:
            raw = "".join(pieces)
            text = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append(Block(text, at[1], linked, at[3]))
            pieces.clear()
        linked = 0

    def close(tags: tuple[str, ...], scopes: frozenset) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in tags:
                del stack[k:]
                return
            if stack[k][0] in scopes:
                return

    place = 0
    while m := _TOKEN.match(page, place):
        place = m.end()
        # A tag that the end of the page cuts off is text.
        text = m["text"] if m["cut"] is None else m[0]
        if text is not None:
            if stack[-1][4]:
                continue
            if not pieces:
                if text.isspace():
                    continue
                at = stack[-1]
            pieces.append(text)
            if stack[-1][2]:
                linked += len(text)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _BLOCK and not stack[-1][4]:
            flush()
        if m["end"]:
            close((tag,), frozenset() if tag in _SCOPES else _SCOPES - {tag})
            if tag in _BLOCK and not stack[-1][4]:
                flush()
            continue
        if tag in _BREAKOUT and stack[-1][5]:
            while stack[-1][5]:
                stack.pop()
            if tag in _BLOCK and not stack[-1][4]:
                flush()
        if tag in _NO_SELECT:
            close(("select",), _SCOPES)
        if tag in _RAW and not stack[-1][5]:
            ended = _RAW_END[tag].search(page, place)
            place = ended.end() if ended else len(page)
            continue
        if tag == "br":
            if pieces and not stack[-1][4]:
                pieces.append(" ")
            continue
        # The head shows nothing itself, and whatever shows has left it.
        if tag in _VOID or tag == "head":
            continue
        if tag in _BLOCK:
            close(("p",), _SCOPES | _CLOSED)
        if tag in _ENDS:
            close(_ENDS[tag], _SCOPES)
        foreign = tag in _FOREIGN or stack[-1][5]
        if m["self"] and (foreign or tag not in _BLOCK) or not foreign and tag not in _BLOCK and m["attrs"].rstrip().endswith("/"):
            continue
        names = {tag}
        for quoted in _NAMES.findall(m["attrs"]):
            names.update(_WORDS.findall("".join(quoted).lower()))
        above = stack[-1]
        bits = above[1] | _bits(above[0] + ">" + tag)
        for name in names:
            bits |= _bits(name)
        hidden = above[4] or tag in _HIDDEN or tag in _RAW
        stack.append((tag, bits, above[2] or tag == "a", above[3] | names, hidden, foreign and tag not in _POINTS))
    flush()
    return out


def weak_label(names: frozenset, has_main: bool) -> bool:
    """Main text by the words of the open elements."""
    return not names & _AROUND and (not has_main or bool(names & _MAIN))


class _WordBins(dict):
    def __missing__(self, word: str) -> int:
        value = zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORD_BINS
        if len(self) < 300_000:
            self[word] = value
        return value


_bins = _WordBins()


def measures(blocks: list[Block]) -> np.ndarray:
    """Word bins and measures of each block of a page."""
    words = [b.text.lower().split() for b in blocks]
    sizes = np.array([len(w) for w in words])
    bins = np.fromiter((_bins[w] for own in words for w in own), np.int64, int(sizes.sum()))
    at = np.repeat(np.arange(len(blocks)) * WORD_BINS, sizes) + bins
    counts = np.bincount(at, minlength=len(blocks) * WORD_BINS).reshape(-1, WORD_BINS)
    n = np.array([len(b.text) for b in blocks])
    cues = [len(b.text) < 400 and sum(w in _CUES for w in _LETTERS.findall(b.text.lower())) for b in blocks]
    alike = Counter(b.path for b in blocks)
    return np.column_stack([
        np.sqrt(counts / np.maximum(1, sizes)[:, None]), np.log1p(n) / 8, np.log1p(sizes) / 6,
        np.minimum(1, np.array([b.linked for b in blocks]) / n), [b.text[-1] in ".!?:;" for b in blocks],
        np.minimum(1, np.array([b.text.count(",") for b in blocks]) * 20 / n), [b.text[0].isupper() for b in blocks],
        np.minimum(1, 2 * np.array(cues) / np.maximum(1, sizes)), np.minimum(1, np.array([len(_DIGITS.findall(b.text)) for b in blocks]) * 4 / n),
        np.array([alike[b.path] for b in blocks]) / max(1, len(blocks)), np.arange(len(blocks)) / max(1, len(blocks) - 1), np.ones(len(blocks))]).astype(np.float32)


def path_vector(bits: int) -> np.ndarray:
    raw = np.frombuffer(bits.to_bytes(PATH_BITS // 8, "little"), np.uint8)
    return np.unpackbits(raw, bitorder="little").astype(np.float32)


def _groups(sizes: list[int], most: int) -> Iterator[list[int]]:
    """Places of like sizes, at most ``most`` together and ``CELLS`` blocks if all were as long as the longest."""
    own: list[int] = []
    for k in sorted(range(len(sizes)), key=sizes.__getitem__):
        if own and (len(own) == most or (len(own) + 1) * sizes[k] > CELLS):
            yield own
            own = []
        own.append(k)
    if own:
        yield own


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """The bidirectional LSTM.  Parameters: per direction ``wp`` (path), ``wx`` (words, measures), ``wh``, ``b``; then ``o``."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.p: dict[str, np.ndarray] = {}
        for d in "fb":
            for name, rows in (("wp", PATH_BITS), ("wx", WORD_BINS + MEASURES), ("wh", HIDDEN)):
                # A name that no page has shown adds nothing.
                spread = 0 if name == "wp" else 0.15
                self.p[d + name] = (rng.standard_normal((rows, 4 * HIDDEN)) * spread).astype(np.float32)
            self.p[d + "b"] = np.repeat(np.array([0, 1, 0, 0], np.float32), HIDDEN)
        self.p["o"] = (rng.standard_normal((2 * HIDDEN + 1, 1)) * 0.15).astype(np.float32)

    def _run(self, d: str, z: np.ndarray, mask: np.ndarray, trace: list | None = None) -> np.ndarray:
        """Hidden states (time, page, HIDDEN) for the input part ``z`` of the gates; ``mask`` is 0 past a page's end."""
        steps, n = z.shape[:2]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((steps, n, HIDDEN), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            g = z[t] + h @ self.p[d + "wh"]
            gates, new = _sigmoid(g[:, :3 * HIDDEN]), np.tanh(g[:, 3 * HIDDEN:])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            keep = mask[t][:, None]
            nc = (f * c + i * new) * keep
            tc = np.tanh(nc)
            nh = o * tc * keep
            if trace is not None:
                trace.append((t, h, c, i, f, o, new, tc, keep))
            h, c = nh, nc
            out[t] = h
        return out

    def chances(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For each page, each block's chance to be main text."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        some = [k for k in range(len(pages)) if pages[k]]
        known: dict[int, int] = {}
        for group in _groups([len(pages[k]) for k in some], 64):
            own = [some[k] for k in group]
            x, path, mask = self._inputs([pages[k] for k in own], known)
            table = np.stack([path_vector(b) for b in known])
            sides = []
            for d in "fb":
                z = x @ self.p[d + "wx"] + (table @ self.p[d + "wp"])[path] + self.p[d + "b"]
                sides.append(self._run(d, z, mask))
            score = _sigmoid(np.concatenate([*sides, np.ones(mask.shape + (1,), np.float32)], axis=2) @ self.p["o"])[:, :, 0]
            for j, k in enumerate(own):
                out[k] = score[:len(pages[k]), j]
            if len(known) > 8_000:
                known.clear()
        return out

    @staticmethod
    def _inputs(pages: list[list[Block]], known: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Measures, path numbers (in ``known``) and the mask of pages side by side, time first."""
        steps = max(map(len, pages))
        x = np.zeros((steps, len(pages), WORD_BINS + MEASURES), np.float32)
        path = np.zeros((steps, len(pages)), np.int64)
        mask = np.zeros((steps, len(pages)), np.float32)
        for j, page in enumerate(pages):
            x[:len(page), j] = measures(page)
            path[:len(page), j] = [known.setdefault(b.path, len(known)) for b in page]
            mask[:len(page), j] = 1
        return x, path, mask

    def fit(self, pages: list[list[Block]], labels: list[np.ndarray], rounds: int = 10, rate: float = 0.01) -> None:
        """Minimise the log loss over all blocks by Adam with backpropagation through time."""
        rng = np.random.default_rng(11)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        # Pages of like length go together; the groups come in random order.
        mixed = rng.permutation(len(pages))
        groups = [self._case([pages[mixed[k]] for k in own], [labels[mixed[k]] for k in own])
                  for own in _groups([len(pages[k]) for k in mixed], 32)]
        for done in range(rounds):
            slower = rate * (1 - 0.9 * done / rounds)
            for at in rng.permutation(len(groups)):
                step += 1
                grads = self._gradients(*groups[at])
                for k, g in grads.items():
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.999 * square[k] + 0.001 * g * g
                    self.p[k] = (self.p[k] - slower * (mean[k] / (1 - 0.9 ** step))
                                 / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
                    if k.endswith("wp"):
                        self.p[k] *= 1 - DECAY * slower

    def _case(self, pages: list[list[Block]], labels: list[np.ndarray]) -> tuple:
        """Inputs and labels of pages side by side."""
        known: dict[int, int] = {}
        x, path, mask = self._inputs(pages, known)
        y = np.zeros(mask.shape, np.float32)
        for j, label in enumerate(labels):
            y[:len(label), j] = label
        return x, path, mask, np.stack([path_vector(b) for b in known]).astype(np.uint8), y

    def _gradients(self, x: np.ndarray, path: np.ndarray, mask: np.ndarray, table: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        sides, traces, table = [], [], table.astype(np.float32)
        for d in "fb":
            traces.append([])
            z = x @ self.p[d + "wx"] + (table @ self.p[d + "wp"])[path] + self.p[d + "b"]
            sides.append(self._run(d, z, mask, traces[-1]))
        top = np.concatenate([*sides, np.ones(mask.shape + (1,), np.float32)], axis=2)
        error = (_sigmoid(top @ self.p["o"])[:, :, 0] - y) * mask / max(1.0, mask.sum())
        grads = {"o": np.einsum("tnk,tn->k", top, error)[:, None]}
        for side, d in enumerate("fb"):
            up = error[:, :, None] * self.p["o"][side * HIDDEN:(side + 1) * HIDDEN, 0]
            dz = np.zeros(mask.shape + (4 * HIDDEN,), np.float32)
            dwh = np.zeros_like(self.p[d + "wh"])
            dh = np.zeros((mask.shape[1], HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t, h, c, i, f, o, new, tc, keep in reversed(traces[side]):
                gh = (dh + up[t]) * keep
                gc = (dc + gh * o * (1 - tc * tc)) * keep
                g = np.concatenate([gc * new * i * (1 - i), gc * c * f * (1 - f), gh * tc * o * (1 - o),
                                    gc * i * (1 - new * new)], axis=1)
                dz[t] = g
                dwh += h.T @ g
                dh, dc = g @ self.p[d + "wh"].T, gc * f
            flat = dz.reshape(-1, 4 * HIDDEN)
            per_path = np.zeros((len(table), 4 * HIDDEN), np.float32)
            np.add.at(per_path, path.reshape(-1), flat)
            grads |= {d + "wh": dwh, d + "b": flat.sum(axis=0), d + "wp": table.T @ per_path,
                      d + "wx": x.reshape(-1, x.shape[2]).T @ flat}
        return grads


# How sites spell the containers of main text and of what stands around it.
_HOLDERS = ('<article>', '<main>', '<div class="article-body">', '<div class="post-content">', '<div id="content">',
            '<section class="entry">', '<div role="main">', '<main><article>')
_FRAMES = {
    "menu": ('<nav>', '<div class="menu">', '<ul class="nav">', '<div id="navigation">', '<header><nav>', '<div class="breadcrumb">',
             '<ul class="navbar">', '<div class="toolbar">', '<div class="tabs">'),
    "header": ('<header>', '<div id="header">', '<div class="site-header">', '<div class="banner">', '<div class="masthead">',
               '<div id="top">'),
    "footer": ('<footer>', '<div id="footer">', '<div class="footer">', '<div class="site-footer">', '<div class="bottom">',
               '<div class="copyright">', '<div class="legal">'),
    "aside": ('<aside>', '<div class="sidebar">', '<div id="sidebar">', '<div class="related">', '<aside class="widget">',
              '<div class="widget">', '<div class="recommended">', '<div class="teaser">', '<div class="share">', '<div class="social">'),
    "notice": ('<div class="cookie-notice">', '<div id="cookie-banner">', '<div class="notice">', '<div class="consent">',
               '<div role="dialog">', '<dialog>', '<div class="popup">', '<div class="modal">', '<div role="alert">'),
    "ad": ('<div class="ad">', '<div class="ads">', '<div class="advert">', '<div class="sponsored">', '<aside class="ad">',
           '<section class="promo">', '<div class="advertisement">', '<div class="promotion">'),
    "form": ('<form>', '<form class="newsletter">', '<div class="subscribe"><form>', '<form id="search">', '<div class="login">'),
    "comments": ('<section class="comments">', '<div id="comments">', '<ol class="comment-list">', '<div class="comment">',
                 '<div class="replies">', '<div id="respond">', '<section class="discussion">'),
}
#: Set phrases that tell what a block is where its container does not.
_PHRASES = {
    "menu": ("Home", "About us", "Contact", "Log in", "Sign up", "Help", "Shop", "Archive", "News", "Next page", "Previous page"),
    "header": ("Skip to content", "Menu", "Sign in or register", "Search this site", "Follow us on Facebook and Twitter"),
    "footer": ("\u00a9 2021 Example Ltd. All rights reserved.", "Privacy policy", "Terms of use", "Copyright 2019", "Sitemap",
               "Powered by Example", "Contact us by email", "Legal disclaimer and privacy settings"),
    "aside": ("Related stories", "Most popular", "Read more", "Recent posts", "Share this on Facebook", "Tags and categories",
              "Trending now", "View all", "Follow us on Instagram"),
    "notice": ("This site uses cookies. Accept all or change your settings.", "We and our partners use cookies; read the privacy policy.",
               "Accept all cookies", "Turn on notifications?", "I agree"),
    "ad": ("Advertisement", "Sponsored", "Promoted: click here and save 20 % in our shop", "Sponsored by our partners"),
    "form": ("Subscribe to our newsletter", "Your email", "Password", "Username", "Submit", "Search", "Log in to your account"),
    "comments": ("3 comments", "Reply", "Like this comment", "2 days ago", "Log in to reply", "Anonymous, 5 hours ago", "View 12 replies"),
}
_SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe ri so tu va we xi yo za bar del fin gor hul kan lem mis nor pux".split()


def _closed(opening: str) -> str:
    return "".join(f"</{t}>" for t in reversed(re.findall(r"<([a-z0-9]+)", opening)))


def _variant(rng: np.random.Generator, main: list[str], others: list[str]) -> tuple[list[Block], np.ndarray]:
    """A page in a random template, and the label of each of its blocks."""
    pick = lambda seq: seq[rng.integers(len(seq))]
    mark = "\ue000"  # stands before main text so that its blocks are known
    word = lambda: "".join(pick(_SYLLABLES) for _ in range(rng.integers(1, 4)))
    invented = rng.random() < 0.5

    def plain(text: str) -> str:
        """``text``, in invented words if the page has them."""
        return entities.escape(re.sub(r"[^\W\d_]+", lambda m: word().capitalize() if m[0][0].isupper() else word(), text)
                               if invented else text)

    def number() -> str:
        return f"{rng.integers(1, 2000)}" + pick(("", "", ".5", " km", " %", " = x"))

    def linked(text: str) -> str:
        """``text``, sometimes with a link on a few of its words."""
        if rng.random() < 0.85:
            return text
        words = text.split()
        at = rng.integers(len(words) + 1)
        end = at + rng.integers(1, 7)
        return " ".join([*words[:at], '<a href="/">', *words[at:end], "</a>", *words[end:]])

    def neutral() -> str:
        """Containers whose names tell nothing, or without names."""
        out = ""
        for _ in range(rng.integers(1, 4)):
            tag = pick(("div", "div", "div", "section", "table><tr><td"))
            name = pick(("", "", f' class="{word()}"', f' id="{word()}"', f' class="{word()}-{word()}"'))
            out += f"<{tag}{name}>"
        return out

    def around(kind: str) -> str:
        named = rng.random() < 0.65
        frame = pick(_FRAMES[kind]) if named else neutral()
        if named and rng.random() < 0.3:
            frame = neutral() + frame
        if kind == "menu":
            items = [pick(_PHRASES[kind]) if rng.random() < 0.4 else word() if invented else pick(pick(others).split() or ["x"])
                     for _ in range(rng.integers(2, 9))]
            inner = "".join(f'<li><a href="/">{entities.escape(w)}</a></li>' for w in items)
            inner = inner if rng.random() < 0.7 else re.sub("</?li>", " ", inner)
        else:
            items = [pick(_PHRASES[kind]) if not named or rng.random() < 0.4 else None for _ in range(rng.integers(1, 4))]
            tag = pick(("p", "p", "div", "li", "span"))
            inner = "".join(f"<{tag}>{plain(pick(others)) if w is None else entities.escape(w)}</{tag}>" for w in items)
            if kind == "form":
                inner = f"<label>{inner}</label><button>{pick(_PHRASES[kind])}</button>"
            elif kind in ("footer", "aside") and rng.random() < 0.5:
                inner += "".join(f'<li><a href="/">{plain(" ".join(pick(others).split()[:8])) or "x"}</a></li>' for _ in range(rng.integers(1, 6)))
        return frame + inner + _closed(frame)

    def body_of(texts: list[str]) -> list[str]:
        out, at = [], 0
        while at < len(texts):
            kind = pick(("p",) * 10 + ("h2", "h3", "h4", "blockquote", "pre", "div", "div", "section", "figcaption", "ul", "ul", "ol", "table", "dl"))
            own = texts[at:at + (rng.integers(1, 6) if kind in ("ul", "ol", "table", "dl") else 1)]
            at += len(own)
            few = kind in ("h2", "h3", "h4", "ul", "ol", "table", "dl", "figcaption") and rng.random() < 0.8 or rng.random() < 0.35
            long = rng.random() < 0.4
            cut = lambda t: " ".join(t.split()[:int(rng.integers(1, 5) ** 2 if few else rng.integers(8, 45))]) if few or not long else t
            shown = [mark + (number() if few and rng.random() < 0.15 else linked(plain(cut(t)))) for t in own]
            inner = {"ul": "li", "ol": "li", "table": "td", "dl": "dd"}.get(kind)
            rows = "".join(f"<{inner}>{t}</{inner}>" if inner != "td" or k % 2 else f"<tr><td>{t}</td>" for k, t in enumerate(shown)) if inner else shown[0]
            out.append(f"<{kind}>{rows}</{kind}>")
        return out

    main = main[:pick((1, 2, 3, 4, 6, 10, 40, 40))]
    holder = pick(_HOLDERS) if rng.random() < 0.5 else neutral()
    body = body_of(main)
    if rng.random() < 0.7:
        tag = pick(("h1", "h1", "h2", "h3"))
        body.insert(0, f"<{tag}>{mark}{plain(' '.join(main[0].split()[:12]))}</{tag}>")
    for kind in ("ad", "aside", "comments", "form", "notice"):
        if rng.random() < 0.2:
            where = len(body) if kind == "comments" else rng.integers(len(body) + 1)
            body.insert(where, around(kind))
    before = [around(k) for k in ("header", "menu", "notice", "ad", "aside") if rng.random() < 0.5]
    after = [around(k) for k in ("comments", "aside", "ad", "form", "footer", "notice") if rng.random() < 0.5]
    whole = neutral() if rng.random() < 0.5 else ""
    found = blocks_of("<html><body>" + whole + "".join(before) + holder + "".join(body) + _closed(holder) + "".join(after)
                      + _closed(whole) + "</body></html>")
    labels = np.array([mark in b.text for b in found], np.float32)
    for b in found:
        b.text = b.text.replace(mark, "").strip() or "-"
    return found, labels


def train(pages: list[str], settings: int = SETTINGS, seed: int = 5) -> Labeller | None:
    """Fit the labeller on whole pages under weak labels and on about ``settings`` template settings of them."""
    rng = np.random.default_rng(seed)
    held: list[tuple[list[Block], np.ndarray]] = []
    for page in pages:
        found = blocks_of(page)
        has_main = any(b.names & _MAIN for b in found)
        held.append((found, np.array([weak_label(b.names, has_main) for b in found], np.float32)))
    others = [b.text[:300] for found, labels in held for b, y in zip(found, labels) if not y] or ["Menu"]
    mains = [[b.text[:SHOWN_CHARS] for b, y in zip(found, labels) if y] for found, labels in held]
    extra = [_variant(rng, m, others) for m in mains if m for _ in range(-(-settings // len(mains)))]
    cases = [(f, y) for f, y in [*held, *extra] if f]
    if not cases:
        return None
    model = Labeller()
    model.fit([f for f, _ in cases], [y for _, y in cases])
    return model


def learn(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Labeller | None:
    """Fit on at most ``sample_pages`` whole pages, chosen by a hash."""
    prepare(pages.sparkSession)
    html = pages.where(F.col("html").isNotNull()).select(F.col("html").cast("string").alias("html"))
    n = html.count()
    slots = 1 << 30
    share = min(slots, slots * 2 * sample_pages // max(1, n))
    chosen = html.where(F.pmod(F.xxhash64("html"), F.lit(slots)) < share).orderBy(F.xxhash64("html"), "html").limit(sample_pages)
    return train([r["html"] for r in chosen.collect()])


_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
#: Characters of html that are parsed and labelled together.
_TOGETHER = 4_000_000


def extract(pages: DataFrame, model: Labeller | None) -> DataFrame:
    """page_id, url, text (main blocks joined by newlines) and n_chars for every row of ``pages``."""
    spark = pages.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def texts_of(html: list[str]) -> list[str]:
        parsed = [blocks_of(h) for h in html]
        chances = shared.value.chances(parsed) if shared.value else [np.zeros(len(p)) for p in parsed]
        return ["\n".join(b.text for b, c in zip(p, chance) if c > 0.5) for p, chance in zip(parsed, chances)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            html, at, size, texts = rb.column(2).to_pylist(), 0, 0, []
            for k, h in enumerate(html):
                size += len(h)
                if size >= _TOGETHER:
                    texts += texts_of(html[at:k + 1])
                    at, size = k + 1, 0
            texts += texts_of(html[at:])
            yield batch(_SCHEMA, rb.column(0), rb.column(1), texts, [len(t) for t in texts])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
