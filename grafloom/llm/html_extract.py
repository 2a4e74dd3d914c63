"""HTML extraction by a recurrent block labeller.

A page is cut into leaf blocks of text. Each becomes a vector of its hashed tag path (tags, classes,
ids), its hashed words and a few shape figures; a bidirectional LSTM, in numpy, reads a page's blocks in
order and labels each as main text or not, knowing what stands before and after. The model is trained
here, on pages made up from templates with known labels; no text of the corpus is learned from.
Pages of many blocks are read in windows that carry the networks' states, so memory doesn't grow with the vectors.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grafloom.llm.common import bare

PATH_DIM, WORD_DIM, SHAPE_DIM, HIDDEN = 192, 32, 6, 16
INPUT_DIM = PATH_DIM + WORD_DIM + SHAPE_DIM
#: Pages that are cut into blocks together: at most so many, and of at most so many characters unless one is longer.
GROUP, GROUP_CHARS = 256, 4_000_000
#: Blocks, with padding, whose vectors are held at once (about 1 KB each, and as much again for the states).
WINDOW = 16_384

#: HTML's void elements; those whose content is raw text, and of these what is never text of the page.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN_TAGS = frozenset("script style template iframe noembed noframes noscript svg math object select option datalist textarea button".split())
#: Elements that don't break a block.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Start tags that end an open element of the first kind, as its end tag may be left out.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

MARKUP = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+[^>]*+)>|<[!?][^>]*+>", re.DOTALL)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)
NAME = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Block:
    path: tuple[str, ...]
    text: str = ""
    linked: int = 0
    bits: list[str] | None = field(default_factory=list)

    def finish(self) -> bool:
        self.text = " ".join("".join(self.bits or ()).split())
        self.bits = None
        return bool(self.text)


def blocks(page: str | None) -> list[Block]:
    """The page's leaf blocks in order: references decoded, white space within turned into one space, none empty."""
    page, out, stack, now, at, links, hidden, paths = page or "", [], [], None, 0, 0, 0, {}

    def say(raw: str) -> None:
        nonlocal now
        if hidden or not raw:
            return
        if now is None:
            if raw.isspace():
                return
            path = tuple(x for _, names in stack for x in names)
            now = Block(paths.setdefault(path, path))
        text = html.unescape(raw) if "&" in raw else raw
        now.bits.append(text)
        if links:
            now.linked += len(text)

    def cut() -> None:
        nonlocal now, links
        if now is not None and now.finish():
            out.append(now)
        now, links = None, 0

    def pop(to: int) -> None:
        nonlocal hidden
        for tag, _ in stack[to:]:
            hidden -= tag in HIDDEN_TAGS
        del stack[to:]

    size = len(page)
    while at < size:
        m = MARKUP.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        if m["cdata"] is not None:
            say(m["cdata"])
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag in INLINE:
            if tag == "a":
                links = 0 if m["end"] else 1
            elif tag == "br":
                say(" " if now is not None else "")
            continue
        if tag in VOID:
            cut()
            continue
        cut()
        if m["end"]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                pop(depth)
            continue
        # a block's start tag ends an open paragraph; some end an open item or cell of the same list or row
        ended = CLOSES.get(tag, ())
        if stack and stack[-1][0] == "p":
            pop(len(stack) - 1)
        if stack and stack[-1][0] in ended:
            pop(len(stack) - 1)
            if tag == "tr" and stack and stack[-1][0] == "tr":
                pop(len(stack) - 1)
        if m["rest"].rstrip().endswith("/") and tag in HIDDEN_TAGS:
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
            if tag == "title" and not hidden:
                stack.append((tag, (tag,)))
                say(page[at : close.start() if close else size])
                cut()
                stack.pop()
            at = close.end() if close else size
            continue
        names = [tag]
        for a in ATTRIBUTE.finditer(m["rest"]):
            names += ["." + x for x in NAME.findall((a[2] or a[3] or a[4] or "").lower())]
        stack.append((tag, tuple(names)))
        hidden += tag in HIDDEN_TAGS
    cut()
    return out


@lru_cache(maxsize=1 << 16)
def _path_rows(path: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the path's hashes, and how much each counts: the whole path's tokens, and again its last three."""
    total = np.zeros(PATH_DIM, dtype=np.float32)
    for place, name in enumerate(path):
        total[crc32(name.encode()) % 128] += 1
        if place >= len(path) - 3:
            total[128 + crc32(name.encode()[::-1]) % 64] += 1
    rows = np.flatnonzero(total)
    return rows, np.minimum(total[rows], 2)


def vectors(found: list[Block], first: int = 0, total: int | None = None) -> np.ndarray:
    """A row for each block; they are a page's blocks from the `first`, of `total`."""
    x, total = np.zeros((len(found), INPUT_DIM), dtype=np.float32), len(found) if total is None else total
    for i, b in enumerate(found):
        rows, value = _path_rows(b.path)
        x[i, rows] = value
        w, at = b.text.encode(errors="replace").split(b" "), first + i
        counts = np.bincount([crc32(y) % WORD_DIM for y in w], minlength=WORD_DIM)
        x[i, PATH_DIM : PATH_DIM + WORD_DIM] = counts / len(w)
        x[i, PATH_DIM + WORD_DIM :] = (np.log1p(len(w)) / 4, min(1.0, b.linked / len(b.text)), b.text[-1] in ".!?…", at / total, 1 / (1 + at), 1 / (total - at))
    return x


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Direction:
    """One LSTM that reads sequences padded to a common length, time first."""

    def __init__(self, rng: np.random.Generator):
        h = HIDDEN
        self.p = {"x": rng.normal(0, 0.1, (INPUT_DIM, 4 * h)).astype(np.float32), "h": rng.normal(0, 0.2, (h, 4 * h)).astype(np.float32), "b": np.r_[np.ones(h), np.zeros(3 * h)].astype(np.float32)}

    def run(self, x: np.ndarray, mask: np.ndarray, keep: bool = False, state: tuple | None = None):
        """The state after each step, what `back` needs, and the last state, from which another run may go on."""
        steps, n, h = x.shape[0], x.shape[1], HIDDEN
        z_all = (x.reshape(-1, INPUT_DIM) @ self.p["x"] + self.p["b"]).reshape(steps, n, 4 * h)
        out, past = np.zeros((steps, n, h), np.float32), []
        s, c = state or (np.zeros((n, h), np.float32), np.zeros((n, h), np.float32))
        for t in range(steps):
            z = z_all[t] + s @ self.p["h"]
            f, i, o, g = _sigmoid(z[:, :h]), _sigmoid(z[:, h : 2 * h]), _sigmoid(z[:, 2 * h : 3 * h]), np.tanh(z[:, 3 * h :])
            m = mask[t][:, None]
            c2 = f * c + i * g
            tc = np.tanh(c2)
            if keep:
                past.append((s, c, f, i, o, g, tc, m))
            s, c = np.where(m, o * tc, s), np.where(m, c2, c)
            out[t] = s
        return out, past, (s, c)

    def back(self, x: np.ndarray, past: list, d_out: np.ndarray) -> dict[str, np.ndarray]:
        steps, n, h = x.shape[0], x.shape[1], HIDDEN
        dz_all, dh, ds, dc = np.zeros((steps, n, 4 * h), np.float32), np.zeros_like(self.p["h"]), np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        for t in range(steps - 1, -1, -1):
            s, c, f, i, o, g, tc, m = past[t]
            ds = ds + d_out[t]
            own, kept = np.where(m, ds, 0), np.where(m, 0, ds)
            dc_own = np.where(m, dc, 0) + own * o * (1 - tc * tc)
            dz = np.concatenate([dc_own * c * f * (1 - f), dc_own * g * i * (1 - i), own * tc * o * (1 - o), dc_own * i * (1 - g * g)], axis=1)
            dz_all[t] = dz
            dh += s.T @ dz
            ds, dc = kept + dz @ self.p["h"].T, np.where(m, dc_own * f, dc)
        flat = dz_all.reshape(-1, 4 * h)
        return {"x": x.reshape(-1, INPUT_DIM).T @ flat, "h": dh, "b": flat.sum(axis=0)}


class Labeller:
    """Probability that a block is main text, from the states of both directions at the block."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.ways = [Direction(rng), Direction(rng)]
        self.w, self.b = rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32), np.zeros(1, np.float32)

    @staticmethod
    def _turned(a: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each sequence reversed within its own length."""
        at = np.arange(a.shape[0])[:, None]
        return a[np.where(at < lengths, lengths - 1 - at, at), np.arange(a.shape[1])]

    def forward(self, pages: list[np.ndarray], keep: bool = False):
        lengths = np.array([len(p) for p in pages])
        x = np.zeros((lengths.max(), len(pages), INPUT_DIM), np.float32)
        for i, p in enumerate(pages):
            x[: len(p), i] = p
        mask = np.arange(len(x))[:, None] < lengths
        turned = self._turned(x, lengths)
        a, past_a, _ = self.ways[0].run(x, mask, keep)
        b, past_b, _ = self.ways[1].run(turned, mask, keep)
        states = np.concatenate([a, self._turned(b, lengths)], axis=2)
        return _sigmoid(states @ self.w + self.b[0]), (x, turned, mask, lengths, states, past_a, past_b)

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For each page's blocks, their probabilities; pages of like length are run together, long ones in windows."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            if len(pages[order[at]]) > WINDOW:
                out[order[at]] = self._in_windows(pages[order[at]])
                at += 1
                continue
            end = at + 1
            while end < min(at + GROUP, len(order)) and len(pages[order[end]]) * (end + 1 - at) <= WINDOW:
                end += 1
            p, _ = self.forward([vectors(pages[i]) for i in order[at:end]])
            for j, i in enumerate(order[at:end]):
                out[i] = p[: len(pages[i]), j]
            at = end
        return out

    def _in_windows(self, found: list[Block]) -> np.ndarray:
        """The same for one page, reading it forwards and then backwards a window at a time."""
        n, score = len(found), np.full(len(found), self.b[0], np.float32)
        starts = range(0, n, WINDOW)
        for way, w, order in zip(self.ways, (self.w[:HIDDEN], self.w[HIDDEN:]), (starts, reversed(starts)), strict=True):
            state, turn = None, 1 if way is self.ways[0] else -1
            for a in order:
                x = vectors(found[a : a + WINDOW], a, n)[::turn, None]
                states, _, state = way.run(x, np.ones(x.shape[:2], bool), state=state)
                score[a : a + WINDOW] += (states[:, 0] @ w)[::turn]
        return _sigmoid(score)

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int, rate: float = 0.01, batch: int = 32, seed: int = 9) -> None:
        rng, step = np.random.default_rng(seed), 0
        params = [*(d.p[k] for d in self.ways for k in ("x", "h", "b")), self.w, self.b]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for _ in range(epochs):
            # pages of like length go together, in pools of several batches, so that little is padded
            order = rng.permutation(len(pages))
            pools = [sorted(order[a : a + 8 * batch], key=lambda i: len(pages[i][0])) for a in range(0, len(order), 8 * batch)]
            groups = [pool[a : a + batch] for pool in pools for a in range(0, len(pool), batch)]
            for at in rng.permutation(len(groups)):
                group = [pages[i] for i in groups[at]]
                p, (x, turned, mask, lengths, states, past_a, past_b) = self.forward([g[0] for g in group], keep=True)
                y = np.zeros_like(p)
                for j, g in enumerate(group):
                    y[: len(g[1]), j] = g[1]
                d = np.where(mask, p - y, 0).astype(np.float32) / mask.sum()
                d_states = d[:, :, None] * self.w
                grads_a = self.ways[0].back(x, past_a, d_states[:, :, :HIDDEN])
                grads_b = self.ways[1].back(turned, past_b, self._turned(d_states[:, :, HIDDEN:], lengths))
                grads = [*(g[k] for g in (grads_a, grads_b) for k in ("x", "h", "b")), np.einsum("tn,tnk->k", d, states), d.sum(keepdims=True).reshape(1)]
                norm = max(1.0, float(np.sqrt(sum((g * g).sum() for g in grads))))
                step += 1
                now = rate * (1.05 - step / (epochs * -(-len(pages) // batch)))  # down to a twentieth
                for q, g, a, b in zip(params, grads, m, v, strict=True):
                    g = g / norm
                    a += 0.1 * (g - a)
                    b += 0.01 * (g * g - b)
                    q -= now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)


class Maker:
    """Pages from templates, with which blocks are main text."""

    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)

    def one(self, *options):
        return options[int(self.rng.integers(len(options)))]

    def words(self, low: int, high: int, end: str = "") -> str:
        letters = "etaoinshrdluéüßcmfñwypvbgk"
        n = int(self.rng.integers(low, high + 1))
        w = ["".join(letters[int(min(25, abs(self.rng.normal(0, 9))))] for _ in range(int(self.rng.integers(2, 10)))) for _ in range(n)]
        if self.rng.random() < 0.3:  # stray signs after words, as in broken texts
            signs = ["".join(self.one(*"%$#*!|/+=~&@^") for _ in range(int(self.rng.integers(1, 4)))).replace("&", "&amp;") for _ in range(3)]
            w = [x + self.one(" ", "") + self.one(*signs) for x in w]
        text = " ".join(w) if self.rng.random() < 0.1 else " ".join(w).capitalize()
        return (text.upper().replace("&AMP;", "&amp;") if self.rng.random() < 0.05 else text) + end

    def inline(self, text: str) -> str:
        """The text with inline tags and line breaks, some of them not closed."""
        w = text.split(" ")
        for _ in range(int(self.rng.integers(0, 3))):
            at, tag = int(self.rng.integers(0, len(w))), self.one("b", "i", "em", "strong", "span", "code", *(["a href=/x"] if len(w) > 4 else []))
            w[at] = f"<{tag}>{w[at]}" + self.one(f"</{tag.split()[0]}>", f"</{tag.split()[0]}>", "</a>" if tag[0] == "a" else "")
            if self.rng.random() < 0.3:
                w.insert(int(self.rng.integers(0, len(w) + 1)), "<br>")
        return " ".join(w)

    def links(self, n: int, tag: str = "li") -> str:
        return "".join(f'<{tag}><a href="/{i}">{self.words(1, 2)}</a></{tag}>' for i in range(n))

    def attr(self, *names: str) -> str:
        return self.one(f' class="{self.one(*names)}"', f' id="{self.one(*names)}"', f' class="{self.one(*names)} {self.one("wide", "box", "block", "js", "dark")}"')

    def plain_wrap(self) -> tuple[str, str]:
        """One to three divs whose names say nothing of what they hold."""
        names = ("wrapper", "wrap", "container", "row", "col", "column", "inner", "page", "site", "layout", "grid", "panel", "root", "outer", "cell", "area")
        n = int(self.rng.integers(1, 4))
        return "".join(f"<div{self.one('', self.attr(*names), self.attr(*names))}>" for _ in range(n)), "</div>" * n

    def rights(self) -> str:
        """What stands below a page without any name: who owns it."""
        year, who = int(self.rng.integers(1995, 2027)), self.words(1, 3)
        said = self.one(f"Copyright {year} {who}", f"&copy; {year} {who}", f"Copyright &copy; {year} {who}. All rights reserved.", f"All rights reserved. {who}", f"{year} &copy; {who}")
        tag = self.one("p", "p", "div", "small", "address", "center")
        return f"<{tag}>{said}{self.one('', f' <a href=/terms>{self.words(1, 2)}</a>')}</{tag}>"

    def aside(self) -> str:
        """A block that isn't main text."""
        n = int(self.rng.integers(1, 7))
        return self.one(
            lambda: f"<nav{self.one('', self.attr('menu', 'main-nav', 'breadcrumb'))}><ul>{self.links(n)}</ul></nav>",
            lambda: f"<div{self.attr('menu', 'nav', 'navigation', 'breadcrumbs', 'topbar', 'toolbar')}>{self.links(n, 'span')}</div>",
            lambda: f"<div{self.attr('ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo', 'banner')}>{self.words(1, 25, '.')}</div>",
            lambda: f"<aside{self.one('', self.attr('sidebar', 'related', 'widget'))}><h3>{self.words(1, 4)}</h3><p>{self.words(3, 30, '.')}</p><ul>{self.links(n)}</ul></aside>",
            lambda: f"<div{self.attr('sidebar', 'related', 'recommended', 'widget', 'popular')}><h4>{self.words(1, 3)}</h4><p>{self.words(3, 30, '.')}</p></div>",
            lambda: f"<div{self.attr('cookie', 'cookies', 'consent', 'notice', 'gdpr', 'alert', 'popup', 'modal')}><p>{self.words(5, 40, '.')}</p></div>",
            lambda: f"<form{self.one('', self.attr('search', 'newsletter', 'subscribe', 'login'))}><p>{self.words(2, 15)}</p><label>{self.words(1, 2)}</label><input></form>",
            lambda: f"<div{self.attr('newsletter', 'subscribe', 'signup', 'share', 'social', 'tags')}><p>{self.words(2, 20, '.')}</p></div>",
            lambda: f"<ul{self.one('', self.attr('links', 'nav', 'menu'))}>{self.links(n + 1)}</ul>",
            lambda: f"<p{self.one('', self.attr('links', 'nav', 'pager'))}>{' | '.join(f'<a href=/{i}>{self.words(1, 2)}</a>' for i in range(n + 1))}</p>",
        )()

    def comments(self) -> str:
        n, tag = int(self.rng.integers(1, 5)), self.one("div", "section", "ol")
        item = "li" if tag == "ol" else "div"
        said = "".join(f"<{item}{self.attr('comment', 'reply', 'response')}>{self.one('', f'<b>{self.words(1, 2)}</b>')}<p>{self.words(3, 50, '.')}</p></{item}>" for _ in range(n))
        title = self.one("", *(f"<{h}>{self.words(1, 4)}</{h}>" for h in ("h2", "h3", "h4")))
        ask = f"<form><p>{self.words(3, 12, '.')}</p><textarea></textarea></form>"
        return f"<{tag}{self.attr('comments', 'discussion', 'responses', 'comment-list', 'respond', 'reply', 'disqus')}>{title}{self.one(said, said, said + ask, ask)}</{tag}>"

    def body(self) -> str:
        """Parts of an article, each main text, marked by <!--=--> before it."""
        n, out = int(self.rng.integers(1, 16)), []
        for _ in range(n):
            text = self.words(1, self.one(6, 30, 80), self.one(".", ".", "", "!"))
            kind = self.rng.random()
            if kind < 0.08:
                out.append(f"<h2><!--=-->{self.words(1, 8)}</h2>")
            elif kind < 0.15:
                out.append("<ul>" + "".join(f"<li><!--=-->{self.words(1, self.one(4, 15), self.one('', '.'))}</li>" for _ in range(int(self.rng.integers(2, 7)))) + "</ul>")
            elif kind < 0.18:
                out.append(f"<blockquote>{self.one('<p>', '')}<!--=-->{text}</blockquote>")
            elif kind < 0.22:
                cells, rows = int(self.rng.integers(1, 4)), int(self.rng.integers(1, 5))
                row = lambda tag: "<tr>" + "".join(f"<{tag}><!--=-->{self.words(1, 4)}</{tag}>" for _ in range(cells)) + "</tr>"  # noqa: E731, B023
                out.append(f"<table{self.one('', '', self.attr('table', 'data', 'facts'))}>{self.one('', row('th'))}{''.join(row('td') for _ in range(rows))}</table>")
            elif kind < 0.25:
                out.append(self.one("<pre>", "<pre><code>", "<pre class=code>") + f"<!--=-->{self.one(text, self.words(1, 6))}</pre>")
            elif kind < 0.28:
                out.append(f"<figure><figcaption><!--=-->{text}</figcaption></figure>")
            elif kind < 0.33:
                out.append(f"<div{self.one('', '', self.attr('text', 'para', 'row', 'block'))}><!--=-->{self.inline(text)}</div>")
            elif kind < 0.37:
                end = self.one("", "</dt>"), self.one("", "</dd>")
                out.append("<dl>" + "".join(f"<dt><!--=-->{self.words(1, 3)}{end[0]}<dd><!--=-->{self.inline(self.words(1, 20, '.'))}{end[1]}" for _ in range(int(self.rng.integers(1, 5)))) + "</dl>")
            elif kind < 0.41:
                out.append("<ol>" + "".join(f"<li><!--=-->{self.inline(self.words(1, 20, self.one('', '.')))}" for _ in range(int(self.rng.integers(2, 7)))) + "</ol>")
            elif kind < 0.46:
                out.append(f"<p><!--=-->{self.inline(text)}")
            elif kind < 0.5:
                out.append(f'<p><!--=-->{text} <a href="/x">{self.words(1, 3)}</a> {self.words(1, 9, ".")}</p>')
            else:
                out.append(f"<p{self.one('', '', '', self.attr('lead', 'intro', 'text'))}><!--=-->{self.inline(text)}</p>")
            if self.rng.random() < 0.08:
                out.append(self.aside())
        return "".join(out)

    def page(self) -> str:
        maybe = lambda p, f: f() if self.rng.random() < p else ""
        head = f"<!DOCTYPE html><html><head><meta charset=utf-8><title>{self.words(1, 8)}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
        title = f"<h1><!--=-->{self.words(1, 12)}</h1>"
        odd = "".join(self.one(*"abcdefhkmprstxyz") for _ in range(5))
        wrap = self.one(("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), (f"<div{self.attr('content', 'post', 'entry', 'article', 'story', 'main', 'article-body', 'post-content')}>", "</div>"), (f"<article{self.attr('post', 'story', 'entry')}>", "</article>"), (f"<section{self.attr('content', 'article', 'story')}>", "</section>"), self.one((f"<div class={odd}><div>", "</div></div>"), (f"<div id=page><div class={odd}>", "</div></div>")))
        if self.rng.random() < 0.06:  # a page of one block, or two
            text = self.words(3, 40, self.one(".", "", "!"))
            if self.rng.random() < 0.4:
                at = text.find(" ", len(text) // 2)
                text = text[:at] + self.one(" < ", " &lt; ", " > ", " &amp; ", " = ") + text[at + 1 :] if at > 0 else text
            tag = self.one("p", "p", "p", "div", "h1", "pre", "")
            block = f"<!--=-->{text}" if not tag else f"{self.one('', '', title)}<{tag}><!--=-->{text}</{tag}>"
            return self.one("", "", "<body>", head) + block
        inner = maybe(0.95, lambda: title) + self.body() + maybe(0.12, self.comments)
        if self.rng.random() < 0.15:
            wrap = self.plain_wrap()
        if self.rng.random() < 0.1:  # paragraphs in the body and little else
            return head + maybe(0.3, self.aside) + maybe(0.8, lambda: title) + self.body() + maybe(0.3, lambda: "<hr>" + self.aside()) + maybe(0.2, lambda: f"<footer>&copy; {self.words(1, 6, '.')}</footer>") + maybe(0.15, self.rights) + self.one("</body></html>", "")
        if self.rng.random() < 0.1:  # columns made with a table
            column = lambda: f"<td{self.one('', ' width=150', self.attr('left', 'menu', 'nav', 'side', 'column'))}>{self.one(lambda: f'<ul>{self.links(int(self.rng.integers(2, 8)))}</ul>', lambda: '<br>'.join(f'<a href=/{i}>{self.words(1, 2)}</a>' for i in range(int(self.rng.integers(2, 8)))), self.aside)()}</td>"
            wide = self.one("", " colspan=2", " colspan=3")
            wrap = (f"<table{self.one('', ' border=0', ' width=100%')}>{maybe(0.5, lambda: f'<tr><td{wide}>{self.one(self.words(1, 4), f"<a href=/>{self.words(1, 2)}</a>")}</td></tr>')}<tr>{maybe(0.8, column)}<td>", f"</td>{maybe(0.4, column)}</tr></table>")
        top = maybe(0.3, lambda: f"<header{self.one('', self.attr('header', 'masthead', 'site-header'))}><p>{self.words(1, 6)}</p>{self.one('', f'<ul>{self.links(3)}</ul>')}</header>")
        foot = self.one(lambda: f"<footer>&copy; {self.words(1, 3)} &middot; {self.words(2, 16, '.')}</footer>", lambda: f"<footer><p>{self.words(1, 12, '.')}</p><ul>{self.links(3)}</ul></footer>", lambda: f"<div{self.attr('footer', 'copyright', 'legal')}>&copy; {self.words(1, 14, '.')}</div>")()
        foot = self.rights() if self.rng.random() < 0.2 else foot
        around = self.plain_wrap() if self.rng.random() < 0.3 else ("", "")
        parts = [head, around[0], top, *(self.aside() for _ in range(int(self.rng.integers(0, 4)))), wrap[0], inner, wrap[1], maybe(0.25, self.comments), *(self.aside() for _ in range(int(self.rng.integers(0, 3)))), maybe(0.9, lambda: foot), around[1], self.one("</body></html>", "</body></html>", "")]
        return "".join(parts)

    def example(self) -> tuple[list[Block], np.ndarray]:
        marked = self.page().replace("<!--=-->", "\ue000")
        found = blocks(marked)
        y = np.array([b.text.startswith("\ue000") for b in found], dtype=np.float32)
        for b in found:
            b.text = b.text.replace("\ue000", "").strip() or "-"
        return found, y


@lru_cache(maxsize=2)
def trained(seed: int = 5, pages: int = 2400, epochs: int = 7) -> Labeller:
    """The labeller after training on so many made-up pages; the same each time."""
    maker, model = Maker(seed), Labeller(seed)
    model.fit([(vectors(b), y) for b, y in (maker.example() for _ in range(pages)) if b], epochs)
    return model


def main_texts(pages: list[str | None], model: Labeller) -> list[str]:
    out, group, size = [], [], 0

    def finish() -> None:
        found = [blocks(p) for p in group]
        chosen = model.label(found)
        out.extend("\n\n".join(x.text for x, p in zip(b, y, strict=True) if p > 0.5) for b, y in zip(found, chosen, strict=True))
        group.clear()

    for page in pages:
        if group and (len(group) == GROUP or size + len(page or "") > GROUP_CHARS):
            finish()
            size = 0
        group.append(page)
        size += len(page or "")
    finish()
    return out


def extract(pages: DataFrame, model: Labeller | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: the id, the URL, `text` (blocks of main text, joined by an empty line) and `n_chars`.

    Null, empty or textless html gives an empty text; pages of any length are read whole. Repeated rows are extracted alike, null ids and URLs are
    returned, an empty table gives no rows, further columns are not looked at.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or trained())  # weights of fixed size

    @F.pandas_udf(T.StringType())
    def run(page: pd.Series) -> pd.Series:
        return pd.Series(main_texts([*page], shared.value), dtype=object)

    rows = bare(pages, id_col, url_col, html_col).toDF("id", "url", "html").select("id", "url", run("html").alias("text"))
    return rows.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
