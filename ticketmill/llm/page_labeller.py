"""A recurrent labeller of page blocks in numpy: which blocks of a page are its main text.

A block is a vector: the mean of its hashed words' vectors, the sum of its path's hashed
tag and name vectors, and a few plain figures. A bidirectional LSTM reads a page's blocks
in order, so that each is judged by the whole page. Trained on pages made by a seeded
generator with many kinds of frames; the model is the same on every machine and run.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np

from . import page_blocks
from .page_blocks import Page

WORDS, PATHS = 1 << 12, 1 << 11
WORD_WIDTH, PATH_WIDTH, FIGURES, HIDDEN = 8, 20, 9, 20
INPUT = WORD_WIDTH + PATH_WIDTH + FIGURES
PAGES, EPOCHS, BATCH, RATE, SEED = 1600, 6, 16, 0.01, 11
MARK = ""  # ends the main blocks of generated pages
CELLS = 1 << 15  # blocks scored at once, if one page has no more


class Weights(NamedTuple):
    words: np.ndarray  # WORDS x WORD_WIDTH
    paths: np.ndarray  # PATHS x PATH_WIDTH
    gates: np.ndarray  # 2 x (INPUT + HIDDEN + 1) x 4 HIDDEN; forward and backward in order
    out: np.ndarray  # 2 HIDDEN + INPUT + 1


class Features(NamedTuple):
    """A page as ids and figures; block i has the words[word_ends[i - 1] : word_ends[i]], paths alike."""

    words: np.ndarray
    word_ends: np.ndarray
    paths: np.ndarray
    path_ends: np.ndarray
    figures: np.ndarray


@lru_cache(200_000)
def _word_id(word: str) -> int:
    return zlib.crc32(word.lower().encode()) % WORDS


@lru_cache(50_000)
def _path_ids(tag: str, marks: tuple[str, ...]) -> tuple[int, ...]:
    return tuple(zlib.crc32(name.encode()) % PATHS for name in (tag, *(f".{m}" for m in marks)))


@lru_cache(20_000)
def _own_ids(tag: str, parent: str) -> tuple[int, int]:
    return zlib.crc32(f"={tag}".encode()) % PATHS, zlib.crc32(f">{parent}".encode()) % PATHS


def _figures(text: str, linked: int, count: int, index: int, total: int) -> list[float]:
    size = len(text)
    ends = text.count(".") + text.count("!") + text.count("?") + text.count("。")
    return [
        np.log1p(count) / 4,
        linked / size,
        min(ends / count, 1.0),
        text.count(",") / count if count > 1 else 0.0,
        float(text[-1] in ".!?:。”\"'"),
        sum(map(text.count, "0123456789")) / size,
        float(text[0].isupper()),
        index / total,
        np.log1p(total) / 5,
    ]


def features(page: Page) -> Features:
    """Ids of a page's words and of the tags above its blocks. All ancestors count, the two nearest by name once more."""
    above: list[tuple[int, ...]] = []
    for node in page.nodes:
        above.append((above[node.parent] if node.parent >= 0 else ()) + _path_ids(node.tag, node.marks))
    words, word_ends, paths, path_ends, figures = [], [], [], [], []
    for i, block in enumerate(page.blocks):
        listed = block.text.split(" ")
        words += map(_word_id, listed)
        word_ends.append(len(words))
        if block.node >= 0:
            node = page.nodes[block.node]
            paths += above[block.node]
            paths += _own_ids(node.tag, page.nodes[node.parent].tag if node.parent >= 0 else "")
        path_ends.append(len(paths))
        figures.append(_figures(block.text, block.linked, len(listed), i, len(page.blocks)))
    as_ids = lambda x: np.array(x, np.int64)
    return Features(as_ids(words), as_ids(word_ends), as_ids(paths), as_ids(path_ends), np.array(figures, np.float32).reshape(-1, FIGURES))


def _bag(table: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per block the sum of its ids' vectors, and how many ids it has."""
    counts = np.diff(ends, prepend=0)
    total = np.zeros((len(ends), table.shape[1]), np.float32)
    some = counts > 0
    if some.any():
        total[some] = np.add.reduceat(table[ids], (ends - counts)[some], axis=0)
    return total, counts


def vectors(w: Weights, f: Features) -> np.ndarray:
    words, counts = _bag(w.words, f.words, f.word_ends)
    paths, _ = _bag(w.paths, f.paths, f.path_ends)
    return np.concatenate([words / np.maximum(counts, 1)[:, None], paths, f.figures], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _turned(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each row backwards within its own length."""
    time = x.shape[1]
    at = lengths[:, None] - 1 - np.arange(time)
    return np.take_along_axis(x, np.where(at >= 0, at, np.arange(time))[:, :, None], axis=1)


def forward(w: Weights, x: np.ndarray, lengths: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """Scores (rows x time) of padded rows of block vectors, and what the backward pass needs."""
    rows, time, _ = x.shape
    both = np.stack([x, _turned(x, lengths)])
    into = both @ w.gates[:, None, :INPUT] + w.gates[:, None, None, -1]
    recur = w.gates[:, INPUT:-1]
    h = np.zeros((2, rows, HIDDEN), np.float32)
    c = np.zeros_like(h)
    hs, steps = np.zeros((2, rows, time, HIDDEN), np.float32), []
    for t in range(time):
        z = into[:, :, t] + h @ recur
        s = _sigmoid(z[..., : 3 * HIDDEN])
        i, f, o = s[..., :HIDDEN], s[..., HIDDEN : 2 * HIDDEN], s[..., 2 * HIDDEN :]
        g = np.tanh(z[..., 3 * HIDDEN :])
        was, before = c, h
        c = f * c + i * g
        tanh = np.tanh(c)
        h = o * tanh
        hs[:, :, t] = h
        if keep:
            steps.append((i, f, o, g, was, before, tanh))
    joined = np.concatenate([hs[0], _turned(hs[1], lengths), x], axis=2)
    return joined @ w.out[:-1] + w.out[-1], [both, joined, steps]


def gradients(w: Weights, kept: list, lengths: np.ndarray, d_scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of gates, out and the block vectors; scores beyond a row's length must have gradient 0."""
    both, joined, steps = kept
    d_out = np.concatenate([np.einsum("rth,rt->h", joined, d_scores), [d_scores.sum()]]).astype(np.float32)
    d_joined = d_scores[:, :, None] * w.out[:-1]
    d_hs = np.stack([d_joined[..., :HIDDEN], _turned(d_joined[..., HIDDEN : 2 * HIDDEN], lengths)])
    recur, enter = w.gates[:, INPUT:-1], w.gates[:, :INPUT]
    d_gates, d_both = np.zeros_like(w.gates), np.zeros_like(both)
    d_h = np.zeros(d_hs.shape[:2] + (HIDDEN,), np.float32)
    d_c = np.zeros_like(d_h)
    for t in range(len(steps) - 1, -1, -1):
        i, f, o, g, was, before, tanh = steps[t]
        d_h = d_h + d_hs[:, :, t]
        d_c = d_c + d_h * o * (1 - tanh**2)
        d_z = np.concatenate(
            [d_c * g * i * (1 - i), d_c * was * f * (1 - f), d_h * tanh * o * (1 - o), d_c * i * (1 - g**2)], axis=2
        )
        d_gates[:, :INPUT] += both[:, :, t].transpose(0, 2, 1) @ d_z
        d_gates[:, INPUT:-1] += before.transpose(0, 2, 1) @ d_z
        d_gates[:, -1] += d_z.sum(1)
        d_both[:, :, t] = d_z @ enter.transpose(0, 2, 1)
        d_h, d_c = d_z @ recur.transpose(0, 2, 1), d_c * f
    d_x = d_both[0] + _turned(d_both[1], lengths) + d_joined[..., 2 * HIDDEN :]
    return d_gates, d_out, d_x


def scores(w: Weights, pages: list[Features]) -> list[np.ndarray]:
    """Above 0: main text. Pages of about one length are read together; a long one by itself."""
    found: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if len(p.figures)), key=lambda i: len(pages[i].figures))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * len(pages[order[end]].figures) <= CELLS:
            end += 1
        some = order[at:end]
        lengths = np.array([len(pages[i].figures) for i in some])
        x = np.zeros((len(some), lengths.max(), INPUT), np.float32)
        for row, i in enumerate(some):
            x[row, : lengths[row]] = vectors(w, pages[i])
        for i, values, n in zip(some, forward(w, x, lengths)[0], lengths, strict=True):
            found[i] = values[:n]
        at = end
    return found


# --- generated pages --------------------------------------------------------------

# Words that frames of pages are made of, and names that authors of pages give to parts. Examples of the generator.
FRAME_WORDS = {
    "nav": "home about contact news products services blog login register search menu more sitemap archive help accueil inicio startseite kontakt".split(),
    "ad": "advertisement sponsored buy now sale offer discount free shipping click here deal anzeige publicité publicidad".split(),
    "notice": "we use cookies accept all settings privacy policy consent agree essential einwilligung aceptar accepter datenschutz".split(),
    "footer": "copyright all rights reserved terms privacy imprint impressum mentions légales aviso legal".split(),
    "form": "name email password subscribe newsletter send submit your message required sign up".split(),
    "related": "related articles read more popular latest recommended trending you may also like next previous share tweet".split(),
    "comment": "reply says commented ago likes great post thanks report permalink responses".split(),
}
FRAME_NAMES = {
    "nav": "nav menu navbar navigation topnav breadcrumb breadcrumbs mainmenu tabs links".split(),
    "header": "header masthead banner top site-header branding logo topbar".split(),
    "ad": "ad ads advert advertisement adsense sponsor sponsored promo banner-ad ad-slot adbox dfp".split(),
    "notice": "cookie cookie-notice consent gdpr notice alert popup modal overlay cookie-banner announcement paywall".split(),
    "sidebar": "sidebar side aside widget widget-area right-column left-col rail secondary".split(),
    "related": "related recommended more-stories popular trending share social sharing tags teaser pager pagination".split(),
    "form": "form newsletter subscribe signup login search-form contact-form".split(),
    "comment": "comments comment comment-list commentlist disqus respond discussion replies comment-body reader-comments".split(),
    "footer": "footer site-footer bottom foot copyright legal colophon".split(),
    "main": "content article post entry entry-content article-body post-content story main main-content text body-copy article-text".split(),
    "plain": "wrapper container row col inner block page box section grid css site outer layout wrap clearfix".split(),
}
_SYLLABLES = (
    "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve ung sch ein ich ge lich ción ado mente "
    "que ll ñ eau eux ai ère é ment oi ka no mi ra so tu"
).split()


class _Maker:
    """One generated page; its main blocks end in MARK."""

    def __init__(self, r: random.Random):
        self.r = r
        self.named = r.random() < 0.75  # whether this page's parts have telling names
        self.closed = r.random() < 0.8

    def word(self) -> str:
        return "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.choice((1, 1, 2, 2, 3, 4))))

    def sentence(self, least: int = 1, most: int = 18) -> str:
        words = [self.word() + ("," if self.r.random() < 0.08 else "") for _ in range(self.r.randint(least, most))]
        return " ".join(words).capitalize().rstrip(",") + self.r.choice(("...!?" if self.r.random() < 0.1 else "....."))

    def prose(self) -> str:
        r = self.r
        if r.random() < 0.2:
            text = self.sentence(1, 4)
        else:
            text = " ".join(self.sentence() for _ in range(r.choice((1, 1, 2, 3, 4, 6, 9))))
        if r.random() < 0.06:
            text += r.choice((f" {r.randint(1, 9999)}", " user@mail.example.com", " http://example.org/x", " &amp; co", " token = &quot;9f3a&quot;"))
        return text

    def frame(self, kind: str, least: int = 1, most: int = 6) -> str:
        """A few words, telling or not; sometimes a sentence like any other."""
        draw = self.r.random()
        if draw < 0.35:
            return self.prose()
        words = FRAME_WORDS[kind] if draw < 0.7 else [self.word() for _ in range(4)]
        return " ".join(self.r.choice(words) for _ in range(self.r.randint(least, most))).capitalize()

    def name(self, kind: str) -> str:
        r = self.r
        if kind not in ("main",) and not self.named and r.random() < 0.8:
            kind = "plain"
        given = r.choice(FRAME_NAMES[kind]) + (r.choice(("-1", "_2", " x", "Box", "-wrap", "")) if r.random() < 0.4 else "")
        return f' {r.choice(("class", "class", "id"))}={r.choice((chr(34), chr(39)))}{given}'

    def element(self, tag: str, kind: str, inside: str) -> str:
        name = self.name(kind) if self.r.random() < (0.85 if tag in ("div", "section", "ul", "td", "span") else 0.3) else ""
        return f"<{tag}{name}{name[name.index('=') + 1] if name else ''}>{inside}</{tag}>"

    def links(self, kind: str, least: int = 2, most: int = 9) -> str:
        r = self.r
        items = [f'<a href="/{r.randint(1, 99)}">{self.word() if r.random() < 0.6 else self.frame(kind, 1, 3)}</a>' for _ in range(r.randint(least, most))]
        style = r.random()
        if style < 0.7:
            return "<ul>" + "".join(f"<li>{i}{'</li>' if self.closed else ''}" for i in items) + "</ul>"
        return r.choice((" | ", " ", " &middot; ")).join(items) if style < 0.9 else "".join(f"<div>{i}</div>" for i in items)

    def nav(self) -> str:
        tag = self.r.choice(("nav", "nav", "div", "ul", "header"))
        return self.element(tag, "nav", self.links("nav"))

    def header(self) -> str:
        r = self.r
        inside = r.choice((f"<a href=/>{self.word()}</a>", f"<div>{self.sentence(1, 6)}</div>", f"<h1>{self.word()}</h1><p>{self.sentence(2, 8)}</p>"))
        return self.element(r.choice(("header", "header", "div")), "header", inside + (self.nav() if r.random() < 0.4 else ""))

    def ad(self) -> str:
        r = self.r
        text = self.frame("ad", 2, 9)
        inside = r.choice((text, text, f"<p>{text}</p>", f'<a href="http://ads.example/">{text}</a>', f"<span>{text}</span>"))
        tag = r.choice(("div", "div", "div", "aside", "section", "p"))
        named, self.named = self.named, self.named or r.random() < 0.8
        made = self.element(tag, "ad", inside if tag != "p" else text)
        self.named = named
        return made if "=" in made.split(">")[0] or tag == "aside" else f'<div class="{r.choice(FRAME_NAMES["ad"])}">{inside}</div>'

    def notice(self) -> str:
        text = self.frame("notice", 4, 14)
        inside = f"<p>{text}</p>" if self.r.random() < 0.5 else text
        button = self.r.choice(("", "<button>OK</button>", '<a href="#">OK</a>'))
        return f'<{(tag := self.r.choice(("div", "div", "section", "aside")))} class="{self.r.choice(FRAME_NAMES["notice"])}">{inside}{button}</{tag}>'

    def form(self) -> str:
        text = self.frame("form", 1, 6)
        return f"<form action=/s>{self.r.choice(('<label>', '<p>', '<div>', ''))}{text}<input name=q><select><option>a<option>b</select><button>Go</button></form>"

    def related(self) -> str:
        head = f"<{(h := self.r.choice(('h3', 'h2', 'p', 'div')))}>{self.frame('related', 1, 4)}</{h}>"
        return self.element(self.r.choice(("div", "section", "aside", "aside")), "related", head + self.links("related"))

    def sidebar(self) -> str:
        r = self.r
        parts = [r.choice((self.related, self.ad, self.form, lambda: f"<h4>{self.frame('related', 1, 3)}</h4><p>{self.prose()}</p>"))() for _ in range(r.randint(1, 3))]
        if r.random() < 0.5:
            return self.element("aside", "sidebar", "".join(parts))
        return f'<div class="{r.choice(FRAME_NAMES["sidebar"])}">{"".join(parts)}</div>'

    def comments(self) -> str:
        r = self.r
        says = [
            f"<b>{self.word()}</b> {r.choice(('', f'<time>{r.randint(1, 9)} ago</time> '))}{r.choice(('<p>', '<div>', '<br>'))}{self.prose()}" for _ in range(r.randint(1, 5))
        ]
        if r.random() < 0.5:
            listed = "<ol>" + "".join(f"<li{r.choice(('', ' class=comment'))}>{s}</li>" for s in says) + "</ol>"
        else:
            listed = "".join(f"<div class={r.choice(('comment', 'reply', 'c'))}>{s}</div>" for s in says)
        head = f"<h3>{r.choice((f'{len(says)} comments', 'Comments', self.frame('comment', 1, 3)))}</h3>" if r.random() < 0.7 else ""
        return f'<{(tag := r.choice(("div", "div", "section", "section", "aside")))} {r.choice(("id", "class"))}="{r.choice(FRAME_NAMES["comment"])}">{head}{listed}</{tag}>'

    def footer(self) -> str:
        r = self.r
        text = r.choice((f"&copy; {r.choice(('', '2024 '))}{self.word()}.example.com &middot; {self.sentence(1, 12)}", self.frame("footer", 3, 12), self.prose()))
        inside = r.choice((text, text, f"<p>{text}</p>", f"<div>{text}</div>{self.links('footer')}", f"{self.links('footer')}<p>{text}</p>"))
        if r.random() < 0.7:
            return self.element("footer", "footer", inside)
        return f'<div class="{r.choice(FRAME_NAMES["footer"])}">{inside}</div>'

    def paragraph(self) -> str:
        r, text = self.r, self.prose() + MARK
        draw = r.random()
        if draw < 0.12:
            text = f"<b>{text}<br>" if r.random() < 0.6 else text.replace(" ", " <i>", 1) + "</i>"
        elif draw < 0.2:
            text = f'{self.sentence(1, 5)} <a href="/x">{self.word()}</a> {text}'
        return text

    def body(self) -> list[str]:
        """The pieces of the main text."""
        r, pieces = self.r, []
        count = r.choice((1, 1, 2, 3, 4, 6, 9, 14, 25))
        tag = r.choices(("p", "div", "text"), (12, 2, 1))[0]
        for i in range(count):
            text = self.paragraph()
            draw = r.random()
            if tag == "text":
                pieces.append(f"{text}<hr>")
            elif draw < 0.05 and i:
                pieces.append(f"<{(h := r.choice(('h2', 'h3')))}>{self.sentence(1, 6)}{MARK}</{h}>")
            elif draw < 0.09:
                pieces.append("<ul>" + "".join(f"<li>{self.sentence(1, 9)}{MARK}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif draw < 0.12:
                pieces.append(f"<blockquote>{r.choice(('', '<p>'))}{text}</blockquote>")
            elif draw < 0.14:
                pieces.append(f"<{(t := r.choice(('pre', 'figcaption')))}>{text}</{t}>" if r.random() < 0.5 else f"<table><tr><td>{text}</td></tr></table>")
            else:
                pieces.append(f"<{tag}>{text}{f'</{tag}>' if self.closed or tag == 'div' else ''}")
        return pieces

    def article(self) -> str:
        r, pieces = self.r, self.body()
        for _ in range(r.choice((0, 0, 0, 1, 2))):
            pieces.insert(r.randint(0, len(pieces)), r.choice((self.ad, self.ad, self.related, self.form, self.notice))())
        title = self.sentence(1, 12).rstrip(".")
        if r.random() < 0.85:
            head = f"<h1>{title}{MARK}</h1>"
            if r.random() < 0.2:
                head = f"<header>{head}</header>"
            if r.random() < 0.2:
                head += f"<{(t := r.choice(('p', 'div', 'span')))} class={r.choice(('byline', 'meta', 'date', 'author'))}>{self.word()} {r.randint(1, 28)}.{r.randint(1, 12)}.2023</{t}>"
            pieces.insert(0, head)
        inside = "".join(pieces)
        if r.random() < 0.2:
            inside += self.comments()
        if r.random() < 0.1:
            inside += f"<footer>{self.frame('related')}</footer>"
        kind = r.choices(("article", "main article", "div", "main", "td", "section", "bare"), (10, 3, 6, 3, 1, 1, 1))[0]
        if kind == "main article":
            return f"<main>{self.element('article', 'main', inside)}</main>"
        if kind == "bare":
            return inside
        if kind == "td":
            return f"<table><tr><td>{self.links('nav')}</td><td>{inside}</td></tr></table>"
        return self.element(kind, "main" if r.random() < 0.8 else "plain", inside)

    def page(self) -> str:
        r = self.r
        some = lambda chance, make: make() if r.random() < chance else ""
        before = [some(0.4, self.header), some(0.6, self.nav), some(0.25, self.notice), some(0.4, self.ad), some(0.15, self.form), some(0.15, self.sidebar)]
        after = [some(0.2, self.ad), some(0.25, self.comments), some(0.2, self.related), some(0.3, self.sidebar), some(0.1, self.form), some(0.1, self.notice)]
        if r.random() < 0.3:
            r.shuffle(before)
        if r.random() < 0.5:
            r.shuffle(after)
        inside = "".join(before) + "<!-- x -->" + self.article() + "".join(after)
        if r.random() < 0.3:
            inside = self.element("div", "plain", inside)
        if r.random() < 0.03:
            inside = f"<form>{inside}</form>"
        head = f"<!DOCTYPE html><html><head><title>{self.word()}</title><style>p{{}}</style></head><body>"
        return head + inside + some(0.85, self.footer) + some(0.8, lambda: "</body></html>")


def examples(count: int = PAGES, seed: int = SEED) -> Iterator[tuple[Page, np.ndarray]]:
    """Read pages, and which of their blocks are main text."""
    r = random.Random(seed)
    for _ in range(count):
        page = page_blocks.read(_Maker(r).page())
        labels = np.array([MARK in b.text for b in page.blocks])
        blocks = [b._replace(text=b.text.replace(MARK, "") or "-") for b in page.blocks]
        yield Page(page.nodes, blocks), labels


def _bag_gradient(d: np.ndarray, size: int, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    table = np.zeros((size, d.shape[1]), np.float32)
    np.add.at(table, ids, np.repeat(d, np.diff(ends, prepend=0), axis=0))
    return table


@lru_cache(2)
def trained(count: int = PAGES, epochs: int = EPOCHS, seed: int = SEED) -> Weights:
    """Weights after training with Adam."""
    rng = np.random.default_rng(seed)
    scale = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[-2]), shape).astype(np.float32)
    w = Weights(
        rng.normal(0, 0.3, (WORDS, WORD_WIDTH)).astype(np.float32),
        rng.normal(0, 0.2, (PATHS, PATH_WIDTH)).astype(np.float32),
        scale(2, INPUT + HIDDEN + 1, 4 * HIDDEN),
        rng.normal(0, 0.1, 2 * HIDDEN + INPUT + 1).astype(np.float32),
    )
    made = [(features(page), labels) for page, labels in examples(count, seed) if page.blocks]
    mean, square = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    step, steps = 0, epochs * -(-len(made) // BATCH)
    for _ in range(epochs):
        # Pages of about one length go together, in random order.
        order = np.argsort([len(labels) + rng.random() * 4 for _, labels in made])
        batches = [order[at : at + BATCH] for at in range(0, len(made), BATCH)]
        for chosen in rng.permutation(len(batches)):
            some = [made[i] for i in batches[chosen]]
            lengths = np.array([len(labels) for _, labels in some])
            x = np.zeros((len(some), lengths.max(), INPUT), np.float32)
            y = np.zeros(x.shape[:2], np.float32)
            for row, (f, labels) in enumerate(some):
                x[row, : lengths[row]], y[row, : lengths[row]] = vectors(w, f), labels
            found, kept = forward(w, x, lengths, keep=True)
            there = np.arange(x.shape[1]) < lengths[:, None]
            d_scores = np.where(there, _sigmoid(found) - y, 0).astype(np.float32) / len(some)
            d_gates, d_out, d_x = gradients(w, kept, lengths, d_scores)
            d_words, d_paths = np.zeros_like(w.words), np.zeros_like(w.paths)
            for row, (f, _) in enumerate(some):
                d = d_x[row, : lengths[row]]
                counts = np.maximum(np.diff(f.word_ends, prepend=0), 1)[:, None]
                d_words += _bag_gradient(d[:, :WORD_WIDTH] / counts, WORDS, f.words, f.word_ends)
                d_paths += _bag_gradient(d[:, WORD_WIDTH : WORD_WIDTH + PATH_WIDTH], PATHS, f.paths, f.path_ends)
            step += 1
            rate = RATE * (1 - step / (steps + 1))
            for p, g, m, v in zip(w, (d_words, d_paths, d_gates, d_out), mean, square, strict=True):
                g = np.clip(g, -5, 5)
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return w
