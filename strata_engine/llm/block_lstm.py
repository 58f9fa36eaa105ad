"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaf blocks. Each block is a vector: hashed counts of
the elements, classes, ids and roles above it, its own element, hashed counts
of its words, and a few sizes. A bidirectional LSTM in numpy reads the
sequence both ways, so every block is classified (main text or not) with the
whole page as context.

It is trained on a bounded sample of the given pages: as they are, labelled by
their article element, and rebuilt with the same texts inside other page
layouts (menus, sidebars, notices, forms, reader comments and so on, whose
place tells the label).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata_engine.llm.common import map_texts, named, sample_keys
from strata_engine.llm.html_blocks import Block, Element, blocks, bucket

PATH_DIMS, TAG_DIMS, WORD_DIMS, SIZE_DIMS = 96, 16, 48, 6
DIMS = PATH_DIMS + TAG_DIMS + WORD_DIMS + SIZE_DIMS
HIDDEN = 24
# Blocks of a training sequence; longer pages are cut for training only.
TRAIN_BLOCKS = 80

# Page parts that are not main text, as opening tags, and the
# short texts usual in them.
NOT_MAIN = (
    '<nav>', '<nav class="menu">', '<ul class="menu">', '<div id="navbar">', '<div class="navigation">', '<div role="navigation">',
    '<header>', '<header class="site-header">', '<div id="header">', '<div class="masthead">', '<div class="topbar">',
    '<div class="breadcrumb">', '<div class="breadcrumbs">', '<div class="pagination">',
    '<aside>', '<aside class="sidebar">', '<div class="sidebar">', '<div id="sidebar">', '<div role="complementary">', '<div class="widget">',
    '<div class="cookie-notice">', '<div id="cookie-banner">', '<div class="gdpr consent">', '<div class="notice">', '<div class="alert">',
    '<div class="banner">', '<div class="popup modal">', '<div class="newsletter">', '<div class="subscribe">', '<div role="alert">',
    '<div class="ad">', '<div class="ads">', '<div class="advert">', '<div class="advertisement">', '<div class="sponsored">',
    '<div class="promo">', '<div id="ad-top">', '<section class="sponsor">',
    '<form>', '<form class="search">', '<form id="login">', '<div class="search-form">', '<fieldset>',
    '<section class="comments">', '<div id="comments">', '<div class="comment">', '<ol class="commentlist">', '<div class="comment-list">',
    '<section id="respond">', '<div class="replies">', '<div id="disqus">', '<ul class="comments">', '<article class="comment">',
    '<footer>', '<footer class="site-footer">', '<div id="footer">', '<div class="copyright">', '<div role="contentinfo">',
    '<div class="share">', '<div class="social">', '<div class="related">', '<ul class="related-posts">', '<div class="tags">', '<div class="author-bio">',
)
MAIN = (
    '<article>', '<article class="post">', '<main>', '<main id="main">', '<main><article>', '<div class="content">', '<div id="content">',
    '<div class="article">', '<div class="article-body">', '<div class="entry-content">', '<div class="post-content">', '<div role="main">',
    '<section class="story">', '<div id="main"><div class="text">', '<article><div class="body">',
)
SHORT = (
    "Home", "About us", "Contact", "Log in", "Sign up", "Subscribe to our newsletter", "We use cookies to improve this site.", "Accept all",
    "Privacy policy", "Terms of use", "All rights reserved.", "Share this page", "Read more", "Related articles", "Leave a reply", "Comments",
    "Reply", "Search", "Menu", "Advertisement", "Sponsored", "Next page", "Previous", "Follow us", "Your email address", "Submit",
    "Startseite", "Impressum", "Datenschutz", "Anmelden", "Kommentare", "Wir verwenden Cookies.", "Accueil", "Mentions légales", "Commentaires",
    "Nous utilisons des cookies.", "Inicio", "Aviso legal", "Comentarios", "Utilizamos cookies.",
)
CONTENT_TAGS = ("p", "p", "p", "p", "div", "h2", "h3", "li", "blockquote", "td", "pre")
# Elements above a block that say it is main text, and elements and names
# that say it is not.
MAIN_PATH = frozenset(("article", "main"))
NOT_MAIN_PATH = frozenset(
    "nav header footer aside form .nav .menu .sidebar .footer .ad .ads .advert .cookie .notice .comment .comments .banner".split()
)

_words: dict[str, int] = {}


def _word_bucket(word: str) -> int:
    found = _words.get(word)
    if found is None:
        if len(_words) > 100_000:
            _words.clear()
        found = _words[word] = bucket(word, WORD_DIMS)
    return found


def vectors(page: list[Block]) -> np.ndarray:
    """One row of DIMS numbers per block."""
    out = np.zeros((len(page), DIMS))
    total = sum(len(b.text) for b in page) or 1
    seen = 0
    for row, b in zip(out, page):
        if b.element is not None:
            row[:PATH_DIMS] = np.frombuffer(b.element.counts(PATH_DIMS, 2), np.uint8)
        row[PATH_DIMS + bucket(b.tag, TAG_DIMS)] = 1.0
        words = b.text.lower().split()
        counts = np.bincount(list(map(_word_bucket, words)), minlength=WORD_DIMS)
        row[PATH_DIMS + TAG_DIMS : PATH_DIMS + TAG_DIMS + WORD_DIMS] = counts / np.sqrt(float(counts @ counts))
        stops = b.text.count(".") + b.text.count(",")
        row[-SIZE_DIMS:] = (
            np.log1p(len(words)) / 5, b.linked / max(len(b.text), 1), stops / len(words), seen / total, len(b.text) / total, b.path_length / 10
        )
        seen += len(b.text)
    return out


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _run(x, w, u, b, keep=False):
    """One direction over x [pages, blocks, DIMS]: hidden states, and what
    the backward pass needs."""
    n, steps, _ = x.shape
    size = u.shape[0]
    given = x @ w + b
    h, c = np.zeros((n, size)), np.zeros((n, size))
    states, kept = np.empty((n, steps, size)), []
    for t in range(steps):
        z = given[:, t] + h @ u
        gates, new = _sigmoid(z[:, : 3 * size]), np.tanh(z[:, 3 * size :])
        i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
        before_c, before_h = c, h
        c = f * c + i * new
        squashed = np.tanh(c)
        h = o * squashed
        states[:, t] = h
        if keep:
            kept.append((i, f, o, new, before_c, before_h, squashed))
    return states, kept


def _back(x, u, kept, d_states):
    """Gradients of w, u, b for gradients of the hidden states."""
    n, steps, _ = x.shape
    size = u.shape[0]
    d_given = np.empty((n, steps, 4 * size))
    du, dh, dc = np.zeros_like(u), np.zeros((n, size)), np.zeros((n, size))
    for t in range(steps - 1, -1, -1):
        i, f, o, new, before_c, before_h, squashed = kept[t]
        dh = dh + d_states[:, t]
        dc = dc + dh * o * (1 - squashed**2)
        dz = np.concatenate(
            [dc * new * i * (1 - i), dc * before_c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - new**2)], 1
        )
        d_given[:, t] = dz
        du += before_h.T @ dz
        dh, dc = dz @ u.T, dc * f
    return np.einsum("ntd,ntz->dz", x, d_given, optimize=True), du, d_given.sum((0, 1))


def _reversal(lengths: np.ndarray, steps: int) -> np.ndarray:
    """Column numbers that turn each row's first ``length`` places round."""
    t = np.arange(steps)[None, :]
    return np.where(t < lengths[:, None], lengths[:, None] - 1 - t, t)


@dataclass
class Labeller:
    """Weights of both directions and of the output."""

    p: list[np.ndarray]  # w, u, b forwards; w, u, b backwards; out forwards; out backwards; bias

    @classmethod
    def fresh(cls, seed: int = 1) -> Labeller:
        rng = np.random.default_rng(seed)
        p = []
        for _ in range(2):
            bias = np.zeros(4 * HIDDEN)
            bias[HIDDEN : 2 * HIDDEN] = 1.0  # remember at first
            p += [rng.normal(0, DIMS**-0.5, (DIMS, 4 * HIDDEN)), rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN)), bias]
        return cls([*p, rng.normal(0, 0.1, HIDDEN), rng.normal(0, 0.1, HIDDEN), np.zeros(1)])

    def _both(self, x, lengths, keep=False):
        turn = _reversal(lengths, x.shape[1])
        rows = np.arange(len(x))[:, None]
        back_x = x[rows, turn]
        ahead, kept_a = _run(x, *self.p[:3], keep)
        behind, kept_b = _run(back_x, *self.p[3:6], keep)
        z = ahead @ self.p[6] + behind[rows, turn] @ self.p[7] + self.p[8]
        return z, (ahead, kept_a, back_x, behind, kept_b, turn, rows)

    def gradients(self, x, lengths, target):
        z, (ahead, kept_a, back_x, behind, kept_b, turn, rows) = self._both(x, lengths, True)
        mask = np.arange(x.shape[1])[None, :] < lengths[:, None]
        dz = np.where(mask, _sigmoid(z) - target, 0.0) / mask.sum()
        grads_a = _back(x, self.p[1], kept_a, dz[:, :, None] * self.p[6])
        turned = dz[rows, turn]
        grads_b = _back(back_x, self.p[4], kept_b, turned[:, :, None] * self.p[7])
        return [
            *grads_a, *grads_b, np.einsum("nt,nth->h", dz, ahead), np.einsum("nt,nth->h", turned, behind), np.array([dz.sum()])
        ]

    def label(self, pages: list[np.ndarray], group: int = 64) -> list[np.ndarray]:
        """Probability of main text for every block of every page. Pages of
        similar length are read together."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i, x in enumerate(pages) if len(x)), key=lambda i: len(pages[i]))
        for start in range(0, len(order), group):
            part = order[start : start + group]
            # a few very long pages must not pad a whole group
            while part:
                longest = len(pages[part[-1]])
                some = [i for i in part if 2 * len(pages[i]) >= longest]
                z, _ = self._both(*_padded([pages[i] for i in some]))
                for i, row in zip(some, z):
                    out[i] = _sigmoid(row[: len(pages[i])])
                part = part[: len(part) - len(some)]
        return out


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(x) for x in pages])
    x = np.zeros((len(pages), lengths.max(), DIMS))
    for row, page in zip(x, pages):
        row[: len(page)] = page
    return x, lengths


def train(pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 8, group: int = 32, rate: float = 0.01, seed: int = 1) -> Labeller:
    """Adam on the log loss of all blocks of (vectors, labels)."""
    parts = [(x[a : a + TRAIN_BLOCKS], y[a : a + TRAIN_BLOCKS]) for x, y in pages for a in range(0, len(x), TRAIN_BLOCKS)]
    model, rng = Labeller.fresh(seed), np.random.default_rng(seed)
    m, v, step = [np.zeros_like(p) for p in model.p], [np.zeros_like(p) for p in model.p], 0
    for epoch in range(epochs):
        order = rng.permutation(len(parts))
        for a in range(0, len(order), group):
            some = [parts[i] for i in order[a : a + group]]
            x, lengths = _padded([p[0] for p in some])
            y = np.zeros(x.shape[:2])
            for row, p in zip(y, some):
                row[: len(p[1])] = p[1]
            step += 1
            now = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for k, g in enumerate(model.gradients(x, lengths, y)):
                g = np.clip(g, -1, 1)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                model.p[k] -= now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def own_labels(page: list[Block]) -> np.ndarray | None:
    """1 for blocks of the article or main element outside any part that is
    named otherwise; None for a page without such an element."""
    known: dict[Element | None, tuple[bool, bool]] = {None: (False, False)}
    found = []
    for b in page:
        above, at = [], b.element
        while at not in known:
            above.append(at)
            at = at.around
        inside, other = known[at]
        for at in reversed(above):
            inside = inside or not MAIN_PATH.isdisjoint(at.tokens)
            other = other or not NOT_MAIN_PATH.isdisjoint(at.tokens)
            known[at] = inside, other
        found.append((inside, other))
    if not any(inside for inside, _ in found):
        return None
    return np.array([float(inside and not other) for inside, other in found])


def rebuilt(texts: list[str], rng: np.random.Generator) -> tuple[str, list[bool]]:
    """A page of another layout: main text from ``texts`` with other parts
    before, in and after it; which block is which, in order."""
    page, labels = ["<html><body>"], []

    def close(opening):
        return "".join(f"</{t.split()[0].rstrip('>')}>" for t in reversed(opening.split("<")[1:]))

    def escape(s):
        return s.replace("&", "&amp;").replace("<", "&lt;")

    def other():
        opening = NOT_MAIN[rng.integers(len(NOT_MAIN))]
        page.append(opening)
        for _ in range(rng.integers(1, 6)):
            long = rng.random() < 0.35
            s = texts[rng.integers(len(texts))] if long else SHORT[rng.integers(len(SHORT))]
            s = s if long else (s if rng.random() < 0.6 else " ".join(texts[rng.integers(len(texts))].split()[:3]))
            tag = ("p", "li", "div", "span", "h3", "label")[rng.integers(6)]
            link = rng.random() < (0.1 if long else 0.5)
            body = f'<a href="#">{escape(s)}</a>' if link else escape(s)
            # inline parts run together: keep them apart as blocks
            page.append(f"<div><{tag}>{body}</{tag}></div>")
            labels.append(False)
        page.append(close(opening))

    for _ in range(rng.integers(1, 4)):
        other()
    opening = MAIN[rng.integers(len(MAIN))]
    page.append(opening)
    if rng.random() < 0.7:
        page.append(f"<h1>{escape(texts[rng.integers(len(texts))][:60])}</h1>")
        labels.append(True)
    for _ in range(rng.integers(1, 14)):
        tag = CONTENT_TAGS[rng.integers(len(CONTENT_TAGS))]
        s = escape(texts[rng.integers(len(texts))])
        if rng.random() < 0.15:
            s = f'<a href="/x">{s[:20]}</a> {s[20:]}'
        page.append(f"<{tag}>{s}</{tag}>" if tag not in ("li", "td") else f"<ul><li>{s}</li></ul>")
        labels.append(True)
        if rng.random() < 0.12:
            other()
    page.append(close(opening))
    for _ in range(rng.integers(1, 4)):
        other()
    return "".join(page) + "</body></html>", labels


def training_pages(pages: list[str], layouts: int = 3, seed: int = 2) -> list[tuple[np.ndarray, np.ndarray]]:
    """(vectors, labels) of the pages themselves and of ``layouts`` rebuilt
    ones for each; rebuilt pages use the pages' own texts, and the first
    words of some as headings."""
    rng = np.random.default_rng(seed)
    parsed = [b for b in map(blocks, pages) if b]
    out = [(vectors(b), y) for b in parsed if (y := own_labels(b)) is not None]
    texts = [b.text for page in parsed for b in page if len(b.text) > 40] or list(SHORT)
    for _ in range(layouts * max(len(parsed), 20)):
        page, labels = rebuilt(texts, rng)
        found = blocks(page)
        if len(found) == len(labels):
            out.append((vectors(found), np.array(labels, float)))
    return out


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_rows: int = 250) -> Labeller:
    """Train on at most ``sample_rows`` pages (smallest id hash, at most
    ``common.SAMPLE_BYTES``; of pages that share an id, those with the
    smallest hash of their text, twice ``sample_rows`` in all)."""
    src = named(pages, page_id=id_col, html=html_col).where("page_id is not null and html is not null")
    src = src.withColumn("html", F.col("html").cast("string"))
    keys = sample_keys(src, "page_id", "html", sample_rows)
    rows = src.join(F.broadcast(keys), "page_id", "left_semi").select("html")
    rows = rows.orderBy(F.xxhash64("html"), "html").limit(2 * sample_rows).collect()
    return train(training_pages(sorted(r["html"] for r in rows)))


def extract(pages: DataFrame, model: Labeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_blocks, n_kept: the blocks labelled main text,
    in page order, joined by newlines; one row per input row, no shuffle.
    Null, empty or textless pages give an empty text; other columns are
    ignored."""

    def make():
        def f(texts):
            pages = [blocks(t) for t in texts]
            marks = model.label([vectors(b) for b in pages])
            kept = [[b.text for b, p in zip(page, mark) if p >= 0.5] for page, mark in zip(pages, marks)]
            return [["\n".join(k) for k in kept], [len(b) for b in pages], [len(k) for k in kept]]

        return f

    src = named(pages, page_id=id_col, url=url_col, html=html_col).withColumn("html", F.col("html").cast("string"))
    return map_texts(src, ["page_id", "url"], "html", "text string, n_blocks bigint, n_kept bigint", make)
