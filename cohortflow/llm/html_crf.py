"""HTML main-text extraction: a linear-chain conditional random field over the
DOM's leaf blocks.

Each block has ancestor features (tags, class and id words on its path, its own
tag, the tag before) and text features (length, link density, punctuation,
place); a page's blocks are one chain with two labels, article and other.  The
field is trained by gradient ascent on the regularised likelihood of labelled
pages and decoded by Viterbi.

Labelled pages: about ``LABELLED`` pages of the table, chosen by the hash of
their html, labelled by their own ``article``/``main`` markup, and twice as many pages
composed from those pages' blocks in varied layouts (``compose``), whose labels
are known because the layout places every block.  All pages are extracted.

Nulls: null html is an empty page, with empty text; null ids and urls are
carried; repeated rows each get their row.  An empty table trains on composed
pages of placeholder words.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable
from functools import reduce
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import col, hash_sample
from cohortflow.llm.html_dom import Block, leaf_blocks

LABELLED = 300
LONGEST_TRAINING_PAGE = 200_000  # characters of a page that may be a training page
STEPS = 120
WIDTH = 1 << 14  # hashed feature space
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def _path_features(path: tuple[tuple[str, str], ...]) -> list[str]:
    tags = [t for t, _ in path if t not in ("html", "body", "b", "i", "em", "strong", "span", "font")]
    out = [f"in:{t}" for t in set(tags)]
    out.append(f"tag:{tags[-1] if tags else ''}")
    out.append(f"deep:{min(len(tags), 8)}")
    for tag, names in path:
        if names:
            words = {w.lower() for w in WORDS.findall(names)}
            out += [f"name:{w}" for w in words] + [f"stem:{w[:4]}" for w in words if len(w) > 4]
            out += [f"{tag}.{w}" for w in words]
            if (tag, names) == path[-1]:
                out += [f"own:{w}" for w in words]
    return sorted(set(out))


def _text_features(b: Block, before: str, place: float) -> list[str]:
    n = len(b.text)
    words = b.text.count(" ") + 1
    return [
        f"words:{min(words, 127).bit_length()}",
        f"links:{int(4 * b.linked / n)}",
        f"stop:{b.text[-1] in '.!?:;…'}",
        f"commas:{min(b.text.count(','), 3)}",
        f"mark:{'©' in b.text or '|' in b.text}",
        f"before:{before}",
        f"place:{int(4 * place)}",
    ]


def _code(name: str) -> int:
    return zlib.crc32(name.encode()) % WIDTH


def features(blocks: list[Block], kept: dict) -> list[np.ndarray]:
    """Hashed feature numbers of each block; ``kept`` remembers paths' numbers."""
    out, before = [], ""
    for k, b in enumerate(blocks):
        codes = kept.get(b.path)
        if codes is None:
            if len(kept) > 20_000:
                kept.clear()
            codes = kept[b.path] = [_code(x) for x in _path_features(b.path)]
        out.append(np.array(codes + [_code(x) for x in _text_features(b, before, k / len(blocks))], np.int64))
        before = b.path[-1][0] if b.path else ""
    return out


def train(pages: list[tuple[list[Block], list[int]]], steps: int = STEPS, rate: float = 0.1, penalty: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """(emission weights WIDTH x 2, transition weights 2 x 2).

    Forward-backward runs over all pages at once, padded to the longest."""
    pages = [p for p in pages if p[0]]
    kept: dict = {}
    feats = [features(b, kept) for b, _ in pages]
    P, T = len(pages), max(len(f) for f in feats)
    length = np.array([len(f) for f in feats])
    gold = np.zeros((P, T), np.int64)
    for i, (_, y) in enumerate(pages):
        gold[i, : len(y)] = y
    flat = np.concatenate([x for f in feats for x in f])
    owner = np.repeat([i * T + t for i, f in enumerate(feats) for t in range(len(f))], [len(x) for f in feats for x in f])
    live = np.arange(T)[None, :] < length[:, None]
    emit, trans = np.zeros((WIDTH, 2)), np.zeros((2, 2))
    moments = [np.zeros_like(emit), np.zeros_like(emit), np.zeros_like(trans), np.zeros_like(trans)]
    rows, total = np.arange(P), live.sum()
    want = np.zeros((P, T, 2))
    want[rows[:, None], np.arange(T)[None, :], gold] = 1
    want[~live] = 0
    pair_live = live[:, 1:]
    want_pairs = np.zeros((2, 2))
    np.add.at(want_pairs, (gold[:, :-1][pair_live], gold[:, 1:][pair_live]), 1)
    for step in range(1, steps + 1):
        score = np.stack([np.bincount(owner, emit[flat, k], P * T).reshape(P, T) for k in (0, 1)], axis=2)
        fwd, bwd = np.zeros((P, T, 2)), np.zeros((P, T, 2))
        fwd[:, 0] = score[:, 0]
        for t in range(1, T):
            new = np.logaddexp.reduce(fwd[:, t - 1, :, None] + trans[None], axis=1) + score[:, t]
            fwd[:, t] = np.where(live[:, t, None], new, fwd[:, t - 1])
        for t in range(T - 2, -1, -1):
            new = np.logaddexp.reduce(trans[None] + (score[:, t + 1] + bwd[:, t + 1])[:, None, :], axis=2)
            bwd[:, t] = np.where(live[:, t + 1, None], new, 0)
        z = np.logaddexp.reduce(fwd[:, -1], axis=1)
        single = np.where(live[:, :, None], np.exp(fwd + bwd - z[:, None, None]), 0)
        both = np.exp(fwd[:, :-1, :, None] + trans + (score + bwd)[:, 1:, None, :] - z[:, None, None, None])
        gap = (want - single).reshape(P * T, 2)
        grads = [np.stack([np.bincount(flat, gap[owner, k], WIDTH) for k in (0, 1)], axis=1) / total - penalty * emit, (want_pairs - both[pair_live].sum(axis=0)) / total - penalty * trans]
        for k, (w, g) in enumerate(zip((emit, trans), grads)):  # Adam
            m, v = moments[2 * k], moments[2 * k + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return emit, trans


def viterbi(score: np.ndarray, trans: np.ndarray) -> list[int]:
    """The best labels of one page's chain (ties go to label 0)."""
    (t00, t01), (t10, t11) = trans.tolist()
    rows = score.tolist()
    a, b = rows[0]
    back = []
    for x, y in rows[1:]:
        from0, from1 = a + t00 < b + t10, a + t01 < b + t11
        back.append((from0, from1))
        a, b = (b + t10 if from0 else a + t00) + x, (b + t11 if from1 else a + t01) + y
    label = int(b > a)
    out = [label]
    for step in reversed(back):
        label = int(step[label])
        out.append(label)
    return out[::-1]


def extract(page: str | None, emit: np.ndarray, trans: np.ndarray, kept: dict) -> str:
    """The article's blocks, in page order, joined by a line feed."""
    blocks = leaf_blocks(page or "")
    if not blocks:
        return ""
    score = np.stack([emit[f].sum(axis=0) for f in features(blocks, kept)])
    return "\n".join(b.text for b, y in zip(blocks, viterbi(score, trans)) if y)


# ---- labelled pages ------------------------------------------------------------

# Names that sites give to the parts of a page.
ARTICLE_NAMES = "content main post entry article story body text post-content entry-content article-body main-content page-content story-body blog-post single articleBody prose markdown".split()
PARTS = {
    "menu": "nav menu navbar navigation main-menu top-menu breadcrumb breadcrumbs pagination pager tabs toc".split(),
    "header": "header masthead topbar site-header branding logo banner tagline page-header".split(),
    "footer": "footer site-footer contentinfo copyright colophon bottom legal credits page-footer".split(),
    "sidebar": "sidebar side aside complementary widget widget-area related recommended popular trending recent rail right-column left-column more-stories".split(),
    "notice": "notice alert cookie cookies cookie-banner cookie-notice consent gdpr warning message popup modal overlay newsletter subscribe signup paywall promo-bar announcement disclaimer".split(),
    "advert": "ad ads advert advertisement adsense ad-slot sponsored sponsor promo promotion banner-ad commercial dfp outbrain taboola".split(),
    "form": "form login search search-box contact-form register feedback signin".split(),
    "comments": "comments comment comment-list commentlist comment-body reply replies respond discussion disqus reactions user-comments reader-comments responses".split(),
    "share": "share sharing social social-links follow buttons toolbar meta byline-tools tags tag-list".split(),
}
BYLINE = "byline author date meta post-meta published timestamp dateline".split()
SEMANTIC = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}


class _Layout:
    """Composes pages whose every block has a known label."""

    def __init__(self, rng: Random, pool: list[str]) -> None:
        self.rng, self.pool = rng, pool

    def text(self, most: int | None = None) -> str:
        words = self.rng.choice(self.pool).split()
        if most and len(words) > most:
            words = words[: self.rng.randint(1, most)]
        return re.sub(r"[<>&]", "", " ".join(words)) or "text"

    def wrap(self, inner: str, tag: str, names: list[str] | None = None) -> str:
        key = self.rng.choice(["class", "class", "id"])
        return f'<{tag} {key}="{self.rng.choice(names)}">{inner}</{tag}>' if names else f"<{tag}>{inner}</{tag}>"

    def article(self) -> str:
        r = self.rng
        out = [f"<h1>{self.text(12)}</h1>"] if r.random() < 0.9 else []
        for _ in range(r.randint(1, 14)):
            x = r.random()
            if x < 0.62:
                out.append(f"<p>{self.text()}</p>")
            elif x < 0.72:
                out.append(f"<p><b>{self.text()}<br>")
            elif x < 0.77:
                out.append(f"<p>{self.text(15)} <a href='/x'>{self.text(6)}</a> {self.text(20)}</p>")
            elif x < 0.82:
                out.append(f"<h{r.randint(2, 4)}>{self.text(8)}</h2>")
            elif x < 0.87:
                out.append("<ul>" + "".join(f"<li>{self.text(r.choice([4, 20]))}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif x < 0.90:
                out.append(f"<blockquote>{self.text()}</blockquote>")
            elif x < 0.93:
                out.append(f"<pre>{self.text(30)}</pre>")
            elif x < 0.96:
                out.append("<table>" + "".join(f"<tr><td>{self.text(5)}</td><td>{self.text(5)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>")
            else:
                out.append(f"<div>{self.text()}</div>")
        return "".join(out)

    def other(self, part: str) -> str:
        r = self.rng
        if part == "menu" or (part in ("footer", "sidebar", "share") and r.random() < 0.4):
            inner = "<ul>" + "".join(f"<li><a href='/{i}'>{self.text(3)}</a></li>" for i in range(r.randint(2, 8))) + "</ul>"
            if r.random() < 0.3:
                inner = " ".join(f"<a href='/{i}'>{self.text(2)}</a>" for i in range(r.randint(2, 6)))
        elif part == "form":
            inner = f"<label>{self.text(3)}</label><input name='q'><select><option>{self.text(2)}<option>{self.text(2)}</select><textarea>{self.text(4)}</textarea><button>{self.text(2)}</button>"
            inner += f"<p>{self.text(20)}</p>" if r.random() < 0.4 else ""
        elif part == "comments":
            item = lambda: f"<p>{self.text()}</p>" if r.random() < 0.6 else f"<span>{self.text(3)}</span><div>{self.text()}</div>"
            each = [self.wrap(item(), r.choice(["div", "li", "article"]), PARTS["comments"]) if r.random() < 0.7 else item() for _ in range(r.randint(1, 6))]
            inner = (f"<h3>{self.text(3)}</h3>" if r.random() < 0.6 else "") + "".join(each)
        elif part == "footer":
            inner = f"&copy; {self.text(4)} &middot; {self.text(20)}" if r.random() < 0.6 else f"<p>{self.text()}</p>"
        else:
            inner = (f"<h3>{self.text(4)}</h3>" if r.random() < 0.4 else "") + (f"<p>{self.text()}</p>" if r.random() < 0.6 else self.text(r.choice([6, 40])))
        if part in ("notice", "advert", "share") and r.random() < 0.3:  # the element itself is named
            text = self.text(r.choice([8, 25]))
            return self.wrap(f"{text}{r.choice(['', ' <a href=/x>more</a>'])}", r.choice(["p", "div", "span"]), PARTS[part])
        tag = SEMANTIC.get(part)
        if tag and r.random() < 0.6:
            return self.wrap(inner, tag, PARTS[part] if r.random() < 0.3 else None)
        return self.wrap(inner, r.choice(["div", "div", "section", "ul" if "<li>" in inner and inner.startswith("<li>") else "div"]), PARTS[part])

    def page(self) -> tuple[list[Block], list[int]]:
        r = self.rng
        body: list[tuple[str, int]] = []
        some = lambda parts, p: [(self.other(x), 0) for x in parts if r.random() < p]
        body += some(["notice"], 0.3) + some(["header"], 0.4) + some(["menu"], 0.7) + some(["advert", "share", "form"], 0.3)
        inside = [(self.article(), 1)]
        if r.random() < 0.15:  # a head with the title and who wrote it
            inside = [("<header>", 0), (f"<h1>{self.text(12)}</h1>", 1), (self.wrap(self.text(5), r.choice(["p", "div", "span"]), BYLINE), 0), ("</header>", 0), *inside]
        if r.random() < 0.5:  # other parts within the article's element
            inside = some(["share", "menu", "notice", "advert"], 0.25) + inside + some(["advert", "share", "form", "comments", "notice", "sidebar"], 0.3)
            while r.random() < 0.5:
                inside += [("".join(f"<p>{self.text()}</p>" for _ in range(r.randint(1, 3))), 1)]
                inside += some(["advert", "notice", "form", "share"], 0.25)
        tag, names = r.choice([("article", None), ("article", ARTICLE_NAMES), ("main", None), ("main", ARTICLE_NAMES), ("div", ARTICLE_NAMES), ("div", ARTICLE_NAMES), ("section", ARTICLE_NAMES), ("div", None), ("div", None)])
        opened = f'<{tag} class="{r.choice(names)}">' if names else f"<{tag}>"
        if r.random() < 0.2:
            opened, closed = f"<div id='{r.choice(['page', 'wrapper', 'container', 'main'])}'>{opened}", f"</{tag}></div>"
        else:
            closed = f"</{tag}>"
        if r.random() < 0.08:  # no element of its own
            opened = closed = ""
        body += [(opened, 0), *inside, (closed, 0)]
        body += some(["share", "advert", "sidebar"], 0.35) + some(["comments"], 0.4) + some(["form", "notice", "sidebar", "menu"], 0.2) + some(["footer"], 0.8)
        # a private mark at the edges of every labelled part tells its blocks apart
        whole = "<html><body>" + "".join(f"<mark-{y}>{x}</mark-{y}>" if x not in (opened, closed, "<header>", "</header>") else x for x, y in body) + "</body></html>"
        blocks, labels = [], []
        for b in leaf_blocks(whole):
            marks = [t for t, _ in b.path if t.startswith("mark-")]
            labels.append(int(bool(marks) and marks[-1] == "mark-1"))
            blocks.append(Block(b.text, tuple(x for x in b.path if not x[0].startswith("mark-")), b.linked))
        return blocks, labels


def compose(pool: list[str], n: int, seed: int = 7) -> list[tuple[list[Block], list[int]]]:
    layout = _Layout(Random(seed), pool or ["Lorem ipsum dolor sit amet, consectetur adipiscing elit.", "Sed do eiusmod"])
    return [layout.page() for _ in range(n)]


def labelled_by_markup(blocks: list[Block]) -> list[int] | None:
    """Labels of a page with exactly one kind of article element, else None."""
    others = {"nav", "aside", "footer", "form", "header"}
    named = reduce(set.union, (set(v) for v in PARTS.values()))
    labels = []
    for b in blocks:
        tags = [t for t, _ in b.path]
        at = next((tags.index(t) for t in ("article", "main") if t in tags), None)
        inner = b.path[at + 1 :] if at is not None else ()
        labels.append(int(at is not None and not any(t in others or set(names.split()) & named for t, names in inner)))
    return labels if any(labels) else None


def fit(pages: DataFrame, html_col: str = "html", labelled: int = LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Weights trained on about ``labelled`` pages and twice as many composed ones."""
    some = pages.select(col(html_col).cast("string").alias("h")).where(f"h is not null and length(h) <= {LONGEST_TRAINING_PAGE}")
    # copies of a page share a hash: one of them is enough
    once = hash_sample(some, [F.col("h")], labelled, "training").groupBy(F.xxhash64("h").alias("k")).agg(F.first("h").alias("h"))
    sample = [leaf_blocks(r["h"]) for r in sorted(once.collect(), key=lambda r: r["k"])]
    own = [(b, y) for b in sample if (y := labelled_by_markup(b))]
    pool = [x.text for b in sample for x in b]
    return train(own + compose(pool, 2 * labelled))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", weights: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """Per row: page_id, url, text, n_chars (code points)."""
    emit, trans = weights or fit(pages, html_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        kept: dict = {}
        for b in batches:
            text = [extract(x.as_py(), emit, trans, kept) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(x) for x in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(col(id_col).alias("page_id"), col(url_col).alias("url"), col(html_col).cast("string").alias("html"))
    kinds = [f.dataType.simpleString() for f in rows.schema]
    return rows.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
