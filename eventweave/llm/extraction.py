"""Main text of web pages: gradient-boosted trees over DOM-node features.

Every layout element of a page gets features of its subtree (text and link density, size,
punctuation), its class and role words, depth, siblings and place, and the log-odds, from
boosted trees, that it belongs to the article. Decoding is hierarchical: an element is in,
out, or only divides its children; below an element that is out nothing is in, and the best
consistent choice for the whole page is found in one pass up and one down the tree. The text
units inside are the result, in page order.

No page is labelled. The trees are fitted on at most ``SAMPLE`` pages of at most ``MOST_BYTES``,
chosen by a hash of page_id: what pages say themselves (article and main elements against menus, footers,
sidebars) marks real text as article or not, and this text, laid out anew in many ways (other
elements, telling or meaningless class words, comments and notices made of other pages'
text), gives the training pages. Every page of the table is then decoded from its whole html.

Defined cases: null, empty and blank html give an empty text; text without elements is judged
as one element; repeated rows give equal results; an empty table gives no rows; extra columns
are ignored; broken and unclosed markup is read leniently (``dom``).
"""

from __future__ import annotations

import random
from html import escape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.llm import boosting, dom
from eventweave.llm.frames import by_blocks, need

#: Pages used for fitting at most (in expectation), and training pages made from them.
SAMPLE, MADE = 400, 900
#: Pages of more bytes teach nothing (a bound on what the driver holds; every page is decoded).
MOST_BYTES = 256 << 10
_OUT_TAGS = frozenset("nav menu header footer aside form".split())
_OUT_ROLES = sum(1 << i for i in (1, 3, 4, 5, 6, 7, 9))


def decode(page: dom.Page, log_odds: np.ndarray) -> list[str]:
    """Text units of the best consistent choice of elements."""
    n = len(page.tag)
    s = np.clip(log_odds, -5, 5).tolist()
    own = [False] * n
    for u in page.unit_node:
        own[u] = True
    keep, drop, divide = list(s), [-v for v in s], [0.0] * n
    for i in range(n):
        if own[i]:                      # its own text has to be in or out
            divide[i] = -abs(s[i])
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        keep[p] += max(keep[i], drop[i])
        drop[p] += drop[i]
        divide[p] += max(keep[i], drop[i], divide[i])
    state = [0] * n                     # 1 in, 0 out, 2 divides
    state[0] = 1 if keep[0] >= max(drop[0], divide[0]) else 2 if divide[0] > drop[0] else 0
    for i in range(1, n):
        above = state[page.parent[i]]
        if above == 1:
            state[i] = int(keep[i] >= drop[i])
        elif above == 2:
            state[i] = 1 if keep[i] >= max(drop[i], divide[i]) else 2 if divide[i] > drop[i] else 0
    return [t for u, t in zip(page.unit_node, page.unit_text) if state[u] == 1]


def main_texts(pages: list[str | None], model: boosting.Boosted) -> list[str]:
    """Main text of every page; the trees see the elements of all pages at once."""
    parsed = [dom.parse(h or "") for h in pages]
    some = [p for p in parsed if p.unit_text]
    if not some:
        return [""] * len(parsed)
    log_odds = model.log_odds(np.concatenate([dom.features(p) for p in some]))
    parts = iter(np.split(log_odds, np.cumsum([len(p.tag) for p in some])[:-1]))
    return ["\n\n".join(decode(p, next(parts))) if p.unit_text else "" for p in parsed]


# -- training pages -----------------------------------------------------------------------

def marked(page: dom.Page) -> list[int | None]:
    """For every element: 1 in an article, 0 in something that is not, None if the page does not say."""
    out: list[int | None] = [None] * len(page.tag)
    for i in range(1, len(page.tag)):
        above = out[page.parent[i]]
        if above == 0 or page.tag[i] in _OUT_TAGS or page.roles[i] & _OUT_ROLES:
            out[i] = 0
        elif above == 1 or page.tag[i] in ("article", "main") or page.roles[i] & 1:
            out[i] = 1
    return out


_NAMES = [words.split() for words in dom.ROLES]
_PLAIN = ["x", "c", "box", "row", "col", "wrap", "inner", "container", "block", "grid", "a1", "b2", "l-1"]
_TAGS = {0: ["article", "main", "div", "section", "div"], 1: ["nav", "div", "ul", "div"], 2: ["header", "div"], 3: ["footer", "div", "div"], 4: ["aside", "div", "section"],
         5: ["div", "dialog", "section"], 6: ["div", "aside", "div"], 7: ["section", "div", "div"], 8: ["div"], 9: ["form", "div", "form"]}


class Layouts:
    """Training pages from real texts; truth is carried by the attribute data-y."""

    def __init__(self, articles: list[list[tuple[str, str]]], lines: list[str], seed: int):
        self.articles, self.rng = articles, random.Random(seed)
        self.lines = lines or [" ".join(t.split()[:6]) for a in articles for _, t in a[:1]] or ["Home"]

    def box(self, role: int, inner: str, y: int, telling: float) -> str:
        r = self.rng
        tag, names = r.choice(_TAGS[role]), []
        if r.random() < telling:
            names.append(r.choice(_NAMES[role]))
            if r.random() < 0.3:
                names[-1] += "-" + r.choice(_PLAIN)
        else:
            tag = "div" if r.random() < 0.6 else tag
        if r.random() < 0.5:
            names.append(r.choice(_PLAIN))
        label = f' {r.choice(["class", "id"])}="{" ".join(names)}"' if names else ""
        out = f"<{tag}{label} data-y={y}>{inner}</{tag}>"
        for _ in range(r.choice([0, 0, 0, 1, 2])):
            out = f'<div class="{r.choice(_PLAIN)}">{out}</div>'
        return out

    def some(self, a: int, b: int) -> list[str]:
        return [escape(self.rng.choice(self.lines)) for _ in range(self.rng.randint(a, b))]

    def links(self, a: int, b: int) -> str:
        r, way = self.rng, self.rng.random()
        parts = [f'<a href="/x">{t[:60]}</a>' for t in self.some(a, b)]
        return "<ul>" + "".join(f"<li>{p}</li>" for p in parts) + "</ul>" if way < 0.6 else " | ".join(parts) if way < 0.8 else "".join(f"<div>{p}</div>" for p in parts)

    def body(self, article: list[tuple[str, str]], telling: float) -> str:
        r, out = self.rng, []
        for tag, t in article:
            t = escape(t)
            tag = tag if tag in ("h1", "h2", "h3", "p", "li", "pre", "blockquote") else "p"
            if r.random() < 0.05 and len(t) > 40:
                k = t.find(" ", len(t) // 2)
                t = f'{t[:k]} <a href="/y">{t[k:k + 25]}</a>{t[k + 25:]}' if "&" not in t[k:k + 30] else t
            out.append(f"<li>{t}</li>" if tag == "li" else f"<{tag}>{t}</{tag}>" if r.random() < 0.9 or tag != "p" else f"<div>{t}</div>")
            if r.random() < 0.04:
                out.append(self.box(6, self.some(1, 1)[0], 0, telling))
        if r.random() < 0.3:
            out.insert(1, f"<h2>{self.some(1, 1)[0][:60]}</h2>")
        return "".join(out)

    def page(self) -> str:
        r = self.rng
        telling = r.choice([0.0, 0.5, 0.9, 1.0])
        article = r.choice(self.articles)
        other = lambda: r.choice(r.choice(self.articles))[1]      # noqa: E731
        main = self.box(0, self.body(article, telling), 1, telling)
        if r.random() < 0.2:            # the title stands apart
            main = f"<div>{main}</div>"
        before, after = [], []
        if r.random() < 0.6:
            before.append(self.box(2, f"<p>{self.some(1, 1)[0][:40]}</p>" + (self.links(3, 8) if r.random() < 0.5 else ""), 0, telling))
        if r.random() < 0.8:
            before.append(self.box(1, self.links(3, 12), 0, telling))
        if r.random() < 0.4:
            (before if r.random() < 0.5 else after).append(self.box(5, f"<p>{self.some(1, 1)[0]}</p><button>{self.some(1, 1)[0][:10]}</button>", 0, telling))
        for _ in range(r.choice([0, 1, 1, 2])):
            (before if r.random() < 0.5 else after).append(self.box(6, self.some(1, 2)[0], 0, telling))
        if r.random() < 0.5:
            side = self.links(3, 8) + "".join(f"<div><h3>{t[:50]}</h3><p>{escape(other()[:120])}</p></div>" for t in self.some(0, 3))
            (before if r.random() < 0.4 else after).append(self.box(4, side, 0, telling))
        if r.random() < 0.3:
            after.append(self.box(9, f"<label>{self.some(1, 1)[0][:20]}</label><input><button>{self.some(1, 1)[0][:12]}</button>", 0, telling))
        if r.random() < 0.4:            # readers' comments need telling words or names and dates
            notes = "".join(f'<div class="{r.choice(["comment", "reply", "x"])}"><p><a href="/u">{t[:14]}</a> {r.randint(1, 28)}.{r.randint(1, 12)}.2024</p><p>{escape(other()[:300])}</p></div>' for t in self.some(1, 5))
            after.append(self.box(7, f"<h3>{r.choice(['Comments', 'Replies', 'Discussion'])}</h3>" + notes, 0, max(telling, 0.8)))
        if r.random() < 0.8:
            after.append(self.box(3, "&copy; " + self.some(1, 1)[0], 0, telling))
        return "<html><head><title>t</title></head><body>" + "".join(before) + main + "".join(after) + "</body></html>"


def truth(html: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and truth of a made page; elements that hold both kinds of text say nothing."""
    page = dom.parse(html)
    marks = _marks(html)
    n = len(page.tag)
    own: list[int | None] = [None] * n
    for i in range(1, n):
        own[i] = marks[i] if i < len(marks) and marks[i] >= 0 else own[page.parent[i]]
    inside, outside = np.zeros(n), np.zeros(n)
    for u, t in zip(page.unit_node, page.unit_text):
        (inside if own[u] == 1 else outside)[u] += len(t)
    for i in range(n - 1, 0, -1):
        inside[page.parent[i]] += inside[i]
        outside[page.parent[i]] += outside[i]
    pure = (inside + outside > 0) & (np.minimum(inside, outside) <= 0.1 * (inside + outside))
    return dom.features(page)[pure], (inside > outside)[pure].astype(float)


def _marks(html: str) -> list[int]:
    """data-y of every element in page order (-1 where there is none)."""
    out = [-1]
    for m in dom._TAG.finditer(html):
        name = (m.group(2) or "").lower()
        if m.group(2) and not m.group(1) and name in dom.KINDS and name not in ("html", "body", "head", "hr"):
            a = m.group(3)
            out.append(1 if "data-y=1" in a else 0 if "data-y=0" in a else -1)
    return out


def fit(pages: DataFrame, *, sample: int = SAMPLE, made: int = MADE, seed: int = 11) -> boosting.Boosted:
    """Fit the trees on texts of a bounded sample of pages."""
    need(pages, "page_id", "html")
    n = pages.count()
    some = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
    if n > sample:
        some = some.filter(F.pmod(F.xxhash64("page_id"), F.lit(1 << 30)) < int((1 << 30) * sample / n))
    small = F.coalesce(F.octet_length("html"), F.lit(0)) <= MOST_BYTES
    rows = some.filter(small).orderBy("page_id").limit(2 * sample).collect()
    articles, lines, x, y = [], [], [], []
    for row in rows:
        page = dom.parse(row["html"] or "")
        if not page.unit_text:
            continue
        marks = marked(page)
        if 1 in marks:                  # real pages that say what they hold are training pages as well
            known = np.array([m is not None for m in marks])
            x.append(dom.features(page)[known])
            y.append(np.array([m for m in marks if m is not None], float))
        body = [(page.tag[u], t) for u, t, k in zip(page.unit_node, page.unit_text, page.unit_link)
                if marks[u] == 1 or (1 not in marks and marks[u] is None and len(t) >= 80 and k < len(t) / 3)]
        if sum(len(t) for _, t in body) >= 200:
            articles.append(body[:60])
        lines += [t[:200] for u, t in zip(page.unit_node, page.unit_text) if marks[u] == 0 and len(t) < 200]
    layouts = Layouts(articles or [[("p", "No text. " * 20)]], lines[:5000], seed)
    for _ in range(made):
        a, b = truth(layouts.page())
        x.append(a)
        y.append(b)
    return boosting.fit(np.concatenate(x), np.concatenate(y))


def extract(pages: DataFrame, model: boosting.Boosted) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    need(pages, "page_id", "url", "html")
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(block) -> dict:
        texts = main_texts(block.column("html").to_pylist(), shared.value)
        return {"page_id": block.column("page_id"), "url": block.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return by_blocks(rows, "html", run, "page_id long, url string, text string, n_chars long", 1 << 20)
