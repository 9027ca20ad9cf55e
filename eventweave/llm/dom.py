"""Block trees of HTML pages: elements that lay out blocks, the text between them, and what
describes an element. Lenient like a browser: unclosed and misnested tags are accepted.

Raw text (scripts, styles, titles and the like) is skipped to its end tag. Other elements
that are no page text are left out with their subtree once their own end tag is met; without
it (also where an element around them ends first, or HTML breaks out of an svg) nothing is
left out. Text of formulas stays."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import numpy as np

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|itemprop|style|aria-label)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Elements whose content is raw text and no page text.
_RAW = frozenset("script style title textarea iframe".split())
_END = {t: re.compile(rf"</{t}[\s>]", re.I) for t in _RAW}
#: Elements that are left out with their subtree.
_LEFT_OUT = frozenset("template svg noscript select object video audio canvas".split())
#: Elements of an svg that hold HTML, and start tags that end an svg outside of them.
_HOLDS_HTML = frozenset("foreignobject desc title".split())
_BREAKS_OUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong "
                        "strike sub sup table tt u ul var article main section header footer nav aside".split())
_UNQUOTED = re.compile(r"=\s*[^\s\"'=<>`]+\Z")
#: Elements that lay out blocks; all others stand inside a line.
KINDS = {"article": 0, "main": 0, "nav": 1, "menu": 1, "header": 2, "footer": 3, "aside": 4, "section": 5, "div": 6, "p": 7, "blockquote": 7, "pre": 7, "dd": 7, "dt": 7,
         "h1": 8, "h2": 8, "h3": 8, "h4": 8, "h5": 8, "h6": 8, "ul": 9, "ol": 9, "dl": 9, "li": 10, "table": 11, "tbody": 11, "thead": 11, "tfoot": 11, "tr": 11, "td": 11, "th": 11,
         "caption": 11, "form": 12, "fieldset": 12, "button": 12, "label": 12, "legend": 12, "figure": 13, "figcaption": 13, "dialog": 14, "address": 14, "details": 14, "summary": 14,
         "body": 15, "html": 15, "head": 15, "center": 6, "hr": 14, "hgroup": 2, "search": 12}
N_KINDS = 16
_CLOSES = {"p": {"p"}, "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "button": {"button"}}
_STOPS = {"p": frozenset(KINDS) - {"p"}, "li": frozenset({"ul", "ol", "menu"}), "dd": frozenset({"dl"}), "dt": frozenset({"dl"}),
          "td": frozenset({"table", "tr"}), "th": frozenset({"table", "tr"}), "tr": frozenset({"table"}), "button": frozenset(KINDS) - {"button"}}
#: Words of class, id and role that say what an element is for (fixed values).
ROLES = (
    "article content contents post entry story main body text prose maincontent articlebody",
    "nav navigation navbar menu menubar breadcrumb breadcrumbs pagination pager toc tabs",
    "header masthead topbar branding logo sitename banner",
    "footer foot bottom copyright colophon legal contentinfo",
    "sidebar side aside widget related recommended recommend more teaser teasers trending popular rail complementary",
    "notice cookie cookies consent gdpr popup modal overlay alert newsflash paywall message toast",
    "ad ads advert advertisement adsense sponsor sponsored promo promotion promoted outbrain taboola",
    "comment comments reply replies respond discussion disqus thread reader",
    "share sharing social follow like tags tag meta byline author date",
    "form login signup subscribe newsletter search register contact hidden",
)
_ROLE = {w: i for i, words in enumerate(ROLES) for w in words.split()}


@dataclass
class Page:
    """Elements in page order (0 is the page) and text units (element, text, characters in links)."""
    tag: list[str] = field(default_factory=lambda: ["html"])
    parent: list[int] = field(default_factory=lambda: [-1])
    roles: list[int] = field(default_factory=lambda: [0])
    unit_node: list[int] = field(default_factory=list)
    unit_text: list[str] = field(default_factory=list)
    unit_link: list[int] = field(default_factory=list)


def roles_of(attributes: str) -> int:
    out = 0
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "hidden":
            out |= 1 << 9
        elif name == "style":
            out |= (1 << 9) if re.search(r"display\s*:\s*none", value, re.I) else 0
        else:
            for w in _TOKEN.findall(value):
                i = _ROLE.get(w.lower())
                if i is not None:
                    out |= 1 << i
    return out


def closes_itself(attributes: str) -> bool:
    """Whether a tag ends with a slash of its own, not with that of an unquoted value."""
    return attributes.endswith("/") and not _UNQUOTED.search(attributes)


def parse(html: str) -> Page:
    page = Page()
    opened: list[tuple] = []    # elements to leave out, with what there was before them
    count = dict.fromkeys(_LEFT_OUT | _HOLDS_HTML, 0)
    stack = [0]
    text: list[str] = []
    link, in_link, pos, n = 0, False, 0, len(html)

    def flush() -> None:
        nonlocal link, text
        if text:
            t = " ".join(unescape("".join(text)).split())
            if t:
                page.unit_node.append(stack[-1])
                page.unit_text.append(t)
                page.unit_link.append(min(link, len(t)))
            text = []           # a new list: the old one may have to be restored
        link = 0

    def forget() -> None:
        """The innermost opened element is no longer left out."""
        count[opened.pop()[0]] -= 1

    def cut(depth: int) -> None:
        del stack[depth:]
        while opened and opened[-1][1] > depth:
            forget()

    def leave_out(name: str) -> None:
        opened.append((name, len(stack), text, len(text), link, in_link, len(page.unit_node), len(page.tag), page.roles[0]))
        count[name] += 1

    while pos < n:
        m = _TAG.search(html, pos)
        stop = m.start() if m else n
        if stop > pos:
            text.append(html[pos:stop])
            if in_link:
                link += stop - pos
        if not m:
            break
        pos = m.end()
        if m.group(2) is None:          # a comment or declaration
            continue
        name = m.group(2).lower()
        if m.group(1):
            if count.get(name):
                while opened[-1][0] != name:
                    forget()
                _, depth, text, size, link, in_link, units, tags, role = opened[-1]
                forget()
                for own, keep in ((stack, depth), (text, size), (page.unit_node, units), (page.unit_text, units), (page.unit_link, units),
                                  (page.tag, tags), (page.parent, tags), (page.roles, tags)):
                    del own[keep:]
                page.roles[0] = role
            elif name == "a":
                in_link = False
            elif name in KINDS:
                for k in range(len(stack) - 1, 0, -1):
                    if page.tag[stack[k]] == name:
                        flush()
                        in_link = False
                        cut(k)
                        break
                else:
                    flush()
            continue
        while opened and opened[-1][0] == "svg" and name in _BREAKS_OUT:
            forget()
        in_svg = bool(opened) and opened[-1][0] == "svg"
        if (in_svg or name == "svg") and closes_itself(m.group(3)):
            continue
        if name in _LEFT_OUT or in_svg and name in _HOLDS_HTML:
            leave_out(name)
            continue
        if in_svg and name not in KINDS:        # no raw text in an svg
            continue
        if name in _RAW:
            end = _END[name].search(html, pos)
            if end:
                pos = html.find(">", end.start())
                pos = n if pos < 0 else pos + 1
            else:
                pos = n
            continue
        if name == "a":
            in_link = True
        elif name in ("br", "wbr", "img", "input"):
            text.append(" " if name != "wbr" else "")
        elif name in ("html", "body", "head"):
            flush()
            page.roles[0] |= roles_of(m.group(3)) & 1 if m.group(3) else 0
        elif name in KINDS:
            flush()
            in_link = False
            closes = _CLOSES.get(name)
            if closes:
                stops = _STOPS[name]
            elif page.tag[stack[-1]] == "p":        # a block ends an open paragraph
                closes, stops = {"p"}, frozenset()
            for k in range(len(stack) - 1, opened[-1][1] - 1 if opened else 0, -1) if closes else ():
                t = page.tag[stack[k]]
                if t in closes:
                    cut(k)
                    if name != "tr":
                        break
                elif t in stops:
                    break
            if name != "hr":
                page.tag.append(name)
                page.parent.append(stack[-1])
                page.roles.append(roles_of(m.group(3)) if m.group(3) else 0)
                stack.append(len(page.tag) - 1)
    flush()
    return page


N_FEATURES = 2 * N_KINDS + 3 * len(ROLES) + 18
_POINT = re.compile(r"[.!?;:,。！？、，]")


def features(page: Page) -> np.ndarray:
    """One row an element: kind, roles (own, above, below), text and link density of the subtree, depth, siblings, place."""
    n = len(page.tag)
    parent = page.parent
    chars, words, links, points, units, kids, deep, below = ([0.0] * n for _ in range(8))
    first, paragraphs, longest = [1e18] * n, [0.0] * n, [0.0] * n
    total = 0.0
    for node, text, link in zip(page.unit_node, page.unit_text, page.unit_link):
        size = len(text)
        first[node] = min(first[node], total)
        total += size
        chars[node] += size
        words[node] += text.count(" ") + 1
        links[node] += link
        points[node] += len(_POINT.findall(text))
        units[node] += 1
        longest[node] = max(longest[node], size)
        paragraphs[node] += size >= 80 and link < size / 3
    own = list(chars)
    down = list(page.roles)
    for i in range(n - 1, 0, -1):
        p = parent[i]
        chars[p] += chars[i]
        words[p] += words[i]
        links[p] += links[i]
        points[p] += points[i]
        units[p] += units[i]
        paragraphs[p] += paragraphs[i]
        kids[p] += 1
        below[p] += below[i] + 1
        first[p] = min(first[p], first[i])
        longest[p] = max(longest[p], longest[i])
        down[p] |= down[i]
    up = [0] * n
    seen: dict[int, int] = {}
    index = [0] * n
    for i in range(1, n):
        p = parent[i]
        deep[i] = deep[p] + 1
        up[i] = up[p] | page.roles[p]
        index[i] = seen.get(p, 0)
        seen[p] = index[i] + 1
    kind = np.array([KINDS.get(t, 14) for t in page.tag])
    par = np.maximum(np.array(parent), 0)
    c, w, lk, pt, u, k = (np.array(v) for v in (chars, words, links, points, units, kids))
    x = np.zeros((n, N_FEATURES), np.float32)
    x[np.arange(n), kind] = 1
    x[np.arange(n), N_KINDS + kind[par]] = 1
    bit = np.arange(len(ROLES))
    at = 2 * N_KINDS
    for r in (page.roles, up, down):
        x[:, at:at + len(ROLES)] = (np.array(r)[:, None] >> bit) & 1
        at += len(ROLES)
    f = np.minimum(np.array(first), total)
    pc = c[par]
    x[:, at:] = np.stack([
        np.log1p(c), c / max(total, 1), lk / np.maximum(c, 1), np.log1p(w), w / np.maximum(u, 1), pt / np.maximum(w, 1), np.log1p(u), np.log1p(k), np.array(deep),
        f / max(total, 1), (f + c) / max(total, 1), np.array(index) / np.maximum(k[par], 1), np.log1p(k[par]), c / np.maximum(pc, 1), np.array(own) / np.maximum(c, 1),
        np.log1p(np.array(paragraphs)), np.array(longest) / max(max(longest), 1), np.log1p(np.array(below))], axis=1)
    return x
