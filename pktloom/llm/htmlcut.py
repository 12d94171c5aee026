"""Main-text extraction by minimum-cut labelling of page blocks.

A page is cut into blocks of text. A logistic classifier, fitted here on generated pages, gives each block the cost of
either label, which becomes its capacity from the source (content) or to the sink (boilerplate).
Neighbouring blocks, and blocks with one parent element, are joined by smoothness edges. The minimum cut of that
graph, by maximum flow, separates content from boilerplate at the least total cost.

Each block is a node. A node whose terminal capacity exceeds all its edges is on that side of every minimum cut, so it is taken out first and
its edges become capacities of its neighbours; the flow is sought in what is left. So a long page, which is one task's
work, costs little more than reading it.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_batches

#: Smoothness of neighbours with one parent that are both links or not, and alike or not; of other neighbours; and of blocks with one parent further apart.
ALIKE, SAME_PARENT, NEIGHBOUR, SIBLING = 1.2, 0.8, 0.15, 0.4
#: Units of a capacity.
SCALE = 1000

_NAME = r"[a-zA-Z][^\s/>]*+"
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)({_NAME})((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)({_NAME})([^>]*+)>|<[!?/][^>]*+(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z0-9]+")

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose text is never shown as text.
RAW_TAGS = frozenset("script style template noscript textarea title iframe object svg math canvas audio video noembed noframes xmp".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag that closes an open element of these, up to an element of the second set.
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
CONTENT_TAGS = frozenset(["article", "main"])
FRAME_TAGS = frozenset(["nav", "aside", "footer", "form", "menu", "dialog", "button", "label", "select", "search", "fieldset"])
CONTENT_WORDS = frozenset("article articlebody content entry main post story text".split())
FRAME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline consent cookie cookies copyright disclaimer footer gdpr header legal login masthead menu menus meta modal nav navbar navigation newsletter notice notices notification pager pagination popup privacy promo promotion promoted recommended related search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags teaser toolbar tracking widget widgets".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond discussion feedback".split())

IN_CONTENT, IN_FRAME, CONTENT_CLASS, FRAME_CLASS, COMMENTS, HIDDEN = (1 << k for k in range(6))
N_FEATURES = 14


class Block:
    __slots__ = ("text", "flags", "tag", "parent", "links", "chars")

    def __init__(self, text, flags, tag, parent, links, chars):
        self.text, self.flags, self.tag, self.parent, self.links, self.chars = text, flags, tag, parent, links, chars


def _flags(tag: str, attributes: str, outer: int) -> int:
    flags = outer
    if tag in CONTENT_TAGS:
        flags |= IN_CONTENT
    elif tag in FRAME_TAGS or tag == "header" and not outer & IN_CONTENT:
        flags |= IN_FRAME
    if attributes and not attributes.isspace():
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name in ("class", "id", "role", "itemprop"):
                for word in _WORD.findall(value):
                    if word in COMMENT_WORDS:
                        flags |= COMMENTS
                    elif word in FRAME_WORDS and not (word == "header" and flags & IN_CONTENT):
                        flags |= FRAME_CLASS
                    elif word in CONTENT_WORDS:
                        flags |= CONTENT_CLASS
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                flags |= HIDDEN
    return flags


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order: character references decoded, white space as one space, none blank."""
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = [("", 0, 0)]  # tag, flags, number of the element
    parts: list[str] = []
    linked = serial = depth_a = at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                tag, flags, number = stack[-1]
                parent = stack[-2][2] if len(stack) > 1 else 0
                out.append(Block(text, flags, tag, parent if tag in ("p", "li", "td", "th", "dt", "dd", "tr", "blockquote", "pre") or tag in HEADINGS else number, min(1.0, linked / max(1, len(text))), len(text)))
            parts.clear()
        linked = 0

    def said(piece: str) -> None:
        nonlocal linked
        if piece:
            parts.append(piece)
            if depth_a:
                linked += len(piece)

    size = len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            said(page[at:])
            break
        said(page[at:lt])
        m = _TOKEN.match(page, lt)
        if not m:
            said("<")
            at = lt + 1
            continue
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, attributes, closing = tag.lower(), m[3] if m[2] else m[6], m[1] or m[4]
        if not closing and tag in RAW_TAGS:
            if tag == "title" or tag in BLOCK_TAGS:
                flush()
            if not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if tag == "a":
            depth_a = 0 if closing else 1
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in BLOCK_TAGS:
            continue
        flush()
        depth_a = 0
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag in VOID_TAGS:
            continue
        for k in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
            if stack[k][0] == "p":
                del stack[k:]
                break
            if stack[k][0] not in HEADINGS and stack[k][0] not in ("label", "button"):
                break
        if tag in CLOSES:
            closed, until = CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in closed:
                    del stack[k:]
                elif stack[k][0] in until:
                    break
        serial += 1
        stack.append((tag, _flags(tag, attributes, stack[-1][1]), serial))
    flush()
    return out


_SENTENCE_END = re.compile(r"[.!?…。！？][\"'”’)\]»]*\W*$")


def features(b: Block) -> list[float]:
    flags = b.flags
    return [
        1.0,
        float(bool(flags & IN_CONTENT)),
        float(bool(flags & CONTENT_CLASS)),
        float(bool(flags & IN_FRAME)),
        float(bool(flags & FRAME_CLASS)),
        float(bool(flags & COMMENTS)),
        b.links,
        math.log1p(b.chars) / 6,
        float(bool(_SENTENCE_END.search(b.text[-12:]))),
        float(b.tag in HEADINGS),
        float(b.tag in ("p", "blockquote", "pre")),
        float(b.tag == "li"),
        float(bool(flags & HIDDEN)),
        float(b.text[:1] == "©" or "copyright" in b.text[:40].lower()),
    ]


_MARK = "zq"


def generated_page(rnd: random.Random) -> str:
    """A page of random layout whose content blocks, and no others, start with _MARK."""

    def words(n: int, mark: bool) -> str:
        w = ["".join(rnd.choices("aeinorst", k=rnd.randint(2, 8))) for _ in range(n)]
        if mark:
            w[0] = _MARK
        return " ".join(w) + rnd.choice([".", ".", ".", "!", "", "?"])

    def links(n: int) -> str:
        return "<ul>" + "".join(f"<li><a href='/x'>{words(rnd.randint(1, 3), False)}</a></li>" for _ in range(n)) + "</ul>"

    def noise(kind: str) -> str:
        text = words(rnd.choice([3, 8, 15, 30, 60]), False)
        by_kind = {
            "ad": lambda: rnd.choice([f'<div class="ad">{text}</div>', f'<div id="sponsored"><p>{text}</p></div>', f'<p class="advert">{text}</p>']),
            "notice": lambda: rnd.choice([f'<div class="cookie-notice"><p>{text}</p></div>', f'<div class="alert notice">{text}</div>']),
            "share": lambda: f'<div class="share">{links(3)}</div>',
            "call": lambda: f"<p><a href='/x'>{words(rnd.randint(1, 4), False)}</a></p>",
            "related": lambda: f'<div class="related-posts"><h3>{words(2, False)}</h3>{links(5)}</div>',
            "form": lambda: f"<form><label>{words(2, False)}</label><input><p>{text}</p><button>{words(1, False)}</button></form>",
            "hidden": lambda: f'<div style="display:none"><p>{text}</p></div>',
            "aside": lambda: rnd.choice([f"<aside><h3>{words(2, False)}</h3><p>{text}</p>{links(3)}</aside>", f'<div class="sidebar"><p>{text}</p></div>']),
            "nav": lambda: f"<nav>{links(4)}</nav>",
            "footer": lambda: rnd.choice([f"<footer><p>{text}</p></footer>", f'<div class="footer">{text}</div>']),
            "comments": lambda: rnd.choice(['<div class="comments">', '<section id="comments">', '<ul class="replies">']) + "".join(f'<div class="comment"><p>{words(rnd.choice([4, 15, 40]), False)}</p></div>' for _ in range(3)),
        }
        return by_kind[kind]()

    content = [f"<h1>{words(rnd.randint(2, 10), True)}</h1>"]
    for _ in range(rnd.randint(1, 10)):
        n = rnd.choice([1, 2, 5, 12, 30, 70])
        content.append(rnd.choice([f"<p>{words(n, True)}</p>"] * 5 + [f"<h2>{words(min(n, 8), True)}</h2>", f"<ul><li>{words(n, True)}</li><li>{words(3, True)}</li></ul>", f"<blockquote>{words(n, True)}</blockquote>", f"<p><b>{words(n, True)}<br>", f"<pre>{words(n, True)}</pre>"]))
        if rnd.random() < 0.2:
            content.append(noise(rnd.choice(["ad", "share", "call", "call", "call", "notice", "form", "hidden", "aside", "nav", "related"])))
    if rnd.random() < 0.4:
        content.append(noise(rnd.choice(["comments", "footer", "aside"])))
    inner = "".join(content)
    body = rnd.choice([f"<article>{inner}</article>"] * 3 + [f"<main>{inner}</main>", f'<div class="post-content">{inner}</div>', f'<div id="content">{inner}</div>', f"<main><article>{inner}</article></main>", f"<div>{inner}</div>"])
    before, after = [], []
    if rnd.random() < 0.7:
        before.append(rnd.choice([f"<nav>{links(6)}</nav>", f'<div class="menu">{links(5)}</div>', f"<header><p>{words(4, False)}</p><nav>{links(4)}</nav></header>"]))
    if rnd.random() < 0.3:
        before.append(f'<div class="breadcrumbs">{words(4, False)}</div>')
    for where in (before, after):
        if rnd.random() < 0.5:
            where.append(noise(rnd.choice(["ad", "notice", "hidden", "form"])))
    if rnd.random() < 0.4:
        rnd.choice([before, after]).append(noise("aside"))
    if rnd.random() < 0.4:
        after.append(noise("comments"))
    if rnd.random() < 0.3:
        after.append(noise("related"))
    if rnd.random() < 0.8:
        after.append(rnd.choice([f"<footer>&copy; {words(6, False)}</footer>", f'<div id="footer"><p>Copyright {words(5, False)}</p>{links(3)}</div>']))
    return "<html><body>" + "".join(before) + body + "".join(after) + "</body></html>"


@lru_cache(maxsize=1)
def trained(pages: int = 400, steps: int = 400, penalty: float = 0.002) -> tuple[float, ...]:
    """The classifier's weights, by gradient descent on the blocks of generated pages; the same each time."""
    rnd = random.Random(11)
    x, y = [], []
    for _ in range(pages):
        for b in blocks(generated_page(rnd)):
            x.append(features(b))
            y.append(float(b.text.startswith(_MARK)))
    x, y = np.array(x), np.array(y)
    w = np.zeros(N_FEATURES)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        h = (x * (p * (1 - p))[:, None]).T @ x / len(y) + penalty * np.eye(N_FEATURES)
        step = np.linalg.solve(h, x.T @ (p - y) / len(y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(np.round(w, 9).tolist())


def source_side(n: int, to_source: list[int], to_sink: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """The least set of nodes on the source's side of a minimum cut, with whole capacities.

    A node that is drawn to the source by more than all its edges is in every such set, and one that is drawn to the sink by as
    much as they hold is not in the least one. Those go first, one after the other, and the others by max_flow_side.
    """
    net = [a - b for a, b in zip(to_source, to_sink)]
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for a, b, c in edges:
        if a != b:
            near[a][b] = near[a].get(b, 0) + c
            near[b][a] = near[b].get(a, 0) + c
    held = [sum(x.values()) for x in near]
    side: list[bool | None] = [None] * n
    queue = list(range(n))
    while queue:
        v = queue.pop()
        if side[v] is not None or not (net[v] > held[v] or -net[v] >= held[v]):
            continue
        side[v] = net[v] > held[v]
        for u, c in near[v].items():
            if side[u] is None:
                net[u] += c if side[v] else -c
                held[u] -= c
                queue.append(u)
    left = [v for v in range(n) if side[v] is None]
    if left:
        number = {v: k for k, v in enumerate(left)}
        among = [(number[v], number[u], c) for v in left for u, c in near[v].items() if u in number and v < u]
        for v, x in zip(left, max_flow_side(len(left), [max(0, net[v]) for v in left], [max(0, -net[v]) for v in left], among)):
            side[v] = x
    return [bool(x) for x in side]


def max_flow_side(n: int, to_source: list[int], to_sink: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """The least set of nodes on the source's side of a minimum cut, by Dinic's maximum flow."""
    s, t = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to, cap = [], []

    def arc(a: int, b: int, ab: int, ba: int) -> None:
        head[a].append(len(to))
        to.append(b)
        cap.append(ab)
        head[b].append(len(to))
        to.append(a)
        cap.append(ba)

    for v in range(n):
        both = min(to_source[v], to_sink[v])  # flows at once
        if to_source[v] > both:
            arc(s, v, to_source[v] - both, 0)
        if to_sink[v] > both:
            arc(v, t, to_sink[v] - both, 0)
    for a, b, c in edges:
        arc(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s], queue = 0, [s]
        for v in queue:
            for e in head[v]:
                if cap[e] and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[v] >= 0 for v in range(n)]
        nxt = [0] * (n + 2)
        path: list[int] = []
        v = s
        while True:
            if v == t:
                least = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= least
                    cap[e ^ 1] += least
                full = next(k for k, e in enumerate(path) if not cap[e])
                v = to[path[full] ^ 1]
                del path[full:]
            elif nxt[v] < len(head[v]):
                e = head[v][nxt[v]]
                if cap[e] and level[to[e]] == level[v] + 1:
                    path.append(e)
                    v = to[e]
                else:
                    nxt[v] += 1
            elif v == s:
                break
            else:
                level[v] = -1
                e = path.pop()
                v = to[e ^ 1]
                nxt[v] += 1


def content_blocks(found: list[Block], weights: tuple[float, ...]) -> list[Block]:
    """The blocks on the content side of the page's minimum cut."""
    if not found:
        return []
    costs = np.array([features(b) for b in found]) @ np.array(weights)
    units = (SCALE * np.abs(costs) * (1 + np.log1p([b.chars for b in found]) / 6)).astype(np.int64).tolist()
    source, sink = [u if c > 0 else 0 for u, c in zip(units, costs)], [0 if c > 0 else u for u, c in zip(units, costs)]
    edges, seen = [], {}
    for k, (a, b) in enumerate(zip(found, found[1:])):
        near = a.parent == b.parent and (a.links >= 0.5) == (b.links >= 0.5)
        alike = near and (a.flags, a.tag) == (b.flags, b.tag)
        edges.append((k, k + 1, int(SCALE * (ALIKE if alike else SAME_PARENT if near else NEIGHBOUR))))
    for k, b in enumerate(found):
        if b.parent in seen and seen[b.parent] != k - 1:
            edges.append((seen[b.parent], k, int(SCALE * SIBLING)))
        seen[b.parent] = k
    side = source_side(len(found), source, sink, edges)
    return [b for b, v in zip(found, side) if v]


def main_text(page: str | None, weights: tuple[float, ...] | None = None) -> str:
    """The content blocks of a page joined by line ends; empty for a page without."""
    return "\n".join(b.text for b in content_blocks(blocks(page or ""), weights or trained()))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for each row: the main text of the whole html, and its code points.

    A null page is empty, and a page without content has an empty text. Broken markup is read as far as it goes; repeated rows give
    repeated rows; other columns are not read; an empty table gives an empty one. Nothing is shuffled.
    """
    text_batches(pages.sparkSession)
    weights = trained()

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [main_text(p, weights) for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(scan, "page_id bigint, url string, text string, n_chars bigint")
