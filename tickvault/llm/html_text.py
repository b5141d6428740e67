"""Main-text extraction by tag-path ratios.

A page is cut into blocks; each block has the root-to-leaf path of its tags (with the class or id
words of containers). Per path, the text length and the punctuation of all its blocks are divided
by the number of its tags; both ratios are smoothed over neighbouring blocks in page order and fused
by multiplication (text share x punctuation share; inside ``article`` and ``main`` it counts more).
Paths whose fused ratio passes a threshold made of the page's own spread are content paths; they
decide what is returned:

* every ``article`` or ``main`` that holds a content path, whole (headings, lists and short paragraphs
  included), and the blocks of content paths beside them, such as a lead in a ``div`` of its own;
* on a page without such elements, the innermost element that holds all content paths, whole.

Elements that are never article text (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles, reader comments, by tag, role, or a class or id made of words for them) have no weight
and are left out, inside articles too. A class name that has other words as well (``social-history``; not with
the words for adverts and comments) is only a doubt: such an element is left out unless its paths are content paths.

Null or empty html, and pages without text: empty text. Broken html (unclosed tags, cut pages,
stray ends) is read as browsers do for blocks: a new block closes an open paragraph. Every page is
handled alone and whole; repeated rows give repeated results.
"""
from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickvault.llm.common import ship

ship(__name__)

BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
 form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th
 thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object canvas audio video".split())
#: Elements whose text is never part of the article.
OUTSIDE = frozenset("head nav footer aside form button select dialog menu header label input".split()) | RAW
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar toolbar form".split())
OUTSIDE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted sidebar
 menu nav navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice notices notification alert popup modal overlay
 newsletter subscribe subscription social share sharing related recommended recommendations comment comments discussion disqus reply
 replies footer masthead toolbar widget login signup search pagination pager copyright disclaimer hidden""".split())
CLOSES_P = BLOCKS - {"option", "optgroup", "legend", "summary", "td", "th", "tr", "tbody", "thead", "tfoot", "title"}
_SAME = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
         "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^<>]*+)(?:>|(?=<)|\Z)|<[!?][^>]*+(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_WORD = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PUNCTUATION = re.compile(r"[.,;:!?。、，！？…]")
#: Words that also rule out an ``article`` element (comments and teasers are often marked up as one).
NOT_THE_ARTICLE = frozenset("ad ads advert comment comments reply replies related recommended promo promoted sponsored".split())
#: Words that say nothing about an element, beside one of the above in a class name.
PLAIN_WORDS = frozenset("""area article bar blog block body bottom box btn button card cell col column container content div el element en
 entry facebook fb field form frame full global google group head header holder icon id inner item items js large latest layout left line link
 links list main mini mobile module more news on outer page panel part popular post reader readers right row section side site slot small span
 story tab tag text thread title top twitter ui unit user users view web wide wrap wrapper zone""".split())
SIGMA, THRESHOLD, BOOST = 0.7, 0.6, 1.5
#: Elements nested deeper than this get no node of their own (as in browsers); their text stays.
MAX_DEPTH = 512


class _Element:
    __slots__ = ("tag", "parent", "outside", "doubt", "path", "boost", "within", "depth", "held")

    def __init__(self, tag: str, parent: "_Element | None", attrs: str) -> None:
        self.tag, self.parent, self.held = tag, parent, None
        self.depth = parent.depth + 1 if parent else 0
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)} if attrs.strip() else {}
        names = [_WORD.findall(_CAMEL.sub(" ", n).lower()) for n in (found.get("class", "") + " " + found.get("id", "")).split()]
        words = [w for n in names for w in n]
        style = found.get("style", "").replace(" ", "").lower()
        self.boost = tag in ("article", "main") or found.get("role") == "main" or found.get("itemprop") == "articleBody"
        inside = parent is not None and parent.within
        self.within = self.boost or inside
        out = (tag in OUTSIDE and not (tag == "header" and inside)) or found.get("role", "").lower() in OUTSIDE_ROLES
        ruled_out = frozenset() if tag in ("html", "body", "main") else NOT_THE_ARTICLE if tag == "article" else OUTSIDE_WORDS
        told = [n for n in names if not ruled_out.isdisjoint(n)]
        out = out or any(not NOT_THE_ARTICLE.isdisjoint(n) or all(w in ruled_out or w in PLAIN_WORDS or w.isdigit() for w in n) for n in told)
        self.doubt = (bool(told) and not out) or (parent is not None and parent.doubt)
        out = out or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style
        self.outside = out or (parent is not None and parent.outside)
        name = tag + ("." + "-".join(words[:2]) if words and tag not in ("p", "span", "a", "b", "i", "em", "strong") else "")
        self.path = hash((parent.path if parent else 0, name))     # identity of the tag path within this page


def _blocks(html: str) -> list[tuple[_Element, str]]:
    """(element, raw text) of the page's blocks in order."""
    root = _Element("#", None, "")
    stack, out, buffer, owner = [root], [], [], root

    def flush() -> None:
        nonlocal buffer
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            if text:
                out.append((owner, text))
            buffer = []

    def pop_to(i: int) -> None:
        nonlocal buffer, owner
        for e in reversed(stack[i:]):
            if e.held is not None:                               # an inline element left out: its block goes on
                flush()
                buffer, owner = e.held
        del stack[i:]

    at, end, raw = 0, len(html), None
    for m in _TOKEN.finditer(html):
        if m.start() < at:
            continue
        if m.start() > at:
            if not buffer:
                owner = stack[-1]
            buffer.append(html[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attrs = m[1] or m[4], m[3] or m[6] or ""
        if tag in BLOCKS:
            flush()
        elif tag == "br":
            buffer.append(" ")
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    if tag not in BLOCKS and any(e.tag in BLOCKS for e in stack[i + 1:]):
                        break                                   # a stray inline end can't close a block
                    if stack[i].outside and stack[i].held is None:
                        flush()
                    pop_to(i)
                    break
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    pop_to(i)
                    break
                if stack[i].tag in BLOCKS:
                    break
        if tag in _SAME:
            same, bounds = _SAME[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in bounds:
                    break
                if stack[i].tag in same.split():
                    pop_to(i)
        if tag in VOID:
            continue
        element = _Element(tag, stack[-1], attrs)
        if element.outside != stack[-1].outside and tag not in RAW:
            if tag in BLOCKS or not buffer or len(stack) >= MAX_DEPTH:
                flush()
            else:
                element.held, buffer = (buffer, owner), []
        if tag in RAW and not attrs.rstrip().endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*+>", re.I).search(html, at)
            at = close.end() if close else end
            continue
        if (not attrs.rstrip().endswith("/") or tag in BLOCKS) and len(stack) < MAX_DEPTH:
            stack.append(element)
    if at < end:
        if not buffer:
            owner = stack[-1]
        buffer.append(html[at:])
    flush()
    pop_to(1)
    flush()
    return out


def _smooth(values: np.ndarray) -> np.ndarray:
    kernel = np.exp(-0.5 * (np.arange(-2, 3) / SIGMA) ** 2)
    return np.convolve(np.pad(values, 2, mode="edge"), kernel / kernel.sum(), mode="valid")


def main_text(html: str | None) -> str:
    """The article's text, its blocks joined by newlines; empty if there is none."""
    blocks = _blocks(html or "")
    kept = [b for b in blocks if not b[0].outside]
    if not kept:
        return ""
    # ratios per tag path
    chars, marks, tags = {}, {}, {}
    for e, text in kept:
        chars[e.path] = chars.get(e.path, 0) + len(text)
        marks[e.path] = marks.get(e.path, 0) + len(_PUNCTUATION.findall(text))
        tags[e.path] = tags.get(e.path, 0) + 1
    text_ratio = _smooth(np.array([chars[e.path] / tags[e.path] for e, _ in kept]))
    mark_ratio = _smooth(np.array([marks[e.path] / tags[e.path] for e, _ in kept]))
    fused = (text_ratio / max(text_ratio.max(), 1e-9)) * ((mark_ratio + 0.1) / (mark_ratio.max() + 0.1))
    fused = fused * np.array([BOOST if e.within else 1.0 for e, _ in kept])
    by_path: dict[int, list[float]] = {}
    for (e, _), f in zip(kept, fused):
        by_path.setdefault(e.path, []).append(f)
    mean = {p: sum(v) / len(v) for p, v in by_path.items()}
    cut = THRESHOLD * float(np.std(list(mean.values()))) if len(mean) > 1 else 0.0
    content = {p for p, m in mean.items() if m >= cut}
    kept = [b for b in kept if not b[0].doubt or b[0].path in content]
    chosen = [e for e, _ in kept if e.path in content]
    articles = {id(a) for e in chosen for a in [_article(e)] if a is not None}
    if articles:
        return "\n".join(text for e, text in kept if e.path in content or id(_article(e)) in articles)
    region = _common(chosen)
    return "\n".join(text for e, text in kept if e is region or region in _ancestors(e))


def _article(e: _Element) -> "_Element | None":
    """The outermost article or main that holds an element."""
    return next((a for a in reversed([e, *_ancestors(e)]) if a.boost), None)


def _common(elements: list[_Element]) -> "_Element | None":
    """The innermost element that holds all of these (a block itself if there is one only: its container)."""
    shared = [e for e in reversed([elements[0], *_ancestors(elements[0])])]
    for e in elements[1:]:
        chain = list(reversed([e, *_ancestors(e)]))
        n = next((i for i, (x, y) in enumerate(zip(shared, chain)) if x is not y), min(len(shared), len(chain)))
        shared = shared[:n]
    inner = ("p", "li", "td", "h1", "h2", "h3", "h4", "h5", "h6", "span", "a", "b", "i", "em", "strong")
    return next((e for e in reversed(shared) if e.tag not in inner), shared[0])


def _ancestors(e: _Element) -> list[_Element]:
    out, up = [], e.parent
    while up is not None:
        out.append(up)
        up = up.parent
    return out


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without ``html``, with ``text`` and ``n_chars`` (replacing columns of these names)."""
    names = [c for c in pages.columns if c not in ("text", "n_chars", html)]
    schema = T.StructType([pages.schema[c] for c in names] + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(h) for h in batch.column(html).to_pylist()]
            new = [pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + new, names=[*names, "text", "n_chars"])

    return pages.select(*[F.col(f"`{c}`") for c in [*names, html]]).mapInArrow(run, schema)
