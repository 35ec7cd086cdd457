"""Main text of web pages as the maximum-scoring stretch of words and tags.

A page is a sequence of text pieces and tags. Words score positive, tags negative,
and one linear scan finds the contiguous stretch with the highest sum. Weights
come from labelled pages, those that mark their main part with an ``article`` or
``main`` element:

* a tag costs the more, the more of its uses lie outside the marked part;
* words below an element that is known or has been learned to hold other things
  (by tag, class or id) are left out. Passing over such a run costs its words and
  tags, ``GAP_COST`` at most, so stray words behind a menu are not picked up, while
  a long aside does not cut an article in two.

Names can mislead. An element that holds more than half of a page's words and the body, a
main element or an ``h1`` is not left out by its names when what would stay outside has
less than a tenth of its words (a form around the page, a body of class ``search``);
names of reader comments are always believed. Where more than half of the words lie in main elements and all of
these would be left out by their own names, those names are passed over.

``PRIOR_OUT`` and ``PRIOR_IN`` stand in for labels no page has given yet. Counts
come from all labelled pages; the model keeps every tag and every class and id name
that decides anything, that is whose weight is ``VETO`` or below or replaces a prior.

Only the body counts; comments, scripts, styles and other raw elements hold no
text. Character references are decoded, white space inside a block becomes one
space, blocks are joined by one space. Null or empty html, and pages whose words
all score negative, give an empty text. Ties go to the earlier, longer stretch.
Unclosed elements end with their parent. An unclosed script, style, title, textarea,
iframe, noscript or template takes the rest of the page; of other unclosed raw elements
(``svg``, ``video``, ``object`` ...) only the tag is passed over. Every input row gives one row, repeated rows included; other columns are not
read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.llm.text import bounded_batches

VETO = -1.2
#: Highest cost of a run of pieces that are left out.
GAP_COST = 20.0

# Element names of the HTML standard and customary class names.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object select canvas video audio head".split())
#: Raw elements whose text runs to the end of the page when they are not closed.
SWALLOWING = frozenset("script style noscript template iframe textarea title".split())
MAIN_TAGS = frozenset(("article", "main"))
HEADS = frozenset(("html", "body", "h1", *MAIN_TAGS))
PRIOR_OUT = frozenset(
    "nav footer aside form button dialog menu menuitem fieldset dl.meta"
    " .ad .ads .advert .adverts .advertisement .advertising .banner .sponsor .sponsored .promo .promotion"
    " .nav .navbar .navigation .menu .menubar .breadcrumb .breadcrumbs .pagination .pager .toc"
    " .sidebar .aside .widget .related .recommended .trending .popular .footer .site-footer .page-footer"
    " .site-header .page-header .masthead .topbar .comment .comments .comment-list .respond .replies .disqus"
    " .cookie .cookies .cookie-notice .cookie-banner .consent .gdpr .notice .alert .popup .modal .overlay"
    " .newsletter .subscribe .subscription .signup .login .search .share .sharing .social .tags .skip-link .hidden".split()
)
COMMENTS = frozenset(".comment .comments .comment-list .respond .replies .disqus".split())
PRIOR_IN = frozenset(".article .article-body .article-content .post .post-body .post-content .entry-content .story .content .main".split())

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


@dataclass
class Weights:
    """What labelled pages have taught: weight of element keys and cost of tags."""

    keys: dict[str, float] = field(default_factory=dict)
    costs: dict[str, float] = field(default_factory=dict)

    def key(self, name: str) -> float:
        known = self.keys.get(name)
        if known is None:
            known = -log(41) if name in PRIOR_OUT else log(41) if name in PRIOR_IN else 0.0
        return known

    def cost(self, tag: str) -> float:
        return self.costs.get(tag, 0.1 if tag in INLINE else 0.3)


def weighted(counts: dict[tuple[str, str], tuple[int, int]]) -> Weights:
    """Weights from (kind, name) -> (inside, outside the marked part)."""
    out = Weights()
    for (kind, name), (inside, outside) in counts.items():
        if kind == "key":
            inside += 40 * (name in PRIOR_IN)
            outside += 40 * (name in PRIOR_OUT)
            out.keys[name] = log((inside + 1) / (outside + 1))
        else:
            out.costs[name] = min(3.0, max(0.05, 0.4 + log((outside + 1) / (inside + 1)) / 2))
    return out


def element_keys(tag: str, attributes: str) -> list[str]:
    keys = [tag] if tag in PRIOR_OUT else []
    if attributes:
        for match in _NAMES.finditer(attributes):
            for name in (match[1] or match[2] or match[3] or "").lower().replace("_", "-").split():
                keys.append("." + name)
    return keys


class Element:
    """An open element with what holds below it: whether in a main element, and the keys of all elements around."""

    __slots__ = ("tag", "keys", "parent", "marked", "around", "place", "trusted", "words", "kept", "heads")

    def __init__(self, tag: str, keys: list[str], parent: Element | None):
        self.tag, self.keys, self.parent = tag, keys, parent
        self.marked = tag in MAIN_TAGS or parent is not None and parent.marked
        above = parent.around if parent else frozenset()
        self.around = above if above.issuperset(keys) else above.union(keys)
        self.place: tuple[bool, float] | None = None
        self.trusted = False  # names of its own do not count
        self.words = self.kept = 0
        self.heads = tag in HEADS  # is, or holds, the body, a main element or the page's heading


def pieces(page: str, made: list[Element] | None = None) -> Iterator[tuple[str, str, Element | None]]:
    """("text", raw text, innermost open element) and ("tag", name, innermost open element) in page order.

    Raw elements, comments and the head give nothing. ``made`` collects the elements, outer ones first.
    """
    stack: list[Element] = []
    opened: Counter = Counter()
    unclosed: set[str] = set()
    view: Element | None = None
    at, n = 0, len(page)
    while at < n:
        found = _PIECE.search(page, at)
        end = found.start() if found else n
        if end > at:
            yield "text", page[at:end], view
        if not found:
            return
        at = found.end()
        closing, name, rest = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not name:
            continue
        tag = name.lower()
        if tag in RAW and not closing:
            if not rest.endswith("/"):
                ended = None
                if tag not in unclosed:
                    ended = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                if ended:
                    at = ended.end()
                elif tag == "head":
                    body = re.compile(r"<body\b", re.I).search(page, at)
                    at = body.start() if body else at
                elif tag in SWALLOWING:
                    return
                if not ended:
                    unclosed.add(tag)
            continue
        yield "tag", tag, view
        if closing:
            left = opened[tag] - 1
            while left >= 0 and opened[tag] > left:
                opened[stack.pop().tag] -= 1
        elif tag not in VOID and not rest.endswith("/"):
            if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
                for k in range(len(stack) - 1, max(len(stack) - 4, -1), -1):
                    if stack[k].tag == tag:
                        opened.subtract(x.tag for x in stack[k:])
                        del stack[k:]
                        break
                    if stack[k].tag not in INLINE:
                        break
            stack.append(Element(tag, element_keys(tag, rest), stack[-1] if stack else None))
            opened[tag] += 1
            if made is not None:
                made.append(stack[-1])
        view = stack[-1] if stack else None


def shut_out(element: Element, weights: Weights) -> bool:
    """Whether the element's own names say that it holds other things."""
    if element.trusted:
        return False
    if element.tag == "header" and not element.marked:
        return True
    return any(weights.key(key) <= VETO for key in element.keys)


def trust(made: list[Element], texts: list[tuple[int, Element | None]], weights: Weights) -> None:
    """Mark the elements whose names are passed over, from the words of each element."""
    for words, view in texts:
        if view is not None:
            view.words += words
            view.kept += words
    total = sum(words for words, _ in texts)
    outside = sum(words for words, view in texts if view is None)
    out = [shut_out(element, weights) for element in made]
    for element, other in zip(reversed(made), reversed(out)):
        above = element.parent
        if above is not None:
            above.words += element.words
            above.kept += 0 if other else element.kept
            above.heads = above.heads or element.heads
        elif not other:
            outside += element.kept
    for element, other in zip(made, out):
        if other and element.words * 2 > total:
            if outside * 10 >= element.words or not element.heads or not COMMENTS.isdisjoint(element.keys):
                return
            element.trusted = True
            outside += element.kept
    outer = [e for e in made if e.tag in MAIN_TAGS and not (e.parent is not None and e.parent.marked)]
    if sum(e.words for e in outer) * 2 > total and all(shut_out(e, weights) for e in outer if e.words):
        for element in outer:
            element.trusted = COMMENTS.isdisjoint(element.keys)


def standing(view: Element | None, weights: Weights) -> tuple[bool, bool]:
    """Whether a place is inside a main element, and whether below an element that holds other things.

    Elements remember it, so one page goes with one ``weights``.
    """
    fresh = []
    while view is not None and view.place is None:
        fresh.append(view)
        view = view.parent
    main, other = view.place if view is not None else (False, False)
    for element in reversed(fresh):
        main = element.marked
        other = other or shut_out(element, weights)
        element.place = main, other
    return main, other


def scored_pieces(page: str, weights: Weights) -> list[tuple[float, str | None, bool]]:
    """(score, text to keep, breaks the block) of every piece of a page.

    Where most text lies in main elements, words outside them are left out.
    What is left out inside a main element costs nothing; neighbouring pieces left out
    elsewhere are one piece, which costs ``GAP_COST`` at most.
    """
    made: list[Element] = []
    found = [(kind, value, view, len(value.split()) if kind == "text" else 0) for kind, value, view in pieces(page, made)]
    trust(made, [(words, view) for kind, _, view, words in found if kind == "text"], weights)
    kept = {True: 0, False: 0}
    for kind, _, view, words in found:
        if words:
            main, other = standing(view, weights)
            if not other:
                kept[main] += words
    only_main = kept[True] > kept[False]
    out: list[tuple[float, str | None, bool]] = []
    gap = None
    for kind, value, view, words in found:
        main, other = standing(view, weights)
        if main and other:
            out.append((0.0, None, kind == "text" or value not in INLINE))
        elif other or only_main and not main:
            gap = (gap or 0.0) + (weights.cost(value) if kind == "tag" else words)
            continue
        elif kind == "tag":
            out.append((-0.02 if main else -weights.cost(value), None, value not in INLINE))
        else:
            out.append((float(words), html.unescape(value), False))
        if gap is not None:
            out.insert(-1, (-min(gap, GAP_COST), None, True))
            gap = None
    return out


def main_text(page: str | None, weights: Weights) -> str:
    if not page:
        return ""
    scored = scored_pieces(page, weights)
    best, best_span, total, start = 0.0, (0, 0), 0.0, 0
    for k, (score, _, _) in enumerate(scored):
        if total <= 0:
            total, start = 0.0, k
        total += score
        if total > best:
            best, best_span = total, (start, k + 1)
    parts: list[str] = []
    for _, text, breaks in scored[slice(*best_span)]:
        if text is not None:
            parts.append(text)
        elif breaks:
            parts.append(" ")
    return " ".join("".join(parts).split())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    inside: Counter = Counter()
    outside: Counter = Counter()
    for batch in batches:
        for page in batch.column("html"):
            text = page.as_py()
            if not text or not re.search(r"<(?:article|main)\b", text, re.I):
                continue
            for kind, value, view in pieces(text):
                counts = inside if view and view.marked else outside
                if kind == "tag":
                    counts["tag", value] += 1
                else:
                    words = len(value.split())
                    if words and view:
                        for key in view.around:
                            counts["key", key] += words
    names = list(inside.keys() | outside.keys())
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([k for k, _ in names], pa.string()),
            pa.array([n for _, n in names], pa.string()),
            pa.array([inside[x] for x in names], pa.int64()),
            pa.array([outside[x] for x in names], pa.int64()),
        ],
        names=["kind", "name", "inside", "outside"],
    )


def fit_weights(pages: DataFrame) -> Weights:
    counted = pages.select("html").mapInArrow(_count, "kind string, name string, inside long, outside long")
    decides = F.log((F.col("inside") + 1) / (F.col("outside") + 1)) <= VETO + 1e-9
    rows = (
        counted.groupBy("kind", "name")
        .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
        .where((F.col("kind") == "tag") | decides | F.col("name").isin(*sorted(PRIOR_OUT | PRIOR_IN)))
        .collect()
    )
    return weighted({(r.kind, r.name): (r.inside, r.outside) for r in rows})


def _extract(weights: Weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), weights) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return run


def extract_pages(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    bounded_batches(pages.sparkSession, rows=500)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    model = weights or fit_weights(rows)
    return rows.mapInArrow(_extract(model), "page_id long, url string, text string, n_chars long")
