"""Main text of web pages by tag-path ratios.

Each page is read into leaf text blocks with their root-to-leaf path of block tags. Text length and punctuation are aggregated per path
(mean per block), laid along the page in block order, smoothed with a Gaussian window, and fused into one value per block; paths whose
fused value passes a share of the page's best are content, whatever element they stand in. The deepest container that holds nearly all
content is the article; its blocks are the text, short ones and headings included, but for boxes in it whose own value is low. Menus,
headers, footers, asides and hidden parts never count: they are told by their tag, role or style. Form tags and words of a class or id
only hint at notices, adverts, sidebars and comments; ``suspected`` weighs the hints.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg object select button".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img
    math mrow mi mn mo ms mtext msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mspace semantics annotation""".split())
CLOSES_P = frozenset("address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table", "tbody", "thead", "tfoot")),
            "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
NOISE_TAGS = frozenset("head nav footer aside dialog menu".split())
HINT_TAGS = frozenset("form fieldset".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar alertdialog".split())
NOISE_WORDS = frozenset("""ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies discussion disqus
    footer gdpr masthead menu modal nav navbar navigation newsletter notice notices outbrain overlay pager pagination popup promo promoted promotion recommended
    related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe subscription taboola teaser toolbar topbar widget widgets""".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*+>|<\?[^>]*+>|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][A-Za-z0-9:-]*+)([^>]*+)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
SMOOTH = 1.0          # width of the Gaussian window in blocks
CONTENT_SHARE = 0.1   # of the best fused value on the page
PROSE = 25.0          # least ratio of a hinted element that can be the article
ALONE = 10            # times the rest of the page's text that a single hinted block must exceed
HOLDS = 0.9           # share of the content's text that the article's element holds
ONLY_SHARE = 0.1      # of the page's text that the only main or article element must hold to be where the article lies
LINKED = 0.8          # linked share of a block's text from which it is a link
CONTAINERS = frozenset("html body main article section div center table tbody tr td form fieldset".split())


class Block(NamedTuple):
    path: tuple[str, ...]
    ids: tuple[int, ...]  # of the elements along the path
    noise: bool
    suspects: tuple[int, ...]  # ids of the elements at or above that a hint calls noise
    text: str
    marks: int            # punctuation
    linked: float         # share of the text that lies in links


def _noise(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is noise by its tag, role or style, and whether its tag or a word of its class or id hints at it."""
    if tag in NOISE_TAGS or (tag == "header" and not in_article):
        return True, False
    hint = tag in HINT_TAGS
    if "=" not in attributes and "hidden" not in attributes:
        return False, hint
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, False
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, False
        if name == "role" and value in NOISE_ROLES:
            return True, False
        if name == "role" and value == "form":
            hint = True
        if name in ("class", "id") and tag not in ("html", "body", "article", "main") and NOISE_WORDS & set(re.split(r"[^a-z0-9]+", value)):
            hint = True
        if name in ("class", "id") and tag == "article" and {"comment", "reply", "ad", "promo", "teaser"} & set(re.split(r"[^a-z0-9]+", value)):
            hint = True
    return False, hint


def blocks(page: str) -> Iterator[Block]:
    """Leaf text blocks in page order, white space collapsed, character references decoded."""
    stack: list[tuple[str, int, bool, tuple[int, ...]]] = []  # block elements (tag, position, noise at or above, suspects at or above)
    names: Counter[str] = Counter()   # of the open elements
    text: list[str] = []
    linked: list[str] = []
    in_link = 0
    unclosed: set[str] = set()        # raw elements without an end tag from here on

    def flush() -> Iterator[Block]:
        joined = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if joined:
            share = len(" ".join(html.unescape("".join(linked)).split())) / len(joined) if linked else 0.0
            yield Block(tuple(x[0] for x in stack), tuple(x[1] for x in stack), *(stack[-1][2:] if stack else (False, ())), joined, len(PUNCTUATION.findall(joined)), share)
        linked.clear()

    def close(k: int) -> None:
        """Leave the elements from place ``k`` of the stack on."""
        names.subtract(x[0] for x in stack[k:])
        del stack[k:]

    def innermost(tag: str) -> int:
        k = len(stack) - 1
        while stack[k][0] != tag:
            k -= 1
        return k

    at = 0
    while True:
        m = TOKEN.search(page, at)
        text.append(page[at : m.start() if m else len(page)])
        if in_link:
            linked.append(text[-1])
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in RAW and not closing:
            end = None if tag in unclosed else re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if end is None:
                unclosed.add(tag)
            if end or tag in ("script", "style", "textarea", "title"):
                at = end.end() if end else len(page)
            text.append(" ")
            continue
        if tag in INLINE or tag in RAW:
            if tag == "a":
                in_link = 0 if closing else 1
            continue
        if tag == "br":
            text.append(" ")
            continue
        yield from flush()
        if tag in VOID:
            continue
        if closing:
            if names[tag]:
                close(innermost(tag))
            continue
        if tag in CLOSES_P and names["p"]:
            close(innermost("p"))
        elif tag in SIBLINGS:
            same, within = SIBLINGS[tag][0].split(), SIBLINGS[tag][1]
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in within:
                    break
                if stack[k][0] in same:
                    close(k)
                    break
        (noise, hint), (above, suspects) = _noise(tag, attributes, names["article"] + names["main"] > 0), stack[-1][2:] if stack else (False, ())
        stack.append((tag, at, above or noise, (*suspects, at) if hint else suspects))
        names[tag] += 1
    yield from flush()


def _smoothed(x: np.ndarray, width: float = SMOOTH) -> np.ndarray:
    reach = int(np.ceil(2 * width))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / width) ** 2)
    kernel /= kernel.sum()
    return np.convolve(np.pad(x, reach, mode="edge"), kernel, mode="valid")


class Sums(NamedTuple):
    """Blocks together: their number, text length and punctuation marks."""

    n: int = 0
    size: int = 0
    marks: int = 0

    def plus(self, b: Block) -> Sums:
        return Sums(self.n + 1, self.size + len(b.text), self.marks + b.marks)

    @property
    def ratio(self) -> float:
        """Mean text length of blocks, raised by their mean number of punctuation marks."""
        n = max(1, self.n)
        return self.size / n * (1 + self.marks / n)


def _ratio(found: list[Block]) -> float:
    return Sums(len(found), sum(len(b.text) for b in found), sum(b.marks for b in found)).ratio


def suspected(found: list[Block]) -> set[int]:
    """Ids of the hinted elements that are noise, of blocks that are not noise themselves.

    A hint holds where the element has no more text than what is known to be free of hints, or a lower ratio than that, or hardly any
    text; and for a single block unless it outweighs the rest of the page by far, as a notice can be longer than a short article. So a
    wrapper of most of the page's text is cleared whatever its class. The best element is looked at first. Sums are kept as elements are
    cleared, so each block is met once per hinted element around it.
    """
    under: dict[int, list[int]] = {}
    own: dict[int, Sums] = {}
    for k, b in enumerate(found):
        for e in b.suspects:
            under.setdefault(e, []).append(k)
            own[e] = own.get(e, Sums()).plus(b)
    left, whole = set(under), sum(len(b.text) for b in found)
    hints, clear = [len(b.suspects) for b in found], Sums()   # hints left around each block; blocks without any
    for b in found:
        clear = clear if b.suspects else clear.plus(b)
    for e in sorted(under, key=lambda e: (-own[e].ratio * np.log1p(own[e].size), e)):
        s = own[e]
        if len(under[e]) == 1 and s.size <= ALONE * (whole - s.size):
            continue
        if e in left and s.ratio >= PROSE and s.ratio >= clear.ratio and s.size > clear.size:
            first = found[under[e][0]].suspects
            for gone in left.intersection(first[: first.index(e) + 1]):  # nothing above a cleared element is noise
                left.discard(gone)
                for k in under[gone]:
                    hints[k] -= 1
                    clear = clear if hints[k] else clear.plus(found[k])
    return left


def only_place(found: list[Block]) -> int | None:
    """Id of the page's only main element, or else its only article, where it holds a share of the text that an article may have."""
    for tag in ("main", "article"):
        sizes: dict[int, int] = {}
        for b in found:
            for e in {i for i, t in zip(b.ids, b.path, strict=True) if t == tag}:
                sizes[e] = sizes.get(e, 0) + len(b.text)
        if len(sizes) == 1:
            (e, size), = sizes.items()
            return e if size >= ONLY_SHARE * sum(len(b.text) for b in found) else None
    return None


def content(found: list[Block]) -> list[Block]:
    """The blocks of the article."""
    open_ = [b for b in found if not b.noise]
    noise = suspected(open_) if any(b.suspects for b in open_) else set()
    open_ = [b for b in open_ if not noise.intersection(b.suspects)]
    if not open_:
        return []
    number = {p: k for k, p in enumerate(dict.fromkeys(b.path for b in open_))}
    which = np.array([number[b.path] for b in open_])
    n = np.bincount(which)
    length = np.bincount(which, [len(b.text) for b in open_]) / n
    marks = np.bincount(which, [b.marks for b in open_]) / n
    fused = _smoothed(length[which]) * (1 + _smoothed(marks[which]))
    per_path = np.bincount(which, fused) / n * np.log1p(np.bincount(which, [len(b.text) for b in open_]))
    place = only_place(open_)
    here = np.array([place is None or place in b.ids for b in open_])
    chosen = here & (per_path[which] >= CONTENT_SHARE * per_path[which[here]].max())
    held = [k for k in range(len(open_)) if chosen[k]]
    whole, depth = sum(len(open_[k].text) for k in held), 0
    while True:  # down to the deepest container that holds nearly all content
        below: dict[tuple[int, str], int] = {}
        for k in held:
            b = open_[k]
            if len(b.ids) > depth:
                key = b.ids[depth], b.path[depth]
                below[key] = below.get(key, 0) + len(b.text)
        best, tag = max(below, key=below.__getitem__, default=(0, ""))
        if tag not in CONTAINERS or below[best, tag] < HOLDS * whole:
            break
        held, depth = [k for k in held if open_[k].ids[depth : depth + 1] == (best,)], depth + 1
    root = open_[held[0]].ids[:depth]
    inside = [k for k, b in enumerate(open_) if b.ids[:depth] == root]
    boxes: dict[object, list[int]] = {}
    for k in inside:  # children of the article's element; text and elements that are no containers stand for themselves
        b = open_[k]
        boxes.setdefault(b.ids[depth] if len(b.ids) > depth and b.path[depth] in CONTAINERS else ("own", k), []).append(k)
    value = {key: _ratio([open_[k] for k in ks]) for key, ks in boxes.items()}
    best_box = max(value[key] for key, ks in boxes.items() if any(chosen[k] for k in ks))
    sure = [k for key, ks in boxes.items() if value[key] >= CONTENT_SHARE * best_box for k in ks if chosen[k]]
    first, last = sure[0], sure[-1]
    least = CONTENT_SHARE * fused[sure].mean()
    whole_page = not root or open_[held[0]].path[depth - 1] in ("html", "body")
    kept = set()
    for key, ks in boxes.items():
        between = first <= ks[0] and ks[-1] <= last
        if isinstance(key, tuple):
            good = between or bool(chosen[ks[0]]) or (not whole_page and open_[ks[0]].linked < LINKED)
        else:
            good = fused[ks].mean() >= least if between else value[key] >= CONTENT_SHARE * best_box
        if good:
            kept.update(ks)
    for k in range(min(kept) - 1, max(min(kept) - 4, -1), -1):  # the title may stand outside the element that holds the text
        if open_[k].path[-1:] in (("h1",), ("h2",)) and not any(b.path[-1:] in (("h1",),) for b in (open_[j] for j in sorted(kept)[:1])):
            kept.update(range(k, min(kept)))
            break
    return [open_[k] for k in sorted(kept)]


def main_text(page: str | None) -> str:
    return " ".join(b.text for b in content(list(blocks(page)))) if page else ""


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points), without ``column``; existing columns of these names give way.

    A null or empty page, and one without content, has the empty text. Repeated rows get equal texts; an empty table stays empty.
    """

    @F.pandas_udf("string")
    def text_of(page: pd.Series) -> pd.Series:
        return page.map(main_text, na_action=None).astype(object)

    keep = [c for c in pages.columns if c not in (column, "text", "n_chars")]
    return pages.select(*keep, text_of(F.coalesce(column, F.lit(""))).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
