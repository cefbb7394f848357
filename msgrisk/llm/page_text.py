"""Main text of web pages by tag-path ratios.

A page is read as a sequence of text blocks, each with the path of tags from the root to the block. Per path,
text length, punctuation, link text and number of blocks are added up. The ratios of a path (text per block,
punctuation per block, share of text outside links) are smoothed over the sequence of blocks, fused with what
the names on the path say, and thresholded: a path is content or it is not, whatever the length of a block.

Names are a prior of at most NAMED, about what the ratios reach. An element's name counts against it by the share
of the page's running text (punctuated or long, outside links) that lies outside of it, so a wrapper of the whole text is
not believed; nav, footer and the like, which wrap no text of a page, count in full. article and main count by the
share that lies inside. Only hidden elements are out in any case.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from msgrisk.llm.tokens import pieces

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover "
    "munderover mmultiscripts mprescripts mtable mtr mtd mstyle mspace mpadded mphantom merror menclose mfenced semantics".split()
)
RAW = frozenset("script style template textarea title iframe svg xmp noembed noframes annotation annotation-xml".split())
# A start tag of the key ends an open element of the values, up to the nearest of SCOPE.
ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
SCOPE = frozenset("html body article main section div td th table ul ol dl blockquote aside nav header footer form".split())
BOILERPLATE_TAGS = frozenset("head nav footer aside form button select menu dialog fieldset".split()) | RAW
FIRM_TAGS = frozenset("nav footer button select menu dialog".split())  # never wrap the text of a page
CONTENT_TAGS = frozenset(("article", "main"))
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation "
    "menu submenu breadcrumb breadcrumbs header masthead topbar footer bottombar sidebar side aside rail cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login search form "
    "social share sharing related recommended recommendations trending pagination pager toolbar widget widgets comment "
    "comments commentlist respond reply replies disqus copyright legal disclaimer skip hidden tags taglist".split()
)
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+|[^>]*)>""",
    re.S,
)
_NAME = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORDS = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、؛؟¿¡]")
_SELF_CLOSED = re.compile(r"""(?:^|["'\s])/$""")
_SMOOTHING = (0.25, 0.5, 0.25)
THRESHOLD = 0.0
NAMED, CONTENT, NEUTRAL = 5.0, 1.0, 0.7


def _verdict(tag: str, attributes: str, inside: int) -> int:
    """-3 not shown, -2 boilerplate whatever its share, -1 boilerplate, 1 content, 0 unknown, from one element's names. Names of html and body say nothing."""
    if tag == "head" or attributes and _HIDDEN.search(attributes):
        return -3
    if tag in FIRM_TAGS:
        return -2
    if tag in BOILERPLATE_TAGS and (tag != "header" or not inside):
        return -1
    if attributes and tag not in ("html", "body"):
        for kind, *values in _NAME.findall(attributes):
            value = next(filter(None, values), "").lower()
            if kind.lower() == "role":
                if value in BOILERPLATE_ROLES:
                    return -1
            elif BOILERPLATE_NAMES.intersection(_WORDS.findall(value)):
                return -1
    return 1 if tag in CONTENT_TAGS else 0


Named = tuple[tuple[int, int], ...]


def blocks(page: str) -> list[tuple[str, Named, str, int]]:
    """(path, elements around it whose names say something, text, characters inside links) of every non-empty block.

    Blocks are in page order; a named element is its number and its verdict.
    """
    stack: list[tuple[str, Named]] = []
    out: list[tuple[str, Named, str, int]] = []
    numbered = 0
    parts: list[str] = []
    linked = links = 0
    at, end, search = 0, len(page), _TAG.search

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                path = "/".join(tag for tag, _ in stack if tag not in INLINE)
                out.append((path, stack[-1][1] if stack else (), text, min(linked, len(text))))
            parts.clear()
        linked = 0

    while at < end:
        found = search(page, at)
        text = page[at:found.start()] if found else page[at:]
        if text:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if links:
                linked += len(text.strip())
        if not found:
            break
        at = found.end()
        closing, tag, attributes = found.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if depth is None:
                continue
            if tag not in INLINE:
                close()
            elif any(t not in INLINE for t, _ in stack[depth:]):
                continue  # a stray inline end tag does not close blocks
            if any(t == "a" for t, _ in stack[depth:]):
                links = 0
            del stack[depth:]
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in INLINE:
            close()
            ends = ENDED_BY.get(tag, ())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends or stack[k][0] == "p":
                    del stack[k:]
                    links = 0
                if k < len(stack) and stack[k][0] in SCOPE and stack[k][0] not in ends:
                    break
        if tag in VOID:
            continue
        if tag in ("svg", "math") and _SELF_CLOSED.search(attributes):
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        over = stack[-1][1] if stack else ()
        verdict = _verdict(tag, attributes, any(v > 0 for _, v in over))
        numbered += 1
        stack.append((tag, (*over, (numbered, verdict)) if verdict else over))
        links += tag == "a"
    close()
    return out


def _priors(found: list[tuple[str, Named, str, int]]) -> dict[Named, float]:
    """What the names around blocks say: above 0 for content."""
    mean = sum(len(block[2]) for block in found) / max(1, len(found))
    running = [(len(text) - linked) * bool(len(text) > mean or _PUNCTUATION.search(text)) for _, _, text, linked in found]
    if not any(running):
        running = [len(text) - linked for _, _, text, linked in found]
    held: dict[int, float] = {}
    total = marked = 0
    for (_, names, _, _), size in zip(found, running):
        if any(v == -3 for _, v in names):
            continue
        total += size
        marked += size * any(v > 0 for _, v in names)
        for number, _ in names:
            held[number] = held.get(number, 0) + size
    share = marked / total if total else 0.0
    out = {}
    for names in {block[1] for block in found}:
        against = max((1 - held.get(number, 0) / total if total and v == -1 else 1.0 for number, v in names if v < 0), default=0.0)
        inside = any(v > 0 for _, v in names)
        favour = CONTENT + (NAMED - CONTENT) * share if inside else NEUTRAL - NAMED * share
        out[names] = -math.inf if any(v == -3 for _, v in names) else min(favour, NEUTRAL) - NAMED * against if against else favour
    return out


def content_paths(found: list[tuple[str, Named, str, int]]) -> list[bool]:
    """For every block, whether its path is content."""
    priors = _priors(found)
    totals: dict[tuple[str, Named], list[float]] = {}
    for path, names, text, linked in found:
        sums = totals.setdefault((path, names), [0, 0, 0, 0])
        sums[0] += len(text)
        sums[1] += len(_PUNCTUATION.findall(text))
        sums[2] += linked
        sums[3] += 1
    shown = [k for k in totals if priors[k[1]] > -math.inf]
    mean = sum(totals[k][0] for k in shown) / max(1, sum(totals[k][3] for k in shown))
    ratio = {}
    for key in totals:
        length, marks, linked, n = totals[key]
        # Text and punctuation per block against the page's mean block, and text outside links.
        fused = min(2.0, max(-2.0, math.log((length / n + 1) / (mean + 1)))) + 0.5 * math.log1p(marks / n) - 3.0 * (linked / length > 0.5)
        ratio[key] = fused
    series = [ratio[b[0], b[1]] for b in found]
    smooth: dict[tuple[str, Named], list[float]] = {}
    for k, block in enumerate(found):
        near = [series[j] if 0 <= j < len(series) else series[k] for j in (k - 1, k, k + 1)]
        smooth.setdefault((block[0], block[1]), []).append(sum(w * x for w, x in zip(_SMOOTHING, near)))
    keep = {}
    for key, values in smooth.items():
        evidence = 0.5 * (ratio[key] + sum(values) / len(values))
        keep[key] = evidence + priors[key[1]] > THRESHOLD
    return [keep[b[0], b[1]] for b in found]


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    return "\n".join(block[2] for block, kept in zip(found, content_paths(found)) if kept)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """All columns of pages but html_col, with the main text and its number of code points.

    Null or empty html, and pages without content, give an empty text. Broken markup is read to its end.
    """
    kept = [c for c in pages.columns if c != html_col]
    clash = {text_col, chars_col} & set(kept)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are taken; name others")
    rows = pages.select(*kept, html_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != html_col)
    schema = (fields + ", " if fields else "") + f"`{text_col}` string, `{chars_col}` bigint"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, html_col):
            texts = pa.array([main_text(page) for page in piece.column(html_col).to_pylist()], pa.string())
            counts = pc.utf8_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in kept), texts, counts], [*kept, text_col, chars_col])

    return rows.mapInArrow(run, schema)
