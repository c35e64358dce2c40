"""Main text of HTML pages by two passes of block rules.

Pass one decides blocks by where they stand (containers that name their purpose) and, where
the page doesn't say, by link density, length and stop-word density. Pass two gives each
undecided short block the label of the nearest decided one. An article element outweighs what
stands outside it only if it holds at least as much text that the passes take for good.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from tidewatch.llm.common import map_batches

# Frequent words of the languages served.
STOP_WORDS = frozenset("""
a about after all also an and any are as at be because been but by can could do for from had has have he her his how
i if in into is it its more my no not of on one only or other our out she so some than that the their them then there
these they this to up was we were what when which who will with would you your
aber als am an auch auf aus bei bin bis da das dass dem den der des die doch durch ein eine einem einen einer er es für
hat haben ich ihr im in ist ja kann man mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war
was wenn werden wie wir zu zum zur
au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais me même ne nous on ou par pas
pour qu que qui sa se ses son sont sur un une vous à été être
al como con de del desde el ella en entre era es esta este esto fue ha hasta hay la las le lo los me más muy no nos o
para pero por porque que se ser si sin sobre son su sus también un una y ya
""".split())

# Element names and the words of class, id and role that name a purpose.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre
section select summary table tbody td tfoot th thead title tr ul""".split())
NEVER = frozenset("nav footer aside form head title button select option noscript template iframe svg dialog menu".split())
HARD_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion comment
comments commentlist respond disqus reply replies related recommended share sharing social newsletter subscribe
navigation nav breadcrumb breadcrumbs contentinfo search login signup form pagination hidden""".split())
SOFT_WORDS = frozenset("""header masthead banner footer sidebar aside complementary menu menubar toolbar widget cookie
cookies consent gdpr notice notices alert popup modal overlay skip copyright legal tags meta""".split())
LAYOUT_WORDS = frozenset("with has no wrap wrapper layout".split())
MAIN_WORDS = frozenset("article articlebody story post entry content main maincontent body text".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|textarea|xmp)\b[^>]*>.*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*+"|'[^']*+'|[^'">])*+)>|<[!?/][^>]*>|</?[a-zA-Z][^>]*>""",
    re.S | re.I)
_MARKS = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""\shidden(?:\s|=|/|\Z)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_WORDS = re.compile(r"[^\W\d_]+")
_FORM = re.compile(r"<form\b", re.I)

GOOD, BAD, SHORT, NEAR, OPEN = "good", "bad", "short", "near", None
SHORT_CHARS, LONG_CHARS, MOST_LINKS, FEW_STOPS, MANY_STOPS = 70, 200, 0.4, 0.1, 0.3


def _purpose(tag: str, attributes: str, above: str | None, forms: bool = False) -> str | None:
    """What an element's content is for: 'main', 'soft' or 'hard' boilerplate, or as above it.

    With `forms`, a form is for whatever it stands in.
    """
    if above == "hard":
        return above
    if tag in NEVER and not (forms and tag == "form") or attributes and _HIDDEN.search(attributes):
        return "hard"
    if tag == "form":
        return above
    words = set()
    if attributes and tag not in ("html", "body"):
        for match in _MARKS.finditer(attributes):
            marks = (match[2] or match[3] or match[4] or "").lower()
            if tag in ("article", "main"):  # what it has ("has-comments") is not what it is ("comment-body")
                first = {re.split(r"[^a-z]+", mark)[0] for mark in marks.split()}
                words.update(first)
            else:
                words.update(re.split(r"[^a-z]+", marks))
        if tag in ("article", "main") and words & MAIN_WORDS:
            words -= HARD_WORDS
    if words & LAYOUT_WORDS:  # such a wrapper holds the whole page: "with-sidebar"
        words -= SOFT_WORDS
    if words & HARD_WORDS:
        return "hard"
    if tag in ("article", "main"):
        return "main"
    if above == "main":
        # A heading of the article is part of it; bars and notices inside are not.
        return "soft" if words & (SOFT_WORDS - {"header", "meta", "legal"}) else "main"
    if tag == "header" or words & SOFT_WORDS:
        return "soft"
    if above is None and tag in ("div", "section", "td") and words & MAIN_WORDS:
        return "likely"
    return above


def blocks_of(html: str, forms: bool = False) -> list[tuple[str, str | None, int, bool]]:
    """(text, purpose, characters inside links, in a list) of every block that has text."""
    found: list[tuple[str, str | None, int, bool]] = []
    stack: list[tuple[str, str | None]] = []
    parts: list[str] = []
    linked, links, at, broken = 0, 0, 0, False

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                listed = any(tag in ("li", "dd", "dt") for tag, _ in stack[-4:])
                found.append((text, stack[-1][1] if stack else OPEN, linked, listed))
            parts.clear()
        linked = 0

    def take(raw: str) -> None:
        nonlocal linked, broken
        if raw:
            text = unescape(raw) if "&" in raw else raw
            parts.append(text)
            if text and not text.isspace():
                broken = False
            if links:
                linked += len(text.strip())

    for match in _TAG.finditer(html):
        take(html[at:match.start()])
        at = match.end()
        tag = (match[3] or "").lower()
        if not tag:
            continue
        if tag == "br":
            if broken:
                close()
            parts.append(" ")
            broken = not broken
            continue
        if tag in BLOCK:
            close()
            broken = False
        if match[2]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag
                          or tag not in BLOCK and stack[i][0] in BLOCK), -1)
            if depth >= 0 and stack[depth][0] == tag:
                del stack[depth:]
            links = sum(name == "a" for name, _ in stack)
            continue
        if tag == "body":
            stack.clear()
        if tag in BLOCK:  # an open paragraph, with what stands inside it, ends here
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in BLOCK), -1)
            if depth >= 0 and (stack[depth][0] == "p" or stack[depth][0] == tag == "li"):
                del stack[depth:]
            links = sum(name == "a" for name, _ in stack)
        if tag not in VOID and not match[4].endswith("/"):
            stack.append((tag, _purpose(tag, match[4], stack[-1][1] if stack else OPEN, forms)))
            links += tag == "a"
    take(html[at:])
    close()
    return found


def label(text: str, purpose: str | None, linked: int, listed: bool, has_main: bool) -> str:
    """The label of the first pass."""
    density = min(1.0, linked / len(text))
    if purpose in ("hard", "soft"):
        return BAD
    if purpose == "main" or purpose == "likely" and not has_main:
        return BAD if listed and density > 0.9 else GOOD
    if has_main or density > MOST_LINKS:
        return BAD
    if len(text) < SHORT_CHARS:
        return BAD if linked else SHORT
    words = _WORDS.findall(text.lower())
    stops = sum(word in STOP_WORDS for word in words) / max(1, len(words))
    if stops >= MANY_STOPS and len(text) > LONG_CHARS:
        return GOOD
    return NEAR if stops >= FEW_STOPS else BAD


def inherit(labels: list[str]) -> list[str]:
    """Second pass: undecided blocks take the nearest decided label; between two equally near
    ones that differ, and on a page without any, near-good blocks stay and short ones go."""
    before: list[tuple[str, int] | None] = []
    last = None
    for place, kind in enumerate(labels):
        last = (kind, place) if kind in (GOOD, BAD) else last
        before.append(last)
    result, last = list(labels), None
    for place in range(len(labels) - 1, -1, -1):
        kind = labels[place]
        if kind in (GOOD, BAD):
            last = (kind, place)
            continue
        left, right = before[place], last
        if left and right and left[0] != right[0] and place - left[1] == right[1] - place or not (left or right):
            result[place] = GOOD if kind == NEAR else BAD
        elif left and (not right or place - left[1] <= right[1] - place):
            result[place] = left[0]
        else:
            result[place] = right[0]
    return result


def _chosen(blocks: list[tuple[str, str | None, int, bool]]) -> list[str]:
    """The texts of the good blocks."""
    labels = inherit([label(*block, False) for block in blocks])
    inside = sum(len(text) for (text, purpose, _, _), kind in zip(blocks, labels) if kind == GOOD and purpose == "main")
    outside = sum(len(text) for (text, purpose, _, _), kind in zip(blocks, labels) if kind == GOOD and purpose != "main")
    if inside and inside >= outside:
        labels = inherit([label(*block, True) for block in blocks])
    return [block[0] for block, kind in zip(blocks, labels) if kind == GOOD]


def main_text(html: str | None) -> str:
    """The article of one page, a line per block; empty for a page without any, and for null.

    A form is left out, unless it holds more text than all the rest of the article.
    """
    texts = _chosen(blocks_of(html)) if html else []
    if html and _FORM.search(html):
        wrapped = _chosen(blocks_of(html, True))
        if sum(map(len, wrapped)) > 2 * sum(map(len, texts)):
            texts = wrapped
    return "\n".join(texts)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row; other columns are left out.

    One pass without a shuffle. A null html gives the empty text; repeated rows stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [main_text(html) for html in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    rows = pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "cast(html as string) html")
    return map_batches(rows, run, "page_id long, url string, text string, n_chars long")
