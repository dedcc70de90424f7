"""Main text of web pages.

The standard library's parser streams events; each block element is one line with its text and the tags in it. A line's text-to-tag
ratio counts the text outside links. What elements, roles, ids and classes say of a line is a weight on its ratio, before and after a
Gaussian kernel smooths the ratios along the page: parts that are named as menus, headers, footers, sidebars, notices, adverts, forms
or reader comments count `NAMED` of their ratio, parts whose class merely mentions such a word outside an article, or is one of `TOPICS` in it, `HINTED`. A line's score is the
root of the geometric mean of its own ratio and the smoothed one. Two-means clustering of the scores of lines that no name weighs down
gives a threshold. Lines of one container, or of one article or
main element, that are named alike form a region; regions with a line at the threshold are content and are taken whole, so that their
short paragraphs stay, and so does a short unnamed line of its own between content lines.

Defined cases: null or empty html gives an empty text, and so does a page of named parts only; html that breaks off is read as far as
it goes; a form around a main heading, article or main element is no form by name; very long and deep pages take linear time;
repeated pages are judged one by one; an empty table gives an empty result; columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements that end a line of text where they start and where they end.
BLOCKS = frozenset("address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
#: Elements without text for readers, and the controls of forms.
SILENT = frozenset("script style noscript template svg head title iframe object embed applet audio video canvas map select option textarea input datalist".split())
#: Elements and roles around the content.
AROUND = frozenset("nav footer aside form dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: Words of ids and classes around the content.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer form gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted promotion related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
#: Marks that are also what a part of an article may be about: there they only hint, and the part's ratio decides.
TOPICS = frozenset("alert banner menu menus navigation notice notices notification promotion search share sharing social subscription".split())
#: Words that may stand beside a mark in a name without changing what it names.
BESIDE = frozenset("area article bar block blog body bottom box button buttons card cards container content footer global group header holder inner item items left link links list main message page panel post primary reader readers right secondary section site slot text thread top unit user users wrap wrapper".split())
#: A class or id of these words alone is a page's header.
HEADER = frozenset("header site page top main global container wrapper inner".split())
#: What lines of named and of hinted parts count, and the least score of a content line.
NAMED, HINTED, LEAST = 1e-3, 0.5, 0.1
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Blocks that are lines of their container, not containers.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt td th tr tbody thead tfoot blockquote pre ul ol dl figure figcaption table".split())
#: The element that an opening block ends, if it is open; so it ends an open head.
ENDS_P = "p"
SPACE = re.compile(r"\s+")
WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
SIGMA, RADIUS = 1.0, 3
#: Lines on either side among which a short line's neighbours are looked for.
GAP = 2
_kernel = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)


def named(attrs: dict[str, str], article: bool) -> tuple[bool, bool]:
    """Whether an id or class names a part around the content, and whether one mentions such a part. In an article only whole names count, and those of what it may be about just hint."""
    names, hints = False, False
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        words = {w.lower() for w in WORD.findall(name)}
        marks, whole = words & MARKS, words <= MARKS | BESIDE
        topic = article and marks <= TOPICS
        hints = hints or bool(marks) and (not article or (whole and topic))
        names = names or bool(marks) and whole and not topic
        names = names or (not article and "header" in words and words <= HEADER)
    return names, hints


class Lines(HTMLParser):
    """Lines of a page: (text, characters outside links, tags, region, part). `weights()` has what each part counts."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, int]] = []
        self.stack: list[tuple[str, bool, bool, int, int, int]] = [("", False, False, 0, 0, -1)]  # tag, silent, in an article, region, part, form
        self.open = [Counter()]  # tags of the stack since each article, main or body
        self.parts: list[str] = []
        self.own: list[tuple[int, float]] = [(0, 1.0)]  # parent and weight of each part
        self.tags, self.made, self.linked, self.links = 0, 0, 0, 0

    def weights(self) -> np.ndarray:
        out = np.ones(len(self.own))
        for i, (up, weight) in enumerate(self.own[1:], 1):
            out[i] = out[up] * weight
        return out

    def flush(self) -> None:
        text = SPACE.sub(" ", "".join(self.parts)).strip()
        _, _, _, region, part, _ = self.stack[-1]
        if text or self.tags:
            self.lines.append((text, max(0, len(text) - self.linked), self.tags, region, part))
        self.parts, self.tags, self.linked = [], 0, 0

    def push(self, *entry) -> None:
        self.stack.append(entry)
        if entry[0] in ("article", "main", "body"):
            self.open.append(Counter())
        self.open[-1][entry[0]] += 1

    def cut(self, depth: int) -> None:
        """Close what is open from depth on."""
        while len(self.stack) > depth:
            tag = self.stack.pop()[0]
            self.open[-1][tag] -= 1
            if tag in ("article", "main", "body"):
                self.open.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.flush()
            if tag == "body":
                self.cut(1)
            elif self.stack[-1][0] in (ENDS_P, "head"):
                self.cut(len(self.stack) - 1)
        elif tag == "br":
            self.parts.append(" ")
        elif tag == "a":
            self.links += 1
        self.tags += 1
        if tag in VOID or not (tag in BLOCKS or tag in SILENT or attrs):
            return
        _, silent, article, region, part, form = self.stack[-1]
        got = {k: v or "" for k, v in attrs}
        names, hints = (False, False) if tag in ("html", "body", "main") else named(got, article)
        names = names or "hidden" in got or got.get("aria-hidden") == "true" or "display:none" in got.get("style", "").replace(" ", "")
        names = names or tag in AROUND or got.get("role") in ROLES or (tag == "header" and not article)
        if tag not in BLOCKS and tag not in SILENT and not names:
            return
        begins = tag in ("article", "main") or got.get("role") in ("main", "article")
        if form >= 0 and (begins or tag == "h1"):
            self.own[form] = self.own[form][0], 1.0
        if names or (hints and not begins):
            self.own.append((part, NAMED if names else HINTED))
            part = len(self.own) - 1
            form = part if tag == "form" else form
            if tag not in BLOCKS:
                self.flush()
        if not article and tag not in LEAVES:
            self.made += 1
            region = self.made
        self.push(tag, silent or tag in SILENT, article or begins, region, part, form)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "a":
            self.links = max(0, self.links - 1)
        scopes = self.open if tag in ("html", "body", "main", "article") else self.open[-1:]
        if any(scope[tag] > 0 for scope in scopes):
            if tag not in SILENT:
                self.flush()
            at = len(self.stack) - 1
            while self.stack[at][0] != tag:
                at -= 1
            self.cut(at)
        elif tag in BLOCKS:
            self.flush()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack[-1][0] == tag:
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if not self.stack[-1][1]:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian mean along the lines; at the ends of what is there."""
    weight = np.convolve(np.ones(len(ratios)), _kernel)[RADIUS:-RADIUS]
    return np.convolve(ratios, _kernel)[RADIUS:-RADIUS] / weight


def threshold(x: np.ndarray) -> float:
    """Between the two means of x."""
    low, high = float(x.min()), float(x.max())
    for _ in range(50):
        cut = (low + high) / 2
        up = x >= cut
        new = float(x[~up].mean()) if (~up).any() else low, float(x[up].mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def main_text(html: str | None, threshold: Callable[[np.ndarray], float] = threshold) -> str:
    parser = Lines()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    lines = parser.lines
    if not any(text for text, *_ in lines):
        return ""
    weight = parser.weights()[[part for *_, part in lines]]
    own = weight * np.array([chars / max(1, tags) for _, chars, tags, _, _ in lines])
    score = np.sqrt(np.sqrt(own * smoothed(own)) * weight)
    has = np.array([bool(text) for text, *_ in lines])
    clear = has & (weight > NAMED * weight[has].max())
    cut = max(LEAST, threshold(score[clear]) - 1e-9)
    plain = weight >= 1
    told = [i for i, (text, *_) in enumerate(lines) if text]
    best: dict[tuple[int, int], float] = {}
    for (text, _, _, region, part), x in zip(lines, score, strict=True):
        if text:
            best[region, part] = max(best.get((region, part), 0.0), float(x))
    closed: list[int] = []
    taken = {i for i in told if best[lines[i][3:]] >= cut}
    # Short gaps between content close: a line or two of text that no name weighs down and that isn't mostly links.
    for at, i in enumerate(told):
        if i not in taken and plain[i] and 2 * lines[i][1] > len(lines[i][0]):
            near = [[j in taken and plain[j] for j in told[max(0, at - GAP) : at]], [j in taken and plain[j] for j in told[at + 1 : at + 1 + GAP]]]
            if all(map(any, near)):
                closed.append(i)
    taken.update(closed)
    return "\n\n".join(lines[i][0] for i in told if i in taken)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of pages."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            text = [main_text(x) for x in batch["html"]]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": text, "n_chars": [len(x) for x in text]})

    own = pages.select(F.col("page_id").cast("string").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return own.mapInPandas(run, "page_id string, url string, text string, n_chars long").withColumn("page_id", F.col("page_id").cast(pages.schema["page_id"].dataType))
