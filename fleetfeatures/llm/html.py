"""Operator 1, HTML extraction: parser events to lines, text-to-tag ratios, smoothing, threshold clusters.

The standard library's streaming parser yields events; they are folded into
lines (one per block) with the characters of text, of link text and the tags
met. The ratio of text to tags per line is smoothed with a Gaussian; lines above
the deviation of the smoothed ratios cluster into content regions. The element
that holds the larger part of the regions' text is the content element; all its
lines are taken in page order, except those inside menus, footers, sidebars,
notices, adverts, forms, comments and the like. A class or id that names such a
block counts only where the block's share of text and of links does not refute it.

Defined cases: a null or empty page, or one without text, gives an empty text;
unclosed and stray tags are tolerated; texts of any length are read whole; equal
pages give equal texts; only page_id, url and html are read, so extra columns
cannot clash.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetfeatures.llm.common import ship

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img math".split())
#: Elements whose text is never shown as text of the page.
HIDDEN = frozenset(
    "head script style template noscript iframe object svg canvas audio video select option button textarea dialog "
    "map title datalist".split())
FURNITURE = frozenset("nav footer aside form menu header".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
#: Words of class and id that name page furniture.
FURNITURE_WORDS = re.compile(
    r"(?:^|[^a-z])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|consent|gdpr"
    r"|notices?|alert|popup|modal|overlay|sidebar|side-?nav|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead"
    r"|site-?header|page-?header|comments?|disqus|replies|social|share|sharing|related|recommended|newsletter|subscribe"
    r"|signup|login|widget|toolbar|pagination|pager|search|skip-?link)(?:$|[^a-z])")
#: Names of reader comments, which are furniture whatever their share.
COMMENT_WORDS = re.compile(r"(?:^|[^a-z])(?:comments?|disqus|replies)(?:$|[^a-z])")
#: Names that tell what else the page has or lacks, not what the element is.
STATES = re.compile(r"(?:^|(?<=\s))(?:no|has|with|without)-\S+")
#: The share of a page's text that refutes a furniture name, and the characters that stand for an article's form.
SHARE, LONG = 2 / 3, 400
#: Elements that are a piece of a content element, not one.
PIECES = frozenset("p li td tr h1 h2 h3 blockquote pre".split())
#: Elements whose classes speak of the page, not of themselves.
ROOTS = frozenset("html body main article".split())
#: An element of the left closes an open one of the right.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table body html article main section div".split())
SIGMA = 1.5


class _Page(HTMLParser):
    """Folds parser events into lines (text, characters outside links, tags, innermost element, whether furniture) and a tree.

    Elements are numbered as they start, so a parent's number is less than its children's and one pass over the numbers
    carries a property down, one backwards sums it up. What is open is counted by kind and tag; a line costs no more the
    deeper it lies.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, bool]] = []
        self.tags, self.parents, self.names = [""], [0], [""]  # by element; 0 is the page
        self.open: list[list] = []  # tag, number, what it starts: hidden, furniture or nothing
        self.open_tags: Counter[str] = Counter()
        self.open_kinds: Counter[str] = Counter()
        self.text: list[str] = []
        self.plain = self.met = 0

    def flush(self) -> None:
        if self.text:
            line = " ".join("".join(self.text).split())
            self.text = []
            if line:
                furniture = bool(self.open_kinds["hidden"] or self.open_kinds["furniture"])
                self.lines.append((line, self.plain, self.met, self._inner(), furniture))
                self.met = 0
            self.plain = 0

    def _inner(self) -> int:
        return self.open[-1][1] if self.open else 0

    def _close(self, at: int) -> None:
        """End the open elements from place ``at`` on."""
        for tag, _, kind in self.open[at:]:
            self.open_tags[tag] -= 1
            self.open_kinds[kind] -= 1
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.met += 1
        if tag == "br":
            self.text.append(" ")
            return
        if tag not in INLINE:
            self.flush()
            if self.open and tag not in VOID:
                self._imply(tag)
        if tag in VOID:
            return
        kind, name = self._kind(tag, dict(attrs))
        self.parents.append(self._inner())
        self.open.append([tag, len(self.tags), kind])
        self.tags.append(tag)
        self.names.append(name)
        self.open_tags[tag] += 1
        self.open_kinds[kind] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.met += 1
        if tag == "br":
            self.text.append(" ")
        elif tag not in INLINE:
            self.flush()

    def handle_endtag(self, tag: str) -> None:
        self.met += 1
        if tag not in INLINE:
            self.flush()
        if not self.open_tags[tag]:
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self._close(at)
                return
            if tag in INLINE and self.open[at][0] not in INLINE:
                return

    def handle_data(self, data: str) -> None:
        if self.open_kinds["hidden"]:
            return
        self.text.append(data)
        if not self.open_tags["a"]:
            self.plain += len(data)

    def _imply(self, tag: str) -> None:
        """Close what this tag's start ends: inline elements left open, a paragraph, a sibling item."""
        while self.open and self.open[-1][0] in INLINE and not self.open[-1][2]:
            self._close(len(self.open) - 1)
        if self.open and self.open[-1][0] == "p":
            self._close(len(self.open) - 1)
        siblings = [t for t in CLOSES.get(tag, ()) if self.open_tags[t]]
        for at in range(len(self.open) - 1, -1, -1) if siblings else ():
            if self.open[at][0] in siblings:
                self._close(at)
                return
            if self.open[at][0] in SCOPES:
                return

    def _kind(self, tag: str, attrs: dict[str, str | None]) -> tuple[str, str]:
        """What an element is by its markup (hidden, furniture or nothing), and by its name (see ``furniture_lines``)."""
        if tag in HIDDEN or "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(
                r"display\s*:\s*none", attrs.get("style") or ""):
            return "hidden", ""
        if tag in ROOTS:
            comment = bool(re.search("comment|repl", (attrs.get("class") or "").lower()))
            if tag in ("article", "main") and self.open_kinds["furniture"] and not comment:
                # an article inside a form or a menu left open is no part of it
                for element in self.open:
                    if element[2] == "furniture" and element[0] in ("form", "nav", "header", "menu"):
                        self.open_kinds["furniture"] -= 1
                        self.open_kinds[""] += 1
                        element[2] = ""
            return ("furniture" if tag == "article" and comment else ""), ""
        if tag == "header" and (self.open_tags["article"] or self.open_tags["main"]):
            return "", ""
        if tag in FURNITURE or (attrs.get("role") or "").lower() in FURNITURE_ROLES:
            return "furniture", ""
        named = STATES.sub(" ", f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower())
        if tag in INLINE or not FURNITURE_WORDS.search(named):
            return "", ""
        return "", "comments" if COMMENT_WORDS.search(named) else "furniture"

    def sums(self, values: dict[int, int]) -> list[int]:
        """Values of elements, with those of all that is inside them."""
        total = [0] * len(self.tags)
        for element, value in values.items():
            total[element] += value
        for element in range(len(total) - 1, 0, -1):
            total[self.parents[element]] += total[element]
        return total

    def inside(self, chosen: set[int]) -> list[bool]:
        """Per element whether it is one of the chosen or lies in one."""
        within = [e in chosen for e in range(len(self.tags))]
        for element in range(1, len(within)):
            within[element] = within[element] or within[self.parents[element]]
        return within


def furniture_lines(page: _Page) -> list[bool]:
    """Per line whether it is furniture, by markup or by a name of an element around it.

    A name alone does not decide: a block named like furniture stays if it holds ``SHARE`` of the page's text, most of it
    outside links, and has an article's form (a heading or article in it, or ``LONG`` characters); an article or main
    element with that share ends the reach of names around it. Reader comments go however long they are, but for a block
    with the page's first heading.
    """
    headings = page.sums({e: 1 for e, tag in enumerate(page.tags) if tag == "h1"})
    forms = page.sums({e: 1 for e, tag in enumerate(page.tags) if tag in ("h1", "article", "main")})
    comments = page.inside({e for e, name in enumerate(page.names) if name == "comments" and not headings[e]})
    chars, plain = Counter(), Counter()
    for text, free, _, element, furniture in page.lines:
        if not furniture and not comments[element]:
            chars[element] += len(text)
            plain[element] += min(free, len(text))
    chars, plain = page.sums(chars), page.sums(plain)
    total = plain[0]

    def holds(e: int) -> bool:
        return plain[e] > 0 and plain[e] >= SHARE * total and 2 * plain[e] >= chars[e]

    gone = [False] * len(page.tags)
    for e in range(1, len(gone)):
        gone[e] = gone[page.parents[e]]
        if page.names[e] and not (holds(e) and (forms[e] or plain[e] >= LONG)):
            gone[e] = True
        elif page.tags[e] in ("article", "main") and holds(e):
            gone[e] = False
    return [furniture or comments[element] or gone[element] for _, _, _, element, furniture in page.lines]


def smoothed(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian smoothing; at the ends the window holds what is there."""
    reach = max(1, math.ceil(2 * sigma))
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        low, high = max(0, i - reach), min(len(values), i + reach + 1)
        part = kernel[low - i + reach:high - i + reach]
        out.append(sum(k * v for k, v in zip(part, values[low:high])) / sum(part))
    return out


def main_text(html: str | None) -> str:
    """The text of the content element of a page."""
    if not html:
        return ""
    page = _Page()
    page.feed(html)
    page.close()
    page.flush()
    furniture = furniture_lines(page)
    if all(furniture):
        return ""
    ratios = smoothed([0.0 if gone else plain / max(1, tags) for (_, plain, tags, _, _), gone in zip(page.lines, furniture)])
    mean = sum(ratios) / len(ratios)
    threshold = math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios))
    regions, rest = Counter(), Counter()
    for (text, _, _, element, _), gone, ratio in zip(page.lines, furniture, ratios):
        if not gone:
            rest[element] += len(text)
            if ratio >= threshold:
                regions[element] += len(text)
    chosen = page.inside({_content_element(page, regions or rest)})
    return " ".join(line[0] for line, gone in zip(page.lines, furniture) if not gone and chosen[line[3]])


def _content_element(page: _Page, regions: dict[int, int]) -> int:
    """An article or main element with over half of the regions' text, else the deepest element with over two thirds, else the page."""
    weight, total = page.sums(regions), sum(regions.values())
    depth = [0] * len(weight)
    for e in range(1, len(depth)):
        depth[e] = depth[page.parents[e]] + 1
    named = [e for e, w in enumerate(weight) if page.tags[e] in ("article", "main") and 2 * w > total]
    if named:
        return max(named, key=lambda e: (depth[e], -e))
    held = [e for e, w in enumerate(weight) if e and 3 * w > 2 * total and page.tags[e] not in INLINE and page.tags[e] not in PIECES]
    return max(held, key=lambda e: (depth[e], -e), default=0)


def _extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in batches:
        yield pages.map(main_text, na_action=None)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    ship(pages.sparkSession)
    text = F.pandas_udf(_extract, "string")
    return (pages.select("page_id", "url", text(F.coalesce("html", F.lit(""))).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
