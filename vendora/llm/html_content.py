"""Main text of web pages by text-to-tag ratios.

1. The standard library's parser streams its events into lines: a block element, a break
   or a list item starts a new one.  Each line keeps its characters, its tags, its
   characters inside links, and the containers around it.  What is never content by its
   element (scripts, styles, menus, forms, footers, ...) or by a name that says nothing but
   menu, notice, advert or comment is marked.  A name that has such a word beside others
   (``related-work``, ``alert-system``) is a doubt that the ratios settle.
2. A line's ratio is its characters outside links for each tag on it.  A Gaussian kernel
   smooths the ratios along the page, so that a short line among long ones is not
   taken for a menu.
3. Smoothed ratios fall into two clusters around their low and high means; the
   threshold lies between.  Lines above it are content.  A doubtful container is marked if
   its characters outside links for each of its tags are not above the threshold either.
4. The content region is the innermost container that holds all of the content, within
   the outermost ``article`` or ``main`` element that holds most of its characters, if there
   is one.  Without one, boxes beside the innermost that hold a tenth of the content at most, and no
   title that it lacks, are left out, and so are boxes inside it that are mostly links.  All other unmarked
   lines of the region are the text, short ones too.

Every page is a row of its own; nothing is shuffled.  Pages are parsed in pieces, and
their lines are held for one page at a time.

Defined results: null and empty pages have an empty text; a page without any unmarked
line too; repeated rows give the same text each; an empty table gives an empty result;
other columns are not read.  Unclosed and stray tags are taken as browsers do, and a
page's end closes what is open.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendora.llm.common import slices

SIGMA = 1.0
# Share of the content's characters that boxes beside the region may hold, where no element names it.
BESIDE = 0.1
# Characters of a page that the parser gets at a time.
FEED = 1 << 16

# --- Fixed values: elements and names ---------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset({"script", "style"})
NEVER = frozenset(
    "script style noscript template head title nav aside footer form button select textarea option "
    "iframe object svg canvas audio video dialog menu map label fieldset".split()
)
BLOCK = frozenset(
    "address article aside blockquote body br dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
# Containers that may be the content region; lists, tables and quotes are parts of a text.
GROUPS = frozenset("html body main article section div".split())
# A start of these closes an open paragraph, and of itself, as browsers do.
ENDS_P = BLOCK - {"br", "body", "html", "head", "title", "td", "th", "tr", "tbody", "thead", "tfoot", "option"}
CLOSES = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "option": ("option", ("select",)),
}
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs topbar toolbar pagination pager "
    "sidebar sidenav aside rail widget widgets footer masthead "
    "comment comments commentlist respond replies disqus discussion "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social related recommended recommendations skip copyright disclaimer legal".split()
)
# Words that say where or what kind of box something is, beside the names above.
PLACES = frozenset(
    "article articles area bar block body bottom box button buttons container content entry entries fixed footer form "
    "global group head header holder icon icons inner item items left link links list main outer page panel post posts "
    "primary reader readers region right row secondary section site slot small sticky text thread title top unit user "
    "users wrap wrapper".split()
)
LISTS = frozenset("ul ol table".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())

_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


# How sure it is that an element is never content.
NO, DOUBT, YES = 0, 1, 2


def _marked(tag: str, attrs: dict[str, str | None], inside: bool) -> int:
    """Whether an element is never content; ``inside``: of an article."""
    if tag in NEVER or (tag == "header" and not inside):
        return YES
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or _HIDDEN.search((attrs.get("style") or "").lower()):
        return YES
    if (attrs.get("role") or "").lower() in ROLES:
        return YES
    if tag in ("body", "html", "main", "article"):
        return NO
    sure = NO
    for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split():
        words = set(_NAME.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower()))
        if words & NAMES:
            sure = max(sure, YES if words <= NAMES | PLACES else DOUBT)
    return sure


class Lines(HTMLParser):
    """Collects lines ``[text, tags, link characters, container, marked, doubt]`` from parser events;
    a doubt is the number of the outermost doubtful element around the line, 0 if there is none."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[list] = []
        self.parts: list[str] = []
        self.tags = self.linked = 0
        # Open elements: name, container number, whether marked, doubt.
        self.open: list[tuple[str, int, bool, int]] = [("", 0, False, 0)]
        self.doubts = 0
        self.parents = [0]
        self.kinds = [""]
        self.links = self.articles = 0

    def _line(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", "".join(self.parts)).strip()
            if text:
                self.lines.append([text, self.tags, self.linked, *self.open[-1][1:]])
                self.tags = self.linked = 0
            self.parts = []

    def _pop(self) -> None:
        tag = self.open[-1][0]
        if tag in BLOCK:
            self._line()
        self.open.pop()
        self.links -= tag == "a"
        self.articles -= tag == "article"

    def _close(self, names, until) -> None:
        """Close the nearest open element of ``names``, unless one of ``until`` is nearer."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] in names:
                while len(self.open) > i:
                    self._pop()
                return
            if self.open[i][0] in until:
                return

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in CLOSES:
            names, until = CLOSES[tag]
            self._close(names.split(), until)
        if tag in ENDS_P:
            self._close(("p",), ("table", "td", "th", "li", "button", "article", "section", "div", "blockquote"))
        if tag in BLOCK:
            self._line()
        if tag in VOID:
            return
        _, number, marked, doubt = self.open[-1]
        sure = NO if marked else _marked(tag, dict(attrs), self.articles > 0)
        marked |= sure == YES
        if sure == DOUBT and not doubt:
            self.doubts += 1
            doubt = self.doubts
        if tag in BLOCK:
            self.parents.append(number)
            self.kinds.append(tag)
            number = len(self.parents) - 1
        self.open.append((tag, number, marked, doubt))
        self.links += tag == "a"
        self.articles += tag == "article"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in RAW and tag in ("svg", "iframe"):
            self._close((tag,), ())

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in VOID:
            return
        # An end tag closes what is open inside it, but not beyond its block.
        until = () if tag in BLOCK else BLOCK
        self._close((tag,), until)

    def handle_data(self, data):
        if self.open[-1][0] in RAW:
            return
        self.parts.append(data)
        if self.links:
            self.linked += len(data)

    def close(self):
        super().close()
        self._line()
        while len(self.open) > 1:
            self._pop()


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing along the page; its borders count as far as there are lines."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * sigma * sigma))
    inner = slice(reach, reach + len(ratios))
    return np.convolve(ratios, kernel)[inner] / np.convolve(np.ones(len(ratios)), kernel)[inner]


def threshold(values: np.ndarray) -> float:
    """The border of the two clusters of values: half way between their means."""
    low, high = values.min(), values.max()
    for _ in range(100):
        cut = (low + high) / 2
        upper = values > cut
        if upper.all() or not upper.any():
            return cut if low < high else low - 1.0
        new = values[~upper].mean(), values[upper].mean()
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def region(found: Lines, sigma: float = SIGMA) -> list[bool]:
    """For each line, whether it is in the content region and unmarked."""
    lines, parents, kinds = found.lines, found.parents, found.kinds
    use = [i for i, line in enumerate(lines) if not line[4]]
    if not use:
        return [False] * len(lines)
    free = [0 if m else max(0, len(t) - linked) for t, _, linked, _, m, _ in lines]
    ratios = np.array([n / max(1, line[1]) for n, line in zip(free, lines, strict=True)])
    smooth = smoothed(ratios, sigma)
    cut = threshold(smooth[use])
    # Doubtful elements as a whole: free characters and tags.
    held = np.zeros((found.doubts + 1, 2))
    for i in use:
        held[lines[i][5]] += free[i], lines[i][1]
    dropped = held[:, 0] <= cut * np.maximum(1, held[:, 1])
    dropped[0] = False
    use = [i for i in use if not dropped[lines[i][5]]]
    content = [i for i in use if smooth[i] > cut] or use
    # Characters of content in each container: all, and those outside links, since smoothing
    # lifts a menu beside a paragraph too; and of all lines, all and in links.
    weight, plain, whole, linked = np.zeros((4, len(parents)))
    title = np.zeros(len(parents), bool)
    for i in content:
        weight[lines[i][3]] += len(lines[i][0])
        plain[lines[i][3]] += free[i]
    for i in use:
        whole[lines[i][3]] += len(lines[i][0])
        linked[lines[i][3]] += lines[i][2]
        title[lines[i][3]] |= kinds[lines[i][3]] == "h1"
    apart = plain.copy()
    for k in range(len(parents) - 1, 0, -1):  # children come after their parents
        for sums in (weight, plain, whole, linked):
            sums[parents[k]] += sums[k]
        title[parents[k]] |= title[k]
    # What of a container's content stands in it, or in a part that is no box.
    for k in range(1, len(parents)):
        if kinds[k] not in GROUPS:
            apart[parents[k]] += plain[k]
    named = [k for k in range(len(parents)) if kinds[k] in ("article", "main") and weight[k] > weight[0] / 2]
    best = named[0] if named else 0
    # Down to the lowest container of all the content; inside a named one, to a named one only.
    for k in named[1:] if named else range(1, len(parents)):
        if named:
            deeper = plain[k] == plain[best] > 0
        else:
            nearly = apart[best] == 0 and plain[k] >= (1 - BESIDE) * plain[best]
            most = plain[best] > 0 and (plain[k] == plain[best] or nearly)
            deeper = most and parents[k] == best and kinds[k] in GROUPS and (title[k] or not title[best])
        if deeper:
            best = k
    inside = np.zeros(len(parents), bool)
    inside[best] = True
    for k in range(best + 1, len(parents)):
        links = not named and kinds[k] in GROUPS | LISTS and linked[k] > whole[k] / 2
        inside[k] = inside[parents[k]] and not links
    # Several articles on a page are content alike.
    if kinds[best] == "article":
        for k in range(1, len(parents)):
            inside[k] |= kinds[k] == "article" or inside[parents[k]]
    return [bool(inside[line[3]]) and not line[4] and not dropped[line[5]] for line in lines]


def main_text(html: str | None) -> str:
    parser = Lines()
    page = html or ""
    for start in range(0, len(page), FEED):
        parser.feed(page[start : start + FEED])
    parser.close()
    keep = region(parser) if parser.lines else []
    return "\n".join(line[0] for line, k in zip(parser.lines, keep, strict=True) if k)


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` of every page, with ``text`` and ``n_chars``."""
    given = pages.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keep)], F.col(html).cast("string").alias("html"))
    kinds = [f"k{i} {given.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(iter([batch]), "html"):
                texts = [main_text(h) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    [*part.schema.names[:-1], "text", "n_chars"],
                )

    out = given.mapInArrow(run, ", ".join([*kinds, "text string", "n_chars long"]))
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keep)], "text", "n_chars")
