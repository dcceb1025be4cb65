"""Main text of web pages by text-to-tag ratio.

The standard library's streaming HTML parser gives events; block-level tags end a line, so a
page in one physical line has as many logical lines as blocks.

1. A line's text-to-tag ratio is its characters over its tags.  Structure feeds it: characters
   of links, and of whole navigation, header, footer, sidebar and menu elements, don't count.
2. The ratios are smoothed with a Gaussian, and two-means clustering of their logarithms gives
   the threshold.  Lines whose smoothed ratio reaches it are the content cluster.
3. The cluster selects the content region: from the page downwards, the section inside that holds
   three quarters of the cluster's characters, as long as there is one; an ``article`` (else
   ``main``) around that is taken whole, and several articles are not told apart.  Where it is the
   whole body, the region runs from the first to the last line of the cluster that is high by its own
   ratio or stands beside such lines.  Headings that stand directly before a region outside ``article``
   and ``main`` belong to it.  All lines of the region are returned, however short, but those of the
   landmark elements of step 1 that stay below the threshold.
4. Adverts, notices, forms, scripts, styles, comments of readers and hidden parts are no lines
   of the article wherever they stand; they are cut out before.

Defined cases
-------------
* null or empty html, or no text: an empty string of length 0.
* all ratios are much the same: every line is in the cluster, and sections are told apart by their characters.
* no line reaches a threshold that the caller sets: no text.
* ties: all lines with one ratio are content.
* character references are decoded; white space inside a block (also of ``br``) is one space.
* unclosed and stray end tags are tolerated; a void element opens nothing.
* an unclosed comment, script or style hides the rest of the page, as in a browser.
* a class or id name marks chrome only as a whole name or its first or last part, and never an
  element that holds an ``article`` or ``main`` element or most of the page's text.
* empty tables: an empty result; repeated rows give repeated rows; extra columns pass through
  ``extract`` untouched unless they are named like its results.
* one page must fit in a task's memory; its length is not limited otherwise.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Never text of the page, whatever it holds.
UNSEEN = frozenset("head title script style noscript template iframe object svg math canvas audio video".split())
#: Controls: cut out, but a form that holds most of the page's text is a wrapper.
CONTROLS = frozenset("form button select textarea dialog search".split())
#: Landmarks: their characters don't count in the ratio.
LANDMARKS = frozenset("nav footer aside menu".split())
LANDMARK_ROLES = frozenset("navigation banner contentinfo complementary menu menubar toolbar".split())
CUT_ROLES = frozenset("search form dialog alert alertdialog".split())
#: Words of class and id names that mark landmarks, and what is cut out.
LANDMARK_WORDS = frozenset("nav navbar navigation menu breadcrumb breadcrumbs sidebar side-bar footer pagination pager toolbar".split())
#: The same outside an article; inside one they hold its headline.
HEADER_WORDS = frozenset("header masthead".split())
CUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adslot adbox banner promo promotion sponsor sponsored comment comments "
    "commentlist respond replies disqus cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup login share "
    "sharing social related recommended widget skiplink skip-link".split()
)
#: Parts of a name that say that it speaks of the layout around the thing.
_LAYOUT = frozenset("has no with without layout page site wrapper container content".split())
_ARTICLE, _MAIN = "article", "main"
SECTIONS = frozenset("html body div section article main td center form dialog details fieldset".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_SPACE = re.compile(r"\s+")
_PART = re.compile(r"[-_]+")


def name_marks(value: str, words: frozenset) -> bool:
    """Whether one of the names in a class or id value is such a word, or begins or ends with one."""
    for name in value.lower().split():
        if name in words:
            return True
        parts = _PART.split(name)
        if len(parts) > 1 and not _LAYOUT.intersection(parts) and (parts[0] in words or parts[-1] in words):
            return True
    return False


class _Element:
    """An open or closed element: its parent, and what marks it."""

    __slots__ = ("tag", "parent", "depth", "cut", "landmark", "header", "link", "chars", "holds_article")

    def __init__(self, tag: str, parent: _Element | None):
        self.tag, self.parent, self.depth = tag, parent, parent.depth + 1 if parent else 0
        self.cut = self.landmark = self.header = self.link = self.holds_article = False
        self.chars = 0


class _Lines(HTMLParser):
    """Logical lines: pieces of text with the element that holds each, and the number of tags."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Element("", None)
        self.lines: list[tuple[list, int, bool]] = []
        self.parts: list[tuple[str, _Element]] = []
        self.tags, self.unseen, self.heading = 0, 0, False
        self.marked: list[_Element] = []

    def flush(self):
        if self.parts:
            if any(not t.isspace() for t, _ in self.parts):
                self.lines.append((self.parts, self.tags, self.heading))
                self.tags = 0
            self.parts = []

    def _mark(self, e: _Element, attrs) -> None:
        e.cut, e.landmark, e.header, e.link = e.tag in CONTROLS, e.tag in LANDMARKS, e.tag == "header", e.tag == "a"
        if e.tag in ("html", "body", _ARTICLE, _MAIN):
            return
        for k, v in attrs:
            if k in ("class", "id") and v:
                e.cut |= name_marks(v, CUT_WORDS)
                e.landmark |= name_marks(v, LANDMARK_WORDS)
                e.header |= name_marks(v, HEADER_WORDS)
            elif k == "role" and v:
                e.cut |= v.lower() in CUT_ROLES
                e.landmark |= v.lower() in LANDMARK_ROLES
            elif k == "hidden" or k == "aria-hidden" and v == "true":
                e.cut = True

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.flush()
            if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
                self._close_implied(tag)
        self.tags += 1
        if tag in VOID:
            if tag in ("br", "hr", "wbr") and not self.unseen:
                self.parts.append((" ", self.at))
            return
        self.at = _Element(tag, self.at)
        self.unseen += tag in UNSEEN
        self._mark(self.at, attrs)
        if self.at.cut:
            self.marked.append(self.at)
        if tag in (_ARTICLE, _MAIN):
            up = self.at.parent
            while up and not up.holds_article:
                up.holds_article = True
                up = up.parent
        self.heading = tag in _HEADING or self.heading and tag not in BLOCKS

    def _close_implied(self, tag):
        """A block of the same kind that is still open ends here, unless a container stands between."""
        e = self.at
        while e.parent:
            if e.tag == tag:
                self._close(e)
                return
            if e.tag in BLOCKS and e.tag != "p":
                return
            e = e.parent

    def _close(self, e):
        while self.at is not e.parent:
            self.unseen -= self.at.tag in UNSEEN
            self.at.parent.chars += self.at.chars
            self.at = self.at.parent

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
            self.heading = False
        self.tags += 1
        e = self.at
        while e.parent:
            if e.tag == tag:
                self._close(e)
                return
            e = e.parent

    def handle_data(self, data):
        if not self.unseen:
            self.parts.append((data, self.at))
            self.at.chars += len(data)

    def finish(self):
        self.flush()
        while self.at.parent:
            self._close(self.at)
        for e in self.marked:  # a wrapper of the page isn't what its name says
            if e.holds_article or 2 * e.chars > self.root.chars:
                e.cut = False


def _ways_up(e: _Element) -> list[_Element]:
    out = [e]
    while out[-1].parent:
        out.append(out[-1].parent)
    return out


class Line:
    """A logical line: text, tags, the characters that count in its ratio, whether it's in a landmark or a heading, its section."""

    __slots__ = ("text", "tags", "counted", "landmark", "heading", "section")

    def __init__(self, text, tags, counted, landmark, heading, section):
        self.text, self.tags, self.counted, self.landmark, self.heading, self.section = text, tags, counted, landmark, heading, section

    @property
    def ratio(self) -> float:
        return self.counted / max(1, self.tags)


def logical_lines(html: str) -> list[Line]:
    p = _Lines()
    p.feed(html)
    p.close()
    p.finish()
    known: dict[_Element, tuple] = {p.root: (False, False, False, p.root, False)}

    def state(e):
        """(cut out, in a landmark, in a link, innermost section, in an article) of an element."""
        path = []
        while e not in known:
            path.append(e)
            e = e.parent
        cut, landmark, link, section, article = known[e]
        for e in reversed(path):
            own = (e.landmark or e.header and not article) and not e.holds_article
            cut, landmark, link, article = cut or e.cut, landmark or own, link or e.link, article or e.tag == _ARTICLE
            section = e if e.tag in SECTIONS else section
            known[e] = cut, landmark, link, section, article
        return known[path[0]] if path else known[e]

    out, tags = [], 0
    for parts, n, heading in p.lines:
        tags += n
        kept = [(t, state(e)) for t, e in parts]
        kept = [(t, s) for t, s in kept if not s[0]]
        text = _SPACE.sub(" ", "".join(t for t, _ in kept)).strip()
        if not text:
            continue
        words = [(t, s) for t, s in kept if t.strip()]
        landmark = all(s[1] for _, s in words)
        counted = min(len(text), sum(len(t) for t, s in words if not s[1] and not s[2]))
        out.append(Line(text, tags, counted, landmark, heading, words[0][1][3]))
        tags = 0
    return out


def smoothed(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing over lines, weights normalised at the ends."""
    if len(ratios) < 2 or sigma <= 0:
        return ratios.astype(float)
    r = min(len(ratios) - 1, int(np.ceil(3 * sigma)))
    w = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    full = np.convolve(ratios, w)[r : r + len(ratios)]
    return full / np.convolve(np.ones(len(ratios)), w)[r : r + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """Two-means border of log ratios: half way between the means of low and high lines."""
    if not len(values):
        return 0.0
    v = np.log1p(values)
    low, high = v.min(), v.max()
    if high - low < 1e-9:
        return 0.0
    for _ in range(20):
        upper = v >= (low + high) / 2
        a, b = v[~upper].mean(), v[upper].mean()
        if a == low and b == high:
            break
        low, high = a, b
    return float(np.expm1((low + high) / 2))


#: Lines whose ratios (plus one) lie within this factor are one cluster.
APART = 4
#: Share of the cluster's characters that a section must hold for the region to go into it.
SHARE = 0.75


def _region(lines: list[Line], cluster: np.ndarray) -> _Element:
    """The section that the cluster lies in: from the page downwards, a section inside goes on as long as it holds
    SHARE of the cluster's characters, and isn't one of several articles that hold some.  An article or main element
    around it is taken whole."""
    mass: dict[_Element, int] = {}
    inner: dict[_Element, set] = {}
    for x, c in zip(lines, cluster, strict=True):
        if not c:
            continue
        way = [e for e in _ways_up(x.section) if e.tag in SECTIONS or not e.parent]
        for e, up in zip(way, [*way[1:], None], strict=True):
            mass[e] = mass.get(e, 0) + max(1, x.counted)
            if up is not None:
                inner.setdefault(up, set()).add(e)
    at = next((e for e in mass if not e.parent), lines[0].section)
    while inner.get(at):
        best = max(inner[at], key=mass.__getitem__)
        if mass[best] < SHARE * mass[at] or best.tag == _ARTICLE and sum(e.tag == _ARTICLE for e in inner[at]) > 1:
            break
        at = best
    for tag in (_ARTICLE, _MAIN):
        for e in _ways_up(at):
            if e.tag == tag:
                return e
    return at


def main_text(html: str | None, sigma: float = 1.0, bar: float | None = None) -> str:
    """Text of the content region of a page.  ``bar`` takes the place of the clusters' threshold."""
    lines = logical_lines(html) if html else []
    if not lines:
        return ""
    own = np.array([x.ratio for x in lines])
    smooth = smoothed(own, sigma)
    if bar is None:
        bar = threshold(smooth) if own.max() + 1 >= APART * (own.min() + 1) else 0.0
    cluster = smooth >= bar
    if not cluster.any():
        return ""
    region = _region(lines, cluster)
    holds = {e: region in _ways_up(e) for e in {x.section for x in lines}}
    inside = [holds[x.section] for x in lines]
    if region.tag in ("", "html", "body"):
        # No section stands out: from the first to the last line of the cluster that is high by itself, or has text of
        # its own and stands in the section of such a line.
        high = cluster & (own >= bar)
        known = {x.section for x, y in zip(lines, high, strict=True) if y}
        near = np.array([x.counted > 0 and x.section in known for x in lines])
        found = np.flatnonzero(cluster & (high | near) if high.any() else cluster)
        inside = [found[0] <= i <= found[-1] for i in range(len(lines))]
    first = inside.index(True)
    while region.tag not in (_ARTICLE, _MAIN) and first and lines[first - 1].heading and not lines[first - 1].landmark:
        first -= 1
        inside[first] = True
    all_landmarks = all(x.landmark for x, y in zip(lines, inside, strict=True) if y)
    return "\n\n".join(x.text for x, y, z in zip(lines, inside, own, strict=True) if y and (not x.landmark or z >= bar or all_landmarks))


def extract(pages: DataFrame, html_col: str = "html", carry: list[str] | None = None, sigma: float = 1.0) -> DataFrame:
    """pages (or its columns ``carry``) with ``text`` and ``n_chars``."""
    carry = [c for c in (pages.columns if carry is None else carry) if c not in ("text", "n_chars")]
    src = pages.select(*carry, F.col(html_col).cast("string").alias("__lf_html"))
    schema = T.StructType([*src.schema.fields[:-1], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py(), sigma) for h in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[*batch.schema.names[:-1], "text", "n_chars"],
            )

    return src.mapInArrow(run, schema)
