"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing and threshold clusters."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow.llm.shared import text_of

#: Fixed values of HTML: elements that end a line of text, that have no content, and whose content is no page text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noframes ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "head script style template noscript noframes iframe object svg math canvas audio video map datalist select textarea button "
    "form fieldset label nav aside footer menu dialog search title".split()
)
#: Words in a class, id or role that mark a part of the page as no article text.
SIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertorial banner banners sponsor sponsored sponsors promo promos promotion nav navbar "
    "navigation menu menus breadcrumb breadcrumbs pagination pager sidebar sidebars aside rail widget widgets footer foot masthead "
    "topbar toolbar header cookie cookies consent gdpr notice notices notification alert disclaimer copyright popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social follow related recommended recommendations trending popular "
    "comment comments commentlist reply replies respond responses disqus discussion feedback form search skip toc complementary "
    "contentinfo dialog secondary hidden".split()
)
#: Side words that hold for comments, advertisements and teasers also beside main words.
CERTAIN_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements sponsor sponsored sponsors promo promos related recommended recommendations "
    "comment comments commentlist reply replies respond responses disqus feedback cookie cookies consent gdpr".split()
)
#: Side words that leave out the text of an inline element as well, besides the certain ones.
INLINE_WORDS = frozenset("share sharing social subscribe newsletter login signup banner hidden".split())
#: Names written as one word that begin so are advertisements.
JOINED = re.compile(r"(?:promo|advert|sponsor|ad(?=box|slot|unit|banner|block|space|wrap|wrapper|container|zone|area|text)).+")
#: Side words that inside an article may as well be its matter; the ratios of the lines decide.
DOUBTFUL_WORDS = frozenset("discussion popular trending notice notices notification alert disclaimer copyright form search rail follow foot dialog skip".split())
#: Before a side word these say what a page has or lacks, not what the element is.
MODIFIERS = frozenset("has no not with without".split())
#: Words that mark the article itself; a name of these only overrules side words of the same element.
MAIN_WORDS = frozenset("article main content post entry story body text page".split())
_WORD = re.compile(r"[a-z]+")
_BLANK = re.compile(r"\s+")
#: Fixed values of HTML: a start tag in the key ends an open element of the value.
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
CONTAINERS = frozenset("article body center div html main section table tbody td tr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Characters of a line that may stand as a paragraph outside of a page's article or main, and lines that a heading may stand above.
ALONE, ABOVE = 25, 3
ENDS_P = BLOCKS - {"body", "head", "html", "title", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "legend"} | {"li", "dd", "dt"}


#: What an open element is: part of the content, in a block of side matter, or in side matter within a line, whose text goes.
CONTENT, SIDE_BLOCK, SIDE_RUN = range(3)


class Lines(HTMLParser):
    """Turns parser events into lines: text between block boundaries, with its tags, links and open elements.

    Text of side matter within a line, such as a button, doesn't enter the line.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, int]] = [("", 0, CONTENT)]  # name, number, what it or one around it is
        self.count = 0
        self.parents = {0: 0}
        self.names = {0: ""}
        self.doubtful: dict[int, tuple[bool, bool]] = {}  # elements with side words: whether these are certain; whether the lines decide
        self.rows: list[tuple[str, int, int, int, bool]] = []
        self.text: list[str] = []
        self.tags = 0
        self.linked = 0
        self.links = 0

    def end_line(self) -> None:
        text = _BLANK.sub(" ", "".join(self.text)).strip()
        if text:
            self.rows.append((text, self.tags, self.linked, self.open[-1][1], self.open[-1][2] != CONTENT))
            self.tags = 0
        self.text, self.linked = [], 0

    def is_side(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in SILENT:
            return True
        inside = any(name in ("article", "main") for name, _, _ in self.open)
        if tag == "header":
            return not inside
        if tag in ("html", "body", "main", "h1", "h2", "h3", "h4", "h5", "h6"):
            return False
        said = dict(attrs)
        if "hidden" in said or (said.get("aria-hidden") or "").lower() == "true" or re.search(r"display\s*:\s*none", (said.get("style") or "").lower()):
            return True
        names = [{JOINED.sub("ad", word) for word in _WORD.findall(name)} for k in ("class", "id", "role") for name in (said.get(k) or "").lower().split()]
        side = set().union(*(n & SIDE_WORDS for n in names if not n & MODIFIERS))
        if inside:
            side -= {"header", "body", "text"}
        if not side:
            return False
        if not side & CERTAIN_WORDS and any(n and n <= MAIN_WORDS for n in names):
            return False
        if tag not in BLOCKS:
            return bool(side & (CERTAIN_WORDS | INLINE_WORDS))
        self.doubtful[self.count] = (bool(side & CERTAIN_WORDS), inside and side <= DOUBTFUL_WORDS)
        return False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCKS:
            if self.open[-1][2] != SIDE_RUN:
                self.end_line()
            if tag in ENDS_P:
                self.close_implied({"p"}, BLOCKS - {"p"})
            if tag in CLOSES:
                self.close_implied(CLOSES[tag], {"ul", "ol", "dl", "table", "menu", "select"})
        elif tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        self.links += tag == "a"
        self.count += 1
        self.parents[self.count], self.names[self.count] = self.open[-1][1], tag
        around = self.open[-1][2]
        if around == CONTENT and self.is_side(tag, attrs):
            around = SIDE_BLOCK if tag in BLOCKS else SIDE_RUN
        self.open.append((tag, self.count, around))

    def close_implied(self, names: set[str], fence: frozenset[str] | set[str]) -> None:
        """Ends the innermost open element of these names, unless an element of the fence lies further in."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] in names:
                self.cut(i)
                return
            if self.open[i][0] in fence:
                return

    def inside_run(self, tag: str) -> bool:
        """Whether the innermost open element of a name lies in side matter within the line."""
        return next((around == SIDE_RUN for name, _, around in reversed(self.open) if name == tag), True)

    def cut(self, i: int) -> None:
        self.links -= sum(name == "a" for name, _, _ in self.open[i:])
        del self.open[i:]

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS and self.open[-1][0] == tag:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS and not (self.open[-1][2] == SIDE_RUN and self.inside_run(tag)):
            self.end_line()
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                self.cut(i)
                return
            if tag not in BLOCKS and self.open[i][0] in BLOCKS and self.open[i][2] != SIDE_RUN:
                return  # the end of an inline element doesn't end the blocks around it

    def handle_data(self, data: str) -> None:
        if self.open[-1][0] in ("script", "style") or self.open[-1][2] == SIDE_RUN:
            return
        self.text.append(data)
        if self.links:
            self.linked += len(data)

    def close(self) -> None:
        super().close()
        self.end_line()


def smoothed(values: np.ndarray, radius: int = 2) -> np.ndarray:
    """Gaussian average of each value and its neighbours; the ends weigh what is there."""
    at = np.arange(-radius, radius + 1)
    kernel = np.exp(-((at / max(radius / 2, 0.5)) ** 2) / 2)
    wide = lambda v: np.convolve(v, kernel, mode="full")[radius : radius + len(v)]
    return wide(values) / wide(np.ones(len(values)))


def content_lines(rows: list[tuple[str, int, int, int, bool]]) -> np.ndarray:
    """Lines in the upper cluster of smoothed text-to-tag ratios.

    Ratios are split at a threshold that starts at their standard deviation and moves to the middle between the
    means of both clusters until it stays. Text in links doesn't count as text.
    """
    ratio = np.array([0.0 if side else max(0, len(text) - linked) / max(1, tags) for text, tags, linked, _, side in rows])
    smooth = smoothed(ratio)
    threshold = min(float(smooth.std()), float(smooth.max()) / 2)
    for _ in range(50):
        high = smooth > threshold
        if high.all() or not high.any():
            break
        new = min(float(smooth[high].mean() + smooth[~high].mean()) / 2, float(smooth.std()) or threshold)
        if abs(new - threshold) < 1e-9:
            break
        threshold = new
    return (smooth > threshold) | (smooth >= smooth.max()) if len(rows) else np.zeros(0, bool)


def without_side(parser: Lines, paths: list[set[int]]) -> list[tuple[str, int, int, int, bool]]:
    """The lines of a page, with those in elements that have side words marked too.

    Such an element is no side matter if it holds an article or main that is none, if it is a doubtful one in an article
    and most of its text lies in content lines, or if most of the page's content is in it and no article or main is left
    otherwise. Elements with certain side words stay side matter.
    """
    rows, side = parser.rows, set(parser.doubtful)
    if not side:
        return rows
    for n, name in parser.names.items():
        if name in ("article", "main") and n not in side:
            above, passed = parser.parents.get(n, 0), []
            while above:
                passed.append(above)
                above = parser.parents[above]
            if not any(parser.doubtful.get(k, (False, False))[0] for k in passed):
                side -= set(passed)
    good = content_lines(rows)
    size = [len(text) - linked for text, _, linked, _, _ in rows]
    content: dict[int, int] = {}
    plain: dict[int, int] = {}
    for n, path, g, row in zip(size, paths, good, rows, strict=True):
        for k in () if row[4] else path & (side | {0}):
            content[k] = content.get(k, 0) + n * bool(g)
            plain[k] = plain.get(k, 0) + n
    side -= {n for n in side if parser.doubtful[n][1] and 2 * content.get(n, 0) > plain.get(n, 0)}
    left = [path for row, path in zip(rows, paths, strict=True) if not row[4] and not path & side]
    if not any(parser.names[n] in ("article", "main") for path in left for n in path):
        side -= {n for n in side if not parser.doubtful[n][0] and 2 * content.get(n, 0) > content.get(0, 0)}
    return [(*row[:4], row[4] or bool(path & side)) for row, path in zip(rows, paths, strict=True)]


def main_text(html: str | None) -> str:
    """The text of the parts of a page that hold its content lines, without side matter, one line per block.

    Lines in the upper cluster of text-to-tag ratios choose the containers: each one that holds such a line directly is
    taken with its other direct lines, and with what lies deeper if half of its text is in such lines. Lines that are
    mostly links go, unless they are paragraphs or stand in an article among lines that mostly aren't. Headings above a taken line, and the few lines between, are taken too.
    Article and main are hints: a line outside them needs ALONE characters, and one of them is taken if no container is.
    """
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    if not parser.rows:
        return ""
    chains, paths = [], []
    for _, _, _, number, _ in parser.rows:
        chain = [number]
        while number:
            number = parser.parents[number]
            chain.append(number)
        chains.append(chain)
        paths.append(set(chain))
    rows = without_side(parser, paths)
    upper = content_lines(rows)
    linkish = [2 * linked > len(text) and "p" not in (parser.names[n] for n in chain[:3]) for (text, _, linked, _, _), chain in zip(rows, chains, strict=True)]
    beside: dict[int, list[int]] = {}  # for each element its lines, text and linked text
    for text, _, linked, _, _, chain in ((*row, chain) for row, chain in zip(rows, chains, strict=True)):
        for n in chain:
            lines_in, size, links_in = beside.get(n, (0, 0, 0))
            beside[n] = [lines_in + 1, size + len(text), links_in + linked]
    for i, chain in enumerate(chains):
        if linkish[i] and any(parser.names[n] in ("article", "main") for n in chain):
            _, size, links_in = next((beside[n] for n in chain if beside[n][0] > 1), beside[chain[0]])
            linkish[i] = 2 * links_in > size
    home = [next((n for n in chain if parser.names[n] in CONTAINERS), 0) for chain in chains]
    weight: dict[int, int] = {}
    plain: dict[int, int] = {}
    for (text, _, linked, _, side), chain, good in zip(rows, chains, upper, strict=True):
        for number in () if side else chain:
            weight[number] = weight.get(number, 0) + (len(text) - linked) * bool(good)
            plain[number] = plain.get(number, 0) + len(text)
    marked = {n for n in plain if parser.names[n] in ("article", "main")}
    regions = set()
    for (text, _, _, _, side), path, good, own, links in zip(rows, paths, upper, home, linkish, strict=True):
        if good and not side and not links and (not marked or path & marked or len(text) >= ALONE):
            regions.add(own)
    if marked and not any(weight[n] for n in marked):
        regions.add(max(marked, key=lambda n: (plain[n], -n)))
    dense = {n for n in regions if parser.names[n] not in ("", "html", "body") and 2 * weight[n] >= plain[n]}
    taken = []
    for (text, _, _, _, side), path, good, own, links in zip(rows, paths, upper, home, linkish, strict=True):
        far = bool(marked) and not path & marked and len(text) < ALONE
        taken.append(not side and not links and (own in regions or bool(path & dense)) and not (far and good))
    lines = [i for i, row in enumerate(rows) if not row[4]]
    for at, i in enumerate(lines):
        if not taken[i] and any(parser.names[n] in HEADINGS for n in chains[i]):
            ahead = lines[at + 1 : at + 2 + ABOVE]
            to = next((k for k, j in enumerate(ahead) if taken[j]), None)
            if to is not None and not any(linkish[j] for j in ahead[:to]):
                for j in (i, *ahead[:to]):
                    taken[j] = True
    return "\n".join(row[0] for row, good in zip(rows, taken, strict=True) if good)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, url, the page's main text and its length in code points, for each page.

    Null and empty pages, and pages with side matter only, give an empty text. Broken markup is read as far as the parser goes;
    pages may have any length and are read whole.
    Repeated rows are extracted each; columns other than page_id, url and the page itself are left out, whatever
    their names. An empty table gives an empty result.
    """

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text)

    found = pages.select("page_id", "url", texts(text_of(html)).alias("text"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
