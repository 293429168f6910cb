"""Main text of web pages by line-block distribution.

Markup is stripped in one pass that keeps a page's block structure: every block becomes a line, and
the borders of layout containers become empty lines. A line weighs its text outside links; lines of
containers that hold no main text by their kind (menus, headers, footers, sidebars, forms, notices,
adverts, comments) and lines outside the page's article, if it has one, weigh nothing. Weights are
summed over sliding windows of lines. Where the sum passes a level taken from the page is a surge, where
it falls back a dive; what lies between a surge and its dive is main text if its weight makes it so, and
so is lighter text that lies between or next to main text in their common container. Links that no window
of main text reaches, as those at an article's end, are none, also in an article.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import rows_of

#: Lines of a sliding window, and empty lines at a container's border (as many, so that windows part).
WINDOW = 3
#: Part of the page's highest sum over a window that is a surge.
LEVEL = 0.05
#: Part of the heaviest run's weight from which another run is main text by itself.
SHARE = 0.2

_NO_TEXT = frozenset("head script style noscript template svg math canvas object iframe audio video map select textarea button".split())
_RAW = frozenset("script style noscript iframe textarea title".split())
_ASIDE = frozenset("nav header footer aside form menu dialog fieldset".split())
_MAIN = frozenset("article main".split())
_BLOCKS = frozenset(
    "address blockquote body caption center dd details dir div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr html li "
    "ol p pre section summary table tbody td tfoot th thead tr ul article main".split()
) | _ASIDE
_CONTAINERS = frozenset("div section body ul ol table".split()) | _MAIN | _ASIDE
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that an opening block ends, as their end tags may be left out.
_ENDED = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
#: Words of a class or id that name a container without main text.
_KIND = re.compile(
    r"ads?|advert(?:s|isements?|ising)?|banners?|sponsor(?:s|ed)?|promos?|promotions?|cookies?|consent|gdpr|notices?|alerts?|popups?|modal|"
    r"overlay|nav(?:s|bar|igation|menu)?|menus?|menubar|breadcrumbs?|sidebars?|foot(?:er)?|header|masthead|comments?|replies|disqus|respond|"
    r"subscribe|newsletter|share|sharing|social|related|recommended|pagination|pager|skiplinks?|search(?:bar|box|form)?|login|signup"
)
#: Kinds that hold articles of others, so that an article in them is the page's own only if there is no other.
_FOREIGN = re.compile(r"ads?|advert\w*|sponsor\w*|promo\w*|nav\w*|menu\w*|sidebars?|comments?|replies|disqus|respond|related|recommended|popups?|modal|overlay")
#: Kinds that are topics as well: the id of a part of an article may be one, and its links decide.
_TOPIC = re.compile(r"related|recommended|social|shar(?:e|ing)|search|alerts?|notices?|consent|cookies?|gdpr|banners?|overlay|nav(?:igation)?|menus?|header")
#: Words by which a name says how something looks or what it has, not what it is.
_MODIFIERS = frozenset("has have no not non with without is hide show toggle".split())
#: Words that may follow a kind in a name, and words that may go before it.
_PARTS = frozenset(
    "list lists item items wrapper wrap container box block bar area section inner outer form field button buttons btn link links icon icons "
    "widget widgets slot unit left right top bottom main primary secondary mobile desktop post posts articles stories thread message row group panel".split()
)
_BEFORE = _PARTS | frozenset("site page global sub user account article entry content blog news reader sticky fixed floating web wp app back side skip".split())
#: By what a container is an aside: a layout's name, a name of a kind that holds foreign articles, its tag or role.
_LAYOUT, _OTHERS, _TAG = 1, 2, 3
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_SPACE = re.compile(r"\s+")
_SENTENCE = re.compile(r"\w\W+\w.*[.!?…。！？:;][\"'”’»)\]]*$", re.DOTALL)
_RIGHTS = re.compile(r"(?:©|\(c\)|copyright\b)", re.IGNORECASE)


def _tag_end(html: str, at: int) -> int:
    """Place after the tag that begins at ``at``; a quoted value may hold ``>``."""
    while True:
        close = html.find(">", at)
        if close < 0:
            return len(html)
        quoted = _QUOTE.search(html, at, close)
        end = html.find(quoted.group(1), quoted.end()) if quoted else -1
        if end < 0:
            return close + 1
        at = end + 1


_QUOTE = re.compile(r"""=\s*(["'])""")


#: A line of a border, before and after it is judged, and its place: most lines of deep markup are such.
_BORDER, _BLANK, _NOWHERE = ("", 0, 0, 0, -1), ("", 0, False, False), (0, False)


class _Line:
    __slots__ = ("parts", "linked", "main", "aside", "doubt", "box", "heading")

    def __init__(self, main: int, aside: int, doubt: int, box: int):
        self.parts: list[str] = []
        self.linked = 0
        self.main, self.aside, self.doubt, self.box = main, aside, doubt, box
        self.heading = False


def _lines(html: str) -> tuple[list[tuple[str, int, bool, bool]], bool, list[tuple[int, bool]], list[tuple[int, str, int]]]:
    """Lines as (text, weight outside links, in an article, in an aside), and whether there is an article.

    Then the container of each line and whether it is a heading, and of each container the one around it, its name
    and its first line. The time is linear in the page, however deep its elements are.

    Articles in a container that is named as one of others' articles count only on pages whose other articles
    have no text; else their lines are in an aside.
    """
    stack: list[tuple[str, int, int, bool, int, int]] = []  # name, main, aside, hidden, doubt, box
    lines: list[tuple[str, int, int, int, int]] = []
    main = aside = 0  # main: 2 in an article, 1 in one among those of others
    hidden = False
    links, doubt = 0, -1
    doubts: list[list[int]] = []  # weight and length of the parts that are asides if they are links
    boxes, box = [(-1, "", 0)], 0
    # Places in the stack: of the open elements of each name, of blocks, and of containers.
    opened: dict[str, list[int]] = {}
    blocks: list[int] = []
    containers: list[int] = []
    places: list[tuple[int, bool]] = []
    line = _Line(main, aside, doubt, box)

    def end_line() -> None:
        nonlocal line
        text = _SPACE.sub(" ", "".join(line.parts)).strip()
        if text:
            weight = max(len(text) - line.linked, 0)
            lines.append((text, weight, line.main, line.aside, line.doubt))
            places.append((line.box, line.heading))
            if line.doubt >= 0:
                doubts[line.doubt][0] += weight
                doubts[line.doubt][1] += len(text)
        line = _Line(main, aside, doubt, box)

    def border() -> None:
        end_line()
        places.extend([_NOWHERE] * WINDOW)
        lines.extend([_BORDER] * WINDOW)

    def close(count: int) -> None:
        nonlocal main, aside, hidden, doubt, box, links
        for _ in range(count):
            name, main, aside, hidden, doubt, box = stack.pop()
            opened[name].pop()
            if name in _BLOCKS:
                blocks.pop()
            if name in _CONTAINERS:
                containers.pop()
            if name == "a":
                links = max(links - 1, 0)

    def last(name: str) -> int:
        """Place in the stack of the innermost open element of a name, -1 if there is none."""
        places = opened.get(name)
        return places[-1] if places else -1

    at, n = 0, len(html)
    while at < n:
        mark = html.find("<", at)
        if mark != at:
            text = html[at : n if mark < 0 else mark]
            if not hidden:
                text = unescape(text)
                line.parts.append(text)
                if links:
                    line.linked += len(_SPACE.sub(" ", text))
            if mark < 0:
                break
        if html.startswith("<!--", mark):
            end = html.find("-->", mark + 4)
            at = n if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), mark):
            end = html.find(">", mark)
            at = n if end < 0 else end + 1
            continue
        closing = html.startswith("</", mark)
        found = _NAME.match(html, mark + 1 + closing)
        if not found:  # a lone sign is text
            if closing:
                end = html.find(">", mark)
                at = n if end < 0 else end + 1
            else:
                if not hidden:
                    line.parts.append("<")
                at = mark + 1
            continue
        name = found.group().lower()
        at = _tag_end(html, mark)
        if closing:
            place = last(name)
            # An end tag of a phrase does not end the blocks around it.
            if place >= 0 and (name in _BLOCKS or name in _NO_TEXT or not blocks or blocks[-1] < place):
                (border if name in _CONTAINERS else end_line if name in _BLOCKS else int)()
                close(len(stack) - place)
                line.main, line.aside, line.doubt, line.box = main, aside, doubt, box
            elif name in _BLOCKS:
                end_line()
            continue
        if name == "br":
            line.parts.append(" ")
            continue
        tag = html[found.end() : at]
        if name in _BLOCKS:
            (border if name in _CONTAINERS else end_line)()
            if name != "html" and opened.get("head"):  # its end tag may be left out
                close(len(stack) - opened["head"][0])
            place = max(last(e) for e in _ENDED.get(name, ("p",)))
            if place > (containers[-1] if containers else -1):
                close(len(stack) - place)
        if name in _VOID or tag.rstrip().endswith("/>") and name not in _BLOCKS:
            continue
        opened.setdefault(name, []).append(len(stack))
        if name in _BLOCKS:
            blocks.append(len(stack))
        if name in _CONTAINERS:
            containers.append(len(stack))
        stack.append((name, main, aside, hidden, doubt, box))
        hidden = hidden or name in _NO_TEXT
        if name in _MAIN:
            others = aside == _OTHERS or main == 1
            # A layout's name says nothing about an article in it.
            aside = aside if aside == _TAG else 0
            main = 1 if others else 2
        if name in _ASIDE:
            # The header of an article holds its title.
            aside = aside if name == "header" and main else _TAG
        elif name in _CONTAINERS and name != "body":
            kind, in_doubt = _aside_kind(tag, bool(main))
            aside = max(aside, kind)
            if in_doubt:
                doubt = len(doubts)
                doubts.append([0, 0])
        if name == "a":
            links += 1
        if name in _CONTAINERS:
            boxes.append((box, name, len(lines)))
            box = len(boxes) - 1
        line.main, line.aside, line.doubt, line.box = main, aside, doubt, box
        line.heading = name in _HEADINGS or line.heading and name not in _BLOCKS
        if name in _RAW:
            end = _raw_end(html, name, at)
            if name == "title" or name in _NO_TEXT:
                at = end
    end_line()
    linked = [2 * weight <= length for weight, length in doubts]
    judged = [(text, weight, m, bool(a) or d >= 0 and linked[d]) if text else _BLANK for text, weight, m, a, d in lines]
    best = max((m for text, _, m, a in judged if text and not a), default=0)
    told = [(text, weight, m > 0 and m >= best, a or 0 < m < best) if text else _BLANK for text, weight, m, a in judged]
    return told, best > 0, places, boxes


def _raw_end(html: str, name: str, at: int) -> int:
    """Where the end tag of an element begins whose content is not markup."""
    found = re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE).search(html, at)
    return found.start() if found else len(html)


def _aside_kind(tag: str, main: bool) -> tuple[int, bool]:
    """As what class, id or role name a container without main text or hide it, 0 if they don't; whether its links decide."""
    kind, doubt = 0, False
    if "=" not in tag and "hidden" not in tag:
        return kind, doubt
    for m in _ATTRIBUTE.finditer(tag):
        name, value = m.group(1).lower(), (m.group(2) or "").strip("\"'").lower()
        if name == "role" and value in _ROLES or name == "hidden":
            return _TAG, False
        if name in ("class", "id"):
            for token in value.split():
                word = _kind_word(token, name == "class" and not main)
                if not word or main and name == "class" and word in ("header", "masthead"):
                    continue
                if main and name == "id" and _TOPIC.fullmatch(word):
                    doubt = True
                else:
                    kind = max(kind, _OTHERS if _FOREIGN.fullmatch(word) else _LAYOUT)
    return kind, doubt and not kind


def _kind_word(token: str, any_before: bool) -> str | None:
    """The kind that a name of a class or id stands for.

    The last word says what it is, but for words such as ``list``: a page-header is a header, a search-page a
    page. Names with has-, no- or with- and topics of several words, as social-impact or data-sharing, are none.
    """
    words = [w for w in re.split("[-_]+", token.replace("side-bar", "sidebar").replace("skip-link", "skiplink")) if w]
    if _MODIFIERS.intersection(words):
        return None
    while words and (words[-1] in _PARTS or words[-1].isdigit()):
        words.pop()
    if not words or not _KIND.fullmatch(words[-1]):
        return None
    before = words[:-1]
    if any_before or all(w in _BEFORE or w.isdigit() or _KIND.fullmatch(w) for w in before):
        return words[-1]
    return None


def main_text(html: str | None) -> str:
    """Main text of a page: its blocks in order, joined by an empty line."""
    if not html:
        return ""
    lines, has_main, places, boxes = _lines(html)
    shown = [text != "" and not aside and (main or not has_main) for text, _, main, aside in lines]
    weights = [line[1] if s else 0 for line, s in zip(lines, shown, strict=True)]
    if not any(weights):
        # All that there is are links, so they are the text.
        weights = [len(text) if s else 0 for (text, *_), s in zip(lines, shown, strict=True)]
    runs = surges(weights)
    least = SHARE * max((w for *_, w in runs), default=0)
    heavy = [i for a, b, w in runs if w >= least for i in range(a, b) if shown[i]]
    kept = _with_neighbours(heavy, lines, shown, places, boxes, has_main)
    return "\n\n".join(lines[i][0] for i in kept)


def surges(weights: list[int], window: int = 0) -> list[tuple[int, int, int]]:
    """Runs of lines from a surge to its dive, as (first line, line after the last, weight).

    The sum over a sliding window of lines surges where it passes ``LEVEL`` of the page's highest sum, and dives
    where it falls back. A run is what its windows cover, so it reaches beyond its heavy lines by less than a window.
    """
    window = window or WINDOW
    before = np.concatenate((np.zeros(window, np.int64), np.cumsum(np.asarray(weights, np.int64))))
    # The i-th window ends with line i; those at the end reach beyond the page.
    sums = np.concatenate((before[window:], np.full(window - 1, before[-1]))) - before[: len(weights) + window - 1]
    above = (sums > 0) & (sums >= LEVEL * sums.max(initial=0))
    turns = np.flatnonzero(np.diff(np.concatenate(([False], above, [False]))))
    runs: list[tuple[int, int, int]] = []
    end = 0
    for surge, dive in turns.reshape(-1, 2).tolist():
        # Lines that windows before this surge have covered belong to the run before.
        start, end = max(surge - window + 1, end), min(dive, len(weights))
        runs.append((start, end, int(before[end + window - 1] - before[start + window - 1])))
    return runs


def _with_neighbours(heavy: list[int], lines: list, shown: list[bool], places: list, boxes: list, has_main: bool) -> list[int]:
    """Heavy lines of a page and the lighter ones that belong to them, in order.

    A block is what lies between two borders. Of a block with heavy lines, all belongs together but links before the
    first and after the last line that is heavy, text or a heading. Other blocks of text belong to the heavy lines if
    they lie between two, have a common container with lines of them, go before them as titles and intros do, or follow
    as a heading, list, table or sentence; a fragment or notice of rights after them in a container of its own does
    not. In an article all text belongs to it. Blocks of links belong to the heavy lines if they stand amid the lines
    of one container.
    """
    if not heavy:
        return heavy
    last, taken = heavy[-1], set(heavy)
    spans: dict[int, tuple[int, int]] = {}  # first and last heavy line that lies directly in a container
    for i in heavy:
        box = places[i][0]
        spans[box] = (spans.get(box, (i, i))[0], i)
    # Of each container: whether it or one around it holds heavy lines, whether it is or lies in a list or table,
    # and the last heavy line that lies directly in one around it which also holds one before the container.
    around = [(0 in spans, False, -1)]
    for box, (outer, name, first) in enumerate(boxes[1:], 1):
        near, listed, until = around[outer]
        if outer in spans and spans[outer][0] < first:
            until = max(until, spans[outer][1])
        around.append((near or box in spans, listed or name in ("ul", "ol", "table"), until))
    kept, at, n = [], 0, len(lines)
    while at < n:
        end = at + 1
        if not lines[at][0]:
            at = end
            continue
        while end < n and lines[end][0]:
            end += 1
        block = [i for i in range(at, end) if shown[i]]
        if taken.intersection(block):
            sure = [i for i in block if i in taken or places[i][1] or 2 * lines[i][1] > len(lines[i][0])]
            kept += [i for i in block if sure[0] <= i <= sure[-1]]
        elif block:
            weight, length = sum(lines[i][1] for i in block), sum(len(lines[i][0]) for i in block)
            box = places[block[0]][0]
            near, listed, until = around[box]
            amid = until > at or box in spans and spans[box][0] < at < spans[box][1]
            heading = any(places[i][1] for i in block)
            belongs = amid or 2 * weight > length or heading
            if belongs and not (amid or has_main or at < last):
                text = " ".join(lines[i][0] for i in block)
                belongs = (near or heading or listed or _SENTENCE.search(text)) and not _RIGHTS.match(text)
            if belongs:
                kept += block
        at = end
    return kept


def _extract(batches):
    schema = pa.schema([("text", pa.string()), ("n_chars", pa.int64())])
    for batch in batches:
        texts = [main_text(html.decode()) if html else "" for (html,) in rows_of([batch], "_html")]
        kept = range(batch.num_columns - 1)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in kept), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            schema=pa.schema([*(batch.schema.field(i) for i in kept), *schema]),
        )


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """The rows with ``text``, the page's main text, and ``n_chars``, its code points, in place of the page.

    A null or empty page, or one without main text, has an empty text. All rows are kept, repeated ones too, and
    all other columns, except that columns of the two names are replaced.
    """
    others = [c for c in pages.columns if c not in (html_column, "text", "n_chars")]
    names = [f"c{i}" for i in range(len(others))]
    plain = pages.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(others, names, strict=True)), F.col(html_column).alias("_html"))
    schema = ", ".join([*(f"{n} {t}" for n, t in plain.drop("_html").dtypes), "text string, n_chars bigint"])
    return plain.mapInArrow(_extract, schema).toDF(*others, "text", "n_chars")
