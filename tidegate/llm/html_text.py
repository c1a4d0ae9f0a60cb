"""Main text of web pages by tag-path ratios.

For each page, text nodes are gathered by their root-to-leaf tag path (with classes and ids of the
elements). A path's text ratio is its characters outside links, its punctuation ratio its marks, both over the root of
its number of blocks, so that many short blocks count less than few long ones; they are fused into one score, text *
(1 + marks). Scores are smoothed over the tree of
paths: a box has the sum of the paths right below it and a quarter of what deeper boxes have, and a path
stands with the box around it, so that a heading or a short paragraph stands with its neighbours. The page itself
is no box. Paths whose smoothed score reaches `cut` times the best one are content.

What elements say of themselves is a bounded factor: words of classes, ids and roles for adverts, menus or comments
divide a path's score by thirty; `article`, `main` and such words double it, and all paths below the outermost of these
stand with it. Inside it only a whole class or id counts, not a word of one. Elements that are no article text by
definition (navigation, headers, footers, asides, forms) have no score.

Text of content paths is given in page order: character references are decoded, white space inside a
block becomes one space, inline elements do not end a block, and blocks are joined by one space.

Pages are read each on its own inside tasks, so nothing is shuffled. Time and memory grow with the length of the page,
however deep it is nested and however many paths it has. Null, empty and text-less pages
give the empty text. Unclosed elements end with their container, and a tag cut off by the end of the
page is dropped. A quote that is never closed, or stands inside an unquoted value, is a character like any
other. Repeated pages and other columns pass through.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidegate.llm.texts import annotate

# Element names of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title svg math iframe object select xmp".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
ASIDE = set("nav header footer aside form button dialog menu fieldset figcaption head".split())
CONTENT = set("article main".split())
#: Elements that end an open paragraph.
ENDS_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
SCOPES = set("article aside body div footer header html main nav ol section table td th ul form".split())
#: Words of a class, id or role that rule an element out.
ASIDE_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu|menubar|breadcrumbs?|header|masthead|footer|foot|sidebar|side|aside|"
    r"complementary|contentinfo|search|form|login|signup|subscribe|newsletter|cookies?|consent|gdpr|notice|notices|alert|popup|modal|overlay|toolbar|share|sharing|social|"
    r"comments?|comment-list|disqus|replies|reply|respond|related|recommend\w*|widget|pagination|pager|copyright|legal|hidden|skip-link)(?=$|[\s_-])", re.I)
CONTENT_NAME = re.compile(r"(?:^|[\s_-])(?:article|content|main|post|entry|story|body-text|text)(?=$|[\s_-])", re.I)

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*))*)(?:>|$)", re.S)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_DIGITS = re.compile(r"\d+")
_MARKS = re.compile(r"[.,;:!?…。，、；：！？]")


#: What a word against a path and a word for it make of its score, and what a box counts of the boxes below it.
AGAINST, FOR, DEEPER = 1 / 30, 2.0, 0.25


class Page:
    """The text nodes of a page, (path, whether in a link, text, block number), and the tree of its paths.

    Paths are numbers: `parents` and `labels` name the path above and the last element. Inline elements are no part of a path.
    """

    def __init__(self, source: str):
        self.nodes: list[tuple[int, bool, str, int]] = []
        self.parents, self.labels = [-1], [""]
        self._numbers: dict[tuple[int, str], int] = {}
        self.block = 0
        # The open elements, the path at each, and where in the stack each name, scope and block element stands.
        self._stack: list[str] = []
        self._paths = [0]
        self._where: dict[str, list[int]] = defaultdict(list)
        self._scopes: list[int] = []
        self._blocks: list[int] = []
        at, size = 0, len(source)
        while at < size:
            found = _TOKEN.search(source, at)
            end = found.start() if found else size
            if end > at:
                self._text(source[at:end])
            if not found:
                break
            at = found.end()
            name = (found[2] or "").lower()
            if not name:
                continue
            if not found[0].endswith(">"):  # cut off
                break
            if found[1]:
                self._end(name)
            elif name in RAW and not found[3].endswith("/"):
                closing = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|$)", re.I).search(source, at)
                at = closing.end() if closing else size
            else:
                self._start(name, found[3])

    def _start(self, name: str, attributes: str) -> None:
        ends = SAME_ENDS.get(name, set()) | ({"p"} if name in ENDS_P else set())
        # The innermost scope bounds the search; a cell or row ends the cell before it, which is a scope itself.
        scope = self._scopes[-1] if self._scopes else -1
        if name in ("tr", "td", "th"):
            while scope >= 0 and self._stack[scope] in ("td", "th") and self._stack[scope] not in ends:
                scope = next((s for s in reversed(self._scopes) if s < scope), -1)
        open_at = max((self._where[e][-1] for e in ends if self._where[e]), default=-1)
        if open_at >= max(scope, 0) and (open_at > scope or self._stack[open_at] in ends):
            self._close(open_at)
        if name not in INLINE:
            self.block += 1
        if name in VOID or (attributes.endswith("/") and name not in INLINE | SCOPES | {"p", "li"}):
            return
        place, path = len(self._stack), self._paths[-1]
        if name not in INLINE:
            said = " ".join(m.strip("\"'") for m in _NAMED.findall(attributes)) if attributes else ""
            if attributes and _HIDDEN.search(attributes):
                said += " hidden"
            # Numbered names count as one, so that a long list has few paths.
            path = self._path(path, f"{name} {_DIGITS.sub('0', said)}" if said else name)
            self._blocks.append(place)
        self._stack.append(name)
        self._paths.append(path)
        self._where[name].append(place)
        if name in SCOPES:
            self._scopes.append(place)

    def _end(self, name: str) -> None:
        if self._where[name]:
            keep = self._where[name][-1]
            # An inline end tag does not close the blocks that were opened inside.
            if name not in INLINE or not self._blocks or self._blocks[-1] < keep:
                self._close(keep)
        if name not in INLINE:
            self.block += 1

    def _path(self, parent: int, label: str) -> int:
        number = self._numbers.setdefault((parent, label), len(self.parents))
        if number == len(self.parents):
            self.parents.append(parent)
            self.labels.append(label)
        return number

    def _close(self, keep: int) -> None:
        if self._blocks and self._blocks[-1] >= keep:
            self.block += 1
        for places in (self._blocks, self._scopes):
            while places and places[-1] >= keep:
                places.pop()
        while len(self._stack) > keep:
            self._where[self._stack.pop()].pop()
            self._paths.pop()

    def _text(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        if text:
            self.nodes.append((self._paths[-1], bool(self._where["a"]), text, self.block))


def said_of(page: Page, names: bool = True) -> tuple[list[float], list[int]]:
    """For each path the factor of what its elements say, and the outermost content element above it (-1: none)."""
    factor, content = [1.0], [-1]
    for number in range(1, len(page.parents)):
        above = page.parents[number]
        name, _, said = page.labels[number].partition(" ")
        own, box = factor[above], content[above]
        if name in ("html", "body"):
            said = ""
        if names and own:
            # Inside content a whole class or id counts; elsewhere a word of one does as well.
            against = any(ASIDE_NAME.fullmatch(w) for w in said.split()) if box >= 0 else said and ASIDE_NAME.search(said)
            if name in ASIDE:
                own = 0.0
            elif against:
                own *= AGAINST
            elif box < 0 and own == 1.0 and (name in CONTENT or (said and CONTENT_NAME.search(said))):
                own, box = FOR, number
        factor.append(own)
        content.append(box)
    return factor, content


def path_scores(page: Page, names: bool = True) -> list[float]:
    """Fused and smoothed score of every path of a page; without `names`, by the ratios alone."""
    n = len(page.parents)
    chars, marks, count, last = [0] * n, [0] * n, [0] * n, [-1] * n
    for path, in_link, text, block in page.nodes:
        size = len(text.strip())
        if size:
            count[path] += block != last[path]
            last[path] = block
            if not in_link:
                chars[path] += size
                marks[path] += len(_MARKS.findall(text))
    factor, content = said_of(page, names)
    fused = [f * c / k**0.5 * (1 + m / k**0.5) if k else 0.0 for f, c, m, k in zip(factor, chars, marks, count)]
    # Paths are numbered after the path above them: from the last on, boxes gather what is below, from the first on they hand it down.
    leaf = [True] * n
    for number in range(1, n):
        leaf[page.parents[number]] = False
    page_itself = [page.labels[number].partition(" ")[0] in ("", "html", "body") for number in range(n)]
    box = list(fused)
    whole = list(fused)
    for number in range(n - 1, 0, -1):
        above = page.parents[number]
        box[above] += box[number] if leaf[number] else DEEPER * box[number]
        whole[above] += whole[number]
    scores = []
    for number in range(n):
        above = page.parents[number]
        if not factor[number]:
            scores.append(0.0)
        elif content[number] >= 0 and factor[number] == factor[content[number]]:
            scores.append(whole[content[number]])
        elif number == 0 or page_itself[above]:
            scores.append(fused[number] if leaf[number] else max(fused[number], DEEPER * box[number]))
        else:
            own = fused[number] if leaf[number] else box[number]
            scores.append(max(own, box[above] * min(1.0, factor[number] / factor[above])))
    return scores


def main_blocks(source: str | None, cut: float = 0.3, names: bool = True) -> list[str]:
    """The blocks of content in page order, without empty ones."""
    page = Page(source or "")
    scores = path_scores(page, names)
    # Only paths with text of their own set the mark.
    best = max((scores[path] for path, _, text, _ in page.nodes if text.strip()), default=0.0)
    blocks: list[list[str]] = []
    last = None
    for path, _, text, block in page.nodes:
        if best > 0 and scores[path] >= cut * best:
            if block != last:
                blocks.append([])
            blocks[-1].append(text)
            last = block
    joined = (" ".join("".join(b).split()) for b in blocks)
    return [b for b in joined if b]


def main_text(source: str | None, cut: float = 0.3) -> str:
    return " ".join(main_blocks(source, cut))


EXTRACTED = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def extract_text(pages: DataFrame, source: str = "html", name: str = "main", cut: float = 0.3) -> DataFrame:
    """`pages` with the struct `name`: the main text of the column `source`, and its code points."""

    def extract(sources: list) -> list[tuple]:
        texts = [main_text(s, cut) for s in sources]
        return [(t, len(t)) for t in texts]

    return annotate(pages, source, name, EXTRACTED, extract)
