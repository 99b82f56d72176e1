"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block element. A line counts with the length of
its text, or not at all where its element is a menu, advert, form or the like, or is
made of links; an element that the page names as its article makes its lines weigh more
and those outside nothing. On every page sums over sliding windows of lines surge where
the text begins and dive to nothing where it ends. The heaviest run between is kept, with
the runs and lines of the same container and runs that only side lines part from it.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import id_and_text, text_batches

WINDOW = 3

#: Weight of a window at which a text begins.
SURGE_CHARS = 80

#: Weight of a character in an element that is named as the article.
NAMED_WEIGHT = 8

# Elements of HTML by their part in a page.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr ul".split()
)
CONTAINERS = frozenset("article aside body details dialog div fieldset footer form header html main nav section table".split())
LISTS = frozenset("ul ol dl".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SPACED = frozenset("br td th".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object canvas xmp".split())
DROPPED = frozenset("nav aside footer form button select menu dialog audio video head".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar".split())
IMPLIED_END = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

# Words in class and id that name what isn't the article.
SIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar aside widget widgets footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
    "signup login search share sharing social related recommended recommendations toolbar pagination pager copyright topbar".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond replies discussion".split())
MAIN_WORDS = frozenset("article content main post entry story body text wrap wrapper container page layout".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</?([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+)>|</?([a-zA-Z][^\s/>]*+)([^>]*)>",
    re.S,
)
#: The same without quotes: a tag ends at the next sign for it.
_PLAIN_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</?([a-zA-Z][^\s/>]*+)([^>]*)>", re.S)

#: Tags with a quote that never ends, each of which is looked through to the end of the page,
#: before quotes are ordinary signs on the rest of it.
OPEN_QUOTES = 4

_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Za-z]+")


class Open:
    """Elements that are open, with counts by which a search for one that isn't there costs nothing."""

    def __init__(self):
        self.stack: list[tuple[str, bool, int, Container | None]] = [("", False, 0, None)]
        self.containers: Counter[str] = Counter()
        #: Since each open container, and since each open list or container.
        self.in_container, self.in_list = [Counter()], [Counter()]

    def push(self, tag: str, side: bool, article: int, container: "Container | None") -> None:
        self.stack.append((tag, side, article, container))
        if tag in CONTAINERS:
            self.containers[tag] += 1
            self.in_container.append(Counter())
            self.in_list.append(Counter())
            return
        self.in_container[-1][tag] += 1
        if tag in LISTS:
            self.in_list.append(Counter())
        else:
            self.in_list[-1][tag] += 1

    def cut(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag = self.stack.pop()[0]
            if tag in CONTAINERS:
                self.containers[tag] -= 1
                self.in_container.pop()
                self.in_list.pop()
                continue
            self.in_container[-1][tag] -= 1
            if tag in LISTS:
                self.in_list.pop()
            else:
                self.in_list[-1][tag] -= 1

    def place_to_close(self, tag: str) -> int:
        """Depth of the element that a closing tag ends, 0 if there is none; only containers end others around them."""
        if not (self.containers if tag in CONTAINERS else self.in_container[-1])[tag]:
            return 0
        return next(d for d in range(len(self.stack) - 1, 0, -1) if self.stack[d][0] == tag)

    def place_implied(self, ends: set[str]) -> int:
        """Depth of the element that an opening tag ends, 0 if there is none in its list or container."""
        if not any(self.in_list[-1][tag] for tag in ends):
            return 0
        return next(d for d in range(len(self.stack) - 1, 0, -1) if self.stack[d][0] in ends)


class Container:
    """An element that holds blocks; the page itself, html and body are none."""

    def __init__(self, parent: "Container | None"):
        self.parent = parent


@dataclass
class Line:
    text: str
    weight: int
    side: bool
    article: int
    container: Container | None


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)}


def _is_side(tag: str, source: str, in_article: bool) -> bool:
    """Whether an element is something beside the article."""
    if tag in DROPPED or tag == "header" and not in_article:
        return True
    if not source:
        return False
    attributes = _attributes(source)
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    if attributes.get("role", "").lower() in DROPPED_ROLES:
        return True
    words = {w.lower() for w in _WORD.findall(attributes.get("class", "") + " " + attributes.get("id", ""))}
    if words & COMMENT_WORDS and tag not in ("html", "body", "main"):
        return True
    if tag in ("html", "body", "main", "article") or words & MAIN_WORDS:
        return False
    return bool(words & SIDE_WORDS) or "header" in words and not in_article


def lines_of(html: str) -> list[Line]:
    """Blocks with text, in page order; one pass over the page, however malformed."""
    lines: list[Line] = []
    text: list[str] = []
    linked = 0
    opened = Open()
    stack = opened.stack
    articles = links = at = open_quotes = 0
    last = html.rfind(">") + 1

    def flush() -> None:
        nonlocal linked
        joined = " ".join("".join(text).split())
        text.clear()
        if joined:
            _, side, article, container = stack[-1]
            weight = 0 if side else max(0, len(joined) - linked)
            lines.append(Line(joined, weight, side, article, container))
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece:
            piece = unescape(piece)
            text.append(piece)
            if links:
                linked += len(piece.strip())

    while at < last:
        quotes = open_quotes < OPEN_QUOTES
        found = (_TAG if quotes else _PLAIN_TAG).search(html, at, last)
        if not found:
            break
        add(html[at : found.start()])
        at = found.end()
        name, source = (found[1], found[2]) if found[1] or not quotes else (found[3], found[4])
        if quotes and found[3]:
            open_quotes += 1
        tag, source = (name or "").lower(), source or ""
        if not tag:
            if at == last and html.startswith("<!--", found.start()) and not html.endswith("-->", found.start() + 4, at):
                at = len(html)
            continue
        closing = html[found.start() + 1] == "/"
        if tag in RAW:
            if not closing and not source.endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at, last)
                at = end.end() if end else len(html)
            continue
        if tag in SPACED:
            text.append(" ")
        if tag in BLOCKS:
            flush()
        if tag == "a":
            links = max(0, links + (-1 if closing else 1))
        if tag in VOID:
            continue
        if closing:
            if depth := opened.place_to_close(tag):
                # what is open inside ends as well, its text first
                flush() if stack[-1][1] != stack[depth - 1][1] else None
                opened.cut(depth)
            continue
        if ends := IMPLIED_END.get(tag):
            if depth := opened.place_implied(ends):
                opened.cut(depth)
        _, side, article, container = stack[-1]
        if not side and _is_side(tag, source, article > 0):
            flush()
            side = True
        if not article and not side and (tag in ("article", "main") or 'role="main"' in source or "articleBody" in source):
            articles += 1
            article = articles
        if tag in CONTAINERS and tag not in ("html", "body"):
            container = Container(container)
        opened.push(tag, side, article, container)
    rest = html[at:]
    add(rest[: rest.find("<!--")] if "<!--" in rest else rest)
    flush()
    return lines


def _between(weights: list[int], surge: int) -> Iterator[tuple[int, int]]:
    """Runs of lines from each surge of the window sums to the next dive to zero."""
    sums = [sum(weights[i : i + WINDOW]) for i in range(len(weights))]
    start = None
    for i, total in enumerate(sums):
        if start is None and total >= surge:
            start = i
        elif start is not None and total == 0:
            yield start, i
            start = None
    if start is not None:
        yield start, len(weights)


def _windows(weights: list[int]) -> int:
    """The heaviest window."""
    return max((sum(weights[i : i + WINDOW]) for i in range(len(weights))), default=0)


def _weights(lines: list[Line]) -> list[int]:
    """Weight of each line: more in the named element of the heaviest run, then nothing outside; names that hold no surge count for nothing."""
    plain = [x.weight for x in lines]
    best, heaviest = None, 0
    for article in sorted({x.article for x in lines if x.article and not x.side}):
        own = [NAMED_WEIGHT * w if x.article == article else 0 for x, w in zip(lines, plain)]
        most = max((sum(own[a:b]) for a, b in _between(own, max(1, min(SURGE_CHARS, _windows(own))))), default=0)
        if most > heaviest:
            best, heaviest = own, most
    if best is None or _windows(best) < NAMED_WEIGHT * SURGE_CHARS and _windows([0 if x.article else w for x, w in zip(lines, plain)]) >= SURGE_CHARS:
        return plain
    return best


def _is_inside(container: Container | None, known: dict[Container | None, bool]) -> bool:
    """Whether one of the known containers holds it; all that are passed are remembered."""
    passed = []
    while container not in known:
        passed.append(container)
        container = container.parent
    known.update(dict.fromkeys(passed, known[container]))
    return known[container]


def main_text(html: str) -> str:
    """Text of the heaviest run between a surge and a dive, with what belongs to it."""
    lines = lines_of(html)
    weights = _weights(lines)
    runs = [(a, b) for a, b in _between(weights, max(1, min(SURGE_CHARS, _windows(weights))))]
    if not runs:
        return ""
    chosen = max(range(len(runs)), key=lambda k: (sum(weights[slice(*runs[k])]), -k))
    taken = {chosen}
    # neighbouring runs go with it if only side lines part them
    for step in (-1, 1):
        k = chosen
        while 0 <= k + step < len(runs):
            (_, a), (b, _) = sorted((runs[k], runs[k + step]))
            if not all(lines[i].side for i in range(a, b)):
                break
            k += step
            taken.add(k)
    kept: set[int] = set()
    for k in taken:
        a, b = runs[k]
        while a < b and not weights[a]:
            a += 1
        while a < b and not weights[b - 1]:
            b -= 1
        kept |= {i for i in range(a, b) if not lines[i].side}
    # and so do all lines with weight inside the containers that hold its lines
    known: dict[Container | None, bool] = {lines[i].container: True for i in kept if weights[i]} | {None: False}
    kept |= {i for i, x in enumerate(lines) if weights[i] and _is_inside(x.container, known)}
    return "\n".join(lines[i].text for i in sorted(kept))


def extract_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; a null or empty page has the empty text.

    Repeated rows stay repeated. Nothing is shuffled.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in batch.column("text").to_pylist()]
        columns = [batch.column("doc_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = id_and_text(pages, id_col, html_col, url_col).withColumnRenamed(url_col, "url").select("doc_id", "text", F.col("url"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(text_batches(work), f"page_id {kinds['doc_id']}, url {kinds['url']}, text string, n_chars long")
