"""Main text of web pages by tree scoring.

A page is read into a tree of blocks. Menus, headers, footers, asides, scripts and styles are not read at all, known by
their element. Blocks that a whole word of their class, id or role marks as a menu, notice, advert, comments and the
like, forms and hidden blocks are doubtful: read, and dropped unless they hold the page's article or nearly all of its
points, or are a section of the article that is found by its id. Article, inline elements and headings are not in doubt
for their names.
Each block with text of its own is a paragraph that gives points for its length and commas to the blocks
around it: all to its parent, half to the next, then a third of that and less, up to the 32nd, each times the share
of its text outside links. The best container is kept with those siblings that score well enough or read like
paragraphs, widened to the article or main element it lies in. Blocks are joined in page order.

Edge cases: null or empty html gives an empty text, so does a page without text outside the skipped parts. Broken
markup is closed as browsers do for paragraphs, list items and table cells; open elements end with the page. A
page with too little text for points keeps its article or main element, else its body. Rows are judged alone:
ties, repeats and empty tables need no rule, and ids may be null. Of containers with equal scores the first is
kept. Other columns of the input are not carried. The work on a page is in proportion to its length, however deep its
elements lie and however many are never closed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.llm.common import OUT_ROWS, column_of, table

SKIPPED = frozenset(
    "script style noscript template head title nav header footer aside button select textarea iframe object svg"
    " canvas audio video menu dialog".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike"
    " strong sub sup time tt u var".split()
)
#: Words of class, id or role that mark a part as not the article.
UNWANTED = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation"
    " menu breadcrumb breadcrumbs header masthead footer sidebar aside widget cookie cookies consent notice gdpr popup"
    " modal overlay newsletter subscribe signup login share sharing social related recommended comment comments"
    " disqus respond replies pagination pager contentinfo complementary search toolbar".split()
)
#: Those of them that mark what readers said: kept only if the page has nothing else.
SAID = frozenset("comment comments disqus respond replies".split())
FORMS = frozenset("form fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WANTED = frozenset("article main content body entry post story text".split())
#: What an opening element closes, and where the search for it stops.
CLOSES = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
#: Blocks around a paragraph that get points from it.
LEVELS = 32
_WORDS = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")
#: A tag that the page's end cuts off.
_CUT_TAG = re.compile(r"<[/a-zA-Z!][^<>]*\Z")


class Block:
    """An element that is not inline: its own text runs and blocks, in order."""

    __slots__ = ("tag", "parent", "items", "linked", "score", "names", "chars", "links", "doubt", "inside")

    def __init__(self, tag: str, parent: Block | None, names: set[str] | frozenset = frozenset(), doubt: str = ""):
        self.tag, self.parent, self.names = tag, parent, names
        self.items: list[str | Block] = []
        self.linked = 0
        self.score: float | None = None
        self.chars = self.links = 0
        #: Why the block may not be the article: "hidden", "said", "id" (by its id alone), "name", or nothing.
        self.doubt = doubt
        #: Whether an article or what readers said is around it.
        self.inside = parent is not None and (parent.inside or parent.tag == "article" or parent.doubt == "said")

    def text(self) -> str:
        """All text below, blocks apart."""
        out: list[str] = []
        todo: list[str | Block] = [self]
        while todo:
            item = todo.pop()
            if isinstance(item, str):
                out.append(item)
            else:
                out.append(" ")
                todo.append(" ")
                todo.extend(reversed(item.items))
        return "".join(out)


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.block = Block("body", None)
        self.blocks = [self.root]
        #: Open elements, outermost first: tag, block (none if inline or skipped), and whether it is skipped.
        self.open: list[tuple[str, Block | None, bool]] = []
        #: Where the elements of each tag are among them, and where those that are not inline are.
        self.places: defaultdict[str, list[int]] = defaultdict(list)
        self.outer: list[int] = []
        #: Place of the outermost skipped element among them, if any.
        self.skip: int | None = None
        self.in_link = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.skip is not None and self.open[self.skip][0] == "head" and tag in ("body", "article", "main", "p", "div"):
            self._pop_to(self.skip)
        if tag in VOID:
            if tag in ("br", "hr") and self.skip is None:
                self.block.items.append(" ")
            return
        if self.skip is not None and tag in INLINE:
            self._push(tag, None, True)
            return
        if self.skip is not None and tag not in ("html", "body"):
            # What the element closes may be skipped, which then ends.
            self._imply(tag)
        if self.skip is not None:
            self._push(tag, None, True)
            return
        names = {w for key, value in attrs if value and key in ("class", "id", "role") for w in _WORDS.findall(value.lower())}
        hidden = any(k == "hidden" or (k == "aria-hidden" and v == "true") for k, v in attrs)
        if tag in SKIPPED or hidden and tag in INLINE:
            if tag not in INLINE:
                self._imply(tag)
            self.block.items.append(" ")
            self.skip = len(self.open)
            self._push(tag, None, True)
            return
        if tag in ("html", "body"):
            return
        if tag in INLINE:
            self._push(tag, None, False)
            self.in_link += tag == "a"
            return
        self._imply(tag)
        child = Block(tag, self.block, names, _doubt(tag, names, attrs, hidden, self.block))
        self.block.items.append(child)
        self.blocks.append(child)
        self._push(tag, child, False)
        self.block = child

    def parse_comment(self, i: int, report: bool = True) -> int:
        """A comment without an end hides the rest; the parser asks only where one can begin."""
        end = super().parse_comment(i, report)
        return len(self.rawdata) if end < 0 else end

    def _imply(self, tag: str) -> None:
        """Close what an opening element that is not inline ends."""
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        self._close({"p"}, {"table", "td", "th", "li", "div", "section", "article", "blockquote", "main"})

    def _push(self, tag: str, block: Block | None, skipped: bool) -> None:
        self.places[tag].append(len(self.open))
        if tag not in INLINE:
            self.outer.append(len(self.open))
        self.open.append((tag, block, skipped))

    def _last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else -1

    def _close(self, tags: set[str], stops: set[str]) -> None:
        """Close the outermost of these elements that lies within the last stop: a row's opening ends cell and row."""
        stop = max(map(self._last, stops))
        found = [places[i] for tag in tags if (places := self.places.get(tag)) and (i := bisect_right(places, stop)) < len(places)]
        if found:
            self._pop_to(min(found))

    def _pop_to(self, at: int) -> None:
        outermost = None
        while len(self.open) > at:
            tag, block, skipped = self.open.pop()
            self.places[tag].pop()
            if tag not in INLINE:
                self.outer.pop()
            self.in_link -= tag == "a" and not skipped
            outermost = block or outermost
        if outermost is not None:
            self.block = outermost.parent or self.root
        if self.skip is not None and at <= self.skip:
            self.skip = None

    def handle_endtag(self, tag: str) -> None:
        if tag == "br" and self.skip is None:
            self.block.items.append(" ")
        at = self._last(tag)
        if at >= 0 and (tag not in INLINE or not self.outer or at > self.outer[-1]):
            self._pop_to(at)

    def handle_data(self, data: str) -> None:
        if self.skip is not None:
            return
        self.block.items.append(data)
        if self.in_link:
            self.block.linked += len(data)


def _doubt(tag: str, names: set[str], attrs: list[tuple[str, str | None]], hidden: bool, parent: Block) -> str:
    if hidden:
        return "hidden"
    if tag in FORMS:
        return "name"
    found = names & UNWANTED
    if not found or tag in HEADINGS or tag == "main":
        return ""
    if tag == "article":
        # Within an article or comments, an article is what a reader said.
        inside = parent.inside or parent.tag == "article" or parent.doubt == "said"
        return "said" if inside and found & SAID else ""
    if found & SAID:
        return "said"
    other = {w for key, value in attrs if value and key in ("class", "role") for w in _WORDS.findall(value.lower())}
    return "name" if other & UNWANTED else "id"


def _points(block: Block) -> float:
    """What a block's own text is worth."""
    own = "".join(x for x in block.items if isinstance(x, str))
    size = len(_SPACE.sub(" ", own).strip())
    if size < 25:
        return 0.0
    plain = 1 - min(1.0, block.linked / max(1, len(own)))
    return (1 + own.count(",") + own.count("，") + min(size / 100, 3)) * plain


def _drop_doubtful(tree: _Tree) -> None:
    """Take doubtful blocks out of the tree that are not the article or a part of it.

    Points and characters of each block are those of all its text. From the outermost on, a block is compared with the
    text of the page that is not in doubt: that which lies in no doubtful block but those already kept.
    """
    if not any(block.doubt for block in tree.blocks):
        return
    points = {id(b): _points(b) for b in tree.blocks}
    chars = {id(b): sum(len(x.strip()) for x in b.items if isinstance(x, str)) for b in tree.blocks}
    links = {id(b): b.linked for b in tree.blocks}
    #: Points below a block that lie in no doubtful block below it.
    sure = dict(points)
    #: The most points of an article or main element below, or of the block if it is one.
    held: dict[int, float] = {id(b): 0.0 for b in tree.blocks}
    for block in reversed(tree.blocks):
        if block.tag in ("article", "main") and not block.doubt:
            held[id(block)] = max(held[id(block)], sure[id(block)])
        if block.parent is None:
            continue
        for sums in (points, chars, links):
            sums[id(block.parent)] += sums[id(block)]
        if not block.doubt:
            sure[id(block.parent)] += sure[id(block)]
            held[id(block.parent)] = max(held[id(block.parent)], held[id(block)])
    clear, best = sure[id(tree.root)], held[id(tree.root)]
    dropped: set[int] = set()
    inside: dict[int, bool] = {id(tree.root): False}
    for block in tree.blocks:
        if block.parent is None:
            continue
        above = block.parent
        inside[id(block)] = inside[id(above)] or block.tag in ("article", "main") and not block.doubt
        if id(above) in dropped:
            dropped.add(id(block))
            continue
        if not block.doubt:
            continue
        # What is in further doubt below a block counts for it if nothing below is sure.
        own = sure[id(block)] or points[id(block)]
        few_links = links[id(block)] < 0.3 * max(1, chars[id(block)])
        if block.doubt == "said" or block.doubt == "hidden":
            kept = own > 0 and clear == 0
        else:
            kept = few_links and (held[id(block)] > 3 * best or own > 5 * clear)
            if block.doubt == "id" and inside[id(above)] and few_links and chars[id(block)] >= 80:
                # A section of the article, named by what it is about.
                kept = kept or block.tag != "div" or any(isinstance(x, Block) and x.tag in HEADINGS for x in block.items)
        if kept:
            clear += sure[id(block)]
            best = max(best, held[id(block)])
        else:
            dropped.add(id(block))
    if not dropped:
        return
    for block in tree.blocks:
        if id(block) not in dropped:
            block.items = [" " if isinstance(x, Block) and id(x) in dropped else x for x in block.items]
    tree.blocks = [b for b in tree.blocks if id(b) not in dropped]


def _measure(tree: _Tree) -> None:
    """Points for paragraphs, handed to the blocks around them; characters and linked characters below each block."""
    for block in reversed(tree.blocks):
        own = [x for x in block.items if isinstance(x, str)]
        size = sum(map(len, own))
        block.chars += size
        block.links += block.linked
        if block.parent is not None:
            block.parent.chars += block.chars
            block.parent.links += block.links
    for block in tree.blocks:
        points = _points(block)
        if not points:
            continue
        above, level = block if block.parent is None else block.parent, 0
        while above is not None and level < LEVELS:
            if above.score is None:
                above.score = _start(above)
            above.score += points / (1, 2, 6)[level] if level < 3 else points / (3 * level)
            above, level = above.parent, level + 1


def _start(block: Block) -> float:
    score = {"article": 25, "main": 25, "div": 5, "section": 5, "td": 3, "pre": 3, "blockquote": 3}.get(block.tag, 0)
    return score + (25 if block.names & WANTED else 0)


def _rank(block: Block) -> float:
    if block.score is None:
        return 0.0
    return block.score * (1 - block.links / max(1, block.chars))


def _kept(tree: _Tree) -> list[Block]:
    scored = [b for b in tree.blocks if b.score is not None]
    if not scored:
        return [b for b in tree.blocks if b.tag in ("article", "main")][:1] or [tree.root]
    best = max(scored, key=_rank)
    wide = best
    while wide is not None and wide.tag not in ("article", "main"):
        wide = wide.parent
    best = wide or best
    if best.parent is None:
        return [best]
    least = max(10.0, 0.2 * _rank(best))
    kept, before = [], True
    for block in (x for x in best.parent.items if isinstance(x, Block)):
        paragraph = block.tag == "p" and block.chars > 80 and block.links < 0.25 * block.chars
        heading = block.tag in ("h1", "h2") and before
        before = before and block is not best
        if block is best or paragraph or heading or _rank(block) >= least:
            kept.append(block)
    return kept


def main_text(html: str | None) -> str:
    """The article's text: white space within and between blocks as one space."""
    if not html:
        return ""
    tree = _Tree()
    tree.feed(_CUT_TAG.sub("", html))
    tree.close()
    _drop_doubtful(tree)
    _measure(tree)
    return _SPACE.sub(" ", " ".join(b.text() for b in _kept(tree))).strip()


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of each page; a page is one value, read by one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_ROWS):
                rows = batch.slice(at, OUT_ROWS)
                texts = [main_text(x.as_py()) for x in column_of(rows, "html")]
                yield pa.RecordBatch.from_arrays(
                    [column_of(rows, "page_id"), column_of(rows, "url"), pa.array(texts, pa.string()),
                     pa.array([len(x) for x in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")
    ).mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_pages(table(spark, sf_dir, "pages"))
