"""Main text of web pages by consensus host paths.

Each page's containers are scored by their text, and the best one's path of tags and classes,
generalised, is a vote. Votes are added up per host, and every page is read again at the path its
host has chosen. A page without that path keeps its own best container.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leafmill.llm.common import stored, texts_of

# Elements of HTML by what they mean for text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
DROPPED = frozenset(
    "script style textarea title xmp noembed noframes head nav footer aside form template noscript iframe object svg math canvas "
    "audio video select option button input label fieldset dialog menu".split()
)
BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th "
    "blockquote pre address figure figcaption header hgroup hr details summary center".split()
)
CONTAINERS = frozenset("article main section div body".split())
INLINE_DROPPED = frozenset("button input label select script style svg math option".split())
CUTS = DROPPED - INLINE_DROPPED
CLOSES_P = BLOCKS | CUTS
RAW_ENDS = {tag: re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE) for tag in RAW}
# Words of classes, ids and roles that name what is not the article.
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb "
    "breadcrumbs footer sidebar widget cookie cookies consent notice gdpr popup modal overlay newsletter subscribe signup "
    "share sharing social related recommended comment comments commentlist disqus respond reply login search toolbar pagination "
    "pager complementary contentinfo masthead topbar".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?=[^a-zA-Z/!?])|[^<]+|<",
    re.DOTALL,
)
REST = re.compile(r"<!--.*|(\Z.)?(\Z.)?.+", re.DOTALL)  # no tag ends any more: all text
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
NAME_WORD = re.compile(r"[a-z]+")
# Words in a class that say the noise is beside the element, not the element itself; elements that are never noise.
BESIDE = frozenset("with without has no article main".split())
NEVER_NOISE = frozenset("html body article main".split())
SPACE = re.compile(r"\s+")


class Paths:
    """The container paths of a page as a tree of names, so that any depth costs one entry a path.

    A path is a number; 0 is the empty one, and a path's parent has a smaller number.
    """

    def __init__(self):
        self.parents, self.names, self.depths = [0], [""], [0]
        self.children: dict[tuple[int, str], int] = {}

    def child(self, path: int, name: str) -> int:
        if (found := self.children.get((path, name))) is None:
            found = self.children[path, name] = len(self.parents)
            self.parents.append(path)
            self.names.append(name)
            self.depths.append(self.depths[path] + 1)
        return found

    def text(self, path: int) -> str:
        names = []
        while path:
            names.append(self.names[path])
            path = self.parents[path]
        return ">".join(reversed(names))

    def below(self, text: str) -> list[bool]:
        """Whether each path is the given one or inside of it; none is if the page does not have it."""
        found = 0
        for name in text.split(">"):
            if (found := self.children.get((found, name), -1)) < 0:
                return [False] * len(self.parents)
        inside = [False] * len(self.parents)
        for path in range(1, len(inside)):
            inside[path] = path == found or inside[self.parents[path]]
        return inside


class Block:
    """One block of text: its pieces, the length of those inside links, the path of the containers around it."""

    __slots__ = ("linked", "path", "pieces")

    def __init__(self, path: int):
        self.pieces: list[str] = []
        self.linked = 0
        self.path = path

    def text(self) -> str:
        return SPACE.sub(" ", html.unescape("".join(self.pieces))).strip()


def element_name(tag: str, attributes: str) -> tuple[str, bool]:
    """The generalised name (tag and class words, digits left out), and whether the element is noise."""
    noisy = tag in DROPPED
    if not attributes:
        return tag, noisy
    classes: set[str] = set()
    for m in ATTRIBUTE.finditer(attributes):
        kind, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "").lower()
        if kind == "hidden" or kind == "aria-hidden" and value == "true":
            noisy = True
        for token in value.split() if kind in ("class", "id", "role") else ():
            words = set(NAME_WORD.findall(token))
            if words & NOISE_WORDS and not words & BESIDE:
                noisy = True
            if kind == "class":
                classes |= words
    return ".".join([tag, *sorted(classes)]), noisy and tag not in NEVER_NOISE


class OpenElements:
    """The elements that are open at a place of a page, outermost first."""

    def __init__(self, paths: Paths):
        self.known = paths
        self.tags: list[str] = []
        self.paths: list[int] = []  # of the containers around and including each element
        self.counts: dict[str, int] = {}
        self.noise = 0  # depth at which a noisy element began, 0 for none

    def has(self, *tags: str) -> bool:
        return any(self.counts.get(t) for t in tags)

    def path(self) -> int:
        return self.paths[-1] if self.paths else 0

    def open(self, tag: str, name: str, noisy: bool) -> None:
        path = self.path()
        if tag in CONTAINERS or tag == "html":
            path = self.known.child(path, name)
        self.tags.append(tag)
        self.paths.append(path)
        self.counts[tag] = self.counts.get(tag, 0) + 1
        if noisy and not self.noise:
            self.noise = len(self.tags)

    def close_from(self, depth: int) -> None:
        for tag in self.tags[depth:]:
            self.counts[tag] -= 1
        del self.tags[depth:], self.paths[depth:]
        if self.noise > depth:
            self.noise = 0

    def close_paragraph(self) -> None:
        """A block ends an open paragraph, unless a container began inside of it."""
        if not self.has("p"):
            return
        for depth in range(len(self.tags) - 1, -1, -1):
            if self.tags[depth] == "p":
                self.close_from(depth)
                return
            if self.tags[depth] in CONTAINERS or self.tags[depth] in ("td", "li", "blockquote"):
                return

    def close(self, tag: str) -> None:
        """An end tag closes up to its start; one of an inline element does not reach beyond its block."""
        if not self.has(tag):
            return
        whole = tag in BLOCKS or tag in DROPPED
        for depth in range(len(self.tags) - 1, -1, -1):
            if self.tags[depth] == tag:
                self.close_from(depth)
                return
            if not whole and self.tags[depth] in BLOCKS:
                return


def blocks_of(page: str, paths: Paths) -> Iterator[Block]:
    """The blocks of text of a page outside of dropped and noisy elements, in page order; their paths go to ``paths``.

    Unclosed elements are closed by what follows: a paragraph by the next block, any element by
    the end of one around it. An end tag without a start is passed over.
    """
    around = OpenElements(paths)
    block: Block | None = None
    at, size = 0, len(page)
    last_end = page.rfind(">")
    while at < size:
        m = TOKEN.match(page, at) if at <= last_end else REST.match(page, at)
        at = m.end()
        if m[2] is None:
            text = m[0]
            if around.noise or text.startswith(("<!", "<?")):
                continue
            if block is None:
                block = Block(around.path())
            block.pieces.append(text)
            block.linked += len(text) if around.has("a") else 0
            continue
        tag = m[2].lower()
        if tag in BLOCKS or tag in CUTS:
            if block is not None:
                yield block
            block = None
        elif tag == "br" and block is not None:
            block.pieces.append(" ")
        if m[1]:
            around.close(tag)
            continue
        if tag in CLOSES_P:
            around.close_paragraph()
        if tag in VOID or tag in DROPPED and m[3].rstrip().endswith("/"):
            continue
        if tag in RAW:
            end = RAW_ENDS[tag].search(page, at)
            at = end.end() if end else size
            continue
        name, noisy = element_name(tag, m[3])
        around.open(tag, name, noisy or tag == "header" and not around.has("article", "main"))
    if block is not None:
        yield block


def best_path(blocks: list[Block], paths: Paths) -> tuple[str, float]:
    """The container path with the main text, and its score.

    A container is worth its text, less twice what of it is in links. Each level down is worth a
    little more, up to five levels, and article and main elements are, so of containers that hold nearly the same
    text the inner one wins. Equal scores go to the path that sorts last.
    """
    worth: list[float | None] = [None] * len(paths.parents)
    for b in blocks:
        worth[b.path] = (worth[b.path] or 0.0) + max(0, sum(map(len, b.pieces)) - 2 * b.linked)
    for path in range(len(worth) - 1, 0, -1):
        if worth[path] is not None:
            worth[paths.parents[path]] = (worth[paths.parents[path]] or 0.0) + worth[path]
    best, best_score = 0, 0.0
    for path in range(1, len(worth)):
        if worth[path] is None:
            continue
        last = paths.names[path].partition(".")[0]
        score = worth[path] * (1 + 0.02 * min(paths.depths[path] - 1, 5)) * (1.2 if last in ("article", "main") else 1.0)
        # A path sorts after the one around it.
        if score > best_score or score == best_score and (paths.parents[path] == best or paths.text(path) > paths.text(best)):
            best, best_score = path, score
    return paths.text(best), best_score


def main_text(page: str, path: str | None = None) -> str:
    """The text of a page at ``path``; at its own best path if it has nothing there."""
    paths = Paths()
    blocks = list(blocks_of(page, paths))

    def lines_at(where: str) -> list[str]:
        inside = paths.below(where)
        return [t for b in blocks if inside[b.path] and (t := b.text())]

    lines = lines_at(path) if path else []
    if not lines:
        own = best_path(blocks, paths)[0]
        lines = lines_at(own) if own else [t for b in blocks if (t := b.text())]
    return "\n".join(lines)


def page_vote(page: str) -> tuple[str, float]:
    """Where one page alone has its main text, and its score."""
    paths = Paths()
    return best_path(list(blocks_of(page, paths)), paths)


def host_of(url: Column) -> Column:
    """Lower-case host of a url; a null url, or one without host, belongs to the empty host."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def host_paths(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """``host, path``: where most pages of each host have their main text, by number of votes, then score, then the path that sorts last."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [page_vote(t.decode("utf-8", "replace")) for t in texts_of(batch.column(1))]
            scores = pa.array([round(s) for _, s in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p for p, _ in found], pa.string()), scores], names=["host", "path", "score"])

    votes = pages.select(host_of(F.col(url)).alias("host"), F.col(page).alias("html")).mapInArrow(vote, "host string, path string, score bigint")
    # One row per host and path is left of any number of pages before anything is shuffled.
    counted = votes.filter("path != ''").groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("score").alias("score"))
    first = counted.groupBy("host").agg(F.max(F.struct("votes", "score", "path")).alias("best"))
    return first.select("host", F.col("best.path").alias("path"))


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row, from the whole html.

    Character references are decoded, white space inside a block becomes one space, blocks are
    joined by a newline. Null and empty html give an empty text. Repeated rows are read and vote
    each; no rows: no rows.
    """
    # Written first, so that its true size is known: pages are shuffled only where there are very many hosts.
    paths = stored(host_paths(pages, url, page), "host-paths")
    asked = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"), host_of(F.col(url)).alias("host"))
    read = asked.join(paths, "host", "left").select("page_id", "url", "html", "path")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(texts_of(batch.column(2)), batch.column(3).to_pylist(), strict=True)
            texts = [main_text(t.decode("utf-8", "replace"), path) for t, path in pairs]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema[page_id].dataType.simpleString()
    return read.mapInArrow(extract, f"page_id {kind}, url string, text string, n_chars bigint")
