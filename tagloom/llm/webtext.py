"""Main text of web pages by composite text density.

Each node of a page has a density: its characters per tag, adjusted for links, so that text with
many links counts little. The sum of the children's densities is largest at the node that holds the
article. The least density on the path from the body to it is the threshold below which link-heavy
parts within are left out. Elements that can't be article by their name (menus, scripts and the like)
are left out from the beginning. So are adverts, notices and comments of readers, by their class or id,
unless there is no text and no article besides them; and what by its role or class should not be article
(sidebars, forms and the like), if it holds no more than half of the page's text and no article: what
holds more is a wrapper of the page.

Pages are independent of each other; a task holds one page at a time.
"""

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tagloom.llm.common import in_pieces

# A comment, a declaration, a tag with its attributes, or text.
_TOKEN = re.compile(
    r"<!--(?:>|->|(?P<comment>.*?)(?:-->|--!>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)"
    r"|</[^>]*(?:>|\Z)|(?P<text>[^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?![\w-])"
                        r"\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is not markup.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre "
    "search section summary table tbody td tfoot th thead tr ul".split())
# Elements that a start tag closes if they are open, and where the search for them stops.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
           "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}}
_SCOPE = frozenset("table td th ul ol dl body html button select article section div".split())
_LEFT_OUT = frozenset(
    "head nav footer button select datalist dialog menu search script style textarea title "
    "noscript iframe noembed noframes template svg annotation annotation-xml canvas audio video object "
    "map".split())
# These, and elements of the roles and names below, may also be wrappers of the page.
_DOUBTFUL = frozenset("aside form".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu "
                   "menubar toolbar form".split())
# Never the article, unless nothing else is on the page.
_UNWANTED = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored cookie cookies consent gdpr "
    "notice popup modal overlay newsletter paywall comment comments disqus respond replies reply".split())
_NAMES = _UNWANTED | frozenset(
    "banner promo promotion subscribe subscription signup login sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs pagination pager footer header masthead topbar toolbar share sharing social "
    "related recommended recommendations skip copyright hidden".split())
# Words that go with those names; with any other word, as in `related-work`, a class says something else.
_NEUTRAL = frozenset(
    "list lists section container box area wrapper wrap widget block bar post posts articles link links item "
    "items site page main content top bottom left right side button buttons thread form title count module "
    "region panel group inner outer row body primary secondary global mobile icon icons".split())
# Within an article these hold its title.
_TITLES = frozenset(["header"])
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup time figure".split())


class Page:
    """The nodes of a page in document order; a node's parent comes before it."""

    def __init__(self, source: str):
        self.tag, self.parent, self.dropped, self.in_article = ["html"], [0], [False], [False]
        self.doubtful = [""]
        # (node, number of its block, text)
        self.texts: list[tuple[int, int, str]] = []
        self.body = 0
        self._parse(source)
        self._drop_doubtful()

    def _parse(self, source: str) -> None:
        stack, block, at = [0], 0, 0
        match = _TOKEN.match
        while at < len(source):
            found = match(source, at)
            if found is None:
                self.texts.append((stack[-1], block, source[at:]))
                break
            at = found.end()
            text = found["text"]
            if text is not None:
                self.texts.append((stack[-1], block, text))
                continue
            name = found["name"] or found["name2"]
            if name is None:
                continue
            name = name.lower()
            if found["close"] or found["close2"]:
                if name in BLOCKS:
                    block += 1
                self._close(stack, name)
                continue
            if name in ("html", "body"):
                if name == "body" and not self.body:
                    while len(stack) > 1:  # an open head ends here
                        stack.pop()
                    self.body = self._open(stack, name, "")
                continue
            if name in BLOCKS:
                block += 1
                self._close_paragraph(stack)
            if name in _CLOSES:
                self._imply(stack, name)
            node = self._open(stack, name, found["attrs"] or found["attrs2"] or "")
            if name in RAW:
                end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(source, at)
                at = end.start() if end else len(source)
            if name in VOID:
                stack.pop()
                if name == "br":
                    self.texts.append((self.parent[node], block, " "))

    def _open(self, stack: list[int], name: str, attributes: str) -> int:
        parent = stack[-1]
        self.tag.append(name)
        self.parent.append(parent)
        inside = self.in_article[parent]
        self.in_article.append(inside or name in ("article", "main"))
        self.dropped.append(self.dropped[parent] or name in _LEFT_OUT)
        self.doubtful.append(self._doubt(name, attributes, inside))
        stack.append(len(self.tag) - 1)
        return stack[-1]

    @staticmethod
    def _doubt(name: str, attributes: str, in_article: bool) -> str:
        """What speaks against an element: "unwanted", "unlikely", or nothing."""
        found = "unlikely" if name in _DOUBTFUL or (name in _TITLES and not in_article) else ""
        if name == "body" or not attributes.strip():
            return found
        names = _NAMES - _TITLES if in_article else _NAMES
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key in ("class", "id"):
                for token in value.split():
                    words = set(re.findall(r"[a-z]+", token))
                    if words & names and words <= names | _NEUTRAL:
                        if words & _UNWANTED:
                            return "unwanted"
                        found = "unlikely"
            elif key == "hidden" or key == "aria-hidden" and value == "true" \
                    or key == "role" and value in _ROLES \
                    or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                found = "unlikely"
        return "" if name in ("article", "main") else found

    def _close(self, stack: list[int], name: str) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if self.tag[stack[depth]] == name:
                del stack[depth:]
                return
            if self.tag[stack[depth]] == "body":
                return

    def _close_paragraph(self, stack: list[int]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if self.tag[stack[depth]] == "p":
                del stack[depth:]
                return
            if self.tag[stack[depth]] in _SCOPE:
                return

    def _imply(self, stack: list[int], name: str) -> None:
        closes, depth = _CLOSES[name], len(stack) - 1
        scope = _SCOPE - closes
        while depth > 0 and self.tag[stack[depth]] not in scope:
            if self.tag[stack[depth]] in closes:
                del stack[depth:]
            depth -= 1

    def _drop_doubtful(self) -> None:
        """Drop what is unwanted or unlikely, but for wrappers of the page."""
        if not any(self.doubtful):
            return
        size = len(self.tag)
        chars, plain, articles = ([0] * size for _ in range(3))
        in_link = [False] * size
        for node in range(1, size):
            in_link[node] = in_link[self.parent[node]] or self.tag[node] == "a"
        for node, _, text in self.texts:
            if not self.dropped[node]:
                length = len("".join(text.split()))
                chars[node] += length
                plain[node] += 0 if in_link[node] else length
        for node in range(size - 1, 0, -1):
            up = self.parent[node]
            chars[up] += chars[node]
            plain[up] += plain[node]
            # Articles of their own; what is named a comment is none.
            if chars[node] and self.tag[node] in ("article", "main") and self.doubtful[node] != "unwanted":
                articles[node] = 1
            articles[up] += articles[node]
        for node in range(1, size):
            up, doubt = self.parent[node], self.doubtful[node]
            if doubt == "unwanted":
                # What is outside it may be a site's name, but no article.
                outside = plain[0] - plain[node]
                holds = articles[node] > 0 and not self.in_article[up]
                wrapper = articles[0] == articles[node] and outside <= (plain[node] // 10 if holds else 0)
            else:
                wrapper = 2 * chars[node] > chars[0] or articles[node] > 0 and not self.in_article[up]
            self.dropped[node] = self.dropped[node] or self.dropped[up] or bool(doubt) and not wrapper

    # -- densities ----------------------------------------------------------------------

    def best_node(self) -> tuple[int, list[float], list, list[int], list[int]]:
        """The node with the largest sum of its children's densities, all densities, the texts that are kept,
        and the characters and linked characters of every node."""
        size = len(self.tag)
        chars, links, tags, link_tags = ([0] * size for _ in range(4))
        in_link = [False] * size
        for node in range(1, size):
            in_link[node] = in_link[self.parent[node]] or self.tag[node] == "a"
        kept = [(node, block, html.unescape(text)) for node, block, text in self.texts
                if not self.dropped[node]]
        for node, _, text in kept:
            length = len(" ".join(text.split()))
            chars[node] += length
            if in_link[node]:
                links[node] += length
        for node in range(size - 1, 0, -1):
            if self.dropped[node]:
                continue
            up = self.parent[node]
            chars[up] += chars[node]
            links[up] += links[node]
            tags[up] += tags[node] + 1
            link_tags[up] += link_tags[node] + (self.tag[node] == "a")
        whole = max(chars[self.body], 1)
        density = [self._density(c, t, lc, lt, links[self.body] / whole)
                   for c, t, lc, lt in zip(chars, tags, links, link_tags)]
        sums = [0.0] * size
        for node in range(1, size):
            if not self.dropped[node]:
                sums[self.parent[node]] += density[node]
        # Of equal sums the first; a page without any element with text is its body.
        best = max(range(self.body, size), key=lambda n: (round(sums[n], 9), -n))
        return best if sums[best] > 0 else self.body, density, kept, chars, links

    def main_blocks(self) -> list[str]:
        """The article's blocks of text, in page order."""
        best, density, kept, chars, links = self.best_node()
        path = [best]
        while path[-1] not in (self.body, 0):
            path.append(self.parent[path[-1]])
        threshold = min(density[n] for n in path)
        root = self._article(best, density)
        return self._blocks(kept, root, set(path), density, threshold, chars, links)

    @staticmethod
    def _density(chars: int, tags: int, links: int, link_tags: int, body_share: float) -> float:
        """Characters per tag; the logarithm grows with text outside links, and its base with the
        share of links here and in the whole body."""
        if not chars:
            return 0.0
        tags, link_chars, link_tags = max(tags, 1), max(links, 1), max(link_tags, 1)
        base = math.log(chars / max(chars - links, 1) * link_chars + body_share * chars + math.e)
        ratio = chars / link_chars * tags / link_tags
        return chars / tags * max(math.log(max(ratio, 1.0)) / math.log(base), 0.0)

    def _article(self, best: int, density: list[float]) -> int:
        """The subtree to take: the one of the largest sum, or the article that holds it, or what
        holds besides it only headings."""
        up = best
        while up not in (self.body, 0):
            if self.tag[up] in ("article", "main"):
                return up
            up = self.parent[up]
        children: list[list[int]] = [[] for _ in self.tag]
        for node in range(1, len(self.tag)):
            if density[node] > 0 and not self.dropped[node]:
                children[self.parent[node]].append(node)
        node = best
        while node not in (self.body, 0) and (up := self.parent[node]) not in (self.body, 0):
            if any(n != node and self.tag[n] not in _HEADINGS for n in children[up]):
                break
            node = up
        return node

    def _blocks(self, kept: list[tuple[int, int, str]], root: int, path: set[int],
                density: list[float], threshold: float, chars: list[int],
                links: list[int]) -> list[str]:
        inside = [False] * len(self.tag)
        inside[root] = True
        for node in range(root + 1, len(self.tag)):
            linked = 2 * links[node] > chars[node] and self.tag[node] != "a"
            inside[node] = inside[self.parent[node]] and not self.dropped[node] and not (
                linked and node not in path and density[node] < threshold and self.tag[node] in BLOCKS)
        blocks: dict[int, list[str]] = {}
        for node, block, text in kept:
            if inside[node]:
                blocks.setdefault(block, []).append(text)
        joined = (" ".join("".join(parts).split()) for _, parts in sorted(blocks.items()))
        return [text for text in joined if text]


def main_text(source: str | None) -> str:
    """The article of a page; empty if there is none."""
    return "\n\n".join(Page(source).main_blocks()) if source else ""


def extract(pages: DataFrame, id_column: str = "page_id", url: str = "url",
            source: str = "html") -> DataFrame:
    """`page_id`, `url`, `text` and `n_chars` of every row.

    A NULL or empty page has an empty text. Ids and URLs are passed on, also NULL. Of nodes with
    equal sums the first is the article. Repeated rows give equal texts; an empty table gives no
    rows; other columns are not looked at. Nothing is cut off.
    """
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"),
                        F.col(url).cast("string").alias("url"),
                        F.col(source).cast("string").alias("html"))

    def apply(batches):
        for batch in in_pieces(batches, "html", 4 << 20):
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(apply, "page_id long, url string, text string, n_chars long")
