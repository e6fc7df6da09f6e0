"""Main text of web pages by tree scoring.

Every paragraph earns points for its length and its commas and passes them to its
ancestors, less with each level; an element's points are discounted by the share of
its text that lies in links. The best container is kept, with those siblings that
look like more of the article. Where several containers are about as strong, the
element under which they meet is the best; an <article> around it is preferred if it has no fewer points. Menus,
forms and the like are cut out of the tree beforehand by their element. Names (words of class, id and
role) cut out notices, comments and adverts too, but not an element that also bears the name or tag of an article
and holds most of the points, and not all that a page has.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.llm.workers import slices

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split()
)
DROPPED = frozenset(
    "script style noscript template head title nav header footer aside form menu dialog button select textarea input iframe object embed applet svg canvas audio video map".split()
)
#: Words of a class, id or role that mark what is no part of an article.
NOISE = frozenset(
    """ad ads adsbygoogle advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr
    notice notices notification alert popup modal overlay newsletter subscribe subscription signup login register paywall nav navbar
    navigation menu breadcrumb breadcrumbs pagination pager sidebar side footer header masthead topbar toolbar search comment comments
    commentlist disqus respond reply replies share sharing social related recommended recommendations widget widgets skip hidden
    complementary contentinfo dialog""".split()
)
#: Of these, words that say little where the same name also speaks of an article.
WEAK = frozenset(("sidebar", "side", "header"))
CONTENT = frozenset("article content body post entry story text".split())
ABOUT_LAYOUT = frozenset("has with no without not".split())
CONTAINERS = frozenset("div section article main body".split())
PARAGRAPHS = CONTAINERS | frozenset("p pre blockquote li td dd".split())
ROOTS = frozenset(("body", "html", ""))
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SELF_CLOSING = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
WORD = re.compile("[A-Z]?[a-z]+|[A-Z]+")
TAG = re.compile("<[a-zA-Z/!]")
MIN_PARAGRAPH = 25  # characters; shorter text earns no points
COMMA = re.compile("[,،、，]")
SIBLING_SHARE = 0.2  # of the best score
STRONG_SHARE = 0.4  # of the most points that a container gets from paragraphs of its own
MOST = 0.5  # of the points of a page
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PLAIN = frozenset("p blockquote pre ul ol table".split()) | HEADINGS
FEW_LINKS, MANY_LINKS = 0.25, 0.75  # link density of text, of a list of links
SCHEMA = "page_id long, url string, text string, n_chars long"


def is_cut(tag: str, found: dict[str, str | None], in_article: bool) -> bool:
    """Whether an element is no part of an article, whatever its name and points."""
    if tag in DROPPED and not (tag == "header" and in_article):
        return True
    return "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in (found.get("style") or "").replace(" ", "")


def names_of(tag: str, found: dict[str, str | None]) -> tuple[bool, bool]:
    """Whether the name of an element speaks of noise, and whether name or tag speak of an article."""
    if tag in ROOTS:
        return False, False
    words = set()
    for name in " ".join(found.get(k) or "" for k in ("class", "id", "role")).split():
        parts = [w.lower() for w in WORD.findall(name)]
        if parts and parts[0] not in ABOUT_LAYOUT:
            words.update(parts)
    noise, article = words & NOISE, bool(words & CONTENT) or tag in ("article", "main")
    return bool(noise) and not (noise <= WEAK and words & CONTENT), article


class Tree(HTMLParser):
    """Elements in document order; `items` has (element, text) and, with text None, the borders of blocks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.cut = [""], [-1], [False]
        self.noisy, self.articles = [False], [False]  # what an element's name says
        self.open, self.opened = [0], Counter()
        self.items: list[tuple[int, str | None]] = []

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_P:
            self._close({"p"}, stop="button table td th li")
        elif tag in SELF_CLOSING:
            tags, stop = SELF_CLOSING[tag]
            self._close(set(tags.split()), stop)
        node = len(self.tags)
        self.tags.append(tag)
        self.parents.append(self.open[-1])
        found = dict(attrs)
        self.cut.append(is_cut(tag, found, self.opened["article"] > 0))
        noisy, article = names_of(tag, found)
        self.noisy.append(noisy)
        self.articles.append(article)
        if tag == "br":
            self.items.append((self.open[-1], " "))
        elif tag not in INLINE:
            self.items.append((node, None))
        if tag not in VOID:
            self.open.append(node)
            self.opened[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self._close({tag}, stop="" if tag in ("html", "body", "table", "article", "main") else "table article main" if tag not in INLINE else "p td th li div section article main table")

    def handle_data(self, data):
        self.items.append((self.open[-1], data))

    def _close(self, tags: set[str], stop: str) -> None:
        """Closes the nearest open element of the tags and all in it, if no element of `stop` is between."""
        if not any(self.opened[tag] for tag in tags):
            return
        limits = stop.split()
        for i in range(len(self.open) - 1, 0, -1):
            name = self.tags[self.open[i]]
            if name in tags:
                if name not in INLINE:
                    self.items.append((self.open[i], None))
                self.opened.subtract(self.tags[n] for n in self.open[i:])
                del self.open[i:]
                return
            if name in limits:
                return


class Scored:
    """Points and link density of a page's elements, but for those that are gone."""

    def __init__(self, tree: Tree, gone: list[bool]):
        tags, parents, n = tree.tags, tree.parents, len(tree.tags)
        self.tree, self.gone = tree, gone
        linked = [False] * n
        for i in range(1, n):
            gone[i] = gone[i] or gone[parents[i]]
            linked[i] = tags[i] == "a" or linked[parents[i]]
        length, links, commas, own, anchors = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n  # own: text outside of inner blocks
        block = list(range(n))
        for i in range(1, n):
            if tags[i] in INLINE:
                block[i] = block[parents[i]]
        for node, text in tree.items:
            if text is not None and not gone[node]:
                size = len(" ".join(text.split()))
                length[node] += size
                links[node] += size if linked[node] else 0
                commas[block[node]] += len(COMMA.findall(text))
                own[block[node]] += size
        for i in range(n - 1, 0, -1):
            if not gone[i]:
                anchors[i] += tags[i] == "a"
                length[parents[i]] += length[i]
                links[parents[i]] += links[i]
                anchors[parents[i]] += anchors[i]
        density = [b / a if a else 0.0 for a, b in zip(length, links, strict=True)]
        for i in range(1, n):  # lists of links inside the article are menus without a name
            gone[i] = gone[i] or gone[parents[i]] or (tags[i] in ("ul", "ol", "div", "table", "p") and anchors[i] >= 3 and density[i] > MANY_LINKS)
        self.length, self.density = length, density

        score, direct, inside = [0.0] * n, [0.0] * n, [0.0] * n
        for i in range(1, n):
            if not gone[i] and tags[i] in PARAGRAPHS and own[i] >= MIN_PARAGRAPH:
                points = 1 + commas[i] + min(own[i] / 100, 3)
                inside[i] += points
                up, level = i if tags[i] in CONTAINERS else parents[i], 1
                direct[up] += points
                while up > 0 and level <= 5:
                    score[up] += points / (1, 2, 6, 9, 12)[level - 1]
                    up, level = parents[up], level + 1
        for i in range(n - 1, 0, -1):
            inside[parents[i]] += inside[i]
        self.score = [s * (1 - d) for s, d in zip(score, density, strict=True)]
        self.direct = [s * (1 - d) for s, d in zip(direct, density, strict=True)]  # from paragraphs of its own
        self.inside = inside  # from all paragraphs below, undiscounted

    def meeting(self, nodes: list[int]) -> int:
        """The lowest element that holds all the nodes."""
        parents = self.tree.parents
        up = nodes[0]
        above = []
        while up >= 0:
            above.append(up)
            up = parents[up]
        places = {node: k for k, node in enumerate(above)}
        deepest = 0
        for node in nodes[1:]:
            while node not in places:
                node = parents[node]
            deepest = max(deepest, places[node])
        return above[deepest]

    def best(self) -> tuple[list[int], bool]:
        """The elements that hold the article, and whether they say so themselves."""
        tags, parents, n = self.tree.tags, self.tree.parents, len(self.tree.tags)
        top = max((i for i in range(1, n) if not self.gone[i]), key=lambda i: (self.score[i], -i), default=0)
        if not top or not self.score[top]:  # no paragraph anywhere
            named = [i for i in range(n) if tags[i] in ("article", "main") and not self.gone[i] and self.length[i]]
            return [named[0] if named else next((i for i in range(n) if tags[i] == "body"), 0)], bool(named)
        most = max(self.direct)
        strong = [i for i in range(1, n) if self.direct[i] and self.direct[i] >= STRONG_SHARE * most]
        holder = self.meeting([*strong, top])
        article, up = 0, holder
        while up > 0:
            if tags[up] == "article" and self.inside[up] * (1 - self.density[up]) >= self.score[top]:
                article = up
            up = parents[up]
        if article:
            return [article], True
        if tags[holder] in ROOTS and len(strong) > 1:  # they meet nowhere: each for itself, whole articles as such
            return sorted({self._container(i) for i in strong}), False
        return [self._container(holder)], False

    def _container(self, i: int) -> int:
        """The element, or the outermost article around it."""
        tags, parents = self.tree.tags, self.tree.parents
        while tags[i] in ("p", "td", "li", "blockquote", "pre"):
            i = parents[i]
        article, up = 0, i
        while up > 0:
            article = up if tags[up] == "article" else article
            up = parents[up]
        return article or i

    def kept(self) -> list[bool]:
        tags, parents, n = self.tree.tags, self.tree.parents, len(self.tree.tags)
        best, says_so = self.best()
        keep = [False] * n
        wanted = max(1.0, SIBLING_SHARE * max(self.score))
        for one in best:
            keep[one] = True
            if tags[one] in ROOTS:
                continue
            for i in range(1, n):
                if parents[i] == parents[one] and not self.gone[i]:
                    plain = not says_so and tags[i] in PLAIN
                    keep[i] = keep[i] or self.score[i] >= wanted or (plain and 0 < self.length[i] and self.density[i] < FEW_LINKS)
        for i in range(1, n):
            keep[i] = keep[i] or keep[parents[i]]
        self._drop_asides(keep, best)
        return keep

    def _drop_asides(self, keep: list[bool], best: list[int]) -> None:
        """Bare text of a container without points, where the article's paragraphs are elements of their own."""
        tags, parents, n = self.tree.tags, self.tree.parents, len(self.tree.tags)
        bare = sum(self.inside[i] for i in range(1, n) if keep[i] and tags[i] in CONTAINERS and not self._has_blocks(i))
        if 2 * bare >= sum(self.inside[i] for i in best):
            return
        dropped = set()
        for i in range(1, n):
            aside = keep[i] and i not in best and tags[i] in ("div", "section") and not self.inside[i] and not self._has_blocks(i)
            if aside or parents[i] in dropped:
                dropped.add(i)
                keep[i] = False

    def _has_blocks(self, i: int) -> bool:
        return i in self._with_blocks

    @property
    def _with_blocks(self) -> set[int]:
        if not hasattr(self, "_parents_of_blocks"):
            tags, parents = self.tree.tags, self.tree.parents
            self._parents_of_blocks = {parents[i] for i in range(1, len(tags)) if tags[i] not in INLINE}
        return self._parents_of_blocks


def cut_by_name(tree: Tree) -> list[bool]:
    """What is gone by its element or its name, given the points that the names compete for."""
    n, parents = len(tree.tags), tree.parents
    sure = [c or (noisy and not article) for c, noisy, article in zip(tree.cut, tree.noisy, tree.articles, strict=True)]
    first = Scored(tree, list(sure))
    gone = list(sure)
    for i in range(1, n):
        gone[i] = gone[i] or gone[parents[i]] or (tree.noisy[i] and first.inside[i] < MOST * first.inside[0])
    return gone


def main_text(html: str) -> str:
    """The article's blocks, each with single spaces, joined by two line feeds; empty if the page has no text."""
    tree = Tree()
    cut = TAG.search(html, html.rfind(">") + 1)  # a page may end inside a tag
    tree.feed(html[: cut.start()] if cut else html)
    tree.close()
    named = any(tree.noisy)
    page = Scored(tree, cut_by_name(tree) if named else list(tree.cut))
    if named and not any(page.length):  # names alone do not empty a page
        page = Scored(tree, list(tree.cut))
    keep, gone = page.kept(), page.gone

    blocks, words = [], []
    for node, text in tree.items:
        if text is None:
            blocks.append(" ".join("".join(words).split()))
            words = []
        elif keep[node] and not gone[node]:
            words.append(text)
    blocks.append(" ".join("".join(words).split()))
    return "\n\n".join(b for b in blocks if b)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Null html counts as empty; pages without text give the empty text. Broken markup
    is read as far as it goes: unclosed elements end with the page. Rows stay as they
    are, repeated and null ids and urls too; an empty table gives no rows; other columns are ignored. Very long pages are read
    whole; work is linear in their length, but for the depth of unclosed elements. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(html) for html in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    whole = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).alias("html"))
    return whole.mapInArrow(run, SCHEMA)
