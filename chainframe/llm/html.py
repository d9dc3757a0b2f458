"""Main text of web pages by tree scoring.

A page is parsed into a tree. Every paragraph scores points for its length and its commas and passes them to
its ancestors, less with each level; a container's points are discounted by the share of its text that
lies in links. The best container tells where the main text is: all of the outermost article or main around it is
kept, and with text beside that the whole part of the page they share; without an article or main, the whole page. Menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are set aside before the scoring, by element,
role and the words of class and id; outside the best container, blocks that are mostly links and hold no running text are too.
Words of class and id alone do not decide against a page's text: an element that another of its names calls content (class="post tags-x"), or
that holds most of the page's paragraph text where no article or main lies beside it, is kept and only loses points; one named for comments
or page furniture needs both.

The text of what is kept is complete: character references are decoded, white space inside a block becomes one space, and blocks are
joined in page order by one space. Null or empty pages, and pages without text, give an empty text. Repeated
rows, null keys and further columns are kept; a column named ``text`` is replaced; an empty table gives an empty result. Parsing and
walking are iterative, so deeply nested and very long pages pass whole.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chainframe.llm.common import bound_batches, others, slices

# Element names of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td"
    " tfoot th thead title tr ul".split()
)
DROPPED = frozenset(
    "applet aside audio button canvas datalist dialog embed fieldset footer form frame frameset head iframe input label math menu meter nav noembed noframes noscript object"
    " option progress script search select style svg template textarea title video".split()
)
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies disclaimer"
    " discussion disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination paywall popup promo"
    " promoted promotion recommended related replies reply respond share sharing shoutbox sidebar signup skip social sponsor sponsored subscribe"
    " subscription tags toolbar topbar widget".split()
)
#: Those of them that name what is never part of an article, however long it is.
STRONG_WORDS = frozenset(
    "breadcrumb breadcrumbs comment comments commentlist consent cookie cookies discussion disqus footer gdpr masthead menu modal nav navbar navigation"
    " overlay pager pagination paywall popup replies reply respond shoutbox sidebar toolbar topbar".split()
)
#: Names of nothing but these call an element content.
CONTENT_WORDS = frozenset("article articles body content contents entry hentry main post posts story text".split())
PENALTY = 25.0  # points that a kept element loses for a word of DROPPED_WORDS
#: Elements that hold a page's content whatever their class says.
HELD = frozenset("html body main article".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd div section figcaption".split())
FAVOURED = {"article": 25.0, "main": 25.0, "div": 5.0, "section": 5.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0, "form": -3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "li": -3.0}
FAVOURED_WORDS, FAVOUR = frozenset("article body content entry main page post story text".split()), 25.0
#: An open element that a start tag ends, and where the search for it stops.
ENDS = {
    **dict.fromkeys(("li",), (frozenset(["li"]), frozenset("ul ol menu".split()))),
    **dict.fromkeys(("dt", "dd"), (frozenset(["dt", "dd"]), frozenset(["dl"]))),
    **dict.fromkeys(("td", "th"), (frozenset(["td", "th"]), frozenset(["tr", "table"]))),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    **dict.fromkeys(("option", "optgroup"), (frozenset(["option"]), frozenset(["select"]))),
}
_PLAIN = frozenset("a b big code em font i nobr s small span strike strong sub sup tt u".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
LEVELS = 5  # ancestors that a paragraph passes points to
LEAST_CHARS = 25
LEAST_SPARED = 200  # characters of paragraphs that speak for an element whose name speaks against it
MENU_SHARE = 0.5  # of links in a block without running text


class Node:
    __slots__ = ("tag", "attrs", "parent", "items", "dropped", "named", "points", "chars", "linked", "prose")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.items: list[Node | str] = []
        self.dropped, self.named, self.points, self.chars, self.linked, self.prose = False, "", 0.0, 0, 0, 0


def names_of(attrs: dict) -> list[list[str]]:
    """The names of class and id in words; names like has-sidebar or no-comments tell of a page's layout and are left out."""
    names = ([w.lower() for w in _WORD.findall(name)] for name in " ".join(attrs.get(k) or "" for k in ("class", "id")).split())
    return [words for words in names if words and words[0] not in ("has", "with", "no", "without")]


def words_of(attrs: dict) -> set[str]:
    """The words of class and id."""
    return set().union(*names_of(attrs))


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.top = Node("#root", {}, None)
        self.open: dict[str, int] = {}  # how many of each element are open

    def _leave(self, node: Node) -> None:
        """Ends the open elements down to node."""
        while True:
            self.open[self.top.tag] -= 1
            last, self.top = self.top, self.top.parent
            if last is node:
                return

    def _end_open(self, tags: frozenset, stops: frozenset) -> None:
        if not any(self.open.get(t) for t in tags):
            return
        node = self.top
        while node.parent and node.tag not in stops:
            if node.tag in tags:
                return self._leave(node)
            node = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in ENDS:
            self._end_open(*ENDS[tag])
        if tag in BLOCK:
            self._end_open(frozenset(["p"]), BLOCK - {"p"})
        node = Node(tag, dict(attrs), self.top)
        node.dropped = _is_dropped(node)
        self.top.items.append(node)
        if tag not in VOID:
            self.top = node
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if self.top.tag == tag and tag not in VOID and tag not in BLOCK:
            self._leave(self.top)

    def handle_endtag(self, tag):
        if not self.open.get(tag):
            return
        node = self.top
        while node.tag != tag:
            if tag in _PLAIN and node.tag in BLOCK:  # an inline end does not end a block
                return
            node = node.parent
        self._leave(node)

    def handle_data(self, data):
        self.top.items.append(data)


def _is_dropped(node: Node) -> bool:
    attrs = node.attrs
    if node.tag in HELD:
        return False
    if node.tag in DROPPED or (attrs.get("role") or "").lower() in DROPPED_ROLES or "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true":
        return True
    if "display:none" in (attrs.get("style") or "").replace(" ", "").lower():
        return True
    if node.tag == "header" or "header" in words_of(attrs):  # a page's header; an article's own one has its title
        up = node.parent
        while up and up.tag not in ("article", "main"):
            up = up.parent
        return up is None and node.tag not in ("h1", "h2", "h3", "h4", "h5", "h6")
    words = words_of(attrs)
    if not DROPPED_WORDS.isdisjoint(words):
        content = any(all(w in CONTENT_WORDS or w.isdigit() for w in name) and not all(map(str.isdigit, name)) for name in names_of(attrs))
        strong = not STRONG_WORDS.isdisjoint(words)
        if strong and not content:
            return True
        node.named = "both" if strong else "content" if content else "weak"
    return False


def _settle_names(root: Node) -> None:
    """Sets aside the elements whose names speak against them: most of the page's paragraph text, or another name, speaks for the rest."""
    flagged = [item for item, opens in _walk(root) if opens and item.named]
    if not flagged:
        return
    for item, opens in _walk(root):
        if opens:
            chars = _plain_chars(item) if item.tag in BLOCK else 0
            item.prose, item.chars = chars if chars >= LEAST_CHARS else 0, chars
        elif opens is False and item.parent is not None:
            item.parent.prose += item.prose
            item.parent.chars += item.chars
    held = [item for item, opens in _walk(root) if opens and item.tag in ("article", "main") and item.chars]
    for node in flagged:
        beside = any(not _within(x, node) and not _within(node, x) for x in held)
        node.dropped = node.named != "content" and (beside or node.prose < LEAST_SPARED or 2 * node.prose <= root.prose)


def _within(node: Node, other: Node) -> bool:
    """Whether a node is another or lies in it."""
    while node is not None and node is not other:
        node = node.parent
    return node is not None


def _walk(node: Node):
    """(node, True) before and (node, False) after its items; strings in between; dropped elements are left out."""
    stack: list = [(node, 0)]
    while stack:
        item, at = stack.pop()
        if at == 0:
            yield item, True
        if at == len(item.items):
            yield item, False
            continue
        stack.append((item, at + 1))
        child = item.items[at]
        if isinstance(child, str):
            yield child, None
        elif not child.dropped:
            stack.append((child, 0))


def _measure(root: Node) -> list[Node]:
    """Counts characters and characters in links of every node; gives the nodes in page order."""
    nodes, links, current = [], 0, root
    for item, opens in _walk(root):
        if opens is None:
            n = len(item.strip())
            current.chars += n
            current.linked += n if links else 0
        elif opens:
            nodes.append(item)
            item.chars = item.linked = 0
            current = item
            links += item.tag == "a"
        else:
            links -= item.tag == "a"
            if item.parent is not None and item is not root:
                item.parent.chars += item.chars
                item.parent.linked += item.linked
                current = item.parent
    return nodes


def _text_of(nodes: list[Node]) -> str:
    """Blocks of the nodes' text in page order, joined by a space."""
    blocks, run = [], []

    def end():
        if words := " ".join("".join(run).split()):
            blocks.append(words)
        run.clear()

    for node in nodes:
        for item, opens in _walk(node):
            if opens is None:
                run.append(item)
            elif item.tag == "br":
                run.append(" ")
            elif item.tag in BLOCK or item.tag == "#root":
                end()
        end()
    return " ".join(blocks)


def _own_text(node: Node) -> tuple[int, int]:
    """(characters, commas) of the text of a node outside its block children."""
    chars = commas = 0
    stack = [node]
    while stack:
        for item in stack.pop().items:
            if isinstance(item, str):
                chars += len(item.strip())
                commas += item.count(",") + item.count("，") + item.count("、")
            elif item.tag not in BLOCK and not item.dropped:
                stack.append(item)
    return chars, commas


def _inline(item: Node | str) -> bool:
    return isinstance(item, str) or item.tag not in BLOCK


def _plain_chars(node: Node) -> int:
    """Characters of the text of a node outside its block children and outside links."""
    chars, stack = 0, [node]
    while stack:
        for item in stack.pop().items:
            if isinstance(item, str):
                chars += len(item.strip())
            elif item.tag not in BLOCK and item.tag != "a" and not item.dropped:
                stack.append(item)
    return chars


def _with_prose(nodes: list[Node]) -> set[int]:
    """Nodes that hold a block with running text: LEAST_CHARS characters outside links."""
    out: set[int] = set()
    for node in nodes:
        up = node if node.tag in BLOCK and _plain_chars(node) >= LEAST_CHARS else None
        while up is not None and id(up) not in out:
            out.add(id(up))
            up = up.parent
    return out


def _reads(item: Node, prose: set[int]) -> bool:
    """Whether a block beside the main part is text: a heading, a paragraph, or what holds running text."""
    if item.dropped or item.tag not in BLOCK or not item.chars:
        return False
    return id(item) in prose or item.tag in ("article", "main") or item.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6") and item.linked <= MENU_SHARE * item.chars


def _outermost(node: Node | None) -> Node | None:
    """The outermost article or main that a node is or lies in."""
    out = None
    while node is not None:
        out, node = node if node.tag in ("article", "main") else out, node.parent
    return out


def _part_of(best: Node, root: Node, prose: set[int]) -> Node:
    """The part of the page that is main text."""
    part = _outermost(best)
    if part is None:
        return root
    top, node = part, part
    while node.parent is not None:
        if any(isinstance(x, Node) and x is not node and _reads(x, prose) for x in node.parent.items):
            top = node.parent
        node = node.parent
    return top


def _leave_menus(part: Node, best: Node, prose: set[int]) -> None:
    """Sets aside what is mostly links without running text: blocks outside best, and runs of loose text beside blocks."""
    stack = [part]
    while stack:
        node = stack.pop()
        if node is best:
            continue
        kept, run = [], []

        def end(kept=kept, run=run):
            linked = sum(x.chars if x.tag == "a" else x.linked for x in run if isinstance(x, Node) and not x.dropped)
            chars = sum(len(x.strip()) if isinstance(x, str) else 0 if x.dropped else x.chars for x in run)
            if linked <= MENU_SHARE * chars or chars - linked >= LEAST_CHARS:
                kept.extend(run)
            run.clear()

        for item in node.items:
            if _inline(item) and not (isinstance(item, Node) and id(item) in prose):
                run.append(item)
                continue
            end()
            if id(item) in prose:
                stack.append(item)
            elif item.linked > MENU_SHARE * item.chars and item is not best:
                continue
            kept.append(item)
        end()
        if any(isinstance(x, Node) and x.tag in BLOCK for x in node.items):
            node.items = kept


def main_text(html: str) -> str:
    """The main text of a page."""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    _settle_names(tree.root)
    nodes = _measure(tree.root)
    scored: dict[int, Node] = {}
    for node in nodes:
        if node.tag not in PARAGRAPHS:
            continue
        chars, commas = _own_text(node)
        if chars < LEAST_CHARS:
            continue
        points = (1 + commas + min(chars / 100, 3)) * (1 - node.linked / max(node.chars, 1))
        up, level = node.parent if node.tag in ("p", "pre", "blockquote", "li", "dd", "td", "figcaption") else node, 0
        while up is not None and level < LEVELS:
            if id(up) not in scored:
                scored[id(up)] = up
                up.points = FAVOURED.get(up.tag, 0.0) + FAVOUR * (not FAVOURED_WORDS.isdisjoint(words_of(up.attrs)) and up.tag not in ("html", "body", "#root")) - PENALTY * bool(up.named)
            up.points += points / (1, 2, 6, 9, 12)[level]
            up, level = up.parent, level + 1
    density = lambda n: n.linked / max(n.chars, 1)
    final = {k: n.points * (1 - density(n)) for k, n in scored.items()}
    if not final:
        parts = [n for n in nodes if n.tag in ("article", "main") and _outermost(n.parent) is None]
        return _text_of(parts or [tree.root])
    best = max(scored.values(), key=lambda n: final[id(n)])
    prose = _with_prose(nodes)
    up = best
    while up is not None:  # the best container stays, even if it is all links
        prose.add(id(up))
        up = up.parent
    part = _part_of(best, tree.root, prose)
    _leave_menus(part, best, prose)
    return _text_of([part])


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages without the html, with ``text``."""
    bound_batches(pages.sparkSession)
    keep = others(pages, html, "text")
    schema = T.StructType([pages.schema[c] for c in keep] + [T.StructField("text", T.StringType(), False)])

    def run(batches):
        for batch in slices(batches, html):
            texts = pa.array((main_text(h) if h else "" for h in batch.column(html).to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), texts], names=[*keep, "text"])

    return pages.select(*keep, html).mapInArrow(run, schema)
