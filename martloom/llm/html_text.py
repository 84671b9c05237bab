"""Main text of web pages by scoring the element tree.

Paragraphs earn points for length and commas and pass them to their
ancestors; a container's points are discounted by its link density.  The best
container, widened to the article element around it, and those of its siblings
that read like text are kept, without menus, forms, notices and the like.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

TOKEN = re.compile(
    r"<!--(?:(?!-->).)*+(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/a-zA-Z][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
WORDS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is not markup, up to their own end tag.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
DROPPED = RAW | frozenset(
    "nav header footer aside form button select option input svg math canvas object dialog menu head audio video "
    "datalist fieldset label".split())
BLOCK = frozenset(
    "address article blockquote body caption center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup "
    "hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split()) | DROPPED
PARAGRAPH = frozenset("p pre td blockquote li dd div section h1 h2 h3 h4 h5 h6".split())
# Kept where they stand between kept siblings, however short.
BETWEEN = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 ul ol dl table figure".split())
# An opening tag ends an open element of the second set, looking no further than the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
# Parts of class names and ids that mark what is not the article.
UNWANTED = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices alert popup modal overlay paywall nav navbar navigation menu menus breadcrumb breadcrumbs "
    "header masthead footer sidebar sidebars aside related recommended share sharing social comment comments "
    "commentlist disqus respond reply replies subscribe subscription newsletter signup login search widget widgets "
    "toolbar pagination pager".split())
# Parts of names of what can be longer than the article itself.
REMARKS = frozenset(
    "comment comments commentlist disqus respond reply replies related recommended cookie cookies consent gdpr".split())
# Parts of names that say what a text itself is, not where it stands.
NOTICES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices alert popup modal overlay paywall comment comments commentlist disqus respond reply replies "
    "subscribe subscription newsletter signup".split())
PROSE = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6".split())
UNWANTED_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu".split())
LINKED_MENU = 0.8
# Letters from which a text is a paragraph without being marked as one.
PARAGRAPH_LETTERS = 80


class Node:
    __slots__ = ("tag", "parent", "children", "dropped", "named", "notice", "score", "letters", "linked", "commas", "links")

    def __init__(self, tag: str, parent: "Node | None", dropped: bool):
        self.tag, self.parent, self.dropped, self.named, self.notice = tag, parent, dropped, "", False
        self.children: list[Node | str] = []
        self.score = 0.0
        self.letters = self.linked = self.commas = self.links = 0

    @property
    def density(self) -> float:
        return self.linked / self.letters if self.letters else 0.0


def unwanted(attributes: str) -> tuple[bool, str, bool]:
    """(hidden, named, notice): no part of the page to read; else ``"whole"`` or ``"part"`` if a class or id names something else.

    ``"whole"`` if an entire name says so or a part is one of ``REMARKS``; ``"part"`` as in ``with-sidebar``.
    ``notice`` if a part is one of ``NOTICES``.
    """
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    style = found.get("style", "").replace(" ", "").lower()
    if (found.get("role", "").lower() in UNWANTED_ROLES or "display:none" in style
            or found.get("aria-hidden", "").lower() == "true" or " hidden" in ATTRIBUTE.sub("", attributes).lower()):
        return True, "", False
    names = f"{found.get('class', '')} {found.get('id', '')}"
    words = UNWANTED.intersection(w.lower() for w in WORDS.findall(names))
    if not words:
        return False, "", False
    return False, "whole" if words & REMARKS or UNWANTED & set(names.lower().split()) else "part", bool(words & NOTICES)


def parse(page: str) -> Node:
    """The element tree; end tags may be missing, and wrong ones are ignored."""
    root = node = Node("#root", None, False)
    at, depth = 0, {}
    match = TOKEN.match(page, at)
    while match:
        at = match.end()
        name = match["name"]
        if match["text"] is not None:
            node.children.append(match["text"])
        elif name is not None:
            name = name.lower()
            if match["close"]:
                if depth.get(name):
                    while True:
                        depth[node.tag] -= 1
                        closed, node = node, node.parent
                        if closed.tag == name:
                            break
                elif name in ("p", "br"):
                    node.children.append(Node(name, node, False))
            else:
                if name in BLOCK and name not in RAW and depth.get("p"):
                    while depth.get("p"):  # a block ends an open paragraph, with the inline elements in it
                        depth[node.tag] -= 1
                        node = node.parent
                elif name in ENDS:
                    ended, border = ENDS[name]
                    up = node
                    while up.parent is not None and up.tag not in ended and up.tag not in border:
                        up = up.parent
                    if up.tag in ended:
                        while True:
                            depth[node.tag] -= 1
                            closed, node = node, node.parent
                            if closed is up:
                                break
                attributes = match["attributes"]
                child = Node(name, node, name in DROPPED)
                if not child.dropped and ("=" in attributes or "hidden" in attributes):
                    hidden, child.named, child.notice = unwanted(attributes)
                    child.dropped = hidden or child.named != ""
                node.children.append(child)
                if name in RAW:
                    end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
                    stop = page.find(">", end.start()) if end else -1
                    at = stop + 1 if stop >= 0 else len(page)
                elif name not in VOID:
                    node = child
                    depth[name] = depth.get(name, 0) + 1
        match = TOKEN.match(page, at)
    return root


def in_order(root: Node) -> list[Node]:
    """All elements, parents first."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [c for c in reversed(node.children) if not isinstance(c, str)]
    return out


def measure(nodes: list[Node]) -> None:
    """Letters, linked letters and commas of every element, without what is dropped."""
    for node in reversed(nodes):
        if node.dropped:
            continue
        for child in node.children:
            if isinstance(child, str):
                size = len(child) if " " not in child and "\n" not in child else len(" ".join(child.split()))
                node.letters += size
                node.commas += child.count(",")
            elif not child.dropped:
                node.letters += child.letters
                node.linked += child.linked
                node.commas += child.commas
                node.links += child.links
        if node.tag == "a":
            node.linked, node.links = node.letters, node.links + 1


def keep_articles(nodes: list[Node]) -> None:
    """A wrapper named after a sidebar or header is no such thing if an outer article is in it."""
    wrappers = ("body", "html", "div", "section", "main", "center", "td", "tr", "tbody", "table", "#root")
    for node in nodes:
        if node.tag in ("article", "main") and not node.dropped:
            above, up = [], node.parent
            while up is not None:
                above.append(up)
                up = up.parent
            if not any(n.tag == "article" for n in above):
                for n in above:
                    if n.tag in wrappers:
                        n.dropped = False
        elif node.tag in ("body", "html"):
            node.dropped = False


def keep_text(nodes: list[Node]) -> None:
    """Elements dropped for their name alone come back if they hold most of the page's text outside links.

    So a name does not empty a page or drop its article.  Where an entire name
    says what the element is, or it may be remarks longer than the article, it
    comes back only if less than a paragraph is left without it; a part of a
    name drops an element other than an article if an article is elsewhere.
    """
    if not any(n.named and n.dropped for n in nodes):
        return
    below: dict[Node, int] = {}  # with what is dropped for its name
    open_below: dict[Node, int] = {}  # without
    for node in reversed(nodes):
        below[node] = open_below[node] = 0
        if (node.dropped and not node.named) or node.tag == "a":
            continue
        for child in node.children:
            if isinstance(child, str):
                size = len(" ".join(child.split()))
                below[node] += size
                open_below[node] += size
            else:
                below[node] += below[child]
                open_below[node] += 0 if child.dropped else open_below[child]
    left = open_below[nodes[0]]
    articles: list[Node] = []
    gone: set[Node] = set()
    for node in nodes:
        if node.parent in gone or node.dropped:
            gone.add(node)
        elif node.tag in ("article", "main") and open_below[node] >= PARAGRAPH_LETTERS:
            articles.append(node)
    # Two elements cannot both hold more than half, so those that may come back are in each other.
    for node in nodes:
        if not (node.named and node.dropped and 2 * below[node] > below[nodes[0]]):
            continue
        above, up = [], node.parent
        while up is not None and not up.dropped:
            above.append(up)
            up = up.parent
        if up is not None:
            return
        if node.named == "whole":
            back = left < PARAGRAPH_LETTERS
        else:
            back = node.tag == "article" or all(a in above for a in articles)
        if not back:
            return
        node.dropped = False
        left += open_below[node]


def keep_prose(nodes: list[Node]) -> None:
    """A paragraph or heading inside an article stays whatever place its name speaks of.

    Not if the name says that the text is a notice, an advert or a remark, nor
    if it holds a link, a form or the like, nor if it is less than a paragraph.
    """
    inside: set[Node] = set()
    for node in nodes:  # parents come first
        if node.parent is not None and node.parent in inside and not node.parent.dropped or (
                node.tag in ("article", "main") and not node.dropped):
            inside.add(node)
        if not (node in inside and node.dropped and node.named and not node.notice and node.tag in PROSE):
            continue
        size, below, plain = 0, [node], True
        while below and plain:
            for child in below.pop().children:
                if isinstance(child, str):
                    size += len(" ".join(child.split()))
                else:
                    plain = plain and child.tag != "a" and not child.dropped
                    below.append(child)
        if plain and (size >= PARAGRAPH_LETTERS or node.tag[0] == "h"):
            node.dropped = False


def main_nodes(root: Node) -> list[Node]:
    """The best container and the siblings kept with it, in page order; empty if nothing reads like text."""
    nodes = in_order(root)
    keep_articles(nodes)
    keep_text(nodes)
    keep_prose(nodes)
    for node in nodes:  # parents come first
        if node.parent is not None and node.parent.dropped:
            node.dropped = True
    measure(nodes)
    alive = [n for n in nodes if not n.dropped]
    for node in alive:
        if node.tag in PARAGRAPH or node.tag in ("article", "main", "body", "#root"):
            own = sum(len(c) for c in node.children if isinstance(c, str) and not c.isspace())
            inline = sum(c.letters for c in node.children if not isinstance(c, str) and not c.dropped and c.tag not in BLOCK)
            if own + inline == 0:
                continue
            size = own + inline
            points = (1 + node.commas + min(size / 100, 3) if node.tag in ("p", "pre", "td", "blockquote") or size >= 80
                      else size / 100) * (1 - node.density)
            up, level = (node.parent if node.tag == "p" or node.parent else node), 0
            if node.tag in ("div", "section", "article", "main", "body", "#root", "td"):
                up = node
            while up is not None:
                up.score += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
                up, level = up.parent, level + 1
    best, most = None, 0.0
    for node in alive:
        if node.tag in ("p", "li", "ul", "ol", "a", "b", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "dl"):
            continue
        score = node.score * (1 - node.density)
        if score > most:
            best, most = node, score
    if best is None:
        return []
    up = best
    while up is not None:
        if up.tag == "article" or up.tag == "main" and best.tag != "article":
            best = up
        up = up.parent
    most = max(most, best.score * (1 - best.density))
    if best.parent is None:
        return [best]
    siblings = [c for c in best.parent.children if not isinstance(c, str) and not c.dropped]
    kept = []
    for sibling in siblings:
        if sibling is best:
            kept.append(sibling)
        elif sibling.tag == "article" or best.tag not in ("article", "main"):
            paragraph = sibling.tag in ("p", "pre", "blockquote") and (
                sibling.letters >= PARAGRAPH_LETTERS and sibling.density < 0.25 or not sibling.linked and ends_sentence(sibling))
            heading = sibling.tag == "h1"
            if paragraph or heading or sibling.score * (1 - sibling.density) >= max(10, most / 5):
                kept.append(sibling)
    if best.tag not in ("article", "main"):  # short paragraphs, headings and lists between them belong to the text
        inside = siblings[siblings.index(kept[0]):siblings.index(kept[-1]) + 1]
        chosen = set(kept)
        kept = [c for c in inside if c in chosen or c.tag in BETWEEN and c.letters and c.density < 0.25]
    return kept


def ends_sentence(node: Node) -> bool:
    text = "".join(c if isinstance(c, str) else "".join(blocks_of([c])) for c in node.children).rstrip()
    return text.endswith((".", "!", "?", "…", "。", "！", "？"))


def is_menu(node: Node) -> bool:
    return node.tag in ("ul", "ol", "div", "section", "table", "dl") and node.links >= 3 and node.density > LINKED_MENU


def blocks_of(nodes: list[Node]) -> list[str]:
    """Texts of the blocks in page order: references decoded, white space single, empty ones left out."""
    out, parts = [], []

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append(text)

    for top in nodes:
        stack: list[tuple[Node | str, bool]] = [(top, False)]
        while stack:
            node, leaving = stack.pop()
            if isinstance(node, str):
                parts.append(node)
            elif leaving:
                flush()
            elif not node.dropped and not (is_menu(node) and node is not top):
                if node.tag == "br":
                    parts.append(" ")
                    continue
                if node.tag in BLOCK:
                    flush()
                    stack.append((node, True))
                stack += [(c, False) for c in reversed(node.children)]
        flush()
    return out


def main_text(page: str) -> str:
    return " ".join(blocks_of(main_nodes(parse(page))))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html, ...).

    Reads the whole html; a null or empty page, or one without readable text,
    gives the empty text.  n_chars counts code points.  Repeated rows and null
    ids give a row each; other columns are not read.
    """
    kind = pages.schema["page_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                batch = whole.slice(k, 256)
                texts = [main_text(p) if p else "" for p in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(
        rows, f"page_id {kind}, url string, text string, n_chars long")
