"""Operator 6: the main text of web pages by composite text density."""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import any_names, without

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)
#: Elements that are never part of an article.
DROPPED = frozenset("head script style noscript template svg math canvas object embed iframe audio video button select textarea input".split())
#: Elements beside an article, unless they hold it.
BESIDE = frozenset("nav footer aside dialog menu".split())
#: Start tags that leave an open head open.
IN_HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
#: What a start tag closes, up to the nearest element of the third set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
CLOSES_P = BLOCKS - {"body", "html", "option", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
#: Blocks that are parts of a text, never one by themselves.
PARTS = frozenset("p ul ol li dl dt dd table tbody thead tfoot tr td th h1 h2 h3 h4 h5 h6 blockquote pre".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
KEEP_WHOLE = frozenset(("html", "body", "article", "main"))
_NAMES = (
    "ads?|ad(?:box|slot|unit|space|sense|wrap\\w*|container)|adsbygoogle|advert\\w*|gdpr\\w*|ccpa|banner|breadcrumbs?|comments?|cookies?|consent|disqus|disclaimer|footer|masthead|menu|modal|nav|navbar|navigation|newsletter|"
    "notices?|popup|promo\\w*|related|replies|share|sharing|sidebar|social|sponsor\\w*|subscribe|toolbar"
)
#: Names of what follows an article and may be longer than it, but not of a state such as comments-open.
_AFTER = re.compile(r"(?:[a-z0-9]+[-_])*(?:comments?|disqus|related|replies)(?:[-_](?!open|closed|on|off|enabled|disabled|page)[a-z0-9_-]*)?$", re.I)
_NOISE = re.compile(rf"(?:(?!has|with|no)[a-z0-9]+[-_])*(?:{_NAMES})(?:[-_][a-z0-9_-]*)?$", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
#: A tag that the end of the page cuts off.
_CUT_TAG = re.compile(r"<[/?a-zA-Z][^<>]*\Z")
_SPACE = re.compile(r"\s+")


#: Characters outside links that make no article yet.
LITTLE = 80
#: How surely an element is no part of an article: by a name that wrappers have too, by a name of what follows an article,
#: by its kind.
NAMED, AFTER, KIND = 1, 2, 3


def noise(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> int:
    """Whether an element looks like one of the parts that surround an article, by its name, role, class or id, or 0."""
    if tag in BESIDE or tag == "header" and not in_article:
        return KIND
    if tag == "form":
        return NAMED
    if tag == "header" or tag in KEEP_WHOLE or not attrs:
        return 0
    found = 0
    for name, value in attrs:
        if name == "hidden":
            return KIND
        if not value:
            continue
        if name == "role" and value.lower() in _ROLES:
            return KIND
        if name in ("class", "id"):
            for word in value.split():
                if _NOISE.match(word):
                    found = max(found, AFTER if _AFTER.match(word) else NAMED)
    return found


class Page(HTMLParser):
    """The tree of a page as lists by node number, parents before children; text pieces in page order with their node."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.links = ["html"], [-1], [False]
        self.texts: list[tuple[int, str]] = []
        #: Open elements: node numbers, or -1, -2, ... for elements that are left out, whose names are in ``left_out``.
        self.stack, self.noise, self.articles = [0], 0, 0
        self.left_out: list[str] = []
        #: Elements that look like noise, and how surely; what they hold is read, since it may be the article.
        self.doubtful: dict[int, int] = {}
        self.forms = 0
        #: Where the open head is in the stack, or 0.
        self.head = 0

    def _pop(self) -> None:
        node = self.stack.pop()
        if len(self.stack) <= self.head:
            self.head = 0
        if node < 0:
            self.noise -= 1
        elif self.tags[node] in ("article", "main"):
            self.articles -= 1
        elif self.tags[node] == "form":
            self.forms -= 1

    def _name(self, i: int) -> str:
        node = self.stack[i]
        return self.left_out[-node - 1] if node < 0 else self.tags[node]

    def _close(self, names, until) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            name = self._name(i)
            if name in names:
                while len(self.stack) > i:
                    self._pop()
                return
            if name in until:
                return

    def _close_head(self) -> None:
        """Its end tag may be left out: content of the body closes it, with all that is open in it but a template."""
        if self.head and all(self._name(i) != "template" for i in range(self.head, len(self.stack))):
            while self.head:
                self._pop()

    def handle_starttag(self, tag, attrs):
        if tag not in IN_HEAD:
            self._close_head()
        if tag in CLOSES_P:
            self._close(("p",), ("td", "th", "li", "div", "article", "section", "button", "body", "table", "blockquote", "form", "nav", "aside", "footer", "header"))
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        if tag == "html" or tag == "body" and "body" in map(self._name, range(1, len(self.stack))):
            return
        if self.noise or tag in DROPPED or tag == "label" and self.forms:
            if tag not in VOID:
                if tag == "head" and not self.noise:
                    self.head = len(self.stack)
                self.left_out.append(tag)
                self.stack.append(-len(self.left_out))
                self.noise += 1
            return
        node = len(self.tags)
        self.tags.append(tag)
        self.parents.append(self.stack[-1])
        self.links.append(tag == "a" or self.links[self.stack[-1]])
        if tag in VOID:
            if tag in ("br", "hr", "wbr"):
                self.texts.append((node, " " if tag != "wbr" else ""))
            return
        doubt = noise(tag, attrs, self.articles > 0)
        if doubt:
            self.doubtful[node] = doubt
        self.articles += tag in ("article", "main")
        self.forms += tag == "form"
        self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        n = len(self.tags)
        self.handle_starttag(tag, attrs)
        if (self.noise or n in self.doubtful) and tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in VOID or tag == "html":
            return
        self._close((tag,), () if tag in BLOCKS or tag in DROPPED else BLOCKS)

    def handle_data(self, data):
        if self.head == len(self.stack) - 1 and self.head and not data.isspace():
            self._close_head()
        if not self.noise:
            self.texts.append((self.stack[-1], data))


def without_noise(page: Page) -> Page:
    """The page less the elements that look like noise and do not hold its article.

    A page with an article or main outside all of them shows its article, so that they all go, but for named wrappers
    with a headed text or an article that have most of the characters outside links. Else a wrapper stays that has an
    article, a headed text or most of the characters; what follows an article also needs that no h1 stands outside, and
    and that there is next to no prose outside; an element is kept against its kind only for an article or main. Nothing
    is kept below what goes.
    """
    if not page.doubtful:
        return page
    n = len(page.tags)
    plain, heads, h1, articles, clean = [0] * n, [0] * n, [False] * n, [False] * n, [True] * n
    for node, text in page.texts:
        if not page.links[node]:
            plain[node] += len(_SPACE.sub(" ", text).strip())
    for node in range(1, n):
        clean[node] = clean[page.parents[node]] and node not in page.doubtful
    shown = headed = False
    for node in range(n - 1, 0, -1):
        tag, up = page.tags[node], page.parents[node]
        if tag in HEADINGS:
            heads[node] = plain[node]
            h1[node] = tag == "h1"
            headed |= h1[node] and clean[node]
        if tag in ("article", "main") and plain[node]:
            articles[node] = True
            shown |= clean[node]
        plain[up] += plain[node]
        heads[up] += heads[node]
        h1[up] |= h1[node]
        articles[up] |= articles[node]
    number, kept = [0] * n, [True] + [False] * (n - 1)
    out = Page()
    for node in range(1, n):
        if not kept[page.parents[node]]:
            continue
        doubt = page.doubtful.get(node, 0)
        if doubt:
            holds = articles[node] or h1[node] and plain[node] > 2 * heads[node]
            most = 2 * plain[node] > plain[0]
            if doubt == KIND:
                stays = articles[node] and not shown
            elif doubt == AFTER:
                # Comments may well be longer than the post; only a page that is hardly more than them is theirs.
                stays = (holds or most) and not shown and not headed and plain[0] - plain[node] < LITTLE
            else:
                stays = holds and most if shown else holds or most
            if not stays:
                continue
        kept[node] = True
        number[node] = len(out.tags)
        out.tags.append(page.tags[node])
        out.parents.append(number[page.parents[node]])
        out.links.append(page.links[node])
    out.texts = [(number[node], text) for node, text in page.texts if kept[node]]
    return out


def densities(page: Page) -> tuple[list[float], list[float], list[int]]:
    """Per node: its link-adjusted characters per tag, the sum of that over its children, and its characters."""
    n = len(page.tags)
    chars, link_chars, tags, link_tags = [0] * n, [0] * n, [1] * n, [0] * n
    for node, text in page.texts:
        size = len(_SPACE.sub(" ", text).strip())
        chars[node] += size
        if page.links[node]:
            link_chars[node] += size
    for node in range(n - 1, 0, -1):
        up = page.parents[node]
        link_tags[node] += page.tags[node] == "a"
        chars[up] += chars[node]
        link_chars[up] += link_chars[node]
        tags[up] += tags[node]
        link_tags[up] += link_tags[node]
    share = link_chars[0] / max(1, chars[0])
    density, sums = [0.0] * n, [0.0] * n
    for node in range(n):
        c, links = chars[node], max(1, link_chars[node])
        if c:
            base = math.log(c / max(1, c - link_chars[node]) * link_chars[node] + share * c + math.e)
            ratio = c / links * tags[node] / max(1, link_tags[node])
            # on a page without links the base is 1 for all nodes, and the logarithm is left at its natural base
            scale = math.log(base) if base > 1 else 1.0
            density[node] = c / tags[node] * math.log(max(1.0, ratio)) / scale
        if node:
            sums[page.parents[node]] += density[node]
    return density, sums, chars


def main_node(page: Page) -> int:
    """The subtree of the largest density sum among those that no node on the path from the body is sparser than the
    body; then up to the article it lies in, or to a block that can be a text by itself."""
    density, sums, _ = densities(page)
    body = body_node(page)
    floor = density[body] * 0.999
    passes = [False] * len(page.tags)
    passes[body] = True
    best = body
    for node in range(body + 1, len(page.tags)):
        passes[node] = passes[page.parents[node]] and density[node] >= floor
        if passes[node] and sums[node] > sums[best]:
            best = node
    inside = best
    while inside > body:
        if page.tags[inside] in ("article", "main"):
            return inside
        inside = page.parents[inside]
    while best > body and (page.tags[best] not in BLOCKS or page.tags[best] in PARTS):
        best = page.parents[best]
    return best


def body_node(page: Page) -> int:
    return next((i for i, t in enumerate(page.tags) if t == "body"), 0)


def fellow_articles(page: Page, root: int, plain: list[int], linked: list[int], tags: list[int]) -> list[int]:
    """The other articles of the text that ``root`` is one of: under the same main, or else the same parent, with a
    quarter of its characters outside links per tag, and not mostly links. A heading that is nothing but a link makes a
    teaser of another page."""
    home = page.parents[root]
    while home >= 0 and page.tags[home] != "main":
        home = page.parents[home]
    home = home if home >= 0 else page.parents[root]
    below, teaser = [False] * len(page.tags), [False] * len(page.tags)
    out = []
    for node in range(1, len(page.tags)):
        up = page.parents[node]
        below[node] = up == home or below[up] and page.tags[up] != "article" and page.tags[home] == "main"
    for node in range(len(page.tags) - 1, 0, -1):
        if page.tags[node] in HEADINGS:
            teaser[node] = linked[node] > 0 and not plain[node]
        teaser[page.parents[node]] |= teaser[node]
    for node in range(1, len(page.tags)):
        if node != root and page.tags[node] == "article" and below[node] and not teaser[node]:
            if plain[node] >= linked[node] and 4 * plain[node] * tags[root] >= plain[root] * tags[node]:
                out.append(node)
    return out


def main_pieces(page: Page) -> list[bool]:
    """Which text pieces belong to the main text: those of the main subtree and, unless it is an article, of the parts
    beside it and beside its parents.

    Composite density grows with the length of a part, so parts are compared by characters outside links per tag: a
    quarter of the least on the path from the body is enough, if links do not have most of the part. Short parts between
    such parts go with them, as do headings before the first; parts that are mostly links do not.
    """
    n, root, body = len(page.tags), main_node(page), body_node(page)
    plain, linked, tags = [0] * n, [0] * n, [1] * n
    first = [len(page.texts)] * n
    sizes = [len(_SPACE.sub(" ", text).strip()) for _, text in page.texts]
    children: list[list[int]] = [[] for _ in range(n)]
    for at, (node, _) in enumerate(page.texts):
        (linked if page.links[node] else plain)[node] += sizes[at]
        first[node] = min(first[node], at)
    for node in range(n - 1, 0, -1):
        up = page.parents[node]
        plain[up] += plain[node]
        linked[up] += linked[node]
        tags[up] += tags[node]
        first[up] = min(first[up], first[node])
        children[up].append(node)
    kept, own = [False] * n, [False] * len(page.texts)
    kept[root] = True
    if page.tags[root] == "article":
        for node in fellow_articles(page, root, plain, linked, tags):
            kept[node] = True
    path = [root]
    if page.tags[root] not in ("article", "main"):
        while path[-1] > body:
            path.append(page.parents[path[-1]])
    least = min(plain[node] / tags[node] for node in path) / 4
    direct: dict[int, list[int]] = {node: [] for node in path[1:]}
    for at, (node, _) in enumerate(page.texts):
        if node in direct:
            direct[node].append(at)
    for below, node in zip(path, path[1:]):
        # the text pieces of the node itself count as parts too; parts in page order
        parts = [(first[c], c, -1) for c in children[node] if first[c] < len(page.texts)] + [(at, -1, at) for at in direct[node]]
        parts.sort()
        inline = sum(linked[c] for c in children[node] if page.tags[c] not in BLOCKS)
        prose = sum(sizes[at] for at in direct[node]) > inline

        def is_text(c: int) -> bool:
            return c < 0 or plain[c] >= linked[c] or page.tags[c] not in BLOCKS and prose

        strong = [k for k, (_, c, at) in enumerate(parts)
                  if c == below or (sizes[at] if c < 0 else plain[c] / tags[c]) >= max(least, 1) and is_text(c)]
        start, end = strong[0], strong[-1]
        while start and (parts[start - 1][1] < 0 and not sizes[parts[start - 1][2]] or page.tags[parts[start - 1][1]] in HEADINGS and parts[start - 1][1] > 0):
            start -= 1
        for _, c, at in parts[start : end + 1]:
            if c < 0:
                own[at] = True
            elif c != below:
                kept[c] = is_text(c)
    for node in range(1, n):
        kept[node] = kept[node] or kept[page.parents[node]]
    return [own[at] or kept[node] for at, (node, _) in enumerate(page.texts)]


def main_text(html: str | None) -> str:
    """The blocks of the main text, white space made single spaces, joined by newlines."""
    if not html:
        return ""
    if html.rfind("<!--") > html.rfind("-->"):
        html += "-->"
    page = Page()
    page.feed(_CUT_TAG.sub("", html))
    page.close()
    page = without_noise(page)
    kept = main_pieces(page)
    n = len(page.tags)
    block = [0] * n
    for node in range(1, n):
        block[node] = node if page.tags[node] in BLOCKS else block[page.parents[node]]
    lines: list[str] = []
    run: list[str] = []
    last = None
    for (node, text), own in zip(page.texts, kept):
        if not own:
            continue
        if block[node] != last:
            lines.append("".join(run))
            run, last = [], block[node]
        run.append(text)
    lines.append("".join(run))
    clean = (_SPACE.sub(" ", line).strip() for line in lines)
    return "\n".join(line for line in clean if line)


@any_names
def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` less the html, with ``text`` and ``n_chars`` (code points).

    A page without text, NULL or empty gives an empty text. Broken markup is read as far as it goes: what is open at
    the end counts as closed there. Repeated rows and NULL ids are rows like any other; columns named text or n_chars
    are replaced. An empty table gives no rows. Each page is handled whole and by itself.
    """
    pages = without(pages, "text", "n_chars")
    at = pages.columns.index(html_col)
    kept = [i for i in range(len(pages.columns)) if i != at]
    schema = T.StructType([*(pages.schema.fields[i] for i in kept), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    names = schema.names

    def extract(batches):
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(at)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(texts, pa.string()), sizes], names=names)

    return pages.mapInArrow(extract, schema)
