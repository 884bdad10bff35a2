"""HTML extraction with site template removal.

Pages are read into element trees by a small tolerant reader. Two hashes of each element's subtree are counted per host by Spark, as the
number of different pages it was seen on (inside an article: of different articles): one of its content (tags, classes, text), and one of its form
(tags and classes, without text, inline tags and repeats), by which a menu or an advert recurs whatever its words are. What recurs on many pages of a
host is its template and is deleted: by content anywhere, by form only outside the main elements (the top-level articles, else main) and what is
above them, and only named elements; text blocks inside an article stay, since documents share passages.

What HTML itself names as furniture (navigation, footers, asides, forms, scripts) goes on every page, a heading's ``header`` inside an
article excepted. Class names are a fallback for hosts of few pages, outside the main elements; inside, only those of adverts and reader comments
count, as whole names.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import broadcast_if_small
from barloom.scratch import settle

#: An element is template if it is seen on so many different pages of a host, and on such a share of its different pages; so many do on any host.
MIN_PARENTS, MIN_SHARE, ENOUGH = 8, 0.2, 40

# Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
FURNITURE_TAGS = RAW | frozenset("head nav header footer aside form button select option label input fieldset dialog menu svg canvas object audio video map".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
BLOCKS = frozenset(
    "address article blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
INLINE = frozenset("a abbr b bdi bdo big br cite code del dfn em font i img ins kbd mark q s samp small span strong sub sup time tt u var wbr".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th tr table tbody ul ol dl figure figcaption b i em strong a span br hr code header".split())
#: What stands for a page itself, whatever its class.
PAGE = frozenset(("#root", "html", "body"))
#: Parts of class names and ids that name furniture outside the main elements.
FURNITURE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|promotion|nav|navbar|navigation|menu|breadcrumb|breadcrumbs|"
    r"header|footer|masthead|sidebar|side|aside|widget|related|recommended|share|sharing|social|comment|comments|reply|replies|disqus|cookie|cookies|consent|gdpr|"
    r"notice|notices|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|search|form|pagination|pager|skip|copyright|legal)(?=$|[\s_-])",
    re.I,
)
#: Whole names of what is no text wherever it stands, and of what frames a page without main elements.
COMMENT_NAMES = frozenset("ad ads advert adverts advertisement sponsored newsletter comment comments comment-list commentlist comments-area comments-section disqus disqus_thread".split())
FRAME_NAMES = COMMENT_NAMES | frozenset("banner nav navbar navigation menu breadcrumb breadcrumbs header footer masthead sidebar widget cookie cookies consent popup modal pagination pager copyright".split())
#: What a start tag ends when it is still open, up to the tags behind the bar.
CLOSES = {
    "li": ("li", "ul ol"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "option": ("option", "select"),
}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}
#: The tags that decide what a start tag closes.
LISTED = frozenset().union(*[a | b for a, b in CLOSES.values()])
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
STOP = re.compile(r">|=\s*([\"'])")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
SPACE = re.compile(r"\s+")
DIGITS = re.compile(r"[0-9]+")


class Element:
    __slots__ = ("block", "children", "code", "form", "listed", "names", "parent", "role", "tag")

    def __init__(self, tag: str, parent: Element | None, names: str = "", role: str = "") -> None:
        self.tag, self.parent, self.names, self.role = tag, parent, names, role
        self.children: list[Element | str] = []
        self.code = self.form = 0
        #: The nearest element, itself included, that is a block, and that decides what a start tag closes.
        self.block: Element | None = self if parent is None or tag in BLOCKS else parent.block
        self.listed: Element | None = self if parent is None or tag in LISTED else parent.listed

    def named(self, names: frozenset[str]) -> bool:
        return bool(self.names) and not names.isdisjoint(self.names.lower().split())


def _tag_end(page: str, at: int, quoted: bool) -> int:
    """Where the tag whose name ends at ``at`` has its closing bracket, past quoted values; -1 if it has none."""
    while quoted and (found := STOP.search(page, at)):
        if not found[1]:
            return found.start()
        close = page.find(found[1], found.end())
        if close < 0:
            break
        at = close + 1
    return -1


def read_page(page: str | None) -> Element:
    """The tree of a page. Unknown and unclosed tags, stray ends and bare signs are taken as browsers do, roughly: a stray end
    is passed over, a block ends an open paragraph, and what is open ends with its parent. Where a quoted value has no end, tags
    end at the next bracket. Reading takes time in proportion to the page, whatever is in it."""
    page = page or ""
    root = Element("#root", None)
    now, at, quoted = root, 0, True
    opened: Counter[str] = Counter()
    last_bracket = page.rfind(">")

    def close(element: Element) -> Element:
        """Close an open element and all in it; returns its parent."""
        nonlocal now
        while True:
            opened[now.tag] -= 1
            now, ended = now.parent, now
            if ended is element:
                return now

    while at < len(page):
        start = page.find("<", at)
        if start < 0 or start > last_bracket:
            now.children.append(page[at:] if start < 0 or not NAME.match(page, start + 1) else page[at:start])
            break
        name = NAME.match(page, start + 1) or (NAME.match(page, start + 2) if page.startswith("</", start) else None)
        if not name:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                stop = len(page) if end < 0 else end + 3
            elif page.startswith(("<!", "<?", "</"), start):
                stop = page.find(">", start) + 1
            else:
                now.children.append(page[at : start + 1])
                at = start + 1
                continue
            if start > at:
                now.children.append(page[at:start])
            at = stop
            continue
        if start > at:
            now.children.append(page[at:start])
        end = _tag_end(page, name.end(), quoted)
        if end < 0:
            quoted, end = False, page.find(">", name.end())
            if end < 0:
                break
        at, tag = end + 1, name[0].lower()
        if page[start + 1] == "/":
            if opened[tag]:
                element = now
                while element.tag != tag:
                    element = element.parent
                close(element)
            continue
        if tag in BLOCKS and opened["p"] and now.block.tag == "p":
            close(now.block)
        if tag in CLOSES:
            ends, until = CLOSES[tag]
            if any(opened[x] for x in ends):
                above, last = now.listed, None
                while above.parent is not None and above.tag not in until:
                    if above.tag in ends:
                        last = above
                    above = above.parent.listed
                if last is not None:
                    close(last)
        names = role = ""
        body = page[name.end() : end]
        if "=" in body:
            given = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(body)}
            names, role = f"{given.get('class', '')} {given.get('id', '')}".strip(), given.get("role", "").lower()
        new = Element(tag, now, names, role)
        now.children.append(new)
        if tag in VOID or body.endswith("/"):
            continue
        if tag in RAW:
            ended = re.compile(rf"</{re.escape(tag)}\s*+>", re.I).search(page, at)
            new.children.append(page[at : ended.start() if ended else len(page)])
            at = ended.end() if ended else len(page)
            continue
        now = new
        opened[tag] += 1
    return root


def _children_first(root: Element) -> Iterator[Element]:
    order, stack = [], [root]
    while stack:
        element = stack.pop()
        order.append(element)
        stack += [x for x in element.children if isinstance(x, Element)]
    return reversed(order)


def _hash(parts: list[str]) -> int:
    return xxhash.xxh64_intdigest("\x00".join(parts).encode("utf-8", "replace")) - (1 << 63)


def code_subtrees(root: Element) -> None:
    """Set the hashes of each element's subtree, children first: of its content, and of its form."""
    for element in _children_first(root):
        parts, form = [element.tag, element.names], ["form", element.tag, DIGITS.sub("0", element.names)]
        for x in element.children:
            if isinstance(x, Element):
                parts.append(f"<{x.code}>")
                shape = str(x.form)
                if x.tag not in INLINE and shape != form[-1]:
                    form.append(shape)
            else:
                parts.append(SPACE.sub(" ", x).strip())
        element.code, element.form = _hash(parts), _hash(form)


def main_elements(root: Element) -> list[Element]:
    """The top-level articles, else the top-level main elements, that are not inside what HTML names as furniture; a form may hold them."""
    for tag in ("article", "main"):
        found, stack = [], [root]
        while stack:
            element = stack.pop()
            if element.tag == tag or (tag == "main" and element.role == "main"):
                found.append(element)
            elif element.tag in PAGE or element.tag == "form" or not (element.tag in FURNITURE_TAGS or element.role in FURNITURE_ROLES - {"form"}):
                stack += [x for x in reversed(element.children) if isinstance(x, Element)]
        if found:
            return found
    return []


class Layout:
    """The main elements of a page, what is above them, and what of the page is furniture by its tag, role or name."""

    def __init__(self, root: Element) -> None:
        self.root, mains = root, main_elements(root)
        self.own = {id(x) for x in mains}
        #: What is above a main element holds it, whatever it is; without main elements so does a form with more than half of the text.
        self.above: set[int] = set()
        for element in mains or self._page_forms():
            while element is not None and id(element) not in self.above:
                self.above.add(id(element))
                element = element.parent

    def _page_forms(self) -> list[Element]:
        sizes: dict[int, int] = {}
        forms = []
        for x in _children_first(self.root):
            sizes[id(x)] = 0 if x.tag in RAW else sum(sizes[id(y)] if isinstance(y, Element) else len(y) - y.count(" ") for y in x.children)
            if x.tag == "form":
                forms.append(x)
        return [x for x in forms if 2 * sizes[id(x)] > sizes[id(self.root)]]

    def stays(self, element: Element) -> bool:
        return element.tag in PAGE or id(element) in self.above or id(element) in self.own

    def furniture(self, element: Element, inside: bool) -> bool:
        """Of an element that doesn't stay in any case; ``inside`` a main element or not."""
        if element.tag in FURNITURE_TAGS and not (inside and element.tag == "header"):
            return True
        if element.role in FURNITURE_ROLES:
            return True
        if inside:
            return element.named(COMMENT_NAMES)
        return bool(element.names and FURNITURE_NAMES.search(element.names)) if self.own else element.named(FRAME_NAMES)

    def walk(self) -> Iterator[tuple[Element, Element, bool]]:
        """The elements that may go, each with its main element or else the page, and whether it is furniture; what furniture holds goes with it."""
        stack = [(x, self.root) for x in reversed(self.root.children) if isinstance(x, Element)]
        while stack:
            element, under = stack.pop()
            if id(element) in self.own:
                under = element
            elif not self.stays(element):
                goes = self.furniture(element, under is not self.root)
                yield element, under, goes
                if goes:
                    continue
            stack += [(x, under) for x in reversed(element.children) if isinstance(x, Element)]

    def codes(self, element: Element, under: Element) -> list[int]:
        """The hashes by which an element may be template."""
        if under is not self.root:
            return [] if element.tag in TEXT_BLOCKS else [element.code]
        named = element.names or element.tag in FURNITURE_TAGS
        return [element.code, element.form] if self.own and named else [element.code]


def main_text(root: Element, template: frozenset[int] | set[int] = frozenset()) -> str:
    """The blocks of the body that are neither furniture nor template, joined by two line feeds.
    White space within a block is one blank; a line break is white space."""
    layout = Layout(root)
    gone = {id(x) for x, under, goes in layout.walk() if goes or (template and any(c in template for c in layout.codes(x, under)))}
    blocks: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = SPACE.sub(" ", html.unescape("".join(line))).strip()
        line.clear()
        if text:
            blocks.append(text)

    stack: list[Element | str | None] = [root]
    while stack:
        x = stack.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            line.append(x)
        elif id(x) not in gone:
            if x.tag == "br":
                line.append(" ")
            if x.tag in BLOCKS or x is root:
                end()
                stack.append(None)
            stack += reversed(x.children)
    end()
    return "\n\n".join(blocks)


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; empty for null and for what has none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def site_templates(pages: DataFrame, min_parents: int = MIN_PARENTS, min_share: float = MIN_SHARE) -> DataFrame:
    """``host`` and ``codes``, the subtree hashes of its template, of content and of form. ``pages``: ``host`` and ``html``.

    A subtree counts once for each different page, and inside a main element once for each different one, so copies count
    once; so do they among the pages of the host that ``min_share`` is taken of. From ``ENOUGH`` pages on no share is needed.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                root = read_page(page)
                code_subtrees(root)
                layout = Layout(root)
                seen.add((host, root.code, None))
                seen.update((host, code, under.code) for x, under, _ in layout.walk() if x.tag not in RAW for code in layout.codes(x, under))
            hosts, codes, under = zip(*seen, strict=True) if seen else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(codes, pa.int64()), pa.array(under, pa.int64())], names=["host", "code", "under"])

    # A row without ``under`` is a page.
    seen = pages.select("host", "html").mapInArrow(work, "host string, code long, under long").distinct()
    counted = seen.groupBy("host", "code").agg(F.count("under").alias("found"), F.bool_or(F.col("under").isNull()).alias("page"))
    counted = settle(counted.where((F.col("found") >= min_parents) | F.col("page")))
    sizes = broadcast_if_small(settle(counted.where("page").groupBy("host").agg(F.count("*").alias("pages"))), 64)
    needed = F.least(F.col("pages") * min_share, F.lit(float(ENOUGH)))
    templates = counted.where(F.col("found") >= min_parents).join(sizes, "host").where(F.col("found") >= needed)
    return templates.groupBy("host").agg(F.collect_list("code").alias("codes"))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_parents: int = MIN_PARENTS, min_share: float = MIN_SHARE) -> DataFrame:
    """One row for each row of ``pages``: its id, its URL and ``text``, empty where there is none.

    Null pages are empty. Pages without a host share the empty host. Repeated rows stay rows of their own; an empty table has none.
    Very long pages and broken markup are read whole, in time in proportion to their length.
    """
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html")).withColumn("host", host_of(F.col("url")))
    templates = settle(site_templates(rows, min_parents, min_share))
    # Most hosts have a few codes; the largest list bounds what a row of the broadcast takes.
    largest = templates.agg(F.coalesce(F.max(F.size("codes")), F.lit(0))).first()[0]
    joined = rows.join(broadcast_if_small(templates, 64 + 8 * largest), "host", "left").select("id", "url", "html", "codes")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, codes in zip(batch.column("html").to_pylist(), batch.column("codes").to_pylist(), strict=True):
                root = read_page(page)
                if codes:
                    code_subtrees(root)
                texts.append(main_text(root, set(codes or ())))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], names=["id", "url", "text"])

    kinds = [rows.schema[c].dataType.simpleString() for c in ("id", "url")]
    found = joined.mapInArrow(work, f"id {kinds[0]}, url {kinds[1]}, text string")
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")
