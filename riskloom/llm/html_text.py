"""Main text of web pages by template deduction over the pages of a host.

The tokens of a page are its tags, told apart by their path of open elements, and its text blocks. A token's occurrence vector
says how often it occurs on each page of the host. Tokens with one vector form a class; no vector is ever held: pages
fold into a signature of the vector (two sums of page hashes weighted by the counts, the number of pages and the total),
and tokens of a host are grouped by it. A class of two tokens or more that occurs on ``SUPPORT`` pages or more is valid
if its tokens come in one order on all pages, repeated as often as they occur, and if its occurrences always lie in the
same gap of the same enclosing class: then it nests there. The valid classes, nested, are the host's template; the text left in their
gaps are its slots. Three scans of the pages do this: tokens, order and nesting, extraction. Pages never move; what a host's pages need is
written by row block (``store``).

Of the slots, the main text are those in the host's main element, which holds nearly all of its text that is neither template
nor marked as something else (menus, headers, footers, sidebars, notices, adverts, forms, comments: by tag, role and words of
class and id). Within it, a slot with hardly any text but links is a menu, and an element that every page has once and with
the same text is template text. All other text stays whole.

Blocks are divided by block-level tags; ``br`` is white space. A page without a host template (few pages, other layout) is
its own host: its main element is chosen from itself. Cases: null or empty html gives an empty text; rows without url are one host; repeated rows
and page_ids count and are returned as often as they occur; markup cut off at the end, unclosed elements and stray end tags
are read as browsers do, nearly; of main elements that hold as much, the deepest, then the smaller path hash, wins; pages of any length are read whole;
a table without rows gives none. Only page_id, url and html are read.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import store
from riskloom.session import materialise

# Pages of a host that a class occurs on, at least.
SUPPORT = 3
# The main element holds so much of the text that counts.
SHARE = 0.9
# A slot with so much of its text in links is a menu.
LINKS = 0.9
# Entries that a task sums up before it hands them on.
_HELD = 200_000
_MASK = (1 << 64) - 1

# Fixed values of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
_BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section select "
    "summary table tbody td template tfoot th thead title tr ul".split()
)
# A start tag closes an open element of its group, as far as the group's scope reaches.
_CLOSES = {
    **{t: (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})) for t in ("li",)},
    **{t: (frozenset({"dt", "dd"}), frozenset({"dl"})) for t in ("dt", "dd")},
    **{t: (frozenset({"option"}), frozenset({"select"})) for t in ("option", "optgroup")},
    **{t: (frozenset({"td", "th"}), frozenset({"table"})) for t in ("td", "th")},
    "tr": (frozenset({"tr"}), frozenset({"table"})),
    **{t: (frozenset({"thead", "tbody", "tfoot"}), frozenset({"table"})) for t in ("thead", "tbody", "tfoot")},
}
_P_SCOPE = frozenset("article aside body button caption details dialog div fieldset figure footer form header html li main nav section table td th".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_HOLDERS = frozenset("article body center div html main section table tbody td tr".split())
_LISTED = frozenset("dd div dl dt li menu ol section td th tr ul".split())

# Tags, roles and words of class and id that mark text as something else than the article.
_OTHER_TAGS = frozenset(
    "aside button canvas datalist dialog footer form head header iframe input menu nav noscript object search select svg template textarea".split()
)
_OTHER_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
_OTHER_WORDS = frozenset(
    "ad ads adsense advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices overlay "
    "pager pagination popup promo promotion recommended related reply replies respond share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription toolbar widget".split()
)
# These belong to the article when they lie in it.
_OF_ARTICLE = frozenset({"header"})

_SCAN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?/][^a-zA-Z>][^>]*(?:>|\Z)|</>|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _hash(text: str, seed: int = 0) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed & _MASK)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


class Element:
    """A path of open elements."""

    __slots__ = ("tag", "parent", "key", "start", "end", "other", "article", "holder", "depth", "children", "link")

    def __init__(self, tag: str, words: str, marks: frozenset[str], parent: Element | None) -> None:
        self.tag, self.parent = tag, parent
        self.key = _hash(f"{tag}.{words}", parent.key if parent else 0)
        self.start, self.end = _signed(_hash("start", self.key)), _signed(_hash("end", self.key))
        self.article = tag in ("article", "main") or bool(parent and parent.article)
        marks = marks - _OF_ARTICLE if parent and parent.article else marks
        self.other = bool(parent and parent.other) or bool(marks) and tag not in ("html", "body")
        self.link = tag == "a" or bool(parent and parent.link and tag not in _BLOCKS)
        self.depth = parent.depth + 1 if parent else 0
        # The innermost element around (or here) that can hold an article.
        self.holder = self if tag in _HOLDERS or parent is None else parent.holder
        self.children: dict[tuple[str, str], Element] = {}


class Block:
    """A text block and where it lies."""

    __slots__ = ("element", "text", "links", "token")

    def __init__(self, element: Element, text: str, links: int) -> None:
        self.element, self.text, self.links = element, text, links
        self.token = _signed(_hash(text, element.key + 1))


class Parser:
    """Pages to tokens: start and end tags as signed hashes, text blocks as ``Block``."""

    def __init__(self) -> None:
        self._made = 0
        self.root = Element("", "", frozenset(), None)

    def _child(self, parent: Element, tag: str, attributes: str) -> Element:
        found = parent.children.get((tag, attributes))
        if found is None:
            given = {}
            for name, *value in _ATTRIBUTE.findall(attributes):
                given.setdefault(name.lower(), html.unescape("".join(value)))
            classes = [w for w in given.get("class", "").split() if not any(c.isdigit() for c in w)]
            marks = {w.lower() for w in _WORD.findall(given.get("class", "") + " " + given.get("id", ""))} & _OTHER_WORDS
            marks |= {tag} & _OTHER_TAGS | {given.get("role", "").lower()} & _OTHER_ROLES
            if "hidden" in given or re.search(r"display\s*:\s*none", given.get("style", "")):
                marks.add("hidden")
            found = Element(tag, " ".join(sorted(classes)), frozenset(marks), parent)
            parent.children[tag, attributes] = found
            self._made += 1
        return found

    def parse(self, page: str) -> list[int | Block]:
        if self._made > _HELD:
            self.__init__()
        out: list[int | Block] = []
        now, at, length = self.root, 0, len(page)
        pieces: list[str] = []
        links = 0
        place = now

        def flush() -> None:
            nonlocal links
            if pieces:
                text = " ".join("".join(pieces).split())
                pieces.clear()
                if text:
                    out.append(Block(place, text, min(links, len(text))))
                links = 0

        def add(text: str) -> None:
            nonlocal links, place
            if not pieces:
                if not text.strip():
                    return
                place = now
                while place.tag not in _BLOCKS and place.parent is not None:
                    place = place.parent
            text = html.unescape(text)
            pieces.append(text)
            if now.link:
                links += len(text)

        while at < length:
            match = _SCAN.search(page, at)
            if match is None:
                add(page[at:])
                break
            if match.start() > at:
                add(page[at : match.start()])
            at = match.end()
            tag = match[2] or match[5]
            if not tag:
                continue
            closing, attributes, tag = match[1] or match[4], match[3] if match[2] else match[6], tag.lower()
            if page[at - 1] != ">":
                break  # cut off inside a tag
            block = tag in _BLOCKS
            if closing:
                if block:
                    flush()
                up = now
                while up.parent is not None and up.tag != tag and (block or up.tag not in _BLOCKS):
                    up = up.parent
                if up.tag == tag:
                    out.append(up.end)
                    now = up.parent
                continue
            if tag == "br":
                add(" ") if pieces else None
            if block:
                flush()
                now = self._close_before(now, tag)
            child = self._child(now, tag, attributes.rstrip("/").strip())
            out.append(child.start)
            if tag in _RAW:
                end = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(page, at)
                if end is None:
                    break
                at = page.find(">", end.end())
                out.append(child.end)
                if at < 0:
                    break
                at += 1
            elif tag not in _VOID:
                now = child
        flush()
        return out

    @staticmethod
    def _close_before(now: Element, tag: str) -> Element:
        """Elements that a block's start tag closes."""
        up = now
        while up.parent is not None and up.tag != "p" and up.tag not in _P_SCOPE:
            up = up.parent
        if up.tag == "p" and tag not in ("option", "optgroup"):
            now = up.parent
        if tag in _CLOSES:
            closed, scope = _CLOSES[tag]
            up = now
            while up.parent is not None and up.tag not in closed and up.tag not in scope:
                up = up.parent
            if up.tag in closed:
                now = up.parent
        return now


def _token(item: int | Block) -> int:
    return item.token if isinstance(item, Block) else item


# --- first scan: signatures of occurrence vectors ----------------------------------------------------------


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


_TOKENS = f"host string, {store.BLOCK} bigint, token bigint, pages bigint, total bigint, one bigint, two bigint"


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and token its share of the signature; rows without token count the pages of a host and block."""
    parser = Parser()
    sums: dict[tuple, list[int]] = {}

    def summed() -> pa.RecordBatch:
        keys, values = list(sums), list(sums.values())
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), pa.array([k[2] for k in keys], pa.int64())]
        columns += [pa.array([v[k] for v in values], pa.int64()) for k in range(4)]
        sums.clear()
        return pa.RecordBatch.from_arrays(columns, names=["host", store.BLOCK, "token", "pages", "total", "one", "two"])

    for block, batch in store.by_block(batches):
        ids, hosts, pages = (batch.column(k).to_pylist() for k in range(3))
        for page_id, host, page in zip(ids, hosts, pages, strict=True):
            page = page or ""
            key = _hash(page, hash(page_id) if page_id is not None else -1)
            counts: dict[int, int] = defaultdict(int)
            for item in parser.parse(page):
                counts[_token(item)] += 1
            for token, n in counts.items():
                mixed = (key * (2 * n + 1) + n) & _MASK
                mixed = (mixed ^ mixed >> 29) * 0xBF58476D1CE4E5B9 & _MASK
                entry = sums.setdefault((host, None, token), [0, 0, 0, 0])
                entry[0] += 1
                entry[1] += n
                # 31 bits each, so that sums over any number of pages fit.
                entry[2] += mixed >> 33
                entry[3] += mixed >> 2 & 0x7FFFFFFF
            sums.setdefault((host, block, None), [0, 0, 0, 0])[0] += 1
            if len(sums) > _HELD:
                yield summed()
    yield summed()


# --- second scan: order and nesting ------------------------------------------------------------------------


class Classes:
    """Classes of a host: token -> class, and which of them every page has once."""

    def __init__(self) -> None:
        self.of: dict[int, int] = {}
        self.size: dict[int, int] = {}
        self.once: set[int] = set()
        self.order: dict[int, tuple[int, ...]] = {}

    def add(self, number: int, members: list[int], once: bool) -> None:
        self.size[number] = len(members)
        self.order[number] = tuple(members)
        self.of.update(dict.fromkeys(members, number))
        if once:
            self.once.add(number)


def arrangement(items: list[int | Block], classes: Classes) -> dict[int, tuple[tuple[int, ...], int, int] | None]:
    """Per class of a page: its tokens' order, the class around it and the gap there; None when it has none.

    A class is in order when its tokens repeat one sequence; it nests when all its occurrences lie in one gap of one class and cross none.
    """
    seen: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for at, item in enumerate(items):
        token = _token(item)
        number = classes.of.get(token)
        if number is not None:
            seen[number].append((token, at))
    found: dict[int, tuple | None] = {}
    spans = []
    for number, places in seen.items():
        size = classes.size[number]
        order = tuple(t for t, _ in places[:size])
        if len(set(order)) < size or any(t != order[k % size] for k, (t, _) in enumerate(places)):
            found[number] = None
            continue
        found[number] = (order, 0, 0)
        spans += [(places[k][1], places[k + size - 1][1], number, [p for _, p in places[k : k + size]]) for k in range(0, len(places), size)]
    # Spans from the left, longer ones first: open ones are a stack.
    spans.sort(key=lambda s: (s[0], -s[1]))
    stack: list[tuple] = []
    around: dict[int, tuple[int, int]] = {}
    for span in spans:
        while stack and stack[-1][1] < span[0]:
            stack.pop()
        start, end, number, places = span
        parent = (0, 0)
        if stack:
            outer = stack[-1]
            gap = sum(p < start for p in outer[3])
            if gap < len(outer[3]) and end > outer[3][gap]:
                # It crosses the outer one; the smaller class gives way.
                found[min((number, outer[2]), key=lambda c: (classes.size[c], c))] = None
                continue
            parent = (outer[2], gap)
        if around.setdefault(number, parent) != parent:
            found[number] = None
        stack.append(span)
    return {n: f and (f[0], *around.get(n, (0, 0))) for n, f in found.items()}


def holders(items: list[int | Block], template: Classes) -> dict[int, list]:
    """Per element that can hold an article: [parent, depth, article or main, own headings, text that counts below it]."""
    out: dict[int, list] = {}
    elements: dict[int, Element] = {}

    def enter(holder: Element | None) -> None:
        while holder is not None and holder.key not in elements:
            elements[holder.key] = holder
            up = holder.parent.holder if holder.parent is not None else None
            out[holder.key] = [_signed(up.key) if up else 0, holder.depth, holder.tag in ("article", "main"), 0, 0]
            holder = up

    for item in items:
        if isinstance(item, Block) and not item.element.other and template.of.get(item.token) not in template.once:
            enter(item.element.holder)
            found = out[item.element.holder.key]
            found[3] += item.element.tag in _HEADINGS
            found[4] += max(0, len(item.text) - item.links)
    # From the innermost out, every holder's text counts for the one around it.
    for key in sorted(elements, key=lambda k: -elements[k].depth):
        parent = elements[key].parent
        if parent is not None:
            out[parent.holder.key][4] += out[key][4]
    return {_signed(k): v for k, v in out.items()}


def main_element(found: dict[int, list]) -> int | None:
    """The deepest holder with nearly all the text; an article or main element that has it is not divided, and headings beside it belong to it."""
    if not found:
        return None
    whole = max(v[4] for v in found.values())
    enough = {k: v for k, v in found.items() if v[4] >= SHARE * whole}
    named = [k for k, v in enough.items() if v[2]]
    if named:
        return min(named, key=lambda k: (enough[k][1], k))
    best = min(enough, key=lambda k: (-enough[k][1], k))
    up, inner = enough[best][0], best
    while up in enough and enough[up][1] < enough[inner][1]:
        if enough[up][3]:
            best = up
        inner, up = up, enough[up][0]
    return best


_SEEN = "host string, class bigint, order array<bigint>, outer bigint, gap int, parent bigint, depth int, named boolean, headings bigint, chars bigint, pages bigint"


def _class_tables(side: str, order: bool):
    def load(block: int) -> dict[str, Classes]:
        out: dict[str, Classes] = defaultdict(Classes)
        table = store.read_packed(side, block, ["host", "class", "members", "once"])
        for row in table.to_pylist() if table is not None else []:
            if row["members"] is not None:
                out[row["host"]].add(row["class"], row["members"], row["once"])
        return out

    return load


def _order(side: str):
    load = _class_tables(side, False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, tables = Parser(), store.SideCache(load)
        sums: dict[tuple, list[int]] = {}

        def summed() -> pa.RecordBatch:
            keys, values = list(sums), list(sums.values())
            columns = [[k[i] for k in keys] for i in range(8)] + [[v[i] for v in values] for i in range(3)]
            types = (pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())
            sums.clear()
            names = ["host", "class", "order", "outer", "gap", "parent", "depth", "named", "headings", "chars", "pages"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for block, batch in store.by_block(batches):
            table = tables.get(block)
            for host, page in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                classes = table.get(host)
                if classes is None:
                    continue
                items = parser.parse(page or "")
                for number, found in arrangement(items, classes).items():
                    order, outer, gap = found or (None, None, None)
                    sums.setdefault((host, number, order, outer, gap, None, None, None), [0, 0, 0])[2] += 1
                for key, (parent, depth, named, headings, chars) in holders(items, classes).items():
                    entry = sums.setdefault((host, None, None, key, None, parent, depth, bool(named)), [0, 0, 0])
                    entry[0] += headings
                    entry[1] += chars
                    entry[2] += 1
                if len(sums) > _HELD:
                    yield summed()
        yield summed()

    return run


# --- third scan: extraction --------------------------------------------------------------------------------


def slots(items: list[int | Block], template: Classes) -> list[tuple[Block, tuple[int, int]]]:
    """The page's text blocks that are no template tokens, with their slot (class, gap), and those that are, with slot (class, -1)."""
    out, stack = [], []
    for item in items:
        token = _token(item)
        number = template.of.get(token)
        if number is not None:
            order = template.order[number]
            at = order.index(token)
            if at == 0:
                stack.append([number, 0])
            else:
                # Classes that did not end here give way to the one around them.
                k = len(stack) - 1
                while k >= 0 and stack[k] != [number, at - 1]:
                    k -= 1
                if k >= 0:
                    del stack[k + 1 :]
                    stack[k][1] = at
            if stack and stack[-1] == [number, len(order) - 1]:
                stack.pop()
            if isinstance(item, Block):
                out.append((item, (number, -1)))
        elif isinstance(item, Block):
            out.append((item, (stack[-1][0], stack[-1][1]) if stack else (0, 0)))
    return out


def _inside(element: Element, key: int) -> bool:
    up: Element | None = element
    while up is not None:
        if _signed(up.key) == key:
            return True
        up = up.parent
    return False


def main_text(items: list[int | Block], template: Classes, main: int | None) -> str:
    found = [(b, s) for b, s in slots(items, template) if not b.element.other]
    mine = [(b, s) for b, s in found if main is not None and _inside(b.element, main)]
    if not mine:
        # The page has no such element, or nothing in it.
        own = main_element(holders(items, Classes()))
        mine = [(b, s) for b, s in found if own is not None and _inside(b.element, own)]
    text, links = defaultdict(int), defaultdict(int)
    for block, slot in mine:
        text[slot, block.element.key] += len(block.text)
        links[slot, block.element.key] += block.links
    menus = {k for k in text if links[k] >= LINKS * text[k]}
    mine = [(b, s) for b, s in mine if b.element.tag not in _LISTED or (s, b.element.key) not in menus]

    def constant(block: Block, slot: tuple[int, int]) -> bool:
        return slot[1] < 0 and slot[0] in template.once and block.element.tag not in _HEADINGS and template.of.get(block.element.start) in template.once

    data = [b for b, s in mine if not constant(b, s)]
    if all(b.element.tag in _HEADINGS for b in data):
        # All pages of the host are alike: their text is not the template's.
        data = [b for b, _ in mine]
    return "\n".join(b.text for b in data)


_TEXT = "page_id bigint, url string, text string, n_chars bigint"


def _extract(side: str):
    def load(block: int) -> dict[str, tuple[Classes, int | None]]:
        classes = _class_tables(side, True)(block)
        table = store.read_packed(side, block, ["host", "holders"])
        out = {host: (c, None) for host, c in classes.items()}
        for row in table.to_pylist() if table is not None else []:
            if row["holders"] is not None:
                found = {h["key"]: [h["parent"], h["depth"], h["named"], h["headings"], h["chars"]] for h in row["holders"]}
                out[row["host"]] = (classes.get(row["host"], Classes()), main_element(found))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, tables = Parser(), store.SideCache(load)
        for block, batch in store.by_block(batches):
            table = tables.get(block)
            ids, hosts, pages, urls = (batch.column(k).to_pylist() for k in range(4))
            texts = []
            for host, page in zip(hosts, pages, strict=True):
                template, main = table.get(host) or (Classes(), None)
                texts.append(main_text(parser.parse(page or ""), template, main))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return run


def _rows(pages: DataFrame) -> DataFrame:
    rows = store.with_blocks(pages, "page_id", "url", "html")
    return rows.select(
        F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"),
        F.col("url").cast("string").alias("url"), store.BLOCK,
    )


def templates(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Valid classes (host, class, members in order, once), holders of text by host, and the blocks of each host."""
    scanned = materialise(rows.mapInArrow(_signatures, _TOKENS), "token-sums")
    blocks = materialise(scanned.filter("token IS NULL").groupBy("host", store.BLOCK).agg(F.sum("pages").alias("pages")), "host-blocks")
    hosts = blocks.groupBy("host").agg(F.sum("pages").alias("all"))
    names = ("pages", "total", "one", "two")
    tokens = scanned.filter("token IS NOT NULL").groupBy("host", "token").agg(*[F.sum(c).alias(c) for c in names]).filter(F.col("pages") >= SUPPORT)
    # All tokens of a class are on one page, so a class is no longer than a page.
    classes = tokens.groupBy("host", *names).agg(F.array_sort(F.collect_list("token")).alias("members")).filter(F.size("members") > 1)
    once = (F.col("pages") == F.col("all")) & (F.col("total") == F.col("all"))
    classes = classes.join(hosts, "host").select("host", F.xxhash64("host", *names).alias("class"), "members", once.alias("once"))
    classes = materialise(classes, "classes")
    side = store.write_packed(classes.join(blocks.select("host", store.BLOCK), "host"), "classes-by-block")
    seen = materialise(rows.mapInArrow(_order(side), _SEEN), "orders")
    ways = seen.filter("class IS NOT NULL").select("host", "class", "order", "outer", "gap").distinct()
    valid = ways.groupBy("host", "class").agg(F.count("*").alias("ways"), F.first("order").alias("order")).filter("ways = 1 AND order IS NOT NULL")
    valid = valid.select("host", "class", F.col("order").alias("members")).join(classes.select("host", "class", "once"), ["host", "class"])
    held = seen.filter("class IS NULL").groupBy("host", F.col("outer").alias("key"), "parent", "depth", "named").agg(
        F.sum("headings").alias("headings"), F.sum("chars").alias("chars"), F.sum("pages").alias("pages")
    )
    return valid, held.filter(F.col("pages") >= SUPPORT), blocks


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = _rows(pages)
    valid, held, blocks = templates(rows)
    per_host = held.groupBy("host").agg(F.collect_list(F.struct("key", "parent", "depth", "named", "headings", "chars")).alias("holders"))
    side = valid.select("host", "class", "members", "once", F.lit(None).cast(per_host.schema["holders"].dataType).alias("holders"))
    side = side.unionByName(per_host, allowMissingColumns=True)
    path = store.write_packed(side.join(blocks.select("host", store.BLOCK), "host"), "templates")
    return rows.mapInArrow(_extract(path), _TEXT)


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))
