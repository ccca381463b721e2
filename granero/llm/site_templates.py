"""Main text of web pages by removal of site templates.

Pages are parsed into elements. The subtree of every element is hashed, the hashes
are counted per host, and subtrees that recur on many pages of their host are
deleted with all that is in them. Pages are told apart by their own content, the
largest part of their text that equally many pages of the host have and not most of
them, so copies of one article do not count as many pages. Paragraphs and the like
may be quoted or copied; they need more pages.

What markup declares to be no article (menus, scripts, forms, adverts and so on)
goes by its tag or class, so that hosts of a single page are cleaned too. Forms and
class names only hint: what holds the article or much of the page's text stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.llm.tables import sifted
from granero.sources.staging import stage

# Fixed values of HTML: elements without content, blocks, and what closes an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
# An element of the key ends an open element of its values when it begins.
ENDS = {
    "li": {"li", "p"},
    "dt": {"dt", "dd", "p"},
    "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"},
    "th": {"td", "th", "p"},
    "option": {"option"},
}
KEEPS = frozenset("article aside blockquote body div dl fieldset figure footer form header html main nav ol section table td th ul".split())
# What an open element of the key may not be closed across.
WITHIN = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}

NOT_TEXT = frozenset(
    "head title script style noscript template iframe object svg canvas audio video select button textarea "
    "nav aside footer menu dialog".split()
)
# Copies of these are more often quotes than templates.
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table tbody thead tr td th figure figcaption a b i em strong span code".split())
# Of these, what a section of a host can have as its template.
SECTION = frozenset("p ul ol dl table".split())
# What holds sentences; a class name inside says nothing about a whole part of the page.
LINES = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dt dd td th figcaption".split())
MAIN = frozenset(["article", "main"])
WHOLE = MAIN | {"body", "html"}
# Marked articles are not the page's text if the rest is over so many times longer.
TEASERS = 2

_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|adslot|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|"
    r"sidebar|side|menu|nav|navbar|navigation|breadcrumbs?|comments?|commentlist|disqus|respond|replies|share|sharing|"
    r"social|related|recommended|newsletter|subscribe|signup|popup|modal|overlay|footer|masthead|toolbar|"
    r"pagination|pager|widget|login|skip-link)(?:$|[\s_-]|\d)",
    re.IGNORECASE,
)
# Names that say how a page is laid out, not what the element is.
_LAYOUT = re.compile(
    r"(?:^|(?<=\s))(?:(?:has|no|not|with|without|is|hide|show|open)[_-]\S*|"
    r"\S*[_-](?:open|opened|close|closed|enabled|disabled|on|off|layout|wrap|wrapper))(?=\s|$)",
    re.IGNORECASE,
)
_COMMENTS = re.compile(r"comment|respond|repl", re.IGNORECASE)
_HEADERS = re.compile(r"(?:^|[\s_-])(?:header|site-title|topbar)(?:$|[\s_-]|\d)", re.IGNORECASE)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu".split())


@dataclass
class Element:
    tag: str
    parent: int
    out: bool
    main: bool
    # Perhaps no article, by its class or as a form; a whole name says so; readers' comments by class.
    hinted: bool = False
    named: bool = False
    comments: bool = False
    # In a paragraph or another element that holds sentences.
    line: bool = False
    digest: xxhash.xxh3_64 = field(default_factory=xxhash.xxh3_64)
    hash: int = 0


class PageParser(HTMLParser):
    """Elements with subtree hashes, and the text blocks that are not out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.elements = [Element("", -1, False, False)]
        self.open = [0]
        self.blocks: list[tuple[str, int, bool]] = []
        self.text: list[str] = []
        self.owner = 0

    def flush(self) -> None:
        block = " ".join("".join(self.text).split())
        if block:
            self.blocks.append((block, self.owner, self.elements[self.owner].main))
        self.text = []
        self.owner = self.open[-1]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.close_before(tag)
            self.flush()
        elif tag in ("br", "img"):
            self.text.append(" ")
        above = self.elements[self.open[-1]]
        above.digest.update(f"<{tag}>".encode())
        if tag in VOID:
            return
        named = dict(attrs)
        words = f"{named.get('class') or ''} {named.get('id') or ''}"
        own = _LAYOUT.sub(" ", words)
        role = (named.get("role") or "").lower()
        main = above.main or tag in MAIN or role == "main"
        comments = tag not in ("body", "html") and bool(_NAMES.search(own)) and bool(_COMMENTS.search(own))
        hinted = (
            tag == "form"
            or role == "form"
            or (tag not in WHOLE and bool(_NAMES.search(own)))
            or (not above.main and tag not in WHOLE and bool(_HEADERS.search(own)))
        )
        whole = any((found := _NAMES.search(name)) and found[0] == name for name in own.split())
        out = (
            above.out
            or tag in NOT_TEXT
            or "hidden" in named
            or role in _ROLES
            or (not above.main and tag == "header")
            # Parts of a line go at once, lest lines be torn, but no words of a sentence do.
            or (hinted and tag not in BLOCKS and not above.line)
            # Readers' comments are often articles of their own inside or below the article.
            or (tag in MAIN and comments)
        )
        line = above.line or tag in LINES
        self.elements.append(Element(tag, self.open[-1], out, main and not out, hinted, whole, comments, line))
        self.elements[-1].digest.update(f"{tag} {words}".encode())
        self.open.append(len(self.elements) - 1)
        if tag in BLOCKS:
            self.owner = self.open[-1]

    def close_before(self, tag: str) -> None:
        ends, stops = ENDS.get(tag, {"p"}), WITHIN.get(tag, KEEPS)
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.elements[self.open[depth]].tag
            if name in ends:
                self.close_to(depth)
            elif name in stops:
                return

    def close_to(self, depth: int) -> None:
        self.flush()
        while len(self.open) > depth:
            done = self.elements[self.open.pop()]
            done.hash = done.digest.intdigest()
            if self.open:
                self.elements[self.open[-1]].digest.update(done.hash.to_bytes(8, "little"))
        self.owner = self.open[-1] if self.open else 0

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.elements[self.open[depth]].tag
            if name == tag:
                if tag in BLOCKS:
                    self.close_to(depth)
                else:
                    self.close_inline(depth)
                return
            if tag not in BLOCKS and name in BLOCKS:
                return  # an inline end tag does not reach out of its block

    def close_inline(self, depth: int) -> None:
        text, owner = self.text, self.owner
        self.text = []
        self.close_to(depth)
        self.text, self.owner = text, owner

    def handle_data(self, data: str) -> None:
        own = self.elements[self.open[-1]]
        own.digest.update(data.strip().encode())
        if not own.out:
            if not self.text:
                self.owner = self.open[-1]
            self.text.append(data)

    def finish(self) -> None:
        self.close()
        self.close_to(0)

    def article(self) -> list[tuple[str, int, bool]]:
        """The blocks that are the page's text.

        Hinted elements go, unless they hold most of the marked articles or, if none is
        marked or those are far shorter, most of the text. Beside marked articles those go
        that have a whole name, such as "ad". Of what stays, marked articles are
        all that counts unless the rest is far longer: then they are teasers.
        """
        chars, marked = [0] * len(self.elements), [0] * len(self.elements)
        for text, at, main in self.blocks:
            chars[at] += len(text)
            marked[at] += len(text) if main else 0
        for at in range(len(self.elements) - 1, 0, -1):  # parents come before what they hold
            above = self.elements[at].parent
            chars[above] += chars[at]
            marked[above] += marked[at]
        total, articles = chars[0], marked[0]
        gone = [False] * len(self.elements)
        for at, element in enumerate(self.elements[1:], 1):
            gone[at] = gone[element.parent]
            if element.hinted and not gone[at]:
                if articles and element.comments:
                    gone[at] = marked[at] < articles
                elif articles and element.named:
                    gone[at] = 2 * marked[at] <= articles
                elif 2 * marked[at] <= articles:
                    gone[at] = 2 * chars[at] <= total or chars[at] <= TEASERS * articles
        left = [block for block in self.blocks if not gone[block[1]]]
        inside = [block for block in left if block[2]]
        within = sum(len(text) for text, _, _ in inside)
        return inside if inside and sum(len(text) for text, _, _ in left) <= (1 + TEASERS) * within else left


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


# Kinds of elements, by how many pages make them a template.
PLAIN, IN_SECTIONS, IN_MOST = range(3)


def _kind(tag: str) -> int:
    return IN_SECTIONS if tag in SECTION else IN_MOST if tag in FLOW else PLAIN


Parts = list[tuple[int, int]]


def parse(html: str) -> tuple[int, list[tuple[int, int, int]], list[tuple[str, int]], Parts]:
    """Content hash, elements that hold text (hash, parent, kind), blocks (text, element) and
    the different block texts (hash, characters).

    If the page marks an article, only its blocks count; see :meth:`PageParser.article`.
    """
    parser = PageParser()
    parser.feed(html)
    parser.finish()
    blocks = parser.article()
    new: dict[int, int] = {0: -1}
    elements: list[tuple[int, int, int]] = []

    def keep(at: int) -> int:
        path = []
        while at not in new:
            path.append(at)
            at = parser.elements[at].parent
        for own in reversed(path):
            element = parser.elements[own]
            new[own] = len(elements)
            elements.append((_signed(element.hash), new[element.parent], _kind(element.tag)))
        return new[path[0]] if path else new[at]

    placed = [(text, keep(at)) for text, at, _ in blocks]
    parts = {_signed(xxhash.xxh3_64_intdigest(text.encode())): len(text) for text, _ in placed}
    content = _signed(xxhash.xxh3_64_intdigest("\n".join(text for text, _ in placed).encode()))
    return content, elements, placed, list(parts.items())


PARSED = (
    "page_id bigint, url string, host string, content bigint, "
    "elements array<struct<hash:bigint,parent:int,kind:int>>, owners array<int>, packed binary, "
    "parts array<struct<hash:bigint,chars:bigint>>"
)


@dataclass(frozen=True)
class TemplatePolicy:
    """A subtree goes if at least ``least_pages`` pages of its host have it; paragraphs and
    other flow elements also need ``flow_share`` of the host's pages. Whole paragraphs, lists
    and tables can be templates of a section: ``section_pages`` are enough for them."""

    least_pages: int = 5
    flow_share: float = 0.5
    section_pages: int = 50


def parsed_pages(pages: DataFrame) -> DataFrame:
    """Elements and blocks of every page; see :func:`parse`.

    ``packed`` are the blocks' texts, joined by newlines and compressed; ``owners`` are
    their elements. Texts are stored once and travel only if a template is in them.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [
            pa.list_(pa.struct([("hash", pa.int64()), ("parent", pa.int32()), ("kind", pa.int32())])),
            pa.list_(pa.struct([("hash", pa.int64()), ("chars", pa.int64())])),
        ]
        compress = zstandard.ZstdCompressor().compress
        for batch in batches:
            found = [parse(html.as_py() or "") for html in batch.column(3)]
            elements = [[{"hash": h, "parent": p, "kind": k} for h, p, k in page[1]] for page in found]
            owners = [[at for _, at in page[2]] for page in found]
            packed = [compress("\n".join(text for text, _ in page[2]).encode()) for page in found]
            parts = [[{"hash": h, "chars": n} for h, n in page[3]] for page in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(3)),
                    pa.array([page[0] for page in found], pa.int64()),
                    pa.array(elements, kinds[0]),
                    pa.array(owners, pa.list_(pa.int32())),
                    pa.array(packed, pa.binary()),
                    pa.array(parts, kinds[1]),
                ],
                ["page_id", "url", "host", "content", "elements", "owners", "packed", "parts"],
            )

    host = F.lower(F.regexp_extract(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    own = pages.select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"), host.alias("host"), F.col("html").cast("string")
    )
    return own.mapInArrow(read, PARSED)


def own_contents(pages: DataFrame, policy: TemplatePolicy = TemplatePolicy()) -> DataFrame:
    """What tells a page from others of its host: host, content, own.

    Pages of the same text are one. A page's blocks are put together by how many of the
    host's pages have them, without what most have; those of the most characters are its
    own. So copies of an article in different surroundings are one, too.
    """
    texts = pages.select("host", "content", "parts").dropDuplicates(["host", "content"])
    sizes = texts.groupBy(F.col("host").alias("_h")).agg(F.count(F.lit(1)).alias("_pages"))
    parts = texts.select("host", "content", F.explode("parts").alias("p")).select("host", "content", "p.*")
    counted = parts.groupBy(F.col("host").alias("_host"), F.col("hash").alias("_hash")).agg(F.count(F.lit(1)).alias("n"))
    # What only one page has needs no row.
    often = counted.where(F.col("n") > 1).join(sizes, F.col("_host") == F.col("_h")).drop("_h")
    n = F.coalesce("n", F.lit(1))
    most = F.coalesce((n >= policy.least_pages) & (n >= policy.flow_share * F.col("_pages")), F.lit(False))
    alike = (
        parts.join(often, (F.col("host") == F.col("_host")) & (F.col("hash") == F.col("_hash")), "left")
        .where(~most)
        .groupBy("host", "content", n.alias("n"))
        .agg(F.sum("chars").alias("chars"), F.bit_xor("hash").alias("own"))
    )
    own = alike.groupBy("host", "content").agg(F.max(F.struct("chars", "n", "own")).alias("best"))
    return own.select("host", "content", F.col("best.own").alias("own"))


def templates(pages: DataFrame, policy: TemplatePolicy = TemplatePolicy()) -> DataFrame:
    """Subtrees (host, hash) that recur on many pages of their host.

    ``pages`` are parsed pages. A page without a host has no site and counts for none.
    """
    sited = pages.where(F.col("host") != "")
    own = stage(own_contents(sited, policy))
    named = own.select(F.col("host").alias("_h"), F.col("content").alias("_c"), "own")
    # Pages of nothing but what most pages have are one page.
    uses = (
        sited.select("host", "content", "elements")
        .join(named, (F.col("host") == F.col("_h")) & (F.col("content") == F.col("_c")), "left")
        .select(
            "host",
            F.coalesce("own", F.lit(0)).alias("own"),
            F.explode(F.transform("elements", lambda e: F.struct(e["hash"].alias("hash"), e["kind"].alias("kind")))).alias("e"),
        )
        .select("host", "own", F.col("e.hash").alias("hash"), F.col("e.kind").alias("kind"))
    )
    counted = uses.groupBy("host", "hash").agg(F.count_distinct("own").alias("n"), F.min("kind").alias("kind"))
    hosts = own.groupBy(F.col("host").alias("_host")).agg(F.count_distinct("own").alias("_pages"))
    often = (
        (F.col("kind") == PLAIN)
        | (F.col("n") >= policy.flow_share * F.col("_pages"))
        | ((F.col("kind") == IN_SECTIONS) & (F.col("n") >= policy.section_pages))
    )
    # Only what recurs at all meets the hosts' sizes.
    return (
        counted.where(F.col("n") >= policy.least_pages)
        .join(hosts, F.col("host") == F.col("_host"))
        .where(often)
        .select("host", "hash")
    )


TEXTS = "page_id bigint, url string, text string"


def _subtree(host: str, digest: str) -> Column:
    """One number for a subtree of a host."""
    return F.xxhash64(host, digest)


def _unpack(column: pa.Array) -> list[str]:
    expand = zstandard.ZstdDecompressor().decompress
    return [expand(packed.as_py()).decode() for packed in column]


def _made(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
    columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text"])


def _whole_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _made(batch, _unpack(batch.column(2)))


def _texts_without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the blocks below elements that are ``gone``."""
    for batch in batches:
        texts = []
        for text, owners, elements, gone in zip(_unpack(batch.column(2)), *(batch.column(i).to_pylist() for i in (3, 4, 5))):
            out, deleted = set(gone or ()), []
            for element in elements:
                parent = element["parent"]
                deleted.append(element["hash"] in out or (parent >= 0 and deleted[parent]))
            blocks = text.split("\n") if owners else []
            texts.append("\n".join(block for block, at in zip(blocks, owners) if at < 0 or not deleted[at]))
        yield _made(batch, texts)


def extract(pages: DataFrame, policy: TemplatePolicy = TemplatePolicy()) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars.

    ``pages`` has page_id, url and html; other columns are not read. Blocks are
    joined by newlines in page order, with single spaces inside. Null, empty and
    broken html give what text there is, at least the empty one. Repeated rows all
    come back and count as one page.
    """
    parsed = stage(parsed_pages(pages)).withColumn("_page", F.monotonically_increasing_id())
    recurring = stage(templates(parsed, policy).select(_subtree("host", "hash").alias("subtree")))
    # Only what may be a template is shuffled, and only pages that hold one meet their list.
    uses = parsed.select("_page", F.explode(F.transform("elements", lambda e: e["hash"])).alias("hash"), "host")
    may = sifted(uses.withColumn("_s", _subtree("host", "hash")), F.col("_s"), recurring)
    gone = stage(
        may.join(recurring, F.col("_s") == F.col("subtree"), "left_semi")
        .groupBy(F.col("_page").alias("_p"))
        .agg(F.collect_set("hash").alias("gone"))
    )
    marks = gone.select(F.xxhash64("_p").alias("page"))
    held = sifted(parsed, F.xxhash64("_page"), marks).join(gone, F.col("_page") == F.col("_p"), "left")
    free = sifted(parsed, F.xxhash64("_page"), marks, apart=True)
    columns = ["page_id", "url", "packed"]
    made = free.select(*columns).mapInArrow(_whole_texts, TEXTS).unionByName(
        held.select(*columns, "owners", "elements", "gone").mapInArrow(_texts_without, TEXTS)
    )
    return made.withColumn("n_chars", F.length("text").cast("bigint"))
