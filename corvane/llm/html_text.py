"""Main text of web pages, by site template removal.

A page is read into elements; each element subtree gets a hash of its tag, its class and id, its text and its children's hashes.
Spark counts on how many different pages of a host each subtree occurs; those on many are the site's template
(menus, notices, share bars) and are deleted, whatever their tags and names. Copies of one page count once. A recurring
paragraph or heading of an article is content, so inside an article only containers are deleted for recurring.

HTML itself says of some elements that they are no part of an article: by tag or role (navigation, footers, forms,
scripts), or by a class or id that means nothing else (``ad``, ``share-bar``, ``comment-list``). These go on any page,
as most of them vary from page to page. A name decides on containers only, never on a text block, an article or a main
part, and only as a whole: ``social-studies`` and ``related-work`` are no such names.

What is left of the articles and main parts, the outermost ones, all of them, is cut into blocks; of the body if there are none.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.DOTALL)
#: An attribute and its value; read one after the other, so that nothing inside a value is taken for a name.
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")

# Elements of HTML by their part in layout.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
TEXT_BLOCKS = set("p h1 h2 h3 h4 h5 h6 pre blockquote".split())
CONTAINERS = set("address article aside body center dd details dialog dir div dl dt fieldset figcaption figure footer form header hgroup hr html li main menu nav ol section summary table tbody tfoot thead tr caption ul".split())
BLOCKS = TEXT_BLOCKS | CONTAINERS
CELLS = {"td", "th"}
CLOSES_P = BLOCKS - {"html", "body", "tbody", "tfoot", "thead", "tr", "caption"}
#: A start tag that ends an open element of the same family, and where the search for it stops.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Never part of an article.
DROP_TAGS = set("head script style noscript template iframe object embed svg canvas math audio video map nav footer aside form select option input textarea dialog menu title link meta".split())
#: Parts of a form, unless they stand in a sentence.
FORM_TAGS = {"button", "label"}
DROP_ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words for what is no part of an article, and words that may stand beside them in a name.
DROP_WORDS = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs "
    "footer masthead comment comments disqus reply replies cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login "
    "social share sharing sharebar related recommended recommendations pagination pager toolbar copyright widget widgets".split()
)
SIDE_WORDS = set("area bar block box button buttons container content form group header inner item items left link links list main message panel post posts right section site top bottom wrap wrapper us on follow the my page".split())
#: Only outside an article: an article's own header holds its heading.
OUTER_WORDS = {"header", "topbar", "hero"}
MAIN_TAGS = ("article", "main")


def says(names: str, words: set[str]) -> bool:
    """Whether one of the names (a class or id) means one of the words and nothing else."""
    for name in names.split():
        parts = {w.lower() for w in _WORDS.findall(name) if not w.isdigit()}
        if not parts.isdisjoint(words) and parts <= words | SIDE_WORDS:
            return True
    return False


class Page:
    """A page as a flat list of events: text, i for the start of element i, ~i for its end."""

    def __init__(self, source: str):
        self.events: list[str | int] = []
        self.tags: list[str] = []
        self.names: list[str] = []  # class and id
        self.drop: list[bool] = []
        self.hashes: list[int] = []
        self.parents: list[int] = []
        self._stack: list[int] = []
        self._parts: list[list[str]] = [[]]
        self._read(source)

    def _text(self, text: str) -> None:
        if text:
            text = html.unescape(text) if "&" in text else text
            self.events.append(text)
            self._parts[-1].append(" ".join(text.split()))

    def _in_sentence(self) -> bool:
        for i in reversed(self._stack):
            if self.tags[i] in BLOCKS or self.tags[i] in CELLS:
                return self.tags[i] in TEXT_BLOCKS
        return False

    def _open(self, tag: str, attributes: str) -> int:
        i = len(self.tags)
        names, drop = "", tag in DROP_TAGS or tag in FORM_TAGS and not self._in_sentence()
        if attributes and not attributes.isspace():
            found: dict[str, str] = {}
            for m in _ATTRIBUTE.finditer(attributes):
                found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")  # the first of a name counts
            names, role = f"{found.get('class', '')} {found.get('id', '')}", found.get("role", "").lower()
            if tag not in ("html", "body", *MAIN_TAGS):
                drop = drop or "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower() or role in DROP_ROLES
                if role in MAIN_TAGS:
                    tag = role
                elif tag in CONTAINERS or tag == "span":
                    drop = drop or says(names, DROP_WORDS)
        self.tags.append(tag)
        self.names.append(names)
        self.drop.append(drop)
        self.hashes.append(0)
        self.parents.append(self._stack[-1] if self._stack else -1)
        self.events.append(i)
        self._stack.append(i)
        self._parts.append([])
        return i

    def _close(self) -> None:
        i, parts = self._stack.pop(), self._parts.pop()
        self.hashes[i] = h = xxhash.xxh3_64_intdigest("\x00".join([self.tags[i], self.names[i], *parts]))
        self.events.append(~i)
        self._parts[-1].append(f"\x01{h:x}" if any(parts) else "")

    def _close_to(self, tags: set[str], stops: set[str]) -> None:
        for depth in range(len(self._stack) - 1, -1, -1):
            tag = self.tags[self._stack[depth]]
            if tag in tags:
                while len(self._stack) > depth:
                    self._close()
                return
            if tag in stops:
                return

    def _read(self, source: str) -> None:
        at = 0
        while m := _TAG.search(source, at):
            self._text(source[at : m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                stops = set() if tag in BLOCKS or tag in CELLS else BLOCKS
                self._close_to({tag}, stops)
                continue
            if tag in CLOSES_P:
                self._close_to({"p"}, CONTAINERS | CELLS | {"button"})
            if tag in SIBLINGS:
                self._close_to(*SIBLINGS[tag])
            self._open(tag, m[3] or m[6] or "")
            if tag in VOID:
                self._close()
            elif tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
                self._text(source[at : end.start() if end else len(source)])
                self._close()
                at = end.end() if end else len(source)
        self._text(source[at:])
        while self._stack:
            self._close()

    def subtrees(self) -> set[int]:
        """Hashes of block subtrees that the page's own tags don't drop anyway, signed 64 bits."""
        return {h - (1 << 64) if h >> 63 else h for i, h in enumerate(self.hashes) if self.tags[i] in BLOCKS and self.tags[i] not in ("html", "body") and not self.drop[i]}

    def text(self, template: set[int] = frozenset()) -> str:
        """Blocks of the main part, joined by an empty line."""
        n = len(self.tags)
        inside, gone, full = [False] * n, [False] * n, [False] * n  # in an article or main; dropped with all below; with text
        for i in range(n):
            up, tag = self.parents[i], self.tags[i]
            inside[i] = tag in MAIN_TAGS or up >= 0 and inside[up]
            drop = self.drop[i] or not inside[i] and (tag == "header" or tag in CONTAINERS and says(self.names[i], OUTER_WORDS))
            h = self.hashes[i]
            if not drop and template and (h - (1 << 64) if h >> 63 else h) in template:
                drop = tag not in ("html", "body", *MAIN_TAGS) and not (inside[i] and (tag in TEXT_BLOCKS or tag not in BLOCKS))
            gone[i] = drop or up >= 0 and gone[up]
        stack = []
        for e in self.events:
            if isinstance(e, str):
                if stack and not gone[stack[-1]] and not e.isspace():
                    full[stack[-1]] = True
            elif e >= 0:
                stack.append(e)
            else:
                stack.pop()
        for i in range(n - 1, -1, -1):
            if self.parents[i] >= 0 and full[i]:
                full[self.parents[i]] = True
        main = [self.tags[i] in MAIN_TAGS and not gone[i] and full[i] for i in range(n)]
        whole = not any(main)
        blocks, now = [], []

        def end_block() -> None:
            block = " ".join("".join(now).split())
            if block:
                blocks.append(block)
            now.clear()

        stack, within = [], int(whole)  # how many of the open elements are main ones
        for e in self.events:
            if isinstance(e, str):
                if within and not (stack and gone[stack[-1]]):
                    now.append(e)
                continue
            i = e if e >= 0 else ~e
            if e >= 0:
                stack.append(i)
                within += main[i]
            if within and not gone[i]:
                if self.tags[i] in BLOCKS:
                    end_block()
                elif self.tags[i] == "br" or self.tags[i] in CELLS:
                    now.append(" ")
            if e < 0:
                stack.pop()
                within -= main[i]
        end_block()
        return "\n\n".join(blocks)


def _subtree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [list(Page(t).subtrees()) for t in common.texts_of(batch.column(2))]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], ["host_key", "page", "subtrees"])


def _text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [Page(t).text(set(own or ())) if t else "" for t, own in zip(common.texts_of(batch.column(2)), batch.column(3).to_pylist(), strict=True)]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])


def templates(spark: SparkSession, pages: DataFrame, *, min_pages: int = 5) -> DataFrame:
    """host_key, page and the page's template: those of its subtrees that are on at least ``min_pages`` different pages of the host.

    The count is the same for a host of any size. A list holds a page's own subtrees only, so it is bounded by the page.
    """
    rows = common.arrow_map(pages.filter("host_key is not null and html is not null").select("host_key", "page", "html"), _subtree_rows, "host_key long, page long, subtrees array<long>")
    each, each_path = common.stored(spark, rows.select("host_key", "page", F.explode("subtrees").alias("subtree")).distinct(), "subtrees")
    recurring, recurring_path = common.stored(spark, each.groupBy("host_key", "subtree").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages).select("host_key", "subtree"), "recurring")
    own = each.join(recurring, ["host_key", "subtree"]).groupBy("host_key", "page").agg(F.collect_list("subtree").alias("template"))
    out, _ = common.stored(spark, own, "templates")
    common.remove(spark, each_path, recurring_path)
    common.release(spark)
    return out


def extract(spark: SparkSession, pages: DataFrame, **options) -> DataFrame:
    """A row per page: page_id, url, text, n_chars.

    Null or empty html: the empty text. Null url or one without a host: no template, the page's own marks only. Null page_id
    and repeated rows: a row each, with the same text; copies of a page count once. Very long pages: read whole, in one worker.
    A subtree on exactly ``min_pages`` pages is template. Empty table: no rows. Other columns are ignored, whatever their names.
    """
    host = F.lower(F.regexp_extract(F.col("url").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1))
    rows = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), F.when(host != "", F.xxhash64(host)).alias("host_key"))
    rows = rows.withColumn("page", F.xxhash64("html"))  # copies of a page have one template
    known = templates(spark, rows, **options)
    joined = rows.join(known.hint("shuffle_hash"), ["host_key", "page"], "left").select("page_id", "url", "html", "template")
    out = common.arrow_map(joined, _text_rows, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
