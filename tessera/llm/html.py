"""Operator 3: main text of web pages by equivalence-class template deduction.

1. Every page is read as a sequence of *tokens*: each block element with its
   path, and each text block with its path. Per host, a token's occurrence
   vector says how often it stands in each of the host's distinct pages
   (pages with the same html count once). Vectors are compared by their
   fingerprint (an order-free hash over pages), so that a host of any size
   needs one row per token and no task holds its pages.
2. Tokens of one host with the same vector form an equivalence class. The
   class of the document element (one occurrence per page) is the template's
   root. A class is valid with two members or more that stand in
   ``LEAST_PAGES`` distinct pages at least; it nests into the template when
   it stands in ``LEAST_SHARE`` of the host's pages, under an element that
   does so too.
3. Text tokens of the template are boilerplate; the text blocks between them
   are slots. The main text is the slots of the page's main element
   (``article`` or ``main``, or their roles). A page without one takes the
   block path that has the most slot text outside links on its host.
   Inside a marked main element a text block counts as boilerplate only if it
   belongs to the root class of its host's template (it stands once in every
   distinct page) and the article otherwise differs from the host's others
   (``_differs``): the pages of a host may all be versions of one article.
4. What HTML itself marks as no article goes in any case: menus, headers,
   footers, sidebars, forms, scripts, styles, and elements whose class, id or
   role names a notice, an advert, reader comments and the like.

Character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined in page order by an empty line.

Defined results: null or empty html gives an empty text; text outside any tag
is a block; unclosed elements end with the page; a page without a host, or the
only page of its host, is judged by its own markup; repeated pages are
extracted alike and count once in the vectors; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import stored, table

LEAST_PAGES = 3
LEAST_SHARE = 0.5
#: A token that every page has once, whatever its markup.
ROOT = "page"
#: Bytes of template rows up to which they are sent to all tasks.
BROADCAST_BYTES = 32 << 20

#: Elements whose content is no article text (fixed list).
SKIP = frozenset("head title nav header footer aside form dialog menu button select textarea label noscript template iframe object svg math canvas audio video".split())
#: Elements that do not break a block.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Start tag -> open elements that it ends (up to the nearest of the stop elements).
ENDS = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "option": ("option", "select"), "thead": ("tr td th", "table"), "tbody": ("thead tbody tr td th", "table"), "tfoot": ("tbody tr td th", "table"),
}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}
MAIN_ROLES = frozenset({"main", "article"})
#: Words in class, id or role that name no article (fixed list).
NOT_ARTICLE = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside complementary banner masthead header footer contentinfo search searchform ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended comment comments commentlist disqus reply replies respond widget toolbar skip copyright".split()
)
#: Never taken out by a class name: their classes often tell about the page's layout.
LAYOUT = frozenset({"html", "body", "main"})
#: Those of the words above that also name layouts; a main element inside counts nevertheless.
LAYOUT_WORDS = frozenset("nav navbar menu sidebar header footer search login toolbar skip copyright widget sharing share".split())
SOFT, HARD = 1, 2

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|xmp)\b[^>]*>.*?(?:</\1[^>]*>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+>)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|itemprop|hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[A-Za-z]+")
_SPACE = re.compile(r"\s+")


class Block:
    """A text block: its path, text, length inside links, and whether it
    stands in a main element and outside all that is no article."""

    __slots__ = ("path", "text", "linked", "main", "skipped")

    def __init__(self, path: str, text: str, linked: int, main: bool, skipped: bool):
        self.path, self.text, self.linked, self.main, self.skipped = path, text, linked, main, skipped


def _says(attributes: str) -> tuple[list[str], bool, bool]:
    """Class and id words; whether a role or property marks the main text; whether it is hidden."""
    words: list[str] = []
    main = hidden = False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden":
            hidden = True
        elif name == "itemprop":
            main = main or value == "articlebody"
        else:
            words += _NAME.findall(value)
            main = main or (name == "role" and value in MAIN_ROLES)
    return words, main, hidden


def blocks(html: str) -> tuple[list[Block], list[str]]:
    """Text blocks in page order, and the paths of all block elements."""
    out: list[Block] = []
    paths: list[str] = [ROOT]
    stack: list[tuple[str, str, bool, int]] = []  # element, path, in main, skipped
    parts: list[str] = []
    linked, in_link = 0, False

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", unescape("".join(parts))).strip()
            if text:
                _, path, main, skipped = stack[-1] if stack else ("", "", False, 0)
                out.append(Block(path, text, min(linked, len(text)), main, skipped > 0))
            parts.clear()
        linked = 0

    at = 0
    last = max(html.rfind(">") + 1, html.find("<!--") + 1 and len(html))  # no tag ends behind it
    for m in _TOKEN.finditer(html, 0, last):
        if m.start() > at:
            piece = html[at : m.start()]
            parts.append(piece)
            linked += len(piece) if in_link else 0
        at = m.end()
        name = m[3]
        if not name:
            if m[0].startswith("<![CDATA["):
                parts.append(m[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if name in INLINE:
            if name == "a":
                in_link = not m[2]
            elif name == "br":
                parts.append(" ")
            continue
        flush()
        if m[2]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
                if stack[i][0] in ("article", "main", "body", "table") and name in ("p", "li", "td", "th", "tr", "div", "section", "ul", "ol"):
                    break  # a stray end tag doesn't close what holds it
            in_link = False
            continue
        if stack and stack[-1][0] == "p":
            stack.pop()  # a block ends an open paragraph
        if name in ENDS:
            ended, stop = ENDS[name]
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in stop:
                    break
                if stack[i][0] in ended:
                    del stack[i:]
        if name in VOID:
            continue
        words, marked, hidden = _says(m[4]) if len(m[4]) > 1 else ([], False, False)
        _, path, main, skipped = stack[-1] if stack else ("", "", False, 0)
        path = f"{path}/{name}" + (f".{'.'.join(sorted(set(words)))}" if words else "")
        marked = marked or name in ("article", "main")
        if marked and skipped == SOFT:
            skipped = 0  # a class that named the layout around the main element
        named = name not in LAYOUT and NOT_ARTICLE.intersection(words)
        if hidden or name in SKIP or (named and not named <= LAYOUT_WORDS):
            skipped = HARD
        elif named and not marked:
            skipped = max(skipped, SOFT)
        main = main or (marked and not skipped)
        paths.append(path)
        if not m[4].endswith("/>") or name in ("p", "div"):
            stack.append((name, path, main, skipped))
    if at < len(html):
        parts.append(html[at:])
    flush()
    return out, paths


def _hash(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\x00".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _element(path: str) -> int:
    """Token of the elements at a path; also names the path of what they hold."""
    return _hash("tag", path)


_TOKENS = "host string, page bigint, token bigint, n int, path bigint, is_text boolean, size bigint"


def _token_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of each page: block paths and text blocks. For slots outside
    what markup excludes, ``size`` is their text outside links."""
    types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int64()]
    names = [x.split()[0] for x in _TOKENS.split(", ")]
    for batch in batches:
        rows: list[tuple] = []
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1)):
            html = html.as_py()
            if not html:
                continue
            page = _hash(html)
            found, paths = blocks(html)
            rows += [(host, page, _element(p), n, _element(p.rpartition("/")[0]), False, 0) for p, n in Counter(paths).items()]
            texts = Counter((b.path, b.text) for b in found)
            size = {(b.path, b.text): 0 if b.skipped else len(b.text) - b.linked for b in found}
            rows += [(host, page, _hash("text", *key), n, _element(key[0]), True, size[key]) for key, n in texts.items()]
            if len(rows) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _host():
    return F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def deduce_templates(pages: DataFrame) -> DataFrame:
    """One row per host with a template: host, boilerplate (its text tokens),
    sure (those of the root class), slot (the block path with
    the most slot text)."""
    rows = pages.select(_host().alias("host"), "html").where("host <> ''")
    # One row per host, distinct page and token.
    tokens = rows.mapInArrow(_token_task, _TOKENS).groupBy("host", "token", "page").agg(F.first("n").alias("n"), F.first("path").alias("path"), F.first("is_text").alias("is_text"), F.first("size").alias("size"))
    vectors = tokens.groupBy("host", "token").agg(
        F.count("*").alias("pages"),
        F.bit_xor(F.xxhash64("page", "n")).alias("v1"),
        F.bit_xor(F.xxhash64("n", "page")).alias("v2"),
        F.min("path").alias("path"),
        F.first("is_text").alias("is_text"),
        F.sum("size").alias("size"),
    )
    vectors = stored(vectors, "html-vectors")
    root = vectors.where(F.col("token") == _element(ROOT)).select("host", F.col("pages").alias("all"), F.col("v1").alias("root1"), F.col("v2").alias("root2"))
    root = root.where(F.col("all") >= LEAST_PAGES)
    candidate = vectors.join(root, "host").where((F.col("pages") >= LEAST_PAGES) & (F.col("pages") >= LEAST_SHARE * F.col("all")))
    classes = candidate.groupBy("host", "v1", "v2").agg(F.count("*").alias("members")).where("members > 1")
    valid = candidate.join(classes, ["host", "v1", "v2"])
    # Nested under the template: the element that holds the token is in the template as well.
    holders = candidate.where("NOT is_text").select("host", F.col("token").alias("path")).distinct()
    is_root = (F.col("v1") == F.col("root1")) & (F.col("v2") == F.col("root2"))
    texts = valid.where("is_text").select("host", "token", "path", is_root.alias("sure"))
    texts = texts.join(holders, ["host", "path"], "left_semi")
    template = texts.groupBy("host").agg(F.collect_set("token").alias("boilerplate"), F.collect_set(F.when(F.col("sure"), F.col("token"))).alias("sure"))
    slots = vectors.where("is_text AND size > 0").join(texts.select("host", "token"), ["host", "token"], "left_anti").join(root.select("host"), "host")
    slots = slots.groupBy("host", "path").agg(F.sum("size").alias("size")).groupBy("host").agg(F.max_by("path", F.struct("size", "path")).alias("slot"))
    return slots.join(template, "host", "left")


def _differs(own: list[Block], shared: list[Block]) -> bool:
    """Whether an article is one of its own beside what all pages of its host
    show in it: at least as many blocks and half as much text, and a title that
    not all have. Versions of one article share their title and most of it."""
    titled = any(re.match(r"h1(\.|$)", b.path.rpartition("/")[2]) for b in shared)
    return not titled and len(own) >= len(shared) and 2 * sum(len(b.text) for b in own) >= sum(len(b.text) for b in shared)


def main_text(html: str | None, boilerplate: frozenset = frozenset(), sure: frozenset = frozenset(), slot: int | None = None) -> str:
    """The main text of one page, given its host's template."""
    found, _ = blocks(html or "")
    marked = [b for b in found if b.main]
    if marked:
        marked = [b for b in marked if not b.skipped]
        shared = [b for b in marked if sure and _hash("text", b.path, b.text) in sure]
        own = [b for b in marked if b not in shared]
        return "\n\n".join(b.text for b in (own if _differs(own, shared) else marked))
    open_ = [b for b in found if not b.skipped and not (boilerplate and _hash("text", b.path, b.text) in boilerplate)]
    if slot is not None and any(_element(b.path) == slot for b in open_):
        # The slot's element and what stands beside it under the same parent.
        parent = next(b.path for b in open_ if _element(b.path) == slot).rpartition("/")[0]
        return "\n\n".join(b.text for b in open_ if b.path.startswith(parent) and (_element(b.path) == slot or 2 * b.linked < len(b.text)))
    return "\n\n".join(b.text for b in open_ if 2 * b.linked < len(b.text))


_TEXTS = "page_id bigint, url string, text string, n_chars bigint"


def _extract_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        page_id, url, html, boilerplate, sure, slot = batch.columns
        texts = [
            main_text(html[i].as_py(), frozenset(boilerplate[i].as_py() or ()), frozenset(sure[i].as_py() or ()), slot[i].as_py())
            for i in range(batch.num_rows)
        ]
        yield pa.RecordBatch.from_arrays([page_id, url, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [x.split()[0] for x in _TEXTS.split(", ")])


def extract(pages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    templates = stored(deduce_templates(pages), "html-templates").withColumnRenamed("host", "__host")
    size = templates.agg(F.sum(64 + F.length("__host") + 8 * (F.coalesce(F.size("boilerplate"), F.lit(0)) + F.coalesce(F.size("sure"), F.lit(0))))).first()[0] or 0
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    joined = rows.join(F.broadcast(templates) if size <= broadcast_bytes else templates, _host() == F.col("__host"), "left")
    return joined.select("page_id", "url", "html", "boilerplate", "sure", "slot").mapInArrow(_extract_task, _TEXTS)


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
