"""HTML extraction with a site style tree.

Every page is read into blocks (the text between block-level tags) under the
path of their block-level elements, each a tag with its classes and id (digits in
them as 0; html and body by tag alone). The pages of a host merge into one tree:
for each path, how many pages m have it, which presentations (sequences of inline
tags) and which contents its blocks show. Pages of a host with the same blocks are
one page here, so copies of a page under many URLs are no template.

* presentation importance is the entropy of the path's presentations, base m;
* content importance, of each content, is 1 minus the entropy of its spread over
  the m pages: 0 if every page repeats it, 1 if one page has it.

A content's importance under its path is (1 - GAMMA) * presentation + GAMMA *
content. Two things are template. A branch outside the article or main element goes
as a whole if the mean importance of what its blocks show is below `THRESHOLD`, on any host with
two different pages or more. A single content goes from among the others of its path (a notice
between paragraphs) if most of the path's pages show it and its importance is below
`THRESHOLD` with `PRIOR` pages added that do not show it: few pages are little
evidence, and a passage that two articles share is no notice. What would be cut from
a page must be less than half of its text; more is a near copy of another page.

Elements that are no article by tag, role or the hidden attribute (menus, footers,
forms, ...) never enter the tree; an article's own header does. A class or id says
so by its last word, numbers and structural words (list, box, area, ...) aside
("reader-comments", "comments-section-12"; not "no-sidebar" or "header-fixed"), but
not on html, body, main or article, not on inline elements, whose words belong to
their sentence, and not where the element holds most of the page's text (reader
comments: all of it) and no article or main element beside it has any. Text outside an article or main element is read like any
other, and the tree decides.

A page is shuffled once, as hashes by its digest; the tree is kept as counts by
(host, path, value), summed before the shuffle, so a large host is no large group;
what a host loses is one short list of contents repeated on most of a path's pages.

Nulls and edge cases: null or empty html gives an empty text; a null url is a
host of its own; comments, tags and scripts may end with the page; an empty table gives an empty result; columns whose names
clash with the result's are replaced.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm.common import quoted, stage, table, without
from spindle.llm.urls import host_of

# Fixed values.
GAMMA = 0.9
THRESHOLD = 0.2
PRIOR = 2.0  # unseen pages of a path
LONGEST_PATH = 300  # deeper paths go by their hash
DROPPED_TAGS = frozenset((
    "script", "style", "noscript", "template", "head", "title", "nav", "header", "footer", "aside", "form", "button",
    "select", "option", "textarea", "input", "label", "fieldset", "iframe", "object", "embed", "svg", "canvas", "menu", "dialog",
    "audio", "video", "map"))
RAW_TAGS = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg")
VOID_TAGS = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
INLINE_TAGS = frozenset((
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
    "var", "wbr"))
DROPPED_NAMES = frozenset((
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "cookie",
    "cookiebanner", "cookiebar", "cookies", "disclaimer", "disqus", "footer", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
    "pager", "pagination", "popup", "promo", "related", "replies", "respond", "share", "sharing", "sidebar", "social", "sponsor", "sponsored",
    "subscribe", "toolbar"))
DROPPED_COMPOUNDS = frozenset((
    "ad-banner", "ad-box", "ad-container", "ad-slot", "ad-unit", "ad-wrapper", "adsbygoogle", "banner-ad", "comment-form",
    "comment-list", "comments-area", "comments-list", "comments-section", "cookie-banner", "cookie-bar", "cookie-consent",
    "cookie-notice", "cookie-popup", "footer-links", "footer-menu", "footer-nav", "footer-widgets", "global-footer", "global-header",
    "global-nav", "main-menu", "main-nav", "main-navigation", "nav-bar", "nav-links", "nav-menu", "newsletter-form",
    "newsletter-signup", "page-footer", "post-navigation", "primary-menu", "primary-nav", "related-articles", "related-links",
    "related-posts", "share-bar", "share-buttons", "share-links", "sharing-buttons", "site-footer", "site-header", "site-nav",
    "site-navigation", "social-buttons", "social-icons", "social-links", "social-share", "top-nav"))
KEPT_TAGS = frozenset(("html", "body", "main", "article"))  # never dropped by class or id
COMMENT_NAMES = frozenset(("comment", "comments", "disqus", "replies", "respond"))
COMMENTS = "comments"
# Words that say little at the end of a name, and words that turn it round.
STRUCTURE = frozenset((
    "area", "bar", "block", "box", "container", "group", "inner", "item", "list", "outer", "panel", "section", "slot", "thread", "unit",
    "widget", "wrap", "wrapper"))
MODIFIERS = frozenset(("free", "has", "hide", "no", "non", "with", "without"))
DROPPED_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu"))
CLOSED_BY_SIBLING = {"p": None, "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                     "th": ("td", "th"), "option": ("option",)}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW_TAGS) + r")(?=[\s>/])[^<>]*>.*?(?:</\1\s*>|\Z)|<[!?][^<>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"<]{0,2000}\"|'[^'<]{0,2000}')*|[^<>]*)(?:>|\Z|(?=<))", re.S | re.I)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_IN_ARTICLE = re.compile(r"(?:^|/)(?:article|main)(?:[.#/]|$)")
_DIGITS = re.compile(r"[0-9]+")


def _no_article(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether the element is no article by its tag, role or the hidden attribute."""
    if tag in DROPPED_TAGS:
        return not (tag == "header" and in_article)
    if not attributes:
        return False
    if any(name.lower() == "role" and (a or b or c).lower().strip() in DROPPED_ROLES for name, a, b, c in _ATTRIBUTE.findall(attributes)):
        return True
    return "hidden" in attributes.lower().split()


def _named(tag: str, attributes: str, in_article: bool) -> str:
    """The name in its class or id that says the element is no article, or ""."""
    if not attributes or tag in KEPT_TAGS:
        return ""
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        if name.lower() == "role":
            continue
        for value in (a or b or c).split():
            words = [w.lower() for w in _WORDS.findall(value)]
            if not words or MODIFIERS.intersection(words):
                continue
            if "-".join(words) in DROPPED_COMPOUNDS:
                return COMMENTS if COMMENT_NAMES.intersection(words) else "-".join(words)
            while len(words) > 1 and words[-1] in STRUCTURE:
                words.pop()
            if words[-1] in DROPPED_NAMES and not (in_article and words[-1] == "header"):
                return COMMENTS if words[-1] in COMMENT_NAMES else words[-1]
    return ""


def _node(tag: str, attributes: str) -> str:
    if not attributes or tag in ("html", "body"):
        return tag
    names = {mark + _DIGITS.sub("0", w) for name, a, b, c in _ATTRIBUTE.findall(attributes)
             if (mark := {"class": ".", "id": "#"}.get(name.lower())) for w in (a or b or c).lower().split()}
    return tag + "".join(sorted(names)).replace("/", "")


def blocks(page: str) -> list[tuple[str, str, str]]:
    """(path, inline tags, text) of the blocks of a page, in page order."""
    found: list[tuple[str, str, str, tuple[int, ...]]] = []
    open_: list[tuple[str, str, bool, tuple[int, ...]]] = []  # tag, path, dropped, named elements that it is in
    names: list[tuple[str, bool]] = []  # of the named elements, and whether they are in an article
    depth: Counter = Counter()  # open elements by tag
    pieces: list[str] = []
    inline: list[str] = []
    at = 0

    def flush() -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(pieces))).strip() if pieces else ""
        if text:
            found.append((open_[-1][1] if open_ else "", " ".join(inline), text, open_[-1][3] if open_ else ()))
        pieces.clear()
        inline.clear()

    for token in _TOKEN.finditer(page):
        if token.start() > at and not (open_ and open_[-1][2]):
            pieces.append(page[at:token.start()])
        at = token.end()
        close, tag, attributes = token.group(2), token.group(3), token.group(4)
        if tag is None:
            continue
        tag = tag.lower()
        in_article = depth["article"] + depth["main"] > 0
        if tag in INLINE_TAGS and not (attributes and not close and _no_article(tag, attributes, in_article)):
            if close:
                if open_ and open_[-1][0] == tag:  # an inline element that was dropped
                    depth[open_.pop()[0]] -= 1
                continue
            if not (open_ and open_[-1][2]):
                inline.append(tag)
                if tag == "br":
                    pieces.append(" ")
            continue
        if close:
            if depth[tag]:
                flush()
                while (ended := open_.pop()[0]) != tag:
                    depth[ended] -= 1
                depth[tag] -= 1
            continue
        if tag not in INLINE_TAGS:
            flush()
        dropped = bool(open_ and open_[-1][2])
        if tag in VOID_TAGS:
            continue
        if not dropped and open_ and open_[-1][0] in CLOSED_BY_SIBLING:
            ends = CLOSED_BY_SIBLING[open_[-1][0]]
            if ends is None or tag in ends:  # a paragraph ends at any block
                depth[open_.pop()[0]] -= 1
                dropped = bool(open_ and open_[-1][2])
        if dropped and open_[-1][0] != tag and attributes.endswith("/"):
            continue
        path = (open_[-1][1] + "/" if open_ else "") + _node(tag, attributes)
        if len(path) > LONGEST_PATH:
            path = f"#{_value(path):x}"
        depth[tag] += 1
        within = open_[-1][3] if open_ else ()
        if not dropped and tag not in INLINE_TAGS and (name := _named(tag, attributes, in_article)):
            names.append((name, in_article))
            within = (*within, len(names) - 1)
        open_.append((tag, path, dropped or _no_article(tag, attributes, in_article), within))
    if at < len(page) and not (open_ and open_[-1][2]):
        pieces.append(page[at:])
    flush()
    return _without_named(found, names)


def _without_named(found: list[tuple[str, str, str, tuple[int, ...]]], names: list[tuple[str, bool]]) -> list[tuple[str, str, str]]:
    """The blocks outside of named elements. An element that holds most of the text
    (comments: all of it) is not one of these, unless it stands beside an article or
    main element that has text."""
    held = [0] * len(names)
    for *_, text, within in found:
        for element in within:
            held[element] += len(text)
    total = sum(len(text) for _, _, text, _ in found)
    article = any(not within and _IN_ARTICLE.search(path) for path, _, _, within in found) if names else False
    gone = {e for e, (name, inside) in enumerate(names)
            if (held[e] < total if name == COMMENTS else 2 * held[e] <= total or (article and not inside))}
    return [(path, inline, text) for path, inline, text, within in found if not gone.intersection(within)]


def _value(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _content(path: str, text: str) -> int:
    return _value(f"{path}\0{text}")


PAGE, PRESENTATION, CONTENT = 0, 1, 2


def style_tree(pages: DataFrame) -> DataFrame:
    """pages (host, html) -> (host, path, content, shown, pages, importance, branch),
    for each content under a path that two or more different pages have; `shown` is
    how many show it, `pages` how many have the path, `importance` that of the
    content with `PRIOR` unseen pages, `branch` the mean of what the path's blocks
    show, without."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_type = pa.list_(pa.struct([("path", pa.string()), ("kind", pa.int32()), ("value", pa.int64())]))
        for batch in batches:
            seen: dict = {}
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                found = blocks(page or "")
                if not found:
                    continue
                at = hashlib.blake2b(digest_size=16)
                own = set()
                for path, inline, text in found:
                    at.update(f"{path}\0{inline}\0{text}\0".encode("utf-8", "surrogatepass"))
                    own |= {(path, PAGE, 0), (path, PRESENTATION, _value(inline)), (path, CONTENT, _content(path, text))}
                seen[host, at.digest()] = own
            hosts, digests = zip(*seen) if seen else ([], [])
            own = [[{"path": p, "kind": k, "value": v} for p, k, v in sorted(o)] for o in seen.values()]
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(digests, pa.binary()), pa.array(own, own_type)],
                                             ["host", "page", "own"])

    once = pages.select("host", "html").mapInArrow(read, "host string, page binary, own array<struct<path string, kind int, value long>>") \
        .dropDuplicates(["host", "page"])
    counts = stage(once.select("host", F.explode("own").alias("o")).groupBy("host", "o.path", "o.kind", "o.value")
                   .agg(F.count(F.lit(1)).alias("n")), "html-tree")
    of = lambda kind, x: F.sum(F.when(F.col("kind") == kind, x).otherwise(F.lit(0.0)))
    n = F.col("n").cast("double")
    sums = counts.where(F.col("kind") != CONTENT).groupBy("host", "path").agg(
        of(PAGE, n).alias("m"), of(PRESENTATION, n).alias("shows"), of(PRESENTATION, n * F.log(n)).alias("show_logs")).where("m > 1")
    presentation = F.least(F.lit(1.0), (F.log("shows") - F.col("show_logs") / F.col("shows")) / F.log("m"))
    whole = lambda content: (1 - GAMMA) * F.col("presentation") + GAMMA * content
    contents = counts.where(F.col("kind") == CONTENT).select("host", "path", F.col("value").alias("content"), "n")
    plain = 1.0 - F.log(n) / F.log("m")
    known = contents.join(sums.select("host", "path", "m", presentation.alias("presentation")), ["host", "path"])
    branch = known.groupBy("host", "path").agg((F.sum(n * whole(plain)) / F.sum(n)).alias("branch"))
    return known.where("n > 1").join(branch, ["host", "path"]).select(
        "host", "path", "content", F.col("n").alias("shown"), F.col("m").cast("long").alias("pages"),
        whole(1.0 - F.log(n) / F.log(F.col("m") + PRIOR)).alias("importance"), "branch")


def template(tree: DataFrame, threshold: float = THRESHOLD) -> Column:
    """Whether a row of the tree is template: by its branch (outside of articles),
    or by itself."""
    outside = ~F.col("path").rlike(_IN_ARTICLE.pattern) & ~F.col("path").startswith("#")
    return (outside & (F.col("branch") < threshold)) | ((F.col("importance") < threshold) & (2 * F.col("shown") > F.col("pages")))


def _cut(found: list[tuple[str, str, str]], gone: frozenset) -> list[str]:
    """The texts of a page without its template, unless that were most of it."""
    kept = [text for path, _, text in found if _content(path, text) not in gone] if gone else [text for _, _, text in found]
    return kept if 2 * sum(map(len, kept)) > sum(len(text) for _, _, text in found) else [text for _, _, text in found]


def extract(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`pages` (url and html among its columns) with text and n_chars instead of
    html."""
    result = ("text", "n_chars", "html")
    rest = without(pages, result)
    hosts = pages.select(*rest, quoted("html").alias("html"), host_of(quoted("url")).alias("__host"))
    tree = style_tree(hosts.select(F.col("__host").alias("host"), "html"))
    low = stage(tree.where(template(tree, threshold)).groupBy(F.col("host").alias("__host"))
                .agg(F.collect_set("content").alias("__low")), "html-low")
    joined = hosts.join(low, "__host", "left").drop("__host")
    columns = [c for c in joined.columns if c not in ("html", "__low")]
    fields = ", ".join(f"`{c.replace('`', '``')}` {joined.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, cut in zip(batch.column("html").to_pylist(), batch.column("__low").to_pylist()):
                texts.append("\n\n".join(_cut(blocks(page or ""), frozenset(cut or ()))))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], [*columns, "text", "n_chars"])

    return joined.mapInArrow(run, fields + ", text string, n_chars long")


def op5_html(spark: SparkSession, data_dir: str) -> DataFrame:
    return extract(table(spark, data_dir, "pages", "page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
