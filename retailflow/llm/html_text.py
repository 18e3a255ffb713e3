"""Main text of web pages by equivalence-class template deduction.

A page is a sequence of tokens: the start tags of its containers, each in its role (tag, class and id below the roles
of the containers around it), and its text blocks, each in the role of its container.  Over the pages of one host,
tokens with the same occurrence vector (how often in which page) form an equivalence class.  A class is valid if
it is large and frequent enough and its tokens lie in containers that are themselves tokens of valid classes; the
nested valid classes are the host's template.  The rest of a page fills the template's slots, and a slot
whose text differs from page to page holds data.

Vectors are not gathered: the vector of a token is the sum of hashes of (page, count), an aggregate with partial sums, so
a host with a third of all pages is no heavier than many small ones.  A template is a few numbers per recurring
container.

The article is the slot to extract: the innermost container that holds most of the page's data.  Names come second: where the slot
lies in an ``article`` or ``main`` container (or one named like it) that is taken whole, and between several slots the one named so goes
first.  Menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts and styles are left out inside it, and in a slot that
nothing names so is template text: containers whose text is the template's on every page, and blocks that every page repeats
where most of a container varies (``SLOT``).  Where all pages of a host are alike, no slot holds data;
then all text counts as data, and nothing is lost by being repeated.

Text.  Character references are decoded; white space in a block becomes one space; blocks are joined by one line
feed.  Block elements and ``br`` end a block.

Cases.  Null html is the empty page, its text is empty.  A null or odd url is a host of its own, page by page.  Unclosed and crossing
tags, missing ends, and ``<`` in text are read as browsers do, roughly.  Repeated rows stay rows; other columns pass
through, ``host``, ``text`` and ``n_chars`` among them are replaced.  An empty table stays empty.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import ready, tidy, written

#: A valid class has this many tokens, on this many pages and this share of its host's pages.
LEAST_TOKENS, LEAST_PAGES, LEAST_SHARE = 3, 2, 0.02
#: A container is a slot of its template, in which what repeats is template too, from this share of data on.
SLOT = 0.5
#: A container holds the article if it has this share of the data of the container around it.
MOST = 0.7

# HTML element names and names used in class, id and role attributes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes template".split())
CONTAINER = frozenset("html body div section article main nav aside header footer form table ul ol dl figure details dialog fieldset center".split())
BLOCK = CONTAINER | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption blockquote pre hr br address figcaption summary legend option".split())
LEFT_OUT = frozenset("head nav aside footer form script style noscript button select input textarea dialog svg canvas menu object audio video".split())
LEFT_OUT_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
LEFT_OUT_NAME = frozenset("""nav navbar navigation menu breadcrumb breadcrumbs masthead topbar header footer sidebar side aside ad ads advert adverts
 advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe
 subscription signup login search comment comments disqus respond replies share sharing social related recommended recommendations widget widgets
 pagination pager toolbar hidden""".split())
ARTICLE_NAME = frozenset("article content post entry story main article-body articlebody post-content entry-content post-body story-body main-content maincontent".split())

_TAG = re.compile(r"""<!--(?:.*?--!?>|.*)|<[!?][^>]*>|</[a-zA-Z][^>]*>|<[a-zA-Z](?>[^>"'=]+|=\s*"[^"]*"|=\s*'[^']*'|["'=])*+>""", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_DIGITS = re.compile(r"\d{2,}")  # numbers of posts and the like


def _hash(text: str) -> int:
    return (xxhash.xxh64_intdigest(text) >> 1) or 1


class Page:
    """Containers of a page and its text blocks."""

    def __init__(self, source: str):
        # of each container: container around it, tag, hash of its role, whether it is left out, whether it is named like an article
        self.parent, self.tag, self.role, self.out, self.named = [-1], [""], [0], [False], [False]
        self.blocks: list[tuple[int, str]] = []
        self._open: list[tuple[str, int]] = [("", 0)]
        self._held: list[str] = []
        at, end = 0, len(source)
        while at < end:
            m = _TAG.search(source, at)
            if not m:
                self._text(source[at:])
                break
            if m.start() > at:
                self._text(source[at: m.start()])
            at = m.end()
            text = m.group()
            if not (name := _NAME.match(text)):
                continue
            tag = name.group(1).lower()
            if text[1] == "/":
                self._end(tag)
                continue
            if tag in RAW:
                close = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(source, at)
                at = close.end() if close else end
                continue
            self._start(tag, text[name.end():-1])
        self._flush()

    def _text(self, text: str) -> None:
        if not self.out[self._open[-1][1]]:
            self._held.append(text)

    def _flush(self) -> None:
        if self._held:
            if text := " ".join(html.unescape("".join(self._held)).split()):
                self.blocks.append((self._open[-1][1], text))
            self._held = []

    def _start(self, tag: str, rest: str) -> None:
        if tag in BLOCK:
            self._flush()
            if self._open[-1][0] == "p":
                self._open.pop()
        if tag in VOID:
            return
        near = self._open[-1][1]
        names, role, hidden = self._names(rest) if "=" in rest or "hidden" in rest else ((), "", False)
        inside = self._within("article", near)
        out = (tag in LEFT_OUT or role in LEFT_OUT_ROLE or hidden or (tag == "header" and not inside)
               or (tag not in ("html", "body", "article", "main") and any(self._bad(n, inside) for n in names)))
        if out or tag in CONTAINER:
            label = tag + "".join("." + _DIGITS.sub("0", n) for n in sorted(names))
            self.parent.append(near)
            self.tag.append(tag)
            self.role.append(xxhash.xxh64_intdigest(label, self.role[near]) >> 1)
            self.out.append(out or self.out[near])
            self.named.append(tag in ("article", "main") or role == "main" or any(n in ARTICLE_NAME for n in names))
            self._open.append((tag, len(self.parent) - 1))

    def _within(self, tag: str, node: int) -> bool:
        while node > 0:
            if self.tag[node] == tag:
                return True
            node = self.parent[node]
        return False

    @staticmethod
    def _names(rest: str) -> tuple[set[str], str, bool]:
        names, role, hidden = set(), "", bool(re.search(r"(?:^|\s)hidden(?:\s|/|$)", _ATTRIBUTE.sub(" ", rest)))
        for m in _ATTRIBUTE.finditer(rest):
            key, value = m.group(1).lower(), (m.group(2) or m.group(3) or m.group(4) or "").lower()
            if key in ("class", "id"):
                names.update(value.split())
            elif key == "role":
                role = value.strip()
            elif key == "itemprop" and "articlebody" in value:
                names.add("articlebody")
            elif key == "style" and "display:none" in value.replace(" ", ""):
                hidden = True
        return names, role, hidden

    @staticmethod
    def _bad(name: str, inside: bool) -> bool:
        """Whether a class or id names something left out; an article's own header holds its title."""
        parts = re.split(r"[-_]+", name)
        if inside and parts[-1] == "header" or parts[0] in ("no", "with", "has", "without"):
            return False
        return name in LEFT_OUT_NAME or parts[0] in LEFT_OUT_NAME or parts[-1] in LEFT_OUT_NAME

    def _end(self, tag: str) -> None:
        if tag in BLOCK:
            self._flush()
        for i in range(len(self._open) - 1, 0, -1):
            if self._open[i][0] == tag:
                self._flush()
                del self._open[i:]
                return
            if tag not in CONTAINER and self._open[i][0] in CONTAINER:
                return  # an end tag of something small doesn't close a container

    def tokens(self) -> list[tuple[int, int, int, int, int]]:
        """(role, role around it, text hash or 0, count, characters) of every distinct token outside what is left out."""
        found: dict[tuple[int, int, int], list[int]] = {}
        for i in range(1, len(self.parent)):
            if not self.out[i]:
                found.setdefault((self.role[i], self.role[self.parent[i]], 0), [0, 0])[0] += 1
        for node, text in self.blocks:
            t = found.setdefault((self.role[node], self.role[node], _hash(text)), [0, 0])
            t[0] += 1
            t[1] += len(text)
        return [(*k, *v) for k, v in found.items()]

    def article(self, data: dict[int, float], fixed: set[tuple[int, int]] = frozenset()) -> list[str]:
        """Blocks of the article.  ``data``: share of data in the text of a container, by role (1 where it is not named);
        ``fixed``: template text inside slots, by role and hash."""
        n = len(self.parent)
        own = self._weights([data.get(r, 1.0) for r in self.role])
        known = own[0] > 0
        if not known:  # pages of a host that are all alike: everything is template, nothing tells the slots apart
            own = self._weights([1.0] * n)
        main = self._slot(own)
        inside = [False] * n
        for i in range(n):  # with the article all of its role: a text may come in several
            inside[i] = i == main or self.named[i] and self.role[i] == self.role[main] or i > 0 and inside[self.parent[i]]
        # a container whose text is the template's on every page fills no slot; one that is the article is taken whole
        whole = self.named[main] or not known
        return [text for node, text in self.blocks if inside[node] and (whole or data.get(self.role[node], 1.0) > 0 and (self.role[node], _hash(text)) not in fixed)]

    def _weights(self, share: list[float]) -> list[float]:
        """Characters of data in every container, those of the containers in it included."""
        own = [0.0] * len(self.parent)
        for node, text in self.blocks:
            own[node] += len(text) * share[node]
        for i in range(len(self.parent) - 1, 0, -1):
            own[self.parent[i]] += own[i]
        return own

    def _slot(self, own: list[float]) -> int:
        """The innermost container that holds most of the data.  Names decide how far out the article goes, and between slots alike."""
        node = 0
        while True:
            best = max((i for i in range(1, len(self.parent)) if self.parent[i] == node and not self.out[i]), key=lambda i: own[i], default=None)
            if best is None or own[best] < MOST * own[node] or own[best] <= 0:
                break
            node = best
        up = node
        while up > 0 and not self.named[up]:
            up = self.parent[up]
        if up > 0:  # the article around it, with its title; the outermost of the most telling kind
            kinds = [up]
            while (up := self.parent[up]) > 0:
                kinds += [up] * self.named[up]
            return max(kinds, key=lambda i: (self.tag[i] == "article", self.tag[i] == "main", i))
        for kind in ("article", "main", None):  # several, none of which holds most
            some = [i for i in range(1, len(self.parent)) if not self.out[i] and own[i] > 0 and self.named[i] and kind in (None, self.tag[i])]
            if some:
                by_role: dict[int, float] = {}
                for i in some:
                    by_role[self.role[i]] = by_role.get(self.role[i], 0) + own[i]
                return max(some, key=lambda i: (by_role[self.role[i]], -i))
        return node


def _host(pages: DataFrame):
    return F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def _tokens(batches):
    for batch in batches:
        out = [[], [], [], [], [], [], []]
        for host, key, source in zip(batch.column("host").to_pylist(), batch.column("page").to_pylist(), batch.column("html")):
            for token in Page(source.as_py() or "").tokens():
                for column, value in zip(out, (host, key, *token)):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), *(pa.array(c, pa.int64()) for c in out[1:])],
                                         ["host", "page", "role", "around", "words", "n", "chars"])


def templates(pages: DataFrame) -> DataFrame:
    """Per host: data (role, share of data in its text) of the recurring containers with template text.

    ``pages`` has host, page (a hash of the row) and html.
    """
    tokens = pages.mapInArrow(tidy(_tokens), "host string, page long, role long, around long, words long, n long, chars long")
    by_token = tokens.groupBy("host", "role", "around", "words").agg(
        F.count("*").alias("pages"), F.sum("chars").alias("chars"),
        F.sum(F.xxhash64("page", "n").cast("decimal(38,0)")).alias("vector"))
    # text met once in a host is data; it only counts towards its container, no token of it travels on
    single = (F.col("words") != 0) & (F.col("pages") < LEAST_PAGES)
    by_token = written(by_token.groupBy("host", "role", "around", F.when(single, F.lit(-1).cast("long")).otherwise(F.col("words")).alias("words")).agg(
        F.sum("pages").alias("pages"), F.sum("chars").alias("chars"), F.min("vector").alias("vector")), "tokens")
    sizes = by_token.where("words = 0").groupBy("host").agg(F.max("pages").alias("host_pages"))
    recurring = by_token.where((F.col("words") != -1) & (F.col("pages") >= LEAST_PAGES))
    classes = recurring.groupBy("host", "vector").agg(F.count("*").alias("tokens"))
    member = (recurring.join(classes, ["host", "vector"]).join(sizes, "host")
              .where((F.col("tokens") >= LEAST_TOKENS) & (F.col("pages") >= LEAST_SHARE * F.col("host_pages"))))
    # nested: the container around a token is a token of a valid class (the page itself always is)
    held = member.where("words = 0").select("host", F.col("role").alias("around")).distinct()
    nested = member.join(held.withColumn("nested", F.lit(True)), ["host", "around"], "left").where(F.col("nested") | (F.col("around") == 0))
    template = nested.where("words <> 0").select("host", "role", "words", F.lit(True).alias("is_fixed"))
    containers = by_token.where("words = 0").select("host", "role", F.col("pages").alias("role_pages"))
    text = by_token.where("words <> 0").join(template, ["host", "role", "words"], "left")
    share = text.groupBy("host", "role").agg(
        (1 - F.sum(F.when(F.col("is_fixed"), F.col("chars")).otherwise(0)) / F.sum("chars")).alias("share"))
    # text on every page in a slot that mostly varies; a slot that mostly repeats holds copies of an article, not a template
    slots = share.where(F.col("share") >= SLOT).select("host", "role").join(containers.where(F.col("role_pages") >= LEAST_TOKENS), ["host", "role"])
    always = (text.where("is_fixed").join(slots, ["host", "role"]).where(F.col("pages") == F.col("role_pages"))
              .groupBy("host").agg(F.collect_list(F.struct("role", "words")).alias("fixed")))  # together less than a page's text
    # of a host travel only the containers that hold template text
    data = (share.where("share < 1").join(containers, ["host", "role"]).where(F.col("role_pages") >= LEAST_PAGES)
            .groupBy("host").agg(F.collect_list(F.struct("role", "share")).alias("data")))
    return data.join(always, "host", "left")


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (url, html and others) with ``text`` and ``n_chars`` (code points)."""
    ready(pages.sparkSession)
    passed = [c for c in pages.columns if c not in ("html", "host", "text", "n_chars")]
    rows = pages.select(F.struct(*passed).alias("_row"), F.xxhash64(*passed, "html").alias("page"), _host(pages).alias("host"), "html")
    rows = rows.withColumn("host", F.when(F.col("host") == "", F.concat(F.lit("?"), "page")).otherwise(F.col("host")))
    template = written(templates(rows.select("host", "page", "html")), "templates")
    joined = rows.drop("page").join(template, "host", "left").drop("host")

    def run(batches):
        for batch in batches:
            texts = []
            for source, data, fixed in zip(batch.column("html"), batch.column("data"), batch.column("fixed")):
                page = Page(source.as_py() or "")
                texts.append("\n".join(page.article({d["role"]: d["share"] for d in data.as_py() or ()}, {(f["role"], f["words"]) for f in fixed.as_py() or ()})))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["_row", "text", "n_chars"])

    schema = T.StructType([rows.schema["_row"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return joined.mapInArrow(tidy(run), schema).select("_row.*", "text", "n_chars")
