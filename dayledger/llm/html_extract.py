"""Main text of web pages, by the template that the pages of a host share.

1. A page becomes tokens: tags, text runs, each with the path of the elements it stands
   in, so that one word in a menu and in a paragraph are two tokens.
2. Per host and token, the vector of its occurrences over the pages is summed up as a
   hash of (page, count): vectors are equal where sums are. Tasks add up what they see
   before anything is shuffled, so a host with a third of all pages is a row a token
   and task.
3. Tokens of one vector are an equivalence class. Classes of several tokens, found on
   enough of a host's pages, make its template.
4. On each page a class is valid if its tokens come in the order they have over the
   host, again and again, and it nests with the others. What valid classes leave are
   the slots. Slots of the article are the text: menus, headers, footers, sidebars,
   notices, adverts, forms, scripts and comments are told by their elements and names.

Text of a valid class in the article is template too, but only if nearly all of many
pages have it: passages that some documents share stay.

Pages are read twice and travel once at most: the templates go to all tasks where they
are small, which is counted; else pages are dealt by host and a salt.

Defined cases: null html is empty and gives an empty text; so does a page without text
outside the parts named. A null url is a host of its own; a host of few pages has no
template, its pages are slots throughout. Repeated rows are pages of their own. Pages
without article or main take the slots of the body that are not mostly links. An empty
table gives no rows. Other columns are returned as they are only on request.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from dayledger.llm.common import boxed, partitions, stage

#: A class counts from so many pages and this share of a host's; smaller ones are content.
MIN_PAGES, MIN_SHARE, MIN_CLASS = 5, 0.1, 2
#: Text in the article is template if this share of at least so many pages has it.
TEXT_PAGES, TEXT_SHARE = 20, 0.9
#: Templates of so many tokens together, 30 bytes each, are sent to all tasks.
SENT_TOKENS = 200_000
SALTS = 32
#: Tokens that a task adds up before it passes them on.
HELD_TOKENS = 200_000

# --- fixed values: names of elements, and of parts that are not the article ---------
RAW = frozenset("script style title textarea iframe noembed noframes xmp plaintext".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt s samp small "
    "span strike strong sub sup time tt u var".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
#: Elements that end an open one of their kind, up to the element that holds them.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
ASIDE = frozenset(
    "head nav aside footer form noscript template button select svg math canvas object audio video dialog menu "
    "datalist map".split()
)
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
ASIDE_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert newsletter subscribe popup modal overlay sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs masthead footer comment comments commentlist reply replies respond disqus share sharing "
    "social related recommended pagination pager toolbar login signup search widget".split()
)
WHOLE = frozenset("html body main".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*>?"
    r"|</?([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>"
    r"|</?[a-zA-Z][^>]*>?"
    r"|[^<]+|<",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
NAME_PARTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")


def _is_aside(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is none of the article, by its kind, role and names."""
    if tag in ASIDE or (tag == "header" and not in_article):
        return True
    if not attributes or tag in WHOLE:
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value.lower() in ASIDE_ROLES:
            return True
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if name in ("class", "id"):
            for word in value.split():
                parts = [p.lower() for p in NAME_PARTS.split(word) if p]
                if parts and parts[0] not in ("has", "with", "no") and ASIDE_NAMES & {parts[0], parts[-1]}:
                    return True
                if parts[:1] == ["header"] and not in_article:
                    return True
    return False


class Token(NamedTuple):
    """A tag or a text run. ``key`` is the same for the same content at the same path.
    ``kind``: ``<`` a block begins, ``>`` one ends, ``-`` a break or an inline tag that
    parts nothing, and ``=`` text. ``zone``: 0 aside, 1 body, 2 main, 3 article."""

    kind: str
    key: str
    text: str
    zone: int
    link: bool


class _Element(NamedTuple):
    tag: str
    path: str
    zone: int


def tokens(page: str) -> Iterator[Token]:
    """The tokens of a page, with elements closed as browsers close them."""
    stack = [_Element("", "", 1)]
    links, at, end = 0, 0, len(page)
    while at < end:
        found = TOKEN.match(page, at)
        at = found.end()
        raw, tag = found.group(), found.group(1)
        here = stack[-1]
        if raw[0] != "<" or raw == "<":
            yield Token("=", here.path + "=" + raw, raw, here.zone, links > 0)
            continue
        if tag is None:  # a comment, a declaration, or a tag that the page's end cuts
            continue
        tag = tag.lower()
        if raw[1] == "/":
            if tag == "a":
                links = max(links - 1, 0)
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if depth:
                path = stack[depth].path
                del stack[depth:]
                yield Token(">", path + ">", "", stack[-1].zone, False)
            continue
        attributes = found.group(2)
        if tag in RAW:
            close = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
            at = close.start() if close else end
            yield Token("-", f"{here.path}/{tag}", "", 0, False)
            continue
        if tag in ENDS_PARAGRAPH or tag in SIBLINGS:
            ended, holders = SIBLINGS.get(tag, ({"p"}, {"table", "td", "th", "button", "object"}))
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in holders:
                    break
                if stack[i].tag in ended:
                    path = stack[i].path
                    del stack[i:]
                    yield Token(">", path + ">", "", stack[-1].zone, False)
                    if tag != "tr":  # a row ends the cell and the row before it
                        break
            here = stack[-1]
        if tag in VOID:
            yield Token("<" if tag == "hr" else "-", f"{here.path}/{tag}", " " if tag == "br" else "", here.zone, False)
            continue
        if tag == "a":
            links += 1
        aside = _is_aside(tag, attributes, here.zone == 3)
        if tag in INLINE and not aside:
            yield Token("-", f"{here.path}/{tag}", "", here.zone, False)
            continue
        zone = here.zone
        if aside or zone == 0:
            zone = 0
        elif tag == "article":
            zone = 3
        elif tag == "main" or re.search(r"\brole\s*=\s*[\"']?main\b", attributes):
            zone = max(zone, 2)
        path = f"{here.path}/{tag}"
        stack.append(_Element(tag, path, zone))
        yield Token("<", path, "", zone, False)


def token_hash(token: Token) -> int:
    return xxh3_64_intdigest(token.key) - (1 << 63)


# --- occurrence vectors ---------------------------------------------------------------

VECTORS = "host string, token bigint, high bigint, low bigint, pages bigint, total bigint, place double"
#: The token that every page has once: its pages are the host's.
PAGE = 0


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*:(?://)?(?:[^/@?#]*@)?([^/:?#]+)", 1)
    return F.coalesce(F.lower(found), F.lit(""))


def vectors(pages: DataFrame) -> DataFrame:
    """Occurrence vectors of ``host, text`` (html) ``, page`` (a hash of the row)."""

    def flush(held):
        rows = [(*key, *value) for key, value in held.items()]
        kinds = [pa.string(), *[pa.int64()] * 5, pa.float64()]
        columns = zip(*rows, strict=True) if rows else ([] for _ in kinds)
        names = [f.split()[0] for f in VECTORS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    def run(batches):
        held: dict[tuple[str, int], list] = {}
        for batch in batches:
            hosts, pages_ = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i, host in enumerate(hosts):
                counts, places = Counter([PAGE]), {PAGE: 0}
                for place, token in enumerate(tokens(batch.column(1)[i].as_py() or "")):
                    if token.kind != "=" or not token.text.isspace():
                        key = token_hash(token)
                        counts[key] += 1
                        places.setdefault(key, place)
                for key, n in counts.items():
                    code = xxh3_64_intdigest(f"{pages_[i]}:{n}")
                    own = held.get((host, key))
                    if own is None:
                        held[host, key] = [code >> 32, code & 0xFFFFFFFF, 1, n, places[key]]
                    else:
                        own[0] += code >> 32
                        own[1] += code & 0xFFFFFFFF
                        own[2] += 1
                        own[3] += n
                        own[4] += places[key]
                if len(held) > HELD_TOKENS:
                    yield flush(held)
                    held = {}
        yield flush(held)

    parts = pages.select("host", "text", "page").mapInArrow(run, VECTORS)
    return parts.groupBy("host", "token").agg(
        *(F.sum(c).alias(c) for c in ("high", "low", "pages", "total", "place"))
    )


def templates(found: DataFrame) -> DataFrame:
    """``host``, ``rows`` (its pages) and ``classes``: of each class its pages, how
    often it occurs in all, and its tokens in their mean order."""
    hosts = found.where(F.col("token") == PAGE).select("host", F.col("pages").alias("rows"))
    enough = (F.col("pages") >= MIN_PAGES) & (F.col("token") != PAGE)
    often = found.where(enough).join(hosts, "host").where(F.col("pages") >= MIN_SHARE * F.col("rows"))
    classes = (
        often.groupBy("host", "rows", "high", "low", "pages", "total")
        .agg(F.sort_array(F.collect_list(F.struct((F.col("place") / F.col("pages")).alias("place"), "token"))).alias("own"))
        .where(F.size("own") >= MIN_CLASS)
    )
    one = F.struct("pages", "total", F.col("own.token").alias("tokens"))
    return classes.groupBy("host", "rows").agg(F.sort_array(F.collect_list(one)).alias("classes"))


class Template:
    """The classes of a host: which class and place each token has."""

    def __init__(self, rows: int, classes: list[dict]):
        self.place: dict[int, tuple[int, int]] = {}
        self.sizes, self.constant = [], []
        for i, own in enumerate(classes):
            self.sizes.append(len(own["tokens"]))
            self.constant.append(rows >= TEXT_PAGES and own["pages"] >= TEXT_SHARE * rows)
            self.place |= {token: (i, k) for k, token in enumerate(own["tokens"])}

    def valid(self, found: list[tuple[int, int] | None]) -> set[int]:
        """Of the classes on a page, those whose tokens come in order and that nest."""
        expected, seen, broken, open_ = {}, set(), set(), []
        for own in found:
            if own is None or own[0] in broken:
                continue
            i, place = own
            seen.add(i)
            if expected.get(i, 0) != place:
                broken.add(i)
                open_ = [o for o in open_ if o != i]
                continue
            expected[i] = (place + 1) % self.sizes[i]
            if place == 0:
                open_.append(i)
            if place == self.sizes[i] - 1:
                while open_ and open_[-1] != i:  # opened inside, not closed there
                    broken.add(open_.pop())
                if open_:
                    open_.pop()
        return seen - broken - set(open_)


NO_TEMPLATE = Template(0, [])


def main_text(page: str, template: Template = NO_TEMPLATE) -> str:
    """The slots of the article, one line a block."""
    found = list(tokens(page))
    places = [template.place.get(token_hash(t)) if template.place else None for t in found]
    valid = template.valid(places) if template.place else set()
    best = max((t.zone for t in found if t.kind == "=" and not t.text.isspace()), default=0)
    blocks: list[tuple[str, int, int]] = []
    parts: list[str] = []
    linked = 0

    def close():
        nonlocal linked
        line = " ".join("".join(map(html.unescape, parts)).split())
        if line:
            blocks.append((line, linked, sum(map(len, parts))))
        parts.clear()
        linked = 0

    for token, place in zip(found, places, strict=True):
        if token.kind in "<>":
            close()
        if token.zone != best or best == 0:
            continue
        if token.kind == "=":
            constant = place is not None and place[0] in valid and template.constant[place[0]]
            if not constant:
                parts.append(token.text)
                linked += len(token.text) if token.link else 0
        elif token.text:
            parts.append(token.text)
    close()
    if best == 1:  # no article to tell: lists of links are menus
        blocks = [b for b in blocks if 2 * b[1] <= b[2]]
    return "\n".join(line for line, _, _ in blocks)


def extract(pages: DataFrame, url: str = "url", text: str = "html") -> DataFrame:
    """``rest`` (all columns but the html), and the main ``text`` of every page."""
    rows = boxed(pages, text).select(
        host_of(F.col(f"rest.`{url}`").cast("string")).alias("host"),
        F.coalesce("text", F.lit("")).alias("text"),
        "rest",
    )
    keyed = rows.withColumn("page", F.xxhash64(F.col("rest").cast("string"), "text"))
    found = stage(templates(stage(vectors(keyed), "page-vectors")), "page-templates")
    size = found.agg(F.sum(F.aggregate("classes", F.lit(0), lambda n, c: n + F.size(c["tokens"])))).first()[0] or 0
    if size <= SENT_TOKENS:
        joined = keyed.join(F.broadcast(found.withColumnRenamed("host", "of")), F.col("host") == F.col("of"), "left")
    else:
        salt = F.pmod("page", F.lit(SALTS)).cast("int")
        salted = found.select(
            F.col("host").alias("of"), "rows", "classes", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("part")
        )
        same = (F.col("host") == F.col("of")) & (F.col("salt") == F.col("part"))
        joined = keyed.withColumn("salt", salt).join(salted, same, "left")
    kind = dict(keyed.dtypes)["rest"]

    def run(batches):
        known: dict[str, Template] = {}
        for batch in batches:
            col = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            out = []
            for i, host in enumerate(col["host"].to_pylist()):
                if host not in known:
                    if len(known) > 256:
                        known.clear()
                    rows = col["rows"][i].as_py()
                    known[host] = Template(rows, col["classes"][i].as_py()) if rows else NO_TEMPLATE
                out.append(main_text(col["text"][i].as_py(), known[host]))
            yield pa.RecordBatch.from_arrays([col["rest"], pa.array(out, pa.string())], names=["rest", "text"])

    return joined.select("host", "text", "rest", "rows", "classes").mapInArrow(run, f"rest {kind}, text string")
