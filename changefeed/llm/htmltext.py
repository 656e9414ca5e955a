"""Main-text extraction by equivalence-class template deduction.

A page is a sequence of tokens: each tag with its path of open elements, and
each text block with its path.  Tokens of one host that occur equally often
on the same pages have equal occurrence vectors and form a class.  A class
is valid if most of the pages that hold it hold its tokens in one order (as
often as they occur), wholly inside one slot of the class around it.  The valid classes,
nested into each other, are the host's template; its slots are what stands
between its tags.  The article is the slots inside one container element of the
template: the innermost that holds ``MAIN_SHARE`` of the host's varying text and
the heading of its pages (or the ``article`` or ``main`` element around it;
such an element inside it narrows it).

Fixed lists of element names, roles, classes and ids say which parts of a page are
never the article: menus, headers, footers, side bars, notices, adverts, forms, scripts and
reader comments; a part that has the article inside after all (a wrapper named
``with-sidebar``, a form round the page) does not count as one.  Where a page
has no template, or not the template's element, they decide with ``article`` and
``main`` alone, and the template's own texts are dropped outside the element with most text.

Scale: a page that may have a template is read twice; what is counted is its saved
sequence of token numbers.  An occurrence vector is kept as two sums of page hashes, so vectors of
a host with a third of all pages are added up map-side and never gathered.
Only tokens on at least ``MIN_SHARE`` of a host's pages can be template
tokens, so a host's template is bounded by the length of its pages, not
by their number.  Classes and templates are broadcast only if their counted size is
below a bound, and joined by host otherwise.

Defined results: null or empty html gives an empty text; a host with fewer
than ``MIN_PAGES`` pages has no deduced template and keeps the element rules
alone; pages without a host share the empty host; repeated rows and null
page_ids are returned each; copies of one page count as one page of the host;
a text inside ``article`` or ``main``, or in the element that holds most of
the page's other texts, is never dropped as the template's; unclosed, misnested or cut markup ends with the
page; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import html as _html
import re
from bisect import bisect
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefeed.llm.common import saved
from changefeed.llm.urlrules import host_of

#: Fewest pages of a host from which a template is deduced, and the share of
#: them that must hold a template token.
MIN_PAGES = 10
MIN_SHARE = 0.8
#: Template tokens broadcast at most (about 16 bytes each); more are joined.
BROADCAST_TOKENS = 500_000
#: Share of a host's varying text that its article element holds.
MAIN_SHARE = 0.9
#: Hosts whose classes a task keeps at hand.
HELD_HOSTS = 1_000
#: Counts a task gathers before it hands them on.
HELD_TOKENS = 100_000

# Names of HTML elements and usual names of page parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option "
    "p pre section select summary table tbody td tfoot th thead title tr ul".split())
CONTAINERS = frozenset("article body center div fieldset form html main section table tbody td tr".split())
ENDS_P = BLOCK - {"body", "head", "html", "title", "option", "optgroup", "legend", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
SKIP = frozenset("nav aside footer form button select menu dialog head object audio video canvas".split())
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar toolbar form".split())
_PARTS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|notification\w*|"
    r"popup|modal|overlay|newsletter|subscri\w+|sidebar|side-?bar|aside|menu|nav|navbar|navigation|breadcrumbs?|"
    r"comments?|disqus|respond|repl(?:y|ies)|share|sharing|social|related|recommend\w*|footer|header|masthead|"
    r"toolbar|pagination|pager|login|signup|widgets?|skip-link|copyright|disclaimer)(?:$|[\s_-])", re.I)
# Of these, parts that are never round the article (``comments-open`` tells a state).
_ANSWERS = re.compile(
    r"(?:^|\s)(?:comments?|disqus|respond|repl(?:y|ies)|related|recommend\w*)"
    r"(?:$|\s|[_-](?!(?:open|closed|enabled|on|status)(?:$|\s)))", re.I)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?(?=[\s/>]|\Z)", re.I)
_SPACES = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _part_of(name: str, attrs: str, inside_article: bool) -> str | None:
    """Whether an element is a page part that is not the article: ``hard`` by
    its name, role or being hidden, ``soft`` by a word in its class or id, or as
    a form, which some sites put round whole pages."""
    if name in SKIP:
        return "soft" if name == "form" else "hard"
    if name == "header":
        return None if inside_article else "hard"
    if not attrs or name in ("html", "body", "main"):
        return None
    soft = None
    for key, a, b, c in _ATTR.findall(attrs):
        key, value = key.lower(), a or b or c
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return "hard"
        if key == "style" and _HIDDEN.search(value) or key == "role" and value.lower() in SKIP_ROLES:
            return "hard"
        if key in ("class", "id") and _PARTS.search(value):
            if _ANSWERS.search(value):
                return "hard"
            soft = "soft"
    return soft


class Element(NamedTuple):
    """An open element.  Elements are numbered from 1 in page order."""

    name: str
    serial: int
    path: int  # a hash of the names of the open elements
    hard: bool  # it or one around it is a part for sure
    soft: int  # the nearest soft part, itself included
    article: int  # the outermost article or main element, itself included
    article_soft: int  # the nearest soft part at that element
    block: int  # place in the stack of the nearest block element, itself included; -1 none
    outer: int  # the nearest element around it but html and body


class Block(NamedTuple):
    """A text of the page: references decoded, white space made single."""

    text: str
    path: int
    hard: bool
    soft: int
    article: int
    article_soft: int
    serial: int  # of the block element it is in
    outer: int  # the element right around that


_TOP = Element("", 0, 0, False, 0, 0, 0, -1, 0)
# What the start of an element ends without an end tag, besides an open
# paragraph, and what it does not look beyond.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"},
         "tr": {"tr", "td", "th"}, "option": {"option"}}
_STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"tr", "table"}, "th": {"tr", "table"},
          "tr": {"table", "tbody", "thead", "tfoot"}}


class Page:
    """One pass over a page: ``tokens`` (a tag's path, or a block) in order;
    ``names`` of its elements; ``end`` and ``last``: for each closed element the
    tokens before its end and the last element inside it;
    ``soft_around``: for each soft part the soft part around it.  Time and
    memory grow with the length of the page, however deep it is nested."""

    def __init__(self, page: str):
        self.tokens: list[int | Block] = []
        self.names: list[str] = []  # of the elements, by number from 1
        self.end: dict[int, int] = {}  # for each closed element the tokens before its end
        self.last: dict[int, int] = {}
        self.soft_around: dict[int, int] = {}
        self.soft_depth: dict[int, int] = {0: 0}
        self.forms: set[int] = set()
        self._stack: list[Element] = []
        self._open: dict[str, int] = {}
        self._serial = 0
        self._buffer: list[str] = []
        self._read(page)

    def inside(self, serial: int, outer: int) -> bool:
        """Whether an element is strictly inside another."""
        return outer < serial <= self.last.get(outer, self._serial)

    def _cut(self, size: int) -> None:
        for e in self._stack[size:]:
            self.last[e.serial] = self._serial
            self.end[e.serial] = len(self.tokens)
            self._open[e.name] -= 1
        del self._stack[size:]

    def _block(self) -> None:
        if not self._buffer:
            return
        text = _SPACES.sub(" ", "".join(self._buffer)).strip()
        self._buffer.clear()
        if text:
            top = self._stack[-1] if self._stack else _TOP
            own = self._stack[top.block] if top.block >= 0 else _TOP
            self.tokens.append(Block(text, top.path, top.hard, top.soft, top.article, top.article_soft,
                                     own.serial, own.outer))

    def _end(self, name: str) -> None:
        """An end tag closes the nearest open element of its name, but none
        beyond the block it is in unless it is a block itself."""
        if not self._open.get(name):
            return
        for i in range(len(self._stack) - 1, -1, -1):
            if self._stack[i].name == name:
                return self._cut(i)
            if name not in BLOCK and self._stack[i].name in BLOCK:
                return None

    def _end_implied(self, name: str) -> None:
        ends, stops = _ENDS.get(name, set()) | {"p"}, _STOPS.get(name, ())
        cut = len(self._stack)
        for i in range(cut - 1, -1, -1):
            tag = self._stack[i].name
            if tag in ends:
                cut = i
                if name != "tr":
                    break
            elif tag in stops or tag in BLOCK:
                break
        self._cut(cut)

    def _start(self, name: str, attrs: str) -> None:
        top = self._stack[-1] if self._stack else _TOP
        self._serial += 1
        part = _part_of(name, attrs, top.article > 0)
        soft = top.soft
        if part == "soft":
            soft = self._serial
            self.soft_around[soft] = top.soft
            self.soft_depth[soft] = self.soft_depth[top.soft] + 1
            if name == "form":
                self.forms.add(soft)
        article, article_soft = top.article, top.article_soft
        if not article and name in ("article", "main"):
            article, article_soft = self._serial, soft
        path = _hash("tag", f"{top.path:x}/{name}")
        self.tokens.append(path)
        self.names.append(name)
        if name in VOID or attrs.endswith("/"):
            self.last[self._serial], self.end[self._serial] = self._serial, len(self.tokens)
        else:
            place = len(self._stack)
            outer = top.outer if top.name in ("html", "body") else top.serial
            self._stack.append(Element(name, self._serial, path, top.hard or part == "hard", soft, article, article_soft,
                                       place if name in BLOCK else top.block, outer))
            self._open[name] = self._open.get(name, 0) + 1

    def _read(self, page: str) -> None:
        at = 0
        while True:
            m = _TOKEN.search(page, at)
            raw = page[at:m.start() if m else None]
            if raw:
                self._buffer.append(_html.unescape(raw) if "&" in raw else raw)
            if m is None:
                break
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            closing, attrs = m[1] or m[4], (m[3] if m[2] else m[6]) or ""
            if name == "br":
                self._buffer.append(" ")
                continue
            if name in BLOCK:
                self._block()
            if closing:
                self._end(name)
                continue
            if name in RAW and not attrs.endswith("/"):
                end = _raw_end(name).search(page, at)
                at = end.end() if end else len(page)
                continue
            if name in ENDS_P or name in ("li", "dt", "dd", "tr", "td", "th", "option"):
                self._end_implied(name)
            self._start(name, attrs)
        self._block()

    def wrappers(self) -> frozenset[int]:
        """Soft parts that are round the article after all: where no article
        stands outside parts, those around the article element in fewest of
        them (of these, the one with most text), if it has more text than stands
        outside all parts; else, where nothing stands outside parts, a form."""
        outside = 0
        sizes: dict[tuple[int, int], int] = {}
        form = 0
        for b in self.tokens:
            if not isinstance(b, Block) or b.hard:
                continue
            if not b.soft:
                if b.article:
                    return frozenset()
                outside += len(b.text)
            elif b.article and b.soft == b.article_soft:
                key = (b.article, b.article_soft)
                sizes[key] = sizes.get(key, 0) + len(b.text)
            elif b.soft in self.forms:
                form = form or b.soft
        best = max(sizes, key=lambda k: (-self.soft_depth[k[1]], sizes[k]), default=None)
        if best is not None and sizes[best] > outside:
            soft = best[1]
        elif not outside and form:
            soft = form
        else:
            return frozenset()
        found = set()
        while soft:
            found.add(soft)
            soft = self.soft_around[soft]
        return frozenset(found)


@functools.cache
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I)


def _hash(kind: str, value: str) -> int:
    return xxhash.xxh64_intdigest(f"{kind}\x00{value}") >> 1


def _text_hash(text: str, path: int) -> int:
    return _hash("text", f"{path:x}\x00{text}")


# The lowest two bits of a token's number.
_TAG, _TEXT, _CONTAINER, _HEADING = range(4)


def _code(value: int, kind: int) -> int:
    return value & ~3 | kind


def page_tokens(page: str) -> tuple[list[int], list[int]]:
    """The numbers of a page's tokens in order, and with each text its length
    (0 in parts that are not the article), with each tag the place of its end."""
    parsed = Page(page)
    wrappers = parsed.wrappers()
    codes, extra, serial = [], [], 0
    for token in parsed.tokens:
        if isinstance(token, Block):
            codes.append(_code(_text_hash(token.text, token.path), _TEXT))
            extra.append(0 if token.hard or token.soft and token.soft not in wrappers else len(token.text))
        else:
            name = parsed.names[serial]
            serial += 1
            codes.append(_code(token, _HEADING if name in ("h1", "h2", "h3") else _CONTAINER if name in CONTAINERS else _TAG))
            extra.append(parsed.end.get(serial, len(parsed.tokens)))
    return codes, extra


def sequences(pages: DataFrame) -> DataFrame:
    """host, mark, tokens and extra (see ``page_tokens``) of every page."""
    def run(batches):
        for batch in batches:
            found = [page_tokens(raw.as_py() or "") for raw in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([t for t, _ in found], pa.list_(pa.int64())),
                 pa.array([e for _, e in found], pa.list_(pa.int32()))], names=["host", "mark", "tokens", "extra"])

    return pages.select("host", "mark", "html").mapInArrow(run, "host string, mark string, tokens array<long>, extra array<int>")


def _added_up(df: DataFrame, page_rows, keys: list[str], sums: list[str], *columns: str) -> DataFrame:
    """The sums of ``page_rows(host, *columns)``, which gives a page's (key, values),
    per host and key; a task adds up what it can hold."""
    types = {"host": "string"} | {c: "long" for c in keys + sums}

    def out(table):
        cols = list(zip(*((h, *key, *row) for (h, key), row in table.items()))) or [()] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "host" else pa.int64())
                                           for c, n in zip(cols, types)], names=list(types))

    def run(batches):
        table: dict[tuple, list[int]] = {}
        for batch in batches:
            for host, *cells in zip(batch.column(0).to_pylist(), *batch.columns[1:]):
                for key, values in page_rows(host, *cells):
                    row = table.get((host, key))
                    if row is None:
                        table[host, key] = list(values)
                    else:
                        for i, v in enumerate(values):
                            row[i] += v
                if len(table) > HELD_TOKENS:
                    yield out(table)
                    table.clear()
        yield out(table)

    return (df.select("host", *columns).mapInArrow(run, ", ".join(f"{c} {t}" for c, t in types.items()))
            .groupBy("host", *keys).agg(*(F.sum(c).alias(c) for c in sums)))


def _page_counts(host: str, mark, tokens):
    mark, found = mark.as_py(), {0: [1, 0]}
    for place, token in enumerate(tokens.as_py()):
        row = found.get(token)
        if row is None:
            found[token] = [1, place]
        else:
            row[0] += 1
    for token, (n, place) in found.items():
        d = xxhash.xxh64_intdigest(f"{mark}\x00{n}")
        yield (token,), (1, n, d & 0xFFFFFFFF, d >> 32, place)


def occurrences(read: DataFrame) -> DataFrame:
    """Per (host, token): pages, occurrences, the vector's two digests and the
    sum of first places; token 0 is on every page."""
    return _added_up(read, _page_counts, ["token"], ["pages", "occurs", "v1", "v2", "places"], "mark", "tokens")


def classes(read: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """Per host the classes of equal occurrence vectors: host, class_id,
    pages, occurs and members (tokens by their mean first place)."""
    seen = saved(occurrences(read).where(f"pages >= {min_pages}"), "occurrences")
    total = seen.where("token = 0").select("host", F.col("pages").alias("host_pages"))
    if total.count() <= BROADCAST_TOKENS:
        total = F.broadcast(total)  # a row a host
    often = seen.where("token <> 0").join(total, "host").where(F.col("pages") >= min_share * F.col("host_pages"))
    member = F.struct((F.col("places") / F.col("pages")).alias("place"), "token")
    found = often.groupBy("host", "v1", "v2", "pages", "occurs").agg(F.sort_array(F.collect_list(member)).alias("m"))
    # A class needs two tokens and a tag among them; one text alone repeats
    # for other reasons than a template.
    found = found.select("host", F.xxhash64("v1", "v2", "occurs").alias("class_id"), "pages", "occurs",
                         F.col("m.token").alias("members")).where(F.size("members") >= 2)
    return found.where(F.exists("members", lambda t: t.bitwiseAND(3) != _TEXT))


def nested(positions: dict[int, list[int]], pages: dict[int, int]) -> dict[int, tuple[int, int] | None]:
    """The class around each class of a page and the slot of it, (0, 0) for
    none; None if it crosses one.  Of two that cross, the one on fewer pages does."""
    out: dict[int, tuple[int, int] | None] = {}
    around: list[int] = []
    for c in sorted(positions, key=lambda c: (positions[c][0], -positions[c][-1])):
        mine = positions[c]
        out[c] = (0, 0)
        while around:
            top = around[-1]
            theirs = positions[top]
            slot = bisect(theirs, mine[0])
            if slot == len(theirs):  # it has ended
                around.pop()
            elif mine[-1] < theirs[slot]:
                out[c] = (top, slot)
                break
            elif pages[c] > pages[top]:
                out[top] = None
                around.pop()
            else:
                out[c] = None
                break
        if out[c] is not None:
            around.append(c)
    return out


def _page_fits():
    """What ``fits`` adds up, with the classes of the last hosts at hand."""
    hosts: dict[str, tuple] = {}

    def known(host, ids, pages, occurs, members):
        if host not in hosts:
            if len(hosts) >= HELD_HOSTS:
                hosts.clear()
            ids, pages, occurs, members = (x.as_py() for x in (ids, pages, occurs, members))
            single = {t for n, o, m in zip(pages, occurs, members) if n == o for t in m if t & 3 == _CONTAINER}
            hosts[host] = ({t: c for c, m in zip(ids, members) for t in m}, dict(zip(ids, members)), dict(zip(ids, pages)), single)
        return hosts[host]

    def rows(host, tokens, extra, ids, pages, occurs, members):
        class_of, members_of, pages_of, single = known(host, ids, pages, occurs, members)
        tokens, extra = tokens.as_py(), extra.as_py()
        positions: dict[int, list[int]] = {}
        varying = [0]  # length of the varying text before each place
        for place, token in enumerate(tokens):
            c = class_of.get(token)
            if c is not None:
                positions.setdefault(c, []).append(place)
            varying.append(varying[-1] + (extra[place] if token & 3 == _TEXT and c is None else 0))
        for c, slot in nested(positions, pages_of).items():
            want = members_of[c]
            ordered = len(positions[c]) % len(want) == 0 and all(
                tokens[p] == want[i % len(want)] for i, p in enumerate(positions[c]))
            yield (0, c, *(slot or (0, 0))), (1, int(ordered and slot is not None), 0, 0, 0)
        head = next((p for p, t in enumerate(tokens) if t & 3 == _HEADING and varying[extra[p]] > varying[p]), None)
        yield (1, 0, 0, 0), (1, 0, varying[-1], int(head is not None), 0)
        for place, token in enumerate(tokens):
            if token in single:
                end = extra[place]
                yield (1, token, 0, 0), (1, 0, varying[end] - varying[place], int(head is not None and place <= head < end), end - place)

    return rows


def fits(read: DataFrame, per_host: DataFrame) -> DataFrame:
    """How the classes fit the pages.  Rows of kind 0: a class (id), the class
    around it (parent) and its slot there, on how many pages, and on how many of them valid (good).
    Rows of kind 1: a container that stands once on a page (id; 0: whole
    pages), the length of the varying text inside (chars), on how many pages it
    holds the heading, and its tokens (span)."""
    def rows(*cells):
        if "f" not in state:  # once a task
            state["f"] = _page_fits()
        return state["f"](*cells)

    state: dict = {}
    joined = read.join(per_host, "host")
    return _added_up(joined, rows, ["kind", "id", "parent", "slot"], ["n", "good", "chars", "heads", "span"],
                     "tokens", "extra", "ids", "pages", "occurs", "members")


def _checked(df: DataFrame, size) -> DataFrame:
    """``df`` for a broadcast if its counted tokens are within the bound."""
    n = df.agg(F.sum(size), F.count(F.lit(1))).first()
    return F.broadcast(df) if (n[0] or 0) + n[1] <= BROADCAST_TOKENS else df


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """The valid classes of every host: host, class_id, parent (the class it is most often
    nested in, 0 for none), slot (its place there), members, and main: the
    token of the host's article element, null if it has none.

    ``pages`` has host, html and mark (anything that tells pages apart)."""
    read = saved(sequences(pages), "sequences")
    found = saved(classes(read, min_pages, min_share), "classes")
    per_host = found.groupBy("host").agg(F.collect_list(F.struct("class_id", "pages", "occurs", "members")).alias("c")).select(
        "host", F.col("c.class_id").alias("ids"), F.col("c.pages").alias("pages"), F.col("c.occurs").alias("occurs"),
        F.col("c.members").alias("members"))
    size = F.aggregate("members", F.lit(0), lambda n, m: n + F.size(m) + 3)
    seen = saved(fits(read, _checked(per_host, size)), "fits")
    place = F.struct("n", "parent", "slot")
    fit = (seen.where("kind = 0").groupBy("host", F.col("id").alias("class_id"))
           .agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.max(place).alias("p"))
           .where(F.col("good") >= min_share * F.col("n"))
           .select("host", "class_id", F.col("p.parent").alias("parent"), F.col("p.slot").alias("slot")))
    valid = saved(found.join(fit, ["host", "class_id"]), "valid")
    tag = seen.where("kind = 1")
    whole = tag.where("id = 0").select("host", F.col("chars").alias("all_chars"), F.col("heads").alias("all_heads"))
    whole = F.broadcast(whole) if whole.count() <= BROADCAST_TOKENS else whole
    inside = valid.where("pages = occurs").select("host", F.explode("members").alias("id"))
    main = (tag.join(inside, ["host", "id"]).join(whole, "host")
            .where((F.col("chars") > 0) & (F.col("chars") >= MAIN_SHARE * F.col("all_chars")) & (F.col("heads") >= min_share * F.col("all_heads")))
            .groupBy("host").agg(F.min_by("id", F.struct(F.col("span") / F.col("n"), "id")).alias("main")))
    return valid.join(main, "host", "left").select("host", "class_id", "parent", "slot", "members", "main")


def article(page: str, template_texts: frozenset[int] = frozenset(), main: int | None = None) -> str:
    """The blocks of a page's article, one per line; ``main`` is the token of
    the template's article element."""
    parsed = Page(page)
    wrappers = parsed.wrappers()
    blocks = [b for b in parsed.tokens
              if isinstance(b, Block) and not b.hard and (not b.soft or b.soft in wrappers)]
    if main is not None:
        tags = (t for t in parsed.tokens if not isinstance(t, Block))
        at = next((n for n, t in enumerate(tags, 1) if t & ~3 == main & ~3), 0)
        found = [b for b in blocks if b.serial == at or parsed.inside(b.serial, at)] if at else []
        around = next((b.article for b in found if 0 < b.article < at), 0)
        if around:
            found = [b for b in blocks if b.article == around]
        if found:
            return "\n".join([b.text for b in found if b.article] or [b.text for b in found])
    named = [b.text for b in blocks if b.article]
    if named:
        return "\n".join(named)
    fixed = [bool(template_texts) and _code(_text_hash(b.text, b.path), _TEXT) in template_texts for b in blocks]
    # No such element: the one right around the blocks with most of what varies.
    sizes: dict[int, int] = {}
    for b, own in zip(blocks, fixed):
        if not own and b.outer:
            sizes[b.outer] = sizes.get(b.outer, 0) + len(b.text)
    slot = max(sizes, key=sizes.get, default=0)
    return "\n".join(b.text for b, own in zip(blocks, fixed) if not own or slot and parsed.inside(b.serial, slot))


def distinct_pages(pages: DataFrame) -> DataFrame:
    """host, html and mark of each page content of a host, copies once.  Only
    pages that have copies are moved, added up map-side."""
    keyed = pages.select("host", "html", F.md5(F.coalesce("html", F.lit(""))).alias("mark"))
    copied = saved(keyed.groupBy("host", "mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("host", "mark"), "copied")
    if copied.count() * 4 <= BROADCAST_TOKENS:
        copied = F.broadcast(copied)
    once = keyed.join(copied, ["host", "mark"], "left_anti").select("host", "html", "mark")
    first = keyed.join(copied, ["host", "mark"], "left_semi").groupBy("host", "mark").agg(F.first("html").alias("html"))
    return once.unionByName(first)


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """page_id, url and text of every page."""
    url = F.col("url").cast("string")
    rows = pages.select("page_id", url.alias("url"), F.col("html").cast("string").alias("html"),
                        F.coalesce(host_of(url), F.lit("")).alias("host"))
    # Hosts with fewer rows than that have no template.
    hosts = saved(rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where(f"n >= {min_pages}").select("host"), "hosts")
    many = rows.join(F.broadcast(hosts), "host", "left_semi") if hosts.count() <= BROADCAST_TOKENS else rows
    found = saved(templates(distinct_pages(many), min_pages, min_share), "templates")
    texts = F.filter(F.flatten(F.collect_list("members")), lambda t: t.bitwiseAND(3) == _TEXT)
    per_host = found.groupBy("host").agg(texts.alias("template_texts"), F.max("main").alias("main"))
    per_host = _checked(per_host, F.size("template_texts"))
    joined = rows.join(per_host, "host", "left").select("page_id", "url", "html", "template_texts", "main")
    id_type = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = [article(raw.as_py() or "", frozenset(t.as_py() or ()), m.as_py())
                   for raw, t, m in zip(*batch.columns[2:5])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())],
                                             names=["page_id", "url", "text"])

    return joined.mapInArrow(run, f"page_id {id_type}, url string, text string")
