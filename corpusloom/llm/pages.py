"""Operator 3: main text of web pages by template deduction over the pages of a host.

A page is cut into tokens: the elements with their path from the root, and the text blocks with
path and wording.  Per host, each token has an occurrence vector, its count in every page; two
128-bit sums over (page, count) stand for it, so vectors are compared without ever being gathered,
whatever the size of a host.  Tokens of one vector form an equivalence class.  Valid classes are
those found in at least half of the host's pages, for texts in two of them at least.  A text block of a valid class is template text if
an element around it is of the same class, so that neither comes without the other; where blocks of
its path also hold text that varies, only if it comes before the first or after the last varying
block of the page's content.  A page of which nothing varies keeps its text.  The order of the
tokens within a class is not compared.

The content is what lies below the template's ``article`` or ``main`` elements, else below the
elements with the most text that is not linked; menus, headers, footers, sidebars, notices, adverts,
forms and comments in there do not count, by element or by class and id, except for the header of a
content element.  A compound name counts if all of it says so (``site-header``, not ``has-sidebar``);
below the content one piece of it is enough for adverts and comments (``comment-body``, ``adSlot``), and
for shared links and notices that are linked or come last (``related-posts``).  A form, or a name, does not rule out what holds the only content elements or most
of the unlinked text.

Character references are decoded, white space within a block becomes one space (a line break
element is white space), blocks are joined by a line break in page order.

A null or empty page, and a page without content, has an empty text.  A null or unusable address
is a host of its own.  A host with one page has that page as its template.  Repeated rows give
repeated results.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import bounded, stored

# Template tables of up to so many hosts are broadcast; more are joined by host and a salt.
BROADCAST_HOSTS = 50_000
SALTS = 32

# Elements that do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset(
    "aside audio button canvas dialog fieldset footer form head header iframe math menu nav noscript object option "
    "script select style svg template textarea title video".split()
)
HINTS = frozenset(
    "ad ads adsbygoogle advert advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "cookie cookies consent disqus_thread disclaimer footer header login masthead menu modal nav navbar navigation "
    "newsletter notice pagination popup promo promotion related search share sharing sidebar social sponsor sponsored "
    "subscribe toolbar topbar widget".split()
)
# Pieces of compound names that say where something is, not what.
PLACES = frozenset(
    "area bar block bottom box bottombar container fixed global inner left list main outer primary right row secondary "
    "section site sticky top wrap wrapper".split()
)
# Pieces of compound names below the content: adverts and comments wherever they stand, the rest if
# linked or after the text.
APART = frozenset(
    "ad ads adsbygoogle advert advertisement advertising comment comments commentlist newsletter sponsor sponsored".split()
)
AFTER = frozenset(
    "breadcrumb breadcrumbs cookie cookies pagination promo promotion related share sharing social subscribe".split()
)
NEGATIONS = frozenset("has have hide no non not open with without".split())
CONTENT = frozenset(["article", "main"])
PARTS = frozenset("blockquote dd dl dt figcaption figure h1 h2 h3 h4 h5 h6 li ol p pre table tbody thead tr ul".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu "
    "nav ol p pre section table ul".split()
)
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}

# Elements whose content is no markup.
RAW = frozenset("script style textarea title noscript iframe".split())
# Elements nested deeper than this count as siblings, as browsers have it.
DEPTH = 512
NAME_CHARS = 256

_RAW_OPEN = re.compile(rf"<({'|'.join(sorted(RAW))})\b", re.I)
_RAW_CLOSE = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
_TAG_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile("[>\"']")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_BLANKS = re.compile(r"\s+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


def tokens_of(page: str) -> Iterator[tuple[str, str, bool, str]]:
    """``(kind, text or tag, closing, attributes)`` in page order; kinds are text, raw and tag.

    Time is linear in the page, whatever its markup.  A tag ends at the first ``>`` outside
    attribute values in quotes, or at the first one at all if a quote stays open.
    """
    at, size, last = 0, len(page), page.rfind(">")
    open_quotes: set[int] = set()  # quotes from which no end of a tag is found

    def end_of_tag(start: int) -> int:
        seen, here = [], start
        while here <= last:
            stop = _STOP.search(page, here).start()
            if page[stop] == ">":
                return stop
            here = stop + 1
            if not page[max(start, stop - 64) : stop].rstrip().endswith("="):
                continue  # not the quote of a value
            seen.append(stop)
            close = -1 if stop in open_quotes else page.find(page[stop], here)
            if close < 0:
                break
            here = close + 1
        open_quotes.update(seen)
        return page.find(">", start)

    while at < size:
        if page[at] != "<":
            end = page.find("<", at)
            end = size if end < 0 else end
            yield "text", page[at:end], False, ""
            at = end
            continue
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = size if end < 0 else end + 3
            continue
        if at < last:
            raw = _RAW_OPEN.match(page, at)
            if raw:
                tag = raw.group(1).lower()
                closed = _RAW_CLOSE[tag].search(page, page.find(">", at) + 1)
                yield "raw", tag, False, ""
                at = closed.end() if closed else size
                continue
            tag = _TAG_OPEN.match(page, at)
            if tag:
                end = end_of_tag(tag.end())
                yield "tag", tag.group(2).lower(), bool(tag.group(1)), page[tag.end() : end]
                at = end + 1
                continue
            if page[at + 1] in "!?":
                at = page.find(">", at) + 1
                continue
        yield "text", "<", False, ""
        at += 1


def _element(tag: str, attributes: str) -> str:
    """A tag with its classes, id and role; long lists of names by their digest and what they say."""
    found = {h for names in _NAMES.findall(attributes) for h in _HUMP.sub("-", "".join(names)).lower().split()}
    hints = [h.replace("/", "-") for h in sorted(found)]
    if sum(map(len, hints)) > NAME_CHARS:
        digest = hashlib.blake2b(" ".join(hints).encode(), digest_size=8).hexdigest()
        hints = [*(h for h in hints if h in HINTS or h == "main"), digest]
    return ".".join([tag, *hints])


def blocks_of(page: str) -> tuple[list[tuple[str, str, int]], Counter]:
    """Text blocks (path, text, linked characters) in page order, and the element paths with counts."""
    stack: list[str] = []
    paths: list[str] = [""]
    held: Counter = Counter()
    blocks: list[tuple[str, str, int]] = []
    elements: Counter = Counter()
    words: list[str] = []
    linked = in_link = 0

    def close_block() -> None:
        nonlocal linked
        if words:
            text = _BLANKS.sub(" ", entities.unescape("".join(words))).strip()
            if text:
                blocks.append((paths[-1], text, linked))
            words.clear()
        linked = 0

    def pop_to(tag: str) -> None:
        while stack:
            paths.pop()
            last = stack.pop()
            held[last] -= 1
            if last == tag:
                return

    def below(element: str) -> str:
        return paths[-1] if len(stack) >= DEPTH else f"{paths[-1]}/{element}" if paths[-1] else element

    for kind, tag, closing, attributes in tokens_of(page):
        if kind == "text":
            words.append(tag)
            if in_link:
                linked += len(tag.strip())
            continue
        if kind == "raw":
            elements[below(tag)] += 1
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                words.append(" ")
            if tag == "hr":
                close_block()
            continue
        close_block()
        in_link = 0
        if closing:
            if held[tag] > 0:
                pop_to(tag)
            continue
        if tag in CLOSES_P and stack and stack[-1] == "p":
            pop_to("p")
        while stack and stack[-1] in SIBLINGS.get(tag, ()):
            pop_to(stack[-1])
        if attributes.rstrip().endswith("/"):
            continue
        path = below(_element(tag, attributes))
        stack.append(tag)
        held[tag] += 1
        paths.append(path)
        elements[path] += 1
    close_block()
    return blocks, elements


def _parts(element: str) -> tuple[str, set[str]]:
    tag, *hints = element.split(".")
    return tag, set(hints)


def _hinted(name: str) -> bool:
    """Whether a class, id or role says boilerplate: itself, or every piece of it but for places."""
    if name in HINTS:
        return True
    pieces = set(re.split(r"[-_]+", name)) - {""}
    return bool(pieces & HINTS) and pieces <= HINTS | PLACES


def is_content(element: str) -> bool:
    tag, hints = _parts(element)
    return tag in CONTENT or "main" in hints


def is_boilerplate(path: str) -> bool:
    """Whether the path leads through an element that never holds content."""
    return any(_ruled_out(element, False) for element in path.split("/"))


def _ruled_out(element: str, inside: bool) -> bool:
    """Whether an element holds no content; ``inside`` a content element, a header is its title."""
    tag, hints = _parts(element)
    if inside:
        hints = hints - {"header"}
    if tag in BOILERPLATE:
        return not (inside and tag == "header")
    return tag not in ("html", "body", "article", "main") and any(map(_hinted, hints))


def _openable(element: str) -> bool:
    """Whether an element is ruled out by its names or as a form only, so that its content may say otherwise."""
    return _parts(element)[0] == "form" or _parts(element)[0] not in BOILERPLATE and _ruled_out(element, False)


def _closed(path: str) -> bool:
    """Whether the path is boilerplate even if forms and names count for nothing."""
    return any(_ruled_out(element, False) and not _openable(element) for element in path.split("/"))


def _prefixes(path: str) -> list[str]:
    pieces = path.split("/")
    return ["/".join(pieces[:depth]) for depth in range(1, len(pieces) + 1)]


def containers_of(elements: dict[str, tuple[int, int]]) -> list[str]:
    """The content elements among template paths with their (characters, linked characters).

    Outermost ``article`` or ``main`` elements outside boilerplate, else those in forms and elements
    that only their names rule out; where there is none, the deepest element, no paragraph, heading or list, that holds most of the
    unlinked text outside boilerplate, and forms and named elements that hold most of the page's.
    """
    open_paths = [path for path in elements if not is_boilerplate(path)]
    passable = [path for path in elements if not _closed(path)]
    for paths in (open_paths, passable):
        named = [path for path in paths if is_content(path.rsplit("/", 1)[-1])]
        articles = [path for path in named if _parts(path.rsplit("/", 1)[-1])[0] == "article"]
        named = articles or named
        if named:
            return sorted(p for p in named if not any(p != q and p.startswith(q + "/") for q in named))
    whole: dict[str, int] = defaultdict(int)
    for path in passable:
        for above in _prefixes(path):
            whole[above] += max(0, elements[path][0] - 2 * elements[path][1])
    total = max(whole.values(), default=0)
    # A path counts if every element that rules it out holds most of the text.
    plain: dict[str, int] = defaultdict(int)
    opened: set[str] = set()
    for path in passable:
        out = [above for above in _prefixes(path) if _ruled_out(above.rsplit("/", 1)[-1], False)]
        if all(2 * whole[above] > total for above in out):
            opened.update(out)
            for above in _prefixes(path):
                plain[above] += max(0, elements[path][0] - 2 * elements[path][1])
    most = max(plain.values(), default=0)
    rich = [path for path, chars in plain.items() if chars >= 0.9 * most and chars]
    if not rich:
        return []
    # A paragraph, heading or list is a part of what is around it.
    whole_parts = [path for path in rich if _parts(path.rsplit("/", 1)[-1])[0] not in PARTS]
    best = max(whole_parts or rich, key=lambda p: (p.count("/"), p))
    return [best, *sorted(path for path in opened if path.startswith(best + "/"))]


def main_text(page: str | None, containers: list[str], constants: frozenset, edges: frozenset = frozenset()) -> str:
    """The content of one page under the template of its host.

    ``constants`` are template text; ``edges`` are too, but for those inside the slot of the varying text.
    """
    if not page:
        return ""
    blocks, elements = blocks_of(page)
    inside = _inside(blocks, containers)
    if not inside:
        own: dict[str, tuple[int, int]] = {path: (0, 0) for path in elements}
        for path, text, linked in blocks:
            chars = own.get(path, (0, 0))
            own[path] = (chars[0] + len(text), chars[1] + linked)
        inside = _inside(blocks, containers_of(own))
    marks = [token_mark(path, text) for path, text in inside] if constants or edges else []
    varying = [at for at, mark in enumerate(marks) if mark not in constants and mark not in edges]
    if not varying:
        return "\n".join(text for _, text in inside)
    # Of the slot's own kind of block, shared text between the first and the last varying block is content.
    kept = [inside[at][1] for at, mark in enumerate(marks)
            if mark not in constants and (mark not in edges or varying[0] < at < varying[-1])]
    return "\n".join(kept)


def _named(element: str, pieces_of: frozenset) -> bool:
    """Whether a piece of a compound name of the element is one of ``pieces_of``; not ``has-comments`` and the like."""
    tag, hints = _parts(element)
    if tag in ("html", "body", "h1", "h2", "h3", "h4", "h5", "h6"):
        return False
    cut = [set(re.split(r"[-_]+", hint)) for hint in hints]
    return any(pieces & pieces_of and not pieces & NEGATIONS for pieces in cut)


def _inside(blocks: list[tuple[str, str, int]], containers: list[str]) -> list[tuple[str, str]]:
    """Blocks of the containers, without boilerplate below them.

    Below a container a compound name counts too if one piece of it says adverts or comments, and if
    one says links or notices whose text is mostly linked, or comes after all other text.  No such
    name rules out what holds most of the text.
    """
    heads = {c: is_content(c.rsplit("/", 1)[-1]) for c in containers}

    def held(path: str) -> tuple[str, list[str]] | None:
        """The container of a path and the elements from there to it."""
        for c, content in heads.items():
            if path == c:
                return c, []
            if path.startswith(c + "/"):
                below = path[len(c) + 1 :].split("/")
                content_from = 0 if content else next((at for at, e in enumerate(below) if is_content(e)), len(below))
                if not any(_ruled_out(e, at >= content_from) for at, e in enumerate(below)):
                    return c, below
        return None

    known = {path: held(path) for path in {path for path, _, _ in blocks}} if containers else {}
    inside = [block for block in blocks if known.get(block[0])]
    # The outermost element of each kind of name around a path, as its own path.
    apart, after = ({path: _first(*known[path], pieces) for path in {block[0] for block in inside}} for pieces in (APART, AFTER))
    total = sum(len(text) for _, text, _ in inside)
    for around, anywhere in ((apart, True), (after, False)):
        shares: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0])
        other = -1
        for at, (path, text, linked) in enumerate(inside):
            name = around[path]
            if name is None:
                other = at
                continue
            share = shares[name]
            share[0] += len(text)
            share[1] += linked
            share[2] = at
        gone = {name for name, (chars, linked, end) in shares.items()
                if 2 * chars <= total and (anywhere or 2 * linked >= chars or end > other)}
        inside = [block for block in inside if around[block[0]] not in gone]
    return [(path, text) for path, text, _ in inside]


def _first(container: str, below: list[str], pieces_of: frozenset) -> str | None:
    at = next((at for at, element in enumerate(below) if _named(element, pieces_of)), None)
    return None if at is None else "/".join([container, *below[: at + 1]])


def token_mark(path: str, text: str) -> int:
    """A number for a text block token."""
    return int.from_bytes(hashlib.blake2b(f"{path}\n{text}".encode(), digest_size=8).digest(), "little", signed=True)


_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract("url", _HOST, 1))
    return pages.withColumn("host", F.coalesce(host, F.lit("")))


TOKENS = "host string, path string, mark long, pages long, total long, low long, high long, chars long, linked long"


def token_sums(pages: DataFrame) -> DataFrame:
    """Per host and token the sums that stand for its occurrence vector."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict = defaultdict(lambda: [0] * 6)
            for number, host, page in zip(*(batch.column(c) for c in ("page_id", "host", "html"))):
                blocks, elements = blocks_of(page.as_py() or "")
                tokens: Counter = Counter({(path, 0): n for path, n in elements.items()})
                share: dict = defaultdict(lambda: [0, 0])
                for path, text, linked in blocks:
                    tokens[path, token_mark(path, text)] += 1
                    share[path][0] += len(text)
                    share[path][1] += linked
                tokens["", 0] = 1  # the page itself
                for (path, mark), n in tokens.items():
                    code = hashlib.blake2b(f"{number.as_py()} {n}".encode(), digest_size=8).digest()
                    row = sums[host.as_py(), path, mark]
                    chars, linked = share.get(path, (0, 0)) if not mark else (0, 0)
                    for at, value in enumerate((1, n, int.from_bytes(code[:4], "little"),
                                                int.from_bytes(code[4:], "little"), chars, linked)):
                        row[at] += value
            keys = list(sums)
            columns = [pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]),
                       pa.array([k[2] for k in keys], pa.int64())]
            columns += [pa.array([sums[k][at] for k in keys], pa.int64()) for at in range(6)]
            names = ["host", "path", "mark", "pages", "total", "low", "high", "chars", "linked"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = with_host(pages).select("page_id", "host", "html").mapInArrow(summed, TOKENS)
    values = ["pages", "total", "low", "high", "chars", "linked"]
    return rows.groupBy("host", "path", "mark").agg(*[F.sum(v).alias(v) for v in values])


def templates(pages: DataFrame) -> DataFrame:
    """(host, elements, texts): the tokens of the valid classes of each host, with their vectors.

    ``elements`` are element paths with the characters of their text, ``texts`` are text tokens;
    ``slot`` says that blocks of the same path hold text that varies.
    """
    tokens = stored(token_sums(pages), "tokens")
    whole = tokens.where("path = '' AND mark = 0").select("host", F.col("pages").alias("n"))
    rows = tokens.where("path != ''").join(whole, "host")
    common = 2 * F.col("pages") >= F.col("n")
    shared = (F.col("mark") != 0) & common & (F.col("pages") > 1)
    varying = rows.where((F.col("mark") != 0) & ~shared).select("host", "path").distinct().withColumn("slot", F.lit(True))
    valid = rows.where(common).join(varying, ["host", "path"], "left")
    return valid.groupBy("host").agg(
        F.collect_list(F.when(F.col("mark") == 0, F.struct("path", "chars", "linked", "low", "high"))).alias("elements"),
        F.collect_list(F.when(shared, F.struct("path", "mark", "low", "high", F.coalesce("slot", F.lit(False)).alias("slot")))
                       ).alias("texts"),
    )


def template_text(elements: dict[str, tuple[int, int]], texts: list[dict]) -> tuple[list[int], list[int]]:
    """Of the ``texts`` those that are template text, and those that are outside a slot of their path only.

    A text token is template text if an element around it is of its class, that is, has its
    occurrence vector: then the element never comes without the text, nor the text without it.
    ``elements`` has the vector of each element path.
    """
    constants, edges = [], []
    for one in texts:
        pieces = one["path"].split("/")
        around = ("/".join(pieces[:depth]) for depth in range(1, len(pieces) + 1))
        if any(elements.get(path) == (one["low"], one["high"]) for path in around):
            (edges if one["slot"] else constants).append(one["mark"])
    return constants, edges


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    found = stored(templates(pages), "templates")

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots, constants, edges = [], [], []
            for elements, texts in zip(batch.column("elements").to_pylist(), batch.column("texts").to_pylist()):
                slots.append(containers_of({one["path"]: (one["chars"], one["linked"]) for one in elements}))
                vectors = {one["path"]: (one["low"], one["high"]) for one in elements}
                always, outside = template_text(vectors, texts)
                constants.append(always)
                edges.append(outside)
            marks = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), pa.array(slots, pa.list_(pa.string())), pa.array(constants, marks), pa.array(edges, marks)],
                names=["_host", "containers", "constants", "edges"],
            )

    slots = stored(found.mapInArrow(
        chosen, "_host string, containers array<string>, constants array<long>, edges array<long>"), "slots")
    rows = with_host(pages.select(F.col("page_id"), "url", "html"))
    if bounded(slots, BROADCAST_HOSTS):
        joined = rows.join(F.broadcast(slots), rows["host"] == slots["_host"], "left")
    else:
        salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
        spread = slots.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("salt", salt)
        joined = rows.join(spread, (rows["host"] == spread["_host"]) & (rows["salt"] == spread["_salt"]), "left")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(page.as_py(), containers.as_py() or [], frozenset(constants.as_py() or ()), frozenset(edges.as_py() or ()))
                for page, containers, constants, edges in zip(
                    *(batch.column(c) for c in ("html", "containers", "constants", "edges")))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(text) for text in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    schema = "page_id long, url string, text string, n_chars long"
    picked = joined.select(F.col("page_id").cast("long"), "url", "html", "containers", "constants", "edges")
    return picked.mapInArrow(extracted, schema)
