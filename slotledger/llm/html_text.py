"""Main text of web pages: site templates are found by counting element subtrees per host.

Each element subtree of a page is hashed: its tag, its attributes, its text and its children. A subtree that stands on many
different pages of a host is part of the host's template and is deleted; so are parts that say what they are (navigation,
footers, forms, adverts, comments and the like) on any page. Many means half of the host's pages or, for a whole block outside
any article, a number of different surroundings that does not grow with the host: copies of an article repeat its
paragraphs too, but beside each other. Of what is left, text outside article or main goes only if these hold half of its words.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger.llm.common import dealt_anew, stored

#: A subtree is template if it stands on at least so many different pages of its host, and on so large a part of them.
MIN_PAGES = 5
MIN_SHARE = 0.5
#: A block outside any article is template, however large the host, if it stands between so many different neighbours.
MIN_SURROUNDINGS = 8
#: A template table of at most so many subtrees is broadcast; a larger one meets the subtrees of every page in a join.
BROADCAST_SUBTREES = 200_000

# fixed values: element names of the HTML standard, and words by which sites name parts that are not the article
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|title|iframe|svg|math|select|object|canvas|video|audio"
SKIP = frozenset("nav footer aside form button menu dialog head script style noscript template textarea title iframe svg math select object canvas video audio".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Blocks that are pieces of another one and mean little by themselves.
PIECES = frozenset("body caption dd dt h1 h2 h3 h4 h5 h6 li main article tbody td tfoot th thead tr".split())
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
PART = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs cmt cmts comment comments consent cookie cookies disqus "
    "footer header masthead menu nav navbar navigation newsletter notice notices pagination popup modal promo promotion related replies reply "
    "share sharing sidebar skip social sponsor sponsored subscribe toolbar widget".split()
)
#: Words for a thing that holds others: what it is, the word before says.
HOLDERS = frozenset("area bar block body box buttons container content group inner item items links list panel row section slot text thread title unit wrap wrapper".split())
#: Parts that a page and an article may both have, and words for an article; the article's own stay.
OWN = frozenset("header footer".split())
ARTICLE = frozenset("article entry post story".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
ROWS = frozenset("tr tbody thead tfoot".split())
#: An end tag closes nothing outside the innermost of these, but for those that reach over them.
WALLS = frozenset("article main body table td th".split())
REACHING = frozenset("html body article main table div section".split())
# what closes an open p
SHUTS_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "summary"}

_NAME = re.compile(r"[a-z][\w:-]*", re.I)
_RAW = re.compile(rf"({RAW})\b", re.I)
_MARK = re.compile("[>\"']")
_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW.split("|")}


def tokens(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, kind, name, rest) of the markup of a page: comments and the like (`skip`), `raw` elements with what they
    hold, `end` tags, and start tags (`tag`) with their attributes. A `<` that begins none of these is text.

    Whatever is left open, no stretch is searched again and again: where no `>` follows there is no further tag, an element that
    holds raw text and is not closed goes on to the end, and quotes that were followed in vain are remembered.
    """
    at, size = 0, len(page)
    vain: set[int] = set()  # quotes outside of quotes from which no end of a tag is found
    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = size if end < 0 else end + 3
            yield at, end, "skip", "", ""
            at = end
            continue
        close = page.find(">", at)
        if close < 0:  # only a comment can follow
            at = page.find("<!--", at)
            if at >= 0:
                yield at, size, "skip", "", ""
            return
        if raw := _RAW.match(page, at + 1):
            found = _ENDS[raw[1].lower()].search(page, close + 1)
            yield at, found.end() if found else size, "raw", raw[1].lower(), page[close + 1 : found.start() if found else size]
            at = found.end() if found else size
            continue
        if page[at + 1 : at + 2] in ("!", "?"):
            yield at, close + 1, "skip", "", ""
            at = close + 1
            continue
        ending = page.startswith("/", at + 1)
        name = _NAME.match(page, at + 1 + ending)
        if not name:
            at += 1
            continue
        if ending:
            yield at, close + 1, "end", name[0].lower(), ""
            at = close + 1
            continue
        end = _tag_end(page, name.end(), vain)
        end = close if end < 0 else end
        yield at, end + 1, "tag", name[0].lower(), page[name.end() : end]
        at = end + 1


def _tag_end(page: str, at: int, vain: set[int]) -> int:
    """The place of the `>` that ends a tag, those in quotes passed over; -1 if a quote stays open or none follows."""
    tried: list[int] = []
    while mark := _MARK.search(page, at):
        if mark[0] == ">":
            return mark.start()
        if mark.start() in vain:
            break
        tried.append(mark.start())
        other = page.find(mark[0], mark.end())
        if other < 0:
            break
        at = other + 1
    vain.update(tried)
    return -1


_NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


def _is_part(tag: str, attrs: str, in_article: bool) -> bool:
    """Whether an element says of itself that it is no part of the article."""
    if tag in SKIP or (tag == "header" and not in_article):
        return True
    if not attrs:
        return False
    for name, a, b, c in _NAMED.findall(attrs):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in ROLES):
            return True
        if name in ("class", "id") and tag not in ("html", "body", "article", "main") and any(_names_part(x, in_article) for x in value.split()):
            return True
    return False


def _names_part(name: str, in_article: bool) -> bool:
    """Whether a class or id names a part that is not the article: by its last word, or the word before those for a holder.

    `comment-list` is one of comments; `share-price` is a price, and `notice-board` a board.
    """
    words = [w for w in re.split(r"[^a-z]+", name) if w]
    while len(words) > 1 and words[-1] in HOLDERS:
        words.pop()
    own = words and words[-1] in OWN and (in_article or not ARTICLE.isdisjoint(words))
    return bool(words) and words[-1] in PART and not own


def _number(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def parse(page: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, int, int | None]]]:
    """(segments, subtrees) of a page.

    A segment is (block, zone, text) of text that no part has marked as foreign; zone has bit 2 in an article, bit 1 in main.
    A subtree is (hash, first segment, end, surroundings): what an element holds, foreign text included in the hash, and for
    a whole block outside any article a hash of what stands before and after it; an only child has its parent's.
    """
    segments: list[tuple[int, int, str]] = []
    found: list[tuple[int, int, int, bool]] = []
    around: dict[int, int] = {}
    above: dict[int, int] = {}
    # open elements: tag, parts of the hash, first segment, foreign, zone, places of child elements in the parts
    stack: list[tuple[str, list[str], int, bool, int, list[tuple[int, int]]]] = [("", [], 0, False, 0, [])]
    # where elements of each name, blocks, blocks other than parts of tables, and what end tags do not reach over are open
    opened: dict[str, list[int]] = {}
    blocks, firm, walls = [0], [0], [0]
    block = 0
    at = 0

    def enter(tag: str, place: int) -> None:
        opened.setdefault(tag, []).append(place)
        if tag in BLOCKS:
            blocks.append(place)
            if tag not in ROWS:
                firm.append(place)
        if tag in WALLS:
            walls.append(place)

    def close() -> None:
        tag, parts, first, _, zone, kids = stack.pop()
        opened[tag].pop()
        for places in (blocks, firm, walls):
            if places[-1] == len(stack):
                places.pop()
        value = xxhash.xxh3_64_intdigest("\x00".join(parts))
        if len(parts) > 2 or parts[1:] != [""]:
            surround(parts[2:], [(k - 2, n) for k, n in kids], len(found))
            stack[-1][5].append((len(stack[-1][1]), len(found)))
            found.append((value - (1 << 63), first, len(segments), tag in BLOCKS and tag not in PIECES and not zone & 2))
        stack[-1][1].append(f"\x01{value}")

    def surround(parts: list[str], kids: list[tuple[int, int]], parent: int) -> None:
        for k, n in kids:
            if len(parts) == 1:
                above[n] = parent
            else:
                around[n] = _number("\x00".join((parts[k - 1] if k else "", *parts[k + 1 : k + 2])))

    def text(data: str) -> None:
        if not data:
            return
        _, parts, _, foreign, zone, _ = stack[-1]
        if "&" in data:
            data = entities.unescape(data)
        line = " ".join(data.split())
        if line:
            parts.append(line)
        if not foreign:
            segments.append((block, zone, data))

    for start, end, kind, tag, rest in tokens(page):
        text(page[at:start])
        at = end
        if kind == "tag":
            attrs = rest.strip()
            if tag in BLOCKS:
                block += 1
            shuts = CLOSES.get(tag)
            ended = [*(shuts or ()), *(("p",) if tag in SHUTS_P else ())]
            last = max((opened[x][-1] for x in ended if opened.get(x)), default=0)
            if last and last >= (firm if shuts else blocks)[-1]:
                while len(stack) > last:
                    close()
            foreign, zone = stack[-1][3], stack[-1][4]
            if tag in VOID or attrs.endswith("/"):
                stack[-1][1].append(f"\x02{tag}")
                if tag in ("br", "hr", "wbr") and not foreign and tag != "wbr":
                    segments.append((block, zone, " "))
                continue
            zone |= {"article": 2, "main": 1}.get(tag, 0)
            foreign = foreign or _is_part(tag, attrs, zone & 2 > 0)
            enter(tag, len(stack))
            stack.append((tag, [tag, " ".join(attrs.split())], len(segments), foreign, zone, []))
        elif kind == "end":
            if tag in BLOCKS:
                block += 1
            last = opened[tag][-1] if opened.get(tag) else 0
            if last and (tag in REACHING or last >= walls[-1]):
                while len(stack) > last:
                    close()
        elif kind == "raw":
            stack[-1][1].append(f"\x03{tag} {xxhash.xxh3_64_intdigest(rest)}")
    text(page[at:])
    while len(stack) > 1:
        close()
    surround(stack[0][1], stack[0][5], -1)
    for n in sorted(above, reverse=True):  # parents come after their children
        around[n] = around.get(above[n], 0)
    return segments, [(value, first, end, around[n] if whole else None) for n, (value, first, end, whole) in enumerate(found)]


def subtree_key(host: str, value: int) -> int:
    return _number(f"{host}\x00{value}")


def main_text(page: str | None, template: frozenset[int] | set[int] = frozenset(), host: str | None = None) -> str:
    """The text of the article: blocks in page order, one line each.

    `template` are hashes of subtrees or, with a host, their keys; they go first. What is left outside article elements goes
    only if these hold at least half of its words; otherwise the same holds for main elements, and otherwise all stays.
    """
    if not page:
        return ""
    segments, subtrees = parse(page)
    if template:
        gone = bytearray(len(segments))
        for value, first, end, _ in subtrees:
            if (value if host is None else subtree_key(host, value)) in template:
                gone[first:end] = b"\x01" * (end - first)
        segments = [s for s, g in zip(segments, gone) if not g]
    words = [len(t.split()) for _, _, t in segments]
    zone = next((bit for bit in (2, 1) if 0 < sum(words) <= 2 * sum(n for n, s in zip(words, segments) if s[1] & bit)), 0)
    lines: list[str] = []
    last, held = None, []
    for block, z, t in segments:
        if z & zone != zone:
            continue
        if block != last and held:
            lines.append(" ".join("".join(held).split()))
            held = []
        last = block
        held.append(t)
    lines.append(" ".join("".join(held).split()))
    return "\n".join(line for line in lines if line)


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def _subtree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = {"host": pa.string(), "subtree": pa.int64(), "page": pa.int64(), "around": pa.int64()}
    for batch in batches:
        hosts, values, pages, arounds = [], [], [], []
        for host, page, text in zip(batch.column("host").to_pylist(), batch.column("page").to_pylist(), batch.column("html")):
            found: dict[int, int | None] = {}
            for value, _, _, around in parse(text.as_py())[1]:
                if found.get(value) is None:
                    found[value] = around
            hosts += [host] * len(found)
            pages += [page] * len(found)
            values += [subtree_key(host, value) for value in found]
            arounds += found.values()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((hosts, values, pages, arounds), types.values())], names=list(types))


def _text_rows(shared: Broadcast | None):
    """Texts of pages without the subtrees whose keys are shared, or else stand in the column `template`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frozenset(shared.value.tolist()) if shared is not None else None
        for batch in batches:
            lists = [known] * batch.num_rows if known is not None else (frozenset(t.as_py() or ()) for t in batch.column("template"))
            hosts = batch.column("host").to_pylist()
            texts = [main_text(page.as_py(), own if host is not None else frozenset(), host) for page, host, own in zip(batch.column("html"), hosts, lists)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    return run


SUBTREE_ROWS = "host string, subtree long, page long, around long"


def _known(pages: DataFrame) -> DataFrame:
    return pages.select(host_of(F.col("url")).alias("host"), F.xxhash64("html").alias("page"), "html").filter("host is not null and html is not null")


def host_templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, min_surroundings: int = MIN_SURROUNDINGS) -> DataFrame:
    """(subtree), stored: keys of the subtrees that recur on a host. Copies of one page count once.

    A subtree recurs if it stands on `min_share` of the host's pages, `min_pages` at least, or as a whole block outside any
    article in `min_surroundings` different surroundings. Keys are of host and subtree; no list of a host is ever held.
    """
    known = _known(pages)
    seen = known.mapInArrow(_subtree_rows, SUBTREE_ROWS).distinct()
    counts = seen.groupBy("host", "subtree", "around").agg(F.count("*").alias("n"))
    counts = counts.groupBy("host", "subtree").agg(F.sum("n").alias("n"), F.count("around").alias("surroundings")).filter(F.col("n") >= min_pages)
    totals = known.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages")).filter(F.col("pages") >= min_pages)
    often = counts.join(totals, "host").filter((F.col("n") >= F.col("pages") * min_share) | (F.col("surroundings") >= min_surroundings))
    return stored(often.select("subtree"), "templates")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """Per row of `pages` (page_id, url, html): page_id, url, text, n_chars.

    Template goes first; of the rest, text outside article (or else main) elements goes if these hold at least half of its
    words. Null or empty html has an empty text. A page whose URL is null or has no host belongs to no template. Repeated rows
    get equal texts; other columns are not looked at; an empty table gives an empty result.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    templates = host_templates(pages, min_pages, min_share)
    rows = pages.withColumn("host", host_of(F.col("url")))
    shared = None
    if templates.count() <= BROADCAST_SUBTREES:
        shared = pages.sparkSession.sparkContext.broadcast(templates.toArrow().column("subtree").to_numpy())
    else:
        own = _known(pages).mapInArrow(_subtree_rows, SUBTREE_ROWS).select("subtree", "page").distinct().join(dealt_anew(templates, "subtree"), "subtree")
        # keys name the host, too: a page that stands on several hosts has the keys of each
        own = dealt_anew(own.groupBy("page").agg(F.collect_list("subtree").alias("template")), "page")
        rows = rows.withColumn("page", F.xxhash64("html")).join(own, "page", "left").drop("page")
    return rows.mapInArrow(_text_rows(shared), "page_id long, url string, text string, n_chars long")
