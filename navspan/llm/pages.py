"""HTML extraction with suffix arrays and counts of repeats over whole hosts.

A page is read into blocks of text, each with what its markup says: inside the article, boilerplate, or neither. What
the markup leaves open is boilerplate where long runs of tokens cover it that repeat across distinct pages of the host,
and main text where it is unique. Inside an article the markup decides alone: its text stays, repeated or not, but for
menus, forms, adverts, comments and the like. Every page goes this way: repeats have a say on each block outside an
article, also on those of a main part around one.

All pages are dealt by host and sorted, and read as runs of at most RUN pages of one host, so a task holds one run at a
time; a host with more than a thousandth of all pages is dealt over several partitions. The token streams of a run,
joined, are sorted into a suffix array by their first tokens; neighbours that agree are one run of tokens, which goes on
with a few of the pages that it is on. On how many pages of the host it is, is an aggregate by host and run of tokens,
which any number of tasks share. Only runs that touch an open block of some page go on; tasks are told of these by a bit
map of fixed size, and where it says yes by mistake, more is counted and nothing changes. The open blocks' runs are then
joined with the repeated ones by their hash.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navspan.llm.collocations import MAP_BITS, in_map, phrase_map
from navspan.llm.shared import frugal, slices, written
from navspan.llm.words import U, mixed, words

#: Pages of a run; tokens that a repeated run has at least; pages that it is on; share of a block that it covers.
RUN, TOKENS, PAGES, COVERED = 256, 8, 3, 0.8
HOT_HOSTS = 1000
#: Rows that a task hands on at a time.
STEP = 1 << 16

SKIPPED = {"script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "select", "textarea", "button", "title", "math", "audio", "video"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "input", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "link", "meta", "source", "track", "embed", "area", "base", "col", "param"}
VOID = {"br", "img", "input", "link", "meta", "source", "track", "embed", "area", "base", "col", "param", "wbr", "hr"}
LOOSE = {"p", "li", "dt", "dd", "tr", "td", "th", "option", "thead", "tbody", "tfoot"}
BOILERPLATE = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Words of class, id and role that mark boilerplate, and those that mark the main text.
DROPPED = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar", "sidebar", "aside", "widget", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "newsletter", "subscribe", "subscription", "signup", "login", "popup", "modal", "overlay", "share", "sharing", "social", "related", "recommended", "recommendations", "comment", "comments", "reply", "replies", "respond", "disqus", "search", "pagination", "pager", "toolbar", "contentinfo", "complementary", "hidden"}
#: Those that mark boilerplate only as a name's first word: others before them tell of something else (market-share).
WEAK = {"share", "search", "social", "alert", "reply", "respond", "hidden", "banner", "promo", "promotion"}
#: Words by which a name tells of a page's layout or state, not of what an element is (no-sidebar, comments-open).
STATES = {"no", "not", "non", "has", "with", "without", "open", "opened", "closed", "enabled", "disabled", "allowed"}
#: Tags that may close themselves; elsewhere a closing slash means nothing.
FOREIGN = {"svg", "math"}
MAIN = {"main", "content", "article", "post", "entry", "story"}

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:"[^"]*"|'[^']*'|[^>"'])*+)(?:>|\Z)|[^<]++|<""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


@dataclass
class Block:
    text: str
    inside: int  # 2 in an article, 1 in another main part, 0 in neither
    dropped: bool


@dataclass
class Open:
    tag: str
    inside: int
    dropped: bool
    header: bool
    surely: bool = False  # dropped by a tag or a whole name, its own or that of what holds it


def words_of_name(name: str) -> list[str]:
    """The words of a class, id or role, in lower case: cut at signs and at capitals."""
    return [x for x in re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", name).lower()) if x]


def is_boilerplate(name: list[str], whole: bool) -> bool:
    """Whether a name marks boilerplate: by itself, or, unless `whole`, by one of its words."""
    if len(name) == 1 or whole:
        return "-".join(name) in DROPPED
    if not STATES.isdisjoint(name):
        return False
    return bool(name) and (name[0] in DROPPED or any(x in DROPPED - WEAK for x in name))


@dataclass
class Reader:
    """Reads a page into blocks."""

    blocks: list[Block] = field(default_factory=list)
    stack: list[Open] = field(default_factory=lambda: [Open("", 0, False, False)])
    places: dict[str, list[int]] = field(default_factory=lambda: defaultdict(list))  # of each tag, in the stack
    pieces: list[str] = field(default_factory=list)
    heading: bool = False

    def close_block(self) -> None:
        text = " ".join(html.unescape("".join(self.pieces)).split())
        self.pieces.clear()
        if text:
            top = self.stack[-1]
            self.blocks.append(Block(text, top.inside, top.dropped or (top.header and not (top.inside and self.heading))))

    def enter(self, tag: str, attributes: str) -> None:
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
        names = [w for key in ("class", "id", "role") for x in found.get(key, "").split() if (w := words_of_name(x))]
        parts = {x for w in names for x in w}
        top = self.stack[-1]
        hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I)
        page, main = tag in ("html", "body"), tag in ("article", "main")
        # An article is boilerplate only where a whole name says so, and not by a word in the name of what holds it.
        surely = (main and top.surely) or (not main and top.dropped)
        named = not page and any(is_boilerplate(w, main) for w in names)
        dropped = surely or tag in BOILERPLATE or bool(hidden) or named
        sure = top.surely or tag in BOILERPLATE or bool(hidden) or not page and any(is_boilerplate(w, True) for w in names)
        header = top.header or tag == "header" or (not page and "header" in parts)
        inside = max(top.inside, 0 if dropped or page else 2 if tag == "article" else 1 if tag == "main" or parts & MAIN and not header else 0)
        if dropped or header or inside != top.inside or tag not in LOOSE:
            self.places[tag].append(len(self.stack))
            self.stack.append(Open(tag, inside, dropped, header, sure))

    def pop(self) -> None:
        self.places[self.stack.pop().tag].pop()

    def leave(self, tag: str) -> None:
        """Closes the last open tag of this name, and all within it; looked up, so that stray tags cost nothing."""
        if not self.places[tag]:
            return
        at = self.places[tag][-1]
        if tag in LOOSE and any(self.places[x] and self.places[x][-1] > at for x in ("article", "main", "body")):
            return
        while len(self.stack) > at:
            self.pop()

    def read(self, page: str) -> list[Block]:
        at, n = 0, len(page)
        while at < n:
            m = TAG.match(page, at)
            at = m.end()
            tag = m[2]
            if tag is None:
                if page[m.start()] != "<":
                    self.pieces.append("" if m[0] == "/" and page[m.start() - 1 : at] == "</" and at == n else m[0])
                elif at - m.start() == 1 and at < n and page[at] != "/":
                    self.pieces.append("<")
                continue
            tag = tag.lower()
            if tag in SKIPPED and not m[1]:
                if tag not in FOREIGN or not m[3].endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                    at = end.end() if end else n
                continue
            if tag in INLINE:
                if tag == "br":
                    self.pieces.append(" ")
                continue
            self.close_block()
            if m[1]:
                self.leave(tag)
                self.heading = False
            elif tag not in VOID:
                if self.stack[-1].tag == "p" or tag in LOOSE and self.stack[-1].tag == tag:
                    self.pop()
                self.heading = tag in HEADINGS
                if tag not in HEADINGS:
                    self.enter(tag, m[3])
        self.close_block()
        return self.blocks


def suffix_array(tokens: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first `length` tokens (a power of two), and the rank of each by these."""
    rank = np.unique(tokens, return_inverse=True)[1]
    done = 1
    while done < length:
        after = np.zeros_like(rank)
        after[:-done] = rank[done:] + 1
        rank = np.unique(rank * (int(rank.max()) + 2) + after, return_inverse=True)[1]
        done *= 2
    return np.argsort(rank, kind="stable"), rank


def identity(page: list[np.ndarray]) -> int:
    """A number for a page's tokens, the same in every task."""
    return int.from_bytes(hashlib.blake2b(b"|".join(b.tobytes() for b in page), digest_size=8).digest(), "little", signed=True)


def page_runs(streams: list[list[np.ndarray]], length: int = TOKENS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of `length` tokens within a page: their places in the order of a suffix array, and the rank of each; and
    the distinct (rank, page identity), as two arrays in the order of ranks. Equal pages count as one."""
    none = np.zeros(0, np.int64)
    sizes = [sum(len(b) for b in page) for page in streams]
    total = sum(sizes)
    if total < length:
        return none, none, none, none
    own, number = np.unique(np.array([identity(page) for page in streams], np.int64), return_inverse=True)
    which = np.repeat(np.arange(len(streams)), sizes)
    order, rank = suffix_array(np.concatenate([b for page in streams for b in page]), length)
    inside = np.zeros(total, bool)
    inside[: total - length + 1] = which[: total - length + 1] == which[length - 1 :]
    order = order[inside[order]]
    pairs = np.unique(rank[order] * np.int64(len(own)) + number[which[order]])
    return order, rank[order], pairs // len(own), own[pairs % len(own)]


def shares_of(streams: list[list[np.ndarray]], repeated: np.ndarray, length: int = TOKENS) -> list[list[float]]:
    """Share of each block's tokens that the runs of `length` tokens from the repeated places on cover."""
    sizes = np.array([len(b) for page in streams for b in page], np.int64)
    cover = np.zeros(int(sizes.sum()) + 1, np.int64)
    np.add.at(cover, repeated, 1)
    np.add.at(cover, repeated + length, -1)
    sums = np.concatenate([[0], np.cumsum(np.cumsum(cover)[:-1] > 0)])
    ends = np.cumsum(sizes)
    shares = iter(((sums[ends] - sums[ends - sizes]) / np.maximum(sizes, 1)).tolist())
    return [[next(shares) for _ in page] for page in streams]


def covered(streams: list[list[np.ndarray]], length: int = TOKENS, pages: int = PAGES) -> list[list[float]]:
    """Share of each block's tokens that runs of `length` tokens and more cover that stand on `pages` distinct pages.

    streams: the tokens of each page's blocks, of all pages of a host. Equal pages count as one.
    """
    order, rank, ranks, _ = page_runs(streams, length)
    on_pages = np.bincount(ranks) if len(ranks) else ranks
    return shares_of(streams, order[on_pages[rank] >= pages], length)


def run_hashes(tokens: np.ndarray, places: np.ndarray, length: int = TOKENS) -> np.ndarray:
    """A 64-bit number for the run of `length` tokens from each place on."""
    out = np.zeros(len(places), np.uint64)
    for k in range(length):
        out = mixed(out * U(0x9E3779B97F4A7C15) + tokens[places + k] + U(k + 1))
    return out.view(np.int64)


def main_text(blocks: list[Block], repeated: list[float]) -> str:
    """The blocks of the article, else of another main part, else those that are neither marked nor repeated. Where most of
    a main part's text is around its articles, they are parts of it; what repeats around them is not."""
    best = max((b.inside for b in blocks if not b.dropped), default=0)
    kept = [b for b, share in zip(blocks, repeated, strict=True) if not b.dropped and not (is_open(b) and share >= COVERED)]
    sizes = [sum(len(b.text) for b in kept if b.inside == k) for k in range(3)]
    least = 1 if best == 2 and sizes[1] > sizes[2] else best
    return "\n".join(b.text for b in kept if b.inside >= least)


def is_open(block: Block) -> bool:
    """Whether repeats have a say on a block."""
    return not block.dropped and block.inside < 2


def open_places(blocks: list[Block], streams: list[np.ndarray], length: int = TOKENS) -> np.ndarray:
    """Where the runs of `length` tokens start that touch an open block."""
    ends = np.cumsum([0, *map(len, streams)])
    reach = np.zeros(int(ends[-1]) + 1, np.int64)
    for block, a, b in zip(blocks, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if is_open(block) and b > a:
            reach[max(0, a - length + 1)] += 1
            reach[b] -= 1
    return np.flatnonzero(np.cumsum(reach)[: max(0, int(ends[-1]) - length + 1)] > 0)


def token_numbers(text: str, seen: dict[str, int]) -> np.ndarray:
    return mixed(np.array([seen.setdefault(w, len(seen)) for w in text.split()], np.int64).view(np.uint64) + U(1))


def token_hashes(blocks: list[Block]) -> list[np.ndarray]:
    """The tokens of each block as numbers that are the same in every task; texts have single spaces between words."""
    texts = [b.text.encode("utf-8", "surrogatepass") for b in blocks]
    hashes, bounds = words(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]), fold=False)
    return [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def open_runs(rows: DataFrame) -> DataFrame:
    """(first, second, host, hash, place) of the runs of TOKENS tokens that touch an open block of the pages (first, second,
    host, html); the first two numbers stand for a page's host and html."""
    schema = pa.schema([("first", pa.int64()), ("second", pa.int64()), ("host", pa.string()), ("hash", pa.int64()), ("place", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                for first, second, host, page in zip(*[part[c].to_pylist() for c in ("first", "second", "host", "html")], strict=True):
                    blocks = Reader().read(page or "")
                    if not any(map(is_open, blocks)):
                        continue
                    streams = token_hashes(blocks)
                    places = open_places(blocks, streams)
                    if not len(places):
                        continue
                    hashes = run_hashes(np.concatenate(streams), places)
                    for i in range(0, len(places), STEP):
                        n = len(places[i : i + STEP])
                        columns = [pa.array([x] * n, t) for x, t in ((first, pa.int64()), (second, pa.int64()), (host, pa.string()))]
                        yield pa.RecordBatch.from_arrays([*columns, pa.array(hashes[i : i + STEP]), pa.array(places[i : i + STEP], pa.int32())], schema=schema)

    return rows.select("first", "second", "host", "html").mapInArrow(frugal(run), "first long, second long, host string, hash long, place int")


def repeated_runs(rows: DataFrame, run: int, wanted: np.ndarray) -> DataFrame:
    """(host, hash) of the runs of TOKENS tokens that stand on PAGES distinct pages of a host, of those in the bit map
    `wanted`. rows: host, html, draw."""
    # Broadcast: the bit map, of fixed size.
    told = rows.sparkSession.sparkContext.broadcast(wanted)
    counts = rows.groupBy("host").count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    # Broadcast: no more than HOT_HOSTS hosts can have more than this share of all pages.
    share = max(4 * run, total // HOT_HOSTS)
    hot = counts.where(F.col("count") > share).select("host", F.ceil(F.col("count") / share).alias("parts"))
    rows = rows.join(F.broadcast(hot), "host", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("part", F.pmod("draw", "parts"))
    rows = rows.repartition("host", "part").sortWithinPartitions("host", "part", F.xxhash64("draw"))
    schema = pa.schema([("host", pa.string()), ("hash", pa.int64()), ("page", pa.int64())])

    def counted(held: list[str], host: str, whole: bool) -> Iterator[pa.RecordBatch]:
        """The first PAGES pages of each run of tokens; of a whole host, only of the repeated ones."""
        streams = [token_hashes(Reader().read(page or "")) for page in held]
        order, rank, ranks, own = page_runs(streams)
        if not len(order):
            return
        first = np.append(True, ranks[1:] != ranks[:-1])
        place = np.arange(len(ranks)) - np.maximum.accumulate(np.where(first, np.arange(len(ranks)), 0))
        keep = place < PAGES
        if whole:
            keep &= np.bincount(ranks)[ranks] >= PAGES
        ranks, own = ranks[keep], own[keep]
        distinct, at = np.unique(rank, return_index=True)
        hashes = run_hashes(np.concatenate([b for page in streams for b in page]), order[at])[np.searchsorted(distinct, ranks)]
        asked = in_map(told.value, hashes & (MAP_BITS - 1))
        hashes, own = hashes[asked], own[asked]
        for i in range(0, len(hashes), STEP):
            part = hashes[i : i + STEP]
            yield pa.RecordBatch.from_arrays([pa.array([host] * len(part), pa.string()), pa.array(part), pa.array(own[i : i + STEP])], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        now, whole = None, True
        for batch in batches:
            for host, part, parts, page in zip(*[batch[c].to_pylist() for c in ("host", "part", "parts", "html")], strict=True):
                if held and ((host, part) != now or len(held) == run):
                    whole = whole and (host, part) != now
                    yield from counted(held, now[0], whole)
                    held, whole = [], (host, part) != now
                now, whole = (host, part), whole and parts == 1
                held.append(page)
        if held:
            yield from counted(held, now[0], whole)

    found = rows.select("host", "part", "parts", "html").mapInArrow(frugal(read), "host string, hash long, page long")
    return found.distinct().groupBy("host", "hash").count().where(F.col("count") >= PAGES).select("host", "hash")


def extract(spark: SparkSession, pages: DataFrame, run: int = RUN) -> DataFrame:
    """Of (page_id, url, html): page_id, url, text (main text, blocks joined by a line feed) and n_chars.

    One row per row of pages; repeated rows, ties and extra columns change nothing. A null or empty html has no text;
    a null url counts as a host of its own; an empty table gives no rows. Character references are decoded, white space
    inside a block is one space, and nothing is cut. Repeats are counted over all pages of a host; `run`, the pages that
    a task holds at a time, has no part in what is found. Runs of tokens are told apart by 64-bit hashes, pages by 128 bits.
    """
    host = F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    page = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", "html", host.alias("host"), F.xxhash64("page_id", "url").alias("draw"))
    rows = rows.select("*", F.xxhash64("host", page).alias("first"), F.xxhash64(page, "host", F.lit(1)).alias("second"))
    asked = written(spark, open_runs(rows), "open")
    wanted = phrase_map(asked.select(F.col("hash").alias("key")))
    repeated = written(spark, repeated_runs(rows.select("host", "html", "draw"), run, wanted), "repeated")
    # A page's places are no more than its tokens, however many copies it has.
    places = asked.join(repeated, ["host", "hash"]).groupBy("first", "second").agg(F.collect_set("place").alias("places"))
    places = written(spark, places, "places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = []
                for html_, at in zip(part["html"].to_pylist(), part["places"], strict=True):
                    blocks = Reader().read(html_ or "")
                    shares = [0.0] * len(blocks)
                    if at.is_valid:
                        shares = shares_of([token_hashes(blocks)], np.asarray(at.values, np.int64))[0]
                    texts.append(main_text(blocks, shares))
                yield pa.RecordBatch.from_arrays([part["page_id"], part["url"], pa.array(texts, pa.string())], ["page_id", "url", "text"])

    found = rows.select("page_id", "url", "html", "first", "second").join(places, ["first", "second"], "left")
    found = found.select("page_id", "url", "html", "places").mapInArrow(frugal(cut), "page_id long, url string, text string")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
