"""Main text of web pages: structural landmarks, and a host suffix array for what they leave open."""

from __future__ import annotations

import html
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import mix64, sliced, spread, stored, table, tidy
from .urls import host_of

#: Tokens of the shortest repeated stretch; tokens of one host's pages that a task sorts together, about.
STRETCH, SHARD = 6, 1_000_000
#: A stretch is common on a host if so many pages, and this share of all its pages, have it.
COMMON, SHARE = 3, 0.5
#: A block within articles is boilerplate if so many different articles of a host, and this share of them, have it.
ARTICLES, NEARLY_ALL = 5, 0.9
#: So many numbers of pages and blocks may be broadcast.
FEW = 100_000
#: Tokens of running text: of a block, and of a text that outweighs what is left of a page.
RUNNING, LONG_TEXT = 10, 25

# Fixed values of HTML: elements by what they mean for text.
RAW = frozenset("script style noscript template svg math iframe object embed canvas audio video textarea select option datalist title head".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("nav aside footer form menu dialog search button fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
# Fixed words in the first or last part of a class or id that mark what isn't the article.
MARKS = frozenset("ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright discussion disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pagination pager popup promo promoted promotion recommended related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets".split())
# Those of them that mark reader comments, whatever else a page has.
COMMENTS = frozenset("comment comments discussion disqus replies reply respond".split())
_PROSE = tuple("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
_SAFE = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
_TOKEN = regex.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|$)|[^<]+|<", regex.S)
_ATTRIBUTE = regex.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_WHITE = regex.compile(r"\s+")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)} if text.strip(" /") else {}


def _marked(own: dict[str, str], in_article: bool) -> int:
    """Whether an element says that it isn't the article: 2 if it does so by its role, by being hidden or as reader comments,
    1 by another word of its class or id. What is called a header within an article holds its title."""
    sure = _sure(own)
    for name in (own.get("class", "") + " " + own.get("id", "")).lower().split():
        parts = regex.split(r"[-_:]+", name)
        if parts[0] not in ("no", "has", "with", "without"):
            found = [x for x in (parts[0], parts[-1]) if x in MARKS and not (in_article and x == "header")]
            if found:
                return 2 if sure or any(x in COMMENTS for x in found) else 1
    return 2 if sure else 0


def _sure(own: dict[str, str]) -> bool:
    return own.get("role", "").lower() in ROLES or "hidden" in own or own.get("aria-hidden", "").lower() == "true" or "display:none" in own.get("style", "").replace(" ", "").lower()


@dataclass
class Page:
    """A page's blocks in order, each with whether it lies in an article or main element, in something to be dropped (2 by an
    element, its role or as comments, 1 by a word of its class alone), how much of it is links, and whether it is a heading
    or paragraph."""

    texts: list[str] = field(default_factory=list)
    inside: list[int] = field(default_factory=list)  # 2 in an article, 1 in main, else 0
    dropped: list[int] = field(default_factory=list)
    linked: list[float] = field(default_factory=list)
    prose: list[bool] = field(default_factory=list)  # in a heading or paragraph


def parsed(text: str) -> Page:
    """Scans the page once. Elements that a page leaves open end with their parent; an article or main element ends all
    that should have ended before it."""
    out, stack = Page(), []  # stack: (name, drops, in article or main)
    drops = sure = inside = articles = 0
    opened: dict[str, int] = {}  # how many of each name are in the stack, so that it is searched only for what is there
    piece: list[str] = []
    link = links = 0
    raw = ""

    def flush() -> None:
        nonlocal piece, links
        if piece:
            joined = _WHITE.sub(" ", html.unescape("".join(piece))).strip()
            if joined:
                out.texts.append(joined)
                out.inside.append(2 if articles else 1 if inside else 0)
                out.dropped.append(2 if sure else 1 if drops else 0)
                out.linked.append(min(1.0, links / len(joined)))
                out.prose.append(any(opened.get(x) for x in _PROSE))
        piece, links = [], 0

    def pop(to: int) -> None:
        nonlocal drops, sure, inside, articles, link
        while len(stack) > to:
            name, drop, landmark = stack.pop()
            opened[name] -= 1
            articles -= landmark == 2
            drops -= drop > 0
            sure -= drop == 2
            inside -= landmark > 0
            link -= name == "a"

    def last(*names: str) -> int:
        """The place of the innermost open element of these names, or -1. What lies above it mostly ends with it."""
        if not any(opened.get(n) for n in names):
            return -1
        return next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in names)

    def push(name: str, drop: int, landmark: int) -> None:
        nonlocal drops, sure, inside, articles, link
        stack.append((name, drop, landmark))
        opened[name] = opened.get(name, 0) + 1
        drops += drop > 0
        sure += drop == 2
        inside += landmark > 0
        articles += landmark == 2
        link += name == "a"

    for m in _TOKEN.finditer(text):
        name = m[2]
        if name is None:
            if not raw and m[0][:2] not in ("<!", "<?") and not (m[0][0] == "<" and len(m[0]) > 1):
                piece.append(m[0])
                if link:
                    links += len(m[0].strip())
            continue
        name = name.lower()
        closing = m[1] == "/"
        if raw:
            if closing and name == raw:
                raw = ""
            continue
        if closing:
            if name in BLOCKS or name in DROPPED:
                flush()
            at = last(name)
            if at >= 0:
                flush() if any(x[0] in BLOCKS for x in stack[at:]) else None
                pop(at)
            continue
        if name in RAW:
            if name == "head":  # what a head holds is raw, one by one; it ends with its tag or the body
                flush()
                push("head", 2, 0)
            elif not m[3].rstrip().endswith("/"):
                flush() if name == "title" else None
                raw = name
            continue
        if name == "br" or name == "td" or name == "th" or name == "img":
            piece.append(" ")
        if name in VOID:
            flush() if name == "hr" else None
            continue
        if name in BLOCKS or name in DROPPED:
            flush()
            if name == "body" and stack and stack[-1][0] == "head":
                pop(len(stack) - 1)
            at = last("p")
            if at >= 0 and name != "span" and not any(x[0] in ("button", "table") for x in stack[at:]):
                pop(at)
            if name == "li":
                at = last("li", "ul", "ol")
                if at >= 0 and stack[at][0] == "li":
                    pop(at)
        own = _attributes(m[3])
        landmark = 2 if name == "article" or own.get("itemprop") == "articleBody" else 1 if name == "main" or own.get("role") == "main" else 0
        in_article = articles > 0
        drop = 2 if name in DROPPED or (name == "header" and not in_article) else _marked(own, in_article) if name not in _SAFE or name == "article" else 0
        if landmark and not drop and drops and not inside:  # what was left open before it
            pop(next((i for i, x in enumerate(stack) if x[1]), len(stack)))
        push(name, drop, landmark)
        if m[3].rstrip().endswith("/") and name not in BLOCKS:
            pop(len(stack) - 1)
    flush()
    return out


def suffix_array(tokens: np.ndarray, stretch: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank): the suffixes of a token sequence sorted by their first `stretch` tokens at least, by doubling, and
    the rank of each, equal where those are. Separators must be unique tokens.

    No deeper order is needed: the tokens that lie in a substring of `stretch` tokens or more which so many pages have are
    those that lie in one of just `stretch` tokens, for all parts of a repeated substring are on as many pages at least."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    have = 1
    while have < stretch:
        step = min(have, stretch - have)
        nxt = np.full(len(rank), -1, np.int64)
        nxt[: len(rank) - step] = rank[step:]
        rank = np.unique(rank * (len(rank) + 1) + nxt + 1, return_inverse=True)[1].astype(np.int64)
        have += step
    return np.argsort(rank, kind="stable"), rank


def _token_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of the blocks, and each token's block."""
    split = [t.split() for t in texts]
    return np.array([xxhash.xxh3_64_intdigest(w) for s in split for w in s], np.uint64), np.repeat(np.arange(len(texts)), [len(s) for s in split])


def stretches(stream: np.ndarray, stretch: int = STRETCH) -> np.ndarray:
    """A 64-bit name of the stretch that begins at each place of a stream (none at the last stretch - 1)."""
    n = len(stream) - stretch + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for j in range(stretch):
            h = h * np.uint64(0x9E3779B97F4A7C15) + stream[j : j + n]
    return mix64(h).astype(np.int64)


def _sorted_shard(group: pa.Table) -> pa.Table:
    """A shard's suffix array: the streams end to end with separators of their own between them; every class of suffixes
    that share their first tokens is one stretch, with how many different pages have it."""
    streams = [np.array(s, np.int64).view(np.uint64) for s in group.column("stream").to_pylist()]
    prints = group.column("print").to_numpy()
    size = np.array([len(s) + 1 for s in streams])
    tokens = np.concatenate([x for i, s in enumerate(streams) for x in (s, np.array([mix64(np.array([i], np.uint64), 77)[0]], np.uint64))])
    page = np.repeat(np.arange(len(streams)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(tokens)) - 1
    order, rank = suffix_array(tokens, STRETCH)
    order = order[left[order] >= STRETCH]  # a whole stretch within its page
    names = np.concatenate([np.concatenate([stretches(s), np.zeros(len(s) + 1 - max(0, len(s) - STRETCH + 1), np.int64)]) for s in streams])
    who = prints[page[order]]
    by = np.lexsort((who, rank[order]))
    r, who, at = rank[order][by], who[by], order[by]
    new = np.ones(len(r), bool)
    new[1:] = r[1:] != r[:-1]
    other = np.ones(len(r), bool)
    other[1:] = new[1:] | (who[1:] != who[:-1])
    pages = np.add.reduceat(other, np.flatnonzero(new)) if len(r) else np.zeros(0, np.int64)
    first = np.flatnonzero(new)
    return pa.table({"host": pa.array([group.column("host")[0].as_py()] * len(first), pa.string()), "name": pa.array(names[at[first]] if len(first) else np.zeros(0, np.int64)), "pages": pa.array(pages.astype(np.int64)), "of": pa.array(np.full(len(first), group.column("of")[0].as_py(), np.int64)), "one": pa.array(who[first] if len(first) else np.zeros(0, np.int64))})


def judged_blocks(blocks: list[str | None], marked: list[bool], linked: list[float], prose: list[bool], where: np.ndarray, places: np.ndarray, pages: np.ndarray, of: int) -> list[str]:
    """The blocks of a page without landmarks that stay (None: dropped already). marked: by a word of its class, which counts
    only where the page has running text besides. where: each token's block; places, pages:
    where stretches begin that other pages have, and how many pages have them; of: pages of the host."""
    n = len(blocks)
    size = np.bincount(where, minlength=n)
    begin = np.zeros(len(where) + STRETCH, np.int64)
    begin[places] = pages
    level = np.zeros(len(where), np.int64)  # pages that have a token in a stretch
    for j in range(STRETCH):
        level[j:] = np.maximum(level[j:], begin[: max(0, len(where) - j)])
    half = lambda least: 2 * np.bincount(where, level >= least, n) >= np.maximum(size, 1)
    links = np.array(linked) >= 0.5
    there = np.array([b is not None for b in blocks], bool)
    if (there & ~np.array(marked, bool) & (size >= RUNNING) & ~links).any():
        there &= ~np.array(marked, bool)
    gone = there & (half(max(COMMON, SHARE * of)) | (links & half(2)))
    keep = there & ~gone
    running = there & (size >= RUNNING) & ~links
    lost = np.flatnonzero(running & gone)
    if len(lost):
        own = np.array([np.median(level[where == i]) if size[i] else 0 for i in range(n)])
        most = (own[lost[np.argmax(size[lost])]] + of) / 2  # what more pages have isn't of this text
        run = lost[own[lost] <= most]
        if not keep.any() or (size[run].sum() >= LONG_TEXT and 2 * size[running & keep].sum() < size[run].sum()):
            part = there & ~links & (own <= most)
            back = np.zeros(n, bool)
            back[run[0] : run[-1] + 1] = True
            for i, step in ((run[0] - 1, -1), (run[-1] + 1, 1)):  # headings and short paragraphs before and after
                while 0 <= i < n and (not there[i] or keep[i] or (part[i] and (prose[i] or own[i] < of))):
                    back[i] = True
                    i += step
            keep |= back & part
    if not keep.any():
        keep = there & ~links
    return [b for b, k in zip(blocks, keep, strict=True) if k and b is not None]


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url", text: str = "html") -> DataFrame:
    """One row per page: key, url, text, n_chars.

    A page's blocks (what lies between block elements, character references decoded, white space one space, trimmed) are
    judged so: scripts, styles, markup comments, menus, page headers and footers, sidebars, forms, and elements whose
    class, id or role names a notice, an advert, reader comments or the like go. Where the page has article elements, the
    article is what lies in them; else what lies in its main element. Where it has neither, the host suffix array
    decides, and a word of a class (but those of reader comments) counts only if there is running text without one: the
    token streams of all pages of a host (what lies outside articles) are concatenated and their suffixes
    sorted; stretches of STRETCH tokens or more that at least COMMON pages and SHARE of the host's pages have are
    boilerplate, and blocks of which they cover half or more go; so do blocks that are mostly links if they cover it that
    any other page has. A text that fewer pages share is a copied article and stays on each. Where most of a host's
    pages are copies, their text stays too: if what would go holds running text (blocks of RUNNING tokens that aren't
    mostly links) of LONG_TEXT tokens and more than twice that of what is left, or if nothing is left, the longest such
    text stays with what lies between its blocks and the headings and paragraphs next to it, but without what clearly
    more pages have. If there is none, all blocks that aren't mostly links stay.

    Within articles stretches have no say, or copies of an article on one host would erase each other. Whole blocks
    that ARTICLES different articles of a host and NEARLY_ALL of them have go, unless they are more than half of an article.

    A host's pages are dealt to shards of about SHARD tokens with a suffix array each; the classes of the shards are then
    added up by stretch, which gives the same stretches as one array over the host, so a large host is no task of its own
    and none of its pages is left out. Pages whose streams are equal count once.

    Nulls: null html is empty, text ''; null urls have the host ''. Repeated rows stay; an empty table gives none; other
    columns are ignored. Pages are parsed whole."""
    kind = pages.schema[key].dataType
    out = StructType([StructField("key", kind), StructField("url", StringType()), StructField("own", ArrayType(StringType())), StructField("row", LongType()), StructField("print", LongType()), *StructType.fromDDL("blocks array<string>, marked array<boolean>, linked array<double>, prose array<boolean>, stream array<long>, block_of array<int>").fields])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "html", 4 << 20):
                rows = []
                for k, u, h in zip(part.column("key").to_pylist(), part.column("url").to_pylist(), part.column("html").to_pylist(), strict=True):
                    page = parsed(h or "")
                    level = max((i for i, d in zip(page.inside, page.dropped, strict=True) if not d), default=0)
                    own = [t for t, i, d in zip(page.texts, page.inside, page.dropped, strict=True) if level and i >= level and not d]
                    outside = [j for j, i in enumerate(page.inside) if i < 2]
                    stream, where = _token_hashes([page.texts[j] for j in outside])
                    row = {"key": k, "url": u, "own": own if level else None, "row": xxhash.xxh3_64_intdigest(f"{k}|{u}|{h}") - (1 << 63), "print": xxhash.xxh3_64_intdigest(stream.tobytes()) - (1 << 63), "stream": stream.view(np.int64).tolist()}
                    if not level:  # nothing settled: the blocks that aren't dropped wait for the host's stretches
                        row |= {"blocks": [page.texts[j] if page.dropped[j] < 2 else None for j in outside], "marked": [page.dropped[j] == 1 for j in outside], "linked": [page.linked[j] for j in outside], "prose": [page.prose[j] for j in outside], "block_of": where.tolist()}
                    rows.append(row)
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("key", part.column("key").type), ("url", pa.string()), ("own", pa.list_(pa.string())), ("row", pa.int64()), ("print", pa.int64()), ("blocks", pa.list_(pa.string())), ("marked", pa.list_(pa.bool_())), ("linked", pa.list_(pa.float64())), ("prose", pa.list_(pa.bool_())), ("stream", pa.list_(pa.int64())), ("block_of", pa.list_(pa.int32()))]))

    read = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(text).alias("html"))
    found = stored(read.mapInArrow(tidy(task), out).withColumn("host", host_of(F.col("url"))), "pages", codec="gzip")
    # the host suffix arrays
    streams = found.filter(F.size("stream") >= STRETCH).select("host", "print", "stream").dropDuplicates(["host", "print"])
    hosts = streams.groupBy("host").agg(F.ceil(F.sum(F.size("stream")) / SHARD).cast("long").alias("shards"), F.count(F.lit(1)).alias("of"))
    dealt = streams.join(hosts, "host").withColumn("shard", F.pmod(F.col("print"), F.col("shards")))
    classes = dealt.groupBy("host", "shard").applyInArrow(_sorted_shard, "host string, name long, pages long, of long, one long")
    repeated = classes.groupBy("host", "name").agg(F.sum("pages").alias("pages"), F.max("of").alias("of")).filter("pages > 1")
    # pages that wait for them
    waiting = found.filter("own IS NULL")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                names = stretches(np.array(batch.column("stream")[r].as_py(), np.int64).view(np.uint64))
                if len(names):
                    yield pa.RecordBatch.from_arrays([pa.array([batch.column("host")[r].as_py()] * len(names), pa.string()), pa.array([batch.column("row")[r].as_py()] * len(names), pa.int64()), pa.array(np.arange(len(names), dtype=np.int32)), pa.array(names)], ["host", "row", "place", "name"])

    places = waiting.select("host", "row", "stream").dropDuplicates(["row"]).mapInArrow(tidy(placed), "host string, row long, place int, name long")
    covered = places.join(repeated, ["host", "name"]).groupBy("row").agg(F.collect_list(F.struct("place", "pages")).alias("places"), F.max("of").alias("of"))
    judged = waiting.join(covered, "row", "left")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for i, r in enumerate(batch.select(["blocks", "marked", "linked", "prose", "block_of", "of"]).to_pylist()):
                at = batch.column("places")[i].values
                place, count = (at.field(c).to_numpy() for c in ("place", "pages")) if at is not None else (np.zeros(0, np.int64),) * 2
                texts.append("\n\n".join(judged_blocks(r["blocks"], r["marked"], r["linked"], r["prose"], np.array(r["block_of"], np.int64), place, count, r["of"] or 1)))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("url"), pa.array(texts, pa.string())], ["key", "url", "text"])

    late = judged.select("key", "url", "blocks", "marked", "linked", "prose", "block_of", "places", "of").mapInArrow(tidy(decide), StructType([*out.fields[:2], StructField("text", StringType())]))
    # articles, without the blocks that nearly all different articles of the host have
    settled = found.filter("own IS NOT NULL").select("key", "url", "own", "row", "host")
    names = settled.select("host", "row", F.xxhash64("own").alias("article"), F.explode(F.array_distinct(F.transform("own", lambda x: F.xxhash64(x)))).alias("block"))
    articles = names.select("host", "article").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("articles"))
    common = names.select("host", "article", "block").distinct().groupBy("host", "block").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= ARTICLES)
    common = common.join(articles, "host").filter(F.col("n") >= F.col("articles") * NEARLY_ALL).select("host", "block")
    gone = stored(names.select("host", "row", "block").distinct().join(common, ["host", "block"]).groupBy("row").agg(F.collect_list("block").alias("gone")), "common-blocks")
    # few pages mostly: then they go to the others' tasks, which need no shuffle
    settled = settled.join(F.broadcast(gone) if (gone.agg(F.sum(F.size("gone") + 1)).first()[0] or 0) <= FEW else gone, "row", "left")
    whole = F.array_join("own", "\n\n")
    rest = F.array_join(F.filter("own", lambda x: ~F.array_contains("gone", F.xxhash64(x))), "\n\n")
    settled = settled.select("key", "url", F.when(F.col("gone").isNull() | (F.length(rest) * 2 < F.length(whole)), whole).otherwise(rest).alias("text"))
    return settled.union(late).select(F.col("key").alias(key), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spread(table(spark, sf_dir, "pages")))
