"""Main text of web pages: markup, then suffix arrays, merged over the pages of each host.

A page is read into blocks of text in page order. Markup decides where it is explicit: menus, page headers and footers,
sidebars, forms, notices, adverts and reader comments, by element or by the words of class, id and role (not those of
article, main, body and headings), are not main text, nor is an article inside of them unless the page has no other
article and less open text than it; a class that says the page has such a part (has-sidebar) is no such class, and an
article inside of an article or main part whose class names comments or teasers is one; scripts, styles and the like have no text. Blocks inside an article (or main part) are content, all others are
open. On pages with an article, open blocks that are links and nothing else go.

All else is decided by repetition. The words of a batch of pages are put in rows, for each page one of its articles and
one of the rest; where a row can have repeats, with a mark of its own after each stretch, suffixes are sorted by prefix doubling, as deep as a
repeat has to be long (``min_words``). Equal prefixes in rows of different pages of a host are repeats, and words
covered by one are boilerplate outside of articles. Pages whose whole row is equal count as one page, so copies of a page
do not erase it. An article loses whole blocks only, never words of a paragraph: a block goes if repeats cover all of
it and it stands in at least ``NOTICE_PAGES`` different articles of the host and in one of ``NOTICE_SHARE`` of them, as a
notice does and a paragraph quoted in another article does not. An article with more than half of its words in repeats is taken
for a copy with changes, and keeps everything.

Every two pages of a host are compared, in whatever batches they are, in two rounds. First, each batch deals one short
hash for about three words, the representatives of its runs of ``min_words`` words, to tasks that find those of other
batches. Runs whose representative stands in no other page are no repeats; the words of all others form the stretches
that the suffix array is built over, and of those each batch deals its distinct (host, prefix)
pairs, with the pages' classes (one, or more than one), to tasks by a hash of both, a task merges those of all batches,
and one bit for each returns to the batch. So a large host, or a passage on all of its pages, meets in no single task:
a prefix is one entry per batch. Hosts, words and rows of pages are compared between batches by 64-bit hashes.

Defined results: null or empty html gives an empty text; a null url is a host of its own; rows that repeat are extracted
each; damaged markup (unclosed elements, quotes and comments) is read as far as it goes; an empty table gives an empty
table; other columns are not looked at. A line break (br) ends a block.
"""

from __future__ import annotations

import html as html_entities
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm import common
from pairloom.llm.flat import FlatTexts

OPEN, CONTENT, BOILERPLATE = 0, 1, 2
_ASIDE = 3  # an article in BOILERPLATE, while a page is read
#: of html in a batch
BATCH_BYTES = 8 << 20
#: of a representative's hash; equal ones of different runs only cost work
BITS = 40
#: A repeated block of an article is a notice of the host if so many different articles have it, and one in so many.
NOTICE_PAGES, NOTICE_SHARE = 3, 4

_RAW = "script style noscript template svg math iframe object canvas textarea select title".split()
_RAW_NAME = re.compile(r"<(" + "|".join(_RAW) + r")\b", re.I)
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in _RAW}
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
#: Most tags: no quotes left open and no < inside, so a failed attempt looks no further than to the next one.
_PLAIN = re.compile(r"""<(/?)([a-zA-Z][^\s/>"'<]*)(?=[\s/>])((?:[^<>"']|"[^"<>]*"|'[^'<>]*')*+)>""")
_SPECIAL = re.compile("[>\"']")
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_TRACKED = frozenset("article aside body center details dialog div dl fieldset figure footer form header main menu nav ol section table ul".split())
_NEVER_AWAY = frozenset("article body h1 h2 h3 h4 h5 h6 main".split())
_AWAY = frozenset("aside button dialog footer form menu nav".split())
_AWAY_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "footer sidebar sidebars cookie cookies consent gdpr notice notices newsletter subscribe popup modal overlay comment comments disqus respond reply "
    "replies login signup share sharing social related pagination pager toolbar widget masthead contentinfo complementary search skip".split()
)
_TEASER = frozenset(["teaser"])
_ATTRIBUTE = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[^A-Za-z]+")


def _says_away(attributes: str, more: frozenset = frozenset()) -> bool:
    """Whether a class, id or role has a word of the list, other than to say that the page has such a part or none."""
    for m in _ATTRIBUTE.finditer(attributes):
        before = ""
        for word in _PARTS.split((m[1] or m[2] or m[3] or "").lower()):
            if (word in _AWAY_WORDS or word in more) and before not in ("has", "with", "no", "without"):
                return True
            before = word
    return False


def tags(html: str) -> Iterator[tuple[int, int, str | None, bool, str]]:
    """(start, end, name or None, closing, attributes) of comments, elements without text, and tags, in order.

    What has no name has no meaning beyond taking its place. A tag ends at the first ``>`` outside of quotes, or at the
    first one at all if its quotes do not close. Every character is looked at a bounded number of times, whatever
    is missing: where a tag ends depends only on the next quote or ``>`` after its name, and that is remembered.
    """
    last = html.rfind(">")
    ends: dict[int, int] = {}  # from a quote or > outside of quotes to the > that ends the tag, -1 for none
    seen = (0, -1)  # no quote or > between these but at the second

    def special(at: int) -> int:
        nonlocal seen
        if not seen[0] <= at <= seen[1]:
            m = _SPECIAL.search(html, at)
            seen = (at, m.start() if m else len(html))
        return seen[1]

    def end_of(at: int) -> int:
        way, found = [], -1
        place = special(at)
        while place < len(html):
            if place in ends:
                found = ends[place]
                break
            way.append(place)
            if html[place] == ">":
                found = place
                break
            closing = html.find(html[place], place + 1)
            if closing < 0:
                break
            m = _SPECIAL.search(html, closing + 1)
            place = m.start() if m else len(html)
        ends.update(dict.fromkeys(way, found))
        return found

    is_raw: dict[str, bool] = {}
    at = html.find("<")
    while 0 <= at <= last:
        if m := _PLAIN.match(html, at):
            name = m[2].lower()
            if name not in is_raw:
                is_raw[name] = bool(_RAW_NAME.match("<" + name))
            if m[1] or not is_raw[name]:
                yield at, m.end(), name, bool(m[1]), m[3]
                at = html.find("<", m.end())
                continue
        start, name, closes, attributes, end = at, None, False, "", -1
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            end = len(html) if end < 0 else end + 3
        elif m := _NAME.match(html, at):
            raw = _RAW_NAME.match(html, at)
            end = end_of(raw.end()) if raw else -1
            if end >= 0:
                closing = _RAW_END[raw[1].lower()].search(html, end + 1)
                end = closing.end() if closing else len(html)
            elif (end := end_of(m.end())) >= 0:
                name, closes, attributes, end = m[2].lower(), bool(m[1]), html[m.end() : end], end + 1
            else:
                end = html.find(">", at) + 1
        elif html[at + 1 : at + 2] in ("!", "?") or html[at + 1 : at + 3] in ("/!", "/?"):
            end = html.find(">", at) + 1
        if end > 0:
            yield start, end, name, closes, attributes
        at = html.find("<", end if end > 0 else at + 1)
    at = html.find("<!--", at) if at >= 0 else -1
    if at >= 0:  # nothing can end any more, and a comment takes what is left
        yield at, len(html), None, False, ""


def blocks(html: str) -> list[tuple[str, int]]:
    """(text, zone) of the blocks of a page that have text, in order."""
    out: list[tuple[str, int]] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []
    zone, at, in_link, unlinked = OPEN, 0, False, False
    links: list[int] = []  # which blocks are links and nothing else
    open_names: Counter[str] = Counter()

    def pop() -> str:
        nonlocal zone
        name = stack.pop()[0]
        open_names[name] -= 1
        zone = stack[-1][1] if stack else OPEN
        return name

    def close() -> None:
        nonlocal unlinked
        if held:
            text = " ".join(html_entities.unescape("".join(held)).split())
            held.clear()
            if text:
                if not unlinked:
                    links.append(len(out))
                out.append((text, zone))
        unlinked = False

    def hold(text: str) -> None:
        nonlocal unlinked
        held.append(text)
        unlinked = unlinked or not in_link and not text.isspace()

    for start, end, tag, closes, attributes in tags(html):
        if start > at:
            hold(html[at:start])
        at = end
        if tag is None:
            continue
        if tag == "a":
            in_link = not closes
        if tag in _INLINE and "=" not in attributes:
            continue
        marked = "=" in attributes and not closes
        away = marked and tag not in _NEVER_AWAY and _says_away(attributes)
        if tag in _INLINE and not away:
            if closes and stack and stack[-1][0] == tag:
                close()
                pop()
            continue
        close()
        if closes:
            if open_names[tag]:
                while pop() != tag:
                    pass
            continue
        if tag in _VOID:
            continue
        if stack and stack[-1][0] not in _TRACKED and stack[-1][0] not in _AWAY:  # an unclosed p, li or the like ends here
            pop()
        if tag == "article" and zone == CONTENT and marked and _says_away(attributes, _TEASER):
            new = BOILERPLATE  # a comment or a teaser inside of the article or main part
        elif tag in ("article", "main") or 'role="main"' in attributes:
            new = _ASIDE if away or zone in (BOILERPLATE, _ASIDE) else CONTENT
        elif zone == _ASIDE and not (away or tag in _AWAY):
            new = _ASIDE
        elif away or tag in _AWAY or zone == BOILERPLATE or tag == "header" and zone != CONTENT:
            new = BOILERPLATE
        else:
            new = zone
        if tag in _TRACKED or tag in _AWAY or new != zone:
            if not attributes.rstrip().endswith("/"):
                stack.append((tag, new))
                open_names[tag] += 1
                zone = new
    if html[at:]:
        hold(html[at:])
    close()
    zones = {z for _, z in out}
    # an article inside of a menu or the like is main text if the page has no other and less open text than that:
    # wrappers have odd names
    sizes = {z: sum(len(text) for text, own in out if own == z) for z in (OPEN, _ASIDE)}
    instead = CONTENT if CONTENT not in zones and sizes[_ASIDE] > sizes[OPEN] else BOILERPLATE
    if CONTENT in zones or instead == CONTENT and _ASIDE in zones:
        for i in links:
            if out[i][1] == OPEN:
                out[i] = (out[i][0], BOILERPLATE)
    return [(text, instead if z == _ASIDE else z) for text, z in out]


def suffix_order(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order of their first ``depth`` tokens or more, rank of each suffix): equal ranks, equal prefixes."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    n, reach = len(rank), 1
    while reach < depth:
        step = min(reach, depth - reach)
        later = np.full(n, -1, np.int64)
        later[: max(n - step, 0)] = rank[step:]
        rank = np.unique(rank * (n + 1) + later + 1, return_inverse=True)[1].astype(np.int64)
        reach += step
    return np.argsort(rank, kind="stable"), rank


def repeated(pages: list[list[str]], min_words: int) -> list[np.ndarray]:
    """For each page's words: which are covered by a run of ``min_words`` words that another page has too."""
    lengths = np.array([len(p) for p in pages])
    if not lengths.sum():
        return [np.zeros(0, bool) for _ in pages]
    codes: dict[str, int] = {}
    words = np.fromiter((codes.setdefault(w, len(codes)) for p in pages for w in p), np.int64, int(lengths.sum()))
    ends = np.cumsum(lengths)
    tokens = np.insert(words, ends, len(codes) + np.arange(len(pages)))  # a mark of its own after each page
    page = np.insert(np.repeat(np.arange(len(pages)), lengths), ends, np.arange(len(pages)))
    alike = {}
    same = np.array([alike.setdefault(tuple(p), i) for i, p in enumerate(pages)])
    order, rank = suffix_order(tokens, min_words)
    of = same[page[order]]
    level = rank[order]
    # in the order, a run of equal ranks is one repeated string; more than one page in it makes it boilerplate
    first = np.ones(len(order), bool)
    first[1:] = level[1:] != level[:-1]
    run = np.cumsum(first) - 1
    low, high = np.full(run[-1] + 1, len(pages)), np.zeros(run[-1] + 1, np.int64)
    np.minimum.at(low, run, of)
    np.maximum.at(high, run, of)
    starts = np.zeros(len(tokens) + 1, np.int64)
    hit = order[(low != high)[run]]
    np.add.at(starts, hit, 1)
    np.add.at(starts, np.minimum(hit + min_words, len(tokens)), -1)
    covered = np.cumsum(starts)[:-1] > 0
    return np.split(np.delete(covered, ends + np.arange(len(pages))), ends[:-1])


def host(url: Column) -> Column:
    """Between ``//`` and the next slash, question mark or hash, in lower case and without a port."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


class Rows:
    """The words of a batch of pages in rows: of each page those outside articles, then of each page those inside.

    The two are hosts of their own: a headline is no repeat of its page's breadcrumbs. Every run of ``min_words`` words
    of a row has a representative, the smallest hash of the shorter runs in it, so equal runs of a host have equal ones.
    """

    def __init__(self, group: pa.Table, min_words: int):
        blocks = group["blocks"].combine_chunks()
        self.min_words, n = min_words, len(blocks)
        flat = blocks.flatten()
        self.text, self.zone = flat.field("text"), flat.field("zone").to_numpy(zero_copy_only=False)
        self.page = np.repeat(np.arange(n), blocks.value_lengths().to_numpy(zero_copy_only=False))
        texts = FlatTexts(self.text)
        self.block_words = texts.words
        row = (self.page + n * (self.zone == CONTENT))[texts.owner]
        self.order = np.argsort(row, kind="stable")
        self.hashes, self.row = texts.hashes[self.order], row[self.order]
        self.lengths = np.bincount(row, minlength=2 * n)
        ends = np.cumsum(self.lengths)
        place = np.arange(len(row)) - (ends - self.lengths)[self.row]
        # copies of a row are one: its class is a sum over its words and their places
        mixed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(common.mix64(self.hashes ^ common.mix64(place)))])
        self.of_row = common.mix64(mixed[ends] - mixed[ends - self.lengths])
        hosts = [h.encode() for h in group["host"].to_pylist()]
        hashed = common.WordHashes(1 << 40)
        self.by_host = np.concatenate([hashed.of(hosts), hashed.of([h + b"/inside" for h in hosts])])
        #: where a run of min_words words starts
        self.at = np.flatnonzero(place + min_words <= self.lengths[self.row])
        self.distinct, self.many, self.spot = np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, np.int64)
        if len(self.at):
            self._represent()

    def _represent(self) -> None:
        width = (self.min_words + 1) // 2
        n = len(self.row) - width + 1
        short = self.by_host[self.row[:n]]
        with np.errstate(over="ignore"):
            for k in range(width):
                short = common.mix64(short * np.uint64(3) + self.hashes[k : k + n])
        smallest = short[self.at]
        for k in range(1, self.min_words - width + 1):
            np.minimum(smallest, short[self.at + k], out=smallest)
        smallest >>= np.uint64(64 - BITS)
        row = self.row[self.at]
        new = np.append(True, (smallest[1:] != smallest[:-1]) | (row[1:] != row[:-1]))
        heads = np.flatnonzero(new)
        order = np.argsort(smallest[heads], kind="stable")
        keys, classes = smallest[heads][order], self.of_row[row[heads]][order]
        first = np.append(True, keys[1:] != keys[:-1])
        cut = np.flatnonzero(first)
        #: distinct representatives, ascending, and whether rows of more than one class have them
        self.distinct = keys[cut]
        self.many = np.minimum.reduceat(classes, cut) != np.maximum.reduceat(classes, cut)
        spot = np.empty(len(order), np.int64)
        spot[order] = np.cumsum(first) - 1
        self.spot = spot[np.cumsum(new) - 1]

    def stretches(self, elsewhere: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of words, lengths of stretches) of all runs whose representative other rows have: those of this
        batch, or, by one flag per distinct one, those ``elsewhere``. No other run can be a repeat."""
        runs = self.at[(self.many | elsewhere)[self.spot]]
        inside = np.zeros(len(self.row) + 1, np.int64)
        np.add.at(inside, runs, 1)
        np.add.at(inside, runs + self.min_words, -1)
        words = np.flatnonzero(np.cumsum(inside)[:-1] > 0)
        new = np.ones(len(words), bool)
        new[1:] = (np.diff(words) != 1) | (np.diff(self.row[words]) != 0)
        return words, np.diff(np.append(np.flatnonzero(new), len(words)))


class Prefixes:
    """The suffix array of a batch's stretches, one host after the other: its distinct (host, ``min_words`` words)."""

    def __init__(self, rows: Rows, elsewhere: np.ndarray, buckets: int):
        self.rows, min_words = rows, rows.min_words
        words, lengths = rows.stretches(elsewhere)
        ends = np.cumsum(lengths)
        stretch = np.repeat(np.arange(len(lengths)), lengths)
        start = np.flatnonzero(np.arange(len(words)) + min_words <= ends[stretch])
        #: where a run of min_words words starts
        self.at = words[start]
        self.distinct, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.low = self.high = self.bucket = np.zeros(0, np.uint64)
        if not len(self.at):
            return
        codes = np.unique(rows.hashes[words], return_inverse=True)[1]
        marked = np.insert(codes, ends, len(words) + np.arange(len(lengths)))  # a mark of its own after each stretch
        rank = suffix_order(marked, min_words)[1][start + stretch[start]]
        host_of = np.unique(rows.by_host, return_inverse=True)[1]
        row = rows.row[self.at]
        _, first, run = np.unique(rank * len(rows.by_host) + host_of[row], return_index=True, return_inverse=True)
        head = self.at[first]
        key = rows.by_host[rows.row[head]]
        with np.errstate(over="ignore"):
            for k in range(min_words):
                key = common.mix64(key * np.uint64(3) + rows.hashes[head + k])
        # distinct runs by bucket, then by hash; two runs of one hash (not expected) stay two entries
        bucket = (key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        order = np.argsort(key, kind="stable")
        self.distinct, self.bucket = key[order], bucket[order].astype(np.int64)  # ascending keys have ascending buckets
        new = np.empty_like(order)
        new[order] = np.arange(len(order))
        self.place = new[run]
        members = np.argsort(self.place, kind="stable")
        cut = np.searchsorted(self.place[members], np.arange(len(order)))
        classes = rows.of_row[row][members]
        self.low, self.high = np.minimum.reduceat(classes, cut), np.maximum.reduceat(classes, cut)

    def covered(self, repeated: np.ndarray) -> np.ndarray:
        """For each word, in the order of the blocks: is it covered by a run that is ``repeated`` (one flag per distinct run)?"""
        starts = np.zeros(len(self.rows.row) + 1, np.int64)
        hit = self.at[repeated[self.place]] if len(self.at) else self.at
        np.add.at(starts, hit, 1)
        np.add.at(starts, hit + self.rows.min_words, -1)
        out = np.empty(len(self.rows.row), bool)
        out[self.rows.order] = np.cumsum(starts)[:-1] > 0
        return out


def _pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 9))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _squeeze(values: np.ndarray) -> bytes:
    """Whole numbers as zstandard-compressed byte planes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unsqueeze(raw: bytes, kind: str, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(raw, n * size, "zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _flags(group: pa.Table, flags: np.ndarray) -> pa.Table:
    """Answers to chunks of ``n`` keys each: one bit for every key."""
    cut = np.cumsum([0, *group["n"].to_pylist()])
    packed = [np.packbits(flags[a:b]).tobytes() for a, b in zip(cut, cut[1:])]
    return pa.table({"batch": group["batch"], "bucket": group["bucket"], "n": group["n"], "flags": pa.array(packed, pa.binary())})


def _bits(found: pa.Table) -> np.ndarray:
    """The answers to a batch's chunks as one array, for its keys in ascending order."""
    found = found.sort_by("bucket")
    bits = [np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool) for n, x in zip(found["n"].to_pylist(), found["flags"].to_pylist())]
    return np.concatenate([np.zeros(0, bool), *bits])


def extract(pages: DataFrame, min_words: int = 8, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(page_id, url, text, n_blocks, n_outside, n_repeated) of every row of (page_id, url, html).

    ``n_outside`` counts words outside the article, ``n_repeated`` those of them that are covered by repeats.
    ``batch_bytes`` of html share a suffix array; results do not depend on it.
    """
    spark = pages.sparkSession
    common.prepare(spark)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host(F.col("url")).alias("host"))
    id_type = pages.schema["page_id"].dataType.simpleString()
    where = pa.list_(pa.struct([("text", pa.string()), ("zone", pa.int8())]))

    def read(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        size = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal number, size
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            batch, number, size = (part << 32) | number, number + 1, 0
            yield pa.RecordBatch.from_arrays([pa.array([batch], pa.int64()), pa.array([_pack(table)], pa.binary())], ["batch", "pages"])

        def some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            nonlocal size
            found = [[{"text": t, "zone": z} for t, z in blocks(x)] for x in batch.column(2).to_pylist()]
            held.append(pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, where), batch.column(3)], ["page_id", "url", "blocks", "host"]))
            size += batch.column(2).nbytes
            if size >= batch_bytes:
                yield from close()

        yield from common.in_batches(some, rows=512, size=min(batch_bytes, 2 << 20))(stream)
        if held:
            yield from close()

    # bucketed by batch as it is written: what comes back to the batches meets their pages where those lie
    path, name = common.stage_path(spark, "pages"), f"pages_{uuid.uuid4().hex}"
    pieces = 4 * common.parallelism(spark)
    rows.mapInArrow(read, "batch long, pages binary").write.format("parquet").bucketBy(pieces, "batch").option("path", path).saveAsTable(name)
    made = spark.table(name)
    buckets = max(pieces, made.count() // 8)

    def represent(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in ((x.as_py(), y.as_py()) for given in stream for x, y in zip(given.column(0), given.column(1))):
            keys = Rows(pa.ipc.open_stream(raw).read_all(), min_words).distinct
            cut = np.searchsorted(keys * np.uint64(buckets) >> np.uint64(BITS), np.arange(buckets + 1))
            out = [(b, keys[cut[b] : cut[b + 1]]) for b in np.flatnonzero(np.diff(cut)).tolist()]
            columns = [[batch] * len(out), [b for b, _ in out], [len(x) for _, x in out], [_squeeze(np.diff(x, prepend=np.uint64(0))) for _, x in out]]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], ["batch", "bucket", "n", "keys"])
            common.give_back()

    def meet(group: pa.Table) -> pa.Table:
        lengths = group["n"].to_pylist()
        keys = np.concatenate([np.cumsum(_unsqueeze(raw, "<u8", n), dtype=np.uint64) for n, raw in zip(lengths, group["keys"].to_pylist())])
        order = np.argsort(keys, kind="stable")
        again = keys[order][1:] == keys[order][:-1]
        elsewhere = np.zeros(len(keys), bool)
        elsewhere[order[1:][again]] = elsewhere[order[:-1][again]] = True
        return _flags(group, elsewhere)

    def deal(given: pa.Table, found: pa.Table) -> pa.Table:
        names, types = ["batch", "bucket", "n", "keys", "which", "classes"], [pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 3]
        runs = Prefixes(Rows(pa.ipc.open_stream(given["pages"][0].as_py()).read_all(), min_words), _bits(found), buckets)
        batch, out = given["batch"][0].as_py(), []
        cut = np.searchsorted(runs.bucket, np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cut)).tolist():
            some = slice(cut[b], cut[b + 1])
            keys, low = runs.distinct[some], runs.low[some]
            # one class of pages per run, as its place among the chunk's classes; 0: two or more
            classes, which = np.unique(low, return_inverse=True)
            which = np.where(low != runs.high[some], 0, which + 1).astype("<u4")
            out.append((batch, b, len(keys), _squeeze(np.diff(keys, prepend=np.uint64(0))), _squeeze(which), classes.tobytes()))
        common.give_back()
        return pa.table([pa.array([row[i] for row in out], t) for i, t in enumerate(types)], names)

    def decide(group: pa.Table) -> pa.Table:
        keys, classes, known, lengths = [], [], [], group["n"].to_pylist()
        for n, raw, which, of in zip(lengths, *(group[c].to_pylist() for c in ("keys", "which", "classes"))):
            with np.errstate(over="ignore"):
                keys.append(np.cumsum(_unsqueeze(raw, "<u8", n), dtype=np.uint64))
            which = _unsqueeze(which, "<u4", n).astype(np.int64)
            known.append(which == 0)
            classes.append(np.frombuffer(of, np.uint64)[np.maximum(which - 1, 0)])
        keys, classes, known = map(np.concatenate, (keys, classes, known))
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
        run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
        # a run of equal prefixes is a repeat if it has more than one class of pages
        many = np.minimum.reduceat(classes[order], first) != np.maximum.reduceat(classes[order], first)
        many |= np.logical_or.reduceat(known[order], first)
        repeated = np.empty(len(keys), bool)
        repeated[order] = many[run]
        return _flags(group, repeated)

    answer = "batch long, bucket int, n long, flags binary"
    first = made.mapInArrow(represent, "batch long, bucket int, n long, keys binary").groupBy("bucket").applyInArrow(meet, answer)
    first = common.stage(first, "representatives")
    chunks = made.groupBy("batch").cogroup(first.groupBy("batch")).applyInArrow(deal, "batch long, bucket int, n long, keys binary, which binary, classes binary")
    second = chunks.groupBy("bucket").applyInArrow(decide, answer)
    flags = first.withColumn("second", F.lit(False)).unionByName(second.withColumn("second", F.lit(True)))

    def clean(given: pa.Table, found: pa.Table) -> pa.Table:
        group = pa.ipc.open_stream(given["pages"][0].as_py()).read_all()
        rows = Rows(group, min_words)
        runs = Prefixes(rows, _bits(found.filter(pc.invert(found["second"]))), buckets)
        covered = runs.covered(_bits(found.filter(found["second"])))
        n = len(group)
        add = lambda x, weight: np.bincount(x, weight, n).astype(np.int64)
        ends = np.cumsum(rows.block_words)
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(covered)])
        hits = total[ends] - total[ends - rows.block_words]
        inside, whole = rows.zone == CONTENT, hits == rows.block_words
        n_outside, n_inside = rows.lengths[:n], rows.lengths[n:]
        copy = 2 * add(rows.page, hits * inside) > n_inside  # of an article, with changes
        stays = inside | (rows.zone == OPEN) & ~whole
        cut = stays & ~inside & (hits > 0)
        fewer = []
        for b in np.flatnonzero(cut).tolist():
            gone = covered[ends[b] - rows.block_words[b] : ends[b]]
            fewer.append(" ".join(w for w, x in zip(rows.text[b].as_py().split(" "), gone) if not x))
        text = pc.replace_with_mask(rows.text, pa.array(cut), pa.array(fewer, pa.string())).filter(pa.array(stays))
        left = pa.StructArray.from_arrays([text, pa.array((inside & whole & ~copy[rows.page])[stays])], ["text", "suspect"])
        offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(add(rows.page, stays))])
        counts = {"n_blocks": add(rows.page, None), "n_outside": n_outside, "n_repeated": add(rows.page, hits * ~inside)}
        common.give_back()
        return pa.table(
            {
                "batch": pa.array([given["batch"][0].as_py()] * n, pa.int64()),
                "place": pa.array(range(n), pa.int32()),
                "page_id": group["page_id"],
                "url": group["url"],
                "host": group["host"],
                "article": pa.array(rows.of_row[n:].view(np.int64), mask=n_inside == 0),
                "blocks": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), left),
                **{name: pa.array(values, pa.int64()) for name, values in counts.items()},
            }
        )

    counted = "n_blocks long, n_outside long, n_repeated long"
    out = f"batch long, place int, page_id {id_type}, url string, host string, article long, blocks array<struct<text string, suspect boolean>>, {counted}"
    cleaned = common.stage(made.groupBy("batch").cogroup(flags.groupBy("batch")).applyInArrow(clean, out), "cleaned", compression="zstd")
    spark.sql(f"DROP TABLE {name}")
    common.drop_stage(spark, path)
    return without_notices(cleaned).select("page_id", "url", "text", "n_blocks", "n_outside", "n_repeated")


def without_notices(cleaned: DataFrame) -> DataFrame:
    """``cleaned`` pages with ``text``: their blocks without those suspects that are notices of the host.

    Only suspects are compared, by 64-bit hashes, and counted once for each host, block and article before they meet.
    """
    blocks = cleaned.select("batch", "place", "host", "article", F.posexplode("blocks").alias("at", "block")).where("block.suspect")
    blocks = blocks.select("batch", "place", "host", "article", "at", F.xxhash64("block.text").alias("hash"))
    stands = blocks.select("host", "hash", "article").distinct().groupBy("host", "hash").agg(F.count("*").alias("n"))
    articles = cleaned.where(F.col("article").isNotNull()).select("host", "article").distinct()
    articles = articles.groupBy("host").agg(F.count("*").alias("of"))
    often = stands.where(F.col("n") >= NOTICE_PAGES).join(articles, "host").where(F.col("n") * NOTICE_SHARE >= F.col("of"))
    gone = blocks.join(often.select("host", "hash"), ["host", "hash"]).groupBy("batch", "place").agg(F.collect_set("at").alias("gone"))
    stays = lambda block, at: ~F.coalesce(F.array_contains("gone", at), F.lit(False))
    text = F.array_join(F.transform(F.filter("blocks", stays), lambda block: block["text"]), "\n")
    # pages without suspects, nearly all, have nothing to lose and stay where they are
    suspected = F.exists("blocks", lambda block: block["suspect"])
    fewer = cleaned.where(suspected).join(gone, ["batch", "place"], "left").withColumn("text", text).drop("gone")
    return cleaned.where(~suspected).withColumn("text", F.array_join("blocks.text", "\n")).unionByName(fewer)
