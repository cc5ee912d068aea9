"""Operator 8: main text of pages, without the passages that a host repeats.

A page is parsed into blocks. A block inside `article` or `main` is content. All blocks outside content form the page's token
stream, which is written, and the host suffix array decides on them first: tokens inside a repeat of the host are cut. Where it finds no repeat, names decide: a block inside an element that is
boilerplate by its name, role, whole class name or id (fixed lists below) is dropped, and any other one stays, as lines of its
unique runs. An element marked by class or id alone that holds an `article` or `main` is a wrapper and its mark doesn't count,
unless it is a comment thread (each comment is an `article` there); elements and roles such as nav or footer keep what they hold
out. Ids of headings are anchors. Content is never cut for being repeated, as the contract asks for the whole article.

The array: a suffix starts at every token and is written as its next DEPTH tokens (the tokens themselves; those over LONG_TOKEN
characters as a 128-bit digest). Equal suffixes that a task meets together are one row with their pages and places. Rows are sorted
by range partitions of (host, tokens, first page). One pass over the
sorted rows takes the common prefix of each row with the row before it; rows that share the first L tokens are an interval, and
its distinct pages are counted. RULES say which intervals are repeats: 32 tokens on 4 pages and 2 % of the host's
pages, or 6 tokens, such as a menu, on 4 pages and half of the host's pages. A longer maximal repeat is the run of such intervals
at its places, so covering each of them covers it whole. Pages of a host whose blocks are all equal count once. So copies of an
article, quotes and common phrases stay, however large the host grows; on a host with fewer than 4 distinct pages nothing is cut.

Scale: before suffixes are sorted, a count sketch of the 6-token windows (2^SKETCH_BITS counters of two bytes, of fixed size, summed by
Spark and broadcast) drops those that start no repeat for certain: by each rule, all windows of its tokens must be on as many pages as
it asks for (its share counts for the LARGE_HOSTS hosts of most pages); where the sketch fills up it lets more through. An interval may lie in
several partitions: each gives its count, and the counts are summed. Rows of equal suffixes of very many pages differ in their first
page, so no range holds them all. Pages are parsed again for the result, so that content is neither written nor shuffled before it;
the text of pages with undecided blocks is shuffled, to meet its repeats. Where there are any, the pages are parsed a third time.
Suffixes are shuffled once, a step's shuffle files go when it has run, and of its tables only the places of repeats stay, which the
result reads.

Defined results: null or empty html gives an empty text; null url belongs to the host ''; rows are known by host and blocks, so
repeated or null page_ids are no special case; text outside any tag is an undecided block; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from hashlib import blake2b
from html import unescape
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.llm.common import cut, scratch, settings, table, tidy
from sessionloom.llm.jaccard_join import TIDY_SHUFFLES
from sessionloom.llm.shingles import mix

#: A passage repeats if it has so many tokens, on so many pages of its host, which are such a share of the host's pages.
RULES = ((32, 4, 0.02), (6, 4, 0.5))
SHORTEST, DEPTH = min(r[0] for r in RULES), max(r[0] for r in RULES)
LONG_TOKEN = 64
SKETCH_BITS = 22
MOST = 65535
SLICES = 16
LARGE_HOSTS = 10_000
PAGES_AT_ONCE = 200
#: A task hands on its rows of equal suffixes when they hold so many, at the end of a page.
SUFFIXES_AT_ONCE = 100_000
STEP = np.uint64(0x9E3779B97F4A7C15)
CONTENT, UNDECIDED, BOILERPLATE = 0, 1, 2
FIRM, SOFT = 1, 2

# Element names, roles, and whole class names and ids that mark boilerplate, those of comment threads; headings; elements that end a block; void ones.
BOILERPLATE_TAGS = frozenset("nav header footer aside form script style noscript template head title button select option iframe dialog menu svg canvas object textarea label fieldset".split())
ALSO_IN_CONTENT = BOILERPLATE_TAGS - {"header"}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
MARKS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation sidebar footer header masthead cookie cookies consent gdpr notice notices newsletter subscribe subscription signup login share sharing social related recommended breadcrumb breadcrumbs comment comments commentlist reply replies disqus respond popup modal overlay widget pagination pager copyright".split())
THREADS = frozenset("comment comments commentlist reply replies disqus respond".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_ITSELF = {"li": "li", "dt": "dd dt", "dd": "dd dt", "tr": "tr", "td": "td th", "th": "td th", "option": "option"}

_OPENING = re.compile(r"<(?:(!--)|(!\[CDATA\[)|([!?])|(/?)([a-zA-Z][^\s/>]*))", re.I)
_TAG_END = re.compile(r">|=\s*([\"'])")
_RAW = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "noscript", "template", "textarea", "title", "svg", "iframe")}
_ATTR = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-z0-9]+")


def _attributes(attrs: str) -> dict[str, str]:
    return {kind.lower(): (a or b or c).lower() for kind, a, b, c in reversed(_ATTR.findall(attrs))}


def _marked(name: str, attrs: str, in_content: bool) -> int:
    """FIRM by element, role or comment thread, SOFT by another class name or id, 0 if not boilerplate."""
    if name in (ALSO_IN_CONTENT if in_content else BOILERPLATE_TAGS):
        return FIRM
    if not attrs or name in ("body", "html", "article", "main"):
        return 0
    own = _attributes(attrs)
    if own.get("role") in ROLES:
        return FIRM
    names = set(own.get("class", "").split())
    if name not in HEADINGS:  # a heading's id is an anchor
        names.add(own.get("id", "").strip())
    return 0 if MARKS.isdisjoint(names) else SOFT if THREADS.isdisjoint(names) else FIRM


def tags(html: str):
    """(start, end, name or None, whether it closes, attributes) of tags, comments and declarations, each with what it hides (scripts and the like).

    One pass: what is looked at is passed over. A quote counts as one behind `=`, if it is closed; where a tag would then have no end, quotes count no more. A comment without an end
    hides the rest; behind the last `>` nothing else is a tag.
    """
    last, at, quotes = html.rfind(">"), 0, True
    open_quotes = {'"', "'"}  # those of which another may follow

    def tag_end(begin: int) -> int:
        nonlocal quotes
        k = begin
        while quotes:
            m = _TAG_END.search(html, k)
            if m is None:
                quotes = False
                break
            if m[1] is None:
                return m.start()
            k = m.end()
            if m[1] in open_quotes:
                shut = html.find(m[1], k)
                if shut < 0:
                    open_quotes.discard(m[1])
                else:
                    k = shut + 1
        return html.find(">", begin)

    while m := _OPENING.search(html, at):
        begin = m.start()
        if m[1]:
            end = html.find("-->", m.end())
            at = len(html) if end < 0 else end + 3
            yield begin, at, None, False, ""
            continue
        if begin > last:
            at = begin + 1 if (at := html.find("<!--", begin)) < 0 else at
            if html.startswith("<!--", at):
                continue
            return
        if m[2]:
            at = m.end()
            yield begin, at, None, False, ""
        elif m[3]:
            at = html.find(">", begin) + 1
            yield begin, at, None, False, ""
        else:
            name, end = m[5].lower(), tag_end(m.end())
            at = end + 1
            if not m[4] and name in _RAW:
                shut = _RAW[name].search(html, at)
                at = shut.end() if shut else len(html)
                yield begin, at, None, False, ""
            else:
                yield begin, at, name, bool(m[4]), html[m.end() : end]


def blocks(html: str | None) -> list[tuple[int, str]]:
    """(kind, text) of the blocks of a page, in order, without empty ones. Work is in proportion to the page, however its tags are nested or broken."""
    out: list[tuple[int, str]] = []
    held: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # open elements, the kind of text inside, and whether it is left out of its block
    count: dict[str, int] = {}  # open elements by name
    block_at: list[int] = []  # the places of block elements in the stack
    kind = UNDECIDED
    # each block element with a soft mark has a kind of its own, below 0: [kind around it, whether it holds an article or main, the kind around all such elements]
    soft: list[list] = []

    def resolved(k: int) -> int:
        """What holds an article does so for all marked elements around it."""
        return k if k >= 0 else soft[-k - 1][2] if soft[-k - 1][1] else BOILERPLATE

    def close() -> None:
        text = " ".join(unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((kind, text))

    def push(name: str, inside: int, left_out: bool) -> None:
        if name in BLOCKS:
            block_at.append(len(stack))
        count[name] = count.get(name, 0) + 1
        stack.append((name, inside, left_out))

    def drop(depth: int) -> None:
        for n, _, _ in stack[depth:]:
            count[n] -= 1
        del stack[depth:]
        while block_at and block_at[-1] >= depth:
            block_at.pop()

    at = 0
    html = html or ""
    for begin, end, name, closes, attrs in tags(html):
        if begin > at and not (stack and stack[-1][2]):
            held.append(html[at:begin])
        at = end
        if name is None:
            continue
        block = name in BLOCKS
        if block:
            close()
        elif name == "br":
            held.append(" ")
        if closes:
            if count.get(name):
                depth = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name)
                if block_at and block_at[-1] >= depth:
                    close()
                drop(depth)
        elif name not in VOID and not attrs.endswith("/"):
            # the nearest block ends where it is a paragraph, or what the new one ends
            if block and block_at and stack[block_at[-1]][0] in ("p", *CLOSES_ITSELF.get(name, "").split()):
                drop(block_at[-1])
            inside, left_out = stack[-1][1:] if stack else (UNDECIDED, False)
            mark = FIRM if left_out or inside == BOILERPLATE else _marked(name, attrs, resolved(inside) == CONTENT)
            if not block:  # marked elements inside a block are cut out of it
                push(name, inside, bool(mark) and inside != BOILERPLATE)
            elif mark == FIRM:
                push(name, BOILERPLATE, False)
            elif name in ("article", "main"):
                k = inside
                while k < 0 and not soft[-k - 1][1]:  # what is around it is a wrapper
                    soft[-k - 1][1] = True
                    k = soft[-k - 1][0]
                push(name, CONTENT, False)
            elif mark == SOFT:
                soft.append([inside, False, inside if inside >= 0 else soft[-inside - 1][2]])
                push(name, -len(soft), False)
            else:
                push(name, inside, False)
        now = stack[-1][1] if stack else UNDECIDED
        if now != kind:
            close()
            kind = now
    if not (stack and stack[-1][2]):
        held.append(html[at:])
    close()
    return [(resolved(k), text) for k, text in out]


def host_of(url: str | None) -> str:
    m = re.match(r"[^/?#]*?://([^/?#]*)", url or "")
    return m.group(1).lower() if m else ""


def _parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host, copy (equal for pages with equal blocks), kinds (a byte for each block), content, outer, undecided of every page."""
    names = ["page_id", "url", "host", "copy", "kinds", "content", "outer", "undecided"]

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, PAGES_AT_ONCE):
                part = b.slice(lo, PAGES_AT_ONCE)
                cols: list[list] = [[] for _ in names[2:]]
                for url, html in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    found = blocks(html)
                    kinds = bytes(k for k, _ in found)
                    whole = kinds + "\n".join(t for _, t in found).encode("utf-8", "surrogatepass")
                    row = (host_of(url), blake2b(whole, digest_size=16).digest(), kinds, [t for k, t in found if k == CONTENT], [t for k, t in found if k != CONTENT], UNDECIDED in kinds)
                    for c, v in zip(cols, row, strict=True):
                        c.append(v)
                text = pa.list_(pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.binary(), pa.binary(), text, text, pa.bool_()), strict=True))], names=names)

    return pages.mapInArrow(tidy(run), "page_id long, url string, host string, copy binary, kinds binary, content array<string>, outer array<string>, undecided boolean")


def _stream(outer: list[str]) -> list[str]:
    return [t for text in outer for t in text.split(" ")]


def _window_keys(tokens: list[str], host: str, known: dict[str, int]) -> np.ndarray:
    """64-bit keys of the host and each run of SHORTEST tokens, for the sketch."""
    for t in {host, *tokens}.difference(known):
        known[t] = int.from_bytes(blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    h = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
    n = max(0, h.size - SHORTEST + 1)
    key = np.full(n, known[host], np.uint64)
    for k in range(SHORTEST):
        key = key * STEP + h[k : k + n]
    return mix(key) >> np.uint64(64 - SKETCH_BITS)


def _sketch(outer: DataFrame) -> np.ndarray:
    """How often windows occur at least, each once a page: counters that stop at MOST."""
    width = (1 << SKETCH_BITS) // SLICES

    def count(batches):
        total = np.zeros(1 << SKETCH_BITS, np.uint16)
        for b in batches:
            for lo in range(0, b.num_rows, PAGES_AT_ONCE):
                part, known = b.slice(lo, PAGES_AT_ONCE), {}
                at = [np.unique(_window_keys(_stream(texts), host, known)) for host, texts in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)]
                place, n = np.unique(np.concatenate([np.empty(0, np.uint64), *at]), return_counts=True)
                total[place] = np.minimum(total[place] + n, MOST)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([x.tobytes() for x in total.reshape(SLICES, width)], pa.binary())], names=["slice", "blob"])

    def add(batches):
        """Sums of the counters met in a task."""
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                total[k] = np.minimum(total.get(k, 0) + np.frombuffer(blob, np.uint16).astype(np.uint32), MOST)
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array([v.astype(np.uint16).tobytes() for v in total.values()], pa.binary())], names=["slice", "blob"])

    kind = "slice int, blob binary"
    rows = outer.select("host", "outer").mapInArrow(tidy(count), kind).repartition(SLICES, "slice").mapInArrow(tidy(add), kind).toArrow()  # SLICES rows
    out = np.zeros((SLICES, width), np.uint16)
    for k, blob in zip(rows.column("slice").to_pylist(), rows.column("blob").to_pylist(), strict=True):
        out[k] = np.minimum(out[k] + np.frombuffer(blob, np.uint16).astype(np.uint32), MOST)
    return out.ravel()


def possible_starts(counts: np.ndarray, of: int) -> np.ndarray:
    """Places where a repeat may start, by how often the windows of a page occur at least on its host of that many pages at least."""
    out = np.zeros(counts.size, bool)
    for length, least, share in RULES:
        span = length - SHORTEST + 1  # windows of a repeat
        if counts.size >= span:
            few = np.append(0, np.cumsum(counts < min(MOST, max(least, share * of))))
            out[: counts.size - span + 1] |= few[span:] == few[:-span]
    return np.flatnonzero(out)


WEIGHTS = [f"w{k}" for k in range(len(RULES))]


def _suffixes(outer: DataFrame, hosts: DataFrame) -> DataFrame:
    """host, tokens (the next DEPTH, each with a space behind it), rows and places where they stand, first (of the rows), and for each rule how many rows show the leading tokens there for the first time.

    Suffixes whose leading tokens are on too few pages of the host are left out. outer: distinct pages; hosts: how many each host has.
    """
    large = hosts.orderBy(F.desc("of"), "host").limit(LARGE_HOSTS).toArrow()
    shipped = outer.sparkSession.sparkContext.broadcast((_sketch(outer), dict(zip(*(c.to_pylist() for c in large.columns), strict=True))))
    names = ["host", "tokens", "first", "rows", "places", *WEIGHTS]

    def packed(held: dict[tuple[str, str], list]):
        entries = list(held.values())
        cols = [[h for h, _ in held], [t for _, t in held], [e[0][0] for e in entries], *([e[k] for e in entries] for k in range(2 + len(RULES)))]
        held.clear()
        kinds = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.int64()] * len(RULES))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    def run(batches):
        held: dict[tuple[str, str], list] = {}  # rows, places, and the weight by each rule
        size = 0
        sketch, pages = shipped.value
        for b in batches:
            for lo in range(0, b.num_rows, PAGES_AT_ONCE):
                part, known = b.slice(lo, PAGES_AT_ONCE), {}
                for row, host, outer in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    tokens = _stream(outer)
                    often = possible_starts(sketch[_window_keys(tokens, host, known)], pages.get(host, 0))
                    if often.size:
                        tokens = [t if len(t) <= LONG_TOKEN else "\0" + blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest() for t in tokens]
                    met: set[tuple[str, ...]] = set()
                    for i in often.tolist():
                        entry = held.setdefault((host, " ".join(tokens[i : i + DEPTH]) + " "), [[], [], *[0] * len(RULES)])
                        entry[0].append(row)
                        entry[1].append(i)
                        for k, (length, _, _) in enumerate(RULES):
                            lead = tuple(tokens[i : i + length])
                            if len(lead) == length and lead not in met:
                                entry[2 + k] += 1
                                met.add(lead)
                    size += often.size
                    if size >= SUFFIXES_AT_ONCE:
                        yield packed(held)
                        size = 0
        if held:
            yield packed(held)

    return outer.select("row", "host", "outer").mapInArrow(tidy(run), "host string, tokens string, first long, rows array<long>, places array<int>, " + ", ".join(f"{w} long" for w in WEIGHTS))


def common_prefixes(hosts: pa.Array, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted suffixes: how many leading tokens each shares with the one before it (0 for the first), and how many it has."""
    n = len(tokens)
    lists = pc.split_pattern(tokens, " ")
    ends = lists.offsets.to_numpy()
    size = np.diff(ends) - 1  # a space is behind each token
    code = lists.flatten().dictionary_encode().indices.to_numpy()
    grid = np.full((n, DEPTH), -1, np.int32)
    column = np.arange(code.size) - np.repeat(ends[:-1], size + 1)
    row = np.repeat(np.arange(n), size + 1)
    real = column < np.repeat(size, size + 1)
    grid[row[real], column[real]] = code[real]
    host = hosts.dictionary_encode().indices.to_numpy()
    same = (grid[1:] == grid[:-1]) & (grid[1:] >= 0) & (host[1:] == host[:-1])[:, None]
    shared = np.where(same.all(1), DEPTH, same.argmin(1)) if n > 1 else np.empty(0, np.int64)
    return np.append(0, shared)[:n], size


def _intervals(array: DataFrame) -> DataFrame:
    """host, rule, lead (the first tokens), pages: counts of the array's intervals, in several rows where one lies in several partitions."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            shared, size = common_prefixes(b.column("host"), b.column("tokens"))
            cols: list[list] = [[], [], [], []]
            for k, (length, _, _) in enumerate(RULES):
                begin = np.flatnonzero(shared < length)
                pages = np.add.reduceat(b.column(WEIGHTS[k]).to_numpy(), begin)
                # any of them may go on in another batch or file, so all are handed on
                good = np.flatnonzero(size[begin] >= length)
                at = pa.array(begin[good])
                cols[0] += b.column("host").take(at).to_pylist()
                cols[1] += [k] * good.size
                cols[2] += [" ".join(t.split(" ", length)[:length]) for t in b.column("tokens").take(at).to_pylist()]
                cols[3] += pages[good].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.string(), pa.int64()), strict=True)], names=["host", "rule", "lead", "pages"])

    return array.select("host", "tokens", *WEIGHTS).mapInArrow(tidy(run), "host string, rule int, lead string, pages long")


def _repeats(outer: DataFrame, keep) -> DataFrame:
    """host, copy, starts (array of place * number of rules + rule): where the repeats of a page's host start in its stream. outer: row (a number), host, copy, outer."""
    # pages with equal blocks count once
    firsts = outer.groupBy("host", "copy").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    copies = cut(outer.select("row", "host", "copy").join(firsts, ["host", "copy"]).where("row > first").select("row"), "html-copies")
    outer = outer.join(copies, "row", "left_anti")
    order = ["host", "tokens", "first"]
    shuffles = int(outer.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hosts = cut(outer.groupBy("host").agg(F.count(F.lit(1)).alias("of")), "html-hosts")
    array = cut(_suffixes(outer, hosts).repartitionByRange(shuffles, *order).sortWithinPartitions(*order), "html-array")
    enough = F.lit(False)
    for k, (_, n, share) in enumerate(RULES):
        enough = enough | ((F.col("rule") == k) & (F.col("pages") >= F.greatest(F.lit(float(n)), F.col("of") * share)))
    counts = _intervals(array).groupBy("host", "rule", "lead").agg(F.sum("pages").alias("pages")).join(hosts, "host")
    repeats = cut(counts.where(enough).select("host", "rule", "lead"), "html-repeats")
    leads = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.substring_index("tokens", " ", r[0]).alias("lead")) for k, r in enumerate(RULES)]))
    found = array.select("host", "rows", "places", leads.alias("x")).select("host", "rows", "places", "x.rule", "x.lead").join(repeats, ["host", "rule", "lead"])
    places = found.select("rule", F.explode(F.arrays_zip("rows", "places")).alias("x")).select("x.rows", (F.col("x.places") * len(RULES) + F.col("rule")).alias("start"))
    starts = places.groupBy(F.col("rows").alias("row")).agg(F.collect_set("start").alias("starts"))
    return keep(starts.join(outer.select("row", "host", "copy"), "row").select("host", "copy", "starts"), "html-starts")


def _covered(n: int, starts: list[int] | None) -> np.ndarray:
    """Which of n tokens lie in a repeat; starts: place * number of rules + rule."""
    out = np.zeros(n + 1, np.int64)
    for x in starts or ():
        s, rule = divmod(x, len(RULES))
        out[s] += 1
        out[s + RULES[rule][0]] -= 1
    return np.cumsum(out[:-1]) > 0


def _text(kinds: bytes, content: list[str], outer: list[str], starts: list[int] | None) -> str:
    """Content, and the runs of undecided blocks that repeats don't cover."""
    covered = _covered(len(_stream(outer)), starts).tolist()
    out, at, inner, rest = [], 0, iter(content), iter(outer)
    for kind in kinds:
        if kind == CONTENT:
            out.append(next(inner))
            continue
        words = next(rest).split(" ")
        if kind == UNDECIDED:
            for gone, run in groupby(zip(covered[at : at + len(words)], words, strict=True), key=lambda x: x[0]):
                if not gone:
                    out.append(" ".join(w for _, w in run))
        at += len(words)
    return "\n".join(out)


def _analysed(pages: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
    """Pages to be parsed where they are read, the written starts of repeats, and whether any page has undecided blocks."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    with scratch(pages.sparkSession) as keep, settings(pages.sparkSession, TIDY_SHUFFLES):
        parsed = _parsed(pages)
        outer = cut(parsed.where(F.size("outer") > 0).select(F.monotonically_increasing_id().alias("row"), "host", "copy", "outer", "undecided"), "html-outer")
        return parsed, _repeats(outer.drop("undecided"), keep), bool(outer.where("undecided").take(1))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def run(batches):
        for b in batches:
            text = [_text(*row) for row in zip(*(b.column(i).to_pylist() for i in range(2, 6)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string())], names=["page_id", "url", "text"])

    parsed, starts, undecided = _analysed(pages)
    done = parsed.where("not undecided").select("page_id", "url", F.array_join("content", "\n").alias("text"))
    if undecided:
        joined = parsed.where("undecided").join(starts, ["host", "copy"], "left").select("page_id", "url", "kinds", "content", "outer", "starts")
        done = done.union(joined.mapInArrow(tidy(run), "page_id long, url string, text string"))
    return done.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def decisions(pages: DataFrame) -> DataFrame:
    """One row: tokens outside content, and how many of them the repeats cut, names alone cut, and stay."""
    names = ["tokens", "by_repeats", "by_names", "kept"]

    def run(batches):
        total = np.zeros(len(names), np.int64)
        for b in batches:
            for kinds, outer, s in zip(*(c.to_pylist() for c in b.columns), strict=True):
                size = [len(t.split(" ")) for t in outer]
                cut_ = _covered(sum(size), s)
                open_ = np.repeat([k == UNDECIDED for k in kinds if k != CONTENT], size)
                total += [cut_.size, cut_.sum(), (~cut_ & ~open_).sum(), (~cut_ & open_).sum()]
        yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in total], names=names)

    with scratch(pages.sparkSession) as keep:
        parsed, starts, _ = _analysed(pages)
        met = parsed.where(F.size("outer") > 0).join(starts, ["host", "copy"], "left").select("kinds", "outer", "starts")
        return keep(met.mapInArrow(tidy(run), ", ".join(f"{c} long" for c in names)).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]), "html-decisions")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


#: The same for pages whose content lies in one article with h1 and p blocks, as in the test tables.
OP8_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(html, '<article>(.*)</article>', 1, 's') AS x FROM pages),
b AS (SELECT page_id, url, list_transform(string_split_regex(x, '</?(?:p|h1)>'), lambda y: trim(regexp_replace(regexp_replace(replace(replace(replace(
       regexp_replace(replace(y, '<br>', ' '), '<[^>]*>', '', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS l FROM a),
c AS (SELECT page_id, url, array_to_string(list_filter(l, lambda y: y <> ''), chr(10)) AS text FROM b)
SELECT page_id, url, text, length(text) AS n_chars FROM c
"""
