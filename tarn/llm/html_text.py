"""Main text of web pages: structure, then nearest-URL page differencing.

1. A page becomes lines: the text of its blocks, each marked as inside the main container (article or main element) or
   not, and inside it with its box, the outermost block in its container that has a class, id or role. Elements that never
   hold main text go: by name (DROP) or by a word of their class, id or role (JUNK).
2. Pages of a host are ordered by the path of their URL (then query, the page's id and the row). Each page is paired with the
   nearest page before or after it that has other lines (copies tell nothing), namely the one whose path shares more leading
   characters, the earlier one of equals. Lines of the two are aligned by their longest common subsequence; what two pages of
   a site share is its frame.
3. In a page without a main container shared lines are deleted; one of whose lines nothing would be left keeps them all, being
   a copy of its neighbour. In a page with one, lines outside it go, and inside it boxes of which every line is shared. Single
   shared lines of the article itself stay, and so does all of an article of which half is in such boxes, or half of the rest is
   shared, as it is republished.

Pages are dealt out by ranges of (host, path, query, page_id, row), so a host of any size, or a page repeated any number
of times, is split over tasks. What travels there is 64-bit hashes of lines; which lines go comes back. The page before and
the one after each range are added to it as context; which they are is decided on hashes of all lines, four a range.

Inside a block, runs of white space are one space; character references are decoded; blocks are joined by one newline.

Cases: null html counts as empty and gives an empty text; a null url pairs with no page; repeated rows each get a row; an
unclosed tag or comment ends with its parent or the page; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from urllib.parse import urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROP = frozenset("nav header footer aside form button select option textarea script style noscript template svg math iframe object embed canvas audio video map menu dialog head title fieldset label input xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
MAIN = frozenset(("article", "main"))
CLOSED_BY = {"p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li td th tr dt dd".split()), "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr",)), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")), "option": frozenset(("option",))}
#: Words of a class, id or role that mark what is no main text.
JUNK = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion promoted banner banners nav navbar navigation menu menus menubar breadcrumb breadcrumbs sidebar sidebars "
    "side aside header masthead topbar footer foot bottombar copyright comment comments commentlist disqus respond reply replies cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations widget widgets pagination pager toolbar complementary contentinfo search searchbox skip".split()
)
#: Bytes of the lists of lines that go that may be broadcast.
BROADCAST_BYTES = 16 << 20
KEEP_CONTAINERS = frozenset(("html", "body", "article", "main"))
# a comment, a tag, a tag whose quotes do not close, a declaration
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)>|<[!?][^>]*>""", re.S)
_MARKS = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_ROLE_MAIN = re.compile(r"""\brole\s*=\s*["']?main\b""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def is_junk(name: str, attributes: str) -> bool:
    if name in DROP:
        return True
    if not attributes or name in KEEP_CONTAINERS:
        return False
    for m in _MARKS.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key in ("class", "id", "role") and any(w.lower() in JUNK for w in _WORD.findall(value)):
            return True
    return False


_HAS_MAIN = re.compile(r"<(?:article|main)\b", re.I)


def lines(page: str | None) -> list[tuple[str, bool, int]]:
    """(text, inside the main container, box or 0) of each block with text, in page order."""
    page = page or ""
    found = _lines_of(page, True)
    if not any(main for _, main, _ in found) and _HAS_MAIN.search(page):
        # what wraps the container has a word of JUNK too, such as "has-sidebar": outside, only names count
        again = _lines_of(page, False)
        if any(main for _, main, _ in again):
            return again
    return found


def _lines_of(page: str, marks_outside: bool) -> list[tuple[str, bool, int]]:
    out: list[tuple[str, bool, int]] = []
    words: list[str] = []
    stack: list[tuple[str, bool, bool, int]] = []  # name, drops, is main, the box around it
    opened: Counter = Counter()  # names on the stack
    dropping = mains = at = box = boxes = 0
    n = len(page)

    def flush():
        if words:
            if text := " ".join(references.unescape("".join(words)).split()):
                out.append((text, mains > 0, box))
            words.clear()

    def pop_to(depth: int):
        nonlocal dropping, mains, box
        while len(stack) > depth:
            name, drops, main, around = stack.pop()
            opened[name] -= 1
            if name not in INLINE and not dropping:
                flush()
            dropping -= drops
            mains -= main
            box = around

    while at < n:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else n
        if stop > at and not dropping:
            words.append(page[at:stop])
        if not m:
            break
        at = m.end()
        closing, name, attributes = m.group(1, 2, 3) if m[2] else m.group(4, 5, 6)
        if name is None:
            continue
        name = name.lower()
        if closing:
            if opened[name]:
                pop_to(next(depth for depth in range(len(stack) - 1, -1, -1) if stack[depth][0] == name))
            elif name not in INLINE and not dropping:
                flush()
            continue
        block = name not in INLINE
        if block and stack:
            for depth in range(len(stack) - 1, -1, -1):
                top = stack[depth][0]
                if name in CLOSED_BY.get(top, ()):
                    pop_to(depth)
                    break
                if top not in INLINE:
                    break
        if not dropping:
            if block:
                flush()
            elif name == "br":
                words.append(" ")
        if name in VOID or attributes.endswith("/") and name not in ("p", "div", "article", "main"):
            continue
        if name in RAW:
            close = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            end = close.start() if close else n
            if not dropping and name not in DROP:
                words.append(page[at:end])
            at = close.end() if close else n
            continue
        drops = is_junk(name, attributes if marks_outside or mains else "")
        main = name in MAIN or _ROLE_MAIN.search(attributes) is not None
        if drops and not dropping:
            flush()
        stack.append((name, drops, main and not dropping, box))
        if main:
            box = 0
        elif block and mains and not box and not drops and any(m[1].lower() in ("class", "id", "role") for m in _MARKS.finditer(attributes)):
            boxes += 1
            box = boxes
        opened[name] += 1
        dropping += drops
        mains += main and not (dropping and drops) and stack[-1][2]
    if not dropping:
        flush()
    return out


def common(a: list[str], b: list[str]) -> set[int]:
    """Places in a of a longest common subsequence of a and b: ends that agree are trimmed, the rest is done row by row."""
    start = 0
    while start < len(a) and start < len(b) and a[start] == b[start]:
        start += 1
    end = 0
    while end < len(a) - start and end < len(b) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    out = set(range(start)) | set(range(len(a) - end, len(a)))
    # lines of one page only are in no common subsequence
    both = set(a[start : len(a) - end]) & set(b[start : len(b) - end])
    x = [i for i in range(start, len(a) - end) if a[i] in both]
    y = [j for j in range(start, len(b) - end) if b[j] in both]
    return out | {x[i] for i in _matched([a[i] for i in x], [b[j] for j in y])}


def _lengths(a: list[str], b: list[str]) -> list[int]:
    """Lengths of longest common subsequences of a and each prefix of b."""
    row = [0] * (len(b) + 1)
    for s in a:
        before = 0
        for k, t in enumerate(b, 1):
            above = row[k]
            row[k] = before + 1 if s == t else max(above, row[k - 1])
            before = above
    return row


def _matched(a: list[str], b: list[str]) -> list[int]:
    """Places in a of a longest common subsequence, by halves of a, so that two rows are held and not a table."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        if i == j or k == m:
            continue
        if j - i == 1:
            if a[i] in b[k:m]:
                out.append(i)
            continue
        half = (i + j) // 2
        left, right = _lengths(a[i:half], b[k:m]), _lengths(a[half:j][::-1], b[k:m][::-1])[::-1]
        at = max(range(len(left)), key=lambda c: left[c] + right[c])
        todo += ((i, half, k, k + at), (half, j, k + at, m))
    return out


def frame(page: list[tuple], neighbour: list[tuple]) -> list[int]:
    """Places of a page's lines, (text or its hash, main, box), that are frame by its neighbour, besides those outside the main container."""
    shared = common([x for x, _, _ in page], [x for x, _, _ in neighbour])
    inside = [i for i, (_, main, _) in enumerate(page) if main]
    if not inside:
        return sorted(shared) if len(shared) < len(page) else []
    own = {page[i][2] for i in inside if i not in shared} | {0}
    gone = [i for i in inside if page[i][2] not in own]
    rest = [i in shared for i in inside if page[i][2] in own]
    return gone if 2 * len(gone) < len(inside) and 2 * sum(rest) < len(rest) else []


def _text(page: list[tuple[str, bool, int]], gone) -> str:
    """What is left of a page without its frame."""
    inside = any(main for _, main, _ in page)
    return "\n".join(t for i, (t, main, _) in enumerate(page) if (main or not inside) and i not in gone)


def main_text(page: list[tuple[str, bool, int]], neighbour: list[tuple[str, bool, int]] | None) -> str:
    return _text(page, frame(page, neighbour) if neighbour else ())


def address(url: str | None) -> tuple[str, str, str] | None:
    """(host, path, query) by which pages are ordered; None for what is no URL."""
    if not url:
        return None
    try:
        parts = urlsplit(url.strip())
        host = parts.hostname or ""
    except ValueError:
        return None
    return host, parts.path, parts.query


def _nearness(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row."""

    def parse(batches):
        for batch in batches:
            ids, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
            found = [lines(x) for x in batch.column("html").to_pylist()]
            places = [address(u) for u in urls]
            yield {
                "page_id": ids, "url": urls, "host": [p[0] if p else None for p in places], "path": [p[1] if p else None for p in places], "query": [p[2] if p else None for p in places],
                "lines": [[{"text": t, "main": m, "box": b} for t, m, b in f] for f in found],
            }

    schema = "page_id long, url string, host string, path string, query string, lines array<struct<text: string, main: boolean, box: int>>"
    # the number tells equal rows apart and is stored with them
    parsed = cut(arrow_map(pages.select(F.col("page_id").cast("long"), "url", "html"), parse, schema).withColumn("row", F.monotonically_increasing_id()), "pages")
    gone = cut(_differenced(parsed), "frames")
    kept = parsed.select("page_id", "url", "lines", "row")
    few = gone.agg(F.sum(F.size("gone") + 8).alias("n")).first().n
    if few is None:
        kept = kept.withColumn("gone", F.lit(None).cast("array<int>"))
    else:
        # texts are not dealt out for lists that fit a broadcast
        kept = kept.join(F.broadcast(gone) if 4 * few <= BROADCAST_BYTES else gone, "row", "left")

    def write(batches):
        for batch in batches:
            texts = [_text(x, frozenset(g or ())) for x, g in zip(_lines(batch.column("lines")), batch.column("gone").to_pylist(), strict=True)]
            yield {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts}

    return arrow_map(kept, write, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))


def _lines(column) -> list[list[tuple]]:
    return [[tuple(x.values()) for x in row] for row in column.to_pylist()]


def _differenced(parsed: DataFrame) -> DataFrame:
    """(row, gone): the places of the lines that each page with a host shares with its neighbour and that are frame, if any."""
    spark = parsed.sparkSession
    key = ["host", "path", "query", "page_id", "row"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashed = F.transform("lines", lambda x: F.struct(F.xxhash64(x["text"]).alias("hash"), x["main"].alias("main"), x["box"].alias("box")))
    hashed = parsed.where("host is not null").select(*key, hashed.alias("lines"))
    ranged = cut(hashed.withColumn("sum", F.xxhash64("lines")).repartitionByRange(n, *key).withColumn("range", F.spark_partition_id()), "ranges")
    context = _context(ranged, key)
    rows = ranged.withColumn("context", F.lit(False))
    if context:
        wanted = F.broadcast(spark.createDataFrame(context, "source int, source_row long, target int"))
        more = ranged.join(wanted, (F.col("range") == F.col("source")) & (F.col("row") == F.col("source_row")))
        rows = rows.unionByName(more.drop("range", "source", "source_row").withColumnRenamed("target", "range").withColumn("context", F.lit(True)))

    def run(batches):
        # of pages with the same lines, which lie together or not, the lines are held once; before: the last other page
        before = now = None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("range", "host", "path", "row", "sum", "context"))
            for rng, host, path, row, total, context, page in zip(*columns, _lines(batch.column("lines")), strict=True):
                if now is None or (rng, host, total) != (now["range"], now["host"], now["sum"]):
                    new = {"range": rng, "host": host, "path": path, "sum": total, "lines": page, "asked": []}
                    if now is not None:
                        yield from told(before, now, new)
                    before, now = now, new
                now["path"] = path
                if not context:
                    now["asked"].append((row, path))
        if now is not None:
            yield from told(before, now, None)

    def told(before, now, after):
        near = [x for x in (before, after) if x and (x["range"], x["host"]) == (now["range"], now["host"])]
        out = {"row": [], "gone": []}
        places = {}
        for row, path in now["asked"] if near else ():
            best = max(near, key=lambda x: _nearness(path, x["path"]))
            if id(best) not in places:
                places[id(best)] = frame(now["lines"], best["lines"])
            if places[id(best)]:
                out["row"].append(row)
                out["gone"].append(places[id(best)])
        if out["row"]:
            yield out

    return arrow_map(rows.repartitionByRange(n, "range").sortWithinPartitions("range", *key), run, "row long, gone array<int>")


def _context(ranged: DataFrame, key) -> list[tuple[int, int, int]]:
    """(range, row) of pages that other ranges need as context, and which range. Four addresses a range reach the driver."""
    place = F.struct(*key)
    page = F.struct("host", "sum", "row")
    ends = ranged.groupBy("range").agg(F.min_by(page, place).alias("first"), F.max_by(page, place).alias("last"))
    # and the outermost pages that are no copies of these
    other = ranged.join(F.broadcast(ends), "range")
    inner = other.groupBy("range").agg(F.min_by(page, F.when(F.col("sum") != F.col("first.sum"), place)).alias("second"), F.max_by(page, F.when(F.col("sum") != F.col("last.sum"), place)).alias("other"))
    found = sorted(ends.join(inner, "range").collect(), key=lambda r: r.range)
    out = []
    for i, r in enumerate(found):
        for own, rest, names in ((r.first, reversed(found[:i]), ("last", "other")), (r.last, found[i + 1 :], ("first", "second"))):
            for source in rest:
                sides = [source[name] for name in names if source[name] is not None]
                if hit := next((x for x in sides if x.host != own.host or x.sum != own.sum), None):
                    if hit.host == own.host:
                        out.append((source.range, hit.row, r.range))
                    break
    return out
