"""Main text of web pages by differencing each page with the one of the nearest URL on its host.

A page becomes block lines: white space in a block is one space, references are decoded, blocks
that markup names as something else (menus, footers, headers outside the article, sidebars,
notices, adverts, forms, comments, scripts, styles; by element, role, class or id) are left
out. Pages are ordered by (host, path); pages in a row with equal lines are copies. The partner of a page is the last
page before its copies or the first one after them, on the same host, whose path agrees longer with its own (ties: the
one before). The lines of both are aligned by their longest common subsequence, and shared lines are
deleted: what two neighbouring pages have in common is the site's and not the page's. Lines inside an ``article``
or ``main`` element are the page's own even where a neighbour repeats them, and where such an
element has text the lines outside of it go. If the partner has all lines of the page, nothing would remain and the other
neighbour is the partner; if that has them all too, the lines stay.

Layout: keys are cut at quantiles of a bounded seeded sample into buckets. A bucket streams through a task in the order of
(key, hash of the lines) and holds the lines of three pages and the ids of one row of copies. The pages next
to its ends, beyond copies that reach over any number of buckets, are found first from (bucket, key, hash): per bucket
its ends and the pages next to the copies at its ends, few rows that the driver connects; these pages go to both
buckets. So cuts change no result. A host that holds a third of all pages is many buckets. Only compressed lines are
shuffled, once.

Defined results: null html is empty text; a null url is a host of its own with an empty path; pages without blocks
have an empty text; repeated rows each give a row (copies skip each other as partners); extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import html
import itertools
import re
from urllib.parse import urlsplit

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateau.llm.common import batches, column_of, cut, seeded_sample

PAGES_PER_BUCKET = 512
MAX_BUCKETS = 16_384   # cut keys the driver may hold; buckets grow beyond
SAMPLE_PER_BUCKET = 16

# Elements whose text is never the article's.
DROPPED = frozenset("""nav aside footer form script style noscript template iframe object embed svg canvas audio video select
    button input label fieldset dialog menu head title math""".split())
OUTSIDE = frozenset(["header"])   # an article's own header holds its title
RAW = frozenset(["script", "style", "textarea", "title", "xmp", "noembed", "noframes"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rb rp rt ruby s samp
    small span strike strong sub sup time tt u var wbr""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion
    cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup share
    sharing social sidebar widget widgets menu nav navbar navigation topnav breadcrumb breadcrumbs pagination pager footer
    masthead comment comments commentlist disqus respond reply replies related recommended toolbar search login
    skiplink""".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>|</?[a-zA-Z][^>]*+>|[^<]++|<""",
    re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z0-9]+")
_CLOSE = {t: re.compile("</" + t, re.I) for t in RAW}


def _unwanted(tag: str, attrs: str, inside: bool) -> bool:
    if tag in DROPPED or (tag in OUTSIDE and not inside):
        return True
    if "=" not in attrs and "hidden" not in attrs:
        return False
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id") and not NAMES.isdisjoint(_WORD.findall(value)):
            if tag not in ("body", "html", "article", "main"):
                return True
        elif name == "role" and value in ROLES:
            return True
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        elif name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def blocks(page: str) -> tuple[list[str], bool]:
    """Lines of the page's blocks, and whether they are those of an article or main element."""
    every: list[tuple[str, bool]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool]] = []   # element, unwanted, article
    dropped = articles = 0

    def flush():
        if parts:
            line = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if line:
                every.append((line, articles > 0))

    def pop():
        nonlocal dropped, articles
        _, bad, art = stack.pop()
        dropped -= bad
        articles -= art

    pos, end = 0, len(page)
    while pos < end:
        m = _TOKEN.match(page, pos)
        pos = m.end()
        tag = m.group(2)
        if tag is None:
            s = m.group()
            if not dropped and not (s[0] == "<" and len(s) > 1):
                parts.append(s)
            continue
        tag = tag.lower()
        if m.group(1):
            if any(t == tag for t, _, _ in stack):
                if tag not in INLINE:
                    flush()
                while stack[-1][0] != tag:
                    pop()
                pop()
            elif tag == "p":
                flush()
            continue
        if tag not in INLINE:
            flush()
        attrs = m.group(3)
        if tag in VOID or attrs.endswith("/") and tag in ("svg", "path", "use"):
            continue
        if tag in RAW:
            found = _CLOSE[tag].search(page, pos)
            close = found.start() if found else -1
            if tag == "xmp" and not dropped:
                parts.append(page[pos:close if close >= 0 else end])
            pos = end if close < 0 else page.find(">", close) + 1 or end
            continue
        if tag in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and stack:
            # An open element of the same kind ends here, with inline ones inside it.
            k = len(stack) - 1
            while k >= 0 and stack[k][0] in INLINE:
                k -= 1
            if k >= 0 and stack[k][0] == tag:
                while len(stack) > k:
                    pop()
        art = tag in ("article", "main") or 'role="main"' in attrs
        bad = _unwanted(tag, attrs, articles > 0)
        stack.append((tag, bad, art and not bad and not dropped))
        dropped += bad
        articles += stack[-1][2]
    flush()
    own = [line for line, inside in every if inside]
    return (own, True) if own else ([line for line, _ in every], False)


def shared_lines(a: list[str], b: list[str]) -> set[int]:
    """Positions of ``a`` in a longest common subsequence with ``b`` (bit-parallel rows; every
    so many rows are kept and the ones between recomputed, so memory is n * sqrt(n) bits)."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    out = set(range(lo)) | set(range(len(a) - hi, len(a)))
    in_b, in_a = set(b[lo:len(b) - hi]), set(a[lo:len(a) - hi])
    rows = [i for i in range(lo, len(a) - hi) if a[i] in in_b]
    cols = [x for x in b[lo:len(b) - hi] if x in in_a]
    if not rows or not cols:
        return out
    at: dict[str, int] = {}
    for j, x in enumerate(cols):
        at[x] = at.get(x, 0) | 1 << j
    full = (1 << len(cols)) - 1
    step = max(1, int(len(rows) ** 0.5))

    def after(v: int, i: int) -> int:
        u = v & at[a[rows[i]]]
        return ((v + u) | (v - u)) & full

    kept, v = [full], full
    for i in range(len(rows)):
        v = after(v, i)
        if (i + 1) % step == 0:
            kept.append(v)
    col, row, base, part = len(cols), len(rows), -1, []

    def state(i: int) -> int:   # V after i rows
        nonlocal base, part
        if i // step != base:
            base = i // step
            part = [kept[base]]
            for k in range(base * step, min((base + 1) * step, len(rows))):
                part.append(after(part[-1], k))
        return part[i - base * step]

    while row and col:
        if state(row) >> (col - 1) & 1:
            col -= 1
        else:
            row -= 1
            if not row or state(row) >> (col - 1) & 1:
                out.add(rows[row])
                col -= 1
    return out


def split_url(url: str | None) -> tuple[str, str]:
    try:
        u = urlsplit(url or "")
        return (u.hostname or "").lower().removeprefix("www."), u.path
    except ValueError:
        return "", url or ""


def page_key(page_id: int | None, url: str | None) -> bytes:
    """Order of pages: host, path segments, id (null last), url."""
    host, path = split_url(url)
    pid = "~" if page_id is None else f"{page_id + (1 << 63):020d}"
    return "\0".join([host, path.replace("/", "\x01"), pid, url or ""]).encode("utf-8", "surrogatepass")


def common_path(a: bytes, b: bytes) -> int:
    """-1 on different hosts, else how many characters the paths share from the start."""
    ha, pa_, *_ = a.split(b"\0")
    hb, pb, *_ = b.split(b"\0")
    if ha != hb:
        return -1
    n = 0
    for x, y in zip(pa_, pb):
        if x != y:
            break
        n += 1
    return n


_PLACE = pa.schema([("bucket", pa.int32()), ("key", pa.binary()), ("hash", pa.binary())])
_PAGE = pa.schema([("bucket", pa.int32()), ("key", pa.binary()), ("hash", pa.binary()), ("own", pa.bool_()), ("page_id", pa.int64()),
                   ("url", pa.string()), ("article", pa.bool_()), ("lines", pa.binary())])
_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()),
                  ("n_shared", pa.int64()), ("partner_url", pa.string())])


def line_hash(lines: list[str]) -> bytes:
    return hashlib.blake2b("\n".join(lines).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _resolve(key: bytes, lines: list[str], article: bool, before, after) -> tuple[str, int, str | None]:
    """Text, number of shared lines and partner's url of a page between two neighbours with other lines."""
    near = [(-common_path(key, p["key"]), side, p) for side, p in enumerate((before, after)) if p is not None]
    tried = []
    for c, _, p in sorted(near, key=lambda x: x[:2]):
        if c <= 0:                                    # the same host
            shared = shared_lines(lines, p["lines"])
            tried.append((shared, p["url"]))
            if len(shared) < len(lines):
                break
    if not tried:
        return "\n".join(lines), 0, None
    shared, url = tried[-1] if len(tried[-1][0]) < len(lines) else tried[0]
    if article or len(shared) == len(lines):
        return "\n".join(lines), len(shared), url
    return "\n".join(x for i, x in enumerate(lines) if i not in shared), len(shared), url


def _difference(it):
    """Pages sorted by (bucket, key, hash): each row of copies with the page before and the page after it."""
    unz = zstandard.ZstdDecompressor()

    def runs():
        """bucket, lines and pages of each row of copies."""
        run = None
        for b in it:
            for r in b.to_pylist():
                at = r["bucket"], r["hash"]
                if run is None or run["at"] != at:
                    if run is not None:
                        yield run
                    body = unz.decompress(r["lines"]).decode("utf-8", "surrogatepass")
                    run = {"at": at, "lines": body.split("\n") if body else [], "pages": []}
                run["pages"].append((r["key"], r["own"], r["page_id"], r["url"], r["article"]))
        if run is not None:
            yield run

    def end(run, i: int, bucket: int):
        if run is None or run["at"][0] != bucket:
            return None
        return {"key": run["pages"][i][0], "url": run["pages"][i][3], "lines": run["lines"]}

    def rows():
        before = cur = None
        for after in itertools.chain(runs(), [None]):
            if cur is not None:
                bucket = cur["at"][0]
                prev, nxt = end(before, -1, bucket), end(after, 0, bucket)
                for key, own, page_id, url, article in cur["pages"]:
                    if own:
                        text, n, partner = _resolve(key, cur["lines"], article, prev, nxt)
                        yield page_id, url, text, len(text), n, partner
            before, cur = cur, after

    yield from batches(rows(), _OUT, 500)


def neighbours(ends: list[dict]) -> dict[tuple[bytes, bytes], set[int]]:
    """Which pages (key, hash) other buckets need beside their own. ``ends`` has for each filled bucket, in order, its
    first and last page and the first and last page that differ from these in their lines (or None)."""
    also: dict[tuple[bytes, bytes], set[int]] = {}
    for side, step in (("before", -1), ("after", 1)):
        order = ends if side == "before" else ends[::-1]
        for i, e in enumerate(order):
            mine = e["first"] if side == "before" else e["last"]
            for f in reversed(order[:i]):
                near, beyond = (f["last"], f["last_other"]) if side == "before" else (f["first"], f["first_other"])
                # The copies at this end reach into f: the page behind them is the neighbour, if f has one.
                found = near if near[1] != mine[1] else beyond
                if found is not None:
                    also.setdefault(found, set()).add(e["bucket"])
                    break
    return also


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, n_shared (lines shared with the partner), partner_url."""
    src = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.col(html_col).cast("string").alias("html"))
    names = src.select("page_id", "url")
    n = names.count()
    n_buckets = max(1, min(MAX_BUCKETS, -(-n // PAGES_PER_BUCKET)))
    sample = seeded_sample(names, n_buckets * SAMPLE_PER_BUCKET, ["page_id", "url"]).collect() if n_buckets > 1 else []
    keys = sorted({page_key(r["page_id"], r["url"]) for r in sample})
    cuts = sorted({keys[len(keys) * i // n_buckets] for i in range(1, n_buckets)}) if keys else []

    also = neighbours(_ends(src, cuts)) if cuts else {}

    def parse(it):
        z = zstandard.ZstdCompressor(level=1)

        def rows():
            for b in it:
                for i, u, page in zip(*(column_of(b, c) for c in ("page_id", "url", "html"))):
                    lines, article = blocks(page or "")
                    body = z.compress("\n".join(lines).encode("utf-8", "surrogatepass"))
                    k, h = page_key(i, u), line_hash(lines)
                    yield bisect.bisect_right(cuts, k), k, h, True, i, u, article, body
                    for other in also.get((k, h), ()):
                        yield other, k, h, False, i, u, article, body
        yield from batches(rows(), _PAGE, 500)

    placed = src.mapInArrow(parse, "bucket int, key binary, hash binary, own boolean, page_id bigint, url string, article boolean, lines binary")
    order = placed.repartition("bucket").sortWithinPartitions("bucket", "key", "hash", "own")
    return order.mapInArrow(_difference, "page_id bigint, url string, text string, n_chars bigint, n_shared bigint, "
                                         "partner_url string")


def _ends(src: DataFrame, cuts: list[bytes]) -> list[dict]:
    """For every filled bucket its first and last page (key, hash) and the first and last that differ from these."""
    def places(it):
        def rows():
            for b in it:
                for i, u, page in zip(*(column_of(b, c) for c in ("page_id", "url", "html"))):
                    k = page_key(i, u)
                    yield bisect.bisect_right(cuts, k), k, line_hash(blocks(page or "")[0])
        yield from batches(rows(), _PLACE, 2000)

    at = cut(src.mapInArrow(places, "bucket int, key binary, hash binary"))
    page = F.struct("key", "hash")
    ends = cut(at.groupBy("bucket").agg(F.min(page).alias("first"), F.max(page).alias("last")))
    # At most MAX_BUCKETS rows on either side of these joins and in the result.
    other = (at.join(F.broadcast(ends), "bucket").groupBy("bucket")
             .agg(F.min(F.when(F.col("hash") != F.col("first.hash"), page)).alias("first_other"),
                  F.max(F.when(F.col("hash") != F.col("last.hash"), page)).alias("last_other")))
    plain = lambda p: None if p is None else (bytes(p["key"]), bytes(p["hash"]))
    found = [{"bucket": r["bucket"], **{c: plain(r[c]) for c in ("first", "last", "first_other", "last_other")}}
             for r in ends.join(other, "bucket").collect()]
    return sorted(found, key=lambda e: e["bucket"])
