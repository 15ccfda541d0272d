"""HTML extraction by equivalence classes of tokens: a host's template is deduced, and the main one of its slots extracted.

A page is read as tokens: opening tags and whole text nodes, each with the path of elements around it. A token's occurrence vector says how often each
page of the host has it; tokens of equal vectors are an equivalence class (vectors are compared by 128-bit digests, made page by
page and combined by exclusive or; copies of a page count once). Classes on at least ``SUPPORT`` of the host's pages and ``LEAST_PAGES`` of them are
kept and nested: a class lies in the class of the nearest element around it, and is parted where its tokens lie in different ones.
The nested classes are the template. Texts of the class of an element around them are the template's own; all other text fills slots.

The main slot is that of the deepest element, once on its pages, that holds over half of the slot text; a page's text is that slot,
without what is in it under menus, footers, forms, notices, adverts and reader comments (by their elements, roles, and class names and ids, whole or by the words in them). An
article element in it keeps even the texts that all pages have. Pages without the template's main element, and hosts of too few pages to deduce a template from,
fall back on article or main elements, and then on all that is under no such element.

A host's template holds only tokens of half its pages, so it is bounded by the tokens of a page or two, however many pages
the host has; pages meet it in a join that is broadcast up to a checked size.

Defined results: a null html is empty and gives an empty text; a null or malformed url is a host of its own; references are decoded, white
space in a block becomes one space, blocks are joined by blank lines; repeated rows each give their row; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, bounded, materialise, small_batches, table

SUPPORT, LEAST_PAGES = 0.5, 3
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|textarea|select|head)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
APART = frozenset("nav footer form button dialog".split())
#: Class names and ids of parts that are not the article, each a whole name.
NAMED = re.compile(r"ads?|adverts?|advertisements?|adsense|sponsor(?:ed|s)?|promos?|banner|sidebars?|side-?bar|widgets?|menus?|nav|navbar|navigation|breadcrumbs?|pagination|pager|site-?header|masthead|footer|site-?footer|(?:cookie-?)?(?:consent|notices?|banner)|cookies?|alerts?|gdpr|newsletter|subscribe|signup|login|share|sharing|social|comments?|comment-?list|replies|disqus|respond|popup|modal|overlay|copyright|search|(?:related|recommended)[-_]?(?:posts?|articles?|stories|links)", re.I)
#: Words that make a name of several such (parted by hyphens, underscores or capitals) one of these parts, and words that tell of something else.
NAMING = frozenset("ad ads advert adverts advertisement advertisements adsense sponsor sponsors sponsored promo promos promotion banner sidebar sidebars widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager masthead footer consent notice notices cookie cookies gdpr newsletter subscribe signup login share sharing social comment comments replies disqus respond popup modal overlay copyright".split())
ELSE = frozenset("no not non without with has category tag topic type format".split())
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
ROLES = frozenset("navigation banner contentinfo complementary search alert dialog form menu menubar".split())
MAIN = frozenset(("article", "main"))
#: Elements that hold blocks; the text in any other block is credited to the nearest of these around it.
CONTAINER = frozenset("html body div section center article main".split())
SPACE = re.compile(r"\s+")


@lru_cache(100_000)
def named_apart(name: str) -> bool:
    """Whether a class name or an id is that of an advert, a menu, comments and the like."""
    if NAMED.fullmatch(name):
        return True
    parts = [p.lower() for p in PARTS.findall(name)]
    return not NAMING.isdisjoint(parts) and ELSE.isdisjoint(parts)


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:\s]*)", 1)), F.lit(""))


def tokens(page: str):
    """Yields ("open", path, apart, inside main), ("close",) and ("text", path, apart, inside main, raw text) in page order."""
    stack: list[tuple[str, str, bool, bool]] = []  # tag, path, apart, inside main
    at = 0

    def close(to: int) -> bool:
        blocks = any(t[0] in BLOCK for t in stack[to:])
        del stack[to:]
        return blocks

    def here():
        return (stack[-1][1], stack[-1][2], stack[-1][3]) if stack else ("", False, False)

    for m in TOKEN.finditer(page):
        if m.start() > at:
            yield ("text", *here(), page[at : m.start()])
        at = m.end()
        tag = m[3]
        if not tag:
            continue
        tag = tag.lower()
        if m[2]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if close(k):
                        yield ("close",)
                    break
            continue
        if tag in VOID:
            yield ("close",) if tag == "hr" else ("space",)
            continue
        if tag in BLOCK:
            yield ("close",)
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p" or stack[k][0] in CLOSES.get(tag, ()):
                    close(k)
                    break
                if stack[k][0] in BLOCK:
                    break
        path, apart, inside = here()
        names = {a.lower(): (x or y or z) for a, x, y, z in ATTRIBUTE.findall(m[4])} if m[4] else {}
        label = tag + "".join(f".{names[a]}" for a in ("class", "id") if names.get(a)).replace("/", "\\")  # "/" parts the elements of a path
        if tag in MAIN:
            inside = inside or not apart
        elif tag not in ("html", "body"):
            apart = apart or tag in APART or tag in ("header", "aside") and not inside or names.get("role", "").lower() in ROLES or any(named_apart(x) for a in ("class", "id") for x in names.get(a, "").split())
        path = f"{path}/{label}" if tag in BLOCK else path
        stack.append((tag, path, apart, inside))
        yield ("open", path, apart, inside, label)
    if at < len(page):
        yield ("text", *here(), page[at:])


def _key(kind: str, path: str, value: str) -> int:
    return xxhash.xxh64_intdigest(f"{kind}\0{path}\0{value}".encode("utf-8", "surrogatepass"), 42) - (1 << 63)


def _clean(raw: str) -> str:
    return SPACE.sub(" ", html_lib.unescape(raw)).strip()


def _around(path: str) -> list[str]:
    """The containers of a path, the outermost first."""
    parts = path.split("/")
    return ["/".join(parts[: k + 1]) for k in range(1, len(parts)) if parts[k].partition(".")[0] in CONTAINER]


def nested(found: list[dict]) -> dict[str, tuple]:
    """The class of each element of a host's template, by path: its vector and the class around it. ``found``: path, is_text, v1, v2."""
    out: dict[str, tuple] = {}
    for e in sorted((e for e in found if not e["is_text"]), key=lambda e: e["path"].count("/")):
        vector, around, path = (e["v1"], e["v2"]), None, e["path"]
        while around is None and "/" in path:
            path = path.rpartition("/")[0]
            around = out.get(path)
        # An element with the vector of the one around it is of its class; another begins a class of its own in there.
        out[e["path"]] = around if around is not None and around[0] == vector else (vector, around)
    return out


def _constant(path: str, vector: tuple, classes: dict[str, tuple]) -> bool:
    """Whether a text is the template's: it is on the pages that an element around it is on, as often."""
    while path:
        if path in classes and classes[path][0] == vector:
            return True
        path = path.rpartition("/")[0]
    return False


def deduced(found: list[dict]) -> tuple[list[int], str | None]:
    """The keys of the template's own texts, and the element that holds the main slot. ``found``: key, path, is_text, v1, v2, pages, total, chars, own.

    Slot text is all characters in an element without those of the template's texts. The deepest element that is once on its pages and holds over half of
    it is the main one; then up, unless it is an article itself, while the element around it has slot text beside its containers, such as the heading of the article.
    """
    classes = nested(found)
    texts = [e for e in found if e["is_text"] and _constant(e["path"], (e["v1"], e["v2"]), classes)]
    elements = [e for e in found if not e["is_text"] and e["chars"]]
    chars, own = {e["path"]: e["chars"] for e in elements}, {e["path"]: e["own"] for e in elements}
    for e in texts:
        around = [p for p in _around(e["path"]) if p in chars]
        for p in around:
            chars[p] -= e["chars"]
        if around:
            own[around[-1]] -= e["chars"]
    whole = max(chars.values(), default=0)
    best = max((e["path"] for e in elements if e["pages"] == e["total"] and whole and chars[e["path"]] * 2 > whole), key=lambda p: (p.count("/"), chars[p], p), default=None)
    while best is not None and best.rpartition("/")[2].partition(".")[0] not in MAIN and (outer := [p for p in _around(best)[:-1] if p in chars]) and own[outer[-1]] > 0:
        best = outer[-1]
    return [e["key"] for e in texts], best


FOUND = "key long, path string, is_text boolean, v1 long, v2 long, pages long, total long, chars long, own long"


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, key, path, is_text, v1, v2, pages, total, chars, own): of each host's tokens in a batch; chars of all text within, own of that outside inner containers."""
    names = [x.split()[0] for x in FOUND.split(", ")]
    for batch in batches:
        got: dict[tuple[str, int], list] = {}
        for host, of, page in zip(*(batch.column(i).to_pylist() for i in range(3))):
            own: dict[tuple[int, str, bool], list[int]] = {}
            for t in tokens(page or ""):
                if t[0] == "open":
                    own.setdefault((_key("open", t[1], t[4]), t[1], False), [0, 0, 0])[0] += 1
                elif t[0] == "text" and not t[2] and (text := _clean(t[4])):
                    one = own.setdefault((_key("text", t[1], text), t[1], True), [0, 0, 0])
                    one[0] += 1
                    one[1] += len(text)
                    around = _around(t[1])
                    for p in around:
                        e = own.setdefault((_key("open", p, p.rpartition("/")[2]), p, False), [0, 0, 0])
                        e[1] += len(text)
                        e[2] += len(text) if p == around[-1] else 0
            counts = {n: xxhash.xxh3_128_intdigest(f"{of}\0{n}") for n in {v[0] for v in own.values()}}
            for (key, path, is_text), (n, chars, direct) in own.items():
                g = got.setdefault((host, key), [path, is_text, 0, 0, 0, 0, 0, 0])
                if n:
                    g[2] ^= counts[n] >> 64
                    g[3] ^= counts[n] & (1 << 64) - 1
                g[4] += n > 0
                g[5] += n
                g[6] += chars
                g[7] += direct
        for g in got.values():
            g[2], g[3] = g[2] - (1 << 63), g[3] - (1 << 63)
        columns = [*zip(*got.values())] or [()] * 8
        types = (pa.string(), pa.bool_(), *[pa.int64()] * 6)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in got], pa.string()), pa.array([k[1] for k in got], pa.int64()), *(pa.array(c, t) for c, t in zip(columns, types))], ["host", *names])


def templates(pages: DataFrame) -> DataFrame:
    """(host, texts, main) of each host: keys of the template's own texts, and the element that holds the main slot."""
    small_batches(pages.sparkSession)
    read = pages.select(host_of(F.col("url")).alias("host"), F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("page_id"), F.coalesce("html", F.lit("")).alias("html"))
    # Copies of a page count once: what they repeat is no template.
    once = materialise(read.groupBy("host", F.xxhash64("html").alias("h"), F.length("html").alias("n")).agg(F.min("page_id").alias("page_id")), "html-pages")
    totals = once.groupBy("host").agg(F.count(F.lit(1)).alias("of"))
    own = read.join(bounded(once.select("host", "page_id", "h")), ["host", "page_id"]).where(F.col("h") == F.xxhash64("html")).select("host", F.concat_ws("/", "h", "page_id").alias("of"), "html")
    if not read.groupBy("host", "page_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        own = own.dropDuplicates(["host", "of"])  # rows that repeat, id and all
    counts = own.mapInArrow(_counts, f"host string, {FOUND}")
    even = F.lit(-(1 << 63)).cast("bigint")  # digests are shifted by half their range
    vectors = (F.bit_xor(F.col(c).bitwiseXOR(even)).alias(c) for c in ("v1", "v2"))
    found = counts.groupBy("host", "key", "is_text").agg(F.max("path").alias("path"), *vectors, *(F.sum(c).alias(c) for c in ("pages", "total", "chars", "own")))
    valid = found.join(totals, "host").where((F.col("pages") >= LEAST_PAGES) & (F.col("pages") >= SUPPORT * F.col("of")))
    hosts = valid.groupBy("host").agg(F.collect_list(F.struct(*(x.split()[0] for x in FOUND.split(", ")))).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [deduced(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in made], pa.list_(pa.int64())), pa.array([x for _, x in made], pa.string())], ["host", "texts", "main"])

    return materialise(hosts.mapInArrow(run, "host string, texts array<long>, main string"), "html-templates")


def text_of(page: str, constant: frozenset[int] | set[int], main: str | None) -> str:
    """The main slot of the page, block by block."""
    found = list(tokens(page))
    if main and any(t[0] == "open" and t[1] == main for t in found):
        keep = lambda t: (t[1] + "/").startswith(main + "/")
    elif any(t[0] == "open" and t[3] for t in found):
        keep = lambda t: t[3]
    else:
        keep = lambda t: True
    blocks: list[str] = []
    run: list[str] = []
    varies = False

    def end() -> None:
        nonlocal varies
        text = _clean("".join(run))
        if text and varies:  # a block of the template's texts alone is no slot
            blocks.append(text)
        run.clear()
        varies = False

    for t in found:
        if t[0] == "close":
            end()
        elif t[0] == "space":
            run.append(" ")
        elif t[0] == "text" and not t[2] and keep(t):
            run.append(t[4])
            if not varies and (text := _clean(t[4])):
                varies = t[3] or not (constant and _key("text", t[1], text) in constant)  # in an article, all is its own
    end()
    return "\n\n".join(blocks)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of each page."""
    made = templates(pages)
    size = made.agg(F.coalesce(F.sum(F.size("texts") + 1), F.lit(0))).first()[0]
    side = made.select(F.col("host").alias("h"), "texts", "main")
    joined = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host")).join(F.broadcast(side) if size <= BROADCAST_ROWS else side, F.col("host") == F.col("h"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text_of(p, frozenset(k or ()), m) for p, k, m in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return joined.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", "texts", "main").mapInArrow(run, "page_id long, url string, text string")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op3_html_extraction": op3}
ORACLE_SQL: dict[str, str] = {}
