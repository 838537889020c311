"""HTML extraction by tag-path ratios.

A page's text falls into blocks, each at the end of a root-to-leaf path of structural tags
(inline tags do not count, open paragraphs and list items close where HTML closes them). For
each path, over a page and over all pages, the text length, punctuation, link text and number
of blocks are summed. A path's ratio is its text with punctuation per block, without link
text. Ratios are smoothed along the paths of a page, fused with the ratio of the path's region
(the part of the page below the body it lies in) and with the corpus, and paths above a share
of the page's threshold hold the content. All blocks of a chosen path are returned whole.

What is never main text by its element or role (menus, footers, sidebars, forms, scripts, notices,
adverts, reader comments) has no ratio. Where a page marks an article or main part, paths outside
weigh a tenth.

Each page is parsed once. A path is known by a digest chained from tag to tag, so neither its depth
nor a label's length is cut. Pages are parsed in slices of about a megabyte; the able blocks, compressed,
and the sums of a slice's paths go to a table in the shared folder. Spark adds the sums of each path over
all slices and joins the totals back to the slices that hold the path, by path and salt, so that a
path of every page is no single task. A slice then meets the totals of its own paths, however
many paths the corpus has; no table of paths reaches the driver or every task.

Edge cases: null and empty pages and pages without content give an empty text; cut-off
pages end where they end (an unfinished tag, comment or script is no text); unknown character
references stay as they are; repeated rows are judged one by one; extra columns are ignored; a page of
any length or depth is parsed whole, as a slice of its own; equal ratios are all chosen or all left; an
empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from hashlib import blake2b

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import common
from logloom.session import ship_package

#: Parts into which the slices that hold a path are dealt.
SALTS = 64
#: A path is content if its ratio reaches this share of the page's mean ratio.
SHARE = 0.4
#: Weight of paths outside the article or main part of a page that has one.
OUTSIDE = 0.1

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?P<end>>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
#: Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr main menu nav ol p pre search section table ul li dd dt tr td th tbody thead tfoot".split()
)
OWN_KIND = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
            "option": ("option",)}
#: Elements and role words that are never main text.
NEVER = frozenset("nav footer aside form script style noscript template iframe head button select textarea dialog menu svg math object canvas".split())
ROLE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar sidebar"
    " aside footer header masthead topbar toolbar breadcrumb breadcrumbs comment comments commentlist disqus respond reply replies notice notices"
    " cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup login search share sharing social related"
    " recommended pagination pager widget copyright legal disclaimer skip hidden complementary contentinfo".split()
)
_PUNCT = re.compile(r"[.,;:!?…。、，！？；：]")
_ROLE_SPLIT = re.compile(r"[^a-z]+")


def _role(attrs: str) -> tuple[str, bool]:
    """(label, whether it is never main text) of a tag's class, id and role."""
    label, never = "", False
    for m in _ATTR.finditer(attrs):
        value = (m[2] or m[3] or m[4] or "").lower()
        name = m[1].lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            never = True
        elif name in ("class", "id", "role"):
            label = label or value.split(" ")[0]
            never |= any(w in ROLE_WORDS for w in _ROLE_SPLIT.split(value))
    return label, never


class Block:
    __slots__ = ("path", "region", "never", "article", "parts", "link", "text")

    def __init__(self, path, region, never, article):
        self.path, self.region, self.never, self.article = path, region, never, article
        self.parts: list[str] = []
        self.link = 0


class Open:
    """An open tag: the digest of its path, and of the region it lies in."""

    __slots__ = ("tag", "path", "region", "body", "never", "article")

    def __init__(self, tag, label, parent, never, article):
        self.tag, self.never, self.article = tag, never, article
        self.path = blake2b((parent.path if parent else b"") + label.encode(), digest_size=16).digest()
        # body: 0 none is open yet, 1 this tag is the first one, 2 below it
        self.body = min(2, parent.body + 1) if parent and parent.body else int(tag == "body")
        inherited = parent and (self.body == 0 or parent.body == 2)
        self.region = parent.region if inherited else self.path


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, texts decoded and white space folded."""
    out: list[Block] = []
    stack: list[Open] = []
    opened: dict[str, int] = {}
    links, skip, now = 0, None, None

    def block() -> Block:
        top = stack[-1] if stack else None
        return Block(top.path, top.region, top.never, top.article) if top else Block(b"", b"", False, False)

    def pop_to(i: int) -> None:
        nonlocal now
        for x in stack[i:]:
            opened[x.tag] -= 1
        del stack[i:]
        now = None

    def last(tag: str) -> int | None:
        """Where the innermost open tag of this name is."""
        if not opened.get(tag):
            return None
        return next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag)

    for m in _TOKEN.finditer(page):
        tag = m["tag"]
        if skip:
            if tag and m["close"] and tag.lower() == skip:
                skip = None
            continue
        if m["text"] is not None:
            if now is None:
                now = block()
                out.append(now)
            now.parts.append(m["text"])
            if links:
                now.link += len(m["text"].strip())
            continue
        if not tag or not m["end"]:
            continue
        tag = tag.lower()
        if m["close"]:
            if tag == "a":
                links = max(0, links - 1)
            if tag in INLINE:
                continue
            at = last(tag)
            if at is not None:
                pop_to(at)
            continue
        if tag in RAW:
            if not m["attrs"].endswith("/") or tag not in ("svg", "math"):
                skip = tag
            continue
        if tag == "br":
            if now is not None:
                now.parts.append(" ")
            continue
        if tag in INLINE:
            links += tag == "a"
            continue
        if tag in CLOSES_PARAGRAPH:
            at = last("p")
            if at is not None:
                pop_to(at)
        now = None
        links = 0
        if tag in VOID:
            continue
        if tag in OWN_KIND and any(opened.get(kind) for kind in OWN_KIND[tag]):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag in OWN_KIND[tag]:
                    pop_to(i)
                    break
                if stack[i].tag in ("ul", "ol", "dl", "table", "select"):
                    break
        label, never = _role(m["attrs"]) if m["attrs"] else ("", False)
        parent = stack[-1] if stack else None
        inside = bool(parent) and parent.article or tag in ("article", "main")
        if tag in ("html", "body", "article", "main"):
            never = False  # a page's theme classes say nothing about its text
        never = never or tag in NEVER or bool(parent) and parent.never or tag == "header" and not inside
        stack.append(Open(tag, f"/{tag}.{label}" if label else f"/{tag}", parent, never, inside))
        opened[tag] = opened.get(tag, 0) + 1
    kept = []
    for b in out:
        b.text = " ".join(html.unescape("".join(b.parts)).split())
        if b.text:
            kept.append(b)
    return kept


def _sums(found: list[Block]) -> dict[bytes, list[int]]:
    """path -> [blocks, characters, punctuation, link characters], regions under a leading '^'."""
    sums: dict[bytes, list[int]] = {}
    for b in found:
        chars, punct = len(b.text), len(_PUNCT.findall(b.text))
        for key in (b.path, b"^" + b.region):
            s = sums.setdefault(key, [0, 0, 0, 0])
            s[0] += 1
            s[1] += chars
            s[2] += punct
            s[3] += min(b.link, chars)
    return sums


def _ratio(sums) -> float:
    """Text with punctuation per block, without link text."""
    n, chars, punct, link = sums
    return math.log1p(max(0.0, chars - 2 * link) / n) * (1 + math.log1p(punct / n))


def content(able: list[tuple[bytes, bytes, bool, str]], own: dict[bytes, tuple], corpus: dict[bytes, tuple]) -> str:
    """The text of a page's chosen blocks (path, region, whether inside an article, text) by its own and the corpus' sums."""
    if not able:
        return ""

    def fused(key: bytes) -> float:
        return (_ratio(own[key]) + _ratio(corpus[key])) / 2

    order = list(dict.fromkeys(path for path, _, _, _ in able))
    raw = {p: fused(p) for p in order}
    region_of = {path: b"^" + region for path, region, _, _ in able}
    region = {key: fused(key) for key in set(region_of.values())}
    most = max(own[key][1] for key in region)
    inside = {path for path, _, article, _ in able if article}
    ratios = {}
    for i, p in enumerate(order):
        near = [raw[q] for q in order[max(0, i - 1) : i + 2]]
        smooth = (raw[p] + sum(near) / len(near)) / 2
        share = own[region_of[p]][1] / most
        ratios[p] = smooth * (0.5 + 0.5 * share) + region[region_of[p]] * share
        if inside and p not in inside:
            ratios[p] *= OUTSIDE
    mean = sum(ratios[path] * len(text) for path, _, _, text in able) / sum(len(text) for _, _, _, text in able)
    chosen = {p for p in order if ratios[p] >= SHARE * mean}
    return "\n\n".join(text for path, _, _, text in able if path in chosen)


#: A parsed page: the able blocks, and the sums of their paths and regions, four numbers each.
_PAGE = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()),
    ("path", pa.list_(pa.int32())), ("region", pa.list_(pa.int32())), ("article", pa.list_(pa.bool_())), ("text", pa.list_(pa.string())),
    ("keys", pa.list_(pa.binary())), ("sums", pa.list_(pa.int64())),
])
#: A slice: its parsed pages as one compressed Arrow stream, and the sums of all its paths.
_SLICE = pa.schema([("slice", pa.int64()), ("pages", pa.large_binary()), ("keys", pa.list_(pa.binary())), ("sums", pa.list_(pa.int64()))])
_COMPRESSED = pa.ipc.IpcWriteOptions(compression="zstd")


def _parsed(batches):
    """A row for each slice; its number is its task's and its own, the same in every attempt."""
    at = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in common.text_slices(batch, "html"):
            total: dict[bytes, list[int]] = {}
            rows: dict[str, list] = {name: [] for name in _PAGE.names[2:]}
            for page in part.column("html").to_pylist():
                found = blocks(page or "")
                own = _sums(found)
                for key, s in own.items():
                    old = total.setdefault(key, [0, 0, 0, 0])
                    for i, x in enumerate(s):
                        old[i] += x
                able = [b for b in found if not b.never]
                place: dict[bytes, int] = {}
                rows["path"].append([place.setdefault(b.path, len(place)) for b in able])
                rows["region"].append([place.setdefault(b"^" + b.region, len(place)) for b in able])
                rows["article"].append([b.article for b in able])
                rows["text"].append([b.text for b in able])
                rows["keys"].append(list(place))
                rows["sums"].append([x for key in place for x in own[key]])
            fixed = [part.column("page_id"), part.column("url").cast(pa.string())]
            made = pa.RecordBatch.from_arrays([*fixed, *[pa.array(rows[f.name], f.type) for f in list(_PAGE)[2:]]], schema=_PAGE)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, _PAGE, options=_COMPRESSED) as out:
                out.write_batch(made)
            row = [[at], [sink.getvalue().to_pybytes()], [list(total)], [[x for s in total.values() for x in s]]]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _SLICE)], schema=_SLICE)
            at += 1


_FOUND = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def _chosen(slices: pa.Table, totals: pa.Table) -> pa.Table:
    """The texts of a slice's pages, from the totals of the slice's paths."""
    columns = [totals.column(name).to_pylist() for name in ("key", "blocks", "chars", "punct", "link")]
    corpus = {key: s for key, *s in zip(*columns)}
    pages = pa.ipc.open_stream(slices.column("pages")[0].as_buffer()).read_all()
    texts = []
    for row in pages.select(["path", "region", "article", "text", "keys", "sums"]).to_pylist():
        keys, sums = row["keys"], row["sums"]
        own = {key: sums[4 * i : 4 * i + 4] for i, key in enumerate(keys)}
        able = [(keys[p], keys[r][1:], a, t) for p, r, a, t in zip(row["path"], row["region"], row["article"], row["text"])]
        texts.append(content(able, own, corpus))
    return pa.table([pages.column("page_id"), pages.column("url"), pa.array(texts, pa.string())], schema=_FOUND)


def extract(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) as (page_id, url, text)."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    parsed = common.cut(pages.mapInArrow(_parsed, "slice long, pages binary, keys array<binary>, sums array<long>"))
    number = ("blocks", "chars", "punct", "link")
    held = (
        parsed.select("slice", "sums", F.posexplode("keys").alias("i", "key"))
        .select(F.col("slice").alias("holder"), "key", F.pmod(F.xxhash64("slice"), F.lit(SALTS)).alias("salt"),
                *[F.get("sums", F.col("i") * 4 + j).alias(c) for j, c in enumerate(number)])
    )
    salted = held.groupBy("key", "salt").agg(*[F.sum(c).alias(c) for c in number])
    total = salted.groupBy("key").agg(*[F.sum(c).alias(c) for c in number])
    back = salted.select("key", "salt").join(total, "key")
    totals = held.select("holder", "key", "salt").join(back, ["key", "salt"]).select("holder", "key", *number)
    return parsed.select("slice", "pages").groupBy("slice").cogroup(totals.groupBy("holder")).applyInArrow(_chosen, "page_id long, url string, text string")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
