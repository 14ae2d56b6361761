"""Main text of web pages, by comparing each page with its neighbours on the host.

A page becomes blocks of text. Those of menus, headers, footers, forms, adverts, comments and the like are noise, by
element, role or class, and those of its articles are main text. All others are compared: pages of a host are sorted by
URL path, each is paired with the nearest before and after it, the blocks of both are aligned by their longest common
subsequence, and blocks that a neighbour shares are the site's, not the page's. What no neighbour shares is text of the
page, beside an article too. A neighbour that shares nearly all of it is the same text under another address and says nothing.

Blocks of an article are kept even where a neighbour shares them: they are stock sentences of the text or the same
article under another address, and the text must be whole.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import Landing
from .words import slices

# Elements that hold no text, that break blocks, and that hold what is not the page's own text.
SKIPPED = "script style noscript template head svg math iframe object select option button canvas audio video textarea".split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
BREAKING = (
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul"
).split()
NOISE = "nav header footer aside form dialog menu fieldset".split()
MAIN = ["article"]
NOISE_ROLES = "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split()
NOISE_NAMES = (
    "nav navbar navigation menu header masthead footer sidebar aside ad ads advert adverts advertisement banner promo "
    "sponsor sponsored cookie cookies consent gdpr notice notices alert popup modal overlay comment comments disqus reply "
    "replies share sharing social related recommended breadcrumb breadcrumbs newsletter subscribe signup login search "
    "widget toolbar pager pagination skip copyright legal"
).split()
OWN_NAMES = "header masthead banner legal search copyright related widget overlay skip".split()  # no noise within an article
MAIN_NOISE, MAIN_TEXT, OPEN = 0, 1, 2
SIGNS = (0, -1, 1)
SAME_TEXT = 0.9  # share of a page's text, noise aside, from which a neighbour is the same text

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"<]*\"|'[^'<]*'|[\"'])*+)>", re.DOTALL
)
ATTRIBUTE = re.compile(r"([A-Za-z_:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
WORDS = re.compile(r"[a-z]+")
SPACES = re.compile(r"\s+")
_SETS = {n: frozenset(v) for n, v in {
    "skipped": SKIPPED, "void": VOID, "breaking": BREAKING, "noise": NOISE, "main": MAIN, "roles": NOISE_ROLES, "names": NOISE_NAMES,
    "inner": set(NOISE_NAMES) - set(OWN_NAMES),
}.items()}
_CLOSED_BY = {"p": frozenset(BREAKING) - {"br"}, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
              "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"])}


def _is_noise(name: str, attributes: str, in_main: bool) -> bool:
    if name in _SETS["noise"] and not (name == "header" and in_main):
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    found = {m[0].lower(): m[1] or m[2] or m[3] for m in ATTRIBUTE.findall(attributes)}
    if found.get("role", "").lower() in _SETS["roles"] or found.get("aria-hidden") == "true":
        return True
    named = set(WORDS.findall(f"{found.get('class', '')} {found.get('id', '')}".lower()))
    return bool(named & _SETS["inner" if in_main else "names"]) and name != "article"


def page_blocks(page: str) -> list[tuple[str, int]]:
    """Blocks of a page in order, each with MAIN_NOISE, MAIN_TEXT or OPEN."""
    blocks, words, stack = [], [], []  # stack: (element, noise, main)
    noise = main = 0
    at, end = 0, len(page)

    def close():
        if words:
            text = SPACES.sub(" ", entities.unescape("".join(words))).strip()
            if text:
                blocks.append((text, MAIN_NOISE if noise else MAIN_TEXT if main else OPEN))
            words.clear()

    while at < end:
        m = TAG.search(page, at)
        if m is None:
            words.append(page[at:])
            break
        if m.start() > at:
            words.append(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if name in _SETS["breaking"]:
            close()
        if m[1]:
            if any(e[0] == name for e in stack):
                close()
                while True:
                    last = stack.pop()
                    noise, main = noise - last[1], main - last[2]
                    if last[0] == name:
                        break
            continue
        if name in _SETS["skipped"]:
            stop = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            if stop:
                at = stop.end()
            elif name in ("script", "style", "textarea"):
                at = end  # never closed: the rest is no text
            continue
        while stack and name in _CLOSED_BY.get(stack[-1][0], ()):
            last = stack.pop()
            noise, main = noise - last[1], main - last[2]
        if name in _SETS["void"] or m[3].endswith("/"):
            continue
        entry = (name, int(_is_noise(name, m[3], main > 0)), int(name in _SETS["main"]))
        if entry[1] or entry[2]:
            close()
        stack.append(entry)
        noise, main = noise + entry[1], main + entry[2]
    close()
    return blocks


def _common_lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of a longest common subsequence of `a` with each beginning of `b`, by one number with a bit for each of `b`."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    every = (1 << len(b)) - 1
    open_ = every  # a bit is cleared where the subsequence grows
    for x in a:
        met = open_ & where.get(x, 0)
        open_ = (open_ + met | open_ - met) & every
    bits = np.unpackbits(np.frombuffer((every ^ open_).to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")
    return np.concatenate([[0], np.cumsum(bits[: len(b)], dtype=np.int64)])


def shared_blocks(a: list[int], b: list[int]) -> list[int]:
    """Places in `a` of a longest common subsequence with `b`; blocks may come again on either side.

    The longer halves of a problem are split where the lengths of both parts add up to most, so that no table of all pairs
    is kept.
    """
    found, rest = [], [(a, b, 0)]
    while rest:
        a, b, first = rest.pop()
        start = 0
        while start < min(len(a), len(b)) and a[start] == b[start]:
            start += 1
        end = 0
        while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
            end += 1
        found += [*range(first, first + start), *range(first + len(a) - end, first + len(a))]
        a, b, first = a[start : len(a) - end], b[start : len(b) - end], first + start
        if len(a) == 1 and a[0] in b:
            found.append(first)
        if len(a) < 2 or not b:
            continue
        half = len(a) // 2
        total = _common_lengths(a[:half], b) + _common_lengths(a[half:][::-1], b[::-1])[::-1]
        cut = int(total.argmax())
        if total[cut]:
            rest += [(a[:half], b[:cut], first), (a[half:], b[cut:], first + half)]
    return sorted(found)


def _open_blocks(batches):
    """Rows (key, html) to (key, blocks, sizes): hashes of all blocks, and their characters: 0 for noise, below 0 in articles."""
    import xxhash

    for batch in slices(batches):
        hashes, sizes = [], []
        for page in batch.column(1):
            found = page_blocks(page.as_py() or "")
            hashes.append([xxhash.xxh64_intdigest(t) - (1 << 63) for t, _ in found])
            sizes.append([SIGNS[kind] * len(t) for t, kind in found])
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, kind), pa.array(sizes, kind)], ["key", "blocks", "sizes"])


def site_blocks(blocks: list[int], sizes: list[int], neighbours: list[list[int] | None]) -> list[int]:
    """Places of blocks outside articles that a neighbour shares, unless it shares nearly all text of the page."""
    gone, whole = set(), sum(map(abs, sizes))
    for other in neighbours:
        met = shared_blocks(blocks, other) if other else []
        if sum(abs(sizes[i]) for i in met) < SAME_TEXT * whole:
            gone.update(i for i in met if sizes[i] > 0)
    return sorted(gone)


def _compare(batches):
    """Rows (key, blocks, sizes, before, after) to (key, shared): places of the blocks that are the site's."""
    for batch in batches:
        rows = [site_blocks(*row[:2], row[2:]) for row in zip(*[batch.column(i).to_pylist() for i in (1, 2, 3, 4)])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int64()))], ["key", "shared"])


def _texts(batches):
    """Rows (page_id, url, html, shared) to (page_id, url, text)."""
    for batch in slices(batches, 2):
        texts = []
        for page, shared in zip(batch.column(2), batch.column(3)):
            gone = set(shared.as_py() or ())
            found = enumerate(page_blocks(page.as_py() or ""))
            texts.append("\n".join(t for i, (t, kind) in found if kind != MAIN_NOISE and i not in gone))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], ["page_id", "url", "text"])


def _neighbours(rows: DataFrame, landing: Landing) -> DataFrame:
    """Adds the blocks of the pages before and after in the order of host and path; no task holds a whole host.

    Rows are sorted into ranges; within one the neighbours are a window away, and the first and last page of each range
    are handed to the ranges beside it.
    """
    order = ["host", "path", "key"]
    ranged = rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    ranged = landing.land(ranged, "ranged")
    page = F.struct(*order, "blocks")
    edges = ranged.groupBy("range").agg(F.min_by(page, F.struct(*order)).alias("first"), F.max_by(page, F.struct(*order)).alias("last"))
    beside = Window.orderBy("range")
    edges = edges.select("range", F.lag("last").over(beside).alias("earlier"), F.lead("first").over(beside).alias("later"))
    within = Window.partitionBy("range").orderBy(*order)
    found = ranged.withColumn("p", F.lag(page).over(within)).withColumn("q", F.lead(page).over(within)).join(edges, "range")
    found = found.withColumn("p", F.coalesce("p", "earlier")).withColumn("q", F.coalesce("q", "later"))
    same = lambda c: F.when(F.col(f"{c}.host") == F.col("host"), F.col(f"{c}.blocks"))
    compared = F.exists("sizes", lambda n: n > 0)
    return found.where(compared).select("key", "blocks", "sizes", same("p").alias("before"), same("q").alias("after"))


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) for every row of `pages`.

    Null, empty and markup-only pages have an empty text. Pages that agree in id, URL and markup are one page when
    compared, but each row is returned. A page without URL, or alone on its host, has no neighbours: what would be
    compared stays. Other columns are ignored; an empty table gives an empty one.
    """
    landing = Landing(pages.sparkSession, "pages")
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    key = F.xxhash64("page_id", "url", "html")
    rows = rows.withColumn("key", key)
    address = F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)([^?#]*)", 1)
    path = F.regexp_replace(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), "/+$", "")
    keyed = rows.where(address != "").select("key", address.alias("host"), path.alias("path"), "html")
    blocks = keyed.select("key", "html").mapInArrow(_open_blocks, "key long, blocks array<long>, sizes array<long>")
    places = rows.select("key", address.alias("host"), path.alias("path")).where("host <> ''").distinct()
    blocks = landing.land(blocks.dropDuplicates(["key"]).join(places, "key"), "blocks")
    shared = _neighbours(blocks, landing).mapInArrow(_compare, "key long, shared array<long>").where(F.size("shared") > 0)
    shared = landing.land(shared, "shared")
    joined = rows.join(shared, "key", "left").select("page_id", "url", "html", "shared")
    texts = joined.mapInArrow(_texts, f"page_id {kind}, url string, text string")
    return texts.select(F.col("page_id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars"))
