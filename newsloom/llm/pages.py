"""Main text of web pages: structure, and differences between pages whose URLs are nearest."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.llm.common import batches, spool

#: Pages whose neighbours are looked for in one task.
RANGE_ROWS = 20_000
#: Bits of the states that a comparison of two pages keeps, and of the masks of frequent lines.
STATE_BITS, MASK_BITS = 1 << 25, 1 << 28

_MARKUP = re.compile(
    r"<!--(?s:.*?)(?:-->|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)"
)
_ATTRIBUTE = re.compile(r"([^\s=>\"'/]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+")
_USED = {"class", "id", "role", "hidden", "aria-hidden", "style"}
_PIECES = re.compile(r"[\s_-]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: Elements whose content is no markup; it is skipped.
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary "
    "table tbody tfoot thead tr ul".split()
)
_SPACERS = {"br", "td", "th", "img", "option"}
#: Elements that hold no article text.
_NOISE = set(
    "aside button canvas datalist dialog footer form head header label menu nav noscript object optgroup option "
    "select svg template".split()
)
_MAIN = {"article", "main"}
#: Parts of class names and ids of such elements.
_NOISE_NAMES = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disclaimer footer gdpr header masthead menu modal nav navbar navigation newsletter notice "
    "notices overlay pager pagination popup promo promoted recommended related replies respond share sharing sidebar "
    "signup social sponsor sponsored subscribe subscription teaser toolbar widget".split()
)
#: Those that an article element may have in its name without being one's text: comments, adverts, previews.
_NOISE_ARTICLES = set("ad ads advert comment comments promo recommended related replies reply sponsored teaser".split())
_NOISE_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

#: Elements and roles in which an article is another one than the page's.
_SEALS = _NOISE - {"form", "header", "dialog", "label"}
_SEAL_ROLES = _NOISE_ROLES - {"alert", "alertdialog", "banner", "dialog", "form"}

#: Sealed is noise in which no article opens main again.
SEALED, NOISE, OTHER, MAIN = -1, 0, 1, 2


def _attributes(text: str) -> list[tuple[str, str]]:
    """The attributes that tell what an element is, in order; words inside other attributes' values are none."""
    if not text:
        return []
    found = ((key.lower(), a or b or c) for key, a, b, c in _ATTRIBUTE.findall(text))
    return [(key, value) for key, value in found if key in _USED]


def _is_main(name: str, attributes: list[tuple[str, str]]) -> bool:
    return name in _MAIN or any(key == "role" and value.lower() in _MAIN for key, value in attributes)


def _seals(name: str, attributes: list[tuple[str, str]]) -> bool:
    """Whether an element that is noise may hold other articles than the page's, or none that is shown."""
    if name in _SEALS:
        return True
    for key, value in attributes:
        if key in ("hidden", "aria-hidden", "style") and _is_noise("div", [(key, value)], False):
            return True
        if key == "role" and value.lower() in _SEAL_ROLES:
            return True
        if key in ("class", "id") and not _NOISE_ARTICLES.isdisjoint(_PIECES.split(_CAMEL.sub("-", value).lower())):
            return True
    return False


def _is_noise(name: str, attributes: list[tuple[str, str]], in_main: bool) -> bool:
    if name in _NOISE and not (name == "header" and in_main):
        return True
    if not attributes or name in ("html", "body"):
        return False
    names = _NOISE_ARTICLES if _is_main(name, attributes) else _NOISE_NAMES
    for key, value in attributes:
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "role" and value.lower() in _NOISE_ROLES:
            return True
        if key == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if key in ("class", "id") and not names.isdisjoint(_PIECES.split(_CAMEL.sub("-", value).lower())):
            return True
    return False


def blocks(html: str) -> list[tuple[int, str]]:
    """The text blocks of a page in order, each with its zone: noise, other or main.

    Main is what lies in ``article`` or ``main``, by element or role. Menus, headers (but that of
    an article), footers, asides, forms, adverts, notices and comments are
    noise, by element, role or a part of the class name or id. An article in such a wrapper (a form
    around the page, a layout named by its sidebar) is main all the same, unless the wrapper is
    hidden, an aside, menu or footer, or one of comments, adverts or previews. Comments,
    scripts and styles have no blocks. Character references are decoded and
    white space in a block becomes one space. Unclosed and stray tags are
    taken as they come.
    """
    out: list[tuple[int, str]] = []
    text: list[str] = []
    stack: list[tuple[str, int]] = []
    zone = OTHER
    at = 0

    def close() -> None:
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                out.append((max(zone, NOISE), joined))
            text.clear()

    while True:
        found = _MARKUP.search(html, at)
        if found is None:
            break
        if found.start() > at:
            text.append(entities.unescape(html[at : found.start()]))
        at = found.end()
        name = found[2]
        if name is None:
            continue
        name = name.lower()
        if found[1]:
            if name in _BLOCKS:
                close()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    if stack[depth][1] != zone:
                        close()
                    zone = stack[depth][1]
                    del stack[depth:]
                    break
            continue
        if name in _RAW:
            end = re.compile(rf"</{name}(?![a-z])", re.I).search(html, at)
            at = end.start() if end else len(html)
            continue
        if name in _BLOCKS:
            close()
        elif name in _SPACERS:
            text.append(" ")
        if name in _VOID or found[3].endswith("/") and name not in _BLOCKS:
            continue
        inner = zone
        if zone != SEALED:
            attributes = _attributes(found[3])
            if _is_noise(name, attributes, zone == MAIN):
                inner = SEALED if _seals(name, attributes) else NOISE
            elif _is_main(name, attributes):
                inner = MAIN
        if inner != zone:
            close()
        stack.append((name, zone))
        zone = inner
    if at < len(html):
        text.append(entities.unescape(html[at:]))
    close()
    return out


def _masks(lines: list):
    """For a line, a number with a bit for each place it has in ``lines``; few are held at a time."""
    where: dict = {}
    for j, line in enumerate(lines):
        where.setdefault(line, []).append(j)
    held: dict = {}

    def mask(line) -> int:
        at = where.get(line, ())
        if len(at) < 8:
            return sum(1 << j for j in at)
        if line not in held:
            if len(held) * len(lines) > MASK_BITS:
                held.clear()
            bits = np.zeros(len(lines), dtype=np.uint8)
            bits[at] = 1
            held[line] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
        return held[line]

    return mask


def _grow(state: int, hit: int, full: int) -> int:
    """The next line's state; bit j is 0 where the length of the subsequence grows at j."""
    hit &= state
    return ((state + hit) | (state - hit)) & full


def _lengths(a: list, b: list) -> np.ndarray:
    """Length of a longest common subsequence of ``a`` and each beginning of ``b``."""
    mask, full = _masks(b), (1 << len(b)) - 1
    state = full
    for line in a:
        state = _grow(state, mask(line), full)
    data = np.frombuffer(state.to_bytes(len(b) // 8 + 1, "little"), dtype=np.uint8)
    return np.append(0, np.cumsum(1 - np.unpackbits(data, bitorder="little")[: len(b)].astype(np.int64)))


def _small_lcs(a: list, b: list) -> list[int]:
    """Indexes of ``a`` on a longest common subsequence with ``b``; keeps a state for each line of ``a``."""
    mask, full = _masks(b), (1 << len(b)) - 1
    states = [full]
    for line in a:
        states.append(_grow(states[-1], mask(line), full))
    out, j = [], len(b)
    zeros = lambda s, n: n - (s & ((1 << n) - 1)).bit_count()
    for i in range(len(a), 0, -1):
        while j and (states[i] >> (j - 1)) & 1:
            j -= 1
        if not j:
            break
        if zeros(states[i - 1], j) < zeros(states[i], j):
            out.append(i - 1)
            j -= 1
    return out[::-1]


def shared_lines(own: list, other: list) -> list[int]:
    """Indexes of ``own`` that lie on a longest common subsequence with ``other``.

    Lines that the other page lacks are left out first. Long pages are halved
    where the lengths of both halves add up to most, so memory grows with the
    number of lines, not with its square.
    """
    low = 0
    while low < len(own) and low < len(other) and own[low] == other[low]:
        low += 1
    high = 0
    while high < min(len(own), len(other)) - low and own[-1 - high] == other[-1 - high]:
        high += 1
    there, here = set(other[low : len(other) - high]), set(own[low : len(own) - high])
    places = [i for i in range(low, len(own) - high) if own[i] in there]
    a, b = [own[i] for i in places], [line for line in other[low : len(other) - high] if line in here]
    middle: list[int] = []
    open_parts = [(0, len(a), 0, len(b))]
    while open_parts:  # the part to the left first
        a0, a1, b0, b1 = open_parts.pop()
        if a0 == a1 or b0 == b1:
            continue
        if a1 - a0 == 1 or (a1 - a0) * (b1 - b0) <= STATE_BITS:
            middle.extend(a0 + i for i in _small_lcs(a[a0:a1], b[b0:b1]))
            continue
        half = (a0 + a1) // 2
        left, right = _lengths(a[a0:half], b[b0:b1]), _lengths(a[half:a1][::-1], b[b0:b1][::-1])
        cut = b0 + int(np.argmax(left + right[::-1]))
        open_parts += [(half, a1, cut, b1), (a0, half, b0, cut)]
    return [*range(low), *(places[i] for i in middle), *range(len(own) - high, len(own))]


def _place(url: str | None) -> tuple[str | None, str]:
    """Host and path of a URL; no host if there is none."""
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or None), parts.path
    except ValueError:
        return None, ""


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _pair(rows: pd.DataFrame) -> pd.DataFrame:
    """Which lines each page shares with the page of its host whose path is nearest."""
    rows = rows.sort_values(["host", "path", "page"], kind="stable").reset_index(drop=True)
    hosts, paths, lines = rows["host"].tolist(), rows["path"].tolist(), [list(x) for x in rows["lines"]]
    out = []
    for i in np.flatnonzero(~rows["ghost"].to_numpy()):
        near = [j for j in (i - 1, i + 1) if 0 <= j < len(hosts) and hosts[j] == hosts[i]]
        if near:
            best = max(near, key=lambda j: _common(paths[i], paths[j]))
            shared = shared_lines(lines[i], lines[best])
            if shared:
                out.append((rows.at[i, "page"], np.asarray(shared, dtype=np.int32)))
    return pd.DataFrame(out, columns=["page", "shared"])


def differences(pages: DataFrame) -> DataFrame:
    """Per page (``page``, a hash of its row) the lines shared with its nearest page.

    Pages of a host are put in order of their paths, in ranges of bounded
    size, so a host with most pages is worked on by many tasks; a page at the
    edge of a range sees the first page beyond it. Only hashes of lines move.
    """

    def read(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(stream, "html", 4 << 20):
            out: list[list] = [[], [], [], []]
            for page, url, html in zip(*(table[c].to_pylist() for c in ("page", "url", "html"))):
                host, path = _place(url)
                if host:
                    hashes = [xxhash.xxh64_intdigest(line) - 2**63 for _, line in blocks(html)]
                    for column, value in zip(out, (page, host, path, hashes)):
                        column.append(value)
            kinds = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["page", "host", "path", "lines"])

    rows = spool(pages.select("page", "url", "html").mapInArrow(read, "page long, host string, path string, lines array<long>"), "lines")
    rows = rows.dropDuplicates(["page"])
    ranges = max(1, -(-rows.count() // RANGE_ROWS))
    dealt = spool(
        rows.repartitionByRange(ranges, "host", "path", "page").withColumn("part", F.spark_partition_id()), "ranges"
    )
    key = F.struct("host", "path", "page", "lines")
    edges = dealt.groupBy("part").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    order = Window.orderBy("part")  # one row per range
    beside = edges.select("part", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"))
    ghosts = beside.select("part", F.explode(F.array("before", "after")).alias("row")).where("row IS NOT NULL")
    columns = ("part", "host", "path", "page", "lines")
    both = dealt.select(*columns, F.lit(False).alias("ghost")).unionByName(
        ghosts.select("part", "row.*", F.lit(True).alias("ghost"))
    )
    return both.groupBy("part").applyInPandas(lambda rows: _pair(rows), "page long, shared array<int>")


def main_text(html: str, shared: set[int]) -> tuple[str, int]:
    """The kept blocks joined by line breaks, and how many blocks were deleted because they are shared.

    Where a page marks its article, the blocks in it are the text: two
    articles may share passages, or be copies, and still are whole articles.
    Where none is marked, the blocks that are no noise by their structure and
    are not shared with the nearest page remain; if none does, the page is a
    copy of its neighbour and its blocks stay.
    """
    found = blocks(html)
    if any(zone == MAIN for zone, _ in found):
        kept = [line for zone, line in found if zone == MAIN]
        return "\n".join(kept), sum(1 for i, (zone, _) in enumerate(found) if zone != MAIN and i in shared)
    plain = [(i, line) for i, (zone, line) in enumerate(found) if zone == OTHER]
    kept = [line for i, line in plain if i not in shared]
    if plain and not kept:
        kept = [line for _, line in plain]
    return "\n".join(kept), len(plain) - len(kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars and n_shared of every page.

    Null html is empty and gives an empty text. A page without a host is not
    paired. Repeated rows, equal ids and equal URLs give a row each; other
    columns are left out.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"),
        F.xxhash64("page_id", "url", "html").alias("page"),
    )
    joined = rows.join(differences(rows), "page", "left")

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(stream, "html", 4 << 20):
            done = [main_text(h, set(s or ())) for h, s in zip(table["html"].to_pylist(), table["shared"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    table["page_id"].combine_chunks(),
                    table["url"].combine_chunks(),
                    pa.array([t for t, _ in done], pa.string()),
                    pa.array([len(t) for t, _ in done], pa.int64()),
                    pa.array([n for _, n in done], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars", "n_shared"],
            )

    return joined.select("page_id", "url", "html", "shared").mapInArrow(
        cut, "page_id long, url string, text string, n_chars long, n_shared long"
    )


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
