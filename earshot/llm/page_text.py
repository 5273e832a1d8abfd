"""Main text of web pages: blocks by markup, and nearest-URL page differencing for what markup leaves open."""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Each alternative matches wherever it can begin, so no part of a page is read twice: a quote without its other half is
# an ordinary character, and a tag without an end goes to the end of the page.
ATTRIBUTES = r"(?:[^'\">]++|\"[^\"]*+\"|'[^']*+'|['\"])*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(script|style|noscript|template|textarea|svg|iframe|object|math|title)\b{ATTRIBUTES}(?:>.*?(?:</\1\s*+>|\Z)|\Z)"
    rf"|<(/?)([a-z][a-z0-9]*+)({ATTRIBUTES})(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
SKIPPED = frozenset("head nav footer aside form button select dialog menu label input".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
MAIN = frozenset(("article", "main"))
ROLE = re.compile(r"(?<![\w-])(?:class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))", re.IGNORECASE)
FURNITURE = frozenset(
    "ad ads advert adverts advertisement banner sponsored promo nav navbar navigation menu breadcrumb breadcrumbs sidebar side footer header "
    "cookie cookies consent notice popup modal newsletter subscribe share sharing social related recommended comment comments disqus replies "
    "widget toolbar pagination pager login search complementary contentinfo".split()
)
NEUTRAL = frozenset(
    "site page main top bottom left right list box bar wrap wrapper container block item items link links button buttons section area slot "
    "unit global primary secondary mobile desktop inner outer form icons js".split()
)
LISTS, TABLES = frozenset(("ul", "ol", "menu")), frozenset(("table",))
ROWS = frozenset(("tr", "tbody", "thead", "tfoot"))
ENDS = {
    "li": (LISTS, frozenset(("li",))),
    "dd": (frozenset(("dl",)), frozenset(("dd", "dt"))),
    "dt": (frozenset(("dl",)), frozenset(("dd", "dt"))),
    "td": (TABLES, ROWS | {"td", "th"}),
    "th": (TABLES, ROWS | {"td", "th"}),
    "tr": (TABLES, ROWS),
}
"""Elements that need no end tag: the containers that end them, and the tags that do so beside them."""
LINES = "lines array<string>, main array<boolean>"


def speaks_of_furniture(attributes: str) -> bool:
    """Whether a class, id or role is made of words for furniture and neutral ones alone: ``site-header``, but not ``has-sidebar``."""
    for found in ROLE.findall(attributes):
        for name in (found[0] or found[1] or found[2]).lower().split():
            words = [w for w in re.split(r"[-_\d]+", name) if w]
            if any(w in FURNITURE for w in words) and all(w in FURNITURE or w in NEUTRAL for w in words):
                return True
    return False


def named_furniture(page: str) -> set[int]:
    """Places of the tags whose class, id or role speaks of furniture and whose element holds at most half of the page's text."""
    total, place = 0, 0
    opened: dict[str, list[tuple[int, int, bool]]] = {}
    sizes = []
    for token in TOKEN.finditer(page):
        total += len(page[place : token.start()].strip())
        place = token.end()
        if token[3] is None:
            continue
        name = token[3].lower()
        if name in VOID:
            continue
        before = opened.setdefault(name, [])
        if token[2] or (name == "p" and before):
            if before:
                at, size, named = before.pop()
                if named:
                    sizes.append((at, total - size))
            if token[2]:
                continue
        named = bool(token[4]) and name not in MAIN and name not in ("body", "html") and speaks_of_furniture(token[4])
        before.append((token.start(), total, named))
    total += len(page[place:].strip())
    never_closed = [(at, total - size) for before in opened.values() for at, size, named in before if named]
    ending = {at for name in ("p", *ENDS) for at, _, _ in opened.get(name, ())}
    return {at for at, size in sizes + never_closed if at in ending or 2 * size <= total}


def page_lines(page: str) -> tuple[list[str], list[bool]]:
    """Text blocks outside the page's furniture, and whether each lies in the main part.

    Furniture is what its tag says it is, or its class, id or role, unless most
    of the page's text lies in it. A paragraph, list item or cell without an end
    tag ends where the next one begins or its list or table ends; any other part
    that is never closed ends where an article begins. Character references are
    decoded and white space becomes one space. The work grows in proportion to
    the page, however broken it is.
    """
    lines, inside, parts = [], [], []
    main = 0
    skip, depth = None, 0
    by_name = named_furniture(page)

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                lines.append(text)
                inside.append(main > 0)

    def still_open(name: str, closing: bool) -> int:
        """The depth of the skipped element after a tag; -1 where the tag ends it and has its own meaning."""
        if skip == "p":
            if name == "p" and closing:
                return 0
            return -1 if name in BLOCKS else depth
        if skip in ENDS:
            containers, beside = ENDS[skip]
            if name in containers:
                return (depth - 1 or -1) if closing else depth + 1
            if name == skip and closing and depth == 1:
                return 0
            return -1 if name in beside and not closing and depth == 1 else depth
        return depth + (0 if name != skip or name in VOID else -1 if closing else 1)

    place = 0
    for token in TOKEN.finditer(page):
        if skip is None and token.start() > place:
            parts.append(page[place : token.start()])
        place = token.end()
        name = token[3]
        if name is None:
            continue
        name = name.lower()
        closing = bool(token[2])
        if skip is not None and name in MAIN and not closing and not main:
            skip = None
        if skip is not None:
            depth = still_open(name, closing)
            if depth <= 0:
                skip = None
            if depth >= 0:
                continue
        if closing:
            if name in BLOCKS:
                flush()
            if name in MAIN and main:
                main -= 1
            continue
        if name in SKIPPED or (name == "header" and not main) or token.start() in by_name:
            flush()
            if name not in VOID and not token[4].endswith("/"):
                skip, depth = name, 1
            continue
        if name in BLOCKS:
            flush()
        elif name == "br":
            parts.append(" ")
        if name in MAIN:
            main += 1
    if skip is None and place < len(page):
        parts.append(page[place:])
    flush()
    return lines, inside


def shared_lines(lines: list[str], other: list[str]) -> set[int]:
    """Places of ``lines`` that belong to a longest common subsequence with ``other``.

    For each line its places in the other page, last first; a longest run of
    increasing places is a longest common subsequence.
    """
    places: dict[str, list[int]] = {}
    for k, line in enumerate(other):
        places.setdefault(line, []).append(k)
    tails: list[int] = []
    ends: list[tuple] = []
    for i, line in enumerate(lines):
        for k in reversed(places.get(line, ())):
            at = bisect_left(tails, k)
            link = (i, ends[at - 1] if at else None)
            if at == len(tails):
                tails.append(k)
                ends.append(link)
            elif k < tails[at]:
                tails[at], ends[at] = k, link
    shared = set()
    link = ends[-1] if ends else None
    while link:
        shared.add(link[0])
        link = link[1]
    return shared


def closeness(a: list[str], b: list[str]) -> int:
    """Leading path segments that two paths share."""
    same = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        same += 1
    return same


def main_text(lines: list[str], main: list[bool], partner: list[str] | None) -> str:
    """The lines of the main part; where none is marked, the lines that the nearest page does not share."""
    if any(main):
        kept = [line for line, m in zip(lines, main, strict=True) if m]
    else:
        shared = shared_lines(lines, partner) if partner is not None else set()
        kept = [line for i, line in enumerate(lines) if i not in shared]
        kept = kept or lines
    return "\n\n".join(kept)


def url_order(host: str, path: list[str], page_id: int | None) -> tuple:
    """A key that sorts as Spark sorts host, path and page, a null id first."""
    return host, path, page_id is not None, page_id or 0


def extract_lines(ranges) -> Callable:
    """The lines of each page, in its range of the sorted URLs.

    The first and the last page of a range go to the range before or after it as
    well, where they are neighbours only (``_beside``).
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows, highs = ranges.value
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("_host", "_path", "page_id")), strict=True)
            rows, parts, beside = [], [], []
            for i, key in enumerate(url_order(*k) for k in keys):
                part = max(0, bisect_right(lows, key) - 1)
                found = [(part, False)]
                if key == lows[part] and part:
                    found.append((part - 1, True))
                if key == highs[part] and part + 1 < len(lows):
                    found.append((part + 1, True))
                rows += [i] * len(found)
                parts += [p for p, _ in found]
                beside += [b for _, b in found]
            lines = [page_lines(page or "") for page in batch.column("html").to_pylist()]
            made = [pa.array([x[0] for x in lines], pa.list_(pa.string())), pa.array([x[1] for x in lines], pa.list_(pa.bool_()))]
            at = batch.schema.get_field_index("html")
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            whole = pa.RecordBatch.from_arrays(columns + made, names=[*names, "lines", "main"])
            if len(rows) > batch.num_rows:
                whole = whole.take(pa.array(rows))
            columns = [*whole.columns, pa.array(parts, pa.int32()), pa.array(beside, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*whole.schema.names, "_part", "_beside"])

    return task


def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of pages that come sorted by range, host and path; each page waits for the next one."""
    before, page = None, None

    def text(before: dict | None, page: dict, after: dict | None) -> str:
        if any(page["main"]):
            return main_text(page["lines"], page["main"], None)
        near = [p for p in (before, after) if p is not None and (p["_part"], p["_host"]) == (page["_part"], page["_host"])]
        best = max(near, key=lambda p: closeness(p["_path"], page["_path"]), default=None)
        return main_text(page["lines"], page["main"], best["lines"] if best else None)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        types = (pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["page_id", "url", "text"])

    for batch in batches:
        rows = []
        for after in batch.to_pylist():
            if page is not None and not page["_beside"]:
                rows.append((page["page_id"], page["url"], text(before, page, after)))
            before, page = page, after
        if rows:
            yield batch_of(rows)
    if page is not None and not page["_beside"]:
        yield batch_of([(page["page_id"], page["url"], text(before, page, None))])


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of each row of ``page_id``, ``url``, ``html``.

    Pages are sorted by host and the segments of the URL path over the whole
    table, so that a large host is spread over many tasks; each page is paired
    with the neighbour in that order, of the same host, that shares more leading
    path segments, the former one on a tie. No other page of the host shares more
    than the two neighbours do. The order is cut into ranges by a pass over the
    URLs alone; the first and the last page of a range are sent to the ranges
    beside it too, so that no pair is lost where tasks meet. Lines are aligned by a longest common subsequence
    and shared ones deleted, unless the markup vouches for them: a block inside
    an article or main element stays, since pages that repeat an article share
    its lines too, and a page with such a part is that part alone. If nothing is
    left, as for two equal pages, all lines stay.

    A null or empty html gives an empty text of 0 characters; a null url counts
    as a host of its own; repeated rows give repeated results; an empty table
    gives no rows. Other columns are left out.
    """
    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    parts = F.split(path, "/").alias("_path")
    keyed = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", host.alias("_host"), parts, "html")
    order = ["_host", "_path", "page_id"]
    context = pages.sparkSession.sparkContext
    n = max(1, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key = F.struct(*order)
    ranged = keyed.select(*order).repartitionByRange(n, *order).groupBy(F.spark_partition_id().alias("_part"))
    # A row for each range: the keys of its first and its last page.
    ends = ranged.agg(F.min(key).alias("low"), F.max(key).alias("high")).collect()
    ranges = context.broadcast(tuple(sorted(url_order(*r[c]) for r in ends) for c in ("low", "high")))
    schema = f"page_id bigint, url string, _host string, _path array<string>, {LINES}, _part int, _beside boolean"
    lines = keyed.mapInArrow(extract_lines(ranges), schema)
    near = lines.repartitionById(max(1, len(ends)), F.col("_part")).sortWithinPartitions("_part", *order)
    texts = near.mapInArrow(difference, "page_id bigint, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
