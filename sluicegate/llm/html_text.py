"""Main text of web pages, by differencing each page with its nearest one.

A page is cut into lines, one per block of its layout.  Lines of menus, headers, footers,
sidebars, notices, adverts, forms and reader comments are told by the elements they stand
in.  A word in class, id or role marks an element only where it holds little of the text:
never an article, nor a wrapper of most of a page.  Pages are then paired with a neighbour in the order of URL paths within their host,
the lines of both are aligned by a longest common subsequence, and shared lines go.

A page that marks its article keeps the article's own lines though a neighbour has them
too: passages that two articles share are text.  Every other line, with an article or
without, is decided by differencing.  A page without a neighbour to tell by is its article,
or all its lines.

Neighbours in a row that share most of each other are a block.  A page is held against the
pages beside it and those beside its block, however long that is; see ``_gone``.

Hosts are cut into runs of neighbouring paths on a bounded sample of URLs, so that no host
is one task.  A run also gets the pages that its ends need from other runs, so texts do not
depend on where the cuts are.  The pairing sees hashes of lines; texts stay where they are.

Null and empty pages have empty text.  Null URLs are a host of their own.  Repeated rows
are one page to the pairing and get the same text.  An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import stored

# Pages per run of paths, and the bound of the sample of URLs that cuts hosts into runs.
RUN_PAGES = 2000
SAMPLE_URLS = 1 << 14
# A neighbour with more than this part of a page's words may be a copy of it.
COPY_SHARE = 0.5

# Elements without content for a reader, furniture, blocks, and empty elements.
RAW = "script style noscript template textarea title iframe object svg math canvas audio video select".split()
FURNITURE = "head nav footer aside form button dialog menu fieldset".split()
BLOCKS = """address article blockquote body center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6
    header hr html li main ol p pre section summary table tbody td tfoot th thead tr ul""".split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
MAIN = "article main".split()
# Words in class, id and role that mark furniture.
FURNITURE_WORDS = """ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments
    complementary consent contentinfo cookie cookies disqus footer gdpr hidden masthead menu modal nav navbar
    navigation newsletter notice pager pagination popup promo related search share sharing sidebar social
    sponsor sponsored subscribe toolbar widget""".split()

# Words of reader comments, which may be longer than the article they stand in.
COMMENT_WORDS = "comment comments disqus".split()
# In compound names, the words behind a furniture word that name a part of a layout, and those
# before one that say whether there is such a part.
LAYOUT_WORDS = """area bar block box button buttons container content group header icons item items label
    link links list panel post posts region section signup slot strip text title unit wrap wrapper""".split()
STATE_WORDS = "has hide is no open show with without".split()
# An element marked by a word is no furniture with more than this part of the words around.
LITTLE = 0.5

_RAW_NAMES = "|".join(RAW)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW_NAMES})\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>|<(/?)([a-z][^\s/>]*)([^>]*)>",
    re.S | re.I,
)
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HEADING = frozenset(["h1"])
_FURNITURE, _FURNITURE_WORDS = frozenset(FURNITURE), frozenset(FURNITURE_WORDS)
_BLOCKS, _VOID, _MAIN = frozenset(BLOCKS), frozenset(VOID), frozenset(MAIN)


@dataclass
class Line:
    text: str
    main: bool
    links: bool
    marked: tuple[int, ...] = ()


@dataclass
class Marked:
    """An element that a word in class, id or role marks as furniture."""

    depth: int
    inside_main: bool
    comments: bool
    heading: bool = False


def _names_furniture(value: str) -> bool:
    """Whether a class, id or role names furniture: the word itself, at the end of a compound
    name, or before the word for a part of a layout."""
    words = [w.lower() for w in _WORD.findall(value) if not w.isdigit()]
    if not words or words[0] in STATE_WORDS:
        return False
    return words[-1] in _FURNITURE_WORDS or (words[0] in _FURNITURE_WORDS and words[-1] in LAYOUT_WORDS)


def _is_furniture(name: str, attributes: str, inside_main: bool) -> bool:
    """Whether the element is furniture by its tag, or hidden."""
    if name in _FURNITURE or (name == "header" and not inside_main):
        return True
    return bool(attributes.strip() and _HIDDEN.search(attributes))


def _mark(attributes: str) -> tuple[bool, bool]:
    """Whether a word marks the element as furniture, and as reader comments."""
    if "=" not in attributes:
        return False, False
    values = [v for a, b, c in _MARKS.findall(attributes) for v in (a or b or c).split() if _names_furniture(v)]
    return bool(values), any(w.lower() in COMMENT_WORDS for v in values for w in _WORD.findall(v))


def _kept(found: list[Line], marked: list[Marked]) -> list[Line]:
    """The lines but those of marked elements that hold little of the page, or mostly links.

    Beside a marked article, all marked elements go; within it, what they hold is measured
    against the article.  Reader comments may be longer.  Elements with the page's heading stay.
    """
    if not marked:
        return found
    sizes = [line.text.count(" ") + 1 for line in found]
    article = sum(n for line, n in zip(found, sizes, strict=True) if line.main)
    total = sum(sizes)
    own, links = [0] * len(marked), [0] * len(marked)
    for line, n in zip(found, sizes, strict=True):
        for k in line.marked:
            own[k] += n
            links[k] += n * line.links
    gone = set()
    for k, element in enumerate(marked):
        around = article if element.inside_main else total
        little = own[k] <= LITTLE * around or 2 * links[k] > own[k] or (element.comments and own[k] < around)
        if not element.heading and (little or (article and not element.inside_main)):
            gone.add(k)
    return [line for line in found if gone.isdisjoint(line.marked)]


def lines(page: str) -> list[Line]:
    """The lines of a page in its order, furniture left out.

    An element that was never closed ends with the element it stands in; an article or the
    body ends furniture that was never closed.
    """
    out: list[Line] = []
    stack: list[str] = []
    marked: list[Marked] = []
    within: list[int] = []  # the marked elements that are open
    skip = main = 0  # depth of the stack at which furniture, or the main element, began
    parts: list[str] = []
    linked = plain = False

    def flush() -> None:
        nonlocal linked, plain
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Line(text, main > 0, linked and not plain, tuple(within)))
        parts.clear()
        linked = plain = False

    def add(text: str) -> None:
        nonlocal linked, plain
        if skip or not text:
            return
        parts.append(text)
        if not text.isspace():
            if "a" in stack:
                linked = True
            else:
                plain = True

    at = 0
    for token in _TOKEN.finditer(page):
        add(page[at : token.start()])
        at = token.end()
        name = token[3] or token[6]
        if not name:
            if token[1]:
                add(" ")
            continue
        name, closing, attributes = name.lower(), bool(token[2] or token[5]), token[4] or token[7] or ""
        if name in _BLOCKS or name in _FURNITURE:
            flush()
        elif name == "br":
            add(" ")
        if closing:
            if name in stack:
                depth = len(stack) - stack[::-1].index(name)
                if main and depth < main and name not in ("body", "html"):
                    continue  # closes something outside the article, from within it
                del stack[depth - 1 :]
                skip, main = (0 if len(stack) < skip else skip), (0 if len(stack) < main else main)
                if within and marked[within[-1]].depth > len(stack):
                    flush()
                    within = [k for k in within if marked[k].depth <= len(stack)]
            continue
        if name in _VOID or attributes.rstrip().endswith("/"):
            continue
        if name in _MAIN and not _is_furniture(name, attributes, bool(main)):
            if skip and not any(s in ("aside", "form", "dialog") for s in stack):
                skip = 0
            if not main and not skip:
                main, within = len(stack) + 1, []
        elif name == "body":
            skip, within = 0, []
        if name in ("p", "li", "td", "th", "tr", "dt", "dd") and stack and stack[-1] == name:
            stack.pop()
            within = [k for k in within if marked[k].depth <= len(stack)]
        stack.append(name)
        if skip or name in ("body", "html"):
            continue
        if _is_furniture(name, attributes, bool(main)):
            skip = len(stack)
        elif name in _HEADING:
            for k in within:
                marked[k].heading = True
        elif name not in _MAIN:
            furniture, comments = _mark(attributes)
            if furniture:
                flush()
                within = [*within, len(marked)]
                marked.append(Marked(len(stack), bool(main), comments))
    add(page[at:])
    flush()
    return _kept(out, marked)


def page_lines(page: str | None) -> list[tuple[str, bool]]:
    """(text, stays even if shared) of all lines but menus of links; the article's lines stay."""
    return [(line.text, line.main) for line in lines(page or "") if line.main or not line.links]


def candidate_lines(page: str | None) -> list[tuple[str, bool]]:
    """The lines of a page without a neighbour: the article's, or all."""
    found = page_lines(page)
    return [line for line in found if line[1]] or found


# Bits of alignment tables that are held at once.
TABLE_BITS = 1 << 28


def _last_row(a: list[int], b: list[int], rows: list[bytes] | None = None) -> int:
    """Bit j is 0 where the longest common subsequence with ``a`` grows at ``b[j]``; a row per line of a.

    All of b is looked at in one addition, so equal lines cost no more than others.
    """
    where: dict[int, int] = {}
    for j, line in enumerate(b):
        where[line] = where.get(line, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, size = full, -(-len(b) // 8)
    for line in a:
        met = row & where.get(line, 0)
        row = ((row + met) | (row - met)) & full
        if rows is not None:
            rows.append(row.to_bytes(size, "little"))
    return row


def _growth(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of a and each start of b."""
    row = _last_row(a, b).to_bytes(-(-len(b) // 8), "little")
    grows = 1 - np.unpackbits(np.frombuffer(row, np.uint8), bitorder="little")[: len(b)].astype(np.int64)
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(grows)])


def _common(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence, the table cut in half until it fits."""
    if not a or not b:
        return []
    if len(a) * len(b) > TABLE_BITS and len(a) > 1:
        half = len(a) // 2
        ends = _growth(a[:half], b) + _growth(a[half:][::-1], b[::-1])[::-1]
        cut = int(ends.argmax())
        return _common(a[:half], b[:cut]) + [half + i for i in _common(a[half:], b[cut:])]
    rows: list[bytes] = []
    _last_row(a, b, rows)

    def level(i: int, j: int) -> int:
        return rows[i][j >> 3] >> (j & 7) & 1

    out, i, j = [], len(a), len(b)
    while i and j:
        if level(i - 1, j - 1):
            j -= 1
            continue
        i -= 1
        if not i or level(i - 1, j - 1):
            j -= 1
            out.append(i)
    return out[::-1]


def shared(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``."""
    low, high = 0, 0
    most = min(len(a), len(b))
    while low < most and a[low] == b[low]:
        low += 1
    while high < most - low and a[-1 - high] == b[-1 - high]:
        high += 1
    inner_b = b[low : len(b) - high]
    there = set(inner_b)
    at = [i for i in range(low, len(a) - high) if a[i] in there]
    here = {a[i] for i in at}
    middle = _common([a[i] for i in at], [line for line in inner_b if line in here])
    return [*range(low), *(at[k] for k in middle), *range(len(a) - high, len(a))]


def _place(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL, without scheme, query and fragment."""
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url or "")
    rest = re.split(r"[?#]", rest, maxsplit=1)[0]
    host, _, path = rest.partition("/")
    return host.lower(), path


def _key(url: str | None, page_id: int | None) -> str:
    host, path = _place(url)
    return f"{host}\0{path}\0{xxhash.xxh64_hexdigest(str(page_id))}"


def _parsed(pages: DataFrame, cuts: list[str]) -> DataFrame:
    """(page_id, url, row_key, place, run, texts, hashes, sizes, fixed) per page."""
    names = ["page_id", "url", "row_key", "place", "run", "texts", "hashes", "sizes", "fixed"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                rows = []
                for page_id, url, page in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    found = page_lines(page)
                    texts = [t for t, _ in found]
                    place = _key(url, page_id)
                    stays = [s for _, s in found]
                    row_key = xxhash.xxh64_intdigest(f"{place}\0{url}\0{stays}" + "\n".join(texts)) - (1 << 63)
                    hashes = [xxhash.xxh64_intdigest(t) - (1 << 63) for t in texts]
                    sizes = [t.count(" ") + 1 for t in texts]
                    run = bisect.bisect_right(cuts, place)
                    rows.append((row_key, place, run, texts, hashes, sizes, stays))
                columns = zip(*rows, strict=True)
                kinds = [pa.int64(), pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.bool_())]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *arrays], names=names)

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.mapInArrow(
        work,
        f"page_id {kind}, url string, row_key bigint, place string, run int, "
        "texts array<string>, hashes array<bigint>, sizes array<int>, fixed array<boolean>",
    )


def _like(a: str, b: str) -> int:
    """How many characters two places have in common from the front; none across hosts."""
    if a.split("\0", 1)[0] != b.split("\0", 1)[0]:
        return -1
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


class _Run:
    """The pages of a run in order, with those carried from other runs."""

    def __init__(self, frame: pd.DataFrame) -> None:
        order = sorted(range(len(frame)), key=list(zip(frame["place"], frame["row_key"], strict=True)).__getitem__)
        frame = frame.iloc[order]
        self.places, self.keys = frame["place"].tolist(), frame["row_key"].tolist()
        self.hashes = [list(h) for h in frame["hashes"]]
        self.sizes, self.fixed = [list(s) for s in frame["sizes"]], [list(f) for f in frame["fixed"]]
        self.totals = [sum(s) for s in self.sizes]
        self.carried = frame["carried"].tolist()

    def words(self, i: int, lines: Iterable[int]) -> int:
        return sum(self.sizes[i][k] for k in lines)

    def linked(self, i: int) -> bool:
        """Whether page i and the next one share most of either, so that one may copy the other."""
        if _like(self.places[i], self.places[i + 1]) < 0:
            return False
        same = shared(self.hashes[i], self.hashes[i + 1])
        return self.words(i, same) > COPY_SHARE * max(self.totals[i], self.totals[i + 1])


def _gone(run: _Run, i: int, near: list[int]) -> list[int]:
    """Positions of the lines that page i loses to the nearest of the pages ``near``.

    A page that has all of page i tells nothing.  One that has most of it is a copy, unless
    most of what they share is also in a page that has less of page i: then it is furniture.
    Where all pages have most of page i, it is furniture too.
    """
    loose = [k for k, stays in enumerate(run.fixed[i]) if not stays]
    if not loose:
        return []
    taken: list[int] | None = None
    for j in sorted(set(near), key=lambda j: (-_like(run.places[i], run.places[j]), abs(i - j) > 1, j)):
        same = shared(run.hashes[i], run.hashes[j])
        if len(same) == len(run.hashes[i]):
            continue
        if run.words(i, same) > COPY_SHARE * run.totals[i]:
            taken = same if taken is None else taken
            continue
        if taken is None or 2 * run.words(i, set(taken).intersection(same)) < run.words(i, taken):
            taken = same
        break
    if taken is None:
        return loose if len(loose) < len(run.hashes[i]) else []
    return [k for k in taken if not run.fixed[i][k]]


def difference(frame: pd.DataFrame) -> pd.DataFrame:
    """(row_key, gone) of the pages of a run: positions of lines that are not main text."""
    run = _Run(frame)
    n = len(run.keys)
    # Of two carried pages at one end, the inner one is of the end's block and the outer one beside it.
    linked = [not (run.carried[i] and run.carried[i + 1]) and run.linked(i) for i in range(n - 1)]
    low, high = list(range(-1, n - 1)), list(range(1, n + 1))
    for i in range(1, n):
        low[i] = low[i - 1] if linked[i - 1] else i - 1
    for i in range(n - 2, -1, -1):
        high[i] = high[i + 1] if linked[i] else i + 1
    out: list[tuple[int, list[int]]] = []
    for i, key in enumerate(run.keys):
        if run.carried[i]:
            continue
        near = (j for j in (i - 1, i + 1, low[i], high[i]) if 0 <= j < n)
        gone = _gone(run, i, [j for j in near if _like(run.places[i], run.places[j]) >= 0])
        if gone:
            out.append((key, gone))
    return pd.DataFrame(out, columns=["row_key", "gone"])


def _ends(frame: pd.DataFrame) -> pd.DataFrame:
    """One row per run: whether its first page is linked to the carried page before it, and
    the first page behind its first block and the last page before its last block, if any."""
    run = _Run(frame)
    own = run.carried.index(False)
    number = int(frame["run"].iloc[0])
    low, high = own, len(run.keys) - 1
    while low < high and run.linked(low):
        low += 1
    while high > own and run.linked(high - 1):
        high -= 1
    behind = low + 1 if low + 1 < len(run.keys) else None
    before = high - 1 if high > own else None
    row = [number, own > 0 and run.linked(own - 1)]
    for i in (behind, before):
        row += [None, None] if i is None else [run.places[i], run.keys[i]]
    return pd.DataFrame([row], columns=["run", "joined", "behind_place", "behind_key", "before_place", "before_key"])


def _placed(seen: DataFrame, more: list[tuple[int, str, int]]) -> DataFrame:
    """The pages in their runs, and once more in each run that ``more`` (to, place, key) names."""
    spark = seen.sparkSession
    # A few rows per run, of which there are fewer than sampled URLs.
    wanted = spark.createDataFrame(sorted(set(more)), "to int, at string, key long").groupBy("at", "key").agg(F.collect_list("to").alias("to"))
    same = (F.col("place") == F.col("at")) & (F.col("row_key") == F.col("key"))
    own = F.array(F.struct(F.col("run").alias("run"), F.lit(False).alias("carried")))
    others = F.transform(F.coalesce("to", F.array().cast("array<int>")), lambda r: F.struct(r.alias("run"), F.lit(True).alias("carried")))
    joined = seen.join(F.broadcast(wanted), same, "left").withColumn("runs", F.concat(own, others)).drop("run")
    return joined.select("place", "row_key", "hashes", "sizes", "fixed", F.inline("runs"))


def _carried(seen: DataFrame) -> list[tuple[int, str, int]]:
    """(run, place, row_key) of the pages that each run needs from other ones: those beside
    it, and those beside the blocks that its first and its last page belong to."""
    page = F.struct("place", "row_key")
    found = seen.groupBy("run").agg(F.min(page).alias("first"), F.max(page).alias("last")).orderBy("run").collect()
    runs = [r.run for r in found]
    first, last = [tuple(r.first) for r in found], [tuple(r.last) for r in found]
    beside = [(runs[i], *last[i - 1]) for i in range(1, len(runs))]
    ends = _placed(seen, beside).groupBy("run").applyInPandas(
        _ends, "run int, joined boolean, behind_place string, behind_key long, before_place string, before_key long"
    )
    end = sorted(ends.collect(), key=lambda r: r.run)
    out = beside + [(runs[i], *first[i + 1]) for i in range(len(runs) - 1)]
    # The nearest page before a run, and behind it, that is in another block.
    before = None
    for i in range(1, len(runs)):
        within = (end[i - 1].before_place, end[i - 1].before_key)
        if not end[i].joined:
            before = last[i - 1]
        elif within[0] is not None:
            before = within
        if before:
            out.append((runs[i], *before))
    behind = None
    for i in range(len(runs) - 2, -1, -1):
        within = (end[i + 1].behind_place, end[i + 1].behind_key)
        if not end[i + 1].joined:
            behind = first[i + 1]
        elif within[0] is not None:
            behind = within
        if behind:
            out.append((runs[i], *behind))
    return out


def main_text(pages: DataFrame, run_pages: int = RUN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    rows = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    total = rows.count()
    wanted = max(1, total // run_pages)
    # A bounded sample that reruns repeat; every page is then placed.
    chosen = F.pmod(F.xxhash64("url", "page_id"), F.lit(1 << 30)) <= (SAMPLE_URLS << 30) // max(1, total)
    sample = rows.select("url", "page_id").filter(chosen).distinct()
    places = sorted(_key(r.url, r.page_id) for r in sample.collect())
    cuts = sorted({places[len(places) * i // wanted] for i in range(1, wanted)}) if places else []
    parsed = stored(_parsed(rows, cuts), "lines")
    seen = parsed.filter("size(hashes) > 0").select("run", "place", "row_key", "hashes", "sizes", "fixed")
    seen = stored(seen.dropDuplicates(["run", "row_key"]), "seen")
    placed = _placed(seen, _carried(seen))
    gone = placed.groupBy("run").applyInPandas(difference, "row_key bigint, gone array<int>")
    gone = stored(gone, "shared").withColumnRenamed("row_key", "key")
    kept = F.when(F.col("gone").isNull(), F.col("texts")).otherwise(
        F.filter("texts", lambda t, i: ~F.array_contains("gone", i))
    )
    text = parsed.join(gone, F.col("row_key") == F.col("key"), "left").withColumn("text", F.array_join(kept, "\n"))
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
