"""Main text of web pages, by differencing pages with nearby addresses, guided by markup.

A page is cut into text lines, one per block. Pages are sorted by host and path; each page is paired with
the nearest pages of its host that are not near copies of it: the ones before it, or where there are too few the
ones after it. The lines are aligned by longest common subsequences, and lines that its partners share are deleted
as template text.

Markup says which lines may be text at all: what stands in menus, headers, footers, sidebars, forms, scripts
and the like never counts, since menus may differ from page to page; of a page with a declared article (or, where
there is none, a declared main part) only the lines inside it count. Everything that is left goes through the
alignment, so that a notice inside an article that its neighbours have too is deleted. A page of which the
alignment would delete most of the text keeps it: then the neighbours carry the text itself.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections.abc import Iterator
from functools import cached_property
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltmart.llm.common import returns_memory, task_number
from voltmart.session import cut_lineage

# Element names by what they mean for the text.
SILENT = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas",
          "textarea", "select", "title", "head", "noframes", "audio", "video"}
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
          "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small",
          "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "br", "wbr", "img"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "noframes", "template"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog",
         "alertdialog", "menu", "menubar", "toolbar"}
# Elements whose end tag may be left out: a new one ends an open one of the named kinds.
ENDS = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
# Words of class and id attributes that name something beside the article.
BESIDE = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner banners "
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside widget widgets footer masthead "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations comment comments "
    "respond disqus reply replies pager pagination toolbar toc skip".split()
)
# Of an <article> itself only these say that it is not one.
IN_ARTICLE = set("ad ads advert sponsored promo comment comments reply replies related".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*+(?:\"[^\"]*\"|'[^']*')|[^<>])*+)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?",
    re.IGNORECASE,
)
_SPACES = re.compile(r"\s+")
_WORDS = re.compile(r"[A-Za-z]+")

# Inside an article or main part; boilerplate; anything else. Negative: inside an article or main part that
# lies itself in so many elements that stand beside the article, such as a form around the whole page.
KEPT, BELOW, OTHER = 2, 1, 0
PARTNERS = 4  # pages that a page is aligned with
UNDECLARED = 2  # of these, for a page without a declared article or main part
LONG_LINE = 40  # characters of a line that tells near copies
KNOWN = 16  # distinct pages of a host held for the pages after them, and handed to the ranges beside
WAITING, HELD = 64, 8192  # different pages and rows that wait for partners after them
ARTICLE, MAIN = 1, 2
NONE = ("", 0, 0, None, None)


def _names(name: str, words: set[str]) -> bool:
    """Whether a class or id consists of the words only: cookie-notice does, no-sidebar does not."""
    found = _WORDS.findall(name.lower())
    return bool(found) and words.issuperset(found)


def _beside(name: str, attributes: str) -> bool:
    """Whether an element stands beside the article, by its name, role, class, id or being hidden."""
    if name in ASIDE:
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    words = IN_ARTICLE if name == "article" else BESIDE
    for match in _ATTRIBUTE.finditer(attributes):
        kind = match[1].lower()
        value = match[2] or match[3] or match[4] or ""
        if kind == "role" and value.strip().lower() in ROLES:
            return True
        if kind in ("class", "id") and any(_names(each, words) for each in value.split()):
            return True
        if kind == "hidden" or kind == "aria-hidden" and value.strip().lower() == "true":
            return True
        if kind == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
            return True
    return False


def lines_of(page: str) -> Page:
    """The text blocks of a page in order: (text, place, part), place being KEPT inside a declared
    article or main part, BELOW inside boilerplate, else OTHER, or negative; part: ARTICLE inside <article>
    plus MAIN inside a main part."""
    out: list[tuple[str, int, int]] = []
    held: list[str] = []
    # Open elements: (name, beside, silent, article, main), beside and silent counted with those around it;
    # article and main: what beside was around the outermost one, None outside.
    stack: list[tuple[str, int, int, int | None, int | None]] = []
    top = NONE

    def flush() -> None:
        text = _SPACES.sub(" ", entities.unescape("".join(held))).strip()
        held.clear()
        if text:
            _, beside, _, article, main = top
            around = article if article is not None else main
            place = KEPT if around == 0 else OTHER if around is None else -around
            if beside > (around or 0):
                place = BELOW
            out.append((text, place, (article is not None) * ARTICLE + (main is not None) * MAIN))

    at, size = 0, len(page)
    while at < size:
        match = _TAG.search(page, at)
        end = match.start() if match else size
        if end > at and not top[2]:
            held.append(page[at:end])
        if not match:
            break
        at = match.end()
        name = match[3]
        if name is None:
            if match[1] and not top[2]:
                held.append(match[1].replace("&", "&amp;"))
            continue
        name = name.lower()
        if name not in INLINE:
            flush()
        elif name == "br":
            held.append(" ")
        if match[2]:  # an end tag closes the nearest open element of its name and all inside it
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
            top = stack[-1] if stack else NONE
            continue
        if name in VOID:
            continue
        ends = ENDS.get(name)
        if ends:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in ends:
                    del stack[depth:]
                    break
                if stack[depth][0] not in INLINE:
                    break
            top = stack[-1] if stack else NONE
        if name in ("footer", "body") or name == "header" and top[3] is None:
            # These do not lie in a paragraph that was left open.
            while stack and (stack[-1][0] == "p" or stack[-1][0] in INLINE or name == "body"):
                stack.pop()
            top = stack[-1] if stack else NONE
        top = (
            name,
            top[1] + _beside(name, match[4]),
            top[2] + (name in SILENT),
            top[1] if top[3] is None and name == "article" else top[3],
            top[1] if top[4] is None and (name == "main" or 'role="main"' in match[4]) else top[4],
        )
        stack.append(top)
        if name in RAW:  # its content is not markup
            close = re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE).search(page, at)
            if name == "template":
                continue
            at = close.start() if close else size
    flush()
    return Page(out)


# ---- alignment -----------------------------------------------------------------------------------


def _lcs_rows(a: list[int], b: list[int]) -> list[int]:
    """For each prefix of a, which places of b end a longer common subsequence, as the bits of a number:
    a zero bit at j means that b[: j + 1] has one more common line than b[:j]."""
    spots: dict[int, int] = {}
    for j, line in enumerate(b):
        spots[line] = spots.get(line, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, [full]
    for line in a:
        hit = row & spots.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    return rows


PRODUCT = 1 << 28  # bits kept for one alignment; longer ones are halved first


def common_places(a: list[int], b: list[int]) -> set[int]:
    """Places of a that lie in a longest common subsequence of a and b."""
    shared = set(a) & set(b)
    pa = [i for i, x in enumerate(a) if x in shared]
    pb = [j for j, x in enumerate(b) if x in shared]
    low = 0
    while low < len(pa) and low < len(pb) and a[pa[low]] == b[pb[low]]:
        low += 1
    high = 0
    while high < min(len(pa), len(pb)) - low and a[pa[-1 - high]] == b[pb[-1 - high]]:
        high += 1
    found = set(pa[:low]) | (set(pa[len(pa) - high :]) if high else set())
    pa, pb = pa[low : len(pa) - high], pb[low : len(pb) - high]
    if not pa or not pb:
        return found
    left, right = [a[i] for i in pa], [b[j] for j in pb]
    if len(left) * len(right) > PRODUCT and len(left) > 1:
        return found | {pa[i] for i in _halved(left, right)}
    rows = _lcs_rows(left, right)
    i, j = len(left), len(right)
    # Lengths along the last row; walk back through the table of zero bits.
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            found.add(pa[i - 1])
            i, j = i - 1, j - 1
    return found


def _halved(a: list[int], b: list[int]) -> set[int]:
    """The same by divide and conquer: the best cut of b for the halves of a, each solved alone."""
    half = len(a) // 2
    ahead = _lcs_rows(a[:half], b)[-1]
    behind = _lcs_rows(a[half:][::-1], b[::-1])[-1]
    score, reach = [0], 0
    for j in range(len(b)):
        reach += not ahead >> j & 1
        score.append(reach)
    reach, best, cut = 0, score[-1], len(b)
    for j in range(len(b) - 1, -1, -1):
        reach += not behind >> (len(b) - 1 - j) & 1
        if score[j] + reach > best:
            best, cut = score[j] + reach, j
    return common_places(a[:half], b[:cut]) | {half + i for i in common_places(a[half:], b[cut:])}


def _declared(page: Page, part: int) -> tuple[list[int], int]:
    """The lines of the declared articles or main parts with the fewest elements around them that stand
    beside an article, and the number of these elements."""
    found = [(0 if place == KEPT else -place, i) for i, (_, place, of) in enumerate(page)
             if of & part and (place == KEPT or place < 0)]
    least = min(found)[0] if found else 0
    return [i for around, i in found if around == least], least


class Page(list):
    """The lines of a page, (text, place, part) each, and what is asked of them more than once."""

    @cached_property
    def chosen(self) -> list[int]:
        return candidates(self)

    @cached_property
    def texts(self) -> set[str]:
        return {self[i][0] for i in self.chosen}

    @cached_property
    def long(self) -> set[str]:
        return {t for t in self.texts if len(t) >= LONG_LINE}


def candidates(page: Page) -> list[int]:
    """The lines that may be main text, by markup."""
    article, around_article = _declared(page, ARTICLE)
    main, around_main = _declared(page, MAIN)
    if article and main:
        # A teaser is not the article: one beside the main part and further out, or one far shorter.
        size = lambda found: sum(len(page[i][0]) for i in found)
        inside = all(page[i][2] & MAIN for i in article)
        if not inside and around_article > around_main or 2 * size(article) < size(main):
            article = []
    # Where all of it stands in something beside an article, any line may be text.
    return article or main or [i for i, line in enumerate(page) if line[1] == OTHER] or list(range(len(page)))


def shared_lines(page: Page, chosen: list[int], near: Page) -> set[int]:
    """Which of the chosen lines of a page align with lines of another page."""
    numbers: dict[str, int] = {}
    code = lambda lines: [numbers.setdefault(t, len(numbers)) for t in lines]
    here, there = code([page[i][0] for i in chosen]), code([t for t, _, _ in near])
    return {chosen[place] for place in common_places(here, there)}


def main_text(page: Page, near: list[Page]) -> str:
    """The main text of a page, given the pages it is paired with, none of them a near copy. Inside a declared
    article only what PARTNERS pages share is template, since short lines may meet by chance; elsewhere what the nearest
    UNDECLARED ones share, or the only one."""
    chosen = page.chosen
    declared = bool(chosen) and page[chosen[0]][2] > 0
    near = near if declared and len(near) >= PARTNERS else [] if declared else near[:UNDECLARED]
    template = set(chosen) if near else set()
    for other in near:
        template &= shared_lines(page, chosen, other)
        if not template:
            break
    size = lambda places: sum(len(page[i][0]) for i in places)
    # Most of a declared article is not template; of an undeclared page all but nothing may be.
    if declared and 2 * size(template) > size(chosen) or len(template) == len(chosen):
        template = set()
    return "\n".join(page[i][0] for i in chosen if i not in template)


def near_copies(a: Page, b: Page) -> bool:
    """Whether two pages share over half of the shorter one's long lines that may be text. Pages without such
    lines are near copies only where all lines that may be text are the same."""
    if a.long and b.long:
        return 2 * len(a.long & b.long) > min(len(a.long), len(b.long))
    return a.texts == b.texts


# ---- on Spark ------------------------------------------------------------------------------------


def _address(url: str | None) -> tuple[str, str]:
    """Host without a leading www. or m., in lower case, and path with neither query nor fragment."""
    try:
        parts = urlsplit((url or "").strip())
        host = re.sub(r"^(www|m)\.", "", (parts.hostname or "").lower())
        return host, parts.path.rstrip("/")
    except ValueError:
        return "", url or ""


def pack(page: Page) -> bytes:
    return zlib.compress(json.dumps(page, ensure_ascii=False).encode(errors="replace"), 1)


def unpack(data: bytes) -> Page:
    return Page(map(tuple, json.loads(zlib.decompress(data))))


def _lines(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) -> (page_id, url, host, path, lines): packed lines are what is shuffled, not markup."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            both = [_address(u) for u in batch["url"]]
            yield pd.DataFrame(
                {
                    "page_id": batch["page_id"], "url": batch["url"], "host": [h for h, _ in both],
                    "path": [p for _, p in both], "lines": [pack(lines_of(x)) if x else pack([]) for x in batch["html"]],
                }
            )

    return pages.select(F.col("page_id").cast("string").alias("page_id"), "url", "html").mapInPandas(
        returns_memory(run), "page_id string, url string, host string, path string, lines binary"
    )


class Range:
    """One pass over the sorted pages of a range. A page is decided once its partners are known; pages of the
    range's first host that lack partners before them, and those that still wait at its end, go to the border."""

    def __init__(self):
        self.host, self.first_host = None, True
        # Pages of this host, none a near copy of one before it in the list: the last ones, and the first ones.
        self.before: list[Page] = []
        self.dropped = False  # whether `before` has lost one
        self.opening: list[Page] = []
        self.waiting: list[tuple] = []  # (rows of equal lines, lines, partners before, partners after)
        self.held = 0  # rows that wait
        self.out: list[tuple] = []

    def _decide(self, rows: list, page: Page, near: list[Page]) -> None:
        text = main_text(page, near)
        self.out += [(row.page_id, row.url, row.host, None, DECIDED, text, None, None, None, None) for row in rows]

    def _border(self, rows: list, before: list[Page], after: list[Page], kind: int) -> None:
        before, after = [pack(p) for p in before], [pack(p) for p in after]
        self.out += [
            (row.page_id, row.url, row.host, row.path, kind, None, row.lines, before, after, None) for row in rows
        ]

    def _edge(self, kind: int, some: list[Page], whole: bool) -> None:
        """What the ranges beside this one need of the host at its edge, and whether that is all it has there."""
        self.out.append((None, None, self.host, None, kind, None, None, [pack(p) for p in some], None, whole))

    def close_host(self, last: bool) -> None:
        if self.host is None:
            return
        for rows, page, before, after in self.waiting:
            if last or self.first_host:
                self._border(rows, before, after, OPEN)
            else:
                self._decide(rows, page, (before + after)[:PARTNERS])
        if self.first_host:
            self._edge(HEAD, self.opening, not last and len(self.opening) < KNOWN)
        if last:
            self._edge(TAIL, self.before[::-1], not self.first_host and not self.dropped)
        self.first_host, self.waiting, self.before, self.opening = False, [], [], []
        self.dropped, self.held = False, 0

    def add(self, row) -> None:
        if row.host != self.host:
            self.close_host(False)
            self.host = row.host
        page = unpack(row.lines)
        kept = []
        for other in self.waiting:
            if len(other[2]) + len(other[3]) < PARTNERS and _new_partner(other[1], page, other[2] + other[3]):
                other[3].append(page)
            if len(other[2]) + len(other[3]) == PARTNERS and not self.first_host:
                self._decide(other[0], other[1], other[2] + other[3])
                self.held -= len(other[0])
            else:
                kept.append(other)
        self.waiting = kept
        near: list[Page] = []
        for other in self.before[::-1]:
            if len(near) < PARTNERS and _new_partner(page, other, near):
                near.append(other)
        if len(near) == PARTNERS:
            self._decide([row], page, near)
        elif self.dropped:
            self._border([row], [], [], LATE)
        else:
            self._wait(row, page, near)
        if not any(near_copies(page, other) for other in self.before):
            self.dropped = self.dropped or len(self.before) == KNOWN
            self.before = [*self.before[1 - KNOWN :], page]
            if len(self.opening) < KNOWN:
                self.opening.append(page)

    def _wait(self, row, page: Page, near: list[Page]) -> None:
        rows, _, before, after = self.waiting[-1] if self.waiting else ([], None, [], [])
        # An equal page right after another one waits with it.
        if rows and rows[0].lines == row.lines and not after and list(map(id, before)) == list(map(id, near)):
            rows.append(row._replace(lines=rows[0].lines))
        else:
            self.waiting.append(([row], page, near, []))
        self.held += 1
        while len(self.waiting) > WAITING or self.held > HELD:
            rows, _, before, after = self.waiting.pop(0)
            self.held -= len(rows)
            self._border(rows, before, after, CUT if self.first_host else LATE)


def _new_partner(page: Page, other: Page, near: list[Page]) -> bool:
    """Whether a page may be a partner: neither a near copy of the page nor of a partner it has."""
    return not near_copies(page, other) and not any(near_copies(other, n) for n in near)


# CUT: open, but the range has more pages after those it met. LATE: it takes a search of its host.
DECIDED, OPEN, HEAD, TAIL, CUT, LATE = 0, 1, 2, 3, 4, 5
CHUNK = 512  # pages of a host that a search meets at once


def _hosts(urls: pd.Series) -> pd.Series:
    return urls.map(lambda url: _address(url)[0])


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted pages and searches of a range -> its chunks, the pages of one host each, and the searches with
    the chunk they stand in and the number of its pages before them."""
    part, host, number, asks, held = task_number(), None, 0, 0, []
    names = ["host", "part", "number", "pages", "ask", "place", "page_id", "url", "lines"]
    out: list[tuple] = []

    def close() -> None:
        nonlocal number, held
        if host is not None:
            out.append((host, part, number, held, None, None, None, None, None))
        number, held = number + 1, []

    for batch in batches:
        for row in batch.itertuples(index=False):
            if row.host != host or len(held) == CHUNK:
                close()
                host = row.host
            if row.asked:
                out.append((host, part, number, None, asks, len(held), row.page_id, row.url, row.lines))
                asks += 1
            else:
                held.append(row.lines)
        yield pd.DataFrame(out, columns=names)
        out = []
    close()
    yield pd.DataFrame(out, columns=names)


def _look(asked: pd.DataFrame, chunk: pd.DataFrame) -> pd.DataFrame:
    """The searches that find partners in a chunk, with all they have then. A page refused once is refused for
    good, since partners are only added; so equal pages are looked at once."""
    out, known = [], {}
    pages = chunk["pages"].iloc[0] if len(chunk) else []
    kinds: dict[bytes, int] = {}
    kind = [kinds.setdefault(bytes(p), len(kinds)) for p in pages]
    opened = [unpack(p) for p in kinds]
    for row in asked.itertuples(index=False):
        places = range(len(pages))
        if row.step == 0:
            places = places[: row.place]
        elif row.step == row.own + 1:
            places = places[row.place :]
        places = places[::-1] if row.step <= row.own else places
        had = tuple(bytes(p) for p in row.near)
        same = (row.lines, had, places)
        if same not in known:
            page, near, more = unpack(row.lines), [unpack(p) for p in had], []
            for k in dict.fromkeys(kind[place] for place in places):
                if len(near) == PARTNERS:
                    break
                if _new_partner(page, opened[k], near):
                    near.append(opened[k])
                    more.append(k)
            known[same] = [*had, *[pack(opened[k]) for k in more]] if more else None
        if known[same]:
            out.append((row.part, row.ask, row.step, known[same]))
    return pd.DataFrame(out, columns=["part", "ask", "step", "found"])


def _search(pages: DataFrame, late: DataFrame) -> DataFrame:
    """(page_id, url, text) of late pages, (page_id, url, host, path, lines): each meets the pages of its host before it, the
    nearest first, then those after it, until it has its partners or the host ends.

    Hosts are cut into chunks. A round asks twice as many chunks per page as the round before; of those that have
    a partner for the page only the first one counts, and the page goes on behind it. So rounds are few, a task holds a chunk
    and the searches that stand in one other chunk, and no page is passed over. Where all pages of a host are near copies without
    being equal each of them meets every other one: that is quadratic in such a host.
    """
    order = ["host", "path", "page_id", "url"]
    columns = [*order, "lines"]
    hosts = cut_lineage(late.select("host").distinct(), "hosts")
    own = F.pandas_udf(_hosts, "string")("url")
    their = pages.select("page_id", "url", "html", own.alias("host")).join(hosts, "host", "left_semi")
    rows = _lines(their).select(*columns, F.lit(False).alias("asked")).unionByName(
        late.select(*columns, F.lit(True).alias("asked"))
    )
    cut = cut_lineage(
        rows.repartitionByRange(*order, "asked").sortWithinPartitions(*order, "asked").mapInPandas(
            returns_memory(_chunks),
            "host string, part int, number int, pages array<binary>, ask int, place int, page_id string, url string, "
            "lines binary",
        ),
        "chunks",
    )
    is_chunk = F.col("ask").isNull()
    line = Window.partitionBy("host").orderBy("part", "number")
    numbers = cut.where(is_chunk).select(
        "host", "part", "number", (F.row_number().over(line) - 1).alias("chunk"),
        F.count(F.lit(1)).over(Window.partitionBy("host")).cast("int").alias("chunks"),
    )
    chunks = cut_lineage(
        cut.where(is_chunk).select("host", "part", "number", "pages").join(numbers, ["host", "part", "number"])
        .select("host", "chunk", "pages"),
        "chunks",
    )
    asked = (
        cut.where(~is_chunk).drop("pages").join(numbers, ["host", "part", "number"])
        .withColumnRenamed("chunk", "own").drop("number")
        .withColumn("step", F.lit(0)).withColumn("near", F.array().cast("array<binary>"))
    )
    # Steps: 0 to own go back to the first chunk, own + 1 to chunks forward to the last one.
    ended = (F.size("near") >= PARTNERS) | (F.col("step") > F.col("chunks"))
    done, span = None, 1
    asked = cut_lineage(asked, "asked")
    while not asked.isEmpty():
        last = F.least(F.col("step") + F.lit(span - 1), F.col("chunks"))
        pairs = asked.withColumn("step", F.explode(F.sequence("step", last))).withColumn(
            "chunk", F.when(F.col("step") <= F.col("own"), F.col("own") - F.col("step")).otherwise(F.col("step") - 1)
        )
        key = ["host", "own", "chunk"]
        wanted = pairs.select(*[F.col(k).alias(f"at_{k}") for k in key]).distinct()
        met = wanted.join(chunks, (F.col("host") == F.col("at_host")) & (F.col("chunk") == F.col("at_chunk"))).select(
            *[f"at_{k}" for k in key], "pages"
        )
        found = pairs.groupBy(*key).cogroup(met.groupBy(*[f"at_{k}" for k in key])).applyInPandas(
            _look, "part int, ask int, step int, found array<binary>"
        )
        first = found.groupBy("part", "ask").agg(
            F.min_by("found", "step").alias("found"), F.min("step").alias("at")
        )
        asked = cut_lineage(
            asked.join(first, ["part", "ask"], "left")
            .withColumn("step", F.coalesce(F.col("at"), F.col("step") + F.lit(span - 1)) + 1)
            .withColumn("near", F.coalesce("found", "near")).drop("found", "at"),
            "asked",
        )
        ready = asked.where(ended)
        done = ready if done is None else done.unionByName(ready)
        asked, span = asked.where(~ended), 2 * span

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                (row.page_id, row.url, main_text(unpack(row.lines), [unpack(p) for p in row.near]))
                for row in batch.itertuples(index=False)
            ]
            yield pd.DataFrame(out, columns=["page_id", "url", "text"])

    return done.select("page_id", "url", "lines", "near").mapInPandas(decide, "page_id string, url string, text string")


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, ...) -> (page_id, url, text, n_chars), one row per row of pages.

    Character references are decoded, white space inside a block becomes one space, blocks are joined in
    page order by a line feed. Null or empty html gives an empty text; null urls form a host of their
    own. Copies and near copies of a page are not its partners; a page that has no other neighbours keeps what markup
    says. Other columns are not looked at.

    The pages are range-partitioned by host and path, so that a host with a third of all pages runs over many
    ranges; each range is read once, holding a few pages. Pages at its edges whose partners may lie in the range
    before or after are decided in a second pass, by the few pages which each range hands to its neighbours. Pages
    that lack partners then, although their host has more pages than they have met, search it (see _search).
    """
    order = ["host", "path", "page_id", "url"]
    names = ["page_id", "url", "host", "path", "kind", "text", "lines", "before", "after", "whole"]

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = Range()
        for batch in batches:
            for row in batch.itertuples(index=False):
                state.add(row)
            yield frame(state)
        state.close_host(True)
        yield frame(state)

    def frame(state: Range) -> pd.DataFrame:
        rows, state.out = state.out, []
        return pd.DataFrame([(*row, task_number()) for row in rows], columns=[*names, "part"])

    found = cut_lineage(
        _lines(pages).repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
            returns_memory(decide),
            "page_id string, url string, host string, path string, kind int, text string, lines binary, "
            "before array<binary>, after array<binary>, whole boolean, part int",
        ),
        "pages",
    )
    # Which range stands before and after each: numbers of ranges only, empty ones left out.
    ranges = found.where(F.col("kind") == TAIL).select("part").distinct()
    line = Window.orderBy("part")
    ranges = ranges.select("part", F.lag("part").over(line).alias("previous"), F.lead("part").over(line).alias("next"))
    edge = lambda kind, name, at: found.where(F.col("kind") == kind).select(
        F.col("part").alias(at), F.col("host").alias(f"host_{name}"), F.col("before").alias(name),
        F.col("whole").alias(f"all_{name}"),
    )
    asked = found.where(F.col("kind").isin(OPEN, CUT)).join(ranges, "part")
    for kind, name, at in ((TAIL, "earlier", "previous"), (HEAD, "later", "next")):
        side = edge(kind, name, f"{at}_part")
        same = (F.col(at) == F.col(f"{at}_part")) & F.col("host").eqNullSafe(F.col(f"host_{name}"))
        asked = asked.join(side, same, "left")

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                page, near, late = unpack(row.lines), [], False
                for some, whole in (
                    (row.before, True), (row.earlier, row.all_earlier in (None, True)), (row.after, row.kind == OPEN),
                    (row.later, row.all_later in (None, True)),
                ):
                    for other in map(unpack, [] if some is None else some):
                        if len(near) < PARTNERS and _new_partner(page, other, near):
                            near.append(other)
                    late = len(near) < PARTNERS and not whole
                    if late:
                        break
                text = None if late else main_text(page, near)
                out.append((row.page_id, row.url, row.host, row.path, row.lines if late else None, text))
            yield pd.DataFrame(out, columns=["page_id", "url", "host", "path", "lines", "text"])

    met = cut_lineage(
        asked.select(
            "page_id", "url", "host", "path", "kind", "lines", "before", "earlier", "all_earlier", "after", "later", "all_later",
        ).mapInPandas(again, "page_id string, url string, host string, path string, lines binary, text string"),
        "border",
    )
    columns = ["page_id", "url", "host", "path", "lines"]
    late = met.where("text is null").select(*columns).unionByName(
        found.where(F.col("kind") == LATE).select(*columns)
    )
    texts = met.where("text is not null").select("page_id", "url", "text")
    if not late.isEmpty():
        texts = texts.unionByName(_search(pages, late))
    return (
        found.where(F.col("kind") == DECIDED)
        .select("page_id", "url", "text")
        .unionByName(texts)
        .select(
            F.col("page_id").cast(pages.schema["page_id"].dataType).alias("page_id"),
            "url",
            "text",
            F.length("text").cast("long").alias("n_chars"),
        )
    )
