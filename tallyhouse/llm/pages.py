"""Main text of web pages by differencing each page with its nearest URLs."""

from __future__ import annotations

import bisect
import hashlib
import html as entities
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from .common import partitions

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.DOTALL)
_DIGITS = re.compile(r"\d+")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)

# fixed values: elements of HTML by role
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_UNSEEN = set("script style noscript template iframe object svg head title textarea select button canvas audio video math".split())
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template"}
_BLOCK = set("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer
 form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr
 ul""".split())
_FURNITURE = set("nav aside footer form menu dialog".split())
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>?", re.IGNORECASE) for name in _RAW}
_SCOPES = {"p", "article", "body", "td", "div"}
_CLOSED_BY_BLOCK = _BLOCK - {"li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "option"}
#: Words of class, id and role that mark what is no article text.
_MARKS = re.compile(
    r"^(?:ad|ads|adv|advert\w*|adbox|adslot|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|comments?|disqus"
    r"|sidebars?|menus?|nav|navbar|navigation|breadcrumbs?|footer|masthead|newsletter|subscribe|popup|modal|widgets?|pagination|pager"
    r"|copyright|toolbar|contentinfo|complementary)$")
#: Words that do so alone, or with words that name a container.
_WEAK_MARKS = set("notice notices alert repl reply replies respond share sharing social related signup login search form".split())
_CONTAINERS = re.compile(r"^(?:\d*|area|articles?|bar|block|body|bottom|box|buttons?|col|container|content|group|icons?|inner|items?|left|links?|list"
                         r"|media|news|outer|panel|posts?|right|row|section|stories|story|top|us|wrap|wrapper)$")

#: Pages of other content that a page is compared with on either side.
NEAR = 3
#: Distinct pages whose lines a task shares among copies.
POOL_PAGES = 256
#: Characters of its own that tell a page from a near copy.
LEAST_OWN = 60


@dataclass
class Line:
    """A block of a page: its text, whether a furniture element holds it, and
    whether it stands in the page's article."""

    text: str
    furniture: bool
    article: bool


def _marked(attributes: str) -> bool:
    if "=" not in attributes:
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        for name in (m[2] or m[3] or m[4] or "").lower().split():
            words = re.split(r"[_-]+", name)
            if any(_MARKS.match(w) for w in words):
                return True
            if any(w in _WEAK_MARKS for w in words) and all(w in _WEAK_MARKS or _CONTAINERS.match(w) for w in words):
                return True
    return False


class _Tree:
    """The elements of a page that say what their text is: marks (menus, adverts and
    the like) and articles, each with its parent among them."""

    def __init__(self):
        self.parent: list[int] = []
        self.kind: list[str] = []  # unseen, mark, article
        self.size: list[int] = []

    def add(self, parent: int, kind: str) -> int:
        self.parent.append(parent)
        self.kind.append(kind)
        self.size.append(0)
        return len(self.parent) - 1

    def judge(self, own: list[tuple[str, int]]) -> list[Line]:
        """Lines from texts and the nearest element of each.

        A mark holds for all inside it, but for one around the main article (the
        article with most text), and, should the marks leave less than a tenth of
        the text, for those that hold over half of it: these name the page's layout.
        """
        for text, node in own:
            if node >= 0:
                self.size[node] += len(text)
        total = sum(len(t) for t, _ in own)
        for k in range(len(self.parent) - 1, -1, -1):  # children come after their parents
            if self.kind[k] == "unseen":
                total -= self.size[k]
                self.size[k] = 0
            if self.parent[k] >= 0:
                self.size[self.parent[k]] += self.size[k]
        holds = [kind != "article" for kind in self.kind]
        articles = [k for k, kind in enumerate(self.kind) if kind == "article" and self.size[k]]
        if articles:
            k = max(articles, key=lambda k: (self.size[k], k))
            while (k := self.parent[k]) >= 0:
                holds[k] = holds[k] and self.kind[k] == "unseen"
        got = self._lines(own, holds)
        if 10 * sum(len(x.text) for x, k in zip(got, _body(got)) if k) < total:
            holds = [h and (kind == "unseen" or 2 * n <= total) for h, kind, n in zip(holds, self.kind, self.size)]
            got = self._lines(own, holds)
        return got

    def _lines(self, own, holds) -> list[Line]:
        furniture, article = [False] * len(holds), [False] * len(holds)
        for k, up in enumerate(self.parent):
            furniture[k] = holds[k] or (up >= 0 and furniture[up])
            article[k] = self.kind[k] == "article" or (not holds[k] and up >= 0 and article[up])
        return [Line(t, k >= 0 and furniture[k], k >= 0 and article[k]) for t, k in own]


def lines(html: str) -> list[Line]:
    """Blocks of a page in order. Unclosed and stray tags are taken as browsers
    do: an end tag closes up to its element, a block ends an open paragraph.
    Time and memory are linear in the page."""
    out: list[tuple[str, int]] = []
    tree = _Tree()
    stack: list[tuple[str, int]] = []  # element, nearest mark or article
    open_now: dict[str, int] = {}  # elements on the stack by name
    scopes: list[int] = []  # places of paragraphs and what may hold them
    pieces: list[str] = []
    node, in_article = -1, 0

    def flush() -> None:
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                out.append((text, node))

    def close(depth: int) -> None:
        """Take everything from ``depth`` up off the stack."""
        nonlocal node, in_article
        now = stack[depth - 1][1] if depth else -1
        if now != node:
            flush()
        while len(stack) > depth:
            name, _ = stack.pop()
            open_now[name] -= 1
            in_article -= name in ("article", "main")
        while scopes and scopes[-1] >= depth:
            scopes.pop()
        node = now

    def depth_of(name: str) -> int:
        if not open_now.get(name):
            return -1
        return next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name)

    at, n, last = 0, len(html), html.rfind(">")
    while at < n:
        m = _TOKEN.search(html, at) if at <= last or html.find("<!--", at) >= 0 else None
        if m is None:
            pieces.append(html[at:])
            break
        if m.start() > at:
            pieces.append(html[at:m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if name in _BLOCK:
            flush()
        elif name == "br":
            pieces.append(" ")
        if m[1] or m[4]:
            if (depth := depth_of(name)) >= 0:
                close(depth)
            continue
        if name in _VOID or (m[3] or m[6] or "").endswith("/"):
            continue
        if name in _RAW:
            end = _RAW_END[name].search(html, at)
            at = end.end() if end else n
            continue
        if name in _BLOCK and (depth := depth_of("head")) >= 0:
            close(depth)  # text that is to be seen ends the head
        if name in _CLOSED_BY_BLOCK and scopes and stack[scopes[-1]][0] == "p":
            close(scopes[-1])
        if name in _UNSEEN:
            mine = tree.add(node, "unseen")
        elif name not in ("html", "body") and (_marked(m[3] or m[6] or "") or name in _FURNITURE or (name == "header" and not in_article)):
            mine = tree.add(node, "mark")
        elif name in ("article", "main"):
            mine = tree.add(node, "article")
        else:
            mine = node
        if mine != node:
            flush()
        if name in _SCOPES:
            scopes.append(len(stack))
        stack.append((name, mine))
        open_now[name] = open_now.get(name, 0) + 1
        in_article += name in ("article", "main")
        node = mine
    flush()
    return tree.judge(out)


def shared(a: list[str], b: list[str]) -> list[bool]:
    """For each line of ``a``, whether a longest common subsequence with ``b`` has it.

    Bit-parallel: one big integer per line of ``a`` holds the row of the
    dynamic program, so long pages need little time and memory.
    """
    keep = [False] * len(a)
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        keep[head] = True
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        keep[len(a) - 1 - tail] = True
        tail += 1
    common = set(a[head:len(a) - tail]) & set(b[head:len(b) - tail])
    left = [i for i in range(head, len(a) - tail) if a[i] in common]
    right = [x for x in b[head:len(b) - tail] if x in common]
    if not left:
        return keep
    at: dict[str, int] = {}
    for j, x in enumerate(right):
        at[x] = at.get(x, 0) | 1 << j
    full = (1 << len(right)) - 1
    row, rows = full, []
    for i in left:
        hit = row & at[a[i]]
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    # a zero bit j of row i says that column j adds one to the length there
    j = len(right) - 1
    for k in range(len(left) - 1, -1, -1):
        before = rows[k - 1] if k else full
        low = (1 << (j + 1)) - 1
        if (~rows[k] & low).bit_count() == (~before & low).bit_count():
            continue  # the same length without this line
        hit = at[a[left[k]]] & low
        # the last place where this line matches and adds to the length
        while hit:
            top = hit.bit_length() - 1
            below = (1 << top) - 1
            if (~before & below).bit_count() + 1 == (~rows[k] & low).bit_count():
                keep[left[k]] = True
                j = top - 1
                break
            hit &= below
        if j < 0:
            break
    return keep


def _body(page: list[Line]) -> list[bool]:
    """The lines that can be main text: the article of a page that marks one, else
    all that is not furniture."""
    marked = any(x.article and not x.furniture for x in page)
    return [not x.furniture and (x.article or not marked) for x in page]


def main_text(page: list[Line], neighbours: list[list[Line]]) -> str:
    """Text of a page after differencing.

    Lines shared with neighbours are deleted, by longest common subsequence. One
    neighbour is enough for a line outside an article if it shares at most 60 %
    of the body; a line that the page marks as article, or that only neighbours
    with more in common share, goes if two neighbours and over half of them have
    it, so that a passage or a licence in two pages stays. A neighbour that
    differs by less than ``LEAST_OWN`` characters on both sides is a near copy
    and has no say. What differencing leaves of furniture (adverts differ from
    page to page), or outside the article of a page that marks one, is removed
    after it.
    """
    texts, body = [x.text for x in page], _body(page)
    size = sum(len(t) for t, k in zip(texts, body) if k)
    votes, alone, used = [0] * len(page), [False] * len(page), 0
    for other in neighbours if size else []:
        same = shared(texts, [x.text for x in other])
        common = sum(len(t) for t, s, k in zip(texts, same, body) if s and k)
        theirs = sum(len(x.text) for x, k in zip(other, _body(other)) if k)
        close = 10 * common > 6 * size
        if close and size - common < LEAST_OWN and theirs - common < LEAST_OWN:
            continue
        used += 1
        votes = [v + s for v, s in zip(votes, same)]
        if not close:
            alone = [a or s for a, s in zip(alone, same)]
    gone = [(a and not x.article) or (v > 1 and 2 * v > used) for x, a, v in zip(page, alone, votes)]
    return "\n\n".join(t for t, k, g in zip(texts, body, gone) if k and not g)


def content(page: list[Line]) -> int:
    """Hash of the body, short lines without digits: equal for copies of an article,
    whatever their menus, adverts, dates and counters."""
    body = "\n".join(_DIGITS.sub("", x.text) if len(x.text) < LEAST_OWN else x.text for x, k in zip(page, _body(page)) if k)
    return int.from_bytes(hashlib.blake2b(body.encode(), digest_size=8).digest(), "little", signed=True)


def nearest(kinds: list[int], near: int) -> list[list[int]]:
    """For each place the ``near`` places after it that are the first of another
    content than its own and each other's."""
    out: list[list[int]] = []
    ahead: dict[int, int] = {}  # content: next place, the nearest last
    for i in range(len(kinds) - 1, -1, -1):
        out.append([p for k, p in reversed(ahead.items()) if k != kinds[i]][:near])
        ahead.pop(kinds[i], None)
        ahead[kinds[i]] = i
        if len(ahead) > near + 1:
            del ahead[next(iter(ahead))]
    return out[::-1]


class Differencer:
    """Takes the pages of a host in order and gives each back with its text once
    ``near`` pages of other content are known after it, or the host is done."""

    def __init__(self, near: int = NEAR):
        self.near = near
        self.before: dict[int, list[Line]] = {}  # content: its last page, the latest last
        self.held: list[tuple] = []  # pages waiting: number, content, lines, doc
        self.last: dict[int, int] = {}  # content: last number, the latest last
        self.number = 0

    def add(self, page: list[Line], doc, kind: int) -> list[tuple]:
        """``doc`` None: a page that is only a neighbour. Returns (doc, text)."""
        self.held.append((self.number, kind, page, doc))
        self.last.pop(kind, None)
        self.last[kind] = self.number
        self.number += 1
        if len(self.last) > self.near + 1:
            del self.last[next(iter(self.last))]
        if len(self.held) < 64 or len(self.last) <= self.near:
            return []
        # at least half of what waits, so that all the looking ahead is linear
        until = next(iter(self.last.values()))
        return self._settle(until) if 2 * (until - self.held[0][0]) >= len(self.held) else []

    def end(self) -> list[tuple]:
        return self._settle(self.number)

    def _settle(self, until: int) -> list[tuple]:
        done = min(len(self.held), until - self.held[0][0]) if self.held else 0
        if done <= 0:
            return []
        out, after = [], nearest([h[1] for h in self.held], self.near)
        made: tuple = ((), "")
        for (_, kind, page, doc), places in zip(self.held[:done], after):
            if doc is not None:
                ahead = [self.held[p][2] for p in places]
                behind = [x for k, x in reversed(self.before.items()) if k != kind][:self.near]
                key = tuple(map(id, (page, *behind, *ahead)))
                if made[0] != key:  # copies in a row are one page object with one text
                    made = key, main_text(page, behind + ahead)
                out.append((doc, made[1]))
            self.before.pop(kind, None)
            self.before[kind] = page
            if len(self.before) > self.near + 1:
                del self.before[next(iter(self.before))]
        del self.held[:done]
        return out


def _order(host: str, path: str, tie: str | None) -> tuple:
    return host, path, tie is not None, tie or ""


def _bounds(keys: DataFrame, parts: int) -> list[tuple]:
    """First keys of the ranges but the first, from about 64 pages a range, picked by
    a hash of the key; a repeated key counts as often as it occurs."""
    limit = int(64 * parts / max(keys.count(), 64 * parts) * (1 << 30))
    picked = (keys.where(F.pmod(F.xxhash64(*keys.columns), F.lit(1 << 30)) < limit)
              .groupBy(*keys.columns).agg(F.count("*").alias("n")).collect())
    found = sorted((_order(r["host"], r["path"], r["tie"]), r["n"]) for r in picked)
    total, done, out = sum(n for _, n in found), 0, []
    for key, n in found:
        if done * parts >= (len(out) + 1) * total and len(out) < parts - 1:
            out.append(key)
        done += n
    return out


def _edges(keyed: DataFrame, bounds: list[tuple], near: int) -> dict[tuple, list[int]]:
    """(host, path, tie, content) of the pages that ranges need of others, with those
    ranges: on either side of a bound the nearest ``near + 1`` contents of its host."""
    each = (keyed.groupBy("range", "host", "content")
            .agg(F.min(F.struct("path", "tie")).alias("first"), F.max(F.struct("path", "tie")).alias("last")))
    found: dict[tuple, list] = {}
    for end, order in (("first", F.asc), ("last", F.desc)):
        rank = F.row_number().over(Window.partitionBy("range", "host").orderBy(order(end), order("content")))
        for r in each.select("range", "host", "content", f"{end}.*", rank.alias("rank")).where(F.col("rank") <= near + 1).orderBy("rank").collect():
            found.setdefault((end, r["range"], r["host"]), []).append((r["content"], r["path"], r["tie"]))
    needed: dict[tuple, list[int]] = {}
    for k, (host, *_) in enumerate(bounds):
        for end, at, step, target in (("last", k, -1, k + 1), ("first", k + 1, 1, k)):
            if (end, target, host) not in found:
                continue
            seen: set[int] = set()
            while len(seen) <= near and (end, at, host) in found:
                for kind, path, tie in found[end, at, host]:
                    if kind not in seen and len(seen) <= near:
                        seen.add(kind)
                        needed.setdefault((host, path, tie, kind), []).append(target)
                at += step
    return needed


def extract(pages: DataFrame, url: str = "url", html: str = "html", page_id: str = "page_id",
            payload: list[str] | None = None) -> DataFrame:
    """Main text of every page: ``doc`` (struct of the payload columns, all by
    default) and ``text``.

    Pages are range-sorted by host, URL path and id; each is compared with the
    ``NEAR`` pages before and after it that are of the same host and of other
    content than its own and each other's, however many copies lie between. A
    hot host is split over many ranges; a range gets from the others the pages
    that its first and last need, so the text does not depend on the ranges.
    Copies wait in a task for the pages after them, equal pages and lines as one, so
    a copy costs its payload and a few bytes a line. A null or empty html gives
    an empty text; a null url is a host of its own; repeated rows each give a row.
    """
    place = F.coalesce(F.col(url).cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(place, r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(place, r"^(?:[a-zA-Z][\w+.-]*://[^/?#]*)?([^?#]*)", 1)
    rows = pages.select(host.alias("host"), path.alias("path"), F.col(page_id).cast("string").alias("tie"),
                        F.struct(*[F.col(f"`{c}`") for c in payload or pages.columns]).alias("doc"),
                        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    parts = partitions(pages.sparkSession)
    bounds = _bounds(rows.select("host", "path", "tie"), parts)
    named = StructType([StructField("range", IntegerType()), StructField("host", StringType()), StructField("path", StringType()),
                        StructField("tie", StringType()), StructField("content", LongType())])
    whole = StructType([*named, StructField("page", StringType()), StructField("doc", rows.schema["doc"].dataType)])

    def parse(needed: dict[tuple, list[int]] | None):
        """Pages with their range and lines, and those ``needed`` by other ranges again,
        without doc; None: only the names."""
        def run(batches):
            for batch in batches:
                cells, source = [], []
                for i, (h, p, t, x) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("host", "path", "tie", "html")])):
                    found = lines(x)
                    kind = content(found)
                    packed = "" if needed is None else "\n".join(f"{2 * y.furniture + y.article}{y.text}" for y in found)
                    own = bisect.bisect_right(bounds, _order(h, p, t))
                    for target in (own, *(needed or {}).get((h, p, t, kind), ())):
                        cells.append((target, h, p, t, kind, packed))
                        source.append(i if target == own else None)
                if not cells:
                    continue
                out = [pa.array(c, k) for c, k in zip(zip(*cells), (pa.int32(), *[pa.string()] * 3, pa.int64(), pa.string()))]
                if needed is None:
                    yield pa.RecordBatch.from_arrays(out[:5], named.names)
                else:
                    yield pa.RecordBatch.from_arrays([*out, batch.column("doc").take(pa.array(source, pa.int64()))], whole.names)

        return run

    split = rows.where(F.col("host").isin(sorted({b[0] for b in bounds}))).select("host", "path", "tie", "html")
    needed = _edges(split.mapInArrow(parse(None), named), bounds, NEAR) if bounds else {}
    dealt = (rows.mapInArrow(parse(needed), whole).repartitionById(parts, F.col("range"))
             .sortWithinPartitions("host", "path", "tie", "content").select("host", "content", "page", "doc"))
    schema = rows.select("doc", F.lit("").alias("text")).schema

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        kind = to_arrow_type(schema["doc"].dataType)
        now, differ, out = None, Differencer(), []
        page_of: dict[str, list[Line]] = {}  # pages and lines met lately, held once
        line_of: dict[str, Line] = {}

        def give():
            got = pa.RecordBatch.from_arrays([pa.array([d for d, _ in out], kind), pa.array([t for _, t in out], pa.string())], schema.names)
            out.clear()
            return got

        for batch in batches:
            kind = batch.schema.field("doc").type
            for h, k, x, d in zip(*[batch.column(c).to_pylist() for c in ("host", "content", "page", "doc")]):
                if h != now:
                    out += differ.end()
                    now, differ = h, Differencer()
                if x not in page_of:
                    if len(page_of) >= POOL_PAGES:
                        page_of.clear()
                        line_of.clear()
                    page_of[x] = [line_of.setdefault(y, Line(y[1:], y[0] in "23", y[0] in "13")) for y in x.split("\n")] if x else []
                out += differ.add(page_of[x], d, k)
                if len(out) >= 1000:
                    yield give()
        out += differ.end()
        if out:
            yield give()

    return dealt.mapInArrow(run, schema)
