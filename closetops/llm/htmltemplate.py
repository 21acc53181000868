"""Main text of web pages by deducing the templates of each host.

Pages of a host with the same outer elements share a template; a page that is alone with its own
takes what all pages of the host give.  Pages with equal html count once.

A page is read as a sequence of tokens: start tags named by their path from the
root (with class, id and role), and literal texts named by path and hash (numbers between words count alike, but in headings).  Two
tokens of a host belong to one equivalence class if they occur equally often
on each of its pages, that is, share their occurrence vector.  The vectors are
never gathered: a sum over the pages of a hash of (page, count) stands for
each, so the classes of a host of any size come from grouped sums.

Classes that are large and frequent are candidates.  A token stays in its class if it has the same rank
among the class's tokens on each page, by its first and by its last place, and if the class lies in the same gap of the
same class around it on each page; tokens out of order, and classes that interleave, leave the template.
The slots are what the template's tags hold.  The one with the article is
chosen per group of pages (an article or main element, else the deepest that holds nearly all text).  Of the slots
below it, and outside article and main elements, those whose texts rotate among few values go, as do literal texts of the
template and the parts that are marked as something else; what the pages have in the other ones is their main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..operators import stage
from .common import BROADCAST_ROWS

#: A class is part of the template if it has at least this many tokens and occurs on this part of the host's pages.
CLASS_TOKENS, SUPPORT = 2, 0.5
#: Part of a group's text that a slot holds if nothing names it; part of the pages that have a literal text of the
#: template; least number of different pages of a group.
FULL, SAME_PAGES = 0.9, 2
#: A slot's texts rotate if it has at least this many, each on average this often.
ROTATING, TURNS = 6, 2
#: Elements nested deeper than this, or below a longer path, take the path of the one around them.
DEPTH, PATH = 100, 4000
#: Start tags and paths that a worker keeps the reading of, and the longest tag it keeps.
KNOWN, SHORT = 8192, 500
#: A slot inside an element with a marked class must hold more text than this many times what is in no such element.
MARKED_SLOT = 2
#: Elements whose paths, to this depth and outside articles, tell the groups of pages.
OUTER, OUTER_DEPTH = {"div", "section", "article", "main", "header", "footer", "nav", "aside", "table", "form"}, 4

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?[A-Za-z][^<>]*(?:>|(?=<)|\Z)", re.S)
TAG, STOP = re.compile(r"</?[A-Za-z]"), re.compile(r"[>\"']")
INSIDE, HEADING, DIGITS = re.compile(r"/(?:(?:article|main)\b|[^/]*role=(?:main|article))"), re.compile(r"h[1-6]$"), re.compile("[0-9]+")
#: Numbers that stand alone, and a letter: texts that differ in such numbers only are one literal.
HIDDEN, ARTICLE = re.compile(r"\s(?:hidden|aria-hidden\s*=\s*.?true)(?:[\s=/>]|$)"), re.compile(r"(?:article|main)\b")
NUMBER, LETTER = re.compile(r"\b[0-9]+\b"), re.compile(r"[^\W\d_]")
NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""(?<![A-Za-z-])([A-Za-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
MARKS = {"class", "id", "role"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
#: Elements whose content is not the article, wherever they stand.
OTHER = RAW | {"head", "title", "nav", "footer", "aside", "form", "button", "select", "option", "svg", "menu", "dialog",
               "object", "canvas", "audio", "video", "map", "datalist"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
          "sub", "sup", "time", "tt", "u", "var", "wbr", "br", "img"}
#: Words of class, id or role that mark such content on other elements.
MARKED = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|banners?|sponsors?|sponsored|promos?|"
                    r"cookies?|consent|notices?|alerts?|popups?|modals?|newsletters?|subscribe|nav|navbar|navigation|"
                    r"menus?|breadcrumbs?|footer|sidebars?|complementary|contentinfo|search|related|"
                    r"recommended|comments?|disqus|replies|respond|share|sharing|social|widgets?|login|pagination|pager|"
                    r"hidden|toolbar)(?:$|[\s_-])", re.I)
#: The same for a page's header; an article's header holds its title.
HEADER = re.compile(r"(?:^|[\s_-])(?:header|masthead)(?:$|[\s_-])", re.I)
#: A start tag on the left ends these open elements.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
#: Elements that an implied end does not reach through.
BARRIER = {"html", "body", "article", "main", "section", "div", "table", "ul", "ol", "dl", "blockquote", "td", "th", "nav",
           "aside", "footer", "header", "form", "figure"}


class Node:
    """An open element: its tag, path of names with marks, whether its tag or that of one around it says that its content
    is something other than the article, the path of the innermost one whose class, id or role does ("" if none), how
    many are around it, and whether it or one of them is an article or main element."""

    __slots__ = ("tag", "path", "other", "mark", "depth", "inside")

    def __init__(self, tag: str, path: str, other: bool, mark: str, depth: int = 0, inside: bool = False):
        self.tag, self.path, self.other, self.mark, self.depth, self.inside = tag, path, other, mark, depth, inside


def _tag_ends(page: str):
    """Function from a place inside a tag to its end, quoted values skipped, or None if it has none.

    Places are asked for from left to right.  Quotes from which a tag did not end are noted and the
    next mark is kept, so a page is gone through once, however its quotes pair.
    """
    lost: set[int] = set()
    kept = [0, -1]  # from the first to the second of these places there is no mark before the second

    def mark(at: int) -> int:
        if not kept[0] <= at <= kept[1]:
            m = STOP.search(page, at)
            kept[:] = at, m.start() if m else len(page)
        return kept[1]

    def end(at: int) -> int | None:
        seen, stop = [], mark(at)
        while stop < len(page) and stop not in lost:
            if page[stop] == ">":
                return stop + 1
            seen.append(stop)
            partner = page.find(page[stop], stop + 1)
            if partner < 0:
                break
            m = STOP.search(page, partner + 1)
            stop = m.start() if m else len(page)
        lost.update(seen)
        return None
    return end


def _marks(tag: str, source: str) -> tuple[str, bool, bool, bool]:
    """Of a start tag: its name with marks, whether they say that it is something else, whether they say header, whether it is hidden."""
    marks = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(source) if k.lower() in MARKS}
    name = ".".join([tag, *sorted(f"{k}={v}".replace("/", "|").replace("#", "|") for k, v in marks.items())])
    return name, any(map(MARKED.search, marks.values())), any(map(HEADER.search, marks.values())), HIDDEN.search(source) is not None


class Kept(dict):
    """What a function gives for the arguments asked for last, at most KNOWN of them (pages of a host repeat their tags
    and paths).  Unlike functools' caches it travels with the job."""

    def __init__(self, f):
        self.f = f

    def __missing__(self, key: tuple):
        if len(self) >= KNOWN:
            self.clear()
        self[key] = value = self.f(*key)
        return value


_known = Kept(_marks)


def _node(parent: Node, tag: str, source: str) -> Node:
    name, said, header, hidden = _known[tag, source] if len(source) <= SHORT else _marks(tag, source)
    outside = not parent.inside
    said = said or outside and header
    deep = parent.depth >= DEPTH or len(parent.path) + len(name) >= PATH
    path = parent.path if deep else f"{parent.path}/{name}"
    body = tag in ("html", "body", "article", "main")  # a marked body is still the page
    return Node(tag, path, parent.other or tag in OTHER or ((tag == "header" and outside or hidden) and not body),
                path if said and not body else parent.mark, parent.depth + 1, parent.inside or ARTICLE.match(tag) is not None)


def read(page: str) -> list[tuple[str, str | None, str]]:
    """What a page holds, in its order: start tags (path, None, "") and blocks (path, text with references decoded, mark),
    without the blocks that are something other than the article by their tags."""
    found: list[tuple[str, str | None, str]] = []
    open_ = [Node("", "", False, "")]
    n_open: Counter = Counter()
    text: list[str] = []
    block_of = [open_[0]]

    def flush():
        if text:
            said = " ".join("".join(text).split())
            if said and not block_of[0].other:
                found.append((block_of[0].path, said, block_of[0].mark))
            text.clear()

    def say(raw: str):
        if raw:
            top = open_[-1]
            if text and (top.other, top.mark) != (block_of[0].other, block_of[0].mark):  # a marked inline element is a block of its own
                flush()
            if not text:
                block_of[0] = top
            text.append(html.unescape(raw) if "&" in raw else raw)

    def close(tags_, barrier):
        if not any(n_open[t] for t in tags_):
            return
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].tag in tags_:
                flush()
                for x in open_[i:]:
                    n_open[x.tag] -= 1
                del open_[i:]
                return
            if open_[i].tag in barrier:
                return

    at, end, tag_end = 0, len(page), _tag_ends(page)
    while at < end:
        m = TOKEN.search(page, at)
        say(page[at:m.start() if m else end])
        if not m:
            break
        at = m.end()
        if TAG.match(m[0]):
            if "'" in m[0] or m[0][-1] != ">" or m[0].count('"') % 2:  # else its quotes pair before its end
                at = tag_end(m.start() + 2) or at
        source = page[m.start():at]
        if source[1] in "!?":
            if source.startswith("<![CDATA["):
                say(source[9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        tag = NAME.match(source)[1].lower()
        if source[1] == "/":
            if n_open[tag]:
                if tag not in INLINE:
                    flush()
                close({tag}, () if tag not in INLINE else BARRIER)
            continue
        if tag == "br":
            say(" ")
            continue
        if tag not in INLINE:
            flush()
            if tag in CLOSES:
                close(CLOSES[tag], {"ul", "ol", "dl", "table", "select", "article", "body"})
            if n_open["p"]:
                close({"p"}, BARRIER)
        node = _node(open_[-1], tag, source)
        if tag not in INLINE:
            found.append((node.path, None, ""))
        if tag in VOID or source.endswith("/>") and tag in {"path", "use", "circle", "rect"}:
            continue
        if tag in RAW:
            m = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = m.end() if m else end
            continue
        open_.append(node)
        n_open[tag] += 1
    flush()
    return found


def _last(path: str) -> str:
    """The tag of a path's last element."""
    return re.split(r"[.#]", path.rpartition("/")[2])[0]


def _inside(path: str) -> bool:
    return INSIDE.search(path + "/") is not None


_is_inside = Kept(_inside)


def _literal(path: str, text: str) -> str:
    alike = not HEADING.match(_last(path)) and LETTER.search(text)
    return f"{path}#{xxhash.xxh64_hexdigest(NUMBER.sub('0', text) if alike else text)}"


def _outer(path: str) -> str:
    """The path with digits alike if it is an outer element's, else ""."""
    outer = path.count("/") <= OUTER_DEPTH and _last(path) in OUTER and not INSIDE.search(path.rpartition("/")[0] + "/")
    return DIGITS.sub("0", path) if outer else ""


_outers = Kept(_outer)


def _structure(found: list) -> int:
    """A hash of the set of paths of a page's outer elements; digits count alike."""
    outer = {_outers[p,] for p in {p for p, said, _ in found if said is None}} - {""}
    return xxhash.xxh64_intdigest("\n".join(sorted(outer))) - 2**63


def _tokens(found: list) -> list[dict]:
    """The tokens of a page: occurrences n, chars below or in it that no element below it marks, free: those in no
    marked element, first and last place.  Texts inside articles are never the template's and are no tokens."""
    tokens: dict[str, list[int]] = {}
    below: Counter = Counter()
    free: Counter = Counter()
    for at, (path, said, mark) in enumerate(found):
        own = said is None or not _is_inside[path,]
        token = path if said is None else _literal(path, said) if own else ""
        if own:
            seen = tokens.setdefault(token, [0, at, at])
            seen[0], seen[2] = seen[0] + 1, at
        if said is not None:
            free[""] += 0 if mark else len(said)
            below[token] += len(said)
            while path and len(path) >= len(mark):
                below[path] += len(said)
                path = path.rpartition("/")[0]
    return [{"token": "", "n": 1, "chars": 0, "free": free[""], "first": -1, "last": len(found)},
            *({"token": t, "n": n, "chars": below[t], "free": 0, "first": i, "last": j} for t, (n, i, j) in tokens.items())]


def placed(tokens: list) -> list[dict]:
    """Where the candidates (token, vector, first, last) of one page stand: rank in their class (-1 if not the
    same by first and by last places), and a hash of the class around theirs and its gap (null: they interleave)."""
    classes: dict = {}
    for t in tokens:
        classes.setdefault(t["vector"], []).append(t)
    spans, rank = [], {}
    for v, members in classes.items():
        members.sort(key=lambda t: t["first"])
        last = sorted(members, key=lambda t: t["last"])
        rank |= {t["token"]: i if t["token"] == last[i]["token"] else -1 for i, t in enumerate(members)}
        spans.append((members[0]["first"], -last[-1]["last"], v))
    spans.sort(key=lambda x: x[:2])
    around, open_ = {}, []
    for lo, hi, v in spans:
        while open_ and -open_[-1][1] < lo:
            open_.pop()
        if not open_:
            around[v] = 0
        elif -open_[-1][1] < -hi:
            around[v] = None
            continue
        else:
            parent = open_[-1][2]
            gap = sum(t["first"] < lo for t in classes[parent])
            around[v] = xxhash.xxh64_intdigest(f"{parent} {gap}") - 2**63
        open_.append((lo, hi, v))
    return [{"token": t, "rank": r, "around": around[v]} for v, members in classes.items()
            for t, r in ((x["token"], rank[x["token"]]) for x in members)]


def host(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"//([^/:?#]+)", 1)), F.lit(""))


def _template(seen: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(*by, pages, free_all) of the groups of at least SAME_PAGES pages, their tokens' vectors, and the template: the
    tokens of valid classes."""
    vectors = stage(seen.groupBy(*by, "token").agg(
        F.count("*").alias("support"), F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.sum("free").alias("free"),
        F.sum(F.xxhash64("page", "n").cast("decimal(20,0)")).cast("decimal(38,0)").alias("vector")))
    size = vectors.where(f"token = '' AND support >= {SAME_PAGES}").select(*by, F.col("support").alias("pages"),
                                                                          F.col("free").alias("free_all"))
    vectors = vectors.where("token <> ''").drop("free").withColumn("literal", F.col("token").contains("#"))
    of_class = [*by, "vector", "support", "n"]
    classes = (vectors.groupBy(*of_class).agg(F.count("*").alias("tokens")).join(size, by)
               .where(f"tokens >= {CLASS_TOKENS} AND support >= {SUPPORT} * pages").select(*of_class))
    candidates = stage(vectors.join(classes, of_class))

    @pandas_udf("array<struct<token:string,rank:int,around:long>>")
    def places(parts: pd.Series) -> pd.Series:
        return pd.Series([placed([dict(t) for t in tokens]) for tokens in parts])

    page = (seen.select(*by, "page", "token", "first", "last")
            .join(bounded(candidates.select(*by, "token", F.col("vector").cast("string").alias("vector"))), [*by, "token"])
            .groupBy(*by, "page").agg(F.collect_list(F.struct("token", "vector", "first", "last")).alias("tokens")))
    valid = (page.select(*by, F.explode(places("tokens")).alias("t")).select(*by, "t.*").groupBy(*by, "token")
             .agg(F.min("rank").alias("lo"), F.max("rank").alias("hi"), F.count("*").alias("k"), F.count("around").alias("ka"),
                  F.min("around").alias("a"), F.max("around").alias("b"))
             .where("lo >= 0 AND lo = hi AND k = ka AND a = b").select(*by, "token"))
    kept = candidates.join(valid, [*by, "token"])
    still = kept.groupBy(*of_class).agg(F.count("*").alias("tokens")).where(f"tokens >= {CLASS_TOKENS}").select(*of_class)
    return size, vectors, kept.join(still, of_class)


def _slots(seen: DataFrame, by: list[str]) -> DataFrame:
    """(*by, slot, same, rotating) from the tokens of each group's pages: the path of the slot with the article, literal
    texts of the template, and the paths of slots whose texts rotate."""
    size, vectors, fixed = _template(seen, by)
    fixed = stage(fixed)
    last = F.regexp_extract("token", r"/([^/.]+)[^/]*$", 1)
    named = last.isin("article", "main") | F.col("token").rlike(r"role=(main|article)[^/]*$")
    depth = F.length(F.regexp_replace("token", "[^/]", ""))

    @pandas_udf("boolean")
    def marked(paths: pd.Series) -> pd.Series:
        return paths.map(_marked)
    # a slot is a tag that each page has once: an article or main element (an article before a main, the outer of
    # nested ones), else the deepest that holds nearly all text of the group
    tags = (fixed.where("NOT literal AND n = support AND chars > 0").join(size, by)
            .withColumn("named", named).withColumn("marked", marked("token"))
            .where(f"NOT marked OR chars > {MARKED_SLOT} * free_all"))
    most = tags.groupBy(*by).agg(F.max("chars").alias("total"))
    slots = (tags.join(most, by).where(F.col("named") | (F.col("chars") >= FULL * F.col("total")))
             .withColumn("rank", F.struct("named", (last == "article").alias("article"),
                                          F.when(F.col("named"), -depth).otherwise(depth).alias("depth"), "chars", "token"))
             .groupBy(*by).agg(F.max_by("token", "rank").alias("slot")))
    same = (fixed.where("literal").join(size, by).where(f"support >= {FULL} * pages")
            .groupBy(*by).agg(F.collect_list("token").alias("same")))
    turns = (vectors.where("literal").groupBy(*by, F.substring_index("token", "#", 1).alias("path"))
             .agg(F.count("*").alias("texts"), F.sum("n").alias("n")).where(f"n >= {ROTATING} AND n >= {TURNS} * texts"))
    rotating = (turns.join(fixed.where("NOT literal").select(*by, F.col("token").alias("path")), [*by, "path"], "left_semi")
                .groupBy(*by).agg(F.collect_list("path").alias("rotating")))
    return stage(size.select(*by).join(slots, by, "left").join(same, by, "left").join(rotating, by, "left"))


def bounded(table: DataFrame, *columns) -> DataFrame:
    """The columns (none: all) of a staged table, marked for broadcast only if its counted rows and the elements of its arrays are within BROADCAST_ROWS."""
    n = F.count("*")
    for field in table.schema:
        if field.dataType.typeName() == "array":
            n = n + F.coalesce(F.sum(F.greatest(F.size(F.col(field.name)), F.lit(0))), F.lit(0))
    rows = table.select(*columns) if columns else table
    return F.broadcast(rows) if table.agg(n).first()[0] <= BROADCAST_ROWS else rows


def _parsed(pages: DataFrame, url_col: str, html_col: str, what: str, ddl: str, make):
    """pages with host and ``structure`` and ``what`` (made from what read() gives) of their html; one parse each."""
    @pandas_udf(f"structure long, {what} {ddl}")
    def parse(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in parts:
            found = [read(p or "") for p in s]
            yield pd.DataFrame({"structure": pd.Series(map(_structure, found), dtype="int64"),
                                what: pd.Series(list(map(make, found)), dtype=object)})
    return pages.withColumn("host", host(F.col(url_col))).withColumn("p", parse(F.col(html_col)))


def templates(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> tuple[DataFrame, DataFrame]:
    """(host, structure, slot, same, rotating) and, over all pages of a host, (host, slot, same, rotating); see _slots.
    The template's size bounds the lists; null if there is none."""
    ddl = "array<struct<token:string,n:long,chars:long,free:long,first:int,last:int>>"
    rows = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    tokens = (_parsed(rows, "url", "html", "tokens", ddl, _tokens)
              .select("host", F.xxhash64("html").alias("page"), "p.structure", "p.tokens"))
    seen = stage(tokens.dropDuplicates(["host", "page"]))
    seen = seen.select("host", "structure", "page", F.explode("tokens").alias("t")).select("host", "structure", "page", "t.*")
    return _slots(seen, ["host", "structure"]), _slots(seen, ["host"])


def _marked(path: str) -> bool:
    """Whether a class, id or role on the path marks its content as something else."""
    names = [n for n in path.split("/") if n.partition(".")[0] not in ("html", "body", "article", "main")]
    return any(MARKED.search(v) or HEADER.search(v) for n in names for v in re.findall(r"\.(?:class|id|role)=(.*?)(?=\.(?:class|id|role)=|$)", n))


def main_text(blocks, slot: str | None, same=(), rotating=()) -> str:
    """Those of a page's blocks (path, text, mark) in the slot that no element below it marks as something else (if all
    are, those too), joined by line feeds.  Without the slot: those in article elements, else in main elements, else all
    of the page.  Literal texts ``same`` and, outside articles, blocks of ``rotating`` paths are no content."""
    same, rotating = set(same if same is not None else ()), set(rotating if rotating is not None else ())
    mine = [(p, s, m) for p, s, m in blocks if _is_inside[p,] or not (
        rotating and p in rotating or same and _literal(p, s) in same)]

    def under(top: str, path: str) -> bool:
        return path.startswith(top) and path[len(top):][:1] in ("", "/")

    def named(pattern):
        def top(path):
            m = re.match(rf"(?:/[^/]*)*?/(?:{pattern})(?=/|$)", path)
            return m and m[0]
        return top
    for top in ((lambda p: slot if slot is not None and under(slot, p) else None),
                named(r"article(?:\.[^/]*)?"), named(r"main(?:\.[^/]*)?|[^/]*role=main[^/]*"), lambda p: ""):
        got = [(s, len(m) > len(t)) for p, s, m in mine if (t := top(p)) is not None]
        if got:
            said = [s for s, marked in got if not marked]
            if said or top("/") != "":
                return "\n".join(said or [s for s, _ in got])
    return ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, text.

    Null and empty html gives an empty text.  Pages with null urls, or urls without a host, are one host.
    Repeated rows each get their row.  Null ids
    are ids; an empty table gives no rows; further columns are ignored.
    """
    groups, hosts = templates(pages, url_col, html_col)
    told = F.struct("slot", "same", "rotating")
    groups = bounded(groups, F.col("host").alias("h"), F.col("structure").alias("g"), told.alias("mine"))
    hosts = bounded(hosts, F.col("host").alias("hh"), told.alias("whole"))

    @pandas_udf("string")
    def text(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for blocks, slot, same, rotating in parts:
            yield pd.Series([main_text([(b["path"], b["said"], b["mark"]) for b in bs], s if isinstance(s, str) else None, a, r)
                             for bs, s, a, r in zip(blocks, slot, same, rotating)], dtype=object)

    def blocks(found):
        return [{"path": p, "said": s, "mark": m} for p, s, m in found if s is not None]

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return (_parsed(rows, "url", "html", "blocks", "array<struct<path:string,said:string,mark:string>>", blocks)
            .select("id", "url", "host", "p.structure", "p.blocks")
            .join(groups, (F.col("host") == F.col("h")) & (F.col("structure") == F.col("g")), "left")
            .join(hosts, F.col("host") == F.col("hh"), "left")
            .withColumn("t", F.coalesce("mine", "whole"))
            .select("id", "url", text("blocks", "t.slot", "t.same", "t.rotating").alias("text")))


def op9(pages: DataFrame) -> DataFrame:
    return extract(pages).select(F.col("id").alias("page_id"), "url", "text",
                                 F.char_length("text").cast("long").alias("n_chars"))
