"""Main text of web pages, without what recurs on many pages of a site."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Set

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitline.llm.batches import slices
from waitline.llm.staging import stage

#: A subtree is a template if that many different texts of a host have it, and this share of them.
LEAST_TEXTS = 10
LEAST_SHARE = 0.1

#: Fixed values of HTML: elements without end tag, those with raw text, and those that are blocks.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCKS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend "
    "li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot "
    "th thead title tr ul".split()
)
#: Start tags that end another element of the same list, up to the element that holds the list.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
#: What is no main text: elements, roles, and words in class or id.
ASIDE = RAW | set(
    "nav footer aside form menu dialog head button select input canvas svg object applet video "
    "audio map datalist".split()
)
ROLES = set(
    "navigation banner contentinfo complementary search form dialog alert menu menubar".split()
)
MARKS = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion "
    "banner nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar rail cookie "
    "cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social comment comments reply replies disqus related recommended "
    "toolbar pagination pager hidden".split()
)
_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*>?"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.DOTALL
)
_MARK = re.compile(r"[a-z0-9]+")


class _Open:
    """An element that is not closed yet."""

    __slots__ = ("name", "aside", "level", "above", "parts", "ruled", "marked", "before")

    def __init__(self, name: str, aside: bool, level: int, above: tuple[int, ...]):
        self.name, self.aside, self.level, self.above = name, aside, level, above
        self.parts: list[str] = [name]
        #: Aside by tag, role or style; the marked elements around; characters of text before it.
        self.ruled, self.marked, self.before = False, (), 0


def _attributes(given: str) -> dict[str, str]:
    found = _ATTRIBUTE.findall(given)
    return {key.lower(): html.unescape(a or b or c) for key, a, b, c in found}


def _is_aside(name: str, given: dict[str, str], inside: bool) -> bool:
    if name in ASIDE or (name == "header" and not inside):
        return True
    if not given or name in ("html", "body"):
        return False
    hidden = "hidden" in given or given.get("aria-hidden") == "true"
    styled = "display:none" in given.get("style", "").replace(" ", "").lower()
    return hidden or styled or given.get("role", "").lower() in ROLES


def _is_marked(name: str, given: dict[str, str], inside: bool) -> bool:
    if not given or name in ("html", "body"):
        return False
    words = _MARK.findall(f"{given.get('class', '')} {given.get('id', '')}".lower())
    return any(word in MARKS or (word == "header" and not inside) for word in words)


def _wrappers(
    mains: list[tuple[int, tuple[int, ...]]], sizes: dict[int, int], total: int
) -> set[int]:
    """Marked elements that are not aside: what is around the main part or most of the text.

    The main part is the main elements, else the articles, with the fewest marks around, so that
    a box of comments that are articles stays aside where the page has another article.
    """
    best = max((level for level, _ in mains), default=0)
    around = [marked for level, marked in mains if level == best]
    fewest = min(map(len, around), default=0)
    found = {n for marked in around if len(marked) == fewest for n in marked}
    return found | {n for n, size in sizes.items() if 2 * size > total}


def page_blocks(page: str) -> list[tuple[str, list[int]]]:
    """Texts of the blocks of a page's main part in order, with hashes of the subtrees around.

    The main part is the articles that are not aside, else the main element, else the page. White
    space is one space, character references are decoded. A subtree's hash covers its name, texts
    and elements. Unclosed and stray tags are borne with; no recursion. One pass, and another
    if an element with a mark in class or id turns out to be a wrapper (see ``_wrappers``).
    """
    blocks, wrappers = _blocks(page, frozenset())
    return _blocks(page, wrappers)[0] if wrappers else blocks


def _blocks(page: str, wrappers: Set[int]) -> tuple[list[tuple[str, list[int]]], set[int]]:
    """The blocks, with the marked elements that begin at ``wrappers`` not aside, and all wrappers."""
    stack = [_Open("", False, 0, ())]
    hashes: list[int] = []
    found: list[tuple[list[str], tuple[int, ...], int]] = []
    fresh = True
    total = 0
    sizes: dict[int, int] = {}
    mains: list[tuple[int, tuple[int, ...]]] = []

    def pop() -> None:
        closed = stack.pop()
        if closed.marked != stack[-1].marked:
            sizes[closed.marked[-1]] = total - closed.before
        value = xxhash.xxh3_64_intdigest("\x1f".join(closed.parts))
        if closed.above and closed.name in BLOCKS and not closed.aside:
            hashes[closed.above[-1]] = value - (1 << 63)
        stack[-1].parts.append(str(value))

    def close_to(names: set[str], until: set[str]) -> bool:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in names:
                while len(stack) > depth:
                    pop()
                return True
            if stack[depth].name in until:
                return False
        return False

    def add(text: str) -> None:
        nonlocal fresh, total
        top = stack[-1]
        text = html.unescape(text)
        top.parts.append(" ".join(text.split()))
        if not top.ruled:
            total += len(top.parts[-1])
        if top.aside:
            return
        if fresh:
            found.append(([], top.above, top.level))
            fresh = False
        found[-1][0].append(text)

    at = 0
    while match := _TAG.search(page, at):
        if match.start() > at:
            add(page[at : match.start()])
        at = match.end()
        name = (match[2] or "").lower()
        if not name:
            continue
        block = name in BLOCKS
        fresh |= block
        if match[1]:
            close_to({name}, set() if block else BLOCKS - {"p"})
            continue
        if block and name != "br":
            close_to({"p"}, BLOCKS - {"p"})
        if name in SIBLINGS:
            close_to(*SIBLINGS[name])
        top = stack[-1]
        given = _attributes(match[3]) if match[3].strip(" /\n") else {}
        ruled = top.ruled or _is_aside(name, given, top.level > 0)
        mark = _is_marked(name, given, top.level > 0)
        marked = (*top.marked, match.start()) if mark else top.marked
        aside = top.aside or ruled or (mark and match.start() not in wrappers)
        if not ruled and (name in ("main", "article") or given.get("role") in ("main", "article")):
            mains.append((2 if "main" in (name, given.get("role")) else 1, marked))
        level = top.level
        if not aside and (name == "article" or given.get("role") == "article"):
            level = 2
        elif not aside and (name == "main" or given.get("role") == "main"):
            level = max(level, 1)
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>?", re.IGNORECASE)
            ended = end.search(page, at)
            at = ended.end() if ended else len(page)
            top.parts.append(name)
        elif name in VOID or match[3].endswith("/"):
            top.parts.append(name)
        else:
            above = top.above
            if block and not aside:
                above = (*above, len(hashes))
                hashes.append(0)
            stack.append(_Open(name, aside, level, above))
            stack[-1].ruled, stack[-1].marked, stack[-1].before = ruled, marked, total
    if at < len(page):
        add(page[at:])
    while len(stack) > 1:
        pop()
    best = max((level for _, _, level in found), default=0)
    blocks = [(" ".join("".join(parts).split()), above, level) for parts, above, level in found]
    kept = [
        (text, [hashes[n] for n in above]) for text, above, level in blocks if text and level == best
    ]
    return kept, _wrappers(mains, sizes, total)


def _longest(page: list[tuple[str, list[int]]]) -> int:
    text = min((text for text, _ in page), key=lambda text: (-len(text), text), default="")
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _parsed(pages: DataFrame, keep: list[str]) -> DataFrame:
    """``doc`` (a struct of ``keep``), ``host``, ``longest``, ``blocks``.

    ``longest`` is a hash of the page's longest block, the first by its text of equally long ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("text", pa.string()), ("marks", pa.list_(pa.int64()))]))
        for batch in slices(batches, "html"):
            pages = [page_blocks(page or "") for page in batch.column("html").to_pylist()]
            longest = [_longest(page) for page in pages]
            rows = [[{"text": t, "marks": m} for t, m in page] for page in pages]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    batch.column("host"),
                    pa.array(longest, pa.int64()),
                    pa.array(rows, kind),
                ],
                ["doc", "host", "longest", "blocks"],
            )

    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:/?#]*:?//([^/?#]*)", 1))
    rows = pages.select(F.struct(*keep).alias("doc"), host.alias("host"), "html")
    kind = rows.schema["doc"].dataType.simpleString()
    blocks = "array<struct<text: string, marks: array<long>>>"
    return rows.mapInArrow(run, f"doc {kind}, host string, longest long, blocks {blocks}")


def _marks() -> Column:
    return F.array_distinct(F.flatten(F.transform("blocks", lambda b: b["marks"])))


def templates(parsed: DataFrame) -> DataFrame:
    """``host, gone``: the subtrees that recur over so many different texts of a host.

    Texts count as different if their longest blocks are. So pages that are copies of each other
    but for a date, a caption or a shorter paragraph are one text, and make no template of what
    they share. What surrounds all of a page's text is no template. A host has at most ten times
    as many templates as its pages have subtrees on average.
    """
    whole = F.aggregate(
        F.transform("blocks", lambda b: b["marks"]),
        F.get("blocks", F.lit(0))["marks"],
        lambda common, one: F.array_intersect(common, one),
    )
    page = F.array(F.lit(None).cast("long"))
    counts = stage(
        parsed.filter(F.size("blocks") > 0)
        .select(
            "host", "longest", F.explode(F.concat(F.array_except(_marks(), whole), page)).alias("mark")
        )
        .groupBy("host", "mark")
        .agg(F.count_distinct("longest").alias("times"))
        .filter(F.col("mark").isNull() | (F.col("times") >= LEAST_TEXTS))
    )
    texts = counts.filter("mark IS NULL").select("host", F.col("times").alias("texts"))
    often = counts.filter("mark IS NOT NULL").join(texts, "host")
    return (
        often.filter(F.col("times") >= F.col("texts") * LEAST_SHARE)
        .groupBy("host")
        .agg(F.collect_list("mark").alias("gone"))
    )


def extracted(pages: DataFrame, keep: list[str]) -> DataFrame:
    """``doc`` (a struct of ``keep``) and ``text``, the main text of each page.

    Null or empty html gives an empty text. Hosts are taken from the url; pages without one are
    one host. Every row is a page of its own, equal ones too.

    Pages are parsed once to count subtrees by host, which combines before the shuffle, and once
    to be cut. The templates of a host are a short list; Spark broadcasts the lists if they are
    small, else joins by host and splits a host with many pages.
    """
    parsed = _parsed(pages, keep)
    gone = stage(templates(parsed)).withColumnRenamed("host", "of")
    kept = F.filter(
        "blocks",
        lambda b: ~F.coalesce(F.arrays_overlap(b["marks"], F.col("gone")), F.lit(False)),
    )
    text = F.array_join(F.transform(kept, lambda b: b["text"]), " ")
    return parsed.join(gone, F.col("host") == F.col("of"), "left").select("doc", text.alias("text"))
