"""Main text of web pages: flat text blocks, classified by a small decision tree.

A page is cut into text blocks in page order. A block has its word count and link density, those of
the blocks before and after it, and where it stands: inside an element that is page furniture, inside
the main part, outside a main part that the page has, or on a page without one. A paragraph, heading or
cell of the main part is a place of its own, as links don't make it a menu. A CART tree trained on the
labelled blocks below decides which blocks are text.

Tags are read by the rules of HTML, in time linear in the page, broken markup included: a tag that never
ends by these rules ends at its first ``>``, as do those after it; one that has none is the page's last.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from roadlens.llm.words import small_batches, trimmed

# Elements and name parts.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style noscript iframe title textarea".split())  # up to their end tag there is no markup
SKIPPED = RAW | set("template svg object canvas math select".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
FURNITURE = set("nav header footer aside form menu dialog button head label fieldset".split())
MAIN = {"article", "main"}
FURNITURE_NAMES = set(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies copyright disqus "
    "footer footnav gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices notification pagination pager popup promo "
    "promotion related reply replies respond search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription tags toolbar widget widgets".split()
)
MAIN_NAMES = set("article articlebody maincontent postbody entry story post-content".split())
RUNNING = set("p h1 h2 h3 h4 h5 h6 blockquote pre td th dd dt figcaption caption".split())
PLACES = {"furniture": -2, "outside": -1, "unknown": 0, "main": 1, "running": 2}

# Labelled blocks. Place, words, link density, then words and link density of the block
# before and of the block after; 1 is text. -1 words: there is no such block.
LABELLED = [
    (-2, 1, 1.0, 1, 1.0, 1, 1.0, 0), (-2, 2, 1.0, -1, 0.0, 3, 1.0, 0), (-2, 8, 0.0, 1, 1.0, 9, 0.0, 0), (-2, 12, 0.2, 80, 0.0, -1, 0.0, 0),
    (-2, 40, 0.0, 60, 0.0, 30, 0.0, 0), (-2, 120, 0.0, 90, 0.0, 70, 0.0, 0), (-2, 5, 0.5, 40, 0.0, 2, 1.0, 0), (-2, 25, 0.1, 10, 0.0, 50, 0.0, 0),
    (-1, 3, 1.0, -1, 0.0, 4, 1.0, 0), (-1, 9, 0.0, 2, 1.0, 7, 0.0, 0), (-1, 35, 0.0, 3, 1.0, 9, 0.0, 0), (-1, 90, 0.0, 50, 0.0, -1, 0.0, 0),
    (-1, 14, 0.3, 70, 0.0, -1, 0.0, 0), (-1, 6, 0.0, 100, 0.0, 5, 1.0, 0),
    (1, 2, 0.0, 2, 1.0, 9, 0.0, 1), (1, 3, 0.0, 1, 1.0, 40, 0.0, 1), (1, 6, 0.0, 3, 1.0, 30, 0.0, 1), (1, 1, 0.0, 4, 1.0, 5, 0.0, 1),
    (1, 7, 0.28, 9, 0.0, -1, 0.0, 1), (1, 20, 0.15, 40, 0.0, -1, 0.0, 1), (1, 12, 0.4, 30, 0.1, -1, 0.0, 1), (1, 30, 0.3, 40, 0.0, 3, 1.0, 1), (1, 5, 0.2, 3, 0.0, 2, 0.0, 1),
    (1, 8, 0.5, 20, 0.0, 1, 0.0, 1), (1, 4, 0.25, 2, 1.0, 3, 0.0, 1), (1, 6, 0.33, 7, 0.0, 4, 0.5, 1), (1, 10, 0.6, 4, 0.2, -1, 0.0, 1), (1, 3, 0.34, 50, 0.0, -1, 0.0, 1),
    (1, 9, 0.0, 8, 0.0, 40, 0.0, 1), (1, 1, 0.0, 60, 0.0, 70, 0.0, 1), (1, 1, 0.0, 1, 0.0, 1, 0.0, 1), (1, 45, 0.0, 9, 0.0, 80, 0.0, 1),
    (1, 130, 0.0, 30, 0.0, 12, 0.0, 1), (1, 300, 0.05, 50, 0.0, 2, 1.0, 1), (1, 20, 0.3, 50, 0.0, 50, 0.1, 1), (1, 3, 0.0, 80, 0.0, -1, 0.0, 1),
    (1, 6, 1.0, 70, 0.0, 60, 0.0, 1), (1, 5, 1.0, 4, 0.0, 50, 0.0, 1), (1, 2, 0.0, -1, 0.0, -1, 0.0, 1), (1, 15, 0.6, 90, 0.0, 40, 0.0, 1),
    (1, 2, 1.0, 3, 1.0, 2, 1.0, 0), (1, 3, 1.0, 2, 1.0, 40, 0.0, 0), (1, 4, 1.0, 60, 0.0, 3, 1.0, 0), (1, 8, 1.0, 7, 1.0, 9, 1.0, 0), (1, 1, 1.0, 1, 1.0, 1, 1.0, 0),
    (2, 2, 1.0, 3, 1.0, 2, 1.0, 1), (2, 3, 1.0, 2, 1.0, 40, 0.0, 1), (2, 4, 1.0, 60, 0.0, 3, 1.0, 1), (2, 8, 1.0, 7, 1.0, 9, 1.0, 1), (2, 1, 1.0, 1, 1.0, 1, 1.0, 1),
    (2, 40, 0.0, 50, 0.0, 60, 0.0, 1), (2, 3, 0.67, -1, 0.0, -1, 0.0, 1), (2, 25, 0.9, 80, 0.0, -1, 0.0, 1), (2, 1, 0.0, 3, 1.0, 3, 1.0, 1), (2, 90, 1.0, 4, 1.0, 5, 1.0, 1),
    (0, 60, 0.0, 4, 0.0, 80, 0.0, 1), (0, 120, 0.1, 50, 0.0, 60, 0.0, 1), (0, 25, 0.0, 40, 0.0, 90, 0.0, 1), (0, 8, 0.0, 2, 1.0, 60, 0.0, 1),
    (0, 5, 0.0, 70, 0.0, 80, 0.0, 1), (0, 200, 0.02, 6, 0.0, -1, 0.0, 1), (0, 30, 0.2, 45, 0.0, 3, 1.0, 1), (0, 18, 0.0, 60, 0.0, 4, 0.5, 1),
    (0, 4, 0.0, 50, 0.0, 40, 0.0, 1), (0, 40, 0.0, -1, 0.0, -1, 0.0, 1),
    (0, 2, 1.0, 1, 1.0, 3, 1.0, 0), (0, 1, 1.0, -1, 0.0, 1, 1.0, 0), (0, 12, 0.8, 60, 0.0, 3, 1.0, 0), (0, 30, 0.9, 5, 1.0, 6, 1.0, 0),
    (0, 4, 0.0, 3, 1.0, 2, 1.0, 0), (0, 3, 0.0, 2, 0.5, 4, 0.0, 0), (0, 6, 0.2, 50, 0.0, -1, 0.0, 0), (0, 9, 0.0, 60, 0.0, -1, 0.0, 0),
    (0, 5, 0.0, -1, 0.0, 2, 1.0, 0), (0, 7, 0.5, 3, 1.0, -1, 0.0, 0),
]

_ATTRIBUTE = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+"""
# Nothing here can be tried twice at a place, so a match that fails costs one look at the rest of the page.
_TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_ATTRIBUTE})*+)>")
_BROKEN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_NAMED = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?+""")
_SPLIT = re.compile(r"[^a-z0-9]+")


def grow(rows: list[tuple], depth: int = 6) -> tuple:
    """A CART tree: (label,) or (feature, threshold, tree up to it, tree above it); ties go to the first split."""
    ones = sum(r[-1] for r in rows)
    if not depth or ones in (0, len(rows)):
        return (int(2 * ones > len(rows)),)

    def impurity(part: list[tuple]) -> float:
        p = sum(r[-1] for r in part) / len(part)
        return len(part) * p * (1 - p)

    best = None
    for f in range(len(rows[0]) - 1):
        values = sorted({r[f] for r in rows})
        for a, b in zip(values, values[1:], strict=False):
            cut = (a + b) / 2
            low, high = [r for r in rows if r[f] <= cut], [r for r in rows if r[f] > cut]
            cost = impurity(low) + impurity(high)
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, cut, low, high)
    if best is None:
        return (int(2 * ones > len(rows)),)
    return (best[1], best[2], grow(best[3], depth - 1), grow(best[4], depth - 1))


def decide(tree: tuple, row: tuple) -> int:
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0]


def _place(tag: str, attributes: str) -> int:
    """-2 for furniture, 1 for the main part, 0 for neither, by element and by names in class, id and role."""
    if tag in FURNITURE:
        return -2
    names: set[str] = set()
    for key, value in _NAMED.findall(attributes):
        if key.lower() in ("class", "id", "role"):
            for name in value.strip("\"'").lower().split():
                names.add(name)
                names.update(_SPLIT.split(name))
    if tag not in ("html", "body") and names & FURNITURE_NAMES:
        return -2
    return 1 if tag in MAIN or names & MAIN_NAMES or "main" in names else 0


def tokens(page: str) -> Iterator[tuple[str, str, str, str]]:
    """(text, "", "", "") for text and ("", "/" or "", tag, attributes) for tags; skipped elements are a tag "-"."""
    at = start = 0  # text from at on is not given yet
    ordered = True  # no tag so far ran to the end of the page
    endless: set[str] = set()
    while (start := page.find("<", start)) >= 0:
        nxt = page[start + 1 : start + 2]
        if nxt in ("!", "?"):
            if page.startswith("<!--", start):
                end = start + 4
                if not page.startswith((">", "->"), end):
                    end = page.find("-->", end)
                end = len(page) if end < 0 else page.index(">", end) + 1
            else:
                end = page.find(">", start) + 1 or len(page)
            given = ("", "", "", "")
        elif nxt.isascii() and nxt.isalpha() or (nxt == "/" and (after := page[start + 2 : start + 3]).isascii() and after.isalpha()):
            found = _TAG.match(page, start) if ordered else None
            if not found:
                ordered = False
                found = _BROKEN_TAG.match(page, start)
            if not found:  # the page breaks off in this tag
                if start > at:
                    yield html.unescape(page[at:start]), "", "", ""
                return
            end = found.end()
            given = ("", found[1], found[2].lower(), found[3])
            if given[2] in SKIPPED and not found[1] and given[2] not in endless:
                close = re.compile(rf"</{given[2]}(?=[\s/>])[^>]*+>?", re.I).search(page, end)
                if given[2] in ("svg", "math") and found[3].endswith("/"):
                    given = ("", "", "-", "")
                elif close or given[2] in RAW:
                    end = close.end() if close else len(page)
                    given = ("", "", "-", "")
                else:
                    endless.add(given[2])
        else:
            start += 1
            continue
        if start > at:
            yield html.unescape(page[at:start]), "", "", ""
        if given[2]:
            yield given
        at = start = end
    if at < len(page):
        yield html.unescape(page[at:]), "", "", ""


def blocks(page: str) -> list[list]:
    """Text blocks of a page in order: [text, words, words in links, place]."""
    out: list[list] = []
    stack: list[tuple[str, int]] = []
    opened: Counter[str] = Counter()  # tags in the stack, so that an end tag of none costs no look through it
    pieces: list[str] = []
    linked: list[str] = []
    in_link = here = 0

    def close() -> None:
        text = " ".join("".join(pieces).split())
        if text:
            out.append([text, len(text.split(" ")), sum(len(x.split()) for x in linked), here])
        pieces.clear()
        linked.clear()

    for text, ending, tag, attributes in tokens(page):
        if not tag:
            pieces.append(text)
            if in_link:
                linked.append(text)
            continue
        if tag == "-":
            pieces.append(" ")
            continue
        if tag == "a":
            in_link = 0 if ending else 1
        if tag == "br":
            pieces.append(" ")
        own = 0 if ending or tag in VOID else _place(tag, attributes)
        if tag in BLOCK or own or (ending and opened[tag]):
            close()
            if tag in BLOCK:
                in_link = 0
            if ending:
                while opened[tag]:
                    name = stack.pop()[0]
                    opened[name] -= 1
                    if name == tag:
                        break
            elif tag not in VOID:
                while stack and ((tag in BLOCK and stack[-1][0] == "p") or (tag == "li" and stack[-1][0] == "li")):  # it ends what is open
                    opened[stack.pop()[0]] -= 1
                above = stack[-1][1] if stack else 0
                stack.append((tag, -2 if -2 in (above, own) else max(above, own)))
                opened[tag] += 1
            here = stack[-1][1] if stack else 0
            if here == 1 and stack[-1][0] in RUNNING:
                here = 2
    close()
    return out


def main_text(page: str, tree: tuple) -> str:
    """The blocks that the tree takes as text, joined by line feeds."""
    found = blocks(page)
    main = any(b[3] > 0 for b in found)
    density = [min(1.0, b[2] / b[1]) for b in found]
    out = []
    for i, (text, words, _, place) in enumerate(found):
        before = (found[i - 1][1], density[i - 1]) if i else (-1, 0.0)
        after = (found[i + 1][1], density[i + 1]) if i + 1 < len(found) else (-1, 0.0)
        if decide(tree, (-1 if main and place == 0 else place, words, density[i], *before, *after)):
            out.append(text)
    return "\n".join(out)


def extract(pages: DataFrame, page: str = "html", text: str = "text", labelled: list[tuple] | None = None) -> DataFrame:
    """Add the main text of ``page`` to every row as a column ``text``; empty if there is none.

    Null or empty html gives an empty text. Character references are decoded, white space in a block is
    one blank, and nothing is capped, however long a page is. Where classes tie in a leaf of the tree,
    blocks are not text. A column named as ``text`` is replaced; all others stay, whatever their names.
    Repeated rows each get the same result. No rows give no rows.
    """
    tree = grow(labelled or LABELLED)
    pages = small_batches(pages)
    # The page's own columns travel in a struct, so that none meets a name of ours.
    own = F.struct(F.lit(None).cast("int").alias("_"), *[F.col(f"`{c}`") for c in pages.columns if c != text])
    given = pages.select(own.alias("row"), F.col(f"`{page}`").cast("string").alias("page"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(x.as_py() or "", tree) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["row", "text"])

    out = given.mapInArrow(trimmed(run), StructType([given.schema["row"], StructField("text", StringType())]))
    return out.select(*[F.col(f"row.`{c}`") for c in pages.columns if c != text], F.col("text").alias(text))
