"""Operator 9: main text of web pages by differencing with the page of the nearest URL.

Pages are sorted by host and path; each is paired with the neighbour whose path has more in common. Text lines (blocks)
of both are aligned by longest common subsequence and the shared ones outside the article are deleted: they belong to the
site. Differencing alone leaves what differs from page to page, such as menus and adverts drawn at random, and would
delete what two articles share; so the mark-up has a say: lines in an ``article`` or ``main`` element are kept whatever
the neighbour has, a page with such an element keeps no others unless its own lines outside are longer (the elements are
teasers then), and menus, footers, forms and the like never stay. An element without an end tag ends where HTML ends it.

The sort is by range, so a large host is spread over many tasks. At the seam of two ranges a page is paired within its
own.
"""

from __future__ import annotations

import html
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Elements whose text is never part of the article, elements that do not end a block, elements without end
# tags, and words in class or id that mark page furniture.
DROPPED = set("head script style noscript template nav footer aside form button select textarea iframe svg dialog menu".split())
INLINE = set(
    "a abbr b bdi bdo cite code data del dfn em font i ins kbd mark q s samp small span strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = set(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "masthead menu modal nav navbar navigation newsletter notice popup promo related share sidebar social sponsor sponsored "
    "subscribe toolbar widget".split()
)
# Words that may stand beside those in one class or id without giving it another meaning.
NEUTRAL = set(
    "area article articles bar block bottom box button buttons container content desktop fixed global header icon icons inner "
    "item items left link links list main mobile outer page panel post posts primary right secondary section site slot sticky "
    "top unit wrap wrapper".split()
)
FURNITURE_ROLES = set("navigation banner contentinfo complementary search form dialog alert".split())
# Elements that hold blocks, and the start tags that end an element whose own end tag may be left out.
CONTAINERS = set(
    "address article aside blockquote body details dialog div dl fieldset figure footer form header html main nav ol section "
    "table tbody td tfoot th thead tr ul".split()
)
NESTING = CONTAINERS - set("tbody td tfoot th thead tr".split())
ENDED_BY = {
    "p": CONTAINERS | set("dd dt h1 h2 h3 h4 h5 h6 hr li p pre".split()),
    "li": {"li"},
    **dict.fromkeys(("dd", "dt"), {"dd", "dt"}),
    **dict.fromkeys(("td", "th"), {"td", "th", "tr", "tbody", "tfoot", "thead"}),
    "tr": {"tr", "tbody", "tfoot", "thead"},
}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|template|noscript)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
_NUMBER = re.compile(r"\d+")


def _is_furniture(attributes: str) -> bool:
    """Whether a role, or a whole class or id of furniture words and neutral ones, marks page furniture."""
    for name, *values in _ATTRIBUTE.findall(attributes):
        known = FURNITURE_ROLES if name.lower() == "role" else FURNITURE
        for value in "".join(values).lower().split():
            words = set(_WORD.findall(value))
            if words & known and words <= known | NEUTRAL:
                return True
    return False


def lines_of(source: str) -> tuple[list[str], list[bool], bool]:
    """Blocks of text outside page furniture, whether each lies in an article, and whether the page has one."""
    lines: list[str] = []
    inner: list[bool] = []
    parts: list[str] = []
    dropped = None  # open furniture element, its depth, and the containers open in one that may lack its end tag
    depth = articles = nested = 0
    has_article = False

    def close() -> None:
        line = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if line:
            lines.append(line)
            inner.append(articles > 0)

    at = 0
    for token in _TOKEN.finditer(source):
        if dropped is None:
            parts.append(source[at : token.start()])
        at = token.end()
        name = (token[3] or "").lower()
        if not name:
            continue
        ends = token[2] == "/"
        if dropped is not None:
            if dropped in ENDED_BY:
                if nested:
                    if name in NESTING:
                        nested += -1 if ends else 1
                    continue
                if ends and name == dropped:
                    dropped = None
                    continue
                if name not in (CONTAINERS if ends else ENDED_BY[dropped]) or (dropped == "tr" and name in ("td", "th") and ends):
                    nested += not ends and name in NESTING
                    continue
                dropped = None  # ended by this tag, which counts as if it stood alone
            elif name == dropped and name not in VOID:
                depth += -1 if ends else 1
                if not depth:
                    dropped = None
                continue
            else:
                if ends and name in ("body", "html"):
                    dropped = None
                continue
        if name in INLINE and (ends or not _is_furniture(token[4])):
            continue
        close()
        if name in ("article", "main"):
            if not ends and not _is_furniture(token[4]):
                has_article, articles = True, articles + 1
                continue
            if ends:
                articles = max(0, articles - 1)
                continue
        if not ends and name not in VOID and not token[4].endswith("/"):
            header = name == "header" and not articles
            if name in DROPPED or header or (name not in ("html", "body") and _is_furniture(token[4])):
                dropped, depth, nested = name, 1, 0
    if dropped is None:
        parts.append(source[at:])
    close()
    return lines, inner, has_article


def common_lines(one: list[str], two: list[str]) -> set[int]:
    """Positions in ``one`` of a longest common subsequence with ``two``; bit-parallel, a row a line of ``two``."""
    places: dict[str, int] = {}
    for i, line in enumerate(one):
        places[line] = places.get(line, 0) | 1 << i
    full = (1 << len(one)) - 1
    row, rows = full, [full]
    for line in two:
        met = row & places.get(line, 0)
        row = ((row + met) | (row - met)) & full
        rows.append(row)
    i, j, shared = len(one), len(two), set()
    while i and j:
        bit = 1 << (i - 1)
        if rows[j] & bit:
            i -= 1
        elif not rows[j - 1] & bit:
            j -= 1
        else:
            i, j = i - 1, j - 1
            shared.add(i)
    return shared


def main_text(page: tuple, other: tuple | None) -> str:
    """Main text of a page of ``lines_of``, given those of its pair.

    Where lines outside the article elements that the pair does not share are longer than those inside, the elements are
    teasers, and the lines of the whole page that are not shared stay.
    """
    lines, inner, has_article = page
    outside = [i for i, own in enumerate(inner) if not own]
    shared: set[int] = set()
    if other is not None and outside:
        theirs = [line for line, own in zip(other[0], other[1], strict=True) if not own]
        shared = {outside[i] for i in common_lines([lines[i] for i in outside], theirs)}
    own = sum(len(lines[i]) for i in outside if i not in shared)
    only_articles = has_article and own <= sum(len(x) for x, within in zip(lines, inner, strict=True) if within)
    kept = [x for i, x in enumerate(lines) if (inner[i] or not only_articles) and i not in shared]
    return " ".join(kept)


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    A page of the same host and path, such as a repeated row, is no pair: everything would be shared; such rows pair with
    the path before them. A page without a pair keeps all lines outside furniture. Null html gives empty text; a null url counts as an empty host and path; null
    ids are carried. An empty table gives an empty result; other columns are ignored.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    address = F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?([^/?#]*)([^?#]*)", 2)
    keyed = pages.select("page_id", "url", "html", F.lower(address).alias("host"), path.alias("path"))
    ranged = keyed.repartitionByRange(count, "host", "path", "page_id", F.xxhash64("html"))
    ordered = ranged.sortWithinPartitions("host", "path", "page_id", "url", F.xxhash64("html"))

    def likeness(one: tuple, two: tuple | None) -> int:
        if two is None or one[2] != two[2] or one[3] == two[3]:
            return -1
        return len(os.path.commonprefix([one[3], two[3]]))

    def result(before, own, after) -> tuple:
        back, ahead = likeness(own, before), likeness(own, after)
        pair = None if max(back, ahead) < 0 else before if back >= ahead else after
        text = main_text(own[4], pair[4] if pair else None)
        return own[0], own[1], text, len(text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = own = None
        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "host", "path", "html"))
            for page_id, url, host, path, source in zip(*columns, strict=True):
                after = (page_id, url, host, path, lines_of(source or ""))
                if own is not None:
                    done.append(result(before, own, after))
                    if likeness(own, after) >= 0 or own[2] != after[2]:
                        before = own
                own = after
                if len(done) == 500:
                    yield batch_of(done)
                    done = []
            yield batch_of(done)
        if own is not None:
            yield batch_of([result(before, own, None)])

    id_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    types = {"page_id": id_type, "url": pa.string(), "text": pa.string(), "n_chars": pa.int64()}

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types.values())]
        return pa.RecordBatch.from_arrays(arrays, names=list(types))

    return ordered.mapInArrow(scan, f"page_id {kind}, url string, text string, n_chars long")
