"""Operator 11: secret scan with multipart credential linking, in DataFrame functions alone.

Strong patterns (assigned secrets, access identifiers, long hexadecimal runs) always count. Parts that are weak on their
own (a bare mixed token, an account name, an endpoint) are reported only where complementary parts occur beside them:

* a token where an identifier (access identifier or account) is near,
* an account where a secret (assigned, hexadecimal or a token) is near,
* an endpoint where both an identifier and a secret are near.

Near means within a scope, the lines between two blank ones, and with starts at most ``LINK_CHARS`` code points apart. The
interval join of parts is a range frame over the starts of a scope: each part meets the parts inside its interval as
counts, so crowded scopes make no pairs.

Matches come from ``regexp_extract_all`` and the gaps between them from ``split`` by the same pattern; their running lengths
are the positions. Texts are not shuffled: a row's matches are exploded with their lengths, grouped by row number, and
come back as one row. A row's matches are bounded by its own text and no two rows share a group, so no key is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minewright.llm import blocks as B

LINK_CHARS = 200
MIN_VALUE, MIN_ACCESS, MIN_HEX, MIN_TOKEN = 6, 20, 24, 32


def _either_case(text: str) -> str:
    """The pattern with every letter in both cases. Case flags fold other scripts' letters too in some engines."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in text)


# Fixed patterns of the task. A run that ends only where its class ends is the same match with its least length written
# into the pattern; the assigned value is not, since a short one still uses up its key.
ASSIGN = f"({_either_case('password|passwd|secret|token|api_?key')})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{%d,}" % (MIN_ACCESS - 4)
HEX = "[0-9a-f]{%d,}" % MIN_HEX
# Weak parts.
TOKEN = "[A-Za-z0-9+/]{%d,}" % MIN_TOKEN
ACCOUNT = f"({_either_case('client_?id|account_?id|user_?name|login')})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)"""
ENDPOINT = r"(https?|ftp|jdbc:[a-z]+|mongodb|redis|amqp|postgres|mysql)://[A-Za-z0-9@:._/-]+"
BREAK = r"\n[\x20\x09\r]*\n"

# Kinds in the order in which spans of one start are listed.
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "token": TOKEN, "account": ACCOUNT, "endpoint": ENDPOINT, "break": BREAK}
KINDS = list(PATTERNS)
BASE = KINDS[:3]


# Words that a text must have, in either case, for the pattern to match at all: plain searches before the expressions run.
_WORDS = {"assign": ("passw", "secret", "token", "api"), "account": ("client", "account", "user", "login")}


def _gates(text: Column) -> dict[str, Column]:
    """Whether each pattern can matter to a text; weak parts and breaks only do where there may be an identifier."""
    small = F.lower(text)
    any_of = {k: F.expr("false") for k in _WORDS}
    for kind, words in _WORDS.items():
        for word in words:
            any_of[kind] = any_of[kind] | small.contains(word)
    identified = text.contains("AKIA") | any_of["account"]
    gates = {"assign": any_of["assign"], "access": text.contains("AKIA"), "hex": F.lit(True)}
    gates |= {"token": identified, "account": any_of["account"], "endpoint": identified & text.contains("://"), "break": identified}
    return gates


def _hits(text: Column, kind: str) -> Column:
    """The matches of a pattern, from left to right; null where there is none."""
    found = F.when(F.col(f"_may_{kind}"), F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)))
    return found.alias(f"_hits_{kind}")


def _matches(text: Column, hits: Column, kind: str) -> Column:
    """Array of (kind, gap before, size, counts) of a pattern's matches, from left to right."""
    pattern = PATTERNS[kind]

    def counts(hit: Column) -> Column:
        if kind in ("assign", "account"):
            return F.length(F.regexp_extract(hit, pattern, 2)) >= (MIN_VALUE if kind == "assign" else 3)
        if kind == "token":  # a mixed run: words of one case and plain numbers are none
            return hit.rlike("[a-z]") & hit.rlike("[A-Z]") & hit.rlike("[0-9]")
        return F.lit(True)

    def part(hit: Column, gap: Column) -> Column:
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            F.length(gap).alias("gap"),
            F.length(hit).alias("size"),
            counts(hit).alias("counts"),
        )

    found = F.zip_with(hits, F.split(text, pattern, -1), part)
    found = F.filter(found, lambda m: m["size"].isNotNull())  # there is a gap more than matches
    return F.when(F.size(hits) > 0, found).otherwise(F.array().cast(_PARTS))


_PARTS = "array<struct<kind int, gap int, size int, counts boolean>>"


def scan(docs: DataFrame, link_chars: int = LINK_CHARS) -> DataFrame:
    """Spans of every text: doc_id, n_assign, n_access, n_hex, n_linked, base_spans, spans.

    ``spans`` is an array of (start, kind, end), ends exclusive, in code points, by start and kind (a number in ``KINDS``);
    ``base_spans`` are those of the three strong kinds. Weak spans that overlap a strong one are left out, as it reports
    the place already. Null and empty texts have no spans; rows are independent, so repeated rows and null ids are like
    others; an empty table gives an empty result, and other columns are ignored.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("_row"))
    text = F.col("text")
    # Projections of their own, so that each search and pattern runs once a text.
    rows = rows.select("*", *[gate.alias(f"_may_{kind}") for kind, gate in _gates(text).items()])
    rows = rows.select("_row", "doc_id", "text", *[_hits(text, kind) for kind in KINDS])
    # A first part of no kind stands for the text itself, so that nothing has to be joined back.
    itself = F.array(F.struct(F.lit(-1).alias("kind"), F.lit(0).alias("gap"), F.lit(0).alias("size"), F.lit(True).alias("counts")))
    found = F.concat(itself.cast(_PARTS), *[_matches(text, F.col(f"_hits_{k}"), k).cast(_PARTS) for k in KINDS])
    parts = rows.select("_row", "doc_id", F.posexplode(found).alias("i", "m")).select("_row", "doc_id", "i", "m.*")
    parts = parts.repartition(B.partitions_for(docs), "_row")

    kind = F.col("kind")
    strong, is_break, itself = kind.between(0, len(BASE) - 1), kind == KINDS.index("break"), kind < 0
    so_far = Window.partitionBy("_row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = parts.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far))
    placed = placed.withColumn("start", F.col("end") - F.col("size")).filter("counts")

    order = Window.partitionBy("_row").orderBy("start", "kind")
    # Both ways from the first row on: a frame that ends at the last row is computed anew for every row.
    back = Window.partitionBy("_row").orderBy(F.col("start").desc(), F.col("kind").desc())
    before, behind = (w.rowsBetween(Window.unboundedPreceding, -1) for w in (order, back))
    inside = (F.max(F.when(strong, F.col("end"))).over(before) > F.col("start")) | (
        F.min(F.when(strong, F.col("start"))).over(behind) < F.col("end")
    )
    breaks = F.sum(is_break.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    scoped = placed.withColumn("scope", breaks).withColumn("covered", ~strong & ~itself & F.coalesce(inside, F.lit(False)))
    scoped = scoped.filter(~is_break & ~F.col("covered"))

    near = Window.partitionBy("_row", "scope").orderBy("start").rangeBetween(-link_chars, link_chars)
    identifier, secret = (kind.isin([KINDS.index(k) for k in ks]) for ks in (("access", "account"), ("assign", "hex", "token")))
    linked = scoped.withColumn("ids", F.count_if(identifier).over(near)).withColumn("secrets", F.count_if(secret).over(near))
    has_id, has_secret = F.col("ids") > 0, F.col("secrets") > 0
    weak = (
        ((kind == KINDS.index("token")) & has_id)
        | ((kind == KINDS.index("account")) & has_secret)
        | ((kind == KINDS.index("endpoint")) & has_id & has_secret)
    )
    span = F.struct(F.col("start"), kind, F.col("end"))
    return (
        linked.groupBy("_row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            *[F.count_if(kind == KINDS.index(k)).alias(f"n_{k}") for k in BASE],
            F.count_if(weak).alias("n_linked"),
            F.array_sort(F.collect_list(F.when(strong, span))).alias("base_spans"),
            F.array_sort(F.collect_list(F.when(strong | weak, span))).alias("spans"),
        )
        .drop("_row")
    )


def written(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    parts = F.transform(
        spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(parts, ",")
