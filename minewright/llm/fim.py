"""Operator 12: fill-in-middle transformation with a sparse index of multibyte characters.

Texts are cut and put together as UTF-8 bytes, while cuts may be given in code points and lengths are reported in them.
``CharIndex`` converts between the two: it records only the places of multibyte characters and their excess bytes, so a
text of ASCII costs nothing, and a cut is one ``searchsorted`` and a subtraction. One index covers all texts of a slice.

A text is cut into units (lines or code points), hashes of the id pick two cuts, and prefix, middle and suffix are put
in the order of the form: ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or ``plain``. Rows stay where
they are: no shuffle, and a task holds a slice of about ``SLICE_BYTES`` or one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minewright.llm import blocks as B

# Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SLICE_BYTES = 4 << 20
_CUTS = ("_h1", "_h2", "_h3", "_h4")


class CharIndex:
    """Positions and excess bytes of the multibyte characters of UTF-8 bytes; everything else is arithmetic.

    ``at`` holds the byte offset of each multibyte character, ``chars`` its code-point offset, and ``excess[i]`` the bytes
    beyond one a character that the first ``i`` of them have.
    """

    def __init__(self, raw: np.ndarray):
        self.at = np.flatnonzero(raw >= 0xC0)
        lead = raw[self.at]
        extra = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([np.zeros(1, np.int64), np.cumsum(extra)])
        self.chars = self.at - self.excess[:-1]

    def to_chars(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before each byte offset; offsets are at character starts or the end."""
        return cuts - self.excess[np.searchsorted(self.at, cuts)]

    def to_bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Byte offset of each code-point offset."""
        return cuts + self.excess[np.searchsorted(self.chars, cuts)]


class Slice:
    """Texts of a slice as one byte array with its offsets; null texts are empty."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray):
        column = texts.cast(pa.large_string())
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        _, offsets, data = column.buffers()
        edges = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        first = int(edges[0])
        self.raw, self.starts, self.ends = raw[first : int(edges[-1])], edges[:-1] - first, edges[1:] - first
        self.index = CharIndex(self.raw)

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Line breaks of the slice, and the units of each text: lines with their break, or a last one without."""
        breaks = np.flatnonzero(self.raw == 10)
        own = np.searchsorted(breaks, self.ends) - np.searchsorted(breaks, self.starts)
        filled = self.ends > self.starts
        open_end = np.zeros(len(own), bool)
        open_end[filled] = self.raw[self.ends[filled] - 1] != 10
        return breaks, own + open_end

    def line_cuts(self, breaks: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Byte offset behind the first ``units`` lines of each text."""
        last = np.searchsorted(breaks, self.starts) + units - 1
        inside = (units > 0) & (last < np.searchsorted(breaks, self.ends))
        cuts = np.where(units > 0, self.ends, self.starts)
        cuts[inside] = breaks[last[inside]] + 1
        return cuts


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit draws from sha256 of ``seed:doc_id``; a null id is written as nothing."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def _assemble(part: Slice, starts: np.ndarray, first: np.ndarray, second: np.ndarray, forms: np.ndarray) -> pa.Array:
    """Output texts: pieces of the slice and markers, joined once for all rows."""
    raw = memoryview(part.raw)
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    pieces: list = []
    sizes = part.ends - starts
    for a, b, c, e, form in zip(starts.tolist(), first.tolist(), second.tolist(), part.ends.tolist(), forms.tolist(), strict=True):
        if form == 0:
            pieces.append(raw[a:e])
        elif form == 1:
            pieces += [p, raw[a:b], s, raw[c:e], m, raw[b:c]]
        else:
            pieces += [s, raw[c:e], p, raw[a:b], m, raw[b:c]]
    sizes = sizes + np.where(forms == 0, 0, len(p) + len(s) + len(m))
    edges = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    buffers = [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(b"".join(pieces))]
    return pa.Array.from_buffers(pa.large_string(), len(sizes), buffers).cast(pa.string())


def transform(
    docs: DataFrame, *, seed: int = 7, unit: str = "line", fim_percent: int = 100, spm_percent: int = 50
) -> DataFrame:
    """Fill-in-middle form of every text: doc_id, n, form, prefix_chars, middle_chars, output.

    ``n`` counts the units (``line`` or ``char``). The prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1) units
    and the middle after the larger. A text is left ``plain``, with null lengths, when it is empty or null, contains a
    marker, or h3 % 100 >= ``fim_percent``; else it is ``spm`` where h4 % 100 < ``spm_percent``, and ``psm`` elsewhere.
    Rows are independent: repeated ids get equal cuts, a null id draws from the seed alone, an empty table gives an empty
    result, and other columns are ignored.
    """
    if unit not in ("line", "char"):
        raise ValueError(f"unknown unit {unit}")
    rows = docs.select("doc_id", "text", *[h.alias(n) for h, n in zip(draws(F.col("doc_id"), seed), _CUTS, strict=True)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in B.gathered(batches, "text", SLICE_BYTES):
            yield _transformed(table)

    def _transformed(table: pa.Table) -> pa.RecordBatch:
        texts = table.column("text").combine_chunks()
        part = Slice(texts)
        h1, h2, h3, h4 = (table.column(c).to_numpy() for c in _CUTS)
        if unit == "line":
            breaks, n = part.lines()
        else:
            n = part.index.to_chars(part.ends) - part.index.to_chars(part.starts)
        low, high = np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))
        if unit == "line":
            first, second = part.line_cuts(breaks, low), part.line_cuts(breaks, high)
        else:
            base = part.index.to_chars(part.starts)
            first, second = part.index.to_bytes(base + low), part.index.to_bytes(base + high)
        held = np.zeros(len(n), bool)
        for marker in (PREFIX, SUFFIX, MIDDLE):
            held |= pc.match_substring(texts, marker).fill_null(False).to_numpy(zero_copy_only=False)
        plain = (part.ends == part.starts) | held | (h3 % 100 >= fim_percent)
        forms = np.where(plain, 0, np.where(h4 % 100 < spm_percent, 2, 1))
        chars = [part.index.to_chars(cut) for cut in (part.starts, first, second)]
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": table.column("doc_id").combine_chunks(),
                "n": pa.array(n, pa.int64()),
                "form": pa.array(np.array(["plain", "psm", "spm"], object)[forms], pa.string()),
                "prefix_chars": pa.array(chars[1] - chars[0], pa.int64(), mask=plain),
                "middle_chars": pa.array(chars[2] - chars[1], pa.int64(), mask=plain),
                "output": _assemble(part, part.starts, first, second, forms),
            }
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(scan, schema)


def restored_text(output: Column, form: Column) -> Column:
    """The text that an output was made from, by its form alone.

    Texts with a marker are left plain, and no marker can begin inside another one, so the first occurrence of each
    marker behind the last one is the right one.
    """
    middle = F.instr(output, MIDDLE)
    second = F.when(form == "psm", F.instr(output, SUFFIX)).otherwise(F.instr(output, PREFIX))
    start = F.lit(len(PREFIX) + 1)
    head = F.substring(output, start, second - start)
    tail = F.substring(output, second + len(PREFIX), middle - second - len(PREFIX))
    held = F.substring(output, middle + len(MIDDLE), F.length(output))
    return F.when(form == "plain", output).when(form == "psm", F.concat(head, held, tail)).otherwise(F.concat(tail, held, head))


def with_restored(transformed: DataFrame, name: str = "restored") -> DataFrame:
    """Add the text rebuilt from ``output`` and ``form``."""
    return transformed.withColumn(name, restored_text(F.col("output"), F.col("form")))
