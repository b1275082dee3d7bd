"""Operator 1: quality rules by host.

Every text is measured against per-document rules. Failures are counted by host, and a host's rate for a rule is shrunk by
a beta prior that is fitted to all hosts' rates (method of moments), so that a host with few documents is not condemned by
them. A host whose shrunk rate for some rule is above ``HOST_LIMIT`` loses the rest of its documents too.

Only one narrow row a document is written and joined; a host with a third of all documents is pre-aggregated on the map
side and its rows are split by ``spread_join``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minewright.llm import blocks as B
from minewright.llm.wordhash import column_bytes, inside, mix, ngrams, text_of_position, words_of
from minewright.plans.lineage import cut_lineage
from minewright.plans.spread import spread_join

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_SYMBOL_PERCENT = 10
HOST_LIMIT = 0.5
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1e6
SYMBOLS = "#*$%&|<>"
SLICE_BYTES = 2 << 20

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _repeat_words(words, window: int) -> np.ndarray:
    """Words of each text inside windows that occur twice or more in it."""
    grams = ngrams(words.hashes, window)
    spots = np.flatnonzero(inside(words.bounds, window, len(grams)))
    texts = text_of_position(words.bounds, spots)
    keyed = mix(grams[spots] ^ mix(texts.astype(np.uint64) + np.uint64(1)))
    _, number, counts = np.unique(keyed, return_inverse=True, return_counts=True)
    edges = np.zeros(len(words.hashes) + window + 1, np.int64)
    twice = spots[counts[number] > 1]
    edges[twice] += 1
    edges[twice + window] -= 1
    covered = np.cumsum(np.cumsum(edges) > 0)
    sums = np.concatenate([[0], covered])
    return sums[words.bounds[1:]] - sums[words.bounds[:-1]]


def _repeated_lines(text: str | None) -> int:
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\r\v\f"):
            again += line in seen
            seen.add(line)
    return again


def measure(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of every row; null texts are empty."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in B.gathered(batches, "text", SLICE_BYTES):
            texts = table.column("text")
            words = words_of(texts)
            data, offsets = column_bytes(texts)

            def per_text(mask: np.ndarray, offsets=offsets) -> pa.Array:
                sums = np.concatenate([[0], np.cumsum(mask)])
                return pa.array(sums[offsets[1:]] - sums[offsets[:-1]], pa.int64())

            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": table.column("doc_id").combine_chunks(),
                    "source": table.column("source").combine_chunks(),
                    "n_words": pa.array(np.diff(words.bounds), pa.int64()),
                    "word_chars": per_text(((data & 0xC0) != 0x80) & ~_IS_SPACE[data]),
                    "n_symbols": per_text(_IS_SYMBOL[data]),
                    "n_dup_lines": pa.array([_repeated_lines(t) for t in texts.to_pylist()], pa.int64()),
                    "n_repeat_words": pa.array(_repeat_words(words, window), pa.int64()),
                }
            )

    rows = docs.select("doc_id", "text", "source")
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    return rows.mapInArrow(scan, f"doc_id {kind}, source string, {counts}")


def failures() -> dict[str, Column]:
    """The rules, as columns over ``measure``: true where a document fails."""
    return {
        "short": F.col("n_words") < MIN_WORDS,
        "repeats": F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"),
        "symbols": F.lit(100) * F.col("n_symbols") > F.lit(MAX_SYMBOL_PERCENT) * F.col("word_chars"),
    }


def host_rates(measured: DataFrame) -> DataFrame:
    """Per ``host`` and rule: documents ``n``, failures and the shrunk rate ``<rule>_rate``."""
    rules = failures()
    hosts = cut_lineage(
        measured.groupBy("host").agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(c.cast("long")).alias(r) for r, c in rules.items()]
        )
    )
    rate = {r: F.col(r) / F.col("n") for r in rules}
    stats = hosts.agg(
        *[F.avg(c).alias(f"{r}_mean") for r, c in rate.items()], *[F.var_samp(c).alias(f"{r}_var") for r, c in rate.items()]
    ).first()
    out = hosts
    for rule in rules:
        mean, var = stats[f"{rule}_mean"] or 0.0, stats[f"{rule}_var"] or 0.0
        strength = min(MAX_STRENGTH, max(MIN_STRENGTH, mean * (1 - mean) / var - 1)) if var > 0 else MAX_STRENGTH
        out = out.withColumn(f"{rule}_rate", (F.col(rule) + mean * strength) / (F.col("n") + strength))
    return out


def judge(docs: DataFrame, *, host_limit: float = HOST_LIMIT) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_failed, kept) of every row.

    Words are split at ASCII white space. ``base_failed``: fewer than 20 words, or more than 30 % of the words in repeated
    windows. ``kept``: not failed, and the host (``source``; rows without one are a host of their own) not either. Null
    texts are empty and fail. Repeated rows count each; rows with a null ``doc_id`` are judged like others; an empty table
    gives an empty result. Other columns are ignored.
    """
    host = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source")))
    measured = cut_lineage(measure(docs).withColumn("host", host))
    rules = failures()
    failed = F.greatest(*[F.col(f"{r}_rate") for r in rules]) > host_limit
    verdicts = host_rates(measured).select("host", failed.alias("host_failed"))
    joined = spread_join(measured, verdicts, "host", spread_by=["doc_id", "n_words", "word_chars"])
    base = rules["short"] | rules["repeats"]
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "host_failed", (~base & ~F.col("host_failed")).alias("kept"),
    )
