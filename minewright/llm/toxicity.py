"""Operator 5: toxicity by compression distance.

Two zstandard dictionaries are made from labelled texts: an ordinary one, trained on windows of ordinary text, and a toxic
one, which is the ordinary one behind a part trained on the words that set toxic texts apart: words, and all words of a stem
(the first letters), that significantly more toxic texts have. Endings never seen in training match by their stem. Sharing
the ordinary part at the same distances makes ordinary windows compress alike with both, so the difference of the two lengths
shows toxic passages and little else. How many windows of a text gain how many bytes is weighed by a logistic model; the
decision is calibrated to mark ``FALSE_ALARMS`` of the ordinary texts that trained neither.

Dictionaries, decision and model are fitted on a bounded sample, ``DOCS_PER_CLASS`` texts a label: a documented limit of
the fit, drawn by a hash of the id. Scoring runs over whole texts of all documents in place, without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.llm import blocks as B

DOCS_PER_CLASS = 1500
WINDOW_WORDS = 8
ORDINARY_BYTES = 4096
TOXIC_BYTES = 512
STEMS = (4, 5, 6)
SIGNIFICANT = 4.5
DECIDED = 0.7
FALSE_ALARMS = 0.03
LEVEL = 7
GAINS = 8
RIDGE = 2.0
SLICE_BYTES = 8 << 20
# Fixed value of the dictionary format: repeat offsets 1, 4 and 8 as little-endian integers.
_OFFSETS = bytes([1, 0, 0, 0, 4, 0, 0, 0, 8, 0, 0, 0])
_PUNCTUATION = ".,;:!?\"'()[]{}|*#$%&<>-_~`+=/\\"


def windows(text: str | None, size: int = WINDOW_WORDS) -> list[bytes]:
    """Lower-cased windows of ``size`` words, each beginning and ending with a space; the last may be shorter."""
    words = (text or "").lower().split()
    return [f" {' '.join(words[i : i + size])} ".encode() for i in range(0, len(words), size)]


def pieces(word: str) -> set[str]:
    """The word without punctuation, closed by a space, and its stems."""
    bare = word.strip(_PUNCTUATION)
    return {f"{bare} ", *(bare[:n] for n in STEMS if len(bare) >= n)} if bare else set()


def distinctive_pieces(toxic: list[str], ordinary: list[str]) -> set[str]:
    """Words and stems in more toxic than ordinary texts by ``SIGNIFICANT`` standard errors, and over twice as often.

    A text counts for a word only in a neighbourhood that no earlier text of its label has, so copies count once.
    """
    found = []
    for texts in (toxic, ordinary):
        seen: Counter[str] = Counter()
        places: set[tuple[str, ...]] = set()
        for text in texts:
            words = text.lower().split()
            near = set(zip(["", *words], words, [*words[1:], ""], strict=False))
            seen.update(set().union(*(pieces(w) for w in {w for _, w, _ in near - places})))
            places |= near
        found.append(seen)
    many, few = max(1, len(toxic)), max(1, len(ordinary))
    out = set()
    for piece, n in found[0].items():
        share, other = n / many, found[1][piece] / few
        pooled = (n + found[1][piece]) / (many + few)
        if share > 2 * other and share - other > SIGNIFICANT * np.sqrt(pooled * (1 - pooled) * (1 / many + 1 / few)):
            out.add(piece)
    return out


def marked_words(toxic: list[str], known: set[str]) -> list[bytes]:
    """Words with a distinctive piece, as often as the root of the number of texts that have them, in hashed order."""
    seen: Counter[str] = Counter()
    for text in toxic:
        seen.update({w.strip(_PUNCTUATION) for w in set(text.lower().split()) if pieces(w) & known})
    copies = [(i, f" {w} ".encode()) for w, n in seen.items() for i in range(int(np.ceil(np.sqrt(n))))]
    return [word for _, word in sorted(copies, key=lambda x: (crc32(b"%d%s" % x), x))]


def _trained(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary trained on the samples, most frequent samples filling what training leaves.

    A trained dictionary has a head of entropy tables that ends with its three repeat offsets; only what follows is used.
    """
    try:
        content = zstandard.train_dictionary(size, samples, k=32, d=6).as_bytes().rpartition(_OFFSETS)[2]
    except zstandard.ZstdError:
        content = b""
    parts, room = [], size - len(content)
    for sample, _ in Counter(samples).most_common():
        if len(sample) <= room and sample not in content:
            parts.append(sample)
            room -= len(sample)
    return b"".join(reversed(parts)) + content


@dataclass
class Model:
    """Dictionary contents, weights of the logistic model over ``features``, and what calibration adds to its logit."""

    ordinary: bytes
    toxic: bytes
    weights: np.ndarray
    shift: float = 0.0

    def chances(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows @ self.weights + self.shift, -500, 500)))

    def meter(self) -> _Meter:
        # Equal sizes, so that zstandard picks equal parameters; bytes of 0 match no text.
        return _Meter(self.toxic + self.ordinary, bytes(len(self.toxic)) + self.ordinary)


class _Meter:
    def __init__(self, toxic: bytes, ordinary: bytes):
        self._sizes = []
        for content in (ordinary, toxic):
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=LEVEL)
            press = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False)
            self._sizes.append(press.compress)

    def gains(self, text: str | None) -> np.ndarray:
        """Bytes that each window is shorter with the toxic dictionary."""
        ordinary, toxic = self._sizes
        return np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(text)], np.int64)


def features(gains: np.ndarray) -> list[float]:
    """Constant, windows that gain at least 1 to ``GAINS`` bytes (as logarithms), and the share of those with 2, 4 and 6."""
    over = [float((gains >= t).sum()) for t in range(1, GAINS + 1)]
    size = max(1, len(gains))
    return [1.0, *np.log1p(over).tolist(), *(min(3.0, 10.0 * over[t - 1] / size) for t in (2, 4, 6))]


def _logistic(rows: np.ndarray, labels: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    weights = np.zeros(rows.shape[1])
    keep = np.diag([0.0] + [ridge] * (rows.shape[1] - 1)) + 1e-9 * np.eye(rows.shape[1])
    for _ in range(25):
        chance = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (labels - chance) - keep @ weights
        bend = (rows * (chance * (1 - chance) + 1e-9)[:, None]).T @ rows + keep
        weights = weights + np.linalg.solve(bend, slope)
    return weights


def fit(toxic: list[str], ordinary: list[str], share: float) -> Model:
    """Fit dictionaries on one half of the texts, model and decision on the other; ``share``: of toxic rows in all."""
    marked = marked_words(toxic[::2], distinctive_pieces(toxic[::2], ordinary[::2]))
    weights = np.zeros(len(features(np.zeros(0))))
    weights[0] = np.log(max(share, 1e-3) / max(1 - share, 1e-3))
    model = Model(
        _trained([w for t in ordinary[::2] for w in windows(t)], ORDINARY_BYTES) if ordinary else b"",
        _trained(marked, TOXIC_BYTES) if marked else b"",
        weights,
    )
    if not model.toxic or not model.ordinary:
        return model
    meter = model.meter()
    parts = [np.array([features(meter.gains(t)) for t in texts[1::2]]).reshape(-1, len(weights)) for texts in (toxic, ordinary)]
    if not min(map(len, parts)):
        return model
    model.weights = _logistic(np.concatenate(parts), np.repeat([1.0, 0.0], [len(p) for p in parts]))
    # The logit above which few ordinary texts are; a text without any gain is never above it.
    cut = float(np.quantile(parts[1] @ model.weights, 1 - FALSE_ALARMS, method="higher"))
    model.shift = np.log(DECIDED / (1 - DECIDED)) - max(cut, float(model.weights[0])) - 1e-6
    return model


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, usable: Column, per_class: int = DOCS_PER_CLASS) -> Model:
    """Fit on about ``per_class`` texts a label among the ``usable`` labels; only ids, labels and texts are read."""
    rows = labels.filter(usable & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rate = F.when(F.col("toxic") == 1, per_class / sizes.get(1, 1)).otherwise(per_class / sizes.get(0, 1))
    chosen = rows.filter(draw < rate).orderBy(draw, "doc_id").limit(3 * per_class)
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull())
    sample = sorted(texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic").limit(6 * per_class).collect())
    parts = [[r["text"] for r in sample if r["toxic"] == k] for k in (1, 0)]
    total = sum(sizes.values())
    return fit(*parts, sizes.get(1, 0) / total if total else 0.0)


def score(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of every row: 0 to 1, higher where label 1 is likelier, and 1 from ``DECIDED`` on.

    Null and wordless texts have no hit, like most ordinary texts. Rows are independent, so repeated rows and null ids are
    like others; an empty table gives an empty result; other columns are ignored.
    """
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        meter = fitted.meter()
        for table in B.gathered(batches, "text", SLICE_BYTES):
            chance = fitted.chances(np.array([features(meter.gains(t)) for t in table.column("text").to_pylist()]))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": table.column("doc_id").combine_chunks(),
                    "score": pa.array(chance, pa.float64()),
                    "predicted": pa.array((chance >= DECIDED).astype(np.int32), pa.int32()),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, score double, predicted int")
