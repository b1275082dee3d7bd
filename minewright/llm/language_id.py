"""Operator 6: languages of the words of a text by a linear-chain conditional random field.

A word's state is its language. Its features are the word, affixes, character n-grams and the lexicon's verdict (which
language's training words have it, and how clearly), hashed into a table of weights; transitions between the languages of
neighbouring words are learned with them by gradient ascent on the likelihood. Forward-backward gives each word's
probabilities, and a text's language is the one with the largest mean probability over its words with a letter.

The field is fitted on a bounded sample (``DOCS_PER_LANGUAGE`` texts a language, one window of ``TRAIN_WORDS`` words of
each): that is a documented limit of the fit. Windows of different languages are joined in pairs, so that the field sees
switches. Prediction runs over whole texts of all documents in place, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.llm import blocks as B
from minewright.llm.wordhash import mix

DOCS_PER_LANGUAGE = 500
TRAIN_WORDS = 100
ROUNDS = 40
WEIGHTS = 1 << 17
UNDETERMINED = "und"
SLICE_BYTES = 2 << 20
CELLS = 250_000
CACHED_WORDS = 150_000

_WORDLIKE = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """True with a letter in it. The class of ``_WORDLIKE`` also takes superscripts, fractions and Roman numerals."""
    return any(found.group().isalpha() for found in _WORDLIKE.finditer(text))


def in_training(doc_id: Column, parts: int, left_out: int) -> Column:
    """True for the rows to learn from: crc32 of the id as text, modulo ``parts``, is not ``left_out``."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts != left_out, F.lit(False))


def word_features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Weights that the words draw on, and the word that each belongs to; a word without a letter has none.

    Features are hashes of the word, of the one to five bytes at every place of the word between edge marks (with a mark
    they are affixes) and of the lexicon's verdict.
    """
    lettered = [i for i, w in enumerate(words) if has_letter(w)]
    if not lettered:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lowered = [words[i].lower() for i in lettered]
    marked = [f"\x02{w}\x03".encode() for w in lowered]
    sizes = np.array([len(m) for m in marked])
    raw = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    ends = np.repeat(np.cumsum(sizes), sizes)
    place, owner = np.arange(len(raw)), np.repeat(np.arange(len(marked)), sizes)
    parts, owners = [], []
    value = np.zeros(len(raw), np.uint64)
    for k in range(1, 6):
        value = value[: len(raw) - k + 1] * np.uint64(257) + raw[k - 1 :] + np.uint64(1)
        ok = place[: len(value)] + k <= ends[: len(value)]
        parts.append(mix(value[ok] + np.uint64(k << 56)))
        owners.append(owner[: len(value)][ok])
    whole = np.array([crc32(m) for m in marked], np.uint64)
    verdict = np.array([lexicon.get(w, -1) + 1 for w in lowered], np.uint64)
    parts += [mix(whole + np.uint64(6 << 56)), mix(verdict + np.uint64(7 << 56))]
    owners += [np.arange(len(marked))] * 2
    flat = (np.concatenate(parts) % np.uint64(WEIGHTS)).astype(np.int64)
    return flat, np.array(lettered)[np.concatenate(owners)]


def _forward_backward(
    scores: np.ndarray, lengths: np.ndarray, change: np.ndarray, count_moves: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of (step, text, state) under word factors ``scores`` and transition factors; expected transitions.

    Texts must come longest first: at each step only those that reach it take part.
    """
    steps, count, states = scores.shape
    alive = np.searchsorted(-lengths, -np.arange(1, steps + 1), "right")
    ahead = np.zeros_like(scores)
    ahead[0] = scores[0] / scores[0].sum(1, keepdims=True)
    for t in range(1, steps):
        n = alive[t]
        cur = (ahead[t - 1, :n] @ change) * scores[t, :n]
        ahead[t, :n] = cur / cur.sum(1, keepdims=True)
    pairs = np.zeros((states, states))
    behind = np.ones((count, states), scores.dtype)
    back = np.ascontiguousarray(change.T)
    for t in range(steps - 1, -1, -1):
        n = alive[t]
        if t:
            flow = behind[:n] * scores[t, :n]
            nxt = flow @ back
            if count_moves:
                joint = ahead[t - 1, :n].T @ (flow / np.maximum((ahead[t - 1, :n] * nxt).sum(1, keepdims=True), 1e-30))
                pairs += joint * change
        marginal = ahead[t, :n] * behind[:n]
        ahead[t, :n] = marginal / marginal.sum(1, keepdims=True)
        if t:
            behind[:n] = nxt / nxt.sum(1, keepdims=True)
    return ahead, pairs


class Field:
    """The fitted field: languages, hashed weights, transition scores and the lexicon."""

    def __init__(self, languages: list[str], weights: np.ndarray, change: np.ndarray, lexicon: dict[str, int]):
        self.languages, self.weights, self.change, self.lexicon = languages, weights, change, lexicon

    def word_scores(self, words: list[str]) -> np.ndarray:
        flat, owner = word_features(words, self.lexicon)
        states = range(len(self.languages))
        sums = [np.bincount(owner, self.weights[flat, k], minlength=len(words)) for k in states]
        return np.stack(sums, 1).astype(np.float32)


def training_window(text: str) -> list[str]:
    """The ``TRAIN_WORDS`` consecutive words of a text that the fit sees, placed by its hash; a shorter text is its own."""
    words = text.split()
    at = crc32(text.encode()) % max(1, len(words) - TRAIN_WORDS + 1)
    return words[at : at + TRAIN_WORDS]


def fit(texts: list[str], labels: list[str], rounds: int = ROUNDS) -> Field:
    """Fit the field on labelled texts: Adagrad on the log likelihood, whole sample a round."""
    languages = sorted(set(labels))
    states = len(languages)
    number = {name: i for i, name in enumerate(languages)}
    cut = [(training_window(text), number[label]) for text, label in zip(texts, labels, strict=True)]
    windows = [(words, label) for words, label in cut if words]
    seen: dict[str, np.ndarray] = {}
    for words, label in windows:
        for word in {w.lower() for w in words}:
            seen.setdefault(word, np.zeros(states))[label] += 1
    lexicon = {w: int(c.argmax()) * 2 + int(c.max() >= 0.9 * c.sum()) for w, c in seen.items() if c.sum() >= 2}
    words = sorted({w for ws, _ in windows for w in ws})
    place = {w: i for i, w in enumerate(words)}
    flat, owner = word_features(words, lexicon)
    half = (len(windows) + 1) // 2
    chains = [windows[i : i + 1] + windows[i + half : i + half + 1] for i in range(half)]
    chains.sort(key=lambda c: -sum(len(w) for w, _ in c))
    lengths = np.array([sum(len(w) for w, _ in c) for c in chains] or [0])
    steps = int(lengths.max()) if len(chains) else 0
    tokens, truth = np.full((steps, len(chains)), len(words)), np.full((steps, len(chains)), -1)
    for j, chain in enumerate(chains):
        tokens[: lengths[j], j] = [place[w] for ws, _ in chain for w in ws]
        truth[: lengths[j], j] = [label for ws, label in chain for _ in ws]
    weights, change = np.zeros((WEIGHTS, states)), np.zeros((states, states))
    power, turn = np.full_like(weights, 1e-6), np.full_like(change, 1e-6)
    wanted = np.zeros((len(words) + 1, states))
    inner = truth >= 0
    np.add.at(wanted, (tokens[inner], truth[inner]), 1)
    moves = np.zeros((states, states))
    both = inner[1:] & inner[:-1]
    np.add.at(moves, (truth[:-1][both], truth[1:][both]), 1)
    total = max(1, int(inner.sum()))
    for _ in range(rounds if len(chains) and states > 1 else 0):
        scores = np.zeros((len(words) + 1, states))
        for k in range(states):
            scores[:-1, k] = np.bincount(owner, weights[flat, k], minlength=len(words))
        scores -= scores.max(1, keepdims=True)
        chance, pairs = _forward_backward(np.exp(scores)[tokens], lengths, np.exp(change), count_moves=True)
        got = np.stack([np.bincount(tokens.ravel(), chance[:, :, k].ravel(), minlength=len(words) + 1) for k in range(states)], 1)
        gap = (wanted - got)[:-1] / total
        slope = np.stack([np.bincount(flat, gap[owner, k], minlength=WEIGHTS) for k in range(states)], 1) - 1e-7 * weights
        power += slope**2
        weights += 0.3 * slope / np.sqrt(power)
        slope = (moves - pairs) / total - 1e-5 * change
        turn += slope**2
        change += 0.3 * slope / np.sqrt(turn)
    return Field(languages, weights.astype(np.float32), change.astype(np.float32), lexicon)


def train(docs: DataFrame, usable: Column, per_language: int = DOCS_PER_LANGUAGE) -> Field:
    """Fit on about ``per_language`` texts of each language among the ``usable`` rows, drawn by a hash of text and id."""
    rows = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Field([], np.zeros((WEIGHTS, 0), np.float32), np.zeros((0, 0), np.float32), {})
    rate = F.create_map([F.lit(x) for name, n in sorted(sizes.items()) for x in (name, per_language / n)])
    draw = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.filter(draw < rate[F.col("lang")]).select("lang", "text", draw.alias("draw"))
    # Only windows travel to the driver: a text of one window is its own window there.
    cut = F.pandas_udf(lambda texts: texts.map(lambda t: " ".join(training_window(t))), "string")
    sample = drawn.withColumn("text", cut("text")).orderBy("draw", "lang", "text").limit(2 * per_language * len(sizes)).collect()
    return fit([r["text"] for r in sample], [r["lang"] for r in sample])


class _Tagger:
    def __init__(self, field: Field):
        self.field, self.places = field, {}
        self.scores = np.zeros((1024, len(field.languages)), np.float32)
        self.letters = np.zeros(1024, bool)

    def _look_up(self, words: list[str]) -> list[int]:
        if len(self.places) > CACHED_WORDS:
            self.__init__(self.field)
        places = self.places
        fresh = [w for w in dict.fromkeys(words) if w not in places]
        if fresh:
            base = len(places)
            places.update((w, base + i) for i, w in enumerate(fresh))
            end = base + len(fresh)
            if end > len(self.letters):
                more = max(end, 2 * len(self.letters)) - len(self.letters)
                self.scores = np.concatenate([self.scores, np.zeros((more, self.scores.shape[1]), np.float32)])
                self.letters = np.concatenate([self.letters, np.zeros(more, bool)])
            self.scores[base:end] = self.field.word_scores(fresh)
            self.letters[base:end] = [has_letter(w) for w in fresh]
        return [places[w] for w in words]

    def means(self, texts: list[list[str]]) -> np.ndarray:
        """Mean probabilities of each text's words with a letter; all texts have words."""
        flat = self._look_up([w for t in texts for w in t])
        lengths = np.array([len(t) for t in texts])
        scores = self.scores[flat]
        scores = np.exp(scores - scores.max(1, keepdims=True))
        steps, states = int(lengths.max()), len(self.field.languages)
        at = np.repeat(np.arange(len(texts)), lengths)
        within = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        grid = np.ones((steps, len(texts), states), np.float32)
        grid[within, at] = np.maximum(scores, 1e-12)
        chance, _ = _forward_backward(grid, lengths, np.exp(self.field.change))
        counted = self.letters[flat]
        words = chance[within[counted], at[counted]]
        sums = np.stack([np.bincount(at[counted], words[:, k], minlength=len(texts)) for k in range(states)], 1)
        return sums / np.maximum(np.bincount(at[counted], minlength=len(texts)), 1)[:, None]


def _tag(texts: list[str | None], tagger: _Tagger) -> tuple[list[str], list[float]]:
    languages, sure = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    words = {i: t.split() for i, t in enumerate(texts) if t and has_letter(t)}
    if not tagger.field.languages:
        return languages, sure
    order = sorted(words, key=lambda i: len(words[i]))
    while order:
        some, steps = [], len(words[order[-1]])
        while order and (not some or (len(some) + 1) * steps <= CELLS):
            some.append(order.pop())
        means = tagger.means([words[i] for i in some])
        for i, row in zip(some, means, strict=True):
            languages[i], sure[i] = tagger.field.languages[int(row.argmax())], float(min(1.0, row.max()))
    return languages, sure


def identify(spark: SparkSession, docs: DataFrame, field: Field, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to the ``keep`` columns of every document.

    ``lang_pred`` is a language of the field, or ``und`` with score 0 where the text is null, has no letter, or nothing
    was learned. The score is the mean probability of that language over the words with a letter. Equal means go to the
    language that sorts first; rows are independent, so repeated rows and null ids are like others.
    """
    shared = spark.sparkContext.broadcast(field)
    asked = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = ", ".join(f"`{c}` {asked.schema[c].dataType.simpleString()}" for c in keep) + ", lang_pred string, score double"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = _Tagger(shared.value)
        for rows in B.gathered(batches, "text", SLICE_BYTES):
            languages, sure = _tag(rows.column("text").to_pylist(), tagger)
            out = {c: rows.column(c) for c in keep}
            out |= {"lang_pred": pa.array(languages, pa.string()), "score": pa.array(sure, pa.float64())}
            yield from pa.table(out).combine_chunks().to_batches()

    return asked.mapInArrow(scan, schema)


def keep_identified(spark: SparkSession, docs: DataFrame, field: Field, min_score: float = 0.0) -> DataFrame:
    """Documents that have a language with at least ``min_score``, with all their columns."""
    shared = spark.sparkContext.broadcast(field)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = _Tagger(shared.value)
        for rows in B.gathered(batches, "text", SLICE_BYTES):
            languages, sure = _tag(rows.column("text").to_pylist(), tagger)
            keep = [name != UNDETERMINED and s >= min_score for name, s in zip(languages, sure, strict=True)]
            yield from rows.filter(pa.array(keep, pa.bool_())).combine_chunks().to_batches()

    return docs.mapInArrow(scan, docs.schema)
