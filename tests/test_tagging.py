import math
import random
from itertools import product

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from minewright.operators import corpus, tagging

TAGS = ["O", "B-A", "I-A", "O-A", "B-B", "I-B", "O-B"]


def walk_spans(tags):
    """Spans by a sequential reading of the rules: one open span at a time."""
    found, open_type, first, last = [], None, 0, 0
    for i, tag in enumerate(tags + ["O"]):
        head, kind = tag[0], tag[2:]
        if head == "I" and kind == open_type:
            last = i
            continue
        if open_type is not None:
            found.append((open_type, first, i if head == "O" and kind == open_type else last))
        open_type = None if head == "O" else kind
        first = last = i
    return found


def walk_chunks(tags):
    found, kind, first = [], None, 0
    for i, tag in enumerate(tags + ["O"]):
        new = None if tag == "O" else tag.split("-")[-1]
        if kind is not None and (new is None or new != kind or tag[0] == "B"):
            found.append((kind, first, i))
            kind = None
        if kind is None and new is not None:
            kind, first = new, i
    return found


@pytest.fixture(scope="module")
def sentences(spark):
    rng = random.Random(9)
    data = [(s, [rng.choice(TAGS) for _ in range(rng.randint(0, 12))]) for s in range(300)]
    data = [(s, tags, [t if rng.random() < 0.8 else rng.choice(TAGS) for t in tags]) for s, tags in data]
    return spark.createDataFrame(data, "sent_id bigint, tags array<string>, pred array<string>"), data


def test_spans_and_chunks_match_a_sequential_walk(sentences):
    df, data = sentences
    spans = sorted((s, *span) for s, tags, _ in data for span in walk_spans(tags))
    assert rows(tagging.tag_spans(df), "sent_id", "type", "start", "end") == spans
    chunks = sorted((s, *c) for s, tags, _ in data for c in walk_chunks(tags))
    assert rows(tagging.tag_chunks(df), "sent_id", "type", "start", "end") == chunks


@pytest.mark.parametrize(
    "tags,spans,chunks",
    [
        ("B-LOC I-LOC O-LOC O", [("LOC", 0, 2)], [("LOC", 0, 3)]),
        ("O I-PER I-LOC", [("PER", 1, 1), ("LOC", 2, 2)], [("PER", 1, 2), ("LOC", 2, 3)]),
        ("B-LOC O-LOC I-LOC", [("LOC", 0, 1), ("LOC", 2, 2)], [("LOC", 0, 3)]),
    ],
)
def test_ill_formed_runs(spark, tags, spans, chunks):
    df = spark.createDataFrame([(0, tags.split())], "sent_id bigint, tags array<string>")
    assert rows(tagging.tag_spans(df), "type", "start", "end") == sorted(spans)
    assert rows(tagging.tag_chunks(df), "type", "start", "end") == sorted(chunks)


def test_scores(sentences):
    df, data = sentences
    gold = {(s, x) for s, tags, _ in data for x in walk_spans(tags)}
    pred = {(s, x) for s, _, tags in data for x in walk_spans(tags)}
    overall = [r for r in tagging.span_f1(df).collect() if r["type"] == "overall"][0]
    assert (overall["tp"], overall["fp"], overall["fn"]) == (len(gold & pred), len(pred - gold), len(gold - pred))
    p, r = len(gold & pred) / len(pred), len(gold & pred) / len(gold)
    assert abs(overall["f1"] - 2 * p * r / (p + r)) < 1e-9
    got = tagging.token_accuracy_chunk_f1(df).collect()[0]
    equal = [a == b for _, g, q in data for a, b in zip(g, q)]
    assert abs(got["acc"] - 100 * sum(equal) / len(equal)) < 1e-9


def test_no_right_chunk_gives_zero(spark):
    df = spark.createDataFrame([(0, ["O", "B-A"], ["B-A", "O"])], "sent_id int, tags array<string>, pred array<string>")
    assert tagging.token_accuracy_chunk_f1(df).collect()[0]["f1"] == 0.0


def test_invalid_tags_and_date_rule(spark):
    df = spark.createDataFrame([(0, ["2018年", "x年", "５日"], ["O", "X-A", "I-A"])], "sent_id int, words array<string>, tags array<string>")
    assert rows(tagging.invalid_tags(df), "pos", "tag") == [(1, "X-A")]
    assert tagging.time_override(df).collect()[0]["tags"] == ["B-TIME", "X-A", "B-TIME"]


def test_viterbi_matches_enumeration(spark):
    rng = np.random.default_rng(3)
    tags, transitions = ["a", "b", "c"], rng.normal(size=(3, 3))
    scores = rng.normal(size=(4, 5, 3))
    lengths = [5, 3, 1, 4]
    data = [(s, p, [float(x) for x in scores[s, p]]) for s in range(4) for p in range(lengths[s])]
    df = spark.createDataFrame(data, "sent_id bigint, pos int, scores array<double>").repartition(3)
    got = dict(rows(tagging.viterbi_decode(df, transitions, tags), "sent_id", "tags"))
    for s in range(4):
        def total(path):
            return sum(scores[s, i, t] for i, t in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:]))
        best = max(product(range(3), repeat=lengths[s]), key=total)
        assert got[s] == [tags[t] for t in best]
    top = rows(tagging.argmax_tags(df, tags), "sent_id", "pos", "tag")
    assert top == [(s, p, tags[int(scores[s, p].argmax())]) for s in range(4) for p in range(lengths[s])]


def test_transition_and_emission_scores(spark):
    df = spark.createDataFrame([(0, ["x", "y", "x"], ["O", "B", "O"]), (1, ["x"], ["O"]), (2, [], [])], "sent_id int, words array<string>, tags array<string>")
    counts = tagging.transition_counts(df)
    assert rows(counts, "tag", "next_tag", "cnt") == [("B", "O", 1), ("O", "B", 1)]
    assert np.allclose(np.exp(tagging.transition_matrix(counts, ["B", "O"])), [[1 / 3, 2 / 3], [2 / 3, 1 / 3]])
    scores = dict(rows(tagging.emission_scores(tagging.emission_counts(df), ["B", "O"]), "word", "scores"))
    assert np.allclose(scores["x"], [math.log(1 / 4), math.log(4 / 6)])


def words_frame(spark):
    data = [(0, ["b", "a", "12"]), (1, ["é", "a"]), (2, ["ü", "é", "ñ"])]
    return spark.createDataFrame(data, "sent_id bigint, words array<string>")


def test_min_count_vocab_and_encoding(spark, no_broadcast):
    sents = words_frame(spark)
    vocab = corpus.min_count_vocab(sents, 2)
    assert dict(rows(vocab, "word", "id")) == {"<PAD>": 0, "<ENG>": 1, "<NUM>": 2, "é": 3, "<UNK>": 4}
    encoded = corpus.encode_words(corpus.word_rows(sents), vocab)
    assert rows(encoded.filter("sent_id = 2"), "pos", "id") == [(0, 4), (1, 3), (2, 4)]
    with pytest.raises(Exception, match="not in the vocabulary"):
        corpus.encode_words(corpus.word_rows(sents), vocab, unk=None).collect()


def test_embeddings(spark):
    vocab = spark.createDataFrame([("a", 0), ("q", 1)], "word string, id bigint")
    vectors = spark.createDataFrame([(0, "a", [1.0, 2.0]), (5, "a", [3.0, 4.0]), (6, "z", [9.0, 9.0])], "line_no bigint, word string, vec array<float>")
    assert rows(corpus.trim_embeddings(vocab, vectors, 2), "word", "vec", "found") == [("a", [3.0, 4.0], True), ("q", [0.0, 0.0], False)]
    random_vectors = corpus.random_embeddings(vocab, 50).collect()
    assert all(-0.25 <= x < 0.25 for r in random_vectors for x in r["vec"])
    assert random_vectors == corpus.random_embeddings(vocab.repartition(3), 50).orderBy("id").collect()


def test_padding(spark):
    data = [(0, [1, 2, 3], 0), (1, [4], 0), (2, [], 1)]
    padded = corpus.pad_sequences(spark.createDataFrame(data, "sent_id int, ids array<int>, batch int"), pad=9)
    assert rows(padded, "sent_id", "ids", "length") == [(0, [1, 2, 3], 3), (1, [4, 9, 9], 1), (2, [], 0)]
    nested = [(0, [[1, 2], [3]], 0), (1, [[4, 5, 6]], 0)]
    padded = corpus.pad_nested(spark.createDataFrame(nested, "sent_id int, char_ids array<array<int>>, batch int"))
    assert rows(padded, "sent_id", "char_ids", "lengths") == [(0, [[1, 2, 0], [3, 0, 0]], [2, 1]), (1, [[4, 5, 6], [0, 0, 0]], [3, 0])]


def test_batches_and_chars(spark):
    batched = corpus.batch_ids(spark.range(10, 17).select(F.col("id").alias("sent_id")), 3)
    assert rows(batched, "sent_id", "batch") == [(10 + i, i // 3) for i in range(7)]
    chars = spark.createDataFrame([("a", 0), ("b", 1)], "char string, id bigint")
    encoded = corpus.encode_chars(spark.createDataFrame([(0, 0, "bab"), (0, 1, "xax"), (0, 2, "zz")], "sent_id int, pos int, word string"), chars)
    assert rows(encoded, "pos", "char_ids") == [(0, [1, 0, 1]), (1, [0]), (2, [])]
    good, bad = corpus.encode_tags(spark.createDataFrame([(0, "O"), (1, "Z")], "pos int, tag string"), spark.createDataFrame([("O", 5)], "tag string, id int"))
    assert rows(good, "pos", "tag_id") == [(0, 5)] and rows(bad, "pos", "tag") == [(1, "Z")]


def test_invalid_tags_make_no_spans(spark):
    from minewright.operators.tagging import span_array

    row = spark.createDataFrame([(["B-PER", "X-PER", "B-LOC", "O"],)], "tags array<string>").select(span_array("tags")).first()[0]
    assert [tuple(s) for s in row] == [("PER", 0, 0), ("LOC", 2, 2)]


def test_sentences_without_tokens_stay(spark, no_broadcast):
    data = [(0, ["a", "b"]), (1, []), (2, None), (3, ["c"]), (4, []), (5, ["a"])]
    sentences = spark.createDataFrame(data, "sent_id bigint, words array<string>")
    words = corpus.every_word_rows(sentences)
    vocab = spark.createDataFrame([("a", 1), ("b", 2), ("<UNK>", 3)], "word string, id bigint")
    ids = corpus.gather_tokens(corpus.encode_words(words, vocab, "<UNK>"), "id", "ids")
    assert rows(ids, "sent_id", "ids") == [(0, [1, 2]), (1, []), (2, []), (3, [3]), (4, []), (5, [1])]
    known = vocab.union(spark.createDataFrame([("c", 4)], vocab.schema))
    strict = corpus.gather_tokens(corpus.encode_words(words, known, None), "id", "ids")
    assert rows(strict, "sent_id", "ids")[3] == (3, [4])
    with pytest.raises(Exception, match="not in the vocabulary"):
        corpus.encode_words(words, vocab, None).collect()
    padded = corpus.pad_sequences(corpus.batch_ids(ids, 2))
    assert rows(padded, "sent_id", "batch", "ids", "length") == [
        (0, 0, [1, 2], 2), (1, 0, [0, 0], 0), (2, 1, [0], 0), (3, 1, [3], 1), (4, 2, [0], 0), (5, 2, [1], 1),
    ]
    letters = spark.createDataFrame([("a", 7), ("c", 9)], "char string, id bigint")
    spelled = corpus.gather_tokens(corpus.encode_chars(words, letters), "char_ids", "char_ids")
    assert rows(spelled, "sent_id", "char_ids")[:4] == [(0, [[7], []]), (1, []), (2, []), (3, [[9]])]
    nested = corpus.pad_nested(corpus.batch_ids(spelled, 3))
    assert rows(nested, "sent_id", "char_ids")[:2] == [(0, [[7], [0]]), (1, [[0], [0]])]
    tagged = sentences.select("sent_id", F.posexplode_outer(F.transform("words", lambda w: F.lit("O"))).alias("pos", "tag"))
    tags = spark.createDataFrame([("O", 5)], "tag string, id bigint")
    encoded, rejected = corpus.encode_tags(tagged, tags)
    assert rows(corpus.gather_tokens(encoded, "tag_id", "ids"), "sent_id", "ids") == [(0, [5, 5]), (1, []), (2, []), (3, [5]), (4, []), (5, [5])]
    assert rejected.count() == 0
    scores = spark.createDataFrame([("a", [0.0, 1.0]), ("b", [2.0, 0.0])], "word string, scores array<double>")
    paths = tagging.viterbi_decode(tagging.score_tokens(words, scores, ["X", "Y"]), np.zeros((2, 2)), ["X", "Y"])
    assert rows(paths, "sent_id", "tags") == [(0, ["Y", "X"]), (1, []), (2, []), (3, ["X"]), (4, []), (5, ["Y"])]


def test_characters_are_encoded_in_place(spark, no_broadcast):
    words = spark.createDataFrame([(0, 0, "bäb"), (0, 1, None), (1, 0, "a𝄞")], "sent_id int, pos int, word string")
    chars = spark.createDataFrame([("a", 4), ("b", 5), ("b", 3), ("𝄞", 9), (None, 7)], "char string, id bigint")
    encoded = corpus.encode_chars(words, chars)
    assert rows(encoded, "sent_id", "pos", "char_ids") == [(0, 0, [3, 5, 3, 5]), (0, 1, []), (1, 0, [4, 9])]
    plan = encoded._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


@pytest.mark.parametrize("copied", [True, False])
def test_packed_sentences_are_those_of_single_rows(spark, no_broadcast, monkeypatch, copied):
    rng = random.Random(4)
    texts = [(rng.randint(0, 25), ["".join(rng.choice("abcdü") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 9))]) for _ in range(60)]
    sentences = spark.createDataFrame([*texts, (None, ["a", "bb"]), (None, ["c"]), (99, None)], "sent_id bigint, words array<string>")
    letters = spark.createDataFrame([(c, i) for i, c in enumerate("abcü")], "char string, id bigint")
    found = corpus.encode_chars(corpus.every_word_rows(sentences), letters)
    for each in (found, found.repartition(3)):
        packed, plain = (corpus.gather_tokens(each, "char_ids", "char_ids", packed=p) for p in (True, False))
        opened = corpus.open_sentences(packed, "char_ids", "array<bigint>")
        assert sorted(map(str, opened.collect())) == sorted(map(str, plain.collect()))
        if not copied:
            monkeypatch.setattr(corpus, "BATCH_SIZES_BYTES", -1)
        padded = [corpus.pad_nested(corpus.batch_ids(s, 4), pad=-1).select("sent_id", "batch", "char_ids", "lengths") for s in (packed, plain)]
        assert sorted(map(str, padded[0].collect())) == sorted(map(str, padded[1].collect()))
        assert "windowspecdefinition(batch" not in padded[0]._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("held", [1 << 20, 80, 0])
def test_sentences_are_scored_and_decoded_whole(spark, no_broadcast, monkeypatch, held):
    monkeypatch.setattr(tagging, "HELD_BYTES", held)
    monkeypatch.setattr(tagging, "BLOCK_TOKENS", 40)
    rng = random.Random(6)
    data = [(rng.randint(0, 30), [f"w{min(rng.randint(0, 30), rng.randint(0, 30))}" for _ in range(rng.randint(0, 15))]) for _ in range(70)]
    data += [(40, []), (41, None), (None, ["w1", "new"]), (None, ["w2"])]
    sentences = spark.createDataFrame(data, "sent_id bigint, words array<string>")
    scores = spark.createDataFrame([(f"w{i}", [rng.random() + (i < 9) for _ in range(3)]) for i in range(28)], "word string, scores array<double>")
    transitions = np.random.default_rng(2).normal(size=(3, 3))
    rows_of = corpus.every_word_rows(sentences)
    scored = [tagging.score_tokens(rows_of, scores, ["X", "Y", "Z"], by_sentence=s) for s in (False, True)]
    paths = [tagging.viterbi_decode(s, transitions, ["X", "Y", "Z"]) for s in (*scored, scored[1].select("sent_id", "scores"))]
    wanted = sorted(map(str, paths[0].collect()))
    assert all(sorted(map(str, path.collect())) == wanted for path in paths[1:])


def test_wide_steps_decode_like_narrow_ones(monkeypatch):
    rng = np.random.default_rng(1)
    scores, transitions = [rng.integers(0, 3, (n, 4)).astype(float) for n in rng.integers(0, 9, 60)], rng.integers(0, 2, (4, 4)).astype(float)
    wide = tagging.best_paths(scores, transitions)
    monkeypatch.setattr(tagging, "WIDE_STEP", 1000)
    assert all((a == b).all() for a, b in zip(wide, tagging.best_paths(scores, transitions), strict=True))
