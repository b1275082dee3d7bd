import sys

from conftest import rows
from pyspark.sql import functions as F

from minewright.functions.keys import fnv1a, shard_of
from minewright.functions.text import is_latin_alpha_word, is_number_token, tokenize
from minewright.operators import words as ops

TEXTS = [(0, "The cat. the CAT-the!"), (1, "the dog 12 dog"), (2, ""), (3, "cat the")]


def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id bigint, text string")


def test_word_count_is_case_sensitive(spark):
    counts = dict(rows(ops.word_count(docs(spark)), "word", "cnt"))
    assert counts == {"The": 1, "cat": 2, "the": 4, "CAT": 1, "dog": 2}
    top = [(r["word"], r["cnt"]) for r in ops.top_words(ops.word_count(docs(spark)), 2).collect()]
    assert top == [("cat", 2), ("the", 4)]


def test_index_segments_hold_every_document(spark, no_broadcast):
    index = ops.inverted_index(docs(spark), F.floor(F.col("doc") / 2))
    assert rows(index.filter(F.col("word") == "the"), "segment", "n_docs", "docs") == [(0, 3, "0,1"), (1, 3, "3")]
    lines = ops.index_lines(ops.inverted_index(docs(spark), F.lit(0)))
    assert "the: 3 0,1,3" in [r["line"] for r in lines.collect()]


def test_rank_postings_drops_one_count(spark):
    frequencies = ops.document_frequency(docs(spark))
    assert [r["word"] for r in ops.rank_postings(frequencies, 1).collect()] == ["the"]
    assert [r["word"] for r in ops.rank_postings(frequencies, 1, dropped_count=3).collect()] == ["cat"]


def test_map_reduce_with_few_salts_and_small_buffers(spark):
    many = spark.createDataFrame([(i, "a b a") for i in range(500)], "doc_id bigint, text string").repartition(7)
    emit = lambda doc, text: ((t, "1") for t in text.split())
    add = lambda key, values: str(sum(map(int, values)))
    for combine in (add, None):
        got = ops.map_reduce(many, emit, add, combine_fn=combine, salts=2, buffered_pairs=11)
        assert rows(got, "key", "value") == [("a", "1000"), ("b", "500")]


def test_map_reduce_calls_reduce_once_a_key_with_all_values(spark):
    many = spark.createDataFrame([(i, "a b a") for i in range(500)], "doc_id bigint, text string").repartition(7)
    emit = lambda doc, text: ((t, "1") for t in text.split())
    got = ops.map_reduce(many, emit, lambda key, values: str(len(list(values))), buffered_pairs=11)
    assert rows(got, "key", "value") == [("a", "1000"), ("b", "500")]
    assert ops.map_reduce(many.limit(0), emit, lambda key, values: "x").count() == 0


def test_map_reduce_from_sql(spark):
    many = [(i, "a b a") for i in range(100)] + [(None, "n"), (7, None), (8, "")]
    emit = lambda doc, text: ((None if t == "n" else t, doc or "-") for t in (text or "").split())
    ops.register_map_reduce(spark, "t", emit, list, lambda held, v: [*held, v], lambda key, held: f"{key} {len(held)} {min(held)}")
    docs_ = spark.createDataFrame(many, "doc_id bigint, text string").repartition(5)
    pairs = "SELECT m.key, m.value FROM {docs} d, LATERAL t_map(string(d.doc_id), d.text) m"
    got = spark.sql(f"SELECT * FROM t_reduce(TABLE({pairs}) PARTITION BY key)", docs=docs_)
    assert sorted(r["value"] for r in got.collect()) == ["None 1 -", "a 200 0", "b 100 0"]
    empty = spark.sql(f"SELECT * FROM t_reduce(TABLE({pairs}) PARTITION BY key)", docs=docs_.limit(0))
    assert empty.collect() == []


def test_map_reduce_ships_values_of_a_key_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(ops, "PIECE_VALUES", 2)
    many = spark.createDataFrame([(i, "a b a n" if i % 2 else "b") for i in range(60)], "doc_id bigint, text string").repartition(3)
    emit = lambda doc, text: ((None if t == "n" else t, None if t == "b" else doc) for t in text.split())
    most = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        got = ops.map_reduce(many, emit, lambda key, values: ",".join(sorted(v or "-" for v in values)), buffered_pairs=50)
        found = {r["key"]: r["value"].split(",") for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
    odd = [str(i) for i in range(1, 60, 2)]
    assert found == {"a": sorted(odd * 2), "b": ["-"] * 60, None: sorted(odd)}


def test_map_reduce_from_sql_folds_lists_of_values(spark):
    ops.register_map_reduce(spark, "l", lambda doc, text: [], list, lambda held, v: [*held, v or "-"], lambda key, held: " ".join(sorted(held)))
    rows_ = "VALUES ('a', array('1', null)), ('b', array('2')), ('a', array('3')), (null, array())"
    got = spark.sql(f"SELECT * FROM l_reduce(TABLE(SELECT * FROM {rows_} t(key, value)) PARTITION BY key)").collect()
    assert {r["key"]: r["value"] for r in got} == {"a": "- 1 3", "b": "2", None: ""}


def test_hash_and_shard(spark):
    df = spark.createDataFrame([("",), ("a",), ("foobar",), ("é",)], "k string")
    got = {r["k"]: (r["h"], r["s"]) for r in df.select("k", fnv1a(F.col("k")).alias("h"), shard_of(F.col("k")).alias("s")).collect()}
    assert got[""] == (0x811C9DC5, 0)
    assert got["a"] == (0xE40C292C, 97 % 10)
    assert got["foobar"][0] == 0xBF9CF968
    assert got["é"][1] == 0xC3 % 10


def test_token_pattern(spark):
    text = "U.S.A. costs 12.5% (don't) state-of-the-art ... <x> naïve"
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(tokenize(F.col("t")).alias("x")).collect()[0]["x"]
    words = ["U.S.A.", "costs", "12.5%", "(", "don't", ")", "state-of-the-art", "...", "<", "x", ">", "naïve"]
    assert got == words


def test_digit_classes(spark):
    df = spark.createDataFrame([("12",), ("１２",), ("²",), ("1a",), ("",), ("ab",)], "w string")
    got = {r["w"]: (r["n"], r["l"]) for r in df.select("w", is_number_token(F.col("w")).alias("n"), is_latin_alpha_word(F.col("w")).alias("l")).collect()}
    assert [got[w][0] for w in ("12", "１２", "²", "1a", "")] == [True, True, True, False, False]
    assert got[""][1] and got["ab"][1] and not got["1a"][1]


def test_number_tokens_are_all_digit_characters(spark):
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c,) for c in points if c.isdigit() or c.isnumeric() or c.isalpha() and ord(c) < 0x3000], "c string")
    found = {r["c"] for r in df.filter(is_number_token(F.col("c"))).collect()}
    assert found == {c for c in points if c.isdigit()}
