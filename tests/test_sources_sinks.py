import pytest
from conftest import rows
from pyspark.sql import functions as F

from minewright import sinks, sources


def lines_of(spark, path):
    """Lines of a written text folder in file order."""
    import glob

    return [line.rstrip("\n") for f in sorted(glob.glob(f"{path}/part-*")) for line in open(f, encoding="utf-8")]


@pytest.fixture
def text(tmp_path):
    def write(content, name="in.txt"):
        path = tmp_path / name
        path.write_text(content, encoding="utf-8")
        return str(path)

    return write


def test_transactions(spark, text):
    df = sources.read_transactions(spark, text("3 1 2\n5 5 1\n"))
    assert rows(df, "txn_id", "items") == [(0, [1, 2, 3]), (1, [1, 5])]


def test_labelled_csv(spark, text):
    df = sources.read_labelled_csv(spark, text("0.5,1.5,2\n-1,3,0\n"))
    assert rows(df, "id", "features", "label") == [(0, [0.5, 1.5], 2), (1, [-1.0, 3.0], 0)]


def test_tagged_corpus(spark, text):
    path = text("a/O b/B-X\n\nc/I-X bad d/e/f\n g/O \n")
    good, bad = sources.read_tagged_corpus(spark, path)
    assert rows(good, "sent_id", "words", "tags") == [(0, ["a", "b"], ["O", "B-X"]), (1, ["c"], ["I-X"]), (2, ["g"], ["O"])]
    assert rows(bad, "sent_id", "pos", "token") == [(1, 1, "bad"), (1, 2, "d/e/f")]
    kept, _ = sources.read_tagged_corpus(spark, path, keep_empty=True, max_sentences=2, processing_word=F.upper)
    assert rows(kept, "sent_id", "words") == [(0, ["A", "B"]), (1, [])]


def test_documents(spark, tmp_path):
    for name, content in (("b.txt", "one\ntwo\n"), ("a.txt", "three\n")):
        (tmp_path / name).write_text(content)
    whole = sources.read_documents(spark, str(tmp_path), whole_files=True)
    assert rows(whole, "doc_id", "text") == [("a.txt", "three\n"), ("b.txt", "one\ntwo\n")]
    assert rows(sources.read_documents(spark, str(tmp_path)), "doc_id", "text") == [(0, "three"), (1, "one"), (2, "two")]


def test_vectors_and_vocab(spark, text):
    df = sources.read_word_vectors(spark, text("2 2\na 1 2\nb 3\nc 5 6 \n"), 2)
    assert rows(df, "line_no", "word", "vec") == [(1, "a", [1.0, 2.0]), (3, "c", [5.0, 6.0])]
    assert dict(rows(sources.read_vocab(spark, text("x\ny\nx\n", "v.txt")), "word", "id")) == {"x": 2, "y": 1}
    assert rows(sources.read_sentences(spark, text("a  b\nc\n", "s.txt")), "tokens") == [(["a", "b"],), (["c"],)]


def test_line_order_survives_file_splits(spark, text):
    path = text("".join(f"w{i}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        vocab = dict(rows(sources.read_vocab(spark, path), "word", "id"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert vocab == {f"w{i}": i for i in range(3000)}


def test_text_sinks(spark, tmp_path):
    sets = spark.createDataFrame([([1], 2, 0.5), ([1, 2], 4, 1.0)], "items array<int>, cnt bigint, support double")
    for _ in range(2):
        sinks.write_itemsets(sets, f"{tmp_path}/sets")
    assert lines_of(spark, f"{tmp_path}/sets") == ["{1,2}\t1.0", "{1}\t0.5"]

    outputs = spark.createDataFrame([(0, "b", "1"), (1, "b", "2"), (0, "B", "3"), (0, "é", "4")], "part int, key string, value string")
    sinks.write_kv_sorted(outputs, f"{tmp_path}/kv")
    assert lines_of(spark, f"{tmp_path}/kv") == ["B: 3", "b: 2", "é: 4"]

    vocab = spark.createDataFrame([("z", 0), ("a", 1)], "word string, id bigint")
    sinks.write_vocab(vocab, f"{tmp_path}/vocab")
    assert lines_of(spark, f"{tmp_path}/vocab/lines") == ["z", "a"]

    tagged = spark.createDataFrame([(1, ["O"]), (0, ["B-X", "O"])], "sent_id bigint, tags array<string>")
    sinks.write_tag_lines(tagged, f"{tmp_path}/tags")
    assert lines_of(spark, f"{tmp_path}/tags") == ["B-X O", "O"]

    top = spark.createDataFrame([(0, 2, "b", 12.5), (0, 1, "a", 50.0), (1, 1, "c", 3.0)], "topic int, rank int, term string, pct double")
    sinks.write_topic_report(top, f"{tmp_path}/topics")
    assert lines_of(spark, f"{tmp_path}/topics") == ["Topic #0: a: 50.00% b: 12.50%", "Topic #1: c: 3.00%"]

    embeddings = spark.createDataFrame([("a", 0, [1.0])], "word string, id bigint, vec array<float>")
    sinks.write_embeddings(embeddings, f"{tmp_path}/emb")
    assert rows(sinks.read_embeddings(spark, f"{tmp_path}/emb"), "word", "vec") == [("a", [1.0])]
