"""Word queries over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from minewright.catalog.registry import ORACLE, documents, query, table
from minewright.operators import words as ops
from minewright.sinks import merge_sorted

SEGMENT = 256
SKEW_BUCKETS = 8
TOP = 10

_LETTERS = r"regexp_split_to_array(text, '[^\p{L}]+')"
_WORDS = f"w AS (SELECT doc_id, word FROM (SELECT doc_id, unnest({_LETTERS}) AS word FROM documents) WHERE word <> '')"
_SPACED = r"regexp_split_to_array(text, '\s+')"


def _segment():
    return F.floor(F.col("doc") / SEGMENT).cast("bigint")


@query(f"WITH {_WORDS} SELECT word, count(*) AS cnt FROM w GROUP BY word")
def word_count(spark, sf):
    return ops.word_count(documents(spark, sf))


@query(f"WITH {_WORDS} SELECT word, count(*) AS cnt FROM w GROUP BY word ORDER BY cnt DESC, word LIMIT {TOP}")
def top_words(spark, sf):
    return ops.top_words(ops.word_count(documents(spark, sf)), TOP)


@query(f"""
WITH {_WORDS}, d AS (SELECT DISTINCT word, doc_id FROM w),
n AS (SELECT word, count(*) AS n_docs FROM d GROUP BY word)
SELECT word, segment, n_docs, docs
FROM (SELECT word, doc_id // {SEGMENT} AS segment, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS docs
      FROM d GROUP BY ALL) JOIN n USING (word)
""")
def inverted_index(spark, sf):
    return ops.inverted_index(documents(spark, sf), _segment())


@query(f"WITH {_WORDS} SELECT word, count(DISTINCT doc_id) AS n_docs FROM w GROUP BY word")
def document_frequency(spark, sf):
    return ops.document_frequency(documents(spark, sf))


@query(f"""
WITH {_WORDS}, d AS (SELECT DISTINCT word, doc_id FROM w),
n AS (SELECT word, count(*) AS n_docs FROM d GROUP BY word HAVING count(*) <> 16
      ORDER BY n_docs DESC, word DESC LIMIT {TOP})
SELECT word, doc_id // {SEGMENT} AS segment, n_docs, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS docs
FROM d JOIN n USING (word) GROUP BY ALL
""")
def top_postings(spark, sf):
    return ops.top_postings(documents(spark, sf), _segment(), TOP, dropped_count=16)


@query(f"SELECT DISTINCT token FROM (SELECT unnest({_SPACED}) AS token FROM documents) WHERE token <> ''")
def distinct_tokens(spark, sf):
    return ops.distinct_tokens(documents(spark, sf))


def _emit_ones(doc, contents):
    for token in contents.split():
        yield token, "1"


def _add_up(key, values):
    return str(sum(map(int, values)))


@query(f"""
SELECT token AS key, count(*)::VARCHAR AS value
FROM (SELECT unnest({_SPACED}) AS token FROM documents) WHERE token <> '' GROUP BY token
""")
def map_reduce_wc(spark, sf):
    return ops.map_reduce(documents(spark, sf), _emit_ones, _add_up, combine_fn=_add_up)


def _emit_doc(doc, contents):
    for token in contents.split():
        yield token, doc


def _count_and_least(key, values):
    count, least = 0, None
    for value in values:
        count += 1
        least = value if least is None else min(least, value)
    return f"{count}:{least}"


@query(f"""
SELECT token AS key, count(*) || ':' || min(doc_id::VARCHAR) AS value
FROM (SELECT doc_id, unnest({_SPACED}) AS token FROM documents) WHERE token <> '' GROUP BY token
""")
def map_reduce_list(spark, sf):
    return ops.map_reduce(documents(spark, sf), _emit_doc, _count_and_least)


# Documents whose values of a key reach the fold in one row.
FOLDED_DOCS = 10_000


def _fold_least(state, value):
    count, least = state
    return count + 1, value if least is None else min(least, value)


@query(ORACLE["map_reduce_list"])
def map_reduce_sql(spark, sf):
    """The same job, called from SQL."""
    finish = lambda key, state: f"{state[0]}:{state[1]}"
    ops.register_map_reduce(spark, "words_of", _emit_doc, lambda: (0, None), _fold_least, finish)
    pairs = "SELECT m.key, m.value, d.doc_id FROM {docs} d, LATERAL words_of_map(string(d.doc_id), d.text) m"
    # Structs, as collect_list drops nulls; a list holds the values of a key in one range of documents.
    lists = (
        "SELECT key, transform(collect_list(struct(value AS v)), p -> p.v) AS value"
        f" FROM ({pairs}) GROUP BY key, doc_id DIV {FOLDED_DOCS}"
    )
    return spark.sql(
        f"SELECT key, value FROM words_of_reduce(TABLE({lists}) PARTITION BY key)", docs=documents(spark, sf)
    )


@query("""
WITH k AS (SELECT string_split(p_name, '') AS c FROM part)
SELECT CAST(list_reduce(
         list_prepend(2166136261::BIGINT, list_transform(c, lambda x: ascii(x)::BIGINT)),
         lambda h, b: (xor(h, b) * 16777619) % 4294967296) % 8 AS INTEGER) AS bucket, count(*) AS cnt
FROM k GROUP BY ALL
""")
def partition_skew(spark, sf):
    return ops.partition_skew(table(spark, sf, "part"), F.col("p_name"), SKEW_BUCKETS)


@query("""
SELECT c_mktsegment AS key, max_by(c_name, c_custkey) AS value FROM customer GROUP BY c_mktsegment
""")
def kv_merge_sorted(spark, sf):
    outputs = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("part"), F.col("c_mktsegment").alias("key"), F.col("c_name").alias("value")
    )
    return merge_sorted(outputs)
