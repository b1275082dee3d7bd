"""Tagged-corpus queries. The sentences are the documents' whitespace tokens, with a gold and a predicted tag that two
fixed rules give every token by document and position, so that all tag shapes and ill-formed runs occur."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.catalog.registry import documents, query, table
from minewright.functions.text import (
    is_ascii_word,
    is_latin_alpha_word,
    is_number_token,
    keep_token,
    normalize_mixed_word,
    normalize_word,
    whitespace_tokens,
)
from minewright.operators import corpus, tagging
from minewright.plans.spread import unnested
from minewright.sinks import tag_lines as tag_line_layout

# Tags by (5 * sentence + position) modulo 16; the prediction differs where (7 * position + sentence) % 11 = 0.
TAG_CYCLE = [
    "O", "B-PERSON", "I-PERSON", "O-PERSON", "O", "B-LOCATION", "O-LOCATION", "I-LOCATION",
    "I-ORGANIZATION", "O", "B-TIME", "I-TIME", "I-LOCATION", "B-LOCATION", "O-ORGANIZATION", "O",
]
STOPWORDS = ["the", "of", "and", "to", "in", "is", "that", "it", "as", "with", "by", "on", "are", "for", "be"]
BATCH = 32
MIN_COUNT = 3
DIM = 16
SEED = 7


def _tag_at(sent, pos, shift=0):
    cycle = F.array(*[F.lit(t) for t in TAG_CYCLE])
    return F.get(cycle, F.pmod(sent * 5 + pos + shift, F.lit(16)).cast("int"))


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select(
        F.col("doc_id").alias("sent_id"), whitespace_tokens(F.col("text")).alias("words")
    )
    sent = F.col("sent_id")
    gold = F.transform("words", lambda w, i: _tag_at(sent, i))
    pred = F.transform(
        "words",
        lambda w, i: F.when(F.pmod(i * 7 + sent, F.lit(11)) == 0, _tag_at(sent, i, 3)).otherwise(_tag_at(sent, i)),
    )
    return docs.withColumn("tags", gold).withColumn("pred", pred)


def words_only(spark: SparkSession, sf: str) -> DataFrame:
    return sentences(spark, sf).select("sent_id", "words")


_LIST = "[" + ", ".join(f"'{t}'" for t in TAG_CYCLE) + "]"
_TOK = r"""tok AS (
  SELECT sent_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos
  FROM (SELECT doc_id AS sent_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w
        FROM documents))"""
_TAGGED = f"""{_TOK},
tagged AS (
  SELECT sent_id, pos, word, {_LIST}[(sent_id * 5 + pos) % 16 + 1] AS tag,
    CASE WHEN (pos * 7 + sent_id) % 11 = 0 THEN {_LIST}[(sent_id * 5 + pos + 3) % 16 + 1]
         ELSE {_LIST}[(sent_id * 5 + pos) % 16 + 1] END AS pred
  FROM tok)"""


def _spans_sql(name: str, tag: str) -> str:
    """CTEs ending in ``name``: (sent_id, type, start, end) of B / I / O spans by windows over token rows."""
    return f"""
{name}_a AS (
  SELECT sent_id, pos, substr({tag}, 1, 1) AS c, substr({tag}, 3) AS t,
    lag(substr({tag}, 1, 1)) OVER w AS pc, lag(substr({tag}, 3)) OVER w AS pt
  FROM tagged WINDOW w AS (PARTITION BY sent_id ORDER BY pos)),
{name}_b AS (
  SELECT *, coalesce(pc IN ('B', 'I') AND pt = t, FALSE) AS same,
    sum(CASE WHEN c = 'B' OR (c = 'I' AND NOT coalesce(pc IN ('B', 'I') AND pt = t, FALSE)) THEN 1 ELSE 0 END)
      OVER (PARTITION BY sent_id ORDER BY pos) AS g
  FROM {name}_a),
{name} AS (
  SELECT sent_id, min(t) AS type, min(pos) AS "start", max(pos) AS "end"
  FROM {name}_b WHERE c IN ('B', 'I') OR (c = 'O' AND same) GROUP BY sent_id, g)"""


def _chunks_sql(name: str, tag: str) -> str:
    return f"""
{name}_a AS (
  SELECT sent_id, pos, {tag} AS t, split_part({tag}, '-', 1) AS c, split_part({tag}, '-', -1) AS k,
    lag({tag}) OVER w AS p, lag(split_part({tag}, '-', -1)) OVER w AS pk
  FROM tagged WINDOW w AS (PARTITION BY sent_id ORDER BY pos)),
{name}_b AS (
  SELECT *, sum(CASE WHEN t <> 'O' AND (p IS NULL OR p = 'O' OR k <> pk OR c = 'B') THEN 1 ELSE 0 END)
      OVER (PARTITION BY sent_id ORDER BY pos) AS g
  FROM {name}_a),
{name} AS (
  SELECT sent_id, min(k) AS type, min(pos) AS "start", max(pos) + 1 AS "end"
  FROM {name}_b WHERE t <> 'O' GROUP BY sent_id, g)"""


# ---- tokens and vocabularies ----------------------------------------------------------------------------------------


@query(rf"""
WITH {_TOK}
SELECT NOT regexp_matches(word, '[^\x00-\x7F]') AS ascii, regexp_full_match(word, '[A-Za-z]*') AS latin,
  regexp_full_match(word, '\p{{Nd}}+') AS number, count(*) AS cnt
FROM tok GROUP BY ALL
""")
def token_class_counts(spark, sf):
    rows = corpus.word_rows(words_only(spark, sf))
    word = F.col("word")
    return rows.groupBy(
        is_ascii_word(word).alias("ascii"), is_latin_alpha_word(word).alias("latin"), is_number_token(word).alias("number")
    ).agg(F.count(F.lit(1)).alias("cnt"))


_STOP_LIST = "(" + ", ".join(f"'{w}'" for w in STOPWORDS) + ")"


@query(rf"""
WITH {_TOK}
SELECT word, count(*) AS cnt FROM tok
WHERE (length(word) <> 1 OR regexp_matches(word, '^\p{{L}}')) AND NOT regexp_matches(lower(word), '[^\x00-\x7F]')
  AND lower(word) NOT IN {_STOP_LIST}
GROUP BY word
""")
def clean_token_counts(spark, sf):
    rows = corpus.word_rows(words_only(spark, sf)).filter(keep_token(F.col("word"), STOPWORDS))
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


@query(rf"""
WITH {_TOK}
SELECT CASE WHEN regexp_full_match(lower(word), '\p{{Nd}}+') THEN '$NUM$' ELSE lower(word) END AS first_form,
  CASE WHEN regexp_full_match(word, '\p{{Nd}}+') THEN '<NUM>' WHEN regexp_full_match(word, '[A-Za-z]*') THEN '<ENG>'
       ELSE word END AS second_form, count(*) AS cnt
FROM tok GROUP BY ALL
""")
def normalized_words(spark, sf):
    word = F.col("word")
    rows = corpus.word_rows(words_only(spark, sf))
    return rows.groupBy(
        normalize_word(word, lowercase=True).alias("first_form"), normalize_mixed_word(word).alias("second_form")
    ).agg(F.count(F.lit(1)).alias("cnt"))


@query(f"""
WITH {_TAGGED}
SELECT DISTINCT 'word' AS kind, word AS entry FROM tagged
UNION ALL SELECT DISTINCT 'tag', t FROM (SELECT tag AS t FROM tagged UNION ALL SELECT pred FROM tagged)
""")
def word_tag_vocab(spark, sf):
    both = sentences(spark, sf)
    other = both.select("sent_id", "words", F.col("pred").alias("tags"))
    words, tags = corpus.vocabs([both, other])
    return words.select(F.lit("word").alias("kind"), F.col("word").alias("entry")).unionByName(
        tags.select(F.lit("tag").alias("kind"), F.col("tag").alias("entry"))
    )


@query(f"WITH {_TOK} SELECT DISTINCT unnest(string_split(word, '')) AS char FROM tok")
def char_vocab(spark, sf):
    return corpus.char_vocab(words_only(spark, sf))


_VECTOR_WORDS = r"""vw AS (
  SELECT DISTINCT x AS word FROM (
    SELECT unnest(regexp_split_to_array(text, '\s+')) AS x FROM conversations
    UNION ALL SELECT unnest(regexp_split_to_array(text, '\s+')) FROM benchmark) WHERE x <> '')"""


def vector_words(spark: SparkSession, sf: str) -> DataFrame:
    """Words of two other tables, standing for those that have a vector."""
    texts = table(spark, sf, "conversations").select("text").unionByName(table(spark, sf, "benchmark").select("text"))
    return texts.select(F.explode(F.array_distinct(whitespace_tokens(F.col("text")))).alias("word")).distinct()


@query(f"""
WITH {_TOK}, {_VECTOR_WORDS}
SELECT DISTINCT word FROM (SELECT word FROM tok INTERSECT SELECT word FROM vw)
UNION SELECT unnest(['$UNK$', '$NUM$'])
""")
def vocab_intersect(spark, sf):
    words = corpus.word_rows(words_only(spark, sf)).select("word").distinct()
    return corpus.vocab_intersect(words, vector_words(spark, sf))


_MIN_COUNT_VOCAB = rf"""
mixed AS (
  SELECT sent_id, pos, CASE WHEN regexp_full_match(word, '\p{{Nd}}+') THEN '<NUM>'
    WHEN regexp_full_match(word, '[A-Za-z]*') THEN '<ENG>' ELSE word END AS word FROM tok),
kept AS (
  SELECT word, min((sent_id, pos)) AS f FROM mixed GROUP BY word
  HAVING count(*) >= {MIN_COUNT} OR word IN ('<NUM>', '<ENG>')),
numbered AS (SELECT word, row_number() OVER (ORDER BY f) AS id FROM kept),
vocab AS (
  SELECT word, id FROM numbered UNION ALL SELECT '<UNK>', max(id) + 1 FROM numbered UNION ALL SELECT '<PAD>', 0)"""


@query(f"WITH {_TOK}, {_MIN_COUNT_VOCAB} SELECT word, id::BIGINT AS id FROM vocab")
def min_count_vocab(spark, sf):
    return corpus.min_count_vocab(words_only(spark, sf), MIN_COUNT)


# ---- embeddings -----------------------------------------------------------------------------------------------------


@query(f"""
WITH {_TOK},
lines AS (SELECT word, vec_id, embedding FROM embeddings JOIN tok ON sent_id = vec_id AND pos = 0),
last AS (SELECT word, max_by(embedding, vec_id) AS vec FROM lines GROUP BY word),
t AS (SELECT DISTINCT word FROM tok)
SELECT t.word, round(coalesce(list_sum(vec::DOUBLE[]), 0), 6) AS total, coalesce(len(vec), 64)::BIGINT AS dim,
  vec IS NOT NULL AS found
FROM t LEFT JOIN last USING (word)
""")
def embedding_lookup(spark, sf):
    """Vectors for all words of the texts; a line's word is the first one of the document of its number."""
    words = words_only(spark, sf)
    firsts = words.select(F.col("sent_id").alias("line_no"), F.get("words", F.lit(0)).alias("word")).filter("word is not null")
    lines = table(spark, sf, "embeddings").select(F.col("vec_id").alias("line_no"), F.col("embedding").alias("vec"))
    vectors = lines.join(firsts, "line_no")
    vocab = corpus.number_vocab(corpus.word_rows(words).select("word"))
    total = F.aggregate(F.col("vec").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return corpus.trim_embeddings(vocab, vectors, 64).select(
        "word", F.round(total, 6).alias("total"), F.size("vec").cast("bigint").alias("dim"), "found"
    )


@query(f"""
WITH {_TOK}, v AS (SELECT DISTINCT word FROM tok)
SELECT word, round(list_sum(list_transform(range(0, {DIM}), lambda j:
    (((('0x' || substr(md5(word || '|' || j || '|{SEED}'), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE) * 2.0::DOUBLE
      - 1.0::DOUBLE) * 0.25::DOUBLE)::FLOAT::DOUBLE)), 6) AS total
FROM v
""")
def random_embeddings(spark, sf):
    words = corpus.word_rows(words_only(spark, sf)).select("word").distinct().withColumn("id", F.lit(0))
    total = F.aggregate(F.col("vec").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return corpus.random_embeddings(words, DIM, SEED).select("word", F.round(total, 6).alias("total"))


# ---- encoding and batches -------------------------------------------------------------------------------------------


def _encoded(spark: SparkSession, sf: str) -> DataFrame:
    vocab = corpus.min_count_vocab(words_only(spark, sf), MIN_COUNT)
    rows = corpus.every_word_rows(words_only(spark, sf)).withColumn("word", normalize_mixed_word(F.col("word")))
    return corpus.encode_words(rows, vocab)


_ENCODED = """encoded AS (
  SELECT sent_id, pos, coalesce(v.id, (SELECT id FROM vocab WHERE word = '<UNK>')) AS id
  FROM mixed LEFT JOIN vocab v USING (word))"""


@query(f"""
WITH {_TOK}, {_MIN_COUNT_VOCAB}, {_ENCODED}
SELECT doc_id AS sent_id, coalesce(string_agg(id::VARCHAR, ' ' ORDER BY pos), '') AS ids
FROM documents LEFT JOIN encoded ON sent_id = doc_id GROUP BY doc_id
""")
def encoded_tokens(spark, sf):
    ids = corpus.gather_tokens(_encoded(spark, sf), "id", "ids")
    return ids.select("sent_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


@query(f"""
WITH {_TAGGED},
t AS (SELECT tag, row_number() OVER (ORDER BY tag) - 1 AS id FROM (SELECT DISTINCT tag FROM tagged))
SELECT doc_id AS sent_id, coalesce(string_agg(id::VARCHAR, ' ' ORDER BY pos), '') AS ids
FROM documents LEFT JOIN (tagged JOIN t USING (tag)) ON sent_id = doc_id GROUP BY doc_id
""")
def encoded_tags(spark, sf):
    both = sentences(spark, sf)
    tags = corpus.number_vocab(corpus.vocabs([both])[1], "tag")
    rows = both.select("sent_id", F.posexplode_outer("tags").alias("pos", "tag"))
    encoded, _ = corpus.encode_tags(rows, tags)
    ids = corpus.gather_tokens(encoded, "tag_id", "ids")
    return ids.select("sent_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


_CHARS = """
wc AS (SELECT word, unnest(c) AS char, generate_subscripts(c, 1) AS i
       FROM (SELECT DISTINCT word, string_split(word, '') AS c FROM tok)),
cv AS (SELECT char, row_number() OVER (ORDER BY char) - 1 AS id FROM (SELECT DISTINCT char FROM wc)),
ws AS (SELECT word, list(id ORDER BY i) AS ids FROM wc JOIN cv USING (char) GROUP BY word)"""


def _chars(spark: SparkSession, sf: str) -> DataFrame:
    """All characters of the corpus, numbered."""
    return corpus.number_vocab(corpus.char_vocab(words_only(spark, sf)), "char")


@query(f"WITH {_TOK}, {_CHARS} SELECT word, array_to_string(ids, ' ') AS char_ids FROM ws")
def encoded_chars(spark, sf):
    rows = corpus.word_rows(words_only(spark, sf)).select("word").distinct()
    encoded = corpus.encode_chars(rows, _chars(spark, sf))
    return encoded.select("word", F.array_join(F.col("char_ids").cast("array<string>"), " ").alias("char_ids"))


@query(f"""
SELECT b AS batch, count(*) AS n FROM (SELECT (row_number() OVER (ORDER BY doc_id) - 1) // {BATCH} AS b FROM documents)
GROUP BY b
""")
def batch_sizes(spark, sf):
    batched = corpus.batch_ids(documents(spark, sf).select(F.col("doc_id").alias("sent_id")), BATCH)
    return batched.groupBy("batch").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
SELECT doc_id AS sent_id, (row_number() OVER (ORDER BY md5(doc_id || '|{SEED}'), doc_id) - 1) // {BATCH} AS batch
FROM documents
""")
def shuffled_batches(spark, sf):
    ids = documents(spark, sf).select(F.col("doc_id").alias("sent_id"))
    return corpus.shuffled_batches(ids, BATCH, SEED).select("sent_id", "batch")


@query(f"""
WITH {_TOK}, {_MIN_COUNT_VOCAB}, {_ENCODED},
s AS (SELECT doc_id AS sent_id, coalesce(list(id ORDER BY pos) FILTER (id IS NOT NULL), []) AS ids
      FROM documents LEFT JOIN encoded ON sent_id = doc_id GROUP BY doc_id),
b AS (SELECT *, (row_number() OVER (ORDER BY sent_id) - 1) // {BATCH} AS batch FROM s),
m AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch) AS longest FROM b)
SELECT sent_id, batch, len(ids)::BIGINT AS length,
  array_to_string(list_concat(ids, list_transform(range(0, longest - len(ids)), lambda x: 0::BIGINT)), ' ') AS ids
FROM m
""")
def padded_batches(spark, sf):
    batched = corpus.batch_ids(corpus.gather_tokens(_encoded(spark, sf), "id", "ids"), BATCH)
    return corpus.pad_sequences(batched).select(
        "sent_id",
        "batch",
        F.col("length").cast("bigint").alias("length"),
        F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"),
    )


@query(f"""
WITH {_TOK}, {_CHARS},
s AS (SELECT doc_id AS sent_id, coalesce(list(ids ORDER BY pos) FILTER (ids IS NOT NULL), []) AS ids,
      coalesce(max(len(ids)), 0) AS w, count(ids) AS n FROM documents LEFT JOIN (tok JOIN ws USING (word)) ON sent_id = doc_id
      GROUP BY doc_id),
b AS (SELECT *, (row_number() OVER (ORDER BY sent_id) - 1) // {BATCH} AS batch FROM s),
m AS (SELECT *, max(w) OVER (PARTITION BY batch) AS lw, max(n) OVER (PARTITION BY batch) AS ln FROM b)
SELECT sent_id, batch, ln::BIGINT AS sentence_size, lw::BIGINT AS word_size,
  coalesce(list_sum(list_transform(ids, lambda x: len(x))), 0)::BIGINT AS length_total,
  md5(array_to_string(list_concat(
    list_transform(ids, lambda x: array_to_string(list_concat(x, list_transform(range(0, lw - len(x)), lambda y: -1::BIGINT)), ' ')),
    list_transform(range(0, ln - n), lambda z: array_to_string(list_transform(range(0, lw), lambda y: -1::BIGINT), ' '))), '/')) AS digest
FROM m
""")
def padded_chars(spark, sf):
    rows = corpus.encode_chars(corpus.every_word_rows(words_only(spark, sf)), _chars(spark, sf))
    batched = corpus.batch_ids(corpus.gather_tokens(rows, "char_ids", "char_ids", packed=True), BATCH)
    padded = corpus.pad_nested(batched, pad=-1)
    text = F.array_join(F.transform("char_ids", lambda w: F.array_join(w.cast("array<string>"), " ")), "/")
    return padded.select(
        "sent_id",
        "batch",
        F.size("char_ids").cast("bigint").alias("sentence_size"),
        F.coalesce(F.array_max(F.transform("char_ids", lambda w: F.size(w))), F.lit(0)).cast("bigint").alias("word_size"),
        F.aggregate("lengths", F.lit(0), lambda a, x: a + x).cast("bigint").alias("length_total"),
        F.md5(text).alias("digest"),
    )


# ---- spans and scores -----------------------------------------------------------------------------------------------


@query(f"""WITH {_TAGGED},{_spans_sql("s", "tag")} SELECT sent_id, type, "start", "end" FROM s""")
def tag_spans(spark, sf):
    return tagging.tag_spans(sentences(spark, sf))


@query(f"""WITH {_TAGGED},{_chunks_sql("s", "tag")} SELECT sent_id, type, "start", "end" FROM s""")
def tag_chunks(spark, sf):
    return tagging.tag_chunks(sentences(spark, sf))


@query(f"""
WITH {_TAGGED}
SELECT sent_id, pos, 'X' || substr(tag, 2) AS tag FROM tagged WHERE (sent_id + pos) % 13 = 0
""")
def invalid_tags(spark, sf):
    both = sentences(spark, sf)
    broken = F.transform(
        "tags",
        lambda t, i: F.when(F.pmod(F.col("sent_id") + i, F.lit(13)) == 0, F.concat(F.lit("X"), F.substring(t, 2, 100))).otherwise(t),
    )
    return tagging.invalid_tags(both.select("sent_id", broken.alias("tags")))


@query(f"""
WITH {_TAGGED},{_spans_sql("p", "pred")},{_spans_sql("g", "tag")},
j AS (SELECT coalesce(p.type, g.type) AS type, p.type IS NOT NULL AS in_p, g.type IS NOT NULL AS in_g
      FROM p FULL JOIN g ON p.sent_id = g.sent_id AND p.type = g.type AND p."start" = g."start" AND p."end" = g."end"),
c AS (SELECT coalesce(type, 'overall') AS type, count(*) FILTER (in_p AND in_g) AS tp,
        count(*) FILTER (in_p AND NOT in_g) AS fp, count(*) FILTER (in_g AND NOT in_p) AS fn
      FROM j GROUP BY ROLLUP (type)),
s AS (SELECT *, tp / (tp + fp + 1e-13) AS p, tp / (tp + fn + 1e-13) AS r FROM c)
SELECT type, tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r + 1e-13), 6) AS f1
FROM s
""")
def span_f1(spark, sf):
    scores = tagging.span_f1(sentences(spark, sf))
    return scores.select("type", "tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query(f"""
WITH {_TAGGED},{_chunks_sql("p", "pred")},{_chunks_sql("g", "tag")},
c AS (SELECT (SELECT count(*) FROM (SELECT * FROM p INTERSECT SELECT * FROM g)) AS hit,
        (SELECT count(*) FROM p) AS np, (SELECT count(*) FROM g) AS ng,
        (SELECT 100 * avg((tag = pred)::INT) FROM tagged) AS acc)
SELECT round(acc, 6) AS acc, round(200 * (hit / np) * (hit / ng) / (hit / np + hit / ng), 6) AS f1 FROM c
""")
def chunk_f1(spark, sf):
    scores = tagging.token_accuracy_chunk_f1(sentences(spark, sf))
    return scores.select(F.round("acc", 6).alias("acc"), F.round("f1", 6).alias("f1"))


@query(f"""
WITH {_TAGGED} SELECT doc_id AS sent_id, coalesce(string_agg(tag, ' ' ORDER BY pos), '') AS line
FROM documents LEFT JOIN tagged ON sent_id = doc_id GROUP BY doc_id
""")
def tag_lines(spark, sf):
    return tag_line_layout(sentences(spark, sf))


@query(rf"""
WITH {_TAGGED}, d AS (
  SELECT sent_id, pos, CASE WHEN (sent_id + pos) % 3 = 0 THEN pos || '年' WHEN (sent_id + pos) % 3 = 1 THEN word || '月'
    ELSE sent_id || '日' END AS word, tag FROM tagged)
SELECT CASE WHEN regexp_full_match(word, '\p{{Nd}}+[年月日]') THEN 'B-TIME' ELSE tag END AS tag, count(*) AS cnt
FROM d GROUP BY ALL
""")
def time_override(spark, sf):
    both = sentences(spark, sf)
    sent = F.col("sent_id")
    dated = F.transform(
        "words",
        lambda w, i: F.when(F.pmod(sent + i, F.lit(3)) == 0, F.concat(i.cast("string"), F.lit("年")))
        .when(F.pmod(sent + i, F.lit(3)) == 1, F.concat(w, F.lit("月")))
        .otherwise(F.concat(sent.cast("string"), F.lit("日"))),
    )
    ruled = tagging.time_override(both.withColumn("words", dated))
    return unnested(ruled, "tags", "tag").groupBy("tag").agg(F.count(F.lit(1)).alias("cnt"))


# ---- counted model --------------------------------------------------------------------------------------------------

TAG_LIST = sorted(set(TAG_CYCLE))


@query(f"""
WITH {_TAGGED},
x AS (SELECT tag, lead(tag) OVER (PARTITION BY sent_id ORDER BY pos) AS next_tag FROM tagged),
c AS (SELECT tag, next_tag, count(*) AS cnt FROM x WHERE next_tag IS NOT NULL GROUP BY ALL)
SELECT tag, next_tag, cnt, round(ln((cnt + 1) / (sum(cnt) OVER (PARTITION BY tag) + {len(TAG_LIST)})), 6) AS logp FROM c
""")
def tag_transitions(spark, sf):
    counts = tagging.transition_counts(sentences(spark, sf))
    return tagging.smoothed_transitions(counts, len(TAG_LIST)).withColumn("logp", F.round("logp", 6))


@query(f"WITH {_TAGGED} SELECT word, tag, count(*) AS cnt FROM tagged GROUP BY ALL")
def tag_emissions(spark, sf):
    return tagging.emission_counts(sentences(spark, sf))


def _scored(spark: SparkSession, sf: str, by_sentence: bool = False) -> tuple[DataFrame, DataFrame]:
    """Token rows (or sentences) with emission scores learned from the gold tags, and the sentences."""
    both = sentences(spark, sf)
    emissions = tagging.emission_scores(tagging.emission_counts(both), TAG_LIST)
    return tagging.score_tokens(corpus.every_word_rows(both.select("sent_id", "words")), emissions, TAG_LIST, by_sentence), both


@query(f"""
WITH {_TAGGED},
e AS (SELECT word, tag, count(*) AS c FROM tagged GROUP BY ALL),
n AS (SELECT tag, sum(c) AS n FROM e GROUP BY tag), v AS (SELECT count(DISTINCT word) AS v FROM e),
tags AS (SELECT DISTINCT tag FROM tagged),
s AS (SELECT w.word, n.tag, (coalesce(e.c, 0) + 1.0) / (n.n + v.v + 1.0) AS p
      FROM (SELECT DISTINCT word FROM e) w CROSS JOIN n CROSS JOIN v LEFT JOIN e ON e.word = w.word AND e.tag = n.tag),
r AS (SELECT word, tag, row_number() OVER (PARTITION BY word ORDER BY round(ln(p), 9) DESC, tag) AS k FROM s)
SELECT t.sent_id, t.pos, r.tag FROM tagged t JOIN r ON r.word = t.word AND r.k = 1
""")
def argmax_tags(spark, sf):
    scored, _ = _scored(spark, sf)
    rounded = scored.filter(F.col("pos").isNotNull()).withColumn("scores", F.transform("scores", lambda s: F.round(s, 9)))
    return tagging.argmax_tags(rounded, TAG_LIST).select("sent_id", "pos", "tag")


@query()
def viterbi_tags(spark, sf):
    scored, both = _scored(spark, sf, by_sentence=True)
    transitions = tagging.transition_matrix(tagging.transition_counts(both), TAG_LIST)
    decoded = tagging.viterbi_decode(scored, transitions, TAG_LIST)
    return decoded.select("sent_id", F.array_join("tags", " ").alias("tags"))
