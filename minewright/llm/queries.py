"""Registered queries of this subpackage, each beside the SQL that checks it where SQL can say it."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.llm import (
    byte_bpe,
    chat_format,
    class_lm,
    conversation_repair,
    decontamination,
    fim,
    host_rules,
    jaccard_join,
    language_id,
    page_text,
    secret_scan,
    substring_dedup,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

_SPLIT = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_WORDS = _SPLIT.format("coalesce(text, '')")
_LOWER_WORDS = _SPLIT.format(f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')")


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql:
            ORACLE[run.__name__] = sql
        return run

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@_query(rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
p AS (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM d WHERE len(ws) >= 8),
g AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS h FROM p),
again AS (SELECT r, h FROM g GROUP BY ALL HAVING count(*) > 1),
spots AS (SELECT DISTINCT r, unnest(range(i, i + 8)) AS j FROM g SEMI JOIN again USING (r, h)),
rep AS (SELECT r, count(*) AS n_repeat FROM spots GROUP BY r),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT r, sum(n - 1) AS n_dup FROM (SELECT r, line, count(*) AS n FROM l
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL) GROUP BY r),
m AS (SELECT d.r, doc_id, coalesce('+' || source, '-') AS host, len(ws)::BIGINT AS n_words,
      length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
      length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
      coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN rep USING (r) LEFT JOIN dup USING (r)),
f AS (SELECT *, (n_words < 20)::INT AS a, (100 * n_repeat_words > 30 * n_words)::INT AS b,
      (100 * n_symbols > 10 * word_chars)::INT AS c FROM m),
h AS (SELECT host, count(*) AS n, sum(a) AS a, sum(b) AS b, sum(c) AS c FROM f GROUP BY host),
hr AS (SELECT host, n, 'a' AS rule, a AS x FROM h UNION ALL SELECT host, n, 'b', b FROM h UNION ALL SELECT host, n, 'c', c FROM h),
k AS (SELECT rule, avg(x / n) AS mean, coalesce(var_samp(x / n), 0) AS var FROM hr GROUP BY rule),
s AS (SELECT rule, mean, CASE WHEN var > 0 THEN least(1e6, greatest(1, mean * (1 - mean) / var - 1)) ELSE 1e6 END AS size FROM k),
v AS (SELECT host, bool_or((x + mean * size) / (n + size) > 0.5) AS host_failed FROM hr JOIN s USING (rule) GROUP BY host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (a = 1 OR b = 1) AS base_failed, host_failed,
       (a = 0 AND b = 0 AND NOT host_failed) AS kept
FROM f JOIN v USING (host)
""")
def op1_host_rules(spark, sf):
    return host_rules.judge(table(spark, sf, "documents"))


@_query()
def op2_byte_bpe(spark, sf):
    ranks = byte_bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    return byte_bpe.encode_documents(spark, table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN)


@_query(rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
d AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
q AS (SELECT DISTINCT item_id, array_to_string(ws[i:i + 4], ' ') AS g
      FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM b WHERE len(ws) > 0)),
n AS (SELECT item_id, count(*) AS n_item FROM q GROUP BY item_id),
s AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN q USING (g) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM s JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_item - 1e-9
""")
def op4_decontamination(spark, sf):
    return decontamination.find_leaks(spark, table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@_query()
def op6_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    usable = language_id.in_training(F.col("doc_id"), 4, 2)
    found = language_id.identify(spark, docs, language_id.train(docs, usable))
    return found.select("doc_id", (~usable).alias("held_out"), "lang_pred", "score")


@_query(rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, ws FROM d WHERE len(ws) >= 13),
g AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 12], ' ')) AS h FROM p),
f AS (SELECT h, min(doc_id) AS first FROM g GROUP BY h),
dup AS (SELECT doc_id, i FROM g JOIN f USING (h) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM dup),
w AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS j, unnest(ws) AS word FROM d),
k AS (SELECT w.doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n FROM w ANTI JOIN gone USING (doc_id, j)
      GROUP BY w.doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
""")
def op7_substring_dedup(spark, sf):
    return substring_dedup.dedup_substrings(table(spark, sf, "documents"))


_CONTROL = r"\\|<s>|</s>|\[INST\]|\[/INST\]|<<TURN|<</TURN>>|>>"
_COUNTED = f"len(regexp_extract_all({{}}, '{_CONTROL}'))"


@_query(rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, CASE WHEN contains(text, chr(92)) OR contains(text, CASE role WHEN 'user' THEN ' [/INST]'
      WHEN 'assistant' THEN '</s>' ELSE ' <</TURN>>' END) THEN {_COUNTED.format("text")} ELSE 0 END AS extra FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(text) + extra + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 5
           ELSE 20 + length(role) + {_COUNTED.format("role")} END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""")
def op8_chat_format(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat_format.digest_conversations(spark, turns.union(extra))


@_query(r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'),
                  '<[^>]*>', ' ', 'g') AS t FROM pages),
u AS (SELECT page_id, url, replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS t
      FROM a),
s AS (SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM u)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM s
""")
def op9_page_text(spark, sf):
    return page_text.extract(spark, table(spark, sf, "pages"))


@_query(rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_LOWER_WORDS} AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 3], ' ')) AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
r AS (SELECT doc_id, g, row_number() OVER (PARTITION BY doc_id ORDER BY g) AS k FROM s),
pre AS (SELECT r.doc_id, g FROM r JOIN n USING (doc_id) WHERE k <= n - ceil(0.85 * n) + 1),
cand AS (SELECT DISTINCT a.doc_id AS x, b.doc_id AS y FROM pre a JOIN pre b USING (g) WHERE a.doc_id < b.doc_id),
o AS (SELECT x, y, count(*) AS o FROM cand JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y AND a.g = b.g GROUP BY x, y),
e AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 85 * (a.n + b.n - o)),
ways AS MATERIALIZED (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach AS (SELECT x AS src, x AS dst FROM ways UNION SELECT src, y FROM reach JOIN ways ON dst = x),
c AS (SELECT src AS doc_id, min(dst) AS component_id FROM reach GROUP BY src)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(component_id, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
""")
def op10_jaccard_join(spark, sf):
    return jaccard_join.link_components(spark, table(spark, sf, "documents"))


@_query()
def op5_toxicity(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    usable = language_id.in_training(F.col("doc_id"), 3, 1)
    found = toxicity.score(spark, docs, toxicity.train(spark, docs, labels, usable))
    return found.select("doc_id", (~usable).alias("held_out"), "score", "predicted")


@_query()
def op3_class_lm(spark, sf):
    return class_lm.score_documents(spark, table(spark, sf, "documents"))


_LINES = r"regexp_extract_all(text, '[^\n]*\n|[^\n]+')"
_DRAW = "('0x' || substr(h, {}, 8))::UBIGINT::BIGINT"


@_query(rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, text, {_LINES} AS ls, {_DRAW.format(1)} AS h1, {_DRAW.format(9)} AS h2, {_DRAW.format(17)} AS h3,
             {_DRAW.format(25)} AS h4 FROM d),
c AS (SELECT *, len(ls)::BIGINT AS n, least(h1 % (len(ls) + 1), h2 % (len(ls) + 1)) AS a,
             greatest(h1 % (len(ls) + 1), h2 % (len(ls) + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
                  THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(ls[1:a], '') AS pre, array_to_string(ls[a + 1:b], '') AS mid,
             array_to_string(ls[b + 1:n], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
""")
def op12_fill_in_middle(spark, sf):
    cut = fim.with_restored(fim.transform(table(spark, sf, "documents")))
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@_query(r"""
WITH RECURSIVE o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
g(n, j, v) AS (SELECT range, 0, range FROM range(256) UNION ALL
      SELECT n, j + 1, CASE WHEN v % 2 = 1 THEN xor(3988292384::BIGINT, v >> 1) ELSE v >> 1 END FROM g WHERE j < 8),
t AS MATERIALIZED (SELECT n, v AS tv FROM g WHERE j = 8),
crc(name, k, b, v) AS (SELECT name, 0, list_transform(string_split(name, ''), lambda x: ascii(x)), 4294967295::BIGINT
      FROM (SELECT DISTINCT name FROM o)
      UNION ALL SELECT name, k + 1, b, xor(tv, v >> 8) FROM crc JOIN t ON n = (xor(v, b[k + 1]::BIGINT) & 255) WHERE k < len(b)),
f AS MATERIALIZED (SELECT name, xor(v, 4294967295::BIGINT) % 20 AS fault FROM crc WHERE k = len(b)),
d AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
      CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
      unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM o JOIN f USING (name)),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
      row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM d),
x AS MATERIALIZED (SELECT *, left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS pc,
      NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut FROM r),
y AS MATERIALIZED (SELECT *, blank OR nth > 1 AS gone, CASE WHEN cut THEN 5 ELSE 0 END AS pen,
      count(*) OVER (PARTITION BY conv_id) AS n FROM x),
move(s, c, s2) AS (VALUES (0, 'u', 2), (0, 's', 1), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
next(s, s2, role) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
ins(s, s2, cost, letters, said) AS (VALUES (0, 0, 0, '', []::VARCHAR[]), (0, 2, 5, 'I', ['user:']), (0, 3, 10, 'II', ['user:', 'assistant:']),
      (1, 1, 0, '', []), (1, 2, 5, 'I', ['user:']), (1, 3, 10, 'II', ['user:', 'assistant:']), (2, 2, 0, '', []),
      (2, 3, 5, 'I', ['assistant:']), (3, 3, 0, '', []), (3, 2, 5, 'I', ['user:'])),
p(conv_id, i, s, cost, audit, said) AS (
  SELECT y.conv_id, 0::BIGINT, s2, cost::BIGINT, letters, said FROM (SELECT DISTINCT conv_id FROM y) y, ins WHERE s = 0
  UNION ALL
  SELECT conv_id, i, s, min(k)[1:12]::BIGINT, min(k)[13:], arg_min(said, k)
  FROM (SELECT m.conv_id, m.i, ins.s2 AS s, lpad((m.cost + ins.cost)::VARCHAR, 12, '0') || m.audit || ins.letters AS k, m.said || ins.said AS said
        FROM (SELECT p.conv_id, y.i, p.s, p.cost + 2 AS cost, audit || 'D' AS audit, said FROM p JOIN y ON p.conv_id IS NOT DISTINCT FROM y.conv_id AND y.i = p.i + 1
              UNION ALL SELECT p.conv_id, y.i, move.s2, p.cost + pen, audit || 'K', said || [role || ':' || text]
              FROM p JOIN y ON p.conv_id IS NOT DISTINCT FROM y.conv_id AND y.i = p.i + 1 AND NOT gone JOIN move ON move.s = p.s AND move.c = y.c
              UNION ALL SELECT p.conv_id, y.i, next.s2, p.cost + pen + 1, audit || 'R', said || [next.role || ':' || text]
              FROM p JOIN y ON p.conv_id IS NOT DISTINCT FROM y.conv_id AND y.i = p.i + 1 AND NOT gone JOIN next ON next.s = p.s) m
        JOIN ins ON ins.s = m.s) GROUP BY conv_id, i, s),
e AS (SELECT conv_id, arg_min((cost, audit, array_to_string(said, chr(10))), lpad(cost::VARCHAR, 12, '0') || audit) AS best
      FROM p JOIN (SELECT DISTINCT conv_id AS c2, n FROM y) l ON p.conv_id IS NOT DISTINCT FROM c2 AND i = n WHERE s IN (0, 3) GROUP BY conv_id),
m AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
      count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND nth > 1) AS duplicate,
      count(*) FILTER (NOT blank AND nth = 1 AND cut) AS truncated,
      count(*) FILTER (i > 1 AND pc || c NOT IN ('su', 'ua', 'au')) AS illegal FROM y GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best[1], 0) AS cost,
       coalesce(best[2], '') AS audit, sha256(coalesce(best[3], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN m ON a.conv_id IS NOT DISTINCT FROM m.conv_id
     LEFT JOIN e ON a.conv_id IS NOT DISTINCT FROM e.conv_id
""")
def op13_conversation_repair(spark, sf):
    damaged = conversation_repair.damage(table(spark, sf, "conversations"))
    return conversation_repair.digests(conversation_repair.repair(spark, damaged, F.col("dropped")))


def _secret_parts() -> str:
    """SQL of the matches of every pattern, from left to right."""
    counts = {
        "assign": "length(regexp_extract(hit, '{}', 2)) >= 6",
        "account": "length(regexp_extract(hit, '{}', 2)) >= 3",
        "token": "regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[0-9]')",
    }
    parts = []
    for number, (kind, pattern) in enumerate(secret_scan.PATTERNS.items()):
        quoted = pattern.replace("'", "''")
        parts.append(
            f"SELECT r, {number} AS kind, i, length(hits[i]) AS size, length(gaps[i]) AS gap, hits[i] AS hit, "
            f"{counts.get(kind, 'true').format(quoted).replace('hit', 'hits[i]')} AS counts "
            f"FROM (SELECT r, hits, gaps, unnest(range(1, len(hits) + 1)) AS i FROM "
            f"(SELECT r, regexp_extract_all(text, '{quoted}') AS hits, regexp_split_to_array(text, '{quoted}') AS gaps FROM d))"
        )
    return " UNION ALL ".join(parts)


@_query(f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({_secret_parts()}),
e AS (SELECT *, sum(gap + size) OVER (PARTITION BY r, kind ORDER BY i) AS stop FROM m),
p AS (SELECT r, kind, stop - size AS start, stop FROM e WHERE counts),
o AS (SELECT *, kind < 3 AS strong, sum((kind = 6)::INT) OVER (PARTITION BY r ORDER BY start, kind) AS scope,
      max(CASE WHEN kind < 3 THEN stop END) OVER (PARTITION BY r ORDER BY start, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last,
      min(CASE WHEN kind < 3 THEN start END) OVER (PARTITION BY r ORDER BY start, kind ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next FROM p),
q AS (SELECT * FROM o WHERE kind <> 6 AND (strong OR NOT (coalesce(last > start, false) OR coalesce(next < stop, false)))),
l AS (SELECT a.*, EXISTS (SELECT 1 FROM q b WHERE b.r = a.r AND b.scope = a.scope AND abs(b.start - a.start) <= 200 AND b.kind IN (1, 4)) AS ids,
      EXISTS (SELECT 1 FROM q b WHERE b.r = a.r AND b.scope = a.scope AND abs(b.start - a.start) <= 200 AND b.kind IN (0, 2, 3)) AS secrets FROM q a),
w AS (SELECT *, CASE kind WHEN 3 THEN ids WHEN 4 THEN secrets WHEN 5 THEN ids AND secrets ELSE true END AS reported,
      ['assign', 'access', 'hex', 'token', 'account', 'endpoint'][kind + 1] || ':' || start::BIGINT || ':' || stop::BIGINT AS name FROM l),
g AS (SELECT r, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b, count(*) FILTER (kind = 2) AS c,
      count(*) FILTER (reported AND NOT strong) AS n_linked, string_agg(name, ',' ORDER BY start, kind) FILTER (strong) AS base,
      string_agg(name, ',' ORDER BY start, kind) FILTER (reported) AS spans FROM w GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, coalesce(n_linked, 0) AS n_linked,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (r)
""")
def op11_secret_scan(spark, sf):
    found = secret_scan.scan(table(spark, sf, "documents"))
    base = F.sha2(secret_scan.written(F.col("base_spans")).cast("binary"), 256)
    counts = ["doc_id", "n_assign", "n_access", "n_hex", "n_linked"]
    return found.select(*counts, base.alias("base_sha256"), secret_scan.written(F.col("spans")).alias("spans"))
