"""Log queries: the events are the log, with the user as key and client and the event type as operation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.catalog.registry import query, table
from minewright.functions.keys import shard_of
from minewright.operators import logs as ops

WIDTH = 4096
PIECE = 64
GAP_MILLIS = 3_600_000
BLOCK_SECONDS = 7 * 86_400
GROUPS = 6


def event_log(spark: SparkSession, sf: str) -> DataFrame:
    op = (
        F.when(F.col("event_type") == "signup", ops.PUT)
        .when(F.col("event_type") == "click", ops.APPEND)
        .when(F.col("event_type") == "view", ops.GET)
    )
    return table(spark, sf, "events").select(
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("client"),
        F.floor("value").cast("bigint").alias("req"),
        F.col("user_id").cast("string").alias("key"),
        op.alias("op"),
        F.concat(F.lit("x"), F.col("event_id").cast("string"), F.lit("y")).alias("value"),
        "ts",
    )


_LOG = """log AS (
  SELECT event_id AS seq, user_id AS client, floor(value)::BIGINT AS req, user_id::VARCHAR AS key,
    CASE event_type WHEN 'signup' THEN 'Put' WHEN 'click' THEN 'Append' WHEN 'view' THEN 'Get' END AS op,
    'x' || event_id || 'y' AS value
  FROM events)"""


@query(f"""
WITH {_LOG}, p AS (SELECT key, max(seq) AS put FROM log WHERE op = 'Put' GROUP BY key)
SELECT key, seq // {WIDTH} AS piece, string_agg(value, '' ORDER BY seq) AS value
FROM log LEFT JOIN p USING (key) WHERE op IN ('Put', 'Append') AND seq >= coalesce(put, seq) GROUP BY ALL
""")
def kv_final_state(spark, sf):
    return ops.fold_log(event_log(spark, sf), WIDTH)


@query(f"""
WITH {_LOG},
s AS (
  SELECT *, last_value(CASE WHEN op = 'Put' THEN seq END IGNORE NULLS) OVER w AS put_seq,
    last_value(CASE WHEN op = 'Put' THEN value END IGNORE NULLS) OVER w AS put_value,
    sum((op = 'Append')::INT) OVER w AS a
  FROM log WHERE op IS NOT NULL WINDOW w AS (PARTITION BY key ORDER BY seq ROWS UNBOUNDED PRECEDING)),
r AS (SELECT s.*, s.a - coalesce(p.a, 0) AS n FROM s LEFT JOIN s p ON p.seq = s.put_seq WHERE s.op = 'Get')
SELECT seq, key, put_seq, coalesce(put_value, '') AS put_value, n::BIGINT AS n_appends,
  CASE WHEN put_seq IS NULL AND n = 0 THEN 'ErrNoKey' ELSE 'OK' END AS err
FROM r
""")
def kv_get_as_of(spark, sf):
    return ops.get_as_of(event_log(spark, sf).filter(F.col("op").isNotNull()), WIDTH)


@query(f"""
WITH {_LOG}, r AS (SELECT key, max(seq) AS seq FROM log WHERE op = 'Get' GROUP BY key),
j AS (
  SELECT r.key, r.seq, w.seq AS pos, w.value, strlen(w.value) + 1 AS size,
    max(CASE WHEN w.op = 'Put' THEN w.seq END) OVER (PARTITION BY r.key) AS put
  FROM r JOIN log w ON w.key = r.key AND w.seq < r.seq AND w.op IN ('Put', 'Append')),
s AS (
  SELECT *, ((sum(size) OVER (PARTITION BY key ORDER BY pos) - size) // {PIECE})::BIGINT AS piece
  FROM j WHERE pos >= coalesce(put, pos))
SELECT seq, key, piece, string_agg(value, '' ORDER BY pos) AS value, 'OK' AS err FROM s GROUP BY seq, key, piece
UNION ALL SELECT seq, key, 0, '', 'ErrNoKey' FROM r WHERE seq NOT IN (SELECT seq FROM j)
""")
def kv_read_values(spark, sf):
    """The text of every key's last Get."""
    log = event_log(spark, sf)
    last = log.filter(F.col("op") == ops.GET).groupBy("key").agg(F.max("seq").alias("seq"))
    return ops.read_values(log, last, PIECE, WIDTH)


@query(f"WITH {_LOG} SELECT client, req, min(seq) AS seq, min_by(value, seq) AS value FROM log GROUP BY client, req")
def log_dedup(spark, sf):
    return ops.dedup_requests(event_log(spark, sf)).select("client", "req", "seq", "value")


@query("""
WITH sent AS (SELECT user_id AS client, event_id AS req FROM events),
stored AS (
  SELECT client, req, CASE WHEN req % 83 = 0 THEN req - 5000 ELSE req END AS pos FROM sent WHERE req % 97 <> 0
  UNION ALL SELECT client, req, req + 7 FROM sent WHERE req % 89 = 0),
f AS (SELECT client, req, min(pos) AS pos, count(*) AS n FROM stored GROUP BY ALL),
j AS (SELECT s.client, s.req, pos, n, lag(pos IGNORE NULLS) OVER (PARTITION BY s.client ORDER BY s.req) AS before
      FROM sent s LEFT JOIN f ON f.client = s.client AND f.req = s.req)
SELECT client, count(*) AS n_sent, count(*) FILTER (pos IS NULL) AS n_missing, count(*) FILTER (n > 1) AS n_duplicated,
  count(*) FILTER (pos <= before) AS n_disordered
FROM j GROUP BY client
""")
def append_audit(spark, sf):
    sent = table(spark, sf, "events").select(F.col("user_id").alias("client"), F.col("event_id").alias("req"))
    moved = F.when(F.col("req") % 83 == 0, F.col("req") - 5000).otherwise(F.col("req"))
    stored = sent.filter(F.col("req") % 97 != 0).withColumn("pos", moved)
    again = sent.filter(F.col("req") % 89 == 0).withColumn("pos", F.col("req") + 7)
    return ops.check_appends(sent, stored.unionByName(again), WIDTH)


def _locks(spark: SparkSession, sf: str) -> DataFrame:
    op = F.when(F.col("event_type").isin("purchase", "view"), ops.LOCK).when(F.col("event_type") == "error", ops.UNLOCK)
    return (
        table(spark, sf, "events")
        .select(F.col("event_id").alias("seq"), F.col("user_id").alias("name"), op.alias("op"))
        .filter(F.col("op").isNotNull())
    )


_LOCKS = """l AS (
  SELECT seq, name, op, coalesce(lag(op) OVER (PARTITION BY name ORDER BY seq), 'Unlock') AS before
  FROM (SELECT event_id AS seq, user_id AS name,
          CASE WHEN event_type IN ('purchase', 'view') THEN 'Lock' WHEN event_type = 'error' THEN 'Unlock' END AS op
        FROM events) WHERE op IS NOT NULL)"""


@query(f"WITH {_LOCKS} SELECT seq, name, op, op <> before AS granted FROM l")
def lock_grants(spark, sf):
    return ops.lock_history(_locks(spark, sf), WIDTH)


@query(f"""
WITH {_LOCKS}, g AS (SELECT *, lead(seq) OVER (PARTITION BY name ORDER BY seq) AS n FROM l WHERE op <> before)
SELECT name, seq AS locked_at, n AS unlocked_at FROM g WHERE op = 'Lock'
""")
def lock_intervals(spark, sf):
    return ops.lock_intervals(_locks(spark, sf), WIDTH)


def pings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(F.col("user_id").alias("server"), "ts")


@query(f"""
WITH p AS (SELECT user_id AS server, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS last_ping FROM events)
SELECT server, epoch_us(last_ping) AS last_ping, epoch_us(last_ping) + {GAP_MILLIS * 5000} AS dead_from,
  epoch_us(ts) AS back_at
FROM p WHERE epoch_us(ts) - epoch_us(last_ping) > {GAP_MILLIS * 5000}
UNION ALL
SELECT user_id, epoch_us(max(ts)), epoch_us(max(ts)) + {GAP_MILLIS * 5000}, NULL
FROM events GROUP BY user_id HAVING (SELECT max(epoch_us(ts)) FROM events) - epoch_us(max(ts)) > {GAP_MILLIS * 5000}
""")
def ping_gaps(spark, sf):
    gaps = ops.ping_gaps(pings(spark, sf), GAP_MILLIS, 5, BLOCK_SECONDS)
    micros = [F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in ("last_ping", "dead_from", "back_at")]
    return gaps.select("server", *micros)


@query("""
WITH p AS (SELECT user_id AS server, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS b FROM events),
s AS (SELECT *, sum((b IS NULL OR epoch_us(ts) - epoch_us(b) > 14400000000)::INT)
        OVER (PARTITION BY server ORDER BY ts) AS g FROM p)
SELECT server, epoch_us(min(ts)) AS start, epoch_us(max(ts)) AS "end", count(*) AS n FROM s GROUP BY server, g
""")
def sessions(spark, sf):
    runs = ops.sessions(pings(spark, sf), 14_400, BLOCK_SECONDS)
    return runs.select(
        "server", *[F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in ("start", "end")], "n"
    )


@query("SELECT ascii(substr(p_name, 1, 1)) % 10 AS shard, count(*) AS cnt FROM part GROUP BY ALL")
def shard_load(spark, sf):
    return ops.shard_load(table(spark, sf, "part"), shard_of(F.col("p_name")))


def _configs(spark: SparkSession, sf: str) -> DataFrame:
    """Each event moves the shard of its user's first digit to the group its value names."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("num"),
        shard_of(F.col("user_id").cast("string")).alias("shard"),
        F.pmod(F.floor("value"), F.lit(GROUPS)).cast("int").alias("gid"),
    )


_CONFIG = f"""m AS (
  SELECT event_id AS num, ascii(substr(user_id::VARCHAR, 1, 1)) % 10 AS shard, (floor(value)::BIGINT % {GROUPS})::INT AS gid
  FROM events)"""


@query(f"""
WITH {_CONFIG}, h AS (SELECT max(num) // 2 AS half FROM m)
SELECT 'half' AS version, shard, max_by(gid, num) AS gid FROM m WHERE num <= (SELECT half FROM h) GROUP BY shard
UNION ALL SELECT 'latest', shard, max_by(gid, num) FROM m GROUP BY shard
""")
def config_as_of(spark, sf):
    configs = _configs(spark, sf)
    half = configs.agg(F.max("num")).collect()[0][0] // 2
    early, latest = ops.config_as_of(configs, half), ops.config_as_of(configs)
    columns = ["shard", "gid"]
    return early.select(F.lit("half").alias("version"), *columns).unionByName(
        latest.select(F.lit("latest").alias("version"), *columns)
    )


@query(f"""
WITH {_CONFIG}, c AS (SELECT shard, max_by(gid, num) AS gid FROM m GROUP BY shard),
g AS (SELECT r_regionkey AS gid FROM region),
n AS (SELECT g.gid, count(c.shard) AS n FROM g LEFT JOIN c USING (gid) GROUP BY g.gid),
i AS (SELECT count(*) AS n_invalid FROM c WHERE gid NOT IN (SELECT gid FROM g))
SELECT n_invalid, min(n) AS min_shards, max(n) AS max_shards, n_invalid = 0 AND max(n) - min(n) <= 1 AS balanced
FROM n CROSS JOIN i GROUP BY n_invalid
""")
def shard_balance(spark, sf):
    groups = table(spark, sf, "region").select(F.col("r_regionkey").alias("gid"))
    return ops.shard_balance_audit(ops.config_as_of(_configs(spark, sf)), groups)
