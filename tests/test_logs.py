import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from minewright.operators.logs import check_appends
from minewright.plans.ordered import sequence_block, with_previous
from minewright.operators import logs as ops
from minewright.streaming import logs as streams

SCHEMA = "seq bigint, client bigint, req bigint, key string, op string, value string"


def make_log(n=400):
    rng = random.Random(8)
    return [
        (s, rng.randint(0, 3), rng.randint(0, 60), "hot" if rng.random() < 0.7 else rng.choice("xyz"),
         rng.choices(["Put", "Append", "Get"], [1, 12, 6])[0], f"{s};")
        for s in range(n)
    ]


def replay(log):
    state, reads = {}, []
    for seq, _, _, key, op, value in log:
        if op == "Put":
            state[key] = (seq, value, 0, value)
        elif op == "Append":
            put, first, n, text = state.get(key, (None, "", 0, ""))
            state[key] = (put, first, n + 1, text + value)
        else:
            known = key in state
            put, first, n, _ = state.get(key, (None, "", 0, ""))
            reads.append((seq, key, put, first, n, "OK" if known else "ErrNoKey"))
    return {k: v[3] for k, v in state.items()}, reads


def whole(pieces):
    values = {}
    for r in sorted(pieces.collect(), key=lambda r: r["piece"]):
        values[r["key"]] = values.get(r["key"], "") + r["value"]
    return values


@pytest.mark.parametrize("width", [9, 1_000_000])
def test_fold_and_reads_match_replay(spark, no_broadcast, width):
    data = make_log()
    log = spark.createDataFrame(data, SCHEMA).repartition(5)
    state, reads = replay(data)
    assert whole(ops.fold_log(log, width)) == state
    got = ops.get_as_of(log, width).collect()
    assert sorted(tuple(r) for r in got) == sorted(reads)


def test_put_replaces_and_missing_key(spark):
    ops_of = [("Put", "a"), ("Append", "b"), ("Put", "c"), ("Append", "d")]
    log = spark.createDataFrame([(i, 0, i, "k", o, v) for i, (o, v) in enumerate(ops_of)] + [(9, 0, 9, "none", "Get", "")], SCHEMA)
    assert whole(ops.fold_log(log)) == {"k": "cd"}
    assert rows(ops.get_as_of(log), "put_value", "err") == [("", "ErrNoKey")]


def test_dedup_keeps_the_first(spark):
    data = make_log()
    first = {}
    for row in data:
        first.setdefault((row[1], row[2]), row)
    got = ops.dedup_requests(spark.createDataFrame(data, SCHEMA).repartition(3))
    assert sorted(tuple(r) for r in got.collect()) == sorted(first.values())


def test_append_audit(spark):
    sent = spark.createDataFrame([(c, r) for c in (1, 2) for r in range(5)], "client bigint, req bigint")
    stored = [(1, r, r) for r in range(5)] + [(2, 0, 10), (2, 1, 9), (2, 3, 11), (2, 3, 12), (2, 4, 13)]
    got = ops.check_appends(sent, spark.createDataFrame(stored, "client bigint, req bigint, pos bigint"), width=2)
    assert rows(got, *got.columns) == [(1, 5, 0, 0, 0), (2, 5, 1, 1, 1)]


@pytest.mark.parametrize("width", [2, 1000])
def test_locks(spark, width):
    steps = ["Unlock", "Lock", "Lock", "Unlock", "Unlock", "Lock"]
    log = spark.createDataFrame([(i, "m", o) for i, o in enumerate(steps)], "seq bigint, name string, op string")
    assert [g for _, g in rows(ops.lock_history(log, width), "seq", "granted")] == [False, True, False, True, False, True]
    got = sorted(tuple(r) for r in ops.lock_intervals(log, width).na.fill(-1).collect())
    assert got == [("m", 1, 3), ("m", 5, -1)]


START = dt.datetime(2024, 1, 1)


def ping_rows():
    rng = random.Random(2)
    out = []
    for server in ("a", "b"):
        t = 0.0
        for _ in range(60):
            t += rng.choice([0.1, 0.2, 0.5, 0.6, 3.0])
            out.append((server, START + dt.timedelta(milliseconds=round(t * 1000))))
    return out


@pytest.mark.parametrize("block_seconds", [2, 86_400])
def test_gaps_and_sessions(spark, block_seconds):
    data = ping_rows()
    pings = spark.createDataFrame(data, "server string, ts timestamp_ntz").repartition(3)
    gaps, runs, until = [], [], max(t for _, t in data)
    down = []
    for server in ("a", "b"):
        times = [t for s, t in data if s == server]
        if (until - times[-1]).total_seconds() > 0.5:
            down.append((server, times[-1], times[-1] + dt.timedelta(seconds=0.5), None))
        run = [times[0]]
        for before, after in zip(times, times[1:]):
            if (after - before).total_seconds() > 0.5:
                gaps.append((server, before, before + dt.timedelta(seconds=0.5), after))
                runs.append((server, run[0], run[-1], len(run)))
                run = []
            run.append(after)
        runs.append((server, run[0], run[-1], len(run)))
    assert down
    columns = ("server", "last_ping", "dead_from", "back_at")
    found = ops.ping_gaps(pings, block_seconds=block_seconds)
    assert rows(found.filter("back_at IS NOT NULL"), *columns) == sorted(gaps)
    assert rows(found.filter("back_at IS NULL"), *columns) == down
    later = ops.ping_gaps(pings, block_seconds=block_seconds, as_of=F.lit(until + dt.timedelta(seconds=9)))
    assert later.filter("back_at IS NULL").count() == 2
    assert rows(ops.sessions(pings, 0.5, block_seconds), "server", "start", "end", "n") == sorted(runs)


def test_shard_configs(spark):
    configs = spark.createDataFrame([(0, 0, 1), (0, 1, 1), (3, 1, 2), (5, 0, 9)], "num int, shard int, gid int")
    assert rows(ops.config_as_of(configs, 4), "shard", "gid") == [(0, 1), (1, 2)]
    assert rows(ops.config_as_of(configs), "shard", "gid") == rows(ops.config_as_of(configs, 99), "shard", "gid") == [(0, 9), (1, 2)]
    groups = spark.createDataFrame([(1,), (2,), (3,)], "gid int")
    assert tuple(ops.shard_balance_audit(ops.config_as_of(configs, 4), groups).collect()[0]) == (0, 0, 1, True)
    assert tuple(ops.shard_balance_audit(ops.config_as_of(configs), groups).collect()[0]) == (1, 0, 1, False)


def test_stream_fold_equals_batch(spark, tmp_path):
    data = make_log()
    rng = random.Random(4)
    shuffled = data[:]
    rng.shuffle(shuffled)
    for i in range(4):
        spark.createDataFrame(shuffled[i::4], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = streams.read_log_stream(spark, f"{tmp_path}/in", SCHEMA, files_per_trigger=1)
    query = streams.stream_fold(stream, f"{tmp_path}/table", f"{tmp_path}/cp")
    query.awaitTermination(120)
    assert whole(ops.fold_log(streams.read_folded(spark, f"{tmp_path}/table"), 50)) == replay(data)[0]


def test_stream_dedup_equals_batch(spark, tmp_path):
    data = [(s, c, r, START + dt.timedelta(seconds=s)) for s, c, r in [(0, 1, 1), (1, 1, 1), (2, 1, 2), (3, 2, 1), (4, 1, 2)]]
    schema = "seq bigint, client bigint, req bigint, ts timestamp_ntz"
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/in")
    stream = streams.stream_dedup(streams.read_log_stream(spark, f"{tmp_path}/in", schema), "1 hour")
    stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(
        f"{tmp_path}/out"
    ).awaitTermination(120)
    got = rows(spark.read.parquet(f"{tmp_path}/out"), "client", "req")
    assert got == rows(ops.dedup_requests(spark.createDataFrame(data, schema)), "client", "req")


def test_stream_sessions_equal_closed_batch_sessions(spark, tmp_path):
    data = ping_rows() + [("sentinel", START + dt.timedelta(days=2))]
    schema = "server string, ts timestamp_ntz"
    frame = spark.createDataFrame(data, schema)
    frame.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = streams.stream_sessions(streams.read_log_stream(spark, f"{tmp_path}/in", schema), "500 milliseconds", "1 second")
    stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(
        f"{tmp_path}/out"
    ).awaitTermination(120)
    got = rows(spark.read.parquet(f"{tmp_path}/out").withColumn("start", F.unix_micros("start")), "server", "start", "n")
    batch = ops.sessions(frame.filter("server <> 'sentinel'").withColumn("ts", F.col("ts").cast("timestamp")), 0.5)
    assert got == rows(batch.withColumn("start", F.unix_micros("start")), "server", "start", "n")


def test_disorder_is_seen_over_a_missing_request(spark):
    sent = spark.createDataFrame([("a", i) for i in (1, 2, 3)], "client string, req long")
    stored = spark.createDataFrame([("a", 1, 10), ("a", 3, 5)], "client string, req long, pos long")
    assert [tuple(r) for r in check_appends(sent, stored).collect()] == [("a", 3, 1, 0, 1)]


def test_rows_with_null_keys_stay(spark):
    rows_ = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("a", 1, 7), ("a", None, 8)], "k string, at long, v long")
    got = with_previous(rows_, ["k"], ["at"], sequence_block("at", 10), {"before": "v"})
    assert sorted((r.v, r.before) for r in got.collect()) == [(5, None), (6, 5), (7, 8), (8, None)]


@pytest.mark.parametrize("piece_bytes", [1, 20, 1 << 20])
def test_read_values_spell_out_the_text_in_bounded_pieces(spark, no_broadcast, piece_bytes):
    data = [(0, 0, 0, "hot", "Get", None), *((s + 1, *rest) for s, *rest in make_log())]
    data += [(900, 0, 0, None, "Append", "né"), (901, 0, 0, None, "Append", None), (902, 0, 0, None, "Get", None)]
    data += [(903, 0, 0, "e", "Append", ""), (904, 0, 0, "e", "Get", None)]
    state, texts = {}, {}
    for seq, _, _, key, op, value in data:
        if op == "Get":
            texts[seq] = (key, state.get(key), "OK" if key in state else "ErrNoKey")
        else:
            state[key] = ("" if op == "Put" else state.get(key, "")) + (value or "")
    asked = sorted(texts)[::3] + [0, 902, 904]
    reads = spark.createDataFrame([(s,) for s in [*asked, 0, 1_000_000]], "seq bigint")
    got = {}
    for r in sorted(ops.read_values(spark.createDataFrame(data, SCHEMA), reads, piece_bytes, 50).collect(), key=lambda r: (r.seq, r.piece)):
        assert len(r.value.encode()) <= piece_bytes + 4
        before = got.get(r.seq, (r.key, "", r.err))
        got[r.seq] = (r.key, before[1] + r.value, r.err)
    assert got == {s: (k, text or "", err) for s, (k, text, err) in texts.items() if s in asked}


def test_read_values_skip_numbers_at_which_no_write_begins(spark):
    data = [(1, 0, 0, "a", "Put", "0123456"), (2, 0, 0, "a", "Get", None), (3, 0, 0, "a", "Append", "x" * 14), (4, 0, 0, "a", "Append", "z")]
    data += [(5, 0, 0, "a", "Get", None), (6, 0, 0, "b", "Get", None)]
    got = ops.read_values(spark.createDataFrame(data, SCHEMA), spark.createDataFrame([(2,), (5,), (6,)], "seq bigint"), 5, 50)
    wanted = [(2, 0, "0123456", "OK"), (5, 0, "0123456", "OK"), (5, 1, "x" * 14, "OK"), (5, 4, "z", "OK"), (6, 0, "", "ErrNoKey")]
    assert sorted((r.seq, r.piece, r.value, r.err) for r in got.collect()) == wanted


def retried_log(n, span):
    """Requests of which some come again within ``span`` numbers, in an order disturbed by less than that."""
    rng = random.Random(5)
    out, recent = [], []
    for seq in range(n):
        again = [r for r in recent if seq - r[0] < span]
        if again and rng.random() < 0.2:
            out.append((seq, *rng.choice(again)[1:]))
            continue
        row = (seq, seq % 3, seq, rng.choice("aab"), rng.choices(["Put", "Append"], [1, 3])[0], f"{seq};")
        out.append(row)
        recent = [*again, row]
    return sorted(out, key=lambda r: r[0] + rng.random() * (span - 1))


def test_stream_fold_with_retries_stays_bounded(spark, tmp_path):
    span, size, table = 12, 20, f"{tmp_path}/table"
    data = retried_log(24 * size, span)
    firsts, held = {}, []
    for row in sorted(data):
        firsts.setdefault(row[1:3], row)
    for number in range(24):
        batch = spark.createDataFrame(data[number * size : (number + 1) * size], SCHEMA).coalesce(1)
        for _ in range(2 if number in (3, 8, 15) else 1):
            streams.fold_batch(batch, number, table, ("client", "req"), span, merge_every=4)
        if number % 4 == 3:
            assert streams._written(spark, f"{table}/piece") == []
            held.append(spark.read.parquet(f"{table}/base/{number}").count())
    folded = streams.read_folded(spark, table, ("client", "req"))
    assert whole(ops.fold_log(folded, 50)) == replay(sorted(firsts.values()))[0]
    assert max(held) <= 60 and held[-1] < 2 * held[0]


def test_stream_of_retries_equals_batch(spark, tmp_path):
    data = retried_log(120, 10)
    for i in range(3):
        spark.createDataFrame(data[i * 40 : i * 40 + 40], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = streams.read_log_stream(spark, f"{tmp_path}/in", SCHEMA, files_per_trigger=1)
    request = ("client", "req")
    streams.stream_fold(stream, f"{tmp_path}/t", f"{tmp_path}/cp", request, span=50, merge_every=2).awaitTermination(120)
    batch = ops.fold_log(ops.dedup_requests(spark.createDataFrame(data, SCHEMA)), 50)
    assert whole(ops.fold_log(streams.read_folded(spark, f"{tmp_path}/t", request), 50)) == whole(batch)


def test_stream_liveness_equals_batch(spark, tmp_path):
    data = ping_rows()
    late = START + dt.timedelta(days=2)
    schema = "server string, ts timestamp_ntz"
    data.sort(key=lambda r: r[1])
    cut = len(data) // 2
    for part in (data[:cut][::-1], data[cut:] + [(None, START)], [("sentinel", late)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = streams.stream_liveness(streams.read_log_stream(spark, f"{tmp_path}/in", schema, 1), "1 hour")
    stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(
        f"{tmp_path}/out"
    ).awaitTermination(120)
    out = spark.read.parquet(f"{tmp_path}/out").filter("server <> 'sentinel'")
    latest = out.groupBy("server", "last_ping", "dead_from").agg(F.max("back_at").alias("back_at"))
    pings = spark.createDataFrame(data, schema).withColumn("ts", F.col("ts").cast("timestamp"))
    batch = ops.ping_gaps(pings, as_of=F.lit(late))
    assert batch.filter("back_at IS NULL").count() == 2
    columns = ("server", "last_ping", "dead_from", "back_at")
    assert sorted(map(str, latest.select(*columns).collect())) == sorted(map(str, batch.select(*columns).collect()))
